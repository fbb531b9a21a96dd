"""tabulae: PySpark-native toolkit for periodic survey / transaction microdata.

Operators are plain functions ``(DataFrame, roles...) -> DataFrame`` built on
DataFrame / SQL / ``pyspark.ml`` primitives; see ``README.md``.
"""
from tabulae.spec import TableSpec  # noqa: F401

__version__ = "0.1.0"
