"""Scans and sinks: text-typed delivery scans, the convert-once typed table,
prepared-table and result writers, model persistence.

Paths may be local or any Hadoop-compatible URI; existence checks and
listings go through the session's Hadoop FileSystem, not the local disk.
"""
from __future__ import annotations

from typing import Callable, Mapping, Sequence
from urllib.parse import quote

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulae.operators.harmonise import add_provenance, harmonise, select_required, stack_by_name


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def listing(spark: SparkSession, directory: str) -> list[str]:
    fs, p = _fs(spark, directory)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def delivery_path(spark: SparkSession, directory: str, files: Mapping[str, str], period: str) -> str:
    """Path of the delivery of ``period``; a missing file error lists what is there."""
    if period not in files:
        raise KeyError(f"no delivery registered for period {period!r}; known: {sorted(files)}")
    path = f"{directory.rstrip('/')}/{files[period]}"
    if not exists(spark, path):
        raise FileNotFoundError(f"{path} does not exist. Files in {directory}: {listing(spark, directory)}")
    return path


def read_text(spark: SparkSession, path: str, fmt: str = "csv", **options) -> DataFrame:
    """All-string scan of a delivery (S3/S4): no inference, empty fields are NULL.

    CSV is read with a header and every field as text; for typed formats every
    column is cast to string so that the harmonisation sees one contract.
    """
    if fmt == "csv":
        opts = {"header": "true", "inferSchema": "false", "emptyValue": None, **options}
        return spark.read.options(**opts).csv(path)
    df = spark.read.format(fmt).options(**options).load(path)
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def load_delivery(spark: SparkSession, path: str, period: str, required: Sequence[str],
                  renames: Mapping[str, str] | None = None, doubles: Sequence[str] = (),
                  ints: Sequence[str] = (), codes: Sequence[str] = (), year: int | None = None,
                  quarter: int | None = None, fmt: str = "csv", **options) -> DataFrame:
    """One delivery: text scan -> required columns -> rename/type -> provenance."""
    text = select_required(read_text(spark, path, fmt, **options), required, source=path)
    typed = harmonise(text, renames, doubles, ints, codes)
    return add_provenance(typed, period, path.rstrip("/").split("/")[-1], year, quarter)


def typed_table(spark: SparkSession, target: str, periods: Sequence[str],
                build: Callable[[str], DataFrame], partition: str = "period", reuse: bool = True) -> DataFrame:
    """Convert-once typed store (S6): one committed table per period below ``target``.

    A period is reused only if its table has the ``_SUCCESS`` marker of a finished write, so a
    folder that a lost job left half-written is converted again.  The tables are stacked by
    name and must have the same columns; a delivery without one of them is an error, not NULLs.
    The period label comes from the list, never from a folder name.
    """
    tables = []
    for period in periods:
        path = f"{target.rstrip('/')}/{partition}={quote(period, safe='')}"
        if not (reuse and exists(spark, f"{path}/_SUCCESS")):
            df = build(period)
            df.drop(partition).write.mode("overwrite").parquet(path)
        tables.append(spark.read.parquet(path).withColumn(partition, F.lit(period)))
    if not tables:
        raise ValueError("no periods given")
    return stack_by_name(tables)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write a prepared table as Parquet, optionally partitioned."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_bucketed(df: DataFrame, name: str, key: Sequence[str], buckets: int, path: str | None = None) -> str:
    """Write a table bucketed and sorted by ``key`` into the session catalog (co-located joins).

    Two tables bucketed by the same key into the same number of buckets join and
    aggregate on that key without a shuffle (the plan has no Exchange); this is how
    ``lineitem`` and ``orders`` should be stored for the records join at scale.
    """
    w = df.write.mode("overwrite").bucketBy(buckets, *key).sortBy(*key)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return name


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a prepared table."""
    return spark.read.parquet(path)


def _nested(kind) -> bool:
    return isinstance(kind, (T.MapType, T.ArrayType, T.StructType))


def write_results(df: DataFrame, path: str, flag: tuple[str, str, object] | None = None) -> str:
    """Write a (small) result table as CSV with header; optional selection flag column.

    ``flag=(name, column, value)`` adds ``name = (column == value)``.  Maps, arrays and structs
    are written as JSON text, so that a grid's parameters stay beside its metrics.
    """
    if flag:
        name, column, value = flag
        df = df.withColumn(name, F.col(f"`{column}`").eqNullSafe(F.lit(value)))
    flat = df.select(*[(F.to_json(F.col(f"`{f.name}`")) if _nested(f.dataType) else F.col(f"`{f.name}`")).alias(f.name) for f in df.schema.fields])
    flat.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
    return path


def read_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read a result CSV back with an explicit schema (S11); columns of a nested type come from their JSON text."""
    wanted = T.StructType.fromDDL(schema)
    text = T.StructType([T.StructField(f.name, T.StringType() if _nested(f.dataType) else f.dataType) for f in wanted.fields])
    found = spark.read.option("header", "true").option("escape", '"').schema(text).csv(path)
    return found.select(*[(F.from_json(F.col(f"`{f.name}`"), f.dataType) if _nested(f.dataType) else F.col(f"`{f.name}`")).alias(f.name)
                          for f in wanted.fields])


def chosen_parameters(spark: SparkSession, path: str, schema: str, flag: str = "selected") -> dict[str, float]:
    """The parameters of the configuration that a stored grid marks as chosen."""
    found = read_results(spark, path, schema).filter(F.col(f"`{flag}`")).limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{path} marks {'no' if not found else 'more than one'} configuration as {flag}")
    return dict(found[0]["params"])


def save_model(model: PipelineModel, path: str) -> str:
    """Persist a fitted pipeline, overwriting."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """Load a fitted pipeline saved by ``save_model``."""
    return PipelineModel.load(path)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    return d or spark.conf.get("spark.checkpoint.dir", None)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the cluster's ``spark.checkpoint.dir`` (survives executor loss).

    Never a local checkpoint; if no shared folder is configured the frame is
    returned unchanged (lineage kept, recomputable).
    """
    spark = df.sparkSession
    d = checkpoint_dir(spark)
    if not d:
        return df
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return df.checkpoint(eager=True)
