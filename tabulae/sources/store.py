"""Tables of periods in versions, and tables stored by the buckets of a key.

A versioned table is a folder of data folders (``v=<id>/<period>``), which are written once, and of
numbered manifests.  A manifest names, for every period, the data folder that holds it.  Several
periods are written in one job (``stage``); they show when the next manifest takes its name by a
rename that doesn't replace (``publish``).  A reader takes one manifest, so that it sees whole
versions only: data of a job that broke off, or of a commit that came second, is in no manifest.
"""
from __future__ import annotations

import json
import math
import uuid
from typing import Mapping, Sequence
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulae.sources.io import _fs, listing, write_bucketed
from tabulae.sources.shared import shared_folder

#: Rows of a bucket, about.
BUCKET_ROWS = 4_000_000


class Conflict(RuntimeError):
    """Another commit came first."""


def _kinds(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def versions(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the published versions, in order; none for a folder without a table."""
    names = listing(spark, f"{target}/manifests")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, target: str, version: int | None = None) -> dict:
    """One version: ``version``, ``schema``, ``partition`` and, per period, its data folder and the version it came with.

    Version 0 is the table before its first commit.  An unknown version is an error.
    """
    known = versions(spark, target)
    version = (known[-1] if known else 0) if version is None else version
    if version == 0:
        return {"version": 0, "schema": None, "partition": None, "periods": {}}
    if version not in known:
        raise KeyError(f"{target} has no version {version}; known: {known}")
    text = "".join(r.value for r in spark.read.text(f"{target}/manifests/{version}.json", wholetext=True).collect())
    return json.loads(text)


def stage(df: DataFrame, target: str, partition: str = "period") -> dict:
    """Write the rows of all periods in one job; returns what ``publish`` takes.  Nothing shows yet.

    Rows without a period label are an error.  The columns must be those of the table so far.
    """
    spark = df.sparkSession
    base = manifest(spark, target)
    label = F.col(f"`{partition}`").cast("string")
    rows = df.withColumn(partition, F.when(label != "", label).otherwise(F.raise_error(F.lit(f"a row has no {partition}"))))
    if base["version"]:
        before = T.StructType.fromJson(base["schema"])
        if base["partition"] != partition or _kinds(before) != _kinds(rows.schema):
            raise ValueError(f"columns {_kinds(rows.schema)} by {partition} differ from the table's {_kinds(before)} by {base['partition']}")
    folder = f"v={uuid.uuid4().hex}"
    rows.write.partitionBy(partition).parquet(f"{target}/data/{folder}")
    found = [name for name in listing(spark, f"{target}/data/{folder}") if name.startswith(f"{partition}=")]
    return {"base": base["version"], "schema": json.loads(rows.schema.json()), "partition": partition,
            "periods": {unquote(name[len(partition) + 1:]): f"{folder}/{name}" for name in found}}


def publish(spark: SparkSession, target: str, staged: Mapping) -> int:
    """Show staged periods, which replace their former selves, as the next version; returns its number.

    If another commit was published since they were staged, ``Conflict`` is raised and nothing changes.
    """
    version = staged["base"] + 1
    periods = {**manifest(spark, target, staged["base"])["periods"],
               **{label: {"folder": folder, "version": version} for label, folder in staged["periods"].items()}}
    content = {"version": version, "schema": staged["schema"], "partition": staged["partition"], "periods": periods}
    fs, waiting = _fs(spark, f"{target}/manifests/_waiting-{uuid.uuid4().hex}")
    out = fs.create(waiting)
    out.write(bytearray(json.dumps(content, ensure_ascii=False, sort_keys=True).encode()))
    out.close()
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    no_options = sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(waiting), fs.makeQualified(hadoop.Path(f"{target}/manifests/{version}.json")), no_options)
    except Py4JJavaError as e:
        fs.delete(waiting, False)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            raise Conflict(f"version {version} of {target} was published by another commit") from e
        raise
    return version


def commit(df: DataFrame, target: str, partition: str = "period") -> int:
    """Write and show the periods of ``df`` as one version; periods that it doesn't hold stay as they are.

    An empty frame makes a version that changes no period.
    """
    return publish(df.sparkSession, target, stage(df, target, partition))


def read_version(spark: SparkSession, target: str, periods: Sequence[str] | None = None, version: int | None = None) -> DataFrame:
    """The table as of a version (the latest by default), or some of its periods: only their folders are read."""
    found = manifest(spark, target, version)
    if not found["version"]:
        raise FileNotFoundError(f"{target} has no published version")
    wanted = sorted(found["periods"]) if periods is None else list(periods)
    if missing := [p for p in wanted if p not in found["periods"]]:
        raise KeyError(f"version {found['version']} of {target} lacks {missing}; it has {sorted(found['periods'])}")
    schema = T.StructType.fromJson(found["schema"])
    if not wanted:
        return spark.createDataFrame([], schema)
    paths = [f"{target}/data/{found['periods'][p]['folder']}" for p in wanted]
    return (spark.read.schema(T.StructType([*schema.fields, T.StructField("v", T.StringType())])).option("basePath", f"{target}/data")
            .parquet(*paths).select(*[F.col(f"`{c}`") for c in schema.names]))


def unpublished(spark: SparkSession, target: str) -> list[str]:
    """Data folders that no version names: broken off, beaten by another commit, or being written."""
    named = {p["folder"].split("/")[0] for n in versions(spark, target) for p in manifest(spark, target, n)["periods"].values()}
    return [name for name in listing(spark, f"{target}/data") if name not in named]


def bucketed(tables: Mapping[str, DataFrame], key: Sequence[str], buckets: int | None = None) -> dict[str, DataFrame]:
    """The tables stored in as many buckets of one key: they join and group by it without an exchange.

    The number of buckets follows the rows of the largest table.  One shuffle a table, paid once;
    each bucket is one sorted file in the shared folder.
    """
    spark = next(iter(tables.values())).sparkSession
    if buckets is None:
        rows = max(df.count() for df in tables.values())
        buckets = max(spark.sparkContext.defaultParallelism, math.ceil(rows / BUCKET_ROWS))
    out = {}
    for name, df in tables.items():
        stored = f"tabulae_{name}_{uuid.uuid4().hex}"
        write_bucketed(df.repartition(buckets, *[F.col(f"`{k}`") for k in key]), stored, key, buckets, shared_folder(spark))
        out[name] = spark.table(stored)
    return out
