"""Helpers shared by the training-data operators: shipping the package to the workers,
tables cut from their lineage, and Arrow columns of UTF-8 bytes."""
from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lower-cases A-Z and turns every ASCII character that is no letter or digit into a space;
#: bytes from 0x80 up (parts of non-ASCII characters in UTF-8) stay as they are.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                   for b in range(256))
#: Lower-cases A-Z and turns the ASCII white space 0x09-0x0D and 0x20 into spaces.
SPACED_BYTES = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


#: Bytes of an Arrow batch, where the session has left Spark's default: a worker holds a batch of texts several times
#: over (bytes, strings, results).
BATCH_BYTES = 6 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their Python workers can import it,
    and keep batches of texts small unless the session sets their size itself."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") in ("64MB", "64m", f"{64 << 20}b", f"{64 << 20}"):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    sc = spark.sparkContext
    if getattr(sc, "_tabulae_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if not os.path.isdir(os.path.join(top, "tabulae")):  # the package already runs from a shipped archive
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="run-"), "tabulae_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "tabulae")):
            for n in sorted(names):
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), top))
    sc.addPyFile(archive)
    sc._tabulae_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the shared one that the session names in ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) gets a folder of its own; a cluster
    without it is an error, as a machine-local folder would lose data there.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/tabulae-{uuid.uuid4().hex}"


def written(df: DataFrame, compression: str | None = None, level: int | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends there, lost executors cost nothing.

    ``level`` is Zstandard's, where that is the compression.
    """
    path = shared_folder(df.sparkSession)
    out = df.write if level is None else df.write.option("parquet.compression.codec.zstd.level", level)
    out.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table made by ``written`` that nothing reads any more."""
    spark = df.sparkSession
    for f in df.inputFiles()[:1]:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f.rsplit("/", 1)[0])
        if "/tabulae-" in f:
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def utf8(name: str) -> Column:
    """A text column as its UTF-8 bytes: workers get them undecoded."""
    return F.col(f"`{name}`").cast("binary")


def blobs(column: pa.Array) -> list[bytes]:
    """The values of a binary Arrow column; null becomes the empty text."""
    return [b or b"" for b in column.to_pylist()]


def structs(fields: dict[str, pa.DataType], columns: dict[str, list]) -> pa.Array:
    """One Arrow struct column from lists by field name."""
    return pa.StructArray.from_arrays([pa.array(columns[k], t) for k, t in fields.items()], names=list(fields))


_BUILT: dict[tuple[str, int], tuple[object, object]] = {}


def built(block, make):
    """``make`` of a broadcast's value, once per worker process.

    The worker serves one operator after the other: only the latest is kept.
    """
    value = block.value
    key = (make.__qualname__, id(value))
    if key not in _BUILT:
        _BUILT.clear()
        released()
        _BUILT[key] = (value, make(value))  # holding the value keeps its id from being used again
    return _BUILT[key][1]


def released() -> None:
    """Give memory that an earlier operator used in this worker back to the system, where the platform can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def blocks_of(rows: DataFrame, size: Column, limit: int):
    """The rows of a reference table in lists of at most ``limit`` bytes (one row at least), one list at a time.

    A table whose summed size is within the limit is one block.
    """
    total = rows.agg(F.sum(size)).first()[0] or 0
    if total <= limit:
        yield rows.collect()
        return
    block, used = [], 0
    for *values, n in rows.withColumn("__size", size).toLocalIterator():
        if block and used + (n or 0) > limit:
            yield block
            block, used = [], 0
        block.append(tuple(values))
        used += n or 0
    yield block


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
