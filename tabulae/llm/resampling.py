"""Importance resampling towards a target distribution over hashed word runs.

A text's features are its runs of one to ``LONGEST`` words, repeats counted; a feature's bucket is
the CRC-32 of its bytes modulo ``BUCKETS``.  Two counting passes (one array per task, summed by
bucket) tell how often each bucket occurs in all documents and in the target.  An array of the
smoothed log ratios (``gains``, ``BUCKETS`` whole numbers, broadcast) then scores every document:
its weight is the sum over its features.  Weight plus Gumbel noise from a hash of the id orders
the documents so that the first n are a draw without replacement in proportion to exp(weight);
``radix.ranked`` gives the ranks.

A run's CRC goes on from that of the run without its last word, so no run is ever built.  Texts
are split ``BLOCK_WORDS`` words at a time.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulae.llm.common import WORD_BYTES, blobs, ship, utf8, written
from tabulae.llm.radix import ranked

BUCKETS, LONGEST = 10_000, 3
#: Documents with fewer words are never drawn; of the others so many per cent are.
LEAST_WORDS, PER_CENT = 20, 5
SEED = 42
BLOCK_WORDS = 1 << 16
#: Features that a task gathers before it counts them.
HELD = 1 << 17


def features(text: bytes, longest: int = LONGEST) -> Iterator[tuple[int, list[int]]]:
    """(words in a run, CRC-32 of every such run), block of words by block."""
    rest, before = text.translate(WORD_BYTES), []
    while rest:
        words = rest.split(None, BLOCK_WORDS)
        rest = words.pop() if len(words) > BLOCK_WORDS else b""
        words = before + words
        crcs = list(map(crc32, words))
        yield 1, crcs[len(before):]
        follows = list(map(b" ".__add__, words))
        for size in range(2, longest + 1):
            crcs = list(map(crc32, follows[size - 1:], crcs))
            yield size, crcs[max(0, len(before) - size + 1):]
        before = words[len(words) - min(len(words), longest - 1):]


def _buckets(crcs: list[int], buckets: int) -> np.ndarray:
    return (np.array(crcs, dtype=np.uint32) % np.uint32(buckets)).astype(np.int64)


def _counted(buckets: int, longest: int):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(bucket, n) of one task's texts."""
        total, held = np.zeros(buckets, dtype=np.int64), []
        for batch in batches:
            for blob in blobs(batch.column(0)):
                for _, crcs in features(blob, longest):
                    held += crcs
                if len(held) >= HELD:
                    total += np.bincount(_buckets(held, buckets), minlength=buckets)
                    held.clear()
        total += np.bincount(_buckets(held, buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    return counted


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How often each bucket occurs in all texts; the driver gets one row per bucket."""
    ship(texts.sparkSession)
    found = texts.select(utf8(text_col)).mapInArrow(_counted(buckets, longest), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in found.collect():
        out[bucket] = n
    return out


def gains(all_counts: np.ndarray, target_counts: np.ndarray) -> np.ndarray:
    """1000 times the natural logarithm of how much likelier a bucket is in the target, smoothed by one, rounded down."""
    size, everything, target = len(all_counts), float(all_counts.sum()), float(target_counts.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (everything + size) / ((s + 1.0) * (target + size))))
                     for s, t in zip(all_counts.tolist(), target_counts.tolist())], dtype=np.int64)


def _scored(block, longest: int):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = block.value
        for batch in batches:
            rows = []
            for blob in blobs(batch.column(1)):
                words = n = weight = 0
                for size, crcs in features(blob, longest):
                    n += len(crcs)
                    words += len(crcs) if size == 1 else 0
                    weight += int(gain[_buckets(crcs, len(gain))].sum())
                rows.append((words, n, weight))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]],
                                             names=["id", "n_words", "n_features", "weight"])

    return scored


def noise(row_id: Column, seed: int = SEED) -> Column:
    """1000 times a Gumbel number that seed and id decide, rounded down; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def _id_fields(least: int, most: int) -> list[tuple[Column, int]]:
    """Ids as key fields in ascending order; rows without an id come last."""
    name = F.col("id")
    if most - least < 1 << 61:
        return [(F.coalesce(name - F.lit(least), F.lit(most - least + 1)), (most - least + 1).bit_length())]
    return [(F.coalesce(F.shiftright(name, 32) + F.lit(1 << 31), F.lit(1 << 32)), 33),
            (F.coalesce(name.bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(0)), 32)]


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             per_cent: int = PER_CENT, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS,
             longest: int = LONGEST) -> DataFrame:
    """One row per row of ``docs``: the id (a whole number), ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    Of the N rows with at least ``least_words`` words the floor(per_cent * N / 100) with the highest
    scores are drawn and have ranks 1, 2, 3, ..., ties by smaller id, rows without an id after all
    ids of their score; all others have a null rank.  Null and empty texts have no features and
    weight 0.  Repeated rows count, score and rank as often as they stand.  An empty target only
    smooths; an empty table gives an empty one.  Other columns of either table are not read.
    """
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, target_text_col, buckets, longest))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), utf8(text_col).alias("text"))
    scored = texts.mapInArrow(_scored(spark.sparkContext.broadcast(gain), longest), "id long, n_words long, n_features long, weight long")
    scored = written(scored.withColumn("score", F.col("weight") + noise(F.col("id"), seed)))
    may = F.col("n_words") >= least_words
    n, low, high, least, most = scored.filter(may).agg(F.count("*"), F.min("score"), F.max("score"), F.min("id"), F.max("id")).first()
    out = scored.filter(~may).withColumn("rank", F.lit(None).cast("long"))
    if n:
        keys = [(F.lit(high) - F.col("score"), (high - low).bit_length()), *_id_fields(least or 0, most or 0)]
        keyed = scored.filter(may).select("*", *[c.alias(f"key_{i}") for i, (c, _) in enumerate(keys)])
        placed = ranked(keyed, [(f"key_{i}", bits) for i, (_, bits) in enumerate(keys)])
        drawn = placed.withColumn("rank", F.when(F.col("rank") <= per_cent * n // 100, F.col("rank")))
        out = drawn.select(*out.columns).union(out)
    return out.withColumnRenamed("id", id_col)


def drawn(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id is drawn, with their columns (all rows of a repeated id; none without an id)."""
    ids = resample(docs, target, id_col, **options).filter("rank IS NOT NULL").select(F.col(f"`{id_col}`").alias("__drawn")).distinct()
    return docs.join(ids, docs[f"`{id_col}`"] == F.col("__drawn"), "left_semi")
