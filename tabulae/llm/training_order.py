"""Token sequences written in training order.

Documents are tokenised, each followed by an end mark, and laid end to end; every ``length``
tokens are a sequence.  A keyed Feistel network over the smallest even number of bits that
holds all sequence numbers, applied again while its result is no sequence number (cycle
walking), is a permutation of the numbers: it gives each sequence its slot, without a sort
key to shuffle by and with an inverse.  Slots are cut into ranges; each range partition writes
one shard of fixed-stride records, so that slot ``s`` of a shard is read at ``s * stride``.

Every text is tokenised once: the first pass writes the ids of each input partition in blocks, with
the place of each block in its partition; the sums per partition (one number each) give the blocks
their first sequence numbers.  The second pass reads the written blocks, in any layout.
Documents are laid end to end as the input's partitions hold them: the layout counts, and the
same rows in other partitions give other sequences (a caller who wants one order whatever the
layout sorts the documents first).

A record is the slot (8 bytes), the tokens (2 bytes each, all little endian; 65535 after the
end of the last sequence) and the mark ``SEQ`` and a line feed, which is the line separator
of the text sink that writes the shards with Spark's commit protocol to any file system.
"""
from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulae.llm.common import built, discard, shared_folder, ship, written
from tabulae.llm.near_dup import mixed

LENGTH = 1024
#: Sequences of a shard: at least, at most, and the number of shards aimed at in between.
LEAST_PER_SHARD, MOST_PER_SHARD, SHARDS = 4096, 65536, 256
END, PAD = 50256, 65535
#: Tokens of a written block, about.
BLOCK = 1 << 18
#: Zstandard's level for ids that are written or shuffled: 6 takes 5 % less than the lower defaults, level 9 hardly less again.
LEVEL = 6
MARK = "SEQ\n"
MAX_VOCABULARY = 64 << 20
ROUNDS = 6


def feistel(numbers: np.ndarray, count: int, key: int, inverse: bool = False) -> np.ndarray:
    """A permutation of 0 to ``count`` - 1 that the key picks, or its inverse."""
    half = max(1, (max(1, count - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mixed(np.arange(ROUNDS, dtype=np.uint64) + np.uint64(key & (1 << 64) - 1))
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & mask
        for k in (keys[::-1] if inverse else keys):
            if inverse:
                left, right = right ^ (mixed(left ^ k) & mask), left
            else:
                left, right = right, left ^ (mixed(right ^ k) & mask)
        out[todo] = left << shift | right
        todo = todo[out[todo] >= np.uint64(count)]
    return out.astype(np.int64)


def tokenizer(content: bytes):
    """The byte-level tokenizer of a rank file."""
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _tokens(block, texts: pa.Array) -> Iterator[list[int]]:
    encode = built(block, tokenizer).encode_ordinary
    for text in texts.to_pylist():
        yield encode(text) if text else []


def _blocks(block):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The tokens of a partition in blocks: (part, at, n, tokens)."""
        part, at, waiting, held = TaskContext.get().partitionId(), 0, [], 0

        def cut() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([at], pa.int64()), pa.array([held], pa.int64()),
                                               pa.array([b"".join(waiting)], pa.binary())], names=["part", "at", "n", "tokens"])

        for batch in batches:
            for tokens in _tokens(block, batch.column(0)):
                tokens.append(END)
                waiting.append(np.array(tokens, dtype="<u2").tobytes())
                held += len(tokens)
                if held >= BLOCK:
                    yield cut()
                    at, waiting, held = at + held, [], 0
        if held:
            yield cut()

    return blocks


def _pieces(starts, count: int, per_shard: int, length: int, key: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sequences, whole but for the first and the last of a block: (shard, slot, at, n, compressed tokens)."""
        pack = pa.Codec("zstd", compression_level=LEVEL).compress
        for batch in batches:
            for part, at, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                start, n = starts.value[part] + at, len(tokens) // 2
                bounds = [0, *range(-start % length or length, n, length), n]
                where = start + np.array(bounds[:-1], dtype=np.int64)
                slots = feistel(where // length, count, key)
                rows = [pack(tokens[2 * a:2 * b], asbytes=True) for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots // per_shard, pa.int32()), pa.array(slots, pa.int64()), pa.array(where % length, pa.int32()),
                     pa.array(np.diff(bounds), pa.int32()), pa.array(rows, pa.binary())], names=["shard", "slot", "at", "n", "tokens"])

    return pieces


def _records(length: int):
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole records of slots, whose pieces come in order."""
        now: tuple[int, int] | None = None
        parts: list[bytes] = []
        unpack = pa.Codec("zstd").decompress

        def record() -> bytes:
            body = b"".join(parts)
            return np.int64(now[1]).astype("<i8").tobytes() + body + np.full(length - len(body) // 2, PAD, dtype="<u2").tobytes()

        for batch in batches:
            out: list[tuple[int, int, bytes]] = []
            for shard, slot, n, tokens in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if now != (shard, slot):
                    if now:
                        out.append((*now, record()))
                    now, parts = (shard, slot), []
                parts.append(unpack(tokens, 2 * n, asbytes=True))
            yield _batch(out)
        yield _batch([(*now, record())] if now else [])

    def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.binary()))],
                                          names=["shard", "slot", "record"])

    return records


def materialise(docs: DataFrame, path: str, vocabulary: str, text_col: str = "text", length: int = LENGTH, key: int = 1,
                per_shard: int | None = None) -> dict[str, int]:
    """Write the token sequences of ``docs`` as shards below ``path``; returns what ``read`` needs.

    A null or empty text is its end mark alone.  An empty table writes no shard.  Repeated rows
    are written as often as they stand; columns besides the text are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    if os.path.getsize(vocabulary) > MAX_VOCABULARY:
        raise ValueError(f"{vocabulary} has more than {MAX_VOCABULARY} bytes")
    with open(vocabulary, "rb") as f:
        block = spark.sparkContext.broadcast(f.read())
    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    ids = written(texts.mapInArrow(_blocks(block), "part int, at long, n long, tokens binary"), "zstd", LEVEL)
    starts, total = {}, 0
    for part, n in sorted(tuple(r) for r in ids.groupBy("part").agg(F.sum("n")).collect()):
        starts[part] = total
        total += n
    count = -(-total // length)
    per_shard = per_shard or min(MOST_PER_SHARD, max(LEAST_PER_SHARD, 1 << (max(1, count // SHARDS) - 1).bit_length()))
    layout = {"sequences": count, "per_shard": per_shard, "length": length, "key": key, "stride": 8 + 2 * length + len(MARK)}
    if count:
        pieces = ids.select("part", "at", "tokens").mapInArrow(
            _pieces(spark.sparkContext.broadcast(starts), count, per_shard, length, key), "shard int, slot long, at int, n int, tokens binary")
        shards = -(-count // per_shard)
        (pieces.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "slot", "at")
         .mapInArrow(_records(length), "shard int, slot long, record binary").sortWithinPartitions("shard", "slot")
         .select("shard", F.col("record").cast("string").alias("value"))
         .write.partitionBy("shard").option("lineSep", MARK).text(path))
    discard(ids)
    return layout


def _parsed(layout: dict[str, int], first: int, stop: int):
    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stride, length, per_shard = layout["stride"], layout["length"], layout["per_shard"]
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                low = shard * per_shard
                view = memoryview(content)[max(0, first - low) * stride:max(0, stop - low) * stride]
                raw = np.frombuffer(view, dtype=np.uint8).reshape(-1, stride)
                slots = raw[:, :8].copy().view("<i8")[:, 0]
                if (slots != max(first, low) + np.arange(len(raw))).any() or (raw[:, -len(MARK):] != list(MARK.encode())).any():
                    raise ValueError(f"shard {shard} is no whole shard of this layout")
                tokens = raw[:, 8:8 + 2 * length].copy().view("<u2")
                for at in range(0, len(raw), 1024):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(slots[at:at + 1024]), shard), pa.int32()), pa.array(slots[at:at + 1024], pa.int64()),
                         pa.array((slots[at:at + 1024] - low) * stride, pa.int64()),
                         pa.array(feistel(slots[at:at + 1024], layout["sequences"], layout["key"], inverse=True), pa.int64()),
                         pa.array([int((t != PAD).sum()) for t in tokens[at:at + 1024]], pa.int32()),
                         pa.array([t.tobytes() for t in tokens[at:at + 1024]], pa.binary())],
                        names=["shard", "slot", "byte_offset", "sequence", "n_tokens", "tokens"])

    return parsed


def read(spark: SparkSession, path: str, layout: dict[str, int], first: int = 0, stop: int | None = None) -> DataFrame:
    """Rows (shard, slot, byte_offset, sequence, n_tokens, tokens) of the slots from ``first`` up to ``stop``, in any
    order; only the shards that hold them are opened.  This is how a training run resumes at a slot."""
    stop = layout["sequences"] if stop is None else min(stop, layout["sequences"])
    schema = "shard int, slot long, byte_offset long, sequence long, n_tokens int, tokens binary"
    if stop <= first:
        return spark.createDataFrame([], schema)
    per = layout["per_shard"]
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
             .filter((F.col("shard") >= first // per) & (F.col("shard") <= (stop - 1) // per)))
    return files.select(F.col("shard").cast("int"), "content").mapInArrow(_parsed(layout, first, stop), schema)


def ordered_digest(docs: DataFrame, vocabulary: str, text_col: str = "text", length: int = LENGTH, key: int = 1) -> DataFrame:
    """Write the shards to a folder that all machines share and read them back: one row per slot with its shard,
    place, sequence number, number of tokens and the CRC-32 of its tokens' bytes.

    Nulls, empty and repeated texts are as in ``materialise``; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    path = shared_folder(spark)
    layout = materialise(docs, path, vocabulary, text_col, length, key)
    return read(spark, path, layout).select("slot", "shard", "byte_offset", "sequence", "n_tokens", F.crc32("tokens").alias("tokens_crc32"))
