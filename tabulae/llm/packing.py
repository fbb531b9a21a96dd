"""Packing of documents into windows of tokens, each filled with lexical neighbours of its seed.

Documents are tokenised once, each followed by an end mark, and written with their ids.  The
lexical terms of the search are token ids, so all statistics are arrays as long as the vocabulary:
how many documents hold a token (exact, over all documents) and the average length.

The inverted index is sharded.  A document's key is its most telling token as far as the vocabulary
says (tokens that were merged later are rarer, and a repeated one tells more); documents with one key
stand in one shard, shards take the keys in order until they have ``SHARD_TOKENS``, and the documents
of a larger key are dealt over as many shards as it needs.  Every shard is packed by itself: whole windows of long documents first; then the longest
rest that is unused is a seed, the index returns the unused documents in the order of their BM25
scores for the seed's ``QUERY_TOKENS`` most telling tokens, and they fill its window greedily: those
that fit, and the beginning of the best that doesn't.  Where no neighbour is left, the next unused
documents follow.  So every window is full but the last one of each shard.
"""
from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulae.llm.bpe import byte_letters
from tabulae.llm.common import built, ship, written

WINDOW, END = 1024, 0
SHARD_TOKENS = 1 << 20
#: Shards that a task packs one after the other, about.
SHARDS_PER_TASK = 8
#: What a document counts in a shard besides its tokens, so that shards of tiny ones stay small too.
ROW_TOKENS = 64
QUERY_TOKENS = 32
#: The usual BM25 parameters.
K1, B = 1.2, 0.75
MAX_VOCABULARY = 64 << 20


class Encoder:
    """Token ids of texts by a byte-level BPE file; added tokens in a text are tokens, as the tokenizers library has it."""

    def __init__(self, content: str):
        import public_tokenizers
        import regex
        import tiktoken

        spec = json.loads(content)
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in self.added}
        self.encode_plain = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    def encode(self, text: str) -> list[int]:
        if self.cut is None or not any(s in text for s in self.added):
            return self.encode_plain(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += self.encode_plain(text[at:m.start()])
            out.append(self.added[m.group()])
            at = m.end()
        return out + self.encode_plain(text[at:])


def vocabulary(path: str) -> tuple[str, int]:
    """The file's content and the number of its ids, after a check of its size."""
    if os.path.getsize(path) > MAX_VOCABULARY:
        raise ValueError(f"{path} has more than {MAX_VOCABULARY} bytes")
    with open(path, encoding="utf-8") as f:
        content = f.read()
    spec = json.loads(content)
    return content, 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])


def key_of(term: np.ndarray, often: np.ndarray) -> int:
    """The most telling token before anything is known of other documents; 0 for none."""
    return int(term[np.argmax(np.log(term + 2.0) * often / (often + K1))]) if len(term) else 0


def _tokenised(block, kind: str, size: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, n, key, tokens) of each text (id, text); last, in a row of their own, how many texts hold each token."""
        encode, code = built(block, Encoder).encode, np.dtype(kind).char
        names = ["id", "n", "key", "tokens", "holders"]
        holders, id_type = np.zeros(size, dtype=np.int64), None
        for batch in batches:
            id_type = batch.schema.field(0).type
            counts, keys, rows = [], [], []
            for text in batch.column(1).to_pylist():
                ids = array(code, encode(text)) if text else array(code)
                term, often = np.unique(np.frombuffer(ids, dtype=kind), return_counts=True)
                holders[term] += 1
                keys.append(key_of(term, often))
                ids.append(end)
                counts.append(len(ids))
                rows.append(ids.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(keys, pa.int32()), pa.array(rows, pa.binary()),
                                              pa.nulls(len(rows), pa.binary())], names=names)
        if id_type is not None:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, id_type), pa.array([0], pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()),
                                              pa.array([holders.astype("<i8").tobytes()], pa.binary())], names=names)

    return run


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, n) summed over a partition's counts."""
    total = None
    for batch in batches:
        for found in _arrays(batch.column(0), "<i8"):
            total = found if total is None else total + found
    some = np.flatnonzero(total) if total is not None else np.empty(0, dtype=np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some] if len(some) else some)], names=["token", "n"])


class Weights:
    """BM25 weights of a document's tokens under the statistics of all documents."""

    def __init__(self, stats: tuple[np.ndarray, int, float, int]):
        holders, rows, self.mean, self.end = stats
        self.idf = np.log1p((rows - holders + 0.5) / (holders + 0.5)).astype(np.float32)

    def of(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distinct tokens without the end mark, their weights)."""
        term, often = np.unique(tokens[:-1], return_counts=True)
        weight = self.idf[term] * (often * (K1 + 1) / (often + K1 * (1 - B + B * len(tokens) / self.mean)))
        return term, weight.astype(np.float32)


def _arrays(column: pa.Array, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(b, dtype=kind) for b in column.to_pylist()]


def shards_of(sizes: list[tuple[int, int]], most: int) -> list[tuple[int, int, int]]:
    """(key, first shard, number of shards) from (key, size) in order of keys."""
    out, shard, used = [], 0, 0
    for key, size in sizes:
        if used and used + size > most:
            shard, used = shard + 1, 0
        parts = max(1, -(-size // most))
        out.append((key, shard, parts))
        used += size
        if parts > 1:
            shard, used = shard + parts, 0
    return out


def fill(rests: list[int], neighbours, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (document, from, length), from rests that are shorter than a window.

    ``neighbours(seed, unused)`` returns documents in the order in which they should follow.  What
    is cut off a document stays a rest.
    """
    left, start = np.array(rests, dtype=np.int64), np.zeros(len(rests), dtype=np.int64)
    unused = left > 0
    order = np.argsort(-left, kind="stable")
    at = 0

    def take(i: int, gap: int) -> tuple[int, int, int]:
        n = min(int(left[i]), gap)
        piece = (i, int(start[i]), n)
        start[i] += n
        left[i] -= n
        unused[i] = left[i] > 0
        return piece

    while True:
        while at < len(order) and not unused[order[at]]:
            at += 1
        if at == len(order):
            return
        seed = int(order[at])
        pieces = [take(seed, window)]
        gap = window - pieces[0][2]
        if gap:
            found = neighbours(seed, unused)
            sizes, low = left[found], 0
            while gap and len(fits := np.flatnonzero(sizes[low:] <= gap)):
                low += int(fits[0])
                pieces.append(take(int(found[low]), gap))
                gap -= pieces[-1][2]
                low += 1
            if gap and len(longer := found[unused[found]]):  # none of these fits: the best is cut
                pieces.append(take(int(longer[0]), gap))
                gap = 0
        follows = at
        while gap and follows < len(order):  # no neighbour is left
            i = int(order[follows])
            if unused[i]:
                pieces.append(take(i, gap))
                gap -= pieces[-1][2]
            else:
                follows += 1
        yield pieces


class Index:
    """The inverted index of one shard."""

    def __init__(self, docs: list[np.ndarray], weights: Weights, query_tokens: int = QUERY_TOKENS):
        self.n, self.most = len(docs), query_tokens
        found = [weights.of(d) for d in docs]
        self.bounds = np.cumsum([0, *(len(t) for t, _ in found)])
        self.terms = np.concatenate([t for t, _ in found]).astype(np.int64)
        self.weights = np.concatenate([w for _, w in found])
        order = np.argsort(self.terms, kind="stable")
        self.holder = np.repeat(np.arange(self.n), np.diff(self.bounds))[order]
        self.posted = self.weights[order]
        self.at = np.concatenate([[0], np.cumsum(np.bincount(self.terms, minlength=len(weights.idf)))])

    def scores(self, i: int) -> np.ndarray:
        """BM25 scores of all documents for the most telling tokens of document ``i``."""
        low, high = self.bounds[i], self.bounds[i + 1]
        terms, weights = self.terms[low:high], self.weights[low:high]
        if len(terms) > self.most:
            terms = terms[np.argpartition(-weights, self.most)[:self.most]]
        spans = [slice(self.at[t], self.at[t + 1]) for t in terms.tolist()]
        if not spans:
            return np.zeros(self.n)
        return np.bincount(np.concatenate([self.holder[s] for s in spans]), np.concatenate([self.posted[s] for s in spans]), minlength=self.n)

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share a token with the seed's query, by descending score."""
        scores = self.scores(seed)
        some = np.flatnonzero((scores > 0) & unused)
        return some[np.argsort(-scores[some], kind="stable")]


def packed(docs: list[np.ndarray], weights: Weights, window: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of one shard, sequences from 0."""
    sequence = 0
    for i, tokens in enumerate(docs):
        for start in range(0, len(tokens) - window + 1, window):
            yield i, start, window, sequence, 0
            sequence += 1
    done = [len(d) // window * window for d in docs]
    for pieces in fill([len(d) - x for d, x in zip(docs, done)], Index(docs, weights).neighbours, window):
        offset = 0
        for i, start, length in pieces:
            yield i, done[i] + start, length, sequence, offset
            offset += length
        sequence += 1


def _packed(block, kind: str, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (shard, id, tokens) come by shard in order; one shard is held at a time."""
        weights = built(block, Weights)
        shard, ids, docs, id_type = None, [], [], None

        def out() -> Iterator[pa.RecordBatch]:
            pieces = list(packed(docs, weights, window))
            for at in range(0, len(pieces), 4096):
                part = pieces[at:at + 4096]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[p[0]] for p in part], id_type), *[pa.array(v, pa.int64()) for v in (
                        [p[1] for p in part], [p[2] for p in part], [len(docs[p[0]]) for p in part], [shard << 32 | p[3] for p in part], [p[4] for p in part])],
                     pa.array([docs[p[0]][p[1]:p[1] + p[2]].astype("<u4").tobytes() for p in part], pa.binary())],
                    names=["id", "start", "length", "doc_tokens", "sequence_id", "offset", "tokens"])

        for batch in batches:
            id_type = batch.schema.field(1).type
            for s, i, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _arrays(batch.column(2), kind)):
                if s != shard and docs:
                    yield from out()
                    ids, docs = [], []
                shard = s
                ids.append(i)
                docs.append(tokens)
        if docs:
            yield from out()

    return run


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end: int = END,
         shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece of a document: the id, ``start`` and ``length`` in its token ids, ``doc_tokens`` (their number, with
    the end mark), ``sequence_id``, ``offset`` there, and ``tokens`` (the piece's ids, little-endian, 4 bytes each).

    Every token id of every row lies in exactly one piece; a sequence has at most ``window`` ids without a
    gap, and is shorter only as the last one of a shard.  A null or empty text is its end mark.  Rows
    without an id, and repeated rows, are packed as often as they stand.  The result doesn't depend on
    the table's layout, but for rows that are equal.  An empty table gives an empty one.  Other
    columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    content, size = vocabulary(path)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    block = spark.sparkContext.broadcast(content)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    both = written(rows.mapInArrow(_tokenised(block, kind, size, end), f"id {id_type}, n long, key int, tokens binary, holders binary"))
    ids = both.filter("key IS NOT NULL").drop("holders")
    count, total = ids.agg(F.count("*"), F.sum("n")).first()
    holders = np.zeros(size, dtype=np.int64)  # one row per token of the vocabulary comes to the driver, and one per key
    for token, n in both.select("holders").filter("holders IS NOT NULL").mapInArrow(_held, "token int, n long").groupBy("token").agg(F.sum("n")).collect():
        holders[token] = n
    stats = spark.sparkContext.broadcast((holders, count, (total or 0) / max(1, count), end))
    sizes = ids.groupBy("key").agg(F.sum(F.col("n") + ROW_TOKENS)).collect()
    shards = shards_of(sorted(map(tuple, sizes)), shard_tokens)
    count_of = sum(shards[-1][1:]) if shards else 1
    place = F.broadcast(spark.createDataFrame(shards, "key int, first long, parts long"))
    spread = F.xxhash64("id", "tokens")
    dealt = ids.join(place, "key").select((F.col("first") + F.pmod(spread, F.col("parts"))).alias("shard"), spread.alias("spread"), "id", "tokens")
    by_shard = dealt.repartition(-(-count_of // SHARDS_PER_TASK), "shard").sortWithinPartitions("shard", "spread", "id", "tokens").drop("spread")
    schema = f"id {id_type}, start long, length long, doc_tokens long, sequence_id long, offset long, tokens binary"
    return by_shard.mapInArrow(_packed(stats, kind, window), schema).withColumnRenamed("id", id_col)
