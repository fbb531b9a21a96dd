"""Near-duplicate groups of documents by word shingles, SuperMinHash and exact verification.

Signature (SuperMinHash): every shingle deals its random numbers over the signature's places
by a permutation of its own, step by step; place ``p`` keeps the least ``step + number``.  All
shingles of a batch of texts take the same step together, and a text stops as soon as the
largest value it holds is below the next step, which no later number could undercut.

Texts with equal word sequences are one class with its smallest id as its node.  Classes whose
signatures agree on a band share a bucket.  The head of a bucket is its most central member:
the one with the fewest shingles that no other class in any bucket has.  All members are
compared with the head on their full shingle sets.  Where a bucket of three or more then still
spans several components, the pairs across components follow, those first ruled out that
cannot be similar enough: by the sizes, by the shingles that a text has alone, and by bitmaps
of the sets, whose bits differ in no more places than the sets do.  These bounds are exact.
Buckets have no cap, and a large group of copies costs about one pair per member.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulae.llm.common import SPACED_BYTES, blobs, discard, free_name, released, ship, utf8, written
from tabulae.llm.components import components

#: Unless a caller says otherwise.
WORDS, PERCENT = 5, 80
#: A pair at a similarity of 0.8 shares no bucket with a probability of (1 - 0.8 ** ROWS) ** BANDS = 3e-6.
BANDS, ROWS = 32, 5
#: Bits of the bitmap that bounds the difference of two sets.
BITS = 2048
#: Shingles that one vectorised step takes together, and words whose hashes a worker keeps.
STEP, CACHED_WORDS = 150_000, 200_000
#: Rows without an id get one from here on, by their text.
NO_ID = 1 << 62
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function (SplitMix)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Texts to sets of hashed shingles."""

    def __init__(self, words: int):
        self.size = words
        self.odd = _ODD[:words] if words <= len(_ODD) else mixed(np.arange(words, dtype=np.uint64)) | np.uint64(1)
        self.hashes: dict[bytes, int] = {}

    def _hash(self, word: bytes) -> int:
        if len(self.hashes) >= CACHED_WORDS:
            self.hashes.clear()
        h = self.hashes[word] = xxhash.xxh3_64_intdigest(word) or 1
        return h

    def words(self, text: bytes) -> list[bytes]:
        return text.translate(SPACED_BYTES).split()

    def set_of(self, words: list[bytes]) -> np.ndarray:
        """Sorted distinct shingle hashes; with fewer words than a shingle has, one for the whole sequence."""
        if not words:
            return np.empty(0, dtype=np.uint64)
        get, make = self.hashes.get, self._hash
        h = np.array([get(w) or make(w) for w in words], dtype=np.uint64)
        size = min(self.size, len(h))
        last = len(h) - size + 1
        total = np.full(last, size, dtype=np.uint64)
        for i in range(size):
            total += h[i:i + last] * self.odd[i]
            total ^= total >> np.uint64(29)
        return np.unique(mixed(total))


def signatures(sets: list[np.ndarray], places: int) -> np.ndarray:
    """SuperMinHash signatures, one row per set; an empty set's row stays at the largest value."""
    n = len(sets)
    least = np.full(n * places, np.iinfo(np.uint64).max, dtype=np.uint64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    element = np.concatenate(sets) if n else np.empty(0, dtype=np.uint64)
    order: np.ndarray | None = None  # permutations so far, one row per element; from the second step on
    for step in range(places):
        if not len(element):
            break
        x = mixed(element ^ mixed(np.uint64([step * 2 + 1])))
        at = step + ((x & np.uint64(0xFFFFFFFF)) * np.uint64(places - step) >> np.uint64(32)).astype(np.int64)
        if step == 0:
            place = first = at
        elif step == 1:  # after the first swap, place 0 stands where the first number went
            place = np.where(at == first, 0, at)
        else:
            rows = np.arange(len(element))
            if order is None:
                order = np.tile(np.arange(places, dtype=np.min_scalar_type(places)), (len(element), 1))
                for k, then in enumerate((first, second)):
                    order[rows, k], order[rows, then] = order[rows, then], order[rows, k].copy()
            order[rows, step], order[rows, at] = order[rows, at], order[rows, step].copy()
            place = order[:, step].astype(np.int64)
        second = at
        np.minimum.at(least, owner * places + place, np.uint64(step << 32) | (x >> np.uint64(32)))
        # a text whose every place holds less than the next step's least number is finished
        open_ = least.reshape(n, places).max(axis=1) >= np.uint64((step + 1) << 32)
        go = open_[owner]
        if not go.all():
            element, owner, first, second = element[go], owner[go], first[go], second[go]
            order = order[go] if order is not None else None
    return least.reshape(n, places)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One signed 64-bit key per band and signature row."""
    key = np.tile(mixed(np.arange(bands, dtype=np.uint64)), (len(signature), 1))
    parts = signature.reshape(len(signature), bands, rows)
    for r in range(rows):
        key = mixed(key ^ parts[:, :, r])
    return key.view(np.int64)


def bitmap(found: np.ndarray) -> np.ndarray:
    """Parities of the numbers of shingles per cell, as signed 64-bit words: each shingle that only one of two sets
    has turns one bit."""
    parity = np.bincount((found >> np.uint64(17) & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def _sign(words: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), blobs(batch.column(1))
            start, total, sets, digests = 0, 0, [], []
            for i, text in enumerate(texts):
                w = shingler.words(text)
                sets.append(s := shingler.set_of(w))
                digests.append(xxhash.xxh3_128_digest(b" ".join(w)))
                total += len(s)
                if total >= STEP or i + 1 == len(texts):
                    keys = band_keys(signatures(sets, bands * rows), bands, rows)
                    flat = pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * bands, keys.reshape(-1))
                    bits = np.concatenate([bitmap(x) for x in sets])
                    bits = pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * (BITS // 64), bits)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[start:i + 1], pa.int64()), pa.array([len(x) for x in sets], pa.int64()),
                         pa.array(digests, pa.binary()), flat, bits], names=["id", "n", "digest", "bands", "bits"])
                    start, total, sets, digests = i + 1, 0, [], []
        released()

    return sign


def _shingles(words: int):
    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per distinct shingle of a text."""
        shingler = Shingler(words)
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), blobs(batch.column(1))):
                found = shingler.set_of(shingler.words(text)).view(np.int64)
                for at in range(0, len(found), STEP):
                    part = found[at:at + STEP]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), node)), pa.array(part)], names=["node", "shingle"])

    return shingles


def _similar(words: int, percent: int):
    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pairs (a, b) whose full sets are similar enough; a's set serves all rows in a row with the same a."""
        shingler, last, mine = Shingler(words), None, None
        for batch in batches:
            out: list[tuple[int, int]] = []
            for a, b, left, right in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                         blobs(batch.column(2)), blobs(batch.column(3))):
                if a != last:
                    last, mine = a, shingler.set_of(shingler.words(left))
                other = shingler.set_of(shingler.words(right))
                both = len(np.intersect1d(mine, other, assume_unique=True))
                if both and 100 * both >= percent * (len(mine) + len(other) - both):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return similar


def row_id(id_col: str, text_col: str) -> Column:
    """The id; for a null one a number above all others, equal for equal texts."""
    made = F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64(F.coalesce(f"`{text_col}`", F.lit(""))), 2)
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), made)


def grouped(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, bands: int, rows: int) -> DataFrame:
    """Rows (id, n, component) of all rows of ``docs``, where an id may be one that ``row_id`` made."""
    ship(docs.sparkSession)
    texts = docs.select(row_id(id_col, text_col).alias("id"), utf8(text_col).alias("text"))
    signed = written(texts.mapInArrow(_sign(words, bands, rows), "id long, n long, digest binary, bands array<long>, bits array<long>"))
    # equal texts: one class, its smallest id the node
    classes = written(signed.filter("n > 0").groupBy("digest").agg(F.min("id").alias("node")))
    nodes = signed.join(classes, "digest").filter("id = node")
    bucketed = nodes.select("node", "n", F.explode("bands").alias("key"))
    shared = bucketed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    members = written(bucketed.join(shared, "key"))
    # shingles that no other member of any bucket has
    among = members.select("node").distinct()
    single = (texts.join(among, texts["id"] == among["node"], "left_semi").mapInArrow(_shingles(words), "node long, shingle long")
              .groupBy("shingle").agg(F.min("node").alias("node"), F.count("*").alias("times")).filter("times = 1")
              .groupBy("node").agg(F.count("*").alias("alone")))
    plain, members = members, written(members.join(single, "node", "left").withColumn("alone", F.coalesce("alone", F.lit(0))))
    discard(plain)
    heads = members.groupBy("key").agg(F.min(F.struct("alone", "node", "n")).alias("head"))
    a, b = members.alias("a"), heads.alias("b")
    pairs = a.join(b, "key").filter("a.node != b.head.node").filter(
        _possible(F.col("a.n"), F.col("a.alone"), F.col("b.head.n"), F.col("b.head.alone"), percent))
    links = _links(pairs.select(F.col("b.head.node").alias("a"), F.col("a.node").alias("b")), texts, words, percent)
    found = components(links)
    # the rest: buckets that still span several components; all but the largest component against all
    label = found.withColumnRenamed("component", "label")
    there = (members.filter("size > 2").filter((F.col("n") - F.col("alone")) * 100 >= F.col("n") * percent)
             .join(label, "node", "left").withColumn("label", F.coalesce("label", "node")))
    main = (there.groupBy("key", "label").agg(F.count("*").alias("rows")).groupBy("key")
            .agg(F.max(F.struct("rows", "label")).alias("most"), F.count("*").alias("labels")).filter("labels > 1"))
    open_ = (there.join(main, "key").join(heads, "key").filter("node != head.node")
             .select("key", "node", "n", "alone", "label", F.col("most.label").alias("main")))
    open_ = written(open_.join(nodes.select("node", "bits"), "node"))
    a, b = open_.filter("label != main").alias("a"), open_.alias("b")
    rest = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.label") != F.col("b.label"))
                  & ((F.col("b.label") == F.col("b.main")) | (F.col("a.node") < F.col("b.node")))
                  & _possible(F.col("a.n"), F.col("a.alone"), F.col("b.n"), F.col("b.alone"), percent)
                  & (_differences(F.col("a.bits"), F.col("b.bits")) * (100 + percent)
                     <= (F.col("a.n") + F.col("b.n")) * (100 - percent)))
    more = _links(rest.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")),
                  texts, words, percent)
    if not more.isEmpty():
        found = components(links.union(more))
    of = classes.join(found, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    return signed.join(of, "digest", "left").select("id", "n", F.coalesce("component", "id").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles`` (size of the distinct set), ``component_id`` (smallest
    id reachable over links, its own included) and ``kept`` (id = component_id).

    Documents are linked if 100 * intersection >= percent * union of their sets.  A null or
    empty text has an empty set and is linked with nothing.  Repeated rows are equal texts and
    so one group; they are all ``kept`` if their id is the group's.  A row without an id takes
    part after all others; its ``component_id`` is null if its group has no id.  Only the id
    and the text are read.
    """
    out = grouped(docs, id_col, text_col, words, percent, bands, rows)
    known = lambda c: F.when(F.col(c) < NO_ID, F.col(c))
    return out.select(known("id").alias(id_col), F.col("n").alias("n_shingles"), known("component").alias("component_id"),
                      (F.col("id") == F.col("component")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
             bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id, and its columns.

    Rows with equal ids and equal texts are one document and leave one row.
    """
    found = grouped(docs, id_col, text_col, words, percent, bands, rows)
    kept = found.filter("id = component").select("id").distinct()
    name, text = free_name(docs, "row"), F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary"))
    marked = docs.withColumn(name, row_id(id_col, text_col))
    here = marked.join(kept, marked[name] == kept["id"], "left_semi")
    digest = free_name(here, "digest")
    return here.withColumn(digest, text).dropDuplicates([name, digest]).drop(name, digest)


def _possible(n: Column, alone: Column, m: Column, lone: Column, percent: int) -> Column:
    """Whether sets of these sizes, with so many shingles that the other set can't have, may be similar enough."""
    both = F.least(n - alone, m - lone)
    return 100 * both >= percent * (n + m - both)


def _differences(a: Column, b: Column) -> Column:
    """Bits that differ: at most the number of shingles that only one of the two sets has."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _links(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    return verified(pairs, texts, _similar(words, percent))


def verified(pairs: DataFrame, texts: DataFrame, check) -> DataFrame:
    """The pairs (a, b) that ``check`` (an Arrow batch function of a, b and both texts) lets through, as a written table.

    ``texts`` (id, text) may have an id more than once.
    """
    pairs = written(pairs.distinct())
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    held = texts.join(wanted, "id", "left_semi")
    both = (pairs.join(held.select(F.col("id").alias("b"), F.col("text").alias("right")), "b")
            .join(held.select(F.col("id").alias("a"), F.col("text").alias("left")), "a")
            .select("a", "b", "left", "right"))
    links = written(both.mapInArrow(check, "a long, b long"))
    discard(pairs)
    return links
