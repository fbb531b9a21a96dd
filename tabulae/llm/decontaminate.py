"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items.

Normalising a text lower-cases A-Z and takes the runs of ASCII letters and digits and of
non-ASCII characters as words.  The windows of all items (13 words, or the whole item if it
has fewer) become the patterns of one automaton whose letters are words of the benchmark;
every other word is one and the same foreign letter.  A text is read once; matched word
ranges are then mapped back to code point offsets of the original text.

A benchmark up to ``block_bytes`` of text makes one automaton.  A larger one is cut into
blocks of whole items, each with its automaton, and the matched ranges are united: the
result is the same, and neither driver nor worker holds more than one block at a time.
"""
from __future__ import annotations

import re
import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulae.llm.common import WORD_BYTES, blobs, blocks_of, built, free_name, ship, structs, utf8, written

WINDOW = 13
#: A document is contaminated if at least one word in this many is hit.
ONE_IN = 20
BLOCK_BYTES = 8 << 20
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_RANGE = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_HIT = {"n_words": pa.int64(), "n_hit": pa.int64(), "ranges": pa.list_(_RANGE), "items": pa.list_(pa.string()),
        "spans": pa.list_(_RANGE)}


class Matcher:
    """The automaton of one block of items, with the vocabulary that makes its letters."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        windows: dict[tuple[int, ...], set[str | None]] = {}
        self.letters: dict[bytes, int] = {}
        for item, text in items:
            letters = [self.letters.setdefault(w, len(self.letters) + 1) for w in text.translate(WORD_BYTES).split()]
            size = min(window, len(letters))
            for i in range(len(letters) - size + 1 if size else 0):
                windows.setdefault(tuple(letters[i:i + size]), set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for w, who in windows.items():
            self.automaton.add_word(w, (len(w), tuple(x for x in who if x is not None)))
        self.automaton.make_automaton()
        self.empty = not windows

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, disjoint ranges of hit words (end excluded), items that occur."""
        words = text.translate(WORD_BYTES).split()
        ranges: list[tuple[int, int]] = []
        items: set[str] = set()
        if words and not self.empty:
            get = self.letters.get
            for end, (size, who) in self.automaton.iter(tuple([get(w, 0) for w in words])):
                items.update(who)
                push(ranges, end + 1 - size, end + 1)
        return len(words), ranges, items


def push(ranges: list[tuple[int, int]], start: int, end: int) -> None:
    """Add a range that ends last to disjoint ranges in order."""
    while ranges and ranges[-1][1] >= start:
        start = min(start, ranges.pop()[0])
    ranges.append((start, end))


def united(parts: list[list[tuple[int, int]]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted((r for p in parts for r in p), key=lambda r: r[1]):
        push(out, start, end)
    return out


def spans(text: bytes, ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Word ranges as code point offsets of the original text."""
    if not ranges:
        return []
    at = [m.span() for m in _WORD.finditer(text)]
    out, byte, point = [], 0, 0
    for start, end in ranges:
        pair = []
        for to in (at[start][0], at[end - 1][1]):
            point += len(text[byte:to].decode("utf-8", "replace"))
            byte = to
            pair.append(point)
        out.append({"start": pair[0], "end": pair[1]})
    return out


def add_hits(docs: DataFrame, benchmark: DataFrame, name: str, text_col: str = "text", item_col: str = "item_id",
             item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a struct column ``name`` of what the automaton found: n_words, n_hit, ranges, items, spans."""
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(F.col(f"`{item_col}`").cast("string"), utf8(item_text_col).alias("t"))
    size = F.coalesce(F.octet_length("t"), F.lit(0)) + 16
    out, before = docs, F.lit(None).cast("struct<ranges array<struct<start int, end int>>, items array<string>>")
    for rows in blocks_of(items, size, block_bytes):
        if out is not docs:  # a benchmark of several blocks: one pass of the documents each
            out = written(out)
            before = F.struct(F.col(name).ranges.alias("ranges"), F.col(name)["items"].alias("items"))
        block = spark.sparkContext.broadcast([(i, bytes(t)) for i, t in rows if t])
        out = out.withColumn(name, _scan(block, window)(utf8(text_col), before))
    return out


def contaminated(hit: Column) -> Column:
    return (hit.n_hit > 0) & (ONE_IN * hit.n_hit >= hit.n_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, ``n_hit``, ``items`` (ids as strings, sorted),
    ``spans`` (code point ranges of the original text, end excluded) and ``contaminated``.

    Null and empty texts have no words and are never contaminated.  A benchmark item without
    text has no window; one with a null id marks words but is listed nowhere; repeated items
    and repeated documents count as they stand.  An empty benchmark hits nothing.  Other
    columns of either table are not read, whatever their names.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    hit = F.col("hit")
    return add_hits(rows, benchmark, "hit", **options).select(
        F.col("id").alias(id_col), hit.n_words.alias("n_words"), hit.n_hit.alias("n_hit"), hit["items"].alias("items"),
        hit.spans.alias("spans"), contaminated(hit).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns."""
    name = free_name(docs, "hit")
    return (add_hits(docs, benchmark, name, text_col, **options)
            .filter(~contaminated(F.col(name))).select(*[F.col(f"`{c}`") for c in docs.columns]))


def _scan(block, window: int):
    def matcher(items):
        return Matcher(items, window)

    @F.arrow_udf("struct<n_words long, n_hit long, ranges array<struct<start int, end int>>, items array<string>, "
                 "spans array<struct<start int, end int>>>")
    def scan(text: pa.Array, before: pa.Array) -> pa.Array:
        m = built(block, matcher)
        out: dict[str, list] = {k: [] for k in _HIT}
        for blob, old in zip(blobs(text), before.to_pylist()):
            n, ranges, items = m.scan(blob)
            if old:
                ranges = united([ranges, [(r["start"], r["end"]) for r in old["ranges"]]])
                items.update(old["items"])
            out["n_words"].append(n)
            out["n_hit"].append(sum(b - a for a, b in ranges))
            out["ranges"].append([{"start": a, "end": b} for a, b in ranges])
            out["items"].append(sorted(items))
            out["spans"].append(spans(blob, ranges))
        return structs(_HIT, out)

    return scan.asNondeterministic()  # one call per row: a filter on the result is not run beside it
