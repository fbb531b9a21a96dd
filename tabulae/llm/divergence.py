"""Source divergence audit: how the vocabulary of a source differs from its language's and from other sources'.

Documents fall into groups by language and source.  Every language keeps the terms that occur in
at least ``LEAST_DOCS`` of its documents.  A group or a language gives a kept term the share
p = 1 + floor(SCALE * (count + 1) / (N + V)), and f(p, q) = floor((p - q)**2 / q) tells how far p
is from q.

Pairs of groups: f is summed over all kept terms.  Only terms that a group has are looked at: a
term that neither has adds a constant, one that only one of them has depends on its count alone,
and terms that both have meet in a join by term.

Terms of a group: f grows with the group's count and falls with the language's, and ties go to the
earlier term, so a term that k others dominate (group count no lower, language count no higher,
earlier in UTF-8) isn't among the first k.  Each partition keeps its skyband, the terms that fewer
than k others dominate; skybands are merged in groups of bounded size until a task holds a whole
group's, and the terms that are left are ranked exactly.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulae.llm.common import blobs, discard, ship, written

LEAST_DOCS, SCALE, RANKS = 3, 1_000_000_000, 200
#: Lower-cases A-Z and turns every other ASCII character into a space.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Bytes of text that a task counts together, and of a piece of a text.
HELD, PIECE = 24 << 20, 4 << 20
#: Rows that a task gathers before it reduces them to their groups' skybands, and rows of a group in a merge.
GATHERED, MERGED = 200_000, 100_000
_CHUNK = 256
#: Groups whose totals every task may hold, and pairs of a term's sources that are taken together.
GROUPS, PAIRS = 1024, 1 << 20
GROUP = ["lang", "source"]


def pieces(text: bytes) -> Iterator[bytes]:
    """A text's terms and spaces in pieces of at most ``PIECE`` bytes, but for terms that are longer."""
    text, at = text.translate(TERM_BYTES), 0
    while len(text) - at > PIECE:
        cut = text.rfind(b" ", at, at + PIECE)
        cut = cut if cut >= at else text.find(b" ", at)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys in order, and each one's sum of every value."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], *(np.add.reduceat(v[order], starts) for v in values)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs); each group also has the empty term, which isn't one."""
    groups: dict[tuple[str, str], int] = {}
    texts: list[bytes] = []
    owner: list[int] = []  # the document of each piece
    group: list[int] = []  # the group of each document
    held = 0

    def flushed() -> pa.RecordBatch:
        nonlocal held
        split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
        coded = split.flatten().dictionary_encode()
        names, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        doc = np.repeat(np.array(owner, dtype=np.int64), np.diff(split.offsets.to_numpy()))
        real = np.ones(len(names), dtype=bool) if (empty := names.index("").as_py()) < 0 else np.arange(len(names)) != empty
        doc, codes = doc[real[codes]], codes[real[codes]]
        width = len(names) + 1  # the last code stands for the group itself
        doc = np.concatenate([doc, np.arange(len(group))])
        codes = np.concatenate([codes, np.full(len(group), width - 1)])
        each, n = _summed(doc * width + codes, np.ones(len(doc), dtype=np.int64))
        keys, n, docs = _summed(np.array(group, dtype=np.int64)[each // width] * width + each % width, n, np.ones(len(each), dtype=np.int64))
        which, code = keys // width, keys % width
        of = [pa.array([g[i] for g in groups], pa.string()).take(pa.array(which)) for i in (0, 1)]
        term = pa.concat_arrays([names.cast(pa.string()), pa.array([""])]).take(pa.array(code))
        n[code == width - 1] = 0
        for kept in (groups, texts, owner, group):
            kept.clear()
        held = 0
        return pa.RecordBatch.from_arrays([*of, term, pa.array(n), pa.array(docs)], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), blobs(batch.column(2))):
            for piece in pieces(blob):
                texts.append(piece)
                owner.append(len(group))
            group.append(groups.setdefault((lang, source), len(groups)))
            held += len(blob)
            if held >= HELD:
                yield flushed()
    if group:
        yield flushed()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, summed up within some documents each; the empty term
    stands for the group itself."""
    ship(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(to) for c, to in ((lang_col, "lang"), (source_col, "source"))],
                       F.col(f"`{text_col}`").cast("binary").alias("text"))
    return rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + kept)), exact; null if no term is kept.

    Counts that would take the product out of a long go through decimals.
    """
    parts = total + kept
    wide = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)"), parts.cast("decimal(20,0)")).cast("long")
    return F.when(parts > 0, F.when(count < (1 << 62) // SCALE, F.call_function("div", F.lit(SCALE).cast("long") * (count + 1), parts)).otherwise(wide) + 1)


def distance(p: Column, q: Column) -> Column:
    """floor((p - q) * (p - q) / q); shares are at most SCALE + 1, so that the square fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def skyband(a: np.ndarray, b: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Which points fewer than k others dominate: ``a`` no lower, ``b`` no higher, ``order`` lower.

    ``order`` differs from point to point.  It is enough to count the dominators that were kept or
    stand in the same chunk: a point with k dominators has k in the skyband.
    """
    at = np.lexsort((order, b, -a))
    cell = np.flatnonzero(np.concatenate([[True], (a[at][1:] != a[at][:-1]) | (b[at][1:] != b[at][:-1])]))[:len(at)]
    at = at[np.arange(len(at)) - np.repeat(cell, np.diff(np.append(cell, len(at)))) < k]  # of equal counts the first k
    b, order = np.unique(b[at], return_inverse=True)[1].astype(np.int32), order[at].astype(np.int32)  # fewer than 2**31 points
    kept_b, kept_order = np.empty(0, dtype=b.dtype), np.empty(0, dtype=order.dtype)
    kept = []
    for low in range(0, len(at), _CHUNK):
        cb, co = b[low:low + _CHUNK], order[low:low + _CHUNK]
        count = np.zeros(len(cb), dtype=np.int64)
        open_ = np.arange(len(cb))
        first, step = 0, 2 * k
        while first < len(kept_b) and len(open_):  # most points are dominated by the first ones kept
            kb, ko = kept_b[first:first + step], kept_order[first:first + step]
            count[open_] += np.count_nonzero((kb <= cb[open_, None]) & (ko < co[open_, None]), axis=1)
            open_ = open_[count[open_] < k]
            first, step = first + step, 2 * step
        earlier = np.tri(len(cb), k=-1, dtype=bool)
        count += ((cb <= cb[:, None]) & (co < co[:, None]) & earlier).sum(axis=1)
        stays = np.flatnonzero(count < k)
        kept.append(low + stays)
        kept_b, kept_order = np.concatenate([kept_b, cb[stays]]), np.concatenate([kept_order, co[stays]])
    return at[np.concatenate(kept)] if kept else at


class Bands:
    """Rows (lang, source, term, n, lang_n and more) of a task, of which the skyband of each group stays."""

    def __init__(self, k: int):
        self.k, self.held, self.size, self.bound = k, [], 0, GATHERED

    def add(self, batch: pa.RecordBatch) -> None:
        self.held.append(batch)
        self.size += batch.num_rows
        if self.size >= self.bound:
            self.held = self.reduced()
            self.size = sum(b.num_rows for b in self.held)
            self.bound = max(GATHERED, 2 * self.size)

    def reduced(self) -> list[pa.RecordBatch]:
        if not self.size:
            return []
        rows = pa.Table.from_batches(self.held)
        order = np.empty(rows.num_rows, dtype=np.int64)
        order[pc.sort_indices(rows["term"].combine_chunks().cast(pa.binary())).to_numpy()] = np.arange(rows.num_rows)
        codes = [rows[c].combine_chunks().dictionary_encode().indices.to_numpy() for c in GROUP]
        group = codes[0].astype(np.int64) << 32 | codes[1]
        n, lang_n = rows["n"].to_numpy(), rows["lang_n"].to_numpy()
        at = np.argsort(group, kind="stable")
        ends = np.flatnonzero(np.diff(group[at])) + 1
        kept = [part[skyband(n[part], lang_n[part], order[part], self.k)] for part in np.split(at, ends)]
        return rows.take(pa.array(np.concatenate(kept))).to_batches()


def _banded(k: int):
    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The skyband of each group's rows in this partition."""
        bands = Bands(k)
        for batch in batches:
            bands.add(batch)
        yield from bands.reduced()

    return banded


def merged_skybands(rows: DataFrame, k: int) -> DataFrame:
    """Of rows (lang, source, term, n, lang_n and more) those that fewer than k others of their group dominate, and maybe
    a few more if a group's skyband is larger than a task should merge."""
    return _merged(written(rows.mapInArrow(_banded(k), rows.schema)), k)


def _merged(band: DataFrame, k: int) -> DataFrame:
    """Skybands of parts of the groups, merged until a task has had all that is left of a group."""
    size = own = None
    while True:
        sizes = band.groupBy(*GROUP).count().agg(F.max("count"), F.sum("count")).first()
        parts = math.ceil((sizes[0] or 0) / MERGED)
        if parts == 0 or sizes[1] == size:
            return band
        size = sizes[1]
        after = written(band.repartition(*GROUP, F.pmod(F.xxhash64("term"), F.lit(parts))).mapInArrow(_banded(k), band.schema))
        if own is not None:
            discard(own)
        band = own = after
        if parts == 1:
            return band


def _gathered(least_docs: int):
    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(lang, term, lang_n, sources, ns) of kept terms and of the empty term, from counts in order of term, lang, source.

        The rows of the last term wait for the next batch.
        """
        def changes(table: pa.Table, *names: str) -> np.ndarray:
            out = np.zeros(table.num_rows, dtype=bool)
            out[0] = True
            for c in names:
                column = table[c].combine_chunks()
                out[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            return out

        def out(table: pa.Table, new_term: np.ndarray) -> pa.RecordBatch:
            new = new_term | changes(table, "source")
            rows, terms = np.flatnonzero(new), np.flatnonzero(new_term)
            n, docs = table["n"].to_numpy(), table["docs"].to_numpy()
            keep = (np.add.reduceat(docs, terms) >= least_docs) | pc.equal(table["term"], "").to_numpy()[terms]
            per = np.diff(np.append(np.flatnonzero(new_term[rows]), len(rows)))  # sources of each term
            stays = np.repeat(keep, per)
            offsets = pa.array(np.concatenate([[0], np.cumsum(per[keep])]), pa.int32())
            lang, term = (table[c].combine_chunks().take(pa.array(terms[keep])) for c in ("lang", "term"))
            source = table["source"].combine_chunks().take(pa.array(rows[stays]))
            return pa.RecordBatch.from_arrays(
                [lang, term, pa.array(np.add.reduceat(n, terms)[keep]), pa.ListArray.from_arrays(offsets, source),
                 pa.ListArray.from_arrays(offsets, pa.array(np.add.reduceat(n, rows)[stays]))], names=["lang", "term", "lang_n", "sources", "ns"])

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows:
                new_term = changes(held, "term", "lang")
                last = int(np.flatnonzero(new_term)[-1])
                if last:
                    yield out(held.slice(0, last), new_term[:last])
                    held = held.slice(last)
        if held is not None and held.num_rows:
            yield out(held, changes(held, "term", "lang"))

    return gathered


def kept_terms(counts: DataFrame, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """(groups, kept): every group with its total, its language's total and number of kept terms; and a row per kept term
    (lang, term, lang_n, sources, ns) with its counts in the language and in the sources that have it."""
    ordered = counts.select(*GROUP, "term", "n", "docs").repartition("term", "lang").sortWithinPartitions("term", "lang", "source")
    found = written(ordered.mapInArrow(_gathered(least_docs), "lang string, term string, lang_n long, sources array<string>, ns array<long>"))
    kept = found.filter("term != ''")
    totals = flat(found).groupBy(*GROUP).agg(F.sum("n").alias("total"))  # the empty term counts nothing
    whole = Window.partitionBy("lang")
    groups = (totals.withColumn("lang_total", F.sum("total").over(whole))
              .join(kept.groupBy("lang").agg(F.count("*").alias("kept")), "lang", "left").fillna(0, ["kept"]))
    return written(groups.select(*GROUP, "total", "lang_total", "kept")), kept


def flat(kept: DataFrame) -> DataFrame:
    """One row per term and source."""
    x = F.col("x")
    return (kept.select("lang", "term", "lang_n", F.explode(F.arrays_zip("sources", "ns")).alias("x"))
            .select("lang", x.sources.alias("source"), "term", x.ns.alias("n"), "lang_n"))


def shares(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """The flat ``kept`` with the share of each term in its group, that of a term which the group hasn't, and the language's."""
    zero = F.lit(0).cast("long")
    return flat(kept).join(groups, GROUP).select(*GROUP, "term", "n", "lang_n", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
                                           share(zero, F.col("total"), F.col("kept")).alias("p0"),
                                           share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"))


def _bare(groups: DataFrame) -> DataFrame:
    return groups.select(*GROUP, "kept", share(F.lit(0).cast("long"), F.col("total"), F.col("kept")).alias("p0"))


def _met(left: DataFrame, right: DataFrame, *on: str) -> DataFrame:
    """Rows x and y of different sources of one language."""
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in (*on, "lang")]
    return left.alias("x").join(right.alias("y"), [*same, F.col("x.source") != F.col("y.source")])


def _bare_pairs(groups: DataFrame) -> DataFrame:
    """Every pair's distance as if no kept term occurred in either."""
    bare, c = _bare(groups), F.col
    return _met(bare, bare).select("x.lang", "x.source", c("y.source").alias("item"), F.when(
        c("x.kept") > 0, c("x.kept") * distance(c("x.p0"), c("y.p0"))).otherwise(0).alias("v"))


def pair_values(groups: DataFrame, has: DataFrame) -> DataFrame:
    """(lang, source, item, value): f summed over all kept terms, of every group and each other source of its language.

    All of a pair's shares sum up to little more than SCALE, so that sums of f fit a long (else they fail).
    """
    bare = _bare(groups)
    levels = has.groupBy(*GROUP, "p", "p0").agg(F.count("*").alias("terms"))
    has = has.select(*GROUP, "term", "p", "p0")

    f, c = distance, F.col
    parts = [
        # terms that this group has, as if the other hadn't
        _met(levels, bare).withColumn("v", c("x.terms") * (f(c("x.p"), c("y.p0")) - f(c("x.p0"), c("y.p0")))),
        # terms that the other has, as if this one hadn't
        _met(bare, levels).withColumn("v", c("y.terms") * (f(c("x.p0"), c("y.p")) - f(c("x.p0"), c("y.p0")))),
        # terms that both have
        _met(has, has, "term").withColumn("v", f(c("x.p"), c("y.p")) - f(c("x.p"), c("y.p0")) - f(c("x.p0"), c("y.p")) + f(c("x.p0"), c("y.p0"))),
    ]
    each = [p.groupBy("x.lang", "x.source", "y.source").agg(F.sum("v").alias("v")).toDF(*GROUP, "item", "v") for p in parts]
    out = _bare_pairs(groups)
    for p in each:
        out = out.union(p)
    return out.groupBy(*GROUP, "item").agg(F.sum("v").alias("value"))


def term_values(has: DataFrame, ranks: int = RANKS) -> DataFrame:
    """(lang, source, item, value) of the terms that may be among a group's first ``ranks``: their share in the group
    is above the language's."""
    more = has.filter("n > 0 AND p > q").select(*GROUP, "term", "n", "lang_n", "p", "q")
    return _valued(merged_skybands(more, ranks))


def _valued(band: DataFrame) -> DataFrame:
    return band.select(*GROUP, F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _share(count: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """``share`` in numpy; beyond what a long product holds in Python's whole numbers."""
    if len(count) and count.max() >= (1 << 62) // SCALE:
        return np.array([1 + SCALE * (c + 1) // t for c, t in zip(count.tolist(), np.broadcast_to(parts, count.shape).tolist())], dtype=np.int64)
    return 1 + SCALE * (count + 1) // parts


class Language:
    """A language's groups, and what a task has seen of their terms."""

    def __init__(self, groups: list[tuple[str, int, int, int]]):
        self.sources = [g[0] for g in groups]
        self.place = {s: i for i, s in enumerate(self.sources)}
        kept = groups[0][3]
        self.parts = np.array([g[1] for g in groups], dtype=np.int64) + kept
        self.whole = np.int64(groups[0][2] + kept)
        self.p0 = _share(np.zeros(len(groups), dtype=np.int64), self.parts)
        self.both = np.zeros((len(groups), len(groups)), dtype=np.int64)
        self.levels = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))  # place << 32 | share, terms

    def add(self, sizes: np.ndarray, place: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Take in terms with so many sources each, their places and counts; returns the shares."""
        p = _share(n, self.parts[place])
        self.levels = _summed(np.concatenate([self.levels[0], place << 32 | p]), np.concatenate([self.levels[1], np.ones(len(p), dtype=np.int64)]))
        start = np.cumsum(sizes) - sizes
        cut = np.searchsorted(np.cumsum(sizes * sizes), np.arange(0, int((sizes * sizes).sum()), PAIRS))
        for low, high in zip(cut, np.append(cut[1:], len(sizes))):  # terms whose pairs are taken together
            many = np.repeat(sizes[low:high], sizes[low:high])
            x = np.repeat(np.arange(start[low], start[low] + len(many)), many) if high > low else np.empty(0, dtype=np.int64)
            y = np.repeat(np.repeat(start[low:high], sizes[low:high]), many) + np.arange(len(x)) - np.repeat(np.cumsum(many) - many, many)
            x, y = x[x != y], y[x != y]
            i, j = place[x], place[y]
            np.add.at(self.both, (i, j), _f(p[x], p[y]) - _f(p[x], self.p0[j]) - _f(self.p0[i], p[y]) + _f(self.p0[i], self.p0[j]))
        return p

    def sums(self) -> np.ndarray:
        """What the terms seen add to the distance of every pair, beyond that of two groups without any term."""
        out, p0 = self.both.copy(), self.p0
        for key, terms in zip(*(x.tolist() for x in self.levels)):
            i, p = key >> 32, np.int64(key & 0xFFFFFFFF)
            out[i, :] += terms * (_f(p, p0) - _f(p0[i], p0))
            out[:, i] += terms * (_f(p0, p) - _f(p0, p0[i]))
        return out


def _measured(block, ranks: int):
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's kept terms: a row per pair of groups with its part of the sum, and the groups' skybands."""
        languages, bands = {lang: Language(groups) for lang, groups in block.value.items()}, Bands(ranks)
        for batch in batches:
            for name in pc.unique(batch["lang"]).to_pylist():
                rows, lang = batch.filter(pc.equal(batch["lang"], name)), languages[name]
                sizes = np.diff(rows["sources"].offsets.to_numpy()).astype(np.int64)
                coded, n = rows["sources"].flatten().dictionary_encode(), rows["ns"].flatten().to_numpy()
                place = np.array([lang.place[s] for s in coded.dictionary.to_pylist()], dtype=np.int64)[coded.indices.to_numpy()]
                p = lang.add(sizes, place, n)
                lang_n = rows["lang_n"].to_numpy()
                q, of = _share(lang_n, lang.whole), np.repeat(np.arange(len(sizes)), sizes)
                at = np.flatnonzero((n > 0) & (p > q[of]))
                bands.add(pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(name, pa.string()), len(at)), coded.cast(pa.string()).take(pa.array(at)), rows["term"].take(pa.array(of[at])),
                     pa.array(n[at]), pa.array(lang_n[of[at]]), pa.array(p[at]), pa.array(q[of[at]])], names=[*GROUP, "term", "n", "lang_n", "p", "q"]))
        for name, lang in languages.items():
            i, j = np.nonzero(sums := lang.sums())
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(name, pa.string()), len(i)), *[pa.array(lang.sources, pa.string()).take(pa.array(x)) for x in (i, j)],
                 *[pa.nulls(len(i), pa.int64())] * 4, pa.array(sums[i, j])], names=[*GROUP, "term", "n", "lang_n", "p", "q", "value"])
        for batch in bands.reduced():
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(batch.num_rows, pa.int64())], names=[*batch.schema.names, "value"])

    return measured


def both_values(groups: DataFrame, kept: DataFrame, ranks: int) -> tuple[DataFrame, DataFrame]:
    """``pair_values`` and ``term_values`` in one pass over the kept terms, with all groups in every task."""
    by_lang: dict[str, list[tuple[str, int, int, int]]] = {}
    for lang, *rest in groups.select(*GROUP, "total", "lang_total", "kept").orderBy(*GROUP).collect():
        if rest[3]:
            by_lang.setdefault(lang, []).append(tuple(rest))
    block = kept.sparkSession.sparkContext.broadcast(by_lang)
    found = written(kept.mapInArrow(_measured(block, ranks), "lang string, source string, term string, n long, lang_n long, p long, q long, value long"))
    sums = found.filter("value IS NOT NULL AND source != term").select(*GROUP, F.col("term").alias("item"), F.col("value").alias("v"))
    pairs = _bare_pairs(groups).union(sums).groupBy(*GROUP, "item").agg(F.sum("v").alias("value"))
    return pairs, _valued(_merged(found.filter("value IS NULL").drop("value"), ranks))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS,
          ranks: int = RANKS, most_groups: int = GROUPS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank), ranks from 1 per group and part by descending value and ascending item.

    Part ``pair`` has every other source of the language and its distance over all kept terms (0 if
    none is kept); part ``term`` the first ``ranks`` kept terms whose share is higher than in the
    language.  A null text, language or source is the empty one.  Rows are documents, repeated ones
    too.  A group without terms, or with a language whose terms are all rare, has pairs but no
    terms; an empty table gives an empty one.  Other columns are not read.  Up to ``most_groups``
    groups the shares are compared in one pass with all groups' totals at hand, beyond that by joins.
    """
    groups, kept = kept_terms(term_counts(docs, text_col, lang_col, source_col), least_docs)
    if groups.count() <= most_groups:
        pairs, best = both_values(groups, kept, ranks)
    else:
        has = written(shares(groups, kept))
        pairs, best = pair_values(groups, has), term_values(has, ranks)
    place = F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item"))
    pairs, best = pairs.withColumn("rank", place), best.withColumn("rank", place).filter(F.col("rank") <= ranks)
    return pairs.select(*GROUP, F.lit("pair").alias("part"), "item", "value", "rank").union(
        best.select(*GROUP, F.lit("term").alias("part"), "item", "value", "rank"))
