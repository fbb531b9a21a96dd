"""Language identification by fusing the evidence about a page or document.

Log probabilities of four sources add up for every language and for ``und`` (none of them):

* the text: a naive Bayes model of letter trigrams, fitted on a bounded sample of labelled documents
  that every language has an equal share of, so a rare one stays a class at every size; its weight
  levels off with the length, as neighbouring trigrams aren't independent;
* the declared language of the markup (or a column) and the language that the address suggests
  (the suffix of the host, or a first path part), each by how often a text of the language
  comes with such a declaration, counted over all rows;
* the prior of the host: the mix of text languages of its other rows, smoothed towards that of
  its domain, that one towards its suffix's, that one towards the mix of all rows.  All mixes are
  grouped sums over all rows.
"""
from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulae.llm.common import built, free_name, ship, written

#: Labelled rows and trigrams that the text model is fitted on, shared out evenly among the languages; the least share.
TRAIN_ROWS, TRIGRAMS = 4000, 60_000
LEAST_ROWS, LEAST_TRIGRAMS = 200, 300
#: Trigrams at which the text's weight has levelled off to a half; rows' worth of a mix's smoothing.
LEVEL_OFF, SMOOTHING = 300, 5.0
UNKNOWN = "und"
#: Log probability of any trigram under ``und``, log odds for it of a text without letters, and its share beforehand.
UNKNOWN_TRIGRAM, NO_LETTERS, UNKNOWN_SHARE = -11.5, 8.0, 0.001
CACHED_WORDS = 100_000
#: Suffixes of hosts that speak for a language.
SUFFIXES = {"at": "de", "au": "en", "cl": "es", "co": "es", "de": "de", "es": "es", "fr": "fr", "ie": "en", "it": "it",
            "mx": "es", "nl": "nl", "nz": "en", "pl": "pl", "pt": "pt", "uk": "en", "us": "en"}
_LETTERS = re.compile(r"[^\W\d_]+")
_BLOCK = re.compile(r"(?i)<(script|style)\b")
_BLOCK_END = {k: re.compile(rf"(?i)</{k}\s*>") for k in ("script", "style")}
_BODY = re.compile(r"(?i)<body\b")
_HTML, _META = re.compile(r"(?i)<html\b"), re.compile(r"(?i)<meta\b")
_LANG = re.compile(r"""(?i)\blang\s*=\s*["']?([a-z]{2,3})\b""")
_ABOUT_LANGUAGE = re.compile(r"(?i)content-language")
_CONTENT = re.compile(r"""(?i)\bcontent\s*=\s*["']?([a-z]{2,3})\b""")


@dataclass
class TextModel:
    """Languages in order, and log probabilities of trigrams by language; the last row is for all others."""

    languages: list[str]
    trigrams: dict[str, int]
    logs: np.ndarray


class Reader:
    """Log likelihoods of texts; sums over words whose values are kept."""

    def __init__(self, model: TextModel):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.rows = np.zeros((1024, self.model.logs.shape[1] + 1))

    def _word(self, word: str) -> int:
        if len(self.at) >= len(self.rows):
            self.rows = np.vstack([self.rows, np.zeros_like(self.rows)])
        get, other = self.model.trigrams.get, len(self.model.logs) - 1
        marked = f" {word} "
        found = [get(marked[i:i + 3], other) for i in range(len(word))]
        i = self.at[word] = len(self.at)
        self.rows[i, :-1] = self.model.logs[found].sum(axis=0)
        self.rows[i, -1] = len(found)
        return i

    def read(self, text: str) -> tuple[list[float], int]:
        """Weighted log likelihood by language (``und`` last) and the number of trigrams."""
        if len(self.at) > CACHED_WORDS:
            self._clear()
        get, make = self.at.get, self._word
        total = np.zeros(self.rows.shape[1])
        words = _LETTERS.findall(text.lower())
        for start in range(0, len(words), 1 << 16):
            found = [i if (i := get(w)) is not None else make(w) for w in words[start:start + (1 << 16)]]
            total += self.rows[found].sum(axis=0)
        n = int(total[-1])
        if not n:
            return [-NO_LETTERS] * (len(total) - 1) + [0.0], 0
        weight = 1 / (1 + n / LEVEL_OFF)
        return [*(total[:-1] * weight).tolist(), n * UNKNOWN_TRIGRAM * weight], n


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for word, n in Counter(_LETTERS.findall((text or "").lower())).items():
                marked = f" {word} "
                for i in range(len(word)):
                    counts[lang, marked[i:i + 3]] += n
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()),
                                          pa.array(list(counts.values()), pa.int64())], names=["lang", "trigram", "n"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        rows: int = TRAIN_ROWS, trigrams: int = TRIGRAMS) -> TextModel:
    """The text model of labelled documents, from about ``rows`` of them (at least ``LEAST_ROWS`` of a language).

    Every language has the same share of the rows (those with the smallest hashes of the id) and
    of the ``trigrams`` (its most frequent ones).
    """
    ship(docs.sparkSession)
    lang, key = F.lower(F.col(f"`{lang_col}`")), F.col(f"`{id_col}`")
    known = docs.filter(lang.rlike("^[a-z]{2,3}$") & (lang != UNKNOWN) & F.col(f"`{text_col}`").isNotNull()).select(
        lang.alias("lang"), F.xxhash64(key).alias("h"), F.col(f"`{text_col}`").alias("text"))
    labelled = max(1, known.select("lang").distinct().count())  # codes of two or three letters
    most = max(LEAST_ROWS, rows // labelled)
    order = Window.partitionBy("lang").orderBy("h")
    ends = (known.select("lang", "h").distinct().withColumn("at", F.row_number().over(order)).filter(F.col("at") <= most)
            .groupBy("lang").agg(F.max("h").alias("end")))
    sample = known.join(F.broadcast(ends), "lang").filter("h <= end").select("lang", "text")
    counts = sample.mapInArrow(_trigrams, "lang string, trigram string, n long").groupBy("lang", "trigram").agg(F.sum("n").alias("n"))
    often = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "trigram"))
    counts = counts.withColumn("at", often).filter(F.col("at") <= max(LEAST_TRIGRAMS, trigrams // labelled))
    counts = counts.orderBy(F.desc("n"), "lang", "trigram").collect()
    languages = sorted({r["lang"] for r in counts})
    at = {t: i for i, t in enumerate(dict.fromkeys(r["trigram"] for r in counts))}
    n = np.full((len(at) + 1, len(languages)), 0.1)
    for r in counts:
        n[at[r["trigram"]], languages.index(r["lang"])] += r["n"]
    logs = np.log(n / n.sum(axis=0)) if languages else np.zeros((1, 0))
    return TextModel(languages, at, logs)


def visible(page: str) -> str:
    """The text of a page without scripts, styles, comments and tags.

    One scan forward: a mark that isn't closed hides nothing but its own tag, a tag that isn't closed
    is text, and what isn't found once isn't looked for again.
    """
    out, at, missing = [], 0, set()

    def after(mark: str, start: int) -> int:
        """The place behind the next ``mark``, or -1."""
        if mark in missing:
            return -1
        if mark in _BLOCK_END:
            m = _BLOCK_END[mark].search(page, start)
            end = m.end() if m else -1
        else:
            end = page.find(mark, start)
            end = end + len(mark) if end >= 0 else -1
        if end < 0:
            missing.add(mark)
        return end

    while (start := page.find("<", at)) >= 0:
        end = after("-->", start + 4) if page.startswith("<!--", start) else -1
        if end < 0 and (m := _BLOCK.match(page, start)):
            end = after(m.group(1).lower(), m.end())
        if end < 0:
            end = after(">", start)
        if end < 0:
            break
        out.append(page[at:start])
        at = end
    out.append(page[at:])
    return entities.unescape(" ".join(out))


def declared(page: str) -> str | None:
    """The language that the ``html`` tag or a ``content-language`` declares ahead of the body, in lower case."""
    body = _BODY.search(page)
    head = page[:body.start()] if body else page

    def tags(begin: re.Pattern) -> Iterator[str]:
        at = 0
        while m := begin.search(head, at):
            at = head.find(">", m.end())
            at = len(head) if at < 0 else at
            yield head[m.end():at]

    found = [m for tag in tags(_HTML) if (m := _LANG.search(tag))]
    found = found or [m for tag in tags(_META) if _ABOUT_LANGUAGE.search(tag) and (m := _CONTENT.search(tag))]
    return found[0].group(1).lower() if found else None


def read_texts(spark, model: TextModel, text: Column, markup: bool = False) -> Column:
    """Struct of a text: ``logs`` (by language, und last), ``n`` trigrams, ``declared`` (of markup only)."""
    ship(spark)
    block = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<logs array<double>, n long, declared string>")
    def run(texts: pa.Array) -> pa.Array:
        reader = built(block, Reader)
        rows = [t or "" for t in texts.to_pylist()]
        found = [reader.read(visible(t) if markup else t) for t in rows]
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.list_(pa.float64())), pa.array([f[1] for f in found], pa.int64()),
             pa.array([declared(t) if markup else None for t in rows], pa.string())], names=["logs", "n", "declared"])

    return run.asNondeterministic()(text)


def _chances(logs: Column) -> Column:
    """Log values as probabilities that sum up to one."""
    top = F.array_max(logs)
    parts = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(parts, lambda x: x / F.aggregate(parts, F.lit(0.0), lambda a, b: a + b))


def _evidence(rows: DataFrame, column: str, classes: list[str]) -> Column:
    """Log P(column's value | language) as an array; zeros where the column is null.

    Counted over all rows; a value outside the languages counts as ``other``.
    """
    seen = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(
        *[F.sum(F.element_at("chance", i + 1)).alias(f"c{i}") for i in range(len(classes))]).collect()  # languages + other
    values = [*classes, "other"]
    count = {r[0]: np.array([r[f"c{i}"] for i in range(len(classes))]) for r in seen}
    total = sum(count.values(), np.zeros(len(classes)))
    out = F.array(*[F.lit(0.0)] * len(classes))
    for v in values:
        # a declaration is taken to be right as often as not before anything is counted
        guess = np.array([0.5 if v == c else 0.5 / len(values) for c in classes])
        p = (count.get(v, 0) + SMOOTHING * guess) / (total + SMOOTHING)
        out = F.when(F.col(column) == v, F.array(*[F.lit(float(x)) for x in np.log(p)])).otherwise(out)
    return out


def fuse(rows: DataFrame, classes: list[str], levels: list[str], name: str) -> DataFrame:
    """``rows`` with a struct ``name`` (lang, probability, text_lang).

    ``rows`` has the columns ``logs``, ``chance`` (text alone), ``declared``, ``suggested`` and, from the
    finest to the coarsest, the columns ``levels`` of groups, none null; a finer group lies in one coarser.
    """
    size = len(classes)
    sums = [F.sum(F.element_at("chance", i + 1)).alias(f"s{i}") for i in range(size)] + [F.count("*").alias("n")]
    again = [F.sum(f"s{i}").alias(f"s{i}") for i in range(size)] + [F.sum("n").alias("n")]
    tables = [rows.groupBy(*levels).agg(*sums)]
    for k in range(1, len(levels)):
        tables.append(tables[-1].groupBy(*levels[k:]).agg(*again))
    whole = tables[-1].agg(*again).first()
    n = whole["n"] or 0
    share = [UNKNOWN_SHARE if c == UNKNOWN else 1 / max(1, size - 1) for c in classes]
    mix = F.array(*[F.lit(float(((whole[f"s{i}"] or 0.0) + SMOOTHING * share[i]) / (n + SMOOTHING))) for i in range(size)])

    def smoothed(own: list[Column], count: Column, towards: Column) -> Column:
        return F.array(*[(own[i] + SMOOTHING * F.element_at(towards, i + 1)) / (count + SMOOTHING) for i in range(size)])

    prior = None
    for k in range(len(levels) - 1, 0, -1):  # the coarsest first
        t = tables[k] if prior is None else tables[k].join(prior, levels[k + 1:])
        up = mix if prior is None else F.col("prior")
        prior = t.select(*levels[k:], smoothed([F.col(f"s{i}") for i in range(size)], F.col("n"), up).alias("prior"))
    finest = tables[0] if prior is None else tables[0].join(prior, levels[1:])
    finest = finest.withColumn("prior", mix if prior is None else F.col("prior")).select(
        F.col(levels[0]).alias("__at"), F.array(*[F.col(f"s{i}") for i in range(size)]).alias("__sums"),
        F.col("n").alias("__n"), F.col("prior").alias("__prior"))
    joined = rows.join(finest, rows[levels[0]] == F.col("__at"))
    # a row's own text stays out of its host's mix
    own = smoothed([F.element_at("__sums", i + 1) - F.element_at("chance", i + 1) for i in range(size)], F.col("__n") - 1, F.col("__prior"))
    said, hinted = _evidence(rows, "declared", classes), _evidence(rows, "suggested", classes)
    total = F.zip_with(F.zip_with("logs", F.transform(own, lambda x: F.log(F.greatest(x, F.lit(1e-9)))), lambda a, b: a + b),
                       F.zip_with(said, hinted, lambda a, b: a + b), lambda a, b: a + b)
    labels = F.array(*[F.lit(c) for c in classes])

    def best(p: Column) -> Column:
        return F.element_at(labels, F.array_position(p, F.array_max(p)).cast("int"))

    fused = F.transform(F.array(_chances(total)), lambda p: F.struct(
        best(p).alias("lang"), F.array_max(p).alias("probability"), best(F.col("chance")).alias("text_lang")))
    return joined.withColumn(name, F.element_at(fused, 1)).drop("__at", "__sums", "__n", "__prior")


def _known(value: Column, classes: list[str]) -> Column:
    """A declared language: null stays, one outside the model's becomes ``other``."""
    return F.when(value.isNull() | value.isin(classes[:-1]), value).otherwise(F.lit("other"))


def _base(rows: DataFrame, classes: list[str]) -> DataFrame:
    return rows.withColumn("chance", _chances(F.col("logs"))).withColumn("declared", _known(F.col("declared"), classes)) \
        .withColumn("suggested", F.when(F.col("suggested").isin(classes[:-1]), F.col("suggested")))


def page_languages(pages: DataFrame, model: TextModel, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: the id, ``host``, ``declared``, ``suggested``, ``text_lang``, ``lang`` and ``probability``.

    A null or empty page has no letters and speaks for ``und``; a null URL, or one without a
    host, belongs to the host with the empty name.  Repeated rows count as they stand.  With a
    model of no language every row is ``und``.
    """
    classes = [*model.languages, UNKNOWN]
    url = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"(?s)^[^:/?#]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    suffix = F.element_at(F.split(host, r"\."), -1)
    by_suffix = F.create_map(*[F.lit(x) for kv in SUFFIXES.items() for x in kv])
    part = F.lower(F.regexp_extract(url, r"(?s)^[^:/?#]*://[^/?#]*/([A-Za-z]{2})(?:/|$)", 1))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), host.alias("host"), suffix.alias("suffix"),
                        F.array_join(F.slice(F.split(host, r"\."), -2, 2), ".").alias("pair"),
                        F.when(part.isin(classes[:-1]), part).otherwise(by_suffix[suffix]).alias("suggested"),
                        read_texts(pages.sparkSession, model, F.col(f"`{html_col}`"), True).alias("read"))
    rows = rows.withColumn("domain", F.when(F.instr("host", ".") > 0, F.col("pair")).otherwise(F.col("host")))
    rows = written(_base(rows.select("id", "host", "domain", "suffix", "suggested", "read.logs", "read.declared"), classes))
    return fuse(rows, classes, ["host", "domain", "suffix"], "found").select(
        F.col("id").alias(id_col), "host", "declared", "suggested", "found.text_lang", "found.lang",
        F.round("found.probability", 6).alias("probability"))


def keep_known(docs: DataFrame, model: TextModel, text_col: str = "text", lang_col: str = "lang",
               source_col: str = "source") -> DataFrame:
    """The documents in a language of the model, with their columns: declared language ``lang_col``, host ``source_col``.

    Null and empty texts, and those without letters, go; a null language declares nothing; rows
    without a source share one.  With a model of no language nothing is known and nothing kept.
    """
    classes = [*model.languages, UNKNOWN]
    kept = [F.col(f"`{c}`") for c in docs.columns]
    name = free_name(docs, "row")
    rows = docs.select(F.struct(*kept).alias(name), F.lit(None).cast("string").alias("suggested"),
                       F.lower(F.col(f"`{lang_col}`")).alias("declared"), F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("host"),
                       read_texts(docs.sparkSession, model, F.col(f"`{text_col}`")).alias("read"))
    rows = written(_base(rows.select(name, "suggested", "declared", "host", "read.logs", "read.n"), classes))
    found = fuse(rows, classes, ["host"], "found").filter(F.col("n") > 0).filter(F.col("found.lang") != UNKNOWN)
    return found.select(*[F.col(name)[c].alias(c) for c in docs.columns])
