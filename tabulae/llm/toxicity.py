"""Toxicity by weak supervision.

Voters are whole words of a small fixed lexicon, patterns that the labelled rows suggest (word
beginnings, each at several levels of frequency in a text), and shapes of a text.  A generative
label model (expectation maximisation over the true label) estimates how often each voter
fires on toxic and on other texts, and how its votes go together with those of other voters
given the label; evidence that correlated voters repeat on a text counts about once.  The
given label of a row is one more voter, right with the odds ``LABEL_ODDS``.  A logistic
regression on the other votes is trained on the posterior labels.  One Aho-Corasick automaton
finds the terms, so that scoring reads every text once.

Only the fit uses labels, from at most ``TRAIN_ROWS`` labelled rows that are not held out (the
smallest by a hash of the id); it sees each text's votes and never the language, the source
or the id.  Scores depend on the text alone.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulae.llm.common import built, discard, free_name, ship, written

#: Labelled rows that the fit reads at most, and patterns that it keeps at most.
TRAIN_ROWS, PATTERNS = 10_000, 1000
#: A pattern must fire on so many toxic texts, and on toxic texts so many times as often as on others, by the lower bound
#: of the ratio's confidence interval (this many standard errors; thousands of beginnings are tried, so chance finds some).
SUPPORT, RATIO, ERRORS = 3, 4.0, 3.0
#: Whole words of the fixed lexicon.
LEXICON = ("bastard", "clown", "coward", "disgusting", "dumb", "fool", "freak", "garbage", "idiot", "imbecile", "jerk",
           "loser", "moron", "nasty", "pathetic", "pig", "scum", "shut up", "stupid", "trash", "ugly", "vermin", "worthless")
PREFIXES = (4, 5, 6, 7)
#: A pattern's level is reached by so many occurrences that make up such a share of a text's words.
LEVELS = ((1, 0.0), (2, 0.005), (2, 0.01), (2, 0.02), (3, 0.04))
#: Log odds that a given label is right.
LABEL_ODDS = 3.0
_WORD = re.compile(r"[^\W\d_]{3,}")
_SHOUT = re.compile(r"!{2,}|\?{2,}")


@dataclass
class Model:
    """Terms (text, level; -1 for a whole word), the weights of their votes and of the shapes, and the bias."""

    terms: list[tuple[str, int]]
    weights: np.ndarray
    bias: float


def words_in(text: str) -> int:
    """Words of a text, about: its gaps and one."""
    return text.count(" ") + text.count("\n") + 1


def level(n: int, words: int) -> int:
    """The highest level that ``n`` occurrences among so many words reach."""
    return max(i for i, (least, share) in enumerate(LEVELS) if n >= least and n >= share * words)


class Voters:
    """Finds which voters fire on a text: terms by number, then the shapes."""

    shapes = 2

    def __init__(self, terms: list[tuple[str, int]]):
        self.automaton = ahocorasick.Automaton()
        by_text: dict[str, list[tuple[int, int]]] = {}
        for i, (term, at) in enumerate(terms):
            by_text.setdefault(term, []).append((at, i))
        for term in by_text:
            self.automaton.add_word(term, (len(term), term))
        if by_text:
            self.automaton.make_automaton()
        self.by_text = by_text
        self.first_shape = len(terms)

    def votes(self, text: str) -> set[int]:
        low = text.lower()
        begins: Counter = Counter()
        fired: set[int] = set()
        if self.by_text:
            whole: set[str] = set()
            for end, (size, term) in self.automaton.iter(low):
                start = end + 1 - size
                if start and low[start - 1].isalpha():
                    continue
                begins[term] += 1
                if end + 1 == len(low) or not low[end + 1].isalpha():
                    whole.add(term)
            words = words_in(low)
            for term, n in begins.items():
                reached = level(n, words)
                fired.update(i for at, i in self.by_text[term] if (term in whole if at < 0 else at <= reached))
        if text.isupper():
            fired.add(self.first_shape)
        if _SHOUT.search(text):
            fired.add(self.first_shape + 1)
        return fired


def held_out(id_col: Column) -> Column:
    """Rows whose labels no fit may see."""
    return F.crc32(id_col.cast("string").cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled texts (text, toxic) that are not held out, each different text once.

    Of several labels of one id the majority counts, and 1 if there is none; equal texts have the
    label of their smallest id.
    """
    key = F.col(f"`{id_col}`")
    some = (labels.select(key.alias("id"), F.col("toxic").cast("int").alias("toxic"))
            .filter(F.col("toxic").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
            .groupBy("id").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(rows))  # the documented bound
    texts = docs.select(key.alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return (texts.join(F.broadcast(some), "id").groupBy(F.md5(F.col("text").cast("binary")).alias("key"))
            .agg(F.min_by("text", "id").alias("text"), F.min_by("toxic", "id").alias("toxic")).drop("key"))


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts by pattern (the beginning of words, or a short word, at a level) and label."""
    for batch in batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            low = text.lower()
            words = words_in(low)
            begins: Counter = Counter()
            for w, n in Counter(_WORD.findall(low)).items():
                for size in {min(size, len(w)) for size in PREFIXES}:
                    begins[w[:size]] += n
            counts[toxic].update((w, at) for w, n in begins.items() for at in range(level(n, words) + 1))
        keys = list(counts[1]) + [k for k in counts[0] if k not in counts[1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([counts[1][k] for k in keys], pa.int64()), pa.array([counts[0][k] for k in keys], pa.int64())],
            names=["term", "level", "toxic", "other"])


def _fired(block):
    def fired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = built(block, Voters)
        for batch in batches:
            rows = [sorted(voters.votes(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32())), batch.column(1)], names=["votes", "toxic"])

    return fired


def posterior(votes: np.ndarray, count: np.ndarray, label: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Posterior probability of the label 1 for rows of votes (0 or 1), each standing for ``count`` texts.

    ``label`` has the given label per row; its mean is the prior.  Each round estimates the voters'
    firing rates by class and the correlations of their votes given the class, then the
    posterior: the log odds of the voters that fire on a text, each divided by one plus its
    positive correlations with the others that fire there.  A voter that doesn't fire abstains.
    """
    prior = (label @ count + 1) / (count.sum() + 2)
    said = LABEL_ODDS * (2 * label - 1)
    p = 1 / (1 + np.exp(-said))
    for _ in range(rounds):
        one, zero = p * count, (1 - p) * count
        rate1 = (votes.T @ one + 0.5 * prior) / (one.sum() + 1)
        rate0 = (votes.T @ zero + 0.5 * (1 - prior)) / (zero.sum() + 1)
        rate1, rate0 = np.clip(rate1, 1e-4, 1 - 1e-4), np.clip(rate0, 1e-4, 1 - 1e-4)
        both = np.zeros((votes.shape[1],) * 2)
        for weight, rate in ((one, rate1), (zero, rate0)):
            both += (votes * weight[:, None]).T @ votes - weight.sum() * np.outer(rate, rate)
        spread = np.sqrt(np.clip(np.diag(both), 1e-9, None))
        again = votes @ np.clip(both / np.outer(spread, spread), 0, 1)  # by text and voter: votes that say the same
        odds = np.log(prior / (1 - prior)) + said + (votes / again.clip(1, None)) @ np.log(rate1 / rate0)
        after = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        done = np.abs(after - p).max(initial=0) < 1e-4
        p = after
        if done:
            break
    return p


def regression(votes: np.ndarray, count: np.ndarray, target: np.ndarray, rounds: int = 1000,
               decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels: accelerated gradient steps with a ridge penalty."""
    n, rows = max(1.0, count.sum()), np.hstack([votes, np.ones((len(votes), 1))])
    w = last = np.zeros(rows.shape[1])
    step = 4.0 / max(1.0, float((count[:, None] * rows * rows).sum() / n))
    for t in range(rounds):
        at = w + (t / (t + 3)) * (w - last)
        off = 1 / (1 + np.exp(-np.clip(rows @ at, -30, 30))) - target
        slope = rows.T @ (off * count) / n + decay * np.append(at[:-1], 0)
        last, w = w, at - step * slope
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        rows: int = TRAIN_ROWS, patterns: int = PATTERNS) -> Model:
    """Voters and classifier from a bounded sample of labelled rows.

    Without labelled rows the fixed lexicon alone votes, each term with the same weight.
    """
    spark = docs.sparkSession
    ship(spark)
    train = written(training_rows(docs, labels, id_col, text_col, rows))
    sums = train.agg(F.count("*"), F.sum("toxic")).first()
    fixed = [(t, -1) for t in LEXICON]
    if not sums[0] or not sums[1] or sums[0] == sums[1]:
        return Model(fixed, np.array([4.0] * len(fixed) + [0.0] * Voters.shapes), -2.0)
    toxic, other = F.col("toxic") + 0.5, F.col("other") + 0.5
    lift = F.log(toxic / (sums[1] + 1.0)) - F.log(other / (sums[0] - sums[1] + 1.0))
    found = (train.mapInArrow(_patterns, "term string, level int, toxic long, other long")
             .groupBy("term", "level").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
             .filter((F.col("toxic") >= SUPPORT)
                     & (lift - ERRORS * F.sqrt(1 / toxic + 1 / other) >= F.log(F.lit(RATIO))))
             .orderBy(F.desc(F.col("toxic") * lift), "term", "level").limit(patterns).collect())
    terms = fixed + [(r["term"], r["level"]) for r in found]
    block = spark.sparkContext.broadcast(terms)
    cells = (train.mapInArrow(_fired(block), "votes array<int>, toxic int").groupBy("votes", "toxic")
             .agg(F.count("*").alias("n")).orderBy("votes", "toxic").collect())  # at most `rows`
    discard(train)
    votes = np.zeros((len(cells), len(terms) + Voters.shapes))
    for i, r in enumerate(cells):
        votes[i, r["votes"]] = 1
    count = np.array([r["n"] for r in cells], dtype=float)
    weights, bias = regression(votes, count, posterior(votes, count, np.array([float(r["toxic"]) for r in cells])))
    return Model(terms, weights, bias)


def scores(spark, model: Model, text: Column) -> Column:
    """Probability of the label 1 for each text; null counts as the empty text."""
    ship(spark)
    block = spark.sparkContext.broadcast(model)

    def voters(m: Model) -> Voters:
        return Voters(m.terms)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        found, m = built(block, voters), block.value
        out = [m.bias + sum(m.weights[i] for i in found.votes(t or "")) for t in texts.to_pylist()]
        return pa.array(1 / (1 + np.exp(-np.clip(np.array(out, dtype=float), -30, 30))), pa.float64())

    return run.asNondeterministic()(text)  # one call per row, also beside a filter


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             model: Model | None = None) -> DataFrame:
    """One row per row of ``docs``: the id, ``held_out``, ``score`` (0 to 1) and ``predicted`` (score >= 0.5).

    Null and empty texts have the score of a text without votes; a null id is not held out and
    trains nothing; repeated rows score alike; without usable labels the fixed lexicon decides.
    """
    model = model or fit(docs, labels, id_col, text_col)
    key = F.col(f"`{id_col}`")
    out = docs.select(key.alias(id_col), F.coalesce(held_out(key), F.lit(False)).alias("held_out"),
                      scores(docs.sparkSession, model, F.col(f"`{text_col}`")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_civil(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose predicted label is 0, with their columns."""
    name = free_name(docs, "score")
    marked = docs.withColumn(name, scores(docs.sparkSession, fit(docs, labels, id_col, text_col), F.col(f"`{text_col}`")))
    return marked.filter(F.col(name) < 0.5).drop(name)
