import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tabulae.llm import divergence


def expected(rows, least_docs=3, ranks=200):
    """Brute force in whole numbers over (text, lang, source) rows."""
    per, docs, whole, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low))
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        per[lang, source].update(words)
        whole[lang].update(words)
        docs[lang].update(words.keys())
    out = set()
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        p, base = shares(per[lang, source]), shares(whole[lang])
        pairs = []
        for other_lang, other in groups:
            if other_lang == lang and other != source:
                q = shares(per[lang, other])
                pairs.append((-sum((p[t] - q[t]) ** 2 // q[t] for t in kept), other.encode()))
        terms = [(-((p[t] - base[t]) ** 2 // base[t]), t.encode()) for t in kept if per[lang, source][t] and p[t] > base[t]]
        out |= {(lang, source, "pair", i.decode(), -v, k + 1) for k, (v, i) in enumerate(sorted(pairs))}
        out |= {(lang, source, "term", i.decode(), -v, k + 1) for k, (v, i) in enumerate(sorted(terms)[:ranks])}
    return out


def got(frame):
    rows = [tuple(r) for r in frame.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("k,n,levels", [(1, 50, 4), (3, 400, 6), (20, 1500, 40), (5, 700, 1)])
def test_skyband_holds_what_fewer_than_k_others_dominate(k, n, levels):
    rng = np.random.default_rng(n)
    a, b, order = rng.integers(0, levels, n), rng.integers(0, levels, n), rng.permutation(n)
    dominators = ((a >= a[:, None]) & (b <= b[:, None]) & (order < order[:, None])).sum(axis=1)
    assert sorted(divergence.skyband(a, b, order, k)) == np.flatnonzero(dominators < k).tolist()
    assert divergence.skyband(a[:0], b[:0], order[:0], k).tolist() == []


@pytest.mark.parametrize("ranks", [2, 200])
def test_equal_to_brute_force(spark, ranks):
    rng = random.Random(ranks)
    words = [w + e for w in ("ab", "cd", "éf", "Gh", "\U0001f600", "zz") for e in ("", "x", "yy", "ä", "中", "q9r")]
    rows = [(" ".join(rng.choices(words, [1 / (1 + i) for i in range(len(words))], k=rng.randrange(30))) or None,
             rng.choice(["en", "de", None, ""]), rng.choice(["s", "t", "u", None])) for _ in range(160)] + [("solo term", "xx", "s"), (None, "yy", "s"), ("", "yy", "t")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)
    for most in (1024, 0):  # with all groups in every task, and by joins
        assert got(divergence.audit(docs, ranks=ranks, most_groups=most)) == expected(rows, ranks=ranks)


def test_small_merges_give_the_same(spark, monkeypatch):
    rng = random.Random(3)
    rows = [("t", f"w{i}", f"term{i}", rng.randrange(1, 30), rng.randrange(30, 60)) for i in range(10)]
    rows += [("t", "s", f"term{i:04}", rng.randrange(1, 12), rng.randrange(30, 50)) for i in rng.sample(range(2000), 2000)]
    frame = spark.createDataFrame(rows, "lang string, source string, term string, n long, lang_n long").repartition(6)
    whole = {tuple(r) for r in divergence.merged_skybands(frame, 4).collect()}
    monkeypatch.setattr(divergence, "MERGED", 60)
    several = {tuple(r) for r in divergence.merged_skybands(frame, 4).collect()}
    one = [r for r in rows if r[1] == "s"]
    exact = {r for r in one if sum(o[3] >= r[3] and o[4] <= r[4] and o[2] < r[2] for o in one) < 4}
    assert {r for r in whole if r[1] == "s"} == exact <= {r for r in several if r[1] == "s"}


def test_odd_rows_clashing_columns_and_empty_tables(spark, odd, none, monkeypatch):
    rows = [(r.text, r.lang, r.source) for r in odd.collect()]
    monkeypatch.setattr(divergence, "PIECE", 1000)
    monkeypatch.setattr(divergence, "HELD", 2000)
    assert got(divergence.audit(odd)) == expected(rows)
    assert divergence.audit(none).count() == 0
    for text in ("Ab " * 2500, "a" * 3000 + " b c" + "d" * 2500, "x " + "y" * 5000, "", " ", "z" * 1500):
        cut = [p.split() for p in divergence.pieces(text.encode())]
        assert [w for p in cut for w in p] == text.lower().encode().split()


def test_pairs_in_small_slices(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(" ".join("w" + chr(97 + rng.randrange(20)) for _ in range(25)), "en", f"s{i % 7}") for i in range(80)]
    monkeypatch.setattr(divergence, "PAIRS", 5)
    assert got(divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string"))) == expected(rows)


def test_large_counts_stay_exact(spark):
    """Counts beyond what a long product holds."""
    big = 5_000_000_000_000
    counts = [("en", s, "", 0, 3) for s in "ab"] + [("en", "a", "x", big, 3), ("en", "b", "x", big // 3, 3), ("en", "a", "y", 17, 3)]
    groups, kept = divergence.kept_terms(spark.createDataFrame(counts, "lang string, source string, term string, n long, docs long"))
    share = lambda n, total: 1 + 1_000_000_000 * (n + 1) // (total + 2)
    a, b = (share(big, big + 17), share(17, big + 17)), (share(big // 3, big // 3), share(0, big // 3))
    for found in (divergence.pair_values(groups, divergence.shares(groups, kept)), divergence.both_values(groups, kept, 5)[0]):
        assert {r.source: r.value for r in found.collect()} == {"a": sum((p - q) ** 2 // q for p, q in zip(a, b)), "b": sum((p - q) ** 2 // q for p, q in zip(b, a))}
