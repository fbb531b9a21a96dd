import random

import numpy as np

from tabulae.llm.components import components
from tabulae.llm.near_dup import Shingler, keep_one, near_duplicates, signatures, mixed
from tests_llm_phrase import phrase


def one_by_one(elements, places):
    """SuperMinHash as published: one element after the other, each with its own shuffle."""
    least = [1 << 64] * places
    for e in elements:
        order = list(range(places))
        for step in range(places):
            x = int(mixed(np.uint64([e]) ^ mixed(np.uint64([step * 2 + 1])))[0])
            at = step + ((x & 0xFFFFFFFF) * (places - step) >> 32)
            order[step], order[at] = order[at], order[step]
            least[order[step]] = min(least[order[step]], step << 32 | x >> 32)
    return least


def test_signatures_are_those_of_the_sequential_algorithm():
    rng = np.random.default_rng(5)
    sets = [rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (1, 2, 3, 7, 20, 60, 300)]
    for s, row in zip(sets, signatures(sets, 24)):
        assert row.tolist() == one_by_one(s.tolist(), 24)


def test_agreement_estimates_the_similarity():
    rng = np.random.default_rng(1)
    common, off = rng.integers(0, 1 << 63, 400).astype(np.uint64), []
    for k in range(40):
        a, b = (np.concatenate([common[:360], rng.integers(0, 1 << 63, 45).astype(np.uint64)]) for _ in range(2))
        s = signatures([a, b], 160)
        off.append((s[0] == s[1]).mean() - 360 / 450)
    assert abs(np.mean(off)) < 0.02


def sets_of(docs, words):
    out = []
    for i, text in docs:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for c in "\t\n\x0b\x0c\r":
            w = w.replace(c, " ")
        w = [x for x in w.split(" ") if x]
        out.append((i, {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()))
    return out


def brute(docs, words, percent=80):
    sets = sets_of(docs, words)
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, s in sets:
        for b, t in sets:
            if a < b and s and t and 100 * len(s & t) >= percent * len(s | t):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: (len(s), root(i), root(i) == i) for i, s in sets}


def corpus():
    """Chains of edits, copies, many texts with one long passage in common, and a bucket with several groups."""
    rng, docs = random.Random(3), []
    for g in range(12):
        w = phrase(100 + g, rng.choice([3, 6, 40, 120])).split()
        for _ in range(rng.randint(1, 9)):
            docs.append(" ".join(w))
            w = list(w)
            for _ in range(max(1, len(w) // 40)):
                w[rng.randrange(len(w))] = rng.choice(["x", "y", "z"])
    passage = phrase(999, 70)
    docs += [phrase(500 + k, rng.choice([4, 12, 25, 50])) + " " + passage for k in range(25)]
    rng.shuffle(docs)
    return [(i * 3 + 1, d) for i, d in enumerate(docs)]


def test_groups_are_those_of_brute_force(spark):
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for words in (4, 5):
        rows = near_duplicates(frame, words=words).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == brute(docs, words)


def test_one_of_each_group_stays(spark, odd, none):
    rows = near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {(r.component_id, r.kept) for r in rows if r.doc_id == 2} == {(1, False)}
    assert all(r.n_shingles == 0 and r.kept for r in rows if r.doc_id in (3, 4, 5))
    lone = [r for r in rows if r.doc_id is None]
    assert [(r.component_id, r.kept) for r in lone] == [(10, False)] * 2  # rows without an id come after all others
    alone = near_duplicates(odd.filter("doc_id IS NULL"))
    assert [(r.component_id, r.kept) for r in alone.collect()] == [(None, True)] * 2
    assert keep_one(odd.filter("doc_id IS NULL")).count() == 1
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == [1, 3, 4, 5, 6, 7, 8, 9, 10]
    assert near_duplicates(none).count() == 0 and keep_one(none).count() == 0


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5001), (5001, 5002), (5002, 5000)]
    links += [(7, 7), (None, 3), (5000, 5001)]
    rng.shuffle(links)
    found = components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()
    expected = {i: 0 for i in range(1, 301)} | {1000 + i: 1000 for i in range(1, 200)} | {5001: 5000, 5002: 5000}
    assert {r.node: r.component for r in found} == expected and len(found) == len(expected)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_short_texts_are_one_shingle():
    s = Shingler(4)
    assert len(s.set_of(s.words(b"a b c"))) == 1 and len(s.set_of(s.words(b""))) == 0
    assert s.set_of(s.words(b"A\tb  C"))[0] == s.set_of(s.words(b"a b c"))[0] != s.set_of(s.words(b"a b"))[0]
