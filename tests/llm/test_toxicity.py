import zlib

import numpy as np

from tabulae.llm import toxicity as t
from tests_llm_phrase import phrase


def planted(n=400):
    """Every eighth text is toxic: a lexicon word or words that begin with a made-up stem."""
    docs, labels = [], []
    for i in range(n):
        text, toxic = phrase(i, 40), int(i % 8 == 0)
        if toxic:
            text += " you idiot trash" if i % 16 else " Grumfo grumfa grumfino"
        docs.append((i, text))
        labels.append((i, 1, toxic))
    return docs, labels


def test_held_out_texts_are_told_apart(spark):
    docs, labels = planted()
    rows = t.toxicity(spark.createDataFrame(docs, "doc_id long, text string"),
                      spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.predicted == labels[r.doc_id][2]


def test_labels_of_held_out_rows_are_never_read(spark):
    docs, labels = planted(160)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    lied = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, q, y in labels]
    found = [t.fit(frame, spark.createDataFrame(rows, "doc_id long, quality int, toxic int")) for rows in (labels, lied)]
    assert found[0].terms == found[1].terms and found[0].bias == found[1].bias
    assert (found[0].weights == found[1].weights).all()


def test_odd_rows(spark, odd, none):
    docs, labels = planted(160)
    labels += [(None, 1, 1), (3, None, None), (1, 1, 0)]
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = t.toxicity(odd, marked).collect()
    assert len(rows) == odd.count() and all(not r.held_out for r in rows if r.doc_id is None)
    assert t.toxicity(none, marked).count() == 0
    bare = t.toxicity(spark.createDataFrame([(1, "You IDIOT."), (2, "idiotic"), (3, None)], "doc_id long, text string"), marked.limit(0))
    assert {r.doc_id: r.predicted for r in bare.collect()} == {1: 1, 2: 0, 3: 0}
    assert t.keep_civil(odd, marked).columns == odd.columns


def test_correlated_voters_count_about_once():
    rng = np.random.default_rng(2)
    truth = (rng.random(4000) < 0.3).astype(float)
    good = (rng.random(4000) < np.where(truth == 1, 0.7, 0.02)).astype(float)
    noise = (rng.random(4000) < 0.3).astype(float)
    votes = np.column_stack([good, good, good, noise])
    p = t.posterior(votes, np.ones(4000), truth)
    single = t.posterior(votes[:, [0, 3]], np.ones(4000), truth)
    assert np.abs(p - single).mean() < 0.05 and ((p > 0.5) == (truth == 1)).mean() > 0.95


def test_levels_need_occurrences_and_density():
    assert t.level(1, 10) == 0 and t.level(2, 10_000) == 0 and t.level(2, 400) == 1 and t.level(2, 100) == 3 and t.level(4, 100) == 4
    v = t.Voters([("idiot", -1), ("grum", 0), ("grum", 3)])
    assert v.votes("Idiot!! grumble " + "x " * 500) == {0, 1, 4} and v.votes("idiots xidiot pogrum") == set()
    assert v.votes("grumo grumi") == {1, 2} and t.Voters([]).votes("a") == set()
