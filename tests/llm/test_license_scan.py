import random

import numpy as np

from tabulae.llm import license_scan as s
from tests_llm_phrase import phrase


def full(template, text):
    """Local alignment without a band: best value and its equal words."""
    best, row = (0, 0), [(0, 0)] * (len(text) + 1)
    for w in template:
        now = [(0, 0)]
        for j, x in enumerate(text):
            v, n = row[j]
            now.append(max((0, 0), (v + 2, n + 1) if x == w else (v - 1, n), (row[j + 1][0] - 1, row[j + 1][1]), (now[-1][0] - 1, now[-1][1])))
        row = now
        best = max([best, *row])
    return best


def test_band_alignment_equals_the_full_one_near_the_diagonal():
    rng = random.Random(1)
    for _ in range(60):
        template = [rng.randrange(6) + 10 * k for k in range(30)]
        text = list(template)
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(text))
            text[at:at + 1] = rng.choice([[], [999], [text[at], 998]])
        before = rng.randrange(20)
        text = [997] * before + text + [996] * 10
        n, start, end = s.align(template, text, before)
        value, equal = full(template, text)
        assert n == equal or abs(n - equal) <= 1  # equal value, another alignment
        assert before <= start < end <= len(text) - 10


def test_every_template_is_found_in_long_texts_with_edits():
    index = s.Index(s.TEMPLATES)
    for name, notice in s.TEMPLATES.items():
        text = "é " + phrase(1, 50) + " :: " + notice.upper().replace(" ", "\n * ") + " -- " + phrase(2, 500)
        found = {m["license"]: m for m in index.scan(text.encode(), s.COVERAGE)}
        assert name in found and found[name]["coverage"] == 1.0
        cut = text[found[name]["start"]:found[name]["end"]]
        assert s.words(cut.encode()) == s.words(notice.encode())
    words = s.TEMPLATES["MIT-text"].split()
    words[10:12] = ["changed"]
    del words[40]
    found = index.scan(" ".join(words).encode(), s.COVERAGE)
    assert [m["license"] for m in found] == ["MIT-text"] and 0.95 < found[0]["coverage"] < 1
    assert index.scan(" ".join(words[:30]).encode(), s.COVERAGE) == []


def test_rows(spark, odd, none):
    docs = spark.createDataFrame([(1, "Released under the MIT License. x " * 3), (2, "released under my license"), (3, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in s.scan(docs).collect()}
    assert (rows[1].n_matches, rows[1].licenses) == (3, ["MIT"]) and rows[2].n_matches == rows[3].n_matches == 0
    assert s.scan(odd).filter("n_matches = 0").count() == odd.count() and s.scan(none).count() == 0
    own = s.scan(docs, templates={"mine": "released under my license", "tiny": "x"})
    assert {r.doc_id: r.licenses for r in own.collect()} == {1: [], 2: ["mine"], 3: []}


def test_every_change_of_one_word_in_a_short_template_is_found():
    index = s.Index(s.TEMPLATES)
    for name, notice in s.TEMPLATES.items():
        words = [w.decode() for w in s.words(notice.encode())]
        if len(words) > 14:
            continue
        for at in range(len(words)):
            for new in (["changed"], []):
                text = f"{phrase(1, 20)} {' '.join(words[:at] + new + words[at + 1:])} {phrase(2, 20)}"
                found = {m["license"]: m["coverage"] for m in index.scan(text.encode(), s.COVERAGE)}
                assert found.get(name) == (len(words) - 1) / len(words), (name, at, new)


def test_changes_all_over_a_long_template_are_found():
    words = s.TEMPLATES["MIT-text"].split()
    words[4::5] = ["changed"] * len(words[4::5])
    assert [m["license"] for m in s.Index(s.TEMPLATES).scan(" ".join(words).encode(), s.COVERAGE)] == ["MIT-text"]


def test_winnowing_keeps_a_fingerprint_of_every_kept_row():
    rng = np.random.default_rng(3)
    for size in (1, 2, 5, 40, 200):
        for window in (1, 2, 3, 7):
            hashes = rng.integers(0, 9, size).astype(np.uint64)
            places = set(s.winnowed(hashes, window).tolist())
            assert all(places & set(range(i, i + window)) for i in range(size - window + 1)) and (places or size < window)
    for size in range(3, 200):
        row, left = s.kept_row(size, 0.8), -(-8 * size // 10)
        assert row * (size - left + 1) >= left > (row - 1) * (size - left + 1)
    index = s.Index(s.TEMPLATES)
    every = sum(len(n) - s.GRAM + 1 for n in index.templates)
    assert sum(len(r[0]) for r in index.runs.values()) < 0.75 * every


def test_no_notice_with_enough_words_left_is_lost():
    rng, index = random.Random(5), s.Index(s.TEMPLATES)
    for k in range(600):
        t = k % len(index.names)
        notice = s.words(s.TEMPLATES[index.names[t]].encode())
        changes = len(notice) - -(-8 * len(notice) // 10)
        step, some = len(notice) / (changes + 1), rng.random() < 0.5
        at = [round(step * (i + 1)) for i in range(changes)] if some else rng.sample(range(len(notice)), changes)
        drops = set(rng.sample(at, min(len(at), rng.randrange(min(s.BAND, len(notice) // 2) // 2 + 1))))
        left = [b"zz%d" % i if i in at else w for i, w in enumerate(notice) if i not in drops]
        text = phrase(k, 30).encode() + b" " + b" ".join(left) + b" " + phrase(k + 1, 30).encode()
        if full(notice, s.words(text))[1] >= s.COVERAGE * len(notice):
            assert index.names[t] in {m["license"] for m in index.scan(text)}, (index.names[t], left)


def test_of_equal_values_more_words_count():
    index = s.Index(s.TEMPLATES)
    for text in (b"licensed under the apache license version yy yy 2", b"this licensed under the gnu general public zz license version 3"):
        assert index.scan(text)
