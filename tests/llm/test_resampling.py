import hashlib
import math
import re
import zlib
from collections import Counter

from tabulae.llm import resampling
from tests_llm_phrase import phrase


def runs(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, Counter(zlib.crc32(" ".join(words[i:i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(words) - n + 1))


def expected(docs, target):
    """Brute force: (id, n_features, weight, score, rank) of every row."""
    everything, wanted = Counter(), Counter()
    for _, text in docs:
        everything.update(runs(text)[1])
    for text in target:
        wanted.update(runs(text)[1])
    s_all, t_all = sum(everything.values()), sum(wanted.values())
    out = []
    for i, text in docs:
        words, found = runs(text)
        weight = sum(n * math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10_000) / ((everything[b] + 1) * (t_all + 10_000)))) for b, n in found.items())
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, sum(found.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= 20])
    may = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(may):
        r.append(place + 1 if place < 5 * len(may) // 100 else None)
    return sorted(repr((*r[:4], r[5] if r[4] else None)) for r in out)


def got(frame):
    return sorted(repr((r.doc_id, r.n_features, r.weight, r.score, r.rank)) for r in frame.collect())


def test_runs_across_blocks_of_words(monkeypatch):
    text = ("One two, THREEé 4five " * 5).encode()
    whole = [list(map(sorted, zip(*[(s, tuple(c)) for s, c in resampling.features(text)])))]
    assert whole
    for block in (1, 2, 3, 7):
        monkeypatch.setattr(resampling, "BLOCK_WORDS", block)
        found = Counter(c % 10_000 for _, crcs in resampling.features(text) for c in crcs)
        assert found == runs(text.decode())[1]


def test_equal_to_brute_force_on_odd_rows(spark, odd):
    target = spark.createDataFrame([(1, phrase(2, 40)), (2, None), (3, ""), (3, phrase(9, 5)), (None, "ab é中")], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(resampling.resample(odd, target)) == expected(rows, [r.text for r in target.collect()])


def test_draw_of_many_rows_with_ties(spark):
    rows = [(i * 1_000_003 - 50_000, phrase(i % 90, 15 + i % 13)) for i in range(400)] + [(7, phrase(3, 30))] * 5
    target = [phrase(5, 60), phrase(17, 44)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    out = resampling.resample(docs, bench).cache()
    assert got(out) == expected(rows, target)
    ids = {r.doc_id for r in out.filter("rank IS NOT NULL").collect()}
    assert {r.doc_id for r in resampling.drawn(docs, bench).collect()} == ids and len(ids) > 5


def test_ids_over_the_whole_range_order_ties(spark):
    keys = [-(1 << 63), -5, 0, 3, (1 << 63) - 1, None]
    fields = resampling._id_fields(-(1 << 63), (1 << 63) - 1)
    frame = spark.createDataFrame([(k,) for k in keys], "id long").select("id", *[c.alias(f"f{i}") for i, (c, _) in enumerate(fields)])
    rows = sorted(frame.collect(), key=lambda r: (r.f0, r.f1))
    assert [r.id for r in rows] == keys and all(0 <= r[f"f{i}"] < 1 << bits for r in rows for i, (_, bits) in enumerate(fields))


def test_empty_tables(spark, none):
    items = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resample(none, items).count() == 0
    one = spark.createDataFrame([(1, phrase(1, 30))], "doc_id long, text string")
    assert got(resampling.resample(one, items)) == expected([(1, phrase(1, 30))], [])
