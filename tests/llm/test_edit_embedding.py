import hashlib
import random

import numpy as np
import pyarrow as pa

from tabulae.llm import edit_embedding as e
from tests_llm_phrase import phrase


def slow_fingerprint(walker, drawn, text):
    """The whole embedding place by place, then for every sample the last record below its length."""
    embedded = []
    for ch in text:
        c = int(e.mixed(np.uint64([ord(ch)]))[0]) % e.CLASSES
        j = len(embedded)
        embedded += [ord(ch)] * walker.stays[c][j % e.PERIOD]
    digits = [0] * walker.size
    for place, k in drawn:
        if place < len(embedded):
            digits[k] = int(e.mixed(np.uint64([place << 21 ^ embedded[place]]))[0] >> np.uint64(60))
    return digits


def test_walks_in_parts_equal_the_whole_embedding(monkeypatch):
    drawn = e.records(16)
    walker = e.Walker(drawn)
    monkeypatch.setattr(e, "CHUNK", 7)
    for text in ("", "a", "é中😀", phrase(3, 40)):
        whole = walker.walk(walker.start(), text)[1]
        assert whole.tolist() == slow_fingerprint(walker, drawn, text)
        half = walker.walk(walker.start(), text[:5])
        assert (walker.walk(half, text[5:])[1] == whole).all()


def test_samples_are_uniform_over_the_text():
    drawn, length = e.records(400), 5000
    last = {}
    for place, k in drawn:
        if place < length:
            last[k] = place
    assert len(last) == 400 and abs(np.mean(list(last.values())) / length - 0.5) < 0.06


def test_few_edits_change_few_digits():
    walker, rng = e.Walker(e.records()), random.Random(4)
    text = phrase(8, 300)
    mine = walker.walk(walker.start(), text)[1]
    near = []
    for _ in range(30):
        at = rng.randrange(len(text))
        near.append(e.likeness(mine, walker.walk(walker.start(), text[:at] + "q" + text[at:])[1]))
    other = e.likeness(mine, walker.walk(walker.start(), phrase(9, 300))[1])
    assert np.mean(near) > 0.8 > 0.4 > other


def brute(docs):
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), d[1] or ""))
    walker = e.Walker(e.records())
    prints = [walker.walk(walker.start(), d[1] or "")[1] for d in order]
    out = []
    for i, (doc, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        edited = text[:len(text) - len(text) // 3] + after[:len(text) // 3]
        ep = walker.walk(walker.start(), edited)[1]
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), e.printed(prints[i]), e.printed(ep),
                    e.likeness(prints[i], ep), e.likeness(prints[i], prints[(i + 1) % len(order)])))
    return sorted(map(str, out))


def test_neighbours_equal_brute_force_over_many_ranges(spark):
    docs = [(i * 5 % 61 * 3, phrase(i, 3 + i % 20)) for i in range(61)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for bucket in (4, 1000):
        assert sorted(str(tuple(r)) for r in e.neighbours_compared(frame, bucket_rows=bucket).collect()) == brute(docs)


def test_odd_rows(spark, odd, none):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    for bucket in (2, 512):
        assert sorted(str(tuple(r)) for r in e.neighbours_compared(odd, bucket_rows=bucket).collect()) == brute(docs)
    one = odd.filter("doc_id = 10")
    assert e.neighbours_compared(one).first().near_next == 1.0
    assert e.neighbours_compared(none).count() == 0
    assert {r.fingerprint for r in e.fingerprints(odd).filter("n_chars = 0").collect()} == {"0" * e.SAMPLES}


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_edit_distance():
    rng = random.Random(6)
    for _ in range(300):
        a, b = ("".join(rng.choice("abé") for _ in range(rng.randrange(12))) for _ in range(2))
        assert e.distance(a, b) == plain_distance(a, b)


def test_near_texts_find_edited_copies_and_leave_others(spark, odd, none):
    rng, docs = random.Random(8), []
    for g in range(8):
        text = phrase(40 + g, 30)
        for k in range(4):
            edited = list(text)
            for _ in range(k * 2):
                edited[rng.randrange(len(edited))] = rng.choice("qvz ")
            docs.append((g * 10 + k, "".join(edited)))
    rng.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = e.near_texts(frame).collect()
    assert {r.doc_id: r.group_id for r in rows} == {i: i // 10 * 10 for i, _ in docs}
    rows = e.near_texts(odd).collect()
    assert len(rows) == odd.count() and {r.group_id for r in rows if r.doc_id in (3, 4, 5)} == {3, 4, 5}
    assert e.near_texts(none).count() == 0


def edited_copy(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        chars[at:at + 1] = rng.choice(([rng.choice("abcdef ")], [], [chars[at], rng.choice("abcdef ")]))
    return "".join(chars)


def test_long_near_texts_with_many_edits_share_a_group_in_the_query(spark, scratch):
    from tabulae.llm.queries import QUERIES

    rng, docs = random.Random(5), []
    for g, words in enumerate((10, 100, 400, 400, 1000)):
        text = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 10))) for _ in range(words))
        copies = [text] + [edited_copy(rng, text, int(rate * len(text))) for rate in (0.05, 0.1, 0.19)]
        assert all(e.distance(text, c) <= 0.2 * max(len(text), len(c)) for c in copies)
        docs += [(g + 10 * k, c) for k, c in enumerate(copies)]
    docs += [(90, ""), (91, None), (92, docs[0][1])]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{scratch}/documents.parquet")
    rows = QUERIES["op10_edit_fingerprint"](spark, scratch).collect()
    assert {r.doc_id: r.group_id for r in rows} == {i: 0 if i == 92 else i if i > 89 else i % 10 for i, _ in docs}


def test_distance_may_stop_above_a_limit():
    rng = random.Random(7)
    for _ in range(300):
        a, b = ("".join(rng.choice("abé") for _ in range(rng.randrange(15))) for _ in range(2))
        most, exact = rng.randrange(8), plain_distance(a, b)
        assert min(e.distance(a, b, most), most + 1) == min(exact, most + 1)


def test_a_bound_from_kept_stretches_and_probes():
    rng = random.Random(11)
    text = phrase(70, 900)
    assert len(text) > e.PROBED
    for rate in (0.01, 0.05, 0.1):
        other = edited_copy(rng, text, int(rate * len(text)))
        most, exact = len(text) // 5, e.distance(text, other)
        bound = e.bridged(text, other, most)
        assert bound is None or exact <= bound <= most
        assert rate > 0.01 or bound is not None
        assert not e.probed(text, other, most) and e.close(text, other, e.NEAR)
    far = "".join(rng.choice("abcdefgh ") for _ in text)
    assert e.probed(text, far, len(text) // 5) and not e.close(text, far, e.NEAR)


def test_packed_texts_come_back(spark, odd):
    rows = odd.filter("text IS NOT NULL").select("text", e.packed("text").alias("packed")).collect()
    assert rows and all(e.unpacked(r.packed) == r.text for r in rows)


def test_a_common_footer_makes_pairs_in_proportion_to_the_texts(spark, monkeypatch):
    """The rows of the buckets go through one shuffle; texts that share a bucket are paired with their neighbours only."""
    rng, sent = random.Random(12), []
    footer = "all rights reserved by the makers of these texts."
    docs = [(i, "".join(rng.choice("abcdefghijklmnopqrst ") for _ in range(60)) + footer) for i in range(200)]
    verified = e.verified

    def counted(pairs, texts, near):
        sent.append(pairs.count())
        return verified(pairs, texts, near)

    monkeypatch.setattr(e, "verified", counted)
    e.near_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sent and sum(sent) < 2 * (e.NEIGHBOURS + 1) * len(docs)


def test_the_session_keeps_its_setting(spark, odd):
    before = spark.conf.get(e.CLEANED)
    e.near_groups(odd)
    assert spark.conf.get(e.CLEANED) == before


def test_an_id_with_two_texts_joins_their_groups(spark):
    one, two = phrase(80, 40), phrase(81, 40)
    docs = [(3, one), (5, one), (5, two), (9, two), (11, phrase(82, 40))]
    rows = e.near_texts(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.group_id) for r in rows} == {(3, 3), (5, 3), (9, 3), (11, 11)}


def crowded_texts():
    """A near pair that meets only in a footer, which many other texts of lengths between theirs have too."""
    rng = random.Random(21)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(n))
    footer, body = "uvwxyz 0123456789 uvwzyx 9876543210 zyx uwvy 1357924680 xwvu 86420 97531 vxz", word(48)
    edited = "0123" + "".join("z" if i % 3 == 0 else c for i, c in enumerate(body))
    docs = [(1, body + footer), (2, edited + footer)]
    docs += [(10 + i, word(42 if i < 3 else 49 + i % 3) + footer) for i in range(33)]
    return docs


def test_near_texts_meet_in_a_bucket_however_many_lie_between(spark):
    docs = crowded_texts()
    a, b = docs[0][1], docs[1][1]
    assert e.distance(a, b) <= 0.2 * len(b) and sum(len(a) < len(t) < len(b) for _, t in docs) > 3 * e.NEIGHBOURS
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for crowd in (e.CROWD, 7):  # one task for a bucket, or several
        rows = {r.key: r.group for r in e.near_groups(frame, crowd=crowd).collect()}
        assert rows == {hashlib.md5(t.encode()).hexdigest(): 1 for t in (a, b)}


def test_the_second_pass_makes_all_pairs_of_a_bucket_in_other_groups():
    rng = random.Random(22)
    rows = sorted((band, 0, (100 + rng.randrange(12)) << 32 | rng.randrange(2) << 30, node, rng.choice([None, None, 7, 8]), 0)
                  for band, many in ((4, 40), (8, 1), (12, 3)) for node in range(many))
    rows = [r for r in rows for _ in range(1 + r[3] % 2)]  # equal texts
    names = ["band", "part", "at", "node", "of", "side"]
    columns = [pa.array([r[names.index(c)] for r in rows], pa.int64()) for c in ("band", "node", "at", "of", "part", "side")]
    whole = pa.RecordBatch.from_arrays(columns, names=["band", "node", "at", "of", "part", "side"])
    expected = set()
    for x in rows:
        for y in rows:
            b = e.Bucketed(np.array([x[0], y[0]]), np.array([x[3], y[3]]), np.array([x[2], y[2]]), e.NEAR)
            if x[0] == y[0] and x[3] < y[3] and b.meet(np.array([0]), np.array([1]))[0] and (x[4] is None or x[4] != y[4]):
                expected.add((x[3], y[3], x[0] & 3))
    for size in (1, 7, len(rows)):
        out = [p for b in e._crossing(e.NEAR)(whole.slice(k, size) for k in range(0, len(rows), size))
               for p in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), (b.column("met").to_numpy() >> 62 & 3).tolist())]
        assert set(out) == expected and len(expected) > 100


def test_shapes_rule_out_no_near_text():
    rng = random.Random(23)
    for words in (1, 3, 20, 60, 100, 130, 300):
        text = phrase(words, words)
        for rate in (0.0, 0.05, 0.1, 0.2):
            other = edited_copy(rng, text, int(rate * len(text)))
            if e.close(text, other, e.NEAR):
                assert e.plausible(e.shape(text), e.shape(other), e.NEAR)
    far = ["".join(rng.choice(letters) for _ in range(100)) for letters in ("abcdefgh", "ijklmnop")]
    assert not e.plausible(*(e.shape(t) for t in far), e.NEAR)


def test_rows_of_large_buckets_go_on_whatever_the_batches():
    rng = random.Random(24)
    rows = sorted((band, rng.randrange(50) << 32, node) for band in range(40) for node in range(rng.choice((1, 3, 9, 10, 11, 30))))
    sizes = {band: sum(r[0] == band for r in rows) for band in range(40)}
    expected = [r for r in rows if sizes[r[0]] > e.NEIGHBOURS + 1]
    rows = [r for r in rows for _ in range(1 + r[2] % 3)]  # equal texts
    whole = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 2, 1)], names=["band", "node", "at"])
    for size in (1, 2, 9, 10, 13, 100, len(rows)):
        out = [r for b in e._large(whole.slice(k, size) for k in range(0, len(rows), size)) for r in zip(*(c.to_pylist() for c in b.columns))]
        assert sorted(out) == sorted((band, node, at) for band, at, node in expected)
