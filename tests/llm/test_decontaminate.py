import re

from tabulae.llm.decontaminate import clean, decontaminate
from tests_llm_phrase import phrase


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", low)


def brute(docs, items, window=13):
    out = {}
    for i, text in docs:
        w, hit, names = words(text), set(), set()
        for item, t in items:
            x = words(t)
            size = min(window, len(x))
            wins = {tuple(x[k:k + size]) for k in range(len(x) - size + 1)} if size else set()
            for k in range(len(w) - size + 1 if size else 0):
                if tuple(w[k:k + size]) in wins:
                    hit.update(range(k, k + size))
                    names.add(str(item))
        out[i] = (len(w), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(w))
    return out


ITEMS = [(1, phrase(11, 40)), (2, "Kurze Frage, été?"), (3, None), (4, ""), (10, phrase(11, 40)), (12, phrase(12, 13))]
DOCS = [
    (1, phrase(1, 30) + " -- " + phrase(11, 40).upper().replace(" ", "\n, ") + phrase(2, 5)),
    (2, "was: KURZE frage... été! " + phrase(3, 10)), (3, "xkurze frage été"), (4, None), (5, ""),
    (6, phrase(5, 900) + " " + phrase(12, 13)), (7, phrase(12, 13) * 2), (8, " ".join(phrase(12, 13).split()[:12])),
    (9, phrase(11, 20) + " " + phrase(12, 13) + " " + phrase(11, 40)),
]


def check(spark, **options):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = decontaminate(docs, items, **options).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in rows} == brute(DOCS, ITEMS)
    return {r.doc_id: r for r in rows}


def test_matches_brute_force_and_maps_spans_to_the_text(spark):
    rows = check(spark)
    texts = dict(DOCS)
    assert [texts[2][s.start:s.end] for s in rows[2].spans] == ["KURZE frage... été"]
    assert words(texts[1][rows[1].spans[0].start:rows[1].spans[0].end])[0] == words(ITEMS[0][1])[0]


def test_blocks_of_a_large_benchmark_give_the_same(spark):
    check(spark, block_bytes=64)


def test_odd_rows_and_empty_tables(spark, odd, none):
    items = spark.createDataFrame(ITEMS + [(None, "one two")], "item_id long, text string")
    rows = decontaminate(odd, items).collect()
    assert len(rows) == odd.count()
    short = next(r for r in rows if r.doc_id == 8)
    assert (short.n_hit, short["items"], short.contaminated) == (2, [], True)  # an item without an id marks words only
    assert all(r.n_words == 0 and not r.contaminated for r in rows if r.doc_id in (3, 4, 5, 9))
    kept = clean(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert decontaminate(none, items).count() == 0
    assert not any(r.n_hit for r in decontaminate(odd, items.limit(0)).collect())
