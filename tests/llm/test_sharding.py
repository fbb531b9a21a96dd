import zlib
from collections import Counter, defaultdict

from tabulae.llm.ranking import ranked
from tabulae.llm.sharding import cut_links, dealt, grants, propagate, shard
from tabulae.llm.common import written
from tests_llm_phrase import phrase


def test_counts_slots_sizes_and_groups(spark):
    docs, n = [], 0
    for g in range(60):
        for _ in range(1 + g % 5):
            docs.append((n, phrase(g, 5)))
            n += 1
    docs += [(n + i, "the same é") for i in range(200)] + [(900 + i, None) for i in range(10)]
    docs += [(2000 + i, phrase(1000 + i, 4)) for i in range(300)]
    rows = shard(spark.createDataFrame(docs, "doc_id long, text string"), shards=7).collect()
    assert len(rows) == len(docs)
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    text = dict(docs)
    for r in rows:
        blob = (text[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(blob) + 8, zlib.crc32(blob), "rows", None)
    groups = defaultdict(set)
    for r in rows:
        if text[r.doc_id] and text[r.doc_id] != "the same é":
            groups[text[r.doc_id]].add(r.shard)
    assert sum(len(s) > 1 for s in groups.values()) <= 3  # at most the cut where a shard is full


def test_odd_rows_and_few_rows(spark, odd, none):
    rows = shard(odd).collect()
    assert len(rows) == odd.count() and max(Counter(r.shard for r in rows).values()) == 1
    assert shard(none).count() == 0


def test_propagation_gathers_a_graph_of_several_keys(spark):
    # two cliques that hang together by one document with both keys
    links = [(i, 1) for i in range(6)] + [(i, 2) for i in range(5, 11)]
    placed = propagate(written(spark.createDataFrame(links, "row long, key long")), [12, 12])
    at = {r.row: r.shard for r in placed.collect()}
    assert len(at) == 11 and max(Counter(at.values()).values()) <= 11
    assert len({at[i] for i in range(5)}) == 1 and len({at[i] for i in range(6, 11)}) == 1


def test_grants_keep_the_quota():
    flows = [{"from": 0, "to": 0, "gain": 0, "n": 50}, {"from": 1, "to": 0, "gain": 3, "n": 30}, {"from": 1, "to": 0, "gain": 1, "n": 40},
             {"from": 0, "to": 1, "gain": 2, "n": 10}]
    share = {(to, gain): s for to, gain, s in grants(flows, [85, 85])}
    assert share[0, 3] == 1.0 and share[1, 2] == 1.0 and abs(share[0, 1] - 5 / 40) < 1e-6


def test_ranks_are_gapless(spark):
    df = spark.createDataFrame([(i % 3, i // 7, i) for i in range(500)], "g int, k long, i long")
    found = defaultdict(list)
    for r in ranked(df, ["g"], ["k", "i"], 5).collect():
        found[r.g].append((r["rank"], r.k))
    for rows in found.values():
        rows.sort()
        assert [x for x, _ in rows] == list(range(len(rows)))
        ks = [k for _, k in rows]
        assert len(set(ks)) == 1 + sum(a != b for a, b in zip(ks, ks[1:]))  # equal keys stand together


def test_keys_up_to_a_shard_stay_whole_and_larger_ones_take_few_shards(spark):
    docs, n = [], 0
    for g, members in enumerate([80, 25, 24, 20, 18, 15, 14, 13, 3, 2, 2]):  # quota 25
        docs += [(n + i, phrase(g, 5)) for i in range(members)]
        n += members
    docs += [(n + i, phrase(1000 + i, 4)) for i in range(300 - n)]
    rows = shard(spark.createDataFrame(docs, "doc_id long, text string"), shards=12).collect()
    assert set(Counter(r.shard for r in rows).values()) == {25} and len({(r.shard, r.slot) for r in rows}) == 300
    text, at = dict(docs), defaultdict(set)
    for r in rows:
        at[text[r.doc_id]].add(r.shard)
    assert [len(at[phrase(g, 5)]) for g in range(11)] == [4] + [1] * 10


def test_propagation_moves_rows_and_cuts_fewer_links(spark):
    links = written(spark.createDataFrame([(7 * g + i, g) for g in range(120) for i in range(2 + g % 6)], "row long, key long"))
    n, quota = links.count(), [100] * 7
    assert n <= sum(quota)
    before, after = dealt(links, quota), propagate(links, quota)
    start, end = ({r.row: r.shard for r in f.collect()} for f in (before, after))
    assert start.keys() == end.keys() and len(start) == n
    at = defaultdict(Counter)
    for r in links.collect():
        at[r.key][start[r.row]] += 1
    assert cut_links(links, before) == sum(sum(c.values()) - max(c.values()) for c in at.values()) > n // 4
    assert cut_links(links, after) <= n // 50
    assert sum(start[r] != end[r] for r in start) > n // 4 and max(Counter(end.values()).values()) <= 110
