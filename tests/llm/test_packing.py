import math
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabulae.llm import packing
from tests_llm_phrase import phrase

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_library_on_every_code_point_and_on_special_strings(library):
    encoder = packing.Encoder(packing.vocabulary(PATH)[0])
    texts = [f"a{chr(c)}b 1{chr(c)}2 {chr(c)}{chr(c)}! \n{chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    step = 64  # many code points in one text, a space between them
    texts = [" ".join(texts[i:i + step]) for i in range(0, len(texts), step)]
    texts += ["a<|endoftext|> b <|endoftext|><|endoftext|>\n", "<|endoftext|>", "<|endoftext|", "", "  \n\t x  "]
    for text in texts:
        assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids


def checked(rows, texts, library, window):
    """All laws of the contract; returns the tokens that padding would take."""
    ids = {k: (library.encode(t or "", add_special_tokens=False).ids + [0]) for k, t in texts.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        tokens = np.frombuffer(bytes(r.tokens), dtype="<u4").tolist()
        assert r.length == len(tokens) > 0 and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for key, expected in ids.items():
        joined = []
        for start, tokens in sorted(pieces[key]):
            assert start == len(joined)
            joined += tokens
        assert joined == expected
    waste = 0
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= window
        waste += window - at if at & at - 1 else 0
    return waste


def test_every_id_in_one_piece_and_little_padding(spark, library):
    texts = {i: phrase(i % 40, 1 + i * 37 % 400) for i in range(150)} | {500: None, 501: "", 502: phrase(9, 30_000)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    rows = packing.pack(docs, PATH, shard_tokens=30_000).collect()
    shards = {r.sequence_id >> 32 for r in rows}
    assert checked(rows, texts, library, 1024) <= 1023 * len(shards) and len(shards) > 3
    again = packing.pack(docs.repartition(2).orderBy("text"), PATH, shard_tokens=30_000).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_a_hot_key_is_dealt_over_shards(spark, library):
    texts = {i: phrase(1, 200) for i in range(60)}
    rows = packing.pack(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), PATH, shard_tokens=8000).collect()
    checked(rows, texts, library, 1024)
    assert len({r.sequence_id >> 32 for r in rows}) >= 4


def test_shards_take_keys_in_order():
    found = packing.shards_of([(0, 5), (2, 6), (3, 25), (4, 1), (5, 9)], 10)
    assert found == [(0, 0, 1), (2, 1, 1), (3, 2, 3), (4, 5, 1), (5, 5, 1)]


def brute_scores(docs, stats, seed, most):
    """BM25 with plain dictionaries."""
    holders, rows, mean, _ = stats
    tf = [Counter(d[:-1].tolist()) for d in docs]
    weight = lambda i, t: math.log1p((rows - holders[t] + 0.5) / (holders[t] + 0.5)) * tf[i][t] * 2.2 / (
        tf[i][t] + 1.2 * (0.25 + 0.75 * len(docs[i]) / mean))
    query = sorted(tf[seed], key=lambda t: -weight(seed, t))[:most]
    return [sum(weight(i, t) for t in query if t in tf[i]) for i in range(len(docs))]


def test_neighbours_and_windows_against_brute_force():
    rng = np.random.default_rng(4)
    docs = [np.append(rng.choice(np.arange(20) + 20 * rng.integers(0, 6), rng.integers(5, 60)), 0).astype("<u2") for _ in range(60)]
    holders = np.zeros(200, dtype=np.int64)
    for d in docs:
        holders[np.unique(d[:-1])] += 1
    stats = (holders, len(docs), float(np.mean([len(d) for d in docs])), 0)
    index = packing.Index(docs, packing.Weights(stats), query_tokens=1000)
    for seed in range(0, 60, 7):
        assert np.allclose(index.scores(seed), brute_scores(docs, stats, seed, 1000), rtol=1e-5)
    # each window: the seed is the longest rest, neighbours come by score, the first that doesn't fit is cut
    left, start = [len(d) for d in docs], [0] * len(docs)
    order = sorted(range(60), key=lambda i: -left[i])
    for pieces in packing.fill([len(d) for d in docs], index.neighbours, 64):
        seed = pieces[0][0]
        assert seed == next(i for i in order if left[i])
        scores, gap = index.scores(seed), 64
        for i, at, n in pieces:
            assert at == start[i] and 0 < n <= left[i] and (n == left[i] or n == gap)
            start[i], left[i], gap = start[i] + n, left[i] - n, gap - n
        whole = [i for i, _, _ in pieces[1:] if not left[i]]
        if gap == 0 and len(whole) > 1:
            picked = [scores[i] for i in whole if scores[i] > 0]
            assert picked == sorted(picked, reverse=True)
        assert gap == 0 or not any(left)
    assert not any(left)


def test_related_documents_share_windows(spark):
    """Three topics with words of their own: nearly all pairs of documents in a window have one topic."""
    topics = [["river", "water", "boat"], ["stone", "mountain", "rock"], ["bread", "flour", "oven"]]
    texts = [(i, " ".join((topics[i % 3] * 12)[i % 5:30 + i % 5])) for i in range(90)]
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string"), PATH, window=64).collect()
    windows = defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append(r.doc_id % 3)
    mixed = sum(len(set(w)) > 1 for w in windows.values())
    assert mixed <= 3 < len(windows)


def test_odd_rows_and_empty_tables(spark, odd, none, library):
    rows = packing.pack(odd, PATH).collect()
    assert sum(r.length for r in rows) == sum(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd.collect())
    assert sum(r.doc_id is None for r in rows) >= 2 and packing.pack(none, PATH).count() == 0
