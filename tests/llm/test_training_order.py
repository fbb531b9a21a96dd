import numpy as np
import public_tokenizers
import pytest

from tabulae.llm import training_order as o
from tabulae.llm.common import shared_folder

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("count", [1, 2, 3, 5, 64, 1000, 4097])
def test_slots_are_a_permutation_with_an_inverse(count):
    numbers = np.arange(count)
    slots = o.feistel(numbers, count, 7)
    assert sorted(slots) == list(range(count)) and (o.feistel(slots, count, 7, inverse=True) == numbers).all()
    assert count < 64 or (slots != o.feistel(numbers, count, 8)).any()


def stream(docs):
    with open(PATH, "rb") as f:
        found = o.tokenizer(f.read())
    return np.concatenate([np.append(found.encode_ordinary(t or ""), o.END) for t in docs]).astype("<u2")


def test_shards_hold_every_token_once_and_resume_at_any_slot(spark, odd):
    docs = odd.repartition(3).sortWithinPartitions("doc_id", "text").select("text").collect()
    frame = spark.createDataFrame([(r.text,) for r in docs], "text string").coalesce(1)
    path = shared_folder(spark)
    layout = o.materialise(frame, path, PATH, length=32, key=3, per_shard=100)
    rows = sorted(o.read(spark, path, layout).collect(), key=lambda r: r.sequence)
    assert [r.sequence for r in rows] == list(range(layout["sequences"]))
    tokens = np.concatenate([np.frombuffer(bytes(r.tokens), dtype="<u2") for r in rows])
    expected = stream([r.text for r in docs])
    assert (tokens[:len(expected)] == expected).all() and (tokens[len(expected):] == o.PAD).all()
    assert all(r.n_tokens == 32 for r in rows[:-1]) and all(r.shard == r.slot // 100 and r.byte_offset == r.slot % 100 * layout["stride"] for r in rows)
    assert (o.feistel(np.arange(len(rows)), len(rows), 3) == [r.slot for r in rows]).all()
    part = o.read(spark, path, layout, first=150, stop=321).collect()
    assert sorted(r.slot for r in part) == list(range(150, 321)) and {r.shard for r in part} == {1, 2, 3}


def test_partitions_share_sequences_at_their_borders(spark):
    frame = spark.range(0, 97, 1, 7).selectExpr("CAST(id AS STRING) AS text")
    path = shared_folder(spark)
    layout = o.materialise(frame, path, PATH, length=16, per_shard=4)
    rows = sorted(o.read(spark, path, layout).collect(), key=lambda r: r.sequence)
    tokens = np.concatenate([np.frombuffer(bytes(r.tokens), dtype="<u2") for r in rows])
    expected = stream([str(i) for i in range(97)])
    assert (tokens[:len(expected)] == expected).all()


def test_digest_of_odd_and_empty_tables(spark, odd, none):
    rows = o.ordered_digest(odd, PATH).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows))) and sum(r.n_tokens for r in rows) == len(stream([r.text for r in odd.collect()]))
    assert o.ordered_digest(none, PATH).count() == 0


def test_the_layout_of_the_input_counts(spark):
    """One layout gives the same slots again; the same rows in another order give other sequences of the same tokens."""
    rows = [(str(i) * (i % 50 + 1),) for i in range(300)]
    digest = lambda r: sorted(map(tuple, o.ordered_digest(spark.createDataFrame(r, "text string").coalesce(1), PATH, length=64).collect()))
    assert digest(rows) == digest(rows) != digest(rows[::-1])
    assert sum(r[4] for r in digest(rows)) == sum(r[4] for r in digest(rows[::-1])) == len(stream([t for t, in rows]))
