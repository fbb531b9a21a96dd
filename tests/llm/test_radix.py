import random

import pytest

from tabulae.llm import radix


def test_digits_are_cut_from_neighbouring_fields(spark):
    frame = spark.createDataFrame([(5, 0b1011)], "a long, b long")
    bits = [frame.select(radix.digit_of([("a", 3), ("b", 4)], low, low + 2)).first()[0] for low in (0, 2, 4, 6)]
    assert bits == [0b11, 0b10, 0b01, 0b1]  # 101 1011 from its end, two bits at a time


@pytest.mark.parametrize("digit_bits,per_block", [(2, 7), (5, 3), (12, 64)])
def test_ranks_follow_the_composite_key(spark, digit_bits, per_block):
    rng = random.Random(digit_bits)
    rows = [(rng.choice([0, 0, 0, rng.randrange(1 << 20)]), rng.randrange(300), i) for i in range(500)]
    frame = spark.createDataFrame(rows, "a long, b int, c int").repartition(5)
    out = radix.ranked(frame, [("a", 20), ("b", 9)], "place", digit_bits, per_block).collect()
    assert sorted(r.place for r in out) == list(range(1, 501)) and sorted((r.a, r.b, r.c) for r in out) == sorted(rows)
    keys = [(r.a, r.b) for r in sorted(out, key=lambda r: r.place)]
    assert keys == sorted(keys)


def test_wide_fields_ties_and_empty_tables(spark):
    values = [0, 1, (1 << 62) - 1, 1 << 61, 1 << 32, (1 << 32) - 1, 7, 7, 7]
    out = radix.ranked(spark.createDataFrame([(v,) for v in values], "a long"), [("a", 62)]).collect()
    assert [r.a for r in sorted(out, key=lambda r: r.rank)] == sorted(values)
    same = radix.ranked(spark.createDataFrame([(0,)] * 10, "a long"), [("a", 0)]).collect()
    assert sorted(r["rank"] for r in same) == list(range(1, 11))
    assert radix.ranked(spark.createDataFrame([], "a long"), [("a", 5)]).count() == 0
    with pytest.raises(ValueError):
        radix.ranked(spark.createDataFrame([(1,)], "a long"), [("a", 63)])


def test_one_digit_for_all_rows_is_spread_over_blocks(spark):
    """A key whose rows share every digit still goes through blocks of bounded size."""
    assert radix.block_rows(10) == 256 and radix.block_rows(10**7) == 10**7 // 4096 and radix.block_rows(10**12) == 65536
