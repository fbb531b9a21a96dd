"""Ranks of all rows by a least-significant-digit radix sort over Spark shuffles.

The fields of a composite key are one row of bits, the last field's lowest bit first.  Each
pass takes the next ``DIGIT_BITS`` of them as its digit and is a stable counting sort: rows
stand at places, places are cut into blocks, every block counts its digits, and prefix sums of
these counts (over the digits, and over the blocks within a digit) give each block the place
where its rows with a digit go on; a row's place adds its number among the block's rows with
that digit.  After the last pass the place is the rank.

A block has a bounded number of rows whatever the key holds, so a digit that most rows share
is as good as any other.  Each pass moves the rows once, by block, and is a written table.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulae.llm.common import discard, written

#: Bits of a digit: a pass has at most 2 ** DIGIT_BITS of them, whose totals the driver sums up.
DIGIT_BITS = 12
#: Rows of a block: one part in so many of all, within these bounds.
BLOCKS, LEAST_ROWS, MOST_ROWS = 4096, 256, 65536


def digit_of(fields: list[tuple[str, int]], low: int, high: int) -> Column:
    """Bits ``low`` to ``high`` (excluded) of the composite key; fields are (column, bits), the most significant first."""
    parts, at = [], 0
    for name, bits in reversed(fields):
        first, last = max(low, at), min(high, at + bits)
        if first < last:
            part = F.shiftright(F.col(f"`{name}`").cast("long"), first - at).bitwiseAND(F.lit((1 << last - first) - 1))
            parts.append(F.shiftleft(part, first - low))
        at += bits
    out = parts[0] if parts else F.lit(0).cast("long")
    for part in parts[1:]:
        out = out.bitwiseOR(part)
    return out.cast("int")


def block_rows(rows: int) -> int:
    return min(MOST_ROWS, max(LEAST_ROWS, rows // BLOCKS))


def ranked(rows: DataFrame, fields: list[tuple[str, int]], name: str = "rank", digit_bits: int = DIGIT_BITS,
           per_block: int | None = None) -> DataFrame:
    """``rows`` with ``name``: 1, 2, 3, ... in ascending order of the key.

    ``fields`` are columns of whole numbers and their bits, the most significant first; each value
    must be at least 0, below 2 ** bits (at most 62) and not null.  Rows with equal keys get
    different ranks, in any order among them.  Columns that begin with ``__radix`` are in use
    here.  An empty table stays empty.
    """
    if bad := [f for f in fields if not 0 <= f[1] <= 62]:
        raise ValueError(f"fields must have 0 to 62 bits: {bad}")
    total = sum(bits for _, bits in fields)
    now = written(rows.withColumn("__radix_place", F.monotonically_increasing_id()))
    size = per_block or block_rows(now.count())
    passes = max(1, -(-total // digit_bits))
    width = max(1, -(-total // passes))
    for low in range(0, max(1, total), width):
        cut = now.withColumn("__radix_block", F.expr(f"__radix_place div {size}")).withColumn(
            "__radix_digit", digit_of(fields, low, min(low + width, total)))
        counts = written(cut.groupBy("__radix_block", "__radix_digit").agg(F.count("*").alias("__radix_n")))
        totals = sorted(counts.groupBy("__radix_digit").agg(F.sum("__radix_n")).collect())  # at most 2 ** digit_bits rows
        bases, base = [], 0
        for digit, n in totals:
            bases.append((digit, base))
            base += n
        first = F.broadcast(now.sparkSession.createDataFrame(bases, "__radix_digit int, __radix_base long"))
        before = Window.partitionBy("__radix_digit").orderBy("__radix_block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (counts.withColumn("__radix_before", F.coalesce(F.sum("__radix_n").over(before), F.lit(0))).join(first, "__radix_digit")
                   .groupBy("__radix_block").agg(F.map_from_entries(F.collect_list(F.struct(
                       "__radix_digit", (F.col("__radix_base") + F.col("__radix_before")).alias("o")))).alias("__radix_offsets")))
        # both sides stand by block: rows move once
        number = F.row_number().over(Window.partitionBy("__radix_block", "__radix_digit").orderBy("__radix_place"))
        placed = cut.repartition("__radix_block").withColumn("__radix_number", number).join(offsets, "__radix_block")
        after = written(placed.withColumn("__radix_place", F.expr("element_at(__radix_offsets, __radix_digit) + __radix_number - 1"))
                        .select(*now.columns))
        discard(now)
        discard(counts)
        now = after
    return now.withColumn(name, F.col("__radix_place") + 1).drop("__radix_place")
