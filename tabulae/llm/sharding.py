"""Sharding by balanced label propagation.

Documents that share a link key (by default: the whole text) want to be in one shard.  They are
dealt to shards by row, without regard to their links; propagation gathers them.  Every
round counts the members of each key by shard, adds up these votes (of the keys whose other
members the shard has room for) for each document and lets it ask for the shard with most of
its neighbours.  Requests are granted by gain, the largest
first, as far as the capacity of the wanted shard allows after those who leave it; the grants
come from a table of shards by gain classes, the only thing the driver sees.  Members of one
key with the same gain are granted alike, so that a small group moves as a whole.

The law is ``rows``: shards end with counts at most one apart.  Linked documents stay where
propagation put them, up to the shard's quota; those beyond it and all unlinked documents,
which cost no cut edge anywhere, fill what is left by rank.  Keys with more members than half a
shard (a few per shard at most) are placed before: the largest first, whole into the shard where
least room stays, or, if none has the room, into as few pieces as the emptiest shards allow.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulae.llm.common import discard, written
from tabulae.llm.ranking import buckets_for, ranked

SHARDS = 24
ROUNDS = 10
#: Members of a key that are ranked together, about.
CHUNK = 256
#: Bytes that a document takes besides its text.
OVERHEAD = 8


def size_of(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus the overhead."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def grants(rows: list, quota: list[int]) -> list[tuple[int, int, float]]:
    """(shard, gain class, share of requests granted) from rows (from, to, gain class, documents).

    Rows with from = to are documents that stay.  The granted arrivals of every shard are at
    most its quota, less those who stay, who are refused elsewhere included.
    """
    shards = range(len(quota))
    held = [0] * len(quota)
    asks: dict[tuple[int, int], dict[int, int]] = {}  # by (to, class): documents by the shard they come from
    for r in rows:
        held[r["from"]] += r["n"]
        if r["from"] != r["to"]:
            by = asks.setdefault((r["to"], r["gain"]), {})
            by[r["from"]] = by.get(r["from"], 0) + r["n"]
    share = {k: 1.0 for k in asks}
    for _ in range(100):  # refusing arrivals keeps documents elsewhere: until no shard is overfull
        out = [0.0] * len(quota)
        for k, by in asks.items():
            for s, n in by.items():
                out[s] += share[k] * n
        tight = False
        for j in shards:
            room = quota[j] - (held[j] - out[j])
            for k in sorted((k for k in asks if k[0] == j), key=lambda k: -k[1]):
                n = sum(asks[k].values())
                granted = min(share[k], max(0.0, room / n))
                tight |= granted < share[k] - 1e-9
                share[k] = granted
                room -= granted * n
        if not tight:
            break
    return [(to, gain, share[to, gain]) for to, gain in share]


def packed(sizes: list[tuple[str, int]], quota: list[int]) -> tuple[list[tuple[str, int, int, int, int]], list[int]]:
    """Pieces (key, first rank, rank after the last, shard, first slot) of large keys, and the rows each shard then holds."""
    used = [0] * len(quota)
    pieces = []
    for key, n in sorted(sizes, key=lambda k: (-k[1], k[0])):
        at = 0
        while at < n:
            room = [q - u for q, u in zip(quota, used)]
            whole = [j for j, r in enumerate(room) if r >= n - at]
            j = min(whole, key=lambda j: room[j]) if whole else max(range(len(room)), key=lambda j: room[j])
            end = min(n, at + room[j])
            pieces.append((key, at, end, j, used[j]))
            used[j] += end - at
            at = end
    return pieces, used


def ranked_by_key(df: DataFrame, groups: list[str], buckets: int) -> DataFrame:
    """``df`` (row, key, chunk) with ``rank`` within ``groups``: members of a key in a row, its chunks one after the other.

    Rows are only numbered inside a chunk; keys and chunks are moved on by counts.
    """
    cut = df.withColumn("__bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    chunks = cut.groupBy(*groups, "__bucket", "key", "chunk").agg(F.count("*").alias("__n"))
    whole = chunks.groupBy(*groups, "__bucket").agg(F.sum("__n").alias("__m"))
    before = lambda by, *over: Window.partitionBy(*over).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    first = whole.select(*groups, "__bucket", F.coalesce(F.sum("__m").over(before(["__bucket"], *groups)), F.lit(0)).alias("__first"))
    offsets = chunks.withColumn("__inside", F.coalesce(F.sum("__n").over(before(["key", "chunk"], *groups, "__bucket")), F.lit(0)))
    offsets = offsets.join(first, [*groups, "__bucket"]).select(
        *groups, "key", "chunk", (F.col("__first") + F.col("__inside")).alias("__offset"))
    number = F.row_number().over(Window.partitionBy(*groups, "key", "chunk").orderBy("row")) - 1
    return (cut.drop("__bucket").withColumn("__number", number).join(offsets, [*groups, "key", "chunk"])
            .withColumn("rank", F.col("__offset") + F.col("__number")).drop("__offset", "__number"))


def dealt(links: DataFrame, quota: list[int]) -> DataFrame:
    """The start (row, shard): rows by their own hash, within shares as large as the quotas; it knows no links."""
    lot = F.pmod(F.xxhash64("row"), F.lit(max(1, sum(quota))))
    start = F.lit(len(quota) - 1)
    for j in range(len(quota) - 1, -1, -1):
        start = F.when(lot < sum(quota[:j + 1]), F.lit(j)).otherwise(start)
    return links.select("row").distinct().select("row", start.cast("int").alias("shard"))


def cut_links(links: DataFrame, placed: DataFrame) -> int:
    """Memberships outside the shard that holds most of their key's members."""
    parts = links.join(placed, "row").groupBy("key", "shard").agg(F.count("*").alias("n"))
    return parts.groupBy("key").agg((F.sum("n") - F.max("n")).alias("cut")).agg(F.sum("cut")).first()[0] or 0


def propagate(links: DataFrame, quota: list[int], rounds: int = ROUNDS) -> DataFrame:
    """Shards (row, shard) of the linked documents; ``links``: a written table (row, key), one row per membership."""
    k = len(quota)
    spark = links.sparkSession
    now = written(dealt(links, quota))
    votes = [f"v{j}" for j in range(k)]
    for turn in range(rounds):
        members = links.join(now, "row")
        counts = counted = written(members.groupBy("key").agg(F.count("*").alias("size"), *[
            F.sum((F.col("shard") == j).cast("long")).alias(v) for j, v in enumerate(votes)]))
        # a shard has room for what it doesn't hold of keys that are whole; it gets votes of keys whose rest fits in
        settled = counts.agg(*[F.sum(F.when(F.col(v) == F.col("size"), F.col(v))).alias(v) for v in votes]).first()
        # many keys may eye the same room: a key asks for less of it from round to round, and so for other shards
        fits = [F.col("size") - F.col(v) <= (quota[j] - (settled[v] or 0)) / (turn + 1) for j, v in enumerate(votes)]
        counts = counts.select("key", *[F.when(fit | (F.col(v) == F.col("size")), F.col(v)).otherwise(0).alias(v) for v, fit in zip(votes, fits)])
        total = members.join(counts, "key").groupBy("row").agg(
            F.min("shard").alias("from"), F.min("key").alias("key"), *[F.sum(v).alias(v) for v in votes])
        # most votes, ties by a hash that the members of a key share
        best = F.greatest(*[F.struct(F.col(v).alias("n"), F.xxhash64("key", F.lit(j)).alias("tie"), F.lit(j).alias("to"))
                            for j, v in enumerate(votes)])
        own = F.element_at(F.array(*votes), F.col("from") + 1)
        asked = written(total.withColumn("best", best).select(
            "row", "key", "from", F.when(F.col("best.n") > 0, F.col("best.to")).otherwise(F.col("from")).alias("to"),
            F.floor(F.log2(F.lit(1) + F.col("best.n") - own)).cast("int").alias("gain")))
        flows = asked.groupBy("from", "to", "gain").agg(F.count("*").alias("n")).collect()  # shards x shards x classes
        granted = spark.createDataFrame(grants(flows, quota), "to int, gain int, share double")
        lot = F.pmod(F.xxhash64("key", F.lit(turn)), F.lit(1 << 30)) / float(1 << 30)
        goes = (F.col("from") != F.col("to")) & (lot < F.col("share"))
        after = written(asked.join(F.broadcast(granted), ["to", "gain"], "left").select(
            "row", F.when(goes, F.col("to")).otherwise(F.col("from")).alias("shard")))
        for old in (asked, counted, now):
            discard(old)
        now = after
        if all(r["from"] == r["to"] for r in flows):
            break
    return now


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
          rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: the id, ``size``, ``text_crc32``, ``law`` (rows), ``shard``, ``slot`` (gapless
    from 0 in the shard) and ``grown_shard`` (null under this law).

    Links join equal texts.  A null text is linked with nothing and has the checksum of the
    empty text; empty texts are equal texts.  Repeated rows are rows of their own.  An empty
    table gives an empty result; with fewer rows than shards some shards stay empty.
    """
    text, spark = F.col(f"`{text_col}`"), docs.sparkSession
    rows = written(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), size_of(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("text_key")))
    n = rows.count()
    quota = [n // shards + (j < n % shards) for j in range(shards)]
    sizes = written(rows.groupBy("text_key").agg(F.count("*").alias("members")).filter("members > 1 AND text_key IS NOT NULL"))
    is_large = F.col("members") * 2 > max(1, n // shards)
    pieces, used = packed([tuple(r) for r in sizes.filter(is_large).collect()], quota)  # less than four per shard
    rest = [q - u for q, u in zip(quota, used)]
    # members of a key are ranked in a row, in chunks that no task finds too large
    links = written(rows.join(sizes, "text_key").select(
        "row", "text_key", is_large.alias("large"), F.xxhash64("text_key").alias("key"), F.xxhash64(
            "text_key", F.pmod(F.xxhash64("row", F.lit(2)), F.ceil(F.col("members") / CHUNK))).alias("chunk")))
    at = spark.createDataFrame(pieces, "text_key string, lo long, hi long, shard int, base long")
    large = ranked_by_key(links.filter("large").select("row", "text_key", "key", "chunk"), ["text_key"], 1)
    large = (large.join(F.broadcast(at), "text_key").filter("rank >= lo AND rank < hi")
             .select("row", "shard", (F.col("rank") - F.col("lo") + F.col("base")).alias("slot")))
    links = links.filter("NOT large").select("row", "key", "chunk")
    placed = propagate(links, rest, rounds)
    linked = ranked_by_key(links.join(placed, "row"), ["shard"], buckets_for(n, shards))
    of_shard = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("shard") + 1)
    # a key at the edge of its shard doesn't stay in part
    ends = linked.groupBy("shard", "key").agg(F.max("rank").alias("end"))
    linked = written(linked.join(ends, ["shard", "key"]).withColumn("kept", F.col("end") < of_shard(rest)).select(
        "row", "key", "chunk", "shard", (F.col("rank") + of_shard(used)).alias("slot"), "kept"))
    held = {j: u for j, u in enumerate(used)}
    for r in linked.filter("kept").groupBy("shard").agg(F.count("*").alias("n")).collect():
        held[r["shard"]] += r["n"]
    # keys that found no room come first and stay together, then the rows without links
    over = linked.filter("NOT kept").select("row", "key", "chunk", F.lit(0).alias("all"))
    beyond = over.count()
    over = ranked_by_key(over, ["all"], buckets_for(beyond)).select("row", "rank")
    free = rows.join(sizes, "text_key", "left_anti").select("row", F.lit(0).alias("all"))
    free = ranked(free, ["all"], ["row"], buckets_for(n)).select("row", (F.col("rank") + beyond).alias("rank"))
    pool = over.union(free)
    # the pool's ranks fill the shards one after the other, members of a key in a row
    start, to, first = 0, F.lit(None).cast("int"), F.lit(None).cast("long")
    for j in range(shards):
        need = quota[j] - held[j]
        here = (F.col("rank") >= start) & (F.col("rank") < start + need)
        to = F.when(here, F.lit(j)).otherwise(to)
        first = F.when(here, F.lit(held[j] - start)).otherwise(first)
        start += need
    pool = pool.select("row", to.alias("shard"), (F.col("rank") + first).alias("slot"))
    slots = linked.filter("kept").select("row", "shard", "slot").union(large).union(pool)
    return rows.join(slots, "row").select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
