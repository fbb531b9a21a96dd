"""Document fingerprints by a randomised embedding of edit distance into Hamming distance.

All texts share one random walk: at step ``j`` the walker copies the character it stands on to
place ``j`` of the embedding and goes on to the next character or stays, as a random bit that
depends on ``j`` and the character says.  Two texts that differ by a few edits fall into step
again soon after each edit, so that their embeddings differ in few places.

A fingerprint samples ``SAMPLES`` places.  Sample ``k`` takes the place whose random number is
the least among the places that the walk has reached; so texts of different lengths mostly
sample the same places.  Only the places at which a new least number comes up (the records)
matter; they are drawn on the driver and broadcast.  A sample is four bits of a hash of the
place and the character there, one hexadecimal digit.  The likeness of two fingerprints is
the share of equal digits.

Near texts (``near_groups``): two walks over long near texts stay out of step for long stretches,
so the walk starts anew at anchors that the content names: of all pieces of a few characters
(the longer the text, the longer the piece) those with the least hashes.  A band is the digits at
sampled places of one piece's walk, and classes of equal texts that agree on a band share a
bucket.  A first pass pairs a text with the shortest one of its bucket and with the ``NEIGHBOURS`` next in
length, which links most near texts.  A second pass pairs every text with all others of its buckets
that lie in other groups; large buckets are dealt to several tasks.  A pair is compared by its edit distance
if the bands that made it lie where so few edits leave them and spread over the text, so that one common line
isn't enough, and if, from ``SKETCHED`` characters on, their sketches, below it their pairs of neighbouring
characters, and from ``PROBED`` on, probes agree as near texts' do.  See ``recall`` in the README.
"""
from __future__ import annotations

import array
import bisect
import contextlib
import functools
import hashlib
import itertools
import math
import os
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tabulae.llm import near_dup
from tabulae.llm.common import built, discard, ship, written
from tabulae.llm.components import components
from tabulae.llm.near_dup import NO_ID, mixed, row_id, verified

SAMPLES = 128
SEED = 20240501
#: The walk's bits repeat after so many steps; characters fall into so many classes.
PERIOD, CLASSES = 1 << 16, 64
#: Characters that are walked before their sampled places are looked up, and the most steps on one character.
CHUNK, LONGEST_STAY = 1 << 12, 32
#: Texts are near if their edit distance is at most one less this, times the longer length.
NEAR = 0.8
#: Characters of a piece, lengths of the texts that have such pieces (two near texts share a row), and the share of the
#: text, one part in so many, over which common bands spread (0: one band is enough).
PIECES = ((2, 1, 32, 0), (5, 24, 128, 0), (8, 100, 640, 8), (12, 512, 1 << 62, 8))
#: Bands of a text and kind of piece, and digits of a band.
BANDS, BAND_DIGITS = 112, 16
#: Texts from this length on have a sketch, of so many cells, each with the least of its pieces of so many characters;
#: near texts agree in this share of them, far more than others.
SKETCHED, CELLS, SKETCH_PIECE, ALIKE = 512, 512, 8, 0.06
#: Texts from this length on are probed by so many parts of so many characters before the whole distance is computed, and
#: aren't near if these tell of so many times the edits that near texts may have.
PROBED, PROBES, PROBE, SURE = 2048, 16, 64, 1.5
#: Pieces that are walked together.
WALKED = 1 << 14
#: Texts before it in its bucket with which the first pass pairs a text, besides the first one.
NEIGHBOURS = 8
#: Texts of a bucket above which the second pass deals its pairs to several tasks, each with about twice so many texts at most.
CROWD = 2048
#: Pairs that go out together.
PAIRED = 1 << 16
#: Hexadecimal digits of a text's MD5 digest that stand for it in buckets.
CODE = 12
#: Spark's setting by which a query deletes its shuffle files when it ends.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of a bucket of neighbouring ids, about, and the most buckets (their bounds are broadcast).
BUCKET_ROWS, MOST_BUCKETS = 512, 16384


def records(samples: int = SAMPLES, seed: int = SEED, limit: int = 1 << 44) -> list[tuple[int, int]]:
    """(place, sample) pairs in order of places: where a sample's least number so far comes up."""
    out = []
    for k in range(samples):
        rng = random.Random(seed * 1_000_003 + k)
        place, least = 0, rng.random()
        while place < limit:
            out.append((place, k))
            place += 1 + int(math.log(1.0 - rng.random()) / math.log1p(-least))  # a geometric wait
            least *= rng.random()
            if least < 1e-15:
                break
    return sorted(out)


class Walker:
    """One shared walk (``number`` tells independent walks apart) and the sampled places."""

    def __init__(self, drawn: list[tuple[int, int]], number: int = 0):
        self.places = np.array([p for p, _ in drawn], dtype=np.int64)
        self.samples = np.array([k for _, k in drawn], dtype=np.int64)
        self.size = int(self.samples.max()) + 1
        j = np.arange(PERIOD, dtype=np.uint64)
        self.stays = []  # by class: steps spent on a character that is reached at step j
        for c in range(CLASSES):
            goes = (mixed(j * np.uint64(CLASSES) + np.uint64(c) + np.uint64(SEED + number << 24)) & np.uint64(1)).astype(bool)
            at = np.flatnonzero(np.concatenate([goes, goes]))
            following = at[np.searchsorted(at, np.arange(PERIOD))]
            self.stays.append(np.resize(following - np.arange(PERIOD) + 1, PERIOD + CHUNK * LONGEST_STAY).astype(np.uint8).tobytes())
            assert max(self.stays[-1][:PERIOD]) <= LONGEST_STAY

    def start(self) -> tuple[int, np.ndarray]:
        """The state before any character: steps so far, and a digit per sample."""
        return 0, np.zeros(self.size, dtype=np.uint8)

    def walk(self, state: tuple[int, np.ndarray], text: str) -> tuple[int, np.ndarray]:
        """The state after some more characters; the given state stays as it is."""
        j, digits = state[0], state[1].copy()
        stays, mask = self.stays, PERIOD - 1
        for at in range(0, len(text), CHUNK):
            points = np.frombuffer(text[at:at + CHUNK].encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
            turn, first = j & ~mask, j
            j &= mask  # the tables reach beyond the period as far as a chunk may go
            after = [j := j + stays[c][j] for c in (mixed(points) & np.uint64(CLASSES - 1)).astype(np.uint8).tobytes()]
            j += turn
            lo, hi = np.searchsorted(self.places, (first, j))
            places = self.places[lo:hi]
            if len(places) < len(after) >> 4:
                here = points[[bisect.bisect_right(after, p) for p in (places - turn).tolist()]]
            else:
                here = points[np.searchsorted(np.frombuffer(array.array("q", after), dtype=np.int64), places - turn, side="right")]
            digits[self.samples[lo:hi]] = (mixed(places.astype(np.uint64) << np.uint64(21) ^ here) >> np.uint64(60)).astype(np.uint8)
        return j, digits


class Bander:
    """Bands of texts: the walks over their pieces of least hash."""

    def __init__(self, bands: int = BANDS):
        self.bands = bands
        self.goes, self.sampled = {}, {}
        for size, *_ in PIECES:
            place = np.arange(2 * size, dtype=np.uint64)[:, None] * np.uint64(CLASSES) + np.arange(CLASSES, dtype=np.uint64)
            self.goes[size] = (mixed(place + np.uint64(SEED << 24)) & np.uint64(1)).astype(np.int64)
            self.sampled[size] = set(random.Random(SEED + size).sample(range(2 * size), min(BAND_DIGITS, 2 * size)))

    @staticmethod
    def hashes(points: np.ndarray, size: int) -> np.ndarray:
        """A hash of every piece of ``size`` code points."""
        total, have = mixed(points), 1
        while have < size:
            step = min(have, size - have)  # pieces of have characters, and those that start step later
            total = (total[:-step] ^ np.uint64(have)) * np.uint64(0x9E3779B97F4A7C15) + (total[step:] ^ total[step:] >> np.uint64(29))
            have += step
        return mixed(total)

    def least(self, points: np.ndarray, size: int) -> np.ndarray:
        """First places of the distinct pieces with the least hashes."""
        size = min(size, len(points))
        found = self.hashes(points, size)
        few = np.flatnonzero(found <= np.uint64(min(1.0, 4 * self.bands / len(found)) * float((1 << 64) - (1 << 12))))
        kept, at = np.unique(found[few], return_index=True)
        if len(kept) >= self.bands:
            return few[at[:self.bands]]
        return np.unique(found, return_index=True)[1][:self.bands]

    def walked(self, pieces: np.ndarray) -> np.ndarray:
        """A 64-bit band per row of code points: the digits at the sampled places of its walk."""
        n, size = pieces.shape
        rows, at, band = np.arange(n), np.zeros(n, dtype=np.int64), np.full(n, size, dtype=np.uint64)
        classes = (mixed(pieces) & np.uint64(CLASSES - 1)).astype(np.int64)
        for place, goes in enumerate(self.goes[size]):
            if place in self.sampled[size]:
                band = band << np.uint64(4) | mixed(np.uint64(place << 21) ^ pieces[rows, at]) >> np.uint64(60)
            at = np.minimum(at + goes[classes[rows, at]], size - 1)
        return mixed(band ^ np.uint64(size << 56))

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(number of the text, characters of a piece, span of its places, band, place) of every band."""
        out = []
        points = [points_of(t) for t in texts]
        for size, low, high, _ in PIECES:
            picked = []
            for i, p in enumerate(points):
                if low <= len(p) < high:
                    at = self.least(p, size)
                    full = np.concatenate([p, np.zeros(size, dtype=np.uint64)]) if len(p) < size else p
                    picked.append((i, at, full[at[:, None] + np.arange(size)]))
            if picked:
                counts = [len(at) for _, at, _ in picked]
                out.append((np.repeat([i for i, _, _ in picked], counts), np.full(sum(counts), size),
                            np.repeat([at.max() - at.min() for _, at, _ in picked], counts),
                            self.walked(np.concatenate([m for *_, m in picked])), np.concatenate([at for _, at, _ in picked])))
        return tuple(np.concatenate(c) for c in zip(*out)) if out else tuple(np.empty(0, dtype=np.int64) for _ in range(5))


def printed(digits: np.ndarray) -> str:
    return (digits[0::2] << 4 | digits[1::2]).tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def drawn_places(spark: SparkSession, samples: int = SAMPLES):
    ship(spark)
    return spark.sparkContext.broadcast(records(samples))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES,
                 walks: int = 1) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_chars`` and ``fingerprint`` (of several walks one after the other); null
    counts as the empty text, whose fingerprint is all zeros.  Equal texts have equal fingerprints; other
    columns are not read."""
    block = drawn_places(docs.sparkSession, samples)

    def walkers_of(drawn: list[tuple[int, int]]) -> list[Walker]:
        return [Walker(drawn, number) for number in range(walks)]

    @F.arrow_udf("struct<n_chars long, fingerprint string>")
    def run(texts: pa.Array) -> pa.Array:
        walkers = built(block, walkers_of)
        rows = [t or "" for t in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([len(t) for t in rows], pa.int64()),
             pa.array(["".join([printed(w.walk(w.start(), t)[1]) for w in walkers]) for t in rows], pa.string())], names=["n_chars", "fingerprint"])

    return docs.select(F.col(f"`{id_col}`").alias(id_col), run(F.col(f"`{text_col}`")).alias("f")).select(id_col, "f.*")


def _compared(block, keyed: bool):
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by bucket in order, the first row of the bucket that follows (``carried``) last."""
        walker = built(block, Walker)
        before = key = None  # the row that waits for its next one, and its text's digest
        for batch in batches:
            out: list[tuple] = []
            for carried, doc, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if carried and before is None:
                    continue
                cut = len(text) - len(text) // 3
                head = walker.walk(walker.start(), text[:cut])
                own = walker.walk(head, text[cut:])[1]
                if before is not None:
                    who, n, their_head, half, theirs = before
                    tail = text[:n // 3]
                    edited = walker.walk(half, tail)[1]
                    digest = hashlib.sha256(their_head.encode("utf-8", "surrogatepass"))
                    digest.update(tail.encode("utf-8", "surrogatepass"))
                    out.append((who, n, digest.hexdigest(), printed(theirs), printed(edited),
                                likeness(theirs, edited), likeness(theirs, own), key))
                key = hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest() if keyed else None
                before = None if carried else (doc, len(text), text[:cut], head, own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(
                    (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.string()))],
                names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "key"])

    return compared


def neighbours_compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES,
                        bucket_rows: int = BUCKET_ROWS, keyed: bool = False) -> DataFrame:
    """Every text's fingerprint against that of its edited text and of the next document.

    The order is by descending id, rows without an id last, equal ids by text; the last row is
    followed by the first.  The edited text has the last third of the characters (rounded down)
    replaced by the first as many of the next text, or all of it.  A null text is empty.  One
    row per row of ``docs``; a single row is followed by itself.  If ``keyed``, a column ``key`` has the
    MD5 digest of the text.

    Texts are shuffled once, into ranges of ids whose bounds come from approximate quantiles;
    each range also gets the first row of the range after it.
    """
    spark = docs.sparkSession
    block = drawn_places(spark, samples)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    ids = rows.select("id")
    parts = min(MOST_BUCKETS, max(1, math.ceil(ids.count() / bucket_rows)))
    cuts = ids.approxQuantile("id", [i / parts for i in range(1, parts)], 0.25 / parts) if parts > 1 else []
    bounds = spark.sparkContext.broadcast(np.unique(np.array(cuts, dtype=np.float64)))

    @F.arrow_udf("int")
    def bucket_of(of: pa.Array) -> pa.Array:
        known = of.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
        return pa.array(np.searchsorted(bounds.value, known.astype(np.float64), side="right"), pa.int32())

    dealt = rows.withColumn("bucket", bucket_of("id"))
    tops = sorted((r["bucket"], r["top"]) for r in ids.withColumn("bucket", bucket_of("id")).groupBy("bucket")
                  .agg(F.max("id").alias("top")).collect())  # one row per bucket
    follows = [(b, t, tops[(i + 1) % len(tops)][0]) for i, (b, t) in enumerate(tops)]
    also = F.broadcast(spark.createDataFrame(follows, "bucket int, top long, goes int"))
    carried = (dealt.join(also, "bucket").filter(F.col("id").eqNullSafe(F.col("top")))
               .select(F.lit(True).alias("carried"), "id", "text", F.col("goes").alias("bucket")))
    both = dealt.select(F.lit(False).alias("carried"), "id", "text", "bucket").union(carried)
    ordered = (both.repartition(max(parts, int(spark.conf.get("spark.sql.shuffle.partitions"))), "bucket")
               .sortWithinPartitions("bucket", "carried", F.desc_nulls_last("id"), "text").drop("bucket"))
    out = ordered.mapInArrow(_compared(block, keyed), "id long, n_chars long, edited_sha256 string, fingerprint string, "
                             "edited_fingerprint string, near_edited double, near_next double, key string")
    return (out if keyed else out.drop("key")).withColumnRenamed("id", id_col)


def distance(a: str, b: str, most: int | None = None) -> int:
    """Edit distance, a column of the table per character of ``b`` as bits of whole numbers (Myers, Hyyro).

    With ``most`` some number above it may stand for any distance above it: only the diagonals that so many edits can
    reach are filled, some columns at a time, and no more columns if every way through them costs too much.
    """
    head = len(os.path.commonprefix([a, b]))
    a, b = a[head:], b[head:]
    tail = len(os.path.commonprefix([a[::-1], b[::-1]]))
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if not a or not b:
        return len(a) + len(b)
    most = len(a) + len(b) if most is None else most
    if abs(len(a) - len(b)) > most:
        return most + 1
    places = _places(a, b)
    step, longer = max(64, most // 8), len(a) - len(b)
    above, below = (most - abs(longer)) // 2 - min(0, longer), (most - abs(longer)) // 2 + max(0, longer)
    low, high, up, down, score = 0, 0, 0, 0, 0  # the rows held are those from low + 1 to high; score is the last one's
    for at in range(0, len(b), step):
        columns = b[at:at + step]
        first, last = max(0, at - above), min(len(a), at + len(columns) + below)
        up, down = up >> first - low | (1 << last - high) - 1 << high - first, down >> first - low
        low, high, score = first, last, score + last - high
        mask, bottom = (1 << high - low) - 1, 1 << high - low - 1
        held = {c: places[c] >> low & mask for c in set(columns) if c in places}
        for c in columns:
            same = held.get(c, 0)
            diagonal = ((same & up) + up ^ up) | same | down
            right, left = down | ~(diagonal | up) & mask, up & diagonal
            score += bool(right & bottom) - bool(left & bottom)
            right, left = (right << 1 | 1) & mask, left << 1 & mask
            up, down = left | ~(diagonal | right) & mask, right & diagonal
        done = at + len(columns)
        if done < len(b) and _least_through(up, down, high - low, score, len(a) - low - (len(b) - done)) > most:
            return most + 1
    return score


def _places(a: str, b: str) -> dict[str, int]:
    """By character of both texts a number whose bits tell its places in ``a``."""
    places: dict[str, int] = {}
    if len(a) < 512:
        for i, c in enumerate(a):
            places[c] = places.get(c, 0) | 1 << i
        return places
    points = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return {c: int.from_bytes(np.packbits(points == ord(c), bitorder="little").tobytes(), "little") for c in set(a) & set(b)}


def probed(a: str, b: str, most: int) -> bool:
    """Whether probes tell of more than ``SURE * most`` edits: parts of ``b`` at even steps, each against where it does best in
    ``a`` within reach.  All parts of ``b`` cost at most the distance in this way, so on average the estimate is no higher."""
    places, longer, cost = _places(a, b), len(a) - len(b), 0
    above, below = (most - abs(longer)) // 2 - min(0, longer), (most - abs(longer)) // 2 + max(0, longer)
    for k in range(PROBES):
        at = (2 * k + 1) * (len(b) - PROBE) // (2 * PROBES)
        low, high = max(0, at - above), min(len(a), at + PROBE + below)
        mask, bottom, part = (1 << high - low) - 1, 1 << high - low - 1, b[at:at + PROBE]
        held = {c: places[c] >> low & mask for c in set(part) if c in places}
        up = down = score = 0  # a way may start in any row
        for c in part:
            same = held.get(c, 0)
            diagonal = ((same & up) + up ^ up) | same | down
            right, left = down | ~(diagonal | up) & mask, up & diagonal
            score += bool(right & bottom) - bool(left & bottom)
            right, left = (right << 1 | 1) & mask, left << 1 & mask
            up, down = left | ~(diagonal | right) & mask, right & diagonal
        cost += int(_values(up, down, high - low, score).min())
        if cost * len(b) > SURE * most * PROBES * PROBE:
            return True
    return False


def _values(up: int, down: int, rows: int, score: int) -> np.ndarray:
    """A column of the table from its steps up and down and its last value."""
    bits = [np.unpackbits(np.frombuffer(v.to_bytes((rows + 7) // 8, "little"), dtype=np.uint8), bitorder="little")[:rows].astype(np.int32)
            for v in (up, down)]
    values = np.concatenate([[0], np.cumsum(bits[0] - bits[1])])
    return values - values[-1] + score


def _least_through(up: int, down: int, rows: int, score: int, ahead: int) -> int:
    """The least cost of a way through a column: a row's value and how far its rest and the other text's differ in length."""
    return int((_values(up, down, rows, score) + np.abs(ahead - np.arange(rows + 1))).min())


def bridged(a: str, b: str, most: int) -> int | None:
    """The cost of one way to edit ``a`` into ``b``, so an upper bound of their distance: stretches of
    pieces that both have once are kept, as many as are in one order, and what lies between them is edited.  None if the bound
    is above ``most`` or the kept pieces leave too much between them."""
    size, (left, here), (right, there) = SKETCH_PIECE, once(a), once(b)
    if not len(left) or not len(right):
        return None
    at = np.minimum(np.searchsorted(right, left), len(right) - 1)
    both = right[at] == left
    here, there = here[both], there[at[both]]
    order = np.argsort(here)
    here, there = here[order], there[order]
    # pieces that overlap or touch, shifted alike, are one stretch
    opens = np.ones(len(here), dtype=bool)
    opens[1:] = (np.diff(here) > size) | (np.diff(here) != np.diff(there))
    last = np.flatnonzero(np.append(opens, True))[1:] - 1
    if 2 * (here[last] - here[opens] + size).sum() < max(len(a), len(b)):
        return None
    here, there, lengths = here[opens].tolist(), there[opens].tolist(), (here[last] - here[opens] + size).tolist()
    ends: list[int] = []  # the longest rising row: by length its least end, who that is, and who comes before each
    who, before = [], []
    for k, q in enumerate(there):
        n = bisect.bisect_left(ends, q)
        before.append(who[n - 1] if n else -1)
        if n == len(ends):
            ends.append(q)
            who.append(k)
        else:
            ends[n], who[n] = q, k
    chain, k = [], who[-1] if who else -1
    while k >= 0:
        chain.append(k)
        k = before[k]
    x = y = between = 0
    gaps = []
    for k in reversed(chain):
        p, q, n = here[k], there[k], lengths[k]
        skip = max(0, x - p, y - q)
        if skip >= n:
            continue
        if x < p + skip or y < q + skip:
            gaps.append((x, p + skip, y, q + skip))
            between += max(p + skip - x, q + skip - y)
        x, y = p + n, q + n
    gaps.append((x, len(a), y, len(b)))
    if 2 * (between + max(len(a) - x, len(b) - y)) > max(len(a), len(b)):
        return None
    cost = 0
    for x, p, y, q in gaps:
        cost += distance(a[x:p], b[y:q], most - cost)
        if cost > most:
            return None
    return cost


def allowed(n: int, least: float) -> int:
    """Edits that near texts may have, the longer of ``n`` characters."""
    return math.floor((1 - least) * n + 1e-9)


def sketch(points: np.ndarray) -> bytes:
    """A byte per cell of hashed pieces that tells the least one; 0 for an empty cell."""
    found, cells = Bander.hashes(points, SKETCH_PIECE), np.zeros(CELLS, dtype=np.uint8)
    found = np.sort(found << np.uint64(55) | found >> np.uint64(9))
    cell = (found >> np.uint64(55)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    cells[cell[first]] = mixed(found[first] & np.uint64((1 << 55) - 1)) % np.uint64(255) + np.uint64(1)
    return cells.tobytes()


def alike(a: bytes | None, b: bytes | None) -> bool:
    """Whether texts with these sketches (None: too short for one) may be near."""
    if a is None or b is None:
        return True
    x, y = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    return np.count_nonzero((x == y) & (x > 0)) >= ALIKE * np.count_nonzero(x | y)


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


def shape(text: str) -> bytes:
    """What bounds of a pair need instead of its texts: the length, the sketch of a text that has one, and the hashed
    pairs of neighbouring characters of one that may be near a text without."""
    points = points_of(text)
    out = len(text).to_bytes(4, "little")
    if len(text) >= SKETCHED:
        out += sketch(points)
    if len(text) * NEAR <= SKETCHED:
        out += np.sort(mixed(points[:-1] << np.uint64(32) | points[1:]) >> np.uint64(48)).astype(np.uint16).tobytes()
    return out


@F.arrow_udf(BinaryType())
def shaped(texts: pa.Array) -> pa.Array:
    return pa.array([shape(t) for t in texts.to_pylist()], pa.binary())


@functools.lru_cache(maxsize=64)  # a text often comes in several pairs in a row
def _shape_read(blob: bytes) -> tuple[int, bytes | None, np.ndarray | None]:
    """The length, the sketch, and a different number for each pair of neighbouring characters."""
    n, rest = int.from_bytes(blob[:4], "little"), blob[4:]
    cells, rest = (rest[:CELLS], rest[CELLS:]) if n >= SKETCHED else (None, rest)
    if n * NEAR > SKETCHED:
        return n, cells, None
    found = np.frombuffer(rest, dtype=np.uint16).astype(np.int64)
    here = np.arange(len(found))
    opens = np.concatenate([[True], found[1:] != found[:-1]])[:len(found)]
    return n, cells, found << 16 | here - np.maximum.accumulate(np.where(opens, here, 0))


def plausible(left: bytes, right: bytes, least: float) -> bool:
    """Whether texts of these shapes may be near.  An edit takes two pairs of neighbouring characters from a text at most, so
    texts so many edits apart have all others of the longer one's in common; this bound rules out no near text."""
    (n, cells, pairs), (m, others, theirs) = _shape_read(left), _shape_read(right)
    most = allowed(max(n, m), least)
    if abs(n - m) > most or not alike(cells, others):
        return False
    if pairs is None or theirs is None:
        return True
    wanted = max(n, m) - 1 - 2 * most
    return wanted <= 0 or len(np.intersect1d(pairs, theirs, assume_unique=True)) >= wanted


@functools.lru_cache(maxsize=16)  # a text often comes in several pairs in a row
def sketched(text: str) -> bytes:
    return sketch(points_of(text))


@functools.lru_cache(maxsize=16)
def once(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes in order of the pieces that a text has once, and their places."""
    found = Bander.hashes(points_of(text), SKETCH_PIECE)
    order = np.argsort(found)
    found = found[order]
    other = np.concatenate([[True], found[1:] != found[:-1], [True]])
    alone = other[1:] & other[:-1]
    return found[alone], order[alone]


def close(a: str, b: str, least: float) -> bool:
    """Whether the edit distance is within the limit; texts whose sketches or probes are unlike aren't compared."""
    most = allowed(max(len(a), len(b)), least)
    if abs(len(a) - len(b)) > most:
        return False
    if min(len(a), len(b)) >= SKETCHED:
        if not alike(sketched(a), sketched(b)):
            return False
        if bridged(a, b, most) is not None:
            return True
        if min(len(a), len(b)) >= PROBED and probed(a, b, most):
            return False
    return distance(a, b, most) <= most


@F.arrow_udf(BinaryType())
def packed(texts: pa.Array) -> pa.Array:
    """Texts by Zstandard: less to shuffle."""
    codec = pa.Codec("zstd", compression_level=3)
    raw = [t.encode("utf-8", "surrogatepass") for t in texts.to_pylist()]
    return pa.array([len(r).to_bytes(4, "little") + codec.compress(r, asbytes=True) for r in raw], pa.binary())


def unpacked(blob: bytes) -> str:
    raw = pa.Codec("zstd").decompress(blob[4:], int.from_bytes(blob[:4], "little"), asbytes=True)
    return raw.decode("utf-8", "surrogatepass")


def _near(least: float):
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(a, b) for a, b, left, right in zip(*(batch.column(i).to_pylist() for i in range(4)))
                   if close(unpacked(left), unpacked(right), least)]
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return near


def _plausible(least: float):
    def fits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(a, b) for a, b, left, right in zip(*(batch.column(i).to_pylist() for i in range(4))) if plausible(left, right, least)]
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return fits


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per band of each (key, text): the band, whose last two bits tell the kind of piece, the key's code, and
    the text's length, the piece's place and the span of the places in one number that sorts by length."""
    bander = Bander()
    kind = np.zeros(1 + max(size for size, *_ in PIECES), dtype=np.uint64)
    kind[[size for size, *_ in PIECES]] = np.arange(len(PIECES))
    for batch in batches:
        codes = np.array([int(k[:CODE], 16) for k in batch.column(0).to_pylist()], dtype=np.int64)
        texts = batch.column(1).to_pylist()
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        for at in range(0, len(texts), step := max(1, WALKED // BANDS)):
            row, size, span, band, place = bander.of(texts[at:at + step])
            row, size = row.astype(np.int64) + at, size.astype(np.int64)
            n = lengths[row]
            where = n << 32 | (place.astype(np.int64) << 16) // n << 16 | (span.astype(np.int64) << 16) // n
            band = band & np.uint64((1 << 48) - 4) | kind[size]  # fewer digits to shuffle
            yield pa.RecordBatch.from_arrays([pa.array(band.view(np.int64)), pa.array(codes[row]), pa.array(where)],
                                             names=["band", "node", "at"])


class Bucketed:
    """Rows of buckets, in order of (band, at, node) where a bucket is whole."""

    def __init__(self, band: np.ndarray, node: np.ndarray, at: np.ndarray, least: float):
        self.band, self.node, self.n, self.least = band, node, at >> 32, least
        self.place, self.span = (((at >> s & 0xFFFF) * self.n + 0xFFFF) >> 16 for s in (16, 0))  # exact up to 65,536 characters
        self.slack = 4 * (self.n >> 16)

    def reach(self, n: np.ndarray) -> np.ndarray:
        """How far apart places may lie in texts that are near, the longer of ``n`` characters."""
        return n * (1 - self.least) + 1e-6 + 4 * (n >> 16)

    def meet(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether rows may be one kept stretch of two different near texts."""
        n, place = self.n, self.place
        return (self.node[i] != self.node[j]) & (np.abs(place[i] - place[j]) + np.abs((n[i] - place[i]) - (n[j] - place[j]))
                                                 <= self.reach(np.maximum(n[i], n[j])))

    def pairs(self, i: np.ndarray, j: np.ndarray) -> list[np.ndarray]:
        """Columns of ``MET`` of pairs that meet."""
        low = self.node[i] < self.node[j]
        slack = np.maximum(self.slack[i], self.slack[j])
        piece, span = self.band[j] & 3, np.maximum(0, np.minimum(self.span[i], self.span[j]) - 16 * slack)
        return [np.where(low, self.node[i], self.node[j]), np.where(low, self.node[j], self.node[i]),
                piece << 62 | span << 31 | np.where(low, self.place[i], self.place[j])]


#: A common band of a pair: the kind of piece (two bits), the lesser span and the place in one number, as less to shuffle.
MET = "a long, b long, met long"


def _paired(columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "met"])


def _different(rows: list[np.ndarray]) -> np.ndarray:
    """Which rows differ from the ones before them: equal texts have equal rows side by side."""
    return np.concatenate([[True], np.any([v[1:] != v[:-1] for v in rows], axis=0)])


def _neighbours(least: float):
    """Pairs of the first pass, from rows in order of (band, at, node): each with the first one of its band and with
    the ``NEIGHBOURS`` before it, which are the nearest in length."""
    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, dtype=np.int64)] * 3  # of the last band: the first row and the last ones
        for batch in batches:
            new = [batch.column(i).to_numpy() for i in range(3)]
            start = len(held[0])
            rows = [np.concatenate([h, v]) for h, v in zip(held, new)]
            if len(rows[0]) == start:
                continue
            other = _different(rows)
            other[:start] = True
            band, node, at = (v[other] for v in rows)
            here = np.arange(len(band))
            opens = np.concatenate([[True], band[1:] != band[:-1]])
            first = np.maximum.accumulate(np.where(opens, here, 0))
            bucketed = Bucketed(band, node, at, least)
            for back in range(NEIGHBOURS + 1):
                j = here[start:]
                i = j - back if back else first[start:]
                fits = i >= first[start:] if back else j - i > NEIGHBOURS
                i, j = i[fits], j[fits]
                fits = bucketed.meet(i, j)
                yield _paired(bucketed.pairs(i[fits], j[fits]))
            own = np.flatnonzero(band == band[-1])
            keep = np.concatenate([own[:1], own[1:][-NEIGHBOURS:]])
            held = [band[keep], node[keep], at[keep]]

    return paired


def _large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different rows of the bands of which the first pass doesn't make all pairs, from rows in order of (band, at, node)."""
    held = [np.empty(0, dtype=np.int64)] * 3  # of the last band: its last rows, all while it is small
    gone = False  # whether they have gone out
    for batch in batches:
        start = len(held[0])
        rows = [np.concatenate([h, batch.column(i).to_numpy()]) for i, h in enumerate(held)]
        if len(rows[0]) == start:
            continue
        rows = [v[other] for other in (_different(rows),) for v in rows]
        opens = np.flatnonzero(_different(rows[:1]))
        sizes = np.diff(np.append(opens, len(rows[0])))
        many = sizes > NEIGHBOURS + 1
        many[0] |= gone and start > 0 and len(rows[0]) > start
        going = np.repeat(many, sizes)
        if gone:
            going[:start] = False
        yield pa.RecordBatch.from_arrays([pa.array(v[going]) for v in rows], names=["band", "node", "at"])
        gone = bool(many[-1]) or (gone and len(opens) == 1)
        held = [v[opens[-1]:][-(NEIGHBOURS + 1):] for v in rows]


def _crossing(least: float):
    """All pairs of the second pass, from rows (band, node, at, of, part, side) in order of (band, part, at, node): texts of one
    part of a band, unless they are in one group (``of``) already or on one side that another part pairs."""
    def pairs_of(band, node, at, of, part, side) -> Iterator[pa.RecordBatch]:
        opens = np.flatnonzero(np.concatenate([[True], (band[1:] != band[:-1]) | (part[1:] != part[:-1])]))
        sizes = np.diff(np.append(opens, len(band)))
        # parts within one group have nothing to add
        several = np.repeat((np.minimum.reduceat(of, opens) != np.maximum.reduceat(of, opens)) | (np.minimum.reduceat(of, opens) < 0), sizes)
        first, bucketed = np.repeat(opens, sizes), Bucketed(band, node, at, least)
        j, back, out, many = np.flatnonzero(several), 0, [], 0
        while len(j):
            back += 1
            j = j[j - back >= first[j]]
            # rows go by length: who is too short for j is so further back as well
            j = j[bucketed.n[j] - bucketed.n[j - back] <= bucketed.reach(bucketed.n[j])]
            i = j - back
            fits = bucketed.meet(i, j) & ((of[i] < 0) | (of[i] != of[j])) & ((side[i] == 0) | (side[i] != side[j]))
            if fits.any():
                out.append(bucketed.pairs(i[fits], j[fits]))
                many += len(out[-1][0])
            if many >= PAIRED:
                yield _paired([np.concatenate(c) for c in zip(*out)])
                out, many = [], 0
        if out:
            yield _paired([np.concatenate(c) for c in zip(*out)])

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, codes, fresh = None, {}, itertools.count()  # the rows of the last part
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 4, 5)]
            # groups by small numbers, -1 for a text in none
            rows.insert(3, np.array([-1 if g is None else codes[g] if g in codes else codes.setdefault(g, next(fresh))
                                     for g in batch.column(3).to_pylist()], dtype=np.int64))
            rows = rows if held is None else [np.concatenate([h, v]) for h, v in zip(held, rows)]
            rows = [v[other] for other in (_different([rows[k] for k in (0, 1, 2, 4)]),) for v in rows]
            ahead = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[4] != rows[4][-1]))
            done = ahead[-1] + 1 if len(ahead) else 0
            if done:
                yield from pairs_of(*(v[:done] for v in rows))
            held = [v[done:] for v in rows]
            if done:
                kept = set(held[3].tolist())
                codes = {g: c for g, c in codes.items() if c in kept}
        if held is not None:
            yield from pairs_of(*held)

    return paired


def _met(rows: DataFrame) -> DataFrame:
    """Common bands (see ``MET``) of a pair and kind of piece in one row.  They are shuffled as they are: few pairs have
    two in a task."""
    met, low = F.col("met"), F.lit((1 << 31) - 1)
    each = rows.repartition("a", "b").select("a", "b", F.shiftrightunsigned(met, 62).cast("int").alias("piece"),
                                             F.shiftright(met, 31).bitwiseAND(low).cast("int").alias("span"), met.bitwiseAND(low).cast("int").alias("place"))
    return each.groupBy("a", "b", "piece").agg(F.count("*").alias("common"), F.min("span").alias("span"),
                                               F.min("place").alias("first"), F.max("place").alias("last"))


def _spread(met: DataFrame) -> DataFrame:
    """Pairs (a, b, common) of ``_met`` whose common bands spread enough."""
    wanted = F.element_at(F.array(*[F.lit(part) for *_, part in PIECES]), F.col("piece") + 1)
    return (met.filter((wanted == 0) | ((F.col("last") - F.col("first")) * wanted >= F.col("span")))
            .groupBy("a", "b").agg(F.max("common").alias("common")))


def _dealt(rows: DataFrame, groups: DataFrame, crowd: int) -> DataFrame:
    """Rows (band, node, at) with the group of the text (``of``, null: none) and the ``part`` of the band to which they go, as
    ``_crossing`` takes them.  A band of more than ``crowd`` rows has a part for every two of its blocks of texts, and a row
    goes to all parts of its block; ``side`` tells the blocks of a part apart, 0 where it is one block."""
    own, parts, q = F.col("own"), F.col("parts"), F.col("q")
    crowds = written(rows.groupBy("band").agg(F.ceil(F.count("*") / crowd).cast("int").alias("parts")).filter("parts > 1"))
    blocks = (rows.join(groups, "node", "left").join(crowds, "band", "left")
              .withColumn("own", F.coalesce(F.pmod(F.xxhash64("node"), parts), F.lit(0)))
              .withColumn("q", F.explode(F.sequence(F.lit(0), F.coalesce(parts, F.lit(1)) - 1))))
    dealt = blocks.select("band", "node", "at", "of", F.coalesce(F.least(own, q) * parts + F.greatest(own, q), F.lit(0)).cast("long").alias("part"),
                          F.when(own == q, 0).when(own < q, 1).otherwise(2).alias("side"))
    return dealt.repartition("band", "part").sortWithinPartitions("band", "part", "at", "node")


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Queries run in here delete their shuffled rows when they end; what they write is all that later ones read."""
    before = spark.conf.get(CLEANED)
    spark.conf.set(CLEANED, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANED, before)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = NEAR, crowd: int = CROWD) -> DataFrame:
    """Rows (key, group): the MD5 digests of texts that are linked with others and the smallest id that links reach
    (one that ``row_id`` made if the group has none).

    Linked are equal texts, rows of one id, and texts that meet in their bands and whose edit distance is at most
    (1 - least) times the longer length.  The first pass takes texts that lie side by side in a bucket (see
    ``_neighbours``): every class of equal texts is first compared with the one with which it has most bands in common, then
    with all it met that still lie in other groups.  The second pass takes all pairs of texts that share a bucket and
    still lie in different groups, in parts of about ``crowd`` texts, so it grows with the square of those.
    Empty texts are linked with nothing.
    """
    spark = docs.sparkSession
    ship(spark)
    with shuffles_dropped(spark):
        return _grouped(docs.select(row_id(id_col, text_col).alias("id"), F.col(f"`{text_col}`").alias("text")).filter("text != ''"), least, crowd)


def _grouped(texts: DataFrame, least: float, crowd: int = CROWD) -> DataFrame:
    digest = F.md5(F.col("text").cast("binary")).alias("key")
    keyed = texts.select("id", digest)
    classes = written(keyed.groupBy("key").agg(F.min("id").alias("node"), F.count("*").alias("rows")))
    banded = (texts.select(digest, "text").mapInArrow(_banded, "band long, node long, at long")
              .repartition("band").sortWithinPartitions("band", "at", "node"))
    # both tables from one shuffle: common bands of pairs; and rows of large buckets, of the kind len(PIECES)
    nothing = F.lit(0)
    found = banded.mapInArrow(_large, "band long, node long, at long").select(
        F.col("band").alias("a"), F.col("node").alias("b"), F.lit(len(PIECES)).alias("piece"), F.col("at").alias("common"),
        *[nothing.alias(c) for c in ("span", "first", "last")])
    met = written(_met(banded.mapInArrow(_neighbours(least), MET)).unionByName(found))
    small, large = met.filter(F.col("piece") < len(PIECES)), met.filter(F.col("piece") == len(PIECES))
    # the code of a class is the beginning of its key; texts that share a code by chance are all looked at
    code = F.conv(F.substring("key", 1, CODE), 16, 10).cast("long")
    coded = lambda c: classes.select(code.alias(c), F.col("node").alias(f"node_{c}"))

    def by_node(spread: DataFrame) -> DataFrame:
        return (spread.join(coded("a"), "a").join(coded("b"), "b").filter("node_a != node_b")
                .groupBy(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
                .agg(F.max("common").alias("common")))

    pairs = written(by_node(_spread(small)))
    # an id with several texts is one document
    same = written(keyed.join(classes, "key").filter("id != node").join(classes.select(F.col("node").alias("id")), "id", "left_semi")
                   .select(F.col("node").alias("a"), F.col("id").alias("b")).distinct())
    held, near = texts.select("id", packed("text").alias("text")), _near(least)
    links = verified(pairs.groupBy("b").agg(F.max_by("a", F.struct("common", -F.col("a"))).alias("a")).select("a", "b"), held, near).union(same)
    found = written(components(links))
    of = lambda c: found.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    apart = lambda pairs: (pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
                           .filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b"))
    more = verified(apart(pairs), held, near)
    if not more.isEmpty():
        discard(found)
        links = links.union(more)
        found = written(components(links))
    # the second pass: pairs of large buckets, whose bands count with those that the first one found
    groups = classes.join(_whole(found), "node", "left").groupBy(code.alias("node")).agg(F.when(F.count("*") == 1, F.max("component")).alias("of"))
    crossed = _dealt(large.select(F.col("a").alias("band"), F.col("b").alias("node"), F.col("common").alias("at")), written(groups.filter("of IS NOT NULL")), crowd)
    crossed = _met(crossed.mapInArrow(_crossing(least), MET)).unionByName(small).groupBy("a", "b", "piece").agg(
        F.max("common").alias("common"), F.min("span").alias("span"), F.min("first").alias("first"), F.max("last").alias("last"))
    rest = written(by_node(_spread(crossed)).join(pairs, ["a", "b"], "left_anti"))  # the first pass has looked at its pairs
    discard(met)
    fresh = near_dup.verified(apart(rest), texts.select("id", shaped("text").alias("text")), _plausible(least))  # bounds, before texts are sent
    more = verified(fresh, held, near)
    for done in (rest, fresh, pairs):
        discard(done)
    if not more.isEmpty():
        discard(found)
        found = written(components(links.union(more)))
    grouped = classes.join(_whole(found), "node", "left").filter("rows > 1 OR component IS NOT NULL")
    return written(grouped.select("key", F.coalesce("component", "node").alias("group")))


def _whole(found: DataFrame) -> DataFrame:
    """Rows (node, component) of all nodes in components, the smallest ones too."""
    return found.union(found.select("component").distinct().select(F.col("component").alias("node")).withColumn("component", F.col("node")))


def known(c: Column) -> Column:
    """An id, or null for one that ``row_id`` made."""
    return F.when(c < NO_ID, c)


def near_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = NEAR) -> DataFrame:
    """One row per row of ``docs``: the id, ``fingerprint`` and ``group_id``, the smallest id that links reach.

    See ``near_groups`` for the links.  Null and empty texts are linked with nothing; a row without an
    id comes after all others and its ``group_id`` is null if its group has no id.
    """
    texts = docs.select(row_id(id_col, text_col).alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    keyed = texts.select(F.struct("id", F.md5(F.col("text").cast("binary")).alias("key")).alias("of"), "text")
    prints = fingerprints(keyed, "of").select("of.id", "of.key", "fingerprint")
    return prints.join(near_groups(docs, id_col, text_col, least), "key", "left").select(
        known(F.col("id")).alias(id_col), "fingerprint", known(F.coalesce("group", "id")).alias("group_id"))


def compared_and_grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``neighbours_compared`` with ``group_id`` as in ``near_texts``."""
    rows = neighbours_compared(docs, id_col, text_col, keyed=True)
    own = F.coalesce("group", F.col(f"`{id_col}`"))
    return rows.join(near_groups(docs, id_col, text_col), "key", "left").withColumn("group_id", known(own)).drop("key", "group")
