"""URL filters: host and path rules, then a weighted vocabulary of terms in the URL.

One Aho-Corasick automaton counts the terms of the vocabulary over the lower-cased URL.  A
hit counts only between boundaries: no ASCII letter or digit directly before or after it.
One strict term, or distinct soft terms of a summed weight of at least ``SOFT_LIMIT``,
reject a URL that no rule decides.
"""
from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulae.llm.common import blobs, built, ship, structs, utf8

#: (host, path, verdict); a rule fits its host and all subdomains, if the path starts with its path.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: One of these rejects.
STRICT = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "porn", "spam-farm", "xxx")
#: Distinct ones of these add up.
SOFT = {
    "ad": 1, "ads": 1, "adult": 1, "affiliate": 1, "banner": 1, "bet": 1, "bets": 1, "bonus": 1, "casino": 1,
    "cheap": 1, "click": 1, "deal": 1, "farm": 1, "free": 1, "jackpot": 1, "loan": 1, "pills": 1, "poker": 1,
    "popup": 1, "promo": 1, "sex": 1, "spam": 1, "sponsor": 1, "track": 1, "tracker": 1, "viagra": 1, "win": 1,
}
SOFT_LIMIT = 2
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ALNUM = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")
_HITS = {"strict": pa.list_(pa.string()), "soft": pa.list_(pa.string())}


class Vocabulary:
    """The automaton over bytes of the lower-cased URL."""

    def __init__(self, terms: list[tuple[str, bool]]):
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for term, strict in terms:
            self.automaton.add_word(term.lower(), (term, len(term), strict))
        self.automaton.make_automaton()

    def hits(self, url: bytes) -> tuple[list[str], list[str]]:
        low = url.translate(_LOWER)
        found: tuple[set[str], set[str]] = (set(), set())
        if len(self.automaton):
            for end, (term, size, strict) in self.automaton.iter(low.decode("latin-1")):
                start = end + 1 - size
                if (start == 0 or low[start - 1] not in _ALNUM) and (end + 1 == len(low) or low[end + 1] not in _ALNUM):
                    found[not strict].add(term)
        return sorted(found[0]), sorted(found[1])


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits as a struct (rule, verdict), null if none does."""
    out = F.lit(None).cast("struct<rule string, verdict string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def term_hits(spark, url: Column, strict=STRICT, soft=tuple(SOFT)) -> Column:
    """Distinct strict and soft terms of a URL as a struct of sorted lists."""
    block = spark.sparkContext.broadcast([(t, True) for t in strict] + [(t, False) for t in soft if t not in strict])

    @F.arrow_udf("struct<strict array<string>, soft array<string>>")
    def scan(urls: pa.Array) -> pa.Array:
        vocabulary = built(block, Vocabulary)
        out: dict[str, list] = {k: [] for k in _HITS}
        for url in blobs(urls):
            a, b = vocabulary.hits(url)
            out["strict"].append(a)
            out["soft"].append(b)
        return structs(_HITS, out)

    return scan(url)


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, strict=STRICT,
          soft: dict[str, int] | None = None, limit: int = SOFT_LIMIT) -> DataFrame:
    """One row per row of ``pages``: the id, ``host``, ``path``, ``rule`` (null if none fits), ``verdict``
    (allow or block: the rule's, else the vocabulary's), ``strict_hits`` and ``soft_hits``.

    A null URL, or one without ``://``, has an empty host and path; the vocabulary still sees
    its text, and a null or empty URL has no hit and is allowed.  Repeated rows are judged
    alike; other columns are not read.
    """
    ship(pages.sparkSession)
    soft = SOFT if soft is None else soft
    url = F.col("url")
    weights = F.create_map(*[F.lit(x) for kv in {**soft, "": 0}.items() for x in kv])
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"))
    seen = rows.select("id", host_of(url).alias("host"), path_of(url).alias("path"),
                       term_hits(pages.sparkSession, utf8("url"), strict, tuple(soft)).alias("hits"))
    weight = F.aggregate(F.transform("hits.soft", lambda t: weights[t]), F.lit(0), lambda a, b: a + b)
    own = F.when((F.size("hits.strict") > 0) | (weight >= limit), "block").otherwise("allow")
    return (seen.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
            .select(F.col("id").alias(id_col), "host", "path", F.col("fit.rule").alias("rule"),
                    F.coalesce("fit.verdict", own).alias("verdict"), F.col("hits.strict").alias("strict_hits"),
                    F.col("hits.soft").alias("soft_hits")))
