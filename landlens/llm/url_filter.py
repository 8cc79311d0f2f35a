"""URL filter (operator 2): rules, then a Bloom filter cascade.

A cascade answers membership exactly for every key of a known universe.  Level 1
encodes the listed keys; level 2 encodes the other keys of the universe that level 1
lets through by mistake; level 3 the listed keys that level 2 lets through; and so
on until none is left.  A key is listed if the first level that does not let it
through has an even number (or there is none after an odd last level).  The universe
is complete: all keys of the corpus's hosts, so no verdict is a guess and no join is
needed.

Keys are the words of a host: its labels, cut at hyphens.  A host is blocked if one
of its words is listed.

Size: with n listed of N keys, the first level's false-positive rate is
sqrt(1/2) n / N, that of all others 1/2, so levels from the second on hold fewer than
2 n keys together, and the whole cascade less than
1.45 n (log2(N / n) + 4) + 64 bits for each level.  It grows with the list, a parameter, and only with the
logarithm of the corpus; those bits are all that reaches the driver and the tasks.

Defined results: a null url, or one without ``://``, has an empty host and path, no
rule and the verdict allow; ties between rules of one length go to the longer host,
then to block.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landlens.session import scratch_path

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The contract's rules.
RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))

#: Words of hosts that serve adverts, gambling, adult matter, fake goods or spam.
LISTED = ("ad", "ads", "adserver", "advert", "adult", "bet", "bets", "betting", "bingo", "casino", "cialis", "clickbait", "doubleclick", "escort",
          "escorts", "gambling", "jackpot", "lottery", "malware", "phishing", "pills", "poker", "popup", "porn", "replica", "sex", "slots", "spam",
          "torrent", "torrents", "track", "tracker", "tracking", "viagra", "warez", "xxx")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or no ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(url, pattern, 1), _UPPER, _UPPER.lower()), F.regexp_extract(url, pattern, 2)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.verdict == "block", r.name)):  # the last one that fits wins
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


@dataclass(frozen=True)
class Level:
    number: int
    bits: int
    hashes: int
    words: tuple[int, ...]

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.number), F.lit(i)), F.lit(self.bits).cast("bigint")) for i in range(self.hashes)]

    def passes(self, key: Column) -> Column:
        held = F.lit(np.array(self.words, np.int64))
        out = F.lit(True)
        for p in self.positions(key):
            word = F.get(held, F.floor(p / 64).cast("int"))
            out = out & (F.getbit(word, F.pmod(p, F.lit(64)).cast("int")) == 1)
        return out


def build_level(keys: DataFrame, number: int, count: int, rate: float) -> Level:
    """Bloom filter of ``count`` keys (column key) with false-positive rate ``rate``; one aggregate, its words are collected."""
    hashes = max(1, round(math.log2(1 / rate)))
    bits = max(64, math.ceil(count * hashes / math.log(2)))
    empty = Level(number, bits, hashes, ())
    at = keys.select(F.explode(F.array(*empty.positions(F.col("key")))).alias("p"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("p", F.lit(64)).cast("int"))
    got = at.groupBy(F.floor(F.col("p") / 64).alias("w")).agg(F.bit_or(bit).alias("v")).collect()
    held = [0] * (-(-bits // 64))
    for r in got:
        held[r.w] = r.v
    return Level(number, bits, hashes, tuple(held))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    @property
    def bits(self) -> int:
        return sum(v.bits for v in self.levels)

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        out = F.lit(len(self.levels) % 2 == 1)
        for v in reversed(self.levels):  # what falls through a level of listed keys is not listed, and the reverse
            out = F.when(v.passes(key), out).otherwise(F.lit(v.number % 2 == 0))
        return out


def build_cascade(universe: DataFrame) -> Cascade:
    """From distinct keys (column key) and whether they are listed (column listed); the table is read a few times, so write it first."""
    counts = {r.listed: r.n for r in universe.groupBy("listed").agg(F.count(F.lit(1)).alias("n")).collect()}
    n, others = counts.get(True, 0), counts.get(False, 0)
    levels: list[Level] = []
    own, other = universe.where("listed").select("key"), universe.where(~F.col("listed")).select("key")
    while n:
        rate = min(0.5, math.sqrt(0.5) * n / max(others, 1)) if not levels else 0.5
        level = build_level(own, len(levels) + 1, n, rate)
        levels.append(level)
        own, other = other.where(level.passes(F.col("key"))), own
        n = own.count()
    return Cascade(tuple(levels))


def host_words(host: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(host, "[.-]"), ""))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, listed: tuple[str, ...] = LISTED, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of every row."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col(f"`{url_col}`"))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    keys = rows.select("host").distinct().select(F.explode(host_words(F.col("host"))).alias("key")).distinct()
    at = scratch_path(spark, "url-keys")
    keys.select("key", F.col("key").isin(*listed).alias("listed")).write.parquet(at)
    cascade = build_cascade(spark.read.parquet(at))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    blocked = F.exists(host_words(F.col("host")), cascade.contains)
    return rows.select("page_id", "host", "path", name.alias("rule"),
                       F.coalesce(verdict, F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))
