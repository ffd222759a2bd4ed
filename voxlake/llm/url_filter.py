"""URL verdicts: explicit rules, and exact membership in a list by a cascade of Bloom filters.

Level 1 of the cascade holds the listed keys. The keys of the corpus that are not listed but pass it
go into level 2, the listed ones that pass that into level 3, and so on until a level lets nothing
wrong through. For every key of the corpus the first level that refuses it then tells exactly
whether it is listed, and judging a URL needs no join: the levels are a few arrays of bits.

Everything is built-in expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.llm.storage import kept

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEYS_PER_CASCADE = 1 << 22  # listed and unlisted; the largest filter then takes 8 MB


@dataclass(frozen=True)
class Rule:
    """Applies to a host and all its subdomains, for paths that begin with the rule's."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _after_scheme(url: Column) -> Column:
    place = F.instr(url, "://")
    return F.when(place > 0, F.substring(url, place + 3, F.length(url)))


def url_host(url: Column) -> Column:
    """What follows the first ://, up to / ? # or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ? # or the end; else empty."""
    path = F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        fits = (((host == rule.host) | host.endswith(f".{rule.host}"))
                & path.startswith(rule.path))
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


@dataclass(frozen=True)
class Level:
    """One Bloom filter: a one-row table `bits` of 64-bit words, and how keys are hashed to it."""

    bits: DataFrame
    size: int
    hashes: int
    seed: int

    def passes(self, key: Column) -> Column:
        words = self.bits.scalar()
        tests = [F.call_function(
            "getbit", F.get(words, F.shiftright(at, 6).cast("int")), (at % 64).cast("int")) == 1
            for at in _places(key, self.size, self.hashes, self.seed)]
        result = tests[0]
        for test in tests[1:]:
            result = result & test
        return result


def _places(key: Column, size: int, hashes: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(1000 * seed + i)), F.lit(size).cast("long"))
            for i in range(hashes)]


def _level(keys: DataFrame, count: int, hashes: int, seed: int) -> Level:
    size = 64 * max(1, math.ceil(count * hashes / math.log(2) / 64))
    empty = keys.sparkSession.range(size // 64).select(
        F.col("id").alias("word"), F.lit(0).cast("long").alias("mask"))
    at = F.explode(F.array(*_places(F.col("key"), size, hashes, seed))).alias("at")
    words = (keys.select(at).groupBy(F.shiftright("at", 6).alias("word"))
             .agg(F.bit_or(F.call_function(
                 "shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))).alias("mask"))
             .union(empty).groupBy("word").agg(F.bit_or("mask").alias("mask")))
    row = words.agg(F.sort_array(F.collect_list(F.struct("word", "mask"))).alias("w")).select(
        F.col("w.mask").alias("bits"))
    return Level(kept(row, "level"), size, hashes, seed)


def cascade(universe: DataFrame) -> list[Level]:
    """The levels for a table of distinct keys (key, listed); no levels if nothing is listed."""
    levels: list[Level] = []
    inside = universe.where("listed").select("key")
    outside = universe.where("not listed").select("key")
    count, others = inside.count(), outside.count()
    while count:
        # the first filter is sharp enough to leave about as many false positives as keys
        hashes = 1 if levels else max(1, round(math.log2(max(1.0, others / count))) + 1)
        level = _level(inside, count, hashes, len(levels) + 1)
        levels.append(level)
        wrong = kept(outside.where(level.passes(F.col("key"))), "wrong")
        inside, outside, others, count = wrong, inside, count, wrong.count()
    return levels


def listed(key: Column, levels: list[Level]) -> Column:
    """Whether a key of the universe is listed; a key outside it may be taken for either."""
    answer = F.lit(len(levels) % 2 == 1)
    for number in range(len(levels), 0, -1):
        answer = F.when(~levels[number - 1].passes(key), F.lit(number % 2 == 0)).otherwise(answer)
    return answer


def url_verdicts(pages: DataFrame, listing: Column, rules: list[Rule], url: str = "url",
                 keys_per_cascade: int = KEYS_PER_CASCADE) -> DataFrame:
    """All columns of pages, then host, path, rule and verdict.

    `listing` is a condition on a row of pages: it puts the row's address, host and path, on the
    block list, for every row with that address. The longest fitting rule decides, of equally long
    ones that with the longer host, of equal rules the last given; without one, a listed address is blocked and any other allowed. A null URL or one without :// has an empty
    host and path, and the empty address is a key like any other. A condition that is null lists
    nothing. Columns of pages named host, path, rule or verdict are replaced.

    The universe of keys, all addresses, is cut by hash into parts with a cascade each, so that no
    filter grows beyond what keys_per_cascade needs; each part is one pass over the URLs.
    """
    rows = (pages.withColumn("host", url_host(F.col(url))).withColumn("path", url_path(F.col(url)))
            .withColumn("__key", F.concat("host", "path")))
    universe = kept(rows.select(F.col("__key").alias("key"),
                                F.coalesce(listing, F.lit(False)).alias("listed"))
                    .groupBy("key").agg(F.max("listed").alias("listed")), "universe")
    parts = max(1, math.ceil(universe.count() / keys_per_cascade))
    name, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = None
    for part in range(parts):
        def mine(key: str, part: int = part) -> Column:
            return F.pmod(F.xxhash64(F.col(key)), F.lit(parts).cast("long")) == part

        levels = cascade(universe.where(mine("key")) if parts > 1 else universe)
        block = F.when(listed(F.col("__key"), levels), "block").otherwise("allow")
        done = ((rows.where(mine("__key")) if parts > 1 else rows)
                .withColumn("rule", name).withColumn("verdict", F.coalesce(verdict, block))
                .drop("__key"))
        judged = done if judged is None else judged.unionByName(done)
    return judged
