"""URL filters: path rules, then a Bloom filter cascade over the corpus's own hosts.

A cascade is a list of Bloom filters. The first holds the listed keys; every
key of the corpus that is not listed but passes it goes into the second; every
listed key that passes that one goes into the third, and so on until a level
lets nothing wrong through. Since each key of the corpus was tried while
building, a lookup of any of them is exact. A page costs a few bit tests and no
join. Where a level would hold too many keys for one task, the keys are dealt by
hash to several cascades, and each page meets that of its own host's. All of it
is DataFrame functions; the filters reach the pages as scalar subqueries.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialise

#: host, path, verdict
Rule = tuple[str, str, str]

DEFAULT_RULES: tuple[Rule, ...] = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: Hosts blocked, with all subdomains, where no rule speaks: sites of these names at each of the domains.
LISTED_NAMES, LISTED_DOMAINS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"), ("example.com", "example.net", "example.org")
DEFAULT_LISTED = tuple(f"{name}.{domain}" for name in LISTED_NAMES for domain in LISTED_DOMAINS)
#: Largest number of keys expected in one level of one cascade (10 bits each: 12.5 MB); more are dealt to several.
MAX_LEVEL_KEYS = 10_000_000
FIRST_RATE, NEXT_RATE = 0.01, 0.25


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)"))
    return F.coalesce(ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit(""))


def with_url_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path. Null urls and those without ``://`` get empty strings."""
    own = pages.withColumn("_url", F.col(url))
    rest = F.when(F.instr("_url", "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)"))
    return own.withColumns(
        {
            "host": host_of(F.col("_url")),
            "path": F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit("")),
        }
    ).drop("_url")


def rule_columns(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, both null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def parent_hosts(host: Column) -> Column:
    """The host itself and each parent domain, as an array."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


class Cascade:
    """Levels as one-row DataFrames of bit words, with their sizes and seeds."""

    def __init__(self, levels: list[tuple[DataFrame, int, int]]):
        self.levels = levels

    def contains(self, key: Column) -> Column:
        """Exact for every key of the universe that the cascade was built over."""
        verdict = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            words, bits, hashes = self.levels[i]
            verdict = F.when(_passes(key, i, words.scalar(), bits, hashes), verdict).otherwise(F.lit(i % 2 == 1))
        return verdict


def _position(key: Column, level: int, n: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(level * 64 + n), key), F.lit(bits))


def _passes(key: Column, level: int, words: Column, bits: int, hashes: int) -> Column:
    """Whether all bits of key are set."""

    def is_set(n: int) -> Column:
        at = _position(key, level, n, bits)
        return F.getbit(F.get(words, F.shiftright(at, 6).cast("int")), (at % 64).cast("int")) == 1

    return reduce(lambda a, b: a & b, [is_set(n) for n in range(hashes)])


def _level(keys: DataFrame, level: int, bits: int, hashes: int) -> DataFrame:
    """One row: the filter's bits as an array of longs."""
    at = keys.select(F.explode(F.array(*[_position(F.col("key"), level, n, bits) for n in range(hashes)])).alias("at"))
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
    empty = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    dense = words.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("words"))


def build_cascade(keys: DataFrame) -> Cascade:
    """A cascade over keys(key, listed), a materialised table that holds each key of the universe once."""
    inside, outside = keys.where("listed").select("key"), keys.where("not listed").select("key")
    levels: list[tuple[DataFrame, int, int]] = []
    while n := inside.count():
        rate = NEXT_RATE if levels else FIRST_RATE
        bits = 64 * max(1, math.ceil(n * math.log2(1 / rate) * 1.4427 / 64))
        hashes = max(1, round(math.log2(1 / rate)))
        i = len(levels)
        words = materialise(_level(inside, i, bits, hashes), "url-level")
        levels.append((words, bits, hashes))
        wrong = materialise(outside.where(_passes(F.col("key"), i, words.scalar(), bits, hashes)), "url-wrong")
        inside, outside = wrong, inside
    return Cascade(levels)


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(-1), key), F.lit(shards))


def build_cascades(keys: DataFrame, max_level_keys: int = MAX_LEVEL_KEYS) -> list[Cascade]:
    """Cascades over keys(key, listed), as many as it takes for levels of about max_level_keys; the key's shard_of says which is its own."""
    n = keys.agg(F.count_if("listed").alias("listed"), F.count(F.lit(1)).alias("all")).first()
    shards = max(1, math.ceil(max(n["listed"], FIRST_RATE * (n["all"] - n["listed"])) / max_level_keys))
    if shards == 1:
        return [build_cascade(keys)]
    dealt = materialise(keys.withColumn("shard", shard_of(F.col("key"), shards)).repartition(shards, "shard"), "url-shards")
    return [build_cascade(dealt.where(F.col("shard") == i)) for i in range(shards)]


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = DEFAULT_RULES,
    listed: DataFrame | Sequence[str] = DEFAULT_LISTED,
    max_level_keys: int = MAX_LEVEL_KEYS,
) -> DataFrame:
    """page_id, host, path, rule and verdict for every row of pages(page_id, url).

    A page whose host has a fitting rule takes the longest one's verdict. Else it
    is blocked if its host or a parent domain is listed. listed: hosts, or a table
    with a column key, of any size; nulls and repeats in it count for nothing.
    Null urls have empty parts and are allowed, as is all that neither rules nor
    list name; repeated rows and null ids stay; other columns of pages are
    ignored, and an empty table gives an empty one.
    """
    spark = pages.sparkSession
    own = with_url_parts(pages.select("page_id", "url"))
    if not isinstance(listed, DataFrame):
        listed = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(list(listed))), "array<string>")).alias("key"))
    listed = listed.select(ascii_lower(F.col("key")).alias("key")).where("key is not null").distinct()
    hosts = materialise(own.select("host").distinct(), "url-hosts")
    inside = hosts.select("host", F.explode(parent_hosts(F.col("host"))).alias("key")).join(listed, "key", "left_semi").select("host").distinct()
    marked = hosts.join(inside.withColumn("listed", F.lit(True)), "host", "left").select(F.col("host").alias("key"), F.coalesce("listed", F.lit(False)).alias("listed"))
    cascades = build_cascades(materialise(marked, "url-keys"), max_level_keys)
    name, verdict = rule_columns(F.col("host"), F.col("path"), rules)

    def judged(rows: DataFrame, cascade: Cascade) -> DataFrame:
        other = F.when(cascade.contains(F.col("host")), "block").otherwise("allow")
        return rows.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, other).alias("verdict"))

    if len(cascades) == 1:
        return judged(own, cascades[0])
    return reduce(DataFrame.unionByName, [judged(own.where(shard_of(F.col("host"), len(cascades)) == i), c) for i, c in enumerate(cascades)])
