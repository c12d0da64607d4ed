"""URL rules by a Bloom filter cascade: exact membership without joining pages to rules.

A url's keys are all pairs of a host suffix and a path prefix as long as some rule's path. Level 1
of a cascade encodes the listed keys, level 2 those other keys of the corpus that level 1 takes
for listed, level 3 the listed keys that level 2 takes for others, and so on until no key is
mistaken. As the levels cover every key of the corpus, the first level that lacks a key decides
exactly. Each level is one array of 64-bit words that reaches the rows as a scalar subquery.

Level 1 spends about log2(other keys / listed keys) bits a key, so the first mistakes are about
as many as the listed keys and all levels together stay proportional to the list.

Nulls and edge cases: a null url or one without "://" has empty host and path and fits no
rule; urls that no rule fits get ``default``; of fitting rules the longest wins, block before
allow if a key has both; an empty list lists nothing; other columns are not looked at.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlens.llm.shared import n_rows, stored, within

MAX_FILTER_KEYS = 2_000_000  # largest level kept as one array (4 MB at 16 bits a key)
MAX_RULE_LENGTHS = 2048
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The rules of the registered query.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    found = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, found, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, found, 2), F.lit(""))


def url_keys(host: Column, path: Column, lengths: list[int], most_labels: int) -> Column:
    """Every host suffix of up to ``most_labels`` labels joined with every path prefix of a length that rules have."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(labels) - most_labels + 1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    usable = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    prefixes = F.transform(usable, lambda n: F.substr(path, F.lit(1), n))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


class Level:
    """One Bloom filter of a cascade: its words, size and hash count."""

    def __init__(self, keys: DataFrame, n_keys: int, bits_per_key: float, seed: int):
        self.n_words = max(1, math.ceil(n_keys * bits_per_key / 64))
        self.n_hashes = max(1, round(bits_per_key * math.log(2)))
        self.seed = seed
        bits = keys.select(F.explode(F.array(*self.positions(F.col("key")))).alias("bit"))
        words = bits.groupBy((F.col("bit") / 64).cast("int").alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("set")
        )
        # At most MAX_FILTER_KEYS keys: the array is bounded.
        as_map = F.map_from_entries(F.collect_list(F.struct("word", "set")))
        self.words = stored(
            words.agg(as_map.alias("by_word")).select(
                F.transform(
                    F.sequence(F.lit(0), F.lit(self.n_words - 1)),
                    lambda w: F.coalesce(F.element_at("by_word", w), F.lit(0).cast("long")),
                ).alias("words")
            ),
            "level",
        )
        self.column = f"_level{seed}"

    def positions(self, key: Column) -> list[Column]:
        n_bits = F.lit(self.n_words * 64)
        first = F.pmod(F.xxhash64(key, F.lit(self.seed)), n_bits)
        step = F.pmod(F.xxhash64(key, F.lit(-self.seed)), n_bits)
        return [F.pmod(first + step * i, n_bits) for i in range(self.n_hashes)]

    def has(self, key: Column) -> Column:
        def bit(at: Column) -> Column:
            word = F.get(F.col(self.column), (at / 64).cast("int"))
            return F.getbit(word, (at % 64).cast("int")) == 1

        return reduce(Column.__and__, [bit(at) for at in self.positions(key)])

    def attach(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.column, self.words.scalar())


class Cascade:
    """Exact membership in ``listed`` for every key of ``universe``."""

    def __init__(self, listed: DataFrame, universe: DataFrame, n_universe: int, seed: int):
        self.levels: list[Level] = []
        listed = stored(listed.select("key").distinct(), "listed")
        n_keys = n_rows(listed)
        bits = 1.44 * max(2.0, math.log2(max(4.0, n_universe / max(1, n_keys))))
        inside, outside = listed, universe.join(listed, "key", "left_anti")
        while n_keys:
            if n_keys > MAX_FILTER_KEYS:
                raise ValueError(f"a level of {n_keys} keys; use rules_by_join")
            level = Level(inside, n_keys, bits, seed + len(self.levels))
            self.levels.append(level)
            mistaken = stored(level.attach(outside).filter(level.has(F.col("key"))).select("key"), "mistaken")
            inside, outside, n_keys, bits = mistaken, inside, n_rows(mistaken), 1.44 * 8

    def attach(self, df: DataFrame) -> DataFrame:
        return reduce(lambda d, level: level.attach(d), self.levels, df)

    def has(self, key: Column) -> Column:
        """The first level without the key decides: odd levels hold listed keys."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels) - 1, -1, -1):
            answer = F.when(self.levels[i].has(key), answer).otherwise(F.lit(i % 2 == 1))
        return answer


def rules_by_join(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Longest rule of each row of (_row, _keys): the way for lists beyond a broadcast filter.

    Of equally long rules a block rule wins, then the largest key, as with the cascade.
    """
    keyed = pages.select("_row", F.explode("_keys").alias("key")).join(rules, "key")
    best = F.max(F.struct(F.length("key"), (F.col("verdict") == "block").alias("blocked"), "key", "verdict"))
    return keyed.groupBy("_row").agg(best.alias("best")).select("_row", "best.key", "best.verdict")


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Adds host, path, rule and verdict to pages (page_id, url).

    ``rules`` has verdict (allow or block), host and path. A rule fits its host and all subdomains
    if the url's path starts with the rule's.
    """
    listed = stored(
        rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull()).select(
            "verdict", F.concat("host", "path").alias("key"), F.length("path").alias("n"),
            F.size(F.split("host", r"\.")).alias("labels"),
        ),
        "rules",
        most_labels=F.max("labels"),
    )
    lengths = [r["n"] for r in listed.select("n").distinct().orderBy("n").limit(MAX_RULE_LENGTHS + 1).collect()]
    if len(lengths) > MAX_RULE_LENGTHS:
        raise ValueError(f"rule paths of more than {MAX_RULE_LENGTHS} lengths")
    host, path = host_and_path(F.col("url"))
    addressed = pages.select("page_id", host.alias("host"), path.alias("path"))
    keyed = addressed.withColumn("_keys", url_keys(F.col("host"), F.col("path"), lengths or [0], listed.seen.get("most_labels") or 1))
    if not within(listed, MAX_FILTER_KEYS):
        numbered = stored(keyed.withColumn("_row", F.monotonically_increasing_id()), "keyed")
        best = rules_by_join(numbered, listed.select("key", "verdict"))
        return numbered.join(best, "_row", "left").select(
            "page_id", "host", "path", F.col("key").alias("rule"),
            F.coalesce("verdict", F.lit(default)).alias("verdict"),
        )
    universe = stored(keyed.select(F.explode("_keys").alias("key")).distinct(), "universe")
    n_universe = n_rows(universe)
    block = Cascade(listed.filter("verdict = 'block'"), universe, n_universe, 1)
    allow = Cascade(listed.filter("verdict = 'allow'"), universe, n_universe, 101)
    tested = allow.attach(block.attach(keyed))
    fits = F.filter(
        F.transform(
            "_keys",
            lambda k: F.struct(
                F.length(k).alias("n"), block.has(k).alias("blocked"), k.alias("key"), allow.has(k).alias("allowed")
            ),
        ),
        lambda s: s["blocked"] | s["allowed"],
    )
    return tested.withColumn("_best", F.array_max(fits)).select(
        "page_id",
        "host",
        "path",
        F.col("_best.key").alias("rule"),
        F.when(F.col("_best").isNull(), default)
        .when(F.col("_best.blocked"), "block")
        .otherwise("allow")
        .alias("verdict"),
    )


def op3_filter_urls(spark, sf_dir):
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
r(verdict, h, t) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
f AS (
  SELECT p.*, r.h || r.t AS rule, r.verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(r.h || r.t) DESC) AS place
  FROM p LEFT JOIN r ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.t))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM f WHERE place = 1
"""
