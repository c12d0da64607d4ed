"""Fuzzy line deduplication: MinHash banding, exact Jaccard check, union-find; DataFrame functions only.

A line's set is its character shingles: ``SHINGLE`` characters from every word start, from every
character of scripts written without blanks, and from every place of a word that has ``SHINGLE``
characters or more left; so every character of a line is in some shingle. Lines are alike if their
sets have a Jaccard similarity of ``SIMILARITY`` per cent or more; groups are the connected
components, and the first occurrence (smallest id, then place) of a group stays.

1. Each line gets a 64-bit hash and 16 minwise hashes, which form the rows, columns and diagonals of a
   4 x 4 grid: 12 bands of 4. Lines at the threshold share a band with chance 0.98, at 0.85 with 0.994, at
   0.9 with 0.999.
2. Buckets of one band with several lines are kept. Up to ``BUCKET`` lines are all paired; of larger
   ones every line is paired with two leaders.
3. Pairs are checked on the full sets (built once), and confirmed pairs are merged. Where a large bucket still has lines
   outside its largest group, each of those is compared with the whole bucket on the full sets, block by
   block, and each pair of blocks gives the links that connect its components, not all alike pairs. So every pair
   that shares a bucket is compared or connected already.
4. Repeats are listed per document, and the texts are put together without them.

Equal lines (blanks at the ends aside) are one line from step 1 on, so copies cost nothing later. Two
different lines of n share a hash with chance n / 2**64 each.

Nulls and edge cases: blank lines are never removed; a null text stays null and has no lines; a text
that loses all lines becomes empty; a null id sorts after all ids; rows that repeat an id are told apart
by their text, rows that repeat both are treated as one; an empty table gives an empty result; other
columns are passed through.
"""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlens.llm.components import connected_components
from txlens.llm.shared import id_or_last, joined, n_rows, seen_as, stored

SHINGLE = 9
SIMILARITY = 80
BUCKET = 16
MAX_SIDE = 200_000  # broadcast bound, at most 60 bytes a row
MAX_KEYS = 1_000_000  # broadcast bound of 8-byte line hashes
MAX_REPEATS = 1_000_000  # broadcast bound of removed places, 4 bytes each
BLOCK = 64
BLOCK_SHINGLES = 100_000  # 800 kB a block, or one line if that is longer
RUN = 8  # shingles hashed in one row
MAPS = 8  # longs of a line's bits, a power of two
ENDS = " \t\x0b\x0c\r"
# Scripts written without blanks: from CJK radicals to Hangul, and the compatibility ideographs.
UNSPACED = r"\x{2E80}-\x{D7AF}\x{F900}-\x{FAFF}"
# The group of a match is a shingle; the match itself goes on to the next place where one starts: past a word of SHINGLE
# characters at most (the quick way, first for most words), else to the next character if enough of the word is left from
# there, else past the word and the blanks after it, or up to a character of a script without blanks.
SHINGLES = r"(?s)(?=(\S(?:%s|.{0,%d}+)))(?:[!-\x{2E7F}]{1,%d}+\s++|\S(?=\S{%d})|[!-\x{2E7F}]++\s++|\S[^\s%s]*+\s*+)" % (
    "." * (SHINGLE - 1),
    SHINGLE - 1,
    SHINGLE,
    SHINGLE,
    UNSPACED,
)
_RANDOM = random.Random(97)
SALTS = [_RANDOM.getrandbits(64) - 2**63 for _ in range(16)]
# Rows, columns and diagonals of the grid: no two bands share more than one hash.
BANDS = [[4 * i + j for j in range(4)] for i in range(4)]
BANDS += [[4 * j + (i ^ d * j) for j in range(4)] for d in (0, 1) for i in range(4)]


def lines_of(documents: DataFrame) -> DataFrame:
    """Every line that is not blank: id, mark (hash of the text), place, line and its hash."""
    # Hashed first, so that it is not done again for each line. Of a column of lines Spark would first ask the size,
    # and so split a text three times.
    texts = documents.select(id_or_last().alias("id"), F.xxhash64("text").alias("mark"), "text")
    lines = texts.select("id", "mark", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    return (
        lines.withColumn("line", F.ltrim("line", F.lit(ENDS)))
        .filter("line != ''")
        .withColumn("line", without_end("line"))
        .withColumn("key", F.xxhash64("line"))
    )


def without_end(name: str) -> Column:
    """The line without blanks at its end; trimming walks the whole line, so only lines with such an end are trimmed."""
    line = F.col(name)
    ends = reduce(Column.__or__, [line.endswith(c) for c in ENDS])
    return F.when(ends, F.rtrim(line, F.lit(ENDS))).otherwise(line)


def shingles(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(SHINGLES), F.lit(1))


def shingle_hashes(line: Column) -> Column:
    return F.array_distinct(F.transform(shingles(line), lambda s: F.xxhash64(s)))


def signatures(documents: DataFrame) -> DataFrame:
    """(key, least_0, ...) of every different line: least shingle hash under 16 exclusive-or permutations, upper halves.

    Runs of ``RUN`` shingles are rows that are combined by line before the shuffle, so all of it is compiled code, and
    a line's values are looked up once a run. The last run is filled up with its first shingle, which changes no least.
    """
    lines = lines_of(documents).select("key", shingles(F.col("line")).alias("shingles"))
    # A line has a shingle at least, as it starts with no blank.
    runs = lines.select("key", "shingles", F.explode(F.sequence(F.lit(0), F.size("shingles") - 1, F.lit(RUN))).alias("at"))
    texts = [F.coalesce(F.get("shingles", F.col("at") + i), F.get("shingles", F.col("at"))) for i in range(RUN)]
    hashes = [F.shiftright(F.xxhash64(text), 32).cast("int").alias(f"hash_{i}") for i, text in enumerate(texts)]
    names = [f"hash_{i}" for i in range(RUN)]
    least = [F.min(F.least(*[F.col(name).bitwiseXOR(F.lit(salt >> 32)) for name in names])) for salt in SALTS]
    hashed = runs.select("key", *hashes)
    return hashed.groupBy("key").agg(*[value.alias(f"least_{i}") for i, value in enumerate(least)])


def band_rows(signed: DataFrame) -> DataFrame:
    """(band, key): the bands of every line."""
    bands = F.array(*[F.xxhash64(F.lit(n), *[F.col(f"least_{i}") for i in at]) for n, at in enumerate(BANDS)])
    return signed.select("key", F.explode(bands).alias("band"))


def all_pairs(groups: DataFrame) -> DataFrame:
    """(a, b) for all keys of groups (keys: sorted array of at most BUCKET)."""
    pairs = F.flatten(
        F.transform(
            "keys",
            lambda x, i: F.transform(
                F.slice("keys", i + 2, F.size("keys")), lambda y: F.struct(x.alias("a"), y.alias("b"))
            ),
        )
    )
    return groups.select(F.inline(pairs))


def bucket_pairs(members: DataFrame) -> DataFrame:
    """Pairs of members (band, n, key): all of a small bucket, stars around two leaders of a large one."""
    # Most buckets have two lines, which need no list.
    twos = members.filter("n = 2").groupBy("band").agg(F.min("key").alias("a"), F.max("key").alias("b")).select("a", "b")
    few = members.filter((F.col("n") > 2) & (F.col("n") <= BUCKET))
    few = few.groupBy("band").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    large = members.filter(F.col("n") > BUCKET)
    leaders = large.groupBy("band").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    many = joined(large, stored(leaders, "bucket_leaders"), ["band"], "inner", MAX_SIDE)
    star = many.select(F.explode(F.array("low", "high")).alias("leader"), "key").filter("leader != key")
    star = star.select(F.least("leader", "key").alias("a"), F.greatest("leader", "key").alias("b"))
    return twos.unionByName(all_pairs(few)).unionByName(star).distinct()


def line_sets(wanted: DataFrame, documents: DataFrame) -> DataFrame:
    """(key, set) of the lines whose hashes are given in the stored frame ``wanted``."""
    lines = joined(lines_of(documents).select("key", "line"), wanted, ["key"], "left_semi", MAX_KEYS)
    # Copies of a line are combined before the shuffle.
    sets = lines.dropDuplicates(["key"])
    return stored(sets.select("key", shingle_hashes(F.col("line")).alias("set")), "line_sets")


def confirm(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b) of line hashes whose full shingle sets reach the similarity."""
    left = sets.select(F.col("key").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("key").alias("b"), F.col("set").alias("set_b"))
    n, m = F.size("set_a"), F.size("set_b")
    # Sets of too different sizes need no look at what they share, which is computed once, being named once.
    near = 100 * F.least(n, m) >= similarity * F.greatest(n, m)
    shared = F.size(F.array_intersect("set_a", "set_b"))
    both = pairs.join(left, "a").join(right, "b")
    return both.filter(near & ((100 + similarity) * shared >= similarity * (n + m))).select("a", "b")


def with_bits(sets: DataFrame) -> DataFrame:
    """(key, set, MAPS longs): each hash of the set sets one bit of the longs."""
    hashes = sets.select("key", F.explode("set").alias("hash"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("hash").bitwiseAND(63)).cast("int"))
    place = F.shiftright("hash", 6).bitwiseAND(MAPS - 1)
    bits = [F.bit_or(F.when(place == i, bit).otherwise(0)).alias(name) for i, name in enumerate(bit_names(MAPS))]
    return sets.join(hashes.groupBy("key").agg(*bits), "key")


def bit_names(maps: int) -> list[str]:
    return [f"bits_{i}" for i in range(maps)]


def leftovers(members: DataFrame, groups: DataFrame, sets: DataFrame, similarity: int) -> DataFrame | None:
    """Links (a, b) between lines of different components in large buckets, found on the full sets.

    None if every large bucket is one component. ``sets`` has every line of a large bucket, as each is in a pair.

    Lines of a bucket's largest component are connected already, so only the others are compared: in
    blocks, each block of outsiders with each block of the bucket. A block pair is one row.
    """
    inside = members.filter(F.col("n") > BUCKET).select("band", "key")
    named = seen_as(groups.select(F.col("node").alias("key"), "component"), groups)
    placed = joined(inside, named, ["key"], "left", MAX_SIDE).withColumn("component", F.coalesce("component", "key"))
    placed = stored(placed.select("band", "key", "component"), "large_members")
    if not n_rows(placed):
        return None
    counted = placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    main = counted.groupBy("band").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"))
    main = main.filter(F.col("all") > F.col("top.n")).select("band", F.col("top.component").alias("main"))
    main = stored(main, "mixed_buckets")
    if not n_rows(main):
        return None
    mixed = stored(joined(placed, main, ["band"], "inner", MAX_SIDE), "mixed_members")
    wanted = stored(mixed.select("key").distinct(), "wanted_lines")
    sets = stored(with_bits(joined(sets, wanted, ["key"], "left_semi", MAX_KEYS)), "line_sets")
    sized = mixed.join(sets.select("key", F.size("set").alias("n")), "key")
    sized = sized.withColumn("out", F.col("component") != F.col("main"))
    # Blocks are limited in lines and in shingles.
    room = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)
    room_out = F.greatest(F.count_if("out") / BLOCK, F.sum(F.when(F.col("out"), F.col("n"))) / BLOCK_SHINGLES)
    rooms = sized.groupBy("band").agg(F.ceil(room).alias("n_blocks"), F.ceil(room_out).alias("n_out"))
    rooms = stored(rooms, "bucket_blocks")
    full = joined(mixed, rooms, ["band"], "inner", MAX_SIDE).join(sets, "key")
    entry = F.struct("key", "component", "set", *bit_names(MAPS))
    blocks = full.groupBy("band", F.pmod("key", "n_blocks").alias("block")).agg(F.collect_list(entry).alias("lines"))
    outside = full.filter("component != main").groupBy("band", "n_blocks", F.pmod("key", "n_out").alias("out"))
    outside = outside.agg(F.collect_list(entry).alias("outsiders"))
    outside = outside.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))

    pairs = blocks.join(outside, ["band", "block"])
    return pairs.select(F.inline(spanning_links("outsiders", "lines", similarity, MAPS))).distinct()


def spanning_links(left: str, right: str, similarity: int, maps: int = 0) -> Column:
    """Links (a, b) that connect what the alike lines of two blocks (arrays of key, component, set, bits) connect.

    ``names`` holds the component of every line of both blocks. The lines of the left block are taken in turn: one is
    compared with the lines of other components only, gets one link to each component it meets, and
    these take its name. So a block pair gives fewer links than it has components, however many pairs are alike.

    A bit that only the left line has (of ``maps`` longs) stands for a hash or more that only it has. If those are too
    many already, the sets are not compared.
    """

    def alike(x: Column, y: Column) -> Column:
        n, m = F.size(x["set"]), F.size(y["set"])
        near = 100 * F.least(n, m) >= similarity * F.greatest(n, m)
        only = [F.bit_count(x[name].bitwiseAND(F.bitwise_not(y[name]))) for name in bit_names(maps)]
        shared = F.size(F.array_intersect(x["set"], y["set"]))
        most = reduce(Column.__sub__, only, n)
        return near & ((100 + similarity) * most >= similarity * (n + m)) & ((100 + similarity) * shared >= similarity * (n + m))

    def link(x: Column, y: Column) -> Column:
        return F.struct(F.least(x["key"], y["key"]).alias("a"), F.greatest(x["key"], y["key"]).alias("b"))

    def bound(value: Column, use) -> Column:
        """``use(value)`` with the value computed once."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def merge(state: Column, i: Column) -> Column:
        return bound(F.get(left, i), lambda x: merge_line(state, x, F.get(state["names"], F.size(right) + i)))

    def merge_line(state: Column, x: Column, own: Column) -> Column:
        names = state["names"]
        met = F.filter(right, lambda y, j: (F.get(names, j) != own) & alike(x, y))
        return bound(
            F.array_distinct(F.transform(met, lambda y: F.get(names, F.array_position(F.col(right)["key"], y["key"]).cast("int") - 1))),
            lambda others: F.struct(
                F.transform(names, lambda name: F.when(F.array_contains(others, name), own).otherwise(name)).alias("names"),
                F.concat(
                    state["links"],
                    F.transform(others, lambda name: link(x, F.get(right, F.array_position(names, name).cast("int") - 1))),
                ).alias("links"),
            ),
        )

    start = F.struct(
        F.concat(F.col(right)["component"], F.col(left)["component"]).alias("names"),
        F.expr("CAST(array() AS array<struct<a: bigint, b: bigint>>)").alias("links"),
    )
    turns = F.sequence(F.lit(0), F.size(left) - 1)
    return F.aggregate(turns, start, merge, lambda state: state["links"])


def line_groups(documents: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """(node, component) of every line hash that is like another one's line."""
    rows = band_rows(stored(signatures(documents), "line_signatures"))
    # Every line has one row, so the rows of a band are its lines.
    buckets = stored(rows.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
    members = stored(joined(rows, buckets, ["band"], "inner", MAX_KEYS).select("band", "n", "key"), "bucket_members")
    pairs = stored(bucket_pairs(members), "line_pairs")
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "wanted_lines")
    sets = line_sets(wanted, documents)
    links = stored(confirm(pairs, sets, similarity), "line_links")
    groups = stored(connected_components(links), "line_components")
    more = leftovers(members, groups, sets, similarity)
    if more is not None and n_rows(more := stored(more, "line_links")):
        groups = stored(connected_components(links.unionByName(more)), "line_components")
    return groups


def repeated_lines(documents: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """(id, mark, places): the lines of each document that are like an earlier line."""
    spots = stored(lines_of(documents).select("id", "mark", "place", "key"), "line_occurrences")
    groups = line_groups(documents, similarity)
    named = seen_as(groups.select(F.col("node").alias("key"), "component"), groups)
    # Rows are only counted here, without their places, for the many lines that occur once and are like no other.
    counted = joined(spots.groupBy("key").agg(F.count(F.lit(1)).alias("n")), named, ["key"], "left", MAX_SIDE)
    counted = counted.filter("n > 1 OR component IS NOT NULL")
    repeated = stored(counted.select("key", F.coalesce("component", "key").alias("component")), "repeated_keys")
    seen = joined(spots, repeated, ["key"], "inner", MAX_SIDE)
    seen = stored(seen.select("component", "id", "mark", "place"), "repeated_occurrences")
    best = seen.groupBy("component").agg(F.min(F.struct("id", "place")).alias("best"))
    best = best.select("component", F.col("best.id").alias("keep_id"), F.col("best.place").alias("keep_place"))
    kept = joined(seen, stored(best, "group_firsts"), ["component"], "inner", MAX_SIDE)
    gone = kept.filter("id != keep_id OR place != keep_place")
    return gone.groupBy("id", "mark").agg(F.collect_set("place").alias("places"))


def line_dedup(documents: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Documents without repeated lines, with n_lines (not blank) and n_removed."""
    gone = stored(repeated_lines(documents, similarity), "repeated_places", places=F.sum(F.size("places")))
    total = gone.seen.get("places") or 0
    side = gone.withColumnsRenamed({"id": "_gone_id", "mark": "_gone_mark", "places": "_gone_places"})
    if total <= MAX_REPEATS:
        side = F.broadcast(side)
    same = (id_or_last(documents["doc_id"]) == F.col("_gone_id")) & (
        F.xxhash64(documents["text"]) == F.col("_gone_mark")
    )
    left = F.filter("_lines", lambda line, i: ~F.array_contains("_gone_places", i))
    blank = F.filter("_lines", lambda line: F.ltrim(line, F.lit(ENDS)) == "")
    return (
        documents.join(side, same, "left")
        .withColumn("_lines", F.split("text", "\n"))
        .withColumns(
            {
                "n_lines": F.coalesce(F.size("_lines") - F.size(blank), F.lit(0)).cast("long"),
                "n_removed": F.coalesce(F.size("_gone_places"), F.lit(0)).cast("long"),
                "text": F.when(F.col("_gone_places").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")),
            }
        )
        .drop("_gone_id", "_gone_mark", "_gone_places", "_lines")
    )


def op8_line_dedup(spark, sf_dir):
    return line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )
