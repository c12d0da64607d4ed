"""Document fingerprints: bottom-k sketches of shingle hashes, DataFrame functions only.

A text's shingles are its runs of ``SHINGLE_WORDS`` words ``[^\\x20\\x09-\\x0D]+``, unchanged; a text with
fewer words is one shingle, a text without words has none. Its fingerprint is the sorted array of the
``SKETCH`` smallest different 64-bit shingle hashes (all of them, if fewer). Sketches of parts merge
into the sketch of the whole: ``merged`` for two columns, ``merge_parts`` for any number of rows.
From two sketches follow the resemblance and containment of the shingle sets, from one the number of
its different shingles; with fewer than ``SKETCH`` shingles all three are exact.

``edited_neighbours`` puts every document beside the next one by id. Ids are dealt by range into
slices, and only a slice's ends look across to its neighbours, so no task sees all ids. Texts are
shuffled once; the head of the next text and its sketch once more.

Nulls and edge cases: a null text counts as empty and has the empty fingerprint; two empty sketches are
fully alike, an empty and another one not at all; a null id sorts after all ids; rows that share an id
are ordered by the hash of their text; rows that repeat id and text are one document and get
one result each; the only document of a table is next to itself; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txlens.llm.shared import BLANKS, WORD_GAP, id_or_last, id_or_null, read_table, stored

SHINGLE_WORDS = 5
SKETCH = 128


def with_sketches(df: DataFrame, texts: dict[str, str], words: int = SHINGLE_WORDS, size: int = SKETCH) -> DataFrame:
    """Adds sketch columns; ``texts`` gives the text column of each.

    Word hashes are a column of their own that the next step names several times, so that Spark
    computes them once a row and not once a shingle.
    """
    held = {name: f"_{name}_words" for name in texts}

    def hashes(text: str) -> Column:
        trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(BLANKS))
        parts = F.filter(F.split(trimmed, WORD_GAP), lambda w: w != "")
        return F.transform(parts, lambda w: F.xxhash64(w))

    def shingles(column: str) -> Column:
        array, n = F.col(column), F.size(column)
        runs = F.transform(
            F.sequence(F.lit(0), n - words), lambda i: F.xxhash64(*[F.get(array, i + k) for k in range(words)])
        )
        return F.when(n >= words, runs).when(n > 0, F.array(F.xxhash64(array))).otherwise(F.array().cast("array<long>"))

    out = df.withColumns({held[name]: hashes(text) for name, text in texts.items()})
    return out.withColumns({name: smallest(shingles(column), size) for name, column in held.items()}).drop(*held.values())


def smallest(hashes: Column, size: int = SKETCH) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, size)


def merged(a: Column | str, b: Column | str, size: int = SKETCH) -> Column:
    """Sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, size)


def merge_parts(parts: DataFrame, keys: list[str], sketch: str = "sketch", size: int = SKETCH) -> DataFrame:
    """(keys, sketch): one sketch for all rows of a key, of whatever number.

    Repeated hashes meet in a partial aggregate, and each task passes on at most ``size`` hashes a key.
    """
    hashes = parts.select(*keys, F.explode_outer(sketch).alias("_hash")).distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_hash").asc_nulls_last()))
    kept = hashes.withColumn("_place", place).filter(F.col("_place") <= size)
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list("_hash")).alias(sketch))


def resemblance(a: str, b: str, size: int = SKETCH) -> Column:
    """Jaccard similarity: the share of the smallest hashes of both that are in both."""
    both = merged(a, b, size)
    shared = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return F.when(F.size(both) == 0, 1.0).otherwise(shared / F.size(both))


def containment(a: str, b: str, size: int = SKETCH) -> Column:
    """Share of the shingles of ``a`` that ``b`` has: over the range of hashes that both sketches cover."""
    top = F.lit(2**63 - 1)
    reach = lambda s: F.when(F.size(s) < size, top).otherwise(F.element_at(s, -1))
    limit = F.least(reach(a), reach(b))
    inside = F.size(F.filter(a, lambda h: h <= limit))
    shared = F.size(F.filter(F.array_intersect(a, b), lambda h: h <= limit))
    return F.when(F.size(a) == 0, 1.0).when(inside == 0, 0.0).otherwise(shared / inside)


def distinct_shingles(sketch: str, size: int = SKETCH) -> Column:
    """Number of different shingles: exact up to ``size - 1``, else from the largest hash kept."""
    reach = (F.element_at(sketch, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(sketch) < size, F.size(sketch).cast("double")).otherwise((size - 1) / reach)


def as_text(sketch: str) -> Column:
    """16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def _before(ids: DataFrame) -> DataFrame:
    """(id, mark, prev): the document before each one in descending order; before the first comes the last.

    ``ids`` has different (id, mark) and columns for ``prev``, a struct of all of them.
    """
    row = F.struct(*ids.columns)
    dealt = ids.repartitionByRange(F.col("id").desc(), F.col("mark").asc()).withColumn("slice", F.spark_partition_id())
    dealt = stored(dealt, "ids")
    inside = Window.partitionBy("slice").orderBy(F.col("id").desc(), "mark")
    ends = dealt.groupBy("slice").agg(F.max_by(row, F.struct(F.bitwise_not("id"), "mark")).alias("_end"))
    every = Window.orderBy("slice")  # one row a slice
    last = F.last("_end").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = ends.select("slice", F.coalesce(F.lag("_end").over(every), last).alias("_end"))
    out = dealt.withColumn("_prev", F.lag(row).over(inside)).join(F.broadcast(ends), "slice")
    return out.select("id", "mark", F.coalesce("_prev", "_end").alias("prev"))


def edited_neighbours(documents: DataFrame, words: int = SHINGLE_WORDS, size: int = SKETCH) -> DataFrame:
    """One row per document: doc_id, text, edited (text), and the sketches sketch, edited_sketch, next_sketch.

    The edited text is the text with its last half replaced by as much of the next document's start.
    """
    docs = documents.select(id_or_last().alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.select("id", F.xxhash64("text").alias("mark"), "text")
    ids = docs.groupBy("id", "mark").agg(F.first(F.length("text")).alias("n"), F.count(F.lit(1)).alias("copies"))
    links = stored(_before(ids), "links", most=F.max("prev.copies"))
    if (links.seen.get("most") or 1) > 1:
        docs = docs.groupBy("id", "mark").agg(F.first("text").alias("text"))
    heads = with_sketches(docs.join(links, ["id", "mark"]), {"next_sketch": "text"}, words, size).select(
        F.col("prev.id").alias("id"),
        F.col("prev.mark").alias("mark"),
        F.col("prev.copies").alias("copies"),
        F.expr("substring(text, 1, CAST(prev.n DIV 2 AS INT))").alias("head"),
        "next_sketch",
    )
    both = docs.join(heads, ["id", "mark"])
    half = F.expr("substring(text, 1, length(text) - CAST(length(text) DIV 2 AS INT))")
    both = both.withColumn("edited", F.concat(half, "head"))
    both = with_sketches(both, {"sketch": "text", "edited_sketch": "edited"}, words, size)
    if (links.seen.get("most") or 1) > 1:
        both = both.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return both.select(
        id_or_null("id").alias("doc_id"), "text", "edited", "sketch", "edited_sketch", "next_sketch"
    )


def op13_fingerprints(spark, sf_dir):
    return edited_neighbours(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text("sketch").alias("fingerprint"),
        as_text("edited_sketch").alias("edited_fingerprint"),
        resemblance("sketch", "edited_sketch").alias("near_edited"),
        resemblance("sketch", "next_sketch").alias("near_next"),
        distinct_shingles("sketch").alias("distinct_shingles"),
    )
