"""Filter interaction audit: what each filter removes under every order of the filters.

1. ``measure`` runs a table-driven transducer over the UTF-8 bytes of the texts. State and byte choose the next
   state and what is emitted: word start, word end, capital, continuation byte, symbol. The state is
   carried over pieces of the byte buffer and reset where a text starts, so that one pass counts words,
   code points, capitals and symbols, and lists the word spans.
2. Word spans are inserted into an open-addressing hash table, many at once: every span looks at its slot,
   empty slots are claimed, and a span that meets another one is compared with it byte for byte;
   a different word moves on to the next slot. What stays in the table are the different words.
3. ``fails`` is the string of letters of the filters a document fails. Counts per (part, fails, labels)
   are all that the orders need, so documents are aggregated once and the 120 orders of
   five filters are laid out over a few rows per part.

A table of repeated texts (SHA-256 and smallest id) decides which documents repeat an earlier one.

Memory of a task: the Arrow batch, one piece of ``PIECE`` bytes, and for the texts at hand about 30 bytes a word.

Nulls and edge cases: a null text counts as empty, a null part as the empty string, and both join those that are
empty; an empty text fails none of the ratio filters; a null id counts as larger than all ids, so such a row
repeats any row with an id and the same text; rows that share their smallest id all stay; several label rows
of an id count as 1 if one of them does; rows without labels count as 0; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txlens.llm.shared import BLANKS, id_or_last, joined, read_table, stored

MAX_GROUPS = 200_000  # broadcast bound: about 80 bytes a group of repeated texts
MAX_LABELS = 500_000  # broadcast bound: about 20 bytes a labelled document
PIECE = 1 << 20  # bytes that the transducer reads at once
SPANS = 1 << 18  # word spans that are inserted at once
LONG = 256  # words of more bytes are hashed and compared one by one

# The symbols of filter D.
SYMBOLS = "#$%&*|"

START, END, CAPITAL, CONTINUED, SYMBOL = 1, 2, 4, 8, 16
_GAP, _WORD = 0, 1


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(next state, emission), each indexed by 256 * state + byte."""
    byte = np.arange(256)
    blank = np.isin(byte, list(map(ord, BLANKS)))
    common = (
        CAPITAL * ((byte >= ord("A")) & (byte <= ord("Z")))
        + CONTINUED * (byte & 0xC0 == 0x80)
        + SYMBOL * np.isin(byte, list(map(ord, SYMBOLS)))
    )
    after = np.where(blank, _GAP, _WORD)
    emitted = np.concatenate([common + START * ~blank, common + END * blank])
    return np.concatenate([after, after]).astype(np.uint8), emitted.astype(np.uint8)


NEXT, EMIT = _tables()
# Every byte leads to the same state from all states, so a piece can be read as a whole.
assert (NEXT[:256] == NEXT[256:]).all()


def transduce(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """(starts, ends) of all words, and the counts of each text.

    ``bounds`` has the start of every text in ``data`` and the end of the last.
    """
    n = len(bounds) - 1
    starts, ends = [], []
    seen = {flag: np.zeros(n, np.int64) for flag in (CAPITAL, CONTINUED, SYMBOL)}
    state = _GAP
    for low in range(0, len(data), PIECE):
        piece = data[low : low + PIECE]
        after = NEXT[piece]
        before = np.empty_like(after)
        before[0], before[1:] = state, after[:-1]
        state = int(after[-1])
        first, last = np.searchsorted(bounds, [low, low + len(piece)])
        new = np.unique(bounds[first:last]) - low  # texts that start here
        cut = new[before[new] == _WORD]
        before[new] = _GAP
        out = EMIT[before.astype(np.uint16) << 8 | piece]
        starts.append(np.flatnonzero(out & START) + low)
        over = np.flatnonzero(out & END)
        ends.append(np.sort(np.concatenate([over, cut])) + low)
        for flag, count in seen.items():
            at = np.searchsorted(bounds, np.flatnonzero(out & flag) + low, "right") - 1
            count += np.bincount(at, minlength=n)
    if state == _WORD:
        ends.append(np.array([len(data)]))
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    starts, ends = join(starts), join(ends)
    words = np.diff(np.searchsorted(starts, bounds))
    counts = {
        "n_words": words,
        "n_points": np.diff(bounds) - seen[CONTINUED],
        "n_capitals": seen[CAPITAL],
        "n_symbols": seen[SYMBOL],
    }
    return starts, ends, counts


_MASKS = np.array([2 ** (8 * k) - 1 for k in range(9)], np.uint64)


class Words:
    """Spans of a byte buffer, hashed and compared eight bytes at a time."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray):
        self.data = np.concatenate([data, np.zeros(8, np.uint8)])
        self.lanes = np.ndarray((len(data) + 1,), np.dtype("<u8"), self.data, strides=(1,))
        self.starts, self.sizes, self.text = starts, ends - starts, text

    def lane(self, at: np.ndarray, k: int) -> np.ndarray:
        left = np.minimum(self.sizes[at] - 8 * k, 8)
        return self.lanes[self.starts[at] + 8 * k] & _MASKS[left]

    def raw(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i] + self.sizes[i]].tobytes()

    def hashes(self, at: np.ndarray) -> np.ndarray:
        out = (self.text[at] * 1_000_003 + self.sizes[at]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        long = self.sizes[at] > LONG
        k, rest = 0, np.flatnonzero(~long)
        while len(rest):
            mixed = (out[rest] ^ self.lane(at[rest], k)) * np.uint64(0xFF51AFD7ED558CCD)
            out[rest] = mixed ^ (mixed >> np.uint64(32))
            k += 1
            rest = rest[self.sizes[at[rest]] > 8 * k]
        for i in np.flatnonzero(long):
            out[i] ^= np.uint64(xxhash.xxh64_intdigest(self.raw(at[i])))
        return out

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = (self.text[a] == self.text[b]) & (self.sizes[a] == self.sizes[b])
        long = self.sizes[a] > LONG
        k, rest = 0, np.flatnonzero(out & ~long & (a != b))
        while len(rest):
            same = self.lane(a[rest], k) == self.lane(b[rest], k)
            out[rest[~same]] = False
            k += 1
            rest = rest[same]
            rest = rest[self.sizes[a[rest]] > 8 * k]
        for i in np.flatnonzero(out & long & (a != b)):
            out[i] = self.raw(a[i]) == self.raw(b[i])
        return out


def insert(words: Words, low: int, high: int) -> np.ndarray:
    """Places of the spans from ``low`` to ``high`` that stay in the hash table: one of each word of a text."""
    bits = max(1, int(2 * (high - low) - 1).bit_length())
    table = np.full(1 << bits, -1, np.int64)
    last = np.int64((1 << bits) - 1)
    for begin in range(low, high, SPANS):
        todo = np.arange(begin, min(begin + SPANS, high))
        slot = (words.hashes(todo) >> np.uint64(64 - bits)).astype(np.int64)
        while len(todo):
            free = table[slot] < 0
            table[slot[free]] = todo[free]  # of several spans that claim a slot one gets it
            other = np.flatnonzero(~words.equal(table[slot], todo))
            todo, slot = todo[other], (slot[other] + 1) & last
    return table[table >= 0]


def counted(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of every text: n_words, n_distinct, n_points, n_capitals, n_symbols."""
    starts, ends, counts = transduce(data, bounds)
    words = Words(data, starts, ends, np.repeat(np.arange(len(bounds) - 1), counts["n_words"]))
    first = np.concatenate([[0], np.cumsum(counts["n_words"])])  # first span of every text
    distinct = np.zeros(len(bounds) - 1, np.int64)
    at = 0
    while at < len(distinct):  # whole texts of up to SPANS words together, a longer one alone
        stop = max(at + 1, int(np.searchsorted(first, first[at] + SPANS, "right")) - 1)
        kept = insert(words, int(first[at]), int(first[stop])) if first[stop] > first[at] else np.zeros(0, np.int64)
        distinct[at:stop] = np.bincount(words.text[kept] - at, minlength=stop - at)
        at = stop
    return {**counts, "n_distinct": distinct}


COUNTS = ("n_words", "n_distinct", "n_points", "n_capitals", "n_symbols")


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        large = pa.types.is_large_string(texts.type)
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64 if large else np.int32) if offsets else np.zeros(1, np.int32)
        bounds = bounds[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        counts = counted(data[bounds[0] : bounds[-1]], bounds - bounds[0])
        rest = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in rest] + [pa.array(counts[n]) for n in COUNTS], names=[*rest, *COUNTS]
        )


def measure(documents: DataFrame, text: str = "text", **keep: Column) -> DataFrame:
    """Columns ``keep`` and the counts of every text."""
    rows = documents.select(*[c.alias(n) for n, c in keep.items()], F.coalesce(text, F.lit("")).alias("text"))
    schema = ", ".join(
        [*(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"), *(f"{n} long" for n in COUNTS)]
    )
    return rows.mapInArrow(_measure, schema)


# The five filters as failure conditions on the counts; E is decided table-wide.
FILTERS = {
    "A": "n_words < 100",
    "B": "100 * n_distinct < 80 * n_words",
    "C": "100 * n_capitals > 10 * n_points",
    "D": "n_symbols > 0",
}
REPEATS = "E"


def failures(
    documents: DataFrame, part: str = "lang", filters: dict[str, str] | None = None, repeats: str | None = REPEATS
) -> DataFrame:
    """One row per document: id, part and fails, the letters of the filters it fails."""
    filters = FILTERS if filters is None else filters
    measured = measure(
        documents,
        id=id_or_last(),
        part=F.coalesce(F.col(part).cast("string"), F.lit("")),
        digest=F.sha2(F.coalesce("text", F.lit("")), 256),
    )
    letters = [F.when(F.expr(condition), letter).otherwise("") for letter, condition in filters.items()]
    rows = stored(measured.select("id", "part", "digest", F.concat(F.lit(""), *letters).alias("fails")), "measured")
    if not repeats:
        return rows.drop("digest")
    groups = rows.groupBy("digest").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("_size"))
    groups = stored(groups.filter("_size > 1").drop("_size"), "repeated")
    again = F.when(F.col("id") > F.col("first_id"), repeats).otherwise("")
    return joined(rows, groups, ["digest"], "left", MAX_GROUPS).select(
        "id", "part", F.concat("fails", again).alias("fails")
    )


def interaction_audit(fails: DataFrame, letters: str) -> DataFrame:
    """One row per part, filter_order and step from rows (part, fails, good, toxic); all counts are longs."""
    counts = fails.groupBy("part", "fails", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    orders = ["".join(p) for p in permutations(letters)]
    steps = F.sequence(F.lit(1), F.lit(len(letters)))
    laid = (
        counts.withColumn("filter_order", F.explode(F.lit(orders)))
        .withColumn("step", F.explode(steps))
        .withColumn("letter", F.expr("substring(filter_order, step, 1)"))
        .withColumn("before", F.expr("substring(filter_order, 1, step - 1)"))
    )
    failing = F.contains("fails", "letter")
    gone = F.expr("translate(fails, before, '') != fails")
    here = failing & ~gone
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    audit = laid.groupBy("part", "filter_order", "step", "letter").agg(
        total(~failing & ~gone).alias("kept"),
        total(here).alias("removed"),
        total(failing & gone).alias("redundant"),
        total(F.col("fails") == F.col("letter")).alias("unique_fails"),
        total(here & F.col("good")).alias("good_lost"),
        total(here & F.col("toxic")).alias("toxic_lost"),
    )
    return audit.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter"))).drop("letter")


def labelled(fails: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds good and toxic, false where there is no label; ``labels`` has doc_id, quality and toxic."""
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id"))
    marks = marks.agg(*[F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))])
    marks = stored(marks.filter("good OR toxic"), "labels")
    out = joined(fails, marks, ["id"], "left", MAX_LABELS)
    return out.select("part", "fails", *[F.coalesce(n, F.lit(False)).alias(n) for n in ("good", "toxic")])


def op12_filter_audit(spark, sf_dir):
    fails = failures(read_table(spark, sf_dir, "documents"))
    return interaction_audit(labelled(fails, read_table(spark, sf_dir, "labels")), "".join(FILTERS) + REPEATS)


SQL = r"""
WITH d AS (
  SELECT coalesce(doc_id, 9223372036854775807) AS id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
f AS (
  SELECT id, part,
         CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN id > min(id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM d),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
  FROM f LEFT JOIN l ON f.id = l.doc_id GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order
  FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
s AS (
  SELECT filter_order, step::INT AS step, filter_order[step] AS letter, left(filter_order, step::INT - 1) AS before
  FROM o, range(1, 6) r(step)),
j AS (
  SELECT m.*, s.*, contains(fails, letter) AS failing,
         before <> '' AND regexp_matches(fails, '[' || before || '0]') AS gone
  FROM m, s),
a AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN NOT failing AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN failing AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN failing AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails = letter THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN failing AND NOT gone AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN failing AND NOT gone AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM j GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM a
"""
