"""Substring deduplication by recompression of word sequences.

Parsing. In rounds, runs of equal symbols and then pairs get new symbols, whose names are hashes of
what they stand for, so that every task names alike without asking. Whether two neighbours pair
depends on one bit of each name only. So equal passages are parsed alike except near their
ends, and each symbol knows the words its parse depends on. A window (``WINDOW`` words in a row)
owns the symbols that depend on its own words alone: equal windows own equal symbols. Its anchor is
the owned symbol of least hash of the highest round of at most ``ROUNDS`` that it owns any of;
a single word if need be. The windows in a row that have one anchor form a region.

Finding repeats. Regions with equal words group; all but the first document of a group lose theirs.
Only where an anchor has several different regions can other windows repeat: there the
first document of every region lists its windows by hash, and a window whose hash an earlier document
lists is a repeat. No text is compared with all others, and copies of a region do no work
after the first. Anchor and word-sequence hash (128 bits together) stand for equal words.

Nulls and edge cases: null, empty and blank texts have no words; texts shorter than a window lose
nothing; a null id counts as larger than all ids; rows that repeat an id are not earlier than each
other and are told apart by their text; an empty table gives an empty result; other columns are
not looked at. A text is parsed in one task, in a few hundred bytes a word.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.llm.near_dedup import _mix, _Words
from txlens.llm.shared import id_or_last, id_or_null, joined, stored, within

WINDOW = 50
ROUNDS = 7
RUN_ROUNDS = (0, 4)
BATCH_WORDS = 200_000
MAX_SIDE = 20_000  # broadcast bound, at most 60 bytes a row
MAX_IDS = 500_000  # broadcast bound of (id, text hash) pairs
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_U = np.uint64


def words_of(text: str | None) -> list[bytes]:
    # bytes.split() splits at exactly [\x20\x09-\x0D].
    return (text or "").encode().split()


class _Level:
    """Symbols of one round: names, and the first and last-but-one word each depends on."""

    def __init__(self, name, low, high):
        self.name, self.low, self.high = name, low, high


def _runs(level: _Level, ends: np.ndarray) -> tuple[_Level, np.ndarray]:
    """Names maximal runs; to be maximal depends on both neighbours."""
    name = level.name
    first = np.flatnonzero(np.concatenate(([True], (name[1:] != name[:-1]) | ends[1:] | ends[:-1])))
    last = np.concatenate((first[1:], [len(name)])) - 1
    length = (last - first + 1).astype(np.uint64)
    named = np.where(length > 1, _mix(name[first] ^ (length * _U(0xD6E8FEB86659FD93))), name[first])
    low = np.minimum(level.low[first], level.low[np.maximum(first - 1, 0)])
    high = np.maximum(level.high[last], level.high[np.minimum(last + 1, len(name) - 1)])
    mark = ends[first]
    return _Level(named, np.where(mark, level.low[first], low), np.where(mark, level.high[last], high)), mark


def _pair(level: _Level, ends: np.ndarray, turn: int) -> tuple[_Level, np.ndarray]:
    """Names pairs of a left and a right symbol, sides being one bit of the hashed name."""
    name, n = level.name, len(level.name)
    right = (_mix(name ^ _U(0xA0761D6478BD642F * (turn + 1) % 2**64)) & _U(1)).astype(bool)
    opens = ~right & ~ends
    closes = right & ~ends
    merged = np.zeros(n, dtype=bool)
    merged[:-1] = opens[:-1] & closes[1:]
    kept = np.ones(n, dtype=bool)
    kept[1:] = ~merged[:-1]
    at = np.flatnonzero(kept)
    after, before = np.minimum(at + 1, n - 1), np.maximum(at - 1, 0)
    pair = merged[at]
    named = np.where(pair, _mix(name[at] * _U(0x9FB21C651E98DF25) + name[after] + _U(turn + 1)), name[at])
    # An unpaired left symbol depends on what follows, an unpaired right one on what precedes.
    low = np.where(~pair & closes[at], level.low[before], level.low[at])
    high = np.where(pair | opens[at], level.high[after], level.high[at])
    return _Level(named, low, high), ends[at]


def parse(hashes: np.ndarray, ends: np.ndarray) -> list[_Level]:
    """Levels from single words up; ``ends`` marks positions that separate documents."""
    place = np.arange(len(hashes), dtype=np.int64)
    level = _Level(hashes, place, place + 1)
    levels = [level]
    for turn in range(ROUNDS):
        if turn in RUN_ROUNDS:
            level, ends = _runs(level, ends)
        level, ends = _pair(level, ends, turn)
        levels.append(level)
    return levels


def _least(order: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Index of the least value in each closed range, leftmost of equals (doubling table)."""
    best = np.arange(len(order))
    out = np.empty(len(first), dtype=np.int64)
    span = np.frexp((last - first + 1).astype(float))[1] - 1
    for k in range(int(span.max()) + 1 if len(span) else 0):
        now = np.flatnonzero(span == k)
        a, b = best[first[now]], best[last[now] - (1 << k) + 1]
        out[now] = np.where(order[b] < order[a], b, a)
        a, b = best[: max(0, len(best) - (1 << k))], best[1 << k :]
        best = np.where(order[b] < order[a], b, a)
    return out


def anchors(levels: list[_Level], starts: np.ndarray, n_places: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor name and an anchor identity (level and index) of every window start."""
    name, which = np.empty(len(starts), dtype=np.uint64), np.empty(len(starts), dtype=np.int64)
    todo = np.arange(len(starts))
    for depth in range(len(levels) - 1, -1, -1):
        level, at = levels[depth], starts[todo]
        # Symbols before the first that depends on nothing left of the window, and up to the last
        # that depends on nothing right of it; both bounds grow along the text.
        below = np.concatenate(([0], np.cumsum(np.bincount(level.low, minlength=n_places + 1))))
        upto = np.cumsum(np.bincount(level.high, minlength=n_places + 2))
        first, last = below[at], upto[at + WINDOW] - 1
        owned = first <= last
        rows = todo[owned]
        if len(rows):
            best = _least(_mix(level.name ^ _U(depth)), first[owned], last[owned])
            name[rows] = _mix(level.name[best] + _U(depth))
            which[rows] = best * 16 + depth
        todo = todo[~owned]
        if not len(todo):
            break
    return name, which


class _Sums:
    """Position-free hashes of word ranges."""

    def __init__(self):
        self.power = self.inverse = np.ones(1, dtype=np.uint64)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if len(self.power) <= len(hashes):
            n = 2 * len(hashes) + 1
            for name, base in (("power", _BASE), ("inverse", _BASE_INVERSE)):
                steps = np.full(n, base % 2**64, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        mixed = _mix(hashes ^ _U(0x2545F4914F6CDD1D))
        return np.concatenate(([_U(0)], np.cumsum(mixed * self.power[: len(hashes)], dtype=np.uint64)))

    def range(self, sums: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((sums[end] - sums[first]) * self.inverse[first] + (end - first).astype(np.uint64))


def _hashes(words: list[bytes], memo: dict) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))


def _regions_of(docs: list[np.ndarray], sums: _Sums):
    """Document number, anchor, region hash, first window and number of windows of all regions."""
    gap = np.zeros(1, dtype=np.uint64)
    hashes = np.concatenate([gap, *[part for d in docs for part in (d, gap)]])
    sizes = np.array([len(d) for d in docs])
    first_word = 1 + np.concatenate(([0], np.cumsum(sizes[:-1] + 1)))
    ends = np.zeros(len(hashes), dtype=bool)
    ends[np.concatenate(([0], first_word + sizes))] = True
    levels = parse(hashes, ends)
    n_windows = sizes - WINDOW + 1
    doc = np.repeat(np.arange(len(docs)), n_windows)
    offset = np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    starts = first_word[doc] + offset
    name, which = anchors(levels, starts, len(hashes))
    new = np.concatenate(([True], (which[1:] != which[:-1]) | (doc[1:] != doc[:-1])))
    at = np.flatnonzero(new)
    length = np.diff(np.concatenate((at, [len(starts)])))
    total = sums.of(hashes)
    region = sums.range(total, starts[at], starts[at] + length + WINDOW - 1)
    return doc[at], name[at], region, offset[at], length


def find_regions(texts: DataFrame) -> DataFrame:
    """Regions (id, mark, anchor, region, at, n) of every text of at least one window."""

    def find(batches):
        memo, sums = _Words(), _Sums()
        for batch in batches:
            ids, marks, docs, size = [], [], [], 0
            rows = list(zip(batch["id"], batch["mark"], batch["text"]))
            for i, (key, mark, text) in enumerate(rows):
                words = words_of(text)
                if len(words) >= WINDOW:
                    ids.append(key)
                    marks.append(mark)
                    docs.append(_hashes(words, memo))
                    size += len(words)
                if docs and (size >= BATCH_WORDS or i + 1 == len(rows)):
                    doc, anchor, region, at, n = _regions_of(docs, sums)
                    yield pd.DataFrame({
                        "id": np.asarray(ids)[doc], "mark": np.asarray(marks)[doc], "anchor": anchor.view(np.int64),
                        "region": region.view(np.int64), "at": at.astype(np.int32), "n": n.astype(np.int32),
                    })
                    ids, marks, docs, size = [], [], [], 0

    return texts.mapInPandas(find, "id long, mark long, anchor long, region long, at int, n int")


def list_windows(rows: DataFrame) -> DataFrame:
    """Windows (anchor, window, id, mark, at) of the regions listed with each text."""

    def windows(batches):
        memo, sums = _Words(), _Sums()
        for batch in batches:
            out: dict[str, list] = {name: [] for name in ("anchor", "window", "id", "mark", "at")}
            for key, mark, text, spans in zip(batch["id"], batch["mark"], batch["text"], batch["spans"]):
                total = sums.of(_hashes(words_of(text), memo))
                n = np.array([s["n"] for s in spans])
                at = np.repeat([s["at"] for s in spans], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                out["anchor"].append(np.repeat(np.array([s["anchor"] for s in spans], dtype=np.int64), n))
                out["window"].append(sums.range(total, at, at + WINDOW).view(np.int64))
                out["id"].append(np.full(len(at), key, dtype=np.int64))
                out["mark"].append(np.full(len(at), mark, dtype=np.int64))
                out["at"].append(at.astype(np.int32))
            if out["at"]:
                yield pd.DataFrame({name: np.concatenate(parts) for name, parts in out.items()})

    return rows.mapInPandas(windows, "anchor long, window long, id long, mark long, at int")


def cut_words(rows: DataFrame) -> DataFrame:
    """n_words, n_removed, kept words' SHA-256 and kept text of texts with their repeated spans."""

    def cut(batches):
        for batch in batches:
            out = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept_text": []}
            for text, spans in zip(batch["text"], batch["spans"]):
                words, removed = words_of(text), 0
                out["n_words"].append(len(words))
                if spans is not None and len(spans):
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(change, [s["at"] for s in spans], 1)
                    np.add.at(change, [s["at"] + s["n"] + WINDOW - 1 for s in spans], -1)
                    covered = np.cumsum(change[:-1]) > 0
                    removed = int(covered.sum())
                    words = [words[i] for i in np.flatnonzero(~covered)]
                kept = b" ".join(words)
                out["n_removed"].append(removed)
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept_text"].append(kept.decode())
            yield pd.DataFrame({"id": batch["id"], **out})

    kind = "id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    return rows.mapInPandas(cut, kind)


def repeated_spans(texts: DataFrame) -> DataFrame:
    """Spans (id, mark, at, n) of n windows in a row that repeat an earlier document's."""
    regions = stored(find_regions(texts), "regions")
    # Most anchors belong to one document; their regions go no further.
    shared = regions.groupBy("anchor").agg(
        F.min("id").alias("f"), F.max("id").alias("l"), F.min("region").alias("r0"), F.max("region").alias("r1")
    ).filter("f != l")
    shared = stored(shared.select("anchor", F.expr("r0 != r1").alias("several")), "shared_anchors")
    regions = stored(joined(regions, shared, ["anchor"], "inner", MAX_SIDE), "shared_regions")
    groups = regions.groupBy("anchor", "region").agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.max("several").alias("_several")
    ).filter("first != last OR _several")
    groups = stored(groups.select("anchor", "region", "first"), "groups")
    known = stored(joined(regions, groups, ["anchor", "region"], "inner", MAX_SIDE), "known_regions")
    whole = known.filter("id > first").select("id", "mark", "at", "n")
    doubtful = known.filter("id = first AND several").groupBy("id", "mark").agg(
        F.collect_set(F.struct("at", "n", "anchor")).alias("spans")  # rows that repeat id and text share theirs
    )
    listed = stored(list_windows(_with_texts(texts, stored(doubtful, "doubtful"), "inner")), "windows")
    first = listed.groupBy("anchor", "window").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    first = stored(first.filter("first != last").select("anchor", "window", "first"), "first_windows")
    again = joined(listed, first, ["anchor", "window"], "inner", MAX_SIDE).filter("id > first")
    return whole.unionByName(again.select("id", "mark", "at", F.lit(1).alias("n")))


def _with_texts(texts: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """Joins spans to texts; only texts that have spans are shuffled if their ids can be broadcast."""
    key = ["id", "mark"]
    ids = spans.select(*key)
    if not within(spans, MAX_IDS):
        return texts.join(spans, key, how)
    found = texts.join(F.broadcast(ids), key, "left_semi").join(spans, key)
    if how == "inner":
        return found
    alone = texts.join(F.broadcast(ids), key, "left_anti")
    return found.unionByName(alone.withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType)))


def substring_dedup(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept_text of every document."""
    texts = documents.select(
        id_or_last().alias("id"), F.xxhash64("text").alias("mark"), "text"
    )
    spans = repeated_spans(texts).groupBy("id", "mark").agg(F.collect_set(F.struct("at", "n")).alias("spans"))
    out = cut_words(_with_texts(texts, stored(spans, "spans"), "left"))
    return out.withColumn("doc_id", id_or_null("id")).drop("id")


def op2_substring_dedup(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return substring_dedup(documents).select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS m FROM s),
f AS (SELECT m, min(doc_id) AS first FROM h GROUP BY m),
r AS (SELECT h.doc_id, h.i FROM h JOIN f USING (m) WHERE h.doc_id > f.first),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
c AS (SELECT p.doc_id, p.i, p.word,
             max(r.i) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
      FROM p LEFT JOIN r ON r.doc_id = p.doc_id AND r.i = p.i),
k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed,
             sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
      FROM c GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(k.n_removed, 0) AS n_removed,
       coalesce(k.kept_sha256, sha256('')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""
