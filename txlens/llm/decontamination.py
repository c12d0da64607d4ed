"""Benchmark decontamination: BM25 with block-max pruning over an index of test items.

Index. Test items (in pieces of at most ``PIECE`` words) are the indexed texts. A posting's impact is
its BM25 weight divided by the piece's score against itself, so 1 means that all a piece weighs
was found. Postings are kept per term by piece, with the maximum per term and per block of
``BLOCK`` pieces. Spark counts document frequencies and impacts over all items; an index holds at most
``MAX_POSTINGS`` postings, and larger benchmarks are searched in several such shards.

Search. Every passage of every document (``2 * PIECE`` words, every ``PIECE`` words, so that each run of
``PIECE`` words lies in one passage) is a query. As in WAND, its terms are ordered by their maximum: up to
the pivot they cannot reach the threshold together, so only blocks that have a term from the
pivot on are looked at. Blocks whose maxima cannot reach the threshold are skipped, the others
are scored piece by piece. All pieces above the threshold are retrieved. The passages of a text go through
these steps together, as arrays.

Verification. Of an item retrieved, question and answer must each share at least ``OVERLAP`` of their word
trigrams with the document. Items without question and answer columns are split in half.

Nulls and edge cases: null and blank texts and items match nothing; a null item id is ignored; a null
doc_id is reported as null; repeated rows are reported each; equal items are reported each;
empty tables give empty results; other columns are not looked at.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.llm.shared import id_or_last, id_or_null, n_rows, stored, within

PIECE = 64
BLOCK = 8
THRESHOLD, OVERLAP = 0.6, 0.5
K1, B = 1.2, 0.75
MAX_POSTINGS = 1_000_000
CELLS = 16_384  # passages times blocks looked at together; at most 2 * PIECE list entries a cell
MAX_FOUND = 200_000  # broadcast bound of contaminated documents
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def grams(words: list[str], n: int) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def shared(part: list[str], words: list[str]) -> float:
    """Share of a part's word trigrams that a text has; shorter grams if the part is shorter."""
    wanted = grams(part, min(3, len(part))) if part else set()
    return len(wanted & grams(words, min(3, len(part)))) / len(wanted) if wanted else 1.0


def halves(text: str | None, question: str | None, answer: str | None) -> tuple[list[str], list[str]]:
    if question is not None or answer is not None:
        return words_of(question), words_of(answer)
    words = words_of(text)
    return words[: (len(words) + 1) // 2], words[(len(words) + 1) // 2 :]


def weigh_postings(items: DataFrame) -> DataFrame:
    """Postings (item_id, piece, term, impact) of items (item_id, text, question, answer)."""

    def split(batches):
        for batch in batches:
            rows = []
            for item, *texts in zip(batch["item_id"], batch["text"], batch["question"], batch["answer"]):
                words = [w for part in halves(*texts) for w in part]
                for at in range(0, max(1, len(words) - PIECE // 2), PIECE // 2):
                    piece = words[at : at + PIECE]
                    rows += [(item, at, w, piece.count(w), len(piece)) for w in dict.fromkeys(piece)]
                    if at + PIECE >= len(words):
                        break
            yield pd.DataFrame(rows, columns=["item_id", "piece", "term", "tf", "size"])

    kind = "item_id long, piece long, term string, tf long, size long"
    postings = stored(items.mapInPandas(split, kind).dropDuplicates(["item_id", "piece", "term"]), "postings")
    pieces = postings.groupBy("item_id", "piece").agg(F.first("size").alias("size"))
    totals = pieces.agg(F.count(F.lit(1)).alias("n_pieces"), F.avg("size").alias("mean_size")).first()
    n, mean = totals["n_pieces"], totals["mean_size"] or 1.0
    seen = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    rarity = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    length = 1 - B + B * F.col("size") / mean
    weighed = postings.join(seen, "term").withColumn(
        "weight", rarity * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * length)
    )
    own = weighed.groupBy("item_id", "piece").agg(F.sum("weight").alias("own"))
    return weighed.join(own, ["item_id", "piece"]).select(
        "item_id", "piece", "term", (F.col("weight") / F.col("own")).alias("impact")
    )


class Index:
    """Postings of one shard: per term its blocks with maxima, per (term, block) its pieces."""

    def __init__(self, postings: pd.DataFrame, parts: dict[int, tuple[list[str], list[str]]], own: dict[int, int]):
        pieces = postings[["item_id", "piece"]].drop_duplicates().sort_values(["item_id", "piece"])
        self.items = pieces["item_id"].to_numpy(dtype=np.int64)
        number = {p: i for i, p in enumerate(zip(pieces["item_id"], pieces["piece"]))}
        place = np.array([number[p] for p in zip(postings["item_id"], postings["piece"])], dtype=np.int64)
        names, term = np.unique(postings["term"].to_numpy(dtype=str), return_inverse=True)
        self.terms = {str(w): i for i, w in enumerate(names)}
        order = np.lexsort((place, term))
        self.place, self.impact = place[order], postings["impact"].to_numpy()[order]
        term = term[order]
        first = np.flatnonzero(np.diff(term * (2 + place.max()) + self.place // BLOCK, prepend=-1))
        self.block, self.block_max = self.place[first] // BLOCK, np.maximum.reduceat(self.impact, first)
        self.block_end = np.concatenate((first[1:], [len(order)]))
        self.block_start = first
        self.term_start = np.searchsorted(term[first], np.arange(len(names) + 1))
        self.term_max = np.maximum.reduceat(self.block_max, self.term_start[:-1])
        self.n_blocks = int(self.block.max()) + 1
        self.parts, self.own = parts, own

    def _lists(self, terms: np.ndarray) -> np.ndarray:
        """Positions of all blocks of the terms."""
        start, size = self.term_start[terms], self.term_start[terms + 1] - self.term_start[terms]
        return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())

    def search(
        self, terms: np.ndarray, passage: np.ndarray, n: int, threshold: float
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, piece, score): all pieces whose score for a passage's distinct terms reaches the threshold.

        The passages 0 to n - 1 are searched together: ``terms`` and ``passage`` are distinct pairs, and what is
        kept per block is kept per cell of passage and block.
        """
        order = np.lexsort((self.term_max[terms], passage))
        terms, passage = terms[order], passage[order]
        upper = self.term_max[terms]
        total = np.concatenate(([0.0], np.cumsum(upper)))
        reach = total[1:] - total[np.searchsorted(passage, np.arange(n))][passage]
        late = reach >= threshold - 1e-9  # terms from the pivot on
        n_cells = n * self.n_blocks

        def cells(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = self._lists(terms[some])
            size = self.term_start[terms[some] + 1] - self.term_start[terms[some]]
            return at, np.repeat(passage[some], size) * self.n_blocks + self.block[at]

        after, cell_after = cells(late)
        bound = np.bincount(cell_after, self.block_max[after], n_cells)
        rest = np.bincount(passage[~late], upper[~late], n)
        opened = (bound > 0) & (bound >= np.repeat(threshold - 1e-9 - rest, self.n_blocks))
        searched = opened.reshape(n, self.n_blocks).any(axis=1)
        before, cell_before = cells(~late & searched[passage])
        bound += np.bincount(cell_before, self.block_max[before], n_cells)
        opened &= bound >= threshold - 1e-9
        every, cell = np.concatenate((after, before)), np.concatenate((cell_after, cell_before))
        left = opened[cell]
        every, cell = every[left], cell[left]
        start, size = self.block_start[every], self.block_end[every] - self.block_start[every]
        rows = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
        where = np.flatnonzero(opened)
        slot = np.repeat(np.searchsorted(where, cell), size) * BLOCK + self.place[rows] % BLOCK
        score = np.bincount(slot, self.impact[rows], len(where) * BLOCK)
        hits = np.flatnonzero(score >= threshold - 1e-9)
        owner, block = np.divmod(where[hits // BLOCK], self.n_blocks)
        return owner, block * BLOCK + hits % BLOCK, score[hits]

    def best_scores(self, words: list[str], threshold: float) -> dict[int, float]:
        """Best score of every item that a passage of the text retrieves."""
        known = np.fromiter(map(self.terms.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        n_passages = len(range(0, max(1, len(words) - PIECE), PIECE))
        best: dict[int, float] = {}
        at_once = max(1, CELLS // self.n_blocks)
        for first in range(0, n_passages, at_once):
            n = min(at_once, n_passages - first)
            part = known[first * PIECE : (first + n + 1) * PIECE]
            place = np.flatnonzero(part >= 0)
            term, passage = part[place], place // PIECE
            # A word lies in the passage that starts in its stretch of words and in the one before.
            pairs = np.concatenate((passage * len(self.terms) + term, (passage - 1) * len(self.terms) + term))
            pairs = np.unique(pairs[(pairs >= 0) & (pairs < n * len(self.terms))])
            if len(pairs):
                _, pieces, scores = self.search(pairs % len(self.terms), pairs // len(self.terms), n, threshold)
                for piece, score in zip(pieces.tolist(), scores.tolist()):
                    item = int(self.items[piece])
                    best[item] = max(score, best.get(item, 0.0))
        return best

    def matches(self, text: str | None, threshold: float, overlap: float) -> list[tuple[int, float, float, float]]:
        """(item_id, best score, question overlap, answer overlap) of the items that a text holds, one for each id."""
        words = words_of(text)
        out: dict[int, tuple] = {}
        for item, score in self.best_scores(words, threshold).items():
            overlaps = [shared(part, words) for part in self.parts[item]]
            if min(overlaps) >= overlap:
                found = (self.own[item], score, *overlaps)
                out[found[0]] = max(found, out.get(found[0], found))
        return list(out.values())


def build_indexes(items: DataFrame, max_postings: int = MAX_POSTINGS) -> list[Index]:
    """Indexes of bounded size that together hold every item."""
    for name in ("question", "answer"):
        if name not in items.columns:
            items = items.withColumn(name, F.lit(None).cast("string"))
    # Inside, an item is a row's id and texts together: rows that share an id but not the texts are items of their own.
    texts = [c for name in ("text", "question", "answer") for c in (F.col(name).isNull(), F.col(name))]
    items = items.filter("item_id IS NOT NULL").select(
        F.col("item_id").cast("long").alias("own_id"), F.xxhash64("item_id", *texts).alias("item_id"), "text", "question", "answer"
    )
    postings = stored(weigh_postings(items), "impacts")
    n_shards = -(-n_rows(postings) // max_postings)
    indexes = []
    for shard in range(n_shards):
        mine = F.pmod(F.xxhash64("item_id"), F.lit(n_shards)) == shard
        rows = postings.filter(mine).orderBy("item_id", "piece", "term").toPandas()
        if len(rows):
            texts = items.filter(mine).orderBy("item_id", "text").collect()
            parts = {r["item_id"]: halves(r["text"], r["question"], r["answer"]) for r in texts}
            indexes.append(Index(rows, parts, {r["item_id"]: r["own_id"] for r in texts}))
    return indexes


def find_contaminated(
    documents: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP
) -> DataFrame:
    """One row per document and item it holds: doc_id, mark, item_id, score, question_overlap, answer_overlap."""
    texts = documents.select(id_or_last().alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    names = ["item_id", "score", "question_overlap", "answer_overlap"]
    kind = "doc_id long, mark long, item_id long, score double, question_overlap double, answer_overlap double"

    def searched(index: Index) -> DataFrame:
        sent = documents.sparkSession.sparkContext.broadcast(index)

        def search(batches):
            for batch in batches:
                rows = [
                    (key, mark, *match)
                    for key, mark, text in zip(batch["doc_id"], batch["mark"], batch["text"])
                    for match in sent.value.matches(text, threshold, overlap)
                ]
                yield pd.DataFrame(rows, columns=["doc_id", "mark", *names])

        return texts.mapInPandas(search, kind)

    found, indexes = None, build_indexes(items)
    n_indexes = len(indexes)
    for index in indexes:
        one = searched(index).withColumn("doc_id", id_or_null("doc_id"))
        found = one if found is None else found.unionByName(one)
    if found is None:
        return documents.sparkSession.createDataFrame([], kind)
    if n_indexes == 1:
        return found
    best = F.max_by(F.struct(*names[1:]), F.struct(*names[1:])).alias("_best")  # an id may have texts in several shards
    return found.groupBy("doc_id", "mark", "item_id").agg(best).select("doc_id", "mark", "item_id", "_best.*")


def remove_contaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = find_contaminated(documents, items).select("doc_id", "mark").distinct()
    found = stored(found.toDF("_gone_id", "_gone_mark"), "contaminated")
    side = F.broadcast(found) if within(found, MAX_FOUND) else found
    same = documents["doc_id"].cast("long").eqNullSafe(F.col("_gone_id"))
    same &= F.xxhash64(documents["text"]) == F.col("_gone_mark")
    return documents.join(side, same, "left_anti")


def op4_decontaminate(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find_contaminated(documents, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("mark")
