"""Toxicity by compression distance to two zstandard dictionaries.

Training. From a bounded sample of labelled texts, the toxic dictionary collects excerpts that
tell toxic texts from ordinary ones: words by log-likelihood ratio of document frequencies, each
pick halving the weight of the texts it explains, so that words which copies of one text
happen to share fade out. The ordinary dictionary is trained on windows of ordinary texts. Both
compressors share the ordinary part; one has the excerpts behind it, the other meaningless filler
of the same length, so that distances into the ordinary part cost the same.

Scoring. Every word of the whole text is one window, in lower case, between marks, in two-byte
characters (every letter costs alike); words longer than ``LONG`` are cut into overlapping pieces.
A window counts if the toxic compressor needs no more bytes than it needs for the longest
of its own excerpts (one reference, no letters in between) and fewer than the ordinary one. Windows that share no
``GRAM`` characters in a row with an excerpt cannot gain that much and are not compressed. A
text's raw score is the sum of its windows' gains; an isotonic curve over learning rows that no
dictionary has seen turns it into a chance.

Nulls and edge cases: null and empty texts have raw score 0 and get its chance; labels that are null or
not 0 or 1 are not learned from; without toxic examples every score is 0; repeated rows are
separate examples; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.llm.calibration import fit_isotonic
from txlens.llm.shared import held_out, id_or_last, id_or_null, stored, within

SAMPLE_TOXIC, SAMPLE_ORDINARY = 2000, 4000  # expected rows, drawn by a hash of the id
MAX_EXCERPTS, MIN_RATIO, MIN_TEXTS = 500, 20.0, 4
DICTIONARY_BYTES, DICTIONARY_WINDOWS = 16384, 60_000
LONG, GRAM, MIN_GAIN = 64, 4, 1
MAX_RAW = 64
THRESHOLD = 0.7
MAX_REJECTED = 200_000  # broadcast bound of ids
MEMO = 200_000
SEED = 11
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BLANK = re.compile(r"[\x20\x09-\x0D]")
_EDGES = ".,;:!?&$%#*|\"'()[]"


def _coded(word: str) -> bytes:
    """One window: marks long enough to be matched show a compressor where the word begins and ends."""
    return f"\1\2\3{word}\4\5\6".encode("utf-16-le", "surrogatepass")


def _ratio(a: float, n: float, b: float, m: float) -> float:
    """Log-likelihood ratio of a in n against b in m; 0 unless the first share is larger."""
    if not n or not m or a / n <= b / m:
        return 0.0

    def fit(k: float, total: float, p: float) -> float:
        return (k * math.log(p) if k else 0.0) + ((total - k) * math.log(1 - p) if total > k and p < 1 else 0.0)

    p = (a + b) / (n + m)
    return 2 * (fit(a, n, a / n) + fit(b, m, b / m) - fit(a, n, p) - fit(b, m, p))


def excerpts(toxic: list[set[str]], ordinary: list[set[str]]) -> list[str]:
    """Words that tell toxic texts apart, most telling first."""
    usual = Counter(w for d in ordinary for w in d)
    first = Counter(w for d in toxic for w in d)
    n, m = len(toxic), len(ordinary)
    open_words = {w for w, c in first.items() if c >= MIN_TEXTS and _ratio(c, n, usual[w], m) >= MIN_RATIO}
    texts, weights, chosen = [d & open_words for d in toxic], [1.0] * n, []
    while len(chosen) < MAX_EXCERPTS:
        counted: dict[str, float] = defaultdict(float)
        for words, weight in zip(texts, weights):
            for w in words:
                counted[w] += weight
        total = sum(weights)
        rated = [(_ratio(c, total, usual[w], m), w) for w, c in counted.items() if c >= MIN_TEXTS and w not in chosen]
        best = max(rated, default=(0.0, ""))
        if best[0] < MIN_RATIO:
            break
        chosen.append(best[1])
        weights = [x / 2 if best[1] in d else x for x, d in zip(weights, texts)]
    return chosen


def ordinary_dictionary(texts: list[str]) -> bytes:
    """Trained dictionary of word windows; plain windows if there are too few to train on."""
    words = [w for t in texts for w in _WORD.findall(t.lower())]
    order = np.random.default_rng(SEED).permutation(len(words))[:DICTIONARY_WINDOWS]
    windows = [_coded(words[i]) for i in order]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, windows, k=200, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(windows)[:DICTIONARY_BYTES]


class Distances:
    """Gains of windows from knowing the toxic excerpts; picklable, compressors made on use."""

    def __init__(self, chosen: list[str], ordinary: bytes):
        self.chosen, self.ordinary = chosen, ordinary
        self._ready = None

    def __getstate__(self):
        return {"chosen": self.chosen, "ordinary": self.ordinary, "_ready": None}

    def _compressors(self):
        if self._ready is None:
            toxic = b"".join(_coded(w) for w in self.chosen)
            private = np.random.default_rng(SEED).integers(0xE000, 0xF8FF, len(toxic) // 2)
            settings = zstandard.ZstdCompressionParameters(
                window_log=18, hash_log=16, chain_log=17, search_log=7, target_length=32, min_match=5,
                strategy=zstandard.STRATEGY_BTOPT, write_checksum=False, write_content_size=False, write_dict_id=False,
            )

            def compressor(ending: bytes):
                content = zstandard.ZstdCompressionDict(self.ordinary + ending, zstandard.DICT_TYPE_RAWCONTENT)
                content.precompute_compress(compression_params=settings)
                return zstandard.ZstdCompressor(dict_data=content, compression_params=settings)

            plain, knowing = compressor(private.astype("<u2").tobytes()), compressor(toxic)
            grams = np.zeros(1 << 20, dtype=bool)
            for w in self.chosen:
                grams[self._grams(np.frombuffer(f" {w} ".encode("utf-16-le"), dtype="<u2"))] = True
            longest = max(len(knowing.compress(_coded(w))) for w in self.chosen)
            self._ready = plain, knowing, grams, longest, {}
        return self._ready

    @staticmethod
    def _grams(codes: np.ndarray) -> np.ndarray:
        rolling = codes[: max(0, len(codes) - GRAM + 1)].astype(np.uint32)
        for i in range(1, GRAM):
            rolling = rolling * np.uint32(0x9E3779B1) + codes[i : len(codes) - GRAM + 1 + i]
        return (rolling * np.uint32(0x85EBCA6B)) >> np.uint32(12)

    def gain(self, word: str) -> int:
        """Bytes that the excerpts save in one window, 0 if too few."""
        plain, knowing, _, longest, memo = self._compressors()
        if word not in memo:
            if len(memo) > MEMO:
                memo.clear()
            coded = _coded(word)
            size = len(knowing.compress(coded))
            saved = len(plain.compress(coded)) - size if size <= longest else 0
            memo[word] = saved if saved >= MIN_GAIN else 0
        return memo[word]

    def raw_score(self, text: str | None) -> int:
        if not text or not self.chosen:
            return 0
        grams, total = self._compressors()[2], 0
        for start in range(0, len(text), 1 << 18):
            # Pieces overlap by one long window, so that no word is cut in both.
            piece = _BLANK.sub(" ", f" {text[max(0, start - LONG) : start + (1 << 18)]} ".lower())
            codes = np.frombuffer(piece.encode("utf-16-le", "replace"), dtype="<u2")
            hits = np.flatnonzero(grams[self._grams(codes)])
            if not len(hits):
                continue
            gaps = np.flatnonzero(codes == 32)
            # A gram that starts on a blank belongs to the word behind it.
            for i in np.unique(np.searchsorted(gaps, hits, side="right")):
                if i == 0 or i >= len(gaps):
                    continue
                coded = codes[gaps[i - 1] + 1 : gaps[i]]
                word = coded.tobytes().decode("utf-16-le", "replace")
                for at in range(0, max(1, len(word) - LONG // 2), LONG // 2):
                    part = word if len(word) <= LONG else word[at : at + LONG]
                    total += max(self.gain(part), self.gain(part.strip(_EDGES)))
                    if len(word) <= LONG:
                        break
        return min(total, MAX_RAW)


def train_distances(texts: DataFrame, known: DataFrame) -> Distances | None:
    """Dictionaries from texts (doc_id, text) and labels (doc_id, label); None without toxic examples."""
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return None
    share = F.when(F.col("label") == 1, SAMPLE_TOXIC / sizes[1]).otherwise(SAMPLE_ORDINARY / sizes[0])
    drawn = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000)) < share * 1_000_000)
    drawn = stored(drawn, "toxicity_sample")
    # The labels are drawn first: their few ids go to the texts, not all labelled texts to the labels.
    side = F.broadcast(drawn) if within(drawn, MAX_REJECTED) else drawn
    sample = texts.filter("text IS NOT NULL").join(side, "doc_id")

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "text"])
        toxic, ordinary = rows["text"][rows["label"] == 1], rows["text"][rows["label"] == 0]

        def words(text: str) -> set[str]:
            return {w.strip(_EDGES) for w in _WORD.findall(text.lower())} - {""}

        chosen = excerpts([words(t) for t in toxic], [words(t) for t in ordinary])
        short = [w for w in chosen if 2 < len(w) <= LONG]
        return pd.DataFrame({"chosen": [short], "ordinary": [ordinary_dictionary(list(ordinary))]})

    # One task reads the sample, whose expected size is fixed above.
    rows = sample.select(F.lit(0).alias("all"), "doc_id", "text", "label").groupBy("all")
    learned = rows.applyInPandas(learn, "chosen array<string>, ordinary binary").first()
    return Distances(list(learned["chosen"]), bytes(learned["ordinary"])) if learned else None


def raw_scores(documents: DataFrame, distances: Distances) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(distances)

    def score(batches):
        for batch in batches:
            found = [shared.value.raw_score(t) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "mark": batch["mark"], "raw": np.array(found, dtype=float),
            })

    rows = documents.select(id_or_last().alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    scored = rows.mapInPandas(score, "doc_id long, mark long, raw double")
    return scored.withColumn("doc_id", id_or_null("doc_id"))


def toxicity_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, mark (hash of the text) and the chance (0 to 1) that it is labelled toxic.

    ``labels`` has doc_id and label.
    """
    known = labels.filter(F.col("label").isin(0, 1)).select("doc_id", "label")
    fold = F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(3))
    texts = documents.select("doc_id", "text")
    distances = train_distances(texts, known.filter(fold > 0))
    if distances is None or not distances.chosen:
        return texts.select("doc_id", F.xxhash64("text").alias("mark"), F.lit(0.0).alias("score"))
    raw = stored(raw_scores(texts, distances), "toxicity_raw")
    kept_back = raw.join(known.filter(fold == 0), "doc_id")
    curve = fit_isotonic(kept_back, F.col("raw"), F.col("label"), 0.0, float(MAX_RAW), MAX_RAW)
    if curve is None:
        return raw.select("doc_id", "mark", F.lit(0.0).alias("score"))
    steps = np.interp(np.arange(MAX_RAW + 1) + 0.5, *curve)
    score = F.element_at(F.lit([float(s) for s in steps]), F.col("raw").cast("int") + 1)
    return raw.select("doc_id", "mark", score.alias("score"))


def remove_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents whose toxicity stays below the threshold."""
    rejected = toxicity_scores(documents, labels).filter(F.col("score") >= threshold).select("doc_id", "mark")
    rejected = stored(rejected.distinct().toDF("_gone_id", "_gone_mark"), "toxic")
    side = F.broadcast(rejected) if within(rejected, MAX_REJECTED) else rejected
    same = documents["doc_id"].cast("long").eqNullSafe(F.col("_gone_id"))
    same &= F.xxhash64(documents["text"]) == F.col("_gone_mark")
    return documents.join(side, same, "left_anti")


def op7_toxicity(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out(F.col("doc_id"), 3, 1))
    scores = toxicity_scores(documents, labels.select("doc_id", F.col("toxic").alias("label")))
    return scores.select(
        "doc_id",
        held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
