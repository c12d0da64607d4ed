"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Each text is reduced to a few statistics of its characters, words and lines. Standardised
statistics pass through random cosine features, whose inner products approximate a Gaussian
kernel. Every task sums its part of the normal equations; Spark adds the parts row by row, and
the driver solves one system of ``FEATURES`` unknowns. Raw scores of learning rows that the
regression has not seen give the isotonic curve from raw score to chance.

Means and deviations of the statistics are taken over all documents.

Nulls and edge cases: a null text counts as empty; empty texts have statistics of 0 and get a
score like any other; labels that are null or not 0 or 1 are not learned from; a document that is
labelled twice is two examples; without labels every score is 0.5; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.llm.calibration import fit_isotonic
from txlens.llm.shared import held_out, id_or_last, id_or_null, n_rows, stored

FEATURES = 128
GAMMA = 0.03
RIDGE = 1.0
SEED = 5
PIECE = 1 << 20
STATISTICS = [
    "log_chars", "log_words", "word_length", "letters", "upper", "digits", "symbols", "punctuation", "blanks",
    "other", "distinct_words", "top_word", "repeated_word", "log_lines", "distinct_lines", "ended_lines",
    "compression", "marked_words",
]

_KINDS = {"Lu": 1, "Lt": 1, "Ll": 0, "Lm": 0, "Lo": 0, "Mn": 0, "Mc": 0, "Nd": 2, "Nl": 2, "No": 2}
_KIND_OF = {"S": 3, "P": 4, "Z": 5}
_CLASS = None


def _classes() -> np.ndarray:
    """Character class of every code below 65536, from the Unicode categories."""
    global _CLASS
    if _CLASS is None:
        kinds = [unicodedata.category(chr(i)) for i in range(65536)]
        table = np.array([_KINDS.get(k, _KIND_OF.get(k[0], 6)) for k in kinds], dtype=np.uint8)
        table[[9, 10, 11, 12, 13]] = 5
        for mark in "#$%&*@|\\/":
            table[ord(mark)] = 3
        _CLASS = table
    return _CLASS


def statistics(text: str | None) -> list[float]:
    """The STATISTICS of one whole text."""
    text = text or ""
    if not text:
        return [0.0] * len(STATISTICS)
    data, packer, packed = text.encode(), zlib.compressobj(1), 0
    for at in range(0, len(data), PIECE):
        packed += len(packer.compress(data[at : at + PIECE]))
    packed += len(packer.flush())
    kinds = np.zeros(7)
    for at in range(0, len(text), PIECE):
        codes = np.frombuffer(text[at : at + PIECE].encode("utf-32-le"), dtype=np.uint32)
        kinds += np.bincount(_classes()[np.minimum(codes, 65535)], minlength=7)
    words, lines, n = data.split(), data.split(b"\n"), len(text)
    n_words = max(1, len(words))
    counted = Counter(words)
    letters = kinds[0] + kinds[1]
    marked = sum(counted[w] for w in counted if not w[-1:].isalpha() and w[-1] < 128 and w[-1:] not in b".,;:?!")
    return [
        np.log1p(n), np.log1p(len(words)), min(50.0, (n - kinds[5]) / n_words), letters / n,
        kinds[1] / max(1.0, letters), kinds[2] / n, kinds[3] / n, kinds[4] / n, kinds[5] / n, kinds[6] / n,
        len(counted) / n_words, max(counted.values(), default=0) / n_words,
        sum(map(eq, words, words[1:])) / n_words, np.log1p(len(lines)), len(set(lines)) / len(lines),
        sum(line.rstrip().endswith((b".", b"!", b"?", b":")) for line in lines) / len(lines),
        min(2.0, packed / len(data)), marked / n_words,
    ]


def document_statistics(documents: DataFrame) -> DataFrame:
    """doc_id and its statistics as an array."""

    def measure(batches):
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "x": [statistics(t) for t in batch["text"]]})

    rows = documents.select(id_or_last().alias("doc_id"), "text")
    return rows.mapInPandas(measure, "doc_id long, x array<double>")


class Fourier:
    """Standardisation and random cosine features."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.deviation = mean, np.where(deviation > 0, deviation, 1.0)
        self.w = rng.normal(0.0, np.sqrt(2 * GAMMA), (len(mean), FEATURES))
        self.b = rng.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, x) -> np.ndarray:
        scaled = np.clip((np.vstack(x) - self.mean) / self.deviation, -8, 8)
        cosines = np.sqrt(2.0 / FEATURES) * np.cos(scaled @ self.w + self.b)
        return np.hstack([cosines, np.ones((len(cosines), 1))])


def fourier_features(measured: DataFrame) -> Fourier:
    x = F.col("x")
    wanted = [f(x[i]).alias(f"{name}{i}") for i in range(len(STATISTICS)) for name, f in (("m", F.avg), ("d", F.stddev_pop))]
    row = measured.agg(*wanted).first()
    values = np.array([0.0 if v is None else v for v in row])
    return Fourier(values[0::2], values[1::2])


def ridge(examples: DataFrame, fourier: Fourier, penalty: float = RIDGE) -> np.ndarray:
    """Coefficients from normal equations that tasks sum in parts."""

    def parts(batches):
        size = FEATURES + 1
        left, right = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            if len(batch):
                z = fourier(batch["x"])
                left += z.T @ z
                right += z.T @ batch["label"].to_numpy(dtype=float)
        if left.any():
            yield pd.DataFrame({"row": range(size), "part": list(np.column_stack([left, right]))})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"row": rows["row"].iloc[:1], "part": [np.sum(np.vstack(rows["part"]), axis=0)]})

    kind = "row long, part array<double>"
    summed = examples.mapInPandas(parts, kind).groupBy("row").applyInPandas(add, kind).collect()
    system = np.zeros((FEATURES + 1, FEATURES + 2))
    for r in summed:
        system[r["row"]] = r["part"]
    damping = penalty * np.eye(FEATURES + 1)
    damping[-1, -1] = 1e-9
    return np.linalg.solve(system[:, :-1] + damping, system[:, -1])


def train_quality(measured: DataFrame, labels: DataFrame):
    """Model from statistics and (doc_id, label); None without usable labels."""
    known = labels.filter(F.col("label").isin(0, 1)).select("doc_id", "label")
    rows = measured.join(known, "doc_id").withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(4)))
    examples = stored(rows, "quality_examples")
    if not n_rows(examples):
        return None
    fourier = fourier_features(measured)
    beta = ridge(examples.filter("fold > 0"), fourier)
    raw = scored(examples.filter("fold = 0"), fourier, beta, keep=("label",))
    curve = fit_isotonic(raw, F.col("raw"), F.col("label"), -0.5, 1.5)
    return fourier, beta, curve


def scored(rows: DataFrame, fourier: Fourier, beta: np.ndarray, curve=None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Adds raw scores, or chances if there is a curve, to (doc_id, x)."""

    def score(batches):
        for batch in batches:
            raw = fourier(batch["x"]) @ beta if len(batch) else np.zeros(0)
            out = raw if curve is None else np.interp(raw, *curve)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "raw": out, **{c: batch[c] for c in keep}})

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    extra = "".join(f", {c} {types[c]}" for c in keep)
    return rows.select("doc_id", "x", *keep).mapInPandas(score, f"doc_id long, raw double{extra}")


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and the chance (0 to 1) that a document is labelled 1."""
    measured = stored(document_statistics(documents), "quality_statistics")
    model = train_quality(measured, labels)
    if model is None or model[2] is None:
        return measured.select(id_or_null("doc_id").alias("doc_id"), F.lit(0.5).alias("score"))
    return scored(measured, *model).select(id_or_null("doc_id").alias("doc_id"), F.col("raw").alias("score"))


def op6_quality(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out(F.col("doc_id"), 5, 0))
    scores = quality_scores(documents, labels.select("doc_id", F.col("quality").alias("label")))
    return scores.select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
