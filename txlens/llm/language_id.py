"""Language identification: sparse multinomial logistic regression on character n-grams.

Features are hashed character n-grams of the whole lower-cased text (runs of other characters
count as one gap), weighted by log counts and inverse document frequencies and scaled to unit
length. Document frequencies come from all learning rows. Weights are learned by
follow-the-regularised-leader with an L1 and an L2 penalty: shards of a bounded sample learn in
parallel from common state, Spark averages their states, and so on for a few rounds. Part of the
sample is kept back to fit a temperature on which the probabilities are calibrated.

Bounds: the model holds ``dims`` x languages weights; ``rows_per_language`` bounds the expected
sample of each language (rows are drawn by a hash of their id); ``MAX_LANGUAGES`` is checked.

Nulls and edge cases: a text that is null or has no letter is ``und`` with score 0; rows without
a language are never learned from; with nothing to learn from every text is ``und``; texts of
any length are read in pieces; repeated rows are separate examples; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.llm.shared import held_out, id_or_last, id_or_null, stored

DIMS_BITS = 15
MAX_N = 3
PIECE = 1 << 18
ROWS_PER_LANGUAGE = 1500
MAX_LANGUAGES = 1000
SHARDS, ROUNDS, EPOCHS = 8, 3, 2
ALPHA, BETA, L1, L2 = 3.0, 0.5, 1e-3, 1e-4
TEMPERATURES = [round(1.25**i, 6) for i in range(-10, 9)]

_LETTER = np.array([chr(i).isalpha() for i in range(128)])


def ngram_counts(text: str, bits: int = DIMS_BITS) -> np.ndarray:
    """Counts of hashed 1- to MAX_N-grams."""
    counts = np.zeros(1 << bits, dtype=np.int64)
    for at in range(0, len(text), PIECE):
        piece = f" {text[at : at + PIECE + MAX_N]} ".lower()
        codes = np.frombuffer(piece.encode("utf-32-le"), dtype=np.uint32)
        codes = np.where((codes < 128) & ~_LETTER[codes & 127], 32, codes)
        gap = codes == 32
        codes = codes[~(gap & np.concatenate(([False], gap[:-1])))].astype(np.uint64)
        rolling = codes
        for n in range(1, MAX_N + 1):
            if n > 1:
                rolling = rolling[:-1] * np.uint64(0x100000001B3) + codes[n - 1 :]
            mixed = (rolling + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            counts += np.bincount((mixed >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts


def features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices and unit-length TF-IDF values."""
    counts = ngram_counts(text)
    at = np.flatnonzero(counts)
    values = (1.0 + np.log(counts[at])) * idf[at]
    norm = np.sqrt(values @ values)
    return at, values / norm if norm else values


def _softmax(scores: np.ndarray) -> np.ndarray:
    shifted = np.exp(scores - scores.max())
    return shifted / shifted.sum()


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    sparse = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= L1, 0.0, sparse)


def ftrl(texts, targets, z, n, idf, epochs: int = EPOCHS):
    """FTRL-proximal over examples in order; z and n are (languages, dims) and change in place."""
    vectors = [features(t, idf) for t in texts]
    for _ in range(epochs):
        for (at, values), target in zip(vectors, targets):
            w = _weights(z[:, at], n[:, at])
            error = _softmax(w @ values)
            error[target] -= 1.0
            gradient = np.outer(error, values)
            grown = n[:, at] + gradient**2
            z[:, at] += gradient - (np.sqrt(grown) - np.sqrt(n[:, at])) / ALPHA * w
            n[:, at] = grown
    return z, n


class LanguageModel:
    """Learned languages, inverse document frequencies, weights and temperature."""

    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float = 1.0):
        self.languages, self.idf, self.weights, self.temperature = languages, idf, weights, temperature

    def scores(self, text: str) -> np.ndarray:
        at, values = features(text, self.idf)
        return self.weights[:, at] @ values

    def predict(self, text: str) -> tuple[str, float]:
        chances = _softmax(self.scores(text) / self.temperature)
        best = int(chances.argmax())
        return self.languages[best], float(chances[best])


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """Number of texts that have each n-gram; one partial count per task."""

    def count(batches):
        total = np.zeros(1 << DIMS_BITS, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                total += ngram_counts(text) > 0
        at = np.flatnonzero(total)
        yield pd.DataFrame({"gram": at, "n": total[at]})

    summed = texts.mapInPandas(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << DIMS_BITS)
    rows = summed.toPandas()  # at most 2**DIMS_BITS rows
    out[rows["gram"].to_numpy(dtype=np.int64)] = rows["n"]
    return out


def train_language_model(
    examples: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, seed: int = 7
) -> LanguageModel | None:
    """Learn from (doc_id, text, lang); None if there is nothing to learn from."""
    usable = examples.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = usable.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return None
    sizes = {r["lang"]: r["count"] for r in counts}
    languages = sorted(sizes)
    spark = examples.sparkSession
    idf = np.log((1.0 + sum(sizes.values())) / (1.0 + document_frequencies(usable))) + 1.0
    draw = F.xxhash64("doc_id", F.lit(seed))
    share = F.element_at(
        F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, rows_per_language / sizes[k]))]), F.col("lang")
    )
    number = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(languages) for x in (k, i)]), F.col("lang"))
    sample = stored(
        usable.filter(F.pmod(draw, F.lit(1_000_000)) < share * 1_000_000).select(
            "doc_id",
            "text",
            number.alias("target"),
            F.pmod(F.shiftright(draw, 24), F.lit(SHARDS)).cast("int").alias("shard"),
            (F.pmod(F.shiftright(draw, 32), F.lit(5)) == 0).alias("kept_back"),
        ),
        "language_sample",
    )
    shape = (len(languages), 1 << DIMS_BITS)
    z, n = np.zeros(shape), np.zeros(shape)
    for _ in range(ROUNDS):
        start = spark.sparkContext.broadcast((z, n, idf))

        def learn(rows: pd.DataFrame) -> pd.DataFrame:
            z0, n0, weights = start.value
            rows = rows.sort_values(["doc_id", "text"])
            order = np.random.default_rng(seed).permutation(len(rows))
            texts, targets = rows["text"].to_numpy()[order], rows["target"].to_numpy()[order]
            z1, n1 = ftrl(texts, targets, z0.copy(), n0.copy(), weights)
            row, column = np.nonzero(n1)
            return pd.DataFrame({"row": row, "column": column, "z": z1[row, column], "n": n1[row, column]})

        learned = sample.filter(~F.col("kept_back")).groupBy("shard").applyInPandas(
            learn, "row long, column long, z double, n double"
        )
        # Shards that never saw a feature leave it at 0; the mean is over all shards.
        mean = learned.groupBy("row", "column").agg(
            (F.sum("z") / SHARDS).alias("z"), (F.sum("n") / SHARDS).alias("n")
        ).toPandas()  # at most languages x dims rows
        z, n = np.zeros(shape), np.zeros(shape)
        at = mean["row"].to_numpy(dtype=np.int64), mean["column"].to_numpy(dtype=np.int64)
        z[at], n[at] = mean["z"], mean["n"]
        start.unpersist()
    model = LanguageModel(languages, idf.astype(np.float32), _weights(z, n).astype(np.float32))
    model.temperature = calibrate(sample.filter("kept_back"), model)
    return model


def calibrate(kept_back: DataFrame, model: LanguageModel) -> float:
    """Temperature of least log loss on rows that the weights have not seen."""
    shared = kept_back.sparkSession.sparkContext.broadcast(model)

    def losses(batches):
        for batch in batches:
            out = []
            for text, target in zip(batch["text"], batch["target"]):
                scores = shared.value.scores(text)
                out.append([-np.log(max(_softmax(scores / t)[target], 1e-12)) for t in TEMPERATURES])
            yield pd.DataFrame({"loss": out})

    each = kept_back.mapInPandas(losses, "loss array<double>")
    sums = each.agg(*[F.sum(F.col("loss")[i]).alias(f"t{i}") for i in range(len(TEMPERATURES))]).first()
    if sums[0] is None:
        return 1.0
    return TEMPERATURES[int(np.argmin(list(sums)))]


def identify_languages(documents: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, lang_pred and score of every whole text."""
    rows = documents.select(id_or_last().alias("doc_id"), F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"))
    if model is None:
        out = rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
        return out.withColumn("doc_id", id_or_null("doc_id"))
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        for batch in batches:
            found = [("und", 0.0) if t is None else shared.value.predict(t) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"],
                "lang_pred": [f[0] for f in found],
                "score": [f[1] for f in found],
            })

    out = rows.mapInPandas(predict, "doc_id long, lang_pred string, score double")
    return out.withColumn("doc_id", id_or_null("doc_id"))


def op5_language_id(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train_language_model(documents.filter(~held_out(F.col("doc_id"), 4, 2)))
    return identify_languages(documents, model).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score"
    )
