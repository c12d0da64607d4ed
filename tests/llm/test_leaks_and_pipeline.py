"""Benchmark decontamination, the SQL twins and the pipeline against brute force."""

import os
import random

import numpy as np
import pytest
from compare import compare, connect
from helpers import EDGE, table
from test_duplicates import brute_lines, brute_near
from test_mixing import targets

import corpus_pipeline
from txlens.llm import decontamination, toxicity
from txlens.llm.decontamination import THRESHOLD, build_indexes, find_contaminated, words_of
from txlens.llm.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) == ""


def test_all_operators_are_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))


def items_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_pruned_search_scores_like_a_full_one(spark, monkeypatch):
    """Everything above the threshold is retrieved, with its full score."""
    rnd = random.Random(2)
    vocabulary = [f"t{i}" for i in range(60)] + [f"rare{i}" for i in range(400)]
    texts = [" ".join(rnd.choices(vocabulary, k=rnd.randrange(5, 60))) for _ in range(150)]
    (index,) = build_indexes(items_of(spark, texts))
    scores = np.zeros((len(index.terms), len(index.items)))
    for term in range(len(index.terms)):
        for at in range(index.term_start[term], index.term_start[term + 1]):
            for i in range(index.block_start[at], index.block_end[at]):
                scores[term, index.place[i]] = index.impact[i]
    assert np.allclose(scores.sum(axis=0), 1)
    queries = []
    for _ in range(300):
        words = rnd.choices(vocabulary, k=40) + rnd.choice(texts).split()
        queries.append(np.unique([index.terms[w] for w in words if w in index.terms]))
    owner = np.repeat(np.arange(300), [len(terms) for terms in queries])
    for threshold in (0.3, 0.6, 0.95):
        together = list(zip(*index.search(np.concatenate(queries), owner, 300, threshold)))
        for i, terms in enumerate(queries):
            full = scores[terms].sum(axis=0)
            alone = index.search(terms, np.zeros(len(terms), dtype=np.int64), 1, threshold)
            for found in (dict(zip(*alone[1:])), {p: s for q, p, s in together if q == i}):
                assert set(found) == set(np.flatnonzero(full >= threshold - 1e-9))
                assert all(abs(full[p] - s) < 1e-9 for p, s in found.items())


def test_leaks_are_found_and_others_left(spark, monkeypatch):
    rnd = random.Random(9)
    word = lambda: rnd.choice(["the", "of", "and", "to"]) if rnd.random() < 0.5 else f"w{rnd.randrange(3000)}"
    texts = [" ".join(word() for _ in range(rnd.randrange(8, 50))) for _ in range(40)]
    texts.append(" ".join(word() for _ in range(400)))  # longer than a piece
    rows, leaks = [], set()
    for i in range(300):
        w = [word() for _ in range(rnd.randrange(0, 400))]
        if i % 5 == 0:
            item = rnd.randrange(len(texts))
            at = rnd.randrange(len(w) + 1)
            w[at:at] = texts[item].upper().split() if i % 2 else texts[item].split()
            leaks.add((i, item))
        rows.append((i, " ".join(w)))
    docs, items = table(spark, rows, clash=True), items_of(spark, texts)
    found = find_contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == leaks
    assert all(r.score >= THRESHOLD and min(r.question_overlap, r.answer_overlap) >= 0.5 for r in found)
    # Half an item is no leak: its answer is missing.
    half = table(spark, [(1, " ".join(texts[3].split()[: len(texts[3].split()) // 2]))])
    assert find_contaminated(half, items).count() == 0
    several = build_indexes(items, max_postings=200)
    assert len(several) > 3 and sum(len(i.items) for i in several) == sum(len(i.items) for i in build_indexes(items))
    monkeypatch.setattr(decontamination, "build_indexes", lambda items: several)
    assert {(r.doc_id, r.item_id) for r in find_contaminated(docs, items).collect()} == leaks


def test_items_that_share_an_id(spark, monkeypatch):
    """Two texts under one id: a document that holds either is found, once."""
    one = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    two = "seven quick foxes jumped over nineteen lazy brown dogs today"
    items = spark.createDataFrame([(1, one), (1, two), (1, one), (2, "some other words that nobody ever wrote down here")], "item_id long, text string")
    docs = table(spark, [(1, f"x {one} y"), (2, f"{two} z"), (3, f"{one} and {two}"), (4, "none of them"), (5, None)])
    expected = [(1, 1), (2, 1), (3, 1)]
    assert sorted((r.doc_id, r.item_id) for r in find_contaminated(docs, items).collect()) == expected
    several = build_indexes(items, max_postings=5)
    assert len(several) > 1
    monkeypatch.setattr(decontamination, "build_indexes", lambda items: several)
    assert sorted((r.doc_id, r.item_id) for r in find_contaminated(docs, items).collect()) == expected


def test_question_and_answer_columns(spark):
    items = spark.createDataFrame(
        [(1, None, "what is the capital city of the land", "quorvia"), (None, "x y z", None, None), (2, None, None, None)],
        "item_id long, text string, question string, answer string",
    )
    docs = table(spark, [(1, "What is the capital city of the land? Quorvia."), (2, "what is the capital city of the land"), *EDGE[2:]])
    assert [(r.doc_id, r.item_id) for r in find_contaminated(docs, items).collect()] == [(1, 1)]
    assert find_contaminated(docs, items.limit(0)).count() == 0
    assert find_contaminated(docs.limit(0), items).count() == 0
    left = decontamination.remove_contaminated(docs, items)
    assert left.columns == docs.columns and left.count() == docs.count() - 1


def test_pipeline_against_brute_force(spark):
    """Every stage on what its predecessor kept, compared with plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").selectExpr("doc_id", "toxic AS label")
    items = [words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns, rows, kept = docs.columns, None, docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in kept.collect()}
        kept = stage(spark, kept, SF).checkpoint()
        rows = kept.collect()
        if name != "mixing":
            assert kept.columns == columns
            after = {r.doc_id: r.text for r in rows}
            assert all(r.n_chars == len(r.text) for r in rows)
        if name == "toxicity":
            scores = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, labels).collect()}
            assert after == {k: t for k, t in before.items() if scores[k] < 0.7}
        if name == "line dedup":
            assert after == dict(brute_lines(sorted(before.items())))
        if name == "near dedup":
            groups = brute_near(list(before.items()), 5)[1]
            assert after == {k: t for k, t in before.items() if groups[k] == k}
        if name == "decontamination":
            has = lambda t: any(f" {' '.join(i)} " in f" {' '.join(words_of(t))} " for i in items)
            assert after == {k: t for k, t in before.items() if not has(t)}
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    wanted = targets(sizes)
    assert {r.doc_id for r in rows} == set(after) and all(r.taken <= 2 * r.size for r in rows)
    assert all(abs(r.target - wanted[r.source]) < 1e-6 * max(1, r.target) for r in rows)
    for s, target in wanted.items():
        assert abs(sum(r.taken for r in rows if r.source == s) - target) <= 65
    again = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
    assert again == sorted(map(tuple, rows))


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).checkpoint()
    assert docs.count() == 0
