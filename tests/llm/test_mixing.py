"""Mixing: water filling and apportionment against plain Python, edge cases, hot sources."""

import random

from helpers import EDGE, table
from pyspark.sql import functions as F

from txlens.llm import mixing
from txlens.llm.mixing import mix_sources, sainte_lague


def targets(sizes, weights=(3, 1, 2), share=1.5, repeats=2):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * level > repeats * sizes[s]}
        if not full:
            out.update({s: w[s] * level for s in open_})
            break
        for s in full:
            out[s] = repeats * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def check(docs, **options):
    rows = mix_sources(docs, **options).collect()
    sizes, taken = {}, {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    wanted = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - wanted[r.source]) < 1e-6 * max(1, wanted[r.source])
    for s in sizes:
        assert abs(taken[s] - wanted[s]) <= 64 + 1, (s, taken[s], wanted[s])
    return rows


def corpus(spark, n, sources, hot=0.4, seed=1):
    rnd = random.Random(seed)
    rows = [
        (i, " ".join("w" * rnd.randrange(0, 60)), "en", "hot" if rnd.random() < hot else rnd.choice(sources))
        for i in range(n)
    ]
    return table(spark, rows)


def test_targets_quotas_and_reruns(spark):
    docs = corpus(spark, 800, ["a", "b", None, "é", "Z"])
    first = sorted(map(str, check(docs)))
    assert first == sorted(map(str, check(docs.repartition(7))))


def test_many_shards_of_a_hot_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_TOKENS", 500)
    docs = corpus(spark, 1500, ["a", "b", "c"], hot=0.8)
    usual = sorted(map(str, check(docs)))
    monkeypatch.setattr(mixing, "MAX_SOURCES", 1)
    assert sorted(map(str, check(docs))) == usual


def test_apportionment_by_highest_quotients(spark):
    rnd = random.Random(4)
    for seats in (0, 1, 7, 100, 1003):
        weights = {i: rnd.randrange(1, 1000) for i in range(12)}
        expected = dict.fromkeys(weights, 0)
        for _ in range(seats):
            best = max(weights, key=lambda i: (weights[i] / (2 * expected[i] + 1), -i))
            expected[best] += 1
        df = spark.createDataFrame([(1, i, float(w)) for i, w in weights.items()], "g int, i int, w double")
        out = sainte_lague(df, ["g"], "w", F.lit(seats), "i").collect()
        assert {r.i: r.quota for r in out} == expected


def test_edge_cases(spark):
    rows = check(table(spark, EDGE, clash=True))
    assert len(rows) == len(EDGE) and all(r.taken == 0 for r in rows if r.size == 0)
    assert mix_sources(table(spark, EDGE).limit(0)).count() == 0
    blank = mix_sources(table(spark, [(1, None, "en", None), (2, " ", "en", "a")])).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 2
