"""Substring, near-duplicate and line deduplication against brute force on small hostile tables."""

import hashlib
import random
import re

import numpy as np
import pytest
from helpers import EDGE, LONG, components, plain_set, table

from txlens.llm import line_dedup, near_dedup, substring_dedup
from txlens.llm.components import connected_components

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in BLANK.split(text or "") if w]


# ---------------------------------------------------------------- components


@pytest.mark.parametrize("shape", ["chain", "star", "random", "empty"])
def test_components(spark, shape, monkeypatch):
    rnd = random.Random(6)
    links = {
        "chain": [(i, i + 1) for i in range(200)],
        "star": [(500, i) for i in range(300)],
        "random": [(rnd.randrange(400), rnd.randrange(400)) for _ in range(250)] + [(3, 3)],
        "empty": [],
    }[shape]
    monkeypatch.setattr("txlens.llm.components.MAX_NODES", 10)
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    nodes = {n for link in links if link[0] != link[1] for n in link}
    assert {r.node: r.component for r in found} == components(nodes, links)


# ---------------------------------------------------------------- substrings


def brute_substrings(rows):
    rank = lambda k: (k is None, k)
    first = {}
    for k, t in rows:
        w = words(t)
        for i in range(len(w) - 49):
            g = tuple(w[i : i + 50])
            first[g] = min(first.get(g, rank(k)), rank(k))
    out = []
    for k, t in rows:
        w = words(t)
        gone = set()
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < rank(k):
                gone.update(range(i, i + 50))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((k, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def substring_rows(df):
    rows = substring_dedup.substring_dedup(df).collect()
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in rows)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=str)


def passages(seed, n=150, letters=30):
    """Texts pasted together from shared passages, runs, periods and fresh words."""
    rnd = random.Random(seed)
    fresh = lambda k: [f"w{rnd.randrange(letters)}" for _ in range(k)]
    shared = [fresh(rnd.randrange(45, 140)) for _ in range(12)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rnd.randrange(1, 5)):
            kind = rnd.randrange(6)
            if kind < 3:
                p = rnd.choice(shared)
                a = rnd.randrange(0, 20)
                w += p[a : len(p) - rnd.randrange(0, 20)]
            elif kind == 3:
                w += ["run"] * rnd.randrange(30, 90)
            elif kind == 4:
                w += ["ab", "cd", "ef"][: rnd.randrange(2, 4)] * rnd.randrange(15, 50)
            else:
                w += fresh(rnd.randrange(0, 60))
        rows.append((rnd.randrange(10_000) if i % 9 else i, " ".join(w)))
    return list({k: (k, t) for k, t in rows}.values())


@pytest.mark.parametrize("seed,letters", [(1, 30), (2, 3), (3, 500)])
def test_substrings_against_brute_force(spark, seed, letters):
    rows = passages(seed, letters=letters)
    assert substring_rows(table(spark, rows).repartition(6)) == brute_substrings(rows)


def test_substrings_of_hot_groups_without_broadcasts(spark, monkeypatch):
    rows = passages(4, n=60) + [(20_000 + i, "copy " + " ".join(f"c{j}" for j in range(80))) for i in range(100)]
    usual = substring_rows(table(spark, rows))
    assert usual == brute_substrings(rows)
    for name in ("MAX_SIDE", "MAX_IDS"):
        monkeypatch.setattr(substring_dedup, name, 2)
    monkeypatch.setattr(substring_dedup, "BATCH_WORDS", 100)
    assert substring_rows(table(spark, rows).repartition(5)) == usual


def test_substring_edge_cases(spark):
    assert substring_rows(table(spark, EDGE, clash=True)) == brute_substrings(EDGE)
    assert substring_rows(table(spark, EDGE).limit(0)) == []


def test_windows_own_equal_symbols():
    """A passage has the same anchors in any surroundings."""
    rng = np.random.default_rng(7)
    passage = rng.integers(0, 2**63, 300, dtype=np.uint64)
    found = []
    for _ in range(20):
        before, after = (rng.integers(0, 40, rng.integers(1, 200), dtype=np.uint64) for _ in range(2))
        text = np.concatenate(([np.uint64(0)], before, passage, after, [np.uint64(0)]))
        ends = np.zeros(len(text), dtype=bool)
        ends[[0, -1]] = True
        starts = 1 + len(before) + np.arange(len(passage) - substring_dedup.WINDOW + 1)
        found.append(substring_dedup.anchors(substring_dedup.parse(text, ends), starts, len(text))[0])
    assert all((f == found[0]).all() for f in found)
    assert len(set(found[0].tolist())) < 40


# ---------------------------------------------------------------- near duplicates


def shingles(text, size):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def brute_near(rows, size, similarity=80):
    sets = {k: shingles(t, size) for k, t in rows if k is not None}
    where = {}
    for k, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(k)
    links = set()
    for k, s in sets.items():
        for other in {o for g in s for o in where[g] if o < k}:
            shared = len(s & sets[other])
            if 100 * shared >= similarity * (len(s) + len(sets[other]) - shared):
                links.add((other, k))
    return sets, components(sets, links)


def near_rows(df, size):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df, size).collect()}


def copies(seed, n=160, edits=6):
    rnd = random.Random(seed)
    base = [[f"v{rnd.randrange(400)}" for _ in range(rnd.randrange(20, 90))] for _ in range(10)]
    rows = []
    for i in range(n):
        w = list(base[0] if i % 3 == 0 else rnd.choice(base))
        for _ in range(rnd.randrange(0, edits)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w if rnd.random() < 0.9 else w[: rnd.randrange(1, len(w))])))
    return rows


@pytest.mark.parametrize("seed,size", [(1, 2), (2, 5)])
def test_near_duplicates_against_brute_force(spark, seed, size):
    rows = copies(seed)
    sets, expected = brute_near(rows, size)
    assert near_rows(table(spark, rows), size) == {k: (len(sets[k]), c, c == k) for k, c in expected.items()}


def test_near_duplicates_in_large_nodes(spark, monkeypatch):
    """Tiny nodes and blocks: stars, deep paths and the comparison of what is left."""
    rows = copies(3, n=220, edits=8)
    sets, expected = brute_near(rows, 2)
    for name, value in (("NODE", 3), ("DEPTH", 2), ("BLOCK", 8), ("MAX_SIDE", 5)):
        monkeypatch.setattr(near_dedup, name, value)
    monkeypatch.setattr(near_dedup, "_SALTS", near_dedup._SALTS[: near_dedup.TREES * 2])
    assert near_rows(table(spark, rows).repartition(5), 2) == {k: (len(sets[k]), c, c == k) for k, c in expected.items()}


def test_near_duplicate_edge_cases(spark):
    docs = table(spark, EDGE, clash=True)
    found = near_dedup.near_duplicates(docs, 2).collect()
    assert len(found) == len(EDGE)
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    assert all(by[k].n_shingles == 0 and by[k].kept for k in (2, 3, 4))
    # A-Z count as a-z, blanks do not matter.
    assert all(r.component_id is None and r.kept for r in found if r.doc_id is None)
    assert by[8].component_id == 1 and not by[8].kept and by[6].component_id == 5 and by[1].kept
    assert near_dedup.near_duplicates(docs.limit(0), 2).count() == 0
    kept = near_dedup.keep_one_of_each(docs, 2)
    assert kept.columns == docs.columns and kept.filter("doc_id = 8 OR doc_id = 6").count() == 0
    assert near_dedup.near_duplicates(table(spark, [(1, "one"), (2, "ONE"), (3, "two")]), 2).filter("kept").count() == 2


def test_rows_that_share_an_id_are_told_apart(spark):
    one, two = "a b c d e f g h i j", "quite another text of more than five words"
    docs = table(spark, [(1, one), (2, one), (2, two), (None, one)])
    left = near_dedup.keep_one_of_each(docs).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == sorted([(1, one), (2, two), (None, one)], key=str)


def test_repeated_rows_share_their_spans(spark):
    """Hundreds of rows with one text, with and without an id, beside one that is earlier: work grows with the rows."""
    words = [f"w{i}" for i in range(501)]
    rows = [(1, " ".join(words))] + [(None, " ".join(words))] * 300 + [(7, " ".join(words[100:400]))] * 100
    found = substring_dedup.substring_dedup(table(spark, rows)).collect()
    assert sorted((r.n_words, r.n_removed) for r in found) == [(300, 300)] * 100 + [(501, 0)] + [(501, 501)] * 300


# ---------------------------------------------------------------- lines

ENDS = " \t\x0b\x0c\r"
def brute_lines(rows):
    rank = lambda k: 2**63 if k is None else k
    spots = [
        (rank(k), i, line.strip(ENDS), k, t)
        for k, t in rows
        if t is not None
        for i, line in enumerate(t.split("\n"))
        if line.strip(ENDS)
    ]
    lines = sorted({s[2] for s in spots})
    sets, where, links = [plain_set(x) for x in lines], {}, []
    for n, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(n)
    for n, s in enumerate(sets):
        for o in {o for g in s for o in where[g] if o < n}:
            shared = len(s & sets[o])
            if 100 * shared >= 80 * (len(s) + len(sets[o]) - shared):
                links.append((o, n))
    group = components(range(len(lines)), links)
    name = {x: group[n] for n, x in enumerate(lines)}
    best = {}
    for r, i, line, _, _ in spots:
        best[name[line]] = min(best.get(name[line], (r, i)), (r, i))
    out = []
    for k, t in rows:
        kept = t
        if t is not None:
            keep = [
                line
                for i, line in enumerate(t.split("\n"))
                if not line.strip(ENDS) or best[name[line.strip(ENDS)]] == (rank(k), i)
            ]
            kept = "\n".join(keep)
        out.append((k, kept))
    return sorted(out, key=str)


def line_rows(df):
    return sorted(((r.doc_id, r.text) for r in line_dedup.line_dedup(df).collect()), key=str)


def pasted(seed, n=120):
    """Lines of shared and fresh wording; edited lines stay well above the threshold."""
    rnd = random.Random(seed)
    sizes = [rnd.choice([3, 5, rnd.randrange(40, 70)]) for _ in range(30)]
    base = [" ".join(f"{rnd.choice(['an', 'er', 'to'])}{rnd.randrange(300)}" for _ in range(k)) for k in [50, *sizes]]
    rows = []
    for i in range(n):
        out = []
        for _ in range(rnd.randrange(0, 7)):
            w = rnd.choice(base[:1] if rnd.random() < 0.3 else base).split()
            if rnd.random() < 0.5 and len(w) > 8:
                w[rnd.choice([0, -1])] = f"z{rnd.randrange(10**6)}"
            out.append(rnd.choice(["", " ", "\t"]) + " ".join(w) + rnd.choice(["", "\r"]))
        rows.append((i, "\n".join(out) if rnd.random() < 0.9 else "\n\n".join(out)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_against_brute_force(spark, seed):
    rows = pasted(seed)
    assert line_rows(table(spark, rows).repartition(5)) == brute_lines(rows)


def test_lines_in_large_buckets_without_broadcasts(spark, monkeypatch):
    rows = pasted(3, n=200)
    monkeypatch.setattr(line_dedup, "BUCKET", 3)
    for name in ("MAX_SIDE", "MAX_KEYS", "MAX_REPEATS"):
        monkeypatch.setattr(line_dedup, name, 2)
    assert line_rows(table(spark, rows)) == brute_lines(rows)


def test_recall_near_the_threshold(spark):
    """Pairs of lines just above the similarity: nearly all are found, none below it."""
    rnd = random.Random(12)
    rows, expected = [], 0
    for i in range(400):
        w = [f"q{i}x{rnd.randrange(10**5)}" for _ in range(rnd.randrange(20, 60))]
        v = list(w)
        for _ in range(len(w) // 20 + 1):
            v[rnd.randrange(len(v))] = f"y{rnd.randrange(10**6)}"
        one, two = plain_set(" ".join(w)), plain_set(" ".join(v))
        if 0.75 < len(one & two) / len(one | two) < 0.88:
            rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
            expected += len(one & two) >= 0.8 * len(one | two)
    removed = sum(r.n_removed for r in line_dedup.line_dedup(table(spark, rows)).collect())
    assert expected > 50 and 0.94 * expected <= removed <= expected


def test_line_edge_cases(spark):
    rows = [r for r in EDGE if r[0] != 1] + [(1, "a b c\nd e f")]
    rows += [(9, "漢字かな混じり文の長い行です。"), (10, "漢字かな混じり文の長い行です"), (11, "\n\n x \n"), (12, LONG)]
    docs = table(spark, rows, clash=True)
    out = line_dedup.line_dedup(docs)
    assert set(docs.columns) | {"n_lines", "n_removed"} == set(out.columns)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == brute_lines(rows)
    by = {r.doc_id: r for r in out.collect()}
    assert by[2].text is None and by[2].n_lines == 0 and by[12].text == "" and by[11].n_lines == 1
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0
    twice = table(spark, [(1, "same"), (1, "same"), (2, "same")])
    assert line_rows(twice) == [(1, "same"), (1, "same"), (2, "")]
