"""Hard negatives, filter audit and fingerprints against brute force, and their edge cases."""

import hashlib
import random
import re
import struct
from itertools import permutations

import numpy as np
import pytest
import xxhash
from helpers import CLASHES, EDGE, LONG, table
from pyspark.sql import functions as F

from txlens.llm import filter_audit, fingerprints, hard_negatives
from txlens.llm.hard_negatives import Packed, mine_hard_negatives

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# ---------------------------------------------------------------- hard negatives


@pytest.mark.parametrize("size", [1, 300, 10**5, 10**12, 2**62])
def test_packed_products_are_exact(size):
    rnd = np.random.default_rng(size % 1000)
    for n, d in ((1, 1), (7, 3), (200, 16), (5, 0)):
        rows = rnd.integers(-size, size, (n, d), endpoint=True)
        anchors = rnd.integers(-size, size, (4, d), endpoint=True)
        packed = Packed(rows, max((sum(abs(int(v)) for v in a) for a in anchors), default=0))
        for a in anchors:
            full = [sum(int(x) * int(y) for x, y in zip(r, a)) for r in rows]
            assert packed.scores(a).tolist() == [min(max(s, -(2**63)), 2**63 - 1) for s in full]


def brute_negatives(rows, anchor):
    """rows: (vec_id, embedding, label)."""
    last = lambda i: 2**63 - 1 if i is None else i
    use = [
        (n, last(i), [int(np.floor(256 * x)) for x in v], y)
        for n, (i, v, y) in enumerate(rows)
        if v is not None and y is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for n, i, v, y in use:
        if i == 2**63 - 1 or not anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, m, z) for m, j, w, z in use if m != n]
        for p, j, _, _ in sorted(s for s in scored if s[3] == y)[:5]:
            fits = sorted((s, k) for s, k, _, z in scored if z != y and -30 * p <= -100 * s <= -90 * p)
            out += [(i, j, r + 1, k, -p, -s) for r, (s, k) in enumerate(fits[:10])]
    return sorted(out)


EMBEDDINGS = "vec_id long, embedding array<float>, label int"


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, EMBEDDINGS).withColumns({c: F.lit("x") for c in CLASHES if c not in ("label",)})
    df = df.withColumns({c: F.lit(1) for c in ("n", "x", "a", "c", "rank")})
    found = mine_hard_negatives(df.repartition(3), F.col("vec_id") % 4 == 0, **options).collect()
    return sorted(tuple(2**63 - 1 if v is None and i in (1, 3) else v for i, v in enumerate(r)) for r in found)


def test_negatives_against_brute_force(spark, monkeypatch):
    rnd = random.Random(4)
    grid = lambda: [rnd.randrange(-3, 6) / 4 for _ in range(4)]  # noqa: E731  many ties
    rows = [(i, grid(), rnd.randrange(3) if i % 3 else 0) for i in range(120)]
    rows += [(None, grid(), 1), (8, rows[8][1], rows[8][2]), (8, rows[8][1], 2), (200, None, 1), (204, grid(), None)]
    rows += [(208, [float("nan"), 1.0, 1.0, 1.0], 1), (212, [None, 1.0, 1.0, 1.0], 1), (216, [float("inf"), 0.0, 0.0, 0.0], 1)]
    rows += [(220, [], 1), (224, [1.0, 1.0], 2), (228, [1.0] * 6, 9)]
    expected = brute_negatives(rows, lambda i: i % 4 == 0)
    assert len(expected) > 500 and mined(spark, rows) == expected
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    monkeypatch.setattr(hard_negatives, "CANDIDATES", 20)
    assert mined(spark, rows) == expected


def test_negatives_of_empty_and_lonely_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(4, [1.0], 1)]) == [] and mined(spark, [(4, [1.0], 1), (5, [1.0], 1)]) == []
    assert mined(spark, [(1, [1.0], 1), (3, [0.5], 2)]) == []
    # Beyond the range of a long, scores count as its ends.
    huge = [(4, [3e38], 1), (5, [3e38], 1), (6, [1.0], 2)]
    assert [r[:2] for r in mined(spark, huge, high=100)] == [(4, 5)]


# ---------------------------------------------------------------- filter audit


def plain_counts(text):
    words = WORD.findall(text)
    return (
        len(words),
        len(set(words)),
        len(text),
        sum("A" <= c <= "Z" for c in text),
        sum(c in "#$%&*|" for c in text),
    )


def texts_of(seed, n=150):
    rnd = random.Random(seed)
    words = ["a", "B", "ü", "漢字", "x" * 9, "y" * 8, "y" * 8 + "z", "w" * 300, "w" * 299 + "v", "#", "A&B", "😀", "\x00", "\x1f"]
    out = ["", " ", "\n\t", "a", "😀"]
    for _ in range(n):
        parts = [rnd.choice(words) + rnd.choice(["", "", "1", "é"]) + rnd.choice(" \t\n\x0b\x0c\r ") * rnd.randrange(1, 3) for _ in range(rnd.randrange(0, 60))]
        out.append(rnd.choice(["", " "]) + "".join(parts) + rnd.choice(["", "end"]))
    return out


@pytest.mark.parametrize("piece, spans", [(1 << 20, 1 << 18), (7, 5), (64, 40)])
def test_transducer_counts_like_plain_python(monkeypatch, piece, spans):
    monkeypatch.setattr(filter_audit, "PIECE", piece)
    monkeypatch.setattr(filter_audit, "SPANS", spans)
    texts = [*texts_of(piece), *["" for _ in range(5)], " ".join(f"w{i % 700}" for i in range(3000))]
    data = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    counts = filter_audit.counted(np.frombuffer(b"".join(data), np.uint8), bounds)
    assert list(zip(*(counts[n].tolist() for n in filter_audit.COUNTS))) == [plain_counts(t) for t in texts]


def test_words_of_one_hash_stay_apart(monkeypatch):
    """The table is verified: with a single hash for all words it still tells them apart."""
    monkeypatch.setattr(filter_audit.Words, "hashes", lambda self, at: np.zeros(len(at), np.uint64))
    texts = ["a b a ab ba ab", "a b", "", "x" * 20 + "a " + "x" * 20 + "b " + "x" * 20 + "a"]
    data = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    found = filter_audit.counted(np.frombuffer(b"".join(data), np.uint8), bounds)["n_distinct"]
    assert found.tolist() == [4, 2, 0, 2]


def brute_audit(rows, labels):
    """rows: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    rank = lambda k: 2**63 - 1 if k is None else k
    first = {}
    for k, t, _ in rows:
        first[t or ""] = min(first.get(t or "", 2**63), rank(k))
    docs = {}
    for k, t, lang in rows:
        t = t or ""
        n, d, points, capitals, symbols = plain_counts(t)
        tests = [n < 100, 100 * d < 80 * n, 100 * capitals > 10 * points, symbols > 0, rank(k) > first[t]]
        fails = {c for c, bad in zip("ABCDE", tests) if bad}
        good, toxic = (any(i == k and x[at] == 1 for i, *x in labels) for at in (0, 1))
        docs.setdefault(lang or "", []).append((fails, good, toxic))
    out = []
    for part, members in docs.items():
        removed = {c: 0 for c in "ABCDE"}
        rows = []
        for order in map("".join, permutations("ABCDE")):
            left = members
            for step, c in enumerate(order, 1):
                gone = [m for m in left if c in m[0]]
                left = [m for m in left if c not in m[0]]
                removed[c] += len(gone)
                fail = [m for m in members if c in m[0]]
                only = sum(m[0] == {c} for m in members)
                lost = [sum(m[i] for m in gone) for i in (1, 2)]
                rows.append((part, order, step, len(left), len(gone), len(fail) - len(gone), only, *lost, c))
        out += [(*r[:-1], removed[r[-1]]) for r in rows]
    return sorted(out)


def test_audit_against_brute_force(spark, monkeypatch):
    rnd = random.Random(8)
    plain = [" ".join(f"{rnd.choice(['w', 'W', 'wü'])}{rnd.randrange(n)}" for _ in range(n)) for n in (20, 120, 400, 130)]
    texts = texts_of(3, 60) + plain * 3 + [LONG, LONG, None, "Same"] + ["Same"] * 20
    rows = [(i if rnd.random() < 0.9 else rnd.choice([None, 3]), t, rnd.choice(["en", "de", "", None])) for i, t in enumerate(texts)]
    labels = [(rnd.choice([None, *range(len(rows))]), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for _ in range(60)]
    docs = table(spark, [(k, t, x) for k, t, x in rows], clash=True).withColumns({c: F.lit("x") for c in ("part", "fails", "digest", "good", "toxic", "quality")})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("id", F.lit("x"))

    def found():
        fails = filter_audit.failures(docs.repartition(5))
        out = filter_audit.interaction_audit(filter_audit.labelled(fails, marks), "ABCDE")
        return sorted(map(tuple, out.collect()))

    expected = brute_audit(rows, labels)
    assert found() == expected
    for name in ("MAX_GROUPS", "MAX_LABELS"):
        monkeypatch.setattr(filter_audit, name, 2)
    assert found() == expected


def test_audit_of_an_empty_table(spark):
    docs = table(spark, []).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    fails = filter_audit.labelled(filter_audit.failures(docs), labels)
    assert filter_audit.interaction_audit(fails, "ABCDE").count() == 0
    few = filter_audit.failures(table(spark, EDGE), filters={"A": "n_words < 3"}, repeats=None)
    assert sorted(r.fails for r in few.collect()) == [""] * 7 + ["A"] * 4


# ---------------------------------------------------------------- fingerprints


def h64(numbers):
    seed = 42
    for n in numbers:
        seed = xxhash.xxh64_intdigest(struct.pack("<Q", n & (2**64 - 1)), seed=seed)
    return seed - 2**64 if seed >= 2**63 else seed


def plain_shingles(text):
    words = [xxhash.xxh64_intdigest(w, seed=42) for w in WORD.findall(text or "")]
    if len(words) < 5:
        return {h64(words)} if words else set()
    return {h64(words[i : i + 5]) for i in range(len(words) - 4)}


def plain_sketch(text):
    return sorted(plain_shingles(text))[:128]


def likeness(a, b):
    both = sorted({*a, *b})[:128]
    return len({*both} & {*a} & {*b}) / len(both) if both else 1.0


def brute_fingerprints(rows):
    rank = lambda k: 2**63 - 1 if k is None else k
    signed = lambda t: (lambda n: n - 2**64 if n >= 2**63 else n)(xxhash.xxh64_intdigest(t, seed=42))
    docs = sorted({(rank(k), t or "") for k, t in rows}, key=lambda r: (-r[0], signed(r[1])))
    after = {d: docs[(n + 1) % len(docs)][1] for n, d in enumerate(docs)}
    out = []
    for k, t in rows:
        t = t or ""
        other, half = after[(rank(k), t)], len(t) // 2
        edited = t[: len(t) - half] + other[:half]
        one, two, three = map(plain_sketch, (t, edited, other))
        text = lambda s: "".join(f"{h & (2**64 - 1):016X}" for h in s)
        out.append((k, len(t), hashlib.sha256(edited.encode()).hexdigest(), text(one), text(two), likeness(one, two), likeness(one, three)))
    return sorted(out, key=str)


def fingerprint_rows(docs, spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "read_table", lambda *_: docs)
    return sorted((tuple(r)[:7] for r in fingerprints.op13_fingerprints(spark, "").collect()), key=str)


@pytest.mark.parametrize("clash", [False, True])
def test_fingerprints_against_brute_force(spark, monkeypatch, clash):
    rnd = random.Random(6)
    rows = [(i, " ".join(f"w{rnd.randrange(60)}ü" for _ in range(rnd.randrange(0, 300)))) for i in rnd.sample(range(-500, 500), 90)]
    rows += [(2**62, "😀 a b c d e f g h"), (-(2**63), "least id of all"), *texts_pairs()]
    if clash:  # repeated rows, several texts of an id, null ids
        rows += [*EDGE, *EDGE, *[(None, f"no id {i}") for i in range(20)], *[(7, "hot row") for _ in range(50)]]
    docs = table(spark, rows, clash=clash).repartition(6)
    assert fingerprint_rows(docs, spark, monkeypatch) == brute_fingerprints(rows)


def texts_pairs():
    return [(1000 + i, t) for i, t in enumerate(texts_of(5, 20))]


def test_fingerprints_of_small_tables(spark, monkeypatch):
    assert fingerprint_rows(table(spark, []).limit(0), spark, monkeypatch) == []
    for rows in ([(1, "alone in the table it is")], [(None, None)], [(1, ""), (2, "a b")]):
        assert fingerprint_rows(table(spark, rows), spark, monkeypatch) == brute_fingerprints(rows)


def test_sketches_estimate_and_merge(spark):
    rnd = random.Random(2)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(4000)]
    one, two = " ".join(words[:3000]), " ".join(words[1000:])
    small, inside = " ".join(words[:40]), " ".join(words[:20])
    df = spark.createDataFrame([(one, two, small, inside)], "a string, b string, c string, d string")
    df = fingerprints.with_sketches(df, {"sa": "a", "sb": "b", "sc": "c", "sd": "d"})
    r = df.select(
        fingerprints.resemblance("sa", "sb"), fingerprints.containment("sa", "sb"), fingerprints.distinct_shingles("sa"),
        fingerprints.containment("sd", "sc"), fingerprints.containment("sc", "sd"), fingerprints.distinct_shingles("sc"),
        fingerprints.merged("sa", "sb"),
    ).collect()[0]
    assert abs(r[0] - 0.5) < 0.15 and abs(r[1] - 2 / 3) < 0.15 and abs(r[2] / 2996 - 1) < 0.3
    assert (r[3], r[4], r[5]) == (1.0, 16 / 36, 36.0)
    assert r[6] == sorted(plain_shingles(one) | plain_shingles(two))[:128]
    # Parts of a text, in any number of rows, merge into the sketch of all their shingles.
    parts = [(k, " ".join(words[i : i + 30])) for k in ("x", None) for i in range(0, 3000, 10)] + [("y", "")]
    df = fingerprints.with_sketches(spark.createDataFrame(parts, "k string, t string"), {"sketch": "t"})
    got = {r.k: r.sketch for r in fingerprints.merge_parts(df.repartition(7), ["k"]).collect()}
    whole = sorted(set().union(*(plain_shingles(t) for k, t in parts if k == "x")))[:128]
    assert got == {"x": whole, None: whole, "y": []}
