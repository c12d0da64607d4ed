"""Line deduplication of long words and of families of templated lines."""

import random

import xxhash
from pyspark.sql import functions as F
from helpers import components, plain_set, table

from txlens.llm import line_dedup

def plain_repeats(lines):
    """Places of the lines (all different) that are like an earlier one, by comparing all pairs."""
    sets = [plain_set(x) for x in lines]
    links = [
        (i, j)
        for j in range(len(lines))
        for i in range(j)
        if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    return {n for n, c in components(range(len(lines)), links).items() if n != c}


def plain_bands(line):
    """The bands of a line with their four minwise hashes."""
    hashes = [xxhash.xxh64_intdigest(x, seed=42) for x in plain_set(line)]
    hashes = [h - 2**64 if h >= 2**63 else h for h in hashes]
    signature = [min(h ^ salt for h in hashes) >> 32 for salt in line_dedup.SALTS]
    return {(n, *(signature[i] for i in at)) for n, at in enumerate(line_dedup.BANDS)}


def repeats(spark, lines):
    rows = line_dedup.line_dedup(table(spark, list(enumerate(lines)))).filter("n_removed > 0").collect()
    return {r.doc_id for r in rows}


def test_tails_of_long_words_count(spark):
    lines = [
        "https://example.org/report/2021",
        "https://example.org/about",
        "order-number:4417000123",
        "order-number:9920555871",
        "someone.long@example.org",
        "someone.long@another.net",
        "ภาษาไทยเขียนติดกันไม่มีช่องว่าง",
        "ภาษาไทยเขียนคนละเรื่องกันเลยนะครับ",
        "0123456789abcdef0123456789abcdef0123456789abcdef0123456789abcdef",
        "0123456789abcdef0123456789abcdef0123456789abcdef0123456789abcdeX",
    ]
    assert repeats(spark, lines) == plain_repeats(lines) == {9}


def test_pairs_inside_a_family_of_templated_lines(spark):
    """Twins above the similarity among 300 lines that are all just below it."""
    rnd = random.Random(5)
    fresh = lambda k: [f"{rnd.randrange(10**8):08d}" for _ in range(k)]
    common, lines = fresh(40), []
    for _ in range(150):
        own = fresh(1)
        lines += [" ".join(common + own + fresh(5)) for _ in range(2)]
    assert plain_repeats(lines) == set(range(1, 300, 2))
    seen = [plain_bands(x) for x in lines]
    expected = {i + 1 for i in range(0, 300, 2) if seen[i] & seen[i + 1]}
    assert len(expected) > 100 and repeats(spark, lines) == expected


def test_recall_of_edits_anywhere(spark):
    rnd = random.Random(1)
    base = [" ".join(f"{rnd.choice(['an', 'er', 'to'])}{rnd.randrange(300)}" for _ in range(rnd.randrange(3, 40))) for _ in range(30)]
    rows = []
    for i in range(120):
        out = []
        for _ in range(rnd.randrange(0, 7)):
            w = rnd.choice(base[:1] if rnd.random() < 0.3 else base).split()
            if rnd.random() < 0.5 and len(w) > 8:
                w[rnd.randrange(len(w))] = f"z{rnd.randrange(10**6)}"
            out.append(" ".join(w))
        rows.append((i, "\n".join(out)))
    lines = [x for _, t in rows for x in t.split("\n") if x]
    different = sorted(set(lines))
    expected = len(lines) - len(different) + len(plain_repeats(different))
    found = sum(r.n_removed for r in line_dedup.line_dedup(table(spark, rows)).collect())
    assert 0.97 * expected <= found <= expected


def test_links_of_two_blocks_connect_what_is_alike_and_no_more(spark):
    """As many links as components that meet, though all pairs of a block may be alike."""
    rnd = random.Random(8)
    pool = [[rnd.getrandbits(60) for _ in range(12)] for _ in range(6)]
    entry = "array<struct<key: bigint, component: bigint, set: array<bigint>>>"
    rows = []
    for n in (1, 5, 40):
        for kinds in (1, 6):
            lines = [(k, rnd.choice([k, k, k % 3]), [*pool[rnd.randrange(kinds)], rnd.getrandbits(60)]) for k in range(2 * n)]
            rows.append((lines[:n], lines))
    df = spark.createDataFrame(rows, f"outsiders {entry}, lines {entry}")
    found = df.select("outsiders", "lines", line_dedup.spanning_links("outsiders", "lines", 80).alias("links")).collect()
    for row in found:
        known = [(f"c{y.component}", y.key) for y in row.lines]
        nodes = [y.key for y in row.lines] + [name for name, _ in known]
        alike = [
            (x.key, y.key)
            for x in row.outsiders
            for y in row.lines
            if 100 * len(set(x.set) & set(y.set)) >= 80 * len(set(x.set) | set(y.set))
        ]
        links = [(k.a, k.b) for k in row.links]
        order = {node: i for i, node in enumerate(dict.fromkeys(nodes))}
        groups = lambda some: components(range(len(order)), [(order[a], order[b]) for a, b in known + some])  # noqa: E731,B023
        assert groups(links) == groups(alike)
        assert len(links) < len(row.lines) and all(a < b for a, b in links)


def test_bits_of_the_sets_change_no_link(spark):
    """Lines of all likenesses around the similarity, short and longer than the bits."""
    rnd = random.Random(9)
    rows = []
    for size in (1, 5, 60, 2000):
        common = [rnd.getrandbits(64) - 2**63 for _ in range(size)]
        own = [rnd.randrange(size // 3 + 2) for _ in range(24)]
        rows.append([(k, k, common[n:] + [rnd.getrandbits(64) - 2**63 for _ in range(n)]) for k, n in enumerate(own)])
    entry = "key bigint, component bigint, set array<bigint>"
    for lines in rows:
        sets = line_dedup.with_bits(spark.createDataFrame(lines, entry))
        bits = [F.struct("key", "component", "set", *names) for names in ([], line_dedup.bit_names(line_dedup.MAPS))]
        blocks = sets.agg(*[F.sort_array(F.collect_list(x)).alias(name) for x, name in zip(bits, ("plain", "marked"))])
        plain, marked = blocks.select(
            line_dedup.spanning_links("plain", "plain", 80), line_dedup.spanning_links("marked", "marked", 80, line_dedup.MAPS)
        ).first()
        assert plain == marked
        for row in sets.collect():
            places = {(h >> 6 & line_dedup.MAPS - 1, h & 63) for h in row.set}
            assert places == {(i, b) for i, name in enumerate(line_dedup.bit_names(line_dedup.MAPS)) for b in range(64) if row[name] >> b & 1}


def test_a_text_is_split_once_and_sets_are_built_once(spark, monkeypatch):
    plan = line_dedup.lines_of(table(spark, [(1, "a b")]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
    built, build = [], line_dedup.line_sets
    monkeypatch.setattr(line_dedup, "line_sets", lambda *given: built.append(1) or build(*given))
    monkeypatch.setattr(line_dedup, "BUCKET", 3)
    rnd = random.Random(6)
    common = " ".join(f"{rnd.randrange(10**8):08d}" for _ in range(40))
    lines = [f"{common} " + " ".join(f"{rnd.randrange(10**8):08d}" for _ in range(6)) for _ in range(40)]
    lines += [x[:-2] + "zz" for x in lines]
    assert repeats(spark, lines) == plain_repeats(lines) and len(built) == 1


def test_shingles_start_where_they_should(spark):
    """Random lines of letters, blanks, control characters, unspaced scripts, marks and characters beyond 16 bits."""
    draw = random.Random(5)
    lines = ["".join(draw.choices("abcdeZ. \t\x01é中한！😀", [9, 9, 9, 9, 9, 2, 2, 6, 1, 1, 2, 1, 1, 1, 1], k=n)).strip(" \t")
             for n in range(1, 60) for _ in range(30)]
    lines = sorted({x for x in lines if x})
    rows = spark.createDataFrame([(x,) for x in lines], "line string").select(
        "line", line_dedup.shingles(F.col("line")).alias("shingles")
    )
    for r in rows.collect():
        assert set(r.shingles) == plain_set(r.line), r.line


def test_runs_of_shingles_change_no_band(spark, monkeypatch):
    """Lines of one shingle and of numbers of shingles around those of whole runs, one of them in several documents."""
    rnd = random.Random(11)
    lines = [" ".join(rnd.choice("abc") * rnd.randrange(1, 6) + str(rnd.randrange(99)) for _ in range(n)) for n in range(1, 36)]
    lines += ["x", "中文字符没有空格", "0123456789abcdef" * 3]
    docs = table(spark, list(enumerate([*lines, lines[4], lines[4]])))
    expected = sorted(band for line in set(lines) for band in plain_bands(line))
    for run in (2, 3, line_dedup.RUN, 64):
        monkeypatch.setattr(line_dedup, "RUN", run)
        signed = line_dedup.signatures(docs)
        assert line_dedup.band_rows(signed).count() == 12 * len(set(lines))
        seen = [(n, *(row[f"least_{i}"] for i in at)) for row in signed.collect() for n, at in enumerate(line_dedup.BANDS)]
        assert sorted(seen) == expected


def test_a_run_of_shingles_is_one_row(spark):
    """What is combined by line are runs: an eighth of the rows, and no list of numbers to be stored."""
    line = " ".join(f"w{n}" for n in range(100))
    signed = line_dedup.signatures(table(spark, [(1, line)]))
    plan = signed._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(sequence(" in plan and "explode(regexp" not in plan
    assert [kind for _, kind in signed.dtypes] == ["bigint", *["int"] * 16]


def test_pairs_of_buckets_of_two_and_more(spark):
    buckets = {n: sorted(random.Random(n).sample(range(-50, 50), n)) for n in (2, 3, 16, 17)}
    rows = [(b, len(keys), k) for b, keys in buckets.items() for k in keys]
    found = line_dedup.bucket_pairs(spark.createDataFrame(rows, "band bigint, n bigint, key bigint")).collect()
    expected = {(a, b) for n in (2, 3, 16) for i, a in enumerate(buckets[n]) for b in buckets[n][i + 1 :]}
    large = buckets[17]
    expected |= {(large[0], k) for k in large[1:]} | {(k, large[-1]) for k in large[:-1]}
    assert len(found) == len(expected) and {(r.a, r.b) for r in found} == expected


def test_lines_that_occur_once_are_counted_without_a_sort(spark, monkeypatch):
    plans, write = {}, line_dedup.stored

    def stored(df, label, **figures):
        plans[label] = df._jdf.queryExecution().executedPlan().toString(), (out := write(df, label, **figures)).seen["n_rows"]
        return out

    monkeypatch.setattr(line_dedup, "stored", stored)
    docs = [(1, "alone\ntwice"), (2, "twice\nalso alone"), (3, "twice"), (None, "twice\ntwice")]
    out = {r.doc_id: r.n_removed for r in line_dedup.line_dedup(table(spark, docs)).collect()}
    assert out == {1: 0, 2: 1, 3: 1, None: 2}
    assert "SortAggregate" not in plans["repeated_keys"][0]
    assert plans["repeated_keys"][1] == 1 and plans["repeated_occurrences"][1] == 5
