"""Small document tables for the tests."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators use under the same names inside, as a caller might have them.
CLASHES = ["id", "mark", "key", "place", "line", "n", "size", "score", "raw", "component", "item_id", "_row", "spans"]


def table(spark, rows, clash=False):
    """documents from (doc_id, text[, lang[, source]])."""
    full = [(*r, *(["en", "s"][len(r) - 2 :]), len(r[1]) if r[1] is not None else None) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if clash:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("x") for c in CLASHES})
    return df


LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
EDGE = [
    (1, "a b c\nd e f"),
    (1, "a b c\nd e f"),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b\x0c\r "),
    (None, "a b c\nd e f"),
    (None, None),
    (5, LONG),
    (6, LONG + " tail"),
    (7, "ünï çödé 漢字かな"),
    (8, "A  b c d e F"),
]


def components(nodes, links):
    """Smallest reachable node of each node."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


BLANKS = " \t\n\x0b\x0c\r"


def plain_set(line):
    """A line's shingles: nine characters from each place that starts a word, is a letter written without blanks, or has nine left."""
    out = set()
    for i, c in enumerate(line):
        if c in BLANKS:
            continue
        starts = i == 0 or line[i - 1] in BLANKS
        dense = "⺀" <= c <= "힯" or "豈" <= c <= "﫿"
        long = i + 9 <= len(line) and not any(x in BLANKS for x in line[i : i + 9])
        if starts or dense or long:
            out.add(line[i : i + 9])
    return out
