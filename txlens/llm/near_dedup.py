"""Near-duplicate documents: chosen-path set similarity join on word shingles.

1. Every text becomes its set of hashed word shingles and ``TREES`` x ``DEPTH`` minwise tokens.
   Documents with equal sets form one class; only its smallest id goes on.
2. Independent trees branch the documents by their minwise tokens: a node holds the documents
   that chose the same tokens on the path to it. Nodes of up to ``NODE`` documents are
   compared exhaustively. A larger node links its members to two leaders and branches on.
3. Comparing means counting equal tokens of short sketches; pairs that may reach the
   threshold are candidates. Each document's best candidates are confirmed on the full sets
   first; links already implied by those need no confirmation, all others are confirmed next.
4. Where a path ends in a node that is still large and has documents outside its largest component, each
   of those is compared with the whole node on the full sets, block by block. So no candidate is cut off.

A pair at the threshold meets in a node of depth d of one tree with chance 0.8**d; twelve trees
miss it with chance 5e-6 at depth 2 and 2e-3 at depth 4, which only large nodes reach. The sketch test
misses fewer than 1 in 10 000 such pairs.

Nulls and edge cases: null, empty and blank texts have empty sets and link with nothing; a text with
fewer words than a shingle is one shingle; a null id links with nothing; rows that repeat an id
count as one document; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlens.llm.components import connected_components
from txlens.llm.shared import id_or_last, id_or_null, joined, n_rows, seen_as, stored, within

TREES, DEPTH = 12, 4
NODE = 32
BLOCK = 64
SIMILARITY = 80  # per cent
MAX_SIDE = 200_000  # broadcast bound, at most 60 bytes a row
_MEMO = 300_000

_SALTS = np.random.default_rng(2024).integers(1, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Words(dict):
    """Hashes of words, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int, memo: dict) -> np.ndarray:
    """Sorted hashes of the distinct word shingles, A-Z lower-cased."""
    # bytes.lower() and bytes.split() treat exactly A-Z and [\x20\x09-\x0D].
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))
    n = max(1, len(hashes) - size + 1)
    rolling = np.full(n, np.uint64(min(size, len(words))))
    for i in range(min(size, len(words))):
        rolling = _mix(rolling ^ hashes[i : i + n]) + np.uint64(i)
    return np.unique(rolling)


def minwise(shingles: np.ndarray) -> np.ndarray:
    """One 32-bit minwise token per tree and level."""
    least = np.full(len(_SALTS), np.uint64(2**64 - 1))
    for at in range(0, len(shingles), 4096):
        least = np.minimum(least, (shingles[at : at + 4096, None] * _SALTS).min(axis=0))
    return (_mix(least) >> np.uint64(32)).astype(np.uint32)


def sketch_documents(documents: DataFrame, shingle_words: int) -> DataFrame:
    """doc_id, mark (hash of the text), n_shingles, two set digests, tokens (array<int>) and sketch (one byte a token)."""

    def sketch(batches):
        memo = _Words()
        for batch in batches:
            out = {"n_shingles": [], "h1": [], "h2": [], "tokens": [], "sketch": []}
            for text in batch["text"]:
                found = shingle_set(text, shingle_words, memo)
                tokens = minwise(found)
                out["n_shingles"].append(len(found))
                out["h1"].append(int(np.bitwise_xor.reduce(found).astype(np.int64)) if len(found) else 0)
                out["h2"].append(int(_mix(found).sum(dtype=np.uint64).astype(np.int64)))
                out["tokens"].append(tokens.view(np.int32))
                out["sketch"].append(tokens.astype(np.uint8).tobytes())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "mark": batch["mark"], **out})

    kinds = "doc_id long, mark long, n_shingles long, h1 long, h2 long, tokens array<int>, sketch binary"
    rows = documents.select(id_or_last().alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    return rows.mapInPandas(sketch, kinds).withColumn("doc_id", id_or_null("doc_id"))


def _cut(similarity: int) -> int:
    """Least number of equal tokens, four deviations below what the threshold gives."""
    n, p = len(_SALTS), similarity / 100
    return max(1, math.floor(n * p - 4 * math.sqrt(n * p * (1 - p))))


def _pairs(ids, sizes, sketches, first, second, similarity: int) -> pd.DataFrame:
    """Candidates among given index pairs: sizes compatible, sketches alike."""
    equal = (sketches[first] == sketches[second]).sum(axis=1)
    small, large = np.minimum(sizes[first], sizes[second]), np.maximum(sizes[first], sizes[second])
    good = (equal >= _cut(similarity)) & (100 * small >= similarity * large) & (ids[first] != ids[second])
    a, b = ids[first][good], ids[second][good]
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "alike": equal[good].astype(np.int64)})


_PAIR = "a long, b long, alike long"


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint8).reshape(len(column), -1)


def compare_nodes(nodes: DataFrame, similarity: int) -> DataFrame:
    """Candidates within nodes given as arrays (ids, sizes, sketches) of at most NODE members."""

    def compare(batches):
        for batch in batches:
            for ids, sizes, sketches in zip(batch["ids"], batch["sizes"], batch["sketches"]):
                first, second = np.triu_indices(len(ids), 1)
                out = _pairs(np.asarray(ids), np.asarray(sizes), _matrix(sketches), first, second, similarity)
                if len(out):
                    yield out

    return nodes.mapInPandas(compare, _PAIR)


def compare_rows(rows: DataFrame, similarity: int) -> DataFrame:
    """Candidates among rows that hold two documents: (id, size, sketch) and (id2, size2, sketch2)."""

    def compare(batches):
        for batch in batches:
            n = len(batch)
            if n:
                ids = np.concatenate([batch["id"].to_numpy(), batch["id2"].to_numpy()])
                sizes = np.concatenate([batch["size"].to_numpy(), batch["size2"].to_numpy()])
                both = np.vstack([_matrix(batch["sketch"]), _matrix(batch["sketch2"])])
                yield _pairs(ids, sizes, both, np.arange(n), np.arange(n, 2 * n), similarity)

    return rows.mapInPandas(compare, _PAIR)


def _node(level: int) -> Column:
    at = [F.get("tokens", F.col("tree") * DEPTH + i) for i in range(level + 1)]
    return F.xxhash64("tree", *at)


def candidates(reps: DataFrame, similarity: int) -> tuple[DataFrame, DataFrame | None]:
    """Candidate pairs of all trees, and the members (node, id) of large last nodes."""
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    active = reps.select("id", "size", "sketch", "tokens", trees.alias("tree"))
    found: list[DataFrame] = []
    for level in range(DEPTH):
        placed = active.withColumn("node", _node(level))
        nodes = placed.groupBy("node").agg(
            F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high")
        ).filter("n > 1")
        nodes = stored(nodes, "nodes")
        small = placed.select("node", "id", "size", "sketch").join(
            nodes.filter(F.col("n") <= NODE).select("node"), "node"
        )
        members = small.groupBy("node").agg(
            F.collect_list("id").alias("ids"),
            F.collect_list("size").alias("sizes"),
            F.collect_list("sketch").alias("sketches"),
        )
        found.append(stored(compare_nodes(members.select("ids", "sizes", "sketches"), similarity).distinct(), "pairs"))
        large = stored(nodes.filter(F.col("n") > NODE), "large_nodes")
        if not n_rows(large):
            return _union(found), None
        inside = joined(placed, large, ["node"], "inner", MAX_SIDE)
        leader = reps.select(
            F.col("id").alias("leader"), F.col("size").alias("size2"), F.col("sketch").alias("sketch2")
        )
        led = large.select("node", F.explode(F.array("low", "high")).alias("leader")).join(leader, "leader")
        led = stored(led.select("node", F.col("leader").alias("id2"), "size2", "sketch2"), "leaders")
        stars = joined(inside.select("node", "id", "size", "sketch"), led, ["node"], "inner", MAX_SIDE)
        found.append(stored(compare_rows(stars, similarity).distinct(), "stars"))
        active = stored(inside.select("id", "size", "sketch", "tokens", "tree", "node"), "active")
    return _union(found), active.select("node", "id")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def confirm(pairs: DataFrame, texts: DataFrame, shingle_words: int, similarity: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""

    def check(batches):
        memo, last, kept = _Words(), None, None
        for batch in batches:
            good = []
            for a, text, other in zip(batch["a"], batch["text"], batch["text2"]):
                if a != last:
                    last, kept = a, shingle_set(text, shingle_words, memo)
                one, two = kept, shingle_set(other, shingle_words, memo)
                shared = len(np.intersect1d(one, two, assume_unique=True))
                good.append(100 * shared >= similarity * (len(one) + len(two) - shared))
            yield batch.loc[good, ["a", "b"]]

    left = texts.select(F.col("id").alias("a"), "text")
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text2"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").mapInPandas(check, "a long, b long")


def _cross(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are not yet in one component."""
    small = seen_as(labels.select(F.col("node").alias("a"), F.col("component").alias("ca")), labels)
    other = seen_as(labels.select(F.col("node").alias("b"), F.col("component").alias("cb")), labels)
    both = joined(joined(pairs, small, ["a"], "left", MAX_SIDE), other, ["b"], "left", MAX_SIDE)
    apart = ~F.coalesce("ca", "a").eqNullSafe(F.coalesce("cb", "b"))
    return both.filter(apart).select(*pairs.columns)


def _best(pairs: DataFrame) -> DataFrame:
    """For each document the candidate most like it."""
    top = F.max(F.struct("alike", "a", "b")).alias("top")
    ends = pairs.groupBy("a").agg(top).select("top.*").unionByName(pairs.groupBy("b").agg(top).select("top.*"))
    return ends.select("a", "b").distinct()


def _links(first, second, shingle_words: int, similarity: int, memo: dict) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two blocks of texts whose full sets reach the threshold."""
    sets = [[shingle_set(t, shingle_words, memo) for t in block] for block in (first, second)]
    known, place = np.unique(np.concatenate([x for block in sets for x in block]), return_inverse=True)
    has = np.zeros((len(first) + len(second), len(known)), dtype=np.float32)
    owner = np.repeat(np.arange(len(has)), [len(x) for block in sets for x in block])
    has[owner, place] = 1
    one, two = has[: len(first)], has[len(first) :]
    shared = one @ two.T
    either = one.sum(axis=1)[:, None] + two.sum(axis=1)[None, :] - shared
    return np.nonzero(100 * shared >= similarity * either)


def leftovers(
    members: DataFrame, labels: DataFrame, documents: DataFrame, shingle_words: int, similarity: int
) -> DataFrame:
    """Links between documents of different components in large last nodes, found on the full sets.

    Members of a node's largest component are connected already, so only the others are compared:
    in blocks, each block of outsiders with each block of the node. A block pair is one row.
    """
    side = seen_as(labels.select(F.col("node").alias("id"), "component"), labels)
    placed = joined(members, side, ["id"], "left", MAX_SIDE).withColumn("component", F.coalesce("component", "id"))
    counted = placed.groupBy("node", "component").agg(F.count(F.lit(1)).alias("n"))
    main = counted.groupBy("node").agg(
        F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all")
    ).filter(F.col("all") > F.col("top.n"))
    n_blocks, n_out = F.ceil(F.col("all") / BLOCK), F.ceil((F.col("all") - F.col("top.n")) / BLOCK)
    main = stored(
        main.select("node", F.col("top.component").alias("main"), n_blocks.alias("n_blocks"), n_out.alias("n_out")),
        "mixed_nodes",
    )
    mixed = stored(joined(placed.select("node", "id", "component"), main, ["node"], "inner", MAX_SIDE), "mixed")
    mixed = mixed.join(_texts(documents, mixed.select("id").distinct()), "id")
    place, entry = F.xxhash64("id"), F.struct("id", "text")
    blocks = mixed.groupBy("node", F.pmod(place, "n_blocks").alias("block")).agg(F.collect_list(entry).alias("docs"))
    outside = mixed.filter("component != main").groupBy("node", "n_blocks", F.pmod(place, "n_out").alias("out"))
    outside = outside.agg(F.collect_list(entry).alias("outsiders"))
    outside = outside.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))

    def compare(batches):
        memo = _Words()
        for batch in batches:
            for docs, outsiders in zip(batch["docs"], batch["outsiders"]):
                texts = [[d["text"] for d in block] for block in (docs, outsiders)]
                at, out = _links(*texts, shingle_words, similarity, memo)
                a = np.array([docs[i]["id"] for i in at], dtype=np.int64)
                b = np.array([outsiders[i]["id"] for i in out], dtype=np.int64)
                yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})[a != b]

    pairs = blocks.join(outside, ["node", "block"]).select("docs", "outsiders")
    return pairs.mapInPandas(compare, "a long, b long").distinct()


def _texts(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of the documents with the given ids."""
    texts = documents.select(F.col("doc_id").cast("long").alias("id"), "text")
    found = joined(texts, stored(ids, "wanted"), ["id"], "left_semi", MAX_SIDE)
    return stored(found.dropDuplicates(["id"]), "texts")


def near_duplicates(documents: DataFrame, shingle_words: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, mark (hash of the text), n_shingles, component_id (smallest linked id), kept."""
    sketched = stored(sketch_documents(documents, shingle_words), "sketches")
    usable = sketched.filter("n_shingles > 0 and doc_id is not null")
    key = ["n_shingles", "h1", "h2"]
    classes = stored(
        usable.groupBy(*key).agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n_rows")), "classes"
    )
    reps = stored(
        usable.join(classes.select(*key, "id"), [*key], "inner")
        .filter("doc_id = id")
        .select("id", F.col("n_shingles").alias("size"), "tokens", "sketch")
        .dropDuplicates(["id"]),
        "representatives",
    )
    pairs, members = candidates(reps, similarity)
    pairs = stored(pairs.distinct(), "candidates")
    texts = _texts(documents, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    links = stored(confirm(_best(pairs), texts, shingle_words, similarity), "links")
    labels = stored(connected_components(links), "labels")
    rest = stored(_cross(pairs, labels), "rest")
    more = stored(confirm(rest, texts, shingle_words, similarity), "links")
    if n_rows(more):
        links = links.unionByName(more)
        labels = stored(connected_components(links), "labels")
    if members is not None:
        more = stored(leftovers(members, labels, documents, shingle_words, similarity), "links")
        if n_rows(more):
            labels = stored(connected_components(links.unionByName(more)), "labels")
    linked = seen_as(labels.select(F.col("node").alias("id"), "component"), labels)
    named = joined(classes, linked, ["id"], "left", MAX_SIDE)
    named = named.withColumn("component", F.coalesce("component", "id")).filter("n_rows > 1 or component != id")
    named = stored(named.select(*key, "component"), "named")
    out = joined(sketched.select("doc_id", "mark", *key), named, key, "left", MAX_SIDE)
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", "mark", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def keep_one_of_each(documents: DataFrame, shingle_words: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Rows are told apart by id and text: one that shares its id with a near copy but not its text stays.
    """
    gone = near_duplicates(documents, shingle_words, similarity).filter("NOT kept").select("doc_id", "mark")
    gone = stored(gone.distinct().toDF("_gone_id", "_gone_mark"), "near_copies")
    side = F.broadcast(gone) if within(gone, MAX_SIDE) else gone
    same = documents["doc_id"].cast("long") == F.col("_gone_id")
    return documents.join(side, same & (F.xxhash64(documents["text"]) == F.col("_gone_mark")), "left_anti")


def op10_near_dedup(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle_words=2).drop("mark")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN [words[1]]
           ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.a, r.c FROM r JOIN e ON r.doc_id = e.b),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN m ON m.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
