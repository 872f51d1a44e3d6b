"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are the 64 leaves' bits of a binary trie.  The join walks pairs
of trie nodes together, from the pair (root, root) down, adds up the bits in
which the two paths differ and drops a pair as soon as that exceeds the
budget.  The upper levels are DataFrame joins of node pairs (four bits a
step), opened only while the two subtrees together hold more than
``leaf_rows`` fingerprints; what is then left, pairs of small subtrees, is
walked bit by bit with numpy, one bounded group a pair.  A dense cluster only
makes the walk go deeper there, so no group grows with a cluster's size.

Equal fingerprints are one node from the start; a group of subtrees gives a
spanning forest of its links (at most one row per fingerprint), not its pairs;
components come from star contraction on those forests.

Defined cases: a null text is empty; a text without words has fingerprint
zero and links like any other; null ids never name a component unless all its
ids are null; repeated rows get one row each.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkit.llm.common import arrow_batch, keep_one, named, text_hash, texts_of, written

BITS = 64
STEP = 4  # bits per joined level


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of one text: bit i is set if it is set in over half of the shingles' XXH64 values."""
    import numpy as np
    from xxhash import xxh64_digest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    totals, n = np.zeros(BITS, dtype=np.int64), max(1, len(words) - shingle + 1)
    for at in range(0, n, 65536):  # whole texts in bounded blocks
        block = words[at : min(n, at + 65536) + shingle - 1]
        runs = zip(*(block[k:] for k in range(shingle))) if len(words) >= shingle else [words]
        digests = b"".join([xxh64_digest(b" ".join(run), seed) for run in runs])
        bits = np.unpackbits(np.frombuffer(digests, dtype=np.uint8).reshape(-1, 8), axis=1)
        totals += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(totals * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3, seed: int = 42) -> DataFrame:
    """id, text_hash, fp (the fingerprint's bits as a signed long)."""
    base = named(docs, id=id_col, text=text_col)
    base = base.select("id", text_hash(F.col("text")).alias("text_hash"), "text")

    def compute(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            values = [fingerprint(t, shingle, seed) for t in texts_of(batch, 2)]
            fps = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
            arrays = [batch.column(0), batch.column(1), fps]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "text_hash", "fp"])

    id_type = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(compute, f"id {id_type}, text_hash bigint, fp bigint")


def _prefix(depth: int):
    return F.shiftrightunsigned("fp", BITS - depth) if depth else F.lit(0).cast("bigint")


def _node_pairs(fps: DataFrame, budget: int, leaf_rows: int) -> list[tuple[int, DataFrame]]:
    """Pairs of trie nodes (a, b, diff) by depth, each pair holding at most
    ``leaf_rows`` fingerprints; together they cover every pair of
    fingerprints within ``budget`` bits."""
    spark = fps.sparkSession
    n = fps.count()
    done, depth = [], 0
    pairs = spark.range(1).selectExpr(
        "0L as a", "0L as b", "0 as diff", f"{n}L as na", f"{n}L as nb"
    )
    while True:
        rows = F.when(F.col("a") == F.col("b"), F.col("na")).otherwise(F.col("na") + F.col("nb"))
        small = rows <= leaf_rows if depth < BITS else F.lit(True)
        done.append((depth, pairs.where(small).select("a", "b", "diff")))
        pairs = pairs.where(~small)
        if depth == BITS or pairs.isEmpty():
            return [(d, p) for d, p in done if not p.isEmpty()]
        depth += STEP
        nodes = fps.groupBy(_prefix(depth).alias("node")).agg(F.count("*").alias("rows"))
        nodes = nodes.withColumn("parent", F.shiftrightunsigned("node", STEP))
        side = lambda s: nodes.select(
            F.col("parent").alias(s), F.col("node").alias(f"{s}2"), F.col("rows").alias(f"n{s}2")
        )
        diff = F.expr(f"diff + bit_count((a2 ^ b2) & {(1 << STEP) - 1}L)")
        pairs = (
            pairs.join(side("a"), "a")
            .join(side("b"), "b")
            .where((F.col("a") != F.col("b")) | (F.col("a2") <= F.col("b2")))
            .withColumn("diff", diff)
            .where(F.col("diff") <= budget)
            .selectExpr("a2 as a", "b2 as b", "diff", "na2 as na", "nb2 as nb")
        )
        pairs = written(pairs, f"trie-{depth}")


def subtree_links(left, right, depth: int, diff: int, budget: int):
    """Component labels over ``left`` + ``right`` (sorted distinct uint64 fingerprints under two
    trie nodes at ``depth`` whose paths differ in ``diff`` bits; the same array twice for a node
    with itself), by walking both subtrees together."""
    import numpy as np

    same = left is right
    offset = 0 if same else len(left)
    values = left if same else np.concatenate([left, right])
    label = np.arange(len(values))

    def unite(i, j) -> None:
        nonlocal label
        while True:
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                shorter = label[label]
                if (shorter == label).all():
                    break
                label = shorter

    start = np.array([[0, len(left), 0, len(right), diff]], dtype=np.int64)
    stack = [(depth, start)] if len(left) and len(right) else []
    while stack:
        d, p = stack.pop()
        if len(p) > 200_000:  # bounded memory: part of the frontier at a time
            stack += [(d, p[200_000:]), (d, p[:200_000])]
            continue
        na, nb = p[:, 1] - p[:, 0], p[:, 3] - p[:, 2]
        few = na * nb <= 16 if d < BITS else np.ones(len(p), dtype=bool)
        if few.any():
            q, size = p[few], (na * nb)[few]
            row = np.repeat(np.arange(len(q)), size)
            k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            width = nb[few][row]
            i, j = q[row, 0] + k // width, q[row, 2] + k % width
            near = np.bitwise_count(left[i] ^ right[j]) <= budget
            if same:
                near &= i < j
            unite(i[near], j[near] + offset)
        p = p[~few]
        if not len(p):
            continue
        bit = np.uint64(1) << np.uint64(BITS - 1 - d)
        below = bit | (bit - np.uint64(1))  # the bits not yet walked
        cut_a = np.searchsorted(left, (left[p[:, 0]] & ~below) | bit)
        cut_b = np.searchsorted(right, (right[p[:, 2]] & ~below) | bit)
        a0, a1 = (p[:, 0], cut_a), (cut_a, p[:, 1])
        b0, b1 = (p[:, 2], cut_b), (cut_b, p[:, 3])
        itself = same & (p[:, 0] == p[:, 2]) & (p[:, 1] == p[:, 3])
        kids = []
        for a, b, more in ((a0, b0, 0), (a1, b1, 0), (a0, b1, 1), (a1, b0, 1)):
            kid = np.column_stack([*a, *b, p[:, 4] + more])
            keep = (kid[:, 0] < kid[:, 1]) & (kid[:, 2] < kid[:, 3]) & (kid[:, 4] <= budget)
            if more and a is a1:
                keep &= ~itself  # the mirror image of (a0, b1)
            kids.append(kid[keep])
        stack.append((d + 1, np.concatenate(kids)))
    return values, label


def fingerprint_links(fps: DataFrame, budget: int = 2, leaf_rows: int = 32768) -> DataFrame:
    """A forest (u, v) that links the distinct fingerprints ``fp`` that are within ``budget`` bits."""
    parts = None
    for depth, pairs in _node_pairs(fps, budget, leaf_rows):
        under = fps.select("fp", _prefix(depth).alias("node"))
        left = under.join(pairs, under.node == pairs.a).select("a", "b", "diff", "fp", F.lit(0).alias("side"))
        crossing = pairs.where("a <> b")
        right = under.join(crossing, under.node == crossing.b).select(
            "a", "b", "diff", "fp", F.lit(1).alias("side")
        )
        both = left.unionByName(right).withColumn("depth", F.lit(depth))
        parts = both if parts is None else parts.unionByName(both)
    if parts is None:
        return fps.sparkSession.createDataFrame([], "u bigint, v bigint")

    def walk(table):
        import numpy as np
        import pyarrow as pa

        fp = table.column("fp").to_numpy().view(np.uint64)
        side = table.column("side").to_numpy()
        left = np.sort(fp[side == 0])
        right = np.sort(fp[side == 1]) if (side == 1).any() else left
        values, label = subtree_links(
            left, right, table.column("depth")[0].as_py(), table.column("diff")[0].as_py(), budget
        )
        linked = label != np.arange(len(label))
        signed = values.view(np.int64)
        return pa.table({"u": signed[linked], "v": signed[label[linked]]})

    return parts.groupBy("depth", "a", "b").applyInArrow(walk, "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """node, root: root is the smallest node that the links (u, v) reach.

    Alternating large-star and small-star contraction; every round is written
    to the shared folder, and rounds grow with the logarithm of a
    component's size."""
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.union(lowest.select("u", "m")).where("u <> v").distinct(), "stars")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    budget: int = 2,
    seed: int = 42,
    leaf_rows: int = 32768,
) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint, component_id, text_hash, root (the component's own key)."""
    marked = written(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    fps = written(marked.groupBy("fp").agg(F.min("id").alias("least_id")), "distinct-fingerprints")
    stars = components(fingerprint_links(fps.select("fp"), budget, leaf_rows))
    rooted = fps.join(stars, fps.fp == stars.node, "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    rooted = written(rooted, "rooted")
    # only roots with further members need the second look-up
    named_roots = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = rooted.join(named_roots, "root").select("fp", "root", "component_id")
    return marked.join(classes, "fp").select(
        "id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "text_hash", "root"
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component (the one that names it), with the columns of ``docs``."""
    found = near_duplicates(docs, id_col, text_col, **options)
    kept = found.where(F.col("id").eqNullSafe(F.col("component_id")))
    # an id may stand on several texts: the smallest text hash decides, so one row stays
    kept = kept.groupBy("id", "root").agg(
        F.min("text_hash").alias("text_hash"), F.count("*").alias("n")
    )
    return keep_one(docs, written(kept.select("id", "text_hash", "n"), "kept"), id_col, text_col)
