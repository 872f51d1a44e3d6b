"""Approximate nearest neighbours by multi-index hashing.

Vectors get binary codes from a learned rotation (principal axes, then the
rotation that brings them closest to the corners of the cube).  A code is
split into ``tables`` substrings and indexed by each.  Two codes within
Hamming radius r agree in at least one substring up to floor(r / tables) bits
(pigeonhole), so probing all buckets within that distance in every table finds
every code within r.  What is found is checked against the full radius and
ranked by the exact Euclidean distance of the original vectors.

Codes and radius are learned on a bounded sample (``sample_rows``, by hash of
the id): the radius is the one within which ``coverage`` of the sample's true
neighbours lie.  Every row is indexed.  A query that finds fewer neighbours
than asked for is searched again with the full radius, so lists are complete.

Equal vectors are one entry that keeps its ``k + 1`` smallest ids, all that a
top-k list can use.  Index rows are dealt by (table, leading bits of the
substring); a part that grows too large, such as a dense cluster, is split
further by hash, and queries go to every split of the parts they probe.

Defined cases: vectors that are null, zero, hold null or non-finite values, or
are not of the most common length take no part, nor do rows without an id;
repeated rows count once; ties go to the smaller id; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelkit.llm.common import named, written

BITS = 64


@dataclass
class Coder:
    mean: object
    rotation: object  # d x BITS
    radius: int

    def codes(self, x):
        """uint64 code of each row."""
        import numpy as np

        bits = (x - self.mean) @ self.rotation > 0
        return np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)


def learn_codes(x, k: int, coverage: float, rounds: int = 30, seed: int = 42, probes: int = 400) -> Coder:
    """Rotated principal axes and the covering radius from sample vectors ``x``."""
    import numpy as np

    rng = np.random.default_rng(seed)
    mean = x.mean(axis=0)
    centred = x - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, : min(BITS, x.shape[1])]
    flat = centred @ axes
    blocks, held = [], 0
    while held < BITS:  # short vectors take several rotations
        turn, _ = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))
        for _ in range(rounds):
            corners = np.where(flat @ turn > 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(corners.T @ flat)
            turn = (u @ v).T
        blocks.append(axes @ turn)
        held += axes.shape[1]
    coder = Coder(mean, np.hstack(blocks)[:, :BITS], BITS)
    if len(x) > k + 1:
        codes = coder.codes(x)
        ask = rng.permutation(len(x))[:probes]
        square = (x**2).sum(1)
        away = square[ask, None] + square[None] - 2 * x[ask] @ x.T
        away[np.arange(len(ask)), ask] = np.inf
        near = np.argpartition(away, k, axis=1)[:, :k]
        bits = np.bitwise_count(codes[ask][:, None] ^ codes[near])
        coder.radius = int(np.quantile(bits, coverage, method="higher"))
    return coder


def substring_radii(radius: int, tables: int) -> list[int]:
    """Radius per table: radius = tables * low + more, and one table of the first more + 1 must agree
    within low, or one of the others within low - 1."""
    low, more = divmod(radius, tables)
    return [low if j <= more else low - 1 for j in range(tables)]


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    base = named(vectors, id=id_col, vec=vec_col)
    sound = (
        "id is not null and vec is not null and size(vec) > 0 and exists(vec, x -> x <> 0)"
        " and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    )
    base = base.where(F.coalesce(F.expr(sound), F.lit(False)))
    base = base.select("id", F.col("vec").cast("array<double>").alias("vec"))
    common = base.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return base.where(F.size("vec") == (common.d if common else 0)).distinct()


def _matrix(column):
    """Rows of a list column as a matrix."""
    import numpy as np

    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return np.asarray(column.flatten()).reshape(len(column), -1)


def build_index(rows: DataFrame, coder: Coder, k: int) -> DataFrame:
    """vkey, vec, code, ids (the k + 1 smallest): one row per distinct vector."""
    place = Window.partitionBy("vec").orderBy("id")
    least = rows.withColumn("n", F.row_number().over(place)).where(F.col("n") <= k + 1)
    entries = least.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))  # at most k + 1 ids

    def compute(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                codes = pa.array(coder.codes(_matrix(batch.column(0))).view(np.int64))
                yield pa.RecordBatch.from_arrays([*batch.columns, codes], names=["vec", "ids", "code"])

    id_type = rows.schema["id"].dataType.simpleString()
    coded = entries.mapInArrow(compute, f"vec array<double>, ids array<{id_type}>, code bigint")
    return written(coded.withColumn("vkey", F.monotonically_increasing_id()), "ann-index")


def _table_search(k: int, tables: int, radii: list[int], radius: int):
    """Search of one part of one table: (index rows, query rows) -> the k + 1 nearest found per query."""

    def search(index, queries):
        import numpy as np
        import pyarrow as pa

        out = pa.schema([("query", pa.int64()), ("vkey", pa.int64()), ("distance", pa.float64())])
        if not index.num_rows or not queries.num_rows:
            return out.empty_table()
        table = index.column("j")[0].as_py()
        width = BITS // tables
        cut = lambda codes, j: (codes >> np.uint64(BITS - width * (j + 1))) & np.uint64((1 << width) - 1)
        codes = index.column("code").to_numpy().view(np.uint64)
        values = cut(codes, table)
        order = np.argsort(values, kind="stable")
        codes, values = codes[order], values[order]
        vectors = _matrix(index.column("vec"))[order]
        keys = index.column("vkey").to_numpy()[order]
        # the buckets of this part, each a run of rows
        buckets, first, size = np.unique(values, return_index=True, return_counts=True)
        asked = queries.column("q_code").to_numpy().view(np.uint64)
        wanted = _matrix(queries.column("q_vec"))
        names = queries.column("query").to_numpy()
        found = []
        for q, v, name in zip(asked, wanted, names):
            probe = np.bitwise_count(buckets ^ cut(q, table)) <= radii[table]
            if not probe.any():
                continue
            runs = size[probe]
            rows = np.repeat(first[probe] - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
            apart = codes[rows] ^ q
            near = np.bitwise_count(apart) <= radius
            for j in range(table):  # a code that an earlier table finds is left to that table
                near &= np.bitwise_count(cut(apart, j)) > radii[j]
            rows = rows[near]
            if not len(rows):
                continue
            distance = np.sqrt(((vectors[rows] - v) ** 2).sum(axis=1))
            if len(rows) > k + 1:
                # all that tie with the last place stay; ties are settled by id later
                last = np.partition(distance, k)[k]
                keep = distance <= last
                rows, distance = rows[keep], distance[keep]
            found.append((np.full(len(rows), name), keys[rows], distance))
        if not found:
            return out.empty_table()
        return pa.table([np.concatenate(c) for c in zip(*found)], schema=out)

    return search


def probe_tables(index: DataFrame, queries: DataFrame, radius: int, k: int, tables: int, part_rows: int) -> DataFrame:
    """query, vkey, distance: per part the nearest of every code within ``radius`` of the query's code."""
    radii, width = substring_radii(radius, tables), BITS // tables
    n = index.count()
    lead = min(width, max(0, (n // part_rows).bit_length()))  # about part_rows rows to a part
    js = F.explode(F.sequence(F.lit(0), F.lit(tables - 1)))
    part = F.expr(f"cast(shiftrightunsigned(code << (j * {width}), {BITS - lead}) as bigint)" if lead else "0L")
    dealt = index.select("vkey", "vec", "code", js.alias("j")).withColumn("part", part)
    held = dealt.groupBy("j", "part").agg(F.count("*").alias("rows"))
    held = held.withColumn("splits", F.ceil(F.col("rows") / F.lit(4 * part_rows)).cast("int")).drop("rows")
    held = written(held, "ann-parts")
    dealt = dealt.join(held, ["j", "part"]).withColumn("split", F.pmod(F.xxhash64("vkey"), "splits").cast("int"))
    allowed = "array(" + ", ".join(map(str, radii)) + ")[j]"
    asked = queries.select(F.col("vkey").alias("query"), F.col("vec").alias("q_vec"), "code", js.alias("j"))
    asked = asked.withColumn("part", part).withColumn("q_code", F.col("code")).drop("code")
    # a part is probed if its leading bits alone do not exceed the table's radius
    asked = asked.withColumnRenamed("part", "own").join(held, "j").where(F.expr(f"bit_count(own ^ part) <= {allowed}"))
    asked = asked.withColumn("split", F.explode(F.expr("sequence(0, splits - 1)")))
    keys = ["j", "part", "split"]
    left = dealt.select(*keys, "vkey", "vec", "code").groupBy(*keys)
    right = asked.select(*keys, "query", "q_vec", "q_code").groupBy(*keys)
    return left.cogroup(right).applyInArrow(
        _table_search(k, tables, radii, radius), "query bigint, vkey bigint, distance double"
    )


def nearest_neighbours(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    every: int = 100,
    k: int = 10,
    tables: int = 4,
    sample_rows: int = 4000,
    coverage: float = 0.98,
    part_rows: int = 8192,
) -> DataFrame:
    """query_id, rank, id, score: the ``k`` nearest rows of each row whose id is divisible by ``every``."""
    import numpy as np

    rows = written(usable(vectors, id_col, vec_col), "ann-rows")
    id_type = rows.schema["id"].dataType.simpleString()
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("vec").toArrow()  # bounded
    if not sample.num_rows:
        return rows.sparkSession.createDataFrame([], f"query_id {id_type}, rank int, id {id_type}, score double")
    x = _matrix(sample.column("vec"))
    coder = learn_codes(x, k, coverage)
    index = build_index(rows, coder, k)
    members = rows.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "vec")
    members = written(members.join(index.select("vec", "vkey"), "vec").select("query_id", "vkey"), "ann-queries")
    searched = index.join(members.select("vkey").distinct(), "vkey", "left_semi")
    ids = index.select("vkey", "ids")

    def ranked(asked: DataFrame, radius: int) -> DataFrame:
        found = probe_tables(index, asked, radius, k, tables, part_rows)
        # k + 1 distinct vectors hold at least k ids other than the query's own
        order = Window.partitionBy("query").orderBy("distance")
        found = found.withColumn("n", F.rank().over(order)).where(F.col("n") <= k + 1).drop("n")
        found = found.join(ids, "vkey").select("query", "distance", F.explode("ids").alias("id"))
        wide = Window.partitionBy("query").orderBy("distance", "id")
        found = found.withColumn("n", F.row_number().over(wide)).where(F.col("n") <= k + 1).drop("n")
        lists = members.join(found, members.vkey == found["query"]).where("id <> query_id")
        nearest = Window.partitionBy("query_id").orderBy("distance", "id")
        lists = lists.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
        return lists.select("query_id", "rank", "id", F.col("distance").alias("score"), "vkey")

    lists = written(ranked(searched, coder.radius), "ann-lists")
    if coder.radius < BITS:
        full = lists.groupBy("query_id", "vkey").agg(F.count("*").alias("n")).where(F.col("n") >= k)
        short = written(members.join(full, ["query_id", "vkey"], "left_anti").select("vkey").distinct(), "ann-short")
        if not short.isEmpty():
            again = ranked(searched.join(short, "vkey", "left_semi"), BITS)
            lists = lists.join(short, "vkey", "left_anti").unionByName(again)
    return lists.select("query_id", "rank", "id", "score")
