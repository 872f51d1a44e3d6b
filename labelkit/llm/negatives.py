"""Hard negatives by angular triangle filtering.

Vectors become integers, floor(scale * x), and scores are exact integer inner
products.  Every row stores its angles to a few reference directions.  For an
anchor at angle a and a row at angle b to the same direction, the triangle
inequality of angles says that they lie between |a - b| and a + b apart, so
the row's cosine lies in an interval; multiplied by the norms it bounds the
score from both sides.  Angles are widened by ``SLACK`` radians, far above
their rounding error, so a bound never excludes a row that counts.

Rows are stored in chunks: range-partitioned by (nearest direction, angle to
it, id) and cut into at most ``chunk_bytes``, each chunk with its smallest
and largest angle to every direction and its norms.  A score range asked for by
an anchor is then a window of the chunk's sorted angles, found by binary
search; a chunk whose angles to any direction lie outside is skipped.  Only the
windows that remain are scored.

Anchors are numbered and taken in waves of at most ``wave_bytes``: a wave is
sent to all tasks, every task passes over its chunks once and hands back its
few best rows per anchor, and a window over (anchor) settles the order.  So
rows are shuffled once, when chunks are made, and no task or broadcast grows
with the table.  Two passes: the first finds positives (the score asked for is
the anchor's k-th best so far), the second finds negatives within
[ratio * positive score, positive score].  Both start from the thresholds that
the bounded sample for the directions already proves.

Defined cases: rows with a null id, label or vector, or with a null or
non-finite component take no part; shorter vectors (empty ones too) end in
zeros; integers are clipped where a product sum could leave 63 bits (at 2**28
for 64 components); repeated rows count once; rows that share an id are no
others to each other; zero vectors score 0; ties go to the smaller id; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelkit.llm.common import named, number_rows, written

SLACK = 1e-6
MOST = (1 << 63) - 1


@dataclass
class Space:
    """What every task needs to know: dimension, largest integer, and the reference directions."""

    width: int
    most: int
    directions: object  # width x m, unit columns

    def integers(self, column, scale: int):
        """Rows of a list column as an integer matrix (floats that hold integers)."""
        import numpy as np
        import pyarrow as pa

        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        sizes = np.diff(np.asarray(column.offsets)) if len(column) else np.zeros(0, np.int64)
        out = np.zeros((len(column), self.width))
        row = np.repeat(np.arange(len(column)), sizes)
        at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[row, at] = np.floor(np.asarray(column.flatten(), dtype=np.float64) * scale)
        return np.clip(out, -self.most, self.most)

    def scores(self, rows, anchors):
        """Exact inner products, rows x anchors, as int64."""
        import numpy as np

        if self.width * float(np.abs(rows).max(initial=0)) * float(np.abs(anchors).max(initial=0)) < 2.0**53:
            return (rows @ anchors.T).astype(np.int64)
        return rows.astype(np.int64) @ anchors.astype(np.int64).T


def norms_and_angles(x, directions):
    """Norm of each row and its angle to each direction (a zero row lies at a right angle)."""
    import numpy as np

    norm = np.sqrt((x * x).sum(axis=1))
    cosine = (x @ directions) / np.where(norm > 0, norm, 1)[:, None]
    return norm, np.arccos(np.clip(cosine, -1, 1))


def choose_directions(x, m: int):
    """At most ``m`` directions among the rows of ``x``, each far from those before it."""
    import numpy as np

    norm = np.sqrt((x * x).sum(axis=1))
    unit = x[norm > 0] / norm[norm > 0][:, None]
    if not len(unit):
        return np.eye(x.shape[1])[:, :1]
    chosen = [unit[0]]
    nearest = unit @ unit[0]
    while len(chosen) < m and nearest.min() < 0.999:
        chosen.append(unit[int(nearest.argmin())])
        nearest = np.maximum(nearest, unit @ chosen[-1])
    return np.array(chosen).T


def usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    base = named(vectors, id=id_col, vec=vec_col, label=label_col)
    sound = (
        "id is not null and label is not null and vec is not null"
        " and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    )
    base = base.where(F.coalesce(F.expr(sound), F.lit(False)))
    base = base.select("id", F.col("vec").cast("array<double>").alias("vec"), "label")
    # -0.0 and 0.0 are one component value
    return base.withColumn("vec", F.expr("transform(vec, x -> x + 0D)")).distinct()


def placed_rows(rows: DataFrame, space: Space, scale: int) -> DataFrame:
    """id, label, cell (nearest direction), angle (to it), q (the integers)."""

    def place(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x = space.integers(batch.column(1), scale)
            _, angles = norms_and_angles(x, space.directions)
            cell = angles.argmin(axis=1)
            own = angles[np.arange(len(x)), cell]
            q = pa.array([r.tobytes() for r in x.astype("<i4")], type=pa.binary())
            columns = [batch.column(0), batch.column(2), pa.array(cell, type=pa.int32()), pa.array(own), q]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "cell", "angle", "q"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(place, f"id {kinds['id']}, label {kinds['label']}, cell int, angle double, q binary")


def cut_chunks(placed: DataFrame, space: Space, chunk_rows: int) -> DataFrame:
    """Chunks of rows next to each other: ids, labels, q (a packed matrix), cell, angles (to the cell's
    direction, sorted), least and most (of the angles to every direction), low and high (norms)."""

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def packed(piece):
            x = np.frombuffer(b"".join(piece.column("q").to_pylist()), "<i4").reshape(-1, space.width).astype(float)
            norm, angles = norms_and_angles(x, space.directions)
            lists = lambda a: pa.array([a.tolist()], type=pa.list_(pa.float64()))
            listed = lambda c: pa.array([piece.column(c).to_pylist()], type=pa.list_(piece.schema.field(c).type))
            columns = {
                "ids": listed("id"),
                "labels": listed("label"),
                "cell": piece.column("cell").slice(0, 1).combine_chunks(),
                "q": pa.array([x.astype("<i4").tobytes()], type=pa.binary()),
                "angles": listed("angle"),
                "least": lists(angles.min(axis=0)),
                "most": lists(angles.max(axis=0)),
                "low": pa.array([norm.min()]),
                "high": pa.array([norm.max()]),
            }
            return pa.RecordBatch.from_pydict(columns)

        held, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                cells = batch.column("cell").to_numpy()
                if held and held[0].column("cell")[0].as_py() != cells[0]:
                    yield packed(pa.Table.from_batches(held))
                    held, rows = [], 0
                same = int(np.argmax(cells != cells[0])) or len(cells)
                piece = batch.slice(0, min(same, chunk_rows - rows))
                held.append(piece)
                rows += piece.num_rows
                batch = batch.slice(piece.num_rows)
                if rows == chunk_rows:
                    yield packed(pa.Table.from_batches(held))
                    held, rows = [], 0
        if held:
            yield packed(pa.Table.from_batches(held))

    kinds = {f.name: f.dataType.simpleString() for f in placed.schema}
    order = ["cell", "angle", "id"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        cut,
        f"ids array<{kinds['id']}>, labels array<{kinds['label']}>, cell int, q binary,"
        " angles array<double>, least array<double>, most array<double>, low double, high double",
    )


def windows(asked, ceiling, norm, angles, cell, own, least, most, low, high):
    """First and last position, per anchor, of the sorted angles ``own`` whose rows may score within
    [asked, ceiling].

    A row can reach a score s > 0 only if its angle to the anchor is at most
    arccos(s / (norms)); by the triangle inequality its angle to a direction
    is then that near to the anchor's.  It scores at most ``ceiling`` only if
    the two angles can add up to as much as the ceiling's own angle."""
    import numpy as np

    scale = norm * high
    needed = np.where((asked > 0) & (scale > 0), asked / np.where(scale > 0, scale, 1), -1.0)
    # a positive score is out of reach of a zero vector
    apart = np.where((asked > 0) & (scale == 0), -1.0, np.arccos(np.clip(needed, -1, 1)) + SLACK)
    apart = np.where(needed > 1 + SLACK, -1.0, apart)
    inside = (apart >= 0) & ((angles - apart[:, None] <= most) & (angles + apart[:, None] >= least)).all(axis=1)
    first = np.searchsorted(own, angles[:, cell] - apart, "left")
    last = np.searchsorted(own, angles[:, cell] + apart, "right")
    scale = norm * low
    cosine = np.where(scale > 0, ceiling / np.where(scale > 0, scale, 1), 1.0)
    near = np.arccos(np.clip(cosine, -1, 1)) - SLACK
    # nearer to the direction than this, a row would score above the ceiling
    first = np.maximum(first, np.where(cosine < 1, np.searchsorted(own, near - angles[:, cell], "left"), 0))
    return first, np.where(inside, last, first)


def best_rows(score, ids, k: int):
    """Positions of the ``k`` highest scores, ties to the smaller id."""
    import numpy as np

    if len(score) > k:
        keep = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        return keep[np.lexsort((ids[keep], -score[keep]))[:k]]
    return np.lexsort((ids, -score))[:k]


class Search:
    """One pass of a task: the best rows found so far for every anchor and every score range.

    ``asked`` and ``ceiling`` (anchors x ranges) bound the scores that count in
    the ranges that are ``open``; ``same`` says whether rows of the anchor's own label or of all others do."""

    def __init__(self, space: Space, wave: dict, same: bool, k: int, tile: int = 64):
        self.space, self.wave, self.same, self.k, self.tile = space, wave, same, k, tile
        self.asked, self.ceiling, self.open = wave["asked"].copy(), wave["ceiling"], wave["open"]
        self.norm, self.angles = norms_and_angles(wave["q"], space.directions)
        self.found = {}

    def add(self, ids, labels, cell: int, q, own, least, most, low: float, high: float) -> int:
        """Take the rows of a chunk into account; returns how many scores were computed."""
        import numpy as np

        x = np.frombuffer(q, "<i4").reshape(-1, self.space.width).astype(np.float64)
        asked = np.where(self.open, self.asked, MOST).min(axis=1).astype(np.float64)
        ceiling = np.where(self.open, self.ceiling, -MOST).max(axis=1).astype(np.float64)
        first, last = windows(asked, ceiling, self.norm, self.angles, cell, own, least, most, low, high)
        hit = np.flatnonzero((last > first) & self.open.any(axis=1))
        hit = hit[np.argsort(first[hit], kind="stable")]
        scored = 0
        for at in range(0, len(hit), self.tile):
            some = hit[at : at + self.tile]
            start, end = int(first[some].min()), int(last[some].max())
            scores = self.space.scores(x[start:end], self.wave["q"][some])
            scored += scores.size
            of_label = labels[start:end, None] == self.wave["label"][some]
            fits = (of_label == self.same) & (ids[start:end, None] != self.wave["id"][some])
            for column, a in enumerate(some):
                self._take(int(a), scores[:, column], fits[:, column], ids[start:end])
        return scored

    def _take(self, a: int, scores, fits, ids) -> None:
        import numpy as np

        for r in np.flatnonzero(self.open[a]):
            rows = np.flatnonzero(fits & (scores >= self.asked[a, r]) & (scores <= self.ceiling[a, r]))
            if not len(rows):
                continue
            score, name = scores[rows], ids[rows]
            if (a, r) in self.found:
                score = np.concatenate([self.found[a, r][0], score])
                name = np.concatenate([self.found[a, r][1], name])
            best = best_rows(score, name, self.k)
            self.found[a, r] = score[best], name[best]
            if len(best) == self.k:
                self.asked[a, r] = max(self.asked[a, r], score[best[-1]])

    def table(self):
        """anchor (its number), range, score, id of all rows found."""
        import numpy as np
        import pyarrow as pa

        keys = list(self.found)
        held = [len(self.found[key][0]) for key in keys]
        number = self.wave["number"]
        column = lambda i: np.concatenate([self.found[key][i] for key in keys]) if keys else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat([number[a] for a, _ in keys], held).astype(np.int64)),
                pa.array(np.repeat([r for _, r in keys], held).astype(np.int32)),
                pa.array(column(0).astype(np.int64)),
                pa.array(column(1), type=self.wave["id_type"]),
            ],
            names=["anchor", "range", "score", "id"],
        )


def _id_array(column):
    import numpy as np

    values = column.to_pylist()
    return np.array(values, dtype=object if values and isinstance(values[0], str) else None)


def searched(chunks: DataFrame, space: Space, wave: dict, same: bool, k: int) -> DataFrame:
    """Best rows of every partition for the anchors of a wave (its size is bounded by the caller)."""
    sent = chunks.sparkSession.sparkContext.broadcast(wave)

    def search(batches: Iterator) -> Iterator:
        import numpy as np

        task = Search(space, sent.value, same, k)
        for batch in batches:
            for i in range(batch.num_rows):
                cell = lambda name: batch.column(name)[i]  # noqa: B023, E731
                task.add(
                    _id_array(cell("ids").values), _id_array(cell("labels").values), cell("cell").as_py(),
                    cell("q").as_buffer(), cell("angles").values.to_numpy(), np.array(cell("least").as_py()), np.array(cell("most").as_py()),
                    cell("low").as_py(), cell("high").as_py(),
                )
        yield task.table()

    id_type = chunks.schema["ids"].dataType.elementType.simpleString()
    return chunks.mapInArrow(search, f"anchor bigint, range int, score bigint, id {id_type}")


def nearest(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of every (anchor, range) over all partitions, with their rank."""
    order = Window.partitionBy("anchor", "range").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _wave(table, space: Space, ranges: int) -> dict:
    """Anchors of a wave as arrays, without score ranges yet."""
    import numpy as np

    n = table.num_rows
    q = np.frombuffer(b"".join(table.column("q").to_pylist()), "<i4").reshape(n, space.width).astype(np.float64)
    return {
        "q": q,
        "id": _id_array(table.column("id")),
        "id_type": table.schema.field("id").type,
        "label": _id_array(table.column("label")),
        "number": table.column("number").to_numpy(),
        "open": np.zeros((n, ranges), dtype=bool),
        "asked": np.full((n, ranges), -MOST),
        "ceiling": np.full((n, ranges), MOST),
    }


def _seeded(wave: dict, space: Space, sample: dict, same: bool, k: int) -> dict:
    """The wave with the thresholds that rows of the sample prove (the ranges stay as wide otherwise)."""
    scout = Search(space, wave, same, k)
    x = sample["q"]
    for at in range(0, len(x), 4096):
        for tile in range(0, len(wave["q"]), 64):
            scores = space.scores(x[at : at + 4096], wave["q"][tile : tile + 64])
            ids, labels = sample["id"][at : at + 4096], sample["label"][at : at + 4096]
            for column in range(scores.shape[1]):
                a = tile + column
                fits = ((labels == wave["label"][a]) == same) & (ids != wave["id"][a])
                scout._take(a, scores[:, column], fits.astype(bool), ids)
    return {**wave, "asked": scout.asked}


def mine_hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    every: int = 100,
    n_positives: int = 5,
    n_negatives: int = 5,
    ratio: tuple[int, int] = (80, 100),
    scale: int = 256,
    directions: int = 16,
    sample_rows: int = 2000,
    chunk_bytes: int = 1 << 20,
    wave_bytes: int = 4 << 20,
) -> DataFrame:
    """anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose id is divisible by ``every``; a negative counts if
    ratio[0] * positive <= ratio[1] * negative <= ratio[1] * positive."""
    import numpy as np

    spark = vectors.sparkSession
    rows = written(usable(vectors, id_col, vec_col, label_col), "negative-rows")
    id_type = rows.schema["id"].dataType.simpleString()
    result = (
        f"anchor_id {id_type}, positive_id {id_type}, positive_rank int, rank int, negative_id {id_type},"
        " positive_score bigint, negative_score bigint"
    )
    width = rows.agg(F.max(F.size("vec"))).first()[0]
    if width is None:
        return spark.createDataFrame([], result)
    width = max(width, 1)
    # |sum of products| <= width * most**2 < 2**62, and the integers fit 32 bits
    space = Space(width, min(isqrt((1 << 62) // width), 2**31 - 1), np.eye(width)[:, :1])
    drawn = rows.orderBy(F.xxhash64("id"), "id", "vec").limit(sample_rows).toArrow()  # bounded
    x = space.integers(drawn.column("vec"), scale)
    space = Space(width, space.most, choose_directions(x, directions))
    sample = {"q": x, "id": _id_array(drawn.column("id")), "label": _id_array(drawn.column("label"))}

    placed = written(placed_rows(rows, space, scale), "negative-placed")
    chunks = written(cut_chunks(placed, space, max(1, chunk_bytes // (4 * width))), "negative-chunks")
    anchors = placed.where(F.col("id") % every == 0)
    anchors = written(number_rows(anchors, ["cell", "angle", "id", "q"], "negative-anchors"), "negative-numbered")
    total = anchors.count()
    size = max(1, wave_bytes // (8 * (width + 4 * n_positives)))
    id_of = anchors.select(F.col("number").alias("anchor"), F.col("id").alias("anchor_id"))

    parts = []
    for start in range(0, total, size):
        table = anchors.where(F.col("number").between(start, start + size - 1)).toArrow()  # at most ``size`` rows
        wave = _wave(table, space, 1)
        wave["open"][:] = True
        found = searched(chunks, space, _seeded(wave, space, sample, True, n_positives), True, n_positives)
        positives = written(nearest(found, n_positives), "negative-positives")
        held = positives.select("anchor", "rank", "score").toArrow()  # at most size * n_positives rows
        wave = _wave(table, space, n_positives)
        at = np.argsort(wave["number"])
        a = at[np.searchsorted(wave["number"][at], held.column("anchor").to_numpy())]
        r, score = held.column("rank").to_numpy() - 1, held.column("score").to_numpy()
        # a negative positive score leaves no score between ratio * score and score
        whole, rest = np.divmod(score, ratio[1])
        wave["asked"][a, r] = whole * ratio[0] - (-rest * ratio[0] // ratio[1])  # ratio * score, rounded up
        wave["ceiling"][a, r], wave["open"][a, r] = score, score >= 0
        found = searched(chunks, space, _seeded(wave, space, sample, False, n_negatives), False, n_negatives)
        negatives = nearest(found, n_negatives).select(
            "anchor", (F.col("range") + 1).alias("positive_rank"), "rank",
            F.col("id").alias("negative_id"), F.col("score").alias("negative_score"),
        )
        negatives = written(negatives, "negative-found")
        chosen = positives.select(
            "anchor", F.col("rank").alias("positive_rank"), F.col("id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        )
        parts.append(chosen.join(negatives, ["anchor", "positive_rank"]))
    if not parts:
        return spark.createDataFrame([], result)
    every_wave = parts[0]
    for part in parts[1:]:
        every_wave = every_wave.unionByName(part)
    return every_wave.join(id_of, "anchor").select(
        "anchor_id", "positive_id", "positive_rank", "rank", "negative_id", "positive_score", "negative_score"
    )
