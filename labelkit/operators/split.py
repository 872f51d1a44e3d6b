"""train/test splits, split guards and class weights.

The default split is a *hash split* on the business key: a row is in train
when ``hash_bucket(key) < train_frac * 10000``.  It is a pure function of the
key, so it needs no shuffle, no cache and no anti-join, and it does not move
when the table is re-read with another partitioning (``sampleBy`` does).
The stratified Bernoulli sample and the anti-join complement are kept as
operators for parity with the original pipeline.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkit.functions.exprs import hash_bucket
from labelkit.session import stored

BUCKETS = 10000


def split_flag(key: str, train_frac: float = 0.8):
    """Boolean column: the row belongs to train."""
    return hash_bucket(key, BUCKETS) < F.lit(int(round(train_frac * BUCKETS)))


def hash_split(df: DataFrame, key: str, train_frac: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """A2 (hash form) — ``(train, test)``; disjoint and complete by construction."""
    flag = split_flag(key, train_frac)
    return df.filter(flag), df.filter(~flag)


def assign_split(
    df: DataFrame, key: str, train_frac: float = 0.8, out: str = "split"
) -> DataFrame:
    """Tag every row ``'train'`` or ``'test'`` in one projection (no filter pair)."""
    return df.withColumn(
        out, F.when(split_flag(key, train_frac), F.lit("train")).otherwise(F.lit("test"))
    )


def anti_join(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """A2 — rows of ``df`` whose key is not in ``other`` (left anti equi-join)."""
    return df.join(other.select(key), key, "left_anti")


def stratified_sample(
    df: DataFrame, label: str = "label", fraction: float = 0.8, seed: int = 42
) -> DataFrame:
    """A1 — per-label Bernoulli sample (labels 0 and 1; others never sampled).

    Row selection depends on partitioning, like the original; prefer
    :func:`hash_split` when the split must be reproducible.
    """
    return df.sampleBy(label, fractions={0: fraction, 1: fraction}, seed=seed)


def stratified_hash_sample(
    df: DataFrame, key: str, label: str = "label", fraction: float = 0.8, seed: int = 42
) -> DataFrame:
    """A1 (hash form) — the same draw whatever the partitioning: a filter on the seeded key."""
    drawn = hash_bucket(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), BUCKETS)
    return df.filter(F.col(label).isin(0, 1) & (drawn < F.lit(int(round(fraction * BUCKETS)))))


def split_counts(
    df: DataFrame, key: str, label: str = "label", train_frac: float = 0.8
) -> DataFrame:
    """A2/A3 — one conditional aggregate: rows and class counts per side."""
    is_train = split_flag(key, train_frac)
    pos = F.col(label) == 1
    neg = F.col(label) == 0
    return df.agg(
        F.count_if(is_train).alias("train_rows"),
        F.count_if(~is_train).alias("test_rows"),
        F.count_if(is_train & neg).alias("train_neg"),
        F.count_if(is_train & pos).alias("train_pos"),
        F.count_if(~is_train & neg).alias("test_neg"),
        F.count_if(~is_train & pos).alias("test_pos"),
    )


@dataclass(frozen=True)
class ClassWeights:
    n0: int
    n1: int

    @property
    def total(self) -> int:
        return self.n0 + self.n1

    @property
    def w0(self) -> float:
        return self.total / (2 * self.n0)

    @property
    def w1(self) -> float:
        return self.total / (2 * self.n1)


def check_split(counts_row) -> ClassWeights:
    """A3 — neither side empty, both classes in train; returns the weights."""
    if counts_row["train_rows"] == 0 or counts_row["test_rows"] == 0:
        raise RuntimeError("one side of the split holds no rows")
    if counts_row["train_neg"] == 0 or counts_row["train_pos"] == 0:
        raise RuntimeError("the training side holds rows of one class only")
    return ClassWeights(int(counts_row["train_neg"]), int(counts_row["train_pos"]))


def class_weight_table(train: DataFrame, label: str = "label") -> DataFrame:
    """G4 — balanced weights ``total / (2 * n_c)`` for labels 0 and 1, as rows."""
    agg = train.agg(
        F.count_if(F.col(label) == 0).alias("n0"),
        F.count_if(F.col(label) == 1).alias("n1"),
    ).withColumn("total", F.col("n0") + F.col("n1"))
    rows = F.array(
        F.struct(
            F.lit(0).alias(label),
            F.col("n0").alias("n"),
            F.try_divide(F.col("total"), F.col("n0") * 2).alias("weight"),
        ),
        F.struct(
            F.lit(1).alias(label),
            F.col("n1").alias("n"),
            F.try_divide(F.col("total"), F.col("n1") * 2).alias("weight"),
        ),
    )
    return agg.select(F.inline(rows))


def add_class_weight(
    df: DataFrame, weights: ClassWeights, label: str = "label", out: str = "weight"
) -> DataFrame:
    """P12 — weight column from train weights (label 0 → w0, anything else → w1)."""
    return df.withColumn(
        out, F.when(F.col(label) == 0, F.lit(weights.w0)).otherwise(F.lit(weights.w1))
    )


def split_with_weights(
    df: DataFrame, key: str, label: str = "label", train_frac: float = 0.8, materialize: bool = False
) -> tuple[DataFrame, DataFrame, ClassWeights]:
    """Split, guard (one bounded aggregate back to the driver) and weight both sides.

    ``materialize`` (S11) writes both sides once, for callers that read them many times."""
    weights = check_split(split_counts(df, key, label, train_frac).first())
    sides = [add_class_weight(side, weights, label) for side in hash_split(df, key, train_frac)]
    if materialize:
        sides = [stored(side, name) for side, name in zip(sides, ("train", "test"))]
    return sides[0], sides[1], weights


def sample_split_with_weights(
    df: DataFrame, label: str = "label", train_frac: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame, ClassWeights]:
    """Parity form of the split: surrogate row id, stratified Bernoulli sample
    for train, left-anti join for test, then guards and weights.

    Row ids and draws depend on the partitioning, so the rows with their ids,
    and then each side, are written once and read from there.
    """
    with_id = stored(df.withColumn("row_id", F.monotonically_increasing_id()), "with-id")
    train = stored(stratified_sample(with_id, label, train_frac, seed), "train")
    test = stored(anti_join(with_id, train, "row_id"), "test")
    counts = {
        r[label]: r["count"] for r in train.groupBy(label).count().collect()
    }  # one row per label value
    weights = check_split(
        {
            "train_rows": sum(counts.values()),
            "test_rows": test.limit(1).count(),
            "train_neg": counts.get(0, 0),
            "train_pos": counts.get(1, 0),
        }
    )
    return add_class_weight(train, weights, label), add_class_weight(test, weights, label), weights
