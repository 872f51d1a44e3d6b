"""Temperature mixing of sources, with DataFrame expressions only.

A source with token share p gets the weight p^a / sum(p^a).  The exponent a
is bisected in [0, 1]: the smallest one (the flattest mix) at which the
entropy stays at or below the target and no source is repeated more than
``max_repeat`` times within the budget.  The target entropy lies
``entropy_lift`` of the way from the sources' own entropy to the uniform one.

The weights are then realised exactly: a source's share of the budget is
filled by whole epochs, each a fresh permutation of its documents, and a last
epoch cut where the budget ends.  Documents stay whole: those longer than the
room left for the last epoch are not in it, so they push no others out, and the
one that crosses the end is taken if that brings the source nearer to its
budget.  A source whose every document is longer than its budget gives the
shortest one, so none is lost; ``realised`` is the share that a source comes to
in the end, beside its ``weight``.  The result is dealt into blocks
of ``block_tokens`` tokens; every block holds each source in its weight and
is permuted in itself.

Positions inside a source are prefix sums.  A source may hold any share of all
rows, so its permutation is cut into buckets by the permutation key: sums per
bucket give the offsets, and only a bucket is ever ordered in one task.

Tokens are words (runs without ASCII white space) plus one end per document.
Defined cases: null and empty texts count one token; a null source is a
source of its own; rows that repeat id, source and text are one unit that is
taken together (``copies``); ties of the permutation key fall to the id and the
text's hash; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelkit.llm.common import WORD, id_text, named, text_hash, written

BISECTIONS = 50


def token_count(text: Column) -> Column:
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)) + 1).cast("bigint")


def units_of(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """id, source, text_hash, copies, tokens: what is permuted and taken as a whole."""
    base = named(docs, id=id_col, text=text_col, source=source_col)
    base = base.select("id", "source", text_hash(F.col("text")).alias("text_hash"), token_count(F.col("text")).alias("tokens"))
    units = base.groupBy("id", "source", "text_hash").agg(F.count("*").alias("copies"), F.sum("tokens").alias("tokens"))
    return written(units, "mix-units")


def source_weights(
    shares: DataFrame, budget_ratio: float = 1.0, entropy_lift: float = 0.5, max_repeat: float = 4.0
) -> DataFrame:
    """source, held (its tokens), exponent, weight, budget from (source, held); one row per source.

    The bisection is one expression over the array of the sources' tokens (a
    row with one number per source), so no value leaves the plan."""
    row = shares.agg(F.sort_array(F.collect_list("held")).alias("held"), F.sum("held").alias("total"))
    row = row.withColumn("n", F.size("held"))
    fold = "aggregate({of}, 0D, (s, x) -> s + {term})"
    z = fold.format(of="held", term="pow(x / total, {a})")
    # entropy of p^a / z is ln z - a / z * sum(p^a ln p)
    own = f"(ln({z}) - {{a}} / {z} * {fold.format(of='held', term='pow(x / total, {a}) * ln(x / total)')})"
    target = f"({own.format(a='1D')} + {entropy_lift} * (ln(n) - {own.format(a='1D')}))"
    # the smallest source is repeated most: its weight times the budget over its tokens
    repeat = f"(pow(held[0] / total, {{a}}) / {z} * total * {budget_ratio} / held[0])"
    row = row.withColumn("target", F.expr(target))
    mid = "((r.lo + r.hi) / 2)"
    fits = f"{own.format(a=mid)} <= target and {repeat.format(a=mid)} <= {max_repeat}"
    bisect = (
        f"aggregate(sequence(1, {BISECTIONS}), named_struct('lo', 0D, 'hi', 1D), (r, i) -> "
        f"if({fits}, named_struct('lo', r.lo, 'hi', {mid}), named_struct('lo', {mid}, 'hi', r.hi))).hi"
    )
    row = row.withColumn("exponent", F.round(F.expr(bisect), 9))
    row = row.withColumn("z", F.expr(z.format(a="exponent")))
    out = shares.join(F.broadcast(row.select("total", "exponent", "z")))  # one row
    weight = F.expr("pow(held / total, exponent) / z")
    return out.select(
        "source",
        "held",
        "exponent",
        F.round(weight, 9).alias("weight"),
        F.round(F.round(weight, 9) * F.col("total") * F.lit(budget_ratio), 0).cast("bigint").alias("budget"),
    )


def _key(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    budget_ratio: float = 1.0,
    entropy_lift: float = 0.5,
    max_repeat: float = 4.0,
    block_tokens: int = 1 << 20,
    spread: int = 64,
    seed: int = 42,
) -> DataFrame:
    """One row per unit and epoch that is taken: id, source, text_hash, copies, tokens, epoch,
    weight, realised, block, block_pos (the place in the permuted block, from 0)."""
    units = units_of(docs, id_col, text_col, source_col)
    shares = units.groupBy("source").agg(
        F.sum("tokens").alias("held"), F.min(F.struct("tokens", "id", "text_hash")).alias("least")
    )
    least = shares.select(F.col("source").alias("of_least"), "least")
    weights = written(source_weights(shares, budget_ratio, entropy_lift, max_repeat), "mix-weights")
    blocks = weights.agg(
        F.greatest(F.ceil(F.sum("budget") / F.lit(block_tokens)), F.lit(1)).alias("blocks")
    )
    plan = weights.join(F.broadcast(blocks)).select(  # one row
        F.col("source").alias("of"),
        "held",
        "weight",
        "budget",
        F.greatest(F.ceil(F.col("budget") / F.col("blocks")), F.lit(1)).alias("quota"),
        # as many buckets as a bucket has documents of ``spread`` tokens: both levels of the sum grow alike
        F.ceil(F.sqrt(F.col("held") / F.lit(spread))).alias("buckets"),
        F.expr("budget div held").alias("full"),
    )
    plan = plan.join(least, F.col("of").eqNullSafe(F.col("of_least"))).drop("of_least")
    plan = plan.withColumn("room", F.expr("budget - full * held"))
    # one row per source; left to the planner, which knows its measured size
    dealt = units.join(plan, units.source.eqNullSafe(plan.of)).drop("of")
    shortest = F.struct("tokens", "id", "text_hash").eqNullSafe(F.col("least"))
    dealt = dealt.withColumn("forced", F.expr("full = 0 and tokens > room") & shortest).drop("least")
    epochs = dealt.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("full"))))
    epochs = epochs.where("epoch < full or tokens <= room or forced")
    # the permutation of an epoch is the order of this key; its first 32 bits give the bucket
    epochs = epochs.withColumn("key", _key(seed, F.col("epoch").cast("string"), id_text(F.col("id"))))
    first = F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint")
    epochs = epochs.withColumn("bucket", F.shiftrightunsigned(first * F.col("buckets"), 32))
    place = ["source", "epoch", "bucket"]
    sums = epochs.groupBy(*place).agg(F.sum("tokens").alias("in_bucket"))
    before = Window.partitionBy("source", "epoch").orderBy("bucket")
    offsets = sums.withColumn("offset", F.sum("in_bucket").over(before) - F.col("in_bucket")).select(
        F.col("source").alias("s2"), F.col("epoch").alias("e2"), F.col("bucket").alias("b2"), "offset"
    )
    order = Window.partitionBy(*place).orderBy("key", "id", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    placed = epochs.withColumn("upto", F.sum("tokens").over(order))
    placed = placed.join(
        offsets,
        placed.source.eqNullSafe(F.col("s2")) & (placed.epoch == F.col("e2")) & (placed.bucket == F.col("b2")),
    )
    end = F.col("epoch") * F.col("held") + F.col("offset") + F.col("upto")
    # nearer to the budget with this document than without: its middle lies within
    taken = placed.withColumn("end", end).where("2 * end - tokens <= 2 * budget or forced")
    taken = taken.withColumn("block", F.expr("(end - tokens) div quota"))
    names = ["id", "source", "text_hash", "copies", "tokens", "epoch", "weight", "block"]
    taken = written(taken.select(*names), "mix-taken")
    sums = taken.groupBy("source").agg(F.sum("tokens").alias("own"))
    whole = sums.agg(F.sum("own").alias("all"))
    realised = sums.join(F.broadcast(whole)).select(  # one row
        F.col("source").alias("of"), (F.col("own") / F.col("all")).alias("realised")
    )
    taken = taken.join(realised, taken.source.eqNullSafe(realised.of)).drop("of")
    shuffled = _key(seed, F.lit("block"), F.col("epoch").cast("string"), id_text(F.col("id")))
    taken = taken.withColumn("in_block", shuffled)
    inside = Window.partitionBy("block").orderBy("in_block", "source", "id", "text_hash")
    return taken.withColumn("block_pos", (F.row_number().over(inside) - 1).cast("bigint")).select(
        "id", "source", "text_hash", "copies", "tokens", "epoch", "weight", "realised", "block", "block_pos"
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: a row comes as often as its epochs say."""
    taken = mix(docs, id_col, text_col, source_col, **options)
    times = taken.groupBy("id", "source", "text_hash").agg(F.count("*").alias("times"))
    right = times.select(*[F.col(c).alias(f"_mix_{c}") for c in times.columns])
    on = (
        F.col(f"`{id_col}`").eqNullSafe(F.col("_mix_id"))
        & F.col(f"`{source_col}`").eqNullSafe(F.col("_mix_source"))
        & (text_hash(F.col(f"`{text_col}`")) == F.col("_mix_text_hash"))
    )
    found = docs.join(written(right, "mix-times"), on)
    found = found.withColumn("_mix_copy", F.explode(F.expr("sequence(1, _mix_times)")))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])
