"""Document quality by histogram gradient-boosted trees.

A document is described by statistics of its whole text only (never by its
id, language, source or a label): shares of character kinds, word and line
lengths, repetition of words and lines.  The trees are grown on a bounded,
documented sample of labelled documents (``max_fit_rows``, by hash of the id,
so it is the same rows whatever the layout): features are cut into at most
``bins`` quantile bins, and a level of a tree needs one histogram of gradients
per node.  The fitted forest is flattened into arrays (feature, threshold,
left, right, value), and a batch of documents walks all trees with numpy, one
step per level.

Documents are read once for scoring; there is no shuffle of texts.

Defined cases: a null text is the empty text and gets a score like any other;
rows with a null id are scored but teach nothing; labels that are null or for
unknown documents are ignored, repeated labels count once each; without any
label the score is 0.5; with labels of one class it is that class's share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkit.llm.common import hash_mod, named, texts_of

FEATURES = (
    "log_bytes", "log_words", "log_lines", "upper", "lower", "digit", "punct", "space", "newline",
    "high_bytes", "odd_marks", "pipes", "stops", "commas", "quotes", "hash_marks", "percent_amp",
    "byte_entropy", "mean_word", "std_word", "max_word", "long_words", "one_char_words", "word_variety",
    "top_word", "top3_words", "mean_line", "max_line", "line_variety", "dup_line_bytes", "words_ending_odd",
    "alpha_words", "run_share", "capital_words",
)


def features(text: str):
    """The statistics of one text, in the order of FEATURES."""
    import numpy as np

    raw = text.encode("utf-8", "surrogatepass")
    out = np.zeros(len(FEATURES), dtype=np.float32)
    words = raw.split()
    if not words:
        out[0] = np.log1p(len(raw))
        return out
    b = np.frombuffer(raw, dtype=np.uint8)
    n = len(b)
    at = np.bincount(b, minlength=256).astype(np.float64)
    share = lambda chars: at[list(chars)].sum() / n
    p = at[at > 0] / n
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    top = sorted(counts.values(), reverse=True)[:3]
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    distinct = set(lines)
    line_len = np.fromiter(map(len, lines), dtype=np.float64, count=len(lines))
    ends = np.frombuffer(b"".join([w[-1:] for w in words]), dtype=np.uint8)
    starts = np.frombuffer(b"".join([w[:1] for w in words]), dtype=np.uint8)
    m = len(words)
    out[:] = (
        np.log1p(n), np.log1p(m), np.log1p(len(lines)),
        at[65:91].sum() / n, at[97:123].sum() / n, at[48:58].sum() / n,
        (at[33:48].sum() + at[58:65].sum() + at[91:97].sum() + at[123:127].sum()) / n,
        share(b" \t"), share(b"\n\r"), at[128:].sum() / n,
        share(b"#$%&*@^~<>{}[]\\"), share(b"|"), share(b".!?"), share(b",;:"), share(b"\"'`"),
        share(b"#*"), share(b"%&$"),
        -(p * np.log2(p)).sum(), lengths.mean(), lengths.std(), lengths.max(), (lengths > 12).mean(),
        (lengths == 1).mean(), len(counts) / m, top[0] / m, sum(top) / m,
        line_len.mean(), np.log1p(line_len.max()), len(distinct) / len(lines),
        1 - sum(map(len, distinct)) / line_len.sum(),
        np.isin(ends, list(b"#$%&*@|<>{}[]!")).mean(), (starts >= 65).mean(),
        (b[1:] == b[:-1]).mean() if n > 1 else 0.0, ((starts >= 65) & (starts <= 90)).mean(),
    )
    return out


def feature_batch(texts: Iterator[str]):
    import numpy as np

    rows = [features(t) for t in texts]
    return np.vstack(rows) if rows else np.zeros((0, len(FEATURES)), dtype=np.float32)


@dataclass
class Forest:
    """All trees in flat arrays; a leaf points at itself."""

    feature: object
    threshold: object
    left: object
    right: object
    value: object
    roots: object
    depth: int
    prior: float

    def score(self, x):
        """Probability of label 1 per row of ``x``: every row walks every tree, one level a step."""
        import numpy as np

        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                low = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def grow_forest(
    x, y, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, l2: float = 1.0, min_rows: int = 10
) -> Forest:
    """Histogram gradient boosting with logistic loss on features ``x`` and 0/1 labels ``y``."""
    import numpy as np

    flat: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []

    def forest(prior: float) -> Forest:
        kinds = {"feature": np.int64, "left": np.int64, "right": np.int64}
        arrays = {k: np.array(v, dtype=kinds.get(k, np.float64)) for k, v in flat.items()}
        return Forest(**arrays, roots=np.array(roots, dtype=np.int64), depth=depth, prior=prior)

    if not len(y):
        return forest(0.0)
    rate_of = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    prior = float(np.log(rate_of / (1 - rate_of)))
    if y.min() == y.max():
        return forest(prior)
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    valid = np.zeros((width, bins), dtype=bool)
    for j, c in enumerate(cuts):
        valid[j, : len(c)] = True
    cell = binned + np.arange(width) * bins  # a row's place in the histogram, per feature
    margin = np.full(n, prior)

    def new_node(value: float = 0.0) -> int:
        k = len(flat["value"])
        for name, v in (("feature", 0), ("threshold", np.inf), ("left", k), ("right", k), ("value", value)):
            flat[name].append(v)
        return k

    for _ in range(trees):
        prob = 1 / (1 + np.exp(-margin))
        grad, hess = prob - y, np.maximum(prob * (1 - prob), 1e-6)
        root = new_node()
        roots.append(root)
        node = np.full(n, root)
        level = [root]
        for d in range(depth + 1):
            place = {k: i for i, k in enumerate(level)}
            rank = np.full(len(flat["value"]), -1)
            rank[level] = np.arange(len(level))
            of = rank[node]
            here = of >= 0
            size = width * bins
            keys = (cell[here] + of[here, None] * size).ravel()
            shape = (len(level), width, bins)
            hist = lambda w: np.bincount(keys, np.repeat(w, width), len(level) * size).reshape(shape)
            g, h = hist(grad[here]).cumsum(2), hist(hess[here]).cumsum(2)
            count = hist(np.ones(here.sum())).cumsum(2)
            gt, ht, ct = g[:, :1, -1:], h[:, :1, -1:], count[:, :1, -1:]
            for k, i in place.items():
                flat["value"][k] = float(-rate * gt[i, 0, 0] / (ht[i, 0, 0] + l2))
            if d == depth:
                break
            gain = g**2 / (h + l2) + (gt - g) ** 2 / (ht - h + l2) - gt**2 / (ht + l2)
            gain[~(valid[None] & (count >= min_rows) & (ct - count >= min_rows))] = 0
            best = gain.reshape(len(level), -1).argmax(1)
            following = []
            for k, i in place.items():
                j, cut = divmod(int(best[i]), bins)
                if gain[i, j, cut] <= 1e-9:
                    continue
                low, high = new_node(), new_node()
                flat["feature"][k], flat["threshold"][k] = j, float(cuts[j][cut])
                flat["left"][k], flat["right"][k] = low, high
                rows = np.flatnonzero(node == k)
                node[rows] = np.where(binned[rows, j] <= cut, low, high)
                following += [low, high]
            level = following
            if not level:
                break
        margin += np.array(flat["value"])[node]
    return forest(prior)


def held_out(id_col: Column, modulus: int = 4, remainder: int = 2) -> Column:
    return F.coalesce(hash_mod(id_col, modulus) == remainder, F.lit(False))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_fit_rows: int = 20_000,
    **growth,
) -> Forest:
    """Trees for ``label_col`` from at most ``max_fit_rows`` labelled rows outside the held-out fold."""
    import numpy as np

    taught = named(labels, id=id_col, label=label_col).where("id is not null and label in (0, 1)")
    taught = taught.where(~held_out(F.col("id")))
    taught = taught.orderBy(F.xxhash64("id"), "id", "label").limit(max_fit_rows)
    texts = named(docs, id=id_col, text=text_col)
    # the labels are bounded by max_fit_rows
    found = texts.join(F.broadcast(taught), "id").select("id", "label", "text")

    def compute(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x = feature_batch(texts_of(batch, 2)).astype(np.float32)
            packed = pa.array([r.tobytes() for r in x], type=pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), batch.column(1).cast(pa.int32()), packed], names=["id", "label", "x"]
            )

    rows = found.mapInArrow(compute, "id string, label int, x binary")
    # a repeated document would bring its label again; the bound holds for the rows that come back too
    rows = rows.groupBy("id", "label", "x").count().orderBy("id", "label", "x").limit(max_fit_rows).collect()
    x = np.array([np.frombuffer(r.x, dtype=np.float32) for r in rows]).reshape(-1, len(FEATURES)).astype(np.float64)
    y = np.array([r.label for r in rows], dtype=np.float64)
    return grow_forest(x, y, **growth)


def quality_score(forest: Forest, text: Column) -> Column:
    """Score column for a text column (whole texts; null is empty)."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        import numpy as np

        out = np.empty(len(texts))
        for at in range(0, len(texts), 512):
            part = texts.iloc[at : at + 512]
            x = feature_batch(t if isinstance(t, str) else "" for t in part).astype(np.float64)
            out[at : at + len(part)] = forest.score(x)
        return pd.Series(out)

    return score(F.coalesce(text, F.lit("")))


def score_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7, **options
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted (1 from ``threshold`` on)."""
    forest = fit_quality(docs, labels, id_col, text_col, **options)
    base = named(docs, id=id_col, text=text_col)
    scored = base.select("id", held_out(F.col("id")).alias("held_out"), quality_score(forest, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7, **options
) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with the columns of ``docs`` (a filter, no join)."""
    forest = fit_quality(docs, labels, id_col, text_col, **options)
    return docs.where(quality_score(forest, F.col(f"`{text_col}`")) >= threshold)
