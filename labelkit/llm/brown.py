"""Language-model scores from Brown class-based bigrams.

    P(text) = prod P(class_i | class_i-1) * P(word_i | class_i)

Exchange clustering moves the ``clustered`` most frequent words between
``classes`` classes as long as the likelihood of the corpus' class bigrams
grows.  These are the seed.  Every further word that comes back is then put
into the class that explains its seed neighbours best, over all training
texts.  Words seen once or never form one more class: they are what the model
learns about words not seen at all.  Transitions and emissions are smoothed
counts over all training documents.

What is counted grows with the corpus and stays on the cluster: words, the
neighbours of every word and the class of every word are Spark tables, made by
map-side summaries and shuffles.  The ``frequent`` most frequent words are
looked up from a broadcast and all others by a join; this decides only how a
word is looked up, so scores do not depend on it.  A word's class is keyed by
the word's 64-bit hash (words of one hash would share a class); its counts are
looked up by the word itself.  Words of over 256 bytes are never seeds and are
always joined.

Words are runs without ASCII white space, A-Z lower-cased; a text ends with
one end token.  Defined cases: a null text is empty (an end token only); rows
with a null id are scored and not learned from; repeated rows get one row each
and count each; with no training document all counts are zero and every
probability comes from the smoothing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelkit.llm.common import hash_mod, named, texts_of, written

END = b"\n"  # no word holds white space


def tokens(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def count_words(texts: DataFrame, most_held: int = 100_000) -> DataFrame:
    """word (binary), c: how often each token occurs in ``texts`` (text), end tokens included."""

    def compute(batches: Iterator) -> Iterator:
        from collections import Counter

        import pyarrow as pa

        def rows(held: Counter):
            return pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "n"]
            )

        held: Counter = Counter()
        for batch in batches:
            for text in texts_of(batch, 0):
                held.update(tokens(text))
                held[END] += 1
                if len(held) > most_held:
                    yield rows(held)
                    held = Counter()
        yield rows(held)

    counted = texts.mapInArrow(compute, "word binary, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("c"))


LONG = 256  # bytes of a word beyond which it is never sent to the driver


def laid_out(texts: Iterator[str], most: int = 1 << 20) -> Iterator[tuple[list, object]]:
    """Texts as token lists, about ``most`` characters at a time: (tokens, bounds).  A text lies in
    bounds[i]:bounds[i + 1] and has an end token on either side."""
    import numpy as np

    flat, bounds, size = [], [0], 0
    for text in texts:
        flat.append(END)
        flat += tokens(text)
        flat.append(END)
        bounds.append(len(flat))
        size += len(text)
        if size >= most:
            yield flat, np.array(bounds)
            flat, bounds, size = [], [0], 0
    if flat:
        yield flat, np.array(bounds)


def inner_pairs(bounds):
    """Whether token i and i + 1 are of one text."""
    import numpy as np

    inside = np.ones(bounds[-1] - 1, dtype=bool)
    inside[bounds[1:-1] - 1] = False
    return inside


def hashes_of(words: list[bytes]):
    """The words' ``xxhash64`` as Spark has it."""
    import numpy as np
    from xxhash import xxh64_intdigest

    return np.fromiter((xxh64_intdigest(w, 42) for w in words), dtype=np.uint64, count=len(words)).view(np.int64)


def places_of(index: dict, flat: list[bytes]):
    """What ``index`` has for every token, -1 where its word is not held."""
    from itertools import repeat

    import numpy as np

    return np.fromiter(map(index.get, flat, repeat(-1)), dtype=np.int64, count=len(flat))


def numbered(flat: list[bytes]):
    """(distinct words, their hashes, number of each token's word)."""
    import numpy as np

    words = list(dict.fromkeys(flat))
    number = dict(zip(words, range(len(words))))
    return words, hashes_of(words), np.fromiter(map(number.__getitem__, flat), dtype=np.int64, count=len(flat))


@dataclass
class Vocabulary:
    """Totals over all words, and the count from which words are looked up from a broadcast."""

    total: int
    distinct: int
    once: int  # words seen once, without the end token
    ends: int  # how often the end token was seen
    threshold: int


def totals(vocabulary: DataFrame, most: int) -> Vocabulary:
    """The threshold leaves at most ``most`` words, and none that was seen once."""
    step = F.floor(F.log2("c") * 16)
    end = F.col("word") == F.lit(bytearray(END))
    levels = vocabulary.groupBy(step.alias("level")).agg(
        F.count("*").alias("words"),
        F.min("c").alias("least"),
        F.sum("c").alias("total"),
        F.count(F.when((F.col("c") == 1) & ~end, 1)).alias("once"),
        F.sum(F.when(end, F.col("c")).otherwise(0)).alias("ends"),
    )
    rows = sorted(levels.collect(), key=lambda r: -r.level)  # at most 16 * 63 levels
    held, threshold, fits = 0, 1 << 62, True
    for r in rows:
        fits = fits and held + r.words <= most and r.least > 1
        if fits:
            held, threshold = held + r.words, r.least
    return Vocabulary(*(sum(r[k] for r in rows) for k in ("total", "words", "once", "ends")), threshold)


def count_bigrams(texts: DataFrame, kinds: dict, size: int):
    """Matrix of bigrams of kinds over all training texts; words without a kind are ``size`` - 1."""
    import numpy as np

    shared = texts.sparkSession.sparkContext.broadcast(kinds)

    def compute(batches: Iterator) -> Iterator:
        from itertools import repeat

        import numpy as np
        import pyarrow as pa

        get, counts = shared.value.get, np.zeros(size * size, dtype=np.int64)
        for batch in batches:
            for flat, bounds in laid_out(texts_of(batch, 0)):
                kind = np.fromiter(map(get, flat, repeat(size - 1)), dtype=np.int64, count=len(flat))
                cell = (kind[:-1] * size + kind[1:])[inner_pairs(bounds)]
                counts += np.bincount(cell, minlength=size * size)
        cell = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(counts[cell])], names=["cell", "n"])

    cells = texts.mapInArrow(compute, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size, dtype=np.float64)
    out[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    return out.reshape(size, size)


def exchange(bigrams, movable: int, classes: int, sweeps: int = 6):
    """Class of every symbol.  The first ``movable`` symbols are exchanged between ``classes``
    classes, best move first found for each in turn; every other symbol is a class of its own."""
    import numpy as np

    size = len(bigrams)
    classes = max(1, min(classes, movable))
    fixed = size - movable
    of = np.concatenate([np.arange(movable) % classes, classes + np.arange(fixed)]).astype(np.int64)
    many = classes + fixed

    def phi(x):
        return x * np.log(np.maximum(x, 1))

    def by_class(values):
        return np.bincount(of, values, minlength=many)

    joint = np.zeros((many, many))
    np.add.at(joint, (of[:, None], of[None, :]), bigrams)
    for _ in range(sweeps):
        moved = 0
        for w in range(movable):
            a, twice = of[w], bigrams[w, w]
            of[w] = -1  # out of its class while it is compared
            rest = of >= 0
            out = np.bincount(of[rest], bigrams[w][rest], minlength=many)
            into = np.bincount(of[rest], bigrams[:, w][rest], minlength=many)
            joint[a] -= out
            joint[:, a] -= into
            joint[a, a] -= twice
            # gain of putting w into each class b: changed cells of row b and column b, less the margins
            rows, cols = joint[:classes], joint[:, :classes].T
            diag = np.arange(classes)
            gain = (phi(rows + out) - phi(rows)).sum(1) + (phi(cols + into) - phi(cols)).sum(1)
            own = joint[diag, diag]
            gain -= phi(own + out[:classes]) - phi(own) + phi(own + into[:classes]) - phi(own)
            gain += phi(own + out[:classes] + into[:classes] + twice) - phi(own)
            row_sum, col_sum = rows.sum(1), cols.sum(1)
            gain -= phi(row_sum + out.sum() + into[:classes] + twice) - phi(row_sum)
            gain -= phi(col_sum + into.sum() + out[:classes] + twice) - phi(col_sum)
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            moved += b != a
            of[w] = b
            joint[b] += out
            joint[:, b] += into
            joint[b, b] += twice
        if not moved:
            break
    return of


def gather_contexts(
    texts: DataFrame, kinds: dict, many: int, most_held: int = 250_000, most_pending: int = 2_500_000
) -> DataFrame:
    """h, cell, n: which kinds stand beside each word without a kind, over all training texts.

    They are summed up over a bounded run of texts: a word and cell come once a run.
    A cell is side * ``many`` + kind of the neighbour; side 0 is what follows, 1 what comes
    before.  Neighbours without a kind (``many`` - 1) are left out: their number follows from
    the word's count."""
    shared = texts.sparkSession.sparkContext.broadcast(kinds)

    def compute(batches: Iterator) -> Iterator:
        from itertools import repeat

        import numpy as np
        import pyarrow as pa

        kinds, other = shared.value, many - 1
        number, words, held, pending = dict(kinds), [], [], 0  # a kind, or from ``many`` on a word without one

        def rows():
            keys = np.concatenate(held)
            keys.sort()
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            n, keys = np.diff(np.r_[first, len(keys)]), keys[first]
            hashes = hashes_of(words)
            return pa.RecordBatch.from_arrays(
                [pa.array(hashes[keys // (2 * many)]), pa.array((keys % (2 * many)).astype(np.int32)), pa.array(n)],
                names=["h", "cell", "n"],
            )

        for batch in batches:
            for flat, _ in laid_out(texts_of(batch, 0)):
                of = np.fromiter(map(number.get, flat, repeat(-1)), dtype=np.int64, count=len(flat))
                new = np.flatnonzero(of < 0)
                found = [flat[i] for i in new.tolist()]
                distinct = list(dict.fromkeys(found))
                number.update(zip(distinct, range(many + len(words), 1 << 62)))
                words += distinct
                of[new] = np.fromiter(map(number.__getitem__, found), dtype=np.int64, count=len(found))
                at = np.flatnonzero(of >= many)  # never the first or last of a text
                own, kind = of[at] - many, np.where(of < many, of, other)
                for side, beside in enumerate((kind[at + 1], kind[at - 1])):
                    known = beside != other
                    held.append((own[known] * 2 + side) * many + beside[known])
                    pending += len(held[-1])
                if len(words) > most_held or pending > most_pending:
                    yield rows()
                    number, words, held, pending = dict(kinds), [], [], 0
        if pending:
            yield rows()

    return texts.mapInArrow(compute, "h bigint, cell int, n bigint")


def place_words(words: DataFrame, contexts: DataFrame, joint, classes: int) -> DataFrame:
    """h, class, c, words: the class below ``classes`` under which the neighbours of the words are likeliest.

    ``words`` (h, c): those to be placed; ``joint``: bigrams of the seed's classes, the end and other words.
    A word's rows are brought together by one shuffle and sort, its count among them as two further cells;
    they are added up as they pass, so that nothing is held but the sums of a batch's words."""
    import numpy as np

    many = len(joint)
    smooth = joint + 0.1
    after = np.log(smooth / smooth.sum(1, keepdims=True))[:classes]
    before = np.log(smooth / smooth.sum(0, keepdims=True))[:, :classes]
    shared = words.sparkSession.sparkContext.broadcast(np.concatenate([after.T, before]))  # by side and neighbour
    count, members = 2 * many, 2 * many + 1

    def choose(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def rows(h, sums):
            wanted = sums[:, members] > 0  # the others are seen once
            h, sums = h[wanted], sums[wanted]
            profile, c = sums[:, :count], sums[:, count]
            for side in (0, many):
                profile[:, side + many - 1] = c - profile[:, side : side + many - 1].sum(1)
            best = (profile @ shared.value).argmax(1)
            columns = (best.astype(np.int32), c.astype(np.int64), sums[:, members].astype(np.int64))
            return pa.RecordBatch.from_arrays([pa.array(h), *map(pa.array, columns)], names=["h", "class", "c", "words"])

        last, held = None, None  # the last word, whose rows may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            h, cell, n = (batch.column(k).to_numpy() for k in ("h", "cell", "n"))
            first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            place = np.repeat(np.arange(len(first)) * (members + 1), np.diff(np.r_[first, len(h)]))
            sums = np.bincount(place + cell, n, len(first) * (members + 1)).reshape(len(first), -1)
            h = h[first]
            if last is not None and last[0] == h[0]:
                sums[0] += held[0]
            elif last is not None:
                yield rows(last, held)
            yield rows(h[:-1], sums[:-1])
            last, held = h[-1:].copy(), sums[-1:].copy()
        if last is not None:
            yield rows(last, held)

    own = F.array(
        F.struct(F.lit(count).alias("cell"), F.col("c").alias("n")),
        F.struct(F.lit(members).alias("cell"), F.lit(1).cast("bigint").alias("n")),
    )
    cells = contexts.unionByName(words.select("h", F.inline(own)))
    cells = cells.repartition("h").sortWithinPartitions("h")
    return cells.mapInArrow(choose, "h bigint, class int, c bigint, words bigint")


def count_transitions(texts: DataFrame, shared, classes: DataFrame, many: int, rare: int):
    """Matrix of class bigrams over all training texts.

    ``shared``: (place of each held word, class by place); the class of any other word is joined from ``classes``."""
    import numpy as np

    def compute(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        index, class_of = shared.value
        index = dict(zip(index, class_of.tolist()))
        known = np.zeros(many * many, dtype=np.int64)

        def rows(side, a, b, n):
            columns = [pa.array(np.full(len(a), side, dtype=np.int32)), *(pa.array(x.astype(np.int64)) for x in (a, b, n))]
            return pa.RecordBatch.from_arrays(columns, names=["side", "a", "b", "n"])

        for batch in batches:
            for flat, bounds in laid_out(texts_of(batch, 0)):
                own = places_of(index, flat)
                lone = np.flatnonzero(own < 0)
                _, hashes, number_of = numbered([flat[i] for i in lone.tolist()])
                number = np.zeros(len(flat), dtype=np.int64)  # of the words without a place
                number[lone] = number_of
                inside = np.flatnonzero(inner_pairs(bounds))
                left, right = number[inside], number[inside + 1]
                cl, cr = own[inside], own[inside + 1]
                both = (cl >= 0) & (cr >= 0)
                known += np.bincount(cl[both] * many + cr[both], minlength=many * many)
                for side, at in enumerate(((cl < 0) & (cr >= 0), (cl >= 0) & (cr < 0))):
                    word, beside = ((left, cr), (right, cl))[side]
                    key, n = np.unique(word[at] * many + beside[at], return_counts=True)
                    if len(key):
                        yield rows(side, hashes[key // many], key % many, n)
                at = (cl < 0) & (cr < 0)
                if at.any():
                    yield rows(2, hashes[left[at]], hashes[right[at]], np.ones(at.sum()))
        cell = np.flatnonzero(known)
        yield rows(3, cell // many, cell % many, known[cell])

    def classed(df: DataFrame, column: str) -> DataFrame:
        of = classes.select(F.col("h").alias(column), "class")
        return df.join(of, column, "left").withColumn(column, F.coalesce("class", F.lit(rare)).cast("bigint")).drop("class")

    pairs = written(texts.mapInArrow(compute, "side int, a bigint, b bigint, n bigint"), "transitions")
    n = F.sum("n").alias("n")
    # the words are seldom, so that adding up before the join would shuffle about as many rows once more
    one = classed(pairs.where("side < 2"), "a").groupBy("side", "a", "b").agg(n)
    two = classed(pairs.where("side = 2"), "a").groupBy("a", "b").agg(n)
    cells = pairs.where("side = 3").select("a", "b", "n")
    cells = cells.unionByName(one.selectExpr("if(side = 0, a, b) as a", "if(side = 0, b, a) as b", "n"))
    cells = cells.unionByName(classed(two, "b").select("a", "b", "n")).groupBy("a", "b").agg(n).toArrow()  # many squared
    out = np.zeros((many, many))
    out[cells.column("a").to_numpy(), cells.column("b").to_numpy()] = cells.column("n").to_numpy()
    return out


@dataclass
class BrownModel:
    index: dict  # place of each word that is looked up from the broadcast
    counts: object  # by place
    symbol: object  # class by place
    classes: DataFrame  # h, class: of all words that come back, but for the seed
    end: int
    rare: int
    log_next: object  # by class of the previous and the next token, log10 of the class transition
    norms: object  # by class, log10 of the emissions' denominator
    base_norm: float  # log10 of the unigram denominator
    total: int
    threshold: int
    sent: object  # the broadcast of (index, symbol)

    @property
    def rare_norm(self) -> float:
        return float(self.norms[self.rare])


def _joint_by_class(bigrams, of):
    import numpy as np

    many = int(of.max()) + 1
    joint = np.zeros((many, many))
    np.add.at(joint, (of[:, None], of[None, :]), bigrams)
    return joint


def fit_brown(
    texts: DataFrame, vocabulary: DataFrame, frequent: int, clustered: int, classes: int, prior: float = 5.0, add: float = 0.5
) -> BrownModel:
    """``vocabulary``: the written table of :func:`count_words` over ``texts``."""
    import numpy as np

    spark = texts.sparkSession
    words = totals(vocabulary, frequent)
    often = vocabulary.where((F.col("c") > 1) & (F.col("word") != F.lit(bytearray(END))))
    short = F.octet_length("word") <= LONG
    seeds = often.where(short).orderBy(F.desc("c"), "word").limit(clustered).toArrow()
    seed_words, seed_counts = seeds.column("word").to_pylist(), seeds.column("c").to_numpy()
    n = len(seed_words)
    bigrams = count_bigrams(texts, {**dict(zip(seed_words, range(n))), END: n}, n + 2)
    of = exchange(bigrams, n, classes)
    end, rare = int(of[n]), int(of[n + 1])
    many = rare + 1

    # all other words that come back, by their seed neighbours
    kinds = {**dict(zip(seed_words, of[:n].tolist())), END: end}
    seed_joint = _joint_by_class(bigrams, of)
    seed_rows = spark.createDataFrame([(bytearray(w),) for w in seed_words], "word binary")
    others = often.join(F.broadcast(seed_rows), "word", "left_anti").select(F.xxhash64("word").alias("h"), "c")
    placed = place_words(others, gather_contexts(texts, kinds, many), seed_joint, max(1, min(classes, n)))
    placed = written(placed, "classes")

    # the most frequent are looked up from a broadcast: bounded in number and in length
    top = often.where(short & (F.col("c") >= words.threshold)).join(F.broadcast(seed_rows), "word", "left_anti")
    top = top.withColumn("h", F.xxhash64("word")).join(placed.select("h", "class"), "h").toArrow()
    top = top.sort_by([("c", "descending")])  # words that come often lie together in memory
    held = [END, *seed_words, *top.column("word").to_pylist()]
    counts = np.concatenate([[words.ends], seed_counts, top.column("c").to_numpy()]).astype(np.int64)
    symbol = np.concatenate([[end], of[:n], top.column("class").to_numpy()]).astype(np.int64)
    index = dict(zip(held, range(len(held))))
    sent = spark.sparkContext.broadcast((index, symbol))
    joint = count_transitions(texts, sent, placed, many, rare)

    # a transition is pulled towards the class' own frequency, which is never zero
    alone = (joint.sum(0) + 1) / (joint.sum() + many)
    chance = (joint + prior * alone) / (joint.sum(1, keepdims=True) + prior)
    mass, members = np.bincount(of[:n], seed_counts, minlength=many), np.bincount(of[:n], minlength=many)
    for r in placed.groupBy("class").agg(F.sum("c").alias("c"), F.sum("words").alias("words")).collect():
        mass[r["class"]] += r.c
        members[r["class"]] += r.words
    mass[rare], members[rare] = words.once, words.once + 1  # and one place for unseen words
    return BrownModel(
        index=index,
        counts=counts,
        symbol=symbol,
        classes=placed.select("h", "class"),
        end=end,
        rare=rare,
        log_next=np.log10(chance),
        norms=np.log10(np.maximum(mass + add * members, add)),
        base_norm=float(np.log10(words.total + 0.5 * (words.distinct + 1))),
        total=words.total,
        threshold=words.threshold,
        sent=sent,
    )


GAP = "struct<word:binary,left:int,right:int>"
SCORED = "id {id}, row bigint, n_tokens bigint, n_known bigint, base_score double, score double, gaps array<" + GAP + ">"


def score_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    modulus: int = 5,
    remainder: int = 1,
    frequent: int = 300_000,
    clustered: int = 800,
    classes: int = 48,
    add: float = 0.5,
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score,
    score (log10 probabilities of the text) and perplexity (per token, of the class model)."""
    base = named(docs, id=id_col, text=text_col)
    out_of = F.coalesce(hash_mod(F.col("id"), modulus) == remainder, F.lit(False))
    texts = base.where(~out_of & F.col("id").isNotNull()).select("text")
    vocabulary = written(count_words(texts), "vocabulary")
    model = fit_brown(texts, vocabulary, frequent, clustered, classes, add=add)
    sent, counts, log_next, norms = model.sent, model.counts, model.log_next, model.norms
    base_norm, rare = model.base_norm, model.rare

    def compute(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        index, class_of = sent.value
        log_base = np.r_[np.log10(counts + 0.5), 0.0]
        log_emit = np.r_[np.log10(counts + add) - norms[class_of], 0.0]
        log_emit[0] = 0.0  # the end token's emission is certain
        class_of, seen = np.r_[class_of, -1], np.r_[counts > 0, False]
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            columns, gaps, many = [[] for _ in range(4)], [[] for _ in range(3)], []
            for flat, bounds in laid_out(texts_of(batch, 1)):
                at = places_of(index, flat)
                of = class_of[at]
                inside = inner_pairs(bounds)
                step = np.zeros(len(flat))  # of the transition to each token
                both = np.flatnonzero(inside & (of[:-1] >= 0) & (of[1:] >= 0))
                step[both + 1] = log_next[of[both], of[both + 1]]
                first = bounds[:-1]
                emit, known, unigram = log_emit[at], seen[at].astype(np.int64), log_base[at]
                known[first], unigram[first] = 0, 0.0  # the end token before a text is none of its tokens
                sizes = np.diff(bounds) - 1
                sums = [np.add.reduceat(x, first) for x in (known, unigram, step + emit)]
                for column, values in zip(columns, (sizes, sums[0], sums[1] - sizes * base_norm, sums[2])):
                    column.append(values)
                gap = np.flatnonzero(of < 0)
                many.append(np.diff(np.searchsorted(gap, bounds)))
                gaps[0] += [flat[i] for i in gap.tolist()]
                gaps[1].append(of[gap - 1].astype(np.int32))
                gaps[2].append(of[gap + 1].astype(np.int32))
            if not columns[0]:
                continue
            held = pa.StructArray.from_arrays(
                [pa.array(gaps[0], pa.binary()), *(pa.array(np.concatenate(g)) for g in gaps[1:])], names=["word", "left", "right"]
            )
            offsets = np.cumsum(np.r_[0, np.concatenate(many)]).astype(np.int32)
            rows, row = pa.array(np.arange(row, row + batch.num_rows)), row + batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), rows, *(pa.array(np.concatenate(c)) for c in columns), pa.ListArray.from_arrays(offsets, held)],
                names=["id", "row", "n_tokens", "n_known", "base_score", "score", "gaps"],
            )

    schema = SCORED.format(id=base.schema["id"].dataType.simpleString())
    scored = written(base.mapInArrow(compute, schema), "scored")
    sent.destroy()  # the scores are written

    # words outside the broadcast: their counts and classes come by shuffles on the word
    seldom = vocabulary.where((F.col("c") < model.threshold) | (F.octet_length("word") > LONG))
    again = seldom.where("c > 1").withColumn("h", F.xxhash64("word")).join(model.classes, "h", "left").select("word", "c", "class")
    seldom = again.unionByName(seldom.where("c = 1").select("word", "c", F.lit(None).cast("int").alias("class")))
    gaps = scored.where("size(gaps) > 0").select("row", F.posexplode("gaps").alias("at", "g")).select("row", "at", "g.*")
    gaps = gaps.join(seldom, "word", "left")
    gaps = gaps.select("row", "at", "left", "right", F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("class", F.lit(rare)).alias("class"))
    after = F.lead("class").over(Window.partitionBy("row").orderBy("at"))  # of one document's words
    gaps = gaps.withColumn("right", F.when(F.col("right") < 0, after).otherwise(F.col("right")))

    def add_up(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            left, right, c, own = (batch.column(k).to_numpy() for k in ("left", "right", "c", "class"))
            score = np.log10(c + add) - norms[own] + log_next[own, right]
            score += np.where(left >= 0, log_next[left, own], 0.0)  # else it is counted from the left
            values = [(c > 0).astype(np.int64), np.log10(c + 0.5), score]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *map(pa.array, values)], names=["row", "known", "base", "more"])

    sums = gaps.mapInArrow(add_up, "row bigint, known bigint, base double, more double").groupBy("row")
    sums = sums.agg(F.sum("known").alias("known"), F.sum("base").alias("base"), F.sum("more").alias("more"))
    zero = F.lit(0.0)
    full = scored.drop("gaps").join(sums, "row", "left")
    full = full.withColumn("score", F.col("score") + F.coalesce("more", zero))
    return full.select(
        "id",
        F.coalesce(hash_mod(F.col("id"), modulus) == remainder, F.lit(False)).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("base", zero)).alias("base_score"),
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
