"""Packing documents into sequences by cutting-stock column generation.

A document's tokens (ids of the given tokenizer, then an end id) are cut into
pieces of at most ``length`` tokens.  What a piece needs of a sequence is its
length alone, so the corpus is summarised by a histogram of piece lengths
(exact up to length / grain tokens, above that rounded up by less than that
part of themselves: a few hundred classes, whatever the number of documents).
On that histogram a linear program chooses how often
to use which pattern of classes; its columns are generated one by one, priced
by a knapsack dynamic program over the dual values.  The pattern counts are
rounded down and the few pieces that are left over are packed largest first.

Patterns then become sequences without looking at pieces: the r-th piece of a
class goes to the r-th place that the patterns hold for that class.  Ranks are
counts inside the partitions of a written table plus offsets per partition
and class, so no class is ever brought together in one task.

Defined cases: a null or empty text has the end id only; repeated rows are
packed once each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelkit.llm.common import named, texts_of, worker_state, written

PIECES = "id {id}, part int, row bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, size int, rank bigint"

MARK = "\x00"  # stands where a text is cut
SPACES = " \n\t\r"
PUNCTUATION = ".,;:!?&*#%()[]{}\"-/"  # no apostrophe: the byte-level pattern takes some letters behind it along
# a-z, digits and Latin letters with marks, upper and lower case, but for the signs in between
LETTERS = frozenset(c for c in map(chr, range(0x180)) if c.isalpha() or c in "0123456789") - frozenset("\xaa\xba")


class ChunkEncoder:
    """Ids of texts, with a bounded memory of the chunks seen before.

    The byte-level pattern never joins characters across the start of a white
    space run, so the chunks between such places can be encoded one by one;
    words come back often, so most chunks are looked up, not encoded.  Several
    texts are cut at once, at spaces, tabs and line ends, and every distinct chunk
    is looked up once for all of them; a text with other white space just before
    such a place is cut by Python's wider rule.  New chunks are encoded in one
    run, as one text, and their ids told apart by the bytes that they stand for;
    the punctuation behind a word has ids of its own, and both are remembered apart.  The memory holds two
    generations of at most ``most_bytes`` each (text and ids): when the younger
    is full it becomes the older, and what is found there comes back."""

    def __init__(self, path: str, most_bytes: int = 32 << 20):
        import re

        import numpy as np
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        size = self.tokenizer.get_vocab_size()
        # one character of a byte-level entry stands for one byte
        self.sizes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)])
        self.young, self.old = {}, {}
        self.held, self.most_bytes = 0, most_bytes
        self.chunks = re.compile(r"\s*\S+|\s+").findall

    def __call__(self, text: str) -> bytes:
        return self.encode([text])[0]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit numbers."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if not texts:
            return []
        marked = pa.array(texts, type=pa.large_string())
        for space in SPACES:
            marked = pc.replace_substring(marked, space, MARK + space)
        for space in SPACES:  # only the start of a run is marked
            marked = pc.replace_substring(marked, space + MARK, space)
        parts = pc.split_pattern(marked, MARK)
        coded = parts.flatten().dictionary_encode()
        index, chunks = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids, joining = self._looked_up(chunks)
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        known, first = np.frombuffer(b"".join(ids), dtype="<u4"), lengths.cumsum() - lengths
        sizes = lengths[index]
        until = np.r_[0, sizes.cumsum()]
        whole = known[np.repeat(first[index] - until[:-1], sizes) + np.arange(until[-1])].tobytes()
        bounds = parts.offsets.to_numpy()
        at = (4 * until[bounds]).tolist()
        out = [whole[a:b] for a, b in zip(at, at[1:])]
        odd = {k for k, text in enumerate(texts) if MARK in text}
        if joining:
            places = np.isin(index, joining).nonzero()[0]
            odd.update((np.searchsorted(bounds, places, side="right") - 1).tolist())
        for k in odd:
            out[k] = b"".join(self._looked_up(self.chunks(texts[k]))[0])
        if self.held > self.most_bytes:
            self.old, self.young, self.held = self.young, {}, 0
        return out

    def _looked_up(self, chunks: list[str]) -> tuple[list[bytes], list[int]]:
        """The ids of each chunk, and which chunks end in white space other than ``SPACES``, which belongs
        to the run behind it; these are not remembered."""
        young, old = self.young, self.old
        ids = list(map(young.get, chunks))
        wanted = [k for k, i in enumerate(ids) if i is None]
        found, missing, ends, joining = {}, {}, [], []
        for k in wanted:
            c = chunks[k]
            known = old.get(c)
            if known is not None:
                found[c] = known
                continue
            word = c.rstrip(PUNCTUATION)
            if word is not c and word[-1:] in LETTERS:
                parts = (word, c[len(word) :])
                ends.append((c, *parts))
                for part in parts:
                    known = young.get(part) or old.get(part)
                    if known is None:
                        missing[part] = None
                    else:
                        found[part] = known
            else:
                missing[c] = None
                if c[-1:].isspace() and c.strip(SPACES):
                    joining.append(k)
        found.update(zip(missing, self._new(list(missing))))
        joined = {c: found[word] + found[end] for c, word, end in ends}  # not remembered: its parts are
        for k in wanted:
            ids[k] = found.get(chunks[k]) or joined.get(chunks[k], b"")
        for k in joining:
            found.pop(chunks[k], None)
        self.held += 100 * len(found) + sum(map(len, found)) + sum(map(len, found.values()))
        young.update(found)
        return ids, joining

    def _new(self, chunks: list[str]) -> list[bytes]:
        """A chunk that starts with white space and ends without can follow another one in a run."""
        import numpy as np

        run = [c for c in chunks if c[:1].isspace() and not c[-1].isspace()]
        known = {}
        for at in range(0, len(run), 250):  # short runs stay in the processor's cache
            part = run[at : at + 250]
            ids = np.array(self._ids(["".join(part)])[0], dtype="<u4")
            ends, cuts = self.sizes[ids].cumsum(), np.cumsum([len(c.encode()) for c in part])
            until = np.searchsorted(ends, cuts) + 1
            if (ends[until - 1] != cuts).any():  # a token crosses the end of a chunk
                known.update(zip(part, [np.array(i, dtype="<u4").tobytes() for i in self._ids(part)]))
                continue
            raw, first = ids.tobytes(), 0
            for c, end in zip(part, (4 * until).tolist()):
                known[c] = raw[first:end]
                first = end
        rest = [c for c in chunks if c not in known]
        known.update(zip(rest, [np.array(i, dtype="<u4").tobytes() for i in self._ids(rest)]))
        return [known[c] for c in chunks]

    def _ids(self, texts: list[str]) -> list[list[int]]:
        # the form without offsets: same ids
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def encoder(path: str) -> ChunkEncoder:
    held = worker_state().setdefault("encoders", {})
    if path not in held:
        held[path] = ChunkEncoder(path)
    return held[path]


def encoded(encode: ChunkEncoder, batch, column: int, run: int = 1 << 20) -> Iterator[bytes]:
    """Ids of a column's texts, encoded together up to ``run`` characters at a time; null is empty.

    A run takes some twenty-five times its characters in arrays and objects, and a worker keeps what it
    once took, so longer runs make every worker of an executor larger."""
    held, size = [], 0
    for text in texts_of(batch, column):
        held.append(text)
        size += len(text)
        if size >= run:
            yield from encode.encode(held)
            held, size = [], 0
    yield from encode.encode(held)


def size_classes(length: int, grain: int):
    """The class of each piece length 0..``length``: the length itself up to length / ``grain``, and
    in steps that double with the length, up to ``grain``, above."""
    import numpy as np

    n, exact = np.arange(length + 1), length // grain
    step, most = np.ones(length + 1, dtype=np.int64), 1
    while most < grain:
        coarser = min(2 * most, grain)
        step[n > exact * most] = coarser
        most = coarser
    return -(-n // step) * step


def cut_pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, length: int, grain: int, end_id: int) -> DataFrame:
    """Pieces of all documents: (part, row) names the document's row, ``size`` the length class and
    ``rank`` counts the pieces of a class within the partition ``part``."""
    base = named(docs, id=id_col, text=text_col)
    schema = PIECES.format(id=base.schema["id"].dataType.simpleString())

    def cut(batches: Iterator) -> Iterator:
        import os
        import zlib

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        encode, end = encoder(tokenizer), int(end_id).to_bytes(4, "little")
        part, row = TaskContext.get().partitionId(), 0
        classes = size_classes(length, grain).tolist()
        seen = [0] * (length + 1)
        for batch in batches:
            found, where = [], []
            for k, ids in enumerate(encoded(encode, batch, 1)):
                ids += end
                tokens = len(ids) // 4
                for start in range(0, tokens, length):
                    piece = ids[4 * start : 4 * (start + length)]
                    n = len(piece) // 4
                    size = classes[n]
                    found.append((part, row, start, n, zlib.crc32(piece), tokens, size, seen[size]))
                    seen[size] += 1
                    where.append(k)
                row += 1
            columns = list(zip(*found)) or [()] * 8
            kinds = (pa.int32(), *[pa.int64()] * 5, pa.int32(), pa.int64())
            ids_of = batch.column(0).take(pa.array(where, type=pa.int64()))
            names = ["id", "part", "row", "start", "length", "ids_crc32", "doc_tokens", "size", "rank"]
            yield pa.RecordBatch.from_arrays([ids_of, *[pa.array(c, type=t) for c, t in zip(columns, kinds)]], names=names)

    return base.mapInArrow(cut, schema)


def price(values, capacity: int):
    """Unbounded knapsack over sizes 1..capacity: (best value within each capacity, the size to take there)."""
    import numpy as np

    best = np.zeros(capacity + 1)
    take = np.zeros(capacity + 1, dtype=np.int64)
    sizes = np.flatnonzero(values)
    worth, upto = values[sizes], np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        fit = sizes[: upto[c]]
        if not len(fit):
            continue
        with_size = worth[: upto[c]] + best[c - fit]
        s = int(with_size.argmax())
        if with_size[s] > best[c - 1]:
            best[c], take[c] = with_size[s], fit[s]
        else:
            best[c] = best[c - 1]
    return best, take


def pattern_of(take, capacity: int, size: int = 0):
    """The multiset behind a knapsack value; with ``size``, the best one that holds this size."""
    import numpy as np

    pattern, c = np.zeros(len(take), dtype=np.int64), capacity
    if size:
        pattern[size], c = 1, capacity - size
    while c > 0:
        if take[c]:
            pattern[take[c]] += 1
            c -= take[c]
        else:
            c -= 1
    return pattern


def greedy_pattern(left, capacity: int):
    """Largest sizes first, as far as there are pieces: a maximal pattern of the pieces in ``left``."""
    import numpy as np

    pattern, room = np.zeros(capacity + 1, dtype=np.int64), capacity
    sizes = np.flatnonzero(left)
    while room > 0:
        fit = sizes[(sizes <= room) & (left[sizes] > pattern[sizes])]
        if not len(fit):
            break
        s = fit[-1]
        n = min(room // s, left[s] - pattern[s])
        pattern[s] += n
        room -= n * s
    return pattern


def first_basis(need, sizes, capacity: int):
    """(columns, inverse) of a basis to start from: patterns filled with the largest sizes first,
    each used until one of its sizes is used up, which names the column's place in the basis."""
    import numpy as np

    m = len(sizes)
    columns = np.diag(np.maximum(capacity // sizes, 1).astype(np.float64))
    inverse = np.diag(1 / np.diag(columns))
    left, open_ = need.copy(), np.ones(m, dtype=bool)
    for _ in range(m):
        pattern, room = np.zeros(m), capacity
        while True:
            fit = np.flatnonzero(open_ & (sizes <= room))
            if not len(fit):
                break
            pattern[fit[-1]] += room // sizes[fit[-1]]
            room %= sizes[fit[-1]]
        held = np.flatnonzero(pattern)
        times = left[held] / pattern[held]
        out = held[times.argmin()]
        left[held] -= times.min() * pattern[held]
        open_[out] = False
        # sizes used up before have no place in this pattern, so the step's pivot is never zero
        direction = inverse @ pattern
        pivot = inverse[out] / direction[out]
        inverse -= np.outer(direction, pivot)
        inverse[out], columns[:, out] = pivot, pattern
    return columns, inverse


def fractional_patterns(need, sizes, capacity: int, tolerance: float, patience: int = 15, rounds: int = 400):
    """Linear program over patterns by column generation: (columns of the basis, how often each).

    The basis starts from patterns packed largest first.  A knapsack over the dual
    values proposes, for every size, the best pattern that holds it; the
    simplex works these columns off (a revised step on the basis inverse),
    then the knapsack is asked again.  Dual values swing widely from step to
    step, so the knapsack is asked at a point between them and the best ones
    known (at first, a piece's share of a sequence): those with the highest
    lower bound on the optimum, need times values over the best column's worth.
    It ends when this bound is within ``tolerance`` of the program's value, or when
    ``patience`` rounds together gained less than a tenth of that, or after
    ``rounds`` rounds; the pieces are packed whole wherever it ends."""
    import numpy as np

    m = len(sizes)
    # a small perturbation keeps the steps from being degenerate; whole counts are restored by the caller
    need = need + np.random.default_rng(42).uniform(0, 0.01, m)
    columns, inverse = first_basis(need, sizes, capacity)
    amount = np.maximum(inverse @ need, 0)
    steps, stale, least = 0, 0, np.inf
    center, bound = sizes / capacity, need @ sizes / capacity
    for _ in range(rounds):
        dual = np.maximum(inverse.sum(axis=0), 0)
        for weight in (0.9, 0.6, 0.0):
            values = np.zeros(capacity + 1)
            values[sizes] = weight * center + (1 - weight) * dual
            best, take = price(values, capacity)
            if best[capacity] > 0 and need @ values[sizes] / best[capacity] > bound:
                center, bound = values[sizes] / best[capacity], need @ values[sizes] / best[capacity]
            worth = values[sizes] + best[capacity - sizes]
            good = sizes[np.argsort(-worth)[: max(16, m // 4)]]
            pool = np.unique([pattern_of(take, capacity, int(s))[sizes] for s in good], axis=0).T.astype(np.float64)
            if (dual @ pool).max() > 1 + tolerance / 2:
                break
        if amount.sum() <= bound * (1 + tolerance):
            break
        for _ in range(2 * pool.shape[1]):
            reduced = inverse.sum(axis=0) @ pool
            enter = pool[:, int(reduced.argmax())]
            if reduced.max() <= 1 + tolerance / 2:
                break
            direction = inverse @ enter
            up = direction > 1e-9
            ratio = np.full(m, np.inf)
            ratio[up] = amount[up] / direction[up]
            out = int(ratio.argmin())
            if not np.isfinite(ratio[out]):
                break
            step = ratio[out]
            amount = np.maximum(amount - step * direction, 0)
            amount[out] = step
            pivot = inverse[out] / direction[out]
            inverse -= np.outer(direction, pivot)
            inverse[out] = pivot
            columns[:, out] = enter
            steps += 1
            if steps % 300 == 0:  # against drift of the updated inverse
                inverse = 2 * inverse - inverse @ columns @ inverse  # Newton's step
                amount = np.maximum(inverse @ need, 0)
        stale = 0 if amount.sum() < least * (1 - tolerance / 10) else stale + 1
        least = min(least, amount.sum())
        if stale > patience:
            break
    return columns, np.nan_to_num(amount)


def solve_patterns(counts, capacity: int, tolerance: float = 2e-3):
    """(pattern, times) pairs that hold exactly ``counts[size]`` pieces of every size 1..capacity:
    the linear program's patterns rounded down, and what is left packed largest first."""
    import numpy as np

    counts = np.asarray(counts, dtype=np.int64)
    sizes = np.flatnonzero(counts)
    if not len(sizes):
        return []
    columns, amount = fractional_patterns(counts[sizes].astype(np.float64), sizes, capacity, tolerance)
    left, chosen = counts.copy(), []
    for j in np.argsort(-amount):
        pattern = np.zeros(capacity + 1, dtype=np.int64)
        pattern[sizes] = np.round(columns[:, j]).astype(np.int64)
        held = pattern > 0
        times = int(min(np.floor(amount[j] + 1e-9), (left[held] // pattern[held]).min()))
        if times > 0:
            chosen.append((pattern, times))
            left -= times * pattern
    while left.any():
        pattern = greedy_pattern(left, capacity)
        held = pattern > 0
        times = int((left[held] // pattern[held]).min())
        chosen.append((pattern, times))
        left -= times * pattern
    return chosen


def place_table(chosen):
    """The places that patterns hold for each size, as arrays sorted by (size, first rank): pattern p
    has ``times`` sequences with ``per`` places of a size each, behind ``before`` places of other sizes.

    Bounded by patterns times sizes in a pattern, whatever the number of documents."""
    import numpy as np

    rows, first_sequence, taken = [], 0, {}
    for pattern, times in chosen:
        before = 0
        for size in pattern.nonzero()[0].tolist():
            per = int(pattern[size])
            first = taken.get(size, 0)
            rows.append((size, first, first_sequence, per, before))
            taken[size] = first + per * times
            before += per
        first_sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5).T


def place_pieces(ranked: DataFrame, places) -> DataFrame:
    """``ranked`` with ``sequence_id`` and ``place``: the piece of a rank goes to the place of that rank."""
    shared = ranked.sparkSession.sparkContext.broadcast(places)

    def compute(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        sizes, first, first_sequence, per, before = shared.value
        for batch in batches:
            size, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("size", "rank"))
            at = np.zeros(len(size), dtype=np.int64)
            for one in np.unique(size):
                a, b = np.searchsorted(sizes, (one, one + 1))
                of = size == one
                at[of] = a + np.searchsorted(first[a:b], rank[of], side="right") - 1
            behind = rank - first[at]
            held = [c for c in batch.schema.names if c not in ("size", "rank")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in held], pa.array(first_sequence[at] + behind // per[at]),
                 pa.array(before[at] + behind % per[at])],
                names=[*held, "sequence_id", "place"],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name not in ("size", "rank")]
    return ranked.mapInArrow(compute, ", ".join([*fields, "sequence_id bigint, place bigint"]))


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 2048,
    grain: int = 16,
    end_id: int = 1,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    sequence_tokens (filled) and padded_to (``length``, or the filled tokens if they are a power of two)."""
    if length % grain:
        raise ValueError("length must be a multiple of grain")
    pieces = written(cut_pieces(docs, id_col, text_col, tokenizer, length, grain, end_id), "pieces")
    held = written(pieces.groupBy("part", "size").agg(F.count("*").alias("n")), "piece-counts")
    counts = [0] * (length + 1)
    for size, n in held.groupBy("size").agg(F.sum("n")).collect():  # one row per class
        counts[size] = n
    earlier = Window.partitionBy("size").orderBy("part")
    offsets = held.select("part", "size", (F.sum("n").over(earlier) - F.col("n")).alias("offset"))
    ranked = pieces.join(offsets, ["part", "size"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("offset")).drop("offset")
    placed = place_pieces(ranked, place_table(solve_patterns(counts, length)))
    inside = Window.partitionBy("sequence_id").orderBy("place")
    running = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    packed = placed.withColumn("offset", running - F.col("length"))
    packed = packed.withColumn("sequence_tokens", F.sum("length").over(Window.partitionBy("sequence_id")))
    power = F.bit_count("sequence_tokens") == 1
    return packed.select(
        "id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens",
        F.when(power, F.col("sequence_tokens")).otherwise(F.lit(length)).cast("bigint").alias("padded_to"),
    )
