"""Aligning the tokens of two tokenizers by galloping intersection of their ends.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (pieces
with byte fallback) the text, which it starts with a space of its own.  Both
give the byte offsets where their tokens end.  The offsets that both lists
hold cut the text into groups: the shorter list drives, and each of its ends is
sought in the longer one by exponential steps from the last place found and a
binary search inside the last step (:func:`common_ends`).  A group's tokens are
those between two common ends in either list, so differences of ranks give the
overlapping ranges; every A token of a group is linked with every B token of it.

Texts are cut into chunks that both tokenizers treat on their own: before a
space that follows no white space.  A chunk's end is a token's end on both
sides, so chunks are aligned apart from their texts (many new ones in one run)
and those that come back are looked up.

How many documents hold an id pair linked is counted over the whole corpus.
The first pass writes every document's distinct pairs and how often it holds
them; the counts are one aggregation of that table.  The ``frequent`` commonest
pairs (a documented bound) are sent to the second pass as two sorted arrays;
whatever else a document holds is joined with the table of counts by shuffle.
All pairs count, whichever way they are looked up.

Defined cases: null and empty texts, and texts whose tokens' bytes on either
side are not the space and the text, have no tokens: zeros and an empty
``groups_sha256``; repeated rows are documents of their own; strings of special
tokens are ordinary text; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkit.llm.common import named, worker_state, written

#: A chunk starts with a space that follows no white space.
CHUNK = r" \s*\S*(?:[^\S ]\s*\S*)*"
#: Links of a chunk that are kept one by one; of more, distinct pairs with their numbers are kept.
MANY_LINKS = 10_000


def common_ends(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """(rank in a, rank in b) of the values that both sorted lists hold."""
    from bisect import bisect_left

    short, long = (a, b) if len(a) <= len(b) else (b, a)
    found, low, most = [], 0, len(long)
    for i, end in enumerate(short):
        step, high = 1, low
        while high < most and long[high] < end:  # gallop
            low = high + 1
            high += step
            step *= 2
        low = bisect_left(long, end, low, min(high + 1, most))
        if low == most:
            break
        if long[low] == end:
            found.append((i, low) if short is a else (low, i))
            low += 1
    return found


class ByteTokens:
    """A byte-level BPE of the ``tokenizers`` library: ids and their bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        size = self.tokenizer.get_vocab_size()
        # byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        moved = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}
        entries = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.bytes = [bytes(byte_of[c] for c in e) if all(c in byte_of for c in e) else e.encode() for e in entries]

    def ids(self, text: str) -> list[int]:
        """Of a text that starts with its space; the form without offsets gives the same ids."""
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids


class PieceTokens:
    """A sentencepiece model with byte fallback: ids and their bytes."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        kinds = range(self.model.get_piece_size())
        pieces = [self.model.id_to_piece(i) for i in kinds]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.space = self.model.piece_to_id("▁")

    def ids(self, text: str) -> list[int]:
        """Of a text that starts with a space, which the model puts there itself."""
        return self.model.encode(text[1:]) if len(text) > 1 else [self.space]


class Aligner:
    """Aligned chunks of texts, with a bounded memory of chunks seen before.

    A chunk's record: numbers of A and B tokens, groups and links, its group
    text, and the id pairs (``a * size_b + b``, 8 bytes each) with their numbers
    (None: each pair once for every time that it stands there).  The memory
    holds two generations of at most ``most`` chunks or ``most_bytes`` of their
    text: when the younger is full it becomes the older, and what is found there
    only comes back to the younger."""

    def __init__(self, byte_path: str, piece_path: str, most: int = 250_000, most_bytes: int = 16 << 20):
        import numpy as np

        self.a, self.b = ByteTokens(byte_path), PieceTokens(piece_path)
        if any(re.search(rb"[^ ] ", p) for p in self.b.bytes):
            raise ValueError("pieces with a space after another character: chunks would not stand apart")
        self.size_b = len(self.b.bytes)
        self.sizes = [np.array([len(x) for x in side.bytes]) for side in (self.a, self.b)]
        self.names = [list(map(str, range(len(side.bytes)))) for side in (self.a, self.b)]
        self.cut, self.joined = re.compile(CHUNK).findall, re.compile(r"\s ").search
        self.young, self.old = {}, {}
        self.most, self.most_bytes, self.held = most, most_bytes, 0

    def chunks(self, text: str) -> list[str]:
        """The chunks of a space and the text, each without its first space."""
        if text[:1] != " " and text[-1:] != " " and not self.joined(text):
            return text.split(" ")  # no space follows white space
        return [c[1:] for c in self.cut(" " + text)]

    def records(self, text: str) -> list | None:
        """The records of a text's chunks, or None if its tokens' bytes are not the text's."""
        chunks = self.chunks(text)
        young = self.young
        missing = [c for c in dict.fromkeys(chunks) if c not in young]
        if missing:
            self._learn(missing)
            if self.young is not young:  # a generation ended: what this text needs is in the two together
                young = {c: self.young[c] if c in self.young else self.old[c] for c in dict.fromkeys(chunks)}
        found = [young[c] for c in chunks]
        return None if None in found else found

    def _learn(self, chunks: list[str]) -> None:
        unseen = [c for c in chunks if c not in self.old]
        fresh = dict(zip(unseen, self._align(unseen)))
        size = sum(map(len, chunks))
        if len(self.young) + len(chunks) > self.most or self.held + size > self.most_bytes:
            self.old, self.young, self.held = {**self.young, **{c: self.old[c] for c in chunks if c in self.old}}, {}, 0
        for c in chunks:
            self.young[c] = fresh[c] if c in fresh else self.old[c]
        self.held += size

    def _align(self, chunks: list[str], run: int = 2000) -> list:
        """Records of new chunks.  A chunk that ends in white space cannot stand before another."""
        known = {}
        plain = [c for c in chunks if c and not c[-1].isspace()]
        for at in range(0, len(plain), run):
            known.update(zip(plain[at : at + run], self._align_run(plain[at : at + run])))
        return [known[c] if c in known else self._align_run([c])[0] for c in chunks]

    def _align_run(self, chunks: list[str]) -> list:
        """Chunks encoded as one text; where that is not reproduced, the chunk to blame is found by halves."""
        whole = " " + " ".join(chunks)
        ids, raw = (self.a.ids(whole), self.b.ids(whole)), whole.encode()
        if all(b"".join([side.bytes[i] for i in of]) == raw for side, of in zip((self.a, self.b), ids)):
            return self._records(chunks, *ids)
        half = len(chunks) // 2
        return self._align_run(chunks[:half]) + self._align_run(chunks[half:]) if half else [None]

    def _records(self, chunks: list[str], a: list[int], b: list[int]) -> list:
        import numpy as np

        ids = [np.array(a), np.array(b)]
        ends = [size[of].cumsum() for size, of in zip(self.sizes, ids)]
        both = np.array(common_ends(*[e.tolist() for e in ends]), dtype=np.int64).reshape(-1, 2)
        # group g holds the tokens first[g] .. last[g] - 1 of either side: differences of ranks
        last = both + 1
        first = np.vstack([[[0, 0]], last[:-1]])
        held = last - first
        cuts = np.cumsum([len(c.encode()) + 1 for c in chunks])
        until = np.searchsorted(ends[0][both[:, 0]], cuts) + 1  # the chunk's groups end here
        if (ends[0][both[until - 1, 0]] != cuts).any():
            raise ValueError("a token crosses the end of a chunk")
        since = np.concatenate([[0], until[:-1]])
        links = np.concatenate([[0], np.cumsum(held[:, 0] * held[:, 1])])
        names = [list(map(table.__getitem__, of)) for table, of in zip(self.names, (a, b))]
        texts = [
            ",".join(names[0][i:x]) + "|" + ",".join(names[1][j:y])
            for (i, j), (x, y) in zip(first.tolist(), last.tolist())
        ]
        light = links[until] - links[since] <= MANY_LINKS
        pairs, place = self._pairs(ids, first, held, np.repeat(light, until - since))
        n_a, n_b = (last[until - 1] - first[since]).T.tolist()
        n_links = (links[until] - links[since]).tolist()
        records = []
        for k, (g, h) in enumerate(zip(since.tolist(), until.tolist())):
            text = ";".join(texts[g:h]).encode()
            if light[k]:
                own, times = pairs[8 * place[g] : 8 * place[h]], None
            else:
                own, times = self._distinct(ids, first[g:h], last[g:h])
            records.append((n_a[k], n_b[k], h - g, n_links[k], text, own, times))
        return records

    def _pairs(self, ids, first, held, wanted):
        """The id pairs of all links in the wanted groups, as bytes, and where each group's begin."""
        import numpy as np

        n = np.where(wanted, held[:, 0] * held[:, 1], 0)
        place = np.concatenate([[0], np.cumsum(n)])
        group = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(group)) - place[group]
        x, y = at // held[group, 1], at % held[group, 1]
        keys = ids[0][first[group, 0] + x] * self.size_b + ids[1][first[group, 1] + y]
        return keys.astype(np.int64).tobytes(), place.tolist()

    def _distinct(self, ids, first, last) -> tuple[bytes, bytes]:
        """The distinct id pairs of some groups and how many links each has."""
        import numpy as np

        keys, times = [], []
        for (i, j), (x, y) in zip(first, last):
            a, n = np.unique(ids[0][i:x], return_counts=True)
            b, m = np.unique(ids[1][j:y], return_counts=True)
            keys.append((a[:, None] * self.size_b + b).ravel())
            times.append((n[:, None] * m).ravel())
        return np.concatenate(keys).astype(np.int64).tobytes(), np.concatenate(times).astype(np.int64).tobytes()


def aligner(byte_path: str, piece_path: str) -> Aligner:
    held = worker_state().setdefault("aligners", {})
    if (byte_path, piece_path) not in held:
        held[byte_path, piece_path] = Aligner(byte_path, piece_path)
    return held[byte_path, piece_path]


def tally(pairs: list[bytes], times: list):
    """Distinct pairs of a document's chunks and their numbers."""
    import numpy as np

    keys = np.frombuffer(b"".join(pairs), np.int64)
    if not any(times):
        return np.unique(keys, return_counts=True)
    ones = np.int64(1).tobytes()
    n = np.frombuffer(b"".join([t or ones * (len(p) // 8) for p, t in zip(pairs, times)]), np.int64)
    keys, inverse = np.unique(keys, return_inverse=True)
    summed = np.zeros(len(keys), np.int64)
    np.add.at(summed, inverse, n)
    return keys, summed


def align_documents(docs: DataFrame, byte_path: str, piece_path: str, id_col: str, text_col: str) -> DataFrame:
    """row, id, n_a, n_b, n_groups, n_links, groups_sha256, pairs (distinct), times (of each in the document)."""
    base = named(docs, id=id_col, text=text_col)
    schema = (
        f"part int, row bigint, id {base.schema['id'].dataType.simpleString()}, n_a bigint, n_b bigint,"
        " n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>"
    )

    def align(batches: Iterator) -> Iterator:
        import os
        from hashlib import sha256

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        task, part, row = aligner(byte_path, piece_path), TaskContext.get().partitionId(), 0
        empty = np.zeros(0, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):  # pairs of few documents at a time
                batch = whole.slice(at, 512)
                sums, shas, pairs, times = [], [], [], []
                for value in batch.column(1):
                    text = value.as_py()
                    found = task.records(text) if text else None
                    if not found:
                        sums.append((0, 0, 0, 0))
                        shas.append("")
                        pairs.append(empty)
                        times.append(empty)
                        continue
                    n_a, n_b, groups, links, texts, held, counts = zip(*found)
                    sums.append((sum(n_a), sum(n_b), sum(groups), sum(links)))
                    shas.append(sha256(b";".join(texts)).hexdigest())
                    keys, n = tally(held, counts)
                    pairs.append(keys)
                    times.append(n)
                offsets = pa.array(np.cumsum([0, *map(len, pairs)]), type=pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([empty, *c]))) for c in (pairs, times)]
                rows = np.arange(row, row + batch.num_rows)
                row += batch.num_rows
                numbers = np.array(sums, dtype=np.int64).reshape(-1, 4).T
                columns = [pa.array(np.full(len(rows), part), type=pa.int32()), pa.array(rows), batch.column(0)]
                columns += [*map(pa.array, numbers), pa.array(shas, type=pa.string()), *lists]
                names = "part row id n_a n_b n_groups n_links groups_sha256 pairs times".split()
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return base.mapInArrow(align, schema)


def count_pairs(aligned: DataFrame, size_b: int) -> DataFrame:
    """pair, n (documents that hold it linked), best (no pair of its A id is held by more): one row per pair."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = written(counts, "pair-counts")
    a = F.expr(f"pair div {size_b}").alias("a")
    highest = counts.groupBy(a).agg(F.max("n").alias("highest"))
    # one row per A id: bounded by the vocabulary
    marked = counts.select("pair", "n", a).join(F.broadcast(highest), "a")
    return written(marked.select("pair", "n", (F.col("n") == F.col("highest")).alias("best")), "pair-marks")


def commonest(marks: DataFrame, frequent: int):
    """The pairs held by at least 2**e documents, for the smallest e that leaves at most ``frequent`` of them:
    sorted arrays of pairs, counts and marks."""
    sizes = marks.groupBy(F.expr("63 - length(regexp_extract(lpad(bin(n), 64, '0'), '^0*', 0))").alias("e")).count()
    least, held = 64, 0
    for e, n in sorted(sizes.collect(), reverse=True):  # at most 64 rows
        held += n
        if held > frequent:
            break
        least = e
    top = marks.where(F.col("n") >= F.lit(min(1 << least, (1 << 63) - 1))).toArrow().sort_by("pair")
    return tuple(top.column(c).to_numpy() for c in ("pair", "n", "best"))


def look_up(aligned: DataFrame, marks: DataFrame, frequent: int) -> DataFrame:
    """``aligned`` with n_best and count_sum from the commonest pairs; pairs and times are those that are left."""
    sent = aligned.sparkSession.sparkContext.broadcast(commonest(marks, frequent))
    names = [c for c in aligned.columns if c not in ("pairs", "times")]
    kinds = {f.name: f.dataType.simpleString() for f in aligned.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in names)
    schema += ", n_best bigint, count_sum bigint, pairs array<bigint>, times array<bigint>"
    n = len(names)

    def look(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        keys, counts, best = sent.value
        for batch in batches:
            lists = [batch.column(i) for i in (n, n + 1)]
            pairs, times = (c.flatten().to_numpy() for c in lists)
            sizes = np.diff(lists[0].offsets.to_numpy())
            doc = np.repeat(np.arange(batch.num_rows), sizes)
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            links = np.where(known, times, 0)
            total = lambda weights: _sums(doc, weights, batch.num_rows)  # noqa: B023, E731
            n_best = total(links * best[at] if len(keys) else links)
            count_sum = total(links * counts[at] if len(keys) else links)
            left = ~known
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc[left], minlength=batch.num_rows))]), type=pa.int32())
            rest = [pa.ListArray.from_arrays(offsets, pa.array(c[left])) for c in (pairs, times)]
            columns = [*batch.columns[:n], pa.array(n_best), pa.array(count_sum), *rest]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_best", "count_sum", "pairs", "times"])

    return aligned.select(*names, "pairs", "times").mapInArrow(look, schema)


def _sums(groups, weights, n: int):
    """Whole-number sums of ``weights`` per group (groups are sorted)."""
    import numpy as np

    running = np.concatenate([[0], np.cumsum(weights, dtype=np.int64)])
    bounds = np.searchsorted(groups, np.arange(n + 1))
    return running[bounds[1:]] - running[bounds[:-1]]


def align_tokens(
    docs: DataFrame,
    byte_path: str,
    piece_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: int = 1 << 20,
) -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    aligned = written(align_documents(docs, byte_path, piece_path, id_col, text_col), "aligned")
    marks = count_pairs(aligned, len(PieceTokens(piece_path).bytes))
    looked = written(look_up(aligned, marks, frequent), "pair-sums")
    keys = ["part", "row"]
    rest = looked.select(*keys, F.explode(F.arrays_zip("pairs", "times")).alias("held"))
    rest = rest.select(*keys, F.col("held.pairs").alias("pair"), F.col("held.times").alias("times"))
    rest = rest.join(marks, "pair").groupBy(*keys).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"),
    )
    more = lambda c, m: (F.col(c) + F.coalesce(m, F.lit(0))).cast("bigint").alias(c)
    return looked.drop("pairs", "times").join(rest, keys, "left").select(
        "id", "n_a", "n_b", "n_groups", "n_links",
        more("n_best", "more_best"), more("count_sum", "more_sum"), "groups_sha256",
    )
