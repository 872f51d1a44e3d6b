"""Licence scans with a positional rare-token index.

Templates (licence phrases and notices) are indexed by word and position.
One pass over the corpus counts in how many documents each licence word
stands.  A second pass takes the licence words of every whole text in the order
of their inverse document frequency, highest first, and looks up their
postings: a word at text position d and template position t puts the template
at d - t.  The starts that the rarest word of a mandatory phrase gives are
intersected with those of its next rarest words.  At every start that is left
the mandatory phrase is compared word for word, and the template's other words
are counted where they stand in place; a template is found where enough do.

The mandatory phrase stands wherever the template is found, and its rarest words
with it, so no place is missed whatever the frequencies are.  A
template may begin before the text does; its words there are missing.
Documents without the rarest word of any mandatory phrase are only counted.

Words are runs of ASCII letters (A-Z lower-cased), digits and all characters
beyond ASCII.  Defined cases: a null text is empty; places may overlap;
repeated rows get one row each; words that are equally rare tie by template
position; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkit.llm.common import named, texts_of


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    key: tuple[int, int]  # words [from, to) of the mandatory phrase
    coverage: float  # share of the words that must stand in place
    base: bool = False


def template(label: str, text: str, key: str = "", coverage: float = 1.0, base: bool = False) -> Template:
    words, phrase = tuple(text.encode().split()), tuple((key or text).encode().split())
    for at in range(len(words) - len(phrase) + 1):
        if words[at : at + len(phrase)] == phrase:
            return Template(label, words, (at, at + len(phrase)), coverage, base)
    raise ValueError(f"{key!r} is no run of words of the template")


#: The standing phrases and their labels.
BASE = (
    template("mit", "under the mit license", base=True),
    template("apache-2", "apache license version 2", base=True),
    template("cc-by-nc", "cc by nc", base=True),
)
#: Further notices, each with its mandatory phrase.
NOTICES = (
    template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "any person obtaining a copy", 0.8),
    template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file", "apache license version 2 0", 0.8),
    template("cc-by-nc", "creative commons attribution noncommercial", "attribution noncommercial"),
    template("cc-by-sa", "creative commons attribution sharealike", "attribution sharealike"),
    template("cc0", "creative commons zero", "commons zero"),
    template("gpl-2", "gnu general public license version 2", "general public license version 2"),
    template("gpl-3", "gnu general public license version 3", "general public license version 3"),
    template("lgpl", "gnu lesser general public license", "lesser general public license"),
    template("agpl", "gnu affero general public license", "affero general public license"),
    template("mpl-2", "mozilla public license version 2", "mozilla public license"),
    template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms", 0.8),
    template("isc", "permission to use copy modify and or distribute this software for any purpose", "use copy modify and or distribute", 0.8),
    template("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software", 0.8),
)


def word_bytes() -> bytes:
    """Byte table: letters lower-cased, digits and non-ASCII bytes kept, all else a space."""
    keep = bytearray(b" " * 256)
    for b in range(256):
        if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80:
            keep[b] = b
        elif 0x41 <= b <= 0x5A:
            keep[b] = b + 32
    return bytes(keep)


def words_of(text: str, kept: bytes) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(kept).split()


def document_frequencies(docs: DataFrame, text_col: str, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """In how many documents each word of ``vocabulary`` stands (one row per word comes back)."""
    kept = word_bytes()

    def compute(batches: Iterator) -> Iterator:
        from collections import Counter

        import pyarrow as pa

        held: Counter = Counter()
        for batch in batches:
            for text in texts_of(batch, 0):
                held.update(vocabulary.intersection(words_of(text, kept)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "n"]
        )

    counts = named(docs, text=text_col).mapInArrow(compute, "word binary, n bigint")
    rows = counts.groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {bytes(r.word): r.n for r in rows}


class PositionalIndex:
    """Postings (template, position, whether it is the rarest) of the ``probes`` rarest words of each
    template's mandatory phrase."""

    def __init__(self, templates: Sequence[Template], frequency: dict[bytes, int], probes: int = 3):
        self.templates = templates
        self.postings: dict[bytes, list[tuple[int, int, bool]]] = {}

        def rarity(word: bytes) -> tuple[int, bytes]:
            return frequency.get(word, 0), word

        for t, entry in enumerate(templates):
            rarest = sorted(range(*entry.key), key=lambda i: (*rarity(entry.words[i]), i))[:probes]
            for n, i in enumerate(rarest):
                self.postings.setdefault(entry.words[i], []).append((t, i, n == 0))
        self.rank = {word: n for n, word in enumerate(sorted(self.postings, key=rarity))}
        self.first = frozenset(w for w, held in self.postings.items() if any(rarest for _, _, rarest in held))

    def starts(self, words: list[bytes]) -> dict[int, set[int]]:
        """Where each template may start: the file's words are looked up, highest inverse document
        frequency first, and their postings intersected by relative position."""
        places: dict[bytes, list[int]] = {}
        for d, word in enumerate(words):
            if word in self.postings:
                places.setdefault(word, []).append(d)
        open_: dict[int, set[int]] = {}
        for word in sorted(places, key=self.rank.__getitem__):
            at = set(places[word])
            for t, i, rarest in self.postings[word]:
                if rarest:
                    open_[t] = {d - i for d in at}
                elif t in open_:
                    open_[t] = {s for s in open_[t] if s + i in at}
        return open_

    def find(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, start, share of its words in place) wherever a template's mandatory phrase stands."""
        found = []
        for t, starts in self.starts(words).items():
            entry = self.templates[t]
            a, b = entry.key
            for start in starts:
                if start + a < 0 or tuple(words[start + a : start + b]) != entry.words[a:b]:
                    continue
                there, of = words[max(start, 0) : start + len(entry.words)], entry.words[max(-start, 0) :]
                found.append((t, start, sum(x == y for x, y in zip(there, of)) / len(entry.words)))
        return found

    def holds(self, t: int, share: float) -> bool:
        return share >= self.templates[t].coverage


SCAN = (
    "id {id}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels string, labels string, score double"
)


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: Sequence[Template] = BASE,
    notices: Sequence[Template] = NOTICES,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_base (places of base phrases), first_word and
    last_word (their smallest and largest start), base_labels, labels (sorted, comma-joined) and
    score (the largest share of a template's words in place, over all places of mandatory phrases)."""
    templates = (*base, *notices)
    vocabulary = frozenset(w for t in templates for w in t.words)
    index = PositionalIndex(templates, document_frequencies(docs, text_col, vocabulary))
    rows = named(docs, id=id_col, text=text_col)
    kept = word_bytes()

    def compute(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            columns = [[] for _ in range(7)]
            for text in texts_of(batch, 1):
                words = words_of(text, kept)
                places, labels, base_labels, score = [], set(), set(), 0.0
                if not index.first.isdisjoint(words):
                    for t, start, share in index.find(words):
                        score = max(score, share)
                        if index.holds(t, share):
                            labels.add(templates[t].label)
                            if templates[t].base:
                                places.append(start)
                                base_labels.add(templates[t].label)
                values = (
                    len(words), len(places), min(places, default=None), max(places, default=None),
                    ",".join(sorted(base_labels)), ",".join(sorted(labels)), score,
                )
                for column, value in zip(columns, values):
                    column.append(value)
            kinds = (*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return rows.mapInArrow(compute, SCAN.format(id=rows.schema["id"].dataType.simpleString()))
