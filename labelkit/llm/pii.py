"""Personal data by bootstrapped contextual extraction.

Standing rules find the base spans (e-mail, ip, card, phone) of every whole
text.  They are the seeds: the words around them are lexical patterns, once with
the coarse class of what stands there (with an @, or with digits only) and once
with its exact shape.  Patterns and the identifiers they hold
form a graph that Spark scores in rounds: a pattern is as good as the share of
its distinct identifiers that are of one kind, and an identifier that is no
seed is as good as the other patterns that hold it.  Patterns with enough
distinct seeds and a confidence that proved right on held-out identifiers then
name further identifiers that the standing rules missed: tokens with a digit or an @, and runs of number tokens
with a space between.  Base spans always stay; of nested finds the outer stays.

Spans count code points, end exclusive.  Whole texts are scanned once; rules
are anchored so that a long run of digits or letters costs linear time.
Identifiers and patterns travel as 64-bit hashes, never as clear text.

Defined cases: a null text is empty; a document without spans has the digest
of the empty string and an empty span list; repeated rows get one row each;
spans at one start are ordered by kind; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelkit.llm.common import named, texts_of, written

KINDS = ("email", "ip", "card", "phone")

#: The standing rules.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        if i % 2:
            v = 2 * v - 9 if v > 4 else 2 * v
        total += v
    return total % 10 == 0


class Scanner:
    """Base spans and identifier-like tokens of a text, with their surroundings."""

    def __init__(self):
        import re

        self.digit = re.compile(r"[0-9]").search
        # no match can begin inside a run whose beginning failed, so only runs' beginnings are tried
        self.email = re.compile(r"(?<![A-Za-z0-9._%+-])" + EMAIL)
        self.email_here = re.compile(EMAIL)
        self.ip = re.compile(r"(?<![0-9])" + IP)
        self.card = re.compile(CARD)
        self.phone = re.compile(PHONE)
        self.word = re.compile(r"\S+")
        self.token = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
        self.lead = re.compile(r"[\w+(]")
        self.number = re.compile(r"[0-9()+./-]+").fullmatch
        self.letters = re.compile(r"[^\W\d_]+")
        self.digits = re.compile(r"[0-9]+")

    def emails(self, text: str) -> Iterator[tuple[int, int]]:
        at = 0
        while True:
            # right after a match the next may begin inside the same run
            m = self.email_here.match(text, at) if at else None
            m = m or self.email.search(text, at)
            if not m:
                return
            yield m.span()
            at = m.end()

    def base(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end), by start, then kind."""
        found = []
        if "@" in text:
            found += [(a, 0, b) for a, b in self.emails(text)]
        if self.digit(text):
            for m in self.ip.finditer(text):
                parts = [p.lstrip("0") for p in m.group().split(".")]
                if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                    found.append((m.start(), 1, m.end()))
            for m in self.card.finditer(text):
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
            if "+" in text:
                for m in self.phone.finditer(text):
                    if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                        found.append((m.start(), 3, m.end()))
        return sorted(found)

    def core(self, token: str) -> tuple[int, int]:
        """[start, end) of a token without the marks around it; a plus or bracket may lead."""
        end = len(token)
        while end and not (token[end - 1].isalnum() or token[end - 1] == "_"):
            end -= 1
        first = self.lead.search(token, 0, end)
        return (first.start(), end) if first else (end, end)

    def others(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
        """Identifier-like tokens, and runs of number tokens, that no base span touches."""
        found, k = [], 0
        spans = sorted((a, b) for a, _, b in base)
        first, last, count, joins = 0, 0, 0, -1  # the open run of number tokens, and where the next must begin

        def close():
            if count > 1 and last - first >= 5:
                found.append((first, last))

        for m in self.token.finditer(text):
            start, end = (m.start() + at for at in self.core(m.group()))
            while k < len(spans) and spans[k][1] <= m.start():
                k += 1
            free = not (k < len(spans) and spans[k][0] < m.end())
            if free and end - start >= 5:
                found.append((start, end))
            number = free and self.number(text, start, end)
            if not (number and m.start() == start == joins):
                close()
                first, count = start, 0
            if number:
                last, count = end, count + 1
            # a bracket may close between two tokens of a run, other marks end it
            joins = m.end() + 1 if number and text[end : m.end()] in ("", ")") and text[m.end() : m.end() + 1] == " " else -1
        close()
        return found

    def shape(self, token: str) -> str:
        """Letters and digits as classes; the number of digits matters, up to a point."""
        token = self.digits.sub(lambda m: f"<{min(len(m.group()), 24)}>", token)
        return self.letters.sub("a", token)

    def neighbours(self, text: str, spans: list[tuple[int, int]]) -> list[tuple[list[str], list[str]]]:
        """The two words before and the one after each of ``spans``, whole and lower-cased.

        Words are runs without white space; in the word that holds the span, the part
        on either side up to the next other span, so that a run of many spans costs
        linear time.  Long words stand as their hashes."""
        if not spans:
            return []
        from bisect import bisect_left, bisect_right

        words = [m.span() for m in self.word.finditer(text)]
        starts = [a for a, _ in words]
        begin, finish = sorted(a for a, _ in spans), sorted(b for _, b in spans)
        seen: dict[int, str] = {}

        def whole(i: int) -> list[str]:
            if not 0 <= i < len(words):
                return []
            if i not in seen:
                seen[i] = short(text[slice(*words[i])])
            return [seen[i]]

        out = []
        for a, b in spans:
            i, j = bisect_right(starts, a) - 1, bisect_left(starts, b) - 1
            last, following = bisect_right(finish, a), bisect_left(begin, b)
            glued = text[max(words[i][0], finish[last - 1] if last else 0) : a]
            behind = text[b : min(words[j][1], begin[following] if following < len(begin) else len(text))]
            left = whole(i - 1) + [short(glued)] if glued else whole(i - 2) + whole(i - 1)
            out.append((left, [short(behind)] if behind else whole(j + 1)))
        return out

    def patterns(self, token: str, left: list[str], right: list[str]) -> list[str]:
        out = []
        # no shape is one of the two class names: its letter runs are "a"
        for kind in ("mail-like" if "@" in token else "digit-like", short(self.shape(token))):
            if left:
                out.append(f"{left[-1]} _ {kind}")
            if len(left) == 2:
                out.append(f"{left[0]} {left[1]} _ {kind}")
            if left and right:
                out.append(f"{left[-1]} _ {right[0]} {kind}")
            if right:
                out.append(f"_ {right[0]} {kind}")
        return out


def short(word: str, most: int = 64) -> str:
    """The word in lower case; beyond ``most`` characters its hash, which stands for all of it."""
    from xxhash import xxh64_hexdigest

    word = word.lower()
    return word if len(word) <= most else f"#{xxh64_hexdigest(word.encode('utf-8', 'surrogatepass'))}"


MENTION = "struct<start:bigint,end:bigint,kind:int,instance:bigint,patterns:array<bigint>>"
SPAN = "struct<start:bigint,kind:int,end:bigint>"


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, row (unique), base: array of spans, mentions: seeds and identifier-like tokens with their patterns."""
    base = named(docs, id=id_col, text=text_col)

    def compute(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        from xxhash import xxh64_intdigest

        def key(s: str) -> int:
            return xxh64_intdigest(s.encode("utf-8", "surrogatepass")) - (1 << 63)

        scanner, row = Scanner(), TaskContext.get().partitionId() << 40
        span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
        mention = pa.struct(
            [("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("instance", pa.int64()),
             ("patterns", pa.list_(pa.int64()))]
        )
        for batch in batches:
            spans, mentions, rows = [], [], []
            for text in texts_of(batch, 1):
                found = scanner.base(text)
                spans.append([{"start": a, "kind": k, "end": b} for a, k, b in found])
                near = [(a, b, k) for a, k, b in found]
                if scanner.digit(text) or "@" in text:
                    near += [(a, b, -1) for a, b in scanner.others(text, found)]
                beside = scanner.neighbours(text, [(a, b) for a, b, _ in near])
                mentions.append(
                    [
                        {"start": a, "end": b, "kind": k, "instance": key(text[a:b].lower()),
                         "patterns": [key(p) for p in scanner.patterns(text[a:b], *words)]}
                        for (a, b, k), words in zip(near, beside)
                    ]
                )
                rows.append(row)
                row += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.int64()), pa.array(spans, pa.list_(span)),
                 pa.array(mentions, pa.list_(mention))],
                names=["id", "row", "base", "mentions"],
            )

    id_type = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(compute, f"id {id_type}, row bigint, base array<{SPAN}>, mentions array<{MENTION}>")


def score_patterns(edges: DataFrame, rounds: int = 3, doubt: float = 1.0, trust: float = 0.5) -> DataFrame:
    """pattern, kind, confidence, seeds from distinct edges (pattern, instance, kind; kind -1: unknown).

    A pattern's confidence in a kind is the sum of its identifiers' confidences
    over their number plus ``doubt``; an unknown identifier has ``trust`` times
    the mean confidence of its other patterns (its own pattern says nothing
    about it, or patterns would confirm themselves)."""
    size = edges.groupBy("pattern").agg(F.countDistinct("instance").alias("size"))
    seeds = edges.where("kind >= 0").groupBy("pattern", "kind").agg(F.countDistinct("instance").alias("seeds"))
    known = edges.where("kind >= 0").select("instance").distinct()
    unknown = edges.where("kind < 0").select("pattern", "instance").join(known, "instance", "left_anti")
    unknown = written(unknown, "pii-unknown")
    held = written(seeds.join(size, "pattern"), "pii-patterns")
    scores = held.withColumn("confidence", F.expr(f"seeds / (size + {doubt})"))
    for i in range(rounds):
        lent = unknown.join(scores.select("pattern", "kind", "confidence"), "pattern")
        of = lent.groupBy("instance", "kind").agg(F.sum("confidence").alias("total"))
        degree = unknown.groupBy("instance").agg(F.count("*").alias("degree"))
        others = lent.join(of, ["instance", "kind"]).join(degree.where("degree > 1"), "instance")
        share = F.expr(f"{trust} * (total - confidence) / (degree - 1)")
        gained = others.withColumn("share", share).groupBy("pattern", "kind").agg(F.sum("share").alias("gained"))
        scores = held.join(gained, ["pattern", "kind"], "left").withColumn(
            "confidence", F.expr(f"(seeds + coalesce(gained, 0D)) / (size + {doubt})")
        )
        scores = written(scores.drop("gained"), f"pii-round-{i}")
    return scores


def confidence_bound(
    edges: DataFrame, min_precision: float, min_seeds: int, least: float = 0.7, doubt: float = 1.0, folds: int = 4, levels: int = 20
) -> float:
    """The confidence from which patterns may name identifiers, learned on held-out identifiers.

    Identifiers are dealt to ``folds`` by hash, and each is named by the best pattern that the
    other folds make.  It is named rightly if it is a seed of that kind, so what is no
    seed counts against its pattern.  The bound is the lowest step of 1 / ``levels``, from
    ``least`` on, such that of all identifiers named at or above it a share of at least
    ``min_precision`` are named rightly; above 1 if there is none."""
    edges = edges.withColumn("fold", F.pmod(F.xxhash64("instance"), F.lit(folds)))
    distinct = F.countDistinct("instance")
    own_size = edges.groupBy("pattern", "fold").agg(distinct.alias("own_size"))
    own_seeds = edges.where("kind >= 0").groupBy("pattern", F.col("kind").alias("named"), "fold").agg(distinct.alias("own_seeds"))
    size = own_size.groupBy("pattern").agg(F.sum("own_size").alias("size"))
    seeds = own_seeds.groupBy("pattern", "named").agg(F.sum("own_seeds").alias("seeds"))
    scores = seeds.where(F.col("seeds") >= min_seeds).join(size, "pattern")
    scores = scores.join(own_size, "pattern").join(own_seeds, ["pattern", "named", "fold"], "left")
    confidence = F.expr(f"(seeds - coalesce(own_seeds, 0)) / (size - own_size + {doubt})")
    judged = edges.join(scores.select("pattern", "named", "fold", confidence.alias("confidence")), ["pattern", "fold"])
    judged = judged.groupBy("instance").agg(
        F.max(F.struct("confidence", (-F.col("named")).alias("order"))).alias("best"),
        F.collect_set("kind").alias("kinds"),  # at most one entry per kind
    )
    right = F.array_contains("kinds", -F.col("best.order"))
    level = F.floor(F.col("best.confidence") * levels).cast("int")
    rows = judged.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.sum(right.cast("int")).alias("right")).collect()
    bound, named_, rightly = 2.0, 0, 0
    for r in sorted(rows, key=lambda r: -r.level):  # at most levels + 1 rows
        named_, rightly = named_ + r.n, rightly + r.right
        if rightly >= min_precision * named_:
            bound = max(least, r.level / levels)
    return bound


def find_personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_precision: float = 0.8,
    min_seeds: int = 8,
    rounds: int = 3,
) -> DataFrame:
    """One row per row of ``docs``: id, n_email, n_ip, n_card, n_phone, base_spans, spans
    (``kind:start:end`` joined by commas; ``spans`` holds those found by patterns as well)."""
    scanned = written(scan(docs, id_col, text_col), "pii-scan")
    mentions = scanned.where("size(mentions) > 0").select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    edges = mentions.select(F.explode("patterns").alias("pattern"), "instance", "kind").distinct()
    edges = written(edges, "pii-edges")
    bound = confidence_bound(edges, min_precision, min_seeds)
    good = score_patterns(edges, rounds).where((F.col("confidence") >= bound) & (F.col("seeds") >= min_seeds))
    open_ = mentions.where("kind < 0").select("row", "start", "end", F.explode("patterns").alias("pattern"))
    # one kind per mention: the one its best pattern names
    best = F.max_by("kind", F.struct("confidence", -F.col("kind")))
    found = open_.join(good.select("pattern", "kind", "confidence"), "pattern")
    found = found.groupBy("row", "start", "end").agg(best.alias("kind"))
    earlier = Window.partitionBy("row").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("reach", F.max("end").over(earlier)).where("reach is null or reach < end")
    more = found.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more"))
    out = scanned.select("id", "row", "base").join(more, "row", "left")
    names = ", ".join(f"'{k}'" for k in KINDS)
    text = "array_join(transform({}, s -> concat(array({})[s.kind], ':', s.start, ':', s.end)), ',')"
    out = out.withColumn("all", F.expr(f"array_sort(concat(base, coalesce(more, cast(array() as array<{SPAN}>))))"))
    return out.select(
        "id",
        *[F.expr(f"cast(size(filter(base, s -> s.kind = {i})) as bigint)").alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.expr(text.format("base", names)).alias("base_spans"),
        F.expr(text.format("all", names)).alias("spans"),
    )


def redact(text: str, spans: str) -> str:
    """``text`` with every span of the list replaced by its kind in brackets (overlaps: the earlier one)."""
    out, at = [], 0
    for item in filter(None, spans.split(",")):
        kind, start, end = item.split(":")
        if int(start) >= at:
            out += [text[at : int(start)], f"[{kind}]"]
            at = int(end)
    return "".join(out) + text[at:]
