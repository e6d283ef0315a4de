"""Personal data by candidate gradient boosting, in DataFrame functions alone.

Base rules give exact spans per kind (e-mail, ip, card, phone); these stay whatever else is found. Generators
of high recall then propose further, overlapping spans: formats that the base rules miss or lose, such as
a card number that a longer run of digits swallowed, a written-out e-mail, a phone number without "+".
Boosted trees score each candidate by eight yes/no features of its format and context, and per kind a threshold
calibrated for precision selects which are kept.

Learning needs no labels from outside: a candidate on a base span of its kind is a positive, one on a base
span of another kind (and not its own) a negative, all others are only scored. Besides, every combination of
features that occurs counts one negative that nobody has seen yet. A combination passes if its score does and if
it reaches the wanted precision by its own positives, so one without positives, such as written-out e-mails, which
no base span can confirm, never passes, however large the table. Candidates of the same text in the same
surroundings count once: copies of a document are no further evidence, and change no span of another one.
The features make at most 256 combinations per kind, so the counts per kind, combination and label (at most
4 x 256 x 3 rows, over all candidates of all documents) are all the trees need: Spark counts, the driver fits
them, and the trees become one column expression. A kind with fewer than `LEAST` positives adds no spans. Of
accepted spans of a kind that lie in one another the longest stays.

Positions are code points, found by cutting the text at the matches. All patterns are linear: runs are
possessive and start only where a run starts (or the previous match ended).

Defined cases: null and empty texts have no spans (redacted, null stays null). Every row is handled by itself, so repeated
or missing doc_ids change nothing. An empty table fits no trees.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import col, fresh, settle

KINDS = ("email", "ip", "card", "phone")
PLACEHOLDERS = ("<EMAIL>", "<IP>", "<CARD>", "<PHONE>")
LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE = (
    rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
    r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # whole runs of 16 to 19 digits: a run starts at its first digit only and ends where no digit follows
    r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){15,18}+(?![ -]?[0-9])",
    r"\+[0-9][ ().0-9-]+[0-9]",
)
#: Further formats: kind and pattern. Each is bounded in length.
GENERATORS = (
    (0, rf"(?<!{LOCAL}){LOCAL}{{1,64}}+ ?(?:\(at\)|\[at\]|\{{at\}}) ?{LABEL}{{1,63}}+(?: ?(?:\.|\(dot\)|\[dot\]|\{{dot\}}) ?{LABEL}{{1,63}}+){{1,8}}+"),
    (0, rf"(?<!{LOCAL}){LOCAL}{{1,64}}+@{LABEL}{{1,63}}+(?:\.{LABEL}{{1,63}}+){{1,8}}+"),
    (1, r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])"),
    (2, r"(?<![0-9])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])"),
    (3, r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"),
    (3, r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])"),
    (3, r"(?<![0-9+.-])00[1-9][0-9]{0,2}[ .-]\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"),
)
BYTE = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)?"
CUES = "(?i)(?:mail|contact|write|phone|tel|call|fax|mobile|card|visa|pay|host|server|addr|ip)[^0-9]{0,16}$"
CONTEXT = 24
FEATURES = 8
#: Matches whose places are added up one by one.
BLOCK = 64
ROUNDS, RATE, LEAST, PRECISION = 20, 0.3, 10, 0.98
SPAN = "struct<kind: int, start: int, stop: int>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits (at most 19) pass the checksum."""
    figures = F.transform(F.split(F.reverse(digits(value)), ""), lambda d: F.try_to_number(d, F.lit("9")).cast("int"))
    doubled = F.transform(figures, lambda d, i: F.when(i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: int, value: Column) -> Column:
    """What the base rule asks of a match besides its pattern."""
    if kind == 1:
        return value.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    n = F.length(digits(value))
    if kind == 2:
        return F.when(n.between(16, 19), luhn(value)).otherwise(False)
    return n.between(8, 15) if kind == 3 else F.lit(True)


def let(value: Column, use) -> Column:
    """use(value), with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def located(text: Column, pattern: str) -> Column:
    """All matches, from the left, as structs of start and value.

    The text between the matches gives their places. Matches are added up in blocks, so that a text with
    very many of them costs little more than their number.
    """
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start: int, value: string>>")

    def pairs(found: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), F.length)
        return F.zip_with(gaps, found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))

    def blocks(p: Column) -> Column:
        last = F.ceil(F.size(p) / BLOCK).cast("int") - 1
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(p, b * BLOCK + 1, F.lit(BLOCK)))

    def size(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), lambda a, x: a + x.gap + F.length(x.value))

    def walk(block: Column, at: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(at.alias("at"), none.alias("found")),
            lambda a, x: F.struct(
                (a.at + x.gap + F.length(x.value)).alias("at"),
                F.concat(a.found, F.array(F.struct((a.at + x.gap).alias("start"), x.value.alias("value")))).alias("found"),
            ),
            lambda a: a.found,
        )

    def walked(parts: Column) -> Column:
        return let(F.transform(parts, size), lambda sizes: F.flatten(F.transform(
            parts, lambda block, b: walk(block, F.aggregate(F.slice(sizes, F.lit(1), b), F.lit(0), lambda a, x: a + x))
        )))

    return let(values, lambda found: F.when(
        F.size(found) > 0, let(pairs(found), lambda p: let(blocks(p), walked))
    ).otherwise(none))


def base_spans(text: Column, kind: int) -> Column:
    kept = F.filter(located(text, BASE[kind]), lambda m: valid(kind, m.value))
    return F.transform(kept, lambda m: as_span(kind, m))


def as_span(kind: int, m: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), m.start.alias("start"), (m.start + F.length(m.value)).alias("stop"))


def candidates(text: Column, kind: int, pattern: str) -> Column:
    """Spans of one generator with their features, one bit each."""

    def described(m: Column) -> Column:
        value, stop = m.value, m.start + F.length(m.value)
        n = F.length(digits(value))
        before = F.substring(text, F.greatest(m.start - CONTEXT, F.lit(0)) + 1, F.least(m.start, F.lit(CONTEXT)))
        after = F.substring(text, stop + 1, F.lit(1))
        answers = (
            value.startswith("+") | value.contains("@"),
            value.rlike("[ ().-]"),
            n.between(10, 12),
            n >= 13,
            (before == "") | before.rlike(r"[\s(\[{<:;,'\"=]$"),
            (after == "") | after.rlike(r"^[\s)\]}>:;,.'\"!?]"),
            before.rlike(CUES),
            value.rlike("[A-Za-z]"),
        )
        mask = reduce(lambda a, b: a + b, [F.when(a, F.lit(1 << i)).otherwise(0) for i, a in enumerate(answers)])
        seen = F.xxhash64(before, value, after)
        return F.struct(F.lit(kind).alias("kind"), m.start.alias("start"), stop.alias("stop"), mask.alias("mask"), seen.alias("seen"))

    found = located(text, pattern)
    if kind in (1, 2):
        found = F.filter(found, lambda m: valid(kind, m.value))
    return F.transform(found, described)


def overlap(a: Column, b: Column) -> Column:
    return (a.start < b.stop) & (b.start < a.stop)


def proposed(docs: DataFrame, text: str, base: str, more: str) -> DataFrame:
    """Adds the base spans, by kind and start, and the candidates that no base span of their kind covers whole.

    A candidate's label is 1 on a base span of its kind, else 0 on one of another kind, else null.
    """
    raw = F.coalesce(col(text), F.lit(""))
    may, at = fresh("may", docs.columns), fresh("at", docs.columns)
    rows = docs.withColumn(may, F.when(raw.rlike("[0-9][ ().-]?[0-9]|\\+[0-9]|@|[(\\[{]at[)\\]}]"), raw).otherwise(""))
    none = F.array().cast(f"array<{SPAN}>")
    spans = F.concat(*[base_spans(col(may), kind) for kind in range(len(KINDS))])
    rows = rows.withColumn(base, F.when(col(may) == "", none).otherwise(spans))
    found = F.concat(*[candidates(col(may), kind, pattern) for kind, pattern in GENERATORS])
    rows = rows.withColumn(at, F.when(col(may) == "", found_none()).otherwise(found))

    def labelled(c: Column) -> Column:
        own = F.exists(col(base), lambda b: (b.kind == c.kind) & overlap(b, c))
        other = F.exists(col(base), lambda b: overlap(b, c))
        return F.struct(c.kind, c.start, c.stop, c["mask"], c.seen, F.when(own, 1).when(other, 0).alias("label"))

    return rows.withColumn(more, F.transform(F.array_distinct(col(at)), labelled)).drop(may, at)


def found_none() -> Column:
    return F.array().cast("array<struct<kind: int, start: int, stop: int, mask: int, seen: bigint>>")


class Trees:
    """Boosted trees of depth two over the feature bits of one kind, the threshold of their score, and the
    combinations (masks) that are right often enough by themselves."""

    def __init__(self, counts: dict[tuple[int, int], int]):
        """counts: by mask and label (1, 0 or None)."""
        masks = sorted({m for m, _ in counts})
        rows = [(m, counts.get((m, 1), 0), counts.get((m, 0), 0) + 1) for m in masks]
        positive, negative = sum(p for _, p, _ in rows), sum(n for _, _, n in rows)
        self.trees: list[tuple] = []
        self.proven = [m for m, p, n in rows if p >= PRECISION * (p + n)]
        self.threshold = None
        if positive < LEAST:
            return
        self.prior = math.log(positive / negative)
        score = dict.fromkeys(masks, self.prior)
        for _ in range(ROUNDS):
            slope = {m: (p - (p + n) / (1 + math.exp(-score[m])), (p + n) / (2 + math.exp(score[m]) + math.exp(-score[m]))) for m, p, n in rows}
            tree = self.grow(masks, slope, 2)
            self.trees.append(tree)
            for m in masks:
                score[m] += self.leaf(tree, m)
        self.calibrate(rows, score)

    def grow(self, masks: list[int], slope: dict, depth: int):
        def gain(group: list[int]) -> float:
            g, h = sum(slope[m][0] for m in group), sum(slope[m][1] for m in group)
            return g * g / (h + 1)

        best, bit = gain(masks) + 1e-9, None
        for i in range(FEATURES) if depth else ():
            parts = [m for m in masks if m >> i & 1], [m for m in masks if not m >> i & 1]
            if all(parts) and gain(parts[0]) + gain(parts[1]) > best:
                best, bit = gain(parts[0]) + gain(parts[1]), i
        if bit is None:
            return RATE * sum(slope[m][0] for m in masks) / (sum(slope[m][1] for m in masks) + 1)
        return bit, *[self.grow([m for m in masks if (m >> bit & 1) == side], slope, depth - 1) for side in (1, 0)]

    def leaf(self, tree, mask: int) -> float:
        while isinstance(tree, tuple):
            tree = tree[1] if mask >> tree[0] & 1 else tree[2]
        return tree

    def calibrate(self, rows: list[tuple[int, int, int]], score: dict[int, float]) -> None:
        """The lowest score such that of all labelled candidates from there on the wanted share is positive."""
        right = wrong = 0
        for m, p, n in sorted(rows, key=lambda r: -score[r[0]]):
            right, wrong = right + p, wrong + n
            if right >= PRECISION * (right + wrong):
                self.threshold = score[m] - 1e-9

    def score(self, mask: Column) -> Column:
        def branch(tree):
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            return F.when(mask.bitwiseAND(F.lit(1 << tree[0])) != 0, branch(tree[1])).otherwise(branch(tree[2]))

        return reduce(lambda a, b: a + b, map(branch, self.trees), F.lit(self.prior))


def fit(found: DataFrame, more: str) -> list[Trees]:
    """One model per kind from the labelled candidates of all rows, equal ones in equal surroundings once."""
    rows = (
        found.select(F.explode(more).alias("c"))
        .select("c.kind", "c.mask", "c.label", "c.seen")
        .distinct()
        .groupBy("kind", "mask", "label")
        .count()
        .collect()
    )
    return [Trees({(r["mask"], r["label"]): r["count"] for r in rows if r["kind"] == kind}) for kind in range(len(KINDS))]


def selected(base: Column, more: Column, models: list[Trees]) -> Column:
    """The base spans and the accepted candidates that no base span of their kind meets, by kind and start."""

    def accepted(c: Column) -> Column:
        passed = F.lit(False)
        for kind, model in enumerate(models):
            if model.threshold is not None:
                proven = c["mask"].isin(model.proven) if model.proven else F.lit(False)
                passed = passed | ((c.kind == kind) & proven & (model.score(c["mask"]) >= model.threshold))
        return passed & ~F.coalesce(c.label == 1, F.lit(False))

    def longest(kept: Column) -> Column:
        def inside(a: Column, b: Column) -> Column:
            return (a.kind == b.kind) & (b.start <= a.start) & (a.stop <= b.stop) & (b.stop - b.start > a.stop - a.start)

        return F.filter(kept, lambda a: ~F.exists(kept, lambda b: inside(a, b)))

    kept = F.transform(F.filter(more, accepted), lambda c: F.struct(c.kind, c.start, c.stop))
    return F.array_sort(F.array_distinct(F.concat(base, let(kept, longest))))


def spans(docs: DataFrame, text: str = "text", base: str = "base", name: str = "spans") -> DataFrame:
    """The rows without their text, with their base spans and all spans (structs of kind, start, stop)."""
    more = fresh("more", [*docs.columns, base, name])
    found = settle(proposed(docs, text, base, more).drop(text), "candidates")
    models = fit(found, more)
    return found.withColumn(name, selected(col(base), col(more), models)).drop(more)


def joined(array: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", F.element_at(kinds, s.kind + 1), s.start, s.stop)), ",")


def counted(array: Column, kind: int) -> Column:
    return F.size(F.filter(array, lambda s: s.kind == kind)).cast("long")


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns of doc_id, base and spans."""
    return found.select(
        "doc_id",
        *[counted(F.col("base"), k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def redacted(text: Column, found: Column) -> Column:
    """The text with every span replaced by its kind's placeholder; spans that overlap become one, of the first's kind."""
    none = F.array().cast(f"array<{SPAN}>")
    by_start = F.array_sort(F.transform(found, lambda s: F.struct(s.start.alias("start"), s.stop.alias("stop"), s.kind.alias("kind"))))
    merged = F.aggregate(
        by_start,
        none,
        lambda a, s: F.when(
            (F.size(a) > 0) & (s.start < F.try_element_at(a, F.lit(-1)).stop),
            F.concat(
                F.slice(a, F.lit(1), F.size(a) - 1),
                F.array(F.struct(
                    F.try_element_at(a, F.lit(-1)).kind.alias("kind"),
                    F.try_element_at(a, F.lit(-1)).start.alias("start"),
                    F.greatest(F.try_element_at(a, F.lit(-1)).stop, s.stop).alias("stop"),
                )),
            ),
        ).otherwise(F.concat(a, F.array(F.struct(s.kind.alias("kind"), s.start.alias("start"), s.stop.alias("stop"))))),
    )
    marks = F.array(*map(F.lit, PLACEHOLDERS))

    def pieces(m: Column) -> Column:
        ends = F.concat(F.array(F.lit(0)), F.transform(m, lambda s: s.stop))
        inner = F.transform(m, lambda s, i: F.concat(
            F.substring(text, F.element_at(ends, i + 1) + 1, s.start - F.element_at(ends, i + 1)), F.element_at(marks, s.kind + 1)
        ))
        last = F.element_at(ends, -1)
        return F.array_join(F.concat(inner, F.array(F.substring(text, last + 1, F.length(text) - last))), "")

    return F.when(F.size(found) > 0, let(merged, pieces)).otherwise(text)


def redact(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The rows with their personal data replaced, and with the new length where there is such a column."""
    base, more, name = (fresh(n, docs.columns) for n in ("base", "more", "spans"))
    narrow = proposed(docs.select(col(text).alias("text")), "text", "base", "more").select("more")
    models = fit(settle(narrow.where(F.size("more") > 0), "candidates"), "more")
    rows = proposed(docs, text, base, more).withColumn(name, selected(col(base), col(more), models))
    rows = rows.withColumn(text, redacted(col(text), col(name)))
    if length in docs.columns:
        changed = F.size(col(name)) > 0
        rows = rows.withColumn(length, F.when(changed, F.length(col(text)).cast(docs.schema[length].dataType)).otherwise(col(length)))
    return rows.select(*[col(c) for c in docs.columns])
