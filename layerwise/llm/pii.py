"""Personal data: validated patterns, and boosted trees over candidate spans, in DataFrame functions only.

*Base spans* are the leftmost non-overlapping matches of four patterns (e-mail, ip, card, phone)
that pass their validation; they always stay.

*Candidates* come from high-recall generators that propose further, possibly overlapping spans:
written-out e-mail addresses, phone-shaped and card-shaped digit groups, number runs, dotted
numbers and long keys.  Each candidate has format and context features, all small integers, none
of which tells whether a base span was validated.  A candidate that covers the same digits or
address as a base span of its kind is a positive example, one that covers a match which failed
validation or nothing at all a negative one.  Counting examples per distinct feature vector is one
aggregate over all documents; of its result, the ``MAX_CELLS`` most frequent rows of each kind are
what the trees are boosted on, so fitting costs the same however large the corpus is.  One fifth of
the documents, by a hash of their text, is kept out of the fit; on all its candidates the smallest
score is chosen, per kind, above which the share of positives is at least ``PRECISION``.  A kind
without such a score, or with under ``LEAST_POSITIVES`` positives to fit to, adds no spans.

The fitted trees are plain ``CASE`` expressions.  Candidates over their kind's threshold that
touch no base span become added spans, taken from the highest score down: one that overlaps a
span already taken is left out.

Offsets count code points, ends are exclusive.  Null texts count as empty, and a null ``doc_id`` is
kept; repeated rows each give a row; other columns are not read, and are kept by ``find`` and ``redact``;
empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored, whole_text

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "key")

# The contract's patterns.  Possessive loops and the look-behind change no match - what follows a
# loop can't begin with what the loop takes, and a start inside a run fails like the run's first -
# but keep long runs from costing stack or quadratic time.
BASE_PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap test that every text with a match passes.
GUARDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}

#: Generators: (kind, pattern, guard).  They overlap one another and the base patterns on purpose.
GENERATORS = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?"
              r"[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++", r"@|\(at\)|\[at\]"),
    ("ip", r"(?<![0-9.])[0-9]{1,4}(?:\.[0-9]{1,4}){2,5}(?![0-9])", r"[0-9]\.[0-9]"),
    ("card", r"(?<![0-9-])[0-9]{4}[\x20-]?[0-9]{4,6}[\x20-]?[0-9]{4,5}(?:[\x20-]?[0-9]{1,4})?(?![0-9])", r"[0-9]{4}"),
    ("phone", r"(?<![0-9])(?:[0-9]{1,3}[\x20.-]?)?\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])", r"[0-9]{4}"),
    ("phone", r"(?<![0-9])[0-9(][0-9().\x20-]{7,20}[0-9](?![0-9])", r"[0-9][().\x20-]*[0-9]"),
    ("key", r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{16,}+", r"[A-Za-z0-9_-]{16}"),
)
#: Code points after which a text is cut at the next safe place.
SEGMENT = 1024
_PIECE = r"(?s).{%d,}?(?:[^A-Za-z0-9._%%+\-@()\[\]\x20]|[A-Za-z](?=\x20[A-Za-z]))|(?s).+\z" % SEGMENT
CONTEXT = 24
MAX_CELLS = 20_000
PRECISION = 0.95
TREES = 24
RATE = 0.4
LEAST_POSITIVES = 1

_SPAN = "struct<kind:string,start:int,end:int,text:string>"


def _located(text: Column, kind: str, pattern: str, guard: str) -> Column:
    """Leftmost non-overlapping matches as an array of spans.

    The parts between the matches and the matches themselves alternate; their lengths give the offsets.
    """
    parts = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["part"])
        end = start + F.length(pair["found"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), pair["found"].alias("text"))
        return F.struct(
            F.coalesce(end, start).alias("at"),
            F.when(pair["found"].isNull(), state["spans"]).otherwise(F.concat(state["spans"], F.array(span))).alias("spans"))

    pairs = F.zip_with(parts, found, lambda part, match: F.struct(part.alias("part"), match.alias("found")))
    return F.when(text.rlike(guard), F.aggregate(pairs, nothing, add)["spans"]) \
        .otherwise(F.array().cast(f"array<{_SPAN}>"))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    size = F.length(digits)

    def add(total: Column, place: Column) -> Column:  # place counts from the last digit
        digit = F.substring(digits, size - place + 1, F.lit(1)).cast("int")
        return total + F.when(place % 2 == 1, digit).otherwise(digit * 2 - F.when(digit > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), F.lit(0), add) % 10 == 0


def _valid(span: Column, kind: str) -> Column:
    text = span["text"]
    count = F.length(_digits(text))
    if kind == "ip":
        # of a part's digits after leading zeros four are enough to tell that it is too large
        return F.forall(F.split(text, r"\."), lambda part: F.substring(
            F.regexp_replace(part, "^0+(?=.)", ""), 1, 4).cast("int") <= 255)
    if kind == "card":
        return F.when((count >= 13) & (count <= 19), _luhn(_digits(text))).otherwise(False)
    if kind == "phone":
        return (count >= 9) & (count <= 15)
    return F.lit(True)


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def _valid_as(kind: str):
    return lambda span: _valid(span, kind)


def _segments(text: Column) -> Column:
    """``text`` in pieces (text, at: code points before it) of ``SEGMENT`` code points and up to the next place that
    no pattern or generator can cross: after a sign that none of them takes, or between a letter and a space and
    another letter.  A text without such a place is one piece."""
    pieces = F.when(F.length(text) <= SEGMENT, F.array(text)).otherwise(
        F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0)))
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<text:string,at:int>>").alias("pieces"))
    return F.aggregate(pieces, none, lambda state, piece: F.struct(
        (state["at"] + F.length(piece)).alias("at"),
        F.concat(state["pieces"], F.array(F.struct(piece.alias("text"), state["at"].alias("at")))).alias("pieces")),
        lambda state: state["pieces"])


def _each(docs: DataFrame, *fields: tuple[str, Callable[[Column], Column]]) -> DataFrame:
    """``docs`` with further fields in every piece."""
    def extend(piece: Column) -> Column:
        return reduce(lambda out, f: out.withField(f[0], f[1](piece)), fields, piece)

    return docs.withColumn("_seg", F.transform("_seg", extend))


def _gathered(name: str, place: Callable[[Column, Column], Column]) -> Column:
    """The spans in field ``name`` of all pieces, each turned by ``place(span, code points before its piece)``."""
    return F.flatten(F.transform("_seg", lambda piece: F.transform(piece[name], lambda span: place(span, piece["at"]))))


def _with_base(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_text`` and its pieces ``_seg``, which hold every base match per kind (``m_<kind>``) and the
    valid ones (``b_<kind>``); places count from the begin of the piece."""
    def matches(kind: str):
        return lambda piece: _located(piece["text"], kind, BASE_PATTERNS[kind], GUARDS[kind])

    def valid(kind: str):
        return lambda piece: F.filter(piece[f"m_{kind}"], _valid_as(kind))

    out = docs.withColumn("_text", whole_text()).withColumn("_seg", _segments(F.col("_text")))
    out = _each(out, *[(f"m_{k}", matches(k)) for k in BASE_KINDS])
    return _each(out, *[(f"b_{k}", valid(k)) for k in BASE_KINDS])


# -- candidates ---------------------------------------------------------------------------------

#: Features of a candidate and the number of values each may take.
FEATURES = {"generator": len(GENERATORS), "length": 8, "digits": 8, "groups": 6, "marks": 5, "distinct": 5,
            "before": 5, "after": 5, "cue": 3}


def _bin(value: Column, *edges: int) -> Column:
    """How many of ``edges`` the value reaches."""
    return reduce(lambda a, b: a + b, [(value >= e).cast("int") for e in edges])


def _neighbour(sign: Column) -> Column:
    return F.when(sign == "", 0).when(sign.rlike(r"\A\s\z"), 1).when(sign.rlike(r"\A[A-Za-z0-9]\z"), 2) \
        .when(sign.rlike(r"\A[.,;:!?]\z"), 3).otherwise(4)


def _features(text: Column, span: Column, generator: int) -> Column:
    match = span["text"]
    digits = _digits(match)
    marks = F.regexp_replace(match, r"[A-Za-z0-9]", "")
    before = F.when(span["start"] > 0, F.substring(text, F.greatest(span["start"] - CONTEXT + 1, F.lit(1)),
                                                   F.least(span["start"], F.lit(CONTEXT)))).otherwise("")
    after = F.substring(text, span["end"] + 1, F.lit(1))
    # a plus before a number would tell the validated phones apart: the sign before it is looked at instead
    before = F.regexp_replace(before, r"\+\z", "")
    cue = F.when(before.rlike(r"(?i)(?:e-?mail|phone|call|tel|fax|mobile|card|visa|host|addr|contact|ip)\W{0,3}\z"), 2) \
        .when(before.rlike(r"(?i)(?:version|v|no|nr|page|chapter|section|isbn|date|year)\W{0,3}\z"), 1).otherwise(0)
    return F.struct(
        F.lit(generator).alias("generator"),
        _bin(F.length(match), 8, 10, 12, 14, 16, 20, 32).alias("length"),
        _bin(F.length(digits), 1, 4, 9, 10, 12, 13, 17).alias("digits"),
        _bin(F.size(F.split(F.regexp_replace(match, r"\A[^0-9]+|[^0-9]+\z", ""), r"[^0-9]+")), 2, 3, 4, 5, 7).alias("groups"),
        F.when(marks == "", 0).when(marks.rlike(r"\A[.]+\z"), 1).when(marks.rlike(r"\A[-\x20]+\z"), 2)
        .when(F.contains(marks, F.lit("@")), 3).otherwise(4).alias("marks"),
        _bin(F.size(F.array_distinct(F.split(digits, ""))), 2, 4, 6, 8).alias("distinct"),
        _neighbour(F.substring(before, -1, 1)).alias("before"),
        _neighbour(after).alias("after"),
        cue.alias("cue"))


def _with_candidates(docs: DataFrame) -> DataFrame:
    """``_with_base`` plus every generator's spans with their features, and whether a base span covers the same
    digits or address (``hit``: 1, or 0): ``cand`` in each piece, ``_cand`` for the whole text."""
    def generated(i: int):
        kind, pattern, guard = GENERATORS[i]
        return lambda piece: _located(piece["text"], kind, pattern, guard)

    def described(piece: Column, i: int, kind: str) -> Column:
        def describe(span: Column) -> Column:
            same = F.exists(piece[f"b_{kind}"], lambda b: (b["end"] == span["end"]) & (b["start"] <= span["start"])
                            & (span["start"] - b["start"] <= 1)) if kind in BASE_KINDS else \
                span["text"].rlike(r"\A(?:AKIA[0-9A-Z]{16}|[0-9a-f]{32,64})\z")
            return F.struct(F.lit(kind).alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
                            _features(piece["text"], span, i).alias("f"), same.cast("int").alias("hit"))

        return F.transform(piece[f"g_{i}"], describe)

    out = _each(_with_base(docs), *[(f"g_{i}", generated(i)) for i in range(len(GENERATORS))])
    out = _each(out, ("cand", lambda piece: F.concat(
        *[described(piece, i, kind) for i, (kind, _, _) in enumerate(GENERATORS)])))
    return out.withColumn("_cand", _gathered("cand", lambda c, at: F.struct(
        c["kind"].alias("kind"), (c["start"] + at).alias("start"), (c["end"] + at).alias("end"), c["f"].alias("f"),
        c["hit"].alias("hit"))))


# -- boosted trees ------------------------------------------------------------------------------


@dataclass
class Trees:
    """Trees of depth two: ``(feature, least, (feature, least, low, high) or leaf, likewise)``."""

    start: dict[str, float] = field(default_factory=dict)
    trees: dict[str, list] = field(default_factory=dict)
    thresholds: dict[str, float] = field(default_factory=dict)

    def value(self, kind: str, cell: dict) -> float:
        total = self.start.get(kind, 0.0)
        for name, least, low, high in self.trees.get(kind, ()):
            name, least, a, b = high if cell[name] >= least else low
            total += b if cell[name] >= least else a
        return total

    def expression(self, kind: str, features: Column) -> Column:
        total = F.lit(self.start.get(kind, 0.0))
        for name, least, low, high in self.trees.get(kind, ()):
            def leaf(split: tuple) -> Column:
                return F.when(features[split[0]] >= split[1], split[3]).otherwise(split[2])
            total = total + F.when(features[name] >= least, leaf(high)).otherwise(leaf(low))
        return total


def _best_split(cells: list, gradient: list[float], curve: list[float]) -> tuple:
    """The split of ``cells`` with the largest gain: (gain, feature, least, low value, high value)."""
    g_all, h_all = sum(gradient), sum(curve)
    best = None
    for name, values in FEATURES.items():
        g, h = [0.0] * (values + 1), [0.0] * (values + 1)
        for (cell, *_), a, b in zip(cells, gradient, curve):
            g[cell[name]] += a
            h[cell[name]] += b
        low_g = low_h = 0.0
        for least in range(1, values + 1):
            low_g += g[least - 1]
            low_h += h[least - 1]
            high_g, high_h = g_all - low_g, h_all - low_h
            gain = low_g ** 2 / (low_h + 1) + high_g ** 2 / (high_h + 1)
            if best is None or gain > best[0] + 1e-12:
                best = (gain, name, least, RATE * low_g / (low_h + 1), RATE * high_g / (high_h + 1))
    return best


def boost(cells: list[tuple[dict, int, int]]) -> tuple[float, list]:
    """Logistic boosting over ``(features, positives, negatives)`` cells."""
    positives, negatives = sum(p for _, p, _ in cells), sum(n for _, _, n in cells)
    start = math.log((positives + 1) / (negatives + 1))
    score = [start] * len(cells)
    trees = []
    for _ in range(TREES):
        chance = [1 / (1 + math.exp(-s)) for s in score]
        gradient = [p - (p + n) * c for (_, p, n), c in zip(cells, chance)]
        curve = [(p + n) * c * (1 - c) for (_, p, n), c in zip(cells, chance)]
        _, name, least, low_value, high_value = _best_split(cells, gradient, curve)
        sides = []
        for above, value in ((False, low_value), (True, high_value)):
            own = [i for i, (cell, *_) in enumerate(cells) if (cell[name] >= least) == above]
            if own:
                _, f, at, a, b = _best_split([cells[i] for i in own], [gradient[i] for i in own], [curve[i] for i in own])
                sides.append((f, at, a, b))
            else:
                sides.append((name, least, value, value))
        trees.append((name, least, *sides))
        for i, (cell, *_) in enumerate(cells):
            f, at, a, b = sides[cell[name] >= least]
            score[i] += b if cell[f] >= at else a
    return start, trees


def fit(docs: DataFrame) -> Trees:
    """Boosted trees from the most frequent cells of each kind, thresholds from all held-out candidates."""
    held = (F.pmod(F.xxhash64("_text"), F.lit(5)) == 0).alias("held")
    cells = stored(
        _with_candidates(docs.select("text")).select(held, F.explode("_cand").alias("c"))
        .groupBy("held", F.col("c.kind").alias("kind"), F.col("c.f").alias("f"))
        .agg(F.sum(F.col("c.hit")).alias("positives"), F.count(F.lit(1)).alias("rows")), "pii-cells")
    model = Trees()
    for kind in KINDS:
        used = [(row["f"].asDict(), row["positives"], row["rows"] - row["positives"])
                for row in cells.filter(~F.col("held") & (F.col("kind") == kind))
                .orderBy(F.desc("rows"), "f").limit(MAX_CELLS).collect()]  # the documented bound of the fit
        if sum(p for _, p, _ in used) >= LEAST_POSITIVES:
            model.start[kind], model.trees[kind] = boost(used)
    if not model.trees:
        return model
    scored = reduce(DataFrame.union, [
        cells.filter(F.col("held") & (F.col("kind") == kind))
        .select("kind", model.expression(kind, F.col("f")).alias("score"), "positives", "rows") for kind in model.trees])
    seen: dict[str, tuple[int, int]] = {}
    for row in scored.groupBy("kind", "score").agg(F.sum("positives").alias("positives"), F.sum("rows").alias("rows")) \
            .orderBy("kind", F.desc("score")).toLocalIterator():  # one partition of distinct scores at a time
        positives, count = seen.get(row["kind"], (0, 0))
        positives, count = seen[row["kind"]] = positives + row["positives"], count + row["rows"]
        if positives and positives / count >= PRECISION:
            model.thresholds[row["kind"]] = row["score"]
    return model


# -- results ------------------------------------------------------------------------------------


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


_PLACE = "struct<kind:string,start:int,end:int>"


def _disjoint(spans: Column) -> Column:
    """``spans`` by falling score, then longer, earlier, and by kind, less those that overlap one kept before."""
    rank = F.transform(spans, lambda s: F.struct(
        s["score"].alias("score"), (s["end"] - s["start"]).alias("length"), (-s["start"]).alias("early"),
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    none = F.array().cast("array<struct<score:double,length:int,early:int,kind:string,start:int,end:int>>")
    return F.aggregate(F.sort_array(rank, asc=False), none, lambda kept, s: F.when(
        F.exists(kept, lambda k: _overlap(k, s)), kept).otherwise(F.concat(kept, F.array(s))))


def _with_spans(docs: DataFrame, model: Trees) -> DataFrame:
    """``_with_candidates`` with the valid base spans of each piece (``base``) and the spans added to them (``added``).

    No span crosses a piece, so what overlaps what is settled within pieces."""
    def scored(piece: Column, kind: str, threshold: float) -> Column:
        free = F.filter(piece["cand"], lambda c: (c["kind"] == kind) & ~F.exists(piece["base"], lambda b: _overlap(b, c)))
        rated = F.transform(free, lambda c: F.struct(
            model.expression(kind, c["f"]).alias("score"), c["start"].alias("start"), c["end"].alias("end"),
            c["kind"].alias("kind")))
        return F.filter(rated, lambda s: s["score"] >= threshold)

    def place(span: Column) -> Column:
        return F.struct(span["kind"].alias("kind"), span["start"].alias("start"), span["end"].alias("end"))

    none = F.array().cast("array<struct<score:double,start:int,end:int,kind:string>>")
    out = _each(_with_candidates(docs), ("base", lambda piece: F.concat(
        *[F.transform(piece[f"b_{k}"], place) for k in BASE_KINDS])))
    out = _each(out, ("rated", lambda piece: F.concat(none, *[scored(piece, k, t) for k, t in model.thresholds.items()])))
    return _each(out, ("added", lambda piece: F.transform(_disjoint(piece["rated"]), place)))


def find(docs: DataFrame, model: Trees | None = None) -> DataFrame:
    """``docs`` with ``base`` and ``added``: arrays of (kind, start, end), by kind as listed, then start.

    Columns of these names that ``docs`` has are replaced."""
    model = model or fit(docs)
    out = _with_spans(docs, model)
    columns = [c for c in docs.columns if c not in ("base", "added")]

    def by_kind(name: str) -> Column:
        moved = _gathered(name, lambda s, at: F.struct(
            (s["start"] + at).alias("start"), (s["end"] + at).alias("end"), s["kind"].alias("kind")))
        kinds = [F.sort_array(F.filter("_all", _of_kind(kind))) for kind in KINDS]
        return moved, F.transform(F.concat(*kinds), lambda s: F.struct(s["kind"], s["start"], s["end"])).cast(f"array<{_PLACE}>")

    for name, result in (("base", "_base"), ("added", "_added")):
        moved, ordered = by_kind(name)
        out = out.withColumn("_all", moved).withColumn(result, ordered)
    return out.select(*[F.col(f"`{c}`") for c in columns], F.col("_base").alias("base"), F.col("_added").alias("added"))


def digest(docs: DataFrame) -> DataFrame:
    """Counts and spans of every document; ``learnt`` lists the kinds whose trees may add spans."""
    docs = docs.select("doc_id", "text")
    model = fit(docs)
    found = find(docs, model)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", _of_kind(kind))).cast("long").alias(f"n_{kind}")

    every = F.concat(*[F.array_sort(F.filter(F.concat("base", "added"), _of_kind(kind)),
                                    lambda a, b: a["start"] - b["start"]) for kind in KINDS])
    return found.select("doc_id", *[count(k) for k in BASE_KINDS],
                        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(every).alias("spans"),
                        F.lit(",".join(k for k in KINDS if k in model.thresholds)).alias("learnt"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets; all columns kept, nulls stay null."""
    columns = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), "text")
    found = _with_spans(row, fit(row))

    def cleaned(piece: Column) -> Column:
        spans = F.sort_array(F.transform(F.concat(piece["base"], piece["added"]), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
        text = piece["text"]

        def step(state: Column, span: Column) -> Column:
            """Overlapping spans become one gap, named after the first."""
            fresh = span["start"] >= state["at"]
            return F.struct(
                F.greatest(state["at"], span["end"]).alias("at"),
                F.when(fresh, F.concat(state["out"], F.substring(text, state["at"] + 1, span["start"] - state["at"]),
                                       F.lit("["), F.upper(span["kind"]), F.lit("]"))).otherwise(state["out"]).alias("out"))

        return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                           lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))

    # a null text has one empty piece; it stays null
    clean = F.when(F.col("text").isNotNull(), F.array_join(F.transform("_seg", cleaned), ""))
    return found.withColumn("_clean", clean).select(
        *[F.col("_clean").alias("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in columns])
