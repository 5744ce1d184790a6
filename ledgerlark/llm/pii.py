"""Personal data: fixed patterns, and spans that boosted trees add to them.

Everything runs as DataFrame and SQL functions. The fixed patterns give the base
spans of a text. Wider patterns propose candidate spans, which may overlap each other but no
base span, and touch no letter or digit; format and context put each into a cell of a
bounded grid, and the counts of the cells over the whole corpus are all that the trees are
trained on, by gradient boosting with logistic loss. What they are to tell apart is what
they may add: positives are base spans rewritten in ways that hide them from their pattern
(an address with ``(at)``, a number without its ``+`` or with a wrong check digit), each in
the context where it was found; negatives are the candidates as they are. Half of the
documents train, the other half sets each kind's threshold at the wanted precision. A kind
that never reaches it adds nothing.

A match never needs a position of its own: the lengths of the pieces between the
matches and of the matches themselves add up to it, and the pieces hold its context.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ledgerlark.llm.common import texts_of, whole_row, whole_text
from ledgerlark.session import materialise

#: In the order in which spans at one place are listed.
KINDS = ["email", "ip", "card", "phone"]

# The fixed patterns. Possessive repeats and the look at the character before only
# keep a failing search from starting again inside the same run; what matches is
# what the plain patterns match.
_NAME = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_NAME}]))[{_NAME}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Wider ones: other ways to write the same.
WIDE = {
    "email": rf"(?:\G|(?<![{_NAME}]))[{_NAME}]++\x20?(?:@|[(\[]at[)\]])\x20?[A-Za-z0-9-]++"
             r"(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]++)*+",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:[.:][0-9]++){3}+",
    "card": r"[0-9](?:[\x20./-]?[0-9])++",
    "phone": r"(?:\+|00)?\(?[0-9][\x20().0-9/-]{5,}[0-9]",
}
_DIGITS = {"email": (0, 10**6), "ip": (4, 12), "card": (12, 19), "phone": (7, 15)}
# Texts without these hold no match of the kind.
_NEEDS = {"email": r"@|[(\[]at[)\]]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
CUES = r"(?i)(?:mail|phone|tel|call|mobile|fax|card|visa|account|\bip|host|addr\w*)\W{0,3}$"

#: Upper borders of the bins of each feature; a value above the last is one more bin.
BINS = {
    "digits": [0, 6, 9, 11, 13, 15, 16, 19],
    "marks": [0, 1, 2, 3],
    "opens": [0, 1],
    "cue": [0],
    "before": [0, 1],
    "after": [0, 1],
    "longest": [0, 3, 4, 9, 13],
    "plain": [0],
}

_SPAN = "array<struct<s:int,e:int,v:string,b:string,a:string>>"
_CONTEXT = 24
_BLOCK = 256


def _with_found(rows: DataFrame, patterns: dict[str, str], prefix: str) -> DataFrame:
    """``rows`` with all matches of ``text`` for each kind, left to right, as ``prefix`` and the
    kind: place, value, and the characters before and after.

    The ends of the matches are running sums of lengths, taken in blocks, so that a text with
    any number of matches costs in proportion. Each step is a column that is read more than
    once, which keeps Spark from computing it again for every element.
    """
    nothing = F.array().cast("array<string>")
    blank = F.array(F.lit(""))
    kept = rows.columns

    def each(name: str, make) -> dict[str, Column]:
        return {f"{name}_{kind}": make(kind) for kind in patterns}

    def needed(kind: str, value: Column) -> Column:
        return F.when(F.col("text").rlike(_NEEDS[kind]), value).otherwise(nothing)

    def firsts(kind: str, values: Column, start: int = 1) -> Column:
        return F.slice(values, F.lit(start), F.size(f"_hits_{kind}"))

    def ends(kind: str) -> Column:
        return F.flatten(F.zip_with(
            F.col(f"_blocks_{kind}"), F.slice(f"_before_{kind}", F.lit(1), F.size(f"_blocks_{kind}")),
            lambda block, before: F.aggregate(
                block, F.array().cast("array<int>"),
                lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), before) + x)),
            ),
        ))

    def around(kind: str) -> Column:
        """Each match between the piece and the match before it and those behind it."""
        hits, pieces = F.col(f"_hits_{kind}"), F.col(f"_pieces_{kind}")
        return F.arrays_zip(
            hits.alias("h"), firsts(kind, pieces).alias("p"), firsts(kind, pieces, 2).alias("q"),
            firsts(kind, F.concat(blank, hits)).alias("before"),
            firsts(kind, F.concat(hits, blank), 2).alias("behind"), ends(kind).alias("e"),
        )

    def placed(x: Column) -> Column:
        return F.struct(
            (x["e"] - F.length(x["h"])).alias("s"), x["e"].alias("e"), x["h"].alias("v"),
            F.right(F.concat(F.right(x["before"], F.lit(1)), x["p"]), F.lit(_CONTEXT)).alias("b"),
            F.left(F.concat(x["q"], x["behind"]), F.lit(1)).alias("a"),
        )

    rows = rows.withColumns(
        each("_hits", lambda kind: needed(kind, F.regexp_extract_all("text", F.lit(patterns[kind]), F.lit(0))))
        | each("_pieces", lambda kind: needed(kind, F.split("text", patterns[kind], -1)))
    )
    rows = rows.withColumns(each("_sizes", lambda kind: F.zip_with(
        firsts(kind, F.col(f"_pieces_{kind}")), F.col(f"_hits_{kind}"), lambda p, h: F.length(p) + F.length(h)
    )))
    rows = rows.withColumns(each("_blocks", lambda kind: F.transform(
        F.sequence(F.lit(0), F.expr(f"(size(_sizes_{kind}) - 1) div {_BLOCK}").cast("int")),
        lambda i: F.slice(f"_sizes_{kind}", i * _BLOCK + 1, F.lit(_BLOCK)),
    )))
    rows = rows.withColumns(each("_before", lambda kind: F.aggregate(
        F.transform(f"_blocks_{kind}", lambda block: F.aggregate(block, F.lit(0), lambda acc, x: acc + x)),
        F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)),
    )))
    return rows.select(*kept, *[F.transform(around(kind), placed).alias(f"{prefix}_{kind}") for kind in patterns])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether the digits pass: from the right, every second one doubled."""
    turned = F.reverse(_digits(value))
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(turned)), F.lit(0),
        lambda acc, i: acc + _luhn_digit(turned, i),
    )
    return total % 10 == 0


def _luhn_digit(turned: Column, i: Column) -> Column:
    digit = F.substring(turned, i, F.lit(1)).cast("int")
    twice = digit * 2
    doubled = F.when(twice > 9, twice - 9).otherwise(twice)
    return F.when(i % 2 == 0, doubled).otherwise(digit)


def _small_part(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+", "")
    return (F.length(bare) <= 3) & (F.concat(F.lit("0"), F.substring(bare, 1, 4)).cast("int") <= 255)


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    return {
        "email": F.lit(True),
        "ip": F.forall(F.split(value, "[.]"), _small_part),
        "card": F.when(n.between(14, 19), _luhn(value)).otherwise(False),
        "phone": n.between(10, 15),
    }[kind]


def _bin(name: str, value: Column) -> Column:
    out = F.lit(len(BINS[name]))
    for i in range(len(BINS[name]) - 1, -1, -1):
        out = F.when(value <= BINS[name][i], i).otherwise(out)
    return out


def _side(char: Column) -> Column:
    """0 for none or white space, 1 for a letter or digit, 2 for a mark."""
    return F.when(char.rlike(r"^\s*$"), 0).when(char.rlike(r"^[\p{L}\p{N}]"), 1).otherwise(2)


def _candidate(kind: str, c: Column, label: int) -> Column:
    """A candidate with its cell and its label."""
    value = c["v"]
    groups = F.filter(F.split(value, "[^0-9]+"), lambda g: g != "")
    opens = F.when(value.rlike(r"^(?:\+|00)"), 2).when(value.startswith("("), 1).otherwise(0)
    return F.struct(
        c["s"].alias("s"), c["e"].alias("e"), F.lit(KINDS.index(kind)).alias("k"), F.lit(label).alias("label"),
        _bin("digits", F.length(_digits(value))).alias("digits"),
        _bin("marks", F.length(F.regexp_replace(value, "[A-Za-z0-9]", ""))).alias("marks"),
        _bin("opens", opens).alias("opens"),
        _bin("cue", c["b"].rlike(CUES).cast("int")).alias("cue"),
        _bin("before", _side(F.right(c["b"], F.lit(1)))).alias("before"),
        _bin("after", _side(c["a"])).alias("after"),
        _bin("longest", F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0))).alias("longest"),
        _bin("plain", value.contains("@").cast("int")).alias("plain"),
    )


def _rewritten(kind: str, value: Column) -> Column:
    """A base match in a form that its pattern does not find, one of two by the match's own hash."""
    even = F.pmod(F.xxhash64(value), F.lit(2)) == 0
    last = F.right(value, F.lit(1)).cast("int")
    wrong = F.concat(F.substr(value, F.lit(1), F.length(value) - 1), ((last + 1) % 10).cast("string"))
    return {
        "email": F.when(even, F.regexp_replace(value, "@", " (at) ")).otherwise(
            F.regexp_replace(F.regexp_replace(value, "@", " [at] "), r"\.(?=[A-Za-z0-9-]+$)", " [dot] ")),
        "ip": F.regexp_replace(value, r"\.", ":"),
        "card": F.when(even & value.rlike("[ -]"), F.regexp_replace(value, "[ -]", ".")).otherwise(wrong),
        "phone": F.regexp_replace(value, r"^\+", F.when(even, F.lit("")).otherwise(F.lit("00"))),
    }[kind]


def _check(kind: str):
    return lambda c: _valid(kind, c["v"])


def _possible(kind: str):
    """A candidate of a length that the kind can have, and no piece of a longer word or number."""
    side = r"^[\p{L}\p{N}]"
    return lambda c: (
        F.length(_digits(c["v"])).between(*_DIGITS[kind])
        & ~F.right(c["b"], F.lit(1)).rlike(side) & ~c["a"].rlike(side)
    )


def _clear(base: Column, wide: Column) -> Column:
    """The candidates that meet no base span, by one walk over both in the order of their starts.

    A candidate is held until something starts behind it, since a base span may begin
    inside it; candidates of one kind never overlap, so one is held at a time.
    """
    place = F.struct(F.lit(None).cast("int").alias("s"), F.lit(None).cast("int").alias("e"),
                     F.lit("").alias("v"), F.lit("").alias("b"), F.lit("").alias("a"))
    both = F.array_sort(F.concat(
        F.transform(base, lambda x: F.struct(x["s"].alias("s"), F.lit(0).alias("t"), x["e"].alias("e"), place.alias("c"))),
        F.transform(wide, lambda x: F.struct(x["s"].alias("s"), F.lit(1).alias("t"), x["e"].alias("e"), x.alias("c"))),
    ))

    def step(acc: Column, x: Column) -> Column:
        is_base = x["t"] == 0
        held = acc["held"]["s"].isNotNull()
        none = place
        keeps = held & is_base & (x["s"] >= acc["held"]["e"])
        gives = held & (~is_base | keeps)
        return F.struct(
            F.when(is_base, F.greatest(acc["reach"], x["e"])).otherwise(acc["reach"]).alias("reach"),
            F.when(is_base | (acc["reach"] > x["s"]), none).otherwise(x["c"]).alias("held"),
            F.when(gives, F.concat(acc["out"], F.array(acc["held"]))).otherwise(acc["out"]).alias("out"),
        )

    def end(acc: Column) -> Column:
        return F.when(acc["held"]["s"].isNotNull(), F.concat(acc["out"], F.array(acc["held"]))).otherwise(acc["out"])

    start = F.struct(F.lit(0).alias("reach"), place.alias("held"), F.array().cast(_SPAN).alias("out"))
    return F.aggregate(both, start, step, end)


def _described(kind: str, label: int):
    return lambda c: _candidate(kind, c, label)


def _hidden(kind: str):
    def rewrite(c: Column) -> Column:
        return F.struct(c["s"].alias("s"), c["e"].alias("e"), _rewritten(kind, c["v"]).alias("v"),
                        c["b"].alias("b"), c["a"].alias("a"))

    return F.transform(F.transform(F.col(kind), rewrite), _described(kind, 1))


def find_spans(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", whole_rows: bool = False
) -> DataFrame:
    """``doc_id``, base spans per kind, candidates that meet none, and base spans as they would
    look in hiding, for every row; with ``whole_rows`` also the whole ``row``."""
    if whole_rows:
        out = docs.select(F.lit(None).cast("bigint").alias("doc_id"), whole_text(text_column).alias("text"),
                          whole_row(docs))
    else:
        out = texts_of(docs, id_column, text_column)
    out = _with_found(out, BASE, "raw")
    out = out.withColumns({kind: F.filter(f"raw_{kind}", _check(kind)) for kind in KINDS})

    def plain(kind: str) -> Column:
        number = F.lit(KINDS.index(kind))
        return F.transform(kind, lambda c: F.struct(c["s"].alias("s"), number.alias("k"), c["e"].alias("e")))

    out = out.withColumn("base", F.array_sort(F.concat(*map(plain, KINDS))))
    out = _with_found(out, WIDE, "near")
    out = out.withColumns({f"wide_{kind}": F.filter(f"near_{kind}", _possible(kind)) for kind in KINDS})
    out = out.withColumns({f"clear_{kind}": _clear(F.col("base"), F.col(f"wide_{kind}")) for kind in KINDS})
    return out.select(
        "doc_id", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("fold"),
        *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS],
        "base",
        F.concat(*[F.transform(f"clear_{kind}", _described(kind, 0)) for kind in KINDS]).alias("wide"),
        F.concat(*map(_hidden, KINDS)).alias("hidden"),
        *(["row"] if whole_rows else []),
    )


FEATURES = ["k", *BINS]


@dataclass
class Node:
    """A split (feature, border, below, above), or a leaf with its value."""

    value: float = 0.0
    split: tuple[str, int, Node, Node] | None = None

    def of(self, row: Row) -> float:
        if self.split is None:
            return self.value
        feature, border, below, above = self.split
        return (below if row[feature] <= border else above).of(row)

    def column(self, c: Column) -> Column:
        if self.split is None:
            return F.lit(self.value)
        feature, border, below, above = self.split
        return F.when(c[feature] <= border, below.column(c)).otherwise(above.column(c))


@dataclass
class Model:
    prior: float = 0.0
    trees: list[Node] = field(default_factory=list)
    thresholds: dict[int, float] = field(default_factory=dict)

    def score(self, row: Row) -> float:
        return self.prior + sum(tree.of(row) for tree in self.trees)

    def selects(self, c: Column) -> Column:
        """Whether the candidate's score reaches its kind's threshold."""
        score = F.lit(self.prior)
        for tree in self.trees:
            score = score + tree.column(c)
        chosen = F.lit(False)
        for k, least in self.thresholds.items():
            chosen = chosen | ((c["k"] == k) & (score >= F.lit(least - 1e-9)))
        return chosen


def _chance(score: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, score))))


def _grow(cells: list[tuple[Row, float, float]], depth: int, rate: float) -> Node:
    """A tree over (cell, gradient, curvature) that reduces the loss the most."""
    ridge = 1.0
    g, h = sum(c[1] for c in cells), sum(c[2] for c in cells)
    leaf = Node(rate * g / (h + ridge))
    if depth == 0:
        return leaf
    best = (1e-6, None)
    for feature in FEATURES:
        sums: dict[int, list[float]] = {}
        for row, gradient, curvature in cells:
            total = sums.setdefault(row[feature], [0.0, 0.0])
            total[0] += gradient
            total[1] += curvature
        left_g = left_h = 0.0
        for border in sorted(sums)[:-1]:
            left_g, left_h = left_g + sums[border][0], left_h + sums[border][1]
            gain = (left_g**2 / (left_h + ridge) + (g - left_g) ** 2 / (h - left_h + ridge)
                    - g**2 / (h + ridge))
            if gain > best[0]:
                best = (gain, (feature, border))
    if best[1] is None:
        return leaf
    feature, border = best[1]
    sides = [c for c in cells if c[0][feature] <= border], [c for c in cells if c[0][feature] > border]
    return Node(split=(feature, border, *[_grow(side, depth - 1, rate) for side in sides]))


def train(cells: list[Row], rounds: int = 24, depth: int = 3, rate: float = 0.3,
          precision: float = 0.95) -> Model:
    """Boosted trees from cell counts: features, ``fold``, ``n`` and ``positive``.

    The model has no threshold for a kind whose other half of the documents never
    reaches the precision, and then adds nothing of that kind.
    """
    fitting = [c for c in cells if c.fold == 0]
    n, positive = sum(c.n for c in fitting), sum(c.positive for c in fitting)
    model = Model(math.log((positive + 1) / (n - positive + 1)))
    if not n:
        return model
    scores = [model.prior] * len(fitting)
    for _ in range(rounds):
        work = []
        for row, score in zip(fitting, scores):
            p = _chance(score)
            work.append((row, row.positive - row.n * p, row.n * p * (1 - p)))
        tree = _grow(work, depth, rate)
        model.trees.append(tree)
        scores = [score + tree.of(row) for row, score in zip(fitting, scores)]
    for k in range(len(KINDS)):
        held = sorted(((model.score(c), c.n, c.positive) for c in cells if c.fold == 1 and c.k == k),
                      reverse=True)
        seen = hit = 0
        for i, (score, n, positive) in enumerate(held):
            seen, hit = seen + n, hit + positive
            ends = i + 1 == len(held) or held[i + 1][0] < score
            if ends and hit >= precision * seen:
                model.thresholds[k] = score
    return model


def _cells(spans: DataFrame) -> DataFrame:
    """Candidates and hidden base spans per cell and half; at most the product of the bins, 233,000 rows."""
    one = spans.select("fold", F.explode(F.concat("wide", "hidden")).alias("c"))
    return one.groupBy("fold", *[F.col(f"c.{name}").alias(name) for name in FEATURES]).agg(
        F.count("*").alias("n"), F.sum("c.label").alias("positive")
    )


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(
        ":", F.element_at(names, c["k"] + 1), c["s"].cast("string"), c["e"].cast("string")
    )), ",")


def find_personal_data(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", precision: float = 0.95
) -> DataFrame:
    """Base counts and digest, and all spans, of every text.

    Columns: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.
    Null texts count as empty and have no spans; repeated rows give repeated rows;
    extra columns are left out. The texts are read once: spans and candidates are
    written before the trees are trained.
    """
    spans = materialise(find_spans(docs, id_column, text_column))
    model = train(_cells(spans).collect(), precision=precision)
    return spans.withColumn("added", _added(model)).select(
        "doc_id", *[f"n_{kind}" for kind in KINDS],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("bigint").alias("n_added"),
    )


def _added(model: Model) -> Column:
    """The candidates that the model selects; none of them meets a base span."""
    return F.array_distinct(F.transform(
        F.filter("wide", model.selects), lambda c: F.struct(c["s"].alias("s"), c["k"].alias("k"), c["e"].alias("e"))
    ))


def redact(docs: DataFrame, text_column: str = "text", precision: float = 0.95) -> DataFrame:
    """The rows of ``docs`` with every span replaced by its kind, as in ``[email]``.

    Spans that overlap are replaced together, by the kind of the first. Where a
    column ``n_chars`` counted the text, it counts the new one. Rows without spans, null
    texts among them, stay as they are, and repeated rows are changed alike.
    """
    # Written: the spans are found once, and the texts read again with them.
    found = materialise(find_spans(docs, text_column=text_column, whole_rows=True))
    model = train(_cells(found).collect(), precision=precision)
    found = found.withColumn("text", whole_text(F.col("row").getField(text_column)))
    names = F.array(*[F.lit(f"[{kind}]") for kind in KINDS])

    def step(acc: Column, c: Column) -> Column:
        gap = F.substring("text", acc["at"] + 1, F.greatest(c["s"] - acc["at"], F.lit(0)))
        new = F.concat(acc["out"], gap, F.element_at(names, c["k"] + 1))
        return F.struct(F.greatest(acc["at"], c["e"]).alias("at"),
                        F.when(c["s"] >= acc["at"], new).otherwise(acc["out"]).alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring("text", acc["at"] + 1, F.length("text")))
    clean = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, rest)
    found = found.withColumn("spans", F.array_sort(F.concat("base", _added(model))))
    found = found.select("row", F.size("spans").alias("n"), clean.alias("clean"))
    columns = []
    for name in docs.columns:
        value = F.col("row").getField(name)
        if name == text_column:
            value = F.when(F.col("n") > 0, F.col("clean")).otherwise(value)
        elif name == "n_chars":
            value = F.when(F.col("n") > 0, F.length("clean").cast(docs.schema[name].dataType)).otherwise(value)
        columns.append(value.alias(name))
    return found.select(*columns)
