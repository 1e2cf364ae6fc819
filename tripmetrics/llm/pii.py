"""Personal data, in DataFrame functions only.

Four base kinds are found by their formats and checks and always stay. Besides them, generators
of high recall propose overlapping spans of other forms: number groups, tokens with digits or an
at sign, spelled-out addresses. Gradient-boosted trees on format and context score these. The
trees are learned from a bounded draw of spans, labelled by the base checks, by telling words before
them and by their spelling. A threshold per generator is calibrated to a precision over all spans
that would be added to the base ones: a number that fails its check and has no telling word before
it counts as wrong. Scoring is a column expression, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as f

from tripmetrics.llm.spans import between, covered, digits, distinct_sorted, find, let, luhn, none, pieces, running
from tripmetrics.llm.trees import boosted_probability
from tripmetrics.sources.shared import store

# A match begins where a run of its characters begins or where the last match ended: the same
# matches as without that, in linear time on long runs.
EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_ADDRESS = rf"{_OCTET}(?:\.{_OCTET}){{3}}"

GENERATORS = {
    "number": r"(?<![0-9A-Za-z])[(+]{0,2}[0-9](?:[ ().-]{0,2}[0-9])++(?![0-9A-Za-z])",
    "token": r"(?<!\S)[^\s0-9@]*+[0-9@](?:\S*[0-9A-Za-z])?",
    "spelled": (
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++ ?[\[({] ?[aA][tT] ?[\])}] ?"
        r"[A-Za-z0-9-]++(?: ?(?:\.|[\[({] ?[dD][oO][tT] ?[\])}]) ?[A-Za-z0-9-]++)++"
    ),
}
#: Words that tell that personal data follows.
TELLING = (
    r"(?i)(?<![A-Za-z])(?:card|visa|mastercard|amex|credit|account|acct|iban|ssn|passport|phone"
    r"|tel|telephone|mobile|cell|fax|call|e-?mail|mail|contact|address|ip|login|user)s?"
    r"[^A-Za-z0-9]{0,4}(?:(?:no|nr|number|is|at)[^A-Za-z0-9]{1,4}){0,2}$"
)
#: Bound of what the trees are learned from: rows of labelled spans with the same features.
SAMPLE_SPANS = 20_000
TREES = 8
DEPTH = 3
PRECISION = 0.98
LEAST_THRESHOLD = 0.8
CONTEXT = 32
LEAST_NEW = 7


@dataclass(frozen=True)
class Model:
    """Boosted trees and a threshold per generator; a generator without one proposes nothing.

    Without trees the label is the score. ``added`` has, per generator, the labelled spans beyond the
    base ones that reach the threshold, and how many of them are personal data by their label."""

    trees: GBTClassificationModel | None = None
    thresholds: dict[str, float] = field(default_factory=dict)
    added: dict[str, tuple[int, int]] = field(default_factory=dict)


def base_spans(text: Column) -> Column:
    """Spans of the base kinds, sorted by start, then kind: start, rank, end, kind."""
    digit = text.rlike("[0-9]")
    found = {
        "email": (text.contains("@"), EMAIL, lambda v: f.lit(True)),
        "ip": (digit, IP, lambda v: v.rlike(f"^{_ADDRESS}$")),
        "card": (
            digit,
            CARD,
            lambda v: let(digits(v), lambda d: f.length(d).between(14, 19) & luhn(d)),
        ),
        "phone": (text.contains("+"), PHONE, lambda v: f.length(digits(v)).between(10, 15)),
    }
    parts = []
    for rank, kind in enumerate(KINDS):
        gate, pattern, check = found[kind]
        spans = f.filter(find(text, pattern), _on_value(check))
        parts.append(_named(f.when(gate, spans).otherwise(none()), rank, kind))
    return f.array_sort(f.concat(*parts))


def _on_value(check: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda span: check(span["value"])


def _named(spans: Column, rank: int, kind: str) -> Column:
    return f.transform(
        spans,
        lambda s: f.struct(
            s["start"].alias("start"),
            f.lit(rank).alias("rank"),
            s["end"].alias("end"),
            f.lit(kind).alias("kind"),
        ),
    )


def _count(value: Column, characters: str) -> Column:
    return f.length(f.regexp_replace(value, f"[^{characters}]", "")).cast("double")


def _features(value: Column, before: Column, after: Column, generator: int) -> Column:
    """Format of a span, and the characters around it."""
    flag = lambda condition: f.coalesce(condition, f.lit(False)).cast("double")
    return f.array(
        f.lit(float(generator)),
        f.length(value).cast("double"),
        _count(value, "0-9"),
        _count(value, "A-Za-z"),
        _count(value, "."),
        _count(value, " ()-"),
        _count(value, "@"),
        _count(value, "+"),
        _count(value, "=\"'/_:"),
        f.size(f.split(value, "[^0-9]++")).cast("double"),
        f.length(f.regexp_extract(value, "[0-9]++", 0)).cast("double"),
        flag(before.rlike("[=:\"'] ?$")),
        flag(before.rlike("[A-Za-z]{2,}[,.]? $")),
        flag(before.rlike("(?i)(version|v|page|section|no)[. ]*$")),
        flag(after.rlike("^[A-Za-z0-9\"'%]")),
        flag(before.rlike(TELLING)),
    )


def _candidates(text: Column) -> Column:
    """Proposed spans with generator, value, features, label, and whether a base check accepts it."""
    gates = {
        "number": text.rlike("[0-9]"),
        "token": text.rlike("[0-9@]"),
        "spelled": text.rlike(r"[\[({] ?[aA][tT] ?[\])}]"),
    }
    found = f.struct(
        *[
            f.when(gates[name], find(text, pattern)).otherwise(none()).alias(name)
            for name, pattern in GENERATORS.items()
        ]
    )

    def all_described(spans: Column, cut: Column) -> Column:
        return f.concat(
            *[
                f.transform(spans[name], _described(cut, number, name))
                for number, name in enumerate(GENERATORS)
            ]
        )

    return let(
        found,
        lambda spans: let(pieces(text), lambda cut: all_described(spans, cut)),
    )


def _described(cut: Column, number: int, name: str) -> Callable[[Column], Column]:
    def described(span: Column) -> Column:
        around = f.struct(
            between(cut, f.greatest(span["start"] - CONTEXT, f.lit(0)), span["start"]).alias("before"),
            between(cut, span["end"], span["end"] + CONTEXT).alias("after"),
            _accepted(span["value"]).alias("base"),
        )
        return let(around, lambda a: judged(span, a))

    def judged(span: Column, around: Column) -> Column:
        value, before = span["value"], around["before"]
        return f.struct(
            span["start"].alias("start"),
            span["end"].alias("end"),
            f.lit(name).alias("generator"),
            value.alias("value"),
            _features(value, before, around["after"], number).alias("features"),
            (around["base"] | _label_beyond(value, before)).cast("double").alias("label"),
            around["base"].alias("base"),
        )

    return described


def _accepted(value: Column) -> Column:
    """Whether the value holds what a base check accepts."""
    number = digits(value)
    size = f.length(number)
    return (
        value.rlike(EMAIL)
        | value.rlike(rf"^{_ADDRESS}\W*$")
        | (value.rlike(r"^\W*\+[0-9]") & size.between(10, 15))
        | (value.rlike(r"^\W*[0-9][0-9 -]*[0-9]\W*$") & size.between(14, 19) & luhn(number))
    )


def _label_beyond(value: Column, before: Column) -> Column:
    """Whether a span that no base check accepts is personal: a spelled-out address, or enough digits
    or an at sign with a telling word before it."""
    told = before.rlike(TELLING) & ((f.length(digits(value)) >= LEAST_NEW) | value.contains("@"))
    return value.rlike(GENERATORS["spelled"]) | told


def _has_candidates(text: Column) -> Column:
    """Whether some generator can find a span; null for a null text."""
    return text.rlike("[0-9@]|[\\[({] ?[aA][tT] ?[\\])}]")


def _labelled(docs: DataFrame) -> DataFrame:
    """Generator, features, label, base and number ``n`` of the spans of all documents.

    Spans with the same features score alike, so they are one row, however often they occur.
    """
    return (
        docs.filter(_has_candidates(f.col("text")))
        .select(f.explode(_candidates(f.col("text"))).alias("span"))
        .select("span.generator", "span.features", "span.label", "span.base")
        .groupBy("generator", "features", "label", "base")
        .agg(f.count("*").alias("n"))
    )


def _drawn(spans: DataFrame, sample_spans: int) -> DataFrame:
    """About ``sample_spans`` rows at most, drawn by hash, with the weight of the spans they
    stand for. Every generator and label has an equal part of the rows, and keeps all of its rows
    if they are fewer; features of more spans are likelier drawn."""
    strata = (
        spans.groupBy("generator", "label")
        .agg(f.count("*").alias("rows"), f.sum("n").alias("spans"))
        .collect()
    )
    most = sample_spans / max(len(strata), 1)
    chance = f.lit(1.0)
    for s in strata:
        if s.rows > most:
            here = (f.col("generator") == s.generator) & (f.col("label") == s.label)
            chance = f.when(here, 1 - f.exp(-f.col("n") * (most / s.spans))).otherwise(chance)
    lot = f.pmod(f.xxhash64("features"), f.lit(1 << 30)) / float(1 << 30)
    return (
        spans.withColumn("chance", chance)
        .filter(lot < f.col("chance"))
        .select("generator", "features", "label", (f.col("n") / f.col("chance")).alias("weight"))
    )


def _threshold(seen: list[tuple[float, float, int]]) -> float | None:
    """The lowest score from which on ``PRECISION`` holds, from scores, personal and all spans.

    Without any span the least threshold; with personal data alone, no span seen is left out.
    """
    if all(right == n for _, right, n in seen):
        return min([LEAST_THRESHOLD, *(p for p, _, _ in seen)])
    good, total, threshold = 0.0, 0, None
    for p, right, n in sorted(seen, reverse=True):
        good, total = good + right, total + n
        if good / total >= PRECISION:
            threshold = max(p, LEAST_THRESHOLD)
    return threshold


def fit(docs: DataFrame, sample_spans: int = SAMPLE_SPANS) -> Model:
    """Trees from drawn spans, and thresholds from all spans beyond the base ones of all documents.

    If all spans have one label, there are no trees, and labels are proposed themselves; so it is
    for an empty table. Null and empty texts have no spans, repeated rows count each, and a text
    may have any number of spans.
    """
    spans = store(_labelled(docs), "labelled")
    if spans.select("label").distinct().count() < 2:
        return Model(None, dict.fromkeys(GENERATORS, LEAST_THRESHOLD))
    drawn = store(_drawn(spans, sample_spans), "drawn")
    trees = GBTClassifier(
        featuresCol="vector",
        labelCol="label",
        weightCol="weight",
        maxIter=TREES,
        maxDepth=DEPTH,
        seed=1,
    ).fit(drawn.withColumn("vector", array_to_vector("features")))
    scores = (
        spans.filter("not base")
        .withColumn("p", boosted_probability(trees, f.col("features")))
        .groupBy("generator", "p")
        .agg(f.sum(f.col("label") * f.col("n")).alias("personal"), f.sum("n").alias("n"))
        .collect()
    )
    thresholds, added = {}, {}
    for name in GENERATORS:
        seen = [(r.p, r.personal, r.n) for r in scores if r.generator == name]
        limit = _threshold(seen)
        if limit is not None:
            thresholds[name] = limit
            reached = [(right, n) for p, right, n in seen if p >= limit]
            added[name] = (sum(n for _, n in reached), round(sum(right for right, _ in reached)))
    return Model(trees, thresholds, added)


def proposed_spans(text: Column, model: Model) -> Column:
    """Spans of other forms that reach their generator's threshold, as ``other``."""
    if not model.thresholds:
        return _named(none(), len(KINDS), "other")

    def score(c: Column) -> Column:
        if model.trees is None:
            return c["label"]
        return boosted_probability(model.trees, c["features"])

    scored = f.transform(
        _candidates(text),
        lambda c: f.struct(
            c["start"].alias("start"),
            c["end"].alias("end"),
            c["value"].alias("value"),
            c["generator"].alias("generator"),
            score(c).alias("p"),
        ),
    )

    def accepted(c: Column) -> Column:
        limit = f.lit(2.0)
        for name, threshold in model.thresholds.items():
            limit = f.when(c["generator"] == name, threshold).otherwise(limit)
        return c["p"] >= limit

    chosen = f.filter(scored, accepted)
    return _named(
        f.transform(chosen, lambda c: f.struct(c["start"], c["end"], c["value"])),
        len(KINDS),
        "other",
    )


def detect(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``base_spans`` and ``all_spans`` (start, rank, end, kind; sorted).

    Null text: no spans. A proposed span that equals another, or that adds fewer than
    ``LEAST_NEW`` characters to the base spans, is left out. Columns of these names are
    replaced; all others pass. A text may be as long as it likes and have any number of spans;
    repeated rows get equal results, an empty table none.
    """
    text = f.coalesce("text", f.lit(""))
    found = docs.drop("base_spans", "all_spans").withColumn("base_spans", base_spans(text))
    has = f.coalesce(_has_candidates(f.col("text")), f.lit(False))
    nothing = _named(none(), len(KINDS), "other")
    proposed = f.when(has, distinct_sorted(proposed_spans(text, model))).otherwise(nothing)

    def new(spans: Column) -> Column:
        def adds(shared: Column) -> Column:
            return f.filter(
                spans,
                lambda p, i: (f.get(shared, i) == 0)
                | (p["end"] - p["start"] - f.get(shared, i) >= LEAST_NEW),
            )

        judged = let(covered(spans, f.col("base_spans")), adds)
        alone = (f.size(spans) == 0) | (f.size("base_spans") == 0)
        return f.when(alone, spans).otherwise(judged)

    added = let(proposed, new)
    return found.withColumn("all_spans", f.array_sort(f.concat(f.col("base_spans"), added)))


def listed(spans: Column | str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return f.array_join(f.transform(spans, lambda s: f.concat_ws(":", s.kind, s.start, s.end)), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; overlapping ones by one."""

    def replaced(sorted_spans: Column) -> Column:
        ends = f.transform(sorted_spans, lambda s: s["end"])
        reached = let(ends, lambda e: running(e, f.lit(0), lambda x, y: f.greatest(x, y)))
        return let(reached, lambda r: let(pieces(text), lambda cut: parts(sorted_spans, r, cut)))

    def parts(sorted_spans: Column, reached: Column, cut: Column) -> Column:
        def part(s: Column, i: Column) -> Column:
            tag = f.concat(f.lit("["), f.upper(s["kind"]), f.lit("]"))
            return let(
                f.coalesce(f.get(reached, i - 1), f.lit(0)),
                lambda at: f.when(s["start"] >= at, f.concat(between(cut, at, s["start"]), tag)).otherwise(""),
            )

        rest = between(cut, f.element_at(reached, -1), f.length(text))
        return f.concat(f.array_join(f.transform(sorted_spans, part), ""), rest)

    return f.when(f.size(spans) == 0, text).otherwise(let(spans, replaced))


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; null texts stay null."""
    found = detect(docs, model)
    return found.withColumn("text", redacted(f.col("text"), f.col("all_spans"))).select(
        *docs.columns
    )
