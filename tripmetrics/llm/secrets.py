"""Secret scanning, in DataFrame functions only.

Candidates are long runs of key characters, and values of 6 or more characters without a space or
quote that are assigned to a telling name. They are found once and stored. Findings are labelled
by the names that values are assigned to and by the formats of known keys. A random forest learns
from the rest alone: length, character transitions, dictionary coverage, path (the document's
source) and neighbouring words. So it removes what has a telling name but looks like no secret,
and finds what looks like one without a name. It is scored as a column expression.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as f

from tripmetrics.llm.spans import between, find, let, none, pieces
from tripmetrics.llm.trees import forest_probability
from tripmetrics.sources.shared import store

KNOWN = (
    r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}"
    r"|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|-----BEGIN .*)$"
)
NAMES = (
    r"(?i:(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|auth|bearer"
    r"|credential)s?)"
)
#: What every one of these names contains, in lower case, for a cheap look at a text.
NAME_PARTS = ("token", "secret", "passw", "pwd", "key", "auth", "bearer", "credential")
ASSIGNS = r"[\"']?\s{0,16}+(?:[:=]|=>)\s{0,16}+[\"']?"
#: A run of key characters, from where such a run begins.
KEY = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
KEY_GATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16}|PRIVATE KEY"
#: A value after a telling name, matched forward from the name; the value is the group.
ASSIGNED = rf"{NAMES}{ASSIGNS}([^\s\"']{{5,}}[^\s\"'.,;:)\]}}])"
BEFORE_TELLING = rf"{NAMES}{ASSIGNS}$"
BEFORE_HARMLESS = r"(?i)(?:sha(?:1|256|512)?|md5|commit|digest|checksum|uuid|etag|revision)[\"' :=]*$"
BEFORE_ANY = r"[:=>][\s\"']*$"
PLACEHOLDER = r"(?i)example|sample|dummy|test|placeholder|change_?me|your[_-]|xxxx|0{8}|1234567"
TEST_PATH = r"(?i)test|example|fixture|mock|demo|doc"
CODE_PATH = r"(?i)code|git|src|config|\.(?:py|js|java|go|rb|sh|ya?ml|json|env|ini|toml|cfg)$"
#: Frequent parts of words and names, for dictionary coverage.
DICTIONARY = (
    "the|and|ing|tion|ment|that|with|for|are|was|this|have|from|ent|ion|able|ness|ive|ous|ist|"
    "con|pro|pre|str|ter|der|ein|sch|und|ung|ich|keit|heit|lich|ver|que|les|des|eau|oir|ais|"
    "ado|ido|cion|mente|los|las|para|name|user|file|path|data|key|class|index|value|error|list"
)
CONTEXT = 48
SAMPLE_FINDINGS = 20_000
TREES = 12
DEPTH = 4
THRESHOLD = 0.5


def _share(value: Column, removed: str) -> Column:
    """Part of ``value`` that the pattern matches; of an empty one, none."""
    rest = f.length(f.regexp_replace(value, removed, ""))
    return f.lit(1.0) - rest / f.greatest(f.length(value), f.lit(1))


def _flag(condition: Column) -> Column:
    return f.coalesce(condition, f.lit(False)).cast("double")


def _features(value: Column, further: Column, after: Column, path: Column) -> Column:
    """What the forest sees: nothing of the name that a value is assigned to, nor its format."""
    length = f.length(value).cast("double")
    transitions = "(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
    return f.array(
        length,
        _share(value, "[0-9]"),
        _share(value, "[A-Z]"),
        _share(value, "[^0-9a-fA-F]"),
        _share(value, "[A-Za-z0-9]"),
        f.regexp_count(value, f.lit(transitions)) / length,
        f.size(f.array_distinct(f.split(value, ""))) / length,
        _share(f.lower(value), DICTIONARY),
        _flag(path.rlike(TEST_PATH)),
        _flag(path.rlike(CODE_PATH)),
        f.regexp_count(further, f.lit("[A-Za-z]{2,}+")).cast("double"),
        _share(f.lower(further), DICTIONARY),
        f.regexp_count(after, f.lit("[A-Za-z]{2,}+")).cast("double"),
        _share(f.lower(after), DICTIONARY),
        _share(f.concat(further, after), "[(){}<>;=_]"),
    )


def _evidence(value: Column, before: Column) -> Column:
    """What labels a finding: its name and format."""
    harmless = before.rlike(BEFORE_HARMLESS) | value.rlike(PLACEHOLDER)
    return f.struct(
        value.rlike(KNOWN).alias("known"),
        before.rlike(BEFORE_TELLING).alias("named"),
        before.rlike(BEFORE_ANY).alias("assigned"),
        harmless.alias("harmless"),
    )


def _spans(text: Column) -> Column:
    """Runs of key characters, and assigned values that hold no such run; by their places."""
    lowered = f.lower(text)
    named = f.lit(False)
    for part in NAME_PARTS:
        named = named | lowered.contains(part)
    keys = f.when(text.rlike(KEY_GATE), find(text, KEY)).otherwise(none())
    values = f.when(named, find(text, ASSIGNED, 1)).otherwise(none())
    values = f.filter(values, lambda s: ~s["value"].rlike(KEY_GATE))
    return f.when(text.rlike(KEY_GATE) | named, f.array_sort(f.concat(keys, values))).otherwise(none())


def _candidates(text: Column, path: Column) -> Column:
    def described(span: Column, cut: Column) -> Column:
        before = between(cut, f.greatest(span["start"] - CONTEXT, f.lit(0)), span["start"])
        around = f.struct(
            before.alias("before"),
            between(cut, span["end"], span["end"] + CONTEXT).alias("after"),
        )
        return let(around, lambda a: judged(span, a))

    def judged(span: Column, around: Column) -> Column:
        value = span["value"]
        # without the word and signs right before the value, which tell whether it is assigned
        further = f.regexp_replace(around["before"], r"[A-Za-z0-9_.-]*[^A-Za-z0-9]*$", "")
        return f.struct(
            span["start"].alias("start"),
            span["end"].alias("end"),
            value.alias("value"),
            let(further, lambda words: _features(value, words, around["after"], path)).alias("features"),
            _evidence(value, around["before"]).alias("evidence"),
        )

    def all_described(spans: Column) -> Column:
        return let(pieces(text), lambda cut: f.transform(spans, lambda span: described(span, cut)))

    return let(_spans(text), lambda spans: f.when(f.size(spans) > 0, all_described(spans)))


def find_candidates(docs: DataFrame) -> DataFrame:
    """doc_id and ``candidates`` (start, end, value, features, evidence; null if there are none).

    Reads doc_id, text and source; null texts are empty, a null source is an empty path.
    """
    text, path = f.coalesce("text", f.lit("")), f.coalesce("source", f.lit(""))
    return docs.select("doc_id", _candidates(text, path).alias("candidates"))


def label(finding: Column) -> Column:
    """1: a known format, or assigned to a telling name. 0: not assigned to anything. Null: the rest,
    and what a harmless name or a placeholder decides without the forest."""
    e = finding["evidence"]
    return (
        f.when(e["harmless"], f.lit(None).cast("double"))
        .when(e["known"] | e["named"], 1.0)
        .when(~e["assigned"], 0.0)
    )


def _drawn(found: DataFrame, sample_findings: int) -> DataFrame:
    """About ``sample_findings`` findings at most, drawn by hash, half of them of each label (all
    of a label with fewer), with the weight of those they stand for."""
    rows = {r.label: r["count"] for r in found.groupBy("label").count().collect()}
    chance = f.lit(1.0)
    for label_, n in rows.items():
        part = min(1.0, sample_findings / 2 / n)
        chance = f.when(f.col("label") == label_, part).otherwise(chance)
    return found.withColumn("weight", 1 / chance).filter(f.col("lot") < chance)


def fit(
    docs: DataFrame, sample_findings: int = SAMPLE_FINDINGS
) -> RandomForestClassificationModel | None:
    """A forest from findings drawn from all documents; None if all have one label."""
    return fit_candidates(find_candidates(docs), sample_findings)


def fit_candidates(
    found: DataFrame, sample_findings: int = SAMPLE_FINDINGS
) -> RandomForestClassificationModel | None:
    """``fit`` from what ``find_candidates`` returns."""
    lot = f.pmod(f.xxhash64("doc_id", "finding.start"), f.lit(1 << 30)) / float(1 << 30)
    labelled = (
        found.select("doc_id", f.explode("candidates").alias("finding"))
        .select("finding.features", label(f.col("finding")).alias("label"), lot.alias("lot"))
        .filter("label is not null")
    )
    labelled = store(labelled, "findings")
    if labelled.select("label").distinct().count() < 2:
        return None
    drawn = store(_drawn(labelled, sample_findings), "drawn_findings")
    return RandomForestClassifier(
        featuresCol="vector",
        labelCol="label",
        weightCol="weight",
        numTrees=TREES,
        maxDepth=DEPTH,
        seed=1,
    ).fit(drawn.withColumn("vector", array_to_vector("features")))


def scan(docs: DataFrame, forest: RandomForestClassificationModel | None) -> DataFrame:
    """Per document: doc_id, n_candidates and ``secrets`` (start, end, probability).

    A placeholder or a value with a harmless name is none, a known format is one, and the forest
    decides the rest; without a forest, a value assigned to a telling name is one. Null and empty
    texts have none. A text may be as long as it likes and have any number of candidates; repeated
    rows get equal results, an empty table none. Reads doc_id, text and source.
    """
    return scan_candidates(find_candidates(docs), forest)


def scan_candidates(found: DataFrame, forest: RandomForestClassificationModel | None) -> DataFrame:
    """``scan`` of what ``find_candidates`` returns."""

    def scored(c: Column) -> Column:
        e = c["evidence"]
        if forest is None:
            judged = e["named"].cast("double")
        else:
            judged = forest_probability(forest, c["features"])
        p = f.when(e["harmless"], 0.0).when(e["known"], 1.0).otherwise(judged)
        return f.struct(c["start"].alias("start"), c["end"].alias("end"), p.alias("p"))

    empty = f.array().cast("array<struct<start:int,end:int,p:double>>")
    secrets = f.filter(f.transform("candidates", scored), lambda s: s["p"] >= THRESHOLD)
    return found.select(
        "doc_id",
        f.coalesce(f.array_size("candidates"), f.lit(0)).cast("bigint").alias("n_candidates"),
        f.coalesce(secrets, empty).alias("secrets"),
    )
