"""URL filtering by a trie over reversed host labels and path segments.

A rule allows or blocks a host with all its subdomains, for paths that start with the rule's. Its
place in the trie is its host's labels from the last to the first, then the segments of its path.
One walk down the trie meets every rule that fits a URL; the longest decides. Rule lists of a
checked size are broadcast as a trie; larger ones are joined on hosts and folders instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as f

from tripmetrics.llm.shipping import ship
from tripmetrics.sources.shared import store

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALLOW, BLOCK = "allow", "block"
RULES = "host string, path string, verdict string"
#: Largest rule list to broadcast: the bytes of its hosts and paths, and so many a rule besides.
TRIE_BYTES = 64 << 20
RULE_BYTES = 512


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path after the first ``://``; both empty without one."""
    at = f.locate("://", url)
    rest = f.when(at > 0, f.substring(url, at + 3, f.length(url)))
    parts = "(?s)^([^/?#]*)([^?#]*)"
    host = f.translate(f.regexp_extract(rest, parts, 1), UPPER, UPPER.lower())
    empty = f.lit("")
    return f.coalesce(host, empty), f.coalesce(f.regexp_extract(rest, parts, 2), empty)


class _Paths:
    """The paths below a host. An edge is a whole segment with its slash; what follows a rule's
    last slash is the start of a segment and waits at its node."""

    __slots__ = ("edges", "starts", "lengths")

    def __init__(self) -> None:
        self.edges: dict[str, _Paths] = {}
        self.starts: dict[str, tuple[str, str]] = {}
        self.lengths: list[int] = []


class _Hosts:
    __slots__ = ("edges", "paths")

    def __init__(self) -> None:
        self.edges: dict[str, _Hosts] = {}
        self.paths: _Paths | None = None


class Trie:
    """Rules by reversed host labels, then path segments."""

    def __init__(self) -> None:
        self.root = _Hosts()

    def add(self, host: str, path: str, verdict: str) -> None:
        node = self.root
        for label in reversed(host.split(".")) if host else ():
            node = node.edges.setdefault(label, _Hosts())
        node.paths = place = node.paths or _Paths()
        *whole, start = path.split("/")
        for segment in whole:
            place = place.edges.setdefault(segment, _Paths())
        place.starts[start] = host + path, verdict
        place.lengths = sorted({*place.lengths, len(start)})

    def longest(self, host: str, path: str) -> tuple[str | None, str | None]:
        """Rule and verdict of the longest rule that fits; of equally long ones, the longer host."""
        best: tuple[str | None, str | None] = (None, None)
        length = -1
        *whole, last = path.split("/")
        labels = reversed(host.split(".")) if host else iter(())
        node: _Hosts | None = self.root
        while node is not None:
            if node.paths is not None:
                for rule, verdict in self._fitting(node.paths, whole, last):
                    if len(rule) >= length:  # hosts get longer on the way down
                        best, length = (rule, verdict), len(rule)
            node = node.edges.get(next(labels, None))
        return best

    @staticmethod
    def _fitting(place: _Paths, whole: list[str], last: str) -> Iterator[tuple[str, str]]:
        """Rules on one path down from a host's node."""
        for segment in [*whole, last]:
            for length in place.lengths:
                if length <= len(segment) and segment[:length] in place.starts:
                    yield place.starts[segment[:length]]
            below = place.edges.get(segment)
            if below is None:
                return
            place = below

    @classmethod
    def of(cls, rules: list[tuple[str, str, str]]) -> Trie:
        trie = cls()
        for host, path, verdict in rules:
            trie.add(host, path, verdict)
        return trie


def _known(rules: DataFrame) -> DataFrame:
    """One row a host and path, hosts in lower case; block wins where both are listed."""
    empty = f.lit("")
    host = f.translate(f.coalesce("host", empty), UPPER, UPPER.lower())
    return (
        rules.filter(f.col("verdict").isin(ALLOW, BLOCK))
        .groupBy(host.alias("host"), f.coalesce("path", empty).alias("path"))
        .agg(f.max("verdict").alias("verdict"))
    )


def judge(
    pages: DataFrame, rules: DataFrame, default: str = ALLOW, trie_bytes: int = TRIE_BYTES
) -> DataFrame:
    """``pages`` with host, path, rule and verdict; a column of one of these names is replaced.

    ``rules`` has host, path and verdict (allow or block; other rows are left out, null hosts and
    paths are empty). A rule fits its host and all subdomains, and paths that start with its path;
    an empty host fits all. The longest host and path together win, then the longer host, then
    block. A URL that no rule fits gets ``default`` and a null rule; so does a null URL, one
    without ``://`` has neither host nor path. Equal rows get equal verdicts, an empty table none.
    """
    known = store(_known(rules), "url_rules")
    size = known.agg(
        f.sum(f.octet_length("host") + f.octet_length("path") + RULE_BYTES).alias("bytes")
    ).first()["bytes"]
    host, path = host_and_path(f.col("url"))
    located = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    judged = _by_trie if (size or 0) <= trie_bytes else _by_join
    return judged(located, known).withColumn("verdict", f.coalesce("verdict", f.lit(default)))


def allowed(pages: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """The rows of ``pages`` that are not blocked; all their columns as they were."""
    marked = pages.select(f.struct(*pages.columns).alias("row"), "url")
    return judge(marked, rules, default).filter(f.col("verdict") == ALLOW).select("row.*")


def _by_trie(located: DataFrame, known: DataFrame) -> DataFrame:
    spark = located.sparkSession
    ship(spark)
    rows = known.select("host", "path", "verdict").collect()  # below the bound
    trie = spark.sparkContext.broadcast(Trie.of([tuple(row) for row in rows]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest = trie.value.longest
        for batch in batches:
            hosts, paths = (batch.column(name).to_pylist() for name in ("host", "path"))
            found = list(map(longest, hosts, paths))
            for number, name in enumerate(("rule", "verdict")):
                column = pa.array([one[number] for one in found], pa.string())
                batch = batch.append_column(name, column)
            yield batch

    fields = located.withColumns({c: f.lit(None).cast("string") for c in ("rule", "verdict")})
    return located.mapInArrow(run, fields.schema)


def _by_join(located: DataFrame, known: DataFrame) -> DataFrame:
    """The same with any number of rules, by a join on host and folder.

    A URL's candidates are its host's endings and its path's folders, as many as the deepest rule
    has; each distinct host and path is judged once.
    """
    labels = f.size(f.split("host", r"\."))
    folder = f.regexp_extract("path", "(?s)^(.*/)?", 0)
    known = known.withColumn("folder", folder)
    depth = known.agg(
        f.max(labels).alias("labels"), f.max(f.size(f.split("folder", "/"))).alias("folders")
    ).first()
    parts = f.split("host", r"\.")
    most = f.least(f.size(parts), f.lit(depth["labels"]))
    endings = f.transform(
        f.sequence(f.lit(1), most),
        lambda n: f.array_join(f.slice(parts, f.size(parts) - n + 1, n), "."),
    )
    segments = f.split("path", "/")
    folders = f.transform(
        f.sequence(f.lit(0), f.least(f.size(segments) - 1, f.lit(depth["folders"] - 1))),
        lambda n: f.when(n == 0, "").otherwise(
            f.concat(f.array_join(f.slice(segments, 1, n), "/"), f.lit("/"))
        ),
    )
    urls = located.select("host", "path").distinct()
    candidates = urls.withColumn(
        "ending", f.explode(f.array_distinct(f.concat(f.array(f.lit("")), endings)))
    ).withColumn("folder", f.explode(folders))
    of_rule = known.select(
        f.col("host").alias("ending"), "folder", f.col("path").alias("start"), "verdict"
    )
    rank = f.struct(
        f.length(f.concat("ending", "start")).alias("length"),
        f.length("ending").alias("host_length"),
        f.concat("ending", "start").alias("rule"),
        "verdict",
    )
    best = (
        candidates.join(of_rule, ["ending", "folder"])
        .filter(f.col("path").startswith(f.col("start")))
        .groupBy("host", "path")
        .agg(f.max(rank).alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )
    columns = [*located.columns, "rule", "verdict"]
    return located.join(best, ["host", "path"], "left").select(*columns)
