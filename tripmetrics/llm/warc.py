"""WARC archives: writing page records, and reading them back by boundary chains.

A record is a header, a blank line, a block and two line feeds. Records of a payload that was
already written are revisits, without a payload. Archives are written by Spark's text writer,
a row a record.

Reading splits files wherever Spark does. Spark's text reader cuts at the record magic, so a
task sees the pieces between magics of its part of a file, and proposes each as a record with
the offset of its successor, from its own Content-Length. The magic may also stand inside a
payload; so pointer jumping from offset 0 of each file keeps only the records that are reached,
and a payload that was cut at magics inside it is put together again.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as f
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from tripmetrics.llm.shipping import ship
from tripmetrics.sources.shared import store

VERSION = "WARC/1.1"
MAGIC = f"{VERSION}\r\n"
#: What a revisit says it has in common with the record it refers to.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
#: Payloads of at least so many bytes are written once; later copies revisit the first.
MIN_REVISIT_BYTES = 0
#: Bytes of a file in which records and pieces of blocks look for each other.
STRETCH = 1 << 20
_HEAD_END = END.encode()
_LENGTH = re.compile(rb"^content-length:[ \t]*([0-9]{1,18})[ \t]*\r?$", re.I | re.M)
_PIECES = (
    "path string, block bigint, place bigint, at bigint, size bigint, header binary, "
    "declared bigint, digest string, body binary"
)


def payload_digest(payload: bytes) -> str:
    """SHA-1 in base 32, as archives name payloads."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@f.pandas_udf(StringType())
def _digests(payloads: pd.Series) -> pd.Series:
    return payloads.map(lambda text: payload_digest(text.encode("utf-8")))


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value. Line ends in values become spaces."""
    clean = f.regexp_replace(value.cast("string"), "[\r\n]+", " ")
    return f.coalesce(f.concat(f.lit(f"{name}: "), clean, f.lit("\r\n")), f.lit(""))


def page_records(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, payload_digest, record_type and refers_to of each row of pages.

    A null html is an empty payload. Of equal payloads of at least ``min_revisit_bytes`` the
    row with the largest page_id (null: smallest) is the response; of several such rows, all
    are. Payloads are equal if SHA-1, SHA-256 and length are. Smaller payloads are responses.
    """
    ship(pages.sparkSession)
    rows = pages.select("page_id", "url", f.coalesce("html", f.lit("")).alias("payload"))
    keyed = rows.withColumns(
        {
            "payload_digest": _digests("payload"),
            "strong": f.sha2("payload", 256),
            "payload_bytes": f.octet_length("payload").cast("bigint"),
        }
    )
    key = ["payload_digest", "strong", "payload_bytes"]
    first = (
        keyed.filter(f.col("payload_bytes") >= min_revisit_bytes)
        .groupBy(*key)
        .agg(f.max("page_id").alias("first_id"), f.count("*").alias("copies"))
        .filter("copies > 1")
    )
    first = store(first.drop("copies"), "repeated_payloads")
    revisit = f.col("first_id").isNotNull() & ~f.col("page_id").eqNullSafe(f.col("first_id"))
    return keyed.join(first, key, "left").select(
        "page_id",
        "url",
        "payload",
        "payload_bytes",
        "payload_digest",
        f.when(revisit, "revisit").otherwise("response").alias("record_type"),
        f.when(revisit, f.col("first_id")).alias("refers_to"),
    )


def write_archives(records: DataFrame, path: str) -> None:
    """One archive per partition of ``records`` below ``path``.

    Every record has an id of its own, so rows with one page_id or none differ; the page_id of a
    record and that of the response it revisits are fields of their own.
    """
    revisit = f.col("record_type") == "revisit"
    block = f.when(revisit, "").otherwise(f.col("payload"))
    now = f.to_utc_timestamp(f.current_timestamp(), f.current_timezone())
    header = f.concat(
        f.lit(MAGIC),
        _field("WARC-Type", f.col("record_type")),
        _field("WARC-Record-ID", f.concat(f.lit("<urn:uuid:"), f.uuid(), f.lit(">"))),
        _field("WARC-Date", f.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _field("WARC-Profile", f.when(revisit, PROFILE)),
        _field("WARC-Target-URI", f.col("url")),
        _field("WARC-Payload-Digest", f.concat(f.lit("sha1:"), f.col("payload_digest"))),
        _field("WARC-Payload-Length", f.col("payload_bytes")),
        _field("Page-ID", f.col("page_id")),
        _field("Refers-To-Page-ID", f.col("refers_to")),
        _field("Content-Type", f.lit("text/html; charset=utf-8")),
        f.lit("Content-Length: "),
        f.octet_length(block).cast("string"),
        f.lit(END),
    )
    # the writer ends every row with the line separator, here a record's end
    records.select(f.concat(header, block).alias("value")).write.option("lineSep", END).text(path)


def _propose(all_bodies: bool):
    """A row per piece between magics: its place in the part of a file that a task reads, its
    size with the magic before it, the header and declared block length if it looks like a
    record, and the digest of the block if the piece holds all of it. A piece keeps its bytes
    (all of them with ``all_bodies``) if it may be cut from a block: if it proposes a longer
    block than it holds, or lies in one that an earlier piece of this part proposes."""
    magic, ends = len(MAGIC), len(_HEAD_END)
    names, types = zip(*(column.split() for column in _PIECES.split(", ")))
    arrow = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, place, covered = None, 0, 0, 0
        for batch in batches:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("path", "block", "value"))
            for path, block, value in zip(*columns):
                if (path, block) != part:
                    part, at, place, covered = (path, block), 0, 0, 0
                # all but the first piece of a file follow a magic
                size = len(value) + (magic if block or place else 0)
                header = declared = digest = None
                inside = all_bodies or at < covered
                stop = value.find(_HEAD_END)
                length = _LENGTH.search(value, 0, stop + 2) if stop >= 0 else None
                if length:
                    header, declared = value[: stop + 2], int(length[1])
                    start = stop + ends
                    if start + declared + ends <= len(value):
                        digest = payload_digest(value[start : start + declared])
                    else:
                        covered = max(covered, at + magic + start + declared + ends)
                body = value if inside or (length and digest is None) else None
                rows.append((path, block, place, at, size, header, declared, digest, body))
                at, place = at + size, place + 1
            if rows:
                arrays = [pa.array(c, arrow[t]) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(arrays, names=list(names))

    return run


def _pieces(spark: SparkSession, paths: list[str], all_bodies: bool = False) -> DataFrame:
    """The pieces of all files, with their offset ``at`` in the file and its size."""
    lines = spark.read.option("lineSep", MAGIC).text(paths)
    pieces = store(
        lines.select(
            f.col("_metadata.file_path").alias("path"),
            f.col("_metadata.file_block_start").alias("block"),
            f.col("value").cast("binary").alias("value"),
        ).mapInArrow(_propose(all_bodies), _PIECES),
        "pieces",
    )
    # offsets in a file: the bytes that earlier parts of it read, and those before in this part
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pieces.groupBy("path", "block")
        .agg(f.sum("size").alias("bytes"))
        .select(
            "path",
            "block",
            f.coalesce(f.sum("bytes").over(earlier), f.lit(0)).alias("start"),
            f.sum("bytes").over(Window.partitionBy("path")).alias("file_bytes"),
        )
    )
    return store(
        pieces.join(store(starts, "parts"), ["path", "block"])
        # the first piece of a file, before its first magic, is no record
        .filter(~((f.col("block") == 0) & (f.col("place") == 0)))
        .withColumn("at", f.col("start") + f.col("at"))
        .drop("start", "block", "place"),
        "placed",
    )


def reachable(candidates: DataFrame) -> DataFrame:
    """path, at of the candidates (path, at, successor) on the chain from offset 0 of a path.

    Pointer jumping: every round, what is reached reaches the end of its pointer, and pointers
    double. Rounds grow with the logarithm of the records in a file. Each is one join and one
    aggregate on unique keys, and is written, so that a lost executor repeats one at most.
    """
    state = candidates.select(
        "path", "at", f.col("successor").alias("to"), (f.col("at") == 0).alias("hit")
    )
    while True:
        target = state.select(
            "path",
            f.col("at").alias("key"),
            f.col("to").alias("further"),
            f.lit(True).alias("known"),
        )
        # pointers that have left the file get keys of their own, none of which exists
        source = state.withColumn("key", f.coalesce("to", -1 - f.col("at")))
        own = f.struct("at", f.col("further").alias("to"), "hit")
        onward = f.struct(
            f.col("to").alias("at"),
            f.lit(None).cast("bigint").alias("to"),
            f.lit(True).alias("hit"),
        )
        rows = f.array_compact(f.array(own, f.when(f.col("hit") & f.col("known"), onward)))
        state = store(
            source.join(target, ["path", "key"], "left")
            .select("path", f.explode(rows).alias("row"))
            .select("path", "row.*")
            .groupBy("path", "at")
            .agg(f.max("to").alias("to"), f.max("hit").alias("hit")),
            "chains",
        )
        if state.filter("to is not null").isEmpty():
            return state.filter("hit").select("path", "at")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records below ``path``: path, at, header, block_bytes, block_digest.

    Records come from the chain that starts each file. A chain that ends before its file does
    (a broken record) keeps the records before that; a length that goes beyond the file is broken,
    whatever it says. Header names count without case.
    """
    ship(spark)
    placed = _pieces(spark, [path])
    head = f.octet_length("header") + len(MAGIC) + 2
    proposed = placed.filter("declared is not null").withColumn(
        "successor", f.col("at") + head + f.col("declared") + len(END)
    ).filter("successor <= file_bytes")
    chain = reachable(store(proposed.select("path", "at", "successor"), "candidates"))
    kept = proposed.join(chain, ["path", "at"], "left_semi")
    whole = kept.filter("digest is not null").select(
        "path",
        "at",
        "header",
        f.col("declared").alias("block_bytes"),
        f.col("digest").alias("block_digest"),
    )
    cut = kept.filter("digest is null").select(
        "path", f.col("at").alias("record"), "header", "declared", "successor"
    )
    return whole.union(_mended(spark, placed, store(cut, "cut")))


def _mended(spark: SparkSession, placed: DataFrame, cut: DataFrame) -> DataFrame:
    """Records whose block holds magics, from all the pieces up to their successor.

    Records and pieces meet by stretches of the file, so that a piece is compared with the few
    records near it.
    """
    stretch = lambda at: f.floor(at / STRETCH)
    ranges = cut.withColumn(
        "stretch", f.explode(f.sequence(stretch(f.col("record")), stretch(f.col("successor") - 1)))
    )

    def inside(pieces: DataFrame) -> DataFrame:
        pieces = pieces.select("path", "at", "body").withColumn("stretch", stretch(f.col("at")))
        return pieces.join(ranges, ["path", "stretch"]).filter("at >= record and at < successor")

    found = store(inside(placed), "inside")
    # blocks that go on into a part read elsewhere: the files concerned are read again, with bodies
    torn = found.filter("body is null").select("path").distinct()
    again = [unquote(row["path"]) for row in torn.collect()]  # names of files
    if again:
        others = found.join(f.broadcast(torn) if len(again) < 10_000 else torn, "path", "left_anti")
        found = store(others.unionByName(inside(_pieces(spark, again, all_bodies=True))), "inside")
    bodies = f.transform(
        f.sort_array(f.collect_list(f.struct("at", "body"))), lambda piece: f.hex(piece["body"])
    )
    joined = found.groupBy("path", "record", "header", "declared").agg(
        f.array_join(bodies, MAGIC.encode().hex().upper()).alias("bytes")
    )
    start = f.octet_length("header") + 3
    block = f.substring(f.unhex("bytes"), start, f.col("declared").cast("int"))
    # a file that ends inside a record has fewer bytes than the record declares
    complete = f.length("bytes") / 2 >= start - 1 + f.col("declared") + len(END)
    return joined.filter(complete).select(
        "path",
        f.col("record").alias("at"),
        "header",
        f.col("declared").alias("block_bytes"),
        _block_digests(block).alias("block_digest"),
    )


@f.pandas_udf(StringType())
def _block_digests(blocks: pd.Series) -> pd.Series:
    return blocks.map(lambda block: payload_digest(bytes(block)))


def header_field(name: str) -> Column:
    """A header field's value, or null."""
    text = f.decode("header", "UTF-8")
    found = f.regexp_extract(text, rf"(?im)^{re.escape(name)}:[ \t]*(.*?)[ \t]*\r?$", 1)
    return f.when(found != "", found)


def page_rows(records: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to, verified.

    A response's payload figures are those of the block that was read; a revisit's, which has no
    block, are those of its response, found by refers_to and digest (null if it is not there).
    """
    rows = store(
        records.select(
            header_field("Page-ID").try_cast("bigint").alias("page_id"),
            header_field("WARC-Type").alias("record_type"),
            header_field("Refers-To-Page-ID").try_cast("bigint").alias("refers_to"),
            f.substring(header_field("WARC-Payload-Digest"), 6, 32).alias("declared"),
            "block_bytes",
            "block_digest",
        ),
        "rows",
    )
    response = f.col("record_type") == "response"
    payload = [
        f.col("block_bytes").alias("payload_bytes"),
        f.col("block_digest").alias("payload_digest"),
    ]
    found = store(
        rows.filter(response)
        .select(
            f.col("page_id").alias("refers_to"),
            f.col("block_digest").alias("declared"),
            *payload,
        )
        .distinct(),
        "responses",
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "declared"]
    own = rows.filter(response).select("*", *payload).select(*columns)
    revisits = rows.filter(~response).join(found, ["refers_to", "declared"], "left")
    return own.union(revisits.select(*columns)).select(
        *columns[:-1],
        f.coalesce(f.col("payload_digest") == f.col("declared"), f.lit(False)).alias("verified"),
    )
