"""Language identification by nearest centroids.

A text's letters, in lower case, give hashed character trigrams (the middle one is a letter, so
word ends count too). Vectors are 1 + log(tf) times idf, of length one. Each language has a few
centroids, found by spherical k-means on a bounded sample of its texts; document frequencies
come from all texts to learn from. A text gets the language of the centroid with the largest
cosine, and is rejected where that cosine is below what the language's sample reaches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as f
from pyspark.sql.window import Window

from tripmetrics.llm.shipping import ship
from tripmetrics.sources.shared import store

BUCKETS = 1 << 13
SAMPLE_PER_LANGUAGE = 256
CENTROIDS = 3
ITERATIONS = 10
#: A text is rejected below this part of the lowest cosine in its language's sample, which is
#: taken at REJECT_QUANTILE; and where its trigrams are fewer, below a part that shrinks.
REJECT_PART = 0.5
REJECT_QUANTILE = 0.01
FULL_TRIGRAMS = 200
UNDETERMINED = "und"

_LETTER = np.frombuffer(bytes(chr(c).isalpha() for c in range(0x110000)), np.uint8).astype(bool)


def trigram_counts(text: str | None) -> np.ndarray:
    """Occurrences of each hashed trigram; all zero exactly if ``text`` has no letter."""
    codes = np.frombuffer(f" {text or ''} ".lower().encode("utf-32-le", "replace"), "<u4")
    codes = np.where(_LETTER[codes], codes, 0)
    left, middle, right = codes[:-2], codes[1:-1], codes[2:]
    inside = middle > 0
    mixed = (
        left[inside] * np.uint32(0x9E3779B1)
        ^ middle[inside] * np.uint32(0x85EBCA77)
        ^ right[inside] * np.uint32(0xC2B2AE3D)
    )
    mixed ^= mixed >> np.uint32(15)
    return np.bincount(mixed & np.uint32(BUCKETS - 1), minlength=BUCKETS)


def vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets in use and their weights, of length one."""
    used = np.flatnonzero(counts)
    weights = (1 + np.log(counts[used])) * idf[used]
    norm = np.sqrt((weights * weights).sum())
    return used, (weights / norm if norm else weights).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """``centroids`` has a row per centroid, ``owner`` its language, ``floor`` its rejection.

    Its size is languages x centroids x buckets, whatever the corpus.
    """

    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    floor: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        counts = trigram_counts(text)
        total = int(counts.sum())
        if not total or not self.languages:
            return UNDETERMINED, 0.0, True
        used, weights = vector(counts, self.idf)
        cosines = self.centroids[:, used] @ weights
        best = int(cosines.argmax())
        score = min(max(float(cosines[best]), 0.0), 1.0)
        floor = float(self.floor[best]) * min(1.0, total / FULL_TRIGRAMS)
        return self.languages[self.owner[best]], score, score < floor


def held_out() -> Column:
    """Whether a document is kept from learning; never for a null doc_id."""
    fold = f.crc32(f.col("doc_id").cast("string").cast("binary")) % 3
    return f.coalesce(fold == 1, f.lit(False))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task, the texts that each bucket occurs in, and the number of texts as bucket -1."""
    seen, texts = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in batch.column("text"):
            counts = trigram_counts(text.as_py())
            seen += counts > 0
            texts += 1
    if texts:
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(seen[used], texts))],
            names=["bucket", "texts"],
        )


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buckets, occurrences = [], []  # all counts of a batch would be 64 kB a text
        for text in batch.column("text"):
            counts = trigram_counts(text.as_py())
            used = np.flatnonzero(counts)
            buckets.append(used.astype(np.int32))
            occurrences.append(counts[used].astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("lang"),
                pa.array(buckets, pa.list_(pa.int32())),
                pa.array(occurrences, pa.list_(pa.int32())),
            ],
            names=["lang", "buckets", "counts"],
        )


def _cluster(points: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; starts from points far apart, empty clusters are dropped."""
    centers = [points.sum(axis=0)]
    centers[0] /= max(np.linalg.norm(centers[0]), 1e-9)
    while len(centers) < min(k, len(points)):
        near = (points @ np.stack(centers).T).max(axis=1)
        centers.append(points[near.argmin()])
    centroids = np.stack(centers)
    for _ in range(ITERATIONS):
        member = (points @ centroids.T).argmax(axis=1)
        sums = [points[member == c].sum(axis=0) for c in np.unique(member)]
        centroids = np.stack([s / max(np.linalg.norm(s), 1e-9) for s in sums])
    return centroids.astype(np.float32)


def fit(
    labelled: DataFrame,
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
    centroids: int = CENTROIDS,
) -> Model:
    """A model from columns doc_id, text and lang; rows without text or lang are left out.

    Document frequencies cover all rows. The sample has at most ``sample_per_language`` rows a
    language, those with the lowest hash of doc_id.
    """
    ship(labelled.sparkSession)
    labelled = labelled.filter("lang is not null and text is not null")
    frequencies = (
        labelled.select("text")
        .mapInArrow(_frequencies, "bucket bigint, texts bigint")
        .groupBy("bucket")
        .agg(f.sum("texts").alias("texts"))
        .toArrow()
    )
    texts = dict(zip(frequencies["bucket"].to_pylist(), frequencies["texts"].to_pylist()))
    total = texts.pop(-1, 0)
    idf = np.full(BUCKETS, np.log(1 + total) + 1)
    for bucket, n in texts.items():
        idf[bucket] = np.log((1 + total) / (1 + n)) + 1
    # Far fewer rows than the limit are then left for the window to order, even for the largest
    # language; and rows that repeat are cut by it before they move.
    # Stored, the sizes are a small side of known size: no row moves for their join.
    sizes = store(labelled.groupBy("lang").agg(f.count("*").alias("rows")), "language_sizes")
    lot = f.pmod(f.xxhash64("doc_id"), f.lit(1 << 30)) / float(1 << 30)
    drawn = (
        labelled.select("doc_id", "lang", lot.alias("lot"))
        .join(sizes, "lang")
        .filter(f.col("lot") * f.col("rows") < 2 * sample_per_language)
        .withColumn(
            "place", f.row_number().over(Window.partitionBy("lang").orderBy("lot", "doc_id"))
        )
        .filter(f.col("place") <= sample_per_language)
        .select("doc_id")
        .distinct()
    )
    drawn = store(drawn, "drawn")
    sample = (
        labelled.select("doc_id", "lang", "text")
        .join(drawn, "doc_id", "left_semi")
        .dropDuplicates(["doc_id", "lang"])
        .select("lang", "text")
        .mapInArrow(_sparse, "lang string, buckets array<int>, counts array<int>")
        .toArrow()
        .to_pylist()
    )
    languages = sorted({row["lang"] for row in sample})
    rows, owner, floor = [], [], []
    for number, language in enumerate(languages):
        members = [r for r in sample if r["lang"] == language and r["buckets"]]
        if not members:
            continue
        points = np.zeros((len(members), BUCKETS), np.float32)
        sizes_of = np.zeros(len(members))
        for point, member in zip(points, members):
            counts = np.zeros(BUCKETS, np.int64)
            counts[member["buckets"]] = member["counts"]
            used, weights = vector(counts, idf)
            point[used] = weights
        sizes_of = np.array([sum(m["counts"]) for m in members])
        found = _cluster(points, centroids)
        near = (points @ found.T).max(axis=1) / np.minimum(1.0, sizes_of / FULL_TRIGRAMS)
        rows.append(found)
        owner += [number] * len(found)
        floor += [REJECT_PART * float(np.quantile(near, REJECT_QUANTILE))] * len(found)
    return Model(
        languages if rows else [],
        idf,
        np.concatenate(rows) if rows else np.zeros((0, BUCKETS), np.float32),
        np.array(owner, np.int64),
        np.array(floor),
    )


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score (the cosine) and rejected.

    ``und``, 0 and rejected: null texts, texts without a letter, and all texts if the model
    knows no language. Only ``text`` is read for it. Ties go to the first language by name.
    Columns of these names are replaced.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = [known.predict(t.as_py()) for t in batch.column("text")]
            columns = zip(*found) if found else ([], [], [])
            types = (pa.string(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c, t) for c, t in zip(columns, types))],
                names=[*batch.schema.names, "lang_pred", "score", "rejected"],
            )

    docs = docs.drop("lang_pred", "score", "rejected")
    schema = docs.withColumns(
        {"lang_pred": f.lit(""), "score": f.lit(0.0), "rejected": f.lit(True)}
    ).schema
    return docs.mapInArrow(run, schema)


def fit_documents(docs: DataFrame) -> Model:
    """A model from the documents that are not held out."""
    learn = docs.filter(~held_out() & f.col("doc_id").isNotNull())
    return fit(learn.select("doc_id", "text", "lang"))
