"""Language identification: the nearest of several TF-IDF centroids per language, by cosine."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded, dealt, stored, text_of

# Hashed features: runs of 1 to 3 characters of lower-cased letters, words set off by blanks.
DIM_BITS = 12
DIMS = 1 << DIM_BITS
GRAMS = (1, 2, 3)
CENTROIDS = 3
# Labelled rows per language whose vectors are clustered, about: they are chosen by hash.
SAMPLE_ROWS = 1000
ROUNDS = 10
# A text is rejected if it is farther from its centroid than this share of the sample's distances
# reaches, widened by SLACK; the label stays beside it.
REACH, SLACK = 0.99, 1.5
UNKNOWN = "und"
MULTIPLIERS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)
BATCH_ROWS = 512

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters, once per worker process."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def gram_counts(text: str) -> np.ndarray | None:
    """Counts of the hashed runs of a whole text; none without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[points]
    if not is_letter.any():
        return None
    points = np.where(is_letter, points, np.uint32(32))
    # One blank before, after and between words.
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    blank, points = np.array([32], np.uint32), points[keep]
    points = np.concatenate([blank, points[:-1] if points[-1] == 32 else points, blank])
    counts = np.zeros(DIMS, np.int64)
    mixed = [points * np.uint32(m) for m in MULTIPLIERS]
    for n in GRAMS:
        if len(points) < n:
            continue
        size = len(points) - n + 1
        h = np.full(size, n * 0x27D4EB2F & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            h = (h ^ mixed[k][k : k + size]) * np.uint32(0x165667B1)
        counts += np.bincount(h >> np.uint32(32 - DIM_BITS), minlength=DIMS)
    return counts


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised: (1 + log count) times the inverse document frequency."""
    v = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0.0) * idf
    return (v / np.linalg.norm(v)).astype(np.float32)


@dataclass
class Model:
    """Labels of the centroids, the centroids as rows, their reach, and the idf of the features."""

    labels: list[str]
    centroids: np.ndarray
    reach: np.ndarray
    idf: np.ndarray


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(feature, n): texts with the feature, over all rows; feature -1 counts the texts. Every task
    sends one row per feature at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMS + 1, np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                c = gram_counts(t)
                if c is not None:
                    total[:DIMS] += c > 0
                    total[DIMS] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.where(at == DIMS, -1, at)), pa.array(total[at])], ["feature", "n"])

    found = docs.select(text_of().alias("t")).mapInArrow(count, "feature bigint, n bigint")
    return found.groupBy("feature").agg(F.sum("n").alias("n"))


def clusters(vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: unit centroids and each row's cosine to its own."""
    chosen = [0]
    best = vectors @ vectors[0]
    while len(chosen) < min(k, len(vectors)):
        far = int(best.argmin())
        chosen.append(far)
        best = np.maximum(best, vectors @ vectors[far])
    centres = vectors[chosen]
    for _ in range(ROUNDS):
        own = (vectors @ centres.T).argmax(1)
        sums = np.stack([vectors[own == i].sum(0) if (own == i).any() else centres[i] for i in range(len(centres))])
        centres = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centres.astype(np.float32), vectors @ centres.T


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, k: int = CENTROIDS) -> Model | None:
    """The model of (doc_id, text, lang) rows with a label; null without a text that has a letter.

    Document frequencies cover all rows. The clusters are those of about `sample_rows` texts per
    language, chosen by a hash of the id; a language is clustered in one task from that sample.
    """
    rows = docs.where(F.col("lang").isNotNull())
    found = {r["feature"]: r["n"] for r in document_frequencies(dealt(rows)).collect()}
    n = found.pop(-1, 0)
    if not n:
        return None
    df = np.zeros(DIMS)
    df[list(found)] = list(found.values())
    idf = np.log((1 + n) / (1 + df)) + 1
    # One row per language, sent to every task if it is short, so that texts stay where they are.
    sizes = stored(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    chance = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.join(bounded(sizes), "lang").where(chance * F.col("n") < sample_rows).select("lang", "doc_id", text_of().alias("t"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for j in range(0, b.num_rows, BATCH_ROWS):
                part = b.slice(j, BATCH_ROWS)
                counts = [gram_counts(t) for t in part.column(2).to_pylist()]
                use = [i for i, c in enumerate(counts) if c is not None]
                raw = [vector(counts[i], idf).astype("<f2").tobytes() for i in use]
                some = part.select([0, 1]).take(pa.array(use, pa.int64()))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(raw, pa.binary())], ["lang", "doc_id", "v"])

    def centres(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["doc_id", "v"], kind="stable")
        m = np.stack([np.frombuffer(x, "<f2").astype(np.float32) for x in g["v"]])
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        c, near = clusters(m, k)
        own, best = near.argmax(1), near.max(1)
        reach = [float(np.quantile(1 - best[own == i], REACH)) if (own == i).any() else 0.0 for i in range(len(c))]
        return pd.DataFrame({"lang": g["lang"].iloc[0], "no": range(len(c)), "c": [x.astype("<f4").tobytes() for x in c], "reach": reach})

    kind = rows.schema["doc_id"].dataType.simpleString()
    sampled = sample.mapInArrow(vectors, f"lang string, doc_id {kind}, v binary")
    out = sampled.groupBy("lang").applyInPandas(centres, "lang string, no int, c binary, reach double").collect()
    out = sorted(out, key=lambda r: (r["lang"], r["no"]))
    if not out:
        return None
    stack = np.stack([np.frombuffer(r["c"], "<f4") for r in out])
    return Model([r["lang"] for r in out], stack, np.array([r["reach"] for r in out]), idf.astype(np.float32))


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, lang_pred, score, rejected.

    The label of the nearest centroid and its cosine, 0 to 1; ties go to the first label. Rejected are
    texts farther from their centroid than its reach. A null text, one without a letter, and
    every text without a model is `und` with score 0 and rejected.
    """

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, scores, far = [], [], []
            for t in b.column(1).to_pylist():
                c = gram_counts(t or "") if model else None
                if c is None:
                    names.append(UNKNOWN), scores.append(0.0), far.append(True)
                    continue
                near = model.centroids @ vector(c, model.idf)
                i = int(near.argmax())
                names.append(model.labels[i])
                scores.append(float(min(1.0, max(0.0, near[i]))))
                far.append(bool(1 - near[i] > model.reach[i] * SLACK))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(far, pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return dealt(rows).mapInArrow(label, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: a fixed quarter, by checksum of the id."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """`predict` for all rows by a model of the rows that aren't held out, with held_out.

    Rows without a language are not learned from. Repeated rows are learned and labelled
    each; other columns are ignored; an empty table gives no rows.
    """
    model = fit(docs.where(~held_out()).select("doc_id", "text", F.col("lang").cast("string").alias("lang")))
    found = predict(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
