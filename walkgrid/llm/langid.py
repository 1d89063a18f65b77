"""Language identification: nearest of several TF-IDF centroids per language by cosine, with rejection by distance."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walkgrid.llm.common import raw_texts, with_columns_in_arrow

UNKNOWN = "und"
#: Hashed n-gram features; a fixed width bounds the vectors and the model.
WIDTH = 4096
#: Labelled rows used for the fit, about so many in all, dealt evenly to the languages; the languages learned at most.
SAMPLE_ROWS, MAX_LANGUAGES = 4000, 200
CENTROIDS = 4
#: A text farther from every centroid than this share of the cosine that its language's training texts reach is rejected.
REJECT_SHARE = 0.3

_SHIFT = np.uint32(32 - 12)
#: A-Z lower-cased; digits, punctuation and controls become one separator.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def ngram_counts(text: bytes) -> np.ndarray:
    """Counts of the bytewise 1-, 2- and 3-grams of the words of a text, padded by blanks, hashed to ``WIDTH`` features."""
    raw = np.frombuffer(b" " + b" ".join(text.translate(_FOLD).split()) + b" ", np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(WIDTH, np.float32)
    two = raw[:-1] * np.uint32(257) + raw[1:] + np.uint32(70_000)
    three = two[:-1] * np.uint32(263) + raw[2:] + np.uint32(90_000_000)
    grams = np.concatenate((raw, two, three)) * np.uint32(2654435769)
    return np.bincount(grams >> _SHIFT, minlength=WIDTH).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=-1, keepdims=True)
    return x / np.where(size > 0, size, 1)


@dataclass
class Model:
    languages: list[str]
    of: np.ndarray  #: language of each centroid
    centroids: np.ndarray
    reach: np.ndarray  #: cosine that nearly all training texts of a centroid's language reach
    idf: np.ndarray

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(counts) * self.idf)

    def predict(self, counts: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine to its nearest centroid, and whether that is too far."""
        cosine = np.clip(self.vectors(counts) @ self.centroids.T, 0, 1)
        best = cosine.argmax(1)
        score = cosine[np.arange(len(best)), best]
        return [self.languages[i] for i in self.of[best]], score, score < REJECT_SHARE * self.reach[best]


def _clusters(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts at the mean direction and then at the row farthest from the starts so far."""
    starts = [_unit(x.mean(0))]
    while len(starts) < min(k, len(x)):
        starts.append(x[(x @ np.array(starts).T).max(1).argmin()])
    centers = np.array(starts)
    for _ in range(rounds):
        near = (x @ centers.T).argmax(1)
        centers = np.array([_unit(x[near == i].mean(0)) if (near == i).any() else centers[i] for i in range(len(centers))])
    return centers


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Model of the labelled rows (null text or label left out), or None if there are none.

    It is fitted on a hash sample of about ``sample_rows`` rows, dealt evenly to the languages; vectors of ``WIDTH`` counts
    are made where the rows are, and only those reach the driver: 24 KB a row at most, whatever the table or its texts hold.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.xxhash64(*labelled.columns).alias("h")).filter("text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()}
    if not sizes:
        return None
    languages, scale = sorted(sizes), 1 << 40
    share = F.create_map(*(F.lit(x) for la in languages for x in (la, int(min(1.0, sample_rows / len(languages) / sizes[la]) * scale))))
    sample = rows.filter(F.pmod("h", F.lit(scale)) < share[F.col("lang")])

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        packed = []
        for t in raw_texts(batch.column("text")):  # features that occur, and how often
            counts = ngram_counts(t)
            has = np.flatnonzero(counts)
            packed.append(has.astype("<u2").tobytes() + counts[has].astype("<f4").tobytes())
        return {"counts": pa.array(packed, pa.binary())}

    found = with_columns_in_arrow(sample, make, [T.StructField("counts", T.BinaryType())]).select("lang", "h", "counts").collect()
    found.sort(key=lambda r: (r["lang"], r["h"]))
    x, at = np.zeros((len(found), WIDTH), np.float32), {la: i for i, la in enumerate(languages)}
    for row, r in zip(x, found, strict=True):
        n = len(r["counts"]) // 6
        row[np.frombuffer(r["counts"], "<u2", n)] = np.frombuffer(r["counts"], "<f4", n, 2 * n)
    label = np.array([at[r["lang"]] for r in found], int)
    del found
    model = Model(languages, np.empty(0, int), np.empty((0, WIDTH)), np.empty(0), np.log((1 + len(x)) / (1 + np.count_nonzero(x, axis=0))).astype(np.float32) + np.float32(0.1))
    np.log1p(x, out=x)  # as ``vectors`` does, without copies of the whole
    x *= model.idf
    size = np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    x /= np.where(size > 0, size, 1)
    of, centers, reach = [], [], []
    for i in range(len(languages)):
        if (label == i).any():
            own = _clusters(x[label == i], CENTROIDS)
            of += [i] * len(own)
            centers.append(own)
            reach += [float(np.quantile((x[label == i] @ own.T).max(1), 0.02))] * len(own)
    model.of, model.centroids, model.reach = np.array(of), np.concatenate(centers).astype(np.float32), np.array(reach)
    return model


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (cosine to the nearest centroid, 0 to 1) and ``rejected``.

    Null texts and texts without a letter are ``und`` with score 0 and rejected; so are all texts if there is no model.
    Texts too far from every centroid keep the nearest language and are rejected. Only the text decides, the whole of it;
    rows, ties and repeated rows are independent of each other. Columns named as an output are replaced. The model that is
    broadcast has a fixed width and at most ``CENTROIDS * MAX_LANGUAGES`` rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    lettered = docs.withColumn("_letter", F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False)))

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        model = shared.value
        langs, scores, far = [], [], []
        texts, ok = raw_texts(batch.column(text)), batch.column("_letter").to_pylist()
        for at in range(0, len(texts), 256):
            part = [t if k and model is not None else b"" for t, k in zip(texts[at : at + 256], ok[at : at + 256], strict=True)]
            if model is not None:
                got, score, off = model.predict(np.array([ngram_counts(t) for t in part]))
            else:
                got, score, off = [UNKNOWN] * len(part), np.zeros(len(part)), np.ones(len(part), bool)
            for t, la, s, o in zip(part, got, score, off, strict=True):
                langs.append(la if t else UNKNOWN)
                scores.append(float(s) if t else 0.0)
                far.append(bool(o) or not t)
        return {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64()), "rejected": pa.array(far, pa.bool_())}

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    return with_columns_in_arrow(lettered, make, fields).drop("_letter")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document belongs to the fold that is never learned from."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(4)) == 2
