"""Compression classifier: which of two zstandard dictionaries, of good and of bad text, shortens a text more.

The dictionaries are built from labelled text. A text's compressed sizes with either, normalised by its length, and
their normalised difference go through a logistic calibration fitted on labelled texts that built no dictionary.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled texts of each class that are fetched at most, the longest of them in code points, and the dictionary's bytes.
FIT_ROWS, FIT_CHARS, DICTIONARY_BYTES = 1600, 12_000, 96_000
LEVEL = 3
CUT = 0.7


class Model:
    """Two dictionaries and the calibration's weights; a few hundred KB, whatever the corpus."""

    def __init__(self, good: bytes, bad: bytes, weights: list[float]):
        self.good, self.bad, self.weights = good, bad, weights

    def opened(self) -> list[zstandard.ZstdCompressor]:
        """Compressors with each dictionary, and one without."""
        flags = {"level": LEVEL, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
        made = []
        for data in (self.good, self.bad):
            dictionary = zstandard.ZstdCompressionDict(data)
            dictionary.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(dict_data=dictionary, **flags))
        return [*made, zstandard.ZstdCompressor(**flags)]


def features(text: str | None, compressors: list[zstandard.ZstdCompressor]) -> list[float]:
    """Constant, normalised difference of the sizes, their levels by length, and how these bend; zeros for an empty text."""
    data = (text or "").encode("utf-8", "replace")
    if not data:
        return [1.0] + [0.0] * 7
    good, bad, plain = (len(c.compress(data)) for c in compressors)
    n = len(data)
    gap = (bad - good) / max(good, bad)
    low, bare = min(good, bad) / n, plain / n
    size = math.log(n) / 10
    return [1.0, gap, low, low * low, bare, gap * size, size, low * size]


def fitted(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Weights of a logistic regression by Newton steps; `weights` says what each row counts, one without."""
    w = np.zeros(rows.shape[1])
    each = np.ones(len(rows)) if weights is None else weights
    penalty = ridge * len(rows) * np.eye(rows.shape[1]) / 10
    penalty[0, 0] = 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        grad = rows.T @ (each * (p - labels)) + penalty @ w
        hess = (rows * (each * p * (1 - p))[:, None]).T @ rows + penalty + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def dictionary(texts: list[str], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary of at most `size` bytes; of too few or too short texts, their own bytes."""
    samples = [t.encode("utf-8", "replace") for t in texts]
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 4)), samples).as_bytes()
    except zstandard.ZstdError:
        share = max(64, size // max(1, len(samples)))
        return b"\n".join(x[:share] for x in samples)[-size:] or b"\n" * 16


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", learn_from: str | None = None) -> Model:
    """Learn from labelled documents.

    At most FIT_ROWS texts of each class, of at most FIT_CHARS code points, in hash order of their ids; every second one
    builds the dictionaries, the others calibrate, each class with the weight of all its labels, chosen or not, so that a
    score means the same at every size. Ids and lengths are joined, then only the chosen texts are fetched. `learn_from` is a SQL condition on `id`. Null texts and labels teach
    nothing; without both classes every text scores the share of good labels, one half without any.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("good")).where("good in (0, 1)").distinct()
    if learn_from:
        known = known.where(learn_from)
    sizes = docs.select(F.col(doc_id).alias("id"), F.length(text).alias("n")).where("n >= 1").distinct()
    labelled = known.join(sizes, "id")
    counted = {r.good: r.n for r in labelled.groupBy("good").agg(F.count_distinct("id").alias("n")).collect()}
    total = sum(counted.values())
    pairs = labelled.where(F.col("n") <= FIT_CHARS)
    chosen = {r.id: good for good in (0, 1) for r in pairs.where(F.col("good") == good).orderBy(F.md5(F.col("id").cast("string")), "id").limit(FIT_ROWS).select("id").collect()}
    sample: dict[int, list[str]] = {0: [], 1: []}
    if chosen:
        bodies: dict = {}
        found = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body")).where(F.col("id").isin(list(chosen)) & F.length("body").between(1, FIT_CHARS))
        for r in found.collect():
            bodies[r.id] = min(r.body, bodies.get(r.id, r.body))
        for i in chosen:
            sample[chosen[i]].append(bodies[i])
    if min(map(len, sample.values())) < 4:
        share = (counted.get(1, 0) + 0.5) / (total + 1)
        return Model(b"\n" * 16, b"\n" * 16, [math.log(share / (1 - share))] + [0.0] * 7)
    model = Model(dictionary(sample[1][::2]), dictionary(sample[0][::2]), [])
    compressors = model.opened()
    rest = [(t, g) for g in (0, 1) for t in sample[g][1::2]]
    rows = np.array([features(t, compressors) for t, _ in rest])
    marks = np.array([float(g) for _, g in rest])
    of_class = {g: counted[g] / total * len(rest) / len(sample[g][1::2]) for g in (0, 1)}
    model.weights = fitted(rows, marks, np.array([of_class[g] for _, g in rest])).tolist()
    return model


def learnable(doc_id: str = "id") -> str:
    """SQL condition of the rows that labels may be learned from: a quarter of ids is held out."""
    return f"crc32(cast(cast({doc_id} as string) as binary)) % 4 <> 2"


def scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """(row, score) of each (row, text)."""
    compressors = model.opened()
    weights = np.array(model.weights)
    for docs in batches:
        rows = np.array([features(t, compressors) for t in docs.column(1).to_pylist()]).reshape(-1, len(weights))
        yield pa.record_batch([docs.column(0), pa.array(1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30))))], names=["row", "score"])


def scores(docs: DataFrame, model: Model, keep: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, score) with column `keep` as row and score in [0, 1]: higher is likelier good. Whole texts; null is empty.

    No shuffle. The kept column goes through under a name of its
    own, so clashing names don't matter.
    """
    rows = docs.select(F.col(keep).alias("row"), F.col(text).alias("text"))
    return rows.mapInArrow(lambda b: scored(b, model), f"row {rows.schema['row'].dataType.simpleString()}, score double")


def kept_rows(batches: Iterator[pa.RecordBatch], model: Model, text: str, cut: float) -> Iterator[pa.RecordBatch]:
    """The rows whose text scores `cut` or more, every column as it came."""
    compressors = model.opened()
    weights = np.array(model.weights)
    for rows in batches:
        at = rows.schema.names.index(text)
        found = np.array([features(t, compressors) for t in rows.column(at).to_pylist()]).reshape(-1, len(weights))
        yield rows.filter(pa.array(1 / (1 + np.exp(-np.clip(found @ weights, -30, 30))) >= cut))


def kept(docs: DataFrame, model: Model, text: str = "text", cut: float = CUT) -> DataFrame:
    """Documents that score `cut` or more, columns unchanged; no shuffle."""
    return docs.mapInArrow(lambda b: kept_rows(b, model, text, cut), docs.schema)
