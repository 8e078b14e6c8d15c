"""Language of a text in two steps: its family first, then one-versus-one linear support vector machines within the family.

Texts are counts of runs of one to three letters and word edges, hashed to a fixed number of places, as square roots of
unit length. Families are learned too: languages whose mean vectors are alike are joined (average linkage) until there
are about as many families as languages in each.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.compression_quality import fitted

#: Places of a vector; documents learned from, about, shared evenly by the languages; fewest of a language, and most languages.
PLACES, SAMPLE, LEAST, LANGUAGES = 4096, 2400, 20, 128
#: Code points of a text that are taken at once (a word ends where a piece does), and texts that are scored at once.
PIECE, SLICE = 1 << 20, 256
UNKNOWN = "und"


@functools.cache
def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def spread(*parts: np.ndarray) -> np.ndarray:
    """Places of tuples of code points, by multiplying and folding 32-bit integers."""
    h = np.full(len(parts[0]), np.uint32(len(parts) * 0x27D4EB2F & 0xFFFFFFFF))
    for p in parts:
        h = (h ^ p.astype(np.uint32)) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
    return h & np.uint32(PLACES - 1)


def vector(text: str | None) -> np.ndarray | None:
    """The text's unit vector; None without a letter. Whole texts, whatever their length."""
    counts, found = np.zeros(PLACES), False
    for start in range(0, len(text or ""), PIECE):
        codes = np.frombuffer(text[start : start + PIECE].lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        known = letters()[codes]
        found = found or bool(known.any())
        edged = np.zeros(len(codes) + 2, dtype=np.uint32)
        edged[1:-1] = np.where(known, codes, 0)
        edged = edged[np.concatenate([[True], (edged[1:] != 0) | (edged[:-1] != 0)])]
        for n in (1, 2, 3):
            counts += np.bincount(spread(*[edged[i : len(edged) - n + 1 + i] for i in range(n)]), minlength=PLACES)
    return np.sqrt(counts / counts.sum()).astype(np.float32) if found else None


def machine(rows: np.ndarray, signs: np.ndarray, cost: float = 1.0, passes: int = 40) -> np.ndarray:
    """Weights, the constant last, of a linear support vector machine with squared hinge loss, by dual coordinate descent
    (Hsieh et al., 2008) in one fixed order."""
    rows = np.hstack([rows, np.ones((len(rows), 1), dtype=rows.dtype)])
    order = np.random.default_rng(7).permutation(len(rows))
    size = (rows * rows).sum(axis=1) + 0.5 / cost
    alpha, w = np.zeros(len(rows)), np.zeros(rows.shape[1], dtype=np.float32)
    for _ in range(passes):
        largest = 0.0
        for i in order:
            new = max(alpha[i] - (signs[i] * float(rows[i] @ w) - 1 + alpha[i] * 0.5 / cost) / size[i], 0.0)
            if new != alpha[i]:
                largest = max(largest, abs(new - alpha[i]))
                w += np.float32((new - alpha[i]) * signs[i]) * rows[i]
                alpha[i] = new
        if largest < 1e-3:
            break
    return w


def margins(rows: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Distances from the machines' planes, in units of their margins."""
    return rows @ w[:-1] + w[-1]


def calibrated(rows: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A machine fitted on all rows, and (constant, slope) of the logistic curve through margins of rows that the machine
    they are measured with hasn't seen."""
    half = np.arange(len(rows)) % 2 == 0
    unseen = np.zeros(len(rows))
    for part in (half, ~half):
        unseen[~part] = margins(rows[~part], machine(rows[part], signs[part]))
    curve = fitted(np.stack([np.ones(len(rows)), unseen], axis=1), (signs > 0).astype(float))
    return machine(rows, signs), curve


class Choice:
    """One-versus-one machines between some classes: (places, classes, weights of each pair, curve of each pair)."""

    def __init__(self, groups: list[np.ndarray]):
        self.pairs = list(combinations(range(len(groups)), 2))
        made = []
        for i, j in self.pairs:
            # Two of the one, two of the other: so every second row is of both.
            rows = np.vstack([groups[i], groups[j]])
            signs = np.repeat([1.0, -1.0], [len(groups[i]), len(groups[j])])
            order = np.argsort(np.concatenate([np.arange(len(g)) // 2 for g in (groups[i], groups[j])]), kind="stable")
            made.append(calibrated(rows[order], signs[order]))
        self.count = len(groups)
        self.weights = np.array([w for w, _ in made], dtype=np.float32).T
        self.curves = np.array([c for _, c in made])

    def shares(self, rows: np.ndarray) -> np.ndarray:
        """For each row and class its mean chance against the other classes, which add up to one."""
        out = np.zeros((len(rows), self.count))
        if self.count == 1:
            return out + 1
        chance = 1 / (1 + np.exp(-np.clip(self.curves[:, 0] + self.curves[:, 1] * margins(rows, self.weights), -30, 30)))
        for at, (i, j) in enumerate(self.pairs):
            out[:, i] += chance[:, at]
            out[:, j] += 1 - chance[:, at]
        return out / len(self.pairs)


def families(means: np.ndarray) -> list[list[int]]:
    """Classes joined by average linkage of their mean vectors' cosines until the square root of their number is left."""
    unit = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)
    alike = unit @ unit.T
    groups = [[i] for i in range(len(means))]
    while len(groups) > max(1, round(len(means) ** 0.5)):
        score = {(a, b): np.mean([alike[i, j] for i in groups[a] for j in groups[b]]) for a, b in combinations(range(len(groups)), 2)}
        a, b = max(score, key=lambda p: (score[p], -p[0], -p[1]))
        groups[a] = sorted(groups[a] + groups[b])
        del groups[b]
    return sorted(groups)


class Model:
    """Languages, their families, the choice between families and that within each: at most some 800 vectors."""

    def __init__(self, samples: dict[str, np.ndarray]):
        self.languages = sorted(samples)
        rows = [samples[x] for x in self.languages]
        self.families = families(np.array([r.mean(axis=0) for r in rows])) if rows else []
        self.between = Choice([np.vstack([rows[i] for i in f]) for f in self.families])
        self.within = [Choice([rows[i] for i in f]) for f in self.families]

    def predicted(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text: the chance of the family times that of the language within it."""
        out = [(UNKNOWN, 0.0)] * len(texts)
        if not self.languages:
            return out
        for start in range(0, len(texts), SLICE):
            found = [(start + i, v) for i, v in enumerate(map(vector, texts[start : start + SLICE])) if v is not None]
            if not found:
                continue
            at, rows = np.array([i for i, _ in found]), np.array([v for _, v in found])
            between = self.between.shares(rows)
            chosen = between.argmax(axis=1)
            for f in np.unique(chosen):
                mine = np.flatnonzero(chosen == f)
                inside = self.within[f].shares(rows[mine])
                best = inside.argmax(axis=1)
                for i, b, p, q in zip(at[mine], best, between[mine, f], inside[np.arange(len(mine)), best], strict=True):
                    out[i] = (self.languages[self.families[f][b]], float(min(1.0, p * q)))
        return out


def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, lang, vector) of texts with a letter."""
    for batch in batches:
        made = [vector(t) for t in batch.column(2).to_pylist()]
        has = pa.array([v is not None for v in made], pa.bool_())
        yield pa.record_batch([batch.column(0).filter(has), batch.column(1).filter(has), pa.array([v.tobytes() for v in made if v is not None], pa.binary())], names=["place", "lang", "vector"])


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", learn_from: str | None = None) -> Model:
    """Learn from documents with a language, about SAMPLE of them, shared evenly by at most LANGUAGES languages (the most
    frequent ones), in hash order of their ids.

    Vectors are made where the documents are; what reaches the driver is at most 2 * SAMPLE vectors of PLACES numbers, of
    whole texts however long. `learn_from` is a SQL condition on `id`. Null ids, texts and languages, and languages with
    fewer than two sampled texts with a letter, teach nothing; without any language every text is unknown.
    """
    known = docs.select(F.col(doc_id).alias("id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null and id is not null")
    if learn_from:
        known = known.where(learn_from)
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    if not counts:
        return Model({})
    steps, each = 1 << 30, max(LEAST, SAMPLE // len(counts))
    bound = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(steps, steps * each // n + 1))]), F.col("lang"))
    place = F.pmod(F.xxhash64("id"), F.lit(steps))
    sample = known.where(F.col("lang").isin(list(counts))).select(place.alias("place"), "lang", "text").where(place < bound)
    found = sample.mapInArrow(vectors, "place long, lang string, vector binary").orderBy("place", "lang", "vector").limit(2 * max(SAMPLE, LEAST * len(counts)))
    groups: dict[str, list[np.ndarray]] = {}
    for r in found.collect():
        groups.setdefault(r.lang, []).append(np.frombuffer(r.vector, dtype=np.float32))
    return Model({k: np.array(v) for k, v in groups.items() if len(v) > 1})


def scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """(row, lang_pred, score) of each (row, text)."""
    for docs in batches:
        made = model.predicted(docs.column(1).to_pylist())
        yield pa.record_batch([docs.column(0), pa.array([x for x, _ in made], pa.string()), pa.array([x for _, x in made], pa.float64())], names=["row", "lang_pred", "score"])


def predictions(docs: DataFrame, model: Model, keep: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, lang_pred, score) with column `keep` as row; no shuffle.

    Null texts and texts without a letter are `und` with score 0. Rows that share an id are judged each by its own text;
    other columns, whatever their names, aren't read.
    """
    rows = docs.select(F.col(keep).alias("row"), F.col(text).alias("text"))
    return rows.mapInArrow(lambda b: scored(b, model), f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double")
