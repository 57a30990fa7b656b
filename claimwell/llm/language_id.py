"""Language identification by the nearest of several centroids of each language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwell.llm.common import map_batches

#: Hashed dimensions of the letter n-grams.
DIMENSIONS = 4096
GRAMS = (1, 2, 3)
CENTROIDS = 4
#: Expected number of learning texts of a language of which the clusters are made.
SAMPLE = 1200
#: A text is rejected below FLOOR times the cosine that all but the LOW share of its language's
#: learning texts of its class reach. Classes are of the number of different n-grams, two for each
#: doubling, so a short text that is repeated is judged as a short one.
LOW, FLOOR = 0.01, 0.75
CLASSES = 25
#: A class with fewer learning texts takes the floor of the one below. If all below have fewer
#: too, the floor is the share NEARNESS of the language's median cosine.
ENOUGH, NEARNESS = 30, 0.25

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def counts(text: str | None, dimensions: int = DIMENSIONS) -> np.ndarray | None:
    """Hashed counts of the 1-, 2- and 3-grams of the lower-cased letters.

    A run of other characters counts as one space. None without a letter.
    """
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _letters()[points]
    if not is_letter.any():
        return None
    points = np.where(is_letter, points, 32)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first of a run of others stays, as a space
    padded = np.concatenate(([32], points[keep], [32])).astype(np.uint64)
    if padded[-2] == 32:
        padded = padded[:-1]
    mixed, out = np.zeros(len(padded), np.uint64), np.zeros(dimensions, np.int64)
    shift = np.uint64(64 - (dimensions - 1).bit_length())
    for n in range(1, max(GRAMS) + 1):
        size = len(padded) - n + 1
        if size <= 0:
            break
        mixed = (mixed[:size] + padded[n - 1 : n - 1 + size]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        if n in GRAMS:
            hashed = mixed * np.uint64(0xBF58476D1CE4E5B9) >> shift
            out += np.bincount(hashed.astype(np.int64), minlength=dimensions)
    return out


@dataclass(frozen=True)
class LanguageModel:
    """`centroids` are unit rows, `owners` their languages, `floors` the least cosines of a row by class."""

    weights: np.ndarray
    centroids: np.ndarray
    owners: list
    floors: np.ndarray

    def predict(self, texts: list) -> tuple[list, list[float], list[bool]]:
        """(language, cosine, rejected) of each text; `und`, 0 and rejected without letters."""
        langs, scores, rejected = [], [], []
        for begin in range(0, len(texts), 256):
            found = [counts(t, len(self.weights)) for t in texts[begin : begin + 256]]
            some = [i for i, c in enumerate(found) if c is not None]
            best = {}
            if some and len(self.owners):
                near = vectors(np.stack([found[i] for i in some]), self.weights) @ self.centroids.T
                best = {i: (int(r.argmax()), float(r.max())) for i, r in zip(some, near)}
            for i in range(len(found)):
                k, cosine = best.get(i, (None, 0.0))
                langs.append("und" if k is None else self.owners[k])
                scores.append(min(max(cosine, 0.0), 1.0))
                rejected.append(k is None or cosine < self.floors[k][text_class(found[i])])
        return langs, scores, rejected


def text_class(counted: np.ndarray) -> int:
    """floor(2 log2 n) for n different n-grams."""
    return min((int(np.count_nonzero(counted)) ** 2).bit_length(), CLASSES) - 1


def floors_by_class(near: np.ndarray, classes: np.ndarray, nearness: float = NEARNESS) -> np.ndarray:
    """The least cosine of each class, from the cosines and classes of learning texts."""
    floors, last = np.zeros(CLASSES), nearness * float(np.median(near))
    for c in range(CLASSES):
        own = near[classes == c]
        if len(own) >= ENOUGH:
            last = FLOOR * float(np.quantile(own, LOW))
        floors[c] = last
    return floors


def vectors(counted: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Unit rows of damped counts times inverse document frequency."""
    rows = (np.log1p(counted) * weights).astype(np.float32)
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length == 0, 1, length)


def _clusters(rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means, begun at rows that are far from each other."""
    chosen = [rows.mean(0)]
    for _ in range(k - 1):
        chosen.append(rows[np.argmin(np.max(rows @ np.stack(chosen).T, axis=1))])
    centres = np.stack(chosen)
    for _ in range(12):
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
        owner = np.argmax(rows @ centres.T, axis=1)
        centres = np.stack([rows[owner == j].mean(0) if (owner == j).any() else centres[j] for j in range(k)])
    centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    return centres, np.max(rows @ centres.T, axis=1)


def fit(
    learn: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    dimensions: int = DIMENSIONS,
    k: int = CENTROIDS,
    sample: int = SAMPLE,
    nearness: float = NEARNESS,
) -> LanguageModel:
    """Learn from the rows with text and language; others are passed over.

    Document frequencies are counted over all these rows. The clusters of a language are
    made of about `sample` of its texts, taken by a hash of id and text (all, if it has fewer),
    and so are the floors; the number of languages has to be small. No rows give a model that says `und`.
    """
    rows = learn.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("key"), F.col(text_col).alias("body"), F.col(lang_col).cast("string").alias("label")
    )

    def frequencies(batches: Iterator[dict]) -> Iterator[dict]:
        seen, total = np.zeros(dimensions, np.int64), 0
        for b in batches:
            for text in b["body"]:
                found = counts(text, dimensions)
                if found is not None:
                    seen += found > 0
                    total += 1
        yield {"bucket": np.arange(-1, dimensions), "n": np.concatenate(([total], seen))}

    found = map_batches(rows.select("body"), frequencies, "bucket bigint, n bigint")
    table = dict(map(tuple, found.groupBy("bucket").agg(F.sum("n")).collect()))  # dimensions + 1 rows
    total = table.get(-1, 0)
    weights = np.log((1 + total) / (1 + np.array([table.get(i, 0) for i in range(dimensions)]))) + 1

    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = 1 << 20
    share = F.pmod(F.xxhash64("key", "body", F.lit("language sample")), F.lit(parts))
    limits = {lang: min(parts, max(1, sample * parts // n)) for lang, n in sizes.items()}
    limit = F.lit(0)
    for lang, most in limits.items():
        limit = F.when(F.col("label") == F.lit(lang), F.lit(most)).otherwise(limit)

    def cluster(pdf):
        import pandas as pd

        table = [c for c in (counts(t, dimensions) for t in pdf.sort_values(["key", "body"])["body"]) if c is not None]
        if not table:
            return pd.DataFrame({"label": [], "centre": [], "floors": []})
        centres, near = _clusters(vectors(np.stack(table), weights), min(k, len(table)))
        floors = floors_by_class(near, np.array([text_class(c) for c in table]), nearness).tolist()
        return pd.DataFrame(
            {"label": pdf["label"].iloc[0], "centre": [c.tolist() for c in centres], "floors": [floors] * len(centres)}
        )

    made = (
        rows.where(share < limit)
        .groupBy("label")
        .applyInPandas(cluster, "label string, centre array<float>, floors array<double>")
        .collect()  # k rows for each language
    )
    made.sort(key=lambda r: (r["label"], list(r["centre"])))
    return LanguageModel(
        weights,
        np.array([r["centre"] for r in made], np.float32).reshape(len(made), dimensions),
        [r["label"] for r in made],
        np.array([r["floors"] for r in made]).reshape(len(made), CLASSES),
    )


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected), one row per input row, from the whole text alone.

    `score` is the cosine to the nearest centroid, in 0 to 1; of equally near ones the
    first language counts. A text without a letter (or NULL) is `und`, 0 and rejected; a
    text below the centroid's floor for its class is rejected but keeps its nearest language. The model
    (some centroids) travels with the tasks.
    """
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("body"))
    kind = dict(rows.dtypes)["key"]

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            langs, scores, rejected = model.predict(b["body"])
            yield {"key": b["key"], "lang_pred": langs, "score": scores, "rejected": rejected}

    return map_batches(rows, work, f"key {kind}, lang_pred string, score double, rejected boolean").withColumnRenamed("key", id_col)
