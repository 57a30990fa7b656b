"""A quality classifier learnt without labels, from heuristic labellers that overlap."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwell.llm.common import map_batches, worker_memory

GOOD, BAD, ABSTAIN = "1", "0", "-"
#: Hashed dimensions of the scorer.
DIMENSIONS = 1 << 14
#: Expected number of documents that the scorer is fitted on.
SAMPLE = 6000
#: Documents that score lower are rejected.
LEAST_SCORE = 0.3
REMEMBERED = 400_000

_UPPER, _LETTER, _DIGIT, _SPACE, _MARK, _END, _SYMBOL = 1, 2, 3, 4, 5, 6, 7
_KIND = np.full(256, _SYMBOL, np.uint8)
_KIND[128:] = _LETTER
for _kind, _bytes in (
    (_UPPER, bytes(range(65, 91))), (_LETTER, bytes(range(97, 123))), (_DIGIT, b"0123456789"),
    (_SPACE, b" \t\n\r\x0b\x0c"), (_MARK, b",;:'\"-()/"), (_END, b".?!"),
):
    _KIND[list(_bytes)] = _kind


def _vote(value: float, good: float, bad: float) -> str:
    """Good up to `good`, bad from `bad` on, else no vote."""
    return GOOD if value <= good else BAD if value >= bad else ABSTAIN


def case_votes(n: np.ndarray) -> str:
    """Shouting: the share of capitals among the letters."""
    letters = n[_UPPER] + n[_LETTER]
    return _vote(n[_UPPER] / letters, 0.12, 0.4) if letters else BAD


def symbol_votes(n: np.ndarray) -> str:
    """The share of characters that are no letters, digits or usual marks."""
    return _vote(n[_SYMBOL] / max(1, n.sum() - n[_SPACE]), 0.01, 0.04)


def doubled_votes(data: np.ndarray, kinds: np.ndarray, words: int) -> str:
    """Doubled marks and symbols, such as !! or ***, for each word."""
    twice = (data[1:] == data[:-1]) & (kinds[1:] >= _MARK)
    return _vote(int(twice.sum()) / max(1, words), 0.02, 0.25)


def sentence_votes(n: np.ndarray, words: int) -> str:
    """Words for each sentence end."""
    if words < 12:
        return ABSTAIN
    return _vote(words / max(0.5, float(n[_END])), 40, 80)


def repeat_votes(words: list[str]) -> str:
    """The share of word triples that were there before."""
    if len(words) < 12:
        return ABSTAIN
    triples = len(words) - 2
    return _vote(1 - len(set(zip(words, words[1:], words[2:]))) / triples, 0.1, 0.3)


def line_votes(text: str) -> str:
    """The share of characters in lines that were there before."""
    lines = [x for x in text.split("\n") if x.strip()]
    if len(lines) < 3:
        return ABSTAIN
    return _vote(1 - sum(map(len, set(lines))) / sum(map(len, lines)), 0.1, 0.4)


def bare_votes(words: list[str]) -> str:
    """The share of words without a letter or digit, as in tables and menus."""
    bare = sum(not w.strip("|-+*=_/<>~#.,:;") for w in words)
    return _vote(bare / max(1, len(words)), 0.02, 0.15)


def stutter_votes(words: list[str]) -> str:
    """The share of words that are the word before."""
    if len(words) < 6:
        return ABSTAIN
    return _vote(sum(map(str.__eq__, words, words[1:])) / len(words), 0.03, 0.2)


LABELLERS = ("case", "symbol", "doubled", "sentence", "repeat", "line", "bare", "stutter")


def votes(text: str | None) -> str:
    """One character for each of LABELLERS: good, bad or no vote."""
    text = text or ""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = _KIND[data]
    n = np.bincount(kinds, minlength=8)
    words = text.split()
    return "".join(
        (
            case_votes(n), symbol_votes(n), doubled_votes(data, kinds, len(words)), sentence_votes(n, len(words)),
            repeat_votes(words), line_votes(text), bare_votes(words), stutter_votes(words),
        )
    )


def label_model(patterns: dict[str, int], rounds: int = 200) -> dict[str, float]:
    """Expectation maximisation over vote patterns and their counts: pattern -> P(good).

    A labeller that votes says "bad" of a good text with one chance and of a bad text with
    another; not to vote says nothing. Labellers are made to object rarely and to miss
    often, so a first guess takes a text as bad where any of them objects. Chances are
    smoothed towards that (5 % and 40 %) with a hundredth of all texts, and an objection
    always speaks for "bad".
    """
    if not patterns:
        return {}
    names = list(patterns)
    weight = np.array([patterns[p] for p in names], float)
    bad_vote = np.array([[v == BAD for v in p] for p in names], float)
    cast = np.array([[v != ABSTAIN for v in p] for p in names], float)
    good = np.where(bad_vote.any(1), 0.1, 0.95)
    prior = weight.sum() / 100
    for _ in range(rounds):
        chances = []
        for share, usual in ((good, 0.05), (1 - good, 0.4)):
            mass = weight * share
            chances.append((mass @ bad_vote + prior * usual) / (mass @ cast + prior))
        chances[1] = np.maximum(chances[1], chances[0])
        logs = [
            bad_vote @ np.log(c) + (cast - bad_vote) @ np.log(1 - c) + np.log(weight @ share + 1)
            for c, share in zip(chances, (good, 1 - good))
        ]
        new = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -40, 40)))
        done = np.abs(new - good).max() < 1e-6
        good = new
        if done:
            break
    return dict(zip(names, good.tolist()))


_RUNS = (
    (re.compile("[A-Z]+"), "A"), (re.compile("[a-zß-\U0010ffff]+"), "a"), (re.compile("[0-9]+"), "9"),
    (re.compile(r"(.)\1\1+"), r"\1\1"),
)


def _shape(word: str, known: dict[str, int]) -> int:
    """A hash of a word's shape: runs of capitals, small letters and digits, and its marks."""
    from xxhash import xxh32_intdigest

    shape = word
    for pattern, by in _RUNS:
        shape = pattern.sub(by, shape)
    if len(known) >= REMEMBERED:
        known.clear()
    value = xxh32_intdigest(shape.encode("utf-8", "surrogatepass"))
    if len(word) < 40:
        known[word] = value
    return value


def features(text: str | None, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed shapes of words, of neighbouring words, and of words that are the word before:
    (dimensions, values of unit length).

    Dimension 0 is a constant that every text has.
    """
    known = worker_memory("weak_quality", dict)
    words = (text or "").split()
    one = np.array([known.get(w) or _shape(w, known) for w in words], np.uint64)
    two = one[1:] * np.uint64(0x9E3779B1) + one[:-1]
    again = np.full(sum(map(str.__eq__, words, words[1:])), 1 << 40, np.uint64)
    mixed = np.concatenate([one, two, again]) * np.uint64(0x9E3779B97F4A7C15)
    at, times = np.unique((mixed >> np.uint64(40)) % np.uint64(dimensions - 1) + np.uint64(1), return_counts=True)
    values = np.log1p(times)
    values /= max(1e-9, float(np.sqrt((values * values).sum())))
    return np.concatenate(([0], at.astype(np.int64))), np.concatenate(([1.0], values))


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]], dimensions: int = DIMENSIONS, rounds: int = 300) -> np.ndarray:
    """Logistic regression on soft labels, by gradient steps that adapt to each dimension."""
    weights = np.zeros(dimensions)
    if not rows:
        return weights
    row = np.repeat(np.arange(len(rows)), [len(a) for a, _, _ in rows])
    at, value = np.concatenate([a for a, _, _ in rows]), np.concatenate([v for _, v, _ in rows])
    wanted = np.array([p for _, _, p in rows])
    # both classes weigh the same
    share = np.clip(wanted.mean(), 0.02, 0.98)
    weight = wanted * 0.5 / share + (1 - wanted) * 0.5 / (1 - share)
    seen = np.zeros(dimensions)
    for _ in range(rounds):
        score = np.bincount(row, value * weights[at], minlength=len(rows))
        error = weight * (1 / (1 + np.exp(-np.clip(score, -40, 40))) - wanted)
        slope = np.bincount(at, error[row] * value, minlength=dimensions) / len(rows) + 1e-5 * weights
        seen += slope * slope
        weights -= 0.5 * slope / np.sqrt(seen + 1e-12)
    return weights


@dataclass(frozen=True)
class QualityModel:
    posteriors: dict
    weights: np.ndarray

    def score(self, text: str | None) -> float:
        at, value = features(text, len(self.weights))
        return float(1 / (1 + np.exp(-np.clip(self.weights[at] @ value, -40, 40))))

    def keeps(self, text: str | None, least: float = LEAST_SCORE) -> bool:
        """Whether a text has words and scores enough."""
        return bool(text) and not text.isspace() and self.score(text) >= least


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, dimensions: int = DIMENSIONS
) -> QualityModel:
    """Count the vote patterns of all rows, estimate the labellers, and fit the scorer.

    The driver gets one row for each vote pattern (at most 3 to the number of labellers)
    and the hashed features of about `sample` rows, taken by a hash of id and text, on
    which the scorer is fitted. No rows give a scorer that says 0.5 of every text.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("key"), F.col(text_col).alias("body"))

    def vote(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            found, times = np.unique([votes(t) for t in b["body"]], return_counts=True)
            yield {"votes": found.tolist(), "n": times}

    counted = map_batches(rows.select("body"), vote, "votes string, n bigint").groupBy("votes").agg(F.sum("n").alias("n"))
    patterns = {r.votes: r.n for r in counted.collect()}
    posteriors = label_model(patterns)

    def describe(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            found = [features(t, dimensions) for t in b["body"]]
            yield {
                "at": [a for a, _ in found],
                "value": [v for _, v in found],
                "good": [posteriors[votes(t)] for t in b["body"]],
            }

    parts = 1 << 30
    rate = min(parts, sample * parts // max(1, sum(patterns.values())) + 1)
    chosen = rows.where(F.pmod(F.xxhash64("key", "body"), F.lit(parts)) < rate).select("body").limit(2 * sample)
    table = map_batches(chosen, describe, "at array<int>, value array<double>, good double").collect()
    table.sort(key=lambda r: (r.good, r.at, r.value))
    return QualityModel(posteriors, fit_scorer([(np.array(r.at), np.array(r.value), r.good) for r in table], dimensions))


def classify(
    docs: DataFrame, model: QualityModel, least: float = LEAST_SCORE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, votes, posterior, score, keep), one row per input row.

    `posterior` is the labellers' P(good), NULL for votes that the model has not seen,
    `score` the scorer's, and `keep` whether it reaches `least`. A NULL text is an empty
    one; texts without words are not kept. Repeated and NULL ids are rows of their own;
    other columns are not read. The model (weights and patterns) travels with the tasks.
    """
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("body"))
    kind = dict(rows.dtypes)["key"]

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            cast = [votes(t) for t in b["body"]]
            scores = [model.score(t) if t and not t.isspace() else 0.0 for t in b["body"]]
            yield {
                "key": b["key"], "votes": cast, "posterior": [model.posteriors.get(v) for v in cast],
                "score": scores, "keep": [s >= least for s in scores],
            }

    return map_batches(
        rows, work, f"key {kind}, votes string, posterior double, score double, keep boolean"
    ).withColumnRenamed("key", id_col)
