"""Periodic runs of words, found on an enhanced suffix array."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwell.llm.common import map_batches

#: A run has at least so many words and is at least so many periods long.
SHORTEST, PERIODS = 24, 3
#: Words whose suffixes are sorted together, and pairs that are tested together.
TOGETHER, PAIRS = 1 << 18, 1 << 21

words_of = re.compile(r"[^\x20\x09-\x0D]+").findall


def repeated(hashes: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """Which places lie in a string of `size` words that its owner holds twice.

    Hashes that collide mark too much, never too little.
    """
    n = len(hashes) - size + 1
    marked = np.zeros(len(hashes), bool)
    if n < 2:
        return marked
    mixed = hashes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    covered = 1
    while covered < size:
        step = min(covered, size - covered)
        mixed = mixed[: len(mixed) - step] * np.uint64(0xBF58476D1CE4E5B9) + mixed[step:]
        mixed ^= mixed >> np.uint64(29)
        covered += step
    inside = np.flatnonzero(owner[:n] == owner[size - 1 :])
    key = mixed[inside] + owner[inside].astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    by = np.argsort(key)
    same = key[by][1:] == key[by][:-1]
    twice = inside[by[np.concatenate((same, [False])) | np.concatenate(([False], same))]]
    change = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(change, twice, 1)
    np.add.at(change, twice + size, -1)
    return np.cumsum(change[:-1]) > 0


def suffix_ranks(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and its inverse, by sorting again those groups that are not single."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    first = np.concatenate(([True], symbols[order][1:] != symbols[order][:-1]))
    rank = np.zeros(n + 1, np.int64)  # 0 for what lies beyond the end
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0)) + 1
    alone = np.zeros(n, bool)
    alone[order] = first & np.concatenate((first[1:], [True]))
    depth = 1
    while len(rest := np.flatnonzero(~alone)):
        pair = rank[rest] << 32 | rank[np.minimum(rest + depth, n)]
        by = np.argsort(pair, kind="stable")
        rest, pair = rest[by], pair[by]
        group, places = pair >> 32, np.arange(len(pair))
        old = np.concatenate(([True], group[1:] != group[:-1]))
        new = np.concatenate(([True], pair[1:] != pair[:-1]))
        rank[rest] = group + np.maximum.accumulate(np.where(new, places, 0)) - np.maximum.accumulate(np.where(old, places, 0))
        alone[rest] = new & np.concatenate((new[1:], [True]))
        depth *= 2
    inverse = rank[:n] - 1
    order[inverse] = np.arange(n)
    return order, inverse


def common_prefixes(symbols: list[int], order: list[int], inverse: list[int]) -> list[int]:
    """Kasai's longest common prefix of each suffix and the one before it in the array."""
    n = len(symbols)
    common, h = [0] * n, 0
    for i, r in enumerate(inverse):
        if r:
            j = order[r - 1]
            most = n - max(i, j)
            while h < most and symbols[i + h] == symbols[j + h]:
                h += 1
            common[r] = h
            if h:
                h -= 1
        else:
            h = 0
    return common


def intervals(common: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each boundary k of the array the interval (left, right) of suffixes that share
    common[k] words: those from left on before k are one child, those from k up to right
    the others (of equal boundaries each parts one child from all after it)."""
    n = len(common)
    left, right, open_ = [0] * n, [n] * n, [0]
    for k in range(1, n):
        depth = common[k]
        while len(open_) > 1 and common[open_[-1]] > depth:
            right[open_.pop()] = k
        left[k] = open_[-1]
        open_.append(k)
    return np.array(left), np.array(right)


def branching_squares(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of every square whose next word does not go on with the period.

    In each interval of the suffix array, the suffixes i of the smaller child ask the
    inverse array whether i + depth or i - depth is in the other child.
    """
    order, inverse = suffix_ranks(symbols)
    common = common_prefixes(symbols.tolist(), order.tolist(), inverse.tolist())
    left, right = intervals(common)
    depth = np.array(common)
    n, boundary = len(symbols), np.arange(len(symbols))
    node = np.flatnonzero(depth > 0)
    smaller_left = boundary - left <= right - boundary
    begin, count = np.where(smaller_left, left, boundary), np.where(smaller_left, boundary - left, right - boundary)
    low, high = np.where(smaller_left, boundary, left), np.where(smaller_left, right, boundary)
    found = []
    for part in np.split(node, np.flatnonzero(np.diff(np.cumsum(count[node]) // PAIRS)) + 1):
        times = count[part]
        which = np.repeat(part, times)
        inner = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
        i, d = order[begin[which] + inner], depth[which]
        for start, other in ((i, i + d), (i - d, i - d)):
            there = np.flatnonzero((other >= 0) & (other < n))
            place = inverse[other[there]]
            there = there[(place >= low[which[there]]) & (place < high[which[there]])]
            found.append(np.stack([start[there], d[there]]))
    starts, periods = np.concatenate(found, 1) if found else np.empty((2, 0), np.int64)
    return starts, periods


def first_of_run(symbols: np.ndarray, start: int, period: int) -> int:
    """The square rotated to the left as long as the word before it goes on with the period."""
    step = 64
    while start:
        low = max(0, start - step)
        other = np.flatnonzero(symbols[low:start] != symbols[low + period : start + period])
        if len(other):
            return low + int(other[-1]) + 1
        start, step = low, 2 * step
    return 0


def runs_of(symbols: np.ndarray, shortest: int = SHORTEST, periods: int = PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every run of at least `shortest` words and `periods` periods."""
    if len(symbols) < shortest:
        return []
    start, period = branching_squares(symbols)
    # the run has to reach back to here
    back = np.minimum(start - (periods - 2) * period, start + 2 * period - shortest)
    near = np.flatnonzero(back >= 0)
    start, period, back = start[near], period[near], back[near]
    likely = (symbols[np.maximum(start - 1, 0)] == symbols[start - 1 + period]) | (back >= start)
    likely &= (symbols[back] == symbols[np.minimum(back + period, len(symbols) - 1)]) | (back >= start)
    start, period = start[likely], period[likely]
    by = np.lexsort((period, start + 2 * period))
    found, here, last = [], [], -1
    for i, q in zip(start[by].tolist(), period[by].tolist()):
        end = i + 2 * q
        if end != last:
            here, last = [], end
        # the square of a multiple of a period in the same run
        if any(i >= s and q % p == 0 for s, p in here):
            continue
        s = first_of_run(symbols, i, q)
        if end - s >= max(shortest, periods * q):
            here.append((s, q))
            found.append((s, end - s, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of_many(texts: list[list[str]], shortest: int = SHORTEST, periods: int = PERIODS) -> dict[int, list[tuple[int, int, int]]]:
    """Runs of each list of words that has any, by its number.

    A run repeats strings of max(shortest - q, (periods - 1) * q) words q further on, so it
    lies inside one stretch of strings of `sure` words that its text holds twice. The
    suffix arrays are over those stretches, whose words differ from stretch to stretch.
    """
    sure = min(max(shortest - q, (periods - 1) * q) for q in range(1, shortest + 1))
    sizes = np.array([len(t) for t in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    hashes = np.fromiter((hash(w) for t in texts for w in t), np.int64, int(sizes.sum()))
    marked = repeated(hashes, owner, sure)
    if not marked.any():
        return {}
    places = np.flatnonzero(marked)
    cut = np.concatenate(([True], (np.diff(places) > 1) | (np.diff(owner[places]) > 0)))
    begins = places[cut]
    stretch = np.cumsum(cut) - 1
    first_word = np.cumsum(sizes) - sizes
    numbers: dict[str, int] = {}
    local = (places - first_word[owner[places]]).tolist()
    words = [numbers.setdefault(texts[o][at], len(numbers)) for o, at in zip(owner[places].tolist(), local)]
    _, symbols = np.unique(stretch << 32 | np.array(words), return_inverse=True)
    found: dict[int, list[tuple[int, int, int]]] = {}
    ends = np.append(np.flatnonzero(cut)[1:], len(places))
    at = 0
    while at < len(places):
        # whole stretches of about TOGETHER words
        end = int(ends[max(np.searchsorted(ends, at + TOGETHER, "right") - 1, np.searchsorted(ends, at, "right"))])
        for start, length, period in runs_of(symbols[at:end], shortest, periods):
            s = stretch[at + start]
            place = places[at + start]
            text = int(owner[place])
            assert begins[s] <= place and owner[places[at + start + length - 1]] == text
            found.setdefault(text, []).append((int(place - first_word[text]), length, period))
        at = end
    return {t: sorted(r, key=lambda x: (x[0], x[2])) for t, r in found.items()}


def looped(words: list[str], seed: int) -> list[str]:
    """The words, from place a on in a loop of p words, both given by `seed`."""
    n, g = len(words), seed // 10
    if seed % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times, rest = divmod(n - a, p)
    return words[:a] + words[a : a + p] * times + words[a : a + rest]


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words without those that a run repeats: its words after the first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shortest: int = SHORTEST,
    periods: int = PERIODS,
    loop_seed: Column | None = None,
) -> DataFrame:
    """(id, n_words, runs array<struct<start, length, period>>, collapsed) of every whole text.

    Words are what stands between ASCII white space, numbered from 0. A run is a stretch
    with smallest period q that no neighbouring word extends, of at least `shortest` words
    and `periods` times q; runs are ordered by start, then period. `collapsed` are the
    words that no run repeats, joined by a space. With `loop_seed` (a long of each row) the
    texts are first given loops for trials, see `looped`; NULL gives none.

    A NULL text is an empty one, without words and runs. Repeated and NULL ids stay rows
    of their own, other columns are not read, no rows give no rows. Work is per row: no
    shuffle, and a text is held by one task only.
    """
    seed = F.lit(None).cast("bigint") if loop_seed is None else loop_seed.cast("bigint")
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("body"), seed.alias("seed"))
    kind = dict(rows.dtypes)["key"]

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            texts = [words_of(t) if t else [] for t in b["body"]]
            texts = [t if s is None else looped(t, s) for t, s in zip(texts, b["seed"])]
            found = runs_of_many(texts, shortest, periods)
            runs = [found.get(i, []) for i in range(len(texts))]
            yield {
                "key": b["key"],
                "n_words": [len(t) for t in texts],
                "runs": [[dict(zip(("start", "length", "period"), r)) for r in x] for x in runs],
                "collapsed": [" ".join(collapse(t, r)) for t, r in zip(texts, runs)],
            }

    run = "struct<start: bigint, length: bigint, period: bigint>"
    return map_batches(rows, work, f"key {kind}, n_words bigint, runs array<{run}>, collapsed string").withColumnRenamed(
        "key", id_col
    )
