"""Lempel-Ziv phrase fingerprints: minimum hashes over the phrases a text is parsed into."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwell.llm.common import map_batches

#: Bins of a signature; each keeps 16 bits of its smallest phrase hash, EMPTY if it has none.
BINS = 128
EMPTY = 0xFFFF
FIRST_PLACE = -(1 << 63)


def parse(data: bytes, known: dict[int, int], node: int = 0) -> int:
    """Parse bytes into phrases: the longest known phrase and one byte more is a new one.

    A phrase is a node below its longest proper prefix; `known` maps (node, byte) to the
    node there, in the order in which phrases were found. Returns the node reached, from
    which the parse of a continued text goes on.
    """
    get, found = known.get, len(known)
    for byte in data:
        key = node << 8 | byte
        node = get(key)
        if node is None:
            found += 1
            known[key] = found
            node = 0
    return node


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def signatures(parsed: list[dict[int, int]]) -> np.ndarray:
    """A row of BINS values for each set of phrases.

    A phrase's hash follows from its prefix's hash and its last byte, so it depends on the
    phrase alone; hashes are made level by level for all texts at once.
    """
    sizes = np.array([len(p) for p in parsed])
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))
    hashes = np.zeros(starts[-1], np.uint64)
    hashes[starts[:-1]] = 0x9E3779B97F4A7C15
    resolved = np.zeros(starts[-1], bool)
    resolved[starts[:-1]] = True
    keys = np.concatenate([np.fromiter(p, np.int64, len(p)) for p in parsed])
    base = np.repeat(starts[:-1], sizes)
    waiting = np.flatnonzero(~resolved)
    parents, last = (keys >> 8) + base, (keys & 255).astype(np.uint64)
    while len(waiting):
        ready = resolved[parents]
        hashes[waiting[ready]] = _mix(hashes[parents[ready]] * np.uint64(257) + last[ready] + np.uint64(1))
        resolved[waiting[ready]] = True
        waiting, parents, last = waiting[~ready], parents[~ready], last[~ready]
    out = np.full((len(parsed), BINS), EMPTY, np.uint16)
    for row, (start, size) in enumerate(zip(starts, sizes)):
        own = np.sort(hashes[start + 1 : start + 1 + size])
        bins = (own >> np.uint64(57)).astype(np.int64)
        first = np.flatnonzero(np.diff(bins, prepend=-1))
        out[row, bins[first]] = own[first] % np.uint64(EMPTY)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated share of common phrases, 0 to 1, row by row; two empty sets are alike."""
    either = (a != EMPTY) | (b != EMPTY)
    same = ((a == b) & either).sum(1)
    return np.where(either.any(1), same / np.maximum(either.sum(1), 1), 1.0)


def _bucket(place: Column, bounds: list[int], first: int = 0) -> Column:
    """How many bounds are at or below the place, by halving."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(place < bounds[middle], _bucket(place, bounds[:middle], first)).otherwise(
        _bucket(place, bounds[middle + 1 :], first + middle + 1)
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of an edited text, with their likeness.

    The edited text is the text whose last floor(n/2) code points are replaced by the first
    as many (or all) of the next document's. Documents follow each other by id (a NULL id
    comes first, repeated ids by text); the first one follows the last; a single document
    follows itself. A NULL text is an empty one; its fingerprint is all EMPTY and it is like
    empty texts only. Returns (id, n_chars, edited, fingerprint, edited_fingerprint,
    near_edited, near_next); an empty table gives no rows; other columns are not read.

    Ids are cut into ranges at approximate quantiles, two for each shuffle partition. A
    range's first document also goes to the end of the range before, so that each range is
    read in order by one task that holds about a million characters at a time. The driver
    sees the bounds and first ids of the ranges only.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("body"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(FIRST_PLACE)).alias("place"),
    )
    kind = dict(rows.dtypes)["key"]
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.approxQuantile("place", [i / ranges for i in range(1, ranges)], 0.25 / ranges)
    bounds = sorted({int(c) for c in cuts})
    ranged = rows.withColumn("range", _bucket(F.col("place"), bounds))
    firsts = sorted(tuple(r) for r in ranged.groupBy("range").agg(F.min("place")).collect())
    if not firsts:
        return spark.createDataFrame([], OUT.format(kind=kind)).withColumnRenamed("key", id_col)
    ends = [(place, firsts[i - 1][0]) for i, (_, place) in enumerate(firsts)]
    followers = rows.join(F.broadcast(spark.createDataFrame(ends, "place bigint, range int")), "place")
    both = ranged.withColumn("follower", F.lit(False)).unionByName(followers.withColumn("follower", F.lit(True)))
    dealt = both.repartition(ranges, "range").sortWithinPartitions("range", "follower", "place", "body")

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        held, at, closed = [], None, False
        for b in batches:
            for key, body, range_, follower in zip(b["key"], b["body"], b["range"], b["follower"]):
                if range_ != at:
                    held, at, closed, chars = [], range_, False, 0
                if closed:
                    continue
                held.append((key, body))
                closed, chars = follower, chars + len(body)
                if closed or chars > 1_000_000 and len(held) > 1:
                    yield _compared(held)
                    held, chars = held[-1:], 0

    return map_batches(dealt.select("key", "body", "range", "follower"), work, OUT.format(kind=kind)).withColumnRenamed("key", id_col)


OUT = (
    "key {kind}, n_chars bigint, edited string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _compared(held: list[tuple]) -> dict:
    """Results for all but the last of some documents in order."""
    own, edited, texts = [], [], []
    for (_, text), (_, following) in zip(held, held[1:]):
        half = len(text) // 2
        head = text[: len(text) - half]
        known: dict[int, int] = {}
        node = parse(head.encode(), known)
        other = known.copy()
        parse(text[len(text) - half :].encode(), known, node)
        parse(following[:half].encode(), other, node)
        own.append(known)
        edited.append(other)
        texts.append(head + following[:half])
    last: dict[int, int] = {}
    parse(held[-1][1].encode(), last)
    own = signatures([*own, last])
    edited = signatures(edited)
    return {
        "key": [k for k, _ in held[:-1]],
        "n_chars": [len(t) for _, t in held[:-1]],
        "edited": texts,
        "fingerprint": [r.astype(">u2").tobytes().hex() for r in own[:-1]],
        "edited_fingerprint": [r.astype(">u2").tobytes().hex() for r in edited],
        "near_edited": likeness(own[:-1], edited),
        "near_next": likeness(own[:-1], own[1:]),
    }
