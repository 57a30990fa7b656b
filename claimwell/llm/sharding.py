"""K-d tree sharding at distributed weighted medians, in DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimwell.llm.common import settle

#: Bins of one pass of a median search. At most this many rows for each open node reach the driver.
BINS = 2048
#: A median search ends when the bin that holds the median weighs less than this share of its node.
CLOSE_ENOUGH = 1 / 8192
#: Rows of a shard are numbered in so many hash buckets side by side.
NUMBERING_BUCKETS = 1024
HIGHEST = (1 << 32) - 1


def _number(docs: DataFrame, column: str) -> Column:
    """A dimension as an integer of 32 bits that keeps the order: numbers as they are,
    text by its first four bytes, NULL as 0."""
    if dict(docs.dtypes)[column] in ("tinyint", "smallint", "int", "bigint", "date", "boolean"):
        value = F.col(column).cast("bigint")
    elif dict(docs.dtypes)[column] in ("float", "double") or dict(docs.dtypes)[column].startswith("decimal"):
        value = F.try_to_number(F.format_string("%.0f", F.col(column).cast("double")), F.lit("9" * 18)).cast("bigint")
    else:
        four = F.hex(F.substring(F.col(column).cast("string").cast("binary"), 1, 4))
        value = F.conv(F.rpad(four, 8, "0"), 16, 10).cast("bigint")
    return F.least(F.greatest(F.coalesce(value, F.lit(0)), F.lit(0)), F.lit(HIGHEST))


@dataclass
class Node:
    """A cell of the tree and the state of the search for its weighted median.

    Rows are compared by `keys` in turn: the widest dimension, then the text's checksum,
    then a hash of the row. `prefix` are the values of the keys already settled; the
    median's row has a value from `low` to `high` in the next one.
    """

    first: int
    shards: int
    weight: int = 0
    keys: list[str] = field(default_factory=list)
    prefix: list[int] = field(default_factory=list)
    low: int = 0
    high: int = 0
    before: int = 0
    done: bool = False

    @property
    def wanted(self) -> float:
        return self.weight * (self.shards // 2) / self.shards

    @property
    def step(self) -> int:
        return (self.high - self.low) // BINS + 1

    def bin(self) -> Column:
        """The row's bin; NULL for rows whose side is already known."""
        key = F.col(self.keys[len(self.prefix)])
        here = reduce(lambda a, b: a & b, [F.col(k) == v for k, v in zip(self.keys, self.prefix)], F.lit(True))
        return F.when(here & key.between(self.low, self.high), F.floor((key - self.low) / self.step).cast("bigint"))

    def narrow(self, weights: list[tuple[int, int]]) -> None:
        """Take the weights of the bins and go on in the bin that holds the median."""
        step, last = self.step, weights[-1][0]
        for bin_, weight in sorted(weights):
            if self.before + weight >= self.wanted or bin_ == last:
                break
            self.before += weight
        self.low, self.high = self.low + bin_ * step, min(self.high, self.low + (bin_ + 1) * step - 1)
        whole = weight <= CLOSE_ENOUGH * self.weight
        if not whole and self.low == self.high and len(self.prefix) + 1 < len(self.keys):
            self.prefix.append(self.low)
            self.low, self.high = 0, HIGHEST
        elif whole or self.low == self.high:
            self.done = True
            if abs(self.before + weight - self.wanted) < abs(self.before - self.wanted):
                self.low = self.high + 1  # the bin goes left as a whole

    def left(self) -> Column:
        """Whether a row lies before the median."""
        side = F.col(self.keys[len(self.prefix)]) < self.low
        for key, value in reversed(list(zip(self.keys, self.prefix))):
            side = (F.col(key) < value) | ((F.col(key) == value) & side)
        return side

    def halves(self) -> tuple[Node, Node]:
        left = self.shards // 2
        return Node(self.first, left), Node(self.first + left, self.shards - left)


def _by_node(nodes: list[Node], value) -> Column:
    """value(node) of the node that a row lies in (`cell` is the node's first shard)."""
    picked = F.lit(None)
    for node in nodes:
        picked = F.when(F.col("cell") == node.first, value(node)).otherwise(picked)
    return picked


def kd_shards(
    docs: DataFrame,
    dimensions: list[str],
    shards: int | None = None,
    target_bytes: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Put every row into one of the leaves of a k-d tree; leaves hold nearly equal bytes.

    The number of leaves is `shards`, or as many as give leaves of `target_bytes`. A cell
    is split along the dimension that is widest in it, relative to the whole table, at the
    weighted median (a cell of an odd number of leaves: at the matching share). A row
    weighs the UTF-8 bytes of its text plus 1, so NULL and empty texts weigh 1. Equal
    values of a dimension are told apart by the text's CRC-32, so that equal texts stay
    together unless they differ in a dimension or a cut falls among them, and then by a
    hash of the row, so that one value or text that holds a third of all rows is cut too.

    Returns (id, size, text_crc32, shard, slot); `slot` counts a shard's rows from 0
    without gaps. The CRC-32 of a NULL text is that of no bytes, 0. Repeated and NULL ids
    are rows of their own; other columns are only read where they are dimensions; an empty
    table gives no rows.

    Bytes pass through no shuffle until the numbering: a median search sums weights by bin
    on the map side, at most BINS rows for each cell, and narrows down; each row's cell
    follows from the cuts found so far.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    named = {f"dim{i}": _number(docs, c) for i, c in enumerate(dimensions)}
    rows = docs.select(
        F.col(id_col).alias("key"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("crc"),
        *[c.alias(n) for n, c in named.items()],
    )
    rows = settle(rows.withColumn("mixed", F.pmod(F.xxhash64("key", "crc", F.lit("cut")), F.lit(1 << 32))), "shard-rows")

    spread = [f(n).alias(f"{kind}_{n}") for n in named for kind, f in (("low", F.min), ("high", F.max))]
    whole = rows.agg(F.sum("size").alias("weight"), *spread).first()
    if shards is None:
        shards = max(1, -(-(whole.weight or 0) // target_bytes))
    placed, open_ = rows.withColumn("cell", F.lit(0)), [Node(0, shards)]
    while any(n.shards > 1 for n in open_) and whole.weight:
        open_ = [n for n in open_ if n.shards > 1]
        found = {
            r.cell: r
            for r in placed.where(F.col("cell").isin([n.first for n in open_]))
            .groupBy("cell").agg(F.sum("size").alias("weight"), *spread).collect()
        }
        open_ = [n for n in open_ if n.first in found]
        for node in open_:
            r = found[node.first].asDict()
            widths = {
                n: (r[f"high_{n}"] - r[f"low_{n}"]) / max(1, whole[f"high_{n}"] - whole[f"low_{n}"]) for n in named
            }
            widest = max(widths, key=lambda n: widths[n])
            node.weight, node.keys = r["weight"], [widest, "crc", "mixed"]
            node.low, node.high = r[f"low_{widest}"], r[f"high_{widest}"]
        while searching := [n for n in open_ if not n.done]:
            bins = (
                placed.select("cell", "size", _by_node(searching, Node.bin).alias("bin"))
                .where("bin is not null")
                .groupBy("cell", "bin").agg(F.sum("size").alias("weight"))
                .collect()
            )
            for node in searching:
                node.narrow(sorted((r.bin, r.weight) for r in bins if r.cell == node.first))
        side = _by_node(open_, lambda n: F.when(n.left(), n.first).otherwise(n.first + n.shards // 2))
        placed = placed.withColumn("cell", F.coalesce(side, "cell"))
        open_ = [half for n in open_ for half in n.halves()]

    bucket = F.pmod(F.xxhash64("key"), F.lit(NUMBERING_BUCKETS)).alias("bucket")
    placed = placed.select("key", "size", "crc", F.col("cell").cast("int").alias("shard"), bucket)
    # the counts are at most NUMBERING_BUCKETS rows for each shard
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "bucket").orderBy("key", "crc")
    numbered = placed.withColumn("place", F.row_number().over(within) - 1)
    return numbered.join(F.broadcast(offsets), ["shard", "bucket"]).select(
        F.col("key").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        "shard",
        (F.col("offset") + F.col("place")).cast("bigint").alias("slot"),
    )
