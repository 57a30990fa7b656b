"""Helpers of the corpus operators: tables in the shared folder, text batches, components."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import claimwell
from claimwell.session import shared_folder


#: Rows of a batch that are Python objects at one time.
ROWS = 512


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_SHIPPED: set[str] = set()
_HELD: dict[object, object] = {}


def worker_memory(owner: object, make: Callable[[], object]):
    """What an operator keeps in a worker process between tasks, such as words that it knows.

    A process keeps it for one owner at a time: the stages of a pipeline run in the same
    workers one after the other, and what the one before kept would only fill them.
    """
    if owner not in _HELD:
        _HELD.clear()
        _HELD[owner] = make()
    return _HELD[owner]


def ship(spark: SparkSession) -> None:
    """Give the tasks' Python workers this package.

    They import it by themselves where it lies in the working directory or on PYTHONPATH;
    elsewhere it travels as a zip file, once for each application.
    """
    root = Path(claimwell.__file__).resolve().parents[1]
    known = (os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep))
    context = spark.sparkContext
    if str(root) in map(os.path.realpath, known) or context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    packed = f"{tempfile.mkdtemp(prefix='claimwell-')}/claimwell.zip"
    with zipfile.ZipFile(packed, "w") as out:
        for module in sorted((root / "claimwell").rglob("*.py")):
            out.write(module, str(module.relative_to(root)))
    context.addPyFile(packed)


def settle(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write a table into the shared folder and read it back.

    This cuts the lineage: later jobs read the files, whichever executors are lost.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(
    df: DataFrame, work: Callable[[Iterator[dict[str, list]]], Iterator[dict]], schema: str, rows: int = ROWS
) -> DataFrame:
    """`mapInArrow` on columns: `work` gets batches as lists by column and yields the same.
    A batch has at most `rows` rows, whatever Spark hands over.

    Values that it yields may be lists, numpy arrays or Arrow arrays.
    """
    spark = df.sparkSession
    ship(spark)
    fields = spark.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(fields)
        parts = (b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows))
        for out in work(p.to_pydict() for p in parts):
            arrays = [
                out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type)
                for f in types
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=types)

    return df.mapInArrow(run, schema)


def filter_batches(df: DataFrame, column: str, keep: Callable[[list], list[bool]]) -> DataFrame:
    """The rows of `df` that `keep` says yes to, judged by one column, ROWS rows at a time."""
    at = df.columns.index(column)
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, ROWS):
                b = whole.slice(begin, ROWS)
                yield b.filter(pa.array(keep(b.column(at).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


@contextmanager
def many_objects() -> Iterator[None]:
    """While many objects without cycles are made, Python need not look for cycles."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def int_lists(parts: list[bytes]) -> pa.Array:
    """Little-endian 32-bit integers, one byte string per row, as an Arrow array of lists."""
    import numpy as np

    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in parts], out=offsets[1:])
    values = pa.array(np.frombuffer(b"".join(parts), "<i4"))
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of `links` (a long, b long): (node long, component long).

    The component is the smallest node of it. Nodes without a link do not appear; loops
    and repeated links are harmless, NULL ends are dropped, no links give no rows.

    Each round lets every node point its larger neighbours, then all its neighbours, at
    the smallest node it sees (large star, small star). Both are one aggregate and one
    join on the node, and the number of rounds grows with the logarithm of the longest
    chain. A round's links are written to the shared folder.
    """
    loops = links.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component"))
    pairs = (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    pairs = settle(pairs, "links")
    for _ in range(rounds):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = low.select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        # a node keeps its smallest neighbour and sends the others there
        small_low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(small_low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = small.unionByName(small_low.select("a", F.col("low").alias("b"))).where("a <> b").distinct()
        small = settle(small, "links")
        rest = small.join(small.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        uneven = small.groupBy("a").count().where("count > 1")
        pairs = small
        if rest.isEmpty() and uneven.isEmpty():
            break
    else:
        raise RuntimeError(f"links did not settle in {rounds} rounds")
    found = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return found.unionByName(roots).unionByName(loops).groupBy("node").agg(F.min("component").alias("component"))
