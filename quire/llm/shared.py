"""The folder that driver and executors share, tables written there, and connected components over it."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.sinks import put_file  # noqa: F401  (the operators take it from here)

#: Rows that a table with a broadcast hint has at most.
BROADCAST_ROWS = 20_000


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder's URI below spark.checkpoint.dir; a folder without a scheme is one of the default file system.

    Only a local session, as in tests, may leave that unset: it gets a temporary folder. On a cluster that raises ValueError.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="quire-")
    if "://" not in base:
        path = spark._jvm.org.apache.hadoop.fs.Path(base)
        base = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
        base = "file://" + base.removeprefix("file:") if base.startswith("file:/") and not base.startswith("file://") else base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _written(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet to the shared folder and read again: its lineage ends here and survives lost executors."""
    return _written(spark, df, name)[0]


def _removed(spark: SparkSession, path: str) -> None:
    """Deletes a table that another one has replaced."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


Batches = Iterator[pa.RecordBatch]


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """run for mapInArrow; when a task ends, what it freed goes back to the system, as its worker waits for other operators' tasks."""

    def tidied(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return tidied


class Forest:
    """Union-find over ids; keeps only the links that join two trees."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        root = x
        while (up := self.up.get(root, root)) != root:
            root = up
        while x != root:
            self.up[x], x = root, self.up.get(x, x)
        return root

    def link(self, a: int, b: int) -> bool:
        x, y = self.find(a), self.find(b)
        if x != y:
            self.up[max(x, y)] = min(x, y)
            self.links.append((min(a, b), max(a, b)))
        return x != y


def links_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    """Links as rows (a, b)."""
    a, b = zip(*links, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def grouped(keys: int, of_group: Callable[[list[pa.RecordBatch]], pa.RecordBatch | None]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow over rows sorted by their first columns (whole numbers): calls of_group with the rows of each key.

    A task holds one group at a time, whatever the number of groups.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            values = np.column_stack([batch.column(c).to_numpy() for c in range(keys)])
            heads = np.r_[0, np.flatnonzero((values[1:] != values[:-1]).any(1)) + 1, len(values)]
            for lo, hi in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
                if held and tuple(values[lo]) != key:
                    if (found := of_group(held)) is not None:
                        yield found
                    held = []
                if hi > lo:
                    key = tuple(values[lo])
                    held.append(batch.slice(lo, hi - lo))
        if held and (found := of_group(held)) is not None:
            yield found

    return tidy(run)


def components(spark: SparkSession, edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component) of every vertex of the edges (a, b): component is its smallest reachable vertex.

    Alternates large-star and small-star steps. Each is a minimum by key with partial sums and a join on that key, whose
    large partitions the optimiser may split, so a hub of many edges does not meet in one task. Every round is written to
    the shared folder. Self links are dropped; an empty edge table gives an empty result.
    """
    cur, path = _written(spark, edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct(), "edges")
    mark = _mark(cur)
    for _ in range(most_rounds):
        if mark[0] == 0:
            break
        both = cur.select(F.col("v").alias("x"), F.col("m").alias("y")).unionAll(cur.select(F.col("m").alias("x"), F.col("v").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("low")).select("x", F.least("x", "low").alias("low"))
        large = both.join(least, "x").where("y > x").select(F.col("y").alias("v"), F.col("low").alias("m")).distinct()
        low = large.groupBy("v").agg(F.min("m").alias("low"))
        joined = large.join(low, "v")
        small = joined.where("m <> low").select(F.col("m").alias("v"), F.col("low").alias("m")).unionAll(low.select("v", F.col("low").alias("m")))
        old, (cur, path) = path, _written(spark, small.distinct(), "edges")
        _removed(spark, old)
        now = _mark(cur)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("v").alias("id"), F.col("m").alias("component")).unionAll(cur.select(F.col("m").alias("id"), F.col("m").alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)")), F.sum(F.xxhash64("m", "v", F.lit(1)).cast("decimal(38,0)"))).first()
    return tuple(row)


def ties_of_repeated(spark: SparkSession, rows: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Links (a, b) between the classes of each id that stands in several; None if there is no such id.

    rows: id, k1, k2; classes: k1, k2 and id, the one that stands for the class.
    """
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in ("k1", "k2") for f in (F.min, F.max)]
    several = stored(spark, rows.groupBy("id").agg(*ends).where("min_k1 <> max_k1 or min_k2 <> max_k2").select("id"), "several")
    if several.isEmpty():
        return None
    mine = rows.join(several, "id").select(F.col("id").alias("row"), "k1", "k2").join(classes.select("k1", "k2", "id"), ["k1", "k2"]).select("row", "id").distinct()
    return mine.join(mine.groupBy("row").agg(F.min("id").alias("b")), "row").where("id <> b").select(F.col("id").alias("a"), "b")
