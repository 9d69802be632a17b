"""Streaming forms: snapshot pages merged batch by batch, keyed latest states, sessions and late data under watermarks."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import catalog


SYNCS = "event_id long, sync_id long, source_id string, status string, cursor string, pages int"


class CatalogTables:
    """Versioned Parquet tables of a catalog: a batch writes new folders and then moves a small pointer table ahead.

    A batch that ran before (its number is the pointer's or older) is passed over, so a restarted query applies each batch once.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _pointer(self) -> int:
        try:
            return self.spark.read.schema("version long").parquet(f"{self.root}/pointer").agg(F.max("version")).first()[0] or 0
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return 0
            raise

    def records(self) -> DataFrame:
        v = self._pointer()
        return self.spark.read.schema(catalog.RECORDS).parquet(f"{self.root}/records/{v}") if v else catalog.empty(self.spark, catalog.RECORDS)

    def log(self, name: str, ddl: str) -> DataFrame:
        v = self._pointer()
        if not v:
            return catalog.empty(self.spark, ddl)
        return self.spark.read.schema(ddl + ", version long").parquet(f"{self.root}/{name}").where(F.col("version") <= v).drop("version")

    def apply(self, page: DataFrame, sync_id: int, batch: int, whole: bool = False) -> bool:
        """Merges a page as version batch + 1; False if that version stands already. Repeated keys refuse the page with ValueError."""
        version = batch + 1
        if version <= self._pointer():
            return False
        if not catalog.duplicate_keys(page).isEmpty():
            raise ValueError("a key repeats within the page")
        # The page and the state of its records are read by three writes: they are kept for these.
        m = catalog.merge(self.records(), page.persist(), sync_id, whole)
        m.records.write.mode("overwrite").parquet(f"{self.root}/records/{version}")
        m.revisions.write.mode("overwrite").parquet(f"{self.root}/revisions/version={version}")
        m.events.write.mode("overwrite").parquet(f"{self.root}/events/version={version}")
        self.spark.range(version, version + 1).select(F.col("id").alias("version")).write.mode("append").parquet(f"{self.root}/pointer")
        page.unpersist()
        return True


    def _syncs(self) -> DataFrame:
        """The latest state of each sync: sync_id, source_id, status, cursor, pages."""
        try:
            log = self.spark.read.schema(SYNCS).parquet(f"{self.root}/syncs")
            log.isEmpty()
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            log = catalog.empty(self.spark, SYNCS)
        last = lambda c: F.max_by(c, "event_id").alias(c)
        return log.groupBy("sync_id").agg(*map(last, ("source_id", "status", "cursor", "pages")))

    def _told(self, sync_id: int, source_id: str, status: str, cursor: str | None, pages: int) -> None:
        self.spark.createDataFrame([(time.time_ns(), sync_id, source_id, status, cursor, pages)], SYNCS).coalesce(1).write.mode("append").parquet(f"{self.root}/syncs")

    def begin_sync(self, source_id: str) -> tuple[int, str | None, int]:
        """(sync_id, cursor, pages) of the source's open sync, which then goes on after its cursor, or of a new one."""
        syncs = self._syncs()
        open_ = syncs.where((F.col("source_id") == source_id) & (F.col("status") == "running")).orderBy(F.desc("sync_id")).first()
        if open_ is not None:
            return open_.sync_id, open_.cursor, open_.pages
        sync_id = (syncs.agg(F.max("sync_id")).first()[0] or 0) + 1
        self._told(sync_id, source_id, "running", None, 0)
        return sync_id, None, 0

    def sync(self, source_id: str, pages: Callable[[str | None], Iterable[tuple[str | None, DataFrame]]]) -> dict[str, int]:
        """Merges a source's pages, each a cursor and rows, from where its open sync stopped; what the whole lacks becomes a tombstone.

        The keys that a sync has seen are a table of their own, so that tombstones are right after a restart too.
        """
        sync_id, cursor, n = self.begin_sync(source_id)
        seen = f"{self.root}/seen/{sync_id}"
        for cursor, rows in pages(cursor):
            rows.select("source_key").write.mode("overwrite").parquet(f"{seen}/page={n}")
            self.apply(catalog.snapshot(rows, source_id), sync_id, self._pointer())
            n += 1
            self._told(sync_id, source_id, "running", cursor, n)
        keys = self.spark.read.parquet(seen) if n else catalog.empty(self.spark, "source_key string")
        mine = self.records().where(F.col("source_id") == source_id)
        gone = mine.where("not tombstoned").join(keys.select("source_key").distinct(), "source_key", "left_anti").select("record_id")
        version = self._pointer() + 1
        records = self.records().join(gone.withColumn("_gone", F.lit(True)), "record_id", "left")
        records = records.withColumn("tombstoned", F.col("tombstoned") | F.coalesce("_gone", F.lit(False))).drop("_gone")
        events = gone.select("record_id", F.lit(sync_id).cast("long").alias("sync_id"), F.lit("tombstoned").alias("event"))
        events.write.mode("overwrite").parquet(f"{self.root}/events/version={version}")
        dead = self.spark.read.schema(catalog.EVENTS).parquet(f"{self.root}/events/version={version}").count()
        records.write.mode("overwrite").parquet(f"{self.root}/records/{version}")
        self.spark.range(version, version + 1).select(F.col("id").alias("version")).write.mode("append").parquet(f"{self.root}/pointer")
        self._told(sync_id, source_id, "complete", cursor, n)
        return {"sync_id": sync_id, "pages": n, "tombstoned": dead}


def sync_stream(pages: DataFrame, tables: CatalogTables, source_id: str, sync_id: int, checkpoint: str):
    """A query that merges a stream of source rows; tombstones follow in one batch step after the last page (end_snapshot)."""

    def merge(batch: DataFrame, number: int) -> None:
        tables.apply(catalog.snapshot(batch, source_id), sync_id, number)

    return pages.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def end_snapshot(tables: CatalogTables, seen_keys: DataFrame, sync_id: int) -> DataFrame:
    """(record_id, event) of live records that the whole snapshot did not hold."""
    gone = tables.records().where("not tombstoned").join(seen_keys.select("source_key").distinct(), "source_key", "left_anti")
    return gone.select("record_id", F.lit(sync_id).cast("long").alias("sync_id"), F.lit("tombstoned").alias("event"))


def windowed_counts(events: DataFrame, ts: str, key: str, size: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts per key and window; rows later than the watermark are dropped when streaming."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return events.withWatermark(ts, late).groupBy(w, key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("began"), F.col("window.end").alias("ended"), key, "n")


def sessions(events: DataFrame, ts: str, key: str, gap: str, late: str = "10 minutes") -> DataFrame:
    s = F.session_window(ts, gap)
    return events.withWatermark(ts, late).groupBy(s, key).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("began"), F.col("session_window.end").alias("ended"), key, "n")


def once(events: DataFrame, ts: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """Rows whose keys were not seen within the watermark."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def run_to_end(df: DataFrame, name: str, mode: str, checkpoint: str) -> DataFrame:
    """Runs a streaming DataFrame over what is there into a memory table (for tests and small results)."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def latest_by(key: list[str], order: str, columns: list[str]) -> Callable[[DataFrame], DataFrame]:
    """A latest-state fold by key that streams in update or complete mode."""

    def fold(df: DataFrame) -> DataFrame:
        latest: list[Column] = [F.max_by(c, order).alias(c) for c in columns]
        return df.groupBy(*key).agg(F.max(order).alias(order), *latest)

    return fold
