"""Runs recipes: orders, claims with heartbeats, batches with barriers, freshness, cells in Spark tasks, stamps, and the run log.

Everything lies below one root that driver and executors share: artifacts as JSON files, and three append-only logs as Parquet folders (order
events, work events, cell runs). What a log says now is a fold over it (operators.ledger). One run drives any number of documents: a
step is one job over all their cells, after which failed pages, or documents, drop out of the steps that follow.
"""

from __future__ import annotations

import hashlib
import json
import os
import socket
import threading
import time
import uuid
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import ledger
from quire.plans import line
from quire.plans.gateway import Cell, InlineExecutor
from quire.sources.sinks import put_json

ORDERS = "event_id long, doc_id string, event string, recipe string, previous_recipe string, status string, created_at timestamp"
WORK = "event_id long, work_run_id string, doc_id string, owner string, status string, heartbeat_at timestamp, error string"
CELLS = (
    "run_id long, doc_id string, page_id string, station string, status string, action string, error string, station_fingerprint string, config_fingerprint string, "
    "input_fingerprint string, output_fingerprint string, cost_usd double, tokens_in long, tokens_out long"
)
LEASE_SECONDS, HEARTBEAT_SECONDS = 600, 15.0


class CellError(Exception):
    """A cell's failure with a kind and what it cost."""

    def __init__(self, message: str, kind: str = "error", cost_usd: float | None = None):
        super().__init__(message)
        self.kind, self.cost_usd = kind, cost_usd


def _read_json(uri: str) -> dict[str, Any] | None:
    """A JSON object's file; None where there is none."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    if store.get_file_info(path).type != fs.FileType.File:
        return None
    with store.open_input_stream(path, compression=None) as f:
        return json.loads(f.read())


def artifact_uri(root: str, doc_id: str, kind: str, page_id: str | None = None) -> str:
    return f"{root}/library/{doc_id}/{kind}" + (f"/{page_id}" if page_id else "") + ".json"


@dataclass(frozen=True)
class _Step:
    """What a task needs to know of a step."""

    root: str
    station: line.Station
    grains: Mapping[str, str]
    model: str | None
    prompt: str | None
    params: Mapping[str, Any]
    options: Mapping[str, Any]
    code: str
    config: str

    def inputs(self, doc_id: str, page_id: str | None, pages: list[dict]) -> list[tuple[str, str | None, str, bool]]:
        """(kind, page, uri, needed) of a cell's inputs; a manuscript's cell takes a page kind of all pages."""
        out = []
        for kinds, needed in ((self.station.consumes, True), (self.station.optional, False)):
            for kind in kinds:
                whole = self.grains[kind] != "page"
                ids = [None] if whole else [page_id] if self.station.grain == "page" else [p["page_id"] for p in pages]
                out += [(kind, p, artifact_uri(self.root, doc_id, kind, p), needed) for p in ids]
        return out

    def inspect(self, doc_id: str, page_id: str | None, pages: list[dict], then: dict[str, Any], refresh: bool) -> dict[str, Any]:
        """The columns that ledger.freshness() decides on."""
        found = [(k, p, _read_json(uri), needed) for k, p, uri, needed in self.inputs(doc_id, page_id, pages)]
        missing = [f"{k}/{p}" if p else k for k, p, x, needed in found if x is None and needed]
        prints = [line.artifact_fingerprint(x) for *_, x, _ in found if x is not None]
        out = _read_json(artifact_uri(self.root, doc_id, self.station.produces, page_id))
        stamp = (out or {}).get("provenance") or {}
        now = None if out is None else line.artifact_fingerprint(out)
        known = {k: then.get(k) for k in ("station_fingerprint", "config_fingerprint", "input_fingerprint")}
        mine = then.get("output_fingerprint") is not None and stamp.get("station") == self.station.name and all(stamp.get(k) == v for k, v in known.items())
        recoverable = stamp.get("station") == self.station.name and stamp.get("station_fingerprint") == self.code and stamp.get("output_fingerprint") == now
        return {
            "has_inputs": not missing, "output_exists": out is not None and not refresh, "input_now": hashlib.sha256("\x1f".join(prints).encode()).hexdigest()[:16],
            "input_then": known["input_fingerprint"] if mine else None, "config_now": self.config, "config_then": known["config_fingerprint"], "output_now": now,
            "output_then": then.get("output_fingerprint") if mine else None, "stamp_input": stamp.get("input_fingerprint") if recoverable else None,
            "stamp_config": stamp.get("config_fingerprint") if recoverable else None, "stamp_cost": stamp.get("cost_usd") if recoverable else None, "error": "missing inputs: " + ", ".join(missing) if missing else None,
        }

    def execute(self, doc_id: str, page_id: str | None, pages: list[dict], input_print: str) -> dict[str, Any]:
        """Runs a cell and writes its output with a stamp, in one step; a repeated task writes the same file again."""
        given: dict[str, Any] = {}
        for kind, p, uri, _ in self.inputs(doc_id, page_id, pages):
            value = _read_json(uri)
            if value is None:
                continue
            if self.station.grain != "page" and self.grains[kind] == "page":
                given.setdefault(kind, {})[p] = value
            else:
                given[kind] = value
        page = next((p for p in pages if p["page_id"] == page_id), None)
        job = {"doc_id": doc_id, "page_id": page_id, "page": page, "pages": pages, "inputs": given, "model": self.model, "prompt": self.prompt, "params": dict(self.params), "options": dict(self.options)}
        raised: list[Exception] = []

        def run(cell: Cell) -> dict[str, Any]:
            try:
                return self.station.run(job)
            except Exception as e:
                raised.append(e)
                raise

        sha = None if self.prompt is None else hashlib.sha256(self.prompt.encode()).hexdigest()
        done = InlineExecutor(run).execute(Cell(doc_id, self.station.name, page_id, self.prompt, sha, tuple(sorted(self.params.items()))))
        if not done["ok"]:
            e = raised[0] if raised else None
            return {"status": f"failed:{getattr(e, 'kind', type(e).__name__.lower())}", "error": str(e) or done["error"], "cost_usd": getattr(e, "cost_usd", None)}
        payload = {"doc_id": doc_id} | ({"page_id": page_id} if page_id else {}) | {k: v for k, v in done["value"].items() if k != "usage"}
        usage = done["value"].get("usage") or {}
        spent = {"tokens_in": usage.get("tokens_in"), "tokens_out": usage.get("tokens_out"), "cost_usd": usage.get("cost_usd", 0.0 if not self.station.model else None)}
        print_ = line.artifact_fingerprint(payload)
        stamp = {"station": self.station.name, "station_fingerprint": self.code, "config_fingerprint": self.config, "input_fingerprint": input_print, "output_fingerprint": print_} | {k: v for k, v in spent.items() if v is not None}
        put_json(artifact_uri(self.root, doc_id, self.station.produces, page_id), payload | {"provenance": stamp})
        return {"status": "done", "output_fingerprint": print_} | spent


_INSPECTED = (
    "doc_id string, page_id string, has_inputs boolean, output_exists boolean, input_now string, input_then string, config_now string, config_then string, output_now string, "
    "output_then string, stamp_input string, stamp_config string, stamp_cost double, error string, pages string"
)


_ARROW = {"string": pa.string(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}


def _map_rows(df: DataFrame, of: Callable[[list[dict]], list[dict]], ddl: str) -> DataFrame:
    """of over batches of rows, a cell at a time; ddl holds the names and types of what it returns."""
    schema = pa.schema([(n, _ARROW[t]) for n, t in (x.split() for x in ddl.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist(of([row]), schema=schema)

    return df.mapInArrow(run, ddl)


@dataclass
class Workshop:
    """Orders and runs below one root; recipes by name, stations by a registry, prompts by name."""

    spark: SparkSession
    root: str
    registry: line.Registry
    recipes: Mapping[str, line.Recipe]
    prompts: Mapping[str, str] = field(default_factory=dict)
    #: Cells that run at once in a step of a station with a model, and in any other.
    model_workers: int = 3
    workers: int = 64

    # Logs

    def _log(self, name: str, ddl: str) -> DataFrame:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(self._uri(f"log/{name}"))
        there = store.get_file_info(path).type == fs.FileType.Directory
        return self.spark.read.schema(ddl).parquet(self._uri(f"log/{name}")) if there else self.spark.createDataFrame([], ddl)

    def _append(self, name: str, ddl: str, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(self._uri(f"log/{name}"))

    def _uri(self, path: str) -> str:
        return (self.root if "://" in self.root else f"file://{os.path.abspath(self.root)}").rstrip("/") + "/" + path

    def orders(self) -> DataFrame:
        """(doc_id, recipe, status, created_at) of all orders."""
        return ledger.items(self._log("orders", ORDERS))

    def history(self, doc_id: str) -> DataFrame:
        """The order's events, oldest first: adoption, then every switch."""
        return self._log("orders", ORDERS).where((F.col("doc_id") == doc_id) & F.col("event").isin("adopted", "switched_recipe")).orderBy("event_id")

    def work(self) -> DataFrame:
        """The latest state of each work run."""
        last = lambda c: F.max_by(c, "event_id").alias(c)
        return self._log("work", WORK).groupBy("work_run_id").agg(*map(last, ("doc_id", "owner", "status", "heartbeat_at", "error")))

    def cells(self) -> DataFrame:
        return self._log("cells", CELLS)

    def status(self) -> DataFrame:
        """Each order with its done cells, failed attempts, known cost, and whether a run is open."""
        runs = self.cells().groupBy("doc_id").agg(F.count_if(F.col("status") == "done").alias("done"), F.count_if(F.col("status") != "done").alias("failed"), F.sum("cost_usd").alias("cost_usd"))
        open_ = self.work().where("status = 'running'").select("doc_id", F.lit(True).alias("running")).distinct()
        return self.orders().join(runs, "doc_id", "left").join(open_, "doc_id", "left").fillna({"done": 0, "failed": 0, "running": False}).orderBy("created_at", "doc_id")

    # Orders

    def _order(self, doc_id: str):
        row = self.orders().where(F.col("doc_id") == doc_id).first()
        if row is None:
            raise KeyError(f"no order for {doc_id}; adopt it first")
        return row

    def _told(self, doc_id: str, event: str, recipe: str | None, before: str | None, status: str) -> None:
        self._append("orders", ORDERS, [(time.time_ns(), doc_id, event, recipe, before, status, pd.Timestamp.now("UTC").to_pydatetime())])

    def _not_running(self, doc_id: str) -> None:
        held = self.work().where((F.col("doc_id") == doc_id) & (F.col("status") == "running")).first()
        if held is not None:
            raise RuntimeError(f"{doc_id} is running under {held.owner}")

    def adopt(self, doc_id: str, recipe: str) -> None:
        if not self.orders().where(F.col("doc_id") == doc_id).isEmpty():
            raise ValueError(f"{doc_id} has an order")
        if recipe not in self.recipes:
            raise KeyError(f"unknown recipe {recipe}")
        self._told(doc_id, "adopted", recipe, None, "active")

    def switch(self, doc_id: str, recipe: str) -> None:
        before = self._order(doc_id)
        self._not_running(doc_id)
        self._told(doc_id, "switched_recipe", recipe, before.recipe, before.status)

    def park(self, doc_id: str) -> None:
        row = self._order(doc_id)
        self._not_running(doc_id)
        self._told(doc_id, "status", row.recipe, None, "parked")

    # Claims

    def _work_event(self, runs: Mapping[str, str], owner: str, status: str, error: str | None = None) -> None:
        now, at = pd.Timestamp.now("UTC").to_pydatetime(), time.time_ns()
        self._append("work", WORK, [(at, run, doc, owner, status, now, error) for doc, run in runs.items()])

    def claim(self, doc_ids: list[str], owner: str) -> dict[str, str]:
        """Work runs by document. Expired leases are closed first; a claim that another one precedes is taken back, and RuntimeError raised."""
        now = F.current_timestamp()
        mine = F.col("doc_id").isin(doc_ids)
        stale = {r.doc_id: r.work_run_id for r in ledger.abandoned(self.work().where(mine), now, LEASE_SECONDS).collect()}
        if stale:
            self._work_event(stale, owner, "abandoned", "the heartbeat expired")
        runs = {d: uuid.uuid4().hex for d in doc_ids}
        self._work_event(runs, owner, "running")
        first = self._log("work", WORK).groupBy("work_run_id").agg(F.min("event_id").alias("began"))
        held = self.work().where(mine & (F.col("status") == "running")).join(first, "work_run_id")
        before = held.groupBy("doc_id").agg(F.min_by(F.struct("work_run_id", "owner"), F.struct("began", "work_run_id")).alias("x")).collect()
        lost = [(r.doc_id, r.x.owner) for r in before if r.x.work_run_id != runs[r.doc_id]]
        if lost:
            self._work_event(runs, owner, "failed", "another run holds the document")
            raise RuntimeError("; ".join(f"{d} is running under {o}" for d, o in lost))
        return runs

    def _beat(self, runs: Mapping[str, str], owner: str, stop: threading.Event, errors: list[Exception]) -> None:
        while not stop.wait(HEARTBEAT_SECONDS):
            try:
                self._work_event(runs, owner, "running")
            except Exception as e:
                errors.append(e)
                return

    # Runs

    def _pages(self, doc_ids: list[str], only: tuple[str, ...]) -> DataFrame:
        """(doc_id, pages): each document's page list in order, as JSON; raises if one lacks it or a selected page."""
        root = self._uri("").rstrip("/")

        def run(rows: list[dict]) -> list[dict]:
            found = [(r["doc_id"], _read_json(artifact_uri(root, r["doc_id"], "page_list"))) for r in rows]
            return [{"doc_id": d, "pages": None if x is None else json.dumps(sorted(x["pages"], key=lambda p: p.get("order") or 0))} for d, x in found]

        out = _map_rows(self.spark.createDataFrame([(d,) for d in doc_ids], "doc_id string"), run, "doc_id string, pages string").persist()
        ids = F.from_json("pages", "array<struct<page_id string>>")["page_id"]
        bad = out.where(F.col("pages").isNull() | (F.size(F.array_except(F.array(*map(F.lit, only)) if only else F.array().cast("array<string>"), ids)) > 0)).first()
        if bad is not None:
            raise ValueError(f"{bad.doc_id} has no page list" if bad.pages is None else f"{bad.doc_id} lacks a selected page")
        return out

    def _step(self, step: line.Step) -> _Step:
        station = self.registry.get(step.station, step.variant)
        text = None if step.prompt is None else self.prompts[step.prompt]
        params = line.config_fingerprints(step, None)[1]
        config = "\x1f".join((station.code, step.model or "", "" if text is None else hashlib.sha256(text.encode()).hexdigest(), params))
        return _Step(self._uri("").rstrip("/"), station, dict(self.registry.kinds), step.model, text, dict(step.params), dict(step.options), station.code, hashlib.sha256(config.encode()).hexdigest()[:16])

    def _cells_of(self, step: _Step, docs: DataFrame, only: tuple[str, ...]) -> DataFrame:
        rows = docs.select("doc_id", "pages")
        if step.station.grain != "page":
            return rows.select("doc_id", F.lit(None).cast("string").alias("page_id"), "pages")
        each = rows.select("doc_id", F.explode(F.from_json("pages", "array<struct<page_id string>>")["page_id"]).alias("page_id"), "pages")
        return each.where(F.col("page_id").isin(*only)) if only else each

    def _run_step(self, step: _Step, cells: DataFrame, refresh: bool) -> DataFrame:
        """Decides and runs a step's cells and appends what was begun to the log. Returns all of them in the log's columns."""
        run_id, name = time.time_ns(), step.station.name
        then = ledger.latest_state(self.cells().where(F.col("station") == name))
        keys = ["station_fingerprint", "config_fingerprint", "input_fingerprint", "output_fingerprint"]
        then = then.select("doc_id", F.coalesce("page_id", F.lit("")).alias("_page"), *keys)
        cells = cells.withColumn("_page", F.coalesce("page_id", F.lit(""))).join(then, ["doc_id", "_page"], "left").drop("_page")
        cells = cells.repartition(self.model_workers if step.station.model else self.workers, "doc_id", "page_id")

        def inspect(rows: list[dict]) -> list[dict]:
            same = lambda r: {k: r[k] for k in ("doc_id", "page_id", "pages")}
            return [same(r) | step.inspect(r["doc_id"], r["page_id"], json.loads(r["pages"]), r, refresh) for r in rows]

        def execute(rows: list[dict]) -> list[dict]:
            out = []
            for r in rows:
                row = {"run_id": run_id, "station": name, "station_fingerprint": step.code, "config_fingerprint": step.config, "input_fingerprint": r["input_now"]} | {k: r[k] for k in ("doc_id", "page_id", "action", "error")}
                if r["action"] == "run":
                    row |= step.execute(r["doc_id"], r["page_id"], json.loads(r["pages"]), r["input_now"])
                    row["action"] = "ran" if row["status"] == "done" else "failed"
                elif r["action"] == "recovered":
                    row |= {"status": "done", "output_fingerprint": r["output_now"], "cost_usd": r["stamp_cost"]}
                else:
                    row |= {"status": "failed:inputs" if r["action"] == "failed" else "fresh", "cost_usd": 0.0}
                out.append(row)
            return out

        decided = ledger.freshness(_map_rows(cells, inspect, _INSPECTED))
        _map_rows(decided, execute, CELLS).write.mode("append").partitionBy("run_id").parquet(self._uri("log/steps"))
        rows = self.spark.read.schema(CELLS).parquet(self._uri("log/steps")).where(F.col("run_id") == run_id)
        rows.where("action in ('ran', 'recovered') or (action = 'failed' and status <> 'failed:inputs')").write.mode("append").parquet(self._uri("log/cells"))
        return rows

    def run(self, doc_ids: list[str], pages: tuple[str, ...] = (), through: str | None = None, refresh: frozenset[str] = frozenset(), owner: str | None = None) -> DataFrame:
        """Runs orders of one recipe; returns what became of each cell: doc_id, station, page_id, action, error, cost_usd.

        Fresh cells are not run again, and cells whose configuration alone has changed are told but left; so a run that was stopped is
        resumed by the next one.
        """
        names = {self._order(d).recipe for d in doc_ids}
        if len(names) != 1:
            raise ValueError("the orders of a run have one recipe")
        recipe = self.recipes[names.pop()]
        steps, partial = line.slice_steps(recipe, self.registry, through, bool(pages))
        docs = self._pages(doc_ids, pages)
        owner = owner or f"{socket.gethostname()}:{os.getpid()}:{uuid.uuid4().hex[:12]}"
        runs = self.claim(doc_ids, owner)
        stop, errors = threading.Event(), []
        beat = threading.Thread(target=self._beat, args=(runs, owner, stop, errors), daemon=True)
        beat.start()
        report, status, failed = None, "failed", None
        try:
            for d in doc_ids:
                self._told(d, "status", recipe.name, None, "active")
            live = docs
            for batch in line.batches(steps, self.registry):
                lost = None
                for s in batch:
                    if errors:
                        raise RuntimeError("the heartbeat failed") from errors[0]
                    step = self._step(s)
                    cells = self._cells_of(step, live, pages)
                    if lost is not None and step.station.grain == "page":
                        cells = cells.join(lost, ["doc_id", "page_id"], "left_anti")
                    rows = self._run_step(step, cells, s.station in refresh)
                    report = rows if report is None else report.unionByName(rows)
                    gone = rows.where("action = 'failed'").select("doc_id", "page_id")
                    lost = gone if lost is None else lost.unionByName(gone)
                live = live.join(lost.select("doc_id").distinct(), "doc_id", "left_anti")
            bad = {r.doc_id for r in report.where("action = 'failed'").select("doc_id").distinct().collect()} if report is not None else set()
            for d in doc_ids:
                self._told(d, "status", recipe.name, None, "failed" if d in bad else "active" if partial or pages else "complete")
            status, failed = ("failed", "one or more cells failed") if bad else ("done", None)
            return report.select("doc_id", "station", "page_id", "action", "error", "cost_usd")
        except BaseException as e:
            failed = str(e)
            for d in doc_ids:
                self._told(d, "status", recipe.name, None, "failed")
            raise
        finally:
            stop.set()
            beat.join()
            self._work_event(runs, owner, status, failed)
            docs.unpersist()

    def drift(self) -> DataFrame:
        """For each order and station of its recipe, how many of its latest cells have today's configuration (ledger.config_drift)."""
        slots = [(r.name, s.station, self._step(s).config) for r in self.recipes.values() for s in r.steps]
        table = self.spark.createDataFrame(slots, "recipe string, station string, expected string")
        return ledger.config_drift(self.orders().select("doc_id", "recipe"), table, ledger.latest_state(self.cells()).select("doc_id", "station", "config_fingerprint"))


def registry_of(kinds: Mapping[str, str], stations: list[line.Station]) -> line.Registry:
    out = line.Registry(kinds)
    for s in stations:
        out.register(s)
    return out

