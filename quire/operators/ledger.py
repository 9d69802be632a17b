"""The run ledger: an append-only log of runs, its latest-state view, leases, freshness decisions and cost sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.exprs import sum_or_unknown_where


def latest_state(runs: DataFrame) -> DataFrame:
    """The latest successful run of each document, station and page; a null page and an empty one are the same."""
    key = Window.partitionBy("doc_id", "station", F.coalesce("page_id", F.lit(""))).orderBy(F.desc("run_id"))
    return runs.where("status = 'done'").withColumn("_n", F.row_number().over(key)).where("_n = 1").drop("_n")


def state(runs: DataFrame, doc_id: str) -> DataFrame:
    """A document's latest state, by station and page, null pages first."""
    return latest_state(runs.where(F.col("doc_id") == doc_id)).orderBy("station", F.asc_nulls_first("page_id"))


def items(events: DataFrame) -> DataFrame:
    """Work orders folded from their events: the last recipe and status, the first time."""
    return events.groupBy("doc_id").agg(F.max_by("recipe", "event_id").alias("recipe"), F.max_by("status", "event_id").alias("status"), F.min("created_at").alias("created_at"))


def parkable(orders: DataFrame, work_runs: DataFrame) -> DataFrame:
    """Orders without a running work run."""
    return orders.join(work_runs.where("status = 'running'"), "doc_id", "left_anti")


def abandoned(work_runs: DataFrame, now: Column, lease_seconds: int = 600) -> DataFrame:
    """Running work runs whose heartbeat is older than the lease."""
    return work_runs.where((F.col("status") == "running") & (F.col("heartbeat_at") < now - F.make_dt_interval(secs=F.lit(lease_seconds))))


def after_abandonment(work_runs: DataFrame, stage_runs: DataFrame, now: Column, lease_seconds: int = 600) -> tuple[DataFrame, DataFrame]:
    """Both logs with stale leases ended: the work runs abandoned, their running cells failed."""
    stale = abandoned(work_runs, now, lease_seconds).select("work_run_id", "doc_id")
    mark = stale.select("work_run_id", F.lit(True).alias("_stale"))
    runs = work_runs.join(mark, "work_run_id", "left").withColumn("status", F.when(F.col("_stale"), F.lit("abandoned")).otherwise(F.col("status"))).drop("_stale")
    docs = stale.select("doc_id", F.lit(True).alias("_stale")).distinct()
    cells = stage_runs.join(docs, "doc_id", "left")
    cells = cells.withColumn("status", F.when(F.col("_stale") & (F.col("status") == "running"), F.lit("failed:abandoned")).otherwise(F.col("status"))).drop("_stale")
    return runs, cells


def claim_problems(work_runs: DataFrame, now: Column, lease_seconds: int = 600) -> DataFrame:
    """Documents that cannot be claimed: a fresh lease holds them, or more than one run is open."""
    open_ = work_runs.where("status = 'running'")
    fresh = open_.where(F.col("heartbeat_at") >= now - F.make_dt_interval(secs=F.lit(lease_seconds)))
    twice = open_.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    return fresh.select("doc_id", F.lit("leased").alias("problem")).unionByName(twice.select("doc_id", F.lit("several runs").alias("problem"))).distinct()


def freshness(cells: DataFrame) -> DataFrame:
    """The decision for each cell, in order:

    inputs missing: failed. Output current with the same configuration: fresh; with another configuration: outdated, and not rerun.
    A stamp that matches although the log lacks the run: recovered. Anything else runs.

    cells has has_inputs, output_exists and the fingerprints input_now, input_then, config_now, config_then, output_now,
    output_then (then: by the last successful run, null without one) and stamp_input, stamp_config (by the output's own stamp).
    """
    same = lambda a, b: F.coalesce(F.col(a) == F.col(b), F.lit(False))
    current = F.col("output_exists") & same("input_now", "input_then") & same("output_now", "output_then")
    stamped = F.col("output_exists") & F.col("input_then").isNull() & same("input_now", "stamp_input") & same("config_now", "stamp_config")
    action = (
        F.when(~F.coalesce("has_inputs", F.lit(False)), "failed")
        .when(current & same("config_now", "config_then"), "fresh")
        .when(current, "outdated")
        .when(stamped, "recovered")
        .otherwise("run")
    )
    return cells.withColumn("action", action)


def run_report(cells: DataFrame) -> DataFrame:
    """Counts by action and the cost of what ran, unknown if any of it is unknown."""
    spent = F.col("action").isin("ran", "failed", "recovered")
    return cells.groupBy("doc_id").agg(*[F.count_if(F.col("action") == a).alias(a) for a in ("ran", "fresh", "outdated", "recovered", "failed")], sum_or_unknown_where(F.col("cost_usd"), spent).alias("cost_usd"))


def colophon(stamps: DataFrame) -> DataFrame:
    """By station in order of first appearance: runs, token sums, cost, known cost, whether the cost is complete, configurations.

    A stamp without a model costs nothing. stamps has seq, station, model, config, tokens_in, tokens_out, cost_usd. Stamps are summed by
    station and configuration first, so what meets in one row are the few configurations of a station.
    """
    cost = F.when(F.col("model").isNull(), F.lit(0.0)).otherwise(F.col("cost_usd"))
    rows = stamps.withColumn("_cost", cost)
    each = rows.groupBy("station", "config").agg(
        F.min("seq").alias("first"), F.count("*").alias("n"), F.count("_cost").alias("known"), F.sum("_cost").alias("cost"),
        *[f(c).alias(f"{f.__name__}_{c}") for c in ("tokens_in", "tokens_out") for f in (F.sum, F.count)],
    )
    whole = lambda total, known: F.when(F.sum(known) == F.sum("n"), F.sum(total))
    configs = F.filter(F.transform(F.sort_array(F.collect_list(F.struct("first", "config"))), lambda x: x["config"]), lambda c: c.isNotNull())
    return each.groupBy("station").agg(
        F.min("first").alias("first_seq"), F.sum("n").alias("runs"), whole("sum_tokens_in", "count_tokens_in").alias("tokens_in"), whole("sum_tokens_out", "count_tokens_out").alias("tokens_out"),
        F.bround(whole("cost", "known"), 4).alias("cost_usd"), F.bround(F.coalesce(F.sum("cost"), F.lit(0.0)), 4).alias("cost_usd_known"),
        (F.sum("known") == F.sum("n")).alias("cost_complete"), configs.alias("configurations"),
    )


def config_drift(orders: DataFrame, slots: DataFrame, observed: DataFrame) -> DataFrame:
    """For each document and station of its recipe: how many observed runs have the expected configuration.

    Joined by recipe; an order whose recipe has no slots is unknown-recipe, and no observed run counts as outdated.
    """
    wanted = orders.join(slots, "recipe", "left")
    seen = wanted.join(observed.select("doc_id", "station", F.col("config_fingerprint").alias("_seen")), ["doc_id", "station"], "left")
    out = seen.groupBy("doc_id", "recipe", "station").agg(F.count_if(F.col("_seen") == F.col("expected")).alias("current"), F.count("_seen").alias("total"))
    status = F.when(F.col("station").isNull(), "unknown-recipe").when((F.col("total") > 0) & (F.col("current") == F.col("total")), "current").otherwise("outdated")
    return out.withColumn("status", status)


def heartbeat_sessions(events: DataFrame, key: str, ts: str, gap_seconds: int) -> DataFrame:
    """Sessions of a key: a gap longer than the given one begins another."""
    order = Window.partitionBy(key).orderBy(ts)
    new = F.coalesce((F.unix_micros(F.col(ts).cast("timestamp")) - F.lag(F.unix_micros(F.col(ts).cast("timestamp"))).over(order) > gap_seconds * 1_000_000).cast("int"), F.lit(1))
    marked = events.withColumn("_new", new)
    numbered = marked.withColumn("session", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(key, "session").agg(F.min(ts).alias("began"), F.max(ts).alias("ended"), F.count("*").alias("n_events"))


def usage_by_turn(turns: DataFrame) -> DataFrame:
    """Each turn's own tokens and cost from running totals of its session."""
    order = Window.partitionBy("session_id").orderBy("turn")
    own = lambda c: (F.col(c) - F.lag(c, 1, 0).over(order)).alias(f"{c}_of_turn")
    return turns.select("*", own("tokens"), own("cost_usd"))


def cost_prefix(orders: DataFrame, order: list, cost: str, most: float) -> DataFrame:
    """The first rows in order whose cost before them is known and below a ceiling.

    Ranges of the order are summed by themselves; one row a range meets in a running sum, which then is where each range begins.
    """
    ranged = orders.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).persist()
    unknown = F.col(cost).isNull().cast("long")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(F.sum(cost).alias("_c"), F.sum(unknown).alias("_u"))
    totals = totals.select("_range", F.coalesce(F.sum("_c").over(before), F.lit(0.0)).alias("_base"), F.coalesce(F.sum("_u").over(before), F.lit(0)).alias("_base_u"))
    own = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.join(totals.where((F.col("_base") < most) & (F.col("_base_u") == 0)), "_range")
    rows = rows.withColumn("_before", F.col("_base") + F.coalesce(F.sum(cost).over(own), F.lit(0.0))).withColumn("_unknown", F.coalesce(F.sum(unknown).over(own), F.lit(0)))
    return rows.where((F.col("_before") < most) & (F.col("_unknown") == 0)).select(*orders.columns)


def health(checks: DataFrame) -> DataFrame:
    """The overall status of checks (name, status): fail over warn over pass."""
    rank = F.when(F.col("status") == "fail", 2).when(F.col("status") == "warn", 1).otherwise(0)
    worst = F.max(rank)
    return checks.agg(F.when(worst == 2, "fail").when(worst == 1, "warn").otherwise("pass").alias("overall"), F.count("*").alias("checks"))


def product_status(items_: DataFrame, books: DataFrame) -> DataFrame:
    """Readiness of each completed order: n/a, missing-book, invalid-book, missing-or-stale-epub or ready."""
    j = items_.join(books, "doc_id", "left")
    stale = F.coalesce(F.col("epub_source") != F.col("book_fingerprint"), F.lit(True))
    product = F.when(F.col("status") != "complete", "n/a").when(F.col("book_fingerprint").isNull(), "missing-book").when(~F.col("book_valid"), "invalid-book").when(stale, "missing-or-stale-epub").otherwise("ready")
    return j.select("doc_id", "status", product.alias("product"))
