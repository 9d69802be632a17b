"""Evidence about readings: two-reader consensus, per-line sensors, event-log usage, verdicts of a tuning run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.exprs import lines, squash, sum_or_unknown
from quire.functions.text import normalize_counted

MATCH_CONFIDENCE, DOUBT_CONFIDENCE = 0.3, 0.05


def consensus(readings: DataFrame) -> DataFrame:
    """Per page: agreement where all readers' normalized texts are equal, failed where one failed, else adjudicate.

    readings has doc_id, page_id, role, model, text, error. Candidates come without their roles, ordered by text and model, so that who
    wrote what cannot be told.
    """
    norm = squash(F.coalesce("text", F.lit("")))
    candidates = F.transform(F.sort_array(F.collect_list(F.struct("text", "model"))), lambda x: x["text"])
    out = readings.groupBy("doc_id", "page_id").agg(F.count_if(F.col("error").isNotNull()).alias("errors"), F.count_distinct(norm).alias("forms"), F.count("*").alias("readers"), candidates.alias("candidates"))
    status = F.when(F.col("errors") > 0, "failed").when(F.col("readers") == 1, "not_needed").when(F.col("forms") == 1, "agreement").otherwise("adjudicate")
    return out.select("doc_id", "page_id", status.alias("status"), "candidates")


def with_fallback(pages: DataFrame, cases: DataFrame, key: Column, fallback: Column, value: str) -> DataFrame:
    """pages with the value of their own case, else of the fallback case. An empty list is a verdict, null is none."""
    own = cases.select(F.col("case_id").alias("_own"), F.col(value).alias("_v1"))
    bare = cases.select(F.col("case_id").alias("_bare"), F.col(value).alias("_v2"))
    rows = pages.withColumns({"_key": key, "_fallback": fallback})
    rows = rows.join(own, F.col("_key") == F.col("_own"), "left").join(bare, F.col("_fallback") == F.col("_bare"), "left")
    return rows.withColumn(value, F.coalesce("_v1", "_v2")).drop("_own", "_bare", "_v1", "_v2", "_key", "_fallback")


def line_sensors(pages: DataFrame) -> DataFrame:
    """One row a line: characters counted, boxes found, whether they differ, and classifier disputes.

    pages has doc_id, page_id, text, box_counts array<int> (by line; null without a detector) and labels
    array<array<struct<label:string,confidence:double>>> (by line and character).
    """
    rows = pages.select("doc_id", "page_id", "box_counts", "labels", F.posexplode(lines(F.col("text"))).alias("line", "raw")).withColumn("counted", normalize_counted(F.col("raw")))
    boxes = F.get("box_counts", F.col("line"))
    chars = F.filter(F.split("counted", ""), lambda c: c != "")
    marks = F.get("labels", F.col("line"))

    def disputed(c: Column, i: Column) -> Column:
        m = F.get(marks, i)
        return F.coalesce(((m["confidence"] >= MATCH_CONFIDENCE) & (m["label"] != c)) | (m["confidence"] < DOUBT_CONFIDENCE), F.lit(False)).cast("int")

    disputes = F.aggregate(F.transform(chars, disputed), F.lit(0), lambda a, x: a + x)
    return rows.select("doc_id", "page_id", "line", F.length("counted").alias("characters"), boxes.alias("boxes"), F.coalesce(boxes != F.length("counted"), F.lit(False)).alias("count_mismatch"), F.when(F.col("labels").isNull(), 0).otherwise(disputes).alias("disputes"))


def page_flags(sensors: DataFrame) -> DataFrame:
    return sensors.groupBy("doc_id", "page_id").agg(F.count_if("count_mismatch").alias("count_mismatches"), F.sum("disputes").alias("disputes"))


def changed_lines(a: Column, b: Column) -> Column:
    """Lines that differ, up to the shorter text."""
    x, y = lines(a), lines(b)
    n = F.least(F.size(x), F.size(y))
    return F.when(n > 0, F.size(F.filter(F.sequence(F.lit(1), n), lambda i: F.element_at(x, i) != F.element_at(y, i)))).otherwise(0)


def session_usage(events: DataFrame) -> DataFrame:
    """Per session log (session_id, line): tokens, cost, assistant turns and tool calls; lines that are no JSON are passed over.

    Token counts go by either of two names. The cost is known only if every usage has one that is finite and not negative, and there
    is some usage.
    """
    j = F.col("line")
    get = lambda *paths: F.coalesce(*[F.get_json_object(j, p) for p in paths])
    usage = get("$.message.usage", "$.usage")
    tokens = F.coalesce(get("$.message.usage.input", "$.usage.input_tokens", "$.usage.input").cast("long"), F.lit(0)) + F.coalesce(get("$.message.usage.output", "$.usage.output_tokens", "$.usage.output").cast("long"), F.lit(0))
    cost = get("$.message.usage.cost.total", "$.usage.cost_usd", "$.usage.cost").cast("double")
    good = F.when(~F.isnan(cost) & (cost >= 0) & (cost < float("inf")), cost)
    rows = events.where(F.try_parse_json(j).isNotNull()).select("session_id", usage.isNotNull().alias("has"), tokens.alias("t"), good.alias("c"), (get("$.message.role", "$.role") == "assistant").alias("turn"), get("$.type").alias("type"))
    used = rows.where("has").groupBy("session_id").agg(F.sum("t").alias("tokens"), sum_or_unknown(F.col("c")).alias("cost_usd"))
    other = rows.groupBy("session_id").agg(F.count_if("turn").alias("turns"), F.count_if(F.col("type").isin("tool_call", "tool_execution_start")).alias("tool_calls"))
    return other.join(used, "session_id", "left").select("session_id", F.coalesce("tokens", F.lit(0)).alias("tokens"), "cost_usd", "turns", "tool_calls")


def last_message(events: DataFrame) -> DataFrame:
    """The last finished assistant message of each session: text of its JSON, and prompt tokens with cached ones."""
    j = F.col("line")
    ok = (F.get_json_object(j, "$.type") == "message_end") & (F.get_json_object(j, "$.message.role") == "assistant")
    tokens = sum((F.coalesce(F.get_json_object(j, f"$.message.usage.{k}").cast("long"), F.lit(0)) for k in ("input", "cacheRead", "cacheWrite")), F.lit(0))
    return events.where(ok).groupBy("session_id").agg(F.max_by(F.get_json_object(j, "$.message"), "line_number").alias("message"), F.max_by(tokens, "line_number").alias("prompt_tokens"))


def tuning(pages: DataFrame, regions: DataFrame, references: DataFrame) -> DataFrame:
    """Per page: regions by kind, lines, and whether the route fits the length of a reference reading."""
    counts = regions.groupBy("doc_id", "page_id").agg(F.count_if(F.col("kind") == "text").alias("text_regions"), F.count_if(F.col("kind") == "figure").alias("figures"), F.sum("est_lines").alias("lines"))
    j = pages.join(counts, ["doc_id", "page_id"], "left").join(references.select("page_id", F.col("length").alias("_length")), "page_id", "left")
    verdict = F.when(F.col("_length").isNull(), "no reference").when((F.col("_length") > 800) & (F.col("route") == "blank"), "missed text").when((F.col("_length") < 120) & (F.col("route") != "blank"), "perhaps blank").otherwise("ok")
    return j.withColumn("verdict", verdict).drop("_length")


def previous_tail(pages: DataFrame, seam_lines: str = "seam_lines") -> DataFrame:
    """Each page's seam evidence: as many last lines of the page before as the seam repeats."""
    w = Window.partitionBy("doc_id").orderBy("order")
    rows = pages.withColumn("_lines", F.filter(lines(F.lag("text").over(w)), lambda x: F.trim(x) != ""))
    n = F.least(F.col(seam_lines), F.size("_lines"))
    return rows.withColumn("previous_tail", F.when(n > 0, F.slice("_lines", F.size("_lines") - n + 1, n))).drop("_lines")
