"""Further operators on the driver's tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions import exprs
from quire.operators import catalog, contracts, publish, readers, sequences, survey
from quire.plans.registry import register, table
from quire.sources import files
from quire.streaming import sync


@register(
    "session_usage",
    """SELECT user_id AS session_id, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT) + 2) AS BIGINT) AS tokens, CASE WHEN bool_and(event_id % 50 <> 7) THEN round(sum(value), 2) END AS cost_usd,
         count(*) FILTER (event_type = 'view') AS turns FROM events GROUP BY user_id""",
)
def session_usage(spark, sf):
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    usage = F.struct(k.alias("input_tokens"), F.lit(2).alias("output_tokens"), F.when(F.col("event_id") % 50 != 7, F.col("value")).alias("cost"))
    line = F.to_json(F.struct(F.when(F.col("event_type") == "view", "assistant").otherwise("user").alias("role"), usage.alias("usage")))
    return readers.session_usage(e.select(F.col("user_id").alias("session_id"), line.alias("line"))).select("session_id", "tokens", F.round("cost_usd", 2).alias("cost_usd"), "turns")


@register("last_message", "SELECT user_id AS session_id, max_by(CAST(json_extract_string(props, '$.k') AS BIGINT), event_id) + 1 AS prompt_tokens FROM events WHERE event_type = 'view' GROUP BY user_id")
def last_message(spark, sf):
    e = table(spark, sf, "events")
    usage = F.struct(F.get_json_object("props", "$.k").cast("int").alias("input"), F.lit(1).alias("cacheRead"))
    message = F.struct(F.lit("assistant").alias("role"), usage.alias("usage"))
    line = F.to_json(F.struct(F.when(F.col("event_type") == "view", "message_end").otherwise("other").alias("type"), message.alias("message")))
    return readers.last_message(e.select(F.col("user_id").alias("session_id"), F.col("event_id").alias("line_number"), line.alias("line"))).select("session_id", "prompt_tokens")


@register(
    "reader_consensus",
    """SELECT l_orderkey AS doc_id, CASE WHEN bool_or(l_quantity = 50) THEN 'failed' WHEN count(*) = 1 THEN 'not_needed' WHEN count(DISTINCT l_returnflag) = 1 THEN 'agreement' ELSE 'adjudicate' END AS status
       FROM lineitem GROUP BY l_orderkey""",
)
def reader_consensus(spark, sf):
    i = table(spark, sf, "lineitem")
    r = i.select(F.col("l_orderkey").alias("doc_id"), F.lit("p").alias("page_id"), F.col("l_linestatus").alias("model"), F.concat(F.col("l_returnflag"), F.when(F.col("l_linenumber") % 2 == 0, " ").otherwise("")).alias("text"), F.when(F.col("l_quantity") == 50, "e").alias("error"))
    return readers.consensus(r).select("doc_id", "status")


@register(
    "sensor_lines",
    r"""SELECT doc_id, CAST(i - 1 AS INTEGER) AS line, CAST(length(regexp_replace(l[i], '[\s]', '', 'g')) AS INTEGER) AS characters, length(regexp_replace(l[i], '[\s]', '', 'g')) <> 40 AS count_mismatch
        FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), unnest(range(1, len(l) + 1)) u(i)""",
)
def sensor_lines(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.lit("p").alias("page_id"), "text", F.array_repeat(F.lit(40), F.size(F.split("text", "\n"))).alias("box_counts"), F.lit(None).cast("array<array<struct<label:string,confidence:double>>>").alias("labels"))
    return readers.line_sensors(d).select("doc_id", "line", "characters", "count_mismatch")


@register(
    "case_fallback",
    """SELECT o_orderkey, coalesce(a.v, b.v) AS v FROM orders LEFT JOIN (SELECT c_custkey || '__' || c_nationkey AS id, 'own' AS v FROM customer) a ON a.id = o_custkey || '__' || (o_orderkey % 25)
       LEFT JOIN (SELECT CAST(c_custkey AS VARCHAR) AS id, 'bare' AS v FROM customer WHERE c_custkey % 2 = 0) b ON b.id = CAST(o_custkey AS VARCHAR)""",
)
def case_fallback(spark, sf):
    c = table(spark, sf, "customer")
    cases = c.select(F.concat_ws("__", "c_custkey", "c_nationkey").alias("case_id"), F.lit("own").alias("v")).unionAll(c.where("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string"), F.lit("bare")))
    o = table(spark, sf, "orders")
    return readers.with_fallback(o, cases, F.concat_ws("__", "o_custkey", F.col("o_orderkey") % 25), F.col("o_custkey").cast("string"), "v").select("o_orderkey", "v")


@register(
    "previous_tail",
    r"""SELECT conv_id, turn, CASE WHEN p IS NOT NULL THEN list_last(list_filter(string_split(p, chr(10)), lambda x: trim(x) <> '')) END AS tail
        FROM (SELECT conv_id, turn, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations)""",
)
def previous_tail(spark, sf):
    p = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("order"), "text", F.lit(1).alias("seam_lines"))
    return readers.previous_tail(p).select(F.col("doc_id").alias("conv_id"), F.col("order").alias("turn"), F.try_element_at("previous_tail", F.lit(1)).alias("tail"))


@register(
    "tuning_verdicts",
    """SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'no reference' WHEN n_chars > 800 AND doc_id % 3 = 0 THEN 'missed text' WHEN n_chars < 120 AND doc_id % 3 <> 0 THEN 'perhaps blank' ELSE 'ok' END AS verdict FROM documents""",
)
def tuning_verdicts(spark, sf):
    d, k = table(spark, sf, "documents"), F.col("doc_id")
    pages = d.select(k, k.cast("string").alias("page_id"), F.when(k % 3 == 0, "blank").otherwise("segmented").alias("route"))
    regions = d.select(k, k.cast("string").alias("page_id"), F.lit("text").alias("kind"), F.lit(1).alias("est_lines"))
    return readers.tuning(pages, regions, d.where(k % 4 != 0).select(k.cast("string").alias("page_id"), F.col("n_chars").alias("length"))).select("doc_id", "verdict")


@register(
    "envelope_check",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'unknown key k,source_key is missing,record is missing' ELSE 'unknown key zz,source_key is missing' END AS problems,
         CASE WHEN event_id % 3 = 0 THEN 's' || event_id END AS source_key, CASE event_id % 3 WHEN 0 THEN '{"a":' || event_id || '}' WHEN 2 THEN '1' END AS record FROM events""",
)
def envelope_check(spark, sf):
    k = F.col("event_id")
    good = F.to_json(F.struct(F.concat(F.lit("s"), k).alias("source_key"), F.struct(k.alias("a")).alias("record")))
    line = F.when(k % 3 == 0, good).when(k % 3 == 1, F.col("props")).otherwise('{"source_key":"","record":1,"zz":2}')
    rows = table(spark, sf, "events").select(F.lit("f").alias("file"), k.alias("line_number"), line.alias("line"), F.lit(None).cast("string").alias("problem"))
    return files.envelopes(rows).select(F.col("line_number").alias("event_id"), F.array_join("problems", ",").alias("problems"), F.nullif("source_key", F.lit("")).alias("source_key"), "record")


@register("line_pages", "SELECT event_id, CAST(floor((row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) / 100) AS INTEGER) AS page FROM events WHERE event_id > 50")
def line_pages(spark, sf):
    rows = table(spark, sf, "events").select(F.col("event_type").alias("file"), F.col("event_id").alias("line_number"))
    return files.pages(rows, 50).select(F.col("line_number").alias("event_id"), "page")


@register("unknown_keys", "SELECT event_id, array_to_string(list_filter(json_keys(props), lambda x: x <> 'z'), ',') AS keys FROM events")
def unknown_keys(spark, sf):
    return table(spark, sf, "events").select("event_id", F.array_join(contracts.unknown_keys(F.col("props"), ["z"]), ",").alias("keys"))


@register(
    "edition_check",
    """SELECT DISTINCT conv_id AS doc_id, 'heading is empty' AS problem FROM conversations WHERE turn = 1
       UNION SELECT conv_id, 'section_index is not its place' FROM conversations GROUP BY conv_id HAVING max(turn) >= 2
       UNION SELECT conv_id, 'section count differs' FROM conversations WHERE conv_id % 7 = 0""",
)
def edition_check(spark, sf):
    c = table(spark, sf, "conversations")
    index = F.when(F.col("turn") == 2, 9).otherwise(F.col("turn"))
    rows = F.sort_array(F.collect_list(F.struct("turn", F.struct(index.alias("section_index"), F.when(F.col("turn") == 1, " ").otherwise("h").alias("heading"), F.col("role").alias("translation")).alias("s"))))
    e = c.groupBy(F.col("conv_id").alias("doc_id")).agg(F.transform(rows, lambda x: x["s"]).alias("sections"))
    m = e.select("doc_id", F.when(F.col("doc_id") % 7 == 0, F.array_append("sections", F.element_at("sections", 1))).otherwise(F.col("sections")).alias("sections"))
    return contracts.edition_problems(m, e)


@register(
    "span_check",
    """WITH b AS (SELECT conv_id, max(turn) AS m FROM conversations GROUP BY conv_id)
       SELECT conv_id, 'unknown page' AS problem FROM b UNION ALL SELECT conv_id, 'backward' FROM b WHERE m > 0""",
)
def span_check(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", F.col("turn").alias("ord"))
    top = c.groupBy("conv_id").agg(F.max("ord").alias("m"))
    spans = top.selectExpr("conv_id", "'a' as span_id", "cast(0 as bigint) as lo", "m + 1 as hi").unionAll(top.selectExpr("conv_id", "'b'", "m", "cast(0 as bigint)"))
    return sequences.span_problems(c, spans, "conv_id").select("conv_id", "problem")


@register("quiet_pages", "SELECT l_orderkey, l_linenumber, count(*) FILTER (l_quantity < 10 AND l_tax = 0) > 0 AS any_quiet FROM lineitem GROUP BY l_orderkey, l_linenumber")
def quiet_pages(spark, sf):
    flags = F.struct(F.when(F.col("l_tax") == 0, 0).otherwise(1).alias("count_mismatches"), F.lit(0).alias("disputes"), F.col("l_quantity").alias("disagreements"))
    return table(spark, sf, "lineitem").withColumn("q", contracts.is_quiet(flags, 9)).groupBy("l_orderkey", "l_linenumber").agg(F.bool_or("q").alias("any_quiet"))


@register("failure_kinds", "SELECT event_id, event_type = 'error' AS truncated, event_type = 'click' AS transient FROM events")
def failure_kinds(spark, sf):
    finish = F.when(F.col("event_type") == "error", "LENGTH").otherwise("stop")
    error = F.when(F.col("event_type") == "click", "HTTP 503 try later").otherwise("bad request 400")
    return table(spark, sf, "events").select("event_id", contracts.is_truncated(finish, error).alias("truncated"), contracts.is_transient(error).alias("transient"))


@register("published_text", "SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN '[Blank page]' WHEN turn % 3 = 1 THEN '[No transcribed text]' ELSE text END AS text FROM conversations")
def published_text(spark, sf):
    t = F.when(F.col("turn") % 3 == 2, F.col("text")).otherwise(" \n")
    return table(spark, sf, "conversations").select("conv_id", "turn", publish.published_text(t, F.col("turn") % 3 == 0).alias("text"))


@register("book_identity", "SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN n_name ELSE 'label' END AS title, split_part(n_name, '_', 1) AS archive FROM nation")
def book_identity(spark, sf):
    title, archive = publish.book_identity(F.when(F.col("n_regionkey") == 1, F.col("n_name")).otherwise(""), F.lit("label"), F.lit(None).cast("string"), F.col("n_name"))
    return table(spark, sf, "nation").select("n_nationkey", title.alias("title"), archive.alias("archive"))


@register("page_routes", "SELECT p_partkey, CASE WHEN p_retailprice * 20 < 15000 THEN 'blank' WHEN p_size % 10 <= 3 AND p_size <= 30 THEN 'full_page' ELSE 'segmented' END AS route FROM part")
def page_routes(spark, sf):
    return table(spark, sf, "part").select("p_partkey", publish.route(F.lit(1), F.lit(1), F.col("p_retailprice") * 20, F.col("p_size") % 10, F.col("p_size")).alias("route"))


@register("unsafe_paths", "SELECT page_id FROM pages WHERE page_id % 5 = 0 OR page_id % 7 = 0")
def unsafe_paths(spark, sf):
    k = F.col("page_id")
    path = F.when(k % 5 == 0, "a/../b").when(k % 7 == 0, "/etc").otherwise("a/b.txt")
    return publish.unsafe_paths(table(spark, sf, "pages").select("page_id", path.alias("path"))).select("page_id")


@register("ambiguous_headings", "SELECT o_custkey AS doc_id, o_orderpriority AS heading, count(DISTINCT o_orderstatus) AS n FROM orders GROUP BY ALL HAVING count(DISTINCT o_orderstatus) > 1")
def ambiguous_headings(spark, sf):
    return publish.ambiguous_headings(table(spark, sf, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderpriority").alias("heading"), F.col("o_orderstatus").alias("section_id")))


@register(
    "composed_regions",
    """SELECT l_orderkey, string_agg(CASE WHEN l_returnflag = 'R' THEN '[margin] ' ELSE '' END || l_partkey, chr(10) || chr(10) ORDER BY l_partkey, l_returnflag) AS text FROM (SELECT DISTINCT l_orderkey, l_partkey, l_returnflag FROM lineitem) GROUP BY l_orderkey""",
)
def composed_regions(spark, sf):
    i = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag").distinct()
    kind = F.when(F.col("l_returnflag") == "R", "marginalia").otherwise("text")
    regions = F.collect_list(F.struct(F.col("l_partkey").alias("reading_order"), F.col("l_returnflag").alias("f"), kind.alias("kind"), F.col("l_partkey").cast("string").alias("text")))
    return i.groupBy("l_orderkey").agg(publish.compose(regions).alias("text"))


@register(
    "folio_join",
    """SELECT c.conv_id AS doc_id, c.turn AS page_id, CASE WHEN c.turn % 2 = 0 AND c.conv_id % 3 <> 0 THEN c.role END AS alignment FROM conversations c WHERE c.turn % 5 <> 4""",
)
def folio_join(spark, sf):
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_id"), "role", "text")
    alignments = c.where("page_id % 2 = 0").select("doc_id", "page_id", F.col("role").alias("alignment"), F.when(F.col("doc_id") % 3 != 0, "now").otherwise("old").alias("transcription_fingerprint"))
    rows = publish.folios(c.select("doc_id", "page_id"), c.select("doc_id", "page_id", "text", F.lit("now").alias("fingerprint")), c.where("page_id % 5 <> 4").select("doc_id", "page_id", F.upper("text").alias("translation")), alignments)
    return rows.select("doc_id", "page_id", "alignment")


@register("selection_window", "SELECT lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS source_key FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0 ORDER BY source_key LIMIT 12")
def selection_window(spark, sf):
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    rows = o.select(k.alias("record_id"), F.lit(1).alias("current_revision"), F.lpad(k.cast("string"), 8, "0").alias("source_key"), F.to_json(F.struct(k.cast("string").alias("manifest_url"))).alias("normalized_json"))
    surveyed = o.where("o_orderkey % 3 = 0").select(k.alias("record_id"), F.lit(1).alias("revision"))
    return survey.window(rows, surveyed, o.where("o_orderkey % 5 = 0").select(k.cast("string").alias("manifest_url")), 12).select("source_key")


@register("tumbling_counts", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS began, event_type, count(*) AS n FROM events GROUP BY ALL")
def tumbling_counts(spark, sf):
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return sync.windowed_counts(e, "ts", "event_type", "1 hour").select("began", "event_type", "n")


@register(
    "gap_sessions",
    """WITH a AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
       b AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM a)
       SELECT user_id, min(ts) AS began, count(*) AS n FROM b GROUP BY user_id, s""",
)
def gap_sessions(spark, sf):
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return sync.sessions(e, "ts", "user_id", "2 hours").select("user_id", "began", "n")


@register("latest_fold", "SELECT user_id, max(event_id) AS event_id, max_by(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def latest_fold(spark, sf):
    return sync.latest_by(["user_id"], "event_id", ["event_type"])(table(spark, sf, "events"))


@register(
    "stamp_union",
    "SELECT 0 AS grain, event_id AS seq FROM events WHERE event_type = 'view' UNION ALL SELECT 1, event_id FROM events WHERE event_type = 'click'",
)
def stamp_union(spark, sf):
    e = table(spark, sf, "events")
    pick = lambda kind, n: e.where(F.col("event_type") == kind).select(F.lit(n).alias("grain"), F.col("event_id").alias("seq"))
    return pick("view", 0).unionByName(pick("click", 1))


@register(
    "page_order",
    "SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(nullif(turn, 2), 0), turn) AS INTEGER) AS place FROM conversations",
)
def page_order(spark, sf):
    c = table(spark, sf, "conversations").withColumn("order", F.nullif(F.col("turn"), F.lit(2)))
    return c.select("conv_id", "turn", F.row_number().over(sequences.page_order("conv_id", "order", "turn")).alias("place"))


@register("ink_characters", "SELECT item_id, CAST(length(regexp_replace(text, '[〔〕?()\\[\\] 　\\n]', '', 'g')) AS INTEGER) AS ink FROM benchmark")
def ink_characters(spark, sf):
    ink = F.aggregate(exprs.text_lines_to_ink(F.col("text")), F.lit(0), lambda a, x: a + F.size(x))
    return table(spark, sf, "benchmark").select("item_id", ink.alias("ink"))


@register(
    "source_counts",
    "SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY source",
)
def source_counts(spark, sf):
    return table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n")).orderBy("source")


@register(
    "normalized_contract",
    "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'record_type is not allowed' WHEN doc_id % 4 = 1 THEN 'titles holds an empty value' WHEN doc_id % 4 = 2 THEN 'date_start is after date_end' ELSE '' END AS problems FROM documents",
)
def normalized_contract(spark, sf):
    k = F.col("doc_id")
    none = {n: F.lit(None).cast("array<string>") for n in catalog.LISTS} | {n: F.lit(None).cast("string") for n in catalog.SCALARS}
    r = none | {
        "record_type": F.when(k % 4 == 0, "poster").otherwise("map"), "access": F.lit(None).cast("string"), "titles": F.array(F.lit("t"), F.when(k % 4 == 1, " ").otherwise("u")),
        "date_start": F.lit(1200), "date_end": F.when(k % 4 == 2, 1100).otherwise(1300),
    }
    problems = contracts_of(F.struct(*[v.alias(n) for n, v in r.items()]))
    return table(spark, sf, "documents").select("doc_id", problems.alias("problems"))


def contracts_of(record):
    return F.array_join(catalog.normalized_problems(record), ",")


@register("timeline", "SELECT user_id, event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS previous_recipe FROM events")
def timeline(spark, sf):
    w = Window.partitionBy("user_id").orderBy("event_id")
    return table(spark, sf, "events").select("user_id", "event_id", F.lag("event_type").over(w).alias("previous_recipe"))
