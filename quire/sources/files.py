"""Strict file sources: JSON lines, single JSON documents, keyed lines, content-addressed objects and globbed metadata.

A line's number within its file comes from one split of the whole file; use them for files that are read as units (their lines carry a
cursor). Bulk JSON without cursors belongs to spark.read.json.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE = ("source_key", "source_url", "source_modified_at", "record", "raw")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_number, line): 1-based physical lines, blank ones left out but counted; a byte-order mark is dropped."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "\\A\ufeff", "").alias("value"))
    lines = rows.select("file", F.posexplode(F.split("value", "\r\n|[\n\r]", -1)).alias("at", "line"))
    return lines.where("trim(line) <> ''").select("file", (F.col("at") + 1).cast("long").alias("line_number"), "line")


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Strict JSON lines (file, line_number, line, problem): problem names what is not a JSON object."""
    kind = F.schema_of_variant(F.try_parse_json("line"))
    problem = F.when(F.try_parse_json("line").isNull(), "not JSON").when(~kind.startswith("OBJECT"), "not an object")
    return numbered_lines(spark, path).withColumn("problem", F.when(F.col("line").rlike(r"\A\s*null\s*\z"), "not an object").otherwise(problem))


def envelopes(rows: DataFrame) -> DataFrame:
    """Source records of read_jsonl(): source_key, source_url, source_modified_at, record, raw, and problems."""
    line = F.col("line")
    keys = F.coalesce(F.json_object_keys(line), F.array().cast("array<string>"))
    unknown = F.array_except(keys, F.array(*map(F.lit, ENVELOPE)))
    get = lambda name: F.get_json_object(line, f"$.{name}")
    problems = F.concat(
        F.transform(unknown, lambda k: F.concat(F.lit("unknown key "), k)),
        F.array_compact(F.array(F.col("problem"), F.when(F.coalesce(get("source_key"), F.lit("")) == "", F.lit("source_key is missing")), F.when(get("record").isNull(), F.lit("record is missing")))),
    )
    return rows.select("file", "line_number", get("source_key").alias("source_key"), get("source_url").alias("source_url"), get("source_modified_at").alias("source_modified_at"), get("record").alias("record"), F.coalesce(get("raw"), get("record")).alias("raw"), problems.alias("problems"))


def pages(rows: DataFrame, cursor: int | None, size: int = 100) -> DataFrame:
    """Rows after a cursor (the last line consumed) with their page number; a page's cursor is its greatest line."""
    if size < 1:
        raise ValueError("a page has one row at least")
    from pyspark.sql import Window

    rest = rows if cursor is None else rows.where(F.col("line_number") > cursor)
    n = F.row_number().over(Window.partitionBy("file").orderBy("line_number"))
    return rest.withColumn("page", F.floor((n - 1) / size).cast("int"))


def keyed_lines(spark: SparkSession, path: str, field: str) -> DataFrame:
    """(case_id, value): the last line of each case wins."""
    rows = numbered_lines(spark, path).select(F.get_json_object("line", "$.case_id").alias("case_id"), F.get_json_object("line", f"$.{field}").alias("value"), "line_number")
    return rows.groupBy("case_id").agg(F.max_by("value", "line_number").alias("value"))


def reference_lengths(spark: SparkSession, path: str) -> DataFrame:
    rows = numbered_lines(spark, path).select(F.get_json_object("line", "$.page_id").alias("page_id"), F.length(F.get_json_object("line", "$.text")).alias("n"), "line_number")
    return rows.groupBy("page_id").agg(F.max_by("n", "line_number").alias("length"))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): each file as one JSON text."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "\\A\ufeff", "").alias("value"))


def known_manifest_urls(spark: SparkSession, glob: str) -> DataFrame:
    """Distinct source.manifest_url of metadata files; older shapes don't count."""
    return read_json(spark, glob).select(F.get_json_object("value", "$.source.manifest_url").alias("manifest_url")).where("manifest_url is not null").distinct()


def objects(spark: SparkSession, roots: list[str], digests: DataFrame) -> DataFrame:
    """(sha256, content, problem) of content-addressed objects: the first root that has one wins, its digest is checked again."""
    found = None
    for i, root in enumerate(roots):
        files = spark.read.format("binaryFile").load(f"{root}/objects").select(F.element_at(F.split("path", "/"), -1).alias("sha256"), "content", F.lit(i).alias("root"))
        found = files if found is None else found.unionByName(files)
    best = found.groupBy("sha256").agg(F.min_by("content", "root").alias("content"))
    j = digests.select("sha256").join(best, "sha256", "left")
    return j.withColumn("problem", F.when(F.col("content").isNull(), "missing").when(F.sha2("content", 256) != F.col("sha256"), "digest differs"))


def provenance(text: Column) -> Column:
    """The provenance stamp within a JSON text, as JSON; null where there is none or the text is no JSON."""
    return F.get_json_object(text, "$.provenance")


def prompt(spark: SparkSession, root: str, name: str):
    """A text resource by its slash name with its sha256; a name may not climb out of the root."""
    if name.startswith("/") or ".." in name.split("/") or "\\" in name:
        raise ValueError(f"{name} is no resource name")
    return spark.read.text(f"{root}/{name}.md", wholetext=True).select(F.lit(name).alias("name"), F.col("value").alias("text"), F.sha2("value", 256).alias("sha256")).first()
