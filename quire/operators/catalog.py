"""Versioned source catalog: snapshot merges with revisions, events and tombstones, and the reads over them.

States are DataFrames. A merge is a full outer join on the record's id; each outcome is a flag of its own, as one record can
be revived and unchanged at once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.exprs import clean_list, failures, first_of, record_fingerprint, record_id, strip

RECORDS = "record_id string, source_id string, source_key string, current_revision int, current_fingerprint string, tombstoned boolean"
REVISIONS = "record_id string, revision int, fingerprint string, source_url string, source_modified_at string, normalized_json string, raw_json string"
EVENTS = "record_id string, sync_id long, event string"

#: What a record and its access may be, and the fields of a normalized record.
RECORD_TYPES = "manuscript manuscript_fragment scroll codex leaf document collection_unit printed_book rubbing map image unknown".split()
ACCESS = "open restricted unknown".split()
LISTS = "titles descriptions subjects languages scripts contributors identifiers relations rights".split()
SCALARS = "repository collection catalog_url manifest_url date_label material".split()
NUMBERS = "date_start date_end".split()
NORMALIZED = (
    "record_type string, access string, "
    + ", ".join(f"{n} array<string>" for n in LISTS)
    + ", "
    + ", ".join(f"{n} string" for n in SCALARS)
    + ", "
    + ", ".join(f"{n} int" for n in NUMBERS)
)


@dataclass(frozen=True)
class Merge:
    """What a snapshot page or a whole snapshot does to the state."""

    records: DataFrame
    revisions: DataFrame
    events: DataFrame
    changes: DataFrame


def normalized_problems(r: Column) -> Column:
    """Messages of what is wrong with a normalized record struct; empty if it may enter the catalog."""
    checks = [(F.coalesce(r["record_type"], F.lit("unknown")).isin(RECORD_TYPES), "record_type is not allowed"), (F.coalesce(r["access"], F.lit("unknown")).isin(ACCESS), "access is not allowed")]
    for name in LISTS:
        checks.append((F.coalesce(~F.exists(r[name], lambda x: F.coalesce(strip(x) == "", F.lit(True))), F.lit(True)), f"{name} holds an empty value"))
    for name in SCALARS:
        checks.append((F.coalesce(strip(r[name]) != "", F.lit(True)), f"{name} is empty"))
    checks.append((F.coalesce(r["date_start"] <= r["date_end"], F.lit(True)), "date_start is after date_end"))
    return failures(*checks)


def normalized_json(r: Column) -> Column:
    """The canonical, sparse JSON form: type and access always, lists only where not empty, scalars only where known."""
    fields = {"record_type": F.coalesce(r["record_type"], F.lit("unknown")), "access": F.coalesce(r["access"], F.lit("unknown"))}
    for name in LISTS:
        value = clean_list(r[name])
        fields[name] = F.when(F.size(value) > 0, value)
    for name in SCALARS:
        fields[name] = strip(r[name])
    for name in NUMBERS:
        fields[name] = r[name]
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))


def snapshot(rows: DataFrame, source_id: str) -> DataFrame:
    """rows (source_key, source_url, source_modified_at, normalized_json, raw_json) with their identity and fingerprint."""
    print_ = record_fingerprint(F.col("source_url"), F.col("source_modified_at"), F.col("normalized_json"), F.col("raw_json"))
    return rows.select("*", F.lit(source_id).alias("source_id"), record_id(F.lit(source_id), F.col("source_key")).alias("record_id"), print_.alias("fingerprint"))


def duplicate_keys(rows: DataFrame) -> DataFrame:
    """Keys that a page holds more than once; such a page is refused as a whole."""
    return rows.groupBy("source_key").agg(F.count("*").alias("n")).where("n > 1 or source_key is null or source_key = ''")


def merge(records: DataFrame, page: DataFrame, sync_id: int, whole: bool = False) -> Merge:
    """Merges a page of snapshot() into records; whole: what the page lacks becomes a tombstone."""
    new = page.select("record_id", F.col("source_id").alias("n_source"), F.col("source_key").alias("n_key"), F.col("fingerprint").alias("n_print"), "source_url", "source_modified_at", "normalized_json", "raw_json")
    j = records.join(new, "record_id", "full")
    seen, known = F.col("n_key").isNotNull(), F.col("source_key").isNotNull()
    j = j.select(
        "*",
        (seen & ~known).alias("inserted"),
        (seen & known & (F.col("n_print") != F.col("current_fingerprint"))).alias("revised"),
        (seen & known & (F.col("n_print") == F.col("current_fingerprint"))).alias("unchanged"),
        (seen & known & F.col("tombstoned")).alias("revived"),
        (~seen & known & ~F.col("tombstoned") & F.lit(whole)).alias("gone"),
    )
    revision = F.when(F.col("inserted"), F.lit(1)).when(F.col("revised"), F.col("current_revision") + 1).otherwise(F.col("current_revision"))
    out = j.select(
        "record_id", F.coalesce("source_id", "n_source").alias("source_id"), F.coalesce("source_key", "n_key").alias("source_key"), revision.cast("int").alias("current_revision"),
        F.coalesce("n_print", "current_fingerprint").alias("current_fingerprint"), (F.col("gone") | (F.coalesce("tombstoned", F.lit(False)) & ~seen)).alias("tombstoned"),
    )
    revisions = j.where("inserted or revised").select("record_id", revision.cast("int").alias("revision"), F.col("n_print").alias("fingerprint"), "source_url", "source_modified_at", "normalized_json", "raw_json")
    names = F.array_compact(F.array(*[F.when(F.col(flag), F.lit(name)) for flag, name in (("inserted", "discovered"), ("revised", "revised"), ("revived", "revived"), ("gone", "tombstoned"))]))
    events = j.select("record_id", F.lit(sync_id).cast("long").alias("sync_id"), F.explode(names).alias("event"))
    count = lambda flag: F.count_if(F.col(flag)).alias(f"records_{flag}")
    changes = j.agg(F.count_if(seen).alias("records_seen"), *map(count, ("inserted", "revised", "unchanged", "revived")), F.count_if("gone").alias("records_tombstoned"))
    return Merge(out, revisions, events, changes)


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def current(records: DataFrame, revisions: DataFrame) -> DataFrame:
    """Each record with its current revision."""
    right = revisions.withColumnRenamed("record_id", "_id")
    return records.join(right, (records.record_id == right._id) & (records.current_revision == right.revision)).drop("_id")


def records_of(records: DataFrame, revisions: DataFrame, source_id: str, limit: int = 100) -> DataFrame:
    """The first records of a source by key, tombstones included."""
    return current(records.where(F.col("source_id") == source_id), revisions).orderBy("source_key").limit(limit)


def selection(records: DataFrame, revisions: DataFrame, source_id: str, after: str | None = None) -> DataFrame:
    """Records to choose from: not tombstones, after a key, with a manifest and not restricted, by key."""
    if after is not None and not after.strip():
        raise ValueError("the cursor is blank")
    rows = records.where((F.col("source_id") == source_id) & ~F.col("tombstoned"))
    rows = rows if after is None else rows.where(F.col("source_key") > after)
    j = F.col("normalized_json")
    return current(rows, revisions).where((F.coalesce(F.get_json_object(j, "$.manifest_url"), F.lit("")) != "") & (F.get_json_object(j, "$.access") != "restricted")).orderBy("source_key")


def record(records: DataFrame, revisions: DataFrame, id_: str):
    """One record's row; LookupError if it is unknown or a tombstone."""
    row = current(records.where(F.col("record_id") == id_), revisions).first()
    if row is None:
        raise LookupError(f"unknown record {id_}")
    if row.tombstoned:
        raise LookupError(f"record {id_} is gone")
    return row


def stats(records: DataFrame) -> DataFrame:
    """Counts of sources, records, live and dead ones, in one pass."""
    return records.agg(F.count_distinct("source_id").alias("sources"), F.count("*").alias("records"), F.count_if(~F.col("tombstoned")).alias("active"), F.count_if("tombstoned").alias("tombstoned"))


def pivot_labels(entries: DataFrame, key: str, label: str, value: str, position: str) -> DataFrame:
    """Label/value metadata as a map a key: labels lower-cased with single spaces, the first value of a label wins."""
    name = F.lower(strip(F.regexp_replace(F.col(label), r"(?U)\s+", " ")))
    first = Window.partitionBy(key, "_name").orderBy(position)
    rows = entries.select("*", name.alias("_name")).withColumn("_n", F.row_number().over(first)).where("_n = 1")
    pairs = F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("_name").alias("k"), F.col(value).alias("v")))))
    return rows.groupBy(key).agg(pairs.alias("labels"))


def archive_fields(labels: Column) -> dict[str, Column]:
    """Columns from a label map, by synonyms in order of precedence."""
    get = lambda name: F.try_element_at(labels, F.lit(name))
    return {"archive": first_of(get("archive"), get("repository")), "author": first_of(get("author"), get("creator")), "date": first_of(get("date"), get("dat")), "language": first_of(get("language"), get("lingua"))}
