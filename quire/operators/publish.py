"""Publication: book projections by positional joins, content-addressed bundles, inventories and their reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.exprs import first_of, strip


def sections(manuscript: DataFrame, emendations: DataFrame, edition: DataFrame) -> DataFrame:
    """One row a section, joined by place; a document whose three counts differ is refused (problem is set, place is null).

    Each input has doc_id and sections, an array of structs.
    """
    j = manuscript.select("doc_id", F.col("sections").alias("m")).join(emendations.select("doc_id", F.col("sections").alias("e")), "doc_id").join(edition.select("doc_id", F.col("sections").alias("d")), "doc_id")
    same = (F.size("m") == F.size("e")) & (F.size("m") == F.size("d"))
    rows = j.select("doc_id", F.when(~same, F.lit("section counts differ")).alias("problem"), F.posexplode_outer(F.when(same, F.arrays_zip("m", "e", "d"))).alias("place", "z"))
    return rows.select("doc_id", "problem", "place", F.col("z.m").alias("manuscript"), F.col("z.e").alias("emended"), F.col("z.d").alias("edited"))


def apparatus(entries: DataFrame, headings: DataFrame) -> DataFrame:
    """Entries (doc_id, position, heading, ...) with ids in source order and their section; an unknown heading leaves section_id null."""
    w = Window.partitionBy("doc_id").orderBy("position")
    rows = entries.withColumn("entry_id", F.format_string("a%04d", F.row_number().over(w)))
    return rows.join(headings.select("doc_id", "heading", "section_id"), ["doc_id", "heading"], "left")


def ambiguous_headings(headings: DataFrame) -> DataFrame:
    """Headings that stand for more than one section."""
    return headings.groupBy("doc_id", "heading").agg(F.count_distinct("section_id").alias("n")).where("n > 1")


def folios(pages: DataFrame, transcriptions: DataFrame, translations: DataFrame, alignments: DataFrame) -> DataFrame:
    """Pages with transcription and translation, and with an alignment where its stamp is current."""
    a = alignments.select("doc_id", "page_id", F.col("alignment").alias("alignment"), F.col("transcription_fingerprint").alias("_print"))
    rows = pages.join(transcriptions, ["doc_id", "page_id"]).join(translations, ["doc_id", "page_id"])
    return rows.join(a, ["doc_id", "page_id"], "left").withColumn("alignment", F.when(F.col("_print") == F.col("fingerprint"), F.col("alignment"))).drop("_print")


def published_text(text: Column, blank: Column) -> Column:
    return F.when(strip(F.coalesce(text, F.lit(""))) != "", text).when(blank, "[Blank page]").otherwise("[No transcribed text]")


def book_identity(title: Column, label: Column, archive: Column, doc_id: Column) -> tuple[Column, Column]:
    """Title and archive with their fallbacks: the label, the id; the id's part before the first underscore."""
    return first_of(title, label, doc_id), first_of(archive, F.split_part(doc_id, F.lit("_"), F.lit(1)))


def station_model(models: Column) -> Column:
    """One model as itself, several as a list, none as null, in JSON."""
    return F.when(F.size(models) == 1, F.to_json(F.struct(F.element_at(models, 1).alias("v")))).when(F.size(models) > 1, F.to_json(models))


def inventory(files: DataFrame) -> DataFrame:
    """(path, bytes, sha256) of binaryFile rows."""
    return files.select("path", F.length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def reconcile(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(path, problem) of a full outer compare of two inventories (path, bytes): missing, extra or size_changed."""
    j = expected.select("path", F.col("bytes").alias("_e")).join(actual.select("path", F.col("bytes").alias("_a")), "path", "full")
    problem = F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "extra").when(F.col("_a") != F.col("_e"), "size_changed")
    return j.select("path", problem.alias("problem")).where("problem is not null")


def bundle_id(files: DataFrame) -> DataFrame:
    """The content address of a set of files: sha256 of its rows' canonical JSON, ordered by path.

    One row a file in one array: bundles list at most some thousands of files.
    """
    rows = F.sort_array(F.collect_list(F.struct("path", "bytes", "sha256")))
    return files.agg(F.concat(F.lit("sha256:"), F.sha2(F.to_json(rows), 256)).alias("bundle_id"))


def unlisted(references: DataFrame, files: DataFrame) -> DataFrame:
    return references.join(files, "path", "left_anti")


def unsafe_paths(files: DataFrame) -> DataFrame:
    """Paths that are absolute, climb, or hold back slashes or empty parts."""
    return files.where(F.col("path").rlike(r"^/|^[A-Za-z]:|\\|(^|/)\.{0,2}(/|$)"))


def epub_is_current(epub_source: Column, book_fingerprint: Column) -> Column:
    return F.coalesce(epub_source == book_fingerprint, F.lit(False))


def resolve_status(statuses: Column) -> Column:
    """A page's adjudication from its regions': failed, then single_reader_fallback, then adjudicated, then agreement if all agree."""
    has = lambda s: F.array_contains(statuses, s)
    return F.when(has("failed"), "failed").when(has("single_reader_fallback"), "single_reader_fallback").when(has("adjudicated"), "adjudicated").when((F.size(statuses) > 0) & F.forall(statuses, lambda s: s == "agreement"), "agreement").otherwise("not_needed")


def compose(regions: Column) -> Column:
    """Region texts (reading_order, kind, text) in order, by blank lines; marginalia are marked, empty ones passed over."""
    ordered = F.filter(F.sort_array(regions), lambda r: strip(F.coalesce(r["text"], F.lit(""))) != "")
    return F.array_join(F.transform(ordered, lambda r: F.concat(F.when(r["kind"] == "marginalia", "[margin] ").otherwise(""), r["text"])), "\n\n")


def route(width: Column, height: Column, ink: Column, regions: Column, lines_: Column) -> Column:
    """How a page is read: blank, full_page or segmented."""
    return F.when(ink < 15_000, "blank").when((regions <= 3) & (lines_ <= 30), "full_page").otherwise("segmented")
