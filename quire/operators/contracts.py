"""Schema contracts as rule expressions: each rule gives a message where it fails, so one pass tells all that is wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.exprs import doc_id_valid, failures, strip

HEX16 = r"\A[0-9a-f]{16}\z"


def payload_problems(payload: Column, required: list[str], doc_id: Column | None = None) -> Column:
    """Messages for a JSON object: required keys that it lacks, and a doc_id that is malformed or not the expected one."""
    keys = F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>"))
    missing = F.transform(F.array_except(F.array(*map(F.lit, required)), keys), lambda k: F.concat(F.lit("missing "), k))
    own = F.get_json_object(payload, "$.doc_id")
    more = [(doc_id_valid(own), "doc_id is malformed")] + ([(own == doc_id, "doc_id is not the expected one")] if doc_id is not None else [])
    return F.when(F.json_object_keys(payload).isNull(), F.array(F.lit("not an object"))).otherwise(F.concat(missing, failures(*more)))


def unknown_keys(payload: Column, allowed: list[str]) -> Column:
    return F.array_sort(F.array_except(F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>")), F.array(*map(F.lit, allowed))))


def page_list_problems(pages: DataFrame) -> DataFrame:
    """(doc_id, problem) of page lists (doc_id, page_id, url, order): repeated ids, empty urls, missing orders. Orders may repeat."""
    rows = pages.groupBy("doc_id", "page_id").agg(F.count("*").alias("n"), F.count_if(F.coalesce(strip(F.col("url")), F.lit("")) == "").alias("no_url"), F.count_if(F.col("order").isNull()).alias("no_order"))
    problem = F.explode(failures((F.col("n") == 1, "page_id repeats"), (F.col("no_url") == 0, "url is empty"), (F.col("no_order") == 0, "order is missing"), (F.coalesce(F.col("page_id"), F.lit("")) != "", "page_id is empty")))
    return rows.select("doc_id", problem.alias("problem")).distinct()


def record_problems(doc_id: Column, metadata: Column, page_list: Column) -> Column:
    """Messages for what intake has made of a document: its id, its metadata and its page list, in JSON, bound to that id."""
    say = lambda what, problems: F.transform(problems, lambda x: F.concat(F.lit(f"{what}: "), x))
    pages = F.from_json(page_list, "struct<pages array<struct<page_id string, url string, order int>>>")["pages"]
    ids = F.transform(pages, lambda p: p["page_id"])
    own = failures(
        (F.coalesce(F.size(pages), F.lit(0)) > 0, "there are no pages"),
        (F.coalesce(F.size(F.array_distinct(ids)) == F.size(ids), F.lit(True)), "page_id repeats"),
        (F.coalesce(F.forall(pages, lambda p: (strip(F.coalesce(p["page_id"], F.lit(""))) != "") & (strip(F.coalesce(p["url"], F.lit(""))) != "") & p["order"].isNotNull()), F.lit(True)), "a page lacks its id, url or order"),
    )
    return F.concat(failures((doc_id_valid(doc_id), "doc_id is malformed")), say("metadata", payload_problems(metadata, ["doc_id", "source"], doc_id)), say("page_list", F.concat(payload_problems(page_list, ["doc_id", "pages"], doc_id), own)))


def book_problems(folios: DataFrame, sections: DataFrame, apparatus: DataFrame, colophon: DataFrame | None = None) -> DataFrame:
    """(doc_id, problem): whatever does not refer rightly within books.

    folios: doc_id, folio_id, order. sections: doc_id, section_id, number, folio_ids, apparatus_ids. apparatus: doc_id, entry_id.
    colophon: doc_id, pages, cost_usd, cost_complete.
    """
    w = Window.partitionBy("doc_id").orderBy("position")
    say = lambda rows, what: rows.select("doc_id", F.lit(what).alias("problem"))
    order = folios.withColumn("_before", F.lag("order").over(w)).where("_before >= order")
    twice = lambda rows, c: rows.groupBy("doc_id", c).agg(F.count("*").alias("n")).where("n > 1")
    numbers = sections.groupBy("doc_id").agg(F.sort_array(F.collect_list("number")).alias("s"), F.count("*").alias("n")).where("s <> sequence(1, cast(n as int))")
    cited = sections.select("doc_id", "section_id", F.posexplode("folio_ids").alias("at", "folio_id"))
    unknown = cited.join(folios, ["doc_id", "folio_id"], "left_anti")
    repeats = cited.groupBy("doc_id", "section_id", "folio_id").agg(F.count("*").alias("n")).where("n > 1")
    placed = cited.join(folios.select("doc_id", "folio_id", "order"), ["doc_id", "folio_id"])
    moved = placed.withColumn("_before", F.lag("order").over(Window.partitionBy("doc_id", "section_id").orderBy("at"))).where("_before > order")
    entries = sections.select("doc_id", F.explode("apparatus_ids").alias("entry_id"))
    out = [
        say(order, "folio orders do not increase"), say(twice(folios, "folio_id"), "folio_id repeats"), say(twice(sections, "section_id"), "section_id repeats"), say(numbers, "section numbers are not 1 to n"),
        say(unknown, "section cites an unknown folio"), say(repeats, "section repeats a folio"), say(moved, "section folios are out of order"), say(twice(entries, "entry_id"), "apparatus entry is cited twice"),
        say(entries.join(apparatus, ["doc_id", "entry_id"], "left_anti"), "unknown apparatus entry is cited"), say(apparatus.join(entries, ["doc_id", "entry_id"], "left_anti"), "apparatus entry is not cited"),
    ]
    if colophon is not None:
        n = folios.groupBy("doc_id").agg(F.count("*").alias("n"))
        c = colophon.join(n, "doc_id", "left")
        out.append(say(c.where("pages <> coalesce(n, 0)"), "colophon pages differ from the folios"))
        out.append(say(c.where("(cost_usd is null) = cost_complete or cost_usd < 0"), "colophon cost does not hold"))
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result.distinct()


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, repeats counted, with the side that has them."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def edition_problems(manuscript: DataFrame, edition: DataFrame) -> DataFrame:
    """(doc_id, problem): an edition has as many sections as its manuscript, numbered by place, with headings and translations."""
    m = manuscript.select("doc_id", F.size("sections").alias("n"))
    e = edition.select("doc_id", F.size("sections").alias("k"), F.posexplode_outer("sections").alias("at", "s"))
    count = m.join(e.select("doc_id", "k").distinct(), "doc_id", "left").where("n <> coalesce(k, 0)").select("doc_id", F.lit("section count differs").alias("problem"))
    checks = failures((F.col("s.section_index") == F.col("at"), "section_index is not its place"), (strip(F.col("s.heading")) != "", "heading is empty"), (strip(F.col("s.translation")) != "", "translation is empty"))
    return count.unionByName(e.where("at is not null").select("doc_id", F.explode(checks).alias("problem"))).distinct()


def source_ref_problems(ref: Column, kinds: list[str]) -> Column:
    """Messages for a lineage pointer (kind, pointer, fingerprint)."""
    return failures((ref["kind"].isin(kinds), "kind is unknown"), (ref["pointer"].startswith("/"), "pointer is no JSON pointer"), (ref["fingerprint"].rlike(HEX16), "fingerprint is malformed"))


def is_quiet(flags: Column, most: int) -> Column:
    """Whether a page needs no audit: no count mismatch, no dispute, few enough disagreements; a negative limit never is quiet."""
    return F.coalesce(F.lit(most >= 0) & (flags["count_mismatches"] == 0) & (flags["disputes"] == 0) & (flags["disagreements"] <= most), F.lit(False))


def apply_edits(text: Column, edits: Column) -> Column:
    """text with edits (offset, source, target), ordered and apart, applied from the end; null if one does not match."""

    def step(done: Column, e: Column) -> Column:
        match = F.substring(done, e["offset"] + 1, F.length(e["source"])) == e["source"]
        return F.when(match, F.concat(F.substring(done, F.lit(1), e["offset"]), e["target"], F.substring(done, e["offset"] + F.length(e["source"]) + 1, F.length(done))))

    return F.aggregate(F.reverse(F.sort_array(edits)), text, step)


def edits_in_order(edits: Column) -> Column:
    """Whether edits are given in order and do not overlap."""
    pairs = F.sequence(F.lit(1), F.greatest(F.size(edits) - 1, F.lit(1)))
    fine = F.forall(pairs, lambda i: F.get(edits, i - 1)["offset"] + F.length(F.get(edits, i - 1)["source"]) <= F.get(edits, i)["offset"])
    return F.when(F.size(edits) < 2, True).otherwise(fine)


def first_json(answer: Column) -> Column:
    """The JSON object or array of a model's answer, without code fences."""
    bare = F.regexp_replace(answer, r"(?s)\A\s*```[a-zA-Z]*\s*|\s*```\s*\z", "")
    return F.regexp_extract(bare, r"(?s)(\{.*\}|\[.*\])", 1)


def flags_block(answer: Column) -> Column:
    """The JSON between the first flag markers; {} where there is none or it is no JSON."""
    found = F.regexp_extract(answer, r"(?s)---FLAGS---\s*(\{.*?\})\s*---END FLAGS---", 1)
    return F.when(F.expr("true") & F.json_object_keys(found).isNotNull(), found).otherwise("{}")


def is_truncated(finish: Column, error: Column) -> Column:
    return F.coalesce(F.lower(finish).rlike(r"^(length|max_tokens|max_output_tokens)$"), F.lit(False)) | F.coalesce(F.lower(error).rlike(r"truncat|maximum (output )?tokens|max_tokens"), F.lit(False))


def is_transient(error: Column) -> Column:
    return F.coalesce(F.lower(error).rlike(r"\b(429|500|502|503|504)\b|rate limit|overloaded|timed? ?out|temporar"), F.lit(False))
