import difflib
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.functions import exprs, geometry, images, text
from quire.operators import catalog, contracts, ledger, publish, sequences, survey
from quire.plans import line
from quire.sources import files, manifests, sinks, sru
from quire.streaming import sync


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


# Expressions --------------------------------------------------------------------------------------------------------------


def test_fingerprint_takes_null_as_empty(spark):
    a = one(spark, exprs.fingerprint(F.lit("a"), F.lit(None).cast("string"), F.lit("b")))
    assert a == one(spark, exprs.fingerprint(F.lit("a"), F.lit(""), F.lit("b"))) and len(a) == 16
    assert a != one(spark, exprs.fingerprint(F.lit("a"), F.lit("b")))


def test_sums_that_unknown_values_poison(spark):
    d = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 3.0)], "k string, x double")
    got = {r.k: r.s for r in d.groupBy("k").agg(exprs.sum_or_unknown(F.col("x")).alias("s")).collect()}
    assert got == {"a": None, "b": 5.0}
    assert d.agg(exprs.sum_or_unknown_where(F.col("x"), F.col("k") == "z").alias("s")).first().s == 0.0


def test_lines_and_unicode_space(spark):
    for s in ("", "a", "a\n", "a\n\n", "a\r\nb\rc", "a\x0bb\x85c d", "\n"):
        assert one(spark, exprs.lines(F.lit(s))) == s.splitlines(), repr(s)
    assert one(spark, exprs.strip(F.lit("　 a b  "))) == "a b"
    assert one(spark, exprs.squash(F.lit("a　b  c"))) == "abc"


def test_picks_and_excerpts(spark):
    for n in (0, 1, 2, 3, 4, 7, 10, 11):
        expected = list(range(n)) if n <= 3 else [round((i + 1) * (n - 1) / 4) for i in range(3)]
        assert one(spark, exprs.evenly_spaced(F.lit(n), 3)) == expected
    assert one(spark, exprs.excerpt(F.lit("abc def ghi"), 6)) == "abc…"
    assert one(spark, exprs.excerpt(F.lit("abcdefghi"), 6)) == "abcde…"
    assert one(spark, exprs.excerpt(F.lit("abc"), 6)) == "abc"


# Catalog ------------------------------------------------------------------------------------------------------------------


def page(spark, rows):
    return catalog.snapshot(spark.createDataFrame([(k, None, None, v, "{}") for k, v in rows], "source_key string, source_url string, source_modified_at string, normalized_json string, raw_json string"), "s")


def test_catalog_life(spark):
    counts = lambda m: tuple(m.changes.first())
    first = catalog.merge(catalog.empty(spark, catalog.RECORDS), page(spark, [("a", "1"), ("b", "1")]), 1, whole=True)
    assert counts(first) == (2, 2, 0, 0, 0, 0)
    second = catalog.merge(first.records, page(spark, [("a", "2")]), 2, whole=True)
    assert counts(second) == (1, 0, 1, 0, 0, 1)
    third = catalog.merge(second.records, page(spark, [("a", "2"), ("b", "1")]), 3, whole=True)
    assert counts(third) == (2, 0, 0, 2, 1, 0)  # revived and unchanged at once
    assert {(r.event) for r in third.events.collect()} == {"revived"}
    revisions = first.revisions.unionByName(second.revisions)
    assert [(r.source_key, r.revision, r.tombstoned) for r in catalog.records_of(second.records, revisions, "s").collect()] == [("a", 2, False), ("b", 1, True)]
    with pytest.raises(LookupError):
        catalog.record(second.records, revisions, third.records.where("source_key = 'b'").first().record_id)
    assert catalog.duplicate_keys(page(spark, [("a", "1"), ("a", "2")])).count() == 1
    with pytest.raises(ValueError):
        catalog.selection(third.records, revisions, "s", " ")


def test_normalized_records(spark):
    ddl = catalog.NORMALIZED
    base = {"record_type": "codex", "access": "open", "titles": [" A ", "A", "B"], "date_start": 5, "date_end": 4, "material": " "}
    d = spark.createDataFrame([base], ddl).select(F.struct("*").alias("r"))
    assert set(d.select(catalog.normalized_problems(F.col("r"))).first()[0]) == {"material is empty", "date_start is after date_end"}
    good = spark.createDataFrame([base | {"material": "ink", "date_end": 6}], ddl).select(F.struct("*").alias("r"))
    assert good.select(F.size(catalog.normalized_problems(F.col("r")))).first()[0] == 0
    assert json.loads(good.select(catalog.normalized_json(F.col("r"))).first()[0]) == {"access": "open", "date_end": 6, "date_start": 5, "material": "ink", "record_type": "codex", "titles": ["A", "B"]}


# Ledger -------------------------------------------------------------------------------------------------------------------


def test_latest_state_and_leases(spark):
    runs = spark.createDataFrame([(1, "d", "s", None, "done"), (2, "d", "s", "", "done"), (3, "d", "s", "p", "done"), (4, "d", "s", "p", "failed:x")], "run_id long, doc_id string, station string, page_id string, status string")
    assert sorted(r.run_id for r in ledger.latest_state(runs).collect()) == [2, 3]
    now = F.to_timestamp(F.lit("2024-01-01 01:00:00"))
    work = spark.createDataFrame([(1, "a", "running", "2024-01-01 00:49:59"), (2, "b", "running", "2024-01-01 00:50:01"), (3, "c", "done", "2023-01-01 00:00:00")], "work_run_id long, doc_id string, status string, t string").withColumn("heartbeat_at", F.to_timestamp("t"))
    assert [r.doc_id for r in ledger.abandoned(work, now).collect()] == ["a"]
    after, cells = ledger.after_abandonment(work, spark.createDataFrame([("a", "running"), ("b", "running"), ("a", "done")], "doc_id string, status string"), now)
    assert {r.doc_id: r.status for r in after.collect()} == {"a": "abandoned", "b": "running", "c": "done"}
    assert sorted((r.doc_id, r.status) for r in cells.collect()) == [("a", "done"), ("a", "failed:abandoned"), ("b", "running")]
    assert [(r.doc_id, r.problem) for r in ledger.claim_problems(work, now).collect()] == [("b", "leased")]


def test_freshness(spark):
    names = "has_inputs output_exists input_now input_then config_now config_then output_now output_then stamp_input stamp_config".split()
    base = (True, True, "i", "i", "c", "c", "o", "o", "i", "c")
    rows = {"fresh": base, "outdated": base[:5] + ("d",) + base[6:], "run": base[:3] + ("x",) + base[4:], "failed": (False,) + base[1:], "recovered": base[:3] + (None,) + base[4:]}
    for action, row in rows.items():
        d = spark.createDataFrame([row], ", ".join(f"{n} {'boolean' if i < 2 else 'string'}" for i, n in enumerate(names)))
        assert ledger.freshness(d).first().action == action


# Survey -------------------------------------------------------------------------------------------------------------------


def test_survey_scores_and_ties(spark):
    rules = {"require": {"transcribable": True}, "languages": ["la"], "forgotten_only": True, "keywords": ["herb", "Herb"]}
    d = spark.createDataFrame([("a", 1, "la", True, False, "A HERBAL"), ("b", 2, "la", True, None, "x"), ("c", 3, "la", True, True, "x"), ("d", 4, "la", False, False, "herb"), ("e", 5, None, True, None, None)], "record_id string, insert_seq long, language_script string, transcribable boolean, known_publicly boolean, content_guess string")
    got = survey.ranked(d, rules).collect()
    assert [(r.record_id, r.score) for r in got] == [("a", 3), ("c", 1), ("b", 1)]
    assert got[0].reasons == ["language la", "not-known (web check)", "keyword herb"]
    assert [r.record_id for r in survey.ranked(d, rules, d.where("record_id = 'a'"), keep=1).collect()] == ["c"]
    with pytest.raises(ValueError):
        survey.ranked(d, {"colour": 1})


def test_checklists(spark):
    good = {"physical_form": "mixed", "sustained_text": True, "language_script": None, "transcribable": False, "content_guess": "", "known_publicly": None, "web_check": "w", "evidence": "e", "risks": ["r"]}
    bad = good | {"physical_form": "stone", "transcribable": 1, "risks": [1], "known_publicly": "no"}
    del bad["evidence"]
    d = spark.createDataFrame([(json.dumps(good),), (json.dumps(bad),), ("[1]",)], "j string")
    rows = [r[0] for r in d.select(survey.checklist_problems(F.col("j"))).collect()]
    assert rows[0] == []
    assert set(rows[1]) == {"missing field evidence", "physical_form must be handwritten|printed|mixed|other", "transcribable must be a boolean", "risks must be a list of strings", "known_publicly must be boolean or null"}
    assert rows[2] == ["checklist must be a JSON object"]


def test_cost_gate():
    gate = survey.CostGate(1.0)
    gate.add(0.6)
    assert gate.open()
    gate.add(0.6)
    assert not gate.open() and gate.stop_reason() == "cost ceiling"
    gate = survey.CostGate(1.0)
    gate.add(None)
    assert not gate.open() and gate.stop_reason() == "unknown cost"


# Sequences ----------------------------------------------------------------------------------------------------------------


def test_trimmed_pages_have_no_line_ends_around(spark):
    before, after = "one line of ink\ntwo line of ink\nthree here it is", "two line of ink\nthree here it is\n\nnew text here\n\n"
    d = spark.createDataFrame([("d", 1, before), ("d", 2, after)], "doc_id string, o int, text string")
    row = sequences.seams(d, "doc_id", "o", "text").where("o = 2").first()
    assert row.seam.lines == 2 and row.trimmed.text == "new text here" and row.trimmed.dropped == "two line of ink\nthree here it is"


def test_coverage_problems():
    manuscript, sections = [("a", "the old word"), ("b", "same")], [("a", "the new word"), ("b", "same more")]
    entries = [("a", "old word", "new word", "Parallel: work · 3"), ("b", "", "same more", "  PARALLEL text"), ("c", "x", "", "")]
    assert sequences.coverage_problems(manuscript, sections, entries) == [("citation without work and section", "b", "  PARALLEL text"), ("unknown section", "c", "")]
    assert sequences.coverage_problems(manuscript, sections[::-1], [("a", "gone", "new", "")]) == [
        ("headings differ", "", ""), ("uncovered change", "b", " ->  more at 4".replace(" ->  more", " ->  more")), ("anchor not found", "a", "original: gone"), ("uncovered change", "a", "old -> new at 4"),
    ]


def test_assembly(spark):
    pages = spark.createDataFrame([("d", 1, "p1", "one hyph-"), ("d", 2, "p2", " "), ("d", 3, "p3", "enated"), ("d", 4, "p4", "goes on"), ("d", 5, "p5", "new")], "doc_id string, order int, page_id string, text string")
    joins = spark.createDataFrame([("d", "p2", "p3", "hyphenation_repair"), ("d", "p3", "p4", "sentence_continuation")], "doc_id string, from_page string, to_page string, join string")
    assert sequences.assemble_documents(pages, joins).first().text == "one hyphenated goes on\n\nnew"
    bad = sequences.join_problems(pages, joins.unionByName(joins.where("to_page = 'p4'")).unionByName(spark.createDataFrame([("d", "p1", "p4", "x")], joins.schema)))
    assert sorted(r.problem for r in bad.collect()) == ["declared twice", "not neighbours"]


def test_seams(spark):
    before = "alpha line of text\nbeta line of text\n\ngamma line here\n"
    after = "\nbeta line of texT\ngamma line hare\n\ndelta comes next\nmore"
    d = spark.createDataFrame([("d", 1, before), ("d", 2, after), ("d", 3, "unlike anything\nelse at all")], "doc_id string, o int, text string")
    rows = sequences.seams(d, "doc_id", "o", "text").orderBy("o").collect()
    ratio = [difflib.SequenceMatcher(None, a, b).ratio() for a, b in (("beta line of text", "beta line of texT"), ("gamma line here", "gamma line hare"))]
    assert rows[0].seam.lines is None and rows[2].seam.lines is None
    assert (rows[1].seam.lines, rows[1].seam.similarity) == (2, round(sum(ratio) / 2, 3))
    assert rows[1].trimmed.text == "delta comes next\nmore" and rows[1].trimmed.dropped == "\nbeta line of texT\ngamma line hare"
    assert one(spark, sequences.apply_seam(F.lit("abc def"), F.lit("abc "))) == "def"
    assert one(spark, sequences.apply_seam(F.lit("abc def"), F.lit("x"))) is None
    assert one(spark, sequences.apply_seam(F.lit("abc\n\ndef"), F.lit("abc"))) == "def"
    assert one(spark, sequences.apply_seam(F.lit("abc\n\ndef"), F.lit("abc"), line_ends=True)) == "\n\ndef"


def test_diffs(spark):
    # What was replaced must be anchored in the old text, what was added in the new one.
    assert sequences.uncovered("the old word here", "the new word here", ["old word"], []) == []
    assert sequences.uncovered("the old word here", "the new word here", [], ["new word"]) == [("old", "new", 4)]
    assert sequences.uncovered("the word here", "the new word here", [], ["the new word"]) == [] != sequences.uncovered("the word here", "the new word here", ["the word"], [])
    d = spark.createDataFrame([("d", 1, "abcabc", "xbcxbc a"), ("d", 2, "q", "q")], "doc_id string, section int, before string, after string")
    assert [(r.old, r.new, r.instances, r.survivors) for r in sequences.sweeps(d).collect()] == [("a", "x", 2, 1)]
    # Counts are of one document: the same replacements in two do not add up.
    two = spark.createDataFrame([("d", 1, "abc", "xbc a"), ("e", 1, "abc", "xbc a")], "doc_id string, section int, before string, after string")
    assert sequences.sweeps(two).count() == 0 and sequences.sweeps(two, 1).count() == 2
    got = one(spark, sequences.diff_spans(F.lit("a b c"), F.lit("axc")))
    assert [(s.base, s.alternative, s.at) for s in got] == [("b", "x", 1)]
    assert sequences.pair_lines(["one", "two words", "three"], ["one", "twa words", "x", "three"]) == {0: "one", 1: "twa words", 2: "three"}


# Geometry -----------------------------------------------------------------------------------------------------------------


def test_scores_are_rounded_in_binary(spark):
    values = [0.0, 0.004999999999999999, 0.115, 0.285, 0.125, 0.145, 1.005, 35.855 % 1, 0.49499999999999994, -0.125, 0.575]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", exprs.rounded(F.col("v"), 2).alias("r")).collect()
    away = lambda y: math.floor(y) + (y - math.floor(y) >= 0.5)
    assert {r.i: r.r for r in rows} == {i: math.copysign(away(abs(v) * 100.0), v) / 100.0 for i, v in enumerate(values)}


def test_suppression_ties_and_regions(spark):
    boxes = [(0, 0, 10, 10), (0, 0, 10, 10), (20, 0, 30, 10), (1, 0, 11, 10)]
    assert geometry.suppress(boxes, [0.5, 0.5, 0.9, 0.4], 0.5) == [2, 1]
    points = spark.createDataFrame([(1, 0, 5.0, 5.0), (2, 0, 99.0, 5.0)], "point_id int, page int, cx double, cy double")
    regions = spark.createDataFrame([(0, 0, 0.0, 0.0, 10.0, 10.0), (1, 0, 4.0, 4.0, 6.0, 6.0), (2, 0, 4.0, 4.0, 6.0, 6.0)], "region_id int, page int, x0 double, y0 double, x1 double, y1 double")
    assert {r.point_id: r.region_id for r in geometry.in_regions(points, regions, ["page"]).collect()} == {1: 1, 2: None}


def test_alignments():
    assert geometry.align_counts([3, 5], [3, 5]) == ([0, 1], "index")
    assert geometry.align_counts([3, 9, 5], [3, 5]) == ([0, 2], "realigned 3 detected columns to 2 lines")
    assert geometry.align_counts([5, 10, 4, 10, 1], [7, 11, 7])[0] == [0, 1, 3]
    assert geometry.align_counts([], [3])[0] == [None] and geometry.align_counts([3], [])[0] == []
    assert geometry.pair_columns([10, 2, 8], [10, 8]) == [0, 2]
    assert geometry.cluster_columns([100, 99, 50, 51], [10, 10, 10, 10]) == [0, 0, 1, 1]
    cells = [(0, 0, 8, 10), (0, 12, 8, 17), (1, 17, 9, 22)]
    assert geometry.bind_characters(cells, 2, 10.0) == [((0, 0, 8, 10), 1.0, "blob"), ((0, 12, 9, 10), 1.0, "merged")]
    assert geometry.bind_characters([], 1, 10.0) == [(None, 0.0, "none")] and geometry.bind_characters(cells, 0, 10.0) == []
    assert geometry.bind_characters([(0, 0, 5, 7)], 1, 10.0) == [((0, 0, 5, 7), 0.76, "blob")]
    assert geometry.merge_boxes([(0, 0, 10, 10), (5, 0, 15, 10), (50, 50, 60, 60)]) == [(0, 0, 15, 10), (50, 50, 60, 60)]


def test_bindings_cost_least():
    """Against all ways to bind: no way is cheaper, and characters and cells keep their order."""
    rnd = random.Random(8)

    def cost(cells, chars):
        if not cells and not chars:
            return 0.0
        ways = []
        if chars:
            ways.append(1.0 + cost(cells, chars - 1))
            for k in range(1, min(4, len(cells)) + 1):
                height = max(c[3] for c in cells[:k]) - min(c[1] for c in cells[:k])
                ways.append(geometry.fit_cost(height, 10.0) + 0.15 * (k - 1) + cost(cells[k:], chars - 1))
        if cells:
            ways.append(0.9 + cost(cells[1:], chars))
        return min(ways)

    for _ in range(40):
        y, cells = 0, []
        for _ in range(rnd.randint(0, 5)):
            h = rnd.randint(2, 14)
            cells.append((0, y, 8, y + h))
            y += h + rnd.randint(0, 3)
        chars = rnd.randint(0, 4)
        bound = geometry.bind_characters(cells, chars, 10.0)
        used = sum(sum(b[1] <= c[1] and c[3] <= b[1] + b[3] for c in cells) for b, _, _ in bound if b)
        spent = sum(1.0 if b is None else geometry.fit_cost(b[3], 10.0) for b, _, _ in bound) + 0.15 * (used - sum(b is not None for b, _, _ in bound)) + 0.9 * (len(cells) - used)
        assert len(bound) == chars and abs(spent - cost(cells, chars)) < 1e-9


def test_detected_columns_are_read_from_the_top(spark):
    rows = [(0, 1, 0.0, 9.0, 10.0, 19.0), (0, 2, 1.0, 0.0, 11.0, 8.0), (0, 3, 50.0, 5.0, 60.0, 15.0), (0, 4, 0.0, 0.0, 10.0, 8.0)]
    d = spark.createDataFrame(rows, "page int, box_id int, x0 double, y0 double, x1 double, y1 double")
    got = sorted((r.column, r.place, r.box_id) for r in geometry.detected_columns(d, "page").collect())
    assert got == [(0, 0, 3), (1, 0, 4), (1, 1, 2), (1, 2, 1)]


def test_grid_joins_equal_plain_ones(spark):
    rnd = random.Random(4)
    points = [(i, i % 2, rnd.uniform(-50, 50), rnd.uniform(-50, 50)) for i in range(200)]
    boxes = [(i, i % 2, x := rnd.uniform(-60, 40), y := rnd.uniform(-60, 40), x + rnd.choice([1, 5, 40]), y + rnd.choice([1, 5, 40])) for i in range(40)]
    p = spark.createDataFrame(points, "point_id int, page int, cx double, cy double")
    r = spark.createDataFrame(boxes, "region_id int, page int, x0 double, y0 double, x1 double, y1 double")
    best = {i: min((((x1 - x0) * (y1 - y0), k) for k, q, x0, y0, x1, y1 in boxes if q == page and x0 <= x <= x1 and y0 <= y <= y1), default=(0, None))[1] for i, page, x, y in points}
    assert {r.point_id: r.region_id for r in geometry.in_regions(p, r, ["page"]).collect()} == best
    text = [(i, page, x, y, rnd.uniform(1, 9), rnd.uniform(1, 9)) for i, page, x, y in points]
    t = spark.createDataFrame(text, "box_id int, page int, x double, y double, w double, h double")
    f = r.selectExpr("page", "x0 as x", "y0 as y", "x1 - x0 as w", "y1 - y0 as h")
    inside = lambda page, x, y, w, h: any(q == page and max(0, min(x + w, x1) - max(x, x0)) * max(0, min(y + h, y1) - max(y, y0)) >= 0.7 * w * h for _, q, x0, y0, x1, y1 in boxes)
    assert {r.box_id for r in geometry.outside_figures(t, f, ["page"]).collect()} == {i for i, *b in text if not inside(*b)}
    assert geometry.in_regions(p, r.limit(0), ["page"]).where("region_id is null").count() == 200


def test_alignment_is_the_cheapest():
    rnd = random.Random(1)

    def cheapest(a, b):
        if not a and not b:
            return 0.0
        out = []
        if a and b:
            out.append(abs(a[0] - b[0]) + cheapest(a[1:], b[1:]))
        if a:
            out.append(4 + cheapest(a[1:], b))
        if b:
            out.append(4 + cheapest(a, b[1:]))
        return min(out)

    for _ in range(40):
        a, b = ([rnd.randint(1, 12) for _ in range(rnd.randint(0, 5))] for _ in range(2))
        pairs = geometry.align(len(a), len(b), lambda i, j, a=a, b=b: abs(a[i] - b[j]), 4.0, 4.0)
        assert sum(abs(a[i] - b[j]) if i is not None and j is not None else 4 for i, j in pairs) == pytest.approx(cheapest(a, b))


# Text, contracts, publication ---------------------------------------------------------------------------------------------


def test_text(spark):
    assert one(spark, text.normalize_recognized(F.lit("漢  字 a\r\n廿 é"), {"漢": "汉"})) == "汉字 a\n二十 é"
    assert one(spark, text.trim_malformed_end(F.lit(" text\\n_`} "))) == "text"
    assert one(spark, text.flag_summary(F.create_map(F.lit("b"), F.lit(2), F.lit("a"), F.lit(1)))) == "a=1 b=2"


def test_book_problems(spark):
    folios = spark.createDataFrame([("d", 1, "f1", 1), ("d", 2, "f2", 2), ("e", 1, "f1", 2), ("e", 2, "f2", 2)], "doc_id string, position int, folio_id string, order int")
    sections = spark.createDataFrame([("d", "s1", 1, ["f1", "f2"], ["a1"]), ("e", "s1", 2, ["f2", "f9"], ["a1", "a2"])], "doc_id string, section_id string, number int, folio_ids array<string>, apparatus_ids array<string>")
    entries = spark.createDataFrame([("d", "a1"), ("e", "a1"), ("e", "a3")], "doc_id string, entry_id string")
    colophon = spark.createDataFrame([("d", 2, 1.0, True), ("e", 3, None, True)], "doc_id string, pages int, cost_usd double, cost_complete boolean")
    got = {(r.doc_id, r.problem) for r in contracts.book_problems(folios, sections, entries, colophon).collect()}
    assert {p for d, p in got if d == "d"} == set()
    assert {p for d, p in got if d == "e"} == {"folio orders do not increase", "section numbers are not 1 to n", "section cites an unknown folio", "unknown apparatus entry is cited", "apparatus entry is not cited", "colophon pages differ from the folios", "colophon cost does not hold"}


def test_edits_and_answers(spark):
    edits = F.array(F.struct(F.lit(0).alias("offset"), F.lit("a").alias("source"), F.lit("X").alias("target")), F.struct(F.lit(2).alias("offset"), F.lit("c").alias("source"), F.lit("YY").alias("target")))
    assert one(spark, contracts.apply_edits(F.lit("abc"), edits)) == "XbYY"
    assert one(spark, contracts.apply_edits(F.lit("abd"), edits)) is None
    assert one(spark, contracts.edits_in_order(edits)) and not one(spark, contracts.edits_in_order(F.reverse(edits)))
    assert one(spark, contracts.flags_block(F.lit('x ---FLAGS--- {"a": 1} ---END FLAGS--- y'))) == '{"a": 1}'
    assert one(spark, contracts.flags_block(F.lit("---FLAGS--- {bad ---END FLAGS---"))) == "{}"
    assert json.loads(one(spark, contracts.first_json(F.lit('```json\n{"a": [1]}\n``` done')))) == {"a": [1]}


def test_publication(spark):
    assert one(spark, publish.resolve_status(F.array(F.lit("agreement"), F.lit("failed")))) == "failed"
    assert one(spark, publish.resolve_status(F.array(F.lit("agreement"), F.lit("not_needed")))) == "not_needed"
    assert one(spark, publish.published_text(F.lit(" "), F.lit(True))) == "[Blank page]"
    bad = publish.unsafe_paths(spark.createDataFrame([("/a",), ("a/../b",), ("a//b",), ("a/b.txt",), ("a\\b",)], "path string"))
    assert {r.path for r in bad.collect()} == {"/a", "a/../b", "a//b", "a\\b"}


# Sources and sinks --------------------------------------------------------------------------------------------------------


def test_json_lines(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('﻿{"source_key": "a", "record": {"x": 1}}\n\n[1]\nnope\n{"source_key": "", "record": 1, "z": 2}\n', encoding="utf-8")
    rows = files.read_jsonl(spark, str(p)).orderBy("line_number").collect()
    assert [(r.line_number, r.problem) for r in rows] == [(1, None), (3, "not an object"), (4, "not JSON"), (5, None)]
    e = files.envelopes(files.read_jsonl(spark, str(p)).where("problem is null")).orderBy("line_number").collect()
    assert e[0].source_key == "a" and e[0].raw == e[0].record == '{"x":1}' and e[0].problems == []
    assert set(e[1].problems) == {"unknown key z", "source_key is missing"}
    k = tmp_path / "k.jsonl"
    k.write_text('{"case_id": "a", "v": 1}\n{"case_id": "a", "v": 2}\n{"case_id": "b", "v": []}\n')
    assert {r.case_id: r.value for r in files.keyed_lines(spark, str(k), "v").collect()} == {"a": "2", "b": "[]"}


RESPONSE = """<s:r xmlns:s="x" xmlns:dc="y"><s:numberOfRecords>{total}</s:numberOfRecords><s:records>{records}</s:records>{next}</s:r>"""
RECORD = "<s:record><s:recordData><dc:dc><dc:title>T {n} fragment</dc:title><dc:identifier>https://g/ark:/12148/b{n}</dc:identifier><dc:language>LAT</dc:language><dc:language>fre</dc:language><dc:date>1200-1300</dc:date><dc:type>manuscrit</dc:type><dc:rights>domaine public</dc:rights></dc:dc></s:recordData><s:recordPosition>{n}</s:recordPosition></s:record>"


def fake_fetch(url):
    at = int(url.split("startRecord=")[1].split("&")[0])
    following = f"<s:nextRecordPosition>{at + 2}</s:nextRecordPosition>" if at < 3 else ""
    return 200, {}, RESPONSE.format(total=4, records=RECORD.format(n=at) + RECORD.format(n=at + 1), next=following)


def test_sru(spark):
    got = list(sru.pages(fake_fetch, "http://x?q", 2))
    assert [n for n, _ in got] == [3, None] and sum(len(r) for _, r in got) == 4
    waits, answers = [], iter([(503, {}, ""), (429, {"Retry-After": "7"}, ""), (200, {}, "ok")])
    assert sru.politely(lambda u: next(answers), "u", sleep=waits.append) == "ok" and waits == [1.0, 7.0]
    with pytest.raises(OSError):
        sru.politely(lambda u: (404, {}, ""), "u", sleep=waits.append)
    with pytest.raises(ValueError):
        sru.parse_response("<a/>")

    class Source(sru.SruSource):
        fetch = staticmethod(fake_fetch)

    spark.dataSource.register(Source)
    rows = spark.read.format("quire_sru").option("url", "http://x?q").option("pagesize", "2").load()
    spark.udtf.register("leaves_of", sru.LeafFields)
    rows.createOrReplaceTempView("sru_rows")
    leaves = spark.sql("select position as record, l.* from sru_rows, lateral leaves_of(xml) l")
    r = sru.field_lists(leaves).where("record = '1'").select(sru.project(F.col("fields"), "R", "C").alias("n")).first().n
    assert (r.source_key, r.record_type, r.access, r.languages, r.date_start, r.date_end) == ("ark:/12148/b1", "manuscript_fragment", "open", ["LAT", "fr"], 1200, 1300)
    assert r.manifest_url == "https://gallica.bnf.fr/iiif/ark:/12148/b1/manifest.json"


def test_chunks_estimate_tokens_exactly(spark):
    # 0.35 * 2,860 are 1,001 tokens, so six chunks; in binary they are a little less, and five.
    d = spark.createDataFrame([("c", i, n) for i, n in enumerate([2849, *[1] * 11])], "k string, i int, n long")
    assert [r.chunk for r in sequences.chunks(d, "k", "i", F.col("n"), 200).orderBy("i").collect()] == [i // 2 for i in range(12)]


def test_manifests(spark):
    two = {"sequences": [{"canvases": [{"@id": "c1", "label": "f. 1r", "images": [{"resource": {"@id": "http://i/a.jpg"}}, {"resource": {"service": {"@id": "http://i/no"}}}]}, {"@id": "c2", "label": "1r", "images": [{"resource": {"service": [{"@id": "http://i/2/info.json?k=1"}]}}]}]}]}
    three = {"items": [{"type": "Range"}, {"type": "Canvas", "id": "x", "label": {"none": ["fol. 12 V"]}, "items": [{"items": [{"body": {"service": [{"id": "http://i/3/"}]}}]}]}]}
    d = spark.createDataFrame([("two", json.dumps(two)), ("three", json.dumps(three))], "doc_id string, manifest string")
    rows = {(r.doc_id, r.order): (r.page_id, r.url) for r in manifests.page_list(d, "300").collect()}
    assert rows == {("two", 1): ("f001r", "http://i/a.jpg"), ("two", 2): ("page_0001", "http://i/2/full/300,/0/default.jpg?k=1"), ("three", 1): ("f012v", "http://i/3/full/300,/0/default.jpg")}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("t", "d1", "p1", '{"doc_id":"d1","text":"x"}', "{}"), ("img", "d1", "p1", None, "{}")], "kind string, doc_id string, page_id string, payload string, provenance string")
    sinks.write_artifacts(rows, str(tmp_path / "a"), {"t": ["doc_id", "text"]})
    assert spark.read.parquet(str(tmp_path / "a")).count() == 2
    with pytest.raises(ValueError):
        sinks.write_artifacts(rows.withColumn("doc_id", F.lit("d2")), str(tmp_path / "b"), {"t": ["doc_id"]})
    s = json.loads(one(spark, sinks.stamp(F.lit("read"), F.lit("f"), tokens_out=F.lit("3"))))
    assert s == {"station": "read", "fingerprint": "f"}
    import io
    import zipfile

    z = zipfile.ZipFile(io.BytesIO(sinks.epub("T & T", "en", [("One", "a\n\nb <c>\nd")], ["note"], "made")))
    assert z.namelist()[0] == "mimetype" and "<p>a</p><p>b &lt;c&gt;<br/>d</p>" in z.read("s1.xhtml").decode()
    m = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], "path string, bytes long, sha256 string")
    other = spark.createDataFrame([("a", 2, "x"), ("c", 1, "x")], "path string, bytes long, sha256 string")
    assert {(r.path, r.problem) for r in sinks.snapshot_problems(m, other).collect()} == {("a", "changed"), ("b", "missing"), ("c", "extra")}


# Plans and streams --------------------------------------------------------------------------------------------------------

KINDS = {"metadata": "manuscript", "page_list": "manuscript", "image": "page", "text": "page", "book": "manuscript"}


def make_registry():
    r = line.Registry(KINDS)
    r.register(line.Station("acquire", ("page_list",), "image", options=("size",)))
    r.register(line.Station("read", ("image",), "text", model=True))
    r.register(line.Station("publish", ("metadata", "text"), "book", "manuscript", optional=("image",)))
    return r


def test_recipes(spark):
    r = make_registry()
    source = "name: x\nsteps:\n- station: acquire\n  options: {size: '${SIZE}'}\n- station: read\n  model: m\n  prompt: p\n- station: publish\n"
    recipe = line.load(source, r, {"SIZE": "max"}, {})
    assert recipe.steps[0].options == (("size", "max"),)
    with pytest.raises(LookupError):
        line.load(source, r, {}, {})
    assert line.chain_problems(line.Recipe("y", (line.Step("read", model="m", prompt="p"), line.Step("acquire", options=(("z", 1),)), line.Step("acquire"))), r) == ["read lacks image", "acquire: unknown option z", "image is made twice"]
    assert [[s.station for s in b] for b in line.batches(recipe.steps, r)] == [["acquire", "read"], ["publish"]]
    assert line.slice_steps(recipe, r, "read") == (recipe.steps[:2], True)
    assert line.slice_steps(recipe, r, pages_only=True) == (recipe.steps[:2], True)
    with pytest.raises(ValueError):
        line.slice_steps(recipe, r, "publish", pages_only=True)
    with pytest.raises(ValueError):
        r.register(line.Station("other", ("page_list",), "image"))
    assert ("image", "publish", "optional") in r.edges() and "-.->" in r.mermaid()
    assert {x.name for x in line.closure(r.edge_table(spark), ["page_list"]).collect()} == {"page_list", "acquire", "image", "read", "text", "publish", "book"}
    assert line.artifact_fingerprint({"b": 1, "a": "é", "provenance": 3}) == line.artifact_fingerprint({"a": "é", "b": 1})


def test_sync_stream(spark, tmp_path):
    src = tmp_path / "src"
    rows = lambda ks: spark.createDataFrame([(k, None, None, v, "{}") for k, v in ks], "source_key string, source_url string, source_modified_at string, normalized_json string, raw_json string")
    rows([("a", "1"), ("b", "1")]).coalesce(1).write.parquet(str(src), mode="append")
    tables = sync.CatalogTables(spark, str(tmp_path / "tables"))
    stream = lambda: spark.readStream.schema(rows([]).schema).parquet(str(src))
    sync.sync_stream(stream(), tables, "s", 1, str(tmp_path / "cp")).awaitTermination()
    rows([("a", "2")]).coalesce(1).write.parquet(str(src), mode="append")
    sync.sync_stream(stream(), tables, "s", 1, str(tmp_path / "cp")).awaitTermination()
    assert {(r.source_key, r.current_revision) for r in tables.records().collect()} == {("a", 2), ("b", 1)}
    assert sorted(r.event for r in tables.log("events", catalog.EVENTS).collect()) == ["discovered", "discovered", "revised"]
    assert not tables.apply(page(spark, [("a", "9")]), 1, 0)  # that batch was applied
    assert sync.end_snapshot(tables, rows([("a", "2")]), 1).count() == 1


def test_windows_over_streams(spark, tmp_path):
    e = spark.createDataFrame([(1, "2024-01-01 00:00:10"), (1, "2024-01-01 00:04:00"), (1, "2024-01-01 00:20:00"), (2, "2024-01-01 00:00:30")], "k int, t string").withColumn("ts", F.to_timestamp("t"))
    e.coalesce(1).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(e.schema).parquet(str(tmp_path / "e"))
    got = sync.run_to_end(sync.windowed_counts(stream, "ts", "k", "5 minutes"), "w1", "complete", str(tmp_path / "c1"))
    assert sorted((r.k, r.n) for r in got.collect()) == [(1, 1), (1, 2), (2, 1)]
    batch = sync.sessions(e, "ts", "k", "10 minutes")
    assert sorted((r.k, r.n) for r in batch.collect()) == [(1, 1), (1, 2), (2, 1)]


# Images -------------------------------------------------------------------------------------------------------------------


def test_images():
    page_ = np.full((120, 200), 40, np.uint8)
    page_[10:110, 20:180] = 220
    assert images.parchment_frame(page_, 0) == (20, 10, 160, 100)
    labels, boxes = images.components(np.array([[1, 0, 1], [0, 1, 0], [0, 0, 0], [1, 1, 0]], bool))
    assert boxes.tolist() == [[0, 0, 3, 2, 3], [0, 3, 2, 1, 2]] and labels[0, 0] == labels[1, 1] == labels[0, 2]
    ink = np.full((60, 60), 200, np.uint8)
    ink[10:20, 10:14], ink[30:44, 30:34] = 20, 20
    assert images.ink_blobs(ink).tolist() == [[10, 10, 4, 10, 40], [30, 30, 4, 14, 56]]
    assert images.glyph_height(images.ink_blobs(ink)) == 14
    assert images.padded_tile(ink, (10, 10, 4, 10), 2).shape == (14, 14)
    shaded = np.clip(np.linspace(80, 240, 60)[None, :].repeat(60, 0), 0, 255).astype(np.uint8)
    assert images.flatten_illumination(shaded, 4.0).std() < shaded.std() / 2
    left, right = images.trim_gutter(np.hstack([np.full((20, 3), 10, np.uint8), np.full((20, 57), 200, np.uint8)]))
    assert (left, right) == (3, 60)


def test_image_rows(spark):
    d = spark.createDataFrame([(("o", 2, 2, 1, 0, bytearray([0, 255, 255, 255])),)], "image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>")
    assert images.map_images(d, lambda a: {"level": images.otsu(a)}, "origin string, level int").first().level == 0


def test_diff_queries_read_whole_turns(spark, tmp_path):
    from quire.plans import queries

    far, near, last = ("".join(chr(0x4E00 + k + i) for i in range(400)) for k in (0, 1000, 2000))
    before, after = f"{far}q{near}q{last}", f"{far}x{near}x{last}q"
    spark.createDataFrame([(1, 0, "user", before), (1, 1, "bot", after), (2, 0, "user", "alone")], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {(r.doc_id, r.kind, r.section, r.detail) for r in queries.diff_coverage(spark, str(tmp_path)).collect()}
    expected = {(1, "uncovered change", "s1", f"{a} -> {b} at {at}") for a, b, at in sequences.uncovered(before, after, [before[:40]], [after[:40]])}
    assert got == expected and len(expected) >= 2
    pairs = [(before[i:j], after[k:m]) for op, i, j, k, m in sequences.spans_of(before, after) if op == "replace" and j - i == m - k == 1]
    expected = {(1, a, b, pairs.count((a, b)), after.count(a)) for a, b in pairs if pairs.count((a, b)) >= 2 and a in after}
    assert expected and {(r.doc_id, r.old, r.new, r.instances, r.survivors) for r in queries.diff_sweeps(spark, str(tmp_path)).collect()} == expected


def test_folios_and_seams_of_queries(spark, tmp_path):
    from quire.plans import evidence_queries, queries

    spark.createDataFrame([(1, "http://a/7"), (2, "http://a/1234/5"), (3, "none"), (4, None)], "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    assert {r.page_id: r.folio for r in queries.page_id_regex(spark, str(tmp_path)).collect()} == {1: "f007r", 2: "f123r", 3: "f000r", 4: None}
    spark.createDataFrame([(1, 0, "user", "ab cd\n\nef"), (1, 1, "bot", "x")], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert {r.turn: r.rest for r in evidence_queries.seam_apply(spark, str(tmp_path)).collect()} == {0: "\n\nef", 1: None}


def page_image(height=900, width=700):
    rng = np.random.default_rng(0)
    return np.clip(rng.normal(220, 2, (height, width)), 0, 255).astype(np.uint8)


def write_lines(page, x, y, w, lines, level=40, step=24):
    for k in range(lines):
        for i in range(x, x + w - 10, 14):
            page[y + k * step : y + k * step + 13, i : i + 9] = level


def test_ink_masks_tell_ink_from_what_shows_through():
    page = page_image()
    write_lines(page, 100, 100, 300, 3)
    page[400:412, 100:108] = 150  # too light to be ink, dark enough to be a mark: the other side
    page[500:505, 100:130] = 185  # a faint low stroke
    page[600:700, 300:304] = 185  # a faint tall one: an overlay
    dark, light = images.ink_masks(page)
    assert dark[102, 103] and not dark[405, 104] and light[502, 110] and not light[650, 301] and not dark[502, 110]
    gray = np.tile(np.linspace(120, 230, 700), (900, 1)).astype(np.uint8)
    assert not images.marks(gray)[50:-50, 50:-50].any()  # a gradient is no mark


def test_regions_of_planted_pages():
    assert images.regions(page_image())["route"] == "blank"
    assert images.regions(page_image(900, 200))["route"] == "blank" and images.regions(page_image(900, 200))["regions"] == []
    page = page_image()
    write_lines(page, 150, 150, 400, 9)
    write_lines(page, 60, 700, 60, 2)
    page[:, :4] = 30  # a binding line
    got = images.regions(page)
    assert [r["kind"] for r in got["regions"]] == ["main_text", "marginalia"] and got["route"] == "full_page"
    x, y, w, h = got["regions"][0]["bbox"]
    assert abs(x - 150) < 30 and abs(y - 150) < 30 and abs(w - 390) < 70 and abs(h - 205) < 70 and got["glyph_height_px"] == 13.0
    dense = page_image(1500, 1000)
    write_lines(dense, 150, 100, 700, 55)
    got = images.regions(dense)
    assert got["route"] == "segmented" and len(got["regions"]) >= 3 and all(r["est_lines"] <= 20 for r in got["regions"])
    big = np.kron(page, np.ones((3, 3), np.uint8))
    small, large = images.regions(page), images.regions(big)
    assert [r["kind"] for r in large["regions"]] == [r["kind"] for r in small["regions"]]
    assert all(abs(a - 3 * b) < 40 for r, q in zip(large["regions"], small["regions"], strict=True) for a, b in zip(r["bbox"], q["bbox"], strict=True))
    yy, xx = np.mgrid[:900, :700]
    page = page_image()
    page[np.abs(np.hypot(xx - 350, yy - 600) - 120) < 2.5] = 40
    write_lines(page, 300, 590, 80, 1)
    write_lines(page, 150, 150, 400, 5)
    kinds = {r["kind"]: r for r in images.regions(page)["regions"]}
    assert set(kinds) == {"main_text", "figure"} or set(kinds) == {"block", "figure"}
    x, y, w, h = kinds["figure"]["bbox"]
    assert abs(x - 228) < 6 and abs(y - 478) < 6 and abs(w - 245) < 8 and abs(h - 245) < 8


def test_prefix_sums_over_ranges(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.uniform(0, 3)) for i in range(400)]
    d = spark.createDataFrame(rows, "k long, c double").repartition(7)
    total, expected = 0.0, []
    for k, c in rows:
        if total < 100:
            expected.append(k)
        total += c
    assert sorted(r.k for r in ledger.cost_prefix(d, ["k"], "c", 100.0).collect()) == expected
    unknown = d.withColumn("c", F.when(F.col("k") != 9, F.col("c")))
    assert sorted(r.k for r in ledger.cost_prefix(unknown, ["k"], "c", 100.0).collect()) == list(range(10))
    assert ledger.cost_prefix(d.limit(0), ["k"], "c", 1.0).count() == 0


def test_closure_has_no_depth(spark):
    chain = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(70)] + [("n3", "n1"), ("z", "y")], "src string, dst string")
    assert line.closure(chain, ["n0"]).count() == 71 and line.closure(chain, ["nowhere"]).count() == 1


def test_code_identity(tmp_path):
    s = line.Station("read", ("image",), "text", run=page_image)
    other = tmp_path / "x.txt"
    other.write_text("1")
    a, b = s.code, line.Station("read", ("image",), "text", run=page_image, sources=(str(other),)).code
    other.write_text("2")
    c = line.Station("read", ("image",), "text", run=page_image, sources=(str(other),)).code
    assert len({a, b, c}) == 3 and a == line.Station("read", ("image",), "text", run=page_image).code and len(a) == 16
    assert a != line.Station("read", ("image",), "text", variant="v", run=page_image).code != line.Station("read", ("image",), "text").code


def test_snapshots(tmp_path):
    root = tmp_path / "lib"
    (root / "a/.x").mkdir(parents=True)
    (root / ".gateway-locks").mkdir()
    for name, data in (("a/one.json", b"1"), ("a/.x/two", b"\0" * 3_000_000), ("db-wal", b"w"), ("y.lock", b""), (".gateway-locks/p", b"")):
        (root / name).write_bytes(data)
    z = tmp_path / "s.zip"
    assert sinks.create_snapshot(str(root), str(z)) == {"files": 2, "payload_bytes": 3_000_001} == sinks.verify_snapshot(str(z))
    assert sinks.restore_snapshot(str(z), str(tmp_path / "new"))["files"] == 2 and (tmp_path / "new/a/.x/two").read_bytes() == b"\0" * 3_000_000
    for bad in (lambda: sinks.create_snapshot(str(root), str(z)), lambda: sinks.create_snapshot(str(root), str(root / "in.zip")), lambda: sinks.restore_snapshot(str(z), str(tmp_path / "new")), lambda: sinks.verify_snapshot(str(root / "a/one.json"))):
        with pytest.raises(sinks.SnapshotError):
            bad()
    import zipfile

    with zipfile.ZipFile(z, "a") as more:
        more.writestr("extra", "x")
    with pytest.raises(sinks.SnapshotError):
        sinks.verify_snapshot(str(z))
    assert "r00 block" in sinks.preview_html("t & t", [{"page_id": "p", "route": "segmented", "width": 10, "height": 20, "regions": [{"region_id": "r00", "kind": "block", "bbox": [1, 2, 3, 4]}]}])


def test_put_file_replaces_in_one_step(tmp_path):
    uri = f"file://{tmp_path}/d/x.json"
    sinks.put_json(uri, {"b": "é", "a": 1})
    sinks.put_json(uri, {"a": 2})
    assert (tmp_path / "d/x.json").read_text() == '{\n  "a": 2\n}\n' and [p.name for p in (tmp_path / "d").iterdir()] == ["x.json"]


def hold(folder, seconds, out):
    import time

    from quire.plans.gateway import FilePermits

    with FilePermits(folder, {"p": 1}).lease("p/model", 30):
        out.put("in")
        time.sleep(seconds)


def test_permits_across_processes(tmp_path):
    import multiprocessing
    import time

    from quire.plans.gateway import FilePermits

    ctx = multiprocessing.get_context("spawn")
    out = ctx.Queue()
    other = ctx.Process(target=hold, args=(str(tmp_path), 1.5, out))
    other.start()
    out.get(timeout=60)
    permits = FilePermits(str(tmp_path), {"p": 1})
    with pytest.raises(TimeoutError), permits.lease("P", 0.2):
        pass
    began = time.time()
    with permits.lease("p", 30):
        assert time.time() - began > 0.3
    with permits.lease("other", 1), permits.lease("other", 1):
        pass
    other.join()


def test_commands(spark, tmp_path, capsys, monkeypatch):
    from quire import cli

    monkeypatch.setattr("quire.session.session", lambda *a, **k: spark)
    source = tmp_path / "s.jsonl"
    source.write_text("".join(json.dumps({"source_key": f"k{i}", "record": {"manifest_url": f"u{i}", "access": "open"}}) + "\n" for i in range(5)))
    said = lambda *args: (cli.main(list(args)), [json.loads(x) for x in capsys.readouterr().out.splitlines()])
    root = str(tmp_path / "catalog")
    assert said("catalog", "sync", root, "s", str(source), "--size", "2") == (0, [{"sync_id": 1, "pages": 3, "tombstoned": 0}])
    assert said("catalog", "stats", root)[1] == [{"sources": 1, "records": 5, "active": 5, "tombstoned": 0}]
    assert [r["source_key"] for r in said("survey", "select", root, "s", "--after", "k2")[1]] == ["k3", "k4"]
    record = said("catalog", "records", root, "s", "--limit", "1")[1][0]["record_id"]
    assert said("catalog", "record", root, record)[1][0]["source_key"] == "k0"
    (tmp_path / "lib").mkdir()
    (tmp_path / "lib/x").write_text("x")
    assert said("snapshot", "create", str(tmp_path / "lib"), str(tmp_path / "z.zip"))[1] == [{"files": 1, "payload_bytes": 1}]
    with pytest.raises(SystemExit):
        cli.main(["nothing"])
