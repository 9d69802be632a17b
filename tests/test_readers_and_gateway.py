import hashlib
import json

import pytest
from pyspark.sql import functions as F

from quire import cli
from quire.operators import readers
from quire.plans import gateway
from quire.sources import archives


def test_consensus(spark):
    rows = [("d", "1", "a", "m1", "x y", None), ("d", "1", "b", "m2", "xy\n", None), ("d", "2", "a", "m1", "x", None), ("d", "2", "b", "m2", "z", None), ("d", "3", "a", "m1", None, "boom"), ("d", "3", "b", "m2", "q", None), ("d", "4", "a", "m1", "q", None)]
    d = spark.createDataFrame(rows, "doc_id string, page_id string, role string, model string, text string, error string")
    got = {r.page_id: (r.status, r.candidates) for r in readers.consensus(d).collect()}
    assert {k: v[0] for k, v in got.items()} == {"1": "agreement", "2": "adjudicate", "3": "failed", "4": "not_needed"}
    assert got["2"][1] == ["x", "z"]


def test_sensors(spark):
    labels = [[("a", 0.9), ("x", 0.9), ("c", 0.01)], [("q", 0.2)]]
    d = spark.createDataFrame([("d", "1", "ab c\nq", [3, 2], labels), ("d", "2", "ab", None, None), ("d", "3", "", [], None)], "doc_id string, page_id string, text string, box_counts array<int>, labels array<array<struct<label:string,confidence:double>>>")
    rows = {(r.page_id, r.line): (r.characters, r.boxes, r.count_mismatch, r.disputes) for r in readers.line_sensors(d).collect()}
    assert rows == {("1", 0): (3, 3, False, 2), ("1", 1): (1, 2, True, 0), ("2", 0): (2, None, False, 0)}
    flags = readers.page_flags(readers.line_sensors(d)).where("page_id = '1'").first()
    assert (flags.count_mismatches, flags.disputes) == (1, 2)
    assert spark.range(1).select(readers.changed_lines(F.lit("a\nb\nc"), F.lit("a\nx"))).first()[0] == 1


def test_fallback_keeps_empty_apart_from_missing(spark):
    pages = spark.createDataFrame([("d", "1"), ("d", "2"), ("e", "1")], "doc_id string, page_id string")
    cases = spark.createDataFrame([("d__1", []), ("d", [7])], "case_id string, boxes array<int>")
    got = readers.with_fallback(pages, cases, F.concat_ws("__", "doc_id", "page_id"), F.col("doc_id"), "boxes")
    assert {(r.doc_id, r.page_id): r.boxes for r in got.collect()} == {("d", "1"): [], ("d", "2"): [7], ("e", "1"): None}


def test_usage_of_logs(spark):
    lines = [
        ("s", 1, '{"type":"message_end","message":{"role":"assistant","usage":{"input":10,"output":5,"cacheRead":2,"cost":{"total":0.5}}}}'),
        ("s", 2, "not json"),
        ("s", 3, '{"type":"tool_call"}'),
        ("s", 4, '{"type":"message_end","message":{"role":"assistant","n":2,"usage":{"input":1,"output":1,"cost":{"total":0.25}}}}'),
        ("t", 1, '{"usage":{"input_tokens":3,"output_tokens":4}}'),
        ("u", 1, '{"type":"x"}'),
    ]
    d = spark.createDataFrame(lines, "session_id string, line_number int, line string")
    got = {r.session_id: (r.tokens, r.cost_usd, r.turns, r.tool_calls) for r in readers.session_usage(d).collect()}
    assert got == {"s": (17, 0.75, 2, 1), "t": (7, None, 0, 0), "u": (0, None, 0, 0)}
    last = readers.last_message(d).first()
    assert json.loads(last.message)["n"] == 2 and last.prompt_tokens == 1


def test_tuning_and_tails(spark):
    pages = spark.createDataFrame([("d", "1", "blank"), ("d", "2", "segmented"), ("d", "3", "blank")], "doc_id string, page_id string, route string")
    regions = spark.createDataFrame([("d", "2", "text", 3), ("d", "2", "figure", 0)], "doc_id string, page_id string, kind string, est_lines int")
    refs = spark.createDataFrame([("1", 900), ("2", 50)], "page_id string, length int")
    assert {r.page_id: r.verdict for r in readers.tuning(pages, regions, refs).collect()} == {"1": "missed text", "2": "perhaps blank", "3": "no reference"}
    p = spark.createDataFrame([("d", 1, "a\n\nb\nc", 0), ("d", 2, "x", 2)], "doc_id string, order int, text string, seam_lines int")
    assert {r.order: r.previous_tail for r in readers.previous_tail(p).collect()} == {1: None, 2: ["b", "c"]}


def test_gateway():
    waits, answers = [], iter([gateway.TransientError(), gateway.TransientError(), gateway.Answer("ok")])

    def call(prompt):
        a = next(answers)
        if isinstance(a, Exception):
            raise a
        return a

    assert gateway.generate(call, "p", sleep=waits.append).text == "ok" and waits == [2.0, 4.0]
    with pytest.raises(gateway.Truncated):
        gateway.generate(lambda p: gateway.Answer("x", finish="LENGTH"), "p")
    texts = iter(['{"a": 1}', '```json\n{"b": 2}\n``` tail'])
    value, used = gateway.generate_json(lambda p: gateway.Answer(next(texts), 3, 0.5), "p", lambda v: [] if "b" in v else ["b is missing"])
    assert value == {"b": 2} and (used.tokens, used.cost_usd) == (6, 1.0)
    with pytest.raises(ValueError):
        gateway.generate_json(lambda p: gateway.Answer("none"), "p", lambda v: [])
    permits = gateway.Permits({"x": 1})
    with permits.lease("x"), pytest.raises(TimeoutError), permits.lease("x", wait=0.01):
        pass


def echo(cell):
    return {"station": cell["station"]}


def test_executors(monkeypatch):
    cell = gateway.Cell("d", "read", prompt="p", prompt_sha256=hashlib.sha256(b"p").hexdigest())
    assert gateway.InlineExecutor(lambda c: {"x": c.station}).execute(cell)["value"] == {"x": "read"}
    assert gateway.InlineExecutor(lambda c: 1 / 0).execute(cell)["error"].startswith("ZeroDivisionError")
    with pytest.raises(ValueError):
        gateway.InlineExecutor(lambda c: {}).execute(gateway.Cell("d", "read", prompt="q", prompt_sha256="0"))
    monkeypatch.setenv("QUIRE_CELL", "tests.test_readers_and_gateway:echo")
    assert gateway.SubprocessExecutor().execute(cell)["value"] == {"station": "read"}
    monkeypatch.delenv("QUIRE_CELL")
    assert not gateway.SubprocessExecutor().execute(cell)["ok"]


def test_archives(spark):
    item = {"item": {"title": ["", {"en": " T "}], "contributors": [{"A B": "x"}]}, "resources": [{"files": [[{"url": "http://a/1.jpg", "mimetype": "image/jpeg", "width": 2, "height": 2}, {"url": "http://a/2.png", "mimetype": "image/png", "width": 9, "height": 9}], [{"url": "http://a/x.txt", "mimetype": "text/plain"}]]}]}
    m = archives.manifest_of_item(item)
    assert m["label"] == "T" and [c["images"][0]["resource"]["@id"] for c in m["sequences"][0]["canvases"]] == ["http://a/2.png"]
    with pytest.raises(ValueError):
        archives.manifest_of_item({"resources": []})
    waits = []
    assert archives.fetch_manifest(lambda u: (403, None) if u == "a" else (200, item), "a", lambda u: "b")["label"] == "T"
    with pytest.raises(OSError):
        archives.fetch_manifest(lambda u: (500, None), "a", lambda u: None, sleep=waits.append)
    assert waits == [5.0, 10.0]
    d = spark.createDataFrame([('{"@value": "x", "a": "y"}',), ('[[], {"de": ["", "z"]}]',), ("plain ",), (None,)], "v string")
    assert [r[0] for r in d.select(archives.first_text_of_json("v")).collect()] == ["x", "z", "plain", None]


def test_cli(capsys):
    assert cli.main(["queries"]) == 0
    assert "stage_state_latest" in capsys.readouterr().out
    assert cli.build_parser().parse_args(["catalog", "records", "r", "s"]).limit == 100
