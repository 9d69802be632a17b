"""A line of eight page stations and seven manuscript stations over two pages: what runs, what is fresh, what fails and what resumes."""

import json
import os

import pytest
from pyspark.sql import functions as F

from quire.plans import conductor, line

PAGE = [f"p{i}" for i in range(8)]
BOOK = [f"m{i}" for i in range(7)]
KINDS = {"metadata": "manuscript", "page_list": "manuscript"} | {f"k_{n}": "page" for n in PAGE} | {f"k_{n}": "manuscript" for n in BOOK}


def page_run(job):
    if job["page"].get("url") == "bad" and job["options"].get("fails"):
        raise conductor.CellError("no such image", "fetch", 0.5)
    return {"text": job["page_id"] + "".join(sorted(x.get("text", "") for x in job["inputs"].values())), "prompt": job["prompt"], "usage": {"tokens_in": 2, "tokens_out": 1, "cost_usd": 0.25}}


def book_run(job):
    first = job["inputs"].get("k_p7") or {}
    return {"pages": len(job["pages"]), "texts": [first[p["page_id"]]["text"] for p in job["pages"] if p["page_id"] in first]}


def workshop(spark, root, prompt="read it", fails=True):
    page = [line.Station(n, ("page_list",) if i == 0 else (f"k_{PAGE[i - 1]}",), f"k_{n}", run=page_run, model=i == 1, options=("fails",)) for i, n in enumerate(PAGE)]
    book = [line.Station(n, ("k_p7",) if i == 0 else (f"k_{BOOK[i - 1]}", "k_p7"), f"k_{n}", "manuscript", optional=("metadata",), run=book_run) for i, n in enumerate(BOOK)]
    steps = [line.Step(n, model="m" if i == 1 else None, prompt="read" if i == 1 else None, options=(("fails", fails),) if i == 2 else ()) for i, n in enumerate(PAGE)] + [line.Step(n) for n in BOOK]
    registry = conductor.registry_of(KINDS, page + book)
    recipe = line.Recipe("whole", tuple(steps))
    assert not line.chain_problems(recipe, registry)
    return conductor.Workshop(spark, str(root), registry, {"whole": recipe}, {"read": prompt}, workers=2, model_workers=1)


def add(root, doc, urls):
    os.makedirs(root / "library" / doc, exist_ok=True)
    pages = [{"page_id": f"f{i}", "order": -i if doc == "back" else i, "url": u} for i, u in enumerate(urls)]
    (root / "library" / doc / "page_list.json").write_text(json.dumps({"doc_id": doc, "pages": pages}))


def counts(report):
    return {r.action: r["count"] for r in report.groupBy("action").count().collect()}


def test_a_line_runs_once_and_resumes(spark, tmp_path):
    add(tmp_path, "one", ["a", "b"])
    w = workshop(spark, tmp_path)
    with pytest.raises(KeyError):
        w.run(["one"])
    w.adopt("one", "whole")
    assert counts(w.run(["one"], through="p2")) == {"ran": 6}
    assert w.orders().first().status == "active"
    first = w.run(["one"])
    assert counts(first) == {"fresh": 6, "ran": 17} and first.count() == 23
    assert first.where("action = 'ran' and page_id is not null").agg(F.sum("cost_usd")).first()[0] == 2.5
    again = w.run(["one"])
    assert counts(again) == {"fresh": 23}
    assert (w.orders().first().status, [r.status for r in w.work().collect()]) == ("complete", ["done"] * 3)
    book = json.loads((tmp_path / "library/one/k_m6.json").read_text())
    assert book["pages"] == 2 and book["provenance"]["station"] == "m6" and len(book["provenance"]["input_fingerprint"]) == 16

    # An output that was changed is made again, and so is what its content reaches; a lost log is recovered from stamps.
    path = tmp_path / "library/one/k_p7/f1.json"
    old = json.loads(path.read_text())
    path.write_text(json.dumps(old | {"text": "other"}))
    assert counts(w.run(["one"])) == {"fresh": 22, "ran": 1}
    import shutil

    shutil.rmtree(tmp_path / "log/cells")
    assert counts(w.run(["one"], through="p0")) == {"recovered": 2}
    # Another prompt makes its cells outdated, which does not run them; refreshing does.
    other = workshop(spark, tmp_path, "read it well")
    got = other.run(["one"], through="p1")
    assert {(r.station, r.action) for r in got.collect()} == {("p0", "fresh"), ("p1", "ran")}
    assert counts(other.run(["one"], through="p1", refresh=frozenset({"p1"}))) == {"fresh": 2, "ran": 2}
    assert counts(w.run(["one"], through="p1")) == {"fresh": 2, "outdated": 2}
    assert {(r.station, r.status) for r in w.drift().where("station in ('p0', 'p1')").collect()} == {("p0", "current"), ("p1", "outdated")}


def test_failures_claims_and_orders(spark, tmp_path, monkeypatch):
    add(tmp_path, "good", ["a", "b"])
    add(tmp_path, "back", ["a", "bad"])
    w = workshop(spark, tmp_path)
    for d in ("good", "back"):
        w.adopt(d, "whole")
    report = w.run(["good", "back"], through="m0")
    got = {(r.doc_id, r.station, r.page_id): (r.action, r.cost_usd) for r in report.collect()}
    assert got["back", "p2", "f1"] == ("failed", 0.5) and ("back", "p3", "f1") not in got and got["back", "p3", "f0"][0] == "ran"
    assert ("back", "m0", None) not in got and got["good", "m0", None][0] == "ran"
    assert {r.doc_id: r.status for r in w.orders().collect()} == {"good": "active", "back": "failed"}
    assert w.cells().where("status = 'failed:fetch'").count() == 1
    # What failed runs on once its reason is gone; the rest is fresh.
    healed = workshop(spark, tmp_path, fails=False).run(["back"], through="p3")
    assert {(r.station, r.page_id): r.action for r in healed.collect()}["p3", "f1"] == "ran"

    runs = w.claim(["good"], "other:1")
    with pytest.raises(RuntimeError, match="other:1"):
        w.run(["good"])
    with pytest.raises(RuntimeError):
        w.park("good")
    monkeypatch.setattr(conductor, "LEASE_SECONDS", -1)
    assert counts(w.run(["good"], through="p0")) == {"fresh": 2}
    assert w.work().where(F.col("work_run_id") == runs["good"]).first().status == "abandoned"
    w.park("good")
    assert {r.doc_id: (r.status, r.running) for r in w.status().collect()}["good"] == ("parked", False)
    w.switch("good", "whole")
    assert [r.event for r in w.history("good").collect()] == ["adopted", "switched_recipe"]
    for bad in (lambda: w.adopt("good", "whole"), lambda: w.run(["good"], pages=("nope",)), lambda: w.run(["good"], through="nope"), lambda: w.run(["good"], pages=("f0",), through="m0")):
        with pytest.raises(ValueError):
            bad()
    assert counts(w.run(["good"], pages=("f1",))) == {"fresh": 8}
