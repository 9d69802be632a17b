"""The command surface, as JSON lines: queries, the catalog, selection, orders and runs, snapshots and the graph.

python -m quire.cli COMMAND ... ; a line's recipes and stations come from --line MODULE:FUNCTION, which makes a Workshop of (spark, root).
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quire")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("queries", help="names of all queries")
    q = sub.add_parser("query", help="run a query")
    q.add_argument("name")
    q.add_argument("sf_dir")
    q.add_argument("--limit", type=int, default=20)

    c = sub.add_parser("catalog", help="the source catalog").add_subparsers(dest="action", required=True)
    for name in ("stats", "records", "record", "sync"):
        a = c.add_parser(name)
        a.add_argument("root")
        if name in ("records", "sync"):
            a.add_argument("source")
        if name == "records":
            a.add_argument("--limit", type=int, default=100)
        if name == "record":
            a.add_argument("record_id")
        if name == "sync":
            a.add_argument("path", help="JSON lines of source records")
            a.add_argument("--size", type=int, default=100)

    s = sub.add_parser("survey", help="selection").add_subparsers(dest="action", required=True)
    a = s.add_parser("select", help="records to choose from")
    a.add_argument("root")
    a.add_argument("source")
    a.add_argument("--after")
    a = s.add_parser("filter", help="evaluations (Parquet) by a rule file, best first")
    a.add_argument("evaluations")
    a.add_argument("rules")
    a.add_argument("--keep", type=int, default=0)

    for name in ("adopt", "switch", "park", "run", "status", "history", "drift", "graph"):
        a = sub.add_parser(name)
        a.add_argument("--line", required=True)
        if name != "graph":
            a.add_argument("--root", required=True)
        if name in ("adopt", "switch", "park", "run", "history"):
            a.add_argument("--doc-id", action="append", required=True)
        if name in ("adopt", "switch"):
            a.add_argument("--recipe", required=True)
        if name == "run":
            a.add_argument("--page", action="append", default=[])
            a.add_argument("--through")
            a.add_argument("--refresh", action="append", default=[])

    f = sub.add_parser("snapshot", help="archives of a library").add_subparsers(dest="action", required=True)
    for name, args in (("create", ("root", "archive")), ("verify", ("archive",)), ("restore", ("archive", "root"))):
        a = f.add_parser(name)
        for x in args:
            a.add_argument(x)
    return p


def _snapshot(args: argparse.Namespace) -> int:
    from quire.sources import sinks

    call = {"create": lambda: sinks.create_snapshot(args.root, args.archive), "verify": lambda: sinks.verify_snapshot(args.archive), "restore": lambda: sinks.restore_snapshot(args.archive, args.root)}
    print(json.dumps(call[args.action]()))
    return 0


def _catalog(spark, args: argparse.Namespace):
    from pyspark.sql import functions as F

    from quire.operators import catalog
    from quire.sources import files
    from quire.streaming.sync import CatalogTables

    tables = CatalogTables(spark, args.root)
    records, revisions = tables.records(), tables.log("revisions", catalog.REVISIONS)
    if args.command == "survey":
        return catalog.selection(records, revisions, args.source, args.after)
    if args.action == "stats":
        return catalog.stats(records)
    if args.action == "records":
        return catalog.records_of(records, revisions, args.source, args.limit)
    if args.action == "record":
        return [catalog.record(records, revisions, args.record_id).asDict()]
    rows = files.envelopes(files.read_jsonl(spark, args.path))
    bad = rows.where("size(problems) > 0").orderBy("line_number").first()
    if bad is not None:
        raise ValueError(f"line {bad.line_number}: {', '.join(bad.problems)}")

    def pages(cursor: str | None):
        rest = files.pages(rows, int(cursor) if cursor else None, args.size).persist()
        for p in rest.groupBy("page").agg(F.max("line_number").alias("last")).orderBy("page").collect():  # one row a page of the file
            yield str(p["last"]), rest.where(F.col("page") == p["page"]).select("source_key", "source_url", "source_modified_at", F.col("record").alias("normalized_json"), F.col("raw").alias("raw_json"))

    return [tables.sync(args.source, pages)]


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    if args.command == "snapshot":
        return _snapshot(args)
    from quire.plans import queries, registry  # noqa: F401
    from quire.session import session

    if args.command == "queries":
        print("\n".join(sorted(registry.QUERIES)))
        return 0
    spark, code = session("cli"), 0
    if args.command == "query":
        out = registry.QUERIES[args.name](spark, args.sf_dir).limit(args.limit)
    elif args.command == "catalog" or args.command == "survey" and args.action == "select":
        out = _catalog(spark, args)
    elif args.command == "survey":
        from quire.operators import survey

        with open(args.rules, encoding="utf-8") as f:
            out = survey.ranked(spark.read.parquet(args.evaluations), json.load(f), keep=args.keep)
    else:
        module, _, name = args.line.partition(":")
        shop = getattr(importlib.import_module(module), name)(spark, getattr(args, "root", "/"))
        if args.command == "graph":
            print(shop.registry.mermaid())
            return 0
        if args.command == "run":
            out = shop.run(args.doc_id, tuple(args.page), args.through, frozenset(args.refresh))
            code = int(not out.where("action = 'failed'").isEmpty())
        elif args.command in ("status", "drift"):
            out = getattr(shop, args.command)()
        elif args.command == "history":
            out = shop.history(args.doc_id[0])
        else:
            for d in args.doc_id:
                getattr(shop, args.command)(d, *([args.recipe] if args.command != "park" else []))
            out = shop.status()
    rows = out if isinstance(out, list) else (json.loads(r) for r in out.toJSON().toLocalIterator())
    for row in rows:
        print(json.dumps(row, ensure_ascii=False, default=str))
    sys.stdout.flush()
    return code


if __name__ == "__main__":
    raise SystemExit(main())
