"""Sinks: typed artifact tables with provenance stamps, snapshots with manifests, and EPUB and HTML files of finished books."""

from __future__ import annotations

import hashlib
import html
import io
import json
import os
import shutil
import uuid
import zipfile
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.contracts import payload_problems


def put_file(uri: str, data: bytes) -> None:
    """Writes a file in one step: under a name of its own first, then renamed, so that a lost or repeated task leaves no half file."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    folder, _, name = path.rpartition("/")
    store.create_dir(folder, recursive=True)
    temporary = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
    try:
        with store.open_output_stream(temporary, compression=None) as out:
            out.write(data)
        if store.get_file_info(path).type != fs.FileType.NotFound:
            store.delete_file(path)  # some stores do not rename onto a file
        store.move(temporary, path)
    except BaseException:
        if store.get_file_info(temporary).type != fs.FileType.NotFound:
            store.delete_file(temporary)
        raise


def put_json(uri: str, value: Any) -> None:
    """A JSON file in one step: two spaces of indent, characters as they are, a line end behind it."""
    put_file(uri, (json.dumps(value, ensure_ascii=False, indent=2) + "\n").encode())


def stamp(station: Column, fingerprint: Column, model: Column | None = None, prompt: Column | None = None, tokens_in: Column | None = None, tokens_out: Column | None = None, cost: Column | None = None) -> Column:
    """A provenance stamp in JSON: what is not known is left out; output tokens only together with input tokens."""
    none = F.lit(None).cast("string")
    tin = tokens_in if tokens_in is not None else none
    fields = {"station": station, "fingerprint": fingerprint, "model": model, "prompt": prompt, "tokens_in": tin, "tokens_out": F.when(tin.isNotNull(), tokens_out if tokens_out is not None else none), "cost_usd": cost}
    return F.to_json(F.struct(*[(v if v is not None else none).alias(k) for k, v in fields.items()]))


def write_artifacts(rows: DataFrame, root: str, required: Mapping[str, Sequence[str]]) -> None:
    """rows (kind, doc_id, page_id, payload, provenance) as a table cut by kind and document; refuses payloads that break their contract.

    A kind that is not in required is binary: its payload must be null.
    """
    problems = F.lit(None).cast("array<string>")
    for kind, keys in required.items():
        problems = F.when(F.col("kind") == kind, payload_problems(F.col("payload"), list(keys), F.col("doc_id"))).otherwise(problems)
    known = F.col("kind").isin(*required)
    bad = rows.select("kind", "doc_id", "page_id", F.when(known, problems).when(F.col("payload").isNotNull(), F.array(F.lit("a binary kind has a payload"))).alias("problems")).where("size(problems) > 0")
    first = bad.first()
    if first is not None:
        raise ValueError(f"{first.kind} of {first.doc_id}: {', '.join(first.problems)}")
    rows.repartition("kind", "doc_id").write.mode("overwrite").partitionBy("kind", "doc_id").option("partitionOverwriteMode", "dynamic").parquet(root)


def snapshot_manifest(files: DataFrame) -> DataFrame:
    """(path, bytes, sha256) of binaryFile rows that belong in a snapshot: no locks, journals or shared-memory files."""
    kept = files.where(~F.col("path").rlike(r"/\.gateway-locks/|(-shm|-wal|-journal|\.lock)$"))
    return kept.select("path", F.length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256")).orderBy("path")


def snapshot_problems(manifest: DataFrame, members: DataFrame) -> DataFrame:
    """(path, problem): members and manifest must be the same set with equal sizes and digests, and safe paths."""
    m = members.select("path", F.col("bytes").alias("b"), F.col("sha256").alias("s"))
    j = manifest.join(m, "path", "full")
    problem = F.when(F.col("s").isNull(), "missing").when(F.col("sha256").isNull(), "extra").when((F.col("b") != F.col("bytes")) | (F.col("s") != F.col("sha256")), "changed").when(F.col("path").rlike(r"(^|/)\.\.(/|$)|^/"), "unsafe")
    return j.select("path", problem.alias("problem")).where("problem is not null")


class SnapshotError(Exception):
    """A snapshot that cannot be made, or does not hold."""


def _digest(file: Any) -> tuple[int, str]:
    """Size and sha256 of an open file, in parts."""
    h, n = hashlib.sha256(), 0
    while part := file.read(1 << 20):
        h.update(part)
        n += len(part)
    return n, h.hexdigest()


def create_snapshot(root: str, archive: str) -> dict[str, Any]:
    """All files below a local root but locks and journals as one ZIP with a manifest, in one step; then verified.

    A snapshot is one file by nature, so the driver writes it, in parts of bounded size.
    """
    root, archive = os.path.realpath(root), os.path.realpath(archive)
    if not os.path.isdir(root) or os.path.exists(archive) or os.path.commonpath([root, archive]) == root:
        raise SnapshotError("the root must be a folder, and the archive a new file outside it")
    paths = sorted(os.path.relpath(os.path.join(d, f), root).replace(os.sep, "/") for d, _, files in os.walk(root) for f in files)
    paths = [p for p in paths if not p.startswith(".gateway-locks/") and not p.endswith(("-shm", "-wal", "-journal", ".lock"))]
    temporary, records = f"{archive}.{uuid.uuid4().hex}.tmp", []
    try:
        with zipfile.ZipFile(temporary, "w") as z:
            for p in paths:
                with open(os.path.join(root, p), "rb") as source:
                    size, sha = _digest(source)
                    source.seek(0)
                    with z.open(zipfile.ZipInfo(p), "w", force_zip64=True) as member:
                        shutil.copyfileobj(source, member, 1 << 20)
                records.append({"path": p, "bytes": size, "sha256": sha})
            z.writestr("snapshot.json", json.dumps({"schema_version": 1, "files": records}, sort_keys=True))
        os.replace(temporary, archive)
    finally:
        if os.path.exists(temporary):
            os.remove(temporary)
    return verify_snapshot(archive)


def verify_snapshot(archive: str) -> dict[str, Any]:
    """Files and bytes of a snapshot whose members are exactly those of its manifest, with equal sizes and digests."""
    try:
        z = zipfile.ZipFile(archive)
    except (zipfile.BadZipFile, OSError) as e:
        raise SnapshotError(str(e)) from e
    with z:
        names = z.namelist()
        unsafe = [n for n in names if n.startswith("/") or "\\" in n or ".." in n.split("/") or n.endswith("/")]
        if len(set(names)) < len(names) or unsafe or "snapshot.json" not in names:
            raise SnapshotError("members repeat, are unsafe or lack the manifest")
        records = json.loads(z.read("snapshot.json"))["files"]
        if {r["path"] for r in records} | {"snapshot.json"} != set(names) or len(records) + 1 != len(names):
            raise SnapshotError("members and manifest differ")
        for r in records:
            with z.open(r["path"]) as member:
                if _digest(member) != (r["bytes"], r["sha256"]):
                    raise SnapshotError(f"{r['path']} has changed")
    return {"files": len(records), "payload_bytes": sum(r["bytes"] for r in records)}


def restore_snapshot(archive: str, root: str) -> dict[str, Any]:
    """A verified snapshot's files below a new root, which appears in one step."""
    found, root = verify_snapshot(archive), os.path.realpath(root)
    if os.path.exists(root):
        raise SnapshotError(f"{root} is there already")
    staged = f"{root}.{uuid.uuid4().hex}.tmp"
    try:
        os.makedirs(staged)
        with zipfile.ZipFile(archive) as z:
            for r in json.loads(z.read("snapshot.json"))["files"]:
                path = os.path.join(staged, *r["path"].split("/"))
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with z.open(r["path"]) as member, open(path, "wb") as out:
                    shutil.copyfileobj(member, out, 1 << 20)
                with open(path, "rb") as out:
                    if _digest(out) != (r["bytes"], r["sha256"]):
                        raise SnapshotError(f"{r['path']} was not restored")
        os.replace(staged, root)
    finally:
        if os.path.exists(staged):
            shutil.rmtree(staged)
    return found


def preview_html(title: str, pages: Sequence[Mapping[str, Any]]) -> str:
    """A page of outlines: each page's size with its regions as labelled boxes (page_id, route, width, height, regions)."""
    colours, parts = {"main_text": "#2a6", "block": "#26a", "marginalia": "#a62", "figure": "#a26"}, []
    for p in pages:
        boxes = "".join(
            f'<rect x="{x}" y="{y}" width="{w}" height="{h}" fill="none" stroke="{colours.get(r["kind"], "#888")}" stroke-width="4"/><text x="{x + 6}" y="{y + 24}" font-size="22">{html.escape(r["region_id"])} {html.escape(r["kind"])}</text>'
            for r in p["regions"]
            for x, y, w, h in [r["bbox"]]
        )
        parts.append(f'<figure><figcaption>{html.escape(p["page_id"])}: {html.escape(p["route"])}, {len(p["regions"])} regions</figcaption><svg viewBox="0 0 {p["width"]} {p["height"]}" width="420">{boxes}</svg></figure>')
    return _page(title, f"<h1>{html.escape(title)}</h1>" + "".join(parts))


def _page(title: str, body: str) -> str:
    return f'<?xml version="1.0" encoding="utf-8"?>\n<html xmlns="http://www.w3.org/1999/xhtml"><head><title>{html.escape(title)}</title></head><body>{body}</body></html>'


def paragraphs_html(text: str) -> str:
    """Paragraphs between blank lines, escaped, with line breaks kept."""
    parts = [p.strip() for p in text.replace("\r\n", "\n").split("\n\n")]
    return "".join("<p>" + html.escape(p).replace("\n", "<br/>") + "</p>" for p in parts if p)


def epub(title: str, language: str, sections: Sequence[tuple[str, str]], apparatus: Sequence[str] = (), colophon: str = "") -> bytes:
    """An EPUB 3 of a book: a title page, a chapter a section, the apparatus and the colophon."""
    pages = [("title", _page(title, f"<h1>{html.escape(title)}</h1>"))]
    pages += [(f"s{i}", _page(head, f"<h2>{html.escape(head)}</h2>" + paragraphs_html(text))) for i, (head, text) in enumerate(sections, 1)]
    if apparatus:
        pages.append(("apparatus", _page("Apparatus", "<ol>" + "".join(f"<li>{html.escape(a)}</li>" for a in apparatus) + "</ol>")))
    if colophon:
        pages.append(("colophon", _page("Colophon", paragraphs_html(colophon))))
    items = "".join(f'<item id="{n}" href="{n}.xhtml" media-type="application/xhtml+xml"/>' for n, _ in pages)
    spine = "".join(f'<itemref idref="{n}"/>' for n, _ in pages)
    nav = _page("Contents", '<nav xmlns:epub="http://www.idpf.org/2007/ops" epub:type="toc"><ol>' + "".join(f'<li><a href="{n}.xhtml">{n}</a></li>' for n, _ in pages) + "</ol></nav>")
    opf = f'<?xml version="1.0"?><package xmlns="http://www.idpf.org/2007/opf" version="3.0" unique-identifier="id"><metadata xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:identifier id="id">{html.escape(title)}</dc:identifier><dc:title>{html.escape(title)}</dc:title><dc:language>{html.escape(language)}</dc:language><meta property="dcterms:modified">2024-01-01T00:00:00Z</meta></metadata><manifest><item id="nav" href="nav.xhtml" media-type="application/xhtml+xml" properties="nav"/>{items}</manifest><spine>{spine}</spine></package>'
    container = '<?xml version="1.0"?><container version="1.0" xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="book.opf" media-type="application/oebps-package+xml"/></rootfiles></container>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(zipfile.ZipInfo("mimetype"), "application/epub+zip", zipfile.ZIP_STORED)
        for name, text in (("META-INF/container.xml", container), ("book.opf", opf), ("nav.xhtml", nav), *[(f"{n}.xhtml", t) for n, t in pages]):
            z.writestr(zipfile.ZipInfo(name), text, zipfile.ZIP_DEFLATED)
    return out.getvalue()


def epub_files(books: DataFrame) -> DataFrame:
    """(doc_id, epub binary) of books (doc_id, title, language, sections array<struct<heading,text>>, apparatus, colophon)."""
    import pandas as pd

    def run(frames):
        for f in frames:
            made = [epub(t, la, [(s["heading"], s["text"]) for s in ss], list(a), c or "") for t, la, ss, a, c in f[["title", "language", "sections", "apparatus", "colophon"]].itertuples(index=False)]
            yield pd.DataFrame({"doc_id": f["doc_id"], "epub": made})

    return books.mapInPandas(run, f"doc_id {dict(books.dtypes)['doc_id']}, epub binary")
