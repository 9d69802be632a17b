"""Archive records as manifests: a fetch with one fallback, an adapter of item JSON, and first texts of language maps."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

Fetch = Callable[[str], tuple[int, Any]]


def fetch_manifest(fetch: Fetch, url: str, fallback: Callable[[str], str | None], attempts: int = 3, step: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> Any:
    """A manifest's JSON. A 403 is asked for once more at its fallback address; other failures are tried again, waiting longer each time."""
    for i in range(attempts):
        status, body = fetch(url)
        if status == 403 and (other := fallback(url)) is not None:
            status, body = fetch(other)
            if status < 400:
                return manifest_of_item(body)
        if status < 400:
            return body
        if i < attempts - 1:
            sleep(step * (i + 1))
    raise OSError(f"status {status} from {url}")


def first_text(value: Any) -> str:
    """The first text that is not empty in a language map, list or scalar, however deep; @value goes first."""
    if isinstance(value, dict):
        for part in ([value["@value"]] if "@value" in value else []) + list(value.values()):
            if text := first_text(part):
                return text
        return ""
    if isinstance(value, list):
        return next((t for t in map(first_text, value) if t), "")
    return "" if value is None or isinstance(value, bool) else str(value).strip()


@F.pandas_udf(StringType())
def first_text_of_json(value: pd.Series) -> pd.Series:
    """first_text() of JSON texts; depth is unbounded, so it is no SQL expression."""
    import json

    def one(x: str | None) -> str | None:
        if x is None:
            return None
        try:
            return first_text(json.loads(x))
        except ValueError:
            return x.strip()

    return value.map(one)


def manifest_of_item(record: Any) -> dict[str, Any]:
    """A manifest in the older shape from an archive's item JSON: of each file group the JPEG or PNG with the most pixels."""
    if not isinstance(record, dict) or not isinstance(record.get("resources"), list):
        raise ValueError("not an item record")
    canvases = []
    for resource in record["resources"]:
        for group in resource.get("files") or []:
            best = None
            for f in group if isinstance(group, list) else [group]:
                url = str(f.get("url", ""))
                if str(f.get("mimetype", "")).startswith("image/") and url.lower().split("?")[0].endswith((".jpg", ".jpeg", ".png")):
                    area = (f.get("width") or 0) * (f.get("height") or 0)
                    if best is None or area > best[0]:
                        best = area, f
            if best:
                n = len(canvases) + 1
                canvases.append({"@id": f"canvas-{n}", "label": f"page {n}", "width": best[1].get("width"), "height": best[1].get("height"), "images": [{"resource": {"@id": best[1]["url"]}}]})
    if not canvases:
        raise ValueError("the item has no images")
    item = record.get("item") or {}
    author = first_text(item.get("contributors") or item.get("contributor_names") or item.get("contributor"))
    return {"label": first_text(item.get("title")), "metadata": [{"label": "author", "value": author}] if author else [], "sequences": [{"canvases": canvases}]}
