"""SRU/XML sources: parsing of responses, leaf fields, projection of Dublin Core, and a paged data source with a polite reader.

The call itself is a function that is given, so that no network is needed: fetch(url) returns (status, headers, text).
"""

from __future__ import annotations

import time
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Language codes and the record lists that Dublin Core fields feed.
LANGUAGES = {"chi": "zh", "fre": "fr", "tib": "bo", "san": "sa"}
FIELDS = {
    "titles": ["title"],
    "descriptions": ["description"],
    "subjects": ["subject"],
    "languages": ["language"],
    "contributors": ["creator", "contributor"],
    "identifiers": ["identifier"],
    "relations": ["relation"],
    "rights": ["rights"],
}
Fetch = Callable[[str], tuple[int, dict[str, str], str]]


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def parse_response(xml: str) -> tuple[int, int | None, list[tuple[str | None, str]]]:
    """Total, the next position (None at the end) and (position, record data) of a response; ValueError if it holds no total."""
    root = ET.fromstring(xml)
    text = {_local(e.tag): (e.text or "").strip() for e in root.iter() if _local(e.tag) in ("numberOfRecords", "nextRecordPosition")}
    if not text.get("numberOfRecords", "").isdigit():
        raise ValueError("the response has no total")
    rows = []
    for record in (e for e in root.iter() if _local(e.tag) == "record"):
        data = next((e for e in record if _local(e.tag) == "recordData"), None)
        if data is not None:
            place = next(((e.text or "").strip() for e in record if _local(e.tag) == "recordPosition"), None)
            rows.append((place, ET.tostring(data, encoding="unicode")))
    following = text.get("nextRecordPosition")
    return int(text["numberOfRecords"]), int(following) if following else None, rows


def leaf_fields(xml: str) -> list[tuple[str, str]]:
    """(local name, text) of the leaf elements in document order; white space is collapsed, empty ones are dropped."""
    out = []
    for e in ET.fromstring(xml).iter():
        if len(e) == 0 and (text := " ".join((e.text or "").split())):
            out.append((_local(e.tag), text))
    return out


@F.udtf(returnType=StructType().add("pos", IntegerType()).add("name", StringType()).add("text", StringType()))
class LeafFields:
    """leaf_fields() as a table function: SELECT * FROM rows, LATERAL leaf_fields(xml)."""

    def eval(self, xml: str) -> Iterator[tuple[int, str, str]]:
        for i, (name, text) in enumerate(leaf_fields(xml)):
            yield i, name, text


def field_lists(leaves: DataFrame, key: str = "record") -> DataFrame:
    """(key, fields map<string, array<string>>) from leaves (key, pos, name, text)."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"])
    lists = leaves.groupBy(key, "name").agg(ordered.alias("texts"))
    return lists.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "texts")))).alias("fields"))


def project(fields: Column, repository: str, collection: str) -> Column:
    """A normalized record struct with source_key, from a field map. source_key is null without an identifier."""
    get = lambda n: F.coalesce(F.try_element_at(fields, F.lit(n)), F.array().cast("array<string>"))
    ark = F.array_compact(F.transform(get("identifier"), lambda x: F.nullif(F.regexp_extract(x, r"ark:/12148/[^/?#\s]+", 0), F.lit(""))))
    first = lambda a: F.try_element_at(a, F.lit(1))
    key = F.coalesce(first(ark), first(get("identifier")))
    web = first(F.filter(get("identifier"), lambda x: x.rlike("^https?://")))
    codes = F.create_map(*[F.lit(x) for pair in LANGUAGES.items() for x in pair])
    lists = {name: F.concat(*[get(s) for s in sources]) for name, sources in FIELDS.items()}
    lists["languages"] = F.transform(lists["languages"], lambda x: F.coalesce(F.try_element_at(codes, F.lower(x)), x))
    date, kind = get("date"), F.lower(F.array_join(F.concat(get("type"), get("format")), " "))
    span = F.when(F.size(date) == 1, first(date))
    rx = r"^\s*(\d{3,4})\s*[-–/]\s*(\d{3,4})\s*$"
    year = lambda i: F.nullif(F.regexp_extract(span, rx, i), F.lit("")).cast("int")
    rights = F.lower(F.array_join(lists["rights"], " "))
    whole = kind.contains("manuscrit") | kind.contains("manuscript")
    fragment = F.lower(F.array_join(get("title"), " ")).contains("fragment")
    values = {
        "source_key": key,
        "record_type": F.when(whole & fragment, "manuscript_fragment").when(whole, "manuscript").otherwise("unknown"),
        "access": F.when(rights.contains("domaine public") | rights.contains("public domain"), "open").otherwise("unknown"),
        **lists,
        "scripts": F.array().cast("array<string>"),
        "repository": F.lit(repository),
        "collection": F.lit(collection),
        "catalog_url": F.when(first(ark).isNotNull(), F.concat(F.lit("https://gallica.bnf.fr/"), first(ark))).otherwise(web),
        "manifest_url": F.concat(F.lit("https://gallica.bnf.fr/iiif/"), first(ark), F.lit("/manifest.json")),
        "date_label": F.nullif(F.array_join(date, "; "), F.lit("")),
        "material": F.nullif(F.array_join(get("format"), "; "), F.lit("")),
        "date_start": year(1),
        "date_end": year(2),
    }
    return F.struct(*[v.alias(k) for k, v in values.items()])


def politely(fetch: Fetch, url: str, attempts: int = 5, sleep: Callable[[float], None] = time.sleep) -> str:
    """The text of a URL. 429 and 5xx are tried again after what the server asks for, or after 1, 2, 4, 8 seconds; others fail at once."""
    for i in range(attempts):
        status, headers, text = fetch(url)
        if status < 400:
            return text
        if status != 429 and status < 500 or i == attempts - 1:
            raise OSError(f"status {status} from {url}")
        wait = headers.get("Retry-After", "")
        sleep(float(wait) if wait.isdigit() else float(2**i))
    raise OSError(url)


def pages(fetch: Fetch, url: str, size: int = 50, start: int = 1, interval: float = 0.0, sleep: Callable[[float], None] = time.sleep) -> Iterator[tuple[int | None, list[tuple[str | None, str]]]]:
    """(next position or None, records) of each page; ValueError on an empty page before the total or a position that stands still."""
    if not 1 <= size <= 50:
        raise ValueError("a page has 1 to 50 records")
    at: int | None = start
    while at is not None:
        total, following, rows = parse_response(politely(fetch, f"{url}&startRecord={at}&maximumRecords={size}", sleep=sleep))
        if not rows and at <= total:
            raise ValueError(f"an empty page at {at} of {total}")
        if following is not None and following <= at:
            raise ValueError(f"the position stands still at {at}")
        yield following, rows
        at = following
        if at is not None and interval:
            sleep(interval)


class SruSource(DataSource):
    """spark.read.format("quire_sru"): one partition a source, so that its interval holds. Options: url, pagesize, interval.

    fetch is a class attribute that is set before registering (functions cannot be options).
    """

    fetch: Fetch | None = None

    @classmethod
    def name(cls) -> str:
        return "quire_sru"

    def schema(self) -> str:
        return "position string, xml string"

    def reader(self, schema) -> DataSourceReader:
        return _SruReader(type(self).fetch, dict(self.options))


class _SruReader(DataSourceReader):
    def __init__(self, fetch: Fetch | None, options: dict[str, str]):
        unknown = set(options) - {"url", "pagesize", "interval", "path"}
        if unknown or fetch is None or "url" not in options:
            raise ValueError(f"unknown options {sorted(unknown)}" if unknown else "url and fetch are needed")
        self.fetch, self.options = fetch, options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple[str | None, str]]:
        for _, rows in pages(self.fetch, self.options["url"], int(self.options.get("pagesize", 50)), interval=float(self.options.get("interval", 0))):
            yield from rows
