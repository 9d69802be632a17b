"""Column expressions that the operators share. All of them stay on the JVM side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT_SEPARATOR = "\x1f"


def fingerprint(*parts: Column) -> Column:
    """First 16 hex digits of the sha256 of the parts joined by U+001F; a null part counts as an empty string."""
    joined = F.concat_ws(UNIT_SEPARATOR, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.substring(F.sha2(joined, 256), 1, 16)


def record_id(source_id: Column, source_key: Column) -> Column:
    """source-record: and the sha256 of source id, NUL, source key."""
    return F.concat(F.lit("source-record:"), F.sha2(F.concat(source_id, F.lit("\0"), source_key), 256))


def json_string(value: Column) -> Column:
    """A JSON string literal of value, or null's literal; non-ASCII characters stay."""
    wrapped = F.to_json(F.struct(value.cast("string").alias("v")), {"ignoreNullFields": "false"})
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)


def record_fingerprint(url: Column, modified: Column, normalized: Column, raw: Column) -> Column:
    """sha256 of the compact JSON array of four values; a null stays null."""
    parts = [json_string(c) for c in (url, modified, normalized, raw)]
    return F.sha2(F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]")), 256)


def canonical_json(**fields: Column) -> Column:
    """Compact JSON with sorted keys; null fields are left out."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))


def sum_or_unknown(value: Column) -> Column:
    """A sum that any unknown value makes unknown. No rows give null."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))


def sum_or_unknown_where(value: Column, condition: Column) -> Column:
    """The same over the rows that meet a condition; none of them give 0."""
    rows = F.count_if(condition)
    known = F.count(F.when(condition, value))
    return F.when(rows == 0, F.lit(0.0)).when(known == rows, F.sum(F.when(condition, value)))


def strip(text: Column) -> Column:
    """Without white space at both ends, in the Unicode sense."""
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def rounded(value: Column, places: int) -> Column:
    """value rounded in binary, as value times 10^places, halves away from zero; F.round goes by the value's shortest decimal digits."""
    scaled = F.abs(value) * F.lit(10.0**places)
    whole = F.floor(scaled)
    return F.signum(value) * (whole + F.when(scaled - whole >= 0.5, 1).otherwise(0)) / F.lit(10.0**places)


def squash(text: Column) -> Column:
    """Without any white space, in the Unicode sense."""
    return F.regexp_replace(text, r"(?U)\s", "")


def lines(text: Column) -> Column:
    """Physical lines: all Unicode line ends count; no empty line after the last one."""
    cut = F.split(text, "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]", -1)
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).when(F.element_at(cut, -1) == "", F.slice(cut, F.lit(1), F.size(cut) - 1)).otherwise(cut)


def content_lines(text: Column) -> Column:
    """Lines that hold something, stripped."""
    return F.filter(F.transform(lines(text), strip), lambda x: x != "")


def paragraphs(text: Column) -> Column:
    """Parts between blank lines, stripped, without empty ones."""
    return F.filter(F.transform(F.split(text, r"\n\s*\n", -1), strip), lambda x: x != "")


def excerpt(text: Column, most: int = 220) -> Column:
    """Longer texts are cut at the last space before most, else just before it, and get an ellipsis."""
    head = F.substring(text, 1, most)
    space = F.length(head) - F.instr(F.reverse(head), " ")
    cut = F.when(F.instr(head, " ") > 0, F.substring(head, F.lit(1), space)).otherwise(F.substring(text, 1, most - 1))
    return F.when(F.length(text) <= most, text).otherwise(F.concat(cut, F.lit("…")))


def first_of(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def clean_list(values: Column) -> Column:
    """Null is empty; elements are stripped; the first of equal elements stays."""
    return F.array_distinct(F.transform(F.coalesce(values, F.array().cast("array<string>")), strip))


def failures(*checks: tuple[Column, str]) -> Column:
    """Messages of the checks that fail; a check that is null fails."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(message)) for ok, message in checks]))


def clamp(value: Column, low: int, high: int) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def tile_token_cap(lines_: Column) -> Column:
    """Tokens allowed for a tile with that many lines."""
    return clamp(lines_ * 80 + 400, 800, 4000)


def evenly_spaced(n: Column, count: int) -> Column:
    """0-based indexes of count interior picks of n items, rounded half to even; all of them if there are no more."""
    picks = F.transform(F.sequence(F.lit(1), F.lit(count)), lambda i: F.bround(i * (n - 1) / F.lit(count + 1)).cast("int"))
    return F.when(n <= count, F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))).otherwise(picks)


def tile_origins(length: Column, tile: int, overlap: int) -> Column:
    """Where tiles of one axis begin: steps of tile less overlap, the last flush with the end."""
    last = (length - tile).cast("int")
    return F.when(length <= tile, F.array(F.lit(0))).otherwise(F.array_union(F.sequence(F.lit(0), last, F.lit(tile - overlap)), F.array(last)))


def cost_label(cost: Column, complete: Column) -> Column:
    return F.when(complete, F.concat(F.lit("$"), F.format_number(cost, 2))).otherwise(F.lit("not fully known"))


def doc_id_valid(doc_id: Column) -> Column:
    return F.coalesce(doc_id.rlike(r"\A[a-z0-9]+(?:_[a-z0-9]+)*\z"), F.lit(False))


def all_true(columns: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & c
    return out


def text_lines_to_ink(text: Column) -> Column:
    """Each line's characters without brackets, question marks and spaces."""
    skip = F.array(*[F.lit(c) for c in "〔〕?()[] 　"])
    return F.transform(lines(text), lambda x: F.filter(F.split(x, ""), lambda c: ~F.array_contains(skip, c) & (c != "")))


def last_error(text: Column) -> Column:
    """Whether a finish reason says that an answer was cut off."""
    return F.lower(text).rlike(r"max_tokens|length|truncat")
