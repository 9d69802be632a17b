"""Normalisation of recognised text: line ends, NFC, variants, numerals and spacing between ideographs."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Code-point ranges of ideographs.
HAN = (
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2A6DF), (0x2A700, 0x2B73F), (0x2B740, 0x2B81F),
    (0x2B820, 0x2CEAF), (0x2CEB0, 0x2EBEF), (0x2EBF0, 0x2EE5F), (0x2F800, 0x2FA1F), (0x30000, 0x3134F), (0x31350, 0x323AF),
)
_HAN_CLASS = "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in HAN) + "]"
#: Ligature numerals and what they stand for.
NUMERALS = {"廿": "二十", "卅": "三十", "卌": "四十"}


@F.pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Unicode NFC, which Spark has no function for."""
    return text.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def compact_han_spacing(text: Column) -> Column:
    """Without runs of spaces between two ideographs; other spaces and tabs stay."""
    return F.regexp_replace(text, f"(?<={_HAN_CLASS}) +(?={_HAN_CLASS})", "")


def fold_variants(text: Column, variants: Mapping[str, str]) -> Column:
    """Each variant character replaced by its class's representative (a table from a parameter)."""
    if not variants:
        return text
    if any(ord(c) > 0xFFFF for pair in variants.items() for c in pair):
        table = F.create_map(*[F.lit(c) for pair in variants.items() for c in pair])
        return F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
    return F.translate(text, "".join(variants), "".join(variants.values()))


def normalize_recognized(text: Column, variants: Mapping[str, str] | None = None) -> Column:
    out = nfc(F.regexp_replace(text, "\r\n?", "\n"))
    out = fold_variants(out, variants or {})
    for a, b in NUMERALS.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return compact_han_spacing(out)


def normalize_counted(text: Column) -> Column:
    """NFC without white space: what is compared when characters are counted."""
    return nfc(F.regexp_replace(text, r"(?U)\s", ""))


def trim_malformed_end(text: Column) -> Column:
    """Stripped, without one malformed ending (/n or backslash n, then _, `, }) that answers may have."""
    inner = F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")
    return F.regexp_replace(F.regexp_replace(inner, r"[/\\]n[_`}]*\z", ""), r"(?U)\s+\z", "")


def flag_summary(flags: Column, prefix: str = "") -> Column:
    """name=value of a flag map, by name."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(flags)), lambda e: F.concat(F.lit(prefix), e["key"], F.lit("="), e["value"].cast("string"))), " ")
