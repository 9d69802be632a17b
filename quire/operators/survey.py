"""Selection: rule scores with reasons, exclusion of what is adopted, stable top-k, keyset windows and cost gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The fields that rules may require, and those of a checklist.
FLAGS = ("sustained_text", "transcribable", "known_publicly")
RULE_KEYS = ("require", "languages", "forgotten_only", "keywords")


def rule_problems(rules: Mapping[str, Any]) -> list[str]:
    """What is wrong with a rule set; unknown keys are refused."""
    out = [f"unknown rule {k}" for k in sorted(set(rules) - set(RULE_KEYS))]
    out += [f"unknown field {k}" for k in sorted(set(rules.get("require", {})) - set(FLAGS) - {"physical_form"})]
    return out


def _required(rules: Mapping[str, Any]) -> Column:
    ok = F.lit(True)
    for name, value in rules.get("require", {}).items():
        ok = ok & F.coalesce(F.col(name) == F.lit(value), F.lit(False))
    return ok


def score(rules: Mapping[str, Any]) -> Column:
    """0 where a requirement fails; else one point each for a listed language, for being surely unknown, for any keyword.

    Keywords are looked for in the lower-cased guess and are not lower-cased themselves.
    """
    guess = F.lower(F.coalesce("content_guess", F.lit("")))
    points = F.col("language_script").isin(list(rules.get("languages", []))) if rules.get("languages") else F.lit(False)
    unknown = ~F.col("known_publicly") if rules.get("forgotten_only") else F.lit(False)
    words = F.lit(False)
    for k in rules.get("keywords", []):
        words = words | guess.contains(k)
    total = sum((F.coalesce(x, F.lit(False)).cast("int") for x in (points, unknown, words)), F.lit(0))
    return F.when(_required(rules), total).otherwise(0)


def reasons(rules: Mapping[str, Any]) -> Column:
    guess = F.lower(F.coalesce("content_guess", F.lit("")))
    parts = []
    if rules.get("languages"):
        parts.append(F.when(F.col("language_script").isin(list(rules["languages"])), F.concat(F.lit("language "), F.col("language_script"))))
    if rules.get("forgotten_only"):
        parts.append(F.when(~F.col("known_publicly"), F.lit("not-known (web check)")))
    matched = F.array_compact(F.array(*[F.when(guess.contains(k), F.lit(k)) for k in rules.get("keywords", [])])) if rules.get("keywords") else None
    if matched is not None:
        parts.append(F.when(F.size(matched) > 0, F.concat(F.lit("keyword "), F.array_join(matched, ", "))))
    found = F.array_compact(F.array(*parts)) if parts else F.array().cast("array<string>")
    return F.when(_required(rules), found).otherwise(F.array().cast("array<string>"))


def ranked(evaluations: DataFrame, rules: Mapping[str, Any], adopted: DataFrame | None = None, keep: int = 0) -> DataFrame:
    """Evaluations that score, best first and newest first among equals; keep = 0 keeps all. Adopted records are left out."""
    if problems := rule_problems(rules):
        raise ValueError("; ".join(problems))
    rows = evaluations if adopted is None else evaluations.join(adopted.select("record_id"), "record_id", "left_anti")
    rows = rows.withColumns({"score": score(rules), "reasons": reasons(rules)}).where("score > 0").orderBy(F.desc("score"), F.desc("insert_seq"))
    return rows.limit(keep) if keep else rows


#: Forms that a checklist may name.
FORMS = ("handwritten", "printed", "mixed", "other")


def checklist_problems(payload: Column) -> Column:
    """Messages of what is wrong with a checklist in JSON."""
    value = F.try_parse_json(payload)
    kind = lambda name: F.schema_of_variant(F.try_variant_get(value, f"$.{name}", "variant"))
    keys = F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>"))
    there = lambda name: F.array_contains(keys, name)
    names = ("physical_form", "sustained_text", "language_script", "transcribable", "content_guess", "known_publicly", "web_check", "evidence", "risks")
    bad = [F.when(~there(n), F.lit(f"missing field {n}")) for n in names]
    form = F.get_json_object(payload, "$.physical_form")
    bad.append(F.when(there("physical_form") & ~F.coalesce(form.isin(*FORMS), F.lit(False)), F.lit("physical_form must be handwritten|printed|mixed|other")))

    def typed(name: str, kinds: tuple[str, ...], message: str) -> None:
        bad.append(F.when(there(name) & ~F.coalesce(kind(name), F.lit("VOID")).isin(*kinds), F.lit(f"{name} must be {message}")))

    for name in ("sustained_text", "transcribable"):
        typed(name, ("BOOLEAN",), "a boolean")
    typed("known_publicly", ("BOOLEAN", "VOID"), "boolean or null")
    typed("language_script", ("STRING", "VOID"), "a string or null")
    for name in ("content_guess", "web_check", "evidence"):
        typed(name, ("STRING",), "a string")
    typed("risks", ("ARRAY<STRING>", "ARRAY<VOID>"), "a list of strings")
    return F.when(F.json_object_keys(payload).isNull(), F.array(F.lit("checklist must be a JSON object"))).otherwise(F.array_compact(F.array(*bad)))


def window(selection: DataFrame, surveyed: DataFrame, adopted_urls: DataFrame, limit: int) -> DataFrame:
    """The next records to evaluate: by key, without surveyed revisions and adopted manifests."""
    rows = selection.withColumn("manifest_url", F.get_json_object("normalized_json", "$.manifest_url"))
    rows = rows.join(surveyed.select("record_id", F.col("revision").alias("current_revision")), ["record_id", "current_revision"], "left_anti")
    return rows.join(adopted_urls.select("manifest_url"), "manifest_url", "left_anti").orderBy("source_key").limit(limit)


def next_cursor(evaluated: DataFrame, before: str | None) -> str | None:
    """The greatest evaluated key; the cursor before if nothing was evaluated. Failed records with smaller keys are passed by."""
    return evaluated.agg(F.max("source_key")).first()[0] or before


def progress(eligible: DataFrame, evaluations: DataFrame) -> DataFrame:
    """Per source: eligible records, evaluations of any revision, and what remains, which may be negative."""
    e = eligible.groupBy("source_id").agg(F.count("*").alias("eligible"))
    v = evaluations.groupBy("source_id").agg(F.count("*").alias("evaluated"))
    return e.join(v, "source_id", "left").select("source_id", "eligible", F.coalesce("evaluated", F.lit(0)).alias("evaluated"), (F.col("eligible") - F.coalesce("evaluated", F.lit(0))).alias("remaining"))


class CostGate:
    """Lets work begin while the known cost is below a ceiling; an unknown cost closes it. Work that has begun may end."""

    def __init__(self, most: float):
        self.most, self.spent, self.unknown = most, 0.0, False

    def open(self) -> bool:
        return not self.unknown and self.spent < self.most

    def add(self, cost: float | None) -> None:
        if cost is None:
            self.unknown = True
        else:
            self.spent += cost

    def stop_reason(self) -> str | None:
        return "unknown cost" if self.unknown else "cost ceiling" if self.spent >= self.most else None


def merged_runs(runs: Sequence[tuple[int, float | None]]) -> tuple[int, float | None]:
    """Tokens and cost of several runs; the cost is unknown if one is."""
    costs = [c for _, c in runs]
    return sum(t for t, _ in runs), None if None in costs else sum(costs)
