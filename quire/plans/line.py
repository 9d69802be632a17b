"""The production line: contract kinds, stations, recipes and their static checks, and the graph of it all.

A recipe is a driver object of a few dozen steps; what it decides about cells is a DataFrame (operators.ledger.freshness).
"""

from __future__ import annotations

import hashlib
import inspect
import json
import os
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCES = ("metadata", "page_list")


@dataclass(frozen=True)
class Station:
    """A transformation: input kinds, one output kind, its grain, its options and the function that runs it."""

    name: str
    consumes: tuple[str, ...]
    produces: str
    grain: str = "page"
    variant: str = "default"
    optional: tuple[str, ...] = ()
    options: tuple[str, ...] = ()
    model: bool = False
    run: Callable[..., Any] | None = None
    #: Further source files that the station's results hang on.
    sources: tuple[str, ...] = ()

    @property
    def socket(self) -> tuple:
        return self.consumes, self.optional, self.produces, self.grain

    @property
    def code(self) -> str:
        """The identity of the station's code: name, variant, its function's name, and the bytes of the files that it is made of."""
        h = hashlib.sha256(f"station\0{self.name}\0{self.variant}\0".encode())
        paths = list(self.sources)
        if self.run is not None:
            h.update(f"{self.run.__module__}.{self.run.__qualname__}\0".encode())
            try:
                paths.append(inspect.getsourcefile(self.run) or "")
            except TypeError:
                pass
            if not paths[-1:] or not os.path.isfile(paths[-1]):  # made at run time: its code alone
                paths = paths[: len(self.sources)]
                h.update(self.run.__code__.co_code if hasattr(self.run, "__code__") else b"")
        for path in sorted(set(paths)):
            with open(path, "rb") as f:
                h.update(os.path.basename(path).encode() + b"\0" + f.read() + b"\0")
        return h.hexdigest()[:16]


@dataclass
class Registry:
    """Stations by name and variant: one socket for all variants of a name, one name for each kind."""

    kinds: Mapping[str, str]
    stations: dict[tuple[str, str], Station] = field(default_factory=dict)

    def register(self, s: Station) -> Station:
        if (s.name, s.variant) in self.stations:
            raise ValueError(f"{s.name}/{s.variant} is there already")
        for kind in (*s.consumes, *s.optional, s.produces):
            if kind not in self.kinds:
                raise ValueError(f"unknown kind {kind}")
        if self.kinds[s.produces] != s.grain:
            raise ValueError(f"{s.produces} is not of grain {s.grain}")
        for other in self.stations.values():
            if other.name == s.name and other.socket != s.socket:
                raise ValueError(f"{s.name}: variants differ in their socket")
            if other.name != s.name and other.produces == s.produces:
                raise ValueError(f"{s.produces} has two producers")
        self.stations[s.name, s.variant] = s
        return s

    def get(self, name: str, variant: str | None = None) -> Station:
        own = {v: s for (n, v), s in self.stations.items() if n == name}
        if not own:
            raise LookupError(f"unknown station {name}")
        if variant is None:
            if "default" in own:
                return own["default"]
            if len(own) > 1:
                raise LookupError(f"{name} has several variants")
            return next(iter(own.values()))
        if variant not in own:
            raise LookupError(f"unknown variant {name}/{variant}")
        return own[variant]

    def edges(self) -> list[tuple[str, str, str]]:
        """(from, to, role) of the graph of kinds and stations, each name once."""
        out = set()
        for s in self.stations.values():
            out |= {(k, s.name, "consumes") for k in s.consumes} | {(k, s.name, "optional") for k in s.optional} | {(s.name, s.produces, "produces")}
        return sorted(out)

    def edge_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.edges(), "src string, dst string, role string")

    def mermaid(self) -> str:
        arrow = {"consumes": "-->", "optional": "-.->", "produces": "==>"}
        return "\n".join(["flowchart LR", *[f"  {a} {arrow[r]} {b}" for a, b, r in self.edges()]])


@dataclass(frozen=True)
class Step:
    station: str
    variant: str | None = None
    model: str | None = None
    prompt: str | None = None
    params: tuple[tuple[str, Any], ...] = ()
    options: tuple[tuple[str, Any], ...] = ()


@dataclass(frozen=True)
class Recipe:
    name: str
    steps: tuple[Step, ...]


def interpolate(text: str, defaults: Mapping[str, str] | None = None, environment: Mapping[str, str] | None = None) -> str:
    """${NAME} from the environment, then the defaults; LookupError if neither has it."""
    env = os.environ if environment is None else environment

    def value(m: re.Match) -> str:
        for place in (env, defaults or {}):
            if m[1] in place:
                return place[m[1]]
        raise LookupError(f"{m[1]} is not set")

    return re.sub(r"\$\{([A-Za-z_][A-Za-z0-9_]*)\}", value, text)


def load(text: str, registry: Registry, defaults: Mapping[str, str] | None = None, environment: Mapping[str, str] | None = None) -> Recipe:
    """A recipe from YAML, checked against the registry."""
    import yaml

    raw = yaml.safe_load(interpolate(text, defaults, environment))
    steps = []
    for slot in raw["steps"]:
        unknown = set(slot) - {"station", "variant", "model", "prompt", "params", "options"}
        if unknown:
            raise ValueError(f"unknown keys {sorted(unknown)}")
        steps.append(Step(slot["station"], slot.get("variant"), slot.get("model"), slot.get("prompt"), tuple(sorted((slot.get("params") or {}).items())), tuple(sorted((slot.get("options") or {}).items()))))
    recipe = Recipe(raw["name"], tuple(steps))
    if problems := chain_problems(recipe, registry):
        raise ValueError("; ".join(problems))
    return recipe


def chain_problems(recipe: Recipe, registry: Registry) -> list[str]:
    """What is wrong with a recipe: inputs that no earlier step made, kinds made twice, models where there should be none."""
    there, out = set(SOURCES), []
    for step in recipe.steps:
        try:
            s = registry.get(step.station, step.variant)
        except LookupError as e:
            out.append(str(e))
            continue
        out += [f"{s.name} lacks {k}" for k in s.consumes if k not in there]
        if s.produces in there:
            out.append(f"{s.produces} is made twice")
        there.add(s.produces)
        out += [f"{s.name}: unknown option {k}" for k, _ in step.options if k not in s.options]
        if s.model != bool(step.model and step.prompt) or (not s.model and (step.model or step.prompt)):
            out.append(f"{s.name}: a model and a prompt " + ("are needed" if s.model else "are out of place"))
    return out


def slice_steps(recipe: Recipe, registry: Registry, through: str | None = None, pages_only: bool = False) -> tuple[tuple[Step, ...], bool]:
    """The steps to run and whether that is a part: up to a station, and before the first manuscript step if pages are selected."""
    steps = list(recipe.steps)
    if through is not None:
        names = [s.station for s in steps]
        if through not in names:
            raise ValueError(f"the recipe has no {through}")
        steps = steps[: names.index(through) + 1]
    if pages_only:
        first = next((i for i, s in enumerate(steps) if registry.get(s.station, s.variant).grain != "page"), len(steps))
        if through is not None and first < len(steps):
            raise ValueError("selected pages cannot cross a manuscript step")
        steps = steps[:first]
    return tuple(steps), len(steps) < len(recipe.steps)


def batches(steps: tuple[Step, ...], registry: Registry) -> list[list[Step]]:
    """Consecutive page steps together, each manuscript step alone: the barriers of a run."""
    out: list[list[Step]] = []
    for s in steps:
        page = registry.get(s.station, s.variant).grain == "page"
        if page and out and registry.get(out[-1][0].station, out[-1][0].variant).grain == "page":
            out[-1].append(s)
        else:
            out.append([s])
    return out


def config_fingerprints(step: Step, prompt_sha256: str | None) -> tuple[str, str]:
    """(configuration, parameters) hashes of a step."""
    params = hashlib.sha256(json.dumps({"params": dict(step.params), "options": dict(step.options)}, sort_keys=True).encode()).hexdigest()
    whole = "\x1f".join(x or "" for x in (step.model, step.prompt, prompt_sha256, params))
    return hashlib.sha256(whole.encode()).hexdigest()[:16], params


def artifact_fingerprint(payload: Mapping[str, Any]) -> str:
    """The 16-digit hash of a JSON artifact: without provenance, sorted keys, ASCII, default separators."""
    body = {k: v for k, v in payload.items() if k != "provenance"}
    return hashlib.sha256(json.dumps(body, sort_keys=True).encode()).hexdigest()[:16]


def closure(edges: DataFrame, roots: list[str]) -> DataFrame:
    """(name) of all that the roots lead to, however far: each round follows the edges of what is new, until nothing is.

    A round's new names are checkpointed where the session has a folder for it, else cached, so that plans do not grow.
    """
    spark = edges.sparkSession
    settled = (lambda df: df.checkpoint()) if spark.sparkContext.getCheckpointDir() else (lambda df: df.persist())
    arrows = edges.select("src", "dst").distinct()
    seen = new = spark.createDataFrame([(r,) for r in sorted(set(roots))], "name string")
    while True:
        new = settled(new.join(arrows, new.name == arrows.src).select(F.col("dst").alias("name")).distinct().join(seen, "name", "left_anti"))
        if new.isEmpty():
            return seen
        seen = settled(seen.unionAll(new))
