"""Declarative descriptions that drive every operator.

``CleanRules`` says how raw text columns become typed columns, ``PanelSpec``
says which columns of an entity-by-period panel play which role in the
collapse, and ``RiskRules`` holds the thresholds of the entity-level features.
Operators never name a column themselves; they read it from here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T

UNUSED, TEXT, DATE, FLOAT, INT = "unused", "text", "date", "float", "int"
SPARK_TYPES = {
    TEXT: T.StringType(),
    DATE: T.DateType(),
    FLOAT: T.DoubleType(),
    INT: T.IntegerType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str


def parse_layout(text: str) -> tuple[Field, ...]:
    """Read one ``name kind`` pair per line, in file order."""
    rows = [line.split() for line in text.strip().splitlines()]
    return tuple(Field(name, kind) for name, kind in rows)


@dataclass(frozen=True)
class CleanRules:
    """Typing and cleaning rules for a positional text layout."""

    layout: tuple[Field, ...]
    extra_text: tuple[str, ...] = ()
    sentinels: Mapping[str, Sequence[str]] = field(default_factory=dict)
    recodes: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    bounds: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    date_format: str = "MMyyyy"

    def __post_init__(self) -> None:
        names = [f.name for f in self.layout] + list(self.extra_text)
        if len(set(names)) != len(names):
            raise ValueError("a column appears twice in the layout")
        bad = [f for f in self.layout if f.kind not in (UNUSED, *SPARK_TYPES)]
        if bad:
            raise ValueError(f"unknown kinds: {bad}")
        known = set(self.kept)
        for rule in (self.sentinels, self.recodes, self.bounds):
            if not set(rule) <= known:
                raise ValueError(f"rules on unknown columns: {set(rule) - known}")

    @property
    def raw_names(self) -> list[str]:
        return [f.name for f in self.layout]

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, T.StringType()) for n in self.raw_names])

    @property
    def unused(self) -> list[str]:
        return [f.name for f in self.layout if f.kind == UNUSED]

    @property
    def kinds(self) -> dict[str, str]:
        """Kept columns in order with their kind."""
        kept = {f.name: f.kind for f in self.layout if f.kind != UNUSED}
        return kept | dict.fromkeys(self.extra_text, TEXT)

    @property
    def kept(self) -> list[str]:
        return list(self.kinds)

    def of_kind(self, *kinds: str) -> list[str]:
        return [n for n, k in self.kinds.items() if k in kinds]

    @property
    def typed_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, SPARK_TYPES[k]) for n, k in self.kinds.items()])


@dataclass(frozen=True)
class Last:
    """Value of ``column`` at the latest period where it is set (or positive)."""

    column: str
    alias: str
    positive: bool = False


@dataclass(frozen=True)
class PanelSpec:
    entity: str
    period: str
    age: str
    status: str
    transfer: str
    plan: str
    modified: str
    code: str
    static: tuple[str, ...]
    last: tuple[Last, ...]
    active_plans: tuple[str, ...]
    default_codes: tuple[str, ...]
    yes: str = "Y"


@dataclass(frozen=True)
class RiskRules:
    default_codes: tuple[str, ...]
    clean_codes: tuple[str, ...]
    vintages: Mapping[str, tuple[int, int]]
    costs: tuple[str, ...]
    proceeds: tuple[str, ...]
    serious_from: int = 3
    strata: tuple[str, str, str, str] = ("default", "serious_dlq", "early_dlq", "performing")
