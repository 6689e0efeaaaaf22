"""Declarative records that drive the operators (rules are data, not code)."""

from __future__ import annotations

from dataclasses import dataclass, field

SUPPORTED_FORMATS = ("csv", "ragged_csv", "parquet", "json", "orc", "table", "jdbc")


@dataclass(frozen=True)
class SourceSpec:
    """One dataset to load: where it lies, how it is written and what it holds."""

    name: str
    location: str
    format: str = "csv"
    skip_rows: int = 0
    schema: str | None = None
    options: dict = field(default_factory=dict)
    comment: str = ""

    def __post_init__(self):
        if self.format not in SUPPORTED_FORMATS:
            raise ValueError(f"source {self.name!r}: unsupported format {self.format!r}")
        if self.skip_rows < 0:
            raise ValueError(f"source {self.name!r}: skip_rows must not be negative")


@dataclass(frozen=True)
class SchemaPatch:
    """How one drifting input reaches the common schema."""

    rename: dict = field(default_factory=dict)
    constants: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Rule:
    """A label given when the text contains any fragment or matches the pattern."""

    label: str
    contains: tuple = ()
    pattern: str | None = None


@dataclass(frozen=True)
class CodeCheck:
    """Validate ``column`` against ``catalogue[code]``; critical failures drop the row."""

    column: str
    catalogue: str
    code: str = "code"
    critical: bool = False


@dataclass(frozen=True)
class RowRule:
    """A named SQL predicate that valid rows satisfy (NULL counts as a failure)."""

    name: str
    predicate: str


@dataclass(frozen=True)
class Rollup:
    """``detail`` takes its parent's label where its scope counts fewer than ``minimum`` records.

    ``scope`` holds columns or SQL expressions of them; None means all other published columns, so
    that single cells are judged.
    """

    name: str
    detail: str
    parent: str
    minimum: int
    scope: tuple | None = None


@dataclass(frozen=True)
class PrivacyPolicy:
    """What a release does with each sensitive column of one table, and with the cells it publishes.

    ``minors`` names age, place and the national label; ``places`` place, its parent and the least
    number of inhabitants; ``others`` the category whose small cells are pooled and the least count.
    ``publish`` lists the columns of a published cell.
    """

    table: str
    sensitivity: str = "low"
    drop: tuple = ()
    months: tuple = ()
    age_groups: tuple = ()
    publish: tuple = ()
    minors: tuple = ()
    rollups: tuple = ()
    places: tuple = ()
    others: tuple = ()
    statistics: tuple = ()

    def __post_init__(self):
        if set(self.publish) & set(self.drop):
            raise ValueError(f"{self.table}: a dropped column is published")
        for name, width in (("minors", 3), ("places", 3), ("others", 2)):
            if len(getattr(self, name)) not in (0, width):
                raise ValueError(f"{self.table}: {name} takes {width} values")
        details = [r.detail for r in self.rollups] + [x for x in (*self.minors[1:2], *self.places[:1], *self.others[:1])]
        if unknown := [d for d in details if d not in self.publish]:
            raise ValueError(f"{self.table}: rules about unpublished columns {unknown}")


@dataclass(frozen=True)
class TableSpec:
    """A catalogue record about one published table."""

    name: str
    format: str
    owner: str
    updated: str
    rule: str
    available: bool = True
