"""Run parameters and the declarative description of each event family."""

from __future__ import annotations

from dataclasses import dataclass, field

from staylens.schemas import ADMISSION, STAY


@dataclass(frozen=True)
class JoinLimits:
    """When a join side may be broadcast and which keys count as hot.

    ``broadcast_rows`` is compared with a counted number of fixed-width rows, so
    2 million stays of at most six 8-byte fields stay below 100 MB.
    """

    broadcast_rows: int = 2_000_000
    hot_share: float = 0.01


@dataclass(frozen=True)
class Settings:
    window_hours: int = 24
    top_n_chart: int = 50
    top_n_lab: int = 30
    top_n_output: int = 20
    top_n_input: int = 30
    top_n_drug: int = 30
    age_mode: str = "year_boundary"
    category_mode: str = "plain"
    exclude: tuple[str, ...] = ()
    test_size: float = 0.2
    seed: int = 42
    folds: int = 5
    # Exactly the share of patients instead of a share up to sampling error.
    exact_split: bool = False
    limits: JoinLimits = field(default_factory=JoinLimits)

    def top_n(self, family: str) -> int:
        return getattr(self, f"top_n_{family}")


@dataclass(frozen=True)
class Source:
    table: str
    time: str
    value: str | None


@dataclass(frozen=True)
class Family:
    """One kind of event: where it is read, how it links, what is computed.

    ``stats`` are the feature columns; ``drug`` events carry no value and count
    rows per normalised drug name.
    """

    name: str
    sources: tuple[Source, ...]
    key: str
    stats: tuple[str, ...]
    dimension: str | None = None
    dimension_columns: tuple[str, ...] = ()


SIX_STATS = ("mean", "min", "max", "std", "count", "last")
ITEM_DIMENSION = ("LABEL", "CATEGORY", "UNITNAME")

CHART = Family(
    "chart", (Source("chartevents", "CHARTTIME", "VALUENUM"),), STAY, SIX_STATS, "d_items", ITEM_DIMENSION
)
LAB = Family(
    "lab",
    (Source("labevents", "CHARTTIME", "VALUENUM"),),
    ADMISSION,
    SIX_STATS,
    "d_labitems",
    ("LABEL", "FLUID", "CATEGORY"),
)
OUTPUT = Family(
    "output",
    (Source("outputevents", "CHARTTIME", "VALUE"),),
    STAY,
    ("sum", "count", "last"),
    "d_items",
    ITEM_DIMENSION,
)
INPUT = Family(
    "input",
    (Source("inputevents_cv", "CHARTTIME", "AMOUNT"), Source("inputevents_mv", "STARTTIME", "AMOUNT")),
    STAY,
    ("sum", "mean", "count", "last"),
    "d_items",
    ITEM_DIMENSION,
)
DRUG = Family("drug", (Source("prescriptions", "STARTDATE", None),), ADMISSION, ("count",))

FAMILIES = {f.name: f for f in (CHART, LAB, OUTPUT, INPUT, DRUG)}


@dataclass(frozen=True)
class TableGroup:
    """A feature table: its families in column order and which stays it keeps.

    ``context`` names the dimensions joined to the stays. Without families the
    table holds context only.
    """

    name: str
    tables: int
    families: tuple[Family, ...]
    needs_chart: bool
    chart_prefix: str = "chart"
    context: tuple[str, ...] = ("patients", "admissions")

    def prefix(self, family: str) -> str:
        return self.chart_prefix if family == "chart" else family


GROUPS = {
    g.name: g
    for g in (
        TableGroup("5", 5, (CHART,), True, "item"),
        TableGroup("7", 7, (CHART, LAB), True),
        TableGroup("9", 9, (CHART, LAB, OUTPUT, DRUG), True),
        TableGroup("more", 11, (CHART, LAB, OUTPUT, INPUT, DRUG), False),
        # Steps of the table experiments that have no published feature table.
        TableGroup("stays", 1, (), False, context=()),
        TableGroup("context", 3, (), False),
        TableGroup("labs", 5, (LAB,), False),
        TableGroup("inputs", 9, (CHART, LAB, INPUT), True),
        TableGroup("outputs", 10, (CHART, LAB, INPUT, OUTPUT), True),
    )
}
