"""Table specs: one declaration drives schema, cleaning, features and profiling."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    DataType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_TYPES: dict[str, DataType] = {
    "int": IntegerType(),
    "bigint": LongType(),
    "string": StringType(),
}

PDAYS_FEATURE_SETS = ("both", "drop_pdays_clean", "drop_prev_contacted")


@dataclass(frozen=True)
class Sentinel:
    """A numeric column where one value means "never" (e.g. pdays = -1).

    Cleaning adds ``flag`` (0 at the sentinel, else 1) and ``clean`` (0 at the
    sentinel, else the value) and drops ``column``.
    """

    column: str
    value: int
    flag: str
    clean: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[tuple[str, str], ...]
    target: str
    positive: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    caps: dict[str, int] = field(default_factory=dict)
    sentinel: Sentinel | None = None
    leakage: str | None = None
    feature_numeric: tuple[str, ...] = ()
    hist_cols: tuple[str, ...] = ()
    key: str | None = None
    label: str = "label"

    # S1 — explicit schema, all nullable, no inference.
    def schema(self) -> StructType:
        return StructType(
            [StructField(n, _TYPES[t], True) for n, t in self.columns]
        )

    def string_schema(self) -> StructType:
        """Every column as string: used where values must be parsed leniently."""
        return StructType([StructField(n, StringType(), True) for n, _ in self.columns])

    # P8 — feature-set choice.
    def features(
        self, keep_leakage: bool = False, pdays_features: str = "both"
    ) -> tuple[list[str], list[str]]:
        if pdays_features not in PDAYS_FEATURE_SETS:
            raise ValueError(f"pdays_features must be one of {PDAYS_FEATURE_SETS}")
        nums = list(self.feature_numeric)
        if self.sentinel is not None:
            if pdays_features == "drop_pdays_clean":
                nums = [c for c in nums if c != self.sentinel.clean]
            elif pdays_features == "drop_prev_contacted":
                nums = [c for c in nums if c != self.sentinel.flag]
        if keep_leakage and self.leakage:
            nums.append(self.leakage)
        return list(self.categorical), nums

    def histogram_columns(self, keep_leakage: bool = False) -> list[str]:
        cols = list(self.hist_cols)
        if keep_leakage and self.leakage:
            cols.append(self.leakage)
        return cols

    def unused_sentinel_feature(self, pdays_features: str) -> str | None:
        """The derived sentinel column a feature set leaves out (stream side drop)."""
        if self.sentinel is None:
            return None
        if pdays_features == "drop_pdays_clean":
            return self.sentinel.clean
        if pdays_features == "drop_prev_contacted":
            return self.sentinel.flag
        return None


# --- fixed values -----------------------------------------------------------
# The bank telemarketing table: column order and types of the raw CSV, the
# numeric and categorical column lists, the cap (34) and the sentinel
# (pdays = -1).  These must equal the original pipeline's for equal results.
BANK = TableSpec(
    name="bank",
    columns=(
        ("age", "int"),
        ("job", "string"),
        ("marital", "string"),
        ("education", "string"),
        ("default", "string"),
        ("balance", "int"),
        ("housing", "string"),
        ("loan", "string"),
        ("contact", "string"),
        ("day", "int"),
        ("month", "string"),
        ("duration", "int"),
        ("campaign", "int"),
        ("pdays", "int"),
        ("previous", "int"),
        ("poutcome", "string"),
        ("y", "string"),
    ),
    target="y",
    positive="yes",
    numeric=("age", "balance", "day", "duration", "campaign", "pdays", "previous"),
    categorical=(
        "job",
        "marital",
        "education",
        "default",
        "housing",
        "loan",
        "contact",
        "month",
        "poutcome",
    ),
    caps={"campaign": 34, "previous": 34},
    sentinel=Sentinel("pdays", -1, "prev_contacted", "pdays_clean"),
    leakage="duration",
    feature_numeric=(
        "age",
        "balance",
        "day",
        "campaign",
        "previous",
        "pdays_clean",
        "prev_contacted",
    ),
    hist_cols=("age", "balance", "campaign"),
)

# The contact-shaped view derived from orders and customer (FIXTURES.md §6).
# Caps 5 / 10 are chosen so that they bite on this data.
CONTACTS = TableSpec(
    name="contacts",
    columns=(
        ("contact_id", "bigint"),
        ("age", "int"),
        ("job", "string"),
        ("education", "string"),
        ("balance", "int"),
        ("day", "int"),
        ("month_no", "int"),
        ("duration", "int"),
        ("campaign", "int"),
        ("previous", "int"),
        ("pdays", "int"),
        ("poutcome", "string"),
        ("y", "string"),
    ),
    target="y",
    positive="yes",
    numeric=("age", "balance", "day", "month_no", "duration", "campaign", "pdays", "previous"),
    categorical=("job", "education", "poutcome"),
    caps={"campaign": 5, "previous": 10},
    sentinel=Sentinel("pdays", -1, "prev_contacted", "pdays_clean"),
    leakage="duration",
    feature_numeric=(
        "age",
        "balance",
        "day",
        "month_no",
        "campaign",
        "previous",
        "pdays_clean",
        "prev_contacted",
    ),
    hist_cols=("age", "balance", "campaign"),
    key="contact_id",
)
