"""The profiling report job: cleaned table → summary, balance, histograms, correlation.

One scan for the summary, one for the class balance, two for all histograms
(min/max, then bins) and one for the correlation matrix; the cleaned frame is
a projection over the source, so every scan reads only the columns it needs.
Report tables are written as CSV with a header (one file each: they are a few
rows).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from labelkit.operators import clean as C
from labelkit.operators import profile as P
from labelkit.sources.files import write_table
from labelkit.spec import TableSpec


@dataclass
class ProfileReport:
    summary: DataFrame
    balance: DataFrame
    histograms: DataFrame
    correlation: DataFrame | None


def profile_tables(
    raw: DataFrame,
    spec: TableSpec,
    keep_leakage: bool = False,
    pdays_features: str = "both",
    bins: int = 20,
) -> ProfileReport:
    """The report tables as DataFrames (lazy except the histogram bounds)."""
    df = C.clean(raw, spec, keep_leakage=keep_leakage, include_label=True)
    _, nums = spec.features(keep_leakage, pdays_features)
    corr_cols = [c for c in nums + [spec.label] if c in df.columns]
    return ProfileReport(
        summary=P.dataset_summary(df, keep_leakage),
        balance=P.class_balance(df, spec.label),
        histograms=P.histogram(df, spec.histogram_columns(keep_leakage), bins=bins, dense=True),
        correlation=P.correlation(df, corr_cols) if len(corr_cols) >= 2 else None,
    )


def run_profile(
    raw: DataFrame,
    spec: TableSpec,
    report_dir: str,
    keep_leakage: bool = False,
    pdays_features: str = "both",
) -> ProfileReport:
    """Write ``dataset_summary``, ``class_balance``, ``histograms`` and
    ``correlation`` tables under ``report_dir``."""
    rep = profile_tables(raw, spec, keep_leakage, pdays_features)
    base = report_dir.rstrip("/")
    write_table(rep.summary, f"{base}/dataset_summary", single_file=True)
    write_table(rep.balance, f"{base}/class_balance", single_file=True)
    write_table(rep.histograms, f"{base}/histograms", single_file=True)
    if rep.correlation is not None:
        write_table(rep.correlation, f"{base}/correlation", single_file=True)
    return rep
