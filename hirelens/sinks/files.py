"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hirelens.operators.cleaning import high_value
from hirelens.schema import EXPORT_COLUMNS, to_source_keys


def write_json(df: DataFrame, path: str, source_keys: bool = True, mode: str = "overwrite") -> None:
    """Rows as JSON lines, UTF-8 unescaped (K1, K5)."""
    (to_source_keys(df) if source_keys else df).write.mode(mode).json(path)


def write_high_value(cleaned: DataFrame, path: str, source_keys: bool = True) -> None:
    """The rows with a value tag (K2)."""
    write_json(high_value(cleaned), path, source_keys)


def write_report(report: DataFrame, path: str) -> None:
    """The run report, (metric, value) rows of a bounded number (K3)."""
    report.coalesce(1).write.mode("overwrite").json(path)


def export_projection(df: DataFrame, source_keys: bool = True) -> DataFrame:
    """The 18 columns of the flat export, other columns left out."""
    flat = df.select(*EXPORT_COLUMNS)
    return to_source_keys(flat) if source_keys else flat


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header, quotes doubled, line breaks and outer blanks kept (K4, R14). No BOM."""
    exact = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(**exact).csv(path)


def export_csv(df: DataFrame, path: str, source_keys: bool = True) -> None:
    write_csv(export_projection(df, source_keys), path)


def write_tsv(df: DataFrame, path: str, replace: bool = False) -> None:
    """Tab-separated result directory: refuse an existing one (K6) or replace it (K7)."""
    mode = "overwrite" if replace else "errorifexists"
    df.write.mode(mode).option("sep", "\t").option("emptyValue", "").csv(path)
