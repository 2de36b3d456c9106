"""Declarative data checks: failing rows or groups against severity thresholds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def failing_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull()).select(F.count(F.lit(1)).alias("failures"))


def failing_unique(df: DataFrame, columns: list[str], ignore_null: bool = True) -> DataFrame:
    """Number of key values held by more than one row; counts are combined before the shuffle."""
    if ignore_null and len(columns) == 1:
        df = df.where(F.col(columns[0]).isNotNull())
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return groups.select(F.count(F.lit(1)).alias("failures"))


@dataclass(frozen=True)
class Check:
    """kind: not_null, unique or unique_combination. Status is the worst threshold passed."""

    table: str
    kind: str
    columns: tuple[str, ...]
    severity: str = "error"
    warn_above: int = 0
    error_above: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}({self.table}: {', '.join(self.columns)})"

    def failing(self, df: DataFrame) -> DataFrame:
        if self.kind == "not_null":
            return failing_not_null(df, self.columns[0])
        return failing_unique(df, list(self.columns), self.kind == "unique")

    def status_column(self, failures: Column) -> Column:
        """status() as an expression."""
        worst = F.when(failures > self.warn_above, "warn").otherwise("pass")
        return F.when(failures > self.error_above, "error").otherwise(worst) if self.severity == "error" else worst

    def status(self, failures: int) -> str:
        if self.severity == "error" and failures > self.error_above:
            return "error"
        return "warn" if failures > self.warn_above else "pass"


@dataclass(frozen=True)
class CheckResult:
    check: Check
    failures: int
    status: str


def run_check(check: Check, df: DataFrame) -> CheckResult:
    n = check.failing(df).first()["failures"]
    return CheckResult(check, n, check.status(n))


def run_not_nulls(checks: list[Check], df: DataFrame) -> list[CheckResult]:
    """All not_null checks of a table in one scan."""
    if not checks:
        return []
    row = df.agg(*[F.count_if(F.col(c.columns[0]).isNull()).alias(f"c{i}") for i, c in enumerate(checks)]).first()
    return [CheckResult(c, row[f"c{i}"], c.status(row[f"c{i}"])) for i, c in enumerate(checks)]
