"""Data-quality checks: each one is a query for violating rows, empty means pass.

``run_checks`` evaluates a whole suite as one DataFrame. Checks that look at single rows are fused:
all of a table's not-null, accepted-value and predicate checks cost one scan of that table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from hourlake.functions import ntz

ERROR, WARN = "error", "warn"
Tables = Mapping[str, DataFrame]

#: Prefix that tells check outcomes from other build results.
CHECK_PREFIX = "test."


@dataclass(frozen=True)
class Check:
    """``violations`` gives the offending rows. ``row_test`` is set if a row alone decides."""

    name: str
    table: str
    violations: Callable[[Tables], DataFrame]
    severity: str = ERROR
    row_test: Column | None = None

    def __post_init__(self) -> None:
        if self.severity not in (ERROR, WARN):
            raise ValueError(f"unknown severity {self.severity!r}")

    @property
    def unique_id(self) -> str:
        return f"{CHECK_PREFIX}{self.table}.{self.name}"


# -- violation queries --------------------------------------------------------------------------


def not_unique(df: DataFrame, *cols: str) -> DataFrame:
    """Values (or combinations) that occur more than once; NULLs of a single column are no value."""
    rows = df.dropna(subset=[cols[0]]) if len(cols) == 1 else df
    return rows.groupBy(*cols).agg(F.count("*").alias("n_records")).filter("n_records > 1")


def unexpected_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Distinct non-NULL values outside the list, with their row counts."""
    return df.filter(~F.col(col).isin(*values)).groupBy(col).agg(F.count("*").alias("n_records"))


def orphans(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-NULL child values without a parent row, with their row counts.

    Both sides are reduced to distinct keys first, so no key is heavy on either side of the join.
    """
    keys = child.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n_records"))
    return keys.join(parent.select(F.col(field).alias(col)).distinct(), col, "left_anti")


# -- declarations -------------------------------------------------------------------------------


def row_check(name: str, table: str, violated: Column, severity: str = ERROR) -> Check:
    return Check(name, table, lambda t: t[table].filter(violated), severity, violated)


def not_null(table: str, col: str, severity: str = ERROR) -> Check:
    return row_check(f"not_null_{col}", table, F.col(col).isNull(), severity)


def accepted_values(table: str, col: str, values: Sequence, severity: str = ERROR) -> Check:
    return Check(
        f"accepted_values_{col}",
        table,
        lambda t: unexpected_values(t[table], col, values),
        severity,
        ~F.col(col).isin(*values),
    )


def unique(table: str, *cols: str, severity: str = ERROR) -> Check:
    return Check(f"unique_{'_'.join(cols)}", table, lambda t: not_unique(t[table], *cols), severity)


def relationships(table: str, col: str, to: str, field: str, severity: str = ERROR) -> Check:
    return Check(
        f"relationships_{col}", table, lambda t: orphans(t[table], col, t[to], field), severity
    )


# -- running ------------------------------------------------------------------------------------

_OUTCOME = ("unique_id", "severity", "violations")


STATES = "unique_id string, violations bigint"


def row_states(checks: Sequence[Check], table: str, rows: DataFrame, by: str) -> DataFrame:
    """``unique_id, violations, <by>``: violations of the table's row-level checks for each value of ``by``, in one scan.

    Such counts add up, so they can be stored by partition and only partitions that change need to be looked at again.
    Values of ``by`` without any violation have rows too (their counts are zero).
    """
    fused = [c for c in checks if c.table == table and c.row_test is not None]
    counts = rows.groupBy(by).agg(*[F.count_if(c.row_test).alias(f"c{i}") for i, c in enumerate(fused)])
    each = F.array(*[F.struct(F.lit(c.unique_id).alias("unique_id"), F.col(f"c{i}").alias("violations")) for i, c in enumerate(fused)])
    return counts.select(F.inline(each), by).select("unique_id", "violations", by)


def run_checks(checks: Sequence[Check], tables: Tables, states: Tables | None = None) -> DataFrame:
    """``unique_id, severity, violations, status`` per check; status is pass, warn or fail.

    ``states``: stored ``row_states`` of some tables, whose row-level checks are then summed up instead of evaluated.
    """
    states = states or {}
    if not checks:
        raise ValueError("no checks given")
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        if c.row_test is not None:
            by_table.setdefault(c.table, []).append(c)
        else:
            parts.append(
                c.violations(tables)
                .agg(F.count("*").alias("violations"))
                .select(F.lit(c.unique_id).alias("unique_id"), F.lit(c.severity).alias("severity"), "violations")
            )
    for table, fused in by_table.items():
        if table in states:
            is_check = [F.col("unique_id") == c.unique_id for c in fused]
            sums = [F.coalesce(F.sum(F.when(hit, F.col("violations"))), F.lit(0)) for hit in is_check]
            counts = states[table].agg(*[s.alias(f"c{i}") for i, s in enumerate(sums)])
        else:
            counts = tables[table].agg(*[F.count_if(c.row_test).alias(f"c{i}") for i, c in enumerate(fused)])
        rows = F.array(
            *[
                F.struct(
                    F.lit(c.unique_id).alias("unique_id"),
                    F.lit(c.severity).alias("severity"),
                    F.col(f"c{i}").alias("violations"),
                )
                for i, c in enumerate(fused)
            ]
        )
        parts.append(counts.select(F.explode(rows).alias("r")).select(*[f"r.{c}" for c in _OUTCOME]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = (
        F.when(F.col("violations") == 0, "pass").when(F.col("severity") == WARN, "warn").otherwise("fail")
    )
    return out.withColumn("status", status)


def summarise(outcomes: DataFrame, now: datetime, run_id: str) -> DataFrame:
    """One row of totals; only check outcomes count, and no outcomes at all give no row."""
    s = F.col("status")
    is_check = F.col("unique_id").startswith(CHECK_PREFIX)
    return (
        outcomes.agg(
            F.count("*").alias("_any"),
            F.count_if(is_check).alias("total_tests"),
            F.count_if(is_check & (s == "pass")).alias("passed_tests"),
            F.count_if(is_check & (s == "warn")).alias("warned_tests"),
            F.count_if(is_check & s.isin("fail", "error")).alias("failed_tests"),
        )
        .filter("_any > 0")
        .select(
            F.lit(run_id).alias("run_id"),
            ntz(now).alias("recorded_at"),
            "total_tests",
            "passed_tests",
            "warned_tests",
            "failed_tests",
        )
    )


class ChecksFailed(Exception):
    """At least one check of severity ``error`` found violations."""


def raise_on_failure(outcomes: DataFrame) -> None:
    """Raise if a check failed; warnings pass. Reads one row per check."""
    bad = [r["unique_id"] for r in outcomes.filter(F.col("status") == "fail").collect()]
    if bad:
        raise ChecksFailed(", ".join(sorted(bad)))
