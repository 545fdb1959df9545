"""Data-quality checks: failing rows as DataFrames, and one result row per check.

A check passes when it has no failing rows. NULL passes every value check except ``not_null``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.sources import sinks

ROW_KINDS = ("not_null", "accepted_values", "accepted_range")
FAILED, TAG = "failed_check", "failed_checks"
RESULT_COLUMNS = ("table_name", "check_name", "severity", "blocking", "violations", "passed")


@dataclass(frozen=True)
class Check:
    table: str
    kind: str
    columns: tuple[str, ...] = ()
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    inclusive: bool = True
    parent: str | None = None
    parent_column: str | None = None
    severity: str = "error"
    blocking: bool = False

    @property
    def name(self) -> str:
        return "_".join((self.kind, *self.columns, *([self.parent] if self.parent else [])))


def not_null(table: str, column: str, **options) -> Check:
    return Check(table, "not_null", (column,), **options)


def unique(table: str, column: str, **options) -> Check:
    return Check(table, "unique", (column,), **options)


def unique_combination(table: str, columns: Sequence[str], **options) -> Check:
    return Check(table, "unique_combination", tuple(columns), **options)


def accepted_values(table: str, column: str, values: Sequence, **options) -> Check:
    return Check(table, "accepted_values", (column,), values=tuple(values), **options)


def accepted_range(table: str, column: str, low=None, high=None, **options) -> Check:
    """Also the "between" check: ``inclusive=False`` makes both bounds strict."""
    return Check(table, "accepted_range", (column,), low=low, high=high, **options)


def relationship(table: str, column: str, parent: str, parent_column: str, **options) -> Check:
    return Check(
        table, "relationship", (column,), parent=parent, parent_column=parent_column, **options
    )


def equal_rowcount(table: str, other: str, **options) -> Check:
    return Check(table, "equal_rowcount", parent=other, **options)


def row_violation(check: Check) -> Column:
    """Condition that a failing row meets."""
    column = F.col(check.columns[0])
    if check.kind == "not_null":
        return column.isNull()
    if check.kind == "accepted_values":
        return ~column.isin(*check.values)
    if check.low is None and check.high is None:
        raise ValueError(f"{check.name} needs a bound")
    outside = []
    if check.low is not None:
        outside.append(column < check.low if check.inclusive else column <= check.low)
    if check.high is not None:
        outside.append(column > check.high if check.inclusive else column >= check.high)
    return reduce(lambda a, b: a | b, outside)


def failing_rows(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    df = tables[check.table]
    if check.kind in ROW_KINDS:
        return df.where(row_violation(check))
    if check.kind in ("unique", "unique_combination"):
        if check.kind == "unique":
            df = df.where(F.col(check.columns[0]).isNotNull())
        return df.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")
    if check.kind == "relationship":
        return _orphans(df.where(F.col(check.columns[0]).isNotNull()), check, tables)
    if check.kind == "equal_rowcount":
        here = df.agg(F.count(F.lit(1)).alias("rows_here"))
        there = tables[check.parent].agg(F.count(F.lit(1)).alias("rows_there"))
        return here.crossJoin(F.broadcast(there)).where("rows_here <> rows_there")
    raise ValueError(f"unknown check {check.kind}")


def _orphans(children: DataFrame, check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    parents = tables[check.parent].select(F.col(check.parent_column).alias("__parent"))
    return children.join(parents, F.col(check.columns[0]) == F.col("__parent"), "left_anti")


def violation_count(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Failing rows of a check that needs its own pass, as one number."""
    if check.kind == "relationship":
        # One row per key meets the parent table, so a key that fills the child table costs one row.
        keys = tables[check.table].where(F.col(check.columns[0]).isNotNull()).groupBy(*check.columns)
        counted = keys.agg(F.count(F.lit(1)).alias("n_records"))
        return _orphans(counted, check, tables).agg(
            F.coalesce(F.sum("n_records"), F.lit(0)).alias("violations")
        )
    return failing_rows(check, tables).agg(F.count(F.lit(1)).alias("violations"))


def _result(check: Check, violations: Column) -> Column:
    return F.struct(
        F.lit(check.table).alias("table_name"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.severity).alias("severity"),
        F.lit(check.blocking).alias("blocking"),
        violations.cast("bigint").alias("violations"),
        (violations == 0).alias("passed"),
    )


def check_table(checks: Iterable[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Results of all checks of one table. Its row checks share a single scan."""
    checks = list(checks)
    by_row = [c for c in checks if c.kind in ROW_KINDS]
    parts = []
    if by_row:
        counts = tables[by_row[0].table].agg(
            *[F.count_if(row_violation(c)).alias(f"n{i}") for i, c in enumerate(by_row)]
        )
        rows = F.array(*[_result(c, F.col(f"n{i}")) for i, c in enumerate(by_row)])
        parts.append(counts.select(F.inline(rows)))
    for check in checks:
        if check.kind not in ROW_KINDS:
            parts.append(
                violation_count(check, tables).select(F.inline(F.array(_result(check, F.col("violations")))))
            )
    return reduce(DataFrame.unionByName, parts)


def with_tag(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``df`` with a column of one bit per row check that a row fails, to be written along with the rows.

    Nearly all tags are zero, so the column takes no room, and statistics tell which parts of a table have none.
    """
    bits = [F.when(row_violation(c), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, c in enumerate(checks)]
    return df.withColumn(TAG, reduce(lambda a, b: a + b, bits, F.lit(0).cast("bigint")))


def check_tags(tagged: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Results of the row checks of a table that was written with its tags: of it only failing parts are read."""
    counts = tagged.where(F.col(TAG) > 0).agg(
        *[F.count_if(F.col(TAG).bitwiseAND(1 << i) > 0).alias(f"n{i}") for i in range(len(checks))]
    )
    return counts.select(F.inline(F.array(*[_result(c, F.col(f"n{i}")) for i, c in enumerate(checks)])))


def run_checks(checks: Iterable[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check: table, check, severity, blocking, violations, passed."""
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        by_table.setdefault(check.table, []).append(check)
    return reduce(DataFrame.unionByName, [check_table(c, tables) for c in by_table.values()])


def blocked(results: DataFrame) -> DataFrame:
    """Results that must stop the run: failed, blocking, and of severity error."""
    return results.where(~F.col("passed") & F.col("blocking") & (F.col("severity") == "error"))


def store_failures(check: Check, tables: Mapping[str, DataFrame], folder: str) -> str:
    """Write the failing rows to the ``test_failures`` layer and return the path."""
    return sinks.write_table(
        failing_rows(check, tables), folder, "test_failures", f"{check.table}_{check.name}"
    )


def store_row_failures(checks: Sequence[Check], df: DataFrame, folder: str) -> dict[Check, str]:
    """Write the failing rows of several row checks of a table in one pass; returns the path of each.

    A row that fails several checks is stored under each of them.
    """
    table = checks[0].table
    names = F.array_compact(F.array(*[F.when(row_violation(c), F.lit(c.name)) for c in checks]))
    tagged = df.where(reduce(lambda a, b: a | b, map(row_violation, checks))).withColumn(FAILED, F.explode(names))
    path = f"{folder}/test_failures/{table}"
    tagged.write.mode("overwrite").partitionBy(FAILED).parquet(path)
    return {c: f"{path}/{FAILED}={c.name}" for c in checks}


def freshness(
    df: DataFrame, column: str, now: datetime, warn_after_days: int, error_after_days: int
) -> DataFrame:
    """Age of the newest row against a given clock: status pass, warn or error.

    A limit is passed by any time beyond it; ``age_days`` are whole days, for reading only.
    """
    clock = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")

    def older_than(days: int) -> Column:
        return F.col("newest") < clock - F.make_dt_interval(days=F.lit(days))

    status = (
        F.when(F.col("newest").isNull() | older_than(error_after_days), "error")
        .when(older_than(warn_after_days), "warn")
        .otherwise("pass")
    )
    age = F.timestamp_diff("DAY", F.col("newest"), clock)
    return df.agg(F.max(column).alias("newest")).select(
        "newest", age.cast("bigint").alias("age_days"), status.alias("status")
    )
