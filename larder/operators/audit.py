"""Checks that return what violates a rule.

Keys are counted before they are compared with anything, so a key that fills a third of a table
reaches each join once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.schemas import FOREIGN_KEYS, MAX_LENGTHS, REQUIRED, UNIQUE_KEYS

Bounds = dict[str, tuple[float, float]]


def _counts_by_column(df: DataFrame, violations: dict[str, Column], count: str) -> DataFrame:
    """One pass over the frame, then one row per column with its number of violations."""
    totals = df.agg(*[F.count_if(condition).alias(name) for name, condition in violations.items()])
    return totals.unpivot([], [f"`{name}`" for name in violations], "column_name", count)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-NULL child keys without a parent, with their number of rows."""
    keys = child.where(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_key).alias(child_key))
    return keys.join(known, child_key, "left_anti")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _counts_by_column(df, {c: F.col(f"`{c}`").isNull() for c in columns}, "n_null")


def out_of_bounds_counts(df: DataFrame, bounds: Bounds) -> DataFrame:
    """Per column, the number of values outside their range; NULL is not outside."""
    outside = {c: ~F.col(f"`{c}`").between(low, high) for c, (low, high) in bounds.items()}
    return _counts_by_column(df, outside, "n_outside")


def too_long_counts(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    return _counts_by_column(df, {c: F.length(f"`{c}`") > n for c, n in limits.items()}, "n_too_long")


def bad_intervals(df: DataFrame, start: str = "effective_from", end: str = "effective_to") -> DataFrame:
    """Rows whose interval does not end after it starts."""
    return df.where(~(F.col(end) > F.col(start)))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n")) for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def row_violations(df: DataFrame, table: str) -> DataFrame:
    """All checks of single rows of a table of the star, in one pass: missing values, too long texts, bad intervals."""
    checks = [("not null", c, F.col(c).isNull()) for c in REQUIRED[table]]
    checks += [("length", c, F.length(c) > limit) for c, limit in MAX_LENGTHS.get(table, {}).items()]
    if table == "dim_product":
        ends_late = F.col("effective_to") > F.col("effective_from")
        checks.append(("interval", "effective_from,effective_to", ~ends_late))
    totals = df.agg(*[F.count_if(broken).alias(f"n{i}") for i, (_, _, broken) in enumerate(checks)])
    found = [
        F.struct(F.lit(check).alias("check"), F.lit(columns).alias("columns"), F.col(f"n{i}").alias("n"))
        for i, (check, columns, _) in enumerate(checks)
    ]
    return totals.select(F.explode(F.array(*found)).alias("one")).select(
        "one.check", F.lit(table).alias("table_name"), "one.columns", F.col("one.n").alias("violations")
    )


def _key_sets() -> list[tuple[str, tuple[str, ...]]]:
    """Every key that must be unique or that other tables point to, as table and columns."""
    parents = [(parent, (key,)) for _, _, parent, key in FOREIGN_KEYS]
    return list(dict.fromkeys([(table, key) for table, keys in UNIQUE_KEYS.items() for key in keys] + parents))


def key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Unique and foreign keys of the star, from one scan per table.

    A row sends each of its keys once, marked with the set it belongs to and with its role there: 0 in the table that owns the key, else the
    number of the foreign key. Keys are counted by role within map tasks first, so a hot key is one row per task, and the same counts answer for
    uniqueness and for all children.
    """
    sets = _key_sets()
    children = {i: [] for i in range(len(sets))}
    sent = {table: [] for table in tables}
    checks = []

    def send(table: str, columns: Sequence[str], number: int, role: int) -> None:
        kinds = dict(tables[table].dtypes)
        texts = [c for c in columns if kinds[c] == "string"]
        numbers = [F.col(c).cast("long") for c in columns if c not in texts] + [F.lit(None).cast("long")] * 2
        text = F.col(texts[0]) if texts else F.lit(None).cast("string")
        key = F.struct(
            F.lit(number).alias("set"), F.lit(role).alias("role"), numbers[0].alias("k1"), numbers[1].alias("k2"), text.alias("text")
        )
        # A child without a key points nowhere.
        sent[table].append(F.when(F.col(columns[0]).isNotNull(), key) if role else key)

    for number, (table, columns) in enumerate(sets):
        send(table, columns, number, 0)
        if columns in UNIQUE_KEYS[table]:
            checks.append(("unique", table, ",".join(columns), number, 0))
    for child, column, parent, key in FOREIGN_KEYS:
        number = sets.index((parent, (key,)))
        children[number].append(column)
        send(child, (column,), number, len(children[number]))
        checks.append(("foreign key", child, column, number, len(children[number])))

    roles = range(1 + max(map(len, children.values())))
    keys = [
        tables[table].select(F.explode(F.array_compact(F.array(*entries))).alias("key")).select("key.*")
        for table, entries in sent.items()
        if entries
    ]
    counts = reduce(DataFrame.unionByName, keys).groupBy("set", "k1", "k2", "text").agg(
        *[F.count_if(F.col("role") == role).alias(f"n{role}") for role in roles]
    )
    surplus = F.sum(F.when(F.col("n0") > 1, F.col("n0") - 1))
    orphans = [F.sum(F.when(F.col("n0") == 0, F.col(f"n{role}"))) for role in roles[1:]]
    totals = counts.groupBy("set").agg(F.array(surplus, *orphans).alias("violations"))
    # Some twenty rows, known beforehand: a key set of empty tables has none among the totals.
    known = [
        F.struct(*[F.lit(v).alias(name) for name, v in zip(("check", "table_name", "columns", "set", "role"), check)]) for check in checks
    ]
    rows = totals.sparkSession.range(1).select(F.inline(F.array(*known)))
    found = F.coalesce(F.get("violations", F.col("role")), F.lit(0))
    return rows.join(totals, "set", "left").select("check", "table_name", "columns", found.alias("violations"))


def star_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Every declared constraint of the star with its number of violations; all zero when sound. Two scans per table."""
    return reduce(DataFrame.unionByName, [key_violations(tables), *(row_violations(tables[table], table) for table in REQUIRED)])


def silver_checks(metrics: DataFrame) -> DataFrame:
    """Metrics row with its verdicts: rows exist, nearly all have a code, the score is there."""
    share = F.try_divide(F.col("rows_with_code"), F.col("rows_total"))
    return metrics.withColumns(
        {
            "has_rows": F.col("rows_total") > 0,
            "codes_complete": F.coalesce(share >= 0.99, F.lit(False)),
            "has_score": F.col("avg_completeness_score").isNotNull(),
        }
    )


def layer_profile(df: DataFrame, layer: str, key: str, bounds: dict[str, Column], limits: Bounds) -> DataFrame:
    """Volume, surplus rows per key and out-of-range values of one layer, as one row.

    Rows are counted per key first; the totals come from those counts.
    """
    outside = {
        f"{name}_outside": F.count_if(~value.between(*limits[name])) for name, value in bounds.items()
    }
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("__n"), *[c.alias(name) for name, c in outside.items()]
    )
    return per_key.agg(
        F.lit(layer).alias("layer"),
        F.sum("__n").alias("n_rows"),
        F.sum(F.col("__n") - 1).alias("n_surplus"),
        *[F.sum(name).alias(name) for name in outside],
    )


