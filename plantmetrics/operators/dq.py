"""Data-quality rules as Spark jobs over whole tables.

Each rule returns the violating rows (or keys); ``dq_report`` evaluates all rules of a table, the
uniqueness rules too, in one scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Key values that occur more than once (NULL keys are not_null's business)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def unique_combination(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def _in_range(col: Column, lo, hi) -> Column:
    return (col >= F.lit(lo)) & (col <= F.lit(hi))


def accepted_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Rows whose value lies outside [lo, hi] (inclusive); NULL passes."""
    return df.where(~_in_range(F.col(col), lo, hi))


def accepted_values(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """Rows whose value is not in the list; NULL passes."""
    return df.where(~F.col(col).isin(values))


def foreign_key(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent row (anti join)."""
    pk = parent_key or key
    return child.join(parent.select(F.col(pk).alias(key)).distinct(), key, "left_anti")


def oee_bounds(oee: DataFrame) -> DataFrame:
    """Rows where OEE or a component rate lies outside [0, 1], or OEE is NULL."""
    rates = ["oee", "availability_rate", "performance_rate", "quality_rate"]
    bad = F.col("oee").isNull()
    for r in rates:
        bad = bad | (F.col(r) < 0) | (F.col(r) > 1)
    return oee.where(bad).select("machine_id", "shift_date", "availability_rate", "performance_rate",
                                 "quality_rate", "oee")


@dataclass
class TableRules:
    name: str
    not_null: list[str] = field(default_factory=list)
    ranges: dict[str, tuple] = field(default_factory=dict)
    values: dict[str, list[str]] = field(default_factory=dict)
    unique: list[str] = field(default_factory=list)
    unique_combos: list[list[str]] = field(default_factory=list)


def dq_rules() -> list[TableRules]:
    """The rules that the marts and sources are held to."""
    rate = (0, 1)
    return [
        TableRules("oee_daily", not_null=["machine_id", "shift_date", "availability_rate", "performance_rate",
                                          "quality_rate", "oee"],
                   ranges={"availability_rate": rate, "performance_rate": rate, "quality_rate": rate, "oee": rate},
                   unique_combos=[["machine_id", "shift_date"]]),
        TableRules("machine_health", not_null=["machine_id", "reading_date", "anomaly_flag"],
                   unique_combos=[["machine_id", "reading_date"]]),
        TableRules("production_summary", not_null=["machine_id", "week_start", "avg_oee"], ranges={"avg_oee": rate}),
        TableRules("maintenance_recommendations", not_null=["rec_id", "machine_id", "root_cause",
                                                            "recommended_action", "confidence",
                                                            "estimated_hours_to_failure"],
                   ranges={"estimated_hours_to_failure": (1, 720)},
                   values={"confidence": ["HIGH", "MEDIUM", "LOW"]}, unique=["rec_id"]),
        TableRules("defects", not_null=["defect_id", "order_id"], unique=["defect_id"]),
    ]


def _one_scan(df: DataFrame, r: TableRules) -> DataFrame:
    """(rule, failures) of one table from a single aggregate over grouping sets: the empty set carries the row
    rules, one set per uniqueness rule the groups of its key. Row rules are counted in flags that only the
    empty set's group sums up, and map tasks aggregate before the one exchange by set and key."""
    rules = {f"not_null({c})": F.col(c).isNull() for c in r.not_null}
    rules |= {f"accepted_range({c},{lo},{hi})": ~_in_range(F.col(c), lo, hi) for c, (lo, hi) in r.ranges.items()}
    rules |= {f"accepted_values({c})": ~F.col(c).isin(vals) for c, vals in r.values.items()}
    keys = {f"unique({c})": [c] for c in r.unique}
    keys |= {f"unique_combination({','.join(cols)})": cols for cols in r.unique_combos}
    counts = [F.count_if(bad).alias(name) for name, bad in rules.items()]
    if not keys:
        one = df.agg(*counts)
    else:
        columns = list(dict.fromkeys(c for cols in keys.values() for c in cols))
        # copies of the key columns are what the sets null out, so the rules see the rows as they are
        copies = {c: f"_key_{i}" for i, c in enumerate(columns)}
        rows = df.select("*", *[F.col(c).alias(k) for c, k in copies.items()])
        sets = [[], *dict.fromkeys(tuple(copies[c] for c in cols) for cols in keys.values())]
        groups = rows.groupingSets([[F.col(k) for k in s] for s in sets], *copies.values()).agg(
            F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n"), *counts)

        def number(cols):           # a bit per key column, 1 where the set leaves it out
            return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in cols)

        whole = F.col("_set") == number([])
        out = [F.coalesce(F.sum(F.when(whole, F.col(f"`{name}`"))), F.lit(0)).alias(name) for name in rules]
        for name, cols in keys.items():
            twice = (F.col("_set") == number(cols)) & (F.col("_n") > 1)
            if name.startswith("unique("):      # a null key is not_null's business
                twice = twice & F.col(copies[cols[0]]).isNotNull()
            out.append(F.count_if(twice).alias(name))
        one = groups.agg(*out)
    return one.unpivot([], one.columns, "rule", "failures").select(
        F.lit(r.name).alias("table_name"), "rule", F.col("failures").cast("long").alias("failures"))


def dq_report(tables: dict[str, DataFrame], rules: list[TableRules]) -> DataFrame:
    """(table_name, rule, failures) for every rule; each table is scanned once."""
    parts = [_one_scan(tables[r.name], r) for r in rules if r.not_null or r.ranges or r.values or r.unique or r.unique_combos]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) for each table, as a union of one-row counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
