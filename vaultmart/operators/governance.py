"""Governance: row filter, column masks, governed views, policy drift.

Open-source Spark has no ``SET ROW FILTER`` / ``SET MASK`` and no group
membership function, so policies are a registry applied as DataFrame
transforms for an explicit set of principal groups; the result is what a
governed view of the table returns for that caller.  Everything is
column expressions plus, for facts without the filtered column, a
``left_semi`` join to the filtered dimension.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Regional groups (in evaluation order) and the states each sees.
REGION_STATES = {
    "regional_manager_northeast": ("NY", "NJ", "PA", "MA", "CT", "RI", "NH", "VT", "ME"),
    "regional_manager_south": ("TX", "FL", "GA", "NC", "SC", "VA", "TN", "AL", "MS", "LA", "AR", "KY", "WV", "OK"),
    "regional_manager_midwest": ("IL", "OH", "MI", "IN", "WI", "MN", "IA", "MO", "KS", "NE", "SD", "ND"),
    "regional_manager_west": ("CA", "WA", "OR", "AZ", "NV", "CO", "UT", "NM", "ID", "MT", "WY", "AK", "HI"),
}
PHI_REVIEWERS = "phi_reviewers"
CREDENTIALING_TEAM = "credentialing_team"
WITHHELD = "WITHHELD"


def visible_states(groups: Iterable[str]) -> tuple[str, ...] | None:
    """States the caller may see; ``None`` means every row (first matching group wins)."""
    gs = set(groups)
    for group, states in REGION_STATES.items():
        if group in gs:
            return states
    return None


# G1
def region_filter(df: DataFrame, groups: Iterable[str], state_col: str = "practice_state") -> DataFrame:
    states = visible_states(groups)
    return df if states is None else df.where(F.col(state_col).isin(*states))


# G2
def mask_birth_date(col: str | Column, groups: Iterable[str]) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c if PHI_REVIEWERS in set(groups) else F.trunc(c, "year")


# G3
def mask_race_code(col: str | Column, groups: Iterable[str]) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c if PHI_REVIEWERS in set(groups) else F.lit(WITHHELD)


# G4
def mask_provider_name(col: str | Column, groups: Iterable[str]) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c if CREDENTIALING_TEAM in set(groups) else F.concat(F.substring(c, 1, 1), F.lit("."))


@dataclass(frozen=True)
class Policy:
    table: str
    row_filter_column: str | None = None
    masks: dict = field(default_factory=dict)     # column -> mask function name


MASKS = {"mask_birth_date": mask_birth_date, "mask_race_code": mask_race_code,
         "mask_provider_name": mask_provider_name}

# Policy bindings
POLICIES = {
    "dim_provider": Policy("dim_provider", "practice_state",
                           {"provider_first_name": "mask_provider_name", "provider_last_name": "mask_provider_name"}),
    "dim_member": Policy("dim_member", None, {"birth_date": "mask_birth_date", "race_code": "mask_race_code"}),
}


def governed(df: DataFrame, table: str, groups: Sequence[str]) -> DataFrame:
    """The table as the caller in ``groups`` sees it."""
    p = POLICIES.get(table)
    if p is None:
        return df
    if p.row_filter_column:
        df = region_filter(df, groups, p.row_filter_column)
    if p.masks:
        df = df.withColumns({c: MASKS[m](c, groups) for c, m in p.masks.items()})
    return df


# G6
def governed_fact(fact: DataFrame, dim_provider: DataFrame, groups: Sequence[str],
                  key: str = "provider_hk") -> DataFrame:
    """Facts lack the state column: keep rows whose provider the caller may see."""
    if visible_states(groups) is None:
        return fact
    allowed = governed(dim_provider, "dim_provider", groups).select(key)
    return fact.join(allowed, key, "left_semi")


# G1-G5 as plain SQL: functions, a session variable with the caller's groups, governed views
GROUPS_VARIABLE = "principal_groups"


def _sql_functions() -> list[str]:
    quoted = lambda xs: ", ".join(f"'{x}'" for x in xs)
    regions = " ".join(f"WHEN array_contains(groups, '{g}') THEN state IN ({quoted(states)})" for g, states in REGION_STATES.items())
    return [
        f"FUNCTION provider_region_filter(state STRING, groups ARRAY<STRING>) RETURNS BOOLEAN RETURN CASE {regions} ELSE true END",
        f"FUNCTION mask_birth_date(d DATE, groups ARRAY<STRING>) RETURNS DATE RETURN CASE WHEN array_contains(groups, '{PHI_REVIEWERS}') "
        "THEN d ELSE trunc(d, 'YEAR') END",
        f"FUNCTION mask_race_code(code STRING, groups ARRAY<STRING>) RETURNS STRING RETURN CASE WHEN array_contains(groups, '{PHI_REVIEWERS}') "
        f"THEN code ELSE '{WITHHELD}' END",
        f"FUNCTION mask_provider_name(name STRING, groups ARRAY<STRING>) RETURNS STRING RETURN CASE WHEN array_contains(groups, "
        f"'{CREDENTIALING_TEAM}') THEN name ELSE concat(substring(name, 1, 1), '.') END",
    ]


def create_sql_functions(spark: SparkSession) -> None:
    """The filter and the masks as temporary SQL functions, and the variable ``principal_groups`` (no groups at first)."""
    for body in _sql_functions():
        spark.sql(f"CREATE OR REPLACE TEMPORARY {body}")
    spark.sql(f"DECLARE OR REPLACE VARIABLE {GROUPS_VARIABLE} ARRAY<STRING> DEFAULT CAST(array() AS ARRAY<STRING>)")


def set_principal_groups(spark: SparkSession, groups: Sequence[str]) -> None:
    spark.sql(f"SET VAR {GROUPS_VARIABLE} = CAST(array({', '.join(repr(str(g)) for g in groups)}) AS ARRAY<STRING>)")


def create_governed_view(spark: SparkSession, table: str, source: str, name: str | None = None) -> str:
    """A view over ``source`` that filters and masks by the policy of ``table`` for whatever groups the session holds.
    The functions are SQL, so Spark folds the caller's groups and pushes the row filter to the scan."""
    policy, name = POLICIES[table], name or f"governed_{table}"
    columns = [f"{policy.masks[c]}({c}, {GROUPS_VARIABLE}) AS {c}" if c in policy.masks else c for c in spark.table(source).columns]
    where = f" WHERE provider_region_filter({policy.row_filter_column}, {GROUPS_VARIABLE})" if policy.row_filter_column else ""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT {', '.join(columns)} FROM {source}{where}")
    return name


def registry_bindings(spark: SparkSession) -> DataFrame:
    """The implemented bindings as a table: (table, control_type, function)."""
    rows = []
    for p in POLICIES.values():
        if p.row_filter_column:
            rows.append((p.table, "row_filter", "provider_region_filter"))
        for _col, m in p.masks.items():
            rows.append((p.table, "column_mask", m))
    return spark.createDataFrame(sorted(set(rows)), "table string, control_type string, function string")


# G7
def policy_drift(documented: DataFrame, implemented: DataFrame) -> DataFrame:
    """Compare documented controls with implemented bindings on (table, function).

    Rows whose documented function is NULL (known gaps) are skipped.
    """
    d = documented.where(F.col("function").isNotNull()).select("table", "function", "rule_id").distinct()
    i = implemented.select("table", "function").distinct().withColumn("_impl", F.lit(True))
    j = d.join(i, ["table", "function"], "full_outer")
    status = (F.when(F.col("rule_id").isNull(), "implemented_not_documented")
               .when(F.col("_impl").isNull(), "documented_not_implemented").otherwise("ok"))
    return j.select("table", "function", "rule_id", status.alias("status"))
