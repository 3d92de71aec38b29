"""Data-quality checks (H-U, H-N, H-R, H-S, H-T, H-M).

``run_checks`` turns a list of check specs into one DataFrame of results
(table, check, column, failures, status).  Every table is read once, whatever
the number of checks: a row gives its keys (as a row of a unique or referenced
column, or as a reference to it) and the row checks it fails, and one aggregate
grouped by (column or table, key) counts them, combined before the shuffle, so
a hot key is one row per task.  A table that is computed is thus never stored
for its checks.  Keys are compared as text.

``run_checks_by_job`` does the same in several jobs that follow each other, each
over some of the tables: what a job shuffled is gone from the disk before the
next one starts.  A job leaves the counts of its keys, but not of those that no
other job names and that pass.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultmart.functions.hashing import HOME
from vaultmart.plans import registry as R
from vaultmart.session import materialize


@dataclass(frozen=True)
class Check:
    table: str
    check: str                 # unique | not_null | relationships | accepted_values
    column: str
    ref_table: str | None = None
    ref_column: str | None = None
    values: tuple = ()


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    # halved: Spark analyses a plan anew at each union
    half = len(frames) // 2
    return _union(frames[:half]).union(_union(frames[half:])) if half else frames[0]


def check_columns(checks: Sequence[Check]) -> dict[str, set[str]]:
    """The columns that the checks read, by table."""
    out: dict[str, set[str]] = {}
    for c in checks:
        out.setdefault(c.table, set()).add(c.column)
        if c.check == "relationships":
            out.setdefault(c.ref_table, set()).add(c.ref_column)
    return out


@dataclass
class _Plan:
    """What rows give for the checks.  Group: a unique or referenced column, or a table with row checks.  Slot 0 of a group is
    the column's own row, slot j its j-th reference, or the table's j-th row check."""
    items: dict[str, list]                    # table -> (kind, column, values, group, slot) of each item of its rows
    slots: list[dict[int, int]]               # per group: slot -> check
    width: int

    def tables_of(self, group: int) -> set[str]:
        return {t for t, its in self.items.items() if any(i[3] == group for i in its)}


def _plan(checks: Sequence[Check]) -> _Plan:
    groups: dict = {}
    slots: list[dict[int, int]] = []
    own: set[int] = set()
    items: dict[str, list] = {}

    def group_of(name) -> int:
        if name not in groups:
            groups[name] = len(slots)
            slots.append({})
        return groups[name]

    def own_rows(table: str, column: str) -> int:
        g = group_of((table, column))
        if g not in own:
            own.add(g)
            items.setdefault(table, []).append(("key", column, (), g, 0))
        return g
    for n, c in enumerate(checks):
        if c.check == "unique":
            slots[own_rows(c.table, c.column)][0] = n
            continue
        g = own_rows(c.ref_table, c.ref_column) if c.check == "relationships" else group_of(c.table)
        slot = max([0, *slots[g]]) + 1
        slots[g][slot] = n
        items.setdefault(c.table, []).append(("key" if c.check == "relationships" else c.check, c.column, c.values, g, slot))
    return _Plan(items, slots, 1 + max(max(s, default=0) for s in slots))


def _unique_at_home(table: str, df: DataFrame, column: str) -> bool:
    """Rows of equal ``column`` are in one place: the keys of a hub, and the key of a link, that are gathered at its home."""
    t = R.BY_NAME.get(table)
    return HOME in df.columns and (isinstance(t, R.Hub) and column in (t.pk, t.bk) or isinstance(t, R.Link) and column == t.pk)


def _rows_given(plan: _Plan, table: str, df: DataFrame) -> DataFrame:
    """``group, key, slot`` of every row of a table."""
    made, again = [], {}
    for kind, column, values, group, slot in plan.items[table]:
        col = F.col(column)
        if kind != "key":
            ok = col.isNull() if kind == "not_null" else col.isNotNull() & ~col.isin(*values)
        else:
            ok = col.isNotNull()
            if slot == 0 and len(plan.slots[group]) == 1 and 0 in plan.slots[group] and _unique_at_home(table, df, column):
                # nothing refers to it: only keys that repeat are counted, and they repeat in place
                again[f"_n{group}"] = F.count(F.lit(1)).over(Window.partitionBy(HOME, column))
                ok = ok & (F.col(f"_n{group}") > 1)
        key = col.cast("string") if kind == "key" else F.lit("")
        made.append(F.when(ok, F.struct(F.lit(group).alias("group"), key.alias("key"), F.lit(slot).alias("slot"))))
    df = df.select("*", *[c.alias(n) for n, c in again.items()])
    return df.select(F.explode(F.array_compact(F.array(*made))).alias("_i")).select("_i.*")


def _counts(plan: _Plan) -> list[str]:
    return [f"c{j}" for j in range(plan.width)]


def _per_key(plan: _Plan, tables: dict[str, DataFrame]) -> DataFrame:
    """``group, key`` with a count for each slot."""
    given = _union([_rows_given(plan, t, tables[t]) for t in plan.items if t in tables])
    return given.groupBy("group", "key").agg(*[F.count_if(F.col("slot") == j).alias(c) for j, c in enumerate(_counts(plan))])


def _failed(plan: _Plan) -> list[Column]:
    # a repeated key is one failure, a reference to a key without own row fails as often as it occurs
    own, *refs = _counts(plan)
    return [(F.col(own) > 1).cast("long"), *[F.when(F.col(own) == 0, F.col(c)).otherwise(0) for c in refs]]


def _failures(plan: _Plan, per_key: DataFrame) -> DataFrame:
    """``no, failures`` of the checks that had any."""
    counts = _counts(plan)
    sums = per_key.groupBy("group").agg(*[F.sum(f).alias(c) for f, c in zip(_failed(plan), counts)])
    nos = F.array(*[F.lit(s.get(j, -1)) for s in plan.slots for j in range(plan.width)])
    return (sums.select("group", F.posexplode(F.array(*counts)).alias("slot", "failures"))
            .select(F.element_at(nos, F.col("group") * plan.width + F.col("slot") + 1).alias("no"), "failures")
            .where(F.col("no") >= 0))


def run_checks(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    plan = _plan(list(dict.fromkeys(checks)))
    return _results(next(iter(tables.values())).sparkSession, checks, _failures(plan, _per_key(plan, tables)))


def run_checks_by_job(spark: SparkSession, load: Callable[[Collection[str]], dict[str, DataFrame]], jobs: Sequence[Collection[str]],
                      checks: Sequence[Check]) -> DataFrame:
    """``run_checks`` over the tables that ``load`` gives for each of ``jobs``, one job after the other; together the jobs
    name every table of the checks, each once."""
    plan = _plan(list(dict.fromkeys(checks)))
    if sorted(t for names in jobs for t in names) != sorted(plan.items):
        raise ValueError("each table of the checks belongs to one job")
    left = []
    for names in jobs:
        counted = _per_key(plan, load(names))
        whole = [g for g in range(len(plan.slots)) if plan.tables_of(g) <= set(names)]
        passed = F.col("group").isin(whole) & ~F.greatest(F.lit(0), *[f.cast("long") for f in _failed(plan)]).cast("boolean")
        left.append(materialize(spark, counted.where(~passed), "checked"))
    per_key = _union(left).groupBy("group", "key").agg(*[F.sum(c).alias(c) for c in _counts(plan)])
    return _results(spark, checks, materialize(spark, _failures(plan, per_key), "failures"))


def _results(spark: SparkSession, checks: Sequence[Check], failures: DataFrame) -> DataFrame:
    asked = {c: list(checks).count(c) for c in checks}                  # a check given twice is counted once and shown twice
    zeros = spark.range(0, len(asked), 1, 1).select(
        F.col("id").cast("int").alias("no"), F.lit(0).cast("long").alias("failures"))
    failures = zeros.union(failures)
    names = F.array(*[F.array_repeat(F.struct(F.lit(c.table).alias("table"),
                                              F.lit(f"relationships:{c.ref_table}" if c.check == "relationships" else c.check).alias("check"),
                                              F.lit(c.column).alias("column")), times) for c, times in asked.items()])
    return (failures.groupBy("no").agg(F.sum("failures").alias("failures"))
            .select(F.explode(F.element_at(names, F.col("no") + 1)).alias("_c"), "failures").select("_c.*", "failures")
            .withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail")))


def vault_checks(names: Sequence[str] | None = None) -> list[Check]:
    """The vault's declarative tests, derived from the registry."""
    hubs_by_pk = {h.pk: h.name for h in R.HUBS}
    links_by_pk = {lk.pk: lk.name for lk in R.LINKS}
    out: list[Check] = []

    def want(n):
        return names is None or n in names
    for h in R.HUBS:
        if want(h.name):
            out += [Check(h.name, "unique", h.pk), Check(h.name, "not_null", h.pk),
                    Check(h.name, "unique", h.bk), Check(h.name, "not_null", h.bk)]
    for lk in R.LINKS:
        if want(lk.name):
            out += [Check(lk.name, "unique", lk.pk), Check(lk.name, "not_null", lk.pk)]
            for fk in lk.fks:
                out.append(Check(lk.name, "not_null", fk))
                if want(hubs_by_pk.get(fk, "")):
                    out.append(Check(lk.name, "relationships", fk, hubs_by_pk[fk], fk))
    for s in R.SATELLITES:
        if want(s.name):
            out += [Check(s.name, "not_null", s.pk), Check(s.name, "not_null", s.hashdiff)]
            if s.pk in hubs_by_pk and want(hubs_by_pk[s.pk]):
                out.append(Check(s.name, "relationships", s.pk, hubs_by_pk[s.pk], s.pk))
            if s.pk in links_by_pk and want(links_by_pk[s.pk]):
                out.append(Check(s.name, "relationships", s.pk, links_by_pk[s.pk], s.pk))
    for t in R.TLINKS:
        if want(t.name):
            out += [Check(t.name, "unique", t.pk), Check(t.name, "not_null", t.pk)]
            for fk in t.fks:
                out.append(Check(t.name, "not_null", fk))
                if want(hubs_by_pk.get(fk, "")):
                    out.append(Check(t.name, "relationships", fk, hubs_by_pk[fk], fk))
    return out


# Fixed values of the triage rules.
AGENT_FACING_LAYERS = ("gold", "semantic")


def layer_of(table: Column) -> Column:
    t = table
    return (F.when(t.rlike("^(hub|lnk|sat|tlnk)_"), "vault").when(t.rlike("^(dim|fact)_"), "gold")
             .when(t.rlike("^stg_"), "staging").otherwise("other"))


def triage(results: DataFrame, layer_col: str | None = None) -> DataFrame:
    """H-T: LOW / MEDIUM / HIGH per failure, with a notify flag.

    Load errors are HIGH; failures in agent-facing layers are HIGH; vault
    failures MEDIUM; the rest LOW.  The layer is an explicit column (or
    derived from the table-name prefix), not guessed from an id string.
    """
    df = results if "failure_type" in results.columns else results.withColumn(
        "failure_type", F.lit("test_failure"))
    layer = F.col(layer_col) if layer_col else layer_of(F.col("table"))
    sev = (F.when(F.col("failure_type") == "load_error", "high")
            .when(layer.isin(*AGENT_FACING_LAYERS), "high")
            .when(layer == "vault", "medium").otherwise("low"))
    out = df.where(F.col("status") == "fail") if "status" in df.columns else df
    return out.withColumn("layer", layer).withColumn("severity", sev) \
              .withColumn("notify", F.col("severity").isin("medium", "high"))


def metric_reference_check(metric_refs: DataFrame, measures: DataFrame) -> DataFrame:
    """H-M: metric inputs that name no known measure or metric."""
    known = measures.select(F.col("name").alias("ref"))
    return metric_refs.join(known, "ref", "left_anti")
