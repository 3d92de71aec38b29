"""Observed counts, file order, binned intervals, stored sketches, governance in plain SQL, declared tests."""
import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from vaultmart.operators import governance as GV
from vaultmart.operators.ranges import binned_interval_join, interval_join
from vaultmart.plans import sketches
from vaultmart.sources import ingest as I


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


@pytest.mark.parametrize("bin_days", [1, 7, 400])
def test_binned_join_equals_the_plain_one(spark, bin_days):
    """Open and reversed intervals, bounds, intervals before and behind all events, keys without a match, nulls."""
    rng = random.Random(bin_days)
    events = [(rng.choice("abc"), day(rng.randint(0, 300)), i) for i in range(300)] + [(None, day(3), 900), ("a", None, 901), ("a", day(300), 902)]
    versions = [(rng.choice("abd"), day(s := rng.randint(-50, 320)), rng.choice([None, day(s + rng.randint(-3, 60))]), i) for i in range(60)]
    e = spark.createDataFrame(events, "k string, at timestamp, n int")
    v = spark.createDataFrame(versions, "vk string, s timestamp, e timestamp, m int")
    want = rows(interval_join(e, v, "k", "at", "s", "e", interval_key="vk"), "n", "m")
    got = binned_interval_join(e, v, "k", "at", "s", "e", bin_days * 86_400, "vk")
    assert rows(got, "n", "m") == want and got.columns == ["k", "at", "n", "vk", "s", "e", "m"]
    assert binned_interval_join(e.limit(0), v, "k", "at", "s", "e", 86_400, "vk").count() == 0


def test_a_sku_with_many_versions_is_spread(spark):
    """One key with 100,000 versions: no join key holds more than 1/100 of the rows."""
    v = spark.range(100_000).select(F.lit("sku").alias("vk"), F.timestamp_seconds(F.col("id") * 3600).alias("s"),
                                    F.timestamp_seconds(F.col("id") * 3600 + 3600).alias("e"), F.col("id").alias("m"))
    e = spark.range(100_000).select(F.lit("sku").alias("k"), F.timestamp_seconds(F.col("id") * 3600 + 1800).alias("at"), F.col("id").alias("n"))
    got = binned_interval_join(e, v, "k", "at", "s", "e", 86_400, "vk")
    assert got.where("n = m").count() == 100_000 == got.count()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"_event_bin#\d+L? = _interval_bin", plan)
    share = e.groupBy(F.floor(F.unix_timestamp("at") / 86_400)).count().agg(F.max("count")).first()[0]
    assert share <= 1000


def test_first_claim_row_in_file_order(spark, tmp):
    """Repeated claims across several files: the row of the first file by name wins, inside a file the first line."""
    cols = list(I.CLAIM_HEADER_COLUMN_MAP)
    rng, folder, first = random.Random(4), os.path.join(tmp, "claims"), {}
    os.makedirs(folder)
    order = list(range(4))
    rng.shuffle(order)                                     # written in another order than they are named
    files = {f: [(f"C{rng.randint(0, 40)}", f"{f}-{line}") for line in range(60)] for f in range(4)}
    for f in order:
        with open(os.path.join(folder, f"part-{f}.csv"), "w") as out:
            out.write(",".join(cols) + "\n")
            for claim, paid in files[f]:
                out.write(",".join(claim if c == "CLM_ID" else paid if c == "CLM_PMT_AMT" else "x" for c in cols) + "\n")
    for f in range(4):
        for claim, paid in files[f]:
            first.setdefault(claim, paid)
    raw = I.read_csv_in_order(spark, folder, cols)
    got = I.land_claim_headers(raw)
    paid = I.CLAIM_HEADER_COLUMN_MAP["CLM_PMT_AMT"]
    assert {r.claim_line_bk: r[paid] for r in got.collect()} == first and "_row_order" not in got.columns


def test_landing_counts_are_observed_in_one_scan(spark, tmp):
    cols = list(I.PROVIDER_COLUMN_MAP)
    npi, kind, when = (next(s for s, t in I.PROVIDER_COLUMN_MAP.items() if t == name) for name in ("npi", "entity_type_code", "last_update_date"))
    data = [tuple({npi: str(n % 7), kind: "1" if n % 7 < 4 else "2", when: f"01/{n + 1:02d}/2024"}.get(c, "x") for c in cols) for n in range(20)]
    raw = spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in cols))
    counted = spark.sparkContext.accumulator(0)
    watched = raw.rdd.map(lambda r: counted.add(1) or r).toDF(raw.schema)
    got = I.land_providers_observed(spark, watched, tmp + "/p")
    assert rows(got, "table", "kind", "rows") == [("nppes_facilities", "landed", 3), ("nppes_providers", "landed", 4), ("nppes_raw", "input", 20)]
    assert counted.value == 20                              # every input row was read once
    assert spark.read.parquet(tmp + "/p").where("entity = 1").count() == 4


def test_sketches_roll_up_without_the_fact(spark, tmp):
    fact = spark.range(60_000).select(F.timestamp_seconds(F.lit(1_704_067_200) + (F.col("id") % 400) * 86_400).alias("at"),
                                      (F.col("id") * 7 % 9000).cast("string").alias("member"), (F.col("id") % 3).alias("class"))
    fact = fact.withColumn("member", F.when(F.col("member") != "7", F.col("member")))
    path = tmp + "/sketches"
    sketches.daily_sketches(fact, "at", "member", ["class"]).write.parquet(path)
    stored = spark.read.parquet(path)
    for grain in ("month", "quarter", "year"):
        near = sketches.rolled_up(stored, grain, ["class"], "near")
        plan = near._jdf.queryExecution().analyzed().toString()
        assert "Range" not in plan
        exact = fact.groupBy(F.date_trunc(grain, "at").cast("date").alias("metric_time"), "class").agg(F.count_distinct("member").alias("n"))
        both = near.join(exact, ["metric_time", "class"]).collect()
        assert len(both) == exact.count() and all(abs(r.near - r.n) <= 0.02 * r.n for r in both)


def test_governed_views_in_plain_sql(spark, tmp):
    """One view for every caller: filter and masks follow the session variable, and the filter reaches the scan."""
    d = spark.createDataFrame([("h1", "Ann", "Smith", "NY"), ("h2", "Bo", None, "TX"), ("h3", "Cy", "Lee", "CA")],
                              "provider_hk string, provider_first_name string, provider_last_name string, practice_state string")
    d.write.parquet(tmp + "/d")
    session = spark.newSession()
    session.read.parquet(tmp + "/d").createOrReplaceTempView("dim_provider")
    GV.create_sql_functions(session)
    view = GV.create_governed_view(session, "dim_provider", "dim_provider")
    for groups in (["regional_manager_south", "regional_manager_west"], ["credentialing_team"], ["regional_manager_west", "credentialing_team"], []):
        GV.set_principal_groups(session, groups)
        got = session.sql(f"SELECT * FROM {view}")
        assert rows(got, "provider_hk") == rows(GV.governed(d, "dim_provider", groups), "provider_hk")
        assert sorted(map(str, got.collect())) == sorted(map(str, GV.governed(d, "dim_provider", groups).collect()))
    GV.set_principal_groups(session, ["regional_manager_south"])
    plan = session.sql(f"SELECT provider_hk FROM {view}")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*In\(practice_state", plan)
    m = spark.createDataFrame([(dt.date(1950, 6, 15), "3"), (None, None)], "birth_date date, race_code string")
    m.write.parquet(tmp + "/m")
    session.read.parquet(tmp + "/m").createOrReplaceTempView("dim_member")
    view = GV.create_governed_view(session, "dim_member", "dim_member")
    for groups in ([], ["phi_reviewers"]):
        GV.set_principal_groups(session, groups)
        assert sorted(map(str, session.sql(f"SELECT * FROM {view}").collect())) == sorted(map(str, GV.governed(m, "dim_member", groups).collect()))


def test_declared_tests_are_complete():
    from vaultmart.plans.queries import gold_checks, source_checks
    kinds = [c.check for c in gold_checks()]
    assert {k: kinds.count(k) for k in set(kinds)} == {"unique": 27, "not_null": 27, "relationships": 18} and len(source_checks()) == 17
