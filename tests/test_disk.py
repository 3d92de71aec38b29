"""What a query has on the disk at once: rows move once, as they are stored, and nothing stays that is not read again."""

import glob
import os

from pyspark.sql import functions as F

from tests import fixtures as FX
from tests.test_gathered import moved_once as moves
from tests.test_gathered import odd_bronze, shown, stored
from tests.test_vault import staged, ts
from vaultmart.functions.hashing import HOME
from vaultmart.operators import partitioned_vault as PV
from vaultmart.plans import gold
from vaultmart.plans import queries as Q
from vaultmart.plans.build import build_vault, hashed_staging
from vaultmart.plans.semantic import MetricStore
from vaultmart.session import scratch_path
from vaultmart.sources import proxy


def test_claims_move_once_to_be_hashed_and_joined(spark, tmp, monkeypatch):
    header = "synpuf_inpatient_claim_header"
    claims = odd_bronze(spark)[header].withColumn("paid_amount", F.lit("1.00"))
    blank = claims.where("trim(claim_line_bk) = ''").unionByName(claims.where("trim(claim_line_bk) = ''").withColumn("provider_bk", F.lit("p9")))
    b = stored(spark, tmp, {header: claims.unionByName(blank)})
    monkeypatch.setattr(Q, "bronze", lambda *a: b)
    joined = Q.q_stage_claims(spark, tmp)
    assert moves(spark, lambda: Q.q_stage_claims(spark, tmp))[:2] == (1, 1)
    hs = hashed_staging({"stg_claim_lines": Q.S.stg_claim_lines(b)}, ["stg_claim_lines_hk", "stg_claim_lines_sat_hk"])
    want = hs["stg_claim_lines_hk"].select("claim_line_bk", "claim_line_hk", "provider_hk", "member_hk", "claim_provider_member_hk").join(
        hs["stg_claim_lines_sat_hk"].select("claim_line_bk", "claim_hashdiff"), "claim_line_bk")
    assert HOME not in joined.columns and shown(joined) == shown(want) != []
    assert joined.where("trim(claim_line_bk) = ''").count() == 9         # three blank keys meet one another


def test_payments_do_not_move_to_their_drg(spark, monkeypatch):
    v = build_vault(FX.bronze(spark), load_dts=FX.LOAD1)
    want = shown(gold.fact_drg_reimbursement_variance(v))
    plans = []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        monkeypatch.setattr(gold, "materialize", lambda s, df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
        got = shown(gold.fact_drg_reimbursement_variance(v))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == want != [] and "BroadcastHashJoin [drg_hk" in plans[0]


def test_aggregates_of_several_models_are_made_one_by_one(spark):
    v, names = build_vault(FX.bronze(spark), load_dts=FX.LOAD1), []
    metrics = ["payment_leakage_rate", "denial_rate", "cob_tpl_recovery_amount"]
    plain = MetricStore(vault=v).query(metrics, ["metric_time"], "year")
    kept = MetricStore(vault=v, store=lambda df, n: names.append(n) or df).query(metrics, ["metric_time"], "year")
    assert len(names) == len(set(names)) == 3 and shown(kept) == shown(plain) != []
    names.clear()
    MetricStore(vault=v, store=lambda df, n: names.append(n) or df).query(metrics[:1], ["metric_time"], "year")
    assert not names


def test_a_load_leaves_only_its_table(spark, tmp):
    def left():
        return set(os.listdir(scratch_path(spark, "materialized").removeprefix("file:"))) if os.path.exists(
            scratch_path(spark, "materialized").removeprefix("file:")) else set()
    had = left()
    for kind, table in (("sat", PV.SatelliteTable(spark, f"{tmp}/sat", "hk", "hd", ["attr"])), ("hub", PV.hub_table(spark, f"{tmp}/hub", "hk", "bk"))):
        for day, attr in ((1, "a"), (2, "b"), (2, "b")):
            table.load(staged(spark, [(f"K{i}", attr, ts(day), "s") for i in range(20)]))
        assert table.version() == 3 and table.table().count() == (40 if kind == "sat" else 20)
    assert left() == had and glob.glob(f"{tmp}/sat/history/load=*/key_prefix=*/*.zstd.parquet")


def test_the_claim_file_is_written_behind_its_sort(spark, tmp):
    lines = [(1, 10, 5, 1, 3.0, 100.0, 0.1, 0.05, "A", "O"), (1, 11, 5, 1, 30.0, None, 0.0, 0.0, None, "F"), (2, 10, 6, 2, 26.0, 7.5, 0.0, 0.0, "R", "O")]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string").withColumn(
        "l_shipdate", F.lit("1997-02-03").cast("timestamp")).write.parquet(f"{tmp}/lineitem.parquet")
    spark.createDataFrame([(1, 7, "F"), (2, 8, None)], "o_orderkey long, o_custkey long, o_orderstatus string").selectExpr(
        "*", "1.0D as o_totalprice", "timestamp '1997-01-01' as o_orderdate", "'1-URGENT' as o_orderpriority").write.parquet(f"{tmp}/orders.parquet")
    spark.createDataFrame([(10, "n", "b", "ECONOMY", 10), (11, None, None, "PROMO", 3)],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_size int").withColumn(
        "p_retailprice", F.lit(1.0)).write.parquet(f"{tmp}/part.parquet")
    select, tables = proxy.raw_sql("spark")["claims_raw"].split("FROM lineitem l")
    whole = Q.raw(spark, tmp, "claims_raw")
    rows = spark.sql(f"SELECT l.*, o_custkey, o_orderdate, p_type, p_brand, p_size FROM lineitem l{tables}")
    text = Q._claims_text(rows, select)
    assert shown(text.drop("_stored")) == shown(whole) != []
    assert shown(Q._claims_text(text.select("_stored.*").repartitionByRange("l_shipdate"), select).drop("_stored")) == shown(whole)
    got = Q.QUERIES["a04_first_claim_row_in_file_order"](spark, tmp)
    assert sorted(r.claim_line_bk for r in got.collect()) == ["1-1", "2-2"]
