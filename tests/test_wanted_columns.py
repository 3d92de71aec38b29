"""Readers that name their columns get the same rows; checks read a table once; a satellite moves a row twice."""

import datetime as dt

from tests import fixtures as FX
from vaultmart.operators import quality as QC
from vaultmart.operators import vault as V
from vaultmart.plans import gold
from vaultmart.plans.build import build_vault
from vaultmart.plans.semantic import MetricStore, used_columns

TS = [dt.datetime(2024, 1, d) for d in range(1, 6)]


def shown(df, columns):
    return sorted(str(tuple(r)) for r in df.select(*columns).collect())


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_fewer_columns_give_the_same_rows(spark):
    s = spark.createDataFrame(
        [("k1", "a", "x", 2, TS[0], "s"), ("k1", "b", "y", 1, TS[0], "s"), ("k1", "a", "x", 0, TS[1], "r"), ("k2", None, "x", 5, TS[2], "s"),
         ("k2", None, "x", 4, TS[2], "s"), (None, "a", "x", 1, TS[0], "s"), ("k3", "c", "z", None, TS[3], None), ("k3", "c", "z", 3, TS[3], "s")],
        "pk string, fk string, hd string, v int, load_dts timestamp, record_source string")
    whole = {"hub": V.new_hub_rows(s, "pk", "fk"), "link": V.new_link_rows(s, "pk", ["fk", "hd"]),
             "tlink": V.new_tlink_rows(s, "pk", ["fk"], ["v", "hd"], "load_dts"), "sat": V.new_satellite_rows(s, "pk", "hd", ["fk", "v"])}
    some = {"hub": lambda c: V.new_hub_rows(s, "pk", "fk", columns=c), "link": lambda c: V.new_link_rows(s, "pk", ["fk", "hd"], columns=c),
            "tlink": lambda c: V.new_tlink_rows(s, "pk", ["fk"], ["v", "hd"], "load_dts", columns=c),
            "sat": lambda c: V.new_satellite_rows(s, "pk", "hd", ["fk", "v"], columns=c)}
    for kind, columns in (("hub", []), ("hub", ["fk"]), ("link", ["fk"]), ("link", ["hd"]), ("tlink", ["fk"]), ("tlink", ["v"]),
                          ("tlink", ["load_dts"]), ("sat", ["fk"]), ("sat", ["v"]), ("sat", []), ("sat", ["record_source"])):
        got = some[kind](columns)
        assert set(columns) <= set(got.columns) and "pk" in got.columns
        assert shown(got, got.columns) == shown(whole[kind], got.columns), (kind, columns)


def test_satellite_and_its_current_rows_take_two_shuffles(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        s = spark.createDataFrame([("k1", "a", 1, TS[0], "s"), ("k1", "b", 2, TS[1], "s"), ("k2", "b", 2, TS[1], "s")],
                                  "pk string, hd string, v int, load_dts timestamp, record_source string")
        current = V.current_satellite(V.new_satellite_rows(s, "pk", "hd", ["v"]), "pk", "hd")
        assert exchanges(current) == 2
        assert shown(current, ["pk", "hd", "v"]) == ["('k1', 'b', 2)", "('k2', 'b', 2)"]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_checks_read_a_table_once(spark, tmp):
    hub = spark.createDataFrame([("a", "A"), ("a", "A"), ("a", "B"), (None, "C")], "k string, bk string")
    ref = spark.createDataFrame([("a", "l1"), ("z", "l1"), ("z", None), (None, "l2")], "k string, lk string")
    for name, df in (("hub", hub), ("ref", ref)):
        df.write.parquet(f"{tmp}/{name}")
    tables = {n: spark.read.parquet(f"{tmp}/{n}") for n in ("hub", "ref")}
    checks = [QC.Check("hub", "unique", "k"), QC.Check("hub", "unique", "bk"), QC.Check("hub", "not_null", "k"), QC.Check("ref", "unique", "lk"),
              QC.Check("ref", "not_null", "lk"), QC.Check("ref", "not_null", "k"), QC.Check("ref", "relationships", "k", "hub", "k"),
              QC.Check("hub", "relationships", "k", "ref", "k"), QC.Check("hub", "not_null", "k")]
    res = QC.run_checks(tables, checks)
    assert res._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 2
    got = sorted((r.table, r.check, r.column, r.failures) for r in res.collect())
    assert got == sorted([("hub", "unique", "k", 1), ("hub", "unique", "bk", 1), ("hub", "not_null", "k", 1), ("ref", "unique", "lk", 1),
                          ("ref", "not_null", "lk", 1), ("ref", "not_null", "k", 1), ("ref", "relationships:hub", "k", 2),
                          ("hub", "relationships:ref", "k", 0), ("hub", "not_null", "k", 1)])


def test_metrics_agree_on_a_vault_of_their_columns(spark):
    whole = build_vault(FX.bronze(spark), load_dts=FX.LOAD1)
    for metric, by in (("total_payment_leakage", []), ("leakage_by_provider", ["provider"]), ("drg_reimbursement_variance", ["drg"])):
        used = used_columns([metric], by)
        keep = {n: [c for c in whole[n].columns if c in used or c in must or c == "drg_hk"] for n, must in gold.PRUNED.items()}
        lean = build_vault(FX.bronze(spark), load_dts=FX.LOAD1, columns=keep)
        assert "member_hk" not in lean["lnk_claim_provider_member"].columns
        a, b = (MetricStore(vault=v).query([metric], group_by=by) for v in (whole, lean))
        assert shown(a, a.columns) == shown(b, b.columns) != []
