"""Rows gathered by the home of their key move once, and give the same tables and facts."""

import datetime as dt

from tests import fixtures as FX
from vaultmart.functions.hashing import FIRST, HOME, LAST, hash_key, home
from vaultmart.operators import vault as V
from vaultmart.plans import gold
from vaultmart.plans.build import build_vault
from vaultmart.sources.ingest import unpivot_codes

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
# keys that repeat in other spellings, hold the separator (two pairs share a link key with other claims), are blank or null
AUTHORIZATIONS = [("a1", "c1", "approved", T1), (" A1 ", "C1", "denied", T2), ("a1", "c2", "approved", T1), ("b||x", "c", "pending", T1),
                  ("x", "c||b", "denied", T2), ("|y", "d", "denied", T2), ("y", "d|", "pending", T1), (None, "c1", "denied", T1),
                  ("", "c1", "denied", T1), ("a3", None, "approved", T1), ("a3", " ", "approved", T2)]
CLAIMS = [("c||b", "m", "p", "9", T1), ("c", "m", "b||p", "9", T2), ("c", "m", "p", "b||9", T1), ("c1", "m1", "p1", "1", T1), ("C1 ", "m1", "p1", "1", T2),
          ("c1", "m2", "p1", "2", T2), ("c|", "m", "|p", "|9", T2), (None, "m", "p", "9", T1), (" ", "m", "p", "9", T1), ("c2", None, "p2", "", T1)]
NAMES = ["hub_authorization", "sat_authorization_details", "lnk_claim_authorization", "tlnk_claim_adjustment_txn", "lnk_claim_provider_member",
         "tlnk_claim_payment_txn", "lnk_claim_drg", "sat_claim_details"]


def odd_bronze(spark):
    b = FX.bronze(spark)
    a = spark.createDataFrame([(x, c, s, t.date(), "s", t) for x, c, s, t in AUTHORIZATIONS],
                              "authorization_bk string, claim_line_bk string, auth_status string, requested_date date, record_source string, load_dts timestamp")
    header = spark.createDataFrame([(c, m, p, d, "s", t) for c, m, p, d, t in CLAIMS],
                                   "claim_line_bk string, member_bk string, provider_bk string, drg_bk string, record_source string, load_dts timestamp")
    for f in b["synpuf_inpatient_claim_header"].schema.fields:
        if f.name not in header.columns:
            header = header.selectExpr("*", f"cast(null as {f.dataType.simpleString()}) as {f.name}")
    claims = ["c1", "c||b", "c", "C1", "c2", "c|", None, "zz"]
    pay = spark.createDataFrame([(t, c, "10.00", "9.00", "8.00", "2024-01-05", "s", d) for d in (T1, T2) for i, c in enumerate(claims)
                                 for t in (f"t{i}", f"t|{i % 3}", None)],
                                "txn_bk string, claim_line_bk string, billed_amount string, allowed_amount string, paid_amount string, "
                                "payment_date string, record_source string, load_dts timestamp")
    adj = pay.selectExpr("txn_bk", "claim_line_bk", "billed_amount as adjustment_amount", "'CO-1' as adjustment_reason_code",
                         "payment_date as adjustment_date", "record_source", "load_dts")
    return {**b, "pi_authorizations": a, "synpuf_inpatient_claim_header": header, "pi_payment_transactions": pay, "pi_adjustment_transactions": adj}


def shown(df):
    df = df.drop(HOME)
    return sorted(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def exchanges(spark, make):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return make()._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_gathered_tables_and_facts_are_the_same_on_odd_keys(spark):
    b = odd_bronze(spark)
    for key_bytes in (False, True):
        plain, gathered = (build_vault(b, names=NAMES, key_bytes=key_bytes, gather=g) for g in (False, True))
        for n in NAMES:
            assert HOME in gathered[n].columns and HOME not in plain[n].columns
            assert shown(gathered[n]) == shown(plain[n]) != [], n
        for fact in (gold.fact_authorization, gold.dim_authorization, gold.fact_claim_adjustment, gold.fact_claim_payment):
            assert HOME not in fact(gathered).columns
            assert shown(fact(gathered)) == shown(fact(plain)) != [], fact.__name__


def test_an_authorization_moves_once_for_each_of_its_tables(spark):
    b = odd_bronze(spark)
    v = build_vault(b, names=NAMES, key_bytes=True, gather=True)
    assert exchanges(spark, lambda: gold.fact_authorization(v)) == 3          # hub, satellite, link; 7 when joined by their keys
    assert exchanges(spark, lambda: gold.fact_claim_adjustment(v)) == 3       # event by its key and by its claim, link


def test_codes_of_a_claim_move_as_one_row(spark):
    wide = spark.createDataFrame([("c1", "x", "y", T1), ("c1", "x", None, T1), (" C1", "x", "x", T2), ("c", "b||x", " ", T1), ("c||b", "x", "", T2),
                                  (None, "x", "y", T1)], "claim string, d1 string, d2 string, load_dts timestamp")
    codes = {g: unpivot_codes(wide, ["claim", "load_dts"], ["d1", "d2", "absent"], "code", gather=g) for g in (False, True)}
    assert shown(codes[True]) == shown(codes[False]) != []

    def link(g):
        s = codes[g].selectExpr("*", "'s' as record_source").select(
            "*", hash_key("claim", "code").alias("pk"), hash_key("claim").alias("a"), hash_key("code").alias("b"))
        return V.new_link_rows(s, "pk", ["a", "b"])
    assert shown(link(True)) == shown(link(False)) != []
    assert exchanges(spark, lambda: link(True)) == 1


def test_a_home_is_the_same_for_all_keys_of_its_rows(spark):
    r = spark.createDataFrame([("a||b", "c", "a", "b||c"), ("a|", "b", " A ", "|b")], "k1 string, l1 string, k2 string, l2 string").select(
        hash_key("k1", "l1").alias("p1"), hash_key("k2", "l2").alias("p2"), home("k1", FIRST).alias("f1"), home("k2", FIRST).alias("f2"),
        home("l1", LAST).alias("z1"), home("l2", LAST).alias("z2")).collect()
    assert all(x.p1 == x.p2 and x.f1 == x.f2 and x.z1 == x.z2 for x in r)


def moved_once(spark, make):
    """Exchanges made and reused by the plan of ``make()``."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = make()._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange"), plan.count("ReusedExchange"), plan.count("Sort [")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def stored(spark, tmp, bronze):
    for name, df in bronze.items():
        df.write.parquet(f"{tmp}/{name}")
    return {name: spark.read.parquet(f"{tmp}/{name}") for name in bronze}


def test_tables_of_one_input_share_its_move(spark, tmp):
    b = stored(spark, tmp, {k: v for k, v in odd_bronze(spark).items() if k in (
        "pi_authorizations", "pi_payment_transactions", "synpuf_inpatient_claim_header")})
    v = build_vault(b, names=NAMES, spark=spark, key_bytes=True, gather=True, one_job=True)
    assert moved_once(spark, lambda: gold.dim_authorization(v))[:2] == (1, 1)         # hub and satellite
    assert moved_once(spark, lambda: gold.fact_authorization(v))[:2] == (1, 2)        # and link
    assert moved_once(spark, lambda: gold.fact_claim_payment(v))[:2] == (3, 2)        # claims; payments by their key and by their claim
    assert moved_once(spark, lambda: gold.dim_authorization(v))[2] == 2               # a table sorts its rows once


def test_a_shared_move_gives_the_same_tables(spark, tmp):
    b = odd_bronze(spark)
    names = [*NAMES, "hub_drg", "sat_drg_details", "hub_claim_line", "hub_appeal", "sat_appeal_details", "lnk_claim_appeal"]
    # a claim without its key still names a DRG
    assert b["synpuf_inpatient_claim_header"].where("trim(claim_line_bk) = '' or claim_line_bk is null").count() == 2
    plain = build_vault(b, names=names, key_bytes=True)
    shared = build_vault(b, names=names, key_bytes=True, gather=True, one_job=True)
    for n in names:
        assert shown(shared[n]) == shown(plain[n]) != [], n
    for fact in (gold.fact_authorization, gold.dim_authorization, gold.fact_claim_adjustment, gold.fact_claim_payment, gold.fact_appeal):
        assert shown(fact(shared)) == shown(fact(plain)) != [], fact.__name__
