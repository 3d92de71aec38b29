import datetime as dt

from pyspark.sql import functions as F

from vaultmart.functions.hashing import hash_key, hashdiff
from vaultmart.operators import vault as V
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)


def ts(days):
    return T0 + dt.timedelta(days=days)


def staged(spark, data):
    df = spark.createDataFrame(data, "bk string, attr string, load_dts timestamp, record_source string")
    return df.select("*", hash_key("bk").alias("hk"), hashdiff(["attr"], df).alias("hd"))


def test_hub_first_seen_wins_and_replay_adds_nothing(spark):
    b1 = staged(spark, [("K1", "a", ts(1), "s2"), ("K1", "a", ts(1), "s1"), ("K2", "b", ts(2), "s1"),
                        (None, "c", ts(0), "s1")])
    hub = V.new_hub_rows(b1, "hk", "bk")
    assert rows(hub, "bk", "record_source") == [("K1", "s1"), ("K2", "s1")]
    again = V.new_hub_rows(b1, "hk", "bk", hub)
    assert again.count() == 0


def test_hub_batches_are_order_independent(spark):
    a = staged(spark, [("K1", "a", ts(1), "s"), ("K2", "a", ts(5), "s")])
    b = staged(spark, [("K2", "a", ts(3), "s"), ("K3", "a", ts(4), "s")])
    ab = V.new_hub_rows(a.unionByName(b), "hk", "bk")
    t = V.new_hub_rows(a, "hk", "bk")
    inc = t.unionByName(V.new_hub_rows(b, "hk", "bk", t))
    assert sorted(r.bk for r in inc.collect()) == sorted(r.bk for r in ab.collect())


def test_link_requires_all_foreign_keys(spark):
    df = spark.createDataFrame([("c1", "p1"), ("c2", None)], "c string, p string").withColumns(
        {"c_hk": hash_key("c"), "p_hk": hash_key("p"), "l_hk": hash_key("c", "p"),
         "load_dts": F.lit(T0), "record_source": F.lit("s")})
    assert V.new_link_rows(df, "l_hk", ["c_hk", "p_hk"]).count() == 1


def test_satellite_history_a_b_a_and_replay(spark):
    b = staged(spark, [("K1", "A", ts(1), "s"), ("K1", "A", ts(2), "s"), ("K1", "B", ts(3), "s"),
                       ("K1", "A", ts(4), "s")])
    sat = V.new_satellite_rows(b, "hk", "hd", ["attr"])
    assert [r.attr for r in sat.orderBy("load_dts").collect()] == ["A", "B", "A"]
    # unchanged reload and late rows add nothing
    assert V.new_satellite_rows(b, "hk", "hd", ["attr"], sat).count() == 0
    late = staged(spark, [("K1", "Z", ts(2), "s")])
    assert V.new_satellite_rows(late, "hk", "hd", ["attr"], sat).count() == 0
    # the first row of a new batch is compared with the current version
    nxt = staged(spark, [("K1", "A", ts(5), "s"), ("K1", "C", ts(6), "s")])
    assert [r.attr for r in V.new_satellite_rows(nxt, "hk", "hd", ["attr"], sat).collect()] == ["C"]


def test_satellite_buckets_do_not_change_result(spark):
    data = [("K1", "ABCD"[i % 3], ts(i * 7), "s") for i in range(40)]
    b = staged(spark, data)
    a = V.new_satellite_rows(b, "hk", "hd", ["attr"], bucket_seconds=86400)
    c = V.new_satellite_rows(b, "hk", "hd", ["attr"], bucket_seconds=10 ** 9)
    assert rows(a, "load_dts", "attr") == rows(c, "load_dts", "attr")
    assert a.count() == 40                                  # every row differs from its predecessor


def test_current_satellite(spark):
    b = staged(spark, [("K1", "A", ts(1), "s"), ("K1", "B", ts(3), "s"), ("K2", "C", ts(2), "s")])
    cur = V.current_satellite(V.new_satellite_rows(b, "hk", "hd", ["attr"]), "hk", "hd")
    assert sorted(r.attr for r in cur.collect()) == ["B", "C"]


def test_tlink_dedupes_on_event_key(spark):
    df = spark.createDataFrame([("t1", "c1", 10, ts(1)), ("t1", "c1", 10, ts(2)), ("t2", "c1", 5, ts(1))],
                               "t string, c string, amount int, load_dts timestamp").withColumns(
        {"t_hk": hash_key("t"), "c_hk": hash_key("c"), "record_source": F.lit("s"), "effective_from": F.lit(T0)})
    out = V.new_tlink_rows(df, "t_hk", ["c_hk"], ["amount"])
    assert out.count() == 2


def test_persisted_loads_are_idempotent(spark, tmp):
    b = staged(spark, [("K1", "A", ts(1), "s"), ("K2", "B", ts(2), "s")])
    path = f"{tmp}/hub"
    V.load_hub(spark, path, b, "hk", "bk")
    V.load_hub(spark, path, b, "hk", "bk")
    assert spark.read.parquet(path).count() == 2
    spath = f"{tmp}/sat"
    V.load_satellite(spark, spath, b, "hk", "hd", ["attr"])
    V.load_satellite(spark, spath, b, "hk", "hd", ["attr"])
    assert spark.read.parquet(spath).count() == 2


def test_loaders_move_every_row_once(spark):
    """The least row is a plain min over the row (min_by would shuffle it twice), and a satellite joins no row back."""
    s = spark.sql("SELECT 'k' AS pk, 'f' AS fk, 'h' AS hd, 1 AS v, TIMESTAMP '2024-01-01 00:00:00' AS load_dts, 'r' AS record_source")
    frames = {"link": V.new_link_rows(s, "pk", ["fk"]), "satellite": V.new_satellite_rows(s, "pk", "hd", ["v"]),
              "current": V.current_satellite(s.select("pk", "hd", "v", "load_dts", "record_source"), "pk", "hd")}
    plans = {n: f._jdf.queryExecution().optimizedPlan().toString() for n, f in frames.items()}
    assert not any(w in p for p in plans.values() for w in ("min_by", "minby", "max_by", "maxby"))
    assert "Join" not in plans["satellite"]


def test_keys_as_bytes_give_the_same_tables(spark):
    """A vault built with 16-byte keys holds the rows of one built with text keys; facts and surrogates agree."""
    from tests import fixtures as FX
    from vaultmart.functions.hashing import as_text
    from vaultmart.plans import gold
    from vaultmart.plans.build import build_vault

    def shown(df):
        return sorted(str(tuple(r)) for r in df.select(*[as_text(c, df).alias(c) if c.endswith(("_hk", "hashdiff")) else c for c in df.columns]).collect())
    text, raw = (build_vault(FX.bronze(spark), load_dts=FX.LOAD1, key_bytes=b) for b in (False, True))
    assert text.keys() == raw.keys()
    for name in ("lnk_claim_provider_member", "sat_claim_details", "tlnk_claim_payment_txn"):
        assert dict(raw[name].dtypes)["claim_line_hk"] == "binary"
        assert shown(raw[name]) == shown(text[name])
    for fact in (gold.fact_claim_payment, gold.fact_hcc_capture):
        assert shown(fact(raw)) == shown(fact(text))
