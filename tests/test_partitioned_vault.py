import random
import tempfile

import pytest
from pyspark.sql import functions as F

from vaultmart.operators import partitioned_vault as PV
from vaultmart.operators import vault as V
from tests.conftest import rows
from tests.test_vault import staged, ts


def batches(seed, n=3):
    """Time-ordered batches of versions; keys come back, attributes change and change back."""
    rng, out, day = random.Random(seed), [], 0
    for _ in range(n):
        part = []
        for _ in range(60):
            day += rng.randint(0, 1)
            part.append((f"K{rng.randint(0, 40)}", rng.choice("abc"), ts(day), "s"))
        out.append(part + [(None, "x", ts(day), "s")])
        day += 1
    return out


TABLES = {
    "hub": lambda spark, root: PV.hub_table(spark, root, "hk", "bk"),
    "link": lambda spark, root: PV.link_table(spark, root, "hk", ["hd"]),
    "tlink": lambda spark, root: PV.tlink_table(spark, root, "hk", ["hd"], ["attr"], "bk"),
    "sat": lambda spark, root: PV.SatelliteTable(spark, root, "hk", "hd", ["attr"]),
}
PLAIN = {
    "hub": lambda s: V.new_hub_rows(s, "hk", "bk"),
    "sat": lambda s: V.new_satellite_rows(s, "hk", "hd", ["attr"]),
}


@pytest.mark.parametrize("kind,seed", [("hub", 0), ("sat", 0), ("sat", 1)])
def test_several_loads_equal_one(spark, tmp, kind, seed):
    table, parts = TABLES[kind](spark, tmp + "/t"), batches(seed)
    for i, part in enumerate(parts):
        table.load(staged(spark, part), i)
    want = PLAIN[kind](staged(spark, [r for part in parts for r in part]))
    assert rows(table.table().select(*want.columns)) == rows(want)
    if kind == "sat":
        assert rows(table.current().select(*want.columns)) == rows(V.current_satellite(want, "hk", "hd"))
        before = table.version()
        table.load(staged(spark, parts[-1]), 99)                       # nothing new: the snapshot stays as it is
        assert rows(table.table().select(*want.columns)) == rows(want) and table.version() == before + 1


def test_links_and_transactional_links(spark, tmp):
    for kind in ("link", "tlink"):
        table = TABLES[kind](spark, f"{tmp}/{kind}")
        first = staged(spark, [("K1", "a", ts(1), "s"), ("K2", "b", ts(1), "s")])
        table.load(first, 0)
        table.load(first.unionByName(staged(spark, [("K3", "c", ts(2), "s")])), 1)
        assert table.table().count() == 3


def test_a_load_reads_only_the_partitions_of_its_keys(spark, tmp):
    hub = TABLES["hub"](spark, tmp + "/h")
    hub.load(staged(spark, [(f"K{i}", "a", ts(1), "s") for i in range(500)]))
    batch = V.new_hub_rows(staged(spark, [("K1", "a", ts(2), "s"), ("new", "a", ts(2), "s")]), "hk", "bk")
    prefixes = hub.prefixes(batch)
    plan = hub.unseen(batch, prefixes)._jdf.queryExecution().executedPlan().toString()
    assert len(prefixes) == 2 and "key_prefix" in plan.split("PartitionFilters:")[1].split("]")[0]
    files = lambda df: df.select(F.input_file_name()).distinct().count()
    assert 0 < files(hub.history([f"k{p}" for p in prefixes])) <= 2 and files(hub.history()) > 100


def test_a_bloom_filter_stands_before_a_large_target(spark, tmp):
    """Spark sets it itself where the target is large; here the sizes it asks for are set to nothing."""
    hub = TABLES["hub"](spark, tmp + "/h")
    hub.load(staged(spark, [(f"K{i}", "a", ts(1), "s") for i in range(300)]))
    rows_path = tmp + "/batch"
    V.new_hub_rows(staged(spark, [(f"K{i}", "a", ts(2), "s") for i in range(290, 320)]), "hk", "bk").write.parquet(rows_path)
    batch = spark.read.parquet(rows_path)
    conf = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = hub.unseen(batch, hub.prefixes(batch))
        assert "might_contain" in got._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(r.bk for r in got.collect()) == [f"K{i}" for i in range(300, 320)]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_load_rewrites_touched_partitions_only(spark, tmp):
    sat = TABLES["sat"](spark, tmp + "/s")
    sat.load(staged(spark, [(f"K{i}", "a", ts(1), "s") for i in range(300)]))
    before = {e[PV.PREFIX]: e["path"] for e in sat.manifest() if e["area"] == PV.CURRENT}
    change = staged(spark, [("K7", "b", ts(2), "s"), ("K8", "a", ts(2), "s")])        # K8 does not change
    touched = {"k" + r[0] for r in change.where("bk = 'K7'").select(F.substring("hk", 1, 2)).collect()}
    sat.load(change)
    after = {e[PV.PREFIX]: e["path"] for e in sat.manifest() if e["area"] == PV.CURRENT}
    assert {k for k in after if after[k] != before.get(k)} == touched
    assert sat.current().count() == 300 and sat.current().where("attr = 'b'").count() == 1
    assert rows(sat.current(version=1), "attr") == [("a",)] * 300                       # the version before stays readable


def test_a_crash_before_the_commit_leaves_the_old_version(spark, tmp, monkeypatch):
    sat = TABLES["sat"](spark, tmp + "/s")
    sat.load(staged(spark, [("K1", "a", ts(1), "s")]), 0)
    second = staged(spark, [("K1", "b", ts(2), "s"), ("K2", "c", ts(2), "s")])
    with monkeypatch.context() as m:
        m.setattr(sat, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            sat.load(second, 1)
    assert rows(sat.table(), "attr") == [("a",)] and rows(sat.current(), "attr") == [("a",)] and sat.version() == 1
    sat.load(second, 1)
    assert rows(sat.table(), "attr") == [("a",), ("b",), ("c",)] and rows(sat.current(), "attr") == [("b",), ("c",)]
    sat.load(second, 1)                                                                 # a committed batch is skipped
    assert sat.version() == 2


def test_empty_batches(spark, tmp):
    for kind, make in TABLES.items():
        table = make(spark, f"{tmp}/{kind}")
        table.load(staged(spark, []), 0)
        assert table.table() is None and table.version() == 1
        table.load(staged(spark, [("K1", "a", ts(1), "s")]), 1)
        assert table.table().count() == 1


def test_a_delivery_is_written_once_and_arrives_whole(spark):
    """Every part arrives with all its files (a task names its files alike in all parts), in the order of time, and no row is written twice."""
    from vaultmart.plans.queries import micro_batches
    rows = spark.range(0, 300, 1, 4).select("id", F.timestamp_seconds(F.col("id") * 60).alias("at"))
    seen = []

    def run(stream):
        checkpoint = seen[0][0] if seen else tempfile.mkdtemp()
        return stream.writeStream.foreachBatch(lambda b, n: seen.append((checkpoint, sorted(r.id for r in b.collect())))).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    micro_batches(spark, rows, "at", run)
    ids = [i for _, b in seen for i in b]
    assert ids == list(range(300)) and len([b for _, b in seen if b]) == 3


def test_a_table_of_byte_keys_is_partitioned_like_one_of_text_keys(spark, tmp):
    s = spark.range(40).select(F.md5(F.col("id").cast("string")).alias("pk"), F.col("id").cast("string").alias("bk"),
                               F.lit("2024-01-01").cast("timestamp").alias("load_dts"), F.lit("r").alias("record_source"))
    raw = s.withColumn("pk", F.unhex("pk"))
    text, as_bytes = PV.hub_table(spark, f"{tmp}/text", "pk", "bk"), PV.hub_table(spark, f"{tmp}/bytes", "pk", "bk")
    for batch in (0, 1):
        text.load(s.where(F.col("bk").cast("int") < 25) if batch == 0 else s, batch)
        as_bytes.load(raw.where(F.col("bk").cast("int") < 25) if batch == 0 else raw, batch)
    assert text.prefixes(s) == as_bytes.prefixes(raw)
    shown = as_bytes.table().withColumn("pk", F.lower(F.hex("pk")))
    assert sorted(map(tuple, shown.collect())) == sorted(map(tuple, text.table().collect())) and shown.count() == 40
