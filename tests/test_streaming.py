import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.plans import ops as OPS
from vaultmart.plans.build import load_vault
from vaultmart.streaming import audit as AUD
from vaultmart.streaming import gateway as GATEWAY
from vaultmart.streaming import joined as JOINED
from vaultmart.streaming import schema_log as LOG
from vaultmart.streaming.committed import CommittedBatches
from vaultmart.streaming.landing import land_stream, vault_stream
from tests import fixtures as FX
from tests.conftest import rows


def _event(i, minute, status="success", latency=100, tool="query_metric", args='{"m": 1}'):
    return {"event_id": f"e{i}", "timestamp_utc": f"2024-01-01T00:{minute:02d}:10", "session_id": "s",
            "caller_identity": "agent", "user_question": "q", "tool_name": tool, "tool_arguments": args,
            "resolved_metric": None, "matched_synonym": None, "status": status, "error_message": None,
            "latency_ms": latency, "row_count_returned": 1}


def _write(path, events):
    with open(path, "w") as f:
        for e in events:
            f.write(json.dumps(e) + "\n")


def test_stream_alerts_equal_batch_on_closed_windows(spark, tmp):
    src = os.path.join(tmp, "events")
    os.makedirs(src)
    evs = [_event(i, i % 10, "error" if i % 3 == 0 else "success", 6000 if i % 7 == 0 else 100)
           for i in range(60)]
    evs.append(_event(5, 5, "error"))                         # duplicate delivery of e5
    evs.append(_event(999, 30))                               # advances the watermark past minute 0-9 windows
    _write(os.path.join(src, "part-0.json"), evs)
    stream = AUD.deduplicated(AUD.read_tool_calls(spark, src), "2 minutes")
    got = AUD.run_to_table(spark, AUD.error_rate_stream(stream, "1 minute", None), "t-err")
    batch = spark.read.schema(AUD.TOOL_CALL_SCHEMA).json(src).withColumn(
        "timestamp_utc", F.to_timestamp("timestamp_utc")).dropDuplicates(["event_id"])
    want = OPS.error_rate_alerts(batch, "1 minute").where(F.col("window_end") <= F.lit("2024-01-01 00:28:10"))
    assert rows(got, "window_start", "calls", "errors") == rows(want, "window_start", "calls", "errors")
    assert got.count() > 0


def test_late_rows_are_dropped(spark, tmp):
    src = os.path.join(tmp, "late")
    os.makedirs(src)
    _write(os.path.join(src, "a.json"), [_event(i, 20) for i in range(3)] + [_event(9, 40)])
    q_root = os.path.join(tmp, "late-run")
    stream = AUD.read_tool_calls(spark, src)
    agg = stream.withWatermark("timestamp_utc", "2 minutes").groupBy(F.window("timestamp_utc", "1 minute")).count()
    q = AUD.write_batches(agg, os.path.join(q_root, "out"), os.path.join(q_root, "ck"))
    q.awaitTermination()
    _write(os.path.join(src, "b.json"), [_event(50, 20)])        # minute 20 arrives after the watermark passed
    q = AUD.write_batches(agg, os.path.join(q_root, "out"), os.path.join(q_root, "ck"))
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(q_root, "out"))
    assert rows(out.select(F.col("window.start").alias("s"), "count"), "count") == [(3,)]


def test_land_stream_picks_up_new_files_once(spark, tmp):
    src = os.path.join(tmp, "raw")
    os.makedirs(src)
    with open(os.path.join(src, "f1.csv"), "w") as f:
        f.write("member_bk,hcc_bk\nM1,H18\nM2,H19\n")
    schema = "member_bk string, hcc_bk string"
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)
    target, ck = os.path.join(tmp, "bronze"), os.path.join(tmp, "ck")
    land_stream(spark, src, st, target, ck, "ra_suspected_hcc").awaitTermination()
    with open(os.path.join(src, "f2.csv"), "w") as f:
        f.write("member_bk,hcc_bk\nM3,H18\n")
    land_stream(spark, src, st, target, ck, "ra_suspected_hcc").awaitTermination()
    df = spark.read.parquet(target)
    assert df.count() == 3 and {"record_source", "load_dts", "source_file"} <= set(df.columns)


def test_vault_stream_is_idempotent(spark, tmp):
    b = FX.bronze(spark)
    src = os.path.join(tmp, "claims")
    b["pi_payment_transactions"].write.parquet(src)
    root, ck = os.path.join(tmp, "vault"), os.path.join(tmp, "vck")
    names = ["tlnk_claim_payment_txn"]

    def to_bronze(batch):
        return {"pi_payment_transactions": batch}
    stream = spark.readStream.schema(b["pi_payment_transactions"].schema).parquet(src)
    vault_stream(spark, stream, to_bronze, root, ck, names).awaitTermination()
    assert spark.read.parquet(os.path.join(root, "tlnk_claim_payment_txn")).count() == 4
    # a replayed batch (fresh checkpoint, same files) appends nothing
    vault_stream(spark, spark.readStream.schema(b["pi_payment_transactions"].schema).parquet(src), to_bronze, root,
                 os.path.join(tmp, "vck2"), names).awaitTermination()
    assert spark.read.parquet(os.path.join(root, "tlnk_claim_payment_txn")).count() == 4
    assert load_vault(spark, root, to_bronze(b["pi_payment_transactions"]), names=names)[
        "tlnk_claim_payment_txn"].count() == 4


REQUEST = ("request_id string, request_seq long, timestamp_utc timestamp, feature string, provider string, "
           "prompt_tokens int, max_completion_tokens int, completion_tokens int")


def _requests(n=60):
    t0 = dt.datetime(2024, 1, 1, 9)
    return [(f"r{i}", i, t0 + dt.timedelta(hours=i), ["metric-lookup", "other", "semantic-layer-qa"][i % 3],
             "provider-a-large" if i % 7 else "nobody", 20_000 + 997 * i, 5_000, 9_000) for i in range(n)]


def _run_admission(spark, src, root, checkpoint):
    stream = spark.readStream.schema(REQUEST).parquet(src)
    GATEWAY.budget_admission_stream(spark, stream, root, checkpoint).awaitTermination()


def test_budget_admission_stream_equals_the_batch_job(spark, tmp):
    """Four micro-batches in time order; ledgers carried across them; no state per ledger in the stream."""
    rows_, src, root = _requests(), os.path.join(tmp, "req"), os.path.join(tmp, "adm")
    for i in range(0, 60, 15):
        spark.createDataFrame(rows_[i:i + 15], REQUEST).coalesce(1).write.mode("append").parquet(src)
        _run_admission(spark, src, root, os.path.join(tmp, "ck"))
    key = ("request_id", "decision", "booked_micro", "spent_after_micro")
    want = rows(OPS.budget_admission(spark, spark.createDataFrame(rows_, REQUEST)).select(*key).fillna(-1))
    got = GATEWAY.admission_decisions(spark, root)
    assert rows(got.select(*key).fillna(-1)) == want and {r[1] for r in want} == {"admitted", "over_budget", "unknown_provider"}


def test_a_replayed_micro_batch_books_nothing_twice(spark, tmp):
    """The second batch crashes behind its ledger version, then runs again from the same checkpoint."""
    rows_, src, root, ck = _requests(30), os.path.join(tmp, "req"), os.path.join(tmp, "adm"), os.path.join(tmp, "ck")
    spark.createDataFrame(rows_[:15], REQUEST).coalesce(1).write.mode("append").parquet(src)
    _run_admission(spark, src, root, ck)
    spark.createDataFrame(rows_[15:], REQUEST).coalesce(1).write.mode("append").parquet(src)
    write, calls = CommittedBatches.write, []

    def crash_on_second(self, df, batch_id, part="all"):
        calls.append(self.root)
        if len(calls) == 2:
            raise RuntimeError("lost")
        write(self, df, batch_id, part)
    CommittedBatches.write = crash_on_second
    try:
        with pytest.raises(Exception):  # noqa: B017
            _run_admission(spark, src, root, ck)
    finally:
        CommittedBatches.write = write
    assert GATEWAY.admission_decisions(spark, root).count() == 15           # readers see whole batches only
    _run_admission(spark, src, root, ck)
    key = ("request_id", "decision", "booked_micro", "spent_after_micro")
    want = rows(OPS.budget_admission(spark, spark.createDataFrame(rows_, REQUEST)).select(*key).fillna(-1))
    assert rows(GATEWAY.admission_decisions(spark, root).select(*key).fillna(-1)) == want
    ledgers = CommittedBatches(spark, f"{root}/ledgers")
    assert ledgers.manifest().where("batch_id = 1").count() == 1 and ledgers.last_before(2) == 1


def test_calls_joined_with_costs_as_streams(spark, tmp):
    """A match, a cost outside the bound, a call whose cost never comes, a late cost that the watermark drops."""
    t0 = dt.datetime(2024, 1, 1)
    calls_schema, costs_schema = "event_id string, timestamp_utc timestamp, tool_name string, status string", "event_id string, timestamp_utc timestamp, cost_dollars double"
    calls = [(f"e{i}", t0 + dt.timedelta(minutes=i), "t", "ok") for i in range(6)] + [("end", t0 + dt.timedelta(days=1), "t", "ok")]
    costs = [("e0", t0, 1.0), ("e1", t0 + dt.timedelta(minutes=59), 2.0), ("e2", t0 + dt.timedelta(hours=3), 4.0), ("x", t0, 8.0),
             ("end", t0 + dt.timedelta(days=1), 16.0)]
    a, b = os.path.join(tmp, "calls"), os.path.join(tmp, "costs")
    spark.createDataFrame(calls, calls_schema).write.parquet(a)
    spark.createDataFrame(costs, costs_schema).write.parquet(b)
    joined = JOINED.calls_with_cost(spark.readStream.schema(calls_schema).parquet(a), spark.readStream.schema(costs_schema).parquet(b))

    def run():
        AUD.write_batches(joined, os.path.join(tmp, "out"), os.path.join(tmp, "ck")).awaitTermination()
    run()
    spark.createDataFrame([("e3", t0 + dt.timedelta(minutes=3), 32.0)], costs_schema).write.mode("append").parquet(b)      # late
    run()
    got = {r.event_id: r.cost_dollars for r in spark.read.parquet(os.path.join(tmp, "out")).collect()}
    assert got == {"e0": 1.0, "e1": 2.0, "e2": None, "e3": None, "e4": None, "e5": None, "end": 16.0}
    total = JOINED.behaviour_and_cost(spark.read.parquet(os.path.join(tmp, "out"))).first()
    assert (total.calls, total.cost_dollars, total.calls_without_cost) == (3, 19.0, 4)


def test_alert_job_is_exactly_once(spark, tmp):
    """One job for three rules; a batch that crashes between two rules is run again and every alert stands once."""
    src = os.path.join(tmp, "events")
    os.makedirs(src)
    _write(os.path.join(src, "a.json"), [_event(i, i % 10, "error" if i % 3 == 0 else "success", 6000 if i % 7 == 0 else 100) for i in range(80)])
    _write(os.path.join(src, "b.json"), [_event(999, 40)])
    root, ck = os.path.join(tmp, "alerts"), os.path.join(tmp, "ck")
    alerts = AUD.alert_table_stream(AUD.read_tool_calls(spark, src), "1 minute", "2 minutes")
    write, calls = CommittedBatches.write, []

    def crash(self, df, batch_id, part="all"):
        calls.append(part)
        if len(calls) == 5:
            raise RuntimeError("lost")
        write(self, df, batch_id, part)
    CommittedBatches.write = crash
    try:
        with pytest.raises(Exception):  # noqa: B017
            AUD.write_alerts(spark, alerts, root, ck).awaitTermination()
    finally:
        CommittedBatches.write = write
    AUD.write_alerts(spark, alerts, root, ck).awaitTermination()
    batch = spark.read.schema(AUD.TOOL_CALL_SCHEMA).json(src).withColumn("timestamp_utc", F.to_timestamp("timestamp_utc"))
    want = OPS.alert_table(batch, "1 minute")
    got = CommittedBatches(spark, root).table()
    assert rows(got, "alert_id") == rows(want, "alert_id") and {r.rule for r in got.collect()} == set(AUD.ALERT_RULES)
    AUD.write_alerts(spark, alerts, root, ck).awaitTermination()             # nothing new: nothing is added
    assert CommittedBatches(spark, root).table().count() == got.count()


def test_schema_log_loses_nothing(spark, tmp):
    """Unknown fields, values that fit no type, nested values, lines that are no JSON; then the new fields are adopted."""
    src, root = os.path.join(tmp, "in"), os.path.join(tmp, "t")
    os.makedirs(src)
    log = LOG.SchemaLog(spark, os.path.join(tmp, "log"))
    assert log.version() == 0 and log.adopt(T.StructType().add("id", "string").add("n", T.IntegerType())) == 1
    lines = ['{"id": "a", "n": 1}', '{"id": "b", "n": "many", "region": "x", "tries": 3}', '{"id": "c", "nested": {"k": [1, 2]}, "tries": "often"}',
             "no json", '{"n": null, "region": null}', ""]
    with open(os.path.join(src, "one.json"), "w") as f:
        f.write("\n".join(lines) + "\n")
    LOG.land_events(spark, src, log, root, os.path.join(tmp, "ck")).awaitTermination()
    table = CommittedBatches(spark, root)
    assert LOG.unknown_fields(table.table()) == ["nested", "region", "tries"]
    assert log.adopt(T.StructType().add("region", "string").add("tries", T.IntegerType()).add("n", "string")) == 2    # a known field keeps its type
    assert log.adopt(T.StructType().add("region", "string")) == 2 and log.schema().names == ["id", "n", "region", "tries"]
    with open(os.path.join(src, "two.json"), "w") as f:
        f.write('{"id": "d", "n": 4, "region": "y", "tries": 5}\n')
    LOG.land_events(spark, src, log, root, os.path.join(tmp, "ck")).awaitTermination()
    got = {(r.id, r.n, r.region, r.tries, str(r.rescued), r.unparsed, r.schema_version) for r in LOG.read_events(table.table(), log).collect()}
    assert got == {("a", 1, None, None, "None", None, 1), ("b", None, "x", 3, "{'n': 'many'}", None, 1),
                   ("c", None, None, None, "{'nested': '{\"k\":[1,2]}', 'tries': 'often'}", None, 1), (None, None, None, None, "None", "no json", 1),
                   (None, None, None, None, "None", None, 1), (None, None, None, None, "None", "", 1), ("d", 4, "y", 5, "None", None, 2)}
