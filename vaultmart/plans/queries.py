"""Registered queries: one per operator / model / metric, over the proxy
inputs derived from the driver's tables.  Each takes (spark, sf_dir)
and returns a lazy DataFrame; ``present`` renders decimals as doubles and
dates/timestamps as text so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.functions.hashing import HOME, as_text
from vaultmart.plans import gold
from vaultmart.plans import registry as R
from vaultmart.plans.build import build_vault
from vaultmart.plans.semantic import MetricStore
from vaultmart.session import materialize_all
from vaultmart.sources import proxy

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.drop(HOME).schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.BinaryType):            # hash keys travel as bytes
            c = as_text(f.name, df)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def vault(spark: SparkSession, sf_dir: str, names: list[str] | None = None, bronze_names=None, columns=None, gather: bool = True,
          one_job: bool = False) -> dict:
    bronze = proxy.bronze(spark, sf_dir, bronze_names)
    header = bronze.get("synpuf_inpatient_claim_header")
    if header is not None and names is not None and "sat_claim_details" not in names:
        # only the satellite reads a claim's dates and amounts: for hubs and links they are neither joined nor written
        bronze["synpuf_inpatient_claim_header"] = header.select(*[
            F.col(f.name) if f.name in HEADER_KEYS else F.lit(None).cast(f.dataType).alias(f.name) for f in header.schema.fields])
    return build_vault(bronze, names=names, spark=spark, key_bytes=True, reread=proxy.projections(), columns=columns,
                       gather=gather, one_job=one_job)


HEADER_KEYS = ("claim_line_bk", "member_bk", "provider_bk", "drg_bk", "record_source", "load_dts")
PAYMENT_VAULT = ["tlnk_claim_payment_txn", "lnk_claim_provider_member", "lnk_claim_drg", "sat_claim_details"]
PAYMENT_BRONZE = ["pi_payment_transactions", "synpuf_inpatient_claim_header"]


@query("m02_payment_leakage_rate_by_provider_year")
def q_leakage_rate(spark, sf_dir):
    used = used_columns(["payment_leakage_rate"], ["provider", "metric_time"])
    ms = MetricStore(vault=gold_vault(spark, sf_dir, "fact_claim_payment", used=used))
    return present(ms.query(["payment_leakage_rate"], group_by=["provider", "metric_time"], grain="year"))


# ---------------------------------------------------------------------------
# hashing and hashed staging
# ---------------------------------------------------------------------------
from vaultmart.functions.hashing import hashdiff, hash_key  # noqa: E402
from vaultmart.operators import vault as V  # noqa: E402
from vaultmart.plans import staging as S  # noqa: E402
from vaultmart.plans.build import hashed_staging, moved_once  # noqa: E402


def bronze(spark, sf_dir, names=None):
    return proxy.bronze(spark, sf_dir, names)


@query("c03_stage_claim_lines_keys")
def q_stage_claims(spark, sf_dir):
    # claims move once, to their business key, and are hashed and joined there: the key is their home, so equal homes are equal keys
    header = "synpuf_inpatient_claim_header"
    st = S.stg_claim_lines({header: moved_once(bronze(spark, sf_dir, [header])[header], F.col("claim_line_bk"))})
    hs = hashed_staging({"stg_claim_lines": st}, ["stg_claim_lines_hk", "stg_claim_lines_sat_hk"], gather=True)
    a = hs["stg_claim_lines_hk"].select(HOME, "claim_line_bk", "claim_line_hk", "provider_hk", "member_hk",
                                        "claim_provider_member_hk")
    b = hs["stg_claim_lines_sat_hk"].select(HOME, "claim_hashdiff")
    return a.join(b, HOME).drop(HOME)


def _two_batches(staged: DataFrame, cutoff: str = "1998-01-01"):
    first = staged.where(F.col("load_dts") < F.lit(cutoff).cast("timestamp"))
    return first, staged


@query("c04_hub_claim_line_two_batches")
def q_hub_two_batches(spark, sf_dir):
    st = S.stg_claim_lines(bronze(spark, sf_dir, ["synpuf_inpatient_claim_header"]))
    hs = hashed_staging({"stg_claim_lines": st}, ["stg_claim_lines_hk"])["stg_claim_lines_hk"]
    b1, b2 = _two_batches(hs)
    target = V.new_hub_rows(b1, "claim_line_hk", "claim_line_bk")
    new = V.new_hub_rows(b2, "claim_line_hk", "claim_line_bk", target)
    return present(target.unionByName(new))


@query("c04_hub_member_two_sources")
def q_hub_member(spark, sf_dir):
    st = S.stg_members(bronze(spark, sf_dir, ["synpuf_beneficiary_summary", "synthea_patients"]))
    hs = hashed_staging({"stg_members": st}, ["stg_members_hk"])["stg_members_hk"]
    return present(V.new_hub_rows(hs, "member_hk", "member_bk"))


@query("c05_link_encounter_provider")
def q_link_enc_provider(spark, sf_dir):
    st = S.stg_encounters(bronze(spark, sf_dir, ["synthea_encounters"]))
    hs = hashed_staging({"stg_encounters": st}, ["stg_encounters_hk"])["stg_encounters_hk"]
    b1, b2 = _two_batches(hs)
    target = V.new_link_rows(b1, "encounter_provider_hk", ["encounter_hk", "provider_hk"])
    new = V.new_link_rows(b2, "encounter_provider_hk", ["encounter_hk", "provider_hk"], target)
    return present(target.unionByName(new))


def _priority_staged(spark, sf_dir):
    """Orders as attribute versions of a member: priority and status per order date."""
    proxy.register_driver_tables(spark, sf_dir, ["orders"])
    o = spark.table("orders")
    df = o.select(F.col("o_custkey").cast("string").alias("member_bk"), "o_orderpriority", "o_orderstatus",
                  F.col("o_orderdate").cast("timestamp").alias("load_dts"), F.lit("proxy.orders").alias("record_source"))
    return df.select("*", hash_key("member_bk").alias("member_hk"),
                     hashdiff(["o_orderpriority", "o_orderstatus"], df).alias("status_hashdiff"))


@query("c06_satellite_history_two_batches")
def q_sat_history(spark, sf_dir):
    st = _priority_staged(spark, sf_dir)
    b1, b2 = _two_batches(st)
    payload = ["o_orderpriority", "o_orderstatus"]
    target = V.new_satellite_rows(b1, "member_hk", "status_hashdiff", payload)
    new = V.new_satellite_rows(b2, "member_hk", "status_hashdiff", payload, target)
    return present(target.unionByName(new))


@query("c08_current_satellite")
def q_current_sat(spark, sf_dir):
    st = _priority_staged(spark, sf_dir)
    sat = V.new_satellite_rows(st, "member_hk", "status_hashdiff", ["o_orderpriority", "o_orderstatus"])
    return present(V.current_satellite(sat, "member_hk", "status_hashdiff"))


@query("c07_tlink_measure_eval")
def q_tlink_eval(spark, sf_dir):
    st = S.stg_member_measure_evals(bronze(spark, sf_dir, ["cq_member_measure_evals"]))
    hs = hashed_staging({"stg_member_measure_evals": st}, ["stg_member_measure_evals_hk"])
    return present(V.new_tlink_rows(hs["stg_member_measure_evals_hk"], "member_measure_eval_txn_hk",
                                    ["member_hk", "measure_hk"], ["eval_result", "eval_date"]))


# ---------------------------------------------------------------------------
# landing and staging (A, B)
# ---------------------------------------------------------------------------
from vaultmart.operators.dedupe import dedupe_latest  # noqa: E402
from vaultmart.sources.ingest import orphan_rows  # noqa: E402


@query("a02_dedupe_latest_order_per_customer")
def q_dedupe(spark, sf_dir):
    proxy.register_driver_tables(spark, sf_dir, ["orders"])
    return present(dedupe_latest(spark.table("orders"), ["o_custkey"], [F.col("o_orderdate")]))


@query("a05_unpivot_claim_diagnoses")
def q_unpivot(spark, sf_dir):
    return present(bronze(spark, sf_dir, ["synpuf_inpatient_claim_diagnoses"])["synpuf_inpatient_claim_diagnoses"])


@query("a09_orphan_claim_drgs")
def q_orphans(spark, sf_dir):
    b = bronze(spark, sf_dir, ["synpuf_inpatient_claim_header", "drg_weights"])
    claims = b["synpuf_inpatient_claim_header"].where(F.trim("drg_bk") != "")
    orphans = orphan_rows(claims, b["drg_weights"], "drg_bk")
    return orphans.groupBy("drg_bk").agg(F.count(F.lit(1)).alias("orphan_claims"))


@query("b01_stg_members")
def q_stg_members(spark, sf_dir):
    return present(S.stg_members(bronze(spark, sf_dir, ["synpuf_beneficiary_summary", "synthea_patients"])))


@query("b02_stg_diagnoses")
def q_stg_diag(spark, sf_dir):
    return present(S.stg_diagnoses(bronze(spark, sf_dir, ["synpuf_inpatient_claim_diagnoses",
                                                           "synthea_conditions"])))


@query("b03_stg_drgs")
def q_stg_drgs(spark, sf_dir):
    return present(S.stg_drgs(bronze(spark, sf_dir, ["synpuf_inpatient_claim_header", "drg_weights"])))


@query("b11_stg_pharmacies")
def q_stg_pharm(spark, sf_dir):
    return present(S.stg_pharmacies(bronze(spark, sf_dir, ["nppes_facilities"])))


@query("b12_stg_drugs")
def q_stg_drugs(spark, sf_dir):
    return present(S.stg_drugs(bronze(spark, sf_dir, ["ndc_products"])))


# ---------------------------------------------------------------------------
# gold dimensions and facts
# ---------------------------------------------------------------------------
# vault tables and bronze views each gold model needs
_DIM_DEPS = {
    "dim_member": (["hub_member", "sat_member_demographics"], ["synpuf_beneficiary_summary", "synthea_patients"]),
    "dim_provider": (["hub_provider", "sat_provider_details"], ["nppes_providers"]),
    "dim_procedure": (["hub_procedure", "sat_procedure_details"], ["synpuf_inpatient_claim_procedures"]),
    "dim_drg": (["hub_drg", "sat_drg_details"], ["synpuf_inpatient_claim_header", "drg_weights"]),
    "dim_drug": (["hub_drug", "sat_drug_details"], ["ndc_products"]),
    "dim_encounter": (["hub_encounter", "sat_encounter_details"], ["synthea_encounters"]),
    "dim_hcc_category": (["hub_hcc_category", "sat_hcc_category_details"], ["ra_hcc_categories"]),
    "dim_measure": (["hub_measure", "sat_measure_definition"], ["cq_measures"]),
    "dim_authorization": (["hub_authorization", "sat_authorization_details"], ["pi_authorizations"]),
    "dim_appeal": (["hub_appeal", "sat_appeal_details"], ["pi_appeals"]),
}
_PAY = (PAYMENT_VAULT, PAYMENT_BRONZE)
_FACT_DEPS = {
    "fact_claim_payment": _PAY,
    "fact_claim_adjustment": (["tlnk_claim_adjustment_txn", "lnk_claim_provider_member"],
                              ["pi_adjustment_transactions", "synpuf_inpatient_claim_header"]),
    "fact_cob_recovery": (["tlnk_cob_recovery_txn", "lnk_claim_provider_member"],
                          ["pi_cob_recovery_transactions", "synpuf_inpatient_claim_header"]),
    "fact_drg_reimbursement_variance": (PAYMENT_VAULT + ["hub_drg", "sat_drg_details"], PAYMENT_BRONZE + ["drg_weights"]),
    "fact_authorization": (["hub_authorization", "sat_authorization_details", "lnk_claim_authorization"],
                           ["pi_authorizations"]),
    "fact_appeal": (["hub_appeal", "sat_appeal_details", "lnk_claim_appeal"], ["pi_appeals"]),
    "fact_member_risk_score": (["tlnk_member_risk_score_txn"], ["ra_member_risk_scores"]),
    "fact_member_risk_tier": (["tlnk_member_risk_score_txn"], ["ra_member_risk_scores"]),
    "fact_hcc_capture": (["lnk_member_suspected_hcc", "lnk_member_hcc"], ["ra_suspected_hcc", "ra_member_hcc"]),
    "fact_coding_gap": (["lnk_member_hcc", "sat_member_hcc_status"], ["ra_member_hcc"]),
    "fact_risk_score_accuracy": (["lnk_member_suspected_hcc", "lnk_member_hcc", "hub_hcc_category",
                                  "sat_hcc_category_details", "tlnk_member_risk_score_txn"],
                                 ["ra_suspected_hcc", "ra_member_hcc", "ra_hcc_categories", "ra_member_risk_scores"]),
    "fact_encounter": (["hub_encounter", "sat_encounter_details", "lnk_member_encounter", "lnk_encounter_provider",
                        "lnk_encounter_facility"], ["synthea_encounters"]),
    "fact_measure_evaluation": (["tlnk_member_measure_eval_txn", "hub_measure", "sat_measure_definition"],
                                ["cq_member_measure_evals", "cq_measures"]),
    "fact_pharmacy_fill": (["tlnk_pharmacy_fill_txn", "hub_drug", "sat_drug_details"],
                           ["pharmacy_fills", "ndc_products"]),
}
_FACT_DEPS["fact_readmission"] = _FACT_DEPS["fact_encounter"]
_FACT_DEPS["fact_preventive_screening"] = _FACT_DEPS["fact_measure_evaluation"]
_FACT_DEPS["fact_care_gap"] = _FACT_DEPS["fact_measure_evaluation"]
_FACT_DEPS["fact_medication_adherence"] = _FACT_DEPS["fact_pharmacy_fill"]
GOLD_DEPS = {**_DIM_DEPS, **_FACT_DEPS}


def gold_columns(name: str) -> list[str]:
    """What the star schema may read of a vault table: no lineage, but a satellite's load stamp."""
    t = R.BY_NAME[name]
    if isinstance(t, R.Hub):
        return [t.bk]
    if isinstance(t, R.Link):
        return list(t.fks)
    return [*t.payload, "load_dts"] if isinstance(t, R.Satellite) else [*t.fks, *t.payload, t.effective]


def gold_vault(spark, sf_dir, *models: str, used: str | None = None, one_job: bool = True) -> dict:
    """The vault tables behind these star tables.  ``used``: all expressions over their facts; a payment, adjustment or
    recovery fact then lacks the columns that none of them names, and no table is loaded for them.  ``one_job``: see
    ``build_vault``."""
    names, bronzes = set(), set()
    for m in models:
        v, b = GOLD_DEPS[m]
        names |= set(v)
        bronzes |= set(b)
    columns = {n: gold_columns(n) for n in names}
    if used is not None:
        if not any(c in used for c in gold.CLAIM_DETAILS):
            names.discard("sat_claim_details")
        weighed = "drg_hk" if "fact_drg_reimbursement_variance" in models else ""
        for n in names & gold.PRUNED.keys():
            columns[n] = [c for c in columns[n] if c in used or c in gold.PRUNED[n] or c == weighed]
    return vault(spark, sf_dir, sorted(names), sorted(bronzes), columns, one_job=one_job)


# the columns of facts that show fewer than the payment, adjustment or recovery behind them
_FACT_COLUMNS = {"fact_drg_reimbursement_variance": "payment_txn_hk claim_line_hk provider_hk drg_hk paid_amount",
                 "fact_cob_recovery": "cob_recovery_txn_hk claim_line_hk member_hk recovery_amount recovery_date"}


def _gold_query(model: str, qname: str):
    fn = gold.DIMENSIONS.get(model) or gold.FACTS[model]

    def run(spark, sf_dir):
        return present(fn(gold_vault(spark, sf_dir, model, used=_FACT_COLUMNS.get(model))))
    run.__name__ = f"q_{model}"
    QUERIES[qname] = run
    return run


_GOLD_IDS = {
    "dim_member": "d01", "dim_provider": "d02", "dim_procedure": "d03", "dim_drg": "d04", "dim_drug": "d05",
    "dim_encounter": "d06", "dim_hcc_category": "d07", "dim_measure": "d08", "dim_authorization": "d09",
    "dim_appeal": "d10", "fact_claim_payment": "e01", "fact_claim_adjustment": "e02", "fact_cob_recovery": "e03",
    "fact_drg_reimbursement_variance": "e04", "fact_authorization": "e05", "fact_appeal": "e06",
    "fact_member_risk_score": "e07", "fact_member_risk_tier": "e08", "fact_hcc_capture": "e09",
    "fact_coding_gap": "e10", "fact_risk_score_accuracy": "e11", "fact_encounter": "e12", "fact_readmission": "e13",
    "fact_measure_evaluation": "e14", "fact_preventive_screening": "e15", "fact_care_gap": "e16",
    "fact_pharmacy_fill": "e17", "fact_medication_adherence": "e18",
}
for _m, _id in _GOLD_IDS.items():
    _gold_query(_m, f"{_id}_{_m}")


# ---------------------------------------------------------------------------
# metrics (M1-M26) through the metric store
# ---------------------------------------------------------------------------
from vaultmart.plans.semantic import METRICS_BY_NAME, MODELS, metric_models, used_columns  # noqa: E402

METRIC_QUERIES = [
    ("m01_total_payment_leakage_by_year", ["total_payment_leakage"], ["metric_time"], "year"),
    ("m03_leakage_by_provider", ["leakage_by_provider"], ["provider"], None),
    ("m04_denial_rate_by_year", ["denial_rate"], ["metric_time"], "year"),
    ("m05_days_to_adjudication_by_year", ["days_to_adjudication"], ["metric_time"], "year"),
    ("m06_yoy_leakage_trend", ["yoy_leakage_trend"], ["metric_time"], "year"),
    ("m07_raf_score_by_year", ["raf_score"], ["metric_time"], "year"),
    ("m08_yoy_raf_score_trend", ["yoy_raf_score_trend"], ["metric_time"], "year"),
    ("m09_measure_compliance_by_measure", ["hedis_style_measure_compliance_rate"], ["measure_code"], None),
    ("m10_star_rating_composite_by_quarter", ["star_rating_composite_score"], ["metric_time"], "quarter"),
    ("m13_ed_utilization_rate_by_year", ["ed_encounters", "distinct_members", "ed_utilization_rate"],
     ["metric_time"], "year"),
    ("m14_medication_adherence_pdc", ["medication_adherence_pdc"], [], None),
    ("m15_drg_reimbursement_variance_by_drg", ["drg_reimbursement_variance"], ["drg"], None),
    ("m16_cob_recovery_by_month", ["cob_tpl_recovery_amount"], ["metric_time"], "month"),
    ("m17_prior_auth_approval_rate_by_year", ["prior_authorization_approval_rate"], ["metric_time"], "year"),
    ("m18_appeal_overturn_rate", ["appeal_overturn_rate"], [], None),
    ("m19_hcc_capture_rate", ["hcc_capture_rate"], [], None),
    ("m20_coding_gap_closure_rate_by_year", ["coding_gap_closure_rate"], ["metric_time"], "year"),
    ("m21_risk_score_accuracy", ["risk_score_accuracy"], [], None),
    ("m22_suspecting_yield_by_member", ["suspecting_yield_rate"], ["member"], None),
    ("m23_member_risk_tier_distribution", ["member_risk_tier_distribution"], ["risk_tier"], None),
    ("m24_readmission_rate_by_year", ["readmission_rate"], ["metric_time"], "year"),
    ("m25_screening_completion_by_measure", ["preventive_screening_completion_rate"], ["measure_code"], None),
    ("m26_care_gap_count_by_member", ["care_gap_count"], ["member"], None),
    ("f12_multi_metric_by_year", ["payment_leakage_rate", "denial_rate", "cob_tpl_recovery_amount"],
     ["metric_time"], "year"),
    ("f10_leakage_by_week", ["total_payment_leakage"], ["metric_time"], "week"),
    ("m11_ed_encounters_by_quarter", ["ed_encounters"], ["metric_time"], "quarter"),
    ("m12_distinct_members_by_encounter_class", ["distinct_members"], ["encounter_class_code"], None),
]


def _metric_query(name, metrics, group_by, grain):
    def run(spark, sf_dir):
        facts = sorted({MODELS[m].fact for x in metrics for m in metric_models(METRICS_BY_NAME[x])})
        ms = MetricStore(vault=gold_vault(spark, sf_dir, *facts, used=used_columns(metrics, group_by)),
                         store=lambda frame, model: materialize(spark, frame, model))
        return present(ms.query(metrics, group_by=group_by, grain=grain))
    run.__name__ = f"q_{name}"
    QUERIES[name] = run


for _q in METRIC_QUERIES:
    _metric_query(*_q)


# ---------------------------------------------------------------------------
# governance (G1-G6) and data quality (H)
# ---------------------------------------------------------------------------
from vaultmart.operators import governance as GV  # noqa: E402
from vaultmart.operators import quality as QC  # noqa: E402


@query("g01_governed_dim_provider_south")
def q_gov_provider(spark, sf_dir):
    d = gold.dim_provider(gold_vault(spark, sf_dir, "dim_provider"))
    return present(GV.governed(d, "dim_provider", ["regional_manager_south"]))


@query("g02_governed_dim_member_masked")
def q_gov_member(spark, sf_dir):
    d = gold.dim_member(gold_vault(spark, sf_dir, "dim_member"))
    return present(GV.governed(d, "dim_member", ["analyst"]))


@query("g03_dim_member_phi_reviewer")
def q_gov_member_phi(spark, sf_dir):
    d = gold.dim_member(gold_vault(spark, sf_dir, "dim_member"))
    return present(GV.governed(d, "dim_member", [GV.PHI_REVIEWERS]))


@query("g06_governed_fact_claim_payment_west")
def q_gov_fact(spark, sf_dir):
    v = gold_vault(spark, sf_dir, "fact_claim_payment", "dim_provider", used="provider_hk leakage_amount")
    f = GV.governed_fact(gold.fact_claim_payment(v, details=False), gold.dim_provider(v), ["regional_manager_west"])
    return present(f.groupBy("provider_hk").agg(F.count(F.lit(1)).alias("payments"),
                                                 F.sum("leakage_amount").alias("leakage")))


QC_EXTRA = [QC.Check("fact_encounter", "not_null", "provider_hk"),
            QC.Check("fact_encounter", "accepted_values", "encounter_class_code", values=("IMP", "EMER", "AMB")),
            QC.Check("fact_encounter", "relationships", "provider_hk", "hub_provider", "provider_hk")]


def quality_checks() -> list:
    return QC.vault_checks() + QC_EXTRA


def _quality_jobs() -> dict[str, list[str]]:
    """Vault tables by the job that loads and checks them: those that share a landed input, which is read for no other job."""
    inputs = {t.name: set(STAGING_INPUTS[R.BY_NAME[t.source].source]) for t in (*R.HUBS, *R.LINKS, *R.SATELLITES, *R.TLINKS)}
    jobs: list[tuple[set, list]] = []
    for name, read in inputs.items():
        same = [j for j in jobs if j[0] & read]
        jobs = [j for j in jobs if j not in same] + [(read.union(*[j[0] for j in same]), [t for j in same for t in j[1]] + [name])]
    return {names[0]: names for _, names in jobs}


def _quality_results(spark, sf_dir):
    # every vault table is loaded once, with the columns that checks read, and passes through them without being
    # stored; only the tables behind the encounter fact are read twice
    checks, shared = quality_checks(), GOLD_DEPS["fact_encounter"][0]
    columns = {t: c for t, c in QC.check_columns(checks).items() if t not in shared}
    wanted = set(QC.check_columns(checks))

    def load(names):
        own = [n for n in names if n != "fact_encounter"]
        bronzes = sorted({b for n in own for b in STAGING_INPUTS[R.BY_NAME[R.BY_NAME[n].source].source]})
        v = vault(spark, sf_dir, own, bronzes, columns, one_job=True)
        if "fact_encounter" not in names:
            return v
        v |= materialize_all(spark, {t: v[t] for t in shared})
        return {**v, "fact_encounter": gold.fact_encounter(v)}
    jobs = [[n for n in names if n in wanted] + ["fact_encounter"] * ("hub_encounter" in names) for names in _quality_jobs().values()]
    return QC.run_checks_by_job(spark, load, jobs, checks)


@query("h01_vault_quality_checks")
def q_quality(spark, sf_dir):
    return _quality_results(spark, sf_dir)


@query("h02_quality_triage")
def q_triage(spark, sf_dir):
    return QC.triage(_quality_results(spark, sf_dir)).select("table", "check", "column", "failures", "layer",
                                                             "severity", "notify")


# ---------------------------------------------------------------------------
# operations jobs (I2-I22), batch form
# ---------------------------------------------------------------------------
from vaultmart.plans import ops as OPS  # noqa: E402


def ops_input(spark, sf_dir, name):
    proxy.register_driver_tables(spark, sf_dir, ["events", "lineitem", "documents", "conversations"])
    return spark.sql(proxy.ops_sql("spark")[name])


@query("i02_error_rate_alerts_hourly")
def q_err(spark, sf_dir):
    return present(OPS.error_rate_alerts(ops_input(spark, sf_dir, "tool_call_events"), "1 hour"))


@query("i03_repeated_call_alerts_daily")
def q_rep(spark, sf_dir):
    return present(OPS.repeated_call_alerts(ops_input(spark, sf_dir, "tool_call_events"), "1 day"))


@query("i04_latency_p99_alerts_hourly")
def q_lat(spark, sf_dir):
    return present(OPS.latency_alerts(ops_input(spark, sf_dir, "tool_call_events"), "1 hour"))


@query("i05_alert_table_hourly")
def q_alerts(spark, sf_dir):
    return present(OPS.alert_table(ops_input(spark, sf_dir, "tool_call_events"), "1 hour"))


def _priced(spark, sf_dir):
    return OPS.call_cost(ops_input(spark, sf_dir, "agent_cost_events"), OPS.model_rates(spark))


@query("i06_call_cost")
def q_cost(spark, sf_dir):
    return present(_priced(spark, sf_dir)[0])


@query("i06_unpriced_calls_by_model")
def q_unpriced(spark, sf_dir):
    return _priced(spark, sf_dir)[1].groupBy("model_name").agg(F.count(F.lit(1)).alias("calls"))


@query("i07_daily_cost_by_feature")
def q_daily_cost(spark, sf_dir):
    return present(OPS.daily_cost_by_feature(_priced(spark, sf_dir)[0], as_of="2024-01-31 00:00:00", days=30))


USAGE_AS_OF = "2001-06-30"


def _usage(spark, sf_dir, days: int | None = None):
    proxy.register_driver_tables(spark, sf_dir, ["lineitem"])
    return OPS.priced_usage(OPS.usage_from_lineitem(spark.table("lineitem")), OPS.list_prices(spark), USAGE_AS_OF, days)


@query("i08_priced_usage_30_days")
def q_priced_usage_recent(spark, sf_dir):
    return present(_usage(spark, sf_dir, 30))


@query("i09_chargeback_30_days")
def q_chargeback_recent(spark, sf_dir):
    return present(OPS.chargeback(_usage(spark, sf_dir, 30)))


@query("i10_untagged_spend_30_days")
def q_untagged_recent(spark, sf_dir):
    return present(OPS.untagged_spend(_usage(spark, sf_dir, 30)))


@query("i08_priced_usage")
def q_priced_usage(spark, sf_dir):
    return present(_usage(spark, sf_dir))


@query("i09_chargeback")
def q_chargeback(spark, sf_dir):
    return present(OPS.chargeback(_usage(spark, sf_dir)))


@query("i10_untagged_spend")
def q_untagged(spark, sf_dir):
    return present(OPS.untagged_spend(_usage(spark, sf_dir)))


@query("i11_behaviour_and_cost")
def q_behaviour(spark, sf_dir):
    return present(OPS.behaviour_and_cost(ops_input(spark, sf_dir, "tool_call_events"), _priced(spark, sf_dir)[0]))


def _admission(spark, sf_dir):
    return OPS.budget_admission(spark, ops_input(spark, sf_dir, "gateway_requests"))


@query("i12_budget_admission")
def q_admission(spark, sf_dir):
    return present(_admission(spark, sf_dir))


@query("i13_spend_by_feature")
def q_spend(spark, sf_dir):
    return present(OPS.spend_by_feature(_admission(spark, sf_dir)))


@query("i14_content_policy_conversations")
def q_policy(spark, sf_dir):
    c = OPS.content_policy(ops_input(spark, sf_dir, "policy_turns"), "text")
    return c.select("conv_id", "turn", "denied_marker", "blocked")


@query("i15_screen_documents")
def q_screen(spark, sf_dir):
    s = OPS.screen_text(ops_input(spark, sf_dir, "screened_documents"), "text")
    return s.select("doc_id", "action", "matched_pattern",
                    F.concat_ws(",", "redacted_kinds").alias("redacted_kinds"),
                    F.md5("processed_text").alias("processed_md5"),
                    F.length("processed_text").cast("long").alias("processed_length"))


@query("i17_resolve_metric_conversations")
def q_resolve(spark, sf_dir):
    r = OPS.resolve_metric(spark, ops_input(spark, sf_dir, "metric_questions"), "text", ["conv_id", "turn"])
    # every 11th answer names a metric that the catalogue does not hold
    named = F.when((F.col("conv_id") + F.col("turn")) % 11 == 0, F.lit("unlisted_metric")).otherwise(F.col("resolved_metric"))
    return OPS.validate_metric(r.withColumn("resolved_metric", named), MetricStore.catalogue(spark))


@query("i17_resolved_metrics")
def q_resolved(spark, sf_dir):
    """Every resolution as it is; the name that is validated stands beside it, every 11th outside the catalogue."""
    r = OPS.resolve_metric(spark, ops_input(spark, sf_dir, "metric_questions"), "text", ["conv_id", "turn"])
    proposed = F.when((F.col("conv_id") + F.col("turn")) % 11 == 0, F.lit("unlisted_metric")).otherwise(F.col("resolved_metric"))
    return OPS.validate_metric(r.withColumn("proposed_metric", proposed), MetricStore.catalogue(spark), "proposed_metric")


@query("i20_delegation_chains")
def q_chain(spark, sf_dir):
    return OPS.delegation_chains(spark, ops_input(spark, sf_dir, "delegation_tokens")).select(
        "token_id", F.col("depth").cast("long").alias("depth"), "root_token_id")


@query("i21_scope_escalations")
def q_scope(spark, sf_dir):
    e = OPS.scope_escalations(ops_input(spark, sf_dir, "delegation_tokens"))
    as_text = F.array_sort(F.transform("excess", lambda x: F.concat(x["catalog"], F.lit("."), x["schema"],
                                                                   F.lit(":"), x["access"])))
    return e.select("token_id", "parent_token_id", F.concat_ws(",", as_text).alias("excess"), "refused")


@query("i22_approval_status")
def q_approval(spark, sf_dir):
    a = OPS.approval_status(ops_input(spark, sf_dir, "approval_requests"), "2024-01-31 00:00:00")
    return present(a.select("request_id", "risk_tier", "status", "sla_minutes", "due_at", "overdue", "escalation"))


# ---------------------------------------------------------------------------
# streaming forms
# ---------------------------------------------------------------------------
import uuid  # noqa: E402

from vaultmart.session import materialize, scratch_path, shuffles_dropped  # noqa: E402
from vaultmart.streaming import audit as AUD  # noqa: E402
from vaultmart.streaming import gateway as GATEWAY  # noqa: E402
from vaultmart.streaming import joined as JOINED  # noqa: E402
from vaultmart.streaming import schema_log as LOG  # noqa: E402
from vaultmart.streaming.committed import CommittedBatches  # noqa: E402


def table_stream(spark, sf_dir: str, name: str) -> DataFrame:
    """A driver table delivered as a file stream: a table stored as a folder of
    part files (as on a cluster) is streamed from that folder; a single file
    is picked out of its parent folder by name."""
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(hpath).isDirectory():
        return spark.readStream.schema(schema).parquet(path)
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _ops_stream(spark, sf_dir, name: str) -> DataFrame:
    """An operations input over the driver's events delivered as a file stream."""
    table_stream(spark, sf_dir, "events").createOrReplaceTempView("events_stream")
    sql = proxy.ops_sql("spark")[name].replace("FROM events", "FROM events_stream")
    return spark.sql(sql).withColumn("timestamp_utc", F.col("timestamp_utc").cast("timestamp"))


def tool_call_stream(spark, sf_dir):
    """Events of the driver's table delivered as a file stream."""
    events, close = AUD.closing(spark, _ops_stream(spark, sf_dir, "tool_call_events"))
    return AUD.deduplicated(events, "1 hour"), close


@query("i01_stream_error_rate_hourly")
def q_stream_err(spark, sf_dir):
    events, close = tool_call_stream(spark, sf_dir)
    return present(AUD.run_to_table(spark, AUD.error_rate_stream(events, "1 hour", None), "error-rate", close))


@query("i03_stream_repeated_calls_daily")
def q_stream_repeated(spark, sf_dir):
    events, close = tool_call_stream(spark, sf_dir)
    return present(AUD.run_to_table(spark, AUD.repeated_call_stream(events, "1 day", None), "repeated-calls", close))


@query("i04_stream_latency_hourly")
def q_stream_lat(spark, sf_dir):
    events, close = tool_call_stream(spark, sf_dir)
    return present(AUD.run_to_table(spark, AUD.latency_stream(events, "1 hour", None), "latency", close))


@query("i05_stream_alert_table_hourly")
def q_stream_alerts(spark, sf_dir):
    """The three rules as one streaming job: one checkpoint, one exactly-once table."""
    events, close = tool_call_stream(spark, sf_dir)
    root = scratch_path(spark, f"alerts-{uuid.uuid4().hex}")
    alerts = AUD.alert_table_stream(events, "1 hour", None)
    for last in (False, True):
        AUD.write_alerts(spark, alerts, f"{root}/out", f"{root}/checkpoint").awaitTermination()
        if not last:
            close()
    return present(CommittedBatches(spark, f"{root}/out").table())


@query("i11_stream_behaviour_and_cost")
def q_stream_behaviour(spark, sf_dir):
    """Calls and costs as two streams, joined within an hour; calls without a cost are reported when the watermark has passed."""
    calls, close_calls = AUD.closing(spark, _ops_stream(spark, sf_dir, "tool_call_events"))
    costs, close_costs = AUD.closing(spark, _ops_stream(spark, sf_dir, "agent_cost_events"))
    priced, _ = OPS.call_cost(costs, OPS.model_rates(spark))

    def close():
        close_calls()
        close_costs(model_name=min(OPS.DEFAULT_MODEL_RATES), event_id="closing")       # a row that the join keeps
    joined = AUD.run_to_table(spark, JOINED.calls_with_cost(calls, priced), "calls-with-cost", close)
    return present(JOINED.behaviour_and_cost(joined.where("event_id IS NOT NULL")))


@query("i12_stream_budget_admission")
def q_stream_admission(spark, sf_dir):
    """Requests arriving in four micro-batches that follow each other in time; ledgers carried in a versioned table."""
    requests = ops_input(spark, sf_dir, "gateway_requests").withColumn("timestamp_utc", F.col("timestamp_utc").cast("timestamp"))
    root = scratch_path(spark, f"admission-{uuid.uuid4().hex}")
    micro_batches(spark, requests, "timestamp_utc", lambda stream: GATEWAY.budget_admission_stream(
        spark, stream, f"{root}/out", f"{root}/checkpoint"), 4)
    return present(GATEWAY.admission_decisions(spark, f"{root}/out"))


@query("i01_stream_additive_schema")
def q_stream_schema(spark, sf_dir):
    """Lines of 13 and then 15 fields land in one table; the two new fields are rescued, then adopted by the schema log."""
    spark_events = ops_input(spark, sf_dir, "tool_call_events").withColumn("timestamp_utc", F.date_format("timestamp_utc", "yyyy-MM-dd HH:mm:ss"))
    absent = [f for f in AUD.TOOL_CALL_SCHEMA if f.name not in spark_events.columns]
    old = spark_events.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent}).select(*AUD.TOOL_CALL_SCHEMA.names)
    third = F.col("event_id").cast("long") % 3
    new = old.withColumns({"cost_center": F.concat(F.lit("cc-"), third.cast("string")), "retry_count": F.col("latency_ms") % 4})
    root = scratch_path(spark, f"audit-{uuid.uuid4().hex}")
    log = LOG.SchemaLog(spark, f"{root}/schema")
    log.adopt(AUD.TOOL_CALL_SCHEMA)

    def deliver(frame):
        frame.select(F.to_json(F.struct(*frame.columns)).alias("value")).write.mode("append").text(f"{root}/in")
        LOG.land_events(spark, f"{root}/in", log, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    table = CommittedBatches(spark, f"{root}/out")
    deliver(old.where(third == 0))
    deliver(new.where(third == 1))
    found = LOG.unknown_fields(table.table())
    log.adopt(T.StructType([T.StructField(n, T.IntegerType() if n == "retry_count" else T.StringType()) for n in found]))
    deliver(new.where(third == 2))
    got = LOG.read_events(table.table(), log)
    return present(got.select("event_id", "timestamp_utc", "tool_name", "status", "latency_ms", "cost_center", "retry_count",
                              F.coalesce(F.size("rescued"), F.lit(0)).alias("unknown_fields"), "unparsed", "schema_version"))


# ---------------------------------------------------------------------------
# more staging models (B) and a top-k metric report
# ---------------------------------------------------------------------------
STAGING_QUERIES = {
    "b05_stg_claim_lines": ("stg_claim_lines", ["synpuf_inpatient_claim_header"]),
    "b09_stg_providers": ("stg_providers", ["nppes_providers"]),
    "b13_stg_encounters": ("stg_encounters", ["synthea_encounters"]),
    "b14_stg_encounter_diagnoses": ("stg_encounter_diagnoses", ["synthea_conditions"]),
    "b17_stg_authorizations": ("stg_authorizations", ["pi_authorizations"]),
    "b19_stg_payment_txns": ("stg_payment_txns", ["pi_payment_transactions"]),
    "b25_stg_member_hcc": ("stg_member_hcc", ["ra_member_hcc"]),
    "b27_stg_member_risk_scores": ("stg_member_risk_scores", ["ra_member_risk_scores"]),
    "b30_stg_member_measure_evals": ("stg_member_measure_evals", ["cq_member_measure_evals"]),
    "b31_stg_pharmacy_fills": ("stg_pharmacy_fills", ["pharmacy_fills"]),
}


def _staging_query(qname, model, bronzes):
    def run(spark, sf_dir):
        return present(S.STAGING[model](bronze(spark, sf_dir, bronzes)))
    run.__name__ = f"q_{model}"
    QUERIES[qname] = run


for _q, (_m, _b) in STAGING_QUERIES.items():
    _staging_query(_q, _m, _b)


@query("f13_leakage_where_paid_since_1998")
def q_where(spark, sf_dir):
    where = "payment_date >= DATE '1998-01-01'"
    used = used_columns(["total_payment_leakage"], ["metric_time"], where)
    ms = MetricStore(vault=gold_vault(spark, sf_dir, "fact_claim_payment", used=used))
    return present(ms.query(["total_payment_leakage"], group_by=["metric_time"], grain="year", where=where))


@query("f13_top10_provider_leakage")
def q_topk(spark, sf_dir):
    ms = MetricStore(vault=gold_vault(spark, sf_dir, "fact_claim_payment", used=used_columns(["leakage_by_provider"], ["provider"])))
    return present(ms.query(["leakage_by_provider"], group_by=["provider"],
                            order_by=["-leakage_by_provider", "provider"], limit=10))


# ---------------------------------------------------------------------------
# every staging model (B1-B31), hashed stage (CK) and vault table
# (CH, CL, CS, CT) of the registry, loaded from one batch of proxy inputs
# ---------------------------------------------------------------------------
from vaultmart.plans.oracle_vault import hashed_query_name, staging_query_name, vault_query_name  # noqa: E402

# bronze inputs read by each staging model
STAGING_INPUTS = {
    "stg_members": ["synpuf_beneficiary_summary", "synthea_patients"],
    "stg_diagnoses": ["synpuf_inpatient_claim_diagnoses", "synthea_conditions"],
    "stg_drgs": ["synpuf_inpatient_claim_header", "drg_weights"],
    "stg_procedures": ["synpuf_inpatient_claim_procedures"],
    "stg_claim_lines": ["synpuf_inpatient_claim_header"],
    "stg_claim_drg": ["synpuf_inpatient_claim_header"],
    "stg_claim_diagnoses": ["synpuf_inpatient_claim_diagnoses"],
    "stg_claim_procedures": ["synpuf_inpatient_claim_procedures"],
    "stg_providers": ["nppes_providers"],
    "stg_facilities": ["nppes_facilities"],
    "stg_pharmacies": ["nppes_facilities"],
    "stg_drugs": ["ndc_products"],
    "stg_encounters": ["synthea_encounters"],
    "stg_encounter_diagnoses": ["synthea_conditions"],
    "stg_contracts": ["pi_contracts"],
    "stg_provider_contracts": ["pi_provider_contracts"],
    "stg_authorizations": ["pi_authorizations"],
    "stg_appeals": ["pi_appeals"],
    "stg_payment_txns": ["pi_payment_transactions"],
    "stg_adjustment_txns": ["pi_adjustment_transactions"],
    "stg_cob_recovery_txns": ["pi_cob_recovery_transactions"],
    "stg_hcc_categories": ["ra_hcc_categories"],
    "stg_risk_models": ["ra_risk_models"],
    "stg_diagnosis_hcc_crosswalk": ["ra_diagnosis_hcc_crosswalk"],
    "stg_member_hcc": ["ra_member_hcc"],
    "stg_suspected_hcc": ["ra_suspected_hcc"],
    "stg_member_risk_scores": ["ra_member_risk_scores"],
    "stg_measures": ["cq_measures"],
    "stg_member_measure": ["cq_member_measure"],
    "stg_member_measure_evals": ["cq_member_measure_evals"],
    "stg_pharmacy_fills": ["pharmacy_fills"],
}

_HAVE_STAGING = {m for m, _ in STAGING_QUERIES.values()} | {
    "stg_members", "stg_diagnoses", "stg_drgs", "stg_pharmacies", "stg_drugs"}
for _m in S.STAGING:
    if _m not in _HAVE_STAGING:
        _staging_query(staging_query_name(_m), _m, STAGING_INPUTS[_m])


def _hashed_stage_query(hs: R.HashedStage):
    def run(spark, sf_dir):
        st = S.STAGING[hs.source](bronze(spark, sf_dir, STAGING_INPUTS[hs.source]))
        return present(hashed_staging({hs.source: st}, [hs.name])[hs.name])
    run.__name__ = f"q_{hs.name}"
    QUERIES[hashed_query_name(hs.name)] = run


def _vault_table_query(name: str, source_stage: str):
    def run(spark, sf_dir):
        return present(vault(spark, sf_dir, [name], STAGING_INPUTS[source_stage])[name])
    run.__name__ = f"q_{name}"
    QUERIES[vault_query_name(name)] = run


for _hs in R.HASHED_STAGES:
    _hashed_stage_query(_hs)
for _t in (*R.HUBS, *R.LINKS, *R.SATELLITES, *R.TLINKS):
    _vault_table_query(_t.name, R.BY_NAME[_t.source].source)


# ---------------------------------------------------------------------------
# landers (A1, A3, A4, A6, A7, A13) over raw-file-shaped proxies
# ---------------------------------------------------------------------------
from vaultmart.sources import ingest as IG  # noqa: E402


def raw(spark, sf_dir, name: str) -> DataFrame:
    sql = proxy.raw_sql("spark")[name]
    proxy.register_driver_tables(spark, sf_dir, proxy.tables_in(sql))
    return spark.sql(sql)


@query("a01_land_providers_individuals")
def q_land_individuals(spark, sf_dir):
    return present(IG.land_providers(raw(spark, sf_dir, "nppes_raw"))[0])


@query("a01_land_providers_organizations")
def q_land_organizations(spark, sf_dir):
    return present(IG.land_providers(raw(spark, sf_dir, "nppes_raw"))[1])


@query("a13_landing_summary_providers")
def q_landing_summary(spark, sf_dir):
    r = raw(spark, sf_dir, "nppes_raw")
    ind, org = IG.land_providers(r)
    return present(IG.landing_summary({"nppes_raw": r}, {"nppes_providers": ind, "nppes_facilities": org}))


@query("a03_land_beneficiaries")
def q_land_beneficiaries(spark, sf_dir):
    return present(IG.land_beneficiaries(raw(spark, sf_dir, "bene_raw"), "_row_order"))


@query("a04_land_claim_headers")
def q_land_claim_headers(spark, sf_dir):
    return present(IG.land_claim_headers(raw(spark, sf_dir, "claims_raw")))


@query("a04_land_claim_procedures")
def q_land_claim_procedures(spark, sf_dir):
    return present(IG.land_claims(raw(spark, sf_dir, "claims_raw"))["synpuf_inpatient_claim_procedures"])


def fhir_bundles(spark, sf_dir) -> DataFrame:
    proxy.register_driver_tables(spark, sf_dir, ["orders"])
    return (spark.sql(proxy.fhir_bundle_json_sql())
                 .select(F.from_json("bundle", IG.FHIR_SCHEMA).alias("b")).select("b.*"))


def _fhir_query(qname: str, table: str):
    def run(spark, sf_dir):
        return present(IG.land_fhir(fhir_bundles(spark, sf_dir))[table])
    run.__name__ = f"q_{table}"
    QUERIES[qname] = run


for _qn, _tb in (("a06_land_fhir_patients", "synthea_patients"), ("a06_land_fhir_encounters", "synthea_encounters"),
                 ("a06_land_fhir_conditions", "synthea_conditions")):
    _fhir_query(_qn, _tb)


# H-X: every crosswalk entry resolves to a known diagnosis, HCC and risk model
XWALK_TABLES = ["lnk_diagnosis_hcc_crosswalk", "hub_diagnosis", "hub_hcc_category", "hub_risk_model"]


def crosswalk_checks() -> list:
    return [c for c in QC.vault_checks(XWALK_TABLES)
            if c.table == "lnk_diagnosis_hcc_crosswalk" and c.check == "relationships"]


@query("h03_crosswalk_resolves")
def q_crosswalk(spark, sf_dir):
    bronzes = sorted({b for n in XWALK_TABLES for b in STAGING_INPUTS[R.BY_NAME[R.BY_NAME[n].source].source]})
    return QC.run_checks(vault(spark, sf_dir, XWALK_TABLES, bronzes), crosswalk_checks())


# The vault and the landing layer loaded by streams over the
# driver's files (availableNow), read back from their sinks
import os as _os  # noqa: E402
import uuid as _uuid  # noqa: E402

from vaultmart.operators import partitioned_vault as PV  # noqa: E402
from vaultmart.plans.build import partitioned_table  # noqa: E402
from vaultmart.streaming.landing import land_stream, partitioned_vault_stream, vault_stream  # noqa: E402


@query("c09_stream_vault_claim_payment_txn")
def q_stream_vault(spark, sf_dir):
    stream = table_stream(spark, sf_dir, "lineitem")
    pay_sql = proxy.bronze_sql("spark")["pi_payment_transactions"].replace("FROM lineitem", "FROM lineitem_batch")

    def to_bronze(batch):
        batch.createOrReplaceTempView("lineitem_batch")
        return {"pi_payment_transactions": batch.sparkSession.sql(pay_sql)}

    root = scratch_path(spark, f"stream-vault-{_uuid.uuid4().hex}")
    vault_stream(spark, stream, to_bronze, _os.path.join(root, "vault"), _os.path.join(root, "checkpoint"),
                 ["tlnk_claim_payment_txn"]).awaitTermination()
    return present(spark.read.parquet(_os.path.join(root, "vault", "tlnk_claim_payment_txn")))


def micro_batches(spark, frame: DataFrame, time_col: str, run, n: int = 3) -> None:
    """Deliver a table to a file stream in ``n`` parts that follow each other in time; ``run(stream)`` takes each as a micro-batch.
    The rows are written once, by part; the files of a part are moved into the delivery folder when it arrives."""
    root = scratch_path(spark, f"delivery-{_uuid.uuid4().hex}")
    at = F.unix_micros(F.col(time_col).cast("timestamp"))
    cuts = sorted(set(frame.select(at.alias("t")).approxQuantile("t", [i / n for i in range(1, n)], 0.01)))
    part = sum(((at >= int(c)).cast("int") for c in cuts), F.lit(0))       # no time, no part: such rows are not delivered
    with shuffles_dropped(spark):
        frame.withColumn("_part", part).where("_part IS NOT NULL").write.partitionBy("_part").option("compression", "zstd").parquet(f"{root}/parts")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in frame.schema.fields])
    spark.createDataFrame([], schema).write.parquet(f"{root}/arrived")
    stream = spark.readStream.schema(schema).parquet(f"{root}/arrived")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for i in range(len(cuts) + 1):
        for f in fs.globStatus(path(f"{root}/parts/_part={i}/part-*")) or []:         # a task names its files alike in all parts
            if not fs.rename(f.getPath(), path(f"{root}/arrived/{i}-{f.getPath().getName()}")):
                raise OSError(f"{f.getPath()} was not delivered")
        run(stream).awaitTermination()


PARTITIONED = {"c09_stream_partitioned_hub": ("hub_claim_line", "synpuf_inpatient_claim_header"),
               "c09_stream_partitioned_link": ("lnk_claim_provider_member", "synpuf_inpatient_claim_header"),
               "c09_stream_partitioned_satellite": ("sat_claim_details", "synpuf_inpatient_claim_header"),
               "c09_stream_partitioned_tlink": ("tlnk_claim_payment_txn", "pi_payment_transactions")}


def _partitioned_query(qname, table, source):
    def run(spark, sf_dir):
        root = scratch_path(spark, f"partitioned-{_uuid.uuid4().hex}")
        micro_batches(spark, bronze(spark, sf_dir, [source])[source], "load_dts", lambda stream: partitioned_vault_stream(
            spark, stream, lambda batch: {source: batch}, f"{root}/vault", f"{root}/checkpoint", [table], prefix_chars=1, key_bytes=True))
        return present(partitioned_table(spark, f"{root}/vault", table, prefix_chars=1).table())
    run.__name__ = f"q_{qname}"
    QUERIES[qname] = run


for _q, (_t, _s) in PARTITIONED.items():
    _partitioned_query(_q, _t, _s)


def _status_satellite(spark, sf_dir):
    """Orders as member versions, loaded in three micro-batches into a satellite with a snapshot of current versions."""
    root = scratch_path(spark, f"status-{_uuid.uuid4().hex}")
    table = PV.SatelliteTable(spark, f"{root}/sat", "member_hk", "status_hashdiff", ["o_orderpriority", "o_orderstatus"], prefix_chars=1)
    micro_batches(spark, _priority_staged(spark, sf_dir), "load_dts", lambda stream: stream.writeStream.foreachBatch(
        table.load).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    return table


@query("c06_stream_satellite_history")
def q_stream_history(spark, sf_dir):
    return present(_status_satellite(spark, sf_dir).table())


@query("c08_maintained_current_versions")
def q_snapshot(spark, sf_dir):
    return present(_status_satellite(spark, sf_dir).current())


@query("a14_stream_land_provider_file")
def q_stream_land(spark, sf_dir):
    root = scratch_path(spark, f"stream-land-{_uuid.uuid4().hex}")
    incoming = _os.path.join(root, "incoming")
    # the raw provider file arrives in the landing folder as CSV
    raw(spark, sf_dir, "nppes_raw").write.option("header", True).csv(incoming)
    schema = IG.text_schema(list(IG.PROVIDER_COLUMN_MAP))
    land_stream(spark, incoming, schema, _os.path.join(root, "bronze"), _os.path.join(root, "checkpoint"),
                "nppes", fmt="csv", options={"header": "true"}).awaitTermination()
    # load time and file path differ per run; the landed rows and source do not
    return spark.read.parquet(_os.path.join(root, "bronze")).drop("load_dts", "source_file")


def drug_files(spark, sf_dir) -> dict[str, DataFrame]:
    """The drug directory files written as tab-separated text, then landed."""
    root = scratch_path(spark, f"ndc-{_uuid.uuid4().hex}")
    paths = {}
    for name in ("ndc_product_file", "ndc_package_file"):
        paths[name] = _os.path.join(root, name)
        raw(spark, sf_dir, name).write.option("header", True).option("sep", "\t").csv(paths[name])
    return IG.land_drugs(spark, paths["ndc_product_file"], paths["ndc_package_file"])


@query("a08_land_drug_products")
def q_land_drugs(spark, sf_dir):
    return drug_files(spark, sf_dir)["ndc_products"]


@query("a09_orphan_drug_packages")
def q_orphan_packages(spark, sf_dir):
    out = drug_files(spark, sf_dir)
    return IG.orphan_rows(out["ndc_packages"], out["ndc_products"], "productndc")


REFERENCE_LOAD_TS = "2024-01-01 00:00:00"


def reference_tables(spark, sf_dir, names: list[str]) -> dict[str, DataFrame]:
    """Reference / event tables arrive as all-text CSV files; read with a
    fixed schema and stamped with the batch load time."""
    folder = scratch_path(spark, f"reference-{_uuid.uuid4().hex}")
    b = bronze(spark, sf_dir, names)
    for n in names:
        IG.write_bronze(b[n].select(*[F.col(c).cast("string").alias(c) for c in IG.REFERENCE_TABLES[n]]),
                        _os.path.join(folder, f"{n}.csv"), "csv")
    return IG.read_reference_tables(spark, folder, names, load_ts=REFERENCE_LOAD_TS)


@query("a15_reference_member_hcc_staged")
def q_reference_member_hcc(spark, sf_dir):
    return present(S.stg_member_hcc(reference_tables(spark, sf_dir, ["ra_member_hcc"])))


@query("a15_reference_payments_staged")
def q_reference_payments(spark, sf_dir):
    return present(S.stg_payment_txns(reference_tables(spark, sf_dir, ["pi_payment_transactions"])))


# the other reference tables, each landed as CSV and typed by the staging model that reads it
REFERENCE_MODELS = {inputs[0]: m for m, inputs in STAGING_INPUTS.items() if len(inputs) == 1 and inputs[0] in IG.REFERENCE_TABLES}
REFERENCE_MODELS = {t: m for t, m in REFERENCE_MODELS.items() if t not in ("ra_member_hcc", "pi_payment_transactions")}


def _reference_query(table, model):
    def run(spark, sf_dir):
        return present(S.STAGING[model](reference_tables(spark, sf_dir, [table])))
    run.__name__ = f"q_reference_{table}"
    QUERIES[f"a15_reference_{table}_staged"] = run


for _t, _m in REFERENCE_MODELS.items():
    _reference_query(_t, _m)


@query("a15_reference_drg_weights_staged")
def q_reference_drgs(spark, sf_dir):
    claims = "synpuf_inpatient_claim_header"
    return present(S.stg_drgs({claims: bronze(spark, sf_dir, [claims])[claims], **reference_tables(spark, sf_dir, ["drg_weights"])}))


# ---------------------------------------------------------------------------
# observed landing (A13), file order (A4), many price versions (I8), stored
# sketches (F5), governance as SQL (G1-G5), gold and source tests (H)
# ---------------------------------------------------------------------------
from vaultmart.plans import sketches as SKETCH  # noqa: E402


@query("a13_observed_landing_providers")
def q_observed_landing(spark, sf_dir):
    return present(IG.land_providers_observed(spark, raw(spark, sf_dir, "nppes_raw"), scratch_path(spark, f"providers-{_uuid.uuid4().hex}")))


def _claims_text(rows: DataFrame, select: str) -> DataFrame:
    """The claim file's columns of joined rows, beside the rows themselves (``_stored``)."""
    return rows.sparkSession.sql(select.replace("SELECT", "SELECT struct(*) AS _stored,", 1) + "FROM {rows}", rows=rows)


@query("a04_first_claim_row_in_file_order")
def q_file_order(spark, sf_dir):
    """The claim file twice over (the second copy of a row with another payment), shuffled into several CSV files; the
    first row of a claim in file order is kept."""
    folder = scratch_path(spark, f"claims-{_uuid.uuid4().hex}")
    proxy.register_driver_tables(spark, sf_dir, ["lineitem", "orders", "part"])
    select, tables = proxy.raw_sql("spark")["claims_raw"].split("FROM lineitem l")
    # rows are sorted as they are stored and written out as text behind the sort: the text is wider
    rows = spark.sql(f"SELECT l.*, o_custkey, o_orderdate, p_type, p_brand, p_size FROM lineitem l{tables}")
    claims = _claims_text(rows, select)
    cols = [c for c in claims.columns if c not in ("_row_order", "_stored")]
    both = claims.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    place = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in IG.CLAIM_HEADER_COLUMN_MAP], F.col("copy").cast("string")))
    # as many files as the session has shuffle partitions: a fixed few would sort the whole table in as few tasks
    placed = both.select(F.unhex(place).alias("_place"), "copy", "_stored.*").repartitionByRange("_place").sortWithinPartitions("_place")
    paid = F.when(F.col("_stored.copy") == 1, F.concat(F.lit("9"), F.col("CLM_PMT_AMT"))).otherwise(F.col("CLM_PMT_AMT"))
    with shuffles_dropped(spark):
        (_claims_text(placed, select).withColumn("CLM_PMT_AMT", paid)
         .select(*cols).write.option("header", True).option("compression", "gzip").csv(folder))
    return present(IG.land_claim_headers(IG.read_csv_in_order(spark, folder, cols)))


PRICE_BIN_DAYS = 30


def versioned_prices(spark, sf_dir) -> DataFrame:
    """A list price for every SKU and shipping day, valid until the SKU's next one: thousands of versions per SKU."""
    days = OPS.usage_from_lineitem(spark.table("lineitem")).select("sku_name", "usage_date").distinct()
    until = F.lead("usage_date").over(Window.partitionBy("sku_name").orderBy("usage_date"))
    price = (F.lit(0.1).cast("decimal(10,4)") + F.dayofyear("usage_date").cast("decimal(10,4)") * F.lit(0.001).cast("decimal(4,3)")).cast("decimal(10,4)")
    return days.select("sku_name", F.col("usage_date").cast("timestamp").alias("price_start_time"), until.cast("timestamp").alias("price_end_time"),
                       F.struct(F.struct(price.alias("default")).alias("effective_list")).alias("pricing"))


@query("i08_priced_usage_many_versions")
def q_many_versions(spark, sf_dir):
    proxy.register_driver_tables(spark, sf_dir, ["lineitem"])
    return present(OPS.priced_usage(OPS.usage_from_lineitem(spark.table("lineitem")), versioned_prices(spark, sf_dir), bin_days=PRICE_BIN_DAYS))


@query("f05_distinct_members_by_sketch")
def q_sketches(spark, sf_dir):
    """Members per encounter class at three grains: the exact count, and whether the stored sketches come within 2 % of it."""
    fact = materialize(spark, gold.fact_encounter(gold_vault(spark, sf_dir, "fact_encounter")), "encounters")
    dims = ["encounter_class_code"]
    stored = materialize(spark, SKETCH.daily_sketches(fact, "encounter_start", "member_hk", dims), "sketches")
    out = []
    for grain in ("month", "quarter", "year"):
        exact = fact.groupBy(F.date_trunc(grain, "encounter_start").cast("date").alias("metric_time"), *dims).agg(
            F.count_distinct("member_hk").alias("distinct_members"))
        near = SKETCH.rolled_up(stored, grain, dims, "estimate")
        same = F.col("metric_time").eqNullSafe(F.col("t")) & F.col("encounter_class_code").eqNullSafe(F.col("c"))
        joined = exact.join(near.select(F.col("metric_time").alias("t"), F.col("encounter_class_code").alias("c"), "estimate"), same, "left")
        off = F.abs(F.coalesce("estimate", F.lit(0)) - F.col("distinct_members"))
        out.append(joined.select(F.lit(grain).alias("grain"), "metric_time", *dims, "distinct_members",
                                 (off <= F.greatest(0.02 * F.col("distinct_members"), F.lit(0.0))).alias("within_2_percent")))
    return present(out[0].unionByName(out[1]).unionByName(out[2]))


def _sql_governed(spark, sf_dir, table: str, groups: list[str]) -> DataFrame:
    """A stored dimension read through its governed view by a plain SQL query of a session in these groups."""
    build = getattr(gold, table)
    path = scratch_path(spark, f"{table}-{_uuid.uuid4().hex}")
    build(gold_vault(spark, sf_dir, table)).write.parquet(path)
    session = spark.newSession()                       # functions, variable and views are the caller's own
    GV.create_sql_functions(session)
    session.read.parquet(path).createOrReplaceTempView(table)
    view = GV.create_governed_view(session, table, table)
    GV.set_principal_groups(session, groups)
    return session.sql(f"SELECT * FROM {view}")


@query("g01_sql_governed_dim_provider_south")
def q_sql_provider(spark, sf_dir):
    return present(_sql_governed(spark, sf_dir, "dim_provider", ["regional_manager_south"]))


@query("g02_sql_governed_dim_member_masked")
def q_sql_member(spark, sf_dir):
    return present(_sql_governed(spark, sf_dir, "dim_member", ["analyst"]))


# The declared tests of the star schema (key columns, references) and of the landed sources.
GOLD_KEYS = {
    "dim_member": "member_hk", "dim_provider": "provider_hk", "dim_procedure": "procedure_hk", "dim_hcc_category": "hcc_hk",
    "dim_encounter": "encounter_hk", "dim_measure": "measure_hk", "dim_drug": "drug_hk", "dim_authorization": "authorization_hk",
    "dim_appeal": "appeal_hk", "dim_drg": "drg_hk", "fact_claim_payment": "payment_txn_hk", "fact_claim_adjustment": "adjustment_txn_hk",
    "fact_cob_recovery": "cob_recovery_txn_hk", "fact_member_risk_score": "member_risk_score_txn_hk", "fact_encounter": "encounter_hk",
    "fact_measure_evaluation": "member_measure_eval_txn_hk", "fact_pharmacy_fill": "pharmacy_fill_txn_hk",
    "fact_medication_adherence": "medication_adherence_hk", "fact_drg_reimbursement_variance": "payment_txn_hk",
    "fact_authorization": "authorization_hk", "fact_appeal": "appeal_hk", "fact_hcc_capture": "hcc_capture_hk", "fact_coding_gap": "member_hcc_hk",
    "fact_member_risk_tier": "member_risk_score_txn_hk", "fact_readmission": "index_encounter_hk",
    "fact_preventive_screening": "member_measure_eval_txn_hk", "fact_care_gap": "member_measure_eval_txn_hk"}
GOLD_MEMBERS = ["fact_claim_payment", "fact_member_risk_score", "fact_encounter", "fact_measure_evaluation", "fact_pharmacy_fill",
                "fact_medication_adherence", "fact_hcc_capture", "fact_coding_gap", "fact_member_risk_tier", "fact_risk_score_accuracy",
                "fact_readmission", "fact_preventive_screening", "fact_care_gap"]
GOLD_REFERENCES = [("fact_claim_payment", "provider_hk", "dim_provider"), ("fact_pharmacy_fill", "drug_hk", "dim_drug"),
                   ("fact_medication_adherence", "drug_hk", "dim_drug"), ("fact_drg_reimbursement_variance", "claim_line_hk", "fact_claim_payment"),
                   ("fact_hcc_capture", "hcc_hk", "dim_hcc_category")]
SOURCE_KEYS = {
    "nppes_providers": "npi", "nppes_facilities": "npi", "synpuf_beneficiary_summary": "member_bk", "synpuf_inpatient_claim_header": "claim_line_bk",
    "synthea_patients": "member_bk", "ra_risk_models": "risk_model_bk", "ra_hcc_categories": "hcc_bk", "ra_diagnosis_hcc_crosswalk": "diagnosis_bk",
    "ra_member_hcc": "member_bk", "ra_suspected_hcc": "member_bk", "ra_member_risk_scores": "member_bk", "cq_measures": "measure_bk",
    "cq_member_measure": "member_bk", "cq_member_measure_evals": "member_bk", "ndc_products": "productndc", "pharmacy_fills": "member_bk",
    "drg_weights": "drg_bk"}


def gold_checks() -> list:
    """27 unique, 27 not-null and 18 relationship tests."""
    keys = [QC.Check(t, kind, k) for t, k in GOLD_KEYS.items() for kind in ("unique", "not_null")]
    members = [QC.Check(t, "relationships", "member_hk", "dim_member", "member_hk") for t in GOLD_MEMBERS]
    return keys + members + [QC.Check(t, "relationships", c, ref, c) for t, c, ref in GOLD_REFERENCES]


def source_checks() -> list:
    """17 not-null tests on the landed tables."""
    return [QC.Check(t, "not_null", k) for t, k in SOURCE_KEYS.items()]


def _gold_jobs() -> list[list[str]]:
    """Star tables by the job that checks them: a table goes with one that reads all of its vault tables."""
    names = sorted(set(QC.check_columns(gold_checks())), key=lambda n: (-len(GOLD_DEPS[n][0]), n))
    jobs: dict[str, list[str]] = {}
    for n in names:
        jobs.setdefault(next((m for m in jobs if set(GOLD_DEPS[n][0]) <= set(GOLD_DEPS[m][0])), n), []).append(n)
    return list(jobs.values())


@query("h04_gold_quality_checks")
def q_gold_quality(spark, sf_dir):
    # every star table passes once through its checks; tables of one job share the moves of their vault tables
    def load(names):
        v = gold_vault(spark, sf_dir, *names)
        return {n: getattr(gold, n)(v) for n in names}
    return QC.run_checks_by_job(spark, load, _gold_jobs(), gold_checks())


@query("h05_source_quality_checks")
def q_source_quality(spark, sf_dir):
    return QC.run_checks(bronze(spark, sf_dir, list(SOURCE_KEYS)), source_checks())
