import pytest
from pyspark.sql import functions as F

from vaultmart.plans import gold
from vaultmart.plans.build import build_vault, load_vault
from vaultmart.plans.semantic import MetricStore, UnknownMetricError
from tests import fixtures as FX


@pytest.fixture(scope="module")
def vault(spark):
    return build_vault(FX.bronze(spark), load_dts=FX.LOAD1)


@pytest.fixture(scope="module")
def store(vault):
    return MetricStore(vault=vault)


def one(df, col):
    r = df.collect()
    assert len(r) == 1
    return r[0][col]


def by(df, key, col):
    return {r[key]: r[col] for r in df.collect()}


def test_vault_tables_built(vault):
    assert vault["hub_member"].count() == 4                       # two disjoint ID spaces
    assert vault["tlnk_claim_payment_txn"].count() == 4           # duplicate T1 delivered once
    assert vault["lnk_encounter_provider"].count() == 4           # E5 has no provider
    assert vault["lnk_claim_drg"].count() == 3                    # blank DRG dropped


def test_leakage_metrics(store):
    df = store.query(["total_payment_leakage", "payment_leakage_rate", "yoy_leakage_trend"],
                     group_by=["metric_time"], grain="year")
    r = {str(x.metric_time): x for x in df.collect()}
    assert float(r["2023-01-01"].total_payment_leakage) == 600.0
    assert r["2023-01-01"].payment_leakage_rate == pytest.approx(0.4)
    assert r["2024-01-01"].payment_leakage_rate == 0.0            # zero-billed claim: 0 / 200
    assert r["2023-01-01"].yoy_leakage_trend is None              # no prior period -> NULL
    assert float(r["2024-01-01"].yoy_leakage_trend) == -600.0


def test_days_denial_cob_auth_appeal(store):
    d = store.query(["days_to_adjudication"], group_by=["metric_time"], grain="year")
    assert by(d, "metric_time", "days_to_adjudication")[__import__("datetime").date(2023, 1, 1)] == 27.5
    assert one(store.query(["denial_rate"]), "denial_rate") == 0.5
    assert float(one(store.query(["cob_tpl_recovery_amount"]), "cob_tpl_recovery_amount")) == 120.5
    assert one(store.query(["prior_authorization_approval_rate"]), "prior_authorization_approval_rate") == 0.5
    assert one(store.query(["appeal_overturn_rate"]), "appeal_overturn_rate") == 1.0


def test_drg_variance(vault, store):
    f = gold.fact_drg_reimbursement_variance(vault)
    v = {r.claim_line_hk: float(r.reimbursement_variance) for r in f.collect()}
    assert sorted(v.values()) == [-75.0, 75.0]                     # benchmark 900 / 2.0 = 450
    assert float(one(store.query(["drg_reimbursement_variance"]), "drg_reimbursement_variance")) == 0.0


def test_readmission_and_ed(vault, store):
    r = gold.fact_readmission(vault)
    assert r.count() == 3 and r.where("is_readmission = 1").count() == 1
    assert one(store.query(["readmission_rate"]), "readmission_rate") == pytest.approx(1 / 3)
    ed = store.query(["ed_utilization_rate"], group_by=["metric_time"], grain="year")
    assert one(ed, "ed_utilization_rate") == 500.0


def test_risk_metrics(vault, store):
    tiers = by(store.query(["member_risk_tier_distribution"], group_by=["risk_tier"]), "risk_tier",
               "member_risk_tier_distribution")
    assert tiers == {"low": 1, "medium": 1, "high": 2}            # NULL score lands in high
    raf = store.query(["raf_score", "yoy_raf_score_trend"], group_by=["metric_time"], grain="year")
    r = {str(x.metric_time): x for x in raf.collect()}
    assert r["2023-01-01"].raf_score == 1.5 and r["2024-01-01"].raf_score == 1.5
    assert r["2024-01-01"].yoy_raf_score_trend == 0.0
    assert one(store.query(["hcc_capture_rate"]), "hcc_capture_rate") == pytest.approx(1 / 3)
    assert gold.fact_hcc_capture(vault).count() == 4
    assert one(store.query(["coding_gap_closure_rate"]), "coding_gap_closure_rate") == 0.5
    assert one(store.query(["risk_score_accuracy"]), "risk_score_accuracy") == pytest.approx(2.25)


def test_quality_and_pharmacy_metrics(store):
    assert one(store.query(["preventive_screening_completion_rate"]),
               "preventive_screening_completion_rate") == pytest.approx(1 / 3)
    assert one(store.query(["care_gap_count"]), "care_gap_count") == 1     # NULL result is not a gap
    assert one(store.query(["star_rating_composite_score"]), "star_rating_composite_score") == pytest.approx(1 / 3)
    assert one(store.query(["medication_adherence_pdc"]), "medication_adherence_pdc") == pytest.approx(395 / 730)


def test_metric_errors(store):
    with pytest.raises(UnknownMetricError):
        store.query(["medical_loss_ratio"])
    with pytest.raises(ValueError):
        store.query(["appeal_overturn_rate"], group_by=["metric_time"], grain="year")   # no time dimension


def test_catalogue_and_dimensions(spark):
    cat = MetricStore.catalogue(spark)
    assert cat.count() == 26 and cat.where("is_intermediate").count() == 2
    assert MetricStore.list_metrics(spark, "pharmacy").count() == 1
    dims = {r.name for r in MetricStore.get_dimensions(spark, ["payment_leakage_rate", "days_to_adjudication"]).collect()}
    assert {"provider", "member", "metric_time"} <= dims


def test_second_batch_history_and_current_dimension(spark, tmp):
    b1 = FX.bronze(spark)
    root = f"{tmp}/vault"
    load_vault(spark, root, b1, names=["hub_member", "sat_member_demographics"])
    b2 = dict(b1)
    b2["synpuf_beneficiary_summary"] = b1["synpuf_beneficiary_summary"].withColumns({
        "state_code": F.when(F.col("member_bk") == "M1", "FL").otherwise(F.col("state_code")),
        "load_dts": F.lit(FX.LOAD2).cast("timestamp")})
    v = load_vault(spark, root, b2, names=["hub_member", "sat_member_demographics"])
    assert v["hub_member"].count() == 4
    assert v["sat_member_demographics"].count() == 5                # M1 changed once
    load_vault(spark, root, b2, names=["hub_member", "sat_member_demographics"])   # replay
    v = {k: spark.read.parquet(f"{root}/{k}") for k in ("hub_member", "sat_member_demographics")}
    assert v["sat_member_demographics"].count() == 5
    dm = gold.dim_member(v)
    assert dm.count() == 4 and by(dm, "member_id", "state_code")["M1"] == "FL"


def test_every_registered_vault_table_is_built(vault):
    from vaultmart.plans import registry as R
    names = {x.name for x in (*R.HUBS, *R.LINKS, *R.SATELLITES, *R.TLINKS)}
    assert len(names) == 54 and names <= set(vault)
    assert vault["lnk_diagnosis_hcc_crosswalk"].count() == 1 and vault["lnk_provider_contract"].count() == 1
    assert vault["sat_pharmacy_details"].count() == 1                   # taxonomy-filtered facility
