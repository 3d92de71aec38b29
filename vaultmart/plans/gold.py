"""Gold star schema: 10 dimensions (D1-D10) and 18 facts.

Every function takes the dict of vault tables (name -> DataFrame) and
returns a lazy DataFrame.  Dimensions always join the *current*
satellite version (one row per key), so a changed attribute never
duplicates a dimension row; facts do the same for satellites.

Joins are plain equi-joins: AQE turns a join into a broadcast when the
measured size of one side is under ``spark.sql.autoBroadcastJoinThreshold``
(the runtime size check) and keeps a shuffle join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultmart.functions.hashing import HOME, sha_surrogate
from vaultmart.operators.ranges import next_start_within_self
from vaultmart.operators.vault import current_satellite
from vaultmart.plans import registry as R
from vaultmart.session import materialize

Vault = dict[str, DataFrame]

# Fixed values of the gold models.
READMISSION_WINDOW_DAYS = 30
INPATIENT_CLASS = "IMP"
PDC_PERIOD_DAYS = 365
SCREENING_MEASURES = ("BCS-E", "COL-E")
RISK_TIER_LOW_BELOW = 1.0
RISK_TIER_MEDIUM_BELOW = 2.0


def _sat(v: Vault, name: str) -> DataFrame:
    spec = R.BY_NAME[name]
    return current_satellite(v[name], spec.pk, spec.hashdiff)


def _with(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left`` with the columns of ``right``, joined (left) on ``key``.  Rows that both sides hold gathered by the key's home
    are joined there: the home is the join key, and keys that share one are told apart in it (an equality of the keys
    would move both sides again)."""
    if HOME not in left.columns or HOME not in right.columns:
        return left.join(right.drop(HOME), key, "left")
    on = (F.col(f"l.{HOME}") == F.col(f"r.{HOME}")) & F.col(f"l.{key}").between(F.col(f"r.{key}"), F.col(f"r.{key}"))
    return left.alias("l").join(right.alias("r"), on, "left").select(
        "l.*", *[F.col(f"r.{c}") for c in right.columns if c not in (key, HOME)])


def _at_home(df: DataFrame) -> list[str]:
    return [HOME] if HOME in df.columns else []


def _dim(v: Vault, hub: str, sat: str, pk: str, bk_alias: tuple[str, str], cols: list[str]) -> DataFrame:
    return _dim_at_home(v, hub, sat, pk, bk_alias, cols).drop(HOME)


def _dim_at_home(v: Vault, hub: str, sat: str, pk: str, bk_alias: tuple[str, str], cols: list[str]) -> DataFrame:
    h = v[hub].select(pk, F.col(bk_alias[0]).alias(bk_alias[1]), *_at_home(v[hub]))
    s = _sat(v, sat)
    return _with(h, s.select(pk, *cols, *_at_home(s)), pk)


def dim_member(v: Vault) -> DataFrame:          # D1
    return _dim(v, "hub_member", "sat_member_demographics", "member_hk", ("member_bk", "member_id"),
                ["birth_date", "sex", "race_code", "state_code", "source_system"])


def dim_provider(v: Vault) -> DataFrame:        # D2
    return _dim(v, "hub_provider", "sat_provider_details", "provider_hk", ("provider_bk", "provider_npi"),
                ["provider_first_name", "provider_last_name", "provider_credential", "primary_taxonomy_code",
                 "practice_state", "practice_city"])


def dim_procedure(v: Vault) -> DataFrame:       # D3
    return _dim(v, "hub_procedure", "sat_procedure_details", "procedure_hk", ("procedure_bk", "procedure_code"),
                ["coding_system"])


def dim_drg(v: Vault) -> DataFrame:             # D4
    return _dim(v, "hub_drg", "sat_drg_details", "drg_hk", ("drg_bk", "drg_bk"),
                ["drg_description", "drg_relative_weight"])


def dim_drug(v: Vault) -> DataFrame:            # D5
    return _dim(v, "hub_drug", "sat_drug_details", "drug_hk", ("drug_bk", "ndc"), ["drug_name", "drug_class"])


def dim_encounter(v: Vault) -> DataFrame:       # D6
    return _dim(v, "hub_encounter", "sat_encounter_details", "encounter_hk", ("encounter_bk", "encounter_id"),
                ["encounter_class_code", "encounter_start", "encounter_end"])


def dim_hcc_category(v: Vault) -> DataFrame:    # D7
    return _dim(v, "hub_hcc_category", "sat_hcc_category_details", "hcc_hk", ("hcc_bk", "hcc_code"),
                ["hcc_description", "hcc_weight"])


def dim_measure(v: Vault) -> DataFrame:         # D8
    return _dim(v, "hub_measure", "sat_measure_definition", "measure_hk", ("measure_bk", "measure_code"),
                ["measure_name", "measure_weight"])


def dim_authorization(v: Vault) -> DataFrame:   # D9
    return _authorizations(v).drop(HOME)


def _authorizations(v: Vault) -> DataFrame:
    return _dim_at_home(v, "hub_authorization", "sat_authorization_details", "authorization_hk",
                        ("authorization_bk", "authorization_bk"), ["auth_status", "requested_date"])


def dim_appeal(v: Vault) -> DataFrame:          # D10
    return _appeals(v).drop(HOME)


def _appeals(v: Vault) -> DataFrame:
    return _dim_at_home(v, "hub_appeal", "sat_appeal_details", "appeal_hk", ("appeal_bk", "appeal_bk"),
                        ["appeal_status", "appeal_reason"])


CLAIM_DETAILS = ("service_from_date", "admission_date")
# Tables of which a reader may load fewer columns (the facts over them then lack the rest), and those the facts always read.
PRUNED = {"tlnk_claim_payment_txn": ("claim_line_hk", "billed_amount", "paid_amount"), "tlnk_claim_adjustment_txn": ("claim_line_hk",),
          "tlnk_cob_recovery_txn": ("claim_line_hk",), "lnk_claim_provider_member": ("claim_line_hk",), "lnk_claim_drg": ("claim_line_hk",)}


def _held(df: DataFrame, *columns: str) -> DataFrame:
    """These columns, as far as ``df`` was loaded with them."""
    return df.select(*[c for c in columns if c in df.columns])


def fact_claim_payment(v: Vault, details: bool = True) -> DataFrame:  # E1
    """Without ``details`` the claim's dates are left out, and with them the current rows of the claim satellite (one per
    claim, so no row of the fact depends on them)."""
    t = v["tlnk_claim_payment_txn"]
    lpm = _held(v["lnk_claim_provider_member"], "claim_line_hk", "provider_hk", "member_hk", HOME)
    ld = _held(v["lnk_claim_drg"], "claim_line_hk", "drg_hk", HOME)
    f = _with(_with(t, lpm, "claim_line_hk"), ld, "claim_line_hk")
    if details:
        f = _with(f, _held(_sat(v, "sat_claim_details"), "claim_line_hk", *CLAIM_DETAILS, HOME), "claim_line_hk")
    f = f.withColumn("leakage_amount", F.col("billed_amount") - F.col("paid_amount"))
    return _held(f, "payment_txn_hk", "claim_line_hk", "provider_hk", "member_hk", "drg_hk", "billed_amount", "allowed_amount",
                 "paid_amount", "leakage_amount", "payment_date", *(CLAIM_DETAILS if details else ()))


def fact_claim_adjustment(v: Vault) -> DataFrame:   # E2
    t = v["tlnk_claim_adjustment_txn"]
    lpm = _held(v["lnk_claim_provider_member"], "claim_line_hk", "provider_hk", "member_hk", HOME)
    return _held(_with(t, lpm, "claim_line_hk"), "adjustment_txn_hk", "claim_line_hk", "provider_hk", "member_hk",
                 "adjustment_amount", "adjustment_reason_code", "adjustment_date")


def fact_cob_recovery(v: Vault) -> DataFrame:   # E3
    t = v["tlnk_cob_recovery_txn"]
    lpm = _held(v["lnk_claim_provider_member"], "claim_line_hk", "member_hk", HOME)
    return _held(_with(t, lpm, "claim_line_hk"), "cob_recovery_txn_hk", "claim_line_hk", "member_hk", "recovery_amount", "recovery_date")


def fact_drg_reimbursement_variance(v: Vault, used: str | None = None) -> DataFrame:  # E4
    """``used``: all expressions over the fact; it then lacks the keys that none of them names."""
    keys = [k for k in ("payment_txn_hk", "claim_line_hk", "provider_hk", "drg_hk") if used is None or k in used]
    f = fact_claim_payment(v, details=False)
    # DRGs with a weight are no more than the weight file has, which staging broadcasts: the payments need not move to them
    d = dim_drg(v).select("drg_hk", "drg_relative_weight").where(F.col("drg_relative_weight").isNotNull())
    c = _held(f.join(F.broadcast(d), "drg_hk", "inner"),
              *keys, "paid_amount", "drg_relative_weight")
    # read twice (benchmark and rows): write it once instead of computing the fact twice
    c = materialize(c.sparkSession, c, "claims_with_weight")
    # population benchmark: one row, so the cross join is a broadcast of a single row
    # the benchmark is fixed to 6 decimals so that everything downstream of
    # it is exact decimal arithmetic
    bench = c.agg((F.sum("paid_amount") / F.nullif(F.sum("drg_relative_weight"), F.lit(0)))
                  .cast("decimal(18,6)").alias("dollars_per_weight_unit"))
    expected = F.col("drg_relative_weight") * F.col("dollars_per_weight_unit")
    f = c.crossJoin(F.broadcast(bench)).withColumns(
        {"expected_paid_amount": expected, "reimbursement_variance": F.col("paid_amount") - expected})
    return _held(f, "payment_txn_hk", "claim_line_hk", "provider_hk", "drg_hk", "drg_relative_weight", "paid_amount",
                 "dollars_per_weight_unit", "expected_paid_amount", "reimbursement_variance")


def fact_authorization(v: Vault) -> DataFrame:  # E5
    lca = _held(v["lnk_claim_authorization"], "authorization_hk", "claim_line_hk", HOME)
    return _with(_authorizations(v), lca, "authorization_hk").select(
        "authorization_hk", "claim_line_hk", "auth_status", "requested_date")


def fact_appeal(v: Vault) -> DataFrame:         # E6
    lca = _held(v["lnk_claim_appeal"], "appeal_hk", "claim_line_hk", HOME)
    return _with(_appeals(v), lca, "appeal_hk").select(
        "appeal_hk", "claim_line_hk", "appeal_status", "appeal_reason")


def fact_member_risk_score(v: Vault) -> DataFrame:  # E7
    return v["tlnk_member_risk_score_txn"].select(
        "member_risk_score_txn_hk", "member_hk", "risk_model_hk", "raf_score", "model_year", "effective_from")


def fact_member_risk_tier(v: Vault) -> DataFrame:   # E8
    tier = (F.when(F.col("raf_score") < RISK_TIER_LOW_BELOW, "low")
             .when(F.col("raf_score") < RISK_TIER_MEDIUM_BELOW, "medium").otherwise("high"))
    return fact_member_risk_score(v).select(
        "member_risk_score_txn_hk", "member_hk", "risk_model_hk", "raf_score", "model_year", tier.alias("risk_tier"))


def fact_hcc_capture(v: Vault) -> DataFrame:    # E9
    s = v["lnk_member_suspected_hcc"].select("member_hk", "hcc_hk", F.lit(1).alias("is_suspected"))
    c = v["lnk_member_hcc"].select("member_hk", "hcc_hk", F.lit(1).alias("is_captured"))
    comb = s.join(c, ["member_hk", "hcc_hk"], "full_outer").select(
        "member_hk", "hcc_hk", F.coalesce("is_suspected", F.lit(0)).alias("is_suspected"),
        F.coalesce("is_captured", F.lit(0)).alias("is_captured"))
    both = F.when((F.col("is_suspected") == 1) & (F.col("is_captured") == 1), 1).otherwise(0)
    return comb.select(sha_surrogate("member_hk", "hcc_hk", df=comb).alias("hcc_capture_hk"), "member_hk", "hcc_hk",
                       "is_suspected", "is_captured", both.alias("is_captured_and_suspected"))


def fact_coding_gap(v: Vault) -> DataFrame:     # E10
    s = _sat(v, "sat_member_hcc_status").select("member_hcc_hk", "active_flag", "coding_gap_identified_date",
                                                 "coding_gap_closed_date")
    return v["lnk_member_hcc"].select("member_hcc_hk", "member_hk", "hcc_hk").join(s, "member_hcc_hk", "left").select(
        "member_hcc_hk", "member_hk", "hcc_hk", "active_flag", "coding_gap_identified_date", "coding_gap_closed_date",
        F.when(F.col("coding_gap_closed_date").isNotNull(), 1).otherwise(0).alias("is_gap_closed"))


def fact_risk_score_accuracy(v: Vault) -> DataFrame:  # E11
    cap = fact_hcc_capture(v).where(F.col("is_suspected") == 1).select("member_hk", "hcc_hk")
    w = cap.join(dim_hcc_category(v).select("hcc_hk", "hcc_weight"), "hcc_hk", "left")
    sw = w.groupBy("member_hk").agg(F.sum("hcc_weight").alias("suspected_raf_approx"))
    a = fact_member_risk_score(v).select("member_hk", "risk_model_hk", "raf_score", "model_year")
    return a.join(sw, "member_hk", "left").select(
        "member_hk", "risk_model_hk", "model_year", F.col("raf_score").alias("actual_raf_score"),
        "suspected_raf_approx",
        (F.col("raf_score") - F.coalesce("suspected_raf_approx", F.lit(0))).alias("raf_accuracy_variance"))


def fact_encounter(v: Vault) -> DataFrame:      # E12
    e = dim_encounter(v)
    lme = v["lnk_member_encounter"].select("encounter_hk", "member_hk")
    lep = v["lnk_encounter_provider"].select("encounter_hk", "provider_hk")
    lef = v["lnk_encounter_facility"].select("encounter_hk", "facility_hk")
    return (e.join(lme, "encounter_hk", "left").join(lep, "encounter_hk", "left").join(lef, "encounter_hk", "left")
             .select("encounter_hk", "member_hk", "provider_hk", "facility_hk", "encounter_class_code",
                     "encounter_start", "encounter_end"))


def readmission_from_encounters(enc: DataFrame) -> DataFrame:
    ip = enc.where((F.col("encounter_class_code") == INPATIENT_CLASS) & F.col("member_hk").isNotNull()).select(
        "encounter_hk", "member_hk", "encounter_start", "encounter_end")
    # one pass over the stays: each is an index row and a candidate row of
    # the same frame, so the encounter fact is read once and not joined back
    nxt = next_start_within_self(ip, "member_hk", "encounter_hk", "encounter_start", "encounter_end",
                                 READMISSION_WINDOW_DAYS, carry=("encounter_start", "encounter_end"))
    return nxt.select(
        F.col("encounter_hk").alias("index_encounter_hk"), "member_hk",
        F.col("encounter_start").alias("index_admission_date"), F.col("encounter_end").alias("index_discharge_date"),
        F.col("next_start").alias("next_admission_within_30_days"),
        F.when(F.col("next_start").isNotNull(), 1).otherwise(0).alias("is_readmission"))


def fact_readmission(v: Vault) -> DataFrame:    # E13
    return readmission_from_encounters(fact_encounter(v))


def fact_measure_evaluation(v: Vault) -> DataFrame:  # E14
    dm = dim_measure(v).select("measure_hk", "measure_code", "measure_weight")
    return v["tlnk_member_measure_eval_txn"].join(dm, "measure_hk", "left").select(
        "member_measure_eval_txn_hk", "member_hk", "measure_hk", "measure_code", "measure_weight", "eval_result",
        "eval_date", "effective_from")


def fact_preventive_screening(v: Vault) -> DataFrame:  # E15
    return fact_measure_evaluation(v).where(F.col("measure_code").isin(*SCREENING_MEASURES)).select(
        "member_measure_eval_txn_hk", "member_hk", "measure_hk", "measure_code", "eval_result", "eval_date",
        F.when(F.col("eval_result") == "met", 1).otherwise(0).alias("is_completed"))


def fact_care_gap(v: Vault) -> DataFrame:       # E16
    return fact_measure_evaluation(v).where(F.col("eval_result") != "met").select(
        "member_measure_eval_txn_hk", "member_hk", "measure_hk", "measure_code", "eval_result", "eval_date")


def fact_pharmacy_fill(v: Vault) -> DataFrame:  # E17
    d = dim_drug(v).select("drug_hk", "ndc")
    return v["tlnk_pharmacy_fill_txn"].join(d, "drug_hk", "left").select(
        "pharmacy_fill_txn_hk", "member_hk", "drug_hk", "ndc", "pharmacy_hk", "fill_date", "days_supply",
        "effective_from")


def fact_medication_adherence(v: Vault) -> DataFrame:  # E18
    fills = fact_pharmacy_fill(v).groupBy("member_hk", "drug_hk").agg(
        F.sum("days_supply").alias("raw_days_supply"))
    covered = F.least(F.col("raw_days_supply"), F.lit(PDC_PERIOD_DAYS).cast("long"))
    return fills.select(sha_surrogate("member_hk", "drug_hk", df=fills).alias("medication_adherence_hk"), "member_hk", "drug_hk",
                        covered.alias("days_covered"), F.lit(PDC_PERIOD_DAYS).alias("period_days"),
                        (covered / F.lit(PDC_PERIOD_DAYS)).alias("pdc"))


DIMENSIONS = {f.__name__: f for f in (dim_member, dim_provider, dim_procedure, dim_drg, dim_drug, dim_encounter,
                                      dim_hcc_category, dim_measure, dim_authorization, dim_appeal)}
FACTS = {f.__name__: f for f in (fact_claim_payment, fact_claim_adjustment, fact_cob_recovery,
                                 fact_drg_reimbursement_variance, fact_authorization, fact_appeal,
                                 fact_member_risk_score, fact_member_risk_tier, fact_hcc_capture, fact_coding_gap,
                                 fact_risk_score_accuracy, fact_encounter, fact_readmission, fact_measure_evaluation,
                                 fact_preventive_screening, fact_care_gap, fact_pharmacy_fill,
                                 fact_medication_adherence)}
