"""Typed staging projections.

Every function takes the dict of bronze DataFrames (names as in the
landing layer) and returns a lazy DataFrame, exactly like a view.  The
batch load time is a parameter (``load_dts``): a bronze table that
already carries ``load_dts`` / ``record_source`` keeps them, otherwise
the batch value and the table's literal source are stamped.  (Stamping
``current_timestamp()`` inside a view, as a scheduler-driven SQL layer
would, makes the load time move on every read.)
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultmart.functions.dates import as_date, as_decimal, as_int, as_timestamp
from vaultmart.functions.hashing import HOME

Bronze = dict[str, DataFrame]

# Fixed value: taxonomy code that marks a facility as a pharmacy.
PHARMACY_TAXONOMY = "3336C0003X"


def _lineage(df: DataFrame, source: str, load_dts) -> list[Column]:
    cols = set(df.columns)
    rs = F.col("record_source") if "record_source" in cols else F.lit(source)
    if "load_dts" in cols:
        ld = F.col("load_dts").cast("timestamp")
    else:
        ld = F.lit(load_dts if load_dts is not None else _dt.datetime(1970, 1, 1)).cast("timestamp")
    return [rs.alias("record_source"), ld.alias("load_dts")]


def _home(df: DataFrame) -> list[str]:
    """Codes of a claim (``unpivot_codes``), claims, authorizations and appeals (``build.gathered_once``) may come gathered."""
    return [HOME] if HOME in df.columns else []


def _nonblank(c: str) -> Column:
    return F.col(c).isNotNull() & (F.trim(F.col(c)) != "")


# B1
def stg_members(b: Bronze, load_dts=None) -> DataFrame:
    a = b["synpuf_beneficiary_summary"]
    s = b["synthea_patients"]
    left = a.select(F.col("member_bk").cast("string").alias("member_bk"), as_date(a, "birth_date").alias("birth_date"),
                    F.col("sex_code").cast("string").alias("sex"), F.col("race_code").cast("string").alias("race_code"),
                    F.col("state_code").cast("string").alias("state_code"),
                    F.lit("cms_de_synpuf").alias("source_system"), *_lineage(a, "synpuf_beneficiary_summary", load_dts))
    right = s.select(F.col("member_bk").cast("string").alias("member_bk"), as_date(s, "birth_date").alias("birth_date"),
                     F.col("sex").cast("string").alias("sex"), F.lit(None).cast("string").alias("race_code"),
                     F.lit(None).cast("string").alias("state_code"), F.lit("synthea").alias("source_system"),
                     *_lineage(s, "synthea_patients", load_dts))
    return left.unionByName(right)


# B2
def stg_diagnoses(b: Bronze, load_dts=None) -> DataFrame:
    c = b["synpuf_inpatient_claim_diagnoses"]
    s = b["synthea_conditions"]
    icd = c.select("diagnosis_bk", F.lit("icd9").alias("coding_system"),
                   *_lineage(c, "synpuf_inpatient_claim_diagnoses", load_dts)).distinct()
    sno = (s.where(F.col("diagnosis_bk").isNotNull())
            .select("diagnosis_bk", F.lit("snomed").alias("coding_system"),
                    *_lineage(s, "synthea_conditions", load_dts)).distinct())
    return icd.unionByName(sno)


# B3 -- the weight table is a small reference file (a few hundred DRGs)
def stg_drgs(b: Bronze, load_dts=None) -> DataFrame:
    h = b["synpuf_inpatient_claim_header"]
    w = b["drg_weights"]
    d = h.where(_nonblank("drg_bk")).select("drg_bk", *_lineage(h, "synpuf_inpatient_claim_header", load_dts)).distinct()
    ww = w.select("drg_bk", "drg_description", as_decimal(w, "drg_relative_weight", 10, 4).alias("drg_relative_weight"))
    return d.join(F.broadcast(ww), "drg_bk", "left").select(
        "drg_bk", "drg_description", "drg_relative_weight", "record_source", "load_dts")


# B4
def stg_procedures(b: Bronze, load_dts=None) -> DataFrame:
    p = b["synpuf_inpatient_claim_procedures"]
    return p.select("procedure_bk", F.lit("icd9_procedure").alias("coding_system"),
                    *_lineage(p, "synpuf_inpatient_claim_procedures", load_dts)).distinct()


# B5
def stg_claim_lines(b: Bronze, load_dts=None) -> DataFrame:
    h = b["synpuf_inpatient_claim_header"]
    return h.select(
        F.col("claim_line_bk").cast("string").alias("claim_line_bk"),
        F.col("member_bk").cast("string").alias("member_bk"),
        F.col("provider_bk").cast("string").alias("provider_bk"),
        as_date(h, "service_from_date").alias("service_from_date"),
        as_date(h, "service_thru_date").alias("service_thru_date"),
        as_date(h, "admission_date").alias("admission_date"),
        as_date(h, "discharge_date").alias("discharge_date"),
        F.col("drg_bk").cast("string").alias("drg_bk"),
        as_decimal(h, "paid_amount").alias("paid_amount"),
        as_decimal(h, "primary_payer_paid_amount").alias("primary_payer_paid_amount"),
        as_int(h, "utilization_day_count").alias("utilization_day_count"),
        F.lit("inpatient").alias("claim_type"),
        *_lineage(h, "synpuf_inpatient_claim_header", load_dts), *_home(h))


# B6
def stg_claim_drg(b: Bronze, load_dts=None) -> DataFrame:
    h = b["synpuf_inpatient_claim_header"]
    return h.where(_nonblank("drg_bk")).select(
        F.col("claim_line_bk").cast("string").alias("claim_line_bk"), "drg_bk",
        *_lineage(h, "synpuf_inpatient_claim_header", load_dts), *_home(h))


# B7
def stg_claim_diagnoses(b: Bronze, load_dts=None) -> DataFrame:
    c = b["synpuf_inpatient_claim_diagnoses"]
    return c.select("claim_line_bk", "diagnosis_bk", *_lineage(c, "synpuf_inpatient_claim_diagnoses", load_dts), *_home(c))


# B8
def stg_claim_procedures(b: Bronze, load_dts=None) -> DataFrame:
    c = b["synpuf_inpatient_claim_procedures"]
    return c.select("claim_line_bk", "procedure_bk", *_lineage(c, "synpuf_inpatient_claim_procedures", load_dts), *_home(c))


# B9
def stg_providers(b: Bronze, load_dts=None) -> DataFrame:
    p = b["nppes_providers"]
    return p.select(F.col("npi").cast("string").alias("provider_bk"), "provider_first_name", "provider_last_name",
                    "provider_credential", "primary_taxonomy_code", "practice_state", "practice_city",
                    *_lineage(p, "nppes_providers", load_dts))


# B10
def stg_facilities(b: Bronze, load_dts=None) -> DataFrame:
    f = b["nppes_facilities"]
    return f.select(F.col("npi").cast("string").alias("facility_bk"), "organization_name", "practice_state",
                    "practice_city", "primary_taxonomy_code", *_lineage(f, "nppes_facilities", load_dts))


# B11
def stg_pharmacies(b: Bronze, load_dts=None) -> DataFrame:
    f = b["nppes_facilities"]
    return f.where(F.col("primary_taxonomy_code") == PHARMACY_TAXONOMY).select(
        F.col("npi").cast("string").alias("pharmacy_bk"), F.col("organization_name").alias("pharmacy_name"),
        F.col("primary_taxonomy_code").alias("pharmacy_type"), *_lineage(f, "nppes_facilities", load_dts))


# B12
def stg_drugs(b: Bronze, load_dts=None) -> DataFrame:
    p = b["ndc_products"]
    return p.select(F.col("productndc").alias("drug_bk"),
                    F.coalesce(F.nullif(F.col("proprietaryname"), F.lit("")), F.col("nonproprietaryname")).alias("drug_name"),
                    F.col("pharm_classes").alias("drug_class"), *_lineage(p, "ndc_products", load_dts))


# B13
def stg_encounters(b: Bronze, load_dts=None) -> DataFrame:
    e = b["synthea_encounters"]
    return e.select("encounter_bk", F.col("member_reference").alias("member_bk"),
                    F.col("provider_reference").alias("provider_bk"), F.col("facility_reference").alias("facility_bk"),
                    "encounter_status", "encounter_class_code", "encounter_type_text",
                    as_timestamp(e, "encounter_start").alias("encounter_start"),
                    as_timestamp(e, "encounter_end").alias("encounter_end"),
                    *_lineage(e, "synthea_encounters", load_dts))


# B14
def stg_encounter_diagnoses(b: Bronze, load_dts=None) -> DataFrame:
    c = b["synthea_conditions"]
    return c.where(F.col("encounter_reference").isNotNull()).select(
        F.col("encounter_reference").alias("encounter_bk"), "diagnosis_bk", "diagnosis_description",
        "clinical_status_code", as_date(c, "onset_date").alias("onset_date"),
        *_lineage(c, "synthea_conditions", load_dts))


# B15
def stg_contracts(b: Bronze, load_dts=None) -> DataFrame:
    c = b["pi_contracts"]
    return c.select("contract_bk", "contract_model", as_date(c, "effective_date").alias("effective_date"),
                    *_lineage(c, "payment_integrity_synthetic", load_dts))


# B16
def stg_provider_contracts(b: Bronze, load_dts=None) -> DataFrame:
    c = b["pi_provider_contracts"]
    return c.select(F.col("provider_bk").cast("string").alias("provider_bk"), "contract_bk",
                    *_lineage(c, "payment_integrity_synthetic", load_dts))


# B17
def stg_authorizations(b: Bronze, load_dts=None) -> DataFrame:
    a = b["pi_authorizations"]
    return a.select("authorization_bk", "claim_line_bk", "auth_status",
                    as_date(a, "requested_date").alias("requested_date"),
                    *_lineage(a, "payment_integrity_synthetic", load_dts), *_home(a))


# B18
def stg_appeals(b: Bronze, load_dts=None) -> DataFrame:
    a = b["pi_appeals"]
    return a.select("appeal_bk", "claim_line_bk", "appeal_status", "appeal_reason",
                    *_lineage(a, "payment_integrity_synthetic", load_dts), *_home(a))


# B19
def stg_payment_txns(b: Bronze, load_dts=None) -> DataFrame:
    t = b["pi_payment_transactions"]
    return t.select("txn_bk", "claim_line_bk", as_decimal(t, "billed_amount").alias("billed_amount"),
                    as_decimal(t, "allowed_amount").alias("allowed_amount"),
                    as_decimal(t, "paid_amount").alias("paid_amount"),
                    as_date(t, "payment_date").alias("payment_date"),
                    *_lineage(t, "payment_integrity_synthetic", load_dts))


# B20
def stg_adjustment_txns(b: Bronze, load_dts=None) -> DataFrame:
    t = b["pi_adjustment_transactions"]
    return t.select("txn_bk", "claim_line_bk", as_decimal(t, "adjustment_amount").alias("adjustment_amount"),
                    "adjustment_reason_code", as_date(t, "adjustment_date").alias("adjustment_date"),
                    *_lineage(t, "payment_integrity_synthetic", load_dts))


# B21
def stg_cob_recovery_txns(b: Bronze, load_dts=None) -> DataFrame:
    t = b["pi_cob_recovery_transactions"]
    return t.select("txn_bk", "claim_line_bk", as_decimal(t, "recovery_amount").alias("recovery_amount"),
                    as_date(t, "recovery_date").alias("recovery_date"),
                    *_lineage(t, "payment_integrity_synthetic", load_dts))


# B22
def stg_hcc_categories(b: Bronze, load_dts=None) -> DataFrame:
    t = b["ra_hcc_categories"]
    return t.select("hcc_bk", "hcc_description", as_decimal(t, "hcc_weight", 10, 4).alias("hcc_weight"),
                    *_lineage(t, "ra_hcc_categories", load_dts))


# B23
def stg_risk_models(b: Bronze, load_dts=None) -> DataFrame:
    t = b["ra_risk_models"]
    return t.select("risk_model_bk", "model_name", *_lineage(t, "ra_risk_models", load_dts))


# B24
def stg_diagnosis_hcc_crosswalk(b: Bronze, load_dts=None) -> DataFrame:
    t = b["ra_diagnosis_hcc_crosswalk"]
    return t.select("diagnosis_bk", "hcc_bk", "risk_model_bk", *_lineage(t, "ra_diagnosis_hcc_crosswalk", load_dts))


# B25
def stg_member_hcc(b: Bronze, load_dts=None) -> DataFrame:
    t = b["ra_member_hcc"]
    return t.select(F.col("member_bk").cast("string").alias("member_bk"), "hcc_bk", "active_flag",
                    as_date(t, "coding_gap_identified_date").alias("coding_gap_identified_date"),
                    as_date(t, "coding_gap_closed_date").alias("coding_gap_closed_date"),
                    *_lineage(t, "ra_member_hcc", load_dts))


# B26
def stg_suspected_hcc(b: Bronze, load_dts=None) -> DataFrame:
    t = b["ra_suspected_hcc"]
    return t.select(F.col("member_bk").cast("string").alias("member_bk"), "hcc_bk",
                    *_lineage(t, "ra_suspected_hcc", load_dts))


# B27
def stg_member_risk_scores(b: Bronze, load_dts=None) -> DataFrame:
    t = b["ra_member_risk_scores"]
    return t.select(F.col("member_bk").cast("string").alias("member_bk"), "risk_model_bk",
                    as_decimal(t, "raf_score", 10, 4).alias("raf_score"), as_int(t, "model_year").alias("model_year"),
                    *_lineage(t, "ra_member_risk_scores", load_dts))


# B28
def stg_measures(b: Bronze, load_dts=None) -> DataFrame:
    t = b["cq_measures"]
    return t.select("measure_bk", "measure_name", as_decimal(t, "measure_weight", 10, 4).alias("measure_weight"),
                    *_lineage(t, "cq_measures", load_dts))


# B29
def stg_member_measure(b: Bronze, load_dts=None) -> DataFrame:
    t = b["cq_member_measure"]
    return t.select(F.col("member_bk").cast("string").alias("member_bk"), "measure_bk",
                    *_lineage(t, "cq_member_measure", load_dts))


# B30
def stg_member_measure_evals(b: Bronze, load_dts=None) -> DataFrame:
    t = b["cq_member_measure_evals"]
    return t.select(F.col("member_bk").cast("string").alias("member_bk"), "measure_bk", "eval_result",
                    as_date(t, "eval_date").alias("eval_date"), *_lineage(t, "cq_member_measure_evals", load_dts))


# B31
def stg_pharmacy_fills(b: Bronze, load_dts=None) -> DataFrame:
    t = b["pharmacy_fills"]
    return t.select(F.col("member_bk").cast("string").alias("member_bk"), F.col("drug_bk").cast("string").alias("drug_bk"),
                    F.col("pharmacy_bk").cast("string").alias("pharmacy_bk"),
                    as_date(t, "fill_date").alias("fill_date"), as_int(t, "days_supply").alias("days_supply"),
                    *_lineage(t, "pharmacy_fills", load_dts))


STAGING = {name: fn for name, fn in globals().items() if name.startswith("stg_") and callable(fn)}


def stage_all(b: Bronze, load_dts=None, only: list[str] | None = None) -> dict[str, DataFrame]:
    """Every staging model whose bronze inputs are present."""
    out = {}
    for name, fn in STAGING.items():
        if only is not None and name not in only:
            continue
        try:
            out[name] = fn(b, load_dts)
        except KeyError:
            continue
    return out
