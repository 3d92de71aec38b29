"""Declarative registry of every hashed-staging, hub, link, satellite and
transactional-link instance of the vault (CK1-CK46, CH1-CH16, CL1-CL17,
CS1-CS15, CT1-CT6).

One row per table; the generic operators in ``operators/vault.py`` and
``functions/hashing.py`` do the work.  ``plans/build.py`` walks this
registry over a dict of staging DataFrames.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultmart.functions.hashing import FIRST, LAST


@dataclass(frozen=True)
class HashedStage:
    name: str
    source: str                       # staging model it reads
    hashed: dict                      # key column -> business-key columns
    hashdiff: dict = field(default_factory=dict)
    derived: dict = field(default_factory=dict)   # name -> column name or callable() -> Column


@dataclass(frozen=True)
class Hub:
    name: str
    pk: str
    bk: str
    source: str


@dataclass(frozen=True)
class Link:
    name: str
    pk: str
    fks: tuple
    source: str


@dataclass(frozen=True)
class Satellite:
    name: str
    pk: str
    hashdiff: str
    payload: tuple
    source: str


@dataclass(frozen=True)
class TLink:
    name: str
    pk: str
    fks: tuple
    payload: tuple
    source: str
    effective: str = "effective_from"


def _model_year_jan1() -> Column:
    return F.to_date(F.concat(F.col("model_year").cast("string"), F.lit("-01-01")))


LD = "load_dts"

HASHED_STAGES: list[HashedStage] = [
    HashedStage("stg_adjustment_txns_hk", "stg_adjustment_txns",
                {"adjustment_txn_hk": ["txn_bk"], "claim_line_hk": ["claim_line_bk"]},
                derived={"effective_from": "adjustment_date"}),
    HashedStage("stg_appeals_hk", "stg_appeals",
                {"appeal_hk": ["appeal_bk"], "claim_line_hk": ["claim_line_bk"],
                 "claim_appeal_hk": ["claim_line_bk", "appeal_bk"]}, derived={"effective_from": LD}),
    HashedStage("stg_appeals_sat_hk", "stg_appeals", {"appeal_hk": ["appeal_bk"]},
                {"appeal_hashdiff": ["appeal_status", "appeal_reason"]}, {"effective_from": LD}),
    HashedStage("stg_authorizations_hk", "stg_authorizations",
                {"authorization_hk": ["authorization_bk"], "claim_line_hk": ["claim_line_bk"],
                 "claim_authorization_hk": ["claim_line_bk", "authorization_bk"]},
                derived={"effective_from": LD}),
    HashedStage("stg_authorizations_sat_hk", "stg_authorizations", {"authorization_hk": ["authorization_bk"]},
                {"authorization_hashdiff": ["auth_status", "requested_date"]}, {"effective_from": LD}),
    HashedStage("stg_claim_diagnoses_hk", "stg_claim_diagnoses",
                {"claim_line_hk": ["claim_line_bk"], "diagnosis_hk": ["diagnosis_bk"],
                 "claim_diagnosis_hk": ["claim_line_bk", "diagnosis_bk"]}, derived={"effective_from": LD}),
    HashedStage("stg_claim_drg_hk", "stg_claim_drg",
                {"claim_line_hk": ["claim_line_bk"], "drg_hk": ["drg_bk"],
                 "claim_drg_hk": ["claim_line_bk", "drg_bk"]}, derived={"effective_from": LD}),
    HashedStage("stg_claim_lines_hk", "stg_claim_lines",
                {"claim_line_hk": ["claim_line_bk"], "provider_hk": ["provider_bk"], "member_hk": ["member_bk"],
                 "claim_provider_member_hk": ["claim_line_bk", "provider_bk", "member_bk"]},
                derived={"effective_from": LD}),
    HashedStage("stg_claim_lines_sat_hk", "stg_claim_lines", {"claim_line_hk": ["claim_line_bk"]},
                {"claim_hashdiff": ["service_from_date", "service_thru_date", "admission_date", "discharge_date",
                                    "drg_bk", "paid_amount", "primary_payer_paid_amount",
                                    "utilization_day_count", "claim_type"]},
                {"effective_from": LD}),
    HashedStage("stg_claim_procedures_hk", "stg_claim_procedures",
                {"claim_line_hk": ["claim_line_bk"], "procedure_hk": ["procedure_bk"],
                 "claim_procedure_hk": ["claim_line_bk", "procedure_bk"]}, derived={"effective_from": LD}),
    HashedStage("stg_cob_recovery_txns_hk", "stg_cob_recovery_txns",
                {"cob_recovery_txn_hk": ["txn_bk"], "claim_line_hk": ["claim_line_bk"]},
                derived={"effective_from": "recovery_date"}),
    HashedStage("stg_contracts_hk", "stg_contracts", {"contract_hk": ["contract_bk"]},
                derived={"effective_from": LD}),
    HashedStage("stg_contracts_sat_hk", "stg_contracts", {"contract_hk": ["contract_bk"]},
                {"contract_hashdiff": ["contract_model", "effective_date"]}, {"effective_from": LD}),
    HashedStage("stg_diagnoses_hk", "stg_diagnoses", {"diagnosis_hk": ["diagnosis_bk"]},
                derived={"effective_from": LD}),
    HashedStage("stg_diagnosis_hcc_crosswalk_hk", "stg_diagnosis_hcc_crosswalk",
                {"diagnosis_hk": ["diagnosis_bk"], "hcc_hk": ["hcc_bk"], "risk_model_hk": ["risk_model_bk"],
                 "diagnosis_hcc_crosswalk_hk": ["diagnosis_bk", "hcc_bk", "risk_model_bk"]}),
    HashedStage("stg_drgs_hk", "stg_drgs", {"drg_hk": ["drg_bk"]}, derived={"effective_from": LD}),
    HashedStage("stg_drgs_sat_hk", "stg_drgs", {"drg_hk": ["drg_bk"]},
                {"drg_hashdiff": ["drg_bk", "drg_description", "drg_relative_weight"]}, {"effective_from": LD}),
    HashedStage("stg_drugs_hk", "stg_drugs", {"drug_hk": ["drug_bk"]}),
    HashedStage("stg_drugs_sat_hk", "stg_drugs", {"drug_hk": ["drug_bk"]},
                {"drug_hashdiff": ["drug_name", "drug_class"]}),
    HashedStage("stg_encounter_diagnoses_hk", "stg_encounter_diagnoses",
                {"encounter_hk": ["encounter_bk"], "diagnosis_hk": ["diagnosis_bk"],
                 "encounter_diagnosis_hk": ["encounter_bk", "diagnosis_bk"]}),
    HashedStage("stg_encounters_hk", "stg_encounters",
                {"encounter_hk": ["encounter_bk"], "member_hk": ["member_bk"], "provider_hk": ["provider_bk"],
                 "facility_hk": ["facility_bk"], "member_encounter_hk": ["member_bk", "encounter_bk"],
                 "encounter_provider_hk": ["encounter_bk", "provider_bk"],
                 "encounter_facility_hk": ["encounter_bk", "facility_bk"]}),
    HashedStage("stg_encounters_sat_hk", "stg_encounters", {"encounter_hk": ["encounter_bk"]},
                {"encounter_hashdiff": ["encounter_class_code", "encounter_start", "encounter_end"]}),
    HashedStage("stg_facilities_hk", "stg_facilities", {"facility_hk": ["facility_bk"]},
                derived={"effective_from": LD}),
    HashedStage("stg_hcc_categories_hk", "stg_hcc_categories", {"hcc_hk": ["hcc_bk"]}),
    HashedStage("stg_hcc_categories_sat_hk", "stg_hcc_categories", {"hcc_hk": ["hcc_bk"]},
                {"hcc_hashdiff": ["hcc_description", "hcc_weight"]}),
    HashedStage("stg_measures_hk", "stg_measures", {"measure_hk": ["measure_bk"]}),
    HashedStage("stg_measures_sat_hk", "stg_measures", {"measure_hk": ["measure_bk"]},
                {"measure_hashdiff": ["measure_name", "measure_weight"]}),
    HashedStage("stg_member_hcc_hk", "stg_member_hcc",
                {"member_hk": ["member_bk"], "hcc_hk": ["hcc_bk"], "member_hcc_hk": ["member_bk", "hcc_bk"]}),
    HashedStage("stg_member_hcc_sat_hk", "stg_member_hcc",
                {"member_hk": ["member_bk"], "hcc_hk": ["hcc_bk"], "member_hcc_hk": ["member_bk", "hcc_bk"]},
                {"member_hcc_status_hashdiff": ["active_flag", "coding_gap_identified_date",
                                                "coding_gap_closed_date"]}),
    HashedStage("stg_member_measure_evals_hk", "stg_member_measure_evals",
                {"member_hk": ["member_bk"], "measure_hk": ["measure_bk"],
                 "member_measure_eval_txn_hk": ["member_bk", "measure_bk", "eval_date"]},
                derived={"effective_from": "eval_date"}),
    HashedStage("stg_member_measure_hk", "stg_member_measure",
                {"member_hk": ["member_bk"], "measure_hk": ["measure_bk"],
                 "member_measure_hk": ["member_bk", "measure_bk"]}),
    HashedStage("stg_member_risk_scores_hk", "stg_member_risk_scores",
                {"member_hk": ["member_bk"], "risk_model_hk": ["risk_model_bk"],
                 "member_risk_score_txn_hk": ["member_bk", "risk_model_bk", "model_year"]},
                derived={"effective_from": _model_year_jan1}),
    HashedStage("stg_members_hk", "stg_members", {"member_hk": ["member_bk"]}, derived={"effective_from": LD}),
    HashedStage("stg_members_sat_hk", "stg_members", {"member_hk": ["member_bk"]},
                {"member_hashdiff": ["birth_date", "sex", "race_code", "state_code"]}, {"effective_from": LD}),
    HashedStage("stg_payment_txns_hk", "stg_payment_txns",
                {"payment_txn_hk": ["txn_bk"], "claim_line_hk": ["claim_line_bk"]},
                derived={"effective_from": "payment_date"}),
    HashedStage("stg_pharmacies_hk", "stg_pharmacies", {"pharmacy_hk": ["pharmacy_bk"]}),
    HashedStage("stg_pharmacies_sat_hk", "stg_pharmacies", {"pharmacy_hk": ["pharmacy_bk"]},
                {"pharmacy_hashdiff": ["pharmacy_name", "pharmacy_type"]}),
    HashedStage("stg_pharmacy_fills_hk", "stg_pharmacy_fills",
                {"member_hk": ["member_bk"], "drug_hk": ["drug_bk"], "pharmacy_hk": ["pharmacy_bk"],
                 "pharmacy_drug_hk": ["pharmacy_bk", "drug_bk"], "member_pharmacy_hk": ["member_bk", "pharmacy_bk"],
                 "pharmacy_fill_txn_hk": ["member_bk", "drug_bk", "pharmacy_bk", "fill_date"]},
                derived={"effective_from": "fill_date"}),
    HashedStage("stg_procedures_hk", "stg_procedures", {"procedure_hk": ["procedure_bk"]},
                derived={"effective_from": LD}),
    HashedStage("stg_procedures_sat_hk", "stg_procedures", {"procedure_hk": ["procedure_bk"]},
                {"procedure_hashdiff": ["coding_system"]}, {"effective_from": LD}),
    HashedStage("stg_provider_contracts_hk", "stg_provider_contracts",
                {"provider_hk": ["provider_bk"], "contract_hk": ["contract_bk"],
                 "provider_contract_hk": ["provider_bk", "contract_bk"]}, derived={"effective_from": LD}),
    HashedStage("stg_providers_hk", "stg_providers", {"provider_hk": ["provider_bk"]},
                derived={"effective_from": LD}),
    HashedStage("stg_providers_sat_hk", "stg_providers", {"provider_hk": ["provider_bk"]},
                {"provider_hashdiff": ["provider_first_name", "provider_last_name", "provider_credential",
                                       "primary_taxonomy_code", "practice_state", "practice_city"]},
                {"effective_from": LD}),
    HashedStage("stg_risk_models_hk", "stg_risk_models", {"risk_model_hk": ["risk_model_bk"]}),
    HashedStage("stg_risk_models_sat_hk", "stg_risk_models", {"risk_model_hk": ["risk_model_bk"]},
                {"risk_model_hashdiff": ["model_name"]}),
    HashedStage("stg_suspected_hcc_hk", "stg_suspected_hcc",
                {"member_hk": ["member_bk"], "hcc_hk": ["hcc_bk"], "member_suspected_hcc_hk": ["member_bk", "hcc_bk"]}),
]

# Stages whose rows are gathered by a business key before they are hashed (``hashing.home``): every table key of the stage
# begins or ends with it.  Codes of a claim come gathered from their unpivoting.
GATHERED = {
    **{f"stg_{name}": ("claim_line_bk", FIRST) for name in ("claim_lines_hk", "claim_lines_sat_hk", "claim_drg_hk")},
    **{f"stg_{name}_txns_hk": ("txn_bk", FIRST) for name in ("adjustment", "payment", "cob_recovery")},
    **{f"stg_authorizations{part}_hk": ("authorization_bk", LAST) for part in ("", "_sat")},
    **{f"stg_appeals{part}_hk": ("appeal_bk", LAST) for part in ("", "_sat")},
}
# Bronze inputs of several such stages of one key: gathered as they are where one job loads two or more tables from them.
GATHERED_BRONZE = {
    "synpuf_inpatient_claim_header": ("stg_claim_lines_hk", "stg_claim_lines_sat_hk", "stg_claim_drg_hk"),
    "pi_authorizations": ("stg_authorizations_hk", "stg_authorizations_sat_hk"),
    "pi_appeals": ("stg_appeals_hk", "stg_appeals_sat_hk"),
}

HUBS: list[Hub] = [
    Hub("hub_appeal", "appeal_hk", "appeal_bk", "stg_appeals_hk"),
    Hub("hub_authorization", "authorization_hk", "authorization_bk", "stg_authorizations_hk"),
    Hub("hub_claim_line", "claim_line_hk", "claim_line_bk", "stg_claim_lines_hk"),
    Hub("hub_contract", "contract_hk", "contract_bk", "stg_contracts_hk"),
    Hub("hub_diagnosis", "diagnosis_hk", "diagnosis_bk", "stg_diagnoses_hk"),
    Hub("hub_drg", "drg_hk", "drg_bk", "stg_drgs_hk"),
    Hub("hub_drug", "drug_hk", "drug_bk", "stg_drugs_hk"),
    Hub("hub_encounter", "encounter_hk", "encounter_bk", "stg_encounters_hk"),
    Hub("hub_facility", "facility_hk", "facility_bk", "stg_facilities_hk"),
    Hub("hub_hcc_category", "hcc_hk", "hcc_bk", "stg_hcc_categories_hk"),
    Hub("hub_measure", "measure_hk", "measure_bk", "stg_measures_hk"),
    Hub("hub_member", "member_hk", "member_bk", "stg_members_hk"),
    Hub("hub_pharmacy", "pharmacy_hk", "pharmacy_bk", "stg_pharmacies_hk"),
    Hub("hub_procedure", "procedure_hk", "procedure_bk", "stg_procedures_hk"),
    Hub("hub_provider", "provider_hk", "provider_bk", "stg_providers_hk"),
    Hub("hub_risk_model", "risk_model_hk", "risk_model_bk", "stg_risk_models_hk"),
]

LINKS: list[Link] = [
    Link("lnk_claim_appeal", "claim_appeal_hk", ("claim_line_hk", "appeal_hk"), "stg_appeals_hk"),
    Link("lnk_claim_authorization", "claim_authorization_hk", ("claim_line_hk", "authorization_hk"),
         "stg_authorizations_hk"),
    Link("lnk_claim_diagnosis", "claim_diagnosis_hk", ("claim_line_hk", "diagnosis_hk"), "stg_claim_diagnoses_hk"),
    Link("lnk_claim_drg", "claim_drg_hk", ("claim_line_hk", "drg_hk"), "stg_claim_drg_hk"),
    Link("lnk_claim_procedure", "claim_procedure_hk", ("claim_line_hk", "procedure_hk"), "stg_claim_procedures_hk"),
    Link("lnk_claim_provider_member", "claim_provider_member_hk", ("claim_line_hk", "provider_hk", "member_hk"),
         "stg_claim_lines_hk"),
    Link("lnk_diagnosis_hcc_crosswalk", "diagnosis_hcc_crosswalk_hk", ("diagnosis_hk", "hcc_hk", "risk_model_hk"),
         "stg_diagnosis_hcc_crosswalk_hk"),
    Link("lnk_encounter_diagnosis", "encounter_diagnosis_hk", ("encounter_hk", "diagnosis_hk"),
         "stg_encounter_diagnoses_hk"),
    Link("lnk_encounter_facility", "encounter_facility_hk", ("encounter_hk", "facility_hk"), "stg_encounters_hk"),
    Link("lnk_encounter_provider", "encounter_provider_hk", ("encounter_hk", "provider_hk"), "stg_encounters_hk"),
    Link("lnk_member_encounter", "member_encounter_hk", ("member_hk", "encounter_hk"), "stg_encounters_hk"),
    Link("lnk_member_hcc", "member_hcc_hk", ("member_hk", "hcc_hk"), "stg_member_hcc_hk"),
    Link("lnk_member_measure", "member_measure_hk", ("member_hk", "measure_hk"), "stg_member_measure_hk"),
    Link("lnk_member_pharmacy", "member_pharmacy_hk", ("member_hk", "pharmacy_hk"), "stg_pharmacy_fills_hk"),
    Link("lnk_member_suspected_hcc", "member_suspected_hcc_hk", ("member_hk", "hcc_hk"), "stg_suspected_hcc_hk"),
    Link("lnk_pharmacy_drug", "pharmacy_drug_hk", ("pharmacy_hk", "drug_hk"), "stg_pharmacy_fills_hk"),
    Link("lnk_provider_contract", "provider_contract_hk", ("provider_hk", "contract_hk"), "stg_provider_contracts_hk"),
]

SATELLITES: list[Satellite] = [
    Satellite("sat_appeal_details", "appeal_hk", "appeal_hashdiff", ("appeal_status", "appeal_reason"),
              "stg_appeals_sat_hk"),
    Satellite("sat_authorization_details", "authorization_hk", "authorization_hashdiff",
              ("auth_status", "requested_date"), "stg_authorizations_sat_hk"),
    Satellite("sat_claim_details", "claim_line_hk", "claim_hashdiff",
              ("service_from_date", "service_thru_date", "admission_date", "discharge_date", "drg_bk",
               "paid_amount", "primary_payer_paid_amount", "utilization_day_count", "claim_type"),
              "stg_claim_lines_sat_hk"),
    Satellite("sat_contract_details", "contract_hk", "contract_hashdiff", ("contract_model", "effective_date"),
              "stg_contracts_sat_hk"),
    Satellite("sat_drg_details", "drg_hk", "drg_hashdiff", ("drg_description", "drg_relative_weight"),
              "stg_drgs_sat_hk"),
    Satellite("sat_drug_details", "drug_hk", "drug_hashdiff", ("drug_name", "drug_class"), "stg_drugs_sat_hk"),
    Satellite("sat_encounter_details", "encounter_hk", "encounter_hashdiff",
              ("encounter_class_code", "encounter_start", "encounter_end"), "stg_encounters_sat_hk"),
    Satellite("sat_hcc_category_details", "hcc_hk", "hcc_hashdiff", ("hcc_description", "hcc_weight"),
              "stg_hcc_categories_sat_hk"),
    Satellite("sat_measure_definition", "measure_hk", "measure_hashdiff", ("measure_name", "measure_weight"),
              "stg_measures_sat_hk"),
    # source_system is carried as payload but not hashed (it is fixed per member)
    Satellite("sat_member_demographics", "member_hk", "member_hashdiff",
              ("birth_date", "sex", "race_code", "state_code", "source_system"), "stg_members_sat_hk"),
    Satellite("sat_member_hcc_status", "member_hcc_hk", "member_hcc_status_hashdiff",
              ("active_flag", "coding_gap_identified_date", "coding_gap_closed_date"), "stg_member_hcc_sat_hk"),
    Satellite("sat_pharmacy_details", "pharmacy_hk", "pharmacy_hashdiff", ("pharmacy_name", "pharmacy_type"),
              "stg_pharmacies_sat_hk"),
    Satellite("sat_procedure_details", "procedure_hk", "procedure_hashdiff", ("coding_system",),
              "stg_procedures_sat_hk"),
    Satellite("sat_provider_details", "provider_hk", "provider_hashdiff",
              ("provider_first_name", "provider_last_name", "provider_credential", "primary_taxonomy_code",
               "practice_state", "practice_city"), "stg_providers_sat_hk"),
    Satellite("sat_risk_model_details", "risk_model_hk", "risk_model_hashdiff", ("model_name",),
              "stg_risk_models_sat_hk"),
]

TLINKS: list[TLink] = [
    TLink("tlnk_claim_adjustment_txn", "adjustment_txn_hk", ("claim_line_hk",),
          ("adjustment_amount", "adjustment_reason_code", "adjustment_date"), "stg_adjustment_txns_hk"),
    TLink("tlnk_claim_payment_txn", "payment_txn_hk", ("claim_line_hk",),
          ("billed_amount", "allowed_amount", "paid_amount", "payment_date"), "stg_payment_txns_hk"),
    TLink("tlnk_cob_recovery_txn", "cob_recovery_txn_hk", ("claim_line_hk",),
          ("recovery_amount", "recovery_date"), "stg_cob_recovery_txns_hk"),
    TLink("tlnk_member_measure_eval_txn", "member_measure_eval_txn_hk", ("member_hk", "measure_hk"),
          ("eval_result", "eval_date"), "stg_member_measure_evals_hk"),
    TLink("tlnk_member_risk_score_txn", "member_risk_score_txn_hk", ("member_hk", "risk_model_hk"),
          ("raf_score", "model_year"), "stg_member_risk_scores_hk"),
    TLink("tlnk_pharmacy_fill_txn", "pharmacy_fill_txn_hk", ("member_hk", "drug_hk", "pharmacy_hk"),
          ("days_supply", "fill_date"), "stg_pharmacy_fills_hk"),
]

BY_NAME = {x.name: x for x in [*HASHED_STAGES, *HUBS, *LINKS, *SATELLITES, *TLINKS]}
