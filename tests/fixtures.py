"""Linked fixture set: one consistent key space, text columns as landed.

Expected values used by the tests are worked out by hand in comments.
"""

LOAD1 = "2024-01-01 00:00:00"
LOAD2 = "2024-02-01 00:00:00"


def _df(spark, header, data):
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in header.split()))


def bronze(spark, with_lineage=True):
    from pyspark.sql import functions as F

    def lin(df, src, ts=LOAD1):
        if not with_lineage:
            return df
        return df.withColumns({"record_source": F.lit(src), "load_dts": F.lit(ts).cast("timestamp")})

    b = {
        "synpuf_beneficiary_summary": lin(_df(spark, "member_bk birth_date sex_code race_code state_code", [
            ("M1", "19450101", "1", "1", "NY"), ("M2", "19500615", "2", "2", "TX")]), "synpuf"),
        "synthea_patients": lin(_df(spark, "member_bk birth_date sex", [
            ("P1", "1960-05-05", "female"), ("P2", "1970-07-07", "male")]), "synthea"),
        "synpuf_inpatient_claim_header": lin(_df(
            spark, "claim_line_bk member_bk provider_bk service_from_date service_thru_date admission_date "
                   "discharge_date drg_bk paid_amount primary_payer_paid_amount utilization_day_count", [
                ("C1", "M1", "1001", "20230105", "20230110", "20230105", "20230110", "291", "600.00", "0", "5"),
                ("C2", "M2", "1002", "20230201", "20230203", "20230201", "20230203", "292", "300.00", "0", "2"),
                ("C3", "M1", "1001", "20240301", "20240302", "20240301", "20240302", " ", "200.00", "0", "1"),
                ("C4", "M2", "1003", "20240401", "20240402", "20240401", "20240402", "999", "0.00", "0", "1")]),
            "synpuf"),
        "synpuf_inpatient_claim_diagnoses": lin(_df(spark, "claim_line_bk diagnosis_bk", [
            ("C1", "4280"), ("C1", "41401"), ("C2", "25000")]), "synpuf"),
        "synpuf_inpatient_claim_procedures": lin(_df(spark, "claim_line_bk procedure_bk", [("C1", "3615")]), "synpuf"),
        "drg_weights": _df(spark, "drg_bk drg_description drg_relative_weight", [
            ("291", "Heart failure with MCC", "1.5000"), ("292", "Heart failure with CC", "0.5000")]),
        "nppes_providers": lin(_df(spark, "npi provider_first_name provider_last_name provider_credential "
                                          "primary_taxonomy_code practice_state practice_city", [
            ("1001", "Ann", "Smith", "MD", "207Q00000X", "NY", "Albany"),
            ("1002", "Bo", "Jones", "DO", "207Q00000X", "TX", "Austin"),
            ("1003", "Cy", "Lee", "NP", "207Q00000X", "CA", "Fresno")]), "nppes"),
        "nppes_facilities": lin(_df(spark, "npi organization_name practice_state practice_city primary_taxonomy_code", [
            ("org1", "General Hospital", "NY", "Albany", "282N00000X"),
            ("P9", "Corner Pharmacy", "NY", "Albany", "3336C0003X")]), "nppes"),
        "ndc_products": lin(_df(spark, "productndc proprietaryname nonproprietaryname pharm_classes", [
            ("D1", "", "metformin", "biguanide"), ("D2", "Lipitor", "atorvastatin", "statin")]), "ndc"),
        "synthea_encounters": lin(_df(spark, "encounter_bk member_reference provider_reference facility_reference "
                                             "encounter_status encounter_class_code encounter_type_text "
                                             "encounter_start encounter_end", [
            ("E1", "P1", "1001", "org1", "finished", "IMP", "adm", "2020-01-01T10:00:00+00:00", "2020-01-05T10:00:00+00:00"),
            ("E2", "P1", "1001", "org1", "finished", "IMP", "adm", "2020-01-20T10:00:00+00:00", "2020-01-22T10:00:00+00:00"),
            ("E3", "P1", "1001", "org1", "finished", "IMP", "adm", "2020-03-30T10:00:00+00:00", "2020-04-01T10:00:00+00:00"),
            ("E4", "P2", "1002", "org1", "finished", "EMER", "er", "2020-02-01T10:00:00+00:00", "2020-02-01T12:00:00+00:00"),
            ("E5", "P2", None, "org1", "finished", "AMB", "visit", "2020-02-03T10:00:00+00:00", "2020-02-03T11:00:00+00:00")]),
            "synthea"),
        "synthea_conditions": lin(_df(spark, "condition_bk clinical_status_code diagnosis_bk diagnosis_description "
                                             "member_reference encounter_reference onset_date", [
            ("X1", "active", "44054006", "Diabetes", "P1", "E1", "2019-05-01"),
            ("X2", "active", "38341003", "Hypertension", "P2", None, "2019-06-01")]), "synthea"),
        "pi_payment_transactions": _df(spark, "txn_bk claim_line_bk billed_amount allowed_amount paid_amount payment_date", [
            ("T1", "C1", "1000.00", "800.00", "600.00", "2023-02-01"),
            ("T1", "C1", "1000.00", "800.00", "600.00", "2023-02-01"),      # duplicate delivery
            ("T2", "C2", "500.00", "400.00", "300.00", "2023-03-01"),
            ("T3", "C3", "200.00", "200.00", "200.00", "2024-04-01"),
            ("T4", "C4", "0.00", "0.00", "0.00", "2024-05-01")]),
        "pi_adjustment_transactions": _df(spark, "txn_bk claim_line_bk adjustment_amount adjustment_reason_code adjustment_date", [
            ("A1", "C1", "-50.00", "CO-45", "2023-02-01"), ("A2", "C2", "-10.00", "PR-1", "2023-03-01")]),
        "pi_cob_recovery_transactions": _df(spark, "txn_bk claim_line_bk recovery_amount recovery_date", [
            ("R1", "C1", "120.50", "2023-06-01")]),
        "pi_authorizations": _df(spark, "authorization_bk claim_line_bk auth_status requested_date", [
            ("AU1", "C1", "approved", "2023-01-01"), ("AU2", "C2", "denied", "2023-01-15")]),
        "pi_appeals": _df(spark, "appeal_bk claim_line_bk appeal_status appeal_reason", [
            ("AP1", "C2", "overturned", "coding_error")]),
        "pi_contracts": _df(spark, "contract_bk contract_model effective_date", [("K1", "MSSP", "2023-01-01")]),
        "pi_provider_contracts": _df(spark, "provider_bk contract_bk", [("1001", "K1")]),
        "ra_risk_models": _df(spark, "risk_model_bk model_name", [("V24", "CMS-HCC V24")]),
        "ra_hcc_categories": _df(spark, "hcc_bk hcc_description hcc_weight", [
            ("H18", "Diabetes", "0.3000"), ("H85", "Heart failure", "0.4000"), ("H19", "Diabetes w/o", "0.2000")]),
        "ra_diagnosis_hcc_crosswalk": _df(spark, "diagnosis_bk hcc_bk risk_model_bk", [("25000", "H19", "V24")]),
        "ra_member_hcc": _df(spark, "member_bk hcc_bk active_flag coding_gap_identified_date coding_gap_closed_date", [
            ("M1", "H18", "N", "2023-01-01", "2023-06-01"), ("M2", "H19", "Y", "2023-02-01", "")]),
        "ra_suspected_hcc": _df(spark, "member_bk hcc_bk", [("M1", "H18"), ("M1", "H85"), ("M2", "H18")]),
        "ra_member_risk_scores": _df(spark, "member_bk risk_model_bk raf_score model_year", [
            ("M1", "V24", "0.5000", "2023"), ("M1", "V24", "1.5000", "2024"),
            ("M2", "V24", "2.5000", "2023"), ("M2", "V24", None, "2024")]),
        "cq_measures": _df(spark, "measure_bk measure_name measure_weight", [
            ("BCS-E", "Breast Cancer Screening", "1.0000"), ("COL-E", "Colorectal Cancer Screening", "1.0000")]),
        "cq_member_measure": _df(spark, "member_bk measure_bk", [("M1", "BCS-E"), ("M1", "COL-E"), ("M2", "BCS-E")]),
        "cq_member_measure_evals": _df(spark, "member_bk measure_bk eval_result eval_date", [
            ("M1", "BCS-E", "met", "2023-03-01"), ("M1", "COL-E", "not_met", "2023-04-01"),
            ("M2", "BCS-E", None, "2023-05-01")]),
        "pharmacy_fills": _df(spark, "member_bk drug_bk pharmacy_bk fill_date days_supply", [
            ("M1", "D1", "P9", "2023-01-01", "90"), ("M1", "D1", "P9", "2023-04-01", "300"),
            ("M2", "D2", "P9", "2023-02-01", "30")]),
    }
    return b
