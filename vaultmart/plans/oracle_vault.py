"""DuckDB oracles for every staging model, hashed stage and vault table.

The 31 staging models are restated below as DuckDB SQL over the proxy
bronze views.  Hashed stages and vault tables are generated from the
registry rows (the declarative spec: which columns are keys, hashdiffs,
payload), with the hash contract and the loader semantics written out in
SQL here, independently of the Spark operators:

* hub / link / t-link: rows with a NULL key part dropped; the earliest
  row per key by (load_dts, record_source, carried columns), NULLs first;
* satellite (one batch, empty target): one row per (key, load_dts) -- the
  smallest (hashdiff, record_source, payload) -- then a row is kept when
  its hashdiff differs from the previous row of the key by load_dts.

Outputs are rendered like ``queries.present``: decimals as doubles,
dates as ``yyyy-MM-dd`` text, timestamps as ``yyyy-MM-dd HH:mm:ss`` text,
integers as bigint.
"""

from __future__ import annotations

from vaultmart.plans import registry as R
from vaultmart.sources.proxy import bronze_sql

_B = bronze_sql("duckdb")


def n(x: str) -> str:
    return f"NULLIF(UPPER(TRIM(CAST({x} AS VARCHAR))), '')"


def hk(*cols: str) -> str:
    return "md5(" + " || '||' || ".join(n(c) for c in cols) + ")"


def hd(cols) -> str:
    return "md5(concat_ws('||', " + ", ".join(f"COALESCE({n(c)}, '^^')" for c in sorted(cols)) + "))"


def _unpivot(ids: str, cols: list[str], value: str) -> str:
    arms = " UNION ALL ".join(f"SELECT {ids}, CAST({c} AS VARCHAR) AS {value} FROM claims_wide" for c in cols)
    return (f"SELECT DISTINCT {ids}, {value} FROM ({arms}) u "
            f"WHERE {value} IS NOT NULL AND trim({value}) <> ''")


_IDS = "claim_line_bk, record_source, load_dts"
_LIT = "'{src}' AS record_source, TIMESTAMP '1970-01-01 00:00:00' AS load_dts"
_LD = "record_source, CAST(load_dts AS TIMESTAMP) AS load_dts"

# Derived bronze views (claim code bridges come from the wide code columns).
_DERIVED_BRONZE = {
    "synpuf_inpatient_claim_diagnoses": (["claims_wide"], _unpivot(_IDS, ["dx_1", "dx_2", "dx_3"], "diagnosis_bk")),
    "synpuf_inpatient_claim_procedures": (["claims_wide"], _unpivot(_IDS, ["px_1", "px_2"], "procedure_bk")),
}

# staging model -> (bronze inputs, SELECT, non-text column types)
# types: d = date, t = timestamp, m = decimal, i = integer; load_dts is always t
STG: dict[str, tuple[list[str], str, dict[str, str]]] = {
    "stg_members": (["synpuf_beneficiary_summary", "synthea_patients"], f"""
        SELECT member_bk, birth_date, sex_code AS sex, race_code, state_code, 'cms_de_synpuf' AS source_system, {_LD}
        FROM synpuf_beneficiary_summary
        UNION ALL
        SELECT member_bk, birth_date, sex, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), 'synthea', {_LD}
        FROM synthea_patients""", {"birth_date": "d"}),
    "stg_diagnoses": (["synpuf_inpatient_claim_diagnoses", "synthea_conditions"], f"""
        SELECT * FROM (SELECT DISTINCT diagnosis_bk, 'icd9' AS coding_system, {_LD}
                       FROM synpuf_inpatient_claim_diagnoses)
        UNION ALL
        SELECT * FROM (SELECT DISTINCT diagnosis_bk, 'snomed', {_LD} FROM synthea_conditions
                       WHERE diagnosis_bk IS NOT NULL)""", {}),
    "stg_drgs": (["synpuf_inpatient_claim_header", "drg_weights"], f"""
        SELECT d.drg_bk, w.drg_description, w.drg_relative_weight, d.record_source, d.load_dts
        FROM (SELECT DISTINCT drg_bk, {_LD} FROM synpuf_inpatient_claim_header
              WHERE drg_bk IS NOT NULL AND trim(drg_bk) <> '') d
        LEFT JOIN drg_weights w ON d.drg_bk = w.drg_bk""", {"drg_relative_weight": "m"}),
    "stg_procedures": (["synpuf_inpatient_claim_procedures"], f"""
        SELECT DISTINCT procedure_bk, 'icd9_procedure' AS coding_system, {_LD}
        FROM synpuf_inpatient_claim_procedures""", {}),
    "stg_claim_lines": (["synpuf_inpatient_claim_header"], f"""
        SELECT claim_line_bk, member_bk, provider_bk, service_from_date, service_thru_date, admission_date,
               discharge_date, drg_bk, paid_amount, primary_payer_paid_amount, utilization_day_count,
               'inpatient' AS claim_type, {_LD}
        FROM synpuf_inpatient_claim_header""",
        {"service_from_date": "d", "service_thru_date": "d", "admission_date": "d", "discharge_date": "d",
         "paid_amount": "m", "primary_payer_paid_amount": "m", "utilization_day_count": "i"}),
    "stg_claim_drg": (["synpuf_inpatient_claim_header"], f"""
        SELECT claim_line_bk, drg_bk, {_LD} FROM synpuf_inpatient_claim_header
        WHERE drg_bk IS NOT NULL AND trim(drg_bk) <> ''""", {}),
    "stg_claim_diagnoses": (["synpuf_inpatient_claim_diagnoses"], f"""
        SELECT claim_line_bk, diagnosis_bk, {_LD} FROM synpuf_inpatient_claim_diagnoses""", {}),
    "stg_claim_procedures": (["synpuf_inpatient_claim_procedures"], f"""
        SELECT claim_line_bk, procedure_bk, {_LD} FROM synpuf_inpatient_claim_procedures""", {}),
    "stg_providers": (["nppes_providers"], f"""
        SELECT npi AS provider_bk, provider_first_name, provider_last_name, provider_credential,
               primary_taxonomy_code, practice_state, practice_city, {_LD} FROM nppes_providers""", {}),
    "stg_facilities": (["nppes_facilities"], f"""
        SELECT npi AS facility_bk, organization_name, practice_state, practice_city, primary_taxonomy_code, {_LD}
        FROM nppes_facilities""", {}),
    "stg_pharmacies": (["nppes_facilities"], f"""
        SELECT npi AS pharmacy_bk, organization_name AS pharmacy_name, primary_taxonomy_code AS pharmacy_type, {_LD}
        FROM nppes_facilities WHERE primary_taxonomy_code = '3336C0003X'""", {}),
    "stg_drugs": (["ndc_products"], f"""
        SELECT productndc AS drug_bk, coalesce(nullif(proprietaryname, ''), nonproprietaryname) AS drug_name,
               pharm_classes AS drug_class, {_LD} FROM ndc_products""", {}),
    "stg_encounters": (["synthea_encounters"], f"""
        SELECT encounter_bk, member_reference AS member_bk, provider_reference AS provider_bk,
               facility_reference AS facility_bk, encounter_status, encounter_class_code, encounter_type_text,
               CAST(encounter_start AS TIMESTAMP) AS encounter_start, CAST(encounter_end AS TIMESTAMP) AS encounter_end,
               {_LD} FROM synthea_encounters""", {"encounter_start": "t", "encounter_end": "t"}),
    "stg_encounter_diagnoses": (["synthea_conditions"], f"""
        SELECT encounter_reference AS encounter_bk, diagnosis_bk, diagnosis_description, clinical_status_code,
               onset_date, {_LD} FROM synthea_conditions WHERE encounter_reference IS NOT NULL""",
        {"onset_date": "d"}),
    "stg_contracts": (["pi_contracts"], f"""
        SELECT contract_bk, contract_model, effective_date, {_LD} FROM pi_contracts""", {"effective_date": "d"}),
    "stg_provider_contracts": (["pi_provider_contracts"], f"""
        SELECT provider_bk, contract_bk, {_LD} FROM pi_provider_contracts""", {}),
    "stg_authorizations": (["pi_authorizations"], f"""
        SELECT authorization_bk, claim_line_bk, auth_status, requested_date, {_LD} FROM pi_authorizations""",
        {"requested_date": "d"}),
    "stg_appeals": (["pi_appeals"], f"""
        SELECT appeal_bk, claim_line_bk, appeal_status, appeal_reason, {_LD} FROM pi_appeals""", {}),
    "stg_payment_txns": (["pi_payment_transactions"], f"""
        SELECT txn_bk, claim_line_bk, billed_amount, allowed_amount, paid_amount, payment_date, {_LD}
        FROM pi_payment_transactions""",
        {"billed_amount": "m", "allowed_amount": "m", "paid_amount": "m", "payment_date": "d"}),
    "stg_adjustment_txns": (["pi_adjustment_transactions"], f"""
        SELECT txn_bk, claim_line_bk, adjustment_amount, adjustment_reason_code, adjustment_date, {_LD}
        FROM pi_adjustment_transactions""", {"adjustment_amount": "m", "adjustment_date": "d"}),
    "stg_cob_recovery_txns": (["pi_cob_recovery_transactions"], f"""
        SELECT txn_bk, claim_line_bk, recovery_amount, recovery_date, {_LD} FROM pi_cob_recovery_transactions""",
        {"recovery_amount": "m", "recovery_date": "d"}),
    "stg_hcc_categories": (["ra_hcc_categories"], f"""
        SELECT hcc_bk, hcc_description, hcc_weight, {_LIT.format(src='ra_hcc_categories')}
        FROM ra_hcc_categories""", {"hcc_weight": "m"}),
    "stg_risk_models": (["ra_risk_models"], f"""
        SELECT risk_model_bk, model_name, {_LIT.format(src='ra_risk_models')} FROM ra_risk_models""", {}),
    "stg_diagnosis_hcc_crosswalk": (["ra_diagnosis_hcc_crosswalk"], f"""
        SELECT diagnosis_bk, hcc_bk, risk_model_bk, {_LD} FROM ra_diagnosis_hcc_crosswalk""", {}),
    "stg_member_hcc": (["ra_member_hcc"], f"""
        SELECT member_bk, hcc_bk, active_flag, coding_gap_identified_date, coding_gap_closed_date, {_LD}
        FROM ra_member_hcc""", {"coding_gap_identified_date": "d", "coding_gap_closed_date": "d"}),
    "stg_suspected_hcc": (["ra_suspected_hcc"], f"""
        SELECT member_bk, hcc_bk, {_LD} FROM ra_suspected_hcc""", {}),
    "stg_member_risk_scores": (["ra_member_risk_scores"], f"""
        SELECT member_bk, risk_model_bk, raf_score, CAST(model_year AS INTEGER) AS model_year, {_LD}
        FROM ra_member_risk_scores""", {"raf_score": "m", "model_year": "i"}),
    "stg_measures": (["cq_measures"], f"""
        SELECT measure_bk, measure_name, measure_weight, {_LIT.format(src='cq_measures')} FROM cq_measures""",
        {"measure_weight": "m"}),
    "stg_member_measure": (["cq_member_measure"], f"""
        SELECT member_bk, measure_bk, {_LD} FROM cq_member_measure""", {}),
    "stg_member_measure_evals": (["cq_member_measure_evals"], f"""
        SELECT member_bk, measure_bk, eval_result, eval_date, {_LD} FROM cq_member_measure_evals""",
        {"eval_date": "d"}),
    "stg_pharmacy_fills": (["pharmacy_fills"], f"""
        SELECT member_bk, drug_bk, pharmacy_bk, fill_date, days_supply, {_LD} FROM pharmacy_fills""",
        {"fill_date": "d", "days_supply": "i"}),
}


def _bronze_ctes(stg_names: list[str]) -> list[str]:
    names: list[str] = []
    for s in stg_names:
        for b in STG[s][0]:
            if b in _DERIVED_BRONZE:
                for bb in _DERIVED_BRONZE[b][0]:
                    if bb not in names:
                        names.append(bb)
            if b not in names:
                names.append(b)
    ctes = []
    for b in names:
        sql = _DERIVED_BRONZE[b][1] if b in _DERIVED_BRONZE else _B[b]
        ctes.append(f"{b} AS ({sql})")
    return ctes


def render(col: str, kind: str | None, src: str = "") -> str:
    x = f"{src}{col}"
    if kind == "d":
        return f"CAST({x} AS VARCHAR) AS {col}"
    if kind == "t":
        return f"strftime({x}, '%Y-%m-%d %H:%M:%S') AS {col}"
    if kind == "m":
        return f"CAST({x} AS DOUBLE) AS {col}"
    if kind == "i":
        return f"CAST({x} AS BIGINT) AS {col}"
    return f"{x} AS {col}"


def _types(stg: str) -> dict[str, str]:
    t = dict(STG[stg][2])
    t["load_dts"] = "t"
    return t


def _present_all(rel: str, ty: dict[str, str]) -> str:
    """Every column of ``rel``, the non-text ones rendered in place."""
    return f"SELECT * REPLACE ({', '.join(render(c, k) for c, k in ty.items())}) FROM {rel}"


def staging_sql(stg: str) -> str:
    """Presented staging model."""
    body = ",\n".join(_bronze_ctes([stg]) + [f"{stg} AS ({STG[stg][1]})"])
    return f"WITH {body}\n{_present_all(stg, _types(stg))}"


# Derived expressions named by the registry (callables on the Spark side).
_DERIVED_SQL = {"_model_year_jan1": ("CAST(CAST(model_year AS VARCHAR) || '-01-01' AS DATE)", "d")}


def _hashed(hs: R.HashedStage) -> tuple[str, dict[str, str]]:
    """CTE body and non-text column types of a hashed stage."""
    ty = _types(hs.source)
    adds = [f"{hk(*parts)} AS {k}" for k, parts in hs.hashed.items()]
    adds += [f"{hd(parts)} AS {k}" for k, parts in hs.hashdiff.items()]
    for k, v in hs.derived.items():
        if callable(v):
            expr, kind = _DERIVED_SQL[v.__name__]
        else:
            expr, kind = v, ty.get(v)
        adds.append(f"{expr} AS {k}")
        if kind:
            ty[k] = kind
    return f"SELECT *, {', '.join(adds)} FROM {hs.source}", ty


def hashed_stage_sql(name: str) -> str:
    hs = R.BY_NAME[name]
    body, ty = _hashed(hs)
    ctes = _bronze_ctes([hs.source]) + [f"{hs.source} AS ({STG[hs.source][1]})", f"hs AS ({body})"]
    return "WITH " + ",\n".join(ctes) + "\n" + _present_all("hs", ty)


def _earliest(pk: str, keys: list[str], carry: list[str]) -> str:
    cond = " AND ".join(f"{c} IS NOT NULL" for c in [pk, *keys])
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in ["load_dts", "record_source", *carry])
    return (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {pk} ORDER BY {order}) AS _rn "
            f"FROM hs WHERE {cond}) WHERE _rn = 1")


def vault_table_sql(name: str) -> str:
    t = R.BY_NAME[name]
    hs = R.BY_NAME[t.source]
    body, ty = _hashed(hs)
    if isinstance(t, R.Hub):
        out = [t.pk, t.bk, "load_dts", "record_source"]
        final = _earliest(t.pk, [], [t.bk])
    elif isinstance(t, R.Link):
        out = [t.pk, *t.fks, "load_dts", "record_source"]
        final = _earliest(t.pk, list(t.fks), list(t.fks))
    elif isinstance(t, R.TLink):
        carry = [*t.fks, *t.payload, t.effective]
        out = [t.pk, *carry, "load_dts", "record_source"]
        final = _earliest(t.pk, list(t.fks), carry)
    else:
        out = [t.pk, t.hashdiff, *t.payload, "load_dts", "record_source"]
        pick = ", ".join(f"{c} ASC NULLS FIRST" for c in [t.hashdiff, "record_source", *t.payload])
        final = f"""SELECT * FROM (
            SELECT *, lag({t.hashdiff}) OVER (PARTITION BY {t.pk} ORDER BY load_dts) AS _prev FROM (
              SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {t.pk}, load_dts ORDER BY {pick}) AS _one
                             FROM hs WHERE {t.pk} IS NOT NULL AND load_dts IS NOT NULL) WHERE _one = 1))
          WHERE _prev IS NULL OR _prev <> {t.hashdiff}"""
    ctes = _bronze_ctes([hs.source]) + [f"{hs.source} AS ({STG[hs.source][1]})", f"hs AS ({body})",
                                        f"v AS ({final})"]
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {', '.join(render(c, ty.get(c)) for c in out)} FROM v"


def vault_query_name(name: str) -> str:
    t = R.BY_NAME[name]
    prefix = {R.Hub: "c04", R.Link: "c05", R.Satellite: "c06", R.TLink: "c07"}[type(t)]
    return f"{prefix}_{name}"


def staging_query_name(stg: str) -> str:
    from vaultmart.plans.staging import STAGING
    idx = list(STAGING).index(stg) + 1
    return f"b{idx:02d}_{stg}"


def hashed_query_name(name: str) -> str:
    return f"c03_{name}"
