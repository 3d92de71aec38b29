"""DuckDB SQL oracles for the registered queries.

Each oracle restates the operator's semantics in plain SQL over the
same proxy inputs (``proxy.bronze_sql('duckdb')``) and the same hash
contract, written independently of the Spark operators.
"""

from __future__ import annotations

from vaultmart.sources.proxy import bronze_sql

ORACLE: dict[str, str] = {}
_B = bronze_sql("duckdb")


def n(x: str) -> str:
    """Normalised text of a business-key column (hash contract)."""
    return f"NULLIF(UPPER(TRIM(CAST({x} AS VARCHAR))), '')"


def nd(x: str) -> str:
    return f"NULLIF(UPPER(TRIM(strftime({x}, '%Y-%m-%d'))), '')"


def hk(*cols: str) -> str:
    return "md5(" + " || '||' || ".join(n(c) for c in cols) + ")"


def with_bronze(*names: str, extra: str = "") -> str:
    parts = [f"{nm} AS ({_B[nm]})" for nm in names]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql


# --- flagship: payment leakage rate by provider and year -------------------
oracle("m02_payment_leakage_rate_by_provider_year", with_bronze(
    "pi_payment_transactions", "synpuf_inpatient_claim_header",
    extra=f"""pay AS (SELECT {hk('txn_bk')} AS payment_txn_hk, {hk('claim_line_bk')} AS claim_line_hk,
                  billed_amount, paid_amount, payment_date FROM pi_payment_transactions),
  lnk AS (SELECT DISTINCT {hk('claim_line_bk')} AS claim_line_hk, {hk('provider_bk')} AS provider_hk
          FROM synpuf_inpatient_claim_header
          WHERE claim_line_bk IS NOT NULL AND provider_bk IS NOT NULL AND member_bk IS NOT NULL)""") + """
SELECT l.provider_hk AS provider, CAST(CAST(date_trunc('year', p.payment_date) AS DATE) AS VARCHAR) AS metric_time,
       CAST(sum(p.billed_amount - p.paid_amount) AS DOUBLE) / NULLIF(CAST(sum(p.billed_amount) AS DOUBLE), 0)
         AS payment_leakage_rate
FROM pay p LEFT JOIN lnk l ON p.claim_line_hk = l.claim_line_hk
GROUP BY 1, 2""")


def hd(cols: list[str], dates: tuple = ()) -> str:
    parts = [f"COALESCE({nd(c) if c in dates else n(c)}, '^^')" for c in sorted(cols)]
    return "md5(concat_ws('||', " + ", ".join(parts) + "))"


def ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def dt(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


CLAIM_SAT_COLS = ["service_from_date", "service_thru_date", "admission_date", "discharge_date", "drg_bk",
                  "paid_amount", "primary_payer_paid_amount", "utilization_day_count", "claim_type"]
CLAIM_DATES = ("service_from_date", "service_thru_date", "admission_date", "discharge_date")

STG_CLAIMS = "stg_claims AS (SELECT *, 'inpatient' AS claim_type FROM synpuf_inpatient_claim_header)"

oracle("c03_stage_claim_lines_keys", with_bronze("synpuf_inpatient_claim_header", extra=STG_CLAIMS) + f"""
SELECT claim_line_bk, {hk('claim_line_bk')} AS claim_line_hk, {hk('provider_bk')} AS provider_hk,
       {hk('member_bk')} AS member_hk, {hk('claim_line_bk', 'provider_bk', 'member_bk')} AS claim_provider_member_hk,
       {hd(CLAIM_SAT_COLS, CLAIM_DATES)} AS claim_hashdiff
FROM stg_claims""")


def earliest(src: str, pk: str, order: list[str], cols: list[str]) -> str:
    o = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER (PARTITION BY {pk} ORDER BY {o}) AS _rn "
            f"FROM {src} WHERE {pk} IS NOT NULL) WHERE _rn = 1")


oracle("c04_hub_claim_line_two_batches", with_bronze(
    "synpuf_inpatient_claim_header",
    extra=f"s AS (SELECT {hk('claim_line_bk')} AS claim_line_hk, claim_line_bk, load_dts, record_source "
          f"FROM synpuf_inpatient_claim_header)") + f"""
SELECT claim_line_hk, claim_line_bk, {ts('load_dts')} AS load_dts, record_source FROM (
{earliest('s', 'claim_line_hk', ['load_dts', 'record_source', 'claim_line_bk'],
          ['claim_line_hk', 'claim_line_bk', 'load_dts', 'record_source'])})""")

STG_MEMBERS = """stg_members AS (
  SELECT member_bk, birth_date, sex_code AS sex, race_code, state_code, 'cms_de_synpuf' AS source_system,
         record_source, load_dts FROM synpuf_beneficiary_summary
  UNION ALL
  SELECT member_bk, birth_date, sex, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), 'synthea', record_source, load_dts
  FROM synthea_patients)"""

oracle("c04_hub_member_two_sources", with_bronze(
    "synpuf_beneficiary_summary", "synthea_patients",
    extra=STG_MEMBERS + f", s AS (SELECT {hk('member_bk')} AS member_hk, member_bk, load_dts, record_source "
                        f"FROM stg_members)") + f"""
SELECT member_hk, member_bk, {ts('load_dts')} AS load_dts, record_source FROM (
{earliest('s', 'member_hk', ['load_dts', 'record_source', 'member_bk'],
          ['member_hk', 'member_bk', 'load_dts', 'record_source'])})""")

oracle("c05_link_encounter_provider", with_bronze(
    "synthea_encounters",
    extra=f"""s AS (SELECT {hk('encounter_bk', 'provider_reference')} AS encounter_provider_hk,
                      {hk('encounter_bk')} AS encounter_hk, {hk('provider_reference')} AS provider_hk,
                      load_dts, record_source FROM synthea_encounters),
              f AS (SELECT * FROM s WHERE encounter_hk IS NOT NULL AND provider_hk IS NOT NULL)""") + f"""
SELECT encounter_provider_hk, encounter_hk, provider_hk, {ts('load_dts')} AS load_dts, record_source FROM (
{earliest('f', 'encounter_provider_hk', ['load_dts', 'record_source', 'encounter_hk', 'provider_hk'],
          ['encounter_provider_hk', 'encounter_hk', 'provider_hk', 'load_dts', 'record_source'])})""")

SAT_HISTORY = f"""WITH s AS (
  SELECT {hk('o_custkey')} AS member_hk, o_orderpriority, o_orderstatus, CAST(o_orderdate AS TIMESTAMP) AS load_dts,
         'proxy.orders' AS record_source, {hd(['o_orderpriority', 'o_orderstatus'])} AS status_hashdiff FROM orders),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY member_hk, load_dts
          ORDER BY status_hashdiff, record_source, o_orderpriority, o_orderstatus) AS rn FROM s) WHERE rn = 1),
lagged AS (SELECT *, lag(status_hashdiff) OVER (PARTITION BY member_hk ORDER BY load_dts) AS prev FROM one),
hist AS (SELECT member_hk, status_hashdiff, o_orderpriority, o_orderstatus, load_dts, record_source FROM lagged
         WHERE prev IS NULL OR prev <> status_hashdiff)
"""

oracle("c06_satellite_history_two_batches", SAT_HISTORY + f"""
SELECT member_hk, status_hashdiff, o_orderpriority, o_orderstatus, {ts('load_dts')} AS load_dts, record_source
FROM hist""")

oracle("c08_current_satellite", SAT_HISTORY + f"""
SELECT member_hk, status_hashdiff, o_orderpriority, o_orderstatus, {ts('load_dts')} AS load_dts, record_source
FROM (SELECT *, row_number() OVER (PARTITION BY member_hk ORDER BY load_dts DESC) AS r FROM hist) WHERE r = 1""")

oracle("c07_tlink_measure_eval", with_bronze(
    "cq_member_measure_evals",
    extra=f"""s AS (SELECT {hk('member_bk')} AS member_hk, {hk('measure_bk')} AS measure_hk,
        md5({n('member_bk')} || '||' || {n('measure_bk')} || '||' || {nd('eval_date')}) AS member_measure_eval_txn_hk,
        eval_result, eval_date, eval_date AS effective_from, load_dts, record_source FROM cq_member_measure_evals),
      f AS (SELECT * FROM s WHERE member_hk IS NOT NULL AND measure_hk IS NOT NULL)""") + f"""
SELECT member_measure_eval_txn_hk, member_hk, measure_hk, eval_result, {dt('eval_date')} AS eval_date,
       {dt('effective_from')} AS effective_from, {ts('load_dts')} AS load_dts, record_source FROM (
{earliest('f', 'member_measure_eval_txn_hk',
          ['load_dts', 'record_source', 'member_hk', 'measure_hk', 'eval_result', 'eval_date', 'effective_from'],
          ['member_measure_eval_txn_hk', 'member_hk', 'measure_hk', 'eval_result', 'eval_date', 'effective_from',
           'load_dts', 'record_source'])})""")

oracle("a02_dedupe_latest_order_per_customer", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {ts('o_orderdate')} AS o_orderdate, o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r
      FROM orders) WHERE r = 1""")

CLAIM_DX = """dx AS (SELECT DISTINCT claim_line_bk, record_source, load_dts, code AS diagnosis_bk FROM (
    SELECT claim_line_bk, record_source, load_dts, dx_1 AS code FROM claims_wide
    UNION ALL SELECT claim_line_bk, record_source, load_dts, dx_2 FROM claims_wide
    UNION ALL SELECT claim_line_bk, record_source, load_dts, dx_3 FROM claims_wide)
  WHERE code IS NOT NULL AND trim(code) <> '')"""

oracle("a05_unpivot_claim_diagnoses", with_bronze("claims_wide", extra=CLAIM_DX) + f"""
SELECT claim_line_bk, record_source, {ts('load_dts')} AS load_dts, diagnosis_bk FROM dx""")

oracle("a09_orphan_claim_drgs", with_bronze("synpuf_inpatient_claim_header", "drg_weights") + """
SELECT drg_bk, count(*) AS orphan_claims FROM synpuf_inpatient_claim_header c
WHERE trim(drg_bk) <> '' AND NOT EXISTS (SELECT 1 FROM drg_weights w WHERE w.drg_bk = c.drg_bk)
GROUP BY drg_bk""")

oracle("b01_stg_members", with_bronze("synpuf_beneficiary_summary", "synthea_patients", extra=STG_MEMBERS) + f"""
SELECT member_bk, {dt('birth_date')} AS birth_date, sex, race_code, state_code, source_system, record_source,
       {ts('load_dts')} AS load_dts FROM stg_members""")

oracle("b02_stg_diagnoses", with_bronze("claims_wide", "synthea_conditions", extra=CLAIM_DX) + f"""
SELECT diagnosis_bk, coding_system, record_source, {ts('load_dts')} AS load_dts FROM (
  SELECT DISTINCT diagnosis_bk, 'icd9' AS coding_system, record_source, load_dts FROM dx
  UNION ALL
  SELECT DISTINCT diagnosis_bk, 'snomed', record_source, load_dts FROM synthea_conditions
  WHERE diagnosis_bk IS NOT NULL)""")

oracle("b03_stg_drgs", with_bronze("synpuf_inpatient_claim_header", "drg_weights") + f"""
SELECT d.drg_bk, w.drg_description, CAST(w.drg_relative_weight AS DOUBLE) AS drg_relative_weight, d.record_source,
       {ts('d.load_dts')} AS load_dts
FROM (SELECT DISTINCT drg_bk, record_source, load_dts FROM synpuf_inpatient_claim_header
      WHERE drg_bk IS NOT NULL AND trim(drg_bk) <> '') d
LEFT JOIN drg_weights w ON d.drg_bk = w.drg_bk""")

oracle("b11_stg_pharmacies", with_bronze("nppes_facilities") + f"""
SELECT npi AS pharmacy_bk, organization_name AS pharmacy_name, primary_taxonomy_code AS pharmacy_type,
       record_source, {ts('load_dts')} AS load_dts
FROM nppes_facilities WHERE primary_taxonomy_code = '3336C0003X'""")

oracle("b12_stg_drugs", with_bronze("ndc_products") + f"""
SELECT productndc AS drug_bk, coalesce(nullif(proprietaryname, ''), nonproprietaryname) AS drug_name,
       pharm_classes AS drug_class, record_source, {ts('load_dts')} AS load_dts FROM ndc_products""")


# ---------------------------------------------------------------------------
# gold dimensions and facts
# ---------------------------------------------------------------------------
def nn(x: str) -> str:
    return f"{n(x)} IS NOT NULL"


G = {
    "lpm": f"""lpm AS (SELECT DISTINCT {hk('claim_line_bk')} AS claim_line_hk, {hk('provider_bk')} AS provider_hk,
                  {hk('member_bk')} AS member_hk FROM synpuf_inpatient_claim_header
                  WHERE {nn('claim_line_bk')} AND {nn('provider_bk')} AND {nn('member_bk')})""",
    "ld": f"""ld AS (SELECT DISTINCT {hk('claim_line_bk')} AS claim_line_hk, {hk('drg_bk')} AS drg_hk
                FROM synpuf_inpatient_claim_header WHERE {nn('claim_line_bk')} AND {nn('drg_bk')})""",
    "satcl": f"""satcl AS (SELECT {hk('claim_line_bk')} AS claim_line_hk, service_from_date, admission_date
                   FROM synpuf_inpatient_claim_header)""",
    "pay": f"""pay0 AS (SELECT {hk('txn_bk')} AS payment_txn_hk, {hk('claim_line_bk')} AS claim_line_hk, billed_amount,
                 allowed_amount, paid_amount, payment_date, payment_date AS effective_from, load_dts, record_source
                 FROM pi_payment_transactions),
           pay AS ({earliest('pay0', 'payment_txn_hk',
                             ['load_dts', 'record_source', 'claim_line_hk', 'billed_amount', 'allowed_amount',
                              'paid_amount', 'payment_date', 'effective_from'],
                             ['payment_txn_hk', 'claim_line_hk', 'billed_amount', 'allowed_amount', 'paid_amount',
                              'payment_date'])})""",
    "fcp": """fcp AS (SELECT p.payment_txn_hk, p.claim_line_hk, l.provider_hk, l.member_hk, d.drg_hk, p.billed_amount,
                 p.allowed_amount, p.paid_amount, p.billed_amount - p.paid_amount AS leakage_amount, p.payment_date,
                 s.service_from_date, s.admission_date
               FROM pay p LEFT JOIN lpm l ON p.claim_line_hk = l.claim_line_hk
               LEFT JOIN ld d ON p.claim_line_hk = d.claim_line_hk
               LEFT JOIN satcl s ON p.claim_line_hk = s.claim_line_hk)""",
    "ddrg": f"""ddrg AS (SELECT {hk('c.drg_bk')} AS drg_hk, c.drg_bk, w.drg_description, w.drg_relative_weight
                  FROM (SELECT DISTINCT drg_bk FROM synpuf_inpatient_claim_header WHERE {nn('drg_bk')}) c
                  LEFT JOIN drg_weights w ON c.drg_bk = w.drg_bk)""",
    "fdrg": """cw AS (SELECT f.payment_txn_hk, f.claim_line_hk, f.provider_hk, f.drg_hk, f.paid_amount, d.drg_relative_weight
                FROM fcp f JOIN ddrg d ON f.drg_hk = d.drg_hk WHERE d.drg_relative_weight IS NOT NULL),
           bench AS (SELECT CAST(CAST(sum(paid_amount) AS DOUBLE) / NULLIF(CAST(sum(drg_relative_weight) AS DOUBLE), 0)
                            AS DECIMAL(18,6)) AS dollars_per_weight_unit FROM cw),
           fdrg AS (SELECT c.*, b.dollars_per_weight_unit,
                           c.drg_relative_weight * b.dollars_per_weight_unit AS expected_paid_amount,
                           c.paid_amount - c.drg_relative_weight * b.dollars_per_weight_unit AS reimbursement_variance
                    FROM cw c CROSS JOIN bench b)""",
    "adj": f"""adj AS (SELECT {hk('txn_bk')} AS adjustment_txn_hk, {hk('claim_line_bk')} AS claim_line_hk,
                 adjustment_amount, adjustment_reason_code, adjustment_date FROM pi_adjustment_transactions)""",
    "fadj": """fadj AS (SELECT a.adjustment_txn_hk, a.claim_line_hk, l.provider_hk, l.member_hk, a.adjustment_amount,
                  a.adjustment_reason_code, a.adjustment_date FROM adj a LEFT JOIN lpm l ON a.claim_line_hk = l.claim_line_hk)""",
    "fcob": f"""fcob AS (SELECT {hk('c.txn_bk')} AS cob_recovery_txn_hk, {hk('c.claim_line_bk')} AS claim_line_hk,
                  l.member_hk, c.recovery_amount, c.recovery_date FROM pi_cob_recovery_transactions c
                  LEFT JOIN lpm l ON {hk('c.claim_line_bk')} = l.claim_line_hk)""",
    "dauth": f"""dauth AS (SELECT {hk('authorization_bk')} AS authorization_hk, authorization_bk, auth_status,
                   requested_date, claim_line_bk FROM pi_authorizations)""",
    "fauth": f"""fauth AS (SELECT authorization_hk, CASE WHEN {nn('claim_line_bk')} THEN {hk('claim_line_bk')} END
                   AS claim_line_hk, auth_status, requested_date FROM dauth)""",
    "dapl": f"""dapl AS (SELECT {hk('appeal_bk')} AS appeal_hk, appeal_bk, appeal_status, appeal_reason, claim_line_bk
                  FROM pi_appeals)""",
    "fapl": f"""fapl AS (SELECT appeal_hk, {hk('claim_line_bk')} AS claim_line_hk, appeal_status, appeal_reason
                  FROM dapl)""",
    "frs": f"""frs AS (SELECT md5({n('member_bk')} || '||' || {n('risk_model_bk')} || '||' || {n('model_year')})
                   AS member_risk_score_txn_hk, {hk('member_bk')} AS member_hk, {hk('risk_model_bk')} AS risk_model_hk,
                   raf_score, model_year, CAST(CAST(model_year AS VARCHAR) || '-01-01' AS DATE) AS effective_from
                 FROM ra_member_risk_scores)""",
    "ftier": """ftier AS (SELECT member_risk_score_txn_hk, member_hk, risk_model_hk, raf_score, model_year,
                   CASE WHEN raf_score < 1.0 THEN 'low' WHEN raf_score < 2.0 THEN 'medium' ELSE 'high' END AS risk_tier
                 FROM frs)""",
    "fhcc": f"""sus AS (SELECT DISTINCT {hk('member_bk')} AS member_hk, {hk('hcc_bk')} AS hcc_hk, 1 AS is_suspected
                 FROM ra_suspected_hcc),
           cap AS (SELECT DISTINCT {hk('member_bk')} AS member_hk, {hk('hcc_bk')} AS hcc_hk, 1 AS is_captured
                 FROM ra_member_hcc),
           comb AS (SELECT coalesce(s.member_hk, c.member_hk) AS member_hk, coalesce(s.hcc_hk, c.hcc_hk) AS hcc_hk,
                       coalesce(s.is_suspected, 0) AS is_suspected, coalesce(c.is_captured, 0) AS is_captured
                    FROM sus s FULL OUTER JOIN cap c ON s.member_hk = c.member_hk AND s.hcc_hk = c.hcc_hk),
           fhcc AS (SELECT sha256(concat_ws('|', member_hk, hcc_hk)) AS hcc_capture_hk, member_hk, hcc_hk,
                       is_suspected, is_captured,
                       CASE WHEN is_suspected = 1 AND is_captured = 1 THEN 1 ELSE 0 END AS is_captured_and_suspected
                    FROM comb)""",
    "fgap": f"""fgap AS (SELECT {hk('member_bk', 'hcc_bk')} AS member_hcc_hk, {hk('member_bk')} AS member_hk,
                   {hk('hcc_bk')} AS hcc_hk, active_flag, coding_gap_identified_date, coding_gap_closed_date,
                   CASE WHEN coding_gap_closed_date IS NOT NULL THEN 1 ELSE 0 END AS is_gap_closed FROM ra_member_hcc)""",
    "dhcc": f"""dhcc AS (SELECT {hk('hcc_bk')} AS hcc_hk, hcc_bk AS hcc_code, hcc_description, hcc_weight
                  FROM ra_hcc_categories)""",
    "facc": """sw AS (SELECT f.member_hk, sum(d.hcc_weight) AS suspected_raf_approx FROM fhcc f
                LEFT JOIN dhcc d ON f.hcc_hk = d.hcc_hk WHERE f.is_suspected = 1 GROUP BY f.member_hk),
           facc AS (SELECT a.member_hk, a.risk_model_hk, a.model_year, a.raf_score AS actual_raf_score,
                       sw.suspected_raf_approx, a.raf_score - coalesce(sw.suspected_raf_approx, 0) AS raf_accuracy_variance
                    FROM frs a LEFT JOIN sw ON a.member_hk = sw.member_hk)""",
    "fenc": f"""fenc AS (SELECT {hk('encounter_bk')} AS encounter_hk,
                   CASE WHEN {nn('member_reference')} THEN {hk('member_reference')} END AS member_hk,
                   CASE WHEN {nn('provider_reference')} THEN {hk('provider_reference')} END AS provider_hk,
                   CASE WHEN {nn('facility_reference')} THEN {hk('facility_reference')} END AS facility_hk,
                   encounter_class_code, encounter_start, encounter_end FROM synthea_encounters)""",
    "fread": """ip AS (SELECT encounter_hk, member_hk, encounter_start, encounter_end FROM fenc
                WHERE encounter_class_code = 'IMP' AND member_hk IS NOT NULL),
           nxt AS (SELECT i.encounter_hk, i.member_hk, i.encounter_start, i.encounter_end,
                      min(CASE WHEN n.encounter_start > i.encounter_end
                                AND n.encounter_start <= i.encounter_end + INTERVAL 30 DAY
                               THEN n.encounter_start END) AS nx
                   FROM ip i LEFT JOIN ip n ON i.member_hk = n.member_hk AND n.encounter_hk <> i.encounter_hk
                   GROUP BY i.encounter_hk, i.member_hk, i.encounter_start, i.encounter_end),
           fread AS (SELECT encounter_hk AS index_encounter_hk, member_hk, encounter_start AS index_admission_date,
                        encounter_end AS index_discharge_date, nx AS next_admission_within_30_days,
                        CASE WHEN nx IS NOT NULL THEN 1 ELSE 0 END AS is_readmission
                     FROM nxt WHERE encounter_end IS NOT NULL)""",
    "dmeas": f"""dmeas AS (SELECT {hk('measure_bk')} AS measure_hk, measure_bk AS measure_code, measure_name,
                   measure_weight FROM cq_measures)""",
    "fmeas": f"""ev AS (SELECT {hk('member_bk')} AS member_hk, {hk('measure_bk')} AS measure_hk,
                md5({n('member_bk')} || '||' || {n('measure_bk')} || '||' || {nd('eval_date')}) AS member_measure_eval_txn_hk,
                eval_result, eval_date, eval_date AS effective_from, load_dts, record_source FROM cq_member_measure_evals),
           evt AS ({earliest('ev', 'member_measure_eval_txn_hk',
                             ['load_dts', 'record_source', 'member_hk', 'measure_hk', 'eval_result', 'eval_date',
                              'effective_from'],
                             ['member_measure_eval_txn_hk', 'member_hk', 'measure_hk', 'eval_result', 'eval_date',
                              'effective_from'])}),
           fmeas AS (SELECT t.member_measure_eval_txn_hk, t.member_hk, t.measure_hk, d.measure_code, d.measure_weight,
                        t.eval_result, t.eval_date, t.effective_from FROM evt t LEFT JOIN dmeas d
                        ON t.measure_hk = d.measure_hk)""",
    "ddrug": f"""ddrug AS (SELECT {hk('productndc')} AS drug_hk, productndc AS ndc,
                   coalesce(nullif(proprietaryname, ''), nonproprietaryname) AS drug_name, pharm_classes AS drug_class
                   FROM ndc_products)""",
    "ffill": f"""fl AS (SELECT md5({n('member_bk')} || '||' || {n('drug_bk')} || '||' || {n('pharmacy_bk')} || '||' ||
                   {nd('fill_date')}) AS pharmacy_fill_txn_hk, {hk('member_bk')} AS member_hk, {hk('drug_bk')} AS drug_hk,
                   {hk('pharmacy_bk')} AS pharmacy_hk, days_supply, fill_date, fill_date AS effective_from, load_dts,
                   record_source FROM pharmacy_fills),
           flt AS ({earliest('fl', 'pharmacy_fill_txn_hk',
                             ['load_dts', 'record_source', 'member_hk', 'drug_hk', 'pharmacy_hk', 'days_supply',
                              'fill_date', 'effective_from'],
                             ['pharmacy_fill_txn_hk', 'member_hk', 'drug_hk', 'pharmacy_hk', 'days_supply', 'fill_date',
                              'effective_from'])}),
           ffill AS (SELECT t.pharmacy_fill_txn_hk, t.member_hk, t.drug_hk, d.ndc, t.pharmacy_hk, t.fill_date,
                        t.days_supply, t.effective_from FROM flt t LEFT JOIN ddrug d ON t.drug_hk = d.drug_hk)""",
}

# CTE dependencies: name -> (bronze views, CTE names in order)
_GDEP = {
    "fcp": (["pi_payment_transactions", "synpuf_inpatient_claim_header"], ["lpm", "ld", "satcl", "pay", "fcp"]),
    "fdrg": (["pi_payment_transactions", "synpuf_inpatient_claim_header", "drg_weights"],
             ["lpm", "ld", "satcl", "pay", "fcp", "ddrg", "fdrg"]),
    "fadj": (["pi_adjustment_transactions", "synpuf_inpatient_claim_header"], ["lpm", "adj", "fadj"]),
    "fcob": (["pi_cob_recovery_transactions", "synpuf_inpatient_claim_header"], ["lpm", "fcob"]),
    "fauth": (["pi_authorizations"], ["dauth", "fauth"]),
    "fapl": (["pi_appeals"], ["dapl", "fapl"]),
    "frs": (["ra_member_risk_scores"], ["frs"]),
    "ftier": (["ra_member_risk_scores"], ["frs", "ftier"]),
    "fhcc": (["ra_suspected_hcc", "ra_member_hcc"], ["fhcc"]),
    "fgap": (["ra_member_hcc"], ["fgap"]),
    "facc": (["ra_suspected_hcc", "ra_member_hcc", "ra_hcc_categories", "ra_member_risk_scores"],
             ["fhcc", "dhcc", "frs", "facc"]),
    "fenc": (["synthea_encounters"], ["fenc"]),
    "fread": (["synthea_encounters"], ["fenc", "fread"]),
    "fmeas": (["cq_member_measure_evals", "cq_measures"], ["dmeas", "fmeas"]),
    "ffill": (["pharmacy_fills", "ndc_products"], ["ddrug", "ffill"]),
}


def gwith(*facts: str, extra: str = "") -> str:
    bronzes: list[str] = []
    ctes: list[str] = []
    for f in facts:
        b, c = _GDEP[f]
        bronzes += [x for x in b if x not in bronzes]
        ctes += [x for x in c if x not in ctes]
    body = ",\n".join(G[c] for c in ctes)
    if extra:
        body += ",\n" + extra
    return with_bronze(*bronzes, extra=body)


oracle("d01_dim_member", with_bronze("synpuf_beneficiary_summary", "synthea_patients", extra=STG_MEMBERS) + f"""
SELECT {hk('member_bk')} AS member_hk, member_bk AS member_id, {dt('birth_date')} AS birth_date, sex, race_code,
       state_code, source_system FROM stg_members""")
oracle("d02_dim_provider", with_bronze("nppes_providers") + f"""
SELECT {hk('npi')} AS provider_hk, npi AS provider_npi, provider_first_name, provider_last_name, provider_credential,
       primary_taxonomy_code, practice_state, practice_city FROM nppes_providers""")
oracle("d03_dim_procedure", with_bronze("claims_wide") + f"""
SELECT DISTINCT {hk('code')} AS procedure_hk, code AS procedure_code, 'icd9_procedure' AS coding_system FROM (
  SELECT px_1 AS code FROM claims_wide UNION ALL SELECT px_2 FROM claims_wide) WHERE code IS NOT NULL AND trim(code) <> ''""")
oracle("d04_dim_drg", with_bronze("synpuf_inpatient_claim_header", "drg_weights", extra=G["ddrg"]) + """
SELECT drg_hk, drg_bk, drg_description, CAST(drg_relative_weight AS DOUBLE) AS drg_relative_weight FROM ddrg""")
oracle("d05_dim_drug", with_bronze("ndc_products", extra=G["ddrug"]) + "SELECT * FROM ddrug")
oracle("d06_dim_encounter", with_bronze("synthea_encounters") + f"""
SELECT {hk('encounter_bk')} AS encounter_hk, encounter_bk AS encounter_id, encounter_class_code,
       {ts('encounter_start')} AS encounter_start, {ts('encounter_end')} AS encounter_end FROM synthea_encounters""")
oracle("d07_dim_hcc_category", with_bronze("ra_hcc_categories", extra=G["dhcc"]) + """
SELECT hcc_hk, hcc_code, hcc_description, CAST(hcc_weight AS DOUBLE) AS hcc_weight FROM dhcc""")
oracle("d08_dim_measure", with_bronze("cq_measures", extra=G["dmeas"]) + """
SELECT measure_hk, measure_code, measure_name, CAST(measure_weight AS DOUBLE) AS measure_weight FROM dmeas""")
oracle("d09_dim_authorization", with_bronze("pi_authorizations", extra=G["dauth"]) + f"""
SELECT authorization_hk, authorization_bk, auth_status, {dt('requested_date')} AS requested_date FROM dauth""")
oracle("d10_dim_appeal", with_bronze("pi_appeals", extra=G["dapl"]) + """
SELECT appeal_hk, appeal_bk, appeal_status, appeal_reason FROM dapl""")

oracle("e01_fact_claim_payment", gwith("fcp") + f"""
SELECT payment_txn_hk, claim_line_hk, provider_hk, member_hk, drg_hk, CAST(billed_amount AS DOUBLE) AS billed_amount,
       CAST(allowed_amount AS DOUBLE) AS allowed_amount, CAST(paid_amount AS DOUBLE) AS paid_amount,
       CAST(leakage_amount AS DOUBLE) AS leakage_amount, {dt('payment_date')} AS payment_date,
       {dt('service_from_date')} AS service_from_date, {dt('admission_date')} AS admission_date FROM fcp""")
oracle("e02_fact_claim_adjustment", gwith("fadj") + f"""
SELECT adjustment_txn_hk, claim_line_hk, provider_hk, member_hk, CAST(adjustment_amount AS DOUBLE) AS adjustment_amount,
       adjustment_reason_code, {dt('adjustment_date')} AS adjustment_date FROM fadj""")
oracle("e03_fact_cob_recovery", gwith("fcob") + f"""
SELECT cob_recovery_txn_hk, claim_line_hk, member_hk, CAST(recovery_amount AS DOUBLE) AS recovery_amount,
       {dt('recovery_date')} AS recovery_date FROM fcob""")
oracle("e04_fact_drg_reimbursement_variance", gwith("fdrg") + """
SELECT payment_txn_hk, claim_line_hk, provider_hk, drg_hk, CAST(drg_relative_weight AS DOUBLE) AS drg_relative_weight,
       CAST(paid_amount AS DOUBLE) AS paid_amount, CAST(dollars_per_weight_unit AS DOUBLE) AS dollars_per_weight_unit,
       CAST(expected_paid_amount AS DOUBLE) AS expected_paid_amount,
       CAST(reimbursement_variance AS DOUBLE) AS reimbursement_variance FROM fdrg""")
oracle("e05_fact_authorization", gwith("fauth") + f"""
SELECT authorization_hk, claim_line_hk, auth_status, {dt('requested_date')} AS requested_date FROM fauth""")
oracle("e06_fact_appeal", gwith("fapl") + "SELECT * FROM fapl")
oracle("e07_fact_member_risk_score", gwith("frs") + f"""
SELECT member_risk_score_txn_hk, member_hk, risk_model_hk, CAST(raf_score AS DOUBLE) AS raf_score,
       CAST(model_year AS BIGINT) AS model_year, {dt('effective_from')} AS effective_from FROM frs""")
oracle("e08_fact_member_risk_tier", gwith("ftier") + """
SELECT member_risk_score_txn_hk, member_hk, risk_model_hk, CAST(raf_score AS DOUBLE) AS raf_score,
       CAST(model_year AS BIGINT) AS model_year, risk_tier FROM ftier""")
oracle("e09_fact_hcc_capture", gwith("fhcc") + """
SELECT hcc_capture_hk, member_hk, hcc_hk, CAST(is_suspected AS BIGINT) AS is_suspected,
       CAST(is_captured AS BIGINT) AS is_captured, CAST(is_captured_and_suspected AS BIGINT) AS is_captured_and_suspected
FROM fhcc""")
oracle("e10_fact_coding_gap", gwith("fgap") + f"""
SELECT member_hcc_hk, member_hk, hcc_hk, active_flag, {dt('coding_gap_identified_date')} AS coding_gap_identified_date,
       {dt('coding_gap_closed_date')} AS coding_gap_closed_date, CAST(is_gap_closed AS BIGINT) AS is_gap_closed
FROM fgap""")
oracle("e11_fact_risk_score_accuracy", gwith("facc") + """
SELECT member_hk, risk_model_hk, CAST(model_year AS BIGINT) AS model_year, CAST(actual_raf_score AS DOUBLE) AS actual_raf_score,
       CAST(suspected_raf_approx AS DOUBLE) AS suspected_raf_approx,
       CAST(raf_accuracy_variance AS DOUBLE) AS raf_accuracy_variance FROM facc""")
oracle("e12_fact_encounter", gwith("fenc") + f"""
SELECT encounter_hk, member_hk, provider_hk, facility_hk, encounter_class_code,
       {ts('encounter_start')} AS encounter_start, {ts('encounter_end')} AS encounter_end FROM fenc""")
oracle("e13_fact_readmission", gwith("fread") + f"""
SELECT index_encounter_hk, member_hk, {ts('index_admission_date')} AS index_admission_date,
       {ts('index_discharge_date')} AS index_discharge_date,
       {ts('next_admission_within_30_days')} AS next_admission_within_30_days,
       CAST(is_readmission AS BIGINT) AS is_readmission FROM fread""")
oracle("e14_fact_measure_evaluation", gwith("fmeas") + f"""
SELECT member_measure_eval_txn_hk, member_hk, measure_hk, measure_code, CAST(measure_weight AS DOUBLE) AS measure_weight,
       eval_result, {dt('eval_date')} AS eval_date, {dt('effective_from')} AS effective_from FROM fmeas""")
oracle("e15_fact_preventive_screening", gwith("fmeas") + f"""
SELECT member_measure_eval_txn_hk, member_hk, measure_hk, measure_code, eval_result, {dt('eval_date')} AS eval_date,
       CAST(CASE WHEN eval_result = 'met' THEN 1 ELSE 0 END AS BIGINT) AS is_completed
FROM fmeas WHERE measure_code IN ('BCS-E', 'COL-E')""")
oracle("e16_fact_care_gap", gwith("fmeas") + f"""
SELECT member_measure_eval_txn_hk, member_hk, measure_hk, measure_code, eval_result, {dt('eval_date')} AS eval_date
FROM fmeas WHERE eval_result <> 'met'""")
oracle("e17_fact_pharmacy_fill", gwith("ffill") + f"""
SELECT pharmacy_fill_txn_hk, member_hk, drug_hk, ndc, pharmacy_hk, {dt('fill_date')} AS fill_date,
       CAST(days_supply AS BIGINT) AS days_supply, {dt('effective_from')} AS effective_from FROM ffill""")
oracle("e18_fact_medication_adherence", gwith("ffill") + """
SELECT sha256(concat_ws('|', member_hk, drug_hk)) AS medication_adherence_hk, member_hk, drug_hk,
       CAST(least(raw, 365) AS BIGINT) AS days_covered, CAST(365 AS BIGINT) AS period_days, least(raw, 365) / 365 AS pdc
FROM (SELECT member_hk, drug_hk, sum(days_supply) AS raw FROM ffill GROUP BY member_hk, drug_hk)""")


# ---------------------------------------------------------------------------
# metrics
# ---------------------------------------------------------------------------
def mt(col: str, grain: str = "year") -> str:
    return f"CAST(CAST(date_trunc('{grain}', {col}) AS DATE) AS VARCHAR)"


def ratio(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0)"


oracle("m01_total_payment_leakage_by_year", gwith("fcp") + f"""
SELECT {mt('payment_date')} AS metric_time, CAST(sum(leakage_amount) AS DOUBLE) AS total_payment_leakage
FROM fcp GROUP BY 1""")
oracle("m03_leakage_by_provider", gwith("fcp") + """
SELECT provider_hk AS provider, CAST(sum(leakage_amount) AS DOUBLE) AS leakage_by_provider FROM fcp GROUP BY 1""")
oracle("m04_denial_rate_by_year", gwith("fadj") + f"""
SELECT {mt('adjustment_date')} AS metric_time,
       {ratio("sum(CASE WHEN adjustment_reason_code LIKE 'CO-%' THEN 1 ELSE 0 END)", 'count(adjustment_txn_hk)')}
         AS denial_rate
FROM fadj GROUP BY 1""")
oracle("m05_days_to_adjudication_by_year", gwith("fcp") + f"""
SELECT {mt('payment_date')} AS metric_time,
       CAST(sum(date_diff('day', service_from_date, payment_date)) AS DOUBLE)
         / count(date_diff('day', service_from_date, payment_date)) AS days_to_adjudication
FROM fcp GROUP BY 1""")
oracle("m06_yoy_leakage_trend", gwith("fcp", extra=f"""y AS (SELECT CAST(date_trunc('year', payment_date) AS DATE) AS t,
       sum(leakage_amount) AS v FROM fcp GROUP BY 1)""") + """
SELECT CAST(c.t AS VARCHAR) AS metric_time, CAST(c.v - p.v AS DOUBLE) AS yoy_leakage_trend
FROM y c LEFT JOIN y p ON c.t = CAST(p.t + INTERVAL 1 YEAR AS DATE)""")
oracle("m07_raf_score_by_year", gwith("frs") + f"""
SELECT {mt('effective_from')} AS metric_time, CAST(sum(raf_score) AS DOUBLE) / count(raf_score) AS raf_score
FROM frs GROUP BY 1""")
oracle("m08_yoy_raf_score_trend", gwith("frs", extra="""y AS (SELECT CAST(date_trunc('year', effective_from) AS DATE) AS t,
       CAST(sum(raf_score) AS DOUBLE) / count(raf_score) AS v FROM frs GROUP BY 1)""") + """
SELECT CAST(c.t AS VARCHAR) AS metric_time, c.v - p.v AS yoy_raf_score_trend
FROM y c LEFT JOIN y p ON c.t = CAST(p.t + INTERVAL 1 YEAR AS DATE)""")
oracle("m09_measure_compliance_by_measure", gwith("fmeas") + f"""
SELECT measure_code, {ratio("sum(CASE WHEN eval_result = 'met' THEN 1 ELSE 0 END)", 'count(member_measure_eval_txn_hk)')}
  AS hedis_style_measure_compliance_rate FROM fmeas GROUP BY 1""")
oracle("m10_star_rating_composite_by_quarter", gwith("fmeas") + f"""
SELECT {mt('effective_from', 'quarter')} AS metric_time,
       {ratio("sum(CASE WHEN eval_result = 'met' THEN measure_weight ELSE 0 END)", 'sum(measure_weight)')}
         AS star_rating_composite_score FROM fmeas GROUP BY 1""")
oracle("m13_ed_utilization_rate_by_year", gwith("fenc") + f"""
SELECT metric_time, ed_encounters, distinct_members, (ed_encounters / distinct_members) * 1000 AS ed_utilization_rate
FROM (SELECT {mt('encounter_start')} AS metric_time,
             CAST(sum(CASE WHEN encounter_class_code = 'EMER' THEN 1 ELSE 0 END) AS BIGINT) AS ed_encounters,
             count(DISTINCT member_hk) AS distinct_members FROM fenc GROUP BY 1)""")
oracle("m11_ed_encounters_by_quarter", gwith("fenc") + f"""
SELECT {mt('encounter_start', 'quarter')} AS metric_time,
       CAST(sum(CASE WHEN encounter_class_code = 'EMER' THEN 1 ELSE 0 END) AS BIGINT) AS ed_encounters
FROM fenc GROUP BY 1""")
oracle("m12_distinct_members_by_encounter_class", gwith("fenc") + """
SELECT encounter_class_code, count(DISTINCT member_hk) AS distinct_members FROM fenc GROUP BY 1""")
oracle("m14_medication_adherence_pdc", gwith("ffill", extra="""ma AS (SELECT least(sum(days_supply), 365) AS dc, 365 AS pd
       FROM ffill GROUP BY member_hk, drug_hk)""") + f"""
SELECT {ratio('sum(dc)', 'sum(pd)')} AS medication_adherence_pdc FROM ma""")
oracle("m15_drg_reimbursement_variance_by_drg", gwith("fdrg") + """
SELECT drg_hk AS drg, CAST(sum(reimbursement_variance) AS DOUBLE) AS drg_reimbursement_variance FROM fdrg GROUP BY 1""")
oracle("m16_cob_recovery_by_month", gwith("fcob") + f"""
SELECT {mt('recovery_date', 'month')} AS metric_time, CAST(sum(recovery_amount) AS DOUBLE) AS cob_tpl_recovery_amount
FROM fcob GROUP BY 1""")
oracle("m17_prior_auth_approval_rate_by_year", gwith("fauth") + f"""
SELECT {mt('requested_date')} AS metric_time,
       {ratio("sum(CASE WHEN auth_status = 'approved' THEN 1 ELSE 0 END)", 'count(authorization_hk)')}
         AS prior_authorization_approval_rate FROM fauth GROUP BY 1""")
oracle("m18_appeal_overturn_rate", gwith("fapl") + f"""
SELECT {ratio("sum(CASE WHEN appeal_status = 'overturned' THEN 1 ELSE 0 END)", 'count(appeal_hk)')}
  AS appeal_overturn_rate FROM fapl""")
oracle("m19_hcc_capture_rate", gwith("fhcc") + f"""
SELECT {ratio('sum(is_captured_and_suspected)', 'sum(is_suspected)')} AS hcc_capture_rate FROM fhcc""")
oracle("m20_coding_gap_closure_rate_by_year", gwith("fgap") + f"""
SELECT {mt('coding_gap_identified_date')} AS metric_time, {ratio('sum(is_gap_closed)', 'count(member_hcc_hk)')}
  AS coding_gap_closure_rate FROM fgap GROUP BY 1""")
oracle("m21_risk_score_accuracy", gwith("facc") + f"""
SELECT {ratio('sum(actual_raf_score)', 'sum(suspected_raf_approx)')} AS risk_score_accuracy FROM facc""")
oracle("m22_suspecting_yield_by_member", gwith("fhcc") + f"""
SELECT member_hk AS member, {ratio('sum(is_captured_and_suspected)', 'sum(is_suspected)')} AS suspecting_yield_rate
FROM fhcc GROUP BY 1""")
oracle("m23_member_risk_tier_distribution", gwith("ftier") + """
SELECT risk_tier, count(member_risk_score_txn_hk) AS member_risk_tier_distribution FROM ftier GROUP BY 1""")
oracle("m24_readmission_rate_by_year", gwith("fread") + f"""
SELECT {mt('index_discharge_date')} AS metric_time, {ratio('sum(is_readmission)', 'count(index_encounter_hk)')}
  AS readmission_rate FROM fread GROUP BY 1""")
oracle("m25_screening_completion_by_measure", gwith("fmeas") + f"""
SELECT measure_code, {ratio("sum(CASE WHEN eval_result = 'met' THEN 1 ELSE 0 END)", 'count(member_measure_eval_txn_hk)')}
  AS preventive_screening_completion_rate FROM fmeas WHERE measure_code IN ('BCS-E', 'COL-E') GROUP BY 1""")
oracle("m26_care_gap_count_by_member", gwith("fmeas") + """
SELECT member_hk AS member, count(member_measure_eval_txn_hk) AS care_gap_count FROM fmeas
WHERE eval_result <> 'met' GROUP BY 1""")
oracle("f12_multi_metric_by_year", gwith("fcp", "fadj", "fcob", extra=f"""
  a AS (SELECT {mt('payment_date')} AS t, {ratio('sum(leakage_amount)', 'sum(billed_amount)')} AS r FROM fcp GROUP BY 1),
  b AS (SELECT {mt('adjustment_date')} AS t,
               {ratio("sum(CASE WHEN adjustment_reason_code LIKE 'CO-%' THEN 1 ELSE 0 END)", 'count(adjustment_txn_hk)')}
               AS r FROM fadj GROUP BY 1),
  c AS (SELECT {mt('recovery_date')} AS t, CAST(sum(recovery_amount) AS DOUBLE) AS r FROM fcob GROUP BY 1)""") + """
SELECT coalesce(a.t, b.t, c.t) AS metric_time, a.r AS payment_leakage_rate, b.r AS denial_rate,
       c.r AS cob_tpl_recovery_amount
FROM a FULL OUTER JOIN b ON a.t IS NOT DISTINCT FROM b.t
FULL OUTER JOIN c ON coalesce(a.t, b.t) IS NOT DISTINCT FROM c.t""")
oracle("f10_leakage_by_week", gwith("fcp") + f"""
SELECT {mt('payment_date', 'week')} AS metric_time, CAST(sum(leakage_amount) AS DOUBLE) AS total_payment_leakage
FROM fcp GROUP BY 1""")


# ---------------------------------------------------------------------------
# governance and data quality
# ---------------------------------------------------------------------------
from vaultmart.operators.governance import REGION_STATES  # noqa: E402
from vaultmart.plans.oracle_vault import vault_table_sql  # noqa: E402
from vaultmart.plans.registry import BY_NAME  # noqa: E402


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


oracle("g01_governed_dim_provider_south", with_bronze("nppes_providers") + f"""
SELECT {hk('npi')} AS provider_hk, npi AS provider_npi, left(provider_first_name, 1) || '.' AS provider_first_name,
       left(provider_last_name, 1) || '.' AS provider_last_name, provider_credential, primary_taxonomy_code,
       practice_state, practice_city FROM nppes_providers
WHERE practice_state IN {_in(REGION_STATES['regional_manager_south'])}""")
oracle("g02_governed_dim_member_masked", with_bronze("synpuf_beneficiary_summary", "synthea_patients",
                                                     extra=STG_MEMBERS) + f"""
SELECT {hk('member_bk')} AS member_hk, member_bk AS member_id,
       CAST(CAST(date_trunc('year', birth_date) AS DATE) AS VARCHAR) AS birth_date, sex, 'WITHHELD' AS race_code,
       state_code, source_system FROM stg_members""")
oracle("g03_dim_member_phi_reviewer", ORACLE["d01_dim_member"])
oracle("g06_governed_fact_claim_payment_west", gwith("fcp", extra=f"nppes_providers AS ({_B['nppes_providers']})") + f"""
SELECT provider_hk, count(*) AS payments, CAST(sum(leakage_amount) AS DOUBLE) AS leakage FROM fcp
WHERE provider_hk IN (SELECT {hk('npi')} FROM nppes_providers
                      WHERE practice_state IN {_in(REGION_STATES['regional_manager_west'])})
GROUP BY provider_hk""")

_QV = {
    "hub_claim_line": f"SELECT DISTINCT {hk('claim_line_bk')} AS claim_line_hk, claim_line_bk FROM synpuf_inpatient_claim_header",
    "hub_provider": f"SELECT DISTINCT {hk('npi')} AS provider_hk, npi AS provider_bk FROM nppes_providers",
    "hub_member": f"SELECT DISTINCT {hk('member_bk')} AS member_hk, member_bk FROM stg_members",
    "hub_encounter": f"SELECT DISTINCT {hk('encounter_bk')} AS encounter_hk, encounter_bk FROM synthea_encounters",
    "lnk_claim_provider_member": f"""SELECT DISTINCT {hk('claim_line_bk', 'provider_bk', 'member_bk')} AS claim_provider_member_hk,
        claim_line_hk, provider_hk, member_hk FROM (SELECT *, {hk('claim_line_bk')} AS claim_line_hk,
        {hk('provider_bk')} AS provider_hk, {hk('member_bk')} AS member_hk FROM synpuf_inpatient_claim_header)
        WHERE claim_line_hk IS NOT NULL AND provider_hk IS NOT NULL AND member_hk IS NOT NULL""",
    "tlnk_claim_payment_txn": f"""SELECT {hk('txn_bk')} AS payment_txn_hk, {hk('claim_line_bk')} AS claim_line_hk
        FROM pi_payment_transactions""",
    "lnk_encounter_provider": f"""SELECT DISTINCT {hk('encounter_bk', 'provider_reference')} AS encounter_provider_hk,
        {hk('encounter_bk')} AS encounter_hk, {hk('provider_reference')} AS provider_hk FROM synthea_encounters
        WHERE {nn('encounter_bk')} AND {nn('provider_reference')}""",
    "lnk_member_encounter": f"""SELECT DISTINCT {hk('member_reference', 'encounter_bk')} AS member_encounter_hk,
        {hk('member_reference')} AS member_hk, {hk('encounter_bk')} AS encounter_hk FROM synthea_encounters
        WHERE {nn('encounter_bk')} AND {nn('member_reference')}""",
    "lnk_encounter_facility": f"""SELECT DISTINCT {hk('encounter_bk', 'facility_reference')} AS encounter_facility_hk,
        {hk('encounter_bk')} AS encounter_hk, {hk('facility_reference')} AS facility_hk FROM synthea_encounters
        WHERE {nn('encounter_bk')} AND {nn('facility_reference')}""",
    "sat_encounter_details": f"""SELECT {hk('encounter_bk')} AS encounter_hk,
        {hd(['encounter_class_code', 'encounter_start', 'encounter_end'])} AS encounter_hashdiff FROM synthea_encounters""",
    "sat_claim_details": f"""SELECT {hk('claim_line_bk')} AS claim_line_hk, 'x' AS claim_hashdiff
        FROM synpuf_inpatient_claim_header""",
}


def _check_sql(c) -> str:
    head = f"SELECT '{c.table}' AS \"table\", '{{chk}}' AS \"check\", '{c.column}' AS \"column\", CAST(({{cnt}}) AS BIGINT) AS failures"
    t = f"q_{c.table}"
    if c.check == "not_null":
        cnt = f"SELECT count(*) FROM {t} WHERE {c.column} IS NULL"
        chk = "not_null"
    elif c.check == "unique":
        cnt = (f"SELECT count(*) FROM (SELECT {c.column} FROM {t} WHERE {c.column} IS NOT NULL "
               f"GROUP BY {c.column} HAVING count(*) > 1)")
        chk = "unique"
    elif c.check == "relationships":
        cnt = (f"SELECT count(*) FROM {t} x WHERE x.{c.column} IS NOT NULL AND NOT EXISTS "
               f"(SELECT 1 FROM q_{c.ref_table} r WHERE r.{c.ref_column} = x.{c.column})")
        chk = f"relationships:{c.ref_table}"
    else:
        cnt = f"SELECT count(*) FROM {t} WHERE {c.column} IS NOT NULL AND {c.column} NOT IN {_in(c.values)}"
        chk = "accepted_values"
    return head.format(chk=chk, cnt=cnt)


def quality_oracle(checks) -> str:
    # tables that are not restated above come from their registry row
    rest = {c.table: vault_table_sql(c.table) for c in checks if c.table not in _QV and c.table in BY_NAME}
    ctes = ",\n".join(f"q_{k} AS ({v})" for k, v in (_QV | rest).items())
    ctes += ",\nq_fact_encounter AS (SELECT * FROM fenc)"
    body = "\nUNION ALL\n".join(_check_sql(c) for c in checks)
    base = with_bronze("synpuf_inpatient_claim_header", "pi_payment_transactions", "nppes_providers",
                       "synpuf_beneficiary_summary", "synthea_patients", "synthea_encounters",
                       extra=STG_MEMBERS + ",\n" + G["fenc"] + ",\n" + ctes)
    return base + f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({body})"


def _register_quality():
    from vaultmart.plans.queries import quality_checks
    q = quality_oracle(quality_checks())
    oracle("h01_vault_quality_checks", q)
    oracle("h02_quality_triage", f"""
SELECT "table", "check", "column", failures, layer,
       CASE WHEN layer IN ('gold', 'semantic') THEN 'high' WHEN layer = 'vault' THEN 'medium' ELSE 'low' END AS severity,
       CASE WHEN layer IN ('gold', 'semantic', 'vault') THEN true ELSE false END AS notify
FROM (SELECT *, CASE WHEN regexp_matches("table", '^(hub|lnk|sat|tlnk)_') THEN 'vault'
                     WHEN regexp_matches("table", '^(dim|fact)_') THEN 'gold'
                     WHEN regexp_matches("table", '^stg_') THEN 'staging' ELSE 'other' END AS layer
      FROM ({q.replace('WITH ', 'WITH ', 1)})) WHERE status = 'fail'""")


_register_quality()


# ---------------------------------------------------------------------------
# operations jobs
# ---------------------------------------------------------------------------
from vaultmart.plans import ops as _ops  # noqa: E402
from vaultmart.sources.proxy import ops_sql  # noqa: E402

_O = ops_sql("duckdb")


def owith(*names: str, extra: str = "") -> str:
    parts = [f"{nm} AS ({_O[nm]})" for nm in names]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"


def _hour(col="timestamp_utc", unit="hour"):
    return f"date_trunc('{unit}', {col})"


oracle("i02_error_rate_alerts_hourly", owith("tool_call_events") + f"""
SELECT {ts('w')} AS window_start, {ts("w + INTERVAL 1 HOUR")} AS window_end, 'high_error_rate' AS rule,
       'P1' AS severity, calls, errors, errors / calls AS error_rate
FROM (SELECT {_hour()} AS w, count(*) AS calls, count(*) FILTER (WHERE status = 'error') AS errors
      FROM tool_call_events GROUP BY 1) WHERE errors / calls > 0.2""")
oracle("i03_repeated_call_alerts_daily", owith("tool_call_events") + f"""
SELECT {ts('w')} AS window_start, {ts("w + INTERVAL 1 DAY")} AS window_end, 'repeated_identical_calls' AS rule,
       'P2' AS severity, tool_name, tool_arguments, calls
FROM (SELECT {_hour(unit='day')} AS w, tool_name, tool_arguments, count(*) AS calls FROM tool_call_events
      GROUP BY 1, 2, 3) WHERE calls >= 5""")
P99 = f"""p AS (SELECT w, max(CASE WHEN rn = greatest(CAST(ceil(0.99 * n) AS BIGINT), 1) THEN latency_ms END) AS p99,
             max(n) AS calls
       FROM (SELECT {_hour()} AS w, latency_ms,
                    row_number() OVER (PARTITION BY {_hour()} ORDER BY latency_ms) AS rn,
                    count(*) OVER (PARTITION BY {_hour()}) AS n FROM tool_call_events) GROUP BY w)"""
oracle("i04_latency_p99_alerts_hourly", owith("tool_call_events", extra=P99) + f"""
SELECT {ts('w')} AS window_start, {ts("w + INTERVAL 1 HOUR")} AS window_end, 'latency_spike' AS rule, 'P2' AS severity,
       CAST(p99 AS BIGINT) AS p99_latency_ms, calls FROM p WHERE p99 > 5000""")
oracle("i05_alert_table_hourly", owith("tool_call_events", extra=P99 + f""",
  e AS (SELECT w, count(*) AS calls, count(*) FILTER (WHERE status = 'error') AS errors FROM
        (SELECT {_hour()} AS w, status FROM tool_call_events) GROUP BY 1),
  r AS (SELECT {_hour()} AS w, tool_name, count(*) AS calls FROM tool_call_events
        GROUP BY {_hour()}, tool_name, tool_arguments),
  u AS (SELECT w, 'high_error_rate' AS rule, 'P1' AS severity, printf('errors=%d calls=%d', errors, calls) AS detail
        FROM e WHERE errors / calls > 0.2
        UNION ALL SELECT w, 'repeated_identical_calls', 'P2', printf('tool=%s calls=%d', tool_name, calls)
        FROM r WHERE calls >= 5
        UNION ALL SELECT w, 'latency_spike', 'P2', printf('p99_ms=%d calls=%d', CAST(p99 AS BIGINT), calls)
        FROM p WHERE p99 > 5000)""") + f"""
SELECT md5(concat_ws('|', rule, {ts('w')}, detail)) AS alert_id, {ts('w')} AS triggered_at_utc, rule, severity, detail
FROM u""")

RATES = ", ".join(f"('{m}', CAST({i} AS DECIMAL(10,6)), CAST({o} AS DECIMAL(10,6)))"
                  for m, (i, o) in sorted(_ops.DEFAULT_MODEL_RATES.items()))
COST = f"""rates AS (SELECT * FROM (VALUES {RATES}) t(model_name, input_rate, output_rate)),
  priced AS (SELECT c.*, CAST(round(CAST(input_tokens AS DECIMAL(18,0)) * input_rate * CAST(0.001 AS DECIMAL(4,3))
                    + CAST(output_tokens AS DECIMAL(18,0)) * output_rate * CAST(0.001 AS DECIMAL(4,3)), 6)
                    AS DECIMAL(18,6)) AS cost_dollars
             FROM agent_cost_events c JOIN rates r ON c.model_name = r.model_name)"""
oracle("i06_call_cost", owith("agent_cost_events", extra=COST) + f"""
SELECT event_id, {ts('timestamp_utc')} AS timestamp_utc, session_id, feature_tag, model_name,
       CAST(input_tokens AS BIGINT) AS input_tokens, CAST(output_tokens AS BIGINT) AS output_tokens,
       CAST(cost_dollars AS DOUBLE) AS cost_dollars FROM priced""")
oracle("i06_unpriced_calls_by_model", owith("agent_cost_events", extra=COST) + """
SELECT model_name, count(*) AS calls FROM agent_cost_events WHERE model_name NOT IN (SELECT model_name FROM rates)
GROUP BY 1""")
oracle("i07_daily_cost_by_feature", owith("agent_cost_events", extra=COST) + """
SELECT CAST(CAST(timestamp_utc AS DATE) AS VARCHAR) AS usage_date, feature_tag, model_name,
       CAST(sum(input_tokens) AS BIGINT) AS total_input_tokens, CAST(sum(output_tokens) AS BIGINT) AS total_output_tokens,
       CAST(round(sum(cost_dollars), 2) AS DOUBLE) AS total_cost_dollars
FROM priced WHERE timestamp_utc >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 30 DAY GROUP BY 1, 2, 3""")

PRICES = ", ".join(f"('{s}', TIMESTAMP '{a} 00:00:00', " + (f"TIMESTAMP '{b} 00:00:00'" if b else "CAST(NULL AS TIMESTAMP)")
                   + f", CAST({p} AS DECIMAL(10,4)))" for s, a, b, p in _ops.LIST_PRICES)
USAGE = f"""prices AS (SELECT * FROM (VALUES {PRICES}) t(sku_name, price_start_time, price_end_time, price)),
  usage AS (SELECT CAST(l_shipdate AS DATE) AS usage_date, 'SKU-' || l_returnflag AS sku_name,
                   CAST(l_quantity AS DECIMAL(18,2)) AS usage_quantity,
                   CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE 'proj-' || CAST(l_suppkey % 4 AS VARCHAR) END AS project_tag,
                   'team-' || CAST(l_partkey % 3 AS VARCHAR) AS team_tag,
                   CASE WHEN l_linestatus = 'F' THEN 'prod' ELSE 'dev' END AS environment_tag,
                   CAST(l_orderkey % 10 AS VARCHAR) AS workspace_id, 'c-' || CAST(l_suppkey % 20 AS VARCHAR) AS cluster_id,
                   CAST(l_orderkey AS VARCHAR) AS job_id FROM lineitem),
  pu AS (SELECT u.usage_date, u.sku_name, u.usage_quantity AS dbus_consumed, p.price AS price_per_dbu,
                u.usage_quantity * p.price AS dollar_cost, u.project_tag, u.team_tag, u.environment_tag,
                u.workspace_id, u.cluster_id, u.job_id
         FROM usage u JOIN prices p ON u.sku_name = p.sku_name AND CAST(u.usage_date AS TIMESTAMP) >= p.price_start_time
              AND (p.price_end_time IS NULL OR CAST(u.usage_date AS TIMESTAMP) < p.price_end_time))"""
oracle("i08_priced_usage", "WITH " + USAGE + f"""
SELECT {dt('usage_date')} AS usage_date, sku_name, CAST(dbus_consumed AS DOUBLE) AS dbus_consumed,
       CAST(price_per_dbu AS DOUBLE) AS price_per_dbu, CAST(dollar_cost AS DOUBLE) AS dollar_cost, project_tag, team_tag,
       environment_tag, workspace_id, cluster_id, job_id FROM pu""")
oracle("i09_chargeback", "WITH " + USAGE + f"""
SELECT {dt('usage_date')} AS usage_date, coalesce(project_tag, 'untagged') AS project,
       coalesce(team_tag, 'untagged') AS team, coalesce(environment_tag, 'untagged') AS environment, sku_name,
       CAST(round(sum(dbus_consumed), 2) AS DOUBLE) AS total_dbus,
       CAST(round(sum(dollar_cost), 2) AS DOUBLE) AS total_cost_dollars
FROM pu GROUP BY 1, 2, 3, 4, 5""")
oracle("i10_untagged_spend", "WITH " + USAGE + f"""
SELECT {dt('usage_date')} AS usage_date, sku_name, CAST(round(sum(dollar_cost), 2) AS DOUBLE) AS untagged_cost_dollars
FROM pu WHERE project_tag IS NULL GROUP BY 1, 2""")
oracle("i11_behaviour_and_cost", owith("tool_call_events", "agent_cost_events", extra=COST) + """
SELECT a.tool_name, a.status, count(*) AS calls, CAST(sum(p.cost_dollars) AS DOUBLE) AS cost_dollars
FROM tool_call_events a JOIN priced p ON a.event_id = p.event_id GROUP BY 1, 2""")

_RATE_ROWS = ", ".join(f"('{k}', {int(round(v * 1000))})" for k, v in _ops.PROVIDER_RATES_PER_1K_TOKENS.items())
_BUDGET_ROWS = ", ".join(f"('{k}', {int(round(v * 1_000_000))})" for k, v in _ops.DAILY_BUDGET_USD_BY_FEATURE.items())
ADMISSION = f"""rates AS (SELECT * FROM (VALUES {_RATE_ROWS}) t(provider, rate_micro)),
  budgets AS (SELECT * FROM (VALUES {_BUDGET_ROWS}) t(feature, budget_micro)),
  req AS (SELECT g.request_id, g.feature, CAST(g.timestamp_utc AS DATE) AS usage_date, b.budget_micro,
                 CAST((g.prompt_tokens + g.max_completion_tokens) * r.rate_micro AS BIGINT) AS proj,
                 CAST((g.prompt_tokens + g.completion_tokens) * r.rate_micro AS BIGINT) AS act,
                 row_number() OVER (PARTITION BY g.feature, CAST(g.timestamp_utc AS DATE)
                                    ORDER BY g.timestamp_utc, g.request_seq) AS rn
          FROM gateway_requests g JOIN rates r ON g.provider = r.provider LEFT JOIN budgets b ON g.feature = b.feature),
  unpriced AS (SELECT request_id, feature, CAST(timestamp_utc AS DATE) AS usage_date FROM gateway_requests
               WHERE provider NOT IN (SELECT provider FROM rates)),
  led AS (
    SELECT feature, usage_date, rn, request_id, proj, act, budget_micro,
           (budget_micro IS NULL OR proj <= budget_micro) AS admitted,
           CASE WHEN budget_micro IS NULL OR proj <= budget_micro THEN act ELSE 0 END AS spent
    FROM req WHERE rn = 1
    UNION ALL
    SELECT q.feature, q.usage_date, q.rn, q.request_id, q.proj, q.act, q.budget_micro,
           (q.budget_micro IS NULL OR l.spent + q.proj <= q.budget_micro),
           l.spent + CASE WHEN q.budget_micro IS NULL OR l.spent + q.proj <= q.budget_micro THEN q.act ELSE 0 END
    FROM led l JOIN req q ON q.feature = l.feature AND q.usage_date = l.usage_date AND q.rn = l.rn + 1)"""
_LEDGER = owith("gateway_requests", extra=ADMISSION).replace("WITH ", "WITH RECURSIVE ", 1)
oracle("i12_budget_admission", _LEDGER + f"""
SELECT request_id, feature, {dt('usage_date')} AS usage_date, admitted, proj AS projected_micro,
       CASE WHEN admitted THEN act ELSE 0 END AS booked_micro, spent AS spent_after_micro,
       CASE WHEN admitted THEN 'admitted' ELSE 'over_budget' END AS decision FROM led
UNION ALL
SELECT request_id, feature, {dt('usage_date')}, false, NULL, 0, NULL, 'unknown_provider' FROM unpriced""")
oracle("i13_spend_by_feature", _LEDGER + f"""
SELECT feature, {dt('usage_date')} AS usage_date, CAST(sum(booked) AS DOUBLE) / 1000000 AS spend_usd,
       count(*) FILTER (WHERE admitted) AS admitted, count(*) FILTER (WHERE NOT admitted) AS refused
FROM (SELECT feature, usage_date, admitted, CASE WHEN admitted THEN act ELSE 0 END AS booked FROM led
      UNION ALL SELECT feature, usage_date, false, 0 FROM unpriced) GROUP BY 1, 2""")

_MARK = " ".join(f"WHEN contains(lower(text), '{m}') THEN '{m}'" for m in _ops.DENIED_CONTENT_MARKERS)
oracle("i14_content_policy_conversations", owith("policy_turns") + f"""
SELECT conv_id, turn, CASE {_MARK} END AS denied_marker, (CASE {_MARK} END) IS NOT NULL AS blocked FROM policy_turns""")

_INJ = " ".join(f"WHEN regexp_matches(lower(text), '{p}') THEN '{p}'" for p in _ops.PROMPT_INJECTION_PATTERNS)
_r = "text"
_hits = []
for _label, _p in _ops.SENSITIVE_DATA_PATTERNS:
    _hits.append(f"CASE WHEN regexp_matches({_r}, '{_p}') THEN '{_label}' END")
    _r = f"regexp_replace({_r}, '{_p}', '[REDACTED_{_label.upper()}]', 'g')"
oracle("i15_screen_documents", owith("screened_documents") + f"""
SELECT doc_id, action, matched_pattern, CASE WHEN action = 'block' THEN '' ELSE kinds END AS redacted_kinds,
       md5(CASE WHEN action = 'redact' THEN red ELSE text END) AS processed_md5,
       CAST(length(CASE WHEN action = 'redact' THEN red ELSE text END) AS BIGINT) AS processed_length
FROM (SELECT doc_id, text, inj AS matched_pattern, red, kinds,
             CASE WHEN inj IS NOT NULL THEN 'block' WHEN kinds <> '' THEN 'redact' ELSE 'allow' END AS action
      FROM (SELECT doc_id, text, CASE {_INJ} END AS inj, {_r} AS red,
                   concat_ws(',', {', '.join(_hits)}) AS kinds FROM screened_documents))""")

_SYN = ", ".join(f"({i}, '{m.name}', {j}, '{s}')" for i, m in enumerate(_ops.METRICS) for j, s in enumerate(m.synonyms))
oracle("i17_resolve_metric_conversations", owith("metric_questions") + f""",
syn AS (SELECT * FROM (VALUES {_SYN}) t(metric_order, metric, synonym_order, synonym)),
q AS (SELECT conv_id, turn, lower(text) AS lq FROM metric_questions),
m AS (SELECT q.conv_id, q.turn, s.metric, s.synonym,
             row_number() OVER (PARTITION BY q.conv_id, q.turn ORDER BY length(s.synonym) DESC, s.metric_order,
                                s.synonym_order) AS rn
      FROM q JOIN syn s ON contains(q.lq, lower(s.synonym)))
SELECT q.conv_id, q.turn, CASE WHEN (q.conv_id + q.turn) % 11 = 0 THEN 'unlisted_metric' ELSE m.metric END AS resolved_metric,
       m.synonym AS matched_synonym, CASE WHEN (q.conv_id + q.turn) % 11 = 0 THEN 'block' ELSE 'allow' END AS validation
FROM q LEFT JOIN (SELECT * FROM m WHERE rn = 1) m ON q.conv_id = m.conv_id AND q.turn = m.turn""")

oracle("i17_resolved_metrics", owith("metric_questions") + f""",
syn AS (SELECT * FROM (VALUES {_SYN}) t(metric_order, metric, synonym_order, synonym)),
m AS (SELECT q.conv_id, q.turn, s.metric, s.synonym,
             row_number() OVER (PARTITION BY q.conv_id, q.turn ORDER BY length(s.synonym) DESC, s.metric_order,
                                s.synonym_order) AS rn
      FROM metric_questions q JOIN syn s ON contains(lower(q.text), lower(s.synonym)))
SELECT q.conv_id, q.turn, m.metric AS resolved_metric, m.synonym AS matched_synonym,
       CASE WHEN (q.conv_id + q.turn) % 11 = 0 THEN 'unlisted_metric' ELSE m.metric END AS proposed_metric,
       CASE WHEN (q.conv_id + q.turn) % 11 = 0 THEN 'block' ELSE 'allow' END AS validation
FROM metric_questions q LEFT JOIN (SELECT * FROM m WHERE rn = 1) m ON q.conv_id = m.conv_id AND q.turn = m.turn""")

oracle("i20_delegation_chains", owith("delegation_tokens").replace("WITH ", "WITH RECURSIVE ", 1) + """,
chain(token_id, ancestor_id, hops) AS (
  SELECT token_id, token_id, 0 FROM delegation_tokens
  UNION ALL
  SELECT c.token_id, t.parent_token_id, c.hops + 1 FROM chain c JOIN delegation_tokens t ON c.ancestor_id = t.token_id
  WHERE t.parent_token_id IS NOT NULL)
SELECT token_id, CAST(max(hops) AS BIGINT) AS depth, arg_max(ancestor_id, hops) AS root_token_id FROM chain
GROUP BY token_id""")

oracle("i21_scope_escalations", owith("delegation_tokens", extra="""
  perms AS (SELECT token_id, 'gold.' || scope_schema || ':read' AS p FROM delegation_tokens
            UNION ALL SELECT token_id, 'gold.' || scope_schema || ':write' FROM delegation_tokens WHERE can_write),
  ex AS (SELECT c.token_id, c.p FROM delegation_tokens t JOIN perms c ON c.token_id = t.token_id
         WHERE t.parent_token_id IS NOT NULL
           AND NOT EXISTS (SELECT 1 FROM perms pp WHERE pp.token_id = t.parent_token_id AND pp.p = c.p))""") + """
SELECT t.token_id, t.parent_token_id, coalesce(string_agg(DISTINCT ex.p, ',' ORDER BY ex.p), '') AS excess,
       count(ex.p) > 0 AS refused
FROM delegation_tokens t LEFT JOIN ex ON t.token_id = ex.token_id WHERE t.parent_token_id IS NOT NULL
GROUP BY t.token_id, t.parent_token_id""")

oracle("i22_approval_status", owith("approval_requests") + f"""
SELECT request_id, risk_tier, status, sla_minutes, {ts('due')} AS due_at, coalesce(overdue, false) AS overdue,
       CASE WHEN overdue AND risk_tier = 'tier_4' THEN 'P1' WHEN overdue THEN 'P2' END AS escalation
FROM (SELECT *, CASE WHEN risk_tier IN ('tier_1', 'tier_2') THEN 'auto_approved' ELSE 'pending' END AS status,
             timestamp_utc + to_minutes(sla_minutes) AS due,
             risk_tier NOT IN ('tier_1', 'tier_2') AND TIMESTAMP '2024-01-31 00:00:00' > timestamp_utc + to_minutes(sla_minutes)
               AS overdue
      FROM (SELECT *, CAST(CASE risk_tier WHEN 'tier_3' THEN 60 WHEN 'tier_4' THEN 15 END AS BIGINT) AS sla_minutes
            FROM approval_requests))""")

# streaming: a bounded run closes its last windows, so streams equal the batch rules
oracle("i01_stream_error_rate_hourly", ORACLE["i02_error_rate_alerts_hourly"])
oracle("i03_stream_repeated_calls_daily", ORACLE["i03_repeated_call_alerts_daily"])
oracle("i04_stream_latency_hourly", ORACLE["i04_latency_p99_alerts_hourly"])

# the last 30 days before a given day
for _name in ("i08_priced_usage", "i09_chargeback", "i10_untagged_spend"):
    _head, _from, _tail = ORACLE[_name].rpartition("FROM pu")
    _recent = "usage_date >= DATE '2001-06-30' - 30"
    _tail = _tail.replace(" WHERE", f" WHERE {_recent} AND", 1) if " WHERE" in _tail else f" WHERE {_recent}{_tail}"
    oracle(f"{_name}_30_days", _head + _from + _tail)


# more staging models, top-k report
oracle("b05_stg_claim_lines", with_bronze("synpuf_inpatient_claim_header") + f"""
SELECT claim_line_bk, member_bk, provider_bk, {dt('service_from_date')} AS service_from_date,
       {dt('service_thru_date')} AS service_thru_date, {dt('admission_date')} AS admission_date,
       {dt('discharge_date')} AS discharge_date, drg_bk, CAST(paid_amount AS DOUBLE) AS paid_amount,
       CAST(primary_payer_paid_amount AS DOUBLE) AS primary_payer_paid_amount,
       CAST(utilization_day_count AS BIGINT) AS utilization_day_count, 'inpatient' AS claim_type, record_source,
       {ts('load_dts')} AS load_dts FROM synpuf_inpatient_claim_header""")
oracle("b09_stg_providers", with_bronze("nppes_providers") + f"""
SELECT npi AS provider_bk, provider_first_name, provider_last_name, provider_credential, primary_taxonomy_code,
       practice_state, practice_city, record_source, {ts('load_dts')} AS load_dts FROM nppes_providers""")
oracle("b13_stg_encounters", with_bronze("synthea_encounters") + f"""
SELECT encounter_bk, member_reference AS member_bk, provider_reference AS provider_bk,
       facility_reference AS facility_bk, encounter_status, encounter_class_code, encounter_type_text,
       {ts('encounter_start')} AS encounter_start, {ts('encounter_end')} AS encounter_end, record_source,
       {ts('load_dts')} AS load_dts FROM synthea_encounters""")
oracle("b14_stg_encounter_diagnoses", with_bronze("synthea_conditions") + f"""
SELECT encounter_reference AS encounter_bk, diagnosis_bk, diagnosis_description, clinical_status_code,
       {dt('onset_date')} AS onset_date, record_source, {ts('load_dts')} AS load_dts
FROM synthea_conditions WHERE encounter_reference IS NOT NULL""")
oracle("b17_stg_authorizations", with_bronze("pi_authorizations") + f"""
SELECT authorization_bk, claim_line_bk, auth_status, {dt('requested_date')} AS requested_date, record_source,
       {ts('load_dts')} AS load_dts FROM pi_authorizations""")
oracle("b19_stg_payment_txns", with_bronze("pi_payment_transactions") + f"""
SELECT txn_bk, claim_line_bk, CAST(billed_amount AS DOUBLE) AS billed_amount,
       CAST(allowed_amount AS DOUBLE) AS allowed_amount, CAST(paid_amount AS DOUBLE) AS paid_amount,
       {dt('payment_date')} AS payment_date, record_source, {ts('load_dts')} AS load_dts FROM pi_payment_transactions""")
oracle("b25_stg_member_hcc", with_bronze("ra_member_hcc") + f"""
SELECT member_bk, hcc_bk, active_flag, {dt('coding_gap_identified_date')} AS coding_gap_identified_date,
       {dt('coding_gap_closed_date')} AS coding_gap_closed_date, record_source, {ts('load_dts')} AS load_dts
FROM ra_member_hcc""")
oracle("b27_stg_member_risk_scores", with_bronze("ra_member_risk_scores") + f"""
SELECT member_bk, risk_model_bk, CAST(raf_score AS DOUBLE) AS raf_score, CAST(model_year AS BIGINT) AS model_year,
       record_source, {ts('load_dts')} AS load_dts FROM ra_member_risk_scores""")
oracle("b30_stg_member_measure_evals", with_bronze("cq_member_measure_evals") + f"""
SELECT member_bk, measure_bk, eval_result, {dt('eval_date')} AS eval_date, record_source, {ts('load_dts')} AS load_dts
FROM cq_member_measure_evals""")
oracle("b31_stg_pharmacy_fills", with_bronze("pharmacy_fills") + f"""
SELECT member_bk, drug_bk, pharmacy_bk, {dt('fill_date')} AS fill_date, CAST(days_supply AS BIGINT) AS days_supply,
       record_source, {ts('load_dts')} AS load_dts FROM pharmacy_fills""")
oracle("f13_leakage_where_paid_since_1998", gwith("fcp") + f"""
SELECT {mt('payment_date')} AS metric_time, CAST(sum(leakage_amount) AS DOUBLE) AS total_payment_leakage
FROM fcp WHERE payment_date >= DATE '1998-01-01' GROUP BY 1""")
oracle("f13_top10_provider_leakage", gwith("fcp") + """
SELECT provider_hk AS provider, CAST(sum(leakage_amount) AS DOUBLE) AS leakage_by_provider FROM fcp
GROUP BY 1 ORDER BY sum(leakage_amount) DESC, provider LIMIT 10""")


# every staging model, hashed stage and vault table of the registry
from vaultmart.plans import oracle_vault as _OV  # noqa: E402
from vaultmart.plans import registry as _R  # noqa: E402

for _s in _OV.STG:
    if _OV.staging_query_name(_s) not in ORACLE:
        oracle(_OV.staging_query_name(_s), _OV.staging_sql(_s))
for _h in _R.HASHED_STAGES:
    oracle(_OV.hashed_query_name(_h.name), _OV.hashed_stage_sql(_h.name))
for _t in (*_R.HUBS, *_R.LINKS, *_R.SATELLITES, *_R.TLINKS):
    oracle(_OV.vault_query_name(_t.name), _OV.vault_table_sql(_t.name))


# landers over the raw-file-shaped proxies
from vaultmart.sources import ingest as _IG  # noqa: E402
from vaultmart.sources.proxy import raw_sql as _raw_sql  # noqa: E402

_RAW = _raw_sql("duckdb")


def _renamed(raw: str, mapping: dict, order: str = "") -> str:
    cols = ", ".join([*(f'"{s}" AS {t}' for s, t in mapping.items()), *([order] if order else [])])
    return f"raw AS ({_RAW[raw]}), r AS (SELECT {cols} FROM raw)"


_PROV = _renamed("nppes_raw", _IG.PROVIDER_COLUMN_MAP) + """,
  latest AS (SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY npi
               ORDER BY try_strptime(last_update_date, '%m/%d/%Y') DESC NULLS LAST) AS _rn FROM r) WHERE _rn = 1)"""
oracle("a01_land_providers_individuals", f"WITH {_PROV} SELECT * FROM latest WHERE entity_type_code = '1'")
oracle("a01_land_providers_organizations", f"WITH {_PROV} SELECT * FROM latest WHERE entity_type_code = '2'")
oracle("a13_landing_summary_providers", f"""WITH {_PROV}
SELECT 'nppes_raw' AS "table", 'input' AS kind, count(*) AS rows FROM raw
UNION ALL SELECT 'nppes_providers', 'landed', count(*) FROM latest WHERE entity_type_code = '1'
UNION ALL SELECT 'nppes_facilities', 'landed', count(*) FROM latest WHERE entity_type_code = '2'""")
oracle("a03_land_beneficiaries", f"""WITH {_renamed('bene_raw', _IG.BENEFICIARY_COLUMN_MAP, '_row_order')}
SELECT * EXCLUDE (_rn, _row_order) FROM (
  SELECT *, row_number() OVER (PARTITION BY member_bk ORDER BY _row_order DESC) AS _rn FROM r) WHERE _rn = 1""")
_HDR_REST = [c for c in _IG.CLAIM_HEADER_COLUMN_MAP.values() if c != "claim_line_bk"]
oracle("a04_land_claim_headers", f"""WITH {_renamed('claims_raw', _IG.CLAIM_HEADER_COLUMN_MAP, '_row_order')}
SELECT * EXCLUDE (_rn, _row_order) FROM (
  SELECT *, row_number() OVER (PARTITION BY claim_line_bk
                               ORDER BY _row_order, {', '.join(c + ' NULLS FIRST' for c in _HDR_REST)}) AS _rn FROM r)
WHERE _rn = 1""")
_PX = " UNION ALL ".join(f'SELECT "CLM_ID" AS claim_line_bk, "{c}" AS procedure_bk FROM raw'
                         for c in _IG.PROCEDURE_CODE_COLUMNS)
oracle("a04_land_claim_procedures", f"""WITH raw AS ({_RAW['claims_raw']})
SELECT DISTINCT claim_line_bk, procedure_bk FROM ({_PX}) u
WHERE procedure_bk IS NOT NULL AND trim(procedure_bk) <> ''""")

_ISO = "strftime({x}, '%Y-%m-%dT%H:%M:%S')"
oracle("a06_land_fhir_patients", """
SELECT 'C' || CAST(o_custkey AS VARCHAR) AS member_bk, '19' || lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0') || '-01-01'
         AS birth_date, CASE WHEN o_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS sex,
       CAST(NULL AS VARCHAR) AS death_date FROM orders""")
oracle("a06_land_fhir_encounters", f"""
SELECT 'E' || CAST(o_orderkey AS VARCHAR) AS encounter_bk, 'finished' AS encounter_status,
       CASE o_orderstatus WHEN 'F' THEN 'IMP' WHEN 'O' THEN 'EMER' ELSE 'AMB' END AS encounter_class_code,
       o_orderpriority AS encounter_type_text, 'C' || CAST(o_custkey AS VARCHAR) AS member_reference,
       {_ISO.format(x='o_orderdate')} AS encounter_start,
       {_ISO.format(x='o_orderdate + to_days(CAST(o_orderkey % 5 AS INTEGER))')} AS encounter_end,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'P' || CAST(o_orderkey % 31 AS VARCHAR) END AS provider_reference,
       'F' || CAST(o_custkey % 97 AS VARCHAR) AS facility_reference FROM orders""")
oracle("a06_land_fhir_conditions", f"""
SELECT 'CND-' || CAST(o_orderkey AS VARCHAR) AS condition_bk,
       CASE WHEN o_orderstatus = 'F' THEN 'resolved' ELSE 'active' END AS clinical_status_code,
       o_orderpriority AS diagnosis_bk, 'Priority ' || o_orderpriority AS diagnosis_description,
       'C' || CAST(o_custkey AS VARCHAR) AS member_reference, 'E' || CAST(o_orderkey AS VARCHAR) AS encounter_reference,
       {_ISO.format(x='o_orderdate')} AS onset_date FROM orders""")


def _crosswalk_oracle() -> str:
    from vaultmart.plans.queries import XWALK_TABLES, crosswalk_checks
    ctes = ",\n".join(f"q_{t} AS ({_OV.vault_table_sql(t)})" for t in XWALK_TABLES)
    body = "\nUNION ALL\n".join(_check_sql(c) for c in crosswalk_checks())
    return f"WITH {ctes}\nSELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({body})"


oracle("h03_crosswalk_resolves", _crosswalk_oracle())

# One availableNow micro-batch over the whole file equals the batch load
oracle("c09_stream_vault_claim_payment_txn", ORACLE["c07_tlnk_claim_payment_txn"])

# The landed stream holds the file's rows as text plus the record source
oracle("a14_stream_land_provider_file", f"WITH raw AS ({_RAW['nppes_raw']}) SELECT *, 'nppes' AS record_source FROM raw")

# Landed drug products (absent column -> NULL, names lower-cased) and
# packages whose product is missing
_PROD_COLS = ", ".join(("CAST(NULL AS VARCHAR)" if c == "DEASCHEDULE" else f'"{c}"') + f" AS {c.lower()}"
                       for c in _IG.DRUG_PRODUCT_COLUMNS)
_PACK_COLS = ", ".join(f'"{c}" AS {c.lower()}' for c in _IG.DRUG_PACKAGE_COLUMNS)
oracle("a08_land_drug_products", f"WITH f AS ({_RAW['ndc_product_file']}) SELECT {_PROD_COLS} FROM f")
oracle("a09_orphan_drug_packages", f"""WITH p AS ({_RAW['ndc_product_file']}), k AS ({_RAW['ndc_package_file']})
SELECT {_PACK_COLS} FROM k WHERE "PRODUCTNDC" NOT IN (SELECT "PRODUCTNDC" FROM p)""")

# Text CSV read with a fixed schema, typed by staging; lineage = table name + batch time
_REF_LD = "'2024-01-01 00:00:00' AS load_dts"
oracle("a15_reference_member_hcc_staged", with_bronze("ra_member_hcc") + f"""
SELECT member_bk, hcc_bk, active_flag, {dt('coding_gap_identified_date')} AS coding_gap_identified_date,
       {dt('coding_gap_closed_date')} AS coding_gap_closed_date, 'ra_member_hcc' AS record_source, {_REF_LD}
FROM ra_member_hcc""")
oracle("a15_reference_payments_staged", with_bronze("pi_payment_transactions") + f"""
SELECT txn_bk, claim_line_bk, CAST(billed_amount AS DOUBLE) AS billed_amount,
       CAST(allowed_amount AS DOUBLE) AS allowed_amount, CAST(paid_amount AS DOUBLE) AS paid_amount,
       {dt('payment_date')} AS payment_date, 'pi_payment_transactions' AS record_source, {_REF_LD}
FROM pi_payment_transactions""")
oracle("i05_stream_alert_table_hourly", ORACLE["i05_alert_table_hourly"])
oracle("i12_stream_budget_admission", ORACLE["i12_budget_admission"])
oracle("i11_stream_behaviour_and_cost", owith("tool_call_events", "agent_cost_events", extra=COST) + """
SELECT a.tool_name, a.status, count(p.event_id) AS calls, CAST(sum(p.cost_dollars) AS DOUBLE) AS cost_dollars,
       count(*) FILTER (WHERE p.event_id IS NULL) AS calls_without_cost
FROM tool_call_events a LEFT JOIN priced p ON a.event_id = p.event_id GROUP BY 1, 2""")
oracle("i01_stream_additive_schema", owith("tool_call_events") + f"""
SELECT event_id, {ts('timestamp_utc')} AS timestamp_utc, tool_name, status, CAST(latency_ms AS BIGINT) AS latency_ms,
       CASE WHEN third > 0 THEN 'cc-' || CAST(third AS VARCHAR) END AS cost_center,
       CASE WHEN third > 0 THEN CAST(latency_ms % 4 AS BIGINT) END AS retry_count,
       CAST(0 AS BIGINT) AS unknown_fields, CAST(NULL AS VARCHAR) AS unparsed, CAST(CASE third WHEN 2 THEN 2 ELSE 1 END AS BIGINT) AS schema_version
FROM (SELECT *, CAST(event_id AS BIGINT) % 3 AS third FROM tool_call_events)""")
for _q, _same in (("c09_stream_partitioned_hub", "c04_hub_claim_line"), ("c09_stream_partitioned_link", "c05_lnk_claim_provider_member"),
                  ("c09_stream_partitioned_satellite", "c06_sat_claim_details"), ("c09_stream_partitioned_tlink", "c07_tlnk_claim_payment_txn"),
                  ("c06_stream_satellite_history", "c06_satellite_history_two_batches"),
                  ("c08_maintained_current_versions", "c08_current_satellite")):
    oracle(_q, ORACLE[_same])

oracle("a13_observed_landing_providers", ORACLE["a13_landing_summary_providers"])
oracle("i08_priced_usage_many_versions", "WITH " + USAGE.replace("prices AS (SELECT * FROM (VALUES " + PRICES
       + ") t(sku_name, price_start_time, price_end_time, price)),\n  usage", "usage", 1).replace(",\n  pu AS", """,
  days AS (SELECT DISTINCT sku_name, usage_date FROM usage),
  prices AS (SELECT sku_name, CAST(usage_date AS TIMESTAMP) AS price_start_time,
                    CAST(lead(usage_date) OVER (PARTITION BY sku_name ORDER BY usage_date) AS TIMESTAMP) AS price_end_time,
                    CAST(CAST(0.1 AS DECIMAL(10,4)) + CAST(dayofyear(usage_date) AS DECIMAL(10,4)) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(10,4)) AS price
             FROM days),
  pu AS""", 1) + ORACLE["i08_priced_usage"].split("WITH " + USAGE, 1)[1])
oracle("f05_distinct_members_by_sketch", gwith("fenc") + " UNION ALL ".join(f"""
SELECT '{g}' AS grain, CAST(CAST(date_trunc('{g}', CAST(encounter_start AS TIMESTAMP)) AS DATE) AS VARCHAR) AS metric_time, encounter_class_code,
       count(DISTINCT member_hk) AS distinct_members, true AS within_2_percent FROM fenc GROUP BY 2, 3""" for g in ("month", "quarter", "year")))
oracle("g01_sql_governed_dim_provider_south", ORACLE["g01_governed_dim_provider_south"])
oracle("g02_sql_governed_dim_member_masked", ORACLE["g02_governed_dim_member_masked"])


def _register_star_and_source_tests():
    from vaultmart.plans.queries import SOURCE_KEYS, gold_checks, source_checks
    by_name = {n.split("_", 1)[1]: sql for n, sql in ORACLE.items() if n[0] in "de" and n[1:3].isdigit()}
    tables = sorted({c.table for c in gold_checks()} | {c.ref_table for c in gold_checks() if c.ref_table})
    ctes = ",\n".join(f"q_{t} AS (SELECT * FROM ({by_name[t]}))" for t in tables)
    status = "SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ("
    oracle("h04_gold_quality_checks", f"WITH {ctes}\n{status}" + "\nUNION ALL\n".join(_check_sql(c) for c in gold_checks()) + ")")
    sources = ",\n".join(f"q_{t} AS (SELECT * FROM {t})" for t in SOURCE_KEYS)
    oracle("h05_source_quality_checks", with_bronze(*SOURCE_KEYS, extra=sources) + status
           + "\nUNION ALL\n".join(_check_sql(c) for c in source_checks()) + ")")


_register_star_and_source_tests()

# the first of two copies of every claim row, in the order in which the files hold them
_PLACE = ", ".join([*(f"""coalesce(CAST("{c}" AS VARCHAR), '')""" for c in _IG.CLAIM_HEADER_COLUMN_MAP), "CAST(copy AS VARCHAR)"])
# a CSV file does not tell an empty field from a missing one
_FIRST = ", ".join(f"""{"CASE WHEN copy = 1 THEN '9' || CLM_PMT_AMT ELSE CLM_PMT_AMT END" if c == 'CLM_PMT_AMT' else f"""nullif("{c}", '')"""} AS {t}"""
                   for c, t in _IG.CLAIM_HEADER_COLUMN_MAP.items())
oracle("a04_first_claim_row_in_file_order", f"""WITH raw AS ({_RAW['claims_raw']}),
two AS (SELECT raw.*, copy FROM raw, (VALUES (0), (1)) c(copy)),
placed AS (SELECT {_FIRST}, md5(concat_ws('|', {_PLACE})) AS _place FROM two)
SELECT * EXCLUDE (_rn, _place) FROM (SELECT *, row_number() OVER (PARTITION BY claim_line_bk ORDER BY _place) AS _rn FROM placed) WHERE _rn = 1""")


def _register_reference_tables():
    from vaultmart.plans.queries import REFERENCE_MODELS
    for table, model in REFERENCE_MODELS.items():
        oracle(f"a15_reference_{table}_staged", f"SELECT * REPLACE ('{table}' AS record_source, {_REF_LD}) "
               f"FROM ({ORACLE[_OV.staging_query_name(model)]})")
    oracle("a15_reference_drg_weights_staged", ORACLE["b03_stg_drgs"])


_register_reference_tables()
