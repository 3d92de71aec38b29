"""Bronze landing (A1-A13, A15): read raw files with explicit schemas,
rename, split, de-duplicate, unpivot, flatten and stamp lineage.

All readers are ``spark.read`` with an explicit all-string schema (no
inference); all transforms are DataFrame operators.  A landing job is
one scan plus at most one shuffle (the de-duplication).
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.functions.hashing import HOME, home
from vaultmart.operators.dedupe import dedupe_latest

log = logging.getLogger(__name__)

# ---------------------------------------------------------------------------
# Raw source column names and the names they land as.
# ---------------------------------------------------------------------------
PROVIDER_COLUMN_MAP = {
    "NPI": "npi",
    "Entity Type Code": "entity_type_code",
    "Provider Organization Name (Legal Business Name)": "organization_name",
    "Provider Last Name (Legal Name)": "provider_last_name",
    "Provider First Name": "provider_first_name",
    "Provider Middle Name": "provider_middle_name",
    "Provider Credential Text": "provider_credential",
    "Provider First Line Business Practice Location Address": "practice_address_line_1",
    "Provider Second Line Business Practice Location Address": "practice_address_line_2",
    "Provider Business Practice Location Address City Name": "practice_city",
    "Provider Business Practice Location Address State Name": "practice_state",
    "Provider Business Practice Location Address Postal Code": "practice_zip",
    "Healthcare Provider Taxonomy Code_1": "primary_taxonomy_code",
    "Healthcare Provider Primary Taxonomy Switch_1": "primary_taxonomy_flag",
    "Provider Enumeration Date": "enumeration_date",
    "Last Update Date": "last_update_date",
    "NPI Deactivation Date": "deactivation_date",
    "Is Sole Proprietor": "is_sole_proprietor",
}
ENTITY_INDIVIDUAL, ENTITY_ORGANIZATION = "1", "2"

BENEFICIARY_COLUMN_MAP = {
    "DESYNPUF_ID": "member_bk", "BENE_BIRTH_DT": "birth_date", "BENE_DEATH_DT": "death_date",
    "BENE_SEX_IDENT_CD": "sex_code", "BENE_RACE_CD": "race_code", "BENE_ESRD_IND": "esrd_indicator",
    "SP_STATE_CODE": "state_code", "BENE_COUNTY_CD": "county_code",
    "SP_ALZHDMTA": "flag_alzheimers_dementia", "SP_CHF": "flag_heart_failure",
    "SP_CHRNKIDN": "flag_chronic_kidney_disease", "SP_CNCR": "flag_cancer", "SP_COPD": "flag_copd",
    "SP_DEPRESSN": "flag_depression", "SP_DIABETES": "flag_diabetes", "SP_ISCHMCHT": "flag_ischemic_heart_disease",
    "SP_OSTEOPRS": "flag_osteoporosis", "SP_RA_OA": "flag_rheumatoid_osteoarthritis",
    "SP_STRKETIA": "flag_stroke_tia", "MEDREIMB_IP": "annual_medicare_reimb_inpatient",
    "MEDREIMB_OP": "annual_medicare_reimb_outpatient", "MEDREIMB_CAR": "annual_medicare_reimb_carrier",
}

CLAIM_HEADER_COLUMN_MAP = {
    "DESYNPUF_ID": "member_bk", "CLM_ID": "claim_line_bk", "CLM_FROM_DT": "service_from_date",
    "CLM_THRU_DT": "service_thru_date", "PRVDR_NUM": "provider_bk", "CLM_PMT_AMT": "paid_amount",
    "NCH_PRMRY_PYR_CLM_PD_AMT": "primary_payer_paid_amount", "CLM_ADMSN_DT": "admission_date",
    "NCH_BENE_DSCHRG_DT": "discharge_date", "CLM_DRG_CD": "drg_bk", "CLM_UTLZTN_DAY_CNT": "utilization_day_count",
}
DIAGNOSIS_CODE_COLUMNS = [f"ICD9_DGNS_CD_{i}" for i in range(1, 11)]
PROCEDURE_CODE_COLUMNS = [f"ICD9_PRCDR_CD_{i}" for i in range(1, 7)]

FHIR_RESOURCE_TYPES = ("Patient", "Encounter", "Condition")
FHIR_PATIENT_FIELDS = {"id": "member_bk", "birthDate": "birth_date", "gender": "sex", "deceasedDateTime": "death_date"}
FHIR_ENCOUNTER_FIELDS = {
    "id": "encounter_bk", "status": "encounter_status", "class.code": "encounter_class_code",
    "type.0.text": "encounter_type_text", "subject.reference": "member_reference",
    "period.start": "encounter_start", "period.end": "encounter_end",
    "participant.0.individual.reference": "provider_reference",
    "serviceProvider.reference": "facility_reference",
}
FHIR_CONDITION_FIELDS = {
    "id": "condition_bk", "clinicalStatus.coding.0.code": "clinical_status_code",
    "code.coding.0.code": "diagnosis_bk", "code.coding.0.display": "diagnosis_description",
    "subject.reference": "member_reference", "encounter.reference": "encounter_reference",
    "onsetDateTime": "onset_date",
}
FHIR_REFERENCE_COLUMNS = ("member_reference", "provider_reference", "facility_reference", "encounter_reference")

DRUG_PRODUCT_COLUMNS = [
    "PRODUCTID", "PRODUCTNDC", "PRODUCTTYPENAME", "PROPRIETARYNAME", "PROPRIETARYNAMESUFFIX",
    "NONPROPRIETARYNAME", "DOSAGEFORMNAME", "ROUTENAME", "STARTMARKETINGDATE", "ENDMARKETINGDATE",
    "MARKETINGCATEGORYNAME", "APPLICATIONNUMBER", "LABELERNAME", "SUBSTANCENAME", "ACTIVE_NUMERATOR_STRENGTH",
    "ACTIVE_INGRED_UNIT", "PHARM_CLASSES", "DEASCHEDULE", "NDC_EXCLUDE_FLAG", "LISTING_RECORD_CERTIFIED_THROUGH",
]
DRUG_PACKAGE_COLUMNS = [
    "PRODUCTID", "PRODUCTNDC", "NDCPACKAGECODE", "PACKAGEDESCRIPTION", "STARTMARKETINGDATE", "ENDMARKETINGDATE",
    "NDC_EXCLUDE_FLAG", "SAMPLE_PACKAGE",
]

# Reference and event tables landed as CSV (A15), all text on arrival.
REFERENCE_TABLES = {
    "pi_contracts": ["contract_bk", "contract_model", "effective_date"],
    "pi_provider_contracts": ["provider_bk", "contract_bk"],
    "pi_authorizations": ["authorization_bk", "claim_line_bk", "auth_status", "requested_date"],
    "pi_appeals": ["appeal_bk", "claim_line_bk", "appeal_status", "appeal_reason"],
    "pi_payment_transactions": ["txn_bk", "claim_line_bk", "billed_amount", "allowed_amount", "paid_amount",
                                "payment_date"],
    "pi_adjustment_transactions": ["txn_bk", "claim_line_bk", "adjustment_amount", "adjustment_reason_code",
                                   "adjustment_date"],
    "pi_cob_recovery_transactions": ["txn_bk", "claim_line_bk", "recovery_amount", "recovery_date"],
    "drg_weights": ["drg_bk", "drg_description", "drg_relative_weight", "weight_source_note"],
    "ra_risk_models": ["risk_model_bk", "model_name"],
    "ra_hcc_categories": ["hcc_bk", "hcc_description", "hcc_weight"],
    "ra_diagnosis_hcc_crosswalk": ["diagnosis_bk", "hcc_bk", "risk_model_bk"],
    "ra_member_hcc": ["member_bk", "hcc_bk", "active_flag", "coding_gap_identified_date", "coding_gap_closed_date"],
    "ra_suspected_hcc": ["member_bk", "hcc_bk"],
    "ra_member_risk_scores": ["member_bk", "risk_model_bk", "raf_score", "model_year"],
    "cq_measures": ["measure_bk", "measure_name", "measure_weight"],
    "cq_member_measure": ["member_bk", "measure_bk"],
    "cq_member_measure_evals": ["member_bk", "measure_bk", "eval_result", "eval_date"],
    "pharmacy_fills": ["member_bk", "drug_bk", "pharmacy_bk", "fill_date", "days_supply"],
}


class MissingColumnsError(ValueError):
    pass


def text_schema(cols: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])


# A11
def require_columns(df: DataFrame, cols: Sequence[str], mode: str = "fail", source: str = "") -> list[str]:
    """Check the schema on the driver (no job); return the missing columns."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        msg = f"{source or 'input'} is missing columns: {missing}"
        if mode == "fail":
            raise MissingColumnsError(msg)
        log.warning(msg)
    return missing


def read_csv(spark: SparkSession, path: str, cols: Sequence[str] | None = None, sep: str = ",",
             null_value: str | None = None) -> DataFrame:
    """Text-only CSV read with a header; the explicit schema prevents inference."""
    reader = spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if cols is not None:
        # keep the header's own column set: enforce names, not positions
        reader = reader.option("enforceSchema", False)
        header = spark.read.option("header", True).option("sep", sep).csv(path).columns
        return reader.schema(text_schema(header)).csv(path)
    return reader.csv(path)


def read_csv_in_order(spark: SparkSession, path: str, cols: Sequence[str], sep: str = ",", order_col: str = "_row_order") -> DataFrame:
    """Text-only CSV files of a folder with ``order_col``: the file's path, where its split starts, and the row's place in
    the task that reads the split.  Files follow each other by path, as their names number them; the key is taken from the
    files themselves, so no column of theirs has to carry it."""
    rows = spark.read.option("header", True).option("sep", sep).schema(text_schema(cols)).csv(path)
    return rows.select(*[F.col(f"`{c}`") for c in cols],
                       F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                                F.monotonically_increasing_id().alias("place")).alias(order_col))


# A10
def with_lineage(df: DataFrame, source: str, load_ts) -> DataFrame:
    """Add ``record_source`` and ``load_dts`` (batch time is a parameter)."""
    return df.withColumns({"record_source": F.lit(source), "load_dts": F.lit(load_ts).cast("timestamp")})


def _rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in mapping.items()])


def _parse_us_date(c: str) -> Column:
    return F.coalesce(F.try_to_date(F.col(c), "MM/dd/yyyy"), F.try_to_date(F.col(c), "yyyy-MM-dd"))


# A1 + A2
def latest_providers(raw: DataFrame, source: str = "nppes", load_ts=None) -> DataFrame:
    """Rename, keep the latest row per NPI."""
    require_columns(raw, list(PROVIDER_COLUMN_MAP), "fail", "provider file")
    df = dedupe_latest(_rename(raw, PROVIDER_COLUMN_MAP), ["npi"], [_parse_us_date("last_update_date")])
    return with_lineage(df, source, load_ts) if load_ts is not None else df


def land_providers(raw: DataFrame, source: str = "nppes", load_ts=None) -> tuple[DataFrame, DataFrame]:
    """Latest row per NPI, split into individuals / organisations."""
    df = latest_providers(raw, source, load_ts)
    return (df.where(F.col("entity_type_code") == ENTITY_INDIVIDUAL),
            df.where(F.col("entity_type_code") == ENTITY_ORGANIZATION))


# A3
def land_beneficiaries(raw: DataFrame, order_col: str = "_row_order", source: str = "de_synpuf",
                       load_ts=None) -> DataFrame:
    """Rename 22 columns; keep the last row per member by an explicit ordering column."""
    require_columns(raw, list(BENEFICIARY_COLUMN_MAP), "fail", "beneficiary file")
    keep = {**BENEFICIARY_COLUMN_MAP}
    df = raw.select(*[F.col(s).alias(d) for s, d in keep.items()],
                    *([F.col(order_col)] if order_col in raw.columns else []))
    if order_col in df.columns:
        df = dedupe_latest(df, ["member_bk"], [F.col(order_col)]).drop(order_col)
    else:
        df = dedupe_latest(df, ["member_bk"], [])
    return with_lineage(df, source, load_ts) if load_ts is not None else df


# A4
def land_claim_headers(raw: DataFrame, order_col: str = "_row_order", source: str = "de_synpuf", load_ts=None) -> DataFrame:
    """Rename; keep the first row per claim in file order, given by an explicit
    ordering column (a file without one has no order on a cluster: the least row is kept)."""
    require_columns(raw, list(CLAIM_HEADER_COLUMN_MAP), "fail", "inpatient claims file")
    order = [order_col] if order_col in raw.columns else []
    df = raw.select(*[F.col(f"`{src}`").alias(dst) for src, dst in CLAIM_HEADER_COLUMN_MAP.items()], *order)
    df = dedupe_latest(df, ["claim_line_bk"], order, descending=False).drop(*order)
    return with_lineage(df, source, load_ts) if load_ts is not None else df


# A5
def unpivot_codes(df: DataFrame, ids: Sequence[str], cols: Sequence[str], value: str, gather: bool = False) -> DataFrame:
    """Wide code columns -> one row per (ids, code); NULL and blank dropped; distinct.

    With ``gather`` the wide rows move to the home of their first id before they become several rows each; the distinct
    rows carry it (``HOME``) and are found, and loaded into links of that id, where they are."""
    present = [c for c in cols if c in df.columns]
    wide = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in present])
    if gather:
        ids = [*ids, HOME]
        # exploded rows stay with their home, unpivoted ones are no longer known to
        long = wide.withColumn(HOME, home(ids[0])).repartition(HOME).select(*ids, F.explode(F.array(*present)).alias(value))
    else:
        long = wide.unpivot(list(ids), present, "_code_col", value)
    return long.where(F.col(value).isNotNull() & (F.trim(F.col(value)) != "")).select(*ids, value).distinct()


def land_claims(raw: DataFrame, source: str = "de_synpuf", load_ts=None) -> dict[str, DataFrame]:
    """Inpatient claim file -> header, diagnosis bridge, procedure bridge."""
    header = land_claim_headers(raw, source=source, load_ts=load_ts)
    base = raw.select(F.col("CLM_ID").alias("claim_line_bk"), *DIAGNOSIS_CODE_COLUMNS, *PROCEDURE_CODE_COLUMNS)
    dx = unpivot_codes(base, ["claim_line_bk"], DIAGNOSIS_CODE_COLUMNS, "diagnosis_bk")
    px = unpivot_codes(base, ["claim_line_bk"], PROCEDURE_CODE_COLUMNS, "procedure_bk")
    if load_ts is not None:
        dx, px = with_lineage(dx, source, load_ts), with_lineage(px, source, load_ts)
    return {"synpuf_inpatient_claim_header": header, "synpuf_inpatient_claim_diagnoses": dx,
            "synpuf_inpatient_claim_procedures": px}


# A7
def clean_reference(c: str | Column) -> Column:
    """``urn:uuid:x`` or ``Patient/x`` -> ``x``; NULL stays NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.isNull(), None).otherwise(F.element_at(F.split(col, "[:/]"), -1))


FHIR_SCHEMA = T.StructType([
    T.StructField("resourceType", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("entry", T.ArrayType(T.StructType([
        T.StructField("fullUrl", T.StringType()),
        T.StructField("resource", T.StructType([
            T.StructField("resourceType", T.StringType()), T.StructField("id", T.StringType()),
            T.StructField("birthDate", T.StringType()), T.StructField("gender", T.StringType()),
            T.StructField("deceasedDateTime", T.StringType()), T.StructField("status", T.StringType()),
            T.StructField("class", T.StructType([T.StructField("code", T.StringType())])),
            T.StructField("type", T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))),
            T.StructField("subject", T.StructType([T.StructField("reference", T.StringType())])),
            T.StructField("period", T.StructType([T.StructField("start", T.StringType()),
                                                  T.StructField("end", T.StringType())])),
            T.StructField("participant", T.ArrayType(T.StructType([
                T.StructField("individual", T.StructType([T.StructField("reference", T.StringType())]))]))),
            T.StructField("serviceProvider", T.StructType([T.StructField("reference", T.StringType())])),
            T.StructField("clinicalStatus", T.StructType([T.StructField("coding", T.ArrayType(
                T.StructType([T.StructField("code", T.StringType())])))])),
            T.StructField("code", T.StructType([T.StructField("coding", T.ArrayType(T.StructType([
                T.StructField("code", T.StringType()), T.StructField("display", T.StringType())])))])),
            T.StructField("encounter", T.StructType([T.StructField("reference", T.StringType())])),
            T.StructField("onsetDateTime", T.StringType()),
        ])),
    ]))),
])


def _path(base: str, dotted: str) -> Column:
    """Dot-path with numeric array indices -> nested column access; NULL when absent (an index beyond the array too)."""
    col = F.col(base)
    for part in dotted.split("."):
        col = F.get(col, F.lit(int(part))) if part.isdigit() else col.getField(part)
    return col


# A6
def land_fhir(bundles: DataFrame, source: str = "synthea", load_ts=None) -> dict[str, DataFrame]:
    """Bundles -> patients, encounters, conditions; other resource types skipped."""
    res = bundles.select(F.explode("entry").alias("e")).select(F.col("e.resource").alias("r"))
    out = {}
    for rtype, fields, name in (("Patient", FHIR_PATIENT_FIELDS, "synthea_patients"),
                                ("Encounter", FHIR_ENCOUNTER_FIELDS, "synthea_encounters"),
                                ("Condition", FHIR_CONDITION_FIELDS, "synthea_conditions")):
        sel = res.where(F.col("r.resourceType") == rtype).select(
            *[_path("r", p).alias(c) for p, c in fields.items()])
        refs = {c: clean_reference(c) for c in FHIR_REFERENCE_COLUMNS if c in sel.columns}
        sel = sel.withColumns(refs) if refs else sel
        out[name] = with_lineage(sel, source, load_ts) if load_ts is not None else sel
    return out


def read_fhir(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FHIR_SCHEMA).option("multiLine", True).json(path)


# A8
def land_drugs(spark: SparkSession, products_path: str, packages_path: str, source: str = "ndc",
               load_ts=None) -> dict[str, DataFrame]:
    """Tab-separated directory files; empty -> NULL; missing columns tolerated."""
    out = {}
    for path, cols, name in ((products_path, DRUG_PRODUCT_COLUMNS, "ndc_products"),
                             (packages_path, DRUG_PACKAGE_COLUMNS, "ndc_packages")):
        df = spark.read.option("header", True).option("sep", "\t").option("nullValue", "").csv(path)
        missing = require_columns(df, cols, "warn", name)
        df = df.select(*[(F.col(c) if c not in missing else F.lit(None).cast("string")).alias(c.lower())
                         for c in cols])
        out[name] = with_lineage(df, source, load_ts) if load_ts is not None else df
    return out


# A9
def orphan_rows(child: DataFrame, parent: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Child rows whose key is absent from the parent (reported, not fatal)."""
    keys = [key] if isinstance(key, str) else list(key)
    return child.join(parent.select(*keys).distinct(), keys, "left_anti")


# A12
def write_bronze(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


# A13
def landing_summary(inputs: dict[str, DataFrame], outputs: dict[str, DataFrame]) -> DataFrame:
    """Rows in and rows landed per table, one global count per frame, unioned."""
    frames = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), F.lit(k).alias("kind"), "rows")
              for k, d in (("input", inputs), ("landed", outputs)) for n, df in d.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A frame whose rows are counted by whatever action runs it."""
    counter = Observation(name)
    return df.observe(counter, F.count(F.lit(1)).alias("rows")), counter


def land_providers_observed(spark: SparkSession, raw: DataFrame, root: str, source: str = "nppes", load_ts=None) -> DataFrame:
    """A1 and A13 in one pass: the provider file is scanned once, its latest rows are written by entity type under
    ``root``, and the counts of the summary are taken while that runs."""
    counted, rows_in = observed(raw, "provider file")
    entity = F.col("entity_type_code")
    landed = latest_providers(counted, source, load_ts)
    landed = landed.observe(landed_rows := Observation("landed"), F.count_if(entity == ENTITY_INDIVIDUAL).alias("nppes_providers"),
                            F.count_if(entity == ENTITY_ORGANIZATION).alias("nppes_facilities"))
    landed.withColumn("entity", entity).write.partitionBy("entity").parquet(root)
    rows = [("nppes_raw", "input", rows_in.get["rows"])] + [(t, "landed", n) for t, n in sorted(landed_rows.get.items())]
    return spark.createDataFrame(rows, "table string, kind string, rows long")


# A15
def read_reference_tables(spark: SparkSession, folder: str, names: Sequence[str] | None = None,
                          load_ts=None) -> dict[str, DataFrame]:
    out = {}
    for name, cols in REFERENCE_TABLES.items():
        if names is not None and name not in names:
            continue
        df = spark.read.option("header", True).schema(text_schema(cols)).csv(f"{folder}/{name}.csv")
        out[name] = with_lineage(df, name, load_ts) if load_ts is not None else df
    return out
