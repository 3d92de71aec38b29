"""Semantic layer (F1-F16): semantic models, measures, metrics, MetricStore.

A metric query compiles to DataFrame aggregations:

* each semantic model touched is aggregated once (``groupBy(dims).agg``,
  partial aggregation map-side);
* frames of different models are combined with a null-safe full outer
  join on the requested dimensions (facts are never joined row-wise);
* ratio metrics divide the two sums as doubles (NULL when the
  denominator is 0); derived metrics evaluate an expression over other
  metrics, where an ``offset_years`` input is the same metric shifted
  forward by 12 months on ``metric_time`` and left-joined (a missing
  prior period gives NULL, not 0).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultmart.plans import gold

GRAINS = ("day", "week", "month", "quarter", "year")
METRIC_TIME = "metric_time"


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str          # sum | count | average | count_distinct
    expr: str         # SQL expression over the fact's columns


@dataclass(frozen=True)
class SemanticModel:
    name: str
    fact: str                                  # name of the gold fact
    entities: dict                             # entity name -> column
    dimensions: dict                           # dimension name -> column (categorical) / time
    measures: tuple
    agg_time: str | None = None
    time_dimensions: tuple = ()


@dataclass(frozen=True)
class MetricInput:
    metric: str
    alias: str
    offset_years: int = 0


@dataclass(frozen=True)
class Metric:
    name: str
    label: str
    type: str                                  # simple | ratio | derived
    domain: str
    unit: str
    synonyms: tuple
    maturity: str
    measure: str | None = None
    numerator: str | None = None
    denominator: str | None = None
    expr: str | None = None
    inputs: tuple = ()
    intermediate: bool = False
    description: str = ""


def _m(name, agg, expr):
    return Measure(name, agg, expr)


# Semantic model instances FS1-FS17 (fixed definitions).
SEMANTIC_MODELS: list[SemanticModel] = [
    SemanticModel("claim_payment", "fact_claim_payment",
                  {"claim_payment": "payment_txn_hk", "claim": "claim_line_hk", "provider": "provider_hk",
                   "member": "member_hk", "drg": "drg_hk"}, {},
                  (_m("total_billed_amount", "sum", "billed_amount"), _m("total_allowed_amount", "sum", "allowed_amount"),
                   _m("total_paid_amount", "sum", "paid_amount"), _m("total_leakage_amount", "sum", "leakage_amount"),
                   _m("claim_payment_count", "count", "payment_txn_hk"),
                   _m("days_to_adjudication", "average", "date_diff(payment_date, service_from_date)")),
                  "payment_date", ("payment_date", "service_from_date")),
    SemanticModel("claim_adjustment", "fact_claim_adjustment",
                  {"claim_adjustment": "adjustment_txn_hk", "claim": "claim_line_hk", "provider": "provider_hk"},
                  {"adjustment_reason_code": "adjustment_reason_code"},
                  (_m("adjustment_count", "count", "adjustment_txn_hk"),
                   _m("denial_count", "sum", "case when adjustment_reason_code like 'CO-%' then 1 else 0 end"),
                   _m("total_adjustment_amount", "sum", "adjustment_amount")),
                  "adjustment_date", ("adjustment_date",)),
    SemanticModel("cob_recovery", "fact_cob_recovery",
                  {"cob_recovery": "cob_recovery_txn_hk", "claim": "claim_line_hk", "member": "member_hk"}, {},
                  (_m("total_recovery_amount", "sum", "recovery_amount"),), "recovery_date", ("recovery_date",)),
    SemanticModel("member_risk_score", "fact_member_risk_score",
                  {"member_risk_score": "member_risk_score_txn_hk", "member": "member_hk",
                   "risk_model": "risk_model_hk"}, {"model_year": "model_year"},
                  (_m("average_raf_score", "average", "raf_score"),), "effective_from", ("effective_from",)),
    SemanticModel("measure_evaluation", "fact_measure_evaluation",
                  {"measure_evaluation": "member_measure_eval_txn_hk", "member": "member_hk",
                   "measure": "measure_hk"}, {"measure_code": "measure_code", "eval_result": "eval_result"},
                  (_m("evaluation_count", "count", "member_measure_eval_txn_hk"),
                   _m("met_count", "sum", "case when eval_result = 'met' then 1 else 0 end"),
                   _m("weighted_met_score", "sum", "case when eval_result = 'met' then measure_weight else 0 end"),
                   _m("total_possible_weight", "sum", "measure_weight")), "effective_from", ("effective_from",)),
    SemanticModel("encounter", "fact_encounter",
                  {"encounter": "encounter_hk", "member": "member_hk", "provider": "provider_hk",
                   "facility": "facility_hk"}, {"encounter_class_code": "encounter_class_code"},
                  (_m("encounter_count", "count", "encounter_hk"),
                   _m("ed_encounter_count", "sum", "case when encounter_class_code = 'EMER' then 1 else 0 end"),
                   _m("distinct_member_count", "count_distinct", "member_hk")), "encounter_start", ("encounter_start",)),
    SemanticModel("medication_adherence", "fact_medication_adherence",
                  {"medication_adherence": "medication_adherence_hk", "member": "member_hk", "drug": "drug_hk"}, {},
                  (_m("total_days_covered", "sum", "days_covered"), _m("total_possible_days", "sum", "period_days"))),
    SemanticModel("drg_reimbursement_variance", "fact_drg_reimbursement_variance",
                  {"drg_payment": "payment_txn_hk", "claim": "claim_line_hk", "provider": "provider_hk",
                   "drg": "drg_hk"}, {},
                  (_m("total_reimbursement_variance", "sum", "reimbursement_variance"),
                   _m("total_expected_paid_amount", "sum", "expected_paid_amount"))),
    SemanticModel("authorization", "fact_authorization",
                  {"authorization": "authorization_hk", "claim": "claim_line_hk"}, {"auth_status": "auth_status"},
                  (_m("authorization_count", "count", "authorization_hk"),
                   _m("authorization_approved_count", "sum", "case when auth_status = 'approved' then 1 else 0 end")),
                  "requested_date", ("requested_date",)),
    SemanticModel("appeal", "fact_appeal", {"appeal": "appeal_hk", "claim": "claim_line_hk"},
                  {"appeal_status": "appeal_status"},
                  (_m("appeal_count", "count", "appeal_hk"),
                   _m("appeal_overturned_count", "sum", "case when appeal_status = 'overturned' then 1 else 0 end"))),
    SemanticModel("hcc_capture", "fact_hcc_capture",
                  {"hcc_capture": "hcc_capture_hk", "member": "member_hk", "hcc": "hcc_hk"}, {},
                  (_m("suspected_hcc_count", "sum", "is_suspected"), _m("captured_hcc_count", "sum", "is_captured"),
                   _m("captured_and_suspected_count", "sum", "is_captured_and_suspected"))),
    SemanticModel("coding_gap", "fact_coding_gap",
                  {"coding_gap": "member_hcc_hk", "member": "member_hk", "hcc": "hcc_hk"}, {},
                  (_m("coding_gap_identified_count", "count", "member_hcc_hk"),
                   _m("coding_gap_closed_count", "sum", "is_gap_closed")),
                  "coding_gap_identified_date", ("coding_gap_identified_date",)),
    SemanticModel("member_risk_tier", "fact_member_risk_tier",
                  {"member_risk_tier": "member_risk_score_txn_hk", "member": "member_hk"}, {"risk_tier": "risk_tier"},
                  (_m("member_count_by_tier", "count", "member_risk_score_txn_hk"),)),
    SemanticModel("risk_score_accuracy", "fact_risk_score_accuracy", {"member": "member_hk"}, {},
                  (_m("total_actual_raf", "sum", "actual_raf_score"),
                   _m("total_suspected_raf_approx", "sum", "suspected_raf_approx"))),
    SemanticModel("readmission", "fact_readmission", {"readmission": "index_encounter_hk", "member": "member_hk"}, {},
                  (_m("index_admission_count", "count", "index_encounter_hk"),
                   _m("readmission_count", "sum", "is_readmission")),
                  "index_discharge_date", ("index_discharge_date",)),
    SemanticModel("preventive_screening", "fact_preventive_screening",
                  {"preventive_screening": "member_measure_eval_txn_hk", "member": "member_hk",
                   "measure": "measure_hk"}, {"measure_code": "measure_code"},
                  (_m("screening_eligible_count", "count", "member_measure_eval_txn_hk"),
                   _m("screening_completed_count", "sum", "is_completed")), "eval_date", ("eval_date",)),
    SemanticModel("care_gap", "fact_care_gap",
                  {"care_gap": "member_measure_eval_txn_hk", "member": "member_hk", "measure": "measure_hk"},
                  {"measure_code": "measure_code"},
                  (_m("open_care_gap_count", "count", "member_measure_eval_txn_hk"),), "eval_date", ("eval_date",)),
]

MODELS = {m.name: m for m in SEMANTIC_MODELS}
MEASURE_MODEL = {ms.name: m for m in SEMANTIC_MODELS for ms in m.measures}
MEASURES = {ms.name: ms for m in SEMANTIC_MODELS for ms in m.measures}


def _simple(name, label, measure, domain, unit, synonyms, maturity, intermediate=False):
    return Metric(name, label, "simple", domain, unit, tuple(synonyms), maturity, measure=measure,
                  intermediate=intermediate)


def _ratio(name, label, num, den, domain, unit, synonyms, maturity):
    return Metric(name, label, "ratio", domain, unit, tuple(synonyms), maturity, numerator=num, denominator=den)


def _derived(name, label, expr, inputs, domain, unit, synonyms, maturity):
    return Metric(name, label, "derived", domain, unit, tuple(synonyms), maturity, expr=expr, inputs=tuple(inputs))


PI, RA, CQ, PH = "payment_integrity", "risk_adjustment", "clinical_quality", "pharmacy"
REAL, SYN = "real_data", "synthetic"

# Metric instances M1-M26, in catalogue order, with their fixed metadata
# (labels, domains, units, synonyms as published with the metric set).
METRICS: list[Metric] = [
    _simple("total_payment_leakage", "Total Payment Leakage", "total_leakage_amount", PI, "usd",
            ["leakage", "payment leakage", "dollars leaked", "overpayment"], REAL),
    _ratio("payment_leakage_rate", "Payment Leakage Rate", "total_leakage_amount", "total_billed_amount", PI,
           "percent", ["leakage rate", "leakage percentage"], REAL),
    _simple("leakage_by_provider", "Leakage by Provider", "total_leakage_amount", PI, "usd",
            ["provider leakage", "leakage per provider"], REAL),
    _ratio("denial_rate", "Denial Rate", "denial_count", "adjustment_count", PI, "percent",
           ["claim denial rate", "denial percentage"], REAL),
    _simple("days_to_adjudication", "Days to Adjudication", "days_to_adjudication", PI, "days",
            ["adjudication turnaround", "claim processing time"], REAL),
    _derived("yoy_leakage_trend", "YoY Leakage Trend", "current_year_leakage - prior_year_leakage",
             [MetricInput("total_payment_leakage", "current_year_leakage"),
              MetricInput("total_payment_leakage", "prior_year_leakage", 1)], PI, "usd",
             ["leakage trend", "leakage year over year"], REAL),
    _simple("raf_score", "RAF Score", "average_raf_score", RA, "raf_score",
            ["risk score", "risk adjustment factor", "CMS-HCC score"], SYN),
    _derived("yoy_raf_score_trend", "YoY RAF Score Trend", "current_year_raf - prior_year_raf",
             [MetricInput("raf_score", "current_year_raf"), MetricInput("raf_score", "prior_year_raf", 1)], RA,
             "raf_score", ["risk score trend", "RAF trend"], SYN),
    _ratio("hedis_style_measure_compliance_rate", "HEDIS-style Measure Compliance Rate", "met_count",
           "evaluation_count", CQ, "percent", ["HEDIS compliance", "measure compliance rate", "quality compliance rate"],
           SYN),
    _ratio("star_rating_composite_score", "Star Rating Composite Score", "weighted_met_score", "total_possible_weight",
           CQ, "score_0_to_1", ["star rating", "CMS star rating", "composite quality score"], SYN),
    _simple("ed_encounters", "ED Encounters", "ed_encounter_count", CQ, "count",
            ["ER visits", "emergency room visits", "emergency encounters"], REAL, intermediate=True),
    _simple("distinct_members", "Distinct Members with an Encounter", "distinct_member_count", CQ, "count",
            ["member population", "member count"], REAL, intermediate=True),
    _derived("ed_utilization_rate", "ED Utilization Rate", "(ed_visits / member_count) * 1000",
             [MetricInput("ed_encounters", "ed_visits"), MetricInput("distinct_members", "member_count")], CQ,
             "per_1000_members", ["ER utilization", "emergency utilization rate"], REAL),
    _ratio("medication_adherence_pdc", "Medication Adherence (PDC)", "total_days_covered", "total_possible_days", PH,
           "percent", ["PDC", "proportion of days covered", "medication adherence"], SYN),
    _simple("drg_reimbursement_variance", "DRG Reimbursement Variance", "total_reimbursement_variance", PI, "usd",
            ["DRG variance", "reimbursement variance", "DRG payment variance"], REAL),
    _simple("cob_tpl_recovery_amount", "COB / TPL Recovery Amount", "total_recovery_amount", PI, "usd",
            ["COB recovery", "TPL recovery", "coordination of benefits recovery"], SYN),
    _ratio("prior_authorization_approval_rate", "Prior Authorization Approval Rate", "authorization_approved_count",
           "authorization_count", PI, "percent", ["prior auth approval rate", "PA approval rate"], SYN),
    _ratio("appeal_overturn_rate", "Appeal Overturn Rate", "appeal_overturned_count", "appeal_count", PI, "percent",
           ["appeal success rate", "overturn rate"], SYN),
    _ratio("hcc_capture_rate", "HCC Capture Rate", "captured_and_suspected_count", "suspected_hcc_count", RA,
           "percent", ["HCC capture", "condition capture rate"], SYN),
    _ratio("coding_gap_closure_rate", "Coding Gap Closure Rate", "coding_gap_closed_count",
           "coding_gap_identified_count", RA, "percent", ["coding gap closure", "gap closure rate"], SYN),
    _ratio("risk_score_accuracy", "Risk Score Accuracy", "total_actual_raf", "total_suspected_raf_approx", RA, "ratio",
           ["RAF accuracy", "risk score accuracy ratio"], SYN),
    _ratio("suspecting_yield_rate", "Suspecting Yield Rate", "captured_and_suspected_count", "suspected_hcc_count", RA,
           "percent", ["suspecting yield", "condition suspecting rate"], SYN),
    _simple("member_risk_tier_distribution", "Member Risk Tier Distribution", "member_count_by_tier", RA, "count",
            ["risk tier breakdown", "risk stratification"], SYN),
    _ratio("readmission_rate", "Readmission Rate", "readmission_count", "index_admission_count", CQ, "percent",
           ["30-day readmission rate", "hospital readmission rate"], REAL),
    _ratio("preventive_screening_completion_rate", "Preventive Screening Completion Rate", "screening_completed_count",
           "screening_eligible_count", CQ, "percent", ["screening completion rate", "preventive care completion"], SYN),
    _simple("care_gap_count", "Care Gap Count", "open_care_gap_count", CQ, "count", ["open care gaps", "care gaps"],
            SYN),
]
METRICS_BY_NAME = {m.name: m for m in METRICS}


class UnknownMetricError(KeyError):
    pass


def metric_models(metric: Metric) -> set[str]:
    if metric.type == "simple":
        return {MEASURE_MODEL[metric.measure].name}
    if metric.type == "ratio":
        return {MEASURE_MODEL[metric.numerator].name, MEASURE_MODEL[metric.denominator].name}
    out: set[str] = set()
    for i in metric.inputs:
        out |= metric_models(METRICS_BY_NAME[i.metric])
    return out


def _agg(ms: Measure) -> Column:
    e = F.expr(ms.expr)
    if ms.agg == "sum":
        return F.sum(e)
    if ms.agg == "count":
        return F.count(e)
    if ms.agg == "average":
        # sum / non-null count in double: identical to avg, and exact sums
        # make the result independent of the summation order
        return F.try_divide(F.sum(e).cast("double"), F.count(e).cast("double"))
    if ms.agg == "count_distinct":
        return F.count_distinct(e)
    raise ValueError(ms.agg)


def _null_safe_outer(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        if not keys:
            out = out.crossJoin(f)       # both sides are single-row global aggregates
            continue
        cond = None
        r = f
        for k in keys:
            r = r.withColumnRenamed(k, f"__r_{k}")
        for k in keys:
            c = out[k].eqNullSafe(r[f"__r_{k}"])
            cond = c if cond is None else cond & c
        j = out.join(r, cond, "full_outer")
        out = j.select(*[F.coalesce(out[k], r[f"__r_{k}"]).alias(k) for k in keys],
                       *[c for c in j.columns if c not in keys and not c.startswith("__r_")])
    return out


def used_columns(metrics: Sequence[str], group_by: Sequence[str] = (), where: str | None = None) -> str:
    """All expressions over the facts that a query of these metrics names."""
    names = [where or ""]

    def add(m: Metric):
        measures = [x for x in (m.measure, m.numerator, m.denominator) if x]
        for model in [MEASURE_MODEL[x] for x in measures]:
            names.extend([model.agg_time or "", *[model.entities.get(g) or model.dimensions.get(g) or g for g in group_by]])
        names.extend(MEASURES[x].expr for x in measures)
        for i in m.inputs:
            add(METRICS_BY_NAME[i.metric])
    for name in metrics:
        add(METRICS_BY_NAME[name])
    return " ".join(names)


class MetricStore:
    """Named-metric access over gold facts."""

    def __init__(self, facts: dict[str, DataFrame | Callable[[], DataFrame]] | None = None,
                 vault: dict[str, DataFrame] | None = None, store: Callable[[DataFrame, str], DataFrame] | None = None):
        """``store``: writes a frame and reads it back; the aggregates of several models are then made one after the other, so
        that the moves behind one need not stay on the disk for the next."""
        self._store = store
        self._facts = dict(facts or {})
        self._vault = vault
        self._cache: dict[str, DataFrame] = {}

    def fact(self, name: str, used: str | None = None) -> DataFrame:
        """A gold fact; ``used``: all expressions over it, so that joins for columns which none of them names are left out."""
        lean = name == "fact_claim_payment" and used is not None and not any(c in used for c in gold.CLAIM_DETAILS)
        key = (name, used if name == "fact_drg_reimbursement_variance" else lean)
        if key not in self._cache:
            f = self._facts.get(name)
            if f is None:
                if self._vault is None:
                    raise KeyError(f"fact {name} not available")
                if name == "fact_drg_reimbursement_variance":
                    f = gold.fact_drg_reimbursement_variance(self._vault, used)
                else:
                    f = gold.fact_claim_payment(self._vault, details=False) if lean else gold.FACTS[name](self._vault)
            elif callable(f):
                f = f()
            self._cache[key] = f
        return self._cache[key]

    # -- compilation -----------------------------------------------------
    @staticmethod
    def _group_cols(model: SemanticModel, group_by: Sequence[str], grain: str | None) -> list[Column]:
        cols = []
        for g in group_by:
            if g == METRIC_TIME:
                if model.agg_time is None:
                    raise ValueError(f"semantic model '{model.name}' has no default time dimension")
                if grain not in GRAINS:
                    raise ValueError(f"grain must be one of {GRAINS}")
                cols.append(F.to_date(F.date_trunc(grain, F.col(model.agg_time).cast("timestamp"))).alias(METRIC_TIME))
            elif g.startswith(METRIC_TIME + "__"):
                raise ValueError("use grain= for metric_time")
            elif g in model.entities:
                cols.append(F.col(model.entities[g]).alias(g))
            elif g in model.dimensions:
                cols.append(F.col(model.dimensions[g]).alias(g))
            elif g in model.time_dimensions:
                cols.append(F.col(g).alias(g))
            else:
                raise ValueError(f"'{g}' is not a dimension or entity of semantic model '{model.name}'")
        return cols

    def _measure_frame(self, model: SemanticModel, measures: set[str], group_by: Sequence[str],
                       grain: str | None, where: str | None) -> DataFrame:
        columns = [model.agg_time or "", *[model.entities.get(g) or model.dimensions.get(g) or g for g in group_by]]
        f = self.fact(model.fact, " ".join([where or "", *columns, *[MEASURES[m].expr for m in measures]]))
        if where:
            f = f.where(F.expr(where))
        gcols = self._group_cols(model, group_by, grain)
        aggs = [_agg(MEASURES[m]).alias(m) for m in sorted(measures)]
        return f.groupBy(*gcols).agg(*aggs) if gcols else f.agg(*aggs)

    def _base(self, metrics: list[Metric], group_by: Sequence[str], grain, where) -> DataFrame:
        need: dict[str, set[str]] = {}

        def add(m: Metric):
            if m.type == "simple":
                need.setdefault(MEASURE_MODEL[m.measure].name, set()).add(m.measure)
            elif m.type == "ratio":
                need.setdefault(MEASURE_MODEL[m.numerator].name, set()).add(m.numerator)
                need.setdefault(MEASURE_MODEL[m.denominator].name, set()).add(m.denominator)
            else:
                for i in m.inputs:
                    if i.offset_years == 0:
                        add(METRICS_BY_NAME[i.metric])
        for m in metrics:
            add(m)
        frames = [self._measure_frame(MODELS[n], ms, group_by, grain, where) for n, ms in sorted(need.items())]
        if self._store and len(frames) > 1:
            frames = [self._store(f, n) for f, n in zip(frames, sorted(need))]
        return _null_safe_outer(frames, list(group_by)) if frames else None

    @staticmethod
    def _value(m: Metric, frame_cols: set[str]) -> Column:
        if m.type == "simple":
            return F.col(m.measure)
        if m.type == "ratio":
            return F.try_divide(F.col(m.numerator).cast("double"), F.col(m.denominator).cast("double"))
        raise ValueError("derived metrics are evaluated separately")

    def query(self, metrics: Sequence[str], group_by: Sequence[str] = (), grain: str | None = None,
              where: str | None = None, order_by: Sequence[str] | None = None,
              limit: int | None = None) -> DataFrame:
        ms = []
        for name in metrics:
            if name not in METRICS_BY_NAME:
                raise UnknownMetricError(f"unknown metric '{name}'")
            ms.append(METRICS_BY_NAME[name])
        group_by = list(group_by)
        base = self._base(ms, group_by, grain, where)
        out_cols = list(group_by)
        result = base
        for m in ms:
            if m.type != "derived":
                result = result.withColumn(m.name, self._value(m, set(result.columns)))
            else:
                result = self._derived(result, m, group_by, grain, where)
            out_cols.append(m.name)
        result = result.select(*out_cols)
        if order_by:
            result = result.orderBy(*[F.col(c[1:]).desc() if c.startswith("-") else F.col(c) for c in order_by])
        if limit is not None:
            result = result.limit(limit)
        return result

    def _derived(self, frame: DataFrame, m: Metric, group_by: list[str], grain, where) -> DataFrame:
        for i in m.inputs:
            src = METRICS_BY_NAME[i.metric]
            if i.offset_years == 0:
                if src.type == "derived":
                    frame = self._derived(frame, src, group_by, grain, where)
                    frame = frame.withColumn(i.alias, F.col(src.name))
                else:
                    frame = frame.withColumn(i.alias, self._value(src, set(frame.columns)))
                continue
            if METRIC_TIME not in group_by:
                raise ValueError(f"metric '{m.name}' uses an offset window and needs metric_time in group_by")
            prior = self._base([src], group_by, grain, where)
            prior = prior.select(*[F.add_months(F.col(k), 12 * i.offset_years).alias(k) if k == METRIC_TIME
                                   else F.col(k) for k in group_by],
                                 self._value(src, set(prior.columns)).alias(i.alias))
            cond = None
            pr = prior
            for k in group_by:
                pr = pr.withColumnRenamed(k, f"__p_{k}")
            for k in group_by:
                c = frame[k].eqNullSafe(pr[f"__p_{k}"])
                cond = c if cond is None else cond & c
            frame = frame.join(pr, cond, "left").drop(*[f"__p_{k}" for k in group_by])
        return frame.withColumn(m.name, F.expr(m.expr))

    # -- catalogue -------------------------------------------------------
    @staticmethod
    def catalogue(spark: SparkSession) -> DataFrame:
        """one row per metric with its metadata."""
        schema = T.StructType([
            T.StructField("metric_order", T.IntegerType()), T.StructField("name", T.StringType()),
            T.StructField("label", T.StringType()), T.StructField("type", T.StringType()),
            T.StructField("domain", T.StringType()), T.StructField("unit", T.StringType()),
            T.StructField("synonyms", T.ArrayType(T.StringType())), T.StructField("data_maturity", T.StringType()),
            T.StructField("is_intermediate", T.BooleanType())])
        rows = [(i, m.name, m.label, m.type, m.domain, m.unit, list(m.synonyms), m.maturity, m.intermediate)
                for i, m in enumerate(METRICS)]
        return spark.createDataFrame(rows, schema)

    @classmethod
    def list_metrics(cls, spark: SparkSession, domain: str | None = None) -> DataFrame:
        """F15."""
        c = cls.catalogue(spark)
        return c.where(F.col("domain") == domain) if domain else c

    @staticmethod
    def get_dimensions(spark: SparkSession, metrics: Sequence[str]) -> DataFrame:
        """F16: dimensions/entities usable with every named metric."""
        common: set[str] | None = None
        for name in metrics:
            if name not in METRICS_BY_NAME:
                raise UnknownMetricError(f"unknown metric '{name}'")
            dims: set[str] = set()
            models = [MODELS[n] for n in metric_models(METRICS_BY_NAME[name])]
            for i, mdl in enumerate(models):
                here = set(mdl.entities) | set(mdl.dimensions) | (
                    {METRIC_TIME} if mdl.agg_time else set())
                dims = here if i == 0 else dims & here
            common = dims if common is None else common & dims
        rows = sorted(common or [])
        kinds = {}
        for mdl in SEMANTIC_MODELS:
            for e in mdl.entities:
                kinds[e] = "entity"
            for d in mdl.dimensions:
                kinds[d] = "categorical"
        kinds[METRIC_TIME] = "time"
        return spark.createDataFrame([(r, kinds.get(r, "categorical")) for r in rows],
                                     "name string, kind string")
