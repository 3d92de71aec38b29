"""Checks in several jobs find what one job finds; what a job shuffled is gone when its result is written."""

import glob

import pytest
from pyspark.sql import functions as F

from tests import fixtures as FX
from vaultmart.operators import quality as QC
from vaultmart.plans import queries as Q
from vaultmart.plans.build import build_vault
from vaultmart.session import FILE_CLEANUP, materialize, shuffles_dropped


def results(df):
    return sorted((r.table, r.check, r.column, r.failures, r.status) for r in df.collect())


def test_jobs_find_what_one_job_finds(spark):
    hub = spark.createDataFrame([("a", "A"), ("a", "A"), ("b", "B"), (None, "C")], "k string, bk string")
    ref = spark.createDataFrame([("a", "l1"), ("z", "l1"), ("z", None), (None, "l2")], "k string, lk string")
    far = spark.createDataFrame([("z", 1), ("b", 2), ("y", 2)], "k string, v int")
    tables = {"hub": hub, "ref": ref, "far": far}
    checks = [QC.Check("hub", "unique", "k"), QC.Check("hub", "unique", "bk"), QC.Check("hub", "not_null", "k"), QC.Check("ref", "unique", "lk"),
              QC.Check("ref", "relationships", "k", "hub", "k"), QC.Check("far", "relationships", "k", "hub", "k"),
              QC.Check("far", "accepted_values", "v", values=(1,)), QC.Check("hub", "relationships", "k", "ref", "k"), QC.Check("hub", "not_null", "k")]
    want = results(QC.run_checks(tables, checks))
    assert [f for t, c, _, f, _ in want if (t, c) in (("far", "relationships:hub"), ("ref", "unique"), ("hub", "unique"))] == [2, 1, 1, 1]
    for jobs in ([["hub", "ref", "far"]], [["hub"], ["ref"], ["far"]], [["far", "hub"], ["ref"]]):
        got = QC.run_checks_by_job(spark, lambda names: {n: tables[n] for n in names}, jobs, checks)
        assert results(got) == want, jobs
    with pytest.raises(ValueError):
        QC.run_checks_by_job(spark, lambda names: tables, [["hub"], ["ref"]], checks)


def test_keys_that_repeat_at_their_home_are_found(spark):
    """Gathered tables count repeated keys in place; other keys of them do not move."""
    names = ["hub_claim_line", "lnk_claim_provider_member", "tlnk_claim_payment_txn"]
    v = {n: t.unionByName(t) for n, t in build_vault(FX.bronze(spark), names=names, gather=True).items()}
    plain = {n: t.unionByName(t) for n, t in build_vault(FX.bronze(spark), names=names).items()}
    checks = QC.vault_checks(names)
    got = results(QC.run_checks(v, checks))
    assert got == results(QC.run_checks(plain, checks))
    keys = {t.pk for t in (Q.R.BY_NAME[n] for n in names)} | {"claim_line_bk"}
    assert all(f == plain[t].count() // 2 > 0 for t, c, col, f, _ in got if c == "unique" and col in keys)


def test_every_table_of_the_checks_belongs_to_one_job():
    for jobs, checks in ((list(Q._quality_jobs().values()), Q.QC.vault_checks()), (Q._gold_jobs(), Q.gold_checks())):
        named = [t for names in jobs for t in names]
        assert len(named) == len(set(named)) and set(QC.check_columns(checks)) <= set(named)


def test_a_written_table_leaves_no_shuffle(spark, tmp):
    before = spark.conf.get(FILE_CLEANUP)
    with shuffles_dropped(spark), shuffles_dropped(spark):
        assert spark.conf.get(FILE_CLEANUP) == "true"
    assert spark.conf.get(FILE_CLEANUP) == before

    def shuffles():
        dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
        return {f for d in dirs for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}
    had = shuffles()
    spark.range(1000).groupBy(F.col("id") % 7).count().write.parquet(f"{tmp}/kept")
    plain = shuffles()
    assert plain - had                                                    # a plain job leaves them
    rows = materialize(spark, spark.range(1000).groupBy((F.col("id") % 9).alias("k")).count(), "counted")
    assert not shuffles() - plain and rows.count() == 9
