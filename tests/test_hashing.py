import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vaultmart.functions.hashing import hash_key, hashdiff, sha_surrogate, stage


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def test_single_and_composite_keys(spark):
    df = spark.createDataFrame([(" a1 ", "x"), ("", "y"), (None, "z")], "a string, b string")
    out = df.select(hash_key("a").alias("k1"), hash_key("a", "b").alias("k2")).collect()
    assert out[0].k1 == md5("A1") and out[0].k2 == md5("A1||X")
    assert out[1].k1 is None and out[1].k2 is None          # blank -> NULL -> NULL key
    assert out[2].k1 is None and out[2].k2 is None


def test_dates_and_decimals_are_formatted(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29), Decimal("12.30"), dt.datetime(2024, 1, 2, 3, 4, 5))],
                               "d date, m decimal(12,2), t timestamp")
    r = df.select(hash_key("d", "m", "t", df=df).alias("k")).first()
    assert r.k == md5("2024-02-29||12.30||2024-01-02 03:04:05")


def test_hashdiff_sorted_and_never_null(spark):
    df = spark.createDataFrame([("b", None)], "zeta string, alpha string")
    r = df.select(hashdiff(["zeta", "alpha"], df).alias("h")).first()
    assert r.h == md5("^^||B")                              # alpha first, NULL marker


def test_float_columns_refused(spark):
    df = spark.createDataFrame([(1.5,)], "x double")
    with pytest.raises(TypeError):
        df.select(hash_key("x", df=df))


def test_stage_and_surrogate(spark):
    df = spark.createDataFrame([("m1", "h1")], "member_bk string, hcc_bk string")
    s = stage(df, {"member_hk": ["member_bk"]}, {"hd": ["hcc_bk"]}, {"src": F.lit("x")})
    assert set(s.columns) == {"member_bk", "hcc_bk", "member_hk", "hd", "src"}
    r = s.select(sha_surrogate("member_hk", "hd").alias("s")).first()
    assert r.s == hashlib.sha256(f"{md5('M1')}|{md5('H1')}".encode()).hexdigest()
