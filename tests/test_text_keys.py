import pytest

from strata.functions.text import code_key, name_key, strip_accents


@pytest.mark.parametrize(("raw", "expected"), [
    ("  Abbott, Mr. Rossmore Edward ", "abbott mr rossmore edward"),
    ("Björkell, Mr. Pontus", "bjorkell mr pontus"),
    ("Ǆemal ﬁnance", "dzemal finance"),
    (None, ""),
])
def test_name_key(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "v string")
    assert df.select(name_key("v").alias("o")).first().o == expected


@pytest.mark.parametrize(("raw", "expected"), [
    ("PC 17599", "PC17599"), ("C.A. 2673", "CA2673"), ("STON/O2. 3101282", "STONO23101282"),
    ("PC-17599", "PC17599"), (None, ""),
])
def test_code_key(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "v string")
    assert df.select(code_key("v").alias("o")).first().o == expected


def test_strip_accents_matches_nfkd(spark):
    import unicodedata
    samples = ["Crème brûlée", "plain", "한국어", "Straße", "𝐀² ½", None]
    df = spark.createDataFrame([(s,) for s in samples], "v string")
    got = [r.o for r in df.select(strip_accents("v").alias("o")).collect()]
    want = [None if s is None else "".join(c for c in unicodedata.normalize("NFKD", s)
                                           if not unicodedata.combining(c)) for s in samples]
    assert got == want
