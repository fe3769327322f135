from pyspark.sql import functions as F

from strata.functions import exprs as X
from strata.presets import passenger as P


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr("v").alias("o")).first().o


def test_title(spark):
    assert one(spark, X.extract_title, "Braund, Mr. Owen Harris") == "Mr"
    assert one(spark, X.extract_title, "Rothes, the Countess. of") == "Rare"
    assert one(spark, X.extract_title, "Smith, Mlle. Anna") == "Miss"
    assert one(spark, X.extract_title, None) == "Unknown"
    assert one(spark, X.extract_title, "   ") == "Unknown"
    assert one(spark, X.extract_title, "No comma here.") == "Unknown"


def test_surname_deck_count_prefix(spark):
    assert one(spark, X.extract_surname, "  Braund , Mr. Owen") == "Braund"
    assert one(spark, X.extract_surname, ", Mr. X") == "Unknown"
    assert one(spark, X.first_letter, "C123") == "C"
    assert one(spark, X.first_letter, " b45") == "B"
    assert one(spark, X.first_letter, "123") == "Unknown"
    assert one(spark, X.first_letter, None) == "Unknown"
    assert one(spark, X.token_count, "C23 C25  C27") == 3
    assert one(spark, X.token_count, "  ") == 0
    assert one(spark, X.token_prefix, "A/5 21171") == "A_5"
    assert one(spark, X.token_prefix, "PC 17599") == "PC"
    assert one(spark, X.token_prefix, "113803") == "NONE"
    assert one(spark, X.token_prefix, "STON/O2. 3101282") == "STON_O2"
    assert one(spark, X.token_prefix, None) == "Unknown"
    assert one(spark, X.letters_prefix, "A/5. 21171") == "A"
    assert one(spark, X.letters_prefix, "113803") == "NONE"


def test_bins_and_flags(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 2.0, 5.0, 7.0, None)], "v double")
    got = [r.o for r in df.select(X.bin_column("v", X.FAMILY_SIZE_EDGES, X.FAMILY_SIZE_LABELS).alias("o")).collect()]
    assert got == [None, "Alone", "Small", "Medium", "Large", None]
    ages = spark.createDataFrame([(v,) for v in (0.0, 12.0, 12.5, 60.0, 61.0)], "v double")
    got = [r.o for r in ages.select(X.bin_column("v", X.AGE_GROUP_EDGES, X.AGE_GROUP_LABELS,
                                                 include_lowest=True).alias("o")).collect()]
    assert got == ["Child", "Child", "Teen", "Adult", "Senior"]
    assert one(spark, X.clip_lower, None, "double") is None
    assert one(spark, X.clip_lower, -3.0, "double") == 0.0


def test_add_passenger_features(spark):
    df = spark.createDataFrame(
        [("Braund, Mr. Owen Harris", 22.0, 1, 0, "A/5 21171", 7.25, None),
         ("Cumings, Mrs. John Bradley", 38.0, 0, 0, "113803", 53.10, "C123")],
        "Name string, Age double, SibSp long, Parch long, Ticket string, Fare double, Cabin string")
    out = P.add_passenger_features(df).collect()
    assert [r.Title for r in out] == ["Mr", "Mrs"]
    assert [r.FamilySize for r in out] == [2, 1]
    assert [r.IsAlone for r in out] == [0, 1]
    assert [r.TicketPrefix for r in out] == ["A_5", "NONE"]
    assert [r.HasCabin for r in out] == [0, 1]
    assert [r.CabinDeck for r in out] == ["Unknown", "C"]
    assert set(P.DERIVED) <= set(P.add_passenger_features(df).columns)
    assert df.columns == ["Name", "Age", "SibSp", "Parch", "Ticket", "Fare", "Cabin"]


def test_recode_and_port_codes(spark):
    df = spark.createDataFrame([(v,) for v in ("Southampton", " cherbourg ", "Q", "x-port", "", None)], "v string")
    assert [r.o for r in df.select(X.port_code("v").alias("o")).collect()] == ["S", "C", "Q", "X-PORT", None, None]
    assert one(spark, lambda c: X.recode(c, {"a": "A"}), "b") is None


def test_whitespace_class_equals_python(spark):
    chars = [chr(c) for c in range(0x3100) if not (0xD800 <= c <= 0xDFFF)]
    df = spark.createDataFrame([(c, c.isspace()) for c in chars], "c string, py boolean")
    assert df.filter(F.col("c").rlike(f"^{X.WS}$") != F.col("py")).count() == 0
