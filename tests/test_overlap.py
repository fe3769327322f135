import pytest
from pyspark.sql import functions as F

from strata.operators import harmonize as H
from strata.operators import overlap as O

EXTERNAL = [
    ("Abbott, Mr. Rossmore Edward", "male", 16.0, "3rd", "Southampton", "United States", "C.A. 2673", 20.25, 1.0, 1.0, "no"),
    ("Andersson, Miss. Ellis Anna Maria", "female", 2.0, "3rd", "Southampton", "Sweden", "347082", 31.275, 4.0, 2.0, "no"),
    ("Brown, Mr. Thomas", "male", 35.0, "1st", "Cherbourg", "United Kingdom", "PC 17599", 100.0, 0.0, 0.0, "yes"),
    ("Crewman, Mr. Engine", "male", 40.0, "engineering crew", "Belfast", "United Kingdom", None, None, 0.0, 0.0, "no"),
    ("Waiter, Mr. Restaurant", "male", 30.0, "restaurant staff", "Southampton", "France", None, None, 0.0, 0.0, "yes"),
    ("Unknown, Mrs. New Passenger", "female", 28.0, "2nd", "Queenstown", "Finland", "NEW 123", 25.0, 0.0, 0.0, "yes"),
]
SCHEMA = ("name string, gender string, age double, class string, embarked string, country string, ticketno string, "
          "fare double, sibsp double, parch double, survived string")


def frames(spark):
    ext = spark.createDataFrame(EXTERNAL, SCHEMA)
    train = spark.createDataFrame([(1, "Abbott, Mr. Rossmore Edward", "UNRELATED", 3),
                                   (2, "Different Passenger", "347082", 3),
                                   (3, "Ticket Match Passenger", "PC-17599", 1)],
                                  "PassengerId long, Name string, Ticket string, Pclass long")
    return ext, train


def test_harmonize(spark):
    ext, _ = frames(spark)
    clean = H.harmonize_external(ext).orderBy("PassengerId").collect()
    assert len(clean) == 4
    assert [r.Embarked for r in clean] == ["S", "S", "C", "Q"]
    assert [r.Pclass for r in clean] == [3, 3, 1, 2]
    assert [r.Survived for r in clean] == [0, 0, 1, 1]
    assert [r.PassengerId for r in clean] == [1, 2, 3, 4]
    assert all(r.Cabin is None for r in clean)
    summary = {(r.metric, r.key): r.value for r in H.class_filter_summary(ext).collect()}
    assert summary[("excluded_rows", "")] == 2 and summary[("retained_rows", "")] == 4


def test_harmonize_rejects_bad_survival(spark):
    ext, _ = frames(spark)
    bad = ext.withColumn("survived", F.lit("maybe"))
    with pytest.raises(Exception):
        H.harmonize_external(bad).collect()


def test_audit_and_rules(spark):
    ext, train = frames(spark)
    clean = H.harmonize_external(ext)
    audit = O.audit_overlap(clean, train, with_ids=True).orderBy("PassengerId").collect()
    assert [r.OverlapEvidence for r in audit] == ["name_only", "ticket_only", "ticket_only", "none"]
    assert list(audit[0].MatchedTrainingIdsByName) == [1]
    assert list(audit[2].MatchedTrainingIdsByTicket) == [3]
    a = O.audit_overlap(clean, train)
    assert O.nonoverlap(a, "either").count() == 1
    assert O.nonoverlap(a, "both").count() == 4
    assert O.nonoverlap(a, "name").count() == 3
    assert O.nonoverlap(a, "ticket").count() == 2
    assert not set(O.AUDIT_COLUMNS) & set(O.nonoverlap(a).columns)
    with pytest.raises(ValueError):
        O.nonoverlap(a, "fuzzy")


def test_external_job_writes_artifacts(spark, tmp_path):
    from strata.plans.external import prepare_external
    ext, train = frames(spark)
    run = prepare_external(ext, train, rule="either", output_dir=str(tmp_path))
    assert run.summary["external_rows"] == 4 and run.summary["either_matches"] == 3
    assert run.summary["nonoverlap_rows"] == 1 and run.summary["training_rows"] == 3
    assert spark.read.parquet(str(tmp_path / "external_nonoverlap")).count() == 1
    assert (tmp_path / "external_overlap_summary.json").exists()
    with pytest.raises(ValueError):
        prepare_external(ext, train, rule="fuzzy")


def test_harmonize_domain_and_integer_rules(spark):
    ext, _ = frames(spark)
    with pytest.raises(ValueError, match="gender"):
        H.harmonize_external(ext.withColumn("gender", F.lit("unknown")))
    with pytest.raises(ValueError, match="non-integer"):
        H.harmonize_external(ext.withColumn("sibsp", F.lit(1.5)))


def test_id_lists_of_a_hot_key_come_in_chunks(spark):
    rows = [(i, "Hot" if i % 3 else f"cold {i}", f"T{i % 2}") for i in range(5000)] + [(None, "", "T0")]
    train = spark.createDataFrame(rows, "PassengerId long, Name string, Ticket string").repartition(5)
    keys = O.training_match_keys(train, "Name", "Ticket", "PassengerId")
    got = O.match_id_lists(keys, "NormalizedName", ids_per_row=100).collect()
    hot = sorted((r for r in got if r.NormalizedName == "hot"), key=lambda r: r.chunk)
    want = [i for i in range(5000) if i % 3]
    assert [r.chunk for r in hot] == list(range(-(-len(want) // 100)))
    assert [i for r in hot for i in r.matched_ids] == want
    assert {r.match_count for r in hot} == {len(want)} and max(len(r.matched_ids) for r in hot) == 100
    cold = {r.NormalizedName: (r.match_count, r.chunk, r.matched_ids) for r in got if r.NormalizedName != "hot"}
    assert cold == {f"cold {i}": (1, 0, [i]) for i in range(0, 5000, 3)}
    whole = O.match_id_lists(keys, "NormalizedName").filter("NormalizedName = 'hot'").collect()
    assert [(r.chunk, r.matched_ids) for r in whole] == [(0, want)]


def test_audit_leaves_long_lists_to_the_chunks(spark):
    train = spark.createDataFrame([(i, "A", f"t{i}") for i in range(30)], "PassengerId long, Name string, Ticket string")
    ext = spark.createDataFrame([(1, "a", "t3"), (2, "b", ""), (3, None, None), (3, "A.", "T-4")], train.schema)
    audit = O.audit_overlap(ext, train, with_ids=True, max_ids_per_key=10).collect()
    got = {(r.PassengerId, r.Name): (r.NameMatchCount, r.MatchedTrainingIdsByName, r.TicketMatchCount, r.MatchedTrainingIdsByTicket)
           for r in audit}
    assert got == {(1, "a"): (30, None, 1, [3]), (2, "b"): (0, [], 0, []), (3, None): (0, [], 0, []), (3, "A."): (30, None, 1, [4])}


def test_shuffles_carry_digests_and_training_is_read_once(spark, tmp_path):
    rows = [(i, f"name {i}", f"T{i}") for i in range(100)]
    spark.createDataFrame(rows, "PassengerId long, Name string, Ticket string").write.parquet(str(tmp_path / "t"))
    ext = spark.createDataFrame(rows[:9], "PassengerId long, Name string, Ticket string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        audit = O.audit_overlap(ext, spark.read.parquet(str(tmp_path / "t"))).select("PassengerId", "NameMatch", "TicketMatch")
        assert audit.filter("NameMatch AND TicketMatch").count() == 9
        audit.collect()
        plan = audit._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = [x.split(",")[0] for x in plan.split("hashpartitioning(")[1:]]
    assert keys and all(k.startswith(("_d", "_digest")) for k in keys)
    assert plan.count("FileScan parquet") == 1
