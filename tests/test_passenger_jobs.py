import csv

from strata.plans import passenger_jobs as J
from tests.test_passenger_catalog import ROWS

HEADER = ["PassengerId", "Survived", "Pclass", "Name", "Sex", "Age", "SibSp", "Parch", "Ticket", "Fare", "Cabin",
          "Embarked"]


def write_csv(path, rows, drop=()):
    keep = [i for i, h in enumerate(HEADER) if h not in drop]
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow([HEADER[i] for i in keep])
        for r in rows:
            w.writerow(["" if r[i] is None else r[i] for i in keep])


def test_prepare_train_predict(spark, tmp_path):
    rows = [(i * 100 + r[0], *r[1:]) for i in range(6) for r in ROWS]  # 72 passengers, 3 classes
    raw = tmp_path / "train.csv"
    write_csv(raw, rows)
    out = J.prepare_data_job(spark, str(raw), str(tmp_path / "processed.parquet"))
    assert out["summary"]["raw_rows"] == 72 and out["summary"]["processed_rows"] == 72
    assert any(q["section"] == "missing" for q in out["quality"])
    res = J.train_job(spark, str(tmp_path / "processed.parquet"), str(tmp_path / "model"), folds=3,
                      tuning_iterations=1, num_trees=20, candidates=("logistic_regression", "majority_class"))
    assert res.classes == [1, 2, 3]
    labelled = tmp_path / "labelled.csv"
    write_csv(labelled, rows[:24])
    run = J.predict_job(spark, str(labelled), str(tmp_path / "model"), str(tmp_path / "pred"))
    assert run["labelled"] and run["metrics"]["rows"] == 24
    unlabelled = tmp_path / "unlabelled.csv"
    write_csv(unlabelled, rows[:10], drop=("Survived", "Pclass"))
    run2 = J.predict_job(spark, str(unlabelled), str(tmp_path / "model"), str(tmp_path / "pred2"))
    assert not run2["labelled"]
    scored = spark.read.parquet(run2["paths"]["predictions"])
    assert scored.count() == 10 and "Name" in scored.columns and "PredictionConfidence" in scored.columns
