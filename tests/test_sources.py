"""CSV with quoted line breaks and malformed lines, checkpoint folder, file order."""

import subprocess
import sys
import types

import pytest
from pyspark.sql import functions as F

from strata import session as S
from strata.operators.rows import with_row_number
from strata.sources import io as IO

TEXT = 'id,name,note\n1,"two\nlines","a ""quoted"" word"\n2,plain,\n3,short\n4,too,many,fields\nx,bad id,"q"\n'


def test_quoted_line_breaks_and_malformed_lines(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(TEXT)
    schema = "id long, name string, note string"
    rows = [tuple(r) for r in IO.read_csv(spark, str(path), schema).collect()]
    assert rows[:3] == [(1, "two\nlines", 'a "quoted" word'), (2, "plain", None), (3, "short", None)]
    assert rows[4] == (None, "bad id", "q")
    reported = IO.read_csv(spark, str(path), schema, malformed="report").collect()
    assert [r[IO.CORRUPT] for r in reported] == [None, None, "3,short", "4,too,many,fields", 'x,bad id,"q"']
    with pytest.raises(ValueError, match="3 malformed lines.*3,short"):
        IO.read_csv(spark, str(path), schema, malformed="fail", name="notes")
    with pytest.raises(ValueError, match="2 malformed lines"):  # all text: only the number of fields counts
        IO.read_csv(spark, str(path), malformed="fail")
    path.write_text(TEXT.split("3,short")[0])
    clean = IO.read_csv(spark, str(path), schema, malformed="fail")
    assert clean.columns == ["id", "name", "note"] and clean.count() == 2
    with pytest.raises(ValueError, match="malformed must be"):
        IO.read_csv(spark, str(path), malformed="drop")


def test_csv_round_trip_keeps_every_text(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(['a "b", c', " blanks ", "", None, "l1\nl2\r\nl3\r", "\\", '\\"', "ü,☃", '"', "#x", "a\tb"])]
    df = spark.createDataFrame(rows, "i int, t string")
    IO.write_csv(df, str(tmp_path / "t"))
    assert sorted(map(tuple, IO.read_csv(spark, str(tmp_path / "t"), df.schema, malformed="fail").collect())) == [(i, t or None) for i, t in rows]


def test_rows_of_unequal_files_are_numbered_in_file_order(spark, tmp_path):
    start = 0
    for i, n in enumerate((3, 5000, 1, 40_000, 800)):
        spark.range(start, start + n).withColumn("pad", F.repeat(F.lit("x"), 30)).coalesce(1).write.parquet(f"{tmp_path}/t/f={i}")
        start += n
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for limit in ("20k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
            spark.conf.set("spark.sql.files.openCostInBytes", "1k")
            numbered = with_row_number(spark.read.parquet(f"{tmp_path}/t").filter("id % 2 = 0").select("id"), "n")
            assert numbered.columns == ["id", "n"]
            assert numbered.filter("n <> id div 2 + 1").count() == 0 and numbered.count() == -(-start // 2)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_checkpoint_folder_must_be_named_off_local_mode():
    def fake(master, conf=None):
        settings = dict(conf or {})
        context = types.SimpleNamespace(master=master, setCheckpointDir=lambda d: settings.update(used=d))
        return types.SimpleNamespace(sparkContext=context, settings=settings, conf=types.SimpleNamespace(
            get=lambda k, d=None: settings.get(k, d), set=lambda k, v: settings.update({k: v})))

    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            S.checkpoint_dir(fake(master))
        assert S.checkpoint_dir(fake(master, {"spark.checkpoint.dir": "hdfs://x/ckpt"})) == "hdfs://x/ckpt"
    for master in ("local", "local[4]", "local[*]"):
        spark = fake(master)
        assert S.checkpoint_dir(spark) == spark.settings["used"]


def test_entry_works_where_a_package_of_the_training_data_operators_is_missing():
    code = ("import sys; sys.modules['xxhash'] = None; sys.modules['ahocorasick'] = None\n"
            "import __spark_entry__ as E; print(len(E.queries()), any(n.startswith('op') and n[2].isdigit() for n in E.queries()))")
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    n, any_op = done.stdout.split()
    assert int(n) > 100 and any_op == "False"
