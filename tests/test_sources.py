"""Text scans, sinks and streams."""

import os

import pytest
from pyspark.sql import functions as F

from wearcurve.plans import phases
from wearcurve.plans.staged import Tables
from wearcurve.sources import schema, tables, text
from wearcurve.streaming import scoring


def write(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(content)


def line(unit, cycle, fields=26):
    return " ".join([str(unit), str(cycle), *[f"{i + 0.5}" for i in range(fields - 2)]]) + "  \n"


def test_series_scan(spark, tmp_path):
    path = str(tmp_path / "s" / "a.txt")
    write(path, line(1, 1) + "\n" + line(1, 2, 28))
    rows = text.read_series(spark, path).orderBy("time_cycles").collect()
    assert [r.time_cycles for r in rows] == [1, 2]
    assert rows[0].setting_1 == 0.5 and rows[1].sensor_21 == 23.5
    assert len(rows[0]) == 26


def test_short_lines_fail(spark, tmp_path):
    path = str(tmp_path / "s" / "a.txt")
    write(path, line(1, 1) + line(1, 2, 25))
    with pytest.raises(Exception, match="expected at least 26 fields"):
        text.read_series(spark, path).collect()


def test_rul_scan_numbers_lines_across_splits(spark, tmp_path):
    path = str(tmp_path / "r" / "rul.txt")
    values = [(i * 37) % 145 for i in range(3000)]
    write(path, "".join(f"{v} \n" for v in values))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        rows = text.read_rul(spark, path)
        assert rows.rdd.getNumPartitions() >= 1
        got = {r.unit_number: r.RUL for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == dict(enumerate(values, 1))


def test_datasets(spark, tmp_path):
    root = str(tmp_path)
    for name in ("FD001", "FD003"):
        write(f"{root}/train/train_{name}.txt", line(1, 1) + line(2, 1))
        write(f"{root}/test/test_{name}.txt", line(1, 1))
        write(f"{root}/RUL/RUL_{name}.txt", "112 \n98 \n")
    loaded = text.load_all(spark, root, ["FD001", "FD003"])
    assert loaded["train"].count() == 4
    assert {tuple(r) for r in loaded["rul"].select("dataset_id", "unit_number", "RUL").collect()} == {
        (d, u, v) for d in ("FD001", "FD003") for u, v in ((1, 112), (2, 98))
    }
    with pytest.raises(ValueError, match="invalid dataset id"):
        text.load_dataset(spark, root, "FD009")
    with pytest.raises(FileNotFoundError, match="train_FD002"):
        phases.run(spark, root, "FD002")
    with pytest.raises(ValueError):
        phases.run(spark, root, "FD001", phase=9)


def test_registry(spark):
    assert text.dataset_registry(spark).count() == 4
    assert len(schema.informative_sensors()) == 21 and len(schema.informative_sensors(True)) == 14


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    path = str(tmp_path / "c")
    tables.write_table(spark.createDataFrame([(1, 2.5)], "b int, a double"), path, "csv")
    with pytest.raises(Exception):
        tables.read_table(spark, path, "a double, b int", "csv").collect()


def test_score_map(spark, tmp_path):
    path = str(tmp_path / "m" / "hp.json")
    write(path, '{"{\\"max_depth\\": 5}": 0.5, "{\\"max_depth\\": 10}": 0.75}')
    got = {r.params: r.score for r in tables.read_score_map(spark, path).collect()}
    assert got == {'{"max_depth": 5}': 0.5, '{"max_depth": 10}': 0.75}


def test_stream_scores_like_batch(spark, tmp_path):
    rows = Tables(spark, "/root/testdata/sf0.001").labelled.select(*scoring.PREDICTIONS.fieldNames())
    fitted = scoring.fit_risk(rows)
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = scoring.score(scoring.read_predictions(spark, str(tmp_path / "in"), 1), fitted)
    assert stream.isStreaming
    scoring.write_scores(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    want = scoring.score(rows, fitted)
    assert got.count() == rows.count()
    assert got.exceptAll(want).count() == 0
    assert want.where(F.col("maintenance_alert") != (F.col("risk_level") == "HIGH")).count() == 0


def test_run_time_is_a_formatted_string(spark):
    from wearcurve.operators import risk

    stamp = risk.with_run_time(spark.range(1)).first().timestamp
    assert len(stamp) == 19 and stamp[10] == " "


def test_missing_readings_become_null(spark, tmp_path):
    path = str(tmp_path / "s" / "a.txt")
    write(path, line(1, 1).replace("0.5", "NaN", 1))
    row = text.read_series(spark, path).first()
    assert row.setting_1 is None and row.setting_2 == 1.5


def test_shared_folder_must_be_named_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.shared_dir(Session())
