"""The jobs end to end, as a user runs them."""

import random

import pytest

from slumberline.__main__ import main
from slumberline.operators.learning import coefficients, load_model

HOUR = 3_600_000
COLUMNS = ["--time-column", "Time", "--sensor-column", "Sensor_ID", "--value-column", "Value"]


@pytest.fixture(scope="module")
def csv(tmp_path_factory):
    rng = random.Random(11)
    lines = ["Time,Sensor_ID,Value"]
    for i in range(2000):
        lines.append(f"{1_700_000_000_000 + i * HOUR // 7},{rng.choice(['P02', 'M04', 'X9'])},{rng.randrange(1000)}")
    lines += ["1700000000000,P02,ON", "1700000000000,P02,", ",P02,5"]
    folder = tmp_path_factory.mktemp("raw")
    (folder / "sensors.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_report(spark, csv, tmp_path, capsys):
    stats, hours = str(tmp_path / "stats"), str(tmp_path / "hours")
    main(["report", "--input", csv, *COLUMNS, "--stats", stats, "--hours", hours])
    shown = capsys.readouterr().out
    assert "StdDev_Pressure" in shown and "hour_of_day" in shown
    back = spark.read.option("header", True).csv(hours)
    assert back.columns == ["hour_of_day", "count"] and back.count() == 24
    assert spark.read.option("header", True).csv(stats).columns == [
        "Count", "Min_Pressure", "Mean_Pressure", "StdDev_Pressure", "Max_Pressure"
    ]


@pytest.mark.parametrize("given, columns", [("--stats", 5), ("--hours", 2)])
def test_one_report_alone_is_written(spark, csv, tmp_path, given, columns):
    main(["report", "--input", csv, *COLUMNS, given, str(tmp_path / "only")])
    assert len(spark.read.option("header", True).csv(str(tmp_path / "only")).columns) == columns


def test_a_job_leaves_no_scratch_table(spark, csv, tmp_path, monkeypatch):
    root = tmp_path / "scratch"
    root.mkdir()
    before = spark.conf.get("spark.checkpoint.dir", None)
    monkeypatch.setattr("slumberline.session.scratch_root", lambda _: str(root))
    main(["train", "--input", csv, *COLUMNS, "--model", str(tmp_path / "m"), "--reg-param", "0"])
    assert list(root.iterdir()) == [] and (tmp_path / "m").exists()
    with pytest.raises(ValueError, match="no training rows"):
        main(["train", "--input", csv, *COLUMNS, "--sensor", "none", "--model", str(tmp_path / "n")])
    assert list(root.iterdir()) == [] and spark.conf.get("spark.checkpoint.dir", None) == before


def test_train_publish_score_peek(spark, csv, tmp_path, capsys):
    model, topic = str(tmp_path / "model"), str(tmp_path / "topic")
    main(["train", "--input", csv, *COLUMNS, "--model", model, "--reg-param", "0"])
    shown = capsys.readouterr().out
    for heading in ("split", "accuracy", "weighted_precision", "weighted_recall", "f1", "auc", "prediction", "label"):
        assert heading in shown
    assert coefficients(load_model(model))[1] > 0  # higher pressure speaks for sleep

    main(["publish", "--input", csv, *COLUMNS, "--files", topic, "--count"])
    published = int(capsys.readouterr().out.split()[0])
    assert 1200 < published < 1500 and spark.read.text(topic).count() == published

    sink = str(tmp_path / "scored")
    places = ["--files", topic, "--model", model, "--sink", sink, "--checkpoint", str(tmp_path / "c")]
    main(["score", *places, "--available-now"])
    scored = spark.read.parquet(sink)
    assert scored.count() == spark.read.text(topic).filter("value LIKE '%P02%'").count()
    assert {row[0] for row in scored.select("Is_Sleeping_Prediction").distinct().collect()} == {0.0, 1.0}

    capsys.readouterr()
    main(["peek", "--files", topic, "-n", "3"])
    assert "sensor_id" in capsys.readouterr().out


def test_training_on_a_sensor_without_events_is_an_error(csv, tmp_path):
    with pytest.raises(ValueError, match="no training rows"):
        main(["train", "--input", csv, *COLUMNS, "--sensor", "none", "--model", str(tmp_path / "m")])
