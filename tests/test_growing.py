"""Reports and models over files that are added, each counted once."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from slumberline.operators import learning
from slumberline.plans.growing import GrowingEvents, hourly_of_cells
from slumberline.plans.jobs import describe
from slumberline.plans.training import split_features, train
from slumberline.rules import ModelParams, SleepRule
from slumberline.sources.events import read_events_table
from slumberline.sources.schema import EVENT_ID

SF_DIR = "/root/testdata/sf0.001"
RULE = SleepRule("click", 25.0)
PARAMS = [ModelParams(reg_param=0.0, tol=1e-8)]


@pytest.fixture
def events(spark):
    return read_events_table(spark, SF_DIR)


@pytest.fixture
def folder(events, tmp_path):
    """A folder to which parts of the events are added, two files each."""
    path = str(tmp_path / "events")

    def add(part, parts=3):
        events.filter(F.col(EVENT_ID) % parts == part).repartition(2).write.mode("append").parquet(path)
        return path

    return add


def reader(spark, seen):
    return lambda paths: seen.append(sorted(paths)) or spark.read.parquet(*paths)


def plain_rows(table):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in table.collect())


def test_an_update_reads_new_files_only_and_equals_a_full_run(spark, events, folder, tmp_path):
    growing, seen = GrowingEvents(spark, str(tmp_path / "counted"), RULE, [EVENT_ID]), []
    for part in range(3):
        path = folder(part)
        read = growing.update(path, reader(spark, seen))
        assert len(read) == 2 and sorted(read) == seen[-1]
        so_far = events.filter(F.col(EVENT_ID) % 3 <= part)
        for grown, full in zip(growing.describe(), describe(so_far, RULE)):
            assert plain_rows(grown) == plain_rows(full)
    assert not set(seen[0]) & set(seen[1]) and growing.update(path, reader(spark, seen)) == [] and len(seen) == 3
    grown, full = growing.train(PARAMS), train(split_features(events, RULE, [EVENT_ID]), PARAMS)
    for one, other in zip(learning.coefficients(grown.models[PARAMS[0]]), learning.coefficients(full.models[PARAMS[0]])):
        assert abs(one - other) < 1e-6
    for report in ("confusion_matrix", "label_distribution", "split_counts"):
        assert plain_rows(getattr(grown, report)()) == plain_rows(getattr(full, report)())


def test_counted_files_are_not_needed_any_more(spark, folder, tmp_path):
    growing = GrowingEvents(spark, str(tmp_path / "counted"), RULE, [EVENT_ID])
    path = folder(0)
    growing.update(path, reader(spark, []))
    before = growing.describe()[0].first()["Count"]
    shutil.rmtree(path)
    growing.update(folder(1), reader(spark, []))
    assert growing.describe()[0].first()["Count"] > before
    assert growing.known_files().count() == 4


def test_an_update_that_fails_counts_nothing_and_can_be_repeated(spark, events, folder, tmp_path, monkeypatch):
    growing = GrowingEvents(spark, str(tmp_path / "counted"), RULE, [EVENT_ID])
    growing.update(folder(0), reader(spark, []))
    path = folder(1)
    for table in ("files", "commits"):
        write = growing.tables.write

        def failing(name, *args, table=table, write=write):
            if name == table:
                raise OSError("no space left")
            return write(name, *args)

        monkeypatch.setattr(growing.tables, "write", failing)
        with pytest.raises(OSError):
            growing.update(path, reader(spark, []))
        monkeypatch.setattr(growing.tables, "write", write)
        assert growing.cells().agg(F.sum("weight")).first()[0] == events.filter(f"sensor_id = 'click' AND {EVENT_ID} % 3 = 0").count()
    growing.update(path, reader(spark, []))
    assert growing.cells().agg(F.sum("weight")).first()[0] == events.filter(f"sensor_id = 'click' AND {EVENT_ID} % 3 < 2").count()


def test_a_changed_file_is_an_error(spark, folder, tmp_path):
    growing = GrowingEvents(spark, str(tmp_path / "counted"), RULE, [EVENT_ID])
    path = folder(0)
    growing.update(path, reader(spark, []))
    one, other = sorted(Path(path).glob("*.parquet"))[:2]
    one.write_bytes(other.read_bytes())
    with pytest.raises(ValueError, match="has changed"):
        growing.update(path, reader(spark, []))


def test_compacted_counts_and_another_rule(spark, events, folder, tmp_path):
    growing = GrowingEvents(spark, str(tmp_path / "counted"), RULE, [EVENT_ID])
    for part in range(2):
        growing.update(folder(part), reader(spark, []))
    single = growing.compact(str(tmp_path / "compacted"))
    assert plain_rows(single.cells()) == plain_rows(growing.cells())
    assert single.update(folder(2), reader(spark, [])) and single.known_files().count() == 6
    # The threshold is no part of what is stored.
    single.rule = SleepRule("click", 60.0)
    full = train(split_features(events, single.rule, [EVENT_ID]), PARAMS)
    assert plain_rows(single.train(PARAMS).label_distribution()) == plain_rows(full.label_distribution())


def test_no_file_and_unusable_readings(spark, tmp_path):
    growing = GrowingEvents(spark, str(tmp_path / "counted"), RULE, [EVENT_ID])
    assert growing.cells().isEmpty() and growing.describe()[0].first()["Count"] == 0
    rows = [(1, 0, "click", 1.0), (2, 0, "click", None), (3, None, "click", 3.0), (4, 0, "view", 9.0), (5, 1, "click", float("inf"))]
    events = spark.createDataFrame(rows, "event_id bigint, timestamp bigint, sensor_id string, value float")
    events.write.parquet(str(tmp_path / "events"))
    growing.update(str(tmp_path / "events"), lambda paths: spark.read.parquet(*paths))
    for grown, full in zip(growing.describe(), describe(events, RULE)):
        assert str(grown.collect()) == str(full.collect())
    assert hourly_of_cells(growing.cells()).agg(F.sum("count")).first()[0] == 4
