"""What must not grow faster than the tables: files, listing tasks, and readings of a batch."""

import os

import pytest
from pyspark.sql import functions as F

from moonstride.catalog import files, models
from moonstride.catalog.registry import Tables, registered
from moonstride.session import shared_dir
from moonstride.sources import landing
from moonstride.streaming import ingest

ROWS = 1500


@pytest.fixture
def folder(spark, tmp_path):
    """Events whose ids lie far apart."""
    number = F.col("id").cast("int")
    events = spark.range(ROWS).select(
        (F.col("id") * 1000).alias("event_id"), F.timestamp_seconds(number * 60 + 1704067200).cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("user_id"), F.element_at(F.array(*map(F.lit, ("view", "click", "error"))), number % 3 + 1).alias("event_type"),
        (F.col("id") / 4).alias("value"), F.concat(F.lit('{"k": '), number.cast("string"), F.lit("}")).alias("props"),
    )
    events.repartition(2).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def written(spark, monkeypatch, label):
    """Where the query puts its files, noted as it runs."""
    places, original = [], files.scratch_path
    monkeypatch.setattr(files, "scratch_path", lambda s, name: places.append((name, original(s, name))) or places[-1][1])
    count = lambda: [sum(f.endswith(".txt") for _, _, found in os.walk(p) for f in found) for n, p in places if n == label]
    return count


@pytest.mark.parametrize("name, label, sets", [("sc_json_array", "arrays", 3), ("sc_indented_landing", "indented", 1), ("sc_split_array", "one-line", 2)])
def test_arrays_hold_many_elements_whatever_the_ids(spark, folder, monkeypatch, name, label, sets):
    count = written(spark, monkeypatch, label)
    rows = registered()[name](spark, folder)
    events = spark.read.parquet(f"{folder}/events.parquet").select(*rows.columns)
    assert rows.exceptAll(events).count() == 0 and rows.count() == ROWS
    assert count()[0] <= 3 * sets  # 1500 per set before


def test_whole_files_beside_cut_ones_are_few(spark, folder, monkeypatch):
    count = written(spark, monkeypatch, "cut")
    rows = registered()["sc_unreadable_files"](spark, folder).collect()
    assert sorted(map(tuple, rows)) == [(2 * i, 1) for i in range(ROWS)]
    assert count()[0] <= ROWS + 3


def test_arrays_grow_with_the_table(spark):
    assert files._elements(spark.range(100_000)) == (500, 200)
    assert files._elements(spark.range(40_000_000)) == (20_000, 2000)
    assert files._elements(spark.range(0))[1] == 1


def test_many_paths_are_listed_by_few_tasks(spark, tmp_path):
    for i in range(150):
        (tmp_path / f"{i}.json").write_text(f'{{"id": {i}}}\n')
    names = [f"{tmp_path}/{i}.json" for i in range(150)]
    before = spark.conf.get(landing._LISTING_TASKS)
    spark.sparkContext.setJobGroup("listing", "listing")
    tracker = spark.sparkContext.statusTracker()
    assert landing._read_text(spark, names).count() == 150
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) < 150
    assert spark.conf.get(landing._LISTING_TASKS) == before


@pytest.mark.parametrize("line, other", [("", 0), ("  ", 0), ("   x", 0), ("  x", 1), (" x", 1), ("x", 1), ("\tx", 1), ("[", 0), ("  {", 0), ("  },\r", 0), ("x\r\r", 1), ("    \r", 0)])
def test_lines_are_told_apart_as_by_the_patterns(spark, tmp_path, line, other):
    """An indented array stays one unless a line stands where none may."""
    (tmp_path / "a.json").write_bytes(("[\n  {\n    \"id\": 1\n  }\n]\n" + line + "\n").encode())
    form = landing._forms(spark, [f"{tmp_path}/a.json"]).first()["form"]
    assert form == ("whole" if other or line.strip() in ("[", "{", "},") else "indented")


def test_a_micro_batch_is_chosen_once(spark, folder, monkeypatch):
    plans, original = [], ingest.append_new

    def noted(batch, *more):
        plans.append(batch._jdf.queryExecution().executedPlan().toString())
        return original(batch, *more)

    monkeypatch.setattr(ingest, "append_new", noted)
    left = lambda: {d for d in os.listdir(f"{shared_dir(spark)}/moonstride") if d.startswith("arrived")}
    rows = registered()["st_incremental_append"](spark, folder)
    assert rows.count() == ROWS and rows.where("load = 'first'").count() == ROWS // 3 * 2
    assert len(plans) > 1 and not any("Join" in p or "Exchange" in p for p in plans)
    assert not left()


def test_checked_models_are_made_from_the_staged_ones(spark, folder, monkeypatch):
    made = []
    for name in ("sleep_records", "workout_records"):
        original = getattr(models, name)
        monkeypatch.setattr(models, name, lambda events, name=name, original=original: made.append(name) or original(events))
    built = models.built_for_checks(Tables(spark, folder))
    assert sorted(made) == ["sleep_records", "workout_records"]
    assert all(model.count() == ROWS for model in built.values())
