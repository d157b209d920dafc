"""Loads read only the parts of the target that may hold their ids."""

import uuid

import pytest
from pyspark.sql import functions as F

from moonstride.operators import load
from moonstride.operators.load import append_new, may_hold, unseen


@pytest.fixture
def table():
    return f"t_{uuid.uuid4().hex}"


def scanned(df):
    """Rows that left the scan of ``df``, which is a filter on files."""
    rows = df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return rows, leaf.metrics().get("numOutputRows").get().value()


@pytest.fixture
def spread(spark, tmp_path, table):
    """A target of eight files whose ids are spread over the same span."""
    ids = spark.range(0, 80_000, 2).select(F.pmod(F.xxhash64("id"), F.lit(10**12)).alias("id"), F.col("id").alias("n"))
    append_new(ids.repartition(8), table, "id", str(tmp_path / "t"))
    return spark.table(table)


def test_bloom_filters_spare_what_holds_no_id(spark, spread):
    known = [r.id for r in spread.where("n = 40").collect()]
    others = spark.range(4).select((F.col("id") * 10**11 + 12_345_678_901).alias("id"))
    assert spread.join(others, "id").count() == 0
    for batch, most in ((others, 0), (spark.createDataFrame([(known[0],)], "id long"), 5_100)):
        rows, read = scanned(spread.where(may_hold(batch, "id")).select("id"))
        assert read <= most and [r.id for r in rows] == ([known[0]] if most else [])


def test_spans_spare_what_lies_apart(spark, tmp_path, table, monkeypatch):
    monkeypatch.setattr(load, "NAMED_IDS", 50)
    ordered = spark.range(80_000).repartitionByRange(8, "id")
    append_new(ordered, table, "id", str(tmp_path / "t"))
    batch = spark.range(79_900, 80_100).union(spark.range(100))  # two ends of the target
    rows, read = scanned(spark.table(table).where(may_hold(batch, "id")))
    assert read < 25_000
    assert {r.id for r in rows} >= {*range(100), *range(79_900, 80_000)}


@pytest.mark.parametrize("named", [0, 3, 1000])
def test_nothing_known_is_passed_over(spark, tmp_path, table, monkeypatch, named):
    monkeypatch.setattr(load, "NAMED_IDS", named)
    target = [(i * 7 % 101 or None, "old") for i in range(60)]
    append_new(spark.createDataFrame(target, "id int, name string").repartition(5), table, "id", str(tmp_path / "t"))
    batch = spark.createDataFrame([(i, "new") for i in [*range(0, 110, 3), None, 5, 5]], "id long, name string")
    known = {i for i, _ in target}
    want = sorted(r.id for r in batch.collect() if r.id not in known)
    assert sorted(r.id for r in unseen(batch, spark.table(table), "id").collect()) == want
    assert append_new(batch, table, "id") == len(want)
    assert append_new(batch, table, "id") == 0


def test_an_empty_batch_and_ids_of_other_kinds(spark, tmp_path, table):
    append_new(spark.createDataFrame([("a", 1.5), (None, None)], "id string, x double"), table, "id", str(tmp_path / "t"))
    assert append_new(spark.createDataFrame([], "id string, x double"), table, "id") == 0
    assert append_new(spark.createDataFrame([("b", 1.5), ("a", 2.5), (None, 0.0)], "id string, x double"), table, "id") == 1
    assert may_hold(spark.table(table), "x") is None
