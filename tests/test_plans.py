"""Plans reach the scan with their filters and columns, and shuffle no more than they must."""

import pytest

from __spark_entry__ import queries
from moonstride.operators.lookups import without_match

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture
def plan(spark, capsys):
    def explain(df_or_name):
        df = queries()[df_or_name](spark, FOLDER) if isinstance(df_or_name, str) else df_or_name
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return explain


@pytest.mark.parametrize("name", ["fl_month_of_year", "fl_year"])
def test_date_ranges_are_pushed_down(plan, name):
    text = plan(name)
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text
    assert "Exchange" not in text


@pytest.mark.parametrize("name", ["fl_on_date", "fl_last_n_days", "fl_this_period", "fl_category", "qn_count_month"])
def test_filters_are_pushed_down(plan, name):
    pushed = [line for line in plan(name).splitlines() if "PushedFilters" in line]
    assert pushed and all("IsNotNull" in line and "," in line for line in pushed)


def test_top_rows_are_kept_per_task(plan):
    assert "TakeOrderedAndProject" in plan("so_latest_n")


@pytest.mark.parametrize("name", ["jn_left_lookup", "jn_left_date", "jn_star", "jn_null_safe", "qn_batch_counts"])
def test_small_sides_leave_the_fact_in_place(plan, name):
    text = plan(name)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    # the tree is printed down its leftmost path first, and that leads to the fact
    assert "Exchange" not in text[: text.index("Scan")]


def test_large_sides_are_shuffled_not_broadcast(spark, plan):
    """Without a hint, the size decides."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        customers = spark.read.parquet(f"{FOLDER}/customer.parquet")
        orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
        text = plan(without_match(customers, orders, "c_custkey", "o_custkey"))
        assert "SortMergeJoin LeftAnti" in text and "Broadcast" not in text
        # the distinct keys are merged before their shuffle and not shuffled again for the join
        assert text.count("Exchange (") == 2 and text.count("HashAggregate (") == 2
        for name in ("jn_left_lookup", "model_star"):
            assert "BroadcastExchange" not in plan(name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_numbering_joins_only_what_is_read(spark, plan):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = queries()["model_activities"](spark, FOLDER)
        text = plan(numbered.select("track_activity_id", "distance_kilometers"))
        assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in text
        assert "Window" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
