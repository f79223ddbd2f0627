"""What the plans must look like, and that all registered queries are fit to run."""

from __future__ import annotations

import re

import pytest

from __spark_entry__ import entry
from hopgrid import app
from hopgrid.plans import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def plan(frame) -> str:
    return frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEvalPython|MapInPandas", text)


def test_flagship_plan(spark):
    text = plan(entry(spark))
    assert "PushedFilters: [IsNotNull(event_id), In(event_type, [click,view])]" in text
    schemas = re.findall(r"ReadSchema: (.*)", text)
    assert schemas and all("props" not in s and ",ts:" not in s for s in schemas)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = plan(entry(spark))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Without a small side: one shuffle of each side on window and bin, nothing else.
    assert len(re.findall(r"\) Exchange\n", big)) == 2 and "SortMergeJoin" in big


def test_crowded_bins_are_cut(spark):
    text = plan(QUERIES["match_crowded"](spark, "/root/testdata/sf0.01"))
    assert "_left_block" in text and "_right_block" in text


def test_aggregates_on_fixed_width_state(spark):
    for name in ("latest_positions", "latest_position", "passenger_of_trips", "route_requests", "bounding_boxes"):
        text = plan(QUERIES[name](spark, SMALL))
        assert "SortAggregate" not in text, name


def test_entry_runs(spark):
    assert entry(spark).count() > 0


def test_app_matches_recorded_messages(spark, tmp_path):
    from hopgrid.plans.events import raw_messages, read_events
    raw_messages(read_events(spark, SMALL)).select("value", "ts").write.parquet(str(tmp_path / "raw"))
    options = app.parse_arguments([
        "--replay", str(tmp_path / "raw"), "--trips", str(tmp_path / "trips"), "--checkpoint", str(tmp_path / "cp"),
        "--map-folder", str(tmp_path / "map"), "--drivers-table", str(tmp_path / "drivers"),
        "--passengers-table", str(tmp_path / "passengers"), "--once", "--trip-ids", "stable", "--lateness", "10 seconds"])
    assert app.configuration(options).lateness == "10 seconds" and app.configuration(options).window_seconds == 15
    for query in app.start(spark, options):
        query.awaitTermination()
    trips = spark.read.parquet(str(tmp_path / "trips"))
    assert trips.count() == entry(spark).count()
    assert spark.read.text(str(tmp_path / "map")).count() > 0
    for name, key in (("drivers", "plate_id"), ("passengers", "passenger_id")):
        table = spark.read.parquet(str(tmp_path / name))
        assert table.count() == table.select(key).distinct().count() > 1
    with pytest.raises(SystemExit):
        app.parse_arguments(["--trips", "x", "--checkpoint", "y"])
