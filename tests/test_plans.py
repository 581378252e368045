"""Plan-shape checks: pruning at the scan, partial aggregation before shuffles, no all-pairs joins."""

import re

from metrolens.operators import interval_join as ij
from metrolens.operators import temporal
from metrolens.plans import registry

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _read_schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^>]*>)", plan)


def test_interval_join_plan(spark):
    plan = _plan(registry.all_queries()["tickets_per_segment"](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # tickets are pre-counted map-side before the first exchange
    assert "partial_count" in plan
    # the ticket scan reads only the two columns the join needs
    assert "struct<l_partkey:bigint,l_quantity:double>" in _read_schemas(plan)
    # the equi-join is on (street, level, bin)
    assert re.search(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin) \[_street#\d+, _clvl#\d+, _cbin#\d+L?\]", plan)


def test_hot_street_is_collapsed_before_the_join(spark):
    # one street holds most tickets; after the partial aggregate it is one row per house number
    rows = [("HOT", str(i % 50)) for i in range(5000)] + [("COLD", "7")]
    tickets = spark.createDataFrame(rows, "StreetName string, HouseNumber string")
    cells = ij.ticket_cells(tickets)
    assert cells.count() == 51
    plan = _plan(cells)
    assert plan.index("partial_count") > plan.index("Exchange")  # partial agg sits below (after) the exchange line


def test_time_counts_prune_and_partially_aggregate(spark):
    df = temporal.tickets_by_hour(
        spark.read.parquet(f"{SF_SMALL}/events.parquet").selectExpr(
            "concat(date_format(ts, 'hhmm'), substr(date_format(ts, 'a'), 1, 1)) AS ViolationTime"))
    plan = _plan(df)
    assert _read_schemas(plan) == ["struct<ts:timestamp_ntz>"]
    assert "partial_count" in plan


def test_only_bounded_frames_are_hinted():
    """Broadcast hints only on one-row frames (bounds, histogram range, dropped count) and the kernel."""
    import inspect

    from metrolens.operators import cleaning, density, geocode, hull, mapping, ml, proximity, temporal as tm
    found = set()
    for mod in (ij, proximity, cleaning, density, mapping, geocode, hull, ml, tm):
        src = inspect.getsource(mod)
        for m in re.finditer(r"F\.broadcast\(", src):
            depth, i = 1, m.end()
            while depth:
                depth += {"(": 1, ")": -1}.get(src[i], 0)
                i += 1
            found.add(src[m.end():i - 1])
    # seg_bins is broadcast only behind the exact bin-row count check in interval_join
    assert found == {"r", "f", "kernel", "invalid_marker_count(df, lat_col, lon_col)", "seg_bins"}


def test_interval_join_size_check(spark):
    assert ij._threshold_bytes(spark) > 0
    assert ij._broadcast_fits(spark, 1000)
    assert not ij._broadcast_fits(spark, 10**9)
    q = registry.all_queries()["tickets_per_segment_day"]
    broadcast_rows = sorted(tuple(r) for r in q(spark, SF_SMALL).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not ij._broadcast_fits(spark, 1)
        df = q(spark, SF_SMALL)
        assert re.search(r"SortMergeJoin \[_street#\d+, _clvl#\d+, _cbin#\d+L?\]", _plan(df))
        assert sorted(tuple(r) for r in df.collect()) == broadcast_rows
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
