from __future__ import annotations

from datetime import date

import pytest
from telemetry_support import at
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millwatch.operators import gold, serving

HOT = {"temperature_celsius": 120.0}
DAY = 60 * 24


def test_measures_of_a_day(silver):
    row = gold.gold_risk(
        silver(
            {"pressure_bar": None, "temperature_celsius": 90.0},
            {"pressure_bar": 4.0, "temperature_celsius": 110.0, "error_code": "E1"},
            {"vibration_hz": 90.0, "operational_status": "FAULT", "temperature_celsius": 100.0},
            {"temperature_celsius": 100.0, "pressure_bar": None},
        )
    ).first()
    assert row.total_readings_24h == 4
    assert row.avg_temp_24h == 100.0 and row.max_temp_24h == 110.0
    assert row.temp_stddev_24h == pytest.approx((200 / 3) ** 0.5)
    assert row.avg_pressure_24h == 3.5 and row.error_code_count_24h == 1
    assert row.avg_vibration_24h == 60.0 and row.max_vibration_24h == 90.0
    assert (
        row.fault_event_count_24h,
        row.overheat_count_24h,
        row.vibration_anomaly_count_24h,
    ) == (1, 3, 1)
    assert row.risk_score == (1 * 0.4 + 3 * 0.3 + 1 * 0.3) / 4


def test_single_reading_has_no_spread(silver):
    assert gold.gold_risk(silver({})).first().temp_stddev_24h is None


def test_unknown_status_of_a_whole_day(silver):
    rows = silver({"operational_status": None}, {"operational_status": None, **HOT})
    assert gold.gold_risk(rows).first().risk_score == 1.0
    assert gold.gold_risk(rows, null_status_as_ok=True).first().risk_score == 0.15


def test_empty_input(silver):
    none = silver({}).limit(0)
    assert gold.gold_risk(none).count() == 0
    counters = serving.risk_kpi(gold.gold_risk(none)).first()
    assert tuple(counters) == (0, 0, None)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.fixed_dictionaries(
            {
                "machine_id": st.sampled_from(["M1", "M2"]),
                "event_timestamp": st.integers(0, 3000).map(at),
                "temperature_celsius": st.floats(1, 199),
                "vibration_hz": st.floats(1, 499),
                "operational_status": st.sampled_from(["FAULT", "IDLE", None]),
            }
        ),
        min_size=1,
        max_size=30,
    )
)
def test_scores_and_counts_stay_in_bounds(silver, rows):
    for row in gold.gold_risk(silver(*rows)).collect():
        assert 0 <= row.risk_score <= 1
        counts = row.overheat_count_24h, row.vibration_anomaly_count_24h, row.error_code_count_24h
        assert max(counts) <= row.total_readings_24h


@pytest.fixture
def days(spark):
    def build(*rows):
        layout = "machine_id STRING, plant_id STRING, event_date DATE, risk_score DOUBLE"
        frame = spark.createDataFrame(
            [(m, p, date(2024, 3, d), score) for m, p, d, score in rows], layout
        )
        measures = [c for c in (*serving.BOARD_COLUMNS, "total_readings_24h") if c not in frame.columns]
        kinds = {c: "double" if "temp" in c else "bigint" for c in measures}
        return frame.withColumns({c: F.lit(1).cast(k) for c, k in kinds.items()})

    return build


def test_leaderboard_orders_ties_by_key(days):
    frame = days(("M2", "P", 1, 0.50001), ("M1", "P", 2, 0.5), ("M1", "P", 1, 0.5), ("M3", "P", 1, 0.4))
    rounded = [(r.machine_id, r.event_date.day) for r in serving.leaderboard(frame, 3).collect()]
    assert rounded == [("M1", 1), ("M1", 2), ("M2", 1)]
    exact = serving.leaderboard(frame, 2, rounded_values=False).collect()
    assert [(r.machine_id, r.event_date.day) for r in exact] == [("M2", 1), ("M1", 1)]


def test_alarm_level_is_not_high(days):
    frame = days(("M1", "P", 1, 0.3), ("M1", "P", 2, 0.31), ("M2", "P", 1, 0.0))
    assert tuple(serving.risk_kpi(frame).first()) == (1, 2, 0.31)
    assert tuple(serving.risk_kpi_machines(frame).first()) == (1, 1, 0.31)


def test_plant_summary_order_and_mean(days):
    frame = days(("M1", "A", 1, 0.2), ("M1", "A", 2, 0.4), ("M2", "B", 1, 0.3), ("M3", "C", 1, 0.9))
    rows = [(r.plant_id, r.total_machines, r.avg_plant_risk_score)
            for r in serving.plant_summary(frame).collect()]
    assert rows == [("C", 1, 0.9), ("A", 1, 0.3), ("B", 1, 0.3)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("AB"), st.sampled_from([0.0, 0.0004, 0.0005, 0.3, 0.3001, 1.0])),
                min_size=1, max_size=40))
def test_ranks_match_counting(days, scored):
    frame = days(*[(f"M{i}", plant, 1, score) for i, (plant, score) in enumerate(scored)])
    for row in serving.rank_in_plant(frame).collect():
        higher = [s for p, s in scored if p == row.plant_id and s > row.risk_score]
        assert row.rank_in_plant == 1 + len(higher)
    assert serving.rank_in_plant(frame).count() == len(scored)


def test_latest_reading(silver):
    row = serving.latest_reading(
        silver({"event_timestamp": at(5), "temperature_celsius": 10.0},
               {"event_timestamp": at(9), "temperature_celsius": 20.0},
               {"event_timestamp": at(9), "temperature_celsius": 30.0})
    ).first()
    assert (row.event_timestamp.minute, row.temperature_celsius) == (9, 30.0)


def test_silent_days_are_listed(silver):
    days = gold.gold_risk(
        silver({"machine_id": "M1", "event_timestamp": at(0)},
               {"machine_id": "M2", "event_timestamp": at(2 * DAY)})
    )
    rows = gold.with_missing_days(days).collect()
    seen = {(r.machine_id, r.event_date.day): (r.total_readings_24h, r.is_silent) for r in rows}
    assert len(seen) == len(rows) == 6
    assert seen["M1", 1] == (1, False) and seen["M1", 3] == (0, True) and seen["M2", 1] == (0, True)
    assert gold.with_missing_days(days, "2024-03-01", "2024-03-05").count() == 10


def test_rollup_levels(silver):
    days = gold.gold_risk(
        silver({"machine_id": "M1"}, {"machine_id": "M1", "event_timestamp": at(DAY), **HOT},
               {"machine_id": "M2", "plant_id": "P2"})
    )
    rows = {(r.plant_id, r.machine_id, r.level): r for r in gold.risk_rollup(days).collect()}
    assert rows[None, None, 3].machine_days == 3
    assert rows["PLANT_MX_01", None, 1].avg_risk_score == 0.15
    assert rows["PLANT_MX_01", "M1", 0].peak_risk_score == 0.3
    assert len(rows) == 5


def test_compact_is_a_projection(silver):
    full = gold.gold_risk(silver({}, HOT))
    row = gold.compact(full).first().asDict()
    whole = full.first().asDict()
    assert len(row) == 12 and all(whole[k] == v for k, v in row.items())


def test_order_of_the_gold_measures(silver):
    from millwatch.operators.gold import gold_risk

    names = [c for c in gold_risk(silver({})).columns if c.endswith("_24h")]
    assert names == [
        "avg_temp_24h", "max_temp_24h", "temp_stddev_24h", "avg_vibration_24h", "max_vibration_24h",
        "avg_pressure_24h", "fault_event_count_24h", "overheat_count_24h", "vibration_anomaly_count_24h",
        "error_code_count_24h", "total_readings_24h",
    ]
