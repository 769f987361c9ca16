"""Golden rows for jobs with rules of their own."""

import datetime as dt
import pytest
from decimal import Decimal

from pyspark.sql import functions as F

from tidemart.plans import freight_reports, page_board, persona, retail_reports, store_entry


def test_two_drivers_share_by_halves(spark):
    shifts = spark.createDataFrame(
        [(7, 1, "A", 2, "B", 2, Decimal("10.00"), 100, 1), (7, 1, "A", None, None, 1, Decimal("4.00"), 60, 0),
         (7, 1, "A", None, None, 1, Decimal("4.00"), 60, 0)],
        "recent_days bigint, driver1_emp_id bigint, driver1_name string, driver2_emp_id bigint, driver2_name string, "
        "trans_finish_count bigint, trans_finish_distance decimal(16,2), trans_finish_dur_sec bigint, trans_finish_delay_count bigint")
    got = {r["driver_emp_id"]: r for r in freight_reports.driver_stats(shifts, F.lit(dt.date(2024, 1, 1))).collect()}
    assert got[1]["trans_finish_distance"] == Decimal("13.000") and got[1]["trans_finish_count"] == 4
    assert got[2]["trans_finish_distance"] == Decimal("5.000") and got[2]["trans_finish_late_count"] == 1


def test_spending_limits(spark):
    df = spark.createDataFrame([(Decimal(x),) for x in ("999.99", "1000", "3999.99", "4000")], "a decimal(16,2)")
    assert [r[0] for r in df.select(persona.spending_power(F.col("a"))).collect()] == ["low", "middle", "middle", "high"]


def test_factor_scores_and_ties(spark):
    df = spark.createDataFrame([("iOS",), ("other",), (None,)], "os string")
    got = [r[0] for r in df.select(persona.factor_scores(F.col("os"), persona.DEVICE, .1)).collect()]
    assert got[0][0] == Decimal("0.070") and got[1] is None and got[2] is None
    sums = spark.createDataFrame([(0.1, 0.3, 0.3, 0.2, 0.0, 0.0), (0.0,) * 6], [f"sum_{b}" for b in persona.BANDS])
    assert [r[0] for r in sums.select(persona.best_band(sums)).collect()] == ["25_29", None]


def test_scores_are_capped_and_graded(spark):
    days = spark.createDataFrame([("d", "s", "p", 10, 5, Decimal("3.00"), Decimal("50.00")), ("d", "s", "q", 0, 0, Decimal(0), Decimal(0))],
                                 "dt string, store_id string, page_type string, page_views bigint, unique_visitors bigint, "
                                 "avg_stay_duration decimal(16,2), bounce_rate decimal(16,2)")
    literal = {r["page_type"]: r["traffic_score"] for r in page_board.traffic_board(days).collect()}
    assert literal == {"p": Decimal("100.00"), "q": Decimal("0.00")}
    spread = {r["page_type"]: r["traffic_score"] for r in page_board.traffic_board(days, "0.2").collect()}
    assert spread["p"] == Decimal("17.80")


def test_consecutive_buyers(spark):
    d = dt.date
    rows = [(1, d(2024, 1, 1)), (1, d(2024, 1, 2)), (1, d(2024, 1, 3)), (2, d(2024, 1, 1)), (2, d(2024, 1, 3)), (2, d(2024, 1, 5)),
            (3, d(2023, 12, 24)), (3, d(2023, 12, 25)), (3, d(2023, 12, 26))]
    df = spark.createDataFrame(rows, "user_id bigint, dt date")
    assert retail_reports.consecutive_buyers(df, F.lit(d(2024, 1, 5))).first()["order_continuously_user_count"] == 1


def test_entry_winner_prefers_the_order(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("p", "home", "v", t, 0, t.date(), "PC"), ("p", "home", "v", t, 1, t.date(), "pc"), ("p", "home", None, t, 1, t.date(), "pc"),
            ("p", "home", "w", t, 2, t.date(), "pc"), ("p", "home", "x", t, 0, t.date(), "wireless")]
    log = spark.createDataFrame(rows, "page_id string, page_type string, visitor_id string, visit_time timestamp, is_order int, "
                                      "data_date date, terminal_type string")
    assert [(r["visitor_id"], r["is_order"]) for r in store_entry.entry_fact(log, "pc").collect()] == [("v", 1)]


def test_day_job_rewrites_its_day_only(spark, folder):
    from tidemart.operators.quality import EmptyLayer
    from tidemart.plans import day_job
    from tidemart.sources import tables

    rows = [(1, "0", "2024-01-01"), (2, "1", "2024-01-01"), (3, "0", "2024-01-02"), (4, "0", "2024-01-02")]
    ods = spark.createDataFrame(rows, "id int, is_deleted string, d string").selectExpr("id", "is_deleted", "cast(d as date) dt")
    tables.overwrite_days(ods, f"{folder}/ods")
    layers = [day_job.Layer("fact", f"{folder}/ods", f"{folder}/dwd", lambda r: r.select("id"))]
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        day_job.run_day(spark, layers, day)
    got = sorted((r.id, str(r.dt)) for r in spark.read.parquet(f"{folder}/dwd").collect())
    assert got == [(1, "2024-01-01"), (3, "2024-01-02"), (4, "2024-01-02")]
    plan = day_job.read_day(spark, f"{folder}/ods", "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert [r.id for r in day_job.recent_days(spark, f"{folder}/dwd", "2024-01-01", 1).collect()] == [1]
    with pytest.raises(EmptyLayer):
        day_job.run_day(spark, layers, "2024-01-03")
