from __future__ import annotations

import math

import pytest

from confluo.operators import evaluate as ev


def graded(spark, rows):
    return spark.createDataFrame(rows, "query_id string, rank int, grade int")


def qrels(spark, rows):
    return spark.createDataFrame(rows, "query_id string, source string, id string, relevance int, line_no long")


def test_dcg_example(spark):
    rows = [("q", i + 1, g) for i, g in enumerate([3, 2, 3, 0, 1])]
    assert ev.dcg(graded(spark, rows)).first().dcg == pytest.approx(3 + 2 + 3 / math.log2(3) + 1 / math.log2(5))


@pytest.mark.parametrize("block", [1, 3, 10_000])
def test_ideal_dcg_is_the_sorted_sum(spark, block):
    grades = [0, 3, 1, 2, 3, 3, 0, 1, 2, 2, 1]
    best = sorted(grades, reverse=True)
    expected = best[0] + sum(g / math.log2(p) for p, g in enumerate(best[1:], 2))
    frame = qrels(spark, [("q", "s", str(i), g, i) for i, g in enumerate(grades)])
    assert ev.ideal_dcg(frame, block).first().ideal_dcg == pytest.approx(expected)


def test_precision_figures(spark):
    judged = qrels(spark, [("q", "s", str(i), g, i) for i, g in enumerate([3, 2, 2, 1, 0])] + [("none", "s", "1", 1, 1), ("zero", "s", "1", 0, 1)])
    rank = graded(spark, [("q", 1, 3), ("q", 2, 0), ("q", 3, 2), ("none", 1, 1)])
    natural = ev.natural_precision(rank, judged).orderBy("rank").collect()
    assert [(r.rank, r.precision, r.recall) for r in natural] == [(1, 1.0, pytest.approx(1 / 3)), (3, pytest.approx(2 / 3), pytest.approx(2 / 3))]
    levels = {r.level: r.precision for r in ev.interpolated_precision(rank, judged).where("query_id = 'q'").collect()}
    assert [levels[i] for i in range(1, 11)] == [1.0] * 3 + [pytest.approx(2 / 3)] * 3 + [0.0] * 4
    average = {r.query_id: r for r in ev.average_precision(rank, judged).collect()}
    assert average["q"].ap_raw == pytest.approx((1 + 2 / 3) / 3) and average["q"].ap_interpolated == pytest.approx(0.5)
    assert average["none"].ap_raw is None and average["none"].ap_interpolated is None
    ndcg = {r.query_id: r.ndcg for r in ev.ndcg(rank, judged).collect()}
    assert ndcg["zero"] is None and ndcg["none"] == 1.0 and 0 < ndcg["q"] < 1
    assert ev.mean_average_precision(rank, judged).first().map_interpolated == pytest.approx(0.5)


def test_first_judged_hit_and_last_judgement_win(spark):
    fused = spark.createDataFrame(
        [("q", 1, [("a", "1"), ("b", "9")]), ("q", 2, [("a", "7"), ("b", "8")]), ("q", 3, [("b", "2"), ("a", "2")])],
        "query_id string, rank int, hits array<struct<source:string,id:string>>",
    )
    judged = qrels(spark, [("q", "b", "9", 3, 1), ("q", "a", "2", 1, 2), ("q", "b", "2", 0, 3), ("q", "b", "2", 2, 4), ("x", "a", "1", 3, 5)])
    assert {r.rank: r.grade for r in ev.grade_fused(fused, judged).collect()} == {1: 3, 2: 0, 3: 2}
