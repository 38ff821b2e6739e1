from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from confluo.functions import values as V
from confluo.functions.text import clean_query, keep_numbers, snippet, standard, strip_tags
from confluo.operators import normalise as N
from confluo.schemas import RATINGS_API, RATINGS_DUMP, STORE_DUMP
from confluo.sources import dumps


def lines(spark, tmp_path, rows, schema, name="in.json"):
    path = tmp_path / name
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")
    return dumps.read_dump(spark, str(path), schema)


def test_ratings_records(spark, tmp_path):
    rows = [
        {"id": 1, "name": "A", "genres": [{"name": "x"}, {"name": "y"}], "release_dates": [{"date": 500}, {"date": None}, {"date": 86400}],
         "involved_companies": [{"company": {"name": "Dev"}, "developer": True}, {"company": {"name": "Pub"}, "developer": False}],
         "total_rating_count": 5},
        "",
        {"id": 2, "name": "B", "release_dates": [{"date": None}], "total_rating_count": 4},
        {"id": 3, "name": "C", "release_dates": [{"date": -86400}], "total_rating_count": 9},
        "   ",
        {"id": 4, "name": "D"},
    ]
    raw = lines(spark, tmp_path, rows, RATINGS_API)
    flat = {r.id: r for r in N.ratings_dump_rows(raw).collect()}
    assert len(flat) == 4
    assert (flat[1].release_date, flat[2].release_date, flat[3].release_date, flat[4].release_date) == (500, None, -86400, None)
    assert flat[1].dev_companies == ["Dev"] and flat[2].genres == [] and flat[4].total_rating_count == 0
    known = {r.id: r for r in N.ratings_catalogue(N.ratings_dump_rows(raw)).collect()}
    assert sorted(known) == ["1", "3"]
    assert known["3"].date == datetime(1969, 12, 31)
    assert N.ratings_catalogue(N.ratings_dump_rows(raw), only_known=False).count() == 4
    assert N.ratings_dump_rows(raw).select(*RATINGS_DUMP.names).columns == RATINGS_DUMP.names


def store(appid, **more):
    base = {
        "steam_appid": appid, "type": "game", "name": f"n{appid}", "about_the_game": "x", "detailed_description": "<b>d</b>",
        "platforms": {"windows": True, "mac": False}, "recommendations": {"total": 2000},
        "release_date": {"coming_soon": False, "date": "21 Aug, 2012"},
    }
    return {**base, **more}


def test_store_records(spark, tmp_path):
    rows = [
        store(1, about_the_game="a <b>bold</b> <i\nx>c", developers=["V"], genres=[{"id": "1", "description": "Action"}]),
        store(2, name=""),
        store(3, type="demo"),
        {k: v for k, v in store(4).items() if k != "type"},
        {"steam_appid": 5, "failed": True, "redirect": 1},
        store(6, recommendations={"total": 999}),
        store(6, name="second", recommendations={"total": 1000}, type="dlc"),
        store(6, name="third"),
        store(7, release_date={"coming_soon": True, "date": "21 Aug, 2012"}),
        store(8, release_date={"coming_soon": False, "date": ""}),
        store(9, release_date={"coming_soon": False, "date": "when it is done"}),
    ]
    raw = lines(spark, tmp_path, rows, STORE_DUMP).withColumn("line", F.monotonically_increasing_id())
    got = {r.id: r for r in N.store_catalogue(raw, ["line"]).collect()}
    assert sorted(got) == ["1", "6", "7", "8", "9"]
    assert got["6"].name == "second"
    assert got["1"].summary == "a bold <i\nx>c" and got["1"].storyline == "<b>d</b>"
    assert sorted(got["1"].platforms) == ["mac", "windows"] and got["1"].devs == ["V"] and got["1"].genres == ["Action"]
    assert got["1"].date == datetime(2012, 8, 21)
    assert [got[i].date for i in "789"] == [None] * 3
    only_true = {r.id: r for r in N.store_catalogue(raw, ["line"], only_true_platforms=True).collect()}
    assert only_true["1"].platforms == ["windows"]
    report = N.unreadable_dates(raw).first()
    assert (report.unreadable, report.records) == (1, 11)


@pytest.mark.parametrize(
    ("text", "day"),
    [("21 Aug, 2012", "2012-08-21"), ("Aug 21, 2012", "2012-08-21"), ("2012", "2012-01-01"), ("Aug 2012", "2012-08-01"), ("Q3 2012", None)],
)
def test_dates(spark, text, day):
    got = spark.range(1).select(V.parse_date(F.lit(text), F.lit(False)).alias("d")).first().d
    assert got == (datetime.fromisoformat(day) if day else None)


def test_text_functions(spark):
    row = spark.sql("SELECT 'Portal 2, the v1.2 of a Pokémon' AS t").select(
        keep_numbers("t").alias("kn"), standard("t").alias("st"), strip_tags(F.lit("<p>x</p>")).alias("h"),
        snippet(F.lit("y" * 151)).alias("s"), snippet(F.lit("y" * 150)).alias("s0"), snippet(F.lit(None).cast("string")).alias("n"),
    ).first()
    assert row.kn == ["portal", "2", "v1.2", "pokémon"] and row.st == ["portal", "v1.2", "pokémon"]
    assert row.h == "x" and row.s == "y" * 150 + "..." and row.s0 == "y" * 150 and row.n is None


def test_very_long_dotted_token(spark):
    rows = spark.range(1).selectExpr("repeat('a.', 100000) || ' b' AS t").select(keep_numbers("t", ()).alias("k"))
    assert [len(t) for t in rows.first().k] == [199999, 1]


def test_query_clean_up(spark):
    rows = spark.createDataFrame([("portal 1",), ("Portal I",), ("portal 2",), ("  x \n",), ("1",), ("a1",)], "t string")
    assert [r[0] for r in rows.select(clean_query(F.col("t"))).collect()] == ["portal", "Portal", "portal 2", "x", "1", "a1"]


def test_dump_round_trip_and_append(spark, tmp_path):
    path = str(tmp_path / "dump")
    rows = spark.createDataFrame([(1, "a"), (2, None)], "steam_appid long, name string")
    dumps.write_dump(rows, path)
    dumps.append_dump(rows.where("steam_appid = 1"), path)
    got = dumps.read_dump(spark, path, rows.schema, partitions=3)
    assert sorted((r[0], r[1] or "") for r in got.collect()) == [(1, "a"), (1, "a"), (2, "")]
    assert got.rdd.getNumPartitions() == 3
    assert all(p.name.endswith(".json.gz") for p in (tmp_path / "dump").glob("part-*"))
    dumps.write_dump(rows.limit(1), path)
    assert dumps.read_dump(spark, path, rows.schema).count() == 1


def test_fetch_outcomes(spark):
    def reply(asked, returned, success=True):
        return json.dumps({str(asked): {"success": success, "data": {"steam_appid": returned, "name": f"n{returned}"}}})

    replies = spark.createDataFrame(
        [(1, reply(1, 1)), (2, "<html>"), (3, reply(3, 3, False)), (4, reply(4, 1)), (5, reply(5, 99)), (6, "{}"), (7, None)],
        "asked long, payload string",
    )
    listing = spark.createDataFrame([(i,) for i in range(1, 8)], "steam_appid long")
    classified = dumps.classify_fetch(replies)
    assert {r.asked: (r.outcome, r.redirect) for r in classified.collect()} == {
        1: ("ok", None), 2: ("failed", None), 3: ("failed", None), 4: ("redirect", 1), 5: ("redirect", 99), 6: ("failed", None), 7: ("failed", None),
    }
    rows = dumps.fetched_rows(classified, listing).collect()
    assert sorted(r.steam_appid for r in rows if r.failed) == [2, 3, 4, 5, 6, 7]
    assert sorted(r.steam_appid for r in rows if not r.failed) == [1, 99]


def test_cutoff_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "id AS popularity", "'x' AS other").write.parquet(path)
    plan = N.known_only(spark.read.parquet(path), "popularity", 50).select("id")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(popularity,50)" in plan and "other" not in plan.split("ReadSchema")[1]
