from __future__ import annotations

import gzip
import json

from confluo.sources.dumps import write_dump
from confluo.streaming.ingest import compact_filters, ingest, key_filter, may_be_stored, read_ingested

SCHEMA = "steam_appid long, name string"


def put(folder, name, rows):
    with gzip.open(folder / name, "wt") as fd:
        fd.writelines((json.dumps({"steam_appid": k, "name": n}) + "\n") for k, n in rows)


def run(spark, base, **options):
    schema = spark.createDataFrame([], SCHEMA).schema
    query = ingest(spark, str(base / "in"), str(base / "out"), str(base / "cp"), schema, "steam_appid", **options)
    query.awaitTermination()
    return {(r.steam_appid, r.name) for r in read_ingested(spark, str(base / "out"), schema).collect()}


PARTS = [[(1, "a"), (2, "b"), (1, "again")], [(2, "late"), (3, "c")], [(4, "d"), (None, "no key"), (1, "later")]]
EXPECTED = {(1, "a"), (2, "b"), (3, "c"), (4, "d")}


def test_three_arrivals_equal_one_batch(spark, tmp_path):
    for name in ("step", "once"):
        (tmp_path / name / "in").mkdir(parents=True)
    for i, rows in enumerate(PARTS):
        put(tmp_path / "step" / "in", f"{i}.json.gz", rows)
        got = run(spark, tmp_path / "step")
        assert len(got) == len({k for k, _ in got})
    put(tmp_path / "once" / "in", "all.json.gz", [r for rows in PARTS for r in rows])
    assert got == run(spark, tmp_path / "once") == EXPECTED
    assert run(spark, tmp_path / "step") == EXPECTED


def test_lost_checkpoint_neither_loses_nor_doubles_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in", "0.json.gz", PARTS[0])
    run(spark, tmp_path, max_files=1)
    put(tmp_path / "in", "1.json.gz", PARTS[1])
    schema = spark.createDataFrame([], SCHEMA).schema
    ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp2"), schema, "steam_appid", max_files=1).awaitTermination()
    rows = [(r.steam_appid, r.name) for r in read_ingested(spark, str(tmp_path / "out"), schema).collect()]
    assert sorted(rows) == [(1, "a"), (2, "b"), (3, "c")]


def test_keys_are_asked_of_the_filter_first(spark, tmp_path, caplog):
    """New keys look through hardly any stored row; stored ones are found."""
    schema = spark.createDataFrame([], "id string, v int").schema
    base = str(tmp_path)
    rows = lambda low, high: spark.range(low, high).selectExpr("cast(id AS string) AS id", "cast(id % 7 AS int) AS v")
    seen = []
    for n, part in enumerate((rows(0, 3000), rows(3000, 6000), rows(2990, 3010).union(rows(6000, 6100)))):
        write_dump(part.repartition(2), f"{base}/in", "append")
        with caplog.at_level("INFO", logger="confluo.streaming.ingest"):
            ingest(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", schema, "id", buckets=64, bits=1 << 20).awaitTermination()
        seen.append([r.message for r in caplog.records if "may be stored" in r.message])
        if n == 1:
            compact_filters(spark, f"{base}/out")
    assert read_ingested(spark, f"{base}/out", schema).groupBy("id").count().where("count > 1").count() == 0
    assert read_ingested(spark, f"{base}/out", schema).count() == 6100
    (second,), third = seen[1], seen[2][-1]
    asked = lambda m: [int(w) for w in m.replace(",", "").split() if w.isdigit()]
    assert asked(second)[0] <= 5 and asked(second)[1] <= 5
    assert 20 <= asked(third)[0] <= 22 and asked(third)[1] <= 22


def test_filters_have_every_key_and_few_others(spark):
    stored = spark.range(5000).selectExpr("cast(id AS string) AS k")
    others = spark.range(5000, 15000).selectExpr("cast(id AS string) AS k")
    for bits in (1 << 17, 64):
        filters = key_filter(stored, "k", bits)
        assert may_be_stored(stored, "k", filters, bits).count() == 5000
        found = may_be_stored(others, "k", filters, bits).count()
        assert found <= 100 if bits > 64 else 100 < found < 2000
