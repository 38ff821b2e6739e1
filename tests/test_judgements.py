from __future__ import annotations

import pytest

from confluo.sources.judgements import parse_suite, read_judgements

SUITE = """# grades 0-3

query portal 2   # the sequel
3 store 620     # good
  2 ratings 71
QUERY no entries
query summary:"a b"~4
1 ratings 5
1 ratings 5 # again
"""


def test_suite(spark, tmp_path):
    path = tmp_path / "suite"
    path.write_text(SUITE)
    queries, judgements = read_judgements(spark, str(path))
    assert [(r.query_id, r.query) for r in queries.orderBy("query_id").collect()] == [
        (1, "portal 2"), (2, "no entries"), (3, 'summary:"a b"~4')
    ]
    assert [(r.query_id, r.relevance, r.source, r.id, r.line_no) for r in judgements.orderBy("line_no").collect()] == [
        (1, 3, "store", "620", 4), (1, 2, "ratings", "71", 5), (3, 1, "ratings", "5", 8), (3, 1, "ratings", "5", 9),
    ]


@pytest.mark.parametrize(("text", "message"), [("3 store 1\nquery x\n", "line 1"), ("query x\n\n3 store\n", "line 3"), ("query x\nhello\n", "line 2"), ("query x\nquery # y\n", "line 2"), ("query x\n-1 s a\n", "line 2")])
def test_bad_lines(spark, tmp_path, text, message):
    path = tmp_path / "suite"
    path.write_text(text)
    _, judgements = read_judgements(spark, str(path))
    with pytest.raises(Exception, match=message):
        judgements.collect()


def test_headers_carry_over_file_splits(spark, tmp_path):
    """A file cut into many splits reads like a whole one."""
    path = tmp_path / "suite"
    body = "".join(f"query q{q}\n" + "".join(f"{(q + e) % 4} s {q}_{e}\n" for e in range(40)) for q in range(30))
    path.write_text(body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        queries, judgements = read_judgements(spark, str(path))
        rows = judgements.collect()
        assert queries.count() == 30
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert len(rows) == 1200
    assert all(r.query == f"q{r.id.split('_')[0]}" and r.query_id == int(r.id.split("_")[0]) + 1 for r in rows)
    assert sorted(r.line_no for r in rows) == [n for n in range(1, 1231) if (n - 1) % 41]


def test_blocks_are_independent_of_order(spark):
    rows = [("f", 10, 0, "1 s a"), ("f", 0, 5, "query x"), ("f", 20, 0, "query y"), ("f", 20, 1, "2 s b"), ("f", 10, 1, "")]
    _, judgements = parse_suite(spark.createDataFrame(rows, "suite string, block long, pos long, line string"))
    assert sorted((r.query, r.id) for r in judgements.collect()) == [("x", "a"), ("y", "b")]
