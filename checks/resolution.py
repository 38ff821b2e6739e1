"""Entity resolution between parts of the documents table, whose copies share their names.

Each document belongs to one part: labelled as good, labelled otherwise, or not labelled.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query, sql_analysed
from checks.views import SQL, src_docs, table
from confluo.functions.scoring import rounded
from confluo.operators import resolve as R


def _labelled(spark, sf, condition: str = "true"):
    return table(spark, sf, "labels").where(condition).select(F.col("doc_id").cast("string").alias("id"))


def _docs(spark, sf, name: str):
    return src_docs(spark, sf).withColumn("source", F.lit(name))


def sides(spark, sf):
    """Unlabelled documents look for labelled ones."""
    labelled = _labelled(spark, sf)
    return _docs(spark, sf, "left").join(labelled, "id", "left_anti"), _docs(spark, sf, "right").join(labelled, "id", "left_semi")


def three_sources(spark, sf):
    good, other = _labelled(spark, sf, "quality = 1"), _labelled(spark, sf, "quality = 0")
    return [
        ("s0", _docs(spark, sf, "s0").join(good, "id", "left_semi")),
        ("s1", _docs(spark, sf, "s1").join(other, "id", "left_semi")),
        ("s2", _docs(spark, sf, "s2").join(_labelled(spark, sf), "id", "left_anti")),
    ]


# SQL twins work pair by pair: every record against every document whose name holds all its terms.


def _sql_part(name: str, labelled: bool, condition: str = "true") -> str:
    test = "IN" if labelled else "NOT IN"
    return f"""SELECT * REPLACE ('{name}' AS source) FROM ({SQL['docs']})
WHERE CAST(id AS BIGINT) {test} (SELECT doc_id FROM labels WHERE {condition})"""


def _sql_edges(p: str, left: str, earlier: str) -> str:
    """CTEs ``{p}pair`` (documents met) and ``{p}edge`` (best five entities) for records against earlier documents."""
    tokens = sql_analysed("name", 1)
    return f"""{p}l AS (SELECT id AS left_id, list_sort(list_distinct({tokens})) AS terms, devs, date FROM ({left})),
{p}e AS (SELECT source, id, entity_id, list_sort({tokens}) AS bag, devs, date FROM ({earlier})),
{p}n AS (SELECT entity_id, count(DISTINCT source) AS n_sources FROM {p}e GROUP BY entity_id),
{p}s AS (SELECT source, count(*) AS n_docs, sum(len(bag)) / count(*) AS avg_len FROM {p}e WHERE len(bag) > 0 GROUP BY source),
{p}rt AS (SELECT source, id, len(bag) AS len, term, count(*) AS tf FROM (SELECT *, unnest(bag) AS term FROM {p}e) GROUP BY source, id, bag, term),
{p}df AS (SELECT source, term, count(*) AS df FROM {p}rt GROUP BY ALL),
{p}lt AS (SELECT left_id, len(terms) AS n_terms, unnest(terms) AS term FROM {p}l),
{p}m AS (SELECT left_id, source, id,
  sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avg_len))) AS base
  FROM {p}lt JOIN {p}rt USING (term) JOIN {p}df USING (source, term) JOIN {p}s USING (source)
  GROUP BY left_id, source, id, n_terms HAVING count(*) = n_terms),
{p}pair AS (SELECT m.left_id, e.entity_id, m.source, base,
  CASE WHEN abs(epoch(l.date) - epoch(e.date)) <= 14 * 86400 THEN 0.5 ELSE 0 END AS date_bonus,
  CASE WHEN len(l.devs) > 0 AND list_has_all(e.devs, l.devs) THEN 2.0 ELSE 0 END AS dev_bonus
  FROM {p}m m JOIN {p}l l USING (left_id) JOIN {p}e e ON e.source = m.source AND e.id = m.id),
{p}tot AS (SELECT left_id, entity_id, sum(base + date_bonus + dev_bonus) / any_value(n_sources) AS score
  FROM {p}pair JOIN {p}n USING (entity_id) GROUP BY left_id, entity_id),
{p}edge AS MATERIALIZED (SELECT left_id, entity_id, score FROM (SELECT *, row_number() OVER (PARTITION BY left_id
  ORDER BY round(score, 6) DESC, entity_id) AS n FROM {p}tot) WHERE n <= 5)"""


def _sql_assign(p: str) -> str:
    """Greedy over all edges, best first, one edge per step."""
    return f"""{p}ord AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY round(score, 6) DESC, left_id, entity_id) AS n FROM {p}edge),
{p}step AS (SELECT CAST(0 AS BIGINT) AS n, CAST([] AS VARCHAR[]) AS ls, CAST([] AS VARCHAR[]) AS es, false AS taken
  UNION ALL SELECT o.n, CASE WHEN list_contains(ls, left_id) OR list_contains(es, entity_id) THEN ls ELSE list_append(ls, left_id) END,
  CASE WHEN list_contains(ls, left_id) OR list_contains(es, entity_id) THEN es ELSE list_append(es, entity_id) END,
  NOT (list_contains(ls, left_id) OR list_contains(es, entity_id)) FROM {p}step s JOIN {p}ord o ON o.n = s.n + 1),
{p}match AS MATERIALIZED (SELECT left_id, entity_id, score FROM {p}ord JOIN {p}step USING (n) WHERE taken)"""


def _sql_ids(p: str, left: str) -> str:
    return f"""SELECT r.* REPLACE (coalesce(m.entity_id, sha256(r.source || ':' || r.id)) AS entity_id), m.entity_id IS NOT NULL AS reused
  FROM ({left}) r LEFT JOIN {p}match m ON m.left_id = r.id"""


_LEFT, _RIGHT = _sql_part("left", False), _sql_part("right", True)
_EDGES = _sql_edges("", _LEFT, _RIGHT)


@query(
    "er_candidates",
    f"""WITH {_EDGES} SELECT DISTINCT array_to_string(terms, ' ') AS lkey, m.source, array_to_string(bag, ' ') AS rkey, round(base, 6) AS score
FROM m JOIN l USING (left_id) JOIN e ON e.source = m.source AND e.id = m.id""",
)
def er_candidates(spark, sf):
    """Distinct names only: copies meet once."""
    left, right = sides(spark, sf)
    rows = R.name_candidates(R.left_records(left), R.right_documents(right))
    return rows.withColumn("score", rounded(F.col("score")))


@query("er_edges", f"WITH {_EDGES} SELECT left_id, entity_id, round(score, 6) AS score FROM edge")
def er_edges(spark, sf):
    left, right = sides(spark, sf)
    return R.candidate_edges(left, right, ["right"]).withColumn("score", rounded(F.col("score")))


def _sql_explained(column: str) -> str:
    return f"""WITH {_EDGES} SELECT left_id, edge.entity_id, pair.source, CAST({column} AS DOUBLE) AS {column}
FROM edge JOIN pair USING (left_id, entity_id)"""


def _explained(spark, sf, column):
    left, right = sides(spark, sf)
    edges = R.candidate_edges(left, right, ["right"])
    return R.explain_edges(edges, left, right).where("name_met").select("left_id", "entity_id", "source", column)


@query("er_date_score", _sql_explained("date_bonus"))
def er_date_score(spark, sf):
    return _explained(spark, sf, "date_bonus")


@query("er_dev_score", _sql_explained("dev_bonus"))
def er_dev_score(spark, sf):
    return _explained(spark, sf, "dev_bonus")


_ASSIGNED = f"WITH RECURSIVE {_EDGES}, {_sql_assign('')}"


def matched(spark, sf):
    left, right = sides(spark, sf)
    return left, R.assign_one_to_one(R.candidate_edges(left, right, ["right"], for_matching=True))


@query("er_assign", f"{_ASSIGNED} SELECT left_id, entity_id, round(score, 6) AS score FROM match")
def er_assign(spark, sf):
    return matched(spark, sf)[1].withColumn("score", rounded(F.col("score")))


@query("er_entity_ids", f"{_ASSIGNED} SELECT source, id, entity_id, reused FROM ({_sql_ids('', _LEFT)})")
def er_entity_ids(spark, sf):
    return R.with_entity_ids(*matched(spark, sf)).select("source", "id", "entity_id", "reused")


@query(
    "er_stats",
    f"""{_ASSIGNED} SELECT source, count(*) FILTER (reused) AS reused, count(*) FILTER (NOT reused) AS generated
FROM ({_sql_ids('', _LEFT)}) GROUP BY source""",
)
def er_stats(spark, sf):
    return R.resolution_stats(R.with_entity_ids(*matched(spark, sf)))


_S = [_sql_part("s0", True, "quality = 1"), _sql_part("s1", True, "quality = 0"), _sql_part("s2", False)]
_FIRST = f"SELECT * REPLACE (sha256(source || ':' || id) AS entity_id), false AS reused FROM ({_S[0]})"


@query(
    "er_three_sources",
    f"""WITH RECURSIVE r0 AS MATERIALIZED ({_FIRST}), {_sql_edges("a_", _S[1], "SELECT * FROM r0")}, {_sql_assign("a_")},
r1 AS MATERIALIZED ({_sql_ids("a_", _S[1])}),
{_sql_edges("b_", _S[2], "SELECT * FROM r0 UNION ALL BY NAME SELECT * FROM r1")}, {_sql_assign("b_")}, r2 AS ({_sql_ids("b_", _S[2])})
SELECT source, id, entity_id, reused FROM (SELECT * FROM r0 UNION ALL BY NAME SELECT * FROM r1 UNION ALL BY NAME SELECT * FROM r2)""",
)
def er_three_sources(spark, sf):
    return R.resolve_sources(spark, three_sources(spark, sf)).select("source", "id", "entity_id", "reused")
