"""Free-form dates by their parts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from confluo.functions.dates import MONTHS, date_parts, parse_date_by_parts

READ = {
    "21 Aug, 2012": ("2012-08-21", "day", False), "Aug 21st, 2012": ("2012-08-21", "day", False), "21.08.2012": ("2012-08-21", "day", False),
    "3.4.2012": ("2012-04-03", "day", False), "2012/08/21": ("2012-08-21", "day", False), "2012-3-4": ("2012-03-04", "day", False),
    "20120821": ("2012-08-21", "day", False), "08/21/2012": ("2012-08-21", "day", False), "21/08/2012": ("2012-08-21", "day", False),
    "03/04/2012": ("2012-04-03", "day", True), "04/04/2012": ("2012-04-04", "day", False), "2012/21/08": ("2012-08-21", "day", True),
    "Q3 2021": ("2021-07-01", "quarter", False), "2021 q1": ("2021-01-01", "quarter", False), "August 2012": ("2012-08-01", "month", False),
    "08/2012": ("2012-08-01", "month", False), "2012": ("2012-01-01", "year", False), "21. März 2012": ("2012-03-21", "day", False),
    "1er février 2012": ("2012-02-01", "day", False), "le 14 août 2012": ("2012-08-14", "day", False), "3 de enero de 2012": ("2012-01-03", "day", False),
    "den 24. Dezember 1999": ("1999-12-24", "day", False), "29 Feb 2012": ("2012-02-29", "day", False), "3 May 99": ("1999-05-03", "day", True), "3 May 12": ("2012-05-03", "day", True),
}
NOT_READ = [
    "", None, "soon", "Coming 2021", "29 Feb 2011", "31.04.2012", "2012-13-14", "12", "1 2 3 2012", "2012 2013", "jui 2012", "ma 2012", "May June 2012", "99999", "Q5 2012", "2012!", "0/0/2012", "March", "Q1 Q2 2012", "12345 2012",
]


def test_readable_and_unreadable_texts(spark):
    rows = spark.createDataFrame(list(enumerate([*READ, *NOT_READ])), "n int, text string")
    got = {r.text: r for r in rows.select("text", date_parts("text").alias("p"), F.date_format(date_parts("text")["date"], "yyyy-MM-dd").alias("day")).collect()}
    assert {t: got[t].day and (got[t].day, got[t].p.precision, got[t].p.ambiguous) for t in READ} == READ
    assert [t for t in NOT_READ if got[t].p is not None] == []


def test_order_that_is_asked_for(spark):
    rows = spark.createDataFrame([("03/04/2012",), ("13/04/2012",), ("3.4.2012",)], "text string")
    got = [r[0] for r in rows.select(F.date_format(date_parts("text", day_first=False)["date"], "yyyy-MM-dd")).collect()]
    assert got == ["2012-03-04", "2012-04-13", "2012-04-03"]


def test_unreleased(spark):
    rows = spark.createDataFrame([("2012", True), ("2012", False), ("2012", None)], "text string, soon boolean")
    assert [r[0] is None for r in rows.select(parse_date_by_parts("text", F.col("soon"))).collect()] == [True, False, False]


@pytest.mark.parametrize("lang", list(MONTHS))
def test_every_month_name_and_its_beginning(spark, lang):
    rows = spark.createDataFrame([(i, f"5 {form} 2020") for i, name in enumerate(MONTHS[lang], 1) for form in {name, name[:4], name.title()}], "n int, text string")
    got = [(r.n, r.m) for r in rows.select("n", F.month(date_parts("text")["date"]).alias("m")).collect()]
    assert all(n == m for n, m in got)
