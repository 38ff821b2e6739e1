"""Reader of graded relevance suites.

A suite is text: blank lines, ``# comments``, ``query <text>`` headers and ``<grade> <source> <id>`` entries that belong to
the header above them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed value: the word that opens a header.
HEADER = "query"
# Names of sources and documents.
_NAME = r"^[\p{L}\p{N}_]+$"
_BLANKS = r"[ \t\f]+"


def _content(line: Column) -> Column:
    """A line without its comment and outer white space."""
    return F.regexp_replace(F.regexp_replace(F.split_part(line, F.lit("#"), F.lit(1)), r"^\s+", ""), r"\s+$", "")


def _parts(content: Column) -> Column:
    return F.split(content, _BLANKS)


def _header_text(content: Column) -> Column:
    """What follows the opening word of a header, or NULL."""
    opened = F.lower(F.get(_parts(content), F.lit(0))) == HEADER
    rest = F.regexp_replace(F.substring(content, len(HEADER) + 1, 1 << 30), r"^\s+", "")
    return F.when(opened & (rest != ""), rest)


def _is_entry(content: Column) -> Column:
    """Three parts: a whole number, a source and a document."""
    parts = _parts(content)
    grade, source, document = (F.get(parts, F.lit(i)) for i in range(3))
    return (F.size(parts) == 3) & (F.translate(grade, "0123456789", "") == "") & source.rlike(_NAME) & document.rlike(_NAME)


def read_suite_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines as ``(suite, block, pos, line)``: file, byte offset of the file split, order inside the split.

    Large suites stay split over tasks; the triple orders all lines of a file.
    """
    return (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("suite"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos"),
            F.col("value").alias("line"),
        )
    )


def _carry(value: Column, window) -> Column:
    return F.last(value, ignorenulls=True).over(window)


def parse_suite(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(queries, judgements)``; headers without entries are queries too. Bad lines fail with their line number.

    ``query_id`` is a running number over all suites, so that queries of several files never share one.

    A header is carried forward inside its block, and from block to block through a summary of one row per block, so no
    task needs a whole suite.
    """
    inside = Window.partitionBy("suite", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    parsed = lines.select("suite", "block", "pos", _content(F.col("line")).alias("line"))
    parsed = parsed.withColumn("query", _header_text(F.col("line"))).withColumn("n", F.row_number().over(inside))
    parsed = parsed.withColumn("n_queries", F.count("query").over(inside)).withColumn("own", _carry(F.col("query"), inside))

    blocks = parsed.groupBy("suite", "block").agg(
        F.count(F.lit(1)).alias("lines"), F.count("query").alias("headers"), F.max_by("own", "pos").alias("last")
    )
    # Query numbers run on over suites in the order of their names: one row per suite.
    suites = blocks.groupBy("suite").agg(F.sum("headers").alias("headers"))
    earlier = Window.orderBy("suite").rowsBetween(Window.unboundedPreceding, -1)
    suites = suites.select("suite", F.coalesce(F.sum("headers").over(earlier), F.lit(0)).alias("suites_before"))
    before = Window.partitionBy("suite").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "suite",
        "block",
        F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("lines_before"),
        F.coalesce(F.sum("headers").over(before), F.lit(0)).alias("headers_before"),
        _carry(F.col("last"), before).alias("carried"),
    )
    placed = parsed.join(blocks, ["suite", "block"]).join(suites, "suite").select(
        "suite",
        (F.col("lines_before") + F.col("n")).alias("line_no"),
        "line",
        "query",
        (F.col("suites_before") + F.col("headers_before") + F.col("n_queries")).cast("int").alias("query_id"),
        F.coalesce("own", "carried").alias("owner"),
    )

    is_entry = _is_entry(F.col("line"))
    where = F.concat(F.lit(" (line "), F.col("line_no").cast("string"), F.lit(" of "), F.col("suite"), F.lit(")"))
    late = F.raise_error(F.concat(F.lit("this judgement belongs to no query"), where))
    broken = F.raise_error(F.concat(F.lit("neither a query nor a judgement"), where))
    kind = (
        F.when(F.col("line") == "", "skip")
        .when(F.col("query").isNotNull(), "query")
        .when(is_entry & F.col("owner").isNull(), late.cast("string"))
        .when(is_entry, "entry")
        .otherwise(broken.cast("string"))
    )
    checked = placed.withColumn("kind", kind)
    # Judgements also look at headers and blanks, so that a bad line is met whichever output is used.
    queries = checked.where(F.col("kind") == "query").select("suite", "query_id", "query", "line_no")
    judgements = checked.where(F.col("kind") == "entry").select(
        "suite",
        "query_id",
        F.col("owner").alias("query"),
        F.get(_parts(F.col("line")), F.lit(0)).cast("int").alias("relevance"),
        F.get(_parts(F.col("line")), F.lit(1)).alias("source"),
        F.get(_parts(F.col("line")), F.lit(2)).alias("id"),
        "line_no",
    )
    return queries, judgements


def read_judgements(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    return parse_suite(read_suite_lines(spark, path))
