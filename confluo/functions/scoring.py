"""Score formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

K1 = 1.2
B = 0.75
SCORE_DIGITS = 6


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(F.lit(1.0) + (n_docs - df + F.lit(0.5)) / (df + F.lit(0.5)))


def tf_part(tf: Column, length: Column, avg_len: Column) -> Column:
    return tf * F.lit(K1 + 1.0) / (tf + F.lit(K1) * (F.lit(1.0 - B) + F.lit(B) * length / avg_len))


def rounded(score: Column) -> Column:
    """Scores are compared after rounding, so that the order of a sum never decides a rank."""
    return F.round(score, SCORE_DIGITS)


def gain_at(grade: Column, rank: Column) -> Column:
    """Discounted gain: the first row counts in full, row p >= 2 by 1 / log2(p)."""
    return F.when(rank == 1, grade.cast("double")).otherwise(grade / F.log2(rank))
