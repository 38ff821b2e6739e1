"""Free-form dates read by their parts: numbers and month names, in any order a reader would understand.

A text is cut into numbers and words. A number of four digits is the year, eight digits are year, month and day. Words are month names or
their beginnings (three letters at least) in the given languages, quarters (``q3``) or words that say nothing. What is left are at most two small
numbers: beside a month name they are the day (and a year of two digits); else, after the year, month and day; before it, day and month if
dots stand between them or only that makes a date, otherwise in the order asked for. Where another reading makes another date too, the date is
marked as ambiguous. Texts with any other word or number, without a year, or with a day that does not exist are unreadable.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: month names in calendar order, lower-case and without accents. ---
MONTHS: dict[str, tuple[str, ...]] = {
    "en": ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"),
    "de": ("januar", "februar", "marz", "april", "mai", "juni", "juli", "august", "september", "oktober", "november", "dezember"),
    "es": ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"),
    "fr": ("janvier", "fevrier", "mars", "avril", "mai", "juin", "juillet", "aout", "septembre", "octobre", "novembre", "decembre"),
}
# Words around dates that say nothing: endings of ordinals, articles and prepositions.
SILENT = ("st", "nd", "rd", "th", "er", "the", "of", "den", "der", "am", "de", "del", "el", "le", "du")
# --- End of fixed values. ---

# Two-digit years from this one on are of the last century.
CENTURY = 70


def _sql(words: Sequence[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _month(token: str, months: Mapping[str, Sequence[str]]) -> str:
    """Number of the one month a word begins, NULL for none or several."""
    per_month = [sorted({names[m] for names in months.values()}) for m in range(12)]
    names = ", ".join(f"array({_sql(some)})" for some in per_month)
    fitting = f"filter(sequence(1, 12), n -> exists(element_at(array({names}), n), m -> startswith(m, {token})))"
    return f"transform(array({fitting}), f -> IF(length({token}) >= 3 AND size(f) = 1, f[0], NULL))[0]"


def date_parts(text: str, day_first: bool = True, months: Mapping[str, Sequence[str]] = MONTHS) -> Column:
    """``struct<date: timestamp, precision: string, ambiguous: boolean>`` of a text column; NULL if it is unreadable.

    ``precision`` is ``day``, ``month``, ``quarter`` or ``year``; the date is the first day of it.
    """
    plain = f"translate(lower(coalesce({text}, '')), 'äáàâéèêëíîïóôúùûüñç', 'aaaaeeeeiiioouuuunc')"
    # Whatever is neither a token nor a common sign makes the text unreadable. Lambdas name what is used more than once.
    state = f"""transform(array({plain}), p -> transform(array(regexp_extract_all(p, 'q[1-4]\\\\b|[a-z]+|[0-9]+', 0)), c -> named_struct(
      'clean', p RLIKE '^[a-z0-9 .,/\\\\-]*$', 'dots', p RLIKE '[0-9]\\\\.[ ]?[0-9]',
      'months', transform(filter(c, t -> NOT t RLIKE '[0-9]' AND t NOT IN ({_sql(SILENT)})), t -> {_month("t", months)}),
      'quarters', transform(filter(c, t -> t RLIKE '^q[1-4]$'), t -> cast(substring(t, 2, 1) AS int)),
      'years', transform(filter(c, t -> t RLIKE '^[1-9][0-9]{{3}}$'), t -> cast(t AS int)),
      'whole', filter(c, t -> t RLIKE '^[0-9]{{8}}$'),
      'strange', exists(c, t -> t RLIKE '^[0-9]+$' AND NOT t RLIKE '^([0-9]{{1,2}}|[1-9][0-9]{{3}}|[0-9]{{8}})$'),
      'small', transform(filter(c, t -> t RLIKE '^[0-9]{{1,2}}$'), t -> cast(t AS int)),
      'leads', coalesce(get(c, 0), '') RLIKE '^[1-9][0-9]{{3}}$'))[0])"""
    return F.get(F.transform(F.expr(state), lambda s: _choose(s, day_first)), F.lit(0))


def _choose(s: Column, day_first: bool) -> Column:
    small, years = s["small"], s["years"]
    a, b = F.get(small, F.lit(0)), F.get(small, F.lit(1))
    n_small, n_years, n_months = F.size(small), F.size(years), F.size(s["months"])
    year, month = F.get(years, F.lit(0)), F.get(s["months"], F.lit(0))
    named = (n_months == 1) & month.isNotNull() & (F.size(s["quarters"]) == 0) & (F.size(s["whole"]) == 0)
    bare = (n_months == 0) & (F.size(s["quarters"]) == 0) & (F.size(s["whole"]) == 0)
    short_year = F.when(b >= CENTURY, b + 1900).otherwise(b + 2000)
    fits = lambda m, d: m.between(1, 12) & d.between(1, 31)
    # Before the year: dots stand for day first; else the order that makes a date, or the one asked for.
    usual = s["dots"] | (F.lit(day_first) & fits(b, a)) | ~fits(a, b)
    both = fits(a, b) & fits(b, a) & (a != b)

    def reading(y: Column, m: Column, d: Column, precision: str, unsure: Column) -> Column:
        day = F.try_to_timestamp(F.format_string("%04d-%02d-%02d", y, m, d), F.lit("yyyy-MM-dd"))
        return F.when(day.isNotNull(), F.struct(day.alias("date"), F.lit(precision).alias("precision"), unsure.alias("ambiguous")))

    one, sure = F.lit(1), F.lit(False)
    whole = F.get(s["whole"], F.lit(0))
    digits = lambda i, n: F.substring(whole, i, n).cast("int")
    found = (
        F.when(named & (n_years == 1) & (n_small == 1), reading(year, month, a, "day", sure))
        .when(named & (n_years == 1) & (n_small == 0), reading(year, month, one, "month", sure))
        .when(named & (n_years == 0) & (n_small == 2), reading(short_year, month, a, "day", F.lit(True)))
        .when(
            (F.size(s["quarters"]) == 1) & (n_months == 0) & (n_years == 1) & (n_small == 0) & (F.size(s["whole"]) == 0),
            reading(year, F.get(s["quarters"], F.lit(0)) * 3 - 2, one, "quarter", sure),
        )
        .when(bare & (n_years == 1) & (n_small == 2) & s["leads"] & fits(a, b), reading(year, a, b, "day", sure))
        .when(bare & (n_years == 1) & (n_small == 2) & s["leads"], reading(year, b, a, "day", F.lit(True)))
        .when(bare & (n_years == 1) & (n_small == 2) & usual, reading(year, b, a, "day", both & ~s["dots"]))
        .when(bare & (n_years == 1) & (n_small == 2), reading(year, a, b, "day", both))
        .when(bare & (n_years == 1) & (n_small == 1), reading(year, a, one, "month", sure))
        .when(bare & (n_years == 1) & (n_small == 0), reading(year, one, one, "year", sure))
        .when((F.size(s["whole"]) == 1) & (n_months + n_years + n_small + F.size(s["quarters"]) == 0), reading(digits(1, 4), digits(5, 2), digits(7, 2), "day", sure))
    )
    return F.when(s["clean"] & ~s["strange"], found)


def parse_date_by_parts(text: str, coming_soon: Column, day_first: bool = True, months: Mapping[str, Sequence[str]] = MONTHS) -> Column:
    """The date alone; NULL if unreleased, empty or unreadable."""
    return F.when(~F.coalesce(coming_soon, F.lit(False)), date_parts(text, day_first, months)["date"])
