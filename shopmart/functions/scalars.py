"""Lenient parsing, money and calendar expressions, as Spark SQL text.

Each function takes SQL expressions (a column name at the simplest) and returns one, for
``selectExpr``, ``F.expr`` or plain SQL.

Spark runs in ANSI mode, where a bad cast or a zero divisor fails the job. Everything that
meets raw data here uses the ``try_`` forms and yields null instead.
"""

from __future__ import annotations


# Cents of amounts below this fit 64 bits.
MOST_MONEY = "9.2E16D"


def text_literal(text: str) -> str:
    """A text as SQL literal, whatever quotes it holds."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column_name(name: str) -> str:
    """A column's name as SQL identifier, whatever it is made of."""
    return "`" + name.replace("`", "``") + "`"


def is_missing(value: str, dtype: str) -> str:
    """Null test that also counts NaN, which Spark keeps apart from null."""
    return f"({value} IS NULL OR isnan({value}))" if dtype in ("double", "float") else f"({value} IS NULL)"


def lenient_number(value: str) -> str:
    """Number or null. NaN becomes null as well, since it would compare above everything.

    Text must be a plain decimal number: a cast alone takes type suffixes such as in ``12d``.
    """
    plain = rf"'^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$|(?i)^\\s*[+-]?inf(inity)?\\s*$'"
    fits = f"(typeof({value}) <> 'string' OR CAST({value} AS STRING) RLIKE {plain})"
    return f"if({fits}, nullif(try_cast({value} AS DOUBLE), double('NaN')), NULL)"


def lenient_timestamp(value: str) -> str:
    """Moment or null. Text must start with a year: a bare time of day would become today's."""
    fits = f"(typeof({value}) <> 'string' OR CAST({value} AS STRING) RLIKE '^\\\\s*[+-]?\\\\d{{4,6}}(-|\\\\s*$)')"
    return f"if({fits}, try_cast({value} AS TIMESTAMP), NULL)"


# Forms in which a feed may write a date, tried in this order where votes are equal.
# Month before day comes first, as in most readers; a day above 12 decides otherwise.
ISO = "iso"
DATE_FORMATS = {
    ISO: None,
    "month/day/year": "M/d/yyyy[ H:mm[:ss]]",
    "day/month/year": "d/M/yyyy[ H:mm[:ss]]",
    "year/month/day": "yyyy/M/d[ H:mm[:ss]]",
    "yearmonthday": "yyyyMMdd[ HH:mm[:ss]]",
    "month-day-year": "M-d-yyyy[ H:mm[:ss]]",
    "day-month-year": "d-M-yyyy[ H:mm[:ss]]",
    "day.month.year": "d.M.yyyy[ H:mm[:ss]]",
    "month name day, year": "MMM d, yyyy[ H:mm[:ss]]",
    "day month name year": "d MMM yyyy[ H:mm[:ss]]",
}


def moment_as(value: str, form: str) -> str:
    """Moment or null, by one of ``DATE_FORMATS``."""
    pattern = DATE_FORMATS[form]
    return lenient_timestamp(value) if pattern is None else f"try_to_timestamp(trim(CAST({value} AS STRING)), '{pattern}')"


def lenient_money(value: str) -> str:
    """Amount or null: also null if infinite or beyond what whole cents can hold."""
    number = lenient_number(value)
    return f"if(abs({number}) < {MOST_MONEY}, {number}, NULL)"


def clip(value: str, low: float, high: float) -> str:
    """Bound a value and keep null; ``greatest``/``least`` would replace null by the bound."""
    # Adding 0 turns -0.0 into 0.0, so equal amounts also have equal bits.
    return f"CASE WHEN {value} < {low}D THEN {low}D WHEN {value} > {high}D THEN {high}D ELSE {value} + 0D END"


def cents(value: str) -> str:
    """Money in whole cents. Sums of cents do not depend on the order of addition.

    Null for what no BIGINT of cents holds: an infinite amount must not end a job.
    """
    return f"try_cast(round({value} * 100) AS BIGINT)"


def money_sum(value: str) -> str:
    """Aggregate: exact sum of a money column, in currency units."""
    return f"sum({cents(value)}) / 100"


def money_avg(value: str) -> str:
    """Aggregate: mean of a money column, in currency units, rounded to the cent.

    Rounding whole cents decides ties on exact halves, which two-decimal doubles cannot hold.
    """
    return f"round(try_divide(sum({cents(value)}), count({value}))) / 100"


def half_even(value: str, places: int) -> str:
    """Round to even on the scaled double, the rule of array libraries (SQL rounds half up)."""
    scale = f"{10.0**places}D"
    return f"rint(({value}) * {scale}) / {scale}"


def line_total_cents(unit_cents: str, quantity: str, discount: str) -> str:
    """Price of a line in cents after its discount, cut to whole cents."""
    return f"({unit_cents} * {quantity} * (100 - {cents(discount)})) DIV 100"


def percent_cents(amount_cents: str, percent: str) -> str:
    """A whole percentage of an amount in cents, cut to whole cents."""
    return f"({amount_cents} * ({percent})) DIV 100"


def add_hours(moment: str, hours: str) -> str:
    return f"{moment} + make_dt_interval(0, CAST({hours} AS INT))"


def month_start(day: str) -> str:
    return f"trunc({day}, 'MM')"


def months_apart(later: str, earlier: str, wrap: bool = False) -> str:
    """Whole months between two month starts; ``wrap`` keeps only the month part of the age."""
    months = f"CAST(months_between({later}, {earlier}) AS INT)"
    return f"{months} % 12" if wrap else months
