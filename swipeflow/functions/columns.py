"""Scalar column expressions (all JVM-side built-ins, no UDFs).

Each helper returns a ``Column``; jobs compose them inside ``select`` /
``withColumn`` so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c) -> Column:
    """ISO-8601 text (``...Z``) to timestamp; unparseable text gives NULL."""
    return F.try_to_timestamp(col(c))


def parse_date(c) -> Column:
    return F.try_to_date(col(c))


def norm_upper(c) -> Column:
    return F.upper(F.trim(col(c)))


def norm_lower(c) -> Column:
    return F.lower(F.trim(col(c)))


def positive_or_null(c) -> Column:
    """Amounts <= 0 become NULL; NULL stays NULL."""
    c = col(c)
    return F.when(c > 0, c)


def is_weekend(dow) -> Column:
    return col(dow).isin(*K.WEEKEND_DAYS)


def is_late_night(hour) -> Column:
    return col(hour).between(K.LATE_NIGHT_FIRST_HOUR, K.LATE_NIGHT_LAST_HOUR)


def count_true(c) -> Column:
    """Aggregate: number of rows where a boolean column is true."""
    return F.sum(col(c).cast("long"))


def rquot_sql(num: str, den: str, mult: int, scale: int) -> str:
    """SQL text for ``sign(num) * round_half_up(|num| * mult / den) / scale``.

    Exact DECIMAL(38, 0) arithmetic until the last division, so money and
    counts of any size that a table can hold neither overflow nor depend on
    how an engine rounds doubles at .5. NULL when ``den`` is NULL or 0.
    ``num``/``den`` are integer-valued SQL expressions; ``den`` must be positive.
    """
    n, d = f"CAST(({num}) AS DECIMAL(28,0))", f"CAST(({den}) AS DECIMAL(28,0))"
    return (
        f"CASE WHEN {d} IS NULL OR {d} = 0 OR {n} IS NULL THEN NULL "
        f"ELSE CAST(CAST(sign({n}) AS INT) * ((abs({n}) * {2 * mult} + {d}) div ({d} * 2)) AS DOUBLE)"
        f" / {scale} END"
    )


def cents_sql(money: str) -> str:
    """A DECIMAL(_, 2) amount as an exact whole number of cents."""
    return f"CAST(({money}) * 100 AS DECIMAL(28,0))"


def rquot(num: str, den: str, mult: int, scale: int) -> Column:
    return F.expr(rquot_sql(num, den, mult, scale))


def ratio(num: str, den: str, places: int = 4) -> Column:
    """round(num / den, places) for integer inputs (exact, half up)."""
    return rquot(num, den, 10**places, 10**places)


def mean_money(sum_money: str, count: str) -> Column:
    """Average of a money column as a double rounded to 4 places (exact)."""
    return rquot(cents_sql(sum_money), count, 100, 10**4)


def money_ratio(a: str, b: str, places: int = 4) -> Column:
    """round(a / b, places) for two DECIMAL(_, 2) amounts; NULL if b = 0."""
    return rquot(cents_sql(a), cents_sql(b), 10**places, 10**places)


def rate_pct(num: str, den: str, places: int = 2) -> Column:
    """round(num / den * 100, places) for counts (exact, half up)."""
    return rquot(num, den, 100 * 10**places, 10**places)


def units(x: str, places: int = 4) -> str:
    """SQL text: a double already rounded to ``places`` as exact integer units."""
    return f"CAST(round(({x}) * {10**places}) AS BIGINT)"


def risk_tier(fraud_count) -> Column:
    c = col(fraud_count)
    return (
        F.when(c >= K.RISK_TIER_HIGH, "HIGH").when(c >= K.RISK_TIER_MEDIUM, "MEDIUM").otherwise("LOW")
    )


def alert_severity(fraud_count) -> Column:
    c = col(fraud_count)
    return (
        F.when(c >= K.SEVERITY_CRITICAL, "CRITICAL")
        .when(c >= K.SEVERITY_HIGH, "HIGH")
        .when(c >= K.SEVERITY_MEDIUM, "MEDIUM")
        .otherwise("LOW")
    )


def score_band(prob) -> Column:
    c = col(prob)
    return (
        F.when(c >= K.BAND_VERY_HIGH, "VERY_HIGH")
        .when(c >= K.BAND_HIGH, "HIGH")
        .when(c >= K.BAND_MEDIUM, "MEDIUM")
        .otherwise("LOW")
    )


def rfm_segment(r, f, m) -> Column:
    r, f, m = col(r), col(f), col(m)
    return (
        F.when(r.isNull() | f.isNull() | m.isNull(), K.SEG_NO_ACTIVITY)
        .when((r >= 4) & (f >= 4) & (m >= 4), K.SEG_CHAMPIONS)
        .when((r >= 3) & (f >= 3), K.SEG_LOYAL)
        .when(r >= 4, K.SEG_RECENT)
        .when((f <= 2) & (m >= 3), K.SEG_AT_RISK_BIG)
        .otherwise(K.SEG_NEEDS_ATTENTION)
    )


def day_date(y, m, d) -> Column:
    """Date from parts; NULL parts give NULL (no text round trip)."""
    return F.make_date(col(y), col(m), col(d))


def hour_ts(y, m, d, h) -> Column:
    return F.try_make_timestamp(col(y), col(m), col(d), col(h), F.lit(0), F.lit(0))


def month_label(y, m) -> Column:
    return F.concat(col(y).cast("string"), F.lit("-"), F.lpad(col(m).cast("string"), 2, "0"))


def as_of_ts(as_of: str) -> Column:
    """A fixed 'now' (UTC) so reruns are deterministic."""
    return F.to_timestamp(F.lit(as_of))


def as_of_date(as_of: str) -> Column:
    return F.to_date(F.lit(as_of))


def money_text(c) -> Column:
    """``$1,234.50`` style text."""
    c = col(c)
    return F.when(c.isNotNull(), F.concat(F.lit("$"), F.format_string("%,.2f", c.cast("double"))))


def md5_long(*cols: str) -> Column:
    """A 60-bit number from the md5 of the columns' text (joined by ``|``); NULL if any is NULL.
    The same number in any engine that has md5."""
    text = F.concat_ws("|", *[col(c).cast("string") for c in cols])
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")
    some_null = reduce(lambda a, b: a | b, [col(c).isNull() for c in cols])
    return F.when(~some_null, number)


def landing_day(c) -> Column:
    """Zero-padded ``yyyy/MM/dd`` landing folder of a date or timestamp."""
    return F.date_format(col(c), "yyyy/MM/dd")
