"""Column-in, column-out expressions. All of them stay inside Catalyst."""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The business vocabulary and thresholds of the metric definitions.
VALID_EVENT_TYPES = ("view", "search", "cart", "favorite", "order", "pay")
AGE_BANDS = ((25, "18-24"), (35, "25-34"), (45, "35-44"))
AGE_REST = "45+"
RECENCY_BANDS = ((7, 5), (30, 4), (60, 3), (90, 2))
FREQUENCY_BANDS = ((10, 5), (5, 4), (3, 3), (2, 2))
MONETARY_BANDS = ((10000, 5), (5000, 4), (2000, 3), (500, 2))
LOWEST_SCORE = 1
HIGH_VALUE = "高价值用户"
PROMISING = "潜力用户"
CHURN_RISK = "流失风险用户"
ORDINARY = "一般用户"
UNKNOWN_CATEGORY = "unknown"
USER_PREFIX = "syn_u_"
SKU_PREFIX = "syn_sku_"
EVENT_ID_SEPARATOR = "||"
EVENT_ID_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def clean_text(column: Column | str) -> Column:
    """Status and type texts compare trimmed and in lower case."""
    return F.lower(F.trim(column))


def day_of(column: Column | str) -> Column:
    """The calendar day of a time value as ``yyyy-MM-dd`` text."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("date").cast("string")


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Ratio as double; 0.0 for a zero denominator, null for a null one."""
    below = denominator.cast("double")
    return F.when(below == 0, F.lit(0.0)).otherwise(numerator.cast("double") / below)


def banded(
    column: Column,
    compare: Callable[[Column, object], Column],
    bands: Sequence[tuple[object, object]],
    rest: object,
) -> Column:
    """Label of the first band whose bound the value satisfies, else ``rest``.

    A null value satisfies no bound, so it gets ``rest``.
    """
    cases = F
    for bound, label in bands:
        cases = cases.when(compare(column, bound), label)
    return cases.otherwise(rest)


def age_group(age: Column) -> Column:
    return banded(age, operator.lt, AGE_BANDS, AGE_REST)


def recency_score(days: Column) -> Column:
    return banded(days, operator.le, RECENCY_BANDS, LOWEST_SCORE)


def frequency_score(orders: Column) -> Column:
    return banded(orders, operator.ge, FREQUENCY_BANDS, LOWEST_SCORE)


def monetary_score(amount: Column) -> Column:
    return banded(amount, operator.ge, MONETARY_BANDS, LOWEST_SCORE)


def score_segment(r: Column, f: Column, m: Column) -> Column:
    """Customer segment from the three 1..5 scores."""
    return (
        F.when(F.least(r, f, m) >= 4, HIGH_VALUE)
        .when((r >= 4) & (f >= 3), PROMISING)
        .when(r <= 2, CHURN_RISK)
        .otherwise(ORDINARY)
    )


def threshold_segment(days: Column, orders: Column, amount: Column) -> Column:
    """Customer segment straight from recency, frequency and monetary value."""
    return (
        F.when((days <= 7) & (orders >= 10) & (amount >= 10000), HIGH_VALUE)
        .when((days <= 30) & (orders >= 3), PROMISING)
        .when(days > 60, CHURN_RISK)
        .otherwise(ORDINARY)
    )


def query_hash(text: Column) -> Column:
    """SHA-256 of a search text; null stays null, empty text is hashed."""
    return F.sha2(text, 256)


def content_event_id(
    dataset: Column, source: Column, client: Column, time: Column, sku: Column, url: Column, text_hash: Column
) -> Column:
    """Content-addressed event id: equal payloads in one second share it."""
    parts = [
        dataset,
        source,
        client.cast("string"),
        F.date_format(time, EVENT_ID_TIME_FORMAT),
        *(F.coalesce(part.cast("string"), F.lit("")) for part in (sku, url, text_hash)),
    ]
    return F.sha2(F.concat_ws(EVENT_ID_SEPARATOR, *parts), 256)


def missing_any(columns: Sequence[str]) -> Column:
    """True when any of the columns is null or blank text."""
    return reduce(operator.or_, (F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "") for c in columns))


def clean_value(column: Column) -> Column:
    """Report form of a double: NaN and infinities become null, six decimals."""
    magnitude = F.abs(column)
    return F.when(~F.isnan(column) & (magnitude != float("inf")), F.round(column, 6))


def lenient_cast(column: Column, source_type: str, target_type: str) -> Column:
    """Cast where malformed text becomes null instead of failing the job.

    Whole numbers go through double first, so ``'17.0'`` is read as 17.
    """
    if source_type == target_type:
        return column
    if source_type == "string" and target_type in ("int", "bigint"):
        whole = column.try_cast(target_type)
        return F.coalesce(whole, column.try_cast("double").try_cast(target_type))
    return column.try_cast(target_type)
