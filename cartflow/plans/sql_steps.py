"""The marts as ordered SQL steps (S10), beside the function form.

A step is a named statement over named inputs.  Inputs are DataFrames that the caller
gives or results of earlier steps; they are passed to ``spark.sql`` as named arguments, so
no view is registered and nothing is left in the catalog.  Before anything runs, the whole
list is checked: every input must be given or made by an earlier step, every placeholder
must be an input, and no two steps may make the same table.
"""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Step:
    """``sql`` names its inputs in braces, and parameters as ``:name``."""

    makes: str
    sql: str

    @property
    def inputs(self) -> set[str]:
        return {name for _, name, _, _ in string.Formatter().parse(self.sql) if name}


class StepError(ValueError):
    """The steps cannot run in this order."""


def check_steps(steps: Sequence[Step], given: Sequence[str]) -> None:
    """Raise StepError naming the first step that cannot run."""
    known = set(given)
    for step in steps:
        if step.makes in known:
            raise StepError(f"{step.makes} is made twice")
        if missing := sorted(step.inputs - known):
            later = [m for m in missing if any(s.makes == m for s in steps)]
            raise StepError(f"{step.makes} needs {', '.join(missing)}" + (f", and {', '.join(later)} comes later" if later else ""))
        known.add(step.makes)


def run_steps(
    spark: SparkSession, steps: Sequence[Step], given: Mapping[str, DataFrame], parameters: Mapping[str, object] | None = None
) -> dict[str, DataFrame]:
    """The tables of all steps by name.  ``parameters`` are bound, not pasted."""
    check_steps(steps, list(given))
    tables = dict(given)
    for step in steps:
        tables[step.makes] = spark.sql(step.sql, args=dict(parameters or {}), **{name: tables[name] for name in step.inputs})
    return {step.makes: tables[step.makes] for step in steps}


_COUNTS = """
    count_if(event_type = 'view') AS views_cnt,
    count_if(event_type = 'cart') AS carts_cnt,
    count_if(event_type = 'purchase') AS purchases_cnt,
    sum(if(event_type = 'purchase', price, 0D)) AS revenue"""

#: Inputs: shop (canonical events) and shop_sessions (the same with session ids, which no
#: plain statement gives at scale: ``sessions.sessionize``).
MART_STEPS = (
    Step("fct_events", "SELECT to_date(event_time) AS event_date, * FROM {shop}"),
    Step(
        "fct_sessions",
        f"""
SELECT session_id, user_id, session_start, session_end, events_cnt, views_cnt, carts_cnt, purchases_cnt, purchase_flag, revenue,
       CAST(unix_date(to_date(session_end)) - unix_date(to_date(session_start)) AS BIGINT) * 1440
       + (hour(session_end) - hour(session_start)) * 60 + minute(session_end) - minute(session_start) AS session_duration_minutes,
       distinct_products_cnt, distinct_categories_cnt
FROM (
    SELECT session_id, user_id, min(event_time) AS session_start, max(event_time) AS session_end, count(*) AS events_cnt,{_COUNTS},
           max(CAST(event_type <=> 'purchase' AS INT)) AS purchase_flag,
           count(DISTINCT product_id) AS distinct_products_cnt, count(DISTINCT category_id) AS distinct_categories_cnt
    FROM {{shop_sessions}} GROUP BY session_id, user_id
)""",
    ),
    Step(
        "mart_funnel_daily",
        f"""
SELECT event_date, category_code, brand, views_cnt, carts_cnt, purchases_cnt,
       try_divide(carts_cnt, views_cnt) AS view_to_cart_rate,
       try_divide(purchases_cnt, carts_cnt) AS cart_to_purchase_rate,
       try_divide(purchases_cnt, views_cnt) AS purchase_conversion_rate, revenue
FROM (SELECT event_date, category_code, brand,{_COUNTS} FROM {{fct_events}} GROUP BY ALL)
WHERE :since IS NULL OR event_date >= :since""",
    ),
    Step(
        "mart_retention",
        """
WITH months AS (
    SELECT DISTINCT user_id, CAST(date_trunc('month', event_time) AS DATE) AS order_month
    FROM {fct_events} WHERE event_type = 'purchase' AND user_id IS NOT NULL
),
placed AS (SELECT m.*, f.cohort_month FROM months AS m JOIN (
    SELECT user_id, min(order_month) AS cohort_month FROM months GROUP BY user_id) AS f USING (user_id)),
cells AS (SELECT cohort_month, order_month, count(*) AS active_users FROM placed WHERE cohort_month IS NOT NULL GROUP BY ALL),
sizes AS (SELECT cohort_month, active_users AS cohort_size FROM cells WHERE order_month = cohort_month)
SELECT cohort_month, order_month,
       CAST(12 * (year(order_month) - year(cohort_month)) + month(order_month) - month(cohort_month) AS BIGINT) AS months_since_first_purchase,
       active_users, cohort_size, active_users / cohort_size AS retention_rate
FROM cells JOIN sizes USING (cohort_month)""",
    ),
    Step(
        "mart_product_conversion",
        f"""
SELECT product_id, category_code, brand, views_cnt, carts_cnt, purchases_cnt, revenue,
       try_divide(purchases_cnt, views_cnt) AS conversion_rate
FROM (SELECT product_id, category_code, brand,{_COUNTS} FROM {{fct_events}} GROUP BY ALL)""",
    ),
)
