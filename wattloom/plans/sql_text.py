"""SQL text of the first three questions, over a view with columns entity, m1, m2, year, month
and hour. They return the same rows as the DataFrame operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

ANNUAL_STATS = """
SELECT year AS date, entity,
       avg(m1) AS m1_mean, min(m1) AS m1_min, max(m1) AS m1_max,
       avg(m2) AS m2_mean, min(m2) AS m2_min, max(m2) AS m2_max
FROM IDENTIFIER(:readings)
GROUP BY year, entity
ORDER BY entity, date
"""

MONTHLY_TOP = """
WITH monthly AS (
  SELECT concat(year, '_', lpad(month, 2, '0')) AS date, avg(m1) AS m1_mean, avg(m2) AS m2_mean
  FROM IDENTIFIER(:readings)
  GROUP BY year, month
),
entries AS (
  SELECT date, m1_mean, m2_mean,
         stack(4, concat(:first, '_desc'), -m1_mean, concat(:first, '_asc'), m1_mean,
                  concat(:second, '_desc'), -m2_mean, concat(:second, '_asc'), m2_mean)
         AS (rank_type, score)
  FROM monthly
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY rank_type ORDER BY score, date) AS rank_num
  FROM entries
  WHERE score IS NOT NULL AND NOT isnan(score)
)
SELECT rank_type, rank_num, date, m1_mean, m2_mean FROM ranked WHERE rank_num <= :n
"""

HOURLY_FIVE_NUMBERS = """
WITH summaries AS (
  SELECT entity,
         min(m1_mean) AS min1, percentile(m1_mean, array(0.25, 0.5, 0.75)) AS q1,
         max(m1_mean) AS max1,
         min(m2_mean) AS min2, percentile(m2_mean, array(0.25, 0.5, 0.75)) AS q2,
         max(m2_mean) AS max2
  FROM IDENTIFIER(:averages)
  GROUP BY entity
)
SELECT entity, stack(2, :first, min1, q1[0], q1[1], q1[2], max1,
                        :second, min2, q2[0], q2[1], q2[2], max2)
       AS (data, min, `25-perc`, `50-perc`, `75-perc`, max)
FROM summaries
"""

HOURLY_AVERAGES = """
SELECT entity, hour, avg(m1) AS m1_mean, avg(m2) AS m2_mean
FROM IDENTIFIER(:readings)
GROUP BY entity, hour
"""


TAGS = ("m1", "m2")


@contextmanager
def view(df: DataFrame) -> Iterator[str]:
    """A temporary view under a name of its own, dropped once the queries on it are analysed."""
    name = f"wattloom_{uuid.uuid4().hex}"
    df.createTempView(name)
    try:
        yield name
    finally:
        df.sparkSession.catalog.dropTempView(name)


def annual_stats_sql(readings: DataFrame) -> DataFrame:
    with view(readings) as name:
        return readings.sparkSession.sql(ANNUAL_STATS, args={"readings": name})


def monthly_top_sql(
    readings: DataFrame, n: int = 5, tags: tuple[str, str] = TAGS
) -> DataFrame:
    """Rank types start with the tags."""
    with view(readings) as name:
        arguments = {"readings": name, "n": n, "first": tags[0], "second": tags[1]}
        return readings.sparkSession.sql(MONTHLY_TOP, args=arguments)


def hourly_five_numbers_sql(readings: DataFrame, tags: tuple[str, str] = TAGS) -> DataFrame:
    """A view on a query on a view. The tags go to the column ``data``."""
    spark = readings.sparkSession
    with view(readings) as name:
        averages = spark.sql(HOURLY_AVERAGES, args={"readings": name})
        with view(averages) as inner:
            arguments = {"averages": inner, "first": tags[0], "second": tags[1]}
            return spark.sql(HOURLY_FIVE_NUMBERS, args=arguments)
