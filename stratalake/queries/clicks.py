"""Page clicks, in Python and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import landing
from ..operators.expectations import expectation_report
from ..plans import clicks
from ..scratch import fresh_dir, fresh_name
from ..sinks.declared import read_log, rule_totals
from ..sinks.tables import materialize
from ..sources.files import query_json_path, read_json
from .registry import Registry

registry = Registry()

PAGE = "purchase"
CLICKS = """
    WITH clicks AS (
      SELECT CASE WHEN event_type <> 'error' THEN event_type END AS current_page_title,
             CAST(count(*) AS INTEGER) AS click_count,
             'user_' || user_id AS previous_page_title
      FROM events GROUP BY ALL)
"""
TOP_REFERRERS = (
    CLICKS
    + f"""
    SELECT previous_page_title AS referrer, click_count
    FROM clicks WHERE current_page_title = '{PAGE}'
    ORDER BY click_count DESC, referrer LIMIT 10"""
)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_json(spark, landing.click_files(spark, sf_dir), clicks.RAW_SCHEMA)


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored, so that every row has passed the fatal rule."""
    return materialize(
        clicks.prepared(_raw(spark, sf_dir)),
        fresh_name("clicks_prepared"),
        fresh_dir(spark, "clicks"),
        comment="Clicks typed and checked",
    )


@registry.check(
    CLICKS + "SELECT current_page_title, click_count, previous_page_title FROM clicks"
)
def click_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir)


@registry.check(
    CLICKS
    + """
    SELECT previous_page_title AS referrer, current_page_title AS page,
           click_count AS n, TRY_CAST(previous_page_title AS INTEGER) AS not_a_number
    FROM clicks"""
)
def click_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select(
        F.col("prev_title").alias("referrer"),
        F.col("curr_title").alias("page"),
        clicks.as_int("n").alias("n"),
        clicks.as_int("prev_title").alias("not_a_number"),
    )


@registry.check(TOP_REFERRERS)
def click_top_referrers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks.top_referrers(_prepared(spark, sf_dir), PAGE)


@registry.check(TOP_REFERRERS)
def click_top_referrers_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_json_path(
        spark,
        landing.click_files(spark, sf_dir),
        f"""SELECT prev_title AS referrer, TRY_CAST(n AS INT) AS click_count
            FROM {{source}} WHERE curr_title = '{PAGE}'
            ORDER BY click_count DESC, referrer LIMIT 10""",
    )


@registry.check(TOP_REFERRERS)
def click_sql_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = clicks.sql_chain(
        spark,
        landing.click_files(spark, sf_dir),
        PAGE,
        fresh_dir(spark, "clicks-sql"),
        fresh_name("run"),
    )
    return spark.table(tables["top"])


@registry.check(
    CLICKS
    + """
    SELECT 'valid_current_page_title' AS rule, count(*) AS row_count,
           count(*) FILTER (current_page_title IS NULL) AS violations
    FROM clicks
    UNION ALL
    SELECT 'valid_count', count(*), count(*) FILTER (NOT coalesce(click_count > 0, false))
    FROM clicks""",
    name="expectation_report",
)
def click_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expectation_report(clicks.renamed(_raw(spark, sf_dir)), clicks.RULES)


@registry.check(
    CLICKS
    + """
    , rules AS (
      SELECT 'valid_current_page_title' AS rule, false AS fatal,
             count(*) FILTER (current_page_title IS NULL) AS violations
      FROM clicks
      UNION ALL
      SELECT 'valid_count', true, count(*) FILTER (NOT coalesce(click_count > 0, false))
      FROM clicks)
    SELECT dataset, rule, fatal, violations, (SELECT count(*) FROM clicks) AS row_count,
           CASE dataset WHEN 'clicks_stream_prepared' THEN 2 ELSE 1 END AS batches,
           (SELECT sum(click_count) FROM clicks) AS clicks_stored
    FROM rules CROSS JOIN (VALUES ('clicks_prepared'), ('clicks_sql_prepared'),
                                  ('clicks_stream_prepared')) AS t(dataset)"""
)
def click_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the log says of the checked clicks, stored at once, by SQL, and by a stream.

    The stream runs three times: for half of the clicks, the rest, and for nothing new.
    """
    run, root, log = fresh_name("run"), fresh_dir(spark, "declared"), fresh_dir(spark, "log")
    raw = _raw(spark, sf_dir)
    clicks.declared_chain(raw, PAGE, root, log, run)
    clicks.declared_sql_chain(spark, landing.click_files(spark, sf_dir), PAGE, root, log, run)
    arrivals, checkpoint = fresh_dir(spark, "arrivals"), fresh_dir(spark, "checkpoint")
    first = F.pmod(F.xxhash64("prev_title"), F.lit(2)) == 0
    for delivered in (first, ~first, None):
        if delivered is not None:
            raw.where(delivered).write.mode("append").json(arrivals)
        stream = spark.readStream.schema(clicks.RAW_SCHEMA).json(arrivals)
        clicks.run_clicks(stream, checkpoint, root, log, run)
    entries = read_log(spark, log)
    batches = entries.where("rule IS NULL").groupBy("dataset").agg(F.count("*").alias("batches"))
    stored = [
        spark.table(f"{name}_{run}").agg(
            F.lit(name).alias("dataset"), F.sum("click_count").alias("clicks_stored")
        )
        for name in ("clicks_prepared", "clicks_sql_prepared", "clicks_stream_prepared")
    ]
    sums = stored[0].unionByName(stored[1]).unionByName(stored[2])
    return (
        rule_totals(entries)
        .join(batches, "dataset")
        .drop("run")
        .withColumn("dataset", F.regexp_replace("dataset", f"_{run}$", ""))
        .join(sums, "dataset")
    )
