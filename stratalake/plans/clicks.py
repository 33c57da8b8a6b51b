"""Page clicks: raw JSON to checked counts and the top referrers of a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.expectations import Rule, constraint_sql, guard
from ..operators.ranking import top_k
from ..sinks.declared import declare, declare_sql
from ..sources.files import query_json_path
from ..streaming.declared import Declared, run_declared

# Column names and rules.
RAW_SCHEMA = "curr_title string, n string, prev_title string"
RENAMED = {"curr_title": "current_page_title", "prev_title": "previous_page_title"}
RULES = (
    Rule("valid_current_page_title", "current_page_title IS NOT NULL"),
    Rule("valid_count", "click_count > 0", fatal=True),
)


def as_int(column: str) -> Column:
    """Text as an integer, null where it is none."""
    return F.col(column).try_cast("int")


def renamed(raw: DataFrame) -> DataFrame:
    titles = [F.col(old).alias(new) for old, new in RENAMED.items()]
    return raw.select(*titles, as_int("n").alias("click_count"))


def prepared(raw: DataFrame) -> DataFrame:
    """Renamed and typed rows; a row breaking the fatal rule fails whatever reads it."""
    return guard(renamed(raw), RULES)


def top_referrers(clicks: DataFrame, page: str, k: int = 10) -> DataFrame:
    referrers = (
        clicks.where(F.col("current_page_title") == page)
        .withColumnRenamed("previous_page_title", "referrer")
        .select("referrer", "click_count")
    )
    return top_k(referrers, "click_count", k, tie_break="referrer")


def sql_chain(
    spark: SparkSession, json_path: str, page: str, root: str, suffix: str
) -> dict[str, str]:
    """The same three datasets declared in SQL; returns their table names."""
    names = {step: f"clicks_{step}_{suffix}" for step in ("raw", "clean", "top")}
    declare = "CREATE TABLE {name} USING parquet LOCATION '{root}/{name}' COMMENT '{comment}' AS "

    def clause(step: str, comment: str) -> str:
        return declare.format(name=names[step], root=root, comment=comment)

    query_json_path(
        spark,
        json_path,
        clause("raw", "Clicks as received") + "SELECT * FROM {source}",
    )
    titles = ", ".join(f"{old} AS {new}" for old, new in RENAMED.items())
    spark.sql(
        clause("clean", "Clicks typed and checked")
        + f"""
        SELECT * FROM (
          SELECT {titles}, TRY_CAST(n AS INT) AS click_count FROM {names["raw"]})
        WHERE {constraint_sql(RULES)}"""
    )
    spark.sql(
        clause("top", "Pages that lead to one page most often")
        + f"""
        SELECT previous_page_title AS referrer, click_count
        FROM {names["clean"]}
        WHERE current_page_title = :page
        ORDER BY click_count DESC, referrer
        LIMIT 10""",
        args={"page": page},
    )
    return names


def declared_chain(
    raw: DataFrame, page: str, root: str, log: str, suffix: str
) -> dict[str, DataFrame]:
    """The three datasets, each stored and built on the stored ones, their rules counted."""
    received = declare(raw, f"clicks_raw_{suffix}", root, log, comment="Clicks as received")
    clean = declare(
        renamed(received),
        f"clicks_prepared_{suffix}",
        root,
        log,
        RULES,
        comment="Clicks typed and checked",
    )
    top = declare(
        top_referrers(clean, page),
        f"clicks_top_{suffix}",
        root,
        log,
        comment="Pages that lead to one page most often",
    )
    return {"raw": received, "prepared": clean, "top": top}


def declared_sql_chain(
    spark: SparkSession, json_path: str, page: str, root: str, log: str, suffix: str
) -> dict[str, DataFrame]:
    """``declared_chain`` with each dataset given as a SELECT."""
    names = {step: f"clicks_sql_{step}_{suffix}" for step in ("raw", "prepared", "top")}
    received = declare(
        query_json_path(spark, json_path), names["raw"], root, log, comment="Clicks as received"
    )
    titles = ", ".join(f"{old} AS {new}" for old, new in RENAMED.items())
    clean = declare_sql(
        spark,
        f"SELECT {titles}, TRY_CAST(n AS INT) AS click_count FROM {names['raw']}",
        names["prepared"],
        root,
        log,
        rules=RULES,
        comment="Clicks typed and checked",
    )
    top = declare_sql(
        spark,
        f"""SELECT previous_page_title AS referrer, click_count FROM {names["prepared"]}
            WHERE current_page_title = :page
            ORDER BY click_count DESC, referrer LIMIT 10""",
        names["top"],
        root,
        log,
        args={"page": page},
        comment="Pages that lead to one page most often",
    )
    return {"raw": received, "prepared": clean, "top": top}


def run_clicks(
    stream: DataFrame, checkpoint: str, root: str, log: str, suffix: str
) -> dict[str, str]:
    """Append newly arrived clicks to the raw and the prepared table; returns their names.

    A click that breaks the fatal rule stops the run at its batch; the batches before stay.
    """
    names = {step: f"clicks_stream_{step}_{suffix}" for step in ("raw", "prepared")}
    raw = Declared(names["raw"], f"{root}/{names['raw']}", comment="Clicks as received")
    clean = Declared(
        names["prepared"],
        f"{root}/{names['prepared']}",
        renamed,
        RULES,
        comment="Clicks typed and checked",
    )
    run_declared(stream, checkpoint, [raw, clean], log)
    return names
