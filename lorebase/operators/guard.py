"""Running generated SQL safely. The text is untrusted, and some statements act when they are parsed.

Two layers: a screen over a whole column of statements, and a wrapper that hands one
statement to Spark's own analyzer as a subquery, which only a query can be.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from lorebase.functions.text import has_row_limit, strip_semicolon, strip_space, without_text

# Functions that call arbitrary Java methods.
DENIED_FUNCTIONS = ["reflect", "try_reflect", "java_method"]

# `identifier('...')` would let a statement spell a function's name as a text.
_DENIED = r"(?i)(^|[^\w`])`?(" + "|".join([*DENIED_FUNCTIONS, "identifier"]) + r")`?\s*\("
_DENIED_IN_PLAN = re.compile(r"\b(" + "|".join(DENIED_FUNCTIONS) + r")\(", re.IGNORECASE)
_PATH_TABLE = r"(?i)(from|join|,)\s*(parquet|orc|csv|json|text|avro|binaryfile|delta)\s*\.\s*`"
_QUERY_START = r"(?i)^[\s(]*(select|with|table|values)\b"
_WRITE_WORD = r"(?i)(^|[^\w.`])(insert\s+(into|overwrite)|(drop|create|alter|truncate)\s+(or\s+replace\s+|global\s+|temporary\s+|temp\s+|external\s+)*(table|view|database|schema|namespace|function|catalog|index|variable)|delete\s+from|merge\s+into)\b"

def screen(sql):
    """'ok', or why a statement is turned away before Spark sees it."""
    bare = strip_semicolon(without_text(sql))
    return (
        F.when(F.coalesce(strip_space(bare) == "", F.lit(True)), "no_sql")
        .when(~F.regexp_like(bare, F.lit(_QUERY_START)), "not_a_query")
        .when(F.contains(bare, F.lit(";")), "several_statements")
        .when(F.regexp_like(bare, F.lit(_WRITE_WORD)), "writes")
        .when(F.regexp_like(bare, F.lit(_DENIED)), "denied_function")
        .when(F.regexp_like(bare, F.lit(_PATH_TABLE)), "path_as_table")
        .otherwise("ok")
    )


def guard_statements(statements: DataFrame, column: str = "sql") -> DataFrame:
    """Add `verdict` and `status` (ok, no_sql, rejected) to a table of statements."""
    verdict = screen(F.col(column))
    return statements.withColumn("verdict", verdict).withColumn(
        "status",
        F.when(F.col("verdict") == "ok", "ok").when(F.col("verdict") == "no_sql", "no_sql").otherwise("rejected"),
    )


@dataclass(frozen=True)
class Run:
    """What became of one statement. `result` is lazy; nothing has been fetched."""

    sql: str
    status: str  # ok, no_sql, rejected, failed
    reason: str | None = None
    result: DataFrame | None = None


def execute_query(spark: SparkSession, sql: str | None, limit: int | None = 100) -> Run:
    """Check one statement and return its result as a lazy frame.

    The statement is analysed inside a subquery. Writing statements, several statements
    and commands do not parse there, so nothing but a query can run. `limit` caps the rows
    unless the statement ends in a LIMIT.
    """
    text = sql or ""
    row = spark.range(1).select(
        screen(F.lit(text)).alias("verdict"),
        strip_semicolon(F.lit(text)).alias("bare"),
        has_row_limit(F.lit(text)).alias("limited"),
    ).first()
    if row["verdict"] == "no_sql":
        return Run(text, "no_sql")
    if row["verdict"] != "ok":
        return Run(text, "rejected", row["verdict"])
    settings = {"spark.sql.runSQLOnFiles": "false", "spark.sql.debug.maxToStringFields": "100000"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        result = spark.sql(f"SELECT * FROM (\n{row['bare']}\n)")
        # Nothing has run yet. The analysed plan shows functions by their true names.
        if _DENIED_IN_PLAN.search(result._jdf.queryExecution().analyzed().toString()):
            return Run(text, "rejected", "denied_function")
    except PySparkException as e:
        return Run(text, "failed", e.getCondition() or type(e).__name__)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    if limit is not None and not row["limited"]:
        result = result.limit(limit)
    return Run(text, "ok", None, result)


def execute_statements(statements: DataFrame, column: str = "sql", limit: int | None = 100) -> Iterator[Run]:
    """Run the distinct statements of a table one after another.

    Only the statement texts come to the driver, one partition at a time: a session
    starts queries from the driver alone. Their results stay lazy.
    """
    spark = statements.sparkSession
    for row in statements.select(column).filter(F.col(column) != "").distinct().toLocalIterator():
        yield execute_query(spark, row[0], limit)


OUTCOME = "sql string, status string, reason string, rows bigint, checksum string, seconds double"


def statement_outcomes(statements: DataFrame, column: str = "sql", limit: int | None = 100) -> DataFrame:
    """Run the distinct statements of a table: (sql, status, reason, rows, checksum, seconds), one row each.

    Result rows are counted and summed up, without regard to order and names of columns, where they are. What passes through the driver
    are the statements, one partition at a time, and their outcomes.
    """
    outcomes = []
    for run in execute_statements(statements, column, limit):
        rows = checksum = None
        status, reason, started = run.status, run.reason, time.monotonic()
        if run.result is not None:
            try:
                hashes = run.result.toDF(*[f"c{n}" for n in range(len(run.result.columns))])
                hashes = hashes.select(F.xxhash64(*hashes.columns).cast("decimal(38,0)").alias("h"))
                rows, checksum = hashes.agg(F.count(F.lit(1)), F.sum("h")).first()
            except PySparkException as e:
                status, reason = "failed", e.getCondition() or type(e).__name__
        outcomes.append((run.sql, status, reason, rows, None if checksum is None else str(checksum), time.monotonic() - started))
    return statements.sparkSession.createDataFrame(outcomes, OUTCOME)
