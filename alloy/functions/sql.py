"""The library's functions for SQL text: ``register`` makes them temporary SQL functions.

Their bodies are the SQL text of the Column expressions, so there is one definition of
each; Spark inlines them when it plans a query, and no Python runs for a row.

    alloy_canon(text)                        canonical text of a raw value
    alloy_raw_hash(array of texts)           SHA-256 of canonical texts joined by '||'
    alloy_is_blank(text)                     blank cell
    alloy_has_content(text)                  cell with content
    alloy_numeric_corrupt(text), alloy_percent_corrupt(text)
    alloy_error_reason(corrupt, date_error, blank)
    alloy_number(text), alloy_percent_ratio(text)
    alloy_parse_date(text)                   mixed-format date, but for the generic forms
    alloy_session_hour(text), alloy_parse_hhmm(text), alloy_session_start(day, time)
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from alloy.constants import HASH_SEP, REASON_DATE, REASON_NUMERIC, REASON_SEP
from alloy.functions import dates, numbers, text


def error_reason(corrupt: Column, date_error: Column, blank: Column) -> Column:
    """Why a row is set aside, its reasons joined; NULL for a good or a blank row."""
    return F.when((corrupt | date_error) & ~blank, F.concat_ws(
        REASON_SEP, F.when(corrupt, F.lit(REASON_NUMERIC)), F.when(date_error, F.lit(REASON_DATE))))


def _definitions() -> dict[str, tuple[str, str, Column]]:
    """name -> (parameters, result type, body over the parameters)."""
    x = F.col("x")
    return {
        "alloy_canon": ("x STRING", "STRING", text.canon(x)),
        "alloy_is_blank": ("x STRING", "BOOLEAN", text.is_blank_cell(x)),
        "alloy_has_content": ("x STRING", "BOOLEAN", text.has_content(x)),
        "alloy_numeric_corrupt": ("x STRING", "BOOLEAN", numbers.numeric_corrupt(x)),
        "alloy_percent_corrupt": ("x STRING", "BOOLEAN", numbers.percent_corrupt(x)),
        "alloy_error_reason": ("corrupt BOOLEAN, date_error BOOLEAN, blank BOOLEAN", "STRING",
                               error_reason(F.col("corrupt"), F.col("date_error"), F.col("blank"))),
        "alloy_number": ("x STRING", "DECIMAL(38,9)", numbers.locale_number(x)),
        "alloy_percent_ratio": ("x STRING", "DOUBLE", numbers.percent_ratio(x)),
        "alloy_parse_date": ("x STRING", "TIMESTAMP_NTZ", dates.parse_mixed_date(x, generic=False)),
        "alloy_session_hour": ("x STRING", "INT", dates.session_hour(x)),
        "alloy_parse_hhmm": ("x STRING", "STRING", dates.parse_hhmm(x)),
        "alloy_session_start": ("day DATE, time STRING", "TIMESTAMP_NTZ", dates.session_start(F.col("day"), F.col("time"))),
    }


def sql_text(spark: SparkSession, parameters: str, body: Column) -> str:
    """The SQL text of a Column over columns named as ``parameters``."""
    plan = spark.createDataFrame([], parameters).select(body.alias("y"))._jdf.queryExecution().analyzed()
    return plan.expressions().head().child().sql()


def register(spark: SparkSession) -> list[str]:
    """Make the functions known to the session; their names."""
    made = []
    for name, (parameters, result, body) in _definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {sql_text(spark, parameters, body)}")
        made.append(name)
    canon = sql_text(spark, "x STRING", text.canon(F.col("x")))
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION alloy_raw_hash(parts ARRAY<STRING>) RETURNS STRING "
              f"RETURN sha2(concat_ws('{HASH_SEP}', transform(parts, x -> {canon})), 256)")
    return made + ["alloy_raw_hash"]
