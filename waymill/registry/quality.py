"""Missing values, most frequent values and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import (
    column_means,
    drop_all_null,
    least_row_per_key,
    most_frequent,
    newer_than,
    read_mark,
    typed_readings,
)
from ..operators import column_profile as profile
from ..operators import fill_mean as by_mean
from ..operators import fill_mode as by_mode
from ..operators import fill_zero as by_zero
from ..plans import clean_forecast, clean_observed
from .incremental import stored_events
from .tables import Tables, collector

QUERIES, ORACLES, query = collector()

# The tables hold no nulls; these rules make them from the rows' own content.
_NO_ERRORS = "CASE WHEN event_type <> 'error' THEN value END"
_NO_SIGNUPS = "CASE WHEN event_type <> 'signup' THEN value END"


@query(
    f"""
    WITH x AS (SELECT event_id, {_NO_ERRORS} AS v FROM events)
    SELECT event_id, round(coalesce(v, (SELECT avg(v) FROM x)), 6) AS value FROM x
    """
)
def fill_mean(t: Tables) -> DataFrame:
    readings = t.events.select("event_id", F.expr(_NO_ERRORS).alias("value"))
    return by_mean(readings, ["value"]).withColumn("value", F.round("value", 6))


@query(f"SELECT event_id, coalesce({_NO_SIGNUPS}, 0.0) AS precipitation FROM events")
def fill_zero(t: Tables) -> DataFrame:
    return by_zero(t.events.select("event_id", F.expr(_NO_SIGNUPS).alias("precipitation")), ["precipitation"])


@query("SELECT event_id, coalesce(CASE WHEN event_type <> 'click' THEN event_type END, '0') AS kind FROM events")
def fill_zero_text(t: Tables) -> DataFrame:
    """Text columns are filled with '0'."""
    return by_zero(t.events.select("event_id", F.expr("CASE WHEN event_type <> 'click' THEN event_type END").alias("kind")), ["kind"])


_HOURS = "(user_id % 12)"


@query(
    f"""
    SELECT event_id, CASE event_type WHEN 'click' THEN NULL WHEN 'view' THEN date_trunc('second', ts) - {_HOURS} * INTERVAL 1 HOUR
           WHEN 'error' THEN date_trunc('minute', ts) + {_HOURS} * INTERVAL 1 HOUR ELSE date_trunc('second', ts) END AS read_at,
           CASE WHEN event_type = 'signup' THEN NULL ELSE value END AS reading
    FROM events
    """
)
def readings_typed(t: Tables) -> DataFrame:
    """Text times without an offset, with offsets east and west and with Z, and unreadable ones."""
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    hours = F.lpad((F.col("user_id") % 12).cast("string"), 2, "0")
    kind = F.col("event_type")
    times = (
        F.when(kind == "click", "never")
        .when(kind == "view", F.concat(text, F.lit("+"), hours, F.lit(":00")))
        .when(kind == "error", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm"), F.lit("-"), hours, F.lit("00")))
        .when(kind == "signup", F.concat(text, F.lit("Z")))
        .otherwise(text)
    )
    rows = t.events.select(
        "event_id", times.alias("read_at"), F.when(kind == "signup", "NaN").otherwise(F.col("value").cast("string")).alias("reading")
    )
    return typed_readings(rows, ["reading"], "read_at")


def _mode_sql(condition: str, result: str) -> str:
    return f"""
    WITH x AS (SELECT event_id, CASE WHEN {condition} THEN event_type END AS t FROM events),
    m AS (SELECT t FROM x GROUP BY t ORDER BY count(*) DESC, t ASC NULLS FIRST LIMIT 1)
    SELECT {result} FROM x
    """


def _types_with_value(t: Tables, least: int) -> DataFrame:
    return t.events.select("event_id", F.when(F.col("value") >= least, F.col("event_type")).alias("event_type"))


@query(_mode_sql("value >= 3", "event_id, coalesce(t, (SELECT t FROM m)) AS event_type"))
def fill_mode_null_group(t: Tables) -> DataFrame:
    """Nulls are the smallest group: filled with the most frequent type."""
    return by_mode(_types_with_value(t, 3), ["event_type"])


@query(_mode_sql("value >= 40", "event_id, coalesce(t, (SELECT t FROM m)) AS event_type"))
def fill_mode_null_wins(t: Tables) -> DataFrame:
    """Nulls are the largest group: nothing is filled."""
    return by_mode(_types_with_value(t, 40), ["event_type"])


@query(
    """
    SELECT * FROM (
      SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
             CASE WHEN event_type NOT IN ('error', 'view') THEN value END AS value, 'ICN' AS airport_code
      FROM events)
    WHERE event_id IS NOT NULL OR value IS NOT NULL
    """
)
def drop_all_null_tagged(t: Tables) -> DataFrame:
    """The tag column is never null and so does not count."""
    kind = F.col("event_type")
    rows = t.events.select(
        F.when(kind != "error", F.col("event_id")).alias("event_id"),
        F.when(~kind.isin("error", "view"), F.col("value")).alias("value"),
        F.lit("ICN").alias("airport_code"),
    )
    return drop_all_null(rows, ["airport_code"])


@query(
    """
    SELECT event_type, n FROM (
      SELECT CASE WHEN value >= 3 THEN event_type END AS event_type, count(*) AS n FROM events GROUP BY 1)
    ORDER BY n DESC, event_type ASC NULLS FIRST LIMIT 1
    """
)
def top_value_by_count(t: Tables) -> DataFrame:
    return most_frequent(_types_with_value(t, 3), "event_type")


@query(f"SELECT round(avg({_NO_ERRORS}), 6) AS m_a, round(avg({_NO_SIGNUPS}), 6) AS m_b FROM events")
def mean_per_column(t: Tables) -> DataFrame:
    readings = t.events.select(F.expr(_NO_ERRORS).alias("m_a"), F.expr(_NO_SIGNUPS).alias("m_b"))
    return column_means(readings, ["m_a", "m_b"]).select(F.round("m_a", 6).alias("m_a"), F.round("m_b", 6).alias("m_b"))


_BATCH = f"""
    x AS (SELECT event_id, {_NO_ERRORS} AS t, {_NO_SIGNUPS} AS p, CASE WHEN event_type <> 'click' THEN event_type END AS v
          FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-22'))
"""


def _batch(t: Tables) -> DataFrame:
    new = newer_than(t.events, "ts", read_mark(stored_events(t), "ts"))
    return new.select(
        "event_id",
        F.expr(_NO_ERRORS).alias("temperature"),
        F.expr(_NO_SIGNUPS).alias("precipitation"),
        F.expr("CASE WHEN event_type <> 'click' THEN event_type END").alias("visibility"),
        F.lit("ICN").alias("airport_code"),
    )


@query(
    f"""
    WITH {_BATCH}, m AS (SELECT v FROM x GROUP BY v ORDER BY count(*) DESC, v ASC NULLS FIRST LIMIT 1)
    SELECT event_id, round(coalesce(t, (SELECT avg(t) FROM x)), 6) AS temperature, coalesce(p, 0.0) AS precipitation,
           coalesce(v, (SELECT v FROM m)) AS visibility, 'ICN' AS airport_code
    FROM x
    """
)
def weather_batch_clean(t: Tables) -> DataFrame:
    """Forecast cleaning of the rows newer than the mark."""
    cleaned = clean_forecast(_batch(t), ["temperature"], ["precipitation"], ["visibility"])
    return cleaned.withColumn("temperature", F.round("temperature", 6))


@query(
    f"""
    WITH {_BATCH}
    SELECT event_id, round(coalesce(t, (SELECT avg(t) FROM x)), 6) AS temperature, coalesce(p, 0.0) AS precipitation,
           v AS visibility, 'ICN' AS airport_code
    FROM x
    """
)
def observed_batch_clean(t: Tables) -> DataFrame:
    """Observed cleaning: no row dropped, no mode."""
    cleaned = clean_observed(_batch(t), ["temperature"], ["precipitation"])
    return cleaned.withColumn("temperature", F.round("temperature", 6))


@query(
    """
    SELECT user_id, event_type, event_id, ts, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY value, event_id) = 1
    """
)
def one_row_per_key(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_type", "event_id", "ts", "value")
    return least_row_per_key(rows, ["user_id", "event_type"], ["value", "event_id"])


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct, "
        f"cast(min({c}) AS varchar) AS min_value, cast(max({c}) AS varchar) AS max_value FROM x"
        for c in ("user_id", "event_type", "value")
    ).join(["WITH x AS (SELECT user_id, CASE WHEN value >= 3 THEN event_type END AS event_type, value FROM events) ", ""])
)
def column_profile(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", F.expr("CASE WHEN value >= 3 THEN event_type END").alias("event_type"), "value")
    return profile(rows)


_LINES = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"
).split()
# Each column as it is, and three times with other gaps.
_WIDE = {name: name for name in _LINES} | {
    f"{name}_{k}": f"CASE WHEN l_linenumber % 3 <> {k} THEN {name} END" for k in range(3) for name in _LINES
}


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) AS n_rows, count(*) - count({rule}) AS n_null, count(DISTINCT {rule}) AS n_distinct, "
        f"cast(min({rule}) AS varchar) AS min_value, cast(max({rule}) AS varchar) AS max_value FROM lineitem"
        for name, rule in _WIDE.items()
    )
)
def column_profile_wide(t: Tables) -> DataFrame:
    """44 columns of five types, four at a time."""
    return profile(t.lineitem.select(*(F.expr(rule).alias(name) for name, rule in _WIDE.items())), batch=4)


@query(
    """
    SELECT 'a.b' AS column_name, count(*) AS n_rows, 0::BIGINT AS n_null, count(DISTINCT user_id) AS n_distinct,
           cast(min(user_id) AS varchar) AS min_value, cast(max(user_id) AS varchar) AS max_value FROM events
    UNION ALL SELECT 'entries', count(*), count(*) FILTER (event_type = 'view'), NULL, NULL, NULL FROM events
    """
)
def column_profile_nested(t: Tables) -> DataFrame:
    """A name with a dot, and a map, which has no order."""
    entries = F.expr("CASE WHEN event_type <> 'view' THEN map(event_type, value) END").alias("entries")
    return profile(t.events.select(F.col("user_id").alias("a.b"), entries))
