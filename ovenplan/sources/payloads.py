"""JSON envelopes of the two HTTP sources, and their parsers.

* Sales: ``{"value": [ {record}, ... ]}`` pages; a missing ``value`` is an
  empty page.
* Weather: ``{"daily": {"time": [...], "temperature_2m_mean": [...],
  "precipitation_sum": [...]}}`` parallel arrays.

Parsers are ``from_json`` with a fixed schema then ``inline``: rows fan out
inside the task that read the payload, nothing is collected.
The encoders turn frames back into such payloads (for landing raw
responses, and for tests); every page is bounded in size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ovenplan.schemas import SALES_PAYLOAD, WEATHER_PAYLOAD

PAGE_SIZE = 5000


def parse_sales_payloads(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """period, product_key, warehouse_key, quantity, amount from sales envelopes."""
    parsed = payloads.select(F.from_json(F.col(column), SALES_PAYLOAD).alias("p"))
    records = parsed.select(F.inline(F.coalesce(F.col("p.value"), F.array().cast(SALES_PAYLOAD["value"].dataType))))
    return records.select(
        F.to_timestamp_ntz(F.col("Period")).alias("period"),
        "product_key",
        "warehouse_key",
        "quantity",
        "amount",
    )


def parse_weather_payloads(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """date, temperature, precipitation from weather envelopes (NULLs kept)."""
    d = F.from_json(F.col(column), WEATHER_PAYLOAD).alias("p")
    zipped = F.arrays_zip(
        F.col("p.daily.time").alias("time"),
        F.col("p.daily.temperature_2m_mean").alias("temperature"),
        F.col("p.daily.precipitation_sum").alias("precipitation"),
    )
    rows = payloads.select(d).select(F.inline(F.coalesce(zipped, F.array().cast(zipped_type()))))
    return rows.select(F.to_date("time").alias("date"), "temperature", "precipitation")


def zipped_type() -> str:
    return "array<struct<time:string,temperature:double,precipitation:double>>"


def sales_payloads(sales: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """payload: one JSON page of at most ``page_size`` records per row.

    Pages are cut inside each input partition from its row position, so a
    page never mixes partitions and never exceeds ``page_size`` records.
    """
    rec = F.struct(
        F.date_format("period", "yyyy-MM-dd'T'HH:mm:ss").alias("Period"),
        "product_key",
        "warehouse_key",
        "quantity",
        "amount",
    )
    paged = sales.select(F.expr(f"monotonically_increasing_id() div {int(page_size)}").alias("_page"), rec.alias("r"))
    pages = paged.groupBy("_page").agg(F.collect_list("r").alias("value"))
    return pages.select(F.to_json(F.struct("value")).alias("payload"))


def weather_payloads(weather: DataFrame) -> DataFrame:
    """payload: one JSON document per month (at most 31 days each)."""
    day = F.struct(
        F.col("date").alias("d"), F.col("temperature").alias("t"), F.col("precipitation").alias("p")
    )
    months = weather.groupBy(F.trunc("date", "month").alias("_m")).agg(F.sort_array(F.collect_list(day)).alias("days"))
    daily = F.struct(
        F.transform("days", lambda x: F.date_format(x["d"], "yyyy-MM-dd")).alias("time"),
        F.transform("days", lambda x: x["t"]).alias("temperature_2m_mean"),
        F.transform("days", lambda x: x["p"]).alias("precipitation_sum"),
    )
    return months.select(F.to_json(F.struct(daily.alias("daily"))).alias("payload"))
