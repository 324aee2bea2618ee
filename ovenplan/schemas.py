"""Explicit schemas: an empty input keeps its columns and types."""

from pyspark.sql import types as T

SALES = T.StructType(
    [
        T.StructField("period", T.TimestampNTZType(), False),
        T.StructField("product_key", T.StringType(), True),
        T.StructField("warehouse_key", T.StringType(), True),
        T.StructField("quantity", T.DoubleType(), True),
        T.StructField("amount", T.DoubleType(), True),
        T.StructField("recorder_type", T.StringType(), True),
    ]
)

# The five columns the source query selects (the record type is a filter only).
SALES_SELECT = ["period", "product_key", "warehouse_key", "quantity", "amount"]

NOMENCLATURE = T.StructType(
    [
        T.StructField("ref_key", T.StringType(), False),
        T.StructField("description", T.StringType(), True),
        T.StructField("parent_key", T.StringType(), True),
    ]
)

WEATHER = T.StructType(
    [
        T.StructField("date", T.DateType(), False),
        T.StructField("temperature", T.DoubleType(), True),
        T.StructField("precipitation", T.DoubleType(), True),
    ]
)

HOLIDAYS = T.StructType([T.StructField("date", T.DateType(), False)])

DAILY = T.StructType(
    [
        T.StructField("date", T.DateType(), False),
        T.StructField("product_key", T.StringType(), False),
        T.StructField("product_name", T.StringType(), True),
        T.StructField("warehouse_key", T.StringType(), False),
        T.StructField("quantity", T.DoubleType(), False),
        T.StructField("amount", T.DoubleType(), False),
    ]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("date", T.DateType(), True),
        T.StructField("product_name", T.StringType(), True),
        T.StructField("warehouse_key", T.StringType(), True),
        T.StructField("quantity", T.DoubleType(), True),
        T.StructField("predicted", T.DoubleType(), True),
        T.StructField("error", T.DoubleType(), True),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("seq", T.LongType(), False),
        T.StructField("model", T.StringType(), False),
        T.StructField("mae", T.DoubleType(), True),
        T.StructField("rmse", T.DoubleType(), True),
        T.StructField("mape", T.DoubleType(), True),
        T.StructField("r2", T.DoubleType(), True),
        T.StructField("features", T.StringType(), True),
    ]
)

# Raw JSON envelopes as the sources deliver them.
SALES_PAYLOAD = T.StructType(
    [
        T.StructField(
            "value",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("Period", T.StringType()),
                        T.StructField("product_key", T.StringType()),
                        T.StructField("warehouse_key", T.StringType()),
                        T.StructField("quantity", T.DoubleType()),
                        T.StructField("amount", T.DoubleType()),
                    ]
                )
            ),
        )
    ]
)

WEATHER_PAYLOAD = T.StructType(
    [
        T.StructField(
            "daily",
            T.StructType(
                [
                    T.StructField("time", T.ArrayType(T.StringType())),
                    T.StructField("temperature_2m_mean", T.ArrayType(T.DoubleType())),
                    T.StructField("precipitation_sum", T.ArrayType(T.DoubleType())),
                ]
            ),
        )
    ]
)
