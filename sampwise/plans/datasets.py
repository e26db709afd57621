"""Model-ready tables derived from the test-data tables by Spark.

The bank-marketing table the studied workload trains on is not available; this
derives a table of the same shape (binary yes/no label, numeric and categorical
features, a unique key) from ``events``, so the model jobs grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import uniform

# Label rule and feature lists of the derived table.
LABEL_THRESHOLD = 35.0
BANK_KEY = "event_id"
BANK_LABEL = "y"
BANK_NUMERIC = ("signal", "hour", "day_of_week", "k")
NOISE_SEED = 5
NOISE_WIDTH = 60.0
BANK_CATEGORICAL = ("event_type", "weekday")


def events_bank(events: DataFrame) -> DataFrame:
    """``event_id, signal, hour, day_of_week, k, event_type, weekday, y``.

    ``y = 'yes'`` when ``value >= LABEL_THRESHOLD`` (about half the rows).  The value
    itself is no feature: ``signal`` is the value plus uniform noise drawn from the key,
    so the label is learnable but not given away.  ``k`` is the integer in ``props``.
    """
    noise = (uniform("event_id", NOISE_SEED) - F.lit(0.5)) * F.lit(NOISE_WIDTH)
    return events.select(
        F.col("event_id"),
        (F.col("value") + noise).alias("signal"),
        F.hour("ts").cast("double").alias("hour"),
        F.dayofweek("ts").cast("double").alias("day_of_week"),
        F.coalesce(F.get_json_object("props", "$.k").cast("double"), F.lit(0.0)).alias("k"),
        F.col("event_type"),
        F.date_format("ts", "EEE").alias("weekday"),
        F.when(F.col("value") >= LABEL_THRESHOLD, F.lit("yes")).otherwise(F.lit("no"))
        .alias("y"),
    )
