"""Row formats of sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The sink table's column for each device field.
SINK_COLUMNS = {
    "appKey": "app_key",
    "appVersion": "app_version",
    "deviceId": "device_id",
    "phoneNo": "phone_no",
}


def csv_value(df: DataFrame) -> DataFrame:
    """Every row as one CSV text in a `value` column, the form a topic takes."""
    return df.select(F.to_csv(F.struct(*df.columns)).alias("value"))


def rename_for_sink(mail: DataFrame) -> DataFrame:
    return mail.select(*[F.col(a).alias(b) for a, b in SINK_COLUMNS.items()])
