"""Text and delimited-file sources, and line parsers with a strict and a quarantine mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillstone.schemas import MAIL, SENSOR, USER_BEHAVIOR


def scan_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line; blank lines are rows."""
    return spark.read.text(path)


def stream_text(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def scan_csv_table(
    spark: SparkSession, path: str, view: str | None = None, schema: str = SENSOR
) -> DataFrame:
    """A CSV table with a declared schema, registered as a view if a name is given."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").csv(path)
    return as_view(df, view) if view else df


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register under a name and read back under it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def scan_ddl_table(
    spark: SparkSession, path: str, delay: str = "1 second", stream: bool = False
) -> DataFrame:
    """The sensor table with a computed event-time column `ks` and its watermark."""
    reader = spark.readStream if stream else spark.read
    return with_computed_time(reader.schema(SENSOR).csv(path), "ks", delay)


def with_computed_time(df: DataFrame, name: str, delay: str) -> DataFrame:
    timed = df.withColumn(name, F.timestamp_seconds("timestamp"))
    return timed.withWatermark(name, delay) if df.isStreaming else timed


def _fields(schema: str):
    return StructType.fromDDL(schema).fields


def parse_lines(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Strict parsing: a missing field or a bad number fails the query; extra fields are ignored.

    The failure is raised here and doesn't hang on the session's ANSI setting.
    """
    parts = F.split(F.col(column), ",")

    def strict(i: int, f) -> Column:
        bad = F.raise_error(F.concat(F.lit(f"no {f.name} in line: "), F.coalesce(F.col(column), F.lit("null"))))
        return F.coalesce(F.get(parts, F.lit(i)).try_cast(f.dataType), bad.cast(f.dataType)).alias(f.name)

    return lines.select(*[strict(i, f) for i, f in enumerate(_fields(schema))])


def split_bad_lines(
    lines: DataFrame, schema: str, column: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Tolerant parsing: (rows that parse, lines that don't)."""
    parts = F.split(F.col(column), ",")
    fields = _fields(schema)
    parsed = F.struct(
        *[F.get(parts, F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)]
    )
    tagged = lines.select(F.col(column).alias("line"), parsed.alias("row"))
    complete: Column = F.lit(True)
    for f in fields:
        complete = complete & F.col(f"row.{f.name}").isNotNull()
    return tagged.filter(complete).select("row.*"), tagged.filter(~complete).select("line")


def parse_sensor_csv(lines: DataFrame) -> DataFrame:
    return parse_lines(lines, SENSOR)


def parse_user_behavior_csv(lines: DataFrame, shift_hours: int = 0) -> DataFrame:
    """Click-stream lines; `shift_hours` moves the epoch seconds for sources in local time."""
    rows = parse_lines(lines, USER_BEHAVIOR)
    if shift_hours:
        rows = rows.withColumn("timestamp", F.col("timestamp") + shift_hours * 3600)
    return rows


def json_to_mail(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON objects to the four device fields; a missing key gives null, malformed text fails."""
    return lines.select(F.from_json(column, MAIL, {"mode": "FAILFAST"}).alias("m")).select("m.*")


def split_bad_json(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(device rows, lines that are not a JSON object)."""
    as_map = F.from_json(column, "map<string,string>")
    tagged = lines.select(F.col(column).alias("line"), as_map.alias("m"))
    names = [f.name for f in _fields(MAIL)]
    good = tagged.filter(F.col("m").isNotNull())
    mail = good.select(*[F.try_element_at("m", F.lit(n)).alias(n) for n in names])
    return mail, tagged.filter(F.col("m").isNull()).select("line")
