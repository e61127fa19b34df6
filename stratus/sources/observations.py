"""Observation sources and the engineered-table sink (A1-A3, A5).

Reads always carry an explicit schema (no inference on a large file), the
naive timestamp is parsed once, and the engineered table is written as
Parquet partitioned by year/month so later scans prune whole directories.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INT_COLUMNS = ("maxtempC", "mintempC", "uvIndex", "moon_illumination", "DewPointC", "HeatIndexC", "WindChillC",
                "WindGustKmph", "cloudcover", "humidity", "pressure", "visibility", "winddirDegree",
                "windspeedKmph", "tempC", "FeelsLikeC")
_DOUBLE_COLUMNS = ("totalSnow_cm", "sunHour", "precipMM")
_TEXT_COLUMNS = ("location", "moonrise", "moonset", "sunrise", "sunset")

# Types of the raw hourly observation columns (matched by header name).
RAW_TYPES = {**{c: T.IntegerType() for c in _INT_COLUMNS}, **{c: T.DoubleType() for c in _DOUBLE_COLUMNS},
             **{c: T.StringType() for c in _TEXT_COLUMNS}}
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_observations(spark: SparkSession, path: str, fmt: str = "csv", types: dict = RAW_TYPES,
                      ts: str = "date_time", ts_format: str = TIMESTAMP_FORMAT) -> DataFrame:
    """A1: typed observation table; the time column becomes ``timestamp_ntz``.

    CSV columns are read as text (no inference pass over the file) and cast
    by *header name*.  All files of a glob must have the same header in the
    same order; a file that differs fails the read instead of shifting values.
    Unparseable numbers become NULL, like pandas' coercion to NaN.
    """
    if fmt == "csv":
        header = spark.read.option("header", True).csv(path).columns
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        df = spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)
        df = df.select(*[(F.col(c).try_cast(types[c]) if c in types else F.col(c)).alias(c) for c in df.columns])
    else:
        df = spark.read.format(fmt).load(path)
        df = df.select(*[(F.col(c).cast(types[c]) if c in types else F.col(c)).alias(c) for c in df.columns])
    if isinstance(df.schema[ts].dataType, T.StringType):
        df = df.withColumn(ts, F.to_timestamp_ntz(F.col(ts), F.lit(ts_format)))
    return df


def load_observations(spark: SparkSession, data_dir: str, engineered: str = "engineered",
                      raw: str = "raw.csv") -> DataFrame:
    """A2: the engineered table when it exists, else the raw observations.
    The choice is made once at job start from the file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    eng = jvm.org.apache.hadoop.fs.Path(f"{data_dir.rstrip('/')}/{engineered}")
    done = jvm.org.apache.hadoop.fs.Path(f"{eng.toString()}/_SUCCESS")
    if eng.getFileSystem(conf).exists(done):  # a folder without the marker was never finished
        df = spark.read.parquet(eng.toString())
        order = jvm.org.apache.hadoop.fs.Path(column_list_path(eng.toString()))
        if order.getFileSystem(conf).exists(order):
            df = df.select(*read_column_list(spark, eng.toString()))
        return df
    return read_observations(spark, f"{data_dir.rstrip('/')}/{raw}")


def column_list_path(path: str) -> str:
    return f"{path.rstrip('/')}.columns"


def write_column_list(spark: SparkSession, columns, path: str) -> None:
    """Column names in order, beside the table or the models they belong to: partitioned tables
    come back with the partition columns last, and models know their inputs by position only."""
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(columns)], "position int, name string")
    rows.coalesce(1).write.mode("overwrite").json(column_list_path(path))


def read_column_list(spark: SparkSession, path: str) -> list[str]:
    rows = spark.read.schema("position int, name string").json(column_list_path(path))
    return [r["name"] for r in rows.orderBy("position").collect()]


def write_engineered(df: DataFrame, path: str, fmt: str = "parquet", partition_by=("year", "month"),
                     mode: str = "overwrite") -> None:
    """A3: engineered-table sink (Parquet by default, partitioned by calendar)."""
    w = df.write.mode(mode)
    cols = [c for c in partition_by if c in df.columns]
    if cols and fmt != "csv":
        w = w.partitionBy(*cols)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        write_column_list(df.sparkSession, df.columns, path)
        w.format(fmt).save(path)


def metrics_long(wide: DataFrame, id_cols, metric_cols, name: str = "metric_name",
                 value: str = "metric_value") -> DataFrame:
    """A5: wide metrics (one column per metric) -> tidy long rows."""
    return wide.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in metric_cols]).unpivot(
        list(id_cols), list(metric_cols), name, value)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A5: JSON-lines sink for metadata / metric tables."""
    df.write.mode(mode).json(path)
