"""Sources and sinks: checked scans, CSV and Parquet conversion, file discovery, partitioned and incremental writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fieldspark.sources.tables import exists, small_side, written

THRESHOLD_SCHEMA = "water_year int, elev_bin int, threshold_1 date, threshold_2 date, threshold_best date"
MODELS = ("peers", "grid")
CHECKLIST = "date date, n_rows long, digest string, run int"


def read_series(spark: SparkSession, path: str, date: str = "Date", schema: StructType | str | None = None) -> DataFrame:
    """Parquet time series with a required date column, cast to DATE and ordered by it."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    if date not in df.columns:
        raise ValueError(f"{path} has no column {date!r}; it has {df.columns}")
    return df.withColumn(date, F.to_date(date)).orderBy(date)


def series_dates(df: DataFrame, date: str = "Date") -> DataFrame:
    """Distinct non-null dates, newest first; only the date column is scanned."""
    return df.where(F.col(date).isNotNull()).select(F.to_date(date).alias(date)).distinct().orderBy(F.desc(date))


def read_csv_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Typed CSV scan; a path that doesn't exist gives an empty table of the schema (S3)."""
    try:
        return spark.read.schema(schema).csv(path, header=True)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str, schema: StructType | str | None = None, **options) -> DataFrame:
    """Convert CSV to Parquet and read the result (S4); without a schema all columns are text."""
    reader = spark.read.schema(schema) if schema else spark.read
    reader.csv(csv_path, header=True, **options).write.mode("overwrite").parquet(parquet_path)
    return spark.read.parquet(parquet_path)


def wide_to_long(df: DataFrame, keys: Sequence[str] = ("date",), entity: str = "station", value: str = "value", drop_null: bool = False) -> DataFrame:
    """One row for each (keys, other column): wide station tables to long ones."""
    columns = [c for c in df.columns if c not in keys]
    out = df.unpivot(list(keys), columns, entity, value)
    return out.where(F.col(value).isNotNull()) if drop_null else out


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Overwrite only the partitions that ``df`` holds; rows are dealt by partition first, so each has few files."""
    df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def append_new_dates(df: DataFrame, path: str, keys: Sequence[str] = ("date",)) -> DataFrame:
    """Append only rows whose keys the table doesn't have yet, and read the table."""
    spark = df.sparkSession
    try:
        known = spark.read.schema(df.schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        known = spark.createDataFrame([], df.schema)
    df.join(known.select(*keys).distinct(), list(keys), "left_anti").write.mode("append").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checklist(spark: SparkSession, path: str) -> DataFrame:
    """Processed dates of ``commit_dates`` as they stand (S17): (date, n_rows, digest, run); empty before the first run."""
    if not exists(spark, path):
        return spark.createDataFrame([], CHECKLIST)
    log = spark.read.schema(CHECKLIST).parquet(path)
    return log.groupBy("date").agg(F.max_by(F.struct("n_rows", "digest", "run"), "run").alias("last")).select("date", "last.*")


def commit_dates(df: DataFrame, path: str, log: str, date: str = "date") -> DataFrame:
    """Put the dates of ``df`` into the table at ``path``, new ones added and changed ones replaced, and read the table.

    A date's rows count as changed if their number or their digest (of all columns, in any order) isn't the one in the
    checklist at ``log``, which gets an entry for each date that is written. Months with such dates are written anew as
    partitions, first the data, then the checklist: a run that is repeated or was broken off adds nothing twice. Dates
    that ``df`` lacks stay; rows without a date are left out. One writer at a time.
    """
    spark, names = df.sparkSession, df.columns
    rows = written(df.where(F.col(date).isNotNull()).withColumn("__date", F.col(date).cast("date")), "commit-rows")
    digest = F.sum(F.xxhash64(*names).cast("decimal(20,0)")).cast("string")
    today = rows.groupBy(F.col("__date").alias("date")).agg(F.count("*").alias("n_rows"), digest.alias("digest"))
    done = checklist(spark, log)
    run = (done.agg(F.max("run")).first()[0] or 0) + 1
    changed = written(today.join(done.select("date", "n_rows", "digest"), ["date", "n_rows", "digest"], "left_anti").withColumn("run", F.lit(run)), "commit-dates")
    table = lambda: spark.read.schema(StructType([*df.schema.fields, StructField("month", StringType())])).parquet(path)
    if not changed.isEmpty():
        dates = changed.select(F.col("date").alias("__date"))
        month = F.date_format("__date", "yyyy-MM")
        fresh = rows.join(dates, "__date", "left_semi").withColumn("month", month)
        if exists(spark, path):
            months = dates.select(month.alias("month")).distinct()
            kept = table().join(F.broadcast(months), "month", "left_semi").withColumn("__date", F.col(date).cast("date"))
            fresh = fresh.unionByName(kept.join(dates, "__date", "left_anti"))
        write_partitioned(written(fresh.select(*names, "month"), "commit-months"), path, ["month"])
        changed.write.mode("append").parquet(log)
    return table().select(*names) if exists(spark, path) else df.where(F.lit(False))


def scan_files(df: DataFrame) -> DataFrame:
    """A Parquet scan with ``file``, the path of a row's file, and ``place``, its row number there."""
    return df.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))


def last_of_files(rows: DataFrame, n: int = 2) -> DataFrame:
    """The last ``n`` rows of each file of ``scan_files`` (S15): each file's end is an aggregate, so no file is one task's work."""
    ends = rows.groupBy("file").agg(F.max("place").alias("__end"))
    return rows.join(small_side(ends), "file").where(F.col("place") > F.col("__end") - n).drop("__end")


def read_grid(spark: SparkSession, base: str, variable: str, water_years: Sequence[int] = ()) -> DataFrame:
    """Files whose name has the variable, of the given water years' partitions."""
    df = spark.read.option("basePath", base).parquet(base, pathGlobFilter=f"*{variable}*")
    return df.where(F.col("wy").isin(*water_years)) if water_years else df


def water_year_of_name(name: Column) -> Column:
    """2026 of ``…wy2026…``, else null."""
    return F.regexp_extract(F.lower(name), r"wy(\d{4})", 1).try_cast("int")


def date_of_name(name: Column) -> Column:
    """The date at a name's end, before its extension."""
    return F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})(?:\.\w+)?$", 1).try_cast("date")


def discover(df: DataFrame, pattern: str, kind: str = "string") -> DataFrame:
    """Distinct values that a pattern's first group has in the scanned files' paths, newest first."""
    found = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).try_cast(kind).alias("found")
    return df.select(found).where("found IS NOT NULL").distinct().orderBy(F.desc("found"))


def model_of_path(path: Column, models: Sequence[str] = MODELS) -> tuple[Column, Column]:
    """(model, seasonality) of a prediction file's path; unknown models are null."""
    low = F.lower(path)
    model = F.regexp_extract(low, "(" + "|".join(models) + ")", 1)
    season = F.when(low.contains("accum"), "accum").when(low.contains("melt"), "melt").otherwise("season")
    return F.when(model != "", model), season


def last_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int = 2) -> DataFrame:
    """The last ``n`` rows of each file (or other group) in the given order."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")


def json_fields(text: Column, dates: Sequence[str], values: Sequence[str]) -> tuple[Column, Column]:
    """Date and value texts of a JSON object by candidate field names."""
    pick = lambda names: F.coalesce(*[F.get_json_object(text, f"$.{n}") for n in names])
    return pick(dates), pick(values)


def long_parameter(df: DataFrame, pattern: str = r"swe|water\s*content|water\s*equiv") -> DataFrame:
    """Rows of a long (parameter, value) table whose parameter names the wanted quantity."""
    return df.where(F.lower("parameter").rlike(pattern))


def quality_level(df: DataFrame, level: str = "1") -> DataFrame:
    """Rows of the wanted quality-control level."""
    return df.where(F.col("quality_control_level_code") == level)


def product_series(df: DataFrame, station, water_year: int, value: str) -> DataFrame:
    """One station's column of a product table from the start of its water year on."""
    return df.where((F.col("station") == station) & (F.col("date") >= F.make_date(F.lit(water_year - 1), F.lit(10), F.lit(1)))).select("date", value)


def register_survey(survey: DataFrame, mask: DataFrame, path: str, keys: Sequence[str] = ("y", "x")) -> None:
    """Keep a new survey's cells inside the mask and write its date's partition."""
    write_partitioned(survey.join(mask.select(*keys).distinct(), list(keys), "left_semi"), path, ["date"])
