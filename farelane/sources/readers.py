"""Reading trips and scoring input from CSV and Parquet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.operators.quality import is_valid_trip
from farelane.schema import TRIPS, cast_trips, nan_to_null, null_safe_hash, typed_column
from farelane.session import fresh_path, prepare

CORRUPT = "_corrupt_record"
#: Columns of a landed file beside the input's own: which fields do not parse, the text of the
#: fields of such a line, and whether it is one.
ERRORS, FIELDS, REJECTED = "errors_", "fields_", "rejected_"


def file_format(path: str) -> str:
    """``parquet`` or ``csv`` by suffix; anything else is an error before any job starts."""
    for fmt in ("parquet", "csv"):
        if path.rstrip("/").endswith(f".{fmt}"):
            return fmt
    raise ValueError(f"data must be .parquet or .csv: {path}")


def _csv_text(spark: SparkSession, path: str) -> DataFrame:
    # The header gives the names; a file of the folder with another header fails the read, since
    # columns are taken by their place.
    reader = spark.read.option("header", True).option("enforceSchema", False)
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    return (
        reader.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        # A line's malformedness must not depend on the columns a query happens to use.
        .option("columnPruning", False)
        .csv(path)
    )


def _unparsed(text: DataFrame) -> Column:
    """The names of the fields of a line that do not parse, ``line`` where it has too few or too
    many of them; a good line has none."""
    known = [n for n in text.columns if n in TRIPS.fieldNames()]
    found = [F.when(F.col(CORRUPT).isNotNull(), "line")]
    for n in known:
        if n not in ("key", "pickup_datetime"):
            found.append(F.when(F.col(n).isNotNull() & F.col(n).try_cast("double").isNull(), n))
    if "pickup_datetime" in known:
        ts = typed_column("pickup_datetime", T.StringType())
        found.append(F.when(F.col("pickup_datetime").isNotNull() & ts.isNull(), "pickup_datetime"))
    return F.array_compact(F.array(*found))


def _is_bad_line(text: DataFrame) -> Column:
    return F.size(_unparsed(text)) > 0


@dataclass(frozen=True)
class Landed:
    """An input as a job reads it: every row, typed, with how many rows there were and how many of
    them are lines that do not parse."""

    data: DataFrame
    rows: int
    rejected: int

    def all_rows(self) -> DataFrame:
        """Every row; a field that does not parse is null."""
        return self.data.drop(ERRORS, FIELDS, REJECTED)

    def trips(self, only_valid: bool = False) -> DataFrame:
        """The rows that parse, as ``read_trips`` gives them."""
        good = self.data.filter(~F.col(REJECTED)) if REJECTED in self.data.columns else self.data
        return _as_trips(good.drop(ERRORS, FIELDS, REJECTED), only_valid)

    def rejects(self) -> DataFrame | None:
        """The lines that do not parse, as text, with ``errors``, the names of their bad fields."""
        if REJECTED not in self.data.columns:
            return None
        return self.data.filter(REJECTED).select(f"{FIELDS}.*", F.col(ERRORS).alias("errors"))


def land(spark: SparkSession, path: str, fmt: str | None = None, rejects: str | None = None) -> Landed:
    """Read an input once for all passes of a job.

    A CSV is parsed in one pass, which writes its rows typed to the shared folder, the lines that do
    not parse apart from the others, and counts both (observed while they are written). ``rejects``
    is a path to which such lines are written, if there are any. A Parquet file is columns already:
    it is read where it is, its rows are counted from the footers, and it has no rejects.
    """
    prepare(spark)
    if (fmt or file_format(path)) == "parquet":
        raw = spark.read.parquet(path)
        return Landed(raw, raw.count(), 0)
    text = _csv_text(spark, path)
    names = [n for n in text.columns if n != CORRUPT]
    marked = text.withColumn(ERRORS, _unparsed(text)).withColumn(REJECTED, F.size(ERRORS) > 0)
    fields = F.when(F.col(REJECTED), F.struct(*[F.col(n) for n in names]))
    if "key" not in names:
        marked = marked.withColumn("key", null_safe_hash(names))
    typed = nan_to_null(cast_trips(marked.withColumn(FIELDS, fields).drop(CORRUPT)))
    seen = Observation()
    landed = fresh_path(spark, "landed")
    counted = typed.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(REJECTED).alias("rejected"))
    counted.write.partitionBy(REJECTED).parquet(landed)
    n = seen.get
    # The types are given, since an input without rows has no folder to tell them from.
    data = spark.read.schema(typed.schema).parquet(landed)
    found = Landed(data, n["rows"], n["rejected"])
    if rejects is not None and found.rejected:
        found.rejects().write.mode("overwrite").parquet(rejects)
    return found


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """Scoring input, format by suffix: known columns typed, all rows and columns kept."""
    prepare(spark)
    if file_format(path) == "parquet":
        return nan_to_null(cast_trips(spark.read.parquet(path)))
    return nan_to_null(cast_trips(_csv_text(spark, path).drop(CORRUPT)))


def read_trips(
    spark: SparkSession, path: str, fmt: str | None = None, only_valid: bool = False
) -> DataFrame:
    """Labelled trips with the columns of ``TRIPS``, plus whatever else the file has.

    ``only_valid`` cleans on the raw columns, below the NaN handling, so that the rules
    reach the Parquet scan as pushed filters. CSV lines that do not parse are left to
    ``read_trip_rejects``; a job reads with ``land``, which counts and keeps them. A file without a
    ``key`` gets one hashed from its columns.
    """
    prepare(spark)
    if (fmt or file_format(path)) == "parquet":
        raw = spark.read.parquet(path)
    else:
        text = _csv_text(spark, path)
        raw = text.filter(~_is_bad_line(text)).drop(CORRUPT)
    return _as_trips(raw, only_valid)


def _as_trips(raw: DataFrame, only_valid: bool) -> DataFrame:
    if "key" not in raw.columns:
        raw = raw.withColumn("key", null_safe_hash(raw.columns))
    missing = [n for n in TRIPS.fieldNames() if n not in raw.columns]
    if missing:
        raise ValueError(f"not a trip table, columns missing: {', '.join(missing)}")
    trips = cast_trips(raw)
    if only_valid:
        trips = trips.filter(is_valid_trip(trips))
    rest = [c for c in trips.columns if c not in TRIPS.fieldNames()]
    return nan_to_null(trips).select(*TRIPS.fieldNames(), *rest)


def read_trip_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The CSV lines ``read_trips`` leaves out, as text columns."""
    prepare(spark)
    text = _csv_text(spark, path)
    return text.filter(_is_bad_line(text))


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``length`` of each file below ``path``; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length")


def dataset_profile(
    spark: SparkSession,
    path: str,
    fraction: float = 0.1,
    fmt: str | None = None,
    rejects: str | None = None,
) -> DataFrame:
    """One row: bytes on disk, rows, the row number of the leading ``fraction``, and how many rows
    are lines that do not parse.

    All rows of the file count, bad lines of a CSV too. Parquet rows are counted from the footers.
    Without ``rejects`` a CSV's lines are counted without looking at their fields, and
    ``rejected_rows`` is null; with it the file is parsed, in one pass, and its bad lines written there.
    """
    prepare(spark)
    size = file_sizes(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    rejected = F.lit(None).cast("long")
    if (fmt or file_format(path)) == "parquet":
        total = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("total_rows"))
        rejected = F.lit(0).cast("long")
    elif rejects is None:
        total = spark.read.option("header", True).csv(path).agg(F.count(F.lit(1)).alias("total_rows"))
    else:
        found = land(spark, path, "csv", rejects)
        total = spark.range(1).select(F.lit(found.rows).cast("long").alias("total_rows"))
        rejected = F.lit(found.rejected).cast("long")
    return total.select(
        size.scalar().alias("bytes"),
        "total_rows",
        F.floor(F.col("total_rows") * fraction).cast("long").alias("head_rows"),
        rejected.alias("rejected_rows"),
    )


def read_requests(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """A stream of request texts, one JSON object per line, in column ``value``.

    A micro-batch takes ``max_files`` files at most, so that a backlog is many batches and not
    one; all files are read in the end.
    """
    prepare(spark)
    return spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(path)

