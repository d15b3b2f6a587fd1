"""Daily CSV files of position reports."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# --- Fixed values: headers of the feed, in file order, and our column names ---
FEED_COLUMNS = {
    "# Timestamp": "timestamp",
    "Type of mobile": "type_of_mobile",
    "MMSI": "mmsi",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Navigational status": "navigational_status",
    "ROT": "rot",
    "SOG": "sog",
    "COG": "cog",
    "Heading": "heading",
    "IMO": "imo",
    "Callsign": "callsign",
    "Name": "name",
    "Ship type": "ship_type",
    "Cargo type": "cargo_type",
    "Width": "width",
    "Length": "length",
    "Type of position fixing device": "position_fixing_device",
    "Draught": "draught",
    "Destination": "destination",
    "ETA": "eta",
    "Data source type": "data_source_type",
}
FEED_DATE_FORMAT = "dd/MM/yyyy"
FEED_TIME_FORMAT = "dd/MM/yyyy HH:mm:ss"
# --- End of fixed values ---

NUMBERS = ("latitude", "longitude", "sog", "cog", "heading", "rot")
TRIMMED = ("mmsi", "name", "navigational_status")

DATE = r"\d{4}-\d{2}-\d{2}"
#: A folder that names the day of its files, as partitioned tables have it.
DAY_FOLDER = rf"/[^/=]+=({DATE})(?=/)"


def day_of_path(path: str) -> str:
    """Label of the day a file belongs to.

    The date in the file's name, else in the nearest folder like
    ``day=2021-12-01``, else the name up to its first point.
    """
    name = path.rstrip("/").rsplit("/", 1)[-1]
    dates = re.findall(DATE, name) or re.findall(DAY_FOLDER, path)
    return dates[-1] if dates else name.split(".", 1)[0]


def is_dated(path: str) -> bool:
    """Whether the label of a file is a date."""
    return re.fullmatch(DATE, day_of_path(path)) is not None


def files_by_day(files: list[str]) -> dict[str, list[str]]:
    """Files of each day. Fails if two files without a date would share a label."""
    days: dict[str, list[str]] = {}
    for path in files:
        days.setdefault(day_of_path(path), []).append(path)
    for label, same in days.items():
        if len(same) > 1 and not all(map(is_dated, same)):
            raise ValueError(f"files without a date share the label {label!r}: {sorted(same)}")
    return days


def plain_path() -> Column:
    """Percent-encoded path of the file a row was read from; a plus sign in it stands for itself."""
    return F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))


def file_day() -> Column:
    """:func:`day_of_path` of the file a row was read from.

    It is worked out for every row, so the name is split off without a pattern,
    which would try each place of the path.
    """
    path = F.url_decode(plain_path())
    name = F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)
    in_name = F.regexp_extract_all(name, F.lit(f"({DATE})"))
    in_folder = F.regexp_extract_all(path, F.lit(DAY_FOLDER))
    return F.coalesce(
        F.try_element_at(in_name, F.lit(-1)),
        F.try_element_at(in_folder, F.lit(-1)),
        F.substring_index(name, ".", 1),
    )


def discover_files(
    spark: SparkSession, folder: str, pattern: str = "*.csv", nested: bool = False
) -> list[str]:
    """Sorted paths below ``folder`` whose name matches; fails when there are none.

    ``nested`` also looks into subfolders.
    """
    listing = (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", nested)
        .schema("line string")
        .csv(folder)
    )
    files = sorted(unquote(f) for f in listing.inputFiles())
    if not files:
        raise FileNotFoundError(f"no file in {folder} matches {pattern}")
    return files


def read_feed(spark: SparkSession, files: str | list[str], bad_line: str | None = None) -> DataFrame:
    """CSV rows of one layout as strings, named by the header, plus ``file_day``.

    All files must have the header of the first one; another layout fails
    instead of shifting columns, see :func:`read_mixed_feed`. With ``bad_line``,
    a column of that name holds the text of lines that have more or fewer
    fields than the header and is NULL for others; such lines stay rows, with
    what fields they have.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    rows = reader.csv(files)
    if bad_line:
        schema = StructType([*rows.schema.fields, StructField(bad_line, StringType())])
        # Fields are counted only where all of them are parsed.
        whole = reader.schema(schema).option("columnPruning", False)
        rows = whole.option("columnNameOfCorruptRecord", bad_line).csv(files)
    return rows.select("*", file_day().alias("file_day"))


#: One task for each piece of a file.
FIRST_LINES = {
    "spark.sql.files.openCostInBytes": str(1 << 30),
    "spark.sql.files.maxPartitionBytes": str(1 << 30),
}
#: Bits of a row's number that tell the rows of one task apart.
ROW_IN_TASK = (1 << 33) - 1


def headers(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """First line of each file that has one, in one job.

    A task reads one piece of a file and gives its first row, which is the
    header if the piece begins the file. Rows are told apart by their number
    within the task, so the lines are scanned as plain text and no Python
    process is started per file. The settings for that hold in a session of
    their own.
    """
    session = spark.newSession()
    for key, value in FIRST_LINES.items():
        session.conf.set(key, value)
    lines = session.read.text(files).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
        F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_IN_TASK)).alias("row"),
    )
    found = lines.where("row = 0 AND start = 0").select("path", "value").collect()
    return {unquote(r["path"]): r["value"] for r in sorted(found)}


def by_layout(spark: SparkSession, files: list[str]) -> dict[str, list[str]]:
    """Files by header line, without empty files unless all are empty."""
    layouts: dict[str, list[str]] = {}
    for path, header in headers(spark, files).items():
        if header.strip():
            layouts.setdefault(header, []).append(path)
    return layouts or {"": files}


def read_mixed_feed(spark: SparkSession, files: list[str], bad_line: str | None = None) -> DataFrame:
    """:func:`read_feed` of files of any layouts, united by column name.

    Files are grouped by their header; a column that a layout lacks is NULL.
    """
    layouts = by_layout(spark, files).values()
    parts = [read_feed(spark, same, bad_line).transform(normalize_columns) for same in layouts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def bad_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file_day, file, line) of the lines that have more or fewer fields than their header."""
    parts = []
    for same in by_layout(spark, files).values():
        rows = read_feed(spark, same, "line")
        if rows.columns[0] == "line":  # files without any field
            continue
        # Spark refuses to read the text of bad lines alone, without a field.
        whole = F.length(F.coalesce(F.col(rows.columns[0]), F.lit(""))) >= 0
        found = rows.where(F.col("line").isNotNull() & whole)
        parts.append(found.select("file_day", F.url_decode(plain_path()).alias("file"), "line"))
    none = spark.createDataFrame([], "file_day string, file string, line string")
    return reduce(DataFrame.unionAll, parts, none)


def normalize_columns(feed: DataFrame) -> DataFrame:
    """Our column names for the headers that are present."""
    return feed.withColumnsRenamed(FEED_COLUMNS)


def feed_time(text: Column) -> Column:
    """Instant of a feed time, which is UTC whatever the session time zone."""
    zoned = F.concat(text, F.lit(" +0000"))
    return F.try_to_timestamp(zoned, F.lit(f"{FEED_TIME_FORMAT} xx"))


def standardize_types(feed: DataFrame) -> DataFrame:
    """Typed points from normalized string rows; unreadable values become NULL.

    Adds ``ts``, the time in epoch seconds.
    """
    present = set(feed.columns)
    typed = {"timestamp": feed_time(F.col("timestamp"))}
    typed |= {c: F.col(c).try_cast("double") for c in NUMBERS if c in present}
    typed |= {c: F.trim(c) for c in TRIMMED if c in present}
    return feed.withColumns(typed).withColumn("ts", F.unix_seconds("timestamp"))


def read_points(
    spark: SparkSession, files: str | list[str], bad_line: str | None = None
) -> DataFrame:
    """Typed points of CSV files of any layouts, keyed by ``file_day``; see :func:`read_feed`."""
    feed = read_mixed_feed(spark, [files] if isinstance(files, str) else files, bad_line)
    return feed.transform(normalize_columns).transform(standardize_types)


def feed_date(ts: Column) -> Column:
    """UTC date of epoch seconds, whatever the session time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(ts / 86400).cast("int"))


def feed_text(ts: Column) -> Column:
    """Epoch seconds in the time format of the feed; reverse of :func:`feed_time`."""
    second = F.pmod(ts, F.lit(86400))
    clock = F.format_string(
        "%02d:%02d:%02d", F.floor(second / 3600), F.floor(second / 60) % 60, second % 60
    )
    text = F.concat_ws(" ", F.date_format(feed_date(ts), FEED_DATE_FORMAT), clock)
    return F.when(ts.isNotNull(), text)


def as_feed(points: DataFrame) -> DataFrame:
    """Points in the headers and time format of the feed, as strings."""
    when = feed_text(F.col("ts"))
    present = set(points.columns)
    return points.select(
        when.alias("# Timestamp"),
        *(
            F.col(c).cast("string").alias(header)
            for header, c in FEED_COLUMNS.items()
            if c in present and c != "timestamp"
        ),
    )
