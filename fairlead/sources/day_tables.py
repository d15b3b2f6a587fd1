"""Stage tables partitioned by day, with a record of what each day was made from."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fairlead.sources.stages import Folder

DAY = "file_day"
RECORD = f"{DAY} string, version string, inputs array<string>, recorded bigint"
#: Setting by which adaptive execution merges small shuffle partitions.
MERGING = "spark.sql.adaptive.coalescePartitions.enabled"
#: Days that one write may leave to a single task.
DAYS_PER_TASK = 8
#: Seconds for which a replaced day stays readable.
RETENTION_SEC = 7 * 86_400


def new_version() -> str:
    """A name that sorts after all earlier ones."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def begun(version: str) -> int:
    """When a version was begun, in nanoseconds since 1970."""
    return int(version.split("-", 1)[0])


def pending_days(requested: DataFrame, done: DataFrame) -> DataFrame:
    """Requested days that are not done yet."""
    return requested.select(DAY).distinct().join(done.select(DAY), DAY, "left_anti")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``; absent ones are NULL."""
    present = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        )
    )


def write_days(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replaces the days that ``df`` has rows of below ``path`` and leaves others alone.

    A day without rows is not known here and keeps what it has; :class:`DayTable`
    replaces whole days, empty ones as well. Rebalancing by day lets adaptive
    execution merge small days and split large ones, so neither tiny files nor
    one task per day result. ``fmt="csv"`` writes text with a header line.
    """
    (
        df.hint("rebalance", F.col(DAY))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy(DAY)
        .format(fmt)
        .save(path)
    )


def read_days(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet"
) -> DataFrame:
    """Typed rows written by :func:`write_days`; none if no day had any."""
    return spark.read.schema(schema).option("header", True).format(fmt).load(path)


@dataclass(frozen=True)
class Record:
    """What one write says of one day: its version, what it was made from, when it was recorded."""

    day: str
    version: str
    inputs: tuple[str, ...]
    recorded: int


class DayTable:
    """One stage's output under ``root/name`` and a manifest of its days.

    Every write goes to a new folder ``version=...``. Then one row per day is
    appended to the manifest with the version and the inputs it was made from,
    so a day is replaced whole, also by nothing, in one step: until its record is
    written, readers see the old version. Readers take the latest recorded version
    of each day. What nobody reads any more goes with :meth:`vacuum`. One job at a
    time writes a table; readers need no lock.
    """

    def __init__(
        self, spark: SparkSession, root: str, name: str, schema: str, fmt: str = "parquet"
    ):
        self.spark = spark
        self.path = f"{root}/{name}"
        self.done_path = f"{root}/{name}_done"
        self.schema = StructType.fromDDL(schema)
        self.fmt = fmt
        self._recorded = False

    def read(self, days: list[str] | None = None) -> DataFrame:
        """Rows of the given days (default: all) in their latest version."""
        chosen: dict[str, list[str]] = {}
        for day, (version, _) in self.latest().items():
            if days is None or day in days:
                chosen.setdefault(version, []).append(day)
        if not chosen:
            return self.spark.createDataFrame([], self.schema)
        stored = StructType([*self.schema.fields]).add("version", "string")
        wanted = F.lit(False)
        for version, of_version in chosen.items():
            wanted = wanted | ((F.col("version") == version) & F.col(DAY).isin(of_version))
        rows = read_days(self.spark, self.path, stored, self.fmt)
        return rows.where(wanted).select(*self.schema.names)

    def write(self, df: DataFrame, inputs: dict[str, list[str]]) -> None:
        """Writes ``df``, the whole result of the days ``inputs`` names, and records them.

        Every day is a file of its own, and opening files takes the time where days
        are small. So many days are not merged into one task by their bytes.
        """
        version = new_version()
        conf = self.spark.conf
        before = conf.get(MERGING, "true")
        if len(inputs) > DAYS_PER_TASK:
            conf.set(MERGING, "false")
        try:
            write_days(conform(df, self.schema), f"{self.path}/version={version}", self.fmt)
        finally:
            conf.set(MERGING, before)
        now = time.time_ns()
        self._record([Record(day, version, tuple(sorted(made)), now) for day, made in inputs.items()])

    def _record(self, records: list[Record]) -> None:
        rows = [(r.day, r.version, list(r.inputs), r.recorded) for r in records]
        frame = self.spark.createDataFrame(rows, RECORD)
        frame.coalesce(1).write.mode("append").parquet(self.done_path)
        self._recorded = True

    def done(self) -> DataFrame:
        """The manifest: one row per day and write."""
        if not self._recorded:
            # Creates the table unless it is there.
            empty = self.spark.createDataFrame([], RECORD)
            empty.write.mode("ignore").parquet(self.done_path)
            self._recorded = True
        return self.spark.read.schema(RECORD).parquet(self.done_path)

    def latest(self) -> dict[str, tuple[str, list[str]]]:
        """Version and inputs of each finished day; one row per day comes to the driver."""
        newest = self.done().groupBy(DAY).agg(F.max(F.struct("version", "inputs")).alias("last"))
        return {r[DAY]: (r["last"]["version"], list(r["last"]["inputs"])) for r in newest.collect()}

    def pending(self, wanted: dict[str, list[str]]) -> dict[str, list[str]]:
        """The days of ``wanted`` (inputs by day) not yet made from exactly these inputs."""
        finished = self.latest()
        return {
            day: inputs
            for day, inputs in sorted(wanted.items())
            if day not in finished or finished[day][1] != sorted(inputs)
        }

    def vacuum(self, retention_sec: int = RETENTION_SEC) -> list[str]:
        """Removes what has not been readable for ``retention_sec`` and returns the paths.

        Goes: the folder of a day whose next version was recorded that long ago,
        so that readers which began before could end; and folders without a
        record, left by broken writes, begun that long ago (longer than the
        longest write must take). The manifest is rewritten as one file of the
        records still needed; files it replaces go after the same time. Reads
        the manifest and lists folders, never rows.
        """
        before = time.time_ns() - int(retention_sec * 1e9)
        files = Folder(self.spark, self.done_path)
        old_records = [f for f in files.children() if f.endswith(".parquet")] if files.exists() else []
        # Records of an earlier layout have no time of their own.
        records = [
            Record(r[DAY], r["version"], tuple(r["inputs"]), r["recorded"] or begun(r["version"]))
            for r in self.done().distinct().collect()
        ]
        by_day: dict[str, list[Record]] = {}
        for r in sorted(records, key=lambda r: r.version):
            by_day.setdefault(r.day, []).append(r)
        current = {rs[-1].version for rs in by_day.values()}
        replaced = {
            (old.day, old.version): new.recorded for rs in by_day.values() for old, new in zip(rs, rs[1:])
        }
        in_use = {(rs[-1].day, rs[-1].version) for rs in by_day.values()}

        gone, kept = [], set(in_use)
        table = Folder(self.spark, self.path)
        for name in table.children() if table.exists() else []:
            if not name.startswith("version="):
                continue
            version, folder, left = name.removeprefix("version="), table.child(name), 0
            for part in folder.children():
                key = (unquote(part.removeprefix(f"{DAY}=")), version)
                if not part.startswith(f"{DAY}=") or key in in_use:
                    left += key in in_use
                elif replaced.get(key, begun(version)) < before:
                    gone.append(folder.child(part).remove())
                else:
                    left += 1
                    kept.add(key)
            if not left and version not in current and begun(version) < before:
                gone.append(folder.remove())

        needed = [r for r in records if (r.day, r.version) in kept]
        if len(old_records) > 1 and needed:
            self._record(needed)
        stale = [f for f in old_records if files.child(f).modified_ns() < before] if len(old_records) > 1 else []
        return gone + [files.child(f).remove() for f in stale]
