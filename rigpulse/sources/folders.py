"""Partition folders of stored tables, looked up by name through the file system Spark uses.

Only folder names are listed: a table's files are never opened to find out which folders it has.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Sequence
from datetime import date

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rigpulse.schemas import DAY_PARTITION

DONE = "_SUCCESS"
# Hidden folder of a table with days that compaction has merged but not yet put in place.
COMPACTING = "_compacting"


def _handle(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _handle(spark, path)
    return files.exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """Folders right below a path, hidden ones left out; none when the path does not exist."""
    files, at = _handle(spark, path)
    if not files.exists(at):
        return []
    found = [s.getPath().getName() for s in files.listStatus(at) if s.isDirectory()]
    return sorted(n for n in found if n[0] not in "_.")


def hidden(spark: SparkSession, path: str, done: bool = True) -> list[str]:
    """Folders below a path that readers of the table skip; finished ones unless told otherwise."""
    files, at = _handle(spark, path)
    if not files.exists(at):
        return []
    found = [f"{path}/{s.getPath().getName()}" for s in files.listStatus(at) if s.isDirectory()]
    return sorted(f for f in found if not done or exists(spark, f"{f}/{DONE}"))


def age(spark: SparkSession, path: str) -> float:
    """Seconds since the folder was last written to, by the file system's clock and this one's."""
    files, at = _handle(spark, path)
    now = spark._jvm.java.lang.System.currentTimeMillis()
    return (now - files.getFileStatus(at).getModificationTime()) / 1000


def text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    files, at = _handle(spark, path)
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def make(spark: SparkSession, path: str) -> None:
    files, at = _handle(spark, path)
    files.mkdirs(at)


def touch(spark: SparkSession, path: str) -> None:
    files, at = _handle(spark, path)
    files.create(at, True).close()


def rename(spark: SparkSession, path: str, to: str) -> None:
    files, at = _handle(spark, path)
    if not files.rename(at, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot rename {path} to {to}")


def drop(spark: SparkSession, path: str) -> None:
    files, at = _handle(spark, path)
    files.delete(at, True)


def drop_if_empty(spark: SparkSession, path: str) -> None:
    """Remove a folder that holds no visible file or folder any more."""
    files, at = _handle(spark, path)
    if files.exists(at) and not any(
        s.getPath().getName()[0] not in "_." for s in files.listStatus(at)
    ):
        files.delete(at, True)


def file_count(spark: SparkSession, path: str) -> int:
    """Data files anywhere below a path."""
    files, at = _handle(spark, path)
    if not files.exists(at):
        return 0
    listed, count = files.listFiles(at, True), 0
    while listed.hasNext():
        count += listed.next().getPath().getName().endswith(".parquet")
    return count


def order_files(spark: SparkSession, path: str) -> None:
    """Give the data files of a folder rising times by name, a second apart. A file stream takes
    files in the order of their times, and tasks end in any order."""
    files, at = _handle(spark, path)
    found = [s.getPath() for s in files.listStatus(at) if s.getPath().getName().endswith(".parquet")]
    newest = files.getFileStatus(at).getModificationTime() // 1000
    for back, file in enumerate(sorted(found, key=lambda f: f.getName(), reverse=True)):
        wanted = (newest - back) * 1000
        files.setTimes(file, wanted, -1)
        if files.getFileStatus(file).getModificationTime() != wanted:
            raise OSError(f"file times cannot be set: {file}")


def days(spark: SparkSession, path: str) -> dict[date, str]:
    """Day folders of a table kept by day: day -> path."""
    stem = f"{DAY_PARTITION}="
    return {
        date.fromisoformat(n.removeprefix(stem)): f"{path}/{n}"
        for n in names(spark, path)
        if n.startswith(stem) and n != f"{stem}__HIVE_DEFAULT_PARTITION__"
    }


def batches(spark: SparkSession, day_folder: str) -> dict[int, str]:
    """Batch folders of a day: batch id -> path."""
    return {
        int(n.removeprefix("batch_id=")): f"{day_folder}/{n}"
        for n in names(spark, day_folder)
        if n.startswith("batch_id=")
    }


def merged_days(spark: SparkSession, path: str) -> dict[date, tuple[int, str]]:
    """Days that wait to be put in place: day -> (newest batch merged, folder)."""
    found = {}
    for day, at in days(spark, f"{path}/{COMPACTING}").items():
        for name in names(spark, at):
            if exists(spark, f"{at}/{name}/{DONE}"):
                found[day] = int(name.removeprefix("upto=")), f"{at}/{name}"
    return found


def without_batches(
    spark: SparkSession, paths: Iterable[str], without: Collection[int]
) -> list[str]:
    """The folders that hold batches, less those of the batches named: a folder with one of them
    is opened up. A folder that compaction put in place holds more than its number says and is
    never left out; the mark it was shown by is still in it."""
    chosen = []
    for path in paths:
        inside = batches(spark, path)
        out = {b for b in inside if b in without and not exists(spark, f"{inside[b]}/{DONE}")}
        chosen += [p for b, p in inside.items() if b not in out] if out else [path]
    return chosen


def read_days(
    spark: SparkSession,
    path: str,
    chosen: Iterable[date] | None,
    schema: T.StructType,
    without: Collection[int] = (),
) -> DataFrame | None:
    """Rows of some days of a table kept by day, of all days for None; ``schema`` names what to
    read, on_day and batch_id among it. No other day's folder is listed. Days merged by compaction
    come from the merged folder and the batches after it. With ``without`` the folders of those
    batches are not read, and there is no frame when none is left."""
    present_days, merged = days(spark, path), merged_days(spark, path)
    wanted = sorted({*present_days, *merged} if chosen is None else set(chosen))
    paths = [present_days[d] for d in wanted if d in present_days and d not in merged]
    undated = f"{path}/{DAY_PARTITION}=__HIVE_DEFAULT_PARTITION__"
    if chosen is None and exists(spark, undated):
        paths.append(undated)
    for day in wanted:
        if day in merged and day in present_days:
            later = batches(spark, present_days[day]).items()
            paths += [p for b, p in later if not 0 <= b <= merged[day][0] and b not in without]
    if without:
        paths = without_batches(spark, paths, without)
        if not paths and not any(d in merged for d in wanted):
            return None
    rows = read(spark, path, paths, schema)
    for day in wanted:
        if day in merged:
            upto, folder = merged[day]
            plain = T.StructType([f for f in schema.fields if f.name not in (DAY_PARTITION, "batch_id")])
            part = spark.read.schema(plain).parquet(folder).withColumns(
                {DAY_PARTITION: F.lit(day), "batch_id": F.lit(upto).cast("bigint")}
            )
            rows = rows.unionByName(part.select(*schema.fieldNames()))
    return rows


def dated_schema(schema: T.StructType) -> T.StructType:
    """A table's columns with those its folders add."""
    return T.StructType(
        [
            *schema.fields,
            T.StructField(DAY_PARTITION, T.DateType()),
            T.StructField("batch_id", T.LongType()),
        ]
    )


def read(
    spark: SparkSession, root: str, paths: Iterable[str], schema: T.StructType
) -> DataFrame:
    """Rows of some folders of a table, with the partition columns of their names."""
    chosen = sorted(paths)
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*chosen)


def present(spark: SparkSession, root: str, relative: Sequence[str]) -> list[str]:
    """Those of some relative folder names that the table has."""
    return [f"{root}/{r}" for r in relative if exists(spark, f"{root}/{r}")]
