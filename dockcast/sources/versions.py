"""Tables that are replaced as a whole: numbered versions, a pointer to the committed one, retention.

A version is written beside the others and counts only once the pointer file names
it; the pointer is replaced by an atomic rename.  A crash between the two leaves the
version before readable, and a repeated write of the same number replaces the
unfinished one.  Versions older than the last ``keep`` committed ones are removed
after a commit.  Batch and stream writers share this.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT"
KEEP = 2


def _fs(spark: SparkSession, out: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(out).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _numbers(spark: SparkSession, out: str) -> list[int]:
    """Numbers of all version folders, finished or not."""
    fs, path = _fs(spark, out)
    if not fs.exists(path(out)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path(out)) if s.isDirectory()]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("version="))


def current(spark: SparkSession, out: str) -> int | None:
    """The committed version's number, None if nothing was committed."""
    fs, path = _fs(spark, out)
    pointer = path(f"{out}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return int(stream.readLine())
    finally:
        stream.close()


def committed(spark: SparkSession, out: str, before: int | None = None) -> int | None:
    """The newest version up to the pointer (and below ``before``) that is still kept."""
    now = current(spark, out)
    found = [n for n in _numbers(spark, out) if now is not None and n <= now and (before is None or n < before)]
    return found[-1] if found else None


def read(spark: SparkSession, out: str, before: int | None = None, fmt: str = "parquet") -> DataFrame | None:
    """The committed table (or the one before version ``before``); None if there is none."""
    n = committed(spark, out, before)
    if n is None:
        return None
    reader = spark.read.option("header", True).option("inferSchema", True) if fmt == "csv" else spark.read
    return reader.format(fmt).load(f"{out}/version={n}")


def write(df: DataFrame, out: str, number: int, fmt: str = "parquet") -> None:
    """Write a version without committing it."""
    df.write.mode("overwrite").format(fmt).option("header", True).save(f"{out}/version={number}")


def point(spark: SparkSession, out: str, number: int, keep: int = KEEP) -> None:
    """Commit a written version and remove those no longer kept."""
    fs, path = _fs(spark, out)
    temporary = path(f"{out}/{POINTER}.{number}")
    stream = fs.create(temporary, True)
    stream.writeBytes(f"{number}\n")
    stream.close()
    jvm = spark._jvm.org.apache.hadoop.fs
    overwrite = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
    overwrite[0] = jvm.Options.Rename.OVERWRITE
    target = fs.makeQualified(path(f"{out}/{POINTER}"))
    jvm.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(temporary), target, overwrite)
    for old in [n for n in _numbers(spark, out) if n <= number][:-max(1, keep)]:
        fs.delete(path(f"{out}/version={old}"), True)


def commit(df: DataFrame, out: str, number: int | None = None, keep: int = KEEP, fmt: str = "parquet") -> int:
    """Write ``df`` as the next version (or as ``number``) and make it the table."""
    spark = df.sparkSession
    if number is None:
        number = (current(spark, out) if current(spark, out) is not None else -1) + 1
    write(df, out, number, fmt)
    point(spark, out, number, keep)
    return number
