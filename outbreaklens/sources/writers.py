"""Writers of result tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow.fs import FileSystem, FileType
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outbreaklens.operators.star import only_new
from outbreaklens.session import bound_batches

FOLDER_FILES = 1000


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a Parquet table."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Replace a CSV table; blanks at the ends of a text stay."""
    df.write.mode("overwrite").csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def write_bulletins(texts: DataFrame, path: str) -> None:
    """One text file a bulletin, `<bulletin>.txt`; two texts of one name are an error.

    Tasks write the files themselves, by name, into folders of about `FOLDER_FILES` files: Spark's writer would give every
    file a folder of its own, and move each of them twice. A file that is written again is the same file. Of a file system
    that tasks cannot open, Spark's writer takes over; there a bulletin's folder carries the name.
    """
    names = texts.groupBy("bulletin").count()
    told = names.agg(F.sum("count").alias("rows"), F.max("count").alias("most")).first()
    if (told["most"] or 0) > 1:
        raise ValueError(f"two texts for {names.where('count > 1').first()['bulletin']}")
    named = texts.select("bulletin", F.coalesce("text", F.lit("")).alias("value"))
    folder = local_folder(texts.sparkSession, path)
    if folder is None:
        named = named.select(F.concat("bulletin", F.lit(".txt")).alias("file"), "value")
        named.repartition("file").write.partitionBy("file").mode("overwrite").option("lineSep", "\n").text(path)
        return
    files, at = FileSystem.from_uri(folder)
    if files.get_file_info(at).type != FileType.NotFound:
        files.delete_dir(at)
    files.create_dir(at, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, at = FileSystem.from_uri(folder)
        there = set()
        for batch in batches:
            for part, name, value in zip(*(column.to_pylist() for column in batch.columns)):
                own = f"{at}/part={part}"
                if own not in there:
                    files.create_dir(own, recursive=True)
                    there.add(own)
                with files.open_output_stream(f"{own}/{_file_name(name)}") as out:
                    out.write(value.encode() + b"\n")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    bound_batches(texts.sparkSession)
    part = F.pmod(F.crc32(F.coalesce("bulletin", F.lit("")).cast("binary")), F.lit(1 + (told["rows"] or 0) // FOLDER_FILES))
    written = named.select(part.alias("part"), "bulletin", "value").mapInArrow(write, "n long").agg(F.sum("n")).first()[0]
    if (written or 0) != (told["rows"] or 0):
        raise RuntimeError(f"{written} files written for {told['rows']} texts")


def local_folder(spark: SparkSession, path: str) -> str | None:
    """The address of a folder that tasks can open by themselves, or None."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    scheme = urlsplit(path).scheme or urlsplit(default).scheme
    return urlsplit(path).path.rstrip("/") if scheme == "file" else None


def _file_name(name: str | None) -> str:
    """The name of a bulletin's file; what a file name or a listing would not keep is escaped."""
    if not name:
        return "%01.txt" if name == "" else "%00.txt"
    kept = quote(name, safe="")
    return f"%{ord(kept[0]):02X}{kept[1:]}.txt" if kept[0] in "._" else f"{kept}.txt"


def write_extractions(records: DataFrame, path: str) -> None:
    """Nested records as JSON lines in UTF-8."""
    records.write.mode("overwrite").json(path)


def replace_tables(tables: dict[str, DataFrame], folder: str) -> str:
    """Replace star tables under one folder together, and register each as a view of its name.

    The tables go to a folder of a new version. Only when all are written, one row with the version is appended to the
    pointer, and readers (`readers.current_tables`) follow the pointer: before, during and after a failed replacement they
    see all tables of one version. Returns the version's folder.
    """
    folder = folder.rstrip("/")
    spark = next(iter(tables.values())).sparkSession
    version = (latest_version(spark, folder) or (0, ""))[0] + 1
    path = f"{folder}/versions/{version:010d}-{uuid.uuid4().hex}"
    for name, df in tables.items():
        write_table(df, f"{path}/{name}")
    pointer = spark.createDataFrame([(version, path.rsplit("/", 1)[1])], "version long, name string")
    pointer.coalesce(1).write.mode("append").parquet(f"{folder}/pointer")
    register(spark, path, list(tables))
    return path


def register(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    """The tables of one version, each registered as a view of its name."""
    found = {name: spark.read.parquet(f"{path}/{name}") for name in names}
    for name, df in found.items():
        df.createOrReplaceTempView(name)
    return found


def latest_version(spark: SparkSession, folder: str) -> tuple[int, str] | None:
    """Number and folder name of the last version that was written whole; of two of one number the later by name."""
    try:
        pointer = spark.read.schema("version long, name string").parquet(f"{folder.rstrip('/')}/pointer")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    last = pointer.agg(F.max(F.struct("version", "name"))).first()[0]
    return tuple(last) if last else None


def append_articles(manifest: DataFrame, stored: DataFrame, path: str) -> None:
    """Append the articles that are not stored yet; `manifest` holds name and article text."""
    fresh = only_new(manifest, stored).withColumn("n_chars", F.length("article"))
    fresh.write.mode("append").parquet(path)
