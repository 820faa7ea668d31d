"""Readers of the raw inputs. Dirty columns are read as text and repaired later."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outbreaklens.functions.html import article_text
from outbreaklens.functions.text import bulletin_date, bulletin_number, date_or_error, file_stem, null_if_missing
from outbreaklens.operators.cleaning import ENTRY
from outbreaklens.session import BATCH_BYTES
from outbreaklens.sources import csvsplit
from outbreaklens.sources.schemas import EXTRACTION, ZONES_GEOJSON
from outbreaklens.sources.writers import latest_version, local_folder, register


CSV = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
TASK_FOLDERS = 8


def csv_table(spark: SparkSession, path: str, entry: bool = False, split: bool = False) -> DataFrame:
    """A CSV file with a header, every column as text, the usual spellings of "missing" as NULL.

    Quoted line breaks stay in their cell; files of one folder with other columns are an error. With `entry`, the
    place of every row in the files comes along. With `split`, files are read by as many tasks as they have splits
    (`csvsplit`) and not by one task each.
    """
    raw = spark.read.csv(path, header=True, inferSchema=False, enforceSchema=False, multiLine=True, **CSV)
    cells = [null_if_missing(F.col(f"`{c}`")).alias(c) for c in raw.columns]
    if split:
        place = F.col("place")
        raw = csvsplit.table(spark, path, raw.columns, CSV)
    else:
        place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    return raw.select(*cells, place.alias(ENTRY)) if entry else raw.select(*cells)


def _required(df: DataFrame, columns: list[str], path: str) -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"{path} lacks the columns {absent}")
    return df


def national_cases(spark: SparkSession, path: str) -> DataFrame:
    df = _required(csv_table(spark, path), ["date", "national_cumulative_confirmed_cases"], path)
    return df.withColumn("date", date_or_error(F.col("date"))).withColumn(
        "national_cumulative_confirmed_cases", F.col("national_cumulative_confirmed_cases").cast("double")
    )


def national_deaths(spark: SparkSession, path: str) -> DataFrame:
    df = _required(csv_table(spark, path), ["date", "national_cumulative_confirmed_deaths"], path)
    return df.withColumn("date", date_or_error(F.col("date"))).withColumn(
        "national_cumulative_confirmed_deaths", F.col("national_cumulative_confirmed_deaths").cast("double")
    )


def zone_cases(spark: SparkSession, path: str) -> DataFrame:
    return _required(csv_table(spark, path, split=True), ["nom", "date", "cumulative_confirmed_cases"], path)


def zone_deaths(spark: SparkSession, path: str) -> DataFrame:
    return _required(csv_table(spark, path, split=True), ["nom", "date", "cumulative_confirmed_deaths"], path)


def aliases(spark: SparkSession, path: str) -> DataFrame:
    return _required(csv_table(spark, path, entry=True), ["observed_name", "canonical_nom"], path)


def zone_features(spark: SparkSession, path: str) -> DataFrame:
    """One row per GeoJSON feature; the geometry is never parsed."""
    collection = spark.read.schema(ZONES_GEOJSON).json(path, multiLine=True)
    features = collection.select(F.col("_metadata.file_path").alias("path"), F.posexplode("features").alias("pos", "f"))
    return features.select("f.properties", F.struct("path", "pos").alias(ENTRY))


def spread(df: DataFrame) -> DataFrame:
    """Rows spread evenly when a scan yields fewer tasks than there are cores.

    Meant for costly work per row on a few files. A table with at least as many splits as cores
    passes unchanged, so a large scan is never shuffled for it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def bulletins(spark: SparkSession, folder: str, partitioned: bool = False) -> DataFrame:
    """One row per text file: bulletin (file stem) and whole text with plain line ends.

    An empty folder is an error. With `partitioned` the files are those of `writers.write_bulletins`, in folders below it.
    """
    text = F.regexp_replace("value", "\r\n?", "\n").alias("text")
    if partitioned:
        files = _files_by_tasks(spark, folder)
        if files is not None:
            return files.select(_bulletin(F.url_decode(file_stem(F.col("file")))), text)
        files = spark.read.text(folder, wholetext=True)
        if "file" in files.columns:  # each in a folder that carries the name
            return files.select(file_stem(F.col("file")).alias("bulletin"), text)
        # The listing escapes names once more.
        return files.select(_bulletin(F.url_decode(F.url_decode(file_stem(F.col("_metadata.file_name"))))), text)
    files = spark.read.text(f"{folder.rstrip('/')}/*.txt", wholetext=True)
    return files.select(file_stem(F.col("_metadata.file_name")).alias("bulletin"), text)


def _bulletin(name: Column) -> Column:
    """The bulletin of an unescaped file name; two names stand for no name and an empty one."""
    return F.when(name == "\x01", "").when(name != "\x00", name).alias("bulletin")


def _files_by_tasks(spark: SparkSession, folder: str) -> DataFrame | None:
    """(file, value) of the files in the folders `part=...` of a folder, or None if tasks cannot open it or it holds others.

    The driver lists these folders and tasks the files in them: Spark's reader keeps the names of all files in the driver,
    and makes tasks of a few files each.
    """
    top = local_folder(spark, folder)
    if top is None:
        return None
    files, at = FileSystem.from_uri(top)
    if files.get_file_info(at).type != FileType.Directory:
        return None
    parts = sorted(info.base_name for info in files.get_file_info(FileSelector(at)) if info.base_name[0] not in "._")
    if not all(name.startswith("part=") for name in parts):
        return None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, at = FileSystem.from_uri(top)
        names, values, held = [], [], 0
        for batch in batches:
            for part in batch.column(0).to_pylist():
                for info in files.get_file_info(FileSelector(f"{at}/{parts[part]}")):
                    if info.type != FileType.File or info.base_name[0] in "._":
                        continue
                    if held and held + info.size > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.binary())], ["file", "value"])
                        names, values, held = [], [], 0
                    with files.open_input_stream(info.path) as stream:
                        values.append(stream.read())
                    names.append(info.base_name)
                    held += info.size
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.binary())], ["file", "value"])

    tasks = max(1, min(len(parts), max(spark.sparkContext.defaultParallelism, math.ceil(len(parts) / TASK_FOLDERS))))
    found = spark.range(0, len(parts), 1, tasks).mapInArrow(read, "file string, value binary")
    return found.select("file", F.col("value").cast("string").alias("value"))


def extractions(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Stored extraction records; an absent path gives no rows."""
    try:
        return spark.read.schema(EXTRACTION).json(path, multiLine=multi_line)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], EXTRACTION)


def current_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """Star tables of the last version that was written whole, each registered as a view of its name."""
    last = latest_version(spark, folder)
    if last is None:
        raise FileNotFoundError(f"{folder} holds no version")
    return register(spark, f"{folder.rstrip('/')}/versions/{last[1]}", names)


def articles(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with their article text."""
    return pages.withColumn("article", article_text(F.col(html)))


# The bulletins on file, name to page.
BULLETIN_PAGES = {
    "DON602_2026-05-17": "https://www.who.int/emergencies/disease-outbreak-news/item/2026-DON602",
    "DON603_2026-05-21": "https://www.who.int/emergencies/disease-outbreak-news/item/2026-DON603",
    "DON605_2026-05-29": "https://www.who.int/emergencies/disease-outbreak-news/item/2026-DON605",
    "DON606_2026-06-08": "https://www.who.int/emergencies/disease-outbreak-news/item/2026-DON606",
    "DON612_2026-07-03": "https://www.who.int/emergencies/disease-outbreak-news/item/2026-DON612",
    "DON613_2026-07-17": "https://www.who.int/emergencies/disease-outbreak-news/item/2026-DON613",
    "DON614_2026-08-01": "https://www.who.int/emergencies/disease-outbreak-news/item/2026-DON614",
}


def bulletin_manifest(spark: SparkSession, pages: dict[str, str] | None = None) -> DataFrame:
    """Name, page address, number and date of every listed bulletin."""
    return manifest(spark.createDataFrame(list((pages or BULLETIN_PAGES).items()), "name string, url string"))


def manifest(entries: DataFrame) -> DataFrame:
    """Entries (name, url) of any number, with the number and date that the name tells."""
    name = F.col("name")
    return entries.select("name", "url", bulletin_number(name).alias("number"), bulletin_date(name).alias("published"))


def missing_files(files: DataFrame, expected: list[str]) -> DataFrame:
    """Expected file names that a listing of `file_integrity` does not hold."""
    names = files.sparkSession.createDataFrame([(n,) for n in expected], "name string")
    return names.join(files.select(F.element_at(F.split("path", "/"), -1).alias("name")), "name", "left_anti")


def file_integrity(spark: SparkSession, pattern: str, min_bytes: int = 1000) -> DataFrame:
    """Size check of files; only the listing is used, no content is read."""
    files = spark.read.format("binaryFile").load(pattern).select("path", "length")
    return files.withColumn("looks_broken", F.col("length") < min_bytes)
