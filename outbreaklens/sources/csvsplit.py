"""Records of CSV files with quoted line breaks, read split by split.

Whether a line break ends a record depends on all quotes in front of it, which is why a reader of such files usually
takes a whole file as one task. Here the first pass tells for every split of a file how it leaves the quoting, for both ways
in which it may be entered; these small functions, put together in the order of the splits, tell how every split is
really entered. The second pass cuts records. A record that goes over a border of splits leaves one piece in each and is
put together afterwards; only such pieces are shuffled.

A quote opens a cell only at its beginning, and two quotes inside are one, as in the reader of whole files; a quote
inside a bare cell is a plain character. Lines end with a line feed, with or without a carriage return. A file that ends
inside a quoted cell ends its last record there. Empty lines are no records.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORD, HEAD, TAIL = 0, 1, 2
STATES = "file string, block long, from_outside boolean, from_inside boolean"
PIECES = "file string, block long, number long, kind int, text string"


def leaves_open(line: str, inside: bool, delimiter: str = ",") -> bool:
    """Whether a line ends inside a quoted cell, entered inside one or at the beginning of a record."""
    at = 0
    while True:
        if not inside and line[at : at + 1] == '"':
            inside, at = True, at + 1
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line[at + 1 : at + 2] == '"':
                at += 2
                continue
            inside = False
        at = line.find(delimiter, at)
        if at < 0:
            return False
        at += 1


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """Runs of lines of one split, in their order; a split may go on over many batches."""

    def rows() -> Iterator[tuple[tuple[str, int], str]]:
        for batch in batches:
            yield from zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), batch.column(2).to_pylist())

    for split, group in groupby(rows(), key=lambda row: row[0]):
        yield split, (line for _, line in group)


def entered_inside(spark: SparkSession, path: str) -> set[tuple[str, int]]:
    """Splits that begin inside a quoted cell: (file, start). There are as many as quoted line breaks at borders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block), lines in _splits(batches):
            ends = [False, True]
            for line in lines:
                if '"' in line:
                    ends = [leaves_open(line.removesuffix("\r"), state) for state in ends]
            yield pa.RecordBatch.from_arrays(
                [pa.array([value]) for value in (file, block, *ends)], ["file", "block", "from_outside", "from_inside"]
            )

    states = _lines(spark, path).mapInArrow(run, STATES)
    # Ends that do not depend on the entrance fix the state; between them only changes count.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fixed = F.col("from_outside") == F.col("from_inside")
    turned = states.withColumn("turns", F.sum((~fixed & F.col("from_outside")).cast("int")).over(upto))
    known = F.when(fixed, F.col("from_outside").cast("int") + F.col("turns"))
    entered = turned.withColumn(
        "entered", (F.coalesce(F.last(known, ignorenulls=True).over(before), F.lit(0)) + F.coalesce(F.lag("turns").over(Window.partitionBy("file").orderBy("block")), F.lit(0))) % 2
    )
    return {(row["file"], row["block"]) for row in entered.where("entered = 1").select("file", "block").collect()}


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, number, text) of every record; file, block and number order the records of the files."""
    inside = entered_inside(spark, path)
    followed: dict[str, list[int]] = {}
    for file, block in inside:
        followed.setdefault(file, []).append(block)

    def goes_on(file: str, block: int) -> bool:
        return any(later > block for later in followed.get(file, ()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block), lines in _splits(batches):
            kind = HEAD if (file, block) in inside else RECORD
            found, held, is_open, number = [], [], kind == HEAD, 0
            for line in lines:
                line = line.removesuffix("\r")
                if block == 0 and not number and not held:
                    line = line.removeprefix("\ufeff")
                held.append(line)
                is_open = leaves_open(line, is_open) if '"' in line else is_open
                if is_open:
                    continue
                if kind == HEAD or held != [""]:
                    found.append((file, block, number, kind, "\n".join(held)))
                    number += 1
                kind, held = RECORD, []
                if len(found) == 10_000:
                    yield _pieces(found)
                    found = []
            if held:
                last = kind if kind == HEAD else TAIL if goes_on(file, block) else RECORD
                found.append((file, block, number, last, "\n".join(held)))
            yield _pieces(found)

    pieces = _lines(spark, path).mapInArrow(run, PIECES)
    whole = pieces.where(F.col("kind") == RECORD).drop("kind")
    if not inside:
        return whole
    in_file = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = pieces.where(F.col("kind") != RECORD).withColumn("of", F.sum((F.col("kind") == TAIL).cast("int")).over(in_file))
    joined = parts.groupBy("file", "of").agg(
        F.min("block").alias("block"),
        F.min_by("number", F.struct("block", "kind")).alias("number"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "kind", "text"))), lambda p: p["text"]), "\n").alias("text"),
    )
    return whole.unionByName(joined.drop("of"))


def _pieces(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [()] * 5
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "block", "number", "kind", "text"])


def table(spark: SparkSession, path: str, columns: list[str], options: dict[str, str]) -> DataFrame:
    """The cells of the records as text, with `place` (file, block, number); the first record of every file is its header.

    A file whose header differs from `columns` stops the job.
    """
    schema = ", ".join("`" + name.replace("`", "``") + "` string" for name in columns)
    header = (F.col("block") == 0) & (F.col("number") == 0)
    cells = F.from_csv("text", schema, options)
    told = F.array(*[F.coalesce(F.col("cells").getField(name), F.lit("")) for name in columns])
    same = F.array_join(F.transform(told, F.lower), "\n") == F.lit("\n".join(columns).lower())
    bad = F.raise_error(F.concat(F.lit("another header than expected in "), F.col("file"))).cast("boolean")
    parsed = records(spark, path).withColumn("cells", cells).withColumn("header", header)
    rows = parsed.where(F.when(~F.col("header"), True).when(same, False).otherwise(bad))
    return rows.select(*[F.col("cells").getField(name).alias(name) for name in columns], F.struct("file", "block", "number").alias("place"))
