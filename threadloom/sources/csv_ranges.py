"""Quoted CSV with line breaks inside fields, read by as many tasks as the files have ranges.

A plain multi-line scan gives each file to one task, since a line break may be part of a field. Here the files are read
as lines, which Spark splits by bytes, and two passes find the records: the first leaves the parity of the quotes of each
range, and the running parity per file says which ranges begin inside a field; the second puts lines together to
records within each range. The few records that reach over a range's end are put together from their parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from threadloom.session import BROADCAST_MAX_ROWS, materialize

#: What a row of the second pass is: a record, or the last, first or middle part of one.
WHOLE, LAST, FIRST, MIDDLE = 0, 1, 2, 3

_RANGE = ["file", "range_start"]
_PARTS = "file string, range_start long, part int, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range_start"), "value")


def range_parities(lines: DataFrame) -> DataFrame:
    """file, range_start, opens_inside: whether a range begins inside a quoted field. One row per range, stored.

    A file whose quotes do not pair up raises an error.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = materialize(lines.groupBy(*_RANGE).agg(F.sum(quotes).alias("quotes")), "csv-quotes")
    odd = counted.groupBy("file").agg(F.sum("quotes").alias("quotes")).where("quotes % 2 = 1").select("file").first()
    if odd is not None:
        raise ValueError(f"quotes do not pair up in {odd.file}")
    before = Window.partitionBy("file").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(counted.select(*_RANGE, (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("opens_inside")), "csv-ranges")


def _joined(lines: pa.Array, ends: np.ndarray) -> list[str]:
    """The records that end with the lines at ``ends``."""
    offsets = np.concatenate([[0], ends + 1]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), lines.slice(0, int(offsets[-1]))), "\n").to_pylist()


class _Range:
    """Lines of one range, put together as they come; holds no more than one open record."""

    def __init__(self, file: str, start: int, inside: bool):
        self.file, self.start, self.inside = file, start, inside
        self.open: list[str] = []
        self.last_part, self.header = inside, start == 0

    def add(self, lines: pa.Array) -> Iterator[tuple[int, str]]:
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
        after = (int(self.inside) + np.cumsum(quotes)) & 1
        self.inside = bool(after[-1])
        ends = np.flatnonzero(after == 0)
        if not len(ends):
            self.open += lines.to_pylist()
            return
        records = _joined(lines, ends)
        records[0] = "\n".join([*self.open, records[0]])
        self.open = lines.slice(int(ends[-1]) + 1).to_pylist()
        for record in records:
            if self.header:
                self.header = False
                continue
            yield (LAST if self.last_part else WHOLE), record
            self.last_part = False

    def close(self) -> Iterator[tuple[int, str]]:
        if self.open:
            yield (MIDDLE if self.last_part else FIRST), "\n".join(self.open)


def _stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(found: Iterator[tuple[int, str]], here: _Range) -> pa.RecordBatch:
        part, text = zip(*found, strict=True) if (found := list(found)) else ((), ())
        n = len(part)
        return pa.RecordBatch.from_arrays([
            pa.array([here.file] * n, pa.string()), pa.array([here.start] * n, pa.int64()),
            pa.array(part, pa.int32()), pa.array(text, pa.string())], names=["file", "range_start", "part", "text"])

    here: _Range | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = pc.dictionary_encode(batch.column("file")), batch.column("range_start").to_numpy()
        code = file.indices.to_numpy()
        cuts = np.flatnonzero((code[1:] != code[:-1]) | (start[1:] != start[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            name, at = file[int(a)].as_py(), int(start[a])
            if here is None or (here.file, here.start) != (name, at):
                if here is not None:
                    yield rows(here.close(), here)
                inside = batch.column("opens_inside")[int(a)].as_py()
                if inside is None:
                    raise ValueError(f"{name} was cut into other ranges than before; set spark.sql.files.minPartitionNum")
                here = _Range(name, at, inside)
            yield rows(here.add(batch.column("value").slice(int(a), int(b - a))), here)
    if here is not None:
        yield rows(here.close(), here)


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of quoted CSV files with a header each, as one ``text`` column without the line's end; empty lines are left out.

    Quotes inside fields are doubled and stand in quoted fields only (RFC 4180). Each range is a task; a range's lines keep
    their order, as it is joined with the table of ranges by broadcast; beyond a million ranges (some 120 TB) by a sorted shuffle.
    """
    lines = _lines(spark, path)
    ranges = range_parities(lines)
    if ranges.count() <= BROADCAST_MAX_ROWS:
        placed = lines.join(F.broadcast(ranges), _RANGE, "left")
    else:
        numbered = lines.withColumn("line", F.monotonically_increasing_id())
        placed = numbered.join(ranges, _RANGE, "left").repartition(*_RANGE).sortWithinPartitions(*_RANGE, "line")
    parts = placed.select(*_RANGE, "value", "opens_inside").mapInArrow(_stitch, _PARTS)
    # at most two parts a range are not whole records
    cut = materialize(parts.where(F.col("part") != WHOLE), "csv-cut")
    order = Window.partitionBy("file").orderBy("range_start", (F.col("part") == FIRST).cast("int"))
    numbered = cut.withColumn("record", F.sum((F.col("part") == FIRST).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = F.array_sort(F.collect_list(F.struct("range_start", "text")))
    mended = numbered.groupBy("file", "record").agg(pieces.alias("pieces")).select(F.array_join("pieces.text", "\n").alias("text"))
    whole = parts.where(F.col("part") == WHOLE).select("text").unionByName(mended)
    return whole.select(F.regexp_replace("text", "\r\\z", "").alias("text")).where("text <> ''")


def read_csv_ranges(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Quoted, multi-line CSV with a header, equal to the plain multi-line scan; see ``records``."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    return records(spark, path).select(F.from_csv("text", ddl, options).alias("row")).select("row.*")
