"""Records of large text files (S1, S2, S4): line numbers and quoted line breaks
without reading a file in one task.

Spark splits a text file into blocks and each line is read with the block it
begins in.  Two sums over blocks, one small row each, are enough to look at
every block on its own:

* the lines in the blocks before it give a line its number in the file;
* the parity of the quotes in the blocks before it tells whether a block begins
  inside a quoted field, so that a line break in it is data.  Composing the
  parities of the blocks is the prefix sum of a two-state machine; a doubled
  quote leaves the state as it was, as the format wants.

Only files that have a line with an odd number of quotes can hold a record of
several lines.  All lines of other files are records as they are; of those
files, the lines between two odd ones are joined in the task that reads them,
a batch of lines at a time.  Only the pieces of records that reach over the edge
of a batch or a block are shuffled, at most two for each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gamestats.sources.scratch import written

if TYPE_CHECKING:
    import pyarrow as pa

QUOTE = '"'


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, id, line)`` of every line: lines end at a line feed (a
    carriage return before it stays in the text), ids rise within a block."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(QUOTE), F.lit("")))


def _odd(line: Column) -> Column:
    return F.pmod(_quotes(line), F.lit(2))


def _blocks(lines: DataFrame) -> DataFrame:
    """Per block: its first id, lines and quotes in the file before it, and
    whether the file has a line with an odd number of quotes (``broken``)."""
    sums = lines.groupBy("file", "block").agg(
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"),
        F.sum(_quotes(F.col("line"))).alias("quotes"), F.max(_odd(F.col("line"))).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("file", "block", "first_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lines_before"),
                       F.coalesce(F.sum("quotes").over(before), F.lit(0)).alias("quotes_before"),
                       (F.max("odd").over(Window.partitionBy("file")) == 1).alias("broken"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, number, line)``: 1-based line numbers in each file.  The text
    isn't shuffled unless its blocks are too many to broadcast."""
    lines = text_lines(spark, path)
    return lines.join(_blocks(lines), ["file", "block"]).select(
        "file", (F.col("lines_before") + F.col("id") - F.col("first_id") + 1).alias("number"), "line")


UNITS = "place long, number long, open int, open_after int, record string"


def _joined_lines(crossing: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For tasks that read whole blocks: the records that lie within a batch of
    lines or, with ``crossing``, the pieces that the others have in it.  A piece
    begins inside quotes (``open``), ends inside them (``open_after``) or both."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        place_before, state = None, 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            place, number, start, odd = (batch.column(c).to_numpy() for c in ("place", "number", "start", "odd"))
            first = np.concatenate(([place[0] != place_before], place[1:] != place[:-1]))
            heads = np.flatnonzero(first)
            quotes = np.cumsum(odd) - odd
            shifts = np.concatenate(([state], start[heads] - quotes[heads]))
            opened = (quotes + shifts[np.cumsum(first)]) & 1
            after = opened ^ odd
            place_before, state = place[-1], int(after[-1])
            begins = first | (opened == 0)
            begins[0] = True
            at = np.flatnonzero(begins)
            edges = np.append(at, n)
            opened, after = opened[at], after[edges[1:] - 1]
            keep = ((opened | after) == 1) == crossing
            if not keep.any():
                continue
            held = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), batch.column("line"))
            records = pc.binary_join(held.filter(pa.array(keep)), "\n")
            at = at[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(place[at]), pa.array(number[at]), pa.array(opened[keep].astype("int32")),
                 pa.array(after[keep].astype("int32")), records],
                names=["place", "number", "open", "open_after", "record"])

    return run


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, number, record)``: the records of quoted text, each with the
    number of the line that it begins in.  A line feed inside quotes is part of
    the record, a carriage return before the line feed that ends one is not.
    Quotes that are never closed make the rest of the file one record."""
    lines = text_lines(spark, path)
    blocks = written(_blocks(lines).withColumn("place", F.monotonically_increasing_id()), "blocks")
    # one row per block; a broadcast leaves the lines in the order of the files
    placed = lines.join(F.broadcast(blocks), ["file", "block"]).withColumn(
        "number", F.col("lines_before") + F.col("id") - F.col("first_id") + 1)
    plain = placed.where("NOT broken").select("file", "number", F.col("line").alias("record"))

    states = placed.where("broken").select(
        "place", "number", F.pmod("quotes_before", F.lit(2)).cast("int").alias("start"),
        _odd(F.col("line")).cast("int").alias("odd"), "line")
    places = F.broadcast(blocks.select("place", "file", "block"))
    whole = states.mapInArrow(_joined_lines(False), UNITS).join(places, "place").select("file", "number", "record")
    # a piece that only leaves a quote open begins a record; the pieces up to the
    # one that closes it carry its number: the last such number, within the block
    # or from the blocks before it
    pieces = states.mapInArrow(_joined_lines(True), UNITS).join(places, "place")
    part = written(pieces.select("file", "block", "number", "record",
                                 F.when(F.col("open") == 0, F.col("number")).alias("start")), "record-pieces")
    by_block = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = part.groupBy("file", "block").agg(F.max("start").alias("last_start")).select(
        "file", "block", F.max("last_start").over(by_block).alias("carried"))
    so_far = Window.partitionBy("file", "block").orderBy("number")
    joined = (part.join(carried, ["file", "block"])
              .withColumn("begin", F.coalesce(F.max("start").over(so_far), F.col("carried")))
              .groupBy("file", "begin").agg(F.array_sort(F.collect_list(F.struct("number", "record"))).alias("held"))
              .select("file", F.col("begin").alias("number"),
                      F.array_join(F.transform("held", lambda x: x["record"]), "\n").alias("record")))
    records = plain.union(whole).union(joined)
    return records.withColumn("record", F.regexp_replace("record", "\r$", ""))


def parsed(records: DataFrame, schema: StructType, corrupt: str = "_corrupt") -> DataFrame:
    """Fields of quoted comma-separated records, with ``corrupt`` holding the
    text of a record that has too few or too many fields or one that doesn't
    parse (its other fields are kept)."""
    full = StructType([*schema.fields, StructField(corrupt, StringType())])
    options = {"quote": QUOTE, "escape": QUOTE, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt,
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
               "maxCharsPerColumn": "-1"}
    out = records.withColumn("_fields", F.from_csv("record", full.simpleString().removeprefix("struct<")
                                                   .removesuffix(">").replace(":", " "), options))
    return out.select("file", "number", *[F.col("_fields")[c].alias(c) for c in full.fieldNames()])
