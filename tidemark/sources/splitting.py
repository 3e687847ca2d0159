"""Large CSV and JSON files whose records run over several lines, read by many tasks.

A file is read as lines, by one task per split. Every line changes a state by itself: its quotes
flip whether a CSV field is open, its brackets move the depth of a JSON array. Sums per split,
added up along the file, tell the state before each split and so, inside its task, before each
line. A line that finds the state between two records begins one, and the task glues the lines
up to the next. Only the pieces of records that run over a split's end move, two per split at
most; no file is ever one value, and no split unless one record covers it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from itertools import pairwise
from operator import or_
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

#: A JSON string, within which brackets do not count; none runs over a line's end.
JSON_STRING = r'"[^"\\]*(?:\\.[^"\\]*)*"'
SPLIT = ["_file", "_start"]
#: What a record is given as, and what a piece of one needs to be glued.
RECORD = "value string, _file long, _first boolean, _before long, _after long"
PIECE = f"{RECORD}, _start long, _begins boolean"
#: Lines of one chunk when a file is digested.
CHUNK_LINES = 1 << 16


def lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines as they lie, with a hash of their file's path, the start and size of their split and
    a number that grows along the split."""
    read = spark.read.option("lineSep", "\n").text(list(paths))
    return read.select(
        "value",
        F.xxhash64("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.col("_metadata.file_block_length").alias("_size"),
        F.monotonically_increasing_id().alias("_at"),
    )


def files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Path, name and length of each file, by the hash that its lines carry; a row per file, so
    that no line carries them."""
    named = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.xxhash64("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_name").alias("_name"),
        F.col("_metadata.file_size").alias("_length"),
    )
    return named.distinct()


def earlier_splits(sums: DataFrame, name: str) -> DataFrame:
    """What the splits of a file before each one add up to."""
    before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    given = [column for column in sums.columns if column != name]
    return sums.select(*given, F.coalesce(F.sum(name).over(before), F.lit(0)).alias(name))


def grouped(
    batches: Iterator[pa.RecordBatch], between: Callable[[Any], Any], pieces: bool
) -> Iterator[pa.RecordBatch]:
    """The records that lie whole in the splits of a task, or the ``pieces`` of the others.

    The lines of a split come in their order, several splits one after another. A piece
    without ``_begins`` ends or goes on with a record of an earlier split.
    """
    names = [field.split()[0] for field in (PIECE if pieces else RECORD).split(", ")]
    split, state, held, begun, first, begins = None, 0, [], 0, False, False

    def rows(values: pa.Array, firsts, before, after) -> pa.RecordBatch:
        n = len(values)
        held_in = [np.full(n, split[0]), firsts, before, after, np.full(n, split[1]), np.full(n, begins)]
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        columns = [values, *(pa.array(given, kind) for given, kind in zip(held_in, kinds, strict=True))]
        return pa.RecordBatch.from_arrays(columns[: len(names)], names)

    def joined(lines: pa.Array, starts: np.ndarray) -> pa.Array:
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), lines), "\n")

    def ended(whole: bool) -> Iterator[pa.RecordBatch]:
        """The lines held, now that their last one is known."""
        if held and whole != pieces:
            lines = pa.concat_arrays(held)
            yield rows(joined(lines, np.array([0, len(lines)])), [first], [begun], [state])

    for batch in batches:
        value, file, start, base, step = (batch.column(i) for i in range(5))
        file, start, base, step = (column.to_numpy() for column in (file, start, base, step))
        turns = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
        edges = [0, *turns.tolist(), batch.num_rows]
        for low, high in pairwise(edges):
            if low == high:
                continue
            if split != (file[low], start[low]):
                yield from ended(begins and bool(between(state)))
                split, state, held, begun = (file[low], start[low]), int(base[low]), [], int(base[low])
                first, begins = bool(start[low] == 0), False
            after = state + np.cumsum(step[low:high], dtype=np.int64)
            before = after - step[low:high]
            begin = np.flatnonzero(between(before))
            lines = value.slice(low, high - low)
            if not len(begin):
                held.append(lines)
                state = int(after[-1])
                continue
            if begin[0]:
                held.append(lines.slice(0, begin[0]))
            state = int(before[begin[0]])
            yield from ended(begins)
            # only the first line of a file's first split begins the file
            first, begins = first and not held, True
            if len(begin) > 1 and not pieces:
                firsts = np.zeros(len(begin) - 1, dtype=bool)
                firsts[0] = first
                yield rows(joined(lines, begin), firsts, before[begin[:-1]], before[begin[1:]])
            first = first and len(begin) == 1
            held, begun, state = [lines.slice(begin[-1])], int(before[begin[-1]]), int(after[-1])
    yield from ended(begins and bool(between(state)))


def records(read: DataFrame, step: Column, between: Callable[[Any], Any]) -> DataFrame:
    """``value, _file, _first, _before, _after``: one row per record of ``lines``.

    ``step`` is what a line adds to the state, ``between`` whether a state, or each of an array
    of states, lies between two records. ``_before`` and ``_after`` are the states around the
    record; ``_first`` marks the file's first line.
    """
    stepped = read.select("value", *SPLIT, "_size", step.cast("long").alias("_step"))
    bases = earlier_splits(stepped.groupBy(*SPLIT, "_size").agg(F.sum("_step").alias("_base")), "_base")
    # one row per split; a broadcast leaves the lines where and in the order in which they are read.
    # The files are read three times, and must be split alike each time.
    stated = stepped.join(F.broadcast(bases), [*SPLIT, "_size"], "left")
    changed = F.raise_error(F.lit("files were split otherwise when read again; run the job again"))
    stated = stated.select("value", *SPLIT, F.coalesce("_base", changed.cast("long")).alias("_base"), "_step")
    whole = stated.mapInArrow(lambda batches: grouped(batches, between, False), RECORD)
    pieces = stated.mapInArrow(lambda batches: grouped(batches, between, True), PIECE)
    along = Window.partitionBy("_file").orderBy("_start", "_begins")
    numbered = pieces.withColumn("_record", F.sum(F.col("_begins").cast("int")).over(along))
    place = F.struct("_start", "_begins")
    glued = numbered.groupBy("_file", "_record").agg(
        F.sort_array(F.collect_list(F.struct("_start", "_begins", "value"))).alias("_lines"),
        F.max("_first").alias("_first"),
        F.min_by("_before", place).alias("_before"),
        F.max_by("_after", place).alias("_after"),
    )
    glued = glued.withColumn("value", F.array_join(F.col("_lines.value"), "\n"))
    return whole.unionByName(glued.select(*whole.columns))


def located(rows: DataFrame, named: DataFrame, columns: StructType, parsed: Column) -> DataFrame:
    """Parsed records with their file where Spark's own readers have it."""
    held = F.struct(F.col("_path").alias("file_path"), F.col("_name").alias("file_name"))
    fields = [F.col(f"_parsed.`{field.name}`").alias(field.name) for field in columns]
    found = rows.select("_file", parsed.alias("_parsed")).join(named, "_file")
    return found.select(*fields, held.alias("_metadata"))


def odd_quotes(value: Column) -> Column:
    """1 if a line opens or closes a quoted field that goes on, else 0; doubled quotes do not."""
    return (F.length(value) - F.length(F.replace(value, F.lit('"')))) % 2


def split_csv(spark: SparkSession, paths: Sequence[str], columns: StructType, options: dict) -> DataFrame:
    """CSV files with a header each, and line breaks inside quotes; ``options`` are the
    reader's. A header that differs from the columns is an error. In a file whose header ends
    with a carriage return, line breaks inside quotes lose theirs, as with Spark's reader."""
    found = records(lines(spark, paths), odd_quotes(F.col("value")), lambda state: state % 2 == 0)
    ends = found.filter("_first").select("_file", F.endswith("value", F.lit("\r")).alias("_returns"))
    found = found.join(ends, "_file")
    line = F.regexp_replace("value", "^﻿|\r$", "")
    line = F.when(F.col("_returns"), F.replace(line, F.lit("\r\n"), F.lit("\n"))).otherwise(line)
    shown = F.split(F.lower(F.replace(line, F.lit('"'))), ",")
    wanted = F.array(*[F.lit(field.name.lower()) for field in columns])
    refused = F.raise_error(F.concat(F.lit("CSV header differs from the declared columns: "), line))
    body = F.when(F.col("_first"), F.when(shown == wanted, F.lit(False)).otherwise(refused.cast("boolean")))
    rows = found.filter(body.otherwise(F.trim(line) != ""))
    given = {name: str(value).lower() if isinstance(value, bool) else value for name, value in options.items()}
    kept = {name: value for name, value in given.items() if name not in ("header", "enforceSchema")}
    return located(rows, files(spark, paths), columns, F.from_csv(line, columns.simpleString(), kept))


def moved_depth(bare: Column) -> Column:
    """How much deeper a line of JSON ends than it begins; its strings are taken out."""

    def count(sign: str) -> Column:
        return F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit(sign)))

    return count("[") + count("{") - count("]") - count("}")


def split_json(spark: SparkSession, paths: Sequence[str], columns: StructType) -> DataFrame:
    """Files holding one array of objects each, printed over many lines (or one array or object
    per line). Objects may share the line on which one ends and the next begins."""
    read, value = lines(spark, paths), F.col("value")

    def has(*signs: str) -> Column:
        return reduce(or_, [F.contains(value, F.lit(sign)) for sign in signs])

    # "}, {" is two lines: the first ends an object, the second begins one
    apart = F.split(F.regexp_replace("value", r"^(\s*\})(\s*,\s*\{)", "$1\n$2"), "\n")
    apart = F.when(has("}") & has("{"), apart).otherwise(F.array("value"))
    read = read.select(F.explode(apart).alias("value"), *SPLIT, "_size")
    # patterns are tried only where they can matter: most lines have no bracket or no string
    bare = F.when(has('"') & has("[", "{", "]", "}"), F.regexp_replace("value", JSON_STRING, ""))
    read = read.withColumn("_bare", bare.otherwise(value))
    found = records(read, moved_depth(F.col("_bare")), lambda state: state <= 1)
    text = F.regexp_replace("value", r"^[\s,﻿]+|[\s,]+$", "")
    text = F.when(F.col("_before") == 0, F.regexp_replace(text, r"^\[", "")).otherwise(text)
    text = F.when(F.col("_after") == 0, F.regexp_replace(text, r"\]$", "")).otherwise(text)
    objects = F.from_json(F.concat(F.lit("["), text, F.lit("]")), ArrayType(columns))
    held = found.withColumn("_object", F.explode(objects))
    return located(held, files(spark, paths), columns, F.col("_object"))


def one_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Printed objects of a task, one text each, as the texts of one array."""
    opening, last = "[ ", pa.array([], pa.string())
    for batch in batches:
        held = pa.concat_arrays([last, batch.column(0)])
        if len(held) > 1:
            heads = pa.array([opening] + [""] * (len(held) - 2))
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(heads, held[:-1], ",", "")], ["value"])
            opening = ""
        last = held[-1:]
    yield pa.RecordBatch.from_arrays([pa.array([f"{opening}{''.join(last.to_pylist())} ]"])], ["value"])


def file_digests(spark: SparkSession, paths: Sequence[str], chunk: int = CHUNK_LINES) -> DataFrame:
    """``path, length, sha256`` of line-based files of any size.

    The digests of ``chunk`` lines at a time make a chunk's digest, and the file's length and
    its chunks' digests in order make the file's: whatever the splits, and no value longer than
    the digests of a chunk or of all chunks. A file's order counts; ``identity.fingerprint_groups``
    is blind to it.
    """
    read = lines(spark, paths).select(*SPLIT, "_at", F.unhex(F.sha2("value", 256)).alias("_digest"))
    along = Window.partitionBy(*SPLIT).orderBy("_at")
    run = read.withColumn("_inside", F.row_number().over(along))
    counts = earlier_splits(run.groupBy(*SPLIT).agg(F.max("_inside").alias("_earlier")), "_earlier")
    number = F.col("_earlier") + F.col("_inside") - 1
    numbered = run.join(counts, SPLIT).select("_file", "_digest", number.alias("_number"))

    def folded(order: str) -> Column:
        held = F.sort_array(F.collect_list(F.struct(order, "_digest")))
        return F.array_join(F.transform(held["_digest"], lambda one: F.lower(F.hex(one))), "")

    chunked = numbered.withColumn("_chunk", F.floor(F.col("_number") / chunk))
    chunks = chunked.groupBy("_file", "_chunk").agg(F.unhex(F.sha2(folded("_number"), 256)).alias("_digest"))
    whole = chunks.groupBy("_file").agg(folded("_chunk").alias("_all")).join(files(spark, paths), "_file")
    return whole.select(
        F.col("_path").alias("path"),
        F.col("_length").alias("length"),
        F.sha2(F.concat_ws(":", "_length", "_all"), 256).alias("sha256"),
    )
