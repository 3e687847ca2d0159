"""Incremental ingest: drops to a pseudonymised lake, guarded by a ledger of fingerprints.

A drop file is listed first; one that has the length and time it had when last seen is not
opened. The others are parsed once, into a version of the lake that no reader sees yet. They are
fingerprinted as they lie there, and those with content that the ledger does not know become
part of the lake by one manifest; the rest is swept. No row is moved or written twice.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.identity import fingerprint_groups, pseudonym, require_salt, year_prefix
from tidemark.plans.model import DROP_FILES, IDENTIFIERS, LANDED, LEDGER, LONG, SEEN, STRING, DropFile, schema
from tidemark.session import inline, side_by_side
from tidemark.sources import drops, snapshots, tables

PATH, DATE, FILE = "_path", "business_date", "file"


def pseudonymise(
    df: DataFrame,
    salt: str,
    identifier: str = "patient_id",
    identifiers: Sequence[str] = IDENTIFIERS,
    birth: str = "birth_date",
) -> DataFrame:
    """Hide identities: direct identifiers go, the id becomes a pseudonym, the birth date
    a year. Columns a source does not have are left alone, column order is kept."""
    shown = {
        identifier: lambda: pseudonym(F.col(identifier), salt).alias("patient_hash"),
        birth: lambda: year_prefix(F.col(birth)).alias("birth_year"),
    }
    return df.select(
        *[shown[name]() if name in shown else F.col(name) for name in df.columns if name not in identifiers]
    )


@dataclass(frozen=True)
class Lake:
    """Where the lake, its ledger and the batches in progress live.

    ``per_date`` keys the ledger on (fingerprint, source, date) instead of the fingerprint
    alone: an identical snapshot dropped on a later date is then kept.
    """

    root: str
    salt: str = field(repr=False)
    per_date: bool = False

    @property
    def ledger_path(self) -> str:
        return f"{self.root}/meta/ingested_files"

    @property
    def seen_path(self) -> str:
        return f"{self.root}/meta/seen_files"

    def path(self, file: DropFile) -> str:
        return f"{self.root}/lake/{file.source}/{file.name}"

    def ledger(self, spark: SparkSession) -> DataFrame:
        """Recorded files. A batch repeated after a crash may have been recorded twice."""
        recorded = tables.read_or_empty(spark, self.ledger_path, LEDGER)
        return recorded.groupBy("path", "sha256", "source", "business_date").agg(
            F.max("rows").alias("rows"), F.min("ingested_at").alias("ingested_at")
        )


def prepare(rows: DataFrame, file: DropFile, salt: str) -> DataFrame:
    """Hidden identities plus each row's drop date and file; nothing is written before this."""
    own = (
        [F.col(name) for name in rows.columns if name != "_metadata"]
        if file.stored is None
        else [F.col(field.name).try_cast(field.dataType).alias(field.name) for field in file.stored]
    )
    located = rows.select(
        *own,
        drops.path_date(F.col("_metadata.file_path")).alias(DATE),
        F.col("_metadata.file_name").alias(FILE),
    )
    return pseudonymise(located, salt) if file.identifying else located


def new_files(staged: DataFrame, file: DropFile, lake: Lake) -> DataFrame:
    """Fingerprint every staged file and keep those the ledger does not know.

    Of files with equal content in one batch, the earliest counts and the others are
    skipped, as if the dates had come one after the other.
    """
    spark = staged.sparkSession
    columns = [name for name in staged.columns if name not in (DATE, FILE)]
    seen = [*(["source", DATE] if lake.per_date else []), "sha256"]
    one = F.struct(F.col(DATE).cast("date").alias(DATE), F.col(FILE).cast("string").alias(FILE))
    prints = fingerprint_groups(staged.withColumn("_file", one), "_file", columns).select(
        F.lit(file.source).alias("source"), "_file.*", "sha256", "rows"
    )
    unknown = prints.join(lake.ledger(spark).select(*seen).distinct(), seen, "left_anti")
    if lake.per_date:
        return unknown.select("source", DATE, FILE, "sha256", "rows")
    return (
        unknown.groupBy("source", "sha256")
        .agg(F.min(F.struct(DATE, FILE, "rows")).alias("_first"))
        .select("source", f"_first.{DATE}", f"_first.{FILE}", "sha256", "_first.rows")
    )


def land(prepared: DataFrame, file: DropFile, lake: Lake) -> list[tuple]:
    """Bring the new files of a batch into the lake; returns them, for ``record``.

    Each file is a slice of its date: changed content replaces it, and so does a batch
    repeated after a crash. One row per new file reaches the driver, as it must for the
    manifest to name it.
    """
    spark = prepared.sparkSession
    write = snapshots.Write(spark, lake.path(file), (DATE, FILE), depth=2)
    write.stage(prepared)
    if not write.found():
        write.abandon()
        return []
    chosen = [tuple(row) for row in new_files(write.staged(), file, lake).collect()]
    if not chosen:
        write.abandon()
        return []
    new = [snapshots.slice_name(spark, (DATE, FILE), row[1:3]) for row in chosen]
    write.commit(gone=(), only=new)
    return chosen


def record(landed: Sequence[tuple], paths: DataFrame | None, spark: SparkSession, lake: Lake) -> None:
    """Add landed files to the ledger, only once their rows are in the lake.

    ``paths`` lists the drop files of the batch; a landed file takes its path from there, or
    else, as from a stream, is known by source, date and name.
    """
    rows = inline(spark, landed, LANDED)
    own = F.concat_ws("/", "source", F.col(DATE).cast("string"), FILE)
    if paths is not None:
        named = paths.groupBy("source", DATE, FILE).agg(F.min("path").alias("path"))
        same = [rows[name].eqNullSafe(named[name]) for name in ("source", DATE, FILE)]
        rows = rows.join(named, reduce(Column.__and__, same), "left").select(*[rows[name] for name in rows.columns], "path")
        own = F.coalesce("path", own)
    recorded = rows.select(
        own.alias("path"),
        "sha256",
        "source",
        DATE,
        "rows",
        F.date_trunc("second", F.current_timestamp()).alias("ingested_at"),
    )
    tables.append(recorded.coalesce(1), lake.ledger_path)


def together(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def glob(root: str, file: DropFile, dates: Sequence[str] | None) -> str:
    return f"{root}/{file.source}/{drops.date_folders(dates)}/{file.pattern}"


def read_drop(
    spark: SparkSession,
    paths: str | Sequence[str],
    file: DropFile,
    json_lines: bool = False,
) -> list[DataFrame]:
    """The drops of one kind of file; none, one part, or one for each set of stored types."""
    found = drops.if_present(
        drops.read_files, spark, paths, file.format, file.schema, json_lines, file.multi_line
    )
    return found or []


def listed(spark: SparkSession, path: str, file: DropFile) -> DataFrame | None:
    """The drop files of one kind: where they are, their length and time; none is opened."""
    found = drops.if_present(drops.listing, spark, path)
    if found is None:
        return None
    return found.select(
        F.lit(file.source).alias("source"),
        F.lit(file.name).alias("name"),
        drops.relative_path(F.col("path")).alias("path"),
        drops.path_date(F.col("path")).alias(DATE),
        F.element_at(F.split("path", "/"), -1).alias(FILE),
        "length",
        F.col("modificationTime").alias("modified"),
        F.col("path").alias("location"),
    )


def unseen(found: DataFrame, lake: Lake) -> tuple[bool, DataFrame]:
    """Whether some of the files were seen before, and those that are new or changed.

    A file counts as seen by this salt only: another one hides identities anew.
    """
    keys = ["source", "name", "path", "length", "modified"]
    seen = tables.read_or_empty(found.sparkSession, lake.seen_path, SEEN)
    seen = seen.filter(F.col("salted") == pseudonym(F.lit("seen"), lake.salt)).select(*keys)
    known = not found.join(seen, keys, "left_semi").isEmpty()
    return known, found.join(seen, keys, "left_anti") if known else found


def ingest(
    spark: SparkSession,
    root: str,
    lake: Lake,
    dates: Sequence[str] | None = None,
    files: Sequence[DropFile] = DROP_FILES,
    json_lines: bool = False,
) -> DataFrame:
    """Bring the drops of the given dates (all when None) into the lake.

    Returns ``(source, n_files)`` for the sources with new files. Files are listed before they
    are read and remembered as they were listed, so one that changes meanwhile is read again.
    """
    require_salt(lake.salt)

    def bring(file: DropFile) -> tuple[list[tuple], DataFrame | None]:
        found = listed(spark, glob(root, file, dates), file)
        if found is None:
            return [], None
        found = tables.rebuild(found, f"{lake.root}/meta/listed/{file.source}-{file.name}")
        known, new = unseen(found, lake)
        paths: str | list[str] = glob(root, file, dates)
        if known:  # as a rule a day's files; a first load is read by its pattern
            paths = [row.location for row in new.select("location").collect()]
        if not paths:
            return [], None
        rows = [prepare(part, file, lake.salt) for part in read_drop(spark, paths, file, json_lines)]
        return land(together(rows), file, lake) if rows else [], new

    brought = side_by_side([partial(bring, file) for file in files])
    opened = [found for _, found in brought if found is not None]
    landed = [row for rows, _ in brought for row in rows]
    if landed:
        record(landed, together(opened), spark, lake)
    if opened:
        salted = pseudonym(F.lit("seen"), lake.salt).alias("salted")
        tables.append(together(opened).select("source", "name", "path", "length", "modified", salted).coalesce(1), lake.seen_path)
    counted = Counter(row[0] for row in landed)
    return inline(spark, sorted(counted.items()), schema(source=STRING, n_files=LONG))
