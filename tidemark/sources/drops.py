"""Reading daily drops: many days at once, with declared schemas and the drop date."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.sources.splitting import split_csv, split_json

DATE_IN_PATH = r"(\d{4}-\d{2}-\d{2})"
DROP_IN_PATH = r"([^/]+/[^/]*\d{4}-\d{2}-\d{2}[^/]*/[^/]+)$"


def path_date(path: Column) -> Column:
    """The drop date named in a file's path."""
    return F.to_date(F.regexp_extract(path, DATE_IN_PATH, 1))


def with_path_date(df: DataFrame, name: str = "business_date") -> DataFrame:
    return df.withColumn(name, path_date(F.col("_metadata.file_path")))


def relative_path(path: Column) -> Column:
    """``<source>/<date folder>/<file>``, free of where the tree is mounted."""
    return F.regexp_extract(path, DROP_IN_PATH, 1)


def date_folders(dates: Sequence[str] | None) -> str:
    return "*" if dates is None else "*{" + ",".join(dates) + "}*"


def csv_options(multi_line: bool) -> dict[str, bool | str]:
    """RFC 4180 quotes; a header that differs from the declared columns is an error, never a
    reading by position, which would leave the wrong column unhidden."""
    return {"header": True, "escape": '"', "enforceSchema": False, "multiLine": multi_line}


def read_csv(spark: SparkSession, path: str | Sequence[str], columns: StructType, multi_line: bool = False) -> DataFrame:
    """Header CSV with RFC 4180 quotes; splittable unless fields may hold line breaks."""
    return spark.read.schema(columns).options(**csv_options(multi_line)).csv(path)


def read_json(spark: SparkSession, path: str | Sequence[str], columns: StructType, multi_line: bool = True) -> DataFrame:
    """JSON arrays of objects, one row per object.

    ``multi_line`` reads a file holding one array. A drop with one array (or object) per
    line is read with it off, and then splits like any text file.
    """
    return spark.read.schema(columns).option("multiLine", multi_line).json(path)


def read_parquet(
    spark: SparkSession, path: str | Sequence[str], columns: StructType | None = None
) -> DataFrame:
    reader = spark.read if columns is None else spark.read.schema(columns)
    return reader.parquet(*[path] if isinstance(path, str) else path)


def read_parquet_by_type(spark: SparkSession, path: str | Sequence[str]) -> list[DataFrame]:
    """Parquet files as one DataFrame per set of column types.

    A writer may store a column as integers one day and as floats the next. Spark's tasks
    compare the footers of all files; as a rule they agree, and nothing but the path given is
    known here. Only where they disagree are their folders, one per drop date, halved and
    compared again, and the files of a folder that disagrees in itself.
    """
    merging = spark.read.option("mergeSchema", True)

    def halves(paths: list[str]) -> tuple[list[str], list[str]]:
        return paths[: len(paths) // 2], paths[len(paths) // 2 :]

    def runs(paths: list[str], inner: Callable[[str], list[str]] | None) -> list[tuple[StructType, list[str]]]:
        try:
            return [(merging.parquet(*paths).schema, paths)]
        except Py4JJavaError as error:
            if "CANNOT_MERGE_SCHEMAS" not in str(error.java_exception):
                raise
            if len(paths) > 1:
                parts = halves(paths)
                return runs(parts[0], inner) + runs(parts[1], inner)
            if inner is None:
                raise
            one, other = halves(inner(paths[0]))
            return runs(one, None) + runs(other, None)

    def found(paths: str | list[str]) -> DataFrame:
        return listing(spark, paths).select("path")

    def files_of(folder: str) -> list[str]:
        return [row.path for row in found(folder).orderBy("path").collect()]

    def folders_of(whole: str) -> list[str]:
        name = whole.rpartition("/")[2]
        folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
        distinct = found(whole).select(F.concat(folder, F.lit(f"/{name}")).alias("path")).distinct()
        return [row.path for row in distinct.orderBy("path").collect()]

    if isinstance(path, str):
        try:
            parts = [(merging.parquet(path).schema, [path])]
        except Py4JJavaError as error:
            if "CANNOT_MERGE_SCHEMAS" not in str(error.java_exception):
                raise
            parts = runs(folders_of(path), files_of)
    else:
        parts = runs(list(path), None) if path else []
    alike: dict[StructType, list[str]] = {}
    for columns, run in parts:
        alike.setdefault(columns, []).extend(run)
    return [spark.read.schema(columns).parquet(*run) for columns, run in alike.items()]


def read_files(
    spark: SparkSession,
    path: str | Sequence[str],
    format: str,
    columns: StructType | None,
    json_lines: bool = False,
    multi_line: bool = True,
) -> list[DataFrame]:
    """The files of one kind; in several parts where they carry differing types themselves, or
    where some are larger than one task should read and records run over lines."""
    if format == "csv" and not multi_line:
        return [read_csv(spark, path, columns)]
    if format == "json" and json_lines:
        return [read_json(spark, path, columns, multi_line=False)]
    if format in ("csv", "json"):
        one_task, many_tasks = by_length(spark, path)
        whole, split = (read_csv, split_csv) if format == "csv" else (read_json, split_json)
        parts = [whole(spark, one_task, columns, multi_line=True)] if one_task else []
        extra = [csv_options(True)] if format == "csv" else []
        return parts + ([split(spark, many_tasks, columns, *extra)] if many_tasks else [])
    return read_parquet_by_type(spark, path) if columns is None else [read_parquet(spark, path, columns)]


def by_length(spark: SparkSession, path: str | Sequence[str]) -> tuple[str | Sequence[str], list[str]]:
    """Files that one task may read, and those longer than a split. As a rule none is, and the
    first are what was given."""
    found = listing(spark, path)
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    large = [row.path for row in found.filter(F.col("length") > split).select("path").collect()]
    if not large:
        return path, []
    others = found.filter(F.col("length") <= split).select("path")
    return [row.path for row in others.collect()], large


def if_present(read, *args, **kwargs) -> DataFrame | None:
    """None when no file matches: a source may well skip a day."""
    try:
        return read(*args, **kwargs)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def listing(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Path, size and time of the files under ``path``; their content is not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def drop_dates(spark: SparkSession, root: str) -> DataFrame:
    """The distinct drop dates of a tree, sorted."""
    dated = listing(spark, root).select(path_date(F.col("path")).alias("business_date"))
    return dated.filter("business_date IS NOT NULL").distinct().orderBy("business_date")


def content_digests(spark: SparkSession, path: str) -> DataFrame:
    """sha256 of each file's bytes. A file is one value here, so keep to files well
    under the 2 GB limit of one; ``identity.fingerprint_groups`` has no such limit."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))
