"""Files whose records run over lines: read by many tasks, with the rows of Spark's own readers."""

from __future__ import annotations

import json
import random
import uuid

import hospital
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.plans.model import DIAGNOSTICS, DROP_FILES, text_schema
from tidemark.sources import drops, splitting, tables
from tidemark.sources.ingest import Lake, ingest

COLUMNS = text_schema("a", "b", "c")
FILES = {file.name: file for file in DROP_FILES}


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def rows(df):
    return sorted(map(repr, df.collect()))


def csv_text(rng, count, end):
    def cell():
        text = "".join(rng.choices(["x", "y", '"', ",", "\n", "\r\n", " ", "é", ""], k=rng.randint(0, 6)))
        if any(c in text for c in '",\n\r') or rng.random() < 0.1:
            return '"' + text.replace('"', '""') + '"'
        return text

    return "a,b,c" + end + "".join(",".join(cell() for _ in range(3)) + end for _ in range(count))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_with_line_breaks_in_quotes(spark, tmp_path, small_splits, end):
    rng = random.Random(7)
    for n, count in enumerate((0, 1, 400, 300)):
        (tmp_path / f"f{n}.csv").write_bytes(csv_text(rng, count, end).encode())
    (tmp_path / "g.csv").write_bytes(b'a,b,c\n1,"' + b"line\n" * 900 + b'",3\n4,5,6')  # one record over many splits
    paths = [str(tmp_path / "*.csv")]
    assert splitting.lines(spark, paths).rdd.getNumPartitions() > 8
    split = splitting.split_csv(spark, paths, COLUMNS, drops.csv_options(True))
    names = {row.file_name for row in split.select("_metadata.file_name").distinct().collect()}
    assert names == {"f1.csv", "f2.csv", "f3.csv", "g.csv"}
    assert rows(split.drop("_metadata")) == rows(drops.read_csv(spark, paths, COLUMNS, True))


def test_csv_with_another_header(spark, tmp_path):
    (tmp_path / "f.csv").write_text("b,a,c\n1,2,3\n")
    with pytest.raises(PySparkException, match="header"):
        splitting.split_csv(spark, [str(tmp_path / "f.csv")], COLUMNS, drops.csv_options(True)).collect()


def objects(count):
    rng = random.Random(count)
    codes = ["a}", "[{", 'q"q', "\\", "é\n", None, "}, {"]
    return [{"stay_id": f"s{n}", "diagnostics": [{"code_cim10": rng.choice(codes), "type": "p"} for _ in range(rng.randint(0, 3))]} for n in range(count)]


@pytest.mark.parametrize("count", [0, 1, 150])
@pytest.mark.parametrize("style", ["indented", "lines", "jackson", "one line"])
def test_json_arrays_over_many_lines(spark, tmp_path, small_splits, style, count):
    made = objects(count)
    printed = {
        "indented": json.dumps(made, indent=2, ensure_ascii=False),
        "lines": "[\n" + ",\n".join(json.dumps(each) for each in made) + "\n]\n",
        "jackson": "[ " + ", ".join(json.dumps(each, indent=2) for each in made) + " ]",
        "one line": json.dumps(made),
    }[style]
    path = tmp_path / "d.json"
    path.write_text(printed)
    split = splitting.split_json(spark, [str(path)], DIAGNOSTICS)
    assert rows(split.drop("_metadata")) == rows(drops.read_json(spark, str(path), DIAGNOSTICS))
    if count == 150 and style != "one line":
        assert splitting.lines(spark, [str(path)]).rdd.getNumPartitions() > 8


def test_large_drops_land_alike(spark, tmp_path, small_splits):
    """The lake is the same whether files are one task each or many."""
    hospital.write_day(tmp_path / "drops", 0)
    files = [FILES[name] for name in ("sejours", "patients", "diagnostics")]
    landed = []
    for split, name in (("900", "split"), ("64m", "whole")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        lake = Lake(str(tmp_path / name), hospital.SALT)
        ingest(spark, str(tmp_path / "drops"), lake, files=files)
        prints = lake.ledger(spark).select("path", "sha256", "rows")
        landed.append([rows(tables.read(spark, lake.path(file))) for file in files] + [rows(prints)])
    assert landed[0] == landed[1] and all(landed[0])


@pytest.mark.parametrize("count", [0, 1, 2, 25_001])
def test_a_task_prints_one_array(spark, count):
    made = [{"stay_id": f"s{n}", "diagnostics": []} for n in range(count)]
    texts = pa.array([json.dumps(each, indent=2) for each in made], pa.string())
    batches = pa.Table.from_arrays([texts], ["value"]).to_batches(max_chunksize=1000)
    printed = [text for batch in splitting.one_array(iter(batches)) for text in batch.column(0).to_pylist()]
    assert json.loads(" ".join(printed)) == made and len(printed) == max(count, 1)


def test_only_pieces_of_records_cut_by_a_split_move(spark, tmp_path, small_splits):
    """Lines are neither dealt out nor sorted; of each split, at most two pieces are."""
    made = objects(400)
    (tmp_path / "d.json").write_text(json.dumps(made, indent=2))
    read = splitting.lines(spark, [str(tmp_path / "d.json")])
    moved = splitting.moved_depth(F.regexp_replace("value", splitting.JSON_STRING, ""))
    found = splitting.records(read, moved, lambda state: state <= 1)
    assert found.count() == len(made) + 2
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_at#" not in plan.replace("AS _at#", "") and "row_number" not in plan
    splits = read.select(*splitting.SPLIT).distinct().count()
    stated = read.select("value", *splitting.SPLIT, F.lit(2).cast("long").alias("_base"), moved.cast("long").alias("_step"))
    stated = stated.withColumn("_base", F.when(F.col("_start") == 0, 0).otherwise(F.col("_base")))
    pieces = stated.mapInArrow(lambda given: splitting.grouped(given, lambda state: state <= 1, True), splitting.PIECE)
    assert 0 < pieces.count() <= 2 * splits < read.count() / 4


def test_files_split_otherwise_when_read_again(spark, tmp_path, small_splits):
    """Splits of another size are an error, not lost lines."""
    (tmp_path / "d.json").write_text(json.dumps(objects(400), indent=2))
    read = splitting.lines(spark, [str(tmp_path / "d.json")])
    other = F.udf(lambda: uuid.uuid4().int % 2**31, "long").asNondeterministic()
    sized = read.withColumn("_size", other())
    found = splitting.records(sized, F.lit(0), lambda state: state <= 1)
    with pytest.raises(PySparkException, match="split otherwise"):
        found.collect()


def test_texts_of_other_encodings_and_long_lines(spark, tmp_path, small_splits):
    """Bytes that are no UTF-8 come back as Spark's own reader has them."""
    body = b'a,b,c\n"\xe9\n",\xff,1\n' + b"".join(b'%d,"\xe9%s\n",z\n' % (n, b"y" * (n % 50)) for n in range(300))
    (tmp_path / "f.csv").write_bytes(body)
    paths = [str(tmp_path / "f.csv")]
    split = splitting.split_csv(spark, paths, COLUMNS, drops.csv_options(True)).drop("_metadata")
    assert rows(split.select(F.hex("a"), F.hex("b"), "c")) == rows(
        drops.read_csv(spark, paths, COLUMNS, True).select(F.hex("a"), F.hex("b"), "c")
    )
