import csv
import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltworks.sources import delimited, documents, files, tables
from siltworks.streaming import landing

PEOPLE = "first string, last string, email string, phone string, address string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_json_permissive_and_corrupt_text(spark, tmp_path):
    document = {"movie": [{"Id": 1, "Budget": "much"}, {"Id": 2}]}
    (tmp_path / "a.json").write_text(json.dumps(document, indent=2))
    (tmp_path / "b.json").write_text('{"movie": [')
    schema = "movie array<struct<Id: bigint, Budget: double>>, _bad string"
    found = documents.read_json(spark, str(tmp_path), schema, corrupt_column="_bad").cache()
    assert found.filter("movie IS NULL").count() == 1
    assert found.filter("_bad IS NOT NULL").count() == 2
    elements = found.select(F.explode("movie").alias("m")).select("m.*")
    assert rows(elements) == [(1, None), (2, None)]
    with pytest.raises((PySparkException, Py4JJavaError)):
        documents.read_json(spark, str(tmp_path), schema, mode="FAILFAST").collect()


def test_json_field_names_are_case_sensitive(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"runtime": 5}')
    assert rows(documents.read_json(spark, str(tmp_path), "RunTime bigint")) == [(None,)]


def test_landing_takes_matching_names_in_the_folder_itself(spark, tmp_path):
    for name, number in (("movie_1.json", 1), ("movie", 2), ("Movie_3.json", 3), ("a_movie.json", 4)):
        (tmp_path / name).write_text(json.dumps({"n": number}))
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "movie_5.json").write_text('{"n": 5}')
    assert rows(documents.read_landing(spark, str(tmp_path), "n int", "movie*")) == [(1,), (2,)]


@pytest.mark.parametrize("name", ["land", "with blank + é%", "day=2"])
def test_landing_beside_folders_named_like_partitions(spark, tmp_path, name):
    folder = tmp_path / name
    (folder / "day=1" / name).mkdir(parents=True)
    (folder / "movie_1.json").write_text('{"n": 1}')
    (folder / "day=1" / "movie_5.json").write_text('{"n": 5}')
    (folder / "day=1" / name / "movie_6.json").write_text('{"n": 6}')
    for path in (str(folder), f"file://{folder}/"):
        found = documents.read_landing(spark, path, "n int", "movie*")
        assert found.columns == ["n"] and rows(found) == [(1,)]
        assert rows(files.inventory(spark, path, recursive=False).select("name")) == [("movie_1.json",)]
    stream = landing.stream_landing(spark, str(folder), "n int", name_glob="movie*")
    loaded, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    landing.load_available(stream, loaded, progress, partition_by=()).awaitTermination()
    assert rows(spark.read.parquet(loaded)) == [(1,)]


def test_split_landing_is_read_by_a_landing_reader(spark, tmp_path):
    df = spark.range(95).select(F.col("id").alias("k"))
    path = str(tmp_path / "land")
    documents.split_landing(df, "movie", 8, ["k"], path, rows_per_document=5)
    found = documents.read_landing(
        spark, path, "chunk int, movie array<struct<k: bigint>>", multi_line=False
    )
    assert found.filter("size(movie) > 5").count() == 0
    elements = found.select("chunk", F.explode("movie").alias("m")).select("chunk", "m.k")
    assert rows(elements) == rows(documents.chunked(df, 8, ["k"]))


def test_chunks_are_the_even_slices(spark):
    sizes = [*range(1, 60), 10004]
    numbers = (
        spark.createDataFrame([(n,) for n in sizes], "cnt bigint")
        .withColumn("pos", F.explode(F.sequence(F.lit(1), F.col("cnt"))))
        .withColumn("chunk", documents.chunk_of(F.col("pos"), F.col("cnt"), 8))
    )
    found = {}
    for r in numbers.groupBy("cnt", "chunk").agg(F.min("pos"), F.max("pos"), F.count("*")).collect():
        found[r[0], r[1]] = tuple(r)[2:]
    for cnt in sizes:
        for i in range(8):
            start, stop = int(cnt * i / 8), int(cnt * (i + 1) / 8)
            expected = (start + 1, stop, stop - start) if stop > start else None
            assert found.get((cnt, i)) == expected


def test_chunked_rows(spark):
    df = spark.range(80).select(F.col("id").alias("k"))
    disjoint = documents.chunked(df, 8, ["k"])
    assert rows(disjoint.groupBy("chunk").count()) == [(i, 10) for i in range(8)]
    assert disjoint.select("k").distinct().count() == 80
    overlapping = documents.chunked(df, 8, ["k"], overlap=True)
    assert overlapping.count() == 80 * 29 // 8
    copies = {r.k: r["count"] for r in overlapping.groupBy("k").count().collect()}
    assert copies == {k: max(1, k // 10) for k in range(80)}


def test_documents_hold_all_rows_in_order(spark, tmp_path):
    df = spark.range(25).select(F.col("id").alias("k"), F.lit("x").alias("s"))
    packed = documents.documents_of(df, "rows", 10, ["k"])
    path = str(tmp_path / "docs")
    documents.write_documents(packed, path)
    assert len(list((tmp_path / "docs").glob("part-*.json"))) == 3
    found = documents.read_json(spark, path, packed.select("rows").schema)
    arrays = sorted([r.k for r in d.rows] for d in found.collect())
    assert arrays == [list(range(10)), list(range(10, 20)), list(range(20, 25))]
    split = documents.split_documents(found, "rows", 2)
    assert split.filter("chunk = 0").count() == 12


TSV_HEADER = "First\tLast\tEmail\tPhone\tAddress\n"


def test_tsv_has_no_quoting_and_keeps_empty_texts(spark, tmp_path):
    (tmp_path / "p.txt").write_text(TSV_HEADER + '"Al\tB"o\tA@x\t\tNo.1 "Elm"\n')
    assert rows(delimited.read_tsv(spark, str(tmp_path), PEOPLE)) == [('"Al', 'B"o', "A@x", "", 'No.1 "Elm"')]


@pytest.mark.parametrize("line", ["a\tb\tc\td", "a\tb\tc\td\te\tf"])
def test_tsv_with_another_number_of_fields(spark, tmp_path, line):
    (tmp_path / "p.txt").write_text(TSV_HEADER + "a\tb\tc\td\te\n" + line + "\n")
    strict = delimited.read_tsv(spark, str(tmp_path), PEOPLE)
    for df in (strict, strict.select("first"), strict.groupBy().count()):
        with pytest.raises((PySparkException, Py4JJavaError)):
            df.collect()
    lenient = delimited.read_tsv(
        spark, str(tmp_path), PEOPLE + ", _bad string", mode="PERMISSIVE", corrupt_column="_bad"
    ).cache()
    assert [r._bad for r in lenient.filter("_bad IS NOT NULL").collect()] == [line]


def test_csv_reads_back_with_a_standard_reader(spark, tmp_path):
    values = [('say "hi"', "a,b"), ("", "back\\slash"), ("two\nlines", "plain")]
    df = spark.createDataFrame(values, "FirstName string, Address string").coalesce(1)
    delimited.csv_writer(df).save(str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*.csv")
    text = part.read_bytes().decode()
    assert text.startswith("FirstName,Address\n")
    assert "plain\n" in text and '"plain"' not in text
    with open(part, newline="") as lines:
        assert sorted(map(tuple, list(csv.reader(lines))[1:])) == sorted(values)


@pytest.mark.parametrize("line", ["", " ", "\t", "  \t "])
def test_tsv_blank_lines_count(spark, tmp_path, line):
    (tmp_path / "p.txt").write_text(TSV_HEADER + "a\tb\tc\td\te\n" + line + "\nf\tg\th\ti\tj\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        delimited.read_tsv(spark, str(tmp_path), PEOPLE).collect()
    lenient = delimited.read_tsv(
        spark, str(tmp_path), PEOPLE + ", _bad string", mode="PERMISSIVE", corrupt_column="_bad"
    ).cache()
    assert [r._bad for r in lenient.filter("_bad IS NOT NULL").collect()] == [line]
    assert lenient.count() == 3
    dropped = delimited.read_tsv(spark, str(tmp_path), PEOPLE, mode="DROPMALFORMED")
    assert len(dropped.collect()) == 2


def test_tsv_read_once(spark, tmp_path):
    (tmp_path / "p.tsv").write_text("h\th\th\th\th\na\tb\tc\td\te\n\t\t\t\t\n\n")
    once = delimited.read_tsv(spark, str(tmp_path), PEOPLE, blank_lines=False)
    assert rows(once) == [("a", "b", "c", "d", "e")]
    assert once._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_tsv_line_of_empty_fields(spark, tmp_path):
    (tmp_path / "p.txt").write_text(TSV_HEADER + "\t \t\t\t\n")
    assert rows(delimited.read_tsv(spark, str(tmp_path), PEOPLE)) == [("", " ", "", "", "")]


def test_csv_keeps_blanks_and_times(spark, tmp_path):
    values = [(" a ", "  "), ("", "\t"), ("x", " 12 elm")]
    df = spark.createDataFrame(values, "a string, b string").withColumn(
        "t", F.lit("2024-01-01 00:00:00.123456").cast("timestamp_ntz")
    )
    delimited.csv_writer(df.coalesce(1)).save(str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*.csv")
    with open(part, newline="") as lines:
        found = list(csv.reader(lines))[1:]
    assert sorted(tuple(r[:2]) for r in found) == sorted(values)
    assert {r[2] for r in found} == {"2024-01-01T00:00:00.123456"}


def test_csv_line_end(spark, tmp_path):
    delimited.csv_writer(spark.range(1).coalesce(1), line_end="\r\n").save(str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert part.read_bytes() == b"id\r\n0\r\n"


def test_publish_replaces_a_table_by_itself(spark, tmp_path, database):
    name, base = f"{database}.numbers", str(tmp_path / "numbers")
    tables.publish(spark.range(4).union(spark.range(4)), name, base)
    old = tables.read_table(spark, name)
    tables.publish(old.distinct(), name, base)
    assert rows(tables.read_table(spark, name)) == [(0,), (1,), (2,), (3,)]
    assert old.count() == 8


def test_publish_partitioned(spark, tmp_path, database):
    name, base = f"{database}.parts", str(tmp_path / "parts")
    df = spark.range(6).select("id", (F.col("id") % 2).alias("p"))
    tables.publish(df, name, base, partition_by=["p"])
    tables.publish(tables.read_table(spark, name).filter("id < 3"), name, base, partition_by=["p"])
    assert rows(tables.read_table(spark, name)) == [(0, 0), (1, 1), (2, 0)]


def test_publish_follows_a_change_of_layout(spark, tmp_path, database):
    name, base = f"{database}.changing", str(tmp_path / "changing")
    df = spark.range(6).select("id", (F.col("id") % 2).alias("p"))
    tables.publish(df, name, base, partition_by=["p"])
    tables.publish(df.filter("id < 2"), name, base)
    assert rows(tables.read_table(spark, name)) == [(0, 0), (1, 1)]
    tables.publish(df.select(F.col("id").cast("string").alias("id")), name, base)
    assert tables.read_table(spark, name).dtypes == [("id", "string")]
    assert tables.read_table(spark, name).count() == 6


def test_publish_follows_a_change_of_format(spark, tmp_path, database):
    name, base = f"{database}.formats", str(tmp_path / "formats")
    for fmt in ("parquet", "orc", "parquet"):
        tables.publish(spark.range(3), name, base, fmt=fmt)
        assert rows(tables.read_table(spark, name)) == [(0,), (1,), (2,)]


def test_publish_nothing(spark, tmp_path, database):
    name, base = f"{database}.emptied", str(tmp_path / "emptied")
    df = spark.range(6).select("id", (F.col("id") % 2).alias("p"))
    tables.publish(df, name, base, partition_by=["p"])
    tables.publish(tables.read_table(spark, name).filter("id < 0"), name, base, partition_by=["p"])
    assert rows(tables.read_table(spark, name)) == []
    assert tables.read_table(spark, name).dtypes == df.dtypes
    tables.publish(df, name, base, partition_by=["p"])
    assert tables.read_table(spark, name).count() == 6


def test_old_snapshots_expire(spark, tmp_path, database):
    name, base = f"{database}.kept", str(tmp_path / "kept")
    for n in range(1, 5):
        last = tables.publish(spark.range(n), name, base, keep=2)
    found = sorted(p.name for p in (tmp_path / "kept").iterdir())
    assert len(found) == 2 and last.endswith(found[-1])
    assert tables.read_table(spark, name).count() == 4
    tables.expire_snapshots(spark, base, 0)
    assert tables.read_table(spark, name).count() == 4


def test_frame_by_name(spark):
    tables.name_frame(spark.range(3), "numbers_here")
    assert spark.sql("SELECT sum(id) AS s FROM numbers_here").first().s == 3


def test_register_replaces_and_leaves_data(spark, tmp_path, database):
    for label, n in (("a", 2), ("b", 3)):
        tables.write_table(spark.range(n), str(tmp_path / label))
        tables.register_table(spark, f"{database}.t", str(tmp_path / label))
    assert tables.read_table(spark, "t").count() == 3
    assert spark.read.parquet(str(tmp_path / "a")).count() == 2


def test_writer_appends_excludes_and_is_not_started(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(2).select("id", F.lit(1).alias("extra"))
    writer = tables.table_writer(df, exclude=["extra", "absent"])
    assert not (tmp_path / "t").exists()
    writer.save(path)
    tables.write_table(df, path, exclude=["extra"])
    assert rows(spark.read.parquet(path)) == [(0,), (0,), (1,), (1,)]


def test_compact_partitions(spark, tmp_path):
    df = spark.range(1000, numPartitions=8).select("id", (F.col("id") % 5).alias("p"))
    tables.write_table(df, str(tmp_path / "t"), partition_by=["p"], compact=True)
    assert len(list((tmp_path / "t").glob("p=*/*.parquet"))) == 5
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_inventory(spark, tmp_path):
    (tmp_path / "a.jpg").write_bytes(b"123")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.png").write_bytes(b"12345")
    (tmp_path / "noext").write_bytes(b"1")
    (tmp_path / "empty").write_bytes(b"")
    found = files.inventory(spark, str(tmp_path))
    assert rows(found.select("name", "type", "size")) == [
        ("a.jpg", "jpg", 3), ("b.png", "png", 5), ("noext", "", 1),
    ]
    top = files.inventory(spark, str(tmp_path), "*.*g", recursive=False)
    assert rows(top.select("name")) == [("a.jpg",)]
    lines = [r.line for r in files.inventory_lines(found).collect()]
    assert sorted(lines)[0] == f"{'a.jpg':<100}{'jpg':<10}  {3:<10}"
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_stream_loads_each_file_once(spark, tmp_path):
    source, loaded, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    (tmp_path / "in").mkdir()
    archive = str(tmp_path / "archive" / "deep")

    def put(name, *numbers):
        (tmp_path / "in" / name).write_text(json.dumps({"movie": [{"Id": n} for n in numbers]}, indent=1))

    def load():
        found = landing.stream_landing(
            spark, source, "movie array<struct<Id: bigint>>", name_glob="movie*", clean="archive", archive=archive
        )
        records = found.select(F.explode("movie").alias("value"), F.current_date().alias("ingestdate"))
        landing.load_available(records, loaded, progress).awaitTermination()
        return sorted(r.Id for r in spark.read.parquet(loaded).select("value.Id").collect())

    put("movie_0.json", 1, 2)
    put("other.json", 9)
    assert load() == [1, 2]
    put("movie_1.json", 3, 3)
    assert load() == [1, 2, 3, 3]
    assert load() == [1, 2, 3, 3]
    assert (tmp_path / "in" / "other.json").exists()
