"""One query per operator, each over whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from siltworks.functions.text import fixed_width
from siltworks.operators import columns, distinct, filters, joins, keys, status
from siltworks.plans import checks, people, refine, variants
from siltworks.plans.spec import PEOPLE_SCHEMA
from siltworks.sources import delimited, documents, files, tables
from siltworks.staging import settle, staged_path
from siltworks.streaming import landing
from workload.bronze import SPEC, bronze, table

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

DATABASE = "siltworks_demo"
ROWS_PER_DOCUMENT = 10_000
LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
RECORD_FIELDS = ["Id", "Budget", "RunTime", "OriginalLanguage", "CreatedDate"]


def query(function: Query) -> Query:
    REGISTRY["q_" + function.__name__.rstrip("_")] = function
    return function


def _in_database(spark: SparkSession, label: str) -> str:
    """A fresh table name in the demo database, which becomes current only for a moment."""
    current = spark.catalog.currentDatabase()
    tables.ensure_database(spark, DATABASE, staged_path(spark, DATABASE))
    spark.catalog.setCurrentDatabase(current)
    return f"{DATABASE}.{staged_path(spark, label).rsplit('/', 1)[1].replace('-', '_')}"


# Scans, sources and sinks


def _order_documents(spark: SparkSession, sf_dir: str) -> tuple[str, StructType]:
    """Orders as JSON documents of up to 10,000 orders, with the schema to read them."""
    orders = table(spark, sf_dir, "orders")
    path = staged_path(spark, "documents")
    packed = documents.documents_of(
        orders, "orders", ROWS_PER_DOCUMENT, ["o_orderkey"], replayable=True
    )
    documents.write_documents(packed, path)
    return path, packed.select("orders").schema


def _order_lines(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    path = staged_path(spark, "orders")
    orders.write.json(path)
    return path, orders


@query
def json_scan(spark, sf_dir):
    path, schema = _order_documents(spark, sf_dir)
    found = documents.read_json(spark, path, schema)
    return columns.expand_struct(columns.explode_column(found, "orders", "o"), "o", keep=False)


@query
def json_infer(spark, sf_dir):
    path, _ = _order_documents(spark, sf_dir)
    found = columns.explode_in_place(documents.read_json(spark, path), "orders")
    orders = columns.expand_struct(found, "orders", keep=False)
    return columns.replace_column(
        orders, "o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")
    )


@query
def landing_glob(spark, sf_dir):
    path, orders = _order_lines(spark, sf_dir)
    _litter(spark, sf_dir, path)
    return documents.read_landing(
        spark, path, orders.schema, name_glob="part-*.json", multi_line=False
    )


def _litter(spark: SparkSession, sf_dir: str, path: str) -> None:
    """What a landing folder may hold besides: other files, and folders with matching ones."""
    delimited.csv_writer(table(spark, sf_dir, "nation"), mode="append").save(path)
    for below in ("day=1", "older"):
        table(spark, sf_dir, "orders").write.json(f"{path}/{below}")


@query
def landing_stream(spark, sf_dir):
    path, orders = _order_lines(spark, sf_dir)
    _litter(spark, sf_dir, path)
    stream = landing.stream_landing(
        spark, path, orders.schema, name_glob="*.json", multi_line=False
    )
    loaded = staged_path(spark, "loaded")
    rows = columns.add_metadata(stream, "orders")
    landing.load_available(rows, loaded, staged_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(loaded).select(*orders.columns, "datasource", "status")


@query
def table_scan(spark, sf_dir):
    name = _in_database(spark, "region")
    tables.register_table(spark, name, f"{sf_dir}/region.parquet")
    return tables.read_table(spark, name)


@query
def sql_scan(spark, sf_dir):
    name = _in_database(spark, "nation")
    tables.register_table(spark, name, f"{sf_dir}/nation.parquet")
    return spark.sql("SELECT * FROM IDENTIFIER(:name)", args={"name": name})


@query
def sink_exclude(spark, sf_dir):
    path = staged_path(spark, "customer")
    tables.write_table(table(spark, sf_dir, "customer"), path, exclude=["c_acctbal", "absent"])
    return spark.read.parquet(path)


@query
def sink_partitioned(spark, sf_dir):
    path = staged_path(spark, "orders")
    orders = table(spark, sf_dir, "orders").withColumn(
        "month", F.trunc("o_orderdate", "month")
    )
    tables.write_table(orders, path, partition_by=["month"], compact=True)
    return spark.read.parquet(path).withColumn("month", F.col("month").cast("string"))


@query
def register_table(spark, sf_dir):
    path = staged_path(spark, "orders")
    tables.write_table(table(spark, sf_dir, "orders"), path, partition_by=["o_orderstatus"])
    name = _in_database(spark, "orders")
    tables.register_table(spark, name, path, partitioned=True)
    return tables.read_table(spark, name)


@query
def append_union(spark, sf_dir):
    below, rest = filters.split_at(
        table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 0
    )
    path = staged_path(spark, "customer")
    repaired = columns.replace_column(below, "c_acctbal", F.abs("c_acctbal"))
    tables.write_table(distinct.append_all(rest, repaired), path)
    return spark.read.parquet(path)


@query
def publish_format(spark, sf_dir):
    name, base = _in_database(spark, "nation"), staged_path(spark, "nation")
    tables.publish(table(spark, sf_dir, "nation"), name, base)
    tables.publish(tables.read_table(spark, name), name, base, fmt="orc", keep=1)
    return tables.read_table(spark, name)


@query
def publish_empty(spark, sf_dir):
    """A partitioned table whose rows all go keeps its columns, and takes rows again."""
    name, base = _in_database(spark, "orders"), staged_path(spark, "orders")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    by = ["o_orderstatus"]
    tables.publish(orders, name, base, partition_by=by)
    tables.publish(tables.read_table(spark, name).filter("o_orderkey < 0"), name, base, partition_by=by)
    emptied = tables.read_table(spark, name).withColumn("state", F.lit("emptied"))
    tables.publish(orders.filter("o_orderstatus = 'F'"), f"{name}_again", f"{base}_again", partition_by=by)
    again = tables.read_table(spark, f"{name}_again").withColumn("state", F.lit("filled"))
    return emptied.unionByName(again)


@query
def view_sql(spark, sf_dir):
    """A frame by its name in SQL, and a frame given to one statement."""
    rows = bronze(spark, sf_dir)
    name = "bronze_" + staged_path(spark, "view").rsplit("-", 1)[1]
    tables.name_frame(rows, name)
    clean = spark.sql(f"SELECT value FROM {name} WHERE value.Budget >= 100000 AND value.RunTime >= 0")
    return spark.sql(
        "SELECT value.Id, CASE WHEN value IN (SELECT value FROM {clean}) THEN 'loaded' ELSE status END"
        " AS status FROM {rows}",
        clean=clean,
        rows=spark.table(name),
    )


@query
def self_overwrite(spark, sf_dir):
    name, base = _in_database(spark, "line"), staged_path(spark, "line")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    tables.publish(lines, name, base)
    tables.publish(tables.read_table(spark, name).distinct(), name, base)
    return tables.read_table(spark, name)


@query
def tsv_scan(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    path = _as_tsv(customers)
    return delimited.read_tsv(spark, path, customers.schema)


@query
def csv_roundtrip(spark, sf_dir):
    key = F.col("event_id").cast("string")
    padded = F.concat(F.lit("  "), "event_type", F.lit(' "'), key, F.lit('", ')).alias("padded")
    blank = F.when(F.col("event_id") % 2 == 0, "  ").otherwise(",").alias("blank")
    events = table(spark, sf_dir, "events").select("*", padded, blank)
    path = staged_path(spark, "events")
    delimited.csv_writer(events).save(path)
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .schema(events.schema)
        .csv(path)
    )


def _chunk_summary(spark: SparkSession, chunks: DataFrame) -> DataFrame:
    path = staged_path(spark, "chunks")
    documents.write_chunks(chunks, path)
    schema = "o_orderkey bigint, chunk int"
    return (
        documents.read_json(spark, path, schema, multi_line=False)
        .groupBy("chunk")
        .agg(
            F.count("*").alias("n"),
            F.min("o_orderkey").alias("first_key"),
            F.max("o_orderkey").alias("last_key"),
        )
    )


@query
def json_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return _chunk_summary(spark, documents.chunked(orders, 8, ["o_orderkey"], replayable=True))


@query
def json_split_overlap(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    chunks = documents.chunked(orders, 8, ["o_orderkey"], overlap=True, replayable=True)
    return _chunk_summary(spark, chunks)


@query
def split_refresh(spark, sf_dir):
    path, orders = staged_path(spark, "landing"), table(spark, sf_dir, "orders")
    documents.split_landing(orders, "orders", 8, ["o_orderkey"], path, 1000, replayable=True)
    schema = T.StructType().add("orders", T.ArrayType(orders.schema))
    found = documents.read_landing(spark, path, schema, "part-*", multi_line=False)
    return columns.expand_struct(columns.explode_column(found, "orders", "o"), "o", keep=False)


@query
def split_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return documents.chunked(orders, 8, ["o_orderkey"], replayable=True)


@query
def document_split(spark, sf_dir):
    path, schema = _order_documents(spark, sf_dir)
    found = documents.read_json(spark, path, schema)
    return documents.split_documents(found, "orders", 8).select("chunk", "element.o_orderkey")


@query
def inventory(spark, sf_dir):
    # A text file holds its lines and a line feed after each, whatever the number of files.
    path = staged_path(spark, "texts")
    table(spark, sf_dir, "documents").select("text", "lang").write.partitionBy("lang").text(path)
    lang = F.regexp_extract("path", "/lang=([^/]*)/", 1).alias("lang")
    return files.inventory(spark, path).groupBy(lang, "type").agg(F.sum("size").alias("bytes"))


@query
def inventory_top(spark, sf_dir):
    path = staged_path(spark, "texts")
    texts = table(spark, sf_dir, "documents").select("text")
    texts.write.text(path)
    texts.write.text(f"{path}/lang=xx")
    found = files.inventory(spark, path, recursive=False)
    return found.groupBy("type").agg(F.sum("size").alias("bytes"))


# Projections


@query
def add_metadata(spark, sf_dir):
    marked = columns.add_metadata(table(spark, sf_dir, "orders"), "orders file")
    dated = F.col("ingestdate") == F.to_date("ingesttime")
    return marked.groupBy("datasource", "status").agg(
        F.count("*").alias("n"), F.count_if(dated).alias("n_dated")
    )


@query
def struct_expand(spark, sf_dir):
    expanded = columns.expand_struct(bronze(spark, sf_dir), "value")
    return expanded.select(
        F.col("value.Id").alias("value_id"), *RECORD_FIELDS, F.array_size("genres").alias("n_genres")
    )


@query
def abs_repair(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return columns.replace_column(customers, "c_acctbal", F.abs("c_acctbal"))


@query
def cast_date(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("o_date")
    )


@query
def format_line(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        fixed_width(("p_name", 100), ("p_brand", 10), ("p_size", 10), gap={1: "  "}).alias("line"),
    )


@query
def project(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("movieid"), F.col("o_custkey").alias("genreid")
    )


def _customer_people(spark: SparkSession, sf_dir: str, other_style: bool = False) -> DataFrame:
    """Customers as contacts; the other style of writing is equal once normalised."""
    key = F.col("c_custkey").cast("string")
    email = F.concat(F.lit("C"), key, F.lit("@Example.com"))
    dash = "" if other_style else "-"
    number = F.lit("" if other_style else "No.")
    case = F.upper if other_style else F.initcap
    return table(spark, sf_dir, "customer").select(
        case("c_mktsegment").alias("first"),
        case("c_name").alias("last"),
        (F.upper(email) if other_style else email).alias("email"),
        F.concat(F.lit("555" + dash), key, F.lit(dash + "01")).alias("phone"),
        F.concat(
            number, key, F.lit(" Elm St #"), F.col("c_nationkey").cast("string"), F.lit(" #")
        ).alias("address"),
    )


def _supplier_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey").cast("string")
    return table(spark, sf_dir, "supplier").select(
        F.lit("Supply").alias("first"),
        F.col("s_name").alias("last"),
        F.concat(F.lit("S"), key, F.lit("@Example.com")).alias("email"),
        F.concat(F.lit("556-"), key).alias("phone"),
        F.concat(F.lit("No. "), key, F.lit(" North St")).alias("address"),
    )


def _as_tsv(people_rows: DataFrame) -> str:
    path = staged_path(people_rows.sparkSession, "tsv")
    (
        people_rows.write.option("sep", "\t")
        .option("header", True)
        .option("quote", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


@query
def normalize(spark, sf_dir):
    contacts = _customer_people(spark, sf_dir)
    padded = [F.concat(F.lit("  "), c, F.lit(" ")).alias(c) for c in contacts.columns]
    return people.normalize_people(contacts.select(*padded))


@query
def people_dedupe(spark, sf_dir):
    first = _as_tsv(_customer_people(spark, sf_dir))
    second = _as_tsv(
        _customer_people(spark, sf_dir, other_style=True).union(_supplier_people(spark, sf_dir))
    )
    lists = [delimited.read_tsv(spark, path, PEOPLE_SCHEMA) for path in (first, second)]
    merged = people.merged_people(*lists)
    path = staged_path(spark, "people")
    delimited.csv_writer(merged).save(path)
    return spark.read.option("header", True).option("escape", '"').schema(merged.schema).csv(path)


# Generators


@query
def explode(spark, sf_dir):
    elements = columns.explode_column(table(spark, sf_dir, "embeddings"), "embedding", "x")
    return elements.agg(
        F.count("*").alias("n"),
        F.min(F.col("x").cast("double")).alias("low"),
        F.max(F.col("x").cast("double")).alias("high"),
    )


@query
def explode_carry(spark, sf_dir):
    elements = columns.explode_column(
        table(spark, sf_dir, "embeddings"), "embedding", "x", ["vec_id", "label"]
    )
    return elements.groupBy("vec_id", "label").agg(
        F.count("*").alias("n"), F.max(F.col("x").cast("double")).alias("high")
    )


@query
def explode_inplace(spark, sf_dir):
    vectors = columns.explode_in_place(table(spark, sf_dir, "embeddings"), "embedding")
    return vectors.select("vec_id", F.col("embedding").cast("double").alias("embedding"), "label")


# Filters


@query
def split_below(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return filters.split_at(orders, "o_totalprice", 100000)[0]


@query
def split_at_or_above(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return filters.split_at(orders, "o_totalprice", 100000)[1]


@query
def split_with_nulls(spark, sf_dir):
    """Rows with a null budget are on neither side."""
    fields = columns.expand_struct(bronze(spark, sf_dir), "value", keep=False).select("Id", "Budget")
    below, rest = filters.split_at(fields, "Budget", 100000)
    return below.withColumn("side", F.lit("below")).union(rest.withColumn("side", F.lit("rest")))


@query
def blank_split(spark, sf_dir):
    tags = columns.explode_column(bronze(spark, sf_dir), "value.genres", "tag")
    blank, named = filters.split_blank(columns.expand_struct(tags, "tag", keep=False), "name")
    return (
        blank.withColumn("side", F.lit("blank"))
        .unionByName(named.withColumn("side", F.lit("named")))
        .groupBy("side", "id", "name")
        .agg(F.count("*").alias("n"))
    )


@query
def status_eq(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return filters.with_status(orders, "F", "o_orderstatus")


@query
def filter_and(spark, sf_dir):
    fields = columns.expand_struct(bronze(spark, sf_dir), "value", keep=False)
    return filters.where_all(
        fields.select("Id", "Budget", "RunTime"), F.col("RunTime") >= 0, "Budget > 100000"
    )


# Joins


@query
def dim_replace(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    priorities = orders.select(F.col("o_orderpriority").alias("priority")).distinct()
    dimension = settle(keys.dense_key(priorities, "priorityid", ["priority"]))
    return joins.replace_with_key(
        orders, "o_orderpriority", dimension, "priority", "priorityid", drop=["o_orderdate"]
    )


@query
def using_join(spark, sf_dir):
    single = distinct.singletons(table(spark, sf_dir, "lineitem"), "l_orderkey")
    orders = table(spark, sf_dir, "orders")
    return joins.join_using(
        orders.select("o_orderkey", "o_totalprice"),
        single.withColumnRenamed("l_orderkey", "o_orderkey"),
        "o_orderkey",
    )


@query
def in_semi(spark, sf_dir):
    return joins.is_in(
        table(spark, sf_dir, "customer"), "c_custkey", table(spark, sf_dir, "orders"), "o_custkey"
    )


@query
def not_in_null_key(spark, sf_dir):
    """A null among the keys admits nothing; the other side asks for what has no key."""
    languages = bronze(spark, sf_dir).select("value.Id", F.col("value.OriginalLanguage").alias("lang"))
    some = languages.filter("lang <> '1-URGENT' OR lang IS NULL")
    known = some.filter("lang IS NOT NULL")
    return joins.not_in(languages, "lang", some).withColumn("keys", F.lit("with null")).union(
        joins.not_in(languages, "lang", known).withColumn("keys", F.lit("without null"))
    )


@query
def not_in_anti(spark, sf_dir):
    return joins.not_in(
        table(spark, sf_dir, "orders"), "o_orderkey", table(spark, sf_dir, "lineitem"), "l_orderkey"
    )


# Aggregations and distinct


@query
def duplicates(spark, sf_dir):
    return distinct.duplicates(table(spark, sf_dir, "documents"), "text")


@query
def duplicate_records(spark, sf_dir):
    return distinct.duplicates(bronze(spark, sf_dir), "value").select("value.Id", "copies")


@query
def distinct_records(spark, sf_dir):
    return distinct.distinct_records(bronze(spark, sf_dir).select("value")).select(*(F.col(f"value.{n}").alias(n) for n in RECORD_FIELDS))


@query
def singletons(spark, sf_dir):
    return distinct.singletons(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def distinct_(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_regionkey").distinct()


@query
def distinct_struct(spark, sf_dir):
    tags = columns.explode_column(bronze(spark, sf_dir), "value.genres", "tag").distinct()
    return columns.expand_struct(tags, "tag", keep=False)


@query
def union_distinct(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("name"), F.col("c_nationkey").alias("nation")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )
    return distinct.distinct_union(customers, suppliers)


# Surrogate keys and dimensions


@query
def dense_key_lang(spark, sf_dir):
    langs = table(spark, sf_dir, "documents").select("lang").distinct()
    return keys.dense_key(langs, "langid", ["lang"])


@query
def dense_key_large(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    order = ["l_shipdate", *[c for c in LINE_COLUMNS if c != "l_shipdate"]]
    return keys.dense_key(lines, "lineid", order, replayable=True)


@query
def sparse_key(spark, sf_dir):
    lines = keys.sparse_key(table(spark, sf_dir, "lineitem").select("l_orderkey"), "lineid")
    return lines.agg(
        F.count("*").alias("n"), F.count_distinct("lineid").alias("n_ids")
    )


@query
def sparse_key_rows(spark, sf_dir):
    lines = keys.sparse_key(table(spark, sf_dir, "lineitem").select("l_orderkey"), "lineid")
    return lines.groupBy("l_orderkey").agg(
        F.count("*").alias("n"), F.count_distinct("lineid").alias("n_ids")
    )


@query
def genre_dim(spark, sf_dir):
    return refine.tag_dimension(bronze(spark, sf_dir), SPEC)


@query
def bridge(spark, sf_dir):
    return refine.bridge(bronze(spark, sf_dir), SPEC)


@query
def language_dim(spark, sf_dir):
    return refine.attribute_dimension(bronze(spark, sf_dir), SPEC)


# Status


@query
def update_in(spark, sf_dir):
    rows = bronze(spark, sf_dir)
    clean = rows.filter("value.Budget >= 100000 AND value.RunTime >= 0").select("value")
    return status.apply_status(rows, clean, status.LOADED).select("value.Id", "status")


@query
def update_not_in(spark, sf_dir):
    rows = bronze(spark, sf_dir)
    clean = rows.filter("value.Budget >= 100000 AND value.RunTime >= 0").select("value")
    return status.apply_status(rows, clean, status.QUARANTINED, negate=True).select(
        "value.Id", "status"
    )


@query
def merge_status(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status")
    )
    big = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum("l_quantity").alias("quantity"))
        .filter("quantity > 150")
        .select("o_orderkey", F.lit("big").alias("status"))
    )
    return status.merge_status(orders, big, "o_orderkey")


# Quality and whole plans


def _languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle(refine.attribute_dimension(bronze(spark, sf_dir), SPEC), "languages")


@query
def classify(spark, sf_dir):
    return refine.first_status(bronze(spark, sf_dir), SPEC).select("value.Id", "status")


@query
def quarantined(spark, sf_dir):
    marked = refine.first_status(bronze(spark, sf_dir), SPEC)
    return status.quarantined(marked).select(*RECORD_FIELDS)


@query
def repair(spark, sf_dir):
    marked = refine.first_status(bronze(spark, sf_dir), SPEC)
    return refine.loadable(
        filters.with_status(marked, status.QUARANTINED), _languages(spark, sf_dir), SPEC
    )


@query
def load_repaired(spark, sf_dir):
    return refine.loadable(bronze(spark, sf_dir), _languages(spark, sf_dir), SPEC)


@query
def silver(spark, sf_dir):
    return refine.silver(bronze(spark, sf_dir), _languages(spark, sf_dir), SPEC)


@query
def bronze_status(spark, sf_dir):
    return refine.final_status(bronze(spark, sf_dir), SPEC).select("value.Id", "status")


@query
def checks_(spark, sf_dir):
    rows = bronze(spark, sf_dir)
    return checks.end_state(
        refine.final_status(rows, SPEC),
        refine.silver(rows, _languages(spark, sf_dir), SPEC),
        refine.tag_dimension(rows, SPEC),
        SPEC,
    )


HEALTHY = ("RunTime >= 0", "Budget > 100000")


@query
def single_occurrence(spark, sf_dir):
    fields = columns.expand_struct(bronze(spark, sf_dir), "value", keep=False)
    return variants.single_occurrence(fields.select(*RECORD_FIELDS), "Id", HEALTHY)


@query
def single_occurrence_unfiltered(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return variants.single_occurrence(
        lines, "l_orderkey", ["l_quantity >= 25"], unfiltered=True
    )


def _entities(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The bronze and silver tables of the entities derived from bronze."""
    rows = bronze(spark, sf_dir)
    tags = columns.explode_column(rows, "value.genres", "genres").distinct()
    entities = {
        "genre": variants.Entity(
            tags, ["genres.id", "genres.name"], F.col("genres.name") != "", F.col("genres.name") == ""
        ),
        "movie_genre": variants.Entity(refine.bridge(rows, SPEC), ["movieid", "genreid"]),
        "language": variants.Entity(refine.attribute_dimension(rows, SPEC), ["languageid", "language"]),
    }
    current = spark.catalog.currentDatabase()
    root = staged_path(spark, "entities")
    database = root.rsplit("/", 1)[1].replace("-", "_")
    named = variants.refine_entities(spark, entities, root, database, "derived")
    spark.catalog.setCurrentDatabase(current)
    return named


@query
def entity_bronze(spark, sf_dir):
    named = _entities(spark, sf_dir)
    genre, bridge_rows, language = (
        tables.read_table(spark, named[f"{role}_bronze"]) for role in ("genre", "movie_genre", "language")
    )
    return (
        genre.select(F.lit("genre").alias("entity"), "genres.id", F.col("genres.name").alias("name"), "status")
        .union(
            bridge_rows.select(
                F.lit("movie_genre"), "moviegenreid", F.concat_ws("-", "movieid", "genreid"), "status"
            )
        )
        .union(language.select(F.lit("language"), "languageid", "language", "status"))
    )


@query
def entity_silver(spark, sf_dir):
    named = _entities(spark, sf_dir)
    genre, bridge_rows, language = (
        tables.read_table(spark, named[f"{role}_silver"]) for role in ("genre", "movie_genre", "language")
    )
    return (
        genre.select(F.lit("genre").alias("entity"), "id", "name")
        .union(bridge_rows.select(F.lit("movie_genre"), "movieid", F.col("genreid").cast("string")))
        .union(language.select(F.lit("language"), "languageid", "language"))
    )


@query
def unreadable(spark, sf_dir):
    """Documents of one order each, of which some are cut off: bronze, and what was lost."""
    order = F.to_json(F.struct(F.array(F.struct("o_orderkey", "o_totalprice")).alias("orders")))
    cut = F.when(F.col("o_orderkey") % 50 == 0, F.left(order, F.lit(20))).otherwise(order)
    path = staged_path(spark, "landing")
    table(spark, sf_dir, "orders").select(cut.alias("value")).write.text(path)
    schema = "orders array<struct<o_orderkey: bigint, o_totalprice: double>>, _text string"
    found = documents.read_landing(spark, path, schema, multi_line=False, corrupt_column="_text")
    lost = refine.unreadable(found, "orders", "_text")
    kept = columns.expand_struct(columns.explode_column(found, "orders", "o"), "o", keep=False)
    return kept.select(F.col("o_orderkey").cast("string").alias("document")).union(lost.select("text"))


@query
def full_refresh(spark, sf_dir):
    rows = columns.expand_struct(bronze(spark, sf_dir), "value", keep=False)
    packed = documents.documents_of(rows, "movie", ROWS_PER_DOCUMENT, ["Id"], replayable=True)
    source = staged_path(spark, "landing")
    packed.drop("document").write.json(source)
    # Records in folders below the landing folder are not its own. They are the same lines, so
    # they are copied, and as such folders often are, compressed.
    lines = spark.read.text(f"{source}/part-*")
    for below in ("day=1", "older"):
        lines.write.option("compression", "gzip").text(f"{source}/{below}")
    schema = packed.select("movie").schema
    current = spark.catalog.currentDatabase()
    named = refine.refine(
        spark, source, staged_path(spark, "layers"), DATABASE, SPEC, schema, "movie", "derived",
        name_glob="part-*", multi_line=False,
    )
    spark.catalog.setCurrentDatabase(current)
    bronze_rows = tables.read_table(spark, named["bronze"])
    silver_rows = tables.read_table(spark, named["silver"])
    return (
        bronze_rows.select(F.lit("bronze").alias("layer"), "value.Id", "status")
        .union(silver_rows.select(F.lit("silver"), "Id", F.col("OriginalLanguage").cast("string")))
    )


# Queries on tables that change register themselves.
from workload import loads  # noqa: E402,F401
