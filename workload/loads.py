"""Queries on tables that change: listings, updates by partition, further loads, and snapshots."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from siltworks.operators import changes, columns, keys, ledger
from siltworks.plans import checks, increment, refine, updates
from siltworks.sources import documents, listing, snapshots, variants
from siltworks.staging import settle, staged_path
from siltworks.streaming import landing, refresh
from workload.bronze import SPEC, bronze, table
from workload.queries import ROWS_PER_DOCUMENT, _in_database, query


@query
def inventory_all(spark, sf_dir):
    """Files of three writes, one of them empty, by folder; checksum files are the file system's own."""
    path = staged_path(spark, "texts")
    texts = table(spark, sf_dir, "documents").select("text", "lang")
    texts.write.partitionBy("lang").text(f"{path}/by language")
    texts.select("text").write.text(f"{path}/all/of/them")
    texts.select("text").filter(F.lit(False)).coalesce(1).write.text(f"{path}/none")
    folder = F.regexp_replace("place", "/[^/]*$", "").alias("folder")
    found = listing.inventory_all(spark, path).filter("type <> 'crc'")
    return found.groupBy(folder, F.col("name").startswith("_").cast("int").alias("hidden")).agg(
        F.count_if(F.col("size") == 0).alias("n_empty"), F.sum("size").alias("bytes")
    )


def _published_orders(spark, sf_dir):
    name, base = _in_database(spark, "orders"), staged_path(spark, "orders")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.trunc("o_orderdate", "month").alias("month")
    )
    snapshots.publish_swap(orders, name, base, partition_by=["month"])
    return name, base


@query
def update_partitions(spark, sf_dir):
    """Orders of one customer are marked, and then those with much quantity merged in."""
    name, base = _published_orders(spark, sf_dir)
    orders = table(spark, sf_dir, "orders")
    first = orders.agg(F.min("o_custkey")).first()[0]
    marked = orders.filter(F.col("o_custkey") == first).select("o_orderkey")
    updates.update_partitions(spark, name, base, marked, "seen", on="o_orderkey")
    big = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum("l_quantity").alias("quantity"))
        .filter("quantity > 200")
        .select("o_orderkey", F.lit("big").alias("status"))
    )
    updates.merge_partitions(spark, name, base, big, "o_orderkey", keep=1)
    return spark.read.table(name).withColumn("month", F.col("month").cast("string"))


@query
def update_partitions_not_in(spark, sf_dir):
    name, base = _published_orders(spark, sf_dir)
    known = table(spark, sf_dir, "lineitem").filter("l_quantity > 10").select(F.col("l_orderkey").alias("o_orderkey"))
    updates.update_partitions(spark, name, base, known, "small", on="o_orderkey", negate=True)
    return spark.read.table(name).withColumn("month", F.col("month").cast("string"))


@query
def publish_swap(spark, sf_dir):
    """A partitioned table made of itself, with other partitions, read by its name and by snapshot."""
    name, base = _in_database(spark, "orders"), staged_path(spark, "orders")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    first = snapshots.publish_swap(orders, name, base, partition_by=["o_orderstatus"])
    later = spark.read.table(name).filter("o_orderstatus <> 'F'").withColumn("rest", F.col("o_custkey") % 3)
    snapshots.publish_swap(later, name, base, partition_by=["rest"], keep=2)
    before = spark.read.table(first).groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    now = spark.read.table(name).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("rest").alias("rest"))
    return before.withColumn("rest", F.lit(None).cast("long")).select(F.lit("before").alias("state"), "*").unionByName(
        now.select(F.lit("now").alias("state"), "*")
    )


@query
def dense_key_append(spark, sf_dir):
    """Keys of two loads: customers in debt, then all."""
    customers = table(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey", "c_acctbal")
    order = ["c_mktsegment", "c_nationkey"]
    first = settle(keys.dense_key(customers.filter("c_acctbal < 0").select(order).distinct(), "segmentid", order))
    return keys.extend_keys(first, customers, "segmentid", order)


@query
def duplicates_incremental(spark, sf_dir):
    """Texts of a second load that are held more than once, here and in the first."""
    name, path = _in_database(spark, "seen"), staged_path(spark, "seen")
    texts = table(spark, sf_dir, "documents")
    ledger.remember(texts.filter("doc_id % 3 <> 0"), "text", name, path, "first", buckets=8)
    return ledger.duplicates_across(texts.filter("doc_id % 3 = 0"), "text", name)


@query
def snapshot_changes(spark, sf_dir):
    """What a later snapshot of documents has more, less, and in other numbers."""
    name, base = _in_database(spark, "documents"), staged_path(spark, "documents")
    source = F.when(F.col("doc_id") % 4 > 0, F.col("source")).alias("source")
    number = table(spark, sf_dir, "documents").select("doc_id", "text", source, "lang")
    old = number.filter("doc_id % 5 <> 0").drop("doc_id")
    first = snapshots.publish_swap(old, name, base, partition_by=["lang"])
    snapshots.publish_swap(number.filter("doc_id % 7 <> 0").drop("doc_id"), name, base, partition_by=["lang"])
    return changes.changes(spark.read.table(first), spark.read.table(name)).select(
        "text", "lang", "source", "before", "after", "change"
    )


@query
def incremental_refresh(spark, sf_dir):
    """Bronze, silver and dimensions of three loads, the last of them copies of earlier records."""
    layers = increment.Layers(spark, staged_path(spark, "layers"), _in_database(spark, "increment").replace(".", "_"), SPEC, buckets=8)
    rows = bronze(spark, sf_dir).select("value.*")
    # Copies of a record lie side by side in bronze; the second of each comes with the last load.
    once = rows.dropDuplicates(["Id"])
    parts = [once.filter("Id % 3 <> 0"), once.filter("Id % 3 = 0"), rows.filter("Id % 10 = 0").dropDuplicates(["Id"])]
    for number, part in enumerate(parts):
        packed = documents.documents_of(settle(part), "movie", ROWS_PER_DOCUMENT, ["Id"], replayable=True)
        layers.run(packed.select("movie"), f"load {number}", "movie", "derived", date(2024, 1, 1 + number // 2))
    named = layers.read("silver").join(
        layers.read("attribute"), F.col(SPEC.attribute) == F.col(SPEC.attribute_key)
    )
    return (
        layers.read("bronze")
        .select(F.lit("bronze").alias("layer"), "value.Id", "status")
        .union(named.select(F.lit("silver"), "Id", SPEC.attribute_name))
        .union(layers.read("tag").select(F.lit("tag"), "id", "name"))
        .union(layers.read("bridge").select(F.lit("bridge"), "movieid", F.col("genreid").cast("string")))
    )


@query
def checks_observed(spark, sf_dir):
    """The end-state checks, counted while the tables are written."""
    rows, state = bronze(spark, sf_dir), checks.ObservedState(SPEC)
    languages = settle(refine.attribute_dimension(rows, SPEC))
    settle(state.watch(refine.silver(rows, languages, SPEC), "silver"))
    settle(state.watch(refine.final_status(rows, SPEC), "bronze"))
    settle(state.watch(refine.tag_dimension(rows, SPEC), "tag"))
    return state.counts(spark)


@query
def json_variant(spark, sf_dir):
    """Orders in files of two layouts: prices as numbers or texts, with and without a note."""
    path = staged_path(spark, "orders")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    orders.filter("o_orderkey % 2 = 0").write.json(path)
    other = orders.filter("o_orderkey % 2 = 1").select(
        "o_orderkey", F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.struct(F.col("o_orderstatus").alias("state")).alias("note"),
    )
    other.write.mode("append").json(path)
    return variants.typed(
        variants.read_variant(spark, path),
        {"o_orderkey": "bigint", "o_totalprice": "double", "o_orderstatus": "string", "state": ("$.note.state", "string")},
    )


@query
def stream_silver(spark, sf_dir):
    """Silver of a landing stream, a load for each of its batches."""
    rows = columns.expand_struct(bronze(spark, sf_dir), "value", keep=False)
    packed = documents.documents_of(rows, "movie", ROWS_PER_DOCUMENT, ["Id"], replayable=True)
    source = staged_path(spark, "landing")
    packed.drop("document").write.json(source)
    layers = increment.Layers(spark, staged_path(spark, "layers"), _in_database(spark, "stream").replace(".", "_"), SPEC, buckets=8)
    stream = landing.stream_landing(
        spark, source, packed.select("movie").schema, name_glob="part-*", multi_line=False
    )
    refresh.refine_available(stream, layers, "movie", "derived", staged_path(spark, "progress")).awaitTermination()
    named = layers.read("silver").join(layers.read("attribute"), F.col(SPEC.attribute) == F.col(SPEC.attribute_key))
    return named.select("Id", "Budget", "RunTime", SPEC.attribute_name, "CreatedDate")
