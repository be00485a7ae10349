"""The queries this library answers, each with the SQL it must agree with.

Every query runs over whole tables. Queries whose operator is a write (copies, restores,
overwrites, jobs) write below the folder that the session names in `spark.checkpoint.dir`.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tablevault as tv
from tablevault.plans.plan import plan_rows, with_due
from tablevault.sources import filesystem
from tablevault.sources.scratch import scratch_path

try:
    import corpus_pipeline
    from tablevault.llm import queries as llm_queries
except ImportError:  # the library is complete without these
    corpus_pipeline = llm_queries = None

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

ORDERS = tv.TableName("shop", "sales", "orders")
LINEITEM = tv.TableName("shop", "sales", "lineitem")
CUSTOMER = tv.TableName("shop", "crm", "customer")


def entry(spark: SparkSession) -> DataFrame:
    """Copy `lineitem` into a vault and verify the copy against its source."""
    return verify_clean(spark, "/root/testdata/sf0.001", "lineitem")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tv.read_files(spark, f"{sf_dir}/{name}.parquet")


def _vault(spark: SparkSession) -> tv.Vault:
    return tv.Vault(spark, scratch_path(spark, "vault"))


# -- sources and sinks -------------------------------------------------------------------


def filter_positive_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return tv.positive_ids(orders.select(F.col("o_orderkey").alias("id"), "o_totalprice"))


def filter_malformed_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    marked = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("x"), key)).otherwise(key)
    orders = _table(spark, sf_dir, "orders")
    return tv.positive_ids(orders.select(marked.alias("id"), "o_totalprice"))


def etl_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "id")
    source, target = scratch_path(spark, "etl-in"), scratch_path(spark, "etl-out")
    tv.write_files(documents, source, "csv")
    tv.run_etl(spark, source, target, schema=documents.schema, dialect="own")
    return tv.read_files(spark, target, "csv", documents.schema)


def _foreign_csv(**options: str) -> Callable[[SparkSession, str], DataFrame]:
    """The job over files that plain Spark wrote, with its escapes and the given line ends."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        documents = _table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "id")
        source, target = scratch_path(spark, "etl-in"), scratch_path(spark, "etl-out")
        documents.write.option("header", "true").options(**options).csv(source)
        tv.run_etl(spark, source, target, schema=documents.schema)
        return tv.read_files(spark, target, "csv", documents.schema)

    return query


def etl_csv_rfc4180(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pages with doubled quotes and line breaks, the header in another order."""
    pages = _table(spark, sf_dir, "pages").withColumnRenamed("page_id", "id")
    source, target = scratch_path(spark, "etl-in"), scratch_path(spark, "etl-out")
    whole = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    pages.select("html", "id", "url").write.options(header="true", escape='"', **whole).csv(source)
    tv.run_etl(spark, source, target, schema=pages.schema, by_name=True, **whole)
    return tv.read_files(spark, target, "csv", pages.schema)


def _quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))


def etl_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of documents, some with a field too many: those are kept whole, elsewhere."""
    documents = _table(spark, sf_dir, "documents")
    source, target = scratch_path(spark, "etl-in"), scratch_path(spark, "etl-out")
    rejects = scratch_path(spark, "etl-rejects")
    record = F.concat_ws(
        ",", F.col("doc_id").cast("string"), _quoted(F.col("text")), F.col("lang"),
        F.when(F.col("doc_id") % 7 == 3, F.lit("one more")),
    )
    documents.select(record).write.text(source)
    result = tv.run_etl(
        spark, source, target, schema="id bigint, text string, lang string", header="false",
        dialect="rfc4180", rejects=rejects,
    )
    kept = tv.read_files(spark, target, "csv", "id bigint, text string, lang string")
    refused = tv.read_files(spark, rejects).select(
        F.regexp_extract("record", r"^(\d+),", 1).cast("bigint").alias("id"),
        F.regexp_extract("record", r",(\w+),one more\s*$", 1).alias("lang"),
    )
    return (
        kept.select("id", F.sha2("text", 256).alias("text_sha256"), "lang")
        .unionByName(refused, allowMissingColumns=True)
        .withColumns(
            {
                "rows_read": F.lit(result.rows_read).cast("bigint"),
                "rows_malformed": F.lit(result.rows_malformed).cast("bigint"),
            }
        )
    )


def etl_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's own counts, on data that is read and written as Parquet."""
    target = scratch_path(spark, "etl-out")
    result = tv.run_etl(
        spark, f"{sf_dir}/lineitem.parquet", target, fmt="parquet", id_col="l_orderkey"
    )
    rows = tv.row_count(tv.read_files(spark, target), "lineitem")
    return rows.select(
        F.lit(result.rows_read).cast("bigint").alias("rows_read"),
        F.lit(result.rows_written).cast("bigint").alias("rows_written"),
        F.col("row_count").alias("rows_found"),
    )


def _roundtrip(name: str, fmt: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _table(spark, sf_dir, name)
        path = scratch_path(spark, f"roundtrip-{fmt}")
        tv.write_files(df, path, fmt)
        return tv.read_files(spark, path, fmt, df.schema)

    return query


def versioned_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, path = _table(spark, sf_dir, "orders"), scratch_path(spark, "versioned")
    tv.write_delta_table(orders, path)
    tv.write_delta_table(tv.positive_ids(orders, "o_orderkey"), path)
    return tv.read_delta_table(spark, path)


def versioned_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, path = _table(spark, sf_dir, "orders"), scratch_path(spark, "versioned")
    tv.write_delta_table(orders, path)
    tv.write_delta_table(_damaged(orders), path)
    return tv.read_delta_table(spark, path, version=1)


def apply_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = tv.create_schema(
        [
            {"name": "event_id", "type": "INTEGER"},
            {"name": "ts", "type": "timestamp"},
            {"name": "user_id", "type": "integer", "nullable": False},
            {"name": "event_type", "type": "string"},
            {"name": "value", "type": "double"},
            {"name": "props", "type": "text"},
        ]
    )
    path = scratch_path(spark, "events")
    tv.write_files(_table(spark, sf_dir, "events"), path, "json")
    events = tv.read_files(spark, path, "json", schema)
    return events.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# -- counts, samples, order --------------------------------------------------------------


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [tv.row_count(_table(spark, sf_dir, name), name) for name in TABLES]
    result = counts[0]
    for count in counts[1:]:
        result = result.union(count)
    return result


def sample_1000(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tv.sample_rows(_table(spark, sf_dir, "lineitem"), 1000)


def sample_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample over the whole table: how large, from where, and all of it rows of the table."""
    lineitem = _table(spark, sf_dir, "lineitem")
    sample = tv.spread_sample(lineitem, 1000)
    orders = lineitem.agg(F.max("l_orderkey").alias("last"))
    tenth = F.floor(F.col("l_orderkey") * 10 / (F.col("last") + 1))
    strange = tv.diff_rows(sample, lineitem).where("_side = 'missing'")
    return (
        sample.join(F.broadcast(orders), F.col("l_orderkey") <= F.col("last"))
        .agg(F.count(F.lit(1)).alias("sample_rows"), F.count_distinct(tenth).alias("tenths"))
        .withColumn("strange_rows", strange.agg(F.count(F.lit(1))).scalar())
    )


def backup_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = _table(spark, sf_dir, "part").select(
        F.lit("shop").alias("catalog"),
        F.col("p_brand").alias("schema"),
        F.col("p_partkey").cast("string").alias("table"),
        F.col("p_size").alias("priority"),
        F.col("p_partkey").alias("ordinal"),
    )
    return tv.ranked(plan).select("table", "priority", "backup_rank")


# -- plan --------------------------------------------------------------------------------


def _frequency(segment: Column) -> Column:
    return (
        F.when(segment == "AUTOMOBILE", "daily")
        .when(segment == "BUILDING", "weekly")
        .when(segment == "FURNITURE", "monthly")
        .when(segment == "HOUSEHOLD", "hourly")
        .otherwise("daily")
    )


_FREQUENCY_SQL = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'daily' WHEN 'BUILDING' THEN 'weekly'
    WHEN 'FURNITURE' THEN 'monthly' WHEN 'HOUSEHOLD' THEN 'hourly' ELSE 'daily' END"""


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration document per customer; fields without a value are left out."""
    entry = F.struct(
        _frequency(F.col("c_mktsegment")).alias("backup_frequency"),
        F.col("c_nationkey").alias("priority"),
        F.when(F.col("c_acctbal") < 0, 14).alias("retention_days"),
        F.struct(
            F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(False)).alias("enabled"),
            F.when(F.col("c_acctbal") > 5000, 500).alias("sample_size"),
        ).alias("verification"),
        F.when(
            F.col("c_mktsegment") == "BUILDING",
            F.struct(F.lit(False).alias("fail_fast")),
        ).alias("error_handling"),
        F.when(
            F.col("c_mktsegment") == "FURNITURE",
            F.struct(
                F.lit("s3").alias("type"),
                F.lit("own").alias("container_name"),
                F.lit("p").alias("path_prefix"),
                F.lit(True).alias("use_external_location"),
            ),
        ).alias("storage"),
    )
    tables = F.create_map("c_name", entry)
    nation = F.create_map(F.col("c_nationkey").cast("string"), F.struct(tables.alias("tables")))
    document = F.struct(
        F.struct(F.lit("backup").alias("catalog"), F.lit("dr").alias("schema")).alias(
            "backup_location"
        ),
        F.struct(
            F.lit("abfss").alias("type"), F.lit("general").alias("container")
        ).alias("storage"),
        F.create_map("c_mktsegment", F.struct(nation.alias("schemas"))).alias("catalogs"),
    )
    return _table(spark, sf_dir, "customer").select("c_custkey", F.to_json(document).alias("doc"))


def load_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_rows(_documents(spark, sf_dir), "doc", "c_custkey").select(
        "ordinal", "catalog", "schema", "table", "backup_frequency", "priority",
        "verify_enabled", "row_count_check", "data_sample_check", "sample_size", "fail_fast",
        "max_retries", "retry_delay_seconds",
        F.coalesce("retention_days", F.lit(0)).alias("retention_days"), "storage_type",
        "container_name", "path_prefix", "use_external_location", "backup_catalog",
        "backup_schema",
    )


def load_plan_catalogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per nation, each with several catalogs, and all tables in document order."""
    customer = _table(spark, sf_dir, "customer")
    settings = F.struct(
        _frequency(F.col("c_mktsegment")).alias("backup_frequency"),
        F.col("c_nationkey").alias("priority"),
    )
    tables = customer.groupBy("c_nationkey", "c_mktsegment").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("c_name", settings)))).alias("tables")
    )
    schemas = F.create_map(F.lit("main"), F.struct("tables"))

    def by_name(a: Column, b: Column) -> Column:
        return F.when(a["c_mktsegment"] < b["c_mktsegment"], -1).otherwise(1)

    catalogs = F.array_agg(F.struct("c_mktsegment", F.struct(schemas.alias("schemas"))))
    documents = tables.groupBy("c_nationkey").agg(catalogs.alias("catalogs")).select(
        (F.col("c_nationkey") * 1_000_000).alias("first"),
        F.to_json(
            F.struct(
                F.lit("backup").alias("backup_catalog"), F.lit("dr").alias("backup_schema"),
                F.map_from_entries(F.array_sort("catalogs", by_name)).alias("catalogs"),
            )
        ).alias("document"),
    )
    return plan_rows(documents, "document", "first").select(
        "ordinal", "catalog", "schema", "table", "backup_frequency", "priority", "verify_enabled",
    )


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as tables to protect."""
    return _table(spark, sf_dir, "customer").select(
        F.lit("shop").alias("catalog"),
        F.lit("crm").alias("schema"),
        F.col("c_custkey").cast("string").alias("table"),
        F.col("c_custkey").alias("ordinal"),
        _frequency(F.col("c_mktsegment")).alias("backup_frequency"),
        F.col("c_nationkey").alias("priority"),
        F.when(F.col("c_acctbal") < 0, 14).alias("retention_days"),
    )


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log of backups: errors are failed ones."""
    return _table(spark, sf_dir, "events").select(
        F.lit("shop").alias("catalog"),
        F.lit("crm").alias("schema"),
        F.col("user_id").cast("string").alias("table"),
        F.lit("backup").alias("operation"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_id").alias("target_version"),
        F.concat(F.lit("/vault/"), F.col("event_id").cast("string")).alias("storage_location"),
    )


def _due(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry, history = _registry(spark, sf_dir), _history(spark, sf_dir)
    due = with_due(registry, history, "2024-01-31 00:00:00")
    return due.withColumn("last_backup", F.col("last_backup").cast("timestamp_ntz"))


def due_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _due(spark, sf_dir).select(
        "table", "backup_frequency", "last_backup", "due", "due_reason"
    )


def due_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry, history = _registry(spark, sf_dir), _history(spark, sf_dir)
    due = tv.due_tables(registry, history, "2024-01-31 00:00:00")
    return tv.ranked(due).select("table", "priority", "backup_frequency", "backup_rank")


def retention_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tv.retention_days(_registry(spark, sf_dir))


def expired_backups(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = tv.expired(
        _history(spark, sf_dir), _registry(spark, sf_dir), "2024-01-31 00:00:00"
    )
    return gone.select("table", "target_version", "status", "age_days", "retention_days")


def storage_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_type")
    plan = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("table"),
        F.when(kind == "STANDARD", "abfss")
        .when(kind == "PROMO", "S3")
        .when(kind == "LARGE", "gcs")
        .when(kind == "SMALL", "ftp")
        .otherwise("ABFSS")
        .alias("storage_type"),
        F.lit("acct").alias("account"),
        F.col("p_brand").alias("container_name"),
        F.when(F.col("p_size") < 40, F.lit("backups")).otherwise(F.lit("")).alias("path_prefix"),
        (F.col("p_size") > 10).alias("use_external_location"),
    )
    return tv.with_location(plan).select("table", "storage_location")


# -- verification ------------------------------------------------------------------------


def _damaged(orders: DataFrame) -> DataFrame:
    """`orders` with one class of rows lost, one changed and one doubled."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    kept = orders.filter((status != "P") | (priority != "1-URGENT")).withColumn(
        "o_totalprice",
        F.when(
            (status == "O") & (priority == "5-LOW"), F.col("o_totalprice") + F.lit(1.0)
        ).otherwise(F.col("o_totalprice")),
    )
    return kept.union(orders.filter((status == "F") & (priority == "2-HIGH")))


_DAMAGED_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW'
                THEN o_totalprice + 1.0::DOUBLE ELSE o_totalprice END AS o_totalprice,
           o_orderdate, o_orderpriority
    FROM orders WHERE o_orderstatus <> 'P' OR o_orderpriority <> '1-URGENT'
    UNION ALL
    SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'
"""


def verify_clean(spark: SparkSession, sf_dir: str, name: str = "orders") -> DataFrame:
    source, vault = _table(spark, sf_dir, name), _vault(spark)
    vault.clone(source, ORDERS)
    return tv.verify(source, vault.read(ORDERS)).select(
        "schema_match", "source_rows", "target_rows", "missing_rows", "extra_rows", "passed"
    )


def _verify_damaged(checks: tv.Checks, *columns: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders, vault = _table(spark, sf_dir, "orders"), _vault(spark)
        vault.clone(_damaged(orders), ORDERS)
        return tv.verify(orders, vault.read(ORDERS), checks).select(*columns)

    return query


def verify_fingerprint_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, vault = _table(spark, sf_dir, "lineitem"), _vault(spark)
    vault.clone(source, LINEITEM)
    checks = tv.Checks(full_diff=False, sample=False, fingerprint=True)
    return tv.verify(source, vault.read(LINEITEM), checks).select(
        "source_rows", "target_rows", "fingerprint_match", "passed"
    )


def diff_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return tv.diff_rows(orders, _damaged(orders))


def diff_rows_in_suspect_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return tv.diff_rows_in_suspect_buckets(orders, _damaged(orders))


def sample_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return tv.sample_diff(orders, _damaged(orders), 1000)


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    statistics = tv.profile(_table(spark, sf_dir, "customer"))
    statistics = statistics.drop("left_out", "checksum")
    return statistics.withColumn("total", F.col("total").cast("double"))


def profile_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubles beyond 1e13, and decimals that differ from others only in the tenth place."""
    lineitem = _table(spark, sf_dir, "lineitem").select(
        (F.col("l_quantity") * 1e13).alias("large"),
        F.expr("CAST(l_orderkey AS DECIMAL(20,10)) + CAST('0.0000000001' AS DECIMAL(20,10))")
        .alias("fine"),
        F.when(F.col("l_linenumber") == 1, F.lit(float("nan")))
        .otherwise(F.col("l_quantity"))
        .alias("gaps"),
    )
    coarse = lineitem.withColumn("fine", F.col("fine").cast("decimal(30,9)").cast("decimal(21,10)"))
    values = tv.profile(lineitem).select(
        "column_name", "non_null", "left_out", F.col("total").cast("double").alias("total")
    )
    return values.join(tv.profile_diff(lineitem, coarse).select("column_name", "equal"), "column_name")


def profile_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return tv.profile_diff(orders, _damaged(orders)).select(
        "column_name", "source_row_count", "target_row_count",
        F.col("source_total").cast("double").alias("source_total"),
        F.col("target_total").cast("double").alias("target_total"),
        "equal",
    )


# -- copies and restores -----------------------------------------------------------------


def clone_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vault, target = _vault(spark), scratch_path(spark, "restored")
    vault.clone(_table(spark, sf_dir, "lineitem"), LINEITEM)
    vault.restore(LINEITEM, target)
    return tv.read_files(spark, target)


def clone_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    vault = _vault(spark)
    vault.clone(
        _table(spark, sf_dir, "lineitem"), LINEITEM,
        partition_by=["l_returnflag", "l_linestatus"],
    )
    return vault.read(LINEITEM)


def clone_if_not_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, vault = _table(spark, sf_dir, "orders"), _vault(spark)
    vault.clone(orders, ORDERS, mode="if_not_exists")
    vault.clone(_damaged(orders), ORDERS, mode="if_not_exists")
    return vault.read(ORDERS)


def restore_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, vault = _table(spark, sf_dir, "orders"), _vault(spark)
    target = scratch_path(spark, "restored")
    vault.clone(_damaged(orders), ORDERS)
    vault.clone(orders, ORDERS)
    vault.restore(ORDERS, target)
    vault.restore(ORDERS, target, version=1, overwrite=True)
    return tv.read_files(spark, target)


def restore_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, vault = _table(spark, sf_dir, "orders"), _vault(spark)
    vault.clone(orders, ORDERS, as_of="2024-01-01 00:00:00")
    vault.clone(_damaged(orders), ORDERS, as_of="2024-02-01 00:00:00")
    target = scratch_path(spark, "restored")
    vault.restore(ORDERS, target, as_of="2024-01-15 00:00:00")
    return tv.read_files(spark, target)


def restore_refuses_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One part of a snapshot is lost, two have changed places, one is added: all are named."""
    lineitem, vault = _table(spark, sf_dir, "lineitem"), _vault(spark)
    kept, target = vault.clone(lineitem, LINEITEM), scratch_path(spark, "restored")
    vault.restore(LINEITEM, target)
    found = vault.clone(lineitem, LINEITEM, partition_by=["l_returnflag"])

    def part(flag: str) -> str:
        return f"{found.path}/l_returnflag={flag}"

    filesystem.rename(spark, part("A"), scratch_path(spark, "lost"))
    aside = scratch_path(spark, "aside")
    for source, place in ((part("N"), aside), (part("R"), part("N")), (aside, part("R"))):
        filesystem.rename(spark, source, place)
    lineitem.drop("l_returnflag").limit(0).coalesce(1).write.parquet(part("X"))
    place = F.substring_index("file", "/", 1)
    lost = (place == "l_returnflag=A") & (F.col("problem") == "missing")
    problems = vault.damage(LINEITEM).agg(
        F.sum("recorded_rows").alias("recorded_rows"),
        F.sum("found_rows").alias("found_rows"),
        F.sum(F.when(lost, F.col("recorded_rows"))).alias("lost_rows"),
        F.bool_or((place == "l_returnflag=X") & (F.col("problem") == "extra")).alias("added"),
    )
    try:
        vault.restore(LINEITEM, target, overwrite=True)
        refused = False
    except RuntimeError:
        refused = True
    live = tv.read_files(spark, target)
    return problems.crossJoin(
        live.agg(F.count(F.lit(1)).alias("live_rows"), F.sum("l_quantity").alias("live_quantity"))
    ).withColumn("refused", F.lit(refused and kept.version == 1))


def restore_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that compares fingerprints, and a restore that relies on them."""
    vault, target = _vault(spark), scratch_path(spark, "restored")
    tv.run_backup(
        vault, _plan_of(spark, "orders"), method="fingerprint",
        source=lambda name: _table(spark, sf_dir, name.table),
    )
    vault.restore(ORDERS, target)
    return tv.read_files(spark, target)


def restore_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A damaged catalog table is replaced by its backup, partition columns included."""
    orders, vault = _table(spark, sf_dir, "orders"), _vault(spark)
    table = f"{vault.create_namespace('live', 'sales')}.`orders_{uuid4().hex}`"
    orders.write.partitionBy("o_orderstatus").saveAsTable(table)
    vault.clone(table, ORDERS)
    _damaged(orders).write.mode("overwrite").partitionBy("o_orderstatus").saveAsTable(table)
    vault.restore_table(ORDERS, table, overwrite=True)
    partitions = tv.describe(spark, table).where("section = 'partition'").select("value")
    rows = spark.table(table).select("*", F.lit(partitions.first()[0]).alias("partitioned_by"))
    return stored_rows(rows, table)


def stored_rows(rows: DataFrame, table: str) -> DataFrame:
    """`rows` on their own, and the table they were read from dropped."""
    path = scratch_path(rows.sparkSession, "rows")
    tv.write_files(rows, path)
    rows.sparkSession.sql(f"DROP TABLE {table}")
    return tv.read_files(rows.sparkSession, path)


def registered_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over a registered backup, the older version first, then the newer."""
    orders, vault = _table(spark, sf_dir, "orders"), _vault(spark)
    table = f"{vault.create_namespace('backup', 'dr')}.`orders_{uuid4().hex}`"
    vault.clone(_damaged(orders), ORDERS)
    vault.clone(orders, ORDERS)
    found = []
    for version in (1, 2):
        vault.register(ORDERS, table, version)
        totals = spark.sql(
            f"SELECT {version}L AS version, o_orderpriority, count(*) AS orders FROM {table} GROUP BY ALL"
        )
        path = scratch_path(spark, "rows")
        tv.write_files(totals, path)
        found.append(tv.read_files(spark, path))
    spark.sql(f"DROP TABLE {table}")
    return found[0].unionByName(found[1])


def deep_clone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clone under full names does nothing the second time."""
    vault, orders = _vault(spark), _table(spark, sf_dir, "orders")
    for source in (orders, _damaged(orders)):
        tv.deep_clone(
            vault, source_catalog="shop", source_schema="sales", source_table="orders",
            target_catalog="backup", target_schema="dr", target_table="orders", source=source,
        )
    return vault.read(tv.TableName("backup", "dr", "orders"))


def created_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When a table was made, beside what it holds."""
    vault, start = _vault(spark), datetime.now(timezone.utc).replace(microsecond=0)
    table = f"{vault.create_namespace('live', 'sales')}.`customer_{uuid4().hex}`"
    _table(spark, sf_dir, "customer").write.saveAsTable(table)
    made = tv.created_time(spark, table)
    recent = start <= made <= datetime.now(timezone.utc)
    rows = spark.table(table).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))
    return stored_rows(rows.withColumn("made_now", F.lit(recent)), table)


def list_backups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions left after a clean-up: the old one of `orders` goes, newest ones stay."""
    vault = _vault(spark)
    orders, customer = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "customer")
    vault.clone(orders, ORDERS, as_of="2024-01-01 00:00:00")
    vault.clone(customer, CUSTOMER, as_of="2024-01-01 00:00:00")
    vault.clone(_damaged(orders), ORDERS, as_of="2024-01-10 00:00:00")
    tv.cleanup(vault, _registry(spark, sf_dir), as_of="2024-01-20 00:00:00")
    return vault.versions().select("catalog", "schema", "table", "target_version", "row_count")


def leftovers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a killed copy and a killed restore left behind, and the data once it is removed."""
    orders, vault = _table(spark, sf_dir, "orders"), _vault(spark)
    target, later = scratch_path(spark, "restored"), datetime(2100, 1, 1, tzinfo=timezone.utc)
    vault.clone(orders, ORDERS)
    vault.copy(_damaged(orders), ORDERS)  # written, but the run ended before it was published
    vault.restore(ORDERS, target)
    tv.write_files(_damaged(orders), f"{target}.restored-{uuid4().hex}")
    found = vault.leftovers(as_of=later).groupBy("kind").agg(F.count(F.lit(1)).alias("folders"))
    found = spark.createDataFrame(found.collect(), found.schema)  # before they go
    vault.remove_leftovers(as_of=later)
    left = vault.leftovers(as_of=later).agg(F.count(F.lit(1)).alias("left"))
    rows = tv.row_count(vault.read(ORDERS), "orders").select("row_count")
    return found.withColumns({"left_after": left.scalar(), "row_count": rows.scalar()})


def _plan_of(spark: SparkSession, *tables: str) -> DataFrame:
    """A plan of daily backups of tables in shop.sales, in order."""
    return spark.createDataFrame(
        [(i, name, 1) for i, name in enumerate(tables)],
        "ordinal bigint, table string, priority int",
    ).select(
        "*",
        F.lit("shop").alias("catalog"), F.lit("sales").alias("schema"),
        F.lit("daily").alias("backup_frequency"), F.lit(True).alias("verify_enabled"),
        F.lit(True).alias("row_count_check"), F.lit(True).alias("data_sample_check"),
        F.lit(1000).alias("sample_size"), F.lit(False).alias("fail_fast"),
        F.lit("backup").alias("backup_catalog"), F.lit("dr").alias("backup_schema"),
        F.lit(False).alias("use_external_location"),
        *[
            F.lit(None).cast("string").alias(c)
            for c in ("storage_type", "account", "container_name", "path_prefix")
        ],
    )


def backup_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over tables in the plan; one has no data and must not stop the others."""
    vault, plan = _vault(spark), _plan_of(spark, "orders", "customer", "lineitem", "absent")
    log = tv.run_backup(vault, plan, source=lambda name: _table(spark, sf_dir, name.table))
    return log.where("operation = 'backup'").select(
        "table", F.coalesce("row_count", F.lit(0)).alias("row_count"), "status",
        "verification_status", F.coalesce("target_version", F.lit(0)).alias("target_version"),
    )


def backup_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four tables at once, and what was published of each."""
    vault, names = _vault(spark), ("orders", "customer", "lineitem", "part")
    tv.run_backup(
        vault, _plan_of(spark, *names), side_by_side=4, method="fingerprint",
        source=lambda name: _table(spark, sf_dir, name.table),
    )
    return vault.versions().select("table", "target_version", "row_count", "verification_status")


def file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    vault = _vault(spark)
    vault.clone(
        _table(spark, sf_dir, "orders"), ORDERS, partition_by=["o_orderpriority"],
    )
    row = vault.versions().select(
        "row_count", "partition_info",
        (F.col("file_count") > 0).alias("has_files"),
        (F.col("total_size_bytes") > 0).alias("has_bytes"),
        F.col("last_modified").isNotNull().alias("has_time"),
    )
    info = F.from_json("partition_info", "columns array<string>, partitions bigint")
    return row.select(
        "row_count", info["columns"][0].alias("partitioned_by"),
        info["partitions"].alias("partitions"), "has_files", "has_bytes", "has_time",
    )


def describe_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of a table as the catalog describes them, with their number of values."""
    vault = _vault(spark)
    vault.clone(_table(spark, sf_dir, "orders"), ORDERS)
    namespace = vault.create_namespace("backup", "dr")
    table = f"{namespace}.`{vault.root.rsplit('/', 1)[-1].replace('-', '_')}`"
    vault.register(ORDERS, table)
    columns = tv.describe(spark, table).filter("section = 'column'")
    values = tv.profile(vault.read(ORDERS)).select("column_name", "non_null")
    spark.sql(f"DROP TABLE {table}")
    return columns.join(values, F.col("key") == F.col("column_name")).select(
        "section", "key", "value", "non_null"
    )


_REPORT = ["source_rows", "target_rows", "missing_rows", "extra_rows", "passed"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    extra = {}
    if llm_queries:
        extra = llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return extra | {
        "filter_positive_id": filter_positive_id,
        "filter_malformed_id": filter_malformed_id,
        "etl_csv": etl_csv,
        "etl_csv_foreign": _foreign_csv(),
        "etl_csv_crlf": _foreign_csv(lineSep="\r\n"),
        "etl_csv_rfc4180": etl_csv_rfc4180,
        "etl_csv_rejects": etl_csv_rejects,
        "etl_counts": etl_counts,
        "roundtrip_parquet": _roundtrip("lineitem", "parquet"),
        "roundtrip_orc": _roundtrip("orders", "orc"),
        "roundtrip_json": _roundtrip("conversations", "json"),
        "roundtrip_csv": _roundtrip("pages", "csv"),
        "versioned_overwrite": versioned_overwrite,
        "versioned_history": versioned_history,
        "apply_schema": apply_schema,
        "row_counts": row_counts,
        "sample_1000": sample_1000,
        "sample_spread": sample_spread,
        "backup_order": backup_order,
        "load_plan": load_plan,
        "load_plan_catalogs": load_plan_catalogs,
        "due_check": due_check,
        "due_tables": due_tables,
        "retention_days": retention_days,
        "expired_backups": expired_backups,
        "storage_location": storage_location,
        "verify_clean": verify_clean,
        "verify_damaged": _verify_damaged(tv.Checks(), *_REPORT),
        "verify_sample": _verify_damaged(tv.Checks(full_diff=False), *_REPORT),
        "verify_spread_sample": _verify_damaged(
            tv.Checks(full_diff=False, sample_method="spread"),
            "source_rows", "target_rows", "passed",
        ),
        "verify_fingerprint": _verify_damaged(
            tv.Checks(full_diff=False, sample=False, fingerprint=True),
            "source_rows", "target_rows", "fingerprint_match", "passed",
        ),
        "verify_fingerprint_clean": verify_fingerprint_clean,
        "verify_profile": _verify_damaged(
            tv.Checks(full_diff=False, sample=False, profile=True),
            "source_rows", "target_rows", "profile_match", "passed",
        ),
        "diff_rows": diff_rows,
        "diff_rows_in_suspect_buckets": diff_rows_in_suspect_buckets,
        "sample_diff": sample_diff,
        "profile": profile,
        "profile_extremes": profile_extremes,
        "profile_diff": profile_diff,
        "clone_restore": clone_restore,
        "clone_partitioned": clone_partitioned,
        "clone_if_not_exists": clone_if_not_exists,
        "restore_version": restore_version,
        "restore_as_of": restore_as_of,
        "restore_refuses_changed": restore_refuses_changed,
        "restore_fingerprint": restore_fingerprint,
        "restore_table": restore_table,
        "registered_backup": registered_backup,
        "deep_clone": deep_clone,
        "created_time": created_time,
        "list_backups": list_backups,
        "backup_audit": backup_audit,
        "backup_side_by_side": backup_side_by_side,
        "leftovers": leftovers,
        "file_stats": file_stats,
        "describe_columns": describe_columns,
    }


def oracle_sql() -> dict[str, str]:
    extra = llm_queries.oracle_sql() if llm_queries else {}
    due = f"""
        WITH plan AS (
            SELECT CAST(c_custkey AS VARCHAR) AS "table", c_custkey AS ordinal,
                   {_FREQUENCY_SQL} AS backup_frequency, c_nationkey AS priority
            FROM customer
        ), last AS (
            SELECT CAST(user_id AS VARCHAR) AS "table", max(ts) AS last_backup
            FROM events WHERE event_type <> 'error' GROUP BY ALL
        ), joined AS (
            SELECT plan.*, last_backup,
                   floor(epoch(TIMESTAMP '2024-01-31' - last_backup) / 86400) AS days
            FROM plan LEFT JOIN last USING ("table")
        ), reasoned AS (
            SELECT *, CASE
                WHEN last_backup IS NULL THEN 'never backed up'
                WHEN backup_frequency NOT IN ('daily', 'weekly', 'monthly')
                    THEN 'unknown frequency'
                WHEN days >= CASE backup_frequency WHEN 'daily' THEN 1 WHEN 'weekly' THEN 7
                    ELSE 30 END THEN 'interval elapsed'
                ELSE 'not yet' END AS due_reason
            FROM joined
        )"""
    diff = f"""
        WITH damaged AS ({_DAMAGED_SQL}),
        missing AS (SELECT * FROM orders EXCEPT ALL SELECT * FROM damaged),
        extra AS (SELECT * FROM damaged EXCEPT ALL SELECT * FROM orders)"""
    samples = f"""
        WITH damaged AS ({_DAMAGED_SQL}),
        a AS (SELECT * FROM orders ORDER BY ALL LIMIT 1000),
        b AS (SELECT * FROM damaged ORDER BY ALL LIMIT 1000),
        missing AS (SELECT * FROM a EXCEPT ALL SELECT * FROM b),
        extra AS (SELECT * FROM b EXCEPT ALL SELECT * FROM a)"""
    diff_result = """
        SELECT 'missing' AS _side, count(*) AS _copies, * FROM missing GROUP BY ALL
        UNION ALL
        SELECT 'extra' AS _side, count(*) AS _copies, * FROM extra GROUP BY ALL"""
    report = """
        SELECT (SELECT count(*) FROM orders) AS source_rows,
               (SELECT count(*) FROM damaged) AS target_rows,
               (SELECT count(*) FROM missing) AS missing_rows,
               (SELECT count(*) FROM extra) AS extra_rows, false AS passed"""
    counts = f"""
        WITH damaged AS ({_DAMAGED_SQL})
        SELECT (SELECT count(*) FROM orders) AS source_rows,
               (SELECT count(*) FROM damaged) AS target_rows"""

    def profile_of(table: str, columns: dict[str, bool]) -> str:
        return " UNION ALL ".join(
            f"""SELECT '{name}' AS column_name, count(*) AS row_count, count({name}) AS non_null,
            {f'sum(CAST({name} AS DECIMAL(38,6)))' if number else 'NULL::DECIMAL(38,6)'} AS total
            FROM {table}"""
            for name, number in columns.items()
        )

    customer_columns = {
        "c_custkey": True, "c_name": False, "c_nationkey": True, "c_acctbal": True,
        "c_mktsegment": False,
    }
    orders_columns = {
        "o_orderkey": True, "o_custkey": True, "o_orderstatus": False, "o_totalprice": True,
        "o_orderdate": False, "o_orderpriority": False,
    }
    orders_types = {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
        "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
    }
    return extra | {
        "filter_positive_id": (
            "SELECT o_orderkey AS id, o_totalprice FROM orders WHERE o_orderkey > 0"
        ),
        "filter_malformed_id": """
            SELECT * FROM (
                SELECT CASE WHEN o_orderstatus = 'P' THEN 'x' || CAST(o_orderkey AS VARCHAR)
                       ELSE CAST(o_orderkey AS VARCHAR) END AS id, o_totalprice
                FROM orders
            ) WHERE TRY_CAST(id AS BIGINT) > 0""",
        **dict.fromkeys(
            ("etl_csv", "etl_csv_foreign", "etl_csv_crlf"),
            "SELECT doc_id AS id, text, lang, source, n_chars FROM documents WHERE doc_id > 0",
        ),
        "etl_csv_rfc4180": "SELECT page_id AS id, url, html FROM pages WHERE page_id > 0",
        "etl_csv_rejects": """
            WITH counts AS (
                SELECT count(*) AS rows_read, count(*) FILTER (doc_id % 7 = 3) AS rows_malformed
                FROM documents
            )
            SELECT doc_id AS id, CASE WHEN doc_id % 7 <> 3 THEN sha256(text) END AS text_sha256,
                   lang, rows_read, rows_malformed
            FROM documents, counts WHERE doc_id > 0""",
        "etl_counts": """
            SELECT count(*) AS rows_read, count(*) FILTER (l_orderkey > 0) AS rows_written,
                   count(*) FILTER (l_orderkey > 0) AS rows_found FROM lineitem""",
        "roundtrip_parquet": "SELECT * FROM lineitem",
        "roundtrip_orc": "SELECT * FROM orders",
        "roundtrip_json": "SELECT * FROM conversations",
        "roundtrip_csv": "SELECT * FROM pages",
        "versioned_overwrite": "SELECT * FROM orders WHERE o_orderkey > 0",
        "versioned_history": "SELECT * FROM orders",
        "apply_schema": """
            SELECT CAST(event_id AS INTEGER) AS event_id, ts, CAST(user_id AS INTEGER) AS user_id,
                   event_type, value, props FROM events""",
        "row_counts": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in TABLES
        ),
        "sample_1000": "SELECT * FROM lineitem ORDER BY ALL LIMIT 1000",
        "sample_spread": """
            SELECT least(count(*), 1000) AS sample_rows, 10::BIGINT AS tenths,
                   0::BIGINT AS strange_rows FROM lineitem""",
        "backup_order": """
            SELECT CAST(p_partkey AS VARCHAR) AS "table", p_size AS priority,
                   row_number() OVER (ORDER BY p_size DESC, p_partkey) AS backup_rank
            FROM part""",
        "load_plan": f"""
            SELECT c_custkey AS ordinal, c_mktsegment AS catalog,
                   CAST(c_nationkey AS VARCHAR) AS "schema", c_name AS "table",
                   {_FREQUENCY_SQL} AS backup_frequency, c_nationkey AS priority,
                   c_mktsegment <> 'MACHINERY' AS verify_enabled, true AS row_count_check,
                   true AS data_sample_check,
                   CASE WHEN c_acctbal > 5000 THEN 500 ELSE 1000 END AS sample_size,
                   c_mktsegment <> 'BUILDING' AS fail_fast, 3 AS max_retries,
                   60 AS retry_delay_seconds,
                   CASE WHEN c_acctbal < 0 THEN 14 ELSE 0 END AS retention_days,
                   CASE WHEN c_mktsegment = 'FURNITURE' THEN 's3' ELSE 'abfss' END AS storage_type,
                   CASE WHEN c_mktsegment = 'FURNITURE' THEN 'own' ELSE 'general' END
                       AS container_name,
                   CASE WHEN c_mktsegment = 'FURNITURE' THEN 'p' END AS path_prefix,
                   c_mktsegment = 'FURNITURE' AS use_external_location,
                   'backup' AS backup_catalog, 'dr' AS backup_schema
            FROM customer""",
        "load_plan_catalogs": f"""
            SELECT c_nationkey * 1000000 - 1 + row_number() OVER (
                       PARTITION BY c_nationkey ORDER BY c_mktsegment, c_name) AS ordinal,
                   c_mktsegment AS catalog, 'main' AS "schema", c_name AS "table",
                   {_FREQUENCY_SQL} AS backup_frequency, c_nationkey AS priority,
                   true AS verify_enabled FROM customer""",
        "due_check": due + """
            SELECT "table", backup_frequency, last_backup,
                   due_reason IN ('never backed up', 'interval elapsed') AS due, due_reason
            FROM reasoned""",
        "due_tables": due + """
            SELECT "table", priority, backup_frequency,
                   row_number() OVER (ORDER BY priority DESC, ordinal) AS backup_rank
            FROM reasoned WHERE due_reason IN ('never backed up', 'interval elapsed')""",
        "retention_days": f"""
            SELECT least(30, min(CASE {_FREQUENCY_SQL} WHEN 'daily' THEN 7 WHEN 'weekly' THEN 30
                   WHEN 'monthly' THEN 90 END)) AS retention_days FROM customer""",
        "expired_backups": """
            WITH newest AS (
                SELECT user_id, max(event_id) AS newest FROM events
                WHERE event_type <> 'error' GROUP BY user_id
            ), aged AS (
                SELECT CAST(e.user_id AS VARCHAR) AS "table", event_id AS target_version,
                       CASE event_type WHEN 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
                       CAST(floor(epoch(TIMESTAMP '2024-01-31' - ts) / 86400) AS BIGINT)
                           AS age_days,
                       CASE WHEN c_acctbal < 0 THEN 14 ELSE 7 END AS retention_days
                FROM events e LEFT JOIN newest n ON e.user_id = n.user_id
                LEFT JOIN customer c ON c.c_custkey = e.user_id
                WHERE event_type = 'error' OR event_id < newest
            )
            SELECT * FROM aged WHERE age_days > retention_days""",
        "storage_location": """
            SELECT CAST(p_partkey AS VARCHAR) AS "table",
                   CASE WHEN p_size > 10 THEN CASE
                       WHEN p_type IN ('STANDARD', 'MEDIUM', 'ECONOMY')
                           THEN 'abfss://' || p_brand || '@acct.dfs.core.windows.net/' || tail
                       WHEN p_type = 'PROMO' THEN 's3://' || p_brand || '/' || tail
                       WHEN p_type = 'LARGE' THEN 'gs://' || p_brand || '/' || tail
                   END END AS storage_location
            FROM (SELECT *, CASE WHEN p_size < 40 THEN 'backups/' ELSE '' END
                         || CAST(p_partkey AS VARCHAR) AS tail FROM part)""",
        "verify_clean": """
            SELECT true AS schema_match, count(*) AS source_rows, count(*) AS target_rows,
                   0::BIGINT AS missing_rows, 0::BIGINT AS extra_rows, true AS passed
            FROM orders""",
        "verify_damaged": diff + report,
        "verify_sample": samples + report,
        "verify_spread_sample": counts + ", false AS passed",
        "verify_fingerprint": counts + ", false AS fingerprint_match, false AS passed",
        "verify_fingerprint_clean": """
            SELECT count(*) AS source_rows, count(*) AS target_rows, true AS fingerprint_match,
                   true AS passed FROM lineitem""",
        "verify_profile": counts + ", false AS profile_match, false AS passed",
        "diff_rows": diff + diff_result,
        "diff_rows_in_suspect_buckets": diff + diff_result,
        "sample_diff": samples + diff_result,
        "profile_extremes": """
            SELECT 'large' AS column_name, count(*) AS non_null, 0 AS left_out,
                   CAST(sum(CAST(l_quantity AS DECIMAL(18,0))) * 10000000000000 AS DOUBLE) AS total,
                   true AS equal FROM lineitem
            UNION ALL
            SELECT 'fine', count(*), 0, CAST(round(CAST(sum(l_orderkey) AS DECIMAL(30,10))
                   + count(*) * CAST('0.0000000001' AS DECIMAL(30,10)), 6) AS DOUBLE), false
            FROM lineitem
            UNION ALL
            SELECT 'gaps', count(*), count(*) FILTER (l_linenumber = 1),
                   CAST(sum(CAST(l_quantity AS DECIMAL(18,0))) FILTER (l_linenumber <> 1) AS DOUBLE),
                   true FROM lineitem""",
        "profile": f"""
            SELECT * REPLACE (CAST(total AS DOUBLE) AS total),
                   CAST(total AS DOUBLE) / non_null AS average
            FROM ({profile_of("customer", customer_columns)})""",
        "profile_diff": f"""
            WITH damaged AS ({_DAMAGED_SQL}),
            s AS ({profile_of("orders", orders_columns)}),
            t AS ({profile_of("damaged", orders_columns)})
            SELECT column_name, s.row_count AS source_row_count, t.row_count AS target_row_count,
                   CAST(s.total AS DOUBLE) AS source_total,
                   CAST(t.total AS DOUBLE) AS target_total,
                   s.row_count = t.row_count AND s.non_null = t.non_null
                       AND s.total IS NOT DISTINCT FROM t.total AS equal
            FROM s JOIN t USING (column_name)""",
        "clone_restore": "SELECT * FROM lineitem",
        "clone_partitioned": "SELECT * FROM lineitem",
        "clone_if_not_exists": "SELECT * FROM orders",
        "restore_version": _DAMAGED_SQL,
        "restore_as_of": "SELECT * FROM orders",
        "restore_refuses_changed": """
            SELECT count(*) AS recorded_rows, count(*) FILTER (l_returnflag <> 'A') AS found_rows,
                   count(*) FILTER (l_returnflag = 'A') AS lost_rows, true AS added,
                   count(*) AS live_rows, sum(l_quantity) AS live_quantity, true AS refused
            FROM lineitem""",
        "restore_fingerprint": "SELECT * FROM orders",
        "restore_table": "SELECT *, 'o_orderstatus' AS partitioned_by FROM orders",
        "registered_backup": f"""
            SELECT 1::BIGINT AS version, o_orderpriority, count(*) AS orders
            FROM ({_DAMAGED_SQL}) GROUP BY ALL
            UNION ALL
            SELECT 2, o_orderpriority, count(*) FROM orders GROUP BY ALL""",
        "deep_clone": "SELECT * FROM orders",
        "created_time": """
            SELECT c_mktsegment, count(*) AS customers, true AS made_now
            FROM customer GROUP BY c_mktsegment""",
        "list_backups": f"""
            SELECT 'shop' AS catalog, 'sales' AS "schema", 'orders' AS "table",
                   2::BIGINT AS target_version, count(*) AS row_count FROM ({_DAMAGED_SQL})
            UNION ALL
            SELECT 'shop', 'crm', 'customer', 1::BIGINT, count(*) FROM customer""",
        "backup_audit": " UNION ALL ".join(
            f"""SELECT '{name}' AS "table", count(*) AS row_count, 'SUCCESS' AS status,
            'PASSED' AS verification_status, 1::BIGINT AS target_version FROM {name}"""
            for name in ("orders", "customer", "lineitem")
        ) + " UNION ALL SELECT 'absent', 0, 'FAILED', 'SKIPPED', 0",
        "backup_side_by_side": " UNION ALL ".join(
            f"""SELECT '{name}' AS "table", 1::BIGINT AS target_version, count(*) AS row_count,
            'PASSED' AS verification_status FROM {name}"""
            for name in ("orders", "customer", "lineitem", "part")
        ),
        "leftovers": " UNION ALL ".join(
            f"""SELECT '{kind}' AS kind, 1::BIGINT AS folders, 0::BIGINT AS left_after,
            count(*) AS row_count FROM orders"""
            for kind in ("copy", "manifest", "restore")
        ),
        "file_stats": """
            SELECT count(*) AS row_count, 'o_orderpriority' AS partitioned_by,
                   count(DISTINCT o_orderpriority) AS partitions, true AS has_files,
                   true AS has_bytes, true AS has_time FROM orders""",
        "describe_columns": " UNION ALL ".join(
            f"""SELECT 'column' AS section, '{name}' AS key, '{kind}' AS value,
            count({name}) AS non_null FROM orders"""
            for name, kind in orders_types.items()
        ),
    }
