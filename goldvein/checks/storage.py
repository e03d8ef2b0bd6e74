"""Queries that go through files and tables in the session's shared folder."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from goldvein.checks import dedup as dedup_checks
from goldvein.checks import standin as s
from goldvein.checks import upsert as upsert_checks
from goldvein.checks.registry import checked
from goldvein.operators import dedup, upsert
from goldvein.plans import medallion, silver
from goldvein.plans.silver import ORDER_ITEMS
from goldvein.session import scratch_path
from goldvein.sources import feeds, quarantine
from goldvein.sources.rejects import read_rejects, write_rejects
from goldvein.sources.tables import (
    Zone,
    create_zone,
    list_zones,
    publish_view,
    read_table,
    save_table,
)
from goldvein.streaming import landing

BATCH_TIME = datetime(2024, 1, 2, 7)


def _zone(spark: SparkSession) -> Zone:
    root = scratch_path(spark, "zone")
    zone = Zone(f"check_{uuid.uuid4().hex[:12]}", root)
    create_zone(spark, zone)
    return zone


@checked(f"""
SELECT customer_id, phone || '.0' AS phone, country_code, country, state,
  'csv' AS file_kind, TIMESTAMP '2024-01-02 07:00:00' AS _ingested_at
FROM ({s.CUSTOMERS_SQL}) AS c""")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV written and scanned back by schema, with provenance."""
    root = scratch_path(spark, "landing")
    s.raw_customers(spark, sf_dir).write.csv(f"{root}/{feeds.CUSTOMERS.folder}", header=True)
    scanned = feeds.scan_feed(spark, root, feeds.CUSTOMERS, F.lit(BATCH_TIME))
    kind = F.element_at(F.split("_source_file", r"\."), -1)
    return s.without_zone(scanned.withColumn("file_kind", kind).drop("_source_file"))


@checked("""
SELECT * REPLACE (CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority)
FROM orders""")
def table_append_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite, then append rows that bring one more column."""
    orders = s.given(spark, sf_dir, "orders")
    table = _zone(spark).table("orders")
    closed = orders.where("o_orderstatus = 'F'").drop("o_orderpriority")
    save_table(closed, table)
    save_table(orders.where("o_orderstatus <> 'F'"), table, mode="append")
    return s.without_zone(read_table(spark, table))


@checked("""
SELECT l_orderkey, l_partkey, l_linenumber, 'duplicate_key' AS _reject_reason
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey
        ORDER BY l_shipdate DESC, l_linenumber, l_suppkey, l_quantity, l_extendedprice,
          l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem) AS r
WHERE rn > 1""")
def rejects_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates written with their reason, twice as by a repeated run, and read back."""
    lineitem = s.given(spark, sf_dir, "lineitem")
    losers = dedup.duplicate_rows(lineitem, dedup_checks.KEYS, "l_shipdate", ["l_linenumber"])
    root = scratch_path(spark, "rejects")
    for _ in range(2):
        folder = write_rejects(losers, root, "lineitem", BATCH_TIME, "duplicate_key")
    return read_rejects(spark, folder).select("l_orderkey", "l_partkey", "l_linenumber", "_reject_reason")


def _upserted(spark: SparkSession, sf_dir: str, partition_by: tuple[str, ...]) -> DataFrame:
    table = _zone(spark).table("orders")
    options = {
        "rejects_root": scratch_path(spark, "rejects"),
        "partition_by": partition_by,
    }
    keys = (*upsert_checks.KEYS, *partition_by)
    month = F.date_format("o_orderdate", "yyyyMM").cast("int")

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("order_month", month)

    first = upsert_checks.target(spark, sf_dir).drop("date_modification")
    day_one = keyed(first.withColumnRenamed("date_creation", "_ingested_at"))
    first_time = datetime.fromisoformat(upsert_checks.FIRST)
    upsert.upsert_table(day_one, table, keys, batch_time=first_time, **options)
    day_two = keyed(upsert_checks.batch(spark, sf_dir))
    second_time = datetime.fromisoformat(upsert_checks.NOW)
    for _ in range(2):
        upsert.upsert_table(day_two, table, keys, batch_time=second_time, **options)
    return s.without_zone(read_table(spark, table)).drop("order_month")


_UPSERTED = f"SELECT * EXCLUDE (_change) FROM ({upsert_checks._MERGED}) AS m"


@checked(_UPSERTED)
def upsert_table_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create, load, load the next day, load it again; then read the table."""
    return _upserted(spark, sf_dir, ())


@checked(_UPSERTED)
def upsert_table_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same into a table by month, of which only the touched months are rewritten."""
    return _upserted(spark, sf_dir, ("order_month",))


@checked("""
SELECT o_orderkey, CAST((o_orderkey + CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END) % 7 AS INTEGER)
    AS shelf, o_totalprice,
  CASE WHEN o_orderstatus = 'O' THEN 'insert' WHEN o_orderstatus = 'F' THEN 'kept' ELSE 'moved' END AS came
FROM orders""")
def upsert_table_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that change their partition in a second load: one row a key, in the new partition."""
    orders = s.given(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")

    def on_shelf(df: DataFrame, plus: int, day: str) -> DataFrame:
        shelf = ((F.col("o_orderkey") + plus) % 7).cast("int")
        return df.withColumns({"shelf": shelf, "_ingested_at": F.lit(day).cast("timestamp")})

    table = _zone(spark).table("shelves")
    options = {"rejects_root": scratch_path(spark, "rejects"), "partition_by": ["shelf"]}
    days = (
        (on_shelf(orders.where("o_orderstatus <> 'O'"), 0, upsert_checks.FIRST), upsert_checks.FIRST),
        (on_shelf(orders.where("o_orderstatus <> 'F'"), 1, upsert_checks.SECOND), upsert_checks.NOW),
    )
    for batch, time in days:
        upsert.upsert_table(batch, table, ["o_orderkey"], batch_time=datetime.fromisoformat(time), **options)
    first = F.col("date_creation") == F.lit(upsert_checks.FIRST).cast("timestamp")
    kept = F.col("date_modification") == F.lit(upsert_checks.FIRST).cast("timestamp")
    came = F.when(~first, "insert").when(kept, "kept").otherwise("moved")
    return read_table(spark, table).select("o_orderkey", "shelf", "o_totalprice", came.alias("came"))


@checked("""
SELECT count(*) FILTER (o_custkey % 10 <> 0) AS n_customers,
  count(*) FILTER (o_custkey % 10 = 0) AS n_null_key FROM (SELECT DISTINCT o_custkey FROM orders)""")
def blank_key_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank text keys are turned away; the same batch twice leaves the same rejects."""
    orders = s.given(spark, sf_dir, "orders").select("o_custkey").distinct()
    code = F.when(F.col("o_custkey") % 10 == 0, F.lit("  ")).otherwise(F.col("o_custkey").cast("string"))
    batch = orders.select(code.alias("code"), "o_custkey", F.lit(upsert_checks.FIRST).cast("timestamp").alias("_ingested_at"))
    table, root = _zone(spark).table("codes"), scratch_path(spark, "rejects")
    for _ in range(2):
        done = upsert.upsert_table(batch, table, ["code"], rejects_root=root, batch_time=BATCH_TIME)
    rejected = read_rejects(spark, done.rejects_folder).where("_reject_reason = 'null_key'")
    counts = read_table(spark, table).select(F.lit("n_customers").alias("k")).unionByName(
        rejected.select(F.lit("n_null_key").alias("k"))
    )
    return counts.agg(*[F.count_if(F.col("k") == k).alias(k) for k in ("n_customers", "n_null_key")])


@checked("""
SELECT * FROM (VALUES ('quantity'), ('unit_price')) c(column_name), LATERAL (
  SELECT CAST(CASE column_name WHEN 'quantity' THEN count(*) FILTER (l_linenumber = 7)
    ELSE count(*) FILTER (l_extendedprice >= 1000) END AS BIGINT) AS lost FROM lineitem)""")
def load_cast_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the casts of a load lose, counted while its batch is written."""
    price = F.floor("l_extendedprice").cast("long")
    grouped = F.when(price >= 1000, F.concat(F.lit("$"), F.format_number(price, 0))).otherwise(price.cast("string"))
    raw = s.given(spark, sf_dir, "lineitem").select(
        F.lit("2024-01-02").alias("dt"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("item_seq"),
        F.when(F.col("l_linenumber") == 7, "many").otherwise("1").alias("quantity"),
        grouped.alias("unit_price"),
        F.lit(BATCH_TIME).alias("_ingested_at"),
    )
    lost = Observation()
    batch = silver.clean_order_items(raw, lost=lost)
    done = upsert.upsert_table(
        batch, _zone(spark).table("lines"), ["order_id", "item_seq"], rejects_root=scratch_path(spark, "rejects"), batch_time=BATCH_TIME, lost_in_casts=lost,
    )
    rows = [(c, done.lost_in_casts[c]) for c in ("quantity", "unit_price")]
    return spark.createDataFrame(rows, "column_name string, lost long")


@checked("""
SELECT o_orderpriority, count(*) AS n_orders FROM orders GROUP BY o_orderpriority""")
def view_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = _zone(spark)
    table, view = zone.table("orders"), zone.table("v_priorities")
    save_table(s.given(spark, sf_dir, "orders"), table)
    publish_view(
        spark,
        view,
        f"SELECT o_orderpriority, count(*) AS n_orders FROM {table.sql_name}"
        " GROUP BY o_orderpriority",
    )
    return read_table(spark, view)


_KEPT_ITEMS = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(ORDER_ITEMS.keys)}
    ORDER BY item_seq, order_ts, quantity, unit_price_currency, unit_price, discount_pct,
      tax_amount, channel, coupon_code) AS rn
  FROM ({s.ITEMS_SQL}) AS i) AS r
WHERE rn = 1"""


@checked(f"""
SELECT category_name, brand_name, year, month_name, CAST(sum(net_amount) AS BIGINT) AS total_sales,
  CAST(sum(gross_amount) AS BIGINT) AS total_gross,
  CAST(sum(net_amount_eur) AS BIGINT) AS total_sales_eur, count(*) AS n_lines
FROM ({s.wide_sql(_KEPT_ITEMS)}) AS w GROUP BY category_name, brand_name, year, month_name""")
def medallion_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV files through all three layers, reported from the published view."""
    run = uuid.uuid4().hex[:12]
    house = medallion.Lakehouse(
        scratch_path(spark, "house"), f"bronze_{run}", f"silver_{run}", f"gold_{run}"
    )
    raw = {
        feeds.BRANDS: s.raw_brands,
        feeds.PRODUCTS: s.raw_products,
        feeds.CATEGORIES: s.raw_categories,
        feeds.CUSTOMERS: s.raw_customers,
        feeds.ORDER_ITEMS: s.raw_order_items,
    }
    for feed, build in raw.items():
        build(spark, sf_dir).write.csv(f"{house.landing}/{feed.folder}", header=True)
    medallion.run(spark, house, s.RATES, BATCH_TIME)
    return (
        read_table(spark, house.view)
        .groupBy("category_name", "brand_name", "year", "month_name")
        .agg(
            F.sum("net_amount").alias("total_sales"),
            F.sum("gross_amount").alias("total_gross"),
            F.sum("net_amount_eur").alias("total_sales_eur"),
            F.count("*").alias("n_lines"),
        )
    )


@checked(f"""
SELECT c.customer_id, c.phone || '.0' AS phone, c.state,
  CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS BIGINT) AS load,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'day_two.csv' ELSE 'day_one.csv' END AS file_day,
  CASE WHEN c_mktsegment = 'BUILDING' THEN TIMESTAMP '2024-01-03 07:00:00' ELSE TIMESTAMP '2024-01-02 07:00:00' END AS _ingested_at
FROM ({s.CUSTOMERS_SQL}) AS c JOIN customer ON CAST(c_custkey AS VARCHAR) = customer_id""")
def landing_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of files and a run on each, then a run without a new file: each file is read once."""
    root, zone = scratch_path(spark, "house"), _zone(spark)
    table, feed = zone.table("customers"), feeds.CUSTOMERS
    segment = s.given(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"), "c_mktsegment"
    )
    raw = s.raw_customers(spark, sf_dir).join(segment, "customer_id")
    second = F.col("c_mktsegment") == "BUILDING"
    days = (("day_one", raw.where(~second)), ("day_two", raw.where(second)), (None, None))
    for n, (day, rows) in enumerate(days):
        if day:
            rows.drop("c_mktsegment").write.csv(f"{root}/landing/{feed.folder}/{day}.csv", header=True)
        landing.ingest_new(
            spark, f"{root}/landing", feed, table, f"{root}/ledger", f"{root}/rejects", BATCH_TIME + timedelta(days=n)
        )
    day_of_file = F.element_at(F.split("_source_file", "/"), -2)
    rows = read_table(spark, table).select(
        "customer_id", "phone", "state", F.col(landing.LOAD).alias("load"), day_of_file.alias("file_day"), "_ingested_at"
    )
    return s.without_zone(rows)


_PARTS_TEXT = "CAST(p_partkey AS VARCHAR) || ',SKU-' || CAST(p_partkey AS VARCHAR) || ',,' || upper(p_brand) || ',red,M,wood,250g,1,2,3'"


@checked(f"""
SELECT CASE WHEN p_size > 3 THEN p_partkey END AS product_id,
  CASE WHEN p_size > 3 THEN CAST(p_size AS INTEGER) END AS rating_count,
  CASE p_size WHEN 1 THEN 'too_few_columns' WHEN 2 THEN 'too_many_columns' WHEN 3 THEN 'wrong_type' END AS reason,
  CASE p_size WHEN 1 THEN {_PARTS_TEXT} WHEN 2 THEN {_PARTS_TEXT} || ',2,more' WHEN 3 THEN {_PARTS_TEXT} || ',three' END AS record,
  CASE WHEN p_size <= 3 THEN 'txt' END AS file_kind
FROM part""")
def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product lines of which the smallest parts' are short, long or hold a wrong type."""
    part = s.given(spark, sf_dir, "part")
    size = F.col("p_size")
    end = F.when(size == 1, "").when(size == 2, ",2,more").when(size == 3, ",three").otherwise(F.concat(F.lit(","), size.cast("string")))
    text = F.concat(F.expr(_PARTS_TEXT.replace("VARCHAR", "STRING")), end)
    root = scratch_path(spark, "landing")
    part.select(text.alias("value")).write.text(root)
    found = quarantine.sorted_out(
        quarantine.scan_csv(spark, root, feeds.PRODUCTS.schema, header=False).withColumn("_source_file", F.col("_metadata.file_path"))
    )
    kind = F.element_at(F.split("_source_file", r"\."), -1)
    none = F.lit(None)
    sound = found.sound.select("product_id", "rating_count", *[none.cast("string").alias(c) for c in ("reason", "record", "file_kind")])
    broken = found.broken.select(
        none.cast("long").alias("product_id"), none.cast("int").alias("rating_count"), F.col(quarantine.REASON).alias("reason"),
        F.col(quarantine.RECORD).alias("record"), kind.alias("file_kind"),
    )
    return sound.unionByName(broken)


@checked("SELECT lower(replace(r_name, ' ', '_')) AS zone FROM region")
def zones_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone for each region, found again in the list of zones."""
    run, root = uuid.uuid4().hex[:12], scratch_path(spark, "zones")
    for r in s.given(spark, sf_dir, "region").collect():
        name = r["r_name"].lower().replace(" ", "_")
        create_zone(spark, Zone(f"zone_{run}_{name}", f"{root}/{name}"))
    own = list_zones(spark).where(F.col("namespace").startswith(f"zone_{run}_"))
    return own.select(F.expr(f"substr(namespace, {len(f'zone_{run}_') + 1})").alias("zone"))


@checked("""
SELECT count(*) FILTER (o_orderstatus = 'O') AS inserted,
  count(*) FILTER (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') AS updated,
  count(*) FILTER (o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT') AS unchanged,
  false AS has_rejects FROM orders""")
def load_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load says it did, counted while it writes."""
    table, rejects = _zone(spark).table("orders"), scratch_path(spark, "rejects")
    first = upsert_checks.target(spark, sf_dir).drop("date_modification").withColumnRenamed("date_creation", "_ingested_at")
    upsert.upsert_table(first, table, upsert_checks.KEYS, rejects_root=rejects, batch_time=datetime.fromisoformat(upsert_checks.FIRST))
    done = upsert.upsert_table(
        upsert_checks.batch(spark, sf_dir), table, upsert_checks.KEYS, rejects_root=rejects, batch_time=datetime.fromisoformat(upsert_checks.NOW)
    )
    rows = [(done.inserted, done.updated, done.unchanged, done.rejects_folder is not None)]
    return spark.createDataFrame(rows, "inserted long, updated long, unchanged long, has_rejects boolean")


@checked("""
SELECT 'customer' AS source, true AS refused, count(*) AS n_rows FROM customer
UNION ALL SELECT 'lineitem', true, count(*) FROM lineitem
UNION ALL SELECT 'orders', false, count(*) FROM orders""")
def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that lack a key or their load time are refused before anything is written."""
    told = []
    for name in ("customer", "lineitem", "orders"):
        batch = s.given(spark, sf_dir, name).withColumn("_ingested_at", F.lit(BATCH_TIME))
        batch = batch.drop("_ingested_at") if name == "lineitem" else batch.withColumnRenamed("l_orderkey", "o_orderkey")
        try:
            upsert.require_columns(batch, [*upsert_checks.KEYS, "_ingested_at"])
            refused = False
        except ValueError:
            refused = True
        counted = batch.agg(F.count("*").alias("n_rows"))
        told.append(counted.select(F.lit(name).alias("source"), F.lit(refused).alias("refused"), "n_rows"))
    return told[0].unionByName(told[1]).unionByName(told[2])
