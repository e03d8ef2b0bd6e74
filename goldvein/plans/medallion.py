"""The full run: landing files -> bronze -> silver -> gold -> reporting view."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from goldvein.functions.amounts import date_key, month_key
from goldvein.operators.dates import date_dimension_of
from goldvein.operators.measures import Star
from goldvein.operators.upsert import LoadResult, upsert_table
from goldvein.plans import gold, reports, silver
from goldvein.sources import feeds
from goldvein.sources.lookups import rates_lookup, region_lookup
from goldvein.streaming import landing
from goldvein.sources.tables import (
    Table,
    Zone,
    append_table,
    create_zone,
    overwrite_table,
    partition_values_of,
    publish_view,
    read_table,
    replace_partitions,
    save_table,
    table_exists,
)


#: the month the fact is partitioned by, beside its own columns, and the calendar's
FACT_MONTH, DAY_MONTH = "date_month", "month_key"
#: what cleaned order lines are partitioned by
ITEM_MONTH, ITEM_DAY = "order_month", "order_day"


@dataclass(frozen=True)
class Lakehouse:
    """The three zones, where files land and where rejects go."""

    root: str
    bronze_name: str = "01_bronze"
    silver_name: str = "02_silver"
    gold_name: str = "03_gold"

    def _zone(self, name: str) -> Zone:
        return Zone(name, f"{self.root.rstrip('/')}/{name}")

    @property
    def bronze(self) -> Zone:
        return self._zone(self.bronze_name)

    @property
    def silver(self) -> Zone:
        return self._zone(self.silver_name)

    @property
    def gold(self) -> Zone:
        return self._zone(self.gold_name)

    @property
    def landing(self) -> str:
        return f"{self.root.rstrip('/')}/landing"

    @property
    def ledgers(self) -> str:
        return f"{self.root.rstrip('/')}/ledgers"

    @property
    def rejects(self) -> str:
        return f"{self.root.rstrip('/')}/rejects"

    @property
    def refined(self) -> Table:
        """Which loads of which raw table have been refined."""
        return self.bronze.table("refined_loads")

    @property
    def products(self) -> Table:
        return self.gold.table("dim_ecommerce_products")

    @property
    def customers(self) -> Table:
        return self.gold.table("dim_ecommerce_customers")

    @property
    def dates(self) -> Table:
        return self.gold.table("dim_date")

    @property
    def fact(self) -> Table:
        return self.gold.table("fact_ecommerce_order_items")

    @property
    def view(self) -> Table:
        return self.gold.table("v_fact_ecommerce_transaction_all_data")


@dataclass(frozen=True)
class Settings:
    """What a run leaves open; the defaults are the behaviour to match.

    ``item_keys`` are the key columns of order lines; ``types``, ``not_kept`` and
    ``thousands`` go to their cleaning, ``strict`` makes a lossy cast an error.
    ``item_partition`` is ``month`` or ``day``: what a late line makes a load rewrite.
    ``blank_keys_are_null`` rejects rows whose text keys are blank; off, all blank keys
    of a feed are one row.
    """

    direction: str = "multiply"
    coupon_when_empty: int = 1
    exact_discount: bool = False
    types: Mapping[str, str] | None = None
    not_kept: Mapping[str, str] | None = None
    thousands: tuple[str, ...] = ()
    strict: bool = False
    item_keys: tuple[str, ...] = silver.ORDER_ITEMS.keys
    item_partition: str = "month"
    blank_keys_are_null: bool = True


DEFAULTS = Settings()

FEED_TABLES = (
    (feeds.BRANDS, silver.BRANDS),
    (feeds.PRODUCTS, silver.PRODUCTS),
    (feeds.CATEGORIES, silver.CATEGORIES),
    (feeds.CUSTOMERS, silver.CUSTOMERS),
    (feeds.ORDER_ITEMS, silver.ORDER_ITEMS),
)


def set_up(spark: SparkSession, house: Lakehouse) -> None:
    for zone in (house.bronze, house.silver, house.gold):
        create_zone(spark, zone)


def ingest(spark: SparkSession, house: Lakehouse, batch_time: datetime) -> None:
    """Landing files to bronze, as they are, with provenance."""
    for feed in feeds.FEEDS:
        raw = feeds.scan_feed(spark, house.landing, feed, F.lit(batch_time))
        save_table(raw, house.bronze.table(feed.name))


def ingest_new(spark: SparkSession, house: Lakehouse, batch_time: datetime) -> dict[str, landing.Landed]:
    """Only the files that have landed since the last run, each feed by its own ledger."""
    return {
        feed.name: landing.ingest_new(
            spark,
            house.landing,
            feed,
            house.bronze.table(feed.name),
            f"{house.ledgers}/{feed.name}",
            house.rejects,
            batch_time,
        )
        for feed in feeds.FEEDS
    }


def pending_loads(spark: SparkSession, house: Lakehouse, feed: feeds.Feed) -> tuple[int, ...]:
    """Loads of a raw table that no run has refined to the end, from an earlier run or this one."""
    table = house.bronze.table(feed.name)
    if not table_exists(spark, table):
        return ()
    have = {v[0] for v in partition_values_of(spark, table)}
    if table_exists(spark, house.refined):
        done = read_table(spark, house.refined).where(F.col("feed") == feed.name).select("load")
        have -= {r["load"] for r in done.collect()}
    return tuple(sorted(have))


def _mark_refined(
    spark: SparkSession, house: Lakehouse, loads: Mapping[str, tuple[int, ...]], batch_time: datetime
) -> None:
    rows = [(name, load, batch_time) for name, numbers in loads.items() for load in numbers]
    if not rows:
        return
    marks = spark.createDataFrame(rows, "feed string, load long, refined_at timestamp")
    if table_exists(spark, house.refined):
        append_table(marks, house.refined)
    else:
        overwrite_table(marks, house.refined)


def _cleaned(
    table: silver.SilverTable, raw: DataFrame, settings: Settings
) -> tuple[DataFrame, Observation | None]:
    """A cleaned feed, and where its casts count what they lose."""
    if table is silver.BRANDS:
        return silver.clean_brands(raw), None
    if table is silver.CATEGORIES:
        return silver.clean_categories(raw), None
    if table is silver.CUSTOMERS:
        return silver.clean_customers(raw), None
    lost = Observation()
    if table is silver.PRODUCTS:
        return silver.clean_products(raw, lost, settings.strict), lost
    lines = silver.clean_order_items(
        raw,
        types=dict(settings.types or {}),
        not_kept=dict(settings.not_kept or {}),
        thousands=settings.thousands,
        lost=lost,
        strict=settings.strict,
    )
    return lines, lost


def refine(
    spark: SparkSession,
    house: Lakehouse,
    batch_time: datetime,
    settings: Settings = DEFAULTS,
    loads: Mapping[str, tuple[int, ...]] | None = None,
) -> dict[str, LoadResult]:
    """Bronze to silver: clean, deduplicate, upsert.

    ``loads`` limits each feed to some loads of its raw table; a feed without one is
    left out of the results.
    """
    results = {}
    for feed, table in FEED_TABLES:
        if loads is not None and not loads.get(feed.name):
            continue
        raw = landing.loaded(spark, house.bronze.table(feed.name), loads and loads[feed.name])
        batch, lost = _cleaned(table, raw, settings)
        partition_by: dict[str, Column] = {}
        if table.month_of:
            partition_by[ITEM_MONTH] = month_key(F.col(table.month_of))
            if settings.item_partition == "day":
                partition_by[ITEM_DAY] = date_key(F.col(table.month_of))
        results[table.name] = upsert_table(
            batch,
            house.silver.table(table.name),
            settings.item_keys if table is silver.ORDER_ITEMS else table.keys,
            rejects_root=house.rejects,
            batch_time=batch_time,
            tie_breakers=table.tie_breakers,
            partition_by=partition_by,
            blank_keys_are_null=settings.blank_keys_are_null,
            lost_in_casts=lost,
        )
    return results


def publish(
    spark: SparkSession,
    house: Lakehouse,
    rates: Mapping[str, float] | DataFrame,
    settings: Settings = DEFAULTS,
    months: Collection[int] | None = None,
) -> None:
    """Silver to gold: dimensions, fact by month, calendar and the wide view.

    ``months`` limits the fact to the months that a load has touched; the others keep
    their files.  Publish all of them (None) when the rates have changed.
    """

    def cleaned(table: silver.SilverTable) -> DataFrame:
        return read_table(spark, house.silver.table(table.name))

    products = gold.product_dimension(
        cleaned(silver.PRODUCTS), cleaned(silver.BRANDS), cleaned(silver.CATEGORIES)
    )
    save_table(products, house.products)
    customers = gold.customer_dimension(cleaned(silver.CUSTOMERS), region_lookup(spark))
    save_table(customers, house.customers)

    items = cleaned(silver.ORDER_ITEMS)
    calendar = date_dimension_of(items, "dt").withColumn(DAY_MONTH, month_key(F.col("date")))
    save_table(calendar, house.dates)
    if months is not None and not table_exists(spark, house.fact):
        months = None
    chosen = items
    if months is not None:
        named = F.col(ITEM_MONTH).isin([m for m in months if m is not None])
        chosen = items.where(named | F.col(ITEM_MONTH).isNull() if None in months else named)
    fact = gold.order_line_fact(
        chosen,
        rates_lookup(spark, rates),
        direction=settings.direction,
        coupon_when_empty=settings.coupon_when_empty,
        exact_discount=settings.exact_discount,
    )
    by_month = fact.withColumn(FACT_MONTH, month_key(F.col("transaction_date")))
    # the cleaned lines lie by month already, so no shuffle is needed to write them so
    if months is None:
        save_table(by_month, house.fact, partition_by=[FACT_MONTH], gather=False)
    elif months:
        replace_partitions(by_month, house.fact, [(m,) for m in months], gather=False)
    reports.reconcile(items, read_table(spark, house.fact))
    view = gold.wide_view_sql(house.fact, house.products, house.dates, FACT_MONTH, DAY_MONTH)
    publish_view(spark, house.view, view)


def star(spark: SparkSession, house: Lakehouse) -> Star:
    """The published tables, ready for the reports."""
    return reports.sales_star(
        read_table(spark, house.fact),
        reports.products_of(read_table(spark, house.products)),
        reports.dates_of(read_table(spark, house.dates), FACT_MONTH),
    )


def run(
    spark: SparkSession,
    house: Lakehouse,
    rates: Mapping[str, float] | DataFrame,
    batch_time: datetime,
    settings: Settings = DEFAULTS,
    incremental: bool = False,
    new_files: bool = False,
) -> dict[str, LoadResult]:
    """One complete batch; running it again with the same files changes nothing.

    ``incremental`` publishes only the fact months that the load has touched; it is
    for batches between which the rates stay the same.  ``new_files`` reads only files
    that have landed since the last run and refines only their rows.  A load counts as
    done when it is published, so a run that breaks off is made good by the next one:
    an upsert of the same rows changes nothing and names the same months.
    """
    set_up(spark, house)
    loads = None
    if new_files:
        ingest_new(spark, house, batch_time)
        loads = {feed.name: pending_loads(spark, house, feed) for feed in feeds.FEEDS}
    else:
        ingest(spark, house, batch_time)
    results = refine(spark, house, batch_time, settings, loads)
    lines = results.get(silver.ORDER_ITEMS.name)
    months = None
    if incremental and (lines is None or lines.touched is not None):
        months = {values[0] for values in lines.touched} if lines else set()
    publish(spark, house, rates, settings, months)
    if loads:
        _mark_refined(spark, house, loads, batch_time)
    return results
