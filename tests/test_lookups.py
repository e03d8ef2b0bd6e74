import pytest
from pyspark.sql import functions as F

from goldvein.plans import gold
from goldvein.sources import lookups


def test_regions(spark):
    rows = lookups.region_rows()
    assert len(rows) == 64 and len({(c, s) for c, s, _ in rows}) == 64
    assert len({c for c, _, _ in rows}) == 7


def test_state_code_needs_its_country(frame, spark):
    people = frame(
        [("1", "p", "IN", "India", "SK"), ("2", "p", "CA", "Canada", "SK"),
         ("3", "p", "CA", "Canada", "MH"), ("4", "p", "XX", None, None)],
        "customer_id string, phone string, country_code string, country string, state string",
    ).withColumns({"date_creation": F.current_timestamp(), "date_modification": F.lit(None)})
    dim = gold.customer_dimension(people.withColumn("more", F.lit(1)),
                                  lookups.region_lookup(spark))
    assert dim.columns == [*gold.CUSTOMER_FIRST, "more"]
    got = {r.customer_id: r.region for r in dim.collect()}
    assert got == {"1": "Northeast", "2": "West", "3": "Other", "4": "Other"}


def test_rates_mapping_with_overrides(spark):
    got = {r[0]: r[1] for r in lookups.rates_lookup(spark, {"USD": 1, "AED": 9.9}).collect()}
    assert got == {"USD": 1.0, "EUR": 1.0, "AED": 4.34}


def test_rates_table(frame, spark):
    table = frame([("USD", 1.1), ("EUR", 7.0)], "unit_price_currency string, rate_eur double")
    got = {r[0]: r[1] for r in lookups.rates_lookup(spark, table).collect()}
    assert got == {"USD": 1.1, "EUR": 1.0, "AED": 4.34}
    assert lookups.rates_lookup(spark, table, {}).count() == 2


def test_a_currency_quoted_twice_is_an_error(frame, spark):
    table = frame([("USD", 1.1), ("USD", 1.2)], "unit_price_currency string, rate_eur double")
    with pytest.raises(Exception, match="more than one rate"):
        lookups.rates_lookup(spark, table).collect()


def test_large_local_lookup_gets_no_hint(spark, monkeypatch):
    monkeypatch.setattr(lookups, "MAX_LOOKUP_ROWS", 10)
    plan = lookups.region_lookup(spark)._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" not in plan and "UnresolvedHint" not in plan
