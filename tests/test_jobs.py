"""Literal-row cases of jobs whose behaviour the shared oracle could hide."""

import datetime as dt

import pytest

from tavola.operators.aggregates import pivot_margins
from tavola.operators.filters import affix_filter, drop_returns
from tavola.operators.windows import first_in_group
from tavola.plans import reports, sales


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_first_in_group_with_shared_columns(spark):
    df = spark.createDataFrame([("a", 2, "LB"), ("a", 1, "Each"), ("b", 5, None)], "item string, ord int, unit string")
    assert rows(first_in_group(df, ["item"], ["ord", "unit"], ["unit", "ord"]), "item", "ord", "unit_first", "ord_first") == [
        ("a", 1, "Each", 1), ("a", 2, "Each", 1), ("b", 5, None, 5)]


def test_returns_are_dropped_and_missing_quantities_kept(spark):
    df = spark.createDataFrame([("(1,000.00)",), ("5.00",), (None,)], "q string")
    assert rows(drop_returns(df, "q"), "q") == [("5.00",), (None,)]


def test_margin_row(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("y", 4.0), (None, 8.0)], "store string, amount double")
    assert rows(pivot_margins(df, "store", "amount"), "store", "amount") == [("Total", 15.0), ("x", 3.0), ("y", 4.0), (None, 8.0)]


def test_prep_items_are_replaced_by_their_ingredients(spark):
    ri = spark.createDataFrame(
        [("Casual", "Soup", "PREP Soup", "PREP Stock", 2.0, "OZ-fl"), ("Casual", "Soup", "PREP Soup", "Salt", 1.0, "OZ-wt"),
         ("Casual", "PREP Soup", "PREP Soup", "Bones", 3.0, "OZ-wt"), ("Casual", "PREP Soup", "PREP Soup", "Water", 9.0, "OZ-fl")],
        "concept string, menu_item string, recipe string, ingredient string, qty double, uofm string")
    assert rows(sales.prep_mapping(ri), "prep_ingredient", "actual_ingredient") == [("PREP Stock", "Bones"), ("PREP Stock", "Water")]


def test_notes_are_no_items(spark):
    df = spark.createDataFrame([("No Salt",), ("Nut Allergy",), ("Sauce for Steak",), ("Nougat",), ("Seat 4",), (None,)], "name string")
    assert rows(affix_filter(df, "name", reports.NOTE_PREFIXES, reports.NOTE_SUFFIXES, negate=True), "name") == [("Nougat",), (None,)]


def test_daily_sales_lines_without_item_are_skipped(spark):
    days = spark.createDataFrame(
        [([{"salesDetails": [{"posItem": {"id": "1", "name": "Casual - Pie"}, "menuItemCategory1": None},
                             {"posItem": None, "menuItemCategory1": "Food"}]}, {"salesDetails": []}],)],
        "salesTickets array<struct<salesDetails: array<struct<posItem: struct<id: string, name: string>, menuItemCategory1: string, "
        "menuItemCategory2: string, menuItemCategory3: string>>>>")
    assert rows(reports.explode_daily_sales(days), "name", "category1") == [("Casual - Pie", None)]


def test_holiday_years(spark):
    from tavola.operators import merge
    from pyspark.sql import functions as F
    table = spark.createDataFrame([(1, dt.date(1999, 1, 1)), (2, dt.date(2000, 1, 1)), (3, None)], "k int, d date")
    batch = spark.createDataFrame([(9, dt.date(2000, 7, 4)), (8, None)], "k int, d date")
    assert rows(merge.replace_partitions(table, batch, F.year("d")), "k") == [(1,), (3,), (8,), (9,)]


@pytest.fixture(scope="module")
def mart(spark):
    from tavola.sources.mart import Mart
    return Mart(spark, "/root/testdata/sf0.001")


def test_uncategorised_items_stay_in_menu_engineering(mart):
    from tavola.plans import menu
    out = menu.menu_engineering(mart, "2001-08-01", 2001, 8)
    assert out.filter("category1 = 'None' AND category2 = 'None'").count() == mart.product_mix.filter("cat1 IS NULL").count() > 0


def test_cheapest_price_keeps_its_own_unit(spark, mart):
    from tavola.plans import cost, recipes
    prices = {}
    for r in cost.latest_item_price(mart).collect():
        key = (r.base_cost is None, r.base_cost or 0.0, r.base_uofm)
        prices[r.itemid] = min(prices.get(r.itemid, key), key)
    got = recipes.menu_cost_converted(mart).select("item_id", "base_uofm").distinct().collect()
    assert got and all(prices[r.item_id][2] == r.base_uofm for r in got)


def test_longest_known_prefix_is_stripped(spark):
    from tavola.plans.records import flatten_menu, strip_known_prefix
    df = spark.createDataFrame([("Hot Dog Bun",), ("Hot Dog",), ("Hotel Soap",), (None,), ("Dog Hot",)], "name string")
    known = spark.createDataFrame([("Hot",), ("Hot Dog",), ("",)], "p string")
    assert rows(strip_known_prefix(df, "name", known, "b"), "name", "b") == sorted(
        [("Hot Dog Bun", "Bun"), ("Hot Dog", "Dog"), ("Hotel Soap", "Hotel Soap"), (None, None), ("Dog Hot", "Dog Hot")], key=str)
    deep = '{"name": "A", "menuItems": [{"name": "x"}], "menuGroups": [{"name": "B", "menuGroups": [{"name": "C", "menuItems": [{"name": "y"}]}]}]}'
    got = flatten_menu(spark.createDataFrame([(1, deep)], "menu_id long, node string"))
    assert rows(got, "path", "item") == [("A > B > C", "y"), ("A", "x")]
