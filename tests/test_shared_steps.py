"""Weekly costs without a shuffled row per week; joined lines that several readers need are joined once."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tavola.plans import cost, loads, menu
from tavola.sources.mart import Mart

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["weekly_base_cost_year", "weekly_base_cost_by_store"])
def test_weeks_are_expanded_after_the_last_shuffle(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert 0 <= plan.index("explode(sequence(") < plan.index("Exchange")
    assert plan.count("explode(sequence(") == 1


def test_store_sums_of_every_week(spark):
    m = Mart(spark, SF)
    keys = ["week_index", "year", "period", "week", "store_id"]
    want = (cost.weekly_base_cost_all(m).groupBy(*keys)
            .agg(F.count("*").alias("items"), F.sum(F.col("base_cost").cast("decimal(18,4)")).cast("double").alias("base_cost")))
    got = cost.weekly_base_cost_by_store(m)
    assert got.columns == want.columns and got.count() > 0
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def facts(spark, rows):
    return spark.createDataFrame(rows, "id long, itemid long, week_index int, date string, transactionid long, lineid int, amount double, "
                                       "quantity double, item string, base_uofm string, base_cost double")


def test_pieces_fall_back_to_the_first_count(spark):
    def row(item, week, price):
        return (1, item, week, f"w{week}", week, 1, 1.0, 1.0, "i", "Each", price)
    bought = facts(spark, [row(1, 3, 2.0), row(1, 5, 0.0), row(2, 4, 0.0), row(4, 2, None)])
    counted = facts(spark, [row(1, 1, 7.0), row(2, 6, 8.0), row(2, 7, 9.0), row(3, 2, 5.0)])
    got = {(r.item_id, r.from_week, r.to_week, r.base_cost) for r in cost._cost_pieces(bought, counted, 9).collect()}
    assert got == {(1, 1, 2, 7.0), (1, 3, 4, 2.0), (1, 5, 9, 7.0), (2, 4, 5, 0.0), (2, 6, 9, 8.0), (3, 2, 9, 5.0), (4, 2, 9, None)}


@pytest.mark.parametrize("name", ["feed_transaction_detail", "weekly_cost_table", "receiving_location", "receiving_vendor", "menu_report_by_quantity"])
def test_lines_are_joined_once(spark, name):
    if name == "menu_report_by_quantity":
        m = Mart(spark, SF)
        df = menu.menu_rating_totals(m, menu.specialty_items(m))
    else:
        df = E.queries()[name](spark, SF)
    assert not [f for f in df.inputFiles() if "lineitem" in f]


def test_two_weeks_at_once(spark):
    m = Mart(spark, SF)
    both = cost.weekly_item_base_cost(m, 2000, 6, 2, weeks=2)
    apart = cost.weekly_item_base_cost(m, 2000, 6, 2).unionByName(cost.weekly_item_base_cost(m, 2000, 6, 1))
    assert both.count() > 0 and both.exceptAll(apart).isEmpty() and apart.exceptAll(both).isEmpty()
    assert {r.week_index for r in loads.weekly_cost_table(m, 2000, 6, 2).select("week_index").distinct().collect()} == {280, 281}


def test_menu_rows_are_written_before_they_are_rated(spark):
    m = Mart(spark, SF)
    rated = menu.menu_rating(m, menu.specialty_items(m))
    assert not [f for f in rated.inputFiles() if "lineitem" in f]  # the means do not total the lines again
    assert rated.count() > 0
    numbered = menu.menu_report(m, menu.specialty_items(m))
    assert "LogicalRDD" not in numbered._jdf.queryExecution().optimizedPlan().toString()  # compressed table, no checkpoint
