"""Item cost jobs: latest purchase price and weekly base cost (DOM-05, DOM-06).

The original computes the weekly cost store by store and week by week in a
driver loop. Here one plan covers every store and every week of the
requested years: purchases are reduced to the newest one per (store, item,
week) and turned into validity spans; the stock-count fallback (the first
count of an item in a store) is valid from its week on; both meet in windows
over (store, item). Only the finished spans are expanded into weeks, in
place, so no row per week is ever shuffled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tavola.functions.numeric import nullif_div, unit_cost
from tavola.operators.calendar import FISCAL_NAMES, fiscal_columns, fiscal_week_index
from tavola.operators.windows import top_per_group
from tavola.sources.mart import FISCAL_EPOCH, Mart

# Item categories priced from purchases.
COSTED_CATEGORIES = ("Food", "LBW")

NEWEST = ["date", "transactionid", "lineid", "amount", "quantity"]


def latest_item_price(mart: Mart) -> DataFrame:
    """DOM-05 (``ingredient_cost``): newest purchase line per store and item,
    in base units. The ``quantity <> 0`` filter applies *after* the newest
    line is picked, and the unit join is inner, as in the original; a zero
    base quantity gives a null cost instead of a division error."""
    p = mart.purchases
    newest = top_per_group(p, ["id", "item"], NEWEST, descending=True)
    return (newest.filter(F.col("quantity") != 0)
                  .filter(F.col("base_uofm").isNotNull())
                  .select("date", "id", "store", "itemid", "item", "quantity", "uofm", "amount",
                          "base_uofm", "base_qty",
                          F.round(nullif_div(F.col("amount") / F.col("quantity"), F.col("base_qty")), 4)
                          .alias("base_cost")))


def _costed_purchases(mart: Mart) -> DataFrame:
    return (mart.purchases_of(pos_stores=True).filter(F.col("category1").isin(*COSTED_CATEGORIES))
                .withColumn("base_cost", unit_cost("amount", "quantity", "base_qty")))


def _stock_counts(mart: Mart) -> DataFrame:
    return (mart.stock_count("Stock Count", pos_stores=True)
                .withColumn("base_cost", unit_cost("amount", "quantity", "base_qty")))


def _fiscal(weeks: DataFrame) -> DataFrame:
    """Fiscal attributes follow from the week index: its last day is day 7."""
    last_day = F.date_add(F.to_date(F.lit(FISCAL_EPOCH)), F.col("week_index") * 7 + 6)
    fiscal = [c for c, n in zip(fiscal_columns(last_day, FISCAL_EPOCH), FISCAL_NAMES)
              if n in ("year", "period", "week", "period_index")]
    return weeks.select("*", *fiscal)


def _finish(merged: DataFrame) -> DataFrame:
    return (_fiscal(merged.filter(F.col("base_uofm").isNotNull()))
                  .select("week_index", F.col("id").alias("store_id"), "item",
                          F.col("itemid").alias("item_id"), "date", "year", "period", "week",
                          "period_index", "base_uofm", F.round("base_cost", 4).alias("base_cost")))


def _pieces_between(mart: Mart, first: int, last: int) -> DataFrame:
    """The cost pieces of the weeks ``first`` to ``last``. Rows after the
    last week are filtered at the scan; what is older than the first week counts
    as of the first week, so only the newest of it is shuffled on."""
    end = dt.date.fromisoformat(FISCAL_EPOCH) + dt.timedelta(days=last * 7 + 6)
    known = F.col("date") <= F.lit(end)
    week = F.greatest("week_index", F.lit(first))
    return _cost_pieces(_costed_purchases(mart).filter(known).withColumn("week_index", week),
                        _stock_counts(mart).filter(known).withColumn("week_index", week), last)


def _week_bounds(mart: Mart) -> tuple[int, int]:
    """The first and the last fiscal week of the data (none without data)."""
    bounds = mart.calendar.agg(F.min("week_index"), F.max("week_index")).first()
    return (0, -1) if bounds[0] is None else (int(bounds[0]), int(bounds[1]))


def weekly_item_base_cost(mart: Mart, year: int, period: int, week: int, weeks: int = 1) -> DataFrame:
    """DOM-06 for one fiscal week (JN-13), or ``weeks`` of them up to it: newest
    costed purchase up to the week's last day; when its cost is 0 or the item
    was never bought, the store's oldest stock count up to that day."""
    # The week's last day is a literal that reaches the parquet scan as a filter.
    if not (1 <= period <= 13 and 1 <= week <= 4):
        raise ValueError(f"no fiscal week {year}/{period}/{week}")
    wk = fiscal_week_index(FISCAL_EPOCH, year, period, week)
    return expand_weeks(_pieces_between(mart, wk - weeks + 1, wk))


def weekly_base_cost_all(mart: Mart, years: Sequence[int] | None = None) -> DataFrame:
    """DOM-06 for every week of ``years`` (default: every fiscal week of the
    data) in one plan (JN-14, INC-03)."""
    if years:
        first = fiscal_week_index(FISCAL_EPOCH, min(years), 1, 1)
        last = fiscal_week_index(FISCAL_EPOCH, max(years), 13, 4)
    else:
        first, last = _week_bounds(mart)
    out = expand_weeks(_pieces_between(mart, first, last))
    return out.filter(F.col("year").isin(*years)) if years else out


def weekly_base_cost_by_store(mart: Mart) -> DataFrame:
    """All fiscal weeks of the data, summarised per store: priced items and
    the sum of their base costs.

    A cost adds to its store's sums in its first week and is taken off after its
    last one; the exact running sums hold until the store's next change. So a
    cost is two rows, however many weeks it stands for.
    """
    pieces = _pieces_between(mart, *_week_bounds(mart))
    cost = F.col("base_cost").cast("decimal(18,4)")
    priced = cost.isNotNull().cast("int")
    changes = pieces.select("store_id", F.inline(F.array(
        F.struct(F.col("from_week").alias("week_index"), F.lit(1).alias("items"), priced.alias("priced"), cost.alias("base_cost")),
        F.struct((F.col("to_week") + 1).alias("week_index"), F.lit(-1).alias("items"), (-priced).alias("priced"), (-cost).alias("base_cost")))))
    sums = ["items", "priced", "base_cost"]
    by_week = Window.partitionBy("store_id").orderBy("week_index")
    held = (changes.groupBy("store_id", "week_index").agg(*[F.sum(c).alias(c) for c in sums])
            .select("store_id", F.lead("week_index").over(by_week).alias("next"), "week_index",
                    *[F.sum(c).over(by_week).alias(c) for c in sums])
            .filter("items > 0"))
    weeks = held.withColumn("week_index", F.explode(F.sequence("week_index", F.col("next") - 1)))
    return _fiscal(weeks).select("week_index", "year", "period", "week", "store_id", "items",
                                 F.when(F.col("priced") > 0, F.col("base_cost").cast("double")).alias("base_cost"))


# -- INC-03: costs as validity spans, kept current key by key ---------------------
SPAN_KEY = ["store_id", "item_id"]
_VALUES = ["date", "item", "base_uofm", "base_cost"]


def _cost_pieces(purchases: DataFrame, counts: DataFrame, last_week: int) -> DataFrame:
    """DOM-06 without a row per week: store_id, item_id, from_week, to_week and
    the cost that holds in all of those weeks.

    A purchase holds until the item's next week with a purchase. Where it costs
    nothing, and before the first purchase, the store's oldest stock count holds
    from its week on. A hot (store, item) is one row per week after the partial
    top-1 and one for its count, so windows are bounded by the number of weeks.
    """
    newest = top_per_group(purchases, ["id", "itemid", "week_index"], NEWEST, descending=True)
    oldest = top_per_group(counts, ["id", "itemid"], NEWEST, descending=False)
    def shape(rows: DataFrame, counted: bool) -> DataFrame:
        return rows.select(F.col("id").alias("store_id"), F.col("itemid").alias("item_id"), F.col("week_index").alias("week"),
                           F.lit(counted).alias("counted"), F.struct(*_VALUES).alias("v"))
    rows = shape(newest, False).unionByName(shape(oldest, True))
    # a key's purchases by week, then its count
    key = Window.partitionBy(*SPAN_KEY)
    order = key.orderBy("counted", "week")
    bought = ~F.col("counted")
    rows = rows.select(
        "*", F.lead(F.when(bought, F.col("week"))).over(order).alias("next"),
        F.min(F.when(bought, F.col("week"))).over(key).alias("first_bought"),
        F.max(F.when(F.col("counted"), F.struct("week", "v"))).over(key).alias("count"))
    until = F.coalesce(F.col("next") - 1, F.lit(last_week))
    held = F.struct(F.col("week").alias("from_week"), until.alias("to_week"), "v")
    free = F.coalesce(F.col("v.base_cost") == 0, F.lit(False)) & F.col("count").isNotNull()
    spans = (F.when(F.col("counted"), F.array(F.struct(
        F.col("week").alias("from_week"), F.coalesce(F.col("first_bought") - 1, F.lit(last_week)).alias("to_week"), "v")))
        .when(free, F.array(
            F.struct(F.col("week").alias("from_week"), F.least(until, F.col("count.week") - 1).alias("to_week"), F.col("v")),
            F.struct(F.greatest("week", "count.week").alias("from_week"), until.alias("to_week"), F.col("count.v").alias("v"))))
        .otherwise(F.array(held)))
    return (rows.select(*SPAN_KEY, F.inline(spans)).filter(F.col("from_week") <= F.col("to_week")).filter(F.col("v.base_uofm").isNotNull())
            .select(*SPAN_KEY, "from_week", "to_week", "v.date", "v.item", "v.base_uofm", F.round("v.base_cost", 4).alias("base_cost")))


def cost_spans(purchases: DataFrame, counts: DataFrame, last_week: int) -> DataFrame:
    """The longest runs of weeks in which a cost holds: store_id, item_id,
    from_week, to_week, date, item, base_uofm, base_cost."""
    by_week = Window.partitionBy(*SPAN_KEY).orderBy("from_week")
    pieces = _cost_pieces(purchases, counts, last_week)
    # neighbours with the same values are one run
    went_on = F.lag("to_week").over(by_week) == F.col("from_week") - 1
    for c in _VALUES:
        went_on = went_on & F.lag(c).over(by_week).eqNullSafe(F.col(c))
    runs = pieces.withColumn("new", F.when(F.coalesce(went_on, F.lit(False)), 0).otherwise(1)).withColumn("run", F.sum("new").over(by_week))
    return (runs.groupBy(*SPAN_KEY, "run").agg(F.min("from_week").alias("from_week"), F.max("to_week").alias("to_week"),
                                                *[F.first(c).alias(c) for c in _VALUES]).drop("run"))


def expand_weeks(spans: DataFrame) -> DataFrame:
    """One row per week of every span, with the fiscal attributes of the week."""
    weeks = spans.withColumn("week_index", F.explode(F.sequence("from_week", "to_week"))).drop("from_week", "to_week")
    return _finish(weeks.withColumnsRenamed({"store_id": "id", "item_id": "itemid"}))


def last_week(mart: Mart) -> int:
    """The last fiscal week of the data (-1 without data)."""
    last = mart.calendar.agg(F.max("week_index")).first()[0]
    return -1 if last is None else int(last)


def weekly_cost_spans(mart: Mart) -> DataFrame:
    """DOM-06 / JN-14 for every fiscal week of the data, as runs of weeks."""
    return cost_spans(_costed_purchases(mart), _stock_counts(mart), last_week(mart))


def refresh_spans(spans: DataFrame, touched: DataFrame, purchases: DataFrame, counts: DataFrame,
                  last_before: int, last_week: int) -> DataFrame:
    """INC-03: the spans after a batch, from the spans before it.

    ``touched`` (store_id, item_id) are the keys that the batch holds;
    ``purchases`` and ``counts`` are the facts after it. Only the touched keys'
    facts are read into new spans; all other spans are kept, those that were open
    at ``last_before`` go on to ``last_week``.
    """
    keys = touched.select(*SPAN_KEY).distinct()
    here = keys.withColumnsRenamed({"store_id": "id", "item_id": "itemid"})
    new = cost_spans(purchases.join(here, ["id", "itemid"], "left_semi"), counts.join(here, ["id", "itemid"], "left_semi"), last_week)
    open_end = F.when(F.col("to_week") == last_before, F.lit(last_week)).otherwise(F.col("to_week"))
    return spans.join(keys, SPAN_KEY, "left_anti").withColumn("to_week", open_end).select(*new.columns).unionByName(new)


def is_late() -> Column:
    """The lines of the late batch: every sixteenth transaction."""
    return F.col("transactionid") % 16 == 5


def weekly_cost_increment(mart: Mart) -> DataFrame:
    """INC-03: spans of all but the late transactions, then the late batch applied
    to them key by key. Equals the run over all transactions."""
    purchases, counts, last = _costed_purchases(mart), _stock_counts(mart), last_week(mart)
    table = cost_spans(purchases.filter(~is_late()), counts.filter(~is_late()), last)
    keys = [F.col("id").alias("store_id"), F.col("itemid").alias("item_id")]
    batch = purchases.filter(is_late()).select(*keys).unionByName(counts.filter(is_late()).select(*keys))
    return refresh_spans(table, batch, purchases, counts, last, last)
