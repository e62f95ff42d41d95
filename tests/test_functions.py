from pyspark.sql import functions as F

from tavola.functions import dates, numeric, strings


def one(spark, expr, rows, schema="s string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_split_first_and_last(spark):
    a, b = strings.split_first("s")
    assert one(spark, a, [("A - B - C",), ("A",)]) == ["A", "A"]
    assert one(spark, b, [("A - B - C",), ("A",)]) == ["B - C", None]
    h, t = strings.split_last("s")
    assert one(spark, h, [("A - B - C",), ("A",)]) == ["A - B", "A"]
    assert one(spark, t, [("A - B - C",), ("A",)]) == ["C", None]


def test_collapse_two_dashes(spark):
    assert one(spark, strings.collapse_two_dashes("s"), [("A - B - C",), ("A - B",), ("",)]) == \
        ["- C", "A - B", ""]


def test_title_case_capitalises_after_punctuation(spark):
    assert one(spark, strings.title_case("s"), [("add-on",), ("ON SIDE",)]) == ["Add-On", "On Side"]


def test_parse_money(spark):
    assert one(spark, strings.parse_money("s"), [("(1,234.50)",), ("2,000",), ("x",), (None,)]) == \
        [-1234.5, 2000.0, None, None]


def test_strip_modifiers(spark):
    e = strings.strip_modifiers("s", ["Add", "Extra", "Lite", "On Side"], ["On Side", "Only"])
    assert one(spark, e, [("Add Bacon",), ("Fries On Side",), ("Addison",)]) == \
        ["Bacon", "Fries", "Addison"]


def test_extract_int(spark):
    assert one(spark, strings.extract_int("s"), [("Period 01",), ("none",)]) == [1, None]


def test_shift_date_text_two_digit_years_and_passthrough(spark):
    e = dates.shift_date_text("s", 364)
    assert one(spark, e, [("12/31/99",), ("01/02/24",), ("Total",)]) == ["12/29/00", "12/31/24", "Total"]


def test_business_date_starts_at_four(spark):
    rows = [("2024-01-01 08:59:00",), ("2024-01-01 09:00:00",)]   # 03:59 / 04:00 in New York
    e = dates.business_date(F.to_timestamp_ntz("s"), "America/New_York", 4)
    got = [str(d) for d in one(spark, e, rows)]
    assert got == ["2023-12-31", "2024-01-01"]


def test_safe_ratio_and_unit_cost(spark):
    df = spark.createDataFrame([(1.0, 0.0, 2.0), (4.0, 2.0, 0.0), (6.0, 2.0, None)], "a double, b double, c double")
    r = df.select(numeric.safe_ratio("a", "b", 1.0).alias("r"),
                  numeric.unit_cost("a", "b", "c").alias("u")).collect()
    assert [x.r for x in r] == [1.0, 2.0, 3.0]
    assert [x.u for x in r] == [0.0, 0.0, 0.0]


def test_not_below_null_is_true(spark):
    df = spark.createDataFrame([(None, 1.0), (0.5, 1.0), (2.0, 1.0)], "x double, m double")
    assert [r[0] for r in df.select(numeric.not_below("x", "m")).collect()] == [True, False, True]


def test_rating_classes(spark):
    df = spark.createDataFrame([(True, True), (True, False), (False, True), (False, False)], "q boolean, m boolean")
    assert [r[0] for r in df.select(numeric.rating("q", "m")).collect()] == \
        ["Star", "Opportunity", "Puzzle", "Dog"]


def test_conversion_factor(spark):
    df = spark.createDataFrame([("OZ-fl", "OZ-wt", 2.0, 4.0, 1.0), ("Each", "Each", 0.0, 1.0, 1.0),
                                ("LB", "Each", 1.0, 1.0, 1.0)],
                               "u string, b string, weight_qty double, volume_qty double, each_qty double")
    r = df.select(numeric.conversion_factor("u", "b"), numeric.is_known_pair("u", "b")).collect()
    assert [(x[0], x[1]) for x in r] == [(2.0, True), (1.0, True), (1.0, False)]
