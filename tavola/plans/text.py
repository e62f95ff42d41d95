"""Name and number clean-up over the item and invoice tables (STR-*, FLT-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tavola.functions.strings import (collapse_two_dashes, is_paren_negative, last_part,
                                      parse_money, split_first, split_last, split_parts,
                                      strip_modifiers, strip_prefix_words, title_case)
from tavola.plans.menu import LEADING_MODIFIERS, TRAILING_MODIFIERS
from tavola.sources.mart import CONCEPTS, Mart


def item_name_parts(mart: Mart) -> DataFrame:
    """STR-01..07/12: the splitting and clean-up rules applied to names built
    as ``brand - type - name`` (and ``concept - name``)."""
    p = mart.raw("part")
    full = F.concat_ws(" - ", "p_brand", "p_type", "p_name")
    concept_name = F.concat_ws(" - ", F.when(F.col("p_size") % 2 == 0, F.lit(CONCEPTS[0]))
                               .otherwise(F.lit(CONCEPTS[1])), F.col("p_name"))
    modified = F.concat(F.when(F.col("p_size") % 4 == 0, F.lit("Add "))
                         .when(F.col("p_size") % 4 == 1, F.lit("Extra ")).otherwise(F.lit("")),
                        F.col("p_name"),
                        F.when(F.col("p_size") % 5 == 0, F.lit(" Only")).otherwise(F.lit("")))
    first_a, first_b = split_first(full)
    last_a, last_b = split_last(full)
    part0, part1 = split_parts(full, 2)
    return p.select(
        "p_partkey", full.alias("full_name"),
        first_a.alias("first_head"), first_b.alias("first_rest"),
        last_a.alias("last_head"), last_b.alias("last_tail"),
        part0.alias("part0"), part1.alias("part1"),
        last_part(full).alias("tail"),
        collapse_two_dashes(full).alias("collapsed"),
        strip_prefix_words(concept_name, CONCEPTS).alias("no_concept"),
        title_case(F.concat(F.lower("p_type"), F.lit("-on "), F.col("p_name"))).alias("titled"),
        strip_modifiers(modified, LEADING_MODIFIERS, TRAILING_MODIFIERS).alias("unmodified"))


def invoice_money_text(mart: Mart) -> DataFrame:
    """STR-09/10 + FLT-10: invoice amounts written as report text (thousands
    commas, returns in parentheses) parsed back to numbers."""
    li = mart.raw("lineitem")
    fmt = F.format_number("l_extendedprice", 2)
    text = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("("), fmt, F.lit(")"))).otherwise(fmt)
    return (li.select("l_orderkey", "l_linenumber", "l_partkey", text.alias("amount_text"))
              .select("*", parse_money("amount_text").alias("amount"),
                      F.coalesce(is_paren_negative("amount_text"), F.lit(False)).alias("is_return")))
