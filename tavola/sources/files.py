"""Readers for landed files (SRC-01 .. SRC-12).

All readers take an explicit schema (no inference in production reads) and
return DataFrames that Spark reads in parallel; a file is never loaded on the
driver.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tavola.functions.nested import as_array
from tavola.functions.strings import parse_money


def _file_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of files, big files split across tasks: value, _file, _block (where the line's split
    starts) and _row, a number that grows along every block. Only ``\\n`` ends a line."""
    return (spark.read.option("lineSep", "\n").text(path)
            .withColumn("_file", F.col("_metadata.file_path"))
            .withColumn("_block", F.col("_metadata.file_block_start"))
            .withColumn("_row", F.monotonically_increasing_id()))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files, also where quoted fields hold line breaks: value, _file, _row, _nth.

    A line break ends a record where the number of quotes before it in the file
    is even. Quotes are counted per block of the file, a running sum over the
    blocks (one row per block) says whether a block starts inside a quoted
    field, and only blocks that hold or start in an open quote number their
    lines with a window; all other lines are records as they are. Lines of one
    record meet in a grouping, also across blocks. ``_row`` is the number of the
    record's first line; ``_nth`` counts the records of a file's first block from
    1 (null in later blocks). A carriage return before the end of a record goes.

    Quotes follow RFC 4180: a field that holds one is quoted, and doubles it. The
    rest of a file after a quote that nothing closes is one record.
    """
    quotes = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    lines = _file_lines(spark, path).withColumn("_odd", quotes)
    along = Window.partitionBy("_file").orderBy("_block")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    blocks = (lines.groupBy("_file", "_block").agg(F.sum("_odd").alias("odd"), F.min("_row").alias("_first"))
              .withColumn("_open", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2))
    marked = lines.join(blocks.select("_file", "_block", "_first", "_open", ((F.col("odd") == 0) & (F.col("_open") == 0)).alias("_plain")),
                        ["_file", "_block"])
    plain = marked.filter("_plain").select(
        "value", "_file", "_row", F.when(F.col("_block") == 0, F.col("_row") - F.col("_first") + 1).alias("_nth"))
    inside = Window.partitionBy("_file", "_block").orderBy("_row")
    before = F.coalesce(F.sum("_odd").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("_open")
    mixed = marked.filter("NOT _plain").withColumn("_starts", before % 2 == 0)
    mixed = (mixed.withColumn("_record", F.last(F.when(F.col("_starts"), F.col("_row")), ignorenulls=True).over(inside))
             .withColumn("_nth", F.when(F.col("_block") == 0, F.sum(F.col("_starts").cast("int")).over(inside))))
    # a block that starts inside a record continues the last one that an earlier block started
    carried = (marked.filter("_plain").groupBy("_file", "_block").agg(F.max("_row").alias("last"))
               .unionByName(mixed.groupBy("_file", "_block").agg(F.max("_record").alias("last")))
               .select("_file", "_block", F.last("last", ignorenulls=True).over(earlier).alias("_carried")))
    mixed = mixed.join(carried, ["_file", "_block"], "left").withColumn("_record", F.coalesce("_record", "_carried"))
    whole = F.col("_starts") & (F.col("_odd") == 0)
    single = mixed.filter(whole).select("value", "_file", "_row", "_nth")
    joined = (mixed.filter(~whole).groupBy("_file", F.col("_record").alias("_row"))
              .agg(F.array_sort(F.collect_list(F.struct("_block", F.col("_row").alias("r"), "value"))).alias("l"),
                   F.min("_nth").alias("_nth"))
              .select(F.array_join(F.col("l.value"), "\n").alias("value"), "_file", "_row", "_nth"))
    rows = plain.unionByName(single).unionByName(joined)
    return rows.withColumn("value", F.regexp_replace("value", r"\r$", ""))


def read_report_csv(spark: SparkSession, path: str, schema: T.StructType, skip: int = 3,
                    columns: Sequence[str] | None = None) -> DataFrame:
    """SRC-01: report CSV with ``skip`` banner lines, a header on the next
    line and numbers written with thousands commas / parentheses.

    Quoted fields may hold line breaks (``csv_records``); big files are read by
    many tasks. The banner and the header are the first ``skip + 1`` records of
    each file and must lie in its first block. Every field is parsed as text by
    ``from_csv`` and numeric fields through ``parse_money``; ``_ord`` is the
    arrival order. Blank lines are no rows.
    """
    names = [f.name for f in schema.fields]
    text_schema = ", ".join(f"`{n}` STRING" for n in names)
    body = csv_records(spark, path).filter(~F.coalesce(F.col("_nth") <= skip + 1, F.lit(False))).filter(F.trim("value") != "")
    parsed = body.select(F.from_csv("value", text_schema, {"escape": '"'}).alias("r"), "_row").select("r.*", "_row")
    out = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType, T.IntegerType, T.LongType)):
            out.append(parse_money(c).cast(f.dataType).alias(f.name))
        else:
            out.append(c.cast(f.dataType).alias(f.name))
    df = parsed.select(*out, F.col("_row").alias("_ord"))
    return df.select(*columns, "_ord") if columns else df


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
             columns: Sequence[str] | None = None) -> DataFrame:
    """SRC-02/03: header CSV (a glob or a list of paths reads many files as
    one table)."""
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    return df.select(*columns) if columns else df


def with_file_attribute(df: DataFrame, mapping: DataFrame, file_col: str = "file_name",
                        attr_col: str = "location") -> DataFrame:
    """SRC-04: attach a per-file value (e.g. the store of a budget workbook)
    by joining on the source file name of each row."""
    named = df.withColumn("_fname", F.col("_metadata.file_name"))
    m = mapping.select(F.col(file_col).alias("_fname"), F.col(attr_col))
    return named.join(m, "_fname", "left").drop("_fname")


def read_json_pages(spark: SparkSession, path: str, record_schema: T.StructType,
                    collection_key: str = "value", lines: bool = False) -> DataFrame:
    """SRC-05/06/08: landed API pages; the records sit under ``collection_key`` of
    each document as a list - or as a single object, which yields one record.

    Files are read in blocks by many tasks, whatever their size and however the
    documents are laid out (one to a file or several, with or without line breaks);
    see ``page_records``. With ``lines`` every line is a document and is taken by
    itself, so a broken line costs no other. ``broken_json_pages`` reports what
    holds no records."""
    if lines:
        items = _page_lines(spark, path).select(
            F.explode(as_array(F.get_json_object("value", f"$['{collection_key}']"))).alias("record"))
    else:
        items = page_records(spark, path, collection_key)
    return items.select(F.from_json("record", record_schema).alias("r")).select("r.*")


def broken_json_pages(spark: SparkSession, path: str, collection_key: str = "value", lines: bool = False) -> DataFrame:
    """DQ: file and problem of pages that are cut off or lack the key; with
    ``lines`` file, problem and the line."""
    if lines:
        docs = _page_lines(spark, path).withColumn("problem", F.when(F.get_json_object("value", "$").isNull(), "no JSON").when(
            F.get_json_object("value", f"$['{collection_key}']").isNull(), f"no {collection_key}"))
        return docs.filter("problem IS NOT NULL").select("file", "problem", "value")
    pieces = _page_pieces(spark, path, collection_key)
    files = pieces.groupBy(F.col("_file").alias("file")).agg(
        (F.sum("_change") != 0).alias("cut"), F.max_by("_odd_end", F.struct("_block", "_row")).alias("quote"), F.count("_opens").alias("key"))
    problem = F.when(F.col("cut") | (F.col("quote") == 1), "cut off").when(F.col("key") == 0, f"no {collection_key}")
    return files.withColumn("problem", problem).filter("problem IS NOT NULL").select("file", "problem")


def _page_lines(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.text(path).withColumn("file", F.col("_metadata.file_path")).filter(F.trim("value") != ""))


def _counted(text: Column, *characters: str) -> Column:
    out = F.lit(0)
    for c in characters:
        out = out + F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))
    return out


def _over_blocks(df: DataFrame, **sums: str) -> DataFrame:
    """``df`` with, per name of ``sums``, the sum of that column over the earlier blocks of the row's file."""
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = df.groupBy("_file", "_block").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    blocks = blocks.select("_file", "_block", *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(n) for n in sums])
    return df.join(blocks, ["_file", "_block"])


def _page_pieces(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The files cut after every closing brace, with what each piece does to the nesting.

    value (without the brace), _file, _block, _row (order within a block), _start
    and _end (depth of nesting before and after), _low (least depth within),
    _closes (whether the brace at its end counts), _opens (2 or 1 where the list or
    object under ``key`` of a document starts here, 0 if it ends here too), _change,
    _odd_end.
    """
    pieces = (spark.read.option("lineSep", "}").text(path)
              .withColumn("_file", F.col("_metadata.file_path")).withColumn("_block", F.col("_metadata.file_block_start"))
              .withColumn("_size", F.col("_metadata.file_size")).withColumn("_row", F.monotonically_increasing_id()))
    # the last piece of a file has a brace unless that would be a byte more than the file has
    last = pieces.groupBy("_file").agg(
        F.max(F.struct("_block", "_row")).alias("last"), (F.sum(F.octet_length("value") + 1) > F.max("_size")).alias("bare"))
    pieces = pieces.join(last, "_file").withColumn(
        "_brace", ~(F.col("bare") & (F.col("last._block") == F.col("_block")) & (F.col("last._row") == F.col("_row")))).drop("last", "bare", "_size")
    inside = Window.partitionBy("_file", "_block").orderBy("_row")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    plain = F.regexp_replace("value", r"(?s)\\.", "")  # without escapes
    pieces = pieces.withColumn("_plain", plain).withColumn("_odd", _counted(F.col("_plain"), '"') % 2)
    pieces = _over_blocks(pieces, quotes="_odd")
    pieces = pieces.withColumn("_in", (F.col("quotes") + F.coalesce(F.sum("_odd").over(before), F.lit(0))) % 2 == 1)
    pieces = pieces.withColumn("_odd_end", F.when(F.col("_in"), 1 - F.col("_odd")).otherwise(F.col("_odd")))
    # strings are marked from left to right, so that a mark never starts at a closing quote
    text = F.when(F.col("_in"), F.regexp_replace("_plain", '^[^"]*"?', "")).otherwise(F.col("_plain"))
    text = F.regexp_replace(F.regexp_replace(text, '"([^"]*)"', "\u0001$1\u0002"), '"[^"]*$', "")
    bare = F.regexp_replace(text, "\u0001[^\u0002]*\u0002", "")
    pieces = (pieces.withColumn("_text", text).withColumn("_bare", bare)
              .withColumn("_closes", F.col("_brace") & (F.col("_odd_end") == 0))
              .withColumn("_change", _counted(F.col("_bare"), "{", "[") - _counted(F.col("_bare"), "]") - F.col("_closes").cast("int")))
    pieces = _over_blocks(pieces, depth="_change")
    pieces = pieces.withColumn("_start", F.col("depth") + F.coalesce(F.sum("_change").over(before), F.lit(0)))
    pieces = pieces.withColumn("_end", F.col("_start") + F.col("_change"))

    def lowest(text: Column, start: Column) -> Column:
        """Least depth right after a closing bracket of a piece of structure that begins at depth ``start``."""
        cut = F.split(text, "]", -1)
        return F.array_min(F.transform(F.sequence(F.lit(1), F.size(cut)), lambda n: F.when(
            n < F.size(cut), start + _counted(F.array_join(F.slice(cut, F.lit(1), n), ""), "{", "[") - n)))

    def without_keys(parts: Column) -> Column:
        return F.regexp_replace(F.array_join(parts, ""), "\u0001[^\u0002]*\u0002", "")
    pieces = pieces.withColumn("_low", F.least("_start", "_end", lowest(F.col("_bare"), F.col("_start"))))
    # where the key stands in front of a bracket, at depth one, and whether that list ends in the same piece
    found = F.split("_text", "\u0001" + re.escape(key) + r"\u0002\s*:\s*(?=[\[{])", -1)
    pieces = pieces.withColumn("_found", F.when(F.size(found) > 1, found))
    found = F.col("_found")
    at_one = F.transform(F.sequence(F.lit(1), F.size(found) - 1), lambda n: F.when(
        F.col("_start") + _counted(without_keys(F.slice(found, F.lit(1), n)), "{", "[") - _counted(without_keys(F.slice(found, F.lit(1), n)), "]") == 1,
        F.when(F.coalesce(lowest(without_keys(F.slice(found, n + 1, F.size(found))), F.lit(1)), F.lit(2)) <= 1, 0)
        .when(F.substring(F.get(found, n), 1, 1) == "[", 2).otherwise(1)))
    return pieces.withColumn("_opens", F.array_max(at_one)).drop(
        "_plain", "_odd", "_text", "_bare", "_found", "quotes", "depth", "_in", "_brace")


def page_records(spark: SparkSession, path: str, collection_key: str = "value") -> DataFrame:
    """record (JSON text) of every object in the list, or object, under ``collection_key`` of the documents of page files.

    Files are split at closing braces, so the pieces of one large document are read
    by many tasks. Whether a piece starts inside a string and how deep, follows
    from sums over the blocks of the file (one row per block) and a running sum
    inside each; the pieces of a record meet in a grouping, also across blocks. A
    document that is cut off yields the records before the cut, and none after it
    in its file. Values in the list that are no objects are left out.
    """
    pieces = _page_pieces(spark, path, collection_key)
    inside = Window.partitionBy("_file", "_block").orderBy("_row")
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # the depth of the open list or object, 0 where it is closed: as it is after each piece
    event = (F.when(F.col("_opens").isNotNull(), F.when(F.col("_end") >= 2, F.col("_opens")).otherwise(0))
             .when(F.col("_low") <= 1, 0))
    pieces = pieces.withColumn("_event", event)

    def carried(df: DataFrame, value: str, name: str) -> DataFrame:
        blocks = df.groupBy("_file", "_block").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col("_row"))).alias("v"))
        return df.join(blocks.select("_file", "_block", F.last("v", ignorenulls=True).over(earlier).alias(name)), ["_file", "_block"])
    pieces = carried(pieces, "_event", "_from")
    run = F.last("_event", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.withColumn("_was", F.coalesce(run, "_from", F.lit(0)))
    base = F.when(F.col("_opens").isNotNull(), F.when(F.col("_opens") > 0, F.col("_opens"))).when((F.col("_was") > 0) & (F.col("_start") > F.col("_was")), F.col("_was")) \
            .when((F.col("_was") == 2) & (F.col("_low") >= 2), F.lit(2))
    peak = F.col("_end") + F.col("_closes").cast("int")
    pieces = pieces.withColumn("_base", base).withColumn("_first", F.coalesce((F.col("_opens").isNotNull() | (F.col("_start") <= F.col("_base")))
                                                                             & (peak > F.col("_base")), F.lit(False)))
    member = pieces.filter(F.col("_base").isNotNull() & (F.col("_first") | (F.col("_start") > F.col("_base"))))
    member = carried(member.withColumn("_mark", F.when(F.col("_first"), F.col("_row"))), "_mark", "_open")
    member = member.withColumn("_record", F.coalesce(F.last("_mark", ignorenulls=True).over(inside), "_open"))
    behind = F.regexp_replace("value", r'(?s)^.*?"' + re.escape(collection_key) + r'"\s*:\s*(?=[\[{])', "")
    body = F.when(F.col("_first"), F.regexp_replace(F.when(F.col("_opens").isNotNull(), behind).otherwise(F.col("value")), "^[^{]*", "")) \
            .otherwise(F.col("value"))
    done = F.col("_closes") & (F.col("_end") == F.col("_base"))
    whole = member.filter(F.col("_first") & done).select(F.concat(body, F.lit("}")).alias("record"))
    parts = (member.filter(~(F.col("_first") & done)).groupBy("_file", "_record")
             .agg(F.array_sort(F.collect_list(F.struct("_block", "_row", body.alias("t")))).alias("l"), F.max(done).alias("done")))
    # every piece but a bare last one ended in a brace
    return whole.unionByName(parts.filter("done").select(F.concat(F.array_join(F.col("l.t"), "}"), F.lit("}")).alias("record")))


def unwrap_records(df: DataFrame, json_col: str, record_schema: T.StructType) -> DataFrame:
    """SRC-07: a document is either a list of records, an object whose first
    list-valued field holds the records, or a single record."""
    v = F.col(json_col)
    trimmed = F.ltrim(v)
    # field values as raw JSON texts, in document order
    values = F.map_values(F.from_json(v, T.MapType(T.StringType(), T.StringType())))
    first_list = F.filter(values, lambda x: F.ltrim(x).startswith("["))
    inner = F.when(trimmed.startswith("["), v) \
             .when(F.size(first_list) > 0, F.get(first_list, 0)) \
             .otherwise(v)
    return (df.select(F.explode(as_array(inner)).alias("rec"))
              .select(F.from_json("rec", record_schema).alias("r")).select("r.*"))


def read_lines(spark: SparkSession, path: str, col: str = "name") -> DataFrame:
    """SRC-11: a list file - stripped lines, blanks dropped; a missing file
    gives an empty list (any other failure is raised)."""
    try:
        df = spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{col} string")
    return df.select(F.trim("value").alias(col)).filter(F.col(col) != "")


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """SRC-09: one landed directory per store / business date
    (``location=.../business_date=...``) read as one table; the partition
    columns come from the directory names, so filters on them prune files."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.option("basePath", path).parquet(path)
