"""Secret scans that link the parts of a credential.

A scan of every text finds spans of these kinds. ``assign`` (a password, token
or key written as ``name = value``), ``access`` (access key ids) and ``hex``
(long hexadecimal strings) speak for themselves: they are always reported. The
others are weak candidates that also stand in harmless texts:

* ``user``: an identifier (``user = ...``, ``client_id: ...``);
* ``short``: an assignment whose value is under ``SHORTEST_VALUE`` characters;
* ``blob``: a long string of mixed letters and digits with high entropy;
* ``endpoint``: an address (``scheme://...`` or ``host = ...``).

A weak candidate is reported only where a part that completes it
(``COMPLEMENTS``) stands in the same scope, at most ``REACH`` characters away
and not overlapping. A scope is a block of text without an empty line. The parts
meet in an interval join: every span is a point (its start for the candidates
before it, its end for those after it) in a band of ``REACH`` characters, each
candidate looks into the two bands that its reach can touch on either side, and
bands are join keys beside the row, so one long text spreads over many tasks.
Spans of a kind do not overlap, so a band holds at most ``REACH`` of each and a
candidate has a bounded number of partners whatever the input.

Spans of a kind are leftmost and do not overlap; spans of different kinds may
overlap, each counts. Offsets are code points, the end is exclusive. Null and
empty texts have no spans; rows that share a doc_id (or have none) are scanned
and reported each by itself; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tavola.llm.common import map_arrow, park, table

REACH = 300
SHORTEST_VALUE = 8
SHORTEST_ACCESS = 16
SHORTEST_HEX = 32
SHORTEST_BLOB = 20
BLOB_BITS = 3.5
# Kinds in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "user", "short", "blob", "endpoint")
BASE = KINDS[:3]
#: Which parts complete a weak candidate.
COMPLEMENTS = {
    "user": ("assign", "hex", "short", "blob"),
    "short": ("access", "user", "endpoint"),
    "blob": ("access", "user"),
    "endpoint": ("assign", "short"),
}

# Letters of the names match in either case (ASCII only).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{%d,}" % SHORTEST_HEX)
USER = re.compile(r"""(?<![A-Za-z0-9])(?:user(?:_?(?:name|id))?|login|account(?:_?id)?|client_?id|access_?key(?:_?id)?|key_?id)"""
                  r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9._%+@-]{3,})""", re.I | re.A)
ENDPOINT = re.compile(r"""[A-Za-z][A-Za-z0-9+.-]{1,30}://[^\s"'<>]+|(?<![A-Za-z0-9])(?:host(?:name)?|server|endpoint|bucket|base_?url)"""
                      r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9._:/-]{3,})""", re.I | re.A)
BLOB = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % SHORTEST_BLOB)
BLANK = re.compile(r"\n[ \t\r]*\n")


def entropy(value: str) -> float:
    """Bits per character of a string."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def spans(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) of a text, weak ones included, by start and kind."""
    out = []
    for m in ASSIGN.finditer(text):
        out.append(("assign" if m.end(2) - m.start(2) >= SHORTEST_VALUE else "short", m.start(), m.end()))
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= SHORTEST_ACCESS:
            out.append(("access", m.start(), m.end()))
    out += (("hex", m.start(), m.end()) for m in HEX.finditer(text))
    if ":" in text or "=" in text:
        out += (("user", m.start(), m.end()) for m in USER.finditer(text))
        out += (("endpoint", m.start(), m.end()) for m in ENDPOINT.finditer(text))
    for m in BLOB.finditer(text):
        value = m.group()
        if (re.search("[0-9]", value) and re.search("[A-Z]", value) and re.search("[a-z]", value)
                and entropy(value) >= BLOB_BITS):
            out.append(("blob", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(docs: DataFrame) -> DataFrame:
    """Per input row: row (a unique number), doc_id, parts (kind, start, end, scope) of all spans found."""
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def fn(batch: pa.RecordBatch):
        found = []
        for text in batch.column("text"):
            text = text.as_py() or ""
            parts = spans(text)
            if parts:
                cuts = [m.start() for m in BLANK.finditer(text)] if len(parts) > 1 else []
                scope = 0
                listed = []
                for kind, start, end in parts:
                    while scope < len(cuts) and cuts[scope] < start:
                        scope += 1
                    listed.append({"kind": kind, "start": start, "end": end, "scope": scope})
                parts = listed
            found.append(parts)
        yield {"row": batch.column("row"), "doc_id": batch.column("doc_id"), "parts": found}

    return map_arrow(docs, fn, "row long, doc_id long, parts array<struct<kind:string,start:int,end:int,scope:int>>")


def link(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """The interval join: one row per weak candidate and part that completes it.

    ``parts`` has row, kind, start, end, scope. Returns row, scope, the
    candidate's kind, start, end, the partner's partner_kind, partner_start,
    partner_end and the gap in characters.
    """
    band = F.lit(reach)
    points = parts.select(
        "row", "scope", F.col("kind").alias("partner_kind"), F.col("start").alias("partner_start"),
        F.col("end").alias("partner_end"),
        F.explode(F.array(F.struct(F.lit("after").alias("side"), F.col("start").alias("at")),
                          F.struct(F.lit("before").alias("side"), F.col("end").alias("at")))).alias("p"))
    points = points.select("*", "p.side", F.floor(F.col("p.at") / band).alias("band")).drop("p")
    first, last = F.floor((F.col("start") - band) / band), F.floor((F.col("end") + band) / band)
    weak = parts.filter(F.col("kind").isin(*COMPLEMENTS)).select(
        "row", "scope", "kind", "start", "end",
        F.explode(F.array(*[F.struct(F.lit(side).alias("side"), b.alias("band")) for side, b in (
            ("before", first), ("before", first + 1), ("after", last - 1), ("after", last))])).alias("b"))
    weak = weak.select("row", "scope", "kind", "start", "end", "b.side", "b.band")
    gap = F.when(F.col("side") == "after", F.col("partner_start") - F.col("end")).otherwise(F.col("start") - F.col("partner_end"))
    completes = F.lit(False)
    for kind, others in COMPLEMENTS.items():
        completes = completes | ((F.col("kind") == kind) & F.col("partner_kind").isin(*others))
    return (weak.join(points, ["row", "scope", "side", "band"]).withColumn("gap", gap)
            .filter(completes & F.col("gap").between(0, reach)).drop("side", "band"))


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, spans array<struct<start,rank,end,kind>>: what is reported of every input row, by start and kind.

    Base spans always, weak ones when they are linked.
    """
    scanned = park(scan(docs))
    several = scanned.filter(F.exists("parts", lambda p: p.kind.isin(*COMPLEMENTS)) & (F.size("parts") > 1))
    parts = several.select("row", F.explode("parts").alias("p")).select("row", "p.*")
    reported = (link(parts, reach).select("row", "kind", "start", "end").distinct()
                .groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("linked")))
    base = F.filter("parts", lambda p: p.kind.isin(*BASE))
    both = F.concat(F.transform(base, lambda p: F.struct(p.kind, p.start, p.end)), F.coalesce("linked", F.array()))
    listed = F.transform(both, lambda p: F.struct(
        p.start.alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), p.kind).alias("rank"),
        p.end.alias("end"), p.kind.alias("kind")))
    return scanned.join(reported, "row", "left").select("doc_id", F.sort_array(listed).alias("spans"))


def _written(column) -> Column:
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def op13_multipart_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))
    count = [F.size(F.expr(f"filter(spans, s -> s.kind = '{kind}')")).cast("long").alias(f"n_{kind}") for kind in BASE]
    base = F.filter("spans", lambda s: s.kind.isin(*BASE))
    return found.select("doc_id", *count, F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))
