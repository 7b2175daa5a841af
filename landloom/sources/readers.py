"""Readers of the register's forms: line logs, payloads, permit XML, geometry, HTML pages, packed TSV.

Nothing is fetched: what an adapter landed is read. Malformed lines of an append-only log are skipped, as a log may
end in half a line; everything else that fails is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEDGER = "match_land_core string, match_iso_date string, field string, to string, why string, by string, at string, gazette_id string, supersedes bigint, accept_removal boolean, confirm_merge boolean, with_land_core string, with_iso_date string, seq bigint"
PERMIT_ROW = "`執照號碼` string, `發照日期` string, `原核發執照` string, `開工日期` string, `地段地號` struct<`地段號`: array<string>>"
POLYGON = "type string, coordinates array<array<array<double>>>"


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An append-only log; lines that aren't whole records are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def payload(spark: SparkSession, path: str, schema: str, prefix: str = "window.PROJECTS") -> DataFrame:
    """``window.PROJECTS = {...};`` as one row per project; ``schema`` is that of a project."""
    body = F.regexp_extract("value", r"(?s)^\s*" + prefix.replace(".", r"\.") + r"\s*=\s*(\{.*\})\s*;?\s*$", 1)
    doc = F.from_json(body, f"published_date string, projects array<struct<{schema}>>", {"mode": "FAILFAST"})
    return spark.read.text(path, wholetext=True).select(doc.alias("d")).select("d.published_date", F.explode("d.projects").alias("p")).select("published_date", "p.*")


def packed_array(c: Column) -> Column:
    """``a|b|c`` as an array; empty text is an empty array."""
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, r"\|"))


def packed_map(c: Column) -> Column:
    """``k:v,v;k:v`` as a map of arrays."""
    entries = F.transform(F.split(c, ";"), lambda e: F.struct(F.substring_index(e, ":", 1).alias("k"), F.split(F.substring(e, F.length(F.substring_index(e, ":", 1)) + F.lit(2), F.lit(1 << 30)), ",").alias("v")))
    return F.when(c == "", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<string>>"))).otherwise(F.map_from_entries(entries))


def tsv(spark: SparkSession, path: str, columns: list[str], arrays: tuple[str, ...] = (), maps: tuple[str, ...] = ()) -> DataFrame:
    """A TSV sink read back: all text, lists and maps unpacked, empty text kept apart from null."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = spark.read.schema(schema).options(sep="\t", header="true", quote='"', escape='"', multiLine="true", emptyValue="", nullValue="\\N", enforceSchema="false").csv(path)
    df = df.select(*[F.coalesce(c, F.lit("")).alias(c) if c in (*arrays, *maps) else F.col(c) for c in columns])
    return df.withColumns({**{c: packed_array(F.col(c)) for c in arrays}, **{c: packed_map(F.col(c)) for c in maps}})


def permit_xml(spark: SparkSession, path: str) -> DataFrame:
    """(permit_no, date, orig_permit, construction_start, lands) of each ``Data`` element that has a number."""
    x = spark.read.format("xml").option("rowTag", "Data").schema(PERMIT_ROW).load(path)
    return x.where("coalesce(trim(`執照號碼`), '') != ''").select(
        F.col("`執照號碼`").alias("permit_no"), F.col("`發照日期`").alias("date"), F.col("`原核發執照`").alias("orig_permit"), F.col("`開工日期`").alias("construction_start"), F.coalesce(F.col("`地段地號`.`地段號`"), F.array().cast("array<string>")).alias("lands")
    )


def geojson(spark: SparkSession, path: str) -> DataFrame:
    """(properties, polygon): every polygon of a feature collection; a multi-polygon gives one row per part."""
    schema = "features array<struct<properties: map<string,string>, geometry: struct<type: string, coordinates: string>>>"
    f = spark.read.schema(schema).option("multiLine", "true").option("primitivesAsString", "true").json(path).select(F.explode("features").alias("f"))
    one = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    many = F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>")
    parts = F.when(F.col("f.geometry.type") == "Polygon", F.array(one)).otherwise(many)
    return f.select(F.col("f.properties").alias("properties"), F.explode(parts).alias("polygon"))


class _Cells(HTMLParser):
    """Text of table rows and links."""

    def __init__(self):
        super().__init__()
        self.rows: list[list[str]] = []
        self.where: list[tuple[int, bool]] = []  # of each row its table's number and whether that is hidden
        self.links: list[tuple[str, str]] = []
        self._tables: list[tuple[int, bool]] = []
        self._count = 0
        self._cell = self._href = None
        self._text = ""

    def _row(self):
        self.rows.append([])
        self.where.append(self._tables[-1] if self._tables else (0, False))

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self._row()
        elif tag == "table":
            self._count += 1
            hidden = "display:none" in (dict(attrs).get("style") or "").replace(" ", "")
            self._tables.append((self._count, hidden or bool(self._tables) and self._tables[-1][1]))
        elif tag in ("td", "th"):
            self._cell = ""
        elif tag == "a":
            self._href, self._text = dict(attrs).get("href") or "", ""

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self._cell is not None:
            if not self.rows:
                self._row()
            self.rows[-1].append(" ".join(self._cell.split()))
            self._cell = None
        elif tag == "table" and self._tables:
            self._tables.pop()
        elif tag == "a" and self._href is not None:
            self.links.append((self._href, " ".join(self._text.split())))
            self._href = None

    def handle_data(self, data):
        if self._cell is not None:
            self._cell += data
        if self._href is not None:
            self._text += data


def html_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(``key``, kind, n, cells): table rows and links of each page, in order; a link's cells are address and text."""
    kind = dict(pages.dtypes)[key]

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            out = []
            for k, page in zip(pdf[key], pdf[html]):
                p = _Cells()
                p.feed(page or "")
                out += [(k, "row", n, cells) for n, cells in enumerate(r for r in p.rows if r)]
                out += [(k, "link", n, list(link)) for n, link in enumerate(p.links)]
            yield pd.DataFrame(out, columns=[key, "kind", "n", "cells"])

    return pages.select(key, html).mapInPandas(run, f"`{key}` {kind}, kind string, n int, cells array<string>")


def html_tables(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(``key``, tab, hidden, n, cells): the rows of each table of a page, in order; tables count from 1, rows outside any are in table 0."""
    kind = dict(pages.dtypes)[key]

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            out = []
            for k, page in zip(pdf[key], pdf[html]):
                p = _Cells()
                p.feed(page or "")
                out += [(k, t, hidden, n, cells) for n, ((t, hidden), cells) in enumerate(zip(p.where, p.rows)) if cells]
            yield pd.DataFrame(out, columns=[key, "tab", "hidden", "n", "cells"])

    return pages.select(key, html).mapInPandas(run, f"`{key}` {kind}, tab int, hidden boolean, n int, cells array<string>")


#: Fixed values of the pages: the head of a table of milestones, and the link to the next page of a list.
MILESTONE_HEAD, NEXT_PAGE = ["項目", "日期"], "下一頁"


def milestones(tables: DataFrame, key: str) -> DataFrame:
    """(``key``, n, label, value): the rows below the head of a page's table of milestones; a hidden table counts only where no shown one has the head."""
    head = tables.where(F.col("cells") == F.array(*map(F.lit, MILESTONE_HEAD)))
    best = head.groupBy(key).agg(F.min(F.struct("hidden", "tab", F.col("n").alias("at"))).alias("b")).select(key, F.col("b.tab").alias("tab"), F.col("b.at").alias("at"))
    rows = tables.join(best, [key, "tab"]).where((F.col("n") > F.col("at")) & (F.size("cells") == 2))
    return rows.select(key, "n", F.col("cells")[0].alias("label"), F.col("cells")[1].alias("value"))


def has_next_page(rows: DataFrame, key: str) -> DataFrame:
    """(``key``, more): whether a list page links to a next one; ``rows`` as of ``html_rows``."""
    return rows.groupBy(key).agg(F.bool_or((F.col("kind") == "link") & (F.col("cells")[1] == NEXT_PAGE) & (F.col("cells")[0] != "")).alias("more"))


def html_title(html: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)(?:\s*-[^<]*)?</title>", 1)), F.lit(""))


def page_fingerprint(html: Column, volatile: str = r"\d{1,2}:\d{2}(?::\d{2})?|瀏覽人次[:：]?\s*[\d,]+") -> Column:
    """Digest of a page without what changes on every visit."""
    return F.sha2(F.regexp_replace(html, volatile, ""), 256)
