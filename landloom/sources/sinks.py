"""Sinks: packed TSV, the JSON document with its script form, and the digests that version them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pack_array(c: Column) -> Column:
    return F.array_join(c, "|")


def pack_map(c: Column) -> Column:
    return F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit(":"), F.array_join(e["value"], ","))), ";")


def tsv_form(df: DataFrame) -> DataFrame:
    """Every column as text: lists joined by |, maps as k:v,v;k:v, booleans in words, null as empty."""
    out = []
    for c, kind in df.dtypes:
        v = pack_array(F.col(c)) if kind.startswith("array<string") else pack_map(F.col(c)) if kind.startswith("map") else F.col(c).cast("string")
        out.append(F.coalesce(v, F.lit("")).alias(c))
    return df.select(*out)


def write_tsv(df: DataFrame, path: str) -> None:
    tsv_form(df).write.mode("overwrite").options(sep="\t", header="true", quote='"', escape='"', emptyValue="").csv(path)


def document(projects: DataFrame, published: str) -> DataFrame:
    """One row a project: its JSON. A document of any size is a folder of such lines and a header row, never one string on the driver."""
    return projects.select(F.to_json(F.struct(F.lit(2).alias("schema_version"), F.lit(published).alias("published_date"), F.struct(*projects.columns).alias("project"))).alias("value"))


def script_form(projects: DataFrame, published: str) -> DataFrame:
    """The whole document as one script text, for payloads that a browser loads (megabytes)."""
    body = F.to_json(F.struct(F.lit(published).alias("published_date"), F.array_sort(F.collect_list(F.struct(*projects.columns))).alias("projects")))
    return projects.agg(F.concat(F.lit("window.PROJECTS = "), body, F.lit(";")).alias("value"))


def asset_version(date: Column, projects: Column, records: Column) -> Column:
    """Date and four hex digits of a digest, to tell browsers of a new payload."""
    return F.concat_ws("-", date, F.substring(F.sha2(F.concat_ws("|", date, projects.cast("string"), records.cast("string")), 256), 1, 4))
