"""From the cells of ruled tables to raw rows: what a table reader of any document has to hand over.

A cell is (document, page, row, column from 0, text). Rows whose number isn't one to four digits are headings or
bands and are left out; of a repeated number the first printed row counts; cells are joined over line breaks.

Defined cases: a missing cell is empty; further columns are ignored; a document without rows gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import calendar_of, to_iso

#: The columns of the published table, in order.
COLUMNS = ["recno", "date", "district", "name", "land", "implementer", "planner"]
NUMBER = "^[0-9]{1,4}$"


def joined(c: Column) -> Column:
    """A cell's text without line breaks and outer space."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\r\n]+", ""))


def rows_of_cells(cells: DataFrame, document: str = "gazette_id", page: str = "page", row: str = "row", column: str = "col", text: str = "text") -> DataFrame:
    """(document, page, row, the seven columns, repeats, parse_error): one aggregation to rows, one to the first of each number."""
    cell = {n: F.max(F.when(F.col(column) == i, joined(F.col(text)))) for i, n in enumerate(COLUMNS)}
    rows = cells.groupBy(document, page, row).agg(*[F.coalesce(c, F.lit("")).alias(n) for n, c in cell.items()]).where(F.col("recno").rlike(NUMBER))
    rest = [page, row, *COLUMNS[1:]]
    first = rows.groupBy(document, F.col("recno").cast("int").alias("recno")).agg(F.min_by(F.struct(*rest), F.struct(page, row)).alias("r"), (F.count("*") - 1).alias("repeats"))
    out = first.select(document, "recno", "r.*", "repeats")
    why = {"date": to_iso(F.col("date")).isNull(), "district": F.col("district") == "", "name": F.col("name") == "", "land": F.col("land") == ""}
    return out.withColumn("parse_error", F.concat_ws("；", *[F.when(bad, F.lit(n)) for n, bad in why.items()]))


def document_meta(rows: DataFrame, document: str = "gazette_id") -> DataFrame:
    """One row a document: records, repeats, pages, faulty rows and the calendars its dates use."""
    return rows.groupBy(document).agg(
        F.count("*").alias("records"), F.sum("repeats").alias("repeats"), F.count_distinct("page").alias("pages"), F.count_if(F.col("parse_error") != "").alias("faulty"),
        F.array_join(F.array_sort(F.collect_set(calendar_of(F.col("date")))), "|").alias("calendars"),
    )
