"""Rows that fail to parse: the valid lines become records, the others come out with the reasons.

Structure is judged by the Arrow CSV reader, whose invalid-row callback reports lines with a wrong number of
columns. Fields are read as strings, then each column is matched and cast as a vector and the failing cells are
labelled; no cell is looked at alone.
Lines are read in bulk: one whose quoting is broken would swallow its neighbours, so lines with quotes or line
breaks are first held against the field grammar, and those that break it are rejected for their quoting.

Defined cases: a null or empty line has one column and is rejected; one final carriage return is ignored; tabs,
line breaks and doubled quotes inside a quoted field are data; every failing cell is named; a table without lines
gives no rows; if no district is known every district fails.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The nine columns of raw.tsv, in order.
COLUMNS = ["recno", "date", "district", "name", "land", "implementer", "planner", "parse_error", "gazette_id"]
_FIELD = r'(?:"(?:[^"]|"")*"|[^"\t\r\n][^\t\r\n]*|)'
_LINE = re.compile(f"{_FIELD}(?:\t{_FIELD})*")
_BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def _bad_recno(v: pa.Array) -> pa.Array:
    """Not a positive whole number in ASCII digits that fits 18 digits."""
    return pc.invert(pc.match_substring_regex(v, "^0*[1-9][0-9]{0,17}$"))


def _bad_day(v: pa.Array, pattern: str, two_calendars: bool) -> pa.Array:
    """Not a possible day of the form ``pattern`` (with groups y, m and d)."""
    parts = pc.extract_regex(v, pattern)
    y, m, d = (pc.fill_null(pc.cast(pc.struct_field(parts, n), pa.int32()), 0) for n in "ymd")
    if two_calendars:
        y = pc.if_else(pc.and_(pc.greater(y, 0), pc.less(y, 1911)), pc.add(y, 1911), y)
    is_by = lambda n: pc.equal(pc.subtract(y, pc.multiply(pc.divide(y, n), n)), 0)
    leap = pc.and_(is_by(4), pc.or_(pc.invert(is_by(100)), is_by(400)))
    month = pc.and_(pc.greater_equal(m, 1), pc.less_equal(m, 12))
    days = pc.take(pa.array([31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31], pa.int32()), pc.if_else(month, pc.subtract(m, 1), 0))
    days = pc.if_else(pc.and_(leap, pc.equal(m, 2)), 29, days)
    possible = pc.and_(pc.and_(month, pc.greater(y, 0)), pc.and_(pc.greater_equal(d, 1), pc.less_equal(d, days)))
    return pc.invert(possible)


def _bad_text(v: pa.Array) -> pa.Array:
    """Blank."""
    return pc.equal(pc.utf8_trim(v, _BLANKS), "")


#: Whether each cell of a column fails, as a vector.
CELLS = {
    "recno": _bad_recno,
    "date": lambda v: _bad_day(v, "^(?P<y>[0-9]{1,4})/(?P<m>[0-9]{1,2})/(?P<d>[0-9]{1,2})$", True),
    "name": _bad_text,
    "land": _bad_text,
    "gazette_id": lambda v: _bad_day(v, "^(?P<y>[0-9]{4})-(?P<m>[0-9]{2})-(?P<d>[0-9]{2})$", False),
}


def read_lines(lines: list[str]) -> tuple[pa.Table, list[int], dict[int, int]]:
    """The records of well-quoted lines, which line each came from, and the column counts of the other lines."""
    wrong: dict[int, int] = {}

    def reject(row: pacsv.InvalidRow) -> str:
        wrong[row.number - 1] = row.actual_columns
        return "skip"

    if not lines:
        return pa.table({c: pa.array([], pa.string()) for c in COLUMNS}), [], wrong
    data = "\n".join(lines).encode() + b"\n"
    table = pacsv.read_csv(
        io.BytesIO(data),
        read_options=pacsv.ReadOptions(column_names=COLUMNS, use_threads=False, block_size=max(1 << 20, len(data) + 1)),
        parse_options=pacsv.ParseOptions(delimiter="\t", newlines_in_values=True, ignore_empty_lines=False, invalid_row_handler=reject),
        convert_options=pacsv.ConvertOptions(column_types={c: pa.string() for c in COLUMNS}, strings_can_be_null=False, quoted_strings_can_be_null=False),
    )
    return table, [i for i in range(len(lines)) if i not in wrong], wrong


OUT = "line_id bigint, " + ", ".join(f"{c} string" for c in COLUMNS) + ", reasons string"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("line_id", pa.int64()), *[(c, pa.string()) for c in COLUMNS], ("reasons", pa.string())])
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        good: list[int] = []
        why: dict[int, str] = {}
        lines = []
        for i, t in enumerate(texts):
            t = (t or "").removesuffix("\r")
            if not t:
                why[i] = "columns: 1"
            elif ('"' in t or "\n" in t or "\r" in t) and not _LINE.fullmatch(t):
                why[i] = "quoting"
            else:
                good.append(i)
                lines.append(t)
        table, kept, wrong = read_lines(lines)
        why |= {good[k]: f"columns: {n}" for k, n in wrong.items()}
        table = table.combine_chunks()
        cols = {c: table.column(c).combine_chunks() if table.column(c).num_chunks != 1 else table.column(c).chunk(0) for c in COLUMNS}
        labels = pc.utf8_rtrim(pc.binary_join_element_wise(*[pc.if_else(bad(cols[c]), f"{c}；", "") for c, bad in CELLS.items()], ""), "；")
        yield pa.RecordBatch.from_arrays([pa.array([ids[good[k]] for k in kept], pa.int64()), *[cols[c] for c in COLUMNS], labels], schema=schema)
        if why:
            none = pa.nulls(len(why), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in why], pa.int64()), *[none for _ in COLUMNS], pa.array(list(why.values()), pa.string())], schema=schema)


def parse_lines(lines: DataFrame, districts: DataFrame, key: str = "line_id", line: str = "line") -> DataFrame:
    """Every line with its nine fields and ``reasons``, which is empty for a valid row.

    ``districts`` has one column of known names; it is made distinct here, and the planner broadcasts it only if its
    measured size allows.
    """
    parsed = lines.select(F.col(key).cast("bigint").alias("line_id"), F.col(line).alias("line")).mapInArrow(_parse, OUT)
    name = districts.columns[0]
    known = districts.select(F.col(name).alias("district")).where(F.col("district").isNotNull()).distinct().withColumn("known", F.lit(True))
    # A line without fields failed by its structure; its district is not judged.
    unknown = F.col("gazette_id").isNotNull() & F.col("known").isNull()
    reasons = F.concat_ws("；", F.nullif("reasons", F.lit("")), F.when(unknown, F.lit("district")))
    return parsed.join(known, "district", "left").select("line_id", *COLUMNS, reasons.alias("reasons"))


def records(parsed: DataFrame) -> DataFrame:
    """The valid rows, with ``recno`` as a number."""
    return parsed.where(F.col("reasons") == "").select("line_id", F.col("recno").cast("bigint").alias("recno"), *COLUMNS[1:])


def rejects(parsed: DataFrame) -> DataFrame:
    """The rejected lines with the reasons as ``parse_error``."""
    return parsed.where(F.col("reasons") != "").select("line_id", F.col("reasons").alias("parse_error"))
