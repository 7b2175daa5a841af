"""Text normal forms. Spark has no Unicode normalisation, so that one step is an Arrow UDF; the rest stays in the JVM."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _nfkc(s):
    # ASCII is its own normal form.
    return s if s is None or s.isascii() else unicodedata.normalize("NFKC", s)


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """NFKC form of each value; null stays null, an empty text stays empty."""
    return pd.Series([_nfkc(x) for x in s], dtype=object)


WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "\u3000\uff64"
NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " \u3001"
#: The code points of Unicode's White_Space property and of Python's str.isspace, as a Java character class.
SPACE = r"\t-\r\x1c-\x20\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def fold_width(c: Column) -> Column:
    """Full-width ASCII, the ideographic space and the half-width comma folded, in the JVM."""
    return F.translate(c, WIDE, NARROW)


def no_space(c: Column) -> Column:
    """Without white space in the Unicode sense."""
    return F.regexp_replace(c, f"[{SPACE}]+", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))
