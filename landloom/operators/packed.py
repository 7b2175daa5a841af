"""Several values packed in one field: one row per value, with its position.

Quoted and bracketed spans are replaced by indexed placeholders, the rest is split at the delimiters, the
spans are put back by array lookup and the items exploded with their positions. Everything is a column
expression; only the NFKC step before it runs in Python.

The placeholder is ``\\ue000<index>\\ue001``. Both are private-use characters; where a value already holds
one of them it is doubled (``\\ue000`` -> ``\\ue000\\ue002``) before and undone after, so no text collides.

Defined cases: null, empty and all-delimiter fields give no rows; an unclosed quote or bracket is ordinary
text; empty items are skipped and not counted; repeated rows and values are kept; further columns of the
input are ignored except the named keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import nfkc

OPEN, CLOSE, ESC = "\ue000", "\ue001", "\ue002"
QUOTED = r'"(?:[^"]|"")*"'
BRACKETED = r"\([^()]*\)"
#: Marks that separate items, in NFKC form (the half-width comma is 、 there).
ITEM_MARKS = r"[|、,;/\s\[\]{}]|及|與"


def _escape(c: Column) -> Column:
    return F.regexp_replace(c, f"([{OPEN}{CLOSE}])", f"$1{ESC}")


def _unescape(c: Column) -> Column:
    return F.regexp_replace(c, f"([{OPEN}{CLOSE}]){ESC}", "$1")


def _protect(c: Column, spans: str) -> Column:
    """``c`` with its k-th span replaced by the placeholder of index k."""
    pieces = F.split(c, spans, -1)
    return F.array_join(
        F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit(OPEN), (i - 1).cast("string"), F.lit(CLOSE), p))),
        "",
    )


def _restore(item: Column, spans: Column) -> Column:
    """An item's placeholders replaced by their spans: text before the first mark, then span and text by turns."""
    parts = F.split(item, f"{OPEN}(?!{ESC})", -1)
    return F.array_join(
        F.transform(
            parts,
            lambda p, i: F.when(i == 0, p).otherwise(
                F.concat(
                    F.get(spans, F.substring_index(p, CLOSE, 1).cast("int")),
                    F.substring(p, F.length(F.substring_index(p, CLOSE, 1)) + F.lit(2), F.lit(2147483647)),
                )
            ),
        ),
        "",
    )


def _unquote(item: Column) -> Column:
    """Enclosing quotes dropped, also where a note follows them; doubled quotes inside become one."""
    inner = F.regexp_replace(item, r'^"((?:[^"]|"")*)"', "$1")
    return F.when(item.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(item)


def split_items(c: Column, marks: str = ITEM_MARKS, protect: str = f"{QUOTED}|{BRACKETED}") -> Column:
    """Array of the items of a packed text already in NFKC form, without empty ones, in order."""
    safe = F.regexp_replace(_escape(c), r"\s+(?=\()", "")
    spans = F.regexp_extract_all(safe, F.lit(f"({protect})"), F.lit(1))
    items = F.split(_protect(safe, protect), marks, -1)
    done = F.transform(items, lambda x: F.trim(_unescape(_unquote(F.trim(_restore(x, spans))))))
    return F.filter(done, lambda x: x != "")


def land_items(c: Column) -> Column:
    """The parcel numbers of a land cell: the place in front and the closing words are cut off first."""
    c = F.regexp_replace(c, r'^[^"(\[]*段', "")
    c = F.regexp_replace(c, r'^[^0-9"(\[]+', "")
    c = F.regexp_replace(c, r"\s*(?:地號)?\s*(?:等\s*[0-9]+\s*筆)?\s*(?:土地)?\s*$", "")
    return split_items(c)


def alias_items(c: Column) -> Column:
    """``parcel:alias`` items of an alias cell.

    Entries come as ``a:b,c;d:e``, ``a=b、c``, ``a->b/c``, ``a(b,c)`` or a JSON object, whole entries quoted or not.
    Quoted spans are replaced by placeholders before the cell is split, so what is quoted stays one piece, whatever
    marks it holds; put back, a quoted number or name is a token as it is, and a quoted entry (with a key mark inside)
    is split as an entry of its own. A token that ends with a key mark names the parcel of the tokens after it.
    """
    c = F.regexp_replace(_escape(c), r"->|=", ":")
    spans = F.regexp_extract_all(c, F.lit(f"({QUOTED})"), F.lit(1))
    marks = r"[|、,;/\s\[\]{})]+"
    keyed = lambda x: F.regexp_replace(F.regexp_replace(x, r"\(", ":"), r"\s*:\s*", ": ")
    pieces = F.split(keyed(_protect(c, QUOTED)), marks, -1)
    whole = F.transform(pieces, lambda x: _unescape(_restore(x, spans)))
    atom = r'^"[^":]*":?$'
    tokens = F.flatten(F.transform(whole, lambda x: F.when(x.rlike(atom), F.array(F.replace(x, F.lit('"'), F.lit("")))).otherwise(F.split(keyed(F.replace(x, F.lit('"'), F.lit(" "))), marks, -1))))
    tokens = F.filter(tokens, lambda x: (x != "") & (x != ":"))
    start = F.struct(F.lit("").alias("key"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(
        tokens,
        start,
        lambda acc, t: F.when(t.endswith(":"), F.struct(F.rtrim(F.regexp_replace(t, ":$", "")).alias("key"), acc["out"].alias("out"))).otherwise(
            F.struct(acc["key"].alias("key"), F.concat(acc["out"], F.array(F.concat(acc["key"], F.lit(":"), F.trim(t)))).alias("out"))
        ),
        lambda acc: acc["out"],
    )


FORMS = {"items": split_items, "land": land_items, "aliases": alias_items}


def unpack(df: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
    """(``key``, field, pos, value) of each packed value. ``fields`` maps a column to its form in ``FORMS``.

    One pass over the table and no shuffle: the fields are turned into one array of (field, items) and exploded.
    """
    text = df.select(F.col(key), *[nfkc(F.col(f)).alias(f"_t{i}") for i, f in enumerate(fields)])
    packed = [F.struct(F.lit(f).alias("field"), FORMS[form](F.col(f"_t{i}")).alias("items")) for i, (f, form) in enumerate(fields.items())]
    per_field = text.select(key, F.explode(F.array(*packed)).alias("f"))
    return per_field.select(key, F.col("f.field").alias("field"), F.posexplode("f.items").alias("p", "value")).select(
        key, "field", (F.col("p") + 1).alias("pos"), "value"
    )
