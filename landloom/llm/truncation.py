"""Text cut off by field limits.

Each value is read once, character by character, by a stack automaton that pushes open brackets, quotes, elements and
unfinished tags, entities and escapes, and ends in one of a few conditions: something replaced the end (an ellipsis, a broken multibyte sequence), a bracket, quote, tag or escape is
still open, the value stops inside a unit of its field's grammar, it ends with a terminator, or it ends cleanly
without one. What a missing terminator means depends on the source: where more than ``bare_share`` of a source's
clean values end without one, they are its complete short form; elsewhere they are cut. The baseline is taken over
all rows of the source.

Defined cases: null and blank values, and values without any content of the field's kind (placeholders), are not
cut; complete short forms are not; repeated rows each count; a source with no values has no share.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.moments import readings
from ..runtime import materialize

PAIRS = {")": "(", "]": "[", "}": "{", "」": "「", "』": "『", "》": "《", "〉": "〈", "】": "【", "”": "“", "’": "‘"}
OPENERS = frozenset(PAIRS.values())
#: A value without any of these has no structure to be left open.
STRUCTURE = re.compile(r'[(\[{「『《〈【“‘"<&%\\]')
#: Elements without an end tag, a fixed list of the markup language.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HEX = frozenset("0123456789abcdefABCDEF")
REPLACED = re.compile(r"(?:�|…|\.\.\.|‥)+\s*$")

#: Ends of a complete land cell and of a complete case name, in NFKC form without white space.
LAND_END = re.compile(r"(?:地號(?:等[0-9]+筆)?(?:土地)?|等[0-9]+筆(?:土地)?|筆土地|土地|[^0-9、,]用地|住宅專區|專區)$")
LAND_BARE = re.compile(r"(?:[0-9]+(?:-[0-9]+)?|\([^()]*\))$")
LAND_COUNT = re.compile(r"等[0-9]*$")
NAME_END = re.compile(r"(?:案|計[畫劃])(?:\([^()]*\))?$")


def open_structure(text: str) -> str:
    """What is still open at the end: a bracket, a quote, an element, '<' for a tag or 'escape' for an escape or entity; empty if nothing is.

    The stack holds what is open; its top decides how a character is read. A mark of inches behind a number opens no
    quote, nor does a percent sign there at the end begin an escape, and a closing mark that nothing opened is text.
    """
    if not STRUCTURE.search(text):
        return ""
    stack: list[str] = []
    word = ""  # of the tag, entity or escape being read
    before, plain = "", False
    for c in text:
        top = stack[-1] if stack else ""
        if top == "<":
            if c == ">":
                stack.pop()
                name = re.match(r"/?([A-Za-z][A-Za-z0-9]*)", word)
                if name and word[0] == "/":
                    if f"<{name[1]}>" in stack:
                        del stack[len(stack) - 1 - stack[::-1].index(f"<{name[1]}>") :]
                elif name and not word.endswith("/") and name[1].lower() not in VOID:
                    stack.append(f"<{name[1]}>")
            elif c == "<" or not word and not (c.isalpha() and c.isascii() or c in "/!"):
                stack.pop()  # it was no tag
                if c == "<":
                    stack.append(c)
                word = ""
            else:
                word += c
        elif top == "&":
            if c == ";" or len(word) > 7 or not (c.isascii() and c.isalnum() or c == "#" and not word):
                stack.pop()
            word += c
        elif top in ("\\", "%"):
            need = {"u": 4, "x": 2}.get(word[:1], 0) + 1 if top == "\\" else 2
            if (word or top == "%") and c not in HEX:
                stack.pop()  # not an escape after all
            else:
                word += c
                need = {"u": 5, "x": 3}.get(word[0], 1) if top == "\\" else need
                if len(word) >= need:
                    stack.pop()
        elif c in OPENERS:
            stack.append(c)
        elif c in PAIRS:
            if top == PAIRS[c]:
                stack.pop()
        elif c == '"':
            if top == c:
                stack.pop()
            elif not (before.isdigit() and c not in stack):
                stack.append(c)
        elif c in "<&%\\":
            stack.append(c)
            word, plain = "", c == "%" and before.isdigit() or c == "&" and before == " "
        before = c
    top = stack[-1] if stack else ""
    if not word and (top == "<" or top in ("%", "&") and plain):
        stack.pop()  # a bare sign at the end
        top = stack[-1] if stack else ""
    return "escape" if top in ("&", "\\", "%") else top


@lru_cache(maxsize=1)
def _date_grammar():
    import regex

    m, d = "(?:0?[1-9]|1[0-2])", "(?:0?[1-9]|[12][0-9]|3[01])"
    time = r"(?:[T ](?:上午|下午)?[0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]+)?)?(?: ?[AP]M)?(?:Z|[+-][0-9]{2}:?[0-9]{2}|\[[A-Za-z/_]+\]| [A-Z]{3,4})?)?"
    han = "[〇零元一二三四五六七八九十百]+"
    mon = "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
    forms = [
        *(f"[0-9]{{2,4}}{s}{m}{s}{d}{time}" for s in (r"/", r"\.", "-")),
        f"(?:中華民國|民國)?(?:[0-9]{{1,4}}年{m}月{d}日|{han}年{han}月{han}日)",
        f"(?:19|20)[0-9]{{2}}(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])(?:T[0-9]{{6}})?",
        f"{d} {mon} [0-9]{{4}}",
        f"{mon} {d}, [0-9]{{4}} [0-9]{{1,2}}:[0-9]{{2}}:[0-9]{{2}} [AP]M [A-Z]{{3,4}}",
        "1[0-9]{12}",
    ]
    return regex.compile("|".join(f"(?:{f})" for f in forms))


def date_end(text: str) -> str:
    """'inside' for a value that is only the beginning of a date, else 'closed'."""
    if readings(text, "UTC"):
        return "closed"
    m = _date_grammar().fullmatch(text, partial=True)
    return "inside" if m and m.partial and text else "closed"


def land_end(text: str) -> str:
    if LAND_END.search(text):
        return "closed"
    if LAND_COUNT.search(text) or not LAND_BARE.search(text):
        return "inside"
    # Numbers ascend; a last one that falls back is the beginning of a longer one.
    body = re.sub(r"\([^()]*\)", "", text)[text.rfind("段") + 1 :] if "(" not in text else re.sub(r"\([^()]*\)", "", text[text.rfind("段", 0, text.find("(")) + 1 :])
    main = [int(x) for x in re.findall(r"([0-9]+)(?:-[0-9]+)?", body)]
    return "inside" if len(main) > 1 and main[-1] < main[-2] else "bare"


def name_end(text: str) -> str:
    return "closed" if NAME_END.search(text) else "bare"


ENDS = {"land": land_end, "name": name_end, "date": date_end}
#: What a value must hold to be more than a placeholder.
CONTENT = {"land": re.compile(r"[市區段0-9]"), "name": re.compile(r"[擬變訂更市區段案]"), "date": re.compile(r"[0-9年國]|^(?:中華|民)|[A-Z][a-z]{2}\b")}


def condition(value: str | None, kind: str) -> str | None:
    """replaced, open, inside, bare or closed; null where there is nothing to judge."""
    if value is None:
        return None
    text = " ".join(unicodedata.normalize("NFKC", value).split())
    if not text:
        return None
    bare_text = REPLACED.sub("", text)
    if not CONTENT[kind].search(bare_text):
        return None
    if REPLACED.search(text) or REPLACED.search(value):
        return "replaced"
    if open_structure(text):
        return "open"
    return ENDS[kind](text if kind == "date" else text.replace(" ", ""))


def conditions(df: DataFrame, key: str, source: str, fields: dict[str, str]) -> DataFrame:
    """(``key``, ``source``, field, condition) of every value; ``fields`` maps a column to its kind."""
    kinds = list(fields.values())

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def judge(*columns: pd.Series) -> pd.Series:
        return pd.Series([[condition(v, k) for v, k in zip(row, kinds)] for row in zip(*columns)])

    judged = df.select(key, source, judge(*[F.col(c).cast("string") for c in fields]).alias("c"))
    pairs = F.explode(F.arrays_zip(F.array(*[F.lit(c) for c in fields]).alias("field"), F.col("c").alias("condition"))).alias("p")
    return judged.select(key, source, pairs).select(key, source, F.col("p.field").alias("field"), F.col("p.condition").alias("condition")).where("condition is not null")


def truncated(df: DataFrame, key: str, source: str, fields: dict[str, str], bare_share: float = 0.2) -> DataFrame:
    """The judged values with ``cut``. The baseline has one row per source and field."""
    # Judged once: the baseline and the verdict read the same small table.
    judged = materialize(conditions(df, key, source, fields), "judged")
    clean = F.col("condition").isin("closed", "bare")
    base = judged.groupBy(source, "field").agg((F.count_if(F.col("condition") == "bare") / F.greatest(F.count_if(clean), F.lit(1))).alias("share"))
    base = base.select(F.col(source).alias("_source"), F.col("field").alias("_field"), "share")
    joined = judged.join(base, F.col(source).eqNullSafe(F.col("_source")) & (F.col("field") == F.col("_field")))
    cut = F.col("condition").isin("replaced", "open", "inside") | ((F.col("condition") == "bare") & (F.col("share") <= bare_share))
    return joined.select(key, source, "field", "condition", cut.alias("cut"))


def cut_shares(judged: DataFrame, source: str) -> DataFrame:
    """(``source``, field, values, cut, share): how often each source truncates."""
    return judged.groupBy(source, "field").agg(F.count("*").alias("n_values"), F.count_if("cut").alias("n_cut")).withColumn("share", F.col("n_cut") / F.col("n_values"))
