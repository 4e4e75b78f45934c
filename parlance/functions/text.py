"""Text functions as native Column expressions (TXT1-TXT9, TXT12).

Everything except NFKC stays inside whole-stage codegen. NFKC has no JVM-side SQL
function, so it is one Arrow UDF applied in the middle of TXT4.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values (must equal the reference's behaviour) -----------------------------
# Invisible and bidirectional control characters removed before scoring:
# U+061C, U+200B, U+200C, U+200D, U+200E, U+200F, U+202A, U+202B, U+202C, U+202D,
# U+202E, U+2066, U+2067, U+2068, U+2069, U+FEFF
INVISIBLE_CHARS = (
    "\u061c"
    "\u200b\u200c\u200d\u200e\u200f"
    "\u202a\u202b\u202c\u202d\u202e"
    "\u2066\u2067\u2068\u2069"
    "\ufeff"
)
# Hebrew vowel points removed before the basic normaliser: U+05B0-U+05BC, U+05C1,
# U+05C2, U+05C7.
NIQQUD_PATTERN = "[\\u05b0-\\u05bc\\u05c1\\u05c2\\u05c7]"
# Quote characters deleted: double quote and apostrophe.
QUOTE_CHARS = "\"'"
# Basic multilingual normaliser patterns: spans in [] or <>, then spans in (),
# then Unicode categories M, S, P become a space.
BRACKET_SPAN = r"[<\[][^>\]]*[>\]]"
PAREN_SPAN = r"\(([^)]+?)\)"
MSP_CLASS = r"[\p{M}\p{S}\p{P}]"
# ASCII punctuation (Python string.punctuation) for canonicalisation; '-' maps to space.
ASCII_PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# --------------------------------------------------------------------------------------

_WS = r"(?U)\s+"


def remove_invisible(c: Column) -> Column:
    """TXT1: delete the 16 invisible/bidi characters."""
    return F.translate(c, INVISIBLE_CHARS, "")


def remove_niqqud(c: Column) -> Column:
    """TXT2: delete Hebrew vowel points."""
    return F.regexp_replace(c, NIQQUD_PATTERN, "")


def remove_quotes(c: Column) -> Column:
    """TXT3: delete double quotes and apostrophes."""
    return F.translate(c, QUOTE_CHARS, "")


#: Texts that are Python strings at a time.
SLICE = 128


@F.arrow_udf(T.StringType())
def nfkc(s: pa.Array) -> pa.Array:
    """Unicode NFKC on an Arrow batch (no JVM-side equivalent exists)."""
    return pa.concat_arrays([pa.array(
        [None if x is None else unicodedata.normalize("NFKC", x) for x in s.slice(lo, SLICE).to_pylist()], s.type)
        for lo in range(0, max(len(s), 1), SLICE)])


def basic_normalize(c: Column, use_nfkc: bool = True) -> Column:
    """TXT4: the published multilingual basic normaliser.

    lower -> drop [..]/<..> spans -> drop (..) spans -> NFKC -> M/S/P to space ->
    lower -> collapse whitespace runs to one space (no trim).
    """
    x = F.lower(c)
    x = F.regexp_replace(x, BRACKET_SPAN, "")
    x = F.regexp_replace(x, PAREN_SPAN, "")
    if use_nfkc:
        x = nfkc(x)
    x = F.regexp_replace(x, MSP_CLASS, " ")
    x = F.lower(x)
    return F.regexp_replace(x, _WS, " ")


def hebrew_normalize(c: Column, use_nfkc: bool = True) -> Column:
    """TXT5: TXT1 -> TXT2 -> TXT3 -> TXT4."""
    return basic_normalize(remove_quotes(remove_niqqud(remove_invisible(c))), use_nfkc)


def canonicalize(c: Column) -> Column:
    """TXT6: delete ASCII punctuation except '-', map '-' to space, collapse whitespace.

    Case is kept and nothing is trimmed.
    """
    no_hyphen = ASCII_PUNCT.replace("-", "")
    x = F.translate(c, no_hyphen, "")
    x = F.translate(x, "-", " ")
    return F.regexp_replace(x, _WS, " ")


def timestamp_token(seconds: Column) -> Column:
    """TXT7: seconds -> '<|x.xx|>' with half-even rounding to 0.02 s; null if outside [0, 30].

    Null marks the reference's error case; callers turn it into an error column.
    """
    s = seconds.cast("double")
    rounded = F.lit(0.02) * F.rint(s / F.lit(0.02))
    tok = F.format_string("<|%.2f|>", rounded)
    return F.when((s >= 0) & (s <= 30), tok)


def join_texts(arr: Column, sep: str = " ") -> Column:
    """TXT8: join final texts with a space, in array order."""
    return F.array_join(arr, sep)


def char_length(c: Column) -> Column:
    """TXT9: character length; null or empty -> 0."""
    return F.coalesce(F.length(c), F.lit(0)).cast("bigint")


def with_prefix_space(text: Column, has_timestamps: Column) -> Column:
    """TXT12: prefix a space only when the text carries no time markers."""
    return F.when(F.coalesce(has_timestamps, F.lit(False)), text).otherwise(F.concat(F.lit(" "), text))


def split_words(c: Column) -> Column:
    """Whitespace split of trimmed text; empty text -> empty array."""
    return F.array_remove(F.split(c, _WS), "")
