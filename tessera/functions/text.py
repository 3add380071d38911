"""Text functions over columns: markup, tokens, tags, families, edit distance."""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

# Character ranges, control tags, emotion families, non-speech events, marks of existing control tags.
CJK = "㐀-䶿一-鿿豈-﫿"
SPEED_TAGS = ("speed_slow", "speed_normal", "speed_fast")
EFFORT_TAGS = ("effort_soft", "effort_normal", "effort_strong")
CONTROL_TAGS = SPEED_TAGS + EFFORT_TAGS
FAMILIES = ("neutral", "happy", "sad", "angry", "fear", "surprise", "disgust", "calm")
EVENTS = "breath hold clucking cough cry crying fizz gasp hush laugh laughter pant panting scream sigh sing sob sneezing whisper yawn".split()
HELD_TAG = "(?i)【(?:speed|effort|volume)(?:_[^】]*)?】|【loud】"

TOKEN = f"[{CJK}]|[A-Za-z0-9]+"
_EDGE = "[\\s\\x1c-\\x1f]"


def text(c) -> Column:
    """The column as a string, null as empty."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    """Without white space at both ends, of any script."""
    return F.regexp_replace(c, f"(?U)^{_EDGE}+|{_EDGE}+$", "")


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Compatibility composition; the JVM functions have none. ASCII passes as it is."""
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def without_markup(c: Column) -> Column:
    for mark in ("【[^】]+】", "\\[[^\\]]+\\]", "</?[^>]+>"):
        c = F.regexp_replace(c, mark, "")
    return strip(c)


def clean_spoken_text(c) -> Column:
    """Composed text without tags; words inside angle tags stay."""
    return without_markup(nfkc(text(c)))


def normalized(c: Column) -> Column:
    """Lower-cased tokens in a row, of text that is clean already."""
    return F.regexp_replace(F.lower(c), f"[^{CJK}A-Za-z0-9]+", "")


def spoken_units(c: Column) -> Column:
    """Tokens of clean text: each CJK character, each ASCII word."""
    return F.regexp_extract_all(c, F.lit(TOKEN), F.lit(0))


def count_units(c: Column) -> Column:
    return F.regexp_count(c, F.lit(TOKEN)).cast("long")


def lexical_characters(c: Column) -> Column:
    """Single lexical characters of clean text with their normal form."""
    return F.transform(F.regexp_extract_all(c, F.lit(f"[{CJK}A-Za-z0-9]"), F.lit(0)), lambda x: F.struct(x.alias("character"), F.lower(x).alias("normalized_character")))


def emotion_tags(c) -> Column:
    """Tags in corner brackets, in order, without control tags."""
    tags = F.transform(F.regexp_extract_all(text(c), F.lit("【([^】]+)】"), F.lit(1)), lambda t: F.lower(strip(t)))
    return F.filter(tags, lambda t: (t != "") & ~t.startswith("speed_") & ~t.startswith("effort_"))


def emotion_family(c) -> Column:
    """The one family that tags begin with; else transition (several tags), other (one) or no_emotion."""
    tags = emotion_tags(c)
    found = F.filter(F.array(*map(F.lit, FAMILIES)), lambda f: F.exists(tags, lambda t: t.startswith(f)))
    return F.when(F.size(tags) == 0, "no_emotion").when(F.size(found) == 1, F.get(found, F.lit(0))).when(F.size(tags) > 1, "transition").otherwise("other")


def strip_emotion_tags(c, tags: list[str]) -> Column:
    """Without the named tags in corner brackets; other markup stays."""
    wanted = sorted({t.strip().lower() for t in tags if t.strip()})
    if not wanted:
        return strip(text(c))
    pieces = "|".join("\\Q" + t.replace("\\E", "\\E\\\\E\\Q") + "\\E" for t in wanted)
    return strip(F.regexp_replace(text(c), f"(?iU)【\\s*(?:{pieces})\\s*】", ""))


def event_tags(c) -> Column:
    """Square tags, and angle tags that name a known event; sorted, each once."""
    square = F.transform(F.regexp_extract_all(text(c), F.lit("\\[([^\\]]+)\\]"), F.lit(1)), lambda t: F.lower(strip(t)))
    angle = F.transform(F.regexp_extract_all(text(c), F.lit("<\\s*([A-Za-z][A-Za-z0-9_-]*)\\b[^>]*>"), F.lit(1)), lambda t: F.lower(t))
    return F.array_sort(F.array_union(F.filter(square, lambda t: t != ""), F.filter(angle, lambda t: t.isin(EVENTS))))


def event_count(c, event: str) -> Column:
    """How often a square tag names the event."""
    return F.size(F.filter(F.regexp_extract_all(text(c), F.lit("\\[([^\\]]+)\\]"), F.lit(1)), lambda t: F.lower(strip(t)) == event)).cast("long")


def has_control_tag(c) -> Column:
    return text(c).rlike(HELD_TAG)


def add_control_tags(c, *tags: str) -> Column:
    """The text behind its control tags."""
    unknown = [t for t in tags if t not in CONTROL_TAGS]
    if unknown:
        raise ValueError(f"unsupported control tags: {unknown}")
    return F.concat(F.lit("".join(f"【{t}】" for t in tags)), strip(text(c)))


def matches_proxy(c, prefixes: list[str]) -> Column:
    """Whether the text has exactly one emotion tag and it begins with a prefix."""
    tags = emotion_tags(c)
    if not prefixes:
        return F.lit(False)
    begins = F.exists(F.array(*map(F.lit, prefixes)), lambda p: F.get(tags, F.lit(0)).startswith(p))
    return F.when(F.size(tags) == 1, begins).otherwise(False)


def is_cjk_only(c: Column) -> Column:
    """At least one CJK character and beside them only white space and punctuation."""
    return c.rlike(f"[{CJK}]") & c.rlike(f"(?U)^[{CJK}\\s\\p{{P}}]*$")


def edit_distance(a: str, b: str) -> int:
    """Edit distance of code points by bit vectors (Hyyrö 2003): a column of the matrix is two numbers as long as the longer text, and a character of the shorter one takes 16 operations on them."""
    if len(a) < len(b):
        a, b = b, a
    if not b or a == b:
        return len(a) if not b else 0
    codes = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = sorted(set(b))
    at_once = max(1, (1 << 22) // len(a))  # the places of letters take a byte a place before they are packed
    places: dict[str, int] = {}
    for k in range(0, len(letters), at_once):
        some = letters[k : k + at_once]
        packed = np.packbits(codes == np.array([[ord(c)] for c in some], np.uint32), axis=1, bitorder="little")
        places |= {c: int.from_bytes(row.tobytes(), "little") for c, row in zip(some, packed, strict=True)}
    ones = (1 << len(a)) - 1
    up, down = ones, 0
    for k in range(0, len(b), 1024):
        for c in b[k : k + 1024]:
            same = places[c]
            diagonal = (((same & up) + up) ^ up) | same | down
            right = ((down | ((diagonal | up) ^ ones)) << 1) | 1
            up, down = ((diagonal & up) << 1) | ((diagonal | right) ^ ones), diagonal & right
        up, down = up & ones, down & ones  # bits past the end never come back, they only take room
    return len(b) + up.bit_count() - down.bit_count()


@F.pandas_udf(LongType())
def levenshtein(a: pd.Series, b: pd.Series) -> pd.Series:
    """edit_distance by row; Spark's own takes a step for every pair of characters."""
    return pd.Series([None if x is None or y is None else edit_distance(x, y) for x, y in zip(a, b, strict=True)], dtype="Int64")


def character_error_rate(reference: Column, hypothesis: Column) -> Column:
    """Edit distance over the reference's length; null for an empty reference."""
    return F.try_divide(levenshtein(reference, hypothesis).cast("double"), F.nullif(F.char_length(reference), F.lit(0)).cast("double"))


def duration_bin(seconds: Column) -> Column:
    return F.when(seconds < 3, "short").when(seconds < 8, "medium").otherwise("long")


def requested_language(c: Column) -> Column:
    """The language asked for; null for automatic."""
    low = F.lower(strip(text(c)))
    return F.when(low.isin("", "auto", "none"), None).otherwise(low)
