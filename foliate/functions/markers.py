"""Column functions on response-sheet lines, scripts and geometry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliate.functions.text import has, part, strip

# --- fixed values -----------------------------------------------------------------
CHOSEN = r"(?i)Chosen\s+Option\s*:\s*([A-Da-d1-4\-]+)?"
CHOSEN_INSTRUCTION = r"(?i)chosen\s+option\s+(?:on\s+the\s+(?:right|left)|indicates|means|shows|represents)"
SHEET_INSTRUCTION = r"(?i)(?:options?\s+shown\s+in\s+green|tick\s+icon\s+are\s+correct|correct\s+answer\s+will\s+carry)"
STATUS = r"(?i)Status\s*:\s*(Answered|Not\s+Answered)"
INSTRUCTION_PHRASES = ("on the right", "on the left", "indicates the option", "selected by the candidate")
NO_CHOICE = ("--", "-", "NA", "N/A")
DIGIT_KEYS = ("1234", "ABCD")


def is_chosen_instruction(text: Column) -> Column:
    """A direction about the chosen option, not a candidate's choice."""
    bare = strip(text)
    low = F.lower(bare)
    phrased = low.contains("chosen option") & ~bare.contains(":")
    some = F.lit(False)
    for phrase in INSTRUCTION_PHRASES:
        some = some | low.contains(phrase)
    return has(bare, CHOSEN_INSTRUCTION) | has(bare, SHEET_INSTRUCTION) | (phrased & some)


def is_chosen_metadata(text: Column) -> Column:
    """A row such as ``Chosen Option : 2``."""
    bare = strip(text)
    return (bare != "") & ~is_chosen_instruction(text) & (has(bare, CHOSEN) | (F.lower(bare).contains("chosen option") & bare.contains(":")))


def chosen_key(text: Column) -> Column:
    """The chosen option as A-D; null without one."""
    raw = strip(part(text, CHOSEN))
    one = F.when((F.char_length(raw) == 1) & ~raw.isin(*NO_CHOICE), F.translate(F.upper(raw), *DIGIT_KEYS))
    return F.when(one.rlike("^[A-D]$"), one)


def language_profile(texts: Column) -> Column:
    """mixed, hindi, english or unknown from the scripts in an array of texts."""
    devanagari = F.exists(texts, lambda t: t.rlike(r"[ऀ-ॿ]"))
    latin = F.exists(texts, lambda t: t.rlike("[A-Za-z]"))
    return F.when(devanagari & latin, "mixed").when(devanagari, "hindi").when(latin, "english").otherwise("unknown")


def bounding_box(polygon: Column) -> Column:
    """[left, top, right, bottom] of a flat list of x, y pairs; null for fewer than two points."""
    at = F.transform(polygon, lambda v, i: F.struct(v.alias("v"), (i % 2).alias("axis")))
    xs = F.transform(F.filter(at, lambda p: p["axis"] == 0), lambda p: p["v"])
    ys = F.transform(F.filter(at, lambda p: p["axis"] == 1), lambda p: p["v"])
    return F.when(F.size(polygon) >= 4, F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)))


def overlap(first: Column, second: Column) -> Column:
    """Shared tokens over the tokens of the first text."""
    tokens = lambda t: F.array_distinct(F.regexp_extract_all(F.lower(t), F.lit(r"(?U)(\w+)"), F.lit(1)))
    own = tokens(first)
    return F.when(F.size(own) == 0, 0.0).otherwise(F.size(F.array_intersect(own, tokens(second))) / F.size(own))
