"""Text normalisation, canonical keys and noise values."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache, reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Entries that mean "nothing was filled in".
NOISE_VALUES = ("0", "none", "unknown", "sans marque", "sans_marque", "n/a", "na", "-", "_", "?")

# A list item that says nothing: noise, or digits only.
NOISE_ITEM = "^(?:[0-9]+|" + "|".join(re.escape(value) for value in NOISE_VALUES) + ")$"

# White space in the Unicode sense, plus the four ASCII separators.
_BLANK = r"[\s\x1c-\x1f\x85\p{Z}]"


def collapse_spaces(c: Column) -> Column:
    """Single blanks for runs of white space, none outside. Text with nothing to collapse skips the pattern."""
    found = reduce(or_, [F.contains(c, F.lit(blanks)) for blanks in ("  ", "\t", "\n", "\x0b", "\f", "\r")])
    return F.trim(F.when(found, F.regexp_replace(c, r"\s+", " ")).otherwise(c))


def normalise(c: Column) -> Column:
    """Lower case, no outer blanks, single inner blanks."""
    return F.lower(collapse_spaces(c))


def strip_blanks(c: Column) -> Column:
    return F.regexp_replace(c, f"^{_BLANK}+|{_BLANK}+$", "")


def is_filled(c: Column) -> Column:
    """True for a value that is neither NULL nor empty; never NULL itself."""
    return c.isNotNull() & (c != "")


def blank_to_null(c: Column) -> Column:
    return F.when(F.length(c) > 0, c)


@lru_cache(maxsize=1)
def _accent_map() -> tuple[str, str]:
    """Letters that reduce to one base letter, followed by the marks to delete.

    ``translate`` pairs characters by position and deletes those left without a partner, so the
    marks go last. Letters that decompose into several (Hangul syllables, a few Indic vowels) stay
    whole, which makes the better key.
    """
    letters, bases, marks = [], [], []
    for point in range(sys.maxunicode + 1):
        char = chr(point)
        base = [x for x in unicodedata.normalize("NFD", char) if not unicodedata.combining(x)]
        if not base:
            marks.append(char)
        elif len(base) == 1 and base[0] != char:
            letters.append(char)
            bases.append(base[0])
    return "".join(letters + marks), "".join(bases)


def strip_accents(c: Column) -> Column:
    """Drop diacritics. Text with one byte per character has none and skips the lookup."""
    source, target = _accent_map()
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(F.translate(c, source, target))


def canonical(c: Column) -> Column:
    """Comparable form: lower case, no accents, letters and digits separated by single blanks."""
    return F.trim(F.regexp_replace(F.lower(strip_accents(c)), r"[^\p{L}\p{N}]+", " "))


@lru_cache(maxsize=1)
def _noise_pattern() -> str:
    """Noise, digits of any script, or at most one character, whatever blanks are around it."""
    digits = "".join(
        chr(point)
        for point in range(sys.maxunicode + 1)
        if chr(point).isdigit() and unicodedata.category(chr(point)) != "Nd"
    )
    noise = "|".join(re.escape(value) for value in NOISE_VALUES)
    return rf"(?isu)^{_BLANK}*(?:{noise}|[\p{{Nd}}{digits}]+|.?){_BLANK}*$"


def noise_to_null(c: Column) -> Column:
    """Stripped lower-case text, or NULL for noise, digits only, and single characters."""
    return F.when(~c.rlike(_noise_pattern()), F.lower(strip_blanks(c)))


def preferred_name(french: Column, generic: Column, english: Column) -> Column:
    """French name if filled, else the generic one if filled, else English as it is."""
    return F.coalesce(blank_to_null(french), blank_to_null(generic), english)


def edit_distance(left: Column, right: Column, limit: int) -> Column:
    """Levenshtein distance, or NULL beyond the limit (the computation stops early there)."""
    distance = F.levenshtein(left, right, limit)
    return F.when(distance >= 0, distance)
