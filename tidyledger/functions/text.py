"""Category text: cleaning and typo correction."""

from __future__ import annotations

import re
from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as blanks around a category (fixed values): the Unicode
# space separators. Tabs and line breaks are not among them.
SPACE_SEPARATORS = " \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000"

# Customer tiers and the misspellings that are corrected (fixed values).
TIERS = ("standard", "premium", "platinum")
TYPOS = {"standrad": "standard", "premuim": "premium", "platnum": "platinum"}


def clean_text(text: Column) -> Column:
    """Lower case without blanks at either end.

    Each letter is lowered on its own: a final sigma stays a plain one, and a
    dotted capital I gives a plain i.
    """
    is_ascii = F.octet_length(text) == F.char_length(text)
    other = F.translate(F.btrim(text, F.lit(SPACE_SEPARATORS)), "İΣ", "iσ")
    return F.lower(F.when(is_ascii, F.trim(text)).otherwise(other))


def strip_first_non_letter(text: Column) -> Column:
    """``text`` without its first character outside a-z; later ones stay."""
    return F.regexp_replace(text, "^([a-z]*+)[^a-z]", "$1")


def map_typos(
    cleaned: Column,
    typos: Mapping[str, str] = TYPOS,
    known: tuple[str, ...] = TIERS,
) -> Column:
    """The right spelling of a known misspelling, else the text itself.

    One stray character is ignored in the comparison only: a text that is no
    known misspelling comes back whole. Texts that are right already skip the
    regular expression, which is nearly every row of a large table.
    """
    table = F.create_map(*(F.lit(word) for word in chain.from_iterable(typos.items())))
    corrected = F.try_element_at(table, strip_first_non_letter(cleaned))
    skip = [word for word in known if re.fullmatch("[a-z]+", word) and word not in typos]
    return F.when(cleaned.isin(skip), cleaned).otherwise(F.coalesce(corrected, cleaned))
