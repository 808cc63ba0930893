"""String cleaning and label predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from seriesmill.schema import NULL_TOKENS

# All characters that count as white space in Unicode, with the ASCII separators.
WHITE_SPACE = "".join(
    chr(code)
    for code in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def null_if_token(text: Column, tokens: Sequence[str] = tuple(NULL_TOKENS)) -> Column:
    """NULL for tokens that stand for a missing value."""
    return F.when(~text.isin(list(tokens)), text)


def has(text: Column, *parts: str) -> Column:
    """Case-insensitive match of the parts in the given order."""
    return text.ilike("%" + "%".join(parts) + "%")


def same_label(text: Column, label: str) -> Column:
    """P10: case-insensitive equality."""
    return text.ilike(label)


def none_of(text: Column, labels: Sequence[str], trimmed: bool = False) -> Column:
    """NOT IN; a NULL label does not pass."""
    return ~(F.trim(text) if trimmed else text).isin(list(labels))


def short_region(region: Column) -> Column:
    """Map council-area spellings to the short spelling that the dashboard uses."""
    plain = F.regexp_replace(region, " Region$", "")
    return F.translate(plain, "ā ē ī ō ū Ā Ē Ī Ō Ū".replace(" ", ""), "aeiouAEIOU")
