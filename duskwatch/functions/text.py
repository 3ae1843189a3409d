"""Redaction markers, command tokens and message templates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blank characters of Python's str.split(): ASCII blanks, the four separators, NEL, Unicode spaces.
_BLANK = r"\s\x1c-\x1f\x85\p{Z}"


def redaction_marker(secret: Column) -> Column:
    return F.concat(F.lit("<filtered:len="), F.length(secret).cast("string"), F.lit(">"))


def redaction_length(marker: Column) -> Column:
    """N of a redaction marker, null for any other text."""
    return F.regexp_extract(marker, r"^<filtered:len=(\d+)>$", 1).try_cast("int")


def first_token(text: Column) -> Column:
    """First blank-separated token, null when there is none."""
    token = F.regexp_extract(text, f"^[{_BLANK}]*([^{_BLANK}]+)", 1)
    return F.when(token != "", token)


def fill_template(template: str, columns: dict[str, Column]) -> Column:
    """Replace ``$(name)`` by the column of that name; a null value leaves an empty text."""
    parts: list[Column] = []
    for i, piece in enumerate(re.split(r"\$\(([^)]*)\)", template)):
        if i % 2:
            parts.append(F.coalesce(columns[piece].cast("string"), F.lit("")))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)
