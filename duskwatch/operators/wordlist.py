"""Expansion of base words into a password dictionary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Suffixes and substitutions (fixed values).
NUMBER_SUFFIXES = (
    "1", "12", "123", "1234", "12345", "123456", "1234567", "12345678", "123456789", "1234567890",
)
SYMBOL_SUFFIXES = ("!", "@", "#", "!@#", "!@#$")
YEAR_SUFFIXES = tuple(str(y) for y in range(2020, 2027))
LEET = (("a", "@"), ("i", "1"), ("o", "0"), ("e", "3"), ("s", "$"))
SEPARATORS = ("", "_", "@", "/")


def _endings() -> list[str]:
    numbers = [glue + n for n in NUMBER_SUFFIXES for glue in ("", "@")]
    symbols = [s for s in SYMBOL_SUFFIXES] + ["123" + s for s in SYMBOL_SUFFIXES]
    years = list(YEAR_SUFFIXES) + ["@" + y for y in YEAR_SUFFIXES]
    return ["", *numbers, *symbols, *years]


def _leet(word: Column) -> Column:
    """Each single substitution with its capitalised form, and the full one with endings."""
    singles = []
    full = word
    for plain, sub in LEET:
        swapped = F.replace(word, F.lit(plain), F.lit(sub))
        singles.append(F.when(F.contains(word, F.lit(plain)), F.array(swapped, capitalised(swapped))))
        full = F.replace(full, F.lit(plain), F.lit(sub))
    multi = F.array(full, *[F.concat(full, F.lit(x)) for x in ("!", "1", "123")])
    return F.flatten(F.array_compact(F.array(*singles, multi)))


def capitalised(word: Column) -> Column:
    """Upper case for letters that follow a non-letter, lower case for the others."""
    marked = F.regexp_replace(F.lower(word), r"(^|[^a-z])([a-z])", "$1\u0001$2")
    pieces = F.split(marked, "\u0001")
    return F.concat_ws("", F.transform(pieces, _raise_first))


def _raise_first(piece: Column, index: Column) -> Column:
    raised = F.concat(F.upper(F.left(piece, F.lit(1))), F.right(piece, F.length(piece) - 1))
    return F.when(index == 0, piece).otherwise(raised)


def expand_wordlist(words: DataFrame, repeat: Sequence[str], leet: Sequence[str] | None = None) -> DataFrame:
    """Distinct expansions of the column ``word``.

    Endings are a fixed array, so the expansion is a flat map of each word. Word pairs are
    formed only within ``repeat``, a short fixed list, and substitutions within ``leet``
    (default: every word).
    """
    c = F.col("word")
    upper = c.rlike("^[^a-z]*[A-Z][^a-z]*$")
    endings = F.array(*[F.lit(e) for e in _endings()])
    base = words.select(c, F.explode(F.array(c, F.when(upper, c).otherwise(capitalised(c)))).alias("form"))
    suffixed = base.select(F.explode(F.transform(endings, lambda e: F.concat(F.col("form"), e))).alias("word"))
    core = words if leet is None else words.filter(c.isin(*leet))
    swapped = core.select(F.explode(_leet(c)).alias("word"))
    partners = F.array(*[F.lit(s + r) for r in repeat for s in SEPARATORS])
    pairs = words.filter(c.isin(*repeat)).select(
        F.explode(F.transform(partners, lambda p: F.concat(F.col("word"), p))).alias("word")
    )
    return suffixed.unionByName(swapped).unionByName(pairs).filter(F.trim("word") != "").distinct()
