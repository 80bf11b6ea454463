"""Text cleansing expressions for raw order files.

Bad text turns into NULL instead of an error, so that the quality rules can
name the reason.  ``try_*`` functions are used here only; the rest of the
library keeps ANSI errors visible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings, dash characters and date layouts.
TRUE_WORDS = ["TRUE", "T", "YES", "Y", "1"]
FALSE_WORDS = ["FALSE", "F", "NO", "N", "0"]
DASHES = "‒–—−"
DATE_PATTERNS = ["M/d/yy", "dd-MM-yyyy", "M/d/yyyy", "MM-dd-yyyy"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_urls(c: Column | str) -> Column:
    """Remove web addresses and the blanks around what is left."""
    return F.trim(F.regexp_replace(_col(c), r"https?://\S+", ""))


def cap(c: Column | str, limit: int) -> Column:
    """Keep at most ``limit`` leading characters."""
    return F.substring(_col(c), 1, limit)


def parse_bool(c: Column | str) -> Column:
    """Read yes/no spellings; unknown words become NULL."""
    word = F.upper(_col(c))
    return (
        F.when(word.isin(TRUE_WORDS), True)
        .when(word.isin(FALSE_WORDS), False)
        .otherwise(_col(c).try_cast("boolean"))
    )


def parse_money(c: Column | str) -> Column:
    """Read an amount: any dash as minus, no ``$`` or ``,``, ``(x)`` as ``-x``."""
    ascii_text = F.trim(F.translate(_col(c), DASHES + "$,", "-" * len(DASHES)))
    signed = F.regexp_replace(ascii_text, r"^\((.*)\)$", r"-$1")
    return F.when(signed.rlike(r"^-?\d+(\.\d+)?$"), signed).try_cast("decimal(10,2)")


def mask_card(c: Column | str) -> Column:
    """Replace every digit that still has four digits after it, dashed or not."""
    return F.regexp_replace(_col(c), r"\d(?=(?:\D*\d){4})", "X")


def parse_date(c: Column | str, patterns: Sequence[str] = DATE_PATTERNS) -> Column:
    """First pattern that reads the text wins; day-first before month-first."""
    return F.coalesce(*[F.try_to_date(_col(c), p) for p in patterns])


def parse_timestamp(c: Column | str) -> Column:
    return F.try_to_timestamp(_col(c))


def parse_int(c: Column | str) -> Column:
    return _col(c).try_cast("int")


def fingerprint(*cols: Column | str) -> Column:
    """sha2-256 over columns, with NULL kept apart from empty text."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("∅")) for c in cols]
    return F.sha2(F.concat_ws("|", *parts), 256)
