"""Text rules: slugs, digests, joined parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_slug(name: Column) -> Column:
    """Lower case, each run of other characters than letters, numbers and ``_`` as one dash.

    Letters and numbers of any script; marks that combine with letters are not word characters.
    """
    return F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}_]+", "-")


def digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes, in hex."""
    return F.sha2(text, 256)


def joined(*parts: Column) -> Column:
    """The parts with a comma and a space between; null if one is null."""
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit(", "), part]
    return F.concat(*pieces)
