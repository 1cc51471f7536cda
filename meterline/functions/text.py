from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_whitespace(text: Column) -> Column:
    """Drop all Unicode white space and separator controls at both ends.

    ``trim`` knows only the plain blank. Most text begins and ends with a visible ASCII
    character, which is quickly seen; only the rest needs the pattern.
    """
    visible = F.ascii(text).between(33, 126) & F.ascii(F.substring(text, -1, 1)).between(33, 126)
    stripped = F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    return F.when(visible, text).otherwise(stripped)


def first_non_empty(*candidates: Column) -> Column:
    return F.coalesce(*[F.nullif(candidate, F.lit("")) for candidate in candidates])
