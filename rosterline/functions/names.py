"""Text normalisation used for matching people across feeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented vowels and their plain letters.
ACCENTED = "áéíóú"
PLAIN = "aeiou"


def name_key(col: Column | str) -> Column:
    """Trimmed name with double blanks made single, in one pass."""
    col = F.col(col) if isinstance(col, str) else col
    return F.replace(F.trim(col), F.lit("  "), F.lit(" "))


def fold_accents(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.translate(col, ACCENTED, PLAIN)


def null_if(col: Column | str, sentinel: str) -> Column:
    """Null where the text is the sentinel, such as the word 'NULL'."""
    col = F.col(col) if isinstance(col, str) else col
    return F.nullif(col, F.lit(sentinel))
