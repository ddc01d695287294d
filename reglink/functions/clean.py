"""Scalar cleaning functions (Column -> Column), all JVM built-ins.

Java regexes need ``(?U)`` so that ``\\s``/``\\w`` are Unicode-aware like
Python's ``re`` on ``str``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reglink import constants as C
from reglink.functions.util import as_col


def clean_name(c) -> Column:
    """lower -> delete every char that is not a-z or whitespace -> collapse
    whitespace to one space -> trim.  Deletes rather than replaces, so
    ``O'Neil-Smith 2nd`` becomes ``oneilsmith nd``; null stays null."""
    c = as_col(c)
    # Python's whitespace also covers U+001C..U+001F, Java's (?U)\s does not
    kept = F.regexp_replace(F.lower(c), r"(?U)[^a-z\s\x{1C}-\x{1F}]", "")
    return F.trim(F.regexp_replace(kept, r"(?U)[\s\x{1C}-\x{1F}]+", " "))


# Python's ``\w`` is letters, numbers and '_' (no combining marks, unlike
# Java's ``(?U)\w``), so the word class is spelt out.
WORD = r"\p{L}\p{N}_"


def strip_punct(c) -> Column:
    """Remove every char that is neither a word char nor whitespace."""
    return F.regexp_replace(as_col(c), rf"(?U)[^{WORD}\s\x{{1C}}-\x{{1F}}]", "")


def concat_address(*cols) -> Column:
    """Join the non-null parts with ``,`` (empty strings are kept)."""
    return F.concat_ws(C.ADDRESS_SEPARATOR, *[as_col(c) for c in cols])


def blank_to_empty(c) -> Column:
    """Null -> '' (the register's ISNULL(x, ''))."""
    return F.coalesce(as_col(c), F.lit(""))
