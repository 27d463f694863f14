"""The three rules that decide when a source value counts as absent. They differ on purpose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Space and the control characters below it.
_BLANKS = "".join(chr(i) for i in range(33))


def strip(c: Column) -> Column:
    """Drop leading and trailing characters up to U+0020."""
    return F.btrim(c, F.lit(_BLANKS))


def registry_value(c: Column) -> Column:
    """Registry file: blank or exactly `null` is absent."""
    t = strip(c)
    return F.when(~t.isin("", "null"), t)


def markup_value(c: Column) -> Column:
    """XML: only blank is absent; the word null is a value."""
    return F.nullif(strip(c), F.lit(""))


def flat_file_value(c: Column) -> Column:
    """Flat files: blank, a lone dot, or null in any case is absent."""
    t = strip(c)
    return F.when(~F.lower(t).isin("", "null", "."), t)
