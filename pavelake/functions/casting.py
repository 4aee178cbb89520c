"""Casts that turn bad text into NULL instead of failing the query.

The session keeps ANSI mode on. Integer text follows the older, lenient rule on purpose: a
fraction is cut off ("60.5" is 60), surrounding blanks and control characters are ignored, and
anything else, exponents and overflow included, is NULL.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

_PAD = r"[\x00-\x20\x7f]*"
_WHOLE = rf"^{_PAD}([+-]?[0-9]+)(?:\.[0-9]*)?{_PAD}$"
_FRACTION_ONLY = rf"^{_PAD}[+-]?\.[0-9]*{_PAD}$"


def lenient_int(text: Column) -> Column:
    # A failing try_cast raises and catches inside, per row. The pattern goes first, so that only
    # numbers too large for an integer get there.
    return F.when(text.rlike(_WHOLE), F.regexp_extract(text, _WHOLE, 1).try_cast("int")).when(
        text.rlike(_FRACTION_ONLY), F.lit(0)
    )


def lenient_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text)
