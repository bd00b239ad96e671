"""Hash surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a NULL part contributes to a key.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column) -> Column:
    """md5 of the columns as text joined by '-', so (a, NULL) and (NULL, a) differ."""
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_PART)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


# More bytes than a digest has, so that the two forms of a packed key never meet.
_PAD = 17


def packed_key(key: Column) -> Column:
    """A text key as bytes, for shuffles and scratch files: the 16 that 32 hex digits stand for, any other text with
    17 zero bytes behind it. Different keys stay different; NULL stays NULL."""
    text = F.concat(key.cast("binary"), F.lit(bytes(_PAD)))
    digest = F.when((F.octet_length(key) == 32) & (F.lower(key) == key), F.unhex(key))
    return F.coalesce(digest, text)


def unpacked_key(key: Column) -> Column:
    """The text of a packed key."""
    size = F.octet_length(key)
    text = F.substring(key, F.lit(1), size - _PAD).cast("string")
    return F.when(size < _PAD, F.lower(F.hex(key))).otherwise(text)
