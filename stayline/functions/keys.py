"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They are part of every stored key, so they must not change.
NULL_COMPONENT = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"


def surrogate_key(*columns: str | Column) -> Column:
    """md5 over the text of the components; a NULL component hashes as a marker instead of vanishing."""
    parts = []
    for column in columns:
        column = F.col(column) if isinstance(column, str) else column
        parts.append(F.coalesce(column.cast("string"), F.lit(NULL_COMPONENT)))
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


# What stands before a key that is no digest; longer than one, so that the two kinds never meet.
_PLAIN = bytes(17)


def packed(key: str | Column) -> Column:
    """A key in the bytes that a shuffle has to carry: the 16 of a digest in hex, any other text behind a mark. Different keys stay
    different, NULL stays NULL, and ``unpacked`` gives the key back."""
    text = F.col(key) if isinstance(key, str) else key
    digest = (F.octet_length(text) == 32) & F.lower(F.hex(F.unhex(text))).eqNullSafe(text)
    return F.when(digest, F.unhex(text)).otherwise(F.concat(F.lit(_PLAIN), text.cast("binary")))


def unpacked(key: str) -> Column:
    held = F.col(key)
    plain = F.substring(held, len(_PLAIN) + 1, 2**31 - 1).cast("string")
    return F.when(F.octet_length(held) == 16, F.lower(F.hex(held))).otherwise(plain)
