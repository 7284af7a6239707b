"""Deterministic point ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the DNS namespace of RFC 4122, as hexadecimal digits.
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def chunk_key(source_file: Column, chunk_id: Column) -> Column:
    return F.concat_ws("_", source_file, chunk_id.cast("string"))


def uuid5(name: Column) -> Column:
    """Version 5 UUID of a name in the DNS namespace, equal to Python's ``uuid.uuid5``."""
    digest = F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE)), F.encode(name, "UTF-8")))
    # The variant digit keeps its two low bits under a leading binary 10.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )
