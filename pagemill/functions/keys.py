"""Canonical spellings of keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NIL_UUID = "00000000-0000-0000-0000-000000000000"


def canonical_uuid(c: Column) -> Column:
    """Lower case with hyphens; null for null, blank, all-zero or malformed values.

    Accepts surrounding white space, braces, a urn:uuid: prefix, any case and missing hyphens.
    """
    h = F.regexp_replace(F.regexp_replace(F.lower(c), r"^[\s\p{Z}]*urn:uuid:", ""), r"[\s\p{Z}{}\-]", "")
    u = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))
    return F.when(h.rlike("^[0-9a-f]{32}$") & (u != NIL_UUID), u)


def raw_or_canonical_uuid(c: Column) -> Column:
    """canonical_uuid, but a non-blank malformed value stays as its trimmed lower-case text (it is a key of its own that nothing carries)."""
    usual = c.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$") & (c != NIL_UUID)  # spares the patterns below
    t = F.lower(F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    nothing = F.regexp_replace(F.regexp_replace(t, r"^urn:uuid:", ""), r"[\s\p{Z}{}\-0]", "") == ""
    return F.when(usual, c).when(c.isNotNull() & ~nothing, F.coalesce(canonical_uuid(c), t))


#: Fixed value: SHA-256 of the empty file.
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def canonical_sha256(c: Column) -> Column:
    """Lower-case hex; null for null, blank, all-zero, malformed values and the hash of the empty file."""
    h = F.regexp_replace(F.regexp_replace(F.lower(c), r"^[\s\p{Z}]*sha-?256:", ""), r"[\s\p{Z}:\-]", "")
    return F.when(h.rlike("^[0-9a-f]{64}$") & ~h.rlike("^0{64}$") & (h != EMPTY_SHA256), h)
