"""Stable keys: short hashes of normalised text, occurrence suffixes, name-based uuids."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.text import normal_form, squeeze

HASH_LENGTH = 12
#: The name space of entity ids, unless a caller whose ids must match earlier ones gives theirs.
ENTITY_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "foliospark/entities")
ROOT = "00000000-0000-0000-0000-000000000000"


def normalized(c: Column) -> Column:
    """NFC with every run of blanks one space."""
    return squeeze(normal_form(c))


def short_hash(c: Column) -> Column:
    return F.substring(F.sha1(c.cast("binary")), 1, HASH_LENGTH)


def fingerprint(*fields: Column) -> Column:
    """Hash of the editable fields; blanks don't matter, null counts as empty."""
    return short_hash(F.concat_ws("\x1f", *[F.coalesce(normalized(f), F.lit("")) for f in fields]))


def with_line_keys(lines: DataFrame, document: str = "document", pos: str = "pos", text: str = "text", into: str = "key") -> DataFrame:
    """Adds the key of each line: its text's hash, ~n from the n-th occurrence on, in document order."""
    digest = "__digest"
    hashed = lines.withColumn(digest, short_hash(normalized(F.coalesce(F.col(text), F.lit("")))))
    rank = F.row_number().over(Window.partitionBy(document, digest).orderBy(pos))
    return hashed.withColumn(into, F.when(rank == 1, F.col(digest)).otherwise(F.concat_ws("~", digest, rank.cast("string")))).drop(digest)


def uuid5(space: uuid.UUID, name: Column) -> Column:
    """Name-based uuid of a string: sha1 of name space and name, with version and variant bits."""
    digest = F.sha1(F.concat(F.unhex(F.lit(space.hex)), name.cast("binary")))
    variant = F.lower(F.hex((F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3))) + 8))
    part = lambda a, n: F.substring(digest, a, n)
    return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(variant, part(18, 3)), part(21, 12))


def is_inserted(key: Column) -> Column:
    return key.contains("+")
