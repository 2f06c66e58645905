"""Keys of profiles: digests, salted row keys, buckets and document ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the separator between the parts of a key.
SEPARATOR = "\x01"
# Fixed value: the salt is the first two digest bytes, so it has this many values.
SALT_SPACE = 65536


def join_key(*parts: Column) -> Column:
    return F.concat_ws(SEPARATOR, *parts)


def entity_key(entity_type: Column, oid: Column) -> Column:
    return F.md5(join_key(entity_type, oid))


def dimension_id(data_source: Column, protocol: Column, action: Column) -> Column:
    return join_key(data_source, protocol, action)


def salt_hex(entity_type: Column, oid: Column) -> Column:
    return F.substring(entity_key(entity_type, oid), 1, 4)


def row_key(entity_type: Column, oid: Column, *dimensions: Column) -> Column:
    """Salt (4 hex digits) followed by the separated key parts."""
    return F.concat(
        salt_hex(entity_type, oid), join_key(entity_type, oid, *dimensions)
    )


def bucket_of(entity_type: Column, oid: Column, buckets: int) -> Column:
    """Index of the even slice of the salt space that holds the entity."""
    salt = F.conv(salt_hex(entity_type, oid), 16, 10).cast("int")
    return F.floor(salt * F.lit(buckets) / F.lit(SALT_SPACE)).cast("int")


def split_points(buckets: int) -> list[str]:
    """First salt of every bucket but the first, as two byte values ``"hi,lo"``."""
    starts = (-(-i * SALT_SPACE // buckets) for i in range(1, buckets))
    return [f"{start // 256},{start % 256}" for start in starts]


def base_document_id(row: dict[str, Column], compat: bool = False) -> Column:
    """Id of a base document; ``compat`` leaves protocol and action out."""
    parts = [row["entity_type"], row["oid"], row["data_source"]]
    if not compat:
        parts += [row["protocol"], row["action"]]
    return F.md5(join_key(*parts))


def info_document_id(entity_type: Column, oid: Column) -> Column:
    return entity_key(entity_type, oid)
