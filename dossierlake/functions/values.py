"""Byte, digest and random text functions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

ALNUM = string.ascii_letters + string.digits
UPPER = string.ascii_uppercase


def to_hex(data: Column) -> Column:
    return F.lower(F.hex(data))


def parse_byte_list(text: Column) -> Column:
    """``"0,255"`` to bytes; empty text gives null."""
    digits = F.transform(
        F.split(text, ","),
        lambda item: F.lpad(F.hex(F.pmod(item.cast("int"), F.lit(256))), 2, "0"),
    )
    return F.when(F.length(text) > 0, F.unhex(F.array_join(digits, "")))


def format_byte_list(data: Column) -> Column:
    """Bytes to ``"0,255"``."""
    digits = F.hex(data)
    items = F.transform(
        F.sequence(F.lit(1), F.length(digits), F.lit(2)),
        lambda at: F.conv(F.substring(digits, at, F.lit(2)), 16, 10),
    )
    return F.when(F.length(data) > 0, F.array_join(items, ",")).when(
        data.isNotNull(), F.lit("")
    )


def unsigned_value(data: Column) -> Column:
    """Up to fifteen bytes as an unsigned big-endian number; more is an error.

    A decimal holds 38 digits, which is what fifteen bytes need at most.
    """
    digits = F.lpad(F.hex(data), 30, "0")

    def part(start: int, size: int) -> Column:
        return F.conv(F.substring(digits, start, size), 16, 10).cast("decimal(20,0)")

    # The last seven bytes and the eight before them.
    room = F.lit(str(1 << 56)).cast("decimal(17,0)")
    value = (part(1, 16) * room + part(17, 14)).cast("decimal(38,0)")
    return F.when(F.length(data) == 0, F.lit(None).cast("decimal(38,0)")).when(
        F.length(data) <= 15, value
    ).when(data.isNotNull(), F.raise_error(F.lit("more than fifteen bytes")).cast("decimal(38,0)"))


def md5_hex(data: Column) -> Column:
    return F.md5(data)


def md5_raw(data: Column) -> Column:
    return F.unhex(F.md5(data))


def digest_slice(digest: Column, start: int, digits: int) -> Column:
    """``digits`` hex digits of a digest, from a 0-based position, as a number."""
    return F.conv(F.substring(digest, start + 1, digits), 16, 10).cast("bigint")


def random_text(seed: Column, length: int, alphabet: str = ALNUM) -> Column:
    """Reproducible random text: every character is drawn from a digest of the seed.

    One digest yields eight draws of four hex digits.
    """
    draws = []
    for block in range(-(-length // 8)):
        digest = F.md5(F.concat_ws(":", seed.cast("string"), F.lit(str(block))))
        draws += [digest_slice(digest, 4 * i, 4) for i in range(8)]
    letters = F.lit(alphabet)
    return F.concat(
        *[
            F.substring(letters, F.pmod(d, F.lit(len(alphabet))).cast("int") + 1, F.lit(1))
            for d in draws[:length]
        ]
    )
