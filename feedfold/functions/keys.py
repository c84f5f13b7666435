"""Stable row keys from text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

KeyFn = Callable[[Column], Column]

KEY_HEX_DIGITS = 32

_DIGESTS: dict[str, KeyFn] = {
    "MD5": F.md5,
    "SHA1": F.sha1,
    "SHA224": lambda c: F.sha2(c, 224),
    "SHA256": lambda c: F.sha2(c, 256),
    "SHA384": lambda c: F.sha2(c, 384),
    "SHA512": lambda c: F.sha2(c, 512),
}


def url_key(column: Column | str, algorithm: str = "MD5") -> Column:
    """The first 16 digest bytes as lower-case hex; null stays null.

    An algorithm nobody knows is an error: one key for the whole feed would pass unnoticed.
    """
    text = F.col(column) if isinstance(column, str) else column
    digest = _DIGESTS.get(algorithm.upper().replace("-", ""))
    if digest is None:
        raise ValueError(f"unknown digest algorithm {algorithm!r}")
    return F.substring(digest(text.cast("string")), 1, KEY_HEX_DIGITS)
