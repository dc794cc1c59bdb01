"""Small shared helpers for column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quote_regex(literal: str) -> str:
    """Java-regex literal for ``literal`` (``split`` takes a pattern)."""
    if re.fullmatch(r"[A-Za-z0-9 ;,:_]*", literal):
        return literal
    return "\\Q" + literal.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def md5_key(key_cols, seed: int) -> Column:
    """``md5(concat_ws('|', keys) || ':' || seed)`` as a hex string."""
    cols = [as_col(c).cast("string") for c in (key_cols if isinstance(key_cols, (list, tuple)) else [key_cols])]
    return F.md5(F.concat(F.concat_ws("|", *cols), F.lit(f":{seed}")))
