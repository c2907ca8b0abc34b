"""Key-based pseudo-random numbers.

Random choices are functions of a row key and a salt, so every run, every
retry of a lost task and the SQL oracle see the same draws. The uniform is
the first 12 hex digits of md5(key '|' salt) divided by 16**12.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 12
SCALE = float(16 ** HEX_DIGITS)


def hash_uniform(*parts: Column | str | int) -> Column:
    """Uniform double in [0, 1) from md5 of the parts joined with '|'."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))
    return F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("double") / F.lit(SCALE)


def hash_bucket(key: Column, buckets: int, salt: str = "") -> Column:
    """Integer in [0, buckets) from md5 of key (and salt)."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(salt)) if salt
                   else key.cast("string"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)).cast("int")
