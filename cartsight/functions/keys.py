"""Layout-independent pseudo-randomness: every seeded operator hashes the row key.

Random splits that depend on row order or partition layout change when a
cluster re-reads its input, so a lost executor could move rows from one part
to the other.  A hash of the key cannot.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

_MULTIPLIER = 2654435761
_HIGH_MULTIPLIER = 1540483477
_RANGE = 1 << 32
_HALF_WORD = 1 << 16


def key_hash(key: Column, seed: int = 0) -> Column:
    """``(key + seed) * 2654435761 mod 2**32`` for a key below ``2**32``; a null key hashes as 0.

    The upper half of a larger key is folded in first, so keys that differ only
    there differ in their hash.  The product is formed from two 16-bit halves so
    that it never leaves the bigint range, whatever the key.
    """
    key = F.coalesce(key, F.lit(0)).cast("bigint")
    folded = F.pmod(key, F.lit(_RANGE)) + F.shiftright(key, 32) * _HIGH_MULTIPLIER
    word = F.pmod(F.pmod(folded, F.lit(_RANGE)) + F.lit(seed % _RANGE), F.lit(_RANGE))
    high = F.shiftright(word, 16) * _MULTIPLIER % _HALF_WORD * _HALF_WORD
    low = word.bitwiseAND(F.lit(_HALF_WORD - 1)) * _MULTIPLIER
    return (high + low) % _RANGE


def bucket(key: Column, buckets: int, seed: int = 0, skip: int = 1) -> Column:
    """Bucket number in ``[0, buckets)``; ``skip`` drops low digits already used elsewhere."""
    value = key_hash(key, seed)
    if skip > 1:
        value = (value - value % skip) / skip
    return (value.cast("bigint") % buckets).cast("int")


def content_key(*columns: Column | str) -> Column:
    """A key for records that carry none: equal records get equal keys.

    The first 15 hexadecimal digits of the MD5 sum of the values as text, which
    any engine can compute; U+001F divides the values, U+0000 stands for a null.
    """
    texts = (F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\u0000")) for c in columns)
    return F.conv(F.left(F.md5(F.concat_ws("\u001f", *texts)), F.lit(15)), 16, 10).cast("bigint")
