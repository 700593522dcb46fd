"""Text Column helpers: trimming, case normalisation and IPv4 masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode space separators (category Zs) that SQL TRIM removes.
# U+0020, U+00A0, U+1680, U+2000..U+200A, U+202F, U+205F, U+3000.
UNICODE_SPACES = (
    "\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)

# The mask of a dotted-quad IPv4 address keeps the first two octets
# (the network) and hides the host part: 103.216.15.12 -> 103.216.*.*
IPV4_NETWORK_MASK = "*.*"

# Only the first IPv4 in a value is masked. Java's regexp_replace replaces every
# match, so the pattern also swallows the rest of the value into a group that
# is put back unchanged: the leftmost match is the only one.
_FIRST_IPV4 = r"(?s)(\d{1,3}\.\d{1,3})\.\d{1,3}\.\d{1,3}(.*)"
_FIRST_IPV4_REPLACEMENT = "$1." + IPV4_NETWORK_MASK + "$2"
# A value that is exactly one dotted quad (the usual case) is masked without a
# replace: keep what precedes the second dot. ``\z`` rather than ``$``, which
# would also accept a trailing line break and then drop it.
_ONLY_IPV4 = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_trim(c: Column | str) -> Column:
    """TRIM that strips every Unicode space separator, not only U+0020 (N7).

    All separators but U+0020 are non-ASCII, so pure-ASCII values (byte
    length = character length) take Spark's plain ``trim``, which is about
    three times cheaper than trimming a character set.
    """
    col = _col(c)
    return F.when(F.octet_length(col) == F.char_length(col), F.trim(col)).otherwise(
        F.btrim(col, F.lit(UNICODE_SPACES))
    )


def norm_upper(c: Column | str) -> Column:
    """``UPPER(TRIM(c))`` for categorical columns."""
    return F.upper(norm_trim(c))


def mask_ipv4(c: Column | str) -> Column:
    """Replace the last two octets of the first IPv4 in the value by ``*.*``.

    Unanchored like the SQL original: ``x1234.5.6.7890`` -> ``x1234.5.*.*0``.
    Values without an IPv4 (IPv6, names) pass through; NULL stays NULL.
    """
    col = _col(c)
    return F.when(
        col.rlike(_ONLY_IPV4),
        F.concat(F.substring_index(col, ".", 2), F.lit("." + IPV4_NETWORK_MASK)),
    ).otherwise(F.regexp_replace(col, _FIRST_IPV4, _FIRST_IPV4_REPLACEMENT))
