"""Column-level cleaning and scalar transforms.

All functions return Spark ``Column`` expressions (or apply a filter to a
DataFrame) built from ``pyspark.sql.functions`` only, so they stay inside
whole-stage codegen. Spark 4 runs with ANSI mode on: casts, parses and
divisions that can fail use the ``try_*`` forms instead of switching ANSI off.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the source system's rules.
# Stored click flags that count as "clicked" (case-sensitive list; the
# case-insensitive variant lowers the input first).
CLICKED_VALUES = ("1", "TRUE", "true")
# The zero date a MySQL DATETIME column holds for "no value".
ZERO_DATETIME = "0000-00-00 00:00:00"
# Characters Python's str.strip() removes (str.isspace).
PY_WHITESPACE_CHARS = ("\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
                       + "\u2028\u2029\u202f\u205f\u3000")
# DNS namespace UUID used for name-based (v5) UUIDs, as 32 hex digits.
DNS_NAMESPACE_HEX = "6ba7b8109dad11d180b400c04fd430c8"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- C1 / C7: row filters -------------------------------------------------

def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows holding NULL in any of ``cols``."""
    return df.dropna(how="any", subset=list(cols))


def verified_only(df: DataFrame, col: str = "verified_purchase") -> DataFrame:
    """Keep verified purchases (``== 1``); NULL is dropped."""
    return df.filter(F.col(col) == 1)


# ---- dates and times ------------------------------------------------------

def parse_date_or_null(c: str | Column, fmt: str | None = None) -> Column:
    """String -> timestamp -> date, NULL when unparseable (never raises)."""
    ts = F.try_to_timestamp(_col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(_col(c))
    return F.to_date(ts)


def coerce_ts(c: str | Column) -> Column:
    """Bad datetime text becomes NULL; the row is kept."""
    return F.try_to_timestamp(_col(c))


def coerce_ts_ntz(c: str | Column) -> Column:
    """Timestamp without zone from text; NULL when unparseable."""
    return _try_cast(_col(c), "timestamp_ntz")


def _try_cast(c: Column, to: str) -> Column:
    return c.try_cast(to)


def null_if_zero_date(c: str | Column) -> Column:
    """C4: ``NULLIF(x, '0000-00-00 00:00:00')`` then a safe cast to timestamp_ntz."""
    return _try_cast(F.nullif(_col(c), F.lit(ZERO_DATETIME)), "timestamp_ntz")


def month_key(ts: str | Column) -> Column:
    """Calendar month as ``yyyy-MM``."""
    return F.date_format(_col(ts), "yyyy-MM")


def day_of(ts: str | Column) -> Column:
    """Calendar date of a timestamp."""
    return F.to_date(_col(ts))


def between_days(ts: str | Column, first_day: str, last_day: str) -> Column:
    """``DATE(ts) BETWEEN first AND last`` written as a half-open range on
    ``ts`` itself so parquet min/max statistics can skip row groups."""
    return (_col(ts) >= F.to_timestamp_ntz(F.lit(first_day))) & (
        _col(ts) < F.date_add(F.to_date(F.lit(last_day)), 1).cast("timestamp_ntz"))


def hour_of(ts: str | Column) -> Column:
    """Hour 0-23."""
    return F.hour(_col(ts))


def minute_key(created_at: str | Column) -> Column:
    """``dd_MM_yyyy_HH_mm`` of an ISO-8601 text in the text's *own* offset.

    The first 19 characters hold the wall-clock time; reading them as a
    timestamp without zone keeps that wall time. NULL when unparseable.
    """
    wall = _try_cast(F.substring(_col(created_at), 1, 19), "timestamp_ntz")
    return F.date_format(wall, "dd_MM_yyyy_HH_mm")


def iso_utc(ts: str | Column) -> Column:
    """ISO-8601 with microseconds and ``+00:00`` of a UTC wall time."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def now_iso() -> Column:
    """Processing-time stamp in UTC, microseconds, ``+00:00``."""
    return iso_utc(F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")))


def date_from_day_offset(n: str | Column) -> Column:
    """Date from an int day offset since 1970-01-01."""
    return F.date_from_unix_date(_col(n).cast("int"))


# ---- flags, numbers, text -------------------------------------------------

def parse_clicked(c: str | Column, case_insensitive: bool = False) -> Column:
    """True iff the stored value is one of ``CLICKED_VALUES``; NULL -> false."""
    v = _col(c)
    if case_insensitive:
        hit = F.lower(v).isin("1", "true")
    else:
        hit = v.isin(*CLICKED_VALUES)
    return F.coalesce(hit, F.lit(False))


def clicked_from_ts(click_ts: str | Column) -> Column:
    """Clicked iff a click timestamp is present."""
    return _col(click_ts).isNotNull()


def trim_all(c: str | Column) -> Column:
    """Strip all leading/trailing whitespace as Python's ``strip()`` does
    (``trim`` strips spaces only)."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE_CHARS))


def trim_dim(c: str | Column) -> Column:
    """Trim both ends (spaces), as the document queries do."""
    return F.trim(_col(c))


def truncate_text(c: str | Column, n: int = 240) -> Column:
    """First ``n`` code points, NULL -> ''."""
    return F.coalesce(F.substring(_col(c), 1, n), F.lit(""))


def int_or_zero(c: str | Column) -> Column:
    """empty/NULL -> 0, else the integer value; NULL (never an error, never
    0) for text that is no integer, so such rows can be told and set aside."""
    v = _col(c).cast("string")
    return F.when(F.coalesce(v, F.lit("")) == "", F.lit(0).cast("bigint")).otherwise(
        F.when(v.rlike(r"^\s*[+-]?\d+\s*$"), _try_cast(v, "bigint")))


def one_line(c: str | Column) -> Column:
    """C11: NULL -> '', ``\\n`` -> space, then strip surrounding whitespace."""
    return trim_all(F.replace(F.coalesce(_col(c), F.lit("")), F.lit("\n"), F.lit(" ")))


#: Escapes of ``one_record``: a character and the letter behind the backslash.
_ESCAPES = (("\n", "n"), ("\r", "r"), ("\0", "0"), ("\\", "s"))


def one_record(c: str | Column) -> Column:
    """Text without line breaks, for formats of one record a line: a line feed,
    carriage return, NUL or backslash becomes a backslash and a letter. As no
    other backslash is left, ``whole_text`` undoes it exactly."""
    v = out = _col(c)
    odd = F.lit(False)
    for char, letter in reversed(_ESCAPES):       # the backslash itself first
        out = F.replace(out, F.lit(char), F.lit("\\" + letter))
        odd = odd | F.contains(v, F.lit(char))
    return F.when(odd, out).otherwise(v)          # looked for first: most texts have none


def whole_text(c: str | Column) -> Column:
    """Undoes ``one_record``."""
    v = out = _col(c)
    for char, letter in _ESCAPES:                 # the backslash itself last
        out = F.replace(out, F.lit("\\" + letter), F.lit(char))
    return F.when(F.contains(v, F.lit("\\")), out).otherwise(v)


def uuid5_from_name(name: str | Column) -> Column:
    """C14: RFC 4122 version-5 UUID of ``name`` in the DNS namespace.

    ``sha1(namespace_bytes || utf8(name))``, first 16 bytes, version nibble 5,
    variant bits ``10``. Same text as Python's ``uuid.uuid5(NAMESPACE_DNS, name)``.
    """
    h = F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE_HEX)), F.encode(_col(name), "UTF-8")))
    variant_nibble = F.substring(F.lit("89ab"),
                                 (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1, 1)
    return F.concat_ws("-",
                       F.substring(h, 1, 8),
                       F.substring(h, 9, 4),
                       F.concat(F.lit("5"), F.substring(h, 14, 3)),
                       F.concat(variant_nibble, F.substring(h, 18, 3)),
                       F.substring(h, 21, 12))


def uuid5_key(prefix: str, id_col: str | Column) -> Column:
    """C14: ``uuid5(DNS, f"{prefix}_{int(id)}")``."""
    return uuid5_from_name(F.concat(F.lit(prefix + "_"), _col(id_col).cast("bigint").cast("string")))


def split_list(c: str | Column, sep: str = ",") -> Column:
    """C17: ``"a,b"`` -> ``[a, b]``; ``""`` -> ``[""]``; NULL -> ``[]``."""
    v = _col(c)
    return F.when(v.isNull(), F.array().cast("array<string>")).otherwise(F.split(v, F.lit(sep), -1))


def safe_ratio(a: str | Column, b: str | Column, zero_if_null: bool = False) -> Column:
    """``a / NULLIF(b, 0)`` as a double; optional ``COALESCE(., 0)``."""
    r = F.try_divide(_col(a).cast("double"), F.nullif(_col(b).cast("double"), F.lit(0.0)))
    return F.coalesce(r, F.lit(0.0)) if zero_if_null else r


def round_to(x: str | Column, n: int) -> Column:
    """Half-up rounding of a double to ``n`` digits."""
    return F.round(_col(x).cast("double"), n)


def ci_key(c: str | Column, collation: str = "UTF8_LCASE") -> Column:
    """A join key compared case-insensitively (``UNICODE_CI_AI`` also
    ignores accents)."""
    return F.collate(_col(c), collation)
