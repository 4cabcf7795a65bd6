"""Scalar Column expressions shared by the jobs.

Two parsing families exist and intentionally differ:

* *ingest* coercions (``coerce_float``, ``coerce_int``, ``parse_iso8601``)
  used while turning feed frames into canonical events;
* *silver* coercions (``silver_*``) used by the typed normalisation.

Everything here returns a ``Column``; nothing runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What ``str.strip()`` takes for white space.
_WS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Trim every kind of whitespace (``str.strip()``), not only spaces."""
    return F.btrim(col_(c), F.lit(_WS))


def blank_to_null(c) -> Column:
    """NULL or whitespace-only text -> NULL, other text trimmed."""
    t = strip_ws(col_(c).cast("string"))
    return F.when(t == "", F.lit(None).cast("string")).otherwise(t)


# --- numeric coercion -------------------------------------------------------

_PY_FLOAT_UNDERSCORE = "^\\s*[+-]?(\\d(_?\\d)*)?(\\.(\\d(_?\\d)*)?)?([eE][+-]?\\d(_?\\d)*)?\\s*$"


def coerce_float(c) -> Column:
    """``float(x)`` on text, NULL when it would raise.

    Spark's cast also accepts a trailing ``d``/``f`` type suffix, which
    Python rejects; such text is rejected here.  Python's digit grouping
    with ``_`` is accepted by removing the underscores first.
    """
    s = col_(c).cast("string")
    # one regex decides the rare cases: a type suffix (rejected unless it is
    # part of "inf") or digit grouping with "_" (accepted without the "_")
    odd = s.rlike("[dDfF_]\\s*$|_")
    suffix = s.rlike("[dDfF]\\s*$") & ~F.lower(F.trim(s)).rlike("^[+-]?(inf|infinity)$")
    grouped = s.rlike(_PY_FLOAT_UNDERSCORE)
    fixed = (F.when(suffix, F.lit(None).cast("double")).when(grouped, F.regexp_replace(s, "_", "").try_cast("double"))
              .otherwise(s.try_cast("double")))
    return F.when(odd, fixed).otherwise(s.try_cast("double"))


def coerce_int(c) -> Column:
    """``int(x)`` on text: integral text only, NULL otherwise."""
    s = strip_ws(col_(c).cast("string"))
    return F.when(s.rlike("^[+-]?\\d+$"), s.try_cast("bigint"))


def compute_mid(bid, ask) -> Column:
    """Mid price; NULL when either side is NULL."""
    return (col_(bid) + col_(ask)) / F.lit(2.0)


def compute_spread_bps(bid, ask) -> Column:
    """Spread in basis points of the mid; NULL when a side is NULL or mid <= 0."""
    mid = compute_mid(bid, ask)
    return F.when(mid > 0, (col_(ask) - col_(bid)) / mid * F.lit(10000.0))


# --- time -------------------------------------------------------------------


def epoch_whole_seconds(ts) -> Column:
    """TIMESTAMP / TIMESTAMP_NTZ -> floor(epoch seconds) as BIGINT."""
    return F.floor(F.unix_micros(col_(ts).cast("timestamp")) / F.lit(1_000_000)).cast("bigint")


def iso_utc(ts) -> Column:
    """Python ``datetime.isoformat()`` of a UTC instant:
    ``YYYY-MM-DDTHH:MM:SS[.ffffff]+00:00`` (fraction only when non-zero)."""
    t = col_(ts).cast("timestamp")
    micros = F.pmod(F.unix_micros(t), F.lit(1_000_000))
    frac = F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(F.lit(""))
    return F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), frac, F.lit("+00:00"))


def iso_utc_from_epoch(epoch) -> Column:
    """``to_iso_utc(float)``: epoch seconds -> ISO text; NULL in, NULL out;
    out of Python's datetime range -> empty text."""
    e = col_(epoch).cast("double")
    in_range = (e >= F.lit(-62135596800.0)) & (e < F.lit(253402300800.0))
    micros = F.round(e * F.lit(1_000_000.0)).cast("bigint")
    return F.when(e.isNull(), F.lit(None).cast("string")).when(
        in_range, iso_utc(F.timestamp_micros(micros))).otherwise(F.lit(""))


def iso_utc_from_micros(us) -> Column:
    """Epoch microseconds -> ISO text (exact, no float rounding)."""
    return F.when(col_(us).isNotNull(), iso_utc(F.timestamp_micros(col_(us).cast("bigint"))))


def compact_stamp(ts) -> Column:
    """``YYYYMMDDTHHMMSSZ`` used in rotated file names."""
    return F.date_format(col_(ts).cast("timestamp"), "yyyyMMdd'T'HHmmss'Z'")


_ISO_COMPACT = "^\\d{8}([T ]\\d{4}(\\d{2}([.,]\\d+)?)?)?(Z|[+-]\\d{2}:?\\d{2})?$"
_ISO_PREFIX = "^\\s*\\d{4}-\\d{2}-\\d{2}"


def parse_iso8601(c) -> Column:
    """ISO-8601 text -> TIMESTAMP (``Z`` accepted, naive text read as UTC
    because every session runs in UTC); anything else -> NULL."""
    s = strip_ws(col_(c).cast("string"))
    s = F.when(s.rlike(_ISO_COMPACT), F.regexp_replace(F.regexp_replace(
        s, "^(\\d{4})(\\d{2})(\\d{2})", "$1-$2-$3"), "([T ]\\d{2})(\\d{2})(\\d{2})?(?=[.Z+-]|$)", "$1:$2:$3")).otherwise(s)
    s = F.regexp_replace(s, "([T ]\\d{2}:\\d{2}):(?=[.Z+-]|$)", "$1")
    s = F.regexp_replace(s, "([T ]\\d{2})(?=Z|[+-]|$)", "$1:00")
    return F.when(s.rlike(_ISO_PREFIX + "([T ]\\d{2}:\\d{2}(:\\d{2}([.,]\\d+)?)?)?(Z|[+-]\\d{2}:?\\d{2})?$"),
                  F.regexp_replace(s, ",", ".").try_cast("timestamp"))


def parse_heartbeat_time(c) -> Column:
    """``YYYY-MM-DD HH:MM:SS[.frac] +hhmm ...`` (Go time format); fraction
    cut to 6 digits, trailing text ignored."""
    s = strip_ws(col_(c).cast("string"))
    pat = "^(\\d{4}-\\d{2}-\\d{2}) (\\d{2}:\\d{2}:\\d{2})(?:\\.(\\d+))? ([+-]\\d{2})(\\d{2})"
    d = F.regexp_extract(s, pat, 1)
    t = F.regexp_extract(s, pat, 2)
    f = F.substring(F.regexp_extract(s, pat, 3), 1, 6)
    zh = F.regexp_extract(s, pat, 4)
    zm = F.regexp_extract(s, pat, 5)
    frac = F.when(f != "", F.concat(F.lit("."), F.rpad(f, 6, "0"))).otherwise(F.lit(""))
    stamp = F.concat(d, F.lit("T"), t, frac, zh, F.lit(":"), zm)
    return F.when(d != "", stamp.try_cast("timestamp"))


# --- silver coercions ---------------------------------------------------------

# ``c`` is a JSON value's text, ``kind`` what it was: s(tring), n(umber), b(oolean).

def _as_number(c, kind, text_rule) -> Column:
    """Number as is, boolean as 1 / 0, text by its rule."""
    return (F.when(kind == "n", col_(c).try_cast("double"))
             .when(kind == "b", F.when(F.lower(col_(c)) == "true", 1.0).otherwise(0.0))
             .when(kind == "s", text_rule))


def silver_text(c, kind) -> Column:
    return F.when(kind == "b", F.initcap(col_(c))).otherwise(blank_to_null(c))


def silver_float(c, kind) -> Column:
    # the cast itself trims whitespace and maps blank text to NULL
    return _as_number(c, kind, coerce_float(c))


def silver_int(c, kind, default: int | None = 0) -> Column:
    """Numbers cut to whole ones; text only if it is a whole number (digits
    may be grouped by ``_``)."""
    s = strip_ws(col_(c))
    text = F.when(s.rlike("^[+-]?\\d+(_\\d+)*$"), F.regexp_replace(s, "_", "").try_cast("bigint"))
    whole = F.when(kind == "s", text).when(kind == "n", F.coalesce(col_(c).try_cast("bigint"), col_(c).try_cast("double").try_cast("bigint"))).when(
        kind == "b", _as_number(c, kind, F.lit(None)).cast("bigint"))
    return F.coalesce(whole, F.lit(default).cast("bigint")) if default is not None else whole


def silver_timestamp(c, kind) -> Column:
    """Number: epoch seconds.  Text: ISO date-time (naive = UTC), else NULL."""
    return F.when(kind == "s", parse_iso8601(blank_to_null(c))).otherwise(_micros_time(_as_number(c, kind, F.lit(None).cast("double"))))


def silver_epoch_seconds(c, kind) -> Column:
    """Float-parsable epoch seconds -> TIMESTAMP (within year 1..9999)."""
    return _micros_time(silver_float(c, kind))


def _micros_time(e) -> Column:
    ok = (e >= F.lit(-62135596800.0)) & (e < F.lit(253402300800.0))
    return F.when(ok, F.timestamp_micros(F.round(e * F.lit(1_000_000.0)).cast("bigint")))


# --- small text helpers ------------------------------------------------------

def projected_daily_bytes(bytes_so_far, elapsed_seconds) -> Column:
    b = col_(bytes_so_far).cast("double")
    e = col_(elapsed_seconds).cast("double")
    return F.when(e <= 0, b).otherwise(b / e * F.lit(86400.0))


def sanitize_metric_name(c) -> Column:
    return F.regexp_replace(col_(c), "[^a-zA-Z0-9_:]", "_")


def sanitize_label_name(c) -> Column:
    return F.regexp_replace(col_(c), "[^a-zA-Z0-9_]", "_")


def epoch_seconds(ts) -> Column:
    """TIMESTAMP / TIMESTAMP_NTZ -> epoch seconds as DOUBLE (microsecond exact)."""
    return F.unix_micros(col_(ts).cast("timestamp")) / F.lit(1_000_000.0)


def ts_floor(ts, window) -> Column:
    """Floor an integer epoch to a window; ``pmod`` keeps Python's floor
    semantics for negative values.  A window <= 0 leaves ts unchanged."""
    w = window if isinstance(window, Column) else F.lit(int(window))
    return F.when(w > 0, col_(ts) - F.pmod(col_(ts), w)).otherwise(col_(ts))


def utc_date(ts) -> Column:
    return F.date_format(col_(ts).cast("timestamp"), "yyyy-MM-dd")


def clean_path(c) -> Column:
    """Backslashes -> '/', each segment trimmed, empty segments dropped."""
    parts = F.split(F.regexp_replace(col_(c).cast("string"), "\\\\", "/"), "/")
    return F.array_join(F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != ""), "/")


def normalize_condition_id(c) -> Column:
    t = F.lower(strip_ws(F.coalesce(col_(c).cast("string"), F.lit(""))))
    body = F.when(t.startswith("0x"), F.substring(t, 3, 1 << 20)).otherwise(t)
    return F.when(body.rlike("^[0-9a-f]{64}$"), F.concat(F.lit("0x"), body)).otherwise(F.lit(""))


def parse_boolish(c) -> Column:
    # The accepted truthy spellings.
    return F.lower(strip_ws(F.coalesce(col_(c).cast("string"), F.lit("")))).isin("1", "true", "yes", "y", "on")


def sign_of(c) -> Column:
    return F.signum(col_(c)).cast("int")


def sign_to_label(c) -> Column:
    # Sign labels.
    v = col_(c)
    return (F.when(v == 1, "Up").when(v == -1, "Down").when(v == 0, "Flat").otherwise(""))


def label_to_sign(c) -> Column:
    v = F.lower(strip_ws(F.coalesce(col_(c).cast("string"), F.lit(""))))
    return F.when(v == "up", 1).when(v == "down", -1).when(v == "flat", 0).cast("int")


def safe_fmt(c) -> Column:
    """Float -> fixed 10 decimals, trailing zeros and dot stripped."""
    s = F.format_string("%.10f", col_(c).cast("double"))
    return F.when(col_(c).isNull(), F.lit("")).otherwise(F.regexp_replace(F.regexp_replace(s, "0+$", ""), "\\.$", ""))


def mask_addr(c) -> Column:
    t = F.coalesce(col_(c).cast("string"), F.lit(""))
    return F.when(F.length(t) <= 10, t).otherwise(F.concat(F.substring(t, 1, 6), F.lit("..."), F.substring(t, -4, 4)))


def compact_json(c, max_len: int = 1200) -> Column:
    """A struct, map or array as compact JSON, cut to ``max_len`` with ``...``."""
    t = F.to_json(col_(c))
    return F.when(F.length(t) <= max_len, t).otherwise(F.concat(F.substring(t, 1, max_len - 3), F.lit("...")))
