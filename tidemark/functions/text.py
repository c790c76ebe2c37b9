"""Text columns: cleaning, parsing and rule-based classification (Column to Column)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accented letters and their plain counterparts, position by position.
ACCENTED = "ÁÉÍÓÚáéíóúÂÊÎÔÛâêîôûÀÈÌÒÙàèìòùÄËÏÖÜäëïöüÇçÑñÃãõÕ"
PLAIN = "AEIOUaeiouAEIOUaeiouAEIOUaeiouAEIOUaeiouCcNnAaoO"

# Texts that sources write where they mean "no value".
NULL_MARKERS = ("", "nan", "[None]", "[Deleted]", "undefined")


# Fixed value: what stands for NULL inside a surrogate key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_accents(col) -> Column:
    return F.translate(_c(col), ACCENTED, PLAIN)


def clean_text_key(col) -> Column:
    """Join key for names: no accents, line breaks or apostrophes, upper case, trimmed."""
    flat = F.translate(_c(col), "\r\n'", "")
    return F.trim(F.upper(strip_accents(flat)))


def null_markers(col, markers: Sequence[str] = NULL_MARKERS) -> Column:
    c = _c(col)
    return F.when(~F.trim(c).isin(list(markers)), c)


def digits_only(col) -> Column:
    return F.regexp_replace(_c(col), "[^0-9]", "")


def is_all_digits(col) -> Column:
    c = _c(col)
    return (F.length(c) > 0) & (F.translate(c, "0123456789", "") == "")


def to_int_lenient(col) -> Column:
    """``'12.0'`` to 12; anything unreadable to NULL.  Exact for all whole numbers of 64 bits."""
    c = _c(col)
    exact = F.coalesce(c.try_cast("bigint"), c.try_cast("decimal(38,10)").try_cast("bigint"))
    return F.coalesce(exact, c.try_cast("double").try_cast("bigint"))


def to_bool(col) -> Column:
    """true/false out of the spellings sources use."""
    c = F.lower(F.trim(_c(col).cast("string")))
    return F.when(c.isin("true", "t", "1", "s", "sim", "y", "yes"), True).when(
        c.isin("false", "f", "0", "n", "nao", "no"), False
    )


def hms_to_seconds(col, otherwise: int | None = 0) -> Column:
    """``HH:MM:SS`` (hours may exceed 24) to seconds; ``otherwise`` for any other text."""
    c = _c(col)
    part = lambda i: F.regexp_extract(c, r"^(\d+):(\d+):(\d+)$", i).try_cast("int")
    whole = part(1) * 3600 + part(2) * 60 + part(3)
    ok = c.rlike(r"^\d+:\d+:\d+$")
    return F.when(ok, whole).otherwise(F.lit(otherwise).cast("int"))


def seconds_to_hms(col) -> Column:
    s = _c(col)
    two = lambda v: F.lpad(v.cast("string"), 2, "0")
    hours = F.floor(s / 3600).cast("string")
    return F.concat_ws(
        ":",
        F.when(F.length(hours) < 2, F.lpad(hours, 2, "0")).otherwise(hours),
        two(F.floor(F.pmod(s, F.lit(3600)) / 60)),
        two(F.pmod(s, F.lit(60))),
    )


def first_token(col) -> Column:
    """First word of a name; the whole text when there is no blank."""
    return F.substring_index(_c(col), " ", 1)


def extract_after(col, marker: str, length: int, offset: int = 0) -> Column:
    """``length`` characters that follow ``marker`` (skipping ``offset``); NULL without the marker."""
    c = _c(col)
    at = F.locate(marker, c)
    start = at + F.lit(len(marker) + offset)
    return F.when(at > 0, F.substring(c, start, F.lit(length)))


def clean_phone(col) -> Column:
    """Digits from the first 1-9 on, without country code 55, with the mobile ninth digit added.

    Text with letters is no phone and gives NULL.
    """
    c = _c(col)
    bare = F.regexp_replace(F.translate(c, "() -.+", ""), "^[^1-9]*", "")
    coded = F.length(bare).between(12, 13) & bare.startswith("55")
    local = F.when(coded, F.substr(bare, F.lit(3))).otherwise(bare)
    short_mobile = (F.length(local) == 10) & F.substring(local, 3, 1).isin("6", "7", "8", "9")
    full = F.when(
        short_mobile, F.concat(F.substring(local, 1, 2), F.lit("9"), F.substring(local, 3, 8))
    ).otherwise(local)
    return F.when(~c.rlike("[A-Za-z]"), full)


def phone_class(col) -> Column:
    """MOBILE, FIXED or UNKNOWN for a cleaned phone; repeated-digit numbers are UNKNOWN."""
    c = _c(col)
    repeated = F.right(c, F.lit(8)).rlike(r"^(\d)\1{7}$")
    return (
        F.when(c.isNull() | repeated, "UNKNOWN")
        .when((F.length(c) == 11) & (F.substring(c, 3, 1) == "9"), "MOBILE")
        .when(F.length(c) == 10, "FIXED")
        .otherwise("UNKNOWN")
    )


def speed_mbps(col) -> Column:
    """Download rate in Mbps from texts like ``100M/50M``, ``300 MBPS``, ``1 GB`` or ``512 KBPS``."""
    c = F.upper(_c(col))
    amount = F.regexp_extract(c, r"(\d+(?:\.\d+)?)\s*([KMG])", 1).try_cast("double")
    unit = F.regexp_extract(c, r"(\d+(?:\.\d+)?)\s*([KMG])", 2)
    return F.when(unit == "K", amount / 1000).when(unit == "G", amount * 1000).when(unit == "M", amount)


def valid_email(col, blocked: Sequence[str]) -> Column:
    """Looks like an address and matches none of the blocked LIKE patterns."""
    c = F.lower(F.trim(_c(col)))
    shape = c.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$")
    return reduce(lambda ok, p: ok & ~c.like(p), blocked, shape)


def like_any(col, patterns: Sequence[str], ignore_case: bool = False) -> Column:
    c = _c(col)
    tests = [c.ilike(p) if ignore_case else c.like(p) for p in patterns]
    return reduce(lambda a, b: a | b, tests)


def first_match(col, rules: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """Label of the first LIKE pattern that fits (case-insensitive)."""
    c, out = _c(col), F
    for pattern, label in rules:
        out = out.when(c.ilike(pattern), label)
    return out.otherwise(default)


def rule_ladder(rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """Label of the first condition that holds."""
    out = F
    for cond, label in rules:
        out = out.when(cond, label)
    return out.otherwise(default)


def bucketize(col, bounds: Sequence[float], labels: Sequence[str], missing: str | None = None) -> Column:
    """``labels[i]`` for the first upper bound with value <= bound, last label above all bounds."""
    c, out = _c(col), F
    for bound, label in zip(bounds, labels):
        out = out.when(c <= bound, label)
    return out.when(c.isNotNull(), labels[-1]).otherwise(missing)


def code_map(col, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Code to name by a literal map."""
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), _c(col)), F.lit(default))


def segment(b2b, pme) -> Column:
    """Business flag wins over small-business flag, else consumer."""
    return F.when(_c(b2b), "B2B").when(_c(pme), "PME").otherwise("B2C")


def weak_secret(secret, document) -> Column:
    """Does the secret contain the digits of the document?"""
    digits = digits_only(document)
    return (F.length(digits) > 0) & F.contains(digits_only(secret), digits)


def surrogate_key(*cols, null_token: str = NULL_TOKEN) -> Column:
    """MD5 of the '-'-joined texts of the columns, NULLs as a fixed token."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(null_token)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def url_host(col) -> Column:
    bare = F.regexp_replace(_c(col), r"^(https?|android-app)://", "")
    return F.regexp_extract(bare, r"^([^/?]*)", 1)


def url_path(col) -> Column:
    bare = F.regexp_replace(_c(col), r"^https?://", "")
    return F.regexp_extract(bare, r"^[^/?]*/?([^?]*)", 1)


def url_parameter(col, name: str) -> Column:
    value = F.regexp_extract(_c(col), name + r"=([^&]*)", 1)
    return F.when(value != "", value)


def empty_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Empty strings to NULL in all (or the named) string columns."""
    names = [n for n, t in df.dtypes if t == "string" and (columns is None or n in columns)]
    return df.withColumns({n: F.nullif(F.col(n), F.lit("")) for n in names})


def star(df: DataFrame, exclude: Sequence[str] = (), prefix: str = "", suffix: str = "") -> DataFrame:
    """All columns but ``exclude``, renamed with a prefix and suffix."""
    return df.select(*[F.col(c).alias(f"{prefix}{c}{suffix}") for c in df.columns if c not in exclude])
