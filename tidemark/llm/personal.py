"""Personal data by anchors: one Aho-Corasick pass finds at-signs, plus signs, digits, schemes and identifier
cues; a small parser for each kind of anchor then expands to the exact boundaries and validates.

Base kinds are those of these patterns, leftmost and without overlap in their kind; a match that fails its test is
dropped and not tried again:

* ``email``  ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ``ip``     ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)``, parts at most 255
* ``card``   ``[0-9]([\\x20-]?[0-9])+``, 14 to 19 digits passing Luhn
* ``phone``  ``\\+[0-9][\\x20().0-9-]+[0-9]``, 10 to 15 digits

Added kinds: ``url`` (a scheme, then an address that names a person by user info, ``~name`` or a user folder) and
``account`` (a cue such as IBAN or account no., then a number; IBANs must pass modulo 97).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")

_DIGITS = frozenset("0123456789")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")

SCHEMES = ("http://", "https://", "ftp://", "ssh://", "sftp://")
CUES = ("iban", "account", "acct", "konto", "kontonummer", "compte", "cuenta", "passport", "ssn")
USER_FOLDERS = ("~", "user/", "users/", "u/", "profile/", "people/", "member/", "members/", "@")

_digit_run = re.compile("[0-9]*")
_label_run = re.compile("[A-Za-z0-9-]*")
_phone_run = re.compile(r"[\x20().0-9-]*")
_card_run = re.compile(r"(?:[\x20-]?[0-9])*")
_link_run = re.compile(r"(?:[^\x00-\x20\"'<>\\^`{|}\x7f:]|:(?!//))*")
_cue_gap = re.compile(r"(?:\x20?(?:no|nr|number|num|id)\b)?[.:#=\x20]{0,4}", re.I)
_account_run = re.compile(r"[A-Za-z]{0,2}[0-9](?:[\x20-]?[A-Za-z0-9]){0,40}")


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    for d in _DIGITS:
        found.add_word(d, ("digit", 1))
    for kind, words in (("scheme", SCHEMES), ("cue", CUES)):
        for w in words:
            for form in {w, w.upper(), w.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def email_at(text: str, at: int, low: int) -> tuple[int, int] | None:
    """The address around the at-sign, not reaching below ``low``."""
    end = _label_run.match(text, at + 1).end()
    if end == at + 1:
        return None
    labels = 0
    while end < len(text) and text[end] == ".":
        stop = _label_run.match(text, end + 1).end()
        if stop == end + 1:
            break
        end, labels = stop, labels + 1
    if not labels:
        return None
    start = at
    while start > low and text[start - 1] in _LOCAL:
        start -= 1
    return (start, end) if start < at else None


def ip_at(text: str, start: int) -> tuple[int, bool, bool]:
    """(end, whether the form fits, whether all parts are in range); without fit the end of the digits."""
    end = first = _digit_run.match(text, start).end()
    parts = [text[start:end]]
    for _ in range(3):
        if not (end + 1 < len(text) and text[end] == "." and text[end + 1] in _DIGITS):
            return first, False, False
        stop = _digit_run.match(text, end + 1).end()
        parts.append(text[end + 1 : stop])
        end = stop
    return end, True, all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def card_at(text: str, start: int) -> tuple[int, bool]:
    """(end of the digits with single blanks or hyphens between, whether they are a card number)."""
    end = _card_run.match(text, start + 1).end()
    if end - start > 40:
        return end, False
    digits = text[start:end].replace(" ", "").replace("-", "")
    return end, 14 <= len(digits) <= 19 and _luhn(digits)


def phone_at(text: str, start: int) -> tuple[int, bool] | None:
    """(end, whether it has 10 to 15 digits), or None where the form does not fit."""
    if not (start + 1 < len(text) and text[start + 1] in _DIGITS):
        return None
    run = _phone_run.match(text, start + 2).group().rstrip(" ().-")
    if len(run) < 2:
        return None
    return start + 2 + len(run), 10 <= 1 + sum(map(run.count, "0123456789")) <= 15


def url_at(text: str, start: int, rest: int) -> int | None:
    """The end of an address that names a person, else None."""
    run = _link_run.match(text, rest).group().rstrip(".,;:!?)]")
    authority, _, path = run.partition("/")
    user, sign, host = authority.rpartition("@")
    if not host or "." not in host:
        return None
    if (sign and user) or any(path.startswith(p) and len(path) > len(p) for p in USER_FOLDERS):
        return rest + len(run)
    return None


def account_at(text: str, cue: str, start: int) -> tuple[int, int] | None:
    """The number behind a cue, else None."""
    begin = _cue_gap.match(text, start).end()
    if begin == start:
        return None
    found = _account_run.match(text, begin)
    if not found:
        return None
    solid = found.group()
    if cue == "iban":
        tight = ""
        for end, c in enumerate(solid):
            tight += c if c not in " -" else ""
            if len(tight) > 34:
                break
            if len(tight) >= 15 and _iban(tight) and (end + 1 == len(solid) or solid[end + 1] in " -"):
                return begin, begin + end + 1
        return None
    solid = re.match(r"[A-Za-z]{0,2}[0-9](?:[\x20-]?[0-9])*", solid).group()
    digits = sum(map(solid.count, "0123456789"))
    return (begin, begin + len(solid)) if 6 <= digits <= 20 else None


def _iban(tight: str) -> bool:
    if not (tight[:2].isalpha() and tight[2:4].isdigit() and tight.isascii() and tight.isalnum()):
        return False
    return int("".join(str(int(c, 36)) for c in tight[4:] + tight[:4])) % 97 == 1


def spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind."""
    out: list[tuple[str, int, int]] = []
    done = dict.fromkeys(KINDS, 0)
    for last, (anchor, width) in _anchors().iter(text):
        at = last - width + 1
        if anchor == "digit":
            if at >= done["ip"]:
                end, fits, good = ip_at(text, at)
                done["ip"] = end
                if fits and good:
                    out.append(("ip", at, end))
            if at >= done["card"]:
                end, good = card_at(text, at)
                done["card"] = end
                if good:
                    out.append(("card", at, end))
        elif anchor == "at":
            if at >= done["email"] and (got := email_at(text, at, done["email"])):
                done["email"] = got[1]
                out.append(("email", *got))
        elif anchor == "plus":
            if at >= done["phone"] and (got := phone_at(text, at)):
                done["phone"] = got[0]
                if got[1]:
                    out.append(("phone", at, got[0]))
        elif anchor == "scheme":
            if at >= done["url"] and (end := url_at(text, at, last + 1)):
                done["url"] = end
                out.append(("url", at, end))
        elif at >= done["account"] and not (at and text[at - 1].isalnum()):
            if got := account_at(text, text[at : last + 1].lower(), last + 1):
                done["account"] = got[1]
                out.append(("account", *got))
    out.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    return out


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        rows = []
        for text in batch.column(1):
            found = spans(text.as_py() or "")
            rows.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "spans"])


def personal_data(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and ``spans``, an array of (kind, start, end) by start.

    Offsets count code points, the end is exclusive.  Null and empty texts have no spans; null and repeated ids are
    handed through.  Other columns are not looked at.  One pass, no shuffle.
    """
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return slim.mapInArrow(_found, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")
