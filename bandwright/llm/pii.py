"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors of a text in one pass: at-signs, plus signs, digits, URL schemes and the
words that introduce an identifier. From each anchor a small parser walks outwards to the boundaries of the item and
validates it. Text without anchors costs nothing more.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import arrow_function, shielded, unshielded

# Kinds in output order, characters, and cues.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "address", "account")
DIGITS = frozenset("0123456789")
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
LABEL = frozenset(string.ascii_letters + string.digits + "-")
PHONE = frozenset(" ().-0123456789")
USER_INFO = LOCAL | frozenset("!$&'()*,;=:~")
ALPHANUMERIC = frozenset(string.ascii_letters + string.digits)
SCHEMES = ("://", "mailto:", "tel:")
CUES = ("iban", "account", "acct", "ssn", "passport", "routing")

SPAN_TYPE = "array<struct<kind:string,start:int,end:int>>"


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for anchor in ("@", "+", *sorted(DIGITS), *SCHEMES, *CUES):
        found.add_word(anchor, (anchor, len(anchor)))
    found.make_automaton()
    return found


_ANCHORS = _automaton()


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _ahead(text: str, at: int, allowed: frozenset) -> int:
    while at < len(text) and text[at] in allowed:
        at += 1
    return at


def _back(text: str, at: int, floor: int, allowed: frozenset) -> int:
    while at > floor and text[at - 1] in allowed:
        at -= 1
    return at


def email_at(text: str, sign: int, floor: int) -> tuple[int, int] | None:
    """Around the at-sign: a local part not before `floor`, and a domain of at least two labels."""
    start, label = _back(text, sign, floor, LOCAL), _ahead(text, sign + 1, LABEL)
    if start == sign or label == sign + 1:
        return None
    end = label
    while end < len(text) and text[end] == "." and (after := _ahead(text, end + 1, LABEL)) > end + 1:
        end = after
    return (start, end) if end > label else None


def dotted_at(text: str, start: int) -> tuple[int, bool] | None:
    """Four runs of digits joined by dots from `start`: their end, and whether none is above 255."""
    at, small = start, True
    for part in range(4):
        if part:
            if at >= len(text) or text[at] != ".":
                return None
            at += 1
        end = _ahead(text, at, DIGITS)
        if end == at:
            return None
        value = text[at:end].lstrip("0")
        small &= len(value) < 3 or len(value) == 3 and value <= "255"
        at = end
    return at, small


def digits_at(text: str, start: int) -> int:
    """End of the run of digits that single spaces or hyphens may separate."""
    at = start + 1
    while True:
        at = _ahead(text, at, DIGITS)
        if at + 1 < len(text) and text[at] in " -" and text[at + 1] in DIGITS:
            at += 2
        else:
            return at


def phone_at(text: str, plus: int) -> int | None:
    """End of a phone number that starts at the plus sign, its last character a digit."""
    if plus + 1 >= len(text) or text[plus + 1] not in DIGITS:
        return None
    end = _ahead(text, plus + 2, PHONE)
    while end > plus + 3 and text[end - 1] not in DIGITS:
        end -= 1
    return end if end > plus + 3 else None


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def address_at(text: str, anchor: str, start: int, end: int) -> tuple[int, int] | None:
    """An address that names a person: `scheme://user@host`, `mailto:` an e-mail, `tel:` a number."""
    if anchor == "mailto:":
        last = _ahead(text, end, LOCAL)
        found = email_at(text, last, end) if last < len(text) and text[last] == "@" else None
        return (start, found[1]) if found and found[0] == end else None
    if anchor == "tel:":
        first = end + (end < len(text) and text[end] == "+")
        last = _ahead(text, first, PHONE)
        last = _back(text, last, first, PHONE - DIGITS)
        return (start, last) if 8 <= len(_only_digits(text[first:last])) <= 15 else None
    scheme = _back(text, start, 0, ALPHANUMERIC | {"+", ".", "-"})
    while scheme < start and not text[scheme].isascii() or scheme < start and text[scheme] not in string.ascii_letters:
        scheme += 1
    user = _ahead(text, end, USER_INFO)
    if scheme == start or user == end or user >= len(text) or text[user] != "@":
        return None
    host = _ahead(text, user + 1, LABEL | {"."})
    host = _back(text, host, user + 1, frozenset(".-"))
    return (scheme, host) if host > user + 1 else None


def account_at(text: str, cue: str, start: int, end: int) -> tuple[int, int] | None:
    """The identifier that follows a cue and at most a separator, if it is valid for that cue."""
    if start and text[start - 1] in ALPHANUMERIC:
        return None
    at = end
    for word in (" number", " no.", " no"):
        if text[at : at + len(word)].lower() == word:
            at += len(word)
            break
    gap = _ahead(text, at, frozenset(" :=#"))
    if gap == at or gap - at > 4:
        return None
    if cue == "iban":
        last, kept = gap, ""
        while len(kept) < 34 and last < len(text):
            if text[last] in ALPHANUMERIC:
                kept += text[last]
            elif not (text[last] == " " and last + 1 < len(text) and text[last + 1] in ALPHANUMERIC):
                break
            last += 1
            if len(kept) >= 15 and _iban(kept) and (last == len(text) or text[last] not in ALPHANUMERIC):
                return gap, last
        return None
    allowed = DIGITS | {"-"} if cue in ("ssn", "account", "acct", "routing") else ALPHANUMERIC
    last = _ahead(text, gap, allowed)
    last = _back(text, last, gap, frozenset("-"))
    digits = len(_only_digits(text[gap:last]))
    if last < len(text) and text[last] in ALPHANUMERIC:
        return None
    valid = {"ssn": digits == 9, "routing": digits == 9}.get(cue, 6 <= digits <= 20)
    return (gap, last) if valid else None


def _iban(value: str) -> bool:
    value = value.upper()
    if not (value[:2].isalpha() and value[2:4].isdigit()):
        return False
    turned = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def find_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """All items of a text as (kind, start, end) in code points, each kind from left to right without overlap."""
    lowered = text.lower()
    if len(lowered) != len(text):  # a letter that grows when lowered would move what follows
        lowered = re.sub("[A-Z]+", lambda m: m.group().lower(), text)
    done = dict.fromkeys(KINDS, 0)
    for last, (anchor, length) in _ANCHORS.iter(lowered):
        start, end = last + 1 - length, last + 1
        if anchor == "@":
            found = email_at(text, start, done["email"])
            if found and start >= done["email"]:
                done["email"] = found[1]
                yield "email", *found
        elif anchor == "+":
            if start >= done["phone"] and (stop := phone_at(text, start)):
                done["phone"] = stop
                if 8 <= len(_only_digits(text[start:stop])) <= 15:
                    yield "phone", start, stop
        elif anchor in DIGITS:
            if start >= done["card"]:
                stop = digits_at(text, start)
                done["card"] = stop
                digits = _only_digits(text[start:stop]) if stop - start >= 16 else ""
                if 16 <= len(digits) <= 19 and luhn(digits):
                    yield "card", start, stop
            if start >= done["ip"] and end < len(text) and text[end] == ".":
                head = _back(text, start, done["ip"], DIGITS)
                if found := dotted_at(text, head):
                    done["ip"] = found[0]
                    if found[1]:
                        yield "ip", head, found[0]
        elif anchor in SCHEMES:
            found = address_at(text, anchor, start, end)
            if found and found[0] >= done["address"]:
                done["address"] = found[1]
                yield "address", *found
        else:
            found = account_at(text, anchor, start, end)
            if found and found[0] >= done["account"]:
                done["account"] = found[1]
                yield "account", *found


def spans(text: Column) -> Column:
    """Array of (kind, start, end), ordered by kind as in `KINDS`, then start; empty for NULL and for text without."""
    place = {kind: i for i, kind in enumerate(KINDS)}

    def of(batch: pa.Array) -> pa.Array:
        out = []
        for value in batch:
            found = sorted((place[k], i, j) for k, i, j in find_spans(value.as_py())) if value.is_valid else []
            out.append([{"kind": KINDS[k], "start": i, "end": j} for k, i, j in found])
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        return pa.array(out, pa.list_(kind))

    return arrow_function(of, SPAN_TYPE)(F.coalesce(text, F.lit("")))


def joined_spans(found: Column) -> Column:
    return F.array_join(
        F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows with `pii`, the spans of every item found, in code points, ends exclusive.

    * Kinds: email, ip, card (Luhn), phone as plain patterns define them; `address` (a URL with user information,
      `mailto:`, `tel:`) and `account` (an identifier after a cue such as IBAN or SSN). Kinds may overlap each other.
    * Whole texts, in one pass and without a shuffle. NULL and empty texts have no spans.
    * An input column named `pii` gives way to the output.
    """
    inner, names = shielded(docs, text)
    return unshielded(inner, docs.columns, {"pii": spans(F.col(names[text]))})


def redact_text(text: str) -> str:
    """The text with every item replaced by its kind in brackets; of overlapping items the first, then longest."""
    out, at = [], 0
    for start, end, kind in sorted(((i, j, k) for k, i, j in find_spans(text)), key=lambda x: (x[0], -x[1])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The same rows and columns, personal data in the text replaced by its kind, and its length put right.

    NULL texts stay NULL. Overlapping items are replaced by one mark.
    """
    inner, names = shielded(docs, text)

    def of(batch: pa.Array) -> pa.Array:
        return pa.array([redact_text(x.as_py()) if x.is_valid else None for x in batch], pa.string())

    clean = arrow_function(of, "string")(F.col(names[text]))
    inner = inner.withColumn(names[text], clean)
    if n_chars in names:
        kind = docs.schema[n_chars].dataType
        inner = inner.withColumn(names[n_chars], F.length(names[text]).cast(kind))
    return unshielded(inner, docs.columns, {})
