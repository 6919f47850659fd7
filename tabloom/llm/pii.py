"""Personal data by anchor expansion: an automaton finds cues, local parsers find the boundaries."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabloom.llm.common import add_struct

_DIGIT = frozenset("0123456789")
_ALPHA = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LOCAL = _ALPHA | _DIGIT | frozenset("._%+-")
_LABEL = _ALPHA | _DIGIT | frozenset("-")
_PHONE = _DIGIT | frozenset(" ().-")
_SECRET = _ALPHA | _DIGIT | frozenset("_-+/.")
_URL_STOP = frozenset(" \t\n\r\x0b\x0c\"'<>`{}|\\^")
#: Base kinds first, in this order, then the kinds of further cues.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "ssn", "secret")
# Cues of links and of credentials (matched without case), and country codes of account numbers with their lengths.
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
CREDENTIALS = ("password", "passwd", "api_key", "apikey", "api key", "token", "secret")
ACCOUNTS = {"AT": 20, "BE": 16, "CH": 21, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "IE": 22, "IT": 27,
            "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24}
_FOLD = {i: i + 32 for i in range(65, 91)}
RESULT = "struct<spans:array<struct<kind:string,start:int,end:int>>>"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if k % 2 == 0 else (2 * v if v < 5 else 2 * v - 9)
    return total % 10 == 0


def _run(text: str, at: int, chars: frozenset) -> int:
    n = len(text)
    while at < n and text[at] in chars:
        at += 1
    return at


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign at ``at`` that starts at ``floor`` or later."""
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    end = _run(text, at + 1, _LABEL)
    if start == at or end == at + 1:
        return None
    last = None
    while end < len(text) and text[end] == ".":
        stop = _run(text, end + 1, _LABEL)
        if stop == end + 1:
            break
        end = last = stop
    return (start, last) if last else None


def ip_at(text: str, start: int) -> tuple[int, int] | None:
    """Four dotted numbers from the first digit of a run."""
    end = _run(text, start, _DIGIT)
    for _ in range(3):
        if end + 1 >= len(text) or text[end] != "." or text[end + 1] not in _DIGIT:
            return None
        end = _run(text, end + 1, _DIGIT)
    return start, end


def small(digits: str) -> bool:
    """At most 255, whatever the number of leading zeros."""
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def card_at(text: str, start: int) -> tuple[int, int] | None:
    """Digits with single blanks or hyphens between them, two digits at least."""
    end = start + 1
    while True:
        if end < len(text) and text[end] in _DIGIT:
            end += 1
        elif end + 1 < len(text) and text[end] in " -" and text[end + 1] in _DIGIT:
            end += 2
        else:
            return (start, end) if end > start + 1 else None


def phone_at(text: str, plus: int) -> tuple[int, int] | None:
    """A plus sign and a digit, then digits, blanks, dots, brackets and hyphens up to the last digit."""
    if plus + 1 >= len(text) or text[plus + 1] not in _DIGIT:
        return None
    end = _run(text, plus + 2, _PHONE)
    while end > plus + 2 and text[end - 1] not in _DIGIT:
        end -= 1
    return (plus, end) if end >= plus + 4 else None


def url_at(text: str, start: int, after: int) -> tuple[int, int] | None:
    end = after
    while end < len(text) and text[end] not in _URL_STOP:
        end += 1
    while end > after and text[end - 1] in ".,;:!?)":
        end -= 1
    return (start, end) if end > after else None


def iban_at(text: str, start: int) -> tuple[int, int] | None:
    """An account number: country, check digits, the country's length, and remainder 1 of 97."""
    size = ACCOUNTS[text[start : start + 2]]
    end, taken = start, []
    while end < len(text) and len(taken) < size:
        if text[end] in _DIGIT or "A" <= text[end] <= "Z":
            taken.append(text[end])
        elif text[end] != " " or not taken:
            return None
        end += 1
    if len(taken) < size or (end < len(text) and text[end] in _ALPHA | _DIGIT) or (start and text[start - 1] in _ALPHA | _DIGIT):
        return None
    moved = "".join(taken[4:] + taken[:4])
    return (start, end) if int("".join(str(int(c, 36)) for c in moved)) % 97 == 1 else None


def ssn_at(text: str, start: int) -> tuple[int, int] | None:
    """ddd-dd-dddd that stands alone, without the numbers that are never given out."""
    part = text[start : start + 11]
    if len(part) < 11 or part[3] != "-" or part[6] != "-" or not (part[:3] + part[4:6] + part[7:]).isascii() or not (part[:3] + part[4:6] + part[7:]).isdigit():
        return None
    if (start and (text[start - 1] in _DIGIT or text[start - 1] == "-")) or (start + 11 < len(text) and (text[start + 11] in _DIGIT or text[start + 11] == "-")):
        return None
    return (start, start + 11) if part[:3] not in ("000", "666") and part[0] != "9" and part[4:6] != "00" and part[7:] != "0000" else None


def secret_at(text: str, after: int) -> tuple[int, int] | None:
    """The value behind a credential cue and = or :, with quotes or blanks, eight signs at least, a digit among them."""
    at = _run(text, after, frozenset(" "))
    if at >= len(text) or text[at] not in "=:":
        return None
    start = _run(text, at + 1, frozenset(" \"'"))
    end = _run(text, start, _SECRET)
    value = text[start:end]
    return (start, end) if len(value) >= 8 and any(c in _DIGIT for c in value) else None


def automaton() -> ahocorasick.Automaton:
    """Cues: at-signs, plus signs with a digit, digits, schemes, credential words and account countries."""
    cues = ahocorasick.Automaton()
    cues.add_word("@", ("@", 1))
    for d in sorted(_DIGIT):
        cues.add_word(d, ("digit", 1))
        cues.add_word("+" + d, ("+", 2))
        for country in ACCOUNTS:
            cues.add_word(country.lower() + d, ("iban", 3))
    for s in SCHEMES:
        cues.add_word(s, ("url", len(s)))
    for c in CREDENTIALS:
        cues.add_word(c, ("secret", len(c)))
    cues.make_automaton()
    return cues


def find_spans(text: str, cues: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in code points, sorted by kind and start.

    Per kind, matches are leftmost and do not overlap; one that fails its check is dropped, not tried again
    from a later start.
    """
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    free = dict.fromkeys(KINDS, 0)
    run_end = 0  # digits before it belong to a run already seen

    def take(kind: str, span: tuple[int, int] | None, valid: bool = True) -> None:
        if span:
            free[kind] = span[1]
            if valid:
                out[kind].append(span)

    for last, (cue, size) in cues.iter(text.translate(_FOLD)):
        at = last - size + 1
        if cue == "@":
            take("email", email_at(text, at, free["email"]))
        elif cue == "digit":
            if at >= free["card"]:
                span = card_at(text, at)
                digits = "".join(c for c in text[span[0] : span[1]] if c in _DIGIT) if span else ""
                take("card", span, 13 <= len(digits) <= 19 and luhn(digits))
            if at >= free["ip"] and (at >= run_end or at == free["ip"]):
                span = ip_at(text, at)
                take("ip", span, bool(span) and all(small(p) for p in text[span[0] : span[1]].split(".")))
            if at >= run_end:
                run_end = _run(text, at, _DIGIT)
                if run_end - at == 3 and at >= free["ssn"]:
                    take("ssn", ssn_at(text, at))
        elif cue == "+":
            if at >= free["phone"]:
                span = phone_at(text, at)
                take("phone", span, bool(span) and 9 <= sum(c in _DIGIT for c in text[span[0] : span[1]]) <= 15)
        elif cue == "url":
            if at >= free["url"]:
                take("url", url_at(text, at, last + 1))
        elif cue == "iban":
            if at >= free["iban"] and text[at : at + 2] in ACCOUNTS:
                take("iban", iban_at(text, at))
        elif at >= free["secret"]:
            take("secret", secret_at(text, last + 1))
    return [(k, a, b) for k in KINDS for a, b in sorted(out[k])]


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``spans`` (kind, start, end in code points, end exclusive) of every whole text; a column of that name is replaced.

    An Aho-Corasick automaton finds the cues in one pass; a parser per cue expands to both sides and checks the
    result (number ranges, check digits, lengths). Kinds: email, ip, card, phone, and of further cues url, iban, ssn, secret.
    A null or empty text has no spans.
    """
    kind = pa.struct([("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))])

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cues = automaton()
        for batch in batches:
            yield pa.array([{"spans": [{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t.as_py() or "", cues)]} for t in batch], kind)

    return add_struct(docs, F.arrow_udf(scan, RESULT)(F.col(text)), ["spans"])


def n_spans(kind: str):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def joined_spans(kinds: tuple[str, ...]):
    """kind:start:end of the spans of these kinds, in order."""
    chosen = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(found: DataFrame, text: str = "text") -> DataFrame:
    """Replace every span by its kind in brackets; overlapping spans become the first one's."""

    def mask(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            out = []
            for t, own in zip(texts.to_pylist(), spans.to_pylist()):
                parts, at = [], 0
                for s in sorted(own or [], key=lambda s: (s["start"], -s["end"])):
                    if s["start"] >= at:
                        parts += [t[at : s["start"]], f"[{s['kind']}]"]
                    at = max(at, s["end"])
                out.append(t if not own else "".join([*parts, t[at:]]))
            yield pa.array(out, pa.string())

    return found.withColumn(text, F.arrow_udf(mask, "string")(F.col(text), F.col("spans")))
