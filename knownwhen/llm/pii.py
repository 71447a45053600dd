"""Personal data by anchor expansion.

An Aho-Corasick automaton runs once over a text and stops at anchors: at-signs,
schemes, plus signs, digits and words that announce an account. At each anchor a
small deterministic parser expands to the left and right, finds the boundaries and
validates what it found. Nothing is ever searched twice, so the work grows with the
text and the number of anchors.

Kinds, in this order (offsets are code points, ends exclusive):

=======  ==================================================================
email    at-sign; name to the left, host with a dot to the right
ip       digit; runs of four dotted numbers, each at most 255
card     digit; digits with single blanks or hyphens, 13 to 19, Luhn checksum
phone    plus sign; 9 to 15 digits with blanks, dots, hyphens, brackets
url      scheme (http, https, ftp, ftps, mailto, tel); up to white space, a quote or an
         angle bracket, without closing punctuation
iban     two letters and two digits of an account number; ISO 13616 checksum
account  an announcing word (account, iban, ssn, passport, ...), then a number of
         6 to 34 characters that holds at least 5 digits
secret   an announcing word (token, password, api key, ...), an equals sign or
         colon, then at least 8 characters without blanks
=======  ==================================================================

The first four are exact: matches are leftmost and don't overlap within their kind,
and a match that fails its validation is dropped without a second try. The other
kinds only add spans. Defined results: a null text is an empty one; repeated rows
give a row each time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownwhen.llm import frames as fr
from knownwhen.llm import text as tx

BASE = ("email", "ip", "card", "phone")
MORE = ("url", "iban", "account", "secret")
SCHEMES = ("http://", "https://", "ftp://", "ftps://", "mailto:", "tel:")
ACCOUNT_CUES = ("account", "acct", "iban", "ssn", "passport", "konto", "compte", "cuenta",
                "routing", "tax id", "national id", "social security")
SECRET_CUES = ("token", "password", "passwd", "secret", "api_key", "api key", "apikey",
               "access_key", "private_key")

_DIGITS = frozenset("0123456789")
_UPPER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_ALNUM = _DIGITS | _UPPER | frozenset("abcdefghijklmnopqrstuvwxyz")
_NAME = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

Spans = dict[str, list[tuple[int, int]]]


# ------------------------------------------------------------------ parsers

def _run(text: str, at: int, allowed: frozenset[str]) -> int:
    """The end of the run of allowed characters that begins at ``at``."""
    end = len(text)
    while at < end and text[at] in allowed:
        at += 1
    return at


def _email(text: str, sign: int, after: int) -> tuple[int, int] | None:
    """The address around an at-sign, no part of it before ``after``."""
    begin = sign
    while begin > after and text[begin - 1] in _NAME:
        begin -= 1
    if begin == sign:
        return None
    end = _run(text, sign + 1, _LABEL)
    if end == sign + 1:
        return None
    dots = 0
    while end < len(text) and text[end] == ".":
        part = _run(text, end + 1, _LABEL)
        if part == end + 1:
            break
        end, dots = part, dots + 1
    return (begin, end) if dots else None


def _ips(text: str, at: int) -> tuple[list[tuple[int, int]], int]:
    """Addresses in the dotted numbers from the digit at ``at`` on, and where these end."""
    numbers = []
    while True:
        end = _run(text, at, _DIGITS)
        numbers.append((at, end))
        if end + 1 < len(text) and text[end] == "." and text[end + 1] in _DIGITS:
            at = end + 1
        else:
            break
    found = []
    for k in range(0, len(numbers) - 3, 4):
        four = numbers[k:k + 4]
        if all(len(text[a:b].lstrip("0")) <= 3 and int(text[a:b].lstrip("0")[:3] or 0) <= 255
               for a, b in four):
            found.append((four[0][0], four[3][1]))
    return found, end


def _card_run(text: str, at: int) -> int:
    """The end of the digits from ``at`` on, with single blanks or hyphens between them."""
    while True:
        at = _run(text, at, _DIGITS)
        if at + 1 < len(text) and text[at] in " -" and text[at + 1] in _DIGITS:
            at += 1
        else:
            return at


def _luhn(digits: list[int]) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        if place % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _is_card(text: str, begin: int, end: int) -> bool:
    if end - begin < 13:
        return False
    digits = [ord(c) - 48 for c in text[begin:end] if c in _DIGITS]
    return 13 <= len(digits) <= 19 and _luhn(digits)


def _phone(text: str, plus: int) -> tuple[int, int] | None:
    """The run from a plus sign to its last digit; None if there is no match at all."""
    if plus + 1 >= len(text) or text[plus + 1] not in _DIGITS:
        return None
    end = _run(text, plus + 2, _PHONE)
    while end > plus + 2 and text[end - 1] not in _DIGITS:
        end -= 1
    return (plus, end) if end >= plus + 4 else None


def _is_phone(text: str, begin: int, end: int) -> bool:
    return 9 <= sum(c in _DIGITS for c in text[begin:end]) <= 15


def _url(text: str, begin: int, body: int, after: int) -> tuple[int, int] | None:
    if begin < after:
        return None
    if begin and text[begin - 1].isalnum():
        return None
    end = body
    while end < len(text) and text[end] not in "<>\"'`" and not text[end].isspace():
        end += 1
    while end > body and text[end - 1] in ".,;:!?)]}":
        end -= 1
    return (begin, end) if end > body else None


def _iban(text: str, digits: int) -> tuple[int, int] | None:
    """An account number whose check digits begin at ``digits``."""
    begin = digits - 2
    if begin < 0 or text[begin] not in _UPPER or text[begin + 1] not in _UPPER:
        return None
    if begin and text[begin - 1].isalnum():
        return None
    end, size, last = begin, 0, begin
    while end < len(text) and size < 34:
        if text[end] in _DIGITS or text[end] in _UPPER:
            size, last = size + 1, end + 1
        elif text[end] != " " or end + 1 >= len(text) or text[end + 1] == " ":
            break
        end += 1
    # Words may follow after a blank: the longest prefix whose checksum holds.
    while size >= 15:
        plain = text[begin:last].replace(" ", "")
        moved = plain[4:] + plain[:4]
        if int("".join(str(int(c, 36)) for c in moved)) % 97 == 1:
            return begin, last
        last -= 1
        while last > begin and text[last - 1] == " ":
            last -= 1
        size -= 1
    return None


def _account(text: str, at: int, after: int) -> tuple[int, int] | None:
    """A number that an announcing word, ending at ``at``, is followed by."""
    stop = min(len(text), at + 16)
    while at < stop and text[at] not in _DIGITS:
        if text[at] == "\n" or not (text[at] in " :#=.-" or text[at] in _ALNUM):
            return None
        at += 1
    if at >= stop or at < after:
        return None
    end, digits, last = at, 0, at
    while end < len(text) and (text[end] in _DIGITS or text[end] in " -"):
        if text[end] in _DIGITS:
            digits, last = digits + 1, end + 1
        elif end + 1 < len(text) and text[end + 1] not in _DIGITS:
            break
        end += 1
    return (at, last) if digits >= 5 and last - at >= 6 else None


def _secret(text: str, at: int, after: int) -> tuple[int, int] | None:
    """What stands behind the equals sign or colon after an announcing word."""
    end = len(text)
    while at < end and text[at] in " \t\"'":
        at += 1
    if at >= end or text[at] not in "=:":
        return None
    at += 1
    while at < end and text[at] in " \t\"'":
        at += 1
    if at < after:
        return None
    stop = at
    while stop < end and not text[stop].isspace() and text[stop] not in "\"'`,;":
        stop += 1
    return (at, stop) if stop - at >= 8 else None


# ------------------------------------------------------------------ finder

def automaton():
    """All anchors, lower-case: single signs, digits, schemes and announcing words."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for word, kind in [("@", "at"), ("+", "plus"), *[(d, "digit") for d in sorted(_DIGITS)],
                       *[(s, "scheme") for s in SCHEMES], *[(c, "account") for c in ACCOUNT_CUES],
                       *[(c, "secret") for c in SECRET_CUES]]:
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def spans(text: str | None, anchors) -> Spans:
    """All spans by kind, each kind from left to right without overlaps."""
    found: Spans = {kind: [] for kind in (*BASE, *MORE)}
    if not text:
        return found
    after = dict.fromkeys((*BASE, *MORE), 0)  # where the next match of a kind may begin

    def add(kind: str, span: tuple[int, int] | None) -> None:
        if span and span[0] >= after[kind]:
            found[kind].append(span)
            after[kind] = span[1]

    # Only A-Z, so that places stay what they are.
    folded = text.lower() if text.isascii() else text.translate(_LOWER)
    for last, (kind, length) in anchors.iter(folded):
        begin = last - length + 1
        if kind == "digit":
            if begin >= after["ip"]:
                ips, after["ip"] = _ips(text, begin)
                found["ip"].extend(ips)
            if begin >= after["card"]:
                after["card"] = _card_run(text, begin)
                if _is_card(text, begin, after["card"]):
                    found["card"].append((begin, after["card"]))
            if begin >= after["iban"] and last + 1 < len(text) and text[last + 1] in _DIGITS:
                add("iban", _iban(text, begin))
        elif kind == "at":
            add("email", _email(text, begin, after["email"]))
        elif kind == "plus":
            if begin >= after["phone"]:
                span = _phone(text, begin)
                if span:
                    after["phone"] = span[1]
                    if _is_phone(text, *span):
                        found["phone"].append(span)
        elif kind == "scheme":
            add("url", _url(text, begin, last + 1, after["url"]))
        elif kind == "account":
            add("account", _account(text, last + 1, after["account"]))
        else:
            add("secret", _secret(text, last + 1, after["secret"]))
    return found


def listed(found: Spans, kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per row of ``docs``, and the
    numbers of added spans, n_url, n_iban, n_account, n_secret."""
    fr.bounded_batches(docs.sparkSession)
    docs = fr.documents(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for rows in tx.slices(batches):
            found = [spans(t, anchors) for t in rows["text"]]
            base = [hashlib.sha256(listed(f, BASE).encode()).hexdigest() for f in found]
            yield pa.RecordBatch.from_arrays([
                pa.array(rows["doc_id"], pa.int64()),
                *[pa.array([len(f[k]) for f in found], pa.int64()) for k in BASE],
                pa.array(base, pa.string()),
                pa.array([listed(f, (*BASE, *MORE)) for f in found], pa.string()),
                *[pa.array([len(f[k]) for f in found], pa.int64()) for k in MORE]],
                names=["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans",
                       *[f"n_{k}" for k in MORE]])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
             "base_sha256 string, spans string, "
             "n_url long, n_iban long, n_account long, n_secret long")
