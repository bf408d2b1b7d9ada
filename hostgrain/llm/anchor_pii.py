"""Personal data by anchor expansion.

One Aho-Corasick pass finds the anchors of a text: at-signs, dots before a
digit, digits, plus signs, schemes and identifier cues. From each anchor a small
deterministic parser walks outwards to the bounds of the address or number and
validates it. Anchors inside the match before are skipped, which gives the
leftmost non-overlapping matches of each kind.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostgrain.llm.spans import Span, span_columns
from hostgrain.llm.storage import table

KINDS = ("email", "ip", "card", "phone", "login", "account", "tel")
BASE = KINDS[:4]
_DIGITS = frozenset(string.digits)
_ALNUM = frozenset(string.ascii_letters + string.digits)
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_NAME = _LOCAL | frozenset(":")
_PHONE = _DIGITS | frozenset(" ().-")
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "mailto:", "sip:", "tel:")
CUES = ("iban", "account", "acct", "ssn", "passport", "customer no", "customer number")
#: Characters of an IBAN by country.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FO FI GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL OM SO", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
        26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
_ASCII_LOWER = {ord(c): c.lower() for c in string.ascii_uppercase}


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for d in string.digits:
        found.add_word(d, ("digit", 1))
        found.add_word(f".{d}", ("dot", 2))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    for kind, words in (("scheme", SCHEMES), ("cue", CUES)):
        for w in words:
            found.add_word(w, (kind, len(w)))
    found.make_automaton()
    return found


def _run(text: str, at: int, allowed: frozenset) -> int:
    """The end of the run of allowed characters from at."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def _back(text: str, at: int, allowed: frozenset, least: int) -> int:
    """The start of the run of allowed characters that ends before at, not before least."""
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


def _host(text: str, at: int) -> int | None:
    """The end of two or more labels joined by single dots from at; None if there are fewer."""
    end, labels = _run(text, at, _LABEL), 1
    if end == at:
        return None
    while end < len(text) and text[end] == "." and (stop := _run(text, end + 1, _LABEL)) > end + 1:
        end, labels = stop, labels + 1
    return end if labels > 1 else None


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def iban(value: str) -> bool:
    """Whether the mod-97 check of an account number with country letters holds."""
    moved = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _iban(text: str, at: int) -> int | None:
    """The end of an account number with country letters at `at`, in groups or not, whose length and check digits are right."""
    length = IBAN_LENGTHS.get(text[at : at + 2].upper())
    if length is None or text[at : at + 2] not in (text[at : at + 2].upper(), text[at : at + 2].lower()) or not _DIGITS.issuperset(text[at + 2 : at + 4]):
        return None
    value, end = "", at
    while len(value) < length:
        if end < len(text) and text[end] in _ALNUM:
            value += text[end]
            end += 1
        elif end + 1 < len(text) and text[end] in " -" and text[end + 1] in _ALNUM:
            end += 1
        else:
            return None
    if end < len(text) and text[end] in _ALNUM:
        return None
    return end if iban(value.upper()) else None


def _account(text: str, at: int) -> tuple[int, int] | None:
    """The bounds of an account number behind a cue that ends at `at`: an IBAN, or 6 to 34 letters or digits, 5 digits at least."""
    while at < len(text) and text[at] in " :=#.\t":
        at += 1
    if (end := _iban(text, at)) is not None:
        return at, end
    for word in ("number", "no", "nr"):
        if text[at : at + len(word)].lower() == word and text[at + len(word) : at + len(word) + 1] not in _ALNUM:
            at += len(word)
            while at < len(text) and text[at] in " :=#.\t":
                at += 1
            if (end := _iban(text, at)) is not None:
                return at, end
    end = _run(text, at, _ALNUM)
    while end < len(text) - 1 and text[end] in " -" and text[end + 1] in _DIGITS:
        end = _run(text, end + 1, _ALNUM)
    value = "".join(c for c in text[at:end] if c in _ALNUM)
    if not 6 <= len(value) <= 34 or sum(c in _DIGITS for c in value) < 5:
        return None
    if value[:2].isalpha() and value[:2].isupper() and len(value) > 14 and not iban(value.upper()):
        return None
    return at, end


def find_spans(text: str) -> list[Span]:
    """All spans of one text."""
    out: list[Span] = []
    done = dict.fromkeys((*KINDS, "run", "chain", "name"), 0)  # up to where each parser has read
    lowered = text.lower()  # schemes and cues count in any case
    if len(lowered) != len(text):
        lowered = text.translate(_ASCII_LOWER)
    for last, (kind, width) in _automaton().iter(lowered):
        start, end = last - width + 1, last + 1
        if kind == "digit" and start >= done["run"]:
            # digits with at most one space or hyphen between them
            stop, digits = end, [text[start]]
            while stop < len(text):
                if text[stop] in _DIGITS:
                    digits.append(text[stop])
                    stop += 1
                elif text[stop] in " -" and stop + 1 < len(text) and text[stop + 1] in _DIGITS:
                    digits.append(text[stop + 1])
                    stop += 2
                else:
                    break
            done["run"] = stop
            if 14 <= len(digits) <= 19 and luhn("".join(digits)):
                out.append(("card", start, stop))
        elif kind == "dot" and start >= done["chain"] and start and text[start - 1] in _DIGITS:
            # digit runs with a dot between them, four at a time
            bounds = [(_back(text, start, _DIGITS, 0), start)]
            stop = start
            while stop + 1 < len(text) and text[stop] == "." and text[stop + 1] in _DIGITS:
                stop_at = _run(text, stop + 1, _DIGITS)
                bounds.append((stop + 1, stop_at))
                stop = stop_at
            done["chain"] = stop
            for i in range(0, len(bounds) - 3, 4):
                four = bounds[i : i + 4]
                if all(len(part := text[a:b].lstrip("0")) <= 3 and int(part or 0) <= 255 for a, b in four):
                    out.append(("ip", four[0][0], four[3][1]))
        elif kind == "at":
            first = _back(text, start, _LOCAL, done["email"])
            stop = _host(text, end) if first < start else None
            if stop is not None:
                out.append(("email", first, stop))
                done["email"] = stop
        elif kind == "plus" and end < len(text) and text[end] in _DIGITS:
            stop = _run(text, end + 1, _PHONE)
            while stop > end + 1 and text[stop - 1] not in _DIGITS:
                stop -= 1
            if stop >= end + 3 and start >= done["phone"]:
                done["phone"] = stop
                if 10 <= sum(c in _DIGITS for c in text[start:stop]) <= 15:
                    out.append(("phone", start, stop))
        elif kind == "scheme" and start >= done["login"] and (not start or text[start - 1] not in _ALNUM):
            # name or name:password before the host of an address, that of mail and calls included
            if lowered[start:end] == "tel:" and text[end : end + 1] != "+":  # one with a plus sign is of kind phone
                stop = _run(text, end, _PHONE)
                while stop > end and text[stop - 1] not in _DIGITS:
                    stop -= 1
                if 3 <= sum(c in _DIGITS for c in text[end:stop]) <= 15:
                    out.append(("tel", end, stop))
                    done["login"] = stop
                continue
            if end <= done["name"]:  # within a name that was read and led to no host
                continue
            done["name"] = stop = _run(text, end, _NAME)
            if stop > end and stop < len(text) and text[stop] == "@":
                host = _host(text, stop + 1) or _run(text, stop + 1, _LABEL)
                if host > stop + 1:
                    out.append(("login", start, host))
                    done["login"] = host
        elif kind == "cue" and start >= done["account"] and (not start or text[start - 1] not in _ALNUM):
            if (found := _account(text, end)) is not None:
                out.append(("account", *found))
                done["account"] = found[1]
    return out


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id and spans, an array of (kind, start, end, value).

    Null and empty texts have no spans. Rows are taken one by one: repeated rows
    and null ids give a row each. Other columns are ignored.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch.pop("text"):
                text = text or ""
                rows.append([{"kind": k, "start": a, "end": b, "value": text[a:b]} for k, a, b in find_spans(text)])
            batch["doc_id"] = batch["doc_id"].astype("Int64")
            batch["spans"] = rows
            yield batch

    schema = "doc_id long, spans array<struct<kind: string, start: int, end: int, value: string>>"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(scan, schema)


def op3(spark, sf_dir):
    return span_columns(find_personal_data(table(spark, sf_dir, "documents")), KINDS, BASE)


QUERIES = {"op3_anchor_pii": op3}
ORACLES: dict[str, str] = {}
