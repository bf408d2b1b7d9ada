"""Secret scan: patterns, and dictionary-primed compression novelty.

Patterns give the base spans. Other strings that stand in a sensitive context
are measured: how many bytes do they add to a zstandard frame whose dictionary
is the surrounding text and a list of common identifiers? Words, names and
repetitions compress against it; a random key does not and is reported. The
measure is what a random string of that length over the same alphabet would add,
as the entropy coder shortens any long string over few characters.
"""

from __future__ import annotations

import itertools
import random
import re
import string
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostgrain.llm.spans import Span, span_columns
from hostgrain.llm.storage import table

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
#: What makes a context sensitive, in any case.
CUES = (
    "access", "account", "api", "auth", "bearer", "cert", "client", "credential", "key", "login", "passphrase",
    "passwd", "password", "private", "pwd", "salt", "secret", "session", "signature", "token",
)
_ANY_CUE = "|".join(CUES)
#: Where a value may begin; the text before a single character is then searched for a cue. A cue alone is a mark, too.
_MARK = re.compile(rf"[:=]|bearer\x20|-----BEGIN[A-Z0-9\x20]*(?:-----)?|(?<![a-z])(?:{_ANY_CUE})s?(?![a-z])", re.IGNORECASE | re.ASCII)
#: A cue begins a word or, with a capital, a part of a camel-case name.
_CUE = re.compile(
    rf"(?:(?<![A-Za-z])(?i:{_ANY_CUE})|(?<=[a-z0-9])(?:{'|'.join(c.capitalize() for c in CUES)}))s?[\w.-]{{0,16}}[\"'\]]?\x20*$", re.ASCII
)
_END = re.compile(r"-----END|\Z")
#: The last line of a block.
_REST = re.compile(r"\s*([A-Za-z0-9+/=]+)\s*\Z", re.ASCII)
_TOKEN = re.compile(r"[A-Za-z0-9+/_=~.-]{12,}")
#: Common identifiers of code, beside which a candidate is no news.
IDENTIFIERS = (
    "abstract assert async await boolean break case catch class const continue default delete double else enum export "
    "extends false final finally float for from function global if implements import include instanceof int interface "
    "lambda long namespace native new null package private protected public raise return self short static string struct "
    "super switch this throw true try typedef undefined union unsigned using var virtual void volatile while with yield "
    "application authorization authentication background buffer callback client configuration connection container "
    "controller credentials database description development directory document element endpoint environment example "
    "exception filename handler hostname identifier implementation index initialize instance listener localhost manager "
    "message method middleware module number object option parameter password placeholder position production property "
    "provider reference repository request resource response result schema secret service session settings signature "
    "source standard status storage template timeout timestamp token transaction undefined username utility validate "
    "variable version https:// http:// www. .com .org 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ "
    "changeme your_api_key your-token-here xxxxxxxxxxxxxxxx 0000000000000000 1234567890"
).encode()
_DIGITS, _LOWER, _UPPER = string.digits, string.ascii_lowercase, string.ascii_uppercase
_ALPHABETS = (
    _DIGITS, _DIGITS + "abcdef", _DIGITS + "ABCDEF", _LOWER, _UPPER, _UPPER + "234567", _DIGITS + _LOWER, _DIGITS + _UPPER,
    _LOWER + _UPPER, _DIGITS + _LOWER + _UPPER,
)
_PAIRS = frozenset(a + b for w in re.findall("[a-z]+", IDENTIFIERS.decode().lower().replace(_LOWER, "")) for a, b in zip(w, w[1:]))
CONTEXT = 256
#: How far from a cue without a mark a value may begin.
NEAR = 48
MIN_RATIO = 0.8
#: Letters only: at a larger share of letter pairs that identifiers have, too, a string is made of words.
WORD_PAIRS = 0.65


def base_spans(text: str) -> list[Span]:
    """The spans of the three patterns, leftmost and non-overlapping within a kind, failing ones dropped."""
    found: list[Span] = []
    lowered = text.lower()  # only to see whether a search is worth while
    if any(w in lowered for w in ("passw", "secret", "token", "apikey", "api_key")):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def marginal_bytes(candidate: str, context: str) -> int:
    """Bytes that the candidate adds to an empty frame with the context and the identifiers as its dictionary."""
    primed = zstandard.ZstdCompressionDict(
        IDENTIFIERS + context.encode("utf-8", "replace"), dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    compressor = zstandard.ZstdCompressor(
        level=3, dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False
    )
    return len(compressor.compress(candidate.encode("utf-8", "replace"))) - len(compressor.compress(b""))


def alphabet(s: str) -> str:
    """The characters that a string like s is drawn from: the smallest usual set with its letters and digits, and its marks."""
    own = {c for c in s if c.isalnum()}
    least = next((a for a in _ALPHABETS if own <= set(a)), "")
    return least + "".join(sorted(set(s) - set(least)))


@lru_cache(maxsize=4096)
def random_bytes(length: int, characters: str) -> int:
    """What a random string of that length over the characters adds."""
    return marginal_bytes("".join(random.Random(length).choices(characters, k=length)), "")


def wordlike(s: str) -> bool:
    """Whether a string without digits is made of words: a dozen letters of a rare word don't compress."""
    if any(map(str.isdigit, s)):
        return False
    pairs = [p for w in re.findall("[A-Z]+(?![a-z])|[A-Z]?[a-z]+", s) for p in map("".join, zip(w.lower(), w.lower()[1:]))]
    # parts of one letter or two, as of random case, hold few pairs
    return len(pairs) * 2 >= len(s) and sum(p in _PAIRS for p in pairs) > WORD_PAIRS * len(pairs)


def is_novel(candidate: str, near: str, min_ratio: float = MIN_RATIO) -> bool:
    """Whether the candidate adds about as many bytes as a random string would."""
    added = marginal_bytes(candidate, near)
    return added >= min_ratio * len(candidate) or added >= min_ratio * random_bytes(len(candidate), alphabet(candidate))


def novel_spans(text: str, base: list[Span], min_ratio: float = MIN_RATIO, context: int = CONTEXT, words: bool = False) -> list[Span]:
    """Strings behind a sensitive cue that hardly compress against their surroundings and overlap no base span.

    Behind a mark, strings begin within `context` characters, behind a cue alone within
    NEAR; behind BEGIN, up to END, every line counts, and the last one however short.
    Every such string is measured; words: report also those made of words (wordlike()).
    """
    out: list[Span] = []
    at = end_of_block = 0
    starts, reach = [], []
    if base:
        spans = sorted((a, b) for _, a, b in base)
        starts, reach = [a for a, _ in spans], list(itertools.accumulate((b for _, b in spans), max))
    for mark in _MARK.finditer(text):
        if len(mark[0]) == 1 and not _CUE.search(text, max(0, mark.start() - 48), mark.start()):
            continue
        block = mark[0].startswith("-----")
        if block:
            if mark.end() > end_of_block:
                end_of_block = _END.search(text, mark.end()).start()
            stop = limit = max(mark.end(), end_of_block)
        else:
            stop, limit = min(len(text), mark.end() + (context if mark[0][-1] in ":= " else NEAR)), len(text)
        last = None
        for m in _TOKEN.finditer(text, max(at, mark.end()), max(at, stop)):
            # the match may have been cut by the search's end: take the whole run
            start, end = m.start(), _TOKEN.match(text, m.start(), limit).end()
            at, last = end, None
            candidate = text[start:end]
            before = bisect_left(starts, end)
            if before and reach[before - 1] > start:
                continue
            near = text[max(0, start - context) : start] + "\n" + text[end : end + context]
            if is_novel(candidate, near, min_ratio) and (words or not wordlike(candidate)):
                out.append(("novel", start, end))
                last = end
        if block and last is not None and (rest := _REST.match(text, last, limit)):
            out.append(("novel", *rest.span(1)))
        if block:
            at = max(at, stop)
    return out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_ratio: float = MIN_RATIO, words: bool = False) -> DataFrame:
    """One row per input row: doc_id and spans, an array of (kind, start, end, value).

    min_ratio and words as in novel_spans(); the time taken grows with the length of a text.

    Null and empty texts have no spans. Rows are taken one by one: repeated rows
    and null ids give a row each. Other columns are ignored.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch.pop("text"):
                text = text or ""
                base = base_spans(text)
                found = base + novel_spans(text, base, min_ratio, words=words)
                rows.append([{"kind": k, "start": a, "end": b, "value": text[a:b]} for k, a, b in found])
            batch["doc_id"] = batch["doc_id"].astype("Int64")
            batch["spans"] = rows
            yield batch

    schema = "doc_id long, spans array<struct<kind: string, start: int, end: int, value: string>>"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(scan, schema)


def op2(spark, sf_dir):
    return span_columns(find_secrets(table(spark, sf_dir, "documents")), KINDS, KINDS[:3])


QUERIES = {"op2_secret_novelty": op2}
ORACLES: dict[str, str] = {}
