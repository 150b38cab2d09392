"""Personal data by anchors that are expanded in place.

One Aho-Corasick automaton runs over each whole text and finds anchors: at-signs,
schemes, plus signs before digits, digits next to digits, and words that announce an
account. At an anchor a small parser finds the boundaries and validates them; text
between anchors is never parsed. All places are code points, ends exclusive.

Base kinds: email, ip (four parts up to 255), card (14 to 19 digits passing Luhn),
phone (plus, 10 to 15 digits). A candidate that fails is dropped and its characters
are not tried again. The method adds url (scheme, host) and account (an IBAN with
valid check digits, or 6 to 17 digits after a cue word).

Defined results: a null or empty text has no spans; a null id is carried; repeated
rows are searched each; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratiolens.llm.common import ship_package, slices, text_or_empty

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
#: Words that announce an account, in the languages of the corpus.
CUES = ("iban", "account", "acct", "konto", "kontonummer", "cuenta", "compte")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
DIGITS = frozenset("0123456789")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
ADDRESS = re.compile(r"[^\s<>\"'{}|\\^`]+")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
NUMBER = re.compile(r"[0-9](?:[ -]?[0-9]){5,16}(?![0-9])")
AFTER_CUE = re.compile(r"[\s:#.=]{0,4}(?:(?:no|nr|number|num)[\s:#.]{0,3})?", re.IGNORECASE)


@cache
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    found.add_word("@", "email")
    found.add_word("://", "url")
    for one in "0123456789":
        found.add_word(f"+{one}", "phone")
    for one, gap, two in product("0123456789", ("", " ", "-"), "0123456789"):
        found.add_word(f"{one}{gap}{two}", "card")
    for one, two in product("0123456789", repeat=2):
        found.add_word(f"{one}.{two}", "ip")
    for cue in CUES:
        for form in (cue, cue.title(), cue.upper()):
            found.add_word(form, "account")
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def iban(code: str) -> bool:
    code = code.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def back_to(text: str, at: int, least: int, allowed: frozenset) -> int:
    """The first place of the run of allowed characters that ends before ``at``."""
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans, in order of start and kind."""
    spans = []
    past = dict.fromkeys(KINDS, 0)  # up to here a kind's text is used
    for last, kind in automaton().iter(text):
        if last < past[kind]:
            continue
        if kind == "email":
            domain = DOMAIN.match(text, last + 1)
            start = domain and back_to(text, last, past[kind], LOCAL)
            if domain and start < last:
                spans.append((start, domain.end(), kind))
                past[kind] = domain.end()
        elif kind == "ip":
            run = DOTTED.match(text, back_to(text, last - 1, past[kind], DIGITS))
            parts, at = run[0].split("."), run.start()
            for k in range(0, len(parts) - 3, 4):
                four = parts[k : k + 4]
                end = at + sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
                    spans.append((at, end, kind))
                at = end + 1
            past[kind] = run.end()
        elif kind == "card":
            first = last - (2 if text[last - 1] in " -" else 1)
            run = CHAIN.match(text, first)
            digits = run[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((run.start(), run.end(), kind))
            past[kind] = run.end()
        elif kind == "phone":
            run = PHONE.match(text, last - 1)
            if run:
                if 10 <= sum(c in DIGITS for c in run[0]) <= 15:
                    spans.append((run.start(), run.end(), kind))
                past[kind] = run.end()
        elif kind == "url":
            start = back_to(text, last - 2, past[kind], SCHEME)
            rest = ADDRESS.match(text, last + 1)
            while start < last - 2 and not text[start].isalpha():
                start += 1
            if rest and start < last - 2 and DOMAIN.match(rest[0].rpartition("@")[2]):
                end = last + 1 + len(rest[0].rstrip(".,;:!?)]*"))
                spans.append((start, end, kind))
                past[kind] = end
        else:
            at = AFTER_CUE.match(text, last + 1).end()
            code = IBAN.match(text, at)
            number = NUMBER.match(text, at)
            hit = code if code and iban(code[0]) else number
            if hit:
                spans.append((hit.start(), hit.end(), kind))
                past[kind] = hit.end()
    spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return spans


SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 8 << 20):
        found = [
            [{"kind": kind, "start": start, "end": end} for start, end, kind in find(text or "")]
            for text in batch.column("text").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(found, SPAN)], ["doc_id", "spans"]
        )


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``spans``, an array of (kind, start, end)."""
    ship_package(docs.sparkSession)
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    found = source.mapInArrow(
        _search, f"doc_id {kind}, spans array<struct<kind: string, start: long, end: long>>"
    )
    return found.withColumnRenamed("doc_id", id_col)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
