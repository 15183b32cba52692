"""PII (operator 9): Aho-Corasick anchors, expanded and checked by local parsers.

One automaton pass over a text finds the anchors: at-signs, plus signs, digits,
``://`` and identifier cues. Each anchor goes to a parser that reads only the
characters around it:

* at-sign: the local part to the left, the domain to the right;
* plus sign: a phone number to the right;
* first digit of a run: addresses of four parts and card numbers in the run;
* ``://``: a scheme to the left, user, host and port to the right (``url``);
* identifier cue: an account number after it, checked as IBAN or by its digits
  (``account``).

The first four kinds are what their leftmost non-overlapping patterns match in
the whole text: an address or card cannot leave a run of digits, dots, spaces
and hyphens, a phone number cannot hold a second plus sign, and the local part
of an email ends at its at-sign, so reading around anchors misses nothing.

Defined cases: null or empty text has no spans; a null doc_id stays null; equal
rows are scanned each for itself; an empty table gives no rows; extra columns
are ignored. Whole texts are scanned, of any length. Positions are code points.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from alloy.llm.common import id_text, slices
from alloy.llm.secrets import _SPAN_TYPE, SPANS

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("account", "url")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
RUN = re.compile(r"[0-9][0-9\x20.-]*")
IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
AUTHORITY = re.compile(r"(?:[A-Za-z0-9._%+:-]+@)?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]{1,5})?")
ACCOUNT = re.compile(r"[\x20:#=.]*(?:(?:no|nr|number)\b[\x20:#=.]*)?([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?|[0-9](?:[\x20-]?[0-9]){7,16})", re.I | re.A)
CUES = ("iban", "account", "acct", "konto", "cuenta", "compte", "ssn")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def iban(value: str) -> bool:
    """Remainder 1 of the number that the rearranged letters and digits spell."""
    turned = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    found.add_word("@", "@")
    found.add_word("+", "+")
    found.add_word("://", ":")
    for d in "0123456789":
        found.add_word(d, "0")
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            found.add_word(form, "#")
    found.make_automaton()
    return found


def spans_of(text: str, anchors) -> list[tuple[str, int, int]]:
    """All spans by kind as listed in KINDS, then start."""
    found = []
    run_end = email_end = 0
    for at, kind in anchors.iter(text):
        if kind == "0":
            if at < run_end:
                continue
            run_end = RUN.match(text, at).end()
            if run_end - at >= 7:
                for m in IP.finditer(text, at, run_end):
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                        found.append(("ip", m.start(), m.end()))
                for m in CARD.finditer(text, at, run_end):
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        found.append(("card", m.start(), m.end()))
        elif kind == "@":
            start = at
            while start > email_end and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                email_end = m.end()
                found.append(("email", start, email_end))
        elif kind == "+":
            if (m := PHONE.match(text, at)) and 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
                found.append(("phone", at, m.end()))
        elif kind == ":":
            start = at - 2
            while start > 0 and at - 2 - start < 8 and text[start - 1] in SCHEME:
                start -= 1
            if start < at - 2 and (m := AUTHORITY.match(text, at + 1)):
                found.append(("url", start, m.end()))
        elif m := ACCOUNT.match(text, at + 1):
            value = m[1].replace(" ", "").replace("-", "").upper()
            if value.isdigit() or iban(value):
                found.append(("account", m.start(1), m.end(1)))
    return sorted(set(found), key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def find_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) for every document; spans by kind, then start."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for batch in batches:
            for part in slices(batch):
                rows = [[{"kind": k, "start": s, "end": e} for k, s, e in spans_of(text, anchors)] if text else []
                        for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, _SPAN_TYPE)], names=["doc_id", "spans"])

    return id_text(docs).mapInArrow(scan, f"doc_id long, spans {SPANS}")
