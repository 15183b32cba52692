"""Operators 7 and 9."""

import hashlib
import os
import random
import re
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from helpers import by_id, no_docs, odd_docs, odd_rows, sentence  # noqa: E402

from alloy.llm import pii, queries, secrets  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


def _secrets(text):
    out = [("assign", *m.span()) for m in re.finditer(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 12]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def _pii(text):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                          ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "phone" and not 8 <= len(digits) <= 15
                    or kind == "card" and not (16 <= len(digits) <= 19 and pii.luhn(digits))):
                continue
            out.append((kind, *m.span()))
    return out


def _fuzz(alphabet, n, size):
    r = random.Random(7)
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, size))) for _ in range(n)]


def test_base_secrets_equal_their_patterns():
    parts = ["token", "API_KEY", "secret", "=", ": ", '"', "abcdef0123456789", "AKIA", "ABCDEFGH12345678", " ", "ſecret", "é", "K", "x.y_z-1"]
    r = random.Random(1)
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        assert secrets.base_spans(text) == _secrets(text), text


def test_base_pii_equals_its_patterns():
    anchors = pii.automaton()
    parts = ["a@b.co", "@", ".", "c-d", "+", "1", "192.168.1.1", "4111 1111 1111 1111", "-", " ", "(22)", "00255", "é", "account 12345678", "://"]
    r = random.Random(2)
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(5000)] + _fuzz("0123456789. -+@a", 5000, 60)
    for text in texts:
        assert [s for s in pii.spans_of(text, anchors) if s[0] in pii.BASE_KINDS] == _pii(text), text


def test_added_pii_kinds():
    anchors = pii.automaton()
    text = "IBAN: DE89370400440532013000, see https://user:pw@host.example.com:80/x account no. 12345678"
    found = {k: text[s:e] for k, s, e in pii.spans_of(text, anchors)}
    assert found["account"] == "12345678" and found["url"] == "https://user:pw@host.example.com:80"
    assert ("account", 6, 28) in pii.spans_of(text, anchors)
    assert not any(k == "account" for k, _, _ in pii.spans_of("IBAN: DE89370400440532013001", anchors))  # fails its check


def _digest(spans, kinds):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans if k in kinds).encode()).hexdigest()


def test_queries_equal_patterns(spark):
    docs = by_id(spark.read.parquet(f"{SMOKE}/documents.parquet"))
    for r in queries.op7_secrets(spark, SMOKE).collect():
        spans = _secrets(docs[r.doc_id].text)
        assert r.base_sha256 == _digest(spans, secrets.BASE_KINDS)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in spans) for k in secrets.BASE_KINDS)
    for r in queries.op9_pii(spark, SMOKE).collect():
        spans = _pii(docs[r.doc_id].text)
        assert r.base_sha256 == _digest(spans, pii.BASE_KINDS)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in spans) for k in pii.BASE_KINDS)


def test_markov_adds_random_strings_and_no_words(spark):
    r = random.Random(9)
    rnd = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40))
    rows = [(i, sentence(100, i) + f' token = "{rnd()}" {sentence(20, i + 500)}', "", "", 0) for i in range(150)]
    bare = rnd()
    rows += [(900, f"{sentence(30, 77)} {bare} {sentence(30, 78)}", "", "", 0),
             (901, "".join(sentence(12, 79).split()), "", "", 0)]  # a long token of ordinary letters
    short, around = "a7e3i9o1u5l2n8", "a7e3i9o1z" + "0123456789abcdef" + "zu5l2n8r4"
    rows += [(902, f"{sentence(30, 80)} {short}", "", "", 0), (903, f"{sentence(30, 81)} {around}", "", "", 0)]
    found = by_id(secrets.find_secrets(odd_docs(spark, rows)))
    at = len(rows[152][1]) - 14
    assert [tuple(s) for s in found[902].spans] == [("markov", at, at + 14)]
    at = len(rows[153][1]) - len(around)
    assert [tuple(s) for s in found[903].spans] == [("markov", at, at + len(around)), ("hex", at + 9, at + 25)]
    start = rows[150][1].index(bare)
    assert [tuple(s) for s in found[900].spans] == [("markov", start, start + 40)]
    assert found[901].spans == []
    assert all([s.kind for s in found[i].spans] == ["assign"] for i in range(150))


def test_scans_odd_rows(spark):
    docs = odd_docs(spark)
    for find in (secrets.find_secrets, pii.find_pii):
        rows = find(docs).collect()
        assert len(rows) == len(odd_rows())
        assert find(no_docs(spark)).count() == 0
    out = secrets.span_columns(pii.find_pii(docs), pii.BASE_KINDS).filter(F.col("doc_id") == 3).first()
    assert out.spans == "" and out.base_sha256 == hashlib.sha256(b"").hexdigest()
    long = pii.find_pii(odd_docs(spark, [(1, "x " * 400_000 + "a@b.co", "", "", 0)])).first()
    assert [tuple(s) for s in long.spans] == [("email", 800_000, 800_006)]
