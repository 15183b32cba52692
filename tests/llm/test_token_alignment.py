"""Cross-tokenizer alignment against a plain version of it."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from alloy.llm import queries, token_alignment
from tests.llm.helpers import no_docs, odd_docs, sentence


def plain(rows):
    """The contract, document by document, with the JSON file."""
    import json

    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    vocabulary = {i: t for t, i in json.load(open(P.path("byte_bpe_50k.json")))["model"]["vocab"].items()}
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    b_side = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))

    def spell_b(i):
        piece = b_side.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_side.is_byte(i) else piece.replace("▁", " ").encode()

    docs, count = [], Counter()
    for doc_id, text in rows:
        groups = []
        if text:
            a = [(i, bytes(byte_of[c] for c in vocabulary[i])) for i in a_side.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, spell_b(i)) for i in b_side.encode(text)]
            whole = (" " + text).encode()
            if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b):
                owner = defaultdict(lambda: ([], []))
                ends = []
                for side in (a, b):
                    at, found = 0, []
                    for i, x in side:
                        at += len(x)
                        found.append((at, i))
                    ends.append(found)
                common = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
                for s in (0, 1):
                    for e, i in ends[s]:
                        owner[next(k for k, c in enumerate(common) if c >= e)][s].append(i)
                groups = [owner[k] for k in range(len(common))]
        docs.append((doc_id, groups))
        count.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    highest = defaultdict(int)
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    out = []
    for doc_id, groups in docs:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
                    sum(count[k] == highest[k[0]] for k in links), sum(count[k] for k in links), hashlib.sha256(said.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


def result(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_token_alignment(spark, str(tmp_path)).collect()
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got), key=str)


TEXTS = ["<|endoftext|> and </s> <s> <unk> <0x41>", "日本語のテキスト äöü ß \U0001f600\U0001f468‍\U0001f469", "a▁b", "  two  spaces ", "tab\tnew\nline\r\n",
         "x" * 5000, "https://example.org/a?b=c&d=" + "9f" * 300, "\x00\x01 control", "ﬁ ligature ① ½", " ", "\n", "don't we'll I'm 1234567 3.14", " nbsp　wide"]


@pytest.mark.parametrize("small,links", [(64 << 20, 1 << 20), (0, 50)])
def test_equals_plain(spark, tmp_path, monkeypatch, small, links):
    monkeypatch.setattr(token_alignment, "_SMALL", small)
    monkeypatch.setattr(token_alignment, "_LINKS", links)
    rows = [(i, t) for i, t in enumerate(TEXTS + [sentence(k * 7, k) for k in range(1, 30)] + [sentence(30, 3).title()])]
    got = result(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), tmp_path)
    assert got == plain(rows)
    assert sum(r[1] > 0 for r in got) > 30


def test_odd_rows(spark, tmp_path):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 60_000]  # the plain version is quadratic
    assert result(spark, docs.filter("length(coalesce(text, '')) < 60000"), tmp_path) == plain(rows)


def test_very_long_text(spark):
    docs = odd_docs(spark)
    n = {r.doc_id: r for r in token_alignment.align(docs).collect()}
    assert n[6].n_a > 60_000 and n[6].n_links >= n[6].n_groups > 50_000 and n[6].groups.count("|") == n[6].n_groups


def test_empty_table(spark):
    assert token_alignment.align(no_docs(spark)).collect() == []


def test_gallop():
    r = random.Random(5)
    for _ in range(500):
        a, b = (sorted(r.sample(range(60), r.randint(0, 40))) for _ in range(2))
        i, j = token_alignment.gallop(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64))
        assert [a[x] for x in i] == [b[x] for x in j] == sorted(set(a) & set(b))
    a, b = (np.unique(np.random.default_rng(k).integers(0, 90_000, n)) for k, n in ((1, 9_000), (2, 60_000)))
    i, j = token_alignment.gallop(a, b)
    assert (a[i] == b[j]).all() and (a[i] == np.intersect1d(a, b)).all()
