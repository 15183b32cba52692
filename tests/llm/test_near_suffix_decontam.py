"""Operators 1, 6 and 8 against brute force."""

import collections
import hashlib
import os
import random
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
from helpers import WORDS, by_id, no_docs, odd_docs, odd_rows, sentence  # noqa: E402

from alloy.llm import decontam, graph, near_dup, queries, suffix_dedup  # noqa: E402

SMOKE = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(rows):
    parent = {d: d for d, _ in rows if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1:]:
            both = len(x & y)
            if both and 100 * both >= 75 * (len(x) + len(y) - both):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {d: find(d) for d in parent}


def edited(text, share, seed):
    r = random.Random(seed)
    w = text.split()
    for i in r.sample(range(len(w)), int(share * len(w))):
        w[i] = r.choice(WORDS)
    return " ".join(w)


def near_rows():
    rows = [(r[0], r[1]) for r in odd_rows()]
    for g in range(12):
        base = sentence(150, 9000 + g)
        rows += [(1000 + g * 20 + k, edited(base, 0.004 * k, g * 100 + k)) for k in range(14)]  # similarities around the bound
    for k in range(30):  # one passage in many texts that differ elsewhere
        rows.append((5000 + k, sentence(60, 70_000) + " " + sentence(60 + k, 71_000 + k)))
    return rows


def test_near_dup_equals_brute_force(spark):
    rows = near_rows()
    found = near_dup.classes(odd_docs(spark, [(d, t, "", "", 0) for d, t in rows])).collect()
    assert len(found) == len(rows)
    expected = components(rows)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == expected[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    n = {d: len(shingles(t)) for d, t in rows}
    assert all(r.n_shingles == n[r.doc_id] for r in found)


@pytest.mark.parametrize("parcel", [2_000_000, 400])
def test_members_meet_in_rows_not_pairs(monkeypatch, parcel):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(near_dup, "PARCEL", parcel)
    base = sentence(150, 9100)
    texts = [edited(base, 0.02, k) for k in range(60)]  # all of one bucket, similarities around the bound
    sets = [near_dup.shingles(t, near_dup.WordHashes()) for t in texts]
    signature = near_dup.signature(sets[0], *near_dup._functions()).tobytes()  # one for all: they share every key
    key = int(near_dup.chunk_keys(np.frombuffer(signature, dtype=np.uint16)).reshape(-1)[0])
    sketch = [np.packbits(near_dup.signature(f, *near_dup._functions(near_dup.SKETCH, 7)) & np.uint16(1)).tobytes() for f in sets]
    n = len(texts)
    rows = pa.RecordBatch.from_pydict({
        "key": [key] * n, "node": list(range(n)), "component": list(range(n)), "block": [0] * n, "p": [0] * n, "q": [0] * n,
        "n_shingles": [len(f) for f in sets], "n_shared": [len(f) for f in sets], "set_id": [near_dup.set_id(f) for f in sets],
        "signature": [signature] * n, "sketch": sketch})
    found = list(near_dup.candidates(iter([rows.slice(0, 7), rows.slice(7)])))
    at = [row for batch in found for row in batch.to_pylist()]
    pairs = [(r["at"], o) for r in at for o in r["others"]]
    assert len(pairs) == len(set(pairs)) > 10 * n
    parts = -(-sum(map(len, sets)) // parcel)
    assert sum(b.num_rows for b in found) <= n * parts
    full = [b.append_column("text", pa.array([texts[i] for i in b["node"].to_pylist()])) for b in found]
    links = [row for batch in near_dup.met(iter(full)) for row in batch.to_pylist()]
    expected = components(list(enumerate(texts)))
    assert parts > 1 or len(links) == n - len(set(expected.values()))
    assert all(near_dup.similar(sets[r["a"]], sets[r["b"]]) for r in links)
    root = list(range(n))
    for _ in range(n):
        for r in links:
            root[r["a"]] = root[r["b"]] = min(root[r["a"]], root[r["b"]])
    assert dict(enumerate(root)) == expected


def test_near_dup_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()]
    expected = components(docs)
    assert {r.doc_id: r.component_id for r in queries.op6_near_dup(spark, SMOKE).collect()} == expected


def test_drop_near_keeps_one_of_each(spark):
    docs = odd_docs(spark)
    kept = near_dup.drop_near(docs)
    assert kept.columns == docs.columns
    expected = components([(r[0], r[1]) for r in odd_rows()])
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))
    same = [(None, sentence(60, 1), "", "", 0), (7, sentence(60, 1), "", "", 0), (7, sentence(60, 1) + " end", "", "", 0), (7, sentence(60, 2), "", "", 0)]
    assert sorted((r.doc_id, r.text) for r in near_dup.drop_near(odd_docs(spark, same)).collect()) in (
        sorted([(7, same[i][1]), (7, same[3][1])]) for i in (1, 2))
    assert near_dup.classes(no_docs(spark)).count() == 0 and near_dup.drop_near(no_docs(spark)).count() == 0


def test_signatures_within_the_distance_share_a_key():
    import numpy as np

    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 16, near_dup.POSITIONS, dtype=np.uint16)
    for _ in range(200):
        b = a.copy()
        at = rng.choice(near_dup.POSITIONS, 2 * near_dup.CHUNKS - 1, replace=False)
        b[at] ^= 1
        chunks = (a.reshape(-1, near_dup.WIDTH) != b.reshape(-1, near_dup.WIDTH)).sum(axis=1)
        assert chunks.min() <= 1  # one position left out makes the keys equal


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    found = {x.node: x.component for x in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[n] == find(n) for n in found)
    assert set(found) == {n for n in parent if any(n in e and e[0] != e[1] for e in edges)}


def _removed(rows):
    seen, out = set(), {}
    for d, data in sorted(rows):
        mark = bytearray(len(data))
        for i in range(len(data) - 99):
            s = data[i:i + 100]
            if s in seen:
                mark[i:i + 100] = b"\1" * 100
            seen.add(s)
        out[d] = (len(data), sum(mark), sum(1 for i, m in enumerate(mark) if m and (i == 0 or not mark[i - 1])),
                  hashlib.sha256(bytes(c for c, m in zip(data, mark) if not m)).hexdigest())
    return out


def suffix_rows():
    passage = sentence(40, 31)
    rows = [(i, sentence(30, i) + passage[i % 5:] + " ü" + sentence(20, 200 + i)) for i in range(40)]
    rows += [(100, "ab" * 400), (101, "y" * 700), (102, "y" * 99), (103, ""), (104, None), (105, passage + passage),
             (106, rows[3][1]), (107, rows[3][1][:99]), (108, rows[3][1][:100]), (109, "\0" * 150 + "é" * 120)]
    return rows


@pytest.mark.parametrize("limit", [suffix_dedup.COLLECTION_BYTES, 2000])  # 2000: most anchors take the way for large groups
def test_suffix_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(suffix_dedup, "COLLECTION_BYTES", limit)
    rows = suffix_rows()
    docs = odd_docs(spark, [(d, t, "", "", 0) for d, t in rows] + [(None, rows[3][1], "", "", 0), (5, rows[5][1], "", "", 0)])
    found = suffix_dedup.remove_repeats(docs).collect()
    assert len(found) == len(rows) + 2
    expected = _removed([(d, (t or "").encode()) for d, t in rows])
    for r in found:
        if r.doc_id is None:
            assert r.removed == []
            continue
        got = (r.n_bytes, sum(s.stop - s.start for s in r.removed), len(r.removed), hashlib.sha256(r.kept).hexdigest())
        assert got == expected[r.doc_id], r.doc_id
    assert suffix_dedup.remove_repeats(no_docs(spark)).count() == 0


def test_suffix_query(spark):
    docs = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()]
    expected = _removed(docs)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op8_suffix_dedup(spark, SMOKE).collect()} == expected


def test_collection_transform():
    r = random.Random(8)
    texts = [bytes(r.choice(b"abc") for _ in range(r.randint(1, 40))) for _ in range(50)]
    rows = sorted((tuple(c + 1 for c in t[j:]) + (0, i), t[j - 1] + 1 if j else 0) for i, t in enumerate(texts) for j in range(len(t) + 1))
    assert suffix_dedup.transform(texts).tolist() == [c for _, c in rows]


def _distance(item, text):
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(row[i - 1] + (x != c), row[i] + 1, new[i - 1] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_distance_to_part():
    r = random.Random(3)
    for _ in range(1500):
        item = "".join(r.choice("abc") for _ in range(r.randint(1, 14)))
        text = "".join(r.choice("abc") for _ in range(r.randint(1, 30)))
        most = len(item) // 2
        expected = _distance(item, text)
        assert decontam.distance_to_part(item, text, most)[0] == (expected if expected <= most else most + 1)


def _leak_case(n=60):
    items = [(i, sentence(12 + i % 30, 40_000 + i).capitalize() + ".") for i in range(n)]
    rows, planted = [], set()
    for i, text in items:
        host = sentence(50, 50_000 + i)
        share = (0, 0.05, 0.1)[i % 3]
        leak = edited(text, share, i).replace(" ", "\n" if i % 4 == 0 else " ").upper()
        rows.append((i, f"{host} {leak} {host[::-1]}"))
        d = _distance(" ".join(decontam.words_of(text)), " ".join(decontam.words_of(rows[-1][1])))
        if d <= 0.2 * len(" ".join(decontam.words_of(text))):
            planted.add((i, i))
    rows += [(1000 + i, sentence(80, 60_000 + i)) for i in range(60)]
    return items, rows, planted


def test_decontamination_finds_near_copies_only(spark):
    items, rows, planted = _leak_case()
    docs = odd_docs(spark, [(d, t, "", "", 0) for d, t in rows])
    bench = spark.createDataFrame(items + [(900, None), (901, ""), (None, sentence(20, 99_999))], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.distance for r in decontam.find_leaks(docs, bench).collect()}
    assert len(set(found) & planted) >= 0.95 * len(planted)  # target recall
    assert not set(found) - planted                          # exact verification
    kept = decontam.drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in found}


def test_decontamination_in_blocks(spark, monkeypatch):
    items, rows, planted = _leak_case(20)
    docs = odd_docs(spark, [(d, t, "", "", 0) for d, t in rows])
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = {tuple(r) for r in decontam.find_leaks(docs, bench).collect()}
    monkeypatch.setattr(decontam.blocks, "__defaults__", (600,))
    assert len(list(decontam.blocks(bench))) > 2
    assert {tuple(r) for r in decontam.find_leaks(docs, bench).collect()} == one
    assert collections.Counter(r.doc_id for r in decontam.drop_leaks(docs, bench).collect()) == collections.Counter(
        d for d, _ in rows if d not in {x[0] for x in one})


def test_decontamination_odd_rows(spark):
    bench = spark.createDataFrame([(1, sentence(80, 1)), (2, "x" * 300), (3, "ONE two")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.find_leaks(odd_docs(spark), bench).collect()}
    assert {(1, 1), (2, 1), (None, 1), (10, 3), (11, 3)} <= found
    assert (4, 1) not in found
    empty = bench.limit(0)
    assert decontam.find_leaks(odd_docs(spark), empty).count() == 0
    assert decontam.drop_leaks(odd_docs(spark), empty).count() == len(odd_rows())
    assert decontam.find_leaks(no_docs(spark), bench).count() == 0


def test_items_that_share_a_document(spark):
    items = [(1, sentence(20, 1)), (2, sentence(20, 2)), (3, sentence(20, 1))]
    docs = odd_docs(spark, [(7, f"{sentence(20, 1)} {sentence(30, 3)} {sentence(20, 2)}", "", "", 0)])
    found = by_id(decontam.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).filter("item_id = 2"))
    assert found[7].distance == 0
    assert decontam.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).count() == 3


def test_blocks_of_one_worker_do_not_share_tables(monkeypatch):
    monkeypatch.setattr(decontam, "id", lambda x: 1, raising=False)  # a new block may lie where a freed one lay
    for i in range(3):
        text = sentence(12, 70_000 + i)
        assert [x[:3] for x in decontam.Items([(i, text)], 0.2).leaks([f"{sentence(9, i)} {text}"])] == [(0, i, 0)]


def _char_edits(text, n, alphabet, r):
    chars = list(text)
    for _ in range(n):
        i = r.randrange(len(chars) + 1)
        if r.random() < 0.3 or i == len(chars):
            chars.insert(i, r.choice(alphabet))
        elif r.random() < 0.5:
            chars[i] = r.choice(alphabet)
        else:
            del chars[i]
    return "".join(chars)


@pytest.mark.parametrize("alphabet", ["aeinorst  ", "ab", "aeinorst", "".join(map(chr, range(0x4E00, 0x4F00)))])
def test_every_leak_within_the_edits_is_found(alphabet):
    r = random.Random(21)
    for share in (0, 0.06, 0.12, 0.2):
        items = [(n, "x".join(r.choice(alphabet) for _ in range((n + 1) // 2))) for n in (1, 3, 5, 9, 11, 15, 21, 33, 81, 121, 233, 395)]
        texts = []
        for _, item in items:
            host = "".join(r.choice(alphabet) for _ in range(150))
            at = r.choice((0, 70, 150))
            texts.append(host[:at] + _char_edits(item, int(share * len(item)), alphabet, r) + host[at:])
        expected = {}
        for t, text in enumerate(texts):
            for n, item in items:
                item = " ".join(decontam.words_of(item))
                d, _ = decontam.distance_to_part(item, " ".join(decontam.words_of(text)), int(0.2 * len(item)))
                if d <= int(0.2 * len(item)):
                    expected[t, n] = d
        assert {x[:2]: x[2] for x in decontam.Items(items, 0.2).leaks(texts)} == expected
        assert len(expected) >= len(items)


def test_leaks_that_share_no_run_of_words():
    item = sentence(60, 7)
    typos = " ".join(w[:-1] + "q" if i % 3 == 0 else w for i, w in enumerate(item.split()))
    texts = [f"{sentence(20, 8)} {typos} {sentence(20, 9)}", sentence(5, 8) + item.replace(" ", ""), "(Quantum, computing!)", "x" * 50_000]
    items = [(1, item), (2, "quantum computing"), (3, "x" * 300), (4, item.replace(" ", ""))]
    found = {x[:2]: x[2] for x in decontam.Items(items, 0.2).leaks(texts)}
    assert {(0, 1), (1, 1), (1, 4), (2, 2), (3, 3)} <= set(found)
    assert found[1, 4] == found[3, 3] == 0 and found[2, 2] == 1


def test_a_short_text_meets_an_item_behind_long_ones():
    items = [(1, sentence(200, 3)), (2, "qwertyui")]
    assert decontam.Items(items, 0.2).leaks(["a qwertyui b"]) == [(0, 2, 0, 2, 10)]


def test_pieces_of_a_text_lose_no_leak(monkeypatch):
    items, docs, _ = _leak_case(20)
    texts = [text for _, text in docs]
    whole = decontam.Items(items, 0.2).leaks(texts)
    for chars in (64, 501):
        monkeypatch.setattr(decontam, "_CHARS", chars)
        monkeypatch.setattr(decontam, "_HITS", 100)
        assert decontam.Items(items, 0.2).leaks(texts) == whole
    assert whole
