"""Operators 2, 3 and 4."""

import collections
import hashlib
import os
import re
import sys
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from helpers import no_docs, odd_docs, odd_rows, sentence  # noqa: E402

from alloy.llm import exact_dedup, packing, queries, sharding  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


def _oracle(name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMOKE}/documents.parquet')")
    return con.sql(queries.ORACLE_SQL[name])


@pytest.mark.parametrize("name", ["op2_sharding", "op3_exact_dedup"])
def test_query_equals_sql(spark, name):
    df = queries.QUERIES[name](spark, SMOKE)
    rel = _oracle(name)
    order = sorted(df.columns)
    mine = sorted(tuple(map(repr, r)) for r in df.select(*order).collect())
    theirs = sorted(tuple(map(repr, r)) for r in rel.select(*order).fetchall())
    assert mine == theirs


def _fill(shards, size):
    """The table's definition, turn by turn."""
    def h(s):
        return int(hashlib.md5(s.encode()).hexdigest()[:15], 16)
    owner, nxt = [-1] * size, [0] * len(shards)
    for turn in range(size):
        i = turn % len(shards)
        offset, skip = h(shards[i] + "/offset") % size, h(shards[i] + "/skip") % (size - 1) + 1
        while owner[(offset + nxt[i] * skip) % size] != -1:
            nxt[i] += 1
        owner[(offset + nxt[i] * skip) % size] = i
    return owner


def test_lookup_table(spark):
    shards = [f"s{i}" for i in range(7)]
    table = sorted((r.slot, r.shard_no) for r in sharding.lookup_table(spark, shards, 211).collect())
    owner = _fill(shards, 211)
    assert [x for _, x in table] == owner
    counts = collections.Counter(owner)
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = _fill(shards[:-1], 211)
    moved = sum(a != b for a, b in zip(owner, fewer) if a != 6)
    assert moved < 0.25 * 211  # most slots of the shards that stay do not move
    with pytest.raises(ValueError):
        sharding.lookup_table(spark, shards, 210)


def test_sharding_odd_rows(spark):
    rows = sharding.assign(odd_docs(spark), ["a", "b"], 13).collect()
    assert len(rows) == len(odd_rows())
    assert len({r.shard for r in rows if r.doc_id == 2}) == 1
    assert all(r.shard in ("a", "b") for r in rows)
    assert sharding.assign(no_docs(spark), ["a", "b"], 13).count() == 0


def _groups(rows):
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc_id, len(text or "")))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))[0]
        out += [(d, keep, len(members), d == keep, hashlib.sha256(norm.encode()).hexdigest()) for d, _ in members]
    return sorted(out, key=repr)


def test_exact_dedup_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd_rows()] + [(20, "a b"), (21, "ab"), (22, " a b"), (23, "a b"), (-5, "")]
    docs = odd_docs(spark, [(d, t, "", "", 0) for d, t in rows])
    found = sorted((tuple(r) for r in exact_dedup.mark(docs).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)
    assert found == _groups(rows)
    kept = exact_dedup.keep_exact(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(keep) for _, keep in {(k[4], k[1]) for k in _groups(rows)})
    nothing_else = [(None, "same"), (None, "same"), (None, "s a m e"), (4, "other"), (4, "other"), (4, " other")]
    twins = exact_dedup.keep_exact(odd_docs(spark, [(d, t, "", "", 0) for d, t in nothing_else])).collect()
    assert sorted((str(r.doc_id), r.text) for r in twins) == [("4", " other"), ("None", "s a m e")]
    assert exact_dedup.mark(no_docs(spark)).count() == 0
    assert exact_dedup.keep_exact(no_docs(spark)).count() == 0


def test_directory_splits_overfull_buckets(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    index, buckets = exact_dedup.build_index(docs, capacity=16)
    sizes = buckets.collect()
    assert all(b.n_entries <= 16 for b in sizes) and sum(b.n_entries for b in sizes) == 3000
    assert len({b.depth for b in sizes}) > 1  # only overfull buckets went deeper
    assert index.count() == 3000
    assert exact_dedup.mark(docs, capacity=16).filter("kept").count() == 3000


def test_equal_keys_are_chained(spark, monkeypatch):
    """With one key for all texts, buckets end at the greatest depth and bytes decide."""
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *a: F.lit(5).cast("long"))
    monkeypatch.setattr(exact_dedup, "MAX_DEPTH", 3)
    rows = [(1, "a"), (2, "b"), (3, "a "), (4, "c")]
    docs = odd_docs(spark, [(d, t, "", "", 0) for d, t in rows])
    found = sorted(tuple(r) for r in exact_dedup.mark(docs, capacity=1).select("doc_id", "keep_id", "group_size").collect())
    assert found == [(1, 3, 2), (2, 2, 1), (3, 3, 2), (4, 4, 1)]


def _check_packing(rows, pieces, seq_len=1024):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = collections.Counter((d, tuple(t.encode(x or "", add_special_tokens=False).ids + [0])) for d, x in rows)
    sequences = collections.defaultdict(list)
    by_doc = collections.defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length > 0
        sequences[p.sequence_id].append((p.offset, p.length, p.sequence_tokens))
        by_doc[p.doc_id].append((p.start, tuple(ids.tolist()), p.doc_tokens))
    for parts in sequences.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= seq_len and at == parts[0][2] and (at == seq_len or at & (at - 1) == 0)
    # A repeated doc_id: compare the multiset of its ids, else the exact sequence.
    for doc_id in {d for d, _ in expected}:
        texts = [x for (d, x), n in expected.items() if d == doc_id for _ in range(n)]
        got = sorted(by_doc[doc_id])
        assert sum(len(p[1]) for p in got) == sum(map(len, texts))
        if len(texts) == 1:
            assert tuple(i for p in got for i in p[1]) == texts[0] and all(p[2] == len(texts[0]) for p in got)


def test_packing_round_trip(spark):
    rows = [(r[0], r[1]) for r in odd_rows()] + [(100 + i, sentence(10 + i * 7, i)) for i in range(60)]
    rows.append((300, "a <|endoftext|> b"))
    docs = odd_docs(spark, [(d, t, "", "", 0) for d, t in rows])
    _check_packing(rows, packing.pack(docs).collect())
    _check_packing(rows, packing.pack(docs, block_tokens=3000).collect())
    assert packing.pack(no_docs(spark)).count() == 0


def test_packing_query_digest(spark):
    pieces = queries.op4_packing(spark, SMOKE).collect()
    full = packing.pack(spark.read.parquet(f"{SMOKE}/documents.parquet")).collect()
    digest = {(p.doc_id, p.start): zlib.crc32(p.ids) for p in full}
    assert {(p.doc_id, p.start): p.ids_crc32 for p in pieces} == digest


def test_placement_balances_cost():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 1024, 3000).tolist()
    pieces, capacities, cost = packing.place(lengths, 1024, 1.0, 1 / 1024)
    assert sum(capacities) == sum(lengths)
    full = cost[:sum(lengths) // 1024]
    assert full.std() < 0.15 * full.mean()
    whole = sum(n == lengths[item] for item, _, n, _, _ in pieces)
    assert whole > 0.8 * len(lengths)  # cut only where nothing else fits
