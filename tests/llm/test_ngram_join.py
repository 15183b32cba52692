"""The n-gram Jaccard join against a plain version of it."""

import random

import numpy as np
import pytest

from alloy.llm import ngram_join
from tests.llm.helpers import no_docs, odd_docs, sentence


def plain_set(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return frozenset()
    k = min(4, len(words))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def plain_join(rows):
    """[(doc_id, n_shingles, component_id, n_links)] by comparing all pairs."""
    sets = [plain_set(text) for _, text in rows]
    parent = {d: d for d, _ in rows if d is not None}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    links = [0] * len(rows)
    for i, (d, _) in enumerate(rows):
        for j in range(i):
            e = rows[j][0]
            if d is None or e is None:
                continue
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    return sorted(((d, len(s), None if d is None else root(d), n) for (d, _), s, n in zip(rows, sets, links)), key=str)


def edited(text, edits, seed):
    r = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        at = r.randrange(len(words))
        r.choice((lambda: words.insert(at, f"w{r.random()}"), lambda: words.pop(at), lambda: words.__setitem__(at, f"w{r.random()}")))()
    return " ".join(words)


def corpus():
    r = random.Random(3)
    rows = []
    for g in range(30):
        base = sentence(r.randint(3, 220), 100 + g)
        rows += [base, base.upper(), base] + [edited(base, r.randint(1, 1 + len(base.split()) // 50), g * 50 + k) for k in range(r.randint(1, 12))]
    line = sentence(30, 7)
    rows += [line + " " + sentence(r.randint(0, 60), 900 + k) for k in range(60)]
    rows += [sentence(r.randint(1, 90), 2000 + k) for k in range(60)]
    return [(i, text) for i, text in enumerate(rows)]


def result(docs, **options):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in ngram_join.join_similar(docs, **options).collect()), key=str)


@pytest.mark.parametrize("block,hot_from", [(512, 32), (8, 2)])
def test_equals_plain_join(spark, monkeypatch, block, hot_from):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = corpus()
    got = result(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), hot_from=hot_from)
    assert got == plain_join(rows)
    assert sum(r[3] for r in got) > 1000


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(docs) == plain_join(rows)
    assert result(no_docs(spark)) == []


def test_repeated_doc_id_with_two_texts_is_one_node(spark):
    a, b = sentence(40, 1), sentence(40, 2)
    rows = [(1, a), (5, a), (5, b), (7, b + " end"), (9, sentence(40, 3))]
    got = {(r.doc_id, r.component_id) for r in ngram_join.join_similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1), (5, 1), (7, 1), (9, 9)}


def test_bands_hold_all_pairs_of_lengths():
    for n in range(1, 5000):
        longest = 100 * n // ngram_join.PERCENT
        assert ngram_join.band_of(np.array([longest]))[0] - ngram_join.band_of(np.array([n]))[0] <= 1


def test_prefixes_of_linked_sets_meet():
    r = random.Random(1)
    for _ in range(300):
        base = sorted(r.sample(range(10_000), r.randint(1, 60)))
        other = sorted(set(r.sample(base, max(1, len(base) - r.randint(0, 4)))) | set(r.sample(range(10_000), r.randint(0, 4))))
        both = len(set(base) & set(other))
        if 100 * both >= 85 * (len(base) + len(other) - both):
            assert set(base[:ngram_join.prefix_length(len(base))]) & set(other[:ngram_join.prefix_length(len(other))])


def test_trie_drops_no_link_on_prefixes_alone():
    r = random.Random(2)
    for _ in range(20):
        base = r.sample(range(500), 40)
        sets = [np.array(sorted(set(r.sample(base, 40 - r.randint(0, 4))) | set(r.sample(range(500), r.randint(0, 4)))), dtype=np.uint64) for _ in range(25)]
        sizes = np.array([len(s) for s in sets])
        every = np.ones(len(sets), dtype=bool)
        links = {frozenset((i, j)) for i in range(25) for j in range(i)
                 if 185 * len(np.intersect1d(sets[i], sets[j])) >= 85 * (sizes[i] + sizes[j])}
        full = {frozenset((i, int(j))) for i, js in ngram_join.Trie(sets, sizes, True).walk(lambda i: every) for j in js}
        cut = [s[:ngram_join.prefix_length(len(s))] for s in sets]
        passed = {frozenset((i, int(j))) for i, js in ngram_join.Trie(cut, sizes, False).walk(lambda i: every) for j in js}
        assert full == links
        assert links <= passed
