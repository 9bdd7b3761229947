"""Collocations against counting every phrase, with tries that burst, spill and forget."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import edge_tables
import numpy as np
import pytest

from shelfwise.llm import collocations as C

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute(rows, min_count, longest, best):
    by, out = defaultdict(list), []
    for lang, text in rows:
        by["und" if lang is None else lang].append(text or "")
    for lang, texts in by.items():
        counts = Counter()
        for text in texts:
            for piece in re.split("[.,;:!?\x0a-\x0d]", text.translate(LOWER)):
                w = re.findall("[^\x20\x09]+", piece)
                for k in range(1, longest + 1):
                    counts.update(" ".join(w[i:i + k]) for i in range(len(w) - k + 1))
        n = sum(v for p, v in counts.items() if " " not in p)
        candidates = {p: v for p, v in counts.items() if " " in p and v >= min_count}
        inside = {}
        for p, v in candidates.items():
            w = p.split(" ")
            for k in range(2, len(w)):
                for i in range(len(w) - k + 1):
                    q = " ".join(w[i:i + k])
                    inside[q] = max(inside.get(q, 0), v)
        ranked = []
        for p, a in candidates.items():
            if inside.get(p, 0) >= a:
                continue
            w = p.split(" ")
            cuts = [(counts[" ".join(w[:k])], counts[" ".join(w[k:])], k) for k in range(1, len(w))]
            score, _, left, right = min((1000 * a * n // (x * y), k, x, y) for x, y, k in cuts)
            ranked.append((-score, -a, p.encode(), left, right))
        out += [(lang, i, x[2].decode(), -x[1], x[3], x[4], n, -x[0])
                for i, x in enumerate(sorted(ranked)[:best], 1)]
    return sorted(out)


def some_texts(n=120):
    draw = random.Random(4)
    words = ["The", "of", "ä", "B", "x-y", "Éa", "1", "a\x00b", "\x1f", "~"]
    glue = [" ", "  ", "\t", ". ", ",", "\n", " "]
    rows = []
    for i in range(n):
        text = "".join(draw.choice(words[:3 + i % 8]) + draw.choice(glue)
                       for _ in range(draw.randint(0, 60)))
        rows.append((draw.choice(["en", "en", "fr", None]), text))
    return rows + [("en", None), ("en", ""), ("de", "New York City " * 400), ("de", " \t\n")]


@pytest.mark.parametrize("bounds", [{}, {"held": 40, "burst": 3, "block": 64, "max_bits": 16}])
def test_as_counting_all(spark, bounds):
    rows = some_texts()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = C.collocations(docs, min_count=4, longest=5, best=60, **bounds).collect()
    expected = brute(rows, 4, 5, 60)
    assert len(expected) > 100
    assert sorted(map(tuple, got)) == expected


def test_words_are_forgotten(spark, monkeypatch):
    rows = some_texts(40)
    monkeypatch.setattr(C, "WORDS", 3)
    counter = C.PhraseCounter(2, None, None)
    total = Counter()
    for lang, text in rows:
        data = (text or "").encode().lower().translate(C.PIECES).replace(C.BREAK, b" \xff ")
        counter.count(lang or "und", data.split())
        for batch in counter.overflow():
            for one, phrase, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total[one, phrase] += n
    for batch in counter.spill(0):
        for one, phrase, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            total[one, phrase] += n
    expected = Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            expected.update((lang or "und", " ".join(x)) for x in zip(w, w[1:], strict=False))
    assert total == expected


@pytest.mark.parametrize("length", [2, 3, 5])
def test_trie_bursts_and_spills_whole_subtrees(length):
    trie, expected = C.HatTrie(burst=4), Counter()
    draw = random.Random(1)

    def whole(first, rest):
        return (first, rest) if type(rest) is int else (first, *rest)

    for _ in range(600):
        first = draw.randint(1, 6)
        rests = {tuple(draw.randint(1, 6) for _ in range(length - 1)) for _ in range(5)}
        own = [r[0] if length == 2 else r for r in rests]
        trie.add(first, own, [2] * len(own))
        expected.update({(first, *r): 2 for r in rests})
    assert any(type(x) is C.Node for x in trie.root.values()) == (length > 2)
    assert trie.held == len(expected) == C.entries(trie.root)
    got = Counter()
    for first, run in trie.spill(trie.held // 2):
        own = {whole(first, rest): n for rest, n in run}
        assert len(own) == len(run) and not set(own) & set(got)
        assert set(own) == {p for p in expected if p[0] == first}
        got.update(own)
    assert 0 < trie.held <= len(expected) // 2
    for first, run in trie.spill(0):
        got.update({whole(first, rest): n for rest, n in run})
    assert got == expected and trie.held == 0


def test_filter_misses_none():
    hashes = np.array([C.word_hash(b"%d" % i, "en") for i in range(5000)], np.uint64)
    for power in (8, 17):
        own = C.BitFilter(power, np.zeros(0, int), np.zeros(0, np.uint64))
        slots, bits = C.places(hashes[:1000], power)
        np.bitwise_or.at(own.words, slots, bits)
        assert own.has(hashes[:1000]).all()
        assert [own.holds(int(x)) for x in hashes] == own.has(hashes).tolist()
    assert own.has(hashes[1000:]).mean() < 0.05


def test_counts_beyond_64_bits(spark):
    n = 3_000_000_000_000
    found = spark.createDataFrame(
        [("en", "a", 1, n), ("en", "b", 1, n // 3), ("en", "a b", 2, n // 7)],
        "lang string, phrase string, size int, n long")
    totals = spark.createDataFrame([("en", 90 * n)], "lang string, total long")
    row = C.weakest_cuts(found, totals).first()
    assert row["score"] == 1000 * (n // 7) * 90 * n // (n * (n // 3))


def test_edge_rows_and_empty_table(spark):
    rows = [(r[2], r[1]) for r in edge_tables.rows()]
    got = C.collocations(edge_tables.table(spark), min_count=2, best=50).collect()
    assert sorted(map(tuple, got)) == brute(rows, 2, 5, 50)
    assert C.collocations(edge_tables.empty(spark)).count() == 0
