"""Ranked search against scoring every document, in shards of any size."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import edge_tables
import numpy as np
import pytest

from shelfwise.llm import ranked_search as R

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in counts]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(items):
        asked, scored = Counter(terms(text)), []
        for (doc_id, own), length in zip(counts, lengths, strict=True):
            score = 0
            for t, q in asked.items():
                if own[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    m = 100 - 75 + 75 * length * n // total
                    score += q * w * (1_000_000_000 * own[t] // (1000 * own[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def some_docs(n=300):
    draw = random.Random(8)
    words = [f"w{i}" for i in range(60)] + ["The", "É1", "a_b", "x\x00y", "世界"]
    heavy = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(draw.choices(words, heavy, k=draw.randint(0, 40)))) for i in range(n)]
    docs += [(n + i, docs[5][1]) for i in range(30)]  # ties
    items = [(i, " ".join(draw.choices(words, k=draw.randint(0, 12)))) for i in range(40)]
    return docs, items + [(99, None), (98, "nothing of this"), (97, docs[5][1]), (0, items[0][1])]


@pytest.mark.parametrize(("postings", "block"), [(1 << 21, 5000), (200, 5000), (1, 7)])
def test_as_scoring_all(spark, postings, block):
    docs, items = some_docs()
    got = R.ranked_search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"), 10, block, postings)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_long_text_counts_as_in_one_piece(monkeypatch):
    docs, _ = some_docs(20)
    numbers, _ = R.number_terms([" ".join(t for _, t in docs)])
    whole = R.TermCounts(numbers)
    whole.add([R.term_bytes(t) for _, t in docs])
    monkeypatch.setattr(R, "BLOCK", 16)
    cut = R.TermCounts(numbers)
    cut.add([R.term_bytes(t) for _, t in docs])
    assert whole.lengths == cut.lengths == [len(terms(t)) for _, t in docs]
    for a, b in ((whole.terms, cut.terms), (whole.counts, cut.counts)):
        assert [x.tolist() for x in a] == [x.tolist() for x in b]


def test_search_stops_before_the_end_of_the_lists(monkeypatch):
    draw = random.Random(3)
    rare = sorted(draw.sample(range(20_000), 40))
    tf = np.ones(20_000, np.int64)
    starts, held, counts = [0], [], []
    for i in range(20_000):
        own = [0, 1] if i in rare else [0]
        held += own
        counts += [int(tf[i]) * (1 + i % 5)] + [30] * (len(own) - 1)
        starts.append(len(held))
    shard = R.Shard(list(range(20_000)), np.full(20_000, 50), np.array(starts), np.array(held),
                    np.array(counts), 20_000, 20_000 * 50)
    weights, factors = np.array([1, 6000]), np.zeros(2, np.int64)
    query = R.Query(np.array([0, 1]), np.array([1, 1]))
    found, scores = shard.search(1, query, weights, factors, 10)
    seen = int((shard.seen == 1).sum())
    assert seen < 2000 and not factors.any()
    m = 25 + 75 * 50 * 20_000 // (20_000 * 50)
    every = sorted((-sum(w * (1_000_000_000 * c // (1000 * c + 8 * m)) for w, c in zip(
        weights, counts[starts[i]:starts[i + 1]], strict=False)), i) for i in range(20_000))[:10]
    assert [(-int(s), int(i)) for s, i in zip(scores, found, strict=True)] == every


def test_edge_rows_and_empty_tables(spark):
    docs = [(r[0], r[1]) for r in edge_tables.rows()]
    items = [(i, text) for i, (_, text) in enumerate(docs)] + [(None, "a b c"), (0, "b")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = R.ranked_search(edge_tables.table(spark), table)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)
    assert R.ranked_search(edge_tables.empty(spark), table).count() == 0
    assert R.ranked_search(edge_tables.table(spark), table.limit(0)).count() == 0
