"""Coder and packing against the tokenizers library, random strings and all placements."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import edge_tables
from shelfwise.llm import bpe, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def library_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_random_strings_as_library(library):
    draw = random.Random(5)
    parts = ["a", "b", " ", "  ", "\n", " \n", "\t", "\x1c", "\x85", "\xa0", "é", "'s", "'", "12",
             "<|endoftext|>", "世", "👍", "!", "x" * 70, "ab" * 90, "\x00", "The", " the", "."]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 30))) for _ in range(3000)]
    coder = bpe.BytePairCoder(PATH)
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode_blocks(texts)]
    assert got == [library_ids(library, t) for t in texts]
    assert [coder.decode(x) for x in coder.encode_blocks(texts)] == texts


def test_long_word_and_forgetting(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 3)
    coder = bpe.BytePairCoder(PATH)
    texts = ["ab" * 3000, "one two three four five six", "one two, three. four!", None]
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode_blocks(texts)]
        assert got == [library_ids(library, t) for t in texts]
    assert len(coder.pieces) <= 3


def test_round_trip_of_edge_rows(spark, library):
    got = bpe.round_trip(edge_tables.table(spark), PATH).collect()
    expected = []
    for row in edge_tables.rows():
        ids = library_ids(library, row[1])
        expected.append((row[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256((row[1] or "").encode()).hexdigest()))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    assert bpe.round_trip(edge_tables.empty(spark), PATH).count() == 0
    coded = bpe.encode_documents(edge_tables.table(spark), PATH)
    back = sorted(r["text"] for r in bpe.decode_documents(coded, PATH).collect())
    assert back == sorted(row[1] or "" for row in edge_tables.rows())


@pytest.mark.parametrize("seed", range(12))
def test_plan_places_all_without_overlap(seed):
    draw = random.Random(seed)
    capacity = draw.choice([1, 2, 3, 7, 30, 64])
    counts = {n: draw.choice([0, 1, 2, 5, 40]) for n in range(1, capacity + 1)}
    runs, opened = packing.plan_runs(counts, capacity)
    used = [np.zeros(capacity, int) for _ in range(opened)]
    for length, count in counts.items():
        own = sorted(r for r in runs if r.length == length)
        for rank in range(count):
            run = [r for r in own if r.first_rank <= rank][-1]
            beyond = rank - run.first_rank
            start = run.offset + beyond % run.each * length
            used[run.sequence + beyond // run.each][start:start + length] += 1
    for one in used:
        assert one.max(initial=0) <= 1 and one[0] == 1
        assert (np.diff(one) <= 0).all()  # gapless from 0
    total = sum(n * c for n, c in counts.items())
    least = max(-(-total // capacity), sum(c for n, c in counts.items() if 2 * n > capacity))
    assert least <= opened <= 1.34 * least + 1


def test_large_pieces_are_matched_in_pairs():
    runs, opened = packing.plan_runs({10: 2, 7: 3, 5: 3, 4: 2, 1: 4}, 12)
    by_sequence = {}
    for run in runs:
        if 3 * run.length > 12:
            by_sequence.setdefault(run.sequence, []).append(run.length)
    assert all(len(lengths) <= 2 for lengths in by_sequence.values())
    assert opened == 6


def test_pack_edge_rows(spark, library):
    placed = packing.pack_documents(edge_tables.table(spark), PATH).toPandas()
    lengths = sorted(len(library_ids(library, r[1])) + 1 for r in edge_tables.rows())
    assert placed["length"].sum() == sum(lengths)
    for _, one in placed.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        ends = (one["offset"] + one["length"]).tolist()
        assert one["offset"].tolist() == [0, *ends[:-1]] and ends[-1] <= 1024
    row = next(r for r in edge_tables.rows() if r[0] == 8)
    ids = np.array([*library_ids(library, row[1]), 2], "<u4")
    own = placed[placed["doc_id"] == 8].sort_values("piece")
    assert own["start"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]]
    assert (own["length"].iloc[1:] == 1024).all() and own["length"].sum() == len(ids)
    for _, piece in own.iterrows():
        a = int(piece["start"])
        assert zlib.crc32(ids[a:a + int(piece["length"])].tobytes()) == piece["ids_crc32"]
    assert packing.pack_documents(edge_tables.empty(spark), PATH).count() == 0


def test_sequences_hold_the_tokens(spark, library):
    docs = spark.createDataFrame([(i, edge_tables.words(i, 5 + 90 * i)) for i in range(12)],
                                 "doc_id long, text string")
    placed = packing.pack_documents(docs, PATH, 256)
    made = packing.sequences(placed, bpe.encode_documents(docs, PATH), 256).collect()
    tokens = sorted(t for r in made for t in np.frombuffer(bytes(r["ids"]), "<u4").tolist())
    expected = sorted(t for r in docs.collect() for t in [*library_ids(library, r["text"]), 2])
    assert tokens == expected
    assert all(len(r["ids"]) <= 4 * 256 for r in made)
