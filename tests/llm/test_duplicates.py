"""Exact, near and passage deduplication against brute force."""

from __future__ import annotations

import hashlib
import random
import time
import re

import numpy as np
import pytest
import xxhash

import edge_tables
from shelfwise.llm import components, exact, passages, simhash

SPACE = "[\x20\x09-\x0d]"


def exact_expected(rows):
    norm = [re.sub(SPACE, "", t or "") for _, t in rows]
    groups = {}
    for (i, t), n in zip(rows, norm, strict=True):
        groups.setdefault(n, []).append((-len(t or ""), i is None, i))
    return [(i, min(groups[n], key=lambda x: (x[0], x[1], x[2] or 0))[2], len(groups[n]),
             hashlib.sha256(n.encode()).hexdigest()) for (i, _), n in zip(rows, norm, strict=True)]


@pytest.mark.parametrize("hot", [1000, 2])
def test_content_sort(spark, hot):
    """``hot=2``: every repeated text is dealt into salted groups, with the same result."""
    many = [(100 + k, f"copy {' ' * (k % 5)} text") for k in range(300)]
    rows = [(r[0], r[1]) for r in edge_tables.rows()] + many
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = exact.content_sort(docs, hot_rows=hot).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got),
                  key=key) == sorted(exact_expected(rows), key=key)
    for digest in {r["text_sha256"] for r in got}:
        kept = [r for r in got if r["text_sha256"] == digest and r["kept"]]
        assert len(kept) == 1 and kept[0]["doc_id"] == kept[0]["keep_id"]


def test_content_sort_empty_and_extra_columns(spark):
    assert exact.content_sort(edge_tables.empty(spark)).count() == 0
    assert exact.content_sort(edge_tables.table(spark)).count() == len(edge_tables.rows())


def plain_fingerprint(text):
    words = [w for w in re.split(SPACE + "+", re.sub(
        "[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 7)
    texts = [r[1] for r in edge_tables.rows() if r[0] != 8 and r[0] != 15] + ["ÀB Ab\tC\x1cd e F g"]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def flipped(draw, most):
    return sum(1 << b for b in draw.sample(range(64), draw.randint(0, most)))


def test_bk_tree_finds_all_within_radius():
    draw = random.Random(3)
    base = [draw.getrandbits(64) for _ in range(20)]
    values = list({b ^ flipped(draw, 4)
                   for b in base for _ in range(15)})
    tree = simhash.BKTree(4)
    for value in values:
        tree.insert(value)
    for value in values:
        assert sorted(tree.values[p] for p in tree.near(value)) == sorted(
            v for v in values if (v ^ value).bit_count() <= 4)


def roots_of(ids, linked):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("masks", [None, 2, 3])
@pytest.mark.parametrize("shard_rows", [4096, 8])
def test_links_join_what_brute_force_joins(spark, shard_rows, masks, monkeypatch):
    """``shard_rows=8``: every shard is split into many trees, with the same components.

    ``masks``: so many blocks of bits are shared, as on larger tables.
    """
    if masks:
        real = simhash.block_masks
        monkeypatch.setattr(simhash, "block_masks", lambda rows, radius, _: real(
            {2: 10 ** 9, 3: 10 ** 11}[masks], radius, 4096))
    draw = random.Random(9)
    base = [draw.getrandbits(64) for _ in range(12)]
    values = sorted({b ^ flipped(draw, 5)
                     for b in base for _ in range(40)})
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    prints = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = [(r["a"], r["b"]) for r in simhash.near_links(prints, 4, shard_rows).collect()]
    close = [(signed[i], signed[j]) for i in range(len(values)) for j in range(i)
             if (values[i] ^ values[j]).bit_count() <= 4]
    assert len(links) <= 35 * len(values)
    assert roots_of(signed, links) == roots_of(signed, close)


def test_every_close_pair_shares_a_mask_at_any_size():
    draw = random.Random(2)
    sizes = [10 ** 3, 10 ** 7, 10 ** 9, 10 ** 11]
    assert [len(simhash.block_masks(n, 4, 4096)) for n in sizes] == [5, 5, 15, 35]
    for n in sizes:
        masks = simhash.block_masks(n, 4, 4096)
        assert all(n <= 4096 << mask.bit_count() for mask in masks)
        for _ in range(2000):
            changed = sum(1 << bit for bit in draw.sample(range(64), 4))
            assert any(changed & mask == 0 for mask in masks)
    assert simhash.block_masks(10, 0, 4096) == [(1 << 64) - 1]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (200, 200), (102, 100)]
    got = components.components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {
        **{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_edge_rows(spark):
    got = simhash.near_duplicates(edge_tables.table(spark)).collect()
    assert len(got) == len(edge_tables.rows())
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["component_id"] == by_id[2]["component_id"] == by_id[3]["component_id"] == 1
    assert by_id[4]["fingerprint"] == "0" * 16 and by_id[6]["component_id"] == 4
    assert by_id[15]["component_id"] == 8
    assert simhash.near_duplicates(edge_tables.empty(spark)).count() == 0


def test_keep_first_of_edge_rows(spark):
    docs = edge_tables.table(spark)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
    assert ids == [(False, i) for i in (1, 4, 7, 8, 9, 10, 11, 12, 13, 14)] + [(True, 0)]
    assert simhash.keep_first(edge_tables.empty(spark)).count() == 0


def test_compact_windows_hold_each_stretch_once():
    draw = np.random.default_rng(4)
    hashes = draw.permutation(60).astype(np.uint64)
    found = passages.compact_windows(hashes, 10)
    for i in range(60):
        for j in range(i + 9, 60):
            holds = [w for w in found if w[0] <= i <= w[1] <= j <= w[2]]
            assert len(holds) == 1 and hashes[holds[0][1]] == hashes[i:j + 1].min()


def test_edits_side_by_side_do_not_cut_a_passage():
    """Adjacent words replaced or put in: alike as a whole, though a step is over six places."""
    for n, at in ((60, 28), (80, 38), (90, 43)):
        words = [b"w%d" % i for i in range(n)]
        new = [b"x", b"y", b"z"][:2 if n == 60 else 3]
        for edited in (words[:at] + new + words[at + len(new):], words[:at] + new + words[at:]):
            a, b = (passages.shingle_hashes(x) for x in (words, edited))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            assert true >= 0.8
            assert passages.alike_passages(a, b, 46, 0.8) == [(0, len(a) - 1, 0, len(b) - 1, true)]


def test_every_place_of_a_passage_is_compared():
    passage = [b"p%d" % i for i in range(60)]
    fill = [[b"f%d_%d" % (k, i) for i in range(90)] for k in range(4)]
    one = passages.shingle_hashes(fill[0] + passage)
    two = passages.shingle_hashes(fill[1] + passage + fill[2] + passage + fill[3])
    assert sorted(passages.alike_passages(one, two, 46, 0.8)) == [
        (90, 145, 90, 145, 1.0), (90, 145, 240, 295, 1.0)]
    assert sorted(passages.alike_passages(two, one, 46, 0.8)) == [
        (90, 145, 90, 145, 1.0), (240, 295, 90, 145, 1.0)]


def best_alike(a, b, least):
    """Highest Jaccard of stretches between common places, of sequences without repeats."""
    place = {x: i for i, x in enumerate(b.tolist())}
    both = [(i, place[x]) for i, x in enumerate(a.tolist()) if x in place]
    best = 0
    for u, (i, m) in enumerate(both):
        for many, (j, n) in enumerate(both[u:], 1):
            if min(j - i, n - m) >= least - 1:
                best = max(best, many / (j - i + n - m + 2 - many))
    return best


def test_an_alike_stretch_among_many_edits_is_found():
    """Texts edited all over are not alike as a whole, but some of their stretches are."""
    rng = np.random.default_rng(11)
    alike = 0
    for case in range(60):
        words = [b"w%d" % i for i in range(260)]
        other = [w if draw > 0.05 else b"x%d" % i
                 for i, (w, draw) in enumerate(zip(words, rng.random(260), strict=True))]
        if case % 2:
            del other[130:133]
        a, b = (passages.shingle_hashes(x) for x in (words, other))
        true = best_alike(a, b, 46)
        found = passages.alike_passages(a, b, 46, 0.8)
        assert bool(found) == (true >= 0.8)
        for i, j, m, n, s in found:
            one, two = a[i:j + 1], b[m:n + 1]
            assert min(len(one), len(two)) >= 46 and s >= 0.8
            assert s == len(np.intersect1d(one, two)) / len(np.union1d(one, two))
        alike += true >= 0.8
    assert 10 < alike < 60


def test_windows_of_texts_side_by_side_are_those_of_each():
    rng = np.random.default_rng(7)
    for case in range(40):
        texts = [rng.integers(0, (3, 50, 2 ** 62)[case % 3], n).astype(np.uint64)
                 for n in rng.integers(0, 150, 4)]
        bounds = np.r_[0, np.cumsum([len(x) for x in texts])]
        found = passages.windows_of_many(np.concatenate(texts), bounds, 20)
        assert sorted(zip(*(x.tolist() for x in found), strict=True)) == sorted(
            (k, left + bounds[k], pivot + bounds[k], right + bounds[k])
            for k, x in enumerate(texts) for left, pivot, right in passages.stacked_windows(x, 20))


def planted(spark):
    texts = {i: edge_tables.words(1000 + i, 150).split() for i in range(40)}
    passage = edge_tables.words(77, 60).split()
    for i in range(10):
        texts[i] = texts[i][:20 + i] + passage + texts[i][20 + i:]
    edited = passage[:30] + ["edited"] + passage[31:]
    texts[10] = texts[10][:5] + edited + texts[10][5:]
    texts[11] = list(texts[12])
    rows = [(i, " ".join(w)) for i, w in texts.items()] + [(None, None), (50, ""), (51, "short")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("salted", [False, True])
def test_planted_passages(spark, monkeypatch, salted):
    docs = planted(spark)
    if salted:  # the sample is the table itself, so frequent minima are dealt by salt
        plain = passages.windows
        monkeypatch.setattr(passages, "windows", lambda k, least, functions: plain(
            docs.withColumnRenamed("doc_id", "i").selectExpr(
                "xxhash64(text) AS text_key", "text"), least, functions))
        monkeypatch.setattr(passages, "max", lambda a, b: 2, raising=False)
    got = passages.near_duplicate_passages(docs).collect()
    copies = [r for r in got if r["whole_copy"]]
    assert [(r["doc_id"], r["other_id"], r["n_words"]) for r in copies] == [(12, 11, 150)]
    alike = [r for r in got if not r["whole_copy"]]
    linked = roots_of(range(60), [(r["doc_id"], r["other_id"]) for r in alike])
    assert all(linked[i] == 0 for i in range(10))
    assert all(linked[i] == i for i in range(13, 60))
    for r in alike:
        assert r["doc_id"] > r["other_id"] and r["similarity"] >= 0.8
        if r["doc_id"] < 10:
            assert (r["start"], r["n_words"]) == (20 + r["doc_id"], 60)


def test_passages_of_edge_rows(spark):
    got = passages.near_duplicate_passages(edge_tables.table(spark)).collect()
    pairs = {(r["doc_id"], r["other_id"]) for r in got}
    assert (2, 1) in pairs and (15, 8) in pairs
    assert passages.near_duplicate_passages(edge_tables.empty(spark)).count() == 0


def test_windows_of_deep_trees_are_those_of_shallow_ones():
    rng = np.random.default_rng(5)
    for values in (rng.integers(0, 2 ** 60, 300), rng.integers(0, 4, 300), np.arange(200),
                   np.arange(200)[::-1], np.zeros(150), np.r_[np.zeros(40), rng.integers(0, 9, 80)]):
        hashes = values.astype(np.uint64)
        for least in (1, 2, 30):
            assert sorted(passages.stacked_windows(hashes, least)) == sorted(
                passages.compact_windows(hashes, least))


def test_a_very_long_repetitive_text_is_one_pass():
    begun = time.process_time()
    found = passages.compact_windows(np.zeros(400_000, np.uint64), 46)
    assert len(found) == 400_000 - 45 and time.process_time() - begun < 20


def test_a_document_with_a_passage_has_rows_of_its_own(spark):
    found = passages.near_duplicate_passages(planted(spark))
    got = passages.from_both_sides(found).collect()
    assert {r["doc_id"] for r in got} == set(range(13))  # 0 and 11 are only other_id in the pairs
    assert sorted(map(tuple, found.collect())) == sorted(
        tuple(r) for r in got if r["doc_id"] > r["other_id"])
    for r in got:
        if r["doc_id"] < 10:
            assert (r["start"], r["n_words"]) == (20 + r["doc_id"], 60)
        if r["other_id"] < 10:
            assert (r["other_start"], r["other_n_words"]) == (20 + r["other_id"], 60)


def test_words_of_each_text_once_and_none_of_short_ones(spark):
    texts = [" ".join(["w"] * 49 + [str(i)]) for i in range(3)]  # 99 bytes, 50 words
    spaced = "\t" + texts[0].replace(" ", " \n\x0b") + "\r"
    rows = [*enumerate([*texts, texts[0], spaced, spaced, " ".join(["long" * 9] * 49)] * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = passages.near_duplicate_passages(docs).where("whole_copy").collect()
    assert sorted((r["doc_id"], r["other_id"], r["n_words"]) for r in got) == [
        (3, 0, 50), (5, 4, 50), (7, 0, 50), (8, 1, 50), (9, 2, 50), (10, 0, 50), (11, 4, 50),
        (12, 4, 50)]


def test_windows_of_several_functions_that_hold_one_stretch():
    """Every stretch of 10 places whose minima two texts share under 3 functions gives one key."""
    rng = np.random.default_rng(3)
    met = 0
    for case in range(30):
        passage = rng.integers(0, 2 ** 62, 24)
        found, texts = [], []
        for _ in range(2):
            ends = rng.integers(0, (2 ** 62, 5)[case % 2], (2, 30))
            texts.append(np.r_[ends[0], passage, ends[1]].astype(np.uint64))
            rows = []
            for function in range(6):
                own = passages.permuted(texts[-1], function)
                rows += [(own[c], left, c, right)
                         for left, c, right in passages.stacked_windows(own, 10)]
            columns = [np.array(x) for x in zip(*rows, strict=True)]
            key, c, lo, hi = passages.agreeing(
                columns[0].astype(np.uint64).view(np.int64), *columns[1:], 3, 10)
            assert (hi - lo >= 9).all() and (c < len(texts[-1])).all()
            found.append(set(key.tolist()))
        minima = [[passages.permuted(t[i:i + 10], f).min() for f in range(6)]
                  for t in texts for i in range(len(t) - 9)]
        one, two = (np.array(x) for x in (minima[:len(minima) // 2], minima[len(minima) // 2:]))
        shared = ((one[:, None] == two).sum(axis=2) >= 3).any()
        assert not shared or found[0] & found[1]
        met += shared
    assert met == 30


def test_kinds_and_shared_codes():
    rng = np.random.default_rng(4)
    for high in (3, 30, 10 ** 9):
        codes = rng.integers(0, high, 80).astype(np.uint64)
        assert passages.least_kinds(codes, 12) == min(
            len(set(codes[i:i + 12].tolist())) for i in range(69))
    sets = [np.unique(rng.integers(0, 40, n).astype(np.uint64)) for n in (5, 30, 30, 60, 60)]
    kinds = np.array([4, 10, 12, 20, 20])
    good = passages.pairs_alike_enough(sets, kinds, 0.8)
    for i, one in enumerate(sets):
        for j, two in enumerate(sets):
            assert good[i, j] == (len(np.intersect1d(one, two)) >= 0.8 * max(kinds[i], kinds[j]))


def test_no_two_texts_with_a_passage_are_lost(spark, monkeypatch):
    """Without the links of neighbours all pairs are found, those of a class by the first of it."""
    monkeypatch.setattr(passages, "BLOCK", 2)
    monkeypatch.setattr(passages, "FEW", 3)
    plain = passages.window_links

    def few(found, sample):
        links, sizes, shared = plain(found, sample)
        return links.where("function = 8"), sizes, shared

    monkeypatch.setattr(passages, "window_links", few)
    got = [r for r in passages.near_duplicate_passages(planted(spark)).collect()
           if not r["whole_copy"]]
    linked = roots_of(range(60), [(r["doc_id"], r["other_id"]) for r in got])
    assert all(linked[i] == 0 for i in range(10)) and all(linked[i] == i for i in range(13, 60))
    for r in got:
        if r["doc_id"] < 10:
            assert (r["start"], r["n_words"]) == (20 + r["doc_id"], 60)


def test_a_passage_whose_partners_differ_by_function_is_found(spark):
    """Each half of a passage stands in texts between two others, too; these two share all of it."""
    rng = np.random.default_rng(9)
    new = lambda n: [f"w{x}" for x in rng.integers(0, 10 ** 9, n)]
    rows, pairs = [], []
    for case in range(12):
        passage = new(56)
        pairs.append((len(rows), len(rows) + 1))
        texts = [new(40) + passage + new(40), new(40) + passage + new(40)]
        for k in range(25):  # parts of the passage, each too short to be one
            at = int(rng.integers(0, 30))
            texts.append(new(60) + passage[at:at + 26] + new(60))
        rows += [(len(rows) + i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = passages.near_duplicate_passages(docs).collect()
    words = [t.split() for _, t in rows]
    fives = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in words]
    assert all(len(fives[r["doc_id"]] & fives[r["other_id"]]) >= 37 for r in got)
    assert {(r["other_id"], r["doc_id"]) for r in got} == set(pairs)
