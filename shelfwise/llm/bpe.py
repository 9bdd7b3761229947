"""Byte-pair encoding and decoding by a segment tree over the ranks of adjacent pairs.

A leaf holds ``rank * width + position`` of the pair that starts there, so the root of the
minimum tree is the leftmost pair of the lowest rank. A merge changes three leaves (the merged
pair, the one before it and the one that vanished); each costs one walk to the root. Short words
are merged many at a time, one row of a tree matrix each; a long run of letters, which the
pre-tokenizer does not cut, gets a tree of its own, so it takes n log n steps, not n squared.

Texts are cut at spaces first. A space that no other white space touches always starts a new
pre-token, so a piece's tokens don't depend on its neighbours and can be kept. Texts with longer
runs of white space are cut by the pre-tokenizer's own pattern as a whole.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.batches import sliced

#: Fixed value: the public byte-level pre-tokenizer's pattern. White space is Unicode's property.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Words of more bytes get a tree of their own.
WIDEST = 64
#: Kept pieces and kept words, each; when full they are forgotten and filled anew.
KEPT = 300_000
#: Characters whose pieces are in memory at the same time, unless one text is longer.
BLOCK_CHARS = 4_000_000
NEVER = np.iinfo(np.int32).max


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary, reversed."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(spare)}


class PairTable:
    """Rank and merged id of a pair of ids: open addressing, so that arrays can be looked up."""

    SLOTS = 1 << 20

    def __init__(self, pairs: dict[int, int]):
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        ranks = np.fromiter(pairs.values(), np.int32, len(pairs))
        self.keys = np.full(self.SLOTS, -1, np.int64)
        self.ranks = np.full(self.SLOTS, NEVER, np.int32)
        slot, self.probes = self.slot(keys), 0
        while len(keys):
            self.probes += 1
            _, first = np.unique(slot, return_index=True)
            put = first[self.keys[slot[first]] == -1]
            self.keys[slot[put]], self.ranks[slot[put]] = keys[put], ranks[put]
            left = np.setdiff1d(np.arange(len(keys)), put)
            keys, ranks, slot = keys[left], ranks[left], (slot[left] + 1) & (self.SLOTS - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.int64(0x9E3779B97F4A7C15 - (1 << 64))) >> 40) & (self.SLOTS - 1)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 20) | right
        slot = self.slot(keys)
        found = np.full(keys.shape, NEVER, np.int32)
        for _ in range(self.probes):
            np.copyto(found, self.ranks[slot], where=self.keys[slot] == keys)
            slot = (slot + 1) & (self.SLOTS - 1)
        return found


class BytePairCoder:
    """Encodes and decodes as the tokenizers library does with the same file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        vocab, letters = stored["model"]["vocab"], byte_letters()
        self.special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        self.byte_ids = np.zeros(256, np.int32)
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocab[letter]
        self.pairs, merged = {}, []
        for rank, pair in enumerate(stored["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.pairs.setdefault(vocab[left] << 20 | vocab[right], rank)
            merged.append(vocab[left + right])
        self.merged = np.array(merged, np.int32)
        self.table = PairTable(self.pairs)
        self.bytes_of = {i: bytes(letters[c] for c in token) if all(c in letters for c in token)
                         else token.encode() for token, i in vocab.items()}
        self.bytes_of |= {i: text.encode() for text, i in self.special.items()}
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.cut = regex.compile(PATTERN).findall
        self.runs = regex.compile(r"\p{White_Space} (?:\p{White_Space}|$)").search
        self.at_special = (regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
                           if self.special else None)

    # -- merging -----------------------------------------------------------------------------

    def merge_rows(self, ids: np.ndarray) -> np.ndarray:
        """Merge every row of a matrix of ids, padded by -1; merged-away places become -1."""
        rows, width = ids.shape
        shift = width.bit_length() - 1
        ids = ids.ravel().copy()
        after = np.tile(np.arange(1, width + 1, dtype=np.int32), rows)
        before = np.tile(np.arange(-1, width - 1, dtype=np.int32), rows)
        tree = np.full((rows, 2 * width), NEVER, np.int32)
        grid = ids.reshape(rows, width)
        after.reshape(rows, width)[:, :-1][grid[:, 1:] < 0] = width
        after.reshape(rows, width)[:, -1] = width
        ranks = self.table.rank(np.maximum(grid[:, :-1], 0), np.maximum(grid[:, 1:], 0))
        usable = (grid[:, 1:] >= 0) & (ranks < NEVER)
        places = np.arange(width - 1, dtype=np.int32)
        tree[:, width:-1] = np.where(usable, (ranks << shift) | places, NEVER)
        half = width >> 1
        while half:
            np.minimum(tree[:, 2 * half:4 * half:2], tree[:, 2 * half + 1:4 * half:2],
                       out=tree[:, half:2 * half])
            half >>= 1
        tree, live = tree.ravel(), np.arange(rows)
        while True:
            root = tree[live * (2 * width) + 1]
            live, root = live[root < NEVER], root[root < NEVER]
            if not len(live):
                return ids.reshape(rows, width)
            flat, top = live * width, live * (2 * width)
            at = root & (width - 1)
            gone = after[flat + at]
            right, left = after[flat + gone], before[flat + at]
            new = self.merged[root >> shift]
            ids[flat + at], ids[flat + gone], after[flat + at] = new, -1, right
            has_right, has_left = right < width, left >= 0
            before[(flat + right)[has_right]] = at[has_right]
            rank = np.full(len(live), NEVER, np.int32)
            rank[has_right] = self.table.rank(new[has_right], ids[(flat + right)[has_right]])
            self.put(tree, top, width, at, rank, shift)
            self.put(tree, top, width, gone, np.full(len(live), NEVER, np.int32), shift)
            rank = self.table.rank(ids[(flat + left)[has_left]], new[has_left])
            self.put(tree, top[has_left], width, left[has_left], rank, shift)

    @staticmethod
    def put(tree, top, width, place, rank, shift) -> None:
        """One leaf of each row, then its way to the root."""
        key = np.where(rank < NEVER, (np.minimum(rank, NEVER >> shift) << shift) | place, NEVER)
        node = place + width
        tree[top + node] = key
        for _ in range(shift):
            node = node >> 1
            tree[top + node] = np.minimum(tree[top + 2 * node], tree[top + 2 * node + 1])

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same for one long word, with a tree of Python integers."""
        size = 1 << max(1, (len(ids) - 1).bit_length())
        never, pairs, merged = size << 20, self.pairs, self.merged
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        tree = [never] * (2 * size)

        def key(place: int) -> int:
            rank = None
            if after[place] < len(ids):
                rank = pairs.get(ids[place] << 20 | ids[after[place]])
            return never if rank is None else rank * size + place

        def put(place: int, value: int) -> None:
            node = place + size
            tree[node] = value
            while node > 1:
                node >>= 1
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    break
                tree[node] = low

        for place in range(len(ids)):
            tree[size + place] = key(place)
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] < never:
            rank, at = divmod(tree[1], size)
            gone = after[at]
            ids[at], ids[gone], after[at] = int(merged[rank]), -1, after[gone]
            if after[at] < len(ids):
                before[after[at]] = at
            put(gone, never)
            put(at, key(at))
            if before[at] >= 0:
                put(before[at], key(before[at]))
        return [i for i in ids if i >= 0]

    def learn(self, words: list[str]) -> list[bytes]:
        """Tokens of each word, merged in classes of equal width."""
        raws = [word.encode() for word in words]
        lengths = np.fromiter(map(len, raws), np.int64, len(raws))
        out: list[bytes] = [b""] * len(raws)
        for place in np.flatnonzero(lengths > WIDEST).tolist():
            ids = self.byte_ids[np.frombuffer(raws[place], np.uint8)].tolist()
            out[place] = np.array(self.merge_long(ids), "<u4").tobytes()
        low, width = 0, 2
        while width <= WIDEST:
            chosen = np.flatnonzero((lengths > low) & (lengths <= width))
            step = max(1, 400_000 // width)
            for start in range(0, len(chosen), step):
                part = chosen[start:start + step]
                grid = np.full((len(part), width), -1, np.int32)
                grid[np.arange(width) < lengths[part][:, None]] = self.byte_ids[
                    np.frombuffer(b"".join([raws[i] for i in part.tolist()]), np.uint8)]
                grid = self.merge_rows(grid)
                kept = grid >= 0
                flat = grid[kept].astype("<u4").tobytes()
                ends = (np.cumsum(kept.sum(axis=1)) * 4).tolist()
                for i, a, b in zip(part.tolist(), [0, *ends[:-1]], ends, strict=True):
                    out[i] = flat[a:b]
            low, width = width, 2 * width
        return out

    # -- texts -------------------------------------------------------------------------------

    def join_words(self, lists: list[list[str]]) -> list[bytes]:
        """Tokens of texts that the pre-tokenizer's pattern has cut into words."""
        known = self.words
        new = list(set(itertools.chain.from_iterable(lists)).difference(known))
        known.update(zip(new, self.learn(new), strict=True))
        out = [b"".join(map(known.__getitem__, words)) for words in lists]
        self.forget(known, new)
        return out

    @staticmethod
    def forget(known: dict[str, bytes], new: list[str]) -> None:
        """Bound what is kept between blocks."""
        if len(known) > KEPT:
            known.clear()
        else:
            for word in new:
                if len(word) > WIDEST:
                    del known[word]

    def lookup(self, pieces: list[str]) -> list[bytes]:
        """Tokens of pieces, each with the space before it that its name lacks."""
        known = self.pieces
        new = [piece for piece in pieces if piece not in known]
        single = [piece for piece in new if piece.isalpha()]
        known.update(zip(single, self.learn([" " + p for p in single]), strict=True))
        mixed = [piece for piece in new if not piece.isalpha()]
        known.update(zip(mixed, self.join_words([self.cut(" " + p) for p in mixed]), strict=True))
        out = list(map(known.__getitem__, pieces))
        self.forget(known, new)
        return out

    def encode_plain(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of texts without special tokens.

        Arrow cuts the texts and numbers their distinct pieces; the tokens of each distinct
        piece are then laid out text by text.
        """
        if not texts:
            return []
        whole = [bool(self.runs(text)) for text in texts]
        heads = self.join_words([self.cut(text if alone else text.partition(" ")[0])
                                 for text, alone in zip(texts, whole, strict=True)])
        cut = pc.split_pattern(pa.array(["" if alone else text for text, alone
                                         in zip(texts, whole, strict=True)], pa.string()), " ")
        named = cut.flatten().dictionary_encode()
        coded = self.lookup(named.dictionary.to_pylist())
        bounds = cut.offsets.to_numpy()
        codes = named.indices.to_numpy().copy()
        codes[bounds[:-1]] = np.arange(len(coded), len(coded) + len(texts))
        flat = np.frombuffer(b"".join(coded) + b"".join(heads), "<u4")
        sizes = np.fromiter(map(len, itertools.chain(coded, heads)), np.int64) // 4
        starts = np.cumsum(sizes) - sizes
        counts = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(counts)])
        places = np.repeat(starts[codes] - ends[:-1], counts) + np.arange(ends[-1])
        ids = flat[places].tobytes()
        cuts = (ends[bounds] * 4).tolist()
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; a special token's text becomes its id, as in the library."""
        if self.at_special is None or not any(s in t for t in texts for s in self.special):
            return self.encode_plain(texts)
        out = []
        for text in texts:
            parts = self.at_special.split(text)
            coded = self.encode_plain(parts[::2])
            out.append(coded[0] + b"".join(
                self.special[name].to_bytes(4, "little") + code
                for name, code in zip(parts[1::2], coded[1:], strict=True)))
        return out

    def encode_blocks(self, texts: list[str | None]) -> Iterator[bytes]:
        """The same for many texts, so many at a time that their pieces fit into memory."""
        block, size = [], 0
        for text in texts:
            block.append(text or "")
            size += len(block[-1])
            if size >= BLOCK_CHARS:
                yield from self.encode(block)
                block, size = [], 0
        yield from self.encode(block)

    def decode(self, ids: bytes) -> str:
        """The text of little-endian 32-bit ids, special tokens included."""
        listed = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.bytes_of.__getitem__, listed)).decode("utf-8", "replace")


_coders: dict[str, BytePairCoder] = {}


def coder(path: str) -> BytePairCoder:
    """The coder of a file, read once in each Python process."""
    if path not in _coders:
        _coders[path] = BytePairCoder(path)
    return _coders[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids``: the little-endian 32-bit token ids of each whole text as binary.

    One row for each row of ``docs``, repeated and null ``doc_id`` included; other columns are
    not read. A null text counts as empty and gives no ids. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in sliced(batches):
            ids = pa.array(own.encode_blocks(batch.column(1).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("ids", T.BinaryType())])
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def decode_documents(coded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids``; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in sliced(batches):
            texts = pa.array((own.decode(x or b"") for x in batch.column(1).to_pylist()),
                             pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["doc_id", "text"])

    kind = coded.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("text", T.StringType())])
    return coded.select("doc_id", "ids").mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encode each text, decode its ids.

    Nulls, repeats and empty tables as in ``encode_documents``. Both ways run in one task, so
    that the ids, which are larger than the text, need not leave it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path)
        for batch in sliced(batches):
            counts, first, second = [], [], []
            for ids in own.encode_blocks(batch.column(1).to_pylist()):
                counts.append(len(ids) // 4)
                first.append(hashlib.sha256(ids).hexdigest())
                second.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(first, pa.string()),
                 pa.array(second, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType())])
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)
