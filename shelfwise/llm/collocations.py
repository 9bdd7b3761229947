"""Phrase collocations: level-wise counting in HAT-tries, exact cuts, longest phrases kept.

A phrase of n words can be frequent only if its first and its last n - 1 words are, so phrases are
counted by length, each length in one scan. What was frequent one word shorter goes to the tasks as
a bit filter of bounded size: it lets every frequent phrase pass and few others, and the exact
counts decide. Before phrases of three words the texts are cut down once to the stretches all of
whose pairs of words pass; longer phrases are counted in these. Each task counts in HAT-tries: a
shallow trie over word numbers with hash containers below, which burst into nodes when they grow.
Beyond a number of entries the largest subtrees are spilled whole as sorted runs. Runs of all tasks
are dealt by hash of language and phrase, so a frequent prefix is spread over all partitions, and
merged there by adding equal phrases.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.storage import discard, materialise
from shelfwise.llm.batches import word_blocks

UNKNOWN_LANG = "und"
BREAK = b"\xff"  # no byte of UTF-8
#: Marks and line ends become breaks between pieces, tabs become spaces.
PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", BREAK * 10 + b" ")
BURST = 4096  #: entries of a container before it becomes a node
HELD = 400_000  #: entries of a task's tries before subtrees are spilled
WORDS = 1_000_000  #: distinct words that a task numbers before it spills and forgets
BLOCK = 1 << 22  #: bytes of text that are counted at a time
RUN = 100_000  #: rows of a batch of a sorted run
MAX_BITS = 27  #: the filter has at most two to this power bits (16 MB)


class Container(dict):
    """Hash container: rest of a phrase (a word number, or a tuple of several) to count."""


class Node(dict):
    """Trie node: word number to the node or container below it."""


Rest = int | tuple[int, ...]


class HatTrie:
    """Counts of phrases of one length, in word numbers; the root is a node of first words."""

    def __init__(self, burst: int = BURST):
        self.burst, self.held, self.root = burst, 0, Node()

    def add(self, first: int, rests: list[Rest], counts: list[int]) -> None:
        """Add phrases with one first word and different rests."""
        below = self.root.get(first)
        if below is None:
            below = self.root[first] = Container()
        self.held += self._add(self.root, first, below, rests, counts)

    def _add(self, above: Node, word: int, below: Container | Node, rests: list[Rest],
             counts: list[int]) -> int:
        if type(below) is Node:
            deeper: dict[int, list[tuple[Rest, int]]] = {}
            for rest, n in zip(rests, counts, strict=True):
                deeper.setdefault(rest[0], []).append((shorter(rest), n))
            new = 0
            for next_word, own in deeper.items():
                under = below.get(next_word)
                if under is None:
                    under = below[next_word] = Container()
                new += self._add(below, next_word, under, *map(list, zip(*own, strict=True)))
            return new
        before, get = len(below), below.get
        for rest, n in zip(rests, counts, strict=True):
            below[rest] = get(rest, 0) + n
        if len(below) > self.burst and type(rests[0]) is tuple:
            node = above[word] = Node()
            for rest, n in below.items():
                node.setdefault(rest[0], Container())[shorter(rest)] = n
        return len(below) - before

    def spill(self, most: int) -> Iterator[tuple[int, list[tuple[Rest, int]]]]:
        """Take out whole subtrees, the largest first, until at most ``most`` entries are left.

        First words with what follows them.
        """
        if self.held <= most:
            return
        sizes = sorted(((entries(below), word) for word, below in self.root.items()), reverse=True)
        for size, word in sizes:
            if self.held <= most:
                return
            self.held -= size
            below = self.root.pop(word)
            yield word, list(below.items() if type(below) is Container else flattened(below, ()))


def shorter(rest: tuple[int, ...]) -> Rest:
    return rest[1] if len(rest) == 2 else rest[1:]


def entries(below: Container | Node) -> int:
    return len(below) if type(below) is Container else sum(map(entries, below.values()))


def flattened(below: Container | Node, lead: tuple[int, ...]) -> Iterator[tuple[Rest, int]]:
    for word, under in below.items():
        if type(below) is Node:
            yield from flattened(under, (*lead, word))
        else:
            yield (*lead, *(word if type(word) is tuple else (word,))), under


class BitFilter:
    """A set of phrase hashes: no phrase of the set is missed, others pass rarely."""

    def __init__(self, power: int, slots: np.ndarray, bits: np.ndarray):
        self.power = power
        self.words = np.zeros(max(1, (1 << power) >> 6), np.uint64)
        self.words[slots] = bits

    def holds(self, own: int) -> bool:
        return bool(int(self.words[own >> 64 - self.power + 6]) >> (own & 63) & 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slots, bits = places(hashes, self.power)
        return (self.words[slots] & bits) != 0


def places(hashes: np.ndarray, power: int) -> tuple[np.ndarray, np.ndarray]:
    """Slot and bit of 64 in the filter of two to the ``power`` bits."""
    slots = (hashes >> np.uint64(64 - power + 6)).astype(np.int64)
    return slots, np.uint64(1) << (hashes & np.uint64(63))


def lang_seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


def word_hash(word: bytes, lang: str) -> int:
    return xxhash.xxh64_intdigest(word, lang_seed(lang))


def joined(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words, from the words' hashes."""
    total = hashes[:len(hashes) - size + 1].copy()
    for i in range(1, size):
        total = (total ^ (total >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        total += hashes[i:len(hashes) - size + 1 + i]
    return total


class Words(dict):
    """Numbers from 1 for the words of one language that pass the filter; others are 0."""

    def __init__(self, lang: str, allowed: BitFilter | None):
        super().__init__({BREAK: 0})
        self.seed, self.allowed = lang_seed(lang), allowed
        self.names: list[bytes] = [b""]
        self.hashes = np.zeros(1024, np.uint64)

    def __missing__(self, word: bytes) -> int:
        own, number = xxhash.xxh64_intdigest(word, self.seed), 0
        if self.allowed is None or self.allowed.holds(own):
            number = len(self.names)
            self.names.append(word)
            if number >= len(self.hashes):
                self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
            self.hashes[number] = own
        self[word] = number
        return number


class PhraseCounter:
    """Counts of the phrases of ``size`` words in one task, one trie for each language."""

    def __init__(self, size: int, allowed: BitFilter | None, parts: BitFilter | None,
                 held: int = HELD, burst: int = BURST):
        self.size, self.allowed, self.parts, self.held, self.burst = (
            size, allowed, parts, held, burst)
        self.single: dict[str, Counter] = {}
        self.words: dict[str, Words] = {}
        self.tries: dict[str, HatTrie] = {}

    def numbers(self, lang: str) -> Words:
        if lang not in self.words:
            self.words[lang], self.tries[lang] = Words(lang, self.allowed), HatTrie(self.burst)
        return self.words[lang]

    def count(self, lang: str, tokens: list[bytes], times: int = 1) -> None:
        """Add the phrases of consecutive tokens, each ``times`` its number."""
        if self.size == 1:  # the words are one container, keyed by themselves
            self.single.setdefault(lang, Counter()).update(tokens)
            return
        words, size = self.numbers(lang), self.size
        ids = np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens))
        many = len(ids) - size + 1
        if many < 1:
            return
        fine = ids[:many] > 0
        for i in range(1, size):
            fine &= ids[i:many + i] > 0
        if self.parts is not None:
            held = self.parts.has(joined(words.hashes[ids], size - 1))
            fine &= held[:many] & held[1:many + 1]
        at = np.flatnonzero(fine)
        if not len(at):
            return
        base, key, width = len(words.names), ids[at], len(words.names)
        for i in range(1, size):
            if width > (1 << 62) // base:
                known, key = np.unique(key, return_inverse=True)
                width = len(known)
            key, width = key * base + ids[at + i], width * base
        _, first, counts = np.unique(key, return_index=True, return_counts=True)
        columns = [ids[at[first] + i] for i in range(size)]
        order = np.argsort(columns[0], kind="stable")
        columns, counts = [c[order] for c in columns], (counts[order] * times).tolist()
        rests = columns[1].tolist() if size == 2 else list(zip(
            *(c.tolist() for c in columns[1:]), strict=True))
        starts = np.flatnonzero(np.diff(columns[0], prepend=-1)).tolist()
        add, heads = self.tries[lang].add, columns[0].tolist()
        for start, end in zip(starts, [*starts[1:], len(heads)], strict=True):
            add(heads[start], rests[start:end], counts[start:end])

    def spill(self, most: int) -> Iterator[pa.RecordBatch]:
        """Sorted runs of whole subtrees until ``most`` entries are left over all languages."""
        for lang, counts in self.single.items():
            counts.pop(BREAK, None)
            yield from batches_of(lang, sorted(counts.items()))
        self.single = {}
        share = most // max(1, len(self.tries))
        for lang, trie in self.tries.items():
            names, run = self.words[lang].names, []
            for first, taken in sorted(trie.spill(share), key=lambda x: names[x[0]]):
                lead = names[first] + b" "
                if type(taken[0][0]) is int:
                    run += sorted([(lead + names[rest], n) for rest, n in taken])
                else:
                    run += sorted([(lead + b" ".join([names[i] for i in rest]), n)
                                   for rest, n in taken])
                if len(run) >= RUN:  # many subtrees are small
                    yield from batches_of(lang, run)
                    run = []
            yield from batches_of(lang, run)

    def overflow(self) -> Iterator[pa.RecordBatch]:
        """What has to go to keep within bounds, if anything; call between texts."""
        if sum(map(len, self.words.values())) > WORDS:
            yield from self.spill(0)
            self.words, self.tries = {}, {}
        elif sum(map(len, self.single.values())) + sum(
                trie.held for trie in self.tries.values()) > self.held:
            yield from self.spill(self.held // 2)


def batches_of(lang: str, run: list[tuple[bytes, int]]) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(run), RUN):
        phrases, counts = zip(*run[start:start + RUN], strict=True)
        ends = np.cumsum([0, *map(len, phrases)], dtype=np.int64)
        text = pa.Array.from_buffers(pa.large_string(), len(phrases), [
            None, pa.py_buffer(ends.tobytes()), pa.py_buffer(b"".join(phrases))])
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(phrases)), text.cast(pa.string()),
             pa.array(counts, pa.int64())], ["lang", "phrase", "n"])


def token_blocks(batches: Iterator[pa.RecordBatch], block: int,
                 ) -> Iterator[tuple[str, int, list[bytes], bool]]:
    """Language, times, tokens, and whether these go on in the same text as the ones before."""
    waiting: dict[tuple[str, int], list[bytes]] = {}
    weight = 0
    for batch in batches:
        for lang, text, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = text.encode().lower().translate(PIECES).replace(BREAK, b" \xff ")
            if len(data) > block:
                for i, tokens in enumerate(word_blocks(data, block)):
                    yield lang, times, tokens, i > 0
                continue
            waiting.setdefault((lang, times), []).append(data)
            weight += len(data)
            if weight > block:
                for (one, n), texts in waiting.items():
                    yield one, n, b" \xff ".join(texts).split(), False
                waiting, weight = {}, 0
    for (one, n), texts in waiting.items():
        yield one, n, b" \xff ".join(texts).split(), False


def phrase_runs(docs: DataFrame, size: int, allowed: BitFilter | None, parts: BitFilter | None,
                held: int = HELD, burst: int = BURST, block: int = BLOCK) -> DataFrame:
    """``lang, phrase, n``: every task's sorted runs of phrases of ``size`` words.

    ``docs`` has ``lang, text, times``: a text's phrases count ``times`` their number.
    """
    sent = docs.sparkSession.sparkContext.broadcast((allowed, parts))  # 2 ** MAX_BITS bits each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PhraseCounter(size, *sent.value, held, burst)
        tail: list[bytes] = []
        for lang, times, tokens, goes_on in token_blocks(batches, block):
            tokens = tail + tokens if goes_on else tokens
            counter.count(lang, tokens, times)
            tail = tokens[max(0, len(tokens) - size + 1):]
            yield from counter.overflow()
        yield from counter.spill(0)

    return docs.select("lang", "text", "times").mapInArrow(
        run, "lang string, phrase string, n long")


def stretches(counter: PhraseCounter, lang: str, tokens: list[bytes]) -> bytes:
    """The longest stretches of three words or more whose pairs of words all pass, as lines."""
    words = counter.numbers(lang)
    ids = np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens))
    if len(ids) < 3:
        return b""
    pair = counter.parts.has(joined(words.hashes[ids], 2)) & (ids[1:] > 0) & (ids[:-1] > 0)
    turns = np.flatnonzero(np.diff(pair, prepend=False, append=False))
    return b"\n".join(b" ".join(tokens[a:b + 1]) for a, b in zip(
        turns[::2].tolist(), turns[1::2].tolist(), strict=True) if b - a > 1)


def cut_down(docs: DataFrame, allowed: BitFilter, pairs: BitFilter, longest: int,
             block: int = BLOCK) -> DataFrame:
    """``docs`` without what no frequent phrase of three words or more can hold.

    A text that is cut into blocks repeats the ``longest - 1`` words before a cut in the next
    block; what these hold on their own is taken off again by a row with ``times`` negated.
    """
    sent = docs.sparkSession.sparkContext.broadcast((allowed, pairs))  # 2 ** MAX_BITS bits each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PhraseCounter(2, *sent.value)
        tail: list[bytes] = []
        for lang, times, tokens, goes_on in token_blocks(batches, block):
            rows = [(stretches(counter, lang, tail + tokens if goes_on else tokens), times)]
            if goes_on:
                rows.append((stretches(counter, lang, tail), -times))
            tail = (tail + tokens if goes_on else tokens)[-(longest - 1):]
            rows = [r for r in rows if r[0]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(rows), pa.string()),
                 pa.array([r[0] for r in rows], pa.binary()).cast(pa.string()),
                 pa.array([r[1] for r in rows], pa.int32())], ["lang", "text", "times"])
            for _ in counter.overflow():
                pass  # only words are held here

    return docs.select("lang", "text", "times").mapInArrow(
        run, "lang string, text string, times int")


def merged(runs: DataFrame) -> DataFrame:
    """Equal phrases of all runs added up; no prefix is gathered whole in one partition."""
    return runs.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def bit_filter(frequent: DataFrame, rows: int, max_bits: int = MAX_BITS) -> BitFilter:
    """Filter of the phrases of ``frequent``; about 16 bits for each, at most 2 ** max_bits."""
    power = min(max(16, (16 * max(1, rows) - 1).bit_length()), max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.array([
                joined(np.array([word_hash(w, lang) for w in words], np.uint64), len(words))[0]
                for lang, words in ((lang, phrase.encode().split(b" ")) for lang, phrase in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True))], np.uint64)
            slots, bits = places(hashes, power)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots), pa.array(bits.view(np.int64))], ["slot", "bits"])

    table = frequent.select("lang", "phrase").mapInArrow(run, "slot long, bits long").groupBy(
        "slot").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most 2 ** power / 64 rows
    return BitFilter(power, table["slot"].to_numpy(), table["bits"].to_numpy().view(np.uint64))


def frequent_phrases(docs: DataFrame, min_count: int, longest: int, held: int = HELD,
                     burst: int = BURST, block: int = BLOCK, max_bits: int = MAX_BITS,
                     ) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, size, n`` of all phrases found ``min_count`` times, and ``lang, total``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANG))
    docs = docs.select(lang.alias("lang"), text.alias("text"), F.lit(1).alias("times")).where(
        "text <> ''")
    allowed = parts = totals = left = None
    levels: list[DataFrame] = []
    for size in range(1, longest + 1):
        counted = merged(phrase_runs(docs, size, allowed, parts, held, burst, block))
        if size == 1:
            counted = every = materialise(counted)
            totals = materialise(every.groupBy("lang").agg(F.sum("n").alias("total")))
        level = materialise(counted.where(F.col("n") >= min_count).select(
            "lang", "phrase", F.lit(size).alias("size"), "n"))
        if size == 1:
            discard(every)
        levels.append(level)
        rows = level.count()
        if not rows:
            break
        if size < longest:
            parts = bit_filter(level, rows, max_bits)
            if size == 1:
                allowed, parts = parts, None
            elif size == 2:
                docs = left = materialise(cut_down(docs, allowed, parts, longest, block))
    found = materialise(reduce(DataFrame.union, levels))
    discard(*levels, *([left] if left is not None else []))
    return found, totals


def weakest_cuts(found: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, phrase, size, a, l, r, n, score`` of the phrases of two words and more."""
    words = F.split("phrase", " ")
    counts = found.select("lang", "phrase", "n")
    cuts = found.where("size > 1").select(
        "lang", "phrase", "size", F.col("n").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), words.alias("w"))
    cuts = cuts.select("lang", "phrase", "size", "a", "k",
                       F.array_join(F.slice("w", 1, F.col("k")), " ").alias("first"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ")
                       .alias("rest"))
    firsts = counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    cuts = cuts.join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"]).join(totals, "lang")
    top = (F.col("a").cast("decimal(18,0)") * F.col("total").cast("decimal(16,0)")
           * F.lit(1000).cast("decimal(4,0)"))
    below = F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)")
    cuts = cuts.select("*", top.alias("_top"), below.alias("_below")).withColumn(
        "score", F.expr("_top div _below"))
    return cuts.groupBy("lang", "phrase", "size", "a", F.col("total").alias("n")).agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "size", "a", "cut.l", "cut.r", "n", "cut.score")


def without_parts(phrases: DataFrame) -> DataFrame:
    """Phrases that no longer one holds as often (columns ``lang, phrase, size, a``)."""
    words = F.split("phrase", " ")
    longer = phrases.where("size > 2").select("lang", "size", "a", words.alias("w"), F.explode(
        F.expr("flatten(transform(sequence(2, size - 1), m -> transform("
               "sequence(1, size - m + 1), i -> struct(i, m))))")).alias("part"))
    longer = longer.select("lang", "a", F.array_join(F.expr("slice(w, part.i, part.m)"), " ").alias(
        "phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    return phrases.join(longer, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (F.col("most") < F.col("a"))).drop("most")


def collocations(docs: DataFrame, min_count: int = 100, longest: int = 5, best: int = 2000,
                 held: int = HELD, burst: int = BURST, block: int = BLOCK,
                 max_bits: int = MAX_BITS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``best`` collocations.

    Texts are lower-cased (A-Z) and cut at ``.,;:!?`` and line ends into pieces, pieces at spaces
    and tabs into words; ``a``, ``l`` and ``r`` count the phrase and both parts of its weakest cut
    within pieces, ``n`` the language's words. Candidates have 2 to ``longest`` words and ``a >=
    min_count``; those inside of a longer candidate of the same count are left out. Ties in score
    go by ``a``, then by phrase. Null texts count as empty, a null ``lang`` as ``und``; empty texts
    and tables give no row; every row of repeated rows counts. Only ``lang`` and ``text`` are read.
    ``held``, ``burst``, ``block`` and ``max_bits`` bound memory and never change the result.
    """
    found, totals = frequent_phrases(docs, max(1, min_count), longest, held, burst, block, max_bits)
    kept = without_parts(weakest_cuts(found, totals))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(
        F.desc("score"), F.desc("a"), "phrase"))
    return kept.withColumn("rank", rank).where(F.col("rank") <= best).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

