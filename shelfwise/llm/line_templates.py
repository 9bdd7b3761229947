"""Line deduplication by a log-template tree.

A line descends a tree of fixed depth: by its number of tokens, then by its leading tokens, where
a token with a digit counts as a variable field. In the leaf it joins the template with which it
agrees in enough places, and the places in which they differ become variable too. A template that
recurs in documents which have nothing else in common is boilerplate, and its lines are dropped.

Copies of a document recur as a whole; dropping their lines would only hide them from the
deduplication of documents. Documents are therefore counted in groups. Beside a template, a
document's own lines are those whose templates are rare against it; a document that own lines make
up, by number or by tokens, has the longest of them as witnesses, and documents that share a
witness are one group. All other documents are one group more; equal texts count once.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.storage import materialise
from shelfwise.llm.batches import sliced
from shelfwise.llm.components import components

VARIABLE = "<*>"
SEED = 42
_digit = re.compile(r"\d").search


def masked_tokens(line: str) -> list[str]:
    """The line's tokens, those with a digit replaced by the variable field.

    Lines of one or two tokens have no variable field: they are matched as they stand.
    """
    tokens = line.split()
    if len(tokens) < 3 or not _digit(line):
        return tokens
    return [VARIABLE if _digit(t) else t for t in tokens]


def leaf_and_hash(tokens: list[str], depth: int) -> tuple[int, int]:
    """The tree's leaf for a line, and the line's own hash, as signed numbers."""
    leaf = xxhash.xxh64_intdigest("\0".join([str(len(tokens)), *tokens[:depth]]), SEED)
    own = xxhash.xxh64_intdigest(" ".join(tokens), SEED)
    return signed(leaf), signed(own)


class Leaf:
    """Templates of one leaf: a row of token numbers each, 0 where variable."""

    def __init__(self, width: int, similarity: float):
        self.numbers: dict[str, int] = {VARIABLE: 0}
        self.rows = np.zeros((8, width), np.int32)
        self.first: list[int] = []
        self.need = similarity * width

    def add(self, tokens: list[str], own: int) -> int:
        """Place of the template that the line joins or starts."""
        codes = np.empty(len(tokens), np.int32)
        for i, token in enumerate(tokens):
            codes[i] = self.numbers.setdefault(token, len(self.numbers))
        many = len(self.first)
        if many:
            agree = ((self.rows[:many] == codes) & (codes > 0)).sum(axis=1)
            best = int(agree.argmax())
            if agree[best] >= self.need:
                self.rows[best][self.rows[best] != codes] = 0
                return best
        if many == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[many] = codes
        self.first.append(own)
        return many


def signed(number: int) -> int:
    return number - (number >> 63 << 64)


def document_lines(docs: DataFrame, min_tokens: int, depth: int, texts: bool) -> DataFrame:
    """Lines of at least ``min_tokens``: with ``texts`` their masked text, else their document.

    ``raw`` is Spark's hash of the line as it stands.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            leaves, own, third, raws, sizes = [], [], [], [], []
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for line in (text or "").split("\n"):
                    tokens = masked_tokens(line)
                    if len(tokens) >= min_tokens:
                        leaf, mine = leaf_and_hash(tokens, depth)
                        leaves.append(leaf)
                        own.append(mine)
                        third.append(" ".join(tokens) if texts else key)
                        raws.append(signed(xxhash.xxh64_intdigest(line, SEED)))
                        sizes.append(len(tokens))
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaves, pa.int64()), pa.array(own, pa.int64()),
                 pa.array(third, pa.string() if texts else pa.int64()),
                 pa.array(raws, pa.int64()), pa.array(sizes, pa.int32())],
                ["leaf", "line", "masked" if texts else "doc_key", "raw", "tokens"])

    third = "masked string" if texts else "doc_key long"
    return docs.select("doc_key", "text").mapInArrow(
        run, f"leaf long, line long, {third}, raw long, tokens int")


def blocks(tokens: list[str], depth: int, similarity: float) -> list[int]:
    """Hashes of parts of a line, one of which it has in common with any line it can merge with.

    Beyond the leading tokens, which the leaf has in common, the places are cut into one part more
    than may differ, so one part at least agrees in full. A variable field agrees with nothing.
    """
    most = len(tokens) - math.ceil(similarity * len(tokens)) - tokens[:depth].count(VARIABLE)
    rest = tokens[depth:]
    if most < 0:
        return []
    if len(rest) <= most:  # the leading tokens are enough
        return [0]
    ends = [len(rest) * i // (most + 1) for i in range(most + 2)]
    parts = [rest[start:end] for start, end in zip(ends, ends[1:], strict=False)]
    return [signed(xxhash.xxh64_intdigest("\0".join([str(i), *part]), SEED))
            for i, part in enumerate(parts) if VARIABLE not in part]


def separate_parts(texts: DataFrame, depth: int, similarity: float) -> DataFrame:
    """``leaf, line, chunk``: the lines that have a block in common with another of their leaf.

    Lines of different chunks can't merge, as a template keeps only tokens of its first line. So
    the templates of a leaf are those of its chunks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            leaves, own, found = [], [], []
            for leaf, line, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for block in blocks(text.split(" "), depth, similarity):
                    leaves.append(leaf)
                    own.append(line)
                    found.append(block)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (leaves, own, found)], ["leaf", "line", "block"])

    shared = materialise(texts.select("leaf", "line", "masked").mapInArrow(
        run, "leaf long, line long, block long").withColumn("node", F.xxhash64("leaf", "line")))
    first = shared.groupBy("leaf", "block").agg(
        F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    edges = shared.join(first, ["leaf", "block"]).select("a", F.col("node").alias("b"))
    joined = components(edges.where("a <> b").distinct())
    return shared.select("leaf", "line", "node").distinct().join(joined, "node").select(
        "leaf", "line", F.col("root").alias("chunk"))


def merge_templates(lines: DataFrame, similarity: float) -> DataFrame:
    """``leaf, line, template``: the first line of each line's template.

    Lines (``leaf, chunk, line, masked``) meet those of their leaf and chunk in the order of their
    text. A task keeps the templates of one chunk at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, leaf = None, None
        for batch in batches:
            first = []
            for a, chunk, own, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = text.split(" ")
                if (a, chunk) != key:
                    key, leaf = (a, chunk), Leaf(len(tokens), similarity)
                first.append(leaf.first[leaf.add(tokens, own)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(first, pa.int64())],
                ["leaf", "line", "template"])

    return lines.repartition("leaf", "chunk").sortWithinPartitions(
        "leaf", "chunk", "masked", "line").select("leaf", "chunk", "line", "masked").mapInArrow(
        run, "leaf long, line long, template long")


def line_templates(docs: DataFrame, lines: DataFrame, often: DataFrame, min_tokens: int,
                   depth: int, similarity: float, chunk_lines: int) -> DataFrame:
    """``leaf, line, template`` of the lines in leaves that hold several lines.

    A leaf with more than ``chunk_lines`` lines is taken apart into chunks of lines that can merge;
    this decides only where lines meet, not their templates.
    """
    distinct = lines.join(often, "leaf").select("leaf", "line").distinct()
    mixed = materialise(distinct.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    texts = document_lines(docs, min_tokens, depth, True).join(mixed, "leaf")
    texts = texts.groupBy("leaf", "line", "n").agg(F.min("masked").alias("masked"))
    whole = F.lit(0).cast("long").alias("chunk")
    if not mixed.where(F.col("n") > chunk_lines).isEmpty():
        texts = materialise(texts)
        large = texts.where(F.col("n") > chunk_lines)
        apart = large.join(separate_parts(large, depth, similarity), ["leaf", "line"])
        texts = texts.where(F.col("n") <= chunk_lines).select("*", whole).unionByName(apart)
    else:
        texts = texts.select("*", whole)
    return materialise(merge_templates(texts, similarity))


def unrelated_groups(by_doc: DataFrame, spread: DataFrame, min_docs: int,
                     witnesses: int) -> DataFrame:
    """``template, groups`` of the templates that ``min_docs`` documents have.

    Beside a template of n documents, lines are own if fewer than ``min_docs`` or at most
    n / ``min_docs`` documents have theirs, so that they can't tie all of its documents together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found: list[tuple[int, int, list[int] | None]] = []
            for doc, lines in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lines = sorted((x["n"], -x["tokens"], x["template"]) for x in lines)
                others, words = len(lines) - 1, -sum(short for _, short, _ in lines)
                at, many, size, longest = 0, 0, 0, []
                for n, short, template in lines:
                    if n < min_docs:
                        continue
                    limit = max(min_docs - 1, n // min_docs)
                    while at < len(lines) and lines[at][0] <= limit:
                        many, size = many + 1, size - lines[at][1]
                        longest = sorted([*longest, lines[at][1:]])[:witnesses + 1]
                        at += 1
                    own, tokens = many - (n <= limit), size + short * (n <= limit)
                    apart = own and (2 * own >= others or 2 * tokens >= words + short)
                    found.append((template, doc, [t for _, t in longest if t != template][
                        :witnesses] if apart else None))
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.list_(pa.int64()))], ["template", "doc_key", "own"])

    lines = by_doc.join(spread, "template").groupBy("doc_key").agg(
        F.collect_list(F.struct("n", "tokens", "template")).alias("lines"))
    rows = materialise(lines.mapInArrow(
        run, "template long, doc_key long, own array<long>").select(
        "template", F.xxhash64("template", "doc_key").alias("node"), "own"))
    counted = rows.groupBy("template").agg(
        F.count("own").alias("apart"), F.max(F.col("own").isNull().cast("int")).alias("rest"))
    seen = rows.where(F.col("own").isNotNull()).select(
        "template", "node", F.explode("own").alias("witness"))
    shared = seen.groupBy("template", "witness").agg(
        F.min("node").alias("a"), F.count(F.lit(1)).alias("docs")).where("docs > 1").drop("docs")
    edges = materialise(seen.join(shared, ["template", "witness"]).select(
        "template", "a", F.col("node").alias("b")).where("a <> b").distinct())
    joined = components(edges.select("a", "b")).where("node <> root").select("node")
    lost = joined.join(rows.select("node", "template"), "node").groupBy("template").agg(
        F.count(F.lit(1)).alias("lost"))
    return counted.join(lost, "template", "left").select("template", (
        F.col("apart") - F.coalesce("lost", F.lit(0)) + F.col("rest")).alias("groups"))


def recurring_lines(docs: DataFrame, min_docs: int, min_tokens: int, depth: int,
                    similarity: float, chunk_lines: int, witnesses: int) -> DataFrame:
    """``doc_key, raw`` of every line whose template recurs in ``min_docs`` unrelated documents."""
    lines = materialise(document_lines(docs, min_tokens, depth, False).distinct())
    often = lines.select("leaf", "doc_key").distinct().groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("leaf")
    often = materialise(often)
    templates = line_templates(docs, lines, often, min_tokens, depth, similarity, chunk_lines)
    named = materialise(lines.join(templates, ["leaf", "line"], "left").select(
        "leaf", "doc_key", "raw", "tokens", F.coalesce("template", "line").alias("template")))
    by_doc = named.groupBy("doc_key", "template").agg(F.max("tokens").alias("tokens"))
    spread = materialise(by_doc.groupBy("template").agg(F.count(F.lit(1)).alias("n")))
    dropped = unrelated_groups(by_doc, spread, min_docs, witnesses).where(
        F.col("groups") >= min_docs).select("template")
    dropped = materialise(dropped)
    return named.join(dropped, "template").select("doc_key", "raw").distinct()


def drop_template_lines(docs: DataFrame, min_docs: int = 5, min_tokens: int = 1, depth: int = 3,
                        similarity: float = 0.8, chunk_lines: int = 4096,
                        witnesses: int = 3) -> DataFrame:
    """``docs`` without recurring template lines, every row and column kept in its order.

    Two columns are added: ``lines_before`` and ``lines_dropped`` (an existing column of such a
    name is replaced). Lines are divided by ``\\n``; those of fewer than ``min_tokens`` tokens,
    blank ones by default, are kept. A line is dropped if its template recurs in at least ``min_docs`` groups of documents
    that share none of their ``witnesses`` longest own lines; documents that aren't made up of own
    lines are one group. A null text stays null; a text that loses no line is
    returned unchanged, one that loses all becomes empty. Rows are told apart by their text, so
    null and repeated ``doc_id`` do no harm. An empty table gives no rows.
    """
    keyed = docs.select(F.xxhash64(F.col("text").cast("string")).alias("doc_key"),
                        F.col("text").cast("string").alias("text"))
    found = recurring_lines(keyed, min_docs, min_tokens, depth, similarity, chunk_lines, witnesses)
    drops = found.groupBy("doc_key").agg(F.collect_set("raw").alias("drops"))
    names = [c for c in docs.columns if c not in ("lines_before", "lines_dropped")]
    text = F.col("row.text").cast("string")
    rows = docs.select(F.struct(*names).alias("row"), F.xxhash64(
        F.col("text").cast("string")).alias("doc_key")).join(drops, "doc_key", "left")
    rows = rows.withColumn("lines", F.split(text, "\n"))
    kept = F.when(F.col("drops").isNull(), F.col("lines")).otherwise(F.filter(
        "lines", lambda line: ~F.array_contains("drops", F.xxhash64(line))))
    rows = rows.withColumn("kept", kept)
    size = lambda c: F.coalesce(F.size(F.col(c)), F.lit(0)).cast("long")
    before = F.when(F.col("lines").isNull(), F.lit(0)).otherwise(size("lines"))
    after = F.when(F.col("kept").isNull(), F.lit(0)).otherwise(size("kept"))
    clean = F.when(F.col("drops").isNull(), text).otherwise(F.array_join("kept", "\n"))
    return rows.select(*[clean.alias(c) if c == "text" else F.col("row")[c].alias(c)
                         for c in names],
                       before.cast("long").alias("lines_before"),
                       (before - after).cast("long").alias("lines_dropped"))
