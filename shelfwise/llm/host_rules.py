"""Quality rules by host, with DataFrame functions only.

Rule failures are counted by host; each host's failure rate is shrunk towards all hosts' by a beta
prior fitted to them; a host whose shrunk rate is high beyond doubt takes its documents with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.storage import materialise

WHITE_SPACE = " \t\n\x0b\x0c\r"
BLANKS = " " * len(WHITE_SPACE)
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def base_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``.

    Words are maximal runs of anything but space and tab to carriage return; a null text has none.
    ``host`` is ``source``. Windows are compared by 64-bit hashes, and only with the same text's.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.col("source").cast("string").alias("host"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"),
                     lambda x: F.trim(F.translate(x, WHITE_SPACE, BLANKS)) != "")
    rows = rows.withColumns({"flat": F.translate("text", WHITE_SPACE, BLANKS), "lines": lines})
    rows = rows.select(
        "doc_id", "host", F.filter(F.split("flat", " "), lambda w: w != "").alias("words"),
        F.length(F.replace("flat", F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias(
            "n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    starts = F.sequence(F.lit(1), F.size("words") - (WINDOW - 1))
    rows = rows.withColumn("hashes", F.when(F.col("n_words") >= WINDOW, F.transform(
        starts, lambda i: F.xxhash64(F.slice("words", i, WINDOW)))))
    again = F.size(F.array_distinct("hashes")) < F.size("hashes")
    rows = rows.withColumn("sorted", F.when(again, F.sort_array(F.transform(
        "hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def beside(pair: Column, i: Column) -> Column:
        def same(j: Column) -> Column:
            return F.coalesce(F.get("sorted", j)["h"] == pair["h"], F.lit(False))

        return same(i - 1) | same(i + 1)

    rows = rows.withColumn("places", F.sort_array(F.transform(
        F.filter("sorted", beside), lambda pair: pair["i"])))
    # of each repeated window's words, those that the one before it doesn't cover
    covered = F.aggregate(
        "places",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda s, p: F.struct(p.alias("last"), (
            s["n"] + F.least(F.lit(WINDOW), p - s["last"])).alias("n")),
        lambda s: s["n"])
    return rows.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def host_verdicts(counts: DataFrame, max_rate: float = 0.5, sureness: float = 2.0) -> DataFrame:
    """``host, n_docs, n_failed, shrunk_rate, host_failed`` of rows with ``host, base_failed``.

    The prior beta(a, b) has the hosts' mean rate and, by moments, the part of the rates' variance
    that sampling does not explain. A host fails if the posterior mean less ``sureness`` posterior
    standard deviations exceeds ``max_rate``. Rows without a host form no host.
    """
    hosts = materialise(counts.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")))
    rate = F.col("n_failed") / F.col("n_docs")
    fit = hosts.agg(F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"),
                    F.count(F.lit(1)).alias("k"), F.sum(rate * rate * F.col("n_docs")).alias("rr"))
    a, b = fit_prior(*fit.first())
    mean = (F.col("n_failed") + a) / (F.col("n_docs") + a + b)
    spread = F.sqrt(mean * (1 - mean) / (F.col("n_docs") + a + b + 1))
    return hosts.select("host", "n_docs", "n_failed", mean.alias("shrunk_rate"),
                        (mean - sureness * spread > max_rate).alias("host_failed"))


def fit_prior(n: int | None, failed: int | None, hosts: int, squares: float | None,
              ) -> tuple[float, float]:
    """a and b of the beta prior, by moments of the rates weighted by documents."""
    if not n:
        return 1.0, 1.0
    mean = min(max(failed / n, 0.5 / n), 1 - 0.5 / n)
    variance = max(squares / n - (failed / n) ** 2, 0.0)
    between = variance - mean * (1 - mean) * hosts / n
    strength = mean * (1 - mean) / between - 1 if between > 0 else 1e6
    strength = min(max(strength, 1.0), 1e6)
    return mean * strength, (1 - mean) * strength


def host_rules(docs: DataFrame, min_words: int = 20, max_repeat_percent: int = 30,
               max_rate: float = 0.5, sureness: float = 2.0) -> DataFrame:
    """One row per document: the base counts, ``base_failed``, the host's verdict and ``kept``.

    A document fails the base rules with fewer than ``min_words`` words or more than
    ``max_repeat_percent`` of them in repeated windows. It is kept if neither it nor its host
    fails. Rows with a null ``source`` are judged on their own; null texts have no words and fail;
    repeated rows each give a row; an empty table gives none. Only ``doc_id``, ``text`` and
    ``source`` are read.
    """
    counts = materialise(base_counts(docs).withColumn(
        "base_failed", (F.col("n_words") < min_words)
        | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))))
    verdicts = host_verdicts(counts, max_rate, sureness)
    failed = F.coalesce("host_failed", F.lit(False))
    return counts.join(verdicts, "host", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & ~failed).alias("kept"), "host", "n_docs",
        "n_failed", "shrunk_rate", failed.alias("host_failed"))
