"""Secret scans: candidates by pattern, false positives removed by a random forest.

With DataFrame functions and Spark's own forest only. The forest sees a candidate's length, the
changes between its kinds of characters, the part that dictionary words cover, whether it stands
in a path, and the words beside it. It learns from labelled findings: the caller's, or those that
rules label beyond doubt; all others, and these too, are judged by the forest.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.storage import materialise

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: A run of 16 or more token characters with a digit, a quoted password, a private key's heading.
CANDIDATE = (
    r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
    r"|(?<=(?:[Pp]assw(?:or)?d|PASSW(?:OR)?D|[Pp]wd|[Ss]ecret)\s{0,2}[:=]\s{0,2}[\"'])[^\"'\s]{6,}+"
    r"|(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])[A-Za-z0-9_+/=-]{16,}+")
CREDENTIAL_WORD = (r"(?i)(?:^|[^a-z])(?:api[ _-]?key|access[ _-]?key|key|secret|token|passw(?:or)?d"
                   r"|pwd|auth|authorization|bearer|credentials?)[^a-z]{0,8}$")
#: Beginnings that issuers document for their keys.
ISSUED = r"^(?:AKIA|ASIA|ghp_|gho_|ghu_|ghs_|ghr_|github_pat_|glpat-|xox[abprs]-|sk_live_|rk_live_|sk-|AIza|eyJ|-----BEGIN )"
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|your[_-]|changeme|x{6,}|0{8,}|1234567"
FEATURES = ["length", "changes", "letters_in_words", "in_path", "slashes", "credential_word",
            "assigned", "quoted", "digits", "capitals", "hexadecimal", "variety", "word_before"]


class ForestRule(NamedTuple):
    each: int = 10_000  #: labelled findings of each class that the forest learns from at most
    trees: int = 50
    depth: int = 6
    words: int = 5_000  #: dictionary words at most
    threshold: float = 0.5  #: a finding of at least this probability is a secret


def candidates(docs: DataFrame) -> DataFrame:
    """Findings of each text: ``doc_id, text_key, place, start, value, before, after``.

    ``start`` counts code points from 0; ``before`` and ``after`` are up to 60 and 20 of them.
    """
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_key"),
                       F.monotonically_increasing_id().alias("row"),
                       F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("found"),
                       text.alias("text")).where(F.size("found") > 0)
    rows = rows.withColumn("gaps", F.split("text", CANDIDATE, -1)).drop("text")
    one = F.transform("found", lambda value, i: F.struct(
        i.alias("place"), value.alias("value"), F.length(F.get("gaps", i)).alias("gap"),
        F.right(F.get("gaps", i), F.lit(60)).alias("before"),
        F.left(F.get("gaps", i + 1), F.lit(20)).alias("after")))
    rows = rows.select("doc_id", "text_key", "row", F.explode(one).alias("one")).select(
        "doc_id", "text_key", "row", "one.*")
    upto = Window.partitionBy("row").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("value")).over(upto)
    return rows.select("doc_id", "text_key", "place", (end - F.length("value")).alias("start"),
                       "value", "before", "after")


def dictionary(docs: DataFrame, words: int, least: int = 3) -> DataFrame:
    """The ``words`` lower-case words of 3 to 20 letters that most texts have, ``least`` at least."""
    found = F.array_distinct(F.filter(
        F.split(F.lower(F.col("text").cast("string")), r"[^\p{L}]+"),
        lambda w: F.length(w).between(3, 20)))
    counted = docs.select(F.explode(found).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return counted.orderBy(F.desc("n"), "word").limit(words).select("word")


def share(pattern: str) -> Column:
    """The part of the value's characters that match."""
    return F.length(F.regexp_replace("value", pattern, "")) / F.length("value")


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Findings with the forest's columns; ``words`` is bounded and sent to every task."""
    kinds = F.translate("value", LOWER + UPPER + DIGITS,
                        "a" * len(LOWER) + "A" * len(UPPER) + "0" * len(DIGITS))
    runs = F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,20}"), F.lit(0))
    pieces = found.select("value").distinct().select("value", F.explode(runs).alias("word"))
    covered = pieces.join(F.broadcast(words), "word").groupBy("value").agg(
        F.sum(F.length("word")).alias("covered"))
    return found.join(covered, "value", "left").withColumns({
        "length": F.least(F.length("value"), F.lit(1000)).cast("double"),
        "changes": (F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1) / F.length("value"),
        "letters_in_words": F.coalesce("covered", F.lit(0)) / F.length("value"),
        "in_path": F.col("before").rlike(r"(?:/|\\|www\.|://\S*)$").cast("double"),
        "slashes": share(r"[^/\\]+"),
        "credential_word": F.col("before").rlike(CREDENTIAL_WORD).cast("double"),
        "assigned": F.col("before").rlike(r"(?:[:=]|=>)\s*[\"'`]?$").cast("double"),
        "quoted": (F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")).cast("double"),
        "digits": share("[^0-9]+"), "capitals": share("[^A-Z]+"),
        "hexadecimal": F.col("value").rlike("^[0-9a-fA-F]+$").cast("double"),
        "variety": F.size(F.array_distinct(F.split("value", ""))) / F.length("value"),
        "word_before": F.length(F.regexp_extract("before", r"(\p{L}*)[^\p{L}]*$", 1)).cast(
            "double")}).drop("covered")


def rule_label() -> Column:
    """1 or 0 where rules leave no doubt, else null."""
    spoken = (F.col("credential_word") == 1) & (F.col("assigned") == 1)
    placeholder = F.col("value").rlike(PLACEHOLDER) | (F.col("variety") < 0.12)
    plain = (F.col("digits") == 1) | (F.col("letters_in_words") > 0.6)
    return F.when(placeholder, 0).when(F.col("value").rlike(ISSUED) | (spoken & ~plain), 1).when(
        (F.col("credential_word") == 0) & (F.col("assigned") == 0)
        & (plain | (F.col("in_path") == 1)), 0)


def scan_secrets(docs: DataFrame, labelled: DataFrame | None = None,
                 rule: ForestRule = ForestRule()) -> DataFrame:
    """Findings with ``score`` and ``is_secret``; columns as from ``candidates`` plus features.

    ``labelled`` has ``value, before, after, label`` of judged findings; by default the findings
    that ``rule_label`` decides are used. The forest learns from at most ``rule.each`` of each
    class, chosen by hash. Without findings of both classes the rules decide alone (undecided: not
    a secret). Null and empty texts have no findings; each of repeated rows has its own; an empty
    table gives none. Of ``docs`` only ``doc_id`` and ``text`` are read.
    """
    found = materialise(candidates(docs))
    words = materialise(dictionary(docs, rule.words))
    rows = materialise(with_features(found, words).withColumn("label", rule_label()))
    if labelled is None:
        known = rows.where(F.col("label").isNotNull())
    else:
        known = with_features(labelled.select("value", "before", "after", "label"), words)
    parts = [known.where(F.col("label") == c).orderBy(
        F.xxhash64("value", "before", "after"), "value").limit(rule.each).select("label", *FEATURES)
        for c in (0, 1)]
    sample = materialise(parts[0].union(parts[1]))
    columns = [c for c in rows.columns if c != "label"]
    if sample.agg(F.count_distinct("label")).first()[0] < 2:
        score = F.coalesce(F.col("label"), F.lit(0)).cast("double")
        return rows.withColumn("score", score).select(
            *columns, "score", (F.col("score") >= rule.threshold).alias("is_secret"))
    gather = VectorAssembler(inputCols=FEATURES, outputCol="_features")
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="label", probabilityCol="_probability",
        rawPredictionCol="_raw", predictionCol="_predicted", numTrees=rule.trees,
        maxDepth=rule.depth, seed=42)
    model = forest.fit(gather.transform(sample.withColumn("label", F.col("label").cast("double"))))
    judged = model.transform(gather.transform(rows.select(*columns)))
    return judged.select(*columns, vector_to_array("_probability")[1].alias("score")).select(
        *columns, "score", (F.col("score") >= rule.threshold).alias("is_secret"))


def redact(docs: DataFrame, findings: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every value that is a secret in its text replaced; all rows and columns stay.

    Findings belong to a text by ``text_key``, so null and repeated ``doc_id`` do no harm.
    """
    secret = findings.where("is_secret").groupBy("text_key").agg(
        F.sort_array(F.collect_set(F.struct(F.length("value").alias("n"), "value")), False).alias(
            "secrets"))
    text = F.col("text").cast("string")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(text).alias("text_key"))
    rows = rows.join(secret, "text_key", "left")
    clean = F.aggregate("secrets.value", F.col("row.text").cast("string"),
                        lambda t, value: F.replace(t, value, F.lit(mark)))
    new = F.coalesce(clean, F.col("row.text").cast("string"))
    return rows.select(*[new.alias(c) if c == "text" else F.col("row")[c].alias(c)
                         for c in docs.columns])
