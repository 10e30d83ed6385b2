"""Operator 9: secret scan with a random forest that removes false positives.

Candidates are runs of at least 16 key characters, with or without digits (so
all known shapes are among them), the value of any characters, from 4 on, that
a key word and an assignment precede, and the password in the user part of a
URL. Each gets its length, character classes and transitions, the share
covered by a small dictionary, signs of a path, and what its neighbouring words
say. A random forest, trained from the labelled findings of ``secret_labels``,
scores them; findings below the threshold are dropped.

Only DataFrame functions and Spark's own forest are used: the scan is one pass
without a shuffle, and no text leaves the JVM.

Defined cases: null and empty texts have no findings; a word with several
candidates gives one finding for each; repeated rows and null ids are scanned
like others; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import only, read_table
from vigil.llm.secret_labels import findings

CANDIDATE = r"[A-Za-z0-9+/_=.~-]{16,}"
KEY = r"(?:token|secret|passw|passwd|passphrase|pass|pwd|api[-_]?key|apikey|access[-_]?key|private[-_]?key|auth|bearer|credential)[\w.-]*[\"'\]]*"
ASSIGN = r" ?(?:=>|:=|=|:) ?(?:(?:bearer|basic) )?"
#: A value after a key word, at the end of some words: in double quotes, in single quotes, or bare; the password of a URL; and what a text with either holds.
KEYED = rf"(?i){KEY}{ASSIGN}(?:\"([^\s\"]{{4,}})\"\S*|'([^\s']{{4,}})'\S*|[\"']?([^\s\"'][^\s]{{2,}}[^\s\"',;.)\]}}])[\"',;.)\]}}]*)$"
IN_URL = r"[A-Za-z][A-Za-z0-9+.-]*://[^\s/:@]*:([^\s/]+)@"
EITHER = rf"(?i){KEY}\s?(?:=>|:=|=|:)|{IN_URL}"
THRESHOLD = 0.5
BEFORE = 3
#: The dictionary, and words that speak for or against a credential nearby.
DICTIONARY = (
    "password|example|default|version|release|account|private|session|content|article|download|placeholder|change|secret|sample|report|summer|client|access|search|index|token|image|"
    "value|final|table|style|admin|login|email|test|user|data|file|name|page|html|http|news|here|your|this|with|that|from|key|api|url|www|com|org|net|the|and|for|xxx|abc|123"
)
FOR_WORDS = r"(?i)(token|secret|passw|passwd|pwd|api[-_]?key|apikey|access[-_]?key|private[-_]?key|auth|bearer|credential)"
AGAINST_WORDS = r"(?i)(^|[^a-z])(commit|sha\d*|md5|hash|checksum|digest|uuid|guid|revision|build|card|phone|tel|order|isbn|account|version|id|file|image|see|example|sample|placeholder)([^a-z]|$)"
FEATURES = ["f_length", "f_transitions", "f_digits", "f_upper", "f_lower", "f_symbols", "f_distinct", "f_hex", "f_dictionary", "f_slashes", "f_extension", "f_parts",
            "f_for", "f_against", "f_assigned", "f_quoted", "f_known", "f_keyed", "f_url", "f_code"]


def featured(df: DataFrame) -> DataFrame:
    """Adds ``FEATURES`` to a table with the texts before, candidate and after."""
    c, n = F.col("candidate"), F.length("candidate")
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    classes = F.translate(c, lower + upper + digits, "a" * 26 + "A" * 26 + "0" * 10)
    classes = F.regexp_replace(classes, "[^aA0]", "+")
    share = lambda mark: F.length(F.regexp_replace(F.col("__classes"), f"[^{mark}]", "")) / n
    flag = lambda test: F.when(test, 1.0).otherwise(0.0)
    made = {
        "f_length": F.log(n.cast("double")),
        "f_transitions": (F.length(F.regexp_replace(F.col("__classes"), r"(.)\1+", "$1")) - 1) / n,
        "f_digits": share("0"), "f_upper": share("A"), "f_lower": share("a"), "f_symbols": share("+"),
        "f_distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
        "f_hex": flag(c.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "f_dictionary": F.lit(1.0) - F.length(F.regexp_replace(F.lower(c), DICTIONARY, "")) / n,
        "f_slashes": F.length(F.regexp_replace(c, "[^/]", "")) / n,
        "f_extension": flag(c.rlike(r"\.[a-z]{2,4}$")),
        "f_parts": F.size(F.split(c, "[-_./]")).cast("double"),
        "f_for": flag(F.col("before").rlike(FOR_WORDS)),
        "f_against": flag(F.concat_ws(" ", "before", "after").rlike(AGAINST_WORDS)),
        "f_assigned": flag(F.col("before").rlike("[=:][\"'\\s]*$")),
        "f_quoted": flag(F.col("before").rlike("[\"']$")),
        "f_known": flag(c.rlike("^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36})$")),
        "f_keyed": flag(F.col("before").rlike(rf"(?i){KEY}{ASSIGN}[\"']?$")),
        "f_url": flag(F.col("before").rlike(r"://[^\s/:@]*:$")),
        "f_code": flag(c.rlike(r"^[$<{%(\[]|[()\[\]{}<>]")),
    }
    return df.withColumn("__classes", classes).withColumns(made).drop("__classes")


def train(spark: SparkSession, labelled: list[tuple[str, str, str, int]] | None = None, trees: int = 40, depth: int = 7) -> RandomForestClassificationModel:
    """A forest from labelled findings (before, candidate, after, label)."""
    rows = findings() if labelled is None else labelled
    df = featured(spark.createDataFrame(rows, "before string, candidate string, after string, label int").coalesce(1))
    table = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=5, maxBins=64).fit(table)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, word_at (from 0), before, candidate, after of every candidate."""
    words = F.split(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+")
    df = only(docs, doc_id=id_col, text=text_col).where(F.col("text").rlike(CANDIDATE) | F.col("text").rlike(EITHER))
    df = df.select("doc_id", words.alias("ws"), F.col("text").rlike(EITHER).alias("either"))

    def left(i, n):
        return F.concat_ws(" ", F.slice("ws", F.greatest(i - n, F.lit(0)) + 1, F.least(i, F.lit(n))))

    def special(w, i):  # the value after a key word, or the password in a URL, or the empty text
        own = F.concat_ws(" ", left(i, BEFORE), w)
        value = F.concat(*[F.regexp_extract(own, KEYED, k) for k in (1, 2, 3)])
        url = F.regexp_extract(w, IN_URL, 1)
        return F.when(~F.col("either") | (F.length(w) < 4), "").when(url != "", url).otherwise(value)

    numbered = F.transform("ws", lambda w, i: F.struct(w.alias("w"), i.alias("i"), special(w, i).alias("value")))
    held = F.filter(numbered, lambda s: (s["value"] != "") | (F.length(s["w"]) >= 16) & s["w"].rlike(CANDIDATE))
    near = F.transform(held, lambda s: F.struct(
        s["i"].alias("word_at"), s["w"].alias("w"), s["value"].alias("value"), left(s["i"], BEFORE).alias("left"),
        F.concat_ws(" ", F.slice("ws", s["i"] + 2, 2)).alias("after")))
    runs = F.regexp_extract_all("w", F.lit(CANDIDATE), F.lit(0))
    apart = F.filter(runs, lambda r: (F.col("value") == "") | ~(F.contains(r, F.col("value")) | F.contains(F.col("value"), r)))
    each = df.select("doc_id", "ws", "either", F.inline(near)).select(
        "doc_id", "word_at", "w", "left", "after", F.explode(F.concat(F.when(F.col("value") != "", F.array("value")).otherwise(F.array().cast("array<string>")), apart)).alias("candidate"))
    return each.select("doc_id", "word_at", F.concat_ws(" ", "left", F.expr("substring_index(w, candidate, 1)")).alias("before"), "candidate", "after")


def scan(docs: DataFrame, model: RandomForestClassificationModel, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, word_at, candidate, score of the findings that the forest leaves."""
    table = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(featured(candidates(docs, id_col, text_col)))
    scored = model.transform(table).withColumn("score", vector_to_array("probability")[1])
    return scored.where(F.col("score") >= threshold).select("doc_id", "word_at", "candidate", "score")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the secrets found in all ``documents``, each as place, length, checksum and score."""
    found = scan(read_table(spark, sf_dir, "documents"), train(spark))
    return found.select("doc_id", "word_at", F.length("candidate").alias("n_chars"), F.sha2("candidate", 256).alias("secret_sha256"), F.round("score", 6).alias("score"))
