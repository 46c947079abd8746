"""Secret scan with a random forest that removes false positives, in DataFrame functions and Spark's own forest.

Candidates are long runs of key characters. Each gets features of its length,
its character transitions, how much of it dictionary words cover, its path and
the words beside it: of the text, whatever other candidates lie there, as a
long variable name is one itself. The forest learns from labelled findings and scores every
candidate of every document.

The dictionary is the corpus's own: words of letters outside candidates that a
share of the distinct texts has, counted over all documents. Labelled findings may be given; else clear
cases are labelled by rule (``rule_labels``), and the forest decides the rest.
The forest is fitted on at most ``FIT_ROWS`` of them, those with the least hash
of each label: a bound on the fit only, all candidates are scored.

Cases: null and empty texts have no candidates; a null path counts as empty;
repeated rows each have their findings; if the labels are all alike there is
nothing to learn and the rule's own label stands; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthlake.llm.common import stored

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}"
BESIDE = 40
DICTIONARY_SHARE = 0.002
FIT_ROWS = 20_000
TREES, DEPTH, SEED = 24, 6, 11
ACCEPT = 0.5
# fixed values: words that speak for and against a secret beside a candidate or in its path
CUES = "token|secret|passw(?:or)?d|passwd|pwd|api.?key|key|auth|bearer|credential|private|access"
AGAINST = "sha|sha1|sha256|commit|hash|md5|checksum|digest|integrity|uuid|guid|version|example|sample|dummy"
PATH_FOR = r"env|config|settings|secret|credential|deploy"
PATH_AGAINST = r"test|example|sample|mock|fixture|docs?|lock|readme"
CLASSES = {"a": "[a-z]", "A": "[A-Z]", "0": "[0-9]", "-": "[^a-zA-Z0-9]"}
FEATURES = [
    "length", "digits", "upper", "symbols", "distinct", "vowels", "hexadecimal", "changes", "letter_digit", "case_change",
    "covered", "assigned", "cue", "against", "quoted", "number_beside", "path_for", "path_against", "path_depth"]


def findings(docs: DataFrame, path: str = "source") -> DataFrame:
    """doc_id, path, start, end (code points), value, left, right of every candidate."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
        text.alias("text")).where(F.col("text").rlike(CANDIDATE))
    cut = rows.select(
        "doc_id", "path", F.split("text", CANDIDATE, -1).alias("gaps"),
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("values"))
    gaps, values = F.col("gaps"), F.col("values")
    placed = F.aggregate(
        F.zip_with(gaps, values, lambda g, v: F.struct(F.length(g).alias("g"), F.length(v).alias("v"))),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda done, n: F.struct(
            (done["at"] + n["g"] + F.coalesce(n["v"], F.lit(0))).alias("at"),
            F.concat(done["starts"], F.array(done["at"] + n["g"])).alias("starts")),
        lambda done: done["starts"])
    # a value has 16 characters or more, so three of them and what lies between reach further than BESIDE
    def near(of: Column, at: Column, cut_to: Callable[[Column, Column], Column]) -> Column:
        return cut_to(F.get(of, at), F.lit(BESIDE))

    def before(i: Column) -> Column:
        return F.right(F.concat_ws("", *(
            near(of, i - k, F.right) for k in (3, 2, 1, 0) for of in ((gaps, values) if k else (gaps,)))), F.lit(BESIDE))

    def after(i: Column) -> Column:
        return F.left(F.concat_ws("", *(near(of, i + k, F.left) for k in (1, 2, 3) for of in (gaps, values))), F.lit(BESIDE))

    each = F.transform(
        F.arrays_zip(values.alias("value"), F.slice(placed, F.lit(1), F.size(values)).alias("start")),
        lambda z, i: F.struct(z["value"], z["start"], before(i).alias("left"), after(i).alias("right")))
    return (
        cut.select("doc_id", "path", F.explode(F.slice(each, F.lit(1), F.size(values))).alias("f"))
        .select("doc_id", "path", F.col("f.start").alias("start"), (F.col("f.start") + F.length("f.value")).alias("end"),
                F.col("f.value").alias("value"), F.col("f.left").alias("left"), F.col("f.right").alias("right")))


def dictionary(docs: DataFrame, share: float = DICTIONARY_SHARE) -> DataFrame:
    """Lower-case words of three letters or more that at least such a share of the distinct texts has, two at least.

    Candidates don't count: a secret in many texts makes no words of its own pieces.
    """
    text = F.col("text").cast("string")
    plain = F.lower(F.regexp_replace(text, CANDIDATE, " "))
    words = F.array_distinct(F.regexp_extract_all(plain, F.lit(r"\p{L}{3,}+"), F.lit(0)))
    # texts that differ in their candidates or spaces only are copies here
    texts = docs.where(text.isNotNull()).select(F.array_sort(words).alias("words"))
    texts = stored(texts.groupBy(F.xxhash64("words").alias("key")).agg(F.first("words").alias("words")), "words")
    counted = texts.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= max(2, math.ceil(share * texts.count()))).select("word")


def _share(of: Column, pattern: str, by: Column) -> Column:
    return F.regexp_count(of, F.lit(pattern)) / by


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """The findings with the columns of ``FEATURES`` as doubles, and ``finding``, a number of each row."""
    found = stored(found.withColumn("finding", F.monotonically_increasing_id()), "findings")
    # words inside a candidate: runs of letters, cut where a capital follows a small letter
    pieces = F.regexp_extract_all(F.lower(F.regexp_replace("value", "([a-z])([A-Z])", "$1 $2")), F.lit("[a-z]{3,}"), F.lit(0))
    known = (
        found.select("finding", F.explode(pieces).alias("word")).join(words, "word")
        .groupBy("finding").agg(F.sum(F.length("word")).alias("letters")))
    value, n = F.col("value"), F.length("value").cast("double")
    shape = reduce(lambda s, c: F.regexp_replace(s, CLASSES[c], c), ["a", "A", "0"], F.regexp_replace(value, CLASSES["-"], "-"))
    joined = found.join(known, "finding", "left").withColumn("shape", shape)
    left, right, path = F.lower("left"), F.col("right"), F.lower("path")

    def flag(condition: Column) -> Column:
        return condition.cast("double")

    features = {
        "length": n, "digits": _share(value, "[0-9]", n), "upper": _share(value, "[A-Z]", n),
        "symbols": _share(value, "[^A-Za-z0-9]", n), "distinct": F.size(F.array_distinct(F.split(value, ""))) / n,
        "vowels": _share(F.lower(value), "[aeiou]", n), "hexadecimal": flag(value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")),
        # a place where the class of the next character is another one
        "changes": _share(F.col("shape"), r"(.)(?!\1)(?=.)", n),
        "letter_digit": _share(F.col("shape"), "[aA](?=0)|0(?=[aA])", n),
        "case_change": _share(F.col("shape"), "a(?=A)|A(?=a)", n),
        "covered": F.coalesce(F.col("letters"), F.lit(0)) / n,
        "assigned": flag(F.col("left").rlike(r"[=:]\s*[\"']?$")),
        "cue": flag(left.rlike(rf"(?:{CUES})(?:_[a-z0-9_]*)?[^a-z0-9]*$")), "against": flag(left.rlike(rf"(?:^|[^a-z])(?:{AGAINST})[^a-z0-9]*$")),
        "quoted": flag(F.col("left").rlike("[\"']$") & right.rlike("^[\"']")),
        "number_beside": flag(left.rlike(r"[0-9]\s*$") | right.rlike(r"^\s*[0-9]")),
        "path_for": flag(path.rlike(PATH_FOR)), "path_against": flag(path.rlike(PATH_AGAINST)),
        "path_depth": _share(path, "[/.]", F.lit(1.0)),
    }
    return joined.select(*found.columns, *(features[name].cast("double").alias(name) for name in FEATURES))


def rule_labels() -> Column:
    """1 for findings that are clearly secrets, 0 for clear false ones, null for the rest."""
    c = F.col
    random = (c("distinct") * c("length") >= 8) & (c("digits") > 0) & (c("covered") < 0.5)
    secret = (c("cue") == 1) & (c("assigned") == 1) & random & (c("length") >= 20)
    false = ((c("cue") == 0) & (c("assigned") == 0)) | (c("against") == 1) | (c("covered") >= 0.8) | (c("digits") == 1)
    return F.when(secret & (c("against") == 0), 1.0).when(false, 0.0)


def scored(features: DataFrame, labelled: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows with ``score``, the forest's share of votes for a secret; ``labelled`` has FEATURES and ``label``."""
    order = F.xxhash64(*FEATURES)
    sample = [
        labelled.where(F.col("label") == label).orderBy(order, *FEATURES).limit(fit_rows // 2).select("label", *FEATURES)
        for label in (0.0, 1.0)]
    sample = stored(sample[0].unionByName(sample[1]).coalesce(1), "labelled")
    if sample.select("label").distinct().count() < 2:
        return features.withColumn("score", F.coalesce(rule_labels(), F.lit(0.0)))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="__features")
    forest = RandomForestClassifier(
        featuresCol="__features", labelCol="label", probabilityCol="__share", rawPredictionCol="__votes",
        predictionCol="__verdict", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    model = forest.fit(assembler.transform(sample))
    voted = model.transform(assembler.transform(features))
    return voted.withColumn("score", F.get(vector_to_array("__share"), F.lit(1))).select(*features.columns, "score")


def secrets(docs: DataFrame, labelled: DataFrame | None = None, path: str = "source") -> DataFrame:
    """Per candidate: doc_id, start, end, value, score, is_secret."""
    features = stored(with_features(findings(docs, path), dictionary(docs)), "features")
    known = labelled if labelled is not None else features.withColumn("label", rule_labels()).where("label IS NOT NULL")
    return scored(features, known).select(
        "doc_id", "start", "end", "value", "score", (F.col("score") >= ACCEPT).alias("is_secret"))


def digest(found: DataFrame) -> DataFrame:
    """The verdicts with a digest in place of the value."""
    return found.select("doc_id", "start", "end", F.sha2("value", 256).alias("value_sha256"), F.round("score", 6).alias("score"), "is_secret")
