"""Secrets in texts: candidates by pattern, false findings removed by a random forest.

All of it is DataFrame and SQL functions in the JVM. A candidate is a word with a digit, or with a credential keyword
and a sign of assignment, or one that follows both within the two words before, or an address with a user's password. A
word that holds assignments to keywords, issued keys or such a password gives each of these values as a candidate of its own
(parts of URLs and of JSON), any other word gives one. The forest sees length, composition, character transitions, dictionary coverage, the
path and the neighbouring words, and learns from labelled findings. Without findings that were looked at it learns the
shapes in `weak_label`, so it can't know more than their likes.

A null or empty text has no candidates; repeated rows have the same findings each; null paths form one of their own;
without labelled findings of both kinds every labelled-true or unlabelled candidate is kept as a secret; columns of
documents pass through `redacted` under their own names; an empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import hashed_sample, staged

KEYWORD = "passw|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth|bearer"
#: What stands between the colon and the @ of an address with a user.
USER_INFO = "://[^/\\s:@]*:([^/\\s@]{6,})@"
CANDIDATE = (
    f"(?<!\\S)(?:(?=[^\\s\\d]*+\\d)\\S{{8,}}|(?=\\S*?(?i:{KEYWORD}))\\S+?[=:]\\S{{6,}}|[\\w+.-]{{1,20}}{USER_INFO})"
)

#: A keyword at the front of a word or of a part of it, and what is assigned to it: up to a quote or the next assignment.
PART = (
    f"(?:^|[\"'`?&;,{{(\\[|#])(?i:[\\w.-]*(?:{KEYWORD})[\\w.-]*)[\"'`]?[=:]+[\"'`]*"
    "([^\"'`\\s<>{}]{6,}?)(?=[,;&?]+[\"'`]?[\\w.-]+[\"'`]?[=:]|[\"'`\\s<>{}]|[,;.)\\]]*$)"
)

#: A keyword and a sign of assignment with nothing assigned in the same word.
ASSIGNING = f"(?i:{KEYWORD})[^\\s=:]*\\s*[=:]+>?[\"'`]?(?:\\s|$)"

#: The same with the sign at the front of the assigned word.
OPENING = f"(?i:{KEYWORD})[^\\s=:]*\\s+[=:]+[\"'`]?\\S{{6,}}"

#: Formats of issued keys, with fixed prefixes that their issuers publish.
ISSUED = (
    "^(?:AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^sk_live_[A-Za-z0-9]{16,}$|^xox[abprs]-[A-Za-z0-9-]{10,}$"
    "|^AIza[A-Za-z0-9_-]{35}$|^glpat-[A-Za-z0-9_-]{20}$|^eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\."
)
#: The same inside of a word.
EMBEDDED = (
    "(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk_live_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}"
    "|AIza[A-Za-z0-9_-]{35}|glpat-[A-Za-z0-9_-]{20}|eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]*)(?![A-Za-z0-9_-])"
)

#: Shapes that hold digits and are no secrets: addresses, numbers, dates, phones, hosts, versions.
HARMLESS = (
    "^[0-9]+$|^[0-9]{1,3}(?:\\.[0-9]{1,3}){3}(?::[0-9]+)?$|@|^\\+?[(]?[0-9][0-9()./ -]*$|^https?:|^www\\."
    "|^v?[0-9]+(?:\\.[0-9]+)+$|^[0-9]{4}-[0-9]{2}-[0-9]{2}|^[\\p{L}'’-]+[0-9]{1,4}$"
)

FEATURES = [
    "length", "digit_share", "upper_share", "transitions", "distinct_share", "longest_run", "dictionary",
    "keyword_inside", "keyword_before", "assigned", "quoted", "known_neighbours", "path_rate",
]


@dataclass(frozen=True)
class Forest:
    """`sample` bounds the labelled findings that the forest is grown on, by hash order with a quota for each label;
    `common` is how often a word has to stand in the corpus to count as one of the dictionary."""

    sample: int = 20_000
    trees: int = 20
    depth: int = 6
    threshold: float = 0.5
    common: int = 3


def candidates(docs: DataFrame, path: Column) -> DataFrame:
    """One row per candidate word with its value, path and neighbouring words."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", path.cast("string").alias("path"))
    rows = rows.filter(F.col("text").rlike(f"{CANDIDATE}|{ASSIGNING}|{OPENING}")).withColumn("text_key", F.xxhash64("text"))
    words = F.split("text", "\\s+")

    def assigned(w: Column, i: Column) -> Column:
        back = lambda n: F.coalesce(F.get("words", i - n), F.lit(""))
        opening = F.concat_ws(" ", back(1), w).rlike(f"^\\S*{OPENING}")
        return (F.length(w) >= 6) & (F.concat_ws(" ", back(2), back(1)).rlike(ASSIGNING) | opening)

    marked = F.filter(
        F.transform("words", lambda w, i: F.when(w.rlike(CANDIDATE) | assigned(w, i), i)), lambda i: i.isNotNull()
    )
    at = rows.select("doc_id", "text_key", "path", words.alias("words")).withColumn("word_no", F.explode(marked))
    word = lambda shift: F.coalesce(F.get("words", F.col("word_no") + shift), F.lit(""))
    found = at.select(
        "doc_id", "text_key", "path", "word_no", word(0).alias("word"), word(-1).alias("before"), word(-2).alias("before2"),
        word(1).alias("after"),
    )
    inner = F.regexp_replace("word", "^[^\\p{L}\\p{N}+]+|[^\\p{L}\\p{N}=_-]+$", "")
    named = f"^(?i:[\\w.-]*(?:{KEYWORD})[\\w.-]*)[\"']?[=:]+[\"'`]*(.+)$"
    whole = F.regexp_replace(F.when(inner.rlike(named), F.regexp_extract(inner, named, 1)).otherwise(inner), "^[\"'`]+", "")
    parts = F.array_distinct(
        F.concat(*(F.regexp_extract_all("word", F.lit(p), F.lit(g)) for p, g in ((EMBEDDED, 0), (PART, 1), (USER_INFO, 1))))
    )
    # Of a part that holds an issued key only the key counts.
    own = F.filter(parts, lambda v: ~(v.rlike(EMBEDDED) & ~v.rlike(f"^{EMBEDDED}$")))
    values = F.when(F.size(own) > 0, own).otherwise(F.array(whole))
    return found.withColumn("value", F.explode(values)).filter("value <> ''")


def dictionary(found: DataFrame, docs: DataFrame, common: int) -> DataFrame:
    """Letter runs of the candidates and their neighbours that stand as words in the corpus at least `common` times.

    Counts are combined in each task before they move, so a frequent word costs no more than a rare one. The runs are a written table: Spark broadcasts it if its size is small, else shuffles.
    """
    text = F.lower(F.concat_ws(" ", "value", "before", "before2", "after"))
    runs = found.select(F.explode(F.regexp_extract_all(text, F.lit("(\\p{L}{3,20})"), 1)).alias("run"))
    wanted = staged(runs.distinct(), "runs")
    words = docs.select(F.explode(F.split(F.lower("text"), "[^\\p{L}\\p{N}]+")).alias("run"))
    counted = words.filter(F.length("run").between(3, 20)).groupBy("run").count().filter(F.col("count") >= common)
    return staged(counted.join(wanted, "run", "left_semi").select("run"), "dictionary")


def covered(found: DataFrame, words: DataFrame) -> DataFrame:
    """Adds the share of a value's letters and digits in dictionary words, and how many neighbours are such words."""
    keys = found.select("value", "before", "before2", "after").distinct()
    parts = keys.select(
        "*",
        F.explode_outer(
            F.concat(
                F.transform(F.regexp_extract_all(F.lower("value"), F.lit("(\\p{L}{3,20})"), 1), lambda r: F.struct(r.alias("run"), F.lit(True).alias("own"))),
                F.transform(
                    F.regexp_extract_all(F.lower(F.concat_ws(" ", "before", "before2", "after")), F.lit("(\\p{L}{3,20})"), 1),
                    lambda r: F.struct(r.alias("run"), F.lit(False).alias("own")),
                ),
            )
        ).alias("part"),
    ).select(*keys.columns, F.col("part.run").alias("run"), F.col("part.own").alias("own"))
    hits = parts.join(words.withColumn("known", F.lit(True)), "run", "left")
    sums = hits.groupBy(*keys.columns).agg(
        (F.sum(F.when(F.col("known") & F.col("own"), F.length("run")).otherwise(0)) / F.length("value")).alias("dictionary"),
        F.count_if(F.col("known") & ~F.col("own")).cast("double").alias("known_neighbours"),
    )
    return found.join(sums, keys.columns)


def weak_label() -> Column:
    """1 for issued formats and for random values that are assigned to a keyword, 0 for harmless shapes, else null.

    A value of letters alone counts as random if its case changes inside and no word of the dictionary is in it.
    """
    value = F.col("value")
    named = F.col("keyword_inside") + F.col("keyword_before") > 0
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.length(value) >= 8)
    letters = value.rlike("^\\p{L}{6,}$")
    cased = letters & value.rlike("[a-z][A-Z]") & (F.col("dictionary") == 0)
    return (
        F.when(value.rlike(ISSUED), 1.0)
        .when(value.rlike(HARMLESS), 0.0)
        .when(named & mixed & ~value.rlike("[\\p{L}]{12,}"), 1.0)
        .when(named & (F.col("assigned") > 0) & cased, 1.0)
        .when(letters & value.rlike("^.\\P{Lu}*$") & (F.col("dictionary") == 1), 0.0)
    )


def described(found: DataFrame) -> DataFrame:
    """Composition and neighbourhood of the candidates as numbers."""
    value, size = F.col("value"), F.length("value").cast("double")
    count = lambda pattern: F.regexp_count(value, F.lit(pattern))
    flag = lambda c: c.cast("double")
    near = F.concat_ws(" ", "before2", "before")
    edges = "(?<=[a-z])[A-Z0-9]|(?<=[A-Z])[a-z0-9]|(?<=[0-9])[A-Za-z]"
    return found.withColumns(
        {
            "length": size,
            "digit_share": count("[0-9]") / size,
            "upper_share": count("\\p{Lu}") / size,
            "transitions": count(edges) / F.greatest(size - 1, F.lit(1.0)),
            "distinct_share": F.size(F.array_distinct(F.split("value", ""))) / size,
            "longest_run": F.coalesce(F.array_max(F.transform(F.regexp_extract_all(value, F.lit("(\\p{L}+)"), 1), F.length)), F.lit(0)).cast("double"),
            "keyword_inside": flag(F.col("word").rlike(f"(?i)(?:{KEYWORD})[\\w.-]*[\"']?[=:]") | F.col("word").rlike(USER_INFO)),
            "keyword_before": flag(near.rlike(f"(?i)(?:{KEYWORD})")),
            "assigned": flag(F.col("before").rlike("[=:]$") | F.col("word").rlike("[=:]")),
            "quoted": flag(F.col("word").rlike("^[\"'`]|[=:][\"'`]")),
        }
    )


def with_path_rates(found: DataFrame) -> DataFrame:
    """Adds the share of labelled findings of the path that are true, its own label left out, drawn toward the whole by ten findings."""
    sums = found.groupBy("path").agg(F.sum("label").alias("good"), F.count("label").alias("n"))
    sums = staged(sums, "paths").withColumnRenamed("path", "p")
    whole = sums.agg(F.sum("good") / F.nullif(F.sum("n"), F.lit(0))).first()[0]
    whole = 0.5 if whole is None else whole
    good = F.coalesce("good", F.lit(0.0)) - F.coalesce("label", F.lit(0.0))
    rate = (good + 10 * whole) / (F.col("n") - F.col("label").isNotNull().cast("int") + 10)
    return found.join(sums, F.col("path").eqNullSafe(F.col("p"))).withColumn("path_rate", rate).drop("p", "good", "n")


def quotas(truth: dict[float, int], size: int) -> dict[float, int]:
    """Rows to take of each of two labels, `size` at most: half each, and what one label leaves goes to the other."""
    least = {k: min(n, size // 2) for k, n in truth.items()}
    return {k: min(n, size - sum(v for j, v in least.items() if j != k)) for k, n in truth.items()}


def grown_on(known: DataFrame, truth: dict[float, int], size: int) -> DataFrame:
    """A sample of the labelled findings with both labels in it; `weight` gives each label its true share."""
    parts = []
    for label, n in sorted(quotas(truth, size).items()):
        rows = hashed_sample(known.filter(F.col("label") == label), n, truth[label], "value", "doc_id", "word_no")
        parts.append(rows.withColumn("weight", F.lit(truth[label] / n)))
    return parts[0].unionByName(parts[1])


def scan(docs: DataFrame, path: Column, labelled: DataFrame | None = None, forest: Forest = Forest()) -> DataFrame:
    """All candidates with score and is_secret.

    `labelled` (doc_id, word_no, label 0/1) holds findings that were looked at; a label holds for all values of its word. Without it, findings of unmistakable shape
    serve as labelled ones. A true label of a finding that was looked at, or of an issued format, stands whatever its score.
    """
    found = staged(candidates(docs, path), "candidates")
    found = described(covered(found, dictionary(found, docs, forest.common)))
    if labelled is None:
        found = found.withColumn("label", weak_label())
    else:
        known = labelled.select("doc_id", "word_no", F.col("label").cast("double").alias("label"))
        found = found.join(known.dropDuplicates(["doc_id", "word_no"]), ["doc_id", "word_no"], "left")
    found = staged(with_path_rates(found), "findings")
    truth = {r[0]: r[1] for r in found.filter("label is not null").groupBy("label").count().collect()}
    if set(truth) != {0.0, 1.0}:
        judged = found.withColumn("score", F.coalesce("label", F.lit(1.0)))
    else:
        assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
        known = assembled.filter("label is not null")
        rows = grown_on(known, truth, forest.sample)
        learner = RandomForestClassifier(
            numTrees=forest.trees, maxDepth=forest.depth, seed=7, labelCol="label", featuresCol="features", weightCol="weight"
        )
        judged = learner.fit(rows.select("features", "label", "weight")).transform(assembled)
        judged = judged.withColumn("score", vector_to_array("probability")[1])
    certain = F.lit(True) if labelled is not None else F.col("value").rlike(ISSUED)
    stands = F.coalesce(F.col("label") == 1, F.lit(False)) & certain
    return judged.withColumn("is_secret", stands | (F.col("score") >= forest.threshold)).select(
        "doc_id", "text_key", "word_no", "value", "path", *[f for f in FEATURES if f != "path_rate"], "path_rate", "score", "is_secret"
    )


def redacted(docs: DataFrame, findings: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every confirmed secret replaced by `mark`; n_chars follows where there is such a column.

    Secrets are matched to documents by their text, so copies share them. Longer ones are replaced first.
    """
    confirmed = findings.filter("is_secret").groupBy("text_key").agg(F.collect_set("value").alias("values"))
    values = staged(confirmed.withColumnRenamed("text_key", "key"), "confirmed")
    longest = F.array_sort("values", lambda a, b: F.length(b) - F.length(a))
    clean = F.aggregate(longest, F.col("row.text"), lambda text, v: F.replace(text, v, F.lit(mark)))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("text_key"))
    both = rows.join(values, F.col("text_key") == F.col("key"), "left")
    text = F.when(F.col("values").isNull(), F.col("row.text")).otherwise(clean)
    changed = both.select("row", text.alias("text"))
    own = {"text": F.col("text"), "n_chars": F.coalesce(F.length("text").cast("bigint"), F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return changed.select(*[own[c].alias(c) if own.get(c) is not None else F.col(f"row.`{c}`") for c in docs.columns])
