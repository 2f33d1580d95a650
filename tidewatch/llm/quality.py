"""Quality of documents by hierarchical empirical Bayes.

A logistic classifier gives the evidence of each text. Hosts and paths get posterior rates from the evidence of all their
documents, paths shrunk toward their host and hosts toward the whole, by strengths that are estimated from how much
the rates differ beyond chance. A document is judged by its own evidence and the rate of its path, taken without
itself.

A null or empty text has the features of no words; null hosts and paths form sites of their own; null labels don't
count; repeated rows count once each; without labels of both kinds the classifier is silent (0.5) and nothing
is rejected; extra columns pass through `accepted`; an empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import hashed_sample, staged

#: Characters that prose rarely holds.
MARKS = "!|%$#&*{}<>\\^~=_@[]"
FEATURES = ["upper", "marks", "marked_words", "digits", "distinct", "repeated", "lines", "word_length", "log_words"]


@dataclass(frozen=True)
class Rule:
    """`sample` bounds the labelled rows that the classifier is fitted on, by hash order of their ids.

    A document is rejected below `threshold`. `ridge` keeps weights finite; `salts` spreads a hot path over
    so many parts where sites are joined.
    """

    sample: int = 20_000
    threshold: float = 0.5
    ridge: float = 1e-3
    salts: int = 16


def features(text: Column) -> list[Column]:
    """Shares and sizes of one text, without leaving the JVM."""
    text = F.coalesce(text, F.lit(""))
    size = F.greatest(F.length(text), F.lit(1)).cast("double")
    words = F.filter(F.split(text, "\\s+"), lambda w: w != "")
    count = F.greatest(F.size(words), F.lit(1)).cast("double")
    lines = F.split(text, "\n")
    same = F.size(
        F.filter(F.zip_with(F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), words, lambda a, b: a == b), lambda x: x)
    )
    return [
        (F.regexp_count(text, F.lit("\\p{Lu}")) / size).alias("upper"),
        ((F.length(text) - F.length(F.translate(text, MARKS, ""))) / size).alias("marks"),
        (F.regexp_count(text, F.lit("[!|%$#&*](?:\\s|$)")) / count).alias("marked_words"),
        ((F.length(text) - F.length(F.translate(text, "0123456789", ""))) / size).alias("digits"),
        (F.size(F.array_distinct(words)) / count).alias("distinct"),
        (same / count).alias("repeated"),
        (F.size(F.array_distinct(lines)) / F.size(lines)).alias("lines"),
        (size / count).alias("word_length"),
        F.log(count + 1).alias("log_words"),
    ]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Newton steps on standardized features and their squares: means, spreads, weights and intercept."""
    x = np.hstack([x, x * x])
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([np.clip((x - mean) / spread, -8, 8), np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), ridge * len(x))
    penalty[-1] = 0
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        gradient = z.T @ (p - y) + penalty * w
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty + 1e-6), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, spread, w[:-1], float(w[-1])


@dataclass(frozen=True)
class Classifier:
    """Log odds of quality beyond the odds among the labelled rows."""

    mean: list[float]
    spread: list[float]
    weights: list[float]
    intercept: float
    prior: float

    def evidence(self) -> Column:
        """Log likelihood ratio of a row that has the columns of `FEATURES`."""
        total = F.lit(self.intercept - self.prior)
        inputs = [F.col(f) for f in FEATURES] + [F.col(f) * F.col(f) for f in FEATURES]
        for c, m, s, w in zip(inputs, self.mean, self.spread, self.weights, strict=False):
            total = total + F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (c - m) / s)) * w
        return F.greatest(F.lit(-30.0), F.least(F.lit(30.0), total))


def train(rows: DataFrame, labels: DataFrame, rule: Rule) -> Classifier:
    """Fit on at most `rule.sample` labelled rows; that many feature rows come to the driver."""
    marks = labels.filter("quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    known = rows.select("doc_id", *FEATURES).join(marks, "doc_id")
    sample = hashed_sample(known, rule.sample, known.count(), "doc_id", *FEATURES)
    got = np.array(sample.select(*FEATURES, "quality").collect(), dtype=float)
    y = (got[:, -1] >= 0.5).astype(float) if len(got) else np.zeros(0)
    if not 0 < y.sum() < len(y):
        return Classifier([], [], [], 0.0, 0.0)
    mean, spread, weights, intercept = fit_logistic(got[:, :-1], y, rule.ridge)
    return Classifier(mean.tolist(), spread.tolist(), weights.tolist(), intercept, float(np.log(y.mean() / (1 - y.mean()))))


def logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), p))
    return F.log(p / (1 - p))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def strength(groups: DataFrame, center: Column) -> DataFrame:
    """One row: how many documents a prior is worth, by the method of moments.

    `groups` has good (sum of rates) and n per group. The spread of group rates around `center` beyond that of
    chance is the variance of a beta prior; without any such spread the prior is worth a million documents.
    """
    rate = F.col("good") / F.col("n")
    noise = center * (1 - center) / F.col("n")
    weight = F.sqrt(F.col("n"))
    parts = groups.agg(
        F.sum(weight * ((rate - center) * (rate - center) - noise)).alias("extra"),
        F.sum(weight * center * (1 - center)).alias("scale"),
    )
    ratio = F.col("extra") / F.nullif(F.col("scale"), F.lit(0.0))
    worth = F.when(ratio > 1e-6, 1 / ratio - 1).otherwise(F.lit(1e6))
    return parts.select(F.greatest(F.lit(1.0), F.least(F.lit(1e6), worth)).alias("worth"))


def site_rates(rows: DataFrame) -> DataFrame:
    """Per (host, path): good and n of its documents, the host's posterior rate and the worth of the path's prior.

    `rows` has host, path and p. Documents are summed per site before anything moves, so a site that holds a
    third of all of them costs one row per task.
    """
    paths = staged(rows.groupBy("host", "path").agg(F.sum("p").alias("good"), F.count("*").alias("n")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    whole = hosts.agg((F.sum("good") / F.nullif(F.sum("n"), F.lit(0))).alias("whole")).first()[0]
    whole = 0.5 if whole is None else whole
    worth = strength(hosts, F.lit(whole)).first()[0] or 1e6
    host_rate = (F.col("good") + worth * whole) / (F.col("n") + worth)
    posterior = hosts.select(F.col("host").alias("h"), host_rate.alias("host_rate"))
    known = staged(paths.join(posterior, F.col("host").eqNullSafe(F.col("h"))).drop("h"), "sites")
    worth = strength(known, F.col("host_rate")).first()[0] or 1e6
    return known.withColumn("path_worth", F.lit(worth))


@dataclass(frozen=True)
class Model:
    classifier: Classifier
    sites: DataFrame
    rule: Rule


def described(docs: DataFrame, host: Column, path: Column) -> DataFrame:
    """The columns of `docs` next to host, path and the features, in a struct so that no name clashes."""
    return docs.select(F.struct("*").alias("row"), host.alias("host"), path.alias("path"), *features(F.col("text")))


def fit(docs: DataFrame, labels: DataFrame, host: Column, path: Column, rule: Rule = Rule()) -> tuple[Model, DataFrame]:
    """The model, and the features of all documents that it was made from (a written table without texts)."""
    slim = described(docs, host, path).select(F.col("row.doc_id").cast("bigint").alias("doc_id"), "host", "path", *FEATURES)
    rows = staged(slim, "features")
    classifier = train(rows, labels, rule)
    scored = rows.withColumn("p", sigmoid(classifier.evidence() + classifier.prior))
    return Model(classifier, site_rates(scored), rule), rows


def judged(rows: DataFrame, model: Model) -> DataFrame:
    """`rows` (host, path, features and others) with evidence, host_rate, path_rate, quality_prob, rejected.

    The sites are a written table, so Spark broadcasts them only if their measured size is small; otherwise a hot path
    is spread over salts.
    """
    salt = F.array(*[F.lit(i) for i in range(model.rule.salts)])
    sites = model.sites.select(
        F.col("host").alias("_h"), F.col("path").alias("_p"), "good", "n", "host_rate", "path_worth", F.explode(salt).alias("_s")
    )
    part = F.pmod(F.xxhash64(*FEATURES), F.lit(model.rule.salts)).cast("int")
    same = F.col("host").eqNullSafe(F.col("_h")) & F.col("path").eqNullSafe(F.col("_p")) & (part == F.col("_s"))
    own = sigmoid(F.col("evidence") + model.classifier.prior)
    rate = (F.col("good") - own + F.col("path_worth") * F.col("host_rate")) / (F.col("n") - 1 + F.col("path_worth"))
    both = rows.withColumn("evidence", model.classifier.evidence()).join(sites, same)
    found = both.withColumn("path_rate", rate).withColumn("quality_prob", sigmoid(F.col("evidence") + logit(F.col("path_rate"))))
    return found.withColumn("rejected", F.col("quality_prob") < model.rule.threshold)


def accepted(docs: DataFrame, labels: DataFrame, host: Column, path: Column, rule: Rule = Rule()) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    model, _ = fit(docs, labels, host, path, rule)
    return judged(described(docs, host, path), model).filter(~F.col("rejected")).select("row.*")
