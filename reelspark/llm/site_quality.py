"""Quality classifier: document evidence with host and path posteriors by hierarchical empirical Bayes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from reelspark.llm.quality_rules import text_counts
from reelspark.session import broadcast_if_small, materialise

FOLDS = 5
FIT_ROWS = 20_000
LEAST = 1e-6
LEAST_SITE = 1e-4
SITE_BYTES = 256


def _per(count: str, total: str) -> Column:
    return F.col(count) / F.greatest(F.col(total), F.lit(1))


def _features() -> dict[str, Column]:
    """What the document classifier sees: ratios, and the length in steps, as short texts say little."""
    return {
        "word_length": F.least(_per("word_chars", "n_words"), F.lit(30.0)),
        "symbols": F.least(_per("n_symbols", "n_words"), F.lit(3.0)),
        "stop_words": _per("n_stop_words", "n_words"),
        "dup_lines": _per("n_dup_lines", "n_lines"),
        "repeats": _per("n_repeat_words", "n_words"),
        "shouts": _per("n_shouts", "n_words"),
        "no_stop_words": ((F.col("n_stop_words") * 50 < F.col("n_words") - 50)).cast("double"),
        "tiny": (F.col("n_words") < 10).cast("double"),
        "no_words": (F.col("n_words") == 0).cast("double"),
    }


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit_evidence(counted: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Column:
    """P(good | text) as one expression over the counts: logistic regression on at most ``rows``
    labelled documents outside the held-out fold, drawn by digest. One class only: its share."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    drawn = usable.select("doc_id", F.col("quality").cast("double").alias("label")).distinct()
    drawn = drawn.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    features = _features()
    train = counted.join(F.broadcast(drawn), counted["_id"] == drawn["doc_id"])
    train = materialise(train.select("label", *[value.alias(name) for name, value in features.items()]))
    shares = train.agg(F.avg("label").alias("share"), F.count(F.lit(1)).alias("n")).first()
    if not shares["n"] or shares["share"] in (0.0, 1.0):
        return F.lit(0.5 if not shares["n"] else min(max(shares["share"], LEAST), 1 - LEAST))
    assembled = VectorAssembler(inputCols=list(features), outputCol="features").transform(train)
    model = LogisticRegression(regParam=1e-4, maxIter=100).fit(assembled)
    margin = F.lit(float(model.intercept))
    for weight, value in zip(model.coefficients, features.values(), strict=True):
        margin = margin + F.lit(float(weight)) * value
    return F.least(F.greatest(1 / (1 + F.exp(-margin)), F.lit(LEAST)), F.lit(1 - LEAST))


@dataclass(frozen=True)
class Strengths:
    """Global mean, and how many documents a prior is worth at host and at path level."""

    mean: float
    host: float
    path: float


def _strength(within: float, between: float) -> float:
    """Pseudo-count of a Beta prior: within variance over between variance; none between: a full shrink."""
    return within / between if between > 0 else 1e12


def fit_strengths(paths: DataFrame, hosts: DataFrame) -> Strengths:
    """Variance components by moments from the sums of (host, path) and host groups."""
    p = paths.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups"), F.sum("ss").alias("ss"),
        F.sum(F.col("s") ** 2 / F.col("n")).alias("fit"), F.sum(F.col("n").cast("double") ** 2).alias("n2"),
    ).first()
    h = hosts.agg(
        F.sum("s").alias("s"), F.count(F.lit(1)).alias("groups"), F.sum(F.col("s") ** 2 / F.col("n")).alias("fit"),
        F.sum(F.col("n").cast("double") ** 2).alias("n2"), F.sum(F.col("path_n2") / F.col("n")).alias("nested"),
    ).first()
    n = p["n"]
    if not n:
        return Strengths(0.5, 1.0, 1.0)
    mean = h["s"] / n
    within = max(p["ss"] - p["fit"], 0.0) / max(n - p["groups"], 1)
    path_room = n - h["nested"]
    path_var = (p["fit"] - h["fit"] - (p["groups"] - h["groups"]) * within) / path_room if path_room > 0 else 0.0
    host_room = n - h["n2"] / n
    host_var = (h["fit"] - n * mean**2 - (h["groups"] - 1) * (within + max(path_var, 0.0))) / host_room if host_room > 0 else 0.0
    return Strengths(mean, _strength(within, host_var), _strength(within, path_var))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _inside(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(LEAST_SITE)), F.lit(1 - LEAST_SITE))


def combine(evidence: DataFrame) -> DataFrame:
    """(_id, _host, _path, e) with host_posterior, path_posterior and score.

    Posteriors leave the document itself out: the host's mean is shrunk to the global mean, the
    path's to its host's, each by the strength the data show. The score adds the site's
    log-odds over the global ones to the document's. Sums per path are combined before the
    shuffle and hosts are summed from paths, so a host of any size costs its paths.
    """
    e = F.col("e")
    paths = evidence.groupBy("_host", "_path").agg(
        F.count(F.lit(1)).alias("n"), F.sum(e).alias("s"), F.sum(e * e).alias("ss")
    )
    paths = materialise(paths)
    hosts = paths.groupBy("_host").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum(F.col("n").cast("double") ** 2).alias("path_n2")
    )
    strengths = fit_strengths(paths, hosts)
    host = hosts.select(F.col("_host").alias("_h"), F.col("n").alias("host_n"), F.col("s").alias("host_s"))
    sites = paths.join(host, paths["_host"].eqNullSafe(host["_h"])).drop("_h", "ss")
    sites = sites.withColumnsRenamed({"_host": "_h", "_path": "_p"})
    sites = broadcast_if_small(sites, paths.count(), SITE_BYTES)
    joined = evidence.join(sites, evidence["_host"].eqNullSafe(sites["_h"]) & evidence["_path"].eqNullSafe(sites["_p"]))
    mean = F.lit(strengths.mean)
    host_mean = (strengths.host * mean + F.col("host_s") - e) / (strengths.host + F.col("host_n") - 1)
    with_host = joined.withColumn("host_posterior", host_mean)
    path_mean = (strengths.path * F.col("host_posterior") + F.col("s") - e) / (strengths.path + F.col("n") - 1)
    with_path = with_host.withColumn("path_posterior", path_mean)
    margin = _logit(e) + _logit(_inside(F.col("path_posterior"))) - _logit(_inside(mean))
    return with_path.withColumn("score", 1 / (1 + F.exp(-margin))).drop("_h", "_p", "n", "s", "host_n", "host_s")


def classify_quality(
    df: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str = "lang",
    least: float = 0.5,
) -> DataFrame:
    """doc_id, held_out, evidence, host_posterior, path_posterior, score and kept of each row.

    ``host`` and ``path`` name the two site levels (a crawl has them in its urls). A null host or
    path is a group of its own. Null and empty texts are judged as texts without words. Labels of
    the held-out fold are never read; without usable labels the evidence is 0.5 throughout.
    Repeated rows are documents of their own. An empty table gives no rows; extra columns are
    ignored.
    """
    named = df.select(
        df[doc_id].alias("_id"), df[host].cast("string").alias("_host"), df[path].cast("string").alias("_path"), df[text].alias("_text")
    )
    counted = materialise(text_counts(named, "_text"))
    evidence = counted.select("_id", "_host", "_path", fit_evidence(counted, labels).alias("e"))
    judged = combine(evidence)
    return judged.select(
        F.col("_id").alias("doc_id"),
        held_out(F.col("_id")).alias("held_out"),
        F.col("e").alias("evidence"),
        "host_posterior",
        "path_posterior",
        "score",
        (F.col("score") >= least).alias("kept"),
    )
