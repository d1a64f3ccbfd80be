"""Document quality by hierarchical empirical Bayes.

A small classifier gives each document its own evidence. Documents of a site
share what is known of the site: the rate of good documents of each host is
shrunk toward the global rate, and that of each path toward its host's, by as
much as the spread between groups, measured over all of them, warrants. A host
with three documents stays near the prior; one with a million stands for itself.
The document's own evidence is then combined with the rate of its path.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchstrata.llm.common import BROADCAST_ROWS, small
from matchstrata.session import stage

#: Labelled documents that the classifier is fitted on, chosen by hash of their id.
SAMPLE_DOCS = 6_000
#: What the classifier's opinion of an unlabelled document counts, against a label.
OPINION_WEIGHT = 0.25
RIDGE = 1.0
LEAST_QUALITY = 0.5
_LIMIT = 1e-4  # rates and evidence stay this far from 0 and 1
_MOST_CONCENTRATION = 1e6

FEATURES = (
    "symbols", "bars", "digits", "capitals", "word_length", "spread", "distinct", "repeats", "stops", "lines", "size", "empty",
)
_SYMBOL = re.compile(rb"[#$%&*@^~<>{}=\\]")


def features(text: str | None) -> list[float]:
    """Plain figures of a text; those of an empty or null text are 0 but for ``empty``."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    n, size = len(words), len(raw)
    lengths = np.fromiter(map(len, words), np.float64, n)
    return [
        len(_SYMBOL.findall(raw)) / size,
        raw.count(b"|") / n,
        sum(map(raw.count, (b"0", b"1", b"2", b"3", b"4", b"5", b"6", b"7", b"8", b"9"))) / size,
        int(np.count_nonzero(np.frombuffer(raw, np.uint8) != np.frombuffer(raw.lower(), np.uint8))) / size,
        min(lengths.mean(), 40.0) / 10,
        min(lengths.std(), 40.0) / 10,
        len(set(words)) / n ** 0.9,
        sum(map(bytes.__eq__, words[1:], words)) / n,
        (raw.count(b". ") + raw.count(b".\n") + raw.count(b", ") + raw.endswith(b".")) / n,
        raw.count(b"\n") / n,
        np.log1p(n) / 10,
        0.0,
    ]


def fit(x: np.ndarray, y: np.ndarray, steps: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression by Newton steps: weights (bias last), means and deviations."""
    mean, deviation = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / deviation, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), RIDGE)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + penalty * w
        curve = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        move = np.linalg.solve(curve, gradient)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return w, mean, deviation


def _features_of(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = [features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "x"]
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, x array<double>")


def _labels(labels: DataFrame, label: str) -> DataFrame:
    """One ``good`` (0 or 1) for each id: the majority of its labels, good if even."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.when(F.avg(F.col(label).cast("double")) >= 0.5, 1.0).otherwise(0.0).alias("good")
    )


def train(docs: DataFrame, labels: DataFrame, label: str = "quality"):
    """The classifier, or None if the labels do not tell two kinds of documents apart."""
    chosen = _labels(labels, label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    chosen = stage(chosen.withColumnRenamed("doc_id", "__id"), "quality-sample").df
    some = docs.select("doc_id", "text").join(small(chosen.select("__id")), F.col("doc_id") == F.col("__id"), "left_semi")
    rows = (
        _features_of(some).join(small(chosen), F.col("doc_id") == F.col("__id")).select("doc_id", "x", "good").limit(2 * SAMPLE_DOCS).collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    y = np.array([r["good"] for r in rows])
    if len(set(y)) < 2:
        return None
    return fit(np.array([r["x"] for r in rows]), y)


def evidence(docs: DataFrame, model, host: str, path: str) -> DataFrame:
    """Per document: ``doc_id, host, path, opinion``, the classifier's probability of good."""
    weights = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
    )

    def run(batches):
        w, mean, deviation = weights.value or (np.zeros(len(FEATURES) + 1), 0.0, 1.0)
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(1)]).reshape(-1, len(FEATURES))
            p = 1 / (1 + np.exp(-np.clip(((x - mean) / deviation) @ w[:-1] + w[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(np.clip(p, _LIMIT, 1 - _LIMIT))],
                names=["doc_id", "host", "path", "opinion"],
            )

    return rows.mapInArrow(run, "doc_id long, host string, path string, opinion double")


def _concentration(groups: DataFrame, rate: Column, n: str, prior: Column) -> float:
    """How many observations the prior is worth, from the spread of the groups' rates around it.

    By moments: the spread between groups beyond what chance gives within them.
    """
    row = groups.agg(
        F.sum(F.col(n) * F.pow(rate - prior, F.lit(2.0))).alias("between"),
        F.sum(prior * (1 - prior)).alias("chance"),
        F.sum(n).alias("n"),
        F.sum(F.pow(F.col(n), F.lit(2.0))).alias("n2"),
        F.sum(F.col(n) * prior * (1 - prior)).alias("within"),
    ).first()
    if not row["n"]:
        return _MOST_CONCENTRATION
    spread = (row["between"] - row["chance"]) / max(row["n"] - row["n2"] / row["n"], 1e-9)
    within = row["within"] / row["n"]
    if spread <= 0:
        return _MOST_CONCENTRATION
    return float(min(max(within / spread - 1, 1e-3), _MOST_CONCENTRATION))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(_LIMIT)), F.lit(1 - _LIMIT))
    return F.log(p / (1 - p))


def scored(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", label: str = "quality") -> DataFrame:
    """Per document: ``doc_id, host, path, opinion, host_rate, path_rate, quality, keep``.

    ``quality`` is the probability of good from the document's own text and the
    rate of its path, in which it has no part itself. Null hosts or paths are
    groups of their own. Documents without label count in the rates with the
    classifier's opinion. Without usable labels every opinion is even. Rows with
    null or repeated ids all get a result; no documents give no rows.

    Rates are sums by host and path, pre-aggregated before their shuffle; only
    those sums are joined back.
    """
    found = stage(evidence(docs, train(docs, labels, label), host, path), "quality-evidence").df
    good = stage(_labels(labels, label), "quality-labels").df
    known = found.join(small(good, BROADCAST_ROWS), "doc_id", "left")
    weight = F.when(F.col("good").isNull(), F.lit(OPINION_WEIGHT)).otherwise(1.0)
    counted = stage(known.withColumns({"w": weight, "s": weight * F.coalesce("good", "opinion")}), "quality-counted").df

    paths = stage(counted.groupBy("host", "path").agg(F.sum("w").alias("path_n"), F.sum("s").alias("path_s")), "quality-paths").df
    hosts = stage(paths.groupBy("host").agg(F.sum("path_n").alias("host_n"), F.sum("path_s").alias("host_s")), "quality-hosts").df
    total = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_s").alias("s")).first()
    mean = total["s"] / total["n"] if total["n"] else 0.5
    prior = F.lit(float(min(max(mean, _LIMIT), 1 - _LIMIT)))

    of_host = _concentration(hosts, F.col("host_s") / F.col("host_n"), "host_n", prior)
    shrunk = lambda s, n, k, p: (k * p + s) / (k + n)
    with_host = paths.join(small(hosts), "host").withColumn(
        "host_mean", shrunk(F.col("host_s"), F.col("host_n"), of_host, prior)
    )
    of_path = _concentration(with_host, F.col("path_s") / F.col("path_n"), "path_n", F.col("host_mean"))
    sums = stage(with_host.drop("host_mean"), "quality-sums").df

    own_n, own_s = F.col("w"), F.col("s")
    joined = counted.join(small(sums), ["host", "path"])
    host_rate = shrunk(F.col("host_s") - own_s, F.col("host_n") - own_n, of_host, prior)
    path_rate = shrunk(F.col("path_s") - own_s, F.col("path_n") - own_n, of_path, F.col("host_rate"))
    odds = _logit(F.col("opinion")) + _logit(F.col("path_rate")) - _logit(prior)
    return (
        joined.withColumn("host_rate", host_rate)
        .withColumn("path_rate", path_rate)
        .withColumn("quality", 1 / (1 + F.exp(-odds)))
        .select("doc_id", "host", "path", "opinion", "host_rate", "path_rate", "quality", (F.col("quality") >= LEAST_QUALITY).alias("keep"))
    )
