"""Quality classifier by hierarchical empirical Bayes.

A document classifier, trained on a bounded sample of labelled rows, gives each
document its evidence: the log-odds of being good. Grouped aggregation sums the
evidence of hosts, and of the paths on them; each host's share of good documents
is shrunk toward the global share, each path's toward its host's, with strengths
estimated by moments from the groups themselves, so that sparse sites stay near
what is known above them. A document's final odds are its own evidence over the
prior of its path, which leaves its own contribution out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerguard.llm.common import NULL_ID, arrow_map, keyed, written

#: Labelled rows that the classifier is fitted on, at most.
TRAINING_ROWS = 20_000
PRIOR_ROWS = (1.0, 1000.0)  # limits of the shrinking strengths
BINS = 12

FEATURES = ("log_words", "word_length", "distinct", "upper", "digits", "symbols", "marks", "repeated_next",
            "repeated_lines", "long_words", "single_words", "bangs", "line_length", "top_word")


def measures(text: bytes) -> list[float]:
    """Numbers that tell prose from lists, noise, shouting and repetition (FEATURES)."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    letters = len(text.translate(None, b" \t\n\r\x0b\x0c"))
    count = lambda drop: (len(text) - len(text.translate(None, drop))) / letters
    lines = [x for x in text.split(b"\n") if x.strip()]
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    sizes = np.fromiter(map(len, words), np.int64, n)
    return [float(np.log1p(n)), letters / n, len(number) / n, count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), count(b"0123456789"),
            count(b"#*$%&|<>{}[]\\^~=+_@"), count(b".,;:?"), float((ids[1:] == ids[:-1]).mean()) if n > 1 else 0.0,
            1 - len(set(lines)) / len(lines), float((sizes > 20).mean()), float((sizes == 1).mean()), count(b"!"),
            float(np.log1p(len(text) / len(lines))), float(np.bincount(ids).max() / n)]


class Classifier:
    """Logistic regression on quantile-binned measures, by Newton's method with a ridge."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        z = self.inputs(x)
        self.weights = np.zeros(z.shape[1])
        penalty = np.full(z.shape[1], ridge)
        penalty[0] = 1e-6
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.einsum("ij,j->i", z, self.weights)))
            slope = np.einsum("ij,i->j", z, y - p) - penalty * self.weights
            curve = np.einsum("ij,i,ik->jk", z, p * (1 - p), z, optimize=True) + np.diag(penalty)
            move = np.linalg.solve(curve, slope)
            self.weights += move
            if np.abs(move).max() < 1e-6:
                break

    def inputs(self, x: np.ndarray) -> np.ndarray:
        parts = [np.ones((len(x), 1)), np.clip((x - self.mean) / self.scale, -8, 8)]
        parts += [(v[:, None] > c[None, :]).astype(float) for c, v in zip(self.cuts, x.T)]
        return np.concatenate(parts, axis=1)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.einsum("ij,j->i", self.inputs(x), self.weights), -20, 20)


def document_measures(docs: DataFrame, host: str, path: str) -> DataFrame:
    """(k, host, path, x) of each row; x is the array of measures."""
    rows = keyed(docs.withColumns({"_h": docs[host].cast("string"), "_p": docs[path].cast("string")})
                 .select("doc_id", "text", "_h", "_p"), "_h", "_p")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = [measures(t) for t in batch.column("text").to_pylist()]
        return pa.record_batch([batch.column("k"), batch.column("_h"), batch.column("_p"),
                                pa.array(x, pa.list_(pa.float64()))], ["k", "host", "path", "x"])
    return arrow_map(rows, step, "k long, host string, path string, x array<double>")


def fit(rows: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> Classifier | None:
    """The classifier of at most ``limit`` labelled rows, those of least id hash; None without both labels.

    A doc_id with different labels counts with each; of documents that share a
    doc_id the one with the least measures counts.
    """
    some = (labels.select(labels["doc_id"].cast("long").alias("k"), labels["quality"].cast("double").alias("y"))
            .where("k is not null and y is not null").distinct().orderBy(F.xxhash64("k"), "k", "y").limit(limit))
    sample = rows.select("k", "x").join(some, "k").groupBy("k", "y").agg(F.min("x").alias("x")).orderBy("k", "y").toPandas()
    if sample["y"].nunique() < 2:
        return None
    return Classifier(np.stack(sample["x"]), (sample["y"].to_numpy() > 0.5).astype(float))


def strength(groups: DataFrame, n: str, s: str, mean: float) -> float:
    """The number of prior rows that a group's share is shrunk by, by the method of moments.

    Between groups the shares vary by tau2, within them by mean * (1 - mean) / n;
    the strength is mean * (1 - mean) / tau2.
    """
    row = groups.agg(F.sum(F.pow(F.col(s) / F.col(n) - mean, 2) * F.col(n)).alias("q"), F.sum(n).alias("n"),
                     F.sum(F.pow(F.col(n), 2)).alias("nn"), F.count("*").alias("g")).first()
    within = mean * (1 - mean)
    if not row["g"] or row["g"] < 2 or within <= 0:
        return PRIOR_ROWS[1]
    spread = row["n"] - row["nn"] / row["n"]
    tau2 = (row["q"] - (row["g"] - 1) * within) / spread if spread > 0 else 0.0
    return float(np.clip(within / tau2 if tau2 > 0 else np.inf, *PRIOR_ROWS))


def judge_sites(docs: DataFrame, labels: DataFrame, host: str = "host", path: str = "path",
                limit: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, host, path, doc_log_odds, host_share, path_share, probability, kept) of each row.

    Null hosts are one host, null paths one path of theirs. Null or empty texts
    have all measures 0. Null ids stay null and train nothing; repeated rows
    repeat their result and count as often. Without labels of both kinds every
    document has even evidence. An empty table gives an empty result. Copies
    have equal evidence; a hot host is summed with partial aggregation.
    """
    rows = written(document_measures(docs, host, path), "measures")
    model = fit(rows, labels, limit)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = batch.column("x")
        flat = np.asarray(x.flatten()).reshape(batch.num_rows, len(FEATURES))
        odds = model.log_odds(flat) if model else np.zeros(batch.num_rows)
        return pa.record_batch([batch.column("k"), batch.column("host"), batch.column("path"), pa.array(odds)],
                               ["k", "host", "path", "odds"])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield step(batch)
    scored = written(rows.mapInArrow(run, "k long, host string, path string, odds double")
                     .withColumn("p", 1 / (1 + F.exp(-F.col("odds")))), "evidence")
    mean = scored.agg(F.avg("p")).first()[0]
    mean = 0.5 if mean is None else float(np.clip(mean, 1e-3, 1 - 1e-3))

    # decimal sums do not depend on the order of tasks
    paths = written(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(
        F.col("p").cast("decimal(20,12)")).cast("double").alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"),
                                      F.sum(F.col("s").cast("decimal(28,12)")).cast("double").alias("host_s"))
    above = strength(hosts, "host_n", "host_s", mean)
    below = strength(paths, "n", "s", mean)
    sites = written(paths.withColumnRenamed("host", "_host")
                    .join(hosts, F.col("_host").eqNullSafe(F.col("host"))).drop("_host")
                    .withColumn("host_share", (F.col("host_s") + above * mean) / (F.col("host_n") + above)), "sites")
    sites = sites.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "n", "s", "host_share")

    def logit(c):
        return F.log(c / (1 - c))
    share = (F.col("s") - F.col("p") + below * F.col("host_share")) / (F.col("n") - 1 + below)
    share = F.least(F.greatest(share, F.lit(1e-3)), F.lit(1 - 1e-3))
    final = F.col("odds") + logit(F.col("path_share")) - float(np.log(mean / (1 - mean)))
    joined = scored.join(sites, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")))
    return (joined.withColumn("path_share", share).withColumn("probability", 1 / (1 + F.exp(-final)))
            .select(F.when(F.col("k") != NULL_ID, F.col("k")).alias("doc_id"), "host", "path",
                    F.col("odds").alias("doc_log_odds"), "host_share", "path_share", "probability",
                    (F.col("probability") >= 0.5).alias("kept")))
