"""Quality classifier: histogram gradient-boosted trees over document statistics.

Training takes place on the driver over a bounded sample of labelled rows (figures
only, no texts); scoring is a numpy traversal of flat tree arrays inside the tasks.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orthoweave.llm.common import bucket_of_id, materialise, packed_rows, unpacked_rows

#: Bound of the training sample: labelled rows taken in order of a hash of the id.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, RATE, L2 = 120, 4, 64, 0.15, 1.0
MIN_LEAF = 5.0
CUT = 0.7

FEATURES = (
    "log_words", "mean_word", "sd_word", "longest_word", "upper_share", "digit_share", "mark_share",
    "full_stops", "commas", "exclamations", "bars", "marked_words", "shouted_words", "short_words",
    "distinct_words", "top_word", "repeated_pairs", "words_per_line", "repeated_lines",
    "open_lines", "capital_lines", "words_per_sentence", "non_ascii", "distinct_chars",
)

_UPPER, _DIGIT = re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"[0-9]")
_MARK = re.compile(r"[#*$%&|<>@^~_=+{}\[\]\\]")


def statistics(text: str | None) -> list[float]:
    """The features of one text, from its text alone; an empty text has zeros."""
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, chars = len(words), len(text)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = set(zip(words, words[1:], strict=False))
    stops, bangs = text.count("."), text.count("!")
    ends = [w[-1] for w in words]
    ends_counted = Counter(ends)
    return [
        float(np.log1p(n)), float(lengths.mean()), float(lengths.std()), float(np.log1p(lengths.max())),
        len(_UPPER.findall(text)) / chars, len(_DIGIT.findall(text)) / chars, len(_MARK.findall(text)) / chars,
        stops / n, text.count(",") / n, bangs / n, counts.get("|", 0) / n,
        sum(ends_counted.get(c, 0) for c in "#*$%&<>") / n, sum(w.isupper() for w in words) / n,
        float((lengths <= 3).mean()), len(counts) / n, max(counts.values()) / n,
        1 - len(pairs) / max(1, n - 1), n / len(lines), 1 - len(set(lines)) / len(lines),
        sum(x.rstrip()[-1] not in ".!?" for x in lines) / len(lines),
        sum(x.lstrip()[0].isupper() for x in lines) / len(lines),
        n / (1 + stops + bangs + text.count("?")), 1 - len(text.encode("ascii", "ignore")) / chars,
        float(np.log1p(len(set(text)))),
    ]


@dataclass
class Model:
    """Complete binary trees in level order: the children of node i are 2i+1 and 2i+2."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes; a value above goes right
    leaf: np.ndarray  # trees x leaves
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1]))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - (leaf.size - 1)]
        return 1 / (1 + np.exp(-total))


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Model:
    """Logistic boosting; each level finds its splits from gradient histograms. Without
    rows, or with one label only, the score is the smoothed share of label 1."""
    y = y.astype(np.float64)
    share = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(share / (1 - share)))
    inner, leaves = (1 << depth) - 1, 1 << depth
    model = Model(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)), start)
    if len(y) == 0 or share * (len(y) + 1) in (0.5, len(y) + 0.5):
        return model
    width = x.shape[1]
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    flat = binned + np.arange(width) * BINS
    score = np.full(len(y), start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            nodes, first = 1 << level, (1 << level) - 1
            place = ((node - first)[:, None] * (width * BINS) + flat).ravel()
            size = nodes * width * BINS
            g = np.bincount(place, np.repeat(grad, width), size).reshape(nodes, width, BINS)
            h = np.bincount(place, np.repeat(hess, width), size).reshape(nodes, width, BINS)
            gl, hl = g.cumsum(2)[:, :, :-1], h.cumsum(2)[:, :, :-1]
            gt, ht = g[:, :1].sum(2, keepdims=True), h[:, :1].sum(2, keepdims=True)
            gr, hr = gt - gl, ht - hl
            gain = gl**2 / (hl + L2) + gr**2 / (hr + L2) - gt**2 / (ht + L2)
            gain[(hl < MIN_LEAF / 4) | (hr < MIN_LEAF / 4)] = 0
            best = gain.reshape(nodes, -1).argmax(1)
            cut_bins = np.full(nodes, BINS)
            cut_features = np.zeros(nodes, np.int64)
            for k in range(nodes):
                f, b = divmod(int(best[k]), BINS - 1)
                if gain[k, f, b] > 1e-6 and b < len(edges[f]):
                    cut_features[k], cut_bins[k] = f, b
                    model.feature[t, first + k], model.threshold[t, first + k] = f, edges[f][b]
            own = node - first
            node = 2 * node + 1 + (binned[np.arange(len(y)), cut_features[own]] > cut_bins[own])
        place = node - inner
        g, h = np.bincount(place, grad, leaves), np.bincount(place, hess, leaves)
        model.leaf[t] = RATE * g / (h + L2)
        score += model.leaf[t][place]
    return model


def featurise(docs: DataFrame) -> DataFrame:
    """(doc_id, f: the features) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "f"])

    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, f array<double>")


def fit(features: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learns from at most sample_rows labelled rows outside the held-out quarter, in
    order of a hash of the id. Null labels and ids are not learnt from. An id with
    several labels is taken with its smallest."""
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    known = known.where(bucket_of_id(4) != 2)
    sample = features.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = sample.select("doc_id", "f", "quality").toArrow()
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable")
    flat = rows.column("f").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    x = flat.reshape(-1, len(FEATURES))[order]
    return train(x, rows.column("quality").to_numpy()[order])


def score(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) per input row.

    Null and empty texts are scored from zero features; a null id counts as the empty
    text for the held-out rule and stays null; repeated rows are scored each; empty
    tables give no rows, and without labels every score is 0.5. Texts are read whole.
    """
    features = materialise(featurise(docs), "quality-features")
    model = fit(features, labels, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x))], ["doc_id", "score"])

    scored = features.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id", (bucket_of_id(4) == 2).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The input rows the classifier accepts, with all their columns. The task that reads a
    row judges it: rows without an id too, and rows that share one apart. Features are found
    again rather than joined back, so no text is shuffled or stored."""
    model = fit(materialise(featurise(docs), "quality-features"), labels, sample_rows)
    rows = packed_rows(docs)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t) for t in batch.column(2).to_pylist()], np.float64).reshape(-1, len(FEATURES))
            yield batch.select(["_in"]).filter(pa.array(model.scores(x) >= CUT))

    return unpacked_rows(rows.mapInArrow(keep, T.StructType(rows.schema.fields[:1])), docs.columns)
