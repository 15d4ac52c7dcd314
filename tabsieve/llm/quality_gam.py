"""Quality classifier: a generalised additive model with pairwise terms.

A text is described by a few ratios (`FEATURES`), all from one pass over its
bytes, lines and words.  Each feature is cut into bins at quantiles of the
training sample.  Boosting goes round the features in turn: a tree of at most
``leaves`` leaves is fitted to the log-loss gradient over one feature's bins
and added, shrunk, to that feature's lookup table.  Then the pairs that reduce
the remaining loss most get two-way tables, boosted in turn the same way by a
tree of one cut in each feature.  A score is the sum of table entries, so
scoring is a bin search and additions on whole batches.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsieve.llm.common import id_crc_mod, labelled_sample, prepare, text_slices, texts_of

#: Labelled rows of each class that the fit uses at most.
SAMPLE_PER_CLASS = 6_000
BINS = 24
PAIR_BINS = 8
ROUNDS = 80
PAIRS = 6
PAIR_ROUNDS = 20
RATE = 0.15
LEAVES = 3
#: Added to the curvature of a leaf: thinly held leaves stay near zero.
RIDGE = 5.0

# ratios only: length by itself says nothing of quality
FEATURES = ["chars_per_word", "upper_share", "digit_share", "punct_per_word",
            "symbol_per_word", "other_share", "space_share", "distinct_words", "top_word", "adjacent_equal",
            "lone_marks", "words_per_line", "repeated_lines", "stops_per_word"]

# Bytes counted as symbols, marks and sentence ends.
SYMBOLS = b"#*$%&|<>"
PUNCTUATION = b"!\"'(),-./:;?@[\\]^_`{}~+="
STOPS = b".!?"


def _members(of: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=np.int64)
    out[list(of)] = 1
    return out


_CLASSES = np.stack([
    _members(bytes(range(65, 91))), _members(bytes(range(48, 58))), _members(PUNCTUATION), _members(SYMBOLS),
    _members(bytes(range(128, 256))), _members(b" \t\n\v\f\r"), _members(STOPS)], axis=1)


def describe(text: str) -> list[float]:
    """Features of one whole text; an empty text has all zeros."""
    raw = text.encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(FEATURES)
    # counted in slices: the counter widens each byte to eight
    counts = np.zeros(256, dtype=np.int64)
    view = np.frombuffer(raw, dtype=np.uint8)
    for at in range(0, len(view), 1 << 16):
        counts += np.bincount(view[at:at + (1 << 16)], minlength=256)
    upper, digit, punct, symbol, other, space, stop = (counts @ _CLASSES).tolist()
    words = raw.split()
    n, size = max(1, len(words)), len(raw)
    seen = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    same = sum(map(bytes.__eq__, words[:-1], words[1:]))
    lone = sum(c for w, c in seen.items() if len(w) == 1 and not w.isalnum())
    return [(size - space) / n, upper / size, digit / size, punct / n,
            symbol / n, other / size, space / size, len(seen) / n, max(seen.values(), default=0) / n, same / n,
            lone / n, math.log1p(len(words) / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)), stop / n]


# --- model -------------------------------------------------------------------------------------

@dataclass
class PairwiseGam:
    """Lookup tables over bins; ``score`` is the logistic of their sum."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)
    constant: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        total = np.full(len(x), self.base)
        for j, (e, t) in enumerate(zip(self.edges, self.tables)):
            total += t[np.searchsorted(e, x[:, j], side="right")]
        if self.pairs:
            coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.pair_edges)]
            for (i, j), t in self.pairs.items():
                total += t[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g, h):
    return g * g / (h + RIDGE)


def _tree_on_bins(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Leaf value for each bin: cuts chosen one after another by loss gain."""
    cuts = [0, len(g)]
    sg, sh = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if hi - lo < 2:
                continue
            k = np.arange(lo + 1, hi)
            gain = (_gain(sg[k] - sg[lo], sh[k] - sh[lo]) + _gain(sg[hi] - sg[k], sh[hi] - sh[k])
                    - _gain(sg[hi] - sg[lo], sh[hi] - sh[lo]))
            if gain.max() > best[0]:
                best = (float(gain.max()), int(k[gain.argmax()]))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        out[lo:hi] = (sg[hi] - sg[lo]) / (sh[hi] - sh[lo] + RIDGE)
    return out


def _quad_on_bins(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best cut in each of two features: gain and value of the four leaves."""
    sg = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    sh = np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    best, value = -1.0, np.zeros_like(g)
    for i in range(1, g.shape[0]):
        j = np.arange(1, g.shape[1])
        if not len(j):
            break
        q = [(s[i, j], s[i, -1] - s[i, j], s[-1, j] - s[i, j], s[-1, -1] - s[i, -1] - s[-1, j] + s[i, j])
             for s in (sg, sh)]
        gain = sum(_gain(a, b) for a, b in zip(*q))
        if gain.max() > best:
            k = int(gain.argmax())
            best, leaf = float(gain[k]), [a[k] / (b[k] + RIDGE) for a, b in zip(*q)]
            value = np.zeros_like(g)
            c = int(j[k])
            value[:i, :c], value[:i, c:], value[i:, :c], value[i:, c:] = leaf
    return best, value


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS, pair_rounds: int = PAIR_ROUNDS,
        rate: float = RATE, leaves: int = LEAVES) -> PairwiseGam:
    """Fit on features x and labels y in {0, 1}.  No rows give the constant 0.5,
    one class its own label."""
    if not len(y) or y.min() == y.max():
        return PairwiseGam(constant=float(y[0]) if len(y) else 0.5)
    model = PairwiseGam(base=math.log(y.mean() / (1 - y.mean())))
    d = x.shape[1]
    model.edges = [_edges(x[:, j], BINS) for j in range(d)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    total = np.full(len(y), model.base)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(d):
            g, h = slopes()
            n = len(model.tables[j])
            if n < 2:
                continue
            step = rate * _tree_on_bins(np.bincount(bins[j], g, n), np.bincount(bins[j], h, n), leaves)
            model.tables[j] += step
            total += step[bins[j]]

    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(d)]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.pair_edges)]
    sizes = [len(e) + 1 for e in model.pair_edges]

    def quad(i, j, g, h):
        at = coarse[i] * sizes[j] + coarse[j]
        shape = (sizes[i], sizes[j])
        return _quad_on_bins(np.bincount(at, g, shape[0] * shape[1]).reshape(shape),
                             np.bincount(at, h, shape[0] * shape[1]).reshape(shape))

    g, h = slopes()
    ranked = sorted(((quad(i, j, g, h)[0], i, j) for i in range(d) for j in range(i + 1, d)
                     if sizes[i] > 1 and sizes[j] > 1), reverse=True)[:pairs]
    model.pairs = {(i, j): np.zeros((sizes[i], sizes[j])) for _, i, j in ranked}
    for _ in range(pair_rounds):
        for (i, j), t in model.pairs.items():
            step = rate * quad(i, j, *slopes())[1]
            t += step
            total += step[coarse[i], coarse[j]]
    return model


# --- on Spark ----------------------------------------------------------------------------------

def _describe_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch):
            x = [describe(t) for t in texts_of(part)]
            yield pa.RecordBatch.from_arrays([part.column("y"), pa.array(x, pa.list_(pa.float64()))],
                                             names=["y", "x"])


def train(docs: DataFrame, labels: DataFrame, mod: int = 3, held_out: int = 1,
          per_class: int = SAMPLE_PER_CLASS) -> PairwiseGam:
    """Model from the documents whose id's crc32 mod ``mod`` is not ``held_out``;
    features are computed on the executors, at most 2 * ``per_class`` feature
    rows come to the driver."""
    prepare(docs.sparkSession)
    sample = labelled_sample(docs, labels, "quality", mod, held_out, per_class)
    got = sample.select("text", "y").mapInArrow(_describe_rows, "y int, x array<double>").toArrow()
    if not got.num_rows:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    x = np.array(got.column("x").to_pylist())
    y = got.column("y").to_numpy().astype(np.float64)
    order = np.lexsort([*x.T, y])  # the same sums whatever order rows come in
    return fit(x[order], y[order])


def score(docs: DataFrame, model: PairwiseGam) -> DataFrame:
    """(doc_id, score, predicted) of every row by its whole text; null and empty
    texts are scored by their (zero) features; repeated rows each get a row."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                s = model.score(np.array([describe(t) for t in texts_of(part)]).reshape(-1, len(FEATURES)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                    names=["doc_id", "score", "predicted"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the classifier rejects (score below 0.5);
    all columns come back unchanged, and equal rows share their fate."""
    prepare(docs.sparkSession)
    model = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                s = model.score(np.array([describe(t) for t in texts_of(part)]).reshape(-1, len(FEATURES)))
                yield part.filter(pa.array(s >= 0.5))

    return docs.mapInArrow(run, docs.schema)


def held_out_column(mod: int = 3, held_out: int = 1):
    return (id_crc_mod(F.col("doc_id"), mod) == held_out).alias("held_out")
