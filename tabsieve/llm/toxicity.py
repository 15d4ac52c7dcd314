"""Toxicity classifier with counterfactual regularisation.

A text's features are the words it holds and the beginnings of its words
(present or not, hashed).  A logistic model with an L1 penalty is fitted to
labelled texts.  For every labelled text that mentions an identity term, a
counterfactual is made by swapping each such term for another of its group,
and the squared change of the model's logit between the two is part of the
loss: a mere mention of a group cannot carry the score, words that go with
real toxicity can.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsieve.llm.common import id_crc_mod, labelled_sample, prepare, text_slices, texts_of

#: Labelled texts of each class that the fit uses at most.
SAMPLE_PER_CLASS = 4_000
SPACE = 1 << 20
#: Lengths of word beginnings that are features.
PREFIXES = (3, 4, 5, 6, 7, 8)
#: Features that enter the fit: those in so many texts whose association with
#: the label is above the largest that chance gives among all features counted.
MIN_TEXTS = 3
L1 = 3e-4
L2 = 1e-5
COUNTERFACTUAL = 1.0
STEPS = 300
CACHE_WORDS = 300_000

# Identity terms by group; a term is swapped for the next of its group.
IDENTITY_TERMS = [
    ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"],
    ["christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"],
    ["woman", "man"], ["women", "men"], ["girl", "boy"], ["girls", "boys"], ["female", "male"],
    ["gay", "straight", "lesbian", "bisexual", "queer", "transgender"],
    ["black", "white", "asian", "latino", "arab", "african", "european", "mexican", "chinese", "indian"],
    ["immigrant", "native", "refugee", "foreigner"], ["immigrants", "natives", "refugees", "foreigners"],
    ["deaf", "blind", "disabled", "autistic"], ["old", "young", "elderly"],
    ["femme", "homme"], ["femmes", "hommes"], ["musulman", "chrétien", "juif"],
    ["frau", "mann"], ["frauen", "männer"], ["muslime", "christen", "juden"],
    ["mujer", "hombre"], ["mujeres", "hombres"], ["musulmán", "cristiano", "judío"],
]
_SWAP = {t: group[(i + 1) % len(group)] for group in IDENTITY_TERMS for i, t in enumerate(group)}
_words = re.compile(r"[^\W_]+").findall


def words_of(text: str) -> set[str]:
    return set(_words(text.lower()))


def features_of(word: str) -> list[int]:
    """Hashed features of one word: itself and its beginnings."""
    keys = ["=" + word, *("^" + word[:k] for k in PREFIXES if len(word) >= k)]
    return [zlib.crc32(k.encode("utf-8", "surrogatepass")) % SPACE for k in keys]


def swapped(words: set[str]) -> set[str]:
    """The words after swapping identity terms."""
    return {_SWAP.get(w, w) for w in words}


def feature_set(words: set[str]) -> set[int]:
    return {f for w in words for f in features_of(w)}


@dataclass
class ToxicityModel:
    base: float = 0.0
    weights: dict[int, float] = field(default_factory=dict)
    constant: float | None = None

    def scorer(self):
        """Function text -> score; remembers the weighted features of words."""
        if self.constant is not None:
            return lambda text: self.constant
        weights, known, none = self.weights, {}, ()

        def score(text: str) -> float:
            active: set[int] = set()
            for w in words_of(text):
                f = known.get(w)
                if f is None:
                    f = tuple(x for x in features_of(w) if x in weights) or none
                    if len(known) < CACHE_WORDS and len(w) <= 32:
                        known[w] = f
                if f:
                    active.update(f)
            z = self.base + sum(weights[x] for x in sorted(active))
            return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))

        return score


def chance_z(n_features: int) -> float:
    """About the largest of ``n_features`` standard scores under chance alone."""
    return math.sqrt(2 * math.log(max(2, n_features)))


def fit(rows: list[np.ndarray], y: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]],
        counterfactual: float = COUNTERFACTUAL, least_z: float | None = None) -> ToxicityModel:
    """Fit on feature lists and labels; ``pairs`` are features of texts and of
    their counterfactuals.  Features under ``least_z`` (by default `chance_z`) are left out.  The L1 penalty picks the features; a second run
    without it frees their weights from its pull.  No rows give the constant 0.5, one class its own label."""
    if not len(y) or y.min() == y.max():
        return ToxicityModel(constant=float(y[0]) if len(y) else 0.5)
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    where = np.concatenate([np.full(len(r), i) for i, r in enumerate(rows)])
    what = np.concatenate(rows).astype(np.int64)
    pos = np.bincount(what, y[where], SPACE)
    all_ = np.bincount(what, minlength=SPACE)
    p1, p0, p = pos / n1, (all_ - pos) / n0, all_ / len(y)
    z = np.abs(p1 - p0) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / n1 + 1 / n0))
    z[all_ < MIN_TEXTS] = 0
    chosen = np.flatnonzero((z >= (chance_z(int((all_ >= MIN_TEXTS).sum())) if least_z is None else least_z)) & (z > 0))
    place = np.full(SPACE, -1)
    place[chosen] = np.arange(len(chosen))

    def gather(lists):
        row = np.concatenate([np.zeros(0, dtype=np.int64), *(np.full(len(r), i) for i, r in enumerate(lists))])
        col = place[np.concatenate([np.zeros(0, dtype=np.int64), *lists]).astype(np.int64)]
        return row[col >= 0].astype(np.int64), col[col >= 0]

    r, c = gather(rows)
    changed = [(np.setdiff1d(a, b), np.setdiff1d(b, a)) for a, b in pairs]
    (r1, c1), (r2, c2) = gather([a for a, _ in changed]), gather([b for _, b in changed])
    dr, dc = np.concatenate([r1, r2]), np.concatenate([c1, c2])
    ds = np.concatenate([-np.ones(len(r1)), np.ones(len(r2))])
    m, d = len(y), len(chosen)
    weight = np.full(m, 1 / m)
    per_pair = np.bincount(dr).max() if len(dr) else 0
    slope = 0.25 * (np.bincount(r, minlength=m).max(initial=1) + 1) + 2 * counterfactual * per_pair

    def descend(w: np.ndarray, b: float, free: np.ndarray, l1: float, l2: float) -> tuple[np.ndarray, float]:
        """Accelerated proximal gradient; a step that overshoots is halved."""
        step, t, last, v, u = 4.0 / slope, 1.0, np.inf, w, b
        for _ in range(STEPS):
            f = 1 / (1 + np.exp(-np.clip(np.bincount(r, v[c], m) + u, -40, 40)))
            e = weight * (f - y)
            g = np.bincount(c, e[r], d) + 2 * l2 * v
            loss = -weight @ np.log(np.clip(np.where(y == 1, f, 1 - f), 1e-12, 1)) + l2 * (v @ v)
            if len(dr):
                shift = np.bincount(dr, ds * v[dc], len(pairs))
                g += 2 * counterfactual / len(pairs) * np.bincount(dc, ds * shift[dr], d)
                loss += counterfactual / len(pairs) * float(shift @ shift)
            if loss > last:
                step, t, v, u, last = step / 2, 1.0, w, b, np.inf
                continue
            last = loss
            w_new = v - step * g
            w_new = np.where(free, np.sign(w_new) * np.maximum(np.abs(w_new) - step * l1, 0), 0.0)
            b_new = u - step * float(e.sum())
            t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
            v, u = w_new + (t - 1) / t_new * (w_new - w), b_new + (t - 1) / t_new * (b_new - b)
            w, b, t = w_new, b_new, t_new
        return w, b

    w, b = descend(np.zeros(d), float(np.log(n1 / n0)), np.ones(d, dtype=bool), L1, 0.0)
    w, b = descend(w, b, w != 0, 0.0, L2)
    return ToxicityModel(base=b, weights={int(k): float(x) for k, x in zip(chosen, w) if x})


# --- on Spark ----------------------------------------------------------------------------------

def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch):
            own, other = [], []
            for t in texts_of(part):
                words = words_of(t)
                twin = swapped(words)
                own.append(sorted(feature_set(words)))
                other.append(sorted(feature_set(twin)) if twin != words else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.string()), part.column("y"), pa.array(own, pa.list_(pa.int32())),
                 pa.array(other, pa.list_(pa.int32()))], names=["id", "y", "x", "twin"])


def _only(chosen: list[int]):
    """Feature lists cut down to the chosen features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.zeros(SPACE, dtype=bool)
        keep[chosen] = True
        for batch in batches:
            for part in text_slices(batch):
                cut = [[None if r is None else [f for f in r if keep[f]] for r in part.column(c).to_pylist()]
                       for c in ("x", "twin")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("y"), *(pa.array(c, pa.list_(pa.int32())) for c in cut)],
                    names=["id", "y", "x", "twin"])

    return run


FEATURE_ROWS = "id string, y int, x array<int>, twin array<int>"


def screen(sample: DataFrame) -> tuple[list[int], float]:
    """The features above the level of chance, counted on the executors, and
    that level."""
    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return [], 0.0
    counts = (sample.select("y", F.explode("x").alias("f")).groupBy("f")
              .agg(F.count("*").alias("texts"), F.sum("y").alias("pos")).filter(F.col("texts") >= MIN_TEXTS)).checkpoint()
    level = chance_z(counts.count())
    share = F.col("texts") / (n1 + n0)
    z = F.abs(F.col("pos") / n1 - (F.col("texts") - F.col("pos")) / n0) / F.sqrt(
        F.greatest(share * (1 - share), F.lit(1e-9)) * (1 / n1 + 1 / n0))
    return sorted(r["f"] for r in counts.filter(z >= level).select("f").collect()), level


def train(docs: DataFrame, labels: DataFrame, mod: int = 5, held_out: int = 0,
          per_class: int = SAMPLE_PER_CLASS) -> ToxicityModel:
    """Model from documents outside the held-out remainder.  Features are made
    and screened on the executors; of at most 2 * ``per_class`` texts the
    screened features come to the driver."""
    prepare(docs.sparkSession)
    sample = labelled_sample(docs, labels, "toxic", mod, held_out, per_class).mapInArrow(
        _featurise, FEATURE_ROWS).checkpoint()
    chosen, level = screen(sample)
    got = (sample.mapInArrow(_only(chosen), FEATURE_ROWS).toArrow()
           .combine_chunks().sort_by([("id", "ascending"), ("y", "ascending")]))
    x = [np.asarray(r, dtype=np.int64) for r in _lists(got, "x")]
    twins = _lists(got, "twin")
    pairs = [(a, np.asarray(b, dtype=np.int64)) for a, b in zip(x, twins) if b is not None]
    return fit(x, np.array(got.column("y").to_pylist(), dtype=np.float64), pairs, least_z=level)


def _lists(got: pa.Table, name: str) -> list:
    return [None if not v.is_valid else v.values.to_numpy(zero_copy_only=False) for v in got.column(name)]


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score, predicted) of every row by its whole text; null and empty
    texts get the base score; repeated rows each get a row."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = model.scorer()
        for batch in batches:
            for part in text_slices(batch):
                s = np.array([one(t) for t in texts_of(part)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                    names=["doc_id", "score", "predicted"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def held_out_column(mod: int = 5, held_out: int = 0):
    return (id_crc_mod(F.col("doc_id"), mod) == held_out).alias("held_out")
