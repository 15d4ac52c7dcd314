"""Language identification by a byte convolutional network in numpy.

A text's UTF-8 bytes are cut into windows of ``window`` bytes (the last one
padded with zero bytes).  Each byte has a learned vector; filters of several
widths run over the window, the largest value of each filter (never below
zero) is its feature, and a softmax layer gives language probabilities.  A
text's probabilities are the mean over all its windows, weighted by the bytes
they hold.  Training is Adam on cross-entropy over windows of labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsieve.functions.ranks import checked_broadcast
from tabsieve.llm.common import id_crc_mod, prepare, text_slices, texts_of

WINDOW = 128
VECTOR = 8
#: Filters of each width.
FILTERS = {2: 8, 3: 12, 4: 12}
#: Training windows of each language, at most, and of all languages together
#: (but at least one of each).
WINDOWS_PER_LANGUAGE = 3_000
TRAINING_WINDOWS = 60_000
EPOCHS = 6
UNKNOWN = "und"
#: Windows that go through the network at once.
BATCH_WINDOWS = 64


def windows_of(raw: bytes, window: int = WINDOW) -> np.ndarray:
    """(windows, window) bytes of a text; an empty text is one window of zeros."""
    n = max(1, -(-len(raw) // window))
    out = np.zeros(n * window, dtype=np.uint8)
    out[:len(raw)] = np.frombuffer(raw, dtype=np.uint8)
    return out.reshape(n, window)


@dataclass
class ByteConvNet:
    languages: list[str]
    embed: np.ndarray                 # (256, VECTOR)
    filters: dict[int, np.ndarray]    # width -> (width * VECTOR, filters)
    bias: dict[int, np.ndarray]
    out: np.ndarray                   # (features, languages)
    out_bias: np.ndarray

    @classmethod
    def start(cls, languages: list[str], seed: int = 7) -> "ByteConvNet":
        rng = np.random.default_rng(seed)
        f32 = lambda *shape, scale=1.0: (rng.standard_normal(shape) * scale).astype(np.float32)
        total = sum(FILTERS.values())
        return cls(languages, f32(256, VECTOR, scale=0.5),
                   {w: f32(w * VECTOR, n, scale=(w * VECTOR) ** -0.5) for w, n in FILTERS.items()},
                   {w: np.zeros(n, dtype=np.float32) for w, n in FILTERS.items()},
                   f32(total, len(languages), scale=total ** -0.5), np.zeros(len(languages), dtype=np.float32))

    def pair_tables(self) -> dict[int, list[np.ndarray]]:
        """Per width the filters' share of each byte pair (65,536 rows), two
        bytes of the filter at a time: a filter's value is then a sum of one or
        two looked-up rows, the last one a single byte's where the width is odd."""
        out = {}
        for w, k in self.filters.items():
            one = [self.embed @ k[i * VECTOR:(i + 1) * VECTOR] for i in range(w)]
            out[w] = [(one[i][:, None] + one[i + 1][None]).reshape(1 << 16, -1) for i in range(0, w - 1, 2)]
            if w % 2:
                out[w].append(one[-1])
        return out

    def pooled(self, x: np.ndarray, tables: dict[int, list[np.ndarray]]) -> np.ndarray:
        """Same as `_features`, by table lookups."""
        single = x.astype(np.intp)
        pair = single[:, :-1] << 8 | single[:, 1:]
        out = []
        for w in self.filters:
            m = x.shape[1] - w + 1
            y = None
            for i, t in enumerate(tables[w]):
                at = (pair if len(t) > 256 else single)[:, 2 * i:2 * i + m]
                y = t.take(at, axis=0) if y is None else np.add(y, t.take(at, axis=0), out=y)
            out.append(np.maximum(y.max(axis=1) + self.bias[w], 0))
        return np.concatenate(out, axis=1)

    def _features(self, x: np.ndarray, keep: list) -> np.ndarray:
        """(windows, features): pooled filter values; ``keep`` gathers what the
        backward pass wants."""
        v = self.embed[x]                                            # (n, window, VECTOR)
        n, length, _ = v.shape
        out = []
        for w, k in self.filters.items():
            m = length - w + 1
            cols = np.concatenate([v[:, i:i + m] for i in range(w)], axis=2).reshape(n * m, w * VECTOR)
            y = (cols @ k).reshape(n, m, -1)
            at = y.argmax(axis=1)
            top = np.take_along_axis(y, at[:, None, :], axis=1)[:, 0] + self.bias[w]
            out.append(np.maximum(top, 0))
            keep.append((w, cols.reshape(n, m, -1), at, top > 0))
        return np.concatenate(out, axis=1)

    def probabilities(self, x: np.ndarray, tables: dict | None = None) -> np.ndarray:
        return _softmax(self.pooled(x, tables or self.pair_tables()) @ self.out + self.out_bias)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 3e-3, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        moments: dict = {}
        step = 0
        for epoch in range(epochs):
            lr = rate * (1 - 0.8 * epoch / max(1, epochs - 1))
            order = rng.permutation(len(x))
            for at in range(0, len(x), 64):
                rows = order[at:at + 64]
                step += 1
                self._adam(self._gradients(x[rows], y[rows]), moments, step, lr)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict:
        keep: list = []
        features = self._features(x, keep)
        p = _softmax(features @ self.out + self.out_bias)
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        grads = {("out",): features.T @ p, ("out_bias",): p.sum(axis=0)}
        back = p @ self.out.T
        embed = np.zeros_like(self.embed)
        rows = np.arange(len(x))[:, None]
        at_feature = 0
        for w, cols, at, alive in keep:
            k = self.filters[w]
            d = back[:, at_feature:at_feature + k.shape[1]] * alive     # (n, filters)
            at_feature += k.shape[1]
            picked = cols[rows, at]                                     # (n, filters, w * VECTOR)
            grads[("filters", w)] = np.einsum("nf,nfc->cf", d, picked)
            grads[("bias", w)] = d.sum(axis=0)
            to_bytes = d[:, :, None] * k.T[None]                        # (n, filters, w * VECTOR)
            for i in range(w):
                np.add.at(embed, x[rows, at + i], to_bytes[:, :, i * VECTOR:(i + 1) * VECTOR])
        grads[("embed",)] = embed
        return grads

    def _adam(self, grads: dict, moments: dict, step: int, lr: float) -> None:
        for key, g in grads.items():
            m, s = moments.setdefault(key, (np.zeros_like(g), np.zeros_like(g)))
            m = 0.9 * m + 0.1 * g
            s = 0.999 * s + 0.001 * g * g
            moments[key] = (m, s)
            move = (lr * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
            if len(key) == 1:
                setattr(self, key[0], getattr(self, key[0]) - move)
            else:
                getattr(self, key[0])[key[1]] -= move

    def predict(self, texts: list[str], tables: dict | None = None) -> tuple[list[str], list[float]]:
        """Language and its probability of whole texts; `und` and 0 for a text
        without letters.  Windows of many texts share batches; of a long text
        only one batch is held."""
        labels = [UNKNOWN] * len(texts)
        scores = [0.0] * len(texts)
        if not self.languages:
            return labels, scores
        tables = tables or self.pair_tables()
        total = np.zeros((len(texts), len(self.languages)))
        pending, owners, weights, held = [], [], [], 0

        def run():
            nonlocal pending, owners, weights, held
            if pending:
                p = self.probabilities(np.concatenate(pending), tables)
                np.add.at(total, np.concatenate(owners), p * np.concatenate(weights)[:, None])
            pending, owners, weights, held = [], [], [], 0

        known = []
        for i, t in enumerate(texts):
            if not any(map(str.isalpha, t)):
                continue
            known.append(i)
            raw = t.encode("utf-8", "surrogatepass")
            grid = windows_of(raw)
            size = np.full(len(grid), float(WINDOW))
            size[-1] = len(raw) - WINDOW * (len(grid) - 1)
            for at in range(0, len(grid), BATCH_WINDOWS):
                pending.append(grid[at:at + BATCH_WINDOWS])
                weights.append(size[at:at + BATCH_WINDOWS])
                owners.append(np.full(len(pending[-1]), i))
                held += len(pending[-1])
                if held >= BATCH_WINDOWS:
                    run()
        run()
        for i in known:
            best = int(total[i].argmax())
            labels[i], scores[i] = self.languages[best], min(1.0, float(total[i, best] / total[i].sum()))
        return labels, scores


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


# --- on Spark ----------------------------------------------------------------------------------

def training_windows(docs: DataFrame, mod: int = 5, held_out: int = 0,
                     per_language: int = WINDOWS_PER_LANGUAGE) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, windows and labels to learn from: at most ``per_language``
    windows of each non-null language of documents outside the held-out
    remainder, fewer where ``TRAINING_WINDOWS`` are shared by many languages.
    Documents and the windows of a text are taken by hash, so the choice is the
    same on every run."""
    prepare(docs.sparkSession)
    rows = (docs.select("doc_id", "text", "lang")
            .filter("lang is not null and text is not null")
            .filter(id_crc_mod(F.col("doc_id"), mod) != held_out))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).checkpoint()
    n_languages = counts.count()
    per_language = max(1, min(per_language, TRAINING_WINDOWS // max(1, n_languages)))
    per_text = 3
    # expected number of texts: enough for per_language windows, some more of rare languages
    share = F.least(F.lit(1.0), (1.5 * per_language + 20) / F.col("n"))
    # one row a language, broadcast when counted small, so texts stay where they are
    chosen = (rows.join(checked_broadcast(counts), "lang").filter(
        F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_003)) < share * 1_000_003))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for part in text_slices(batch):
                lang, order, window = [], [], []
                for t, name in zip(texts_of(part), part.column("lang").to_pylist()):
                    raw = t.encode("utf-8", "surrogatepass")
                    if not any(map(str.isalpha, t)):
                        continue
                    grid = windows_of(raw)
                    for k in range(min(per_text, len(grid))):
                        h = xxhash.xxh64_intdigest(raw, seed=k) >> 1
                        lang.append(name)
                        order.append(h)
                        window.append(grid[h % len(grid)].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lang, pa.string()), pa.array(order, pa.int64()), pa.array(window, pa.binary())],
                    names=["lang", "h", "window"])

    found = chosen.select("text", "lang").mapInArrow(run, "lang string, h bigint, window binary")
    # a sample of bounded size for each language
    first = Window.partitionBy("lang").orderBy("h", "window")
    got = (found.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= per_language)
           .select("lang", "place", "window").toPandas().sort_values(["lang", "place"]))
    languages = sorted(r["lang"] for r in counts.select("lang").collect())
    number = {lang: i for i, lang in enumerate(languages)}
    labels = np.array([number[x] for x in got["lang"]], dtype=np.int64)
    return languages, np.frombuffer(b"".join(got["window"]), dtype=np.uint8).reshape(-1, WINDOW), labels


def train(docs: DataFrame, mod: int = 5, held_out: int = 0) -> ByteConvNet:
    """Network fitted to `training_windows`; without any it knows no language
    and answers `und`."""
    languages, x, y = training_windows(docs, mod, held_out)
    net = ByteConvNet.start(languages)
    if len(x):
        net.fit(x, y)
    return net


def identify(docs: DataFrame, net: ByteConvNet) -> DataFrame:
    """(doc_id, lang_pred, score) of every row by its whole text: `und` with
    score 0 where the text is null or holds no letter.  Repeated rows each get
    a row; other columns are not read."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.pair_tables()
        for batch in batches:
            for part in text_slices(batch):
                lang, score = net.predict(texts_of(part), tables)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lang, pa.string()),
                                                  pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def held_out_column(mod: int = 5, held_out: int = 0):
    return (id_crc_mod(F.col("doc_id"), mod) == held_out).alias("held_out")
