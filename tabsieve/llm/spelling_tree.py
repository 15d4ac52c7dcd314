"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

A word is the vector of its letter counts (a-z and U+00C0-U+00FF; any other
letter in one more dimension).  One replaced letter moves one count up and one
down, an L1 distance of 2; one inserted letter moves one count up, a distance
of 1.  So the neighbours of a word lie in a small box around it, and each pair
of lengths (L with L, L with L + 1) is searched by a box-pruned range search:

1. for each length a k-d tree is built on the driver over a sample of at most
   ``SAMPLE_WORDS`` words; it has about one leaf for each ``LEAF_WORDS`` words
   (at most ``MAX_LEAVES`` in all).  Words above ``LONG`` letters share a tree.
2. each word goes to its own leaf as a target, and to each leaf whose box its
   neighbours may reach, as a query.  A leaf with more words than planned is
   cut into blocks by hash, and a query goes to all blocks of a leaf.
3. a task holds the targets of one block, grows a k-d tree over them down to
   ``LOCAL_WORDS``, sends the queries through it by the same pruned search, and
   takes as candidates the vectors at the exact distance.  Their letters are
   then compared in order.

The result is exact whatever the sample; it only decides how even the leaves
are.  Words with the same letter counts cannot be parted by any tree; their
leaf is cut into blocks.

Nulls and odd rows: a null word or one without a count is left out; a word
given twice counts with the sum; no words give no rows.  Null and empty texts
have no words, a null id counts as empty text in the misspelling hash, and
repeated rows count each.  Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsieve.llm.common import prepare

MIN_LETTERS = 7
MIN_COUNT = 2
#: One occurrence in so many, by hash, loses a letter.
MISSPELT = 31
#: A word's form is this many times as frequent.
FORM_RATIO = 10

#: Words above this length share a tree.
LONG = 40
LEAF_WORDS = 16_384
LOCAL_WORDS = 64
SAMPLE_WORDS = 200_000
MAX_LEAVES = 1 << 17
#: Distinct words that a task gathers, and queries searched at a time.
GATHER = 400_000
SLICE = 8_192

_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % MIN_LETTERS)
DIMENSIONS = 26 + 64 + 1
_DIMENSION = np.full(0x110000, DIMENSIONS - 1, dtype=np.uint8)
_DIMENSION[ord("a"):ord("z") + 1] = np.arange(26)
_DIMENSION[0xC0:0x100] = 26 + np.arange(64)


# ---- words of the corpus ----------------------------------------------------

def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                         ["word", "n"])
        counts.clear()

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
            raw = texts[i].as_py()
            if not raw:
                continue
            start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            found = Counter(m[0] for m in _RUN.finditer(raw.lower().decode()))
            for run, n in found.items():
                h = zlib.crc32(run.encode(), start)
                if h % MISSPELT == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                    if len(run) < MIN_LETTERS:
                        continue
                counts[run] += n
            if len(counts) > GATHER:
                yield from flush()
    yield from flush()


def misspelt_words(docs: DataFrame) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, of at least ``MIN_LETTERS``
    code points and ``MIN_COUNT`` occurrences, after one occurrence in
    ``MISSPELT`` (by the hash of id and run) has lost the letter the hash names."""
    prepare(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(_runs, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT))


# ---- vectors and trees ------------------------------------------------------

def code_matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of each word, zero after its end, and lengths."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    out = np.zeros((len(words), int(lengths.max(initial=0))), dtype=np.uint32)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out, lengths


def letter_counts(words: list[str]) -> np.ndarray:
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    cell = np.repeat(np.arange(len(words)) * DIMENSIONS, lengths) + _DIMENSION[flat]
    return np.bincount(cell, minlength=len(words) * DIMENSIONS).reshape(len(words), DIMENSIONS).astype(np.int32)


@dataclass
class Tree:
    """Nodes of a k-d tree: dimension (-1 in a leaf), largest value on the left,
    children; ``leaf`` numbers the leaves from ``first``."""

    dim: list[int]
    split: list[int]
    left: list[int]
    right: list[int]
    leaf: list[int]

    @staticmethod
    def grow(points: np.ndarray, per_leaf: int, first: int = 0) -> tuple["Tree", list[np.ndarray]]:
        """Tree over points and the rows of each leaf; median splits along the
        dimension of the largest variance, until a leaf holds ``per_leaf`` rows
        or equal ones."""
        t, rows_of = Tree([], [], [], [], []), []
        work = [(np.arange(len(points)), -1, False)]
        while work:
            rows, parent, is_right = work.pop()
            node = len(t.dim)
            if parent >= 0:
                (t.right if is_right else t.left)[parent] = node
            t.left.append(-1), t.right.append(-1)
            at = points[rows]
            d = int(at.var(axis=0).argmax()) if len(rows) > per_leaf else -1
            if d >= 0 and at[:, d].min() < at[:, d].max():
                values = np.sort(at[:, d])
                s = int(min(values[(len(values) - 1) // 2], values[-1] - 1))
                t.dim.append(d), t.split.append(s), t.leaf.append(-1)
                below = at[:, d] <= s
                work += [(rows[~below], node, True), (rows[below], node, False)]
            else:
                t.dim.append(-1), t.split.append(0), t.leaf.append(first + len(rows_of))
                rows_of.append(rows)
        return t, rows_of

    def locate(self, points: np.ndarray) -> np.ndarray:
        """Leaf of each point."""
        out = np.empty(len(points), dtype=np.int64)
        work = [(0, np.arange(len(points)))]
        while work:
            node, rows = work.pop()
            if not len(rows):
                continue
            if self.dim[node] < 0:
                out[rows] = self.leaf[node]
                continue
            below = points[rows, self.dim[node]] <= self.split[node]
            work += [(self.left[node], rows[below]), (self.right[node], rows[~below])]
        return out

    def reach(self, points: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of the points) for each leaf whose box holds a vector
        that a point becomes by at most ``up`` counts more and ``down`` less."""
        zero = np.zeros(len(points), dtype=np.int32)
        work = [(0, np.arange(len(points)), zero, zero, {})]
        while work:
            node, rows, ups, downs, box = work.pop()
            if not len(rows):
                continue
            d, s = self.dim[node], self.split[node]
            if d < 0:
                yield self.leaf[node], rows
                continue
            lo, hi = box.get(d, (0, None))
            v = points[rows, d]
            more = downs + np.maximum(0, v - s) - (np.maximum(0, v - hi) if hi is not None else 0)
            ok = more <= down
            work.append((self.left[node], rows[ok], ups[ok], more[ok], {**box, d: (lo, s)}))
            more = ups + np.maximum(0, s + 1 - v) - np.maximum(0, lo - v)
            ok = more <= up
            work.append((self.right[node], rows[ok], more[ok], downs[ok], {**box, d: (s + 1, hi)}))


def _group(length: int) -> int:
    return min(length, LONG + 1)


def grow_trees(words: DataFrame, leaf_words: int, sample_words: int) -> dict[int, Tree]:
    """A tree for each length that occurs, from a sample by hash."""
    group = F.least(F.length("word"), F.lit(LONG + 1))
    size = {r["g"]: r["n"] for r in words.groupBy(group.alias("g")).agg(F.count("*").alias("n")).collect()}
    total = max(1, sum(size.values()))
    slots = 1 << 20
    share = min(slots, max(1, slots * sample_words // total))
    rows = words.filter(F.pmod(F.xxhash64("word"), F.lit(slots)) < share)
    rows = rows.select("word").limit(2 * sample_words).toPandas()["word"]
    trees, first = {}, 0
    by_group: dict[int, list[str]] = {}
    for w in sorted(rows):
        by_group.setdefault(_group(len(w)), []).append(w)
    for g, n in sorted(size.items()):
        sample = by_group.get(g, [])
        leaves = max(1, min(-(-n // leaf_words), MAX_LEAVES * n // total))
        trees[g], parts = Tree.grow(letter_counts(sample), max(1, -(-len(sample) // leaves)), first)
        first += len(parts)
    return trees


# ---- search -----------------------------------------------------------------

TARGET, SAME, SHORTER = 0, 1, 2
_ROUTED = ["leaf", "block", "kind", "word", "n"]


def _route(trees: dict[int, Tree], blocks: np.ndarray | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Without ``blocks`` the leaf of each word; with them each word as target
    and as queries."""
    for batch in batches:
        words = np.array(batch.column("word").to_pylist(), dtype=object)
        count = batch.column("n").to_numpy(zero_copy_only=False)
        spread = batch.column("spread").to_numpy(zero_copy_only=False)
        groups = np.fromiter((_group(len(w)) for w in words), dtype=np.int64, count=len(words))
        vectors = letter_counts(words.tolist())
        for g in np.unique(groups).tolist():
            mine = np.flatnonzero(groups == g)
            points = vectors[mine]
            home = trees[g].locate(points)
            if blocks is None:
                yield pa.RecordBatch.from_arrays([pa.array(home, pa.int64())], ["leaf"])
                continue
            yield _routed(home, spread[mine] % blocks[home], TARGET, words[mine], count[mine])
            for kind, to, up, down in ((SAME, g, 1, 1), (SHORTER, min(g + 1, LONG + 1), 1, 0)):
                if to not in trees:
                    continue
                for leaf, rows in trees[to].reach(points, up, down):
                    at = mine[rows]
                    for b in range(blocks[leaf]):
                        yield _routed(np.full(len(at), leaf), np.full(len(at), b), kind, words[at], count[at])


def _routed(leaf: np.ndarray, block: np.ndarray, kind: int, words: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(leaf, pa.int64()), pa.array(block, pa.int64()),
                                       pa.array(np.full(len(words), kind), pa.int64()), pa.array(words.tolist(), pa.string()),
                                       pa.array(n, pa.int64())], _ROUTED)


def one_edit(x: np.ndarray, x_len: np.ndarray, y: np.ndarray, y_len: np.ndarray) -> np.ndarray:
    """For rows of code points: does y differ from x by one replaced code point
    (equal lengths) or one inserted one (y longer by one)?"""
    width = max(x.shape[1], y.shape[1]) + 1
    x, y = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, y))
    differ = x != y
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    replaced = differ.sum(axis=1) == 1
    after = np.arange(width - 1) >= first[:, None]
    inserted = ~((x[:, :-1] != y[:, 1:]) & after).any(axis=1)
    return np.where(x_len == y_len, replaced, (y_len == x_len + 1) & inserted)


class _Block:
    """Targets of one block under a k-d tree."""

    def __init__(self, words: list[str], n: np.ndarray):
        order = sorted(range(len(words)), key=words.__getitem__)
        self.words = [words[i] for i in order]
        self.n = n[order]
        self.codes, self.lengths = code_matrix(self.words)
        self.points = letter_counts(self.words)
        self.tree, self.rows = Tree.grow(self.points, LOCAL_WORDS)
        self.floats = [self.points[r].astype(np.float32) for r in self.rows]
        self.norms = [np.einsum("ij,ij->i", f, f) for f in self.floats]

    def near(self, words: list[str], kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of ``words``, target) one edit apart.  At the wanted
        distance, one step along one or two dimensions, the squared distance
        is 1 or 2; small whole numbers are exact in single precision."""
        points = letter_counts(words)
        floats = points.astype(np.float32)
        norms = np.einsum("ij,ij->i", floats, floats)
        wanted = 2 if kind == SAME else 1
        found = []
        for leaf, rows in self.tree.reach(points, 1, 1 if kind == SAME else 0):
            between = norms[rows][:, None] + self.norms[leaf][None, :] - 2 * floats[rows] @ self.floats[leaf].T
            near = between == wanted
            if kind == SAME:  # letters beyond the alphabet share a dimension: a replaced one leaves the vector as it is
                near |= (between == 0) & (points[rows, -1] > 0)[:, None]
            q, t = np.nonzero(near)
            found.append((rows[q], self.rows[leaf][t]))
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        q, t = (np.concatenate(x) for x in zip(*found))
        codes, lengths = code_matrix(words)
        keep = [np.zeros(0, dtype=np.int64)]
        for at in range(0, len(q), 1 << 18):
            part = slice(at, at + (1 << 18))
            keep.append(at + np.flatnonzero(one_edit(codes[q[part]], lengths[q[part]], self.codes[t[part]], self.lengths[t[part]])))
        kept = np.concatenate(keep)
        return q[kept], t[kept]


def _summary(of: np.ndarray, words: list[str], others: list[str], other_n: np.ndarray, other: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row a word with neighbours: their number, the most frequent one."""
    if not len(of):
        return
    by_name = np.empty(len(others), dtype=np.int64)
    by_name[sorted(range(len(others)), key=others.__getitem__)] = np.arange(len(others))
    order = np.lexsort((by_name[other], -other_n[other], of))
    of, other = of[order], other[order]
    at = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    yield pa.RecordBatch.from_arrays(
        [pa.array([words[i] for i in of[at]], pa.string()), pa.array(np.diff(np.r_[at, len(of)]), pa.int64()),
         pa.array(-other_n[other[at]], pa.int64()), pa.array([others[i] for i in other[at]], pa.string())],
        ["word", "n_near", "minus_n", "form"])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by leaf, block and kind: targets first."""
    key, words, counts, block = None, [], [], None
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            ids = np.stack([part.column(c).to_numpy(zero_copy_only=False) for c in ("leaf", "block", "kind")])
            cuts = [0, *(np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1).tolist(), part.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                leaf, number, kind = ids[:, lo].tolist()
                if (leaf, number) != key:
                    key, words, counts, block = (leaf, number), [], [], None
                row = part.slice(lo, hi - lo)
                w, n = row.column("word").to_pylist(), row.column("n").to_numpy(zero_copy_only=False)
                if kind == TARGET:
                    words += w
                    counts.append(n)
                    continue
                if not words:
                    continue
                block = block or _Block(words, np.concatenate(counts))
                q, t = block.near(w, kind)
                yield from _summary(q, w, block.words, block.n, t)
                if kind == SHORTER:
                    yield from _summary(t, block.words, w, n, q)


def neighbours(words: DataFrame, leaf_words: int = LEAF_WORDS, sample_words: int = SAMPLE_WORDS) -> DataFrame:
    """(word, n_near, form, form_n) of every word (word, n; unique) with a word
    one edit away: their number, the most frequent of them (ties: the smallest)
    and its count."""
    spark = words.sparkSession
    trees = grow_trees(words, leaf_words, sample_words)
    spread = words.select("word", "n", F.pmod(F.xxhash64("word", F.lit("block")), F.lit(1 << 30)).alias("spread"))
    n_leaves = 1 + max((x for t in trees.values() for x in t.leaf), default=-1)
    shared = spark.sparkContext.broadcast(trees)
    loads = (spread.mapInArrow(lambda b: _route(shared.value, None, b), "leaf long").groupBy("leaf").count().toPandas())
    blocks = np.ones(max(1, n_leaves), dtype=np.int64)
    blocks[loads["leaf"].to_numpy(dtype=np.int64)] = -(-loads["count"].to_numpy(dtype=np.int64) // leaf_words)
    blocks = np.maximum(blocks, 1)
    plan = spark.sparkContext.broadcast(blocks)
    routed = spread.mapInArrow(lambda b: _route(shared.value, plan.value, b), "leaf long, block long, kind long, word string, n long")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(blocks.sum()))
    found = (routed.repartition(parts, "leaf", "block").sortWithinPartitions("leaf", "block", "kind")
             .mapInArrow(_search, "word string, n_near long, minus_n long, form string"))
    best = F.min(F.struct("minus_n", "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.minus_n")).alias("form_n"))


def variants(words: DataFrame, ratio: int = FORM_RATIO, leaf_words: int = LEAF_WORDS,
             sample_words: int = SAMPLE_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word: ``n_near`` words
    one edit away; ``form`` the most frequent of them if it has ``ratio`` times
    the word's count, else null; ``root`` the last word along the forms."""
    spark = words.sparkSession
    prepare(spark)
    words = words.filter("word is not null and n is not null").groupBy("word").agg(F.sum("n").alias("n")).checkpoint()
    if words.isEmpty():
        return spark.createDataFrame([], "word string, form string, root string, n long, n_near long, form_n long")
    near = words.join(neighbours(words, leaf_words, sample_words), "word", "left")
    is_form = F.col("form_n") >= ratio * F.col("n")
    out = near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("form")).alias("form"),
                      F.when(is_form, F.col("form_n")).alias("form_n")).checkpoint()
    roots = _roots(out.filter("form is not null").select("word", "form"))
    return (out.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form.  Each step along a form
    multiplies the count, so the walk ends after a few rounds; a round moves
    only the words that are not at their root yet."""
    step = forms.select(F.col("word").alias("at"), F.col("form").alias("next"))
    moving, done = forms.select("word", F.col("form").alias("at")), []
    while True:
        walked = moving.join(step, "at", "left").checkpoint()
        done.append(walked.filter("next is null").select("word", F.col("at").alias("root")))
        moving = walked.filter("next is not null").select("word", F.col("next").alias("at"))
        if moving.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
