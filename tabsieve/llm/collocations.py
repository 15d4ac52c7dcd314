"""Collocations: phrases of two or three words that occur together more often
than their parts would suggest.

Counting is by direct address.  Frequent words get ids by rank; a pair of ids
is a cell of a matrix cut into tiles of ``TILE`` x ``TILE`` cells, so the top
left tiles hold most of all occurrences.  A task counts a well-filled tile with
one dense ``bincount`` and all others as sorted coordinates; Spark adds up the
cells of all tasks.  Frequent pairs are ranked in their turn, and triples are
cells of (pair rank, word id), counted in the same way.

Only a phrase whose parts are all frequent can be frequent, so words and pairs
under ``min_count`` are no part of a cell.  Ids are held by every task: at most
``head_words`` words (of ``MAX_WORD_BYTES``) and ``head_pairs`` pairs, the most
frequent ones.  Where more are frequent, phrases beyond the ids are counted by
their words, so the result is the same whatever these bounds.

Each language is its own corpus; a null language counts as ``und``.  Null and
empty texts have no words.  Repeated rows, also of one id, count each.  Texts
are read in slices of ``SLICE_BYTES``, which overlap by the words that a phrase
needs.  Only the columns ``text`` and ``lang`` are read, so others may have any
name.  An empty table has no phrases.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsieve.llm.common import prepare
from tabsieve.session import shuffle_partitions

MIN_COUNT = 10
#: A longer candidate with this share (percent) of a phrase's count takes its place.
COVERED_PERCENT = 50
TOP = 2_000
SCALE = 1_000_000
#: Words and pairs that get ids; more frequent ones are counted by their words.
HEAD_WORDS = 1 << 19
HEAD_PAIRS = 1 << 21
MAX_WORD_BYTES = 64
TILE = 1 << 10
#: Occurrences from which a tile is counted densely.
DENSE = TILE * TILE // 64
#: Occurrences counted at a time, bytes of a text read at a time and distinct
#: words that a task gathers.
BUFFER = 1 << 20
SLICE_BYTES = 1 << 20
GATHER = 150_000

BREAK, UNKNOWN = -1, -2
_STOP = b"."
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t",
                        b"abcdefghijklmnopqrstuvwxyz" + _STOP * 10 + b" ")


def token_slices(raw: bytes, overlap: int, size: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """Words of a text in order, a full stop for each end of a piece; a slice
    begins with the last ``overlap`` tokens of the one before."""
    folded = raw.translate(_FOLD)
    at, carry = 0, []
    while at < len(folded):
        end = at + size
        if end < len(folded):
            cut = max(folded.rfind(b" ", at, end), folded.rfind(_STOP, at, end))
            if cut <= at:
                after = [x for x in (folded.find(b" ", end), folded.find(_STOP, end)) if x >= 0]
                cut = min(after, default=len(folded) - 1)
            end = cut + 1
        tokens = folded[at:end].replace(_STOP, b" . ").split()
        yield carry + tokens
        carry = (carry + tokens)[-overlap:] if overlap else []
        at = end


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    texts = batch.column("text").cast(pa.binary())
    for i, lang in enumerate(batch.column("lang").to_pylist()):
        yield lang, texts[i].as_py() or b""


def _utf8(words: list[bytes | None]) -> pa.Array:
    return pa.array(words, type=pa.binary()).cast(pa.string())


# ---- words ------------------------------------------------------------------

def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, c in counts.items():
            c.pop(_STOP, None)
            words, n = list(c), list(c.values())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(n) + 1), pa.string()), _utf8([*words, None]),
                                              pa.array([*n, sum(n)], pa.int64())], ["lang", "word", "n"])
        counts.clear()

    for batch in batches:
        for lang, raw in _texts(batch):
            for tokens in token_slices(raw, 0):
                counts[lang].update(tokens)
                if sum(map(len, counts.values())) > GATHER:
                    yield from flush()
    yield from flush()


def word_counts(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, word, n) of the frequent words, and a row of a null word with
    the number of all words for each language."""
    counted = docs.mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return counted.filter((F.col("n") >= min_count) | F.col("word").isNull()).checkpoint()


def most_frequent(table: DataFrame, bound: int) -> tuple[DataFrame, bool]:
    """Rows of a table with counts ``n`` that fit the bound, by steps of the
    logarithm of the count, the most frequent first, and whether these are all.
    The driver sees one row a step (32 to a doubling)."""
    step = F.floor(F.log2("n") * 32)
    sizes = table.groupBy(step.alias("step")).count().collect()
    total, lowest = 0, None
    for row in sorted(sizes, key=lambda r: -r["step"]):
        if total + row["count"] > bound:
            break
        total, lowest = total + row["count"], row["step"]
    chosen = table.filter(step >= lowest) if lowest is not None else table.limit(0)
    return chosen, total == sum(r["count"] for r in sizes)


# ---- cells ------------------------------------------------------------------

def tile_cells(rows: np.ndarray, cols: np.ndarray, n_cols: int, dense: int = DENSE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, count) of the cells that occur: full tiles by dense
    bincount, the others as sorted coordinates."""
    rows, cols = rows.astype(np.int64, copy=False), cols.astype(np.int64, copy=False)
    across = n_cols // TILE + 1
    tile = (rows // TILE) * across + cols // TILE
    ids, size = np.unique(tile, return_counts=True)
    full = ids[size >= dense]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    in_full = np.isin(tile, full)
    order = np.flatnonzero(in_full)
    order = order[np.argsort(tile[order], kind="stable")]
    for part in np.split(order, np.cumsum(size[size >= dense])[:-1]) if len(full) else []:
        r0, c0 = rows[part[0]] // TILE * TILE, cols[part[0]] // TILE * TILE
        counts = np.bincount((rows[part] - r0) * TILE + (cols[part] - c0), minlength=TILE * TILE)
        cell = np.flatnonzero(counts)
        found.append(((cell // TILE + r0) * n_cols + cell % TILE + c0, counts[cell]))
    found.append(np.unique(rows[~in_full] * n_cols + cols[~in_full], return_counts=True))
    code, n = (np.concatenate(x) for x in zip(*found))
    return code // n_cols, code % n_cols, n


class Ids:
    """Word ids by rank and pair ranks, as the tasks hold them."""

    def __init__(self, head: pa.Table, all_words: bool):
        self.all_words = all_words
        self.size = max(1, len(head))
        self.of: dict[str, dict[bytes, int]] = defaultdict(dict)
        at = 0
        for batch in head.select(["lang", "word"]).to_batches(max_chunksize=1 << 14):
            words = batch.column("word").cast(pa.binary()).to_pylist()
            for i, (lang, word) in enumerate(zip(batch.column("lang").to_pylist(), words), at):
                self.of[lang][word] = i
            at += batch.num_rows
        self.of = dict(self.of)
        self.pair_codes = self.pair_ranks = np.zeros(0, dtype=np.int64)
        self.all_pairs = False

    def set_pairs(self, pairs: pa.Table, all_pairs: bool) -> None:
        code = pairs.column("id1").to_numpy().astype(np.int64) * self.size + pairs.column("id2").to_numpy()
        code = code[np.lexsort((code, -pairs.column("n").to_numpy()))]
        self.code_of_rank = code  # the most frequent first
        order = np.argsort(code)
        self.pair_codes, self.pair_ranks, self.all_pairs = code[order], order.astype(np.int32), all_pairs

    def encode(self, lang: str, tokens: list[bytes]) -> np.ndarray:
        get = self.of.get(lang, {}).get
        out = np.fromiter((get(t, UNKNOWN) for t in tokens), dtype=np.int64, count=len(tokens))
        if not self.all_words:  # a stop is unknown too
            out[np.fromiter((t == _STOP for t in tokens), dtype=bool, count=len(tokens))] = BREAK
        return out

    def ranks(self, code: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 for those without one."""
        if not len(self.pair_codes):
            return np.full(len(code), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.pair_codes, code), len(self.pair_codes) - 1)
        # 64 bits: a rank times the number of words passes 32
        return np.where(self.pair_codes[at] == code, self.pair_ranks[at].astype(np.int64), -1)


def _phrases(ids: Ids, words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells and, beyond the ids, phrases by their words: columns id1..,
    lang, word1.., n."""
    flat: list[np.ndarray] = []
    held = 0
    by_words: Counter = Counter()
    names = [*(f"id{k + 1}" for k in range(words)), "lang", *(f"word{k + 1}" for k in range(words)), "n"]

    def cells() -> Iterator[pa.RecordBatch]:
        x = np.concatenate(flat) if flat else np.zeros(0, dtype=np.int64)
        flat.clear()
        known = np.ones(max(0, len(x) - words + 1), dtype=bool)
        for k in range(words):
            known &= x[k:len(known) + k] >= 0
        at = np.flatnonzero(known)
        if words == 2:
            a, b, n = tile_cells(x[at], x[at + 1], ids.size)
            yield from batch_of([a, b], n)
            return
        first, second = ids.ranks(x[at] * ids.size + x[at + 1]), ids.ranks(x[at + 1] * ids.size + x[at + 2])
        both = (first >= 0) & (second >= 0)
        rank, c, n = tile_cells(first[both], x[at[both] + 2], ids.size)
        if len(n):
            pair = ids.code_of_rank[rank]
            yield from batch_of([pair // ids.size, pair % ids.size, c], n)
        if not ids.all_pairs:  # pairs without a rank may be frequent: plain sorted coordinates
            rest = at[~both]
            if len(rest):
                triple, n = np.unique(np.stack([x[rest + k] for k in range(3)]), axis=1, return_counts=True)
                yield from batch_of(list(triple), n)

    def batch_of(cell: list[np.ndarray], n: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(n):
            nothing = pa.nulls(len(n), pa.string())
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in cell), nothing, *[nothing] * words,
                                              pa.array(n, pa.int64())], names)

    def spelled() -> Iterator[pa.RecordBatch]:
        if by_words:
            keys, n = list(by_words), list(by_words.values())
            nothing = pa.nulls(len(n), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*[nothing] * words, pa.array([k[0] for k in keys], pa.string()),
                 *(_utf8([k[i + 1] for k in keys]) for i in range(words)), pa.array(n, pa.int64())], names)
            by_words.clear()

    for batch in batches:
        for lang, raw in _texts(batch):
            for tokens in token_slices(raw, words - 1):
                x = ids.encode(lang, tokens)
                flat += [x, np.array([BREAK])]
                held += len(x) + 1
                if not ids.all_words and len(x) >= words:
                    windows = np.lib.stride_tricks.sliding_window_view(x, words)
                    for i in np.flatnonzero((windows == UNKNOWN).any(axis=1) & (windows != BREAK).all(axis=1)).tolist():
                        by_words[(lang, *tokens[i:i + words])] += 1
                    if len(by_words) > GATHER:
                        yield from spelled()
                if held > BUFFER:
                    yield from cells()
                    held = 0
    yield from cells()
    yield from spelled()


def _count_phrases(docs: DataFrame, ids: Ids, words: int, min_count: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(ids)
    names = [*(f"id{k + 1}" for k in range(words)), "lang", *(f"word{k + 1}" for k in range(words))]
    schema = ", ".join(f"{c} {'int' if c.startswith('id') else 'string'}" for c in names) + ", n long"
    counted = docs.mapInArrow(lambda batches: _phrases(shared.value, words, batches), schema)
    done = counted.groupBy(*names).agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count).checkpoint()
    shared.unpersist()
    return done


# ---- scores -----------------------------------------------------------------

def _spell(cells: DataFrame, head: DataFrame, words: DataFrame, k: int, all_words: bool) -> DataFrame:
    """Phrases with their words and the counts f1.. of these.  The id table is
    of bounded size; words beyond it are joined by key."""
    known = cells.filter("id1 is not null").drop("lang", *(f"word{i + 1}" for i in range(k)))
    for i in range(1, k + 1):
        side = F.broadcast(head.select(F.col("id").alias(f"id{i}"), F.col("lang").alias(f"lang{i}"),
                                       F.col("word").alias(f"word{i}"), F.col("n").alias(f"f{i}")))
        known = known.join(side, f"id{i}")
    known = known.withColumnRenamed("lang1", "lang")
    columns = ["lang", *(f"word{i}" for i in range(1, k + 1)), *(f"f{i}" for i in range(1, k + 1)), "n"]
    if all_words:
        return known.select(columns)
    spelled = cells.filter("id1 is null")
    rare = words.join(F.broadcast(head.select("lang", "word")), ["lang", "word"], "left_anti")
    for i in range(1, k + 1):
        often = F.broadcast(head.select("lang", F.col("word").alias(f"word{i}"), F.col("n").alias(f"h{i}")))
        other = rare.select("lang", F.col("word").alias(f"word{i}"), F.col("n").alias(f"r{i}"))
        spelled = (spelled.join(often, ["lang", f"word{i}"], "left").join(other, ["lang", f"word{i}"], "left")
                   .withColumn(f"f{i}", F.coalesce(f"h{i}", f"r{i}")))
    return known.select(columns).unionByName(spelled.select(columns))


def score_of(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)) in whole numbers of 38 digits: counts may have 15."""
    whole = lambda c: c.cast("decimal(15,0)")
    square = (F.lit(SCALE).cast("decimal(7,0)") * (whole(a) * whole(a))).cast("decimal(38,0)")
    product = (whole(left) * whole(right)).cast("decimal(30,0)")
    return F.call_function("div", square, product).cast("long")


def collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT, covered_percent: int = COVERED_PERCENT,
                 head_words: int = HEAD_WORDS, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of
    each language by score, count and phrase (in byte order).

    ``a`` is the phrase's count; l and r are the counts of the parts at the cut
    with the lowest score, the first such cut on a tie; n counts all words of
    the language.  A phrase within a longer candidate that has
    ``covered_percent`` of its count is left out."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    counted = word_counts(docs, min_count)
    words = counted.filter("word is not null")
    short, all_short = most_frequent(words.filter(F.octet_length("word") <= MAX_WORD_BYTES), head_words)
    n_short = short.count()
    all_words = all_short and n_short == words.count()
    table = short.toArrow().sort_by([("n", "descending"), ("lang", "ascending"), ("word", "ascending")])
    ids = Ids(table, all_words)
    head = spark.createDataFrame(table.append_column("id", pa.array(np.arange(len(table)), pa.int32()))).checkpoint()
    del table

    pair_cells = _count_phrases(docs, ids, 2, min_count)
    ranked, all_ranked = most_frequent(pair_cells.filter("id1 is not null").select("id1", "id2", "n"), head_pairs)
    ids.set_pairs(ranked.toArrow(), all_ranked)
    triple_cells = _count_phrases(docs, ids, 3, min_count)
    del ids

    pairs = _spell(pair_cells, head, words, 2, all_words)
    triples = _spell(triple_cells, head, words, 3, all_words)
    found = _scored(pairs.checkpoint(), triples.checkpoint(), covered_percent)
    totals = counted.filter("word is null").select("lang", F.col("n").alias("all"))
    return (_first(found, top).join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("all").alias("n"), "score"))


def _scored(pairs: DataFrame, triples: DataFrame, covered_percent: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) of all candidates that no longer one covers."""
    longer = (triples.select("lang", "word1", "word2", "n")
              .unionByName(triples.select("lang", F.col("word2").alias("word1"), F.col("word3").alias("word2"), "n"))
              .groupBy("lang", "word1", "word2").agg(F.max("n").alias("longer")))
    two = (pairs.join(longer, ["lang", "word1", "word2"], "left")
           .filter(F.col("longer").isNull() | (100 * F.col("longer") < covered_percent * F.col("n")))
           .select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), F.col("n").alias("a"),
                   F.col("f1").alias("l"), F.col("f2").alias("r")).withColumn("score", score_of(F.col("a"), F.col("l"), F.col("r"))))
    front = pairs.select("lang", "word1", "word2", F.col("n").alias("f12"))
    back = pairs.select("lang", F.col("word1").alias("word2"), F.col("word2").alias("word3"), F.col("n").alias("f23"))
    cuts = (triples.join(front, ["lang", "word1", "word2"]).join(back, ["lang", "word2", "word3"])
            .withColumns({"s1": score_of(F.col("n"), F.col("f1"), F.col("f23")),
                          "s2": score_of(F.col("n"), F.col("f12"), F.col("f3"))}))
    first = F.col("s1") <= F.col("s2")
    three = cuts.select("lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), F.col("n").alias("a"),
                        F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                        F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))
    return two.unionByName(three)


def _first(found: DataFrame, top: int) -> DataFrame:
    """The first rows of each language with their rank: first of each of many
    parts of a language, then of these, so no task orders a whole language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = max(8, shuffle_partitions(found.sparkSession))
    found = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    near = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
