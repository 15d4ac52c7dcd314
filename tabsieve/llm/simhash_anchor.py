"""SimHash near-duplicates by anchor points of a covering code.

Fingerprint: 64 bits over word shingles; a bit is 1 if set in more than half of
the shingles' XXH64 hashes.  Two fingerprints link when they differ in at most
``max_bits`` bits.

Search: the 64 bits are cut into three blocks of 23, 23 and 18 bits.  If two
fingerprints differ in at most d bits, they differ in at most floor(d / 3) bits
in one block, so each block is searched for that smaller threshold t.  In a
block the anchors are the words of a covering code of radius R:

* 23 bits: the binary Golay code (4,096 words, R = 3, perfect);
* 18 bits: the Hamming code on 15 bits with 3 free bits (16,384 words, R = 1).

Each fingerprint's home is the anchor within R (the codes are perfect, so there
is just one) and it is replicated to every anchor within R + t.  If x and y
differ in at most t bits, y lies within R + t of x's home, so the pair meets at
that anchor.  On average a fingerprint goes to 5.3 anchors in each Golay block
and 10.6 in the Hamming block at t = 1.  All 64 bits are compared there.

Each anchor is compared alone: its homes in blocks of ``block_homes`` against
the stream of its replicas, so memory does not grow with an anchor's size, and
blocks of a crowded anchor go to several tasks.  Per block only a spanning
forest of the links leaves the task (no pair lists), which keeps connectivity
whole.  Equal fingerprints are one row before the search.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tabsieve.llm.common import LocalForest, connected_components, join_facts, prepare, segments, text_slices, texts_of
from tabsieve.session import shuffle_partitions

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Homes of an anchor that one task holds in memory.
BLOCK_HOMES = 4096

# Generator polynomial of the binary Golay code (x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1).
GOLAY_POLY = 0b110001110101

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_FOLD = bytes.maketrans(_UPPER, _LOWER)


# --- fingerprints ------------------------------------------------------------------------------

def simhash(text: str, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Fingerprint of one text as an unsigned integer; no words: 0."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle_words:
        return digest(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.empty_like(ends)
    starts[0] = 0
    starts[1:] = ends[:-1] + 1
    n = len(words) - shingle_words + 1
    hashes = np.fromiter((digest(joined[i:j], seed) for i, j in
                          zip(starts[:n].tolist(), ends[shingle_words - 1:].tolist())),
                         dtype=np.uint64, count=n)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes, counted in bounded slices."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 16384):
        part = hashes[at:at + 16384].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, fp bigint: the 64 bits, sign bit included) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                fp = np.array([simhash(t, shingle_words, seed) for t in texts_of(part)], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fp.view(np.int64))],
                                                 names=["doc_id", "fp"])

    d = docs.select("doc_id", "text")
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, fp bigint")


# --- covering codes ----------------------------------------------------------------------------

def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _golay_syndrome(word: int) -> int:
    for shift in range(22, 10, -1):
        if word >> shift & 1:
            word ^= GOLAY_POLY << (shift - 11)
    return word


@functools.lru_cache(maxsize=None)
def _cosets(n: int, weight: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the perfect code of length n: syndromes of single bits, then the words
    of at most ``weight`` bits by syndrome, as one array with starts and counts.
    A word x has the codewords x ^ e, e over the coset of x's syndrome; the
    first entry is the coset leader."""
    from itertools import combinations

    if n == 23:
        unit = np.array([_golay_syndrome(1 << i) for i in range(23)], dtype=np.int64)
        cosets = 2048
    else:
        unit = np.arange(1, n + 1, dtype=np.int64)  # Hamming: the syndrome of bit i is i + 1
        cosets = n + 1
    by: list[list[int]] = [[] for _ in range(cosets)]
    for w in range(weight + 1):
        for bits in combinations(range(n), w):
            s = e = 0
            for i in bits:
                s ^= int(unit[i])
                e |= 1 << i
            by[s].append(e)
    counts = np.array([len(x) for x in by], dtype=np.int64)
    return unit, np.array([e for x in by for e in x], dtype=np.int64), np.cumsum(counts) - counts, counts


def anchors_of(block: np.ndarray, bits: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, is_home) of every anchor within R + reach of each block
    value; ``bits`` is 23 or 18."""
    free = 3 if bits == 18 else 0
    n, radius = (15, 1) if bits == 18 else (23, 3)
    rows, anchors, homes = [], [], []
    low, high = block & ((1 << n) - 1), block >> n
    for e_free in range(1 << free):
        spent = bin(e_free).count("1")
        if spent > reach:
            continue
        unit, words, starts, counts = _cosets(n, radius + reach - spent)
        syndrome = np.zeros(len(block), dtype=np.int64)
        for i, u in enumerate(unit.tolist()):
            syndrome ^= np.where(low >> i & 1, u, 0)
        many = counts[syndrome]
        row = np.repeat(np.arange(len(block)), many)
        within = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        e = words[np.repeat(starts[syndrome], many) + within]
        rows.append(row)
        anchors.append((low[row] ^ e) | ((high[row] ^ e_free) << n))
        homes.append((within == 0) & (spent == 0))
    return np.concatenate(rows), np.concatenate(anchors), np.concatenate(homes)


#: (first bit, bits) of the blocks.
BLOCKS = ((0, 23), (23, 23), (46, 18))


def replicate(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fp, anchor key, is_home) over the three blocks; the key holds the block
    number above the anchor's bits."""
    reach = max_bits // len(BLOCKS)
    out_fp, out_key, out_home = [], [], []
    u = fps.view(np.uint64)
    for k, (at, bits) in enumerate(BLOCKS):
        block = (u >> np.uint64(at) & np.uint64((1 << bits) - 1)).astype(np.int64)
        row, anchor, home = anchors_of(block, bits, reach)
        out_fp.append(fps[row])
        out_key.append(anchor | k << 40)
        out_home.append(home)
    return np.concatenate(out_fp), np.concatenate(out_key), np.concatenate(out_home)


# --- join --------------------------------------------------------------------------------------

def _anchor_rows(distinct: DataFrame, max_bits: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                fp, key, home = replicate(batch.column("fp").to_numpy()[at:at + 8192], max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(fp), pa.array(key), pa.array(home)],
                                                 names=["fp", "anchor", "home"])

    return distinct.select("fp").mapInArrow(run, "fp bigint, anchor bigint, home boolean")


def _block_links(max_bits: int):
    """Streams rows sorted by (unit, is_stream): the unit's homes, then its
    replicas; yields a spanning forest of the links."""

    def run(batches):
        unit = homes = forest = None
        gathered: list[np.ndarray] = []

        def close():
            if homes is None or forest is None:
                return None
            roots = [(i, forest.find(i)) for i in range(len(homes)) if forest.parent[i] != i]
            if not roots:
                return None
            i, r = np.array(roots).T
            return pa.RecordBatch.from_arrays([pa.array(homes[i]), pa.array(homes[r])], names=["a", "b"])

        for (key, chunk, stream), part in segments(batches, ["anchor", "chunk", "stream"]):
            if unit != (key, chunk):
                if (done := close()) is not None:
                    yield done
                unit, homes, forest, gathered = (key, chunk), None, None, []
            fp = part.column("fp").to_numpy()
            if not stream:
                gathered.append(fp)
                continue
            if homes is None:
                homes = np.concatenate(gathered) if gathered else np.zeros(0, dtype=np.int64)
                forest = LocalForest(len(homes))
            if not len(homes):
                continue
            for at in range(0, len(fp), 1024):
                block = fp[at:at + 1024]
                near = _popcount((block[:, None] ^ homes[None, :]).view(np.uint64)) <= max_bits
                near &= block[:, None] != homes[None, :]
                r, h = np.nonzero(near)
                if not len(r):
                    continue
                first = np.concatenate([[True], r[1:] != r[:-1]])
                leads, which = np.unique(h[first], return_inverse=True)
                met = np.zeros((len(leads), len(homes)), dtype=bool)
                met[which[np.cumsum(first) - 1], h] = True
                for x, y in zip(*(z.tolist() for z in np.nonzero(met))):
                    forest.join(int(leads[x]), y)
                yield pa.RecordBatch.from_arrays([pa.array(block[r[first]]), pa.array(homes[h[first]])],
                                                 names=["a", "b"])
        if (done := close()) is not None:
            yield done

    return run


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS, block_homes: int = BLOCK_HOMES) -> DataFrame:
    """(a, b): fingerprint pairs within ``max_bits`` that connect every pair of
    fingerprints joined by links (a forest per anchor, not all pairs)."""
    spark = distinct.sparkSession
    rows = _anchor_rows(distinct, max_bits)
    # homes per anchor decide how many blocks an anchor has; only crowded anchors are listed
    home_counts = (rows.filter("home").groupBy("anchor").agg(F.count("*").alias("homes"))
                   .filter(F.col("homes") > block_homes)
                   .select("anchor", F.ceil(F.col("homes") / block_homes).cast("int").alias("blocks"))
                   .checkpoint())
    if home_counts.isEmpty():
        units = rows.select("fp", "anchor", F.lit(0).alias("chunk"), F.lit(0).alias("stream"), "home")
        streams = units.withColumn("stream", F.lit(1))
        units = units.filter("home").unionByName(streams)
    else:
        dealt = (rows.join(home_counts, "anchor", "left")
                 .withColumn("blocks", F.coalesce("blocks", F.lit(1))))
        own = dealt.filter("home").select(
            "fp", "anchor", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("chunk"),
            F.lit(0).alias("stream"), "home")
        streams = dealt.select("fp", "anchor", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("chunk"),
                               F.lit(1).alias("stream"), "home")
        units = own.unionByName(streams)
    n = shuffle_partitions(spark)
    placed = (units.drop("home").repartition(n, "anchor", "chunk")
              .sortWithinPartitions("anchor", "chunk", "stream"))
    return placed.mapInArrow(_block_links(max_bits), "a bigint, b bigint")


def _groups(fp: DataFrame, max_bits: int) -> DataFrame:
    """(fp, component: a fingerprint of the group, component_id) of every
    distinct fingerprint of (doc_id, fp)."""
    classes = fp.groupBy("fp").agg(F.min("doc_id").alias("first_id")).checkpoint()
    linked = connected_components(fingerprint_links(classes, max_bits))
    named = classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")).checkpoint()
    lowest = named.groupBy("component").agg(F.min("first_id").alias("component_id")).checkpoint()
    return join_facts(named, lowest, "component").select("fp", "component", "component_id").checkpoint()


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint hex, component_id) of every row of ``docs``.

    component_id is the smallest doc_id reachable over links.  A null or empty
    text has fingerprint zero and links like any other; a null doc_id takes
    part in the links but is never a component's id unless no row of the group
    has an id (then null).  Repeated rows each get their row.  Extra columns
    are not read.  An empty table gives an empty result."""
    prepare(docs.sparkSession)
    fp = fingerprints(docs, shingle_words).checkpoint()
    return join_facts(fp, _groups(fp, max_bits), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest doc_id;
    rows without id lose to rows with one.  Where several rows of the group
    share that id (or none has an id), the one with the smallest fingerprint
    and then the smallest row hash stays.  Columns of ``docs`` come back
    unchanged, whatever their names."""
    prepare(docs.sparkSession)
    fp = fingerprints(docs, shingle_words).checkpoint()
    groups = _groups(fp, max_bits)
    member = join_facts(fp, groups, "fp")
    kept = (member.groupBy("component")
            .agg(F.min_by(F.struct("doc_id", "fp"),
                          F.struct(F.col("doc_id").isNull(), "doc_id", "fp")).alias("k"))
            .select("k.doc_id", "k.fp").checkpoint())
    repeats = fp.groupBy("doc_id").count().filter("doc_id is null or count > 1")
    if repeats.isEmpty():
        return docs.join(kept.select("doc_id"), "doc_id", "left_semi").select(*docs.columns)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    candidates = docs.join(kept.select(F.col("doc_id").alias("_kept_id")).distinct(),
                           F.col("doc_id").eqNullSafe(F.col("_kept_id")), "left_semi").select(row.alias("r"))
    ids = candidates.select(F.col("r.doc_id").alias("doc_id"), F.col("r.text").alias("text"), "r")
    hashed = _with_fingerprint(ids, shingle_words)
    return (hashed.join(kept.select(F.col("doc_id").alias("_kept_id"), F.col("fp").alias("_kept_fp")),
                        (F.col("fp") == F.col("_kept_fp")) & F.col("doc_id").eqNullSafe(F.col("_kept_id")))
            .groupBy("fp", "doc_id").agg(F.min_by("r", F.xxhash64("r")).alias("r")).select("r.*"))


def _with_fingerprint(rows: DataFrame, shingle_words: int) -> DataFrame:
    """(doc_id, r, fp) for (doc_id, text, r)."""
    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                fp = np.array([simhash(t, shingle_words) for t in texts_of(part)], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("r"),
                                                  pa.array(fp.view(np.int64))], names=["doc_id", "r", "fp"])

    schema = rows.select("doc_id", "r").schema.add("fp", LongType())
    return rows.mapInArrow(run, schema)
