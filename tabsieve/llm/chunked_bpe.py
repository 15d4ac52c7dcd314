"""Byte-level BPE by overlapping chunks.

A text is cut into chunks of ``chunk_chars`` characters, each read on for
``overlap_chars`` more.  Every chunk is pre-tokenised alone, from its own first
character, wherever that falls.  The pre-token pattern looks ahead only, never
behind, so two runs that share one boundary agree from there on; neighbouring
chunks are stitched at the first boundary both see inside the overlap.  The
pieces between the stitches are then the pieces of the whole text, and each is
encoded alone by the ranks.

Chunks of one text are rows of their own and go to different tasks; only texts
longer than one chunk are shuffled (their chunk results, not the other texts).
If an overlap holds no common boundary (a run of one character class longer
than the overlap), nothing proves that the chunks behind that seam are in step,
so they are joined to the last chunk that is and pre-tokenised as one text:
exact, and rare.

A chunk's last two pieces are no ground for a stitch: the pattern's look-ahead
may want text that the chunk does not hold.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsieve.llm.common import prepare, text_slices, texts_of
from tabsieve.session import shuffle_partitions

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 1_024
#: Distinct pieces whose ids a task remembers.
CACHE_PIECES = 200_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a .tiktoken file: one base64 token and its id a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PieceEncoder:
    """Ids of pre-token pieces by the merge ranks, and bytes of ids."""

    _loaded: dict[tuple, "PieceEncoder"] = {}

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import tiktoken

        ranks = load_ranks(ranks_path)
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max(ranks.values()) + 1 if ranks else 0)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        self.cache: dict[str, bytes] = {}

    @classmethod
    def get(cls, ranks_path: str, pattern: str) -> "PieceEncoder":
        """One per worker process."""
        key = (ranks_path, pattern)
        if key not in cls._loaded:
            cls._loaded[key] = cls(ranks_path, pattern)
        return cls._loaded[key]

    def _piece(self, piece: str) -> bytes:
        # a piece alone is one match of the pattern again, so it is merged as a whole
        got = np.array(self.encoding.encode_ordinary(piece), dtype="<u4").tobytes()
        if len(self.cache) < CACHE_PIECES and len(piece) <= 64:
            self.cache[piece] = got
        return got

    def coded(self, pieces: list[str]) -> bytes:
        """Ids of the pieces in a row, four little-endian bytes each: kept as
        bytes, a remembered piece takes less than half of a list of numbers."""
        known = self.cache
        return b"".join([known[p] if p in known else self._piece(p) for p in pieces])

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def boundaries(pattern, text: str, at: int = 0) -> list[int]:
    """Starts of the pieces of ``text`` from ``at``."""
    return [m.start() for m in pattern.finditer(text, at)]


def _file(path: str) -> str:
    """Path of a vocabulary file on this machine: as given, or the copy that
    ``SparkContext.addFile`` brought."""
    import os

    return path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))


CHUNK_SCHEMA = ("doc_id {id}, uid binary, chunk int, chunks int, start bigint, text string")


def _cut(chunk_chars: int, overlap_chars: int):
    """Rows of chunks; a text of one chunk stays one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 64):
                row, uid, chunk, chunks, start, text = [], [], [], [], [], []
                for i, t in enumerate(texts_of(part)):
                    n = max(1, -(-len(t) // chunk_chars))
                    key = b"" if n == 1 else hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest()
                    for k in range(n):
                        row.append(i)
                        uid.append(key)
                        chunk.append(k)
                        chunks.append(n)
                        start.append(k * chunk_chars)
                        text.append(t if n == 1 else t[k * chunk_chars:(k + 1) * chunk_chars + overlap_chars])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row)), pa.array(uid, pa.binary()),
                     pa.array(chunk, pa.int32()), pa.array(chunks, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(text, pa.string())],
                    names=["doc_id", "uid", "chunk", "chunks", "start", "text"])

    return run


def _encode_single(ranks_path: str, pattern: str):
    """(doc_id, ids) of texts of one chunk: no seam, its pieces are final."""

    def run(batches):
        enc = PieceEncoder.get(_file(ranks_path), pattern)
        for batch in batches:
            for part in text_slices(batch, 64):
                ids = [enc.coded(enc.pattern.findall(t)) for t in texts_of(part)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())],
                                                 names=["doc_id", "ids"])

    return run


def _pretokenise(ranks_path: str, pattern: str, overlap_chars: int):
    """Per chunk of a long text: its piece starts in the head zone (its first
    ``overlap_chars``) and in the tail zone (the overlap with the next chunk),
    in text positions."""

    def run(batches):
        enc = PieceEncoder.get(_file(ranks_path), pattern)
        for batch in batches:
            for part in text_slices(batch, 64):
                heads, tails = [], []
                for t, s, k, n in zip(texts_of(part), part.column("start").to_pylist(),
                                      part.column("chunk").to_pylist(), part.column("chunks").to_pylist()):
                    b = np.array(boundaries(enc.pattern, t), dtype=np.int64)
                    last = k == n - 1
                    zone = len(t) - overlap_chars
                    heads.append((b[b < overlap_chars] + s).tolist())
                    # the last two pieces may change with the text that follows
                    tails.append([] if last else (b[:-2][b[:-2] >= zone] + s).tolist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("doc_id", "uid", "chunk", "chunks", "start", "text")]
                    + [pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))],
                    names=["doc_id", "uid", "chunk", "chunks", "start", "text", "head", "tail"])

    return run


def _encode_between(ranks_path: str, pattern: str):
    """Per chunk with its two stitches: ids of the pieces between them."""

    def run(batches):
        enc = PieceEncoder.get(_file(ranks_path), pattern)
        for batch in batches:
            for part in text_slices(batch, 64):
                out = []
                for t, s, lo, hi in zip(texts_of(part), part.column("start").to_pylist(),
                                        part.column("from").to_pylist(), part.column("until").to_pylist()):
                    cut = [*boundaries(enc.pattern, t, lo - s), len(t)]
                    pieces = [t[a:b] for a, b in zip(cut[:-1], cut[1:]) if hi is None or a + s < hi]
                    out.append(enc.coded(pieces))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("doc_id", "uid", "chunk", "times")] + [pa.array(out, pa.binary())],
                    names=["doc_id", "uid", "chunk", "times", "ids"])

    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str, chunk_chars: int = CHUNK_CHARS,
           overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """(doc_id, ids binary: little-endian unsigned 32-bit ids) of every row.

    A null text counts as empty (no ids); repeated rows each get their row; a
    null doc_id is kept; extra columns are not read."""
    return _encoded(docs, ranks_path, pattern, chunk_chars, overlap_chars, lambda coded: coded, "ids binary")


def encode_digest(docs: DataFrame, ranks_path: str, pattern: str, chunk_chars: int = CHUNK_CHARS,
                  overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """The rows of ``digest(encode(docs))``.  The worker that has a text's ids
    hashes them: one Python worker a task with one vocabulary, where two steps
    in a row keep two."""
    return _encoded(docs, ranks_path, pattern, chunk_chars, overlap_chars, _digests(ranks_path, pattern), DIGEST_COLUMNS)


def _encoded(docs: DataFrame, ranks_path: str, pattern: str, chunk_chars: int, overlap_chars: int,
             finish: Callable, columns: str) -> DataFrame:
    """(doc_id, ``columns``): ``finish`` takes the batches of (doc_id, ids) in
    the step that made them."""
    spark = docs.sparkSession
    prepare(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    encode_single = _encode_single(ranks_path, pattern)
    rows = docs.select("doc_id", "text")
    is_long = F.coalesce(F.length("text") > chunk_chars, F.lit(False))
    single = rows.filter(~is_long).mapInArrow(lambda batches: finish(encode_single(batches)), f"doc_id {kind}, {columns}")

    cut = rows.filter(is_long).mapInArrow(_cut(chunk_chars, overlap_chars), CHUNK_SCHEMA.format(id=kind))
    # chunks of one text to different tasks; equal texts of one id share their chunks
    same = ["doc_id", "uid", "chunk"]
    spread = cut.repartition(shuffle_partitions(spark), F.xxhash64("uid", "chunk"))
    pre = spread.mapInArrow(_pretokenise(ranks_path, pattern, overlap_chars),
                            CHUNK_SCHEMA.format(id=kind) + ", head array<bigint>, tail array<bigint>")
    zones = (pre.groupBy(*same).agg(F.count("*").alias("times"), *(F.min(c).alias(c) for c in (
        "chunks", "start", "text", "head", "tail"))))
    # neighbours meet here: the rows of one text, with the zones' boundaries
    by_text = Window.partitionBy("doc_id", "uid").orderBy("chunk")
    so_far = by_text.rowsBetween(Window.unboundedPreceding, 0)
    settled = (zones.withColumn("seam", F.when(F.col("chunk") == 0, F.lit(0).cast("bigint")).otherwise(
        F.array_min(F.array_intersect(F.lag("tail").over(by_text), F.col("head")))))
        .withColumn("lost", F.max(F.col("seam").isNull()).over(so_far))
        .withColumn("leader", F.max(F.when(~F.col("lost"), F.col("chunk"))).over(so_far)))
    own = F.struct("chunk", F.when(F.col("chunk") == F.col("chunks") - 1, F.col("text"))
                   .otherwise(F.substring("text", 1, chunk_chars)).alias("core"), "text")
    joined = (settled.groupBy("doc_id", "uid", F.col("leader").alias("chunk"))
              .agg(F.max("times").cast("int").alias("times"), F.min("start").alias("start"),
                   F.min_by("seam", "start").alias("from"),
                   F.sort_array(F.collect_list(own)).alias("parts"))
              .withColumn("text", F.concat(
                  F.array_join(F.transform(F.slice("parts", 1, F.size("parts") - 1), lambda p: p["core"]), ""),
                  F.element_at("parts", -1)["text"])))
    spans = joined.withColumn("until", F.lead("from").over(by_text)).select(
        "doc_id", "uid", "chunk", "times", "start", "text", "from", "until")
    coded = spans.mapInArrow(_encode_between(ranks_path, pattern),
                             f"doc_id {kind}, uid binary, chunk int, times int, ids binary")
    whole = (coded.groupBy("doc_id", "uid")
             .agg(F.max("times").alias("times"), F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))
             .select("doc_id", "parts", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("copy"))
             .select("doc_id", F.col("parts.ids").alias("parts"))
             .mapInArrow(lambda batches: finish(_join_parts(batches)), f"doc_id {kind}, {columns}"))
    return single.unionByName(whole)


def _join_parts(batches):
    for batch in batches:
        for part in text_slices(batch, 16):
            ids = [b"".join(p) for p in part.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())],
                                             names=["doc_id", "ids"])


DIGEST_COLUMNS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def _digests(ranks_path: str, pattern: str):
    """Per text with its ids: their number and the hashes."""

    def run(batches):
        enc = PieceEncoder.get(_file(ranks_path), pattern)
        for batch in batches:
            for part in text_slices(batch, 64):
                n, a, b = [], [], []
                for raw in part.column("ids").to_pylist():
                    ids = np.frombuffer(raw, dtype="<u4").tolist()
                    n.append(len(ids))
                    a.append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
                    b.append(hashlib.sha256(enc.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()),
                     pa.array(b, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def digest(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of (doc_id, ids): hashes
    of the decimal ids joined by spaces and of the decoded bytes."""
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.mapInArrow(_digests(ranks_path, pattern), f"doc_id {kind}, {DIGEST_COLUMNS}")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, bytes) of (doc_id, ids): raw bytes of the ids, joined."""

    def run(batches):
        enc = PieceEncoder.get(_file(ranks_path), pattern)
        for batch in batches:
            for part in text_slices(batch, 64):
                out = [enc.decode(np.frombuffer(r, dtype="<u4").tolist()) for r in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.binary())],
                                                 names=["doc_id", "bytes"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.mapInArrow(run, f"doc_id {kind}, bytes binary")
