"""Token ids in Arrow files of equal-length sequences.

A dataset is a folder of pairs of Arrow IPC files, one pair a partition, in
ascending document order:

* ``part-NNNNN.tokens.arrow``: record batches of ``ids`` (fixed-size list of
  unsigned integers, the smallest of 16 and 32 bits that holds the vocabulary)
  and ``mask`` (fixed-size list of booleans, false on padding).  The
  documents' ids, each document closed by the end id, run on through the
  sequences; only the last sequence of a file is padded.
* ``part-NNNNN.docs.arrow``: ``doc_id``, ``start`` (ids before it in this
  file), ``n_tokens``.

Values are not compressed, so a memory-mapped file serves any sequence without
a copy (`open_sequences`).  A file is written under a name of its own attempt
and then renamed, so a lost or repeated task leaves whole files only, and the
content depends on the partition's rows alone.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.ipc as ipc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsieve.llm.common import prepare, text_slices, texts_of
from tabsieve.session import shuffle_partitions

SEQUENCE_IDS = 2048
#: Sequences of a record batch.
BATCH_SEQUENCES = 64
END_ID = 1
CACHE_WORDS = 400_000


# --- encoding ----------------------------------------------------------------------------------

class WordEncoder:
    """Ids of a text by the ``tokenizers`` library, word by word.

    No pre-token crosses ASCII white space, so a text's ids are its words' ids
    in a row, and frequent words are looked up.  Words of printable ASCII and
    Latin-1 letters that a lower-casing, white-space-dropping vocabulary would
    only lower-case go to the library's model directly, others through its
    whole chain.  ``direct`` is off for vocabularies of another make."""

    _loaded: dict[str, "WordEncoder"] = {}
    _simple = re.compile(r"[!-~À-ÖØ-öø-ÿ]+").fullmatch

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        # texts with the string of a special token (in any case) go whole through the library
        self.special = [t["content"].lower() for t in json.loads(self.tok.to_str()).get("added_tokens", [])]
        self.tok.no_padding()
        self.tok.no_truncation()
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        steps = [n["type"] for n in (made.get("normalizer") or {}).get("normalizers", [])]
        splits = (made.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.whole_words = bool(splits) and splits[0]["type"] == "Split" and splits[0].get("behavior") == "Removed"
        self.direct = self.whole_words and steps == ["NFC", "Replace", "Lowercase"]
        if self.direct:
            import regex

            self.split = regex.compile(splits[0]["pattern"]["Regex"]).findall
            self.model = self.tok.model
            self.chars = byte_characters()
        self.vocabulary = self.tok.get_vocab_size(with_added_tokens=True)
        self.width = "<u2" if self.vocabulary <= 1 << 16 else "<u4"
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    @classmethod
    def get(cls, path: str) -> "WordEncoder":
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _library(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype=self.width).tobytes()

    def _part(self, part: str) -> bytes:
        got = self.parts.get(part)
        if got is None:
            mapped = part if part.isascii() else "".join(map(self.chars.__getitem__, part.encode()))
            got = np.array([t.id for t in self.model.tokenize(mapped)], dtype=self.width).tobytes()
            if len(self.parts) < CACHE_WORDS and len(part) <= 32:
                self.parts[part] = got
        return got

    def _word(self, word: str) -> bytes:
        if self.direct and self._simple(word):
            got = b"".join(map(self._part, self.split(word.lower())))
        else:
            got = self._library(word)
        if len(self.words) < CACHE_WORDS and len(word) <= 32:
            self.words[word] = got
        return got

    def encode(self, text: str) -> bytes:
        if not self.whole_words or any(x in text.lower() for x in self.special):
            return self._library(text)
        known = self.words
        return b"".join([known[w] if w in known else self._word(w) for w in _ascii_words(text)])


def _ascii_words(text: str) -> list[str]:
    """Words between ASCII white space only: other white space may stand for
    something else to a normaliser."""
    if text.isascii() or not _ODD_SPACE.search(text):
        words = text.split()
        return words if not _SEPARATORS.search(text) else re.split(r"[ \t\n\r\v\f]+", text)
    return re.split(r"[ \t\n\r\v\f]+", text)


_ODD_SPACE = re.compile("[\x85\xa0  -     　]")
_SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: itself where printable, else the next free code from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


# --- files -------------------------------------------------------------------------------------

def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder given as URI or local path."""
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") \
        else (pafs.LocalFileSystem(), folder)


class SequenceWriter:
    """Packs documents' ids into sequences and writes them batch by batch; no
    more than one batch of sequences and the document index is held."""

    def __init__(self, fs, path: str, width: str, length: int):
        self.kind = pa.uint16() if width == "<u2" else pa.uint32()
        self.width, self.length, self.size = width, length, length * BATCH_SEQUENCES
        self.schema = pa.schema([("ids", pa.list_(self.kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.out = fs.open_output_stream(path)
        self.writer = ipc.new_file(self.out, self.schema)
        self.held = np.empty(self.size, dtype=width)
        self.n = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            take = min(self.size - self.n, len(ids) - at)
            self.held[self.n:self.n + take] = ids[at:at + take]
            self.n += take
            at += take
            if self.n == self.size:
                self._flush()
        self.total += len(ids)

    def _flush(self) -> None:
        rows = -(-self.n // self.length)
        ids = np.zeros(rows * self.length, dtype=self.width)
        ids[:self.n] = self.held[:self.n]
        mask = np.arange(rows * self.length) < self.n
        self.writer.write_batch(pa.record_batch(
            [pa.FixedSizeListArray.from_arrays(pa.array(ids, self.kind), self.length),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))
        self.n = 0

    def close(self) -> None:
        if self.n:
            self._flush()
        self.writer.close()
        self.out.close()


def write_partition(batches: Iterator[pa.RecordBatch], folder: str, part: int, tokenizer_path: str,
                    end_id: int, length: int) -> tuple[int, int]:
    """Write one partition's pair of files; returns (documents, ids)."""
    fs, root = _filesystem(folder)
    enc = WordEncoder.get(tokenizer_path)
    fs.create_dir(root, recursive=True)
    attempt = uuid.uuid4().hex
    names = [f"{root}/part-{part:05d}.{kind}.arrow" for kind in ("tokens", "docs")]
    drafts = [f"{root}/_{attempt}.{kind}" for kind in ("tokens", "docs")]
    tokens = SequenceWriter(fs, drafts[0], enc.width, length)
    end = np.array([end_id], dtype=enc.width)
    docs = 0
    out = writer = None
    for batch in batches:
        for rows in text_slices(batch):
            start, count = [], []
            for t in texts_of(rows):
                start.append(tokens.total)
                tokens.add(np.frombuffer(enc.encode(t), dtype=enc.width))
                tokens.add(end)
                count.append(tokens.total - start[-1])
            index = pa.record_batch([rows.column("doc_id"), pa.array(start, pa.int64()), pa.array(count, pa.int64())],
                                    names=["doc_id", "start", "n_tokens"])
            if writer is None:
                out = fs.open_output_stream(drafts[1])
                writer = ipc.new_file(out, index.schema)
            writer.write_batch(index)
            docs += rows.num_rows
    tokens.close()
    if writer is None:
        fs.delete_file(drafts[0])
        return 0, 0
    writer.close()
    out.close()
    for draft, name in zip(drafts, names):
        fs.move(draft, name)
    return docs, tokens.total


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID,
                 length: int = SEQUENCE_IDS) -> DataFrame:
    """Write the ids of every row's whole text in ascending doc_id order; returns
    the manifest (part, documents, ids, base: ids of all parts before it).

    A null text counts as empty (its end id only); null ids come first; rows
    that share an id stand side by side, in the order of their text's hash and
    text.  Rows are dealt by ranges of doc_id, so the parts are in order and no
    row passes through the driver.  Extra columns are not read."""
    prepare(docs.sparkSession)
    kind = "part int, documents bigint, ids bigint"
    rows = docs.select("doc_id", "text")
    n = shuffle_partitions(docs.sparkSession)
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text").asc_nulls_first()]
    placed = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        made, ids = write_partition(batches, folder, part, tokenizer_path, end_id, length)
        if made:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([made], pa.int64()),
                                              pa.array([ids], pa.int64())], names=["part", "documents", "ids"])

    # one row a part: the running sum is over as many rows as there are files
    parts = placed.mapInArrow(run, kind).checkpoint()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def open_sequences(path: str) -> ipc.RecordBatchFileReader:
    """Memory-mapped reader of a local tokens file: `get_batch(i)` and the list
    arrays' values are views of the file."""
    return ipc.open_file(pa.memory_map(path))


def sequence(reader: ipc.RecordBatchFileReader, i: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, mask) of sequence ``i``; the ids are a view of the file."""
    batch = reader.get_batch(i // BATCH_SEQUENCES)
    row = i % BATCH_SEQUENCES
    return (batch.column("ids")[row].values.to_numpy(zero_copy_only=True),
            batch.column("mask")[row].values.to_numpy(zero_copy_only=False))


def _read_documents(folder: str, id_type: pa.DataType):
    """Streams each listed part: yields its documents with their ids' checksum."""

    def run(batches):
        fs, root = _filesystem(folder)
        for listed in batches:
            for part, base in zip(listed.column("part").to_pylist(), listed.column("base").to_pylist()):
                name = f"{root}/part-{part:05d}"
                with fs.open_input_file(f"{name}.tokens.arrow") as f, fs.open_input_file(f"{name}.docs.arrow") as g:
                    tokens, index = ipc.open_file(f), ipc.open_file(g)
                    stream = _ids(tokens)
                    held = np.zeros(0, dtype=np.uint32)
                    for i in range(index.num_record_batches):
                        rows = index.get_batch(i)
                        sums = []
                        for want in rows.column("n_tokens").to_pylist():
                            crc = 0
                            while want:
                                if not len(held):
                                    held = next(stream)
                                crc = zlib.crc32(held[:want].tobytes(), crc)
                                want, held = want - min(want, len(held)), held[want:]
                            sums.append(crc)
                        start = pa.array(rows.column("start").to_numpy() + base)
                        yield pa.RecordBatch.from_arrays(
                            [rows.column("doc_id").cast(id_type), start, rows.column("n_tokens"),
                             pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def _ids(reader) -> Iterator[np.ndarray]:
    """Unpadded ids of a file, batch by batch, as little-endian 32 bits."""
    for i in range(reader.num_record_batches):
        batch = reader.get_batch(i)
        ids = batch.column("ids").flatten().to_numpy()
        mask = batch.column("mask").flatten().to_numpy(zero_copy_only=False)
        yield ids[mask].astype("<u4")


def read_documents(manifest: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files of
    ``manifest``; a task reads whole parts, a batch of sequences at a time."""
    prepare(manifest.sparkSession)
    n = shuffle_partitions(manifest.sparkSession)
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]
    return (manifest.select("part", "base").repartition(n, "part")
            .mapInArrow(_read_documents(folder, arrow),
                        f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint"))
