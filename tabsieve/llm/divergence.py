"""Quality rules: a text's histograms against language references.

Two histograms of a text are compared with those of each language of the
corpus by Jensen-Shannon distance (square root of the divergence in bits, 0 to
1): shares of character classes, and shares of the language's common words
with one more bin for all other words.  References are counted over all
documents.  A word is common if it makes up at least ``COMMON_SHARE`` of a
language's words.

Finding the common words takes two passes, both exact, with bounded tables:
each segment of the corpus lists its words of at least half that share; a word
that reaches the share overall must be listed with half of it in sum, so the
second pass counts at most 2 / COMMON_SHARE words a language.

A document whose language has no reference, for want of words, is not judged by
distance; one without a language is held against the nearest reference.

Length guards: a histogram is judged only if the text is long enough for it
(``MIN_CHARS`` characters, ``MIN_WORDS`` words), and the limit is widened by
the distance that drawing so few items from the reference itself would show,
sqrt(bins / (8 n ln 2)), times ``NOISE_WEIGHT``.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsieve.llm.common import prepare, text_slices, texts_of

COMMON_SHARE = 0.004
#: Words of a segment of the first pass.
SEGMENT_WORDS = 200_000
#: A language is a reference if it holds at least so many words, whatever its
#: share of the corpus: a common word has 8 of them.
REFERENCE_WORDS = 2_000
MIN_CHARS = 200
MIN_WORDS = 60
MAX_CHAR_DISTANCE = 0.24
MAX_WORD_DISTANCE = 0.17
NOISE_WEIGHT = 0.75

# Base rules.
BASE_MIN_WORDS = 20
BASE_MAX_REPEAT_PERCENT = 30
WINDOW_WORDS = 8
SYMBOLS = "#*$%&|<>"

CLASSES = ["lower", "upper", "digit", "space", "punctuation", "symbol", "other_ascii", "beyond_ascii"]


def _class_of_byte() -> np.ndarray:
    out = np.full(256, 6)
    out[97:123], out[65:91], out[48:58] = 0, 1, 2
    out[[32, 9, 10, 11, 12, 13]] = 3
    out[list(b"!\"'(),-./:;?[]_")] = 4
    out[list(SYMBOLS.encode())] = 5
    out[0xC0:] = 7      # a lead byte stands for its character
    out[0x80:0xC0] = 8  # continuation bytes are not counted
    return out


_CLASS = np.eye(9, dtype=np.int64)[_class_of_byte()][:, :8]


def char_classes(raw: bytes) -> np.ndarray:
    """Characters of each class, counted in slices."""
    counts = np.zeros(256, dtype=np.int64)
    view = np.frombuffer(raw, dtype=np.uint8)
    for at in range(0, len(view), 1 << 16):
        counts += np.bincount(view[at:at + (1 << 16)], minlength=256)
    return counts @ _CLASS


def words_of(raw: bytes) -> list[bytes]:
    """Words between ASCII white space."""
    return raw.split()


_MARKS = b"!\"'(),-./:;?[]_" + SYMBOLS.encode()


def bare_words(words: list[bytes]) -> list[bytes]:
    """Words for the histograms: lower-cased, without marks around them."""
    return [x for x in (w.strip(_MARKS) for w in b" ".join(words).lower().split()) if x]


def repeated_words(words: list[bytes], window: int = WINDOW_WORDS) -> int:
    """Words covered by windows of ``window`` words that the text holds twice or
    more, the first one included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    grams = list(zip(*(words[i:] for i in range(window))))
    counts = Counter(grams)
    if len(counts) == n:
        return 0
    twice = np.fromiter((counts[g] > 1 for g in grams), dtype=bool, count=n)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    covered[:n] += twice
    covered[window:] -= twice[:len(covered) - window]
    return int((np.cumsum(covered[:-1]) > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[str] = set()
    twice = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            twice += line in seen
            seen.add(line)
    return twice


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence in bits of two histograms."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.nansum(np.where(p > 0, p * np.log2(p / m), 0)) + np.nansum(np.where(q > 0, q * np.log2(q / m), 0))
    return float(np.sqrt(max(0.0, min(1.0, d / 2))))


def limit(base: float, bins: int, n: int) -> float:
    """Largest distance let pass for a histogram of n items."""
    return base + NOISE_WEIGHT * math.sqrt(bins / (8 * n * math.log(2)))


@dataclass
class References:
    """Per language: character-class counts, and common words with their counts
    and the count of all other words last."""

    chars: dict[str, np.ndarray] = field(default_factory=dict)
    words: dict[str, dict[bytes, int]] = field(default_factory=dict)
    rest: dict[str, int] = field(default_factory=dict)

    def judges(self, lang: str | None) -> bool:
        """Whether texts of ``lang`` (null: unknown) are held against the references."""
        return lang is None or lang in self.chars

    def compare(self, raw: bytes, words: list[bytes]) -> tuple[float | None, float | None, str | None, bool]:
        """(character distance, word distance, language, far) for the nearest
        reference; a distance is None where the text is too short for it or
        there is no reference.  Far: a distance is over its limit."""
        chars = char_classes(raw)
        n_chars = int(chars.sum())
        by_char = {k: js_distance(chars, r) for k, r in self.chars.items()} if n_chars >= MIN_CHARS else {}
        bare = Counter(bare_words(words)) if len(words) >= MIN_WORDS else {}
        total = sum(bare.values())
        by_word = {}
        if total >= MIN_WORDS:
            for k, ref in self.words.items():
                p = np.array([*(bare.get(w, 0) for w in ref), 0.0])
                p[-1] = total - p.sum()
                by_word[k] = js_distance(p, np.array([*ref.values(), self.rest[k]], dtype=float))
        both = by_word or by_char
        if not both:
            return None, None, None, False
        nearest = min(both, key=lambda k: (both[k], k))
        c, w = by_char.get(nearest), by_word.get(nearest)
        far = (c is not None and c > limit(MAX_CHAR_DISTANCE, len(CLASSES), n_chars)) or (
            w is not None and w > limit(MAX_WORD_DISTANCE, len(self.words[nearest]) + 1, total))
        return c, w, nearest, far


# --- references on Spark -----------------------------------------------------------------------

def _list_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language and segment: its words of at least half the common share and
    the sums every segment adds; a segment is what a task reads until it holds
    ``SEGMENT_WORDS`` words of the language."""
    words: dict[str, Counter] = defaultdict(Counter)
    sizes: Counter = Counter()
    chars: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(CLASSES), dtype=np.int64))

    def listed(lang: str) -> pa.RecordBatch:
        n = sizes.pop(lang, 0)
        least = n * COMMON_SHARE / 2
        top = [(w.decode("utf-8", "replace"), c) for w, c in words.pop(lang, Counter()).items() if c >= least]
        totals = chars.pop(lang)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * (len(top) + 1), pa.string()), pa.array([None, *(w for w, _ in top)], pa.string()),
             pa.array([n, *(c for _, c in top)], pa.int64()),
             pa.array([totals.tolist(), *([None] * len(top))], pa.list_(pa.int64()))],
            names=["lang", "word", "n", "chars"])

    for batch in batches:
        for part in text_slices(batch):
            for t, lang in zip(texts_of(part), part.column("lang").to_pylist()):
                raw = t.encode("utf-8", "surrogatepass")
                bare = bare_words(words_of(raw))
                words[lang].update(bare)
                sizes[lang] += len(bare)
                chars[lang] += char_classes(raw)
                if sizes[lang] >= SEGMENT_WORDS:
                    yield listed(lang)
    for lang in list(chars):
        yield listed(lang)


def _count_words(wanted: dict[str, list[bytes]]):
    """Exact counts of the wanted words per language and task."""

    def run(batches):
        found: dict[str, Counter] = {k: Counter() for k in wanted}
        for batch in batches:
            for part in text_slices(batch):
                for t, lang in zip(texts_of(part), part.column("lang").to_pylist()):
                    if lang not in found:
                        continue
                    seen = Counter(bare_words(words_of(t.encode("utf-8", "surrogatepass"))))
                    for w in wanted[lang]:
                        if w in seen:
                            found[lang][w] += seen[w]
        rows = [(k, w.decode(), n) for k, c in found.items() for w, n in c.items()]
        if rows:
            lang, word, n = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(word, pa.string()),
                                              pa.array(n, pa.int64())], names=["lang", "word", "n"])

    return run


def references(docs: DataFrame) -> References:
    """References of the languages of ``docs`` over all its rows; rows without
    text or lang teach nothing, and no language at all gives no reference."""
    prepare(docs.sparkSession)
    rows = docs.select("text", F.col("lang").cast("string").alias("lang")).filter(
        "text is not null and lang is not null")
    segments = rows.mapInArrow(_list_segments, "lang string, word string, n bigint, chars array<bigint>").checkpoint()
    sums = (segments.filter("word is null").groupBy("lang")
            .agg(F.sum("n").alias("n"), *(F.sum(F.col("chars")[i]).alias(c) for i, c in enumerate(CLASSES))))
    # one row a language
    sums = sums.filter(F.col("n") >= REFERENCE_WORDS).checkpoint()
    langs = {r["lang"]: r for r in sums.collect()}
    out = References(chars={k: np.array([r[c] for c in CLASSES], dtype=float) for k, r in sorted(langs.items())})
    if not langs:
        return out
    # at most 2 / COMMON_SHARE words a language pass
    listed = (segments.filter("word is not null").groupBy("lang", "word").agg(F.sum("n").alias("n"))
              .join(sums.select("lang", F.col("n").alias("total")), "lang")
              .filter(F.col("n") >= COMMON_SHARE / 2 * F.col("total")).select("lang", "word").collect())
    wanted: dict[str, list[bytes]] = {k: [] for k in langs}
    for r in sorted(listed):
        wanted[r["lang"]].append(r["word"].encode())
    counted = (rows.mapInArrow(_count_words(wanted), "lang string, word string, n bigint")
               .groupBy("lang", "word").agg(F.sum("n").alias("n")).collect())
    common: dict[str, dict[bytes, int]] = {k: {} for k in langs}
    for x in sorted((r["lang"], r["word"].encode(), r["n"]) for r in counted):
        if x[2] >= COMMON_SHARE * langs[x[0]]["n"]:
            common[x[0]][x[1]] = x[2]
    for k, r in sorted(langs.items()):
        out.words[k] = common[k]
        out.rest[k] = r["n"] - sum(common[k].values())
    return out


# --- verdicts ----------------------------------------------------------------------------------

SCHEMA = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, kept boolean, char_distance double, word_distance double, nearest_lang string")


def judge(text: str, ref: References, lang: str | None = None) -> tuple:
    raw = text.encode("utf-8", "surrogatepass")
    words = words_of(raw)
    n = len(words)
    spaces = sum(map(raw.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")))
    repeat = repeated_words(words)
    failed = n < BASE_MIN_WORDS or 100 * repeat > BASE_MAX_REPEAT_PERCENT * n
    by_char, by_word, nearest, far = ref.compare(raw, words) if ref.judges(lang) else (None, None, None, False)
    return (n, len(text) - spaces, sum(map(text.count, SYMBOLS)), duplicate_lines(text), repeat, failed,
            not failed and not far, by_char, by_word, nearest)


def apply_rules(docs: DataFrame, ref: References) -> DataFrame:
    """(doc_id, base figures, base_failed, kept, distances) of every row by its
    whole text.  A null text counts as empty (fails the base rules); a text too
    short for a histogram is not judged by it; without references, or for a
    ``lang`` (if there is one) that has none, only the base rules speak, and
    distances and language are null.  Repeated rows each get a row; other
    columns are not read."""
    prepare(docs.sparkSession)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select("doc_id", "text", lang.alias("lang"))
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2 + [pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                found = list(zip(*(judge(t, ref, k) for t, k in zip(texts_of(part), part.column("lang").to_pylist())))) or [()] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(found, kinds))], names=["doc_id", *names])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {SCHEMA}")
