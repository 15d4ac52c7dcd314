import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from tabsieve.llm import arrow_tokens as A

PATH = P.path("word_bpe_49k.json")
ODD = ["Ünïcode ÀÉ ß ẞ İstanbul ΣΑΣ ﬁ", "a\x1cb c\x1dd", "x y 　z \u0085q", "don't I'LL we'Ve '", "é a ̈x",
       "<|endoftext|> a", "hello <|endoftext|> world", "a<|startoftext|><|ENDOFTEXT|>b", "<|endoftext|>", "１２3 ½ x²", "​zero", "日本語 テスト 😀!!", "tab\tnew\nline\r\n\v\f x", "", " ", "µ ª º × ÷ ¿¡",
       "ÀB", "각", "-" * 300]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)  # as it comes: strings of special tokens are their ids


@pytest.mark.parametrize("text", ODD)
def test_words_equal_the_library(library, text):
    enc = A.WordEncoder.get(PATH)
    assert np.frombuffer(enc.encode(text), enc.width).tolist() == library.encode(text, add_special_tokens=False).ids


def test_other_vocabularies_go_through_the_library():
    path = P.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    enc = A.WordEncoder(path)
    for text in [*ODD[:4], "hello <|endoftext|> world"]:
        assert np.frombuffer(enc.encode(text), enc.width).tolist() == t.encode(text, add_special_tokens=False).ids


def test_files_hold_every_document_in_order(spark, library, tmp_path):
    rows = [(i * 7 % 50, f"text number {i} " * (i % 9)) for i in range(50)] + [(60, "same"), (60, None), (None, "no id")]
    rows += [(70 + i, t) for i, t in enumerate(ODD)] + [(99, "word " * 3000)]
    docs = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id bigint, text string, start string")
    manifest = A.write_tokens(docs, str(tmp_path), PATH, length=16)
    got = sorted(A.read_documents(manifest, str(tmp_path)).collect(), key=lambda r: r.start)
    stream, at = {}, 0
    assert [-1 if r.doc_id is None else r.doc_id for r in got] == sorted(-1 if i is None else i for i, _ in rows)
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        stream.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in got:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in stream[r.doc_id]
        stream[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        at += r.n_tokens
    # fixed-length sequences, read without a copy
    part = sorted(p for p in tmp_path.iterdir() if p.name.endswith("tokens.arrow"))[0]
    reader = A.open_sequences(str(part))
    ids, mask = A.sequence(reader, 0)
    assert len(ids) == len(mask) == 16 and not ids.flags.owndata and mask.all()
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_")]


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert A.read_documents(A.write_tokens(docs, str(tmp_path), PATH), str(tmp_path)).count() == 0


def test_special_tokens_are_read_as_the_library_reads_them(library):
    enc = A.WordEncoder.get(PATH)
    assert np.frombuffer(enc.encode("hello <|endoftext|> world"), enc.width).tolist() == [3306, 49407, 1002]
