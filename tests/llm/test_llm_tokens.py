"""Token ids of the packing are those of the plain tokenizer call, whatever the text and the cache."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidalrec.llm import bestfit

public_tokenizers = pytest.importorskip("public_tokenizers")
PARTS = ["a", "B", "é", " ", "  ", "   ", "\n", "\t", " \n", "\n ", "'s", "don't", "1", "23", "!", "<|endoftext|>", " ", "　",
         "\x1c", "\x85", "漢字", "😀", "_", "<|", "endoftext|>", "\r\n", "​", "﻿", "x" * 80]


def _plain():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda x: np.asarray(tok.encode(x, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("most", [1, 50, 10 ** 6])
def test_ids_of_odd_texts(most):
    rnd = random.Random(1)
    texts = ["".join(rnd.choices(PARTS, k=rnd.randrange(30))) for _ in range(3000)] + ["", "a <|endoftext|> b", "word " * 40_000]
    tok = bestfit.ChunkCachingTokenizer(public_tokenizers.path("byte_bpe_50k.json"), most)
    got = list(bestfit._encoded(tok, pa.array([*texts, None]), 500))
    plain = _plain()
    assert got == [*map(plain, texts), b""]
    assert np.frombuffer(got[3001], "<u4").tolist() == [64, 220, 50256, 275]


def test_added_tokens_in_documents(spark):
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>"), (3, None), (4, "x<|endoftext|>y <|endoftext")]
    got = {r.doc_id: r for r in bestfit.pieces(spark.createDataFrame(rows, "doc_id long, text string"), bestfit.Packing()).collect()}
    plain = _plain()
    for i, text in rows:
        ids = plain(text or "") + np.asarray([2], "<u4").tobytes()
        assert (got[i].length, got[i].ids_crc32) == (len(ids) // 4, zlib.crc32(ids))


def test_cuts_around_marks_and_breaks():
    rnd = random.Random(2)
    parts = ["a", "Zz", "ß", "9", ".", ",", "'", "'s", "'ll", "_", "#$", "\n", "\n\n", "\n'", " ", "  ", "\t", "\r", "\xa0", " ",
             " ", " ", "　", "\x85", "«", "–", "あ", "ж", "é", "😀"]
    texts = ["".join(rnd.choices(parts, k=rnd.randrange(12))) for _ in range(4000)]
    tok = bestfit.ChunkCachingTokenizer(public_tokenizers.path("byte_bpe_50k.json"), 1000)
    assert list(bestfit._encoded(tok, pa.array(texts).slice(7), 3000)) == [*map(_plain(), texts[7:])]


def test_words_go_through_the_tokenizer_once_whatever_follows():
    tok = bestfit.ChunkCachingTokenizer(public_tokenizers.path("byte_bpe_50k.json"), 1000)
    asked, ids = [], tok._ids
    tok._ids = lambda texts: asked.extend(texts) or ids(texts)
    text = "the haus, the haus. the haus; the haus! the haus\nthe haus... the"
    assert [*bestfit._encoded(tok, pa.array([text, text]))] == [_plain()(text)] * 2
    assert sum("haus" in x for x in asked) == 1


def test_a_worker_holds_a_bounded_number_of_chunks():
    p = bestfit.Packing()
    assert p.cache_words <= 300_000     # of each of an executor's workers, beside what earlier stages left there
    tok = bestfit.ChunkCachingTokenizer(public_tokenizers.path("byte_bpe_50k.json"), 400)
    for n in range(60):
        list(bestfit._encoded(tok, pa.array([" ".join(f"w{n}x{k}" for k in range(100))])))
        assert len(tok._young) + len(tok._old) <= 400 + 2 * 300
