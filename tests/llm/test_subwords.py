"""Subword ids against the tokenizer itself, and hashes of spans."""

import random

import numpy as np
import pyarrow as pa
import pytest

from rivulet.llm import subwords as module
from rivulet.llm.packing import packed_documents
from rivulet.llm.queries import tokenizer
from rivulet.llm.subwords import bytes_of, in_parts, joined, span_hashes, spans_of, subwords


def doubled(first, second, steps=10):
    """Words of like structure that collide under every hash by powers modulo 2**64."""
    word = first
    for _ in range(steps):
        word += word.translate(str.maketrans(first + second, second + first))
    return word


TEXTS = ["", " ", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b", "don't it's 'tis   x", "\x1c\x1d x", "É 12éa  \n b", "中文 x",
         doubled("a", "b"), doubled("b", "a"), "x" + " " * 30_000 + "y", "word, next. 1 2" * 50]


@pytest.mark.parametrize("piece", [20, 1_000_000])
def test_ids_are_those_of_the_tokenizer(monkeypatch, piece):
    monkeypatch.setattr(module, "PIECE", piece)
    encoder = subwords(tokenizer())
    for text, ids in zip(TEXTS, encoder.encode(TEXTS)):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.sizes[ids].sum() == len(text.encode())


def test_words_of_like_structure_are_packed_by_their_own_ids(spark):
    docs = spark.createDataFrame([(1, doubled("a", "b")), (2, doubled("b", "a"))], "doc_id long, text string").coalesce(1)
    found = {r.doc_id: (r.length, r.ids_crc32) for r in packed_documents(docs, tokenizer()).collect()}
    assert found == {1: (342, 1902198809), 2: (343, 108583655)}


def test_span_hashes_depend_on_the_bytes_alone():
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(0, 3, int(n), dtype=np.uint8)) for n in rng.integers(1, 200, 3000)] + [doubled("a", "b").encode(), doubled("b", "a").encode()]
    data = np.frombuffer(b"".join(words + words[::-1]), np.uint8)
    sizes = np.array([len(w) for w in words + words[::-1]])
    ends = np.cumsum(sizes)
    found = {}
    for word, value in zip(words + words[::-1], span_hashes(data, ends - sizes, ends).tolist()):
        assert found.setdefault(word, value) == value
    assert len(set(found.values())) == len(found)


def ids_by_span(texts):
    encoder = subwords(tokenizer())
    spans, counts = spans_of(texts)
    spans = spans.dictionary_encode()
    ids, bounds = bytes_of(encoder.encode_spans(spans.dictionary).take(spans.indices))
    return [np.frombuffer(x, "<u2").tolist() for x in joined(ids, bounds[np.append(0, np.cumsum(counts))]).to_pylist()]


def test_ids_of_spans_are_those_of_the_text():
    rng = random.Random(5)
    bits = [" ", "  ", "\n", " \n", "\t", "a", "The", "don't", "'s", " 's", "é", "ß", "\xa0", "\u3000", "\u2003", " \xa0", "\x85", "\x1c", "1", "23"]
    bits += ["<|endoftext|>", "  <|endoftext|>", "<|endof", "text|>", "!", "...", "漢字", " 漢", "😀", " á", "\r\n", "\u200b", "\ufeff", " <", " >", "\x0b", "\x0c"]
    encoder = subwords(tokenizer()).tokenizer
    for _ in range(300):
        texts = ["".join(rng.choices(bits, k=rng.randrange(14))) for _ in range(rng.randrange(1, 8))]
        expected = [encoder.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids_by_span(pa.array(["before", *texts])[1:]) == expected
    assert ids_by_span(pa.array([], pa.string())) == []


def test_a_long_text_is_taken_in_parts(monkeypatch):
    text = "The of  and <|endoftext|> é\n" * 400 + "x" * 300
    whole = ids_by_span(pa.array([text]))
    monkeypatch.setattr(module, "PIECE", 500)
    parts = list(in_parts(pa.array([text])))
    assert len(parts) > 10 and b"".join(x[0].as_py() for x in parts).decode() == text
    assert [sum((ids_by_span(x)[0] for x in parts), [])] == whole
