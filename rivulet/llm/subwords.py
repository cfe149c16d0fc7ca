"""Byte-level BPE ids of texts, and hashes of byte spans.

The ids are those of `Tokenizer.from_file(..).encode(text, add_special_tokens=False)`.
They come from the same vocabulary as ranks (its `.tiktoken` twin), whose encoder keeps
nothing between calls: a worker holds the vocabulary and the ids of one piece of text.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import xxhash

SPECIAL = "<|endoftext|>"
PIECE = 1_000_000
# Between these a blank always begins a pre-token, so a text can be cut there.
CUT = re.compile(r"(?<=[A-Za-z0-9.,;]) (?=[A-Za-z0-9])")
# Longer runs of white space overflow the stack of the encoder's pattern engine.
BLANK = 10_000
BLANKS = re.compile(rf"\s{{{BLANK}}}")
HASHED = 128
# A blank before one of these bytes begins a pre-token whatever comes before: they are no white space, nor the first
# byte of any outside ASCII, and do not begin the special token.
AFTER_CUT = np.zeros(256, dtype=bool)
AFTER_CUT[0x21:0x7F] = True
AFTER_CUT[ord(SPECIAL[0])] = False
AFTER_CUT[0xC3:0xE1] = AFTER_CUT[0xE4:0xF5] = True
CUT_BYTES = re.compile(rb" (?=[\x21-\x3B\x3D-\x7E])")


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of these bytes, the same wherever the span lies.

    Eight bytes are mixed in at a time, each step multiplied and folded, so that texts
    of like structure do not collide as under a sum of powers. Longer spans than
    `HASHED` bytes are hashed one by one.
    """
    lengths = ends - starts
    out = lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eights = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1))
    going = np.flatnonzero(lengths <= HASHED)
    for at in range(0, HASHED, 8):
        going = going[lengths[going] > at]
        if not len(going):
            break
        loaded = eights[starts[going] + at].view(np.uint64).ravel()
        spare = np.clip(8 - (lengths[going] - at), 0, 7).astype(np.uint64) * np.uint64(8)
        mixed = (out[going] ^ (loaded << spare)) * np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(32)
        out[going] = mixed * np.uint64(0xC4CEB9FE1A85EC53)
    for i in np.flatnonzero(lengths > HASHED).tolist():
        out[i] ^= np.uint64(xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes()))
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts end to end, where each begins and the last ends); no text is null."""
    _, offsets, data = texts.cast(pa.binary()).buffers()
    bounds = np.frombuffer(offsets, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1] if offsets else np.zeros(1, np.int32)
    held = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]] if data else np.zeros(0, np.uint8)
    return held, bounds - bounds[0]


def joined(data: np.ndarray | bytes, bounds: np.ndarray) -> pa.Array:
    """The binary array whose values lie end to end in `data`."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)])


def in_parts(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts of one of `slices`: all of them, or parts of about `PIECE` bytes of one that is longer,
    cut where `spans_of` cuts."""
    data, _ = bytes_of(texts)
    at = 0
    if len(texts) == 1:
        while len(data) - at > 2 * PIECE:
            cut = CUT_BYTES.search(data, at + PIECE)
            if cut is None:
                break
            yield joined(data[at : cut.start()], np.array([0, cut.start() - at]))
            at = cut.start()
    yield joined(data[at:], np.array([0, len(data) - at])) if at else texts


def spans_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(spans, how many each text has): texts cut where the ids of both sides are those of the whole."""
    data, bounds = bytes_of(texts)
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[: len(data[1:])] = (data[:-1] == 0x20) & AFTER_CUT[data[1:]]
    begins[bounds[1:] - 1] = False  # what follows is another text
    begins[bounds[:-1]] = True
    starts = np.flatnonzero(begins[: len(data)])
    counts = np.diff(np.searchsorted(starts, bounds))
    return joined(data, np.append(starts, len(data))), counts


@dataclass
class Subwords:
    """Encoder over one vocabulary; `path` is the tokenizers file, its `.tiktoken` twin lies beside it."""

    path: str

    def __post_init__(self):
        import tiktoken
        from public_tokenizers import PATTERN

        self.ranks = {}
        with open(self.path.removesuffix(".json") + ".tiktoken", "rb") as lines:
            for line in lines:
                token, rank = line.split()
                self.ranks[base64.b64decode(token)] = int(rank)
        self.encoding = tiktoken.Encoding("subwords", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self.special = len(self.ranks)

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @cached_property
    def sizes(self) -> np.ndarray:
        """Bytes of each id."""
        out = np.zeros(len(self.ranks) + 1, dtype=np.int64)
        for token, rank in self.ranks.items():
            out[rank] = len(token)
        out[self.special] = len(SPECIAL)
        return out

    def _piece(self, text: str) -> np.ndarray:
        if len(text) >= BLANK and BLANKS.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.array(self.encoding.encode_ordinary(text), dtype=np.uint32)

    def _ordinary(self, text: str) -> list[np.ndarray]:
        """Ids of a text without the special token, a piece of about `PIECE` letters at a time."""
        out, at = [], 0
        while len(text) - at > 2 * PIECE:
            cut = CUT.search(text, at + PIECE)
            if cut is None:
                break
            out.append(self._piece(text[at : cut.start()]))
            at = cut.start()
        out.append(self._piece(text[at:] if at else text))
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit arrays."""
        out = []
        for text in texts:
            pieces = []
            for i, part in enumerate(text.split(SPECIAL)):
                if i:
                    pieces.append(np.array([self.special], dtype=np.uint32))
                pieces += self._ordinary(part)
            out.append(pieces[0] if len(pieces) == 1 else np.concatenate(pieces))
        return out

    def encode_spans(self, spans: pa.Array) -> pa.Array:
        """Ids of each span of `spans_of`, as little-endian unsigned 16-bit numbers end to end."""
        data, bounds = bytes_of(spans)
        starts, lengths = bounds[:-1], np.diff(bounds)
        # Those that begin with a cut are encoded as one text, and their ids told apart by the bytes they stand for.
        cut = (lengths > 1) & (data[starts] == 0x20)
        cut[cut] = AFTER_CUT[data[starts[cut] + 1]]
        at, alone = np.flatnonzero(cut), np.flatnonzero(~cut)
        made = [i.astype("<u2") for i in self.encode(spans.take(pa.array(alone)).cast(pa.string()).to_pylist())]
        ids = self.encode([bytes_of(spans.take(pa.array(at)))[0].tobytes().decode()])[0]
        ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum(lengths[at])) + 1
        every = np.concatenate([ids.astype("<u2"), *made])
        sizes = np.concatenate([np.diff(ends, prepend=0), [len(i) for i in made]]).astype(np.int64)
        out = joined(every.view(np.uint8), 2 * np.cumsum(np.append(0, sizes)))
        return out.take(pa.array(np.argsort(np.concatenate([at, alone]))))


@lru_cache(maxsize=2)
def subwords(path: str) -> Subwords:
    """One encoder per worker process."""
    return Subwords(path)
