"""Language identification by rank-order profiles.

A profile is the list of the most frequent letter n-grams (one to three, with word
ends) by falling frequency. A document goes to the language whose profile has its
n-grams least out of place. Language profiles count all training texts: tasks count
in arrays, Spark adds up, and one short list per language comes to the driver.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import mapped, slices, text_id_crc

PROFILE = 300
UNKNOWN = "und"
GAP = 1  # stands for all that is not a letter
FOLDS, HELD_OUT = 4, 2
# Texts of the pipeline below this score look like none of the languages.
LEAST_SCORE = 0.15


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case letter of every code point, `GAP` for what is no letter."""
    table = np.full(0x110000, GAP, dtype=np.int64)
    for c in range(0x110000):
        ch = chr(c)
        if unicodedata.category(ch)[0] == "L":
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def grams(text: str) -> np.ndarray:
    """The n-grams of a text, each packed into one number; none crosses a word's end."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le"), dtype=np.uint32)
    x = _letters()[points]
    keep = np.ones(len(x), dtype=bool)
    keep[1:] = (x[1:] != GAP) | (x[:-1] != GAP)
    x = x[keep]
    if len(x) < 3:
        return np.zeros(0, np.int64)
    pairs = (x[:-1] << 21) | x[1:]
    triples = (pairs[:-1] << 21) | x[2:]
    return np.concatenate([x[x != GAP], pairs, triples[x[1:-1] != GAP]])


def top_grams(text: str, size: int) -> np.ndarray:
    """The most frequent n-grams by falling count; ties by the n-gram itself."""
    distinct, counts = np.unique(grams(text), return_counts=True)
    return distinct[np.argsort(-counts, kind="stable")[:size]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def flush():
        for lang, (keys, counts) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)], names=["lang", "gram", "count"]
            )
        held.clear()

    for batch in slices(batches, "text"):
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            keys, counts = np.unique(grams(" ".join(texts)), return_counts=True)
            if lang in held:
                keys = np.concatenate([held[lang][0], keys])
                counts = np.concatenate([held[lang][1], counts])
                keys, where = np.unique(keys, return_inverse=True)
                counts = np.bincount(where, weights=counts, minlength=len(keys)).astype(np.int64)
            held[lang] = (keys, counts)
        if sum(len(keys) for keys, _ in held.values()) > 500_000:
            yield from flush()
    yield from flush()


def learn_profiles(labelled: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """Profiles from all rows of (text, lang) where both are there.

    The result holds `size` numbers per language: bounded by the label set.
    """
    rows = labelled.select("lang", "text").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = mapped(rows, _count, "lang string, gram long, count long")
    sums = counts.groupBy("lang", "gram").agg(F.sum("count").alias("count"))
    order = Window.partitionBy("lang").orderBy(F.desc("count"), "gram")
    best = sums.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    profiles: dict[str, list[int]] = {}
    for row in best.orderBy("lang", "rank").collect():
        profiles.setdefault(row.lang, []).append(row.gram)
    return profiles


class Profiles:
    """Out-of-place distances of texts to all languages at once."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.size = size
        self.langs = sorted(profiles)
        self.keys = np.unique(np.array([k for p in profiles.values() for k in p], dtype=np.int64))
        self.ranks = np.full((len(self.keys) + 1, len(self.langs)), -1, dtype=np.int64)
        for j, lang in enumerate(self.langs):
            listed = np.array(profiles[lang], dtype=np.int64)
            self.ranks[np.searchsorted(self.keys, listed), j] = np.arange(len(listed))

    def predict(self, text: str | None) -> tuple[str, float]:
        own = top_grams(text, self.size) if text else ()
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.keys, own)
        at[(at == len(self.keys)) | (self.keys[np.minimum(at, len(self.keys) - 1)] != own)] = len(self.keys)
        ranks = self.ranks[at]
        apart = np.abs(ranks - np.arange(len(own))[:, None])
        distance = np.where(ranks < 0, self.size, apart).sum(axis=0)
        best = int(distance.argmin())
        return self.langs[best], float(1.0 - distance[best] / (self.size * len(own)))


def identify_language(
    docs: DataFrame, profiles: dict[str, list[int]], text_column: str = "text", prefix: str = "", size: int = PROFILE
) -> DataFrame:
    """`docs` with `lang_pred` and `score` (names begin with `prefix`).

    `und` with score 0 for a NULL text, a text without letters, or no profile at
    all. Equal distances: the language that sorts first. A score of 1 means that
    every n-gram is in its place, 0 that none is in the profile.
    """
    columns, names = docs.columns, [f"{prefix}lang_pred", f"{prefix}score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(profiles, size)
        for batch in slices(batches, text_column):
            made = [model.predict(t) for t in batch.column(text_column).to_pylist()]
            new = [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], *new], names=[*columns, *names])

    schema = T.StructType([*docs.schema.fields]).add(names[0], T.StringType()).add(names[1], T.DoubleType())
    return mapped(docs, run, schema)


def predict_languages(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Learns from text and lang of the rows that are not held out.
    """
    held_out = F.pmod(text_id_crc("doc_id"), F.lit(FOLDS)) == HELD_OUT
    profiles = learn_profiles(docs.filter(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return identify_language(rows, profiles).drop("text")


def keep_known_languages(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """`docs`, all its columns, without rows of no known language."""
    held_out = F.pmod(text_id_crc("doc_id"), F.lit(FOLDS)) == HELD_OUT
    profiles = learn_profiles(docs.filter(~held_out))
    judged = identify_language(docs, profiles, prefix="_rv_")
    return judged.filter((F.col("_rv_lang_pred") != UNKNOWN) & (F.col("_rv_score") >= least_score)).select(*docs.columns)
