"""The language model: gradients, windows, distributions, counts, and held-out text."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rivulet.llm import lm
from rivulet.llm.lm import (
    CLASSES, OVERLAP, START, VOCABULARY, WIDTH, WINDOW, AttentionModel, encoded_rows, least_count, pair_counts, score_documents,
    train_model, windows_of, word_counts,
)
from rivulet.llm.queries import tokenizer
from rivulet.llm.subwords import subwords


def small_parameters(rng, rows):
    shapes = {"e": (rows, WIDTH), "at": (WINDOW, WIDTH), "q": (WIDTH, lm.HEAD), "k": (WIDTH, lm.HEAD), "v": (WIDTH, lm.HEAD)}
    shapes |= {"a": (WIDTH, CLASSES), "b": (lm.HEAD, CLASSES), "c": (CLASSES,)}
    return {n: rng.standard_normal(s) * 0.3 for n, s in shapes.items()}


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    p = small_parameters(rng, 9)
    tokens = rng.integers(0, 9, (3, WINDOW))
    classes = rng.integers(0, CLASSES, (3, WINDOW - OVERLAP))
    use = (rng.random((3, WINDOW - OVERLAP)) < 0.7).astype(float)

    def loss(p):
        x = p["e"][tokens] + p["at"]
        tail = x[:, OVERLAP:]
        scores = (tail @ p["q"]) @ (x @ p["k"]).transpose(0, 2, 1) / np.sqrt(lm.HEAD) + lm._MASK
        a = np.exp(scores - scores.max(axis=-1, keepdims=True))
        a /= a.sum(axis=-1, keepdims=True)
        logits = tail @ p["a"] + a @ (x @ p["v"]) @ p["b"] + p["c"]
        logs = logits - np.log(np.exp(logits).sum(axis=-1, keepdims=True))
        chosen = np.take_along_axis(logs, classes[..., None], axis=-1)[..., 0]
        return -(chosen * use).sum() / use.sum()

    grads = AttentionModel._gradients(p, tokens, classes, use)
    for name in p:
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in p[name].shape)
            up, down = {n: x.copy() for n, x in p.items()}, {n: x.copy() for n, x in p.items()}
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            assert grads[name][at] == pytest.approx((loss(up) - loss(down)) / 2e-5, abs=2e-5)


def test_each_place_is_scored_once_with_what_came_before():
    lengths = np.array([1, 5, WINDOW - OVERLAP, WINDOW, 100, 2])
    places, scored = windows_of(lengths)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    seen = Counter()
    for row, use in zip(places, scored):
        for i, place in enumerate(row[OVERLAP:]):
            if use[i]:
                seen[int(place)] += 1
                before = row[: OVERLAP + i]
                real = before[before >= 0]
                assert (owner[real] == owner[place]).all() and (np.diff(np.append(real, place)) == 1).all()
    assert seen == Counter(range(int(lengths.sum())))


def model_of(texts):
    """A model with statistics of these texts and untrained weights."""
    encoder = subwords(tokenizer())
    sequences = [np.append(x.astype(int), START) for x in encoder.encode(texts)]
    pairs = Counter((int(a), int(b)) for s in sequences for a, b in zip(np.append(START, s[:-1]), s))
    before, ids = (np.array(x) for x in zip(*pairs))
    n = np.array(list(pairs.values()))
    around = np.random.default_rng(2).standard_normal((VOCABULARY, 48)).round(1)
    model = AttentionModel(np.bincount(ids, n, VOCABULARY), around)
    cells = Counter()
    for (b, i), k in pairs.items():
        cells[int(model.class_of[b]), i] += k
    classes, subs = (np.array(x) for x in zip(*cells))
    model.emissions(classes, subs, np.array(list(cells.values())))
    model.keep_pairs(before, ids, n)
    p = model.untrained()
    model.fold(p)
    return model, p, sequences


def test_batched_windows_score_like_a_plain_loop():
    model, p, sequences = model_of(["the of and in that was for " * 30, "a b", ""])
    expected = []
    for sequence in sequences:
        read = np.append(START, sequence[:-1])
        for at in range(len(sequence)):
            begin = at // (WINDOW - OVERLAP) * (WINDOW - OVERLAP) - OVERLAP
            inside = np.arange(begin, at + 1)
            tokens = np.where(inside < 0, START, read[np.maximum(inside, 0)])
            x = p["e"][tokens].astype(np.float64) + p["at"][: len(inside)]
            weight = np.exp((x[-1] @ p["q"]) @ (x @ p["k"]).T / np.sqrt(lm.HEAD))
            z = weight / weight.sum() @ (x @ p["v"])
            logits = x[-1] @ p["a"] + z @ p["b"] + p["c"]
            of_class = logits[model.class_of[sequence[at]]] - np.log(np.exp(logits).sum())
            emitted = model.emitted(read[at : at + 1], sequence[at : at + 1])[0]
            expected.append(of_class / np.log(10) + np.log10(emitted))
    assert model.token_logs(sequences) == pytest.approx(np.array(expected), abs=1e-4)


def test_subwords_of_each_class_add_up_to_one():
    model, _, sequences = model_of(["the of and in that was for the the the", "zebra zebra zebra"])
    every = np.arange(VOCABULARY)
    for before in {START, *np.concatenate(sequences).tolist(), 7}:
        sums = np.bincount(model.class_of, model.emitted(np.full(VOCABULARY, before), every), CLASSES)
        assert sums[np.unique(model.class_of)] == pytest.approx(1, abs=1e-4)


def fold_of(docs):
    return docs.withColumn("held_out", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1)


def test_statistics_cover_all_training_documents(spark, monkeypatch):
    monkeypatch.setattr(lm, "HELD_PAIRS", 50)
    texts = [f"w{i} the of and" for i in range(300)] + ["zebra " * 3000, None, ""]
    rows = fold_of(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).fillna("", "text").repartition(4)
    held = {r.doc_id: r.held_out for r in rows.collect()}
    encoded = encoded_rows(rows, tokenizer(), {b"the": 5}, 10, 3)
    encoder, pairs, words = subwords(tokenizer()).tokenizer, Counter(), Counter()
    for i, t in enumerate(texts):
        if not held[i]:
            ids = [START, *encoder.encode(t or "", add_special_tokens=False).ids, START]
            pairs.update(zip(ids[:-1], ids[1:]))
            words.update([*(t or "").encode().split(), lm.END_WORD])
    assert {(r.before, r.subword): r.n for r in pair_counts(encoded).collect()} == pairs
    assert {bytes(r.word): r.n for r in word_counts(rows).collect()} == words
    trained = train_model(encoded).token_logs([np.array(x) for x in ([START], encoder.encode("the of and").ids)])
    assert np.isfinite(trained).all() and (trained < 0).all()


def test_the_table_of_frequent_rows_is_bounded(spark):
    counts = spark.range(1000).selectExpr("id", "cast(1000 / (id + 1) as long) as n")
    for most in (10, 100, 999):
        assert counts.filter(F.col("n") >= least_count(counts, most)).count() <= most
    assert least_count(counts.limit(0), 5) >= 1


def test_rare_and_known_words_give_one_base(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"the The of zebra{i % 7} Ünï {'x' * 90} the") for i in range(40)], "doc_id long, text string")
    whole = sorted(tuple(r[:6]) for r in score_documents(docs, tokenizer()).collect())
    monkeypatch.setattr(lm, "HOT_WORDS", 2)  # nearly every word goes through the join
    few = sorted(tuple(r[:6]) for r in score_documents(docs, tokenizer()).collect())
    assert [r[:5] for r in few] == [r[:5] for r in whole]
    assert [r[5] for r in few] == pytest.approx([r[5] for r in whole])


def test_rare_and_kept_pairs_give_one_score(spark, monkeypatch):
    texts = [f"the of and {w} river{i % 9} {w} hill{i % 5}{w}" for i, w in enumerate(["stone", "winter", "ly", "zebra", ""] * 8)]
    docs = spark.createDataFrame([*enumerate(texts), (98, None), (99, "never seen Ünï")], "doc_id long, text string").repartition(3)
    whole = {r.doc_id: r.score for r in score_documents(docs, tokenizer()).collect()}
    for most in (10, 0):  # most pairs, or all, go through the join
        monkeypatch.setattr(lm, "KEPT_PAIRS", most)
        assert {r.doc_id: r.score for r in score_documents(docs, tokenizer()).collect()} == pytest.approx(whole, abs=1e-3)


def test_held_out_prose_scores_better_than_the_base(spark):
    rng = np.random.default_rng(3)
    follows = {w: rng.choice(40, 3) for w in range(40)}
    names = [f"{a}{b}" for a in ("win", "sum", "riv", "sto", "hill") for b in ("ter", "mer", "er", "ne", "side", "ly", "ed", "ing")]

    def prose(n):
        at, out = int(rng.integers(40)), []
        for _ in range(n):
            out.append(names[at])
            at = int(rng.choice(follows[at]))
        return " ".join(out)

    docs = spark.createDataFrame([(i, prose(300)) for i in range(150)], "doc_id long, text string")
    held = score_documents(docs, tokenizer()).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert held.s > held.b


def test_weights_learn_from_every_place(monkeypatch):
    """Of many windows too: each place is scored in a step of each pass."""
    rng = np.random.default_rng(4)
    sequences = [rng.integers(0, 50, n) for n in (300_000, 5, 250_000, 1, 77)]
    trained = []

    def counted(p, tokens, classes, use):
        trained.append(int(use.sum()))
        return {n: np.zeros_like(x) for n, x in p.items()}

    monkeypatch.setattr(AttentionModel, "_gradients", staticmethod(counted))
    p = {n: x.astype(np.float32) for n, x in small_parameters(rng, VOCABULARY).items()}
    for number in range(lm.ROUNDS):
        trained.clear()
        AttentionModel.learn(p, np.arange(VOCABULARY) % CLASSES, sequences, number, 0)
        assert len(trained) >= lm.LEAST_STEPS and sum(trained) == sum(map(len, sequences))


def test_words_are_those_of_the_pattern():
    texts = ["", " ", "A bÜ\x0b\x0cC\n", "x", " y  Z\t", "\x1c\x85\xa0 É", "last"]
    words, counts = lm.words_of(pa.array(["before", *texts])[1:])
    expected = [re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()) for t in texts]
    assert words.to_pylist() == sum(expected, []) and counts.tolist() == list(map(len, expected))


def test_what_comes_again_is_encoded_once(monkeypatch):
    """The encoder's work goes by the distinct spans of a slice of texts, not by its length."""
    texts = [f"the of and in that {w}, was for" for w in ("one", "two", "six")] * 500
    encoder, given = subwords(tokenizer()), []
    expected = [x.tolist() for x in encoder.encode(texts)]
    encode = encoder.encode
    monkeypatch.setattr(encoder, "encode", lambda parts: given.extend(parts) or encode(parts))
    ids, n_words, n_known, base, text, word, often = lm._measured(pa.array(texts), encoder, (pa.array([b"the"]), np.array([-0.5])))
    assert [np.frombuffer(x, "<u2").tolist() for x in ids.to_pylist()] == expected
    assert sum(map(len, given)) < 100
    assert set(n_words) == {8} and set(n_known) == {1} and set(base) == {-0.5}
    assert Counter(text.tolist()) == Counter({i: 7 for i in range(1500)}) and set(often) == {1} and b"the" not in word.to_pylist()


def test_long_and_short_texts_are_measured_alike(spark, monkeypatch):
    docs = [(1, "the The zebra of  Ünï\n" * 300), (2, "the zebra"), (3, None), (4, "")]
    rows = fold_of(spark.createDataFrame(docs, "doc_id long, text string")).fillna("", "text").coalesce(1)

    def measured():
        out = {}
        for r in encoded_rows(rows, tokenizer(), {b"the": 5, b"of": 2}, 10, 3).collect():
            rare = Counter()
            for w, n in zip(r.rare, r.rare_n):
                rare[bytes(w)] += n
            out[r.doc_id] = (bytes(r.ids), r.n_tokens, r.n_known, round(r.base, 6), rare)
        return out

    whole = measured()
    assert whole[1][1:3] == (1501, 900) and whole[1][4] == {b"zebra": 300, "Ünï".encode().lower(): 300, lm.END_WORD: 1}
    monkeypatch.setattr(lm, "SLICE_BYTES", 100)  # a text longer than this is alone
    assert measured() == whole


def test_a_step_in_64_and_32_bits_agree_where_scores_are_large():
    """Also where scores are beyond what needs no care for its exponential."""
    rng = np.random.default_rng(6)
    p = {n: x * 3 for n, x in small_parameters(rng, 40).items()}
    tokens, classes = rng.integers(0, 40, (70, WINDOW)), rng.integers(0, CLASSES, (70, WINDOW - OVERLAP))
    use = np.ones((70, WINDOW - OVERLAP))
    wide = AttentionModel._gradients(p, tokens, classes, use)
    narrow = AttentionModel._gradients({n: x.astype(np.float32) for n, x in p.items()}, tokens.astype(np.uint16), classes, use.astype(np.float32))
    for n in p:
        assert np.isfinite(narrow[n]).all() and narrow[n].dtype == np.float32
        assert narrow[n] == pytest.approx(wide[n], abs=2e-2 * np.abs(wide[n]).max())
