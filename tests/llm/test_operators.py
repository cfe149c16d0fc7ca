"""Every training-data operator on one table of edge cases, against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rivulet.llm import repeats
from rivulet.llm.chat import conversation_digests, escape, format_conversations, read_turns, unescape
from rivulet.llm.chunks import pack_chunks, squeeze
from rivulet.llm.exact import exact_groups, keep_one_of_equals
from rivulet.llm.language import keep_known_languages, predict_languages
from rivulet.llm.lm import score_documents
from rivulet.llm.mixing import mix, mixed_documents
from rivulet.llm.near import _joined, _similar, keep_one_of_near, near_classes, probability_jaccard, shingles, similar
from rivulet.llm.packing import packed_documents, piece_bounds, plan_sequences
from rivulet.llm.pii import DOCUMENT_ROWS, Detector, base_spans, candidates, drawn_rows, personal_data, redacted, training_rows
from rivulet.llm.queries import tokenizer
from rivulet.llm.repeats import LEAST, least_ids, prefix_order, remove_repeats, separated
from rivulet.llm.subwords import subwords

WORDS = "the of and in that was for with as his on be at by had not are but from or have an they which one you were her all she".split()
RNG = np.random.default_rng(1)


def prose(n, seed):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] + str(j % 7) * (j % 5 == 0) for j, i in enumerate(rng.integers(0, len(WORDS), n)))


LONG = prose(6000, 9)
TEXTS = [
    (1, prose(200, 1), "en", "a"),
    (2, prose(200, 1), "en", "b"),  # equal to 1
    (3, prose(200, 1).replace(" ", "\n", 3), "en", None),  # equal but for white space
    (4, prose(199, 1) + " changed", "en", "a"),  # near 1
    (5, prose(60, 2) + " Write to jo.doe@mail.example.org or +1 (555) 010-9999, 10.0.0.300 8.8.8.8, 4111 1111 1111 1111.", None, "a"),
    (6, "", "en", "b"),
    (7, None, "fr", None),
    (8, None, None, None),
    (9, " \t\n", "en", "c"),
    (10, "Le café était très bon, où est la forêt éloignée près d'ici ? Élève où été.", "fr", "b"),
    (11, LONG, "en", "a"),
    (11, LONG, "en", "a"),  # a repeated row
    (12, "don't <|endoftext|> it's 'tis   x", "en", "c"),
    (13, "!!! 123 ???", "en", "c"),
    (None, prose(80, 3), "en", "a"),
    (14, prose(40, 4) + LONG[:400], "en", "d"),
]


@pytest.fixture(scope="module")
def docs(spark):
    schema = "doc_id long, text string, lang string, source string, name string, kept boolean, size int"
    rows = [(*row, "x", None, 1) for row in TEXTS]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def squashed(text):
    return re.sub(r"[\x20\x09-\x0D]+", "", text or "")


def test_exact_groups(docs, empty):
    found = exact_groups(docs).drop("n_chars").collect()
    groups = defaultdict(list)
    for doc_id, text, *_ in TEXTS:
        groups[squashed(text)].append((-len(text or ""), doc_id is None, doc_id))
    assert len(found) == len(TEXTS) and sum(r.kept for r in found) == len(groups)
    for r in found:
        own = next(g for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        assert (r.keep_id, r.group_size) == (min(own)[2], len(own))
    kept = keep_one_of_equals(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_groups(empty).count() == 0 and keep_one_of_equals(empty).count() == 0


def test_near_classes(docs, empty):
    found = near_classes(docs).collect()
    assert len(found) == len(TEXTS)
    by_id = {r.doc_id: r.class_id for r in found}
    assert by_id[1] == by_id[2] == by_id[3] == by_id[4] == 1
    assert all(by_id[i] == i for i in (5, 6, 7, 8, 9, 10, 11, 12, 13, 14, None))
    assert Counter(r.class_id for r in found if r.kept)[11] == 1 and sum(r.kept for r in found) == len(TEXTS) - 4
    assert keep_one_of_near(docs).count() == len(TEXTS) - 4
    assert near_classes(empty).count() == 0


def test_probability_jaccard_is_jaccard_for_even_weights():
    owner, keys, counts, _ = shingles([prose(50, 1), prose(48, 1) + " x y"])
    a, b = (dict(zip(keys[owner == i].tolist(), counts[owner == i].tolist())) for i in (0, 1))
    a, b = dict.fromkeys(a, 1), dict.fromkeys(b, 1)
    sets = [(np.array(sorted(s), dtype=np.uint64), np.ones(len(s), int)) for s in (a, b)]
    assert probability_jaccard(*sets) == pytest.approx(len(set(a) & set(b)) / len(set(a) | set(b)))
    x = (np.array([1, 2, 3], np.uint64), np.array([3, 1, 2]))
    y = (np.array([2, 3, 4], np.uint64), np.array([2, 2, 1]))
    wx, wy = dict(zip([1, 2, 3], [3, 1, 2])), dict(zip([2, 3, 4], [2, 2, 1]))
    slow = sum(1 / sum(max(wx.get(j, 0) / wx[i], wy.get(j, 0) / wy[i]) for j in {*wx, *wy}) for i in {*wx} & {*wy})
    assert probability_jaccard(x, y) == pytest.approx(slow)


def test_similarity_of_exactly_the_limit_links():
    even = lambda n: (np.arange(n, dtype=np.uint64), np.ones(n, int))
    assert all(similar(even(4 * k), even(5 * k)) and not similar(even(4 * k - 1), even(5 * k)) for k in range(1, 1000))
    # 1/5 + 3 * 1/5 with uneven weights, and just below it
    assert similar((np.arange(4, dtype=np.uint64), np.full(4, 3)), (np.arange(5, dtype=np.uint64), np.full(5, 7)))
    assert not similar((np.arange(5, dtype=np.uint64), np.array([1, 1, 1, 1, 2])), (np.arange(5, dtype=np.uint64), np.array([3, 3, 3, 3, 1])))
    for words, common in ((19, 16), (64, 52)):  # 12 of 15 shingles, 48 of 60
        text = " ".join(f"w{i}" for i in range(words))
        part = " ".join(text.split()[:common])
        pair = pa.record_batch({"a": pa.array([1]), "b": pa.array([2]), "text_a": [text], "text_b": [part]})
        assert next(_similar(iter([pair]))).column("similar").to_pylist() == [True]
        block = {"node": [1, 2], "class": [1, 2], "block": [0, 0], "band": [0, 0], "bands": [[1], [1]], "one": [True, True], "text": [text, part]}
        assert _joined(pa.table(block)).to_pylist() == [{"a": 1, "b": 2}]


def test_repeats_against_brute_force(docs, empty):
    found = {(r.doc_id, r.n_bytes): r for r in remove_repeats(docs).collect()}
    order = sorted(TEXTS, key=lambda t: (t[0] is None, t[0]))
    seen = defaultdict(list)
    for doc_id, text, *_ in order:
        data = (text or "").encode()
        for i in range(len(data) - LEAST + 1):
            seen[data[i : i + LEAST]].append(1 << 60 if doc_id is None else doc_id)
    for doc_id, text, *_ in order:
        data, own = (text or "").encode(), 1 << 60 if doc_id is None else doc_id
        gone = bytearray(len(data))
        for i in range(len(data) - LEAST + 1):
            if min(seen[data[i : i + LEAST]]) < own:
                gone[i : i + LEAST] = b"\1" * LEAST
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        r = found[(doc_id, len(data))]
        assert (r.n_removed, r.n_spans, r.kept_sha256) == (sum(gone), spans, hashlib.sha256(kept).hexdigest())
    assert remove_repeats(empty).count() == 0


@pytest.mark.parametrize("hot_runs, bits", [(50, 64), (0, 64), (10**6, 64), (50, 1), (0, 2), (10**6, 0)])
def test_repeats_split_hot_keys(monkeypatch, hot_runs, bits):
    """Also with hashes of so few bits that unlike bytes share them."""
    rng, sizes = np.random.default_rng(4), []
    letters = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes()
    grams = [letters(20) for _ in range(3000)]
    gram = min(grams, key=lambda g: repeats._gram_hashes(np.frombuffer(g, np.uint8))[0])
    texts = [letters(45) + gram + letters(45) for _ in range(300)]
    texts[40], texts[250], texts[299] = texts[7][5:95] + b"!", b"?" + texts[290], texts[0]
    texts += [letters(70), b"", letters(30)]
    ids = rng.permutation(len(texts)).tolist()
    monkeypatch.setattr(repeats, "HOT_RUNS", hot_runs)
    monkeypatch.setattr(repeats, "TRANSFORM_BYTES", 4000)
    hashes = repeats.span_hashes
    monkeypatch.setattr(repeats, "span_hashes", lambda *spans: hashes(*spans) & np.uint64(2**bits - 1))
    real = repeats.least_ids
    monkeypatch.setattr(repeats, "least_ids", lambda segments, own: sizes.append(sum(map(len, segments))) or real(segments, own))
    chunks = [{"chunk": c, "doc_id": ids[c::4], "lengths": [len(t) for t in texts[c::4]], "data": squeeze(b"".join(texts[c::4]))} for c in range(4)]

    def exchange(requests, replies):
        asked = [(part, c["chunk"], block) for c in chunks for part, block in requests(c)]
        found = defaultdict(list)
        for part in {a[0] for a in asked}:
            own = [a for a in asked if a[0] == part]
            for (_, chunk, _), reply in zip(own, replies([a[2] for a in own])[0]):
                found[chunk].append({"part": part, "reply": reply})
        return [c | {"replies": found[c["chunk"]]} for c in chunks]

    chunks = exchange(repeats._ask_keys(3), repeats._answer_keys)
    chunks = exchange(repeats._ask_surroundings(3), repeats._answer_surroundings)
    least = {}
    for i, t in zip(ids, texts):
        for at in range(len(t) - LEAST + 1):
            least[t[at : at + LEAST]] = min(i, least.get(t[at : at + LEAST], i))
    removed = 0
    for c in chunks:
        _, _, gone = repeats._covered(c)
        expected = b""
        for i, t in zip(c["doc_id"], texts[c["chunk"] :: 4]):
            mask = bytearray(len(t))
            for at in range(len(t) - LEAST + 1):
                if least[t[at : at + LEAST]] < i:
                    mask[at : at + LEAST] = b"\1" * LEAST
            expected += bytes(mask)
        assert gone.astype(np.uint8).tobytes() == expected
        removed += sum(expected)
    assert removed > 250
    assert max(sizes, default=0) <= 4000 or hot_runs > 50 or bits < 64
    assert sizes  # the transform decides about hot keys too


def test_spans_alike_by_their_bytes():
    data = np.frombuffer(b"abcdefghij" * 3 + b"abcdefghiX" + b"abcdefghij", np.uint8)
    first, size = np.array([0, 10, 30, 40, 1, 20]), np.array([10, 10, 10, 10, 9, 9])
    for names in (np.zeros(6, np.uint64), np.array([1, 1, 1, 1, 0, 1], np.uint64)):
        order, starts = repeats._alike(data, names, first, size)
        groups = {frozenset(g.tolist()) for g in np.split(order, starts[1:])}
        assert groups == {frozenset({0, 1, 3}), frozenset({2}), frozenset({4}), frozenset({5})}
    assert [len(x) for x in repeats._alike(data, names[:0], first[:0], size[:0])] == [0, 0]


def test_interval_expansion_finds_common_prefixes():
    text = np.append(RNG.integers(1, 3, 400), 0)  # texts end with a sign of their own
    order = prefix_order(text, 12)
    known = separated(text, order, 12)
    padded = [tuple(text[i : i + 12]) for i in order]
    for i in range(1, len(order)):
        if len(padded[i]) == len(padded[i - 1]) == 12:
            assert known[i] == (padded[i] != padded[i - 1])
    segments = [np.frombuffer(s, np.uint8) for s in (b"x" * 60, b"y" * 10 + b"x" * 55)]
    assert [set(x.tolist()) for x in least_ids(segments, np.array([7, 3]))][0] == {3}


def test_mixing(docs, empty):
    found = mix(docs).collect()
    sizes = Counter()
    for _, text, _, source in TEXTS:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        for s in over or open_:
            target[s] = 2.0 * sizes[s] if over else weight[s] * level
        left -= sum(target[s] for s in over)
        open_ = open_ - over if over else set()
    assert len(found) == len(TEXTS)
    for r in found:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source]
        assert r.taken in (0, r.size, 2 * r.size)
    assert sorted(rows_of(mix(docs)), key=repr) == sorted(map(tuple, found), key=repr)
    assert mixed_documents(docs).count() == sum(r.times for r in found)
    assert mix(empty).count() == 0 and mixed_documents(empty).count() == 0


def test_packing(docs, empty):
    found = packed_documents(docs, tokenizer(), keep_ids=True).collect()
    encoder = subwords(tokenizer()).tokenizer
    expected = Counter()
    for doc_id, text, *_ in TEXTS:
        ids = np.array([*encoder.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        for piece, (start, length) in enumerate(piece_bounds(len(ids), 1024)):
            expected[(doc_id, piece, start, length, zlib.crc32(ids[start : start + length].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert packed_documents(empty, tokenizer()).count() == 0


def test_best_two_fit_plans_every_piece():
    histogram = {n: int(c) for n, c in zip(range(1, 1025), RNG.integers(0, 50, 1024)) if c}
    plan = plan_sequences(histogram)
    assert sum((Counter({n: t * c for n, c in Counter(p).items()}) for t, p in plan), Counter()) == Counter(histogram)
    assert all(sum(p) <= 1024 for _, p in plan)
    assert sum(t for t, _ in plan) <= 1.02 * sum(n * c for n, c in histogram.items()) / 1024 + 1
    assert plan_sequences({600: 2, 300: 2, 124: 2, 200: 1, 224: 1}) and plan_sequences({}) == []


def test_subwords_equal_the_tokenizer():
    texts = [t or "" for _, t, *_ in TEXTS] + ["a　b ١٢ \x1c\x85 x​ ", "   ", "\n\n a  b\n"]
    encoder = subwords(tokenizer())
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_language(docs, empty):
    found = {r.doc_id: r for r in predict_languages(docs).collect()}
    assert found[7].lang_pred == found[6].lang_pred == found[13].lang_pred == "und" and found[7].score == 0
    assert found[1].lang_pred == "en" and all(0 <= r.score <= 1 for r in found.values())
    kept = keep_known_languages(docs)
    assert kept.columns == docs.columns and {1, 11, 14} <= {r.doc_id for r in kept.collect()}
    assert predict_languages(empty).count() == 0


def test_personal_data(docs, empty):
    text = TEXTS[4][1]
    spans = [(k, text[s:e]) for k, s, e in base_spans(text)]
    assert spans == [(0, "jo.doe@mail.example.org"), (1, "8.8.8.8"), (2, "4111 1111 1111 1111"), (3, "+1 (555) 010-9999")]
    r = {r.doc_id: r for r in personal_data(docs).collect()}[5]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1) and "[email]" in redacted(text, r.spans)
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"]
    for odd in ("a@b.c@d.e", "@@x.y", "a@b c@d.e.f.", "x@y..z", "é@a.b", "a" * 500 + "@b", "u@v.w-u@v.w"):
        assert [(s, e) for k, s, e in base_spans(odd) if k == 0] == [m.span() for m in re.finditer(patterns[0], odd)]
    assert personal_data(empty).count() == 0


def test_natural_masked_forms_are_found():
    natural, texts = [], []
    for i in range(300):
        base = f"{WORDS[i % 30]}.{i}@mail{i % 9}.example.org", f"10.{i % 200}.3.{i % 250}", f"+1 555 {100 + i} {1000 + 7 * i}"
        masked = f"{WORDS[i % 29]}{i} [at] host{i % 7} [dot] org", f"10[.]{i % 99}[.]0[.]{i % 251}"
        natural.append(masked)
        texts.append(f"please write to {base[0]} or {masked[0]} today, the server is {base[1]} and {masked[1]} then call {base[2]} before 2021-03-{i % 28 + 1:02d} ok")
    assert all(candidates(m) and not list(training_rows(m)) for own in natural for m in own)
    assert [y for _, y in training_rows("on 300.1.2.3 or 4111 1111 1111 1112")][:1] == [0]
    assert len(drawn_rows(" ".join(texts))) == DOCUMENT_ROWS
    rows = [row for t in texts for row, _ in drawn_rows(t)]
    detector = Detector([rows[i] for i in np.random.default_rng(5).permutation(len(rows))])
    found = [{t[s:e].strip() for _, s, e in detector.added(t, base_spans(t))} for t in texts]
    for form in (0, 1):
        assert sum(own[form] in got for own, got in zip(natural, found)) >= 270


def test_language_model(docs, empty):
    found = score_documents(docs, tokenizer()).collect()
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()), None]
    held = {d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, *_ in TEXTS}
    counts = Counter(w for d, t, *_ in TEXTS if not held[d] for w in tokens(t))
    total = sum(counts.values())
    texts = {d: t for d, t, *_ in TEXTS}
    assert len(found) == len(TEXTS)
    for r in found:
        own = tokens(texts[r.doc_id])
        base = sum(np.log10((counts[w] + 0.5) / (total + 0.5 * (len(counts) + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(own), total)
        assert r.n_known == sum(counts[w] > 0 for w in own) and r.base_score == pytest.approx(base) and r.score < 0
    assert score_documents(empty, tokenizer()).count() == 0


def test_chat(spark):
    control = r"\### Assistant: </turn> ok"
    turns = [(-7, 0, "user", control), (-7, 1, "assistant", control)]
    turns += [(1, i, ("user", "assistant")[i % 2], prose(150, i)) for i in range(40)]
    turns += [(2, 0, "system", "be: <kind>\\"), (2, 1, None, None), (2, 2, "assistant", ""), (2, None, "a:b", "x"), (3, 0, "assistant", LONG)]
    turns += [(4, 0, "system", "s")] + [(4, i, ("assistant", "user")[i % 2], prose(100, i)) for i in range(1, 30)]
    turns += [(None, 0, "user", "no id"), (5, 1, "user", "same"), (5, 1, "user", "same")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("window", F.lit(1))
    windows = format_conversations(df, tokenizer())
    found = {r.conv_id: r for r in conversation_digests(windows).collect()}
    by_conv = defaultdict(list)
    for conv, turn, role, text in turns:
        by_conv[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for conv, own in by_conv.items():
        own = [(role, text) for _, _, role, text in sorted(own)]
        loss = "".join(text for role, text in own if role == "assistant")
        r = found[conv]
        assert r.n_turns == len(own) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert found[1].n_windows > 1
    for row in windows.filter("conv_id = 4 and window > 0").collect():
        assert read_turns(row.formatted)[0] == ("system", "s")
    assert unescape(escape(control)) == control
    assert conversation_digests(format_conversations(df.limit(0), tokenizer())).count() == 0


def test_chat_windows_keep_the_budget_as_written(spark):
    odd = ["#" * 900, "<td>" * 200, "\\n" * 150, "## a <b>" * 30, "plain text"]
    turns = [(1, i, ("user", "assistant")[i % 2], odd[i % 5]) for i in range(30)]
    turns += [(2, i, "<a long role>:" * 9, "x") for i in range(60)]
    windows = format_conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), tokenizer()).collect()
    encoder = subwords(tokenizer()).tokenizer
    sizes = [(len(read_turns(w.formatted)), len(encoder.encode(w.formatted, add_special_tokens=False).ids)) for w in windows]
    assert any(n > 1 for n, _ in sizes) and all(tokens <= 1024 for n, tokens in sizes if n > 1)


def test_runs_are_looked_for_once(spark, monkeypatch):
    """The windows of a text are gone through once; later steps find its runs by their marks."""
    rng = np.random.default_rng(12)
    lengths = np.array([0, 700, 49, 50, 40_000, 3, 51, 90])
    data = rng.integers(97, 100, lengths.sum()).astype(np.uint8)
    found, chosen, calls = repeats.Runs(data, lengths), repeats._chosen, []
    monkeypatch.setattr(repeats, "_chosen", lambda data: calls.append(1) or chosen(data))
    marked = repeats.Runs(data, lengths, found.marks())
    assert not calls
    hashes, at = repeats._gram_hashes(data), 0
    for name in ("key", "doc", "first", "last"):
        assert (getattr(found, name) == getattr(marked, name)).all()
    for begin, n in zip(np.cumsum(lengths) - lengths, lengths):
        for place in range(begin, begin + n - repeats.LEAST + 1):
            at += place > found.last[at]
            assert found.first[at] <= place <= found.last[at] and found.key[at] in hashes[place : place + repeats.PLACES]
    assert at == len(found.key) - 1 and repeats._unmarked(repeats._marks(b"", []))[0].size == 0
