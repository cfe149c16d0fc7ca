"""Operators against plain computations: near-duplicates, languages, mixing, personal data, the pipeline."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rivulet.llm import near
from rivulet.llm.language import predict_languages
from rivulet.llm.mixing import mix
from rivulet.llm.near import near_classes
from rivulet.llm import pii
from rivulet.llm.pii import Boosted, ListedRows, base_spans, personal_data, training_counts, training_rows

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe", "ri", "so", "ta") for b in ("na", "re", "li", "dos", "ven", "gar")]


# --- near-duplicates against all pairs --------------------------------------------------------


def plain_similarity(a, b):
    """Probability Jaccard of the counts of five-word shingles, by its definition."""
    total = 0.0
    for i in a.keys() & b.keys():
        total += 1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a.keys() | b.keys())
    return total


def shingled(text):
    words = text.lower().split()
    size = min(5, len(words))
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else Counter()


def edited(rng, words, share):
    return [rng.choice(WORDS) if rng.random() < share else w for w in words]


@pytest.mark.parametrize("block", [512, 4])
def test_near_classes_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    rng = random.Random(7)
    texts = []
    for _ in range(12):
        base = [rng.choice(WORDS) for _ in range(120)]
        texts += [" ".join(edited(rng, base, share)) for share in (0, 0.01, 0.01, 0.02, 0.02, 0.03)]
    common = [rng.choice(WORDS) for _ in range(60)]  # a crowd around one passage, its members more or less alike
    texts += [" ".join(common + [rng.choice(WORDS) for _ in range(n)]) for n in range(1, 30)]
    words = [f"w{i}" for i in range(19)]
    texts += [" ".join(words), " ".join(words[:16]), "", "short text", "short text"]  # 12 of 15 shingles: exactly 0.8
    sets = [shingled(t) for t in texts]
    head = list(range(len(texts)))

    def root(i):
        while head[i] != i:
            i = head[i]
        return i

    found = {r.doc_id: r.class_id for r in near_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    links = caught = 0
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and plain_similarity(sets[i], sets[j]) >= 0.8 - 1e-12:
                links += 1
                caught += found[i] == found[j]
                head[max(root(i), root(j))] = min(root(i), root(j))
    assert links > 60 and caught / links >= 0.9
    # No class joins what no chain of similar texts joins.
    assert all(root(i) == root(found[i]) for i in found)
    if block == 512:
        assert found == {i: root(i) for i in range(len(texts))}


# --- languages against a plain out-of-place distance --------------------------------------------


def plain_grams(text):
    words = re.findall(r"[^\W\d_]+", text.lower())
    return Counter(g for w in words for n in (1, 2, 3) for padded in [w if n == 1 else f" {w} "] for g in [padded[i : i + n] for i in range(len(padded) - n + 1)])


def test_languages_against_plain_profiles(spark):
    rng = random.Random(3)
    alphabets = {"aa": "abcdeé", "bb": "cdefg", "cc": "ghijà"}
    docs = []
    for i in range(160):
        lang = rng.choice(sorted(alphabets))
        text = " ".join("".join(rng.choice(alphabets[lang]) for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(1, 40)))
        docs.append((i, text, lang))
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    found = {r.doc_id: r for r in predict_languages(table).collect()}
    counts = defaultdict(Counter)
    for i, text, lang in docs:
        if not found[i].held_out:
            counts[lang] += plain_grams(text)
    # By falling count; ties by the letters as code points, a word's end before all of them, shorter ones first.
    key = lambda g: sum((1 if c == " " else ord(c)) << (21 * (len(g) - 1 - k)) for k, c in enumerate(g))
    ranked = lambda c: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], key(x[0])))][:300]
    profiles = {lang: {g: r for r, g in enumerate(ranked(c))} for lang, c in counts.items()}
    for i, text, _ in docs:
        own = ranked(plain_grams(text))
        distance = {lang: sum(abs(p[g] - r) if g in p else 300 for r, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(sorted(distance), key=distance.get)
        assert found[i].lang_pred == best and found[i].score == pytest.approx(1 - distance[best] / (300 * len(own)))


# --- mixing against a full sort ------------------------------------------------------------------


def test_mix_takes_the_smallest_keys_of_each_source(spark):
    from rivulet.llm.mixing import quality, sampling_key, words

    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 60))), rng.choice(["a", "b", "c", "d", None])) for i in range(800)]
    table = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4)
    keys = {r.doc_id: r.key for r in table.select("doc_id", sampling_key("doc_id", "source", "text", quality("text", words("text"))).alias("key")).collect()}
    found = defaultdict(list)
    for r in mix(table).collect():
        found[r.source].append(r)
    for rows in found.values():
        size, target = rows[0].source_size, rows[0].target
        assert size == sum(r.size for r in rows) and target <= 2 * size + 1e-6
        epochs, budget = int(target // size), target - int(target // size) * size
        expected, so_far = {}, 0
        for r in sorted(rows, key=lambda r: keys[r.doc_id]):
            so_far += r.size
            expected[r.doc_id] = (epochs + (budget > 0 and so_far - r.size / 2 <= budget)) * r.size
        assert {r.doc_id: r.taken for r in rows} == expected
        assert abs(sum(expected.values()) - target) <= max(r.size for r in rows)
    assert sum(rows[0].target for rows in found.values()) == pytest.approx(1.5 * sum(rows[0].source_size for rows in found.values()))


# --- personal data against the contract's patterns --------------------------------------------------


def plain_spans(text):
    def luhn(digits):
        doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
        return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0

    digits = lambda m: re.sub(r"[^0-9]", "", m[0])
    kinds = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, (pattern, good) in enumerate(kinds) for m in re.finditer(pattern, text) if good(m)]


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(11)
    parts = ["a@b.co", "x", ".", "@", "-", "+", " ", "1", "10", "255", "256", "0007", "4111 1111 1111 1111", "4111111111111111", "(", ")", "é", "a.b", "5500-0000-0000-0004"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 22)))
        assert base_spans(text) == plain_spans(text), text


def test_the_detector_learns_from_whole_documents_once(spark):
    texts = ["Write to jo@mail.example.org or call +1 555 010 9999", "Host 10.0.0.7 and 8.8.8.8", "nothing here", None] * 30
    docs = spark.createDataFrame([(i if i % 7 else None, t) for i, t in enumerate(texts)] + [(1, texts[0])] * 50, "doc_id long, text string")
    found = personal_data(docs.repartition(3)).collect()
    assert len(found) == docs.count() and sum(r.n_ip for r in found) == 60
    assert personal_data(docs.limit(0)).count() == 0 and personal_data(docs.filter("text = 'nothing here'")).agg(F.sum("n_ip")).first()[0] == 0


def test_the_detector_learns_from_every_document_and_row(spark):
    """Rows counted by Spark are all there are, and give the model that the listed ones give."""
    rng = random.Random(3)
    host = lambda: ".".join(str(rng.randrange(1, 280)) for _ in range(4))
    texts = [f"write to u{rng.randrange(99)}@mail.example.org, host {host()} of {rng.randrange(2000, 2030)}-03-11" for _ in range(4000)]
    texts.append(" ".join(f"a{i}@b{i % 7}.example.org" for i in range(200)))  # more rows than a document once gave
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = [row for t in texts for row in training_rows(t)]
    counted = training_counts(docs)
    assert counted.df.agg(F.sum("n")).first()[0] == len(rows) > 20_000
    listed = ListedRows(rows)
    assert counted.total(pii._outcomes).tolist() == listed.total(pii._outcomes).tolist()
    (a, x), (b, y) = (Boosted(trees=2).fit(r) for r in (counted, listed))
    assert a.start == b.start and all(p.tolist() == q.tolist() for p, q in zip(a.edges, b.edges))
    assert all(np.array_equal(p, q) for s, t in zip(a.forest, b.forest) for p, q in zip([*s[0], s[1]], [*t[0], t[1]]))
    assert np.array_equal(x.total(a.held_scores), y.total(b.held_scores))


# --- the pipeline, stage by stage --------------------------------------------------------------------


def test_pipeline_stages_one_after_the_other(spark, tmp_path):
    rng = random.Random(13)
    french = ["été", "forêt", "où", "près", "café", "leçon", "âme", "être"]
    base = [" ".join(rng.choice(WORDS) for _ in range(80)) for _ in range(40)] + [" ".join(rng.choice(french) for _ in range(60)) for _ in range(20)]
    docs = [(i, t, "xx" if i < 40 else "fr", f"s{i % 3}") for i, t in enumerate(base)]
    docs += [(100, base[0], "xx", "s0"), (101, base[1] + " \n", "xx", "s1"), (102, " ".join([*base[2].split()[:-1], "changed"]), "xx", "s2")]
    docs += [(200, "12 34 !!", "xx", "s0"), (201, None, "fr", "s1"), (202, "", None, None)]
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    table.write.parquet(f"{tmp_path}/documents.parquet")
    current, ids = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, str(tmp_path))
        assert current.columns == table.columns
        current.write.parquet(f"{tmp_path}/{name}")
        current = spark.read.parquet(f"{tmp_path}/{name}")
        ids.append(sorted(r.doc_id for r in current.collect()))
    language, exact, close, mixed = ids
    clean = [i for i, *_ in docs if i < 200]
    assert language == clean
    # Of equal texts the one with more code points stays, then the smaller id.
    assert exact == [i for i in clean if i not in (100, 1)]
    assert close == [i for i in exact if i != 102]
    taken = Counter(mixed)
    assert set(taken) <= set(close) and max(taken.values()) <= 2
    sizes = {i: len(t.split()) for i, t, *_ in docs if t}
    assert sum(sizes[i] * n for i, n in taken.items()) == pytest.approx(1.5 * sum(sizes[i] for i in close), rel=0.1)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == taken
    ends = defaultdict(list)
    for r in packed:
        ends[r.sequence_id].append((r.offset, r.length))
    for places in ends.values():
        places.sort()
        assert [a for a, _ in places] == [0, *np.cumsum([n for _, n in places])[:-1]] and sum(n for _, n in places) <= 1024
