"""Near-duplicate vectors and the two audits, on edge cases, against brute force."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rivulet.llm import divergence, transducer, vectors
from rivulet.llm.divergence import audit_sources
from rivulet.llm.transducer import WordTable, audit_filters, figures
from rivulet.llm.vectors import Leaves, near_vectors

WHITE_RUN = r"[^\x20\x09-\x0D]+"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- the transducer -------------------------------------------------------------------------


def plain_figures(text):
    words = re.findall(WHITE_RUN, text or "")
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text or "")), len(text or ""), len(re.findall(r"[#$%&*|]", text or ""))]


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 64, 1_000_000])
def test_figures_in_pieces_of_any_size(monkeypatch, piece):
    monkeypatch.setattr(transducer, "PIECE_BYTES", piece)
    rng = random.Random(piece)
    for _ in range(60):
        texts = [None, ""] + ["".join(rng.choice("aAB #|é中😀 \t\n\x1f") for _ in range(rng.randrange(40))) for _ in range(5)]
        rng.shuffle(texts)
        assert figures(pa.array(texts, pa.string())).tolist() == [plain_figures(t) for t in texts]


def test_figures_of_long_words_and_sliced_arrays():
    texts = ["skipped", "a" * 70 + " " + "a" * 69 + "b " + "a" * 70, "x" * 5000 + " " + "x" * 4999 + "y", None]
    assert figures(pa.array(texts).slice(1)).tolist() == [plain_figures(t) for t in texts[1:]]


def test_words_with_one_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(WordTable, "_hashes", lambda self, start, length, owner: np.full(len(start), 5, dtype=np.uint64))
    text = " ".join(f"w{i % 40}" for i in range(400)) + " w1 " + "z" * 80 + " " + "z" * 81
    assert figures(pa.array([text, text])).tolist() == [plain_figures(text)] * 2


def test_text_longer_than_a_piece():
    rng = np.random.default_rng(3)
    text = " ".join(f"Wörter{i}" for i in rng.integers(0, 50_000, 300_000))
    assert len(text.encode()) > 3 * transducer.PIECE_BYTES
    assert figures(pa.array([text, "a b"])).tolist() == [plain_figures(text), plain_figures("a b")]


def brute_audit(docs, labels):
    marks = []
    for doc_id, text, source in docs:
        t = text or ""
        words, distinct, capitals, points, symbols = plain_figures(t)
        earlier = doc_id is not None and any(i is not None and i < doc_id and (x or "") == t for i, x, _ in docs)
        fails = {c for c, bad in zip("ABCDE", (words < 50, 100 * distinct < 65 * words, 100 * capitals > 5 * points, symbols, earlier)) if bad}
        own = [(q, x) for i, q, x in labels if i is not None and i == doc_id]
        marks.append((source or "", fails, any(q == 1 for q, _ in own), any(x == 1 for _, x in own)))
    out = []
    for part in {m[0] for m in marks}:
        own = [m for m in marks if m[0] == part]
        shapley, rows = Counter(), []
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [m for m in left if letter in m[1]]
                left = [m for m in left if letter not in m[1]]
                redundant = sum(letter in m[1] for m in own) - len(gone)
                unique = sum(m[1] == {letter} for m in own)
                shapley[letter] += len(gone)
                rows.append([part, "".join(order), step, len(left), len(gone), redundant, unique, sum(m[2] for m in gone), sum(m[3] for m in gone)])
        out += [(*row, shapley[row[1][row[2] - 1]]) for row in rows]
    return sorted(out, key=repr)


def test_filter_audit_against_brute_force(spark):
    rng = random.Random(2)
    pool = ["the of and", "Big LETTERS # here", "", "  ", " ".join(f"w{i}" for i in range(60)), " ".join("ab"[i % 2] for i in range(60))]
    docs = [(i if i % 11 else None, rng.choice([*pool, None]), rng.choice(["a", "b", "", None])) for i in range(80)]
    docs += docs[:5]  # repeated rows
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 60, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    table = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({"mask": F.lit("x"), "n": F.lit(1)})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert rows_of(audit_filters(table.repartition(3), marks)) == brute_audit(docs, labels)
    assert audit_filters(table.limit(0), marks).count() == 0
    assert audit_filters(table, marks.limit(0)).filter("good_lost > 0").count() == 0


# --- divergence of sources ------------------------------------------------------------------


def brute_divergence(docs, least, top):
    terms = defaultdict(Counter)
    seen = defaultdict(Counter)
    for _, lang, source, text in docs:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower))
        terms[lang or "", source or ""] += found
        seen[lang or ""].update(found.keys())
    out = []
    for lang in {lang for lang, _ in terms}:
        kept = sorted(t for t, n in seen[lang].items() if n >= least)
        groups = {s: c for (own, s), c in terms.items() if own == lang}
        whole = Counter()
        for c in groups.values():
            whole.update({t: c[t] for t in kept})

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return [1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept]

        parts = {s: shares(c) for s, c in groups.items()}
        of_all = shares(whole)
        apart = lambda p, q: (p - q) ** 2 // (p + q)
        for s, p in parts.items():
            pairs = [(sum(map(apart, p, q)), o) for o, q in parts.items() if o != s]
            pairs.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, s, "pair", o, v, r) for r, (v, o) in enumerate(pairs, 1)]
            more = [(apart(x, y), t) for x, y, t in zip(p, of_all, kept) if groups[s][t] and x > y]
            more.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, s, "term", t, v, r) for r, (v, t) in enumerate(more[:top], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("sets", [256, 2])
def test_source_divergence_against_brute_force(spark, monkeypatch, sets):
    monkeypatch.setattr(divergence, "SOURCE_SET", sets)
    monkeypatch.setattr(divergence, "MEETING_CELLS", 50)
    monkeypatch.setattr(divergence, "HELD_TERMS", 30)
    rng = random.Random(4)
    words = ["The", "of", "Été", "straße", "中文", "x_y", "don't", "a1b", "ÀÉ"] + [f"t{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(20)]
    docs = []
    for i in range(150):
        text = " ".join(rng.choice(words[: rng.choice([5, 30, len(words)])]) for _ in range(rng.randrange(40)))
        docs.append((i, rng.choice(["en", "en", "fr", None]), rng.choice(["a", "b", "c", "é", "", None]), rng.choice([text, text, None, ""])))
    docs += [(900, "xx", "lonely", "rare"), (901, "xx", "other", None), (902, "yy", "only", "")] + docs[:6]
    table = spark.createDataFrame(docs, "doc_id long, lang string, source string, text string")
    table = table.withColumns({"term": F.lit("x"), "n": F.lit(1), "p": F.lit(2)}).repartition(4)
    assert rows_of(audit_sources(table, least_documents=4, top=5)) == brute_divergence(docs, 4, 5)
    assert audit_sources(table.limit(0)).count() == 0


def test_shares_do_not_overflow(spark):
    row = spark.range(1).selectExpr("cast(8e12 as long) n", "cast(9e15 as long) total", "1234567 terms")
    expected = 1 + 10**9 * (8 * 10**12 + 2) // (9 * 10**15 + 2 * 1234567)
    assert row.select(divergence.share("n", "total", "terms").alias("p")).first().p == expected


# --- near vectors ---------------------------------------------------------------------------


def brute_near(rows, cosine):
    good = []
    for _, v in rows:
        usable = v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
        good.append(np.array(v, dtype=float) if usable else None)
    n = len(rows)
    links = [[] for _ in range(n)]
    for i in range(n):
        for j in range(i + 1, n):
            a, b = good[i], good[j]
            if a is not None and b is not None and len(a) == len(b):
                if a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= cosine:
                    links[i].append(j)
                    links[j].append(i)
    out, component = [], [None] * n
    for i in range(n):
        if component[i] is None:
            found, todo = {i}, [i]
            while todo:
                for j in links[todo.pop()]:
                    if j not in found:
                        found.add(j)
                        todo.append(j)
            for j in found:
                component[j] = found
    for i, (vec_id, _) in enumerate(rows):
        least = min((rows[j][0] for j in component[i] if rows[j][0] is not None), default=None)
        out.append((vec_id, len(links[i]), least, vec_id == least))
    return sorted(out, key=repr)


def crowded(seed=5, size=16):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(260):
        rows.append((i, rng.standard_normal(size)))
    for i in range(260, 380):  # chains and pairs near the limit
        base = rows[int(rng.integers(0, 260))][1]
        rows.append((i, base / np.linalg.norm(base) + rng.standard_normal(size) * rng.choice([0.02, 0.06, 0.08])))
    centre = rng.standard_normal(size)
    centre /= np.linalg.norm(centre)
    rows += [(i, centre + rng.standard_normal(size) * 0.025) for i in range(400, 560)]  # a crowd
    rows += [(i, rows[3][1]) for i in range(600, 640)]  # copies
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in rows]
    unlucky = [(700, None), (701, []), (702, [0.0] * size), (703, [float("nan")] * size), (704, [None] * size), (705, [1.0, 2.0])]
    return [*rows, *unlucky, (706, [2.0, 4.0]), (None, rows[0][1]), rows[1], (None, [5.0] * 3), (708, [-0.0, 1.0, 0.0]), (709, [0.0, 2.0, 0.0])]


@pytest.mark.parametrize("leaf, part", [(65_536, 32_768), (40, 24)])
def test_near_vectors_against_all_pairs(spark, monkeypatch, leaf, part):
    monkeypatch.setattr(vectors, "LEAF_NODES", leaf)
    monkeypatch.setattr(vectors, "PART_BYTES", part * 8 * 16)
    rows = crowded()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    table = table.withColumns({"node": F.lit(1), "key": F.lit("x"), "links": F.lit(0)}).repartition(3)
    assert rows_of(near_vectors(table)) == brute_near(rows, 0.95)


def test_near_vectors_of_doubles_at_the_limit(spark):
    # 19 / 20 is 0.95 exactly, in doubles too.
    rows = [(1, [1.0, 0, 0, 0, 0]), (2, [19.0, 6, 1, 1, 1]), (3, [19.0, 6, 1, 1, 1.0000001]), (4, [1e200, 0, 0, 0, 0]), (5, [0, 1e-200, 0, 0, 0])]
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    found = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(table).collect()}
    assert found == {1: (2, 1), 2: (3, 1), 3: (1, 1), 4: (2, 1), 5: (0, 5)}
    assert near_vectors(table.limit(0)).count() == 0


def test_hot_copies_are_joined_without_moving_rows(spark, monkeypatch):
    monkeypatch.setattr(vectors, "HOT_SHARE", 500)
    many = spark.range(3000).select(F.col("id").alias("vec_id"), F.expr("array(1f, 2f, cast(id % 1500 = 7 as float))").alias("embedding"))
    found = near_vectors(many).groupBy("n_links", "component_id").count().collect()
    assert sorted(tuple(r) for r in found) == sorted([(2997, 0, 2998), (1, 7, 2)]) or sorted(r["count"] for r in found) == [2, 2998]


def test_every_point_reaches_all_leaves_within_reach():
    points = np.random.default_rng(1).standard_normal((400, 3))
    leaves = Leaves.fitted(points[:100], 9)
    home, rows, other = leaves.dealt(points, 0.2)
    sent = set(zip(rows.tolist(), other.tolist()))
    for i in range(400):
        for j in range(400):
            if ((points[i] - points[j]) ** 2).sum() <= 0.2 and home[i] > home[j]:
                assert (i, int(home[j])) in sent


def test_vectors_are_not_written_once_for_each_meeting(spark, monkeypatch):
    """Every two packs meet, and yet no shuffle or stored table has more than each vector once."""
    monkeypatch.setattr(vectors, "PART_BYTES", 8 * 16 * 10)
    monkeypatch.setattr(vectors, "LEAF_NODES", 25)
    packs, plans, keep = [], [], vectors.stored

    def watched(df, purpose):
        out = keep(df, purpose)
        if purpose == "vector-packs":
            packs.append(out)
        if purpose == "vector-links":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(vectors, "stored", watched)
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.standard_normal(16)]) for i in range(200)]
    rows += [(1000 + i, v) for i, v in rows[:50]]
    near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert packs[0].count() >= 20 and packs[0].agg(F.sum(F.octet_length("data"))).first()[0] == 200 * 16 * 4
    assert "Exchange hash" not in plans[0] and "Exchange range" not in plans[0]
