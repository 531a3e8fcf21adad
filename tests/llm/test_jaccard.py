"""The n-gram join against all pairs."""

import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from encore.llm import jaccard, tables

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=4):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))}


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            m = len(sets[i] & sets[j])
            if m and 100 * m >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min(least.get(r, (True, 1 << 62)), (d is not None, d or 0))
    return sorted(((d, len(sets[i]), least[find(i)][1] if least[find(i)][0] else None)
                   for i, (d, _) in enumerate(rows)), key=repr)


def near_copies(seed=13, groups=6, copies=14):
    """Groups around the threshold, chains, and a passage that many otherwise different texts share."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeÉ") for _ in range(rnd.randint(1, 5)))
    passage = [word() for _ in range(60)]
    texts = [None, "", " \n", "one", "One", "a b c", "a b c d", "a b c d e", "漢 字 a b é"]
    for g in range(groups):
        base = [word() for _ in range(rnd.choice([9, 12, 30, 60, 150, 300]))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 40))):
                w[rnd.randrange(len(w))] = word()
            if rnd.random() < 0.3:
                w = w[:len(w) - rnd.randint(0, len(w) // 6)]
            texts.append(" ".join(w))
            base = w if rnd.random() < 0.3 else base
    for k in (0, 3, 8, 12, 30):
        texts += [" ".join(passage + [word() for _ in range(k)]) for _ in range(8)]
    texts += texts[-3:]
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)] + [(None, texts[20]), (None, "alone in this table of texts"), (7, texts[20])]
    rnd.shuffle(rows)
    return rows


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("single, pairs, block", [(32, 2048, 1024), (2, 6, 5), (1, 1, 1024)])
def test_join_equals_all_pairs(spark, monkeypatch, single, pairs, block):
    monkeypatch.setattr(jaccard, "SINGLE", single)
    monkeypatch.setattr(jaccard, "PAIRS", pairs)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "LIST_BLOCK", block)
    rows = near_copies()
    docs = spark.createDataFrame([(d, t, i, "x") for i, (d, t) in enumerate(rows)],
                                 "doc_id long, text string, node long, key string").repartition(4)
    assert rows_of(jaccard.joined(docs)) == brute(rows)


def test_documents_of_the_other_operators(documents, no_documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert rows_of(jaccard.joined(documents)) == brute(rows)
    assert jaccard.joined(no_documents).count() == 0


def test_similar_sets_always_share_a_key(monkeypatch):
    """Prefixes of sets at the threshold meet, whatever the counts of their tokens."""
    rnd = np.random.default_rng(4)
    for single, pairs in ((32, 2048), (2, 5), (0, 9), (0, 0)):
        monkeypatch.setattr(jaccard, "SINGLE", single)
        monkeypatch.setattr(jaccard, "PAIRS", pairs)
        for _ in range(400):
            n = int(rnd.integers(6, 400))
            universe = rnd.integers(0, 2 ** 63, 2 * n).astype(np.uint64)
            times = dict(zip(universe.tolist(), rnd.integers(2, 12, 2 * n).tolist()))
            x, y = set(universe[:n].tolist()), set(universe[:n].tolist())
            other = iter(universe[n:].tolist())
            while True:
                z = set(y)
                kind = rnd.integers(0, 3)
                if kind != 1:
                    z.remove(rnd.choice(sorted(z)))
                if kind != 0:
                    z.add(next(other))
                if 100 * len(x & z) < 85 * len(x | z):
                    break
                y = z
            keys = []
            for s in (x, y):
                t = np.array(sorted(s), np.uint64)
                keys.append(set(jaccard.combined(len(t), np.array([times[v] for v in t.tolist()]), t, 85).tolist()))
            assert x == y or keys[0] & keys[1]


def test_long_text(spark):
    words = [f"w{i}" for i in range(150_000)]
    edited = words[:70_000] + ["x"] * 50 + words[70_050:]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(words[:100_000]))],
                                 "doc_id long, text string")
    assert [(r.n_shingles, r.component_id) for r in jaccard.joined(docs).orderBy("doc_id").collect()] == [
        (149_997, 1), (len(shingles(" ".join(edited))), 1), (99_997, 3)]


def test_parities_never_refute_similar_sets():
    rng = np.random.default_rng(7)
    for _ in range(600):
        n = int(rng.integers(1, 700))
        x = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        y = np.unique(np.concatenate((x[rng.random(len(x)) > 0.08], rng.integers(0, 2 ** 63, n // 12).astype(np.uint64))))
        shared = len(np.intersect1d(x, y))
        if 100 * shared >= 85 * (len(x) + len(y) - shared):
            a, c = sorted((jaccard._words(jaccard.parities(v)) for v in (x, y)), key=len)
            assert jaccard._may_be_alike(a, c, len(x) + len(y), 85)


def test_texts_and_sets_without_a_partner_stay_where_they_are(spark, monkeypatch):
    """Only what a join can meet is shuffled: texts of the classes left, sets of the pairs to confirm."""
    rnd = random.Random(3)
    rows = [(i, " ".join(f"{i}w{rnd.random()}" for _ in range(120))) for i in range(200)]
    rows += [(1000 + i, rows[i][1] + " end") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    moved = []
    class_texts = jaccard.class_texts
    monkeypatch.setattr(jaccard, "class_texts", lambda d, *rest: moved.append(d.count()) or class_texts(d, *rest))
    assert rows_of(jaccard.joined(docs)) == brute(rows)
    assert len(moved) == 1 and 6 <= moved[0] <= 12


@pytest.mark.parametrize("words", [1, 64, 1 << 18])
def test_sift_loses_no_wanted_row(spark, monkeypatch, words):
    monkeypatch.setattr(tables, "SIFT_WORDS", words)
    rows = spark.range(-500, 4000).selectExpr("id", "id * 7 AS th")
    wanted = rows.filter("id % 50 = 0").unionAll(rows.filter("id < 0"))
    got = tables.sifted(rows, [F.col("id"), F.col("th")], wanted)
    assert wanted.exceptAll(got).exceptAll(rows.filter("id < 0 AND id % 50 = 0")).isEmpty()
    assert got.count() == got.distinct().count() <= 4500
    assert words < 1 << 18 or got.count() < 700
    assert tables.sifted(rows, [F.col("id"), F.col("th")], wanted.limit(0)).isEmpty()
