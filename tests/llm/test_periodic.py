"""Periodic runs against a search of all starts and periods."""

import hashlib
import random
import re
import zlib

from encore.llm import periodic

from .conftest import SCHEMA

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)  # a longer period of the same stretch isn't the smallest
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def repeating_rows():
    rnd = random.Random(11)
    rows = [(None, "a a a a a a"), (None, None), (None, "a a a a a a"), (3, ""), (3, "x " * 6), (3, "x " * 5),
            (4, " \t\n"), (5, "a b a b a b a b"), (5, "a b a b a b a"), (6, "á 漢 á 漢 á 漢 á 漢 á x" * 3),
            (7, ("w " * 7 + "v ") * 30), (8, "".join(f"w{i % 197} " for i in range(2_000))),
            (9, " ".join(rnd.choice("ab") for _ in range(1500))), (10, "long" * 50_000 + " b" * 40)]
    for doc_id in range(100, 420):
        rows.append((doc_id, "".join(rnd.choice("abc"[:rnd.randint(1, 3)]) + rnd.choice([" ", "\n", "  "])
                                     for _ in range(rnd.randint(0, 90)))))
    return rows


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_every_run_of_short_sequences():
    rnd = random.Random(5)
    for _ in range(1500):
        words = [rnd.randint(1, rnd.choice([1, 2, 3])) for _ in range(rnd.randint(0, 60))]
        assert periodic.repeats(words) == brute_runs(words)


def test_smallest_period_and_other_bounds():
    assert periodic.repeats([1, 2] * 8) == [(0, 16, 2)]
    assert periodic.repeats([1] * 6) == [(0, 6, 1)]
    assert periodic.repeats([1] * 5) == []
    assert periodic.repeats([1, 2] * 2, least=2, periods=2) == [(0, 4, 2)]


def test_query_equals_search(spark, documents):
    made = spark.createDataFrame(repeating_rows(), "doc_id long, text string").repartition(3)
    for docs in (made, documents.select("doc_id", "text")):
        want = sorted((brute_row(*r) for r in docs.collect()), key=repr)
        assert rows_of(periodic.digests(docs)) == want


def test_long_periodic_text_in_bounded_time(spark):
    words = [f"w{i % 60_000}" for i in range(250_000)]
    out = periodic.digests(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    assert (out.n_runs, out.start, out.length, out.period, out.exponent_milli) == (1, 0, 250_000, 60_000, 4166)


def test_collapsed_keeps_columns(spark, no_documents):
    docs = spark.createDataFrame([(1, "a b a b a b a b c", 7, "x", None)],
                                 "doc_id long, text string, runs int, collapsed string, row string")
    out = periodic.collapsed(docs).first()
    assert out.collapsed == "a b c" and [tuple(r) for r in out.runs] == [(0, 8, 2)]
    assert out.row.runs == 7 and out.row.collapsed == "x"
    assert periodic.digests(no_documents).count() == 0 and periodic.collapsed(no_documents).count() == 0


def test_sieve_is_exact_across_rows(spark):
    """Equal words in neighbouring rows are no run."""
    docs = spark.createDataFrame([(1, "a a a"), (2, "a a a"), (3, "a a a a a a a")], "doc_id long, text string").coalesce(1)
    assert [r.n_runs for r in periodic.digests(docs).orderBy("doc_id").collect()] == [
        len(brute_runs(["a"] * n)) for n in (3, 3, 7)]


def test_schema_of_documents(spark):
    assert periodic.digests(spark.createDataFrame([], SCHEMA)).columns == ["doc_id", *periodic.NAMES]
