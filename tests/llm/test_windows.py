"""Suffix-array and substring dedup against brute force."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.llm import bytescan as b, suffixarray, superkmer, tables, windows


def brute_words(rows, width=20):
    first = {}
    texts = sorted({(i, t or "") for i, t in rows})
    split = {(i, t): t.encode().split() for i, t in texts}
    for key in texts:
        words = split[key]
        for s in range(len(words) - width + 1):
            first.setdefault(tuple(words[s:s + width]), (key, s))
    out = {}
    for key in texts:
        words = split[key]
        gone = np.zeros(len(words), bool)
        for s in range(len(words) - width + 1):
            if first[tuple(words[s:s + width])] != (key, s):
                gone[s:s + width] = True
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[key] = (len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest())
    return out


def brute_bytes(rows, width=200):
    places = defaultdict(set)
    texts = {(i, (t or "").encode()) for i, t in rows}
    for i, t in texts:
        for s in range(len(t) - width + 1):
            places[t[s:s + width]].add((i, t, s))
    out = {}
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - width + 1):
            if len(places[t[s:s + width]]) > 1:
                gone[s:s + width] = True
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out[i, t.decode()] = (len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def word_result(df):
    return {(r.doc_id, r.text or ""): (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


@pytest.fixture(params=[windows.HOT_RECORDS, 3], ids=["cold", "hot"])
def hot(request, monkeypatch):
    """With 3, most repeated seeds count as hot and their windows travel as digests."""
    real = windows.planned
    for module in (suffixarray, superkmer):
        monkeypatch.setattr(module, "planned",
                            lambda *a, **k: real(*a[:7], request.param, **k))
    if request.param == 3:
        monkeypatch.setattr(np, "clip", lambda x, lo, hi, f=np.clip: f(x, lo, hi))
    return request.param


def joined(docs, out):
    return out.join(docs.select("doc_id", "text"), "doc_id")


def test_substring_dedup(documents, hot):
    want = brute_words([(r.doc_id, r.text) for r in documents.collect()])
    assert word_result(joined(documents, superkmer.digests(documents))) == want
    assert sum(v[1] for v in want.values()) > 2000


def test_suffix_array_dedup(documents, hot):
    want = brute_bytes([(r.doc_id, r.text) for r in documents.collect()])
    got = {(r.doc_id, r.text or ""): (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in joined(documents, suffixarray.digests(documents)).collect()}
    assert got == want
    assert sum(v[1] for v in want.values()) > 10000


@pytest.mark.parametrize("shard", [700, 5000, 1 << 20])
def test_shards_merge_by_binary_search(shard):
    rnd = np.random.default_rng(3)
    core = rnd.integers(97, 100, 400, dtype=np.uint8)
    slices = [core[x:x + 300].copy() for x in rnd.integers(0, 100, 30)]
    for s in slices[::3]:
        s[rnd.integers(0, 300)] = 120
    slices = [s for s in {s.tobytes(): s for s in slices}.values()]
    buf = np.concatenate(slices)
    size = np.array([len(s) for s in slices])
    place = np.cumsum(size) - size
    got = suffixarray.repeated_places(buf, place, size, np.full(len(size), 7), 200, shard)
    seen = defaultdict(list)
    for p, n in zip(place, size):
        for s in range(p, p + n - 199):
            seen[buf[s:s + 200].tobytes()].append(s)
    want = np.zeros(len(buf), bool)
    for v in seen.values():
        if len(v) > 1:
            want[v] = True
    assert (got == want).all() and want.any()


def test_suffix_array_and_kasai():
    rnd = np.random.default_rng(1)
    buf = rnd.integers(97, 99, 600, dtype=np.uint8)
    left = 600 - np.arange(600)
    order = suffixarray.suffix_array(buf, left, 37)
    text = buf.tobytes()
    want = sorted(range(600 - 36), key=lambda i: text[i:i + 37])
    assert [text[i:i + 37] for i in order] == [text[i:i + 37] for i in want]
    common = suffixarray.common_prefixes(buf, order, np.array([0]), np.array([600 - 36]), 37)
    for x, y, n in zip(order[1:], order[:-1], common[1:]):
        m = 0
        while m < 37 and text[x + m] == text[y + m]:
            m += 1
        assert m == n


def test_places_that_agree_in_full_carry_nothing_wrong():
    rnd = np.random.default_rng(5)
    unit = rnd.integers(97, 123, 300, dtype=np.uint8).tobytes()
    parts = [unit[:rnd.integers(60, 300)] + bytes(rnd.integers(97, 100, 80, dtype=np.uint8)) + unit[rnd.integers(0, 200):]
             for _ in range(40)]
    buf = np.frombuffer(b"".join(parts), np.uint8)
    size = np.array([len(x) for x in parts])
    place = np.cumsum(size) - size
    got = suffixarray.repeated_places(buf, place, size, np.full(len(size), 7), 50)
    seen = defaultdict(list)
    for p, n in zip(place, size):
        for s in range(p, p + n - 49):
            seen[buf[s:s + 50].tobytes()].append(s)
    want = np.zeros(len(buf), bool)
    for v in seen.values():
        if len(v) > 1:
            want[v] = True
    assert (got == want).all() and want.any() and not want.all()


def test_long_texts_are_cut_into_overlapping_pieces(spark, monkeypatch):
    monkeypatch.setattr(b, "CHUNK_BYTES", 300)
    import pyarrow as pa
    text = b" ".join(b"w%d" % (i % 97) for i in range(2000)) + b" " + b"y" * 2500 + b" z" * 30
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([5]), "th": pa.array([1], pa.int64()),
                                        "text": pa.array([text])})
    for chunks, units in ((windows.byte_chunks, len(text)), (windows.word_chunks, len(text.split()))):
        seen = []
        for chunk in chunks(batch, 20, 3):
            first, last, _ = chunk.runs()
            for x, y in zip(first, last):
                start = chunk.place(np.array([x]))[2][0]
                seen += range(start, start + y - x + 1)
                if chunks is windows.word_chunks:
                    piece = chunk.buf[chunk.at[x]:chunk.at[x + 20]].tobytes().split()
                    assert piece == text.split()[start:start + 20]
                else:
                    assert chunk.buf[x:x + 20].tobytes() == text[start:start + 20]
        assert sorted(seen) == list(range(units - 19))


def test_defined_cases(spark, documents, no_documents):
    for module in (superkmer, suffixarray):
        assert module.digests(no_documents).collect() == []
        base = {r.doc_id: tuple(r)[1:] for r in module.digests(documents).collect()}
        more = documents.withColumns({"spans": F.lit(1), "bucket": F.lit("x"), "_id": F.lit(2), "th": F.lit(0)})
        assert {r.doc_id: tuple(r)[1:] for r in module.digests(more).collect()} == base
        odd = spark.createDataFrame([(None, "w " * 150), (None, "w " * 150), (4, None)], "doc_id long, text string")
        got = sorted((r.doc_id is None, r.n_removed > 0) for r in module.digests(odd).collect())
        assert got == [(False, False), (True, True), (True, True)]


def passage(seed, n=60):
    rnd = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rnd.integers(0, 9999, n))


@pytest.fixture(params=[False, True], ids=["apart", "colliding"])
def weak_first_salt(request, monkeypatch):
    """With it all texts of one id have one name under the first salt."""
    if request.param:
        real = tables.text_key
        weak = lambda salt: F.lit(7).cast("long") if salt == 0 else real(salt)
        for module in (tables, windows, suffixarray, superkmer):
            monkeypatch.setattr(module, "text_key", weak)


def test_shared_ids_make_no_copies(spark, weak_first_salt):
    """Rows are documents, compared with brute force over rows."""
    a, b_, c = passage(1), passage(2), passage(3)
    short = "x" * 199
    cases = [[(None, a), (None, b_), (7, a)], [(1, a), (9, a), (9, b_)], [(None, a), (None, a), (3, c)],
             [(3, a), (3, a), (4, short), (4, short), (5, None), (5, None)], [(9, b_), (9, c), (9, a), (2, a + " " + c)]]
    for rows in cases:
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        places = defaultdict(set)
        for i, (_, t) in enumerate(rows):
            raw = (t or "").encode()
            for s in range(len(raw) - 199):
                places[raw[s:s + 200]].add((i, s))
        want = []
        for i, (d, t) in enumerate(rows):
            raw = (t or "").encode()
            gone = np.zeros(len(raw), bool)
            for s in range(len(raw) - 199):
                if len(places[raw[s:s + 200]]) > 1:
                    gone[s:s + 200] = True
            kept = bytes(x for x, g in zip(raw, gone) if not g)
            want.append((str(d), len(raw), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
        got = [(str(r.doc_id), r.n_bytes, r.n_removed, r.kept_sha256) for r in suffixarray.digests(docs).collect()]
        assert sorted(got) == sorted(want)


def test_substrings_of_shared_ids_stay(spark, weak_first_salt):
    a, b_ = passage(1), passage(2)
    for rows in ([(None, a), (None, b_), (7, a)], [(1, a), (9, a), (9, b_)], [(3, a), (3, a), (9, b_)]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        kept = sorted((str(r.doc_id), r.text) for r in superkmer.deduplicated(docs).collect())
        first = min((d if d is not None else -1) for d, t in rows if t == a)
        want = sorted((str(d), "" if t == a and (d if d is not None else -1) != first else t) for d, t in rows)
        assert kept == want


def test_deduplicated_keeps_columns(documents):
    out = superkmer.deduplicated(documents)
    assert out.columns == documents.columns
    want = word_result(joined(documents, superkmer.digests(documents)))
    kept = {r.doc_id: r for r in out.collect()}
    for (doc_id, _), (_, _, sha) in want.items():
        row = kept[doc_id]
        assert hashlib.sha256(b" ".join((row.text or "").encode().split())).hexdigest() == sha
        assert row.n_chars == (None if row.text is None else len(row.text))
