"""The conversation trie against one built in plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from encore.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, rebuild):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild and c is not None else 0
        made[c] = (turns.get(c - c % 100, [])[:h] if h else []) + own[h:]
    members = defaultdict(list)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)

    def least(convs):
        return min(convs, key=lambda c: (c is not None, c or 0))

    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k, convs in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(convs) - 1) * len(k[-1][1]) if k else 0
    out = []
    for k, convs in members.items():
        ends = sorted((c for c in convs if len(made[c]) == len(k)), key=lambda c: (c is not None, c or 0))
        listed = ",".join("null" if c is None else str(c) for c in ends)
        out.append((least(convs), len(k), least(members[k[:-1]]) if k else None, len(convs), children[k], leaves[k],
                    saved[k], hashlib.sha256(listed.encode()).hexdigest()))
    return sorted(out, key=repr)


def talks(seed=12):
    rnd = random.Random(seed)
    said = [None, "", "hi", "ho", "Ünï 漢", "long " * 400]
    rows, copied = [], [(r, rnd.choice(said)) for r in ("user", None, "assistant") * 3]
    for c in [*range(0, 60), *range(130, 150), *range(200, 215), 990, 1000, None]:
        kind = rnd.random()
        if kind < 0.3:
            seq = copied[:rnd.randint(1, 9)]
        else:
            seq = [(rnd.choice(["user", "assistant", None]), rnd.choice(said[:4])) for _ in range(rnd.randint(1, 8))]
        turns = [None, *range(3, 3 + len(seq))][:len(seq)]
        rows += [(c, t, *s) for t, s in zip(turns, seq)]
    for c in (70, 71, 72):  # beyond two bands of bands
        rows += [(c, t, "user", f"t{t if t < 350 else t * c}") for t in range(360)]
    rows += [(73, 5, "user", "same")] * 40  # repeated rows are turns of their own
    rnd.shuffle(rows)
    return rows


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("parts", [1, 7])
def test_trie_equals_brute_force(spark, monkeypatch, parts):
    rows = talks()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(parts == 1).lower())
    try:
        conversations = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        assert rows_of(trie.rebuilt_trie(conversations)) == brute(rows, True)
        monkeypatch.setattr(trie, "BAND", 4)
        assert rows_of(trie.trie(conversations)) == brute(rows, False)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_one_conversation_over_many_blocks(spark):
    rows = [(8, t, "user", f"t{t % 7}") for t in range(3000)] + [(9, t, "user", f"t{t % 7}") for t in range(2000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        conversations = spark.createDataFrame(rows, SCHEMA)
        ranks = trie.ranked(trie.turns_of(conversations))
        assert ranks.select("block").distinct().count() > 3
        got = {(r.conv_id, r.depth): r for r in trie.trie(conversations).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(got) == 3001 and got[8, 0].n_leaves == 1 and got[8, 0].saved_tokens == 2000 * 2
    assert got[8, 2000].ends_sha256 == hashlib.sha256(b"9").hexdigest() and got[8, 2000].n_children == 1


def test_ties_have_one_order(spark):
    rows = [(1, 4, "user", x) for x in "abcd"] + [(2, 4, "user", x) for x in "dcba"]
    for parts in (1, 4):
        out = trie.trie(spark.createDataFrame(rows, SCHEMA).repartition(parts))
        assert sorted((r.conv_id, r.depth, r.n_convs) for r in out.collect()) == [(1, d, 2) for d in range(5)]


def test_empty_and_extra_columns(spark):
    assert trie.rebuilt_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    wide = spark.createDataFrame([(1, 0, "u", "x", 5, "z")], SCHEMA + ", c long, rep string")
    assert rows_of(trie.trie(wide)) == brute([(1, 0, "u", "x")], False)
