"""Conversation prefix trie by depth-band rollup (operator 12).

A node is a distinct sequence of first turns (role, text); its members are
the conversations that start with it. Only digests of turns travel, never
their texts. A conversation's turns are ranked and their digests summed in
range-partitioned, sorted passes that also cut a very long conversation into
blocks; a sequence's key is its depth and two 64-bit sums of turn digests
times powers of an odd base, which can be scaled and shifted without a
second pass. A node is named by its smallest member and its depth, so a
conversation's own nodes are the tail of its path.

Totals over subtrees go up by bands of ``BAND`` levels: nodes explode only to
their ancestors within a band (the nodes of one conversation in a band lie on
one path, so this is a running sum over at most ``BAND`` rows), which gives the
band roots their totals; band roots form a trie of a ``BAND``-th of the depth,
rolled up in the same way; the completed totals of band roots then explode
over the band above them alone. Rounds are the logarithm of the depth to the
base ``BAND``, and a row is copied to ``BAND`` ancestors at most.

Defined cases: a null role or text is empty; turns of one conversation with
equal turn numbers are ordered by their digest; repeated rows are turns of
their own; a null conv_id is one conversation, ordered before all others, not
rebuilt, returned as null and spelled ``null`` in lists; other columns are ignored;
an empty table has no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import NULL_ID, opaque, stored, tidy

#: Levels of a band.
BAND = 16
#: Turns taken over from another conversation in ``rebuilt``, at most.
MOST_SHARED = 5
#: Odd bases of the two sums.
_BASES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


def power(base: int, exponent: np.ndarray) -> np.ndarray:
    """``base ** exponent`` modulo 2**64, exponents of either sign (the base is odd)."""
    out = np.ones(len(exponent), np.uint64)
    for sign in (1, -1):
        left = np.maximum(exponent * sign, 0)
        square = base if sign > 0 else pow(base, -1, 2 ** 64)
        while len(left) and left.any():
            odd = (left & 1).astype(bool)
            out[odd] *= np.uint64(square)
            left >>= 1
            square = square * square % 2 ** 64
    return out


def turns_of(conversations: DataFrame) -> DataFrame:
    """c, turn, x, y (digests of role and text), chars of each turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    return conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NULL_ID)).alias("c"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("x"), F.xxhash64(F.lit(1), text, role).alias("y"),
        F.char_length(text).cast("long").alias("chars"))


def _u64(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def _i64(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn: rank and running sums within this task's part of a conversation."""
    from pyspark import TaskContext
    block = TaskContext.get().partitionId()
    conv, rank, sums = None, 0, [np.uint64(0), np.uint64(0)]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        c = batch.column("c").to_numpy()
        new = np.ones(n, bool)
        new[1:] = c[1:] != c[:-1]
        new[0] = conv is None or c[0] != conv
        first = np.where(new, np.arange(n), 0)
        np.maximum.accumulate(first, out=first)
        on = ~new[first]  # still the conversation of the batch before
        r = np.arange(n) - first + 1 + np.where(on, rank, 0)
        out = []
        for k, name in enumerate("xy"):
            run = np.cumsum(_u64(batch.column(name)) * power(_BASES[k], r), dtype=np.uint64)
            before = np.concatenate((np.zeros(1, np.uint64), run))[first]
            out.append(run - before + np.where(on, sums[k], np.uint64(0)))
            sums[k] = out[k][-1]
        conv, rank = c[-1], int(r[-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, block)), batch.column("c"), pa.array(r), _i64(out[0]), _i64(out[1]), batch.column("chars")],
            ["block", "c", "r", "x", "y", "chars"])


def ranked(turns: DataFrame) -> DataFrame:
    """block, c, r, x, y, chars: rank and sums of each turn within its block of its conversation."""
    order = ["c", F.asc_nulls_first("turn"), "x", "y"]
    return turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        tidy(_ranked), "block long, c long, r long, x long, y long, chars long")


def _offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What stands before each block of a conversation that has several."""
    for batch in batches:
        rows = []
        for c, blocks in zip(batch.column("c").to_pylist(), batch.column("blocks").to_pylist()):
            n, x, y = 0, 0, 0
            for at in blocks:
                rows.append((c, at["block"], n, *(v - 2 ** 64 if v >= 2 ** 63 else v for v in (x, y))))
                x, y = ((v + at["last"][name] * pow(base, n, 2 ** 64)) % 2 ** 64
                        for v, name, base in ((x, "x", _BASES[0]), (y, "y", _BASES[1])))
                n += at["last"]["r"]
        columns = list(zip(*rows)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in columns], ["c", "block", "n", "bx", "by"])


def offsets(ranks: DataFrame) -> DataFrame:
    """c, block, n, bx, by for the blocks of conversations that lie in several tasks' parts."""
    blocks = ranks.groupBy("c", "block").agg(F.max(F.struct("r", "x", "y")).alias("last"))
    # A list holds one row a block: as many as there are range partitions, at most.
    several = blocks.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("block", "last"))).alias("blocks")).filter(
        F.size("blocks") > 1)
    return several.mapInArrow(tidy(_offsets), "c long, block long, n long, bx long, by long")


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranks and sums within the whole conversation."""
    for batch in batches:
        n = batch.column("n").to_numpy()
        sums = [_u64(batch.column(f"b{k}")) + _u64(batch.column(k)) * power(base, n) for k, base in zip("xy", _BASES)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("c"), pa.array(batch.column("r").to_numpy() + n), *map(_i64, sums), batch.column("chars")],
            ["c", "r", "x", "y", "chars"])


def placed(ranks: DataFrame, before: DataFrame) -> DataFrame:
    """c, r, x, y, chars: rank of each turn in its conversation and the sums up to it."""
    at = before.select(F.col("c").alias("_c"), F.col("block").alias("_block"), "n", "bx", "by")
    met = ranks.join(at, (ranks.c == at["_c"]) & (ranks.block == at["_block"]), "left").na.fill(0, ["n", "bx", "by"])
    return met.select("c", "r", "x", "y", "chars", "n", "bx", "by").mapInArrow(
        tidy(_placed), "c long, r long, x long, y long, chars long")


def paths(places: DataFrame) -> DataFrame:
    """c, d, x, y, chars, ends for each node that a conversation passes, the root included."""
    places = places.select("c", F.col("r").alias("d"), "x", "y", "chars")
    sizes = places.groupBy("c").agg(F.max("d").alias("m"))
    own = _sized(places, sizes.select("c", "m"))
    return own.unionAll(sizes.select("c", F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long"),
                                     F.lit(0).cast("long"), F.lit(False)))


def _sized(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    m = sizes.select(opaque(F.col("c")).alias("_c"), "m")
    return rows.join(m, opaque(rows.c) == m["_c"]).select("c", "d", "x", "y", "chars", (F.col("d") == F.col("m")).alias("ends"))


def _shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's own turns behind the turns taken over: sums scaled by the shift of their places."""
    for batch in batches:
        by = batch.column("shift").to_numpy()
        sums = [_u64(batch.column(f"q{k}")) + (_u64(batch.column(k)) - _u64(batch.column(f"s{k}"))) * power(base, by)
                for k, base in zip("xy", _BASES)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("c"), pa.array(batch.column("r").to_numpy() + by), *map(_i64, sums), batch.column("chars"),
             batch.column("ends")], ["c", "d", "x", "y", "chars", "ends"])


def shared_turns(c: Column) -> Column:
    """How many first turns of conversation ``c`` come from conversation c - c % 100."""
    return F.when(c == NULL_ID, 0).otherwise(F.crc32(c.cast("string")) % (MOST_SHARED + 1)).cast("int")


def rebuilt_paths(ranks: DataFrame, before: DataFrame) -> DataFrame:
    """As ``paths``, of conversations whose first turns come from the first of their hundred."""
    places = placed(ranks, before)
    # Ranks in a block are at most those in the conversation, so the first filter loses no head.
    first = placed(ranks.filter(F.col("r") <= MOST_SHARED), before).filter(F.col("r") <= MOST_SHARED)
    heads = first.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("r", "x", "y", "chars"))).alias("head"))
    sizes = ranks.groupBy("c", "block").agg(F.max("r").alias("r")).groupBy("c").agg(F.sum("r").alias("n"))
    heads = stored(heads.join(sizes, "c").withColumn("h", shared_turns(F.col("c"))), "heads")
    base = heads.select(F.col("c").alias("base"), F.col("head").alias("taken"), F.col("n").alias("n_base"))
    info = heads.withColumn("base", F.when(F.col("c") == NULL_ID, F.col("c")).otherwise(F.col("c") - F.col("c") % 100))
    info = info.join(base, "base", "left").withColumn("t", F.least("h", F.coalesce("n_base", F.lit(0))).cast("int"))
    info = info.withColumn("taken", F.slice(F.coalesce("taken", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("t")))

    def at(head: str, k: Column, name: str) -> Column:
        return F.when(k > 0, F.get(F.col(head), k - 1)[name]).otherwise(0).cast("long")

    info = info.select("c", "h", "t", "taken", (F.col("t") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("m"),
                       *[at("head", F.least("h", "n").cast("int"), k).alias(f"s{k}") for k in "xy"],
                       *[at("taken", F.col("t"), k).alias(f"q{k}") for k in "xy"])
    info = stored(info, "rebuilt")
    key = info.select(opaque(F.col("c")).alias("_c"), "h", "t", "m", "sx", "sy", "qx", "qy")
    own = places.join(key, (opaque(places.c) == key["_c"]) & (places.r > F.col("h"))).select(
        "c", "r", "x", "y", "chars", "sx", "sy", "qx", "qy", (F.col("t") - F.col("h")).cast("long").alias("shift"),
        (F.col("r") - F.col("h") + F.col("t") == F.col("m")).alias("ends"))
    own = own.mapInArrow(tidy(_shifted), "c long, d long, x long, y long, chars long, ends boolean")
    none = F.lit(0).cast("long")
    root = F.array(F.struct(none.alias("r"), none.alias("x"), none.alias("y"), none.alias("chars")))
    taken = info.select("c", "m", F.explode(F.concat(root, "taken")).alias("e")).select(
        "c", F.col("e.r").alias("d"), "e.x", "e.y", "e.chars", (F.col("e.r") == F.col("m")).alias("ends"))
    return own.unionAll(taken)


def totals(steps: DataFrame, values: list[str], band: int = BAND) -> DataFrame:
    """rep, d and the sums of ``values`` over the subtree of each node.

    ``steps`` (c, d, rep, values) has a row for each node on each
    conversation's path that the rollup can need; a row whose ``rep`` is its
    ``c`` is that node's own and brings its values.
    """
    own = [F.when(F.col("rep") == F.col("c"), F.col(v)).alias(v) for v in values]
    steps = stored(steps.select("c", "d", "rep", F.floor(F.col("d") / band).cast("long").alias("b"), *own), "steps")
    group = Window.partitionBy("c", "b").orderBy(F.desc("d"))  # a band of one path: ``band`` rows at most
    if steps.agg(F.max("b")).first()[0] in (None, 0):
        extra = steps
    else:
        parts = steps.groupBy("c", "b").agg(F.min_by("rep", "d").alias("rep"), *[F.sum(v).alias(v) for v in values])
        tops = parts.filter(F.col(values[0]).isNotNull()).groupBy("rep", "b").agg(*[F.sum(v).alias(v) for v in values])
        tops = tops.select(F.col("rep").alias("_rep"), F.col("b").alias("_b"), *values)
        roots = steps.filter(F.col("d") % band == 0).select("c", F.col("b").alias("d"), "rep")
        roots = roots.join(tops, (roots.c == tops["_rep"]) & (roots.d == tops["_b"]) & (roots.rep == roots.c), "left")
        done = totals(roots.select("c", "d", "rep", *values), values, band).filter("d > 0")
        done = done.select(F.col("rep").alias("_c"), (F.col("d") - 1).alias("_b"), *[F.col(v).alias(f"_{v}") for v in values])
        # The completed total of a band root goes to its ancestors in the band above.
        extra = steps.join(done, (steps.c == done["_c"]) & (steps.b == done["_b"]), "left")
        extra = extra.select("c", "d", "rep", "b", *[
            F.when(F.row_number().over(group) == 1, F.coalesce(F.col(v) + F.col(f"_{v}"), v, f"_{v}")).otherwise(F.col(v)).alias(v)
            for v in values])
    summed = extra.select("d", "rep", *[F.sum(v).over(group).alias(v) for v in values])
    out = summed.filter(F.col(values[0]).isNotNull()).groupBy("rep", "d").agg(*[F.sum(v).alias(v) for v in values])
    return stored(out, "totals")


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and conversation: the ids of each node in this task's range, comma-joined, in pieces."""
    for batch in batches:
        rep, d, c = (batch.column(k).to_numpy() for k in ("rep", "d", "c"))
        if not len(c):
            continue
        new = np.ones(len(c), bool)
        new[1:] = (rep[1:] != rep[:-1]) | (d[1:] != d[:-1])
        starts = np.flatnonzero(new)
        ids = ["null" if v == NULL_ID else str(v) for v in c.tolist()]
        ends = np.append(starts[1:], len(c))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rep[starts]), pa.array(d[starts]), pa.array(c[starts]),
             pa.array([",".join(ids[i:j]) for i, j in zip(starts, ends)])], ["rep", "d", "c", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by node and first id: one digest a node, piece after piece."""
    last, digest = None, None
    for batch in batches:
        rows = []
        for rep, d, ids in zip(*(batch.column(k).to_pylist() for k in ("rep", "d", "ids"))):
            if (rep, d) != last:
                if last is not None:
                    rows.append((*last, digest.hexdigest()))
                last, digest = (rep, d), hashlib.sha256()
                digest.update(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield _digest_rows(rows)
    if last is not None:
        yield _digest_rows([(*last, digest.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 3
    return pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], ["rep", "d", "sha"])


def ends_digests(ends: DataFrame) -> DataFrame:
    """rep, d, sha: SHA-256 of the ascending ids (c) of the conversations that end at a node.

    Ids are sorted by range, so a node where very many end is no hot task of
    the sort; its digest, which has no parallel form, reads joined pieces.
    """
    pieces = ends.repartitionByRange("rep", "d", "c").sortWithinPartitions("rep", "d", "c").mapInArrow(
        tidy(_lists), "rep long, d long, c long, ids string")
    return pieces.repartition("rep", "d").sortWithinPartitions("rep", "d", "c").mapInArrow(
        tidy(_hashed), "rep long, d long, sha string")


def nodes(passed: DataFrame) -> DataFrame:
    """The trie of ``passed`` (see ``paths``): one row a node."""
    passed = stored(passed, "passed")
    keyed = passed.groupBy("d", "x", "y").agg(F.min("c").alias("rep"), F.count("*").alias("n"), F.max("chars").alias("chars"))
    keyed = stored(keyed, "nodes").select(opaque(F.col("d")).alias("_d"), opaque(F.col("x")).alias("_x"),
                                          opaque(F.col("y")).alias("_y"), "rep", "n", F.col("chars").alias("node_chars"))
    same = ((opaque(passed.d) == keyed["_d"]) & (opaque(passed.x) == keyed["_x"]) & (opaque(passed.y) == keyed["_y"]))
    steps = stored(passed.join(keyed, same).select("c", "d", "rep", "n", F.col("node_chars").alias("chars"), "ends"), "named")
    # A conversation's own nodes are the tail of its path; the last row before is their parent.
    above = steps.filter("rep != c").groupBy("c").agg(F.max(F.struct("d", "rep", "ends")).alias("up"))
    above = stored(above.filter("not up.ends").select("c", "up.d", "up.rep"), "above")
    joined = above.groupBy("rep", "d").agg(F.count("*").alias("others"))
    joined = joined.select(F.col("rep").alias("_rep"), F.col("d").alias("_d"), "others")
    up = above.select(F.col("c").alias("_c"), F.col("d").alias("up_d"), F.col("rep").alias("up_rep"))
    own = steps.filter("rep = c").join(joined, (F.col("c") == F.col("_rep")) & (F.col("d") == F.col("_d")), "left")
    own = own.join(up, F.col("c") == F.col("_c"), "left")
    children = F.coalesce("others", F.lit(0)) + F.when(F.col("ends"), 0).otherwise(1)
    parent = F.when(F.col("d") == 0, None).when(F.col("up_d") + 1 == F.col("d"), F.col("up_rep")).otherwise(F.col("c"))
    own = stored(own.select("c", "d", "n", "chars", children.alias("children"), parent.alias("parent")), "own")
    saves = own.select(F.col("c").alias("_c"), F.col("d").alias("_d"),
                       F.when(F.col("children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
                       ((F.col("n") - 1) * F.col("chars")).alias("saved"))
    valued = steps.select("c", "d", "rep").join(
        saves, (opaque(steps.c) == opaque(saves["_c"])) & (steps.d == saves["_d"]) & (steps.rep == steps.c), "left")
    sums = totals(valued.select("c", "d", "rep", "leaves", "saved"), ["leaves", "saved"])
    sums = sums.select(F.col("rep").alias("_c"), F.col("d").alias("_d"), "leaves", "saved")
    ended = ends_digests(steps.filter("ends").select("rep", "d", "c"))
    ended = ended.select(F.col("rep").alias("_e"), F.col("d").alias("_ed"), "sha")
    out = own.join(sums, (own.c == sums["_c"]) & (own.d == sums["_d"])).join(
        ended, (own.c == ended["_e"]) & (own.d == ended["_ed"]), "left")

    def restored(c):
        return F.when(F.col(c) != NULL_ID, F.col(c))

    return out.select(restored("c").alias("conv_id"), F.col("d").alias("depth"), restored("parent").alias("parent_conv_id"),
                      F.col("n").alias("n_convs"), F.col("children").cast("long").alias("n_children"),
                      F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                      F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of conversations as they are."""
    ranks = stored(ranked(stored(turns_of(conversations), "turns")), "ranks")
    return nodes(paths(placed(ranks, stored(offsets(ranks), "offsets"))))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of conversations rebuilt by ``rebuilt_paths``."""
    ranks = stored(ranked(stored(turns_of(conversations), "turns")), "ranks")
    return nodes(rebuilt_paths(ranks, stored(offsets(ranks), "offsets")))
