"""N-gram Jaccard self-join by token-combination prefixes (operator 13).

A document's set is its distinct shingles of ``SHINGLE`` words (A-Z
lower-cased), as 64-bit hashes (tokens); equal sets form one class. Two sets
of similarity t share at least o = ceil(t * n) tokens of either's n, so among
any n - o + 1 tokens of a set at least one is shared.

Most sets fall out by that alone: a first pass counts, for a quarter of all
tokens chosen by hash, those that only one class has; a class with n - o + 1
of them has no partner. What is left is small, and all its tokens are
counted. Tokens are ordered from rare to frequent and dealt to classes by
their count: rare ones are indexed singly, more frequent ones in pairs and
the most frequent in triples, within groups of tokens (by hash) that keep the
combinations few. A prefix is extended until its weight reaches n - o + 1,
where each group of k-token combinations weighs k - 1 less than its tokens: two
similar sets then share a token, or k tokens of one group, in their prefixes,
and so an indexed combination. The number of groups follows from the set's
size; a set whose possible partners lie in the next size class is indexed
for both.

No list of the index is expanded into its pairs. Each member is held against
the list's first on full sets; links are contracted to components; where a
list still holds several, its members are compared in blocks by their
parities, bit maps that prove most pairs unlike, and those that can be similar
across components on full sets. So each pair that meets is linked, refuted or
already connected.

Defined cases: a text without words (or null) has an empty set and is linked
with nothing; fewer words than a shingle are one shingle; a null doc_id is
ordered first and returned as null; rows that share a doc_id are linked by
their sets alone; repeated rows give a row each; very long texts are hashed in
pieces, their sets held whole; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import bytescan as b
from .components import components
from .minhash import class_texts, shingle_sets
from .tables import NULL_ID, id_key, keyed_texts, opaque, sifted, stored, text_digest, tidy

SHINGLE, PERCENT = 4, 85
#: Greatest counts of tokens indexed singly and in pairs; those beyond are indexed in triples.
SINGLE, PAIRS = 32, 2048
#: Tokens of a set for each group of combinations.
GROUP_TOKENS = 16
#: Members of a block, and tokens of its members' sets on average.
BLOCK, BLOCK_TOKENS = 1024, 2_000_000
#: Members of a block where only parities travel.
LIST_BLOCK = 4096
#: Sets that a task remembers to pass over copies.
REMEMBERED = 1_000_000


def needed(n, percent: int):
    """Tokens of a set of ``n`` among which one is shared with any similar set (columns and numbers alike)."""
    return n - (percent * n + 99 - (percent * n + 99) % 100) / 100 + 1 if isinstance(n, Column) else n - -(-percent * n // 100) + 1


def digested(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, th, n (set size), k1 and k2 (digest of the set; null: empty)."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, th, own in shingle_sets(batch, shingle):
                one, two = (int(b.mix(own ^ salt).sum().view(np.int64)) for salt in (np.uint64(0), np.uint64(0x9E37)))
                rows.append((doc_id, th, len(own), one, two) if len(own) else (doc_id, th, 0, None, None))
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "th", "n", "k1", "k2"])

    return keyed_texts(docs, th=text_digest()).mapInArrow(
        tidy(digests), "doc_id long, th long, n long, k1 long, k2 long")


def lonely(docs: DataFrame, shingle: int) -> DataFrame:
    """k1, lone: how many tokens of the chosen quarter a class alone has."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in batches:
            tokens, sizes, keys = [], [], []
            for _, _, own in shingle_sets(batch, shingle):
                key = int(b.mix(own).sum().view(np.int64))
                if key in known:
                    continue
                if len(known) >= REMEMBERED:
                    known.clear()
                known.add(key)
                some = own[(own & np.uint64(3)) == 0]
                tokens.append(some)
                sizes.append(len(some))
                keys.append(key)
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat.view(np.int64)), pa.array(np.repeat(np.array(keys, np.int64), sizes))], ["token", "k1"])

    rows = keyed_texts(docs, th=text_digest()).mapInArrow(tidy(chosen), "token long, k1 long")
    owners = rows.groupBy("token").agg(F.min("k1").alias("k1"), F.max("k1").alias("other"))
    return owners.filter("k1 = other").groupBy("k1").agg(F.count("*").alias("lone"))


def parities(own: np.ndarray) -> bytes:
    """A bit for each bucket of tokens, as many as tokens at least: whether the bucket holds an odd number of them.

    Two sets differ in at least as many tokens as their parities differ in bits.
    """
    size = max(64, 1 << (max(len(own), 1) - 1).bit_length())
    odd = np.bincount((own >> np.uint64(8)).astype(np.int64) & (size - 1), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def packed(texts: DataFrame, shingle: int) -> DataFrame:
    """node, tokens: the sorted set as bytes; bits: its parities."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(node, own.tobytes(), parities(own)) for node, _, own in shingle_sets(batch, shingle)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.binary()))],
                ["node", "tokens", "bits"])

    return texts.select(F.col("node").alias("doc_id"), F.lit(0).cast("long").alias("th"), "text").mapInArrow(
        tidy(sets), "node long, tokens binary, bits binary")


def unpacked(sets: DataFrame) -> DataFrame:
    """node, token: a row for each token."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = b.binary_parts(batch.column("tokens"))
            nodes = np.repeat(batch.column("node").to_numpy(), np.diff(offsets) // 8)
            flat = np.ascontiguousarray(buf[offsets[0]:offsets[-1]]).view(np.int64)
            for i in range(0, len(flat), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[i:i + (1 << 16)]), pa.array(flat[i:i + (1 << 16)])],
                                                 ["node", "token"])

    return sets.mapInArrow(tidy(rows), "node long, token long")


def level(n: int) -> int:
    """The size class of a set: its number of groups is two to this power."""
    return max(0, (n // GROUP_TOKENS).bit_length() - 1)


def levels(n: int, percent: int) -> range:
    """The size classes in which a set can meet a partner: that of the larger of the two."""
    return range(level(n), level(100 * n // percent) + 1)


def prefix(times: np.ndarray, tokens: np.ndarray, need: int, groups: int) -> list[tuple[int, np.ndarray]]:
    """(k, tokens) of each group of the extended prefix; ``times`` and ``tokens`` are sorted from rare to frequent."""
    kind = 1 + (times > SINGLE).astype(np.int64) + (times > PAIRS)
    group = np.where(kind == 1, 0, kind * groups + (tokens >> np.uint64(40)).astype(np.int64) % groups)
    order = np.argsort(group, kind="stable")
    first = np.ones(len(order), bool)
    first[1:] = group[order[1:]] != group[order[:-1]]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    weight = np.cumsum(place >= kind - 1)
    end = int(np.searchsorted(weight, need)) + 1
    assert end <= len(tokens), "the weight of a whole set reaches any need"
    order = order[order < end]
    bounds = np.flatnonzero(np.append(True, group[order[1:]] != group[order[:-1]]))
    return [(int(kind[part[0]]), tokens[part]) for part in np.split(order, bounds[1:])]


def combined(n: int, times: np.ndarray, tokens: np.ndarray, percent: int) -> np.ndarray:
    """The indexed keys of a set of ``n`` tokens, given those that other sets have too."""
    order = np.lexsort((tokens, times))
    times, tokens = times[order], tokens[order]
    need = needed(n, percent) - (n - len(tokens))
    if need <= 0:
        return tokens[:0]
    keys = []
    for at in levels(n, percent):
        for k, part in prefix(times, tokens, need, 1 << at):
            if k == 1:
                keys.append(part)
            elif len(part) >= k:
                hashed = b.mix(np.sort(part) + np.uint64(64 * k + at))
                parts = np.array(list(combinations(hashed, k)), np.uint64)
                keys.append(b.mix((parts * b._ODD ** np.arange(k, dtype=np.uint64)).sum(1, dtype=np.uint64)))
    return np.unique(np.concatenate(keys)) if keys else tokens[:0]


def index(sets: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """node, n, keys: the prefix combinations of each set; sets without a partner are left out."""
    rows = stored(unpacked(sets), "tokens")
    shared = rows.groupBy("token").agg(F.count("*").alias("times")).filter("times > 1").select(
        opaque(F.col("token")).alias("_token"), "times")
    met = rows.join(shared, opaque(rows.token) == shared["_token"]).groupBy("node").agg(
        F.collect_list(F.struct("times", "token")).alias("shared"))  # a set's own tokens

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("shared").flatten()
            times = flat.field("times").to_numpy()
            tokens = flat.field("token").to_numpy().view(np.uint64)
            ends = np.cumsum(batch.column("shared").value_lengths().to_numpy())
            n = batch.column("n").to_numpy()
            keys = [combined(int(n[i]), times[x:y], tokens[x:y], percent).view(np.int64)
                    for i, (x, y) in enumerate(zip(np.append(0, ends[:-1]), ends))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("n"), pa.array(keys, pa.list_(pa.int64()))], ["node", "n", "keys"])

    out = met.join(sizes, "node").select("node", "n", "shared").mapInArrow(
        tidy(keyed), "node long, n long, keys array<long>")
    return out.filter(F.size("keys") > 0)


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    at = np.searchsorted(x, y)
    at[at == len(x)] = 0
    return int((x[at] == y).sum())


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    shared = _overlap(x, y)
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _words(bits: bytes) -> np.ndarray:
    return np.frombuffer(bits, np.uint64)


def _may_be_alike(bits: np.ndarray, other: np.ndarray, total, percent: int):
    """Whether sets of ``total`` tokens together can be similar, by their parities; ``other`` is one or rows of as many
    words as ``bits``, or more."""
    while other.shape[-1] > len(bits):
        half = other.shape[-1] // 2
        other = other[..., :half] ^ other[..., half:]
    differing = np.bitwise_count(bits ^ other).sum(-1, dtype=np.int64)
    return differing * (100 + percent) <= total * (100 - percent)


def likely(pairs: DataFrame, sets: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that can be similar by their parities."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            total = batch.column("total").to_numpy()
            for i, (x, y) in enumerate(zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())):
                x, y = sorted((_words(x), _words(y)), key=len)
                if _may_be_alike(x, y, total[i], percent):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in "ab"], ["a", "b"])

    sized = sets.select("node", "bits").join(sizes, "node")
    one = sized.select(opaque(F.col("node")).alias("_a"), F.col("bits").alias("x"), F.col("n").alias("m"))
    two = sized.select(opaque(F.col("node")).alias("_b"), F.col("bits").alias("y"), "n")
    met = pairs.join(two, opaque(F.col("b")) == F.col("_b")).join(one, opaque(F.col("a")) == F.col("_a"))
    return met.select("a", "b", "x", "y", (F.col("n") + F.col("m")).alias("total")).mapInArrow(tidy(check), "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that are similar on full sets; the sets of their members alone travel."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [i for i, (x, y) in enumerate(zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()))
                    if _alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in "ab"], ["a", "b"])

    one, two = (sifted(sets, [F.col("node")], pairs.select(end)) for end in "ab")
    one = one.select(opaque(F.col("node")).alias("_a"), F.col("tokens").alias("x"))
    two = two.select(opaque(F.col("node")).alias("_b"), F.col("tokens").alias("y"))
    met = pairs.join(two, opaque(F.col("b")) == F.col("_b")).join(one, opaque(F.col("a")) == F.col("_a"))
    return met.select("a", "b", "x", "y").mapInArrow(tidy(check), "a long, b long")


def _near(table: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each member i of a table sorted by n: later members, of the other side and another root, that can be similar."""
    lo, hi = (table.column(c)[0].as_py() for c in ("lo", "hi"))
    n, root, mine = (table.column(c).to_numpy() for c in ("n", "root", "mine"))
    bits = [_words(x) for x in table.column("bits").to_pylist()]
    width = np.array([len(x) for x in bits])  # grows with n, twofold at most among sets of like size
    upto = np.searchsorted(n, 100 * n // percent, "right")
    rows = {w: np.stack([bits[i] for i in np.flatnonzero(width == w)]) for w in set(width.tolist())}
    first = {w: int(np.argmax(width == w)) for w in rows}
    for i in range(len(n)):
        for w in (int(width[i]), 2 * int(width[i])):
            if w not in rows:
                continue
            x, y = max(i + 1, first[w]), min(int(upto[i]), first[w] + len(rows[w]))
            if x >= y:
                continue
            other = (root[x:y] != root[i]) & (mine[x:y] == (hi if mine[i] == lo else lo))
            j = np.flatnonzero(other)
            j = j[_may_be_alike(bits[i], rows[w][x - first[w] + j], n[x + j] + n[i], percent)]
            if len(j):
                yield i, x + j


def _by_size(table: pa.Table) -> pa.Table:
    return table.sort_by([("n", "ascending"), ("node", "ascending")])


def _spanning(table: pa.Table, found: Iterator[tuple[int, int]], start: np.ndarray) -> pa.Table:
    """Of the pairs found those that join what ``start`` and the pairs before leave apart."""
    node, label = table.column("node").to_numpy(), start.copy()
    a, c = [], []
    for i, j in found:
        if label[i] != label[j]:
            a.append(node[i])
            c.append(node[j])
            label[label == label[j]] = label[i]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(c, pa.int64())})


def _promising(table: pa.Table, percent: int) -> pa.Table:
    """Pairs that connect the members of two blocks (or of one) that can be similar, of different components."""
    table = _by_size(table)
    pairs = ((i, j) for i, near in _near(table, percent) for j in near.tolist())
    return _spanning(table, pairs, np.arange(table.num_rows))


def _compared(table: pa.Table, percent: int) -> pa.Table:
    """Links that connect members of two blocks (or of one) across components."""
    table = _by_size(table)
    sets = [np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()]
    roots = table.column("root").to_numpy()
    pairs = ((i, j) for i, near in _near(table, percent) for j in near.tolist() if _alike(sets[i], sets[j], percent))
    return _spanning(table, pairs, roots)


def in_blocks(rest: DataFrame, members: int, tokens: int) -> DataFrame:
    """The rows of lists (key, node, n, root) that hold several components, dealt to pairs of blocks."""
    mixed = rest.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("m"),
                                    F.sum("n").alias("size")).filter("least != most")
    blocks = F.ceil(F.greatest(F.col("m") / members, F.col("size") / tokens)).cast("int")
    mixed = mixed.select(opaque(F.col("key")).alias("_key"), blocks.alias("blocks"))
    rest = rest.join(mixed, opaque(F.col("key")) == F.col("_key")).drop("_key")
    rest = rest.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rest.select("key", "node", "n", "root", "mine", F.least("mine", "other").alias("lo"),
                       F.greatest("mine", "other").alias("hi"))


def across(posted: DataFrame, firsts: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of one list that the list's first has left in different components.

    Parities, an eighth of a byte a token, tell which members can be similar;
    what they connect is a cluster, and a member is in one. Sets travel for
    the members of clusters alone, once for each pair of a cluster's blocks.
    """
    labelled = posted.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rest = labelled.join(firsts, opaque(F.col("key")) == F.col("_key")).filter("m > 2 and node != first.node")
    rest = stored(rest.select("key", "node", "n", "root"), "rest")
    dealt = in_blocks(rest, LIST_BLOCK, LIST_BLOCK * BLOCK_TOKENS // BLOCK).join(sets.select("node", "bits"), "node")
    edges = dealt.groupBy("key", "lo", "hi").applyInArrow(lambda table: _promising(table, percent), "a long, b long")
    clusters = components(stored(edges.distinct(), "promising")).withColumnRenamed("root", "key")
    members = stored(clusters.join(rest.select("node", "n", "root").distinct(), "node").select("key", "node", "n", "root"), "clusters")
    own = sifted(sets, [F.col("node")], members.select("node"))
    left = in_blocks(members, BLOCK, BLOCK_TOKENS).join(own, "node")
    return left.groupBy("key", "lo", "hi").applyInArrow(lambda table: _compared(table, percent), "a long, b long")


def grouped(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, th, n, component (its smallest doc_id) for each row of ``docs``; a null id is ``NULL_ID``."""
    if not 60 <= percent <= 100:
        raise ValueError("percent must be from 60 to 100")
    signed = stored(digested(docs, shingle), "sets")
    classes = signed.filter("k1 is not null").groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "th")).alias("first"),
                                                                      F.min("n").alias("n"))
    classes = stored(classes.select("k1", "k2", "first.*", "n", F.monotonically_increasing_id().alias("node")), "classes")
    alone = lonely(docs, shingle).select(opaque(F.col("k1")).alias("_k1"), "lone")
    # A set of n can't be similar to another unless one of n + 1 can hold it.
    able = classes.filter(100 * F.col("n") >= percent * (F.col("n") + 1))
    left = able.join(alone, opaque(able.k1) == alone["_k1"], "left").filter(
        F.coalesce("lone", F.lit(0)) < needed(F.col("n"), percent)).select("node", "doc_id", "th", "n")
    left = stored(left, "left")
    several = not signed.groupBy("doc_id", "th").count().filter("count > 1").isEmpty()
    own = sifted(docs, [id_key(), text_digest()], left.select("doc_id", "th"))
    sets = stored(packed(class_texts(own, left, several), shingle), "tokensets")
    keys = stored(index(sets, left.select("node", "n"), percent), "keys")
    posted = keys.select(F.explode("keys").alias("key"), "node", "n")
    firsts = posted.groupBy("key").agg(F.min(F.struct("node", "n")).alias("first"), F.count("*").alias("m")).filter("m > 1")
    firsts = stored(firsts, "firsts").select(opaque(F.col("key")).alias("_key"), "first", "m")
    close = 100 * F.least("n", "first.n") >= percent * F.greatest("n", "first.n")
    stars = posted.join(firsts, opaque(F.col("key")) == F.col("_key")).filter((F.col("node") != F.col("first.node")) & close)
    stars = stored(stars.select(F.col("first.node").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    stars = stored(likely(stars, sets, left.select("node", "n"), percent), "likely")
    links = stored(confirmed(stars, sets, percent), "links")
    roots = components(links)
    more = stored(across(posted, firsts, roots, sets, percent), "more")
    if not more.isEmpty():
        roots = components(links.unionAll(more))
    named = roots.select(F.col("node").alias("_node"), "root")
    rooted = classes.join(named, classes.node == named["_node"], "left").select(
        "k1", "k2", "doc_id", F.coalesce("root", "node").alias("root"))
    heads = rooted.groupBy("root").agg(F.min("doc_id").alias("component"))
    heads = heads.select(opaque(F.col("root")).alias("_root"), "component")
    ids = rooted.join(heads, opaque(rooted.root) == heads["_root"]).select(
        opaque(F.col("k1")).alias("_k1"), opaque(F.col("k2")).alias("_k2"), "component")
    met = signed.join(ids, (opaque(signed.k1) == ids["_k1"]) & (opaque(signed.k2) == ids["_k2"]), "left")
    return met.select("doc_id", "th", "n", F.coalesce("component", "doc_id").alias("component"))


def joined(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs``."""
    def restored(c):
        return F.when(F.col(c) != NULL_ID, F.col(c))
    return grouped(docs, percent).select(restored("doc_id").alias("doc_id"), F.col("n").alias("n_shingles"),
                                         restored("component").alias("component_id"))
