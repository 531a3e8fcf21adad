"""MinHash near-dedup by a signature-coordinate inverted join (operator 3).

A document's set is its distinct shingles of ``SHINGLE`` words (A-Z
lower-cased); equal sets form one class. Each class posts its signature's
``COORDINATES`` minima under (coordinate, value). Two classes with at least
``SIMILARITY`` of their union in common agree in ``least_matches`` of the
coordinates but for ``MISS`` of such pairs, so it is enough that they meet
under one of a class's rarest postings (prefix filter: coordinates - matches
+ 1 of them, by global count), and a count of collisions that skips the long
lists - it compares the two signatures - retains the pairs above the match
threshold. These are confirmed on full sets, exactly.

No list is expanded into all its pairs. First each member of a list is held
against the list's smallest class; confirmed links are contracted to
components. Only where a list still holds several components, its members
are compared in blocks, across components alone, each pair in one list; a
block retains pairs by their signatures, confirms them on full sets and
returns links that connect its members, no more. So each pair that meets
under a prefix is either confirmed, refuted or already connected.

A document is a doc_id and a text: rows that agree in both are one, stated
several times; rows that share a null or repeated doc_id but not the text are
documents of their own and linked by their sets alone. Of a component the
document with the smallest doc_id is kept (of several, the smallest digest).

Defined cases: a text without words (or null) has an empty set and is linked
with nothing; fewer words than a shingle are one shingle; a null doc_id is
ordered first and returned as null; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import bytescan as b
from .components import components
from .tables import NULL_ID, keyed_texts, opaque, stored, text_digest, tidy
from .windows import word_chunks

SHINGLE, PERCENT = 5, 85
COORDINATES, MISS = 40, 1e-7
#: Members of a block, and shingles of its members' sets on average.
BLOCK, BLOCK_SHINGLES = 1024, 1_000_000
_FACTORS = b.mix(np.arange(1000, 1000 + COORDINATES, dtype=np.uint64)) | np.uint64(1)


def least_matches(coordinates: int, percent: int, miss: float = MISS) -> int:
    """The most agreeing coordinates that all but ``miss`` of the pairs at the threshold reach."""
    p, total = percent / 100, 0.0
    for k in range(coordinates + 1):
        total += comb(coordinates, k) * p ** k * (1 - p) ** (coordinates - k)
        if total > miss:
            return max(1, k)
    return coordinates


def shingle_sets(batch: pa.RecordBatch, shingle: int = SHINGLE) -> Iterator[tuple[int, int, np.ndarray]]:
    """(doc_id, th, sorted distinct 64-bit shingle hashes) of each row, in order."""
    open_: list = []  # the pieces of one long text

    def closed():
        if open_:
            yield open_[0][0], open_[0][1], np.unique(np.concatenate([o[2] for o in open_]))
            open_.clear()

    for chunk in word_chunks(batch, shingle, 1, lower=True):
        every = chunk.spans.every(shingle)
        if len(chunk.doc_id) != 1 or not chunk.base[0]:
            yield from closed()
        for row in range(len(chunk.doc_id)):
            x, y = int(chunk.begin[row]), int(chunk.end[row])
            if y - x >= shingle:
                own = every[x:y - shingle + 1]
            else:
                own = chunk.spans(np.array([x]), np.array([y])) if y > x else every[:0]
            found = (int(chunk.doc_id[row]), int(chunk.th[row]), own)
            if len(chunk.doc_id) == 1:
                open_.append(found)
            else:
                yield found[0], found[1], np.unique(own)
    yield from closed()


def signature(own: np.ndarray) -> np.ndarray:
    """Upper 32 bits of the minimum under each of the coordinates' hashes."""
    best = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), 4096):
        best = np.minimum(best, (own[at:at + 4096, None] * _FACTORS).min(0))
    return (best >> np.uint64(32)).astype(np.uint32).view(np.int32)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, th, n (set size), k1 and k2 (digest of the set; null: empty), sig."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, sizes, one, two, sigs = [], [], [], [], [], []
            for doc_id, th, own in shingle_sets(batch):
                ids.append(doc_id)
                hashes.append(th)
                sizes.append(len(own))
                filled = len(own) > 0
                one.append(int(b.mix(own).sum().view(np.int64)) if filled else None)
                two.append(int(b.mix(own ^ _FACTORS[0]).sum().view(np.int64)) if filled else None)
                sigs.append(signature(own) if filled else None)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in (ids, hashes, sizes, one, two)),
                 pa.array(sigs, pa.list_(pa.int32()))], ["doc_id", "th", "n", "k1", "k2", "sig"])

    return keyed_texts(docs, th=text_digest()).mapInArrow(
        tidy(signed), "doc_id long, th long, n long, k1 long, k2 long, sig array<int>")


def similar_size(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def postings(classes: DataFrame, matches: int) -> DataFrame:
    """(token, node): each class under its rarest shared postings, as many as the prefix filter asks for."""
    tokens = classes.select("node", F.posexplode("sig").alias("at", "value")).select(
        "node", (F.shiftleft(F.col("at").cast("long"), 32) + F.col("value") + F.lit(2 ** 31)).alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("times")).filter("times > 1").select(
        opaque(F.col("token")).alias("_token"), "times")
    mine = tokens.join(shared, opaque(F.col("token")) == F.col("_token")).groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("times", "token"))).alias("tokens"))
    # Postings that no other class shares are the rarest; they fill the prefix first.
    length = F.lit(COORDINATES - matches + 1) - (F.lit(COORDINATES) - F.size("tokens"))
    return mine.filter(length > 0).select("node", F.explode(F.slice("tokens", F.lit(1), length)).alias("t")).select(
        F.col("t.token").alias("token"), "node")


def agreeing(x: Column, y: Column) -> Column:
    """Coordinates in which two signatures agree."""
    return F.size(F.filter(F.zip_with(x, y, lambda p, q: p == q), lambda same: same))


def with_signatures(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    for end in ("a", "b"):
        side = classes.select(F.col("node").alias("_node"), F.col("n").alias(f"n_{end}"), F.col("sig").alias(f"sig_{end}"))
        pairs = pairs.join(side, F.col(end) == F.col("_node")).drop("_node")
    return pairs


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough; ``a`` may be in very many pairs."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list = [None, None]
        for batch in batches:
            a, b_ = (batch.column(c).to_numpy() for c in ("a", "b"))
            keep = []
            others = pa.RecordBatch.from_arrays([batch.column("b"), batch.column("b"), batch.column("text")],
                                                ["doc_id", "th", "text"])
            for i, (_, _, own) in enumerate(shingle_sets(others)):
                if last[0] != a[i]:
                    one = pa.RecordBatch.from_arrays(
                        [batch.column("a").slice(i, 1), batch.column("a").slice(i, 1),
                         batch.column("text_a").slice(i, 1)], ["doc_id", "th", "text"])
                    last[:] = [a[i], next(shingle_sets(one))[2]]
                shared = len(np.intersect1d(last[1], own, assume_unique=True))
                if 100 * shared >= percent * (len(last[1]) + len(own) - shared):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b_[keep])], ["a", "b"])

    other = texts.select(F.col("node").alias("_b"), "text")
    first = texts.select(F.col("node").alias("_a"), F.col("text").alias("text_a"))
    met = pairs.join(other, F.col("b") == F.col("_b")).join(first, F.col("a") == F.col("_a"))
    return met.select("a", "b", "text", "text_a").mapInArrow(tidy(check), "a long, b long")


def _compared(table: pa.Table, matches: int, percent: int) -> pa.Table:
    """Links that connect the members of two blocks of one list (or of one block), a spanning set of them.

    A pair is looked at in the list of its first common posting only, if it is
    not connected yet and its signatures agree in enough coordinates.
    """
    token, lo, hi = (table.column(c)[0].as_py() for c in ("token", "lo", "hi"))
    node, root, mine = (table.column(c).to_numpy() for c in ("node", "root", "mine"))
    root = root.copy()
    sig = np.array(table.column("sig").to_pylist(), np.int32).reshape(-1, COORDINATES)
    lists = np.full((len(node), COORDINATES), np.iinfo(np.int64).max)
    for i, own in enumerate(table.column("tokens").to_pylist()):
        lists[i, :len(own)] = own
    texts = pa.table({"doc_id": table.column("node"), "th": table.column("mine"), "text": table.column("text")})
    sets = [own for batch in texts.combine_chunks().to_batches() for _, _, own in shingle_sets(batch)]
    n = np.array([len(own) for own in sets])
    right = np.flatnonzero(mine == hi)
    a, c = [], []
    for i in np.flatnonzero(mine == lo):
        j = right[right > i] if lo == hi else right
        j = j[(root[j] != root[i]) & (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i]))]
        j = j[(sig[j] == sig[i]).sum(1) >= matches]
        both = (lists[j][:, :, None] == lists[i][None, None, :]).any(2)
        j = j[np.where(both, lists[j], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max) == token]
        for k in j:
            if root[k] != root[i]:
                shared = len(np.intersect1d(sets[i], sets[k], assume_unique=True))
                if 100 * shared >= percent * (n[i] + n[k] - shared):
                    a.append(node[i])
                    c.append(node[k])
                    root[root == root[k]] = root[i]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(c, pa.int64())})


def across_components(posted: DataFrame, firsts: DataFrame, roots: DataFrame, classes: DataFrame, texts: DataFrame,
                      matches: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) between members of one list that are in different components.

    A list's first member has been held against all others already. Blocks
    are cut by members and by the size of their sets.
    """
    labelled = posted.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rest = labelled.join(firsts, opaque(F.col("token")) == F.col("_token")).filter("node != first").drop("_token", "first")
    rest = rest.join(classes.select("node", "n", "sig"), "node")
    mixed = rest.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("m"),
                                      F.sum("n").alias("size")).filter("lo != hi")
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK, F.col("size") / BLOCK_SHINGLES)).cast("int")
    mixed = mixed.select(opaque(F.col("token")).alias("_token"), blocks.alias("blocks"))
    rest = rest.join(mixed, opaque(F.col("token")) == F.col("_token")).drop("_token")
    lists = posted.groupBy("node").agg(F.collect_list("token").alias("tokens"))  # a prefix: COORDINATES at most
    rest = rest.join(lists, "node").join(texts, "node")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rest = rest.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = rest.withColumns({"lo": F.least("mine", "other"), "hi": F.greatest("mine", "other")})
    return rest.select("token", "lo", "hi", "mine", "node", "root", "sig", "tokens", "text").groupBy(
        "token", "lo", "hi").applyInArrow(lambda table: _compared(table, matches, percent), "a long, b long")


def class_texts(docs: DataFrame, classes: DataFrame, several: bool) -> DataFrame:
    """(node, text): one text of each of ``classes``; ``several``: documents may be stated in several rows."""
    owners = classes.select("node", opaque(F.col("doc_id")).alias("_id"), opaque(F.col("th")).alias("_th"))
    texts = keyed_texts(docs, th=text_digest())
    same = (opaque(texts.doc_id) == owners["_id"]) & (opaque(texts.th) == owners["_th"])
    out = texts.join(owners, same).select("node", "text")
    return out.groupBy("node").agg(F.first("text").alias("text")) if several else out


def grouped(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, th, n, component (its smallest doc_id), kept for each row of ``docs``; a null id is ``NULL_ID``."""
    matches = least_matches(COORDINATES, percent)
    signed = stored(signatures(docs), "signatures")
    of_class = signed.filter("k1 is not null").groupBy("k1", "k2").agg(
        F.min(F.struct("doc_id", "th", "n", "sig")).alias("first"))
    # Ids of documents may be null or repeat, so a class gets a number of its own.
    classes = stored(of_class.select("k1", "k2", "first.*", F.monotonically_increasing_id().alias("node")), "classes")
    posted = stored(postings(classes, matches), "postings")
    firsts = posted.groupBy("token").agg(F.min("node").alias("first"), F.count("*").alias("m")).filter("m > 1").select(
        opaque(F.col("token")).alias("_token"), "first")
    stars = posted.join(firsts, opaque(F.col("token")) == F.col("_token")).filter("node != first").select(
        F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    enough = (similar_size(F.col("n_a"), F.col("n_b"), percent)
              & (agreeing(F.col("sig_a"), F.col("sig_b")) >= matches))
    stars = stored(with_signatures(stars, classes).filter(enough).select("a", "b"), "stars")
    # Texts of the classes that may be similar to any: what is left of the corpus for the exact check.
    in_lists = posted.join(firsts, opaque(F.col("token")) == F.col("_token")).select("node").distinct()
    several = not signed.groupBy("doc_id", "th").count().filter("count > 1").isEmpty()
    texts = stored(class_texts(docs, classes.join(in_lists, "node", "left_semi"), several), "candidates")
    links = stored(confirmed(stars, texts, percent), "confirmed")
    roots = components(links)
    more = stored(across_components(posted, firsts, roots, classes, texts, matches, percent), "across")
    if not more.isEmpty():
        roots = components(links.unionAll(more))
    rooted = classes.join(roots, "node", "left").select(
        F.concat_ws("/", "k1", "k2").alias("_key"), F.coalesce("root", "node").alias("root"),
        F.struct("doc_id", "th").alias("head"))
    heads = rooted.groupBy("root").agg(F.min("head").alias("head")).select(opaque(F.col("root")).alias("_root"), "head")
    ids = rooted.drop("head").join(heads, opaque(F.col("root")) == F.col("_root")).select("_key", "head")
    met = signed.withColumn("key", F.concat_ws("/", "k1", "k2")).join(ids, F.col("key") == F.col("_key"), "left")
    head, th = F.coalesce("head.doc_id", "doc_id"), F.coalesce("head.th", "th")
    return met.select("doc_id", "th", "n", head.alias("component"),
                      ((head == F.col("doc_id")) & (th == F.col("th"))).alias("kept"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs``."""
    def restored(c):
        return F.when(F.col(c) != NULL_ID, F.col(c))
    return grouped(docs, percent).select(restored("doc_id").alias("doc_id"), F.col("n").alias("n_shingles"),
                                         restored("component").alias("component_id"), "kept")
