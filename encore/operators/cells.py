"""A stored index of vectors that new vectors can probe (K6, J8): an inverted file of cells.

K-means centroids cut the directions into cells. Each vector is stored in the
``copies`` cells nearest to it, laid out by cell, so a probe reads the folders
of its own cells alone. A query asks its ``probes`` nearest cells, by default a
fifth of all, and the best answer of each pair is kept.

The centroids are fitted on a bounded sample, ``FIT_PER_CELL`` vectors a cell
at most, dealt by a hash of the track id; all vectors are indexed. Only the
centroids and the cells' sizes are held by the driver and sent to tasks:
``MOST_CELLS`` rows at most. Queries are cut into few large blocks
(``streamed.QUERY_BYTES``), and cells are dealt to blocks too: a query travels once
for each block of cells that it asks, with the cells as bits, a stored vector once
for each block of queries. A task holds a block of queries and reads its cells in
a stream, each scored against the queries that ask it. A cell with more vectors
than a block has is cut into blocks of its own, so one that holds a third
of all rows is many tasks. Where all cells are asked, each vector travels by a
hash of its track, once for each block of queries. Vectors travel as FLOAT where
that loses nothing.

Defined cases: vectors without a direction (null, empty, all zero) have no
neighbours and are not stored; copies of a track collapse as in
``similar_tracks``; a query whose cells hold fewer than ``k`` other tracks is
searched in all vectors, so lists are as long as the exact ones; with no vectors
there are none.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.operators.similar import (DEFAULT_BLOCK_ROWS, LEAST_BLOCK_ROWS, _ranked, block_rows_for, nearest_of,
                                      one_vector_per_track)
from encore.operators.streamed import QUERY_BYTES, SCORED_SCHEMA, streamed_lists
from encore.session import shuffles_removed
from encore.sinks.files import materialize

#: Vectors that each cell's centroid is fitted on, about.
FIT_PER_CELL = 64
#: Bounds what the driver and the tasks hold: 65,536 centroids of 100 numbers are 50 MB.
MOST_CELLS = 65_536
#: Cells that share a folder beyond this many folders; files are sorted by cell inside.
MOST_FOLDERS = 512
COPIES, PROBED_SHARE = 3, 0.2
#: Rows, and numbers of their distances to centroids, that a task holds at once.
_AT_ONCE, _DISTANCES = 2_048, 1 << 20
#: Pairs of blocks for each core, at least, where there are rows for them; stored rows that one task reads at most, about.
TASKS_PER_CORE, MOST_STREAMED = 4, 1 << 20
#: Partitions for each core that the pairs are dealt to, at most.
MOST_PARTS = 32
FOLDER, CELL, COPY = "_cell_folder", "_cell", "_copy"
_STORED = "track_id bigint, features array<double>, label int"


def _directions(vectors: DataFrame) -> DataFrame:
    """One vector for each track, those without a direction left out."""
    square = F.aggregate("features", F.lit(0.0), lambda s, x: s + x * x)
    return one_vector_per_track(vectors).filter((square > 0) & (square < float("inf")))


def _rows_at_once(centroids: np.ndarray) -> int:
    return max(1, min(_AT_ONCE, _DISTANCES // max(1, len(centroids))))


def _nearest(x: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` cells nearest to each row."""
    x = x.astype(np.float64)
    far = -((x / np.linalg.norm(x, axis=1, keepdims=True)) @ centroids.T)
    if n >= far.shape[1]:
        return np.argsort(far, axis=1, kind="stable")
    some = np.sort(np.argpartition(far, n - 1, axis=1)[:, :n], axis=1)
    value = np.take_along_axis(far, some, axis=1)
    cells = np.take_along_axis(some, np.argsort(value, axis=1, kind="stable"), axis=1)
    # of cells as near as the last one, the first
    tied = np.flatnonzero((far <= value.max(axis=1)[:, None]).sum(axis=1) > n)
    cells[tied] = np.argsort(far[tied], axis=1, kind="stable")[:, :n]
    return cells


def nearest_cells(centroids: np.ndarray, n: int):
    """mapInPandas function: each row once for each of its ``n`` nearest cells, with its place among them."""
    n = min(n, len(centroids))
    step = _rows_at_once(centroids)

    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), step):
                rows = pdf.iloc[at:at + step]
                cells = _nearest(np.stack(rows["features"].to_numpy()), centroids, n)
                out = rows.loc[rows.index.repeat(n)].reset_index(drop=True)
                out[CELL] = cells.ravel().astype(np.int32)
                out[COPY] = np.tile(np.arange(n, dtype=np.int32), len(rows))
                yield out
    return run


def dealt(sizes: np.ndarray, block_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First block of each cell, and how many blocks it has: cells share a block while that holds ``block_rows``
    vectors, larger ones have several of their own."""
    first, several = np.zeros(len(sizes), np.int32), np.ones(len(sizes), np.int32)
    block, held = 0, 0
    for cell, size in enumerate(sizes.tolist()):
        if held and held + size > block_rows:
            block, held = block + 1, 0
        first[cell] = block
        if size > block_rows:
            several[cell] = math.ceil(size / block_rows)
            block += int(several[cell])
        else:
            held += size
    return first, several


def asking(centroids: np.ndarray, n: int, first: np.ndarray, several: np.ndarray):
    """mapInArrow function: each query with ``asked``, the blocks that hold its ``n`` nearest cells and which cells
    of each they are."""
    step = _rows_at_once(centroids)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                features = part.column("features")
                x = features.flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                cells = _nearest(x, centroids, n)
                row = np.repeat(np.arange(part.num_rows), cells.shape[1])
                cell = cells.ravel()
                times = several[cell]
                offset = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                row, cell = np.repeat(row, times), np.repeat(cell, times)
                block = first[cell] + offset
                order = np.lexsort((cell, block, row))
                row, cell, block = row[order], cell[order], block[order]
                starts = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (block[1:] != block[:-1])))
                lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(row)), pa.int32()),
                                                 pa.array(cell, pa.int32()))
                blocks = pa.StructArray.from_arrays([pa.array(block[starts], pa.int32()), lists], ["vb", "cells"])
                ends = np.searchsorted(row[starts], np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), blocks)],
                                                 [*part.schema.names, "asked"])
    return run


def packed(run, low: np.ndarray, held: np.ndarray):
    """mapInArrow function: what ``run`` (see ``asking``) yields, the cells asked of a block as bits: bit i is the i-th of
    the block's ``held`` cells, which begin with cell ``low``."""
    size = -(-held // 8)

    def pack(batches):
        for batch in run(batches):
            asked = batch.column("asked")
            blocks = asked.flatten()
            vb, lists = blocks.field("vb").to_numpy(), blocks.field("cells")
            entry = np.repeat(np.arange(len(vb)), np.diff(lists.offsets.to_numpy()))
            ends = np.append(0, np.cumsum(size[vb])).astype(np.int32)
            bits = np.zeros(8 * int(ends[-1]), np.uint8)
            bits[8 * ends[entry] + lists.flatten().to_numpy() - low[vb[entry]]] = 1
            raw = pa.Array.from_buffers(pa.binary(), len(vb), [
                None, pa.py_buffer(ends), pa.py_buffer(np.packbits(bits, bitorder="little"))])
            out = pa.ListArray.from_arrays(asked.offsets, pa.StructArray.from_arrays([pa.array(vb), raw], ["vb", "bits"]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], out], batch.schema.names)
    return pack


def cells_of(low: np.ndarray, n_cells: int):
    """mapInArrow function: the cells that a batch of what ``packed`` yields asks, each once."""
    def run(batches):
        for batch in batches:
            blocks, wanted = batch.column("asked").flatten(), np.zeros(n_cells, bool)
            vb, raw = blocks.field("vb").to_numpy(), blocks.field("bits")
            for block in np.unique(vb):
                rows = raw.filter(pa.array(vb == block)).to_pylist()
                bits = np.unpackbits(np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in rows]), bitorder="little")
                wanted[low[block] + np.flatnonzero(bits)] = True
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(wanted).astype(np.int32))], ["c"])
    return run


def narrowest(*tables: DataFrame) -> str:
    """The type in which the vectors travel: FLOAT where every number of them is one, so that nothing is lost."""
    same = F.forall("features", lambda x: x.cast("float").cast("double") == x)
    held = [t.agg(F.min(same)).first()[0] for t in tables]
    return "array<double>" if any(x is False for x in held) else "array<float>"


def blocks_for(n_queries: int, n_rows: int, most: int, cores: int) -> tuple[int, int]:
    """Blocks of queries and of stored rows: at most ``most`` queries a block, ``TASKS_PER_CORE`` pairs of blocks for each
    core where there are rows enough, and then as few copies of either side as can be. Pairs fill the cores evenly if some
    more blocks of rows do that: the last ones would keep a few cores busy, the others idle."""
    tasks, least = TASKS_PER_CORE * cores, math.ceil(n_rows / LEAST_BLOCK_ROWS)
    wanted = round(math.sqrt(tasks * n_queries / max(1, n_rows)))
    q = max(1, math.ceil(n_queries / most), min(wanted, math.ceil(n_queries / LEAST_BLOCK_ROWS)))
    v = max(1, math.ceil(n_rows / MOST_STREAMED), min(math.ceil(tasks / q), least))
    more = range(v, max(v, min(v + v // 4, least)) + 1)
    return q, max(more, key=lambda x: q * x / (math.ceil(q * x / cores) * cores))


@dataclass(frozen=True)
class CellIndex:
    """An index written by ``build_cells``: centroids, vectors of each cell, and where they are stored."""

    spark: SparkSession
    path: str
    centroids: np.ndarray
    sizes: np.ndarray
    folders: int
    n_vectors: int

    def stored(self) -> DataFrame:
        return self.spark.read.schema(f"{_STORED}, {CELL} int, {COPY} int, {FOLDER} int").parquet(f"{self.path}/cells")

    def vectors(self) -> DataFrame:
        """Each vector once."""
        return self.stored().filter(F.col(COPY) == 0).select("track_id", "features", "label")

    def of_cells(self, cells: list[int]) -> DataFrame:
        """What these cells hold: their folders are read, and in them the row groups of the cells."""
        folders = sorted({c % self.folders for c in cells})
        return self.stored().filter(F.col(FOLDER).isin(folders) & F.col(CELL).isin(sorted(cells))).drop(FOLDER, COPY)

    def nearest(self, queries: DataFrame, k: int = 10, probes: int | None = None,
                block_rows: int | None = None) -> DataFrame:
        """The ``k`` most similar tracks found for each query track; columns of ``similar_tracks``."""
        n_cells = len(self.centroids)
        asked = materialize(self.spark, _directions(queries), "cell_queries").select("track_id", "features", "label")
        if self.n_vectors == 0:
            return nearest_of(asked, self.vectors(), k, 1, 1, block_rows or DEFAULT_BLOCK_ROWS)
        n_queries = asked.count()  # from the footers
        probes = max(1, int(n_cells * PROBED_SHARE)) if probes is None else min(probes, n_cells)
        cores = self._cores()
        # where all cells are asked, each vector once will do
        n_rows = self.n_vectors if probes == n_cells else int(self.sizes.sum())
        most = max(1, QUERY_BYTES // (8 * self.centroids.shape[1]))
        q_blocks, v_blocks = blocks_for(n_queries, n_rows, most, cores)
        if block_rows:
            q_blocks, v_blocks = (max(1, math.ceil(n / block_rows)) for n in (n_queries, n_rows))
        if probes == n_cells:
            mine, found = self._all_met(asked, v_blocks)
        else:
            mine, found, v_blocks = self._probed(asked, probes, block_rows or math.ceil(n_rows / v_blocks))
        kind = narrowest(asked, self.vectors())
        query_block = F.pmod(F.xxhash64("track_id"), F.lit(q_blocks)).cast("int")
        rows = ["cell", "bits", "track_id", F.col("features").cast(kind).alias("features"), "label"]
        groups = q_blocks * v_blocks
        both = mine.select((query_block * v_blocks + F.col("vb")).alias("grp"), F.lit(0).alias("side"), *rows).unionByName(
            found.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
            .select((F.col("qb") * v_blocks + F.col("vb")).alias("grp"), F.lit(1).alias("side"), *rows))
        parts = min(groups, MOST_PARTS * cores)
        partial = (both.repartitionById(parts, F.pmod("grp", F.lit(parts)))
                   .sortWithinPartitions("grp", "side", "cell", "track_id")
                   .mapInArrow(streamed_lists(k), SCORED_SCHEMA))
        best = partial.repartition("track_id").groupBy("track_id", "similar_track_id").agg(
            F.max("sim_micro").alias("sim_micro"), F.max("similar_label").alias("similar_label"))
        lists = materialize(self.spark, _ranked(best, k), "cell_lists")
        full = lists.filter(F.col("rank") == min(k, max(1, self.n_vectors - 1))).select("track_id")
        short = materialize(self.spark, asked.join(full, "track_id", "left_anti"), "cell_short")
        if short.isEmpty():
            return lists
        return (lists.join(full, "track_id", "left_semi").unionByName(nearest_of(
            short, self.vectors(), k, None, self.n_vectors, block_rows or block_rows_for(self.n_vectors))))

    def _cores(self) -> int:
        try:
            return max(1, self.spark.sparkContext.defaultParallelism)
        except Exception:  # no driver-side context (Spark Connect)
            return int(self.spark.conf.get("spark.sql.shuffle.partitions", "10"))

    def _all_met(self, asked: DataFrame, v_blocks: int) -> tuple[DataFrame, DataFrame]:
        """Queries, each to all blocks, and every stored vector once."""
        each = [F.lit(0).alias("cell"), F.lit(None).cast("binary").alias("bits"), "track_id", "features", "label"]
        mine = asked.select(F.explode(F.sequence(F.lit(0), F.lit(v_blocks - 1))).alias("vb"), *each)
        found = self.vectors().select(F.pmod(F.xxhash64("track_id"), F.lit(v_blocks)).cast("int").alias("vb"), *each)
        return mine, found

    def _probed(self, asked: DataFrame, probes: int, rows: int) -> tuple[DataFrame, DataFrame, int]:
        """Queries, each once for every block in which it asks cells, what these cells hold, and the blocks there are."""
        n_cells = len(self.centroids)
        first, several = dealt(self.sizes, rows)
        v_blocks = int((first + several).max())
        low = np.full(v_blocks, n_cells, np.int64)
        held = np.zeros(v_blocks, np.int64)
        for cell in range(n_cells - 1, -1, -1):  # a cell's blocks hold it alone, or one block holds it with its neighbours
            mine = slice(first[cell], first[cell] + several[cell])
            low[mine], held[mine] = cell, held[mine] + 1
        placed = materialize(self.spark, asked.mapInArrow(
            packed(asking(self.centroids, probes, first, several), low, held),
            f"{_STORED}, asked array<struct<vb int, bits binary>>"), "cell_probes")
        # as many rows as there are cells, at most
        wanted = [r.c for r in placed.select("asked").mapInArrow(cells_of(low, n_cells), "c int").distinct().collect()]
        stored = self.stored().drop(FOLDER, COPY) if len(wanted) == n_cells else self.of_cells(wanted)
        places = self.spark.createDataFrame([(c, int(first[c]), int(several[c]), int(low[first[c]])) for c in range(n_cells)],
                                            f"{CELL} int, first int, several int, low int")
        mine = placed.select(F.explode("asked").alias("a"), "track_id", "features", "label").select(
            "a.vb", F.lit(-1).alias("cell"), "a.bits", "track_id", "features", "label")
        found = stored.join(F.broadcast(places), CELL).select(
            (F.col("first") + F.pmod(F.xxhash64("track_id"), F.col("several"))).cast("int").alias("vb"),
            (F.col(CELL) - F.col("low")).alias("cell"), F.lit(None).cast("binary").alias("bits"),
            "track_id", "features", "label")
        return mine, found, v_blocks


def _sizes(stored: DataFrame, n_cells: int) -> np.ndarray:
    """Rows of each cell."""
    sizes = np.zeros(n_cells, np.int64)
    for r in stored.groupBy(CELL).count().collect():
        sizes[r[CELL]] = r["count"]
    return sizes


def _fitted(vectors: DataFrame, n_vectors: int, n_cells: int, seed: int) -> np.ndarray:
    """Unit centroids, fitted on about ``FIT_PER_CELL`` vectors a cell."""
    share = min(1.0, FIT_PER_CELL * n_cells / n_vectors)
    sample = vectors.filter(F.pmod(F.xxhash64("track_id", F.lit(seed)), F.lit(1 << 20)) < share * (1 << 20))
    points = sample.select(array_to_vector("features").alias("features"))
    model = KMeans(k=n_cells, seed=seed, maxIter=10, distanceMeasure="cosine").fit(points)
    centroids = np.array(model.clusterCenters())
    return centroids / np.linalg.norm(centroids, axis=1, keepdims=True)


def build_cells(vectors: DataFrame, path: str, n_cells: int | None = None, copies: int = COPIES,
                seed: int = 7) -> CellIndex:
    """Write the index of ``vectors`` (track_id, features, optional label) to the new directory ``path``.

    ``n_cells`` defaults to four times the root of the number of vectors.
    """
    spark = vectors.sparkSession
    vec = materialize(spark, _directions(vectors), "cell_vectors")
    n_vectors = vec.count()  # from the footers
    n_cells = min(MOST_CELLS, n_vectors, n_cells or math.ceil(4 * math.sqrt(n_vectors)))
    if n_cells > 1:
        centroids = _fitted(vec, n_vectors, n_cells, seed)
    else:  # a table of one vector, or none
        only = [np.array(r.features) for r in vec.select("features").limit(1).collect()]
        centroids = np.array([x / np.linalg.norm(x) for x in only])
    folders = max(1, min(MOST_FOLDERS, len(centroids)))
    if n_vectors:
        rows = vec.mapInPandas(nearest_cells(centroids, copies), f"{_STORED}, {CELL} int, {COPY} int")
    else:
        rows = spark.createDataFrame([], f"{_STORED}, {CELL} int, {COPY} int")
    placed = rows.withColumn(FOLDER, F.col(CELL) % folders)
    with shuffles_removed(spark):
        (placed.hint("rebalance", F.col(FOLDER)).sortWithinPartitions(FOLDER, CELL)
         .write.mode("errorifexists").partitionBy(FOLDER).parquet(f"{path}/cells"))
    spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centroids)],
                          "cell int, centroid array<double>").coalesce(1).write.parquet(f"{path}/centroids")
    spark.createDataFrame([(json.dumps({"folders": folders, "n_vectors": n_vectors}),)], "about string").coalesce(
        1).write.parquet(f"{path}/about")
    return load_cells(spark, path)


def load_cells(spark: SparkSession, path: str) -> CellIndex:
    """An index that ``build_cells`` has written; its last part written is ``about``."""
    about = json.loads(spark.read.parquet(f"{path}/about").first()[0])
    centroids = [r.centroid for r in spark.read.parquet(f"{path}/centroids").orderBy("cell").collect()]
    index = CellIndex(spark, path, np.array(centroids), np.zeros(len(centroids), np.int64), about["folders"],
                      about["n_vectors"])
    index.sizes[:] = _sizes(index.stored(), len(centroids))
    return index
