"""The stored index of cells: recall, pruned reads, full lists, odd tables."""

import re

import pytest
from pyspark.sql import functions as F

from encore.operators import cells
from encore.operators.similar import nearest_of, recall_at_k
from encore.session import scratch_path
from encore.sources import testdata as td


@pytest.fixture(scope="module")
def vectors(spark):
    return td.vectors(spark, "/root/testdata/sf0.1").cache()


@pytest.fixture(scope="module")
def index(spark, vectors):
    return cells.build_cells(vectors, scratch_path(spark, "cells"))


def test_recall_with_a_fifth_of_the_cells(spark, vectors, index):
    queries = vectors.filter(F.col("track_id") % 5 == 0)
    exact = nearest_of(queries, vectors, 10).cache()
    loaded = cells.load_cells(spark, index.path)
    got = loaded.nearest(queries, 10).cache()
    recall = recall_at_k(got, exact).first()["recall"]
    print("recall@10", recall)
    assert recall >= 0.9
    assert got.count() == exact.count()
    assert got.dtypes == exact.dtypes
    # what was found has the exact similarity
    met = got.join(exact, ["track_id", "similar_track_id"])
    assert met.filter(got["similarity"] != exact["similarity"]).isEmpty()
    whole = loaded.nearest(queries, 10, probes=len(index.centroids), block_rows=50)
    key = ["track_id", "rank", "similar_track_id", "similarity"]
    assert sorted(map(tuple, whole.select(key).collect())) == sorted(map(tuple, exact.select(key).collect()))


def test_each_vector_is_stored_in_its_cells(index, vectors):
    assert index.stored().count() == cells.COPIES * vectors.count() == index.sizes.sum()
    assert sorted(r.track_id for r in index.vectors().collect()) == sorted(r.track_id for r in vectors.collect())


def test_a_probe_reads_its_cells_alone(index):
    rows = index.of_cells([3, 5])
    assert {r[cells.CELL] for r in rows.collect()} <= {3, 5}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    listed = re.search(r"PartitionFilters: \[.*?_cell_folder#\d+ (?:IN|INSET) \(?([\d, ]+)", plan)
    assert listed and {int(x) for x in listed[1].replace(" ", "").strip(",").split(",")} == {3, 5}, plan
    assert "In(_cell, [3,5])" in plan


def test_odd_tables(spark):
    schema = "track_id long, features array<double>"
    empty = cells.build_cells(spark.createDataFrame([], schema), scratch_path(spark, "no_cells"))
    some = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (2, [0.9, 0.1]), (3, [0.0, 1.0]),
                                  (4, [0.0, 0.0]), (5, None)], schema)
    assert empty.nearest(some, 2).collect() == []
    one = cells.build_cells(some.filter("track_id = 1"), scratch_path(spark, "one_cell"))
    assert [(r.track_id, r.similar_track_id) for r in one.nearest(some, 2).orderBy("track_id").collect()] == [(2, 1), (3, 1)]
    few = cells.build_cells(some, scratch_path(spark, "few_cells"))
    got = few.nearest(some, 2, probes=1).orderBy("track_id", "rank").collect()
    assert [(r.track_id, r.similar_track_id) for r in got] == [(1, 2), (1, 3), (2, 1), (2, 3), (3, 2), (3, 1)]


def test_a_hot_cell_is_searched_in_blocks(spark):
    alike = spark.range(1000, 1300).select(F.col("id").alias("track_id"),
                                           F.expr("array(1.0D, id / 1e6, 0.5D)").alias("features"))
    index = cells.build_cells(alike, scratch_path(spark, "hot_cell"), n_cells=4, copies=1)
    asked = alike.filter("track_id % 50 = 0")
    got = index.nearest(asked, 3, block_rows=40)
    exact = nearest_of(asked, alike, 3)
    total = lambda df: df.agg(F.sum("similarity")).first()[0]
    assert got.count() == exact.count() and abs(total(got) - total(exact)) < 1e-3


def test_a_query_travels_by_blocks_of_cells():
    import numpy as np
    import pyarrow as pa
    first, several = cells.dealt(np.array([3, 4, 2, 25, 1, 0, 9]), 10)
    assert first.tolist() == [0, 0, 0, 1, 4, 4, 4] and several.tolist() == [1, 1, 1, 3, 1, 1, 1]
    centroids = np.eye(7)
    batch = pa.RecordBatch.from_pydict({"track_id": [1], "features": [[1.0, 0.9, 0.1, 0.8, 0.2, 0.3, 0.4]], "label": [1]})
    out, = cells.asking(centroids, 4, first, several)([batch])
    # four cells asked in five blocks, the features once for each block
    assert out.column("asked").to_pylist() == [[{"vb": 0, "cells": [0, 1]}, {"vb": 1, "cells": [3]}, {"vb": 2, "cells": [3]},
                                                {"vb": 3, "cells": [3]}, {"vb": 4, "cells": [6]}]]


def test_what_a_task_yields_is_bounded_for_any_number_of_cells():
    import numpy as np
    import pyarrow as pa
    n = 5000
    vectors = np.random.default_rng(1).normal(size=(n, 4))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(300)), pa.array(list(vectors[:300])), pa.array(np.zeros(300, np.int32))],
                                       ["track_id", "features", "label"])
    got = list(cells.asking(vectors, n, *cells.dealt(np.full(n, 3), 1000))([batch]))
    assert sum(b.num_rows for b in got) == 300
    assert max(b.num_rows for b in got) * n <= cells._DISTANCES
    # a query stands once, not once for each of its 5000 cells
    assert {len(a) for b in got for a in b.column("asked").to_pylist()} == {16}
