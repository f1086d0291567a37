import numpy as np
import pytest
from pyspark.sql import functions as F

from platewise.llm import vectors
from .brute import find_roots

SF = "/root/testdata/sf0.01"


def brute(rows, threshold):
    """rows: (id, vector, label); {id: n_links}, links."""
    sound = [(i, np.array(v, np.float64), g) for i, v, g in rows
             if v and g is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    count, links = {i: 0 for i, _, _ in rows}, []
    for a, (i, v, g) in enumerate(sound):
        for j, w, h in sound[:a]:
            if g == h and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= threshold:
                links.append((i, j))
                count[i] += 1
                count[j] += 1
    return count, find_roots(count, links)


def rows_of(df):
    return [(r.vec_id, r.embedding, r.label) for r in df.collect()]


@pytest.mark.parametrize("cell_rows,max_pivots", [(1024, 4096), (7, 200), (5, 40)])
def test_equals_brute_force(spark, cell_rows, max_pivots):
    rng = np.random.default_rng(0)
    rows = rows_of(spark.read.parquet(f"{SF}/embeddings.parquet"))
    rows = [(i, [float(x) for x in v], g) for i, v, g in rows]
    centre = rng.normal(size=64)
    rows += [(10**6 + k, (centre + rng.normal(size=64) * 0.22).tolist(), 3) for k in range(60)]  # chains near the threshold
    rows += [(2 * 10**6 + k, rows[0][1], rows[0][2]) for k in range(5)]  # copies
    rows += [(3 * 10**6, None, 1), (3 * 10**6 + 1, [0.0] * 64, 1), (3 * 10**6 + 2, [float("nan")] * 64, 1), (3 * 10**6 + 3, [], 1),
             (3 * 10**6 + 4, [None] + [1.0] * 63, 1), (3 * 10**6 + 5, rows[0][1], None), (3 * 10**6 + 6, [1.0, 2.0], 3),
             (3 * 10**6 + 7, [2.0, 4.0], 3), (3 * 10**6 + 8, [1e300, -1e300], 3), (3 * 10**6 + 9, [float("inf"), 1.0], 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("n_links", F.lit(1))
    count, root = brute([r for r in rows if r[0] != 3 * 10**6 + 8], 0.93)
    got = {r.vec_id: r for r in vectors.link_vectors(df, 0.93, cell_rows=cell_rows, max_pivots=max_pivots).collect()}
    assert len(got) == len(rows) and got.pop(3 * 10**6 + 8).n_links == 0
    for i, r in got.items():
        assert (r.n_links, r.component_id, r.kept) == (count[i], root[i], root[i] == i), i


def test_null_ids_and_empty(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1)],
                               "vec_id long, embedding array<float>, label int")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in vectors.link_vectors(df, 0.93).collect())
    assert got == [(0, 0, None, True), (5, 1, 5, True), (5, 1, 5, True)]
    assert vectors.link_vectors(df.limit(0), 0.93).count() == 0


def test_a_label_never_runs_into_the_components(spark):
    rows = [(1, [2.0], "x,1.0"), (2, [1.0, 2.0], "x"), (3, [1.0], "2"), (4, [1.0], "1/2"), (5, [1.0, 1.0], "1/2"), (6, [3.0], "2/1")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.link_vectors(df, 0.93).collect()}
    assert got == {i: (0, i) for i in range(1, 7)}
