"""Models brought to the executors as files, and batches of rows of like size."""

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import functions as F

from platewise.plans import ml
from platewise.session import work_path
from platewise.sources.fixtures import Fixtures

from conftest import SF_SMALL


def test_shipped_layer_scores_as_the_layer_itself(spark):
    rng = np.random.default_rng(1)
    w, b = rng.normal(size=(10, 64)), rng.normal(size=10)
    v = Fixtures(spark, SF_SMALL).vector_data()
    rows = [ml.score(v, "embedding", fn, batch_size=64, width=64).select("key", "probs", "category_id", "prob")
            for fn in (ml.softmax_predict_fn(w, b), ml.shipped_softmax_predict_fn(spark, w, b))]
    assert sorted(rows[0].collect()) == sorted(rows[1].collect()) and rows[0].count() == v.count() > 0


def test_tasks_do_not_carry_the_weights(spark):
    sizes = [len(cloudpickle.dumps(ml.shipped_softmax_predict_fn(spark, np.zeros((n, 64)), np.zeros(n)))) for n in (10, 5000)]
    assert abs(sizes[0] - sizes[1]) < 100
    assert len(cloudpickle.dumps(ml.softmax_predict_fn(np.zeros((5000, 64)), np.zeros(5000)))) > 100 * sizes[1]


def test_an_array_larger_than_one_write(spark, monkeypatch):
    monkeypatch.setattr(ml, "SHIP_BYTES", 1000)
    a = np.arange(5000.0).reshape(50, 100)
    name = ml.ship_array(spark, a)
    mapped = ml.open_array(name)
    assert isinstance(mapped, np.memmap) and np.array_equal(mapped, a)


def test_rows_of_like_size_meet_in_a_batch(spark):
    def padding():
        """A model that tells how far each text was padded in its batch, and its length."""
        import numpy as np

        def run(texts):
            n = np.array([len(t) for t in texts])
            return np.stack([n.max() - n, n], axis=1).astype(np.float32)
        return run

    path = work_path(spark, "texts")
    spark.range(4000).select("id", F.repeat(F.lit("x"), (F.xxhash64("id") % 500 + 500).cast("int")).alias("name")).coalesce(2).write.parquet(path)
    df = spark.read.parquet(path)
    plain, ordered = [ml.score(df, "name", padding, batch_size=64, size=size).select("id", F.element_at("probs", 1).alias("pad"), F.element_at("probs", 2).alias("n"))
                      for size in (None, F.length("name"))]
    want = {r.id: len(r.name) for r in df.collect()}
    assert {r.id: r.n for r in ordered.collect()} == want
    padded = [d.agg(F.sum("pad")).first()[0] for d in (plain, ordered)]
    assert padded[1] < padded[0] / 10
