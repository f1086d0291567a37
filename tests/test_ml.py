"""Split invariants, label encoding, a model accuracy floor, and batch scoring."""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from platewise.plans import ml
from platewise.sources.fixtures import SEED, Fixtures

from conftest import SF_MID, SF_SMALL


def test_split_is_disjoint_complete_and_stable(spark):
    td = Fixtures(spark, SF_MID).training_data()
    a = ml.split(td, "key", SEED).select("key", "split")
    b = ml.split(td, "key", SEED).select("key", "split")
    assert a.count() == td.count() == a.select("key").distinct().count()
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    share = a.where(F.col("split") == "test").count() / a.count()
    assert 0.14 < share < 0.26


def test_text_model_accuracy_floor(spark):
    td = Fixtures(spark, SF_MID).training_data()
    enc = ml.fit_labels(td, "dish_type_l3")
    assert [r.category_id for r in enc.orderBy("category_id").collect()] == [0, 1, 2, 3]
    data = ml.split(ml.encode_labels(td, "dish_type_l3", enc), "key", SEED)
    model, val = ml.train_and_validate(data, "dish_name", max_iter=20, num_features=1 << 12)
    val = val.first()
    assert val.accuracy >= 0.9 and val.n == data.where(F.col("split") == "val").count()
    pred = ml.predict(model, data.where(F.col("split") == "test"), text_col="dish_name")
    m = ml.evaluate(pred).first()
    assert m.accuracy >= 0.9, m


def test_batch_scoring_matches_native_argmax(spark):
    from platewise.functions.arrays import argmax

    v = Fixtures(spark, SF_SMALL).vector_data()
    s = ml.score(v, "embedding", ml.identity_predict_fn(), batch_size=64, width=64)
    bad = s.where(F.col("category_id") != argmax("embedding")).count()
    assert bad == 0


def test_vector_model_accuracy_floor(spark):
    """Vectors of a label share a direction only weakly: well above one label in ten on seen rows."""
    v = Fixtures(spark, SF_MID).vector_data()
    model = ml.train_vec(v, "embedding", "label")
    m = ml.evaluate(ml.predict(model, v, vector_col="embedding")).first()
    assert m.accuracy >= 0.3 and m.n == v.count()


def test_char_ngram_model_and_vector_model(spark):
    td = Fixtures(spark, SF_SMALL).training_data()
    enc = ml.fit_labels(td, "dish_type_l3")
    data = ml.encode_labels(td, "dish_type_l3", enc)
    model = ml.train_text(data, "dish_name", analyzer="char", ngram=3, max_iter=10, num_features=1 << 14)
    pred = ml.predict(model, data, text_col="dish_name")
    assert pred.count() == data.count()
    assert pred.where((F.col("prob") < 0) | (F.col("prob") > 1)).count() == 0
    v = Fixtures(spark, SF_SMALL).vector_data()
    vm = ml.train_vec(v, "embedding", "label", max_iter=10)
    vp = ml.predict(vm, v, vector_col="embedding")
    assert vp.select("category_id").where(F.col("category_id").isNull()).count() == 0


def test_probability_and_loss_are_the_models_own(spark):
    """From the stored coefficients, in NumPy: softmax, its largest entry, and the mean log-loss."""
    import numpy as np

    from platewise import operator_queries as oq

    model, _, _ = oq._tag_model(spark, SF_SMALL)
    layer, hashed = model.stages[-1], PipelineModel(model.stages[:-1])
    test = oq._tag_training(Fixtures(spark, SF_SMALL)).where("split = 'test'")
    known = {r.menu_id: int(r.label) for r in test.collect()}
    weights, bias = layer.coefficientMatrix.toArray(), layer.interceptVector.toArray()
    want, losses = {}, []
    for r in hashed.transform(ml.with_clean_text(Fixtures(spark, SF_SMALL).menu(), "menu_name")).select("menu_id", "features").collect():
        z = weights @ r.features.toArray() + bias
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        want[r.menu_id] = (int(p.argmax()), p.max())
        if r.menu_id in known:
            losses.append(-np.log(p[known[r.menu_id]]))
    got = {r.menu_id: (r.category_id, r.prob) for r in oq.ml_predict(spark, SF_SMALL).collect()}
    assert got.keys() == want.keys()
    assert all(got[i][0] == c and abs(got[i][1] - p) < 1e-9 for i, (c, p) in want.items())
    assert len({round(p, 6) for _, p in got.values()}) > 10
    told = oq.ml_evaluate(spark, SF_SMALL).first()
    assert told.n == len(losses) and abs(told.loss - np.mean(losses)) < 1e-9
    for r in oq.tag_menus(spark, SF_SMALL).collect():
        assert abs(r.prob - want[r.menu_id][1]) < 1e-6


def test_tune_for_input_leaves_fixed_settings(spark):
    from platewise.session import tune_for_input

    before = spark.conf.get("spark.sql.shuffle.partitions")
    old_split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    done = tune_for_input(spark, 100 << 40)
    try:
        assert "spark.sql.shuffle.partitions" not in done  # the test session was launched with 8
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        assert done["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    finally:
        for k in done:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.files.maxPartitionBytes", old_split)


def test_names_of_one_split_are_dealt_to_all_cores(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    names = spark.range(3000).selectExpr("id menu_id", "concat('dish ', chr(97 + cast(id % 3 as int))) name", "cast(id % 3 as int) label").coalesce(1)
    model = ml.train_text(names, "name", num_features=1 << 10, max_iter=10)
    pred = ml.predict(model, names, text_col="name").cache()
    assert pred.select(F.spark_partition_id()).distinct().count() > 1
    assert pred.count() == 3000 and pred.where("category_id <> label").count() == 0
    assert ml.spread(names, "name").rdd.getNumPartitions() == min(cores, 12)
    monkeypatch.setattr(ml, "TEXT_BYTES", 300)
    assert ml.spread(names, "name").rdd.getNumPartitions() == 60  # 18,000 bytes
    monkeypatch.setattr(ml, "NAMES", 10)
    assert ml.spread(names, "name").rdd.getNumPartitions() == 300
    assert ml.spread(names.limit(0), "name").rdd.getNumPartitions() == 1


def test_the_text_model_is_the_plain_pipelines(spark):
    td = Fixtures(spark, SF_SMALL).training_data()
    data = ml.encode_labels(td, "dish_type_l3", ml.fit_labels(td, "dish_type_l3"))
    kw = {"num_features": 1 << 10, "max_iter": 10}
    plain = ml.text_pipeline(**kw).fit(ml.with_clean_text(data, "dish_name"))
    got = ml.train_text(data, "dish_name", **kw)
    assert [type(s) for s in got.stages] == [type(s) for s in plain.stages]
    assert got.stages[-2].docFreq == plain.stages[-2].docFreq and got.stages[-2].numDocs == plain.stages[-2].numDocs
    a, b = (m.stages[-1].coefficientMatrix.toArray() for m in (got, plain))
    assert abs(a - b).max() < 1e-6 * abs(b).max()


def test_counted_ngrams_are_the_stages_vectors(spark, monkeypatch):
    texts = ["", "a", "ab", "abc", "Abc aBC abc", "ส้มตำ ‘x’ ส้มตำ", " ", "﻿yz﻿", "zz" * 40, "กขค" * 9]
    some = spark.createDataFrame([(i, t) for i, t in enumerate(texts + [None])], "id int, t string")
    docs = Fixtures(spark, SF_SMALL).training_data().selectExpr("cast(key as int) id", "dish_name t")
    for n, piece, rows in ((3, 7, some), (2, 1, some), (4, 1 << 20, some), (1, 5, some), (3, 1 << 20, docs), (5, 1 << 20, some)):
        monkeypatch.setattr(ml, "PIECE", piece)
        monkeypatch.setattr(ml, "MOST_KNOWN", 4)
        stages = ml.text_pipeline(ngram=n, num_features=1 << 16).getStages()[:3]
        clean = ml.with_clean_text(rows, "t")
        want = {r.id: r._tf for r in PipelineModel(stages).transform(clean).collect()}
        got = {r.id: r._tf for r in ml.hashed_counts(clean, stages).collect()}
        assert got == want and ("MapInArrow" in ml.hashed_counts(clean, stages)._jdf.queryExecution().toString()) == (n < 5)
