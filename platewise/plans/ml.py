"""Text classification on Spark ML: labels, split, train, predict, evaluate.

The contract is the original model's: text in, class-probability vector out.
Everything runs on executors; nothing is collected to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from fractions import Fraction

from pyspark import SparkFiles
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, NGram, RegexTokenizer
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewise.functions.arrays import argmax, max_prob
from platewise.functions.text import clean_text
from platewise.operators.counting import cut_by_counting
from platewise.operators.relational import sized_broadcast
from platewise.session import durable, work_path
from platewise.sources.sinks import _fs

SHIP_BYTES = 8 << 20  # of an array written at once
TEXT_BYTES = 16 << 20  # of texts that one task turns into features
PIECE = 1 << 17  # characters whose n-grams are counted at once
MOST_KNOWN = 1 << 20  # n-grams whose slots a task remembers
ROWS_AT_ONCE = 128
NAMES = 1 << 16  # rows that one task turns into features, however short
FEW = 256  # fewer rows aren't worth a task
SCORING_TASKS = 4  # per core; rows stream through them, so they hold no more where the input grows


def fit_labels(df: DataFrame, label_col: str) -> DataFrame:
    """Encoder table: sorted distinct labels -> ``category_id`` 0..n-1.

    The distinct label set is one row per class (a small, bounded table).
    """
    labels = df.select(F.col(label_col).alias("dish_type_l3")).where(F.col("dish_type_l3").isNotNull()).distinct()
    return labels.select(
        (F.row_number().over(Window.orderBy("dish_type_l3")) - 1).cast("int").alias("category_id"),
        "dish_type_l3")


def encode_labels(df: DataFrame, label_col: str, encoder: DataFrame, out: str = "label") -> DataFrame:
    enc = sized_broadcast(encoder.select(F.col("dish_type_l3").alias("_lbl"), F.col("category_id").alias(out)))
    return df.join(enc, F.col(label_col) == F.col("_lbl"), "inner").drop("_lbl")


def _unit(seed: int, key, tag: str):
    h = F.md5(F.concat(F.lit(f"{seed}{tag}:"), key.cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long") / F.lit(2 ** 32)


def split(df: DataFrame, key: str, seed: int, test: float = 0.2, val: float = 0.15) -> DataFrame:
    """Stable seeded split into ``train``/``val``/``test`` by a hash of the key.

    ``test`` of all rows, then ``val`` of the rest (about 68/12/20 %).  No
    shuffle and no sampling job: each row decides alone, so the split is the
    same on every run and every cluster size.
    """
    k = F.col(key)
    s = (F.when(_unit(seed, k, "") < test, F.lit("test"))
         .when(_unit(seed, k, ":val") < val, F.lit("val"))
         .otherwise(F.lit("train")))
    return df.withColumn("split", s)


def split_exact(df: DataFrame, key: str, seed: int, test: float = 0.2, val: float = 0.15) -> DataFrame:
    """``split`` with exact sizes: of ``n`` rows ``ceil(test * n)`` are ``test``, and of the others
    ``ceil(val * rest)`` are ``val`` (shares taken as the decimals they are written as).

    The rows with the smallest seeded digests of ``key`` are taken, found by counting
    (:func:`cut_by_counting`) without a sort or a shuffle of rows.  Rows of one key may
    part at a border, as their whole rows' digests say, since sizes count rows; use
    :func:`split` where a key must stay in one part.
    """
    def ends(n: int) -> list[int]:
        t = math.ceil(Fraction(str(test)) * n)
        return [t, t + math.ceil(Fraction(str(val)) * (n - t))]

    whole = F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(df.columns)]), {"ignoreNullFields": "false"})
    own = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    parts = cut_by_counting(df, [own, whole], ends, out="_part")
    return parts.withColumn("split", F.element_at(F.array(F.lit("test"), F.lit("val"), F.lit("train")), F.col("_part") + 1)).drop("_part")


def text_pipeline(label_col: str = "label", analyzer: str = "char", ngram: int = 3,
                  num_features: int = 1 << 16, max_iter: int = 25, reg: float = 1e-4) -> Pipeline:
    """tokens (character n-grams, or words) -> hashed TF -> IDF -> softmax regression.

    Characters by default: half of the kept ones are Thai, which sets no spaces
    between words, so an unseen name would be a single unseen word.
    Reads the cleaned text column ``_clean`` (see :func:`with_clean_text`).  The
    model holds classes x ``num_features`` coefficients and is shipped to every
    executor that scores, so the hash width is kept moderate (2^16: about 50 MB
    for 100 dish classes).
    """
    if analyzer == "char":
        stages = [RegexTokenizer(inputCol="_clean", outputCol="_chars", pattern="", gaps=True,
                                 toLowercase=True, minTokenLength=1),
                  NGram(n=ngram, inputCol="_chars", outputCol="_tokens")]
    else:
        stages = [RegexTokenizer(inputCol="_clean", outputCol="_tokens", pattern="\\s+", gaps=True,
                                 toLowercase=True)]
    return Pipeline(stages=[
        *stages,
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol=label_col, family="multinomial",
                           maxIter=max_iter, regParam=reg),
    ])


def with_clean_text(df: DataFrame, text_col: str) -> DataFrame:
    """The whitelisted-character form of the text, as the model sees it."""
    return df.withColumn("_clean", F.coalesce(clean_text(text_col), F.lit("")))


def spread(df: DataFrame, text_col: str) -> DataFrame:
    """The rows at random over as many tasks as their texts' bytes and their number ask for, and
    at least over the cluster's cores.

    Features cost far more per byte than a scan, whose splits follow stored (compressed)
    bytes: millions of names can lie in one split.  Takes a count of the rows.
    """
    known = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text_col)).alias("bytes")).first()
    least = min(df.sparkSession.sparkContext.defaultParallelism, -(-known.n // FEW))
    return df.repartition(max(1, least, -(-known.n // NAMES), -(-(known.bytes or 0) // TEXT_BYTES)))


def _murmur3(data: bytes, seed: int = 42) -> int:
    """Murmur3 (x86, 32 bits, signed) of some bytes, as ``HashingTF`` hashes a term."""
    m, h = 0xFFFFFFFF, seed
    whole = len(data) // 4 * 4
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i:i + 4], "little") * 0xCC9E2D51 & m
        h ^= ((k << 15 | k >> 17) & m) * 0x1B873593 & m
        if i < whole:
            h = ((h << 13 | h >> 19) & m) * 5 + 0xE6546B64 & m
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & m
    h = (h ^ h >> 13) * 0xC2B2AE35 & m
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def _gram_counts(texts: list[str], n: int, width: int, known: dict):
    """(ends, slots, counts) of the texts' character n-grams: a text's slots ascend.  ``known`` holds
    the slot of each n-gram met before.  Texts are joined by a zero, which cleaned ones don't hold."""
    import numpy as np

    points = np.frombuffer("\0".join(texts).lower().encode("utf-16-le"), np.uint16)
    key, count, before = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for at in range(0, max(0, len(points) - n + 1), PIECE):  # a long text comes in pieces
        piece = points[at:at + PIECE + n - 1]
        size = len(piece) - n + 1
        owner = before + np.cumsum(piece == 0)
        before = owner[size - 1]
        gram = np.zeros(size, np.uint64)
        for i in range(n):
            gram = gram << np.uint64(16) | piece[i:i + size]
        inside = (owner[:size] == owner[n - 1:]) & (piece[:size] != 0)
        found, which = np.unique(gram[inside], return_inverse=True)
        if len(known) > MOST_KNOWN:
            known.clear()
        slots = np.zeros(len(found), np.int64)
        for j, g in enumerate(found.tolist()):
            slot = known.get(g)
            if slot is None:
                term = " ".join(chr(g >> 16 * i & 0xFFFF) for i in range(n - 1, -1, -1))
                slot = known[g] = _murmur3(term.encode()) % width
            slots[j] = slot
        more, times = np.unique(owner[:size][inside] * width + slots[which], return_counts=True)
        key, which = np.unique(np.concatenate([key, more]), return_inverse=True)
        count = np.bincount(which, np.concatenate([count, times]), len(key)).astype(np.int64)
    return np.searchsorted(key, np.arange(len(texts) + 1) * width), key % width, count


def hashed_counts(df: DataFrame, stages: list) -> DataFrame:
    """``PipelineModel(stages).transform(df)`` for the stages before the inverse frequencies.  Characters'
    n-grams are counted by array operations in Arrow batches, which gives the vectors that the
    stages give without a string per character and per n-gram; other stages run as they are."""
    first, hashing = stages[0], stages[-1]
    plain = (len(stages) == 3 and isinstance(first, RegexTokenizer) and isinstance(stages[1], NGram) and first.getPattern() == ""
             and first.getGaps() and first.getToLowercase() and first.getMinTokenLength() == 1 and stages[1].getN() <= 4
             and isinstance(hashing, HashingTF) and not hashing.getBinary() and first.getInputCol() == "_clean")
    if not plain:
        return PipelineModel(stages).transform(df)
    n, width, out = stages[1].getN(), hashing.getNumFeatures(), hashing.getOutputCol()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        known: dict = {}
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                ends, slots, counts = _gram_counts(part.column("_clean").to_pylist(), n, width, known)
                ends = pa.array(ends.astype(np.int32))
                vectors = pa.StructArray.from_arrays(
                    [pa.array(np.zeros(part.num_rows, np.int8)), pa.array(np.full(part.num_rows, width, np.int32)),
                     pa.ListArray.from_arrays(ends, pa.array(slots.astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.float64)))], names=["type", "size", "indices", "values"])
                yield pa.RecordBatch.from_arrays([*part.columns, vectors], names=[*part.schema.names, out])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, VectorUDT())]))


def train_text(df: DataFrame, text_col: str, label_col: str = "label", **kw) -> PipelineModel:
    """The fitted :func:`text_pipeline`, stage by stage: texts become hashed counts once, which are
    stored, and both the inverse frequencies and the regression are fitted on those."""
    *hashed, idf, layer = text_pipeline(label_col, **kw).getStages()
    rows = with_clean_text(spread(df.select(text_col, label_col), text_col), text_col)
    counted = durable(hashed_counts(rows, hashed).select("_tf", label_col))
    idf = idf.fit(counted)
    return PipelineModel([*hashed, idf, layer.fit(idf.transform(counted))])


def train_and_validate(data: DataFrame, text_col: str, label_col: str = "label", **kw) -> tuple[PipelineModel, DataFrame]:
    """Fit on the ``train`` rows of :func:`split` data; the model, and its loss and
    accuracy on the ``val`` rows (``test`` rows are left for the caller)."""
    model = train_text(data.where(F.col("split") == "train"), text_col, label_col, **kw)
    return model, evaluate(predict(model, data.where(F.col("split") == "val"), text_col=text_col), label_col)


def save_model(model: PipelineModel, encoder: DataFrame, path: str) -> None:
    """Store a model and its label encoder side by side, for a later scoring job."""
    model.write().overwrite().save(f"{path.rstrip('/')}/model")
    encoder.write.mode("overwrite").parquet(f"{path.rstrip('/')}/encoder")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path.rstrip('/')}/model"), spark.read.parquet(f"{path.rstrip('/')}/encoder")


def train_vec(df: DataFrame, vec_col: str = "embedding", label_col: str = "label",
              max_iter: int = 100, reg: float = 1e-3) -> PipelineModel:
    """Softmax layer on a float-array feature (the encoder's output)."""
    lr = LogisticRegression(featuresCol="features", labelCol=label_col, family="multinomial",
                            maxIter=max_iter, regParam=reg)
    return Pipeline(stages=[lr]).fit(df.withColumn("features", array_to_vector(vec_col)))


def predict(model: PipelineModel, df: DataFrame, text_col: str | None = None,
            vector_col: str | None = None) -> DataFrame:
    """Score and reduce to ``category_id`` (argmax, first on ties), ``prob`` and ``probs``.  Texts are
    dealt to all cores first: a scan's splits follow its bytes, and one can hold millions of names."""
    if text_col:
        df = with_clean_text(df.repartition(SCORING_TASKS * df.sparkSession.sparkContext.defaultParallelism), text_col)
    if vector_col:
        df = df.withColumn("features", array_to_vector(vector_col))
    at = next((i for i, stage in enumerate(model.stages) if isinstance(stage, HashingTF)), None) if text_col else None
    if at is not None:
        scored = PipelineModel(model.stages[at + 1:]).transform(hashed_counts(df, model.stages[:at + 1]))
    else:
        scored = model.transform(df)
    out = scored.withColumn("_p", vector_to_array("probability"))
    out = out.withColumns({"category_id": argmax("_p"), "prob": max_prob("_p"), "probs": F.col("_p")})
    drop = [c for c in out.columns if c.startswith("_") or c in
            ("features", "rawPrediction", "probability", "prediction")]
    return out.drop(*drop)


def evaluate(pred: DataFrame, label_col: str = "label", probs_col: str = "probs",
             pred_col: str = "category_id") -> DataFrame:
    """Mean log-loss and accuracy (one distributed aggregation, one row out)."""
    p_true = F.element_at(F.col(probs_col), F.col(label_col).cast("int") + 1).cast("double")
    return pred.agg(
        F.avg(-F.ln(F.greatest(p_true, F.lit(1e-15)))).alias("loss"),
        F.avg((F.col(pred_col) == F.col(label_col)).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n"))


def score(df: DataFrame, col: str, make_predict_fn: Callable, batch_size: int = 1024,
          width: int | None = None, size: Column | None = None) -> DataFrame:
    """Score ``col`` with an external model in Arrow batches of ``batch_size``.

    With ``size`` (a text's length, say) the rows of a partition come to the model in that
    order, so a model that pads a batch to its longest row pads little.  The sort is the
    partition's own: nothing is shuffled, and it spills.

    ``make_predict_fn`` is called once per Python worker and returns a function
    from a NumPy batch to a batch of probability rows (the Keras-style
    ``predict``).  The result gets ``category_id`` and ``prob`` as in
    :func:`predict`.
    """
    kw = {"input_tensor_shapes": [[width]]} if width else {}
    udf = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.DoubleType()),
                            batch_size=batch_size, **kw)
    if size is not None:
        df = df.sortWithinPartitions(size)
    s = df.withColumn("probs", udf(col))
    return s.withColumns({"category_id": argmax("probs"), "prob": max_prob("probs")})


def _softmax_layer(w, b) -> Callable:
    import numpy as np

    def run(x):
        z = np.asarray(x, dtype=np.float64) @ w.T + b
        z = z - z.max(axis=1, keepdims=True)
        e = np.exp(z)
        return e / e.sum(axis=1, keepdims=True)
    return run


def softmax_predict_fn(weights, bias) -> Callable:
    """A ``make_predict_fn`` for a softmax layer given as NumPy arrays (in every task; for a
    layer of some size see :func:`shipped_softmax_predict_fn`)."""
    def make():
        import numpy as np

        return _softmax_layer(np.asarray(weights, dtype=np.float64), np.asarray(bias, dtype=np.float64))
    return make


def ship_array(spark: SparkSession, array, name: str = "array") -> str:
    """Write an array once to the shared folder and let Spark bring it to every executor
    (``addFile``); the name for :func:`open_array`."""
    import io

    import numpy as np

    buffer = io.BytesIO()
    np.save(buffer, np.ascontiguousarray(array))
    path = f"{work_path(spark, name)}.npy"
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    view = buffer.getvalue()
    for at in range(0, len(view), SHIP_BYTES):
        out.write(bytearray(view[at:at + SHIP_BYTES]))
    out.close()
    spark.sparkContext.addFile(p.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString())
    return path.rsplit("/", 1)[-1]


def open_array(name: str):
    """A shipped array in a Python worker, mapped from the executor's file: the workers of an
    executor share its pages, and only what is used is read."""
    import numpy as np

    return np.load(SparkFiles.get(name), mmap_mode="r")


def shipped_softmax_predict_fn(spark: SparkSession, weights, bias) -> Callable:
    """:func:`softmax_predict_fn` whose tasks carry two file names, whatever the layer's size."""
    import numpy as np

    w = ship_array(spark, np.asarray(weights, dtype=np.float64), "weights")
    b = ship_array(spark, np.asarray(bias, dtype=np.float64), "bias")

    def make():
        return _softmax_layer(open_array(w), open_array(b))
    return make


def identity_predict_fn() -> Callable:
    """A ``make_predict_fn`` whose scores are the input vector itself."""
    def make():
        import numpy as np

        def run(x):
            return np.asarray(x, dtype=np.float64)
        return run
    return make
