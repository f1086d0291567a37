import re

import numpy as np
import pyarrow as pa
import public_tokenizers

from platewise.llm import packing, quality_model, substrings
from platewise.llm.common import small_batches

from .conftest import SF_SMALL


def own_mb():
    return int(re.search(r"RssAnon:\s+(\d+)", open("/proc/self/status").read())[1]) / 1024


def test_a_batch_leaves_no_memory_behind():
    pinned, full = [], 0
    for _ in small_batches(iter([pa.record_batch({"id": [1]})])):
        before = own_mb()
        parts = [np.ones(8000) for _ in range(2000)]  # 128 MB in arrays too small for a mapping of their own
        pinned.append(np.ones(8000))  # at the end of the heap, so what is freed below stays with the process
        full = own_mb() - before
        del parts
    assert full > 100
    assert own_mb() - before < 40


class Dealt:
    """Takes the functions that the operator hands to Spark."""

    def mapInArrow(self, run, shape):
        self.deal = run
        return self

    def groupBy(self, key):
        return self

    def applyInArrow(self, run, shape):
        self.meet = run
        return self


def test_texts_are_read_in_small_parts_and_dealt_together():
    text = [" ".join(f"w{(i * 7 + k) % 50}" for k in range(400)) for i in range(2000)]
    batch, sizes = pa.record_batch({"id": pa.array(range(2000), pa.int64()), "text": text}), []

    def items(b):
        sizes.append(b.nbytes)
        place = np.tile(np.arange(3), b.num_rows)
        row = np.repeat(np.arange(b.num_rows), 3)
        mark = (np.array(b.column(0).to_pylist(), np.uint64)[row] % np.uint64(700) << np.uint64(20)) + place.astype(np.uint64)
        return mark << np.uint64(16), None, row, place, place > 0

    dealt = Dealt()
    substrings._met_twice(dealt, "bigint", items, 5, False)
    out = list(dealt.deal(iter([batch])))
    assert len(out) <= 3 and max(sizes) <= 1 << 18  # dealt by 2 MB, read by 256 KB
    table, found = pa.Table.from_batches(out), []
    for c in range(5):
        one = dealt.meet(table.filter(pa.compute.equal(table["cell"], c)))
        found += zip(one["id"].to_pylist(), one["at"].to_pylist())
    assert sorted(found) == [(i, p) for i in range(2000) for p in (1, 2)]  # each mark has two rows or more


def test_no_list_passes_through_python_workers(spark, monkeypatch):
    """A second set of Python workers would stay beside those of the operators."""
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    packed = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    assert "ExistingRDD" not in plan(packed)
    plans, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda self: plans.append(plan(self)) or collect(self))
    labels = docs.selectExpr("doc_id", "doc_id % 2 AS quality")
    quality_model.train(docs, labels)
    assert "MapInArrow" in plans[-1] and "ExistingRDD" not in plans[-1]
