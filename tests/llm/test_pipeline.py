import re
import zlib
from collections import defaultdict

import corpus_pipeline as pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .test_minhash import brute as near_brute
from .test_pii_groups import brute as pii_brute
from .test_substrings import brute as repeat_brute

SF = "/root/testdata/sf0.001"
KINDS = ("EMAIL", "IP", "CARD", "PHONE", "CONTEXT")


def rows(df):
    return sorted(tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect())


def masked(text, spans):
    out, at = "", 0
    for a, b, k in spans:
        if a >= at:
            out += text[at:a] + f"<{KINDS[k]}>"
        at = max(at, b)
    return out + text[at:]


@pytest.fixture(scope="module")
def inputs(spark):
    """Outputs of all stages on the smallest table, each stored."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        out[name] = docs
        docs = pipeline.stored(stage(spark, docs, SF), "test")
    out["end"] = docs
    return out


def test_stages_equal_brute_force(spark, inputs):
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["quality classifier", "near dedup", "substring dedup", "pii", "packing"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(inputs[n].columns == columns for n in names)
    first, scored = rows(inputs[names[0]]), rows(inputs[names[1]])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert set(scored) < set(first)
    gone = {r[0] for r in first} - {r[0] for r in scored}
    assert all(labels.get(i) != 1 for i in gone) and sum(labels.get(r[0]) == 0 for r in scored) <= 2

    _, root, _ = near_brute([r[:2] for r in scored], 5, 80)
    unique = rows(inputs[names[2]])
    assert unique == [r for r in scored if root[r[0]] == r[0]]

    cut = repeat_brute([r[:2] for r in unique], 50)
    want = []
    for i, text, lang, source, n in unique:
        words, out = cut[i]
        text = " ".join(w for w, g in zip(words, out) if not g) if any(out) else text
        want.append((i, text, lang, source, len(text)))
    assert rows(inputs[names[3]]) == want

    spans = pii_brute([r[:2] for r in want])
    want = [(i, masked(t, spans[i]), lang, source, len(masked(t, spans[i]))) for i, t, lang, source, _ in want]
    assert rows(inputs[names[4]]) == want

    library, ids = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), defaultdict(list)
    got = inputs["end"].collect()
    for r in sorted(got, key=lambda r: (r.doc_id, r.piece)):
        ids[r.doc_id].append(r)
    assert sorted(ids) == [w[0] for w in want]
    for i, text, *_ in want:
        tokens = [*library.encode(text, add_special_tokens=False).ids, 2]
        for p in ids[i]:
            own = tokens[p.start:p.start + p.length]
            assert zlib.crc32(b"".join(t.to_bytes(4, "little") for t in own)) == p.ids_crc32
        assert sum(p.length for p in ids[i]) == len(tokens)


def test_run_gives_the_same_rows(spark, inputs):
    before = pipeline.stored_so_far()
    got = pipeline.run(spark, SF).drop("sequence_id", "offset")
    assert pipeline.stored_so_far() == before + 1  # only the result is left
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, inputs["end"].drop("sequence_id", "offset").collect()))


def test_stages_on_hard_and_empty_tables(spark, docs, docs_rows):
    repeated = docs.unionByName(docs.where("doc_id < 9"))
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, repeated, SF)
        assert out.columns == docs.columns and out.count() <= len(docs_rows) + 9
        if name in ("substring dedup", "pii"):
            assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in repeated.collect())
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert not re.search("localCheckpoint", open(pipeline.__file__).read())
    assert pipeline.pack(spark, docs.limit(0).withColumn("x", F.lit(1)), SF).count() == 0
