import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from platewise.llm import alignment

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
HARD = ["<|endoftext|> <s>a</s> <0x0A> <unk>", "a  b   c \n\n  d \n", " lead", "tail ", "   ", "\n", "\n\nx", "▁a", "a▁ b", "é中\U0001f642ﬁ　x y",
        "nul\x00byte\x01 \x7f\x80", "word" * 3000, "a" * 70 + " " + "b" * 70 + "\n" + "c" * 70, "x\r\ny\tz", "\U0010ffff﻿q", "١٢٣ 45", "it's 'll"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(libraries, text):
    """[(id, bytes)] of both tokenizers; none where either doesn't spell space + text."""
    a, b = libraries
    if not text:
        return [], []
    plain = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c <= 255]
    rest = [c for c in range(256) if c not in plain]
    alphabet = {chr(c): c for c in plain} | {chr(256 + i): c for i, c in enumerate(rest)}
    one = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    two = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    want = (" " + text).encode()
    return (one, two) if b"".join(x for _, x in one) == want == b"".join(x for _, x in two) else ([], [])


def brute(libraries, texts):
    """Per text [n_a, n_b, n_groups, n_links, n_best, count_sum, sha], and the pairs' (documents, links)."""
    links, shown, held = [], [], Counter()
    for t in texts:
        one, two = tokens(libraries, t)
        ends_a, ends_b = (np.cumsum([len(x) for _, x in own]).tolist() for own in (one, two))
        common = sorted(set(ends_a) & set(ends_b))
        own, groups, at = [], [], 0
        for c in common:
            left = [i for (i, _), e in zip(one, ends_a) if at < e <= c]
            right = [i for (i, _), e in zip(two, ends_b) if at < e <= c]
            groups.append(f"{','.join(map(str, left))}|{','.join(map(str, right))}")
            own.append((left[-1], right[-1]))
            at = c
        held.update(set(own))
        links.append(own)
        shown.append([len(one), len(two), len(groups), ";".join(groups)])
    count = Counter(p for own in links for p in own)
    top = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return [(a, b, g, len(own), sum(count[p] == top[p[1]] for p in own), sum(count[p] for p in own), hashlib.sha256(s.encode()).hexdigest() if s else "")
            for (a, b, g, s), own in zip(shown, links)], {p: (held[p], n) for p, n in count.items()}


def as_rows(df):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()}


def test_pieces_equal_library(libraries):
    model, rng = alignment.PieceModel(B), random.Random(2)
    texts = HARD + ["".join(rng.choice(rng.choice(["ab \n", "the and ing ", "é中\U0001f642 x", "  \n\t", "Z9_-"])) for _ in range(rng.choice([1, 5, 300, 5000])))
                    for _ in range(300)]
    texts = [t for t in texts if "▁" not in t]
    raw = [(" " + t).encode() for t in texts]
    for _ in range(2):  # the second time from remembered pieces
        ids, n = model.encode_batch(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw]))
        for t, own in zip(texts, np.split(ids, np.cumsum(n)[:-1])):
            assert own.tolist() == libraries[1].encode(t), t[:80]


@pytest.mark.parametrize("postings,dense", [(1 << 20, True), (300, False)])
def test_equals_brute_force(spark, docs_rows, libraries, monkeypatch, postings, dense):
    monkeypatch.setattr(alignment, "CHUNK_POSTINGS", postings)
    monkeypatch.setattr(alignment, "CHUNK_DOCS", 1 << 16 if dense else 40)
    same = ["the same words the same words"] * 50
    texts = [t for _, t in docs_rows] + HARD + same
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df = df.withColumn("pair", F.lit("x")).withColumn("chunk", F.lit(1)).repartition(3)
    index = alignment.index_documents(df, A, B)
    scores = alignment.pair_scores(index)
    want, pairs = brute(libraries, texts)
    assert {(r.a, r.b): (r.docs, r.links) for r in scores.collect()} == pairs
    got = as_rows(alignment.document_scores(index, scores).withColumnRenamed("id", "doc_id"))
    assert got == dict(enumerate(want))
    assert sum(not w[0] for w in want) >= 4 and index.where("dense").count() > 0


def test_planes_hold_multiplicities():
    rng = np.random.default_rng(0)
    key = np.unique(rng.integers(0, 50 * 3000, 20_000))
    pair, doc, times = key // 3000, key % 3000, rng.geometric(0.2, len(key))
    b = alignment._planes(pair, doc, times, 3000)
    back, docs, links = Counter(), Counter(), Counter()
    for r in b.to_pylist():
        for d in alignment._members(r["dense"], r["bits"], 3000):
            back[r["pair"], int(d)] += 1 << r["plane"]
        docs[r["pair"]] += r["docs"]
        links[r["pair"]] += r["links"]
    assert back == {(int(p), int(d)): int(t) for p, d, t in zip(pair, doc, times)}
    assert docs == Counter(pair.tolist()) and all(links[p] == times[pair == p].sum() for p in set(pair.tolist()))
    assert {r["dense"] for r in b.to_pylist()} == {True, False}


def test_nulls_repeats_and_empty(spark, libraries):
    rows = [(None, "a b"), (None, "a b"), (1, "a b"), (1, "a b c"), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, _ = brute(libraries, [t for _, t in rows])
    got = alignment.align_documents(df, A, B)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr((i, *w)) for (i, _), w in zip(rows, want))
    assert alignment.align_documents(df.limit(0), A, B).count() == 0
    assert [r[1:7] for r in map(tuple, alignment.align_documents(df.where("doc_id > 1"), A, B).collect())] == [(0,) * 6] * 2
