import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from platewise.llm import substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """{id: (words, removed mask)} by counting every window of every row."""
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    count = Counter(tuple(w[p:p + window]) for _, w in words for p in range(len(w) - window + 1))
    out = {}
    for i, w in words:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if count[tuple(w[p:p + window])] > 1:
                gone[p:p + window] = [True] * window
        out[i] = (w, gone)
    return out


def passages(rng, rows):
    """Texts with shared passages at odd places, repeats inside a text, and edges of the window length."""
    pool = " ".join(t for _, t in rows if t).split()
    shared = [[rng.choice(pool) for _ in range(n)] for n in (34, 35, 36, 53, 80, 200)]
    out = []
    for i in range(60):
        text = []
        for _ in range(rng.randint(1, 4)):
            text += [rng.choice(pool) for _ in range(rng.randint(0, 60))]
            p = rng.choice(shared)
            text += p[rng.randint(0, 3):] if rng.random() < 0.3 else p
        out.append((2 * 10**6 + i, " ".join(text)))
    return out + [(3 * 10**6, " ".join(shared[5] + ["x"] + shared[5])), (3 * 10**6 + 1, " ".join(["same"] * 36)),
                  (3 * 10**6 + 2, " ".join(["once"] * 35)), (3 * 10**6 + 3, "z " + " ".join(shared[1]))]


@pytest.mark.parametrize("window", [35, 4])
def test_equals_brute_force(spark, docs_rows, window, monkeypatch):
    monkeypatch.setattr(substrings, "CELL_BYTES", 50_000)
    rows = docs_rows + passages(random.Random(8), docs_rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(1)).repartition(6)
    want = brute(rows, window)
    got = substrings.remove_repeats(df, window=window).collect()
    assert sorted(r.doc_id for r in got) == sorted(want)
    for r in got:
        w, gone = want[r.doc_id]
        assert r.kept == " ".join(x for x, g in zip(w, gone) if not g), r.doc_id
        assert (r.n_words, r.n_removed) == (len(w), sum(gone))
        assert {p for s in r.removed for p in range(s.start, s.end)} == {p for p, g in enumerate(gone) if g}


def test_repeated_rows_nulls_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, text), (2, None), (None, "a b"), (None, "a b"), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(df, window=35).collect())
    assert got == [(0, 2, 0, "a b"), (0, 2, 0, "a b"), (1, 40, 40, ""), (1, 40, 40, ""), (2, 0, 0, ""), (3, 0, 0, "")]
    assert substrings.remove_repeats(df.limit(0)).count() == 0
