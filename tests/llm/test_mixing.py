import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from platewise.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, weights=(5, 2, 1), times=3, seed=1):
    """[(id, size, source size, target, copies)], sharing round by round."""
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    own = Counter()
    for (_, _, s), n in zip(rows, size):
        own[s] += n
    order = sorted((s for s in own if s is not None), key=lambda s: s.encode()) + [None] * (None in own)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    stopped = set()
    while True:
        left = sum(own.values()) - sum(times * own[s] for s in stopped)
        rest = sum(weight[s] for s in own if s not in stopped)
        more = {s for s in own if s not in stopped and times * own[s] * rest <= weight[s] * left}
        if not more:
            break
        stopped |= more
    out = []
    for (i, t, s), n in zip(rows, size):
        target = float(times * own[s]) if s in stopped else weight[s] * left / rest
        rate = target / own[s] if own[s] else 0.0
        inner = hashlib.md5((t or "").encode()).hexdigest()
        u = int(hashlib.md5(f"{seed}:{'' if i is None else i}:{inner}".encode()).hexdigest()[:13], 16) / 2**52
        out.append((i, n, own[s], target, math.floor(rate) + (u < rate - math.floor(rate))))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("x")).withColumn("_source", F.lit(1))


def sample(rng, sources):
    return [(i, rng.choice([None, "", " \n"]) if rng.random() < 0.05 else "w " * int(rng.expovariate(1 / 50)), rng.choice(sources)) for i in range(3000)]


def test_equals_brute_force(spark, docs_rows):
    rng = random.Random(1)
    names = ["b", "a", None, "é", "Z", "\U0001f642", "￿", "big", "big", "big", "big", "big", "big"]
    rows = sample(rng, names) + [(i, t, "hard") for i, t in docs_rows] + [(None, "x y", "a"), (None, "x z", "a"), (1, "w", "b"), (1, "w", "b"), (9, "", "none")]
    for weights, times in (((5, 2, 1), 3), ((1,), 2), ((1, 100), 1)):
        got = mixing.mix(frame(spark, rows).repartition(5), weights, times).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(rows, weights, times)))
        assert all(r.copies <= times for r in got)


def test_taken_words_come_near_their_targets(spark):
    rows = sample(random.Random(2), ["a", "b", "c", "d", *["e"] * 8])
    source = {i: s for i, _, s in rows}
    taken, want, spread = Counter(), {}, Counter()
    for r in mixing.mix(frame(spark, rows)).collect():
        s, rate = source[r.doc_id], r.target / r.source_size
        taken[s] += r.size * r.copies
        want[s] = r.target
        spread[s] += r.size**2 * (rate % 1) * (1 - rate % 1)
    assert abs(sum(want.values()) - sum(len((t or "").split()) for _, t, _ in rows)) < 1e-6
    assert all(abs(taken[s] - want[s]) <= 4 * math.sqrt(spread[s]) for s in want) and len(want) == 5


def test_emitted_copies(spark):
    rows = sample(random.Random(3), ["a", "b", "c"]) + [(7, None, None)]
    df = frame(spark, rows)
    copies, seen = {r.doc_id: r.copies for r in mixing.mix(df).where("doc_id <> 7").collect()}, defaultdict(list)
    out = mixing.emit(df)
    assert out.columns == ["doc_id", "text", "source", "size", "_source", "copy"]
    for r in out.where("doc_id <> 7").collect():
        seen[r.doc_id].append(r.copy)
        assert (r.size, r._source) == ("x", 1)
    assert {i: len(v) for i, v in seen.items()} == {i: n for i, n in copies.items() if n}
    assert all(sorted(v) == list(range(len(v))) for v in seen.values())


def test_empty_wordless_and_beyond_the_broadcast(spark, monkeypatch):
    assert mixing.mix(frame(spark, []).limit(0)).count() == 0 and mixing.emit(frame(spark, []).limit(0)).count() == 0
    rows = [(1, None, "a"), (2, "", None)]
    assert sorted(map(tuple, mixing.mix(frame(spark, rows)).collect())) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    rows = sample(random.Random(4), ["a", "b", None])
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", 0)
    got = mixing.mix(frame(spark, rows))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute(rows)))
