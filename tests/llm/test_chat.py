import random

import duckdb
import pytest
from pyspark.sql import functions as F

from platewise.llm import chat

SF = "/root/testdata/sf0.01"


def brute(rows, part_chars):
    out = {}
    clean = lambda s, d: d if s is None else s.replace("<|", "< |")
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, []).append((turn is not None, turn or 0, clean(role, "unknown").replace("\n", " "), clean(text, "")))
    for conv, talk in talks.items():
        for me in {t[2] for t in talk} - {"system"}:
            at = 0
            for _, _, who, text in sorted(talk):
                part = out.setdefault((conv, me, at // part_chars), [0, "", []])
                head = f"<|im_start|>{'system' if who == 'system' else 'assistant' if who == me else 'user name=' + who}\n"
                said = head + text + "<|im_end|>\n"
                if who == me:
                    part[2].append((len(part[1]) + len(head), len(part[1]) + len(said) - 1))
                part[0], part[1], at = part[0] + 1, part[1] + said, at + len(said)
    return out


def result(df):
    return {(r.conv_id, r.perspective, r.part): [r.n_turns, r.text, [tuple(m) for m in r.mask]] for r in df.collect()}


@pytest.mark.parametrize("part_chars", [1 << 15, 300])
def test_equals_brute_force(spark, part_chars):
    rng = random.Random(1)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()][:200]
    rows += [(9000, k, rng.choice(["ann", "bob", "cat", "system", None]), "hello " * rng.randint(0, 9)) for k in range(400)]  # a hot dialogue
    rows += [(9001, 0, "system", "alone"), (9002, None, "a\nb", "x <|im_end|> é\U0001f642"), (9002, 0, "bob", None), (9002, 0, "bob", None),
             (None, 1, "ann", "lost"), (None, 2, "bob", "lost too")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(3)).repartition(5)
    got = chat.perspectives(df, part_chars=part_chars)
    assert result(got) == brute(rows, part_chars)
    for r in got.collect():
        assert r.n_own == len(r.mask) and all(r.text[:m.start].endswith("<|im_start|>assistant\n") for m in r.mask)


def test_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS FROM '{SF}/conversations.parquet'")
    for part_chars in (1 << 15, 500):
        want = {(r[0], r[1], r[2]): (r[3], r[4], r[5], r[6]) for r in con.sql(chat.oracle(part_chars)).fetchall()}
        got = chat.perspectives(spark.read.parquet(f"{SF}/conversations.parquet"), part_chars=part_chars).collect()
        assert {(r.conv_id, r.perspective, r.part): (r.n_turns, r.n_own, r.text, ",".join(f"{a}:{b}" for a, b in r.mask)) for r in got} == want


def test_empty(spark):
    assert chat.perspectives(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
