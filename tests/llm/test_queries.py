"""Registered queries: contract columns, and equality with their SQL over whole tables."""

import zlib
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from platewise.llm import queries

from .test_pii import brute_base
from .test_pii_groups import brute as pii_brute

SF = "/root/testdata/sf0.001"
COLUMNS = {
    1: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    2: "doc_id n_shingles component_id kept", 3: "doc_id held_out score predicted", 4: "vec_id n_links component_id kept",
    5: "doc_id piece start length ids_crc32 sequence_id offset", 6: "doc_id size text_crc32 law shard slot grown_shard",
    7: "doc_id n_words n_removed kept_sha256", 8: "conv_id perspective part n_turns n_own text mask",
    9: "doc_id n_email n_ip n_card n_phone base_sha256 spans", 10: "doc_id n_tokens ids_sha256 decoded_sha256",
    11: "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256", 12: "item_id rank doc_id score",
    13: "doc_id size source_size target taken",
}
BY_NUMBER = {int(k[2:].split("_")[0]): k for k in queries.QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "labels", "embeddings", "conversations", "benchmark"):
        c.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return c


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.sql("SELECT doc_id, text FROM documents").fetchall())


def result(spark, n):
    return queries.QUERIES[BY_NUMBER[n]](spark, SF)


def test_registered():
    assert sorted(BY_NUMBER) == list(range(1, 14)) and set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_equals_sql(spark, con, key):
    df = queries.QUERIES[key](spark, SF)
    want = con.sql(entry.oracle_sql()[key])
    assert sorted(df.columns) == sorted(want.columns)
    assert set(COLUMNS[int(key[2:].split("_")[0])].split()) <= set(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_op3(spark, texts):
    rows = result(spark, 3).collect()
    assert set(rows[0].asDict()) >= set(COLUMNS[3].split()) and sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


def test_op5_and_op10(spark, texts):
    import hashlib

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in texts.items()}
    for r in result(spark, 10).collect():
        assert r.n_tokens == len(ids[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids[r.doc_id])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    pieces, fill = result(spark, 5).collect(), defaultdict(list)
    assert set(pieces[0].asDict()) >= set(COLUMNS[5].split())
    assert Counter(r.doc_id for r in pieces) == {i: max(1, -(-(len(x) + 1) // 1024)) for i, x in ids.items()}
    for r in pieces:
        own = [*ids[r.doc_id], 2][r.start:r.start + r.length]
        assert len(own) == r.length and zlib.crc32(b"".join(t.to_bytes(4, "little") for t in own)) == r.ids_crc32
        fill[r.sequence_id].append((r.offset, r.length))
    for own in fill.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(own), [*sorted(own)[1:], (sum(n for _, n in own), 0)]))
    total = sum(r.length for r in pieces)
    assert len(fill) <= -(-total // 1024) + 1


def test_op6(spark, texts):
    rows = result(spark, 6).collect()
    assert list(rows[0].asDict()) == COLUMNS[6].split() and {r.law for r in rows} == {"bytes"}
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    assert set(sizes) == set(range(24)) and sorted(r.doc_id for r in rows) == sorted(texts)


def test_op9(spark, texts):
    import hashlib

    want, kinds = pii_brute(list(texts.items())), ("email", "ip", "card", "phone", "context")
    show = lambda spans: ",".join(f"{kinds[k]}:{a}:{b}" for a, b, k in spans)
    for r in result(spark, 9).collect():
        base = brute_base(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in base) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(show(base).encode()).hexdigest() and r.spans == show(want[r.doc_id])


def test_op11(spark, texts):
    import sentencepiece

    from .test_alignment import A, B, as_rows, brute

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    rows = result(spark, 11)
    assert list(rows.columns) == COLUMNS[11].split()
    want, _ = brute((a, sentencepiece.SentencePieceProcessor(model_file=B)), list(texts.values()))
    assert as_rows(rows) == dict(zip(texts, want))
