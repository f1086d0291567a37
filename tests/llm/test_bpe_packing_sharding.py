import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from platewise.llm import bpe, packing, sharding

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_library_on_random_texts(library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 300)
    table, rng = bpe.merge_table(PATH), random.Random(5)
    for k in range(200):
        alphabet = rng.choice(["ab", "abcdefgh -", "DRAGON", "a", "é中\U0001f642 a", "=-", "0123 ",
                               "\n\t \x1c a", "'stdrelvm xX\n"])
        text = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 2, 5, 50, 3000, 9000])))
        text += "<|endoftext|>" + text if k % 10 == 0 else ""
        got = table.encode_batch(["x ", text, "", "y"])[1].tolist()
        assert got == ids_of(library, text)
        assert table.decoder()(got, True) == text


def test_lookahead_is_sufficient(library):
    """Tokens that end ``lookahead`` bytes before the end don't depend on what follows."""
    table, rng = bpe.merge_table(PATH), random.Random(3)
    for _ in range(30):
        data = "".join(rng.choice("aehinorst") for _ in range(3000)).encode()
        short, whole = table.merge(data[:2000]), table.merge(data)
        end = 0
        for a, b in zip(short, whole):
            end += int(table.byte_len[a])
            if end > 2000 - table.lookahead:
                break
            assert a == b


def test_decoder_keeps_partial_characters():
    table = bpe.merge_table(PATH)
    ids = table.encode_batch(["\U0001f642中"])[0].tolist()
    feed = table.decoder()
    assert "".join([*(feed([i]) for i in ids), feed((), True)]) == "\U0001f642中"
    assert table.decoder()([int(table.byte_ids[0xF0]), 10**6], True) == "�"


def test_round_trip_frame(spark, docs, docs_rows, library):
    out = bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH).collect()
    texts = dict(docs_rows)
    assert len(out) == len(docs_rows)
    for r in out:
        assert r.ids == ids_of(library, texts[r.doc_id]) and r.decoded == (texts[r.doc_id] or "")
    assert bpe.decode_documents(bpe.encode_documents(docs.limit(0), PATH), PATH).count() == 0


def test_packing(spark, docs, docs_rows, library):
    out = packing.pack_documents(docs.unionByName(docs.where("doc_id < 20").withColumn("doc_id", F.col("doc_id") + 10**7)), PATH,
                                 capacity=1024, keep_ids=True).collect()
    texts, by_doc, by_seq = dict(docs_rows), defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        assert zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r.ids)) == r.ids_crc32
    for doc, text in texts.items():
        pieces = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [i for p in pieces for i in p.ids] == [*ids_of(library, text), 2]
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:i]) for i in range(len(pieces))]
        assert all(p.length == 1024 for p in pieces[1:])
    total = 0
    for pieces in by_seq.values():
        end = 0
        for p in sorted(pieces, key=lambda r: r.offset):
            assert p.offset == end
            end += p.length
        assert end <= 1024
        total += end
    assert len(by_seq) <= -(-total // 1024) * 1.05 + 1


def best(sizes, capacity):
    """Fewest sequences, by trying everything."""
    sizes, found = sorted(sizes, reverse=True), [len(sizes)]

    def go(i, bins):
        if len(bins) >= found[0]:
            return
        if i == len(sizes):
            found[0] = len(bins)
            return
        for j in {b: j for j, b in enumerate(bins)}.values():
            if bins[j] + sizes[i] <= capacity:
                go(i + 1, [*bins[:j], bins[j] + sizes[i], *bins[j + 1:]])
        go(i + 1, [*bins, sizes[i]])

    go(0, [])
    return found[0]


def places(rows):
    seqs, numbers = defaultdict(list), defaultdict(list)
    for n, first, count, seq, k, at in rows:
        for i in range(count):
            seqs[seq + i // k].append((at + n * (i % k), n))
            numbers[n].append(first + i)
    return seqs, numbers


def test_plan_places_all_and_reduction_loses_nothing(monkeypatch):
    rng = random.Random(1)
    for trial in range(300):
        capacity = rng.choice([10, 20, 50])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 11))]
        seqs, numbers = places(packing.plan(Counter(sizes), capacity))
        assert {n: sorted(x) for n, x in numbers.items()} == {n: list(range(c)) for n, c in Counter(sizes).items()}
        for items in seqs.values():
            end = 0
            for at, n in sorted(items):
                assert at == end
                end += n
            assert end <= capacity
        assert len(seqs) <= best(sizes, capacity) + 1
        # one fixed set leaves an instance that needs exactly one sequence less
        left = Counter(sizes)
        for x in sorted(left, reverse=True):
            if got := packing._dominating(dict(left), x, capacity - x):
                rest = list((left - Counter(got)).elements())
                assert best(rest, capacity) == best(sizes, capacity) - 1, (sizes, got)
                break


def test_packing_empty(spark, docs):
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0


def test_differencing_known_case():
    """8 7 6 5 4 in two parts: the rule gives 16 and 14."""
    out = sharding.differencing([[(s, s)] for s in (8, 7, 6, 5, 4)], 2)
    assert sorted(t for t, _ in out) == [14, 16]
    assert sorted(x for _, labels in out for x in labels) == [4, 5, 6, 7, 8]
    assert sharding.differencing([], 3) == []


def plain_differencing(sizes, shards):
    """Sums of the parts, by the rule itself: join the two partial partitions of largest spread, oppositely ordered."""
    parts = [([0] * (shards - 1) + [s], i) for i, s in enumerate(sizes)]
    while len(parts) > 1:
        parts.sort(key=lambda p: (p[0][0] - p[0][-1], p[1]))
        (a, i), (b, _) = parts[:2]
        made = sorted(x + y for x, y in zip(a, reversed(b)))
        parts = [(made, i)] + parts[2:]
    return parts[0][0] if parts else [0] * shards


def test_one_cell_equals_plain_differencing(spark):
    rng = random.Random(7)
    for shards in (2, 3, 24):
        sizes = rng.sample(range(1, 100_000), 300)
        rows = [(i, s) for i, s in enumerate(sizes)]
        got = Counter()
        for r in sharding.balance(spark.createDataFrame(rows, "key long, size long"), shards).collect():
            got[r.shard] += sizes[r.key]
        assert sorted(got.values()) == plain_differencing(sorted(sizes), shards)


def test_sharding(spark, docs, docs_rows):
    out = sharding.shard_documents(docs, shards=6).collect()
    texts, shard_of, sizes, slots = dict(docs_rows), defaultdict(set), Counter(), defaultdict(list)
    assert len(out) == len(docs_rows)
    for r in out:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))
        shard_of[data].add(r.shard)
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in shard_of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) < 0.01 * sum(sizes.values())
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def test_balance_in_several_levels(spark):
    rng = random.Random(2)
    rows = [(i, rng.randint(1, 1000)) for i in range(500)] + [(1000, 30_000)]
    got = sharding.balance(spark.createDataFrame(rows, "key long, size long"), 5, groups_per_cell=20, fan_in=4).collect()
    assert sorted(r.key for r in got) == sorted(k for k, _ in rows)
    sums, size = Counter(), dict(rows)
    for r in got:
        sums[r.shard] += size[r.key]
    assert max(sums.values()) - min(sums.values()) <= 1000
