"""No result hangs on words that a weak fingerprint takes for equal: complementary Thue-Morse
strings, which collide under any polynomial with an odd base modulo a power of two."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from platewise.llm import bpe, minhash, packing, quality_model, substrings, text_arrays

from .test_minhash import brute as near_brute
from .test_substrings import brute as repeat_brute

PATH = public_tokenizers.path("byte_bpe_50k.json")


def thue_morse(n):
    t = "a"
    while len(t) < n:
        t += t.translate({97: 98, 98: 97})
    return t, t.translate({97: 98, 98: 97})


def rows():
    out = []
    for n in (16, 32, 64, 1024, 2048):
        t, c = thue_morse(n)
        tail = " ".join(f"w{n}x{i}" for i in range(60))
        out += [t, c, f"{t} {tail}", f"{c} {tail[:-1]}z", f"{c} {' '.join(tail.split()[:34])}", f"{t} {' '.join(tail.split()[:34])}"]
    x, y = thue_morse(64)
    out += [" ".join(x), " ".join(y)]  # the same patterns as words
    return list(enumerate(out))


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(rows(), "doc_id long, text string").repartition(3)


def test_marks_differ():
    for n in (8, 16, 64, 72, 1024, 2048):
        for seed in (1, 2):
            w = text_arrays.Words(list(thue_morse(n)), seed=seed)
            assert w.mark[0] != w.mark[1]
    x, y = (text_arrays.Words([" ".join(t)]) for t in thue_morse(2048))
    for size in (3, 35, 64, 1024, 2048):
        assert x.windows(size)[0][0] != y.windows(size)[0][0]


def test_marks_follow_the_bytes():
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("ab"), n)) for n in rng.integers(1, 100, 2000)]
    w = text_arrays.Words([" ".join(words), "x " + " ".join(words)])
    assert len(set(w.mark[:2000].tolist())) == len(set(words))
    assert (w.mark[:2000] == w.mark[2001:]).all()
    for size in (1, 2, 3, 5, 7, 18, 35):
        mark, at = w.windows(size)
        assert (mark[:at[1]] == mark[at[1] + 1:]).all() and len(set(mark[:at[1]].tolist())) == len(
            {tuple(words[i:i + size]) for i in range(2000 - size + 1)})
    data, eq = w.data, text_arrays.same_bytes
    same = eq(data, w.start[:2000], data, w.start[2001:], (w.end - w.start)[:2000])
    assert same.all() and not eq(data, w.start[:1], np.frombuffer(b"c" * 100, np.uint8), np.zeros(1, np.int64), (w.end - w.start)[:1]).any()


def test_encoder_tells_them_apart(spark, frame, monkeypatch):
    library = Tokenizer.from_file(PATH)
    texts = [t for _, t in rows()]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    table = bpe.merge_table(PATH)
    assert [x.tolist() for x in table.encode_batch(texts)] == want
    got = {r.doc_id: r.decoded for r in bpe.decode_documents(bpe.encode_documents(frame, PATH), PATH).collect()}
    assert got == dict(rows())
    for r in packing.pack_documents(frame, PATH, keep_ids=True).collect():
        assert r.ids == [*want[r.doc_id], 2][r.start:r.start + r.length]
    # equal fingerprints don't matter, since the bytes are compared
    monkeypatch.setattr(bpe, "byte_marks", lambda data, at, length: np.zeros(len(at), np.uint64))
    weak = bpe.MergeTable(PATH)
    for _ in range(2):
        assert [x.tolist() for x in weak.encode_batch(texts)] == want


def test_near_duplicates(frame):
    for k, percent in ((3, 85), (5, 80)):
        size, root, _ = near_brute(rows(), k, percent)
        for r in minhash.near_duplicates(frame, k=k, percent=percent).collect():
            assert (r.n_shingles, r.component_id) == (size[r.doc_id], root[r.doc_id]), r.doc_id


def test_substrings(frame):
    want = repeat_brute(rows(), 35)
    for r in substrings.remove_repeats(frame, window=35).collect():
        words, gone = want[r.doc_id]
        assert r.kept == " ".join(w for w, g in zip(words, gone) if not g)


def test_repeated_lines():
    t, c = thue_morse(1024)
    x = quality_model.features([f"{t}\n{c}\n", f"{t}\n{t}\n"])[:, quality_model.FEATURES.index("repeated_lines")]
    assert x.tolist() == [0, 0.5]
