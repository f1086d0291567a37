"""Near-duplicate documents: one-permutation MinHash, densified, banded, verified.

A document's set holds its distinct ``k``-word shingles.  One hash per shingle
deals them to bins; a bin's smallest hash is its value, and an empty bin takes
the value of the first non-empty bin on its own random probe sequence (optimal
densification), so bins match with the sets' similarity.  ``bands`` bands of
``rows`` bins make bucket keys.  At the threshold a pair misses all of them with
probability (1 - 0.85**5)**32 < 1e-8.

Documents with equal sets form a class, and only its smallest id takes part; a
class is told by 128 bits of two keyed fingerprints per shingle.  A compared pair
counts shared 64-bit fingerprints, of which a false one among s and t shingles has
probability s * t / 2**64 (5e-12 for sets of 10,000), and only at the threshold
could it decide a link.  In
each bucket a star joins the smallest id to the others, so candidates grow with
the bucket's size, not its square; all are verified on full sets, and verified
links give components.  A bucket whose members are still in several components
gets a second star around its heart, the document with the smallest share of
shingles of its own; what is still apart after that has every document outside
its bucket's largest component compared with those of other components.  So each
pair that shares a bucket is verified, connected already, or ruled out by a bound:
with t shingles shared with the heart and c with any document at all, a pair
shares at most min(t1, t2) + min(c1 - t1, c2 - t2).  No link is lost to the
stars, nothing is capped.

Defined cases: an id stands for one text (its rows may repeat); fewer than ``k`` words make one shingle of all words; a text that
is NULL or has no word has an empty set and is linked with nothing; so is a NULL
id; equal rows are kept; an empty table gives no rows; only named columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import broadcast_ids, components, small_batches, stored
from platewise.llm.text_arrays import _LOWER, Words, mix


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Sorted distinct shingle fingerprints of each text (A-Z in lower case)."""
    return [s for s, _ in _sets(texts, k, None)]


def _sets(texts: list[str | None], k: int, second: int | None):
    """(sorted distinct fingerprints, those of another key in the same order) of each text."""
    words = Words(texts, lower=True)
    mark, offset = words.windows(k)
    other = mark if second is None else words.windows(k, second)[0]
    for i, n in enumerate(np.diff(words.at)):
        if n >= k:
            own, at = np.unique(mark[offset[i]:offset[i + 1]], return_index=True)
            yield own, other[offset[i]:offset[i + 1]][at]
        elif n:  # shorter than a window: all words as one shingle, apart from longer ones
            whole = words.text(i, np.ones(n, bool)).translate(_LOWER.tobytes())
            both = np.frombuffer(hashlib.blake2b(whole, digest_size=16, key=b"short").digest(), np.uint64)
            yield both[:1], both[1:]
        else:
            yield np.zeros(0, np.uint64), np.zeros(0, np.uint64)


def signatures(sets: list[np.ndarray], bins: int, probes: int = 4096) -> np.ndarray:
    """(documents, bins) densified one-permutation MinHash; sets must not be empty."""
    n = len(sets)
    flat = np.concatenate(sets)
    doc = np.repeat(np.arange(n), [len(s) for s in sets])
    # bins are ranges of the hash, so in a sorted set the first of a bin is its smallest
    at = doc * bins + ((flat >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    head = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    full = np.zeros(n * bins, bool)
    value = np.zeros(n * bins, np.uint64)
    full[at[head]], value[at[head]] = True, flat[head]
    todo = np.flatnonzero(~full)
    row, col = todo // bins, todo % bins
    for t in range(1, probes + bins):
        if not len(todo):
            break
        if t < probes:
            hop = (mix(np.arange(bins, dtype=np.uint64) * np.uint64(probes) + np.uint64(t)) % np.uint64(bins)).astype(np.int64)[col]
        else:
            hop = (col + t) % bins
        hit = full[row * bins + hop]
        value[todo[hit]] = value[(row * bins + hop)[hit]]
        todo, row, col = todo[~hit], row[~hit], col[~hit]
    return value.reshape(n, bins)


def sketches(df: DataFrame, id_col: str, text_col: str, k: int, bands: int, rows: int) -> DataFrame:
    """(id, n, digest, bands): set size, digest of the whole set, one key per band."""
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        factor = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
        for b in small_batches(batches):
            sets, digests = [], []
            for own, other in _sets(b.column(1).to_pylist(), k, second=2):
                sets.append(own)
                digests.append(hashlib.blake2b(own.tobytes() + other.tobytes(), digest_size=16).digest() if len(own) else None)
            some = [i for i, s in enumerate(sets) if len(s)]
            keys: list = [None] * len(sets)
            if some:
                sig = signatures([sets[i] for i in some], bands * rows).reshape(len(some), bands, rows)
                band = mix((sig * factor).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)).view(np.int64)
                for i, r in zip(some, band):
                    keys[i] = r
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(digests, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], ["id", "n", "digest", "bands"])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, n bigint, digest binary, bands array<bigint>")


def full_sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(id, s): the whole shingle sets of the documents (id, text) that ``ids`` names."""
    ids = broadcast_ids(ids.select(F.col("id").alias("_id")))
    need = docs.join(ids, F.col("id") == F.col("_id"), "left_semi").select("id", "text")

    def run(batches):
        for b in small_batches(batches):
            sets = shingle_sets(b.column(1).to_pylist(), k)
            at = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = pa.array(np.concatenate(sets).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(at, flat)], ["id", "s"])

    return need.mapInArrow(run, f"id {need.schema['id'].dataType.simpleString()}, s array<bigint>")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, i, n): shared shingles of each pair's whole sets, and the sum of their sizes."""
    met = (pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
           .join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b"))
    return met.select("a", "b", F.size(F.array_intersect("sa", "sb")).cast("long").alias("i"),
                      (F.size("sa") + F.size("sb")).cast("long").alias("n")).distinct()


def verified(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ``overlaps`` that are similar enough."""
    return pairs.where(F.col("i") * 100 >= (F.col("n") - F.col("i")) * percent).select("a", "b")


def _open(member: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with their root and the
    root of the bucket's largest one."""
    root = F.coalesce("root", F.col("id")).alias("root")
    placed = stored(member.join(roots, F.col("id") == F.col("node"), "left").select(*member.columns, root), "placed")
    several = (placed.groupBy("band", "key", "root").agg(F.count(F.lit(1)).alias("m"))
               .groupBy("band", "key").agg(F.max(F.struct("m", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
               .where("roots > 1").select("band", "key", F.col("main.root").alias("main")))
    return stored(placed.join(stored(several, "open"), ["band", "key"]), "open-members")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
                    bands: int = 32, rows: int = 5) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row: the smallest id reachable
    over pairs whose sets have ``100 * intersection >= percent * union``."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sketch = stored(sketches(docs, "id", "text", k, bands, rows), "sketches")
    found = sketch.where("n > 0 AND id IS NOT NULL")
    classes = stored(found.groupBy("digest").agg(F.min(F.struct("id", "n", "bands")).alias("m"))
                     .select("digest", "m.*"), "classes")
    member = classes.select("id", "n", F.posexplode("bands").alias("band", "key"))
    centre = stored(member.groupBy("band", "key").agg(F.min("id").alias("centre"), F.count(F.lit(1)).alias("m"))
                    .where("m > 1").select("band", "key", "centre"), "centres")
    member = stored(member.join(centre, ["band", "key"]).select("band", "key", "id", "n", "centre"), "members")
    size = classes.select(F.col("id").alias("a"), F.col("n").alias("na"))
    fits = F.least("na", "n") * 100 >= F.greatest("na", "n") * percent
    star = member.where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b"), "n").distinct()
    star = stored(star.join(size, "a").where(fits).select("a", "b"), "stars")
    sets = stored(full_sets(docs, stored(member.select("id").distinct(), "member-ids"), k), "sets")
    links = stored(verified(overlaps(star, sets), percent), "links")

    # shingles that no other document of the buckets has can't be shared, which bounds every
    # pair's similarity; c is the number of the others
    own = (sets.distinct().select("id", F.explode("s").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("id"))
           .where("m = 1").groupBy("id").agg(F.count(F.lit(1)).alias("_own")).withColumnRenamed("id", "_o"))
    member = member.join(stored(own, "own"), F.col("id") == F.col("_o"), "left").withColumn("c", F.col("n") - F.coalesce("_own", F.lit(0)))
    member = stored(member.where(F.col("c") * 100 >= F.col("n") * percent).select("band", "key", "id", "n", "c"), "linkable")

    # a second star around the member with the smallest share of such shingles, where one is
    # still needed; it tells how much of that member, the heart, every other one shares
    placed = _open(member, components(links))
    heart = placed.groupBy("band", "key").agg(F.min(F.struct((1 - F.col("c") / F.col("n")).alias("own"), "id")).alias("h"))
    heart = stored(heart.select("band", "key", F.col("h.id").alias("heart")), "hearts")
    second = placed.join(heart, ["band", "key"]).where("id <> heart").select(F.col("heart").alias("a"), F.col("id").alias("b")).distinct()
    second = stored(overlaps(second, sets), "second-stars")
    links = stored(links.unionByName(verified(second, percent)), "links")

    # what is left: documents outside their bucket's largest component, against the others.  A pair shares
    # at most what both share with the heart, and of the rest what any other document has as well
    roots = components(links)
    shared = second.select(F.col("a").alias("heart"), F.col("b").alias("id"), F.col("i").alias("t"))
    placed = _open(member, roots).join(heart, ["band", "key"]).join(shared, ["heart", "id"])
    placed = placed.join(classes.select(F.col("id").alias("_c"), "bands"), F.col("id") == F.col("_c"))
    placed = stored(placed.select("band", "key", "id", "n", "c", "t", "root", "main", "bands"), "compared")
    outside = placed.where("root <> main").select("band", "key", F.col("id").alias("x"), F.col("n").alias("nx"),
                                                  F.col("c").alias("cx"), F.col("t").alias("tx"), F.col("root").alias("rx"), F.col("bands").alias("bx"))
    most = F.least("t", "tx") + F.least(F.col("c") - F.col("t"), F.col("cx") - F.col("tx"))
    # of the buckets that a pair shares, only the first compares it
    earlier = F.exists(F.zip_with(F.slice("bands", 1, F.col("band")), F.slice("bx", 1, F.col("band")), lambda x, y: x == y), lambda e: e)
    rest = (outside.join(placed, ["band", "key"])
            .where((F.col("rx") != F.col("root")) & (most * 100 >= (F.col("n") + F.col("nx") - most) * percent) & ~earlier)
            .select(F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b")).distinct()
            .join(star, ["a", "b"], "left_anti"))
    more = stored(verified(overlaps(stored(rest, "rest"), sets), percent), "more-links")
    # the roots found already stand for the links they come from
    joined = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    label = classes.join(joined, F.col("id") == F.col("node"), "left").select(
        F.col("digest").alias("_digest"), F.coalesce("root", F.col("id")).alias("_root"))
    out = sketch.join(label, (F.col("digest") == F.col("_digest")) & F.col("id").isNotNull(), "left")
    component = F.coalesce("_root", F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))
