"""Quality rules whose cutoffs are chosen under risk control.

Base statistics of a text come from native array functions in one pass.  A rule
is a ratio of two of them and rejects above a cutoff from a fixed grid.  The grids
have one length, and step j puts every rule at its j-th cutoff, so the steps go
from lax to strict and each rejects all that a laxer one does.  Per stratum, the
labelled good documents say how many of them (k of n) any rule of a step would
reject; the step may be used if P(Binomial(n, alpha) <= k) <= delta / m, that is if
the exact (Clopper-Pearson) upper bound on the false rejection rate of the whole
verdict is at most ``alpha``, where m counts the strata (Bonferroni).  The steps are
tested from lax to strict up to the first failure (a fixed sequence, which needs no
further correction), and the strictest that passed is taken; with too few labels
the rules stay off.  So with probability 1 - delta the verdict rejects more than
``alpha`` of the good documents of no stratum.  Copies of one text are one trial.
Everything is DataFrame functions; what is shuffled are counts and labelled texts'
digests.

Defined cases: a NULL text has no words; a NULL stratum is the stratum "";
labels other than 1, NULL or for unknown ids are not used, equal label rows
count once; equal rows are judged alike; an empty table gives no rows; only the
named columns are read.  Repeated word windows are compared by 64-bit
fingerprints inside one text.  The binomial tail is summed over ``terms`` terms
and bounded from above beyond them (:func:`binomial_tail`), which can only make a
step fail.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import broadcast_ids, stored, words

STATS = ("n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words")
# rule: (numerator, denominator, cutoffs in thousandths); it rejects where 1000 * numerator > cutoff * denominator
RULES = {
    "symbols": ("n_symbols", "word_chars", (10, 25, 50, 100, 200, 400)),
    "upper": ("n_upper", "word_chars", (50, 100, 200, 300, 400, 600)),
    "dup_lines": ("n_dup_lines", "n_lines", (50, 100, 200, 300, 400, 600)),
    "repeat_words": ("n_repeat_words", "n_words", (50, 100, 150, 200, 300, 400)),
    "long_words": ("word_chars", "n_words", (7000, 8000, 9000, 10000, 15000, 20000)),
}


def text_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``df`` and the statistics of the whole text (long)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    left = lambda drop: F.length(F.regexp_replace(text, drop, ""))
    one = df.withColumn("_w", words(text_col)).withColumn(
        "_l", F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    one = one.withColumn("_h", F.transform(
        F.slice("_w", 1, F.greatest(F.size("_w") - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get("_w", i + 1), F.get("_w", i + 2))))
    # equal fingerprints lie side by side once sorted; p: places of windows found twice or more
    pairs = F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    one = one.withColumn("_s", pairs)
    twice = lambda e, k: (F.get("_s", k - 1)["h"].eqNullSafe(e["h"]) | F.get("_s", k + 1)["h"].eqNullSafe(e["h"]))
    one = one.withColumn("_p", F.sort_array(F.transform(F.filter("_s", twice), lambda e: e["i"])))
    covered = F.aggregate(F.transform("_p", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_p", k + 1) - p, F.lit(3)))),
                          F.lit(0), lambda a, x: a + x)
    return one.select(
        *df.columns, F.size("_w").cast("long").alias("n_words"), F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        left("[^#*$%&|<>]+").cast("long").alias("n_symbols"), left("[^A-Z]+").cast("long").alias("n_upper"),
        F.size("_l").cast("long").alias("n_lines"), (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed(min_words: int = 50, max_repeat: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat)


def _log_gamma(x: Column) -> Column:
    """Stirling's series ten steps up, where its error is below 1e-13."""
    y = x + 10
    down = F.log(x)
    for i in range(1, 10):
        down = down + F.log(x + i)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - down


def binomial_tail(n: Column, k: Column, p: float, terms: int = 4096) -> Column:
    """P(Binomial(n, p) <= k) for k < n * p, else 1.  Summed downwards from k; beyond
    ``terms`` the rest is bounded by a geometric series, so it is never too small."""
    n, k = n.cast("double"), k.cast("double")
    top = F.exp(_log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
    ratio = lambda i: (k - i) * (1 - p) / ((n - k + i + 1) * p)
    start = F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term"))
    step = lambda a, i: F.struct((a["sum"] + a["term"] * ratio(i)).alias("sum"), (a["term"] * ratio(i)).alias("term"))
    last = F.least(k, F.lit(float(terms))).cast("int") - 1
    total = F.aggregate(F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>")), start, step,
                        lambda a: a["sum"] + F.when(k > terms, a["term"] * ratio(terms) / (1 - ratio(terms))).otherwise(0.0))
    return F.when((n > 0) & (k < n * p), F.least(F.lit(1.0), top * total)).otherwise(1.0)


def _rejects(rule: str, cutoff: Column) -> Column:
    num, den, _ = RULES[rule]
    return F.col(num) * 1000 > cutoff * F.col(den)


STEPS = len(next(iter(RULES.values()))[2])  # from the strictest, 0, to the laxest


def choose_cutoffs(good: DataFrame, alpha: float, delta: float) -> DataFrame:
    """(stratum, one column per rule): the cutoffs of the strictest step whose risk is
    controlled, no row if there is none; ``good`` has the stratum and statistics of
    labelled good documents, one row per text."""
    any_rule = lambda j: functools.reduce(Column.__or__, [_rejects(r, F.lit(cuts[j])) for r, (_, _, cuts) in RULES.items()])
    counts = good.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(any_rule(j).cast("long")).alias(f"k{j}") for j in range(STEPS)])
    counts = stored(counts, "counts")  # a row per stratum
    level = delta / max(1, counts.count())
    rows = counts.select("stratum", "n", F.posexplode(F.array(*[f"k{j}" for j in range(STEPS)])).alias("step", "k"))
    # k grows with strictness and the tail with k: what is laxer than a step that passes has passed
    safe = rows.where(binomial_tail(F.col("n"), F.col("k"), alpha) <= level).groupBy("stratum").agg(F.min("step").alias("step"))
    return safe.select("stratum", *[F.get(F.array(*map(F.lit, cuts)), "step").alias(f"cut_{r}") for r, (_, _, cuts) in RULES.items()])


def judge(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
          label_col: str = "quality", alpha: float = 0.01, delta: float = 0.05) -> DataFrame:
    """(id, statistics, base_failed, cut_<rule>, kept) of every row."""
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
                     F.col(text_col).alias("_text"))
    digest = F.unhex(F.sha2(F.coalesce(F.col("_text"), F.lit("")), 256))
    stats = text_stats(docs.withColumn("_digest", digest), "_text")
    stats = stats.select("id", "stratum", "_digest", *STATS, base_failed().alias("base_failed"))
    stats = stored(stats, "stats")
    good = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("_id")).distinct()
    good = stats.where("NOT base_failed").join(good, F.col("id") == F.col("_id")).dropDuplicates(["stratum", "_digest"])
    cuts = stored(choose_cutoffs(good, alpha, delta), "cutoffs").withColumnRenamed("stratum", "_stratum")
    cuts = broadcast_ids(cuts)  # a row per stratum with enough labels; broadcast only if its size is small
    out = stats.join(cuts, F.col("stratum") == F.col("_stratum"), "left")
    rejected = F.lit(False)
    for r in RULES:
        rejected = rejected | F.coalesce(_rejects(r, F.col(f"cut_{r}")), F.lit(False))
    return out.select(F.col("id").alias(id_col), *STATS, "base_failed", *[f"cut_{r}" for r in RULES],
                      (~F.col("base_failed") & ~rejected).alias("kept"))


def oracle(alpha: float = 0.01, delta: float = 0.05) -> str:
    """The same rows in DuckDB SQL over ``documents`` and ``labels``."""
    names = ", ".join(f"cut_{r}" for r in RULES)
    values = ", ".join(str((j, *[cuts[j] for _, _, cuts in RULES.values()])) for j in range(STEPS))
    hit = " OR ".join(f"coalesce({n} * 1000 > cut_{r} * {d}, false)" for r, (n, d, _) in RULES.items())
    return rf"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
wins AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
         FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
dups AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM wins) WHERE c > 1),
reps AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM dups, (VALUES (0), (1), (2)) s(o) GROUP BY doc_id),
st AS (
  SELECT doc_id, stratum, t, len(ws)::BIGINT AS n_words, coalesce(length(array_to_string(ws, '')), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(t, '[^A-Z]+', '', 'g'))::BIGINT AS n_upper, len(ls)::BIGINT AS n_lines,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(reps.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN reps USING (doc_id)),
stats AS (SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed FROM st),
good AS (SELECT DISTINCT stratum, t, {", ".join(STATS)} FROM stats
         WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
grid(step, {names}) AS (VALUES {values}),
counted AS (SELECT stratum, step, count(*)::DOUBLE AS n, count(*) FILTER ({hit})::DOUBLE AS k FROM good, grid GROUP BY ALL),
tail AS (
  SELECT stratum, step, list_sum(list_transform(range(0, k::BIGINT + 1), lambda i: exp(
           lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({alpha}) + (n - i) * ln(1 - {alpha})))) AS p
  FROM counted WHERE k < n * {alpha}),
chosen AS (SELECT stratum, min(step) AS step FROM tail
           WHERE p <= {delta} / (SELECT count(DISTINCT stratum) FROM good) GROUP BY stratum),
cuts AS (SELECT stratum, {names} FROM chosen JOIN grid USING (step))
SELECT doc_id, {", ".join(STATS)}, base_failed, {names},
       NOT base_failed AND NOT ({hit}) AS kept
FROM stats LEFT JOIN cuts USING (stratum)"""
