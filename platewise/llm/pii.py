"""Personal data: base formats, and identifiers found by bootstrapped contexts.

Base spans (e-mail, IP address, payment card, phone number) come from regular
expressions; places are code points.  They seed a bootstrap over the corpus.  A
candidate is

* a word with at least five digits or an at sign,
* a whole base span of several words, or
* a group: words with digits (no at sign, touched by no base span) that follow each
  other, or are parted by words of ``().-`` only, with at least five digits in all.

Its patterns are the word before it and the word behind it (in lower case, whatever
they hold), each with the candidate's format (letters, digits, blanks, signs; runs are
one sign).  A number (5 to 19 digits and nothing else but blanks and ``+()-``) that is
no part of a longer candidate has the same two patterns with the format ``#`` too, so
that a number in one grouping teaches the context of another.  From the graph of
patterns and distinct instances

* a pattern's confidence is known / (all + 1), over its instances,
* an instance is known if it is a seed or in a pattern of at least ``confident``,

and both are computed in turn until no further pattern is confident (known instances
only grow, so that ends; beyond ``max_rounds`` it raises).  All candidates of a
confident pattern that no base span touches become spans of kind ``context``.
Words and formats count whole, however long (a pattern holds the hash of those of more
than 32 characters).  The graph holds each edge once, so a hot pattern or instance counts its partners,
not its rows.

Main path: DataFrame functions only.  Regular expressions are written so that
long runs are read once (possessive; a match starts at a run's start or at the
end of the match before it), which finds the same matches.

Defined cases: a NULL text is empty; equal rows get equal spans and each counts
once as a text's copy (patterns count distinct instances); a row without an id is
kept; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
# Matches of the contract's expressions, read without going back over long runs.
REGEX = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
SPAN = "array<struct<start:int,end:int,kind:int>>"


def _luhn(digits: Column) -> Column:
    d = F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), 0)
    value = lambda c, i: c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
    total = F.aggregate(F.transform(d, lambda c, i: value(c, i) - F.when(value(c, i) > 9, 9).otherwise(0)), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":  # each part at most 255, whatever its leading zeros
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.substring(part(p), 1, 3).cast("int") <= 255))
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)


def _walk(text: Column, regex: str, one, shape: str) -> Column:
    """``one(match, start, gap before, gap behind)`` of every match; the gaps between
    matches, which ``split`` gives, tell their places."""
    gaps, found = F.split(text, regex, -1), F.regexp_extract_all(text, F.lit(regex), 0)
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{shape}>").alias("out"))
    zipped = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("m"), F.slice(gaps, 2, F.size(found)).alias("next"))
    return F.aggregate(zipped, empty, lambda a, x: F.struct(
        (a["at"] + F.length(x["gap"]) + F.length(x["m"])).alias("at"),
        F.concat(a["out"], F.array(one(x["m"], a["at"] + F.length(x["gap"]), x["gap"], x["next"]).cast(shape))).alias("out")),
        lambda a: a["out"])


def _matches(text: str, kind: str, code: int) -> Column:
    """Spans of the valid matches of one kind."""
    walked = _walk(F.col(text), REGEX[kind], lambda m, start, *_: F.struct(
        start, start + F.length(m), F.lit(code), _valid(kind, m)), "struct<start:int,end:int,kind:int,ok:boolean>")
    spans = F.transform(F.filter(walked, lambda s: s["ok"]), lambda s: F.struct(s["start"], s["end"], s["kind"]))
    return F.when(F.col(text).rlike(HINT[kind]), spans.cast(SPAN)).otherwise(F.array().cast(SPAN))


def _ordered(spans: Column) -> Column:
    """By start, then kind as listed."""
    return F.transform(F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"]))),
                       lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))


def base_spans(df: DataFrame, text_col: str = "text", out: str = "base") -> DataFrame:
    """All columns of ``df`` and the base spans, by start, then kind."""
    each = [_matches("_t", k, i) for i, k in enumerate(KINDS)]
    return df.withColumn("_t", F.coalesce(F.col(text_col), F.lit(""))).withColumn(out, _ordered(F.concat(*each))).drop("_t")


BLANK, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
MARKED = rf"(?<!{WORD})[^\x20\x09-\x0D0-9@]*+[0-9@]{WORD}*+"  # a word with a digit or an at sign
# Marked words that follow each other, words of signs between them; a base span lies in one run.
RUN = rf"{MARKED}(?:{BLANK}++(?:[().-]++{BLANK}++)*+{MARKED})*+"
LEAST_DIGITS, MOST_DIGITS = 5, 19
TOKEN = "struct<start:int,end:int,word:string>"
CANDIDATE = "struct<start:int,end:int,instance:string,patterns:array<string>>"


def _digits(c: Column) -> Column:
    return F.length(F.regexp_replace(c, "[^0-9]++", ""))


def _touch(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _short(c: Column) -> Column:
    """The string, or the hash of a long one (which is too long itself to be another's)."""
    return F.when(F.length(c) <= 32, c).otherwise(F.concat(F.lit("~"), F.md5(c)))


def _candidate(text: Column, start: Column, before: Column, behind: Column, whole: Column) -> Column:
    """The candidate in ``text``, which begins at ``start``, between two words (empty where there is none)."""
    body = F.regexp_replace(text, "^[^A-Za-z0-9+]++", "")
    core = F.regexp_replace(body, r"(?<![^A-Za-z0-9])[^A-Za-z0-9]++$", "")
    first = start + F.length(text) - F.length(body)
    instance = F.regexp_replace(core, f"{BLANK}++", " ")
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(instance, r"\p{L}++", "a"), "[0-9]++", "9"), "(?:a9){2,}+a?|(?:9a){2,}+9?", "x")
    number = whole & instance.rlike(r"^[\x20+()0-9-]++$") & _digits(instance).between(LEAST_DIGITS, MOST_DIGITS)
    shapes = F.filter(F.array(_short(shape), F.when(number, F.lit("#"))), lambda f: f.isNotNull())
    side = lambda sign, w: F.when(w != "", F.transform(shapes, lambda f: F.concat_ws(" ", F.lit(sign), _short(F.lower(w)), f)))
    none = F.array().cast("array<string>")
    patterns = F.concat(F.coalesce(side("<", before), none), F.coalesce(side(">", behind), none))
    return F.struct(first, first + F.length(core), instance, patterns).cast(CANDIDATE)


def _in_run(run: Column, base: Column) -> Column:
    """Candidates of one run."""
    token = lambda m, at, *_: F.struct(run["start"] + at, run["start"] + at + F.length(m), m)
    base = F.filter(base, lambda s: (s["start"] >= run["start"]) & (s["end"] <= run["end"]))
    cut = lambda start, end: F.substr(run["text"], start - run["start"] + 1, end - start)

    def of(state):
        tokens, wide = state["tokens"], state["wide"]
        n = F.size(tokens)
        word = lambda i: F.when(i < 0, run["before"]).when(i >= n, run["behind"]).otherwise(F.get(tokens, i)["word"])
        open_ = F.transform(tokens, lambda t: ~t["word"].contains("@") & ~F.exists(base, lambda s: _touch(s, t)))
        at = lambda flags, i: F.coalesce(F.get(flags, i), F.lit(False))

        def with_groups(g):
            free = g["open"]
            every = F.sequence(F.lit(0), n - 1)
            firsts = F.filter(every, lambda i: at(free, i) & ((i == 0) | ~at(free, i - 1)))
            lasts = F.filter(every, lambda i: at(free, i) & ~at(free, i + 1))
            several = F.filter(F.arrays_zip(firsts.alias("i"), lasts.alias("j")), lambda x: x["i"] < x["j"])
            groups = F.transform(several, lambda x: _candidate(
                cut(F.get(tokens, x["i"])["start"], F.get(tokens, x["j"])["end"]), F.get(tokens, x["i"])["start"], word(x["i"] - 1), word(x["j"] + 1), F.lit(True)))
            groups = F.filter(groups, lambda c: _digits(c["instance"]) >= LEAST_DIGITS)
            alone = lambda t, i: ~F.exists(wide, lambda s: _touch(s, t)) & ~(
                at(free, i) & (at(free, i - 1) & (i > 0) | at(free, i + 1)))
            words = F.transform(tokens, lambda t, i: _candidate(t["word"], t["start"], word(i - 1), word(i + 1), alone(t, i)))
            words = F.filter(words, lambda c: c["instance"].contains("@") | (_digits(c["instance"]) >= LEAST_DIGITS))
            return F.concat(words, groups)

        ends = lambda test: F.filter(tokens, test)["word"]
        before = lambda s: F.coalesce(F.try_element_at(ends(lambda t: t["end"] <= s["start"]), F.lit(-1)), run["before"])
        behind = lambda s: F.coalesce(F.get(ends(lambda t: t["start"] >= s["end"]), 0), run["behind"])
        spans = F.transform(wide, lambda s: _candidate(cut(s["start"], s["end"]), s["start"], before(s), behind(s), F.lit(True)))
        return F.concat(_let(F.struct(open_.alias("open")), with_groups), spans)

    wide = F.filter(base, lambda s: cut(s["start"], s["end"]).contains(" "))
    return _let(F.struct(_walk(run["text"], f"{WORD}++", token, TOKEN).alias("tokens"), wide.alias("wide")), of)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _candidates(text: str, base: str) -> Column:
    """Candidates with their place and patterns."""
    def one(m, start, gap, after):
        before = F.regexp_extract(gap, rf"(?<!{WORD})({WORD}++){BLANK}*+\z", 1)
        behind = F.regexp_extract(after, rf"^{BLANK}*+({WORD}++)", 1)
        return F.struct(start, start + F.length(m), m, before, behind)

    runs = _walk(F.col(text), RUN, one, "struct<start:int,end:int,text:string,before:string,behind:string>")
    found = F.flatten(F.transform(runs, lambda r: _in_run(r, F.col(base))))
    return F.when(F.col(text).rlike("[0-9@]"), found).otherwise(F.array().cast(f"array<{CANDIDATE}>"))


def confident_patterns(edges: DataFrame, confident: float = 0.8, max_rounds: int = 200) -> DataFrame:
    """(pattern) of the confident ones; ``edges`` has (pattern, instance, seed), each edge once."""
    known = edges.where("seed").select("instance").distinct()
    before = 0
    for _ in range(max_rounds):
        known = stored(known.select(F.col("instance").alias("_known")), "known")
        met = edges.join(known, F.col("instance") == F.col("_known"), "left")
        score = F.count("_known") / (F.count(F.lit(1)) + 1)
        chosen = stored(met.groupBy("pattern").agg(score.alias("score")).where(F.col("score") >= confident)
                        .select(F.col("pattern").alias("_pattern")), "patterns")
        n = chosen.count()
        if n == before:
            return chosen
        before = n
        more = edges.join(chosen, F.col("pattern") == F.col("_pattern")).select("instance")
        known = edges.where("seed").select("instance").unionByName(more).distinct()
    raise RuntimeError("confident patterns did not settle")


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", confident: float = 0.8, max_rounds: int = 200) -> DataFrame:
    """(id, base, spans): base spans and all spans of every row, by start, then kind
    (0 to 3 as in ``KINDS``, 4 for a context span)."""
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = base_spans(docs).withColumn("cand", _candidates("text", "base")).select("id", "base", "cand")
    cand = F.transform("cand", lambda c: F.struct(*[c[n].alias(n) for n in ("start", "end", "instance", "patterns")],
                                                  F.exists("base", lambda s: _touch(s, c)).alias("seed")))
    rows = stored(rows.select("id", "base", cand.alias("cand")), "spans")
    flat = rows.where("size(cand) > 0").select("id", F.explode("cand").alias("c")).select("id", "c.*")
    sides = flat.select("id", "start", "end", "instance", "seed", F.explode("patterns").alias("pattern"))
    edges = stored(sides.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "edges")
    chosen = confident_patterns(edges, confident, max_rounds)
    more = (sides.where("NOT seed AND id IS NOT NULL").join(chosen, F.col("pattern") == F.col("_pattern"))
            .groupBy("id").agg(F.collect_set(F.struct("start", "end", F.lit(len(KINDS)).alias("kind"))).alias("more"))
            .withColumnRenamed("id", "_id"))
    out = rows.join(stored(more, "context"), F.col("id") == F.col("_id"), "left")
    return out.select(F.col("id").alias(id_col), "base", _ordered(F.concat("base", F.coalesce("more", F.array().cast(SPAN)))).alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in (*KINDS, "context")])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; of spans that
    overlap the first names the whole."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in (*KINDS, "CONTEXT")])
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda a, s: F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] >= a["at"], F.concat(
        a["out"], F.substr(text, a["at"] + 1, s["start"] - a["at"]), F.get(names, s["kind"]))).otherwise(a["out"]).alias("out"))
    return F.aggregate(spans, state, step, lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1)))
