"""Text functions on columns (JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a dish name keeps; every other character is
# removed.  Space, A-Z, a-z, Thai U+0E01..U+0E25, U+0E27..U+0E3A,
# U+0E40..U+0E4D, left and right single quotes U+2018 and U+2019, and U+FEFF.
KEPT_RANGES = (
    (0x20, 0x20),
    (0x41, 0x5A),
    (0x61, 0x7A),
    (0x0E01, 0x0E25),
    (0x0E27, 0x0E3A),
    (0x0E40, 0x0E4D),
    (0x2018, 0x2018),
    (0x2019, 0x2019),
    (0xFEFF, 0xFEFF),
)


def _class_item(lo: int, hi: int) -> str:
    esc = lambda cp: f"\\x{{{cp:04X}}}"  # noqa: E731  Java and RE2 both read \x{...}
    return esc(lo) if lo == hi else f"{esc(lo)}-{esc(hi)}"


#: Regex matching a run of characters that are *not* kept (one replacement per run).
DROP_PATTERN = "[^" + "".join(_class_item(lo, hi) for lo, hi in KEPT_RANGES) + "]+"


def clean_text(c: Column | str) -> Column:
    """Remove every character outside the kept set (NULL stays NULL)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(col, F.lit(DROP_PATTERN), F.lit(""))


def normalise_name(c: Column | str) -> Column:
    """Lower-case and turn spaces into underscores ('Tiny Ring' -> 'tiny_ring')."""
    col = F.col(c) if isinstance(c, str) else c
    return F.replace(F.lower(col), F.lit(" "), F.lit("_"))


def percentile_label(decile: Column | str) -> Column:
    """``'P' || decile``; a NULL decile is skipped, giving ``'P'``."""
    col = F.col(decile) if isinstance(decile, str) else decile
    return F.concat_ws("", F.lit("P"), col.cast("string"))
