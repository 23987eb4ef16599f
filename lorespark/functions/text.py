"""Text scalars as columns."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]{2,}"


def tokens(c: Column) -> Column:
    """Lower-case Unicode word tokens of at least two characters; null gives an empty array."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(WORD), 0)


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def scope_slug(c: Column) -> Column:
    return F.lower(F.translate(c, " -", "__"))


def label_slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "_"), "^_+|_+$", "")


def basename(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def stem(c: Column) -> Column:
    return F.regexp_replace(basename(c), r"\.[^.]+$", "")


def occurrences(c: Column, needle: str) -> Column:
    """Non-overlapping occurrences of a fixed string."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(needle), F.lit("")))) / len(needle)).cast("int")


def hex_id(c: Column, length: int = 24) -> Column:
    return F.substring(F.sha2(c, 256), 1, length)


def snippet(c: Column, length: int) -> Column:
    return F.when(F.length(c) > length, F.concat(F.substring(c, 1, length), F.lit("..."))).otherwise(c)


def blockquote(c: Column) -> Column:
    return F.concat(F.lit("> "), F.replace(c, F.lit("\n"), F.lit("\n> ")))


def normal_newlines(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def entity_id(c: Column) -> Column:
    return F.replace(F.replace(F.lower(c), F.lit(" "), F.lit("_")), F.lit("'"), F.lit(""))


def bound(c: Column, use: Callable[[Column], Column]) -> Column:
    """`use(c)` with c computed once, also where `use` reads it inside of lambdas."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def keyword_hits(c: Column, keywords: list[str]) -> Column:
    """How many of the keywords occur as substrings."""
    return sum((F.contains(c, F.lit(k)).cast("int") for k in keywords), F.lit(0))


def best_label(c: Column, lists: dict[str, list[str]], default: str) -> Column:
    """The label whose keywords hit most often; the first declared one of equals; `default` without hits."""

    def best(text: Column) -> Column:
        return F.array_max(F.array(*[F.struct(keyword_hits(text, ks).alias("s"), F.lit(-i).alias("p"), F.lit(name).alias("n")) for i, (name, ks) in enumerate(lists.items())]))

    return bound(bound(F.coalesce(c, F.lit("")), best), lambda top: F.when(top["s"] > 0, top["n"]).otherwise(F.lit(default)))


# --- reserved transforms: what a source may declare that it does to a text, by name -------------------------------------


def _lines(c: Column, f) -> Column:
    return F.array_join(F.transform(F.split(c, "\n"), f), "\n")


def collapsed_blank_lines(c: Column) -> Column:
    """Runs of three or more blank lines become two; lines of blanks count as blank."""
    bare = _lines(c, lambda x: F.when(x.rlike(r"\S"), x).otherwise(F.lit("")))
    return F.regexp_replace(bare, r"\n{4,}", "\n\n\n")


def joined_lines(c: Column) -> Column:
    """The lines of each paragraph, stripped, joined by spaces."""
    parts = F.split(c, r"\n[ \t]*\n")
    return F.array_join(F.transform(parts, lambda p: F.array_join(F.filter(F.transform(F.split(p, "\n"), strip), lambda x: x != ""), " ")), "\n\n")


def without_blank_lines(c: Column) -> Column:
    return F.array_join(F.filter(F.split(c, "\n"), lambda x: x.rlike(r"\S")), "\n")


def decoded(c: Column) -> Column:
    """Bytes as UTF-8 text, with the replacement character for what isn't."""
    return F.decode(F.coalesce(F.try_validate_utf8(c.cast("string")).cast("binary"), F.make_valid_utf8(c.cast("string")).cast("binary")), "UTF-8")


def _same(c: Column) -> Column:
    return c


#: By name; those that depend on a format leave the text as it is unless a source brings its own.
TRANSFORMS = {
    "utf8_replace_invalid": decoded,
    "newline_normalize": normal_newlines,
    "whitespace_trim": strip,
    "whitespace_collapse_internal": collapsed_blank_lines,
    "line_trim": lambda c: _lines(c, strip),
    "line_join_spaces": joined_lines,
    "blank_line_drop": without_blank_lines,
    "strip_tool_chrome": _same,
    "tool_result_truncate": _same,
    "tool_result_omitted": _same,
    "spellcheck_user": _same,
    "synthesized_marker": _same,
    "speaker_role_assignment": _same,
}


def transformed(c: Column, names: list[str]) -> Column:
    """The transforms of these names, in order; an unknown name is an error."""
    for name in names:
        if name not in TRANSFORMS:
            raise ValueError(f"no transform is called {name}")
        c = TRANSFORMS[name](c)
    return c


# --- functions that a user may bring ------------------------------------------------------------------------------------


def hashed_vectors(texts: pd.Series, dim: int) -> pd.Series:
    """Unit vectors of hashed word counts, the same on every machine; zeros for a text without words."""
    out = []
    for text in texts:
        v = np.bincount([zlib.crc32(w.encode()) % dim for w in (text or "").lower().split()], minlength=dim).astype(float)
        out.append((v / max(float(np.linalg.norm(v)), 1e-300)).tolist())
    return pd.Series(out)


def embedded(c: Column, dim: int = 64, model: Callable[[pd.Series], pd.Series] | None = None) -> Column:
    """The vector (array<double>) of a text by `model`, which takes and gives a pandas series; hashed words without one."""

    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return model(texts) if model else hashed_vectors(texts, dim)

    return run(c)


def spellchecked(c: Column, speller: Callable[[str], str] | None = None) -> Column:
    """A text with each plain word as `speller` spells it; words with digits, capitals or marks inside, and short ones,
    stay, as does everything without a speller."""
    if speller is None:
        return c

    def word(w: str) -> str:
        return speller(w) if len(w) > 3 and w.isalpha() and w.islower() else w

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else " ".join(map(word, t.split(" "))))

    return run(c)
