"""Text Column builders.

Every function maps Columns to a Column with built-in Spark expressions only,
so the work stays inside whole-stage codegen. Regexes are Java regexes; the
whitespace class below reproduces Python's ``str.isspace`` set, which Java's
``\\s`` (ASCII only) and Spark's ``trim`` (space only) do not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values. These must equal the values the original dataset builder
# uses, so that descriptions come out identical.
# ---------------------------------------------------------------------------
IGNORED_TAGS = (
    "3d", "model", "3d model", "free", "free model", "free3dmodel", "download",
    "downloadable", "sketchfab", "blender", "maya", "3ds max", "3dsmax",
    "substance painter", "zbrush", "unity", "unreal",
)
JUNK_PHRASES = ("newfields design gallery", "design gallery")
PROMO_PATTERNS = (
    r"please\s+follow", r"follow\s+and\s+support", r"support\s+me",
    r"free\s+to\s+use", r"click\s+here", r"facebook", r"search\s+page",
    r"publisher", r"asset\s+store", r"download\s+link",
)
WEEKDAYS = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MAX_WORDS = 35
# ---------------------------------------------------------------------------

# The code points Python treats as whitespace, as one Java/RE2 class.
WS = (r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
# A Python ``\w`` character (letters, numbers, underscore).
_WORD = r"[\p{L}\p{N}_]"

URL_RE = r"(?iu)https?://\S+|www\.\S+"
PROMO_RE = "(?iu)(?:" + "|".join(PROMO_PATTERNS) + ").*"
HEX_ID_RE = rf"(?iu)(?<!{_WORD})[0-9a-f]{{12,}}(?!{_WORD})"
DATE_NAME_RE = (
    "^(?:" + "|".join(WEEKDAYS) + r")[\s,]+\p{Nd}{1,2}\s+(?:" + "|".join(MONTHS)
    + r")\s+\p{Nd}{4}(?:[\s,]+\p{Nd}{1,2}(?:[:\s]\p{Nd}{2})(?:[:\s]\p{Nd}{2})?)?$"
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """NULL -> '', '-' and '_' -> space, collapse whitespace, strip."""
    s = F.translate(F.coalesce(_c(c).cast("string"), F.lit("")), "-_", "  ")
    return F.trim(F.regexp_replace(s, WS + "+", " "))


def is_useful_clean(t: Column) -> Column:
    """F03 on text that is already T01-clean (see :func:`is_useful_text`).

    Conditions are ordered so that the cheap ones decide first: the hex test
    only runs on single tokens, the date pattern only on strings that start
    with a weekday, and the letter count stops at the third letter.
    """
    low = F.lower(t)
    single = ~t.contains(" ")
    n_hex = F.length(low) - F.length(F.translate(low, "0123456789abcdef", ""))
    hexlike = single & (n_hex >= 12)
    datelike = F.substring(low, 1, 3).isin(*WEEKDAYS) & low.rlike(DATE_NAME_RE)
    n_ascii_letters = F.length(low) - F.length(F.translate(low, "abcdefghijklmnopqrstuvwxyz", ""))
    three_letters = (n_ascii_letters >= 3) | t.rlike(r"\p{L}\P{L}*\p{L}\P{L}*\p{L}")
    return ((t != "")
            & ~low.isin(*JUNK_PHRASES)
            & ~hexlike
            & ~datelike
            & three_letters)


def is_useful_text(c) -> Column:
    """reject empty, junk labels, single hex-like tokens, date names and
    strings with fewer than three letters (T12, T13)."""
    return is_useful_clean(clean_text(c))


def fallback_description(category) -> Column:
    return F.concat(F.coalesce(_c(category).cast("string"), F.lit("None")), F.lit(" furniture"))


def _promo_candidate(low: Column) -> Column:
    """Necessary condition for a promotional phrase (skips the regex on most rows).
    Case folds that ``lower`` does not perform (the long s) also trigger it."""
    words = ("follow", "support", "free", "click", "facebook", "search", "publisher", "asset", "download")
    out = low.contains("\u017f")
    for w in words:
        out = out | low.contains(w)
    return out


def sanitize_steps(t: Column, category, max_words: int = MAX_WORDS, prechecks: bool = False) -> list:
    """T02 on T01-clean text as a list of ``(name, Column)`` steps; each step reads
    the previous one by name, so callers that add them one ``select`` at a time
    never copy a large expression into several places of the plan."""
    low = F.lower(F.col("_s0"))
    url = F.regexp_replace(F.col("_s0"), URL_RE, " ")
    promo = F.regexp_replace(F.col("_s1"), PROMO_RE, " ")
    if prechecks:  # literal tests decide whether the regex has to run at all
        url = F.when(low.contains("://") | low.contains("www."), url).otherwise(F.col("_s0"))
        promo = F.when(_promo_candidate(F.lower(F.col("_s1"))), promo).otherwise(F.col("_s1"))
    words = F.array_join(F.slice(F.split(F.trim(F.regexp_replace(
        F.regexp_replace(F.col("_s2"), HEX_ID_RE, " "), " +", " ")), " "), 1, max_words), " ")
    fb = fallback_description(category)
    final = F.when(F.col("_s0") == "", fb).when(F.col("_s3") == "", fb).otherwise(F.col("_s3"))
    return [("_s0", t), ("_s1", url), ("_s2", promo), ("_s3", words), ("_out", final)]


def sanitize_clean(t: Column, category, max_words: int = MAX_WORDS) -> Column:
    """T02 on text that is already T01-clean, as one Column (small inputs)."""
    s = F.regexp_replace(t, URL_RE, " ")
    s = F.regexp_replace(s, PROMO_RE, " ")
    s = F.regexp_replace(s, HEX_ID_RE, " ")
    s = F.array_join(F.slice(F.split(F.trim(F.regexp_replace(s, " +", " ")), " "), 1, max_words), " ")
    fb = fallback_description(category)
    return F.when(t == "", fb).when(s == "", fb).otherwise(s)


def sanitize_description(c, category, max_words: int = MAX_WORDS) -> Column:
    """Clean, drop URLs, promotional tails and long hex ids, cap words."""
    return sanitize_clean(clean_text(c), category, max_words)


def _named_parts(arr, drop_ignored: bool) -> Column:
    """Cleaned, useful names of an ``array<struct<name>>``, first occurrence kept."""
    items = F.filter(F.coalesce(arr, F.array()), lambda x: x.isNotNull())
    names = F.transform(items, lambda x: clean_text(x["name"]))
    if drop_ignored:
        keep = lambda n: is_useful_clean(n) & ~F.lower(n).isin(*IGNORED_TAGS)
    else:
        keep = is_useful_clean
    return F.array_distinct(F.filter(names, keep))


def description_parts(name, description, tags, categories) -> Column:
    """Fragments of T04 in order: name, description, tags, categories (deduped)."""
    n = clean_text(name)
    d = clean_text(description)
    head = F.filter(F.array(n, d), is_useful_clean)
    return F.array_distinct(F.concat(head, _named_parts(tags, True), _named_parts(categories, False)))


def build_description(name, description, tags, categories, category) -> Column:
    """Join the useful fragments, clean, fall back, sanitise."""
    text = clean_text(F.array_join(description_parts(name, description, tags, categories), " "))
    text = F.when(text == "", fallback_description(category)).otherwise(text)
    return sanitize_clean(text, category)


def clean_description(c) -> Column:
    """Lower, keep ``[a-z0-9-]`` and whitespace, collapse, strip."""
    s = F.regexp_replace(F.lower(F.coalesce(_c(c), F.lit(""))), r"[^a-z0-9\s-]", " ")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


EMPTY_TOKEN = "empty"


def token_runs(c) -> Column:
    """``[a-z0-9-]+`` runs of the lower-cased text (possibly none)."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(c), F.lit(""))), F.lit("[a-z0-9-]+"), F.lit(0))


def tokenize(c) -> Column:
    """``[a-z0-9-]+`` runs of the lower-cased text; none -> ['empty']."""
    toks = token_runs(c)
    return F.when(F.size(toks) == 0, F.array(F.lit(EMPTY_TOKEN))).otherwise(toks)


def slug(c, max_len: int = 40) -> Column:
    """Lower, non ``[a-z0-9]`` runs -> '-', strip '-', cut, else 'shape'."""
    s = F.regexp_replace(F.lower(_c(c)), "[^a-z0-9]+", "-")
    s = F.substring(F.regexp_replace(s, "^-+|-+$", ""), 1, max_len)
    return F.when(s == "", F.lit("shape")).otherwise(s)


def mesh_filename(stem, key) -> Column:
    """``{stem}-{8 hex}.obj``; the suffix is derived from a key, so reruns agree."""
    return F.concat(_c(stem), F.lit("-"), F.substring(F.md5(_c(key).cast("string")), 1, 8), F.lit(".obj"))


def path_basename(c) -> Column:
    return F.regexp_extract(_c(c), "([^/]*)$", 1)


def path_stem(c, suffix: str = ".glb") -> Column:
    """Basename, cut at the first occurrence of the suffix."""
    base = path_basename(c)
    return F.substring_index(base, suffix, 1)


def strip_shard(c) -> Column:
    """Remove ``ddd-ddd/`` shard folders from a path."""
    return F.regexp_replace(_c(c), r"\d{3}-\d{3}/", "")


def failure_reason(kind: str, message) -> Column:
    """``{ExceptionType}: {message}``."""
    return F.concat(F.lit(kind + ": "), _c(message))


def strip_punctuation(c) -> Column:
    """T14 first step: delete ASCII punctuation."""
    return F.regexp_replace(_c(c), r"[!-/:-@\[-`{-~]+", "")


def tag_text(tags) -> Column:
    """Names of the tags joined by a space."""
    return F.array_join(F.transform(_c(tags), lambda t: t["name"]), " ")


def split_words(c) -> Column:
    """Python ``str.split()``: whitespace runs, no empty words."""
    s = F.trim(F.regexp_replace(F.coalesce(_c(c), F.lit("")), WS + "+", " "))
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, " "))
