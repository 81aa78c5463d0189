"""Asset-catalog views derived from the driver's ``documents`` table.

The driver's tables carry no asset catalog, so ``documents`` stands in for one.
Each derivation exists twice: as Spark Columns (what the queries run) and as
DuckDB SQL (what the oracle runs). Noise the builder must remove (URLs,
promotional tails, hex ids, dates, junk labels, blanks) is injected with the
same rule on both sides, over every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import IGNORED_TAGS, WS
from .registry import table

# Fixed display forms used to write date-like object names.
WEEKDAY_NAMES = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def _lits(vals):
    return F.array(*[F.lit(v) for v in vals])


def _sql_list(vals):
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in vals) + "]"


def annotations_from_documents(spark: SparkSession, sf_dir: str, text_tags: bool = False) -> DataFrame:
    """``(uid, category, pos, name, description, tags, categories)`` per document.

    Three in ten documents have a second annotation, uid ``x<doc_id>``, with a
    blank description. Tags are the words of the first line, or with
    ``text_tags`` those of the whole text.
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    did = F.col("doc_id")
    title = F.regexp_extract("text", r"^([^\n]*)", 1)
    digest = F.md5("text")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    date_name = F.concat(
        F.element_at(_lits(WEEKDAY_NAMES), (did % 7 + 1).cast("int")), F.lit(", "),
        (did % 28 + 1).cast("string"), F.lit(" "),
        F.element_at(_lits(MONTH_NAMES), (did % 12 + 1).cast("int")), F.lit(" "),
        (did % 25 + 2000).cast("string"), F.lit(" "),
        two(did % 24), F.lit(":"), two(did % 60), F.lit(":"), two(did * 7 % 60))
    dashed = F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4),
                         F.substring(digest, 13, 4), F.substring(digest, 17, 4),
                         F.substring(digest, 21, 12))
    k8 = did % 8
    name = (F.when(k8 == 0, date_name).when(k8 == 1, digest).when(k8 == 2, dashed)
            .when(k8 == 3, F.lit("Newfields_Design-Gallery")).when(k8 == 4, F.lit(None))
            .otherwise(title))
    k10 = did % 10
    desc = (F.when(k10 == 0, F.concat("text", F.lit(" Please  follow me on Facebook")))
            .when(k10 == 1, F.concat(F.lit("See https://my-site.com/x-"), did.cast("string"),
                                     F.lit(" now. "), "text"))
            .when(k10 == 2, F.concat(F.lit("WWW.SHOP.COM/a_b "), digest, F.lit(" "), "text"))
            .otherwise(F.col("text")))
    blank = F.when(k10 == 3, F.lit("")).when(k10 == 5, F.lit("\u00a0"))
    uid = did.cast("string")
    notes = F.array(F.struct(uid.alias("uid"), desc.alias("description")),
                    F.struct(F.concat(F.lit("x"), uid).alias("uid"), blank.alias("description")))
    notes = F.when((k10 >= 3) & (k10 <= 5), notes).otherwise(F.slice(notes, 1, 1))
    tag_names = F.concat(
        F.split("text", "[ \n]") if text_tags else F.split(title, " "),
        F.array(F.element_at(_lits(IGNORED_TAGS), (did % 17 + 1).cast("int")),
                F.upper("lang"), F.lit(None).cast("string"), F.lit("ab1"), F.col("source")))
    cat_names = F.array(F.col("source"), F.col("lang"), F.col("source"), F.lit(None).cast("string"))
    as_named = lambda arr: F.transform(
        arr, lambda n: F.when(n.isNull(), F.lit(None)).otherwise(F.named_struct(F.lit("name"), n)))
    each = d.select(
        F.col("source").alias("category"),
        did.alias("pos"),
        name.alias("name"),
        as_named(tag_names).alias("tags"),
        as_named(cat_names).alias("categories"),
        F.explode(notes).alias("note"),
    )
    return each.select("note.uid", "category", "pos", "name", "note.description", "tags", "categories")


def annotations_sql(text_tags: bool = False) -> str:
    """DuckDB twin of :func:`annotations_from_documents` (tags as name lists)."""
    wd, mo, ig = _sql_list(WEEKDAY_NAMES), _sql_list(MONTH_NAMES), _sql_list(IGNORED_TAGS)
    words = ("string_split(replace(text, chr(10), ' '), ' ')" if text_tags
             else r"string_split(regexp_extract(text, '^([^\n]*)', 1), ' ')")
    return rf"""
  SELECT CASE WHEN copy = 1 THEN 'x' ELSE '' END || CAST(doc_id AS VARCHAR) AS uid, source AS category, doc_id AS pos,
    CASE doc_id % 8
      WHEN 0 THEN {wd}[doc_id % 7 + 1] || ', ' || CAST(doc_id % 28 + 1 AS VARCHAR) || ' '
                  || {mo}[doc_id % 12 + 1] || ' ' || CAST(doc_id % 25 + 2000 AS VARCHAR) || ' '
                  || lpad(CAST(doc_id % 24 AS VARCHAR), 2, '0') || ':'
                  || lpad(CAST(doc_id % 60 AS VARCHAR), 2, '0') || ':'
                  || lpad(CAST(doc_id * 7 % 60 AS VARCHAR), 2, '0')
      WHEN 1 THEN md5(text)
      WHEN 2 THEN concat_ws('-', substr(md5(text), 1, 8), substr(md5(text), 9, 4),
                  substr(md5(text), 13, 4), substr(md5(text), 17, 4), substr(md5(text), 21, 12))
      WHEN 3 THEN 'Newfields_Design-Gallery'
      WHEN 4 THEN NULL
      ELSE regexp_extract(text, '^([^\n]*)', 1) END AS name,
    CASE doc_id % 10 + 100 * copy
      WHEN 0 THEN text || ' Please  follow me on Facebook'
      WHEN 1 THEN 'See https://my-site.com/x-' || CAST(doc_id AS VARCHAR) || ' now. ' || text
      WHEN 2 THEN 'WWW.SHOP.COM/a_b ' || md5(text) || ' ' || text
      WHEN 103 THEN ''
      WHEN 104 THEN NULL
      WHEN 105 THEN chr(160)
      ELSE text END AS description,
    list_concat({words},
                [{ig}[doc_id % 17 + 1], upper(lang), NULL, 'ab1', source]) AS tags,
    [source, lang, source, NULL] AS categories
  FROM documents, (VALUES (0), (1)) copies(copy) WHERE copy = 0 OR doc_id % 10 BETWEEN 3 AND 5"""


# ---- DuckDB expression builders for the text rules (independent formulation) ----

def sql_clean_text(e: str) -> str:
    return f"trim(regexp_replace(translate(coalesce({e}, ''), '-_', '  '), '{WS}+', ' ', 'g'))"


_DATE_RE2 = (r"(?:mon|tue|wed|thu|fri|sat|sun)[\s,]+\p{Nd}{1,2}\s+"
             r"(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\s+\p{Nd}{4}"
             r"(?:[\s,]+\p{Nd}{1,2}(?:[:\s]\p{Nd}{2})(?:[:\s]\p{Nd}{2})?)?")


def sql_useful_clean(t: str) -> str:
    """F03 on an already-cleaned expression ``t``."""
    return (f"({t} <> '' AND lower({t}) NOT IN ('newfields design gallery', 'design gallery')"
            f" AND NOT (length(regexp_replace(lower({t}), '[^0-9a-f]', '', 'g')) >= 12"
            f" AND NOT contains({t}, ' '))"
            f" AND NOT regexp_full_match(lower({t}), '{_DATE_RE2}')"
            rf" AND length(regexp_replace({t}, '[^\p{{L}}]', '', 'g')) >= 3)")


_PROMO_RE2 = (r"(?i)(?:please\s+follow|follow\s+and\s+support|support\s+me|free\s+to\s+use|"
              r"click\s+here|facebook|search\s+page|publisher|asset\s+store|download\s+link).*")
_HEX_RE2 = r"(?i)(^|[^\p{L}\p{N}_])[0-9a-f]{12,}($|[^\p{L}\p{N}_])"


def sql_sanitize_steps(src: str, text_col: str, cat_col: str, keep: str) -> str:
    """T02 as a chain of CTE selects over ``src``; yields ``keep`` + description_raw."""
    return f"""
  s0 AS (SELECT {keep}, {cat_col} AS _cat, {sql_clean_text(text_col)} AS _t FROM {src}),
  s1 AS (SELECT *, regexp_replace(regexp_replace(_t, '(?i)https?://\\S+|www\\.\\S+', ' ', 'g'),
                  '{_PROMO_RE2}', ' ', 'g') AS _u FROM s0),
  s2 AS (SELECT *, regexp_replace(regexp_replace(_u, '{_HEX_RE2}', '\\1 \\2', 'g'),
                  '{_HEX_RE2}', '\\1 \\2', 'g') AS _v FROM s1),
  s3 AS (SELECT *, array_to_string(list_slice(string_split(
                  trim(regexp_replace(_v, ' +', ' ', 'g')), ' '), 1, 35), ' ') AS _w FROM s2),
  s4 AS (SELECT {keep}, CASE WHEN _t = '' OR _w = '' THEN coalesce(_cat, 'None') || ' furniture'
                        ELSE _w END AS description_raw FROM s3)"""


def sql_clean_description(e: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(lower(coalesce({e}, '')), '[^a-z0-9\\s-]', ' ', 'g'),"
            f" '\\s+', ' ', 'g'))")
