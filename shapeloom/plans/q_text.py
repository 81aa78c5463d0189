"""Text and catalog queries."""

from __future__ import annotations

import string

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.text import IGNORED_TAGS, WS
from ..operators import catalog as cat
from .derived import (annotations_from_documents, annotations_sql, sql_clean_description,
                      sql_clean_text, sql_sanitize_steps, sql_useful_clean)
from .registry import query, table


def _ignored_sql():
    return "(" + ", ".join("'" + t + "'" for t in IGNORED_TAGS) + ")"


@query("clean_description", "T03 P06", oracle=f"""
  SELECT doc_id, {sql_clean_description('text')} AS description FROM documents
""")
def q_clean_description(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", tx.clean_description("text").alias("description"))


@query("clean_text", "T01", oracle=f"""
  SELECT doc_id, {sql_clean_text('text')} AS cleaned FROM documents
""")
def q_clean_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", tx.clean_text("text").alias("cleaned"))


@query("useful_text", "F03 T12 T13", oracle=f"""
  WITH a AS ({annotations_sql()}),
  c AS (SELECT uid, {sql_clean_text('name')} AS name_clean,
               {sql_clean_text('description')} AS desc_clean FROM a)
  SELECT uid, name_clean,
         {sql_useful_clean('name_clean')} AS name_useful,
         {sql_useful_clean('desc_clean')} AS description_useful,
         CAST(len(list_filter(string_split(desc_clean, ' '),
                  lambda w: {sql_useful_clean('w')})) AS INTEGER) AS useful_words
  FROM c
""")
def q_useful_text(spark, sf_dir):
    a = annotations_from_documents(spark, sf_dir)
    c = a.select("uid", tx.clean_text("name").alias("name_clean"),
                 tx.clean_text("description").alias("desc"))
    # per-document checks run once per document, before the explode (in the
    # same select Catalyst would evaluate them after the Generate, once per word)
    per_doc = c.select("uid", "name_clean", "desc",
                       tx.is_useful_clean(F.col("name_clean")).alias("name_useful"),
                       tx.is_useful_clean(F.col("desc")).alias("description_useful"))
    keys = ["uid", "name_clean", "name_useful", "description_useful"]
    # one row per word (codegen'd check); a document's words sit in one task,
    # so the partial hash aggregate leaves one row per document for the shuffle
    words = per_doc.select(*keys, F.explode(F.split("desc", " ")).alias("w"))
    # the extra keys are functions of uid, so grouping on them changes nothing
    return words.groupBy(*keys).agg(
        F.count_if(tx.is_useful_clean(F.col("w"))).cast("int").alias("useful_words"))


@query("sanitize_description", "T02 L05", oracle=f"""
  WITH a AS ({annotations_sql()}), {sql_sanitize_steps('a', 'description', 'category', 'uid')}
  SELECT uid, description_raw FROM s4
""")
def q_sanitize_description(spark, sf_dir):
    a = annotations_from_documents(spark, sf_dir)
    c = a.select("uid", "category", tx.clean_text("description").alias("t"))
    return cat.add_sanitized(c, F.col("t"), "category", "description_raw").select("uid", "description_raw")


def _ordered_distinct(col: str) -> str:
    return f"list_filter({col}, lambda x, i: list_position({col}, x) = i)"


_BUILD_SQL = f"""
  WITH a AS ({annotations_sql()}),
  ann AS (SELECT a.* FROM a SEMI JOIN labels l ON a.pos = l.doc_id),
  m AS (SELECT category, pos, uid FROM a),
  j AS (SELECT m.uid, m.category, m.pos, ann.name, ann.description, ann.tags, ann.categories
        FROM m LEFT JOIN ann ON m.uid = ann.uid),
  f0 AS (SELECT uid, category, pos,
           list_filter([{sql_clean_text('name')}, {sql_clean_text('description')}],
                       lambda f: {sql_useful_clean('f')}) AS head,
           list_filter(list_transform(coalesce(tags, []::VARCHAR[]), lambda x: {sql_clean_text('x')}),
                       lambda f: {sql_useful_clean('f')} AND lower(f) NOT IN {_ignored_sql()}) AS tg,
           list_filter(list_transform(coalesce(categories, []::VARCHAR[]), lambda x: {sql_clean_text('x')}),
                       lambda f: {sql_useful_clean('f')}) AS ct
         FROM j),
  f1 AS (SELECT uid, category, pos, list_concat(head, {_ordered_distinct('tg')},
                                                {_ordered_distinct('ct')}) AS parts0 FROM f0),
  f2 AS (SELECT uid, category, pos,
           {sql_clean_text("array_to_string(" + _ordered_distinct('parts0') + ", ' ')")} AS t0 FROM f1),
  f3 AS (SELECT uid, category, pos,
           CASE WHEN t0 = '' THEN coalesce(category, 'None') || ' furniture' ELSE t0 END AS t1 FROM f2),
  {sql_sanitize_steps('f3', 't1', 'category', 'uid, category, pos')}
"""


@query("build_description", "T04 F04 F05 A14 U03 J01 P02", oracle=_BUILD_SQL + """
  SELECT uid, category, pos, description_raw FROM s4
""")
def q_build_description(spark, sf_dir):
    a = annotations_from_documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("pos"))
    ann = a.join(labels, "pos", "left_semi")
    return cat.category_metadata(a.select("category", "pos", "uid"), ann)


@query("clean_manifest", "T03 F02 W01", oracle=_BUILD_SQL + f""",
  c AS (SELECT ltrim(uid, 'x') AS uid, category, pos, description_raw,
               {sql_clean_description('description_raw')} AS description FROM s4)
  SELECT uid, category, pos, description_raw, description FROM c WHERE description <> ''
  QUALIFY row_number() OVER (PARTITION BY uid ORDER BY pos, description_raw) = 1
""")
def q_clean_manifest(spark, sf_dir):
    # a document's two annotations are rows of one uid: the first by text stays
    both = q_build_description(spark, sf_dir).withColumn("uid", F.ltrim("uid", F.lit("x")))
    return cat.clean_manifest(both, order=["pos", "description_raw"])


@query("dedupe_keep_first", "F02 W01", oracle=f"""
  WITH m AS (SELECT md5(text) AS uid, doc_id AS pos,
                    CASE WHEN doc_id % 7 = 0 THEN '?!' ELSE text END AS description_raw
             FROM documents),
  c AS (SELECT uid, pos, {sql_clean_description('description_raw')} AS description FROM m),
  f AS (SELECT * FROM c WHERE length(description) > 0)
  SELECT uid, pos, description FROM (
    SELECT *, row_number() OVER (PARTITION BY uid ORDER BY pos) AS rn FROM f) WHERE rn = 1
""")
def q_dedupe_keep_first(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    m = d.select(F.md5("text").alias("uid"), F.col("doc_id").alias("pos"),
                 F.when(F.col("doc_id") % 7 == 0, F.lit("?!")).otherwise(F.col("text"))
                 .alias("description_raw"))
    return cat.clean_manifest(m).select("uid", "pos", "description")


@query("category_rank", "A05 L02", oracle="""
  WITH s AS (SELECT source AS category, COUNT(*) AS n_uids, MIN(doc_id) AS cat_pos
             FROM documents GROUP BY source)
  SELECT category, n_uids, cat_pos,
         row_number() OVER (ORDER BY n_uids DESC, cat_pos) AS size_rank FROM s
""")
def q_category_rank(spark, sf_dir):
    return cat.category_sizes(_members(spark, sf_dir))


def _members(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("source").alias("category"), F.col("doc_id").alias("cat_pos"))


@query("largest_category", "L03 A05", oracle="""
  SELECT source AS category, COUNT(*) AS n_uids, MIN(doc_id) AS cat_pos
  FROM documents GROUP BY source ORDER BY n_uids DESC, cat_pos LIMIT 1
""")
def q_largest_category(spark, sf_dir):
    return cat.largest_category(_members(spark, sf_dir))


@query("limit_per_category", "W02 W03 L01 J04", oracle="""
  SELECT category, pos, uid FROM (
    SELECT source AS category, CAST(doc_id AS VARCHAR) AS uid,
           row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos
    FROM documents) WHERE pos < 10
""")
def q_limit_per_category(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(
        F.col("source").alias("category"), "doc_id", F.col("doc_id").cast("string").alias("uid"))
    return cat.first_per_category(d, 10, ["doc_id"]).select("category", "pos", "uid")


@query("tokenize_counts", "T06", oracle="""
  WITH t AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9-]+') AS toks
             FROM documents)
  SELECT doc_id, CASE WHEN len(toks) = 0 THEN 1 ELSE len(toks) END AS n_tokens,
         CASE WHEN len(toks) = 0 THEN 1 ELSE len(list_distinct(toks)) END AS n_distinct
  FROM t
""")
def q_tokenize_counts(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    toks = tx.tokenize("text")
    return d.select("doc_id", F.size(toks).alias("n_tokens"),
                    F.size(F.array_distinct(toks)).alias("n_distinct"))


#: Stop words of the query, on both sides (the operator's default is Spark's list).
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or",
              "that", "the", "this", "to", "was", "were", "with"]


def _notebook_sql() -> str:
    stops = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
    punct = string.punctuation.replace("'", "''")
    return f"""
  WITH a AS ({annotations_sql(text_tags=True)}),
  t AS (SELECT uid, array_to_string(tags, ' ') AS tag_text FROM a WHERE len(coalesce(tags, [])) > 0),
  p AS (SELECT uid, trim(regexp_replace(translate(tag_text, '{punct}', ''), '{WS}+', ' ', 'g')) AS s FROM t),
  w AS (SELECT uid, list_filter(string_split(s, ' '), lambda x: x <> '' AND NOT list_contains({stops}, x))
                 AS kept FROM p)
  SELECT uid, lower(array_to_string(kept, ' ')) AS description FROM w
  WHERE lower(array_to_string(kept, ' ')) <> ''
"""


@query("notebook_descriptions", "T14 T15 F17 F18", oracle=_notebook_sql())
def q_notebook_descriptions(spark, sf_dir):
    return cat.notebook_descriptions(annotations_from_documents(spark, sf_dir, text_tags=True), stop_words=STOP_WORDS)


def _glb_paths(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    shard = F.format_string("%03d-%03d", (F.col("page_id") % 160).cast("int"), (F.col("page_id") % 7).cast("int"))
    return p.select(F.concat(F.lit("/assets/glbs/"), shard, F.lit("/"), F.col("page_id").cast("string"),
                             F.lit(".glb")).alias("path"))


@query("inventory_stems", "T10 T11 J07 S05", oracle=f"""
  WITH g AS (SELECT '/assets/glbs/' || printf('%03d-%03d', page_id % 160, page_id % 7) || '/'
                    || CAST(page_id AS VARCHAR) || '.glb' AS path FROM pages),
  s AS (SELECT path, regexp_replace(path, '\\d{{3}}-\\d{{3}}/', '', 'g') AS stripped,
               split_part(regexp_extract(path, '([^/]*)$', 1), '.glb', 1) AS stem FROM g)
  SELECT s.path, s.stripped, s.stem, d.source AS category,
         {sql_clean_description('d.text')} AS description
  FROM s LEFT JOIN documents d ON CAST(d.doc_id AS VARCHAR) = s.stem
""")
def q_inventory_stems(spark, sf_dir):
    g = _glb_paths(spark, sf_dir)
    s = g.select("path", tx.strip_shard("path").alias("stripped"), tx.path_stem("path").alias("stem"))
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("stem"),
                                                 F.col("source").alias("category"),
                                                 tx.clean_description("text").alias("description"))
    return s.join(d, "stem", "left").select("path", "stripped", "stem", "category", "description")
