"""Training-data, build-split and prompt queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog as cat
from ..operators import quality as q
from ..operators import scoring as sc
from ..operators import training as tr
from ..operators import voxels as vx
from .build import asset_split
from .q_voxels import _CELLS_SQL
from .registry import query, table

ROUND = 6


@query("training_view", "X01 J03 V13 V08", oracle=f"""
  WITH {_CELLS_SQL},
  n AS (SELECT i AS doc_id, COUNT(c.uid) AS n_occupied
        FROM a LEFT JOIN c ON a.uid = c.uid GROUP BY i)
  SELECT l.doc_id AS uid, n.n_occupied, CAST(len(e.embedding) AS INTEGER) AS text_dim,
         round(list_sum(list_transform(e.embedding, lambda v: CAST(v AS DOUBLE))), 6) AS embedding_sum
  FROM labels l JOIN n ON n.doc_id = l.doc_id JOIN embeddings e ON e.vec_id = l.doc_id
""")
def q_training_view(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("uid"))
    ids = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    ids = ids.join(labels.select(F.col("uid").alias("id")), "id", "left_semi")
    assets = cat.synthetic_manifest(ids)
    cells = vx.shape_cells(vx.by_key(assets, "i"), key="i").withColumnRenamed("i", "uid")
    emb = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("uid"), "embedding")
    v = tr.training_view(labels, cells, emb, strict=False)
    esum = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return v.select("uid", F.size(F.array_remove("voxels", 0.0)).cast("long").alias("n_occupied"),
                    F.size("embedding").alias("text_dim"), F.round(esum, ROUND).alias("embedding_sum"))


_BATCH_SQL = """
  ep AS (SELECT e.vec_id, e.label, e.embedding, s.epoch FROM embeddings e, range(1, 4) s(epoch)),
  rk AS (SELECT epoch, vec_id, label, embedding,
                row_number() OVER (PARTITION BY epoch
                                   ORDER BY md5(CAST(vec_id AS VARCHAR) || ':42:' || CAST(epoch AS VARCHAR)),
                                            vec_id) AS rn
         FROM ep),
  mb AS (SELECT epoch, vec_id, label, embedding, rn, (rn - 1) // 16 AS batch FROM rk)"""


def _batches(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return tr.minibatches(e, batch_size=16, seed=42, epochs=3, key="vec_id", hasher="md5"), e


@query("minibatches", "W04 X02 L08", oracle=f"""
  WITH {_BATCH_SQL}
  SELECT CAST(epoch AS INTEGER) AS epoch, vec_id, rn, batch FROM mb
""")
def q_minibatches(spark, sf_dir):
    b, _ = _batches(spark, sf_dir)
    return b.select(F.col("epoch").cast("int"), "vec_id", "rn", "batch")


def _bce_sql(y, p):
    return (f"-(({y}) * greatest(CASE WHEN {p} > 0 THEN ln({p}) END, -100) + (1 - ({y})) * "
            f"greatest(CASE WHEN {p} < 1 THEN ln(1 - {p}) END, -100))")


@query("epoch_metrics", "A06 X04 M06 P09", oracle=f"""
  WITH {_BATCH_SQL},
  r AS (SELECT epoch, batch, CAST(label % 2 AS DOUBLE) AS y,
               1.0 / (1.0 + exp(-list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE))))) AS p FROM mb),
  bl AS (SELECT epoch, batch, avg({_bce_sql('1.0', 'p')}) AS generator_loss,
                avg(({_bce_sql('y', 'p')} + {_bce_sql('1.0 - y', 'p')}) / 2) AS discriminator_loss
         FROM r GROUP BY epoch, batch)
  SELECT CAST(epoch AS INTEGER) AS epoch, round(avg(generator_loss), 6) AS generator_loss,
         round(avg(discriminator_loss), 6) AS discriminator_loss, COUNT(*) AS batches
  FROM bl GROUP BY epoch
""")
def q_epoch_metrics(spark, sf_dir):
    b, e = _batches(spark, sf_dir)
    rows = b.join(e.select("vec_id", "label", "embedding"), "vec_id")
    p = tr.sigmoid(F.aggregate("embedding", F.lit(0.0), lambda acc, v: acc + v.cast("double")))
    y = (F.col("label") % 2).cast("double")
    r = rows.select("epoch", "batch", y.alias("y"), p.alias("p"))
    one = F.lit(1.0)
    losses = r.select("epoch", "batch", tr.bce(one, F.col("p")).alias("generator_loss"),
                      ((tr.bce(F.col("y"), F.col("p")) + tr.bce(one - F.col("y"), F.col("p"))) / 2)
                      .alias("discriminator_loss"))
    m = tr.epoch_metrics(tr.batch_means(losses, ["generator_loss", "discriminator_loss"]))
    return m.select(F.col("epoch").cast("int"), F.round("generator_loss", ROUND).alias("generator_loss"),
                    F.round("discriminator_loss", ROUND).alias("discriminator_loss"), "batches")


@query("log_loss", "A07 X05", oracle=f"""
  WITH s AS (SELECT toxic, CAST(quality AS DOUBLE) AS y,
                    CASE doc_id % 4 WHEN 0 THEN 0.0 WHEN 1 THEN 1.0
                         ELSE CAST(doc_id % 100 AS DOUBLE) / 100.0 END AS p FROM labels)
  SELECT toxic, COUNT(*) AS n, round(avg({_bce_sql('y', 'p')}), 6) AS log_loss FROM s GROUP BY toxic
""")
def q_log_loss(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    k = F.col("doc_id") % 4
    p = (F.when(k == 0, F.lit(0.0)).when(k == 1, F.lit(1.0))
         .otherwise((F.col("doc_id") % 100).cast("double") / 100.0))
    s = lab.select("toxic", F.col("quality").cast("double").alias("label"), p.alias("p"))
    r = tr.log_loss(s, ["toxic"])
    return r.select("toxic", "n", F.round("log_loss", ROUND).alias("log_loss"))


def _prompts(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    t = F.col("turn")
    prompt = F.when(t % 5 == 1, F.lit("   ")).otherwise(F.col("text"))
    thr = (F.when(F.col("conv_id") % 7 == 0, F.lit(0.0)).when(F.col("conv_id") % 7 == 1, F.lit(1.0))
           .when(F.col("conv_id") % 7 == 2, F.lit(None)).otherwise(F.lit(0.25)))
    return c.select(F.concat_ws("-", F.col("conv_id").cast("string"), t.cast("string")).alias("prompt_id"),
                    prompt.alias("prompt"), F.col("conv_id").cast("int").alias("seed"),
                    thr.cast("double").alias("threshold"))


_PROMPTS_SQL = r"""
  pr AS (SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS prompt_id,
                CASE WHEN turn % 5 = 1 THEN '   ' ELSE text END AS prompt,
                coalesce(CASE WHEN conv_id % 7 = 0 THEN 0.0 WHEN conv_id % 7 = 1 THEN 1.0
                              WHEN conv_id % 7 = 2 THEN NULL ELSE 0.25 END, 0.5) AS threshold
         FROM conversations WHERE role = 'user'),
  pv AS (SELECT *, CASE WHEN prompt IS NULL OR length(prompt) < 1
                          THEN 'prompt: String should have at least 1 character'
                        WHEN length(prompt) > 300 THEN 'prompt: String should have at most 300 characters'
                        WHEN threshold <= 0 THEN 'threshold: Input should be greater than 0'
                        WHEN threshold >= 1 THEN 'threshold: Input should be less than 1'
                        WHEN regexp_full_match(prompt, '\s*') THEN 'Prompt must not be empty' END AS reason,
                   coalesce(nullif(left(regexp_replace(regexp_replace(lower(prompt), '[^a-z0-9]+', '-', 'g'),
                                                       '^-+|-+$', '', 'g'), 40), ''), 'shape') AS stem
         FROM pr)"""


@query("prompt_validation", "F11 F12 T08 T09 P08 L06", oracle=f"""
  WITH {_PROMPTS_SQL}
  SELECT prompt_id, threshold, reason, stem,
         stem || '-' || substr(md5(prompt_id), 1, 8) || '.obj' AS filename,
         '/meshes/' || stem || '-' || substr(md5(prompt_id), 1, 8) || '.obj' AS download_url
  FROM pv
""")
def q_prompt_validation(spark, sf_dir):
    v = sc.publish_names(sc.validate_prompts(_prompts(spark, sf_dir)))
    return v.select("prompt_id", "threshold", "reason", "stem", "filename", "download_url")


@query("mesh_lookup", "X09 F20", oracle=f"""
  WITH {_PROMPTS_SQL},
  inv AS (SELECT DISTINCT stem || '-' || substr(md5(prompt_id), 1, 8) || '.obj' AS safe_name
          FROM pv WHERE reason IS NULL),
  req AS (SELECT CASE WHEN length(prompt_id) % 2 = 0 THEN '../../' || f ELSE 'x' || f END AS request
          FROM (SELECT prompt_id, stem || '-' || substr(md5(prompt_id), 1, 8) || '.obj' AS f FROM pv)),
  rq AS (SELECT request, regexp_extract(request, '([^/]*)$', 1) AS safe_name FROM req)
  SELECT rq.request, rq.safe_name, (inv.safe_name IS NOT NULL) AS found
  FROM rq LEFT JOIN inv ON rq.safe_name = inv.safe_name
""")
def q_mesh_lookup(spark, sf_dir):
    v = sc.publish_names(sc.validate_prompts(_prompts(spark, sf_dir)))
    inv = v.where(F.col("reason").isNull()).select("filename")
    req = v.select(F.when(F.length("prompt_id") % 2 == 0, F.concat(F.lit("../../"), F.col("filename")))
                   .otherwise(F.concat(F.lit("x"), F.col("filename"))).alias("filename"))
    return sc.mesh_lookup(req, inv)


def _split(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    clean = cat.clean_manifest(d.select(F.col("doc_id").cast("string").alias("uid"),
                                        F.col("source").alias("category"), F.col("doc_id").alias("pos"),
                                        F.col("text").alias("description_raw")))
    pages = table(spark, sf_dir, "pages")
    files = pages.select(F.col("page_id").cast("string").alias("uid"),
                         F.when(F.col("url").endswith("#top"), F.lit("")).otherwise(F.col("url"))
                         .alias("mesh_path"))
    bounds = pages.select(F.col("page_id").cast("string").alias("uid"),
                          F.size(F.split("html", "<p>")).cast("long").alias("n_points"),
                          ((F.length("html") % 7).cast("double")).alias("max_extent"))
    bounds = bounds.withColumn("n_points", F.col("n_points") - 1)
    return asset_split(clean, files, bounds)


_SPLIT_SQL = r"""
  cl AS (SELECT CAST(doc_id AS VARCHAR) AS uid FROM documents
         WHERE length(trim(regexp_replace(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9\s-]', ' ', 'g'),
                                          '\s+', ' ', 'g'))) > 0),
  fl AS (SELECT CAST(page_id AS VARCHAR) AS uid, CASE WHEN suffix(url, '#top') THEN '' ELSE url END AS mesh_path,
                len(string_split(html, '<p>')) - 1 AS n_points, CAST(length(html) % 7 AS DOUBLE) AS max_extent
         FROM pages),
  sp AS (SELECT cl.uid, fl.mesh_path,
                CASE WHEN coalesce(fl.mesh_path, '') = '' THEN 'download_missing'
                     WHEN coalesce(fl.n_points, 0) = 0 THEN 'ValueError: Empty mesh: ' || fl.mesh_path
                     WHEN fl.max_extent <= 0 THEN 'ValueError: Degenerate mesh: ' || fl.mesh_path END AS reason
         FROM cl LEFT JOIN fl ON cl.uid = fl.uid)"""


@query("asset_split", "J02 F07 F08 F13 T17 U04", oracle=f"""
  WITH {_SPLIT_SQL}
  SELECT uid, mesh_path, reason FROM sp
""")
def q_asset_split(spark, sf_dir):
    return _split(spark, sf_dir).select("uid", "mesh_path", "reason")


@query("failure_summary", "Q05 K04", oracle=f"""
  WITH {_SPLIT_SQL}
  SELECT split_part(reason, ':', 1) AS reason_kind, COUNT(*) AS n_assets
  FROM sp WHERE reason IS NOT NULL GROUP BY 1
""")
def q_failure_summary(spark, sf_dir):
    s = _split(spark, sf_dir)
    return q.failure_summary(s.where(F.col("reason").isNotNull()))


@query("loss_curves", "X06 X11 K09 P09", oracle=f"""
  WITH {_BATCH_SQL},
  r AS (SELECT epoch, batch, CAST(label % 2 AS DOUBLE) AS y,
               1.0 / (1.0 + exp(-list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE))))) AS p FROM mb),
  bl AS (SELECT epoch, batch, avg({_bce_sql('1.0', 'p')}) AS generator_loss,
                avg(({_bce_sql('y', 'p')} + {_bce_sql('1.0 - y', 'p')}) / 2) AS discriminator_loss
         FROM r GROUP BY epoch, batch),
  em AS (SELECT epoch, avg(generator_loss) AS g, avg(discriminator_loss) AS d FROM bl GROUP BY epoch)
  SELECT 'run-1' AS run_id, CAST(epoch - 1 AS INTEGER) AS step, round(g, 6) AS generator_loss,
         round(d, 6) AS discriminator_loss
  FROM em
""")
def q_loss_curves(spark, sf_dir):
    m = q_epoch_metrics(spark, sf_dir)
    runs = tr.metrics_frame(m, "run-1")
    return tr.loss_curves(runs).select("run_id", "step", "generator_loss", "discriminator_loss")


@query("train_split", "R01", oracle="""
  WITH p AS (SELECT doc_id, ('0x' || substr(md5('42:' || coalesce(text, '')), 1, 8))::BIGINT / 4294967296.0 AS place FROM documents)
  SELECT doc_id, CASE WHEN place < 0.8 THEN 'train' WHEN place < 0.9 THEN 'validation' ELSE 'test' END AS split FROM p
""")
def q_train_split(spark, sf_dir):
    """Copies of a text stay in one split."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tr.split_rows(d, "text", {"train": 0.8, "validation": 0.1, "test": 0.1}).select("doc_id", "split")
