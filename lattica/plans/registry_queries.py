"""Registry algebra: merging, pending work, cascades, statistics, shards."""

from __future__ import annotations

from pyspark.sql import functions as F

from lattica.operators import numbering, registry
from lattica.plans import views
from lattica.plans.catalog import query


@query(
    """SELECT count(*) AS n_assets, count(m.local_path) AS n_downloaded, count(m.aesthetic_score) AS n_scored,
    count(*) FILTER (WHERE m.mesh_dumped) AS n_mesh, count(*) FILTER (WHERE m.pbr_dumped) AS n_pbr, count(*) FILTER (WHERE m.mesh_dumped IS DISTINCT FROM true) AS n_pending,
    CAST(sum(m.num_faces) AS BIGINT) AS faces, CAST(sum(m.pbr_latent_tokens) AS BIGINT) AS tokens,
    count(*) FILTER (WHERE coalesce(m.aesthetic_score >= 5, false)) AS n_good
    FROM (SELECT coalesce(a.sha256, s.sha256) AS sha256, a.local_path, a.aesthetic_score, a.num_faces, s.pbr_dumped, s.pbr_latent_tokens,
          coalesce(a.mesh_dumped, s.mesh_dumped) AS mesh_dumped FROM v_asset a FULL JOIN v_stage s ON a.sha256 = s.sha256) m"""
)
def registry_statistics(spark, sf_dir):
    merged = registry.combine_first(views.assets(spark, sf_dir), views.stages(spark, sf_dir), "sha256")
    return merged.agg(
        F.count("*").alias("n_assets"),
        F.count("local_path").alias("n_downloaded"),
        F.count("aesthetic_score").alias("n_scored"),
        F.count_if("mesh_dumped").alias("n_mesh"),
        F.count_if("pbr_dumped").alias("n_pbr"),
        F.count_if(registry.pending("mesh_dumped")).alias("n_pending"),
        F.sum("num_faces").alias("faces"),
        F.sum("pbr_latent_tokens").alias("tokens"),
        F.count_if(registry.at_least("aesthetic_score", 5)).alias("n_good"),
    )


@query(
    """SELECT coalesce(a.sha256, s.sha256) AS sha256, a.dataset, a.lang, a.num_faces, a.aesthetic_score, a.local_path,
    coalesce(a.mesh_dumped, s.mesh_dumped) AS mesh_dumped, s.pbr_dumped, s.pbr_latent_tokens FROM v_asset a FULL JOIN v_stage s ON a.sha256 = s.sha256"""
)
def combine_first_pair(spark, sf_dir):
    return registry.combine_first(views.assets(spark, sf_dir), views.stages(spark, sf_dir), "sha256")


@query(
    """SELECT k.sha256, coalesce(s.mesh_dumped, a.mesh_dumped) AS mesh_dumped, s.pbr_latent_tokens, a.num_faces, coalesce(a.local_path, l.local_path) AS local_path
    FROM (SELECT sha256 FROM v_asset UNION SELECT sha256 FROM v_stage) k LEFT JOIN v_stage s ON k.sha256 = s.sha256 LEFT JOIN v_asset a ON k.sha256 = a.sha256
    LEFT JOIN (SELECT sha256, 'late/' || lang AS local_path FROM v_asset) l ON k.sha256 = l.sha256"""
)
def combine_first_nway(spark, sf_dir):
    a = views.assets(spark, sf_dir)
    late = a.select("sha256", F.concat(F.lit("late/"), "lang").alias("local_path"))
    return registry.combine_first_many([views.stages(spark, sf_dir).drop("pbr_dumped"), a.select("sha256", "mesh_dumped", "num_faces", "local_path"), late], "sha256").select(
        "sha256", "mesh_dumped", "pbr_latent_tokens", "num_faces", "local_path"
    )


@query(
    """SELECT asset_id, arg_max(c_click, seq) FILTER (WHERE c_click IS NOT NULL) AS c_click, arg_max(c_view, seq) FILTER (WHERE c_view IS NOT NULL) AS c_view
    FROM v_record GROUP BY asset_id"""
)
def upsert_latest_nonnull(spark, sf_dir):
    return registry.upsert(views.records(spark, sf_dir), "asset_id", "seq")


@query("SELECT sha256, num_faces FROM v_asset WHERE mesh_dumped IS DISTINCT FROM true AND local_path IS NOT NULL")
def pending_assets(spark, sf_dir):
    return views.assets(spark, sf_dir).filter(registry.pending("mesh_dumped") & F.col("local_path").isNotNull()).select("sha256", "num_faces")


@query(
    """SELECT sha256, mesh_dumped_256, mesh_dumped_512 FROM (SELECT sha256, mesh_dumped AS mesh_dumped_256, num_faces % 2 = 0 AS mesh_dumped_512 FROM v_asset)
    WHERE mesh_dumped_256 IS DISTINCT FROM true OR mesh_dumped_512 IS DISTINCT FROM true"""
)
def pending_multi_resolution(spark, sf_dir):
    a = views.assets(spark, sf_dir).select("sha256", F.col("mesh_dumped").alias("mesh_dumped_256"), (F.col("num_faces") % 2 == 0).alias("mesh_dumped_512"))
    return a.filter(registry.pending_any(a, [f"mesh_dumped_{r}" for r in (256, 512)]))


@query("SELECT sha256, mesh_dumped FROM v_asset")
def pending_missing_column(spark, sf_dir):
    """A resolution without a column keeps every row."""
    a = views.assets(spark, sf_dir).select("sha256", "mesh_dumped")
    return a.filter(registry.pending_any(a, ["mesh_dumped", "mesh_dumped_1024"]))


@query("SELECT sha256, aesthetic_score FROM v_asset WHERE coalesce(aesthetic_score >= 5, false) AND num_faces <= 4000")
def score_and_cap_filter(spark, sf_dir):
    return views.assets(spark, sf_dir).filter(registry.at_least("aesthetic_score", 5) & (F.col("num_faces") <= 4000)).select("sha256", "aesthetic_score")


@query("SELECT doc_id, score FROM (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN CAST('NaN' AS DOUBLE) WHEN doc_id % 4 = 1 THEN NULL ELSE CAST(doc_id % 10 AS DOUBLE) END AS score FROM documents) WHERE NOT isnan(score) AND score >= 5")
def nan_threshold(spark, sf_dir):
    d = views.load(spark, sf_dir, "documents")
    score = F.when(F.col("doc_id") % 4 == 0, float("nan")).when(F.col("doc_id") % 4 != 1, (F.col("doc_id") % 10).cast("double"))
    return d.select("doc_id", score.alias("score")).filter(registry.at_least("score", 5))


@query("SELECT a.sha256, a.dataset FROM v_asset a WHERE EXISTS (SELECT 1 FROM v_stage s WHERE s.sha256 = a.sha256 AND s.pbr_latent_tokens < 32)")
def instances_semi(spark, sf_dir):
    wanted = views.stages(spark, sf_dir).filter("pbr_latent_tokens < 32")
    return views.assets(spark, sf_dir).join(wanted, "sha256", "left_semi").select("sha256", "dataset")


@query("SELECT a.sha256, a.dataset FROM v_asset a WHERE NOT EXISTS (SELECT 1 FROM v_stage s WHERE s.sha256 = a.sha256 AND s.mesh_dumped)")
def done_anti(spark, sf_dir):
    finished = views.stages(spark, sf_dir).filter(registry.done("mesh_dumped"))
    return views.assets(spark, sf_dir).join(finished, "sha256", "left_anti").select("sha256", "dataset")


@query("SELECT a.sha256, a.lang, s.pbr_latent_tokens FROM v_asset a JOIN v_stage s ON a.sha256 = s.sha256")
def key_lookup(spark, sf_dir):
    return views.assets(spark, sf_dir).join(views.stages(spark, sf_dir), "sha256").select("sha256", "lang", "pbr_latent_tokens")


@query("SELECT sha256, mesh_dumped, pbr_dumped FROM v_stage WHERE mesh_dumped OR pbr_dumped")
def stage_disjunction(spark, sf_dir):
    return views.stages(spark, sf_dir).filter(registry.done("mesh_dumped") | registry.done("pbr_dumped")).select("sha256", "mesh_dumped", "pbr_dumped")


@query(
    """WITH m AS (SELECT local_path IS NOT NULL AS p1, coalesce(aesthetic_score >= 4.5, false) AS p2, mesh_dumped IS NOT DISTINCT FROM true AS p3, num_faces <= 5000 AS p4 FROM v_asset)
    SELECT 0 AS step, 'all' AS name, count(*) AS n FROM m UNION ALL SELECT 1, 'downloaded', count(*) FILTER (WHERE p1) FROM m UNION ALL SELECT 2, 'score', count(*) FILTER (WHERE p1 AND p2) FROM m
    UNION ALL SELECT 3, 'mesh', count(*) FILTER (WHERE p1 AND p2 AND p3) FROM m UNION ALL SELECT 4, 'faces', count(*) FILTER (WHERE p1 AND p2 AND p3 AND p4) FROM m"""
)
def filter_cascade_counts(spark, sf_dir):
    return registry.cascade_counts(
        views.assets(spark, sf_dir),
        [("downloaded", F.col("local_path").isNotNull()), ("score", registry.at_least("aesthetic_score", 4.5)), ("mesh", registry.done("mesh_dumped")), ("faces", F.col("num_faces") <= 5000)],
    )


@query("SELECT sha256, pbr_latent_tokens FROM v_stage WHERE mesh_dumped AND pbr_latent_tokens % 2 > 0 AND pbr_latent_tokens % 3 > 0 AND pbr_latent_tokens % 5 > 0")
def full_pbr_filter(spark, sf_dir):
    """All texture counts above zero."""
    counts = {f"num_tex_{k}": F.col("pbr_latent_tokens") % k for k in (2, 3, 5)}
    s = views.stages(spark, sf_dir).withColumns(counts).filter(registry.done("mesh_dumped"))
    for c in counts:
        s = s.filter(F.col(c) > 0)
    return s.select("sha256", "pbr_latent_tokens")


@query("SELECT dataset, lang, mesh_dumped_512, num_faces_512 FROM (SELECT dataset, lang, mesh_dumped AS mesh_dumped_512, num_faces AS num_faces_512 FROM v_asset)")
def resolution_rename(spark, sf_dir):
    return views.assets(spark, sf_dir).withColumnsRenamed({c: f"{c}_512" for c in ("mesh_dumped", "num_faces")}).select("dataset", "lang", "mesh_dumped_512", "num_faces_512")


@query(
    """SELECT sha256, CASE WHEN error IS NULL THEN 'ok' ELSE 'error' END AS part, error FROM
    (SELECT sha256, CASE WHEN local_path IS NULL THEN 'no file' WHEN num_faces > 5000 THEN 'too large' END AS error FROM v_asset)"""
)
def error_split(spark, sf_dir):
    a = views.assets(spark, sf_dir).select("sha256", F.when(F.col("local_path").isNull(), "no file").when(F.col("num_faces") > 5000, "too large").alias("error"))
    good, bad = registry.split_errors(a)
    return good.select("sha256", F.lit("ok").alias("part"), F.lit(None).cast("string").alias("error")).unionAll(bad.select("sha256", F.lit("error").alias("part"), "error"))


@query("SELECT sha256, dataset, mesh_dumped, NULL::BIGINT AS pbr_latent_tokens FROM v_asset UNION ALL SELECT sha256, NULL, mesh_dumped, pbr_latent_tokens FROM v_stage")
def union_missing_columns(spark, sf_dir):
    a = views.assets(spark, sf_dir).select("sha256", "dataset", "mesh_dumped")
    return a.unionByName(views.stages(spark, sf_dir).drop("pbr_dumped"), allowMissingColumns=True)


@query(
    """SELECT dataset, count(*) AS n, count(DISTINCT lang) AS langs, count(local_path) AS files, CAST(sum(num_faces) AS BIGINT) AS faces, max(num_faces) AS most,
    round(avg(aesthetic_score), 4) AS score FROM v_asset GROUP BY dataset"""
)
def dataset_summary(spark, sf_dir):
    return views.assets(spark, sf_dir).groupBy("dataset").agg(
        F.count("*").alias("n"), F.countDistinct("lang").alias("langs"), F.count("local_path").alias("files"), F.sum("num_faces").alias("faces"), F.max("num_faces").alias("most"), F.round(F.avg("aesthetic_score"), 4).alias("score")
    )


@query(
    """SELECT conv_id, len(o) AS num_objects, CAST(list_sum(list_transform(o, lambda x: x.v)) AS BIGINT) AS num_vertices, len(list_filter(o, lambda x: x.v = 0)) AS num_empty FROM
    (SELECT conv_id, list({'v': coalesce(length(text), 0), 'r': role} ORDER BY turn) AS o FROM conversations GROUP BY conv_id)"""
)
def asset_nested_stats(spark, sf_dir):
    """Counts over nested objects of an asset (conversations stand for dumps, turns for objects)."""
    c = views.load(spark, sf_dir, "conversations")
    nested = c.groupBy("conv_id").agg(F.collect_list(F.struct(F.coalesce(F.length("text"), F.lit(0)).alias("v"), F.col("role").alias("r"))).alias("objects"))
    return nested.select(
        "conv_id",
        F.size("objects").cast("long").alias("num_objects"),
        F.aggregate("objects", F.lit(0).cast("long"), lambda a, o: a + o["v"]).alias("num_vertices"),
        F.size(F.filter("objects", lambda o: o["v"] == 0)).cast("long").alias("num_empty"),
    )


@query("SELECT sha256, num_faces FROM (SELECT *, row_number() OVER (ORDER BY sha256) - 1 AS i, count(*) OVER () AS n FROM v_asset) WHERE i >= n * 2 // 7 AND i < n * 3 // 7")
def shard_slice(spark, sf_dir):
    return numbering.shard_slice(views.assets(spark, sf_dir).select("sha256", "num_faces"), "sha256", 2, 7)


@query(
    """SELECT sha256, CAST(r.range AS INT) AS rank FROM (SELECT sha256, row_number() OVER (ORDER BY sha256) - 1 AS i, count(*) OVER () AS n FROM v_asset) a, range(7) r
    WHERE i >= n * r.range // 7 AND i < n * (r.range + 1) // 7"""
)
def shard_ranks(spark, sf_dir):
    return numbering.shard_bounds(views.assets(spark, sf_dir).select("sha256"), "sha256", 7)


@query(
    """WITH a AS (SELECT sha256, row_number() OVER (ORDER BY sha256) - 1 AS i, count(*) OVER () AS n FROM v_asset),
    p AS (SELECT sha256, i FROM a UNION ALL SELECT sha256, i + n FROM a WHERE i + n < (n + 6) // 7 * 7) SELECT sha256, CAST(i % 7 AS INT) AS rank, CAST(i // 7 AS BIGINT) AS slot FROM p"""
)
def shard_strided_padded(spark, sf_dir):
    return numbering.strided(views.assets(spark, sf_dir).select("sha256"), "sha256", 7, pad=True)


@query(
    """WITH a AS (SELECT sha256, row_number() OVER (ORDER BY sha256) - 1 AS i, count(*) OVER () AS n FROM v_asset)
    SELECT sha256, CAST(i % 7 AS INT) AS rank, CAST(i // 7 AS BIGINT) AS slot FROM a WHERE i < n // 7 * 7"""
)
def shard_strided_dropped(spark, sf_dir):
    return numbering.strided(views.assets(spark, sf_dir).select("sha256"), "sha256", 7, pad=False)


@query("SELECT part, count(*) AS n FROM (SELECT CAST(r.range AS INT) AS part FROM (SELECT row_number() OVER (ORDER BY sha256) - 1 AS i, count(*) OVER () AS n FROM v_asset) a, range(9) r WHERE i >= n * r.range // 9 AND i < n * (r.range + 1) // 9) GROUP BY part")
def micro_batch_sizes(spark, sf_dir):
    return numbering.micro_batches(views.assets(spark, sf_dir).select("sha256"), "sha256", 9).groupBy("part").agg(F.count("*").alias("n"))


@query()
def epoch_shuffle(spark, sf_dir):
    """Order by a hash of key and epoch; other engines hash differently."""
    return numbering.epoch_order(views.assets(spark, sf_dir).select("sha256"), "sha256", 17, 3)


@query("SELECT CAST(max(CAST(regexp_extract(f, 'step([0-9]+)\\.pt$', 1) AS BIGINT)) AS BIGINT) AS latest FROM (SELECT concat('ckpt/model_step', CAST(event_id * 10 AS VARCHAR), '.pt') AS f FROM events)")
def latest_checkpoint(spark, sf_dir):
    files = views.load(spark, sf_dir, "events").select(F.concat(F.lit("ckpt/model_step"), (F.col("event_id") * 10).cast("string"), F.lit(".pt")).alias("f"))
    return files.agg(F.max(F.regexp_extract("f", r"step([0-9]+)\.pt$", 1).cast("long")).alias("latest"))


@query("SELECT p.page_id, regexp_extract(p.url, '^([a-z]+)://', 1) AS scheme, split_part(p.url, '/', 3) AS host, sha256(p.html) AS sha256 FROM pages p")
def content_hash(spark, sf_dir):
    p = views.load(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("url", "^([a-z]+)://", 1).alias("scheme"), F.split_part("url", F.lit("/"), F.lit(3)).alias("host"), F.sha2(F.col("html").cast("binary"), 256).alias("sha256"))


@query(
    """SELECT CAST(a.vec_id AS BIGINT) AS vec_id, a.pos, round(CAST(a.v AS DOUBLE), 6) AS shape, round(CAST(b.v AS DOUBLE), 6) AS pbr FROM
    (SELECT vec_id, unnest(range(64)) AS pos, unnest(embedding) AS v FROM embeddings) a JOIN (SELECT vec_id, 63 - unnest(range(64)) AS pos, unnest(embedding) AS v FROM embeddings) b
    ON a.vec_id = b.vec_id AND a.pos = b.pos WHERE a.vec_id % 10 < 10"""
)
def aligned_coords_join(spark, sf_dir):
    """Two latents with one set of coordinates; a coordinate that one side lacks fails the query."""
    e = views.load(spark, sf_dir, "embeddings")
    a = e.select("vec_id", F.posexplode("embedding").alias("pos", "shape"))
    b = e.select("vec_id", F.posexplode("embedding").alias("pos", "pbr")).withColumn("pos", 63 - F.col("pos"))
    both = registry.checked(a.join(b, ["vec_id", "pos"], "full"), F.col("shape").isNotNull() == F.col("pbr").isNotNull(), "a coordinate has one latent only")
    return both.select("vec_id", F.col("pos").cast("long").alias("pos"), F.round(F.col("shape").cast("double"), 6).alias("shape"), F.round(F.col("pbr").cast("double"), 6).alias("pbr"))


@query("SELECT vec_id, CAST(len(embedding) AS INT) AS n FROM embeddings WHERE len(list_filter(embedding, lambda x: isnan(x) OR isinf(x))) = 0")
def finite_latents(spark, sf_dir):
    return views.load(spark, sf_dir, "embeddings").filter(registry.finite("embedding")).select("vec_id", F.size("embedding").alias("n"))
