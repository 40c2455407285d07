"""Sinks read back, quarantined lines, nested objects, layers over features."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lattica.operators import layers, logs, registry
from lattica.plans import views
from lattica.plans.catalog import query
from lattica.session import shared_dir
from lattica.sources import files


def place(spark) -> str:
    return f"{shared_dir(spark)}/sink-{uuid.uuid4().hex}"


@query(
    """SELECT doc_id % 3 AS rank, doc_id, n_chars, CAST(NULL AS VARCHAR) AS bad FROM documents WHERE doc_id % 10 <> 0 AND doc_id % 11 <> 0
    UNION ALL SELECT doc_id % 3, NULL, NULL, doc_id || ',' || n_chars || ',more' FROM documents WHERE doc_id % 10 = 0 UNION ALL SELECT doc_id % 3, NULL, NULL, 'x' || doc_id || ',' || n_chars FROM documents WHERE doc_id % 11 = 0 AND doc_id % 10 <> 0"""
)
def tolerant_parts(spark, sf_dir):
    """Part files of three ranks with lines that don't fit: the good ones, and the quarantine with its text."""
    home = place(spark)
    d = views.load(spark, sf_dir, "documents")
    line = F.when(F.col("doc_id") % 10 == 0, F.concat_ws(",", "doc_id", "n_chars", F.lit("more"))).when(F.col("doc_id") % 11 == 0, F.concat(F.lit("x"), F.concat_ws(",", "doc_id", "n_chars"))).otherwise(F.concat_ws(",", "doc_id", "n_chars"))
    jvm, config = spark._jvm, spark._jsc.hadoopConfiguration()
    for rank in range(3):
        lines = d.filter(F.col("doc_id") % 3 == rank).select(line.alias("value")).coalesce(1)
        head = spark.createDataFrame([("doc_id,n_chars",)], "value string")
        head.unionAll(lines).coalesce(1).write.text(f"{home}/made/{rank}")
        made = jvm.org.apache.hadoop.fs.Path(f"{home}/made/{rank}/part-*.txt")
        fs = made.getFileSystem(config)
        fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{home}/new_records"))
        for status in fs.globStatus(made):
            fs.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(f"{home}/new_records/part_{rank}.csv"))
    parts = files.read_parts(spark, f"{home}/new_records", "doc_id long, n_chars long")
    good = files.good_lines(parts).select(F.col("rank").cast("long").alias("rank"), "doc_id", "n_chars", F.lit(None).cast("string").alias("bad"))
    return good.unionByName(files.bad_lines(parts).select(F.col("rank").cast("long").alias("rank"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_chars"), "bad"))


@query("SELECT k.kind, doc_id, source, n_chars FROM documents, (VALUES ('csv'), ('json'), ('orc'), ('parquet')) k(kind)")
def format_dispatch(spark, sf_dir):
    """A table written and read back by the extension of its path, in four formats."""
    home, d = place(spark), views.load(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    out = None
    for kind in ("csv", "json", "orc", "parquet"):
        files.write(d, f"{home}/t.{kind}")
        back = files.read(spark, f"{home}/t.{kind}").select(F.lit(kind).alias("kind"), F.col("doc_id").cast("long").alias("doc_id"), "source", F.col("n_chars").cast("long").alias("n_chars"))
        out = back if out is None else out.unionByName(back)
    return out


@query("SELECT event_id AS step, event_type AS name, user_id AS rank, round(value, 6) AS value FROM events")
def log_sink(spark, sf_dir):
    """A log as lines of ``step: {json}``, written and read back."""
    home = place(spark)
    files.write_log_lines(views.log(spark, sf_dir).select("step", "name", "rank", "value"), home)
    back = logs.parsed(spark.read.text(home), "value", "name string, rank long, value double").select("step", "log.*")
    return back.select("step", "name", "rank", F.round("value", 6).alias("value"))


@query(
    """SELECT CASE WHEN aesthetic_score >= 5 THEN 'good' ELSE 'poor' END AS kind, count(*) AS n FROM v_asset WHERE coalesce(aesthetic_score >= 5, false) GROUP BY 1 UNION ALL SELECT 'all', count(*) FROM v_asset"""
)
def where_column(spark, sf_dir):
    """A filter that holds only where the frame has its column: on the registry, and on the registry without it."""
    a = views.assets(spark, sf_dir)
    kept = registry.where_column(a, "aesthetic_score", registry.at_least("aesthetic_score", 5.0)).groupBy(F.lit("good").alias("kind")).agg(F.count("*").alias("n"))
    return kept.unionByName(registry.where_column(a.drop("aesthetic_score"), "aesthetic_score", registry.at_least("aesthetic_score", 5.0)).groupBy(F.lit("all").alias("kind")).agg(F.count("*").alias("n")))


@query(
    """WITH o AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 2 THEN 0 ELSE coalesce(length(text), 0) END AS size, role FROM conversations)
    SELECT conv_id, coalesce(string_agg(turn || ':' || size || ':' || role, ' ' ORDER BY turn) FILTER (WHERE size > 0), '') AS objects, count(*) FILTER (WHERE size = 0) AS dropped, CAST(coalesce(sum(size), 0) AS BIGINT) AS faces FROM o GROUP BY conv_id"""
)
def nested_objects(spark, sf_dir):
    """The objects of each asset in order without the empty ones, and how many of these there were."""
    o = views.load(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 3 == 2, 0).otherwise(F.coalesce(F.length("text"), F.lit(0))).alias("size"), "role")
    n = layers.nested_objects(o, "conv_id", "turn", "role", size="size")
    told = F.array_join(F.transform("objects", lambda x: F.concat_ws(":", x["turn"].cast("string"), x["size"].cast("string"), x["role"])), " ")
    return n.select("conv_id", told.alias("objects"), "dropped", F.aggregate("objects", F.lit(0).cast("long"), lambda a, x: a + x["size"]).alias("faces"))


@query(
    """WITH l AS (SELECT conv_id, list(coalesce(length(text), 0) ORDER BY turn) AS l FROM conversations GROUP BY conv_id), m AS (SELECT max(len(l)) AS m FROM l), p AS (SELECT conv_id, l, unnest(range(m)) AS place FROM l, m)
    SELECT conv_id, CAST(place AS INT) AS place, CASE WHEN place < len(l) THEN l[place + 1] ELSE -1 END AS value, place < len(l) AS mask FROM p"""
)
def ragged_to_dense(spark, sf_dir):
    """Sequences of different lengths as rows of one length, with a mask of what is theirs."""
    c = views.load(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("v"))
    p = layers.padded(c, "conv_id", "turn", "v", F.lit(-1))
    return p.select("conv_id", F.posexplode(F.arrays_zip("values", "mask")).alias("place", "c")).select("conv_id", "place", F.col("c.values").alias("value"), F.col("c.mask").alias("mask"))


#: Weights by a rule: row k, channel i.
MATRIX = [[((k * 31 + i * 17) % 23 - 11) / 16.0 for i in range(64)] for k in range(5)]
BIAS = [k / 8.0 - 0.25 for k in range(5)]
GAIN, SHIFT = [1 + (i % 5) / 8.0 for i in range(64)], [(i % 7) / 16.0 - 0.125 for i in range(64)]


@query(
    """WITH s AS (SELECT vec_id, avg(v) AS m, var_pop(v) AS d FROM v_channel GROUP BY vec_id)
    SELECT c.vec_id, c.pos, round((c.v - s.m) / sqrt(s.d + 1e-5) * (1 + (c.pos % 5) / 8.0::DOUBLE) + (c.pos % 7) / 16.0::DOUBLE - 0.125, 5) + 0 AS value FROM v_channel c JOIN s ON s.vec_id = c.vec_id"""
)
def layer_norm(spark, sf_dir):
    """Latents normed over their channels, with a gain and a shift for each."""
    v = views.latents(spark, sf_dir).select("vec_id", F.posexplode(layers.layer_norm("feats", GAIN, SHIFT)).alias("pos", "value"))
    return v.select("vec_id", "pos", (F.round("value", 5) + 0).alias("value"))


@query(
    """SELECT vec_id, CAST(k.range AS INT) AS k, round(sum(v * ((k.range * 31 + pos * 17) % 23 - 11) / 16.0::DOUBLE) + max(k.range) / 8.0::DOUBLE - 0.25, 5) + 0 AS value FROM v_channel, range(5) k GROUP BY vec_id, k.range"""
)
def linear_map(spark, sf_dir):
    """Latents times a fixed matrix, plus a bias."""
    v = views.latents(spark, sf_dir).select("vec_id", F.posexplode(layers.linear("feats", MATRIX, BIAS)).alias("k", "value"))
    return v.select("vec_id", "k", (F.round("value", 5) + 0).alias("value"))


@query("SELECT b, x, y, z, [f0::DOUBLE, n::DOUBLE] AS shape, [f1, f1 / 2] AS pbr FROM v_voxel")
def latent_pack(spark, sf_dir):
    """Two features of one set of coordinates packed into one table; it is the same unpacked."""
    v = views.voxels(spark, sf_dir)
    d = lambda *c: F.array(*[F.col(x).cast("double") for x in c])
    one = v.select("b", "x", "y", "z", d("f0", "n").alias("shape"))
    return layers.packed(one, v.select("b", "x", "y", "z", F.array("f1", F.col("f1") / 2).alias("pbr")), ["b", "x", "y", "z"], "shape", "pbr")
