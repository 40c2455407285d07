"""Views that stand for asset registries, voxels, logs and meshes over the given tables, once for Spark and once as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha(column: str):
    return F.sha2(F.col(column).cast("string").cast("binary"), 256)


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry: one row per asset, with nulls in score, path and a three-valued flag."""
    d = load(spark, sf_dir, "documents")
    return d.select(
        sha("doc_id").alias("sha256"),
        F.col("source").alias("dataset"),
        "lang",
        F.col("n_chars").cast("long").alias("num_faces"),
        F.when(F.col("doc_id") % 7 != 0, (F.col("doc_id") % 100).cast("double") / 10).alias("aesthetic_score"),
        F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("raw/"), F.col("doc_id").cast("string"))).alias("local_path"),
        F.when(F.col("doc_id") % 3 == 0, True).when(F.col("doc_id") % 3 == 1, False).alias("mesh_dumped"),
    )


def stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage records that cover a part of the registry."""
    return load(spark, sf_dir, "labels").select(
        sha("doc_id").alias("sha256"), (F.col("quality") == 1).alias("mesh_dumped"), (F.col("toxic") == 1).alias("pbr_dumped"), (F.col("doc_id") % 64).cast("long").alias("pbr_latent_tokens")
    )


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse tensor: unique coordinates (b, x, y, z) and features f0, f1, n."""
    i = load(spark, sf_dir, "lineitem")
    return i.groupBy(
        (F.col("l_suppkey") % 4).cast("int").alias("b"),
        (F.col("l_partkey") % 32).cast("int").alias("x"),
        (F.col("l_orderkey") % 32).cast("int").alias("y"),
        ((F.col("l_linenumber") * 5 + F.col("l_suppkey")) % 32).cast("int").alias("z"),
    ).agg(F.sum(F.col("l_quantity").cast("decimal(18,4)")).cast("decimal(18,4)").alias("f0"), F.max("l_extendedprice").alias("f1"), F.count("*").alias("n"))


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(F.col("event_id").alias("step"), "ts", F.col("event_type").alias("name"), F.col("user_id").alias("rank"), "value")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("long").alias("asset_id"), F.col("event_id").alias("seq"), F.when(F.col("event_type") == "click", F.col("value")).alias("c_click"), F.when(F.col("event_type") == "view", F.col("value")).alias("c_view")
    )


def faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = load(spark, sf_dir, "lineitem")
    out = i.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("fid"), (F.col("l_partkey") % 50).cast("int").alias("v0"), (F.col("l_suppkey") % 50).cast("int").alias("v1"), (F.col("l_orderkey") % 50).cast("int").alias("v2")
    )
    return out.filter("v0 <> v1 and v1 <> v2 and v0 <> v2")


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty vertices, from the first parts."""
    return load(spark, sf_dir, "part").filter("p_partkey < 50").select(
        F.col("p_partkey").cast("int").alias("vid"), (F.col("p_partkey") * 7 % 13).cast("double").alias("x"), (F.col("p_partkey") * 5 % 11).cast("double").alias("y"), (F.col("p_size") % 9).cast("double").alias("z")
    )


#: Quads of the surface in a row of it.
ROW = 40


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices of a surface over all parts, in rows of ROW. No place has a round number."""
    p = load(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("vid"), (F.expr(f"p_partkey div {ROW}") * 0.71 + 0.1037).alias("x"), (F.col("p_partkey") % ROW * 0.53 + 0.0713).alias("y"), (F.col("p_size") % 11 * 0.37 + 2.0917).alias("z")
    )


def surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two triangles for each quad of four parts, with holes where a part's size is 13."""
    p = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), "p_size")
    n = p.select(F.max("k").alias("last"))
    q = p.join(F.broadcast(n)).filter(f"k % {ROW} < {ROW - 1} and k + {ROW + 1} <= last and p_size <> 13")
    corners = F.array(*[F.struct(F.lit(t).alias("t"), *[(F.col("k") + d).alias(f"v{j}") for j, d in enumerate(c)]) for t, c in enumerate(((0, ROW, 1), (1, ROW, ROW + 1)))])
    return q.select("k", F.inline(corners)).select((F.col("k") * 2 + F.col("t")).alias("fid"), "v0", "v1", "v2")


def views_of_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "conversations").select(F.col("conv_id").alias("asset_id"), F.col("turn").cast("int").alias("frame"), "role")


def latents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("b"), F.col("embedding").alias("feats"))


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every channel of every latent: its place, its value, and the value at the same place from the end."""
    both = F.arrays_zip(F.col("feats").cast("array<double>").alias("v"), F.reverse("feats").cast("array<double>").alias("w"))
    return latents(spark, sf_dir).select("vec_id", "b", F.posexplode(both).alias("pos", "_c")).select("vec_id", "b", "pos", "_c.v", "_c.w")


SQL = {
    "v_asset": """SELECT sha256(CAST(doc_id AS VARCHAR)) AS sha256, source AS dataset, lang, CAST(n_chars AS BIGINT) AS num_faces,
       CASE WHEN doc_id % 7 = 0 THEN NULL ELSE CAST(doc_id % 100 AS DOUBLE)/10 END AS aesthetic_score,
       CASE WHEN doc_id % 5 = 0 THEN NULL ELSE concat('raw/', CAST(doc_id AS VARCHAR)) END AS local_path,
       CASE doc_id % 3 WHEN 0 THEN true WHEN 1 THEN false ELSE NULL END AS mesh_dumped FROM documents""",
    "v_stage": """SELECT sha256(CAST(doc_id AS VARCHAR)) AS sha256, quality = 1 AS mesh_dumped, toxic = 1 AS pbr_dumped,
       CAST(doc_id % 64 AS BIGINT) AS pbr_latent_tokens FROM labels""",
    "v_voxel": """SELECT CAST(l_suppkey % 4 AS INT) AS b, CAST(l_partkey % 32 AS INT) AS x, CAST(l_orderkey % 32 AS INT) AS y,
       CAST((l_linenumber*5 + l_suppkey) % 32 AS INT) AS z,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS f0,
       CAST(max(l_extendedprice) AS DOUBLE) AS f1, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1,2,3,4""",
    "v_log": "SELECT event_id AS step, ts, event_type AS name, user_id AS rank, value FROM events",
    "v_record": """SELECT CAST(user_id AS BIGINT) AS asset_id, event_id AS seq, CASE WHEN event_type='click' THEN value END AS c_click,
       CASE WHEN event_type='view' THEN value END AS c_view FROM events""",
    "v_face": """SELECT l_orderkey*8+l_linenumber AS fid, CAST(l_partkey % 50 AS INT) AS v0, CAST(l_suppkey % 50 AS INT) AS v1,
       CAST(l_orderkey % 50 AS INT) AS v2 FROM lineitem
       WHERE l_partkey % 50 <> l_suppkey % 50 AND l_suppkey % 50 <> l_orderkey % 50 AND l_partkey % 50 <> l_orderkey % 50""",
    "v_vertex": """SELECT CAST(p_partkey AS INT) AS vid, CAST(p_partkey * 7 % 13 AS DOUBLE) AS x, CAST(p_partkey * 5 % 11 AS DOUBLE) AS y,
       CAST(p_size % 9 AS DOUBLE) AS z FROM part WHERE p_partkey < 50""",
    "v_node": "SELECT p_partkey AS vid, p_partkey // 40 * 0.71::DOUBLE + 0.1037::DOUBLE AS x, p_partkey % 40 * 0.53::DOUBLE + 0.0713::DOUBLE AS y, p_size % 11 * 0.37::DOUBLE + 2.0917::DOUBLE AS z FROM part",
    "v_surface": """SELECT k * 2 + t AS fid, k + CASE t WHEN 0 THEN 0 ELSE 1 END AS v0, k + 40 AS v1, k + CASE t WHEN 0 THEN 1 ELSE 41 END AS v2 FROM
       (SELECT p_partkey AS k FROM part WHERE p_partkey % 40 < 39 AND p_partkey + 41 <= (SELECT max(p_partkey) FROM part) AND p_size <> 13), (VALUES (0), (1)) q(t)""",
    "v_view": "SELECT conv_id AS asset_id, CAST(turn AS INT) AS frame, role FROM conversations",
    "v_channel": "SELECT vec_id, label AS b, CAST(unnest(range(len(embedding))) AS INT) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v, CAST(unnest(list_reverse(embedding)) AS DOUBLE) AS w FROM embeddings",
    "v_latent": "SELECT vec_id, label AS b, embedding AS feats FROM embeddings",
}


def sql(body: str) -> str:
    """The query with the views it names put in front."""
    used = [f"{name} AS ({text})" for name, text in SQL.items() if name in body]
    rest = body.strip()
    if rest[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {', '.join([*used, rest[15:]])}"
    if rest[:5].upper() == "WITH ":
        return f"WITH {', '.join([*used, rest[5:]])}"
    return f"WITH {', '.join(used)} {rest}" if used else rest
