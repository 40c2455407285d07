"""Archives and replays, state, sources by name, images, checks: each against brute force or a broken run."""

import itertools
import math
import os
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lattica.operators import geometry, images, logs, registry
from lattica.operators.numbering import with_row_number
from lattica.plans import QUERIES, geometry_queries, model_queries
from lattica.session import ship
from lattica.sources import files, plugin, voxels
from lattica.streaming import records, state


SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def part(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("k,a,c\n" + "".join(f"{x}\n" for x in lines))


SCHEMA = "k int, a int, c int"


def of(df):
    return sorted((r.k, r.a, r.c) for r in df.fillna(-1).collect())


def test_archive_keeps_stages(spark, tmp_path):
    """Files of one name in two stages and one in a folder with a space are all moved; a second call moves nothing."""
    for stage in ("one", "two", "c d"):
        part(tmp_path / "in" / stage / "new_records", "part_0.csv", ["1,2,3"])
    read = lambda: files.read_parts(spark, str(tmp_path / "in" / "*" / "new_records"), SCHEMA)
    assert files.good_lines(read()).count() == 3
    moved = files.archived(spark, read(), str(tmp_path / "merged"), "7")
    assert sorted(m.split("merged/")[1] for m in moved) == ["c d/7_part_0.csv", "one/7_part_0.csv", "two/7_part_0.csv"]
    assert not list((tmp_path / "in").rglob("*.csv")) and len(list((tmp_path / "merged").rglob("7_part_0.csv"))) == 3
    part(tmp_path / "in" / "one" / "new_records", "part_0.csv", ["1,2,3"])
    part(tmp_path / "in" / "two" / "new_records", "part_0.csv", ["1,2,3"])
    with pytest.raises(FileExistsError):
        files.archived(spark, read(), str(tmp_path / "merged"), "7")


def test_part_stream_breaks_off(spark, tmp_path):
    """A run that ends after its table is written and before its files are moved is made again with the same result; the
    archive holds what was moved, and a replay by name gives the same registry."""
    root, archive, st, check = (str(tmp_path / n) for n in ("in", "archive", "state", "check"))
    lines = [["1,5,", "2,,7", "bad,line,too,long"], ["1,,9", "3,4,"], ["2,6,", "3,,1"]]
    for k, x in enumerate(lines):
        part(tmp_path / "in" / f"stage{k % 2}", f"part_{k}.csv", x)
    merge = lambda: records.merged_parts(spark, root, SCHEMA, "k", st, check, archive, 1)
    want = [(1, 5, 9), (2, 6, 7), (3, 4, 1)]
    assert of(merge()) == want
    moved = sorted(p.name for p in Path(archive).rglob("part_*.csv"))
    left = sorted(p.name for p in Path(root).rglob("part_*.csv"))
    assert moved and sorted(moved + left) == ["part_0.csv", "part_1.csv", "part_2.csv"]
    commits = sorted(Path(check, "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].with_name(f".{commits[-1].name}.crc").unlink(missing_ok=True)
    commits[-1].unlink()  # as if it had broken off before the batch was committed
    assert of(merge()) == want
    part(tmp_path / "in" / "stage0", "part_9.csv", ["1,8,"])
    assert of(merge()) == [(1, 8, 9), *want[1:]]
    assert of(records.replayed(spark, [archive, root, str(tmp_path / "none")], SCHEMA, "k")) == [(1, 8, 9), *want[1:]]
    assert of(records.replayed(spark, [archive, root], SCHEMA, "k", "part_1.csv", "part_9.csv")) == [(1, -1, 9), (2, 6, -1), (3, 4, 1)]
    assert records.replayed(spark, [str(tmp_path / "none")], SCHEMA, "k").count() == 0


def test_checks_are_not_pruned(spark):
    left, right = (spark.createDataFrame(x, "k string, v int") for x in ([("a", 1)], [("a", 2), ("a", 3)]))
    merged = registry.combine_first(left, right, "k")
    for ask in (merged.count, merged.select("v").collect, merged.select(F.lit(1)).count):
        with pytest.raises(Exception, match="repeats"):
            ask()
    assert registry.checked(left, F.col("v") > 0, "no").count() == 1
    with pytest.raises(Exception, match="no"):
        registry.checked(left, F.lit(None).cast("boolean"), "no").count()


def bounds(values, size, share, cap):
    held, bound, out = [], cap, []
    for v in values:
        if v is not None and math.isfinite(v):
            held = [*held, v][-size:]
            if len(held) == size:
                bound = min(cap, float(np.quantile(held, share)))
        out.append(bound)
    return out


def test_bounds_of_finite_values(spark, tmp_path):
    """Batch and stream against a loop: a value that isn't finite leaves the bound as it is, in blocks and micro-batches of any size."""
    rng = random.Random(6)
    odd = [None, float("nan"), float("inf"), float("-inf")]
    runs = {1: [1.0, 2.0, 3.0, 4.0, float("nan"), 6.0, 7.0, 8.0, 9.0], 2: [rng.choice(odd) if rng.random() < 0.4 else round(rng.uniform(0, 9), 3) for _ in range(60)], 3: [float("nan")] * 7, 4: [5.0]}
    rows = [(r, i, v) for r, vs in runs.items() for i, v in enumerate(vs)]
    want = {(r, i): b for r, vs in runs.items() for i, b in enumerate(bounds(vs, 4, 0.5, 8.5))}
    df = spark.createDataFrame(rows, "run int, step int, v double")
    for block in (5, 100_000):
        got = {(r.run, r.step): r.limit for r in logs.clip_limit(df, "run", "step", "v", 4, 0.5, 8.5, block).collect()}
        assert {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in want.items()}
    source = str(tmp_path / "in")
    for low, high in ((0, 3), (3, 9), (9, 10), (10, 99)):
        df.filter(f"step >= {low} and step < {high}").orderBy(F.rand(1)).coalesce(1).write.mode("append").parquet(source)
    stream = state.clip_limits(records.file_stream(spark, source, files_per_batch=1), "run", "step", "v", 4, 0.5, 8.5)
    got = {(r.run, r.step): round(r.limit, 9) for r in records.drained(stream, "append", "bounds").collect()}
    assert got == {k: round(v, 9) for k, v in want.items()}


def test_rolling_fits(spark):
    rng = np.random.default_rng(4)
    rows = [(r, i, float(1e6 + i * 3 + rng.normal()), float(1e5 + i + rng.normal())) for r in (1, 2) for i in range(53)] + [(None, 0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "run int, step int, y double, x double")
    for size, every in ((30, 10), (7, 3), (12, 1), (4, 8)):
        got = {(r.run, r.step): (r.slope, r.intercept) for r in logs.rolling_fit(df, "run", "step", "y", "x", size, every).collect()}
        for (run, step), (slope, intercept) in got.items():
            at = (step + 1) // every * every
            if run is None or not at:
                assert slope is None
                continue
            mine = [x for x in rows if x[0] == run and at - size <= x[1] < at]
            if len(mine) < 2:
                assert slope is None
                continue
            want = np.polyfit([x[3] - 1e5 for x in mine], [x[2] - 1e6 for x in mine], 1)
            assert abs(slope - want[0]) < 1e-6 * max(1, abs(want[0])) and abs(intercept - (want[1] + 1e6 - 1e5 * want[0])) < 1e-3 * max(1, abs(intercept))
    fits = df.limit(0).select(F.lit(1).alias("i"), F.lit(0.0).alias("slope"), F.lit(1.0).alias("intercept"), F.lit(2.0).alias("size"))
    assert logs.memory_ratio(fits, "size", 5.0, 0.9, 0.5, 10, "i").count() == 0


def test_voxel_source(spark, tmp_path):
    """A box opens the chunks that it meets and no others; footers tell rows and bounds."""
    path = str(tmp_path / "v")
    df = spark.range(20 * 20 * 20).select(*[(F.expr(f"cast(id div {20**k} % 20 as int)") - 7).alias(a) for k, a in enumerate("xyz")], (F.col("id") * 2).alias("v"))
    voxels.write_voxels(df, path, size=8)
    plugin.register(spark)
    box = spark.read.format("voxels").option("file", "true").load(path).filter("x >= 1 and x < 3 and y = 9 and z > -4 and z <= 0")
    assert sorted((r.x, r.y, r.z, r.v) for r in box.collect()) == sorted((r.x, r.y, r.z, r.v) for r in df.filter("x >= 1 and x < 3 and y = 9 and z > -4 and z <= 0").collect())
    chunks = {tuple(int(p.split("=")[1]) for p in r.file.split("/") if p.startswith("chunk_") and "size" not in p) for r in box.select("file").distinct().collect()}
    assert chunks == {(0, 1, -1), (0, 1, 0)} and box.rdd.getNumPartitions() == 2
    assert spark.read.format("voxels").load(path).count() == 8000
    assert spark.read.format("voxels").load(path).filter("x > 100").count() == 0
    info = {(r.chunk_x, r.chunk_y, r.chunk_z): r for r in plugin.chunk_info(spark, path).collect()}
    assert len(info) == 27 and sum(r.n for r in info.values()) == 8000 and (info[-1, 0, 1].low_x, info[-1, 0, 1].high_x, info[-1, 0, 1].high_z) == (-7, -1, 12)
    with pytest.raises(Exception, match="No such|NotFound|not exist|cannot|Cannot"):
        spark.read.format("voxels").load(str(tmp_path / "none")).count()


def plain_ssim(p, q):
    half, w = images.WIDTH // 2, np.outer(images.window(), images.window())
    pad = lambda v: np.pad(v, half)
    out = np.zeros_like(p)
    a, b = pad(p), pad(q)
    for y, x in itertools.product(*map(range, p.shape)):
        u, v = a[y : y + images.WIDTH, x : x + images.WIDTH], b[y : y + images.WIDTH, x : x + images.WIDTH]
        mu, mv = (w * u).sum(), (w * v).sum()
        su, sv, suv = (w * u * u).sum() - mu * mu, (w * v * v).sum() - mv * mv, (w * u * v).sum() - mu * mv
        out[y, x] = (2 * mu * mv + images.C1) * (2 * suv + images.C2) / ((mu * mu + mv * mv + images.C1) * (su + sv + images.C2))
    return out


def test_ssim(spark):
    rng = np.random.default_rng(7)
    pictures = {i: (rng.random((13, 17)), rng.random((13, 17))) for i in range(2)}
    rows = [(i, y, x, *(None if (y, x) == (4, 4) else float(v[y, x]) for v in pq)) for i, pq in pictures.items() for y in range(13) for x in range(17)]
    for p, q in pictures.values():
        p[4, 4] = q[4, 4] = 0
    df = spark.createDataFrame(rows, "i int, y int, x int, p double, q double")
    for tile in (4, 16):
        got = {(r.i, r.y, r.x): r.ssim for r in images.ssim(df, ["i"], "p", "q", tile).collect()}
        assert len(got) == len(rows)
        for i, (p, q) in pictures.items():
            want = plain_ssim(p, q)
            assert all(abs(got[i, y, x] - want[y, x]) < 1e-9 for y in range(13) for x in range(17))
    same = images.ssim(df, ["i"], "p", "p", 8).agg(F.min("ssim")).first()[0]
    assert abs(same - 1) < 1e-9 and images.ssim(df.limit(0), ["i"], "p", "q").count() == 0


def test_feature_colours(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(200, 6)) @ np.diag([5, 3, 2, 1, 0.5, 0.1]) + 1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(999, None)], "id int, colour_in array<double>").repartition(3)
    got = {r.id: r.colour for r in images.feature_colours(df, "colour_in", (0, 2, 1)).collect()}
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    axes, values = images.main_axes(df, "colour_in", 6)
    assert np.allclose(values, s) and got.pop(999) is None
    for k, channel in enumerate((0, 2, 1)):
        along = u[:, channel] * np.sign(vt[channel][np.argmax(np.abs(vt[channel]))])
        want = (along - along.min()) / (along.max() - along.min())
        assert np.allclose([got[i][k] for i in range(200)], want)
        assert axes[np.argmax(np.abs(axes[:, channel])), channel] > 0
    assert images.feature_colours(df.limit(0), "colour_in").count() == 0


def test_row_numbers_keep_their_order(spark):
    numbered, n = with_row_number(spark.range(100).select((F.col("id") % 7).alias("g"), "id"), "g", "id")
    assert n == 100 and [r.id for r in numbered.orderBy("row_number").collect()] == sorted(range(100), key=lambda i: (i % 7, i))


def test_fallback_query(spark):
    """Good documents keep their place, each bad one has a good one's, and another call gives the same."""
    docs = {r.doc_id: r.n_chars >= 500 for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r.used for r in QUERIES["fallback_samples"](spark, SF).collect()}
    assert set(got) == set(docs) and all(docs[u] for u in got.values()) and all(got[k] == k for k, good in docs.items() if good)
    assert got == {r.doc_id: r.used for r in QUERIES["fallback_samples"](spark, SF).collect()}
    bad = [u for k, u in got.items() if not docs[k]]
    assert len(set(bad)) > len(bad) / 3


def test_qef_query(spark):
    """Each cell's vertex is as good as any place of a net over the cell for the planes of the triangles that touch it."""
    tris = {r.fid: np.array([r[f"{a}{k}"] for k in range(3) for a in "xyz"]).reshape(3, 3) for r in geometry_queries.triangles(spark, SF).collect()}
    touched = {}
    for r in geometry.triangle_voxels(geometry_queries.triangles(spark, SF), 4).collect():
        touched.setdefault((r.x, r.y, r.z), []).append(tris[r.fid])
    found = QUERIES["qef_solve"](spark, SF).collect()
    flat = lambda t: np.linalg.norm(np.cross(t[1] - t[0], t[2] - t[0])) == 0
    assert {(r.x, r.y, r.z) for r in found} == {c for c, ts in touched.items() if not all(map(flat, ts))}
    for r in found:
        mine = [t for t in touched[r.x, r.y, r.z] if not flat(t)]
        assert r.n == len(mine)
        q, b = 0.1 * len(mine) * np.eye(3), 0.1 * len(mine) * np.mean([t.mean(axis=0) for t in mine], axis=0)
        for t in mine:
            n = np.cross(t[1] - t[0], t[2] - t[0])
            n /= np.linalg.norm(n)
            q, b = q + np.outer(n, n), b + n * (n @ t[0])
        net = np.array([r.x, r.y, r.z]) + np.array(list(itertools.product(np.linspace(0, 1, 9), repeat=3)))
        cost = lambda v: np.einsum("...i,ij,...j", v, q, v) / 2 - v @ b  # noqa: E731, B023
        assert cost(np.array([r.vx, r.vy, r.vz])) <= cost(net).min() + 1e-3


def test_no_height_on_a_tie(spark):
    """Heights of line crossings are compared after six digits: none may lie on the border of two roundings."""
    tables = SF.replace("sf0.001", "sf0.01")
    for r in geometry.line_crossings(model_queries.shifted_triangles(spark, tables)).select("px", "py", "pz").collect():
        for v in r:
            assert abs(v * 1e6 % 1 - 0.5) > 1e-8


def test_corners_are_projected_for_voxels_only(spark):
    """The filter on a voxel's corners works on the grouped voxels, not on each line below the grouping."""
    plan = QUERIES["frustum_cull"](ship(spark), SF)._jdf.queryExecution().executedPlan().toString()
    assert "Filter" in plan and "lineitem" not in plan and "HashAggregate" not in plan
