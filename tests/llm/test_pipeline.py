"""The pipeline stage by stage against brute force, and the queries' columns, on the smallest tables."""

import os
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import corpus_pipeline
from test_llm_operators import brute_contamination, brute_groups

from lattica.llm import language, mixing, packing
from lattica.llm.common import in_fold
from lattica.llm.queries import QUERIES
from lattica.session import shared_dir, ship

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")

COLUMNS = {
    "op1_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op2_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op3_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op4_packing": ["ids", "cu_seqlens", "position_resets", "doc_ids"],
    "op5_minhash": ["doc_id", "n_shingles", "component_id", "kept"],
    "op6_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op7_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op8_embeddings": ["vec_id", "n_links", "component_id", "kept"],
    "op9_mixing": ["doc_id", "rate", "copies", "residual", "met"],
    "op10_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op11_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op12_token_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
}
ROWS = {"op8_embeddings": "embeddings", "op10_url_filter": "pages"}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    df = QUERIES[name](ship(spark), SF)
    assert set(COLUMNS[name]) <= set(df.columns)
    n = spark.read.parquet(f"{SF}/{ROWS.get(name, 'documents')}.parquet").count()
    assert df.count() == n or name == "op4_packing"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)
    rows = {r.doc_id: r for r in docs.collect()}

    now = stages[names[0]](spark, docs, SF)
    got = {r.doc_id for r in now.collect()}
    prototypes = language.fitted(docs.filter(~in_fold("doc_id", 4, 2)))
    told = {}
    for i, r in rows.items():
        v = language.Encoder().encoded(r.text)
        odds = np.exp(language.SHARPNESS * np.array([0.0 if v is None else p @ v for p in prototypes.values()]))
        told[i] = v is not None and odds.max() / odds.sum() >= corpus_pipeline.LEAST_SCORE
    assert now.columns == docs.columns and got == {i for i in rows if told[i]}

    now = stages[names[1]](spark, now, SF)
    groups = brute_groups([rows[i].text for i in sorted(got)], sorted(got), 5)
    got = {r.doc_id for r in now.collect()}
    assert now.columns == docs.columns and got == {i for i, (_, c) in groups.items() if i == c}

    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = now
    now = stages[names[2]](spark, before, SF)
    got = {i for i in got if not brute_contamination(rows[i].text, items)[4]}
    assert now.columns == docs.columns and {r.doc_id for r in now.collect()} == got

    wanted = {r.doc_id: r.copies for r in mixing.mixture(now, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    mixed = stages[names[3]](spark, now, SF)
    found = Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == docs.columns and found == Counter({i: n for i, n in wanted.items() if n})

    packed = stages[names[4]](spark, mixed, SF)
    codec, tokens = packing.encoding(), Counter()
    for r in packing.unpacked(packed).collect():
        tokens[r.doc_id] += len(r.ids)
    assert tokens == Counter({i: n * (len(codec.encode_ordinary(rows[i].text)) + 1) for i, n in found.items()})


def test_run(spark):
    """The stages in a row, with nothing left behind but the table that the last one reads."""
    made = lambda: {p.name for p in Path(shared_dir(spark)).iterdir()}
    before = made()
    rows = corpus_pipeline.run(spark, SF)
    left = [n for n in made() - before if any((Path(shared_dir(spark)) / n).glob("*.parquet"))]
    assert len(left) == 1 and left[0].startswith("stage-mixing")
    docs, stages = spark.read.parquet(f"{SF}/documents.parquet"), dict(corpus_pipeline.STAGES)
    for stage in stages.values():
        docs = stage(spark, docs, SF)
    count = lambda df: Counter(r.doc_id for r in packing.unpacked(df).collect())
    assert count(rows) == count(docs)


def test_odd_rows(spark, tmp_path):
    """Null columns, empty texts, long runs and repeated rows go through all stages."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    odd = [(None, None, None, None, None), (7, "", "en", "s", 0), (7, " " * 2_000_000 + "x", "en", "s", 1), (None, "a" * 2_000_000, "en", "s", 1), (8, "\n" * 2_000_000, None, "s", 1)]
    rows = docs.unionByName(spark.createDataFrame(odd * 2, docs.schema))
    rows.withColumns({c: F.lit("own") for c in ("tokens", "rate", "found", "score", "row", "copy")}).write.parquet(str(tmp_path / "documents.parquet"))
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    ids = {r.doc_id for r in packing.unpacked(corpus_pipeline.run(spark, str(tmp_path))).select("doc_id").distinct().collect()}
    assert ids and ids <= {r.doc_id for r in rows.collect()}


def test_empty_tables(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").filter("false").write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
