"""The pipeline's stages, each against plain versions on its own input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from conftest import SF001
from voltgrid.llm import mixing, quality
from voltgrid.llm.common import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF001), "test-stage"))
    return out


def pairs(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_stages(spark, steps):
    raw, good, single, clean, mix, shards = steps
    assert [s[0] for s in corpus_pipeline.STAGES] == [
        "quality rules", "MinHash near-dedup", "benchmark decontamination", "mixing sources", "sharding"]
    assert all(df.columns == COLUMNS for df in steps[:-1])
    # quality: the operator's verdict, which test_operators holds against brute force
    assert pairs(good) == pairs(quality.judge(raw).where("kept"))
    # near-duplicates: at 0.8 on the stage's own input
    rows = pairs(good)
    sets = [brute.shingles(t) for _, t in rows]
    link = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                lo, hi = sorted((link[a], link[b]))
                link = [lo if x == hi else x for x in link]
    assert pairs(single) == [rows[k] for k in range(len(rows)) if link[k] == k]
    # leaks: documents with an item go, no other
    items = [r["text"] for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    assert pairs(clean) == [r for r in pairs(single) if not any(i in r[1] for i in items)]
    # mix: the plan's copies; shards: every row of it
    plan = {r["doc_id"]: r["copies"] for r in mixing.mixing_plan(clean).collect()}
    assert pairs(mix) == sorted(r for r in pairs(clean) for _ in range(plan[r[0]]))
    assert pairs(shards) == pairs(mix)
    assert shards.columns == [*COLUMNS, "slot", "shard"]
    assert pairs(corpus_pipeline.run(spark, SF001)) == pairs(shards)


def test_awkward_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = "the cat and the dog of a house is in that garden for it was with a key on the door by the wall " * 1
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (2, text, None, None, None),
            (2, text, None, None, None), (None, text, "en", "s", 1), (3, text + "then this and that", "en", "s", 2)]
    for data in ([], rows):
        docs = spark.createDataFrame(data, schema).withColumns({c: F.lit(1) for c in ("node", "size", "key", "n_words")})
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF001)
            assert out.columns == docs.columns
            out.collect()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF001).count() == len(data)
    stays = corpus_pipeline.near_dedup(spark, docs, SF001).collect()
    assert sorted(r["doc_id"] for r in stays if r["text"] and r["text"] == text) == [2]
