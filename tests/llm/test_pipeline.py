"""The pipeline against a plain version of each stage, and the registered queries."""

import hashlib

import corpus_pipeline
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from modeleval.llm import quality
from modeleval.llm.queries import SHARDS, SLOTS, oracle, registry
from modeleval.llm.sharding import fill_table

from .helpers import SF, least_edits, mix, rows_of, shingle_counts, word_list


def plain_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    net = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [(r["doc_id"], r["text"], r["source"]) for r in rows_of("documents")]
    rows = [r for r, s in zip(rows, quality.score_batch(net, pa.array([t for _, t, _ in rows]))) if s >= 0.3]
    sets, parent = {i: shingle_counts(t) for i, t, _ in rows}, {i: i for i, _, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if j < i:
                both = sum((sets[i] & sets[j]).values())
                if both >= 0.8 * (sum(sets[i].values()) + sum(sets[j].values()) - both):
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
    rows = [r for r in rows if root(r[0]) == r[0]]
    items = [word_list(r["text"]) for r in rows_of("benchmark")]
    rows = [r for r in rows if not any(least_edits(item, word_list(r[1])) <= int(0.2 * len(item)) for item in items)]
    owner, out = fill_table(SHARDS, SLOTS), []
    taken = mix(rows)
    for i, _, _ in rows:
        slot = int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16) % SLOTS
        size, _, _, words = taken[i]
        out += [(i, slot, SHARDS[owner[slot]])] * (words // size)
    return sorted(out)


def test_pipeline_is_the_plain_one(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "slot", "shard"]
    assert sorted((r.doc_id, r.slot, r.shard) for r in got.collect()) == plain_pipeline(spark)


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "mix_sources", "assign_shards"]


def test_every_query_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert set(oracle()) == {"op4_shard", "op5_mix", "op7_urls", "op11_centroids", "op12_exact"} <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry()))
def test_queries_run(spark, name):
    if name == "pipeline":
        pytest.skip("has a test of its own")
    out = registry()[name](spark, SF)
    assert out.columns and out.count() > 0
