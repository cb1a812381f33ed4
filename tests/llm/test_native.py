"""Sharding, mixing, URL rules and personal data against plain-Python versions."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from modeleval.llm import mixing, pii, sharding, urlfilter
from modeleval.llm.queries import SHARDS, SLOTS, URL_RULES

from .helpers import SF, base_pii, edge_docs, judge, mix, mix_chances, no_docs, rows_of


# ------------------------------------------------------------------- sharding
def test_table_is_full_and_even():
    owner = sharding.fill_table(SHARDS, SLOTS)
    counts = [owner.count(i) for i in range(len(SHARDS))]
    assert min(owner) == 0 and max(counts) - min(counts) <= 1


def test_removing_a_shard_moves_little_else():
    before, after = sharding.fill_table(SHARDS, SLOTS), sharding.fill_table(SHARDS[:-1], SLOTS)
    kept = [(a, b) for a, b in zip(before, after) if a != len(SHARDS) - 1]
    assert sum(a != b for a, b in kept) / len(kept) < 0.1


@pytest.mark.parametrize("shards, slots", [((), 7), (("a", "a"), 7), (("a",), 8), (("a", "b", "c"), 2)])
def test_bad_tables_are_refused(shards, slots):
    with pytest.raises(ValueError):
        sharding.fill_table(shards, slots)


def test_shard_edges(spark):
    docs = edge_docs(spark)
    out = sharding.shard(docs, ("a", "b", "c"), 101)
    assert out.count() == docs.count() and set(out.columns) == set(docs.columns)
    owner = sharding.fill_table(("a", "b", "c"), 101)
    for r in out.collect():
        slot = int(hashlib.md5(str("" if r.doc_id is None else r.doc_id).encode()).hexdigest()[:15], 16) % 101
        assert (r.slot, r.shard) == (slot, "abc"[owner[slot]])
    assert sharding.shard(no_docs(spark), ("a",), 2).count() == 0


# --------------------------------------------------------------------- mixing
def test_mix_is_the_plain_rule(spark):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in rows_of("documents")]
    rows += [(10**6 + i, t, s) for i, (t, s) in enumerate([(None, "src1"), ("", None), ("one two", None), ("x " * 5000, "zzz")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want, got = mix(rows), {r.doc_id: r for r in mixing.mix_report(docs).collect()}
    assert set(got) == set(want)
    for i, (size, source_size, target, taken) in want.items():
        assert (got[i].size, got[i].source_size, got[i].taken) == (size, source_size, taken)
        assert got[i].target == pytest.approx(target) and got[i].taken <= 2 * size


def test_mix_edges(spark):
    docs = edge_docs(spark)
    report = mixing.mix_report(docs)
    assert report.count() == docs.count()
    again = sorted(map(str, mixing.mix_report(docs.repartition(5)).collect()))
    assert again == sorted(map(str, report.collect()))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in report.collect())
    assert mixing.mix_report(no_docs(spark)).count() == 0 and mixing.mix(no_docs(spark)).count() == 0


def test_one_source_with_a_third_of_all_rows(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', cast(1 + id % 40 as int)) AS text", "if(id % 3 = 0, 'hot', concat('s', id % 7)) AS source")
    for r in mixing.mix_report(docs).groupBy("source_size", "target").agg({"taken": "sum"}).collect():
        assert abs(r["sum(taken)"] - r.target) <= 20


def test_a_row_repeated_through_a_source(spark):
    """600 of a source's 1,000 rows are one row: it is drawn copy by copy, so targets are met within a document."""
    texts = [(7, "same words here " * 40, "a") if i % 5 < 3 else (100 + i, "w " * (1 + i % 90), "a") for i in range(1000)]
    texts += [(5000 + i, "x " * (1 + i % 50), "b") for i in range(1000)] + [(9000 + i, "y " * (1 + i % 70), "c") for i in range(500)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string")
    out = mixing.mix_report(docs.repartition(7)).collect()
    assert len(out) == len(texts) and len({r.copies for r in out if r.doc_id == 7}) == 2
    taken, target = {}, {}
    for r in out:
        taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
        target[r.source_size] = r.target
    assert all(abs(taken[s] - target[s]) <= 120 for s in target)
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix_report(docs.repartition(3)).collect()))
    assert mixing.mix(docs).count() == sum(r.copies for r in out)


def test_documents_are_drawn_by_their_own_chances(spark):
    """Over many seeds a document is in the sample as often as its inclusion probability says."""
    sizes = {i: (3, 10, 40, 400)[i % 4] for i in range(160)}
    docs = spark.createDataFrame([(i, "w " * n, "a") for i, n in sizes.items()], "doc_id long, text string, source string").coalesce(1)
    quota, seeds = 0.5 * sum(sizes.values()), 6
    chances = mix_chances(sizes, quota)
    often = dict.fromkeys(set(sizes.values()), 0)
    for seed in range(seeds):
        for r in mixing.mix_report(docs, seed=f"s{seed}").collect():
            often[r.size] += r.copies - 1
    assert len({round(p, 9) for p in chances.values()}) == 4
    for i in range(4):
        assert often[sizes[i]] / (40 * seeds) == pytest.approx(chances[i], abs=0.11)


# ----------------------------------------------------------------------- URLs
URLS = [None, "", "no scheme", "http://", "https://EXAMPLE.com/en/x?y", "http://a.b.www.example.com/en/", "http://example.com", "http://example.com?/en/",
        "ftp://x.net/es/1#f", "http://net/fr/", "http://xnet/es/", "http://user@Example.COM:80/en/", "http://example.com/EN/", "x://é.com/", "http://.com/",
        "http://a..com/a", "http://com/" + "a" * 50_000, "http://" + "a." * 3000 + "com/en", "a://b://c.net/es/", "http://x.net/es", "http://İ.com/ü\n/z"]


def test_urls_are_judged_by_the_plain_rules(spark):
    urls = URLS + [r["url"] for r in rows_of("pages")] + ["http://hot.net/es/"] * 50
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, `__prefix` int")
    out = urlfilter.filter_urls(pages, urlfilter.rules_frame(spark, URL_RULES)).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out} == {i: judge(u, URL_RULES) for i, u in enumerate(urls)}
    assert len(out) == len(urls)


def test_url_tables_may_be_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.com/"), (1, "http://a.com/")], "page_id long, url string")
    none = urlfilter.rules_frame(spark, URL_RULES).filter("false")
    assert [r.verdict for r in urlfilter.filter_urls(pages, none, default="block").collect()] == ["block", "block"]
    assert urlfilter.filter_urls(pages.filter("false"), urlfilter.rules_frame(spark, URL_RULES)).count() == 0


# -------------------------------------------------------------- personal data
PII = ["a@b.com_x@y.org z@q", "1.2.3.4.5.6.7.8 999.1.1.1 é1.2.3.4 01.002.0003.4", "4041894974608795 4041-8949-7460-8795 4041 8949 7460 8795 1234",
       "😀 +1 (403) 555-9312 +49 30 1234567x ++1 22 33 44 55 66 +12", "@@ a@ .@b.c x.@b..c a@b.c.", "a@b.co " * 300 + "1.1.1.1 " * 200,
       "a" * 60_000 + "@" + "b" * 100 + ".c", "1 " * 20_000, "+1" + " " * 20_000, "john [at] mail [dot] com or 10[.]0[.]0[.]1 or (403) 555-9312"]


@pytest.fixture(scope="module")
def trees(spark):
    return pii.train(spark.read.parquet(f"{SF}/documents.parquet"), sample_docs=150, rounds=3)


def test_base_spans_are_the_plain_ones(spark, trees):
    texts = {i: t for i, t in enumerate(PII + [r["text"] for r in rows_of("documents")])}
    out = pii.report(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), trees).collect()
    for r in out:
        base = base_pii(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in base) for k in pii.KINDS]
        spans = [tuple(s.split(":")) for s in r.spans.split(",") if s]
        assert {(k, str(a), str(b)) for k, a, b in base} <= set(spans) and len(spans) == len(base) + r.n_added
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), int(s[1])))


def test_added_spans_are_loose_forms(spark, trees):
    if "email" not in trees.thresholds:
        pytest.skip("too few unseen examples")
    one = spark.createDataFrame([(1, PII[-1])], "doc_id long, text string")
    assert "john" not in pii.redact(one, trees).first().text


def test_pii_edges(spark, trees):
    docs = edge_docs(spark)
    assert pii.report(docs, trees).count() == docs.count()
    out = pii.redact(docs, trees)
    assert out.columns == docs.columns
    assert {r.text for r in out.collect() if r.doc_id is None} == {None, "a text without an id, mail me at <email>"}
    assert pii.report(no_docs(spark), trees).count() == 0
    assert pii.train(no_docs(spark)).thresholds == {}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="a1.@+- ()é5", max_size=40), min_size=1, max_size=30))
def test_base_spans_of_any_text(spark, texts):
    out = pii.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), pii.Judge([], {})).collect()
    for r in out:
        assert r.spans == ",".join(f"{k}:{a}:{b}" for k, a, b in base_pii(texts[r.doc_id]))


def test_very_long_matches_of_every_generator(spark):
    """Each kind is given a threshold that all proposals pass, so that every pattern runs."""
    long = ["x@a" + ".b" * 200_000, "y [at] b" + " [dot] c" * 20_000, "1" + ".1" * 200_003, "1[.]2" + "[.]3" * 50_000,
            "4 " * 200_000, "9" * 400_000, "+1" + "(0) " * 100_000 + "1", "555-123-" * 50_000, "a" * 500_000 + "@", "@" * 300_000]
    judge = pii.Judge([], dict.fromkeys(pii.KINDS, 0.5))
    frame = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string").repartition(4)
    out = {r.doc_id: r for r in pii.report(frame, judge).collect()}
    assert len(out) == len(long)
    assert [(r.n_email, r.n_ip, r.n_card, r.n_phone) for _, r in sorted(out.items())] == [
        (1, 0, 0, 0), (0, 0, 0, 0), (0, 50_001, 0, 0), *[(0, 0, 0, 0)] * 7]
    assert out[0].spans == f"email:0:{len(long[0])}"
    assert out[1].spans.startswith("email:0:") and out[1].n_email == 0 and out[1].n_added == 1


def test_trees_learn_from_every_document(spark):
    """One example of each distinct text, however many texts there are; copies add none."""
    rows = spark.range(4000).select(F.format_string("user%d@host.org", F.col("id") % 2000).alias("text"))
    assert pii.examples(rows, "text").filter("label = 1 and kind = 'email'").count() == 2000
    many = spark.createDataFrame([("1.2.3.4 " * 25_000,)], "text string")
    assert pii.examples(many, "text").filter("kind = 'ip'").count() == 25_000


def test_thresholds_count_all_examples(spark):
    rows = [("ip", 1, 198, 0.9), ("ip", 0, 1, 0.9), ("ip", 1, 1, 0.5), ("ip", 0, 1, 0.4), ("ip", 1, 1, 0.3), ("card", 0, 5, 0.9), ("email", 1, 1, 0.2)]
    scored = spark.createDataFrame(rows, "kind string, label int, n long, p double")
    assert pii.thresholds(scored, 0.995) == {"ip": 0.5, "email": 0.2}
    assert pii.thresholds(scored, 0.999) == {"ip": 0.9, "email": 0.2}
