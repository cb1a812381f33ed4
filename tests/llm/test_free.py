"""Decontamination, quality, repeats, tokens, neighbours and near-duplicates against brute force."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from modeleval.llm import ann, decontam, minhash, quality, suffixdedup, tokens
from modeleval.llm.components import connected_components
from modeleval.llm.queries import vocabulary_path
from modeleval.llm.suffixes import suffix_array

from .helpers import EDGE_TEXTS, LONG, SF, edge_docs, least_edits, no_docs, repeats, rows_of, shingle_counts, word_list


def frame(spark, texts, parts=3):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)


# ------------------------------------------------------------ decontamination
def edited(words, share, rng, vocabulary):
    words = list(words)
    for _ in range(int(len(words) * share)):
        p, kind = rng.randrange(len(words)), rng.choice("sid")
        if kind == "s":
            words[p] = rng.choice(vocabulary)
        elif kind == "i":
            words.insert(p, rng.choice(vocabulary))
        else:
            del words[p]
    return words


def test_items_are_found_by_edit_distance():
    items = [r["text"] for r in rows_of("benchmark")]
    docs, rng = [r["text"] for r in rows_of("documents")], random.Random(4)
    vocabulary, index, planted = word_list(" ".join(docs)), decontam.Index(items), 0
    for share in (0, 0.1, 0.2):
        texts = [" ".join(rng.choices(vocabulary, k=30) + edited(word_list(t), share, rng, vocabulary) + rng.choices(vocabulary, k=30)) for t in items]
        found = {(r, i): e for r, i, e, _ in index.find(decontam.WordHasher(), pa.array(texts))}
        planted += sum((i, i) in found for i in range(len(items)))
        for (r, i), edits in found.items():
            item = word_list(items[i])
            assert least_edits(item, word_list(texts[r])) <= edits <= 0.2 * len(item)
    assert planted >= 0.98 * 3 * len(items)
    # Every pair that the exact search has and none that it has not.
    found = {(r, i) for r, i, _, _ in index.find(decontam.WordHasher(), pa.array(docs[:60]))}
    assert found == {(r, i) for r, d in enumerate(docs[:60]) for i, t in enumerate(items) if least_edits(word_list(t), word_list(d)) <= int(0.2 * len(word_list(t)))}


def one_sided(words, kind, rng, vocabulary):
    """``words`` with as many edits of one kind as are allowed, spread or in one run."""
    edits, words = int(len(words) * 0.2), list(words)
    lo = rng.randrange(len(words) - edits)
    at = rng.sample(range(len(words)), edits) if rng.random() < 0.7 else range(lo, lo + edits)
    for p in sorted(at, reverse=True):
        words[p:p + (kind != "insert")] = [] if kind == "delete" else rng.choices(vocabulary, k=1)
    return words


@pytest.mark.parametrize("kind", ["insert", "delete", "replace"])
@pytest.mark.parametrize("length", [8, 12, 24, 40, 59, 120, 300, 600])
def test_items_of_any_length_are_found_at_the_full_share(length, kind):
    rng, vocabulary = random.Random(length), [f"w{i}" for i in range(5000)]
    items = [rng.choices(vocabulary, k=length) for _ in range(30)]
    index = decontam.Index([" ".join(i) for i in items])
    texts = [rng.choices(vocabulary, k=rng.randrange(40)) + one_sided(i, kind, rng, vocabulary) + rng.choices(vocabulary, k=rng.randrange(40)) for i in items]
    found = {(r, i): e for r, i, e, _ in index.find(decontam.WordHasher(), pa.array([" ".join(t) for t in texts]))}
    # The walks miss a passage with a chance of 1 - RECALL; what they find is exact.
    assert set(found) <= {(i, i) for i in range(len(items))} and len(found) >= 0.95 * len(items)
    if length <= 59:
        assert all(e == least_edits(items[i], texts[i]) for (_, i), e in found.items())


@pytest.mark.parametrize("length", [8, 10, 13, 21, 40])
def test_walks_reach_their_recall(length):
    """On items and edits other than those that the number of walks was chosen by."""
    rng = np.random.default_rng(length + 1000)
    edits = int(length * 0.2)
    assert 1 <= decontam.repetitions(length, edits) < decontam.MOST_WALKS
    for kind in ("insert", "delete", "replace"):
        items = rng.integers(1, 2**63, (400, length), dtype=np.uint64)
        passages, size = decontam.spread_edits(items, edits, kind, rng)
        texts = [" ".join(f"w{x}" for x in p[:n]) for p, n in zip(passages, size)]
        index = decontam.Index([" ".join(f"w{x}" for x in item) for item in items])
        found = index.find(decontam.WordHasher(), pa.array(texts))
        assert len({r for r, i, _, _ in found if r == i}) >= 0.98 * len(items)


def test_walks_fall_into_step_after_an_edit():
    rng = np.random.default_rng(3)
    words = rng.integers(1, 2**63, 400, dtype=np.uint64)
    other = np.delete(words, 200)
    line = [np.append(w, np.uint64(0)) for w in (words, other)]
    same = np.mean([np.isin(*(decontam.walk_keys(x, np.arange(len(x) - 1), walk) for x in line)).mean() for walk in range(20)])
    assert same > 0.96
    assert decontam.walk_keys(np.zeros(5, np.uint64), np.arange(5), 0).tolist() == [0] * 5


def test_passages_start_where_they_are():
    rng, vocabulary = random.Random(5), [f"w{i}" for i in range(5000)]
    items = [rng.choices(vocabulary, k=n) for n in (8, 30, 200) for _ in range(10)]
    texts = [rng.choices(vocabulary, k=k) + i for k, i in enumerate(items)]
    found = decontam.Index([" ".join(i) for i in items]).find(decontam.WordHasher(), pa.array([" ".join(t) for t in texts]))
    assert found == [(k, k, 0, k) for k in range(len(items))]


def test_decontamination_edges(spark):
    item = "the quick brown fox jumps over the lazy dog"
    benchmark = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "two words"), (None, "ipsum dolor sit amet lorem ipsum dolor sit amet")], "item_id long, text string")
    docs = edge_docs(spark)
    hits = {(r.doc_id, r.item_id, r.edits) for r in decontam.contaminated(docs, benchmark).collect()}
    assert hits == {(1, 1, 0), (7, 1, 0), (6, None, 0)}
    assert decontam.contaminated(docs, benchmark).filter("doc_id = 7").count() == 2
    kept = decontam.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 4
    assert decontam.contaminated(docs, benchmark.filter("false")).count() == 0
    assert decontam.drop_contaminated(docs, benchmark.filter("false")).count() == docs.count()
    assert decontam.contaminated(no_docs(spark), benchmark).count() == 0


def test_a_benchmark_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontam, "MAX_BLOCK_WORDS", 40)
    docs, benchmark = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    split = {tuple(r) for r in decontam.contaminated(docs, benchmark).collect()}
    monkeypatch.undo()
    assert len(list(decontam.blocks(benchmark))) == 1
    assert split == {tuple(r) for r in decontam.contaminated(docs, benchmark).collect()} != set()


# ------------------------------------------------------------------- quality
def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = quality.Network.fresh()
    texts = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (5, 300, 700)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, 5, 300, 700])
    labels = np.array([0.0, 1.0, 0.0])

    def loss():
        p = quality.sigmoid(net.forward(data, offsets)["logits"])
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for weights, gradient in zip(net.params(), net.gradients(data, offsets, labels)):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        kept, step = weights[at], 1e-2
        weights[at] = kept + step
        up = loss()
        weights[at] = kept - step
        down = loss()
        weights[at] = kept
        assert (up - down) / (2 * step) == pytest.approx(gradient[at], rel=0.1, abs=1e-4)


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = {r.doc_id: r for r in quality.score_quality(docs, quality.fit(docs, labels)).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    unseen = [r for i, r in out.items() if r.held_out and i in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in unseen]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out.values())


def test_quality_edges(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (4, 1, 0), (None, 1, 1), (5, None, 0)], "doc_id long, quality int, toxic int")
    net = quality.fit(docs, labels)
    out = quality.score_quality(docs, net).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id == 7}) == 1
    assert {r.score for r in quality.score_quality(docs, quality.fit(docs, labels.filter("false"))).collect()} == {0.5}
    kept = quality.keep_quality(docs, quality.Network.fresh(), threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert quality.score_quality(no_docs(spark), net).count() == 0
    # A text is scored alike alone and among others.
    a, b = (quality.score_batch(quality.Network.fresh(), pa.array(t)) for t in (["abc", LONG, None, ""], [LONG]))
    assert a[1] == pytest.approx(b[0]) and a[2] == a[3]


# -------------------------------------------------------------------- repeats
@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60))
def test_suffix_array(symbols):
    symbols = symbols + [0]
    assert suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


@pytest.mark.parametrize("max_runs", [1, 20_000])
def test_repeats_are_the_plain_ones(spark, max_runs):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(300))) for _ in range(40)]
    texts += ["a" * 100, "ab" * 60, "ab" * 55, "", None, texts[3], texts[3], texts[5][:40] + texts[6][10:60] + "x", "é" * 30]
    out = suffixdedup.digest_kept(suffixdedup.remove_repeats(frame(spark, texts), 16, 8, max_runs)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in out} == dict(enumerate(repeats(texts, 16)))


def test_repeats_of_documents(spark):
    texts = [r["text"] for r in rows_of("documents")][:120]
    texts += [texts[0][:500] + texts[5][100:900], "zz" * 400 + "q", LONG[:20_000]]
    out = suffixdedup.digest_kept(suffixdedup.remove_repeats(frame(spark, texts))).collect()
    assert {r.doc_id: tuple(r)[1:] for r in out} == dict(enumerate(repeats(texts, 200)))


@pytest.mark.parametrize("max_runs", [20_000, 1])
def test_a_text_that_a_third_of_all_rows_share(spark, max_runs):
    rng = random.Random(8)
    line = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    hot, part = line(300), line(40)
    texts = [hot] * 200 + [line(60) + part + line(60) for _ in range(390)] + [line(20) + hot[50:120] + line(20) for _ in range(10)]
    rng.shuffle(texts)
    docs = frame(spark, texts, 7)
    spans = suffixdedup.repeated_spans(docs.selectExpr("unhex(md5(text)) key", "text"), 16, 8, max_runs).collect()
    single = {zlib.crc32(t.encode()) for t in texts if t != hot}
    assert len(spans) == len(single) == 400
    assert max(len(r.spans) for r in spans) <= 300  # not one for each copy
    out = suffixdedup.digest_kept(suffixdedup.remove_repeats(docs, 16, 8, max_runs)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in out} == dict(enumerate(repeats(texts, 16)))


def test_repeats_edges(spark):
    out = suffixdedup.remove_repeats(edge_docs(spark)).collect()
    assert len(out) == len(EDGE_TEXTS) and {(r.n_bytes, r.n_removed) for r in out if r.doc_id == 6} == {(len(LONG), len(LONG))}
    assert suffixdedup.remove_repeats(no_docs(spark)).count() == 0


# --------------------------------------------------------------------- tokens
TRICKY = ["", None, "<|endoftext|>", "a<|endoftext|>b  <|endoftext|> \n\n x", "I'll can't 'S  \u00a0 \u3000 ab\u200b ١٢٣ ²½ é e\u0301 😀😀 \r\n\t x  ", "<|endof", "   ",
          "\x00\x01 \ud7ff 中文字", "a" * 3000, "\x85 x \u2028 y", "\x1c \x1d\x1ea"]


def library_counts(texts):
    from tokenizers import Tokenizer

    return [len(e.ids) for e in Tokenizer.from_file(vocabulary_path()).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_token_counts_are_the_library_s(spark):
    texts = TRICKY + [LONG] + [r["text"] for r in rows_of("documents")]
    out = {r.doc_id: r for r in tokens.count_tokens(frame(spark, texts), vocabulary_path()).collect()}
    for i, n in enumerate(library_counts(texts)):
        assert (out[i].n_tokens, out[i].n_bytes, out[i].over_limit) == (n, len((texts[i] or "").encode()), n > 1024)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_token_counts_of_any_text(text):
    counter = test_token_counts_of_any_text.__dict__.setdefault("counter", tokens.Counter(vocabulary_path()))
    assert counter.count(text) == library_counts([text])[0]


def test_token_edges(spark):
    docs = edge_docs(spark)
    assert tokens.count_tokens(docs, vocabulary_path()).count() == docs.count()
    assert tokens.count_tokens(no_docs(spark), vocabulary_path()).count() == 0


# ----------------------------------------------------------------- neighbours
def brute_nearest(ids, vectors, i, k):
    score = vectors @ vectors[i] / (np.linalg.norm(vectors, axis=1) * np.linalg.norm(vectors[i]))
    order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-score[j], ids[j]))
    return [(ids[j], score[j]) for j in order[:k]]


def test_recall(spark):
    rows = rows_of("embeddings", "/root/testdata/sf0.1")
    ids, vectors = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows])
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got: dict = {}
    for r in ann.nearest(table, table.filter("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = 0
    for i in (i for i, v in enumerate(ids) if v % 50 == 0):
        want, have = dict(brute_nearest(ids, vectors, i, 2000)), sorted(got[ids[i]])
        assert [r for r, _, _ in have] == [1, 2, 3, 4, 5]
        assert all(s == pytest.approx(want[v], abs=1e-12) for _, v, s in have) and have == sorted(have, key=lambda x: (-x[2], x[1]))
        hits += len({v for _, v, _ in have} & set(list(want)[:5]))
    assert hits / (5 * len(got)) >= 0.9


def test_neighbour_edges(spark):
    one, two = [1.0, 0.0, 0.0], [0.0, 1.0, 1.0]
    rows = [(i, one, "x") for i in range(0, 40)] + [(50, two, "x"), (100, two, "x"), (100, two, "x"), (150, None, "x"), (200, [0.0, 0.0, 0.0], "x"), (250, [1.0, float("nan"), 0.0], "x"),
            (300, [1.0, None, 0.0], "x"), (350, [], "x"), (400, [1.0, 1.0], "x"), (None, one, "x"), (450, [-0.0, 2.0, 2.0], "x"), (500, [float("inf"), 0.0, 0.0], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got: dict = {}
    for r in ann.nearest(table, table.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 12)))
    assert set(got) == {0, 50, 100, 450}
    assert got[0] == [(i, 1.0) for i in range(1, 6)]
    assert got[50] == [(100, 1.0), (450, 1.0), (0, 0.0), (1, 0.0), (2, 0.0)]
    assert ann.nearest(table.filter("false"), table).count() == 0 and ann.nearest(table, table.filter("false")).count() == 0


# ------------------------------------------------------------ near-duplicates
def jaccard(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if a or b else 1.0


def test_near_duplicates_against_all_pairs(spark):
    rows = rows_of("documents")
    rng, texts = random.Random(6), [r["text"] for r in rows]
    vocabulary = word_list(" ".join(texts))
    base = " ".join(rng.choices(vocabulary, k=300))
    for _ in range(12):  # a group around one text whose copies are nearer to it than to each other
        words = base.split()
        for p in rng.sample(range(300), 4):
            words[p] = "edited" + str(rng.random())
        texts.append(" ".join(words))
    texts.append(base)
    got = {r.doc_id: r for r in minhash.near_duplicates(frame(spark, texts)).collect()}
    sets = [shingle_counts(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            s = jaccard(sets[i], sets[j])
            if s >= 0.85:
                assert got[i].class_id == got[j].class_id, (i, j, s)
    for i, r in got.items():  # no class without links
        mates = [j for j, x in got.items() if x.class_id == r.class_id and j != i]
        assert not mates or max(jaccard(sets[i], sets[j]) for j in mates) >= 0.72
        assert r.class_id == min([i, *mates]) and r.kept == (r.class_id == i)


def classes_of(rows):
    out = {}
    for r in rows:
        out.setdefault(r.class_id, set()).add(r.doc_id)
    return sorted(map(sorted, out.values()))


def test_unlike_texts_with_a_common_passage(spark, monkeypatch):
    """Buckets of more than PART texts: groups are bounded, pairs are found, unlike texts part."""
    rng = random.Random(12)
    prose = lambda n: [f"v{rng.randrange(4000)}" for _ in range(n)]
    passage, texts = prose(60), []
    for _ in range(60):
        own = passage + prose(22)
        texts += [" ".join(own), " ".join(own[:-1] + prose(1))]
    texts += [" ".join(prose(50)) for _ in range(20)]
    sizes, deal = [], minhash.dealt

    def watched(*args):
        rows = deal(*args)
        sizes.extend(r["count"] for r in rows.groupBy("band", "part", "block", "is_hub").count().collect())
        return rows

    whole = classes_of(minhash.near_duplicates(frame(spark, texts)).collect())
    monkeypatch.setattr(minhash, "PART", 8)
    monkeypatch.setattr(minhash, "dealt", watched)
    split = []
    again = minhash.shingle_buckets
    monkeypatch.setattr(minhash, "shingle_buckets", lambda *a: split.append(again(*a)) or split[0])
    parts = classes_of(minhash.near_duplicates(frame(spark, texts)).collect())
    assert whole == parts
    assert all([2 * k, 2 * k + 1] in parts for k in range(60))
    assert len(split) == 1 and max(sizes, default=0) <= 4 * minhash.PART
    # Unlike texts share a bucket no more: pairs only, not the passage's 120 texts.
    assert max(r["count"] for r in split[0].groupBy("band").count().collect() or [{"count": 0}]) <= minhash.PART


def test_hubs_are_dealt_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PART", 8)
    members = spark.range(100).selectExpr("1L band", "cast(cast(id as string) as binary) key", "100L n", "named_struct('degree', 1L, 'key', cast(cast(id as string) as binary)) comp")
    chosen = members.selectExpr("band", "n", "cast(cast(key as string) as int) + 1 place", "key hub", "comp hub_comp")
    rows = minhash.dealt(members, chosen).collect()
    groups = {}
    for r in rows:
        groups.setdefault((r.part, r.block), ([], []))[r.is_hub].append(r.key)
    assert all(len(hubs) <= 8 and len(own) <= 32 for own, hubs in groups.values())
    assert len({(h, m) for own, hubs in groups.values() for h in hubs for m in own}) == 100 * 100


def test_last_hubs_cover_all_components(spark):
    """Any two members of different components: one is a last hub or was among the first hubs."""
    rng = random.Random(3)
    key = lambda i: str(i).zfill(3).encode()
    size = {1: 120, 2: 40}
    comp = {(b, i): (0 if b == 1 and i % 4 else rng.randrange(5)) for b in size for i in range(size[b])}
    members = spark.createDataFrame(
        [(b, key(i), size[b], (i, key(i)), (c, key(c))) for (b, i), c in comp.items()],
        "band long, key binary, n long, rank struct<degree:long,key:binary>, comp struct<degree:long,key:binary>")
    hubs = {(r.band, int(r.hub)) for r in minhash.last_hubs(members, 10).collect()}
    been = {(b, i) for b, i in comp if i >= size[b] - 10}  # the highest ranks
    assert hubs and not hubs & been
    assert all({(b, i), (b, j)} & (hubs | been) for b, i in comp for j in range(i) if comp[b, i] != comp[b, j])
    assert len({h for h in hubs if h[0] == 1}) < 40  # of 120


def weighted_sets(spark, texts):
    levels = minhash.idf_levels(frame(spark, texts))
    row, hashes, weight = minhash.weighted_shingles(minhash.WordHasher(), levels, minhash.pa.array(texts))
    return [(hashes[row == i], weight[row == i]) for i in range(len(texts))]


def test_shared_weight_is_the_sum_of_lesser_weights():
    rng = np.random.default_rng(4)
    for many, n_a, n_b in ((30, 9, 12), (5000, 20, 15), (200_000, 3, 4), (6000, 256, 300)):
        sides = []
        for n in (n_a, n_b):
            has = [np.sort(rng.choice(many, rng.integers(0, min(many, 3000)), replace=False)) for _ in range(n)]
            hashes = np.concatenate(has)
            weight = 1 + hashes % 7 / 7.0
            weight[hashes % 5 == 0] *= rng.integers(1, 4, int((hashes % 5 == 0).sum()))
            sides.append((np.repeat(np.arange(n), [len(h) for h in has]), hashes.astype(np.uint64), weight))
        got = minhash.shared_weight(*sides, n_a, n_b)
        one = [[dict(zip(s[1][s[0] == i].tolist(), s[2][s[0] == i].tolist())) for i in range(n)] for s, n in zip(sides, (n_a, n_b))]
        for j in range(0, n_b, 7):
            for i in range(0, n_a, 5):
                assert got[j, i] == pytest.approx(sum(min(w, one[0][i][h]) for h, w in one[1][j].items() if h in one[0][i]))
    none = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0))
    assert not minhash.shared_weight(none, sides[0], 2, 300).any()


def test_recall_with_a_group_of_a_third_of_all_rows(spark, monkeypatch):
    """All pairs of weighted Jaccard 0.8 or more, by brute force, in and outside a group that holds a
    third of all rows: at least 0.95 are in one class, and every class is connected by such pairs."""
    rng = random.Random(31)
    prose = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]

    def edited(words, most):
        words = list(words)
        for p in rng.sample(range(len(words)), rng.randrange(most + 1)):
            words[p] = "x" + str(rng.randrange(10**9))
        return " ".join(words)

    base, texts = prose(120), []
    texts += [edited(base, 8) for _ in range(100)]
    for _ in range(60):
        own = prose(rng.randrange(40, 200))
        texts += [" ".join(own), edited(own, max(1, len(own) // 40))]
    texts += [" ".join(prose(60)) for _ in range(80)]
    sets = weighted_sets(spark, texts)
    near = [(i, j) for i in range(len(texts)) for j in range(i) if minhash.weighted_jaccard(sets[i], sets[j]) >= minhash.THRESHOLD]
    monkeypatch.setattr(minhash, "PART", 16)
    monkeypatch.setattr(minhash, "HUB_GROWTH", 4)  # all three rounds
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(frame(spark, texts)).collect()}
    for part in ([p for p in near if p[0] < 100], [p for p in near if p[1] >= 100]):
        assert len(part) >= 40
        assert sum(got[i] == got[j] for i, j in part) >= 0.95 * len(part)
    root = list(range(len(texts)))
    for i, j in near:
        a, b = root[i], root[j]
        root = [a if x == b else x for x in root]
    assert all(root[i] == root[c] for i, c in got.items())


def test_near_duplicate_edges(spark):
    docs = edge_docs(spark)
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    classes: dict = {}
    for r in got:
        classes.setdefault(r.class_id, []).append((r.doc_id, r.kept))
    assert sorted(classes[1]) == [(1, True), (7, False), (7, False)]
    assert sorted(classes[2], key=str) == sorted([(2, True), (3, False), (None, False)], key=str)
    assert sorted(classes[10]) == [(10, False), (10, True)] or sorted(classes[10]) == [(10, True), (10, True)]
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id = 1").count() == 1 and kept.filter("doc_id = 7").count() == 0
    assert minhash.near_duplicates(no_docs(spark)).count() == 0 and minhash.drop_near_duplicates(no_docs(spark)).count() == 0


def test_draws_agree_as_often_as_the_sets_are_similar():
    sampler, rng = minhash.Sampler(), np.random.default_rng(1)
    hashes = rng.integers(0, 2**48, 1000, dtype=np.uint64) << np.uint64(16)
    agree, total = 0, 0
    for part in range(40):
        own = np.sort(rng.choice(hashes, 400, replace=False))
        other = np.sort(np.concatenate([own[:370], rng.integers(0, 2**48, 30, dtype=np.uint64) << np.uint64(16)]))
        draws = [sampler.bands(np.zeros(len(x), np.int64), x, np.where((x >> np.uint64(20)) % np.uint64(3) == 0, 2.0, 1.0), 1)[0] for x in (own, other)]
        agree, total = agree + sum(a == b for a, b in zip(*draws)), total + len(draws[0])
        similar = minhash.weighted_jaccard(*[(x, np.where((x >> np.uint64(20)) % np.uint64(3) == 0, 2.0, 1.0)) for x in (own, other)])
    assert agree / total == pytest.approx(similar**minhash.ROWS, abs=0.12)


def test_components_of_a_long_chain(spark):
    links = spark.range(60).selectExpr("cast(cast(id as string) as binary) a", "cast(cast(id + 1 as string) as binary) b").unionAll(
        spark.sql("SELECT cast('x' as binary) a, cast('y' as binary) b"))
    assert len({bytes(r.comp) for r in connected_components(links).collect()}) == 2
