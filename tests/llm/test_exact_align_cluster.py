"""Exact duplicates, tokenizer alignment and centroid clustering against plain-Python versions."""

import hashlib
import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from modeleval.llm import alignment, centroids, exactdedup
from modeleval.llm.queries import PIECES, vocabulary_path

from .helpers import SF, edge_docs, no_docs, rows_of


# ------------------------------------------------------------------- exact duplicates
def lowered(text) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_duplicates(rows, keep):
    """(doc_id, keep_id, group_size, text_sha256) of each row, and kept rows per group."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[lowered(t)].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[lowered(t)] if x is not None]
        best = (max if keep == "largest" else min)(ids) if ids else None
        out.append((i, best, len(groups[lowered(t)]), hashlib.sha256(lowered(t).encode()).hexdigest()))
    return out


def check_duplicates(spark, rows, keep="largest", **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = exactdedup.exact_duplicates(docs, keep, **options).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == Counter(plain_duplicates(rows, keep))
    kept = Counter((r.text_sha256) for r in found if r.kept)
    assert kept == Counter({hashlib.sha256(lowered(t).encode()).hexdigest() for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_duplicates_with_a_hot_group_and_ties(spark, keep):
    rng = random.Random(5)
    rows = [(i, "The Same Text" if i % 3 == 0 else f"text {rng.randrange(150)}") for i in range(600)]
    rows += [(7, "twice"), (7, "twice"), (None, "twice"), (None, "no id"), (None, "no id"), (8, None), (9, ""), (10, "É"), (11, "é"), (12, "ABC"), (13, "abc")]
    check_duplicates(spark, rows, keep)


def test_texts_that_share_a_hash_are_told_apart_by_their_bytes(spark):
    rows = [(i, f"text {i % 700}") for i in range(1500)]
    check_duplicates(spark, rows, hash_bytes=1)


def test_exact_duplicates_edges(spark):
    docs = edge_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = exactdedup.exact_duplicates(docs).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == Counter(plain_duplicates(rows, "smallest"))
    left = exactdedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    assert Counter(lowered(r.text) for r in left.collect()) == Counter({lowered(t) for _, t in rows})
    assert exactdedup.exact_duplicates(no_docs(spark)).count() == 0
    assert exactdedup.drop_exact_duplicates(no_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        exactdedup.exact_duplicates(docs, "first")


def test_exact_duplicates_stay_out_of_python_workers(spark):
    plan = exactdedup.exact_duplicates(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# ------------------------------------------------------------------- alignment
A, B = vocabulary_path(), vocabulary_path(PIECES)


def plain_alignment(texts):
    """The report's columns, from both libraries and the sets of ends."""
    import sentencepiece
    from tokenizers import Tokenizer

    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    name = {v: k for k, v in first.get_vocab().items()}
    plain, back, spare = {*range(33, 127), *range(161, 173), *range(174, 256)}, {}, 256
    for b in range(256):
        back[chr(b if b in plain else spare)] = b
        spare += b not in plain
    found, times = [], Counter()
    for t in texts:
        a = first.encode(" " + t, add_special_tokens=False).ids if t else []
        b = second.encode(t) if t else []
        bytes_a = [bytes(back[c] for c in name[i]) for i in a]
        bytes_b = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
        body = b" " + (t or "").encode()
        if not t or b"".join(bytes_a) != body or b"".join(bytes_b) != body:
            found.append(None)
            continue
        ends_a, ends_b = ({sum(map(len, x[:0])): -1} for x in (bytes_a, bytes_b))
        for ends, parts in ((ends_a, bytes_a), (ends_b, bytes_b)):
            place = 0
            for k, p in enumerate(parts):
                place += len(p)
                ends[place] = k
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b))[1:]:
            groups.append(",".join(map(str, a[i:ends_a[cut] + 1])) + "|" + ",".join(map(str, b[j:ends_b[cut] + 1])))
            i, j = ends_a[cut] + 1, ends_b[cut] + 1
            links.append((a[i - 1], b[j - 1]))
        times.update(links)
        found.append((len(a), len(b), ";".join(groups), links))
    most = Counter()
    for (_, b), n in times.items():
        most[b] = max(most[b], n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else (
        f[0], f[1], len(f[3]), len(f[3]), sum(times[x] == most[x[1]] for x in f[3]), sum(times[x] for x in f[3]),
        hashlib.sha256(f[2].encode()).hexdigest()) for f in found]


def test_alignment_of_documents_and_edges(spark):
    docs = edge_docs(spark)
    texts = [r.text for r in docs.collect()] + [
        "<|endoftext|> and <s>x</s> <unk>", "a ▁ b", "two  spaces   and\n\nlines ", "naïve café 東京 😀😀", "x" * 30_000, " " * 5_000, "ab\x00c", "don't WE'LL 1234567"]
    rows = list(enumerate(texts)) + [(r["doc_id"] + 1000, r["text"]) for r in rows_of("documents")]
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, links int").repartition(5)
    found = {r.doc_id: tuple(r)[1:] for r in alignment.alignment_report(frame, A, B).collect()}
    assert found == dict(zip([i for i, _ in rows], plain_alignment([t for _, t in rows])))
    assert sum(f[0] == 0 for f in found.values()) >= 3
    assert alignment.alignment_report(no_docs(spark), A, B).count() == 0


def test_alignment_of_repeated_rows_and_its_own_outputs(spark):
    frame = spark.createDataFrame([(1, "Aligning tokens"), (1, "Aligning tokens"), (None, "")], "doc_id long, text string")
    rows = alignment.align(frame, A, B).collect()
    assert rows[0] == rows[1] and rows[2].groups == "" and rows[2].links == []
    sides = [g.split("|") for g in rows[0].groups.split(";")]
    pieces_a, pieces_b = alignment.tokenizer(A).pieces, alignment.tokenizer(B).pieces
    for a, b in sides:
        assert b"".join(pieces_a[int(i)] for i in a.split(",")) == b"".join(pieces_b[int(i)] for i in b.split(","))
    counts = alignment.pair_counts(alignment.align(frame, A, B)).collect()
    assert sum(r["count"] for r in counts) == 2 * len(sides)
    assert len(counts) <= alignment.possible_pairs(A, B)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=1, max_size=60), st.randoms(use_true_random=False))
def test_terminals_label_the_groups(lengths, rng):
    total = sum(lengths)
    other = sorted({total, *(rng.randrange(1, total + 1) for _ in range(rng.randrange(1, 40)))})
    end_a, end_b = np.cumsum(lengths), np.array(other)
    step, _ = alignment.terminals(end_a, end_b, np.append(0, end_a[:-1]), np.append(0, end_b[:-1]))
    cuts = np.array(sorted(set(end_a.tolist()) & set(other)))
    label = np.searchsorted(end_b, cuts)
    assert (step[:len(end_b)] == label[np.searchsorted(cuts, end_b)]).all()
    assert (step[len(end_b):] == label[np.searchsorted(cuts, end_a)]).all()


def test_linked_tokens_are_suffixes_within_the_bound():
    a, b = alignment.tokenizer(A).pieces, alignment.tokenizer(B).pieces
    short = sum(1 for x in set(a) & set(b) if x)
    assert short <= alignment.possible_pairs(A, B) < 50 * max(len(a), len(b))


def test_alignment_works_on_a_small_part_of_a_batch_at_a_time():
    rng = random.Random(3)
    words = ["token", "Alignment", "été", "x1", "of", "naïve", "<s>", "\n", "2026"]
    texts = [" ".join(rng.choices(words, k=200)) for _ in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "__text"])
    assert batch.nbytes > 4 * alignment.SLICE
    found = []
    rows = alignment.aligned_batches(iter([batch.slice(0, 1), batch]), A, B)
    next(rows)  # the vocabularies are there
    tracemalloc.start()
    for part in rows:
        found.append(part.select(["doc_id", "n_a", "n_b", "n_groups"]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20  # 98 MB for slices of 2 MB
    assert sum(p.num_rows for p in found) == len(texts)
    assert [i for p in found for i in p["doc_id"].to_pylist()] == list(range(len(texts)))


def test_link_totals_are_those_of_every_row_whatever_the_parts(monkeypatch):
    rng = random.Random(4)
    rows = [[{"a": rng.randrange(9), "b": rng.randrange(9), "times": rng.randrange(1, 4)} for _ in range(n)] for n in (0, 3, 0, 40, 1, 7, 0, 12, 0)]
    links = pa.array(rows, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("times", pa.int64())])))
    expected = [[sum(x["times"] for x in r) for r in rows], [sum(x["a"] * x["b"] * x["times"] for x in r) for r in rows]]
    seen = []

    def per_link(a, b):
        seen.append(len(a))
        return [np.ones(len(a), np.int64), a.astype(np.int64) * b]

    for most in (1, 5, 10, 1000):
        monkeypatch.setattr(alignment, "LINKS_AT_A_TIME", most)
        seen.clear()
        assert [x.tolist() for x in alignment.link_totals(links, per_link)] == expected
        assert [x.tolist() for x in alignment.link_totals(links.slice(2, 4), per_link)] == [x[2:6] for x in expected]
        assert max(seen) <= max(most, 40)


# ------------------------------------------------------------------- centroids
def plain_clusters(rows, k, rounds, dims):
    def whole(v):
        return [math.floor(256 * float(x)) for x in v]

    kept = [(i, whole(v)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    middle = [list(v) for _, v in order[:k]]

    def place(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(middle))

    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[place(v)[1]].append(v)
        for n, vs in own.items():
            middle[n] = [sum(x) // len(vs) for x in zip(*vs)]
    return Counter((i, place(v)[1], place(v)[0]) for i, v in kept), middle


def check_clusters(spark, rows, k, rounds, dims, **options):
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, cluster string").repartition(3)
    found = centroids.cluster(frame, k, rounds, dims, **options)
    expected, middle = plain_clusters([(r.vec_id, r.embedding) for r in frame.collect()], k, rounds, dims)
    assert Counter(map(tuple, found.assigned.collect())) == expected
    assert found.centroids == middle
    return found


@pytest.mark.parametrize("bits", [1, 4, 8])
def test_clusters_are_exact_whatever_the_cells(spark, bits):
    rng = random.Random(bits)
    rows = [(i, [rng.gauss(i % 5, 0.3) for _ in range(6)]) for i in range(300)]
    found = check_clusters(spark, rows, 7, 3, 6, bits=bits, sample=64)
    report = centroids.inertia_report(found).collect()
    assert len(report) == 300 and sum(r.distance for r in report) == report[0].inertia
    by = defaultdict(int)
    for r in report:
        by[r.cluster] += r.distance
    assert all(by[r.cluster] == r.cluster_inertia for r in report)
    assert all(r.centroid_sha256 == hashlib.sha256(",".join(map(str, found.centroids[r.cluster])).encode()).hexdigest() for r in report)


def test_clusters_of_awkward_vectors(spark):
    rows = [(1, None), (2, []), (3, [1.0, None, 2.0]), (4, [1.0, 2.0]), (5, [float("nan"), 0.0, 0.0]), (6, [float("inf"), 0.0, 0.0]),
            (None, [0.5, 0.5, 0.5]), (7, [0.1, -0.1, 0.2]), (7, [0.1, -0.1, 0.2]), (7, [0.3, 0.0, 0.0]), (8, [-0.001, 0.0, 1e-30])]
    rows += [(i, [0.25, 0.25, 0.25]) for i in range(10, 60)]
    check_clusters(spark, rows, 4, 2, 3)
    check_clusters(spark, rows, 500, 1, 3)
    check_clusters(spark, [(i, [x * 1e4 for x in (i, -i, 7)]) for i in range(40)], 5, 2, 3)
    empty = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert centroids.inertia_report(centroids.cluster(empty)).count() == 0
    assert centroids.inertia_report(centroids.cluster(empty.limit(0))).count() == 0


def test_too_large_components_are_refused():
    import pyarrow as pa

    with pytest.raises(ValueError):
        centroids.whole_vectors(pa.array([[1e30, 0.0]]), 2, 256.0)


def test_few_vectors_are_fetched_where_clusters_are_apart():
    rng = np.random.default_rng(1)
    middle = rng.normal(0, 100, (10, 16)).astype(np.int64)
    vectors = middle[rng.integers(0, 10, 5000)] + rng.integers(-9, 10, (5000, 16))
    marks = centroids.fit_marks(vectors[:500], 6)
    cells = centroids.Cells(marks, vectors.min(axis=0), vectors.max(axis=0))
    best, fetched = centroids.nearest_centroid(centroids.encode(vectors, marks), vectors, middle, cells.tables(middle))
    exact = ((vectors[:, None] - middle[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (best == exact).all() and fetched < 500
