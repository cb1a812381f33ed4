"""Components from local forests: few links need no rounds, many give the same components."""

import random

import pytest

from modeleval.llm import components, minhash


def links_of(pairs, spark):
    return spark.createDataFrame([(a.to_bytes(2, "big"), b.to_bytes(2, "big")) for a, b in pairs], "a binary, b binary")


@pytest.mark.parametrize("most", [1 << 16, 16])
def test_components_of_chains_and_stars(spark, monkeypatch, most):
    written, real = [], components.materialize
    monkeypatch.setattr(components, "FOREST_LINKS", most)
    monkeypatch.setattr(components, "materialize", lambda df, label: written.append(label) or real(df, label))
    rng = random.Random(5)
    pairs = [(i + 1, i) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200), (201, 200), (200, 201)]
    rng.shuffle(pairs)
    found = {int.from_bytes(r.key, "big"): int.from_bytes(r.comp, "big") for r in components.connected_components(links_of(pairs, spark)).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}
    assert (written == ["cc-stars"]) == (most > len(pairs))


def test_labels_stand_for_the_links_before(spark, monkeypatch):
    seen, real = [], minhash.connected_components
    monkeypatch.setattr(minhash, "connected_components", lambda links: seen.append(links.count()) or real(links))
    labels = minhash.more_components(None, links_of([(1, 2), (2, 3), (1, 3), (7, 8)], spark))
    assert minhash.more_components(labels, links_of([], spark)) is labels and len(seen) == 1
    labels = minhash.more_components(labels, links_of([(3, 8)], spark))
    assert {r.comp for r in labels.collect()} == {(1).to_bytes(2, "big")} and labels.count() == 5
