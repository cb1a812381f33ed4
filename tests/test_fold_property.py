"""The thinning rule used on Spark equals the original greedy fold (pure Python).

Greedy fold: from the top, keep a row when its bucket differs from the last kept
row. Rule used here: keep a row when its bucket differs from the row just above.
"""

from hypothesis import given, settings
from hypothesis import strategies as st


def greedy(buckets):
    kept = [0]
    for i in range(1, len(buckets)):
        if buckets[i] != buckets[kept[-1]]:
            kept.append(i)
    return kept


def neighbour(buckets):
    return [i for i in range(len(buckets)) if i == 0 or buckets[i] != buckets[i - 1]]


@settings(max_examples=2000, deadline=None)
@given(st.lists(st.integers(min_value=-3, max_value=12), min_size=1, max_size=60))
def test_neighbour_rule_equals_greedy_fold(buckets):
    # any sequence, monotone or not (negative weights make rates non-monotone)
    assert neighbour(buckets) == greedy(buckets)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=60))
def test_score_points_rule(scores):
    scores = sorted(scores)
    ints = [int(s) for s in scores]
    fold = [0]
    for i in range(1, len(ints)):
        if ints[i] != ints[fold[-1]]:
            fold.append(i)
    assert fold == [i for i in range(len(ints)) if i == 0 or ints[i] != ints[i - 1]]
