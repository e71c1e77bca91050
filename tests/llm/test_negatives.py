"""Hard negatives: Strassen's products, heaps, and the whole search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from touchline.llm import negatives as N


@pytest.mark.parametrize("shape", [(1, 1, 1), (7, 5, 3), (33, 64, 65), (100, 1, 90), (130, 70, 131)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(sum(shape))
    n, k, m = shape
    a, b = rng.integers(-2 ** 27, 2 ** 27, (n, k)), rng.integers(-2 ** 27, 2 ** 27, (k, m))
    for leaf in (1, 4, 32):
        assert (N.strassen(a, b, leaf) == (a.astype(object) @ b.astype(object)).astype(np.int64)).all()


def test_heaps_merge_in_any_grouping():
    rng = np.random.default_rng(2)
    slot, score, ids = rng.integers(0, 6, 400), rng.integers(-5, 6, 400), rng.integers(0, 40, 400)
    want = []
    for s in range(6):
        best = sorted({(-v, i) for v, i in zip(score[slot == s].tolist(), ids[slot == s].tolist())})[:7]
        want += [(s, -v, i) for v, i in best]
    for parts in (1, 3, 11):
        heaps = []
        for k in range(parts):
            heaps.append(N.Heaps(6, 7))
            for half in (slice(k, None, 2 * parts), slice(k + parts, None, 2 * parts)):
                heaps[-1].push(slot[half], score[half], ids[half])
        for other in heaps[:0:-1]:
            heaps[0].push(*other.rows())
        assert list(zip(*(x.tolist() for x in heaps[0].rows()))) == want


SCHEMA = "vec_id bigint, label string, embedding array<double>, rank string, score string, id string, anchor_id string, a string, block string"


def brute(rows, step=10, window=(30, 90)):
    """Rows of (id, label, vector) that take part, each once."""
    width = max((len(v) for _, _, v in rows), default=0)
    part = {(i, c, tuple([int(np.floor(256 * x)) for x in v] + [0] * (width - len(v)))) for i, c, v in rows}
    anchors = {}
    for i, c, v in sorted(part):
        anchors.setdefault(i, (c, v))
    out = set()
    for i, (label, v) in anchors.items():
        if i % step:
            continue
        scored = {(-sum(x * y for x, y in zip(v, w)), j, c) for j, c, w in part}
        near = sorted((s, j) for s, j, c in scored if c == label and j != i)[:5]
        far = sorted({(s, j) for s, j, c in scored if c != label})
        for s, j in near:
            inside = [(t, k) for t, k in far if window[0] * -s <= 100 * -t <= window[1] * -s][:10]
            out |= {(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(inside)}
    return out


def test_against_brute_force(spark):
    rng = np.random.default_rng(7)
    x = rng.integers(-40, 60, (300, 9)) / 64 + 0.3  # coarse: many ties
    rows = [(i, "abc"[min(2, int(rng.integers(0, 4)))], [float(v) for v in r]) for i, r in enumerate(x)]
    rows += rows[20:30]  # repeated rows
    rows += [(20, "z", rows[33][2]), (20, "a", [9.0] * 9)]  # one id, other contents
    rows += [(400 + i, "a", rows[5][2][:i]) for i in range(9)]  # shorter vectors, an empty one
    plain = [(i, c, v) for i, c, v in rows]
    rows += [(None, "a", [1.0] * 9), (500, None, [1.0] * 9), (510, "a", None), (520, "a", [1.0, None]), (530, "a", [float("nan")]),
             (540, "b", [float("inf"), 1.0]), (550, "b", [1.0, float("-inf")])]
    df = spark.createDataFrame([(i, c, v, *"uvwxyz") for i, c, v in rows], SCHEMA).repartition(7)
    got = N.hard_negatives(df, F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(plain)
    assert len(want) > 500
    assert sorted(map(tuple, got.collect())) == sorted(want)
    # many small blocks of anchors give the same
    assert sorted(map(tuple, N.hard_negatives(df, F.col("vec_id") % 10 == 0, anchor_numbers=60).collect())) == sorted(want)


def test_empty_tables_and_large_components(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert N.hard_negatives(none, F.col("vec_id") % 10 == 0).count() == 0
    one = spark.createDataFrame([(1, "a", [1.0], *"uvwxyz")], SCHEMA)
    assert N.hard_negatives(one, F.col("vec_id") % 10 == 0).count() == 0  # no anchor
    assert N.hard_negatives(one, F.col("vec_id") % 1 == 0).count() == 0  # no positive
    huge = spark.createDataFrame([(10, "a", [1e300], *"uvwxyz"), (20, "a", [1.0], *"uvwxyz")], SCHEMA)
    with pytest.raises(Exception, match="too large for exact"):
        N.hard_negatives(huge, F.col("vec_id") % 10 == 0)
