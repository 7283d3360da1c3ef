"""Hard negatives against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltworks.llm import hard_negatives
from tests.llm.conftest import as_multiset

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, every=50, positives=5, negatives=3):
    used = [
        (key, [math.floor(256 * float(np.float32(x))) for x in vector], label)
        for key, vector, label in rows
        if label is not None and vector is not None
        and all(x is not None and math.isfinite(x) for x in vector)
    ]

    def order(row):
        return -row[0], row[1] is None, row[1] or 0

    found = []
    for at, (anchor, own, label) in enumerate(used):
        if anchor is None or anchor % every:
            continue
        scored = [
            (sum(a * b for a, b in zip(own, other)), key, kind)
            for i, (key, other, kind) in enumerate(used) if i != at
        ]
        same = sorted((r for r in scored if r[2] == label), key=order)[:positives]
        for score, positive, _ in same:
            hard = [r for r in scored if r[2] != label and 50 * score <= 100 * r[0] <= 95 * score]
            for rank, (value, key, _) in enumerate(sorted(hard, key=order)[:negatives], 1):
                found.append((anchor, positive, rank, key, score, value))
    return found


def vectors(seed, rows, dims, labels, scale=0.3):
    rng = np.random.default_rng(seed)
    values = rng.normal(0, scale, (rows, dims)).astype(np.float32)
    values[rows // 2 :] += values[rng.integers(0, 5, rows - rows // 2)]
    kinds = rng.integers(0, labels, rows)
    return [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(values, kinds))]


def awkward_vectors():
    rows = vectors(1, 260, 13, 3)
    rows += [
        (None, [0.4] * 13, 1), (None, rows[0][1], rows[0][2]), (300, None, 1), (350, [0.1] * 13, None),
        (400, [float("nan")] * 13, 1), (401, [float("inf")] + [0.1] * 12, 2), (450, [], 1), (402, [None, 0.1], 1),
        (500, [0.3] * 5, 0), (403, [0.5] * 30, 1), (550, [0.3] * 20, 2), (-50, [0.2] * 13, 7),
        rows[50], rows[50], rows[60], (600, [0.0] * 13, 1), (404, [4000.0, -4000.0] + [0.1] * 11, 0),
    ]
    # Ties: a third of the rows are one vector.
    return rows + [(1000 + i, [0.25] * 13, i % 3) for i in range(90)]


@pytest.mark.parametrize(
    "settings", [{}, {"block_rows": 16, "block_anchors": 3}, {"positives": 2, "negatives": 6}]
)
def test_triples(spark, settings):
    rows = awkward_vectors()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    frame = frame.withColumns({n: F.lit(n) for n in ("anchor_id", "RANK", "_whole", "negative_score")})
    found = hard_negatives.hard_negatives(frame, **settings)
    wanted = plain(rows, **{k: v for k, v in settings.items() if not k.startswith("block")})
    assert wanted and as_multiset(found.collect()) == as_multiset(wanted)
    assert found.schema == spark.createDataFrame([], hard_negatives.RESULTS).schema


def test_one_label(spark):
    """Without rows of another label, without anchors, and without rows."""
    rows = vectors(2, 60, 8, 1)
    assert hard_negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA)).count() == 0
    assert hard_negatives.hard_negatives(spark.createDataFrame(rows[1:40], SCHEMA)).count() == 0
    assert hard_negatives.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("size", [1, 100, 70_000, (1 << 20) - 1])
@pytest.mark.parametrize("dims", [1, 8, 21])
def test_scores(size, dims):
    """Tables and bit-planes give the inner products, whatever the number of bits."""
    rng = np.random.default_rng(dims)
    anchors = rng.integers(-size, size + 1, (5, dims))
    rows = rng.integers(-size, size + 1, (40, dims))
    planes = hard_negatives.planes_of(rows)
    found = hard_negatives.scores(hard_negatives.subset_sums(anchors), planes)
    assert (found == rows @ anchors.T).all()
    tables = hard_negatives.subset_sums(anchors)
    assert tables.shape[1] == 256 and tables[0, 5, 2] == anchors[2, [0, 2][: min(2, dims)]].sum() if dims > 2 else True


def test_planes_hold_the_rows():
    rows = np.random.default_rng(3).integers(-300, 300, (50, 11))
    planes = hard_negatives.planes_of(rows)
    assert planes.shape == (10, 2, 50)
    block = hard_negatives.Block(
        {"start": 7, "dims": 11, "ids": np.arange(50).tobytes(), "labels": np.zeros(50, np.int64).tobytes(), "planes": planes.tobytes()}
    )
    wanted = np.array([3, 49, 0])
    assert (hard_negatives.values_of(block, wanted, 11) == rows[wanted]).all()
    assert block.rows[3] == 10


def test_large_component(spark):
    rows = [(0, [5000.0], 1), (1, [1.0], 1)]
    with pytest.raises(Exception, match="not below"):
        hard_negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA)).count()
