"""Cuts by a counter that is reset, against a counter."""

import random

import pytest

from doclog.operators.cuts import roll_by_counter


def counted(rows, limit, first=1):
    """Segment of each seq: a request opens a new one when the open one holds more than the limit."""
    out, segment, held = {}, first, 0
    sizes = {}
    for seq, size in rows:
        sizes[seq] = sizes.get(seq, 0) + (size or 0)
    for seq in sorted(sizes):
        if held > limit:
            segment, held = segment + 1, 0
        held += sizes[seq]
        out[seq] = segment
    return out


def sizes(rng, n, limit, kind):
    if kind == "small":
        return [rng.randint(0, max(1, limit // 5)) for _ in range(n)]
    if kind == "large":
        return [rng.choice([0, None, 1, limit, limit + 1, 3 * limit, rng.randint(0, 9 * limit)]) for _ in range(n)]
    return [rng.choice([0, 1, 2]) if rng.random() < 0.9 else rng.randint(0, 40 * limit) for _ in range(n)]


@pytest.mark.parametrize("kind", ["small", "large", "mixed"])
@pytest.mark.parametrize("seed", range(2))
def test_equal_to_a_counter(spark, kind, seed):
    rng = random.Random(seed)
    limit = rng.choice([0, 7, 100])
    rows = [(seq * rng.choice([1, 3]), s) for seq, s in enumerate(sizes(rng, 250, limit, kind))]
    got = roll_by_counter(spark.createDataFrame(rows, "seq long, bytes long"), limit, chunk_bits=4, first=5)
    found = [(r.seq, r.segment_id) for r in got.collect()]
    want = counted(rows, limit, 5)
    assert len(found) == len(rows) and set(found) == set(want.items())


def test_no_rows_one_row_and_other_columns(spark):
    kind = "seq long, bytes long, note string"
    assert roll_by_counter(spark.createDataFrame([], kind), 10).collect() == []
    (row,) = roll_by_counter(spark.createDataFrame([(3, None, "n")], kind), 10).collect()
    assert (row.seq, row.bytes, row.note, row.segment_id) == (3, None, "n", 1)
