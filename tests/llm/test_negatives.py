"""Hard negatives, held against all scores of every anchor."""
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import catalog, negatives

FOLDER = "/root/testdata/sf0.01"
KIND = "vec_id long, embedding array<float>, label int, rank string"


def slow(rows, positives=5, hard=3, every=50):
    whole = [(i, label, [int(np.floor(256 * np.float64(x))) for x in v]) for i, v, label, *_ in rows
             if None not in (i, v, label) and None not in v and np.isfinite(v).all()]
    out = []
    for i, label, v in whole:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in whole if j != i)
        for p, j, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p]
            out += [(i, j, n + 1, k, -p, -s) for n, (s, k, _) in enumerate(fit[:hard])]
    return sorted(out)


def clustered(seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (6, 8))
    rows = [(int(i), (centres[i % 6] + rng.normal(0, 0.3, 8)).astype(np.float32).tolist(),
             int(rng.integers(0, 4)), "clash") for i in range(0, 900)]
    # A third of all rows share one vector; some rows are repeated, some can take no part.
    rows += [(900 + i, rows[3][1], int(i % 3), "clash") for i in range(450)]
    rows += [rows[50], rows[50], rows[901], rows[901], rows[7]] + [rows[100]] * 9
    rows += [(50, rows[8][1], 1, "")] * 2
    rows += [(2000, None, 1, ""), (None, rows[0][1], 1, ""), (2050, [None] * 8, 1, ""),
             (2100, [float("nan")] * 8, 1, ""), (2150, rows[0][1], None, ""), (2200, [0.0] * 8, 1, ""),
             (2201, [0.0] * 8, 2, ""), (2250, [], 2, ""), (2300, [1.0], 2, ""), (2350, rows[5][1], 77, ""),
             (2400, (-centres[1]).tolist(), 1, "")]
    return rows


@pytest.mark.parametrize("size", [{}, {"CLUSTERS": 5, "MEMBER_BLOCK": 4, "LIST_BLOCK": 60, "STEP": 7},
                                  {"CLUSTERS": 1, "LIST_BLOCK": 10_000, "STEP": 3}])
def test_hard_negatives(spark, monkeypatch, size):
    for name, value in size.items():
        monkeypatch.setattr(negatives, name, value)
    rows = clustered()
    got = negatives.mine(spark.createDataFrame(rows, KIND).repartition(3)).collect()
    assert sorted(map(tuple, got)) == slow(rows)


def test_whole_table(spark):
    rows = duckdb.execute(f"SELECT vec_id, embedding, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 "
                          f"ELSE label END FROM '{FOLDER}/embeddings.parquet'").fetchall()
    got = sorted(map(tuple, catalog.op13_hard_negatives(spark, FOLDER).collect()))
    assert got == slow(rows) and len(got) > 50
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{FOLDER}/embeddings.parquet'")
    assert sorted(duck.execute(catalog.OP13_SQL).fetchall()) == got


def test_few_rows(spark):
    frame = spark.createDataFrame([(50, [1.0, 0.0], 1, ""), (51, [1.0, 0.5], 1, ""),
                                   (52, [0.9, 0.0], 2, ""), (53, [0.4, 0.0], 2, "")], KIND)
    assert list(map(tuple, negatives.mine(frame).collect())) == [(50, 51, 1, 52, 65536, 230 * 256)]
    assert negatives.mine(frame.filter("vec_id <> 51")).count() == 0
    assert negatives.mine(frame.filter("vec_id > 51")).count() == 0
    assert negatives.mine(frame.limit(0)).count() == 0


def test_wide_numbers(spark):
    """Beyond 2^53 products are added as integers."""
    rows = [(50 * i, [float(2 ** 19 + i), float(3 ** 9 * i)], i % 2) for i in range(14)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, negatives.mine(frame).collect())) == slow(rows)


def test_members_stop_early():
    """On clustered data a walk ends long before its list, with the whole result."""
    rng = np.random.default_rng(3)
    centre = np.zeros(16)
    centre[0] = 1000
    near = np.floor(centre + rng.normal(0, 20, (300, 16)))
    far = np.floor(rng.normal(0, 300, (6000, 16)))
    vectors = np.r_[near, far].astype("<i8")
    norm = np.linalg.norm(vectors, axis=1)
    cells = negatives.Cells(near[:50], 1)
    spread = cells.angles([v.tobytes() for v in vectors[:20]]).max(axis=0)
    bound = negatives.bounds(norm, cells.angles([v.tobytes() for v in vectors]), spread)[:, 0]
    order = np.argsort(-bound, kind="stable")
    label = np.zeros(len(vectors), int)

    class Counted(dict):
        looked = 0

        def __getitem__(self, key):
            self.looked += key == "row"
            return super().__getitem__(key)
    them = Counted(vec=[v.tobytes() for v in vectors], row=order, bound=bound[order], vec_id=order,
                   label=label)
    us = dict(vec=[v.tobytes() for v in vectors[:20]], norm=norm[:20], who=np.arange(20),
              vec_id=np.arange(20), label=label[:20], low=np.full(20, negatives.NONE + 1),
              high=np.full(20, -negatives.NONE))
    question, score, place = negatives.walk(us, them, 5, True, 16, True)
    assert them.looked * negatives.STEP < len(vectors) / 4
    for q in range(20):
        scored = sorted((-int(vectors[q] @ v), i) for i, v in enumerate(vectors) if i != q)[:5]
        assert [(-s, i) for s, i in scored] == list(zip(score[question == q], order[place[question == q]]))
