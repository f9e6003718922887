import numpy as np
import pytest

from pagetables.llm import neighbours, queries
from pagetables.llm.neighbours import MultiIndex, SearchParams


def exact(ids, x, asked, k=20):
    out = {}
    for q in asked:
        others = ids != ids[q]
        score = (x * x[q]).sum(axis=1)[others]
        best = np.lexsort((ids[others], -score))[:k]
        out[int(ids[q])] = list(zip(ids[others][best].tolist(), score[best].tolist()))
    return out


@pytest.fixture(scope="module")
def crowded(spark, tmp_path_factory):
    """More than four full blocks of vectors; one vector is that of a third of all rows."""
    draw = np.random.default_rng(7)
    n, width = 34_000, 64
    x = draw.normal(size=(n, width))
    x[draw.random(n) < 1 / 3] = draw.normal(size=width)
    x /= np.linalg.norm(x, axis=1)[:, None]
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path_factory.mktemp("vectors")
    rows = pa.table({"vec_id": np.arange(n), "embedding": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), width).cast(pa.list_(pa.float64()))})
    pq.write_table(rows, folder / "embeddings.parquet", row_group_size=8_000)
    return str(folder)


@pytest.mark.parametrize("data", ["sf0.001", "crowded"])
def test_recall_against_brute_force(spark, data, request):
    folder = f"/root/testdata/{data}" if data != "crowded" else request.getfixturevalue("crowded")
    table = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").toPandas()
    ids, x = table.vec_id.to_numpy(), np.array(table.embedding.tolist(), float)
    want = exact(ids, x, np.flatnonzero(ids % 20 == 0))
    from pyspark.sql import functions as F

    if data == "crowded":
        found = neighbours.nearest(spark.read.parquet(f"{folder}/embeddings.parquet"), F.col("vec_id") % 20 == 0, params=SearchParams(block=4096))
    else:
        found = queries.op4_neighbours(spark, folder)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.95
    for q, found in got.items():
        assert found == sorted(found, key=lambda r: (-r[1], r[0]))
        place = {i: k for k, i in enumerate(ids.tolist())}
        assert all(abs(s - float(x[place[i]] @ x[place[q]])) < 1e-12 for i, s in found)


def _codes_around(centre, n, most, rng):
    codes = np.tile(centre, (n, 1))
    for row in codes:
        for b in rng.integers(0, 256, rng.integers(0, most)):
            row[b // 8] ^= np.uint8(1 << (b % 8))
    return codes


def test_probing_finds_every_code_within_its_radius():
    rng = np.random.default_rng(0)
    centre = rng.integers(0, 256, 32).astype(np.uint8)
    codes = _codes_around(centre, 601, 150, rng)
    index = MultiIndex(codes, SearchParams())
    gaps = np.bitwise_count(codes ^ centre).sum(axis=1)
    for level, certain in enumerate((31, 63, 95, 127)):
        found = np.unpackbits(index.probe(centre[None, :], level)[0], count=len(codes), bitorder="little").astype(bool)
        assert index.certain(level) == certain and found[gaps <= certain].all()
        # nothing but what some substring leads to
        apart = np.bitwise_count(codes ^ centre).min(axis=1)
        assert (found == (apart <= level)).all()


def test_search_gives_all_codes_within_the_least_radius():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 256, 32).astype(np.uint8)
    far = rng.integers(0, 256, (3000, 32)).astype(np.uint8)
    codes = np.concatenate((_codes_around(centre, 300, 60, rng), far))
    params = SearchParams(candidates=200, share=0.0)
    asked = np.concatenate((centre[None], far[:20], ~centre[None]))
    for index in (MultiIndex(codes, params), MultiIndex(codes, params)):
        for rounds in range(2):  # a second search on an index that has risen gives the same
            for q, (near, radius) in zip(asked, index.search(asked)):
                gaps = np.bitwise_count(codes ^ q).sum(axis=1)
                assert radius == np.sort(gaps)[199] and sorted(near.tolist()) == np.flatnonzero(gaps <= radius).tolist()
    few = MultiIndex(codes[:5], params)
    assert sorted(few.search(centre[None])[0][0].tolist()) == [0, 1, 2, 3, 4]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (2, [2.0, 0.0]), (20, None), (40, [0.0, 0.0]), (60, [nan, 1.0]), (80, [inf, 1.0]),
        (3, [None, 1.0]), (4, []), (5, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (100, [-1.0, 0.0]), (6, [-3.0, 4.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "vec_id AS block", "vec_id AS id", "1 AS kind")
    from pyspark.sql import functions as F

    got = neighbours.nearest(table, F.col("vec_id") % 20 == 0, k=20).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [
        (0, 1, 2, 2.0), (0, 2, 1, 0.5), (0, 3, 2, 0.5), (0, 4, 100, -1.0), (0, 5, 6, -3.0),
        (100, 1, 6, 3.0), (100, 2, 1, -0.5), (100, 3, 2, -0.5), (100, 4, 0, -1.0), (100, 5, 2, -2.0),
    ]
    assert neighbours.nearest(table.where("false"), F.lit(True)).count() == 0
    assert neighbours.nearest(table.where("vec_id = 40"), F.lit(True)).count() == 0


def test_rows_that_repeat_an_id_do_not_hide_others(spark):
    from pyspark.sql import functions as F

    rows = [(0, [1.0, 0.0])] * 50 + [(k, [1.0, 0.0]) for k in range(1, 30)] + [(k, [-0.0, 1.0]) for k in range(30, 33)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(table, F.col("vec_id").isin(0, 5), k=3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(0, 1), (0, 2), (0, 3), (5, 0), (5, 0), (5, 0)]


def test_many_equal_vectors_give_the_smallest_ids(spark):
    from pyspark.sql import functions as F

    table = spark.range(3000).select(F.col("id").alias("vec_id"), F.array(*[F.lit(float(k)) for k in (1, 2, 3)]).alias("embedding"))
    got = neighbours.nearest(table, F.col("vec_id").isin(0, 2980), k=5, params=SearchParams(block=500, candidates=10)).collect()
    assert sorted((r.query_id, r.vec_id) for r in got) == [(0, k) for k in range(1, 6)] + [(2980, k) for k in range(5)]
