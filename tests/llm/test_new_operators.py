"""Lattice hashing, conversation trie and spelling variants against plain-Python versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickmart.llm import prefix_trie, spelling, vector_dedup
from clickmart.llm._store import ship_package
from tests.llm import brute
from tests.llm.fixtures import empty, messy, messy_rows, same_rows

VECTORS = "vec_id long, embedding array<float>, label int"
TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def rotated(rng, x, cos):
    """Random unit vectors at the given cosine from unit vectors."""
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    return cos * x + np.sqrt(1 - cos * cos) * z / np.linalg.norm(z, axis=1, keepdims=True)


def unit(rng, n, dim=64):
    x = rng.normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def vector_rows():
    rng = np.random.default_rng(1)
    x = unit(rng, 60)
    groups = [x, rotated(rng, x[:20], 0.93), rotated(rng, x[:10], 0.88), rotated(rng, np.repeat(x[30:31], 40, 0), 0.99), 7.5 * x[40:45]]
    rows = [(i, [float(np.float32(v)) for v in vector], 0) for i, vector in enumerate(np.concatenate(groups))]
    nan, inf = float("nan"), float("inf")
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * 64, 1), (503, [nan] + [1.0] * 63, 1), (504, [inf] * 64, 1), (505, [None] + [1.0] * 63, 1),
             (506, [1.0, 0.0], 1), (507, [2.0, 0.0], 1), (508, [-0.0, 1.0], 1), (509, [0.0, 1.0], 1), (None, [1.0, 0.1], 1), (None, None, None),
             (None, [-1.0, 3.0, 0.0], 1), (rows[3][0], rows[3][1], 2), (510, rows[3][1], 2), (511, rows[3][1], None), (512, [1e-30, 1e-30], 0), (512, [1e30, 1e30], 0)]
    return rows


def test_vectors_equal_brute_force(spark):
    rows = vector_rows()
    df = spark.createDataFrame(rows, VECTORS).repartition(3).withColumns({c: F.lit("clash") for c in ("kept", "vid", "cid", "vec", "n_links", "cell")})
    expected = brute.near_vectors([r[:2] for r in rows])
    # With a tiny limit for cells, all levels of dealing again are in use.
    for options in ({}, {"piece": 6, "leaders": 1}):
        out = vector_dedup.near_vectors(df, **options)
        assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
        same_rows(out.collect(), expected)
    assert vector_dedup.near_vectors(spark.createDataFrame([], VECTORS)).collect() == []
    assert len(vector_dedup.near_vectors(spark.createDataFrame([(1, None, 0), (2, [], 0)], VECTORS)).collect()) == 2


def test_recall_at_the_limit_and_a_hot_group(spark):
    """Of pairs just over the limit nearly all are found, none below it; a group of a third of all rows keeps all its links."""
    rng = np.random.default_rng(3)
    x = unit(rng, 1500)
    near, below, hot = rotated(rng, x[:1000], 0.902), rotated(rng, x[1000:1400], 0.897), rotated(rng, np.repeat(x[1499:], 900, 0), 0.985)
    a = np.concatenate([x, near, below, hot]).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(a)]
    got = {r["vec_id"]: r for r in vector_dedup.near_vectors(spark.createDataFrame(rows, VECTORS).repartition(7)).collect()}
    d = a.astype(np.float64)
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    true = (d @ d.T >= 0.9).sum(axis=1) - 1
    found = np.array([got[i]["n_links"] for i in range(len(rows))])
    assert (found <= true).all()
    assert found[1500:2500].sum() >= 0.97 * true[1500:2500].sum()
    assert (found[-900:] == true[-900:]).all() and (true[-900:] >= 900).all()
    assert {got[i]["component_id"] for i in range(len(rows) - 900, len(rows))} == {1499}


def test_e8_decoding_is_the_nearest_point():
    rng = np.random.default_rng(4)
    y = rng.normal(size=(300, 8)) * 2
    point = vector_dedup.nearest_e8(y)
    doubled = 2 * point
    assert (doubled == doubled.round()).all() and ((doubled % 2 == doubled[:, :1] % 2).all()) and (point.sum(axis=1) % 2 == 0).all()
    assert len({tuple(v) for v in vector_dedup.NEIGHBOURS}) == 240 and np.allclose((vector_dedup.NEIGHBOURS ** 2).sum(axis=1), 2)
    # No lattice point beside it is nearer; E8's Voronoi cell is bounded by these and the vectors of norm 4.
    around = point[:, None] + vector_dedup.NEIGHBOURS
    assert (((y[:, None] - around) ** 2).sum(axis=2) >= ((y - point) ** 2).sum(axis=1)[:, None] - 1e-9).all()


def turn_rows():
    rng = random.Random(2)
    texts = ["hello", "hi there", "", None, "Über 🙂", "x" * 40_000, "yes", "no"]
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(texts)) for c in range(90, 320) for t in range(rng.randint(1, 4))]
    same = [("user", "same"), ("assistant", "same too"), ("user", "and last")]
    rows += [(c, t, *same[t % 3]) for c in range(400, 520) for t in range(7)]  # a third are copies
    rows += [(600, None, "user", "no number"), (600, 0, "user", "first"), (600, 0, "user", "tie"), (600, 0, "user", "tie"), (None, 1, "user", "no id"),
             (-205, 0, "user", "negative"), (-200, 0, "user", "head"), (700, 5, None, None), (7, 3, "ab", "c"), (8, 3, "a", "bc"), (10 ** 15, 0, "user", "far")]
    rows += [(900, t, "user", str(t % 3)) for t in range(900)]
    return rows


def test_trie_equals_brute_force(spark):
    rows = turn_rows()
    df = spark.createDataFrame(rows, TURNS).repartition(3).withColumns({c: F.lit("clash") for c in ("depth", "key", "turns", "block", "chars", "h1")})
    expected = brute.trie(rows)
    for block in (prefix_trie.BLOCK, 50, 1):  # small blocks: nodes reach over many of them
        same_rows(prefix_trie.conversation_trie(df, block).collect(), expected)
    assert prefix_trie.conversation_trie(spark.createDataFrame([], TURNS)).collect() == []
    only_empty = [(6, 0, "user", "a"), (5, 0, "user", "a")]  # both lose their only turn if h is over 0
    same_rows(prefix_trie.conversation_trie(spark.createDataFrame(only_empty, TURNS)).collect(), brute.trie(only_empty))


def test_sparse_table_extents():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 5, 77)
    table = prefix_trie.SparseTable(values)
    at, least = np.arange(77).repeat(6), np.tile(np.arange(6), 77)
    left, right = table.reach_left(at, least), table.reach_right(at, least)
    for i, d, a, b in zip(at, least, left, right):
        assert (values[a + 1:b + 1] >= d).all()
        assert (a == 0 or values[a] < d) and (b == 76 or values[b + 1] < d)
    assert (table.minimum(left, right) == [values[a:b + 1].min() for a, b in zip(left, right)]).all()


def spelling_rows():
    rng = random.Random(6)
    base = ["".join(rng.choice("abcdeéÀß") for _ in range(rng.randint(5, 9))) for _ in range(60)]
    words = base * 6 + [w[:i] + x + w[i + 1:] for w in base for i in (0, 2, 4) for x in ("", "a", "aa")] * 3
    words += ["aaaaa", "aaaaaa", "aaaaaaa"] * 5 + ["x" * 3000, "x" * 3001] * 4 + ["×÷×÷×"] * 4
    words += ["kettex"] * 3 + ["kettexy"] * 9 + ["kettexyz"] * 30  # a chain of forms
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::40])) for i in range(40)]
    return rows + [(None, "aaaaa base1word aaaaa"), (3, None), (4, ""), (5, "12 !?"), (rows[0][0], rows[0][1]), (None, None), (6, "MiXed mixed MIXED Àéßab àéßab")]


def test_variants_equal_brute_force(spark):
    rows = spelling_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit("clash") for c in ("word", "n", "form", "bucket", "l")})
    for typo, piece in ((97, spelling.PIECE), (3, 40)):  # small buckets: dealt again until the rest is one letter
        expected = brute.spelling(rows, typo=typo)
        got = spelling.spelling_variants(df, typo=typo, piece=piece)
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        same_rows(got.collect(), expected)
        assert any(r[1] for r in expected) and any(r[2] != r[1] and r[1] for r in expected)
    same_rows(spelling.spelling_variants(messy(spark)).collect(), brute.spelling([r[:2] for r in messy_rows()]))
    assert spelling.spelling_variants(empty(spark)).collect() == []


def test_runs_are_counted_over_cuts():
    rng = random.Random(8)
    text = "".join(rng.choice("abÀ é.1") for _ in range(5000))
    whole, parts = spelling._RUN.findall(text), []
    for part in spelling._cuts(text, 37):
        parts += spelling._RUN.findall(part)
    assert parts == whole and "".join(spelling._cuts(text, 37)) == text
