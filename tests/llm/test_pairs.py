"""Near copies of texts and of vectors against all pairs; components against a plain search."""

import math
import random

import pytest

from spanloom.llm.embed import Grid, _slack, near_vectors, unit, visits
from spanloom.llm.graph import components
from spanloom.llm.jaccard import SMALL, Shingles, least_common, most_common, near_groups, parity_bits, similar
from tests.llm.tables import awkward_texts, crowded, documents, words


def _roots(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    pick = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)] + [(5, 5)]
    links += [(pick.randrange(300, 400), pick.randrange(300, 400)) for _ in range(70)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = _roots({n for a, b in links for n in (a, b)}, links)
    assert got == {n: r for n, r in want.items() if n != 5}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def _near_copies(seed: int) -> list[tuple]:
    pick = random.Random(seed)
    rows = []
    for family in range(6):
        base = words(1000 + family, 60 + 40 * family, 5000).split()
        for _ in range(12):
            own = list(base)
            for _ in range(pick.randrange(5)):
                own[pick.randrange(len(own))] = f"n{pick.randrange(10**6)}"
            rows.append((len(rows), " ".join(own).upper() if pick.random() < 0.3 else "  ".join(own)))
    common = words(5, 60)
    rows += [(len(rows) + i, common + " " + words(77 + i, 14, 9000)) for i in range(30)]
    return rows


@pytest.mark.parametrize("rows", [_near_copies(1), _near_copies(2), [r for r in awkward_texts() if r[0] is not None and r[0] != 5]])
def test_near_groups(spark, rows):
    def shingles(text):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for c in "\t\n\x0b\x0c\r":
            w = w.replace(c, " ")
        w = [x for x in w.split(" ") if x]
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {d: shingles(t) for d, t in rows}
    ids = sorted(sets)
    links = [
        (a, b) for a in ids for b in ids
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    roots = _roots(ids, links)
    assert links
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_groups(crowded(documents(spark, rows))).collect()}
    assert got == {d: (len(sets[d]), roots[d]) for d in ids}


def test_near_groups_of_lists_about_the_small_size(spark):
    pick = random.Random(8)
    rows = []
    for family, size in enumerate((2, SMALL - 1, SMALL, SMALL + 1, 3 * SMALL)):
        base = words(2000 + family, 120, 10**6).split()
        for i in range(size):  # a chain: each text changes one more word than the one before
            base[i * 3 % 120] = f"c{family}_{i}"
            rows.append((len(rows), " ".join(base)))
            rows.append((len(rows), " ".join(base[:40] + [f"x{pick.random()}" for _ in range(40)] + base[80:])))

    make = Shingles(5)
    sets = {d: set(make(t).tolist()) for d, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    got = {r["doc_id"]: r["component_id"] for r in near_groups(documents(spark, rows)).collect()}
    assert links and got == _roots(sets, links)


def test_near_groups_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (4, "A b c d e f"), (4, "A b c d e f"), (None, "alone"), (3, None), (2, "  ")]
    got = sorted(map(tuple, near_groups(documents(spark, rows)).collect()), key=repr)
    assert got == sorted([(None, 2, 4), (4, 2, 4), (4, 2, 4), (None, 1, None), (3, 0, 3), (2, 0, 2)], key=repr)
    assert near_groups(crowded(documents(spark, []))).collect() == []


def test_filters_never_miss():
    make = Shingles(5)
    for seed in range(40):
        one = words(seed, 80, 10**6).split()
        other = one[: 80 - seed] + words(seed + 500, seed, 10**6).split()
        a, b = make(" ".join(one)), make(" ".join(other))
        common = len(set(a.tolist()) & set(b.tolist()))
        assert most_common(a, b) >= common
        assert similar(a, b) == (100 * common >= 80 * (len(a) + len(b) - common))
        assert (common >= least_common(len(a), len(b))) == (100 * common >= 80 * (len(a) + len(b) - common))


def _vectors() -> list[tuple]:
    pick = random.Random(9)
    rows = []
    for family in range(40):
        base = [pick.gauss(0, 1) for _ in range(16)]
        for _ in range(1 + family % 9):
            rows.append((len(rows), [float(x + pick.gauss(0, 0.08)) for x in base]))
    rows += [(len(rows) + i, rows[0][1]) for i in range(3)]
    rows.append((len(rows), [2 * x for x in rows[0][1]]))
    size = len(rows)
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [1.0, 2.0]]
    return rows + [(size + i, v) for i, v in enumerate(odd)] + [(None, rows[0][1]), (3, rows[3][1])]


def test_near_vectors(spark):
    rows = _vectors()

    def linked(a, b):
        if not a or not b or len(a) != len(b) or any(x is None or not math.isfinite(x) for x in (*a, *b)):
            return False
        size = math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))
        return size > 0 and (a == b or sum(x * y for x, y in zip(a, b, strict=True)) / size >= 0.95)

    places = range(len(rows))
    links = [(i, j) for i in places for j in places if i < j and linked(rows[i][1], rows[j][1])]
    roots = _roots(places, links)
    named = {}
    for i in places:
        if rows[i][0] is not None:
            named[roots[i]] = min(named.get(roots[i], 10**9), rows[i][0])
    want = [(rows[i][0], sum(i in p for p in links), named.get(roots[i])) for i in places]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = near_vectors(crowded(table)).collect()
    assert sorted(map(tuple, (r[:3] for r in got)), key=repr) == sorted(want, key=repr)
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)


def test_vectors_of_every_length_are_searched(spark):
    pick = random.Random(4)
    rows = []
    for width, count in ((16, 30), (7, 12), (5, 12), (1, 6)):
        base = [pick.gauss(0, 1) for _ in range(width)]
        for i in range(count):
            away = base if i % 3 else [-x for x in base]
            rows.append((len(rows), [(1 + i) * x + (0 if i % 2 else pick.gauss(0, 0.01)) for x in away]))

    def linked(a, b):
        sizes = math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))
        return len(a) == len(b) and sum(x * y for x, y in zip(a, b, strict=True)) / sizes >= 0.95

    links = [(i, j) for i, a in rows for j, b in rows if i < j and linked(a, b)]
    roots = _roots(range(len(rows)), links)
    want = {i: (sum(i in p for p in links), roots[i]) for i in roots}
    for some in (rows, rows[-6:]):  # the second table has vectors of length 1 alone
        table = spark.createDataFrame(some, "vec_id long, embedding array<double>").repartition(3)
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors(table).collect()}
        assert got == {i: want[i] for i, _ in some}


def test_slack_heeds_small_groups(spark):
    import numpy as np

    pick = np.random.default_rng(6)
    hot = pick.normal(size=64)
    rows = [hot + pick.normal(size=64) * 0.001 for _ in range(900)]  # links by the hundred thousand
    for _ in range(100):  # pairs at the limit that differ in two dimensions alone
        one = np.zeros(64)
        one[[0, 40]] = pick.normal(size=2)
        side = np.zeros(64)
        side[[0, 40]] = -one[40], one[0]
        rows += [one + 0.01 * pick.normal(size=64), one + 0.3 * side]
    points = unit(np.array(rows))
    grid = Grid(points, 16)
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rows)], "_node long, _vector array<double>").repartition(3)
    slack = _slack(table, grid, 0.95, 0.999, 64)
    (own_first, first), (own_second, second) = grid.places(points)
    a, b = np.nonzero(points @ points.T >= 0.95)
    a, b = a[a != b], b[a != b]
    far = first[a, own_first[b]] + second[a, own_second[b]] > slack
    small = a >= 900
    assert far[small].mean() < 0.01


def test_no_vectors(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_vectors(table).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, near_vectors(nothing).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_visits_come_nearest_first():
    import numpy as np

    first, second = np.array([0.3, 0.0, 0.1]), np.array([0.2, 0.05, 0.0])
    assert visits(first, second, 0.25) == [(1, [2, 1, 0]), (2, [2, 1])]


def test_parity_bits_bound_the_difference():
    make = Shingles(5)
    for seed in range(30):
        one = words(seed, 50 + 20 * seed, 10**5).split()
        other = one[: 40 + 10 * seed] + words(seed + 900, 3 * seed, 10**5).split()
        a, b = make(" ".join(one)), make(" ".join(other))
        pairs = zip(parity_bits(a).tolist(), parity_bits(b).tolist(), strict=True)
        differ = sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in pairs)
        assert differ <= len(set(a.tolist()) ^ set(b.tolist()))
        assert not similar(a, b) or 9 * differ <= len(a) + len(b)
