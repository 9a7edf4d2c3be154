"""Periodic runs against a search of all periods and stretches, and the query against its contract."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from spanloom.llm.periodic import periodic_runs, runs_of
from spanloom.llm.queries import op12_periodic
from tests.llm.tables import awkward_texts, crowded, documents


def _plain(words, times=4, least=6):
    """Per period, the longest stretches in which words that far apart are equal; of each stretch the smallest period."""
    best = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, times * q) and j > i:
                best.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((start, length, q) for (start, length), q in best.items())


def _collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def _words(pick, count):
    """Words with planted runs, nested and touching ones too."""
    letters = "ab" if pick.random() < 0.4 else "abcdefgh"
    out = []
    while len(out) < count:
        part = [pick.choice(letters) for _ in range(pick.randrange(1, 9))]
        if pick.random() < 0.3:
            part = part * pick.randrange(2, 5) + [pick.choice(letters)]
        out += part * (pick.randrange(3, 9) if pick.random() < 0.5 else 1)
    return out[:count]


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_several_texts(seed):
    pick = random.Random(seed)
    texts = [_words(pick, pick.randrange(0, 120)) for _ in range(60)] + [["x"] * 300, [], ["a", "b"] * 40 + ["a"], ["a", "a", "b"] * 20 + ["a", "a", "a"] * 5]
    ids = {}
    codes = np.array([ids.setdefault(w, len(ids)) for t in texts for w in t], np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    start, stop, period = runs_of(codes, bounds, 4, 6)
    got = {i: [] for i in range(len(texts))}
    for s, e, q in zip(start.tolist(), stop.tolist(), period.tolist(), strict=True):
        i = int(np.searchsorted(bounds, s, side="right")) - 1
        got[i].append((s - int(bounds[i]), e - s, q))
    assert [got[i] for i in got] == [_plain(t) for t in texts]


def _rows():
    pick = random.Random(9)
    rows = [(100 + i, " ".join(_words(pick, pick.randrange(0, 90)))) for i in range(80)]
    rows += [(300, "x " * 40_000), (301, ("a b c d " * 30_000) + "e"), (302, "\x0bÜ\x0bÜ\x0cÜ Ü Ü\tÜ  x "), (100, rows[0][1]), (303, "\x1c " * 9)]
    return [*awkward_texts(), *rows]


def _per_row(df):
    return sorted(((r[0], [tuple(x) for x in r[1]], r[2]) for r in df.collect()), key=repr)


def test_equals_all_periods(spark):
    small = [r for r in _rows() if len(r[1] or "") < 2_000]
    want = []
    for i, text in small:
        words = [w.decode() for w in (text or "").encode().split()]
        want.append((i, _plain(words), _collapsed(words, _plain(words))))
    got = _per_row(periodic_runs(documents(spark, small)))
    assert got == sorted(want, key=repr)
    assert _per_row(periodic_runs(crowded(documents(spark, small)))) == got


def test_long_texts_and_empty_table(spark):
    rows = [r for r in _rows() if r[0] in (43, 44, 300, 301)]
    got = {r[0]: (r[1], r[2]) for r in _per_row(periodic_runs(documents(spark, rows)))}
    assert got[300] == ([(0, 40_000, 1)], "x") and got[301] == ([(0, 120_000, 4)], "a b c d e")
    assert got[44] == ([], "x" * 60_000)
    assert periodic_runs(documents(spark).where("false")).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(documents(spark), times=3)


def _contract(doc_id, text):
    """The row of the query, written down from its contract alone."""
    words = [w.decode() for w in (text or "").encode().split()]
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = _plain(words)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    said = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    exponent = 1000 * top[1] // top[2] if runs else None
    shas = [hashlib.sha256(t.encode()).hexdigest() for t in (said, _collapsed(words, runs))]
    return (doc_id, len(runs), *top, exponent, *shas)


def test_query_equals_its_contract(spark, tmp_path):
    rows = [r for r in _rows() if len(r[1] or "") < 2_000]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    df = op12_periodic(spark, str(tmp_path))
    assert df.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {f.dataType.simpleString() for f in df.schema.fields[1:6]} == {"bigint"}
    assert sorted(map(tuple, df.collect()), key=repr) == sorted((_contract(*r) for r in rows), key=repr)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 and t for i, t in rows if i is not None)
