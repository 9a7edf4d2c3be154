"""Ordered operators against plain loops on random sequences."""

import random

import pytest

from spanloom.operators import spans as S
from spanloom.operators.carry import Mark, carry_forward
from spanloom.schema import REPEATED_OPS, SINGLE_OPS

KINDS = SINGLE_OPS + REPEATED_OPS


def loop_spans(rows):
    """(file, line) -> first line of its span, by the rules as a loop."""
    open_spans, out = {}, {}
    for file, line, cursor, op in rows:
        if op == "RESET":
            open_spans = {k: None for k in open_spans if k[0] != file} | {
                k: v for k, v in open_spans.items() if k[0] != file
            }
            continue
        current = open_spans.get((file, cursor))
        if current is None or op == "PIC" or (op in SINGLE_OPS and op in current[1]):
            current = (line, set())
            open_spans[(file, cursor)] = current
        current[1].add(op)
        out[(file, line)] = current[0]
    return out


def random_rows(seed, n, kinds, cursors=3, files=2, resets=0.03):
    rng = random.Random(seed)
    rows, line = [], 0
    for _ in range(n):
        line += rng.randint(1, 3)
        file = f"f{rng.randrange(files)}"
        if rng.random() < resets:
            rows.append((file, line, None, "RESET"))
        else:
            rows.append((file, line, f"#10{rng.randrange(cursors)}", rng.choice(kinds)))
    return rows


@pytest.mark.parametrize(
    "seed,kinds,resets,size,levels",
    [
        (1, KINDS, 0.03, 16, 1),
        (2, [k for k in KINDS if k != "PIC"], 0.0, 8, 2),
        (3, ["BINDS", "EXEC", "CLOSE"], 0.0, 4, 2),
        (4, ["PARSE", "EXEC", "FETCH"], 0.01, 1 << 13, 0),
    ],
)
def test_spans_equal_a_loop(spark, monkeypatch, seed, kinds, resets, size, levels):
    rows = random_rows(seed, 600, kinds, resets=resets)
    df = spark.createDataFrame(
        [(*r, "x" if r[3] == "PIC" else None) for r in rows],
        "file_name string, line bigint, cursor_id string, ops string, sql_id string",
    )
    segmented = S.segment_calls(df)
    starts = S.repeated_starts(segmented, size=size, levels=levels)
    cut = S.cut_spans(segmented, starts)
    found = S.number_spans(cut).select("file_name", "line", "span_id").collect()
    want = loop_spans(rows)
    assert len(found) == len(want)
    groups, expected = {}, {}
    for r in found:
        groups.setdefault(r["span_id"], set()).add((r["file_name"], r["line"]))
    for key, first in want.items():
        expected.setdefault((key[0], first), set()).add(key)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_strictly_periodic_calls_keep_their_phase(spark):
    """No local pattern shows where a span starts; the state has to travel over all blocks."""
    kinds = ["BINDS", "EXEC", "CLOSE"]
    rows = [("f", i + 1, "#100", kinds[(i + 1) % 3]) for i in range(500)]
    df = spark.createDataFrame(
        [(*r, None) for r in rows],
        "file_name string, line bigint, cursor_id string, ops string, sql_id string",
    )
    segmented = S.segment_calls(df)
    starts = S.repeated_starts(segmented, size=7, levels=2).collect()
    assert sorted(r["line"] for r in starts) == list(range(4, 501, 3))


@pytest.mark.parametrize("size", [1, 5, 1 << 16])
def test_carry_forward_equals_a_loop(spark, size):
    rng = random.Random(size)
    rows = [
        (rng.choice("ab"), i, rng.randrange(100) if rng.random() < 0.2 else None) for i in range(300)
    ]
    df = spark.createDataFrame(rows, "k string, i bigint, v int")
    marks = {
        "now": Mark("v is not null", "v"),
        "before": Mark("v is not null", "v", strict=True),
    }
    found = {
        r["i"]: (r["now"] and r["now"]["value"], r["before"] and r["before"]["value"])
        for r in carry_forward(df, ["k"], "i", marks, size=size).collect()
    }
    last, want = {}, {}
    for k, i, v in rows:
        before = last.get(k)
        if v is not None:
            last[k] = v
        want[i] = (last.get(k), before)
    assert found == want


@pytest.mark.parametrize("size,often", [(1, 0.2), (4, 0.1), (7, 0.5), (1 << 16, 0.1)])
def test_first_row_since_a_mark_equals_a_loop(spark, size, often):
    rng = random.Random(size)
    rows = []
    for i in range(0, 900, 2):
        kind = rng.choice(["mark", "row", "row"]) if rng.random() < often else "none"
        rows.append((rng.choice("ab"), i, kind, rng.randrange(100)))
    df = spark.createDataFrame(rows, "k string, i bigint, kind string, v int")
    marks = {"mark": Mark("kind = 'mark'", "v"), "first": Mark("kind = 'row'", "v", since="mark")}
    found = {
        r["i"]: (r["mark"] and r["mark"]["at"], r["first"] and (r["first"]["at"], r["first"]["value"]))
        for r in carry_forward(df, ["k"], "i", marks, size=size).collect()
    }
    state, want = {}, {}
    for k, i, kind, v in rows:
        if kind == "mark":
            state[k] = (i, None)
        elif kind == "row" and k in state and state[k][1] is None:
            state[k] = (state[k][0], (i, v))
        want[i] = state.get(k, (None, None))
    assert found == want


def test_lobs_join_the_latest_call(spark):
    rows = [
        ("f", 1, None, "LOBREAD", None),
        ("f", 2, "#100", "PIC", "s1"),
        ("f", 3, None, "LOBWRITE", None),
        ("f", 4, "#101", "EXEC", None),
        ("f", 5, None, "LOBWRITE", None),
        ("f", 6, None, "XCTEND", None),
    ]
    df = spark.createDataFrame(
        rows, "file_name string, line bigint, cursor_id string, ops string, sql_id string"
    )
    r = {x["line"]: x for x in S.assign_spans(df, attach_lobs=True).collect()}
    assert r[3]["span_id"] == r[2]["span_id"] and r[3]["sql_id"] == "s1"
    assert r[5]["span_id"] == r[4]["span_id"] and r[5]["sql_id"] is None
    assert len({r[i]["span_id"] for i in (1, 2, 4, 6)}) == 4
    counts = {x["n_ops"]: x for x in S.span_op_counts(S.assign_spans(df, attach_lobs=True)).collect()}
    assert counts[2]["n_lob"] == 1


def test_validate(spark):
    df = spark.createDataFrame(
        [("PIC", "#0"), ("EXEC", "#1"), ("EXEC", None), ("LOBREAD", "#12"), ("LOBREAD", None), ("NOPE", "#12")],
        "ops string, cursor_id string",
    )
    found = [r["reject"] for r in S.validate(df).collect()]
    assert found == [None, "cursor", "cursor", "cursor", None, "ops"]


def test_ids_argument(spark):
    df = spark.createDataFrame([("f", "", 1)], "file_name string, _cursor string, _mark bigint")
    with pytest.raises(ValueError):
        S.number_spans(df, "other")
    with pytest.raises(ValueError):
        S.number_spans(df, "dense")
