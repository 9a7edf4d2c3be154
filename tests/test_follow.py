"""Growing files in rounds against one ingest of their last state."""

import random

import pytest
from pyspark.sql import functions as F

from spanloom.plans.ingest import ingest
from spanloom.schema import OPS_COLUMNS
from spanloom.sources.store import read_ops
from spanloom.streaming.follow import follow
from tests import traces


def _random_trace(seed, count):
    """Calls on few cursors, resets, parses with texts, binds, errors, clocks and attributes."""
    pick = random.Random(seed)
    out, tim = ["p1", "p2", "p3"], 1000
    for i in range(count):
        tim += pick.randrange(50)
        cursor = f"#10{pick.randrange(3)}"
        kind = pick.choice(["PARSE", "EXEC", "FETCH", "CLOSE", "WAIT", "PIC", "BINDS", "STAR", "NAME", "RESET", "LOB", "PE", "XCT", "BAD", "EXEC", "FETCH"])
        out += {
            "PIC": [f"PARSING IN CURSOR {cursor} len=2 dep=0 uid=1 oct=3 lid=1 tim={tim} hv=1 ad='a' sqlid='s{i}'", "select 1", " from x", "END OF STMT"],
            "BINDS": [f"BINDS {cursor}:", " Bind#0", f"  value={i}"],
            "STAR": [f"*** 2024-03-01T10:{i % 60:02d}:00.000000+00:00"],
            "NAME": [f"*** {pick.choice(['CLIENT ID', 'MODULE NAME', 'SESSION ID'])}:(v{i}) 2024-03-01T11:{i % 60:02d}:00.000000+00:00"],
            "RESET": ["====================="],
            "LOB": [f"LOBREAD: type=TEMPORARY LOB,bytes=5,c=1,e=4,p=0,cr=0,cu=7,tim={tim}"],
            "PE": [f"PARSE ERROR {cursor}:len=7 dep=0 uid=9 oct=3 lid=9 tim={tim} err=942", "selec bad"],
            "XCT": [f"XCTEND rlbk=0, rd_only=1, tim={tim}"],
            "BAD": [f"EXEC {cursor}:c=1,e=2,ti", "no rule knows this"],
            "WAIT": [f"WAIT {cursor}: nam='w' ela= 5 p1=1 tim={tim}"],
        }.get(kind, [f"{kind} {cursor}:c=1,e=2,r=1,tim={tim}"])
    return "\n".join(out) + "\nCLOSE #100:c=1,e=1,tim=99999\n"


def _rows(df, columns):
    name = F.regexp_extract("file_name", "([^/]+)$", 1)
    return sorted(map(repr, df.select(*[name.alias(c) if c == "file_name" else F.col(c) for c in columns]).collect()))


@pytest.mark.parametrize("seed,ids,lobs", [(1, "hash", False), (2, "unique", True)])
def test_rounds_equal_one_ingest(spark, tmp_path, seed, ids, lobs):
    texts = {f"f{i}.trc": _random_trace(10 * seed + i, 120) for i in range(3)}
    texts["again.trc"] = traces.AGAIN
    texts["odd.trc"] = traces.ODD.replace("\n", "\r\n")
    folder, out, state = (tmp_path / p for p in ("in", "out", "state"))
    folder.mkdir()
    pick = random.Random(seed)
    done = dict.fromkeys(texts, 0)
    for turn in range(3):
        for file, text in texts.items():
            done[file] = len(text) if turn == 2 else pick.randrange(done[file], len(text))
            (folder / file).write_text(text[: done[file]], newline="")
        assert follow(spark, str(folder), str(out), str(state), ids=ids, attach_lobs=lobs) == turn + 1
    follow(spark, str(folder), str(out), str(state), ids=ids, attach_lobs=lobs, idle_rounds=1)
    whole = ingest(spark, [str(folder)], ids=ids, attach_lobs=lobs)
    columns = [c for c in OPS_COLUMNS if c != "span_id"] if ids == "unique" else OPS_COLUMNS
    rounds = read_ops(spark, str(out))
    assert _rows(rounds, columns) == _rows(whole.ops, columns)
    per_span = [
        sorted(map(repr, ops.groupBy("span_id").agg(F.count("*").alias("n"), F.sum("line").alias("lines"), F.min(F.regexp_extract("file_name", "([^/]+)$", 1)).alias("f")).drop("span_id").collect()))
        for ops in (rounds, whole.ops)
    ]
    assert per_span[0] == per_span[1]
    for table, want, named in (("_rejects", whole.rejects, ["file_name", "line", "value", "reason"]), ("_orphans", whole.orphans, ["file_name", "line", "value"])):
        assert _rows(spark.read.parquet(f"{out}/{table}"), named) == _rows(want, named)


def test_text_that_waits_and_rounds_cut_off(spark, tmp_path):
    folder, out, state = (tmp_path / p for p in ("in", "out", "state"))
    folder.mkdir()
    file = folder / "a.trc"
    head = "1\n2\n3\nEXEC #10:c=1,e=1,tim=5\nBINDS #10:\n Bind#0\n"
    file.write_text(head + "  va")

    def turn(**more):
        follow(spark, str(folder), str(out), str(state), **more)
        return [(r["ops"], r["event_raw"]) for r in read_ops(spark, str(out)).orderBy("line").collect()]

    assert turn() == [("EXEC", "")]
    file.write_text(head + "  value=1\n")
    assert turn() == [("EXEC", "")]
    for path in (state / "round=2/files").iterdir():  # a round that did not come to its end
        if path.name == "_SUCCESS":
            path.unlink()
    assert turn(idle_rounds=9) == [("EXEC", "")]
    assert turn(idle_rounds=1) == [("EXEC", ""), ("BINDS", " Bind#0\n  value=1\n")]
    assert turn(idle_rounds=1) == [("EXEC", ""), ("BINDS", " Bind#0\n  value=1\n")]
    with pytest.raises(ValueError):
        follow(spark, "f", "t", "s", ids="dense")
