"""Trace files that are still being written: each round stores what they have grown by.

What a later line means depends on few earlier records: the latest of each session attribute, the latest wall
clock and the first and last timed record since, the latest reset line, and per cursor its latest parse record and
the records that opened its current span. A round keeps just these, as they are, in a state table. The
operators of a whole ingest then run over the kept records and the new ones, and give the new ones what a whole ingest
would give them. A record that may still get lines of text (a statement without its end, binds, the text of a
parse error) waits in the state with all lines after it; so does a last line without its line feed.

The state of a round has a folder of its own and counts once its table of files is complete. A round that was cut
off is done again with the same input or more, and replaces what it left in the target.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spanloom.operators.classify import MULTILINE, assemble, classify
from spanloom.operators.context import CONTEXT
from spanloom.operators.parse import parse_records
from spanloom.operators.spans import ONCE_OPS
from spanloom.plans.ingest import STORED, finish_spans, resolve
from spanloom.schema import OPS_COLUMNS, TRACKED_OPS
from spanloom.sources.stage import remove_stages, stage, stage_folder
from spanloom.sources.store import write_ops
from spanloom.sources.trace import number_lines

_LINES = "file_name string, line bigint, value string"
_FILES = "file_name string, lines bigint, bytes bigint, idle int, seen timestamp"


def follow(
    spark: SparkSession,
    folder: str,
    target: str,
    state: str,
    ids: str = "hash",
    zone: str = "UTC",
    attach_lobs: bool = False,
    name: str = "file_name",
    idle_rounds: int | None = None,
) -> int:
    """One round over ``folder``: append what its files have grown by to the fact table at ``target`` (and to its
    ``_rejects`` and ``_orphans``), and return the number of the round.

    Rounds over all states of a file store the rows of one ingest of its last state; only the text that waits is
    missing until more of the file, or its end, is there. A file ends when it has not grown for ``idle_rounds``
    rounds: its waiting text is stored and its open spans are forgotten; what it grows by later starts anew.
    ``name`` is SQL over the path that names the file, for stores that replace a growing file by a new object.
    Only files changed since the last round are read, each from its beginning; lines that are known are
    dropped. ``dense`` ids number the spans of one ingest and are refused.
    """
    if ids == "dense":
        raise ValueError("dense ids number the spans of one ingest; a followed file has many rounds")
    last = _last_round(spark, state)
    this = last + 1
    key = f"follow-{uuid.uuid5(uuid.NAMESPACE_URL, state.rstrip('/')).hex}-{this}"
    with stage_folder(spark, key):
        known = _state(spark, state, last, "files", _FILES)
        sizes = stage(_sizes(spark, folder, name), "sizes")  # before the text: what comes later is seen next time
        found = stage(_grown(spark, folder, name, known, sizes), "grown")
        files = stage(_files(known, found, sizes), "files")
        closing = files.where(F.lit(False) if idle_rounds is None else F.col("idle") >= idle_rounds).select("file_name")
        lines = found.where("not partial").select("file_name", "line", F.rtrim("value", F.lit("\r")).alias("value"))
        classified = stage(classify(_state(spark, state, last, "pending", _LINES).unionByName(lines)), "lines")
        waits = stage(_waiting(classified).join(closing, "file_name", "left_anti"), "waiting")
        split = classified.join(waits, "file_name", "left")
        ready = split.where("coalesce(line < _open, true)").drop("_open")

        records = stage(parse_records(assemble(ready), zone), "records")
        new = records.where(STORED).drop("kind", "value", "reject")
        kept = _state(spark, state, last, "kept", new.schema)
        touched = new.select("file_name").distinct()
        every = stage(
            new.withColumn("_new", F.lit(True)).unionByName(
                kept.join(touched, "file_name", "left_semi").withColumn("_new", F.lit(False))
            ),
            "records_in_reach",
        )
        cut, segmented = resolve(every, attach_lobs)
        ops = finish_spans(cut, segmented, ids, f"{state}/numbers").where("_new")

        own = f"round={this}"
        write_ops(ops.select(*OPS_COLUMNS), f"{target}/{own}", mode="overwrite", version_row=False)
        rejects = records.where("reject is not null").selectExpr("file_name", "line", "value", "reject as reason")
        rejects.write.mode("overwrite").parquet(f"{target}/_rejects/{own}")
        orphans = records.where("kind = 'ORPHAN'").select("file_name", "line", "value")
        orphans.write.mode("overwrite").parquet(f"{target}/_orphans/{own}")

        wanted = stage(_kept_lines(segmented, cut), "kept_lines")
        later = every.drop("_new").join(wanted, ["file_name", "line"], "left_semi").unionByName(
            kept.join(touched, "file_name", "left_anti")
        )
        base = f"{state}/{own}"
        pending = split.where("line >= _open").select("file_name", "line", "value")
        pending.write.mode("overwrite").parquet(f"{base}/pending")
        later.join(closing, "file_name", "left_anti").write.mode("overwrite").parquet(f"{base}/kept")
        files.write.mode("overwrite").parquet(f"{base}/files")  # the round counts from here on
    remove_stages(spark, key)
    return this


def _path(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _last_round(spark: SparkSession, state: str) -> int:
    path, system = _path(spark, state)
    if not system.exists(path):
        return 0
    names = [s.getPath().getName() for s in system.listStatus(path)]
    rounds = [int(n.removeprefix("round=")) for n in names if n.startswith("round=")]
    return max((r for r in rounds if system.exists(_path(spark, f"{state}/round={r}/files/_SUCCESS")[0])), default=0)


def _state(spark: SparkSession, state: str, last: int, table: str, schema: str | StructType) -> DataFrame:
    if last == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{state}/round={last}/{table}")


def _sizes(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Files with their length and time of change; their contents are not read."""
    listed = spark.read.format("binaryFile").load(folder)
    return listed.select(F.col("_metadata.file_path").alias("file_name"), "length", "modificationTime").selectExpr(
        f"{name} as file_name", "length", "modificationTime as changed"
    )


def _grown(spark: SparkSession, folder: str, name: str, known: DataFrame, sizes: DataFrame) -> DataFrame:
    """``file_name, line, value, bytes, partial``: lines that no round has read. ``partial`` is the last line of a
    file whose bytes do not add up to whole lines."""
    since = known.agg(F.max("seen")).first()[0]
    text = spark.read.option("lineSep", "\n").text(folder)
    if since is not None:
        text = text.where(F.col("_metadata.file_modification_time") >= F.lit(since))  # other files are not opened
    raw = text.select(
        F.col("_metadata.file_path").alias("file_name"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_at"),
        "value",
    )
    lines = stage(number_lines(raw).selectExpr(f"{name} as file_name", "line", "value"), "numbered")
    done = known.select("file_name", F.col("lines").alias("_lines"), F.col("bytes").alias("_bytes"))
    fresh = stage(
        lines.join(done, "file_name", "left")
        .where("line > coalesce(_lines, 0L)")
        .selectExpr("file_name", "line", "value", "octet_length(value) + 1L as bytes", "coalesce(_bytes, 0L) as _bytes"),
        "fresh",
    )
    ends = fresh.groupBy("file_name").agg(F.max("line").alias("_end"), F.expr("max(_bytes) + sum(bytes) as _sum"))
    whole = ends.join(sizes, "file_name", "left").selectExpr("file_name", "_end", "coalesce(_sum <> length, true) as _cut")
    return fresh.join(whole, "file_name").selectExpr("file_name", "line", "value", "bytes", "_cut and line = _end as partial")


def _files(known: DataFrame, found: DataFrame, sizes: DataFrame) -> DataFrame:
    """What has been read of each file, and for how many rounds it has not grown."""
    grown = found.where("not partial").groupBy("file_name").agg(F.max("line").alias("_line"), F.sum("bytes").alias("_more"))
    looked = sizes.groupBy("file_name").agg(F.max("changed").alias("changed"))
    return known.join(grown, "file_name", "full").join(looked, "file_name", "left").selectExpr(
        "file_name",
        "coalesce(_line, lines) as lines",
        "coalesce(bytes, 0L) + coalesce(_more, 0L) as bytes",
        "if(_line is null, idle + 1, 0) as idle",
        "greatest(changed, seen) as seen",
    )


def _waiting(classified: DataFrame) -> DataFrame:
    """``file_name, _open``: files whose last call may still get text, and the line of that call."""
    many = ", ".join(repr(m) for m in MULTILINE)
    return (
        classified.groupBy("file_name")
        .agg(
            F.expr("max(if(kind = 'CALL', struct(line, call), null)) as _last"),
            F.expr("max(if(kind = 'END', line, null)) as _end"),
        )
        .where(f"_last.call in ({many}) and not (_last.call = 'PARSING IN CURSOR' and coalesce(_end > _last.line, false))")
        .selectExpr("file_name", "_last.line as _open")
    )


def _kept_lines(segmented: DataFrame, cut: DataFrame) -> DataFrame:
    """``file_name, line`` of the records that later ones depend on."""
    tracked = f"ops in ({', '.join(repr(op) for op in TRACKED_OPS)})"
    names = ", ".join(repr(n) for n in CONTEXT.values())
    attributes = segmented.where(f"ops = 'STAR' and event_name in ({names})").groupBy("file_name", "event_name").agg(
        F.max("line").alias("line")
    )
    of_file = segmented.groupBy("file_name").agg(
        F.expr(
            f"""array(max(_anchor.at), max_by(_first.at, line), max(_timed.at), max(if(ops = 'RESET', line, null)),
            max(if({tracked}, line, null))) as _lines"""
        )
    )
    cursors = ["file_name", "cursor_id"]
    calls = segmented.where(tracked).join(
        cut.where(tracked).select("file_name", "line", "_mark"), ["file_name", "line"]
    )
    segment = "greatest(coalesce(_reset, 0L), coalesce(_pic, 0L))"
    current = calls.groupBy(*cursors).agg(
        F.max_by("_mark", "line").alias("_now"), F.max("_pic").alias("_parse"), F.expr(f"max_by({segment}, line) as _from")
    )
    current = stage(current, "current_spans")
    inside = calls.join(current, cursors)
    once = ", ".join(repr(op) for op in ONCE_OPS)
    opened = inside.where("_mark = _now").groupBy(*cursors).agg(
        F.min("line").alias("_start"),
        F.min_by("ops", "line").alias("_opener"),
        *[F.expr(f"min(if(ops = '{op}', line, null)) as _once{i}") for i, op in enumerate(ONCE_OPS)],
    )
    # A span that began with a repeated call begins again only after an earlier call of that kind.
    earlier = (
        inside.where(f"_mark < _now and line >= _from and _now > _from and ops in ({once})")
        .join(opened.select(*cursors, "_opener"), cursors)
        .where("ops = _opener")
        .groupBy(*cursors)
        .agg(F.max("line").alias("line"))
    )
    seen = ", ".join(f"_once{i}" for i in range(len(ONCE_OPS)))
    spans = opened.selectExpr("file_name", f"explode(array(_start, {seen})) as line")
    parts = [
        attributes.select("file_name", "line"),
        of_file.selectExpr("file_name", "explode(_lines) as line"),
        current.selectExpr("file_name", "_parse as line"),
        spans,
        earlier.select("file_name", "line"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.where("line is not null").distinct()
