"""Registered queries of the operators: name -> (Spark query, DuckDB SQL or None).

Each applies its operator to the whole of its table and derives what is compared from its output.
"""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.bpe import encode_decode
from spanloom.llm.centroid import cluster
from spanloom.llm.content import extract_text, fit_tags
from spanloom.llm.disguise import KINDS, find_identifiers
from spanloom.llm.embed import near_vectors
from spanloom.llm.imatch import edited_and_next
from spanloom.llm.jaccard import near_groups
from spanloom.llm.lines import dedup_lines
from spanloom.llm.pack import pack
from spanloom.llm.periodic import periodic_runs
from spanloom.llm.rows import map_rows
from spanloom.llm.shard import assign_shards
from spanloom.llm.toxic import fit_toxicity, score_toxicity
from spanloom.llm.urls import fit_urls, host_and_path, judge_urls, rule_of


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP2_SQL = """
with cut as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
line as (select doc_id, unnest(range(1, len(lines) + 1)) as i, unnest(lines) as line from cut),
keyed as (
  select doc_id, i, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from line
),
repeats as (
  select k, max(doc_id) as keeper from keyed where length(k) >= 20 group by k having count(distinct doc_id) >= 3
),
judged as (
  select doc_id, i, line, keeper is not null and doc_id <> keeper as gone from keyed left join repeats using (k)
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from judged group by doc_id
"""


TOKENIZER = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
)


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The small labelled table: URLs that a rule judges, labelled by its verdict."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    _, verdict = rule_of(RULES, *host_and_path(F.col("url")))
    model = fit_urls(pages.select("url", F.when(verdict == "block", 1).when(verdict == "allow", 0).alias("label")))
    return judge_urls(pages, RULES, model)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    model = fit_toxicity(docs, _table(spark, sf_dir, "labels").where(~held_out))
    scored = score_toxicity(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= TOXIC).cast("int").alias("predicted"),
    )


TOXIC = 0.3


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(_table(spark, sf_dir, "documents"))


def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = edited_and_next(_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


def op8_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    put = assign_shards(_table(spark, sf_dir, "documents"))
    return put.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    texts = extract_text(pages, fit_tags(pages))
    return texts.select("page_id", "url", F.col("_main").alias("text"), F.length("_main").cast("long").alias("n_chars"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = cluster(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    digest = F.sha2(F.array_join("centroid", ",").cast("binary"), 256)
    return placed.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def _op11_sql(rounds: int = 10) -> str:
    """Rounds one after the other: all distances of a vector, the least of them, exact sums by component."""
    parts = [
        """x as materialized (select vec_id, list_transform(embedding, lambda e: floor(1024 * e::double)::bigint) as v from embeddings
          where len(embedding) = 64 and len(list_filter(embedding, lambda e: e is not null and isfinite(e::double))) = 64),
        c0 as materialized (select (row_number() over (order by h) - 1)::int as c, v
          from (select sha256('3:' || vec_id) as h, v from x order by h limit 8))"""
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} as materialized (select vec_id, x.v, min(struct_pack(d := list_sum(list_transform(list_zip(x.v, c{r}.v),
              lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint, c := c)) as near from x cross join c{r} group by all)"""
        )
        if r < rounds:
            parts.append(
                f"""m{r} as materialized (select c, list((s - ((s % n) + n) % n) // n order by i)::bigint[] as v from (
                  select near.c as c, i, sum(v[i])::bigint as s, count(*) as n from a{r}, range(1, 65) t(i) group by all) group by c),
                c{r + 1} as materialized (select c, coalesce(m{r}.v, c{r}.v) as v from c{r} left join m{r} using (c))"""
            )
    return (
        f"with {', '.join(parts)} select vec_id, near.c as cluster, near.d as distance, "
        "(sum(near.d) over (partition by near.c))::bigint as cluster_inertia, (sum(near.d) over ())::bigint as inertia, "
        f"sha256(array_to_string(c.v, ',')) as centroid_sha256 from a{rounds} a join c{rounds} c on a.near.c = c.c"
    )


OP11_SQL = _op11_sql()


def _with_echoes(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, by a hash of the id, repeat a passage from some word on to their end."""

    def echo():
        def one(doc_id, text):
            h = -1 if doc_id is None else zlib.crc32(str(doc_id).encode())
            words = (text or "").encode().split() if h % 10 == 0 else None
            if not words:
                return (text,)
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            said = words[a : a + p]
            return (b" ".join(words[:a] + (said * ((n - a) // p + 1))[: n - a]).decode(),)

        return one

    return map_rows(docs, echo, ["doc_id", "text"], "_echoed string").select("doc_id", F.col("_echoed").alias("text"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_with_echoes(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    longest = "array_max(transform(runs, r -> struct(r.length as length, -r.start as back, -r.period as minus)))"
    said = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return found.selectExpr("*", f"{longest} as _top").selectExpr(
        "doc_id",
        "cast(size(runs) as long) as n_runs",
        "-_top.back as start",
        "_top.length as length",
        "-_top.minus as period",
        "1000 * _top.length div -_top.minus as exponent_milli",
        f"sha2(cast({said} as binary), 256) as runs_sha256",
        "sha2(cast(collapsed as binary), 256) as collapsed_sha256",
    )


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts, like the digest, are those of the plain identifiers; ``spans`` holds the hidden ones as well."""
    found = find_identifiers(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    plain = "filter(spans, s -> not s.hidden)"

    def said(spans: str) -> str:
        return f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.stop)), ',')"

    return found.selectExpr(
        "doc_id",
        *[f"cast(size(filter(spans, s -> s.kind = '{kind}' and not s.hidden)) as long) as n_{kind}" for kind in KINDS],
        f"sha2(cast({said(plain)} as binary), 256) as base_sha256",
        f"{said('spans')} as spans",
    )


LLM_QUERIES = {
    "op1_bpe": (op1_bpe, None),
    "op2_lines": (op2_lines, OP2_SQL),
    "op4_pack": (op4_pack, None),
    "op3_urls": (op3_urls, None),
    "op5_embeddings": (op5_embeddings, None),
    "op6_jaccard": (op6_jaccard, None),
    "op7_imatch": (op7_imatch, None),
    "op8_shard": (op8_shard, None),
    "op9_toxicity": (op9_toxicity, None),
    "op10_html": (op10_html, None),
    "op11_centroids": (op11_centroids, OP11_SQL),
    "op12_periodic": (op12_periodic, None),
    "op13_pii": (op13_pii, None),
}
