"""URL filter: rules of hosts and paths first, then logistic regression on hashed character n-grams.

The model is fitted in the driver on a small labelled table of at most ``most`` rows (the first ones by
hash). Its weights have a fixed size and go to the executors; URLs are judged where they are.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.logistic import fit
from spanloom.llm.rows import hashed_sample, map_rows

SIZE = 1 << 16
GRAMS = (3, 4, 5)
Rule = tuple[str, str, str]  # verdict, host, path

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits (host and path as one string) and its verdict, null if none fits."""
    name = verdict = F.when(F.lit(False), F.lit(""))
    for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = name.when(fits, h + p), verdict.when(fits, v)
    return name, verdict


def features(host: str, path: str) -> np.ndarray:
    """Distinct hashed n-grams of the characters of host and path, each with its ends marked."""
    found = set()
    for part, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in GRAMS:
            found.update(part + text[i : i + n] for i in range(max(1, len(text) - n + 1)))
    return np.array(sorted({zlib.crc32(g.encode()) % SIZE for g in found}), np.int64)


def fit_urls(labelled: DataFrame, url: str = "url", label: str = "label", most: int = 20_000) -> tuple[np.ndarray, float]:
    """Weights and bias from rows (url, label 1: block, 0: allow). Null labels are left out; at most
    ``most`` distinct rows are used. Without rows of both labels no URL gets a reason to be blocked."""
    host, path = host_and_path(F.col(url))
    known = labelled.where(F.col(label).isNotNull()).select(
        host.alias("host"), path.alias("path"), F.col(label).cast("int").alias("label")
    )
    rows = hashed_sample(known.distinct(), most, "host", "path", "label").collect()
    return fit([features(r["host"], r["path"]) for r in rows], np.array([r["label"] for r in rows]), SIZE, ridge=0.5)


def judge_urls(
    pages: DataFrame, rules: list[Rule], model: tuple[np.ndarray, float], key: str = "page_id", url: str = "url"
) -> DataFrame:
    """One row per page: key, ``host``, ``path``, ``rule``, ``verdict`` (allow or block), ``score``
    (the model's probability of block, also where a rule decides).

    Null URLs and those without ``://`` have an empty host and path and are judged by the model. Repeated
    rows are judged alike; other columns are not read; an empty table gives no rows.
    """
    host, path = host_and_path(F.col(url))
    split = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    shared = split.sparkSession.sparkContext.broadcast(model)

    def score():
        weights, bias = shared.value
        return lambda h, p: (float(1 / (1 + np.exp(-(weights[features(h, p)].sum() + bias)))),)

    scored = map_rows(split, score, ["host", "path"], "score double")
    rule, verdict = rule_of(rules, F.col("host"), F.col("path"))
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(key, "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "score")
