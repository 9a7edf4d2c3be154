"""Toxicity by a counterfactual-regularised classifier on words and word beginnings.

Logistic regression on the presence of words and of the first letters of words. In the labelled texts
identity terms are swapped for one another, and score changes are penalised: the mention of a group
then says the same whichever group it is, and no more than its context. The model is fitted on at most
``most`` labelled rows (the first by hash) with the ``KEPT`` features that tell the classes apart best,
and has a fixed size. Texts are scored whole where they are.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.logistic import fit
from spanloom.llm.rows import flat_map, hashed_sample, map_rows, others
from spanloom.sources.stage import stage

KEPT = 4096
PREFIXES = (4, 5)
WORDS = 400_000  # words kept in a worker

#: Groups whose terms are swapped for one another, in the languages of the documents.
IDENTITY = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "bisexual", "transgender", "queer", "straight"),
    ("black", "white", "asian", "latino", "african", "european", "american"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("disabled", "deaf", "blind", "autistic"),
    ("frauen", "männer"), ("christen", "muslime", "juden"), ("schwarze", "weiße"),
    ("femmes", "hommes"), ("chrétiens", "musulmans", "juifs"), ("noirs", "blancs"),
    ("mujeres", "hombres"), ("cristianos", "musulmanes", "judíos"), ("negros", "blancos"),
)
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def word_features(raw: str) -> tuple[int, ...]:
    """Hashes of a word without its punctuation, and of its beginnings."""
    word = _EDGES.sub("", raw)
    if not word:
        return ()
    names = ["w" + word, *("p" + word[:n] for n in PREFIXES if len(word) >= n)]
    return tuple(xxhash.xxh3_64_intdigest(n) >> 1 for n in names)


def text_features(text: str | None) -> set[int]:
    return {f for w in set((text or "").lower().split()) for f in word_features(w)}


def _swaps(text: str, groups=IDENTITY) -> list[tuple[set[int], set[int]]]:
    """For each identity term of a text and each other term of its group: features lost and won."""
    words = {_EDGES.sub("", w) for w in set(text.lower().split())}
    found = []
    for group in groups:
        for term in group:
            if term in words:
                for other in group:
                    if other not in words:
                        before, after = set(word_features(term)), set(word_features(other))
                        found.append((before - after, after - before))
    return found


class Model:
    """Weights by feature hash, and a bias."""

    def __init__(self, weights: dict[int, float], bias: float):
        self.weights, self.bias = weights, bias
        self.words: dict[str, tuple[int, ...]] = {}

    def score(self, text: str | None) -> float:
        found: set[int] = set()
        for raw in set((text or "").lower().split()):
            own = self.words.get(raw)
            if own is None:
                if len(self.words) > WORDS:
                    self.words.clear()
                own = tuple(f for f in word_features(raw) if f in self.weights)
                if len(raw) < 100:
                    self.words[raw] = own
            if own:
                found.update(own)
        total = self.bias + math.fsum(self.weights[f] for f in found)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))

    def __reduce__(self):
        return Model, (self.weights, self.bias)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    most: int = 12_000,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    even: float = 10.0,
) -> Model:
    """A model from the labelled texts (label 1: toxic). Rows with a null key or label are left out; a
    key labelled more than once counts once for each label, and of the texts of a repeated key the one of
    the smallest hash counts. Without rows of both labels every text gets
    the share of label 1."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).select(
        F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")
    )
    chosen = hashed_sample(known.distinct(), most, "_key", "_label")
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_key")
    least = F.min_by("_text", F.xxhash64("_text")).alias("_text")
    texts = texts.withColumn("_text", F.coalesce("_text", F.lit(""))).groupBy("_key", "_label").agg(least)

    def extract():
        def some(part: pa.RecordBatch):
            rows = [(label, text_features(value)) for value, label in zip(*(part.column(c).to_pylist() for c in ("_text", "_label")), strict=True)]
            swaps = [[f for pair in _swaps(value or "") for s in (pair[0], [0], pair[1], [0]) for f in s] for value in part.column("_text").to_pylist()]
            return [r[0] for r in rows], [list(r[1]) for r in rows], swaps

        return some

    rows = stage(flat_map(texts, extract, "label int, found array<long>, swaps array<long>"), "toxicity_sample")
    size, toxic = rows.agg(F.count("*"), F.sum("label")).first()
    if not toxic or size == toxic:
        share = ((toxic or 0) + 0.5) / (size + 1)
        return Model({}, math.log(share / (1 - share)))
    counts = rows.select("label", F.explode("found").alias("f")).groupBy("f").agg(F.count("*").alias("n"), F.sum("label").alias("t"))
    apart = F.abs(F.col("t") - F.col("n") * toxic / size) / F.sqrt(F.col("n") * toxic / size + 1)
    best = counts.where(F.col("n") >= 3).orderBy(apart.desc(), "f").limit(KEPT).collect()
    templates = [(set(word_features(a)) - set(word_features(b)), set(word_features(b)) - set(word_features(a))) for g in IDENTITY for a, b in zip(g, g[1:], strict=False)]
    names = {r["f"] for r in best} | {f for pair in templates for side in pair for f in side}
    place = {f: i for i, f in enumerate(sorted(names))}
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def select():
        where = shared.value
        return lambda found: ([where[f] for f in found if f in where],)

    sample = map_rows(rows.select("label", "found", "swaps"), select, ["found"], "own array<int>").select("label", "own", "swaps").collect()
    pairs = list(templates)
    for row in sample:
        sides, side = [], []
        for f in row["swaps"]:
            if f:
                side.append(f)
            else:
                sides.append(side)
                side = []
        pairs += zip(sides[::2], sides[1::2], strict=True)
    placed = [tuple(np.array(sorted(place[f] for f in side if f in place), np.int64) for side in pair) for pair in pairs]
    weights, bias = fit(
        [np.array(r["own"], np.int64) for r in sample],
        np.array([r["label"] for r in sample]),
        len(place),
        ridge=1.0,
        equal=[p for p in placed if len(p[0]) or len(p[1])],
        equal_weight=even,
    )
    return Model({f: float(weights[i]) for f, i in place.items() if weights[i]}, bias)


def score_toxicity(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, text, ``toxicity`` (0 to 1) and ``row``, a struct of all other columns.

    The whole text alone decides. Null and empty texts get the score of a text without words. Repeated
    rows score alike; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score():
        own = shared.value
        return lambda value: (own.score(value),)

    slim = docs.select(key, text, others(docs, key, text).alias("row"))
    return map_rows(slim, score, [text], "toxicity double").select(key, text, "toxicity", "row")
