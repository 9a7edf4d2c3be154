"""I-Match fingerprints with randomised lexicons.

Terms whose inverse document frequency lies in a band form the lexicon. A text with few of them also
takes its rarest other terms, until it has two thirds of its distinct terms: near copies then share
terms however common their words are. A fingerprint is made of hashes of the sorted terms taken that lie in
each of several random parts of all terms. A part keeps one term of ``2**level``; the level follows the
number of terms, so that a part holds about one term of the document, and a changed passage changes some
hashes but not all. Two neighbouring levels are kept, so that texts of somewhat different length can
still be compared.

Document frequencies are exact and count distinct texts, so copies of one text don't make its words
common. Each task adds up its terms before they are shuffled. Executors get the terms that are in the
band or more common, and the number of copies of each repeated text.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from spanloom.llm.rows import hashed_sample, map_rows, nullable, slices
from spanloom.sources.stage import stage

PARTS = 24  # random parts of the lexicon at each level
DIGITS = 4  # hexadecimal digits of a hash
BAND = (2.0, 12.0)  # natural logarithm of documents / document frequency
LEAST = 8  # terms that a fingerprint takes at least, and two thirds of the text's terms
PENDING = 1 << 20  # terms that a task holds before it adds them up
SENT = 100_000  # rows of a batch of added-up terms, and terms mixed at a time
TOGETHER = 16_000_000  # bytes of texts that are read together, and one more text

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_PARTS = np.arange(PARTS + 1)
_BEFORE = np.array([-1], np.int32)
_MIX = np.array([(0x9E3779B97F4A7C15 * (2 * k + 1)) & (2**64 - 1) for k in range(PARTS)], np.uint64)


def _together(batches: Iterable[pa.RecordBatch], text: str | int = "_text") -> Iterator[pa.RecordBatch]:
    """Slices whose texts (a column) are read together; long texts make shorter slices."""
    for part in slices(batches):
        ends = np.cumsum(pc.binary_length(part.column(text)).fill_null(0).to_numpy(), dtype=np.int64)
        starts = [0, *(np.flatnonzero(np.diff(ends // TOGETHER)) + 1).tolist(), part.num_rows]
        for start, stop in zip(starts, starts[1:], strict=False):
            yield part.slice(start, stop - start)


def read_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The terms of some texts as ascending 64-bit hashes; the words of all texts as places among them, -1 for
    words without letters or digits; where each text's words begin, and the last one's end.

    A word is hashed once, however many of the texts have it."""
    words = pc.utf8_split_whitespace(texts)
    coded = words.flatten().dictionary_encode()
    lower = map(str.lower, coded.dictionary.to_numpy(zero_copy_only=False))
    codes = [xxhash.xxh3_64_intdigest(w) if w.isalnum() else _inner_code(w) for w in lower]
    terms, places = np.unique(np.array(codes, np.uint64), return_inverse=True)
    none = int(len(terms) > 0 and terms[0] == 0)
    places = (places - none).astype(np.int32)
    return terms[none:], places[coded.indices.to_numpy()], words.offsets.to_numpy()


def _inner_code(word: str) -> int:
    """Hash of a word without signs at its ends, 0 if nothing is left."""
    word = word.strip(punctuation)  # most signs; the pattern is slow
    if not word.isalnum():
        word = _EDGES.sub("", word)
    return xxhash.xxh3_64_intdigest(word) if word else 0


class Lexicon:
    """Terms (ascending) in the band, and those more common than the band, these with their frequencies."""

    def __init__(self, inside: np.ndarray, common: np.ndarray, counts: np.ndarray):
        self.inside, self.common, self.counts = inside, common, counts

    def rarity(self, terms: np.ndarray) -> np.ndarray:
        """Terms are taken in this order: those in the band are -1, rarer ones 0, more common ones have their frequency."""
        found = np.where(_places(self.inside, terms) >= 0, -1, 0)
        at = _places(self.common, terms)
        found[at >= 0] = self.counts[at[at >= 0]]
        return found


def _places(known: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Where terms are in an ascending array, -1 for those that are not."""
    if not len(known):
        return np.full(len(terms), -1)
    at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
    return np.where(known[at] == terms, at, -1)


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[DataFrame, int]:
    """``(term, n)``: in how many distinct texts (null: empty) a term is, and the number of distinct texts.

    Each of ``m`` copies of a text counts ``1 / m``; the sums are rounded to whole numbers."""
    value = F.coalesce(F.col(text), F.lit(""))
    slim = docs.select(value.alias("_text"), F.xxhash64(value).alias("_hash"))
    texts = slim.groupBy("_hash").agg(F.count("*").alias("_copies"))
    texts = stage(texts, "text_copies")
    copies = texts.where("_copies > 1").orderBy("_hash").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(tuple(copies.column(i).to_numpy() for i in (0, 1)))
    schema = nullable("term long, n double")
    arrow = to_arrow_schema(schema)

    def summed(found, weights):
        names, own = np.unique(np.concatenate(found), return_inverse=True)
        sums = np.bincount(own, np.concatenate(weights))
        for at in range(0, len(names), SENT):
            columns = names[at : at + SENT].view(np.int64), sums[at : at + SENT]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def local(batches):
        repeated, times = shared.value
        found, weights, held = [], [], 0
        for part in _together(batches):
            at = _places(repeated, part.column("_hash").to_numpy())
            each = np.ones(len(at))
            each[at >= 0] = 1 / times[at[at >= 0]]
            terms, places, ends = read_terms(part.column("_text"))
            pairs = np.repeat(np.arange(len(at)) << 32, np.diff(ends)) | places  # text and term
            pairs = np.sort(pairs[places >= 0])
            pairs = pairs[np.diff(pairs, prepend=-1) > 0]
            found.append(terms)
            weights.append(np.bincount(pairs & 0xFFFFFFFF, each[pairs >> 32], len(terms)))
            held += len(terms)
            if held > PENDING:
                yield from summed(found, weights)
                found, weights, held = [], [], 0
        if held:
            yield from summed(found, weights)

    counts = slim.mapInArrow(local, schema).groupBy("term").agg(F.round(F.sum("n")).cast("long").alias("n"))
    return counts, texts.count()


def lexicon(counts: DataFrame, texts: int, band: tuple[float, float] = BAND) -> Lexicon:
    """The lexicon of a band. A term of one text alone is never in."""
    least, most = (texts / np.exp(b) for b in band[::-1])
    found = counts.where((F.col("n") > 1) & (F.col("n") >= float(least))).toArrow()
    names, n = found.column("term").to_numpy().view(np.uint64), found.column("n").to_numpy()
    order = np.argsort(names)
    names, n = names[order], n[order]
    return Lexicon(names[n <= most], names[n > most], n[n > most])


class Prints:
    """Fingerprints of texts made of given pieces, of which none ends within a word. What they need of a term is
    worked out once, however many of the pieces have it."""

    def __init__(self, pieces: list[str], known: Lexicon):
        terms, places, self.ends = read_terms(pa.array(pieces, pa.large_string()))
        rarity = known.rarity(terms)
        order = np.argsort(rarity, kind="stable")  # terms are numbered as they are taken: by rarity, then hash
        self.codes, self.inside = terms[order], np.count_nonzero(rarity < 0)
        numbers = np.full(len(terms) + 1, -1, np.int32)  # the last one is that of place -1
        numbers[order] = np.arange(len(terms))
        self.numbers = numbers[places]
        self.zeros = np.empty((len(terms), PARTS), np.uint8)  # a part keeps a term up to this level
        for at in range(0, len(terms), SENT):
            codes = self.codes[at : at + SENT]
            mixed = (codes ^ (codes >> np.uint64(29)))[:, None] * _MIX
            mixed ^= mixed >> np.uint64(32)
            self.zeros[at : at + SENT] = np.bitwise_count(~mixed & (mixed - np.uint64(1)))

    def _taken(self, pieces: tuple[int, ...]) -> np.ndarray:
        """All terms in the band, and the rarest others as long as there are fewer than ``LEAST``, or than
        two thirds of the terms; terms rarer than the band are alike."""
        found = np.concatenate([_BEFORE, *(self.numbers[self.ends[p] : self.ends[p + 1]] for p in pieces)])
        found.sort()
        found = found[1:][found[1:] != found[:-1]]
        return found[: max(int(found.searchsorted(self.inside)), LEAST, (2 * len(found) + 2) // 3)]

    def __call__(self, *pieces: int) -> str:
        """``level:hashes;level:hashes``, a hash of dots for a part without terms; ``-`` without any term."""
        own = self._taken(pieces)
        if not len(own):
            return "-"
        level = len(own).bit_length() - 1
        zeros = self.zeros[own].ravel()
        found = np.flatnonzero(zeros >= level)
        term, part = np.divmod(found, PARTS)
        codes = self.codes[own[term]]
        order = np.lexsort((codes, part))
        zeros, part, codes = zeros[found][order], part[order], codes[order]
        said = []
        for at in (level, level + 1):
            kept = zeros >= at
            taken, ends = codes[kept].tobytes(), (8 * part[kept].searchsorted(_PARTS)).tolist()
            hashes = [
                xxhash.xxh3_64_hexdigest(taken[start:stop])[:DIGITS] if start < stop else "." * DIGITS
                for start, stop in zip(ends, ends[1:], strict=False)
            ]
            said.append(f"{at}:" + "".join(hashes))
        return ";".join(said)


def _cut(text: str) -> tuple[str, str, str]:
    """What an edited text keeps: up to the last word, and that word if the text is cut in it or behind it; the
    last third (floor), which it replaces."""
    at = len(text) - len(text) // 3
    head, tail = text[:at], text[at:]
    if not head or head[-1].isspace():
        return head, "", tail
    *before, word = head.rsplit(None, 1)
    return "".join(before), word, tail


def likeness(one: str, other: str) -> float:
    """Share of equal hashes among the parts that either text has terms in, at the levels of both; 1 for
    equal fingerprints, 0 for texts without a common level."""
    if one == other:
        return 1.0
    if "-" in (one, other):
        return 0.0
    a, b = (dict(level.split(":") for level in f.split(";")) for f in (one, other))
    same = count = 0
    for level in a.keys() & b.keys():
        for i in range(0, PARTS * DIGITS, DIGITS):
            left, right = a[level][i : i + DIGITS], b[level][i : i + DIGITS]
            if left[0] != "." or right[0] != ".":
                count += 1
                same += left == right
    return same / count if count else 0.0


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_fingerprint`` of the whole text (null: empty). Equal texts have equal ones."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon(*document_frequencies(docs, text)))
    schema = nullable(T.StructType([*docs.schema.fields, T.StructField("_fingerprint", T.StringType())]))
    arrow, place = to_arrow_schema(schema), docs.columns.index(text)

    def run(batches):
        for part in _together(batches, place):
            prints = Prints([value or "" for value in part.column(place).to_pylist()], shared.value)
            kept = [c.cast(f.type) for c, f in zip(part.columns, arrow, strict=False)]
            said = pa.array([prints(i) for i in range(part.num_rows)], arrow[-1].type)
            yield pa.RecordBatch.from_arrays([*kept, said], schema=arrow)

    return docs.mapInArrow(run, schema)


def _blocks(keys: DataFrame) -> tuple[list[tuple], dict[int, tuple]]:
    """Ascending bounds that cut the rows into blocks of like size, and for each block with rows the first
    row (key, hash) of the block that follows it, with a wrap-around."""
    spark = keys.sparkSession
    rows = keys.count()
    count = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), rows // 2_000_000)
    sample = hashed_sample(keys.withColumn("_id", F.monotonically_increasing_id()), 50 * count, "_id").select("_key", "_hash").collect()
    found = sorted(_place(*row) for row in sample)
    bounds = sorted({found[i * len(found) // count] for i in range(1, count)}) if found else []
    numbered = map_rows(keys, lambda: lambda key, hash_: (bisect_right(bounds, _place(key, hash_)),), ["_key", "_hash"], "_block int")
    first = F.struct(F.col("_key").isNull().alias("none"), F.bitwise_not("_key").alias("down"), "_hash")
    firsts = numbered.groupBy("_block").agg(F.min(first).alias("f")).orderBy("_block").collect()
    heads = [(None if f["f"]["none"] else ~f["f"]["down"], f["f"]["_hash"]) for f in firsts]
    return bounds, {f["_block"]: head for f, head in zip(firsts, heads[1:] + heads[:1], strict=True)}


def _place(key: int | None, hash_: int) -> tuple[bool, int, int]:
    """Places count up as keys go down, and up with the hashes of one key; rows without a key come last."""
    return (True, 0, hash_) if key is None else (False, ~key, hash_)


def edited_and_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, ``n_chars``, ``edited``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``.

    The edited text has its last third (floor of a third of the code points) replaced by as many first
    ones of the next document, or all of its fewer ones. The next document is the following one in
    descending order of the key, which is an integer (nulls last, equal keys by their text's hash), and
    the first one after the last. Null texts count as empty; a sole document follows itself; other columns are not
    read; an empty table gives no rows.

    The rows are cut into blocks by key and hash of the text, so rows of one key are dealt out too. The row that begins a block is also sent to the block before it, so the
    texts are shuffled once; a block is sorted by Spark and read as a stream.
    """
    slim = docs.select(F.col(key).cast("long").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon(*document_frequencies(slim, "_text")))
    slim = slim.withColumn("_hash", F.xxhash64("_text"))
    bounds, following = _blocks(slim.select("_key", "_hash"))
    before: dict[tuple, list[int]] = {}
    for block, head in following.items():
        before.setdefault(head, []).append(block)

    def places():
        def one(key, hash_):
            own = bisect_right(bounds, _place(key, hash_))
            return ([own, *(-1 - b for b in before.get((key, hash_), ()))],)

        return one

    dealt = (
        map_rows(slim, places, ["_key", "_hash"], "_to array<int>")
        .select("_key", "_text", "_hash", F.explode("_to").alias("_to"))
        .select("_key", "_text", "_hash", (F.col("_to") < 0).alias("_extra"), F.when(F.col("_to") < 0, -1 - F.col("_to")).otherwise(F.col("_to")).alias("_block"))
        .repartition("_block")
        .sortWithinPartitions("_block", "_extra", F.col("_key").desc_nulls_last(), "_hash")
    )
    schema = nullable("_key long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    arrow = to_arrow_schema(schema)

    def stream(batches):
        last = None  # key and text of the row before, still without its next
        for part in _together(batches):
            rows, paired = [] if last is None else [last], []
            for row_key, value, extra in zip(*(part.column(c).to_pylist() for c in ("_key", "_text", "_extra")), strict=True):
                if extra and last is None:
                    continue  # another copy of a block's first row
                if last is not None:
                    paired.append(len(rows) - 1)
                rows.append((row_key, value))
                last = None if extra else rows[-1]
            if not paired:
                continue
            cuts = [_cut(value) for _, value in rows]
            new = [rows[i + 1][1][: len(cuts[i][2])] for i in paired]
            prints = Prints(
                [kept for kept, _, _ in cuts] + [word + tail for _, word, tail in cuts] + [cuts[i][1] + n for i, n in zip(paired, new, strict=True)],
                shared.value,
            )
            own = [prints(i, len(rows) + i) for i in range(len(rows))]
            out = []
            for j, i in enumerate(paired):
                row_key, value = rows[i]
                edited = value[: len(value) - len(value) // 3] + new[j]
                print_ = prints(i, 2 * len(rows) + j)
                out.append((row_key, len(value), edited, own[i], print_, likeness(own[i], print_), likeness(own[i], own[i + 1])))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    rows = dealt.select("_key", "_text", "_extra").mapInArrow(stream, schema)
    return rows.withColumnRenamed("_key", key)
