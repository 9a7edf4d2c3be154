"""BPE, line dedup, packing, fingerprints and shards against plain versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from spanloom.llm import imatch
from spanloom.llm.bpe import ChunkCoder, cuts, encode_decode
from spanloom.llm.imatch import _blocks, document_frequencies, edited_and_next, fingerprints, likeness
from spanloom.llm.lines import dedup_lines
from spanloom.llm.pack import hilbert, pack, sequence_of
from spanloom.llm.queries import TOKENIZER
from spanloom.llm.shard import assign_shards, longest_first
from tests.llm.tables import awkward_texts, crowded, documents, words

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _sorted(rows):
    return sorted(rows, key=repr)


def test_bpe_is_the_tokenizer(spark):
    plain = Tokenizer.from_file(WORD_BPE)
    want = []
    for doc, text in awkward_texts():
        ids = plain.encode(text or "", add_special_tokens=False).ids
        want.append((doc, np.array(ids, "<u4").tobytes(), plain.decode(ids, skip_special_tokens=False)))
    got = [(r[0], bytes(r[1]), r[2]) for r in encode_decode(crowded(documents(spark)), WORD_BPE).collect()]
    assert _sorted(got) == _sorted(want)


def test_bpe_stores_may_be_tiny():
    coder, plain = ChunkCoder(WORD_BPE, words=3, chunks=3), Tokenizer.from_file(WORD_BPE)
    for _, text in awkward_texts():
        ids = plain.encode(text or "", add_special_tokens=False).ids
        assert coder.encode(text) == np.array(ids, "<u4").tobytes()


def test_bpe_around_every_character():
    coder, plain = ChunkCoder(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    for code in [*range(0x0, 0x600), *range(0x1680, 0x1820), *range(0x2000, 0x2100), 0x3000, 0xFEFF]:
        text = f"b{chr(code)}a c{chr(code)} {chr(code)}d {chr(code)}{chr(code)}."
        assert coder.encode(text) == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), hex(code)


def test_shared_passages_are_cut_alike():
    passage = words(8, 300)
    one, other = words(1, 50) + passage, words(2, 80) + passage
    pieces = [{t[i:j] for i, j in zip([0, *cuts(t)], cuts(t), strict=False)} for t in (one, other)]
    assert cuts(one)[-1] == len(one) and pieces[0] & pieces[1]


def _plain_lines(rows, least=3, shortest=20):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= shortest and doc is not None:
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < least or max(holders[key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_lines(spark):
    rows = awkward_texts() + [(100 + i, "  A Line Of Twenty Chars\r\nshort\n" + "é" * 19 + "\n" + "É" * 20) for i in range(4)]
    got = [tuple(r)[:4] for r in dedup_lines(crowded(documents(spark, rows))).collect()]
    assert _sorted(got) == _sorted(_plain_lines(rows))


def test_rows_of_one_key_are_no_group(spark, monkeypatch):
    from pyspark.sql import functions as F

    import spanloom.llm.lines as lines

    seen, real = [], lines.map_rows
    monkeypatch.setattr(lines, "map_rows", lambda df, *a: seen.append(df) or real(df, *a))
    rows = [(key, f"this line of {i % 60} is repeated") for i in range(180) for key in (None, i)]
    got = [tuple(r)[:4] for r in dedup_lines(documents(spark, rows)).collect()]
    assert _sorted(got) == _sorted(_plain_lines(rows))
    assert seen[0].agg(F.max(F.size("_drop"))).first()[0] == 1


def test_lines_keep_the_other_columns(spark):
    row = dedup_lines(crowded(documents(spark, [(1, "a")]))).first()
    assert row["kept"] == "a" and row["row"]["kept"] == "x9"


def _check_packing(rows, pieces, size=2048):
    plain = Tokenizer.from_file(TOKENIZER[0])
    want, got = Counter(), Counter()
    for doc, text in rows:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        want[doc, len(ids)] += len(ids)
        assert len(ids)
    sequences = defaultdict(list)
    for p in pieces:
        got[p["doc_id"], p["doc_tokens"]] += p["length"]
        sequences[p["sequence_id"]].append(p)
    assert got == want
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= size and at & (at - 1) == 0


def test_packing(spark):
    rows = awkward_texts()
    pieces = pack(crowded(documents(spark)), TOKENIZER).collect()
    _check_packing(rows, pieces)
    plain = Tokenizer.from_file(TOKENIZER[0])
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
    for doc, text in rows:
        if doc not in (None, 5):
            ids = b"".join(bytes(p["ids"]) for p in sorted(by_doc[doc], key=lambda p: p["start"]))
            assert ids == np.array([*plain.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()


def test_hilbert_visits_each_cell_once_in_single_steps():
    cells = np.array([[x, y, z] for x in range(8) for y in range(8) for z in range(8)])
    places = hilbert(cells, 3)
    assert sorted(places.tolist()) == list(range(512))
    assert set(np.abs(np.diff(cells[np.argsort(places)], axis=0)).sum(axis=1).tolist()) == {1}


@pytest.mark.parametrize("total", [1, 7, 16, 23, 40])
def test_every_place_has_one_sequence(total):
    found = [sequence_of(i, total, 16) for i in range(total)]
    assert len({f[:2] for f in found}) == total
    for i, (sequence, offset, room) in enumerate(found[:-1]):
        assert found[i + 1][:2] == ((sequence, offset + 1) if room > 1 else (sequence + 1, 0))


def test_edited_texts_and_fingerprints(spark):
    rows = [r for r in awkward_texts() if r[0] not in (None, 5)] + [(None, "tail")]
    got = {r["doc_id"]: r for r in edited_and_next(crowded(documents(spark, rows))).collect()}
    ordered = sorted(rows[:-1], key=lambda r: -r[0]) + rows[-1:]
    assert len(got) == len(rows)
    prints = defaultdict(set)
    for i, (doc, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + (after[1] or "")[:cut]
        row = got[doc]
        assert (row["n_chars"], row["edited"]) == (len(text), edited)
        assert row["near_next"] == likeness(row["fingerprint"], got[after[0]]["fingerprint"])
        assert 0 <= row["near_edited"] <= 1
        prints[text].add(row["fingerprint"])
        prints[edited].add(row["edited_fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    assert np.mean([r["near_edited"] for r in got.values()]) > np.mean([r["near_next"] for r in got.values()]) + 0.2


def _plain_terms(text):
    stripped = (re.sub(r"^[\W_]+|[\W_]+$", "", word) for word in text.lower().split())
    return {xxhash.xxh3_64_intdigest(word) for word in stripped if word}


def _plain_print(text, counts, texts):
    least, most = (texts / np.exp(b) for b in imatch.BAND[::-1])

    def rarity(term):
        n = counts[term]
        return 0 if n < 2 or n < least else -1 if n <= most else n

    terms = sorted(_plain_terms(text), key=lambda t: (rarity(t), t))
    own = sorted(terms[: max(sum(rarity(t) < 0 for t in terms), imatch.LEAST, (2 * len(terms) + 2) // 3)])
    said = []
    for level in (len(own).bit_length() - 1, len(own).bit_length()):
        hashes = ""
        for k in range(imatch.PARTS):
            kept = b""
            for t in own:
                mixed = (t ^ t >> 29) * (0x9E3779B97F4A7C15 * (2 * k + 1)) % 2**64
                kept += t.to_bytes(8, "little") if (mixed ^ mixed >> 32) % 2**level == 0 else b""
            hashes += xxhash.xxh3_64_hexdigest(kept)[: imatch.DIGITS] if kept else "." * imatch.DIGITS
        said.append(f"{level}:{hashes}")
    return ";".join(said) if own else "-"


def test_fingerprints_are_the_plain_ones(spark):
    rows = [r for r in awkward_texts() if r[0] not in (None, 5)]
    rows += [(100 + i, words(300 + i, 40) + t) for i, t in enumerate(["", " ", " ΑΣ", "\x1cΟΔΟΣ\u2003Σ ", " İx, -- \"ẞ\" _a_ 'b'"])]
    rows += [(200 + i, "x" * i + " (w1) y" + " " * i) for i in range(6)]
    texts = {t or "" for _, t in rows}
    counts = Counter(term for t in texts for term in _plain_terms(t))
    got = edited_and_next(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    own = {r["doc_id"]: r["fingerprint"] for r in got}
    assert own == {d: _plain_print(t or "", counts, len(texts)) for d, t in rows}
    assert all(r["edited_fingerprint"] == _plain_print(r["edited"], counts, len(texts)) for r in got)
    assert own == {r["doc_id"]: r["_fingerprint"] for r in fingerprints(documents(spark, rows)).collect()}


def test_words_are_hashed_once_for_all_texts_read_together(spark, monkeypatch):
    rows = [(i, words(i, 60)) for i in range(200, 0, -1)]
    docs, given = documents(spark, rows), []
    real = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, *a, **b: given.append(f) or real(self, f, *a, **b))
    edited_and_next(docs)
    hashed = []
    counted = SimpleNamespace(xxh3_64_intdigest=lambda w: hashed.append(w) or xxhash.xxh3_64_intdigest(w), xxh3_64_hexdigest=xxhash.xxh3_64_hexdigest)
    monkeypatch.setattr(imatch, "xxhash", counted)
    columns = [pa.array(c) for c in zip(*((d, t, i == 199) for i, (d, t) in enumerate(rows)), strict=True)]
    batches = list(given[-1](iter([pa.RecordBatch.from_arrays(columns, ["_key", "_text", "_extra"])])))
    edited = [t for b in batches for t in b.column("edited").to_pylist()]
    assert len(edited) == 199 and sorted(hashed) == sorted({w for t in [t for _, t in rows] + edited for w in t.split()})


def test_long_texts_are_read_in_shorter_slices(monkeypatch):
    monkeypatch.setattr(imatch, "TOGETHER", 1000)
    texts = ["a" * (i * 7919 % 901) for i in range(1500)] + ["", "b" * 5000, "", "c"]
    parts = [p.column("_text").to_pylist() for p in imatch._together([pa.RecordBatch.from_pydict({"_text": texts})])]
    assert [t for p in parts for t in p] == texts and all(parts)
    assert all(sum(map(len, p)) <= 1000 + len(p[0]) for p in parts)


@pytest.mark.parametrize("near", [False, True])
def test_copies_of_a_third_of_the_rows_stay_alike(spark, near):
    base = words(77, 120, 10**6).split()
    rows = [(i, words(900 + i, 100, 3000)) for i in range(120)]
    for i in range(120, 180):  # copies, or every one with a word of its own; some rows with words of other texts
        own = list(base)
        if near:
            own[i % 100] = f"own{i}"
        if i % 10 == 0:
            own[i % 7 : i % 7 + 4] = rows[i - 120][1].split()[:4]
        rows.append((i, " ".join(own)))
    got = {r["doc_id"]: r for r in edited_and_next(documents(spark, rows)).collect()}
    assert all(got[i]["near_edited"] > (0.2 if i > 120 else 0) for i in range(120, 180))
    assert all(got[i]["near_next"] > 0.5 for i in range(121, 180))
    assert max(got[i]["near_next"] for i in range(121)) < 0.5


def test_rows_of_one_key_are_several_blocks(spark):
    from pyspark.sql import functions as F

    rows = [(None, f"t{i}") for i in range(300)] + [(5, f"u{i}") for i in range(300)] + [(i, f"v{i}") for i in range(6, 9)] + [(-(2**63), "low")]
    docs = documents(spark, rows)
    keys = docs.select(F.col("doc_id").alias("_key"), F.xxhash64("text").alias("_hash"))
    _, following = _blocks(keys)
    heads = [key for key, _ in following.values()]
    assert heads.count(None) > 2 and heads.count(5) > 2
    hashed = {r["text"]: r["h"] for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashed[r[1]]))
    want = [(d, t[: len(t) - len(t) // 3] + n[: len(t) // 3]) for (d, t), (_, n) in zip(ordered, ordered[1:] + ordered[:1], strict=True)]
    assert _sorted((r["doc_id"], r["edited"]) for r in edited_and_next(docs).collect()) == _sorted(want)


def test_document_frequencies_are_exact(spark):
    rows = [(i, words(i % 50, 2000, 10**7)) for i in range(100)]
    counts, texts = document_frequencies(documents(spark, rows))
    want = Counter(w for text in {t for _, t in rows} for w in set(text.split()))
    assert texts == 50 and Counter(r["n"] for r in counts.collect()) == Counter(want.values())


def test_one_document_follows_itself(spark):
    row = edited_and_next(documents(spark, [(7, "abcdef")])).first()
    assert row["edited"] == "abcdab" and row["near_next"] == 1.0


def test_repeated_ids_stay_rows(spark):
    assert edited_and_next(documents(spark)).count() == len(awkward_texts())


def test_shards(spark):
    rows = awkward_texts()
    got = assign_shards(crowded(documents(spark)), 8).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots, of_text = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        of_text[r["text_crc32"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of_text.values())


def test_shards_are_level(spark):
    got = assign_shards(documents(spark, [(i, "x" * (i * 7919 % 901)) for i in range(4000)]), 8)
    sizes = [r[1] for r in got.groupBy("shard").sum("size").collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) < 0.005 * sum(sizes) / 8


def test_longest_first_by_hand():
    placed = longest_first([("a", 7), ("b", 5), ("c", 4), ("d", 3), ("e", 3)], 2)
    assert placed == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}


@pytest.mark.parametrize(
    "apply",
    [
        lambda d: encode_decode(d, WORD_BPE),
        dedup_lines,
        lambda d: pack(d, TOKENIZER),
        edited_and_next,
        assign_shards,
    ],
)
def test_empty_tables(spark, apply):
    assert apply(crowded(documents(spark, []))).collect() == []


def test_hash_of_kept_is_of_the_text(spark):
    row = dedup_lines(documents(spark, [(1, None)])).first()
    assert hashlib.sha256(row["kept"].encode()).hexdigest() == hashlib.sha256(b"").hexdigest()
