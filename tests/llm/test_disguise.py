"""Plain identifiers against the patterns as they are given, disguised ones against the places they were planted at."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spanloom.llm.disguise import KINDS, Change, Written, bare, digits, find_identifiers, fold, hidden_spans, mail_signs, plain_spans
from spanloom.llm.queries import op13_pii
from tests.llm.tables import awkward_texts, crowded, documents

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _holds(kind, value):
    figures = [int(c) for c in value if c.isdigit()]
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(figures))]
        return 13 <= len(figures) <= 19 and sum(doubled) % 10 == 0
    return kind != "phone" or 9 <= len(figures) <= 15


def _by_pattern(text):
    found = [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if _holds(k, m.group())]
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1]))


@settings(max_examples=600, deadline=None)
@given(st.text(st.sampled_from("a9@.-+ (%_1234é٣\n"), max_size=40))
def test_plain_spans_are_those_of_the_patterns(text):
    assert list(plain_spans(text)) == _by_pattern(text)


def test_plain_spans_in_prose():
    pick = random.Random(4)
    parts = ["die.55@mail4.example.com", "10.0.0.255", "10.0.0.256", "4111 1111 1111 1111", "4111-1111 1111-1112", "+49 (151) 123-4567", "+1 23", "und", "a@b", "x@y.z@q.r", "1.2.3.4.5.6.7.8", "000000001.2.3.4", "7" * 30]
    for _ in range(300):
        text = "".join(pick.choice(parts) + pick.choice(["", " ", ". ", "\n", "-"]) for _ in range(8))
        assert list(plain_spans(text)) == _by_pattern(text)


DISGUISES = [
    ("email", "die.55 at mail4.example.com", "die.55@mail4.example.com"),
    ("email", "bob (at) example (dot) com", "bob@example.com"),
    ("email", "bob [at] example[.]com", "bob@example.com"),
    ("email", "john dot smith at example dot co dot uk", "john.smith@example.co.uk"),
    ("email", "ｂｏｂ＠ｅｘａｍｐｌｅ．ｃｏｍ", "bob@example.com"),
    ("email", "bоb@exаmple.com", "bob@example.com"),
    ("email", "b​ob@exam­ple.com﻿"[:-1], "bob@example.com"),
    ("email", "bob_at_example_dot_com", "bob@example.com"),
    ("email", "bob{AT}example{DOT}com", "bob@example.com"),
    ("email", "bob@example dot com", "bob@example.com"),
    ("email", "juan arroba ejemplo punto es", "juan@ejemplo.es"),
    ("phone", "plus four nine one five one two three four five six seven", "+49151234567"),
    ("phone", "＋４９ 151 1234567", "+49 151 1234567"),
    ("phone", "+4٩ 151 1234567", "+49 151 1234567"),
    ("ip", "192 dot 168 dot one dot oh", "192.168.1.0"),
    ("ip", "192[.]168[.]1[.]1", "192.168.1.1"),
    ("ip", "one nine two dot one six eight dot one dot one", "192.168.1.1"),
    ("card", "four one one one one one one one one one one one one one one one", "4111111111111111"),
    ("card", "4111‑1111‑1111‑1111", "4111-1111-1111-1111"),
    ("card", "411l llll 1111 1111", "4111 1111 1111 1111"),
    ("card", "vier eins eins eins 1111 1111 1111", "4111 1111 1111 1111"),
    ("card", "vier eins eins eins 1111 1111 1112", None),
]


@pytest.mark.parametrize("kind,hidden,value", DISGUISES)
def test_disguises_are_found_where_they_stand(kind, hidden, value):
    for before, after in (("", ""), ("Ü schreib: ", ", bitte."), ("die.1@x.example.org und ​", "\nthen 10.0.0.1 ")):
        text = before + hidden + after
        plain = list(plain_spans(text))
        found = list(hidden_spans(text, plain))
        want = [] if value is None else [(kind, len(before), len(before) + len(hidden), value)]
        assert [f for f in found if f[0] == kind] == want


@pytest.mark.parametrize(
    "text",
    [
        "meet me at example.com at noon", "look at dot com firms", "one plus one is two and two plus two is four",
        "He came at nine. One two three four five.", "the radio радио@ and привет", "We sat at home . then left",
        "una o dos o tres o cuatro veces", "see (at) the end", "at at at and dot dot", "I, I, I, I, I said", "oi oi oi 1 oi", "SİX sıx ſix six Oi 1 2 3", "a@b.c.d@e.f", "",
    ],
)
def test_prose_is_left_alone(text):
    assert list(hidden_spans(text, list(plain_spans(text)))) == []


_PIECES = ["one", "Oi", "oh", "plus", "dot", "at", "double", "İ", "ſ", "I", "l0", "4111", "+49", "@", ".", "(", ")", "[", "]", " ", " ", "-", "_", "a.b", "\u200b", "é", "\n"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(_PIECES), max_size=24))
def test_any_text_has_spans_in_order(pieces):
    text = "".join(pieces)
    plain = list(plain_spans(text))
    assert plain == _by_pattern(text)
    for kind, start, stop, value in hidden_spans(text, plain):
        assert 0 <= start < stop <= len(text) and _holds(kind, value)
        assert not any(k == kind and s < stop and start < e for k, s, e in plain)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30), st.lists(st.tuples(st.integers(0, 30), st.integers(0, 4), st.text(max_size=4)), max_size=6))
def test_ways_back(source, wanted):
    changes, done = [], 0
    for start, length, text in sorted(wanted):
        if done <= start and start + length <= len(source) and (length or text):
            changes.append(Change(start, start + length, text))
            done = start + length
    places, out, done = [], [], 0  # the stretch that each character came from
    for c in changes:
        out += source[done : c.start]
        places += [(i, i + 1) for i in range(done, c.start)]
        out += c.text
        places += [(c.start, c.stop)] * len(c.text)
        done = c.stop
    out += source[done:]
    places += [(i, i + 1) for i in range(done, len(source))]
    written = Written(source, changes)
    assert written.text == "".join(out)
    for i in range(len(places)):
        for j in range(i, len(places)):
            assert written.back(i, j + 1) == (places[i][0], places[j][1])


def test_long_texts_take_time_by_length():
    for text in ("x" * 300_000, "1" * 300_000, "1 " * 150_000, "a." * 150_000, "@" * 300_000, "one " * 80_000 + "x", " at " * 80_000, "a dot " * 50_000, "(" * 200_000, " " * 300_000, "+" * 200_000, "+1" + " " * 200_000, "a_" * 100_000 + "@"):
        plain = list(plain_spans(text))
        list(hidden_spans(text, plain))
        assert len(fold("ü" + text)) == len(text) + 1
    assert bare("a​​b").text == "ab" and mail_signs("").text == digits("").text == ""


def _rows():
    pick = random.Random(6)
    rows = []
    for i in range(60):
        parts = [pick.choice(DISGUISES)[1] if pick.random() < 0.4 else pick.choice(["und", "die.55@mail4.example.com", "10.0.0.1", "x"]) for _ in range(9)]
        rows.append((200 + i, " ; ".join(parts)))
    return [*awkward_texts(), *rows, rows[0]]


def test_query_equals_its_contract(spark, tmp_path):
    rows = _rows()
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    df = op13_pii(spark, str(tmp_path))
    assert df.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    want = []
    for i, text in rows:
        plain = _by_pattern(text or "")
        hidden = [f[:3] for f in hidden_spans(text or "", list(plain_spans(text or "")))]
        every = sorted([*plain, *hidden], key=lambda s: (KINDS.index(s[0]), s[1]))
        said, all_ = (",".join(f"{k}:{s}:{e}" for k, s, e in part) for part in (plain, every))
        want.append((i, *(sum(p[0] == k for p in plain) for k in KINDS), hashlib.sha256(said.encode()).hexdigest(), all_))
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)
    assert any(w[6].count(":") > 2 * sum(w[1:5]) for w in want)


def test_other_columns_and_empty_table(spark):
    df = documents(spark, _rows())
    plain, more = (sorted(find_identifiers(d).collect(), key=repr) for d in (df, crowded(df)))
    assert plain == more
    assert find_identifiers(df.where("false")).collect() == []
    spans = {r[0]: r[1] for r in plain}
    assert spans[40] == [] and spans[41] == [] and spans[44] == []
