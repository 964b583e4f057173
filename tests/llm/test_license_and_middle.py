import hashlib
import random
import re

import duckdb
import pytest

from tidemark.llm import fill_in_middle, license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


def statistics(ws, templates):
    """Of each word the longest run that ends there and stands in a template, by trying all."""
    known = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    out = []
    for i in range(len(ws)):
        n = 0
        while n <= i and tuple(ws[i - n : i + 1]) in known:
            n += 1
        out.append(n)
    return out


def spoiled(rng, text, loss):
    return " ".join(w if rng.random() > loss else "xyzzy" for w in text.split())


@pytest.mark.parametrize("piece", [7, 64, 1 << 20])
def test_matches_and_places_equal_brute_force(piece):
    rng = random.Random(5)
    templates = [words(t) for _, t in license_scan.TEMPLATES]
    every = templates + [p.split() for p in license_scan.PHRASES]
    vocabulary = sorted({w for t in every for w in t}) + ["foo", "É", "bar9"]
    for _ in range(60):
        bits = []
        for _ in range(rng.randrange(12)):
            t = rng.choice(every)
            i = rng.randrange(len(t))
            bits += t[i : i + rng.randrange(1, 12)] if rng.random() < 0.6 else [rng.choice(vocabulary)]
        text = " ".join(w.title() if rng.random() < 0.2 and w.isascii() else w for w in bits) + rng.choice(["", ".", "  "])
        ws = words(text)
        n = statistics(ws, every)
        want = [(i + 1 - n[i], i + 1) for i in range(len(ws)) if n[i] >= license_scan.MATCH_WORDS and (i + 1 == len(ws) or n[i + 1] <= n[i])]
        got = list(license_scan.walk(text, piece))
        assert [(a, b) for what, a, b, _ in got if what == "match"] == want
        phrases = [p.split() for p in license_scan.PHRASES]
        places = sorted((i, k) for k, p in enumerate(phrases) for i in range(len(ws)) if ws[i : i + len(p)] == p)
        assert sorted((a, k) for what, a, _, k in got if what == "place") == places
        assert got[-1] == ("end", 0, len(ws), 0)
        for what, a, b, state in got:
            if what == "match":
                ends = {(t, e) for t, s in enumerate(templates) for e in range(b - a, len(s) + 1) if s[e - (b - a) : e] == ws[a:b]}
                assert ends == {x for x in license_scan.automaton().ends[state]}


def test_templates_are_found_whole_spoiled_and_embedded():
    rng = random.Random(6)
    filler = " ".join(f"word{rng.randrange(500)}" for _ in range(300))
    for number, (label, text) in enumerate(license_scan.TEMPLATES):
        size = len(words(text))
        found = license_scan.scan(f"{filler} {text} {filler}")["spans"]
        assert (number, 300, 299 + size, size, 1.0, label) in found and len(found) == 1
        if size > 60:
            span = license_scan.scan(f"{filler} {spoiled(rng, text, 0.03)} {filler}")["spans"]
            assert {s[5] for s in span} == {label} and span[0][4] > 0.6
            half = " ".join(text.split()[: len(text.split()) // 2])
            assert {s[5] for s in license_scan.scan(f"{filler} {half}")["spans"]} == {label}
    assert license_scan.scan(filler)["spans"] == []
    text = license_scan.TEMPLATES[1][1]
    size = len(words(text))
    assert [x[:3] for x in license_scan.scan(f"{text} {filler} {text}")["spans"]] == [(1, 0, size - 1), (1, size + 300, 2 * size + 299)]


def test_near_licences_and_ordinary_talk_get_no_label():
    for text in ("licensed under CC BY-NC", "the licence under the terms of the work", "you may use this in any way, with or without a copy of the software"):
        assert license_scan.scan(text)["spans"] == []
    nc = license_scan.scan("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.")
    assert {s[5] for s in nc["spans"]} == {"cc-by-nc"}


def test_license_scan_of_hard_rows(docs_of, hard_rows):
    rows = hard_rows + [(20, "MIT License; the MIT-license of É mit licenses. Apache  License\nGNU General Public License"), (21, "released under the MIT license"), (21, "released under the MIT license")]
    got = {(r.doc_id, r.n_words): r for r in license_scan.license_scan(docs_of(rows)).collect()}
    r = got[20, 15]
    assert (r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == (4, 0, 12, "apache,gpl,mit", "apache,gpl,mit", 0.5)
    assert (got[21, 5].n_base, got[21, 5].score, got[21, 5].labels) == (1, 1.0, "mit")
    assert (got[4, 0].n_base, got[4, 0].first_word, got[4, 0].labels, got[4, 0].score) == (0, None, "", 0.0)
    assert license_scan.license_scan(docs_of(rows)).count() == len(rows) and license_scan.license_scan(docs_of([])).count() == 0


def test_a_licence_repeated_through_a_long_text_is_found_each_time():
    text = license_scan.TEMPLATES[1][1]
    found = license_scan.scan((text + "\n") * 500, 1000)
    assert len(found["spans"]) == 500 and {s[4] for s in found["spans"]} == {1.0}


def transformed(doc_id, text):
    text = text or ""
    d = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(d[8 * i : 8 * i + 8], 16) for i in range(4))
    units = UNIT.findall(text)
    n = len(units)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    if text == "" or any(m in text for m in fill_in_middle.MARKS) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    p, m, s = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, n)))
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 80 else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle_equals_brute_force(docs_of, hard_rows):
    rng = random.Random(7)
    odd = ["".join(rng.choice("ab< PSM>é\n\t\x00\x1c\x85\U0001f600") for _ in range(rng.randrange(60))) for _ in range(400)]
    rows = hard_rows + [(100 + i, t) for i, t in enumerate(odd)] + [(100, odd[0]), (900, " <P"), (901, "<M>"), (902, "\v\f "), (903, "a  b ")]
    got = fill_in_middle.fill_in_middle(docs_of(rows)).collect()
    key = lambda x: repr(x)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in got), key=key) == sorted(
        ((d, *transformed(d, t), t or "") for d, t, *_ in rows), key=key)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fill_in_middle.fill_in_middle(docs_of([])).count() == 0


def test_rates_are_parameters(docs_of):
    docs = docs_of([(i, f"one two {i}") for i in range(50)])
    assert {r.form for r in fill_in_middle.fill_in_middle(docs, rate=100, suffix_first=0).collect()} == {"psm"}
    assert {r.form for r in fill_in_middle.fill_in_middle(docs, rate=0).collect()} == {"plain"}
    assert all(r.restored == f"one two {r.doc_id}" for r in fill_in_middle.fill_in_middle(docs, seed=7, rate=100).collect())


def test_sql_of_fill_in_middle_on_the_same_rows(spark, docs_of, tmp_path):
    rows = [(i, t) for i, t in enumerate(["", None, " a", "a ", "é ü  \n", "x <S> y", "one two three", "\U0001f600 b\tc "])]
    docs_of(rows, clash=False).write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    got = fill_in_middle.op12_fill_in_middle(spark, str(tmp_path / "sf"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/sf/documents.parquet/*.parquet'")
    want = con.sql(fill_in_middle.OP12_SQL)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(want.fetchall())
