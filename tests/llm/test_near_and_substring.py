import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash, substring_dedup
from tidemark.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text, k=3):
    words = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints, radius):
    own = list(range(len(prints)))

    def find(x):
        while own[x] != x:
            x = own[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (int(prints[i]) ^ int(prints[j])).bit_count() <= radius:
                a, b = find(i), find(j)
                own[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def near(rng, n=60, copies=5):
    base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    out = [base]
    for _ in range(copies):
        flips = np.zeros(n, np.uint64)
        for _ in range(int(rng.integers(1, 4))):
            flips ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
        out.append(out[-1] ^ flips)
    return np.concatenate(out)


@pytest.mark.parametrize("radius", [0, 1, 3, 7])
def test_tree_search_is_exact(radius):
    prints = np.unique(near(np.random.default_rng(radius)))
    q, n = simhash.BKTree(prints).within(prints, radius)
    want = {(i, j) for i, a in enumerate(prints) for j, b in enumerate(prints) if (int(a) ^ int(b)).bit_count() <= radius}
    assert set(zip(q.tolist(), n.tolist())) == want


def test_spanning_links_match_brute_force():
    prints = near(np.random.default_rng(5))
    prints = np.concatenate([prints, prints[:50]])
    assert simhash.spanning_links(prints, 3).tolist() == roots(prints, 3)


@pytest.mark.parametrize("shard", [4096, 4])
def test_fingerprint_components(spark, monkeypatch, shard):
    """With small shards the second level of blocks takes over; the result stays exact."""
    monkeypatch.setattr(simhash, "SHARD", shard)
    prints = near(np.random.default_rng(9))
    prints = np.concatenate([prints, np.array([0, 0, 2**64 - 1, 2**64 - 2], np.uint64)])
    rows = [(i, int(p.view(np.int64))) for i, p in enumerate(prints)]
    got = simhash.fingerprint_components(spark.createDataFrame(rows, "doc_id long, fingerprint long"), 3)
    named = {r.fingerprint: r.component_id for r in got.collect()}
    assert [named[f] for _, f in rows] == roots(prints, 3)


def test_query_columns_match_brute_force(docs_of, hard_rows):
    text = " ".join(f"tok{i}" for i in range(400))
    rows = hard_rows + [(20, text), (21, text + " end"), (22, text.replace("tok7 ", "TOK7 ")), (23, "one"), (24, "ONE"), (25, "two words"), (26, None)]
    prints = simhash.fingerprints(docs_of(rows), 3)
    named = prints.join(simhash.fingerprint_components(prints.select("doc_id", "fingerprint")), "fingerprint").collect()
    want = {r[1]: fingerprint(r[1]) for r in rows}
    assert sorted(((r.doc_id, r.fingerprint & (1 << 64) - 1) for r in named), key=repr) == sorted(((r[0], want[r[1]]) for r in rows), key=repr)
    own = roots([want[r[1]] for r in rows], 3)
    least = defaultdict(list)
    for r, c in zip(rows, own):
        least[c].append(r[0])
    expected = sorted(((r[0], min((x for x in least[c] if x is not None), default=None)) for r, c in zip(rows, own)), key=repr)
    assert sorted(((r.doc_id, r.component_id) for r in named), key=repr) == expected


def test_similar_texts_leave_one(docs_of, hard_rows):
    rng = np.random.default_rng(3)
    rows = list(hard_rows)
    for g in range(12):
        words = [f"g{g}w{x}" for x in rng.integers(0, 5000, 600)]
        for c in range(4):
            copy = list(words)
            for i in rng.integers(0, 600, 5 * c):
                copy[i] = f"new{rng.integers(0, 10**9)}"
            rows.append((100 + 10 * g + c, " ".join(copy)))
    docs = docs_of(rows)
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {100 + 10 * g for g in range(12)} <= set(ids)
    shingles = lambda t: {" ".join(w[i : i + 5]) for w in [t.split()] for i in range(len(w) - 4)}
    texts = dict(r[:2] for r in rows)
    for g in range(12):
        a = shingles(texts[100 + 10 * g])
        for c in range(1, 4):
            b = shingles(texts[100 + 10 * g + c])
            similarity = len(a & b) / len(a | b)
            if similarity >= 0.88:
                assert 100 + 10 * g + c not in ids
            if similarity < 0.7:
                assert 100 + 10 * g + c in ids or c > 1
    # Of repeated rows one stays; texts without words are similar to none.
    assert [d for d in ids if d in (3, 4, 5)] and ids.count(7) + ids.count(8) == 1


def test_similarity_is_exact(docs_of):
    """Pairs just at 0.8 go, those just below stay: 8 of 10 shingles, and texts of 100 to 400 around the threshold."""
    rows = []
    for g in range(60):
        words = [f"g{g}w{i}" for i in range(13 if g < 20 else 100 + 5 * g)]
        k = len(words) - 4
        # The last c words changed: (k - c) / (k + c) is the similarity.
        c = 1 if g < 20 else k // 9 + g % 2
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(words[: len(words) - c] + [f"new{g}x{i}" for i in range(c)]))]
    ids = {r.doc_id for r in simhash.keep_one_of_each(docs_of(rows)).collect()}
    shingles = [{" ".join(w[i : i + 5]) for w in [t.split()] for i in range(len(w) - 4)} for _, t in rows]
    want = {2 * g for g in range(60)}
    want |= {2 * g + 1 for g in range(60) if len(shingles[2 * g] & shingles[2 * g + 1]) / len(shingles[2 * g] | shingles[2 * g + 1]) < 0.8}
    assert 70 < len(want) < 90 and ids == want


def test_repeated_lines_do_not_hide_copies(docs_of):
    """Equal sets of shingles, but for the line's seams, with the line once or 100 times."""
    rows = []
    for g in range(10):
        line, rest = [f"l{g}x{i}" for i in range(9)], [f"g{g}w{i}" for i in range(500)]
        rows += [(2 * g, " ".join(rest + line * 2)), (2 * g + 1, " ".join(rest + line * 100))]
    assert sorted(r.doc_id for r in simhash.keep_one_of_each(docs_of(rows)).collect()) == list(range(0, 20, 2))


@pytest.mark.parametrize("shard", [4096, 16])
def test_pairs_of_a_hot_key_alone_are_linked(spark, docs_of, monkeypatch, shard):
    """All rows share the first key, and no two rows another one: salted or not, the same pairs are linked."""
    monkeypatch.setattr(simhash, "SHARD", shard)
    rows = []
    for g in range(60):
        words = [f"g{g}w{i}" for i in range(300)]
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(words[:-5] + ["new"] * 5))]
    docs = docs_of(rows)
    prints = simhash.fingerprints(docs, 5, sketch=True)
    hot = prints.withColumn("keys", F.array(F.lit(1).cast("long"), *[F.col("row") * 8 + k for k in range(1, 6)]))
    members = prints.select(F.col("row").alias("id"), "doc_id").join(simhash.similar_components(hot, docs), "id").collect()
    groups = defaultdict(set)
    for m in members:
        groups[m.root].add(m.doc_id)
    assert sorted(map(sorted, groups.values())) == [[2 * g, 2 * g + 1] for g in range(60)]


def test_empty_tables(docs_of):
    prints = simhash.fingerprints(docs_of([]), 3)
    assert simhash.fingerprint_components(prints.select("doc_id", "fingerprint")).count() == 0
    assert simhash.keep_one_of_each(docs_of([])).count() == 0
    assert substring_dedup.substring_dedup(docs_of([])).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (9, 8), (8, 9)]
    got = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 161))
    assert all(got[i] == 500 for i in range(500, 560))
    assert got[9] == got[8] == 8 and 7 not in got


def brute_removed(rows):
    """rows in order of the table; ties in doc_id are in that order."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    seen, out = set(), []
    for i in order:
        words = WORD.findall(rows[i][1] or "")
        gone = [False] * len(words)
        for s in range(len(words) - 19):
            w = tuple(words[s : s + 20])
            if w in seen:
                gone[s : s + 20] = [True] * 20
            seen.add(w)
        kept = [w for w, g in zip(words, gone) if not g]
        out.append((rows[i][0], len(words), len(words) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group", [1 << 13, 2])
def test_substring_dedup_matches_brute_force(docs_of, hard_rows, monkeypatch, group):
    """With small groups, codes are shared out; the result is the same."""
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    rng = np.random.default_rng(1)
    passages = [[f"p{p}x{i}" for i in range(n)] for p, n in enumerate((19, 20, 21, 60, 200))]
    rows = list(hard_rows)
    for d in range(60):
        words = []
        for _ in range(rng.integers(1, 6)):
            words += [f"u{rng.integers(0, 10**9)}" for _ in range(rng.integers(0, 40))]
            p = passages[rng.integers(0, 5)]
            a = int(rng.integers(0, 5))
            words += p[a:]
        rows.append((int(rng.integers(50, 90)) if d % 10 == 0 else 100 + d, "  \n".join(words)))
    rows += [(300, "same " * 100), (301, "same " * 30), (302, "x y " * 50)]
    rows = [r for i, r in enumerate(rows) if r[0] is None or r[0] not in {x[0] for x in rows[:i]} or r[1] == "tie"]
    rows = [r for r in rows if r[0] is not None or r[1] == "no id at all"]
    got = substring_dedup.substring_dedup(docs_of(rows)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == brute_removed(rows)


def test_repeated_rows_keep_one(docs_of):
    text = " ".join(f"w{i}" for i in range(30))
    got = substring_dedup.substring_dedup(docs_of([(5, text), (5, text), (None, text)])).collect()
    assert sorted(((r.doc_id, r.n_removed) for r in got), key=repr) == [(5, 30), (5, 30), (None, 0)]


def test_suffix_trees_match_brute_force():
    """Order of leaves and common prefixes of three groups of segments over few words, whose widths differ."""
    rng = np.random.default_rng(8)
    groups, segments = np.sort(rng.integers(0, 3, 60)), []
    for _ in groups:
        segments.append([b"w%d" % x for x in rng.integers(0, 2, rng.integers(20, 36))])
    segments[5], groups[5] = segments[4], groups[4]
    widths = np.array([len(s) for s in segments])
    segment, place, depths = substring_dedup.suffix_tree(groups, [b" ".join(s) for s in segments], widths - 19, widths)
    leaves = [(groups[s], segments[s][p:]) for s, p in zip(segment, place)]
    assert sorted(zip(segment.tolist(), place.tolist())) == [(s, p) for s in range(60) for p in range(widths[s] - 19)]
    for i in range(1, len(leaves)):
        (g, a), (h, b) = leaves[i - 1], leaves[i]
        shared = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) if g == h else 0
        assert depths[i] == shared
    # Leaves under one deep node are all those that share a window.
    by = defaultdict(set)
    for (g, words), node in zip(leaves, substring_dedup.deep_nodes(depths)):
        by[g, tuple(words[:20])].add(node)
    assert all(len(nodes) == 1 for nodes in by.values()) and len(set.union(*by.values())) == len(by)


def test_a_frequent_passage_fills_no_task(spark, docs_of, monkeypatch):
    """A passage of 30 words in a third of the documents, within different words: groups stay small, the result is that of brute force."""
    monkeypatch.setattr(substring_dedup, "GROUP", 16)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for d in range(600):
        own = [f"d{d}w{i}" for i in range(30)]
        rows.append((d, " ".join(own[:15] + (passage if d % 3 == 0 else []) + own[15:])))
    sizes = []
    deal = substring_dedup.subtrees
    monkeypatch.setattr(substring_dedup, "subtrees", lambda s: sizes.append(s.groupBy("code", "salt").count().agg(F.max("count")).first()[0]) or deal(s))
    got = substring_dedup.substring_dedup(docs_of(rows)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == brute_removed(rows)
    assert max(sizes) <= 40


def test_one_repetitive_text_fills_no_task(spark, docs_of, monkeypatch):
    """A phrase of five words after every eleven new ones of one text: its code's segments are shared out, the result is that of brute force."""
    monkeypatch.setattr(substring_dedup, "GROUP", 64)
    phrase = [f"p{i}" for i in range(5)]
    words = [w for i in range(3000) for w in [f"n{i % 2900}x{j}" for j in range(11)] + phrase]
    rows = [(1, " ".join(words)), (2, " ".join(words[500:700])), (3, " ".join(phrase * 3))]
    sizes, deal = [], substring_dedup.subtrees

    def watched(segments):
        sizes.extend(segments.groupBy("code").agg(F.count("*"), F.max("salt")).orderBy(F.desc("count(1)")).first()[1:2])
        sizes.append(segments.groupBy("code", "salt").count().agg(F.max("count")).first()[0])
        return deal(segments)

    monkeypatch.setattr(substring_dedup, "subtrees", watched)
    got = substring_dedup.substring_dedup(docs_of(rows)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == brute_removed(rows)
    assert sizes[0] > 1000 and sizes[1] <= 2 * 64


def test_codes_are_counted_without_a_window(spark):
    coded = spark.createDataFrame([(1, 1, 0, 1), (2, 1, 9, 1), (2, 2, 0, 3), (3, 3, 0, 2), (3, 3, 5, -1), (4, 4, 0, 0)], "code long, row long, at long, segments int")
    found = substring_dedup.repeated_codes(coded)
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(1, 9, 2, False, 4), (2, 0, 2, False, 4), (3, 0, 3, False, 2), (3, 5, 3, False, None), (4, 0, 4, True, None)], key=repr
    )


def test_every_equal_window_has_an_equal_code():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    shifted = np.concatenate([rng.integers(0, 1 << 63, 7, dtype=np.uint64), words[50:150], rng.integers(0, 1 << 63, 9, dtype=np.uint64)])
    known = substring_dedup.Hashes()
    at = []
    for x in (words, shifted):
        start = np.arange(len(x) - substring_dedup.CODE + 1)
        at.append(substring_dedup.code_places(known.runs(known.sums(x), start, start + substring_dedup.CODE)))
    for i in range(81):
        assert at[0][50 + i] - 50 == at[1][7 + i] - 7


def test_spans_partition_the_windows():
    rng = np.random.default_rng(3)
    texts = [[b"w%d" % x for x in rng.integers(0, 50, n)] for n in (0, 5, 19, 20, 21, 300, 64, 3)]
    text, _, _, low, high, place = substring_dedup.spans(substring_dedup.Hashes(), texts)
    seen = sorted((int(t), s) for t, a, b in zip(text, low, high) for s in range(a, b + 1))
    assert seen == [(t, s) for t, words in enumerate(texts) for s in range(len(words) - 19)]
    assert ((low <= place) & (place + substring_dedup.CODE <= high + 20)).all() and (high - low < 256).all()


def test_a_large_group_of_near_copies_is_not_copied_around(spark, docs_of, monkeypatch):
    """Of 400 near copies in shards of 16 all but one go, and rows are dealt out in proportion to their number."""
    monkeypatch.setattr(simhash, "SHARD", 16)
    words = [f"w{i}" for i in range(300)]
    rows = [(d, " ".join(words[: 299 - d % 7] + [f"d{d}"])) for d in range(400)] + [(1000 + d, f"some other text number {d} of its own") for d in range(40)]
    dealt, deal = [], simhash._by_shard
    monkeypatch.setattr(simhash, "_by_shard", lambda df, *a: dealt.append(df.count()) or deal(df, *a))
    ids = {r.doc_id for r in simhash.keep_one_of_each(docs_of(rows)).collect()}
    assert {x for x in ids if x < 1000} == {0}
    assert dealt[0] <= 2 * simhash.KEYS * len(rows)


def test_a_shared_passage_does_not_multiply_rows(spark, docs_of, monkeypatch):
    """20,000 texts of 240 words, unrelated but for one passage of 60: all stay, and the rows dealt out are fewer than three times theirs."""
    passage = " ".join(f"licence{i}" for i in range(60))
    rows = [(d, f"{passage} " + " ".join(f"d{d}w{i}" for i in range(180))) for d in range(20_000)]
    dealt, deal = [], simhash._by_shard
    monkeypatch.setattr(simhash, "_by_shard", lambda df, *a: dealt.append(df.count()) or deal(df, *a))
    assert simhash.keep_one_of_each(docs_of(rows)).count() == 20_000
    assert sum(dealt) < 3 * 20_000


def test_recall_at_the_similarity(docs_of):
    """Of 400 pairs a little above 0.8, of 25 to 400 words, at least 0.99 are found; of 400 a little below none."""
    rng = np.random.default_rng(12)
    rows, above = [], set()
    for g in range(800):
        n = int(rng.integers(25, 400))
        words, k = [f"g{g}w{i}" for i in range(n)], n - 4
        c = k // 9 + (g % 2)  # shingles that differ on either side: up to k / 9 is 0.8 and more
        if (k - c) / (k + c) >= 0.8:
            above.add(g)
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(words[: n - c] + [f"new{g}x{i}" for i in range(c)]))]
    ids = {r.doc_id for r in simhash.keep_one_of_each(docs_of(rows)).collect()}
    gone = {g for g in range(800) if 2 * g + 1 not in ids}
    assert gone <= above and len(gone) >= 0.99 * len(above) and len(above) >= 350
