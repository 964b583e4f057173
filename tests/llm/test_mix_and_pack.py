import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import packing, source_mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def level(sizes, weights):
    """Resharing by rounds, as the contract tells it."""
    total, target, open_ = 1.5 * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        left = total - sum(target[i] for i in range(len(sizes)) if i not in open_)
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = {i for i in open_ if share[i] > 2 * sizes[i]}
        for i in over or open_:
            target[i] = 2.0 * sizes[i] if over else share[i]
        open_ -= over or open_
    return target


def mixed(docs):
    sized = source_mix.sized_rows(docs)
    sources = source_mix.targets(sized)
    return sized, sources, source_mix.mix(sized, sources)


def test_targets_and_taken(docs_of, hard_rows):
    rows = hard_rows + [(100 + i, "w " * (7 * i % 50), "abc"[i % 3] if i % 4 else None) for i in range(200)]
    docs = docs_of(rows)
    sized, sources, pieces = mixed(docs)
    size = defaultdict(int)
    for d, t, *s in rows:
        size[(s or ["a"])[0]] += len(WORD.findall(t or ""))
    names = sorted((x for x in size if x is not None)) + [None]
    want = level([size[n] for n in names], [(3, 1, 2)[i % 3] for i in range(len(names))])
    got = {r.source: r for r in sources.collect()}
    for n, w in zip(names, want):
        assert got[n].source_size == size[n]
        assert got[n].target == pytest.approx(w)
    taken = {r["row"]: r["sum(words)"] for r in pieces.groupBy("row").sum("words").collect()}
    by = defaultdict(int)
    for r in sized.collect():
        assert taken.get(r.row, 0) <= 2 * r["size"]
        by[r.source] += taken.get(r.row, 0)
    assert all(abs(by[n] - w) <= 1 for n, w in zip(names, want))


def test_schedule_interleaves_by_weight(spark, docs_of):
    docs = docs_of([(i, "w " * 64, "abc"[i % 3]) for i in range(600)])
    sized, sources, pieces = mixed(docs)
    first = pieces.where("slot < 60").select("slot", "row").join(sized.select("row", "source"), "row").collect()
    share = defaultdict(set)
    for r in first:
        share[r.source].add(r.slot)
    want = {r.source: r.target for r in sources.collect()}
    for s, slots in share.items():
        assert abs(len(slots) / 60 - want[s] / sum(want.values())) < 0.1


def test_mixed_documents_hold_what_the_mix_takes(docs_of, hard_rows):
    docs = docs_of(hard_rows)
    sized, sources, pieces = mixed(docs)
    out = source_mix.mixed_documents(docs)
    assert out.columns == docs.columns
    words = sum(len(WORD.findall(r.text or "")) for r in out.collect())
    assert words == pieces.agg({"words": "sum"}).first()[0]
    again = source_mix.mixed_documents(docs)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, out.collect()))


def test_small_sources_lose_no_words(docs_of):
    """Sources of a few words, and the null source, beside a million words: each has a slot for every block."""
    small = [(2000 + i, "w " * 5, f"s{i}") for i in range(6)] + [(3000, "w " * 7, None)]
    docs = docs_of([(i, "w " * 1000, "a") for i in range(1000)] + small, clash=False)
    sized, sources, pieces = mixed(docs)
    got = {r.source: r.words for r in pieces.join(sized.select("row", "source"), "row").groupBy("source").agg({"words": "sum"}).withColumnRenamed("sum(words)", "words").collect()}
    take = {r.source: r.take for r in sources.collect()}
    assert got == take and len(take) == 8 and take["s0"] == 10
    assert pieces.select("slot").distinct().count() == sum(-(-t // 128) for t in take.values())
    assert {d for d, *_ in small} <= {r.doc_id for r in source_mix.mixed_documents(docs).collect()}


def test_rows_without_ids_are_spread(docs_of, monkeypatch):
    """Neither null ids nor rows without words gather in one bucket; the mix stays whole."""
    monkeypatch.setattr(source_mix, "BUCKET_DOCS", 16)
    docs = docs_of([(None, f"w{i} " * (1 + i % 5)) for i in range(300)] + [(None, None)] * 200 + [(i, "w " * 3) for i in range(100)], clash=False)
    sized, sources, pieces = mixed(docs)
    placed = sorted((r.start, r["size"]) for r in source_mix._positions(sized, sources, 42).collect())
    assert len(placed) == 400 and all(a + n == b for (a, n), (b, _) in zip(placed, placed[1:]))
    by_start = [r.row for r in source_mix._positions(sized, sources, 42).orderBy("start").collect()]
    null = {r.row for r in sized.where("doc_id IS NULL").collect()}
    runs = "".join("n" if r in null else " " for r in by_start).split()
    assert len(runs) > 30 and max(map(len, runs)) < 60
    assert pieces.agg({"words": "sum"}).first()[0] == sources.first().take


def test_mix_of_empty_tables(docs_of):
    for rows in ([], [(1, None), (2, "")]):
        docs = docs_of(rows)
        sized, sources, pieces = mixed(docs)
        assert pieces.count() == 0
        assert source_mix.mixed_documents(docs).count() == 0


def check_packing(rows, pieces, full):
    by = defaultdict(list)
    for p in pieces:
        by[p.sequence_id].append(p)
    for own in by.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= 4096
    want = sorted(
        (d if d is not None else -1, ids) for d, ids in ((d, tuple(full.encode(t or "", add_special_tokens=False).ids) + (2,)) for d, t, *_ in rows)
    )
    # Pieces of a document follow each other in (sequence, offset); repeated ids are told apart by their order.
    got, open_ = [], {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        key = p.doc_id if p.doc_id is not None else -1
        if p.start == 0:
            assert key not in open_
            open_[key] = []
        assert sum(x[0] for x in open_[key]) == p.start
        open_[key].append((p.length, p.ids_crc32))
        if p.start + p.length == p.doc_tokens:
            got.append((key, open_.pop(key)))
    assert not open_
    assert sorted(k for k, _ in got) == [d for d, _ in want]
    left = [(k, cuts) for k, cuts in got]
    for d, ids in want:
        for i, (k, cuts) in enumerate(left):
            at, ok = 0, k == d and sum(c[0] for c in cuts) == len(ids)
            for n, crc in cuts if ok else ():
                ok = ok and zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes()) == crc
                at += n
            if ok:
                left.pop(i)
                break
        else:
            raise AssertionError(d)


def test_packing_is_exact(docs_of, hard_rows):
    rows = hard_rows + [(50, "<|endoftext|> it's THEY'LL \x01\x1c\x7f 12'3 x\u0301 \u1e9e"), (51, "a" * 3000)]
    pieces = packing.pack(docs_of(rows), packing.default_vocabulary()).collect()
    check_packing(rows, pieces, packing.encoder(packing.default_vocabulary()).full)


def test_packing_of_an_empty_table(docs_of):
    assert packing.pack(docs_of([]), packing.default_vocabulary()).count() == 0


def brute_cost(positions, penalties, size, final):
    best = {positions[0]: 0}
    for j in range(1, len(positions)):
        p = positions[j]
        last = final and j == len(positions) - 1
        best[p] = min(
            best[q] + (packing.tail_cost(p - q, size)[0] if last else size - (p - q) + penalties[j])
            for q in positions[:j] if p - q <= size
        )
    return best[positions[-1]]


@pytest.mark.parametrize("seed", range(30))
def test_windows_are_optimal(seed):
    rng = np.random.default_rng(seed)
    positions = np.concatenate([[0], np.cumsum(rng.integers(1, 12, 80))]).tolist()
    penalties = rng.choice([0, 2, 12], len(positions)).tolist()
    size, final = int(rng.integers(16, 64)), bool(seed % 2)
    cuts = packing.cut_windows(positions, penalties, size, final)
    where = {p: i for i, p in enumerate(positions)}
    cost = 0
    for a, b in zip(cuts, cuts[1:]):
        assert 0 < b - a <= size
        last = final and b == positions[-1]
        cost += packing.tail_cost(b - a, size)[0] if last else size - (b - a) + penalties[where[b]]
    assert cuts[0] == 0 and cuts[-1] == positions[-1]
    assert cost == brute_cost(positions, penalties, size, final)
