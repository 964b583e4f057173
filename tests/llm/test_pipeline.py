import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
from tidemark.llm import packing, quality


def lower(t):
    return (t or "").translate({i: i + 32 for i in range(65, 91)})


def run_stages(spark, docs, sf_dir, tmp_path):
    """The frames after each stage, written and read as the pipeline does."""
    out = [docs]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / f"stage{i}")
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_in_order(spark, docs_of, hard_rows, tmp_path):
    docs = docs_of(hard_rows + [(100 + i, f"a plain document number {i} with words of its own {i * 7}") for i in range(40)], clash=False)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    frames = run_stages(spark, docs, str(tmp_path), tmp_path)
    assert [len(f.columns) for f in frames[:-1]] == [5] * 5
    assert frames[1].count() == docs.count()  # without labels nothing is rejected
    texts = [lower(r.text) for r in frames[2].collect()]
    assert len(texts) == len(set(texts)) == len({lower(r.text) for r in docs.collect()})
    assert set(r.doc_id for r in frames[3].collect()) <= set(r.doc_id for r in frames[2].collect())
    want = Counter()
    known = packing.encoder(packing.default_vocabulary())
    for r in frames[4].collect():
        want[r.doc_id] += len(known.full.encode(r.text or "", add_special_tokens=False).ids) + 1
    got = Counter()
    for p in frames[5].collect():
        got[p.doc_id] += p.length
    assert got == want


def corpus():
    """Good and bad documents with labels, copies in other case, near copies, three sources."""
    rng = random.Random(8)
    words = [f"word{i}" for i in range(400)] + ["the", "of", "river.", "over"] * 20
    rows, labels = [], []
    for i in range(320):
        text = " ".join(rng.choices(words, k=rng.randint(40, 160)))
        if i % 8 == 0:
            text = " | ".join(text.upper().split())
        rows.append((i, text, "abc"[i % 3 % (1 + i % 2 * 2)]))
        labels.append((i, int(i % 8 != 0), 0))
    for i in range(1, 80, 2):  # copies, some of them in capitals
        d, text, source = rows[i]
        rows.append((1000 + i, text.capitalize() if i % 3 else text, source))
    for i in range(81, 160, 2):  # one word of some 100 is another: similarities of 0.8 and more, or less in short texts
        d, text, source = rows[i]
        own = text.split()
        own[rng.randrange(len(own))] = "changed"
        rows.append((2000 + i, " ".join(own), source))
    return rows, labels


def one_of_each_near(rows):
    """Least doc_id of each group of rows linked by five-word shingles, by all pairs."""
    sets = []
    for d, text in rows:
        own = lower(text).split()
        sets.append({" ".join(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set())
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and shared / len(sets[i] | sets[j]) >= 0.8:
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    least = defaultdict(list)
    for (d, _), r in zip(rows, root):
        least[r].append(d)
    return {min(ds) for ds in least.values()}


def test_each_stage_matches_brute_force(spark, docs_of, tmp_path):
    rows, labels = corpus()
    docs = docs_of(rows, clash=False)
    sf_dir = tmp_path / "tables"
    docs.write.parquet(str(sf_dir / "documents.parquet"))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    table.write.parquet(str(sf_dir / "labels.parquet"))
    frames = run_stages(spark, docs, str(sf_dir), tmp_path)
    held = [[(r.doc_id, r.text, r.source) for r in f.collect()] for f in frames[:-1]]
    ids = [{d for d, *_ in h} for h in held]

    scores = {r.doc_id: r.score for r in quality.quality_scores(docs, table).collect()}
    assert ids[1] == {d for d, s in scores.items() if s >= 0.3}
    bad = {d for d, q, _ in labels if not q}
    assert len(bad & ids[1]) < len(bad) / 10 and len(ids[0] - bad - ids[1]) < 4

    last = {}
    for d, text, _ in held[1]:
        last[lower(text)] = max(d, last.get(lower(text), d))
    assert ids[2] == set(last.values()) and len(ids[1]) - len(ids[2]) > 20

    assert ids[3] == one_of_each_near([r[:2] for r in held[2]]) and len(ids[2]) - len(ids[3]) > 20

    texts = {d: t for d, t, _ in held[3]}
    size, taken = Counter(), Counter()
    for d, text, source in held[3]:
        size[source] += len(text.split())
    of_doc = Counter()
    for d, text, source in held[4]:
        taken[source] += len(text.split())
        of_doc[d] += len(text.split())
        assert re.match(re.escape(text), texts[d])
    assert all(n <= 2 * len(texts[d].split()) for d, n in of_doc.items())
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) <= 2 and all(taken[s] <= 2 * size[s] for s in size)

    tokens = Counter()
    known = packing.encoder(packing.default_vocabulary())
    for d, text, _ in held[4]:
        tokens[d] += len(known.full.encode(text, add_special_tokens=False).ids) + 1
    pieces = frames[5].collect()
    packed = Counter()
    for p in pieces:
        packed[p.doc_id] += p.length
    assert packed == tokens
    again = Counter()
    for p in corpus_pipeline.run(spark, str(sf_dir)).collect():
        again[p.doc_id] += p.length
    assert again == packed


def test_empty_corpus(spark, docs_of, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    frames = run_stages(spark, docs_of([], clash=False), str(tmp_path), tmp_path)
    assert all(f.count() == 0 for f in frames)
