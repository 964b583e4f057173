import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, url_filter


def lower(t):
    return (t or "").translate({i: i + 32 for i in range(65, 91)})


def brute(rows):
    groups = defaultdict(list)
    for d, t, *_ in rows:
        groups[lower(t)].append(d)
    return sorted(
        ((d, max((x for x in groups[lower(t)] if x is not None), default=None), len(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest())
         for d, t, *_ in rows), key=repr)


def test_exact_dedup_matches_brute_force(docs_of, hard_rows):
    docs = docs_of(hard_rows)
    got = exact_dedup.exact_dedup(docs).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.digest.hex()) for r in got), key=repr) == brute(hard_rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({lower(t) for _, t, *_ in hard_rows})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_weak_digest_is_told_apart_by_full_bytes(docs_of, hard_rows):
    weak = exact_dedup.exact_dedup(docs_of(hard_rows), digest=lambda t: F.lit(b"same"))
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in weak.collect()), key=repr) == [x[:3] for x in brute(hard_rows)]


def test_state_lives_across_micro_batches(spark, tmp_path):
    for i in range(3):
        spark.createDataFrame([(i, "same"), (i + 10, f"own {i}")], "doc_id long, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "d"))
    got = exact_dedup.exact_dedup(spark.read.parquet(str(tmp_path / "d")), batch_bytes=1)
    assert {(r.keep_id, r.group_size) for r in got.collect() if r.doc_id < 10} == {(2, 3)}


def test_keep_one_keeps_one_row_with_all_columns(docs_of, hard_rows):
    docs = docs_of(hard_rows)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == len({lower(t) for _, t, *_ in hard_rows})
    assert {r.doc_id for r in rows if lower(r.text) == "tie"} == {8}


def test_exact_dedup_of_an_empty_table(docs_of):
    assert exact_dedup.exact_dedup(docs_of([])).count() == 0
    assert exact_dedup.keep_one(docs_of([])).count() == 0


RULES = [(h, p, a) for a, h, p in url_filter.RULES]


def judge(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, path = lower(rest[:cut]), rest[cut:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [(len(h + p), h + p, a) for h, p, a in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[1], best[2] if best else "allow"


def test_url_filter_matches_brute_force(spark, tmp_path):
    urls = [None, "", "nonsense", "http://", "http://com/en/", "https://A.Example.COM/en/7?x=1", "http://x.example.com/en/8", "ftp://com",
            "http://b.net/de/1", "http://example.net/de/81#f", "http://notexample.net/de/81", "http://q.org/es/", "http://q.org/ES/", "http://org/es/x://y",
            "http://.com/en/", "http://a..com/en/", "http://com/en/\nline", "http://com?/en/", "http://a.com:80/en/1", "http://x.net/de/\u00e9", "http://" + "a." * 3000 + "com/en/1"]
    rows = [(i, u, "x", "y", "z") for i, u in enumerate(urls)] + [(4, urls[4], "x", "y", "z"), (None, urls[4], "x", "y", "z")]
    spark.createDataFrame(rows, "page_id long, url string, host string, rule string, path string").write.parquet(str(tmp_path / "p"))
    got = url_filter.url_filter(spark.read.parquet(str(tmp_path / "p")), url_filter.rule_table(spark)).collect()
    want = sorted(((i, *judge(u)) for i, u, *_ in rows), key=repr)
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=repr) == want


def test_url_filter_of_an_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.url_filter(pages, url_filter.rule_table(spark)).count() == 0
    none = url_filter.rule_table(spark).limit(0)
    one = spark.createDataFrame([(1, "http://com/en/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.url_filter(one, none).collect()] == ["allow"]
