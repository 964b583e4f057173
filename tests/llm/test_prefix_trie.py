import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from tidemark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth string, parent string, level string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), (role, text)))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    members, ended = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        s = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
        ended[s].append(c)
    children = defaultdict(list)
    for q in members:
        if q:
            children[q[:-1]].append(q)
    out = {}
    for q in sorted(members, key=len, reverse=True):
        n = len(members[q])
        saved = (n - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) if q else 0
        below = [out[x] for x in children[q]]
        out[q] = (members[q][0], len(q), members[q[:-1]][0] if q else None, n, len(below), sum(b[5] for b in below) or 1, saved + sum(b[6] for b in below),
                  hashlib.sha256(",".join(map(str, ended[q])).encode()).hexdigest())
    return sorted(out.values(), key=repr)


def some_rows(seed, convs=120):
    rng = random.Random(seed)
    rows = []
    for _ in range(convs):
        c = rng.randrange(-30, 200)
        turns = rng.choice([1, 2, 3, 5, 9])
        rows += [(c, rng.choice([None, t, t, t, t]), rng.choice(["user", "bot", None]), rng.choice(["hi", "hi there", "", None, "same  old\tline", "x" * 50])) for t in range(turns)]
    rows += [(1000 + i, t, "user", f"line {t}") for i in range(60) for t in range(4)]  # one common conversation
    rows += [(2000, t, "user", f"turn {t % 3}") for t in range(70)] + [(2001, t, "user", f"turn {t % 3}") for t in range(66)]  # long ones
    rows += [(None, 0, "user", "lost"), (5000, None, None, None), (5000, None, None, None), (9, 0, "a:", "b"), (9, 0, "a", ":b")]
    rng.shuffle(rows)
    return rows


@pytest.fixture
def table(spark, tmp_path):
    def make(rows):
        path = str(tmp_path / f"c{len(list(tmp_path.iterdir()))}.parquet")
        spark.createDataFrame([(*r, *"wxyz") for r in rows], SCHEMA).repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.mark.parametrize("options", [{}, {"shard_rows": 6, "levels": 4, "block": 5, "held": 3}, {"shard_rows": 1, "levels": 1, "block": 1, "held": 1}])
def test_trie_equals_brute_force(table, options):
    rows = some_rows(11)
    got = prefix_trie.prefix_trie(table(rows), **options).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_trie_equals_its_sql(spark, table, tmp_path):
    rows = some_rows(12, 80)
    got = prefix_trie.prefix_trie(table(rows))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c0.parquet/*.parquet'")
    want = con.sql(prefix_trie.OP13_SQL)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr) == brute(rows)


def test_trie_of_empty_and_turnless_conversations(table):
    assert prefix_trie.prefix_trie(table([])).count() == 0
    turnless = next(c for c in range(1, 99) if c % 20 and zlib.crc32(str(c).encode()) % 4)
    got = prefix_trie.prefix_trie(table([(turnless, 0, "user", "gone")])).collect()
    assert [tuple(r) for r in got] == [(turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())]


def test_ends_of_many_members_stream_through_chunks(table):
    rows = [(20 * i, 0, "user", "hello") for i in range(9001)]
    (leaf,) = prefix_trie.prefix_trie(table(rows)).where("depth = 1").collect()
    assert (leaf.n_convs, leaf.saved_tokens) == (9001, 9000)
    assert leaf.ends_sha256 == hashlib.sha256(",".join(str(20 * i) for i in range(9001)).encode()).hexdigest()


def test_spilling_queue_is_a_queue():
    rng = random.Random(3)
    queue, held = prefix_trie.SpillingQueue(10), []
    for _ in range(3000):
        if rng.random() < 0.6 or not held:
            item = (rng.randrange(50), bytes([rng.randrange(4)]), rng.randrange(9), 0)
            queue.put(item)
            held.append(item)
        else:
            held.sort()
            assert queue.first() == held[0] and queue.pop() == held.pop(0)
    assert queue.spilled > 20
    assert [queue.pop() for _ in range(len(held))] == sorted(held) and queue.first() is None
