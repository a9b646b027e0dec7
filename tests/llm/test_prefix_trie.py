import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
import xxhash

from tablekit.llm import prefix_trie as T

SCHEMA = "conv_id long, turn int, role string, text string, depth string, k1 int, members string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def tie(role, text):
    h = xxhash.xxh64_intdigest(text.encode(), seed=xxhash.xxh64_intdigest(role.encode(), seed=42))
    return h - (1 << 64) if h >> 63 else h


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, tie(role or "", text or ""), role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in sorted(built.items()):
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        s = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += s
    return sorted((m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in m if len(built[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items())


def result(spark, rows, **kw):
    turns = T.ordered_turns(frame(spark, rows))
    return sorted(map(tuple, T.prefix_trie(*T.spliced(turns), **kw).collect()), key=lambda r: r[:2])


def conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        k = rng.choice([1, 2, 3, 4, 6])
        same = c % 3 == 0                                  # a third are copies of one conversation
        for t in range(k if not same else 5):
            rows.append((c, t, "user" if t % 2 else "bot", f"w{t} a\tb" if same else rng.choice(["x y", "x z", "p q r", ""])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("most, per_shard, queue", [(None, 50_000, 200_000), (2, 7, 2), (5, 3, 1), (10**9, 10, 3)])
def test_equals_brute_force(spark, most, per_shard, queue):
    rows = conversations(1, 130)
    assert result(spark, rows, most_members=most, runs_per_shard=per_shard, queue=queue) == brute(rows)


def test_a_long_conversation_spread_over_tasks(spark):
    rows = [(c, t, "r", f"t{t % 7}") for c in (40, 41, 43) for t in range(900)] + conversations(2, 30)
    rows = [r for r in rows if r[0] not in (40, 41, 43) or len(r[3]) == 2]
    assert result(spark, rows, most_members=2) == brute(rows)
    turns = T.ordered_turns(frame(spark, rows))
    assert turns.where("conv_id = 40").count() == turns.where("conv_id = 40").select("place").distinct().count() == 900


def test_edge_rows(spark):
    rows = [(0, None, "a", "x"), (0, None, "a", "y"), (0, 1, None, None), (0, 1, None, None), (1, 3, "a", None),
            (None, 1, "a", "b"), (25, 0, "u", "lone"), (-5, 0, "n", "neg"), (-5, 1, "n", "neg two"), (2, 0, "a", "b" * 5000),
            (3, 0, "", ""), (44, 0, "only", "one"), (2**62, 0, "big", "id")]
    assert result(spark, rows) == brute(rows)
    assert result(spark, [(8, 0, "r", "t")]) == brute([(8, 0, "r", "t")])
    assert any(not p for p in [brute(rows)]) is False
    assert result(spark, []) == []


def test_queue_spills_and_keeps_order():
    q, rng = T.SpillingQueue(10), random.Random(3)
    items = [(rng.randrange(50), i) for i in range(500)]
    got = []
    for i, item in enumerate(items):
        q.push(item)
        if i % 5 == 4:
            got.append(q.pop())
    assert q.spilled > 10
    rest = []
    while q.least() is not None:
        assert q.least() == (top := q.pop())
        rest.append(top)
    assert rest == sorted(rest) and sorted(got + rest) == sorted(items)


def test_ids_of_one_node_are_packed_not_listed(spark):
    ids = spark.range(60_000).selectExpr("id % 2 * 0 AS k1", "id % 2 * 0 AS k2", "id AS conv_id")
    got = T.id_digests(ids, ["k1", "k2"], "conv_id").collect()
    assert [r["sha256"] for r in got] == [hashlib.sha256(",".join(map(str, range(60_000))).encode()).hexdigest()]
