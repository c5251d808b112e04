import hashlib
import random
import zlib

from fieldkpi.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, shard binary, key string"


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        paths[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    nodes = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            nodes.setdefault(p[:d], []).append(c)
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        leaf = [q for q in below if not any(len(r) == len(q) + 1 and r[:-1] == q for r in nodes)]
        ends = sorted(c for c in members if len(paths[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members),
                    sum(len(r) == len(p) + 1 and r[:-1] == p for r in nodes), len(leaf),
                    sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in below if q),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(seed=2, n=70):
    rng = random.Random(seed)
    rows = []
    for c in range(-7, n):
        shared = rng.randint(0, 3)
        for t in range(rng.randint(1, 10)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"é{t}" if t <= shared else f"w{rng.randint(0, 2)}"))
    rows += [(500, None, None, None), (500, 0, "user", ""), (500, 0, "user", ""), (None, 1, "user", "x"), (501, 3, None, "x"), (502, 1, "a", None)]
    rows += [(1000 + i, t, "user", f"same {t}") for i in range(40) for t in range(9)]  # copies, one with many members
    rng.shuffle(rows)
    return rows


def df(spark, rows):
    return spark.createDataFrame([(*r, b"s", "k") for r in rows], SCHEMA).repartition(5)


def run(spark, rows, **how):
    return sorted((tuple(r) for r in pt.prefix_trie(df(spark, rows), **how).collect()), key=repr)


def test_equals_brute_force_with_and_without_shards(spark):
    rows = rows_of()
    want = brute(rows)
    assert run(spark, rows) == want
    assert run(spark, rows, min_heavy=3, queue_records=2) == want  # many shards, queues that spill
    assert run(spark, rows, min_heavy=0) == want  # every node but leaves' chains goes by the upper stream


def test_conversations_without_turns_are_members_of_the_root(spark):
    alone = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2][:3]
    rows = [(c, 0, "user", "x") for c in alone]
    got = run(spark, rows)
    assert got == brute(rows) and len(got) == 1
    assert got[0][:7] == (min(alone), 0, None, 3, 0, 1, 0)


def test_empty_and_null_ids(spark):
    assert run(spark, []) == [] and run(spark, [(None, 0, "user", "x")]) == []


def test_a_long_conversation_and_ids_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(pt, "IDS_A_CHUNK", 7)
    rows = [(0, t, "user", f"t{t % 3}") for t in range(700)] + [(5 * c, 0, "user", "hi") for c in range(1, 200)]
    assert run(spark, rows, queue_records=50) == brute(rows)


def test_queue_keeps_order_over_spills():
    rng = random.Random(1)
    records = [bytes([rng.randint(0, 40), rng.randint(0, 5), i % 256, i // 256]) for i in range(3000)]
    queue = pt.SpillingQueue(100, 4)
    for r in records:
        queue.push(r)
    assert queue.spills > 20
    out = [r for k in range(41) for r in queue.pop(bytes([k]))]
    assert sorted(out) == sorted(records) and [r[0] for r in out] == sorted(r[0] for r in records)
