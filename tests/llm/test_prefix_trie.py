"""The prefix trie against a dictionary of beginnings, with few ranges and many, nulls, ties, repeats and long conversations."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tallyloom.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, path string"


@pytest.mark.parametrize("seed", range(20))
def test_tree_holds_what_was_put_in(seed):
    rng, tree, want = random.Random(seed), trie.Tree(), {}
    letters = [1, 3, 5, 20, 60, 256][seed % 6]
    for _ in range(400):
        path = bytes(rng.randrange(letters) for _ in range(4 * rng.randint(0, 4)))
        want[path] = len(want)
        tree.insert(path, (path, want[path]))
    found, layouts, stack = [], set(), [(tree.root, b"")]
    while stack:
        node, path = stack.pop()
        path += node.prefix
        if node.value:
            assert node.value[0] == path
            found.append(node.value)
        kids = node.children()
        assert [k.prefix[0] for k in kids] == sorted({k.prefix[0] for k in kids}) and node.n == len(kids) and node.layout() >= node.n
        assert node.value or len(kids) > 1  # compressed: no place without a branch
        layouts.add(node.layout())
        stack += [(k, path) for k in kids]
    assert sorted(found) == sorted(want.items())
    assert letters < 256 or layouts >= {4, 256}


def brute(rows, rebuild=True):
    turns = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in turns.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        built[c] = own.get(c - int(abs(c) % 100) * (1 if c > 0 else -1), [])[:h] + v[h:]
    members = defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        kids[node[:-1]] += bool(node)
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), kids[node], leaves[node], saved[node],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(node)).encode()).hexdigest())
        for node, m in members.items()
    )


def conversations(seed, n=260):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-5, n), 10**12, 10**12 + 1]:
        if rng.random() < 0.1:
            continue  # some blocks lack their first conversation
        common = rng.random() < 0.4
        for turn in range(rng.choice([1, 2, 3, 4, 7]) if not common else 3):
            rows.append((c, turn, "user" if turn % 2 else None, "hello" if common and turn < 2 else rng.choice(["", None, "ä€𝄞", "yes", f"t{rng.randrange(9)}"]), 5, "x"))
    rows += [(50, None, "system", "first of all", 1, "y"), (51, 1, "user", "a tie", 1, "y"), rows[3], rows[3], (None, 1, "user", "nobody", 1, "y")]
    rows += [(77, k, "user", f"w{k % 3}", 1, "y") for k in range(10, 700)] + [(78, k, "user", f"w{k % 3}", 1, "y") for k in range(10, 699)]
    rng.shuffle(rows)
    return rows


def got(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


@pytest.mark.parametrize(("range_paths", "part_ids"), [(20_000, 4096), (40, 3), (3, 1)])
def test_trie_equals_brute_force(spark, monkeypatch, range_paths, part_ids):
    monkeypatch.setattr(trie, "RANGE_PATHS", range_paths)
    monkeypatch.setattr(trie, "PART_IDS", part_ids)
    rows = conversations(range_paths)
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(trie.prefix_trie(trie.with_shared_heads(trie.turns_of(table)))) == brute(rows)


def test_trie_of_plain_and_no_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "RANGE_PATHS", 2)
    rows = [(c, k, "user", str(k), 1, "x") for c in range(12) for k in range(c % 6)]
    table = spark.createDataFrame(rows, SCHEMA)
    assert got(trie.prefix_trie(trie.turns_of(table))) == brute(rows, rebuild=False)
    assert got(trie.prefix_trie(trie.with_shared_heads(trie.turns_of(table.limit(0))))) == []
    # a conversation with fewer turns than its head, in a block without a first one, has none left
    lone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(lone, 0, "user", "gone", 1, "x"), (300, 0, "user", "here", 1, "x")]
    assert got(trie.prefix_trie(trie.with_shared_heads(trie.turns_of(spark.createDataFrame(rows, SCHEMA))))) == brute(rows)
