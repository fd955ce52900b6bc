"""Text operators against brute force, with nulls, empty and long texts, ties, repeated rows and other columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import chaining, compression, decontaminate, html_blocks, line_join, lsh_forest, lstm, ordinal, packing, secrets, token_counts
from tallyloom.llm.components import components
from tallyloom.llm.pieces import load

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
BLANK = re.compile(r"[\x20\x09-\x0D]+")
WILD = ["", " ", "  a  b \n c", "foo <|endoftext|> bar", "x\n\n y z", "ß 你好 a’s it's I'LL 12 3²", "\x1c a　b \x85 c ", " lead", "trail ", "\t\ta b", "a\x1fb c_d", "É Ünḯcode ΣΑΣ"]


def prose(n: int, seed: int, words: int = 4000) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Rows with a null id, null, empty and very long texts, copies, repeated rows and columns of clashing names."""
    base = prose(60, 1)
    near = base.split()
    near[30] = "changed"
    texts = [None, "", base, base, " ".join(near), "short text", "Short  TEXT", prose(6000, 2), "again and again " * 40, *WILD, f"{prose(30, 3)}\n{prose(20, 4)}\n{prose(30, 3)}", f"{prose(20, 4)}\nother words stand here now"]
    rows = [(i, t, f"s{i % 3}" if i % 4 else None, 7, "x") for i, t in enumerate(texts)]
    rows += [(None, base, "s1", 7, "x"), (None, None, None, None, None), rows[7], rows[4]]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_tokens long, k1 string").cache()


def collected(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def same_rows(got, want):
    assert Counter(got) == Counter(want)


def test_token_counts(docs):
    tokenizer = load(BYTES)
    want = [(i, len((t or "").encode()), n := len(tokenizer.encode(t or "").ids), n > 1024) for i, t in collected(docs)]
    same_rows([tuple(r) for r in token_counts.token_counts(docs, BYTES).collect()], want)


def test_packing_round_trip(docs):
    tokenizer, size = load(WORDS), 64
    rows = packing.pack(docs, WORDS, size=size).collect()
    want = Counter()
    for i, t in collected(docs):
        want[i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()] += 1
    by_row, got = {}, Counter()
    for r in rows:
        by_row.setdefault(r.row_id, []).append(r)
    left = dict(want)
    for pieces in by_row.values():
        pieces.sort(key=lambda r: r.start)
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        match = next(key for key, n in left.items() if n and key[0] == pieces[0].doc_id and len(key[1]) == 4 * pieces[0].doc_tokens and all(zlib.crc32(key[1][4 * p.start : 4 * (p.start + p.length)]) == p.ids_crc32 for p in pieces))
        left[match] -= 1
        got[match] += 1
    assert got == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s, parts in sequences.items():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) == size or s == max(sequences)


@pytest.mark.parametrize("weights", [None, {"a": 5, "b": 2.5, "tiny": 0.05}])
def test_packing_keeps_the_mixture_of_each_sequence(spark, weights):
    size, names = 256, ["a"] * 12 + ["b"] * 5 + ["c"] * 2 + [None]
    rows = [(i, prose(random.Random(i).choice([3, 40, 700]), i), "tiny" if i % 150 == 0 else names[i % 20]) for i in range(600)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), WORDS, size=size, weights=weights).collect()
    total = Counter()
    by_sequence = {}
    for p in pieces:
        total[p.source] += p.length
        by_sequence.setdefault(p.sequence_id, Counter())[p.source] += p.length
    share = {s: (weights.get(s, 1.0) if weights else n) for s, n in total.items()}
    share = {s: w / sum(share.values()) for s, w in share.items()}
    dry = min(n / share[s] for s, n in total.items()) / size  # rounds until the first queue is empty
    assert dry > 20
    for sequence, found in by_sequence.items():
        if sequence < dry - 2:
            for s, part in share.items():
                own = part * size  # one slice more or less; two where a queue saves up for one
                assert abs(found[s] - own) <= max(own, 2 * packing.LEAST_SLICE - own) + 1, (sequence, s)


def test_packing_of_sources_without_weight(spark):
    rows = [(i, prose(60, i), "abc"[i % 3]) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = packing.pack(docs, WORDS, size=64, weights={"a": 0.0, "b": 2, "c": 1}).collect()
    assert len({p.row_id for p in pieces}) == 90
    last = max((p.sequence_id, p.offset) for p in pieces if p.source != "a")
    assert all((p.sequence_id, p.offset) > last for p in pieces if p.source == "a")
    assert {p.source for p in packing.pack(docs, WORDS, size=64, weights={"a": 0, "b": 0, "c": 0}).collect()} == set("abc")
    with pytest.raises(ValueError, match="negative"):
        packing.pack(docs, WORDS, weights={"a": -1})


def base_rules(text):
    words = [w for w in BLANK.split(text) if w]
    lines = [x for x in text.split("\n") if BLANK.sub("", x)]
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(k, k + 8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_compression_bands(spark, docs):
    rows = compression.quality_by_compression(docs).collect()
    same_rows([tuple(r)[:7] for r in rows], [(i, *base_rules(t or "")) for i, t in collected(docs)])
    assert not any(r.kept for r in rows if r.base_failed)
    noise = np.random.default_rng(1).choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"), 6000)
    noise = " ".join("".join(noise[k : k + 60]) for k in range(0, 6000, 60))
    rows = spark.createDataFrame([(1, noise), (2, "\n".join(f"row {k} of the same table" for k in range(900))), (3, prose(900, 5))], "doc_id long, text string")
    assert [r.kept for r in compression.quality_by_compression(rows).orderBy("doc_id").collect()] == [False, False, True]


def test_compression_bands_of_tails(spark):
    """A repetitive tail behind a normal first chunk, or before it."""
    rng = random.Random(8)
    normal = " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(1000))[:4096]
    rows = "\n".join(f"row {k} of the same table" for k in range(160))
    table = spark.createDataFrame([(1, f"{normal}\n{rows}"), (2, f"{rows}\n{normal}"), (3, normal + normal[::-1][:900]), (4, normal)], "doc_id long, text string")
    got = compression.quality_by_compression(table).orderBy("doc_id").collect()
    assert [(r.n_chunks, r.n_chunks_failed, r.kept) for r in got] == [(2, 1, False), (2, 1, False), (2, 0, True), (1, 0, True)]


def test_secret_scan(spark):
    texts = [None, "", "password = hunter22 and token:abc", "API-key", "api_key: 'ABCDEFG' apikey=zz/yy/xx", "AKIA" + "Z" * 15, "é AKIA" + "Z" * 16, "x" + "0a" * 12 + " " + "f" * 23, "passwd=ABCDEFé secret='token=abcdefg'", "sEcReT:  aaaaaa " * 3000]
    rows = spark.createDataFrame([*enumerate(texts), (None, texts[2]), (2, texts[6])], "doc_id long, text string").withColumn("rules", F.lit(1)).withColumn("spans", F.lit(2))
    got = [(r.doc_id, [(s.start, s.end, s.kind) for s in r.spans]) for r in secrets.secret_spans(rows).collect()]

    def brute(t):
        out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A) if len(m[2]) >= 6]
        out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
        return [(s, e, k) for s, _, e, k in sorted(out)]

    assert sorted(got, key=str) == sorted(((r.doc_id, brute(r.text or "")) for r in rows.collect()), key=str)
    assert secrets.trigram_query(r"[0-9a-f]{24,}") is None
    assert secrets.trigram_query("AKIA[A-Z]+") == [frozenset({"aki", "kia"})]
    assert {"pas", "ass", "ssw", "swo", "wor", "ord"} in [set(c) for c in secrets.trigram_query(secrets.RULES[0].regex)]


def lines_removed(rows):
    lines = [((i is None, i or 0, t), n, frozenset(w for w in BLANK.split(x) if w)) for i, t in rows if t is not None for n, x in enumerate(t.split("\n"))]
    lines = [x for x in lines if x[2]]
    return {(a[0][1] if not a[0][0] else None, a[1]) for a in lines for b in lines if (b[0], b[1]) < (a[0], a[1]) and 5 * len(a[2] & b[2]) >= 4 * len(a[2] | b[2])}


def test_line_join(spark):
    rng, rows = random.Random(3), []
    stock = [[f"v{rng.randrange(300)}" for _ in range(rng.randint(1, 30))] for _ in range(60)]
    for i in range(80):
        lines = []
        for _ in range(rng.randint(1, 4)):
            words = list(rng.choice(stock))
            for _ in range(rng.choice((0, 0, 1, 2))):
                words[rng.randrange(len(words))] = f"v{rng.randrange(300)}"
            lines.append(" ".join(words))
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "a b c d e f " * 3000)]
    rows += [(104, "Menu\nto be or\none two three four"), (105, "Menu\nor  be to\nto be\nfive one two three four"), (106, "Menu\n \nto be or not\nfive one two four three six")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("removed", F.lit("own"))
    got = line_join.without_removed(table).collect()
    assert {(r.doc_id, n) for r in got for n in r.removed} == lines_removed(rows)
    texts = dict(rows)
    for r in got:
        t = texts[r.doc_id]
        assert r.kept_text == (t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in r.removed))


def groups_of(rows, share):
    def shingled(t):
        w = [x for x in BLANK.split((t or "").translate({c: c + 32 for c in range(65, 91)})) if x]
        return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()

    sets = [shingled(t) for _, t in rows]
    owner = list(range(len(rows)))

    def top(k):
        return k if owner[k] == k else top(owner[k])

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b]):
            owner[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return [(i, len(s), least.get(top(k))) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))]


def test_near_duplicates(spark, docs):
    rows = collected(docs)
    rng = random.Random(5)
    for g in range(12):
        words = prose(rng.randint(80, 300), 100 + g).split()
        for _ in range(30 if g == 0 else 4):
            words = list(words)
            words[rng.randrange(len(words))] = f"n{rng.random()}"
            rows.append((len(rows) + 1000, " ".join(words)))
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component", F.lit("own"))
    got = lsh_forest.near_duplicates(table).select("doc_id", "n_shingles", "component_id").collect()
    same_rows([tuple(r) for r in got], groups_of(rows, 85))
    kept = lsh_forest.one_of_each(table, 85)
    assert kept.columns == table.columns
    ids = [r.doc_id for r in kept.where("text IS NOT NULL").collect()]
    want = {c for i, n, c in groups_of(rows, 85) if n}
    assert {i for i, n, c in groups_of(rows, 85) if n and i in ids} == want and len([i for i in ids if i in want]) == len(want)


@pytest.mark.parametrize(("copies", "place"), [(10, 0), (300, 150), (2000, 2000)])
def test_near_duplicates_of_a_star(spark, copies, place):
    """Copies that are near the original, wherever it stands, but not near each other."""
    base, rows = prose(200, 900).split(), []
    for k in range(copies):
        words, rng = list(base), random.Random(k)
        for j in range(3):
            words[5 + 65 * j + rng.randrange(55)] = f"c{k}-{j}"
        rows.append((k, " ".join(words)))
    rows.insert(place, (copies, " ".join(base)))
    rows += [(9000 + k, prose(120, 3000 + k)) for k in range(20)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(table).collect()}
    assert got == {i: 0 if i <= copies else i for i, _ in rows}


@pytest.mark.parametrize("region", [lsh_forest.REGION, 6])
def test_forest_alone_joins_nine_of_ten(spark, monkeypatch, region):
    """Without the exact join: of the steps that brute force takes to put groups together, nine of ten are found.

    Small regions divide nearly all beginnings, down to whole labels."""
    monkeypatch.setattr(lsh_forest, "REGION", region)
    rng, rows = random.Random(9), []
    for g in range(40):
        base = prose(150, 5000 + g).split()
        for _ in range(60 if g < 2 else 6):
            words = list(base)
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = f"n{rng.random()}"
            rows.append((len(rows), " ".join(words)))
    rows += [(5000 + k, prose(120, 7000 + k)) for k in range(60)]
    signed = lsh_forest.signed(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    least = signed.groupBy("k1", "k2").agg(F.min("row_id").alias("node"))
    nodes = signed.select(F.col("row_id").alias("node"), "sig", "text").join(least.select("node"), "node", "left_semi")
    found = [tuple(r) for r in lsh_forest.forest_links(nodes, signed, 85).collect()]
    ids = {r.row_id: r.doc_id for r in signed.select("row_id", "doc_id").collect()}
    same = {i: c for i, _, c in groups_of(rows, 85)}
    assert all(same[ids[a]] == same[ids[b]] for a, b in found)
    top = {n: n for n in (r.node for r in nodes.select("node").collect())}
    wanted = len(top) - len({same[ids[n]] for n in top})

    def root(n):
        while top[n] != n:
            n = top[n]
        return n

    joined = 0
    for a, b in found:
        a, b = root(a), root(b)
        if a != b:
            top[a], joined = b, joined + 1
    print(f"forest alone, regions of {region}: {joined} of {wanted}")
    assert 10 * joined >= 9 * wanted > 0


def test_neighbours_share_the_longest_prefixes(spark):
    """A node's partners: the next on either side, and up to SIDE that share its longest prefix."""
    label = lambda *values: b"".join(v.to_bytes(2, "big") for v in values)
    labels = [label(1, 1, 1, 1, 5, k) for k in (1, 2, 3)] + [label(1, 1, 1, 1, 9, 9)] + [label(1, 1, 1, 1, 12, k) for k in (7, 7, 7)]
    rows = [(0, label(1, 1, 1, 1), 0, x, n, None) for n, x in enumerate(labels)]
    found = spark.createDataFrame(rows, "tree int, shared binary, block int, label binary, node long, pivot long")
    got = {(r.a, r.b): r.step for r in lsh_forest.candidate_pairs(found).collect()}
    inside = {frozenset(p) for g in ((0, 1, 2), (4, 5, 6)) for p in combinations(g, 2)}
    pairs = {frozenset(p) for p in got}
    assert inside <= pairs and {p for p, step in got.items() if step == 1} >= {(0, 1), (1, 2), (2, 3)}
    # node 3 shares four values with all: whoever has longer ones isn't reached past its own kind
    assert all(3 in p or len(p & {0, 1, 2}) != 1 for p in pairs)


def test_clashing_names(spark):
    """Columns named like the operators' own stay as they are and change nothing."""
    rows = [(1, f"{prose(40, 1)}\none line of six words here"), (2, f"{prose(40, 1)}\none line of six words here"), (2, f"{prose(40, 1)}\none line of six words here"), (3, prose(30, 2)), (None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    own = ("_id", "_h", "_h1", "_h2", "_again", "_k1", "_k2", "row")
    more = table.select("*", *[F.lit(f"own {c}").alias(c) for c in own])
    bench = spark.createDataFrame([(1, prose(30, 2))], "item_id long, text string")
    for operator in (line_join.without_removed, lsh_forest.one_of_each, lambda t: decontaminate.without_contaminated(t, bench)):
        plain, got = operator(table), operator(more)
        assert set(got.columns) == {*plain.columns, *own}
        same_rows([str(r) for r in got.select(*plain.columns).collect()], [str(r) for r in plain.collect()])
        assert all(r[c] == f"own {c}" for r in got.select(*own).collect() for c in own)


def test_line_stage_keeps_own_columns(spark):
    """The pipeline's line stage: columns named like the operator's stay; n_chars follows the text."""
    import corpus_pipeline

    line = "one line of six words here"
    rows = [(1, f"{prose(9, 1)}\n{line}"), (2, f"{prose(9, 2)}\n{line}"), (3, line), (4, None), (5, ""), (6, "\n")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    own = ("removed", "n_lines", "kept_text", "others", "_id", "_h")
    more = table.select(*[F.concat(F.lit(f"{c} of "), "doc_id").alias(c) for c in own], "doc_id", "text", F.length("text").alias("n_chars"))
    got = corpus_pipeline.without_repeated_lines(spark, more, "")
    assert got.columns == more.columns and dict(got.dtypes) == dict(more.dtypes)
    found = {r.doc_id: r for r in got.collect()}
    assert {i: r.text for i, r in found.items()} == {1: rows[0][1], 2: prose(9, 2), 4: None, 5: "", 6: "\n"}
    assert all(r[c] == f"{c} of {i}" for i, r in found.items() for c in own)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in found.values())
    plain = corpus_pipeline.without_repeated_lines(spark, table, "")
    assert {r.doc_id: r.text for r in plain.collect()} == {i: r.text for i, r in found.items()}
    assert corpus_pipeline.without_repeated_lines(spark, more.limit(0), "").count() == 0


def test_components(spark):
    chain = [(k + 1, k) for k in range(50)] + [(100, 101), (101, 102), (200, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert got == {k: 0 for k in range(1, 51)} | {101: 100, 102: 100}


def test_passages(spark):
    shared, fuzzy = prose(70, 11), prose(80, 12).split()
    other = list(fuzzy)
    other[20], other[50] = "one", "two"
    del other[35]
    rows = [(1, f"{prose(90, 1)} {shared} {prose(40, 2)}"), (2, f"{prose(10, 3)} {shared} {prose(70, 4)}"), (3, prose(30, 5) + " " + " ".join(fuzzy)), (4, " ".join(other) + " " + prose(200, 6)), (5, prose(300, 7)), (6, f"{prose(60, 8)} {prose(40, 9)}"), (7, f"{prose(40, 9)} {prose(60, 10)}"), (8, None), (9, ""), (10, prose(60, 13)), (11, prose(60, 13)), (None, prose(300, 7))]
    got = [tuple(r) for r in chaining.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    spans = {r[0]: r[1:] for r in got}
    assert set(spans) == {1, 2, 3, 4, 5, 10, 11, None}
    assert spans[1][:2] == (90, 160) and spans[2][:2] == (10, 80) and spans[1][5] == 70
    assert spans[3][:2] == (30, 110) and spans[4][:2] == (0, 79) and spans[3][5] == 77


def test_chains_follow_the_best_order():
    rng = random.Random(1)
    for _ in range(20):
        n = rng.randint(1, 8)
        a, b = [8 * rng.randrange(8) for _ in range(n)], [8 * rng.randrange(8) for _ in range(n)]

        def score(chain):
            total = chaining.K
            for j, i in zip(chain, chain[1:], strict=False):
                if a[i] <= a[j] or b[i] <= b[j]:
                    return -1
                total += min(chaining.K, a[i] - a[j], b[i] - b[j]) - chaining.GAP_COST * (a[i] - a[j] + b[i] - b[j])
            return total

        best = max(score(sorted(c, key=lambda i: (b[i], a[i]))) for k in range(1, n + 1) for c in combinations(range(n), k))
        assert abs(score(chaining.chains(a, b)[0]) - best) < 1e-9


def test_passages_with_many_changed_words(spark):
    """Seven equal words in a row at most, changed words at both ends of what the seeds cover."""
    base = prose(80, 31).split()
    other = [f"n{k}" if k % 8 == 7 and k < 79 else w for k, w in enumerate(base)]
    table = spark.createDataFrame([(1, f"{prose(50, 32)} {' '.join(base)} {prose(20, 33)}"), (2, f"{' '.join(other)} {prose(90, 34)}")], "doc_id long, text string")
    got = {r.doc_id: (r.start, r.end, r.n_equal) for r in chaining.passages(table).collect()}
    assert got == {1: (50, 130, 71), 2: (0, 80, 71)}


def test_passages_held_twice(spark):
    """Each place of a passage is listed, whichever of the texts is the first by hash."""
    for seed in range(41, 45):
        shared = prose(70, seed)
        rows = [(1, f"{prose(20, seed + 10)} {shared} {prose(30, seed + 20)}"), (2, f"{shared} {prose(130, seed + 30)} {shared} {prose(9, seed + 40)}")]
        got = {(r.doc_id, r.start, r.end) for r in chaining.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == {(1, 20, 90), (2, 0, 70), (2, 200, 270)}


@pytest.mark.parametrize("holders", [12, 40])
def test_passages_of_pieces_with_other_first_holders(spark, holders):
    """Two texts share 60 words whose halves are in other texts, too, few or many: they are linked all the same."""
    for seed in (100, 200):
        left, right = prose(30, seed), prose(30, seed + 1)
        rows = [(k, f"{prose(40, seed + 2 + k)} {half} {prose(20, seed + 3000 + k)}") for k in range(2 * holders) for half in [(left, right)[k % 2]]]
        rows += [(1000 + k, f"{prose(20 + k, seed + 5000 + k)} {left} {right} {prose(30, seed + 6000 + k)}") for k in range(2)]
        got = {(r.doc_id, r.start, r.end, r.other_id) for r in chaining.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == {(1000, 20, 80, 1001), (1001, 21, 81, 1000)}


def test_chains_after_a_long_chain():
    """A second passage of two texts is linked, however well an earlier one ended."""
    at = [*range(0, 201, 4), *range(700, 761, 4)]
    assert sorted(map(len, chaining.chains(at, at))) == [16, 51]


@pytest.mark.parametrize("piece", [7, 1 << 20])
def test_words_and_their_hashes(monkeypatch, piece):
    """Runs of other than white space, wherever a long text is cut; equal words, and no others, have equal hashes."""
    monkeypatch.setattr(chaining, "PIECE", piece)
    known = {}
    for text in [*WILD, prose(900, 4), " ", "\n\t ", "a", "x" * 70_000 + " y " + "z" * 5, "aB cd\n" * 30_000]:
        words, hashes = text.encode().lower().split(), chaining.words_of(text.encode())
        assert len(words) == len(hashes)
        assert all(known.setdefault(w, h) == h for w, h in zip(words, hashes.tolist(), strict=True))
    assert len(set(known.values())) == len(known)


def test_least_values_of_windows():
    rng = np.random.default_rng(2)
    for n in range(1, 40):
        h = rng.integers(0, rng.choice([3, 1 << 60]), n).astype(np.uint64)
        for width in range(1, min(9, n + 1)):
            want = sorted({start + int(h[start : start + width].argmin()) for start in range(n - width + 1)})
            assert chaining._least_of_windows(h, width).tolist() == want


def test_chains_against_all_pairs():
    """The best chain scores what a search over all pairs of anchors finds, also where texts repeat themselves."""
    k, cost, reach = chaining.K, chaining.GAP_COST, chaining.LONGEST_GAP + chaining.K

    def gain(da, db):
        return min(k, da, db) - cost * (da + db)

    rng = random.Random(3)
    for trial in range(300):
        size, points = rng.choice([20, 100, 300, 1000]), set()
        while len(points) < 1 + trial % 110:
            x, y = rng.randrange(size), rng.randrange(size)
            for _ in range(rng.randint(1, 20)):
                x, y = x + rng.randint(1, 5), y + rng.randint(1, 5)
                points.add((x, y))
        a, b = zip(*rng.sample(sorted(points), len(points)), strict=True)
        score = {}
        for i in sorted(range(len(a)), key=lambda i: (b[i], a[i])):
            near = [j for j in score if 0 < b[i] - b[j] <= reach and 0 < a[i] - a[j] <= reach]
            score[i] = max([k, *(score[j] + gain(a[i] - a[j], b[i] - b[j]) for j in near)])
        found = chaining.chains(list(a), list(b))
        assert sorted(i for chain in found for i in chain) == list(range(len(a)))
        steps = [(a[j] - a[i], b[j] - b[i]) for i, j in zip(found[0], found[0][1:], strict=False)]
        assert all(0 < da <= reach and 0 < db <= reach for da, db in steps)
        assert abs(k + sum(gain(*d) for d in steps) - max(score.values())) < 1e-6


def test_contamination(spark):
    item, short = prose(40, 21), "six words make this item whole"
    swapped = item.upper().split()
    for k in (9, 20, 29):
        swapped[k] = "other"
    rows = [(1, f"{prose(50, 1)} {item} {prose(9, 2)}"), (2, f"{prose(50, 3)} {' '.join(swapped)}."), (3, prose(90, 4)), (4, " ".join(item.split()[:10]) + " " + prose(50, 5)), (5, None), (6, ""), (7, f"x {short} y"), (8, f"{prose(20, 6)} {item}"), (8, f"{prose(20, 7)}"), (None, item)]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("k1", F.lit("own")).withColumn("words", F.lit(1))
    bench = spark.createDataFrame([(1, item), (2, short), (3, None), (4, ""), (5, item)], "item_id long, text string")
    got = sorted(((r.doc_id or 0, r.contaminated, tuple(r.item_ids)) for r in decontaminate.contamination(table, bench).collect()))
    assert got == [(0, True, (1, 5)), (1, True, (1, 5)), (2, True, (1, 5)), (3, False, ()), (4, False, ()), (5, False, ()), (6, False, ()), (7, True, (2,)), (8, False, ()), (8, True, (1, 5))]
    kept = decontaminate.without_contaminated(table, bench)
    assert kept.columns == table.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 8]
    assert not any(r.contaminated for r in decontaminate.contamination(table, bench.limit(0)).collect())


def overlaps_within_limits():
    """(n, changed places) of all overlaps of 13 to 24 words with as many changed as the limits allow.

    Longer ones hold one of these: cut into parts of 16 to 24 words, one part has the share
    and so 13 equal words, also without changed words at its ends."""
    for n in range(decontaminate.LEAST_WORDS, 25):
        yield from ((n, s) for s in combinations(range(1, n - 1), min(n - decontaminate.LEAST_WORDS, n // 5)))


def test_masks_hit_all_overlaps():
    windows = {n: [sum(1 << i + p for p in m) for m in decontaminate.MASKS for i in range(n - m[-1])] for n in range(13, 25)}
    for n, changed in overlaps_within_limits():
        places = sum(1 << i for i in changed)
        assert any(not w & places for w in windows[n]), (n, changed)


def test_contamination_of_short_overlaps(spark):
    bench = [(n, prose(n, 500 + n)) for n in (16, 20, 24)]
    rows = []
    for n, item in bench:
        cases = [s for m, s in overlaps_within_limits() if m == n]
        for changed in random.Random(n).sample(cases, min(200, len(cases))):
            words = item.split()
            for k in changed:
                words[k] = f"new{k}"
            rows.append((n, f"{prose(20, 20000 + len(rows))} {' '.join(words)} {prose(20, 40000 + len(rows))}"))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = decontaminate.contamination(table, spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert len(got) == len(rows) and all(r.item_ids == [r.doc_id] for r in got)


def test_ordinal_grades(spark):
    rng, rows, grades = random.Random(2), [], []
    for i in range(900):
        grade = i % 3
        words = prose(rng.randint(20, 60), i, 500).split()
        if grade < 2:
            words[rng.randrange(len(words))] = ("vile", "dull")[grade] + rng.choice("abc")
            words[0] = ("vile", "dull")[grade] + "x"
        rows.append((i, " ".join(words)))
        grades.append((i, grade))
    table = spark.createDataFrame([*rows, (None, None), (5000, "")], "doc_id long, text string").withColumn("kept", F.lit("own"))
    ratings = spark.createDataFrame([*grades[:600], (5000, None), (None, 1), (0, 2)], "doc_id long, grade int")
    model = ordinal.fit_on_table(table, ratings)
    assert model.thresholds[0] < model.thresholds[1]
    held = [r for r in ordinal.graded(table, model).collect() if r.doc_id is not None and 600 <= r.doc_id < 900]
    assert np.mean([round(r.expected_grade) == r.doc_id % 3 for r in held]) > 0.95
    kept = ordinal.select_kept(table, model)
    assert kept.columns == table.columns
    assert ordinal.graded(table, None).where("NOT kept").count() == 0
    assert ordinal.fit_on_table(table, ratings.limit(0)) is None


def test_lstm_gradient():
    rng = np.random.default_rng(4)
    x = [rng.normal(size=(n, 3)) for n in (4, 7, 2)]
    y = [rng.integers(0, 2, len(s)) for s in x]
    y = [(np.cumsum(s[:, 0]) > 0).astype(int) for s in x * 20]
    w = lstm.train(x * 20, y, epochs=60)
    padded, mask = lstm.padded(x)
    got = lstm.probabilities(w, padded, mask) > 0.5
    assert np.mean([(got[: len(s), i] == y[i]).mean() for i, s in enumerate(x)]) > 0.95


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News &amp; more</a></li></ul></nav><div class="ad">Buy this now.</div>
<article><h1>A  title</h1><p><b>First&nbsp;line of the story, with some words.<br><p>Second &lt;line&gt; goes
on and on for a while.</article><!-- no --><footer>&copy; 2020 nobody</footer></body></html>"""


def test_html_blocks(spark):
    rows = [(1, "u", PAGE), (2, "u", None), (3, None, ""), (None, "u", PAGE), (4, "u", "<p>" * 3), (1, "u", PAGE)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("own"))
    more = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    weights = html_blocks.fit(more)
    got = [(r.page_id, r.text, r.n_chars) for r in html_blocks.main_text(pages, weights).collect()]
    text = "A title\nFirst line of the story, with some words.\nSecond <line> goes on and on for a while."
    same_rows(got, [(1, text, len(text)), (2, "", 0), (3, "", 0), (None, text, len(text)), (4, "", 0), (1, text, len(text))])
    rng = random.Random(77)
    pool = [prose(n, n) for n in range(20, 60)]
    made = [p for p in (html_blocks.made_page(pool, rng) for _ in range(80)) if p]
    x, mask = lstm.padded([html_blocks.vectors([b[:3] for b in p], html_blocks.Vectors()) for p in made])
    good = lstm.probabilities(weights, x, mask) > 0.5
    assert np.mean([g == b[3] for n, p in enumerate(made) for g, b in zip(good[:, n], p, strict=False)]) > 0.93


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<html><head><title>x</title><p>text", ["text"]),
        ("<html><head><title>x</title><meta charset=a><div>a<article><p>b c</p></article></div>", ["a", "b c"]),
        ("<head><title>x</title>plain words<p>z", ["plain words", "z"]),
        ("<title>x</title><p>text", ["text"]),
        ("<head><script>'<p>no</p>'</script><style>p{}</style></head><body><p>yes", ["yes"]),
        ("<body><p>one</p><svg><path d=1><text>label</text><p>two</p><section>three</section>", ["one", "two", "three"]),
        ("<body><svg><foreignObject><div>in</div></foreignObject></svg><p>two</p>", ["two"]),
        ("<body><math><mi>x</mi><svg><g><p>after both", ["after both"]),
        ("<div><svg><text>label</text></div><p>after</p>", ["after"]),
    ],
)
def test_ends_that_a_page_leaves_out(html, want):
    assert [b[1] for b in html_blocks.blocks_of(html)] == want


def test_all_words_of_a_block_count():
    """Blocks that differ in one middle word only have different vectors; very long ones stay in scale."""
    words = prose(60, 3).split()
    other = [*words[:30], "advert", *words[31:]]
    path = (("body", ()), ("p", ()))
    long = " ".join(f"w{k}" for k in range(60_000))
    x, y, z = html_blocks.vectors([(path, " ".join(words), 0), (path, " ".join(other), 0), (path, long, 0)], html_blocks.Vectors())
    assert np.abs(x - y).max() > 0.01 and np.isfinite(z).all() and np.abs(z).max() < 6
    summed = sum(html_blocks.Words.table[html_blocks.Words()[w]] for w in words)
    assert np.allclose(x[96:120], summed * 0.5 / 60**0.5)


def test_html_blocks_without_names(spark):
    """On layouts whose names and landmark elements are neutral, the labels come from words, places and neighbours."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    weights = html_blocks.fit(pages)
    rng, pool = random.Random(5), [b[1] for r in pages.collect() for b in html_blocks.blocks_of(r.html)]
    landmarks = {*html_blocks.APART, "article", "main", "section"}
    bare = []
    for _ in range(80):
        page = html_blocks.made_page(pool, rng)
        bare.append([(tuple(("div" if t in landmarks else t, ()) for t, _ in path), *rest) for path, *rest in page])
    bare = [p for p in bare if p]

    def right(pages):
        x, mask = lstm.padded([html_blocks.vectors([b[:3] for b in p], html_blocks.Vectors()) for p in pages])
        good = lstm.probabilities(weights, x, mask) > 0.5
        return np.mean([g == b[3] for n, p in enumerate(pages) for g, b in zip(good[:, n], p, strict=False)])

    usual = np.mean([b[3] for p in bare for b in p])
    assert right(bare) > max(usual, 1 - usual) + 0.1
    assert right(bare) > right([[b] for p in bare for b in p])  # each block by itself


def test_long_pages_are_labelled_whole(spark):
    paragraphs = "".join(f"<p>Paragraph {k} tells a part of the long story, and it goes on.</p>" for k in range(3000))
    html = f"<html><body><nav><ul><li><a href=a>Home</a></li></ul></nav><article>{paragraphs}</article><footer>Imprint</footer></body></html>"
    weights = html_blocks.fit(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    row = html_blocks.main_text(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string"), weights).first()
    assert row.text.split("\n") == [f"Paragraph {k} tells a part of the long story, and it goes on." for k in range(3000)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert token_counts.token_counts(none, BYTES).count() == 0
    assert packing.pack(none, WORDS).count() == 0
    assert compression.quality_by_compression(none).count() == 0
    assert secrets.secret_spans(none).count() == 0
    assert line_join.without_removed(none).count() == 0
    assert lsh_forest.near_duplicates(none).count() == 0
    assert lsh_forest.one_of_each(none).count() == 0
    assert chaining.passages(none).count() == 0
    assert decontaminate.contamination(none, none.withColumnRenamed("doc_id", "item_id")).count() == 0
    assert ordinal.graded(none, None).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_blocks.main_text(pages, html_blocks.fit(pages, made=20)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert rows.count() > 0
    assert hashlib.sha256(b"").hexdigest() == secrets.op2_secret_scan(spark, "/root/testdata/sf0.001").where("n_assign + n_access + n_hex = 0").first().base_sha256


def test_all_nodes_are_counted_for_the_order_of_shingles(spark):
    nodes = [(k, prose(8 + k % 5, 700 + k % 9)) for k in range(40)]
    want = np.zeros(lsh_forest.CLASSES, np.int64)
    for _, text in nodes:
        np.add.at(want, lsh_forest._classes(lsh_forest.shingles(text.encode(), lsh_forest.WordHashes())), 1)
    got = lsh_forest.class_counts(spark.createDataFrame(nodes, "node long, text string"))
    assert (got == np.where(want > 1, want, 0)).all()


def test_shuffles_of_scratch_tables_are_deleted(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from tallyloom.llm.common import CLEANUP, written

    seen, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: (seen.append(spark.conf.get(CLEANUP)), write(self, path)))
    before = spark.conf.get(CLEANUP)
    assert written(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "few").count() == 7
    assert seen == ["true"] and spark.conf.get(CLEANUP) == before


def test_parities_part_unlike_lines_before_they_are_written(spark, monkeypatch):
    rng = np.random.default_rng(7)
    names = np.array([f"w{k}" for k in range(3000)])
    lines, texts_ = [], []
    for n in [*range(4, 44), 60, 120, 300]:
        line = rng.choice(names, n, replace=False)
        other = line.copy()
        other[: n // 10] = rng.choice(names, n // 10, replace=False)
        lines += [line, other]
    common = ["rare1", "rare2"]  # unlike lines that share what they are joined on
    lines += [np.array([*common, *rng.choice(names, 30, replace=False)]) for _ in range(12)]
    texts_ = [(k, " ".join(line)) for k, line in enumerate(lines)]
    docs = spark.createDataFrame(texts_, "doc_id long, text string")
    sets, written_pairs = [set(x) for x in lines], []
    want = {k for k in range(len(sets)) if any(9 * len(sets[k] & sets[j]) >= 4 * (len(sets[k]) + len(sets[j])) for j in range(k))}
    keep = line_join.written
    monkeypatch.setattr(line_join, "written", lambda df, name: (out := keep(df, name), written_pairs.append(out.count()) if name == "line-pairs" else None)[0])
    assert {r.doc_id for r in line_join.removed_lines(docs).collect()} == want and len(want) >= 30
    assert written_pairs[0] < 60, written_pairs  # the twelve make 66 pairs alone


def test_of_alike_lines_the_earliest_is_compared_first(spark, monkeypatch):
    """Thirty lines with one word changed each make 435 pairs; 29 are joined with their words, and the rest isn't needed."""
    base = [f"w{k}" for k in range(30)]
    rows = [(k, " ".join([*base[:k], f"n{k}", *base[k + 1 :]])) for k in range(30)]
    rows += [(30, " ".join(base[:24])), (31, " ".join([*base[:22], "x1", "x2"]))]
    keep, counts = line_join.written, {}
    monkeypatch.setattr(line_join, "written", lambda df, name: (out := keep(df, name), counts.setdefault(name, out.count()))[0])
    got = {(r.doc_id, r.line_no) for r in line_join.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == lines_removed(rows) and len(got) >= 30
    assert counts["line-earliest"] <= 31 < 435 <= counts["line-partners"], counts


def test_common_words_are_no_keys_of_their_own(spark, monkeypatch):
    """Unlike lines that share their rarest word aren't compared with each other where it stands in many texts; all similar ones are found."""
    rng, lines = np.random.default_rng(9), []
    names = np.array([f"w{k}" for k in range(400)])
    for n in [*range(4, 60), 100, 150]:
        line = rng.choice(names, n, replace=False)
        other = line.copy()
        other[: n // 10] = rng.choice(names, n // 10, replace=False)
        lines += [line, other, rng.permutation(line)[: n - n // 5], np.array([*line, *(f"x{n}y{k}" for k in range(n // 4))])]
    lines += [np.array(["one", *rng.choice(names, 40, replace=False)]) for _ in range(200)]
    docs = spark.createDataFrame([(k, " ".join(line)) for k, line in enumerate(lines)], "doc_id long, text string")
    sets, postings = [set(x) for x in lines], []
    want = {k for k in range(len(sets)) if any(9 * len(sets[k] & sets[j]) >= 4 * (len(sets[k]) + len(sets[j])) for j in range(k))}
    join = line_join.similar
    monkeypatch.setattr(line_join, "similar", lambda rows: (postings.append(rows.groupBy("key").count().agg(F.max("count")).first()[0] or 0), join(rows))[1])
    for rare in (0, 1 << 20):
        monkeypatch.setattr(line_join, "RARE", rare)
        assert {r.doc_id for r in line_join.removed_lines(docs).collect()} == want and len(want) >= 150, rare
    assert max(postings[: line_join.PASSES]) < 20 < max(postings[-line_join.PASSES :]), postings


def test_parities_differ_in_at_most_the_words_of_one_side(spark):
    rng = np.random.default_rng(8)
    rows = []
    for n in (1, 5, 40, 400):
        a = rng.integers(0, 1 << 62, n).tolist()
        rows.append((a, a[n // 3 :] + rng.integers(0, 1 << 62, n // 4).tolist()))
    found = spark.createDataFrame(rows, "a array<long>, b array<long>").select("a", "b", line_join.parities(F.col("a")).alias("x"), line_join.parities(F.col("b")).alias("y"))
    for r in found.collect():
        odd = lambda codes: sum((1 << k) for k in range(128) if sum(c & 127 == k for c in codes) % 2)
        assert [r.x.low % 2**64 + (r.x.high % 2**64 << 64), r.y.low % 2**64 + (r.y.high % 2**64 << 64)] == [odd(r.a), odd(r.b)]
        assert (odd(r.a) ^ odd(r.b)).bit_count() <= len(set(r.a) ^ set(r.b))


def test_batches_of_texts_are_small(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from tallyloom.llm import common

    seen, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: (seen.append(int(spark.conf.get(common.ROWS_A_BATCH))), write(self, path)))
    before = spark.conf.get(common.ROWS_A_BATCH)
    docs = spark.createDataFrame([(k, prose(8, k)) for k in range(30)], "doc_id long, text string")
    lsh_forest.signed(docs)
    lsh_forest.prefixes(docs.select(F.col("doc_id").alias("node"), "text"), 85)
    assert seen[:2] == [common.FEW_ROWS] * 2
    seen.clear()
    for own, want in (("7", 7), ("0", common.FEW_ROWS)):
        spark.conf.set(common.ROWS_A_BATCH, own)
        try:
            common.written(spark.range(3), "few", common.FEW_ROWS)
            assert seen[-1] == want and spark.conf.get(common.ROWS_A_BATCH) == own
        finally:
            spark.conf.set(common.ROWS_A_BATCH, before)


def test_packing_holds_few_texts_and_pieces(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from tallyloom.llm import common, ids

    seen, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: (seen.append(int(spark.conf.get(common.ROWS_A_BATCH))), write(self, path)))
    docs = spark.createDataFrame([(k, "web", prose(8, k)) for k in range(30)], "doc_id long, source string, text string")
    packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    assert seen[0] == 2 * common.FEW_ROWS and ids.PIECES_KEPT <= 700_000
