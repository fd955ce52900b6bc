"""Best-fit packing against packing piece by piece, with nulls, empty and long texts, repeated rows and other columns."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from tallyloom.llm import best_fit
from tallyloom.llm.ids import Ids
from tallyloom.llm.pieces import load

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
WILD = ["", " ", "  a  b \n c", "foo <|endoftext|> bar", "<|STARTOFTEXT|> A", "x\n\n y z", "ß 你好 a’s it's I'LL 12 3²", "\x1c a　b \x85 c ", "\t\ta b", "a\x1fb c_d", "É Ünḯcode. ΣΑΣ, é!", "trail "]


@pytest.mark.parametrize(("path", "folds"), [(BYTES, False), (WORDS, True)])
def test_ids_equal_the_tokenizer(path, folds, monkeypatch):
    rng, marks = random.Random(5), "abABIİK 1.,'s\n\t  é×　你\x1c\x85́Σ​‰”"
    texts = [None, *WILD, *("".join(rng.choice(marks) for _ in range(rng.randint(0, 14))) for _ in range(20_000)), "word. " * 30_000]
    want = [e.ids for e in load(path).encode_batch_fast([x or "" for x in texts], add_special_tokens=False)]
    for kept in (1_000_000, 500):  # a memo that is emptied again and again changes nothing
        monkeypatch.setattr("tallyloom.llm.ids.PIECES_KEPT", kept)
        monkeypatch.setattr("tallyloom.llm.ids.SLICE_BYTES", 20_000)
        got = []
        for ids, lengths in Ids(path, folds)(pa.array(["skipped", *texts]).slice(1)):
            got += [list(x) for x in np.split(ids, np.cumsum(lengths)[:-1])]
        assert got == want
    assert list(Ids(path)(pa.array([], pa.string()))) == []


def one_by_one(lengths, size):
    """How many sequences best-fit decreasing fills to each length: ties between equal rooms don't change it."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fitting = [b for b in bins if size - sum(b) >= n]
        if fitting:
            min(fitting, key=lambda b: size - sum(b)).append(n)
        else:
            bins.append([n])
    return Counter(map(sum, bins))


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_packing_one_by_one(seed):
    rng = random.Random(seed)
    size = rng.choice([1, 7, 16, 50, 64])
    lengths = [min(size, max(1, int(rng.paretovariate(0.7)))) if seed % 2 else rng.randint(1, size) for _ in range(rng.randint(0, 300))]
    runs, used = best_fit.best_fit_decreasing(Counter(lengths), size)
    bins, ends = {}, {}
    for length, rank, *_ in runs.tolist():
        ends.setdefault(length, []).append(rank)
    for length, rank, sequence, each, offset in runs.tolist():
        later = [x for x in ends[length] if x > rank]
        for k in range(rank, min(later) if later else Counter(lengths)[length]):
            at, beside = divmod(k - rank, each)
            bins.setdefault(sequence + at, []).append((offset + beside * length, length))
    assert sorted(bins) == list(range(used))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
    assert Counter(sum(n for _, n in parts) for parts in bins.values()) == one_by_one(lengths, size)


def test_work_depends_on_lengths_not_on_pieces():
    few, _ = best_fit.best_fit_decreasing({n: 3 for n in range(1, 2049)}, 2048)
    many, _ = best_fit.best_fit_decreasing({n: 3_000_000_007 * n for n in range(1, 2049)}, 2048)
    assert len(few) < 10_000 and len(many) < 100_000


def test_packing_is_an_exact_round_trip(spark):
    rng = random.Random(3)
    texts = [None, *WILD, *(" ".join(rng.choices(["the", "cat", "sat", "é.", "x1"], k=rng.randint(1, 90))) for _ in range(200)), "long words " * 9000]
    rows = [(i, t, "x", i, 0, 1) for i, t in enumerate(texts)] + [(None, "no key", "x", 1, 1, 1), (5, texts[5], "x", 5, 0, 1), (5, texts[5], "x", 5, 0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string, rank int, row_id int, chunk int").repartition(5)
    size, tokenizer = 64, load(BYTES)
    packed = best_fit.pack_best_fit(docs, BYTES, size=size, with_ids=True).cache()
    got = packed.collect()
    want = Counter((r[0], np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4").tobytes()) for r in rows)
    by_row = {}
    for r in got:
        by_row.setdefault(r.row_id, []).append(r)
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    assert Counter((p[0].doc_id, b"".join(q.ids for q in sorted(p, key=lambda q: q.piece))) for p in by_row.values()) == want
    for p in by_row.values():
        p.sort(key=lambda q: q.piece)
        assert [q.piece for q in p] == list(range(len(p)))
        assert [q.start for q in p] == [sum(x.length for x in p[:k]) for k in range(len(p))]
        assert all(q.length == size for q in p[1:]) and p[0].length <= size
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length, r.ids))
    for parts in bins.values():
        parts.sort()
        assert [x[0] for x in parts] == [sum(y[1] for y in parts[:k]) for k in range(len(parts))]
    assert Counter(sum(x[1] for x in parts) for parts in bins.values()) == one_by_one([r.length for r in got], size)
    assert {r.sequence_id: (r.length, bytes(r.ids)) for r in best_fit.sequences(packed).collect()} == {k: (sum(x[1] for x in v), b"".join(x[2] for x in v)) for k, v in bins.items()}
    assert best_fit.pack_best_fit(docs.limit(0), BYTES).collect() == []
