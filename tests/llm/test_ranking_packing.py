"""Lexical ranking, hard negatives and histogram packing against brute force, with nulls, blanks, ties, repeated rows and clashing columns."""

from __future__ import annotations

import bisect
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("triagelake.llm")

from triagelake.llm import histogram_packing, lexical_rank, packing, residue_negatives
from triagelake.llm.queries import byte_bpe

from .samples import LOWER, SCHEMA, documents, table_of

ROWS = documents()
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def docs(spark):
    return table_of(spark, ROWS).cache()


# --- lexical ranking


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranking(items, rows, k):
    """(item_id, rank, doc_id, score) by adding up term by term."""
    own = [(d, terms(t)) for d, t in rows if terms(t)]
    total, length = len(own), sum(len(t) for _, t in own)
    counts = [Counter(t) for _, t in own]
    df = Counter(w for c in counts for w in c)
    out = []
    for item, text in items:
        scores = []
        for (doc, words), count in zip(own, counts):
            m = 75 + 25 * len(words) * total // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[w] + 1))) * (1_000_000_000 * count[w] // (1000 * count[w] + 12 * m)) for w in terms(text) if count[w])
            if score > 0:
                scores.append((-score, doc is None, doc, score))
        out += [(item, i + 1, doc, score) for i, (_, _, doc, score) in enumerate(sorted(scores, key=lambda s: s[:2] + (s[2] or 0,))[:k])]
    return sorted(out, key=str)


def queries_of(rows):
    r = random.Random(5)
    texts = [t for _, t, *_ in rows if t]
    items = [(i, " ".join(r.choices(r.choice(texts).split() or ["x"], k=r.randint(1, 40)))) for i in range(30)]
    return items + [(100, None), (101, ""), (102, "; , \n"), (103, "zzz unknown-word"), (104, "the-SAME same Same _same_ line;here"), (None, texts[-1][:200]), (105, "Ça ñu 日本é KA_ka"), (105, "one two")]


@pytest.mark.parametrize("k", [1, 20])
def test_ranking_equals_brute_force(spark, docs, k, monkeypatch):
    monkeypatch.setattr(lexical_rank, "DOCUMENT_TILE", 16)
    monkeypatch.setattr(lexical_rank, "TILE", 32)
    monkeypatch.setattr(lexical_rank, "ITEM_BLOCK", 7)
    items = queries_of(ROWS)
    table = spark.createDataFrame([(*x, "clash", 3) for x in items], "item_id long, text string, doc_id string, score int")
    got = lexical_rank.ranked(table, docs, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == ranking(items, [(i, t) for i, t, *_ in ROWS], k)


def test_ranking_in_rounds(spark, docs, monkeypatch):
    monkeypatch.setattr(lexical_rank, "ROUND_TERMS", 60)
    items = queries_of(ROWS)[:12]
    table = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    assert len(lexical_rank.rounds_of(lexical_rank.item_terms(table).cache())) > 2
    assert sorted(map(tuple, lexical_rank.ranked(table, docs, 5).collect()), key=str) == ranking(items, [(i, t) for i, t, *_ in ROWS], 5)


def test_ranking_of_nothing(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert not lexical_rank.ranked(none, docs).collect()
    assert not lexical_rank.ranked(some, spark.createDataFrame([], SCHEMA)).collect()
    assert not lexical_rank.ranked(some, spark.createDataFrame([(1, None), (2, " ; ")], "doc_id long, text string")).collect()


def test_large_weights_are_cut_into_limbs():
    r = np.random.default_rng(1)
    weight = r.integers(1, 1 << 40, 50)
    block = lexical_rank.Block(0, 2, np.arange(25), np.repeat([0, 1], 25)[np.argsort(np.tile(np.arange(25), 2), kind="stable")], np.sort(np.tile(np.arange(25), 2)), weight)
    impact = r.integers(0, 10**6, (3, 25))
    row, term = np.nonzero(impact >= 0)
    got = lexical_rank.block_scores(block, row, term, impact[row, term], 3)
    for item in range(2):
        for doc in range(3):
            assert got[item, doc] == sum(int(w) * int(impact[doc, t]) for w, t, i in zip(weight, block.at, block.row) if i == item)


def test_terms_with_equal_first_hashes():
    first = np.array([1, 5, 5, 9], np.uint64)
    items = lexical_rank.Items(np.zeros(0), np.zeros(0), np.zeros(0), np.zeros(0), first, np.array([1, 2, 7, 3], np.uint64), 2)
    assert items.places(np.array([5, 5, 5, 9, 10, 0], np.uint64), np.array([7, 2, 3, 3, 3, 0], np.uint64)).tolist() == [2, 1, -1, 3, -1, -1]


# --- hard negatives


def test_scores_come_back_from_residues():
    r = np.random.default_rng(2)
    for bits in (3, 20, 40, 54):
        bound = 2**bits
        primes = residue_negatives.primes_for(bound)
        values = np.array([0, 1, -1, bound, -bound, bound - 1, 1 - bound, *r.integers(-bound, bound, 500)])
        parts = [(values % p).astype(np.int32) for p in primes]
        assert (residue_negatives.reconstructed(parts, primes) == values).all()
        assert len(primes) == 1 or math.prod(primes[:-1]) <= 2 * bound * (1 + 1e-8) + 4
    with pytest.raises(ValueError):
        residue_negatives.primes_for(2.0**60)


def test_products_of_long_and_large_vectors():
    r = np.random.default_rng(3)
    for dims, size in ((1, 10), (64, 2**20), (333, 2**22)):
        a, b = (np.floor(r.uniform(-size, size, (n, dims))) for n in (5, 9))
        primes = residue_negatives.primes_for(float(size) ** 2 * dims)
        got = residue_negatives.exact_scores(a, [residue_negatives.residues(b, p) for p in primes], primes)
        assert got.tolist() == [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]


def mined(rows, every, positives=5, negatives=5):
    own = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and len(v) == 3 and all(x is not None and math.isfinite(x) for x in v):
            own.setdefault(i, set()).add((label, tuple(math.floor(256 * x) for x in v)))
    flat = [(i, label, v) for i, s in own.items() for label, v in s]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    best_p, best_n, out = defaultdict(dict), defaultdict(dict), []
    for a, label, v in flat:
        if a % every == 0:
            for b, other, w in flat:
                if a != b:
                    side = best_p if label == other else best_n
                    side[a][b] = max(side[a].get(b, -(10**18)), dot(v, w))
    top = lambda d, k: sorted(d.items(), key=lambda x: (-x[1], x[0]))[:k]
    for a in best_p:
        for p, score in top(best_p[a], positives):
            inside = {n: s for n, s in best_n[a].items() if 80 * score <= 100 * s <= 100 * score}
            out += [(a, p, i + 1, n, score, s) for i, (n, s) in enumerate(top(inside, negatives))]
    return sorted(out)


def vectors(n=400, seed=4):
    r = random.Random(seed)
    rows = [(i, r.choice([0, 0, 0, 1, 2]), [round(r.uniform(-1, 1), 1) for _ in range(3)]) for i in range(n)]
    rows += [(i, 1, [0.5, 0.5, -0.25]) for i in range(n, 2 * n)]  # one vector in half of all rows
    bad = [(None, 1, [1.0, 1.0, 1.0]), (900, None, [1.0, 1.0, 1.0]), (905, 1, None), (910, 1, [1.0, None, 1.0]), (915, 1, [1.0, math.nan, 1.0]), (920, 1, [math.inf, 1.0, 1.0]), (925, 1, [1.0, 1.0]), (930, 1, []), (935, 1, [0.0, 0.0, 0.0]), (940, 0, [0.0, -0.0, 0.0])]
    return rows + bad + rows[:50]


def test_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(residue_negatives, "LEAST_BLOCK", 60)
    monkeypatch.setattr(residue_negatives, "ANCHOR_BLOCK", 20)
    monkeypatch.setattr(residue_negatives, "STRIP", 7)
    rows = vectors()
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<double>, x int, size string").repartition(5)
    got = residue_negatives.hard_negatives(table, every=10)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = mined(rows, 10)
    assert len(expected) > 100 and sorted(map(tuple, got.collect())) == expected


def test_rows_that_share_an_id(spark):
    r = random.Random(6)
    rows = [(i // 2, i % 3 and 1, [r.choice([0.25, 0.5, 1.0]) for _ in range(3)]) for i in range(120)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    labels = {}
    for i, label, _ in rows:
        labels.setdefault(i, set()).add(label)
    single = [x for x in rows if len(labels[x[0]]) == 1]
    table = spark.createDataFrame(single, table.schema)
    assert sorted(map(tuple, residue_negatives.hard_negatives(table, every=5).collect())) == mined(single, 5)


def test_no_vectors(spark):
    schema = "vec_id long, label int, embedding array<float>"
    for rows in ([], [(100, 1, None)], [(100, 1, [1.0])], [(100, 1, [1.0]), (101, 2, [1.0])]):
        assert not residue_negatives.hard_negatives(spark.createDataFrame(rows, schema)).collect()


def test_labels_can_be_changed(spark):
    from pyspark.sql import functions as F

    rows = [(100, 1, [1.0]), (101, 2, [1.0]), (102, 3, [1.0])]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = residue_negatives.hard_negatives(table, relabel=F.when(F.col("vec_id") == 101, F.lit(1)).otherwise(F.col("label"))).collect()
    assert [tuple(x) for x in got] == [(100, 101, 1, 102, 65536, 65536)]


# --- histogram packing


def one_by_one(lengths, width):
    """Best-fit decreasing, piece by piece: the number of sequences."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, n)
        room = rooms.pop(at) if at < len(rooms) else width
        bisect.insort(rooms, room - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan_equals_best_fit_piece_by_piece(seed):
    r = random.Random(seed)
    width = [10, 64, 2048][seed % 3]
    lengths = [min(width, max(1, int(r.expovariate(4 / width)))) for _ in range(3000)] + [3] * (seed * 700)
    plan = histogram_packing.planned(Counter(lengths), width)
    filled = defaultdict(list)
    for n, count in Counter(lengths).items():
        own = plan[plan[:, 0] == n]
        assert own[0, 1] == 0
        for rank in range(count):
            _, first, sequence, each, offset = own[np.searchsorted(own[:, 1], rank, "right") - 1]
            i = rank - first
            filled[sequence + i // each].append((offset + i % each * n, n))
    for pieces in filled.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= width
    assert len(filled) == one_by_one(lengths, width)
    assert len(plan) <= width * 4 * 63


def test_pieces_hold_every_id_once(docs):
    encoder = byte_bpe()
    got = histogram_packing.packed(docs, byte_bpe).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for x in got:
        by_doc[x.doc_id].append(x)
        by_sequence[x.sequence_id].append((x.offset, x.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= histogram_packing.WIDTH
    expected = defaultdict(list)
    for i, text, *_ in ROWS:
        expected[i].append(np.array([*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes())
    for i, whole in expected.items():
        if len(whole) == 1:
            pieces = sorted(by_doc[i], key=lambda x: x.piece)
            assert b"".join(bytes(x.ids) for x in pieces) == whole[0]
            assert [x.piece for x in pieces] == list(range(len(pieces)))
            assert [x.start for x in pieces] == [sum(y.length for y in pieces[:j]) for j in range(len(pieces))]
            assert all(x.length == histogram_packing.WIDTH for x in pieces[1:]) and pieces[0].length <= histogram_packing.WIDTH
        else:
            assert sum(x.length for x in by_doc[i]) == sum(len(w) for w in whole) // 4
    assert len(by_sequence) == one_by_one([x.length for x in got], histogram_packing.WIDTH)


def test_frequent_length_and_no_documents(spark):
    same = spark.createDataFrame([(i, None, 5) for i in range(5000)], "doc_id long, text string, length int").repartition(7)
    got = histogram_packing.packed(same, byte_bpe).collect()
    assert len({(x.sequence_id, x.offset) for x in got}) == 5000 and len({x.sequence_id for x in got}) == 3
    assert {zlib.crc32(bytes(x.ids)) for x in got} == {zlib.crc32(bytes(4))}
    assert not histogram_packing.packed(spark.createDataFrame([], SCHEMA), byte_bpe).collect()


def test_both_encoders_agree():
    """The rank form of the vocabulary against the tokenizer file."""
    encoder = byte_bpe()
    r = random.Random(8)
    for text in [t for _, t, *_ in ROWS if t][:40] + ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(160, 0x3000)])) for _ in range(300)) for _ in range(20)]:
        assert encoder.ids(text) == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert isinstance(encoder, packing.Encoder)
