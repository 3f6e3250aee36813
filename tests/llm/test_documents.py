"""Document operators against brute force, on tables with nulls, blanks, ties, repeated rows and clashing columns."""

from __future__ import annotations

import hashlib
import time
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pytest

pytest.importorskip("triagelake.llm")

from triagelake.llm import adaptive_quality, group_join, license_index, packing, suffix_merge, weighted_mix

from .samples import LOWER, SCHEMA, WORD, documents, shingles, table_of

ROWS = documents()


@pytest.fixture(scope="module")
def docs(spark):
    return table_of(spark, ROWS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same(got, expected):
    assert Counter(map(tuple, got)) == Counter(expected)


# --- quality rules


def base_counts(text):
    w = WORD.findall(text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    triples = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if triples[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    n, chars, symbols, rep = len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(covered)
    return n, chars, symbols, dup, rep, n < 50 or 100 * rep > 50 * n


def test_quality_counts(docs):
    out = adaptive_quality.judged(docs)
    assert out.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    rows = out.collect()
    same([r[:7] for r in rows], [(i, *base_counts(t)) for i, t, *_ in ROWS])
    assert not any(r.kept and r.base_failed for r in rows)
    assert any(not r.kept and not r.base_failed for r in rows) and any(r.kept for r in rows)


def test_quality_keeps_rows_whole(docs):
    kept = adaptive_quality.kept_documents(docs)
    assert kept.columns == docs.columns
    judged = Counter(r.doc_id for r in adaptive_quality.judged(docs).where("kept").collect())
    assert Counter(r.doc_id for r in kept.collect()) == judged


def test_sketch_quantiles_are_near_and_merge(spark):
    values = [(None if i % 2 else "en", "s", i, 1, 0, i, 1, 1) for i in range(1, 3000)]
    counted = spark.createDataFrame(values, "lang string, source string, n_symbols long, n_words long, n_dup_lines long, word_chars long, n_repeat_words long, n_lines long")
    sketch = adaptive_quality.sketches(counted)
    overall = adaptive_quality.fences(sketch, []).first()
    exact = 1500 * 1000
    assert overall["size"] == 2999
    assert abs(overall["hi_symbols"] - (exact + 8 * 750_000)) <= (exact + 8 * 750_000) / 16
    assert {r["size"] for r in adaptive_quality.fences(sketch, ["lang"]).collect()} == {1499, 1500}


def test_sketches_decide_without_constants(spark):
    """Documents far outside their group but inside UPPER and LOWER go; a source full of junk doesn't raise its own fence."""
    clean = lambda i: " ".join(f"word{i}x{j}" for j in range(100))
    odd = {"symbols": clean(9001) + " #" * 25, "dup_lines": "\n".join([clean(9002), *[f"line {j}" for j in range(8)], "line 1", "line 2"]), "long words": clean(9003).replace("word", "wordwo")}
    texts = [(clean(i), "a") for i in range(300)] + [(t, "a") for t in odd.values()] + [(clean(400 + i) + " #" * 25 * (i % 3 > 0), "junk") for i in range(240)]
    texts += [(clean(1000 + i), f"s{i % 8}") for i in range(2000)]
    rows = table_of(spark, [(i, t, "en", s, len(t), *["x"] * 10) for i, (t, s) in enumerate(texts)])
    fixed, led = ({r.doc_id for r in adaptive_quality.kept_documents(rows, by_sketch=b).select("doc_id").collect()} for b in (False, True))
    junk = {i for i, (t, s) in enumerate(texts) if s == "junk" and "#" in t}
    assert fixed == set(range(len(texts)))
    assert led == fixed - junk - {300, 301, 302}
    assert Counter(r.doc_id for r in adaptive_quality.judged(rows, by_sketch=True).where("kept").collect()) == Counter(led)


# --- near duplicates


def brute_components(rows, similarity=(80, 100)):
    sets = [shingles(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in holders[x])
        for j, n in common.items():
            if similarity[1] * n >= similarity[0] * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
        for x in s:
            holders[x].append(i)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    low = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    return [(rows[i][0], len(sets[i]), low[find(i)] if sets[i] else rows[i][0]) for i in range(len(rows))]


def test_group_join(docs):
    same(group_join.linked(docs).collect(), brute_components(ROWS))


def test_group_join_links_across_stars(spark):
    """A chain whose ends are far apart, members of one group, and many documents that share all but their own words."""
    base = [f"w{i}" for i in range(120)]
    chain = [base]
    for i in range(6):
        chain.append([*chain[-1][: i * 15], *(f"c{i}{j}" for j in range(6)), *chain[-1][i * 15 + 6 :]])
    common = [f"s{i}" for i in range(30)]
    texts = [" ".join(x) for x in chain] + [" ".join([*common, f"own{i}", f"x{i}", f"y{i}"]) for i in range(40)] + [" ".join([*common, *(f"far{i}{j}" for j in range(9))]) for i in range(40)]
    rows = [(i, t, "en", "a", 0, *["x"] * 10) for i, t in enumerate(texts)]
    same(group_join.linked(table_of(spark, rows)).collect(), brute_components(rows))


def test_copies_add_no_entries(spark):
    """16 copies of each document over 16 partitions give the index of one."""
    rows = [(i, t, "en", "a", 0, *["x"] * 10) for i, (_, t, *_) in enumerate(ROWS)]

    def entries(table):
        order = group_join.Order(*group_join.frequent_shingles(table))
        members = group_join.classified(table, order).where("n > 0")
        groups = members.groupBy("g").agg({"r": "min"}).withColumnRenamed("min(r)", "r")
        index = group_join.prefix_index(table, order, groups).cache()
        shared = [tuple(r) for r in group_join.shared_entries(index).select("token", "g").collect()]
        assert len(shared) == len(set(shared))
        return index.count(), index.select("token", "g").distinct().count()

    one = table_of(spark, rows).select("doc_id", "text")
    copies = one.crossJoin(spark.range(16).select("id")).selectExpr("doc_id + 100000 * id AS doc_id", "text").repartition(16, "doc_id")
    (_, alone), (emitted, distinct) = entries(one), entries(copies)
    assert emitted <= 1.01 * distinct
    assert abs(distinct - alone) <= alone / 10  # prefixes depend on which shingles count as frequent


def test_group_join_between_many_components(spark):
    """Entries of one large component and several small ones, with sizes on both sides of a bucket's edge."""
    rows = []
    for size in (12, 13, 20, 26, 27, 60):
        for family in range(3):
            base = [f"common{i}" for i in range(size)] if family < 2 else [f"f{family}w{i}" for i in range(size)]
            for j in range(8):
                words = list(base)
                words[(j * 5 + family) % size] = f"x{size}{family}{j % 5}"
                rows.append(" ".join(words + [f"tail{family}{i}" for i in range(j % 3)]))
    rows = [(i, t, "en", "a", 0, *["x"] * 10) for i, t in enumerate(rows)]
    same(group_join.linked(table_of(spark, rows)).collect(), brute_components(rows))


def test_large_group_meets_others_by_its_few_strays(spark):
    """Group 1 has 300 classes of component 1 and one of its own; 40 more groups of component 1: only the stray meets them."""
    bits = {b: 0 for b in group_join.BITMAP}
    rows = [{"g": 1, "k": k, "n": 20, "root": 1, **bits} for k in range(1, 301)] + [{"g": 1, "k": 301, "n": 20, "root": 301, **bits}]
    rows += [{"g": g, "k": 1000 + g, "n": 20, "root": 1, **bits} for g in range(2, 42)]
    rooted = spark.createDataFrame(rows, "g long, k long, n long, root long, " + ", ".join(f"{b} long" for b in group_join.BITMAP))
    pairs = spark.createDataFrame([(1, g) for g in range(1, 42)], "ga long, gb long")
    parts = group_join.open_parts(pairs, rooted)
    expanded = parts.join(rooted.selectExpr("g AS gx", "root AS rx", "k"), ["gx", "rx"])
    assert expanded.where("gx <> gy").count() == 40
    assert expanded.where("gx = gy").count() == 300
    found = {frozenset((r.a, r.b)) for r in group_join.open_classes(pairs, rooted).collect()}
    want = {frozenset((301, k)) for k in [*range(1, 301), *range(1002, 1042)]}
    assert found == want


def test_changed_copies_meet_their_source_first(spark, monkeypatch):
    """40 copies of a text, each unlike every other but like the text: linked in the first round, so no pairs of copies are made."""
    base = [f"w{i}" for i in range(200)]
    texts = [base] + [[f"own{c}x{i}" if i in (20 + c, 80 + c, 140 + c) else w for i, w in enumerate(base)] for c in range(40)]
    rows = [(i, " ".join(t), "en", "a", 0, *["x"] * 10) for i, t in enumerate(texts[1:] + texts[:1])]
    made, parts = [], group_join.open_parts

    def counted(*given):
        out = parts(*given)
        made.append(out.count())
        return out

    monkeypatch.setattr(group_join, "open_parts", counted)
    same(group_join.linked(table_of(spark, rows)).collect(), brute_components(rows))
    assert sum(made) <= 40


def test_long_texts_that_cannot_link_are_not_sent(spark, monkeypatch):
    """Five long texts with one half in common are candidates of each other; their bitmaps alone rule them out."""
    half = [f"w{i}" for i in range(1500)]
    texts = [half + [f"own{c}x{i}" for i in range(1500)] for c in range(5)]
    rows = [(i, " ".join(t), "en", "a", 0, *["x"] * 10) for i, t in enumerate([*texts, [*texts[0][:-30], "end"]])]
    asked, verified = [], group_join.verified

    def counted(documents, pairs, classes):
        asked.append(pairs.count())
        return verified(documents, pairs, classes)

    monkeypatch.setattr(group_join, "verified", counted)
    same(group_join.linked(table_of(spark, rows)).collect(), brute_components(rows))
    assert sum(asked) == 1


def test_bitmaps_differ_in_no_more_bits_than_sets_in_elements():
    rng = np.random.default_rng(5)
    pool = np.unique(rng.integers(0, 1 << 63, 9000).astype(np.uint64))
    sets = [np.sort(rng.choice(pool, n, replace=False)) for n in (257, 300, 511, 512, 513, 2000, 5000)] + [pool[:100]]
    at = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    wide = group_join.wide_bitmaps(np.concatenate(sets), at)
    assert wide[-1] is None and all(2 * len(x) <= 8 * len(w) < 4 * len(x) + 1 for x, w in zip(sets, wide[:-1]))
    for x, w in zip(sets, wide[:-1]):
        for y, v in zip(sets, wide[:-1]):
            assert group_join.differing(w, v) <= len(np.setxor1d(x, y))
            assert group_join.differing(w, v) == group_join.differing(v, w)


def test_writing_leaves_no_shuffle_files(spark):
    from triagelake.llm.shared import CLEANUP, written

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = {str(f) for f in disk.getAllFiles().mkString("\n").split("\n")}
    table = written(spark.range(200000).repartition(8, "id"), "shuffled")
    deadline = time.monotonic() + 10
    while (left := set(disk.getAllFiles().mkString("\n").split("\n")) - before) and time.monotonic() < deadline:
        time.sleep(0.1)
    assert not {f for f in left if "shuffle" in f}
    assert table.count() == 200000 and spark.conf.get(CLEANUP) == "false"


def test_one_of_each_group_stays(docs):
    kept = group_join.representatives(docs)
    assert kept.columns == docs.columns
    found = group_join.joined(docs.select("doc_id", "text")).collect()
    groups = {r.stays for r in found if r.n_shingles}
    blank = sum(not shingles(t) for _, t, *_ in ROWS)
    assert kept.count() == len(groups) + blank


# --- repeated passages


def brute_cut(texts, n=200):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[p : p + n] for d in data for p in range(len(d) - n + 1))
    flags = []
    for d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - n + 1):
            if seen[d[p : p + n]] > 1:
                gone[p : p + n] = b"\1" * n
        flags.append(gone)
    return data, flags


def test_suffix_merge(docs):
    data, flags = brute_cut([r[1] for r in ROWS])
    expected = []
    for (i, *_), d, f in zip(ROWS, data, flags, strict=True):
        kept = bytes(b for b, x in zip(d, f, strict=True) if not x)
        spans = sum(x and (p == 0 or not f[p - 1]) for p, x in enumerate(f))
        expected.append((i, len(d), sum(f), spans, hashlib.sha256(kept).hexdigest()))
    same(suffix_merge.deduplicated(docs).collect(), expected)


def test_suffix_merge_of_hot_prefixes(docs, monkeypatch):
    whole = suffix_merge.deduplicated(docs).collect()
    monkeypatch.setattr(suffix_merge, "HOT", 1)
    same(suffix_merge.deduplicated(docs).collect(), list(map(tuple, whole)))


def test_cut_keeps_characters_whole(docs):
    cut = suffix_merge.cut_documents(docs)
    assert cut.columns == docs.columns
    data, flags = brute_cut([r[1] for r in ROWS])
    expected = []
    for (i, t, *_), f in zip(ROWS, flags, strict=True):
        if t is None:
            expected.append((i, None, None))
            continue
        out, p = [], 0
        for c in t:
            n = len(c.encode())
            out.append("" if all(f[p : p + n]) else c)
            p += n
        text = "".join(out)
        expected.append((i, text, len(text)))
    same([(r.doc_id, r.text, r.n_chars) for r in cut.collect()], expected)


def test_loser_tree_merges_in_order_with_common_prefixes():
    import random

    r = random.Random(3)
    runs = [[(bytes(r.choices(b"ab", k=r.randint(1, 12))), b"left", r.randrange(9), r.randrange(99), False) for _ in range(r.randint(1, 40))] for _ in range(7)]
    expected = sorted(e[0] for run in runs for e in run)
    got = list(suffix_merge.merged([suffix_merge.packed_run(list(run)) for run in runs]))
    assert [e[0] for _, e in got] == expected
    assert all(n == suffix_merge.common(a, b, 0) for (_, (a, *_)), (n, (b, *_)) in pairwise(got))
    assert Counter(e for _, e in got) == Counter(e for run in runs for e in run)


def test_large_groups_give_what_pairs_give(monkeypatch):
    import random

    r = random.Random(5)
    core = bytes(r.choices(b"abcd", k=120))
    group = []
    for s in range(30):
        before, after = bytes(r.choices(b"ab", k=3)) * 30, bytes(r.choices(b"ab", k=4)) * 30
        group.append((before, core + after, s))
    group.sort(key=lambda x: x[1])
    rows = [(64, (suffix, before, 1, s, False)) for before, suffix, s in group]
    pairs = set(suffix_merge.repeats_in(rows[:24]))
    monkeypatch.setattr(suffix_merge, "PAIRED", 1)
    assert pairs == set(suffix_merge.repeats_in(rows[:24]))


# --- mixing


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, free, target = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        above = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not above:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= above
    return target


def test_mix(docs):
    rows = weighted_mix.mix_of(docs).collect()
    same([(r.doc_id, r["size"]) for r in rows], [(i, len(WORD.findall(t or ""))) for i, t, *_ in ROWS])
    sizes = Counter()
    for _, t, _, s, *_ in ROWS:
        sizes[s] += len(WORD.findall(t or ""))
    target = brute_targets(sizes)
    source = {i: s for i, _, _, s, *_ in ROWS}
    taken = Counter()
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"]
        if r.doc_id is not None:
            assert r.source_size == sizes[source[r.doc_id]] and abs(r.target - target[source[r.doc_id]]) < 1e-6
        taken[r.target] += r.taken
    for s in sizes:
        assert abs(sum(v for t, v in taken.items() if abs(t - target[s]) < 1e-6) - target[s]) <= 1
    same(weighted_mix.mix_of(docs).collect(), list(map(tuple, rows)))


def test_mix_favours_clean_documents(spark):
    rows = [(i, ("word " if i % 2 else "#### ") * 20, "en", "b" if i < 400 else "a", 0, *["x"] * 10) for i in range(500)]
    out = weighted_mix.mix_of(table_of(spark, rows)).where("doc_id < 400").collect()
    extra = Counter()
    for r in out:
        extra[r.doc_id % 2] += r.taken
    assert extra[1] - 4000 > 2 * (extra[0] - 4000)  # each document is taken once, and the better ones again


def test_mixed_documents(docs):
    mixed = weighted_mix.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = Counter()
    texts = {i: t for i, t, *_ in ROWS if t}
    for r in mixed.collect():
        assert r.n_chars == len(r.text) and texts[r.doc_id].startswith(r.text)
        got[r.doc_id] += len(WORD.findall(r.text))
    expected = Counter()
    for r in weighted_mix.mix_of(docs).collect():
        expected[r.doc_id] += r.taken
    assert got == +expected


# --- packing


def test_packing(docs):
    P = pytest.importorskip("public_tokenizers")
    path, ranks, pattern = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN
    slow = packing.Encoder(path)
    rows = [*ROWS, (900, "a <|endoftext|> b", None, None, 0, *["x"] * 10), (901, "a" + " " * 3000 + "b", None, None, 0, *["x"] * 10)]
    ids = {i: [*slow.ids(t or ""), 0] for i, t, *_ in rows if i is not None}
    out = packing.packed(table_of(docs.sparkSession, rows), lambda: packing.Encoder(path, ranks, pattern)).collect()
    pieces, sequences = defaultdict(set), defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
        if r.doc_id is not None:
            part = ids[r.doc_id][r.start : r.start + r.length]
            assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)) and r.doc_tokens == len(ids[r.doc_id])
            pieces[r.doc_id].add((r.start, r.length))
    for i, p in pieces.items():
        assert {x for a, n in p for x in range(a, a + n)} == set(range(len(ids[i])))
    assert sorted(sequences) == list(range(len(sequences)))
    for s, p in sequences.items():
        p.sort()
        assert p[0][0] == 0 and all(a + n == b for (a, n), (b, _) in pairwise(p))
        assert p[-1][0] + p[-1][1] == 1024 or s == len(sequences) - 1


# --- license scan


def brute_bases(text):
    import re

    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    found = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        found += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    return len(w), len(found), min(found)[0] if found else None, max(found)[0] if found else None, ",".join(sorted({x for _, x in found}))


LICENSES = [
    "Released under the MIT License. MIT license, MIT-LICENSE! mit  license", "Licensed under the Apache License, Version 2.0", "the GNU\nGeneral\tPublic License", "General Public\u00e9 License", "Licensed under CC BY-NC 4.0.",
    "Redistribution and use in source and binary forms, with or without modification, are permitted", "commit license", "license mit", "LICENSE", "cc\n**by**/nc 4.0", "distribution in binary forms", "K\u212a License", None, "",
]


def test_license_scan(spark):
    rows = [(i, t, None, None, 0, *["x"] * 10) for i, t in enumerate(LICENSES)] + [r for r in ROWS if r[0] is None or r[0] > 50]
    out = license_index.scanned(table_of(spark, rows)).collect()
    same([tuple(r)[:6] for r in out], [(i, *brute_bases(t)) for i, t, *_ in rows])
    labels = {r.doc_id: r.labels for r in out}
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in out)
    assert labels[4] == labels[9] == "cc-by-nc" and labels[5] == "bsd" and labels[10] == labels[8] == ""


def test_every_licence_of_a_long_document_is_found(spark):
    """Ordinary words and other notices don't keep a licence from being looked up."""
    ordinary = "charge domain free general granted modify permission permitted public purpose software subject terms version " * 3
    notices = ", ".join(t for _, t, _ in license_index.TEMPLATES)
    texts = [ordinary + "Licensed under CC BY-NC 4.0. " + ordinary, notices, "Licensed under CC BY-NC 4.0. " * 2, *["Licensed under the CC BY 4.0 license"] * 40]
    out = {r.doc_id: r for r in license_index.scanned(table_of(spark, [(i, t, None, None, 0, *["x"] * 10) for i, t in enumerate(texts)])).collect()}
    assert out[0].labels == out[2].labels == "cc-by-nc" and out[0].score == 1.0
    assert out[1].labels.split(",") == sorted({label for label, *_ in license_index.TEMPLATES})


def test_licence_words_are_counted_over_all_documents(spark, monkeypatch):
    """Documents without a gate string count too: a word of ordinary English isn't taken for a rare one."""
    texts = ["Free public TERMS under general software; terms"] * 20 + ["licensed under cc by nc 4 0", "hereby", None, ""]
    found, idf_of = {}, license_index.idf_of
    monkeypatch.setattr(license_index, "idf_of", lambda *a: found.update(idf_of(*a)) or found)
    license_index.scanned(table_of(spark, [(i, t, None, None, 0, *["x"] * 10) for i, t in enumerate(texts)])).collect()
    assert found["free"] == found["terms"] == 25 / 21 and found["under"] == 25 / 22
    assert found["cc"] == found["hereby"] == 25 / 2 and found["affero"] == 25


@pytest.mark.parametrize("run", [adaptive_quality.judged, adaptive_quality.kept_documents, group_join.linked, group_join.representatives, suffix_merge.deduplicated, suffix_merge.cut_documents, weighted_mix.mix_of, weighted_mix.mixed_documents, license_index.scanned])
def test_empty_tables(empty, run):
    assert run(empty).collect() == []
