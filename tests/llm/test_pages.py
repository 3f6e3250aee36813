"""Page, vector and pipeline operators against brute force."""

from __future__ import annotations

import base64
import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("triagelake.llm")

from triagelake.llm import block_crf, legacy_archive, rp_forest, url_rules

from .samples import LOWER, documents, table_of

PAGES = "page_id long, url string, html string, host string, rule string, text string, value string, digest string"
URLS = ["http://www.Example.com/en/x?q=/fr/", "https://example.com/en/", "http://a.b.example.com/en", "http://example.com/en", "ftp://notexample.com/en/1", "http://net/es/", "http://x.net/fr/a#b", "http://x.net/f", "com/", "http://com/", "http://COM", "x://http://www.example.com/en/", "http://example.com:80/en/", "", None, "http://?x", "http://é.net/es/ü\nz", "http://.net/fr/", "http://a..net/es/"]


@pytest.fixture(scope="module")
def pages(spark):
    htmls = ["<p>a</p>", "<p>b</p>", "<p>a</p>", None, "", "é" * 50_000, "<p>b</p>", "plain text, no tags at all.", "<p>a</p>\r\n\r\nWARC/1.0\r\n\n", "<p>b"]
    rows = [(i, u, htmls[i % len(htmls)], *["x"] * 5) for i, u in enumerate(URLS)]
    return spark.createDataFrame([*rows, rows[3], rows[3], (None, "http://n", "<p>a</p>", *[None] * 5)], PAGES).repartition(3).cache()


def test_archive_round_trip(pages):
    groups, expected = defaultdict(list), []
    for r in pages.collect():
        data = (r.html or "").encode()
        groups[data].append(r.page_id)
    for data, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected += [(i, len(data), digest, "revisit" if n else "response", ids[0] if n else None) for n, i in enumerate(ids)]
    got = legacy_archive.archived(pages).collect()
    assert Counter(tuple(r)[:5] for r in got) == Counter(expected)
    assert len({r.record_id for r in got}) == len(got)


def test_http_records_with_other_schemes_are_linked(spark):
    """A page is an HTTP record whatever its url's scheme."""
    html = "<p>the same page</p>" * 100
    rows = [(1, "dns:a"), (2, "http://b/"), (3, "filedesc://c"), (4, "http://d/")]
    got = legacy_archive.archived(spark.createDataFrame([(i, u, html, *["x"] * 5) for i, u in rows], PAGES)).collect()
    assert {(r.page_id, r.record_type, r.refers_to) for r in got} == {(1, "response", None), (2, "revisit", 1), (3, "revisit", 1), (4, "revisit", 1)}


def test_arc_versions_and_lengths():
    import gzip

    for version, fields in legacy_archive.FIELDS.items():
        block = f"{version} 0 x\n{' '.join(fields)}\n".encode()
        body = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nbody\nwith lines\n\n"
        parts = [legacy_archive._arc_line(1, "filedesc://x", "text/plain", block, 0, "x") + b"\n" + block, legacy_archive._arc_line(version, "http://a/", "text/html", body, 9, "x") + b"\n" + body]
        records = list(legacy_archive.arc_records(gzip.compress(b"\n".join(parts) + b"\n")))
        assert [b for _, _, b in records] == [block, body] and records[1][1]["URL"] == "http://a/"
        with pytest.raises(ValueError, match="shorter"):
            list(legacy_archive.arc_records(gzip.compress(b"\n".join(parts)[:-9])))


def test_types_of_other_records():
    row = {"path": "p", "number": 1, "archive": "a", "uri": "dns:x", "ip": "0", "date": "20010203", "mime": "text/dns", "digest": "D", "block": b"x", "first": None}
    assert b"WARC-Type: resource\r\n" in legacy_archive.to_warc(row) and b"WARC-Date: 2001-02-03T00:00:00Z\r\n" in legacy_archive.to_warc(row)
    assert b"WARC-Type: warcinfo\r\n" in legacy_archive.to_warc(row | {"number": 0, "uri": "filedesc://a"})


def brute_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut].translate(LOWER), rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h + p), h + p, v) for v, h, p in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def test_url_rules(spark, pages):
    got = url_rules.judged(pages, url_rules.rule_table(spark)).collect()
    assert Counter(map(tuple, got)) == Counter((r.page_id, *brute_rule(r.url)) for r in pages.collect())


def test_html_blocks():
    page = '<html><head><title>no</title><style>p{}</style></head><body><div class="ad">ad</div><p>one &amp; <b>two</b>\n <a href="x">three</a><p>four<br>five<script>"</p>"</script> six<ul><li>x<li>y</ul>&copy; tail<!-- c --> end<p class="cut'
    root = block_crf.Context("")
    assert [t for _, t, _ in block_crf.blocks_of(page, root)] == ["ad", "one & two three", "four five", "six", "x", "y", "© tail end"]
    assert [t for _, t, _ in block_crf.blocks_of("plain  text", root)] == ["plain text"]


def test_crf_on_held_out_pages():
    model, wrong, total = block_crf.default_model(), 0, 0
    for seed in range(7000, 7150):
        page, truth = block_crf.labelled_page(seed)
        labels = model.labels(block_crf.blocks_of(page, model.root))
        wrong += sum(a != b for a, (_, b) in zip(labels, truth, strict=True))
        total += len(truth)
    assert wrong / total < 0.02


def test_extraction(pages):
    rows = block_crf.extracted(pages).collect()
    assert len(rows) == pages.count() and all(r.n_chars == len(r.text) for r in rows)
    assert {r.text for r in rows if r.page_id in (3, 4)} == {""}


def vectors(seed, n, dims=16, spread=1.0):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, dims))
    x *= r.uniform(1, spread, (n, 1)) / np.linalg.norm(x, axis=1)[:, None]
    return [(i, v.tolist(), "x", "y") for i, v in enumerate(x.astype(np.float32))]


def brute_nearest(rows, k=20):
    good = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, np.float64)
    ids = sorted(good)
    x = np.array([good[i] for i in ids])
    out = {}
    for i in ids:
        if i % 20 == 0:
            s = (x * good[i]).sum(1)
            out[i] = [(ids[j], s[j]) for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
    return out


@pytest.mark.parametrize("spread", [1.0, 3.0])
def test_forest(spark, spread):
    rows = vectors(1, 1500, spread=spread)
    rows += [(2000 + i, rows[20][1], "x", "y") for i in range(200)]
    rows += [(3000, None, "", ""), (3020, [0.0] * 16, "", ""), (3040, [None, *[1.0] * 15], "", ""), (3060, [float("nan")] * 16, "", ""), (3080, [float("inf"), *[1.0] * 15], "", ""), (3100, [], "", ""), (None, [1.0] * 16, "", ""), (3120, [1.0] * 3, "", "")]
    got = defaultdict(list)
    for r in rp_forest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, leaf string").repartition(3)).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    expected = brute_nearest(rows)
    assert set(got) == set(expected)
    hits = 0
    for q, found in got.items():
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(abs(s - dict(brute_scores(rows, q))[v]) < 1e-9 for _, v, s in found[:3])
        hits += len({v for _, v, _ in found} & {v for v, _ in expected[q]})
    assert hits / (20 * len(expected)) >= 0.9
    if spread == 1.0:  # the query's own vector, many times: the smallest ids
        assert [v for _, v, _ in got[2000]] == [v for v, _ in expected[2000]]


def brute_scores(rows, q):
    good = {i: v for i, v, *_ in rows if i is not None and i < 2999}
    return [(i, float((np.array(v, np.float64) * np.array(good[q], np.float64)).sum())) for i, v in good.items()]


def test_few_vectors(spark):
    rows = vectors(2, 7)
    kind = "vec_id long, embedding array<float>, id string, leaf string"
    assert len(rp_forest.nearest(spark.createDataFrame(rows, kind)).collect()) == 6
    assert rp_forest.nearest(spark.createDataFrame([], kind)).collect() == []


def test_empty_pages(spark):
    empty = spark.createDataFrame([], PAGES)
    assert legacy_archive.archived(empty).collect() == []
    assert url_rules.judged(empty, url_rules.rule_table(spark)).collect() == []
    assert block_crf.extracted(empty).collect() == []


def test_pipeline(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    pytest.importorskip("public_tokenizers")
    table_of(spark, documents(n=90)).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == names
        docs.write.parquet(f"{tmp_path}/stage{i}")
        docs = spark.read.parquet(f"{tmp_path}/stage{i}")
        assert docs.count() > 0
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.start) for r in out} and {r.doc_id for r in out} == {r.doc_id for r in docs.collect()}
