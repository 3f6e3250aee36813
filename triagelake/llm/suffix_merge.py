"""Suffix-array dedup: repeated byte strings by a distributed merge sort of suffixes that knows common prefixes.

A byte goes if some LENGTH-byte string that covers it starts at another place too, in the same text or another.

Which suffixes are sorted. The smallest hash of all GRAM-byte strings inside a LENGTH-byte window (leftmost of equal ones)
is the window's anchor; it depends on the window's bytes alone, so equal windows have equal anchors at equal offsets. Only
suffixes at anchors are sorted, one for about LENGTH / 3 bytes. A suffix whose first GRAM bytes are found once in the corpus
is settled by that prefix and never travels; a bit table of fixed size tells the scan which prefixes may be repeated.

The sort. A task cuts its texts into runs, merges equal suffixes (an anchor's whole neighbourhood: the bytes of all windows
that it serves), sorts each run and sends it front-coded: for each suffix the length of the prefix that it shares with the
one before, and the bytes after it. Runs are dealt by the digest of the first GRAM bytes, so that repeats meet and no
list of splitters grows on the driver. Each receiver merges its runs with a loser tree that keeps, for every run, the common
prefix with the suffix last put out: unequal lengths decide without a look at the bytes, equal ones compare from there on.

The repeats. Suffixes that share GRAM bytes are neighbours. Two of them repeat the windows that fit in the common bytes
around their anchors (right: the smallest common prefix between the two; left: compared backwards). Larger groups compare
the digests of their windows instead, each once. Prefixes with more than HOT different suffixes are not merged in one task:
their windows are dealt by their own digests.

Defined cases: null text is empty; texts shorter than LENGTH keep everything; equal rows repeat each other; null or repeated
doc_ids are rows like any other (rows are told apart by a hash of doc_id and text); an empty table gives an empty result;
extra columns are ignored by `deduplicated` and kept by `cut_documents`. Suffixes and windows are matched by 64-bit hashes
next to their prefix's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .bit_table import bit_table, maybe_in
from .shared import own_columns, written

LENGTH = 200
GRAM = 64
#: Bytes scanned at once, and bytes of text in a run.
PIECE, RUN = 1 << 20, 16 << 20
TABLE_BITS = 1 << 27
#: Suffixes in a receiver's bucket, different suffixes of one prefix merged in one task, and neighbours compared in pairs.
BUCKET, HOT, PAIRED = 50_000, 8192, 24


class Anchors:
    """Anchors of some texts' windows: positions in `data`, windows first..last (starts), hashes."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray) -> None:
        self.data, self.bounds = data, bounds
        n = len(data) - LENGTH + 1
        self.at = self.first = self.last = np.zeros(0, np.int64)
        self.gram = self.suffix = np.zeros(0, np.uint64)
        if n <= 0:
            return
        self.up, self.down = K.powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(K._BYTES[data] * self.up[:-1], out=self.sums[1:])
        grams = K.mixed((self.sums[GRAM:] - self.sums[:-GRAM]) * self.down[: len(data) - GRAM + 1])
        bits = np.uint64((1 << 22) - 1)
        low = (grams & ~bits) | np.arange(len(grams), dtype=np.uint64)
        width, span = 1, LENGTH - GRAM + 1
        while width * 2 <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
        anchor = (low & bits).astype(np.int64)[:n]
        row = K.rows_of(bounds)[:n]
        inside = np.arange(n) + LENGTH <= bounds[row + 1]
        new = inside.copy()
        new[1:] &= (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        end = inside.copy()
        end[:-1] &= (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | ~inside[1:]
        self.first, self.last = np.flatnonzero(new), np.flatnonzero(end)
        self.at = anchor[self.first]
        self.row = row[self.first]
        self.gram = grams[self.at]
        self.suffix = K.mixed(self.hashes(self.first, self.last + LENGTH) + (self.at - self.first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return K.mixed((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def scanned(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, int, Anchors]]:
    """(batch of rows, first byte of the piece in its row, anchors). Long texts come in overlapping pieces;
    a batch without rows follows each RUN bytes."""
    done = 0
    for batch in K.slices(batches, text, PIECE):
        data, bounds = K.text_bytes(batch.column(text))
        if len(data) <= 2 * PIECE:
            yield batch, 0, Anchors(data, bounds)
        else:  # one long text
            for start in range(0, len(data) - LENGTH + 1, PIECE):
                piece = data[start : start + PIECE + LENGTH - 1]
                yield batch, start, Anchors(piece, np.array([0, len(piece)]))
        done += len(data)
        if done >= RUN:
            done = 0
            yield batch.slice(0, 0), 0, Anchors(np.zeros(0, np.uint8), np.zeros(1, np.int64))


def repeated_prefixes(texts: DataFrame) -> DataFrame:
    """(h, places, suffixes): prefixes found at two places or more, and at most how many different suffixes they begin."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def report() -> pa.RecordBatch:
            pairs = np.concatenate(held)
            pairs = pairs[np.argsort(pairs["h"], kind="stable")]
            new = np.ones(len(pairs), bool)
            new[1:] = pairs["h"][1:] != pairs["h"][:-1]
            first = np.flatnonzero(new)
            places = np.diff(np.append(first, len(pairs)))
            suffixes = np.ones(len(first), np.int64)
            for i in np.flatnonzero(places > 1):
                suffixes[i] = len(np.unique(pairs["s"][first[i] : first[i] + places[i]]))
            return pa.RecordBatch.from_arrays([pa.array(pairs["h"][first].view(np.int64)), pa.array(places), pa.array(suffixes)], names=["h", "places", "suffixes"])

        for batch, _, a in scanned(batches, 1):
            if batch.num_rows:
                pair = np.empty(len(a.gram), [("h", np.uint64), ("s", np.uint64)])
                pair["h"], pair["s"] = a.gram, a.suffix
                held.append(pair)
            elif held:
                yield report()
                held.clear()
        if held:
            yield report()

    counts = texts.mapInArrow(scan, "h long, places long, suffixes long").groupBy("h").agg(F.sum("places").alias("places"), F.sum("suffixes").alias("suffixes"))
    return written(counts.where("places > 1"), "suffix-prefixes")


def common(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix, known to be `start` at least."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[start:n], "big") ^ int.from_bytes(b[start:n], "big")
    return n - (x.bit_length() + 7) // 8 if x else n


def packed_run(entries: list[tuple[bytes, bytes, int, int, bool]]) -> bytes:
    """A sorted run of (suffix from the anchor, bytes before it, prefix hash, suffix hash, found twice), front-coded."""
    entries.sort()
    shared = [0, *(common(x[0], y[0], 0) for x, y in zip(entries, entries[1:], strict=False))]
    head = np.array([(p, len(e[0]), len(e[1]), e[4], e[2], e[3]) for p, e in zip(shared, entries, strict=True)], HEAD)
    return b"".join([len(entries).to_bytes(4, "little"), head.tobytes(), *(e[0][p:] for p, e in zip(shared, entries, strict=True)), *(e[1] for e in entries)])


HEAD = np.dtype([("shared", "<u2"), ("right", "<u2"), ("left", "<u2"), ("twice", "?"), ("h", "<u8"), ("s", "<u8")])


class Run:
    """Reads a packed run suffix by suffix; `shared` is the common prefix with the suffix before."""

    def __init__(self, blob: bytes) -> None:
        n = int.from_bytes(blob[:4], "little")
        self.blob, self.n, self.i = blob, n, 0
        head = np.frombuffer(blob, HEAD, n, 4)
        self.shared, self.right, self.left, self.twice, self.h, self.s = (head[f].tolist() for f in HEAD.names)
        self.tail = 4 + n * HEAD.itemsize
        self.before = self.tail + sum(self.right) - sum(self.shared)
        self.suffix = b""
        self.entry: tuple = ()

    def advance(self) -> bool:
        i = self.i
        if i == self.n:
            return False
        more = self.right[i] - self.shared[i]
        self.suffix = self.suffix[: self.shared[i]] + self.blob[self.tail : self.tail + more]
        self.tail += more
        self.entry = (self.suffix, self.blob[self.before : self.before + self.left[i]], self.h[i], self.s[i], self.twice[i])
        self.before += self.left[i]
        self.i += 1
        return True


def merged(blobs: list[bytes]) -> Iterator[tuple[int, tuple]]:
    """All entries of the runs in order, each with its common prefix with the one before. A loser tree: every inner node holds
    the run that lost there and its common prefix with the winner that passed."""
    runs = [Run(b) for b in blobs]
    k = 1 << max(1, (len(runs) - 1).bit_length())
    # common prefix with the last output; -1: the run is at its end
    near = [0 if i < len(runs) and runs[i].advance() else -1 for i in range(k)]
    loser = [-1] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's common prefix is then with the winner."""
        x, y = near[a], near[b]
        if x != y:  # the longer common prefix with the last output is the smaller suffix, and y < x is also y's prefix with it
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        s, t = runs[a].suffix, runs[b].suffix
        n = common(s, t, x)
        if s[n : n + 1] <= t[n : n + 1]:
            near[b] = n
            return a, b
        near[a] = n
        return b, a

    level = list(range(k))
    at = k
    while at > 1:
        at //= 2
        up = []
        for i in range(0, len(level), 2):
            w, lost = play(level[i], level[i + 1])
            loser[at + i // 2] = lost
            up.append(w)
        level = up
    winner = level[0]
    while near[winner] >= 0:
        run = runs[winner]
        yield near[winner], run.entry
        near[winner] = run.shared[run.i] if run.i < run.n else -1
        run.advance()
        at = (winner + k) // 2
        while at:
            winner, loser[at] = play(winner, loser[at])
            at //= 2


def spans_of(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of each stretch of set flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def repeats_in(group: list[tuple[int, tuple]]) -> Iterator[tuple[int, int, int, int]]:
    """Neighbours with equal prefix, in order with common prefixes -> (h, s, first, last) of repeated windows, counted from
    each suffix's first window."""
    entries: dict[int, list] = {}
    for _, (suffix, before, h, s, twice) in group:
        if s in entries:
            entries[s][3] = True
        else:
            entries[s] = [suffix, before, h, twice]
    windows = {s: len(e[0]) + len(e[1]) - LENGTH + 1 for s, e in entries.items()}
    if len(entries) == 1:
        ((s, e),) = entries.items()
        if e[3]:
            yield e[2], s, 0, windows[s] - 1
        return
    flags = {s: np.full(windows[s], e[3], bool) for s, e in entries.items()}
    keys = list(entries)
    if len(keys) <= PAIRED:
        for i, s in enumerate(keys):
            e = entries[s]
            back = e[1][::-1]
            for t in keys[i + 1 :]:
                o = entries[t]
                ahead, behind = common(e[0], o[0], GRAM), common(back, o[1][::-1], 0)
                if ahead + behind >= LENGTH:
                    for key, left in ((s, len(e[1])), (t, len(o[1]))):
                        flags[key][max(0, left - behind) : max(0, left + ahead - LENGTH + 1)] = True
    else:
        data = np.frombuffer(b"".join(e[1] + e[0] for e in entries.values()), np.uint8)
        counts = np.array([windows[s] for s in keys])
        ends = np.cumsum(counts + LENGTH - 1)
        first = ends - (counts + LENGTH - 1)
        starts = np.repeat(first, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        hashes = window_digests(data, starts)
        _, inverse, seen = np.unique(hashes, return_inverse=True, return_counts=True)
        again = seen[inverse] > 1
        at = np.concatenate([[0], np.cumsum(counts)])
        for i, s in enumerate(keys):
            flags[s] |= again[at[i] : at[i + 1]]
    for s in keys:
        for first_, last_ in spans_of(flags[s]):
            yield entries[s][2], s, first_, last_


def window_digests(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of the LENGTH bytes from each start (ascending), a piece of the data at a time."""
    out = np.empty(len(starts), np.uint64)
    done = 0
    while done < len(starts):
        low = starts[done]
        end = max(done + 1, int(np.searchsorted(starts, low + PIECE, "right")))
        piece = data[low : starts[end - 1] + LENGTH]
        up, down = K.powers(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(K._BYTES[piece] * up[:-1], out=sums[1:])
        at = starts[done:end] - low
        out[done:end] = K.mixed((sums[at + LENGTH] - sums[at]) * down[at])
        done = end
    return out


def runs_of(texts: DataFrame, maybe, hot, buckets: int) -> DataFrame:
    """(bucket, run): front-coded sorted runs; with bucket -1 the windows of hot prefixes (h, s, window hashes)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def report() -> Iterator[pa.RecordBatch]:
            parts: dict[int, list] = {}
            for (h, s), e in held.items():
                parts.setdefault(h % buckets, []).append((e[0], e[1], h, s, e[2]))
            for b, entries in parts.items():
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([packed_run(entries)], pa.binary()), *(pa.array([None], kind) for kind in KINDS)], names=NAMES)
            held.clear()

        for batch, _, a in scanned(batches, 1):
            if not batch.num_rows:
                yield from report()
                continue
            keep = np.flatnonzero(maybe_in(maybe.value, a.gram))
            is_hot = maybe_in(hot.value, a.gram[keep]) if len(keep) else np.zeros(0, bool)
            data = a.data.tobytes()
            for i in keep[~is_hot]:
                key = (int(a.gram[i]), int(a.suffix[i]))
                if key in held:
                    held[key][2] = True
                else:
                    at = int(a.at[i])
                    held[key] = [data[at : a.last[i] + LENGTH], data[a.first[i] : at], False]
            some = keep[is_hot]
            if len(some):
                _, first, counts = np.unique(a.suffix[some], return_index=True, return_counts=True)
                some = some[first]
                lists = [a.hashes(w := np.arange(a.first[i], a.last[i] + 1), w + LENGTH).view(np.int64) for i in some]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), -1)), pa.array([None] * len(some), pa.binary()), pa.array(a.gram[some].view(np.int64)), pa.array(a.suffix[some].view(np.int64)), pa.array(counts > 1), pa.array(lists, pa.list_(pa.int64()))], names=NAMES)
        yield from report()

    NAMES = ["bucket", "run", "h", "s", "twice", "windows"]
    KINDS = [pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64())]
    return texts.mapInArrow(scan, "bucket long, run binary, h long, s long, twice boolean, windows array<long>")


def merge_bucket(rows: pa.Table) -> pa.Table:
    out: list[tuple] = []
    group: list[tuple[int, tuple]] = []
    for shared, entry in merged([r.as_py() for r in rows.column("run")]):
        if group and shared < GRAM:
            out += repeats_in(group)
            group = []
        group.append((shared, entry))
    if group:
        out += repeats_in(group)
    columns = list(zip(*out, strict=True)) or [(), (), (), ()]
    longs = [pa.array(np.array(c, np.uint64).view(np.int64), pa.int64()) for c in columns[:2]]
    return pa.table([*longs, *(pa.array(c, pa.int32()) for c in columns[2:])], names=["h", "s", "first", "last"])


def hot_repeats(runs: DataFrame) -> DataFrame:
    """Windows of hot prefixes, dealt by their digests -> (h, s, first, last), a row for each repeated window."""
    suffixes = runs.where("bucket < 0").groupBy("h", "s").agg((F.max("twice") | (F.count("*") > 1)).alias("twice"), F.first("windows").alias("windows"))
    suffixes = written(suffixes, "suffix-hot")  # read twice below
    rows = suffixes.select("h", "s", "twice", F.posexplode("windows").alias("first", "w"))
    again = rows.groupBy("h", "w").agg(F.count("*").alias("n"), F.max("twice").alias("t")).where("n > 1 OR t").select("h", "w")
    return rows.join(again, ["h", "w"]).select("h", "s", F.col("first").cast("int"), F.col("first").cast("int").alias("last"))


def places_of(texts: DataFrame, maybe) -> DataFrame:
    """(r, start, h, s): where the suffixes stand; start is that of the suffix's first window."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, skipped, a in scanned(batches, 1):
            if batch.num_rows and len(a.gram):
                keep = np.flatnonzero(maybe_in(maybe.value, a.gram))
                start = a.first[keep] + skipped - a.bounds[a.row[keep]]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(a.row[keep])), pa.array(start), pa.array(a.gram[keep].view(np.int64)), pa.array(a.suffix[keep].view(np.int64))], names=["r", "start", "h", "s"])

    return texts.mapInArrow(scan, "r long, start long, h long, s long")


def repeated_spans(documents: DataFrame) -> DataFrame:
    """documents (doc_id, text) -> (r, spans): array of (start, end) of repeated bytes for each row that has any; r is the
    64-bit hash of doc_id and text."""
    texts = documents.select(F.xxhash64("doc_id", "text").alias("r"), "text")
    sc = documents.sparkSession.sparkContext
    prefixes = repeated_prefixes(texts)
    maybe = sc.broadcast(bit_table(prefixes.select("h"), TABLE_BITS))
    hot = sc.broadcast(bit_table(prefixes.where(F.col("suffixes") > HOT).select("h"), TABLE_BITS >> 3))
    total = prefixes.agg(F.sum("suffixes")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET))
    runs = runs_of(texts, maybe, hot, buckets)
    cold = runs.where("bucket >= 0").select("bucket", "run").groupBy("bucket").applyInArrow(merge_bucket, "h long, s long, first int, last int")
    repeats = cold.union(hot_repeats(runs)) if prefixes.where(F.col("suffixes") > HOT).limit(1).count() else cold
    placed = places_of(texts, maybe).join(written(repeats, "suffix-repeats"), ["h", "s"])
    spans = placed.select("r", F.struct((F.col("start") + F.col("first")).alias("a"), (F.col("start") + F.col("last") + LENGTH).alias("b")).alias("span"))
    # a row's spans: at most its bytes / LENGTH * 3
    return spans.groupBy("r").agg(F.sort_array(F.collect_set("span")).alias("spans"))


def joined_spans(spans: list | None) -> list[tuple[int, int]]:
    """Sorted spans, overlapping and touching ones joined."""
    out: list[list[int]] = []
    for x in spans or []:
        if out and x["a"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], x["b"])
        else:
            out.append([x["a"], x["b"]])
    return out


def deduplicated(documents: DataFrame) -> DataFrame:
    """documents (doc_id, text) -> doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    documents = own_columns(documents, ["doc_id", "text"])
    spans = repeated_spans(documents)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, 1):
            out = []
            for text, found in zip(batch.column(1).cast(pa.binary()) if batch.num_rows else [], batch.column(2), strict=True):
                data, joined = text.as_py() or b"", joined_spans(found.as_py())
                digest, at = hashlib.sha256(), 0
                for a, b in joined:
                    digest.update(data[at:a])
                    at = b
                digest.update(data[at:])
                out.append((len(data), sum(b - a for a, b in joined), len(joined), digest.hexdigest()))
            n_bytes, removed, n_spans, sha = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (n_bytes, removed, n_spans)), pa.array(sha)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = documents.withColumn("r", F.xxhash64("doc_id", "text")).join(spans, "r", "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(cut, f"doc_id {dict(documents.dtypes)['doc_id']}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut_documents(documents: DataFrame) -> DataFrame:
    """The documents without their repeated bytes, with all columns; n_chars, where there is one, follows the text. A character
    goes if all its bytes go. Null text stays null, and texts of which nothing is left stay as empty ones."""
    spans = repeated_spans(documents.select("doc_id", "text"))

    @F.pandas_udf("string")
    def cut(texts, found):  # noqa: ANN001, ANN202
        out = []
        for text, spans_ in zip(texts, found, strict=True):
            if text is None or spans_ is None:
                out.append(text)
                continue
            data, at, parts = text.encode(), 0, []
            for a, b in joined_spans(list(spans_)):
                while a < len(data) and data[a] & 0xC0 == 0x80:
                    a += 1
                while b < len(data) and data[b] & 0xC0 == 0x80:
                    b -= 1
                parts.append(data[at : max(a, at)])
                at = max(at, a, b)
            out.append(b"".join([*parts, data[at:]]).decode())
        import pandas as pd

        return pd.Series(out, dtype=object)

    names = documents.columns
    key = "r"
    while key in names:
        key += "_"
    packed = documents.select(F.xxhash64("doc_id", "text").alias("r"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")).join(spans, "r", "left")
    text = cut(F.col("row.text"), F.col("spans"))
    out = packed.select("row", text.alias("cut"))
    return out.select(*[F.col("cut").alias("text") if c == "text" else F.length("cut").cast(dict(documents.dtypes)[c]).alias(c) if c == "n_chars" else F.col(f"row.`{c}`").alias(c) for c in names])
