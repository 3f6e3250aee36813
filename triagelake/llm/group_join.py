"""N-gram Jaccard join by grouped prefixes.

A document's set are its distinct word shingles as 64-bit hashes. Documents with equal sets form a class. Sets are ordered
rare shingles first (shingles seen often come last, in order of their counts, so that common lines stay out of prefixes);
a set of n elements has a prefix of n - ceil(t * n) + 1, and sets that reach similarity t share an element of their prefixes.
Classes with identical prefix and size form a group, and the prefix index holds groups:

1. every group meets one partner, that of the index entries that they share most often; its classes are verified against that
   partner's first class, and classes inside a group against the group's first class. An entry's partner is the group with the
   most elements after the shared one: copies with changes of their own have those before the shared elements, the text they
   were made from has not;
2. what those links have connected needs no further look: only pairs that stand in one index entry but in different
   components remain. They are found between groups: of an entry's components the one with the most groups only meets the
   other ones' groups, so an entry costs little more than its pairs between components. Pairs of groups pass the size and
   position filters, a pair known to share an earlier prefix element is left to that element's entry, and each pair is kept
   once. Expanded to classes, they pass a bound by bitmaps: a set is folded into PARITY bits, each the parity of the elements
   that fall on it, and two sets differ in as many elements at least as their bitmaps in bits. PARITY bits say little about
   long sets, so those have a second bitmap whose width grows with the set; a wider one folds to the width of the other;
3. of these pairs each class first verifies the one with the fewest differing bits, and then all that are still in different
   components are verified.

So a large group of near copies costs one comparison a member, not one a pair, and no link between components is lost.
Sets are looked up for candidates only: a bit table of fixed size tells the scan which classes may be candidates. Another one
lets only one document of each group into the index, so copies add no entries, wherever they lie. A partner's text is sent once
for each block of MEMBERS members.

Defined cases: null or empty text, or text without words, has an empty set, n_shingles 0 and links with nothing; fewer words
than a shingle count as one shingle of the whole sequence; repeated rows and repeated or null doc_ids are members of their
class like any other (component_id is the smallest non-null doc_id, null if there is none); an empty table gives an empty
result; extra columns are ignored. Sets, classes and groups are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .bit_table import bit_table, maybe_in
from .components import components
from .shared import own_columns, written

SHINGLE = 5
#: Similarity as a fraction, 4 / 5.
NUM, DEN = 4, 5
#: The list of frequent shingles: its length, and what a task reports from each CHUNK of shingles.
FREQUENT, REPORTED, CHUNK, OFTEN = 1 << 16, 1 << 13, 1 << 22, 8
#: Bits of a set's bitmap, in words of 64.
PARITY = 1024
#: Sets of more elements have a bitmap of their own width too, of 2 to 4 bits an element; rows whose bitmaps are made at once.
LONG, MAPPED = 256, 512
#: Prefix elements that rows carry with their positions, to see whether a pair meets in an earlier entry: the first frequent
#: ones, as a text's own rare shingles are in no other prefix, else the first of all.
EARLY = 4
#: Members that one copy of their partner's text is compared with.
MEMBERS = 256
#: Bytes of text of either side that are compared at once.
COMPARED = 1 << 20
#: Bytes of text whose sets are made at once in a scan; the work arrays are many times as large.
SCANNED = 1 << 20
#: Parts of a frequent element's entries.
SPREAD = 64
#: Sizes of one bucket lie within this ratio. A wider one copies a row into fewer buckets and compares more sizes that don't fit.
SIZE_RATIO = 2.0
#: Bits of the candidate table (2 MB at most); with more candidates it only lets more classes through.
BITS = 1 << 24


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct shingle hashes in ascending order, and the number of hashes before each row."""
    data, bounds = K.text_bytes(column, lower=True)
    starts, ends, before = K.word_bounds(data, bounds)
    words, rows, n_words = K.span_hashes(data, starts, ends), K.rows_of(before), np.diff(before)
    full = K.window_hashes(words, SHINGLE)
    counts = np.where(n_words >= SHINGLE, n_words - SHINGLE + 1, (n_words > 0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(counts)])
    whole = n_words[K.rows_of(at)] < SHINGLE
    out = np.empty(at[-1], np.uint64)
    if len(full):
        out[~whole] = full[rows[SHINGLE - 1 :] == rows[: len(full)]]
    for n in range(1, SHINGLE):
        few = np.flatnonzero(n_words == n)
        value = np.full(len(few), n, np.uint64)
        for i in range(n):
            value = K.mixed(value + words[before[few] + i])
        out[at[few]] = value
    for i in range(len(counts)):
        out[at[i] : at[i + 1]].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[at[:-1][counts > 0]] = True
    return out[new], np.concatenate([[0], np.cumsum(K.segment_sums(new, at))])


def set_keys(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of each row's set."""
    return K.mixed(K.segment_sums(K.mixed(sets), at) + np.diff(at).astype(np.uint64))


def frequent_shingles(documents: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The FREQUENT most common shingles in ascending order of hash, and their rank by count. Only steers the order, never the result."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def report() -> pa.RecordBatch:
            values = np.concatenate(held)
            held.clear()
            values.sort()  # in place: a chunk's copies would be the largest arrays of the scan
            first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
            counts = np.diff(np.append(first, len(values)))
            often = np.flatnonzero(counts >= OFTEN)
            often = often[np.argsort(-counts[often], kind="stable")[:REPORTED]]
            return pa.RecordBatch.from_arrays([pa.array(values[first[often]].view(np.int64)), pa.array(counts[often].astype(np.int64))], names=["h", "n"])

        for batch in K.slices(batches, 0, SCANNED):
            held.append(shingle_sets(batch.column(0))[0])
            if sum(map(len, held)) >= CHUNK:
                yield report()
        if held:
            yield report()

    top = documents.select("text").mapInArrow(scan, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(FREQUENT).collect()
    h = np.array([r["h"] for r in top], np.int64).view(np.uint64)
    rank = np.arange(len(top), 0, -1)
    order = np.argsort(h)
    return h[order], rank[order]


class Order:
    """Rare shingles by hash, then frequent ones by count."""

    def __init__(self, frequent: np.ndarray, rank: np.ndarray) -> None:
        self.frequent, self.rank = frequent, rank
        self.near = np.zeros(1 << 20, bool)
        self.near[frequent & np.uint64((1 << 20) - 1)] = True

    def ranks(self, sets: np.ndarray) -> np.ndarray:
        """0 for rare shingles."""
        out = np.zeros(len(sets), np.int64)
        maybe = np.flatnonzero(self.near[sets & np.uint64((1 << 20) - 1)])
        if len(maybe):
            i = np.minimum(np.searchsorted(self.frequent, sets[maybe]), len(self.frequent) - 1)
            hit = self.frequent[i] == sets[maybe]
            out[maybe[hit]] = self.rank[i[hit]]
        return out

    def prefixes(self, sets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Elements of all prefixes, the number before each row, and whether each is frequent."""
        ranks, n = self.ranks(sets), np.diff(at)
        length = np.where(n > 0, n - -(-NUM * n // DEN) + 1, 0)
        parts, flags = [], []
        rare = K.segment_sums(ranks == 0, at)
        for i in np.flatnonzero(n):
            s, m = sets[at[i] : at[i + 1]], length[i]
            if rare[i] < n[i]:
                order = np.argsort(ranks[at[i] : at[i + 1]], kind="stable")[:m]
                parts.append(s[order])
                flags.append(ranks[at[i] : at[i + 1]][order] > 0)
            else:
                parts.append(s[:m])
                flags.append(np.zeros(m, bool))
        join = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
        return join(parts, np.uint64), np.concatenate([[0], np.cumsum(length)]), join(flags, bool)


def bitmaps(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """PARITY / 64 words for each row: the parities of its elements by place."""
    out = np.zeros((len(at) - 1, PARITY // 64), np.int64)
    for low in range(0, len(out), MAPPED):
        own = at[low : low + MAPPED + 1]
        places = (K.mixed(sets[own[0] : own[-1]] + np.uint64(5)) % np.uint64(PARITY)).astype(np.int64)
        counts = np.bincount(K.rows_of(own - own[0]) * PARITY + places, minlength=(len(own) - 1) * PARITY)
        out[low : low + MAPPED] = np.packbits((counts & 1).astype(np.uint8).reshape(-1, PARITY), axis=1, bitorder="little").view(np.int64)
    return out


def wide_bitmaps(sets: np.ndarray, at: np.ndarray) -> list[bytes | None]:
    """The same for sets of over LONG elements, as wide as the power of two from twice their size on; None for shorter ones."""
    out: list[bytes | None] = []
    for low, high in zip(at[:-1].tolist(), at[1:].tolist()):
        width = 1 << (2 * (high - low) - 1).bit_length() if high - low > LONG else 0
        places = (K.mixed(sets[low:high] + np.uint64(5)) & np.uint64(width - 1)).astype(np.int64) if width else None
        out.append(np.packbits((np.bincount(places, minlength=width) & 1).astype(np.uint8), bitorder="little").tobytes() if width else None)
    return out


def differing(x: bytes, y: bytes) -> int:
    """Bits in which two bitmaps differ, at the width of the narrower one."""
    a, b = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _keys(order: Order, column: pa.Array) -> tuple:
    sets, at = shingle_sets(column)
    prefix, pre_at, frequent = order.prefixes(sets, at)
    n = np.diff(at)
    return set_keys(sets, at), K.mixed(K.segment_sums(K.mixed(prefix), pre_at) * np.uint64(3) + n.astype(np.uint64)), n, prefix, pre_at, frequent, sets, at


BITMAP = [f"b{i}" for i in range(PARITY // 64)]
FIRST = [f"{c}{i}" for i in range(EARLY) for c in "fp"]


def classified(documents: DataFrame, order: Order) -> DataFrame:
    """(doc_id, r, n, k, g, b0..., wide): set size, class, group, bitmaps and first prefix elements of each document; k and g are null for empty sets."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, 2, SCANNED):
            k, g, n, prefix, pre_at, frequent, sets, at = _keys(order, batch.column(2))
            rows = K.rows_of(pre_at)
            chosen = frequent | (K.segment_sums(frequent, pre_at) == 0)[rows]
            at_chosen = np.flatnonzero(chosen)
            sel = np.concatenate([[0], np.cumsum(K.segment_sums(chosen, pre_at))])
            first = []
            for i in range(EARLY):
                none = sel[:-1] + i >= sel[1:]
                where = np.append(at_chosen, 0)[np.where(none, len(at_chosen), sel[:-1] + i)]
                token = np.append(prefix, 0).astype(np.uint64)[np.where(none, len(prefix), where)].view(np.int64)
                first += [(token, none), (where - pre_at[:-1], none)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(n.astype(np.int64)), *(pa.array(x.view(np.int64), mask=n == 0) for x in (k, g)), *map(pa.array, bitmaps(sets, at).T), *(pa.array(x, mask=none) for x, none in first), pa.array(wide_bitmaps(sets, at), pa.binary())], names=["doc_id", "r", "n", "k", "g", *BITMAP, *FIRST, "wide"])

    return documents.select("doc_id", F.xxhash64("doc_id", "text").alias("r"), "text").mapInArrow(scan, f"doc_id {dict(documents.dtypes)['doc_id']}, r long, n long, k long, g long, " + ", ".join(f"{b} long" for b in BITMAP + FIRST) + ", wide binary")


def prefix_index(documents: DataFrame, order: Order, groups: DataFrame) -> DataFrame:
    """(token, g, place, frequent) of one document of each group, r in groups; place is size * 2**24 + position. Rows that the
    bit table lets through by chance repeat entries."""
    only = documents.sparkSession.sparkContext.broadcast(bit_table(groups.select("r"), BITS))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # groups of this partition
        for whole in batches:
            rows = whole.column(0).to_numpy(zero_copy_only=False)
            chosen = whole.take(pa.array(np.flatnonzero(maybe_in(only.value, rows.view(np.uint64))), pa.int64()))
            for batch in K.slices(iter([chosen]), 1, SCANNED):
                _, g, n, prefix, pre_at, frequent, *_ = _keys(order, batch.column(1))
                new = np.zeros(len(n), bool)
                for i in np.flatnonzero(n):
                    if g[i] not in seen:
                        seen.add(g[i])
                        new[i] = True
                rows = K.rows_of(pre_at)
                keep = new[rows]
                place = (n[rows] << 24) + (np.arange(len(rows)) - pre_at[rows])
                yield pa.RecordBatch.from_arrays([pa.array(prefix[keep].view(np.int64)), pa.array(g.view(np.int64)[rows[keep]]), pa.array(place[keep]), pa.array(frequent[keep])], names=["token", "g", "place", "frequent"])

    return documents.select(F.xxhash64("doc_id", "text").alias("r"), "text").mapInArrow(scan, "token long, g long, place long, frequent boolean")


def shared_entries(index: DataFrame) -> DataFrame:
    """(token, g, place, partner): entries that several groups share, each once, with the group that has most elements after the token."""
    # one scan for both kinds: a rare token's entries lie together, a frequent one's are dealt over SPREAD parts
    part = F.when(F.col("frequent"), F.pmod("g", F.lit(SPREAD))).otherwise(0).alias("part")
    dealt = index.select("token", part, "g", "place", "frequent").repartition("token", "part")
    together = Window.partitionBy("token", "part")
    once = dealt.groupBy("token", "part", "g").agg(F.first("place").alias("place"), F.first("frequent").alias("frequent"))
    after = F.shiftright("place", 24) - F.col("place").bitwiseAND((1 << 24) - 1)
    spans = once.withColumns({"low": F.min("g").over(together), "high": F.max("g").over(together), "most": F.max(after).over(together)})
    central = F.min(F.when(after == F.col("most"), F.col("g"))).over(together)
    met = written(spans.where("frequent OR low <> high").withColumn("partner", central).drop("part"), "join-met")
    # at most FREQUENT rows: the tokens come from the frequent list
    ends = met.where("frequent").groupBy("token").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min(F.struct(-F.col("most"), "partner"))["partner"].alias("partner")).where("low <> high").select("token", "partner")
    hot = met.where("frequent").drop("partner").join(F.broadcast(written(ends, "join-ends")), "token")
    return met.where("NOT frequent").select("token", "g", "place", "partner").union(hot.select("token", "g", "place", "partner"))


def differ(x: str, y: str) -> str:
    """Differing bits of two rows' bitmaps of PARITY bits."""
    return " + ".join(f"bit_count({x}.{b} ^ {y}.{b})" for b in BITMAP)


def bounded(x: str, y: str) -> str:
    """Whether those bitmaps leave a link possible: linked sets differ in at most (DEN - NUM) / (DEN + NUM) of their sizes' sum."""
    return f"{DEN + NUM} * ({differ(x, y)}) <= {DEN - NUM} * ({x}.n + {y}.n)"


def near(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """pairs (a, b) of classes -> (a, b, differ): those that the bitmaps of either kind don't rule out, and in how many bits they differ."""
    of = lambda name, side: classes.select(F.col("k").alias(name), F.struct("n", *BITMAP, "wide").alias(side))
    met = pairs.select("a", "b").join(of("a", "x"), "a").join(of("b", "y"), "b").where(bounded("x", "y"))

    def narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("wx"), batch.column("wy")
            n, bits = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n", "differ"))
            for i in np.flatnonzero(x.is_valid().to_numpy(zero_copy_only=False) & y.is_valid().to_numpy(zero_copy_only=False)):
                bits[i] = differing(x[i].as_py(), y[i].as_py())
            keep = pa.array((DEN + NUM) * bits <= (DEN - NUM) * n)
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in (batch.column("a"), batch.column("b"), pa.array(bits))], names=["a", "b", "differ"])

    chosen = met.select("a", "b", F.expr("x.n + y.n").alias("n"), F.expr(differ("x", "y")).cast("long").alias("differ"), F.col("x.wide").alias("wx"), F.col("y.wide").alias("wy"))
    return chosen.mapInArrow(narrowed, "a long, b long, differ long")


def verified(documents: DataFrame, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """pairs (a, b) of classes -> a, b, na, nb, common, from the texts of one document of each class. Texts travel instead of
    sets, which are larger and don't compress."""
    of = lambda name: classes.select(F.col("k").alias(name), F.col("stays.r").alias(f"r{name}"))
    pairs = written(pairs.join(of("a"), "a").join(of("b"), "b"), "join-pairs")
    shared = documents.sparkSession.sparkContext.broadcast(bit_table(pairs.select(F.explode(F.array("ra", "rb")).alias("r")).distinct(), BITS))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # fully repeated rows of this partition
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            keep = []
            for i in np.flatnonzero(maybe_in(shared.value, rows.view(np.uint64))):
                if rows[i] not in seen:
                    seen.add(rows[i])
                    keep.append(i)
            if keep:
                yield batch.take(pa.array(keep, pa.int64()))

    # written, so that the documents are read once for both sides, and no task has this Python map and the comparing one at a time
    texts = written(documents.select(F.xxhash64("doc_id", "text").alias("r"), "text").mapInArrow(scan, "r long, text string"), "join-texts")
    # members travel to their partner, whose text is there once a block
    blocks = pairs.groupBy("rb").agg(F.ceil(F.count("*") / MEMBERS).alias("blocks"))
    dealt = pairs.join(blocks, "rb").select("a", "b", "ra", "rb", F.pmod(F.xxhash64("ra"), "blocks").alias("block"))
    with_a = dealt.join(texts.select(F.col("r").alias("ra"), F.col("text").alias("ta")), "ra")
    partners = blocks.join(texts.select(F.col("r").alias("rb"), F.col("text").alias("tb")), "rb").select("rb", "tb", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    both = with_a.join(partners, ["rb", "block"]).select("a", "b", "ta", "tb")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for half in K.slices(batches, 2, COMPARED):
            for batch in K.slices(iter([half]), 3, COMPARED):
                (x, x_at), (y, y_at) = (shingle_sets(batch.column(c)) for c in (2, 3))
                x_rows, y_rows = K.rows_of(x_at), K.rows_of(y_at)
                key, at, _ = np.intersect1d(x ^ K.mixed(x_rows + 1), y ^ K.mixed(y_rows + 1), assume_unique=True, return_indices=True)
                counts = np.bincount(x_rows[at], minlength=batch.num_rows)
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(c.astype(np.int64)) for c in (np.diff(x_at), np.diff(y_at), counts))], names=["a", "b", "na", "nb", "common"])

    return written(both.mapInArrow(compare, "a long, b long, na long, nb long, common long"), "join-verified")


LINKED = f"{DEN} * common >= {NUM} * (na + nb - common)"


def open_groups(entries: DataFrame, groups: DataFrame, rooted: DataFrame) -> DataFrame:
    """(ga, gb): different pairs of groups that may hold a link between components; a group of several components with itself."""
    spans = rooted.groupBy("g").agg(F.min("root").alias("r1"), F.max("root").alias("r2"))
    placed = written(entries.join(spans, "g").select("token", "g", "place", "r1", "r2"), "join-placed")
    # an entry's components, and of those that groups have to themselves the one with the most groups
    sizes = placed.groupBy("token", "r1").agg(F.max("r2").alias("r2"), F.count_if(F.expr("r1 = r2")).alias("n"))
    mostly = sizes.groupBy("token").agg(F.min("r1").alias("low"), F.max("r2").alias("high"), F.max_by("r1", F.struct("n", "r1")).alias("most")).where("low <> high").select("token", "most")
    # written between the joins, so that one join's shuffles are gone when the next one's are made
    rows = placed.join(written(mostly, "join-mostly"), "token").join(groups.select("g", *FIRST), "g")
    n = F.shiftright("place", 24)
    bucket = lambda size: F.floor(F.log(size) / F.log(F.lit(SIZE_RATIO)))
    rows = rows.select("token", "g", "r1", "r2", n.alias("n"), F.col("place").bitwiseAND((1 << 24) - 1).alias("pos"), F.expr("r1 <> r2 OR r1 <> most").alias("other"), bucket(n).alias("bucket"), *FIRST)
    rows = written(rows, "join-open-entries")
    # the buckets of the sizes that fit, from the smallest to the largest
    fitting = F.sequence(bucket(F.expr(f"(n * {NUM} + {DEN - 1}) div {DEN}")), bucket(F.expr(f"n * {DEN} div {NUM}")))
    x = rows.where("other").withColumn("bucket", F.explode(fitting)).alias("x")
    y = rows.alias("y")
    earlier = " OR ".join(f"(x.p{i} < x.pos AND y.p{j} < y.pos AND x.f{i} = y.f{j})" for i in range(EARLY) for j in range(EARLY))
    met = x.join(y, F.expr(f"""
        x.token = y.token AND x.bucket = y.bucket
        AND x.g <> y.g AND (NOT y.other OR x.g < y.g)
        AND NOT (x.r1 = y.r2 AND x.r2 = y.r1)
        AND {NUM} * greatest(x.n, y.n) <= {DEN} * least(x.n, y.n)
        AND {DEN + NUM} * least(x.n - x.pos, y.n - y.pos) >= {NUM} * (x.n + y.n)
        AND NOT coalesce({earlier}, false)
    """))  # fmt: skip
    own = spans.where("r1 <> r2").select(F.col("g").alias("ga"), F.col("g").alias("gb"))
    return met.select(F.least("x.g", "y.g").alias("ga"), F.greatest("x.g", "y.g").alias("gb")).distinct().union(own)


def open_parts(pairs: DataFrame, rooted: DataFrame) -> DataFrame:
    """Pairs of groups -> (gx, rx, gy, ry): their pairs of different components."""
    parts = rooted.select("g", "root").distinct()
    part = lambda side: parts.select(F.col("g").alias(f"g{side}"), F.col("root").alias(f"r{side}"))
    met = pairs.select(F.col("ga").alias("gx"), F.col("gb").alias("gy")).join(part("x"), "gx").join(part("y"), "gy")
    return met.where("rx <> ry AND (gx <> gy OR rx < ry)")


def open_classes(pairs: DataFrame, rooted: DataFrame) -> DataFrame:
    """Pairs of groups -> (a, b, differ): their pairs of classes of different components that the bitmaps don't rule out.

    Groups meet by component first, so only the classes outside the partner's component are expanded.
    """
    of = lambda side: rooted.select(F.col("g").alias(f"g{side}"), F.col("root").alias(f"r{side}"), F.struct("k", "n", *BITMAP).alias(side))
    ends = open_parts(pairs, rooted).join(of("x"), ["gx", "rx"]).join(of("y"), ["gy", "ry"]).where(bounded("x", "y"))
    return ends.select(F.col("x.k").alias("a"), F.col("y.k").alias("b"), F.expr(differ("x", "y")).alias("differ"))


def joined(documents: DataFrame) -> DataFrame:
    """documents (doc_id, text) -> doc_id, r, n_shingles, component_id, stays; r is the hash of doc_id and text, and `stays` the
    r of the one document of the component that stays: the smallest doc_id's."""
    order = Order(*frequent_shingles(documents))
    members = written(classified(documents, order), "join-members")
    classes = written(members.where("n > 0").groupBy("k").agg(F.min("g").alias("g"), F.min("n").alias("n"), F.min("doc_id").alias("low"), F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "r")).alias("stays"), *[F.first(b).alias(b) for b in [*BITMAP, *FIRST, "wide"]]), "join-classes")
    # size and prefix are the group's, so are its first elements
    groups = written(classes.groupBy("g").agg(F.min("k").alias("first"), F.max("k").alias("last"), F.min("n").alias("n"), F.min("stays.r").alias("r"), *[F.first(c).alias(c) for c in FIRST]), "join-groups")
    entries = shared_entries(prefix_index(documents, order, groups))
    # a group of several classes is an entry of its own
    inside = groups.where("first <> last").select(F.col("g").alias("token"), "g", F.shiftleft("n", 24).alias("place"), F.col("g").alias("partner"))

    first = groups.select(F.col("g").alias("partner"), F.col("first").alias("b"), F.col("n").alias("partner_n"))
    shares = entries.union(inside).groupBy("g", "partner", F.shiftright("place", 24).alias("n")).agg(F.count("*").alias("times"))
    own = shares.where("g = partner").select("g", "partner")
    best = shares.where("g <> partner").join(first, "partner").where(f"{NUM} * greatest(n, partner_n) <= {DEN} * least(n, partner_n)").groupBy("g").agg(F.max_by("partner", F.struct("times", "partner")).alias("partner"))
    chosen = own.union(best).distinct().join(first, "partner").join(classes.select("g", F.col("k").alias("a")), "g")
    one = verified(documents, near(written(chosen.where("a <> b").select("a", "b").distinct(), "join-chosen"), classes).select("a", "b"), classes)
    links = one.where(LINKED).select("a", "b")
    roots = written(components(links), "join-roots")

    rooted = written(classes.join(roots, F.col("k") == F.col("node"), "left").select("k", "g", "n", F.coalesce("root", "k").alias("root"), *BITMAP), "join-rooted")
    pairs = written(near(written(open_classes(open_groups(entries, groups, rooted), rooted), "join-bounded"), classes), "join-open")
    best = pairs.groupBy("a").agg(F.min(F.struct("differ", "b"))["b"].alias("b")).union(pairs.groupBy("b").agg(F.min(F.struct("differ", "a"))["a"].alias("a")).select("a", "b")).distinct()
    best = written(best, "join-best")
    links = written(links.union(verified(documents, best, classes).where(LINKED).select("a", "b")), "join-links")
    of = written(components(links), "join-roots")
    root = lambda name: of.select(F.col("node").alias(name), F.col("root").alias(f"r{name}"))
    rest = pairs.select("a", "b").join(best, ["a", "b"], "left_anti").join(root("a"), "a", "left").join(root("b"), "b", "left")
    rest = rest.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")
    roots = components(links.union(verified(documents, rest, classes).where(LINKED).select("a", "b")))

    placed = classes.join(roots, F.col("k") == F.col("node"), "left").select("k", "low", "stays", F.coalesce("root", "k").alias("root"))
    low = placed.groupBy("root").agg(F.min("low").alias("component_id"), F.min("stays")["r"].alias("stays"))
    labels = placed.select("k", "root").join(low, "root").select("k", "component_id", "stays")
    return members.join(labels, "k", "left").select("doc_id", "r", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "stays")


def linked(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id."""
    return joined(own_columns(documents, ["doc_id", "text"])).select("doc_id", "n_shingles", "component_id")


def representatives(documents: DataFrame) -> DataFrame:
    """One document of each component with all its columns: that of the smallest doc_id. Documents without words all stay."""
    found = joined(own_columns(documents, ["doc_id", "text"]))
    keep = found.where("n_shingles = 0 OR r = stays").select("r", (F.col("n_shingles") > 0).alias("one")).distinct()
    rows = documents.select(F.xxhash64("doc_id", "text").alias("r"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")).join(keep, "r")
    # of fully repeated rows one; for unique rows the window has one row each, in the join's own partitions
    return rows.withColumn("i", F.row_number().over(Window.partitionBy("r").orderBy("r"))).where("i = 1 OR NOT one").select("row.*")
