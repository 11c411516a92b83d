"""SimHash near-duplicates: fingerprints, generalised pigeonhole search, components.

Two 64-bit fingerprints within ``tau`` bits of each other, cut into m
partitions, must be within t_i bits in some partition i whenever the sum of the
(t_i + 1) is tau + 1.  Bits that go together across the corpus are grouped into
the same partition; for each m the thresholds t_i (-1: the partition isn't
used) come from dynamic programming on estimated candidate counts, and the
cheapest m is taken.  A fingerprint's partition value, with up to t_i of its
set bits cleared, are its probe keys: any two values within t_i bits share one.
Fingerprints with a key in common are compared as a whole.

Equal fingerprints are one row from the start.  The rows of a key that many
share are cut into blocks and compared block by block in separate tasks, and a
task returns links that span what it found connected, not all pairs, so that no
key makes a task, its memory or its output grow without bound.  Connected
components come from alternating large-star and small-star steps on written
tables.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship

ship(__name__)

BITS = 64
#: Rows of a block; a task compares two blocks.
BLOCK = 1024
#: Runs up to this length are compared by shifting whole columns, longer ones as a matrix.
SHORT_RUN = 16
#: Estimated cost of a probe row, in compared pairs.
ROW_COST = 500.0
#: Partitions tried at most; tau + 1 exact partitions need no probes.
HISTOGRAM_BITS = 8


# -- fingerprints ------------------------------------------------------------------------------------------------------


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of ``words`` words, lower-cased A-Z, space-joined; repeats included."""
    import xxhash

    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], dtype=np.uint64)
    lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    ends = (starts + lengths)[words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], 42) for s, e in zip(starts.tolist(), ends)], dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> np.uint64:
    """Bit b is set if it is set in over half the hashes; 0 if there are none."""
    if not len(hashes):
        return np.uint64(0)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(hashes), bitorder="little").view("<u8")[0]


def fingerprints(docs: DataFrame, row_id: str, id_col: str, text_col: str, words: int) -> DataFrame:
    """(row_id, doc_id, fp); fp is the fingerprint's 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(shingle_hashes(t.as_py(), words)) for t in batch.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], names=["row_id", "doc_id", "fp"]
            )

    rows = docs.select(F.col(row_id).alias("row_id"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "row_id long, doc_id long, fp long")


# -- the search plan ---------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Partition:
    """Some of the bits, and the distance up to which values of them are matched (-1: unused)."""

    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        return sum(1 << b for b in self.bits)

    def keys(self, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, keys): the masked value with up to ``threshold`` set bits cleared."""
        value = fps & np.uint64(self.mask)
        for n in range(self.threshold + 1):
            for cleared in itertools.combinations(self.bits, n):
                off = np.uint64(sum(1 << b for b in cleared))
                rows = np.flatnonzero((value & off) == off)
                yield rows, value[rows] & ~off


def _unpack(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints, and how often two bits are set together; 64 x 64 sums over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS), dtype=np.float64), 0
        for batch in batches:
            bits = _unpack(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)).astype(np.float32)
            total += bits.T @ bits
            n += len(bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(BITS * BITS + 1), pa.int32()), pa.array([*total.ravel().astype(np.int64).tolist(), n], pa.int64())],
            names=["cell", "n"],
        )

    out = np.zeros(BITS * BITS + 1)
    for row in fps.mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[row["cell"]] = row["n"]
    return int(out[-1]), out[:-1].reshape(BITS, BITS)


def group_bits(n: int, together: np.ndarray, m: int) -> list[tuple[int, ...]]:
    """m groups of nearly equal size; each starts with the most correlated pair left and takes in what fits it best."""
    mean = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    like = np.abs(cov / np.outer(scale, scale))
    np.fill_diagonal(like, 0)
    left, groups = list(range(BITS)), []
    for g in range(m):
        size = len(left) // (m - g)
        group = [left.pop(int(np.argmax(like[np.ix_(left, left)].max(axis=1))))]
        while len(group) < size:
            group.append(left.pop(int(np.argmax(like[np.ix_(left, group)].mean(axis=1)))))
        groups.append(tuple(sorted(group)))
    return groups


def value_histograms(fps: DataFrame, pieces: list[tuple[int, ...]]) -> list[np.ndarray]:
    """Counts of the values of each piece (``HISTOGRAM_BITS`` bits at most) over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(1 << len(p), dtype=np.int64) for p in pieces]
        for batch in batches:
            bits = _unpack(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)).astype(np.int64)
            for p, total in zip(pieces, totals):
                total += np.bincount(bits[:, p] @ (1 << np.arange(len(p))), minlength=len(total))
        for k, total in enumerate(totals):
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * len(total), pa.int32()), pa.array(range(len(total)), pa.int32()), pa.array(total)],
                names=["piece", "value", "n"],
            )

    out = [np.zeros(1 << len(p)) for p in pieces]
    rows = fps.mapInArrow(run, "piece int, value int, n long").groupBy("piece", "value").agg(F.sum("n").alias("n"))
    for row in rows.collect():
        out[row["piece"]][row["value"]] = row["n"]
    return out


def distance_shares(histogram: np.ndarray) -> np.ndarray:
    """The share of pairs of rows at each distance within the piece."""
    values = np.arange(len(histogram))
    distance = np.bitwise_count(values[:, None] ^ values[None, :])
    p = histogram / max(histogram.sum(), 1)
    return np.bincount(distance.ravel(), weights=np.outer(p, p).ravel())


def allocate(n: int, sizes: list[int], shares: list[np.ndarray], units: int) -> tuple[float, list[int]]:
    """Cost and thresholds: ``units`` = sum of (threshold + 1), by dynamic programming over the partitions.

    ``shares[i]``: the share of pairs at each distance within partition i.
    """

    def cost(i: int, unit: int) -> float:
        if not unit:
            return 0.0
        # about half the bits are set, and a key clears some of them
        rows = n * sum(math.comb(math.ceil(sizes[i] / 2), k) for k in range(unit))
        return ROW_COST * rows + 0.5 * n * n * float(shares[i][: 2 * unit - 1].sum())

    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for i in range(len(sizes)):
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (total, chosen) in best.items():
            for unit in range(units - used + 1):
                found = (total + cost(i, unit), [*chosen, unit - 1])
                if used + unit not in step or found < step[used + unit]:
                    step[used + unit] = found
        best = step
    return best[units]


def plan_search(fps: DataFrame, tau: int) -> list[Partition]:
    """The partitions and thresholds that cost least by estimate; any of them finds every link."""
    n, together = bit_counts(fps)
    cuts = {m: group_bits(n, together, m) for m in range(1, tau + 2)}
    pieces = {
        m: [[g[i : i + HISTOGRAM_BITS] for i in range(0, len(g), HISTOGRAM_BITS)] for g in groups] for m, groups in cuts.items()
    }
    flat = [p for groups in pieces.values() for g in groups for p in g]
    histograms = iter(value_histograms(fps, flat))
    plans = []
    for m, groups in cuts.items():
        shares = []
        for g in pieces[m]:
            share = np.ones(1)
            for _ in g:  # as if the pieces were independent
                share = np.convolve(share, distance_shares(next(histograms)))
            shares.append(share)
        cost, thresholds = allocate(n, [len(g) for g in groups], shares, tau + 1)
        plans.append((cost, m, [Partition(g, t) for g, t in zip(groups, thresholds)]))
    return min(plans, key=lambda p: p[:2])[2]


# -- probing and verifying ---------------------------------------------------------------------------------------------


def probe_keys(fps: DataFrame, partitions: list[Partition]) -> DataFrame:
    """(part, key, fp) rows of each fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at, partition in enumerate(partitions):
                for rows, keys in partition.keys(values):
                    if len(rows):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(rows), at, dtype=np.int32)),
                                pa.array(keys.view(np.int64)),
                                pa.array(values[rows].view(np.int64)),
                            ],
                            names=["part", "key", "fp"],
                        )

    return fps.mapInArrow(run, "part int, key long, fp long")


def spanning_links(fps: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (larger, smaller) that connect what fingerprints within ``tau`` bits connect."""
    fps = np.unique(fps)
    n = len(fps)
    near = np.empty((n, n), dtype=bool)
    for i in range(0, n, 256):
        near[i : i + 256] = np.bitwise_count(fps[i : i + 256, None] ^ fps[None, :]) <= tau
    root = np.full(n, -1)
    for i in range(n):
        if root[i] >= 0:
            continue
        new = near[i] & (root < 0)
        new[i] = True
        while new.any():
            root[new] = i
            new = near[new].any(axis=0) & (root < 0)
    others = np.flatnonzero(root != np.arange(n))
    return fps[others], fps[root[others]]


def run_links(unit: np.ndarray, fps: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal ``unit`` (sorted)."""
    edges = np.flatnonzero(np.diff(unit)) + 1
    starts = np.concatenate([[0], edges])
    lengths = np.diff(np.concatenate([starts, [len(unit)]]))
    length = np.repeat(lengths, lengths)
    found = []
    short = np.flatnonzero(length <= SHORT_RUN)
    u, f = unit[short], fps[short]
    for shift in range(1, SHORT_RUN):
        hit = np.flatnonzero((u[shift:] == u[:-shift]) & (np.bitwise_count(f[shift:] ^ f[:-shift]) <= tau))
        a, b = f[hit], f[hit + shift]
        found.append((np.maximum(a, b), np.minimum(a, b)))
    for i in np.flatnonzero(lengths > SHORT_RUN):
        found.append(spanning_links(fps[starts[i] : starts[i] + lengths[i]], tau))
    a, b = (np.concatenate(x) for x in zip(*found))
    differ = a != b
    return a[differ], b[differ]


def find_links(fps: DataFrame, partitions: list[Partition], tau: int) -> DataFrame:
    """(a, b), a > b as signed longs: links whose components are those of all links.

    ``fps``: a written table of distinct fingerprints.
    """
    probes = probe_keys(fps, partitions)
    crowded = materialize(
        probes.groupBy("part", "key").count().filter(F.col("count") > BLOCK), "simhash-crowded"
    ).select("part", "key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int")
    placed = (
        probes.join(crowded, ["part", "key"], "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("part", "key", F.least("own", "other"), F.greatest("own", "other")).alias("unit"), "fp"
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, fp = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)

        def links(u: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            a, b = (x.view(np.int64) for x in run_links(u, f, tau))
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])

        for batch in batches:
            unit = np.concatenate([unit, batch.column(0).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if len(unit):
                last = int(np.searchsorted(unit, unit[-1]))  # the last run may go on in the next batch
                if last:
                    yield links(unit[:last], fp[:last])
                unit, fp = unit[last:], fp[last:]
        if len(unit):
            yield links(unit, fp)

    # a unit's number is a hash: should two units share one, their rows are compared in one run, which is still right
    return placed.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "a long, b long").distinct()


# -- components --------------------------------------------------------------------------------------------------------


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component, for every node with a link that isn't the root itself.

    ``links``: (a, b) with a > b.  Each step is an aggregate and a join on a
    written table, so a node with very many links can be split.
    """
    edges = materialize(links, "links")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "large-star-min")
        edges = materialize(
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-star"
        )
        least = materialize(edges.groupBy("a").agg(F.min("b").alias("m")), "small-star-min")
        edges = materialize(
            edges.join(least, "a")
            .filter("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least)
            .distinct(),
            "small-star",
        )
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, tau: int = 4, row_id: str | None = None
) -> DataFrame:
    """One row per input row: row_id, doc_id, fp, component_id, kept.

    Rows are linked when their fingerprints differ in ``tau`` bits or fewer;
    ``component_id`` is the smallest id of all rows reachable (null ids come
    last, so it is null only where all are).  ``kept`` is true for one row of
    each component, one with that id.  A null or wordless text has fingerprint
    zero and is linked like any other.  Other columns are not read.

    ``row_id``: a column that numbers the rows of a written table; without it
    the rows are numbered here.
    """
    if row_id is None:
        row_id = "row_id"
        docs = docs.select(F.monotonically_increasing_id().alias("row_id"), id_col, text_col)
    rows = materialize(fingerprints(docs, row_id, id_col, text_col, words), "simhash-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id")).alias("first")
    distinct = materialize(rows.groupBy("fp").agg(first), "simhash-distinct")
    fps = distinct.select("fp")
    roots = components(find_links(fps, plan_search(fps, tau), tau))
    rooted = materialize(
        distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
            "fp", F.coalesce("root", "fp").alias("root"), "first"
        ),
        "simhash-roots",
    )
    heads = materialize(rooted.groupBy("root").agg(F.min("first").alias("head")), "simhash-heads")
    of_fp = materialize(rooted.join(heads, "root").select("fp", "head"), "simhash-components")
    return rows.join(of_fp, "fp").select(
        "row_id",
        "doc_id",
        "fp",
        F.col("head.doc_id").alias("component_id"),
        (F.col("row_id") == F.col("head.row_id")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, tau: int = 4) -> DataFrame:
    """``docs`` with one row of each component, all columns as they were."""
    numbered = materialize(
        docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("nr")),
        "simhash-docs",
    )
    flat = numbered.select("nr", F.col("doc")[id_col].alias("doc_id"), F.col("doc")[text_col].alias("text"))
    kept = near_duplicates(flat, "doc_id", "text", words, tau, row_id="nr").filter("kept").select(F.col("row_id").alias("nr"))
    return numbered.join(kept, "nr", "left_semi").select("doc.*")


def fingerprint_hex(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
