"""Periodic runs of words, found on a grammar of the text (Re-Pair).

A run is a maximal stretch of consecutive words with smallest period q (words
q apart are equal) of at least ``repeats`` periods and ``least`` words.  Per
document:

1. words become numbers, and Re-Pair replaces the most frequent pair of
   neighbours by a new nonterminal until no pair is frequent enough to lie
   inside a run; what no pair can join (a pair of words that is too rare from
   the start) ends a stretch, since no run goes over it;
2. for every nonterminal X -> Y Z the runs that cross the boundary of Y and Z
   are computed once, on one place of X in the text.  The rest of a stretch,
   a sequence in which no pair repeats, is halved again and again, each half's
   boundary being one more nonterminal with a single place;
3. runs of X are translated to every place that X has in the derivation, and
   intervals of one period that overlap by a period or more are merged, so
   that a run cut off at X's ends gives way to the whole one.

Every run crosses the boundary of the smallest node that contains it, so none
is missed.  Documents are independent: no shuffle, and a task holds one
document's words at a time.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

ship(__name__)

#: Least number of periods, and of words, of a run.
REPEATS, LEAST = 4, 6
#: Bytes of text that an output batch holds before it is sent.
BATCH_BYTES = 8 << 20
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"

Run = tuple[int, int, int]  # first word, word after the last, period


def live_stretches(ids: np.ndarray, frequent: int) -> list[tuple[int, int]]:
    """[start, end) of the stretches in which every pair of neighbours occurs ``frequent`` times or more."""
    if len(ids) < 2:
        return []
    pairs = ids[:-1] * (int(ids.max()) + 1) + ids[1:]
    _, kind, count = np.unique(pairs, return_inverse=True, return_counts=True)
    live = np.concatenate([[False], count[kind] >= frequent, [False]])
    edges = np.flatnonzero(live[1:] != live[:-1])
    return [(int(a), int(b) + 1) for a, b in zip(edges[::2], edges[1::2])]


class Grammar:
    """Re-Pair over stretches of a sequence; positions are those of the sequence.

    ``rules`` has, for each nonterminal, where its boundary lies, how long it
    is, and all its places in the derivation.  ``rest`` has, for each stretch,
    the starts of the symbols that are left, and the stretch's end.
    """

    def __init__(self, ids: list[int], stretches: list[tuple[int, int]], frequent: int):
        self.where: dict[tuple[int, int], list[int]] = {}  # of pairs of words
        self.rules: list[tuple[int, int, list[int]]] = []
        symbol, after, before = list(ids), list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        for a, b in stretches:
            before[a] = after[b - 1] = -1
            for i in range(a, b - 1):
                self.where.setdefault((ids[i], ids[i + 1]), []).append(i)
        length: dict[int, int] = {}  # of nonterminals
        new = max(ids, default=0) + 1
        at = dict(self.where)
        queue = [(-len(places), n, pair) for n, (pair, places) in enumerate(at.items()) if len(places) >= frequent]
        heapify(queue)
        turn = len(at)  # of pairs that are as frequent, the older goes first
        while queue:
            count, _, pair = heappop(queue)
            places = at.get(pair)
            if places is None:
                continue
            x, y = pair
            places = [i for i in places if symbol[i] == x and after[i] >= 0 and symbol[after[i]] == y]
            if x == y:
                places.sort()
                free, apart = -1, []
                for i in places:
                    if i >= free:
                        apart.append(i)
                        free = after[after[i]] if after[after[i]] >= 0 else len(ids)
                places = apart
            if len(places) < -count:  # some have gone into other nonterminals since
                at[pair] = places
                if len(places) >= frequent:
                    heappush(queue, (-len(places), turn, pair))
                    turn += 1
                continue
            del at[pair]
            left = length.get(x, 1)
            length[new] = left + length.get(y, 1)
            fresh = set()
            for i in places:
                j = after[i]
                k, p = after[j], before[i]
                symbol[i], symbol[j], after[i] = new, -1, k
                if k >= 0:
                    before[k] = i
                    at.setdefault(q := (new, symbol[k]), []).append(i)
                    fresh.add(q)
                if p >= 0:
                    at.setdefault(q := (symbol[p], new), []).append(p)
                    fresh.add(q)
            for q in sorted(fresh):
                if len(at[q]) >= frequent:
                    heappush(queue, (-len(at[q]), turn, q))
                    turn += 1
            self.rules.append((left, length[new], places))
            new += 1
        self.rest: list[list[int]] = []
        for a, b in stretches:
            starts, i = [], a
            while i >= 0:
                starts.append(i)
                i = after[i]
            self.rest.append([*starts, b])


def _same(ids: list[int], i: int, j: int, most: int) -> int:
    """How many of the words from i on equal those from j on, ``most`` at most."""
    n, step = 0, 4
    while n < most:
        step = min(step, most - n)
        if ids[i + n : i + n + step] == ids[j + n : j + n + step]:
            n += step
            step *= 2
        elif step == 1:
            break
        else:
            step = max(1, step // 4)
    return n


def _same_back(ids: list[int], i: int, j: int, most: int) -> int:
    """How many of the words before i equal those before j, ``most`` at most."""
    n, step = 0, 4
    while n < most:
        step = min(step, most - n)
        if ids[i - n - step : i - n] == ids[j - n - step : j - n]:
            n += step
            step *= 2
        elif step == 1:
            break
        else:
            step = max(1, step // 4)
    return n


def crossing(ids: list[int], where: dict, t: int, b: int, e: int) -> list[Run]:
    """The runs of ids[t:e] that have words on both sides of b, each with its smallest period.

    Such a run of period q holds the pair of words around b a second time, q
    words to the left or to the right, so only such distances are tried, the
    shorter first.
    """
    longest = (e - t) // REPEATS
    if e - t < LEAST:
        return []
    places = where.get((ids[b - 1], ids[b]), ())
    a = bisect_left(places, max(t, b - 1 - longest))
    z = bisect_left(places, min(e - 1, b + longest))
    if z - a < 2:
        return []
    found: list[Run] = []
    for q, anchor in sorted((abs(o - b + 1), min(o, b - 1)) for o in places[a:z] if o != b - 1):
        # a run of period q would share a period and more with one found before, and so have its period
        if any(
            (b - s >= q + q0 or b - 2 * q < t) and (f - b >= q + q0 or b + 2 * q > e) for s, f, q0 in found if q0 < q
        ):
            continue
        start = anchor - _same_back(ids, anchor, anchor + q, anchor - t)
        end = anchor + q + _same(ids, anchor, anchor + q, e - anchor - q)
        if end - start >= max(LEAST, REPEATS * q) and not any(s <= start and end <= f for s, f, _ in found):
            found.append((start, end, q))
    return found


def runs_of(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period."""
    if len(words) < LEAST:
        return []
    number: dict = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    # inside a run each pair of words comes at least once less often than there are periods
    frequent = REPEATS - 1
    stretches = [(a, b) for a, b in live_stretches(np.array(ids), frequent) if b - a >= LEAST]
    if not stretches:
        return []
    grammar = Grammar(ids, stretches, frequent)
    by_period: dict[int, set[tuple[int, int]]] = {}
    for left, length, places in grammar.rules:
        t = places[0]
        for start, end, q in crossing(ids, grammar.where, t, t + left, t + length):
            by_period.setdefault(q, set()).update((start - t + p, end - t + p) for p in places)
    for starts in grammar.rest:
        halves = [(0, len(starts) - 1)]
        while halves:
            a, z = halves.pop()
            if z - a < 2 or starts[z] - starts[a] < LEAST:
                continue
            m = (a + z) // 2
            for start, end, q in crossing(ids, grammar.where, starts[a], starts[m], starts[z]):
                by_period.setdefault(q, set()).add((start, end))
            halves += [(a, m), (m, z)]
    runs = []
    for q, intervals in by_period.items():
        merged: list[list[int]] = []
        for start, end in sorted(intervals):
            if merged and start <= merged[-1][1] - q:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end])
        runs += [(start, end - start, q) for start, end in merged]
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that some run holds after its first period."""
    kept = []
    at = 0
    for start, end in sorted((start + q, start + length) for start, length, q in runs):
        if start > at:
            kept += words[at:start]
        at = max(at, end)
    return kept + words[at:]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (start, length, period), collapsed.

    Words are separated by ASCII white space.  ``collapsed`` has the words that
    no run holds after its first period, joined by one space.  A null text has
    no words, no runs and an empty ``collapsed``, as an empty one; a null id
    stays null; repeated rows each give a row; an empty table gives none.  Of
    runs at one place, those of different periods are all listed.  Other
    columns are not read, so their names cannot clash.
    """
    row = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(row)), ("collapsed", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for part in batches:
            for doc_id, text in zip(part.column(0), part.column(1)):
                words = (text.as_py() or "").encode().split()
                runs = runs_of(words)
                collapsed = b" ".join(collapse(words, runs) if runs else words).decode()
                fields = [{"start": s, "length": n, "period": q} for s, n, q in runs]
                rows.append((doc_id.as_py(), len(words), fields, collapsed))
                size += len(collapsed) + 100 + 100 * len(runs)
                if size > BATCH_BYTES:
                    yield batch()
                    rows, size = [], 0
        if rows:
            yield batch()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
