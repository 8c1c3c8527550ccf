"""Repeated passages by a hash-compared suffix sort.

A byte goes if it is covered by a 200-byte string that also starts anywhere
else in the table (same document included); matches never cross documents.

Sorting every suffix of a corpus is out of reach, so suffixes are first dealt
to places where equal ones must meet, and whole stretches that are plainly
repeated or plainly unique are settled by prefix polynomial hashes:

1. Each 200-byte window has an anchor: the least hashed 32-byte gram in it
   (leftmost of equals).  Equal windows have their anchor at the same offset.
   Windows of one anchor are cut into cells of 43 offsets.  The *core* of a
   cell is what all its possible windows share (158 bytes), its *hull* is what
   the windows present cover.
2. Cells are dealt by core hash.  A core met once settles its windows as
   unique; a hull met twice settles them as repeated.  Equal hulls within a
   task are combined before the shuffle, and of a core with many hulls in a
   task one cell is sent and the others are open at once, so a hot passage
   sends little.
3. Cells with a shared core but a hull of their own are where repeats begin or
   end.  Their windows are dealt again by a core of 188 bytes, those of hot
   cores one by one by the bytes around it too, so that a hot passage in many
   surroundings meets nowhere as a whole.  Those that meet are sorted as
   suffixes: a merge sort whose comparisons find the common extension by
   binary search on prefix polynomial hashes, in logarithmic steps.  Equal
   neighbours are verified by the bytes around the core.

Task output travels as packed blobs, not as a row per cell.

Nulls: a null text counts as empty.  Texts under 200 bytes lose nothing.
Texts longer than a segment are read in overlapping segments.  Repeated rows repeat each other's
passages.  Empty tables give no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (BASE, OTHER_BASE, Polynomial, by_bytes, frugal, mix64, ship, shuffle_partitions,
                     small_batches, stored, table, utf8)

ship(__name__)

SPAN, GRAM = 200, 32
#: Grams in a window; offsets of an anchor run from 0 to REACH - 1.
REACH = SPAN - GRAM + 1
#: Offsets of a cell, and of the parts in which open cells are sorted; parts divide REACH evenly.
CELL, PART = 43, 13
#: Bits of a gram's place in a batch; the others are its hash.
PLACE_BITS = 24
#: Bytes worked on at once; longer texts are read in overlapping segments.
SEGMENT = 1 << 20
#: Cells that a task packs at once.
FLUSH = 1 << 20
#: A core with so many hulls in one task is hot: its cells go on without meeting there, and its windows are dealt one by one.
HOT = 32
LOW_BITS = 48
U = np.uint64
ITEM = np.dtype([("low", "<u8"), ("start", "<u4"), ("count", "u1"), ("offset", "u1"), ("check", "<u8")])
RUN = np.dtype([("start", "<u4"), ("count", "u1")])
#: Windows of a part, ``count`` of them from ``start`` on: hashes of the core, and the bytes before and after it
#: (``lead`` of them before it in the first window; those that belong to no window are 0).
PIECE = np.dtype([("meet", "<u8"), ("check", "<u8"), ("start", "<u4"), ("count", "u1"), ("lead", "u1"), ("settled", "u1"),
                  ("left", "u1", PART - 1), ("right", "u1", PART - 1)])


def cells(data: np.ndarray, cut: np.ndarray) -> dict[str, np.ndarray]:
    """Cells of all windows in the segments data[cut[i]:cut[i+1]]; starts and ends count in ``data``.

    first, last: window starts; offset: of the anchor in the first window; seg: segment; core, hull: hashes."""
    empty = {k: np.empty(0, np.int64) for k in ("first", "last", "offset", "seg", "core_from", "core_to")}
    room = np.maximum(np.diff(cut) - SPAN + 1, 0)
    if not room.sum():
        return empty | {"core": np.empty(0, U), "hull": np.empty(0, U)}
    poly = Polynomial(data)
    grams = mix64((poly.sums[GRAM:] - poly.sums[:-GRAM]) * poly.down[:len(data) - GRAM + 1])
    m = (grams & ~U((1 << PLACE_BITS) - 1)) | np.arange(len(grams), dtype=U)
    for step in (1, 2, 4, 8, 16, 32, 64, REACH - 128):
        m = np.minimum(m[:-step], m[step:])
    seg = np.repeat(np.arange(len(room)), room)
    at = cut[:-1][seg] + np.arange(len(seg)) - (np.cumsum(room) - room)[seg]
    anchor = (m[at] & U((1 << PLACE_BITS) - 1)).astype(np.int64)
    offset = anchor - at
    key = anchor * 4 + offset // CELL
    new = np.ones(len(key), np.bool_)
    new[1:] = key[1:] != key[:-1]
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(key)) - 1
    anchor, cell = anchor[a], offset[a] // CELL
    least, most = cell * CELL, np.minimum(cell * CELL + CELL, REACH) - 1
    first, last = at[a], at[b]
    core_from, core_to = anchor - least, anchor - most + SPAN
    hull = Polynomial(data, OTHER_BASE).of(first, last + SPAN) + (offset[a] * 256 + last - first).astype(U) * U(BASE)
    return {"first": first, "last": last, "offset": offset[a], "seg": seg[a], "core_from": core_from, "core_to": core_to,
            "core": mix64(poly.of(core_from, core_to) + cell.astype(U) * U(OTHER_BASE)), "hull": mix64(hull)}


def segments(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, cuts, row, start in the row) of groups of segments; each window lies in exactly one segment."""
    n = len(ends) - 1
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + SEGMENT, "right")) - 1)
        size = ends[i + 1] - ends[i]
        if size > SEGMENT:
            for s in range(0, int(size) - SPAN + 1, SEGMENT):
                part = data[ends[i] + s:min(ends[i] + s + SEGMENT + SPAN - 1, ends[i + 1])]
                yield part, np.array([0, len(part)]), np.array([i]), np.array([s])
        else:
            yield data[ends[i]:ends[j]], ends[i:j + 1] - ends[i], np.arange(i, j), np.zeros(j - i, np.int64)
        i = j


def split(h: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    n = U(n_buckets)
    return (((h >> U(32)) * n) >> U(32)).astype(np.uint16), (h * n) >> U(64 - LOW_BITS)


def _deal(n_buckets: int):
    """Cells per bucket; cells that repeat another of the task are settled here and sent as runs, those of hot cores as open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        waiting = 0
        for batch in batches:
            keys = batch.column(0).to_numpy()
            data, ends = utf8(batch.column(1))
            for part, cut, row, start in segments(data, ends):
                c = cells(part, cut)
                if len(c["seg"]):
                    within = c["first"] - cut[c["seg"]] + start[c["seg"]]
                    held.append((keys[row[c["seg"]]], within, c["last"] - c["first"] + 1, c["offset"], c["core"], c["hull"]))
                    waiting += len(within)
                if waiting >= FLUSH:
                    yield from flush(held)
                    held, waiting = [], 0
        if waiting:
            yield from flush(held)

    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        key, start, count, offset, core, hull = (np.concatenate(x) for x in zip(*held))
        bucket, low = split(core, n_buckets)
        order = np.lexsort((hull, core))
        new = np.ones(len(order), np.bool_)
        new[1:] = (core[order][1:] != core[order][:-1]) | (hull[order][1:] != hull[order][:-1])
        group = np.cumsum(new) - 1
        twice = np.bincount(group) > 1
        chief = order[new]  # of equal cells one goes on; the lowest bit of check says that there are more
        new_core = np.ones(len(chief), np.bool_)
        new_core[1:] = core[chief][1:] != core[chief][:-1]
        of_core = np.cumsum(new_core) - 1
        is_hot = (np.bincount(of_core) >= HOT)[of_core]
        out: list[list] = [[] for _ in range(6)]
        rest = np.concatenate((order[~new], chief[is_hot & twice]))
        if len(rest):
            rest = rest[np.argsort(key[rest], kind="stable")]
            for k, blob in runs(key[rest], start[rest], count[rest]):
                for c, v in zip(out, (k & 0x7FFF, k, None, None, blob, None)):
                    c.append(v)
        many, hot = np.zeros(len(order), np.bool_), np.zeros(len(order), np.bool_)
        many[chief], hot[chief] = twice, is_hot
        direct = chief[is_hot]
        direct = direct[np.argsort(key[direct], kind="stable")]
        items = np.zeros(len(direct), ITEM)
        items["start"], items["count"], items["offset"], items["check"] = start[direct], count[direct], offset[direct], 2 + many[direct]
        who, at = np.unique(key[direct], return_index=True)
        for k, x, y in zip(who.tolist(), at.tolist(), [*at[1:].tolist(), len(direct)]):
            for c, v in zip(out, (k & 0x7FFF, k, None, None, None, items[x:y].tobytes())):
                c.append(v)
        chief = chief[~is_hot | new_core]  # of a hot core one cell goes on, for the core's sake only
        sel = chief[np.lexsort((key[chief], bucket[chief]))]
        items = np.empty(len(sel), ITEM)
        items["low"], items["start"], items["count"], items["offset"] = low[sel], start[sel], count[sel], offset[sel]
        items["check"] = (hull[sel] & ~U(3)) | hot[sel].astype(U) << U(1) | many[sel].astype(U)
        where = np.searchsorted(bucket[sel], np.arange(n_buckets + 1))
        for b in range(n_buckets):
            x, y = where[b], where[b + 1]
            if x < y:
                who, n = np.unique(key[sel[x:y]], return_counts=True)
                for c, v in zip(out, (b, None, who.tobytes(), n.astype(np.uint32).tobytes(), packed(items[x:y]), None)):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()),
                                          *(pa.array(c, pa.binary()) for c in out[2:])],
                                         names=["bucket", "key", "keys", "counts", "blob", "open"])

    return run


def packed(items: np.ndarray) -> bytes:
    """18 bytes a cell: 6 of the core, 6 of the hull, place, number of windows, offset."""
    return b"".join([(items["low"] >> U(16)).astype("<u4").tobytes(), items["low"].astype("<u2").tobytes(),
                     (items["check"] >> U(32)).astype("<u4").tobytes(), items["check"].astype("<u2").tobytes(),
                     items["start"].tobytes(), items["count"].tobytes(), items["offset"].tobytes()])


def unpacked(blob: bytes) -> np.ndarray:
    n = len(blob) // 18
    items = np.empty(n, ITEM)
    at = 0
    cols = []
    for kind in ("<u4", "<u2", "<u4", "<u2", "<u4", "u1", "u1"):
        cols.append(np.frombuffer(blob, kind, n, at))
        at += n * np.dtype(kind).itemsize
    items["low"] = (cols[0].astype(U) << U(16)) | cols[1]
    items["check"] = (cols[2].astype(U) << U(32)) | cols[3]
    items["start"], items["count"], items["offset"] = cols[4:]
    return items


def runs(key: np.ndarray, start: np.ndarray, count: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Window runs as one blob per key; ``key`` is sorted."""
    out = np.empty(len(key), RUN)
    out["start"], out["count"] = start, count
    who, at = np.unique(key, return_index=True)
    for k, x, y in zip(who.tolist(), at.tolist(), [*at[1:].tolist(), len(key)]):
        yield k, out[x:y].tobytes()


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: runs of repeated windows, and cells that must be sorted (or serve others as partners)."""
    bucket, rows = None, []
    for batch in batches:  # sorted by bucket
        ready: list[tuple] = []
        for b, key, keys, counts, blob, unsure in zip(*batch.columns):
            if b.as_py() != bucket:
                yield from _settled(rows)
                bucket, rows = b.as_py(), []
            if key.is_valid:
                ready.append((key.as_py(), blob.as_py(), unsure.as_py()))
            else:
                rows.append((keys.as_py(), counts.as_py(), blob.as_py()))
        if ready:
            yield _by_key(ready)
    yield from _settled(rows)


def _settled(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """The cells of one bucket."""
    if rows:
        key = np.concatenate([np.repeat(np.frombuffer(k, np.int64), np.frombuffer(n, np.uint32)) for k, n, _ in rows])
        items = np.concatenate([unpacked(r[2]) for r in rows])
        is_hot = (items["check"] & U(2)) > 0
        hot = np.unique(items["low"][is_hot])
        key, items = key[~is_hot], items[~is_hot]
        low = items["low"]
        order = np.argsort(low, kind="stable")
        same = low[order][1:] == low[order][:-1]
        many = (items["check"][order] & U(1)).astype(np.bool_)
        shared = many | np.isin(low[order], hot)
        shared[1:] |= same
        shared[:-1] |= same
        order = order[shared]
        order = order[np.lexsort((items["check"][order] >> U(2), low[order]))]
        key, items = key[order], items[order]
        if not len(key):
            return
        low, hull = items["low"], items["check"] >> U(2)
        new_core = np.ones(len(key), np.bool_)
        new_core[1:] = low[1:] != low[:-1]
        new_hull = new_core.copy()
        new_hull[1:] |= hull[1:] != hull[:-1]
        of_hull = np.cumsum(new_hull) - 1
        of_core = np.cumsum(new_core) - 1
        twice = (np.bincount(of_hull) + np.bincount(of_hull, items["check"] & U(1)) > 1)[of_hull]
        is_hot = np.isin(low, hot)
        unsure = (np.bincount(of_core, ~twice) > 0)[of_core] | is_hot
        # of a repeated hull one cell goes along as a partner for the open ones
        send = unsure & (~twice | new_hull)
        ready = []
        sel = np.flatnonzero(twice)
        sel = sel[np.argsort(key[sel], kind="stable")]
        ready += [(k, blob, None) for k, blob in runs(key[sel], items["start"][sel], items["count"][sel])]
        sel = np.flatnonzero(send)
        sel = sel[np.argsort(key[sel], kind="stable")]
        who, at = np.unique(key[sel], return_index=True)
        out = items[sel].copy()
        out["check"] = twice[sel] + 2 * is_hot[sel]
        for k, x, y in zip(who.tolist(), at.tolist(), [*at[1:].tolist(), len(sel)]):
            ready.append((k, None, out[x:y].tobytes()))
        if ready:
            yield _by_key(ready)


def _by_key(rows: list[tuple]) -> pa.RecordBatch:
    key, done, unsure = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(done, pa.binary()), pa.array(unsure, pa.binary())],
                                      names=["key", "runs", "open"])


def _open(n_buckets: int):
    """The parts of open cells: a core as hashes, and the bytes left and right of it, dealt by the core.

    Windows of hot cores are dealt one by one, by all of their bytes, so they spread with what surrounds the
    core.  Parts equal to another of the task are settled here, and one of them goes on as a partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        waiting = 0
        for batch in batches:
            data, ends = utf8(batch.column(1))
            blobs = batch.column(2).to_pylist()
            keys = batch.column(0).to_numpy()
            for i, j in by_bytes(ends, SEGMENT):
                got = pieces(data[ends[i]:ends[j]], ends[i:j] - ends[i], keys[i:j], blobs[i:j])
                held += got
                waiting += sum(len(key) for key, _ in got)
                if waiting >= FLUSH // 2:
                    yield from flush(held)
                    held, waiting = [], 0
        if waiting:
            yield from flush(held)

    def pieces(data: np.ndarray, begin: np.ndarray, keys: np.ndarray, blobs: list[list[bytes]]) -> list[tuple]:
        count = [sum(len(x) for x in b) // ITEM.itemsize for b in blobs]
        doc = np.repeat(np.arange(len(blobs)), count)
        items = np.frombuffer(b"".join(x for b in blobs for x in b), ITEM)
        start, offset = items["start"] + begin[doc], items["offset"].astype(np.int64)
        last = start + items["count"] - 1
        anchor = start + offset
        one, two = Polynomial(data), Polynomial(data, OTHER_BASE)
        out = []
        for p in range(REACH // PART):  # parts of PART offsets, on the same grid for every cell
            least, most = p * PART, p * PART + PART - 1
            a, b = np.maximum(start, anchor - most), np.minimum(last, anchor - least)
            has = np.flatnonzero(a <= b)
            core_from, core_to = anchor[has] - least, anchor[has] - most + SPAN
            meet = mix64(one.of(core_from, core_to) + U(p * OTHER_BASE % (1 << 64)))
            check = mix64(two.of(core_from, core_to) + U(p * BASE % (1 << 64)))
            hot = items["check"][has] > 1
            n = b[has] - a[has] + 1
            several = np.where(hot, n, 1)
            row = np.repeat(np.arange(len(has)), several)
            at = a[has][row] + np.arange(len(row)) - (np.cumsum(several) - several)[row]
            w = np.empty(len(row), PIECE)
            lead, count = core_from[row] - at, np.where(hot, 1, n)[row]
            w["meet"], w["check"], w["lead"], w["count"] = meet[row], check[row], lead, count
            w["settled"] = items["check"][has][row]  # the second bit: hot
            w["start"] = at - begin[doc[has]][row]
            for k in range(PART - 1):
                x, y = core_from[row] - (PART - 1) + k, core_to[row] + k
                w["left"][:, k] = np.where(x >= at, data[np.maximum(x, 0)], 0)
                w["right"][:, k] = np.where(y < at + count - 1 + SPAN, data[np.minimum(y, len(data) - 1)], 0)
            out.append((keys[doc[has]][row], w))
        return out

    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        key, items = np.concatenate([k for k, _ in held]), np.concatenate([w for _, w in held])
        order, new = alike(items)
        group = np.cumsum(new) - 1
        twice = np.empty(len(order), np.bool_)
        twice[order] = (np.bincount(group) > 1)[group]
        out: list[list] = [[], [], [], [], []]
        done = np.flatnonzero(twice & (items["settled"] & 1 == 0))
        done = done[np.argsort(key[done], kind="stable")]
        for k, blob in runs(key[done], items["start"][done], items["count"][done]):
            for c, v in zip(out, (k & 0x7FFF, k, None, None, blob)):
                c.append(v)
        items["settled"] |= twice
        sel = order[new]
        bucket = split(np.where(items["settled"][sel] > 1, dealt(items[sel]), mix64(items["meet"][sel])), n_buckets)[0]
        by = np.lexsort((key[sel], bucket))
        sel, bucket = sel[by], bucket[by]
        where = np.searchsorted(bucket, np.arange(n_buckets + 1))
        for b in range(n_buckets):
            x, y = where[b], where[b + 1]
            if x < y:
                who, n = np.unique(key[sel[x:y]], return_counts=True)
                for c, v in zip(out, (b, None, who.tobytes(), n.astype(np.uint32).tobytes(), items[sel[x:y]].tobytes())):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()),
                                          *(pa.array(c, pa.binary()) for c in out[2:])],
                                         names=["bucket", "key", "keys", "counts", "blob"])

    return run


def columns(items: np.ndarray) -> tuple[np.ndarray, ...]:
    """What tells pieces apart."""
    sides = [np.ascontiguousarray(items[side]) for side in ("left", "right")]
    return (*(np.ascontiguousarray(x[:, a:a + 4]).view("<u4").ravel().astype(U) for x in sides for a in range(0, PART - 1, 4)),
            items["lead"].astype(U), items["count"].astype(U), items["check"], items["meet"])


def dealt(items: np.ndarray) -> np.ndarray:
    """A hash of the whole piece."""
    h = np.zeros(len(items), U)
    for c in columns(items):
        h = mix64(h * U(BASE) + c)
    return h


def alike(items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order with equal pieces together, and where a new one begins in it."""
    cols = columns(items)
    order = np.lexsort(cols)
    new = np.ones(len(order), np.bool_)
    new[1:] = np.any([c[order][1:] != c[order][:-1] for c in cols], axis=0)
    return order, new


class Suffixes:
    """Suffixes of one text, compared by binary search for their common extension on prefix hashes.

    The text is a sequence of symbols; ``length`` symbols of each suffix count."""

    def __init__(self, symbols: np.ndarray, length: int):
        self.symbols, self.length = symbols, length
        self.poly = Polynomial(symbols)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes at x and y."""
        got = np.zeros(len(x), np.int64)
        step = 1 << (self.length.bit_length() - 1)
        while step:
            more = got + step
            ok = more <= self.length
            a, b = np.where(ok, more, 0), got
            equal = ok & (self.poly.of(x + b, x + a.clip(b)) == self.poly.of(y + b, y + a.clip(b)))
            got = np.where(equal, more, got)
            step >>= 1
        return got

    def less(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        n = self.common(x, y)
        differ = n < self.length
        n = np.where(differ, n, 0)
        return differ & (self.symbols[x + n] < self.symbols[y + n])

    def sort(self, at: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Merge-sort the suffixes ``at`` within segments: element i's segment begins at first[i] and has size[i]."""
        at = at.copy()
        width, alive = 1, np.flatnonzero(size > 1)
        while len(alive):
            local = alive - first[alive]
            run = local // width
            even = run % 2 == 0
            lo = np.minimum(np.where(even, run + 1, run - 1) * width, size[alive])
            hi = np.minimum(lo + width, size[alive])
            begin = lo.copy()
            # where the element goes in the neighbouring run; elements of the left run stay in front of equals
            open_ = lo < hi
            while open_.any():
                i = np.flatnonzero(open_)
                mid = (lo[i] + hi[i]) // 2
                x, y = at[alive[i]], at[first[alive[i]] + mid]
                after = np.where(even[i], self.less(y, x), ~self.less(x, y))
                lo[i] = np.where(after, mid + 1, lo[i])
                hi[i] = np.where(after, hi[i], mid)
                open_ = lo < hi
            place = first[alive] + (run // 2) * 2 * width + (local - run * width) + (lo - begin)
            moved = at[alive]
            at[place] = moved
            width *= 2
            alive = alive[size[alive] > width]
        return at


def _sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: runs of repeated windows among those that were open."""
    bucket, rows = None, []
    for batch in batches:  # sorted by bucket
        ready: list[tuple] = []
        for b, key, keys, counts, blob in zip(*batch.columns):
            if b.as_py() != bucket:
                yield from _sorted(rows)
                bucket, rows = b.as_py(), []
            if key.is_valid:
                ready.append((key.as_py(), blob.as_py(), None))
            else:
                rows.append((keys.as_py(), counts.as_py(), blob.as_py()))
        if ready:
            yield _by_key(ready)
    yield from _sorted(rows)


def _sorted(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Sort the suffixes of one bucket; windows equal to a neighbour are repeated."""
    if not rows:
        return
    key = np.concatenate([np.repeat(np.frombuffer(k, np.int64), np.frombuffer(n, np.uint32)) for k, n, _ in rows])
    items = np.concatenate([np.frombuffer(r[2], PIECE) for r in rows])
    # cores that came alone are unique
    order = np.lexsort((items["check"], items["meet"]))
    new = np.ones(len(order), np.bool_)
    new[1:] = (items["meet"][order][1:] != items["meet"][order][:-1]) | (items["check"][order][1:] != items["check"][order][:-1])
    order = order[(np.bincount(np.cumsum(new) - 1) > 1)[np.cumsum(new) - 1]]
    if not len(order):
        return
    row = np.repeat(order, items["count"][order])
    step = np.arange(len(row)) - np.repeat(np.cumsum(items["count"][order], dtype=np.int64) - items["count"][order], items["count"][order])
    lead = items["lead"][row] - step  # symbols before the core: equal windows have equally many
    by = np.lexsort((lead, items["check"][row], items["meet"][row]))
    row, step, lead = row[by], step[by], lead[by]
    key, start, items = key[row], items["start"][row] + step, items[row]
    # one text of all windows: left bytes, a symbol for the core, right bytes
    text = np.empty((len(key), PART), np.uint16)
    for k in range(PART):
        text[:, k] = np.where(k < lead, items["left"][np.arange(len(key)), np.minimum(PART - 1 - lead + k, PART - 2)],
                              items["right"][np.arange(len(key)), np.maximum(k - lead - 1, 0)])
    text[np.arange(len(key)), lead] = 256
    text = text.ravel()
    at = np.arange(len(key)) * PART
    new = np.ones(len(key), np.bool_)  # equal windows have the same core at the same place
    new[1:] = np.any([c[1:] != c[:-1] for c in (items["meet"], items["check"], lead)], axis=0)
    group = np.cumsum(new) - 1
    suffixes = Suffixes(text, PART)
    ranked = suffixes.sort(at, np.flatnonzero(new)[group], np.bincount(group)[group])
    pairs = np.flatnonzero(group[1:] == group[:-1])
    x, y = ranked[pairs], ranked[pairs + 1]
    equal = suffixes.common(x, y) == PART
    for k in range(PART):  # the hashes agree: so must the bytes
        equal &= text[x + k] == text[y + k]
    hit = np.unique(np.concatenate((x[equal], y[equal]))) // PART
    hit = hit[items["settled"][hit] & 1 == 0]
    hit = hit[np.argsort(key[hit], kind="stable")]
    out = [(k, blob, None) for k, blob in runs(key[hit], start[hit], np.ones(len(hit), np.int64))]
    if out:
        yield _by_key(out)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols: list[list] = [[] for _ in range(5)]
        for doc, text, blobs in zip(*(c.to_pylist() for c in batch.columns)):
            body = (text or "").encode()
            gone = n_spans = 0
            if blobs:
                r = np.concatenate([np.frombuffer(b, RUN) for b in blobs])
                a = r["start"].astype(np.int64)
                edge = np.bincount(a, minlength=len(body) + 1) - np.bincount(a + r["count"] + (SPAN - 1), minlength=len(body) + 1)
                covered = np.cumsum(edge[:len(body)]) > 0
                gone = int(covered.sum())
                n_spans = int(covered[0]) + int((covered[1:] & ~covered[:-1]).sum())
                kept = np.frombuffer(body, np.uint8)[~covered].tobytes()
            else:
                kept = body
            for c, v in zip(cols, (doc, len(body), gone, n_spans, hashlib.sha256(kept).hexdigest())):
                c.append(v)
        types = [pa.int64()] * 4 + [pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    small_batches(df.sparkSession)
    parts = shuffle_partitions(df.sparkSession)
    docs = df.select(df[id_col].cast("long").alias("doc_id"), df[text].cast("string").alias("text"))
    docs = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    found = stored(docs.select("key", "text")
                   .mapInArrow(frugal(_deal(min(parts, 1 << 15))),
                               "bucket int, key long, keys binary, counts binary, blob binary, open binary")
                   .repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(frugal(_settle), "key long, runs binary, open binary"), "cells")
    # a document's open cells; no more than its length allows
    unsure = stored(found.where("open is not null").groupBy("key").agg(F.collect_list("open").alias("open")), "open")
    sorted_ = (docs.select("key", "text").join(unsure, "key")
               .mapInArrow(frugal(_open(min(parts, 1 << 15))), "bucket int, key long, keys binary, counts binary, blob binary")
               .repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(frugal(_sort), "key long, runs binary, open binary"))
    done = stored(found.where("runs is not null").select("key", "runs").unionByName(sorted_.select("key", "runs"))
                  .groupBy("key").agg(F.collect_list("runs").alias("runs")), "runs")
    return docs.join(done, "key", "left").select("doc_id", "text", "runs").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").withColumnRenamed("doc_id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (SELECT rid, n, k, substr(h, 2000 * k + 1, 2398) AS c FROM (SELECT *, unnest(range(0, (n + 800) // 1000)) AS k FROM docs WHERE n >= 200)),
starts AS (SELECT rid, k, c, unnest(range(0, least(1000, n - 199 - 1000 * k))) AS j FROM blocks),
windows AS (SELECT rid, 1000 * k + j AS i, md5_number(substr(c, 2 * j + 1, 400)) AS w FROM starts),
repeated AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
hits AS (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before FROM windows SEMI JOIN repeated USING (w)),
runs AS (SELECT rid, i, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY i) AS run FROM hits),
spans AS (SELECT rid, min(i) AS a, max(i) + 200 AS b FROM runs GROUP BY rid, run),
gaps AS (
  SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS from_, max(b) OVER (PARTITION BY rid) AS tail FROM spans),
cut AS (
  SELECT rid, count(*) AS n_spans, sum(b - a) AS n_removed,
         string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a) || substr(any_value(h), 2 * max(tail) + 1) AS kept
  FROM gaps JOIN docs USING (rid) GROUP BY rid)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM docs LEFT JOIN cut USING (rid)
"""
