"""Removal of repeated substrings by a distributed merge sort of suffixes.

Bytes covered by a 50-byte string that also starts in a document with a smaller id are
removed.  Method (communication-efficient string sorting, as published for distributed
suffix sorting):

1. Every 50-byte window names one anchor, the 25-byte string in it with the least hash; equal
   windows name equal anchors.  Neighbouring windows mostly share their anchor, so a text of n
   bytes has about 2n/27 suffixes that start at anchors.  Hashes of the anchors' distinguishing prefixes
   are exchanged first (4 bytes each); suffixes whose prefix lies in one document only
   are left out, as their windows are unique.
2. Each block of documents sorts its remaining suffixes, bounded to what their windows see, keeps one of each with
   its smallest id, and sends one front-coded run (common-prefix lengths and the rest) a hash range.
3. A range merges its runs with a loser tree that carries common-prefix lengths: two suffixes are
   compared only from the first unknown byte.  Neighbours with a common prefix of an anchor form a
   group; it gives every window the smallest id that holds it.
4. The answer, one bit a window, returns to the block, which marks, joins and removes bytes.

Scale: work is by blocks of documents and by hash ranges, both bounded in bytes; a string that a third
of all rows hold is one record a block.  Texts are shuffled once (the exchange is reused).
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only

#: Bytes of text a block aims at (least, most), and anchors a hash range.
BLOCK_BYTES, RANGE_ANCHORS = (4 << 20, 32 << 20), 1 << 20
PIECE = 1 << 18
FULL = 0xFFFFFFFF


def _hashes(x: np.ndarray, width: int) -> np.ndarray:
    """32-bit polynomial hashes of all ``width``-byte strings, by doubling."""
    base = 0x9E3779B1
    power = lambda e: np.uint32(pow(base, e, 1 << 32))
    h, size, done, out = (x.astype(np.uint32) + np.uint32(1)) * np.uint32(0x85EBCA6B), 1, 0, None
    n = len(x) - width + 1
    rest = width
    while rest:
        if rest & 1:
            part = h[done:done + n]
            out = part.copy() if out is None else out * power(size) + part
            done += size
        rest >>= 1
        if rest:
            h = h[:-size] * power(size) + h[size:]
            size *= 2
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x2C1B3C6D)
    out ^= out >> np.uint32(12)
    return out


def _anchors(x: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, anchor position) of the runs of windows with one anchor.

    ``ends``: where the documents in ``x`` end; no window crosses one."""
    width = length // 2
    span = length - width + 1
    if len(x) < length:
        return (np.zeros(0, np.int64),) * 3
    h = _hashes(x, width)
    v = h.astype(np.uint64) << np.uint64(32)
    v |= np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= span:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    if size < span:
        v = np.minimum(v[:len(v) - (span - size)], v[span - size:])
    valid = np.ones(len(v), bool)
    for e in ends:
        valid[max(0, e - length + 1):e] = False
    at = np.flatnonzero(valid)
    if not len(at):
        return (np.zeros(0, np.int64),) * 3
    a = (v[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
    return at[new], np.diff(np.append(new, len(at))), a[new]


def _mixed(x: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of the ``width``-byte strings at ``at``."""
    words = -(-width // 8)
    out = np.full(len(at), 0x243F6A8885A308D3, np.uint64)
    for i in range(0, len(at), 1 << 16):
        g = np.zeros((len(at[i:i + (1 << 16)]), words * 8), np.uint8)
        g[:, :width] = x[at[i:i + (1 << 16), None] + np.arange(width)]
        h = out[i:i + (1 << 16)]
        for c in g.view(np.uint64).T:
            h ^= c
            h *= np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return out


class Block:
    """The documents of a block, and the suffixes at their anchors."""

    def __init__(self, rows: pa.Table, ranges: int, length: int):
        key = rows.column("key").to_numpy()
        texts = [(t or "").encode("utf-8", "surrogatepass") for t in rows.column("text").to_pylist()]
        order = sorted(range(len(key)), key=lambda i: (key[i], texts[i]))  # the same on every reading
        self.ids = [rows.column("id")[i].as_py() for i in order]
        self.key = key[order]
        texts = [texts[i] for i in order]
        self.x = np.frombuffer(b"".join(texts), np.uint8)
        self.raw = self.x.tobytes()
        self.bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        self.length, self.width, self.ranges = length, length // 2, ranges
        first, count, anchor = [], [], []
        for lo, hi, ends in self._pieces():
            f, c, a = _anchors(self.x[lo:hi], ends, length)
            first.append(f + lo)
            count.append(c)
            anchor.append(a + lo)
        cat = lambda v: np.concatenate(v) if v else np.zeros(0, np.int64)
        self.first, self.count, self.anchor = cat(first), cat(count), cat(anchor)
        self.doc = np.searchsorted(self.bounds, self.first, "right") - 1
        h = _mixed(self.x, self.anchor, self.width)
        part = ((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
        self.mark = (part << np.uint64(32)) | (h & np.uint64(FULL))

    def _pieces(self):
        """(start, end, document ends inside) of stretches that hold every window once."""
        step, lo, ends = PIECE, 0, []
        for s, e in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist()):
            if e - s > step:
                if s > lo:
                    yield lo, s, ends
                for at in range(s, e - self.length + 1, step):
                    hi = min(e, at + step + self.length - 1)
                    yield at, hi, ([hi - at] if hi == e else [])
                lo, ends = e, []
                continue
            ends.append(e - lo)
            if e - lo > step:
                yield lo, e, ends
                lo, ends = e, []
        if lo < len(self.x):
            yield lo, len(self.x), ends

    def marks(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct marks, ascending, and whether two documents of the block hold each."""
        order = np.argsort(self.mark, kind="stable")
        m, k = self.mark[order], self.key[self.doc[order]]
        start = np.flatnonzero(np.concatenate(([True], m[1:] != m[:-1]))) if len(m) else np.zeros(0, np.int64)
        if not len(start):
            return m, np.zeros(0, bool)
        return m[start], np.minimum.reduceat(k, start) != np.maximum.reduceat(k, start)

    def by_range(self, marks: np.ndarray):
        """(range, first index, end index) of ascending marks."""
        part = (marks >> np.uint64(32)).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else np.zeros(0, np.int64)
        for s, e in zip(new, np.append(new[1:], len(part))):
            yield int(part[s]), int(s), int(e)

    def suffixes(self, shared: dict[int, np.ndarray]) -> dict[int, dict[bytes, list]]:
        """By range: suffix -> [smallest key, occurrences], for suffixes that may repeat."""
        marks, own = self.marks()
        keep = own.copy()
        for part, s, e in self.by_range(marks):
            if part in shared:
                keep[s:e] |= shared[part][:e - s]
        wanted = np.flatnonzero(keep[np.searchsorted(marks, self.mark)]) if len(marks) else []
        out: dict[int, dict[bytes, list]] = {}
        raw = self.raw
        for i, f, c, a, d, m in zip(wanted, self.first[wanted].tolist() if len(wanted) else [], self.count[wanted].tolist() if len(wanted) else [],
                                    self.anchor[wanted].tolist() if len(wanted) else [], self.doc[wanted].tolist() if len(wanted) else [],
                                    (self.mark[wanted] >> np.uint64(32)).tolist() if len(wanted) else []):
            # from the anchor on, then what stands before it, backwards; \xff is in no UTF-8 text
            s = raw[a:f + c + self.length - 1] + b"\xff" + raw[f:a][::-1]
            found = out.setdefault(m, {})
            k = self.key[d]
            if s in found:
                rec = found[s]
                if k < rec[0]:
                    rec[0] = k
                rec[1].append(i)
            else:
                found[s] = [k, [i]]
        return out


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of a and b, of which ``known`` bytes are known."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def front_code(run: list[bytes], keys: list[int]) -> bytes:
    """A sorted run as common-prefix lengths, remaining lengths, keys and remaining bytes."""
    shared = [0] + [common_prefix(a, b, 0) for a, b in zip(run, run[1:])]
    rest = [s[h:] for s, h in zip(run, shared)]
    return zlib.compress(b"".join([np.uint32(len(run)).tobytes(), np.array(shared, np.uint8).tobytes(),
                                   np.array([len(r) for r in rest], np.uint8).tobytes(),
                                   np.array(keys, np.int64).tobytes(), *rest]), 1)


def read_run(data: bytes) -> tuple[list[bytes], list[int], list[int]]:
    """(suffixes, common prefix with the one before, keys) of a front-coded run."""
    data = zlib.decompress(data)
    n = int(np.frombuffer(data, np.uint32, 1)[0])
    shared = list(data[4:4 + n])
    sizes = data[4 + n:4 + 2 * n]
    keys = np.frombuffer(data, np.int64, n, 4 + 2 * n).tolist()
    at, run, last = 4 + 10 * n, [], b""
    for h, size in zip(shared, sizes):
        last = last[:h] + data[at:at + size]
        at += size
        run.append(last)
    return run, shared, keys


class LoserTree:
    """Merges sorted runs; every comparison starts where the common prefix is no longer known.

    A node holds the loser of its match and the loser's common prefix with the winner that
    passed.  The next suffix of the winner's run brings its common prefix with the
    winner from the front coding, so of two contenders the one that shares more with the last
    winner is the smaller, without a look at their bytes; only equal lengths read on."""

    def __init__(self, runs: list[list[bytes]], shared: list[list[int]]):
        self.runs, self.shared = runs, shared
        self.size = 1
        while self.size < max(1, len(runs)):
            self.size *= 2
        self.at = [0] * len(runs)
        self.node = [(-1, 0)] * self.size  # (run, common prefix); run -1: exhausted
        self.top = self._fill(1)

    def _fill(self, i: int) -> tuple[int, int]:
        if i >= self.size:
            r = i - self.size
            return (r, 0) if r < len(self.runs) and self.runs[r] else (-1, 0)
        win, lose = self._match(self._fill(2 * i), self._fill(2 * i + 1))
        self.node[i] = lose
        return win

    def _match(self, x, y):
        """(winner, loser) of two contenders (run, common prefix with the last winner)."""
        if x[0] < 0:
            return y, x
        if y[0] < 0:
            return x, y
        if x[1] != y[1]:
            return (x, y) if x[1] > y[1] else (y, x)
        a, b, h = self.runs[x[0]][self.at[x[0]]], self.runs[y[0]][self.at[y[0]]], x[1]
        n = common_prefix(a, b, h)
        if a[n:n + 1] <= b[n:n + 1]:
            return x, (y[0], n)
        return y, (x[0], n)

    def __iter__(self):
        """(run, index, common prefix with the one before), in order."""
        runs, shared, at, node, size = self.runs, self.shared, self.at, self.node, self.size
        run, h = self.top
        while run >= 0:
            yield run, at[run], h
            at[run] += 1
            i = at[run]
            cur = (run, shared[run][i]) if i < len(runs[run]) else (-1, 0)
            p = (run + size) >> 1
            while p:
                other = node[p]
                if other[0] >= 0:
                    if cur[0] < 0 or cur[1] < other[1]:
                        cur, node[p] = other, cur
                    elif cur[1] == other[1]:
                        cur, node[p] = self._match(cur, other)
                p >>= 1
            run, h = cur


def merge_range(runs: list[bytes], length: int) -> list[np.ndarray]:
    """For every run, a bit mask a suffix: bit j is set if its j-th window also starts in a
    document with a smaller key than the suffix's."""
    read = [read_run(r) for r in runs]
    keys = [r[2] for r in read]
    texts = [r[0] for r in read]
    masks = [np.zeros(len(k), np.uint32) for k in keys]
    width = length // 2
    group: list[tuple[bytes, list]] = []

    def close():
        if len(group) == 1:
            holders = group[0][1]
            if len(holders) > 1:
                low = min(k for _, _, k in holders)
                for r, i, k in holders:
                    if low < k:
                        masks[r][i] = FULL
            return
        least: dict[bytes, int] = {}
        seen = []
        for s, holders in group:
            cut = s.index(b"\xff")
            full = s[cut + 1:][::-1] + s[:cut]
            wins = [full[j:j + length] for j in range(len(full) - length + 1)]
            low = min(k for _, _, k in holders)
            seen.append(wins)
            for w in wins:
                if least.get(w, low) >= low:
                    least[w] = low
        for (s, holders), wins in zip(group, seen):
            lows = [least[w] for w in wins]
            most, low = max(lows), min(lows)
            for r, i, k in holders:
                if most < k:
                    masks[r][i] = FULL
                elif low < k:
                    masks[r][i] = sum(1 << j for j, v in enumerate(lows) if v < k)

    last = b""
    for r, i, h in LoserTree(texts, [x[1] for x in read]):
        s = texts[r][i]
        if group and h == len(s) == len(last):
            group[-1][1].append((r, i, keys[r][i]))
        else:
            if group and h < width:
                close()
                group.clear()
            group.append((s, [(r, i, keys[r][i])]))
        last = s
    if group:
        close()
    return masks


def _announce(ranges: int, length: int):
    def run(rows: pa.Table) -> pa.Table:
        b = Block(rows, ranges, length)
        block = rows.column("block")[0].as_py()
        marks = b.marks()[0]
        low = (marks & np.uint64(FULL)).astype(np.uint32)
        parts = list(b.by_range(marks))
        return pa.table({"block": pa.array([block] * len(parts), pa.int64()), "part": pa.array([p for p, _, _ in parts], pa.int64()),
                         "data": pa.array([low[s:e].tobytes() for _, s, e in parts], pa.binary())})
    return run


def _meet(rows: pa.Table) -> pa.Table:
    """Which prefixes of a range several blocks hold: one bit each."""
    arrays = [np.frombuffer(d, np.uint32) for d in rows.column("data").to_pylist()]
    values, n = np.unique(np.concatenate(arrays), return_counts=True)
    values = values[n > 1]
    bits = []
    for a in arrays:
        i = np.searchsorted(values, a)
        i[i == len(values)] = 0
        bits.append(np.packbits(values[i] == a if len(values) else np.zeros(len(a), bool)).tobytes())
    return pa.table({"block": rows.column("block"), "part": rows.column("part"), "data": pa.array(bits, pa.binary())})


def _answers(answers: pa.Table) -> dict[int, bytes]:
    return dict(zip(answers.column("part").to_pylist(), answers.column("data").to_pylist()))


def _shared(answers: pa.Table) -> dict[int, np.ndarray]:
    return {p: np.unpackbits(np.frombuffer(d, np.uint8)).astype(bool) for p, d in _answers(answers).items()}


def _send(ranges: int, length: int):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        out = {"block": [], "part": [], "data": []}
        if rows.num_rows:
            b = Block(rows, ranges, length)
            block = rows.column("block")[0].as_py()
            for part, found in b.suffixes(_shared(answers)).items():
                order = sorted(found)
                out["block"].append(block)
                out["part"].append(part)
                out["data"].append(front_code(order, [found[s][0] for s in order]))
        return pa.table({"block": pa.array(out["block"], pa.int64()), "part": pa.array(out["part"], pa.int64()), "data": pa.array(out["data"], pa.binary())})
    return run


def _merge(length: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        masks = merge_range(rows.column("data").to_pylist(), length)
        return pa.table({"block": rows.column("block"), "part": rows.column("part"),
                         "data": pa.array([zlib.compress(m.tobytes(), 1) for m in masks], pa.binary())})
    return run


def _remove(ranges: int, length: int, with_rest: bool):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        cols: dict[str, list] = {"id": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "rest": []}
        if rows.num_rows:
            b = Block(rows, ranges, length)
            kind = answers.column("kind").to_pylist()
            pick = lambda k: answers.filter(pa.array([x == k for x in kind], pa.bool_()))
            masks = _answers(pick(1))
            start = np.zeros(len(b.x) + length + 1, bool)
            for part, found in b.suffixes(_shared(pick(0))).items():
                bits = np.frombuffer(zlib.decompress(masks[part]), np.uint32).tolist()
                for s, m in zip(sorted(found), bits):
                    low, at = found[s]
                    for i in at:
                        f, c = b.first[i], b.count[i]
                        if m == FULL or b.key[b.doc[i]] > low:
                            start[f:f + c] = True
                        elif m:
                            start[f:f + c] |= (m >> np.arange(c)) & 1 == 1
            at = np.flatnonzero(start)
            change = np.zeros(len(start) + length + 1, np.int32)
            change[at] += 1
            change[at + length] -= 1
            gone = np.cumsum(change)[:len(b.x)] > 0
            for d, (s, e) in enumerate(zip(b.bounds[:-1], b.bounds[1:])):
                g = gone[s:e]
                n = int(g.sum())
                rest = b.x[s:e][~g].tobytes() if n else b.raw[s:e]
                cols["id"].append(b.ids[d])
                cols["n_bytes"].append(int(e - s))
                cols["n_removed"].append(n)
                cols["n_spans"].append(int(g[:1].sum() + (g[1:] & ~g[:-1]).sum()) if n else 0)
                cols["kept_sha256"].append(hashlib.sha256(rest).hexdigest())
                cols["rest"].append(rest if with_rest else None)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        out = pa.table({c: pa.array(v, t) for (c, v), t in zip(cols.items(), kinds)})
        return out if with_rest else out.drop_columns(["rest"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, with_rest: bool = False) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256 and, ``with_rest``, the remaining bytes.

    A null text is empty.  A null id counts as larger than all others; rows with the same id
    (or both null) do not remove each other's bytes.  Matches never cross documents.  ``length`` is
    even and at most 126.  Extra columns are not read; an empty table gives an empty result.
    """
    rows = only(docs, id_col, text_col).toDF("id", "text").withColumn("id", F.col("id").cast("long"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    size = min(max(BLOCK_BYTES[0], total // 4096), BLOCK_BYTES[1])
    blocks = max(8, -(-total // size))
    ranges = max(8, -(-total * 2 // ((length // 2 + 2) * RANGE_ANCHORS)))
    texts = rows.select("id", F.coalesce("id", F.lit((1 << 63) - 1)).alias("key"), "text",
                        F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).alias("block"))
    shape = "block long, part long, data binary"
    met = texts.groupBy("block").applyInArrow(_announce(ranges, length), shape).groupBy("part").applyInArrow(_meet, shape)
    sent = texts.groupBy("block").cogroup(met.groupBy("block")).applyInArrow(_send(ranges, length), shape)
    merged = sent.groupBy("part").applyInArrow(_merge(length), shape)
    answers = met.withColumn("kind", F.lit(0)).unionByName(merged.withColumn("kind", F.lit(1)))
    shape = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", rest binary" if with_rest else "")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_remove(ranges, length, with_rest), shape)
