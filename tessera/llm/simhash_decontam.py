"""Benchmark decontamination with item-sized SimHash windows.

Method: words (lower case, outer punctuation trimmed) become 5-word shingles, weighted by how few
benchmark items hold them.  A window as long as an item, in words, gets a 128-bit weighted
SimHash.  The items' fingerprints lie in a multi-index of 16 blocks of 8 bits: a fingerprint within RADIUS
differs from an item's in at most RADIUS // 16 bits of some block, so looking up each block with
that tolerance finds every item within the radius.  Candidates within the radius are
verified by the exact weighted similarity of the shingle sets.

Windows that share no shingle with any item have similarity 0 and are not fingerprinted.  A fingerprint sums the
distinct shingles with the square roots of their weights, so its cosine follows the similarity, however often a
shingle is repeated: at least 8/9 at similarity 0.8.  RADIUS is five standard deviations above the distance
expected there.

Scale: one pass over whole texts, no shuffle.  The benchmark is sent to the tasks in portions of at
most PORTION_BYTES of text (more portions: more passes), whatever its size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, only, released, stored
from .common import portions as slices

WIDTH, LEAST = 5, 0.8
BITS, BLOCKS, RADIUS = 128, 16, 40
PORTION_BYTES = 16 << 20
WORD_CACHE = 100_000
STARTS = 4096
_TRIM = regex.compile(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$")
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class _Words(dict):
    """Hash of a trimmed, lower-cased word; 0 if nothing is left of it."""

    def __missing__(self, w):
        s = w if w.isalnum() else _TRIM.sub("", w)
        v = self[w] = (xxhash.xxh3_64_intdigest(s.lower().encode("utf-8", "surrogatepass")) | 1) if s else 0
        return v


def word_hashes(text: str | None, words: dict) -> np.ndarray:
    toks = (text or "").split()
    if len(words) > WORD_CACHE:
        words.clear()
    w = np.fromiter(map(words.__getitem__, toks), np.uint64, len(toks))
    return w[w != 0]


def shingles(w: np.ndarray, width: int) -> np.ndarray:
    n = len(w) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, width, np.uint64)
    for i in range(width):
        h = (h ^ w[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _signs(h: np.ndarray) -> np.ndarray:
    """(n, BITS) of +1 and -1 from shingle hashes."""
    out = np.empty((len(h), BITS // 64), np.uint64)
    for c in range(BITS // 64):
        g = (h + np.uint64(c + 1)) * np.uint64(0xBF58476D1CE4E5B9)
        g ^= g >> np.uint64(32)
        g *= np.uint64(0x94D049BB133111EB)
        out[:, c] = g ^ (g >> np.uint64(29))
    return np.unpackbits(out.view(np.uint8), axis=1).astype(np.int32) * 2 - 1


class Index:
    """Benchmark items by size, their fingerprints and the multi-index.

    ``total`` items have words in the whole benchmark, and ``counts`` has the number of items that hold a shingle, where
    above one; without them, ``items`` are the whole benchmark."""

    def __init__(self, items: list[tuple[int, str]], total: int | None = None, counts: dict[int, int] | None = None):
        words, found = _Words(), []
        for item, text in items:
            w = word_hashes(text, words)
            if len(w):
                width = min(WIDTH, len(w))
                found.append((item, len(w), width, np.unique(shingles(w, width))))
        df: dict[int, int] = {}
        for *_, own in found:
            for x in own.tolist():
                df[x] = df.get(x, 0) + 1 if counts is None else counts.get(x, 1)
        self.top = 1 + math.log(max(1, len(found) if total is None else total))
        self.weight = {x: self.top - math.log(n) for x, n in df.items()}
        self.known = np.array(sorted(df), np.uint64)
        self.known_weight = np.array([self.weight[x] for x in sorted(df)], np.float32)
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.known >> np.uint64(44)).astype(np.int64)] = True
        self.sizes: dict[int, dict] = {}
        for item, size, width, own in found:
            s = self.sizes.setdefault(size, {"width": width, "items": [], "sets": [], "prints": []})
            s["items"].append(item)
            s["sets"].append(own)
            s["prints"].append(np.packbits((_signs(own) * self.roots(own)[:, None]).sum(axis=0) > 0))
        near = np.array([[_POP[a ^ b] <= RADIUS // BLOCKS for b in range(256)] for a in range(256)])
        for s in self.sizes.values():
            p = s["prints"] = np.stack(s["prints"])
            s["tables"] = [near[:, p[:, b]] for b in range(BLOCKS)]  # value of a block -> items it may belong to
            s["all"] = np.unique(np.concatenate(s["sets"]))
        self.widths = sorted({s["width"] for s in self.sizes.values()})

    def _is_known(self, h: np.ndarray) -> np.ndarray:
        i = np.searchsorted(self.known, h)
        i[i == len(self.known)] = 0
        return self.known[i] == h if len(self.known) else np.zeros(len(h), bool)

    def weights(self, h: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(h), self.top, np.float32)
        i = np.searchsorted(self.known, h)
        i[i == len(self.known)] = 0
        return np.where(self.known[i] == h, self.known_weight[i], np.float32(self.top))

    def roots(self, h: np.ndarray) -> np.ndarray:
        """Square roots of the weights as whole numbers, so that sums and their differences are exact."""
        return np.rint(np.sqrt(self.weights(h)) * 1024).astype(np.int32)

    def _similar(self, window: np.ndarray, own: np.ndarray) -> float:
        u = np.unique(window)
        both = self.weights(np.intersect1d(u, own, assume_unique=True)).sum()
        return float(both / (self.weights(u).sum() + self.weights(own).sum() - both))

    def search(self, text: str | None, words: dict) -> list[tuple[int, float, int, int]]:
        """(item, best similarity, its first word, windows) of the items that a text holds."""
        w = word_hashes(text, words)
        best: dict[int, list] = {}
        for width in self.widths:
            sh = shingles(w, width)
            hit = np.flatnonzero(self.filter[(sh >> np.uint64(44)).astype(np.int64)])
            hit = hit[self._is_known(sh[hit])]
            if not len(hit):
                continue
            for size, s in self.sizes.items():
                m = min(size - width + 1, len(sh))  # a shorter text is its own window
                if s["width"] != width:
                    continue
                own = hit[np.isin(sh[hit], s["all"])]
                if not len(own):
                    continue
                starts = np.unique(np.clip((own[:, None] - np.arange(m)).ravel(), 0, len(sh) - m))
                for i in range(0, len(starts), STARTS):
                    self._windows(sh, starts[i:i + STARTS], m, s, best)
        return [(item, sim, at, n) for item, (sim, at, n) in sorted(best.items())]

    def _windows(self, sh, starts, m, s, best) -> None:
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > m) + 1):  # stretches of the text
            lo, part = run[0], sh[run[0]:run[-1] + m]
            total = np.zeros((len(part) + 1, BITS), np.int32)
            value = _signs(part) * self.roots(part)[:, None]
            np.cumsum(value, axis=0, out=total[1:])
            sums = total[run - lo + m] - total[run - lo]
            order = np.argsort(part, kind="stable")
            same = np.flatnonzero(part[order[1:]] == part[order[:-1]])
            j, p = order[same + 1], order[same]  # a shingle and the same one before it
            j, p = j[j - p < m], p[j - p < m]
            if len(j):  # windows that hold both count it once
                twice = np.zeros((len(part) - m + 2, BITS), np.int32)
                np.add.at(twice, np.maximum(j - m + 1, 0), value[j])
                np.subtract.at(twice, np.minimum(p + 1, len(part) - m + 1), value[j])
                sums -= np.cumsum(twice, axis=0, dtype=np.int32)[run - lo]
            prints = np.packbits(sums > 0, axis=1)
            maybe = s["tables"][0][prints[:, 0]].copy()
            for b in range(1, BLOCKS):
                maybe |= s["tables"][b][prints[:, b]]
            r, c = np.nonzero(maybe)
            near = _POP[prints[r] ^ s["prints"][c]].sum(axis=1) <= RADIUS
            for at, i in zip(run[r[near]].tolist(), c[near].tolist()):
                sim = self._similar(sh[at:at + m], s["sets"][i])
                if sim >= LEAST - 1e-6:
                    old = best.setdefault(s["items"][i], [0.0, at, 0])
                    if sim > old[0]:
                        old[:2] = sim, at
                    old[2] += 1


def weighed(benchmark: DataFrame, id_col: str, text_col: str) -> tuple[int, DataFrame]:
    """The number of items with words, and (id, text, common) of them: the shingles that several items hold and how many do."""
    src = only(benchmark, id_col, text_col).toDF("id", "text").where("id is not null and text is not null")

    def run(batches):
        words = _Words()
        for batch in batches:
            own = []
            for t in batch.column("text").to_pylist():
                w = word_hashes(t, words)
                own.append(np.unique(shingles(w, min(WIDTH, len(w)))).view(np.int64) if len(w) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text"), pa.array(own, pa.list_(pa.int64()))], names=["id", "text", "own"])

    items = stored(src.mapInArrow(run, f"id {dict(src.dtypes)['id']}, text string, own array<bigint>").where("size(own) > 0"), "benchmark")
    items = items.withColumn("k", F.sha2("text", 256))
    several = items.select(F.explode("own").alias("h")).groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    common = items.select("k", F.explode("own").alias("h")).distinct().join(several, "h").groupBy("k").agg(F.collect_list(F.struct("h", "n")).alias("common"))
    return items.count(), stored(items.join(common, "k", "left").select("id", "text", "common"), "weighed")


def portions(benchmark: DataFrame, id_col: str, text_col: str):
    """Arguments of Index: the benchmark's items, in lists of at most PORTION_BYTES of text (or one item), with the
    number of all items and the counts of the portion's common shingles."""
    total, items = weighed(benchmark, id_col, text_col)
    part, size, counts = [], 0, {}
    for r in items.toLocalIterator():
        n = len(r["text"].encode("utf-8", "surrogatepass"))
        if part and size + n > PORTION_BYTES:
            yield part, total, counts
            part, size, counts = [], 0, {}
        part.append((r["id"], r["text"]))
        counts.update((c["h"] % (1 << 64), c["n"]) for c in r["common"] or [])
        size += n
    if part:
        yield part, total, counts


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
         item_text: str = "text") -> DataFrame:
    """(id, item_id, similarity, first_word, n_windows): a row for each document row and item it holds.

    Null, empty and wordless texts and items hold nothing; items with a null id are left
    out; an item of fewer than five words is one shingle.  Documents with null or repeated ids are
    searched row by row.  Extra columns are not read; empty tables give an empty result.
    """
    kind, item_kind = dict(docs.dtypes)[id_col], dict(benchmark.dtypes)[item_id]
    schema = f"`{id_col}` {kind}, `{item_id}` {item_kind}, similarity double, first_word long, n_windows long"
    types = [pa.float64(), pa.int64(), pa.int64()]
    src = only(docs, id_col, text_col).toDF("id", "text")

    def search(portion):
        def run(batches):
            index, words = Index(*portion), _Words()
            for batch in slices(batches):
                row, hits = [], []
                for i, t in enumerate(batch.column("text").to_pylist()):
                    for h in index.search(t, words):
                        row.append(i)
                        hits.append(h)
                cols = list(zip(*hits)) if hits else [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(row, pa.int64())), pa.array(cols[0], pa.int64()),
                     *[pa.array(c, t) for c, t in zip(cols[1:], types)]],
                    names=[id_col, item_id, "similarity", "first_word", "n_windows"])
        return released(run)

    out = docs.sparkSession.createDataFrame([], schema)
    for n, portion in enumerate(portions(benchmark, item_id, item_text)):
        one = src.mapInArrow(search(portion), schema)
        out = one if n == 0 else out.unionByName(one)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns kept."""
    flag = fresh(docs, "__leak")
    schema = T.StructType([*docs.schema.fields, T.StructField(flag, T.BooleanType())])

    def mark(portion):
        def run(batches):
            index, words = Index(*portion), _Words()
            for batch in slices(batches, text_col):
                leak = [bool(index.search(t, words)) for t in batch.column(text_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leak, pa.bool_())], names=[*batch.schema.names, flag])
        return released(run)

    for portion in portions(benchmark, item_id, item_text):
        docs = docs.mapInArrow(mark(portion), schema).where(~F.col(flag)).drop(flag)
    return docs
