"""MinHash near-duplicates with odd sketches.

Method: every text becomes a set of word shingles, hashed to 64 bits.  160 MinHash
samples give 40 bands of 4 (a pair at similarity 0.8 shares no band with
probability (1 - 0.8^4)^40 < 1e-9).  The same samples are folded into a
512-bit parity bitmap (odd sketch): sample i flips bit h(i, min_i), so the
population count of the XOR of two sketches estimates the similarity.  A second odd sketch
holds the whole set in 1024 bits: its XOR count never exceeds the size of the symmetric
difference, so a larger count than similarity 0.8 allows rules a pair out for certain.  Pairs of a
band bucket pass both sketches (estimate >= 0.55, over five standard deviations below
0.8) and are then confirmed on the full shingle sets.

Groups: equal shingle sets are one class.  In a bucket, every class is first
compared with the bucket's smallest member (a star: linear in the bucket).  After
components are joined, members of different components of a bucket are compared by their sketches alone,
inside tasks and in parts of CHUNK members; only pairs that pass leave the task.  So no
link is lost, and a bucket never yields all its pairs as rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, portions, released, stored
from .components import components

ROWS, BANDS = 4, 40
SAMPLES = ROWS * BANDS
SKETCH_BITS, SET_BITS = 512, 1024
LEAST_ESTIMATE = 0.55
#: Largest XOR population count whose estimate 1 + n/(4k) ln(1 - 2x/n) reaches LEAST_ESTIMATE.
MOST_FLIPS = int(SKETCH_BITS / 2 * (1 - np.exp(-4 * SAMPLES * (1 - LEAST_ESTIMATE) / SKETCH_BITS)))
#: Members of a bucket (on average) that are compared with each other in one group.
CHUNK = 1024


@lru_cache(maxsize=1)
def _tables():
    rng = np.random.default_rng(20240229)
    a = rng.integers(0, 2**32, SAMPLES, dtype=np.uint32) | np.uint32(1)
    b = rng.integers(0, 2**32, SAMPLES, dtype=np.uint32)
    salt = rng.integers(0, 2**63, SAMPLES, dtype=np.uint64)
    odd = rng.integers(0, 2**63, 64, dtype=np.uint64) | np.uint64(1)
    return a, b, salt, odd


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of a text (A-Z
    lower-cased); a text of fewer words is one shingle, one without words none."""
    if not text:
        return np.zeros(0, np.uint64)
    toks = text.encode("utf-8", "surrogatepass").lower().split()
    if not toks:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, toks), np.uint64, len(toks))
    odd = _tables()[3]
    k = min(width, len(w))
    n = len(w) - k + 1
    h = np.full(n, np.uint64(k) * odd[63], np.uint64)
    for i in range(k):
        h += w[i:i + n] * odd[i]
        h ^= h >> np.uint64(33)
    return np.unique(_mix(h))


def signature(h: np.ndarray) -> np.ndarray:
    """SAMPLES MinHash values of a non-empty set of 64-bit hashes."""
    a, b, _, _ = _tables()
    x = (h >> np.uint64(32)).astype(np.uint32)
    low = None
    for i in range(0, len(x), 1024):
        part = (x[i:i + 1024, None] * a + b).min(axis=0)
        low = part if low is None else np.minimum(low, part)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    _, _, salt, odd = _tables()
    v = low.astype(np.uint64).reshape(BANDS, ROWS)
    h = salt[:BANDS].copy()
    for r in range(ROWS):
        h = _mix(h + v[:, r] * odd[r])
    return h


def odd_sketch(low: np.ndarray) -> np.ndarray:
    salt = _tables()[2]
    bit = (_mix(low.astype(np.uint64) + salt) >> np.uint64(55)).astype(np.int64)
    parity = (np.bincount(bit, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64)


def set_sketch(h: np.ndarray) -> np.ndarray:
    """Parity bitmap of a whole set of 64-bit hashes."""
    parity = (np.bincount((h & np.uint64(SET_BITS - 1)).astype(np.int64), minlength=SET_BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64)


def _features(width: int):
    def run(batches):
        for batch in portions(batches):
            n, k1, k2, bands, sketch, whole = [], [], [], [], [], []
            for text in batch.column("text").to_pylist():
                h = shingle_hashes(text, width)
                d = xxhash.xxh3_128_intdigest(h.tobytes())
                n.append(len(h))
                k1.append((d >> 64) - (1 << 63))
                k2.append((d & (1 << 64) - 1) - (1 << 63))
                if len(h):
                    low = signature(h)
                    bands.append(band_keys(low).view(np.int64))
                    sketch.append(odd_sketch(low))
                    whole.append(set_sketch(h))
                else:
                    bands.append(None)
                    sketch.append(None)
                    whole.append(None)
            arr = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                 pa.array(bands, arr), pa.array(sketch, arr), pa.array(whole, arr)],
                names=["id", "n", "k1", "k2", "bands", "sketch", "whole"])
    return released(run)


def _sets(width: int):
    def run(batches):
        for batch in portions(batches):
            s = [shingle_hashes(t, width).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(s, pa.list_(pa.int64()))], names=["id", "s"])
    return released(run)


def _confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose full shingle sets are similar enough."""
    ids = pairs.select(F.col("u").alias("id")).unionByName(pairs.select(F.col("v").alias("id"))).distinct()
    sets = texts.join(ids, "id", "left_semi").mapInArrow(_sets(width), "id long, s array<long>")
    sets = stored(sets, "sets")
    a, b = sets.toDF("u", "su"), sets.toDF("v", "sv")
    inter = F.size(F.array_intersect("su", "sv"))
    # 100 i >= p (a + b - i), with the intersection written once
    alike = F.lit(100 + percent) * inter >= F.lit(percent) * (F.size("su") + F.size("sv"))
    return pairs.join(a, "u").join(b, "v").where(alike).select("u", "v")


def _sketched(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that the sizes and the odd sketches allow."""
    a = classes.select(F.col("rep").alias("u"), F.col("n").alias("nu"), F.col("sketch").alias("ku"), F.col("whole").alias("wu"))
    b = classes.select(F.col("rep").alias("v"), F.col("n").alias("nv"), F.col("sketch").alias("kv"), F.col("whole").alias("wv"))
    flips = lambda x, y, bits: sum((F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(bits // 64)), F.lit(0))
    fits = F.lit(100) * F.least("nu", "nv") >= F.lit(percent) * F.greatest("nu", "nv")
    # the symmetric difference at the least similarity is (100 - p) / (100 + p) of both sizes
    apart = F.lit(100 + percent) * flips("wu", "wv", SET_BITS) > F.lit(100 - percent) * (F.col("nu") + F.col("nv"))
    return pairs.join(a, "u").join(b, "v").where(fits & (flips("ku", "kv", SKETCH_BITS) <= MOST_FLIPS) & ~apart).select("u", "v").distinct()


def _apart(percent: int):
    """Pairs of a group, of different components, that the sizes and the odd sketches allow.

    Rows come sorted by group (b, g0, g1); only pairs that pass leave the task."""
    def pairs(t: dict):
        k, m, n, c, rep, lead, p = (t[x] for x in ("sketch", "whole", "n", "c", "rep", "lead", "p"))
        two = t["g0"][0] != t["g1"][0]
        left = np.flatnonzero(p == t["g0"][0]) if two else np.arange(len(n))
        right = np.flatnonzero(p == t["g1"][0]) if two else left
        for i in range(0, len(left), 256):
            a = left[i:i + 256]
            fits = (c[a, None] != c[right]) & (rep[a, None] != lead[right]) & (rep[right] != lead[a, None])
            fits &= 100 * np.minimum(n[a, None], n[right]) >= percent * np.maximum(n[a, None], n[right])
            if not two:
                fits &= rep[a, None] < rep[right]
            x, y = np.nonzero(fits)
            x, y = a[x], right[y]
            for j in range(0, len(x), 1 << 16):
                u, v = x[j:j + (1 << 16)], y[j:j + (1 << 16)]
                near = np.bitwise_count(k[u] ^ k[v]).sum(axis=1) <= MOST_FLIPS
                u, v = u[near], v[near]
                near = (100 + percent) * np.bitwise_count(m[u] ^ m[v]).sum(axis=1, dtype=np.int64) <= (100 - percent) * (n[u] + n[v])
                yield rep[u[near]], rep[v[near]]

    def run(batches):
        names = ["b", "g0", "g1", "p", "lead", "rep", "c", "n"]
        held: list[dict] = []

        def flush(t):
            cut = np.flatnonzero((t["b"][1:] != t["b"][:-1]) | (t["g0"][1:] != t["g0"][:-1]) | (t["g1"][1:] != t["g1"][:-1])) + 1
            us, vs = [], []
            for s, e in zip(np.append(0, cut), np.append(cut, len(t["b"]))):
                for u, v in pairs({x: y[s:e] for x, y in t.items()}):
                    us.append(u)
                    vs.append(v)
            u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t = {x: batch.column(x).to_numpy() for x in names}
            for x in ("sketch", "whole"):
                t[x] = np.asarray(batch.column(x).flatten()).reshape(batch.num_rows, -1)
            held.append(t)
            last = tuple(t[x][-1] for x in ("b", "g0", "g1"))
            if tuple(held[0][x][0] for x in ("b", "g0", "g1")) == last:
                continue  # one group so far: at most two parts of CHUNK members on average
            t = {x: np.concatenate([h[x] for h in held]) for x in held[0]}
            done = int(np.flatnonzero((t["b"] != last[0]) | (t["g0"] != last[1]) | (t["g1"] != last[2]))[-1]) + 1
            held = [{x: y[done:] for x, y in t.items()}]
            yield flush({x: y[:done] for x, y in t.items()})
        if held:
            yield flush({x: np.concatenate([h[x] for h in held]) for x in held[0]})
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4,
                    percent: int = 80) -> DataFrame:
    """One row per input row: ``id``, ``n_shingles``, ``component_id``, ``kept``.

    Null, empty and wordless texts have no shingles and link with nothing.  Rows that
    repeat an id are one document (its texts' links are united).  Rows with a null id link
    with nothing: component null, kept.  An empty table gives an empty result.  Extra
    columns are not read.
    """
    texts = only(docs, id_col, text_col).toDF("id", "text").withColumn("id", F.col("id").cast("long"))
    feats = stored(texts.mapInArrow(_features(width),
                                    "id long, n long, k1 long, k2 long, bands array<long>, sketch array<long>, whole array<long>"), "minhash")
    full = feats.where("n > 0 and id is not null")
    classes = stored(full.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.first("n").alias("n"),
                                                  F.first("bands").alias("bands"), F.first("sketch").alias("sketch"),
                                                  F.first("whole").alias("whole")), "classes")
    spread = classes.select("rep", F.explode("bands").alias("b"))
    lead = spread.groupBy("b").agg(F.min("rep").alias("lead"), F.max("rep").alias("last")).where("lead <> last").select("b", "lead")
    members = stored(spread.join(lead, "b"), "members")

    star = members.where("lead <> rep").select(F.col("lead").alias("u"), F.col("rep").alias("v")).distinct()
    links = stored(_confirm(_sketched(star, classes, percent), texts, width, percent), "links")
    comp = components(links, "star")

    # what a star left apart: buckets whose members are not all in one component
    placed = members.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select(
        "b", "lead", "rep", F.coalesce("component", "rep").alias("c"))
    mixed = (placed.groupBy("b").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.count("*").alias("m"))
             .where("c0 <> c1").select("b", F.ceil(F.col("m") / CHUNK).cast("int").alias("q")))
    placed = placed.join(mixed, "b").join(classes.select("rep", "n", "sketch", "whole"), "rep")
    # a bucket above CHUNK members is dealt into q parts, and each pair of parts is a group
    part = F.pmod(F.xxhash64("rep"), F.col("q")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("q") - 1))
    dealt = placed.withColumn("p", part).withColumn("o", other).select(
        "b", F.least("p", "o").alias("g0"), F.greatest("p", "o").alias("g1"), "p", "lead", "rep", "c", "n", "sketch", "whole")
    rest = (dealt.repartition("b", "g0", "g1").sortWithinPartitions("b", "g0", "g1")
            .mapInArrow(_apart(percent), "u long, v long").distinct())
    more = stored(_confirm(rest, texts, width, percent), "more")
    comp = components(links.unionByName(more), "all")

    # a class's rows follow its representative
    by_class = classes.select("k1", "k2", "rep").join(comp.withColumnRenamed("node", "rep"), "rep", "left").select(
        "k1", "k2", F.coalesce("component", "rep").alias("c"))
    rows = feats.select("id", "n", "k1", "k2").join(by_class, ["k1", "k2"], "left")
    component = F.when(F.col("id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("c", "id"))
    return rows.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                       F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
