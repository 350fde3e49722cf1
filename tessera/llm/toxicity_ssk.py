"""Toxicity: a support vector machine on a gap-weighted subsequence string kernel.

Method: the kernel of two strings sums, over all common subsequences of three characters,
a decay for every position that the subsequence spans in either, so an insult with gaps or
inserted characters stays close to the insult.  Nyström landmarks turn the kernel into a fixed
linear form: a unit's decision is a weighted sum of its normalised kernels with the landmarks.

Units are a text's words (trimmed of outer punctuation, lower-cased; runs of single letters are
joined, so spelled-out insults form one unit).  Sentences are labelled only through
their documents, so units carry both counts: documents labelled toxic and not that hold them.
A text's score is a logistic function of its three highest unit decisions.

Training uses labelled documents only: at most MAX_DOCS a class (the first by a hash of the id),
of which at most MAX_UNITS units a kind reach the driver.  The share of toxic rows, language, source
and id are no inputs.  Scoring is one pass over whole texts without a shuffle.
"""

from __future__ import annotations

import uuid
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, only, portions, released

#: Bounds of the training sample: labelled documents a class, units a kind.
MAX_DOCS, MAX_UNITS = 4000, 3000
LANDMARKS, DECAY, POWER, TOP = 48, 0.7, 4, 3
#: A bad unit is at least so sure, as a share of the surest.
LEAST_SURE = 0.25
#: Units of a generation whose decisions a worker remembers: a full one becomes the older one, which is then forgotten.
UNIT_CACHE = 150_000
_TRIM = regex.compile(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$")


def units(text: str | None) -> list[str]:
    """Units of a text, in order."""
    out: list[str] = []
    run: list[str] = []
    for w in (text or "").lower().split():
        if not (w[0].isalnum() and w[-1].isalnum()):
            w = _TRIM.sub("", w)
            if not w:
                continue
        if len(w) == 1:
            run.append(w)
            continue
        if run:
            if len(run) > 2:
                out.append("".join(run))
            run = []
        if len(w) > 2:
            out.append(w)
    if len(run) > 2:
        out.append("".join(run))
    return out


def _codes(word: str) -> np.ndarray:
    """Code points between a start and an end mark, so stems and endings differ."""
    return np.frombuffer(f"\x01{word}\x02".encode("utf-32-le", "surrogatepass"), np.uint32)


@lru_cache(maxsize=80)
def _triples(m: int) -> tuple[np.ndarray, np.ndarray]:
    """All places i < j < k in a string of m characters, and the decays of their spans."""
    at = np.array(list(combinations(range(m), 3)), np.int64).reshape(-1, 3)
    return at, (np.float32(DECAY) ** (at[:, 2] - at[:, 0] + 1)).astype(np.float32)


class Landmarks:
    """Target strings as rows of their length-3 subsequences' weights: the kernel of a string with
    all targets is the sum of the rows of its own subsequences."""

    def __init__(self, words: list[str]):
        codes = [_codes(w) for w in words]
        self.words = words
        self.letters = np.unique(np.concatenate(codes)) if words else np.zeros(0, np.uint32)
        self.base = len(self.letters) + 1
        self.row = np.full(self.base ** 3, -1, np.int32)
        held = []
        for m, c in enumerate(codes):
            at, decay = _triples(len(c))
            code = self._code(np.searchsorted(self.letters, c)[None], at)[0]
            held.append((np.full(len(at), m), code, decay))
        code = np.concatenate([h[1] for h in held]) if held else np.zeros(0, np.int64)
        known = np.unique(code)
        self.row[known] = np.arange(len(known), dtype=np.int32)
        self.rows = np.zeros((len(known), len(words)), np.float32)
        for m, code, decay in held:
            np.add.at(self.rows, (self.row[code], m), decay)
        self.own = np.sqrt(np.maximum(_own(words), 1e-12))

    def _code(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (ids[:, at[:, 0]] * self.base + ids[:, at[:, 1]]) * self.base + ids[:, at[:, 2]]

    def kernel(self, s: np.ndarray) -> np.ndarray:
        """Kernels (B, words) of strings s (B, m)."""
        out = np.zeros((len(s), len(self.words)), np.float32)
        if not len(self.letters):
            return out
        ids = np.searchsorted(self.letters, s)
        ids[ids == len(self.letters)] = 0
        ids = np.where(self.letters[ids] == s, ids, len(self.letters)).astype(np.int64)
        at, decay = _triples(s.shape[1])
        row = self.row[self._code(ids, at)]
        word, place = np.nonzero(row >= 0)
        if len(word):
            start = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            out[word[start]] = np.add.reduceat(self.rows[row[word, place]] * decay[place][:, None], start, axis=0)
        return out


def self_kernel(s: np.ndarray) -> np.ndarray:
    """The kernel of each string with itself, by the usual recursion over prefixes, one step a
    character.  The states are kept divided by DECAY**j at target position j, so that the
    recursion over the target is a plain running sum."""
    r = np.ascontiguousarray(s.T)
    lam = np.float32(DECAY)
    j = np.arange(len(r), dtype=np.float32)[:, None]
    back, first = lam ** (j[1:] + 2), lam ** (1 - j)
    k1, k2 = np.zeros(r.shape, np.float32), np.zeros(r.shape, np.float32)
    total = np.zeros(r.shape[1], np.float32)
    for c in r:
        hit = (r == c).astype(np.float32)
        total += (hit[1:] * k2[:-1] * back).sum(axis=0)
        step = hit[1:] * k1[:-1] * lam
        k2 *= lam
        k2[1:] += np.cumsum(step, axis=0)
        k1 *= lam
        k1 += np.cumsum(hit * first, axis=0)
    return total


def _grouped(words: list[str], longest: int = 64):
    """(positions, code matrix) of words by length; a longer word is cut into overlapping
    pieces of ``longest`` characters, so no part of it is left out."""
    by: dict[int, tuple[list, list]] = {}
    for i, w in enumerate(words):
        c = _codes(w)
        for at in range(0, max(1, len(c) - longest // 2), longest // 2) if len(c) > longest else (0,):
            part = c[at:at + longest]
            pos, rows = by.setdefault(len(part), ([], []))
            pos.append(i)
            rows.append(part)
    for m, (pos, rows) in by.items():
        if m > 2:
            step = max(1, min(512, 120_000 // max(1, (m * m * m) // 6)))
            for k in range(0, len(pos), step):
                yield np.array(pos[k:k + step]), np.stack(rows[k:k + step])


def decisions(words: list[str], model: dict) -> np.ndarray:
    """The machine's decision for each word (the largest of a very long word's pieces)."""
    out = np.full(len(words), -np.inf, np.float32)
    for pos, k in similarities(words, model["marks"]):
        np.maximum.at(out, pos, k @ model["weights"] + model["bias"])
    out[np.isinf(out)] = model["bias"]
    return out


def similarities(words: list[str], marks: Landmarks):
    """(positions, POWER-th powers of normalised kernels with the landmarks) of groups of words."""
    for pos, s in _grouped(words):
        k = marks.kernel(s) / marks.own
        k /= np.sqrt(np.maximum(self_kernel(s), 1e-12))[:, None]
        yield pos, k ** POWER


def _sureness(a, b, n_toxic: int, n_clean: int):
    """How surely a unit goes with toxic documents: the root of the likelihood ratio of its 2 x 2 table of documents.  Unlike
    an odds ratio's error, it grows with a unit that no clean document holds."""
    def cell(held, n, share):
        return F.when(held > 0, held * F.log(held / (n * share))).otherwise(0.0)

    n = n_toxic + n_clean
    there, away = a + b, F.lit(n) - a - b
    g = sum((cell(o, m, k / n) for o, m, k in ((a, there, n_toxic), (b, there, n_clean), (F.lit(n_toxic) - a, away, n_toxic), (F.lit(n_clean) - b, away, n_clean))), F.lit(0.0))
    return F.sqrt(F.greatest(2 * g, F.lit(0.0)))


def choose_marks(words: list[str], z: np.ndarray, most: int) -> list[str]:
    """The surest words that differ from those before them."""
    order = [words[i] for i in sorted(range(len(words)), key=lambda i: (-z[i], words[i])) if len(words[i]) <= 16][:600]
    if not order:
        return []
    alike = np.zeros((len(order), len(order)), np.float32)
    for pos, k in similarities(order, Landmarks(order)):
        alike[pos] = k
    kept: list[int] = []
    for i in range(len(order)):
        if len(kept) < most and all(alike[i, j] < 0.8 ** POWER for j in kept):
            kept.append(i)
    return [order[i] for i in kept]


def _own(words: list[str]) -> np.ndarray:
    out = np.zeros(len(words), np.float32)
    for pos, s in _grouped(words):
        out[pos] = self_kernel(s)
    return out


def fit_units(bad: list[tuple[str, int]], clean: list[tuple[str, int]], marks: list[str]) -> dict:
    """A machine from bad and clean units with document counts, and landmarks."""
    if not bad or not marks:
        return {"marks": Landmarks([]), "weights": np.zeros(0, np.float32), "bias": np.float32(-1)}
    # a bad unit counts again with a mark or a doubled character inserted
    bad = bad + [(w[:len(w) // 2] + x + w[len(w) // 2:], c) for w, c in bad for x in ("-", w[len(w) // 2])]
    words = [w for w, _ in bad + clean]
    y = np.repeat([1.0, -1.0], [len(bad), len(clean)])
    n = np.log1p(np.array([c for _, c in bad + clean], np.float64))
    weight = np.where(y > 0, n / max(n[y > 0].sum(), 1e-9), n / max(n[y < 0].sum(), 1e-9))
    held = Landmarks(marks)
    gram = np.zeros((len(marks), len(marks)))
    for pos, k in similarities(marks, held):
        gram[pos] = k
    feats = np.zeros((len(words), len(marks)))
    for pos, k in similarities(words, held):
        feats[pos] = k
    val, vec = np.linalg.eigh((gram + gram.T) / 2)
    root = (vec / np.sqrt(np.maximum(val, 1e-3))) @ vec.T
    v = _svm(np.hstack([feats @ root, np.ones((len(words), 1))]), y, weight)
    return {"marks": held, "weights": (root @ v[:-1]).astype(np.float32), "bias": np.float32(v[-1])}


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 200.0, rounds: int = 60) -> np.ndarray:
    """Squared-hinge linear SVM by Newton steps on the rows inside the margin."""
    v = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        inside = y * (x @ v) < 1
        xw = x[inside] * (c * weight[inside])[:, None]
        nxt = np.linalg.solve(ridge + xw.T @ x[inside], xw.T @ y[inside])
        if np.abs(nxt - v).max() < 1e-7:
            break
        v = 0.5 * v + 0.5 * nxt
    return v


#: Key of the model, and the decisions of the units met lately, in two generations.
_MEMORY: dict = {"key": None, "new": {}, "old": {}}


def _forget() -> None:
    _MEMORY.update(key=None, new={}, old={})


def _tops(texts: list[str | None], model: dict) -> np.ndarray:
    """The TOP highest unit decisions of each text; texts with fewer units get the lowest."""
    if _MEMORY["key"] != model["key"]:
        _MEMORY.update(key=model["key"], new={}, old={})
    out = np.full((len(texts), TOP), -3.0, np.float64)
    if len(_MEMORY["new"]) > UNIT_CACHE:
        _MEMORY.update(new={}, old=_MEMORY["new"])
    known, old = _MEMORY["new"], _MEMORY["old"]
    held = [set(units(t)) for t in texts]
    missing = []
    for u in set().union(*held) - known.keys() if held else ():
        d = old.get(u)
        if d is None:
            missing.append(u)
        else:
            known[u] = d
    known.update(zip(missing, decisions(missing, model).tolist()))
    for i, u in enumerate(held):
        best = sorted(map(known.__getitem__, u), reverse=True)[:TOP]
        out[i, :len(best)] = best
    return np.clip(out, -3, 3)


def _platt(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weighted logistic regression (both classes count alike), Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    v = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        g = x.T @ (w * (y - p)) - 0.5 * v
        h = (x * (w * p * (1 - p) + 1e-9)[:, None]).T @ x + 0.5 * np.eye(x.shape[1])
        v += np.linalg.solve(h, g)
    return v


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> dict:
    """A model from the labelled rows given (hold rows out before calling).

    Null ids, texts and labels are left out; an id with labels of both kinds counts in
    both classes.  Without a toxic row the model rejects nothing."""
    lab = only(labels, id_col, label_col).toDF("id", "y").where("id is not null and y in (0, 1)").distinct()
    order = F.xxhash64(F.col("id"), F.lit(17))
    picked = None
    for y in (0, 1):
        one = lab.where(F.col("y") == y).orderBy(order, "id").limit(MAX_DOCS)
        picked = one if picked is None else picked.unionByName(one)
    # at most 2 * MAX_DOCS rows of two numbers: the bound holds at every size
    rows = only(docs, id_col, text_col).toDF("id", "text").where("text is not null").join(F.broadcast(picked), "id").select("y", "text")

    def unit_sets(batches):
        for batch in portions(batches):
            y, u = [], []
            for label, t in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist()):
                for w in set(units(t)):
                    if len(w) <= 64:
                        y.append(label)
                        u.append(w)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.string()), pa.array(y, pa.int32())], names=["u", "y"])

    counts = rows.withColumn("y", F.col("y").cast("int")).mapInArrow(unit_sets, "u string, y int").groupBy("u").agg(
        F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    counts = counts.persist()
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    odds = F.log((F.col("a") + 0.5) / (n1 + 1)) - F.log((F.col("b") + 0.5) / (n0 + 1))
    z = _sureness(F.col("a"), F.col("b"), max(n1, 1), max(n0, 1))
    likely = (odds > 1.5) & (z > 2.5) & (F.col("a") >= 3)
    # words of a few copied toxic documents are far less sure than insults, which many documents hold
    surest = counts.where(likely).agg(F.max(z)).first()[0] or 0.0
    is_bad = likely & (z >= LEAST_SURE * surest)
    top = counts.where(is_bad).select("u", "a", z.alias("z")).orderBy(F.desc("z"), "u").limit(MAX_UNITS // 3).collect()
    bad = [(r["u"], r["a"]) for r in top]
    marks = choose_marks([w for w, _ in bad], np.array([r["z"] for r in top]), LANDMARKS * 3 // 4)
    clean: list[tuple[str, int]] = []
    if marks:
        held = Landmarks(marks)

        def nearness(batches):
            for batch in batches:
                u = batch.column("u").to_pylist()
                near = np.zeros(len(u), np.float32)
                for pos, k in similarities(u, held):
                    np.maximum.at(near, pos, k.max(axis=1))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.float32())], names=["u", "b", "near"])

        # clean units: those most like a landmark, the commonest, and an even spread
        others = counts.where(~is_bad & (F.col("b") > 0)).select("u", "b")
        close = others.mapInArrow(nearness, "u string, b long, near float").orderBy(F.desc("near"), "u").limit(MAX_UNITS).collect()
        common = others.orderBy(F.desc("b"), "u").limit(MAX_UNITS // 3).collect()
        spread = others.orderBy(F.xxhash64("u"), "u").limit(MAX_UNITS).collect()
        clean = sorted({r["u"]: r["b"] for r in [*close, *common, *spread]}.items())
        weight = {r["u"]: r["near"] * np.log1p(r["b"]) for r in close}
        against = sorted(weight, key=lambda u: (-weight[u], u))[:600]
        marks += choose_marks(against, np.array([weight[u] for u in against]), LANDMARKS - len(marks))
    counts.unpersist()
    model = fit_units(bad, clean, marks)
    model["key"] = uuid.uuid4().hex

    def tops(batches):
        for batch in portions(batches):
            x = _tops(batch.column("text").to_pylist(), model)
            yield pa.RecordBatch.from_arrays([batch.column("y"), *[pa.array(x[:, j]) for j in range(TOP)]],
                                             names=["y", *[f"x{j}" for j in range(TOP)]])

    shape = "y int, " + ", ".join(f"x{j} double" for j in range(TOP))
    sample = rows.withColumn("y", F.col("y").cast("int")).mapInArrow(tops, shape).collect()  # 2 * MAX_DOCS rows at most, but for repeated ids
    data = np.array(sorted(map(tuple, sample)), np.float64).reshape(-1, TOP + 1)
    model["platt"] = _platt(data[:, 1:], data[:, 0]) if len(set(data[:, 0])) == 2 else np.array([0.0] * TOP + [-3.0])
    return model


def _probability(texts: list[str | None], model: dict) -> np.ndarray:
    x = _tops(texts, model)
    return 1 / (1 + np.exp(-np.clip(x @ model["platt"][:-1] + model["platt"][-1], -30, 30)))


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row; a null, empty or unit-less text gets the score of no evidence."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        for batch in portions(batches):
            p = _probability(batch.column("text").to_pylist(), model)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(p, pa.float64())], names=["id", "score"])

    return only(docs, id_col, text_col).toDF("id", "text").mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def keep_clean(docs: DataFrame, model: dict, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns kept."""
    flag = fresh(docs, "__score")
    schema = T.StructType([*docs.schema.fields, T.StructField(flag, T.DoubleType())])

    def run(batches):
        for batch in portions(batches, text_col):
            p = _probability(batch.column(text_col).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], names=[*batch.schema.names, flag])

    return docs.mapInArrow(released(run, _forget, _triples.cache_clear), schema).where(F.col(flag) < threshold).drop(flag)


def held_out(id_col: str = "doc_id"):
    """True for rows whose crc32 of the id's text is 1 modulo 3 (null ids: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
