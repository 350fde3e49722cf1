"""Exact dedup, Merkle witnesses and prefix tries against brute force."""
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from llm_fixtures import make  # noqa: F401
from tessera.llm import exact_dedup as ED
from tessera.llm import merkle as MK
from tessera.llm import prefix_trie as PT
from tessera.llm.spread import look_up, running


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# --- helpers ------------------------------------------------------------------
def test_running_sums_over_a_hot_group(spark):
    rows = [("hot" if i % 3 else f"g{i % 7}", i * 37 % 1000, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, o long, v long")
    got = running(df, ["g"], ["o", "v"], {"s": F.col("v"), "n": F.lit(1)}, "t").collect()
    want = {}
    for g in {r[0] for r in rows}:
        s = 0
        own = sorted((o, v) for x, o, v in rows if x == g)
        for k, (o, v) in enumerate(own):
            s += v
            want[v] = (g, o, s, k + 1, sum(x for _, x in own), len(own))
    assert {r["v"]: (r["g"], r["o"], r["s"], r["n"], r["all_s"], r["all_n"]) for r in got} == want


def test_look_up_splits_hot_classes(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    classes = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    got = look_up(rows, classes, ["k"], "n", 3000)
    assert got.count() == 3000 and got.where("low <> k").count() == 0


# --- exact dedup -----------------------------------------------------------------
def brute_classes(rows):
    norm = [re.sub("[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), t in zip(rows, norm):
        ids = [j for (j, _), u in zip(rows, norm) if u == t]
        keep = min((j for j in ids if j is not None), default=None)
        out.append((i, keep, len(ids), i == keep, sha(t)))
    return sorted(out, key=repr)


def dedup_rows():
    rnd = random.Random(5)
    texts = ["a b", "a  b", "a\tb", "a\n\r\x0bb", " a b", "a b ", "A b", "a b", "中 文", "ab", "b a", None, "", " ", "\n\n", "x" * 300_000, "x" * 299_999 + "y"]
    rows = [(i, rnd.choice(texts)) for i in range(200)] + [(i, "hot  copy") for i in range(1000, 1400)]
    return rows + [(5, "a b"), (5, "a b"), (None, "a b"), (None, "only null"), (None, "only null"), (-7, "hot copy"), (7, "other"), (7, "hot copy")]


@pytest.mark.parametrize("bits", [None, 1])
def test_exact_classes(make, bits):
    """With one or three hash values for all texts, only the bytes tell classes apart."""
    rows = dedup_rows()
    hashed = ED.content_hash if bits is None else (lambda t: F.unhex(F.lpad((F.length(t) % 3).cast("string"), 2, "0")))
    assert sorted(map(tuple, ED.classes(make(rows), hashed=hashed).collect()), key=repr) == brute_classes(rows)


def test_exact_empty_and_deduplicated(make):
    assert ED.classes(make([])).count() == 0 and ED.deduplicated(make([])).count() == 0
    out = ED.deduplicated(make([(2, "a b"), (1, "a\nb"), (3, "c"), (None, "a b")]))
    assert out.columns == make([]).columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out.collect()) == [(0, "a b"), (1, "a\nb"), (3, "c")]


# --- Merkle -----------------------------------------------------------------
def brute_tree(leaves):
    """Root and, per leaf, the (left, right) pairs of its levels."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        runs = [level[i:i + 3] for i in range(0, len(level), 3)]
        for k, p in enumerate(at):
            run = runs[p // 3]
            paths[k].append(("".join(run[:p % 3]), "".join(run[p % 3 + 1:])))
        at = [p // 3 for p in at]
        level = [sha("".join(r)) for r in runs]
    return level[0], paths


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_manifest(rows):
    groups = {}
    for i, source, leaf in rows:
        groups.setdefault(source, []).append((i is not None, i, leaf))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_tree([x[2] for x in sorted(groups[s])]) for s in order}
    root, tops = brute_tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for (has, i, leaf), path in zip(sorted(groups[s]), trees[s][1]):
            whole = path + top
            out.append((i, s, leaf, trees[s][0], root, [a for a, _ in whole], [b for _, b in whole]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 8, 9, 10, 27, 28, 728, 729, 730])
def test_open_tree(n):
    leaves = [sha(str(i)) for i in range(n)]
    tree = MK.OpenTree()
    for x in leaves:
        tree.append(x)
    root, paths = brute_tree(leaves)
    assert tree.close() == root
    assert [list(zip(*tree.witness(i))) if paths[i] else [] for i in range(n)] == paths


def test_manifest_brute_force(make):
    rnd = random.Random(2)
    rows = [(i, f"text {i}\nmore", "en", "hot") for i in rnd.sample(range(9000), 2300)]  # four blocks of one source
    rows += [(i, f"x{i}", "de", f"s{i % 5}") for i in range(40)] + [(1, "a", None, "ä"), (2, None, None, None), (2, None, None, None), (3, "", "", ""), (None, "b", "fr", "s1"), (4, "z" * 400_000, "en", "one")]
    docs = make(rows)
    want = [(i, s, sha("".join(map(enc, (i, s, lang, len(t or ""), t))))) for i, t, lang, s in rows]
    got = MK.signed(docs, ["doc_id", "source", "lang", "n_chars", "text"])
    assert got.columns == ["doc_id", "source", "leaf", "subroot", "root", "left", "right"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_manifest(want)
    seen = got.withColumn("ok", MK.folded("leaf") == F.col("root")).withColumn("bad", MK.folded(F.lit("0" * 64)) == F.col("root"))
    assert seen.where("not ok or bad").count() == 0


def test_manifest_edges(make):
    assert MK.signed(make([]), ["doc_id", "text"]).count() == 0
    one = MK.signed(make([(1, "a")]), ["doc_id", "text"]).first()
    assert one["leaf"] == one["subroot"] == one["root"] == sha("1:11:a") and one["left"] == one["right"] == []


def test_manifest_keeps_clashing_columns(spark):
    leaves = spark.createDataFrame([(1, "a", sha("1"), 5, 6, "q"), (2, "a", sha("2"), 5, 6, "q")], "doc_id long, source string, leaf string, pos int, tree int, node string")
    out = MK.manifest(leaves)
    assert out.columns[:6] == leaves.columns and {(r["pos"], r["tree"], r["node"]) for r in out.collect()} == {(5, 6, "q")}


# --- prefix trie -----------------------------------------------------------------
@pytest.mark.parametrize("seed", range(6))
def test_double_array(seed):
    rnd = random.Random(seed)
    rows = sorted([rnd.randrange(rnd.choice([2, 50])) for _ in range(rnd.randrange(9))] for _ in range(120))
    trie = PT.DoubleArray(rows)
    held = {tuple(r[:d]) for r in rows for d in range(len(r) + 1)}
    found, todo = {()}, [((), 0)]
    while todo:
        path, state = todo.pop()
        for c in range(51):
            to = trie.child(state, c)
            if to > 0:
                found.add((*path, c))
                todo.append(((*path, c), to))
    assert found == held


def brute_trie(rows, share=5, longest=9):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own.setdefault(conv, []).append((turn is not None, turn, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest(), (role, text)))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % longest
        base = c - (c % share if c >= 0 else -(-c % share))
        built[c] = tuple(own.get(base, [])[:h] + v[h:])
    members, kids = {}, {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
            if d:
                kids.setdefault(seq[:d - 1], set()).add(seq[:d])
    sums = {}
    for p in sorted(members, key=len, reverse=True):
        saved = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        down = [sums[k] for k in kids.get(p, ())]
        sums[p] = (saved + sum(x for x, _ in down), sum(x for _, x in down) or 1)
    return sorted([(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, ())), sums[p][1], sums[p][0],
                    sha(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)))) for p, m in members.items()], key=repr)


def conv_rows():
    rnd = random.Random(9)
    rows = []
    for c in range(-6, 120):
        n = rnd.randrange(0, 12)
        rows += [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["hi", "yes", "", None, "wörld", "a longer text"])) for t in range(n)]
    long = [(t, "user", f"turn {t // 2}") for t in range(150)]  # several segments
    for c in (1000, 1001, 1005, 1010, 1013):
        rows += [(c, *x) for x in long[:150 - c % 7]]
    rows += [(c, t, "user", f"same {t}") for c in range(2000, 2300) for t in range(3)]  # copies
    rows += [(50, None, "user", "no turn"), (50, None, "user", "no turn"), (51, 0, "b", "tie"), (51, 0, "a", "tie"), (None, 1, "user", "no conversation")]
    return rows


CONVS = "conv_id long, turn int, role string, text string, conv long, id string, `key` int, n int, part int"


def test_trie_brute_force(spark, monkeypatch):
    rows = conv_rows()
    monkeypatch.setattr(PT, "CHUNK", 16)
    got = PT.trie(spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], CONVS)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_trie(rows)


def test_trie_edges(spark):
    assert PT.trie(spark.createDataFrame([], CONVS)).count() == 0
    alone = PT.trie(spark.createDataFrame([(3, 0, None, None, 1, "x", 2, 3, 4)], CONVS)).collect()
    assert sorted(map(tuple, alone), key=repr) == brute_trie([(3, 0, None, None)])
    text = "very long " * 200_000
    rows = [(5, 0, "user", text), (10, 0, "user", text)]
    assert sorted(map(tuple, PT.trie(spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], CONVS)).collect()), key=repr) == brute_trie(rows)


def test_many_shards_agree(spark, monkeypatch):
    """Nodes that shards share are merged: one trie or many give the same rows."""
    rows = [(5 * c, t, "user", f"{t}-{c % (t + 2)}") for c in range(400) for t in range(6)]
    df = spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], CONVS)
    assert sorted(map(tuple, PT.trie(df.repartition(1)).collect()), key=repr) == brute_trie(rows)
