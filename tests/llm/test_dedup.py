"""Suffix removal and near-duplicates against brute force."""
import hashlib
import random

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from llm_fixtures import make  # noqa: F401
from tessera.llm import odd_minhash as OM
from tessera.llm import suffix_dedup as SD
from tessera.llm.components import components

BIG = 1 << 62


def brute_removed(rows, length=50):
    holds = {}
    data = [(BIG if i is None else i, (t or "").encode()) for i, t in rows]
    for k, b in data:
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            holds[w] = min(holds.get(w, k), k)
    out = []
    for (i, _), (k, b) in zip(rows, data):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if holds[b[p:p + length]] < k:
                gone[p:p + length] = b"\1" * length
        rest = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr)


def suffix_rows():
    rnd = random.Random(3)
    words = ["eins", "zwei", "ähre", "t", "中文", "lorem", "ipsum"]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    shared = [text(30) for _ in range(4)]
    rows = [(i, text(rnd.randint(0, 25)) + rnd.choice(shared) + text(rnd.randint(0, 25))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "short"), (103, "a" * 400), (104, "a" * 49), (105, "a" * 50), (50, rows[2][1]), (7, rows[7][1]),
             (None, rows[3][1]), (None, rows[3][1]), (200, "x" + rows[5][1][3:]), (201, "ab" * 300000), (202, "ab" * 70), (-5, "b" + "ab" * 60)]
    return rows


def test_suffix_brute_force(make):
    rows = suffix_rows()
    rows[-3] = (201, "ab" * 2000)
    got = SD.remove_repeats(make(rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_removed(rows)


def test_suffix_very_long_text_and_rest(make):
    long = "".join(random.Random(1).choices("abcdefg ", k=600_000))
    got = {r["id"]: r for r in SD.remove_repeats(make([(1, long[1000:1300]), (2, long)]), with_rest=True).collect()}
    assert got[2]["n_removed"] == 300 and got[2]["n_spans"] == 1
    assert bytes(got[2]["rest"]).decode() == long[:1000] + long[1300:]


def test_suffix_empty_table(make):
    assert SD.remove_repeats(make([])).collect() == []


def test_loser_tree_merges_and_keeps_prefixes():
    rnd = random.Random(5)
    runs = [sorted({bytes(rnd.choices(b"ab", k=rnd.randint(1, 9))) for _ in range(rnd.randint(0, 20))}) for _ in range(7)]
    coded = [SD.read_run(SD.front_code(r, list(range(len(r))))) for r in runs]
    assert [c[0] for c in coded] == runs
    out = [(runs[r][i], h) for r, i, h in SD.LoserTree(runs, [c[1] for c in coded])]
    assert [s for s, _ in out] == sorted(s for r in runs for s in r)
    assert all(h == SD.common_prefix(a, b, 0) for (a, _), (b, h) in zip(out, out[1:]))


def shingle_set(t, width):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[j:j + width]) for j in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute_components(rows, width):
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, (i, s) in enumerate(sets):
        for b in range(a):
            j, u = sets[b]
            same = i is not None and i == j and s and u
            if i is not None and j is not None and s and u and (same or 100 * len(s & u) >= 80 * len(s | u)):
                parent[root(a)] = root(b)
    low = {}
    for a, (i, _) in enumerate(sets):
        if i is not None:
            low[root(a)] = min(low.get(root(a), i), i)
    return sorted(((i, len(s), None if i is None else low[root(a)], i is None or low[root(a)] == i) for a, (i, s) in enumerate(sets)), key=repr)


def near_rows():
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choices("abcdefghij", k=5))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "Two words"), (5, "two WORDS"), (6, "x"), (None, "two words"), (None, None)]
    i = 10
    for _ in range(12):
        base = [word() for _ in range(rnd.randint(30, 120))]
        for _ in range(rnd.randint(1, 9)):
            w = list(base)
            for _ in range(rnd.randint(0, 6)):
                w[rnd.randrange(len(w))] = word()
            rows.append((i, " ".join(w)))
            i += 1
    return rows + [rows[-1], (i, rows[12][1].upper())]


@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_brute_force(make, width):
    rows = near_rows()
    got = OM.near_duplicates(make(rows), width=width).collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(rows, width)


def test_near_duplicates_chain_of_variants_in_parts(make, monkeypatch):
    """Texts of one family that a star does not join; groups dealt into parts."""
    monkeypatch.setattr(OM, "CHUNK", 4)
    rnd = random.Random(2)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(30):
        base = list(base)
        for k in rnd.sample(range(200), 3):
            base[k] = f"v{i}-{k}"
        rows.append((i, " ".join(base)))
    got = OM.near_duplicates(make(rows), width=4).collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(rows, 4)


def test_near_duplicates_small_tables(spark, make):
    assert OM.near_duplicates(make([])).collect() == []
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()]
    got = E.queries()["op8_odd_minhash"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(rows, 4)


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1100)]
    parent = {x: x for e in edges for x in e}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    want = {(x, root(x)) for a, b in edges if a != b for x in (a, b)}
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
