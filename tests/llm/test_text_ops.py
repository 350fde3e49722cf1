"""BPE, toxicity, decontamination against the library, brute force and held-out labels."""
import hashlib
import random
from itertools import combinations

import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from llm_fixtures import make  # noqa: F401
from tessera.llm import simhash_decontam as SH
from tessera.llm import toxicity_ssk as TX
from tessera.llm import trie_bpe as TB
from tessera.llm.queries import BPE_VOCABULARY

SF = "/root/testdata/sf0.01"


def documents(sf=SF_SMALL):
    return [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE_VOCABULARY)


def test_bpe_like_the_library(make, library):
    rnd = random.Random(8)
    bits = ["a", "th", "ing", " ", "  ", "\n", "\t", "'s", "1", "23", "é", "ß", "中", "😀", "!", "<|endoftext|>", "\x1c", "\x85", "\xa0", "_"]
    rows = [(i, "".join(rnd.choices(bits, k=rnd.randint(0, 60)))) for i in range(400)]
    rows += [(None, None), (None, "abc"), (3, ""), (3, "repeated id"), (900, "word " * 50_000)] + documents()
    df = make(rows)
    got = sorted(map(tuple, TB.encode(df, BPE_VOCABULARY, with_ids=True).collect()), key=repr)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert back == (t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(back), ids))
    assert got == sorted(want, key=repr)


def test_bpe_round_trip(make):
    rows = [(i, t) for i, t in documents()[:40]] + [(5000, "")]
    enc = TB.encode(make(rows), BPE_VOCABULARY, with_ids=True)
    back = {r["doc_id"]: r["text"] for r in TB.decode(enc, BPE_VOCABULARY).collect()}
    assert back == {i: t or "" for i, t in rows}
    assert TB.encode(make([]), BPE_VOCABULARY).collect() == []


def brute_kernel(s, t):
    s, t = f"\x01{s}\x02", f"\x01{t}\x02"
    total = 0.0
    for a in combinations(range(len(s)), 3):
        for b in combinations(range(len(t)), 3):
            if all(s[i] == t[j] for i, j in zip(a, b)):
                total += TX.DECAY ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


def test_kernel_brute_force():
    words = ["idiot", "id-i.ot", "cat", "aaaa", "worthless", "éàéà"]
    marks = TX.Landmarks(words)
    for s in [*words, "xyz", "id"]:
        got = marks.kernel(TX._codes(s)[None])[0]
        assert np.allclose(got, [brute_kernel(s, w) for w in words], rtol=1e-4)
        assert np.isclose(TX.self_kernel(TX._codes(s)[None])[0], brute_kernel(s, s), rtol=1e-4)


def test_toxicity_held_out(spark):
    rows = E.queries()["op7_subsequence_svm"](spark, SF).collect()
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    assert len(rows) == len(documents(SF)) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    pos = [r["score"] for r in rows if r["held_out"] and labels.get(r["doc_id"]) == 1]
    neg = [r["score"] for r in rows if r["held_out"] and labels.get(r["doc_id"]) == 0]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)
    assert auc > 0.8


def test_toxicity_edges(spark, make):
    words = "good day to walk in the green garden with many old friends".split()
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choices(words, k=30)) + (" vorlox" if i % 4 == 0 else "")) for i in range(80)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(80)] + [(None, 1), (1000, None)], "doc_id long, toxic int")
    model = TX.train(make(rows), labels)
    odd = [(1, "what a vor-lox here"), (2, "v o r l o x now"), (3, "green garden"), (4, None), (5, ""), (None, "!!! ..."), (6, "VORLOX " * 3000), (7, "x" * 5000)]
    got = {r["doc_id"]: r["score"] for r in TX.score(make(odd), model).collect()}
    assert min(got[1], got[2], got[6]) >= 0.7 > max(got[3], got[4], got[5], got[None], got[7])
    kept = TX.keep_clean(make(odd), model, 0.7)
    assert {r["doc_id"] for r in kept.collect()} == {3, 4, 5, None, 7} and kept.columns == make(odd).columns
    none = TX.train(make(rows), labels.where("toxic = 0"))
    assert all(r["score"] < 0.7 for r in TX.score(make(odd), none).collect())
    assert TX.score(make([]), model).collect() == []


def brute_leaks(docs, items):
    """Every item-sized window of every text against every item, by exact weighted similarity."""
    idx = SH.Index(items)
    words, out = SH._Words(), set()
    for i, t in docs:
        w = SH.word_hashes(t, words)
        for item, text in items:
            x = SH.word_hashes(text, words)
            if not len(x):
                continue
            width = min(SH.WIDTH, len(x))
            own, sh, m = np.unique(SH.shingles(x, width)), SH.shingles(w, width), len(x) - width + 1
            if any(idx._similar(sh[a:a + m], own) >= SH.LEAST - 1e-6 for a in range(len(sh) - m + 1)):
                out.add((i, item))
    return out


def test_decontamination_brute_force(spark, make):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choices("abcdefghijkl", k=4))
    items = [(k, " ".join(word() for _ in range(rnd.randint(1, 50)))) for k in range(25)] + [(90, None), (91, ""), (92, "..."), (93, "tiny one")]
    docs = []
    for i in range(80):
        w = [word() for _ in range(rnd.randint(0, 60))]
        x = (rnd.choice(items[:25])[1]).split()
        for _ in range(rnd.randint(0, 4)):
            x[rnd.randrange(len(x))] = word()
        docs.append((i, " ".join(w + [y + rnd.choice(["", "", ",", "###"]) for y in x] + [word(), word()])))
    docs += [(None, items[3][1].upper()), (200, None), (201, ""), (202, "! ?"), (203, "a tiny one. " * 4000), (0, docs[0][1])]
    bench = spark.createDataFrame(items + [(None, "null id item")], "item_id long, text string")
    got = SH.find(make(docs), bench).collect()
    want = brute_leaks(docs, items)
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(want) > 20
    clean = SH.clean(make(docs), bench)
    dirty = {i for i, _ in want}
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(i for i, _ in docs if i not in dirty)
    assert clean.columns == make(docs).columns
    assert SH.find(make(docs), bench.limit(0)).collect() == [] and SH.find(make([]), bench).collect() == []


def brute_short(docs, items):
    """As brute_leaks, with the whole of a text that is shorter than an item as its one window."""
    idx, words, out = SH.Index(items), SH._Words(), set()
    for i, t in docs:
        for item, text in items:
            w, x = SH.word_hashes(t, words), SH.word_hashes(text, words)
            width = min(SH.WIDTH, len(x))
            own, sh, m = np.unique(SH.shingles(x, width)), SH.shingles(w, width), len(x) - width + 1
            if any(idx._similar(sh[a:a + m], own) >= SH.LEAST - 1e-6 for a in range(max(1, len(sh) - m + 1)) if len(sh)):
                out.add((i, item))
    return out


def test_decontamination_truncated_items(spark, make):
    """Items with some words cut off at the start or the end are found, down to the limit."""
    rnd = random.Random(12)
    items = [(k, " ".join("".join(rnd.choices("abcdefghijkl", k=4)) for _ in range(50))) for k in range(12)]
    docs = [(100 * k + 10 * a + b, " ".join(t.split()[a:len(t.split()) - b])) for k, t in items for a in (0, 3) for b in range(10)] + [(5000, "one two"), (5001, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_short(docs, items)
    assert {(r["doc_id"], r["item_id"]) for r in SH.find(make(docs), bench).collect()} == want and (5, 0) in want and 150 < len(want) < len(docs)
    assert SH.clean(make(docs), bench).count() == len(docs) - len(want)


def test_decontamination_portions(spark, make, monkeypatch):
    monkeypatch.setattr(SH, "PORTION_BYTES", 40)
    items = [(k, f"alpha{k} beta{k} gamma{k} delta{k} eps{k} zeta{k}") for k in range(5)]
    docs = [(k, f"so {t} end") for k, t in items]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in SH.find(make(docs), bench).collect()} == {(k, k) for k in range(5)}
    assert SH.clean(make(docs + [(9, "none")]), bench).count() == 1


def test_decontamination_repeated_phrases():
    """Items with repeated shingles are found like in brute force when one word of the phrase is another everywhere."""
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choices("abcdefghijkl", k=5))
    items, docs = [], []
    for k in range(30):
        phrase, rest = [word() for _ in range(rnd.randint(8, 12))], [word() for _ in range(44)]
        items.append((k, " ".join(phrase * 10 + rest)))
        phrase[4] = word()
        docs.append((k, " ".join([word(), word(), *phrase * 10, *rest, *phrase * rnd.randint(0, 3), word()])))
    idx = SH.Index(items)
    found = {(i, k) for i, t in docs for k, *_ in idx.search(t, SH._Words())}
    assert found == brute_short(docs, items) and len(found) > 15


def test_decontamination_portions_weigh_alike(spark, make, monkeypatch):
    """Similarities do not depend on where the borders of portions fall."""
    rnd = random.Random(3)
    stock = " ".join(f"stock{j}" for j in range(14))
    items = [(k, f"{stock} " + " ".join("".join(rnd.choices("abcdef", k=6)) for _ in range(30))) for k in range(12)]
    docs = [(k, " ".join(x if j != 43 - k % 3 else "other" for j, x in enumerate(t.split()))) for k, t in items]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = lambda: {(r["doc_id"], r["item_id"]): round(r["similarity"], 5) for r in SH.find(make(docs), bench).collect()}
    whole = found()
    idx = SH.Index(items)
    assert whole == {(i, k): round(s, 5) for i, t in docs for k, s, *_ in idx.search(t, SH._Words())} and len(whole) == 12
    monkeypatch.setattr(SH, "PORTION_BYTES", 600)
    assert found() == whole


def test_multi_index_finds_all_within_radius():
    rnd = np.random.default_rng(1)
    a = rnd.integers(0, 256, (200, 16), dtype=np.uint8)
    near = np.array([[SH._POP[x ^ y] <= SH.RADIUS // SH.BLOCKS for y in range(256)] for x in range(256)])
    for _ in range(300):
        p = a[0].copy()
        flips = rnd.choice(128, SH.RADIUS, replace=False)
        bits = np.unpackbits(p)
        bits[flips] ^= 1
        q = np.packbits(bits)
        assert any(near[q[b], p[b]] for b in range(SH.BLOCKS))


def test_bpe_decodes_the_ids(library):
    """The decoded bytes come from the ids, not from the text: another table of tokens gives other bytes."""
    voc = TB.Vocabulary(BPE_VOCABULARY)
    text = "of the word<|endoftext|> é"
    joined, ids, back = voc.encode_batch([text])[0]
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids and joined == ",".join(map(str, ids))
    assert back == text.encode()
    voc.token = {i: b"<%d>" % i for i in voc.token}
    assert voc.encode_batch([text])[0][2] == b"".join(b"<%d>" % i for i in ids)
