"""Byte-level BPE encoding and decoding over a trie of distinct words.

Method: BPE is determined by the last token of every prefix.  For a prefix p, the last
token is the one suffix t of p in the vocabulary that can follow the last token of the
rest of p without a merge across their border.  So the distinct words of a batch are put
into a trie (kept as their sorted list, whose scan is the trie's depth-first walk; a stack
holds the last-token state of every node on the current path), and a prefix shared by many
words is worked out once.  A word's tokens are then read backwards from its end.

Words are what the vocabulary file's byte-level pre-tokenizer splits; special tokens are
cut out first.  A Python worker keeps the words it has met lately (two bounded generations), so
repeated words cost one dictionary look-up.  There is no shuffle.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, portions, released

#: Words of a generation: a full one becomes the older one, which is then forgotten; words met again move on.
WORD_CACHE = 400_000
#: Pairs of tokens whose border a worker remembers.
BORDER_CACHE = 500_000
#: Bytes of a prefix's end by which its tokens are looked up, and ends that a worker remembers.
TAIL, END_CACHE = 4, 300_000
#: The words, ends and borders kept where a worker also serves other stages.
STAGE_CACHES = 60_000, 90_000, 80_000
#: Fixed value: the split pattern of byte-level pre-tokenizers with use_regex.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def _byte_chars() -> dict[str, int]:
    """The printable stand-ins that vocabulary files use for the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Vocabulary:
    """Tokens, merges and the two tests that the trie walk needs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = _byte_chars()
        raw = lambda s: bytes(chars[c] for c in s)
        self.id_of = {raw(s): i for s, i in spec["model"]["vocab"].items()}
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special_bytes = {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
        self.rank: dict[tuple[int, int], int] = {}
        self.made_by: dict[int, tuple[int, int, int]] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            a, b = raw(a), raw(b)
            pair, made = (self.id_of[a], self.id_of[b]), self.id_of[a + b]
            self.rank[pair] = r
            if made not in self.made_by:
                self.made_by[made] = (*pair, r)
        self.follows: dict[int, bool] = {}
        # a vocabulary entry that its own merges would not rebuild is never a last token
        self.usable = {b: i for b, i in self.id_of.items() if self._rebuilt(i)}
        self.token = {**self.special_bytes, **self.bytes_of}  # what every id decodes to
        self.words: dict[str, str] = {}  # comma-joined ids
        self.older: dict[str, str] = {}
        self.most = WORD_CACHE, END_CACHE, BORDER_CACHE
        self.ends = self._by_end()
        self.split = regex.compile(SPLIT)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def _by_end(self) -> dict[bytes, tuple[tuple[int, int], ...]]:
        """For the last TAIL bytes of a prefix: the lengths of the usable tokens that may end it, longest first, with the
        token itself where those bytes name it (else -1)."""
        held: dict[bytes, set[int]] = {}
        for b in self.usable:
            if len(b) >= TAIL:
                held.setdefault(b[-TAIL:], set()).add(len(b))
        return {end: (*((k, -1) for k in sorted(sizes, reverse=True) if k > TAIL), *self._short(end)) for end, sizes in held.items()}

    def _short(self, end: bytes) -> tuple[tuple[int, int], ...]:
        """The usable tokens among the ends of a few bytes."""
        return tuple((k, self.usable[end[-k:]]) for k in range(len(end), 0, -1) if end[-k:] in self.usable)

    def _rebuilt(self, token: int) -> bool:
        if token not in self.made_by:
            return len(self.bytes_of[token]) == 1
        a, b, r = self.made_by[token]
        return self._border(a, b, r)

    def _border(self, a: int, b: int, before: int) -> bool:
        """True if no merge of rank below ``before`` crosses the border of a and b.

        Undo the merges of the two sides, latest first: each undone merge names a moment at
        which both inner neighbours stood; a cross merge ranked before that moment (at an
        equal rank the left position goes first) would have taken place."""
        left_at = right_at = before
        while True:
            r = self.rank.get((a, b))
            # a stood from its making until left_at, b until right_at
            if r is not None and r < min(left_at, right_at + 1) and r < before:
                return False
            am, bm = self.made_by.get(a), self.made_by.get(b)
            if am is None and bm is None:
                return True
            if bm is None or am is not None and am[2] > bm[2]:
                left_at, right_at, a = am[2], min(right_at, am[2]), am[1]
            else:
                right_at, left_at, b = bm[2], min(left_at, bm[2] + 1), bm[0]

    def can_follow(self, a: int, b: int) -> bool:
        key = a << 32 | b
        ok = self.follows.get(key)
        if ok is None:
            if len(self.follows) > self.most[2]:
                self.follows.clear()
            ok = self.follows[key] = self._border(a, b, 1 << 60)
        return ok

    def learn(self, words: list[str]) -> None:
        """Encode distinct words by one depth-first walk of their trie.

        Words in code point order are in byte order too, so neighbours share their longest prefixes; the states of the
        current path hold, per byte, the last token and the ids of the prefix that ends there."""
        usable, follows, can, keep, ends, short = self.usable, self.follows, self.can_follow, self.words, self.ends, self._short
        if len(ends) > self.most[1]:
            ends = self.ends = self._by_end()
        last: list[int] = [-1]
        ids: list[str] = [""]
        words = sorted(words)
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        for word, path, shared in zip(words, data, _shared(data)):
            del last[shared + 1:], ids[shared + 1:]
            for i in range(shared + 1, len(path) + 1):
                tail = path[i - TAIL:i] if i > TAIL else path[:i]
                sizes = ends.get(tail)
                if sizes is None:
                    sizes = ends[tail] = short(tail)
                for size, t in sizes:
                    if t < 0:
                        if size > i:
                            continue
                        t = usable.get(path[i - size:i])
                        if t is None:
                            continue
                    if size == i:
                        ids.append(str(t))
                        break
                    before = last[i - size]
                    ok = follows.get(before << 32 | t)
                    if can(before, t) if ok is None else ok:
                        ids.append(f"{ids[i - size]},{t}")
                        break
                else:
                    raise ValueError(f"no token ends {path[:i]!r}")
                last.append(t)
            keep[word] = ids[-1]

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    def pieces(self, text: str) -> list[str]:
        """Words of a text in order; special tokens stand as themselves."""
        if self.cut is None or not self.cut.search(text):
            return self.split.findall(text)
        out: list[str] = []
        for part in self.cut.split(text):
            out.extend([part] if part in self.special else self.split.findall(part))
        return out

    def encode_batch(self, texts: list[str]) -> list[tuple[str, np.ndarray, bytes]]:
        """(comma-joined ids, ids, the bytes that these ids decode to) of each text."""
        split = [self.pieces(t) for t in texts]
        if len(self.words) > self.most[0]:
            self.words, self.older = {}, self.words
        keep, older = self.words, self.older
        for s, i in self.special.items():
            keep[s] = str(i)
        missing = []
        for w in set().union(*split) if split else ():
            if w in keep:
                continue
            held = older.get(w)
            if held is None:
                missing.append(w)
            else:
                keep[w] = held
        if missing:
            self.learn(missing)
        out = []
        for p in split:
            joined = ",".join(map(keep.__getitem__, p))
            ids = np.fromstring(joined, np.int32, sep=",") if joined else np.zeros(0, np.int32)
            out.append((joined, ids, self.decode_bytes(ids.tolist())))
        return out


def _shared(data: list[bytes]) -> list[int]:
    """Bytes that each of the sorted words shares with the one before it."""
    if len(data) < 2:
        return [0] * len(data)
    width = 32
    head = np.array([d[:width] + b"\1" * (d[:width].endswith(b"\0")) for d in data], f"S{width + 1}")
    same = head.view(np.uint8).reshape(len(data), width + 1)
    same = same[1:] == same[:-1]
    first = np.where(same.all(axis=1), width + 1, same.argmin(axis=1))
    out = [0, *first.tolist()]
    for i, (a, b) in enumerate(zip(data, data[1:]), 1):
        n = min(len(a), len(b))
        if out[i] >= width and n > width:  # beyond the table
            out[i] = next((j for j in range(width, n) if a[j] != b[j]), n)
        elif out[i] > n:
            out[i] = n
    return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _encode(path: str, ids: bool):
    def run(batches):
        voc = vocabulary(path)
        voc.most = STAGE_CACHES if ids else (WORD_CACHE, END_CACHE, BORDER_CACHE)
        for batch in portions(batches, "__t"):
            n, sha, back, seq = [], [], [], []
            for joined, numbers, data in voc.encode_batch([t or "" for t in batch.column("__t").to_pylist()]):
                n.append(len(numbers))
                sha.append(hashlib.sha256(joined.encode()).hexdigest())
                back.append(hashlib.sha256(data.decode("utf-8", "replace").encode()).hexdigest())
                if ids:
                    seq.append(numbers)
            cols = [c for c in batch.schema.names if c != "__t"]
            data = [batch.column(c) for c in cols] + [pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())]
            names = [*cols, "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                data.append(pa.array(seq, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(data, names=names)

    # with ids the worker also serves other stages: leave the memory, the vocabulary's too, to what comes next
    return released(run, vocabulary.cache_clear) if ids else run


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False) -> DataFrame:
    """Per row: the id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, ``with_ids``, ``ids``.

    Null texts count as empty: no tokens, hashes of the empty string.  Rows with a null
    or repeated id stay, one result each.  Extra columns are not read.  ``vocab_path`` must be readable
    on every executor.
    """
    kind = dict(docs.dtypes)[id_col]
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    out = only(docs, id_col, text_col).toDF("id", "__t").mapInArrow(_encode(vocab_path, with_ids), schema)
    return out.withColumnRenamed("id", id_col)


def _decode(path: str):
    def run(batches):
        voc = vocabulary(path)
        for batch in batches:
            texts = [None if x is None else voc.decode_bytes(x).decode("utf-8", "replace")
                     for x in batch.column("ids").to_pylist()]
            cols = [c for c in batch.schema.names if c != "ids"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in cols], pa.array(texts, pa.string())], names=[*cols, "text"])
    return run


def decode(rows: DataFrame, vocab_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The texts of id sequences (null sequence: null text)."""
    kind = dict(rows.dtypes)[id_col]
    out = only(rows, id_col, ids_col).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").cast("array<int>").alias("ids"))
    return out.mapInArrow(_decode(vocab_path), f"id {kind}, text string").withColumnRenamed("id", id_col)
