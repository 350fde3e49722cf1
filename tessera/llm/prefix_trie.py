"""Prefix trie of conversations, packed as double arrays per prefix shard.

Method: a turn (role, text) has a 128-bit id; a prefix has the sum, in four 32-bit lanes, of hashes of its
(position, turn id) pairs, so all prefix keys are running sums.  Conversations are cut into
pieces of at most SEGMENT turns.  Equal pieces are added up first; then pieces are range
partitioned by their start key and turns, so a shard holds neighbouring prefixes.  Each shard packs its
pieces into BASE and CHECK arrays over dense turn codes, adds every piece's figures along its walk and
gives one row per node.  Nodes that several shards share (the paths along shard borders) are merged by key.

Subtree sums need no walk up: every node belongs to its smallest member, whose nodes are the lower
end of its path.  So a node's subtree holds all that its members own, less what its owner owns above it: one more
sum over members by the same shards, and one running sum along owners' paths.

Scale: nothing depends on the number of members of a node or on the length of a conversation: both only
spread over more pieces and ranges.  Two prefixes share a key by chance with probability 2^-128 a pair.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only, stored
from .spread import look_up, running

#: Turns of a piece, turns of a shard's trie, ids of a chunk of a digest.
SEGMENT, SHARD_TURNS, CHUNK = 64, 1 << 16, 4096
LANES = [f"k{i}" for i in range(4)]
ROOT = "00" * 16


class DoubleArray:
    """A trie of sorted code sequences: the child of state s by code c is BASE[s] + c if CHECK[that] = s."""

    def __init__(self, rows: list[list[int]]):
        self.base, self.check, self.free = [0], [0], 1
        todo = [(0, 0, len(rows), 0)]
        while todo:
            state, lo, hi, depth = todo.pop()
            while lo < hi and len(rows[lo]) == depth:
                lo += 1  # sorted: what ends here comes first
            cuts = [lo]
            for i in range(lo + 1, hi):
                if rows[i][depth] != rows[i - 1][depth]:
                    cuts.append(i)
            if lo == hi:
                continue
            codes = [rows[i][depth] for i in cuts]
            base = self.base[state] = self._place(codes)
            for i, j, c in zip(cuts, [*cuts[1:], hi], codes):
                self.check[base + c] = state
                todo.append((base + c, i, j, depth + 1))

    def _place(self, codes: list[int]) -> int:
        """A BASE under which all codes (ascending) meet free slots: the first of 64 free ones, or the arrays' end."""
        at, tried = self.free, 0
        while at < len(self.check) and tried < 64:
            if self.check[at] < 0:
                if all(at + c - codes[0] >= len(self.check) or self.check[at + c - codes[0]] < 0 for c in codes):
                    break
                tried += 1
            at += 1
        else:
            at = len(self.check)
        more = at + codes[-1] - codes[0] + 1 - len(self.check)
        if more > 0:
            self.check.extend([-1] * more)
            self.base.extend([0] * more)
        base = at - codes[0]
        for c in codes:
            self.check[base + c] = -2  # taken; the caller writes the parent
        while self.free < len(self.check) and self.check[self.free] != -1:
            self.free += 1
        return base

    def child(self, state: int, code: int) -> int:
        to = self.base[state] + code
        return to if 0 < to < len(self.check) and self.check[to] == state else -1


def _shard(pieces: list[tuple], n_sums: int) -> dict:
    """The nodes of sorted pieces (start, turns, sizes, keys, depth before, least, sums): column lists."""
    codes: dict[bytes, int] = {}
    dense = [[codes.setdefault(x, len(codes)) for x in (p[0], *p[1])] for p in pieces]
    order = sorted(range(len(pieces)), key=dense.__getitem__)
    trie = DoubleArray([dense[i] for i in order])
    size = len(trie.check)
    least, sums, seen = [None] * size, [[0] * size for _ in range(n_sums)], {}
    for p, row in zip(pieces, dense):
        state, up = trie.child(0, row[0]), p[0]
        for j, code in enumerate(row[1:]):
            state = trie.child(state, code)
            if state not in seen:
                seen[state] = (p[3][j], up, p[4] + j + 1, p[2][j])
                least[state] = p[5]
            elif p[5] < least[state]:
                least[state] = p[5]
            for k, v in enumerate(p[6]):
                sums[k][state] += v
            up = p[3][j]
    out = {name: [] for name in ("key", "up", "depth", "bytes", "least", *[f"s{k}" for k in range(n_sums)])}
    for state, (key, up, depth, n) in seen.items():
        for name, v in zip(out, (key, up, depth, n, least[state], *[s[state] for s in sums])):
            out[name].append(v)
    return out


def _walk(pieces: DataFrame, sums: list[str]) -> DataFrame:
    """(key, up, depth, bytes, least, the sums) per node below the root, from pieces with their figures."""
    alike = pieces.groupBy("start", "end", "n").agg(F.first("items").alias("items"), F.first("depth").alias("depth"), F.min("conv").alias("least"),
                                                    *[F.sum(s).alias(s) for s in sums])
    shards = alike.select("start", F.col("items.turn").alias("turns"), F.col("items.bytes").alias("sizes"), F.col("items.key").alias("keys"), "depth", "least",
                          *sums, F.slice("items.turn", 1, 4).alias("head"), "end")
    shards = shards.repartitionByRange("start", "head", "end").sortWithinPartitions("start", "turns").drop("head", "end")
    types = [pa.binary(), pa.binary(), *[pa.int64()] * (3 + len(sums))]
    names = ["key", "up", "depth", "bytes", "least", *sums]

    def run(batches):
        def rows():
            for batch in batches:
                cols = [batch.column(c).to_pylist() for c in ("start", "turns", "sizes", "keys", "depth", "least")]
                yield from zip(*cols, list(zip(*[batch.column(s).to_pylist() for s in sums])))

        def flush(part):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(_shard(part, len(sums)).values(), types)], names=names)

        part, turns = [], 0
        for p in rows():
            part.append(p)
            turns += len(p[1])
            if turns >= SHARD_TURNS:
                yield flush(part)
                part, turns = [], 0
        if part:
            yield flush(part)

    nodes = shards.mapInArrow(run, "key binary, up binary, depth long, bytes long, least long, " + ", ".join(f"{s} long" for s in sums))
    return nodes.groupBy("key", "up", "depth", "bytes").agg(F.min("least").alias("least"), *[F.sum(s).alias(s) for s in sums])


def _lane(i: int) -> Column:
    """32 bits of the hash of a position and a turn id."""
    return F.conv(F.substring("__h", 8 * i + 1, 8), 16, 10).cast("long")


def _key(lanes: list[Column]) -> Column:
    return F.unhex(F.concat(*[F.lpad(F.hex(F.pmod(x, F.lit(1 << 32))), 8, "0") for x in lanes]))


def turn_ids(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, id, bytes, tie) of every row with a conversation: the 128-bit id of (role, text), nulls as empty."""
    t = only(conversations, conv_col, turn_col, role_col, text_col).toDF("conv", "turn", "role", "text").where("conv is not null")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return t.select(F.col("conv").cast("long").alias("conv"), "turn", F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("id"),
                    F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("tie"))


def rebuilt(turns: DataFrame, share: int = 5, longest: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations on a borrowed prefix: the first h turns of conversation c - c % ``share``, then c's own after its
    first h, where h is crc32 of c's decimal modulo ``longest``.

    Turns ascend by turn (nulls first), then by turn id.  Returns (conv, part, place, id, bytes, tie), in the order of
    part and place, and all conversations (conv), also those left without turns."""
    own = stored(running(turns, ["conv"], ["turn", "id", "tie"], {"place": F.lit(1)}, "own").drop("turn"), "own")
    cut = F.crc32(F.col("conv").cast("string")) % longest
    convs = own.where("place = 1").select("conv")
    lent = own.where(F.col("place") < longest).select(F.col("conv").alias("base"), "place", "id", "bytes", "tie")
    taken = (convs.select("conv", (F.col("conv") - F.col("conv") % share).alias("base"), cut.alias("h")).join(lent, "base")
             .where("place <= h").select("conv", F.lit(0).alias("part"), "place", "id", "bytes", "tie"))
    kept = own.where(F.col("place") > cut).select("conv", F.lit(1).alias("part"), "place", "id", "bytes", "tie")
    return taken.unionByName(kept), convs


def nodes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Per trie node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` are (conv, part, place, id, bytes, tie) in the order of part, place and tie; ``convs`` (conv, distinct) are the members,
    also those without turns, which end at the root.  Without a member there is no node.  Conversations must not be
    null; very long ones are many pieces.
    """
    placed = running(turns, ["conv"], ["part", "place", "tie"], {"pos": F.lit(1)}, "placed").select("conv", "pos", F.col("all_pos").alias("size"), "id", "bytes")
    hashed = placed.withColumn("__h", F.md5(F.concat(F.col("pos").cast("string"), F.lit(":"), F.hex("id"))))
    hashed = hashed.withColumns({f"own{i}": _lane(i) for i in range(4)}).drop("__h")
    steps = running(hashed, ["conv"], ["pos"], {k: F.col(f"own{i}") for i, k in enumerate(LANES)}, "keys")
    steps = stored(steps.select("conv", "pos", "size", F.col("id").alias("turn"), "bytes", _key([F.col(k) for k in LANES]).alias("key"),
                                _key([F.col(k) - F.col(f"own{i}") for i, k in enumerate(LANES)]).alias("up")), "steps")
    item = F.struct("pos", "turn", "bytes", "key", "up")
    pieces = steps.groupBy("conv", F.expr(f"(pos - 1) div {SEGMENT}").alias("segment")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    pieces = stored(pieces.select("conv", "items", F.size("items").alias("n"), F.col("items")[0]["up"].alias("start"), F.element_at("items", -1)["key"].alias("end"),
                                  (F.col("items")[0]["pos"] - 1).alias("depth")), "pieces")

    inner = _walk(pieces.withColumn("n_convs", F.lit(1)), ["n_convs"])
    root = convs.agg(F.min("conv").alias("least"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        F.unhex(F.lit(ROOT)).alias("key"), F.lit(None).cast("binary").alias("up"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"), "least", "n_convs")
    found = stored(inner.unionByName(root), "nodes")
    children = found.where("up is not null").groupBy(F.col("up").alias("key")).agg(F.count("*").alias("n_children"))
    found = stored(found.join(children, "key", "left").select("*", F.coalesce("n_children", F.lit(0)).alias("n")).drop("n_children").withColumnRenamed("n", "n_children")
                   .withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes")), "family")

    # what each conversation owns, summed over the members of every node
    owned = found.groupBy(F.col("least").alias("conv")).agg(F.sum("saved").alias("saved"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
    inside = _walk(pieces.join(owned, "conv", "left").fillna(0, ["saved", "leaves"]), ["saved", "leaves"]).select("key", F.col("saved").alias("all_owned"), F.col("leaves").alias("n_leaves"))
    total = owned.agg(F.sum("saved").alias("all_owned"), F.sum("leaves").alias("n_leaves")).select(F.unhex(F.lit(ROOT)).alias("key"), "all_owned", "n_leaves")
    above = running(found, ["least"], ["depth"], {"so_far": F.col("saved")}, "owned").drop("all_so_far")
    out = above.join(inside.unionByName(total), "key").withColumn("saved_tokens", F.col("all_owned") - F.col("so_far") + F.col("saved"))

    out = stored(out.join(ends_digest(steps, convs), "key", "left"), "figures")
    parents = found.where("n_children > 0").select(F.col("key").alias("up"), F.col("least").alias("parent_conv_id"), F.col("n_children").alias("n"))
    below = out.where("up is not null")
    out = look_up(below, parents, ["up"], "n", below.count()).drop("n").unionByName(out.where("up is null").withColumn("parent_conv_id", F.lit(None).cast("long")))
    return out.select(F.col("least").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def ends_digest(steps: DataFrame, convs: DataFrame) -> DataFrame:
    """(key, ends_sha256): the hash of the ascending, comma-joined conversations that end at a node.

    Ids are joined in chunks; a node's chunks then stream in order through one hash, which never
    holds more than a chunk."""
    last = steps.where("pos = size").select("key", "conv")
    empty = convs.join(last, "conv", "left_anti").select(F.unhex(F.lit(ROOT)).alias("key"), "conv")
    ranked = running(last.unionByName(empty), ["key"], ["conv"], {"rank": F.lit(1)}, "ends")
    chunks = ranked.groupBy("key", F.expr(f"(rank - 1) div {CHUNK}").alias("chunk")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches):
        key, hashed = None, None
        for batch in batches:
            keys, shas = [], []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if k != key:
                    if key is not None:
                        keys.append(key)
                        shas.append(hashed.hexdigest())
                    key, hashed = k, hashlib.sha256()
                else:
                    hashed.update(b",")
                hashed.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(shas, pa.string())], names=["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([hashed.hexdigest()], pa.string())], names=["key", "ends_sha256"])

    return chunks.repartition("key").sortWithinPartitions("key", "chunk").select("key", "ids").mapInArrow(run, "key binary, ends_sha256 string")


def trie(conversations: DataFrame, share: int = 5, longest: int = 9, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
         text_col: str = "text") -> DataFrame:
    """The nodes of all conversations rebuilt on borrowed prefixes.

    Null roles and texts are empty; null turns come first, equal turns by turn id, repeated rows are repeated turns;
    rows without a conversation are left out; extra columns are not read; an empty table has no node."""
    turns = stored(turn_ids(conversations, conv_col, turn_col, role_col, text_col), "turns")
    steps, convs = rebuilt(turns, share, longest)
    return nodes(stored(steps, "rebuilt"), stored(convs, "convs"))
