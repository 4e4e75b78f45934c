"""Operator 12, conversation prefix trie by a splitter skeleton.

Every distinct sequence of first turns is a node. A conversation is a path of turn tokens (20 bytes
a turn: a digest of role and text, and the length of the text), so texts are read once and never
shuffled.

1. A bounded sample of the paths gives the splitters of a range partitioning by (path, id); each
   shard holds one range. The members of a node are neighbours in that order, also if they are a
   large group of equal conversations, which the id cuts into several shards.
2. The trie of the splitters' paths is the skeleton, and it is broadcast. Only its nodes can have
   members in more than one shard.
3. Each shard is read in order with a stack of the open nodes of the current path. A node outside
   the skeleton is finished there and then. For a skeleton node the shard gives a partial
   aggregate: members, smallest id, and the children, leaves and savings below it that are not in
   the skeleton.
4. The partial aggregates are summed per skeleton node, then passed to the node's ancestors in the
   skeleton and summed again.

The ids of the conversations that end in a skeleton node leave the shards as joined pieces of 64 KB
and are hashed piece after piece in order: such a digest is sequential by its definition, but no
group is held. A task holds the open path, one piece and the skeleton.

Edge cases: rows without a conversation id belong to none and are left out; a null turn comes first,
equal turns are ordered by their token; null roles and texts are empty; repeated rows are repeated
turns; a conversation without turns is a member of the root only; an empty table has no node, not
even the root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import map_arrow, stash

#: Bytes of a turn's token.
TOKEN = 20
#: Sampled paths at most (about), and turns of a splitter's path at most; together they bound the
#: skeleton. Conversations that agree in more turns than that stay in one shard.
SAMPLE = 32_768
SPLITTER_TURNS = 256
#: Bytes of joined ids in a piece.
PIECE = 1 << 16


def paths(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """(conv_id, path array<string>) of every conversation: its turns' tokens as hex digits, in order."""
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    token = F.concat(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)),
                     F.lower(F.lpad(F.hex(F.length(text)), 8, "0")))
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"), F.struct(F.col(turn_col).isNotNull().alias("known"), F.col(turn_col).alias("turn"),
                                                   token.alias("token")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).getField("token").alias("path"))


class Skeleton:
    """Trie of the splitters' paths: ``child`` by (node, token), ``parent`` by node; node 0 is the root."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent: list[int] = [-1]
        for path, _ in splitters:
            at = 0
            for i in range(0, len(path), TOKEN):
                key = (at, path[i:i + TOKEN])
                if key not in self.child:
                    self.child[key] = len(self.parent)
                    self.parent.append(at)
                at = self.child[key]
        self.children = [0] * len(self.parent)
        for p in self.parent[1:]:
            self.children[p] += 1


def splitters(rows: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """At most ``shards`` - 1 (path, id), evenly spaced in a sample that is a function of the ids."""
    n = rows.count()
    parts = 1 << 20
    share = parts if n <= SAMPLE else max(1, parts * SAMPLE // n)
    sample = rows.where(F.pmod(F.xxhash64("conv_id"), F.lit(parts)) < share).select(
        F.substring("path", 1, SPLITTER_TURNS * TOKEN).alias("path"), "conv_id")
    got = sorted((bytes(r["path"]), r["conv_id"]) for r in sample.collect())
    return sorted({got[len(got) * i // shards] for i in range(1, shards)}) if got else []


_ROW = ("kind int, shard int, seq long, pshard int, pseq long, depth long, conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved long, length long, ends binary")
_NODE, _PARTIAL, _ENDS = 0, 1, 2


class _Open:
    """An open node of the current path."""

    __slots__ = ("sid", "seq", "length", "conv", "convs", "children", "leaves", "saved", "ids", "size", "sha")

    def __init__(self, sid: int, seq: int, length: int):
        self.sid, self.seq, self.length = sid, seq, length
        self.conv, self.convs, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ids, self.size, self.sha = [], 0, None


class _Shard:
    """Rows of one shard in order, to the rows of ``_ROW``."""

    def __init__(self, shard: int, skeleton: Skeleton, out: list[tuple], piece: int):
        self.shard, self.skeleton, self.out, self.piece = shard, skeleton, out, piece
        self.path, self.seq = b"", 0
        self.open = [_Open(0, 0, 0)]

    def add(self, path: bytes, conv: int) -> None:
        old, same = self.path, 0
        if path != old:
            most = min(len(path), len(old))
            while same < most and path[same:same + TOKEN] == old[same:same + TOKEN]:
                same += TOKEN
            while len(self.open) > same // TOKEN + 1:
                self.close()
            for i in range(same, len(path), TOKEN):
                token = path[i:i + TOKEN]
                above = self.open[-1].sid
                self.seq += 1
                self.open.append(_Open(self.skeleton.child.get((above, token), -1) if above >= 0 else -1, self.seq,
                                       int.from_bytes(token[16:], "big")))
            self.path = path
        node = self.open[-1]
        node.convs += 1
        node.conv = conv if node.conv is None or conv < node.conv else node.conv
        name = b"%d" % conv
        node.ids.append(name)
        node.size += len(name) + 1
        if node.size >= self.piece:
            self.flush(node)

    def flush(self, node: _Open) -> None:
        """The ids held go into the node's digest or, for a skeleton node, out as a piece."""
        if not node.ids:
            return
        piece = b",".join(node.ids)
        if node.sid >= 0:
            first = int(node.ids[0])
            self.out.append((_ENDS, -1, node.sid, None, None, None, first, None, None, None, None, None, piece))
        elif node.sha is None:
            node.sha = hashlib.sha256(piece)
        else:
            node.sha.update(b"," + piece)
        node.ids, node.size = [], 0

    def close(self) -> None:
        node = self.open.pop()
        above = self.open[-1] if self.open else None
        depth = len(self.open)
        self.flush(node)
        if above is not None and node.convs:
            above.convs += node.convs
            above.conv = node.conv if above.conv is None else min(above.conv, node.conv)
        if node.sid >= 0:
            if node.convs:
                self.out.append((_PARTIAL, -1, node.sid, -1, above.sid if above else None, depth, node.conv, node.convs, node.children,
                                 node.leaves, node.saved, node.length, None))
            return
        node.saved += (node.convs - 1) * node.length
        node.leaves = node.leaves if node.children else 1
        above.children += 1
        above.leaves += node.leaves
        above.saved += node.saved
        place = (-1, above.sid) if above.sid >= 0 else (self.shard, above.seq)
        self.out.append((_NODE, self.shard, node.seq, *place, depth, node.conv, node.convs, node.children, node.leaves, node.saved,
                         node.length, (node.sha or hashlib.sha256()).digest()))

    def end(self) -> None:
        while self.open:
            self.close()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in _ROW.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields, strict=True)],
                                      [name for name, _ in fields])


def _sharded(rows: DataFrame, shared, shards: int) -> DataFrame:
    """(shard, path, conv_id), one shard a partition, in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = shared.value.splitters
        for b in batches:
            keys = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
            shard = pa.array([bisect_right(cuts, k) for k in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([shard, b.column(0), b.column(1)], ["shard", "path", "conv_id"])

    dealt = map_arrow(rows.select("path", "conv_id"), run, "shard int, path binary, conv_id long")
    return dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")


def _scan(sharded: DataFrame, shared, piece: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now = None
        for b in batches:
            for shard, path, conv in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now is None or now.shard != shard:
                    if now is not None:
                        now.end()
                    now = _Shard(shard, shared.value, out, piece)
                now.add(path, conv)
                if len(out) >= 5000:
                    yield _batch(out)
                    out.clear()
        if now is not None:
            now.end()
        if out:
            yield _batch(out)

    return map_arrow(sharded, run, _ROW)


def _to_ancestors(totals: DataFrame, shared) -> DataFrame:
    """(seq, n_leaves, saved): what each skeleton node brings to itself and to all above it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        skeleton = shared.value
        for b in batches:
            out = []
            for sid, convs, children, leaves, saved, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
                leaves += not children and not skeleton.children[sid]
                saved += (convs - 1) * length
                while sid >= 0:
                    out.append((sid, leaves, saved))
                    sid = skeleton.parent[sid]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] if out else
                                             [pa.array([], pa.int64())] * 3, ["seq", "n_leaves", "saved"])

    cols = totals.select("seq", "n_convs", "n_children", "n_leaves", "saved", "length")
    return map_arrow(cols, run, "seq long, n_leaves long, saved long").groupBy("seq").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))


def _digests(pieces: DataFrame) -> DataFrame:
    """(seq, ends): digest of each skeleton node's pieces in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha, done = None, None, []
        for b in batches:
            for sid, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if sid != at:
                    if at is not None:
                        done.append((at, sha.digest()))
                    at, sha = sid, hashlib.sha256(piece)
                else:
                    sha.update(b"," + piece)
        if at is not None:
            done.append((at, sha.digest()))
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done])],
                                             ["seq", "ends"])

    rows = pieces.repartition("seq").sortWithinPartitions("seq", "conv_id").select("seq", "ends")
    return map_arrow(rows, run, "seq long, ends binary")


def prefix_trie(convs: DataFrame, shards: int | None = None, piece: int = PIECE) -> DataFrame:
    """The nodes over (conv_id long, path array<string>), see ``paths``: conv_id (smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (what storing each shared
    turn once saves in the subtree, in code points), ends_sha256 (of the ids of the conversations
    that end in the node, ascending, joined by commas)."""
    spark = convs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stash(convs.select(F.unhex(F.array_join("path", "")).alias("path"), F.col("conv_id").cast("long").alias("conv_id")), "paths")
    shared = spark.sparkContext.broadcast(Skeleton(splitters(rows, shards)))
    found = stash(_scan(_sharded(rows, shared, shards), shared, piece), "trie")
    totals = stash(found.where(F.col("kind") == _PARTIAL).groupBy("seq").agg(
        F.max("pseq").alias("pseq"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"),
        F.max("length").alias("length")), "skeleton")
    inner = totals.where("pseq IS NOT NULL").groupBy(F.col("pseq").alias("seq")).agg(F.count("*").alias("inner"))
    ends = _digests(found.where(F.col("kind") == _ENDS).select("seq", "conv_id", "ends"))
    skeleton = (totals.drop("n_leaves", "saved").join(_to_ancestors(totals, shared), "seq").join(ends, "seq", "left")
                .join(inner, "seq", "left").withColumn("n_children", F.col("n_children") + F.coalesce("inner", F.lit(0))))
    skeleton = stash(skeleton, "skeleton-nodes")
    names = F.broadcast(skeleton.select(F.col("seq").alias("pseq"), F.col("conv_id").alias("parent_conv_id")))
    local = found.where(F.col("kind") == _NODE)
    below = local.where("pshard = -1").join(names, "pseq")  # the skeleton is bounded by its splitters
    inside = local.where("pshard >= 0").join(local.select(
        F.col("shard").alias("pshard"), F.col("seq").alias("pseq"), F.col("conv_id").alias("parent_conv_id")), ["pshard", "pseq"])
    cols = [F.col("conv_id"), F.col("depth"), F.col("parent_conv_id"), F.col("n_convs"), F.col("n_children"), F.col("n_leaves"),
            F.col("saved").alias("saved_tokens"), F.lower(F.hex(F.coalesce("ends", F.unhex(F.sha2(F.lit(b""), 256))))).alias("ends_sha256")]
    return (skeleton.join(names, "pseq", "left").select(*cols).unionByName(below.select(*cols)).unionByName(inside.select(*cols)))


def with_planted_heads(convs: DataFrame) -> DataFrame:
    """The query's input: the paths, where the first crc32(id) % 6 turns of every conversation are those
    of the conversation whose id is the next lower multiple of 100 (all it has, if fewer; none if
    there is no such conversation)."""
    h = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int")
    heads = convs.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("path", 1, 5).alias("head"))
    own = convs.select("conv_id", "path", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"), h.alias("h"))
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), 1, F.col("h"))
    tail = F.expr("CASE WHEN size(path) > h THEN slice(path, h + 1, size(path) - h) ELSE cast(array() AS array<string>) END")
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, tail).alias("path"))
