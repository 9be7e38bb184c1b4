"""Conversation prefix trie: which conversations share their first turns, and what that sharing saves.

A node is a distinct sequence of first turns; its members are the conversations that start with it.  Nodes are
never materialised one link at a time: conversations are sorted, so a node is a run of rows, at every depth at once.

1. A turn's id is a 120-bit hash of role and text.  Turns are ranked in their conversation by a distributed position.
2. A conversation is cut into slabs of ``SLAB`` turns; a slab's row holds its turn ids, their bytes and the
   key of all turns before it (sums of position-salted hashes, so a key needs running sums only).  A conversation
   of any length is many rows, and a matrix is never wider than a slab.
3. Slab rows are range-sharded by (slab, key, turn ids, conversation).  In a shard the ids become a padded matrix, which
   numpy's lexsort orders; column changes between neighbours, OR-accumulated from the left, mark the node
   starts of every depth.  How far a shard's first row continues the shard before comes from both edge rows.
4. ``reduceat`` over those starts aggregates the nodes of every depth.  All measures are sums or minima over a
   node's rows: a row adds the bytes it shares with the row before it, and the leaf it ends.  Rows whose conversation
   goes on in a later slab bring in what the later slabs add (running sums from the end).
5. Nodes inside a shard are whole.  Nodes that run over a shard's edge, and nodes at a slab's end, are partial: they
   are recombined by key.  Their lists of ended conversations are hashed in a stream of bounded pieces.

A first turn, or a whole conversation, that a third of all conversations share is many shards, each of bounded size.

Defined cases: null role and text are empty; null turns come first; rows of one conversation and turn are ordered by role,
then by their hash; repeated rows are turns of their own; rows without a conversation id take no part; a
conversation without rebuilt turns is a member of the root; an empty table has no node; other input columns
are not used.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.llm.textops import whole
from fraudlens.operators.prefix import with_global_position, with_keyed_cumsum
from fraudlens.session import materialize

SLAB = 64                          # turns of a slab
SHARD_TURNS = 1 << 17              # turns of a range shard, about
HEAD, FAMILY = 9, 5                # the digest's rebuilding: heads of under 9 turns, families of 5 ids
_PIECE = 1024                      # ids of one piece of a partial node's list
_LANES, _LANE_BITS = 4, 30         # a node key is four sums of 30-bit hashes
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_EMPTY = hashlib.sha256(b"").hexdigest()
NODE = ("kind int, depth bigint, conv bigint, parent bigint, p0 bigint, p1 bigint, k0 bigint, k1 bigint, n bigint, "
        "children bigint, leaves bigint, saved bigint, sha string, shard int, piece bigint, ids string")
_WHOLE, _PARTIAL, _LIST = 0, 1, 2


def turn_rows(turns: DataFrame) -> DataFrame:
    """(c, p, hi, lo, nb): place in the conversation from 0, the turn's id, UTF-8 bytes of its text."""
    role, text = whole("role"), whole("text")
    name = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, F.lit(":"), text))
    part = lambda at: F.conv(F.substring(name, at, 15), 16, 10).cast("bigint")
    t = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("c"), "turn", role.alias("role"), part(1).alias("hi"), part(16).alias("lo"),
        F.octet_length(text).cast("bigint").alias("nb"))
    placed = with_global_position(t, ["c", "turn", "role", "hi", "lo"], "at").select("c", "at", "hi", "lo", "nb")
    first = placed.groupBy("c").agg(F.min("at").alias("first"))
    return placed.join(first, "c").select("c", (F.col("at") - F.col("first")).alias("p"), "hi", "lo", "nb")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The digest's conversations: (c, total) and (c, p, hi, lo, nb), each with the first h turns of its family's first."""
    conv = rows.groupBy("c").agg(F.count(F.lit(1)).alias("own"))
    conv = conv.select("c", "own", F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(HEAD)).alias("h"),
                       (F.col("c") - F.col("c") % FAMILY).alias("b"))
    base = conv.select(F.col("c").alias("b"), F.col("own").alias("base"))
    conv = conv.join(base, "b", "left").select("c", "b", "h", F.least("h", F.coalesce("base", F.lit(0))).alias("head"), "own")
    conv = materialize(conv.withColumn("total", F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "conversations")
    tails = rows.join(conv.select("c", "h", "head"), "c").where("p >= h").select(
        "c", (F.col("head") + F.col("p") - F.col("h")).alias("p"), "hi", "lo", "nb")
    # a head holds under HEAD turns, and a family few conversations
    heads = rows.where((F.col("p") < HEAD - 1) & (F.col("c") % FAMILY == 0)).groupBy(F.col("c").alias("b")).agg(
        F.collect_list(F.struct("p", "hi", "lo", "nb")).alias("x"))
    heads = conv.where("head > 0").select("c", "b", "h").join(heads, "b").select("c", "h", F.explode("x").alias("x")).where("x.p < h")
    return conv.select("c", "total"), heads.select("c", "x.*").unionByName(tails)


def lanes(at: np.ndarray, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """(n, 4) hashes of turns at their places; sums of them name a sequence."""
    def mix(x):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
    x = mix(mix(hi.astype(np.uint64)) + lo.astype(np.uint64)) + mix(at.astype(np.uint64) + np.uint64(1))
    return (mix(x[:, None] + _SEEDS) >> np.uint64(64 - _LANE_BITS)).astype(np.int64)


def _key(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = sums & ((1 << _LANE_BITS) - 1)
    return (s[..., 0] << _LANE_BITS) | s[..., 1], (s[..., 2] << _LANE_BITS) | s[..., 3]


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.int64), np.asarray(column.value_lengths(), np.int64)


def _slab_sums(slab: int):
    def run(batches):
        for b in batches:
            ids, sizes = _lists(b.column(2))
            n = sizes // 2
            row = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            each = lanes(np.asarray(b.column(1))[row] * slab + place, ids[0::2], ids[1::2])
            out = np.zeros((len(n), _LANES), np.int64)
            np.add.at(out, row, each)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *map(pa.array, (out & ((1 << _LANE_BITS) - 1)).T)],
                                             ["c", "s", *[f"l{i}" for i in range(_LANES)]])
    return run


def slabs(conv: DataFrame, rows: DataFrame, slab: int = SLAB) -> DataFrame:
    """(c, s, k0, k1, ids, nb, more): a row for each slab of a conversation, and one for a conversation without turns."""
    s = F.floor(F.col("p") / slab)
    x = F.array_sort(F.collect_list(F.struct("p", "hi", "lo", "nb")))
    got = rows.groupBy("c", s.alias("s")).agg(x.alias("x")).select(
        "c", "s", F.flatten(F.transform("x", lambda y: F.array(y["hi"], y["lo"]))).alias("ids"), F.transform("x", lambda y: y["nb"]).alias("nb"))
    none = F.array().cast("array<bigint>")
    bare = conv.where("total = 0").select("c", F.lit(0).cast("bigint").alias("s"), none.alias("ids"), none.alias("nb"), F.lit(0).cast("bigint").alias("total"))
    got = materialize(got.join(conv, "c").unionByName(bare), "slabs")
    # the key before a slab: only conversations of several slabs have one that is not zero
    value, total = [f"l{i}" for i in range(_LANES)], [f"t{i}" for i in range(_LANES)]
    long = got.where(F.col("total") > slab).select("c", "s", "ids").mapInArrow(
        _slab_sums(slab), "c bigint, s bigint, " + ", ".join(f"{v} bigint" for v in value))
    summed = with_keyed_cumsum(long, "c", ["s"], value, total)
    lane = lambda i: F.shiftleft(((F.col(f"t{i}") - F.col(f"l{i}")).cast("bigint").bitwiseAND(F.lit((1 << _LANE_BITS) - 1))),
                                 _LANE_BITS * (1 - i % 2))
    keys = summed.select("c", "s", lane(0).bitwiseOR(lane(1)).alias("k0"), lane(2).bitwiseOR(lane(3)).alias("k1"))
    zero = F.lit(0).cast("bigint")
    return got.join(keys, ["c", "s"], "left").select(
        "c", "s", F.coalesce("k0", zero).alias("k0"), F.coalesce("k1", zero).alias("k1"), "ids", "nb",
        (F.col("total") > (F.col("s") + 1) * slab).alias("more"))


def sort_shard(seg: np.ndarray, ids: np.ndarray, n: np.ndarray, more: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): the sorted order of the rows, and how many first turns each shares with the row before (-1: another segment)."""
    hi, lo = ids[0::2], ids[1::2]
    by = np.lexsort((lo, hi))
    new = np.r_[True, (hi[by][1:] != hi[by][:-1]) | (lo[by][1:] != lo[by][:-1])][:len(by)]
    code = np.empty(len(by), np.int32)
    code[by] = np.cumsum(new)
    row = np.repeat(np.arange(len(n)), n)
    width = int(n.max(initial=0))
    m = np.zeros((len(n), width), np.int32)                    # padded turn ids; 0 comes before every turn
    m[row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)] = code
    order = np.lexsort((c, more, *m.T[::-1], seg))
    m, n, seg = m[order], n[order], seg[order]
    change = np.logical_or.accumulate(m[1:] != m[:-1], axis=1)
    common = np.minimum((~change).sum(1), np.minimum(n[1:], n[:-1]))
    common[seg[1:] != seg[:-1]] = -1
    return order, np.r_[np.full(min(1, len(n)), -1), common].astype(np.int64)


def _sorted(batches):
    table = pa.Table.from_batches(list(batches))               # one range shard
    if not len(table):
        return
    s, k0, k1, c = (np.asarray(table[x]) for x in ("s", "k0", "k1", "c"))
    ids, sizes = _lists(table["ids"])
    by = np.lexsort((k1, k0, s))
    new = np.r_[False, (s[by][1:] != s[by][:-1]) | (k0[by][1:] != k0[by][:-1]) | (k1[by][1:] != k1[by][:-1])]
    seg = np.empty(len(by), np.int64)
    seg[by] = np.cumsum(new)
    order, common = sort_shard(seg, ids, sizes // 2, np.asarray(table["more"]), c)
    n = (sizes // 2)[order]
    table = table.take(pa.array(order))
    bytes_, _ = _lists(table["nb"])
    upto = np.r_[0, np.cumsum(bytes_)]
    start = np.cumsum(n) - n
    after = np.r_[common[1:], -1]
    table = table.append_column("idx", pa.array(np.arange(len(n)))).append_column("common", pa.array(common))
    table = table.append_column("shared", pa.array(upto[start + np.maximum(common, 0)] - upto[start]))
    table = table.append_column("leaf", pa.array((~np.asarray(table["more"]) & (after < n)).astype(np.int64)))
    table = table.append_column("last", pa.array(np.arange(len(n)) == len(n) - 1))
    yield from table.to_batches(max_chunksize=4096)


def _edges(rows: DataFrame) -> DataFrame:
    """(shard, before, after): turns that a shard's first row shares with the last row before it, and its last row with the
    first one after it; -1 where there is none.  Two rows for each shard are read, whatever the data."""
    w = Window.orderBy("shard", "idx")
    prev = lambda c: F.lag(c).over(w).alias(f"{c}_")
    e = rows.where("idx = 0 or last").select("shard", "idx", "s", "k0", "k1", "ids", *[prev(c) for c in ("s", "k0", "k1", "ids")]).where("idx = 0")
    same = F.zip_with("ids", "ids_", lambda x, y: F.coalesce(x == y, F.lit(False)))
    stop = F.array_position(same, False)
    turns = F.floor(F.when(stop == 0, F.size("ids")).otherwise(stop - 1) / 2)
    here = (F.col("s") == F.col("s_")) & (F.col("k0") == F.col("k0_")) & (F.col("k1") == F.col("k1_"))
    e = e.select("shard", F.when(here, turns).otherwise(F.lit(-1)).cast("bigint").alias("before"))
    return e.select("shard", F.coalesce("before", F.lit(-1)).alias("before"),
                    F.coalesce(F.lead("before").over(Window.orderBy("shard")), F.lit(-1)).alias("after"))


def _digest(c: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() if len(c) else _EMPTY


def shard_nodes(table: pa.Table, slab: int = SLAB) -> pa.Table:
    """Nodes of one shard, whole or partial, and the id lists of the partial ones."""
    table = table.sort_by("idx")
    c, s, k0, k1, common, leaf, carried = (np.asarray(table[x], np.int64) for x in ("c", "s", "k0", "k1", "common", "leaf", "carried"))
    more, after, shard = np.asarray(table["more"]), int(table["after"][0].as_py()), int(table["shard"][0].as_py())
    ids, sizes = _lists(table["ids"])
    n, first = sizes // 2, (np.cumsum(sizes) - sizes)
    rows, width = len(c), int(n.max(initial=0))
    upto = np.zeros((rows, width + 1), np.int64)               # bytes of the first turns
    nb, _ = _lists(table["nb"])
    row = np.repeat(np.arange(rows), n)
    upto[row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + 1] = nb
    np.cumsum(upto, axis=1, out=upto)
    shared_upto = upto[np.arange(rows), np.maximum(common, 0)]
    base = np.stack([k0 >> _LANE_BITS, k0 & ((1 << _LANE_BITS) - 1), k1 >> _LANE_BITS, k1 & ((1 << _LANE_BITS) - 1)], 1)

    def name(r, j):
        t = ids[first[r]:first[r] + 2 * j]
        return _key(base[r] + lanes(s[r] * slab + np.arange(j), t[0::2], t[1::2]).sum(0))

    out: list[tuple] = []
    above = None                                               # (node of each row, conv, whether partial, key) one depth up
    for j in range(width + 1):
        active = n >= j
        starts = np.flatnonzero(active & (common < j))
        if active[0] and common[0] >= j:
            starts = np.r_[0, starts]
        if not len(starts):
            break
        node = np.cumsum(np.bincount(starts, minlength=rows)) - 1
        ended = active & ~more & (n == j)
        total = lambda v: np.add.reduceat(np.where(active, v, 0), starts)
        count, leaves = total(np.ones(rows, np.int64)), total(leaf)
        children = total(((n > j) & (common <= j)).astype(np.int64))
        # bytes shared at this depth and below, and what later slabs add
        saved = total(np.where(common >= j, shared_upto - upto[:, max(j - 1, 0)], 0) + carried)
        conv = np.minimum.reduceat(np.where(active, c, np.iinfo(np.int64).max), starts)
        partial = np.zeros(len(starts), bool)
        partial[0] |= bool(active[0] and common[0] >= j)
        partial[-1] |= bool(active[-1] and after >= j)
        if j == slab:
            partial |= np.maximum.reduceat((active & more).astype(np.int8), starts) > 0
        if j == 0:
            partial[:] = True
        keys = [name(r, j) if p else (None, None) for r, p in zip(starts, partial)]
        ends = np.add.reduceat(ended.astype(np.int64), starts)
        for x, r in enumerate(starts):
            depth, later = int(s[r]) * slab + j, j == 0 and s[r] > 0
            p_conv = p0 = p1 = None
            if j:
                up = above[0][r]
                p_conv, (p0, p1) = (None, above[3][up]) if above[2][up] else (above[1][up], (None, None))
            mine = c[r:starts[x + 1] if x + 1 < len(starts) else rows]
            mine = mine[ended[r:r + len(mine)]] if ends[x] else mine[:0]
            if later:                                          # a slab's root: the slab before counts its members
                out.append((_PARTIAL, depth, None, None, None, None, *keys[x], 0, children[x], 0, 0, None, shard, None, None))
            else:
                out.append((_PARTIAL if partial[x] else _WHOLE, depth, conv[x], p_conv, p0, p1, *keys[x], count[x], children[x],
                            leaves[x], saved[x], None if partial[x] else _digest(mine), shard, None, None))
                if partial[x]:
                    out += [(_LIST, depth, None, None, None, None, *keys[x], None, None, None, None, None, shard, i,
                             ",".join(map(str, mine[i:i + _PIECE].tolist()))) for i in range(0, len(mine), _PIECE)]
        above = (node, conv, partial, keys)
    names = [f.split()[0] for f in NODE.split(", ")]
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
    typed = [kinds[f.split()[1]] for f in NODE.split(", ")]
    return pa.table([pa.array([None if v is None else v if isinstance(v, str) else int(v) for v in col], t)
                     for col, t in zip(zip(*out), typed)], names=names)


def _hash_lists(batches):
    """Hashes of id lists that come as pieces in order; only the running hash is held."""
    now, state = None, None
    done = []
    for b in batches:
        for depth, k0, k1, ids in zip(*(b.column(x).to_pylist() for x in ("depth", "k0", "k1", "ids"))):
            if (depth, k0, k1) != now:
                if now:
                    done.append((*now, state.hexdigest()))
                now, state = (depth, k0, k1), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*done))), ["depth", "k0", "k1", "sha"])
            done = []
    if now:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*now, state.hexdigest())], ["depth", "k0", "k1", "sha"])


def trie(conv: DataFrame, rows: DataFrame, slab: int = SLAB, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of the conversations (c, total) with their turns (c, p, hi, lo, nb): (conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256)."""
    made = materialize(slabs(conv, rows, slab), "slab-rows")
    turns = made.agg(F.sum(F.size("nb"))).first()[0] or 0
    wanted = max(int(made.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-turns // shard_turns))
    ranged = made.repartitionByRange(wanted, "s", "k0", "k1", "ids", "more", "c").withColumn("shard", F.spark_partition_id())
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema.fields)
    ordered = materialize(ranged.mapInArrow(_sorted, kinds + ", idx bigint, common bigint, shared bigint, leaf bigint, last boolean"), "shards")
    edges = materialize(_edges(ordered), "edges")
    fixed = ordered.join(edges, "shard")
    upto = F.slice("nb", 1, F.greatest(F.col("before"), F.lit(0)).cast("int"))
    fixed = fixed.withColumn("shared", F.when(F.col("idx") == 0, F.aggregate(upto, F.lit(0).cast("bigint"), lambda a, x: a + x)).otherwise(F.col("shared")))
    fixed = fixed.withColumn("common", F.when(F.col("idx") == 0, F.col("before")).otherwise(F.col("common")))
    fixed = fixed.withColumn("leaf", F.when(F.col("last"), (~F.col("more") & (F.col("after") < F.size("nb"))).cast("bigint")).otherwise(F.col("leaf")))
    # what later slabs of a conversation add to the nodes of an earlier one
    several = fixed.where((F.col("s") > 0) | F.col("more")).select("c", "s", (-F.col("s")).alias("back"), "shared", "leaf")
    summed = with_keyed_cumsum(several, "c", ["back"], ["shared", "leaf"], ["all_shared", "all_leaf"])
    later = summed.select("c", "s", (F.col("all_shared") - F.col("shared")).cast("bigint").alias("carried"),
                          F.col("all_leaf").cast("bigint").alias("end_leaf"))
    full = fixed.join(later, ["c", "s"], "left").withColumn("carried", F.coalesce("carried", F.lit(0))).withColumn(
        "leaf", F.coalesce("end_leaf", "leaf"))
    full = full.select("shard", "idx", "c", "s", "k0", "k1", "ids", "nb", "more", "common", "leaf", "carried", "after")
    found = materialize(full.groupBy("shard").applyInArrow(lambda key, table: shard_nodes(table, slab), NODE), "nodes")

    key = ["depth", "k0", "k1"]
    lists = found.where(F.col("kind") == _LIST).select(*key, "shard", "piece", "ids").repartition(*key).sortWithinPartitions(
        *key, "shard", "piece").select(*key, "ids")
    hashed = lists.mapInArrow(_hash_lists, "depth bigint, k0 bigint, k1 bigint, sha string")
    joined = found.where(F.col("kind") == _PARTIAL).groupBy(*key).agg(
        *[F.min(x).alias(x) for x in ("conv", "parent", "p0", "p1")], *[F.sum(x).alias(x) for x in ("n", "children", "leaves", "saved")])
    joined = materialize(joined.join(hashed, key, "left").withColumn("sha", F.coalesce("sha", F.lit(_EMPTY))), "joined-nodes")
    nodes = found.where(F.col("kind") == _WHOLE).select(joined.columns).unionByName(joined)
    up = joined.select((F.col("depth") + 1).alias("depth"), F.col("k0").alias("p0"), F.col("k1").alias("p1"), F.col("conv").alias("up"))
    known = nodes.where(F.col("p0").isNull()).withColumn("up", F.lit(None).cast("bigint"))
    asked = nodes.where(F.col("p0").isNotNull()).join(up, ["depth", "p0", "p1"], "left").select(known.columns)
    return known.unionByName(asked).select(
        F.col("conv").alias("conv_id"), "depth", F.coalesce("parent", "up").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.col("sha").alias("ends_sha256"))


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of the conversations as they are."""
    rows = materialize(turn_rows(turns), "turns")
    return trie(rows.groupBy("c").agg(F.count(F.lit(1)).alias("total")), rows)


def trie_digest(turns: DataFrame) -> DataFrame:
    """The registered query: conversations rebuilt as its contract fixes them."""
    return trie(*rebuilt(materialize(turn_rows(turns), "turns")))


TRIE_SQL = """
WITH t AS (
  SELECT conv_id AS c, coalesce(text, '') AS text, coalesce(role, '') AS role, turn,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS id
  FROM conversations WHERE conv_id IS NOT NULL),
r AS (SELECT c, id, strlen(text) AS nb, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, id) - 1 AS p FROM t),
v AS (
  SELECT c, c - c % 5 AS b, xor(list_reduce(list_concat([4294967295::BIGINT],
           list_transform(range(1, strlen(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i, 1))::BIGINT)),
           lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, i: xor(y >> 1, 3988292384 * (y & 1)))),
         4294967295) % 9 AS h FROM (SELECT DISTINCT c FROM t)),
s AS (
  SELECT v.c, r.p, r.id, r.nb FROM v JOIN r ON r.c = v.b AND r.p < v.h
  UNION ALL SELECT v.c, r.p, r.id, r.nb FROM v JOIN r ON r.c = v.c AND r.p >= v.h),
k AS (SELECT c, row_number() OVER w AS depth, nb, md5(string_agg(id, '') OVER w) AS node FROM s
      WINDOW w AS (PARTITION BY c ORDER BY p ROWS UNBOUNDED PRECEDING)),
m AS (SELECT c, depth, nb, node FROM k UNION ALL SELECT c, 0, 0, '' FROM v),
l AS (SELECT c, max(depth) AS len FROM m GROUP BY c),
n AS (
  SELECT node, m.depth, min(m.c) AS conv_id, count(*) AS n_convs, any_value(nb) AS nb,
         sha256(coalesce(string_agg(m.c::VARCHAR, ',' ORDER BY m.c) FILTER (WHERE len = m.depth), '')) AS ends_sha256
  FROM m JOIN l ON l.c = m.c GROUP BY node, m.depth),
q AS (SELECT n.*, u.node AS up, a.conv_id AS parent_conv_id
      FROM n LEFT JOIN m u ON u.c = n.conv_id AND u.depth = n.depth - 1 LEFT JOIN n a ON a.node = u.node AND a.depth = n.depth - 1),
ch AS (SELECT up AS node, depth - 1 AS depth, count(*) AS n_children FROM q WHERE depth > 0 GROUP BY ALL),
x AS (SELECT q.*, coalesce(n_children, 0) AS n_children FROM q LEFT JOIN ch ON ch.node = q.node AND ch.depth = q.depth),
z AS (
  SELECT m.node, m.depth, count(*) FILTER (WHERE x.n_children = 0) AS n_leaves, sum((x.n_convs - 1) * x.nb) AS saved_tokens
  FROM x JOIN m ON m.c = x.conv_id AND m.depth <= x.depth GROUP BY m.node, m.depth)
SELECT conv_id, x.depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM x JOIN z ON z.node = x.node AND z.depth = x.depth
"""
