"""N-gram Jaccard join by a token-group matrix.

1. A text becomes its set of distinct k-word shingles, as 64-bit hashes.  Documents with equal sets form one class,
   represented by its least id; copies are counted away before anything else.
2. Two sets of Jaccard ``percent`` or more differ in at most d = a * (100 - percent) / percent tokens, where a is
   the smaller size.  The token space is dealt by hash to d + 2 parts, d taken from the size class of the smaller
   set; at least two parts are then the same in both sets.  A part's signature is the hash of all its tokens, so
   every linked pair shares a signature: the candidates are exact, and a frequent shingle alone makes none.
   (Empty parts have no signature unless a set has so many that a pair could agree in empty parts only.)
3. Documents that share a signature are partitioned into groups of ``GROUP`` similar ones: neighbours in the order of
   their least token hashes.  A group's row of the matrix is the union of its members' tokens; a run of neighbouring
   groups, bounded in sets and in tokens, is a shelf.
4. A query set asks a shelf.  Who meets whom is first thinned by small marks: of the tokens dealt to 2 to 4 bits a token,
   the parity of each bit.  Two marks differ in no more bits than their sets in tokens, so a pair whose marks differ in
   more than a link allows is none; a query or member that is left with no pair of two labels moves no set.
   Of the others a query's overlap with a group's union bounds its overlap with each member, so a group
   whose overlap is under ``percent`` of the larger of the query and the smallest member stays closed; the others
   are opened and compared member by member, exactly.  A block is one shelf and at most ``QUERIES`` query sets, and
   it yields links that connect what it found linked, not all pairs.
5. In turns every set asks one shelf only: that of the least label among the sets it shares a signature with.  Links
   lower labels, so most copies of a text have one label after a turn or two, however many they are.  When turns find
   little, every set that has not the commonest label of a signature asks all its shelves that hold another label,
   once.  Links join components by union-find on the whole link table.

Only ids, signatures, marks and the sets of documents that may link are shuffled, through tables in the shared
checkpoint folder.

Defined cases: null, empty and wordless texts have the empty set and are linked with nothing; fewer words than k
are one shingle; rows that repeat an id are one node, linked by any of their texts; rows without an id are linked
with nothing; empty tables give no rows; other input columns are not used.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.llm.components import components
from fraudlens.llm.neardup import shingle_set
from fraudlens.operators.prefix import with_global_cumsum
from fraudlens.session import materialize

PERCENT = 90                       # of 100: the least Jaccard similarity of a link
GROUP = 64                         # sets of a group
SHELF, SHELF_TOKENS = 1024, 1 << 18  # sets and tokens of a shelf
QUERIES = 256                      # query sets that meet a shelf in one block
LOWER = 3                          # times that a turn lowers the labels
LAST_SHARE = 0.25                  # of the asked sets: turns go on while so many find a link
_STEP = 1.5                        # ratio of the size classes
_BATCH = 1 << 20                   # tokens, or words of marks, that are held at a time


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (murmur3); constants are fixed by its definition."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def size_classes(most: int) -> np.ndarray:
    """Least sizes of the classes, up to one above ``most``."""
    low = [1]
    while low[-1] <= most:
        low.append(max(low[-1] + 1, int(low[-1] * _STEP)))
    return np.array(low, np.int64)


def signatures(tokens: np.ndarray, ends: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(set, signature) of non-empty sets of distinct 64-bit tokens that lie between ``ends``.

    A set has signatures in the size class of each possible smaller partner, itself included."""
    n = np.diff(ends)
    low = size_classes(int(n.max(initial=0)))
    high = np.r_[low[1:], 0] - 1
    first = np.searchsorted(low, -(-n * percent // 100), "right") - 1       # class of its smallest partner
    own = np.searchsorted(low, n, "right") - 1
    x = tokens.view(np.uint64)
    where, what = _mix(x), _mix(x + np.uint64(0x9E3779B97F4A7C15))
    owner = np.repeat(np.arange(len(n)), n)
    out_set, out_sig = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for back in range(int((own - first).max(initial=-1)) + 1):
        c = own - back
        some = (c >= first) & (n > 0)
        if not some.any():
            continue
        parts = np.where(some, high[c] * (100 - percent) // percent + 2, 0)
        at = np.cumsum(parts) - parts
        mine = some[owner]
        o = owner[mine]
        slot = at[o] + ((where[mine] >> np.uint64(32)) * parts[o].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        sums = np.zeros(int(parts.sum()), np.uint64)
        np.add.at(sums, slot, what[mine])
        full = np.bincount(slot, minlength=len(sums)) > 0
        of = np.repeat(np.arange(len(n)), parts)
        empty = np.bincount(of[~full], minlength=len(n))
        differ = np.minimum(high[c], n) * (100 - percent) // percent
        keep = full | (empty >= parts - differ)[of]
        name = (c[of].astype(np.uint64) << np.uint64(40)) + (np.arange(len(of)) - at[of]).astype(np.uint64)
        out_set.append(of[keep])
        out_sig.append(_mix(sums ^ _mix(name + np.uint64(1)))[keep].view(np.int64))
    return np.concatenate(out_set), np.concatenate(out_sig)


def signed_sets(docs: DataFrame, text: str, k: int, percent: int) -> DataFrame:
    """(doc_id, n, k1, k2, m1, m2, sigs): set size, a 128-bit key of the set, its two least hashes, its signatures."""
    s = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.sort_array(shingle_set(text, k)).alias("s"))
    s = s.select("doc_id", F.size("s").cast("bigint").alias("n"), F.xxhash64("s").alias("k1"), F.xxhash64(F.lit(1), "s").alias("k2"),
                 F.get("s", F.lit(0)).alias("m1"), F.get("s", F.lit(1)).alias("m2"), "s")
    schema = T.StructType([*s.schema.fields[:6], T.StructField("sigs", T.ArrayType(T.LongType()))])

    def run(batches):
        for b in batches:
            sets = b.column(6)
            ends = sets.offsets.to_numpy().astype(np.int64)
            flat = sets.flatten().to_numpy(zero_copy_only=False)
            of, sig = signatures(flat, ends - ends[0], percent)
            sizes = np.bincount(of, minlength=len(ends) - 1)
            sig = sig[np.argsort(of, kind="stable")]
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.ListArray.from_arrays(offsets, pa.array(sig))], schema.names)
    return s.mapInArrow(run, schema)


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks()
    return np.asarray(column.flatten(), np.int64), np.asarray(column.value_lengths(), np.int64)


def open_group(q_flat, q_sizes, g_flat, g_sizes, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, member) numbers of the pairs of Jaccard ``percent`` or more, and which queries the group is opened for."""
    union, row = np.unique(g_flat, return_inverse=True)
    order = np.argsort(row, kind="stable")
    holder = np.repeat(np.arange(len(g_sizes)), g_sizes)[order]              # the matrix, token by token
    begin = np.searchsorted(row[order], np.arange(len(union) + 1))
    at = np.searchsorted(union, q_flat)
    at[at == len(union)] = 0
    hit = union[at] == q_flat
    owner = np.repeat(np.arange(len(q_sizes)), q_sizes)
    overlap = np.bincount(owner[hit], minlength=len(q_sizes))
    opened = 100 * overlap >= percent * np.maximum(q_sizes, g_sizes.min())
    hit &= opened[owner]
    at, owner = at[hit], owner[hit]
    out_q, out_g = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    first = np.searchsorted(owner, np.arange(len(q_sizes) + 1))
    i = 0
    while i < len(q_sizes):                                                  # some queries at a time bound the memory
        j = max(i + 1, int(np.searchsorted(first, first[i] + (1 << 14), "right")) - 1)
        t, o = at[first[i]:first[j]], owner[first[i]:first[j]] - i
        many = begin[t + 1] - begin[t]
        which = np.repeat(begin[t] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        common = np.bincount(np.repeat(o, many) * len(g_sizes) + holder[which], minlength=(j - i) * len(g_sizes)).reshape(j - i, -1)
        near = (common > 0) & (100 * common >= percent * (q_sizes[i:j, None] + g_sizes - common))
        a, b = np.nonzero(near)
        out_q.append(a + i)
        out_g.append(b)
        i = j
    return np.concatenate(out_q), np.concatenate(out_g), opened


def parity_marks(tokens: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, ends) of the marks of sets of distinct 64-bit tokens that lie between ``ends``: 64 bits at least, or the power
    of two from twice the set's size on; a bit is the parity of the tokens whose low bits name it."""
    n = np.diff(ends)
    bits = np.left_shift(1, np.maximum(np.frexp(2 * n - 1)[1], 6), dtype=np.int64)
    at = np.r_[0, np.cumsum(bits >> 6)]
    out = np.zeros(at[-1], np.uint64)
    i = 0
    while i < len(n):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + _BATCH, "right")) - 1)
        owner = np.repeat(np.arange(i, j), n[i:j])
        bit = tokens[ends[i]:ends[j]] & (bits[owner] - 1)
        np.bitwise_xor.at(out, at[owner] + (bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
        i = j
    return out, at


def marked(sets: DataFrame) -> DataFrame:
    """(id, n, mark) of sets (id, s)."""
    def run(batches):
        for b in batches:
            s = b.column(1)
            ends = s.offsets.to_numpy().astype(np.int64)
            words, at = parity_marks(s.flatten().to_numpy(zero_copy_only=False), ends - ends[0])
            marks = pa.Array.from_buffers(pa.binary(), len(s), [None, pa.py_buffer((at * 8).astype(np.int32)), pa.py_buffer(words)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(ends)), marks], ["id", "n", "mark"])
    return sets.select("id", "s").mapInArrow(run, "id bigint, n bigint, mark binary")


def may_link(q_n, q_marks, q_label, m_n, m_marks, m_label, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the queries and of the members that are in a pair of two labels whose sizes and marks allow a link."""
    q_some, m_some = np.zeros(len(q_n), bool), np.zeros(len(m_n), bool)
    q_words, m_words = (np.array([len(x) // 8 for x in marks], np.int64) for marks in (q_marks, m_marks))
    for wide in np.unique(q_words):
        for high in np.unique(m_words):
            q, m, w = np.flatnonzero(q_words == wide), np.flatnonzero(m_words == high), min(wide, high)
            # the wider marks are folded: the parity of two bits is the parity of their tokens
            x, y = (np.bitwise_xor.reduce(np.frombuffer(b"".join([marks[i] for i in of]), np.uint64).reshape(len(of), -1, w), axis=1)
                    for marks, of in ((q_marks, q), (m_marks, m)))
            step = max(1, _BATCH // (len(m) * w))
            for i in range(0, len(q), step):
                some = q[i:i + step]
                a, b = q_n[some, None], m_n[m]
                ok = (100 * np.minimum(a, b) >= percent * np.maximum(a, b)) & (q_label[some, None] != m_label[m])
                if ok.any():
                    differ = np.bitwise_count(x[i:i + step, None] ^ y).sum(-1, dtype=np.int64)
                    ok &= (100 + percent) * differ <= (100 - percent) * (a + b)
                    q_some[some] |= ok.any(1)
                    m_some[m] |= ok.any(0)
    return q_some, m_some


def _thin(percent: int):
    def run(key, block):
        queries, shelf = block.filter(pc.is_null(block["grp"])), block.filter(pc.is_valid(block["grp"]))
        sides = [[np.asarray(x["n"], np.int64), x["mark"].to_pylist(), np.asarray(x["comp"], np.int64)] for x in (queries, shelf)]
        keep = may_link(*sides[0], *sides[1], percent)
        # an id that repeats may have several marks
        rows = pa.concat_tables([x.filter(pa.array(k)) for x, k in zip((queries, shelf), keep)]).select(["g", "part", "id", "grp", "comp"])
        return rows.group_by(rows.column_names).aggregate([])
    return run


def shelved(sets: DataFrame) -> DataFrame:
    """(id, g, grp) of rows (id, n, m1, m2): shelf and group by place in the order of the least hashes, and by the tokens so
    far, whatever the number of partitions.  A shelf has at most ``SHELF`` sets, and ``SHELF_TOKENS`` tokens before its last."""
    rows = with_global_cumsum(sets.withColumn("one", F.lit(1)), ["m1", "m2", "n", "id"], ["n", "one"], ["tokens", "sets"])
    at, before = (F.col("sets") - 1).cast("bigint"), (F.col("tokens") - F.col("n")).cast("bigint")
    shelf = F.shiftleft(F.floor(at / SHELF).cast("bigint"), 31) + F.pmod(F.floor(before / SHELF_TOKENS).cast("bigint"), F.lit(1 << 31))
    return rows.select("id", shelf.alias("g"), F.floor(F.pmod(at, F.lit(SHELF)) / GROUP).cast("int").alias("grp"))


def _block(percent: int):
    def run(key, block):
        out = []
        queries, shelf = block.filter(pc.is_null(block["grp"])), block.filter(pc.is_valid(block["grp"]))
        ids = np.asarray(queries["id"], np.int64)
        labels = {}                                        # labels of the shelf that this block has found to be one
        of = np.asarray(shelf["grp"])
        for grp in np.unique(of) if len(ids) else []:
            members = shelf.filter(pa.array(of == grp))
            others, root = (np.asarray(members[x], np.int64) for x in ("id", "comp"))
            q, g, _ = open_group(*_flat(queries["s"]), *_flat(members["s"]), percent)
            ok = others[g] != ids[q]
            q, g = q[ok], g[ok]
            # one link for each query and label, and none that only repeats what others of the block say
            _, first = np.unique(np.stack([q, root[g]]), axis=1, return_index=True)
            for i, j in zip(q[first].tolist(), g[first].tolist()):
                a, b = _root(labels, ("q", i)), _root(labels, int(root[j]))
                if a != b:
                    labels[a] = b
                    out.append((ids[i], others[j]))
        return pa.table(list(np.array(out, np.int64).reshape(-1, 2).T), names=["a", "b"])
    return run


def _root(labels: dict, x):
    while x in labels:
        labels[x] = labels.get(labels[x], labels[x])
        x = labels[x]
    return x


def _ask(asks: DataFrame, sets: DataFrame, groups: DataFrame, labels: DataFrame, percent: int, marks: DataFrame | None = None) -> DataFrame:
    """Links (a, b) found by ``asks`` (id, g), written.

    Who meets where is settled on ids and ``marks`` (those of ``sets``, made here if not given) and written; the sets (id, s)
    are joined to that once, for queries (no group) and shelves together, and move once more to their block."""
    per = materialize(asks.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("parts")), "asked-shelves")
    own = F.pmod(F.xxhash64("id"), F.col("parts")).alias("part")
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part")
    left = asks.join(per, "g").join(labels, "id").select("g", own, "id", F.lit(None).cast("int").alias("grp"), "comp")
    right = groups.join(per, "g").join(labels, "id").select("g", part, "id", "grp", "comp")
    meet = left.unionByName(right).join(marked(sets) if marks is None else marks, "id").groupBy("g", "part").applyInArrow(
        _thin(percent), "g bigint, part bigint, id bigint, grp int, comp bigint")
    meet = materialize(meet, "meetings")
    return materialize(meet.join(sets, "id").groupBy("g", "part").applyInArrow(_block(percent), "a bigint, b bigint"), "found")


def _between(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Links (a, b) as links between the labels of their ends, those inside a label dropped."""
    a, b = (labels.select(F.col("id").alias(c), F.col("comp").alias(f"{c}_")) for c in "ab")
    return links.join(a, "a").join(b, "b").where("a_ <> b_").select(F.col("a_").alias("a"), F.col("b_").alias("b")).distinct()


def _lowered(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (id, comp), each lowered to the least linked one, ``LOWER`` times a few steps on; written.  Equal labels are
    always connected and a label is never above its id; connected ids may still differ."""
    for _ in range(LOWER):
        e = _between(links, labels)
        near = e.union(e.select("b", "a")).groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("to"))
        near = materialize(near, "lower")
        for _ in range(2):
            near = near.join(near.select(F.col("a").alias("to"), F.col("to").alias("far")), "to").select("a", F.col("far").alias("to"))
        labels = materialize(labels.join(near.withColumnRenamed("a", "comp"), "comp", "left").select("id", F.coalesce("to", "comp").alias("comp")),
                             "labels")
    return labels


def link_classes(classes: DataFrame, docs: DataFrame, twice: DataFrame, text: str, k: int,
                 percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Labels (id, comp) of class representatives and links (a, b) between labels that together connect every linked pair.

    ``classes``: (rep, n, m1, m2, sigs), written; ``twice``: repeated ids.  ``docs`` is read again for the sets of
    those that share a signature."""
    rows = classes.select(F.col("rep").alias("id"), F.explode("sigs").alias("sig"))
    shared = materialize(rows.groupBy("sig").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("sig"), "shared")
    members = materialize(rows.join(shared, "sig"), "members")
    if members.isEmpty():
        none = members.select(F.col("id").alias("a"), F.col("id").alias("b"))
        return none.toDF("id", "comp"), none
    placed = members.select("id").distinct().join(classes.select(F.col("rep").alias("id"), "n", "m1", "m2"), "id")
    groups = materialize(shelved(placed), "groups")
    t = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col(text).alias("t"))
    # equal rows of a repeated id are one
    again = t.join(twice, "id", "left_semi").groupBy("id", F.xxhash64("t").alias("h")).agg(F.first("t").alias("t")).drop("h")
    t = t.join(twice, "id", "left_anti").union(again).join(groups.select("id"), "id", "left_semi")
    sets = materialize(t.select("id", shingle_set("t", k).alias("s")), "sets")
    marks = materialize(marked(sets), "marks")
    members = materialize(members.join(groups.select("id", "g"), "id"), "members")
    labels = groups.select("id", F.col("id").alias("comp")).distinct()
    done, links = groups.select("id", "g").limit(0), groups.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)

    # turns: a set asks one shelf, that of the least label of its signatures
    while True:
        act = materialize(members.join(labels, "id"), "members")
        least = act.groupBy("sig").agg(F.min(F.struct("comp", "id", "g")).alias("c"), F.max("comp").alias("d")).where("c.comp < d")
        least = materialize(least.select("sig", F.col("c.comp").alias("c"), F.col("c.g").alias("c_g")), "centres")
        asks = act.join(least, "sig").where("c <> comp").groupBy("id").agg(F.min(F.struct("c", F.col("c_g").alias("g"))).alias("m"))
        asks = materialize(asks.select("id", F.col("m.g").alias("g")).join(done, ["id", "g"], "left_anti"), "asks")
        found = _ask(asks, sets, groups, labels, percent, marks)
        n_asked, n_found = asks.count(), found.select("a").distinct().count()
        done = materialize(done.union(asks), "done")
        if not n_found:
            break
        links = materialize(links.union(found), "links")
        labels = _lowered(labels, found)
        if n_found < LAST_SHARE * n_asked:
            act = materialize(members.join(labels, "id"), "members")
            break

    # the rest: all shelves of a signature that hold another label
    per = act.groupBy("sig", "comp").agg(F.count(F.lit(1)).alias("c"))
    big = per.groupBy("sig").agg(F.count(F.lit(1)).alias("comps"), F.max(F.struct("c", "comp")).alias("m")).where("comps > 1")
    big = materialize(big.select("sig", F.col("m.comp").alias("big")), "mixed")
    mixed = materialize(act.join(big, "sig"), "mixed-members")
    # a shelf has one label ("only") or several (null); signatures of equal shelves are one kind, so that a set asks for
    # the shelves of a kind once, however many of its signatures are of that kind
    held = mixed.groupBy("sig", "g").agg(F.when(F.min("comp") == F.max("comp"), F.min("comp")).alias("only"))
    held = materialize(held, "held")
    two = [F.bit_xor(F.xxhash64(F.lit(i), "g", "only")).alias(f"x{i}") for i in (1, 2)]
    kind = materialize(held.groupBy("sig").agg(*two, F.count(F.lit(1)).alias("x3")), "kinds")
    kind = kind.join(kind.groupBy("x1", "x2", "x3").agg(F.min("sig").alias("kind")), ["x1", "x2", "x3"]).select("sig", "kind")
    asks = mixed.where("comp <> big").select("sig", "id", "comp").join(kind, "sig").select("kind", "id", "comp").distinct()
    asks = asks.join(held.withColumnRenamed("sig", "kind"), "kind").where("only is null or only <> comp")
    asks = materialize(asks.select("id", "g").distinct().join(done, ["id", "g"], "left_anti"), "asks")
    return labels, _between(links.union(_ask(asks, sets, groups, labels, percent, marks)), labels)


def jaccard_components(docs: DataFrame, text: str = "text", k: int = 3, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per document: ``component_id`` is the least id reachable by links."""
    signed = materialize(signed_sets(docs, text, k, percent), "signed")
    linkable = signed.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = materialize(linkable.groupBy("n", "k1", "k2").agg(
        F.min("doc_id").alias("rep"), F.first("m1").alias("m1"), F.first("m2").alias("m2"), F.first("sigs").alias("sigs")), "classes")
    twice = linkable.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("doc_id").alias("id"))
    twice = materialize(twice, "repeated")
    labels, links = link_classes(classes, docs, twice, text, k, percent)
    # rows that repeat an id tie the classes of their texts together
    ties = linkable.join(twice.withColumnRenamed("id", "doc_id"), "doc_id").join(classes.select("n", "k1", "k2", "rep"), ["n", "k1", "k2"]).select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    to = [labels.select(F.col("id").alias(c), F.col("comp").alias(f"{c}_")) for c in "ab"]
    ties = ties.join(to[0], "a", "left").join(to[1], "b", "left").select(F.coalesce("a_", "a").alias("a"), F.coalesce("b_", "b").alias("b"))
    # a label is never above its ids, so the least label reached is the least id reached
    joined = components(links.unionByName(ties)).withColumnRenamed("id", "label")
    of_class = classes.select("n", "k1", "k2", "rep").join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        "n", "k1", "k2", F.coalesce("comp", "rep").alias("label"))
    of_class = materialize(of_class.join(joined, "label", "left").select("n", "k1", "k2", F.coalesce("comp", "label").alias("component_id")),
                           "class-components")
    out = signed.select("doc_id", "n", "k1", "k2").join(of_class, ["n", "k1", "k2"], "left")
    linked = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


GROUPJOIN_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b
      WHERE 100 * c >= 90 * (na.n + nb.n - c)),
r AS (SELECT doc_id AS id, doc_id AS reach FROM documents UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.reach),
m AS (SELECT id, min(reach) AS component_id FROM r GROUP BY id)
SELECT t.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id
FROM t LEFT JOIN n USING (doc_id) JOIN m ON m.id = t.doc_id
"""
