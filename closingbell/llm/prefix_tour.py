"""Prefix trie of conversations by the Euler-tour technique.

A node is a distinct sequence of first turns, named by its smallest conversation and its depth. Each node
has an enter and an exit arc; the arcs form one list, the tour: into a node, through its children by
name, out again. The list is ranked distributedly: stretches of it that lie in one block are contracted
first, then random arcs take in their successors, round by round, until the rest fits one block of
bounded size; what was taken in gets its position back in the opposite order. A node's subtree is what lies
between its arcs, so its leaves and savings are differences of prefix sums at their positions.

No step gathers a conversation, the children of a node or the members of a node in one task: turns and
siblings are put in order by ranges of their sort keys, with one carried value for each range. Prefixes are
compared by 128 bits: the exclusive or of a hash of every turn and its place, which is summed up like
a count. Only the digest of a node's member ids, which is sequential by its definition, is fed by one task,
piece by piece from pieces that other tasks have joined.

Defined results: a null role or text is empty; rows without a conv_id belong to no conversation;
turns come in the order of turn, null first, equal ones in the order of a digest of role and text, and
repeated rows are turns of their own; remainders have the sign of the id; a conversation without turns is
a member of the root alone; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from closingbell.llm.common import stored

#: Arcs that are ranked in one task.
BLOCK_ARCS = 1 << 16
#: Positions that are summed in one window.
CHUNK = 1 << 16
FAMILY, MOST_SHARED = 100, 6


def in_ranges(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The rows, dealt by ranges of the keys; ``part`` numbers the ranges in their order."""
    return stored(df.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), name)


# -- turns and prefixes ---------------------------------------------------------------------


def numbered_turns(conversations: DataFrame, shared: Column, base: Column) -> DataFrame:
    """Every turn with its place ``at`` in its conversation, from 0, and what its conversation takes over.

    ``shared`` and ``base`` are expressions on ``conv_id``: how many first turns of which conversation a
    rebuilt one begins with. ``taken`` of them exist; ``length`` is that of the rebuilt conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        said.alias("said"),
        F.char_length(text).cast("long").alias("chars"),
        F.xxhash64(F.monotonically_increasing_id()).alias("salt"),  # deals equal rows to several ranges
    )
    keys = ["conv_id", "turn", "said", "salt"]
    rows = in_ranges(rows.filter("conv_id IS NOT NULL"), keys, "turns")
    counts = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    parts = Window.partitionBy("conv_id").orderBy("part")
    parts = counts.select(
        "conv_id",
        "part",
        (F.sum("n").over(parts) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("own"),
        shared.cast("long").alias("shared"),
        base.cast("long").alias("base"),
    )
    parts = stored(parts, "segments")
    others = parts.filter("before = 0").select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    parts = parts.join(others, "base", "left")
    taken = F.least("shared", F.coalesce("there", F.lit(0)))
    parts = parts.withColumn("taken", taken).withColumn(
        "length", F.col("taken") + F.greatest(F.col("own") - F.col("shared"), F.lit(0))
    )
    at = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy("turn", "said", "salt"))
    placed = rows.join(parts, ["conv_id", "part"]).withColumn("at", F.col("before") + at - 1)
    return stored(placed.drop("salt", "turn"), "numbered")


def rebuilt(turns: DataFrame, most: int) -> DataFrame:
    """conv_id, depth, said, chars, length and part of every turn of the rebuilt conversations."""
    own = turns.filter("at >= shared").withColumn("depth", F.col("taken") + F.col("at") - F.col("shared") + 1)
    first = turns.filter(F.col("at") < most).select(F.col("conv_id").alias("base"), "at", "said", "chars")
    asked = turns.filter("at = 0").select("conv_id", "base", "shared", "length")
    begun = asked.join(first, "base").filter("at < shared").withColumn("depth", F.col("at") + 1)
    columns = ["conv_id", "depth", "said", "chars", "length"]
    return own.select(*columns, "part").union(begun.select(*columns, F.lit(-1).alias("part")))


def prefixes(rows: DataFrame) -> DataFrame:
    """For every turn the key of the prefix that ends with it (k1, k2) and of the one before (q1, q2)."""
    marks = {f"x{i}": F.xxhash64(F.lit(i), "depth", "said") for i in (1, 2)}
    rows = stored(rows.withColumns(marks), "rebuilt")
    totals = rows.groupBy("conv_id", "part").agg(*(F.bit_xor(x).alias(f"all_{x}") for x in marks))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        "conv_id", "part", *(F.coalesce(F.bit_xor(f"all_{x}").over(before), F.lit(0)).alias(f"old_{x}") for x in marks)
    )
    inside = Window.partitionBy("part", "conv_id").orderBy("depth")
    keyed = rows.join(carried, ["conv_id", "part"])
    for i in (1, 2):
        keyed = keyed.withColumn(f"k{i}", F.col(f"old_x{i}").bitwiseXOR(F.bit_xor(f"x{i}").over(inside)))
        keyed = keyed.withColumn(f"q{i}", F.col(f"k{i}").bitwiseXOR(F.col(f"x{i}")))
    return stored(keyed.select("conv_id", "depth", "k1", "k2", "q1", "q2", "chars", "length"), "prefixes")


# -- the trie -----------------------------------------------------------------------------------


def trie(found: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes, and the members that end at each: node_id, depth, conv_id.

    ``asked`` has one row per conversation (conv_id, length), ``found`` its prefixes.
    """
    facts = [F.any_value(c).alias(c) for c in ("q1", "q2", "chars")]
    nodes = found.groupBy("depth", "k1", "k2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *facts)
    zero = lambda *names: [F.lit(0).cast("long").alias(x) for x in names]
    root = asked.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(*zero("depth", "k1", "k2"), "conv_id", "n_convs", *zero("q1", "q2", "chars"))
    nodes = stored(nodes.unionByName(root), "nodes")
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id")
    )
    linked = nodes.join(above, ["depth", "q1", "q2"], "left")
    ends = found.filter("depth = length").select("depth", "k1", "k2", F.col("conv_id").alias("member"))
    turnless = asked.filter("length = 0").select(*zero("depth", "k1", "k2"), F.col("conv_id").alias("member"))
    names = nodes.select("depth", "k1", "k2", "conv_id")
    ends = ends.union(turnless).join(names, ["depth", "k1", "k2"]).select("conv_id", "depth", "member")
    weight = (F.col("n_convs") - 1) * F.col("chars")
    return linked.select("conv_id", "depth", "parent_conv_id", "n_convs", weight.alias("weight")), ends


def with_kin(nodes: DataFrame) -> DataFrame:
    """Nodes with the number of their children, the first one, and their next sibling."""
    nodes = in_ranges(nodes, ["depth", "parent_conv_id", "conv_id"], "siblings")
    inside = Window.partitionBy("part").orderBy("depth", "parent_conv_id", "conv_id")
    here = F.struct("depth", "parent_conv_id", "conv_id")
    # behind the last node of a range comes the first one of the next: one row for each range
    firsts = nodes.groupBy("part").agg(F.min(here).alias("opens"))
    after = firsts.select("part", F.lead("opens").over(Window.orderBy("part")).alias("opens"))
    placed = nodes.join(F.broadcast(after), "part").withColumn("next", F.coalesce(F.lead(here).over(inside), "opens"))
    same = (F.col("next.depth") == F.col("depth")) & (F.col("next.parent_conv_id") == F.col("parent_conv_id"))
    placed = placed.withColumn("sibling", F.when(same, F.col("next.conv_id"))).drop("next", "opens", "part")
    children = nodes.filter("depth > 0").groupBy("parent_conv_id", "depth")
    children = children.agg(F.count("*").alias("n_children"), F.min("conv_id").alias("child"))
    children = children.select(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"), "n_children", "child")
    return stored(placed.join(children, ["conv_id", "depth"], "left").fillna(0, ["n_children"]), "kin")


def tour(nodes: DataFrame) -> DataFrame:
    """The arcs (a, b) and the next of each (c, d): a is a node's conv_id, b twice its depth, odd for exits."""
    down = F.col("depth") * 2
    arc = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    own = F.col("conv_id")
    into = F.when(F.col("n_children") > 0, arc(F.col("child"), down + 2)).otherwise(arc(own, down + 1))
    out = F.when(F.col("sibling").isNotNull(), arc(F.col("sibling"), down)).when(
        F.col("depth") > 0, arc(F.col("parent_conv_id"), down - 1)
    )
    both = F.array(
        F.struct(down.alias("b"), into.alias("to")),
        F.struct((down + 1).alias("b"), out.alias("to")),
    )
    arcs = nodes.select(own.alias("a"), F.explode(both).alias("arc"))
    return arcs.select("a", "arc.b", F.col("arc.to.a").alias("c"), F.col("arc.to.b").alias("d"))


# -- ranking a list -----------------------------------------------------------------------------

CONTRACTED = "a long, b long, head_a long, head_b long, off long, c long, d long, steps long"
_CONTRACTED = pa.schema([(x.split()[0], pa.int64()) for x in CONTRACTED.split(", ")])


def contract(rows: pa.Table) -> pa.Table:
    """Each arc's head, the first arc of its stretch inside this block, and the steps from it.

    Heads (off 0) also get the arc behind their stretch and the steps to it.
    """
    n = rows.num_rows
    a, b, steps = (rows[x].to_numpy() for x in ("a", "b", "steps"))
    there = pc.is_valid(rows["c"]).to_numpy()
    c, d = (pc.fill_null(rows[x], 0).to_numpy() for x in ("c", "d"))
    # number arcs and successors alike
    first, second = np.concatenate([a, c]), np.concatenate([b, d])
    order = np.lexsort((second, first))
    new = np.ones(2 * n, bool)
    new[1:] = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
    number = np.empty(2 * n, np.int64)
    number[order] = np.cumsum(new) - 1
    place = np.full(2 * n, -1)
    place[number[:n]] = np.arange(n)
    follows = np.where(there, place[number[n:]], -1)
    inner = np.flatnonzero(follows >= 0)
    head, off = np.arange(n), np.zeros(n, np.int64)
    head[follows[inner]] = inner
    off[follows[inner]] = steps[inner]
    while True:
        further = head[head]
        if (further == head).all():
            break
        off = off + off[head]
        head = further
    last = np.flatnonzero(follows < 0)
    total, tail = np.zeros(n, np.int64), np.zeros(n, np.int64)
    total[head[last]] = off[last] + steps[last]
    tail[head[last]] = last
    is_head = head == np.arange(n)
    ends = ~is_head | ~there[tail]
    columns = [a, b, a[head], b[head], off]
    arrays = [pa.array(x) for x in columns]
    arrays += [pa.array(x[tail], mask=ends) for x in (c, d)] + [pa.array(total, mask=~is_head)]
    return pa.table(arrays, schema=_CONTRACTED)


def _blocks(links: DataFrame, block: Column) -> DataFrame:
    return links.withColumn("block", block).groupBy("block").applyInArrow(lambda t: contract(t.combine_chunks()), CONTRACTED)


def list_rank(links: DataFrame, count: int, block_arcs: int = BLOCK_ARCS) -> DataFrame:
    """a, b and position (from 0) of every arc of one list; ``links`` has a, b and the next arc c, d.

    The number of rounds grows with the logarithm of the list; each leaves about three quarters.
    """
    blocks = -(-count // block_arcs)
    near = F.pmod(F.xxhash64("a", F.shiftright("b", 13)), F.lit(max(1, blocks))).cast("int")
    local = stored(_blocks(links.withColumn("steps", F.lit(1).cast("long")), near), "stretches")
    taken = [local.filter("steps IS NULL").select("a", "b", "head_a", "head_b", "off")]
    left = local.filter("steps IS NOT NULL").select("a", "b", "c", "d", "steps")
    rounds = 0
    while left.count() > block_arcs:
        rounds += 1
        coin = F.xxhash64(F.lit(rounds), "a", "b").bitwiseAND(F.lit(1)) == 1
        stays, goes = left.filter(~coin).alias("x"), left.filter(coin).alias("y")
        met = stays.join(goes, (F.col("x.c") == F.col("y.a")) & (F.col("x.d") == F.col("y.b")), "full")
        both = F.col("x.a").isNotNull() & F.col("y.a").isNotNull()
        own = lambda name: F.coalesce(f"x.{name}", f"y.{name}").alias(name)
        behind = lambda name: F.when(F.col("y.a").isNotNull(), F.col(f"y.{name}")).otherwise(F.col(f"x.{name}")).alias(name)
        step = met.select(
            own("a"),
            own("b"),
            behind("c"),
            behind("d"),
            (F.coalesce("x.steps", F.lit(0)) + F.coalesce("y.steps", F.lit(0))).alias("steps"),
            *(F.when(both, F.col(f"y.{x}")).alias(f"gone_{x}") for x in ("a", "b")),
            F.when(both, F.col("x.steps")).alias("off"),
        )
        step = stored(step, "round")
        gone = step.filter("gone_a IS NOT NULL")
        taken.append(gone.select(F.col("gone_a").alias("a"), F.col("gone_b").alias("b"), F.col("a").alias("head_a"), F.col("b").alias("head_b"), "off"))
        left = step.select("a", "b", "c", "d", "steps")
    ranks = stored(_blocks(left, F.lit(0)).select("a", "b", F.col("off").alias("pos")), "ranks")
    for gone in reversed(taken):
        heads = ranks.select(F.col("a").alias("head_a"), F.col("b").alias("head_b"), "pos")
        back = gone.join(heads, ["head_a", "head_b"]).select("a", "b", (F.col("pos") + F.col("off")).alias("pos"))
        ranks = stored(ranks.union(back), "ranks")
    return ranks


def subtree_sums(nodes: DataFrame, ranks: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """conv_id, depth, leaves and saved of every node's subtree, from prefix sums over the tour."""
    placed = ranks.select(
        F.col("a").alias("conv_id"), F.shiftright("b", 1).alias("depth"), (F.col("b") % 2 == 1).alias("out"), "pos"
    )
    arcs = placed.join(nodes, ["conv_id", "depth"]).select(
        "conv_id",
        "depth",
        "out",
        "pos",
        F.floor(F.col("pos") / chunk).alias("chunk"),
        F.when(~F.col("out") & (F.col("n_children") == 0), 1).otherwise(0).cast("long").alias("leaf"),
        F.when(~F.col("out"), F.col("weight")).otherwise(0).alias("worth"),
    )
    arcs = stored(arcs, "arcs")
    sums = arcs.groupBy("chunk").agg(F.sum("leaf").alias("leaf"), F.sum("worth").alias("worth"))
    upto = Window.orderBy("chunk")  # one row for each chunk of positions
    before = sums.select("chunk", *((F.sum(x).over(upto) - F.col(x)).alias(f"old_{x}") for x in ("leaf", "worth")))
    inside = Window.partitionBy("chunk").orderBy("pos")
    summed = arcs.join(before, "chunk")
    for x in ("leaf", "worth"):
        # at its exit what stands up to there, at its enter what stands before it
        upto_here = F.col(f"old_{x}") + F.sum(x).over(inside)
        summed = summed.withColumn(f"sum_{x}", F.when(F.col("out"), upto_here).otherwise(F.col(x) - upto_here))
    return summed.groupBy("conv_id", "depth").agg(F.sum("sum_leaf").alias("n_leaves"), F.sum("sum_worth").alias("saved_tokens"))


# -- digests of members -------------------------------------------------------------------------

PIECES = "conv_id long, depth long, first long, ids string"
DIGESTS = "conv_id long, depth long, ends_sha256 string"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one node's members, joined."""
    for batch in batches:
        if not batch.num_rows:
            continue
        conv, depth, member = (batch[x].to_numpy() for x in ("conv_id", "depth", "member"))
        new = np.ones(len(conv), bool)
        new[1:] = (conv[1:] != conv[:-1]) | (depth[1:] != depth[:-1])
        first = np.flatnonzero(new)
        names = member.tolist()
        ids = [",".join(map(str, names[i:j])) for i, j in zip(first, [*first[1:], len(names)])]
        yield pa.record_batch([pa.array(x[first]) for x in (conv, depth, member)] + [pa.array(ids, pa.string())], ["conv_id", "depth", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's pieces, which come in order; one node's state at a time."""
    node, state = None, None
    for batch in batches:
        out = []
        for conv, depth, ids in zip(*(batch[x].to_pylist() for x in ("conv_id", "depth", "ids"))):
            if (conv, depth) != node:
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = (conv, depth), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield from _digest_rows(out)
    if node is not None:
        yield from _digest_rows([(*node, state.hexdigest())])


def _digest_rows(rows: list) -> Iterator[pa.RecordBatch]:
    if rows:
        conv, depth, digest = zip(*rows)
        yield pa.record_batch([pa.array(conv, pa.int64()), pa.array(depth, pa.int64()), pa.array(digest, pa.string())], ["conv_id", "depth", "ends_sha256"])


def member_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node, ascending and joined by commas."""
    keys = ["conv_id", "depth", "member"]
    pieces = ends.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(_pieces, PIECES)
    dealt = pieces.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first")
    return dealt.mapInArrow(_digests, DIGESTS)


def prefix_tree(
    conversations: DataFrame,
    shared: Column | None = None,
    base: Column | None = None,
    most_shared: int = MOST_SHARED,
    block_arcs: int = BLOCK_ARCS,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. A
    conversation is rebuilt from the first ``shared`` (less than ``most_shared``) turns of ``base`` and
    its own turns behind as many; both are expressions on ``conv_id``. Left out, ``shared`` is zero: the
    conversations are taken as they are.
    """
    own = F.col("conv_id")
    turns = numbered_turns(conversations, F.lit(0) if shared is None else shared, own if base is None else base)
    asked = turns.filter("at = 0").select("conv_id", "length")
    found = prefixes(rebuilt(turns, most_shared))
    nodes, ends = trie(found, asked)
    nodes = with_kin(nodes)
    ranks = list_rank(tour(nodes), 2 * nodes.count(), block_arcs)
    sums = subtree_sums(nodes, ranks, chunk)
    tree = nodes.join(sums, ["conv_id", "depth"]).join(member_digests(ends), ["conv_id", "depth"], "left")
    none = hashlib.sha256(b"").hexdigest()
    return tree.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )
