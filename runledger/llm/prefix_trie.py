"""The trie of conversation prefixes, as flat arrays behind a minimal perfect hash.

Every distinct sequence of first turns is a node, and it is named by a 128-bit digest of that
sequence and its depth. The digest of a prefix is the exclusive or of one hash for each of its
turns, which depends on the turn and its place, so digests of all prefixes are running sums that
can be cut anywhere, and the digest of a parent is that of the node without its last turn.

Nodes are counted by Spark, combined before the shuffle. What is summed over subtrees is
accumulated in shards. A node is heavy if more than ``LIGHT_TURNS`` turns lie below it, copies
included. Heavy nodes are few and form the top of the trie, as a parent is never lighter than its
child; below them hang subtrees of bounded size, which are dealt by hash into shards of about
``SHARD_TURNS``. A shard gives each of its digests a slot by a minimal perfect hash: level by level
keys that are alone at their place get it, the others go on; a digest is looked up by the same
levels and checked against the one in its slot. Counts are scattered into arrays by slot, parents
are found as slots, and sums go up along the parents' slots, deepest nodes first. What the subtrees
below heavy nodes come to is then added up over the heavy ones by pointer doubling, in as many
rounds as the logarithm of their depth. So one common first turn is no task's work, and neither is
one conversation of very many turns.

Defined cases: turns of a conversation are in order of ``turn``, nulls first, ties by a hash of
role and text; a null role or text is empty; repeated rows are turns of their own; rows without a
conversation id take no part; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.common import mixed, stored
from runledger.operators.hot_windows import numbered

#: Turns below a node, copies included, from which it is heavy; and turns of a shard, about.
LIGHT_TURNS, SHARD_TURNS = 4_096, 32_768

#: Rows of one conversation that are numbered and hashed in one task, about.
SLICE_TURNS = 100_000

#: Heavy nodes that are broadcast at most; more are joined.
BROADCAST_NODES = 1_000_000

#: Conversation ids that are written into one row before hashing: 64 KiB of digits, about.
IDS_AT_ONCE = 4_096

_NODE = ["depth", "x", "y"]
_PARENT = ["parent_x", "parent_y"]


def turns_in_order(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv, pos, a, b, words): turns from 0 with two hashes of role and text."""
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"),
        F.col(turn).isNotNull().cast("int").alias("told"),
        F.coalesce(F.col(turn).cast("long"), F.lit(0)).alias("turn"),
        F.xxhash64(F.lit(1), role_, text_).alias("a"),
        F.xxhash64(F.lit(2), role_, text_).alias("b"),
        F.regexp_count(text_, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("words"),
    )
    in_order = numbered(rows, ["conv"], ["told", "turn", "a", "b"], SLICE_TURNS)
    return in_order.select("conv", (F.col("row_no") - 1).alias("pos"), "a", "b", "words")


def rebuilt_turns(turns: DataFrame, every: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another one, and their lengths (conv, size).

    The first h turns of conversation c become those of conversation c - c % ``every``, where h is
    the CRC-32 of c's digits modulo ``most`` + 1, all of them if that has fewer, none if it is not
    there; the own turns after the first h follow.
    """
    convs = stored(
        turns.groupBy("conv").agg(F.count("*").alias("n")).select(
            "conv", "n", (F.col("conv") - F.col("conv") % every).alias("base"),
            (F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)).alias("h"),
        ),
        "conversations",
    )
    bases = convs.filter("conv = base").select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(bases, "base", "left").withColumn("lent", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = stored(
        convs.withColumn("size", F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "sizes"
    ).select("conv", "base", "h", "lent", "size")
    heads = turns.filter((F.col("pos") < most) & (F.col("conv") % every == 0)).withColumnRenamed("conv", "base")
    lent = heads.join(convs, "base").filter(F.col("pos") < F.col("lent"))
    own = turns.join(convs, "conv").filter(F.col("pos") >= F.col("h"))
    columns = ["conv", "pos", "a", "b", "words", "size"]
    own = own.withColumn("pos", F.col("pos") - F.col("h") + F.col("lent"))
    return lent.select(columns).unionByName(own.select(columns)), convs.select("conv", "size")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, size, depth, x, y, parent_x, parent_y, words): a row for each first d turns of each."""
    hashed = turns.withColumns(
        {
            "u": F.xxhash64(F.lit(11), "pos", "a", "b"),
            "v": F.xxhash64(F.lit(29), "pos", "b", "a"),
            "block": F.floor(F.col("pos") / SLICE_TURNS),
        }
    )
    so_far = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = hashed.withColumns({"x": F.bit_xor("u").over(so_far), "y": F.bit_xor("v").over(so_far)})
    # What the earlier blocks of a long conversation come to: a row per block, none for short ones.
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = hashed.filter(F.col("size") > SLICE_TURNS).groupBy("conv", "block")
    blocks = blocks.agg(F.bit_xor("u").alias("u_"), F.bit_xor("v").alias("v_")).select(
        "conv", "block", F.bit_xor("u_").over(earlier).alias("x_"), F.bit_xor("v_").over(earlier).alias("y_")
    )

    def whole(own: str, before: str) -> Column:
        return F.col(own).bitwiseXOR(F.coalesce(before, F.lit(0)))

    long = sums.filter(F.col("size") > SLICE_TURNS).join(blocks, ["conv", "block"], "left")
    long = long.withColumns({"x": whole("x", "x_"), "y": whole("y", "y_")}).drop("x_", "y_")
    every = sums.filter(F.col("size") <= SLICE_TURNS).unionByName(long)
    return every.select(
        "conv", "size", (F.col("pos") + 1).alias("depth"), "x", "y",
        F.col("x").bitwiseXOR(F.col("u")).alias("parent_x"), F.col("y").bitwiseXOR(F.col("v")).alias("parent_y"), "words",
    )


class PerfectSlots:
    """A minimal perfect hash: n distinct digests (two 64-bit numbers each) to slots 0 to n - 1."""

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, given = np.arange(len(keys)), 0
        self.keys = np.zeros_like(keys)
        while len(left):
            place = self._place(keys[left], len(self.levels), 2 * len(left))
            alone = np.bincount(place, minlength=2 * len(left)) == 1
            slot = given + np.cumsum(alone) - 1
            self.levels.append((alone, slot))
            got = alone[place]
            self.keys[slot[place[got]]] = keys[left[got]]
            given += int(got.sum())
            left = left[~got]

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        turned = keys[:, 1] * np.uint64(2 * level + 1) + np.uint64(level)
        return (mixed(keys[:, 0] ^ mixed(turned)) % np.uint64(size)).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Slots of ``keys``; -1 for one that the slot's own digest shows not to be there."""
        out = np.full(len(keys), -1)
        left = np.arange(len(keys))
        for level, (alone, slot) in enumerate(self.levels):
            place = self._place(keys[left], level, len(alone))
            hit = alone[place]
            out[left[hit]] = slot[place[hit]]
            left = left[~hit]
        found = out >= 0
        found[found] = (self.keys[out[found]] == keys[found]).all(axis=1)
        return np.where(found, out, -1)


def _digests(part: pa.Table, x: str, y: str, depth: np.ndarray) -> np.ndarray:
    """The two numbers of a node, which the depth is mixed into."""
    mix = mixed(depth.astype(np.uint64))
    return np.stack([part[c].to_numpy().view(np.uint64) + mix for c in (x, y)], axis=1)


def _summed(part: pa.Table) -> pa.Table:
    """Sums over the subtrees of a shard, a row per node; a node whose parent is elsewhere is a top."""
    depth = part["depth"].to_numpy()
    own = _digests(part, "x", "y", depth)
    table = PerfectSlots(own)
    slot = table.of(own)
    n = len(slot)
    at = np.empty(n, np.int64)
    at[slot] = np.arange(n)
    parent = np.empty(n, np.int64)
    parent[slot] = table.of(_digests(part, "parent_x", "parent_y", depth - 1))
    level, conv = depth[at], part["conv"].to_numpy()[at]
    saved = ((part["n_convs"].to_numpy() - 1) * part["words"].to_numpy())[at]
    inner = parent >= 0
    children = np.bincount(parent[inner], minlength=n)
    leaves = (children == 0).astype(np.int64)
    deepest_first = np.argsort(-level, kind="stable")
    for nodes in np.split(deepest_first, np.flatnonzero(np.diff(level[deepest_first])) + 1):
        nodes = nodes[inner[nodes]]
        np.add.at(leaves, parent[nodes], leaves[nodes])
        np.add.at(saved, parent[nodes], saved[nodes])
    parents = pa.array(np.where(inner, conv[parent], 0), mask=~inner)
    columns = {"n_children": children[slot], "n_leaves": leaves[slot], "saved_tokens": saved[slot]}
    for name, values in columns.items():
        part = part.append_column(name, pa.array(values, pa.int64()))
    return part.append_column("parent_conv_id", parents.take(pa.array(slot)))


def _heavy_sums(heavy: DataFrame) -> DataFrame:
    """n_leaves and saved_tokens of ``heavy`` added up over their heavy descendants.

    After k rounds a node has the sums of all nodes less than 2**k below it, and the ancestor
    2**k above it, whose sums it then adds to.
    """
    key = [F.col(c) for c in _NODE]
    state = stored(
        heavy.select(
            F.struct(*key).alias("id"), "n_leaves", "saved_tokens",
            F.when(F.col("depth") > 0, F.struct((F.col("depth") - 1).alias("depth"), F.col("parent_x").alias("x"), F.col("parent_y").alias("y"))).alias("up"),
        ),
        "heavy",
    )
    while not state.filter(F.col("up").isNotNull()).isEmpty():
        more = state.filter(F.col("up").isNotNull()).groupBy(F.col("up").alias("id"))
        more = more.agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        above = state.select(F.col("id").alias("up"), F.col("up").alias("further"))
        state = stored(
            state.join(more, "id", "left").join(above, "up", "left").select(
                "id", (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("s", F.lit(0))).alias("saved_tokens"), F.col("further").alias("up"),
            ),
            "heavy",
        )
    return state.select("id.*", "n_leaves", "saved_tokens")


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, x, y, ends_sha256) from conversations and the nodes they end at (depth, x, y, conv).

    Ids are sorted over all tasks, so the ids of a node lie in neighbouring ones; each writes its
    own in one row or a few, and these rows, in order, are hashed one after the other.
    """
    node = [F.col(c) for c in _NODE]
    in_order = ends.repartitionByRange(*node, "conv").sortWithinPartitions(*node, "conv")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in _NODE], axis=1)
            new = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))[: len(keys)])
            to = np.append(new[1:], len(keys))
            begin = np.concatenate([np.arange(a, b, IDS_AT_ONCE) for a, b in zip(new, to)] or [new]).astype(np.int64)
            end = np.minimum(np.append(begin[1:], len(keys)), begin + IDS_AT_ONCE)
            conv = batch.column("conv").to_pylist()
            text = [",".join(map(str, conv[a:b])) for a, b in zip(begin, end)]
            heads = batch.select([*_NODE, "conv"]).take(pa.array(begin))
            yield pa.RecordBatch.from_arrays([*heads.columns, pa.array(text, pa.string())], [*_NODE, "conv", "ids"])

    schema = "depth long, x long, y long, conv long, ids string"
    rows = in_order.select(*_NODE, "conv").mapInArrow(written, schema)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            out: list[tuple] = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "ids"))):
                if key == now:
                    digest.update(b",")
                else:
                    if now is not None:
                        out.append((*now, digest.hexdigest()))
                    now, digest = key, sha256()
                digest.update(ids.encode())
            yield _ends_batch(out)
        if now is not None:
            yield _ends_batch([(*now, digest.hexdigest())])

    return rows.repartition(*node).sortWithinPartitions(*node, "conv").mapInArrow(hashed, "depth long, x long, y long, ends_sha256 string")


def _ends_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*_NODE, "ends_sha256"])


def prefix_trie(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """A row per node of the trie of conversations.

    ``turns`` (conv, pos, a, b, words, size) are all turns with the size of their conversation;
    ``sizes`` (conv, size) all conversations, those without turns too.
    """
    paths = stored(prefixes(turns), "paths")
    zero = F.lit(0).cast("long")
    below = (F.col("size") - F.col("depth") + 1).alias("below")
    root = sizes.select(
        "conv", "size", zero.alias("depth"), zero.alias("x"), zero.alias("y"), zero.alias("parent_x"), zero.alias("parent_y"), zero.alias("words")
    )
    nodes = stored(
        paths.unionByName(root)
        .groupBy(*_NODE)
        .agg(
            F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.min("words").alias("words"),
            F.min("parent_x").alias("parent_x"), F.min("parent_y").alias("parent_y"), F.sum(below).alias("below"),
        ),
        "nodes",
    )
    heavy = nodes.filter(F.col("below") > LIGHT_TURNS)
    names = stored(heavy.select(*_NODE), "heavy")
    if names.count() <= BROADCAST_NODES:
        names = F.broadcast(names)
    # A path is heavy as far as some depth; the first light node on it is the top of its subtree.
    every = paths.select("conv", *_NODE).unionByName(root.select("conv", *_NODE))
    tops = every.join(names, _NODE, "left_anti").groupBy("conv").agg(F.min(F.struct(*_NODE)).alias("top"))
    total = sizes.agg(F.sum("size"), F.count("*")).first()
    shards = max(1, -(-(total[0] or 0) // SHARD_TURNS))
    light = nodes.filter(F.col("below") <= LIGHT_TURNS).join(tops, "conv")
    light = light.withColumn("shard", F.pmod(F.xxhash64("top"), F.lit(shards)).cast("int")).drop("top", "below")
    added = "n_children long, n_leaves long, saved_tokens long, parent_conv_id long"
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in light.schema.fields)
    summed = stored(light.groupBy("shard").applyInArrow(_summed, f"{kinds}, {added}"), "summed")

    up = [(F.col("depth") - 1).alias("depth"), F.col("parent_x").alias("x"), F.col("parent_y").alias("y")]
    hang = summed.filter("parent_conv_id is null and depth > 0")
    from_light = hang.select(*up, "n_leaves", "saved_tokens", F.lit(1).alias("child"))
    from_heavy = heavy.filter("depth > 0").select(*up, zero.alias("n_leaves"), zero.alias("saved_tokens"), F.lit(1).alias("child"))
    gathered = (
        from_light.unionByName(from_heavy)
        .groupBy(*_NODE)
        .agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"), F.sum("child").alias("c"))
    )
    own = heavy.join(gathered, _NODE, "left").withColumns(
        {
            "n_children": F.coalesce("c", zero),
            "n_leaves": F.when(F.col("c").isNull(), F.lit(1).cast("long")).otherwise(F.col("l")),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("words") + F.coalesce("s", zero),
        }
    )
    own = stored(own.select(*_NODE, *_PARENT, "conv", "n_convs", "n_children", "n_leaves", "saved_tokens"), "tops")
    top = own.drop("n_leaves", "saved_tokens").join(_heavy_sums(own), _NODE)
    # Only tops of subtrees and heavy nodes have their parent among the heavy ones.
    parents = own.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("parent_x"), F.col("y").alias("parent_y"), F.col("conv").alias("above"))
    columns = [*_NODE, "conv", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    outer = hang.drop("parent_conv_id").select(*_PARENT, *[c for c in columns if c != "parent_conv_id"]).unionByName(
        top.select(*_PARENT, *[c for c in columns if c != "parent_conv_id"])
    )
    outer = outer.join(parents, ["depth", *_PARENT], "left").withColumnRenamed("above", "parent_conv_id").select(columns)
    inner = summed.filter("parent_conv_id is not null or depth = 0").select(columns)
    ends = paths.filter("depth = size").unionByName(root.filter("size = 0")).select(*_NODE, "conv")
    none = F.lit(sha256(b"").hexdigest())
    return (
        inner.unionByName(outer)
        .join(ends_digest(ends), _NODE, "left")
        .select(
            F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", none).alias("ends_sha256"),
        )
    )


def conversation_trie(conversations: DataFrame, every: int = 20, most: int = 3, **columns: str) -> DataFrame:
    """The trie of all conversations, rebuilt so that ``every`` neighbours share first turns."""
    turns = stored(turns_in_order(conversations, **columns), "turns")
    rebuilt, sizes = rebuilt_turns(turns, every, most)
    return prefix_trie(rebuilt, sizes)
