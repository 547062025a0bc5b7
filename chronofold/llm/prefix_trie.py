"""The trie of conversation prefixes, with totals of every subtree by a depth-band rollup.

A node of depth d is a distinct sequence of the first d turns (role and text). Its key is d and a 128-bit sum over its
turns of a hash of (place, role, text); a sum can be formed in parts, so no conversation is ever walked by one task.
Each node is owned by its smallest member; since deeper nodes have fewer members, a conversation owns its nodes from
some depth on, and its own turns tell their ancestors.

Subtree totals: depths are cut into bands of ``BAND``. A node explodes only to its ancestors within its band, so to at
most ``BAND`` rows. The top nodes of the bands form a trie whose depth is smaller by that factor; its totals are found
in the same way, and each completed top then hands its total to its ancestors in the band above, at most ``BAND``
rows again. That makes log_BAND(depth) rounds each way however long the longest conversation is. Totals are
combined map-side, so the root or any other node may have any number of nodes below it.

Turns are ordered by number, null first; equal numbers by the hash of role and text. Null role or text is the empty
string. Rows of null conv_id take no part. Equal rows are turns each. An empty table has no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.storage import saved
from chronofold.llm.streams import runs

#: Height of a band; rows of a window along a conversation; conv_ids (as a power of two) that are joined in one piece.
BAND, STRETCH, PIECE_BITS = 16, 1024, 12
#: Conversations come in groups of so many, whose first one lends its turns, and fewer turns than this.
GROUP, LENT = 5, 9
#: Leaves and tokens are summed over subtrees.
_SUMS = ("n_leaves", "saved_tokens")
_KEY = ("depth", "a", "b")
_PARTS = ("p0", "p1", "p2", "p3")


def _before(value: str, window: Window) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def running(rows: DataFrame, at: str, order: list[str], sums: list[str]) -> DataFrame:
    """Turn the columns ``sums`` into running sums along each conversation, the row itself included.

    Rows lie in stretches by ``at div STRETCH``; sums run inside a stretch and over the stretches, so a window holds
    the rows of one stretch or one row per stretch.
    """
    cut = rows.withColumn("__stretch", F.coalesce(F.expr(f"`{at}` div {STRETCH}L"), F.lit(-(2**62))))
    totals = cut.groupBy("conv_id", "__stretch").agg(*[F.sum(c).alias(c) for c in sums])
    earlier = Window.partitionBy("conv_id").orderBy("__stretch")
    bases = totals.select("conv_id", "__stretch", *[_before(c, earlier).alias(f"__base_{c}") for c in sums])
    inside = Window.partitionBy("conv_id", "__stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = cut.withColumns({c: F.sum(c).over(inside) for c in sums}).join(bases, ["conv_id", "__stretch"])
    return summed.withColumns({c: (F.col(c) + F.col(f"__base_{c}")).cast("long") for c in sums}).drop("__stretch", *[f"__base_{c}" for c in sums])


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest (of role and text), bytes (of the text) of every turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), F.sha2(whole, 256).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"), F.lit(1).cast("long").alias("place"))
    return running(turns, "turn", ["turn", "digest"], ["place"]).drop("turn")


def lent_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first one of its group."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % LENT).cast("long")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations' lengths after rebuilding (conv_id, length; also without turns), and their turns.

    Every conversation keeps its turns after its first h, behind the first h of the conversation that opens its group.
    """
    sizes = turns.groupBy("conv_id").agg(F.max("place").alias("own"))
    asked = sizes.select("conv_id", "own", lent_turns(F.col("conv_id")).alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("first_id"))
    lenders = sizes.select(F.col("conv_id").alias("first_id"), F.col("own").alias("there"))
    plans = asked.join(lenders, "first_id", "left").withColumn("lent", F.least("h", F.coalesce("there", F.lit(0))))
    plans = saved(plans.select("conv_id", "first_id", "h", "lent", (F.col("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")))
    kept = turns.join(plans.select("conv_id", "h", "lent"), "conv_id").where("place > h")
    kept = kept.withColumn("place", F.col("place") - F.col("h") + F.col("lent")).drop("h", "lent")
    # at most LENT - 1 turns for each conversation of the group
    heads = turns.where(F.col("place") < LENT).withColumnRenamed("conv_id", "first_id")
    lent = heads.join(plans.select("conv_id", "first_id", "h"), "first_id").where("place <= h").drop("first_id", "h")
    return plans.select("conv_id", "length"), kept.unionByName(lent)


def prefixes(lengths: DataFrame, turns: DataFrame) -> DataFrame:
    """conv_id, depth, a, b (key of the prefix), up_a, up_b (key of the one above), bytes: for every conversation its prefixes of all depths."""
    digest = F.sha2(F.concat(F.col("place").cast("string"), F.lit(":"), F.col("digest")), 256)
    parts = {p: F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i, p in enumerate(_PARTS)}
    own = turns.withColumns(parts).withColumns({f"own_{p}": F.col(p) for p in _PARTS})
    summed = running(own, "place", ["place"], list(_PARTS))

    def joined(high: Column, low: Column) -> Column:
        return F.shiftleft(F.pmod(high, F.lit(2**32)), 32).bitwiseOR(F.pmod(low, F.lit(2**32)))

    until, above = [F.col(p) for p in _PARTS], [F.col(p) - F.col(f"own_{p}") for p in _PARTS]
    below_root = summed.select(
        "conv_id", F.col("place").alias("depth"), joined(*until[:2]).alias("a"), joined(*until[2:]).alias("b"),
        joined(*above[:2]).alias("up_a"), joined(*above[2:]).alias("up_b"), "bytes")
    none = F.lit(0).cast("long")
    root = lengths.select("conv_id", none.alias("depth"), none.alias("a"), none.alias("b"), none.alias("up_a"), none.alias("up_b"), none.alias("bytes"))
    return root.unionByName(below_root)


def _nodes(members: DataFrame) -> DataFrame:
    """One row per node: its key, the key above, smallest member, members, bytes of its last text, children, parent's smallest member."""
    nodes = saved(members.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        *[F.first(c).alias(c) for c in ("up_a", "up_b", "bytes")]))
    above = [(F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")]
    children = nodes.where("depth > 0").groupBy(*above).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, list(_KEY), "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    return saved(counted.join(parents, ["depth", "up_a", "up_b"], "left"))


def _bands(members: DataFrame) -> DataFrame:
    """conv_id, band, way: the nodes of a conversation within one band, at most ``BAND``, by depth."""
    way = F.sort_array(F.collect_list(F.struct(*_KEY)))
    return members.groupBy("conv_id", F.expr(f"depth div {BAND}").alias("band")).agg(way.alias("way"))


def _summed(rows: DataFrame, node: str) -> DataFrame:
    """Sums by the node in the struct column ``node``."""
    return rows.select(f"{node}.*", *_SUMS).groupBy(*_KEY).agg(*[F.sum(c).cast("long").alias(c) for c in _SUMS])


def subtree_sums(members: DataFrame, values: DataFrame) -> DataFrame:
    """Sums over the subtree of every node.

    ``members``: conv_id, depth, a, b. ``values``: the node's key, conv_id (its smallest member) and the columns to be
    summed. Returns key, conv_id and sums.
    """
    deepest = members.agg(F.max("depth")).first()[0]
    ways = saved(_bands(members))
    owners = values.select(*_KEY, "conv_id")
    placed = values.withColumn("band", F.expr(f"depth div {BAND}")).join(ways, ["conv_id", "band"])
    in_band = placed.select(*_SUMS, F.explode(F.expr("filter(way, x -> x.depth <= depth)")).alias("node"))
    sums = saved(_summed(in_band, "node"))
    if deepest is not None and deepest >= BAND:
        tops = [F.expr(f"depth div {BAND}").alias("depth"), "a", "b"]
        top = F.col("depth") % BAND == 0
        whole = subtree_sums(members.where(top).select("conv_id", *tops), sums.join(owners, list(_KEY)).where(top).select("conv_id", *tops, *_SUMS))
        below = whole.where("depth > 0").withColumn("band", F.col("depth") - 1).drop(*_KEY).join(ways, ["conv_id", "band"])
        handed_up = _summed(below.select(*_SUMS, F.explode("way").alias("node")), "node")
        sums = saved(sums.unionByName(handed_up).groupBy(*_KEY).agg(*[F.sum(c).cast("long").alias(c) for c in _SUMS]))
    return sums.join(owners, list(_KEY))


def trie(lengths: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All nodes with their counts and subtree sums, and the members (conv_id with each of its prefixes' keys)."""
    members = saved(prefixes(lengths, turns))
    nodes = _nodes(members)
    values = nodes.select(
        *_KEY, "conv_id", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"))
    sums = subtree_sums(members.select("conv_id", *_KEY), values)
    return nodes.join(sums.drop("conv_id"), list(_KEY)), members


def ends(lengths: DataFrame, members: DataFrame) -> DataFrame:
    """Key, conv_id: the node at which each conversation ends."""
    return members.join(lengths, "conv_id").where("depth = length").select(*_KEY, "conv_id")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    *key, digests = zip(*rows, strict=True) if rows else ((),) * 4
    columns = [*(pa.array(k, pa.int64()) for k in key), pa.array(digests, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=[*_KEY, "ends_sha256"])


def ends_digest(ended: DataFrame) -> DataFrame:
    """Key, ends_sha256: SHA-256 of the conv_ids that end at a node, in rising order and joined by commas.

    Ids are first joined in pieces of neighbouring ids, each at most 2^PIECE_BITS. A node's pieces then pass its hash
    in order, one after the other, so that a task holds a batch of pieces however many conversations end there.
    """
    pieces = ended.groupBy(*_KEY, F.shiftright("conv_id", PIECE_BITS).alias("piece")).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string"))).alias("ids"))

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, hashlib.sha256()
        for batch in batches:
            done: list[tuple] = []
            for key, part in runs([batch], list(_KEY)):
                if key != now:
                    if now is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(",".join(part.column(part.schema.get_field_index("ids")).to_pylist()).encode())
            yield _digests(done)
        if now is not None:
            yield _digests([(*now, digest.hexdigest())])

    return pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "piece").mapInArrow(hashed, "depth long, a long, b long, ends_sha256 string")


def prefix_nodes(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations; the smallest member and the depth name a node."""
    lengths, turns = rebuilt(saved(numbered_turns(conversations)))
    nodes, members = trie(lengths, turns)
    digests = ends_digest(ends(lengths, members))
    return nodes.join(digests, list(_KEY), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *_SUMS,
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def last_turns(conversations: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes below the root of conversations as they are (not rebuilt), with role and text of their last turn."""
    numbered = running(
        conversations.where("conv_id is not null").select(
            "conv_id", "turn", "role", "text", F.sha2(F.concat(F.octet_length(F.coalesce("role", F.lit(""))).cast("string"), F.lit(":"), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))), 256).alias("digest"),
            F.lit(1).cast("long").alias("depth")),
        "turn", ["turn", "digest"], ["depth"])
    return nodes.join(numbered.select("conv_id", "depth", "role", "text"), ["conv_id", "depth"])
