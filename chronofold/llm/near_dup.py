"""Near duplicates by bottom-k sketches of word shingles, confirmed on the full sets.

Every document becomes the set of hashes of its shingles. Documents of equal sets are one class, of which the smallest
doc_id stands for all. A class's sketch is the ``SKETCH`` smallest hashes of its set. Two sets of
similarity ``SIMILAR`` share about that part of the smallest values of their union; ``LEAST`` is five deviations below
it, and a smaller overlap rules a pair out.

So many values are common to the sketches of a link that some of the rarest ``1 - LEAST`` of each must be among them:
only those go into the inverted lists, and passages that many documents hold seldom do. The pairs of short lists are
all compared. The long lists are worked off in rounds. In each, the pairs of a list that lie in different components are compared by their sketches, which are the sets themselves where those are no larger. The first rounds
deal one list of each class, the longest or the one of the smallest value, into chunks, and pass on a spanning forest
of each chunk's most similar pairs, so they cost no more than their members. For the last one the classes of long lists
get new ones by the rarest values of their full sets, of which a link needs fewer; it passes on every pair of any
list that the sketches allow, where they are found: the sets are brought to the list's chunks. All pairs passed on
are confirmed by the exact Jaccard similarity of the full sets and joined to components. Pairs within a component need
no comparison, so a large group of near copies costs little more than its members. A link of exactly 80 % has sketches
below ``LEAST`` with a probability of 4e-6, a closer one more seldom; no other link between components is lost. The longest lists are dealt out as pairs of chunks.

Null texts, empty ones and those without words have the empty set and are linked with nothing. Rows that repeat a
doc_id count as one document, linked with whatever one of them is linked with; each keeps its own row and n_shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.llm.components import components
from chronofold.llm.kept import dropped
from chronofold.llm.shingles import mixed, shingle_sets
from chronofold.llm.storage import fresh, saved

WIDTH, SIMILAR, SKETCH, LEAST = 4, 80, 64, 0.55
#: Rounds that pass on spanning forests only, the classes of a chunk of a list, and those of a list that is joined
#: with itself at once.
FOREST_ROUNDS, CHUNK, SHORT = 2, 256, 8
#: Bytes of text whose shingles are hashed at once, values that are compared at once, and hashes of the sets that hold them.
_BYTES, _VALUES, _HASHES = 1 << 20, 4096, 1 << 18
_TOP = np.uint64(1 << 63)
_LONGS = pa.list_(pa.int64())


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """The ids and sets of consecutive rows whose texts have about ``_BYTES`` bytes; a longer text comes alone or last."""
    dropped()  # sets need memory of their own
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        piece = (np.cumsum(sizes, dtype=np.int64) - sizes) // _BYTES
        cuts = np.append(np.flatnonzero(np.diff(piece, prepend=-1)), len(sizes)).tolist()
        for at, to in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(at, to - at)
            texts = part.column("text").cast(pa.large_binary()).to_pylist()
            yield part.column("doc_id").cast(pa.int64()), shingle_sets(texts, width)


def _signed(hashes: np.ndarray) -> np.ndarray:
    """Unsigned words as signed ones of the same order."""
    return (hashes ^ _TOP).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate([np.empty(0, np.int64), *map(_signed, arrays)]), type=_LONGS)


def sketches(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, a 128-bit key of the set (null for the empty one) and its sketch, in rising order."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _sets(batches, width):
            sizes = np.array([len(x) for x in sets], dtype=np.int64)
            one = np.array([np.bitwise_xor.reduce(x) if len(x) else 0 for x in sets], dtype=np.uint64).view(np.int64)
            two = np.array([np.add.reduce(mixed(x)) if len(x) else 0 for x in sets], dtype=np.uint64).view(np.int64)
            columns = [ids, pa.array(sizes), pa.array(one, mask=sizes == 0), pa.array(two, mask=sizes == 0), _lists([x[:SKETCH] for x in sets])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "key1", "key2", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(sketch, "doc_id long, n_shingles long, key1 long, key2 long, sketch array<long>")


def inverted_lists(classes: DataFrame, values: str = "sketch", least: Column | None = None) -> DataFrame:
    """(value, node, n): the classes that hold a value among the rarest of their values, for those that several so hold.

    ``least``: how many of a class's ``s`` values a linked one must hold.
    """
    least = F.ceil(F.col("s") * LEAST) if least is None else least
    values = classes.select("node", F.size(values).alias("s"), F.explode(values).alias("value"))
    shared = values.groupBy("value").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    common = values.join(shared, "value").groupBy("node", "s").agg(F.array_sort(F.collect_list(F.struct("held", "value"))).alias("common"))
    # values that no other class holds are the rarest: they use up their part of the places
    places = F.col("s") - least + 1 - (F.col("s") - F.size("common"))
    rare = common.where(places > 0).select("node", F.explode(F.slice("common", F.lit(1), places.cast("int"))).alias("c"))
    lists = rare.select("node", "c.value").distinct()
    several = lists.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return lists.join(several, "value").select("value", "node", "n")


def _held_by_both(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """For each pair of sketches how many values both hold; ``_VALUES`` values that either side has are counted at a time."""
    (x, i), (y, j) = ((np.concatenate(side), np.repeat(np.arange(len(side)), [len(s) for s in side])) for side in (one, other))
    values = np.intersect1d(x, y)
    both = np.zeros((len(one), len(other)), dtype=np.float32)
    for k in range(0, len(values), _VALUES):
        some = values[k : k + _VALUES]
        a, b = (np.zeros((len(side), len(some)), dtype=np.float32) for side in (one, other))
        for matrix, value, row in ((a, x, i), (b, y, j)):
            at = np.searchsorted(some, value)
            held = some[np.minimum(at, len(some) - 1)] == value
            matrix[row[held], at[held]] = 1
        both += a @ b.T
    return both


def _union_estimate(x: np.ndarray, y: np.ndarray) -> float:
    """The part of the smallest values of two sets' union that both hold; x and y are the sets or their sketches, in rising order."""
    x, y = x[:SKETCH], y[:SKETCH]
    union = np.union1d(x, y)[:SKETCH]
    return np.searchsorted(np.intersect1d(x, y, assume_unique=True), union[-1], side="right") / len(union)


def _likeness(one: pd.DataFrame, other: pd.DataFrame, similar: int) -> np.ndarray:
    """No less than the estimate on the union for pairs of classes of different components that may be links, 0 for the others.

    Sketches of both whole sets tell their links from other pairs; else the sizes must allow a link.
    """
    both = _held_by_both(*([np.asarray(x) for x in side["sketch"]] for side in (one, other)))
    n, m = one["n_shingles"].to_numpy()[:, None], other["n_shingles"].to_numpy()[None, :]
    union = np.minimum(n, SKETCH) + np.minimum(m, SKETCH) - both
    apart = one["component"].to_numpy()[:, None] != other["component"].to_numpy()[None, :]
    linked = 100 * both >= similar * (n + m - both)
    sizes = 100 * np.minimum(n, m) >= similar * np.maximum(n, m)
    return np.where(apart & np.where(np.maximum(n, m) <= SKETCH, linked, sizes), both / np.minimum(union, SKETCH), 0.0)


def _near(one: pd.DataFrame, other: pd.DataFrame, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs of the i-th of one side and the j-th of the other the nodes of those whose sketches allow a link."""
    x, y = ([np.asarray(s) for s in side["sketch"]] for side in (one, other))
    near = np.array([_union_estimate(x[p], y[q]) >= LEAST for p, q in zip(i.tolist(), j.tolist(), strict=True)], dtype=bool)
    return one["node"].to_numpy()[i[near]], other["node"].to_numpy()[j[near]]


def _as_pairs(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()


def _spanning_forest(likeness: np.ndarray, component: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a maximum spanning forest of the likenesses from ``LEAST`` on; each component counts as tied already."""
    likeness = np.where(component[:, None] == component[None, :], 2.0, likeness)
    best, near = np.zeros(len(component)), np.zeros(len(component), dtype=np.int64)
    left, pairs = np.ones(len(component), dtype=bool), []
    for _ in component:
        i = int(np.where(left, best, -1.0).argmax())
        if LEAST <= best[i] < 2:
            pairs.append((near[i], i))
        left[i] = False
        better = likeness[i] > best
        best[better], near[better] = likeness[i][better], i
    i, j = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
    return i, j


def _forest_pairs(group: pd.DataFrame, similar: int) -> pd.DataFrame:
    """Fewer pairs than a chunk has classes: those that tie its components together if they are links."""
    group = group.sort_values("node")
    i, j = _spanning_forest(_likeness(group, group, similar), group["component"].to_numpy())
    return _as_pairs(*_near(group, group, i, j))


def _candidates(group: pd.DataFrame, similar: int) -> pd.DataFrame:
    """The classes of a list that make pairs, in different components, whose sketches allow a link: each once, one of a pair with its partners.

    A pair that several lists hold is passed on by the one of the smallest value alone.
    """
    empty = pd.DataFrame({c: pd.Series(dtype="int64") for c in ("value", "low", "high", "node")} | {"partners": pd.Series(dtype="object")})
    if group["component"].nunique() < 2:
        return empty
    low, high = int(group["low"].iloc[0]), int(group["high"].iloc[0])
    group = group.sort_values("node")
    if high < 0:
        one, other = group[~group["main"]], group[group["main"]]
    else:
        one, other = group[group["chunk"] == low], group[group["chunk"] == high]
    if one.empty or other.empty:
        return empty
    allowed = _likeness(one, other, similar) >= LEAST
    value = int(group["value"].iloc[0])
    smaller = [[x[x < value] for x in map(np.asarray, side["lists"])] for side in (one, other)]
    allowed &= _held_by_both(*smaller) == 0
    a, b = _near(one, other, *np.nonzero(allowed))
    if not len(a):
        return empty
    partners = pd.Series(b).groupby(a).agg(list)
    partners = partners.reindex(np.union1d(a, b)).map(lambda x: x if isinstance(x, list) else [])
    return pd.DataFrame({"value": value, "low": low, "high": high, "node": partners.index, "partners": partners.to_numpy()})


def _links_of_group(group: pd.DataFrame, similar: int) -> pd.DataFrame:
    """Of the links among a group's pairs as many as tie together what all of them tie; a node may have several sets."""
    group = group.sort_values("node")
    node, full = group["node"].to_numpy(), [np.asarray(x) for x in group["full"]]
    partner = np.concatenate([np.empty(0, np.int64), *map(np.asarray, group["partners"])]).astype(np.int64)
    low, high = np.searchsorted(node, partner, side="left"), np.searchsorted(node, partner, side="right")
    i = np.repeat(np.repeat(np.arange(len(node)), [len(x) for x in group["partners"]]), high - low)
    j = np.repeat(low - (np.cumsum(high - low) - (high - low)), high - low) + np.arange(len(i))
    sizes = np.array([len(x) for x in full], dtype=np.int64)
    first, at = np.unique(i, return_inverse=True)
    second, to = np.unique(j, return_inverse=True)
    if 8 * len(i) < len(first) * len(second):
        both = np.array([len(np.intersect1d(full[p], full[q], assume_unique=True)) for p, q in zip(i.tolist(), j.tolist(), strict=True)], dtype=np.int64)
    else:
        held = np.zeros((len(first), len(second)))
        for rows in _runs(sizes[first]):
            for columns in _runs(sizes[second]):
                held[rows, columns] = _held_by_both([full[k] for k in first[rows]], [full[k] for k in second[columns]])
        both = held[at, to].astype(np.int64)
    linked = 100 * both >= similar * (sizes[i] + sizes[j] - both)
    likeness = np.zeros((len(node), len(node)))
    likeness[i[linked], j[linked]] = likeness[j[linked], i[linked]] = 1.0
    a, b = _spanning_forest(likeness, np.arange(len(node)))
    return _as_pairs(node[a], node[b])


def _runs(sizes: np.ndarray) -> list[slice]:
    """Consecutive sets of about ``_HASHES`` hashes together; a larger set comes alone or last."""
    cuts = np.append(np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // _HASHES, prepend=-1)), len(sizes)).tolist()
    return [slice(x, y) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]


def _in_chunks(members: DataFrame, round_: int) -> DataFrame:
    """The members of the lists that hold several components, each in one chunk of its list; another round deals them otherwise."""
    parts = members.groupBy("value").agg(F.count(F.lit(1)).alias("k"), F.min("component").alias("least"), F.max("component").alias("most"))
    parts = parts.where("least < most").select("value", F.ceil(F.col("k") / CHUNK).alias("chunks"))
    chunk = F.pmod(F.xxhash64("node", F.lit(round_)), F.col("chunks")).alias("chunk")
    return members.join(parts, "value").select("value", "node", "component", chunk)


def _dealt(members: DataFrame) -> DataFrame:
    """The members of the lists that hold several components, dealt so that all such pairs meet once.

    The members of a list's largest component need not meet one another: their chunks meet only those of the others,
    as groups (chunk, -1 - chunk of the others). The others also meet among themselves, as pairs of chunks of their own.
    No group holds more than two chunks. Further columns of the members go with them.
    """
    carried = [c for c in members.columns if c not in ("value", "node", "component")]
    parts = members.groupBy("value", "component").agg(F.count(F.lit(1)).alias("k"))
    parts = parts.groupBy("value").agg(F.max(F.struct("k", "component")).alias("largest"), F.sum("k").alias("all"))
    parts = parts.where(F.col("all") > F.col("largest.k"))
    members = members.join(parts, "value").withColumn("main", F.col("component") == F.col("largest.component"))
    mains, others = (F.ceil(k / CHUNK).cast("int") for k in (F.col("largest.k"), F.col("all") - F.col("largest.k")))
    place = F.xxhash64("node")
    members = members.withColumn("chunk", F.when(F.col("main"), F.pmod(place, mains)).otherwise(F.pmod(place, others)).cast("int"))
    with_main = F.transform(F.sequence(F.lit(0), mains - 1), lambda c: F.struct(c.alias("low"), (-1 - F.col("chunk")).alias("high")))
    among = F.transform(F.sequence(F.lit(0), others - 1), lambda c: F.struct(F.least("chunk", c).alias("low"), F.greatest("chunk", c).alias("high")))
    with_others = F.transform(F.sequence(F.lit(0), others - 1), lambda c: F.struct(F.col("chunk").alias("low"), (-1 - c).alias("high")))
    meets = F.when(F.col("main"), with_others).otherwise(F.concat(with_main, among))
    return members.withColumn("meet", F.explode(meets)).select("value", "node", "component", "main", "chunk", "meet.low", "meet.high", *carried)


def _confirmed(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs of which 100 |a and b| >= similar |a or b|."""
    first, second = (sets.select(F.col("node").alias(k), F.col("full").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", (F.size("x") + F.size("y")).alias("sizes"), F.size(F.array_intersect("x", "y")).alias("both"))
    return both.where(100 * F.col("both") >= similar * (F.col("sizes") - F.col("both"))).select("a", "b")


def near_duplicates(docs: DataFrame, width: int = WIDTH, similar: int = SIMILAR) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    rows = saved(sketches(docs, width))
    known = rows.where("key1 is not null and doc_id is not null")
    classes = saved(known.groupBy("key1", "key2", "n_shingles").agg(F.min("doc_id").alias("node"), F.first("sketch").alias("sketch")))
    # a doc_id of several rows ties their classes together
    tied = known.join(classes.drop("sketch"), ["key1", "key2", "n_shingles"]).where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    # two classes may have the same doc_id as their least: the set's size tells them apart within the search
    lists = saved(inverted_lists(classes.where(F.size("sketch") > 0)))
    links = tied.distinct()
    if not lists.isEmpty():
        links = links.unionByName(_links(docs, lists, classes, width, similar))
    found = components(links)
    out = rows.select("doc_id", "n_shingles").join(found, F.col("doc_id") == F.col("node"), "left")
    out = out.withColumn("component_id", F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _links(docs: DataFrame, lists: DataFrame, classes: DataFrame, width: int, similar: int) -> DataFrame:
    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _sets(batches, width):
            yield pa.RecordBatch.from_arrays([ids, _lists(sets)], names=["node", "full"])

    nodes = saved(lists.select("node").distinct())
    wanted = docs.select("doc_id", "text").join(nodes, F.col("doc_id") == F.col("node"), "left_semi")
    sets = saved(wanted.mapInArrow(full, "node long, full array<long>"))
    held = saved(nodes.join(classes.select("node", "sketch", "n_shingles"), "node"))
    state = nodes.select("node", F.col("node").alias("component"))
    tested = saved(_short_lists(lists.where(F.col("n") <= SHORT), held))
    links = saved(_confirmed(tested, sets, similar))
    lists = lists.where(F.col("n") > SHORT)
    if lists.isEmpty():
        return links
    of_node = lists.groupBy("node").agg(F.sort_array(F.collect_list("value")).alias("lists"), F.max(F.struct("n", "value")).alias("longest"))
    of_node = saved(of_node.join(held, "node"))
    held = of_node.drop("longest")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for round_ in range(FOREST_ROUNDS):
        # a group's members meet in the longest list of each, or else in that of the smallest value
        members = of_node.select(F.col("lists")[0].alias("value") if round_ % 2 else F.col("longest.value"), "node").join(state, "node")
        dealt = _in_chunks(members, round_).join(held.drop("lists"), "node").repartition(parts, "value", "chunk")  # little data, much work
        pairs = dealt.groupBy("value", "chunk").applyInPandas(lambda group: _forest_pairs(group, similar), "a long, b long").distinct()
        pairs = saved(pairs.join(tested, ["a", "b"], "left_anti"))
        tested = tested.unionByName(pairs)
        links = links.unionByName(saved(_confirmed(pairs, sets, similar)))
        found = components(links)
        state = saved(nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component")))
    # links hold more of each other's full sets than of the sketches, so their rarest values are fewer and the lists shorter
    least = F.expr(f"(s * {similar} + 99) div 100")
    lists = saved(inverted_lists(sets.join(of_node.select("node"), "node", "left_semi"), "full", least))
    pairs = saved(_short_lists(lists.where(F.col("n") <= SHORT), held).join(tested, ["a", "b"], "left_anti"))
    links = links.unionByName(saved(_confirmed(pairs, sets, similar)))
    lists = lists.where(F.col("n") > SHORT)
    held = saved(held.drop("lists").join(lists.groupBy("node").agg(F.sort_array(F.collect_list("value")).alias("lists")), "node"))
    # a set is brought once to a group, not once to each of its pairs
    by = ["value", "low", "high"]
    # a member's row is put together before it is dealt to several groups
    dealt = _dealt(lists.select("value", "node").join(held.join(state, "node"), "node")).repartition(parts, *by)
    ends = dealt.groupBy(*by).applyInPandas(lambda group: _candidates(group, similar), "value long, low int, high int, node long, partners array<long>")
    ends = saved(ends).join(sets, "node").repartition(parts, *by)
    return links.unionByName(saved(ends.groupBy(*by).applyInPandas(lambda group: _links_of_group(group, similar), "a long, b long")))


def _short_lists(lists: DataFrame, held: DataFrame) -> DataFrame:
    """The pairs of each list's classes whose sketches allow a link; a pair holds at most SKETCH values of a union."""
    other = lists.select("value", F.col("node").alias("b"))
    pairs = lists.select("value", F.col("node").alias("a")).join(other, "value").where("a < b").select("a", "b").distinct()
    first, second = (held.select(F.col("node").alias(k), F.col("sketch").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    pairs = pairs.join(first, "a").join(second, "b")
    union = F.slice(F.array_sort(F.array_union("x", "y")), 1, SKETCH)
    estimate = F.size(F.array_intersect(union, F.array_intersect("x", "y"))) / F.size(union)
    return pairs.where(estimate >= LEAST).select("a", "b")


def without_near_copies(docs: DataFrame, width: int = WIDTH, similar: int = SIMILAR) -> DataFrame:
    """The rows of one document of each component, the one of the smallest doc_id; of rows that repeat it, one.

    Rows of null doc_id have no place in that order: they are compared with nothing, and every one of them stays.
    """
    name = fresh(docs, "__kept")
    kept = near_duplicates(docs, width, similar).where("kept and doc_id is not null").select(F.col("doc_id").alias(name)).distinct()
    named = docs.join(kept, F.col("doc_id") == F.col(name), "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.where("doc_id is null"))
