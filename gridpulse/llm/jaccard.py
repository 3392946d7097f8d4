"""N-gram Jaccard self-join: a MinHash LSH forest, its prefixes shortened until the target recall, and exact verification.

1. Every text becomes its set of five-word shingles (64-bit hashes). Texts with the same set are one class. A class has one label a tree:
   ``LEVELS`` one-byte MinHash values in a long, so that the first d values are the label shifted right.
2. The labels, sorted by (tree, label), are prefix tries. Branches that hold one class down to the shortest prefix are cut away first.
3. Matching starts at the whole label. While two sets of the asked similarity meet in some tree with less than ``recall``, the prefixes lose a
   level, and only nodes that join classes not yet joined are followed. Classes that meet form candidate groups (smallest labels, sums per
   node, never pairs). Sets too small to have a different neighbour at that similarity stay out.
4. A candidate group of up to ``block`` classes is compared whole. A larger one is cut into blocks, classes that share a long prefix together,
   and only blocks that meet in a node of the trie are compared, each pair of blocks as a task of its own. A text is sent once for each
   block it is compared with: in a dense group, where every pair has to be counted, that is members / ``block`` times.

Verification is exact: shared shingles are counted by posting lists, long lists as a matrix product. It sends back a number of links for each
class and a spanning forest of the links, not the pairs. Every link between different texts that met in the forest is counted; copies share
their class's links.

Cases: null and empty texts and texts without a word have no shingles and link to nothing, not even to each other; texts of fewer than five
words are one shingle; repeated rows are copies and link to each other; a row with a null id gets the class of its text but is no link of
others; of rows that share an id but not a text the smallest text stands for the id; a similarity equal to the threshold is a link. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import WORD, WordHashes, connected, mix, shingles
from gridpulse.scratch import materialize


#: Values of a label; each is a byte of a long.
LEVELS = 8


def met_share(similarity: float, depth: int, trees: int) -> float:
    """The probability that two sets of that similarity share a prefix of that depth in some tree."""
    return 1 - (1 - similarity ** depth) ** trees


def forest_depth(similarity: float, trees: int, recall: float, longest: int = LEVELS) -> int:
    """The longest prefix at which a pair of that similarity still shares a node of some tree with probability ``recall``."""
    return next((d for d in range(longest, 1, -1) if met_share(similarity, d, trees) >= recall), 1)


def _sets(text: str | None, hashes: WordHashes, k: int) -> np.ndarray:
    return np.unique(shingles(hashes.of(WORD.findall(text.lower())), k)) if text else np.empty(0, np.uint64)


def _signature(found: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The smallest value of each of the hash functions over the set; a few thousand shingles at a time."""
    x = (found >> np.uint64(32)).astype(np.uint32) ^ found.astype(np.uint32)
    best = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        values = np.multiply.outer(factors, x[at: at + 1024])
        values += offsets[:, None]
        np.minimum(best, values.min(axis=1), out=best)
    return best


def signatures(docs: DataFrame, id_column: str, text_column: str, k: int, trees: int, seed: int = 11) -> DataFrame:
    """id, n (shingles), same (hash of the set), labels (one for each tree; none for an empty set)."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 2 ** 32, trees * LEVELS, np.uint32) | np.uint32(1)
    offsets = rng.integers(0, 2 ** 32, trees * LEVELS, np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            n, same, labels = [], [], []
            for text in batch.column("text"):
                found = _sets(text.as_py(), hashes, k)
                n.append(len(found))
                if not len(found):
                    same.append(None)
                    labels.append([])
                    continue
                both = mix(found)
                same.append((int(found.sum(dtype=np.uint64)) << 64 | int(both.sum(dtype=np.uint64))).to_bytes(16, "big") + len(found).to_bytes(8, "big"))
                values = _signature(found, factors, offsets) * np.uint32(0x9E3779B1) >> np.uint32(24)
                labels.append(values.astype(np.uint8).reshape(trees, LEVELS).view(">i8").ravel().astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(same, pa.binary()),
                                              pa.array(labels, pa.list_(pa.int64()))], names=["id", "n", "same", "labels"])

    frame = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return frame.mapInArrow(run, "id long, n long, same binary, labels array<long>")


def _prefix(depth: int) -> Column:
    return F.shiftright("label", 8 * (LEVELS - depth))


def tries(classes: DataFrame, depth: int, similarity: float) -> DataFrame:
    """tree, label, cls in the order of the labels: all branches that still hold two classes at ``depth``."""
    # No set but its own copies is that similar to a very small one.
    able = classes.where(F.col("n") >= similarity * (F.col("n") + 1) - 1e-9)
    met = able.select("cls", F.posexplode("labels").alias("tree", "label")).withColumn("node", _prefix(depth))
    branches = met.groupBy("tree", "node").agg(F.count("*").alias("members")).where("members > 1").select("tree", "node")
    return materialize(met.join(branches, ["tree", "node"]).select("tree", "label", "cls")
                       .repartitionByRange("tree", "label", "cls").sortWithinPartitions("tree", "label", "cls"), "tries")


def candidates(forest: DataFrame, similarity: float, trees: int, recall: float) -> tuple[DataFrame, int]:
    """cls, deep (its group at the whole label), grp (its group at the depth that has the target recall); and that depth.

    Each level joins only groups that the level above left apart.
    """
    groups = forest.select("cls").distinct().select("cls", F.col("cls").alias("grp"))
    depth, deep = LEVELS, None
    while True:
        at = forest.select("cls", "tree", _prefix(depth).alias("node")).join(groups, "cls")
        joins = at.groupBy("tree", "node").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).where("low < high").select("tree", "node", "low")
        edges = materialize(at.join(joins, ["tree", "node"]).where("grp <> low").select("grp", "low").distinct(), "edges")
        if edges.limit(1).count():
            moved = connected(edges, "grp", "low", "to", "grp")
            groups = materialize(groups.join(moved, "grp", "left").select("cls", F.coalesce("to", "grp").alias("grp")), "groups")
        if deep is None:
            deep = groups.withColumnRenamed("grp", "deep")
        if depth == 1 or met_share(similarity, depth, trees) >= recall:
            return materialize(groups.join(deep, "cls"), "groups"), depth
        depth -= 1


def _tasks_of(groups: DataFrame, classes: DataFrame, forest: DataFrame, depth: int, block: int, block_shingles: int) -> DataFrame:
    """cls, copies, grp, i, j, side, key: each class once for each pair of blocks that it is compared in; one key is one task."""
    load = F.greatest(F.col("members") / block, F.col("shingles") / block_shingles)
    held = groups.join(classes.select("cls", "n", "copies"), "cls")
    deep = held.groupBy("grp", "deep").agg(F.count("*").alias("members"), F.sum("n").alias("shingles")).withColumn("part", load)
    whole = (deep.groupBy("grp").agg(F.sum("members").alias("members"), F.sum("shingles").alias("shingles"),
                                     F.sum(F.when(F.col("part") <= 0.5, F.col("part")).otherwise(0)).alias("shared")).withColumn("load", load))
    whole = materialize(whole.select("grp", "load", "shared"), "loads")
    # A long prefix with many classes has blocks of its own, others share some.
    own = F.xxhash64("grp", "deep", F.pmod(F.xxhash64("cls"), F.ceil("part")))
    rest = F.xxhash64("grp", F.pmod(F.xxhash64("deep"), F.greatest(F.ceil("shared"), F.lit(1))))
    large = materialize(held.join(deep.select("deep", "part"), "deep").join(whole.where("load > 1"), "grp")
                        .select("cls", "copies", "grp", F.when(F.col("part") > 0.5, own).otherwise(rest).alias("block")), "blocks")
    meet = (forest.select("cls", "tree", _prefix(depth).alias("node")).join(large.select("cls", "grp", "block"), "cls")
            .groupBy("tree", "node", "grp").agg(F.collect_set("block").alias("blocks")))
    pairs = (meet.select("grp", F.explode("blocks").alias("i"), "blocks").select("grp", "i", F.explode("blocks").alias("j"))
             .where("i <= j").distinct())
    sides = F.when(F.col("i") == F.col("j"), F.array(F.struct(F.col("i").alias("block"), F.lit(2).alias("side")))).otherwise(
        F.array(F.struct(F.col("i").alias("block"), F.lit(0).alias("side")), F.struct(F.col("j").alias("block"), F.lit(1).alias("side"))))
    dealt = (large.join(pairs.select("grp", "i", "j", F.explode(sides).alias("s")).select("grp", "i", "j", "s.*"), ["grp", "block"])
             .select("cls", "copies", "grp", "i", "j", "side", F.xxhash64("grp", "i", "j").alias("key")))
    # Many small groups share a task, about a quarter of a block of classes.
    tasks = max(1, math.ceil(4 * (whole.where("load <= 1").agg(F.sum("load")).first()[0] or 0)))
    zero = F.lit(0).cast("long")
    small = (held.join(whole.where("load <= 1"), "grp")
             .select("cls", "copies", "grp", zero.alias("i"), zero.alias("j"), F.lit(2).alias("side"), F.pmod(F.xxhash64("grp"), F.lit(tasks)).alias("key")))
    return small.unionByName(dealt)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def linked(left: list[np.ndarray], right: list[np.ndarray] | None, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs with at least that Jaccard similarity: between left and right, or within left where right is None."""
    sets = left + (right or [])
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    starts = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]]) if len(flat) else np.empty(0, int)
    lens = np.diff(np.append(starts, len(flat)))
    n_left = len(left)
    shared = np.zeros((n_left, len(sets)), np.int32)
    # Shingles with the same posting list are added up together: copies of a passage cost one list.
    lists: dict[bytes, int] = {}
    for s, n in zip(starts[lens > 1], lens[lens > 1]):
        key = owner[s: s + n].astype(np.int32).tobytes()
        lists[key] = lists.get(key, 0) + 1
    wide = []
    for key, times in lists.items():
        who = np.frombuffer(key, np.int32)
        rows = who[who < n_left]
        if len(who) > 24 and len(rows):
            wide.append((who, times))
        elif len(rows):
            shared[np.ix_(rows, who)] += times
    for at in range(0, len(wide), 256):
        part = wide[at: at + 256]
        marks = np.zeros((len(sets), len(part)), np.float32)
        for i, (who, _) in enumerate(part):
            marks[who, i] = 1
        shared += ((marks[:n_left] * np.array([t for _, t in part], np.float32)) @ marks.T).astype(np.int32)
    union = sizes[:n_left, None] + sizes[None, :] - shared
    good = shared >= similarity * union
    if right is None:
        good = np.triu(good, 1)
    else:
        good = good[:, n_left:]
    a, b = np.nonzero(good & (shared[:, : good.shape[1]] > 0 if right is None else shared[:, n_left:] > 0))
    return a, b


def _verify(frame: pd.DataFrame, sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links, linked documents and smallest reached class of the rows of one task. Side 2 is compared with itself, side 0 with side 1."""
    n, sizes, side = len(frame), frame["copies"].to_numpy(), frame["side"].to_numpy()
    links, linked_docs, root = np.zeros(n, np.int64), np.zeros(n), np.arange(n)
    for at in frame.reset_index(drop=True).groupby(["grp", "i", "j"]).indices.values():
        left, right = at[side[at] != 1], at[side[at] == 1]
        within = len(left) > 0 and side[left[0]] == 2
        a, b = linked([sets[i] for i in left], None if within else [sets[i] for i in right], similarity)
        a, b = left[a], (left if within else right)[b]
        links += np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
        linked_docs += np.bincount(a, sizes[b], n) + np.bincount(b, sizes[a], n)
        local = np.zeros(n, np.int64)
        local[at] = np.arange(len(at))
        root[at] = at[_roots(len(at), local[a], local[b])]
    return links, linked_docs.astype(np.int64), frame["cls"].to_numpy()[root]


def join(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = 5, similarity: float = 0.8, trees: int = 24,
         recall: float = 0.999, block: int = 1024, block_shingles: int = 2_000_000) -> DataFrame:
    """One row for each document: doc_id, copy_of (the class of texts with its shingle set: their smallest id), class_id (the smallest id
    that its links reach), n_links (other documents with at least that similarity, its copies included), n_texts (linked classes)."""
    rows = materialize(signatures(docs, id_column, text_column, k, trees), "signatures")
    classes = materialize(rows.where("same is not null and id is not null").groupBy("same", "n", "labels")
                          .agg(F.min("id").alias("cls"), F.count("*").alias("copies")), "classes")
    forest = tries(classes, forest_depth(similarity, trees, recall), similarity)
    groups, depth = candidates(forest, similarity, trees, recall)
    placed = _tasks_of(groups, classes, forest, depth, block, block_shingles)
    texts = docs.select(F.col(id_column).cast("long").alias("cls"), F.col(text_column).alias("text")).where("text is not null")
    one = placed.join(texts, "cls")

    def verify(frame: pd.DataFrame) -> pd.DataFrame:
        # A repeated id has one text here: the smallest.
        frame = frame.sort_values(["grp", "i", "j", "cls", "text"]).drop_duplicates(["grp", "i", "j", "cls"])
        hashes = WordHashes()
        sets = [_sets(t, hashes, k) for t in frame["text"]]
        links, linked_docs, root = _verify(frame, sets, similarity)
        return pd.DataFrame({"cls": frame["cls"].to_numpy(), "links": links, "linked_docs": linked_docs, "root": root})

    found = materialize(one.groupBy("key").applyInPandas(
        verify, "cls long, links long, linked_docs long, root long"), "links")
    counts = found.groupBy("cls").agg(F.sum("links").alias("links"), F.sum("linked_docs").alias("linked_docs"))
    roots = connected(found.where("cls <> root").select("cls", "root"), "cls", "root", "root", "cls")
    per_class = (classes.select("same", "cls", "copies").join(counts, "cls", "left").join(roots, "cls", "left")
                 .select("same", "cls", "copies", "links", "linked_docs", "root"))
    return rows.select("id", "same").join(per_class, "same", "left").select(
        F.col("id").alias("doc_id"), F.coalesce("cls", "id").alias("copy_of"), F.coalesce("root", "cls", "id").alias("class_id"),
        F.when(F.col("cls").isNull(), 0).otherwise(F.coalesce("linked_docs", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_texts"))

