"""Near-duplicate groups by bottom-k sketches of one hash function.

1. Every text becomes the set of its hashed word shingles; equal sets collapse to one class at once, so copies are
   never paired.
2. A class keeps its ``k`` smallest hashes.  Inverted lists of the retained values generate overlaps: classes
   whose sketches share enough values must share one of their rarest few (prefix filter), so only these
   are listed, and lists of one class end here.
3. Classes connected through lists form candidate groups, found by contracting links between a list's members and its
   first one.  No pair is emitted.
4. A group's members meet with sketch and full set in one task (large groups in pairs of blocks).  A search from
   member to member counts overlaps through inverted lists of the retained values, drops what the union-sketch
   estimate rules out, confirms the rest on the full sets and takes linked members out of the lists,
   so a group of n copies costs about n steps.  Only a spanning forest of links leaves the task.
5. Components of the confirmed links give every document its smallest reachable id.

The sketch filter's limits lie five standard deviations below the wanted similarity, so a true link is lost with a
chance of less than one in a million; sets smaller than the sketch are handled exactly.  Hashes have 64 bits.

Defined cases: null text counts as empty; a text without words has an empty set, links with nothing and is its own
component; a text with fewer words than a shingle is one shingle; null ids are never the smallest id of a
component that has others; rows that repeat an id are rows of the result of ``near_duplicates``, and ``keep_one_of_each`` keeps one
row of a group, whatever ids repeat; an empty table gives no rows; other columns are ignored by ``near_duplicates`` and
kept by ``keep_one_of_each``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardsmith.llm.common import fresh, prepare, shuffle_partitions
from boardsmith.llm.tokens import Generations
from boardsmith.session import materialize

SKETCH = 32
LIST_ROWS = 4_096  # classes of one inverted list that one task compares
GROUP_HASHES = 4_000_000  # hashes of full sets that one task holds of a group before the group is cut into blocks
WORD_CACHE = 300_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingles:
    def __init__(self, width: int):
        self.width, self.words = width, Generations(xxhash.xxh3_64_intdigest, WORD_CACHE)

    def __call__(self, text: bytes) -> np.ndarray:
        """Sorted distinct hashes of the word shingles of a text."""
        words = text.lower().split()  # bytes: only A-Z change, only space and \x09-\x0D separate
        if not words:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        self.words.trim()
        n = max(1, len(h) - self.width + 1)
        out = np.full(n, min(len(h), self.width), np.uint64)
        for i in range(min(len(h), self.width)):
            out = mixed(out * _A + h[i:i + n] + _B)
        return np.unique(out)


def _class_of(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _sketches(width: int, k: int):
    def run(batches):
        shingles = Shingles(width)
        for b in batches:
            n, sid, sketch = [], [], []
            for t in b.column(1).cast(pa.binary()):
                s = shingles(t.as_py() or b"")
                n.append(len(s))
                sid.append(_class_of(s) if len(s) else None)
                sketch.append(s[:k].view(np.int64))
            flat = pa.array(np.concatenate(sketch) if sketch else np.zeros(0, np.int64))
            offsets = pa.array(np.cumsum([0, *map(len, sketch)]), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(sid, pa.binary()), pa.ListArray.from_arrays(offsets, flat)],
                                             ["doc_id", "digest", "n_shingles", "sid", "sketch"])

    return run


def _least_share(similarity: float, k: int) -> float:
    """Share of a sketch that two linked sets have in common, but for a chance of five standard deviations."""
    return max(0.05, similarity - 5 * math.sqrt(similarity * (1 - similarity) / k))


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the smallest node reachable.

    Each round maps every node to the first of its neighbourhood (itself included) in a random order of that round,
    then contracts the links by that map, so a round reads only the links between what is still apart.  Half of a
    chain is expected to go in each round, more of denser graphs, whatever the order of the nodes.  The maps are then
    followed back from the last one.  Links and maps stay distributed, and every round is written.
    """
    # Written first: both directions must come from one evaluation, as two may find different links of a group.
    links = materialize(links.select("a", "b").where("a != b").distinct(), f"{name}-links")
    maps: list[DataFrame] = []
    while not maps or not links.isEmpty():

        def ranked(node: str, seed: int = len(maps)):
            return F.struct(F.xxhash64(node, F.lit(seed)).alias("h"), F.col(node).alias("node"))

        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(ranked("b")).alias("m"))
        to = materialize(first.select(F.col("a").alias("node"), F.least("m", ranked("a"))["node"].alias("to")), f"{name}-map")
        ends = links.join(to.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(to.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        links = materialize(ends.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), f"{name}-left")
        maps.append(to)
    tops = maps.pop()
    while maps:
        above = tops.select(F.col("node").alias("to"), F.col("to").alias("top"))
        tops = materialize(maps.pop().join(above, "to", "left").select("node", F.coalesce("top", "to").alias("to")), f"{name}-tops")
    labels = tops.groupBy("to").agg(F.min("node").alias("label"))
    return materialize(tops.join(labels, "to").select("node", "label"), f"{name}-labels")


def _forest(similarity: tuple[int, int], least: float, k: int):
    """Confirmed links within one group (or between two blocks of it), enough of them to keep it connected."""
    num, den = similarity

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("sid")  # the order of arrival differs from run to run
        sids = group["sid"].to_list()
        sets = [np.frombuffer(x, np.uint64) for x in group["full"]]
        size = np.array([len(s) for s in sets])
        sketch = [s[:k] for s in sets]
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sketch])
        order = np.argsort(np.concatenate(sketch), kind="stable")
        values, owner = np.concatenate(sketch)[order], owner[order]
        waiting, unlinked, listed = np.ones(len(sets), bool), len(sets), len(sets)
        links = []
        for seed in range(len(sets)):
            if not waiting[seed]:
                continue
            waiting[seed], unlinked = False, unlinked - 1
            todo = [seed]
            while todo and unlinked:
                i = todo.pop()
                if unlinked * 2 < listed:  # linked members leave the lists
                    left = waiting[owner]
                    values, owner, listed = values[left], owner[left], unlinked
                a, b = np.searchsorted(values, sketch[i]), np.searchsorted(values, sketch[i], side="right")
                near, shared = np.unique(np.concatenate([owner[x:y] for x, y in zip(a, b, strict=True)]), return_counts=True)
                larger = np.maximum(size[near], size[i])
                ok = waiting[near] & (den * np.minimum(size[near], size[i]) >= num * larger) & (shared >= np.floor(least * np.minimum(k, larger)))
                for j in near[ok].tolist():
                    if not _estimate(sketch[i], sketch[j], k, least):
                        continue
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if den * both >= num * (size[i] + size[j] - both):
                        waiting[j], unlinked = False, unlinked - 1
                        todo.append(j)
                        links.append((sids[i], sids[j]))
        return pd.DataFrame(links, columns=["a", "b"])

    return run


def _agreeing(least: float, k: int):
    """Rows (value, node, sketch) sorted by value to links (a, b) of nodes that share a list and whose sketches agree, enough of
    them to keep connected what agrees."""

    def tree(nodes: list[int], sketches: list[np.ndarray]):
        size = np.array([len(s) for s in sketches])
        owner = np.repeat(np.arange(len(nodes)), size)
        values = np.concatenate(sketches)
        order = np.argsort(values, kind="stable")
        values, owner, waiting = values[order], owner[order], np.ones(len(nodes), bool)
        for seed in range(len(nodes)):
            if not waiting[seed]:
                continue
            waiting[seed], todo = False, [seed]
            while todo:
                i = todo.pop()
                a, b = np.searchsorted(values, sketches[i]), np.searchsorted(values, sketches[i], side="right")
                near, shared = np.unique(np.concatenate([owner[x:y] for x, y in zip(a, b, strict=True)]), return_counts=True)
                for j in near[waiting[near] & (shared >= np.floor(least * np.maximum(size[near], size[i])))].tolist():
                    if _estimate(sketches[i], sketches[j], k, least):
                        waiting[j] = False
                        todo.append(j)
                        yield nodes[i], nodes[j]

    def run(batches):
        value, nodes, sketches = None, [], []

        def links():
            if len(nodes) == 2:
                return [tuple(nodes)] if _estimate(*sketches, k, least) else []
            return list(tree(nodes, sketches)) if len(nodes) > 2 else []

        def rows(out):
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], ["a", "b"])

        for batch in batches:
            out = []
            flat, at = batch.column(2).values.to_numpy().view(np.uint64), batch.column(2).offsets.to_numpy()
            for i, (v, node) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if v != value:
                    out += links()
                    value, nodes, sketches = v, [], []
                nodes.append(node)
                sketches.append(flat[at[i]:at[i + 1]])
            yield rows(out)
        yield rows(links())

    return run


def _estimate(a: np.ndarray, b: np.ndarray, k: int, least: float) -> bool:
    """Whether the k smallest values of the union have a large enough share in both sketches."""
    union = np.union1d(a, b)[:k]
    both = np.intersect1d(a, b, assume_unique=True)
    return np.searchsorted(both, union[-1], side="right") >= math.floor(least * len(union))


def _full_sets(width: int):
    """Rows (sid, members' group and blocks, text) to (sid, ..., full set)."""

    def run(batches):
        shingles = Shingles(width)
        for b in batches:
            full, keep = [], []
            for t, sid in zip(b.column("text").cast(pa.binary()), b.column("sid"), strict=True):
                s = shingles(t.as_py() or b"")
                same = len(s) > 0 and _class_of(s) == sid.as_py()
                keep.append(same)
                full.append(s.tobytes() if same else b"")
            out = pa.RecordBatch.from_arrays([b.column("sid"), b.column("label"), pa.array(full, pa.binary())], ["sid", "label", "full"])
            yield out.filter(pa.array(keep, pa.bool_()))

    return run


def near_duplicates(docs: DataFrame, width: int = 5, similarity: tuple[int, int] = (4, 5), k: int = SKETCH, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; ``similarity`` is a fraction, linked at or above it."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = rows.withColumn("digest", F.xxhash64("text"))
    sketched = materialize(rows.mapInArrow(_sketches(width, k), "doc_id bigint, digest bigint, n_shingles bigint, sid binary, sketch array<bigint>"), "sketches")
    wanted = similarity[0] / similarity[1]
    least = _least_share(wanted, k)

    # Classes of equal sets, each with its smallest id; copies meet in the map side of this aggregation.
    one = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest"))
    classes = sketched.where("sid IS NOT NULL").groupBy("sid").agg(one.alias("one"), F.first("sketch").alias("sketch"))
    classes = materialize(classes.select("sid", F.col("one.doc_id").alias("first"), F.col("one.digest").alias("digest"), "sketch"), "classes")

    # Inverted lists: the rarest retained values of each class, of which linked classes share at least one.
    node = F.xxhash64("sid")
    listed = classes.select(node.alias("node"), F.size("sketch").alias("m"), F.explode("sketch").alias("value"))
    df = listed.groupBy("value").agg(F.count(F.lit(1)).alias("df"))
    rare = listed.join(df, "value").where(F.col("df") > 1)
    # Values of one class alone are not joined back as rows, but they are the rarest: the others rank after them.
    shared = rare.groupBy("node").agg(F.max("m").alias("m"), F.array_sort(F.collect_list(F.struct("df", "value"))).alias("v"))
    reach = F.col("m") - F.ceil(F.col("m") * F.lit(least)) + 1 - (F.col("m") - F.size("v"))
    lists = shared.where(reach > 0).select("node", F.explode(F.slice("v", 1, reach.cast("int"))).alias("e")).select("node", F.col("e.value").alias("value"))
    lists = materialize(lists, "lists")
    # Inside a list only classes whose sketches agree are joined, so groups do not grow through single shared values.  A list
    # too long for that is joined whole: a group may be larger than needed, as its links are confirmed later.
    heads = materialize(lists.groupBy("value").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1"), "heads")
    short = lists.join(heads.where(F.col("n") <= LIST_ROWS).select("value"), "value").join(classes.select(node.alias("node"), "sketch"), "node")
    short = short.repartition(shuffle_partitions(spark), "value").sortWithinPartitions("value", "node").select("value", "node", "sketch")
    joined = short.mapInArrow(_agreeing(least, k), "a bigint, b bigint")
    whole = lists.join(heads.where(F.col("n") > LIST_ROWS), "value").select(F.col("node").alias("a"), F.col("head").alias("b"))
    groups = components(joined.unionByName(whole), "groups")

    # Full sets of the candidates, from one document of each class.
    members = classes.withColumn("node", node).join(groups, "node").select("sid", "label", "first", "digest")
    # By id and text: rows that repeat an id, or have none, meet only the classes of their own text.
    absent = F.lit(-(2**63))
    held = rows.withColumn("first", F.coalesce("doc_id", absent)).join(members.withColumn("first", F.coalesce("first", absent)), ["first", "digest"])
    full = held.select("sid", "label", "text").mapInArrow(_full_sets(width), "sid binary, label bigint, full binary").dropDuplicates(["sid"])
    full = materialize(full, "full-sets")

    links = _links(full, similarity, least, k)
    parts = components(links.select(F.col("a"), F.col("b")), "links")

    # The smallest document id of a component, for every class of it.
    ends = classes.select("sid", "first").join(parts.withColumnRenamed("node", "sid"), "sid", "left")
    ends = ends.withColumn("label", F.coalesce("label", "sid"))
    least_id = ends.groupBy("label").agg(F.min("first").alias("component_id"))
    named = ends.join(least_id, "label").select("sid", "component_id")
    out = sketched.drop("sketch").join(named, "sid", "left")
    component = F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def _links(full: DataFrame, similarity: tuple[int, int], least: float, k: int) -> DataFrame:
    """Confirmed links (a, b) of class ids; a group too large for one task is dealt in pairs of blocks ordered by size."""
    sized = full.withColumn("n", F.length("full") / 8)
    totals = sized.groupBy("label").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("members"))
    sized = sized.join(totals.where("members > 1"), "label")
    small = sized.where(F.col("total") <= GROUP_HASHES).withColumns({"block": F.lit(0), "pair": F.lit(0).cast("long")})
    blocks = F.ceil(F.col("total") / (GROUP_HASHES // 2)).cast("int")
    large = sized.where(F.col("total") > GROUP_HASHES).withColumn("block", F.pmod(F.xxhash64("sid"), blocks).cast("int"))
    # Every block meets every other one of its group once; blocks grow in number, not in size.
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    large = large.withColumn("other", other).withColumn(
        "pair", F.least("block", "other").cast("long") * F.lit(2**31) + F.greatest("block", "other"))
    cols = ["label", "pair", "sid", "full"]
    dealt = small.select(*cols).unionByName(large.select(*cols)).repartition(shuffle_partitions(full.sparkSession), "label", "pair")
    return dealt.groupBy("label", "pair").applyInPandas(_forest(similarity, least, k), "a binary, b binary")


def keep_one_of_each(docs: DataFrame, width: int = 5, similarity: tuple[int, int] = (4, 5), id_col: str = "doc_id", text_col: str = "text",
                     keep_unnamed: bool = True) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: one row of each near-duplicate group, the one with the smallest id (then the first written).

    Rows are told apart by a written row number, so rows that repeat an id are judged by their own texts.  Rows without an id all
    stay beside the others unless ``keep_unnamed`` is false; then they are rows like others, after those that have an id.
    """
    (key,) = [c for c in docs.columns if c == id_col]
    prepare(docs.sparkSession)
    (row,) = fresh(docs, "row")
    # Written first: a row must have the same number wherever it is read.
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-rows")
    parts = near_duplicates(numbered, width, similarity, id_col=row, text_col=text_col).select(F.col("doc_id").alias("row"), "component_id")
    ids = numbered.select(F.col(row).alias("row"), F.col(f"`{key}`").cast("long").alias("id"))
    rank = F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")
    stay = parts.join(ids, "row").groupBy("component_id").agg(F.min(rank)["row"].alias("row")).select("row")
    if keep_unnamed:
        stay = stay.unionByName(ids.where("id IS NULL").select("row"))
    return numbered.join(stay.withColumnRenamed("row", row), row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
