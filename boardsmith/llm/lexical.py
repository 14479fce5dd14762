"""Ranked lexical search by buckets of impact vectors of similar length.

1. The items are dealt into blocks of bounded size.  A block's terms and weights are small enough to travel to every task.
2. One scan of the documents counts their terms in the row; a document becomes the vector of its counts over the terms of
   the block.  Sizes, document frequencies and the number of documents come from partial aggregates over all rows.
3. Counts become integer impacts by Spark expressions.  Vectors are ordered by length (the Euclidean norm): bounds at
   quantiles of the norm cut them into bands, a band is dealt into shards, and a shard is sorted by length.
4. Wave one searches the longest band, which gives each item a score that its last rank must reach.  Wave two searches the
   other bands with it.  A shard is cut into buckets of vectors of similar length, in falling order:
   a bucket is left out for an item when item length times bucket length, the Cauchy-Schwarz bound, stays below the
   score to reach (and so are all later ones of the shard).  Inside a bucket the item's largest coordinates are added
   first; a vector goes when that sum plus the product of the remaining lengths of both stays below the score to reach.
   What survives is rescored exactly in 64-bit integers.  A shard's own winners raise the score to reach.
5. The winners of all shards are merged by rank: equal scores by smaller doc_id.

Bounds are computed in doubles and widened by a margin far above their rounding, so no document is lost.

Defined cases: null text has no terms; documents without terms do not count; an item without terms, or whose terms no
document holds, has no rows; each row of the items is searched, so rows that repeat an item repeat its result;
repeated documents are rows of their own; null ids are carried (they come last among equal scores); empty tables give
no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boardsmith.llm.common import prepare, shuffle_partitions
from boardsmith.session import materialize

# The characters below \x80 that belong to terms; A-Z are lower-cased, all others separate.
_TERM_CHARS = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(i if i >= 128 or i in _TERM_CHARS else 32 for i in range(256)).lower()

BLOCK_BYTES = 16_000_000  # bytes of item texts searched at once: bounds what is broadcast
SHARD_ROWS = 40_000  # mean vectors of a shard
HELD_VALUES = 8_000_000  # coordinates held by one task at a time; a shard with more is searched in parts
BUCKET_ROWS = 4_096
BANDS = 16  # bands of vector lengths; the first is wave one
FOCUS = 0.7  # share of an item's squared length that is added before vectors are ruled out
MARGIN = 1e-9


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: runs of letters, digits and characters from \\x80 on, only A-Z lower-cased."""
    return text.translate(_TABLE).split()


# ---------------------------------------------------------------------------------------------------- items

class Items:
    """A block of items as sparse vectors over the block's own terms."""

    def __init__(self, rows: list[tuple]):
        self.keys = [r[0] for r in rows]  # row numbers
        self.vocabulary: dict[bytes, int] = {}
        self.counts = []
        for _, text in rows:
            own = Counter(terms((text or "").encode()))
            self.counts.append({self.vocabulary.setdefault(t, len(self.vocabulary)): n for t, n in own.items()})

    def weigh(self, weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(term numbers, weight times count), the largest first, without zeros."""
        out = []
        for own in self.counts:
            ids = np.fromiter(own, np.int64, len(own))
            value = weights[ids] * np.fromiter(own.values(), np.int64, len(own))
            order = np.lexsort((ids, -value))
            order = order[value[order] > 0]
            out.append((ids[order], value[order]))
        return out


# ------------------------------------------------------------------------------------------------ documents

VECTORS = "doc_id {}, n bigint, ids array<int>, tfs array<int>"


def _counted(vocabulary):
    def run(batches):
        known = vocabulary.value
        for b in batches:
            sizes, ids, tfs = [], [], []
            for text in b.column(1).cast(pa.binary()):
                found = terms(text.as_py() or b"")
                own = Counter(found)
                hits = [(known[t], n) for t, n in own.items() if t in known]
                sizes.append(len(found))
                ids.append([i for i, _ in hits])
                tfs.append([n for _, n in hits])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))], ["doc_id", "n", "ids", "tfs"])

    return run


def count_vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, ids, tfs) for every document with a term: its number of terms and its counts over the vocabulary."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(vocabulary)
    return rows.mapInArrow(_counted(shared), VECTORS.format(rows.schema["doc_id"].dataType.simpleString())).where(F.col("n") > 0)


def impact_vectors(counted: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """(doc_id, ids, impacts, norm): integer impacts of the counts, and the vector's length."""
    m = F.expr(f"CAST(75 + (25 * n * {n_docs}L) div {max(1, n_terms)}L AS bigint)")
    impact = F.expr("transform(tfs, tf -> (1000000000L * tf) div (1000L * tf + 12L * m))")
    norm = F.sqrt(F.aggregate("impacts", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return counted.where(F.size("ids") > 0).withColumn("m", m).withColumn("impacts", impact).select("doc_id", "ids", "impacts", norm.alias("norm"))


# --------------------------------------------------------------------------------------------------- search

class Bucket:
    """Vectors of similar length, by row and by term."""

    def __init__(self, ids: np.ndarray, impacts: np.ndarray, starts: np.ndarray, norms: np.ndarray):
        self.ids, self.impacts, self.starts, self.norms = ids, impacts, starts, norms
        self.n = len(norms)
        rows = np.repeat(np.arange(self.n), np.diff(starts))
        order = np.argsort(ids, kind="stable")
        self.terms, at = np.unique(ids[order], return_index=True)
        self.at = np.append(at, len(order))
        self.row_of, self.impact_of = rows[order], impacts[order]

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        k = int(np.searchsorted(self.terms, term))
        if k == len(self.terms) or self.terms[k] != term:
            return self.row_of[:0], self.impact_of[:0]
        part = slice(self.at[k], self.at[k + 1])
        return self.row_of[part], self.impact_of[part]

    def survivors(self, ids: np.ndarray, values: np.ndarray, length: float, least: int) -> np.ndarray:
        """Rows that the largest coordinates cannot rule out for a score of ``least``."""
        share = np.cumsum(values.astype(np.float64) ** 2)
        focus = int(np.searchsorted(share, FOCUS * share[-1])) + 1
        dot, seen = np.zeros(self.n), np.zeros(self.n)
        for t, v in zip(ids[:focus], values[:focus], strict=True):
            rows, impact = self.postings(t)
            impact = impact.astype(np.float64)
            dot[rows] += v * impact
            seen[rows] += impact * impact
        rest_item = math.sqrt(max(0.0, share[-1] - share[focus - 1]))
        rest = np.sqrt(np.maximum(self.norms**2 - seen, 0.0) + MARGIN * self.norms**2)
        return np.flatnonzero(dot + rest_item * rest + MARGIN * length * self.norms >= least)

    def scores(self, rows: np.ndarray, ids: np.ndarray, values: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Exact scores of the given rows; ``dense`` is a zero array over the vocabulary."""
        held = int((self.starts[rows + 1] - self.starts[rows]).sum())
        found = [self.postings(t) for t in ids]
        if held > sum(len(r) for r, _ in found):  # shorter by terms
            out = np.zeros(self.n, np.int64)
            for (r, impact), v in zip(found, values, strict=True):
                out[r] += v * impact
            return out[rows]
        dense[ids] = values
        out = np.array([dense[self.ids[a:b]] @ self.impacts[a:b] for a, b in zip(self.starts[rows], self.starts[rows + 1], strict=True)], np.int64)
        dense[ids] = 0
        return out


class Winners:
    """The best of one item so far, and the score that a further document must reach."""

    def __init__(self, least: int):
        self.least, self.docs, self.scores = max(1, least), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, docs: np.ndarray, scores: np.ndarray, k: int) -> None:
        good = scores >= self.least
        self.docs, self.scores = np.append(self.docs, docs[good]), np.append(self.scores, scores[good])
        if len(self.scores) > 4 * k:
            self.trim(k)

    def trim(self, k: int) -> None:
        best = np.lexsort((self.docs, -self.scores))[:k]
        self.docs, self.scores = self.docs[best], self.scores[best]
        if len(best) == k:
            self.least = max(self.least, int(self.scores[-1]))


NO_ID = np.iinfo(np.int64).max  # a null id among the winners: last among equal scores


def _buckets(doc_ids, lists, impacts, norms):
    """Buckets of one sorted shard with their document ids, in falling order of length."""
    order = np.argsort(-norms, kind="stable")
    starts = np.append(0, np.cumsum([len(lists[i]) for i in order]))
    ids = np.concatenate([lists[i] for i in order]).astype(np.int64)
    values = np.concatenate([impacts[i] for i in order]).astype(np.int64)
    docs, norms = doc_ids[order], norms[order]
    for a in range(0, len(order), BUCKET_ROWS):
        b = min(a + BUCKET_ROWS, len(order))
        yield docs[a:b], Bucket(ids[starts[a]:starts[b]], values[starts[a]:starts[b]], starts[a:b + 1] - starts[a], norms[a:b])


def _searched(shared, k: int):
    def shards(batches):
        """The input, which comes sorted by shard, in tables of bounded size."""
        held, values = [], 0
        for b in batches:
            held.append(b)
            values += len(b.column(1).flatten())
            if values >= HELD_VALUES:
                yield pa.Table.from_batches(held)
                held, values = [], 0
        if sum(b.num_rows for b in held):
            yield pa.Table.from_batches(held)

    def run(batches):
        vectors, least, size = shared.value
        dense = np.zeros(size, np.int64)
        lengths = [math.sqrt(float((v.astype(np.float64) ** 2).sum())) for _, v in vectors]
        best = [Winners(x) for x in least]
        for t in shards(batches):
            doc_ids = t.column("doc_id").combine_chunks()
            doc_ids = doc_ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
            lists = [c for c in _arrays(t.column("ids"))]
            impacts = [c for c in _arrays(t.column("impacts"))]
            open_items = [i for i, (ids, _) in enumerate(vectors) if len(ids)]
            for docs, bucket in _buckets(doc_ids, lists, impacts, t.column("norm").to_numpy()):
                longest = float(bucket.norms[0]) * (1 + MARGIN)
                open_items = [i for i in open_items if lengths[i] * longest >= best[i].least]  # Cauchy-Schwarz
                for i in open_items:
                    ids, values = vectors[i]
                    rows = bucket.survivors(ids, values, lengths[i], best[i].least)
                    if len(rows):
                        best[i].add(docs[rows], bucket.scores(rows, ids, values, dense), k)
        for w in best:
            w.trim(k)
        numbers = np.repeat(np.arange(len(best)), [len(w.docs) for w in best])
        docs = np.concatenate([w.docs for w in best]) if best else np.zeros(0, np.int64)
        scores = np.concatenate([w.scores for w in best]) if best else np.zeros(0, np.int64)
        if len(docs):
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(docs, pa.int64(), mask=docs == NO_ID), pa.array(scores, pa.int64())],
                                             ["item", "doc_id", "score"])

    return run


def _arrays(column: pa.ChunkedArray):
    for chunk in column.chunks:
        values, at = chunk.values.to_numpy(zero_copy_only=False), chunk.offsets.to_numpy()
        for a, b in zip(at, at[1:]):
            yield values[a:b]


def _wave(spark: SparkSession, vectors: DataFrame, items: list, least: list[int], size: int, k: int) -> DataFrame:
    """The k best of each shard for each item, as far as they reach its least score."""
    shared = spark.sparkContext.broadcast((items, least, size))
    return vectors.mapInArrow(_searched(shared, k), "item bigint, doc_id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, rows: list[tuple], k: int, **columns: str) -> DataFrame:
    """(item, rank, doc_id, score) for one block of items; ``item`` is the row's number."""
    spark = docs.sparkSession
    items = Items(rows)
    counted = materialize(count_vectors(docs, items.vocabulary, **columns), "counted")
    n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = np.zeros(len(items.vocabulary), np.int64)
    for term, n in counted.select(F.explode("ids").alias("term")).groupBy("term").count().collect():  # at most one row for each term of the block
        frequency[term] = n
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(f) + 1))) for f in frequency], np.int64)
    vectors = items.weigh(weights)
    # Bands of falling length; a shard is a band's rows under one hash.
    with_norm = impact_vectors(counted, n_docs, n_terms)
    bounds, held = with_norm.agg(F.percentile_approx("norm", [1 - i / BANDS for i in range(1, BANDS)], 1000), F.count(F.lit(1))).first()
    shards = max(1, -(-held // (BANDS * SHARD_ROWS)), -(-shuffle_partitions(spark) // BANDS))
    band = sum((F.when(F.col("norm") < b, 1).otherwise(0) for b in sorted(set(bounds or []), reverse=True)), F.lit(0))
    placed = with_norm.withColumn("band", band).withColumn("shard", F.col("band") * shards + F.pmod(F.xxhash64("doc_id", "ids", "impacts"), F.lit(shards)))
    placed = materialize(placed.repartition(BANDS * shards, "shard").sortWithinPartitions("shard", F.desc("norm")), "impact-vectors")
    nothing = [1] * len(vectors)
    first = materialize(_best(_wave(spark, placed.where(F.col("band") == 0), vectors, nothing, len(weights), k), k), "wave-one")
    least = list(nothing)
    for item, score in first.where(F.col("rank") == k).select("item", "score").collect():  # one row for each item of the block
        least[item] = score
    rest = _wave(spark, placed.where(F.col("band") > 0), vectors, least, len(weights), k)
    merged = _best(first.select("item", "doc_id", "score").unionByName(rest), k)
    names = spark.createDataFrame([(i, key) for i, key in enumerate(items.keys)], "item bigint, key bigint")
    return merged.join(F.broadcast(names), "item").select("key", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 20, item_col: str = "item_id", item_text_col: str = "text", **columns: str) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents of every row of ``items``, scores above 0."""
    spark = docs.sparkSession
    prepare(spark)
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), F.coalesce(F.col(f"`{item_text_col}`").cast("string"), F.lit("")).alias("text"))
    asked = materialize(asked.withColumn("key", F.monotonically_increasing_id()), "items")  # numbered once, in the written rows
    n_bytes = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    blocks = max(1, -(-(n_bytes[0] + 64 * n_bytes[1]) // BLOCK_BYTES))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    found = None
    for block in range(blocks):
        rows = [tuple(r) for r in asked.where(F.col("block") == block).select("key", "text").collect()]  # about BLOCK_BYTES
        if rows:
            part = _search_block(docs, rows, k, **columns)
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "key bigint, rank int, doc_id bigint, score bigint")
    return found.join(asked.select("key", "item_id"), "key").select("item_id", "rank", "doc_id", "score")
