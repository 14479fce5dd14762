"""Mixing sources to target weights by weighted fair queueing.

1. Each source has a weight by its place among the sources in code point order (null last).  The sources share the total
   of all sizes by weight; a target stops at ``most`` times the size of its source and the excess is shared again by
   weight among the others until none is above (rounds over the small table of sources).
2. The documents of a source queue in an order shuffled by a seeded digest of the row, once for each pass (a target above
   the source's size needs further passes).  Cumulative source words come from windows over (source, part of the digest
   range) and offsets over the parts, so a source with a third of all rows spreads over as many tasks as it needs.
3. A queue is served in packets of at most ``PACKET`` words.  A packet's virtual finish time is the cumulative words of
   its source divided by the source's target.  Served at these rates, every span of virtual time holds about as many
   words as any other of its length, so packets are range-sorted by spans of equal length, whose bounds are fixed by the budget.
4. Running words over the sorted packets give every packet its place in the mix; the mix is truncated at the total
   budget.  By the order, at any cut a source is within a packet of its share of what is served.

Rows that agree in id, source and text are interchangeable: their digests are equal, and so is what each may get.

Defined cases: null text has size 0; a document of size 0 is never taken; a source whose documents are all empty has the
target 0; null ids are ids like others; repeated rows are rows of their own; an empty table gives no rows; other
columns are ignored by ``mix`` and ``schedule``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boardsmith.llm.common import prepare, shuffle_partitions
from boardsmith.operators.ranking import with_rank
from boardsmith.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3  # times a source's size at which its target stops, and passes over a document
PACKET = 64  # words served at once
PART_ROWS = 500_000  # rows of a source in one window, or fewer where the table is small for its tasks
SPAN_WORDS = 20_000_000  # words of the mix in one span of virtual time
SEED = 20_251


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, digest): a row for each document, without its text."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    doc, source = F.col(f"`{id_col}`"), F.col(f"`{source_col}`").cast("string")
    return docs.select(doc.alias("doc_id"), source.alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                       F.xxhash64(F.lit(SEED), text, doc, source).alias("digest"))


def targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_rank, source_size, source_rows, target): one row for each source."""
    own = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows")), "sources")
    # Null comes last; ascending ranks would start with it, so a flag goes first.
    ranked = with_rank(own.withColumn("_none", F.col("source").isNull()), ["_none", "source"], "source_rank").drop("_none")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_rank") % len(weights) + 1).cast("int")).cast("long")
    ranked = materialize(ranked.withColumn("weight", weight), "ranked-sources")
    # Water-filling: a source whose share passes its limit stops there, the rest share what is left.  The level
    # left / among only rises from round to round, so it alone says which sources have stopped.
    limit = F.col("source_size") * most
    wide = lambda c, digits: c.cast(f"decimal({digits},0)")
    first = ranked.agg(F.sum("source_size").alias("left"), F.sum("weight").alias("among")).first()
    total, left, among = first["left"] or 0, first["left"] or 0, first["among"] or 0
    while True:
        stopped = wide(F.col("weight"), 19) * wide(F.lit(left), 19) > wide(limit, 19) * wide(F.lit(among), 19) if among else F.lit(True)
        row = ranked.agg(F.sum(F.when(stopped, limit)).alias("given"), F.sum(F.when(~stopped, F.col("weight"))).alias("open")).first()
        before, (left, among) = (left, among), (total - (row["given"] or 0), row["open"] or 0)
        if not among or (left, among) == before:
            break
    share = F.col("weight").cast("double") * float(left) / float(among) if among else F.lit(0.0)
    return ranked.select("source", "source_rank", "source_size", "source_rows", F.when(stopped, limit.cast("double")).otherwise(share).alias("target"))


def queue(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, **columns: str) -> DataFrame:
    """Every row of ``docs`` with its source's target and ``start``, the words of its source queued before it (null for size 0)."""
    prepare(docs.sparkSession)
    sized = materialize(sizes(docs, **columns), "sizes")
    aims = materialize(targets(sized, weights, most), "targets").withColumnRenamed("source", "_source")
    rows = sized.join(aims, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    part_rows = min(PART_ROWS, -(-sized.count() // shuffle_partitions(docs.sparkSession)) or 1)  # a source with a third of the rows takes a third of the tasks
    parts = F.ceil(F.col("source_rows") / part_rows).cast("long")
    rows = rows.withColumn("part", F.shiftright(F.shiftrightunsigned("digest", 33) * parts, 31))  # ranges of the digest's first 31 bits
    own = Window.partitionBy("source_rank", "part").orderBy("digest", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("source_rank").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each part
    offsets = rows.groupBy("source_rank", "part").agg(F.sum("size").alias("_words")).select(
        "source_rank", "part", F.coalesce(F.sum("_words").over(ahead), F.lit(0)).alias("_off"))
    placed = rows.withColumn("_own", F.coalesce(F.sum("size").over(own), F.lit(0))).join(offsets, ["source_rank", "part"])
    start = F.when(F.col("size") > 0, F.col("_off") + F.col("_own"))
    return materialize(placed.select("doc_id", "source", "source_rank", "source_size", "target", "size", start.alias("start")), "queue")


def schedule(queued: DataFrame, most: int = MOST, packet: int = PACKET) -> DataFrame:
    """The mix: (source_rank, start, pass, packet, finish, offset, taken), a row for each packet or cut packet within the budget.

    ``offset`` is the packet's place in words in the whole mix; ``start`` names the document within its source.
    """
    spark = queued.sparkSession
    aims = queued.groupBy("source_rank").agg(F.max("source_size").alias("words")).agg(F.sum("words").alias("budget"), F.count(F.lit(1)).alias("n")).first()
    budget, n_sources = aims["budget"] or 0, aims["n"]
    horizon = 1.0 + packet * n_sources / max(1, budget)  # at time 1 every source is within a packet of its target
    spans = max(shuffle_partitions(spark), -(-budget // SPAN_WORDS))
    units = queued.where((F.col("size") > 0) & (F.col("target") > 0)).withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    units = units.withColumn("_from", F.col("pass") * F.col("source_size") + F.col("start")).where(F.col("_from") < horizon * F.col("target"))
    packets = units.withColumn("packet", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(size - 1) div {packet}"))))
    words = F.least(F.lit(packet).cast("long"), F.col("size") - F.col("packet") * packet)
    packets = packets.withColumn("words", words).withColumn("_end", F.col("_from") + F.col("packet") * packet + F.col("words"))
    packets = packets.where(F.col("_end") - F.col("words") < horizon * F.col("target")).withColumn("finish", F.col("_end") / F.col("target"))
    span = F.least(F.floor(F.col("finish") / F.lit(horizon) * spans), F.lit(spans)).cast("long")
    packets = packets.select("source_rank", "start", "pass", "packet", "words", "_end", "finish", span.alias("span"))
    own = Window.partitionBy("span").orderBy("finish", "source_rank", "_end").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)  # one row for each span
    offsets = packets.groupBy("span").agg(F.sum("words").alias("_words")).select("span", F.coalesce(F.sum("_words").over(ahead), F.lit(0)).alias("_off"))
    placed = packets.withColumn("_own", F.coalesce(F.sum("words").over(own), F.lit(0))).join(offsets, "span")
    placed = placed.withColumn("offset", F.col("_off") + F.col("_own")).where(F.col("offset") < budget)
    return placed.select("source_rank", "start", "pass", "packet", "finish", "offset", F.least("words", F.lit(budget) - F.col("offset")).alias("taken"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, packet: int = PACKET, **columns: str) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of ``docs``."""
    queued = queue(docs, weights, most, **columns)
    taken = schedule(queued, most, packet).groupBy("source_rank", "start").agg(F.sum("taken").alias("taken"))
    return queued.join(taken, ["source_rank", "start"], "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
