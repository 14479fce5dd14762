"""Removal of long repeated byte strings by external induced sorting of suffix shards.

1. Every window of ``least`` bytes is assigned to its anchor, the smallest hash among the grams inside it.
   Equal windows have equal anchors, so windows can only repeat among those of one anchor.  Consecutive windows of
   one anchor form a segment: few rows for each document, of hashes only.
2. Anchors that occur once are dropped.  Segments of the others are reduced to distinct ones with their counts, so a
   passage in many documents is one row; a distinct segment that is alone under its anchor needs no sort.
3. The bytes of the rest are dealt to shards by anchor and each shard is sorted by ``induced_sort``: suffixes whose
   common prefix with a neighbour reaches ``least`` are windows that start elsewhere too.  Shards are cut between
   anchors at ``SHARD_BYTES``.
4. An anchor whose distinct segments exceed ``GROUP_BYTES`` is dealt again before it is sorted: its windows by the
   anchor's offset in them, in cells of a quarter of the offsets, and by a hash of the bytes that all windows of a cell
   have.  Equal windows share both.  Equal pieces become one row again, and what is still too large is dealt in cells
   of a quarter of that width, down to single windows, of which only distinct ones are left; so every shard is bounded.
5. Repeated windows go back to every occurrence of their segment and are cut from the texts.

Matches never cross texts.  Strings are judged on the input, not on what is left.  Hashes of segments have 128 bits.

Defined cases: null text counts as empty in the report and stays null in ``remove_repeats``; a text shorter than
``least`` bytes keeps everything; null or repeated ids are rows of their own (equal texts repeat each other);
an empty table gives no rows; other columns are ignored by the report and kept by ``remove_repeats``, where a
character of which some byte is removed goes as a whole.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardsmith.llm.common import fresh, prepare, shuffle_partitions
from boardsmith.llm.induced_sort import Sorter
from boardsmith.llm.near_dedup import mixed
from boardsmith.session import materialize

SHARD_BYTES = 4_000_000
GROUP_BYTES = 4_000_000  # bytes of the distinct segments of one anchor before they are dealt again
DEAL = 4  # cells into which the offsets of such an anchor are cut in each round
BLOCK = 1 << 17  # bytes that are hashed at once; a longer text is taken in overlapping blocks
_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(11).integers(1, 2**63, 256, np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def gram_of(least: int) -> int:
    """Bytes of a gram: long enough that other texts seldom share an anchor, short enough that segments are long."""
    return max(1, least * 2 // 5)


class Anchors:
    """Segments of the windows of some texts, ``least`` bytes each, by the smallest hash of their grams."""

    def __init__(self, least: int):
        self.least, self.gram = least, gram_of(least)
        self.limit = max(BLOCK, 4 * least)
        self.place = np.uint64((1 << (2 * self.limit).bit_length()) - 1)
        size = 2 * self.limit + 1
        self.power, self.back = _powers(_BASE, size), _powers(pow(_BASE, -1, 2**64), size)

    def blocks(self, texts: list[bytes]):
        """Runs of (text index, offset, bytes) whose joint size stays bounded; every window lies in exactly one of them."""
        run, size = [], 0
        for i, t in enumerate(texts):
            for at in range(0, max(0, len(t) - self.least + 1), self.limit - self.least + 1):
                piece = t[at:at + self.limit]
                if len(piece) < self.least:
                    continue
                if size + len(piece) > self.limit:
                    yield run
                    run, size = [], 0
                run.append((i, at, piece))
                size += len(piece)
        if run:
            yield run

    def segments(self, run: list[tuple[int, int, bytes]]):
        """Arrays (text index, first byte, bytes, anchor, content, the anchor's offset) of the segments of one run."""
        data = np.frombuffer(b"".join(p for _, _, p in run), np.uint8)
        n, least, gram = len(data), self.least, self.gram
        total = np.concatenate([[np.uint64(0)], np.cumsum(_TABLE[data] * self.power[:n])])
        hashed = mixed((total[gram:] - total[:-gram]) * self.back[:n - gram + 1])
        low = (hashed & ~self.place) | np.arange(len(hashed), dtype=np.uint64)
        width, span = least - gram + 1, 1
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if width > span:
            low = np.minimum(low[:span - width], low[width - span:])
        anchor = (low & self.place).astype(np.int64)  # of the window that starts here
        tops = np.concatenate([[0], np.cumsum([len(p) for _, _, p in run])])
        owner = np.repeat(np.arange(len(run)), np.diff(tops))[: len(anchor)]
        start = np.arange(len(anchor))
        inside = start + least <= tops[owner + 1]
        opens = inside & np.append(True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]))
        first = np.flatnonzero(opens)
        if not len(first):
            return None
        until = np.minimum(np.append(first[1:], len(anchor)), tops[owner[first] + 1] - least + 1)
        end = until - 1 + least
        content = mixed((total[end] - total[first]) * self.back[first] + (end - first).astype(np.uint64))
        index, offset = np.array([i for i, _, _ in run]), np.array([at for _, at, _ in run])
        own = owner[first]
        return index[own], offset[own] + first - tops[own], end - first, hashed[anchor[first]].view(np.int64), content.view(np.int64), anchor[first] - first


def text_id(text: bytes) -> bytes:
    return xxhash.xxh3_128_digest(text)


SEGMENTS = "tid binary, first bigint, size bigint, anchor bigint, content bigint, spot bigint"


def _segments(least: int):
    def run(batches):
        anchors = Anchors(least)
        for b in batches:
            texts = [t.as_py() or b"" for t in b.column(0).cast(pa.binary())]
            tids = pa.array([text_id(t) for t in texts], pa.binary())
            for block in anchors.blocks(texts):
                found = anchors.segments(block)
                if found:
                    own, *rest = found
                    yield pa.RecordBatch.from_arrays([tids.take(pa.array(own)), *map(pa.array, rest)], ["tid", "first", "size", "anchor", "content", "spot"])

    return run


def _cut_out(batches):
    """Rows (text, wanted segments) to the segments' bytes."""
    for b in batches:
        wanted = b.column("wanted")
        fields = dict(zip((f.name for f in wanted.type.value_type), wanted.flatten().flatten(), strict=True))
        spots = zip(fields["first"].to_pylist(), fields["size"].to_pylist(), strict=True)
        done, cut, size = 0, [], 0
        for text, n in zip(b.column("text").cast(pa.binary()), wanted.value_lengths().to_pylist(), strict=True):
            data = text.as_py()
            for first, length in itertools.islice(spots, n):
                cut.append(data[first:first + length])
                size += length
            if size >= SHARD_BYTES:
                yield _cut_rows(fields, done, cut)
                done, cut, size = done + len(cut), [], 0
        if cut:
            yield _cut_rows(fields, done, cut)


def _cut_rows(fields: dict, at: int, cut: list[bytes]) -> pa.RecordBatch:
    anchor, content, n, spot = (fields[c].slice(at, len(cut)) for c in ("anchor", "content", "n", "spot"))
    return pa.RecordBatch.from_arrays([anchor, content, n, pa.array(cut, pa.binary()), spot], ["anchor", "content", "n", "bytes", "spot"])


ROWS = "anchor bigint, content bigint, n bigint, bytes binary, spot bigint"
PIECES = "whole_anchor bigint, whole_content bigint, lo bigint, " + ROWS


def _pieces(least: int, width: int):
    """Rows (``ROWS``) to their windows dealt in cells of ``width`` offsets; a piece's anchor is the hash of its cell and of the bytes in all its windows."""

    def run(batches):
        for b in batches:
            out = []
            for anchor, content, n, data, spot in zip(*[b.column(c).to_pylist() for c in ("anchor", "content", "n", "bytes", "spot")], strict=True):
                last = len(data) - least  # the start of the last window; the anchor's offset in a window is spot - start
                for cell in range((spot - last) // width, spot // width + 1):
                    lo, hi = max(0, spot - cell * width - width + 1), min(last, spot - cell * width)
                    core = data[spot - cell * width:spot - cell * width - width + 1 + least]
                    piece = data[lo:hi + least]
                    key = xxhash.xxh3_64_intdigest(b"%d %d %d " % (anchor, cell, width) + core)
                    out.append((anchor, content, lo, key - 2**63, xxhash.xxh3_64_intdigest(piece, 1) - 2**63, n, piece, spot - lo))
            cols = list(zip(*out, strict=True)) if out else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if i == 6 else pa.int64()) for i, c in enumerate(cols)],
                                             ["whole_anchor", "whole_content", "lo", "anchor", "content", "n", "bytes", "spot"])

    return run


RANGES = "anchor bigint, content bigint, ranges array<struct<lo:bigint,hi:bigint>>"


def _shard(rows: list[tuple[int, int, int, bytes]], least: int):
    anchor, content, n, data = zip(*rows, strict=True)
    text = np.frombuffer(b"\0".join([*data, b""]), np.uint8).astype(np.uint16) + 1
    size = np.array([len(d) for d in data])
    end = np.cumsum(size + 1) - 1
    text[end] = 0
    again = Sorter(text, least).repeated()
    again |= np.repeat(np.array(n) > 1, size + 1)
    again &= np.arange(least, len(text) + least) <= np.repeat(end, size + 1)  # windows that end inside their segment
    # Byte ranges covered by such windows.  Those of two segments are more than ``least`` bytes apart.
    at = np.flatnonzero(again)
    gaps = np.flatnonzero(np.diff(at) > least)
    lo = at[np.append(0, gaps + 1)] if len(at) else at
    hi = at[np.append(gaps, len(at) - 1)] + least if len(at) else at
    own = np.searchsorted(end, lo)
    first = (end - size)[own]
    kept = np.unique(own)
    ranges = pa.StructArray.from_arrays([pa.array(lo - first), pa.array(hi - first)], ["lo", "hi"])
    offsets = pa.array(np.append(np.searchsorted(own, kept), len(own)), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor, pa.int64()).take(pa.array(kept)), pa.array(content, pa.int64()).take(pa.array(kept)), pa.ListArray.from_arrays(offsets, ranges)],
        ["anchor", "content", "ranges"])


def _sorted_shards(least: int):
    """Segments sorted by anchor, cut into shards between anchors."""

    def run(batches):
        rows, size = [], 0
        for b in batches:
            for r in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if size >= SHARD_BYTES and r[0] != rows[-1][0]:
                    yield _shard(rows, least)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[3])
        if rows:
            yield _shard(rows, least)

    return run


def _whole_range(size: Column) -> Column:
    return F.array(F.struct(F.lit(0).cast("long").alias("lo"), size.cast("long").alias("hi"))).alias("ranges")


def _by_shards(rows: DataFrame, least: int) -> DataFrame:
    """(anchor, content, ranges) of rows (``ROWS``) of which each anchor's fit one shard."""
    dealt = rows.select("anchor", "content", "n", "bytes").repartition(shuffle_partitions(rows.sparkSession), "anchor")
    return dealt.sortWithinPartitions("anchor", "content").mapInArrow(_sorted_shards(least), RANGES)


def _dealt_ranges(rows: DataFrame, least: int, width: int) -> DataFrame:
    """(anchor, content, ranges) of rows (``ROWS``) of anchors too large for a shard, whose windows have the anchor at ``width`` offsets."""
    width = -(-width // DEAL)
    pieces = materialize(rows.mapInArrow(_pieces(least, width), PIECES), "pieces")
    distinct = pieces.groupBy("anchor", "content").agg(F.sum("n").alias("n"), F.first("bytes").alias("bytes"), F.first("spot").alias("spot"))
    distinct = materialize(distinct, "distinct-pieces")
    totals = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents"), F.sum(F.length("bytes")).alias("total")).where("contents > 1")
    totals = materialize(totals.select("anchor", "total"), "several-pieces")
    alone = distinct.join(totals, "anchor", "left_anti").where("n > 1").select("anchor", "content", _whole_range(F.length("bytes")))
    fits, large = F.col("total") <= GROUP_BYTES, totals.where(F.col("total") > GROUP_BYTES)
    if width == 1 or large.isEmpty():  # a cell of one offset holds one distinct window
        fits = F.lit(True)
    ranges = _by_shards(distinct.join(totals.where(fits), "anchor", "left_semi"), least).unionByName(alone)
    if width > 1 and not large.isEmpty():
        ranges = ranges.unionByName(_dealt_ranges(distinct.join(large, "anchor", "left_semi"), least, width))
    back = pieces.select("whole_anchor", "whole_content", "lo", "anchor", "content").join(ranges, ["anchor", "content"])
    moved = F.transform("ranges", lambda r: F.struct((r["lo"] + F.col("lo")).alias("lo"), (r["hi"] + F.col("lo")).alias("hi")))
    return back.select(F.col("whole_anchor").alias("anchor"), F.col("whole_content").alias("content"), moved.alias("ranges"))


def repeated_ranges(texts: DataFrame, least: int) -> DataFrame:
    """(tid, ranges) of the texts (column ``text``) that hold repeated strings; ranges overlap and are not sorted."""
    spark = texts.sparkSession
    found = materialize(texts.mapInArrow(_segments(least), SEGMENTS), "segments")
    again = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("anchor")
    again = materialize(again, "repeated-anchors")  # a join with an aggregate on its own shuffle cannot be split at a common anchor
    shared = materialize(found.join(again, "anchor", "left_semi"), "shared-segments")

    distinct = shared.groupBy("anchor", "content", "size").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("tid", "first", "spot")).alias("at"))
    distinct = materialize(distinct, "distinct-segments")
    several = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents"), F.sum("size").alias("total")).where("contents > 1")
    several = materialize(several.select("anchor", "total"), "several-segments")
    alone = distinct.join(several, "anchor", "left_anti").where("n > 1").select("anchor", "content", _whole_range(F.col("size")))
    by_text = texts.mapInArrow(_with_id, _with_id_schema(texts)).dropDuplicates(["tid"])

    def cut_out(anchors: DataFrame) -> DataFrame:
        w = F.struct("anchor", "content", "n", "size", F.col("at.first").alias("first"), F.col("at.spot").alias("spot"))
        wanted = distinct.join(anchors, "anchor", "left_semi").select(F.col("at.tid").alias("tid"), w.alias("w")).groupBy("tid").agg(F.collect_list("w").alias("wanted"))
        return by_text.join(wanted, "tid").select("text", "wanted").mapInArrow(_cut_out, ROWS)

    large = several.where(F.col("total") > GROUP_BYTES)
    ranges = _by_shards(cut_out(several.where(F.col("total") <= GROUP_BYTES)), least).unionByName(alone)
    if not large.isEmpty():
        ranges = ranges.unionByName(_dealt_ranges(cut_out(large), least, least - gram_of(least) + 1))
    ranges = materialize(ranges, "ranges")

    # Back to every text that holds the segment; copies of a text are one row here.
    places = shared.select("tid", "first", "anchor", "content").distinct()
    spots = places.join(ranges, ["anchor", "content"]).select("tid", F.explode(F.transform(
        "ranges", lambda r: F.struct((r["lo"] + F.col("first")).alias("lo"), (r["hi"] + F.col("first")).alias("hi")))).alias("r"))
    return spots.groupBy("tid").agg(F.collect_list("r").alias("ranges"))


def _with_id_schema(texts: DataFrame) -> str:
    return f"tid binary, text {texts.schema['text'].dataType.simpleString()}"


def _with_id(batches):
    for b in batches:
        texts = b.column(0).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([text_id(t.as_py() or b"") for t in texts], pa.binary()), b.column(0)], ["tid", "text"])


def _merged(column: pa.ListArray) -> list[list[tuple[int, int]]]:
    """Each row's ranges in order, joined where they meet; none for null."""
    count = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    if not len(flat):
        return [[] for _ in count]
    lo, hi = (pc.struct_field(flat, c).to_numpy(zero_copy_only=False) for c in ("lo", "hi"))
    base = np.repeat(np.arange(len(count)) * (int(hi.max()) + 1), count)  # a row's ranges lie after those of the row before
    order = np.argsort(lo + base)
    lo, reach = (lo + base)[order], np.maximum.accumulate((hi + base)[order])
    opens = np.flatnonzero(np.append(True, lo[1:] > reach[:-1]))
    until = np.append(opens[1:], len(lo)) - 1
    pairs = list(zip((lo[opens] - base[opens]).tolist(), (reach[until] - base[opens]).tolist(), strict=True))
    ends = np.searchsorted(opens, np.cumsum(count)).tolist()
    return [pairs[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for lo, hi in spans:
        parts.append(data[at:lo])
        at = hi
    return b"".join([*parts, data[at:]])


def _whole_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans widened to whole UTF-8 characters."""
    out = []
    for lo, hi in spans:
        while lo and data[lo] & 0xC0 == 0x80:
            lo -= 1
        while hi < len(data) and data[hi] & 0xC0 == 0x80:
            hi += 1
        out.append((lo, hi))
    return out


def _stretches(least: int):
    """Rows (tid, text, n, ranges) to the stretches of at least ``least`` bytes that the ranges cover, twice for a text that has copies."""

    def run(batches):
        for b in batches:
            rows = []
            for tid, text, n, spans in zip(b.column(0), b.column(1).cast(pa.binary()), b.column(2), _merged(b.column(3)), strict=True):
                data = text.as_py() or b""
                rows += [(tid.as_py(), lo, data[lo:hi], text_id(data[lo:hi])) for lo, hi in spans if hi - lo >= least] * min(n.as_py(), 2)
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.binary(), pa.int64(), pa.binary(), pa.binary()], strict=True)], ["tid", "lo", "text", "sid"])

    return run


def ranges_within(texts: DataFrame, least: int) -> DataFrame:
    """(tid, ranges) of the strings of ``least`` bytes that repeat, from distinct texts (tid, text, n, ranges) with the ranges of shorter ones.

    A string that repeats consists of shorter strings that repeat, so it lies inside a stretch that they cover, and so does its
    other occurrence: the stretches are all that has to be sorted again.
    """
    own = texts.select("tid", "text", "n", "ranges")
    stretches = materialize(own.mapInArrow(_stretches(least), "tid binary, lo bigint, text binary, sid binary"), "stretches")
    found = repeated_ranges(stretches.select("text"), least).withColumnRenamed("tid", "sid")
    moved = F.transform("ranges", lambda r: F.struct((r["lo"] + F.col("lo")).alias("lo"), (r["hi"] + F.col("lo")).alias("hi")))
    places = stretches.select("tid", "lo", "sid").distinct()
    return places.join(found, "sid").select("tid", F.explode(moved).alias("r")).groupBy("tid").agg(F.collect_list("r").alias("ranges"))


REPORT = "tid binary, n_removed bigint, n_spans bigint, kept_sha256 string, n_passage_bytes bigint"


def _report(batches):
    for b in batches:
        rows = []
        for tid, text, spans, shorter in zip(b.column(0), b.column(1).cast(pa.binary()), _merged(b.column(2)), _merged(b.column(3)), strict=True):
            rows.append((tid.as_py(), sum(hi - lo for lo, hi in spans), len(spans), hashlib.sha256(_kept(text.as_py() or b"", spans)).hexdigest(),
                         sum(hi - lo for lo, hi in shorter)))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.int64()], strict=True)],
                                         ["tid", "n_removed", "n_spans", "kept_sha256", "n_passage_bytes"])


def _whole(batches):
    """Rows (id, text) to what holds for a text without repeats: its size and digest."""
    for b in batches:
        texts = [t.as_py() or b"" for t in b.column(1).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([text_id(t) for t in texts], pa.binary()), pa.array([len(t) for t in texts], pa.int64()),
             pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())], ["doc_id", "tid", "n_bytes", "whole_sha256"])


PASSAGE = 200  # bytes: shorter than a passage of fifty words


def repeat_report(docs: DataFrame, least: int = 400, id_col: str = "doc_id", text_col: str = "text", passage: int = PASSAGE) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passage_bytes) for every row.

    Strings of ``least`` bytes are removed.  ``n_passage_bytes`` counts the bytes of shorter repeated passages too, strings of ``passage`` bytes
    that also start elsewhere, which are told and not removed; they are sorted first, and the strings of ``least`` bytes inside them.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    texts = rows.select("text")
    shorter = materialize(repeated_ranges(texts, min(least, passage)), "passage-ranges")
    distinct = texts.mapInArrow(_with_id, _with_id_schema(texts)).groupBy("tid").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("n"))
    cut = materialize(distinct.join(shorter, "tid"), "texts-with-passages")
    ranges = shorter if passage >= least else materialize(ranges_within(cut, least), "text-ranges")
    cut = cut.withColumnRenamed("ranges", "shorter").join(ranges, "tid", "left").select("tid", "text", "ranges", "shorter")
    cut = cut.mapInArrow(_report, REPORT)
    kind = rows.schema["doc_id"].dataType.simpleString()
    whole = rows.mapInArrow(_whole, f"doc_id {kind}, tid binary, n_bytes bigint, whole_sha256 string")
    return whole.join(cut, "tid", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"), F.coalesce("n_passage_bytes", F.lit(0)).alias("n_passage_bytes"))


def remove_repeats(docs: DataFrame, least: int, text_col: str = "text") -> DataFrame:
    """``docs`` with every repeated string of ``least`` bytes or more cut from ``text_col``; all rows and columns stay."""
    prepare(docs.sparkSession)
    ranges = materialize(repeated_ranges(docs.select(F.col(f"`{text_col}`").cast("string").alias("text")), least), "text-ranges")
    tid, spans = fresh(docs, "tid", "ranges")
    place = docs.columns.index(text_col)
    own = T.StructType([*docs.schema.fields, T.StructField(tid, T.BinaryType())])

    def identify(batches):
        for b in batches:
            ids = pa.array([text_id(t.as_py() or b"") for t in b.column(place).cast(pa.binary())], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, ids], names=[*b.schema.names, tid])

    def cut(batches):
        for b in batches:
            out = []
            for text, found in zip(b.column(place).cast(pa.binary()), _merged(b.column(b.num_columns - 1)), strict=True):
                data = text.as_py()
                out.append(data if data is None or not found else _kept(data, _whole_characters(data, found)))
            cols = [pa.array(out, pa.binary()).cast(pa.string()) if i == place else b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1])

    joined = docs.mapInArrow(identify, own).join(ranges.select(F.col("tid").alias(tid), F.col("ranges").alias(spans)), tid, "left")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(spans)).mapInArrow(cut, docs.schema)
