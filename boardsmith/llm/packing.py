"""Order-preserving packing of token streams into sequences by dynamic programming.

Documents are dealt by a digest of id and text and sorted by id; each task tokenizes its share and packs it as one stream in
bounded segments.  Window cuts are chosen among all document ends and sentence ends (and, dearer, some word ends for what
has no sentence end within a window) so that padding plus truncation penalties are least.  A window of n tokens costs capacity - n, or nothing when n is a power of
two; the best start among all windows that end at a cut is the front of a monotone queue, and the powers of two
are tried one by one.  The last two windows of a segment are not fixed; their tokens open the next.

Defined cases: a null text is an empty document (its end id only); rows that repeat an id are packed as documents
of their own, ordered by text; null ids come first; an empty table gives no rows; other columns are ignored.
A document longer than a segment is cut like any other.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardsmith.llm import tokens
from boardsmith.llm.common import prepare, shuffle_partitions

SEGMENT = 1_000_000
# Token penalties: a new sequence, a cut at a sentence end, at a word end, within a word; none at a document's end.
PER_SEQUENCE, AT_SENTENCE, AT_WORD, IN_WORD = 1, 8, 32, 64
WORD_STEP, TAIL_STEP = 256, 16  # one word end in so many tokens is offered
SLICE_CHARS = 16_000_000  # bytes of text tokenized at once
SENTENCE_ENDS = (".", "!", "?", "。", "！", "？")


def cut_classes(path: str) -> np.ndarray:
    """For each id: 2 where a sentence may end after it, 1 at a word's end, else 0."""
    from tokenizers import Tokenizer

    vocab = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    out = np.zeros(max(vocab.values()) + 1, np.uint8)
    for piece, i in vocab.items():
        word = piece.removesuffix("</w>")
        out[i] = 0 if word == piece else 2 if word.endswith(SENTENCE_ENDS) else 1
    return out


def candidates(classes: np.ndarray, ends: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions (0 and the stream's end among them) and their penalties."""
    n = len(classes)
    pen = np.full(n + 1, -1, np.int32)

    def offer(pos: np.ndarray, step: int, cost: int) -> None:
        first = np.unique(pos // step, return_index=True)[1] if step > 1 else slice(None)
        chosen = pos[first]
        pen[chosen] = np.where(pen[chosen] < 0, cost, np.minimum(pen[chosen], cost))

    offer(np.arange(WORD_STEP, n, WORD_STEP), 1, IN_WORD)
    offer(np.flatnonzero(classes >= 1) + 1, WORD_STEP, AT_WORD)
    offer(np.flatnonzero(classes == 2) + 1, 1, AT_SENTENCE)
    if last:  # the stream's tail may end in small powers of two
        offer(np.arange(n, max(0, n - 4096), -TAIL_STEP), 1, IN_WORD)
        offer(n - 2 ** np.arange(int(np.log2(max(n, 1))) + 1)[: 12], 1, IN_WORD)
    pen[ends] = 0
    pen[0] = pen[n] = 0
    pos = np.flatnonzero(pen >= 0)
    return pos, pen[pos]


def plan_cuts(pos: np.ndarray, pen: np.ndarray, capacity: int) -> list[int]:
    """Positions of the least-cost cuts from the first to the last position."""
    exact: dict[int, list[int]] = {}
    k = 1
    while k <= capacity:
        at = np.searchsorted(pos, pos - k)
        for j in np.flatnonzero((pos >= k) & (pos[at] == pos - k)).tolist():
            exact.setdefault(j, []).append(int(at[j]))
        k *= 2
    p, cost = pos.tolist(), (pen + PER_SEQUENCE).tolist()
    best, back = [0] * len(p), [0] * len(p)
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (cost so far + position, index), least first
    for j in range(1, len(p)):
        here = p[j]
        while p[queue[0][1]] < here - capacity:
            queue.popleft()
        value, i = queue[0]
        value += capacity - here
        for e in exact.get(j, ()):
            if best[e] < value:
                value, i = best[e], e
        best[j], back[j] = value + cost[j], i
        key = best[j] + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [p[-1]], len(p) - 1
    while j:
        j = back[j]
        cuts.append(p[j])
    return cuts[::-1]


class Stream:
    """Tokens that are not packed yet, with the documents they belong to."""

    def __init__(self, classes: np.ndarray, capacity: int, first_sequence: int):
        self.classes, self.capacity, self.sequence = classes, capacity, first_sequence
        self.parts: list[np.ndarray] = []
        self.docs: list[tuple[object, int, int]] = []  # id, ids of the document packed before, all its ids
        self.size = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.parts.append(ids)
        self.docs.append((doc_id, 0, len(ids)))
        self.size += len(ids)

    def flush(self, last: bool):
        """Pieces of the windows that are fixed now."""
        ids = np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint16)
        if not len(ids):
            return
        ends = np.cumsum([len(x) for x in self.parts])
        cuts = plan_cuts(*candidates(self.classes[ids], ends, last), self.capacity)
        if not last:
            cuts = cuts[:-2] if len(cuts) > 3 else cuts[:1]
        at, doc = 0, 0
        for a, b in zip(cuts, cuts[1:], strict=False):
            while at < b:
                name, before, total = self.docs[doc]
                stop = min(b, int(ends[doc]))
                piece = ids[at:stop]
                yield name, before, stop - at, zlib.crc32(piece.astype("<u4").tobytes()), total, self.sequence, at - a, piece
                if stop == ends[doc]:
                    doc += 1
                else:
                    self.docs[doc] = (name, before + stop - at, total)
                at = stop
            self.sequence += 1
        tops = ends[doc:] - at
        self.parts = [ids[at + s:at + e] for s, e in zip([0, *tops[:-1]], tops, strict=True)] if len(tops) else []
        self.docs = self.docs[doc:]
        self.size = len(ids) - at


def slices(texts: pa.Array):
    """Ranges of rows whose texts have about ``SLICE_CHARS`` bytes, each at least a row."""
    total = np.cumsum(pc.binary_length(texts).to_numpy())
    a = 0
    while a < len(total):
        z = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + SLICE_CHARS, "right")))
        yield a, z
        a = z


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _pack(path: str, capacity: int, end_id: int, with_ids: bool):
    def rows_of(pieces):
        rows = list(pieces)
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 8
        arrays = [pa.array(c) if rows else pa.array([], pa.int64()) for c in cols[:7]]
        return [*arrays, pa.array(cols[7], pa.list_(pa.int32()))] if with_ids else arrays

    def run(batches):
        enc, classes = tokens.encoder(path), cut_classes(path)
        stream = Stream(classes, capacity, TaskContext.get().partitionId() << 33)
        kind, end = None, np.array([end_id], enc.dtype)

        def out(last: bool):
            cols = rows_of(stream.flush(last))
            if len(cols[0]):
                cols[0] = cols[0].cast(kind)
                yield pa.RecordBatch.from_arrays(cols, [*NAMES, "ids"][: len(cols)])

        for b in batches:
            kind = b.column(0).type
            texts = b.column(1).fill_null("")
            for a, z in slices(texts):
                ids, ends = enc.batch(texts.slice(a, z - a))
                for name, part in zip(b.column(0).slice(a, z - a).to_pylist(), np.split(ids, ends[:-1]), strict=True):
                    stream.add(name, np.concatenate([part, end]))
                    if stream.size >= SEGMENT:
                        yield from out(False)
        yield from out(True)

    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
         with_ids: bool = False) -> DataFrame:
    """One row per piece: document, place and length in it, CRC-32 of its ids, sequence and offset there; ``with_ids`` adds the ids."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # By a digest, not by sampled ranges: every evaluation deals the same rows to the same stream.
    ordered = rows.repartition(shuffle_partitions(docs.sparkSession), F.xxhash64("doc_id", "text")).sortWithinPartitions("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return ordered.mapInArrow(_pack(tokenizer_path, capacity, end_id, with_ids), schema + (", ids array<int>" if with_ids else ""))
