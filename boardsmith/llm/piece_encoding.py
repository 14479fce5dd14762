"""Encoding and decoding by a merge-type SentencePiece vocabulary.

A score-ordered agenda of adjacent symbol pairs merges the best pair first (leftmost on ties) until no pair is in
the vocabulary; symbols outside it become byte pieces.  A piece never holds a space mark after another
character, nor any character that the vocabulary lacks, nor (where its pieces say so) a letter beside a punctuation
mark, so a text falls into independent chunks there and equal chunks are merged once (bounded cache).  In each Arrow batch the chunks merged for the first time are
checked against the library, whose ids win should they ever differ, and every text is decoded by the library.

Defined cases: null text counts as empty (no ids, empty decoded text); null or repeated ids give one row
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardsmith.llm.common import prepare
from boardsmith.llm.tokens import Generations

SPACE = "▁"  # fixed value: the library's mark for a space
_PROBE = "  a  b\tc"
FLAT_CHARS = 64  # up to this length the least of a list is found sooner than a heap is kept


class Agenda:
    def __init__(self, path: str, capacity: int = 500_000):
        import sentencepiece

        sp = self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        scores, self.ids, chars = {}, {}, set()
        for i in range(sp.get_piece_size()):
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)):
                piece = sp.id_to_piece(i)
                scores[piece], self.ids[piece] = sp.get_score(i), i
                chars.update(piece)
        places = {score: k for k, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.order = {piece: places[score] for piece, score in scores.items()}  # the best score is 0, equal scores are equal
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        inner = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        hard = "".join(c for c in "\n\t" if c not in chars)
        apart = re.escape(self._apart(chars))
        forms = [f"[{hard}]"] * bool(hard) + [f"{SPACE}*[^{SPACE}{hard}{apart}]+"] + [f"{SPACE}*[{apart}]+"] * bool(apart) + [f"{SPACE}+"]
        self.split = re.compile(r"(?s).+" if inner else "|".join(forms))
        # Chunks without a space mark in front are checked behind a character that is a chunk of its own.
        self.before = "" if inner else hard[:1]
        self.before_ids = sp.encode(self.before) if self.before else []
        self.plain = sp.normalize(_PROBE) == SPACE + _PROBE.replace(" ", SPACE)
        self.fresh: list[tuple[str, list[int]]] = []
        self.chunks = Generations(self._new, capacity)
        self.disagreed = 0

    def _apart(self, chars: set[str]) -> str:
        """Characters that no piece joins, directly or through others, to any but their own: no merge crosses between them and the rest.

        Whole groups of joined characters but the largest one, those with an ASCII character: marks that often stand beside words.
        """
        beside: dict[str, set[str]] = {c: set() for c in chars if c != SPACE}
        for piece in self.ids:
            for a, b in zip(piece, piece[1:]):
                if a != SPACE:
                    beside[a].add(b)
                    beside[b].add(a)
        groups, left = [], set(beside)
        while left:
            group, edge = set(), {left.pop()}
            while edge:
                group |= edge
                edge = set().union(*(beside[c] for c in edge)) - group
            left -= group
            groups.append(group)
        largest = max(groups, key=len, default=set())
        return "".join(sorted(c for g in groups if g is not largest and any(map(str.isascii, g)) for c in g))

    def merge(self, chunk: str) -> list[int]:
        """Ids of one chunk: the best-scored adjacent pair is merged until none is left."""
        symbols = self._flat(chunk) if len(chunk) <= FLAT_CHARS else self._heap(chunk)
        ids = list(map(self.ids.get, symbols))
        if None in ids:
            ids = [i for s, found in zip(symbols, ids) for i in ([found] if found is not None else [self.byte_ids[b] for b in s.encode()])]
        return ids

    def _flat(self, chunk: str) -> list[str]:
        """The agenda of a short chunk is a plain list, the score orders of its pairs from left to right."""
        order, none = self.order.get, len(self.order)
        symbols = list(chunk)
        agenda = [order(chunk[i:i + 2], none) for i in range(len(chunk) - 1)]
        while agenda and (best := min(agenda)) < none:
            k = agenda.index(best)
            joined = symbols[k] = symbols[k] + symbols.pop(k + 1)
            del agenda[k]
            if k < len(agenda):
                agenda[k] = order(joined + symbols[k + 1], none)
            if k:
                agenda[k - 1] = order(symbols[k - 1] + joined, none)
        return symbols

    def _heap(self, chunk: str) -> list[str]:
        """The agenda of a long chunk is a heap of (score order, start, middle, end); ``end`` and ``left`` link the spans left over."""
        order, n = self.order.get, len(chunk)
        end, left = list(range(1, n + 1)), list(range(-1, n))
        agenda = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := order(chunk[i:i + 2])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, i, j, stop = heapq.heappop(agenda)
            if end[i] != j or end[j] != stop:
                continue  # one side has been merged elsewhere since
            end[i], end[j], left[stop] = stop, 0, i
            if stop < n and (r := order(chunk[i:end[stop]])) is not None:
                heapq.heappush(agenda, (r, i, stop, end[stop]))
            if i and (r := order(chunk[left[i]:stop])) is not None:
                heapq.heappush(agenda, (r, left[i], i, stop))
        symbols, i = [], 0
        while i < n:
            symbols.append(chunk[i:end[i]])
            i = end[i]
        return symbols

    def _new(self, chunk: str) -> str:
        """The chunk's ids as decimal numbers joined by commas."""
        ids = self.merge(chunk)
        self.fresh.append((chunk, ids))
        return ",".join(map(str, ids))

    def check(self) -> None:
        """Hold the chunks merged since the last call against the library.

        It adds a first space mark itself; a chunk without one is asked for behind ``before``, whose ids are known.
        """
        asked = [(c, ids, c[1:] if c.startswith(SPACE) else self.before + c) for c, ids in self.fresh if c != SPACE and (c.startswith(SPACE) or self.before)]
        if asked:  # a lone mark can't be asked for
            told = self.lib.encode([t.replace(SPACE, " ") for _, _, t in asked], num_threads=1)
            for (chunk, ids, _), lib in zip(asked, told, strict=True):
                lib = lib if chunk.startswith(SPACE) else lib[len(self.before_ids):]
                if ids != lib:
                    self.chunks[chunk] = ",".join(map(str, lib))
                    self.disagreed += 1
        self.fresh.clear()
        self.chunks.trim()

    def parts(self, text: str) -> list[str]:
        norm = SPACE + text.replace(" ", SPACE) if self.plain and text else self.lib.normalize(text) if text else ""
        return self.split.findall(norm)


_LOADED: dict[str, Agenda] = {}


def agenda(path: str) -> Agenda:
    if path not in _LOADED:
        _LOADED[path] = Agenda(path)
    return _LOADED[path]


SLICE_CHARS = 2_000_000


def _slices(texts: list[str]):
    """Runs of texts of about ``SLICE_CHARS``, so that a batch of long texts is not held in pieces all at once."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= SLICE_CHARS:
            yield run
            run, size = [], 0
    if run:
        yield run


def _encode(path: str, with_ids: bool):
    def run(batches):
        a = agenda(path)
        for b in batches:
            rows = []
            for texts in _slices([t.as_py() or "" for t in b.column(1)]):
                before = a.disagreed
                split = [a.parts(t) for t in texts]
                merged = [list(map(a.chunks.__getitem__, parts)) for parts in split]
                a.check()
                if a.disagreed > before:
                    merged = [list(map(a.chunks.__getitem__, parts)) for parts in split]
                for chunks in merged:
                    shown = ",".join(chunks)
                    ids = list(map(int, shown.split(","))) if shown else []
                    decoded = a.lib.decode(ids) if ids else ""
                    rows.append((len(ids), hashlib.sha256(shown.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), *((ids, decoded) if with_ids else ())))
            names, kinds = ["n_tokens", "ids_sha256", "decoded_sha256"], [pa.int64(), pa.string(), pa.string()]
            if with_ids:
                names, kinds = [*names, "ids", "decoded"], [*kinds, pa.list_(pa.int32()), pa.string()]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], ["doc_id", *names])

    return run


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row; ``with_ids`` adds the ids and the decoded text."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(_encode(model_path, with_ids), schema + (", ids array<int>, decoded string" if with_ids else ""))
