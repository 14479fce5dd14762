"""Token ids of whole texts by a public ``tokenizers`` file, with a bounded cache of distinct words.

The cache applies to byte-level BPE with word ends, lower case and dropped white space: there no token crosses
white space, so a text's ids are its words' ids one after another.  A word met for the first time is split by the
file's own pattern and each part goes through the library's model; words outside a plain Latin range, or that hold
the start of a special token, go through the whole library.  Any other file is encoded whole, text by text.
"""

from __future__ import annotations

import array
import hashlib
import json
import os
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# The pre-token pattern of the supported kind of file, and the range in which lower-casing and
# normalisation work character by character.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN = regex.compile("[\x21-\x7e¡-įı-ɏ]*")
PRE = regex.compile(PRE_TOKEN)


class Generations(dict):
    """A cache of two generations: when the young one is full it becomes the old one, whose entries return on use."""

    def __init__(self, make, capacity: int = 300_000):
        super().__init__()
        self.make, self.capacity, self.old = make, capacity, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > self.capacity:
            self.old = dict(self)
            self.clear()


def byte_symbols() -> dict[int, str]:
    """Byte-level BPE writes each byte as a printable character: itself where it has one, else the next free one from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _word_kind(spec: dict) -> bool:
    parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    norm = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    return (
        norm == ["NFC", "Replace", "Lowercase"] and len(parts) == 2 and parts[0].get("pattern") == {"Regex": PRE_TOKEN}
        and parts[0].get("behavior") == "Removed" and parts[1].get("type") == "ByteLevel" and not parts[1].get("add_prefix_space")
        and spec["model"].get("type") == "BPE" and spec.get("truncation") is None and spec.get("padding") is None
        and all(t["content"].startswith("<|") and not any(map(str.isspace, t["content"])) for t in spec.get("added_tokens", []))
        and not any(t.get("lstrip") or t.get("rstrip") or t.get("normalized") for t in spec.get("added_tokens", [])))


class Ids:
    """``ids(text)``: little-endian unsigned 16- or 32-bit ids of a UTF-8 text, without added begin or end ids."""

    def __init__(self, path: str, capacity: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.kind = os.path.splitext(path)[1]
        if self.kind == ".model":
            import sentencepiece

            self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
            size, self.by_word = self.lib.get_piece_size(), False
        else:
            from tokenizers import Tokenizer

            self.lib = Tokenizer.from_file(path)
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            size, self.by_word = self.lib.get_vocab_size(with_added_tokens=True), _word_kind(spec)
        self.dtype = "<u2" if size <= 1 << 16 else "<u4"
        self.width = int(self.dtype[2])
        self.code = next(c for c in "HIL" if array.array(c).itemsize == self.width)
        if self.by_word:
            self.symbols, self.tokenize = byte_symbols(), self.lib.model.tokenize
            self.parts = Generations(self._part, capacity)
            self.words = Generations(self._word, capacity)

    def _pack(self, ids) -> bytes:
        out = array.array(self.code, ids)
        if sys.byteorder != "little":
            out.byteswap()
        return out.tobytes()

    def _part(self, part: str) -> bytes:
        return self._pack([t.id for t in self.tokenize(part.encode().decode("latin-1").translate(self.symbols))])

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if text.isascii() and text.isalpha():  # one part, whose bytes are written as they are
            return self._pack([t.id for t in self.tokenize(text.lower())])
        if "<|" in text or not PLAIN.fullmatch(text):
            return self._pack(self.lib.encode(text, add_special_tokens=False).ids)
        parts = PRE.findall(text.lower())
        return self._part(parts[0]) if len(parts) == 1 else b"".join(map(self.parts.__getitem__, parts))  # a single part is kept once, as the word

    def ids(self, text: bytes) -> bytes:
        if not self.by_word:
            plain = text.decode()
            return self._pack(self.lib.encode(plain) if self.kind == ".model" else self.lib.encode(plain, add_special_tokens=False).ids)
        out = b"".join(map(self.words.__getitem__, (text if b"<|" in text else text.lower()).split()))
        self.words.trim()
        self.parts.trim()
        return out

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, where each text's ids end) of a string array without nulls.

        Words are told apart by Arrow, so the cache is asked once for each distinct word of the batch.
        """
        if not self.by_word or pc.any(pc.match_substring(texts, "<|")).as_py():
            each = [np.frombuffer(self.ids(t.as_py()), self.dtype) for t in texts.cast(pa.binary())]
            return np.concatenate(each) if each else np.zeros(0, self.dtype), np.cumsum([len(x) for x in each], dtype=np.int64)
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        coded = split.flatten().dictionary_encode()
        found = list(map(self.words.__getitem__, coded.dictionary.cast(pa.binary()).to_pylist()))
        self.words.trim()
        self.parts.trim()
        pool = np.frombuffer(b"".join(found), self.dtype)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.width
        starts = np.cumsum(sizes) - sizes
        which = coded.indices.to_numpy()
        counts = sizes[which]
        ends = np.cumsum(counts)
        ids = pool[np.repeat(starts[which] - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)]
        words = np.cumsum(pc.list_value_length(split).to_numpy())
        return ids, np.append(0, ends)[words]


_LOADED: dict[str, Ids] = {}


def encoder(path: str) -> Ids:
    """The encoder for ``path``, loaded once in each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Ids(path)
    return _LOADED[path]


def file_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()
