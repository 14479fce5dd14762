"""H12 for phrases: leftmost-longest replacement of words and multi-word phrases by a token trie.

A lexicon of up to ``BLOCK_BYTES`` is a trie in every task; it marks, for every word of a text, the longest phrase that starts there.
For a larger one every run of words that is as long as some phrase is a row, which Spark joins with the phrases, so no
task holds the lexicon; the texts are written once with a row number, by which the marks come back.  The last step walks the
text from the left, takes the phrase marked at each word and goes on behind it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardsmith.functions.util import pieces
from boardsmith.session import materialize

BLOCK_BYTES = 16_000_000  # phrases and replacements of a trie
END = ""  # no word is empty, so it can mark the end of a phrase in a trie


def words(text: str) -> list[str]:
    return text.split(" ")


def trie(rows) -> dict:
    """Nested dictionaries by lower-cased word; the replacement under ``END``.  Of equal phrases the smallest replacement holds."""
    root: dict = {}
    for phrase, replacement in sorted(rows, reverse=True):
        at = root
        for w in phrase.lower().split():
            at = at.setdefault(w, {})
        if at is not root:
            at[END] = replacement
    return root


def longest(root: dict, found: list[str], start: int) -> tuple[int, str] | None:
    """(words, replacement) of the longest phrase that starts at a word."""
    at, best = root, None
    for i in range(start, len(found)):
        at = at.get(found[i]) if found[i] else None
        if at is None:
            break
        if END in at:
            best = i + 1 - start, at[END]
    return best


def _marked(shared, place: int, marks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = shared.value
        for b in (p for whole in batches for p in pieces(whole, 1_000_000)):
            out = []
            for text in b.column(place).to_pylist():
                found = [w.lower() for w in words(text or "")]
                hits = [(i, longest(root, found, i)) for i, w in enumerate(found) if w in root]
                out.append([{"at": i, "n": hit[0], "put": hit[1]} for i, hit in hits if hit])
            cols = list(b.columns)
            cols[marks] = pa.array(out, b.schema.field(marks).type)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return run


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, v) -> (phrase, n, k, v): the phrase's lower-cased words, parted by one space."""
    for b in (p for whole in batches for p in pieces(whole, 1_000_000)):
        found = [k.lower().split() for k in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([" ".join(f) for f in found], pa.string()), pa.array([len(f) for f in found], pa.int32()), b.column(0), b.column(1)], names=["phrase", "n", "k", "v"])


def _runs_of_words(lengths: list[int]):
    """(_row, text) -> (_row, at, n, phrase) for every run of words of one of these lengths."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (p for whole in batches for p in pieces(whole, 250_000)):
            rows, ats, sizes, runs = [], [], [], []
            for row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = [w.lower() for w in words(text or "")]
                for n in lengths:
                    for at in range(len(found) - n + 1):
                        if all(own := found[at:at + n]):
                            rows.append(row)
                            ats.append(at)
                            sizes.append(n)
                            runs.append(" ".join(own))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(ats, pa.int32()), pa.array(sizes, pa.int32()), pa.array(runs, pa.string())], names=["_row", "at", "n", "phrase"])

    return run


def _replaced(place: int, marks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (p for whole in batches for p in pieces(whole, 1_000_000)):
            out = []
            for text, held in zip(b.column(place).to_pylist(), b.column(marks).to_pylist(), strict=True):
                if not held:
                    out.append(text)
                    continue
                at = {m["at"]: (m["n"], m["put"]) for m in sorted(held, key=lambda m: m["n"])}  # the longest of a word
                found, i, parts = words(text), 0, []
                while i < len(found):
                    n, put = at.get(i, (1, found[i]))
                    parts.append(put)
                    i += n
                out.append(" ".join(parts))
            cols = [c for i, c in enumerate(b.columns) if i != marks]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(out, pa.string())], names=[*[n for i, n in enumerate(b.schema.names) if i != marks], "_out"])

    return run


def phrase_replace(df: DataFrame, text_col: str, lexicon: DataFrame, out: str = "text_out", key: str = "word", value: str = "replacement",
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``df`` with ``out``: its text with every phrase of the lexicon replaced, longest first from the left.

    Words are parted by single spaces and compared in lower case; a phrase's words are parted by white space.  A null text stays null.
    """
    spark = df.sparkSession
    lex = lexicon.select(F.col(key).alias("k"), F.col(value).alias("v")).where("k IS NOT NULL AND v IS NOT NULL")
    n_bytes, n = lex.agg(F.coalesce(F.sum(F.octet_length("k") + F.octet_length("v")), F.lit(0)), F.count(F.lit(1))).first()
    mark = T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("put", T.StringType())]))
    place, marks = df.columns.index(text_col), len(df.columns)
    if n_bytes + 64 * n <= block_bytes:
        rows = [tuple(r) for r in lex.collect()]  # ``block_bytes`` at most
        schema = T.StructType([*df.schema.fields, T.StructField("_marks", mark)])
        found = df.withColumn("_marks", F.lit(None).cast(mark)).mapInArrow(_marked(spark.sparkContext.broadcast(trie(rows)), place, marks), schema)
    else:
        lex = lex.mapInArrow(_phrases, "phrase string, n int, k string, v string").where("n > 0")
        # Of equal phrases the first by (phrase, replacement) holds, as in a trie.
        lex = materialize(lex.groupBy("phrase", "n").agg(F.min(F.struct("k", "v"))["v"].alias("put")), "phrases")
        lengths = sorted(r[0] for r in lex.select("n").distinct().collect())
        texts = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "texts")  # written, so that the numbers stay
        runs = texts.select("_row", F.col(f"`{text_col}`")).mapInArrow(_runs_of_words(lengths), "_row bigint, at int, n int, phrase string")
        hits = runs.join(lex, ["phrase", "n"]).groupBy("_row").agg(F.collect_list(F.struct("at", "n", "put")).alias("_marks"))
        found = texts.join(hits, "_row", "left").select(*[F.col(f"`{c}`") for c in df.columns], "_marks")
    done = T.StructType([*df.schema.fields, T.StructField("_out", T.StringType())])
    result = found.mapInArrow(_replaced(place, marks), done)
    return result.select(*[F.col(f"`{c}`") for c in df.columns if c != out], F.col("_out").alias(out))
