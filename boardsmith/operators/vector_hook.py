"""U4 with the caller's model: texts to vectors by a function that takes a list of texts.

``load`` runs once in each Python worker and returns the function; vectors come back as ``array<float>`` of a fixed width.
A batch that fails, or returns something else than one vector of that width for each text, is halved until the texts that fail are
alone: they get a null vector and the error, the others their vectors.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Encode = Callable[[list[str]], "list | np.ndarray"]


def _vectors(encode: Encode, texts: list[str], width: int) -> list[tuple[np.ndarray | None, str | None]]:
    """(vector, error) of each text."""
    try:
        out = np.asarray(encode(texts), np.float32)
        if out.shape != (len(texts), width):
            raise ValueError(f"the hook returned shape {out.shape}, not {(len(texts), width)}")
        if not np.isfinite(out).all():
            raise ValueError("the hook returned a value that is not finite")
        return [(v, None) for v in out]
    except Exception as e:  # noqa: BLE001 - the hook isolates any failure
        if len(texts) == 1:
            return [(None, f"{type(e).__name__}: {e}")]
        half = len(texts) // 2
        return _vectors(encode, texts[:half], width) + _vectors(encode, texts[half:], width)


_LOADED: dict[str, Encode] = {}  # by the call of ``hook_vectors``, as functions arrive in a worker anew with each task


def hook_vectors(df: DataFrame, load: Callable[[], Encode], width: int, text_col: str = "content", out: str = "content_vector",
                 error: str = "vector_error", batch: int = 256) -> DataFrame:
    """``df`` with ``out`` (array<float>, null where the text is null or failed) and ``error``."""
    place, call = df.columns.index(text_col), uuid.uuid4().hex
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.FloatType())), T.StructField(error, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if call not in _LOADED:
            _LOADED[call] = load()
        for b in batches:
            texts = b.column(place).to_pylist()
            there = [i for i, t in enumerate(texts) if t is not None]
            vectors, errors = [None] * len(texts), [None] * len(texts)
            for a in range(0, len(there), batch):
                own = there[a:a + batch]
                for i, (v, e) in zip(own, _vectors(_LOADED[call], [texts[i] for i in own], width), strict=True):
                    vectors[i], errors[i] = v, e
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(vectors, pa.list_(pa.float32())), pa.array(errors, pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)
