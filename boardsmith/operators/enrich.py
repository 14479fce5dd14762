"""The enrichment hook.  A caller-supplied ``fn(prompt) -> reply`` runs over prompt
batches in Arrow-batched Python workers, a few MB at a time; an exception becomes a null
reply plus an error text, so one failed call never fails the job (the reference prints
and moves on).  No hosted service is called by this package.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from boardsmith.functions.util import pieces

RESPONSES_SCHEMA = "batch_id bigint, response string, error string"


def enrich_batches(prompts: DataFrame, fn: Callable[[int, str], str], batch_col: str = "batch_id", prompt_col: str = "prompt") -> DataFrame:
    """(batch_id, prompt) -> (batch_id, response, error)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in it for p in pieces(b, 1_000_000)):
            out_resp, out_err = [], []
            for b, p in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                try:
                    reply = fn(int(b), p)
                    if reply is not None and not isinstance(reply, str):
                        raise TypeError(f"the hook returned {type(reply).__name__}, not text")
                    out_resp.append(reply)
                    out_err.append(None)
                except Exception as e:  # noqa: BLE001 - the hook isolates any failure
                    out_resp.append(None)
                    out_err.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(out_resp, pa.string()), pa.array(out_err, pa.string())], names=["batch_id", "response", "error"])

    return prompts.select(batch_col, prompt_col).mapInArrow(run, RESPONSES_SCHEMA)


class EchoFailure(RuntimeError):
    pass


def echo(batch_id: int, prompt: str, fail_every: int = 13) -> str:
    """Shipped deterministic hook: the prompt echoed under a line-count header; every
    ``fail_every``-th batch raises, to exercise error isolation."""
    if fail_every and batch_id % fail_every == 0:
        raise EchoFailure(f"batch {batch_id} refused")
    return f"{prompt.count(chr(10))} lines\n{prompt}"
