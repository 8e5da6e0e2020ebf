"""A model call as an operator: bounded concurrency in each partition, results resumable by id."""

from __future__ import annotations

import asyncio
import json
from collections.abc import Awaitable, Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

Rollout = Callable[[str, int], Awaitable[dict]]
RESULT = "doc_id long, rollout_results string, n_rollouts int"


async def dummy(prompt: str, rollout: int) -> dict:
    """A backend that answers at once: a fixed reply with made-up usage."""
    request = {"messages": [{"role": "user", "content": prompt}], "rollout": rollout}
    return {"text": "This is a dummy reply.", "finish_reason": "stop", "usage": {"prompt_tokens": len(str(request)) // 4, "completion_tokens": 100}}


async def with_retries(call: Rollout, prompt: str, rollout: int, attempts: int = 6, wait: float = 5.0) -> dict | None:
    """Connection errors are tried again after 5, 10, 20 ... seconds; a bad request gives None."""
    for k in range(attempts):
        try:
            return await call(prompt, rollout)
        except ConnectionError:
            if k + 1 < attempts:
                await asyncio.sleep(wait * 2**k)
        except ValueError:
            return None
    return None


def rollouts(df: DataFrame, call: Rollout = dummy, count: int = 1, concurrency: int = 32, done: DataFrame | None = None, wait: float = 5.0) -> DataFrame:
    """``RESULT`` rows for every document of ``(doc_id, text)``; those in ``done`` are left out.

    A document all of whose rollouts fail is not in the result.
    """
    todo = df.select("doc_id", "text").where("text is not null")
    if done is not None:
        todo = todo.join(done.select("doc_id"), "doc_id", "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        async def answer(texts: list[str]) -> list[list[dict | None]]:
            gate = asyncio.Semaphore(concurrency)

            async def one(text: str, k: int) -> dict | None:
                async with gate:
                    return await with_retries(call, text, k, wait=wait)

            return await asyncio.gather(*[asyncio.gather(*[one(t, k) for k in range(count)]) for t in texts])

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            got = asyncio.run(answer(texts))
            rows = [(i, json.dumps([x for x in g if x is not None]), sum(x is not None for x in g)) for i, g in zip(ids, got)]
            rows = [r for r in rows if r[2]]
            cols = list(zip(*rows)) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32())], ["doc_id", "rollout_results", "n_rollouts"])

    return todo.mapInArrow(run, RESULT)
