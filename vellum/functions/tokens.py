"""Token counts and ids with the public tokenizers' files (their folder is a parameter)."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

TOKENIZER_DIR = "/opt/tokenizers"
TOKENIZER_FILE = "byte_bpe_50k.tiktoken"
#: Fixed value: the pre-split pattern belonging to the byte-level ranks.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@lru_cache(4)
def load_encoding(path: str):
    """An encoder ``text -> list of ids`` for a ``.tiktoken``, ``.json`` or ``.model`` file."""
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return enc.encode_ordinary
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True
        return lambda text: tok.encode(text, add_special_tokens=False).ids
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda text: sp.encode(text, num_threads=1)


def with_tokens(
    df: DataFrame,
    text: str = "text",
    count: str | None = "token_count",
    ids: str | None = None,
    eos: int | None = None,
    tokenizer_dir: str = TOKENIZER_DIR,
    tokenizer_file: str = TOKENIZER_FILE,
) -> DataFrame:
    """Add the token count and/or the token ids of ``text``; ``eos`` is appended where given.

    A null text has null count and ids.  Columns of those names are replaced.
    """
    path = os.path.join(tokenizer_dir, tokenizer_file)
    out = [c for c in (count, ids) if c]
    base = df.drop(*out)
    schema = T.StructType(list(base.schema.fields))
    if count:
        schema = schema.add(count, T.LongType())
    if ids:
        schema = schema.add(ids, T.ArrayType(T.IntegerType()))
    at = base.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_encoding(path)
        for batch in batches:
            found = [None if t is None else encode(t) for t in batch.column(at).to_pylist()]
            if eos is not None:
                found = [None if f is None else [*f, eos] for f in found]
            arrays, names = list(batch.columns), list(batch.schema.names)
            if count:
                arrays.append(pa.array([None if f is None else len(f) for f in found], pa.int64()))
                names.append(count)
            if ids:
                arrays.append(pa.array(found, pa.list_(pa.int32())))
                names.append(ids)
            yield pa.RecordBatch.from_arrays(arrays, names)

    return base.mapInArrow(run, schema)
