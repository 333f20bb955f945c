"""Token counts with a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


def encoder(path: str) -> tiktoken.Encoding:
    """The vocabulary at ``path``, read once in a process."""
    kept = sys.__dict__.setdefault("_millrace_encoders", {})
    if path not in kept:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        kept[path] = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return kept[path]


def _counts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    for b in batches:
        n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(b.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=[*b.schema.names[:-1], "n_tokens"])


def count_tokens(docs: DataFrame, keep: list[str], text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` and ``n_tokens``; null and empty texts have none. Whole texts are counted."""
    d = docs.select(*keep, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields[:-1]) + ", n_tokens bigint"
    return d.mapInArrow(lambda b: _counts(b, vocabulary), schema)
