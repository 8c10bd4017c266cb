"""Token counts: the libraries encode batches balanced by bytes and only lengths leave the task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices
from .tokenizing import vocabulary

LIMIT = 2048


def count(docs: DataFrame, path: str, limit: int = LIMIT, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: ``id``, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).

    Whole texts are counted as the library of the tokenizer file ``path`` (``.json`` or ``.model``) encodes them, without added
    tokens; special strings inside texts follow its default. A null text is an empty one: 0 bytes, 0 tokens, not over the limit.
    Rows are handled one by one: repeated rows and repeated or null ids give as many rows, other columns are not read, and an empty
    table gives no rows. Texts are split where that cannot change a token, and equal stretches are counted once; one without such a
    place goes to the library whole, however long.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for part in slices(batches, "value"):
            texts = [t or "" for t in part["value"].to_pylist()]
            tokens = words.counts(texts)
            yield pa.RecordBatch.from_arrays(
                [part["key"], pa.array([len(t) if t.isascii() else len(t.encode()) for t in texts], pa.int64()),
                 pa.array(tokens), pa.array(tokens > limit)], names=[id, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(docs[id].alias("key"), docs[text].alias("value")).mapInArrow(
        run, f"`{id}` {dict(docs.dtypes)[id]}, n_bytes long, n_tokens long, over_limit boolean")
