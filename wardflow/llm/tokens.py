"""Token counts: lengths of whole texts in tokens, and nothing else, from Arrow
batches.

Rows come in batches bounded by bytes; inside one, neighbouring texts are cut
and encoded in runs of about equal bytes, and a text longer than a run is split
where no token can cross (see ``bytebpe``), so one long text costs no more
memory than its own bytes. Only counts leave the worker.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.bytebpe import Encoder
from wardflow.llm.common import bounded_batches


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_tokens``, ``over_limit``.

    ``vocabulary`` is a file of the ``tokenizers`` library (``.json``) or of
    ``sentencepiece`` (``.model``), readable under that path on every executor.
    Null and empty texts have 0 bytes and 0 tokens; repeated rows and ids are
    counted each; an empty table gives none; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark holds the cores
        count = _sentencepiece(vocabulary) if vocabulary.endswith(".model") else _byte_level(vocabulary)
        for b in batches:
            n_bytes, n_tokens = count(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(n_tokens > limit)],
                ["id", "n_bytes", "n_tokens", "over_limit"])

    return source.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)


def _byte_level(path: str):
    def count(column):
        from wardflow.llm.common import text_buffer

        _, bytes_at = text_buffer(column)
        _, at = Encoder.of(path).encode(column)
        return np.diff(bytes_at), np.diff(at)
    return count


def _sentencepiece(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def count(column):
        texts = [t or "" for t in column.to_pylist()]
        return (np.asarray([len(t.encode()) for t in texts], np.int64),
                np.asarray([len(x) for x in model.encode(texts, num_threads=1)], np.int64))
    return count
