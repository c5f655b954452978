"""SentencePiece encoding and decoding of a table of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tachoflow.llm.pieces import Encoder, Vocabulary
from tachoflow.llm.tables import giving_back
from tachoflow.llm.words import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text whose new segments are indexed together.
BATCH_BYTES = 2 << 20


def encoded(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Piece ids of every whole text.

    ``docs`` has doc_id and text; other columns are ignored. ``model`` is the path of the
    vocabulary on every executor. Returns one row per row: doc_id, n_tokens, ids, and
    round_trip (whether decoding gives the text back).

    A null text has null ids, 0 tokens and no round_trip; an empty text has no ids and comes
    back. A space mark (U+2581) in a text is encoded as a space, so such a text does not come
    back. Repeated rows are encoded alike.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(Vocabulary(model))
            for part in slices(batch["text"], BATCH_BYTES):
                column = batch["text"].slice(part.first, part.count)
                missing = np.asarray(column.is_null().to_numpy(zero_copy_only=False), bool)
                texts = [x or "" for x in column.to_pylist()]
                ids = encoder.encode(texts)
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                same = [encoder.decode(x) == t for x, t in zip(ids, texts, strict=True)]
                values = pa.array(np.concatenate(ids))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(part.first, part.count),
                        pa.array(np.diff(offsets).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets, mask=np.append(missing, False)), values),
                        pa.array(same, pa.bool_(), mask=missing),
                    ],
                    ["doc_id", "n_tokens", "ids", "round_trip"],
                )

    return docs.mapInArrow(giving_back(run), "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def decoded(tokens: DataFrame, model: str = MODEL) -> DataFrame:
    """Texts of rows with doc_id and ids. Null ids give a null text, no ids an empty one."""
    tokens = tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(Vocabulary(model))
            texts = [None if x is None else encoder.decode(np.array(x, np.int64)) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.mapInArrow(giving_back(run), "doc_id long, text string")
