"""Token counts from distinct pre-tokens, without a list of ids."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from farelane.llm.texts import slices
from farelane.llm.tokens import Pieces


def count_tokens(
    docs: DataFrame, tokenizer: str, limit: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` for each row of ``docs``.

    ``tokenizer`` is the path of a file of the tokenizers library, on every executor. Each slice of
    documents is reduced to its distinct pre-tokens; each of them is encoded once and only its
    number of pieces kept, which is joined to the places of the pre-token by its number in the
    slice and summed for each document. The join is within the slice, so nothing is shuffled: the
    pairs of document and pre-token are several times the size of the texts.

    Null text counts as empty: 0 bytes, 0 tokens. Rows are counted each for itself, so repeated
    rows and null ids stay; an empty table gives no row. Other columns are not read.
    """

    def count(batches):
        for batch in slices(batches):
            n_tokens = Pieces(batch.column("text"), tokenizer, with_ids=False).counts()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pc.binary_length(batch.column("text")).cast(pa.int64()),
                    pa.array(n_tokens),
                    pa.array(n_tokens > limit),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    ids = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        count, f"doc_id {ids}, n_bytes long, n_tokens long, over_limit boolean"
    )
