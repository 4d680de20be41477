"""Token counts of whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame

BYTE_BPE = "byte_bpe_50k.json"


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = BYTE_BPE, limit: int = 512, path: str | None = None) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every row.

    An Arrow function without a shuffle: a batch is cut into runs of about 1 MB
    of text, each text into chunks at places no token crosses, and only lengths
    return. Null text: counts of the empty text (0). Null ids, repeated rows
    and ids are kept as they are; an empty table gives an empty table; other
    columns are ignored. A text of any length is encoded whole.
    """
    rows = docs.select(docs[id_col].alias("_id"), docs[text_col].cast("string").alias("_text"))
    kind = dict(rows.dtypes)["_id"]

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        from newsloom.llm.encoding import encoder
        from newsloom.llm.kernels import slices

        own = encoder(tokenizer, path)
        for batch in batches:
            for part in slices(batch, "_text", 1_000_000):
                n = pa.array(own.lengths(part.column("_text")), pa.int64())
                size = pc.fill_null(pc.binary_length(part.column("_text")), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("_id"), size, n, pc.greater(n, limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
