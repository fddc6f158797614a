"""The registered query that encodes and decodes. SQL has no tokenizer, so tests compare it with the library."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from lakeops.llm.bpe import compile_lexicon, encode
from lakeops.llm.registry import query, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@query("op11_transducer_bpe")
def op11_transducer_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    made = compile_lexicon(docs, TOKENIZER)
    rows = encode(docs, TOKENIZER, made["uri"] if made else None, decoded=True)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
