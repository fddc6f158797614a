"""The registered packing and token store queries. SQL has no tokenizer, so tests compare them with plain Python."""

from __future__ import annotations

import public_tokenizers

from lakeops.llm.packing import packed
from lakeops.llm.registry import query, table
from lakeops.llm.token_store import new_store_folder, read_store, write_store

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@query("op1_best_fit_packing")
def op1_best_fit_packing(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"), TOKENIZER)


@query("op4_token_store")
def op4_token_store(spark, sf_dir):
    return read_store(write_store(table(spark, sf_dir, "documents"), TOKENIZER, new_store_folder(spark)))
