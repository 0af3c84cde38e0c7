"""Query of the token-id files. No SQL: a tokenizer isn't SQL; tested against the tokenizer by round trip."""

from __future__ import annotations

import public_tokenizers

from ..sources.tables import table
from .registry import register
from .token_files import token_index


@register("op9_token_id_files")
def op9_token_id_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_index(docs, vocabulary=public_tokenizers.path("word_bpe_49k.json"), end_id=1)
