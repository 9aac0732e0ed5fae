"""Parameters that the registered queries and the pipeline share."""

from __future__ import annotations

import public_tokenizers

# The vocabulary, the same as ranks, and its pattern.
TOKENIZER = {
    "vocabulary": public_tokenizers.path("byte_bpe_50k.json"),
    "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
    "pattern": public_tokenizers.PATTERN,
}
# Decides all surrogates; a user of the operator brings one of their own.
SURROGATE_KEY = "documents"
