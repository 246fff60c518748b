"""Token, corpus and parameter estimates as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: characters of a token.
CHARS_PER_TOKEN = 4.45


def tokens_of_chars(chars: Column) -> Column:
    return F.floor(chars / CHARS_PER_TOKEN)


def tokens_of_gb(gb: Column, bytes_per_char: float = 3.0, chars_per_token: float = CHARS_PER_TOKEN) -> Column:
    return F.floor(gb * 1e9 / bytes_per_char / chars_per_token)


def gb_of_tokens(tokens: Column, bytes_per_char: float = 3.0, chars_per_token: float = CHARS_PER_TOKEN) -> Column:
    return tokens * chars_per_token * bytes_per_char / 1e9


def chinchilla_params(tokens: Column, per_param: float = 20.0) -> Column:
    return tokens / per_param


def parameters(vocab: Column, width: Column, layers: Column, hidden: Column, heads: Column, kv_heads: Column, tied: Column) -> Column:
    """Weights of a decoder with gated feed-forward blocks, grouped key-value heads and RMS norms."""
    head = (width / heads).cast("long")
    attention = width * width * 2 + width * head * kv_heads * 2
    block = attention + 3 * width * hidden + 2 * width
    return (vocab * width * F.when(tied, 1).otherwise(2) + layers * block + width).cast("long")
