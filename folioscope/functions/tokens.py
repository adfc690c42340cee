"""Whitespace tokens, fixed-length runs of them, and hashed token ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.text import WHITESPACE_CLASS, as_column

# The space clean-up that decoding applies, in this order.
SPACE_CLEANUP = (
    (" .", "."),
    (" ?", "?"),
    (" !", "!"),
    (" ,", ","),
    (" ' ", "'"),
    (" n't", "n't"),
    (" 'm", "'m"),
    (" 's", "'s"),
    (" 've", "'ve"),
    (" 're", "'re"),
)


def tokenize(text: Column | str) -> Column:
    """Split at Unicode whitespace; null gives null, blank text gives no tokens."""
    pieces = F.split(as_column(text), WHITESPACE_CLASS + "+")
    return F.array_remove(pieces, "")


def fixed_chunks(tokens: Column | str, size: int) -> Column:
    """Non-overlapping runs of ``size`` tokens; the last one may be shorter."""
    tokens = as_column(tokens)
    last = F.ceil(F.size(tokens) / F.lit(size)).cast("int") - 1
    return F.when(
        F.size(tokens) > 0,
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.slice(tokens, i * size + 1, F.lit(size)),
        ),
    ).otherwise(F.array().cast("array<array<string>>"))


def detokenize(tokens: Column | str, clean_up: bool = True) -> Column:
    """Join tokens with blanks, then tidy the blanks before punctuation."""
    text = F.array_join(as_column(tokens), " ")
    if clean_up:
        for found, tidy in SPACE_CLEANUP:
            text = F.replace(text, F.lit(found), F.lit(tidy))
    return text


def pad_truncate(tokens: Column | str, positions: int = 512, pad: str = "<pad>") -> Column:
    """Exactly ``positions`` entries: cut the rest or fill with ``pad``."""
    kept = F.slice(as_column(tokens), 1, positions)
    return F.concat(kept, F.array_repeat(F.lit(pad), F.lit(positions) - F.size(kept)))


def hash_token(token: Column | str) -> Column:
    """The first 32 bits of a token's MD5 digest."""
    return F.conv(F.left(F.md5(as_column(token)), F.lit(8)), 16, 10).cast("bigint")


def hashed_dimension(code: Column, dims: int) -> Column:
    return F.pmod(code, F.lit(dims))


def hashed_sign(code: Column, dims: int) -> Column:
    return F.when(F.floor(code / F.lit(dims)) % 2 == 0, F.lit(1)).otherwise(F.lit(-1))
