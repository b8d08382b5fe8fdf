"""Text columns: name tokens and candidate identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlink.config import (
    DESCRIPTOR_TOKENS,
    MERCHANT_ALIASES,
    MIN_TOKEN_LENGTH,
    STOP_TOKENS,
)

# The token alphabet, and the characters an identifier is made
# of (an identifier counts only when none of these touches it on either side).
TOKEN = "[a-z0-9]+"
ID_CHAR = "[A-Za-z0-9_-]"
NOT_ID_CHAR = "[^A-Za-z0-9_-]"


def _token_set(text: Column, stop: tuple[str, ...]) -> Column:
    words = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    kept = F.filter(
        words, lambda w: (F.length(w) >= MIN_TOKEN_LENGTH) & ~w.isin(*stop)
    )
    return F.coalesce(
        F.sort_array(F.array_distinct(kept)), F.array().cast("array<string>")
    )


def name_tokens(text: Column, fold_case: bool = False) -> Column:
    """Sorted set of name tokens; empty for a null text.

    By default only lower-case letters and digits of the text as written form
    tokens, so capitals end a token. ``fold_case`` lower-cases the text first.
    """
    return _token_set(F.lower(text) if fold_case else text, STOP_TOKENS)


def identity_tokens(
    text: Column, aliases: tuple[tuple[str, str], ...] = MERCHANT_ALIASES
) -> Column:
    """Lower-cased tokens with descriptors dropped and merchant ``aliases`` resolved."""
    tokens = _token_set(F.lower(text), STOP_TOKENS + DESCRIPTOR_TOKENS)
    if not aliases:
        return tokens
    names = F.create_map(*[F.lit(part) for pair in aliases for part in pair])

    def resolve(word: Column) -> Column:
        return F.coalesce(F.try_element_at(names, word), word)

    return F.sort_array(F.array_distinct(F.transform(tokens, resolve)))


def id_runs(text: Column) -> Column:
    """Maximal runs of identifier characters, in text order."""
    return F.regexp_extract_all(text, F.lit(f"{ID_CHAR}+"), F.lit(0))


def id_pieces(text: Column) -> Column:
    """The text as identifier runs and the single characters between them."""
    return F.regexp_extract_all(text, F.lit(f"{ID_CHAR}+|{NOT_ID_CHAR}"), F.lit(0))


def zero_padded(number: Column, width: int) -> Column:
    """``number`` as text of at least ``width`` digits; longer numbers stay whole.

    A plain ``lpad`` would cut them, and different keys would become one.
    """
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), "0")
