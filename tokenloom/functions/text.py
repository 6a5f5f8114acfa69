"""Text clean-up and byte-level pieces."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import PIECE_PATTERN, SPECIAL_TOKENS, byte_alphabet

_LATIN1 = "".join(map(chr, range(256)))
_ALPHABET = "".join(byte_alphabet())


def strip_blank_lines(text: Column) -> Column:
    """Delete every pair of newlines; the words on both sides end up glued together."""
    return F.replace(text, F.lit("\n\n"), F.lit(""))


def pieces(text: Column, add_prefix_space: bool = True) -> Column:
    """Byte-level pieces of a text, in order.

    With ``add_prefix_space`` a non-empty text that does not begin with a space gets one.
    """
    if add_prefix_space:
        text = F.when(text.rlike("^[^ ]"), F.concat(F.lit(" "), text)).otherwise(text)
    return F.regexp_extract_all(text, F.lit(PIECE_PATTERN), F.lit(0))


def _any_of(specials: Sequence[str]) -> str:
    return "|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True))


def segments(text: Column, specials: Sequence[str] = SPECIAL_TOKENS) -> Column:
    """A text cut before and after every literal special token; no empty segments."""
    if not specials:
        return F.filter(F.array(text), lambda s: s != "")
    any_special = _any_of(specials)
    # A look at one character first spares most places the whole list of alternatives.
    opening, closing = ("[" + "".join(map(re.escape, {s[k] for s in specials})) + "]" for k in (0, -1))
    cut = F.split(text, f"(?={opening})(?={any_special})|(?<={closing})(?<={any_special})")
    return F.filter(cut, lambda s: s != "")


def pieces_with_specials(text: Column, add_prefix_space: bool = False,
                         specials: Sequence[str] = SPECIAL_TOKENS) -> Column:
    """Pieces of a text in which literal special tokens stay whole.

    Each segment between special tokens is pre-tokenized by itself. Texts without any
    take the short way.
    """
    if not specials:
        return pieces(text, add_prefix_space)
    mixed = F.flatten(
        F.transform(
            segments(text, specials),
            lambda s: F.when(s.isin(*specials), F.array(s)).otherwise(
                pieces(s, add_prefix_space)
            ),
        )
    )
    return F.when(text.rlike(_any_of(specials)), mixed).otherwise(pieces(text, add_prefix_space))


def utf8_as_latin1(text: Column) -> Column:
    """One character U+0000..U+00FF per UTF-8 byte of the text."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def to_byte_symbols(text: Column) -> Column:
    """The visible byte-level spelling of a text."""
    return F.translate(utf8_as_latin1(text), _LATIN1, _ALPHABET)


def from_byte_symbols(symbols: Column) -> Column:
    """The text spelled by byte-level symbols; broken UTF-8 becomes U+FFFD."""
    raw = F.encode(F.translate(symbols, _ALPHABET, _LATIN1), "ISO-8859-1")
    return F.make_valid_utf8(raw.cast("string"))
