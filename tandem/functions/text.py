"""Text expressions, all native Spark SQL."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that count as white space (as ranges), and the ranges whose characters
# the evaluation tokenizer sets apart (Han, phonetic symbols, full-width forms, CJK punctuation).
WHITESPACE = (
    r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
CJK_RANGES = (
    r"\x{3400}-\x{4db5}\x{4e00}-\x{9fbb}\x{f900}-\x{fa2d}\x{fa30}-\x{fa6a}\x{fa70}-\x{fad9}"
    r"\x{ff00}-\x{ffef}\x{2e80}-\x{2eff}\x{2f00}-\x{2fdf}\x{2ff0}-\x{2fff}\x{3000}-\x{303f}"
    r"\x{3100}-\x{312f}\x{31a0}-\x{31bf}\x{31c0}-\x{31ef}\x{fe10}-\x{fe1f}\x{fe30}-\x{fe4f}"
    r"\x{2600}-\x{27bf}\x{3200}-\x{33ff}"
)
# The ASCII punctuation that the evaluation tokenizer always sets apart. Full stop and comma
# are set apart after a non-digit, then before a non-digit; a hyphen is set apart after a digit.
PUNCTUATION = "!\"#$%&()*+/:;<=>?@[\\]^_`{|}~"
DIGIT_RULES = (
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
)
# Document markers, chunk length, token budget.
START_MARKER = "<|startoftext|>"
END_MARKER = "<|endoftext|>"
CHUNK_LENGTH = 500
TOKEN_BUDGET = 512


def _members(character_class: str) -> str:
    """The characters of a class written as ``\\x{..}`` code points and ranges of them."""
    found = ""
    for first, last in re.findall(r"\\x\{(\w+)\}(?:-\\x\{(\w+)\})?", character_class):
        found += "".join(map(chr, range(int(first, 16), int(last or first, 16) + 1)))
    return found


_WHITESPACE_CHARACTERS = _members(WHITESPACE)
# Java tests a class of single Latin-1 characters with one table look-up, but a union of ranges range by
# range for every character. So the classes that meet every character are spelled out one by one, and the
# unions are used only on texts that have a character beyond Latin.
_PUNCTUATION_CLASS = "[" + "".join(f"\\{ch}" for ch in PUNCTUATION) + "]"
_LATIN_BLANKS = "[" + "".join(f"\\x{ord(ch):02x}" for ch in _WHITESPACE_CHARACTERS if ord(ch) < 256) + "]+"
_WIDE = r"[\x{1680}-\x{ffef}]"
# The first digit rule, begun at the mark and not at any character before it: marks after a non-digit that is no mark stand
# alone, all others in pairs. The blanks differ from those of the rule, the tokens do not.
_MARKS = (r"([\.,])(?:(?<=[^0-9\.,][\.,])|([\.,]))", " $1 $2 ")


def strip(text: Column) -> Column:
    """Remove Unicode white space from both ends (plain ``trim`` only knows the space character)."""
    return F.btrim(text, F.lit(_WHITESPACE_CHARACTERS))


def is_filled(text: Column) -> Column:
    """Keeps rows whose text has at least one character."""
    return F.length(text) > 0


def is_usable_example(text: Column) -> Column:
    """Keeps texts that are not blank and longer than one character."""
    return (F.length(strip(text)) > 0) & (F.length(text) > 1)


def chunks(text: Column, length: int = CHUNK_LENGTH) -> Column:
    """Slices of at most ``length`` code points, in order, remainder kept; one linear pass."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{int(length)}}}"), F.lit(0))


def with_markers(text: Column) -> Column:
    """Surround a chunk with the document markers."""
    return F.concat(F.lit(START_MARKER), text, F.lit(END_MARKER))


def flatten_newlines(text: Column, mode: str = "space") -> Column:
    """One line per text: ``space`` replaces line feeds, ``remove`` strips and deletes them, ``none`` keeps."""
    if mode == "space":
        return F.replace(text, F.lit("\n"), F.lit(" "))
    if mode == "remove":
        return F.replace(strip(text), F.lit("\n"), F.lit(""))
    if mode == "none":
        return text
    raise ValueError(f"unknown newline mode {mode!r}")


def one_line(text: Column, mode: str = "space") -> Column:
    """The text without any line break that a text file reader knows: CR LF, CR and LF.

    As ``flatten_newlines`` for files of one text per line: ``remove`` strips and deletes breaks, any other mode
    replaces each by a blank, because a break that is left would shift all later lines.
    """
    if mode not in ("space", "remove", "none"):
        raise ValueError(f"unknown newline mode {mode!r}")
    breaks = "\\r\\n|\\r|\\n"
    return F.regexp_replace(strip(text), breaks, "") if mode == "remove" else F.regexp_replace(text, breaks, " ")


def file_safe(name: Column) -> Column:
    """Language or run name as used in file names."""
    return F.replace(name, F.lit(" "), F.lit("_"))


def characters(text: Column) -> Column:
    """Array of code points; empty for the empty text."""
    return F.array_remove(F.split(text, ""), "")


def distinct_characters(text: Column) -> Column:
    """Each character of the text once."""
    return F.array_distinct(characters(text))


def eval_tokens(text: Column, tokenize: str = "zh") -> Column:
    """Tokens that corpus BLEU counts.

    ``zh`` sets every CJK character and punctuation mark apart and serves all target languages;
    ``char`` takes single non-blank characters; ``none`` splits on white space only.
    """
    spaced = strip(text)
    plain = F.regexp_replace(spaced, WHITESPACE, " ")
    if tokenize == "zh":
        padded = F.regexp_replace(plain, f"[{CJK_RANGES}]", " $0 ")
        spaced = F.when(spaced.rlike(_WIDE), padded).otherwise(spaced)
        spaced = F.regexp_replace(spaced, _PUNCTUATION_CLASS, " $0 ")
        for pattern, replacement in (_MARKS, *DIGIT_RULES[1:]):
            spaced = F.regexp_replace(spaced, pattern, replacement)
    elif tokenize == "char":
        spaced = F.regexp_replace(plain, "(?s).", "$0 ")
    elif tokenize == "none":
        spaced = F.when(spaced.rlike(_WIDE), plain).otherwise(spaced)
    else:
        raise ValueError(f"unknown tokenizer {tokenize!r}")
    return F.array_remove(F.split(spaced, _LATIN_BLANKS), "")


def budgeted(tokens: Column, budget: int = TOKEN_BUDGET) -> Column:
    """The first ``budget`` tokens."""
    return F.slice(tokens, 1, budget)


def exceeds_budget(tokens: Column, budget: int = TOKEN_BUDGET) -> Column:
    """True where :func:`budgeted` dropped something."""
    return F.size(tokens) > budget


def response_ids(output_ids: Column, prompt_length: Column, special: list[int]) -> Column:
    """The generated part of a model's output: prompt ids cut off, special ids dropped."""
    tail = F.slice(output_ids, prompt_length + 1, F.greatest(F.size(output_ids) - prompt_length, F.lit(0)))
    return F.filter(tail, lambda token: ~token.isin(list(special))) if special else tail
