"""Prompt and chat-message expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prompt texts, byte for byte. Names in braces are filled from columns.
TEMPLATES = {
    "inference": (
        "<|im_start|> system Translate the given {src_lang} words to {tgt_lang}. <|im_end|>"
        " <|im_start|> user {src_text} <|im_end|>"
    ),
    "sft": (
        "<|im_start|>system\nTranslate the given {src_lang} words into {tgt_lang}.<|im_end|>\n"
        "<|im_start|>user\n{src_text}<|im_end|>\n"
        "<|im_start|>assistant\n{tgt_text}<|im_end|>\n"
    ),
    "sft_one_line": (
        "<|im_start|>system Translate the given {src_lang} words into {tgt_lang}. <|im_end|>"
        "<|im_start|>user {src_text} <|im_end|>"
        "<|im_start|>assistant {tgt_text} <|im_end|>"
    ),
    "eval": (
        "<|im_start|> system\n"
        "    Translate the given {src_lang} words to {tgt_lang}.<|im_end|>\n"
        "    <|im_start|> user\n"
        "    {src_text}<|im_end|>\n"
        "    <|im_start|> assistant\n"
        "    "
    ),
    "completion": (
        "<|im_start|> user\n"
        "        Complete the following text: {head} <|im_end|> \n"
        "        <|im_start|> assistant\n"
        "        {tail} <|im_end|>"
    ),
}
SYSTEM_INTO = "Translate the given {src_lang} words into {tgt_lang}."
SYSTEM_TO = "Translate the given {src_lang} words to {tgt_lang}."


def fill(template: str, values: Mapping[str, Column]) -> Column:
    """Concatenate the template's literal parts and the columns named in braces; NULL if any is NULL."""
    parts = re.split(r"\{(\w+)\}", template)
    pieces = [
        values[part] if position % 2 else F.lit(part)
        for position, part in enumerate(parts)
        if position % 2 or part
    ]
    return F.concat(*pieces)


def prompt(template: str, **columns: Column) -> Column:
    """A named template filled from ``columns``; by default each placeholder is the column of that name."""
    text = TEMPLATES[template]
    names = re.findall(r"\{(\w+)\}", text)
    return fill(text, {name: columns.get(name, F.col(name)) for name in names})


def message(role: str, content: Column) -> Column:
    """One chat message."""
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def chat(src_lang: Column, tgt_lang: Column, text: Column, system: str = SYSTEM_INTO) -> Column:
    """System and user message asking for one translation."""
    instruction = fill(system, {"src_lang": src_lang, "tgt_lang": tgt_lang})
    return F.array(message("system", instruction), message("user", text))


def chat_both_ways(
    left_lang: Column, right_lang: Column, left: Column, right: Column, system: str = SYSTEM_TO
) -> Column:
    """Two conversations per row: left to right, then right to left."""
    return F.array(
        chat(left_lang, right_lang, left, system),
        chat(right_lang, left_lang, right, system),
    )
