"""Language codes, names and routing."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Language codes of line-aligned files, with their display names and earlier variants.
LANGUAGE_NAMES = {
    "cmn_Hans": "Simplified Chinese",
    "cmn_Hant": "Traditional Chinese",
    "eng_Latn": "English",
    "yue_Hant": "Cantonese",
}
LANGUAGE_NAMES_MERGED_MANDARIN = {
    "eng_Latn": "English",
    "cmn_Hans": "Mandarin",
    "cmn_Hant": "Mandarin",
    "yue_Hant": "Cantonese",
}
DICTIONARY_NAMES = {"en": "English", "yue": "Cantonese", "chinese": "Mandarin"}
PIVOT = "Cantonese"


def mapped(value: Column, names: dict[str, str], strict: bool = True) -> Column:
    """Look ``value`` up in ``names``; an unknown value is an error, or NULL when not strict."""
    table = F.create_map(*[F.lit(item) for item in chain.from_iterable(names.items())])
    found = table[value]
    if not strict:
        return found
    unknown = F.raise_error(F.concat(F.lit("unknown language: "), F.coalesce(value, F.lit("NULL"))))
    return F.coalesce(found, unknown.cast("string"))


def inverted(names: dict[str, str]) -> dict[str, str]:
    """Name to code; refuses names shared by two codes."""
    if len(set(names.values())) != len(names):
        raise ValueError("two codes share a name, the inverse is not defined")
    return {name: code for code, name in names.items()}


def code_of_file(file_name: Column) -> Column:
    """The second dot-separated field: ``dev.eng_Latn`` -> ``eng_Latn``."""
    return F.split_part(file_name, F.lit("."), F.lit(2))


def metric_language(target: Column) -> Column:
    """Which variant of a learned metric scores this target language."""
    return F.when(target == "English", "en").otherwise("zh")
