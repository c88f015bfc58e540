"""Caption text as Column functions: blocks, tokens, bigrams, normalisation, search slugs."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a token is, the word that is none, section labels, line breaks and white space of captions.
TOKEN = r"[a-z0-9]+(?:'[a-z0-9]+)*"
NO_TOKEN = "none"
SECTIONS = ("SCENE_OVERVIEW", "VISUAL_DETAILS", "DIALOGUE", "OTHER_SOUNDS")
LEAKED = (*SECTIONS, "VISUAL", "AUDIO")
BREAK = r"\R|[\x1c-\x1e]"
_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_FENCE = r"^`{3,}\s*$"
_BULLET = r"^(?:[-*+]\s+|\d+\.\s+)"


def strip(text: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(text, _SPACE, "")


def lines(text: Column) -> Column:
    """Stripped lines that are not empty."""
    return F.filter(F.transform(F.split(text, BREAK), strip), lambda x: x != "")


def tokens(text: Column) -> Column:
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)), lambda t: t != NO_TOKEN)


def blocks(caption: Column) -> Column:
    """Array of token arrays, one for each line that has tokens; a leading section label does not count."""
    label = rf"(?is)^(?:{'|'.join(SECTIONS)})\s*:?\s*(.*)$"
    bodies = F.transform(lines(caption), lambda x: F.regexp_replace(x, label, "$1"))
    return F.filter(F.transform(bodies, tokens), lambda b: F.size(b) > 0)


def bigrams(block: Column) -> Column:
    """Neighbouring tokens of one block, joined by a blank."""
    pairs = F.transform(F.sequence(F.lit(1), F.size(block) - 1), lambda i: F.concat_ws(" ", F.element_at(block, i), F.element_at(block, i + 1)))
    return F.when(F.size(block) > 1, pairs).otherwise(F.array().cast("array<string>"))


def normalize_caption(text: Column) -> Column:
    """A model's reply as one paragraph: fences, labels, bullets and backticks go. Null where nothing is left."""
    label = rf"(?s)^\s*(?:{'|'.join(LEAKED)})\s*:?\s*(.*)$"

    def line(x: Column) -> Column:
        body = strip(F.regexp_replace(x, label, "$1"))
        return F.when(x.rlike(_FENCE), "").otherwise(F.replace(strip(F.regexp_replace(body, _BULLET, "")), F.lit("`"), F.lit("")))

    joined = F.array_join(F.filter(F.transform(lines(text), line), lambda x: x != ""), " ")
    out = strip(F.regexp_replace(joined, r"(?U)[\s\x1c-\x1f]+", " "))
    return F.when(out != "", out)


@F.pandas_udf(T.StringType())
def _decomposed(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode(), na_action="ignore")


def slug(query: Column) -> Column:
    """Folder name of a search: ASCII after decomposition, other characters as dashes, lower case; 'search' if nothing is left,
    or for null. Python gets the searches alone that have other characters than ASCII."""
    plain = F.coalesce(_decomposed(F.when(query.rlike(r"[^\x00-\x7f]"), query)), query)
    name = F.lower(F.regexp_replace(F.regexp_replace(plain, "[^A-Za-z0-9]+", "-"), "^-|-$", ""))
    return F.coalesce(F.nullif(name, F.lit("")), F.lit("search"))


def ordered_query(query: Column) -> Column:
    """A search that names its order, newest first by default."""
    named = F.exists(F.split(query, r"\s+"), lambda t: t.startswith("order:"))
    return F.when(named, query).otherwise(strip(F.concat(query, F.lit(" order:id_desc"))))
