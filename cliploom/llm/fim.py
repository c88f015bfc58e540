"""Fill-in-the-middle transformation.

The tokenizers library's Split pre-tokenizer, with its regular expression's matches isolated, cuts a text into units and gives
their ends in code points; it has nothing to train. The number of ends is n, the ends at two hashed ranks are where the middle
begins and ends, and all the rest is Catalyst's: hashes, slices, and putting a text together again.

Defined cases: a null or empty text is plain and its output empty; a null key hashes as an empty string; repeated rows are
treated alike; a text that holds a sentinel is plain, so an output is read back without doubt; very long texts are cut whole, in
time and memory that grow with their length; an empty table gives no rows; all columns of the input pass through, and where
one has an output's name, the output gets an underscore more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from .common import fresh

#: A unit: a run of anything but ASCII white space with the white space before it, or white space alone.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
#: Before the prefix, the suffix and the middle.
SENTINELS = ("<P>", "<S>", "<M>")


def unit_ends(text: Column, pattern: str = UNIT) -> Column:
    """Array of the code points at which the units of a text end. Each match of the pattern is a unit, and so is what lies
    between two matches."""

    @F.arrow_udf("array<int>")
    def ends(texts: pa.Array) -> pa.Array:
        split = pre_tokenizers.Split(Regex(pattern), behavior="isolated")
        # a text's pieces are let go once their ends are in an array
        found = [np.array([end for _, (_, end) in split.pre_tokenize_str(t.as_py())], np.int32) for t in texts]
        upto = np.cumsum([0, *map(len, found)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(upto), pa.array(np.concatenate([*found, np.zeros(0, np.int32)])))

    return ends(F.coalesce(text, F.lit("")))


def _checked(sentinels: tuple[str, str, str]) -> tuple[str, str, str]:
    """Sentinels that can't arise where a text and a sentinel meet: their first characters stand nowhere else in them."""
    if len(set(sentinels)) < 3 or not all(sentinels) or {s[0] for s in sentinels} & set("".join(s[1:] for s in sentinels)):
        raise ValueError("three different sentinels whose first characters occur in none of them again are needed")
    return sentinels


def _hashes(key: Column, seed: int) -> list[Column]:
    """The first four groups of eight hex digits of the hash of seed and key, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transformed(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 42,
    percent: int = 50,
    spm_percent: int = 80,
    pattern: str = UNIT,
    sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """Adds fim_units (n), fim_form (plain, psm or spm), fim_prefix_chars and fim_middle_chars (code points, null if plain) and
    fim_text. percent of the texts are transformed, spm_percent of these to suffix, prefix, middle, others to prefix,
    suffix, middle. The four hashes of seed and key decide all: where the middle begins and ends, whether, and how."""
    p, s, m = _checked(sentinels)
    taken = list(docs.columns)
    names = [fresh(name, taken) for name in ("fim_units", "fim_form", "fim_prefix_chars", "fim_middle_chars", "fim_text")]
    said, ends = fresh("_said", taken), fresh("_ends", taken)
    t, e = F.col(said), F.col(ends)
    cut = docs.withColumn(said, F.coalesce(F.col(text), F.lit(""))).withColumn(ends, unit_ends(F.col(said), pattern))
    h1, h2, h3, h4 = _hashes(F.col(key), seed)
    n = F.size(e).cast("long")

    def upto(units: Column) -> Column:
        return F.when(units > 0, F.element_at(e, F.greatest(units, F.lit(1)).cast("int"))).otherwise(0).cast("long")

    a, b = h1 % (n + 1), h2 % (n + 1)
    plain = (t == "") | t.contains(p) | t.contains(s) | t.contains(m) | (h3 % 100 >= percent)
    form = F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    first, last = fresh("_first", taken), fresh("_last", taken)
    placed = cut.select("*", n.alias(names[0]), form.alias(names[1]), upto(F.least(a, b)).alias(first), upto(F.greatest(a, b)).alias(last)).drop(ends)
    x, y = F.col(first), F.col(last)
    prefix, middle = F.substring(t, F.lit(1), x.cast("int")), F.substring(t, (x + 1).cast("int"), (y - x).cast("int"))
    suffix = F.substring(t, (y + 1).cast("int"), F.length(t))
    output = (
        F.when(F.col(names[1]) == "plain", t)
        .when(F.col(names[1]) == "spm", F.concat(F.lit(s), suffix, F.lit(p), prefix, F.lit(m), middle))
        .otherwise(F.concat(F.lit(p), prefix, F.lit(s), suffix, F.lit(m), middle))
    )
    turned = F.col(names[1]) != "plain"
    return placed.select(*taken, names[0], names[1], F.when(turned, x).alias(names[2]), F.when(turned, y - x).alias(names[3]), output.alias(names[4]))


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output of the given form was made of."""
    parts = F.split(output, "|".join(rf"\Q{s}\E" for s in _checked(sentinels)), -1)

    def part(k: int) -> Column:
        return F.element_at(parts, k)

    return F.when(form == "plain", output).when(form == "spm", F.concat(part(3), part(4), part(2))).otherwise(F.concat(part(2), part(4), part(3)))
