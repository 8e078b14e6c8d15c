"""String, cast and validation expressions."""

from __future__ import annotations

import difflib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

URL = r"(?i)^(https?|ftp)://[^\s/$.?#].[^\s]*$"
EMAIL = "_%@_%.__%"


def trigrams(text: Column) -> Column:
    """Distinct trigrams of the lower-cased words of a text, each word padded with two blanks before and one after."""
    words = F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")
    grams = F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substr(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def trigram_codes(text: Column) -> Column:
    """The trigrams as numbers, one byte a character: arrays of numbers intersect without comparing strings."""
    code = lambda g, i: F.ascii(F.substr(g, F.lit(i), F.lit(1)))
    return F.transform(trigrams(text), lambda g: code(g, 1) * 65536 + code(g, 2) * 256 + code(g, 3))


def trigram_overlap(a: Column, b: Column) -> Column:
    """Shared trigrams over all trigrams of two arrays without repeats; 0 where there are none or a side is null."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - shared
    return F.coalesce(F.when(total > 0, shared / total), F.lit(0.0))


def may_overlap(a: Column, b: Column, threshold: float) -> Column:
    """Whether two arrays without repeats can have an overlap of a threshold: first by their sizes alone, then by what
    they share, which is looked up once; rounding is on the safe side, so the overlap itself has to be compared after it."""
    sizes = F.least(F.size(a), F.size(b)) >= threshold * F.greatest(F.size(a), F.size(b)) - 1e-9
    return sizes & (F.size(F.array_intersect(a, b)) * (1 + threshold) >= threshold * (F.size(a) + F.size(b)) - 1e-9)


def similarity(a: Column, b: Column) -> Column:
    """Trigram similarity of two texts."""
    return trigram_overlap(trigrams(a), trigrams(b))


def sequence_similar(name: str | None, other: str, threshold: float) -> bool:
    """Whether two names are alike: one holds the other, or their matching blocks cover `threshold` of both; None is not."""
    if name is None:
        return False
    a, b = name.lower(), other.lower()
    return a in b or b in a or difflib.SequenceMatcher(None, a, b).ratio() >= threshold


def similar_to_any(name: Column, aliases: Sequence[str], threshold: float) -> Column:
    """Whether a name is alike any alias. Matching blocks have no expression in Spark, so this is an Arrow-batched UDF."""
    wanted = list(aliases)

    @F.pandas_udf("boolean")
    def alike(names: pd.Series) -> pd.Series:
        known = {n: any(sequence_similar(n, a, threshold) for a in wanted) for n in names.dropna().unique()}
        return names.map(lambda n: known.get(n, False) if isinstance(n, str) else False).astype(bool)

    return alike(name)


def blank_to_null(text: Column) -> Column:
    """Trimmed text, null if nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def unquoted(text: Column) -> Column:
    """Text without surrounding double quotes, null if empty."""
    return F.nullif(F.btrim(text, F.lit('"')), F.lit(""))


def to_int(text: Column) -> Column:
    """Number in a text rounded half to even as an int; null where there is none."""
    return F.rint(text.try_cast("double")).cast("int")


def guarded_number(text: Column) -> Column:
    """A text of digits and dots as a double, anything else null."""
    return F.when(text.rlike(r"^[0-9.]*$"), text.try_cast("double"))


def house_number(address: Column) -> Column:
    """From the first digit on; empty without digits; null for an address that starts with one."""
    body = F.trim(address)
    return F.when(~body.rlike("^[0-9]"), F.regexp_extract(body, "[0-9].*$", 0))


def street(address: Column) -> Column:
    """What stands before the house number, its trailing blank kept; null for an address that starts with a digit."""
    body = F.trim(address)
    number = F.regexp_extract(body, "[0-9].*$", 0)
    return F.when(~body.rlike("^[0-9]"), F.when(number == "", body).otherwise(F.replace(body, number, F.lit(""))))


def valid_email(text: Column) -> Column:
    """The text if it has the form of an e-mail address, else null."""
    return F.when(F.trim(text).like(EMAIL), F.trim(text))


def valid_url(text: Column) -> Column:
    """The text if it is an http or ftp URL of fewer than 2048 bytes, else null."""
    return F.when(F.trim(text).rlike(URL) & (F.octet_length(F.trim(text)) < 2048), F.trim(text))


def any_of(text: Column, patterns: Sequence[str]) -> Column:
    """Whether any of the patterns, taken as regular expressions, is found."""
    return F.coalesce(text.rlike("|".join(patterns)), F.lit(False))


def storeys(height: Column, each: float = 3.5) -> Column:
    """Whole storeys of a height, one at least."""
    return F.when(height > each, F.floor(height / each)).otherwise(F.lit(1)).cast("int")


def xml_escape(text: Column) -> Column:
    """Text for an XML attribute: quotes are dropped, the other marked-up characters escaped."""
    return F.replace(F.replace(F.replace(F.replace(text, F.lit('"'), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def free_name(taken: Sequence[str], name: str) -> str:
    """A column name that isn't among those taken."""
    known = {x.lower() for x in taken}
    while name.lower() in known:
        name += "_"
    return name
