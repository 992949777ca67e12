"""Match keys for names, domains and people. Both sides of a match use these."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the legal forms stripped when no seed table is given
LEGAL_SUFFIXES = ("COMPANY", "GROUP", "CORP", "INC", "LLC", "LTD", "ULC", "CO")

# below this length a domain stem prefixes unrelated names
MIN_STEM = 12


def suffix_list(seed: DataFrame | None) -> tuple[str, ...]:
    """Suffixes of the legal_suffix seed, longest first; the fixed list if empty.

    The seed is configuration, a hand-kept list of words: it is read whole on the
    driver to build one pattern, whatever its length.
    """
    if seed is None:
        return LEGAL_SUFFIXES
    rows = seed.select("suffix").where("suffix is not null").collect()
    words = sorted((r.suffix for r in rows), key=lambda w: (-len(w), w))
    return tuple(words) or LEGAL_SUFFIXES


def name_upper(c: Column) -> Column:
    return F.upper(F.trim(c))


def name_alnum(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, "[^a-zA-Z0-9]", ""))


def _quoted(word: str) -> str:
    """``word`` as a pattern that matches what is left of it after the name lost its punctuation."""
    return re.sub(r"[^a-zA-Z0-9 ]", "", word)


def name_core(c: Column, suffixes: Sequence[str] = LEGAL_SUFFIXES) -> Column:
    plain = F.regexp_replace(c, "[^a-zA-Z0-9 ]", "")
    bare = F.regexp_replace(plain, r"(?i)\s+(" + "|".join(filter(None, map(_quoted, suffixes))) + ")$", "")
    return F.upper(F.regexp_replace(bare, r"\s+", " "))


def domain_stem(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, r"\..*$", ""))


def person_key(last: Column, first: Column) -> Column:
    return F.upper(F.concat(F.trim(last), F.lit(" "), F.trim(first)))
