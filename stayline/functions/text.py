"""Text predicates and classifiers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayline import params as P


def merged_product_group(group: Column) -> Column:
    """Fold detailed product groups into the few the models use; others stay as they are."""
    out = None
    for prefix, name in P.GROUP_PREFIXES.items():
        hit = group.startswith(prefix)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    for name, members in P.GROUP_MEMBERS.items():
        out = out.when(group.isin(*members), name)
    return out.otherwise(group)


def first_words(text: Column, n: int = 2) -> Column:
    return F.substring_index(text, " ", n)


def leading(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def contains_any(text: Column, keywords: Iterable[str]) -> Column:
    """True where ``text`` (lower-cased) holds any keyword, in one regex pass."""
    words = [k.lower().replace("\\E", "") for k in keywords]
    if not words:
        return F.lit(False)
    return F.lower(text).rlike("|".join(f"\\Q{w}\\E" for w in words))


def classify_by_keywords(
    text: Column,
    rules: Mapping[str, Sequence[str]],
    priority: Sequence[str] = P.SIZE_PRIORITY,
    default: str = P.DEFAULT_SIZE,
) -> Column:
    """Class of the last rule in ``priority`` that has a keyword inside ``text``."""
    out = None
    for name in reversed([p for p in priority if p in rules]):
        hit = contains_any(text, rules[name])
        out = F.when(hit, name) if out is None else out.when(hit, name)
    fallback = F.when(text.isNotNull(), F.lit(default))
    return fallback if out is None else out.otherwise(fallback)


def tokens(text: Column) -> Column:
    """Distinct lower-case word tokens of a name."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^a-z0-9]+"), lambda t: t != ""))
