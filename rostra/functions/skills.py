"""Skill extraction as one regular expression per vocabulary."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from rostra import constants as K

BEFORE = r"(?<![a-z0-9])"
AFTER = r"(?![a-z0-9+#])"
SPECIAL = set(r"\.^$|?*+()[]{}-#/&~")


def escape(text: str) -> str:
    return "".join("\\" + ch if ch in SPECIAL else ch for ch in text)


def normalise_vocabulary(terms: Iterable[str]) -> list[str]:
    return sorted({t.lower().strip() for t in terms if t.strip()})


def prefix_pattern(terms: Iterable[str]) -> str:
    """One alternation in which shared prefixes are written once, longest reading first.

    The matcher then tests a handful of branches per position instead of every term.
    """
    tree: dict = {}
    for term in terms:
        node = tree
        for ch in term:
            node = node.setdefault(ch, {})
        node[""] = {}

    def render(node: dict) -> str:
        branches = [escape(ch) + render(child) for ch, child in sorted(node.items()) if ch]
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"
        return f"(?:{body})?" if "" in node else body

    return render(tree)


def vocabulary_pattern(terms: Iterable[str]) -> str:
    """Pattern of a vocabulary; an empty one is replaced by the base skills."""
    terms = normalise_vocabulary(terms) or K.BASE_SKILLS
    return f"{BEFORE}({prefix_pattern(normalise_vocabulary(terms))}){AFTER}"


def extract_skills(text: Column, terms: Iterable[str]) -> Column:
    """Distinct sorted vocabulary terms found in the text, longest reading first, left to right."""
    found = F.regexp_extract_all(F.lower(text), F.lit(vocabulary_pattern(terms)), 1)
    return F.array_sort(F.array_distinct(found))


def join_sorted(items: Column, limit: int | None = None) -> Column:
    return F.array_join(items if limit is None else F.slice(items, 1, limit), ", ")
