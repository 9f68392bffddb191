"""Error-family matching: a flexible lexicon matcher and three fixed alternations."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .text import all_matches, first_match, large_lookup, lookup, strip_ws

_SEPARATORS = "[^A-Za-z0-9]*"


def _words(name: str) -> list[str]:
    return re.findall(r"[A-Za-z0-9]+", name)


def flex_family(c: Column, lexicon: Sequence[str], default: str | None) -> Column:
    """Family of the leftmost lexicon hit, ignoring case and separators between words.

    One prefix tree of the names finds the leftmost hit and, among names that start at
    the same place, the earlier entry. What a place of the text costs depends on the
    depth of the tree, not on the number of names. The hit is mapped back to its entry
    by its letters and digits. There are no word boundaries, and a word of a name must
    itself be unbroken (``MFTERR 03`` is not ``MFTERR03``).
    """
    entries = {"".join(_words(name)).lower(): name for name in reversed(lexicon) if _words(name)}
    if not entries:
        return F.lit(default).cast("string")
    initials = "".join(sorted({key[0] for key in entries}))
    hit = F.regexp_extract(c, f"(?i)(?=[{initials}]){prefix_tree(lexicon)}", 0)
    key = F.lower(F.regexp_replace(hit, "[^A-Za-z0-9]", ""))
    return F.coalesce(large_lookup(key, entries), F.lit(default).cast("string"))


def prefix_tree(names: Sequence[str]) -> str:
    """Pattern that matches what the alternation of the names in their order would, with common beginnings shared.

    A name is a row of letters with free separators between its words. Names that go on
    with the same letter share a branch, also across others in between, as those cannot
    match there. A free separator may be empty and then competes with letters, so it is
    shared between neighbours only. Nothing after the end of a name can win.
    """
    rows = []
    for name in names:
        words = _words(name.lower())
        letters = [[*word, _SEPARATORS] for word in words]
        if words:
            rows.append(tuple(x for word in letters for x in word)[:-1])
    return _branches(list(dict.fromkeys(rows)))


def _branches(rows: list[tuple[str, ...]]) -> str:
    groups: list[tuple[str, list[tuple[str, ...]]]] = []
    place: dict[str, int] = {}
    for row in rows:
        if not row:
            groups.append(("", []))
            break
        token = row[0]
        if token not in place:
            # A separator bars the letters before it from those after it, and the other way round.
            if token == _SEPARATORS or _SEPARATORS in place:
                place.clear()
            place[token] = len(groups)
            groups.append((token, []))
        groups[place[token]][1].append(row[1:])
    parts = [token + (_branches(rest) if rest else "") for token, rest in groups]
    return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"


def lexicon_label(family: Column) -> Column:
    """Reported label of a lexicon entry (aliases folded)."""
    return F.coalesce(lookup(family, P.FAMILY_LEXICON_ALIASES), family)


def family_v1(c: Column) -> Column:
    """Built-in lexicon, aliases folded, ``other`` when nothing matches."""
    return lexicon_label(flex_family(c, P.FAMILY_LEXICON, P.OTHER))


def family_token(c: Column, profile: str) -> Column:
    """First match of the profile's alternation as written, NULL when there is none."""
    names = P.FAMILY_PATTERNS[profile]
    # Every alternative starts with a letter; testing it first skips most words.
    initials = "".join(sorted({n[0].lower() for n in names}))
    return first_match(c, rf"\b(?=[{initials}])({'|'.join(names)})\b", 1, ignore_case=True)


def normalize_family(token: Column, profile: str) -> Column:
    """Label of a matched token; whitespace runs count as one space.

    v2 keeps an unlisted token as written and maps NULL to ``other``. v3 and v4
    upper-case an unlisted token with ``-`` for ``_`` and map NULL to ``''``.
    Callout labels use ``-`` in every profile.
    """
    one_space = F.regexp_replace(strip_ws(token), r"(?U)\s+", " ")
    spaced = F.regexp_replace(F.lower(one_space), r"(?U)[\s_-]+", " ")
    if profile == "v2":
        return F.coalesce(lookup(spaced, P.FAMILY_LABELS_V2), token, F.lit(P.OTHER))
    upper = F.upper(F.translate(one_space, "_", "-"))
    return F.coalesce(lookup(spaced, P.FAMILY_LABELS_V3), upper, F.lit(""))


def fixed_family(c: Column, profile: str) -> Column:
    """First match of the profile's alternation, as a label."""
    return normalize_family(family_token(c, profile), profile)


def fixed_family_or_empty(c: Column) -> Column:
    """As :func:`fixed_family` with the v2 patterns, but ``''`` when nothing matches."""
    token = family_token(c, "v2")
    return F.when(token.isNull(), F.lit("")).otherwise(normalize_family(token, "v2"))


def unmatched_anomalies(c: Column, family: Column) -> Column:
    """Trouble hints in the text that the family's own name does not contain.

    Lower-cased, distinct, in first-seen order.
    """
    base = F.regexp_replace(F.lower(family), "[^A-Za-z0-9]", "")
    hits = all_matches(c, r"\b(?:" + "|".join(P.ANOMALY_HINTS) + r")\b", 0, ignore_case=True)
    lowered = F.array_distinct(F.transform(hits, lambda h: F.lower(strip_ws(h))))

    def is_new(hint: Column) -> Column:
        return ~base.contains(F.regexp_replace(hint, "[^A-Za-z0-9]", ""))

    return F.filter(lowered, is_new)
