"""Field extractors: each takes a text column and returns a column.

NULL text behaves as empty text. Lists are arrays here; the operators join them
into text where a table needs it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .text import (
    all_matches,
    first_match,
    has_match,
    lookup,
    strip_ws,
    text_or_empty,
    title_case,
    to_long,
)

# --- interfaces --------------------------------------------------------------


def interface_ids(c: Column) -> Column:
    return all_matches(text_or_empty(c), P.INTERFACE_ID)


def _first_starting(ids: Column, prefix: str) -> Column:
    return F.get(F.filter(ids, lambda x: x.startswith(prefix)), 0)


def primary_interface(ids: Column) -> Column:
    """First ``E`` id, else first ``I``, else first ``U``."""
    return F.coalesce(*[_first_starting(ids, p) for p in P.PRIMARY_PREFIX_ORDER])


def _id_segments(c: Column) -> Column:
    return F.filter(F.split(c, "-"), lambda s: s.rlike(P.INTERFACE_ID_WHOLE))


def chain_clean(c: Column, ids: Column) -> Column:
    """Ids standing alone between hyphens, else all ids, joined by ``-``; at least two."""
    segments = _id_segments(text_or_empty(c))
    return F.when(F.size(segments) >= 2, F.array_join(segments, "-")).when(
        F.size(ids) >= 2, F.array_join(ids, "-")
    )


def chain_raw(c: Column) -> Column:
    """Longest word with two or more id segments; the first of equal length."""
    words = F.filter(all_matches(text_or_empty(c), r"\S+", 0), lambda w: w.contains("-"))
    chains = F.filter(words, lambda w: F.size(_id_segments(w)) >= 2)

    def ranked(word: Column, position: Column) -> Column:
        return F.struct(F.length(word).alias("len"), (-position).alias("pos"), word.alias("word"))

    return F.array_max(F.transform(chains, ranked))["word"]


def triplet(c: Column) -> dict[str, Column]:
    """Parts of the first ``src-mid-dst`` route, ``''`` when there is none."""
    t = text_or_empty(c)
    names = ("src_interface", "route_or_mid", "dst_interface")
    return {n: F.regexp_extract(t, "(?U)" + P.TRIPLET, i) for i, n in enumerate(names, start=1)}


def triplet_label(src: Column, mid: Column, dst: Column) -> Column:
    """``src-mid-dst``, ``''`` when neither end is known."""
    return F.when((src != "") | (dst != ""), F.concat_ws("-", src, mid, dst)).otherwise(F.lit(""))


# --- codes, commands, hosts --------------------------------------------------


def error_codes(c: Column) -> Column:
    """Distinct codes in first-seen order."""
    return F.array_distinct(all_matches(text_or_empty(c), P.ERROR_CODE))


def ftp_command(c: Column) -> Column:
    return F.upper(first_match(c, P.FTP_COMMAND, 2, ignore_case=True))


def ftp_code_550(c: Column) -> Column:
    return F.when(has_match(c, P.FTP_CODE_550), F.lit("550"))


def ftp_code(c: Column) -> Column:
    """First 4xx / 5xx number, ``''`` when absent."""
    return F.regexp_extract(text_or_empty(c), "(?U)" + P.FTP_CODE_MESSAGE, 1)


def ftp_message(c: Column) -> Column:
    """Text after the code up to the first full stop, trailing punctuation removed."""
    message = F.regexp_extract(text_or_empty(c), "(?U)" + P.FTP_CODE_MESSAGE, 2)
    return F.rtrim(strip_ws(message), F.lit(" .;:"))


def permission_denied(c: Column) -> Column:
    return has_match(c, "Permission denied", ignore_case=True)


def not_connected(c: Column) -> Column:
    return has_match(c, "Not connected", ignore_case=True)


def app_hosts(c: Column, domain: str | None = None) -> Column:
    """Lower-cased hosts: application hosts, then names under ``domain``.

    A pattern started at every letter would take quadratic time on a long word. So each
    run of host characters is tried once, up to its last ending, and the match proper is
    then sought from the front of that piece, where the first try that can start succeeds.
    """
    t = text_or_empty(c)
    found = _last_in_runs(t, P.HOST_RUN, P.APP_HOST_END, P.APP_HOST)
    if domain is None:
        return F.transform(F.array_distinct(found), lambda h: F.lower(h))
    suffix = domain.replace(".", r"\.")
    ending = rf"\.(?:{suffix})\b"
    named = _last_in_runs(t, P.NAME_RUN, ending, rf"\b[{P.NAME_RUN}]+{ending}")
    return F.array_distinct(F.transform(F.concat(found, named), lambda h: F.lower(h)))


def _last_in_runs(c: Column, run: str, ending: str, whole: str) -> Column:
    """The match of ``whole`` in each run of the characters ``run`` that holds ``ending``; it reaches to the last one."""
    pieces = all_matches(c, rf"(?:^|[^{run}])[{run}]*{ending}", 0, ignore_case=True)
    found = F.transform(pieces, lambda p: F.regexp_extract(p, f"(?iU){whole}\\z", 0))
    return F.filter(found, lambda m: m != "")


def host_tag(c: Column, prefix: str | None) -> Column:
    """First application host with the given prefix, case matters; without a prefix there is no tag."""
    if prefix is None:
        return F.lit(None).cast("string")
    return first_match(c, rf"\b{prefix}[a-z]+app[0-9]+\b", 0)


def script_name(c: Column) -> Column:
    return first_match(c, P.SCRIPT_NAME)


def warning_subject(c: Column, family: Column, length: int = P.WARNING_SUBJECT_LENGTH) -> Column:
    subject = first_match(c, P.WARNING_SUBJECT)
    return F.when(family == "WARNING", F.substring(subject, 1, length))


def fms_class(c: Column) -> Column:
    return F.regexp_extract(text_or_empty(c), "(?U)" + P.FMS_CLASS, 1)


def caller_class(c: Column) -> Column:
    low = F.lower(c)
    out = None
    for label, needles in P.CALLER_RULES:
        hit = low.contains(needles[0])
        for needle in needles[1:]:
            hit = hit | low.contains(needle)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(P.CALLER_OTHER)


# --- stuck files -------------------------------------------------------------

_STUCK_COUNT = {"v1": P.STUCK_COUNT_V1, "v2": P.STUCK_COUNT_V1, "v3": P.STUCK_COUNT_V3, "v4": P.STUCK_COUNT_V3}
_STUCK_MINUTES = {
    "v1": P.STUCK_MINUTES_V1,
    "v2": P.STUCK_MINUTES_V2,
    "v3": P.STUCK_MINUTES_V3,
    "v4": P.STUCK_MINUTES_V3,
}


def stuck_count(c: Column, profile: str) -> Column:
    return to_long(F.regexp_extract(c, "(?U)" + _STUCK_COUNT[profile], 1))


def stuck_minutes(c: Column, profile: str) -> Column:
    return to_long(F.regexp_extract(c, "(?iU)" + _STUCK_MINUTES[profile], 1))


# --- operations --------------------------------------------------------------


def operation_tags(c: Column, profile: str) -> Column:
    """Labels of the signals present, in catalogue order."""
    t = text_or_empty(c)
    labels = [F.when(has_match(t, p, ignore_case=True), F.lit(tag)) for tag, p in P.OPERATION_TAGS[profile]]
    return F.array_compact(F.array(*labels))


def operation(c: Column, tags: Column) -> Column:
    """PUT / GET of a failed transfer, else a bare PUT, else a bare GET, else ``''``."""
    t = text_or_empty(c)
    return (
        F.when(F.array_contains(tags, "unsuccessful_put"), "PUT")
        .when(F.array_contains(tags, "unsuccessful_get"), "GET")
        .when(has_match(t, r"\bPUT\b", ignore_case=True), "PUT")
        .when(has_match(t, r"\bGET\b", ignore_case=True), "GET")
        .otherwise("")
    )


def operation_success(tags: Column, profile: str) -> Column:
    """``NO`` when a failing tag is present, else ``''``."""
    failing = tags
    for tag in P.OPERATION_NEUTRAL_TAGS[profile]:
        failing = F.array_remove(failing, tag)
    return F.when(F.size(failing) > 0, "NO").otherwise("")


# --- paths -------------------------------------------------------------------


def paths_rooted(c: Column, profile: str) -> Column:
    """Unix paths under the profile's fixed roots, repeats kept."""
    return all_matches(text_or_empty(c), P.PATH_ROOTED_V1 if profile == "v1" else P.PATH_ROOTED_V2)


def normalize_path(c: Column) -> Column:
    """Trim, drop trailing punctuation, collapse repeated slashes."""
    return F.regexp_replace(F.rtrim(strip_ws(c), F.lit(" .;:\t)")), "/{2,}", "/")


def _clean(paths: Column) -> Column:
    return F.filter(F.transform(paths, normalize_path), lambda p: p != "")


def split_paths(c: Column) -> Column:
    """Paths listed in one cell, separated by commas, semicolons or line ends."""
    return _clean(F.split(text_or_empty(c), P.PATH_CELL_SEPARATORS))


def absolute_only(paths: Column, unc: bool = True) -> Column:
    pattern = P.PATH_ABSOLUTE if unc else P.PATH_ABSOLUTE_NO_UNC
    return F.filter(paths, lambda p: p.rlike(pattern))


def text_paths(c: Column, allow_non_abs: bool = False, unc: bool = True) -> Column:
    """Distinct paths in free text: Unix, then Windows drive, then UNC matches.

    With ``allow_non_abs`` a text without any path yields its path-like words
    (not de-duplicated, as given).
    """
    t = text_or_empty(c)
    kinds = [P.PATH_UNIX, P.PATH_WINDOWS] + ([P.PATH_UNC] if unc else [])
    found = F.array_distinct(_clean(F.concat(*[all_matches(t, k) for k in kinds])))
    if not allow_non_abs:
        return found
    words = F.transform(all_matches(t, P.PATH_FALLBACK_TOKEN_V5, 0), normalize_path)
    return F.when(F.size(found) > 0, found).otherwise(words)


def feature_paths(c: Column, allow_non_abs: bool = False) -> Column:
    """Distinct Unix and Windows paths; fallback words must exceed three characters."""
    found = text_paths(c, unc=False)
    if not allow_non_abs:
        return found
    words = all_matches(text_or_empty(c), P.PATH_FALLBACK_TOKEN_V3, 0)
    return F.when(F.size(found) > 0, found).otherwise(
        F.array_distinct(F.filter(words, lambda w: F.length(w) > 3))
    )


def file_patterns(c: Column, profile: str) -> Column:
    """Distinct file names with a wildcard."""
    # No match crosses a separator. Of the stretches between them those with a star are
    # looked at; a match begins with a word's first letter before a star and reaches to the
    # stretch's last letter or digit, so one attempt finds it, in linear time.
    separators = r"[ \t:/\\]+" if profile == "v3" else r"[ \t:/]+"
    stretches = F.filter(F.split(text_or_empty(c), separators), lambda s: s.contains("*"))

    def whole(stretch: Column) -> Column:
        return F.regexp_extract(F.regexp_extract(stretch, r"(?sU)^.*\w", 0), r"(?sU)(?<!\S)[^\w\s]*+(\w\S*\*.*)", 1)

    if profile == "v3":
        found = F.transform(stretches, whole)
    else:  # a backslash may stand before the star but not after it
        found = F.flatten(
            F.transform(
                stretches,
                lambda s: F.when(s.contains("\\"), all_matches(s, P.FILE_WILDCARD_V4, 0)).otherwise(F.array(whole(s))),
            )
        )
    return F.array_distinct(F.filter(found, lambda m: m != ""))


def basename(path: Column) -> Column:
    """Last component, ignoring trailing slashes."""
    return F.regexp_extract(path, r"([^/]+)/*\z", 1)


# --- status and closure notes ------------------------------------------------


def canonical_status(c: Column) -> Column:
    """Trimmed status through the fixed map, else in title case; NULL stays NULL."""
    low = F.lower(strip_ws(c))
    return F.coalesce(lookup(low, P.STATUS_LABELS), title_case(low))


def is_intermittent(notes: Column) -> Column:
    return F.lower(text_or_empty(notes)).contains("intermittent")


def closure_quality(notes: Column) -> Column:
    """How many of the three keyword groups the notes mention (0-3)."""
    low = F.lower(text_or_empty(notes))
    score = F.lit(0)
    for group in P.CLOSURE_KEYWORDS:
        score = score + low.rlike(group).cast("int")
    return score


