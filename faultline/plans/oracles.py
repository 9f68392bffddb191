"""Reference SQL for the registered queries, for DuckDB over the same tables.

Written apart from the Spark operators: families are found by comparing match
positions or by a CASE list, recurrence by a plain ``lag``, drill-through by
comparing every pair. Only the shared projections and fixed patterns coincide.
"""

from __future__ import annotations

from .fixtures import CI_LOOKUP_SQL, INCIDENTS_SQL, TEXTS_SQL

_FAMILY_NAMES = [
    "FMS-FTP-ERROR", "FMS-CONFIG-FILE", "FMS-ERR-FILE-REMOVE", "FMS-ERR-FILE-COPY", "FMS-DIR-CREATE",
    "PROCESS-ALERT", "MFTERRGEN", "CALLOUT-MFTERR02", "CALLOUT-MFTERR03", "CALLOUT-MFTERR04",
    "ERR-HTTPS-ERROR", "UNHANDLED EXCEPTION ERROR", "MISSING FILES", "FTP error", "Permission denied",
    "Not connected", "Auth fail", "java.io.IOException", "Address already in use", "Stuck files",
]


def _position_rows(names: list[str]) -> str:
    """``(order, name, pattern)`` rows; separators between words are free."""
    rows = []
    for i, name in enumerate(names):
        words = "".join(c if c.isalnum() else " " for c in name).split()
        rows.append(f"({i}, '{name}', '(?i)" + "[^A-Za-z0-9]*".join(words) + "')")
    return ", ".join(rows)


def _earliest(text: str, lexicon: str, keep: str = "number") -> str:
    return f"""
  SELECT {keep}, arg_min(name, strpos({text}, regexp_extract({text}, pattern)) * 1000 + ord) AS fam
  FROM incidents, {lexicon} WHERE regexp_matches({text}, pattern) GROUP BY {keep}"""


_ANOMALIES = (
    r"(?i)\btime(?:out)?\b|\bconnection\s+refused\b|\bconnection\s+reset\b|\bno\s+such\s+file\b|\bpermission\b"
    r"|\bdenied\b|\bauth(?:entication)?\s+fail(?:ure)?\b|\bssl\s+error\b|\bh(?:ttps|ttp)\b|\bcertificate\b"
    r"|\bhandshake\b|\bproxy\b|\brefused\b|\breset\b|\bnot\s+found\b"
)
_V2_TOKEN = (
    r"(?i)\b(FMS-FTP-ERROR|FTP\s*error|FMS-CONFIG-FILE|FMS-ERR-FILE-REMOVE|PROCESS-ALERT|MFTERRGEN"
    r"|CALLOUT[_\-]?MFTERR0?3|CALLOUT[_\-]?MFTERR0?4|Permission denied|Not connected|Auth fail"
    r"|java\.io\.IOException|Address already in use|Stuck files|WARNING)\b"
)
_V3_TOKEN = (
    r"(?i)\b(FMS-FTP-ERROR|FTP\s*error|FMS-CONFIG-FILE|FMS-ERR-FILE-REMOVE|FMS-ERR-FILE-COPY|FMS-DIR-CREATE"
    r"|PROCESS-ALERT|FTG(?:-ALERT)?|MFTERRGEN|CALLOUT[_-]?MFTERR0?2|CALLOUT[_-]?MFTERR0?3|CALLOUT[_-]?MFTERR0?4"
    r"|ERR-HTTPS-ERROR|Missing Files|MISSING-FILES|Unhandled\s+Exception\s+Error)\b"
)
_V4_TOKEN = (
    r"(?i)\b(FMS-FTP-ERROR|FTP\s*error|FMS-CONFIG-FILE|FMS-ERR-FILE-REMOVE|FMS-DIR-CREATE|MFTERRGEN|PROCESS-ALERT"
    r"|CALLOUT[_-]?MFTERR0?2|CALLOUT[_-]?MFTERR0?3|CALLOUT[_-]?MFTERR0?4|CALLOUT-FTG|FTG-ALERT|WARNING"
    r"|Unhandled\s+Exception\s+Error|ERR-HTTPS-ERROR|ERR-FTP-COPY)\b"
)
_TRIPLET = r"\b((?:[EIU]\d{6,}|MULTIPLE|INV))-([A-Za-z0-9]+)-((?:[EIU]\d{6,}|MULTIPLE|INV))\b"
_ID = r"\b([EIU][0-9]{3,6}[A-Z]?)\b"


def _v2_family(tok: str) -> str:
    return f"""CASE WHEN {tok} = '' THEN 'other'
    WHEN lower({tok}) = 'fms-ftp-error' OR regexp_full_match({tok}, '(?i)ftp\\s+error') THEN 'FMS-FTP-ERROR'
    WHEN lower({tok}) IN ('fms-config-file', 'fms-err-file-remove', 'process-alert', 'mfterrgen', 'warning') THEN upper({tok})
    WHEN lower({tok}) IN ('callout_mfterr03', 'callout-mfterr03') THEN 'CALLOUT-MFTERR03'
    WHEN lower({tok}) IN ('callout_mfterr04', 'callout-mfterr04') THEN 'CALLOUT-MFTERR04'
    WHEN lower({tok}) = 'java.io.ioexception' THEN 'java.io.IOException'
    WHEN lower({tok}) IN ('permission denied', 'not connected', 'auth fail', 'address already in use', 'stuck files')
      THEN upper(left({tok}, 1)) || lower(substr({tok}, 2))
    ELSE {tok} END"""


def _v3_family(tok: str) -> str:
    return f"""CASE WHEN regexp_full_match({tok}, '(?i)ftp\\s+error') THEN 'FMS-FTP-ERROR'
    WHEN regexp_full_match({tok}, '(?i)missing[ -]files') THEN 'MISSING-FILES'
    ELSE upper(replace(regexp_replace({tok}, '\\s+', ' ', 'g'), '_', '-')) END"""


def _first(text: str, pattern: str, group: int = 0) -> str:
    return f"nullif(regexp_extract({text}, '{pattern}', {group}), '')"


def _primary(ids: str) -> str:
    parts = [f"list_filter({ids}, lambda x: starts_with(x, '{p}'))[1]" for p in "EIU"]
    return f"coalesce({', '.join(parts)})"


def _join(items: str, sep: str = "; ") -> str:
    return f"coalesce(array_to_string(list_filter({items}, lambda x: trim(x) <> ''), '{sep}'), '')"


def _join_null(items: str, sep: str = ",") -> str:
    return f"CASE WHEN len({items}) > 0 THEN array_to_string({items}, '{sep}') END"


def _ordered_distinct(items: str) -> str:
    """Distinct items in first-seen order."""
    return f"list_filter({items}, lambda x, i: list_position({items}, x) = i)"


def _norm(path: str) -> str:
    return rf"regexp_replace(regexp_replace(trim({path}, ' ' || chr(9) || chr(10)), '[ .;:)\t]+$', ''), '/+', '/', 'g')"


def _all(text: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract_all({text}, '{pattern}', {group})"


def _text_paths(text: str, unc: bool) -> str:
    kinds = [_all(text, "/[-A-Za-z0-9_./]+"), _all(text, r"[A-Za-z]:\\[^\s:;,)]+")]
    if unc:
        kinds.append(_all(text, r"\\\\[A-Za-z0-9._-]+\\[^\s:;,)]+"))
    joined = kinds[0]
    for k in kinds[1:]:
        joined = f"list_concat({joined}, {k})"
    cleaned = f"list_filter(list_transform({joined}, lambda p: {_norm('p')}), lambda p: p <> '')"
    return _ordered_distinct(cleaned)


_OPS_V3 = [
    ("unsuccessful_put", r"Unsuccessful\s+PUT"), ("unsuccessful_get", r"Unsuccessful\s+GET"),
    ("permission_denied", r"Permission\s+denied"), ("not_connected", r"\bNot\s+connected\b"),
    ("couldnt_remote_list", r"Couldn''?t\s+get\s+remote\s+file\s+list"),
    ("cant_create", r"Can''t\s+create\s+file|Cannot\s+create\s+a\s+file"),
    ("addr_in_use", r"Address\s+already\s+in\s+use"),
    ("connection_closed_foreignhost", r"connection\s+is\s+closed\s+by\s+foreignhost"),
    ("https_curl_error", r"ERR-HTTPS-ERROR|curl\s+error"),
]
_OPS_V4 = [
    *_OPS_V3[:5],
    ("cannot_create_exists", r"Cannot\s+create\s+a\s+file\s+when\s+that\s+file\s+already\s+exists"),
    ("rnfr_failed", r"\bRNFR\s+command\s+failed\b"), ("addr_in_use", r"Address\s+already\s+in\s+use"),
    ("cannot_remove_file", r"Cannot\s+remove\s+file"), ("cannot_move", r"\bCannot\s+move\b"),
    ("dir_create_fail", r"\bCannot\s+create\s+[^.]+"),
    ("config_missing", r"Mandatory\s+item\s+missing\s+from\s+config\s+file"),
    ("config_empty", r"Config\s+exists,\s+but\s+contains\s+no\s+config\s+lines"),
]


def _tags(text: str, ops: list[tuple[str, str]]) -> str:
    return "concat_ws('; ', " + ", ".join(
        f"CASE WHEN regexp_matches({text}, '(?i){p}') THEN '{n}' END" for n, p in ops
    ) + ")"


def _operation(text: str) -> str:
    return f"""CASE WHEN regexp_matches({text}, '(?i)unsuccessful\\s+put') THEN 'PUT'
    WHEN regexp_matches({text}, '(?i)unsuccessful\\s+get') THEN 'GET'
    WHEN regexp_matches({text}, '(?i)\\bput\\b') THEN 'PUT'
    WHEN regexp_matches({text}, '(?i)\\bget\\b') THEN 'GET' ELSE '' END"""


def _success(text: str, ops: list[tuple[str, str]], neutral: tuple[str, ...] = ()) -> str:
    tests = " OR ".join(f"regexp_matches({text}, '(?i){p}')" for n, p in ops if n not in neutral)
    return f"CASE WHEN {tests} THEN 'NO' ELSE '' END"


_HOST_APP = r"(?i)\b[a-z][a-z0-9_-]*app[0-9]{3,4}\b"
_HOST_NET = r"(?i)\b[A-Za-z0-9.-]+\.example\.net\b"


def _hosts(text: str, named: bool) -> str:
    found = _all(text, _HOST_APP)
    if named:
        found = f"list_concat({found}, {_all(text, _HOST_NET)})"
        return _join(_ordered_distinct(f"list_transform({found}, lambda h: lower(h))"))
    return _join(f"list_transform({_ordered_distinct(found)}, lambda h: lower(h))")


_DAY = r"\b(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)\s+[A-Za-z]{3}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2}\s+GMT\s+\d{4}\b"


def _day_iso(raw: str) -> str:
    return f"strftime(try_strptime({raw}, '%a %b %d %H:%M:%S GMT %Y'), '%Y-%m-%dT%H:%M:%S')"


_ISO_V3 = r"\b\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z)?\b"


def _timestamp(text: str, fired: bool) -> str:
    iso = _first(text, _ISO_V3)
    forms = [
        f"strftime(try_cast(replace({iso}, 'Z', '') AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S+00:00')",
        _day_iso(_first(text, _DAY)) + " || 'Z'",
        "''",
    ]
    if fired:
        forms.insert(0, _first(text, r"(?i)Fired\s+Date\s+Time:\s*(\d{4}-\d{2}-\d{2}T\S+)", 1))
    return f"coalesce({', '.join(forms)})"


def _bigint(text: str, pattern: str) -> str:
    return f"try_cast({_first(text, pattern, 1)} AS BIGINT)"


_OPENED = """CASE WHEN regexp_full_match(opened_raw, '[0-9]+(\\.[0-9]*)?')
      THEN TIMESTAMP '1899-12-30 00:00:00' + to_microseconds(CAST(round(CAST(opened_raw AS DOUBLE) * 86400000000) AS BIGINT))
      ELSE try_cast(opened_raw AS TIMESTAMP) END"""


def _grains(ts: str) -> str:
    return f"""strftime({ts}, '%Y-%m') AS month,
    strftime(date_trunc('week', {ts}), '%Y-%m-%d') || '/' || strftime(date_trunc('week', {ts}) + INTERVAL 6 DAY, '%Y-%m-%d') AS week,
    dayname({ts}) AS dow, CAST(hour({ts}) AS BIGINT) AS hour,
    CASE WHEN hour({ts}) <= 5 THEN 'Night(00-05)' WHEN hour({ts}) <= 11 THEN 'Morning(06-11)'
         WHEN hour({ts}) <= 17 THEN 'Afternoon(12-17)' WHEN hour({ts}) IS NOT NULL THEN 'Evening(18-23)' END AS daypart"""


_STATUS = """CASE lower(trim(status)) WHEN 'accepted / in progress' THEN 'In Progress' WHEN 'in progress' THEN 'In Progress'
      WHEN 'accepted' THEN 'In Progress' WHEN 'resolved' THEN 'Resolved' WHEN 'closed' THEN 'Closed'
      ELSE array_to_string(list_transform(regexp_extract_all(lower(trim(status)), '[a-z]+|[^a-z]+'),
             lambda w: upper(left(w, 1)) || substr(w, 2)), '') END"""

_NOTES = "lower(coalesce(resolution_notes, ''))"
_SCORE = f"""CAST(regexp_matches({_NOTES}, 'rca') AS BIGINT)
    + CAST(regexp_matches({_NOTES}, 'resolution|fix|reprocessed|triggered|housekeep') AS BIGINT)
    + CAST(regexp_matches({_NOTES}, 'confirmation|verified|hence closing|hence we are resolving') AS BIGINT)"""

_SD, _DE = "coalesce(short_description, '')", "coalesce(description, '')"
_PREFER = "CASE WHEN trim(coalesce(description, '')) <> '' THEN description ELSE coalesce(short_description, '') END"


def _pool(*columns: str) -> str:
    return "concat_ws(' ', " + ", ".join(f"CASE WHEN trim({c}) <> '' THEN {c} END" for c in columns) + ")"


_POOL_V4 = _pool("short_description", "resolution_notes", "description", "comments")
_POOL_V5 = _pool("short_description", "description", "resolution_notes", "comments")

_HELPERS = f"""ids, {_join_null('ids')} AS interfaces, {_primary('ids')} AS primary_interface,
    {_v2_family('tok')} AS error_family,
    {_join_null(_ordered_distinct('codes'))} AS error_codes, codes,
    {_join_null('pl')} AS paths, pl, len(pl) > 0 AS has_path,
    {_bigint('sd', r':\s*-\s*(\d+)\b')} AS stuck_files_count,
    {_bigint('sd', r'(?i)from\s+(\d+)\s*min\b')} AS stuck_for_minutes,
    upper({_first('sd', r'(?i)\b(Unsuccessful)\s+(PUT|GET)\b', 2)}) AS ftp_command,
    CASE WHEN regexp_matches(sd, '\\b550\\b') THEN '550' END AS ftp_code,
    regexp_matches(sd, '(?i)permission denied') AS permission_denied,
    regexp_matches(sd, '(?i)not connected') AS not_connected,
    {_first('sd', r'\babc[a-z]+app[0-9]+\b')} AS host_tag"""

_CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "incidents": (INCIDENTS_SQL.replace("{events}", "events"), ()),
    "lookup": (CI_LOOKUP_SQL.replace("{nation}", "nation"), ()),
    "lex": (f"SELECT * FROM (VALUES {_position_rows(_FAMILY_NAMES)}) t(ord, name, pattern)", ()),
    "lex3": (
        f"SELECT * FROM (VALUES {_position_rows(['FMS-ERR-FILE-COPY', 'Address already in use', 'MISSING FILES'])}) t(ord, name, pattern)",
        (),
    ),
    "fam_desc": (_earliest("description", "lex"), ("incidents", "lex")),
    "fam_short": (_earliest("short_description", "lex"), ("incidents", "lex")),
    "fam_pool": (_earliest(_POOL_V5, "lex"), ("incidents", "lex")),
    "fam3": (_earliest("description", "lex3"), ("incidents", "lex3")),
    # enrichment of the description
    "enr": (
        f"""SELECT *, {_grains('opened_dt')} FROM (
  SELECT i.* EXCLUDE (configuration_item), configuration_item, configuration_item AS ci, {_OPENED} AS opened_dt,
    {_STATUS} AS status_canonical,
    {_primary(_all(_DE, _ID, 1))} AS primary_interface,
    CASE coalesce(f.fam, 'other') WHEN 'FTP error' THEN 'FMS-FTP-ERROR' ELSE coalesce(f.fam, 'other') END AS error_family,
    {_bigint('description', r':\s*-\s*(\d+)\b')} AS stuck_files_count,
    {_bigint('description', r'(?i)\bfrom\s+(\d+)\s*min\b')} AS stuck_for_minutes,
    contains({_NOTES}, 'intermittent') AS is_intermittent
  FROM incidents i LEFT JOIN fam_desc f USING (number)) WHERE opened_dt IS NOT NULL""",
        ("fam_desc",),
    ),
    "rec": (
        """SELECT *, coalesce(opened_dt - prev_time <= INTERVAL 24 HOUR, false) AS recurs_24h FROM (
  SELECT *, CASE WHEN primary_interface IS NOT NULL AND error_family IS NOT NULL THEN
    lag(opened_dt) OVER (PARTITION BY primary_interface, error_family ORDER BY opened_dt, number) END AS prev_time FROM enr)""",
        ("enr",),
    ),
    # v2 fields of the short description
    "v2": (
        f"""SELECT *, {_HELPERS} FROM (
  SELECT *, {_SD} AS sd, {_all(_SD, _ID, 1)} AS ids, {_all(_SD, r'\b([UEI][0-9]{3,6})\b', 1)} AS codes,
    {_all(_SD, r'/(?:var|opt|data|mnt|etc|home)[^\s:;,)]*')} AS pl, regexp_extract({_SD}, '{_V2_TOKEN}', 1) AS tok
  FROM incidents)""",
        ("incidents",),
    ),
    "v2t": (f"SELECT *, {_grains('opened_dt')} FROM (SELECT *, {_OPENED} AS opened_dt FROM v2)", ("v2",)),
    "tags": (
        """SELECT *, list_filter([
    CASE WHEN upper(error_family) = 'STUCK FILES' OR coalesce(stuck_files_count, 0) >= 1 OR coalesce(stuck_for_minutes, 0) >= 1
           OR sd ILIKE '%number of stuck files%' THEN 'stuck-files' END,
    CASE WHEN error_family = 'FMS-FTP-ERROR' OR regexp_matches(sd, '(?i)ftp\\s*error|unsuccessful\\s+(put|get)|not connected')
           OR ftp_code = '550' OR ftp_command IN ('PUT', 'GET') THEN 'ftp-errors' END,
    CASE WHEN error_family = 'FMS-CONFIG-FILE' OR sd ILIKE '%config exists%' OR sd ILIKE '%contains no config lines%' THEN 'config-file' END,
    CASE WHEN error_family = 'FMS-ERR-FILE-REMOVE' OR sd ILIKE '%cannot remove file%' OR sd ILIKE '%cannot move%' THEN 'err-file-remove' END,
    CASE WHEN error_family = 'CALLOUT-MFTERR03' OR regexp_matches(sd, '(?i)callout[_-]?mfterr0?3') THEN 'callout_mfterr03' END,
    CASE WHEN error_family = 'CALLOUT-MFTERR04' OR regexp_matches(sd, '(?i)callout[_-]?mfterr0?4') THEN 'callout_mfterr04' END,
    CASE WHEN error_family = 'PROCESS-ALERT' OR sd ILIKE '%process-alert%' THEN 'process-alert' END,
    CASE WHEN error_family = 'WARNING' OR sd ILIKE '%warning:%' THEN 'warnings' END], lambda x: x IS NOT NULL) AS found FROM v2t""",
        ("v2t",),
    ),
    "tall": (
        "SELECT *, unnest(CASE WHEN len(found) = 0 THEN ['misc'] ELSE found END) AS scenario FROM tags",
        ("tags",),
    ),
    "names": (
        """SELECT * FROM (VALUES (1, 'stuck-files'), (2, 'ftp-errors'), (3, 'config-file'), (4, 'err-file-remove'),
  (5, 'callout_mfterr03'), (6, 'callout_mfterr04'), (7, 'process-alert'), (8, 'warnings'), (9, 'misc')) t(pos, name)""",
        (),
    ),
    "mentions": ("SELECT *, unnest(pl) AS path FROM tall", ("tall",)),
    # unique paths over all text columns
    "plist": (
        f"""SELECT i.*, coalesce(f.fam, '') AS fam, {_primary(_all(_SD, _ID, 1))} AS iface,
    list_filter({_text_paths(_POOL_V5, True)}, lambda p: regexp_matches(p, '^(/|[A-Za-z]:\\\\|\\\\\\\\)')) AS plist
  FROM incidents i LEFT JOIN fam_pool f USING (number)""",
        ("fam_pool",),
    ),
    "pairs": ("SELECT number, configuration_item AS ci, fam, iface, unnest(plist) AS path FROM plist", ("plist",)),
    "plist5": (
        f"""SELECT number, configuration_item, iface, CASE WHEN tok = '' THEN '' ELSE {_v2_family('tok')} END AS fam,
    list_filter({_text_paths('txt', False)}, lambda p: regexp_matches(p, '^(/|[A-Za-z]:\\\\)')) AS plist FROM (
  SELECT *, {_POOL_V4} AS txt, {_primary(_all(_SD, _ID, 1))} AS iface, regexp_extract({_POOL_V4}, '{_V2_TOKEN}', 1) AS tok FROM incidents)""",
        ("incidents",),
    ),
    "pairs5": ("SELECT number, configuration_item AS ci, fam, iface, unnest(plist) AS path FROM plist5", ("plist5",)),
}


def _paths_of(pairs: str) -> str:
    return f"""
SELECT p.path, p.incident_count, p.configuration_items, p.error_families, coalesce(t.txt, '') AS top_primary_interfaces
FROM (SELECT path, count(DISTINCT number) AS incident_count,
        coalesce(string_agg(DISTINCT ci, '; ' ORDER BY ci) FILTER (WHERE trim(ci) <> ''), '') AS configuration_items,
        coalesce(string_agg(DISTINCT fam, '; ' ORDER BY fam) FILTER (WHERE trim(fam) <> ''), '') AS error_families
      FROM {pairs} GROUP BY path) p
LEFT JOIN (SELECT path, string_agg(iface || ' (' || n || ')', '; ' ORDER BY n DESC, iface) AS txt FROM (
      SELECT path, iface, n, row_number() OVER (PARTITION BY path ORDER BY n DESC, iface) AS r
      FROM (SELECT path, iface, count(*) AS n FROM {pairs} WHERE iface IS NOT NULL GROUP BY path, iface)) WHERE r <= 5 GROUP BY path) t
USING (path)"""


_CTES["ptable"] = (_paths_of("pairs"), ("pairs",))


#: Text operators also run over real texts.
TEXT_QUERIES = (
    "interfaces", "error_codes", "error_family_v2", "error_family_v3", "error_family_lexicon", "paths_rooted", "paths_general",
    "normalize_path", "ftp_code_message", "hosts", "script_name",
)


def _with(body: str, *needs: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for dep in _CTES[name][1]:
                visit(dep)
            ordered.append(name)

    for n in needs:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({_CTES[n][0]})" for n in ordered)
    return f"WITH {ctes}\n{body}"


def _rows(columns: str) -> str:
    return _with(f"SELECT number, {columns} FROM incidents", "incidents")


def _tally(source: str, key: str, where: str = "true", n: int | None = None, unknown: bool = False, count: str = "count") -> str:
    value = f"coalesce({key}, 'UNKNOWN')" if unknown else key
    keep = where if unknown else f"({where}) AND {key} IS NOT NULL"
    tail = f" ORDER BY 2 DESC, 1 LIMIT {n}" if n else ""
    return _with(f"SELECT {value} AS {key}, count(*) AS {count} FROM {source} WHERE {keep} GROUP BY 1{tail}", source)


def _scenario(key: str, scenario: str, source: str = "tall") -> str:
    unknown = key in ("primary_interface", "host_tag", "ftp_command", "ftp_code")
    return _tally(source, key, f"scenario = '{scenario}'", unknown=unknown, count="incidents_count")


_PATH_COLUMNS = "path, incident_count, configuration_items, error_families, top_primary_interfaces"
_V3_ERR = f"SELECT *, {_v3_family('tok')} AS fam3 FROM (SELECT *, regexp_extract({_PREFER}, '{_V3_TOKEN}', 1) AS tok FROM incidents)"
_V4_ERR = f"SELECT *, {_v3_family('tok')} AS fam4 FROM (SELECT *, regexp_extract({_POOL_V4}, '{_V4_TOKEN}', 1) AS tok FROM incidents)"
_CTES["f3"] = (_V3_ERR, ("incidents",))
_CTES["f4"] = (_V4_ERR, ("incidents",))


def _features(text: str, token: str, v3: bool) -> str:
    ops = _OPS_V3 if v3 else _OPS_V4
    cols = f"""{_v3_family('tok')} AS error_family_extracted,
  regexp_extract(txt, '{_TRIPLET}', 1) AS src_interface, regexp_extract(txt, '{_TRIPLET}', 2) AS route_or_mid,
  regexp_extract(txt, '{_TRIPLET}', 3) AS dst_interface, {_timestamp('txt', v3)} AS extracted_timestamp,
  {_operation('txt')} AS operation, {_success('txt', ops, ('addr_in_use',) if v3 else ())} AS operation_success,
  {_tags('txt', ops)} AS operation_tags, {_code('txt')} AS ftp_code, {_message('txt')} AS ftp_message,
  {_hosts('txt', v3)} AS hosts, {_join(_text_paths('txt', False))} AS paths,
  {_join(_ordered_distinct(_all('txt', _WILD_V3 if v3 else _WILD_V4)))} AS file_patterns,
  {_bigint('txt', r'(?i)\bfrom\s+(\d+)\s+min\b')} AS stuck_minutes, {_bigint('txt', r':-\s*(\d+)\b')} AS stuck_count"""
    if v3:
        cols += r", regexp_extract(txt, '\bClass:\s*(FMS_[A-Z_]+)', 1) AS fms_err_class"
    return f"""SELECT number, {cols}
FROM (SELECT number, {text} AS txt, regexp_extract({text}, '{token}', 1) AS tok FROM incidents)"""


_CODE = r"\b([45]\d{2})\b(?:\s+([^.]+))?"
_WILD_V3 = r"\b[^\s/:\\]+?\*[^ \t:/\\]*\b"
_WILD_V4 = r"\b[^\s/:]+?\*[^ \t:/\\]*\b"


def _code(text: str) -> str:
    return f"regexp_extract({text}, '{_CODE}', 1)"


def _message(text: str) -> str:
    return f"regexp_replace(trim(regexp_extract({text}, '{_CODE}', 2)), '[ .;:]+$', '')"


def _chain_ids(text: str) -> str:
    return f"list_filter(string_split({text}, '-'), lambda s: regexp_full_match(s, '[EIU][0-9]{{3,6}}[A-Z]?'))"


_CHAIN = f"""CASE WHEN len({_chain_ids('sd')}) >= 2 THEN array_to_string({_chain_ids('sd')}, '-')
  WHEN len(ids) >= 2 THEN array_to_string(ids, '-') END"""
_RAW_WORDS = f"list_filter(regexp_extract_all(sd, '\\S+'), lambda w: contains(w, '-') AND len({_chain_ids('w')}) >= 2)"
_RAW = f"list_filter({_RAW_WORDS}, lambda w: length(w) = list_max(list_transform({_RAW_WORDS}, lambda y: length(y))))[1]"
_FIRED = r"\b\d{4}-\d{2}-\d{2}T[0-9:.\-]+Z?\b"
_DAY_V2 = _DAY.replace("[A-Za-z]{3}", "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)")
_FIRED_OK = f"CASE WHEN try_cast(replace({_first('sd', _FIRED)}, 'Z', '') AS TIMESTAMP) IS NOT NULL THEN {_first('sd', _FIRED)} END"
_FIRED_TIME = f"coalesce({_FIRED_OK}, {_day_iso(_first('sd', _DAY_V2))})"
_FIRED_SOURCE = f"CASE WHEN ({_FIRED_OK}) IS NULL THEN {_first('sd', _DAY_V2)} END"
_SCRIPT = _first("sd", r"([A-Za-z0-9_\-]+\.sh)\b", 1)
_WARN = f"CASE WHEN error_family = 'WARNING' THEN substr({_first('sd', r'WARNING:\s*(.+)', 1)}, 1, 200) END"
_CALLER = """CASE WHEN lower(caller) LIKE '%netcool%' THEN 'NetCool'
  WHEN regexp_matches(lower(caller), 'int[_ -]mft api_prod') THEN 'INT_MFT API_PROD'
  WHEN lower(caller) LIKE '%atos%' THEN 'Atos Events' ELSE 'Other' END"""
_HELPER_COLUMNS = (
    "error_family, stuck_files_count, stuck_for_minutes, paths, has_path, ftp_command, ftp_code, interfaces, "
    "primary_interface, permission_denied, not_connected"
)
_SUMMARY = """SELECT name AS "group", (SELECT count(*) FROM tall WHERE scenario = name) AS count,
  (SELECT count(*) FROM tags) AS total_rows,
  CAST((SELECT count(*) FROM tall WHERE scenario <> 'misc') AS DOUBLE) / (SELECT count(*) FROM tags) * 100.0 AS coverage_pct,
  CAST((SELECT count(DISTINCT number) FROM tall WHERE scenario <> 'misc') AS DOUBLE) / (SELECT count(*) FROM tags) * 100.0 AS coverage_distinct_pct
FROM names"""
_STUCK = "scenario = 'stuck-files'"
_FTP = "scenario = 'ftp-errors'"


def _unk(key: str) -> str:
    return f"coalesce({key}, 'UNKNOWN')"


_PERM = f"""SELECT {_unk('primary_interface')} AS primary_interface, CAST(sum(CAST(permission_denied AS INT)) AS BIGINT) AS permission_denied,
  CAST(sum(CAST(not_connected AS INT)) AS BIGINT) AS not_connected, count(*) AS incidents_count FROM tall WHERE {_FTP} GROUP BY 1"""
_DAYS = "(VALUES ('Monday'), ('Tuesday'), ('Wednesday'), ('Thursday'), ('Friday'), ('Saturday'), ('Sunday')) d(dow)"


def _hist(col: str) -> str:
    width = "((hi - lo) / 30)"
    b = f"CASE WHEN hi > lo THEN least(CAST(floor((v - lo) / {width}) AS BIGINT), 29) ELSE 0 END"
    return f"""SELECT bin, lo + bin * w AS lower, lo + (bin + 1) * w AS upper, count(*) AS count, '{col}' AS metric FROM (
  SELECT {b} AS bin, lo, {width} AS w FROM (
    SELECT CAST({col} AS DOUBLE) AS v, CAST(min({col}) OVER () AS DOUBLE) AS lo, CAST(max({col}) OVER () AS DOUBLE) AS hi
    FROM v2t WHERE {col} IS NOT NULL)) GROUP BY bin, lo, w"""


def _pareto(source: str, key: str, n: int) -> str:
    return f"""SELECT value, count, CAST(sum(count) OVER (ORDER BY count DESC, value ROWS UNBOUNDED PRECEDING) AS DOUBLE)
  / CAST(sum(count) OVER () AS DOUBLE) * 100.0 AS cum_pct
FROM (SELECT {key} AS value, count(*) AS count FROM {source} WHERE {key} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {n})"""


def _avg(flag: str) -> str:
    return f"avg(CAST({flag} AS INT))"


_FILTER_COLUMNS = "number, primary_interface, error_family, ftp_command, month, dow, hour"
_SUBGROUPS = " UNION ALL ".join(
    f"SELECT '{s}' AS scenario, '{kind}' AS kind, {_unk(k)} AS value, count(*) AS count FROM tall WHERE scenario = '{s}' GROUP BY 3"
    for s, k, kind in (
        ("stuck-files", "primary_interface", "by-interface"),
        ("ftp-errors", "ftp_command", "by-verb"),
        ("ftp-errors", "ftp_code", "by-code"),
    )
)
_RUN = "'run_' || strftime(opened, '%Y-%m')"


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    # sources and sinks
    sql["scan_csv"] = _rows(
        "opened_raw, caller, short_description, nullif(description, '') AS description, nullif(resolution_notes, '') AS resolution_notes")
    sql["sheet_select"] = _with("SELECT number, source_sheet FROM incidents WHERE source_sheet = 'sheet1'", "incidents")
    sql["sheet_union"] = _with(
        """SELECT number, CASE WHEN source_sheet <> 'sheet2' THEN status END AS status,
  CASE WHEN source_sheet <> 'sheet0' THEN comments END AS comments, source_sheet FROM incidents""", "incidents")
    sql["per_sheet_rollup"] = _with(
        "SELECT source_sheet, fam3 AS error_family, count(*) AS count FROM f3 WHERE fam3 <> '' GROUP BY 1, 2", "f3")
    sql["lexicon_load"] = _with(
        "SELECT row_number() OVER (ORDER BY category DESC) - 1 AS position, category AS family FROM (SELECT DISTINCT category FROM incidents)", "incidents")
    sql["ci_lookup_scan"] = _with(
        """SELECT configuration_item AS ci, max(severity) AS ci_role, min(category) AS ci_protocol, max(source_sheet) AS ci_env,
  min(assignment_group) AS ci_techstack, CAST(count(*) AS VARCHAR) AS ci_criticality
FROM incidents WHERE configuration_item IS NOT NULL GROUP BY 1""", "incidents")
    sql["read_group"] = _with(
        f"""SELECT number, {_RUN} AS run_id, scenario FROM tall
WHERE scenario = 'callout_mfterr03' AND {_RUN} = (SELECT max({_RUN}) FROM tall)""", "tall")
    sql["latest_run"] = _with(
        f"SELECT number, {_RUN} AS run_id, scenario FROM tall WHERE {_RUN} = (SELECT max({_RUN}) FROM tall)", "tall")
    sql["summary_read"] = _with(_SUMMARY.replace('name AS "group"', "replace(name, 'callout_', 'callout/') AS \"group\""), "tall", "names")
    sql["sink_roundtrip"] = _with(
        "SELECT number, CAST(opened_dt AS VARCHAR) AS opened_dt, primary_interface, error_family, stuck_for_minutes, source_sheet FROM enr", "enr")
    sql["scenario_sink"] = _with(f"SELECT {_RUN} AS run_id, scenario, count(*) AS count FROM tall GROUP BY 1, 2", "tall")
    sql["subgroup_sink"] = _with(
        f"SELECT {_unk('primary_interface')} AS by_primary_interface, count(*) AS count FROM tall WHERE {_STUCK} GROUP BY 1", "tall")
    sql["subgroup_counts"] = _with(_SUBGROUPS, "tall")
    sql["misc_samples"] = _with(
        "SELECT number, short_description FROM tags WHERE len(found) = 0 ORDER BY opened, number LIMIT 200", "tags")
    # projections
    sql["schema_normalize"] = _rows(
        "caller, assigned_to, assignment_group, CAST(NULL AS VARCHAR) AS configuration_item, CAST(NULL AS VARCHAR) AS comments")
    sql["trim_strings"] = _rows("trim(status) AS status, trim(short_description) AS short_description, trim(caller) AS caller")
    sql["shortdesc_extract"] = _with(
        f"""SELECT number, short_description, caller, status, severity, assignment_group, CAST(opened AS VARCHAR) AS opened,
  interfaces, primary_interface, len(ids) AS interface_count, {_CHAIN} AS interface_chain, {_RAW} AS interface_chain_raw,
  error_family, error_codes, ftp_command, ftp_code, paths, has_path, stuck_files_count, stuck_for_minutes,
  {_FIRED_TIME} AS fired_time, {_FIRED_SOURCE} AS fired_time_source, {_SCRIPT} AS script_name, host_tag,
  {_WARN} AS warning_subject, {_CALLER} AS caller_class FROM v2""", "v2")
    sql["desc_features"] = _with(_features(_PREFER, _V3_TOKEN, True), "incidents")
    sql["desc_features_only"] = _with(f"SELECT * EXCLUDE (number) FROM ({_features(_PREFER, _V3_TOKEN, True)})", "incidents")
    sql["shortdesc_features"] = _with(_features(_POOL_V4, _V4_TOKEN, False), "incidents")
    sql["ensure_helpers"] = _with(
        f"""SELECT number, * EXCLUDE (number, severity) REPLACE (CASE WHEN severity = '1' THEN 'GIVEN' ELSE error_family END AS error_family,
  CASE WHEN severity = '2' THEN 7 ELSE stuck_files_count END AS stuck_files_count)
FROM (SELECT number, severity, {_HELPER_COLUMNS} FROM v2)""", "v2")
    sql["ensure_helpers_default"] = _rows(
        """CASE WHEN severity = '1' THEN 'GIVEN' END AS error_family, CASE WHEN severity = '2' THEN CAST(7 AS BIGINT) END AS stuck_files_count,
  CAST(NULL AS BIGINT) AS stuck_for_minutes, CAST(NULL AS VARCHAR) AS paths, false AS has_path, CAST(NULL AS VARCHAR) AS ftp_command,
  CAST(NULL AS VARCHAR) AS ftp_code, CAST(NULL AS VARCHAR) AS interfaces, CAST(NULL AS VARCHAR) AS primary_interface,
  false AS permission_denied, false AS not_connected""")
    sql["text_pool"] = _rows(f"{_pool('short_description', 'resolution_notes', 'description', 'comments')} AS text")
    sql["text_prefer"] = _rows("CASE WHEN trim(coalesce(description, '')) <> '' THEN description ELSE short_description END AS text")
    sql["perm_conn_melt"] = _with(
        f"""SELECT primary_interface, incidents_count, 'permission_denied' AS category, permission_denied AS count FROM ({_PERM})
UNION ALL SELECT primary_interface, incidents_count, 'not_connected', not_connected FROM ({_PERM})""", "tall")
    sql["explode_paths"] = _with("SELECT number, unnest(pl) AS path FROM v2", "v2")
    split = f"list_filter(list_transform(regexp_split_to_array({_SD}, '[,;\\n]+'), lambda x: {_norm('x')}), lambda x: x <> '')"
    sql["paths_cell_split"] = _rows(f"{_join(split, ' | ')} AS parts, len({split}) AS n")
    options = ("primary_interface", "error_family", "ftp_command", "ftp_code", "month")
    sql["filter_options"] = _with(
        " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS option, {c} AS value FROM v2t WHERE {c} IS NOT NULL" for c in options), "v2t")
    sql["ci_choices"] = _with(
        """SELECT DISTINCT 'configuration_items' AS option, ci AS value FROM pairs WHERE trim(ci) <> ''
UNION ALL SELECT DISTINCT 'error_families', fam FROM pairs WHERE trim(fam) <> ''""", "pairs")
    # extraction
    ids = _all(_SD, _ID, 1)
    sql["interfaces"] = _rows(f"{_join_null(ids)} AS interfaces")
    sql["primary_interface"] = _rows(f"{_primary(ids)} AS primary_interface")
    sql["interface_count"] = _rows(f"len({ids}) AS interface_count")
    sql["interface_chain"] = _with(f"SELECT number, {_CHAIN} AS interface_chain FROM v2", "v2")
    sql["interface_chain_raw"] = _with(f"SELECT number, {_RAW} AS interface_chain_raw FROM v2", "v2")
    sql["triplet"] = _rows(", ".join(
        f"regexp_extract({_DE}, '{_TRIPLET}', {i}) AS {n}" for i, n in enumerate(("src_interface", "route_or_mid", "dst_interface"), 1)))
    sql["error_codes"] = _with("SELECT number, error_codes FROM v2", "v2")
    alias = "CASE coalesce({0}.fam, 'other') WHEN 'FTP error' THEN 'FMS-FTP-ERROR' ELSE coalesce({0}.fam, 'other') END"
    sql["error_family_lexicon"] = _with(
        f"""SELECT number, {alias.format('d')} AS error_family, {alias.format('s')} AS error_family_short
FROM incidents LEFT JOIN fam_desc d USING (number) LEFT JOIN fam_short s USING (number)""", "fam_desc", "fam_short")
    sql["error_family_v2"] = _with("SELECT number, error_family FROM v2", "v2")
    sql["error_family_v3"] = _with("SELECT number, fam3 AS error_family FROM f3", "f3")
    sql["error_family_v4"] = _with("SELECT number, fam4 AS error_family FROM f4", "f4")
    sql["family_rederive"] = _with(
        "SELECT number, CASE WHEN severity = '1' THEN 'GIVEN' ELSE coalesce(fam, '') END AS error_family FROM incidents LEFT JOIN fam3 USING (number)", "fam3")
    sql["family_rederive_forced"] = _with(
        "SELECT number, coalesce(fam, '') AS error_family FROM incidents LEFT JOIN fam3 USING (number)", "fam3")
    hits = _ordered_distinct(f"list_transform({_all('sd', _ANOMALIES)}, lambda h: lower(trim(h)))")
    strip = "regexp_replace({0}, '[^a-z0-9]', '', 'g')"
    fresh = f"list_filter({hits}, lambda h: NOT contains({strip.format('lower(fam)')}, {strip.format('h')}))"
    sql["anomalies"] = _with(
        f"""SELECT number, {_join_null(fresh, '; ')} AS anomalies
FROM (SELECT number, {_SD} AS sd, {alias.format('s')} AS fam FROM incidents LEFT JOIN fam_short s USING (number))""", "fam_short")
    v1 = _all(_SD, r"/(?:var|opt|data)[^\s]*")
    sql["paths_rooted"] = _with(
        f"SELECT number, {_join_null(v1, ' ')} AS paths_v1, {_join_null('pl', ' ')} AS paths_v2, has_path FROM v2", "v2")
    sql["paths_general"] = _rows(
        f"{_join(_text_paths(_POOL_V5, True))} AS paths_v5, {_join(_text_paths(_POOL_V5, False))} AS paths_v3")
    sql["normalize_path"] = _rows(f"{_norm('short_description')} AS path")
    sql["paths_absolute"] = _rows(
        f"{_join(f'''list_filter(string_split({_SD}, ' '), lambda p: regexp_matches(p, '^(/|[A-Za-z]:\\\\|\\\\\\\\)'))''')} AS absolute_words")
    tok5 = f"list_transform({_all(_SD, r'[A-Za-z0-9_./\\-]+')}, lambda p: {_norm('p')})"
    tok3 = _ordered_distinct(f"list_filter({_all(_SD, r'[A-Za-z0-9_./\\:-]+')}, lambda p: length(p) > 3)")
    sql["paths_fallback"] = _rows(
        f"""CASE WHEN len({_text_paths(_SD, True)}) > 0 THEN {_join(_text_paths(_SD, True))} ELSE {_join(tok5)} END AS tokens_v5,
  CASE WHEN len({_text_paths(_SD, False)}) > 0 THEN {_join(_text_paths(_SD, False))} ELSE {_join(tok3)} END AS tokens_v3""")
    sql["file_patterns"] = _rows(
        f"{_join(_ordered_distinct(_all(_SD, _WILD_V3)))} AS patterns_v3, {_join(_ordered_distinct(_all(_SD, _WILD_V4)))} AS patterns_v4")
    sql["stuck_metrics"] = _with(
        f"""SELECT number, stuck_files_count, stuck_for_minutes, {_bigint('description', r':-\s*(\d+)\b')} AS stuck_count,
  {_bigint('description', r'(?i)\bfrom\s+(\d+)\s+min\b')} AS stuck_minutes FROM v2""", "v2")
    sql["ftp_command"] = _with("SELECT number, ftp_command, ftp_code FROM v2", "v2")
    sql["ftp_code_message"] = _rows(
        f"{_code(_SD)} AS ftp_code, {_message(_SD)} AS ftp_message, {_code(_DE)} AS desc_code, {_message(_DE)} AS desc_message")
    sql["operation_tags"] = _rows(f"{_tags(_PREFER, _OPS_V3)} AS tags_v3, {_tags(_POOL_V4, _OPS_V4)} AS tags_v4")
    sql["operation"] = _rows(
        f"""{_operation(_PREFER)} AS operation_v3, {_success(_PREFER, _OPS_V3, ('addr_in_use',))} AS success_v3,
  {_operation(_POOL_V4)} AS operation_v4, {_success(_POOL_V4, _OPS_V4)} AS success_v4""")
    sql["hosts"] = _rows(f"{_hosts(_POOL_V4, True)} AS hosts_v3, {_hosts(_POOL_V4, False)} AS hosts_v4")
    sql["host_tag"] = _with("SELECT number, host_tag FROM v2", "v2")
    sql["script_name"] = _with(f"SELECT number, {_SCRIPT} AS script_name FROM v2", "v2")
    sql["warning_subject"] = _with(f"SELECT number, {_WARN} AS warning_subject FROM v2", "v2")
    sql["fms_class"] = _rows(rf"regexp_extract({_DE}, '\bClass:\s*(FMS_[A-Z_]+)', 1) AS fms_err_class")
    sql["fired_time"] = _with(f"SELECT number, {_FIRED_TIME} AS fired_time, {_FIRED_SOURCE} AS fired_time_source FROM v2", "v2")
    sql["extracted_timestamp"] = _rows(
        f"""{_timestamp(_POOL_V4, True)} AS timestamp_v3, {_timestamp(_POOL_V4, False)} AS timestamp_v4,
  {_timestamp(_DE, False)} AS timestamp_desc""")
    sql["caller_class"] = _rows(f"{_CALLER} AS caller_class")
    sql["status_canonical"] = _rows(f"{_STATUS} AS status_canonical")
    sql["closure_quality"] = _rows(f"contains({_NOTES}, 'intermittent') AS is_intermittent, {_SCORE} AS closure_quality_score")
    sql["perm_conn_flags"] = _with("SELECT number, permission_denied, not_connected FROM v2", "v2")
    # time
    sql["opened_formats"] = _rows(
        """CAST(date_trunc('minute', opened) AS VARCHAR) AS form_0, CAST(date_trunc('minute', opened) AS VARCHAR) AS form_1,
  CAST(date_trunc('minute', opened) AS VARCHAR) AS form_2, CAST(CAST(date_trunc('day', opened) AS TIMESTAMP) AS VARCHAR) AS form_3""")
    sql["opened_unread"] = _with(
        "SELECT count(*) AS rows, count(*) FILTER (WHERE opened_raw = 'not a date') AS unread, CAST(0 AS BIGINT) AS missing FROM incidents", "incidents")
    sql["opened_parse"] = _rows(f"CAST({_OPENED} AS VARCHAR) AS opened_dt")
    sql["time_grains"] = _with("SELECT number, month, week, dow, hour, daypart FROM enr", "enr")
    # filters
    sql["filter_exact"] = _with(
        f"SELECT {_FILTER_COLUMNS} FROM v2t WHERE error_family = 'FMS-FTP-ERROR' AND ftp_command = 'PUT' AND ftp_code = '550'", "v2t")
    sql["filter_text"] = _with(
        f"""SELECT {_FILTER_COLUMNS} FROM v2t WHERE contains(lower(concat_ws(' ', short_description, paths, error_codes, resolution_notes)), 'e000012')""", "v2t")
    sql["filter_time"] = _with(
        f"SELECT {_FILTER_COLUMNS} FROM v2t WHERE dow IN ('Monday', 'Tuesday') AND hour BETWEEN 8 AND 17", "v2t")
    sql["filter_paths_global"] = _with(
        f"""SELECT {_PATH_COLUMNS} FROM ptable WHERE error_families ILIKE '%fms%' AND top_primary_interfaces ILIKE '%e0000%'
  AND concat_ws(' ', {_PATH_COLUMNS.replace('incident_count, ', '')}) ILIKE '%/opt%'""", "ptable")
    sql["filter_paths_specific"] = _with(
        f"""SELECT {_PATH_COLUMNS} FROM ptable WHERE starts_with(path, '/opt') AND incident_count >= 2
  AND list_contains(string_split(configuration_items, '; '), 'CI-1')""", "ptable")
    base = r"regexp_extract(path, '([^/]+)/*$', 1)"
    sql["basename_filter"] = _with(
        f"SELECT path, incident_count, {base} AS basename FROM ptable WHERE contains(lower({base}), 'e00001')", "ptable")
    drill = " OR ".join(f"contains(lower(coalesce({c}, '')), lower({{0}}))" for c in ("paths", "short_description", "resolution_notes"))
    sql["drill_through"] = _with(f"""SELECT number, paths FROM v2t WHERE {drill.format("'/opt/big/configs/E00001'")}""", "v2t")
    sql["drill_through_all"] = _with(
        f"""SELECT path, (SELECT count(*) FROM v2t WHERE {drill.format('p.path')}) AS matching_incidents FROM ptable p""", "ptable", "v2t")
    sql["preview"] = _with("SELECT number, status FROM incidents ORDER BY opened, number LIMIT 10000", "incidents")
    # scenarios
    sql["scenario_counts"] = _with(
        'SELECT name AS "group", (SELECT count(*) FROM tall WHERE scenario = name) AS count FROM names', "tall", "names")
    sql["scenario_tall"] = _with("SELECT number, scenario FROM tall", "tall")
    sql["partition_summary"] = _with(_SUMMARY, "tall", "names")
    # joins and windows
    sql["ci_join"] = _with(
        """SELECT number, configuration_item AS ci, CASE WHEN ci_env = 'dev' THEN 'replaced' ELSE ci_role END AS ci_role,
  ci_protocol, ci_env, ci_techstack, ci_criticality FROM incidents LEFT JOIN lookup ON configuration_item = lookup.ci""", "incidents", "lookup")
    sql["recurrence"] = _with(
        """SELECT number, primary_interface, error_family, CAST(opened_dt AS VARCHAR) AS opened_dt,
  CAST(prev_time AS VARCHAR) AS prev_time, recurs_24h FROM rec""", "rec")
    sql["recurrence_pairs"] = _with(
        """SELECT primary_interface, error_family, CAST(sum(CAST(recurs_24h AS INT)) AS BIGINT) AS recurs_24h_count
FROM rec WHERE primary_interface IS NOT NULL GROUP BY 1, 2""", "rec")
    sql["path_dedup"] = _with(
        "SELECT number, path, ci AS configuration_item, iface AS primary_interface FROM pairs", "pairs")
    sql["path_scan_stats"] = _with(
        """SELECT count(*) AS rows_in, count(*) FILTER (WHERE len(plist) > 0) AS incidents_with_path,
  CAST(sum(len(plist)) AS BIGINT) AS exploded_rows FROM plist""", "plist")
    sql["unique_paths"] = _with(f"SELECT {_PATH_COLUMNS} FROM ptable", "ptable")
    sql["unique_paths_read"] = _with(
        """SELECT path, incident_count, nullif(configuration_items, '') AS configuration_items, nullif(error_families, '') AS error_families,
  nullif(top_primary_interfaces, '') AS top_primary_interfaces FROM ptable""", "ptable")
    sql["unique_paths_min"] = _with(f"SELECT {_PATH_COLUMNS} FROM ptable WHERE incident_count >= 5", "ptable")
    sql["unique_paths_fixed"] = _with(_paths_of("pairs5"), "pairs5")
    sql["top_paths"] = _with("SELECT path, incident_count FROM ptable ORDER BY incident_count DESC, path LIMIT 30", "ptable")
    # rollups
    sql["kpis"] = _with(
        f"""SELECT count(*) AS total_incidents, count(*) FILTER (WHERE status_canonical IN ('Resolved', 'Closed')) AS closed_incidents,
  count(*) FILTER (WHERE status_canonical IS NULL OR status_canonical NOT IN ('Resolved', 'Closed')) AS open_incidents,
  {_avg('is_intermittent')} AS intermittent_ratio FROM enr""", "enr")
    sql["top_interfaces"] = _tally("enr", "primary_interface", n=15)
    sql["top_error_families"] = _tally("enr", "error_family", n=10)
    sql["ci_error_pairs"] = _with("SELECT ci, error_family, count(number) AS count FROM enr GROUP BY 1, 2", "enr")
    sql["ci_error_pairs_top"] = _with(
        """SELECT coalesce(ci, '(none)') || ' × ' || error_family AS pair, count FROM (
  SELECT ci, error_family, count(number) AS count FROM enr GROUP BY 1, 2 ORDER BY 3 DESC, 1 NULLS FIRST, 2 LIMIT 10)""", "enr")
    sql["quality_checks"] = _with(
        f"""SELECT {_avg('primary_interface IS NULL')} AS pct_no_interface, {_avg("error_family = 'other'")} AS pct_other_error_family,
  count(stuck_files_count) AS rows_with_stuck_files_count, count(stuck_for_minutes) AS rows_with_stuck_for_minutes,
  coalesce(avg(CAST(recurs_24h AS INT)) FILTER (WHERE is_intermittent), 0) AS intermittent_with_recurrence_ratio FROM rec""", "rec")
    sql["monthly_trend"] = _with("SELECT month, count(number) AS count FROM enr GROUP BY 1", "enr")
    sql["dow_counts"] = _with(
        f"SELECT d.dow, c.count FROM {_DAYS} LEFT JOIN (SELECT dow, count(number) AS count FROM enr GROUP BY 1) c USING (dow)", "enr")
    hours = ", ".join(f"count(*) FILTER (WHERE e.hour = {h}) AS h{h:02d}" for h in range(24))
    sql["dow_hour_matrix"] = _with(f"SELECT d.dow, {hours} FROM {_DAYS} LEFT JOIN enr e USING (dow) GROUP BY 1", "enr")
    sql["error_family_pareto"] = _with(_pareto("enr", "error_family", 20), "enr")
    sql["shortdesc_top"] = _tally("v2", "primary_interface", n=30)
    sql["shortdesc_top_families"] = _tally("v2", "error_family", n=30)
    stats = {
        "pct_rows_with_primary_interface": "primary_interface IS NOT NULL", "pct_rows_with_error_codes": "error_codes IS NOT NULL",
        "pct_rows_with_paths": "has_path", "pct_rows_with_interface_chain": f"({_CHAIN}) IS NOT NULL",
    }
    sql["shortdesc_stats"] = _with(
        "SELECT 'rows_total' AS metric, CAST(count(*) AS DOUBLE) AS value FROM v2 UNION ALL "
        + " UNION ALL ".join(f"SELECT '{m}', {_avg(f)} FROM v2" for m, f in stats.items()), "v2")
    sql["by_error_family"] = _with("SELECT fam3 AS error_family, count(*) AS count FROM f3 WHERE fam3 <> '' GROUP BY 1", "f3")
    sql["by_error_family_all"] = _with(
        """SELECT error_family, CAST(sum(n) AS BIGINT) AS count FROM (
  SELECT source_sheet, fam4 AS error_family, count(*) AS n FROM f4 WHERE fam4 <> '' GROUP BY 1, 2) GROUP BY 1""", "f4")
    sql["by_triplet"] = _with(
        f"SELECT triplet, count(*) AS count FROM (SELECT regexp_extract({_POOL_V4}, '{_TRIPLET}') AS triplet FROM incidents) WHERE triplet <> '' GROUP BY 1", "incidents")
    sql["by_triplet_sheets"] = _with(
        f"SELECT source_sheet, triplet, count(*) AS count FROM (SELECT source_sheet, regexp_extract({_PREFER}, '{_TRIPLET}') AS triplet FROM incidents) WHERE triplet <> '' GROUP BY 1, 2", "incidents")
    sql["stuck_histogram"] = _with(f"{_hist('stuck_files_count')} UNION ALL {_hist('stuck_for_minutes')}", "v2t")
    sql["filtered_top_interfaces"] = _tally("v2t", "primary_interface", "hour BETWEEN 6 AND 18", n=20)
    # scenario tables
    sql["stuck_paths_counts"] = _scenario("path", "stuck-files", "mentions")
    sql["stuck_paths_stats"] = _with(
        f"""SELECT path, count(*) AS incidents_count, CAST(sum(coalesce(stuck_files_count, 0)) AS DOUBLE) AS total_stuck_files,
  avg(CAST(stuck_for_minutes AS DOUBLE)) AS mean_minutes, median(CAST(stuck_for_minutes AS DOUBLE)) AS median_minutes,
  CAST(min(stuck_for_minutes) AS DOUBLE) AS min_minutes, CAST(max(stuck_for_minutes) AS DOUBLE) AS max_minutes
FROM mentions WHERE {_STUCK} GROUP BY 1""", "mentions")
    sql["stuck_top_interfaces"] = _with(
        f"""SELECT {_unk('primary_interface')} AS primary_interface, count(*) AS incidents_count,
  CAST(sum(coalesce(stuck_files_count, 0)) AS DOUBLE) AS total_stuck_files FROM tall WHERE {_STUCK} GROUP BY 1""", "tall")
    sql["ftp_by_verb"] = _scenario("ftp_command", "ftp-errors")
    sql["ftp_by_code"] = _scenario("ftp_code", "ftp-errors")
    ivc = ", ".join(f"{_unk(k)} AS {k}" for k in ("primary_interface", "ftp_command", "ftp_code"))
    sql["ftp_iface_verb_code"] = _with(f"SELECT {ivc}, count(*) AS incidents_count FROM tall WHERE {_FTP} GROUP BY 1, 2, 3", "tall")
    sql["ftp_tables"] = _with(
        f"""SELECT CAST(NULL AS VARCHAR) AS primary_interface, {_unk('ftp_command')} AS ftp_command, CAST(NULL AS VARCHAR) AS ftp_code, 'by_verb' AS "table", count(*) AS incidents_count
  FROM tall WHERE {_FTP} GROUP BY 2
UNION ALL SELECT NULL, NULL, {_unk('ftp_code')}, 'by_code', count(*) FROM tall WHERE {_FTP} GROUP BY 3
UNION ALL SELECT {_unk('primary_interface')}, {_unk('ftp_command')}, {_unk('ftp_code')}, 'by_interface_verb_code', count(*) FROM tall WHERE {_FTP} GROUP BY 1, 2, 3""", "tall")
    sql["ftp_permission_connectivity"] = _with(_PERM, "tall")
    sql["config_bad_paths"] = _tally("mentions", "path", "scenario = 'config-file' AND starts_with(path, '/opt/big/configs')", count="incidents_count")
    sql["config_top_interfaces"] = _scenario("primary_interface", "config-file")
    sql["err_remove_by_interface"] = _scenario("primary_interface", "err-file-remove")
    sql["err_remove_paths"] = _scenario("path", "err-file-remove", "mentions")
    sql["process_alert_by_interface"] = _scenario("primary_interface", "process-alert")
    sql["process_alert_time"] = _with(
        "SELECT month, count(primary_interface) AS incidents_count FROM tall WHERE scenario = 'process-alert' GROUP BY 1", "tall")
    for name, key in (("callout_interfaces", "primary_interface"), ("callout_hosts", "host_tag")):
        sql[name] = _with(
            f"SELECT scenario, {_unk(key)} AS {key}, count(*) AS incidents_count FROM tall WHERE scenario LIKE 'callout%' GROUP BY 1, 2", "tall")
    sql["warnings_hosts"] = _scenario("host_tag", "warnings")
    sql["warnings_fs_paths"] = _scenario("path", "warnings", "mentions")
    sql["misc_error_codes"] = _with(
        f"""SELECT error_code, count(*) AS count FROM (SELECT unnest({_ordered_distinct('codes')}) AS error_code FROM tall WHERE scenario = 'misc') GROUP BY 1""", "tall")
    sql["misc_top_tokens"] = _with(
        r"""SELECT token, count(*) AS count FROM (SELECT lower(unnest(regexp_extract_all(sd, '[A-Za-z0-9_/.\-]+'))) AS token
  FROM tall WHERE scenario = 'misc') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 200""", "tall")
    sql["top_offenders"] = _tally("tall", "primary_interface", n=10, unknown=True, count="incidents_count")
    summary = f"""SELECT count(*) AS total_rows, count(*) FILTER (WHERE scenario <> 'misc') AS coverage_non_misc,
  CAST(count(*) FILTER (WHERE scenario <> 'misc') AS DOUBLE) / count(*) * 100.0 AS coverage_pct,
  {{groups}} AS group_counts,
  {_avg('primary_interface IS NULL')} AS pct_missing_primary_interface, {_avg("error_family = 'other'")} AS pct_error_family_other,
  count(stuck_files_count) + count(stuck_for_minutes) AS rows_with_stuck_metrics, count(ftp_command) + count(ftp_code) AS rows_with_ftp_metadata
FROM tall"""
    per_group = "SELECT pos, name, count(scenario) AS n FROM names LEFT JOIN tall ON scenario = name GROUP BY 1, 2"
    sql["run_summary"] = _with(
        summary.format(groups=f"(SELECT string_agg(name || '=' || n, ';' ORDER BY pos) FROM ({per_group}))"), "tall", "names")
    as_map = f"(SELECT map(list(name ORDER BY pos), list(n ORDER BY pos)) FROM ({per_group}))"
    offenders = f"""(SELECT list(struct_pack(primary_interface := k, incidents_count := n) ORDER BY n DESC, k) FROM (
    SELECT {_unk('primary_interface')} AS k, count(*) AS n FROM tall GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10))"""
    sql["summary_json"] = _with(
        f"""SELECT CAST(to_json(s) AS VARCHAR) AS summary
FROM (SELECT *, {offenders} AS top_offenders_interfaces FROM ({summary.format(groups=as_map)})) s""", "tall", "names")
    for name in ("stuck_paths_stats", "ftp_iface_verb_code", "misc_top_tokens", "top_offenders"):
        sql[f"stored_{name}"] = sql[name]
    # The same SQL over whole real texts: only the table differs.
    whole = TEXTS_SQL
    for table in ("documents", "pages", "conversations"):
        whole = whole.replace(f"{{{table}}}", table)
    for name in TEXT_QUERIES:
        sql[f"text_{name}"] = sql[name].replace(_CTES["incidents"][0], whole)
    return sql
