"""Fixed values.

Everything in this module is a constant that results depend on: patterns,
ordered name lists, labels and lookup entries. They are data, stated plainly;
the code that uses them lives in the sibling modules.

Patterns are written for ``java.util.regex``. :func:`faultline.functions.text.rx`
adds the Unicode flag, so ``\\b \\d \\s`` follow the Unicode definitions on every
JDK; ``i`` in a name's comment means case-insensitive.
"""

# --- identifiers and codes ---------------------------------------------------
INTERFACE_ID = r"\b([EIU][0-9]{3,6}[A-Z]?)\b"
INTERFACE_ID_WHOLE = r"^[EIU][0-9]{3,6}[A-Z]?\z"
ERROR_CODE = r"\b([UEI][0-9]{3,6})\b"
PRIMARY_PREFIX_ORDER = ("E", "I", "U")
TRIPLET = r"\b((?:[EIU]\d{6,}|MULTIPLE|INV))-([A-Za-z0-9]+)-((?:[EIU]\d{6,}|MULTIPLE|INV))\b"

# --- paths -------------------------------------------------------------------
PATH_ROOTED_V1 = r"(/(?:var|opt|data)[^\s]*)"
PATH_ROOTED_V2 = r"(/(?:var|opt|data|mnt|etc|home)[^\s:;,)]*)"
PATH_UNIX = r"(/[-A-Za-z0-9_./]+)"
PATH_WINDOWS = r"([A-Za-z]:\\[^\s:;,)]+)"
PATH_UNC = r"(\\\\[A-Za-z0-9._-]+\\[^\s:;,)]+)"
PATH_CELL_SEPARATORS = r"[,;\n]+"
PATH_FALLBACK_TOKEN_V3 = r"[A-Za-z0-9_./\\:-]+"
PATH_FALLBACK_TOKEN_V5 = r"[A-Za-z0-9_./\\-]+"
PATH_ABSOLUTE = r"^(?:/|[A-Za-z]:\\|\\\\)"
PATH_ABSOLUTE_NO_UNC = r"^(?:/|[A-Za-z]:\\)"
FILE_WILDCARD_V3 = r"\b[^\s/:\\]+?\*[^ \t:/\\]*\b"
FILE_WILDCARD_V4 = r"\b[^\s/:]+?\*[^ \t:/\\]*\b"
CONFIG_ROOT = "/opt/big/configs"

# --- stuck files -------------------------------------------------------------
STUCK_COUNT_V1 = r":\s*-\s*(\d+)\b"
STUCK_COUNT_V3 = r":-\s*(\d+)\b"
STUCK_MINUTES_V1 = r"\bfrom\s+(\d+)\s*min\b"  # i
STUCK_MINUTES_V2 = r"from\s+(\d+)\s*min\b"  # i
STUCK_MINUTES_V3 = r"\bfrom\s+(\d+)\s+min\b"  # i

# --- transfer commands, codes, hosts, scripts --------------------------------
FTP_COMMAND = r"\b(Unsuccessful)\s+(PUT|GET)\b"  # i
FTP_CODE_550 = r"\b550\b"
FTP_CODE_MESSAGE = r"\b([45]\d{2})\b(?:\s+([^.]+))?"
APP_HOST = r"\b[a-z][a-z0-9_-]*app[0-9]{3,4}\b"  # i
APP_HOST_END = r"app[0-9]{3,4}\b"  # i
HOST_RUN = "a-z0-9_-"  # i
NAME_RUN = "A-Za-z0-9.-"
SCRIPT_NAME = r"(?<![A-Za-z0-9_\-])([A-Za-z0-9_\-]++\.sh)\b"  # whole runs only, so linear
FMS_CLASS = r"\bClass:\s*(FMS_[A-Z_]+)"
WARNING_SUBJECT = r"WARNING:\s*([^\n]+)"
WARNING_SUBJECT_LENGTH = 200
WORD_TOKEN = r"[A-Za-z0-9_/.\-]+"

# --- time in text ------------------------------------------------------------
ISO_TIME_V2 = r"\b\d{4}-\d{2}-\d{2}T[0-9:.\-]+Z?\b"
ISO_TIME_V3 = r"\b\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z)?\b"
DAY_NAME_TIME_V2 = (
    r"\b(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)\s+"
    r"(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\s+"
    r"\d{1,2}\s+\d{2}:\d{2}:\d{2}\s+GMT\s+\d{4}\b"
)
DAY_NAME_TIME_V3 = (
    r"\b(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)\s+[A-Za-z]{3}\s+"
    r"\d{1,2}\s+\d{2}:\d{2}:\d{2}\s+GMT\s+\d{4}\b"
)
FIRED_TIME = r"Fired\s+Date\s+Time:\s*(\d{4}-\d{2}-\d{2}T\S+)"  # i
MONTH_ABBREVIATIONS = (
    "jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec",
)
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
# (last hour of the part, label)
DAYPARTS = (
    (5, "Night(00-05)"),
    (11, "Morning(06-11)"),
    (17, "Afternoon(12-17)"),
    (23, "Evening(18-23)"),
)
SERIAL_DAYS = r"^\s*[+-]?\d+(?:\.\d*)?\s*\z"
SERIAL_DAY_ORIGIN = "1899-12-30 00:00:00"

# --- error families ----------------------------------------------------------
# Lexicon of the flexible matcher; order decides ties.
FAMILY_LEXICON = (
    "FMS-FTP-ERROR",
    "FMS-CONFIG-FILE",
    "FMS-ERR-FILE-REMOVE",
    "FMS-ERR-FILE-COPY",
    "FMS-DIR-CREATE",
    "PROCESS-ALERT",
    "MFTERRGEN",
    "CALLOUT-MFTERR02",
    "CALLOUT-MFTERR03",
    "CALLOUT-MFTERR04",
    "ERR-HTTPS-ERROR",
    "UNHANDLED EXCEPTION ERROR",
    "MISSING FILES",
    "FTP error",
    "Permission denied",
    "Not connected",
    "Auth fail",
    "java.io.IOException",
    "Address already in use",
    "Stuck files",
)
# Lexicon entries whose reported label is another family.
FAMILY_LEXICON_ALIASES = {"FTP error": "FMS-FTP-ERROR"}

# Alternations of the fixed matchers, in order. i
FAMILY_PATTERNS = {
    "v2": (
        r"FMS-FTP-ERROR", r"FTP\s*error",
        r"FMS-CONFIG-FILE",
        r"FMS-ERR-FILE-REMOVE",
        r"PROCESS-ALERT",
        r"MFTERRGEN",
        r"CALLOUT[_\-]?MFTERR0?3", r"CALLOUT[_\-]?MFTERR0?4",
        r"Permission denied", r"Not connected", r"Auth fail",
        r"java\.io\.IOException", r"Address already in use",
        r"Stuck files", r"WARNING",
    ),
    "v3": (
        r"FMS-FTP-ERROR", r"FTP\s*error",
        r"FMS-CONFIG-FILE",
        r"FMS-ERR-FILE-REMOVE", r"FMS-ERR-FILE-COPY",
        r"FMS-DIR-CREATE",
        r"PROCESS-ALERT", r"FTG(?:-ALERT)?",
        r"MFTERRGEN",
        r"CALLOUT[_-]?MFTERR0?2",
        r"CALLOUT[_-]?MFTERR0?3",
        r"CALLOUT[_-]?MFTERR0?4",
        r"ERR-HTTPS-ERROR",
        r"Missing Files", r"MISSING-FILES",
        r"Unhandled\s+Exception\s+Error",
    ),
    "v4": (
        r"FMS-FTP-ERROR", r"FTP\s*error",
        r"FMS-CONFIG-FILE",
        r"FMS-ERR-FILE-REMOVE",
        r"FMS-DIR-CREATE",
        r"MFTERRGEN",
        r"PROCESS-ALERT",
        r"CALLOUT[_-]?MFTERR0?2",
        r"CALLOUT[_-]?MFTERR0?3",
        r"CALLOUT[_-]?MFTERR0?4",
        r"CALLOUT-FTG", r"FTG-ALERT",
        r"MFTERRGEN", r"WARNING",
        r"Unhandled\s+Exception\s+Error",
        r"ERR-HTTPS-ERROR", r"ERR-FTP-COPY",
    ),
}
# Matched text (lower case, separators as single spaces) -> label.
FAMILY_LABELS_V2 = {
    "fms ftp error": "FMS-FTP-ERROR",
    "ftp error": "FMS-FTP-ERROR",
    "fms config file": "FMS-CONFIG-FILE",
    "fms err file remove": "FMS-ERR-FILE-REMOVE",
    "process alert": "PROCESS-ALERT",
    "mfterrgen": "MFTERRGEN",
    "callout mfterr03": "CALLOUT-MFTERR03",
    "callout mfterr04": "CALLOUT-MFTERR04",
    "permission denied": "Permission denied",
    "not connected": "Not connected",
    "auth fail": "Auth fail",
    "java.io.ioexception": "java.io.IOException",
    "address already in use": "Address already in use",
    "stuck files": "Stuck files",
    "warning": "WARNING",
}
FAMILY_LABELS_V3 = {
    "ftp error": "FMS-FTP-ERROR",
    "missing files": "MISSING-FILES",
}

# Hints of trouble that are not families, each a whole word or phrase. i
ANOMALY_HINTS = (
    r"time(?:out)?",
    r"connection\s+refused",
    r"connection\s+reset",
    r"no\s+such\s+file",
    r"permission",
    r"denied",
    r"auth(?:entication)?\s+fail(?:ure)?",
    r"ssl\s+error",
    r"h(?:ttps|ttp)",
    r"certificate",
    r"handshake",
    r"proxy",
    r"refused",
    r"reset",
    r"not\s+found",
)

# --- operation tags, in reported order. i ------------------------------------
OPERATION_TAGS = {
    "v3": (
        ("unsuccessful_put", r"Unsuccessful\s+PUT"),
        ("unsuccessful_get", r"Unsuccessful\s+GET"),
        ("permission_denied", r"Permission\s+denied"),
        ("not_connected", r"\bNot\s+connected\b"),
        ("couldnt_remote_list", r"Couldn'?t\s+get\s+remote\s+file\s+list"),
        ("cant_create", r"Can't\s+create\s+file|Cannot\s+create\s+a\s+file"),
        ("addr_in_use", r"Address\s+already\s+in\s+use"),
        ("connection_closed_foreignhost", r"connection\s+is\s+closed\s+by\s+foreignhost"),
        ("https_curl_error", r"ERR-HTTPS-ERROR|curl\s+error"),
    ),
    "v4": (
        ("unsuccessful_put", r"Unsuccessful\s+PUT"),
        ("unsuccessful_get", r"Unsuccessful\s+GET"),
        ("permission_denied", r"Permission\s+denied"),
        ("not_connected", r"\bNot\s+connected\b"),
        ("couldnt_remote_list", r"Couldn'?t\s+get\s+remote\s+file\s+list"),
        ("cannot_create_exists", r"Cannot\s+create\s+a\s+file\s+when\s+that\s+file\s+already\s+exists"),
        ("rnfr_failed", r"\bRNFR\s+command\s+failed\b"),
        ("addr_in_use", r"Address\s+already\s+in\s+use"),
        ("cannot_remove_file", r"Cannot\s+remove\s+file"),
        ("cannot_move", r"\bCannot\s+move\b"),
        ("dir_create_fail", r"\bCannot\s+create\s+[^.]+"),
        ("config_missing", r"Mandatory\s+item\s+missing\s+from\s+config\s+file"),
        ("config_empty", r"Config\s+exists,\s+but\s+contains\s+no\s+config\s+lines"),
    ),
}
# Tags that do not mean failure.
OPERATION_NEUTRAL_TAGS = {"v3": ("addr_in_use",), "v4": ()}

# --- status, caller, closure notes -------------------------------------------
STATUS_LABELS = {
    "accepted / in progress": "In Progress",
    "in progress": "In Progress",
    "accepted": "In Progress",
    "resolved": "Resolved",
    "closed": "Closed",
}
CLOSED_STATUSES = ("Resolved", "Closed")
# First rule whose text occurs in the lower-cased caller wins.
CALLER_RULES = (
    ("NetCool", ("netcool",)),
    ("INT_MFT API_PROD", ("int_mft api_prod", "int-mft api_prod", "int mft api_prod")),
    ("Atos Events", ("atos",)),
)
CALLER_OTHER = "Other"
CLOSURE_KEYWORDS = (
    "rca",
    "resolution|fix|reprocessed|triggered|housekeep|housekeeping",
    "confirmation|verified|hence closing|hence we are resolving",
)

# --- scenarios, in reported order --------------------------------------------
SCENARIOS = (
    "stuck-files",
    "ftp-errors",
    "config-file",
    "err-file-remove",
    "callout_mfterr03",
    "callout_mfterr04",
    "process-alert",
    "warnings",
    "misc",
)
# scenario -> (family label upper-cased, text pattern). i
SCENARIO_RULES = {
    "stuck-files": ("STUCK FILES", r"Number of stuck files"),
    "ftp-errors": ("FMS-FTP-ERROR", r"FTP\s*error|Unsuccessful\s+PUT|Unsuccessful\s+GET|Not connected"),
    "config-file": ("FMS-CONFIG-FILE", r"Config exists|contains no config lines"),
    "err-file-remove": ("FMS-ERR-FILE-REMOVE", r"Cannot remove file|Cannot move"),
    "callout_mfterr03": ("CALLOUT-MFTERR03", r"CALLOUT[_\-]?MFTERR0?3"),
    "callout_mfterr04": ("CALLOUT-MFTERR04", r"CALLOUT[_\-]?MFTERR0?4"),
    "process-alert": ("PROCESS-ALERT", r"PROCESS-ALERT"),
    "warnings": ("WARNING", r"WARNING:"),
}
UNKNOWN = "UNKNOWN"
OTHER = "other"
