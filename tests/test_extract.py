"""Extractors on hand-made texts; expected values written from the source rules."""

import pytest
from pyspark.sql import functions as F

from faultline.functions import extract as X
from faultline.functions import families, times
from faultline.functions import patterns as P
from faultline.functions.text import join_list, pool_text, prefer_text, strip_ws, title_case


def values(spark, build, texts):
    """Result of ``build(text column)`` for each text, in order."""
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string").repartition(3)
    return [r[0] for r in df.select(build(F.col("t")).alias("v"), "i").orderBy("i").select("v").collect()]


def check(spark, build, cases):
    got = values(spark, build, [t for t, _ in cases])
    assert list(zip([t for t, _ in cases], got)) == cases


def test_interfaces_keep_repeats_and_order(spark):
    check(
        spark,
        X.interface_ids,
        [
            ("U000034-693-E000064 then E000064B", ["U000034", "E000064", "E000064B"]),
            ("E12 E1234567 xE123456 e123456", []),
            ("E123 I123456Z U999", ["E123", "I123456Z", "U999"]),
            ("éE00012 E00012é", []),
            (None, []),
            ("", []),
        ],
    )


def test_primary_interface_prefers_e_then_i_then_u(spark):
    check(
        spark,
        lambda c: X.primary_interface(X.interface_ids(c)),
        [("U001 I002 E003 E004", "E003"), ("U001 I002 I003", "I002"), ("U005 U001", "U005"), ("none", None), (None, None)],
    )


def test_clean_chain(spark):
    check(
        spark,
        lambda c: X.chain_clean(c, X.interface_ids(c)),
        [
            ("E000001-693-U000064", "E000001-U000064"),
            ("E000001-E000002-tail U000003", "E000001-E000002"),
            ("E000001-693-U000064 failed", "E000001-U000064"),
            ("E000001 and U000064", "E000001-U000064"),
            ("E000001", None),
            (None, None),
        ],
    )


def test_raw_chain_is_longest_then_first(spark):
    check(
        spark,
        X.chain_raw,
        [
            ("x E001-693-U002 y", "E001-693-U002"),
            ("E001-U002 E0011-9-U0022 E0033-9-U0044", "E0011-9-U0022"),
            ("E001-693 a-b", None),
            (None, None),
        ],
    )


def test_triplet(spark):
    texts = ["E000341-788-U000064 x", "MULTIPLE-693-U000064", "INV-A1-INV", "E00034-1-U000064", None]
    parts = [values(spark, lambda c, n=n: X.triplet(c)[n], texts) for n in ("src_interface", "route_or_mid", "dst_interface")]
    assert list(zip(*parts)) == [
        ("E000341", "788", "U000064"), ("MULTIPLE", "693", "U000064"), ("INV", "A1", "INV"), ("", "", ""), ("", "", ""),
    ]


def test_triplet_label_needs_one_end(spark):
    df = spark.createDataFrame([("E1", "2", "U3"), ("", "2", ""), ("", "2", "U3")], "s string, m string, d string")
    got = [r[0] for r in df.select(X.triplet_label(F.col("s"), F.col("m"), F.col("d"))).collect()]
    assert got == ["E1-2-U3", "", "-2-U3"]


def test_error_codes_distinct_first_seen(spark):
    check(spark, X.error_codes, [("U02 U002 E003 U002 I0000001", ["U002", "E003"]), ("E000064B", []), (None, [])])


@pytest.mark.parametrize(
    "text, family",
    [
        ("FMS_FTP ERROR", "FMS-FTP-ERROR"),
        ("ftp - error", "FMS-FTP-ERROR"),
        ("CALLOUT MFTERR03", "CALLOUT-MFTERR03"),
        ("CALLOUT MFTERR 03", "other"),
        ("xxPROCESSALERTxx", "PROCESS-ALERT"),
        ("not connected, then FMS-FTP-ERROR", "Not connected"),
        ("unhandled exception error", "UNHANDLED EXCEPTION ERROR"),
        ("missing_files", "MISSING FILES"),
        ("java.io.IOException: x", "java.io.IOException"),
        ("FMS DIR CREATE", "FMS-DIR-CREATE"),
        ("callout-mfterr02", "CALLOUT-MFTERR02"),
        ("MFTERRGEN", "MFTERRGEN"),
        ("FMS-ERR-FILE\n\n-REMOVE", "FMS-ERR-FILE-REMOVE"),
        ("", "other"),
    ],
)
def test_lexicon_family(spark, text, family):
    assert values(spark, families.family_v1, [text]) == [family]


def test_lexicon_order_decides_at_one_place(spark):
    longer = lambda c: families.flex_family(c, ("AB CD", "AB"), "")
    shorter = lambda c: families.flex_family(c, ("AB", "AB CD"), "")
    assert values(spark, longer, ["x ab-cd", "ab x"]) == ["AB CD", "AB"]
    assert values(spark, shorter, ["x ab-cd", "ab x"]) == ["AB", "AB"]
    assert values(spark, lambda c: families.flex_family(c, (), None), ["x"]) == [None]
    assert values(spark, lambda c: families.flex_family(c, ("--", "A-B", "A B"), ""), ["a.b"]) == ["A-B"]


def test_fixed_families(spark):
    check(
        spark,
        lambda c: families.fixed_family(c, "v2"),
        [
            ("FTP  error now", "FMS-FTP-ERROR"),
            ("FTPerror", "FTPerror"),
            ("fms-config-file", "FMS-CONFIG-FILE"),
            ("FMS_CONFIG_FILE", "other"),
            ("callout_mfterr03", "CALLOUT-MFTERR03"),
            ("CALLOUT-MFTERR4", "CALLOUT-MFTERR4"),
            ("PERMISSION DENIED", "Permission denied"),
            ("warning: x", "WARNING"),
            ("forewarning", "other"),
            (None, "other"),
        ],
    )
    check(
        spark,
        lambda c: families.fixed_family(c, "v3"),
        [
            ("ftp error", "FMS-FTP-ERROR"),
            ("Missing Files", "MISSING-FILES"),
            ("missing-files", "MISSING-FILES"),
            ("Unhandled  Exception\tError", "UNHANDLED EXCEPTION ERROR"),
            ("ftg", "FTG"),
            ("FTG-ALERT", "FTG-ALERT"),
            ("CALLOUT_MFTERR03", "CALLOUT-MFTERR03"),
            ("warning", ""),
            (None, ""),
        ],
    )
    check(
        spark,
        lambda c: families.fixed_family(c, "v4"),
        [("WARNING", "WARNING"), ("err-ftp-copy", "ERR-FTP-COPY"), ("CALLOUT-FTG", "CALLOUT-FTG"), ("FMS-ERR-FILE-COPY", "")],
    )


def test_anomalies_leave_out_words_of_the_family(spark):
    check(
        spark,
        lambda c: families.unmatched_anomalies(c, families.family_v1(c)),
        [
            ("Proxy reset, SSL  error, proxy timeout", ["proxy", "reset", "ssl  error", "timeout"]),
            ("Permission denied by proxy", ["proxy"]),
            ("Auth failure", ["auth failure"]),
            ("connection refused", ["connection refused"]),
            ("timely", []),
        ],
    )


def test_rooted_paths(spark):
    texts = ["a /var/x,/etc/y; /opt/z) /usr/q /data", None]
    assert values(spark, lambda c: X.paths_rooted(c, "v1"), texts) == [["/var/x,/etc/y;", "/opt/z)", "/data"], []]
    assert values(spark, lambda c: X.paths_rooted(c, "v2"), texts) == [["/var/x", "/etc/y", "/opt/z", "/data"], []]


def test_normalize_path(spark):
    check(
        spark,
        X.normalize_path,
        [("  //a//b///c.; \t", "/a/b/c"), ("/x)):", "/x"), (".;:", ""), ("C:\\a\\b.", "C:\\a\\b"), ("\u00a0/x\u3000", "/x")],
    )


def test_split_paths(spark):
    check(spark, X.split_paths, [("/a//b.; ,,/c;\n/d\n", ["/a/b", "/c", "/d"]), ("", []), (None, [])])


def test_text_paths_list_unix_first_and_distinct(spark):
    text = r"E:\Data\In, /opt/a//b. //opt/a/b \\srv1\share\x;/22 C:\x"
    assert values(spark, X.text_paths, [text]) == [["/opt/a/b", "/22", r"E:\Data\In", r"C:\x", r"\\srv1\share\x"]]
    assert values(spark, lambda c: X.text_paths(c, unc=False), [text])[0][-1] == r"C:\x"


def test_fallback_words_only_without_paths(spark):
    v5 = lambda c: X.text_paths(c, allow_non_abs=True)
    v3 = lambda c: X.feature_paths(c, allow_non_abs=True)
    texts = [r"ab out\dir ab.", "ab /x"]
    assert values(spark, v5, texts) == [["ab", r"out\dir", "ab"], ["/x"]]
    assert values(spark, v3, [r"ab c:d out\dir out\dir", "ab /x"]) == [[r"out\dir"], ["/x"]]


def test_absolute_only(spark):
    build = lambda c: X.absolute_only(F.split(c, " "))
    check(spark, build, [(r"a /b C:\d \\s 1:\x", ["/b", r"C:\d", r"\\s"])])
    assert values(spark, lambda c: X.absolute_only(F.split(c, " "), unc=False), [r"/b \\s"]) == [["/b"]]


def test_file_patterns(spark):
    texts = [r"orders-in21_*.xml parcel_*.zip d\e_*.x parcel_*.zip", "none"]
    assert values(spark, lambda c: X.file_patterns(c, "v3"), texts) == [
        ["orders-in21_*.xml", "parcel_*.zip", "e_*.x"], [],
    ]
    assert values(spark, lambda c: X.file_patterns(c, "v4"), texts)[0][2] == r"d\e_*.x"


def test_stuck_metrics(spark):
    texts = ["from 15 min : - 4", "xfrom 7min :-0", "FROM 3 MIN :- 99999999999999999999", "from 5 minutes", None]
    assert values(spark, lambda c: X.stuck_count(c, "v2"), texts) == [4, 0, None, None, None]
    assert values(spark, lambda c: X.stuck_minutes(c, "v1"), texts) == [15, None, 3, None, None]
    assert values(spark, lambda c: X.stuck_minutes(c, "v2"), texts) == [15, 7, 3, None, None]
    assert values(spark, lambda c: X.stuck_minutes(c, "v3"), texts) == [15, None, 3, None, None]
    assert values(spark, lambda c: X.stuck_count(c, "v3"), texts) == [None, 0, None, None, None]


def test_ftp_fields(spark):
    texts = ["unsuccessful  put 550", "Unsuccessful GET 5501", "PUT", None]
    assert values(spark, X.ftp_command, texts) == ["PUT", "GET", None, None]
    assert values(spark, X.ftp_code_550, texts) == ["550", None, None, None]
    texts = ["x 550 The system cannot find: . y", "426", "route-500-x 404 no", "399 600", None]
    assert values(spark, X.ftp_code, texts) == ["550", "426", "500", "", ""]
    assert values(spark, X.ftp_message, texts) == ["The system cannot find", "", "", "", ""]


def test_operations(spark):
    texts = [
        "Unsuccessful PUT Permission denied", "Address already in use put", "Couldnt get remote file list, get it",
        "RNFR command failed. Cannot create a dir", "Cannot move; Mandatory item missing from config file", "quiet", None,
    ]
    tags = {p: values(spark, lambda c: join_list(X.operation_tags(c, p)), texts) for p in ("v3", "v4")}
    assert tags["v3"] == [
        "unsuccessful_put; permission_denied", "addr_in_use", "couldnt_remote_list", "", "", "", "",
    ]
    assert tags["v4"][3:5] == ["rnfr_failed; dir_create_fail", "cannot_move; config_missing"]
    ops = lambda c: X.operation(c, X.operation_tags(c, "v3"))
    assert values(spark, ops, texts) == ["PUT", "PUT", "GET", "", "", "", ""]
    done = {p: values(spark, lambda c: X.operation_success(X.operation_tags(c, p), p), texts) for p in ("v3", "v4")}
    assert done["v3"] == ["NO", "", "NO", "", "", "", ""]
    assert done["v4"] == ["NO", "NO", "NO", "NO", "NO", "", ""]


def test_hosts(spark):
    text = "ABCAPP0002 n1.Example.net abcapp0002 x_app123 app99 n1.example.org"
    assert values(spark, lambda c: X.app_hosts(c, "example.net"), [text]) == [["abcapp0002", "x_app123", "n1.example.net"]]
    assert values(spark, X.app_hosts, [text]) == [["abcapp0002", "abcapp0002", "x_app123"]]
    assert values(spark, lambda c: X.host_tag(c, "abc"), ["on abcxyzapp0001x abcxyzapp0002", "ABCxapp1"]) == ["abcxyzapp0002", None]


def test_small_extractors(spark):
    check(spark, X.script_name, [("run_it.sh a-b.sh", "run_it.sh"), ("x.shell", None)])
    check(spark, X.fms_class, [("Class:  FMS_IO_ERROR2", "FMS_IO_ERROR"), ("class: FMS_X", ""), (None, "")])
    check(spark, X.basename, [("/a/b/", "b"), ("/a/b.txt", "b.txt"), ("x", "x"), ("/", "")])
    subject = lambda c: X.warning_subject(c, families.fixed_family(c, "v2"))
    check(
        spark,
        subject,
        [("WARNING:  disk\nmore", "disk"), ("FTP error WARNING: x", None), ("WARNING: " + "y" * 300, "y" * 200), ("warning: low", None)],
    )
    check(
        spark,
        X.caller_class,
        [("Atos NetCool", "NetCool"), ("INT-MFT API_PROD", "INT_MFT API_PROD"), ("atos", "Atos Events"), ("x", "Other"), (None, "Other")],
    )


def test_status(spark):
    check(
        spark,
        X.canonical_status,
        [
            (" Accepted / In Progress ", "In Progress"), ("CLOSED", "Closed"), ("on-hold", "On-Hold"),
            ("awaiting user info", "Awaiting User Info"), ("don't", "Don'T"), ("a1b", "A1B"), (None, None), ("", ""),
        ],
    )
    check(spark, title_case, [("éTé x", "Été X")])


def test_closure_notes(spark):
    texts = ["RCA fixed, verified", "Intermittent; hence closing", "housekeep", None]
    assert values(spark, X.closure_quality, texts) == [3, 1, 1, 0]
    assert values(spark, X.is_intermittent, texts) == [False, True, False, False]


def test_text_choice(spark):
    df = spark.createDataFrame([(" ", "b"), ("a ", None), (None, "b"), (None, None), ("a", " b")], "x string, y string")
    got = [tuple(r) for r in df.select(pool_text(F.col("x"), F.col("y")), prefer_text(F.col("x"), F.col("y"))).collect()]
    assert got == [("b", "b"), ("a ", "a "), ("b", "b"), ("", None), ("a  b", "a")]
    assert values(spark, strip_ws, ["\t x\u00a0\n", None]) == ["x", None]


def test_parse_opened(spark):
    check(
        spark,
        lambda c: times.parse_opened(c).cast("string"),
        [
            ("45000.5", "2023-03-15 12:00:00"),
            (" 45001 ", "2023-03-16 00:00:00"),
            ("-1", "1899-12-29 00:00:00"),
            ("2024-02-29 23:59:59", "2024-02-29 23:59:59"),
            ("2024-02-30", None),
            ("99999999999", None),
            ("NaN", None),
            ("Infinity", None),
            ("soon", None),
            (None, None),
        ],
    )


def test_time_grains(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (timestamp_ntz'2024-01-01 05:59:59'), (timestamp_ntz'2023-12-31 23:00:00'), (NULL) AS t(opened_dt)"
    )
    got = [tuple(r)[1:] for r in times.add_time_grains(df).collect()]
    assert got == [
        ("2024-01", "2024-01-01/2024-01-07", "Monday", 5, P.DAYPARTS[0][1]),
        ("2023-12", "2023-12-25/2023-12-31", "Sunday", 23, P.DAYPARTS[3][1]),
        (None, None, None, None, None),
    ]


def test_results_do_not_depend_on_the_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist there on that day
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00' AS opened_dt")
        row = times.add_time_grains(df).withColumn("text", F.col("opened_dt").cast("string")).first()
        assert (row.hour, row.dow, row.text) == (2, "Sunday", "2024-03-10 02:30:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _staged(spark, profile, build, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string").withColumns(times.raw_times(F.col("t"), profile))
    return [tuple(r) for r in df.select("i", *build()).orderBy("i").drop("i").collect()]


def test_fired_time(spark):
    texts = [
        "at 2025-12-22T17:03Z Mon Dec 22 19:22:11 GMT 2025",
        "at 2025-13-22T17:03 Mon Dec  2 19:22:11 GMT 2025",
        "Tue Feb 30 19:22:11 GMT 2025",
        None,
    ]
    build = lambda: [c.alias(n) for n, c in times.fired_time(F.col("_iso"), F.col("_named")).items()]
    assert _staged(spark, "v2", build, texts) == [
        ("2025-12-22T17:03Z", None),
        ("2025-12-02T19:22:11", "Mon Dec  2 19:22:11 GMT 2025"),
        (None, "Tue Feb 30 19:22:11 GMT 2025"),
        (None, None),
    ]


def test_extracted_timestamp(spark):
    texts = [
        "Fired Date Time: 2025-12-22T17:03:00.5Z, x",
        "x 2025-12-22T17:03:00.120Z",
        "x 2025-12-22T17:03",
        "Mon Dec 22 19:22:11 GMT 2025",
        "Mon Xyz 22 19:22:11 GMT 2025",
        None,
    ]
    iso, named = (lambda: F.col("_iso")), (lambda: F.col("_named"))
    v3 = _staged(spark, "v3", lambda: [times.extracted_timestamp(iso(), named(), F.col("_fired")).alias("v")], texts)
    assert [r[0] for r in v3] == [
        "2025-12-22T17:03:00.5Z,", "2025-12-22T17:03:00.120000+00:00", "2025-12-22T17:03:00+00:00",
        "2025-12-22T19:22:11Z", "", "",
    ]
    v4 = _staged(spark, "v4", lambda: [times.extracted_timestamp(iso(), named()).alias("v")], texts)
    assert v4[0][0] == "2025-12-22T17:03:00.500000+00:00"
