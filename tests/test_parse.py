from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from logloom.operators import parse
from logloom.sinks.letters import letter_documents

AS_OF = "2025-01-01 12:00:00"
NOW = datetime(2025, 1, 1, 12)
HEAD = '192.168.1.100 - - [27/Sep/2025:10:30:00 +0000] "GET /test HTTP/1.1"'


def parsed(spark, *lines):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "n int, value string")
    return [r.asDict(recursive=True) for r in
            parse.parse_access_lines(df, AS_OF, keep=["n"]).orderBy("n").collect()]


def test_common_line(spark):
    row, = parsed(spark, HEAD + " 200 1234")
    assert row["log_format"] == "apache"
    assert (row["ip_address"], row["http_method"], row["request_path"]) == ("192.168.1.100", "GET", "/test")
    assert (row["status_code"], row["response_size"]) == (200, 1234)
    assert row["timestamp"] == datetime(2025, 9, 27, 10, 30)
    assert row["user_agent"] is None and row["referer"] is None and row["response_time"] is None
    assert row["metadata"]["parser_version"] == "1.0" and row["metadata"]["parsed_at"] == NOW
    assert row["metadata"]["has_user_agent"] is None


def test_combined_line_wins_over_common(spark):
    row, = parsed(spark, HEAD + ' 201 567 "-" "curl/7.68.0" rt=0.123')
    assert (row["log_format"], row["user_agent"], row["referer"], row["response_time"]) == (
        "nginx", "curl/7.68.0", "-", 0.123)
    assert row["metadata"]["has_user_agent"] is True and row["metadata"]["has_referer"] is False


def test_combined_without_response_time_and_empty_agent(spark):
    plain, empty = parsed(spark, HEAD + ' 200 5 "http://a/" "x"', HEAD + ' 200 5 "" ""')
    assert plain["log_format"] == "nginx" and plain["response_time"] is None
    assert empty["log_format"] == "nginx" and empty["user_agent"] == "" and empty["referer"] == ""
    assert empty["metadata"]["has_user_agent"] is True


def test_offset_is_dropped_not_applied(spark):
    east, west = parsed(
        spark, HEAD.replace("+0000", "+0530") + " 200 1", HEAD.replace("+0000", "-0930") + " 200 1")
    assert east["timestamp"] == west["timestamp"] == datetime(2025, 9, 27, 10, 30)
    assert not east["timestamp_defaulted"]


@pytest.mark.parametrize("time", ["31/Feb/2025:10:30:00 +0000", "yesterday", "27/Sep/2025:10:30:00",
                                  "27/Sep/2025:25:30:00 +0000"])
def test_bad_time_becomes_now(spark, time):
    row, = parsed(spark, HEAD.replace("27/Sep/2025:10:30:00 +0000", time) + " 200 1")
    assert row["timestamp"] == NOW and row["timestamp_defaulted"] and row["log_format"] == "apache"


def test_time_does_not_depend_on_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row, = parsed(spark, HEAD.replace("27/Sep/2025:10:30", "09/Mar/2025:02:30") + " 200 1")
        assert row["timestamp"] == datetime(2025, 3, 9, 2, 30)  # a wall-clock time that New York skips
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_numbers_that_do_not_fit(spark):
    status, size, rt = parsed(
        spark, HEAD + " 99999999999 1", HEAD + " 200 99999999999999999999", HEAD + ' 200 1 "-" "-" rt=1.2.3')
    for row, text in ((status, "99999999999"), (size, "99999999999999999999"), (rt, "1.2.3")):
        assert row["log_format"] == "failed"
        assert row["metadata"]["parse_failure_reason"] == f'Parse error: For input string: "{text}"'
        assert row["ip_address"] is None and row["status_code"] is None and row["timestamp"] == NOW


def test_missing_size(spark):
    row, = parsed(spark, HEAD + " 304 -")
    assert row["response_size"] is None and row["log_format"] == "apache"


def test_unknown_lines_fail(spark):
    for row in parsed(spark, "", "   ", "hello", HEAD, HEAD + " abc 1", HEAD + " 200 1\n", None):
        assert row["log_format"] == "failed"
        assert row["metadata"]["parse_failure_reason"] == "Unknown format"
        assert row["metadata"]["failed_at"] == NOW and row["metadata"]["parsed_at"] is None


def test_line_with_the_internal_separator(spark):
    good, bad = parsed(spark, HEAD.replace("/test", "/a\x01b") + " 200 7", "x\x01y")
    assert good["request_path"] == "/a\x01b" and good["response_size"] == 7 and good["log_format"] == "apache"
    assert bad["log_format"] == "failed" and bad["raw_log"] == "x\x01y"


def test_dead_letters_escape(spark):
    df = spark.createDataFrame([('say "hi" \\ there',)], "value string")
    dead = parse.dead_letters(parse.parse_access_lines(df, AS_OF))
    value, = [r["value"] for r in letter_documents(dead).collect()]
    assert value == ('{"raw_log":"say \\"hi\\" \\\\ there","failure_reason":"Unknown format",'
                     '"timestamp":"2025-01-01T12:00:00"}')


WORD = st.text(st.sampled_from("abcXYZ019/._-"), min_size=1, max_size=12)
TEXT = st.text(st.sampled_from("abc XYZ/();.,=-"), max_size=20)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    WORD, WORD, WORD, st.integers(0, 2 ** 31 - 1), st.one_of(st.none(), st.integers(0, 2 ** 63 - 1)),
    st.one_of(st.none(), st.tuples(TEXT, TEXT, st.one_of(st.none(), st.integers(0, 99999))))), min_size=1, max_size=20))
def test_round_trip(spark, records):
    lines = []
    for ip, method, path, status, size, tail in records:
        line = f'{ip} - - [01/Feb/2024:03:04:05 +0000] "{method} {path} HTTP/1.1" {status} {"-" if size is None else size}'
        if tail:
            line += f' "{tail[0]}" "{tail[1]}"' + ("" if tail[2] is None else f" rt={tail[2] / 1000}")
        lines.append(line)
    for row, (ip, method, path, status, size, tail) in zip(parsed(spark, *lines), records, strict=True):
        assert (row["ip_address"], row["http_method"], row["request_path"]) == (ip, method, path)
        assert (row["status_code"], row["response_size"]) == (status, size)
        assert row["timestamp"] == datetime(2024, 2, 1, 3, 4, 5)
        if tail:
            rt = None if tail[2] is None else tail[2] / 1000
            assert (row["log_format"], row["referer"], row["user_agent"], row["response_time"]) == (
                "nginx", tail[0], tail[1], rt)
        else:
            assert (row["log_format"], row["referer"]) == ("apache", None)


def test_app_lines(spark):
    line = "[2025-09-27 10:30:00.123] WARN [user-service] [req:1234567] [user:4321] Operation 'create_user' completed in 77ms"
    df = spark.createDataFrame([(line,), ("nonsense",), (line + " ",)], "value string")
    good, bad, tail = parse.parse_app_lines(df).collect()
    assert good["timestamp"] == datetime(2025, 9, 27, 10, 30, 0, 123000)
    assert (good["level"], good["service_name"], good["operation"]) == ("WARN", "user-service", "create_user")
    assert (good["request_id"], good["user_id"], good["response_time_ms"]) == (1234567, 4321, 77)
    for row in (bad, tail):
        assert not row["parsed"] and row["level"] is None and row["response_time_ms"] is None


def test_regex_runs_once_below_later_filters(spark):
    df = spark.createDataFrame([("x",)], "value string")
    plan = parse.parsed_only(parse.parse_access_lines(df, AS_OF)).filter("status_code = 200")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("regexp_replace") == 1
