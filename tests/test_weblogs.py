from __future__ import annotations

import os
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import conform
from strata.sources import files, tables
from strata.streaming import weblogs

NOW = datetime(2001, 12, 1)

LINES = [
    '10.0.0.1 - cust7 [01/Oct/2024:10:11:12 +0000] "GET / HTTP/1.1" 200 123 "-" "Mozilla/5.0 (iPad)"',
    '10.0.0.2 - - [1/Oct/2024:1:2:3 -0530] "GET /a b HTTP/1.1" 404 - "http://x" "-"',
    '10.0.0.3 ident guest [31/Dec/2023:23:59:59 +02:00] "POST /" 500 9 "r" ""',
    '10.0.0.4 - cust1 [31/Feb/2024:10:00:00 +0000] "GET /" 200 1 "-" "a \\"quoted\\" agent"',
    '10.0.0.5 - cust1 [bad time] "GET /" 200 1 "-" "x"',
    '10.0.0.6   -\tcust2  [05/jan/2024:00:00:00 Z]   "G"  200  5  "-"  "tabs and blanks"',
    '10.0.0.7 - cust1 [05/Jan/2024:00:00:00] "GET /" 200 1 "-" "no offset"',
    '10.0.0.8 - cüst x [05/Jan/2024:00:00:00 +0000] "GET /" 200 1 "-" "no-break space"',
    '10.0.0.9 - müller [05/Jan/2024:00:00:00 +0000] "GET /" 200 1 "-" "次   \u0085 agent"',
    '10.0.0.10 - a [05/Jan/2024:00:00:00 +0000] "GET /" 20 1 "-" "two-digit status"',
    '10.0.0.11 - a [05/Jan/2024:00:00:00 +0000] "GET /" 200 1 "-" "trailing" ',
    ' 10.0.0.12 - a [05/Jan/2024:00:00:00 +0000] "GET /" 200 1 "-" "leading blank"',
    '10.0.0.13 - a [] "GET /" 200 1 "-" "no time"',
    '10.0.0.14 - a [05/Jan/2024:00:00:00 +0000] "" 200 1 "" ""',
    "$1 \\1 garbage",
    "",
]

def quoted(text):
    """What stands between the first quote and the next quote that a blank or the end follows; and what comes after it."""
    if not text.startswith('"'):
        return None, text
    ends = [k for k in range(1, len(text)) if text[k] == '"' and (k + 1 == len(text) or text[k + 1].isspace())]
    return (text[1 : ends[0]], text[ends[0] + 1 :]) if ends else (None, text)


def by_hand(line):
    """Field by field from the left: three words, a time in brackets, a quoted request, a status, a size, two quoted texts."""
    nothing = (None, None, None, None)
    words, rest = [], line
    for _ in range(3):
        k = next((k for k, c in enumerate(rest) if c.isspace()), 0)
        if not k:
            return nothing
        words.append(rest[:k])
        rest = rest[k:].lstrip()
    if not rest.startswith("[") or "]" not in rest:
        return nothing
    time, rest = rest[1:].split("]", 1)
    _, rest = quoted(rest.lstrip())
    status, size, rest = [*rest.split(maxsplit=2), "", ""][:3]
    if not (len(status) == 3 and status.isdigit() and size):
        return nothing
    referrer, rest = quoted(rest)
    agent = rest.lstrip()
    if referrer is None or not (len(agent) > 1 and agent[0] == agent[-1] == '"'):
        return nothing
    ip, _, user = words
    try:
        when = datetime.strptime(time, "%d/%b/%Y:%H:%M:%S %z").astimezone(UTC).replace(tzinfo=None)
    except ValueError:
        when = None
    return ip, None if user == "-" else user, when, None if agent[1:-1] == "-" else agent[1:-1]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parsing_equals_reading_by_hand(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    parsed = files.parse_weblogs(spark.createDataFrame([(x,) for x in LINES], "raw_line string"))
    got = {r.raw_line: (r.client_ip, r.username, r.request_time, r.user_agent) for r in parsed.collect()}
    assert got == {line: by_hand(line) for line in LINES}


def lines_of(spark, target):
    rows = tables.read_table(spark, target, schemas.WEBLOG_ROWS).collect()
    return sorted((r.source_file.rsplit("/", 1)[1], r.source_line_number, r.raw_line) for r in rows)


def test_stream_loads_each_line_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("\r\n".join(LINES[:5]) + "\r\n")
    weblogs.stream_weblogs(spark, source, target, checkpoint, NOW)
    first = [("a.log", n, x) for n, x in enumerate(LINES[:5], 1)]
    assert lines_of(spark, target) == first

    (tmp_path / "in" / "b.log").write_text("\n".join(LINES[5:9]) + "\n")
    for _ in range(2):
        weblogs.stream_weblogs(spark, source, target, checkpoint, NOW)
    both = sorted(first + [("b.log", n, x) for n, x in enumerate(LINES[5:9], 1)])
    assert lines_of(spark, target) == both

    # A stream that lost its checkpoint reads everything again, here file by file: nothing is added twice.
    weblogs.stream_weblogs(spark, source, target, str(tmp_path / "check2"), NOW, batch_bytes=1)
    assert lines_of(spark, target) == both


def test_grown_file_adds_its_new_lines_only(spark, tmp_path):
    log, target = tmp_path / "a.log", str(tmp_path / "out")
    log.write_text("one\ntwo\n")
    assert weblogs.load_lines(spark, files.read_lines(spark, str(log)), target, NOW) == {"inserted": 2, "skipped": 0}
    log.write_text("one\nTWO changed\nthree\n")
    assert weblogs.load_lines(spark, files.read_lines(spark, str(log)), target, NOW) == {"inserted": 1, "skipped": 2}
    assert [x[2] for x in lines_of(spark, target)] == ["one", "two", "three"]


def test_stream_takes_old_and_grown_files(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    (tmp_path / "in").mkdir()
    log = tmp_path / "in" / "a.log"
    log.write_text("one\ntwo\n")
    weblogs.stream_weblogs(spark, source, target, checkpoint, NOW)
    old = tmp_path / "in" / "b.log"
    old.write_text("x\ny\nz\n")
    os.utime(old, (1_000_000_000, 1_000_000_000))
    with log.open("a") as more:
        more.write("three\n")
    weblogs.stream_weblogs(spark, source, target, checkpoint, NOW)
    expected = [("a.log", 1, "one"), ("a.log", 2, "two"), ("a.log", 3, "three"), ("b.log", 1, "x"), ("b.log", 2, "y"), ("b.log", 3, "z")]
    assert lines_of(spark, target) == sorted(expected)
    assert weblogs.changed_files(spark, source, target) == []
    ids = [r.log_id for r in tables.read_table(spark, target, schemas.WEBLOG_ROWS).collect()]
    assert sorted(ids) == list(range(1, 7))


def test_leads_go_by_their_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("lead_id,full_name,email,company_name,lead_score,acquired_at\nL1,Ann,a@b.c,Co,5,2001-01-01 00:00:00\n")
    (tmp_path / "b.csv").write_text("EMAIL,lead_id,note,full_name,company_name,lead_score,acquired_at\nx@y.z,L2,n,Bob,Inc,6,2001-01-02 00:00:00\n")
    got = sorted(tuple(r) for r in files.read_leads(spark, str(tmp_path)).select("lead_id", "full_name", "email").collect())
    assert got == [("L1", "Ann", "a@b.c"), ("L2", "Bob", "x@y.z")]
    numbered = conform.add_lineage(files.read_leads(spark, str(tmp_path), located=True), NOW).collect()
    assert [r.source_line_number for r in numbered] == [1, 1] and len({r.row_hash for r in numbered}) == 2
    (tmp_path / "c.csv").write_text("lead_id,full_name\nL3,Eve\n")
    with pytest.raises(ValueError, match="email"):
        files.read_leads(spark, str(tmp_path))


def test_parsed_fields_need_one_pass_of_the_pattern(spark):
    parsed = files.parse_weblogs(spark.createDataFrame([("x",)], "raw_line string").filter(F.col("raw_line") != ""))
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan


def test_a_batch_that_comes_again_is_known_by_its_number(spark, tmp_path, monkeypatch):
    """A crash after the rows were committed and before the stream was."""
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("one\ntwo\n")
    with monkeypatch.context() as m:
        m.setattr(weblogs, "_remember", lambda *_: (_ for _ in ()).throw(OSError("crashed")))
        with pytest.raises(Exception, match="crashed"):
            weblogs.stream_weblogs(spark, source, target, checkpoint, NOW)
    assert [x[2] for x in lines_of(spark, target)] == ["one", "two"]
    version = tables._current(spark, target)[0]
    with monkeypatch.context() as m:
        m.setattr(weblogs, "insert_absent_actions", lambda *_: (_ for _ in ()).throw(AssertionError("the history was read")))
        weblogs.stream_weblogs(spark, source, target, checkpoint, NOW)
    assert tables._current(spark, target)[0] == version and weblogs.changed_files(spark, source, target) == []
    # batches of another checkpoint have the same numbers and are not taken for it
    (tmp_path / "in" / "b.log").write_text("three\n")
    weblogs.stream_weblogs(spark, source, target, str(tmp_path / "check2"), NOW)
    assert [x[2] for x in lines_of(spark, target)] == ["one", "two", "three"]
    # a batch without anything new is committed too
    origin = tables.Origin("s", 5)
    lines = files.read_lines(spark, source)
    assert weblogs.load_lines(spark, lines, target, NOW, origin) == {"inserted": 0, "skipped": 3}
    assert tables.taken_in(spark, target, origin) and not tables.taken_in(spark, target, tables.Origin("s", 6))
    assert weblogs.load_lines(spark, lines, target, NOW, origin) == {"inserted": 0, "skipped": 0}
    assert len(lines_of(spark, target)) == 3
