import gzip
import hashlib

import pytest

from checks.compare import check, duck
from skyledger.llm import queries
from skyledger.llm import warc
from tests.conftest import SF


def test_equals_sql(spark):
    assert check(warc.op4_warc(spark, SF), duck(SF), queries.SQL["op4_warc"]) is None


def test_round_trip_of_payloads_and_revisits(spark, tmp_path):
    long = "é" * 600
    rows = [
        (1, "http://a/", long), (2, "http://b/\r\nX: y", long), (3, None, long), (4, "http://c", "short"),
        (5, "http://d", "short"), (6, "http://e", None), (7, "http://f", ""), (None, "http://g", long),
        (3, None, long), (8, "http://h", "WARC/1.1\r\n\r\n" + "z" * 3_000_000),
    ]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, sha1 string")
    folder = f"file://{tmp_path}/w"
    files = warc.write(pages, folder)
    assert files.groupBy().sum("records").first()[0] == len(rows)
    got = warc.read(spark, folder).collect()
    assert len(got) == len(rows) and all(r.verified for r in got)
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
    assert [r.record_type for r in by[3]] == ["response", "response"]
    for i in (1, 2, None):
        (r,) = by[i]
        assert (r.record_type, r.refers_to, r.payload, r.payload_bytes) == ("revisit", 3, None, 1200)
        assert r.payload_digest == hashlib.sha1(long.encode()).hexdigest()
    assert {by[i][0].record_type for i in (4, 5, 6, 7, 8)} == {"response"}
    assert bytes(by[8][0].payload).decode() == rows[-1][2] and by[6][0].payload_bytes == 0
    assert by[3][0].url is None and by[2][0].url == "http://b/%0D%0AX: y"


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/none"
    assert warc.write(pages, folder).count() == 0
    assert warc.read(spark, folder).count() == 0


@pytest.mark.parametrize("harm", ["cut", "byte", "framing"])
def test_damage_is_seen(harm):
    sound = [warc.record(i, "http://a/", b"x" * 500, hashlib.sha1(b"x" * 500).digest(), None, False, warc.DATE) for i in (1, 2)]
    data = b"".join(warc.member(r, 6) for r in sound)
    assert [warc.parsed(*m)["verified"] for m in warc.members(data)] == [True, True]
    if harm == "cut":
        data = data[:-9]
    elif harm == "byte":
        data = warc.member(sound[0], 6) + warc.member(sound[1].replace(b"xxxx", b"xxyx", 1), 6)
    else:
        data = warc.member(sound[0], 6) + gzip.compress(sound[1][:-4])
    assert [warc.parsed(*m)["verified"] for m in warc.members(data)] == [True, False]


def test_archives_are_read_forward_in_pieces():
    class Pipe:
        """An archive of thousands of records that has no length and can't go back."""

        def __init__(self, data, times):
            self.data, self.left, self.held, self.largest = data, times, b"", 0

        def read(self, n):
            self.largest = max(self.largest, n)
            while len(self.held) < n and self.left:
                self.held, self.left = self.held + self.data, self.left - 1
            out, self.held = self.held[:n], self.held[n:]
            return out

    body = bytes(range(256)) * 400
    one = warc.member(warc.record(7, "http://a/", body, hashlib.sha1(body).digest(), None, False, warc.DATE), 0)
    pipe, n = Pipe(one, 3000), 0
    for data, complete in warc.members(pipe):
        n += complete and warc.parsed(data, complete)["verified"]
    assert n == 3000 and 3000 * len(one) > 300_000_000 and pipe.largest == warc.CHUNK
