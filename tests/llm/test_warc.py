import gzip
import hashlib
import io

import pytest

from simtrail.llm import warc
from simtrail.llm.queries import op1_warc


def expected(rows):
    payload = {i: (h or "").encode() for i, h in rows}
    first = {}
    for i, p in payload.items():
        if len(p) >= 100:
            first[p] = min(i, first.get(p, i))
    out = set()
    for i, p in payload.items():
        kept = first.get(p, i)
        out.add((i, len(p), hashlib.sha256(p).hexdigest(), "response" if kept == i else "revisit", None if kept == i else kept))
    return out


def test_query(spark, sf):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = op1_warc(spark, sf).collect()
    assert len(got) == len(rows) and {tuple(r) for r in got} == expected(rows)


@pytest.mark.parametrize("split", [37, 1000, 1 << 20])
def test_ranges_of_any_size_give_every_record_once(spark, split):
    same = "<p>copy " + "x" * 200
    rows = [(i, f"https://e.org/{i} ä\r\n", "é" * (i * 37)) for i in range(40)]
    rows += [(100 + i, None, same) for i in range(30)] + [(200, "u", None), (201, "u", ""), (202, "u", "short"), (203, "u", "short")]
    rows += [(300, "u", "WARC/1.0 \x1f\x8b\x08 " * 300)]
    df = spark.createDataFrame([(i, u, h, "c") for i, u, h in rows], "page_id long, url string, html string, bytes string").coalesce(2)
    archives = warc.write_archives(df)
    got = warc.read_archives(archives, split).collect()
    assert sorted(r.record_id for r in got) == sorted(f"{warc.PREFIX}{i}" for i, *_ in rows)
    by_id = {r.record_id: r for r in got}
    for i, _, h in rows:
        r = by_id[f"{warc.PREFIX}{i}"]
        if r.record_type == "response":
            assert bytes(r.payload).decode() == (h or "")
    assert [r.record_type for r in got].count("revisit") == 29
    assert archives.count() <= 2 or archives.selectExpr("sum(records)").first()[0] == len(rows)


def test_foreign_bytes_are_skipped():
    one = warc.record_bytes("a", "response", "u", b"x" * 50, 50, "d", None)
    two = warc.record_bytes("b", "response", None, b"y" * 5000, 5000, "d", None)
    data = b"junk" + gzip.compress(b"no archive") + one + warc.MAGIC + b"broken" + two + two[: len(two) // 2]
    source = io.BytesIO(data)

    def read(at, n):
        source.seek(at)
        return source.read(n)

    got = list(warc.records_from(read, len(data), 0, len(data)))
    assert [(h["warc-record-id"], len(b)) for _, h, b in got] == [("<a>", 50), ("<b>", 5000)]
    halves = [r[0] for cut in (7, 60, 400) for s, e in ((0, cut), (cut, len(data))) for r in warc.records_from(read, len(data), s, e)]
    assert halves == [r[0] for r in got] * 3


def test_null_and_repeated_ids_and_no_rows(spark):
    text = "t" * 150
    rows = [(None, "u", text), (4, "u", text), (3, "u", text), (3, "u", text)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((str(r.record_id), r.record_type) for r in warc.read_archives(warc.write_archives(df)).collect())
    assert got == [("urn:record:3", "response")] * 2 + [("urn:record:4", "revisit"), ("urn:record:null", "response")]
    assert warc.read_archives(warc.write_archives(df.limit(0))).count() == 0
