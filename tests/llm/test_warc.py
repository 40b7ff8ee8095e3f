import base64
import gzip
import io
import random
import zlib
from hashlib import sha1, sha256

import pytest

from tidemark.llm.queries import archived
from tidemark.llm.warc import Gap, Record, archive_pages, read_archives, record_bytes, salvage, with_revisits, write_archives

SCHEMA = "page_id long, url string, html string, type string, first string"


def page(i, compress, size=None):
    pick = random.Random(i)
    payload = bytes(pick.choices(range(256), k=pick.randint(0, 5000) if size is None else size))
    return record_bytes(i, f"http://h/{i}", payload, sha256(payload).hexdigest(), None, compress), payload


@pytest.fixture(params=[True, False], ids=["gz", "plain"])
def archive(request):
    records = [page(i, request.param)[0] for i in range(40)]
    records[7] = record_bytes(7, None, b"x" * 200, sha256(b"x" * 200).hexdigest(), 3, request.param)
    return records


def read(data):
    found = list(salvage(io.BytesIO(data)))
    return [r for r in found if isinstance(r, Record)], [g for g in found if isinstance(g, Gap)]


def test_whole(archive):
    data = b"".join(archive)
    records, gaps = read(data)
    assert not gaps and [r.id for r in records] == [str(i) for i in range(40)]
    assert sum(r.length for r in records) == len(data)
    assert records[7].type == "revisit" and records[7].refers_to == "3" and records[7].payload_bytes == 200
    assert read(b"") == ([], [])


def test_damage(archive):
    """Whatever happens to some records, the others are all read and the bytes of the damaged are logged."""
    pick = random.Random(11)
    starts = [sum(map(len, archive[:i])) for i in range(41)]
    for turn in range(60):
        data, hurt = bytearray(b"".join(archive)), set(pick.sample(range(40), 3))
        for i in hurt:
            at = pick.randrange(starts[i], starts[i + 1])
            kind = turn % 3
            if kind == 0:
                data[at] ^= 1 << pick.randrange(8)
            elif kind == 1:
                stop = pick.randrange(at, starts[i + 1]) + 1
                data[at:stop] = bytes(stop - at)
            else:
                data[starts[i] : starts[i] + 2] = b"??"
        records, gaps = read(bytes(data))
        assert {r.id for r in records} >= {str(i) for i in range(40)} - {str(i) for i in hurt}
        for r in records:
            if int(r.id) != 7:
                payload = page(int(r.id), True)[1]
                assert (r.payload_bytes, r.payload_digest) == (len(payload), sha256(payload).hexdigest())
        spans = sorted([(r.offset, r.offset + r.length) for r in records] + [(g.start, g.end) for g in gaps])
        assert spans[0][0] == 0 and spans[-1][1] == len(data)
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_lost_and_foreign_bytes(archive):
    junk = random.Random(3).randbytes(200_000) + b"\x1f\x8b\x08 WARC/1.1\r\n WARC/1."
    data = junk + archive[0] + archive[1][: len(archive[1]) // 2] + archive[2] + junk + archive[3] + archive[4][:-3]
    records, gaps = read(data)
    assert [r.id for r in records] == ["0", "2", "3"]
    assert [g.end - g.start for g in gaps] == [len(junk), len(archive[1]) // 2, len(junk), len(archive[4]) - 3]
    assert all(g.reason for g in gaps)


def test_wrong_digest_and_long_record():
    payload = b"a" * 3_000_000
    good = record_bytes(1, "u", payload, sha256(payload).hexdigest(), None, True)
    bad = record_bytes(2, "u", payload, sha256(b"").hexdigest(), None, True)
    double = zlib.compress(b"", wbits=31) + good
    records, gaps = read(bad + good + double)
    assert [r.id for r in records] == ["1", "1"]
    assert gaps[0] == Gap(0, len(bad), "the payload differs from its digest")
    assert gaps[1].end - gaps[1].start == len(double) - len(good)


@pytest.fixture
def pages(spark):
    long = "<p>é</p>" * 100
    rows = [(5, "http://a b/\r\n", long), (3, None, long), (9, "u", long), (1, "u", "short"), (2, "u", "short"),
            (4, "u", None), (6, "u", ""), (None, "u", long), (7, "u", "w" * 2_000_000)]
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


@pytest.mark.parametrize("compress", [True, False])
def test_tables(spark, pages, compress):
    records, gaps = archive_pages(pages, compress=compress)
    got = {r.id: (r.type, r.refers_to, r.payload_bytes, r.payload_digest) for r in records.collect()}
    sha = lambda t: sha256(t.encode()).hexdigest()
    long = "<p>é</p>" * 100
    assert gaps.count() == 0 and len(got) == 9
    assert got["3"] == ("response", None, 900, sha(long))
    assert got["5"] == got["9"] == got[None] == ("revisit", "3", 900, sha(long))
    assert got["1"][:2] == got["2"][:2] == got["4"][:2] == got["6"][:2] == ("response", None)
    assert got["4"] == ("response", None, 0, sha("")) and got["7"][2] == 2_000_000
    assert archive_pages(pages.where("false"))[0].count() == 0


def test_query_with_odd_ids(spark, pages):
    """Null ids stay null, and text ids are text."""
    sha = sha256(("<p>é</p>" * 100).encode()).hexdigest()
    for kind in ("long", "string"):
        rows = archived(pages.withColumn("page_id", pages.page_id.cast(kind))).collect()
        got = {None if r.page_id is None else str(r.page_id): tuple(r)[1:] for r in rows}
        three = 3 if kind == "long" else "3"
        assert len(rows) == 9 and got["3"] == (900, sha, "response", None)
        assert got[None] == got["5"] == got["9"] == (900, sha, "revisit", three)


def test_false_heads_are_linear():
    """Heads that claim more than there is, nested in junk: each costs its headers, not the rest of the archive."""
    good = page(1, False)[0]
    head = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 99999999\r\n\r\n"

    class Counted(io.BytesIO):
        total = most = 0

        def read(self, size=-1):
            data = super().read(size)
            self.total, self.most = self.total + len(data), max(self.most, len(data))
            return data

    for count in (5_000, 10_000):
        source = Counted(head * count + bytes(300_000) + good)
        found = list(salvage(source))
        assert [type(f) for f in found] == [Gap, Record] and found[1].id == "1"
        assert source.most <= 1 << 20 and source.total < 30 * len(source.getvalue())
    # Claims that end within the archive, but not where a record ends.
    head = head.replace(b"99999999", b"50000")
    found = list(salvage(Counted(head * 2_000 + good)))
    assert [type(f) for f in found] == [Gap, Record]


def foreign(kind, block, *more, digest=True):
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{kind}>"), ("WARC-Date", "2020-01-01T00:00:00Z"), *more]
    if digest:
        head.append(("WARC-Block-Digest", "sha1:" + base64.b32encode(sha1(block).digest()).decode()))
    lines = "".join(f"{n}: {v}\r\n" for n, v in [*head, ("Content-Length", len(block))])
    return b"WARC/1.0\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


@pytest.mark.parametrize("pack", [lambda x: x, lambda x: gzip.compress(x)], ids=["plain", "gz"])
def test_other_writers(pack):
    body = b"<html>\r\n\r\n</html>" * 5000
    http = ("Content-Type", "application/http; msgtype=response")
    sha = ("WARC-Payload-Digest", "sha1:" + base64.b32encode(sha1(body).digest()).decode())
    message = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n" + body
    records = [
        foreign("warcinfo", b"software: x\r\n", ("Content-Type", "application/warc-fields")),
        foreign("request", b"GET / HTTP/1.1\r\nHost: h\r\n\r\n", ("Content-Type", "application/http; msgtype=request")),
        foreign("response", message, http, sha, ("WARC-Target-URI", "http://h/")),
        foreign("response", message[:-1] + b"!", http, sha, digest=False),
        foreign("metadata", b"", ("X-Long", "one\r\n two")),
        foreign("revisit", message[:30], http, sha, ("WARC-Refers-To", "<urn:uuid:response>")),
        foreign("resource", bytes(range(256)), digest=False),
    ]
    hurt = bytearray(pack(foreign("conversion", b"text" * 100)))
    hurt[len(hurt) // 2] ^= 4
    data = b"".join(map(pack, records)) + bytes(hurt) + pack(records[0])
    found = list(salvage(io.BytesIO(data), payload=True))
    gaps = [f for f in found if isinstance(f, Gap)]
    assert [f.type for f in found if isinstance(f, Record)] == [
        "warcinfo", "request", "response", "metadata", "revisit", "resource", "warcinfo",
    ]
    assert [g.end - g.start for g in gaps] == [len(pack(records[3])), len(hurt)]
    assert found[2].payload == body and found[2].payload_digest == sha256(body).hexdigest()
    assert (found[2].target, found[2].record_id, found[2].id) == ("http://h/", "<urn:uuid:response>", None)
    assert [f.payload for f in found if isinstance(f, Record)][5] == bytes(range(256))
    assert [f.refers_to for f in found if isinstance(f, Record)][4] == "<urn:uuid:response>"


def test_damaged_files(spark, pages, tmp_path):
    folder = f"file://{tmp_path}"
    sized = with_revisits(pages.selectExpr("page_id", "url", "cast(coalesce(html, '') as binary) as payload"))
    archives = write_archives(sized.coalesce(1), folder, roll_bytes=1000)
    names = sorted(r.archive for r in archives.collect())
    assert len(names) >= 2 and archives.selectExpr("sum(records)").first()[0] == 9
    file = tmp_path / names[0]
    file.write_bytes(b"lost" + file.read_bytes()[1:])
    records, gaps = read_archives(archives, folder)
    lost = gaps.collect()
    assert len(lost) == 1 and lost[0].archive == names[0] and lost[0].start == 0
    assert records.count() == 8
