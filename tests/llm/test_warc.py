import gzip
import hashlib
import random
from collections import Counter

import pytest

from roadflux.llm import warc

PAGE = "page_id bigint, url string, html string, digest string"


def expected(rows):
    out, keeper = [], {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and i is not None:
            keeper[data] = max(i, keeper.get(data, i))
    for i, _, html in rows:
        data = (html or "").encode()
        best = keeper.get(data)
        other = best is not None and best != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if other else "response", best if other else None))
    return Counter(out)


def run(spark, rows, folder, compress=True, file_bytes=900, per_range=4):
    df = spark.createDataFrame([(*r, "clash") for r in rows], PAGE)
    warc.write_archives(warc.captures_of(df), folder, file_bytes=file_bytes, compress=compress)
    return warc.merged_index(warc.read_archives(spark, folder), rows_per_range=per_range)


@pytest.mark.parametrize("compress", [True, False])
def test_round_trip_and_order(spark, tmp_path, compress):
    rnd = random.Random(2)
    big = ["é" * 500, "x" * 1000, "y" * 999, "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 40]
    rows = [(i, f"http://{rnd.choice('abc')}.net/{rnd.randrange(4)}", rnd.choice([*big, None, "", "\r\n\r\n", f"<p>{i}\x00"])) for i in range(60)]
    rows += [(100, None, "z"), (101, "no scheme", "z"), (102, "http://q.org/\r\nEvil: 1", "z"), (None, "http://a.net/", "x" * 1000), (103, "http://a.net/", "long " * 200_000), (7, rows[7][1], rows[7][2])]
    index = run(spark, rows, str(tmp_path / "w"), compress).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in index) == expected(rows)
    keys = [(r.url_key.encode(), r.captured_at, r.page_id is not None, r.page_id or 0) for r in index]
    assert keys == sorted(keys)  # partitions in order, rows in order
    payloads = {i: (html or "").encode() for i, _, html in rows}
    for r in index:  # the index leads to the record
        raw = (tmp_path / "w" / r.archive).read_bytes()[r.offset :][: r.packed_bytes]
        ((_, head, block),) = warc.records(memoryview(raw))
        assert head["WARC-Type"] == r.record_type and (r.record_type == "revisit" or r.page_id == 7 or warc.payload_of(head, block) == payloads[r.page_id])
    assert {r.url_key for r in index if r.page_id == 0} == {"net," + rows[0][1][7] + ")/" + rows[0][1][-1]}


def test_one_url_is_cut_into_ranges(spark, tmp_path):
    rows = [(i, "http://hot.net/", f"{i}") for i in range(200)]
    index = run(spark, rows, str(tmp_path / "w"), file_bytes=8000, per_range=20)
    sizes = [len(x) for x in index.rdd.glom().collect()]
    assert sum(sizes) == 200 and max(sizes) < 100
    assert [r.page_id for r in index.collect()] == list(range(200))


def test_nothing(spark, tmp_path):
    df = spark.createDataFrame([], PAGE)
    warc.write_archives(warc.captures_of(df), str(tmp_path / "w"))
    assert warc.merged_index(warc.read_archives(spark, str(tmp_path / "w"))).count() == 0


def test_archives_are_gzip_files_and_bounded(spark, tmp_path):
    rows = [(i, f"http://a.net/{i}", random.Random(i).randbytes(3000).hex()) for i in range(300)] + [(900, "http://b.net/", "z" * (17 << 20)), (901, "http://b.net/", "w" * (16 << 20))]
    folder = tmp_path / "w"
    index = run(spark, rows, str(folder), file_bytes=100_000, per_range=1000).collect()
    sizes = [f.stat().st_size for f in folder.glob("part-*")]
    assert len(sizes) > 8 and max(sizes) < 100_000 + 20_000 and len(index) == 302
    for f in folder.glob("part-*"):
        text = gzip.decompress(f.read_bytes())  # an ordinary tool reads all members
        assert text.count(b"WARC/1.1\r\n") == sum(r.archive == f.name for r in index)
    big = next(r for r in index if r.page_id == 900)
    raw = gzip.decompress((folder / big.archive).read_bytes()[big.offset : big.offset + big.packed_bytes])
    assert raw.endswith(b"z" * 1000 + b"\r\n\r\n") and b"HTTP/1.1 200 OK" in raw[:2000]


def test_records_of_one_member_have_no_place(spark):
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    whole = gzip.compress(record * 3)
    assert [at for at, *_ in warc.records(memoryview(whole))] == [0, None, None]
    assert [at for at, *_ in warc.records(memoryview(record * 3))] == [0, len(record), 2 * len(record)]
    assert [at for at, *_ in warc.records(memoryview(warc.member(record) * 2))] == [0, len(warc.member(record))]


def test_damage_is_noticed(tmp_path):
    good = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for *_, b in warc.records(memoryview(good * 2))] == [b"abc"] * 2
    for bad in (good[:-6], good.replace(b"3", b"2"), good.replace(b"WARC/1.1", b"ZARC/1.1")):
        with pytest.raises(ValueError):
            list(warc.records(memoryview(bad)))


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    rnd = random.Random(k)
    runs = [sorted(rnd.randrange(50) for _ in range(rnd.choice([0, 1, 7, 30]))) for _ in range(k)]
    assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_loser_tree_compares_once_a_level():
    class Counted(int):
        seen = 0

        def __lt__(self, other):
            Counted.seen += 1
            return int.__lt__(self, other)

    runs = [[Counted(i * 16 + r) for i in range(100)] for r in range(16)]
    list(warc.LoserTree(runs, lambda x: x))
    assert Counted.seen <= 1600 * 4 + 16
