from __future__ import annotations

import hashlib

from flightmarts.llm import warc

FAKE = "x\r\n\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\nWARC/1.0\r\n tail"
ROWS = [
    (1, "http://a\r\nb", FAKE), (2, None, None), (3, "u", ""), (4, "u", FAKE + "é" * 100),
    (5, "v", FAKE + "é" * 100), (6, "u", "short"), (7, "u", "short"), (8, "w", FAKE * 50),
    (9, "w", "WARC/1.0\r\n"), (10, "w", "WARC/1.0\r\n\r\n\r\nWARC/1.0\r\n"),
    (11, "x", "y" * 99), (12, "x", "y" * 99), (13, "x", "z" * 100), (14, "x", "z" * 100),
    (15, "x", "q" * 200_000),
]


def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr(
        "*", "'clash' AS size", "'clash' AS digest", "'clash' AS value", "'clash' AS first"
    ).coalesce(2)


def expected():
    first = {}
    for page, _, html in sorted(ROWS, key=lambda r: r[0]):
        payload = (html or "").encode()
        revisit = len(payload) >= 100 and payload in first
        yield (
            page, len(payload), hashlib.sha256(payload).hexdigest(),
            "revisit" if revisit else "response", first[payload] if revisit else None,
        )
        first.setdefault(payload, page)


def test_pages_come_back(spark):
    assert sorted(map(tuple, warc.archived(pages(spark)).collect())) == list(expected())


def test_small_splits_cut_records_anywhere(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        rows = warc.archived(pages(spark).filter("page_id != 15")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(map(tuple, rows)) == [r for r in expected() if r[0] != 15]


def test_second_reading_may_split_files_otherwise(spark, monkeypatch):
    name = "spark.sql.files.maxPartitionBytes"
    before, bitmap = spark.conf.get(name), warc.bitmap

    def resplit(*args, **kwargs):
        bits = bitmap(*args, **kwargs)
        spark.conf.set(name, "700")
        return bits

    monkeypatch.setattr(warc, "bitmap", resplit)
    try:
        rows = warc.archived(pages(spark).filter("page_id != 15")).collect()
    finally:
        spark.conf.set(name, before)
    assert sorted(map(tuple, rows)) == [r for r in expected() if r[0] != 15]


def test_files_are_plain_records(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write(pages(spark), path)
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "archive").glob("part-*")))
    seen = 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.0\r\n")
        length = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
        assert rest[length : length + 4] == b"\r\n\r\n"
        data, seen = rest[length + 4 :], seen + 1
    assert seen == len(ROWS)


def test_damage_is_noticed(spark, tmp_path):
    path = tmp_path / "archive"
    warc.write(pages(spark).coalesce(1), str(path))
    for crc in path.glob(".*.crc"):
        crc.write_bytes(b"")
    file = next(path.glob("part-*"))
    hurt = tmp_path / "hurt"
    hurt.mkdir()
    (hurt / "part-0.txt").write_bytes(file.read_bytes()[:-30])
    try:
        warc.read(spark, str(hurt)).collect()
    except ValueError as error:
        assert "whole record" in str(error)
    else:
        raise AssertionError("damage went unnoticed")


def test_empty_table(spark):
    assert warc.archived(pages(spark).limit(0)).count() == 0
