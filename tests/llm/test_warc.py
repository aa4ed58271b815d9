import base64
import gzip
import hashlib
import random

import pytest

from clickloom.llm import warc

SCHEMA = "page_id long, url string, html string, key string, file string"


def pages():
    rng = random.Random(2)
    rows = [
        (k, f"http{'s' * (k % 2)}://{rng.choice(['hot', 'hot', 'b'])}.example.com/{rng.randrange(9)}?x={k % 3}#f",
         f"<p>{'é' * (k % 7)}{k % 11}</p>" * (k % 4), "k", "f")
        for k in range(120)
    ]
    return rows + [(200, None, None, "k", "f"), (201, "", "", "k", "f"), (202, "odd url\nwith\tbreaks%", "x" * 400_000, "k", "f"),
                   (203, "http://hot.example.com/0?x=0", "WARC/1.1\r\n\r\nfake\r\n\r\n", "k", "f"), (5, *rows_of(rows, 5)), (None, "http://n/", "unique", "k", "f")]


def rows_of(rows, page_id):
    return next(r[1:] for r in rows if r[0] == page_id)


def want(rows):
    payload = [(r[2] or "").encode() for r in rows]
    largest = {}
    for r, p in zip(rows, payload, strict=True):
        largest[p] = max(largest.get(p, -1), -1 if r[0] is None else r[0])
    out = []
    for r, p in zip(rows, payload, strict=True):
        first = largest[p] if largest[p] >= 0 else None
        response = r[0] == first or payload.count(p) == 1
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((r[0], len(p), digest, "response" if response else "revisit", None if response else first))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def archive(spark):
    folder = warc.archive_folder(spark)
    frame = spark.createDataFrame(pages(), SCHEMA).repartition(3)
    records = warc.write_archives(frame, folder, file_bytes=4000)
    return folder, frame, records, warc.write_index(records, folder, block_lines=7, shards=4)


def test_every_record_is_read_back(archive):
    folder, frame, _, shards = archive
    places = warc.look_up(frame, folder, shards)
    got = warc.read_records(places, folder).collect()
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == want(pages())
    source = {(r[0], r[1], (r[2] or "").encode()) for r in pages()}
    for r in got:
        if r.record_type == "response":
            assert (r.page_id, r.url, bytes(r.payload)) in source


def test_reading_tasks_follow_the_archive_bytes(archive):
    folder, frame, _, shards = archive
    places = warc.look_up(frame, folder, shards)
    for task_bytes in (1 << 30, 500):
        read = warc.read_records(places, folder, task_bytes=task_bytes)
        total = sum(r.length for r in places.select("length").collect())
        assert read.rdd.getNumPartitions() == -(-total // task_bytes)
        assert read.count() == places.count()


def test_lookup_of_single_urls(spark, archive):
    folder, _, records, shards = archive
    rows = records.collect()
    assert len({r.file for r in rows}) > 3 and len(shards) > 1
    urls = [r[1] for r in pages()][::9] + ["http://missing.example/", "", "zzz", "http://hot.example.com/0?x=0#other"]
    for url in urls:
        asked = spark.createDataFrame([(url,)], "url string")
        got = {(r.file, r.offset) for r in warc.look_up(asked, folder, shards).collect()}
        assert got == {(r.file, r.offset) for r in rows if r.key == warc.url_key(url)}


def test_files_are_archives(archive):
    folder, _, records, _ = archive
    system, path = warc.file_system(folder)
    file = records.first().file
    raw = gzip.decompress(system.open_input_stream(f"{path}/{file}", compression=None).read())
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and raw.endswith(b"\r\n\r\n")


def test_empty_table(spark):
    folder = warc.archive_folder(spark)
    frame = spark.createDataFrame([], SCHEMA)
    shards = warc.write_index(warc.write_archives(frame, folder), folder)
    assert shards == [] and warc.read_records(warc.look_up(frame, folder, shards), folder).count() == 0


def test_damage_is_noticed():
    raw = warc.record(1, "http://a/", b"payload", None, True)
    assert warc.parse_record(raw)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse_record(raw.replace(b"payload", b"pAyload"))


def test_keys():
    assert warc.url_key("https://U@WWW.a.Example.com:8080/B?c#d") == "com,example,a,www)/B?c"
    assert warc.url_key("//x.y") == "y,x)/" and warc.url_key(None) == "-" == warc.url_key("")
