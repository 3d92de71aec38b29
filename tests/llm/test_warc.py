import base64
import hashlib

import pytest

from tests.llm.helpers import store
from vaultmart.llm import warc
from vaultmart.llm.common import new_path

PAGES = "page_id long, url string, html string, frame int, sha string, id string"


def pages_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "s", "i") for r in rows], PAGES).repartition(3)


ROWS = [(i, f"http://h/{i}", f"<p>page {i % 7} é</p>" * (i % 5 + 1)) for i in range(60)]
ROWS += [(100, None, None), (101, "http://h/a b\r\nX: y", ""), (102, "http://h/l", "z" * 700_000), (103, "http://h/m", "z" * 700_000),
         (104, "u", "WARC/1.1\r\n\r\nfake\r\n\r\n"), (104, "u", "WARC/1.1\r\n\r\nfake\r\n\r\n"), (None, "n", "lonely"), (None, "n", "<p>page 0 é</p>")]


def brute(rows, min_bytes=0):
    groups = {}
    for i, _, html in rows:
        groups.setdefault(html or "", []).append(i)
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        ids = [x for x in groups[html or ""] if x is not None]
        first = max(ids) if ids else None
        refers = first if len(raw) >= min_bytes and first is not None and (i is None or i < first) else None
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((i, len(raw), digest, "response" if refers is None else "revisit", refers))
    return sorted(map(str, out))


@pytest.fixture(scope="module", params=[0, 20])
def archives(spark, request):
    folder = new_path(spark, "warc")
    marked = warc.mark_revisits(pages_frame(spark, ROWS), "page_id", "url", "html", request.param)
    return store(spark)(warc.write_archives(marked, folder), "index"), folder, request.param


def test_round_trip(spark, archives):
    index, folder, least = archives
    got = warc.read_archives(index, folder, store(spark)).collect()
    as_int = lambda x: None if x is None else int(x)
    assert sorted(str((as_int(r.id), r.payload_bytes, r.payload_digest, r.record_type, as_int(r.refers_to))) for r in got) == brute(ROWS, least)
    # the index places every record where the reader found it
    assert sorted(str((as_int(r.id), r.bundle, r.frame, r.offset)) for r in got) == sorted(str(tuple(r)) for r in index.collect())


def test_random_access(spark, archives):
    index, folder, _ = archives
    got = {r.id: r for r in warc.fetch(index, folder, spark.createDataFrame([(103,), (104,), (5,)], "id long")).collect()}
    assert bytes(got[103].payload) == b"z" * 700_000 and got[104].headers["WARC-Type"] == "response"
    assert got[5].headers["WARC-Target-URI"] == "http://h/5"


def test_frames_are_independent_and_standard(archives):
    import zstandard

    index, folder, _ = archives
    fs, path = warc.file_system(folder)
    for name in {r.bundle for r in index.select("bundle").distinct().collect()}:
        raw = fs.open_input_file(f"{path}/{name}").read()
        with fs.open_input_file(f"{path}/{name}") as f:
            table = warc.seek_table(f, f.size())
            parts = [warc.read_frame(f, *row) for row in table]
        whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()   # skips the seek table
        assert whole == b"".join(parts) and all(p.startswith(b"WARC/1.1") for p in parts)


def test_empty_table(spark):
    folder = new_path(spark, "warc")
    index = store(spark)(warc.write_archives(warc.mark_revisits(pages_frame(spark, []), "page_id", "url", "html"), folder), "index")
    assert index.count() == 0 and warc.read_archives(index, folder, store(spark)).count() == 0
