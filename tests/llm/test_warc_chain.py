import hashlib
import random
import uuid

import numpy as np
import pytest
from mergewell.llm import warc_chain
from mergewell.llm.warc_chain import MAGIC, archive_round_trip, exits, on_chain, read_archives, write_archives


def brute(rows):
    payloads = [(p, (h or "").encode()) for p, _, h in rows]
    least = {}
    for p, x in payloads:
        if len(x) >= 100 and p is not None:
            least[x] = min(p, least.get(x, p))
    out = []
    for p, x in payloads:
        refers = least.get(x) if least.get(x) != p else None
        out.append((p, len(x), hashlib.sha256(x).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


def rows(seed):
    r = random.Random(seed)
    magic = MAGIC.decode()
    fake = f"{magic}WARC-Type: response\r\nPage: 9\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    long = ["<p>é😀</p>" * 30, fake * 3, "x" * 99, "y" * 100, f"{magic * 5}tail" + "z" * 80, f"a{fake}", magic + "q" * 90, "\r\n\r\n" * 40]
    out = [(i * 3 % 80, f"http://a/{i}\r\n\r\n{magic}", r.choice([*long, "", None, magic, fake, f"n{i}" * 60, f"{i}{magic}" * 20])) for i in range(80)]
    out += [(None, None, long[0]), (5, "u", "same id " * 20), (5, "u", "same id " * 20), (7, "u", "same id " * 20), (None, "u", "null id " * 20), (-4, "u", long[3])]
    r.shuffle(out)
    return out


@pytest.mark.parametrize(("compression", "block"), [("gzip", None), ("none", None), ("none", 700)])
def test_round_trip(spark, tmp_path, compression, block):
    data = rows(1)
    frame = spark.createDataFrame([(*x, "k") for x in data], "page_id long, url string, html string, digest string").repartition(3)
    write_archives(frame, f"file://{tmp_path}/a", compression)
    if block:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = read_archives(spark, f"file://{tmp_path}/a").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(tuple, got), key=str) == brute(data)


def test_empty_table(spark):
    assert archive_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_large_group_is_shuffled_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(warc_chain, "MOST_BROADCAST", 0)
    data = [(i, "u", "copy " * 40) for i in range(50)]
    got = archive_round_trip(spark.createDataFrame(data, "page_id long, url string, html string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(data)


def test_chains():
    starts, ends = np.array([0, 5, 12, 20, 31]), np.array([12, 31, 31, 40, 50])
    assert on_chain(starts, ends, 0).tolist() == [True, False, True, False, True]
    assert on_chain(starts, ends, None).tolist() == [False] * 5 and on_chain(starts, ends, 5).tolist() == [False, True, False, False, True]
    assert exits(starts, ends).tolist() == [50, 50, 50, 40, 50]
    n = 5000
    assert on_chain(np.arange(n) * 7, np.arange(1, n + 1) * 7, 0).all() and set(exits(np.arange(n) * 7, np.arange(1, n + 1) * 7).tolist()) == {7 * n}
    r = random.Random(4)
    for _ in range(200):
        starts = np.array(sorted(r.sample(range(60), r.randint(1, 30))))
        ends = starts + np.array([r.randint(1, 12) for _ in starts])
        after = dict(zip(starts.tolist(), ends.tolist(), strict=True))

        def walk(at, after=after):
            seen = []
            while at in after:
                seen.append(at)
                at = after[at]
            return seen, at

        assert exits(starts, ends).tolist() == [walk(s)[1] for s in starts.tolist()]
        assert starts[on_chain(starts, ends, int(starts[0]))].tolist() == walk(int(starts[0]))[0]


def test_a_broken_chain_is_noticed(spark, tmp_path):
    page = spark.createDataFrame([(i, "u", f"hello world {i}") for i in range(20)], "page_id long, url string, html string").coalesce(1)
    for kind in ("cut", "longer", "before"):
        write_archives(page, f"file://{tmp_path}/{kind}")
        file, = (tmp_path / kind).glob("*.txt")
        data = file.read_bytes()
        file.write_bytes({"cut": data[:-30], "longer": data.replace(b"hello world 7", b"hello worlds 7"), "before": b"x" + data}[kind])
        (tmp_path / kind / f".{file.name}.crc").unlink()
        with pytest.raises(ValueError, match="breaks off"):
            read_archives(spark, f"file://{tmp_path}/{kind}")


def test_a_plain_parser_reads_the_files(spark, tmp_path):
    """Records after the format's rules: version, fields, block and two line ends, one after the other, with what is mandatory."""
    data = rows(3)
    write_archives(spark.createDataFrame(data, "page_id long, url string, html string").repartition(3), f"file://{tmp_path}/a")
    found, ids = [], {}
    for file in (tmp_path / "a").glob("*.txt"):
        raw, at = file.read_bytes(), 0
        while at < len(raw):
            end = raw.index(b"\r\n\r\n", at)
            version, *lines = raw[at:end].decode().split("\r\n")
            fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
            size = int(fields["Content-Length"])
            block = raw[end + 4 : end + 4 + size]
            assert version == "WARC/1.1" and raw[end + 4 + size : end + 8 + size] == b"\r\n\r\n"
            assert uuid.UUID(fields["WARC-Record-ID"][len("<urn:uuid:") : -1]).variant == uuid.RFC_4122 and fields["WARC-Date"].endswith("Z") and fields["WARC-Target-URI"]
            head, _, payload = block.partition(b"\r\n\r\n")
            assert head.startswith(b"HTTP/1.1 200")
            page = int(fields["Page"]) if fields["Page"] else None
            refers = fields.get("Refers-To-Page")
            if fields["WARC-Type"] == "revisit":
                assert fields["WARC-Profile"].endswith("identical-payload-digest") and not payload
            else:
                assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(payload).hexdigest()
                ids[fields["WARC-Record-ID"]] = page
            found.append((page, int(fields["Payload-Length"]), fields["WARC-Payload-Digest"][7:], fields["WARC-Type"], None if refers is None else int(refers), fields.get("WARC-Refers-To")))
            at = end + 8 + size
    assert sorted((x[:5] for x in found), key=str) == brute(data)
    assert all(ids[x[5]] == x[4] for x in found if x[5] is not None)


def test_very_long_pages(spark):
    magic = MAGIC.decode()
    data = [(1, "u", "long page " * 300_000), (2, "u", (magic + "z" * 50) * 20_000), (3, "u", "long page " * 300_000)]
    assert sorted(map(tuple, archive_round_trip(spark.createDataFrame(data, "page_id long, url string, html string")).collect()), key=str) == brute(data)


def test_a_damaged_payload_is_noticed(spark, tmp_path):
    page = spark.createDataFrame([(1, "u", "hello world")], "page_id long, url string, html string").coalesce(1)
    write_archives(page, f"file://{tmp_path}/a", "none")
    file, = tmp_path.glob("a/*.txt")
    file.write_bytes(file.read_bytes().replace(b"hello", b"jello"))
    (tmp_path / "a" / f".{file.name}.crc").unlink()
    with pytest.raises(Exception, match="payload digest differs"):
        read_archives(spark, f"file://{tmp_path}/a").collect()
