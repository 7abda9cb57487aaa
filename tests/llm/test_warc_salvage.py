from __future__ import annotations

import glob
import gzip
import os
import random
import zlib

import pytest

from riskflow.llm import warc_salvage as op
from tests.llm.conftest import rows

PAGES = "page_id long, url string, html string, digest string, refers_to string, payload string"
HTMLS = ["<p>a</p>", "é" * 3000, "", "<p>a</p>", None, "WARC/1.1\r\nWARC-Type: fake\r\n\r\n", "x\r\n\r\ny\r\n\r\n", "\x00\x1f\x8b\x08"]


def pages_of(spark, htmls=HTMLS):
    return spark.createDataFrame([(i, None if i == 2 else f"http://a/{i}\r\nX: y", h, "clash", "clash", "clash") for i, h in enumerate(htmls)], PAGES)


def archive(n: int, compress: bool) -> tuple[list[bytes], list[str]]:
    """Records by hand, and their ids."""
    out, ids = [], []
    for i in range(n):
        payload = f"payload {i} ".encode() * (i + 1)
        head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Payload-Digest: sha1:{op.digest_of(payload)}\r\nContent-Length: {len(payload)}\r\n\r\n"
        record = head.encode() + payload + b"\r\n\r\n"
        out.append(gzip.compress(record) if compress else record)
        ids.append(f"<urn:page:{i}>")
    return out, ids


def read(raw: bytes) -> tuple[list[str], list[tuple[int, int]]]:
    items = list(op.salvage(raw))
    return [i.headers["warc-record-id"] for i in items if isinstance(i, op.Record)], [i for i in items if not isinstance(i, op.Record)]


@pytest.mark.parametrize("compress", [False, True])
def test_whole_archive(compress):
    parts, ids = archive(6, compress)
    assert read(b"".join(parts)) == (ids, []) and read(b"") == ([], [])


@pytest.mark.parametrize("compress", [False, True])
@pytest.mark.parametrize("seed", range(8))
def test_damage_costs_only_what_it_hits(compress, seed):
    """Flipped, lost and added bytes: all untouched records come back, gaps cover the rest."""
    rng = random.Random(seed)
    parts, ids = archive(12, compress)
    hit = set(rng.sample(range(12), 4))
    raw, spans, at = [], [], 0
    for i, part in enumerate(parts):
        if i in hit:
            place = rng.randrange(len(part))
            kind = rng.choice(["flip", "lose", "add", "cut"])
            part = {
                "flip": part[:place] + bytes([part[place] ^ 0x55]) + part[place + 1 :],
                "lose": part[:place] + part[place + 3 :],
                "add": part[:place] + b"\x00junk" + part[place:],
                "cut": part[: place // 2],
            }[kind]
        raw.append(part)
        spans.append((at, at + len(part)))
        at += len(part)
    found, gaps = read(b"".join(raw))
    assert [i for n, i in enumerate(ids) if n not in hit] == [i for i in found if int(i[10:-1]) not in hit]
    for a, b in gaps:
        assert not any(a < spans[n][1] and spans[n][0] < b for n in range(12) if n not in hit)


def test_gap_is_logged_where_it_is():
    parts, ids = archive(3, False)
    junk = b"WARC/1.0\r\nbroken\r\n\r\n" + b"\x1f\x8b\x08no member"
    raw = junk + parts[0] + parts[1][:-2] + parts[2] + b"tail"
    a, b = len(junk) + len(parts[0]), len(junk) + len(parts[0]) + len(parts[1]) - 2
    assert read(raw) == ([ids[0], ids[2]], [(0, len(junk)), (a, b), (len(raw) - 4, len(raw))])


def in_one_member(bad: int, n: int = 40) -> tuple[bytes, list[str], list[bytes]]:
    """Records in one content, of which one has a wrong byte."""
    parts, ids = archive(n, False)
    if bad >= 0:
        parts[bad] = parts[bad].replace(b"payload", b"PAYLOAD", 1)
    return b"".join(parts), ids, parts


@pytest.mark.parametrize("bad", [0, 17, 39])
def test_bad_record_in_a_member_costs_itself(bad):
    content, ids, parts = in_one_member(bad)
    raw = gzip.compress(content)
    tail, (last,) = archive(1, True)[0][0], archive(1, True)[1]
    found, gaps = read(raw + tail)
    assert found == [i for n, i in enumerate(ids) if n != bad] + [last]
    assert gaps == [op.InnerGap(0, len(raw), sum(map(len, parts[:bad])), len(parts[bad]))]


@pytest.mark.parametrize("level", [0, 9])
def test_cut_off_member_gives_its_whole_records(level):
    content, ids, parts = in_one_member(-1)
    raw = gzip.compress(content, level)
    for kept in (len(raw) - 1, len(raw) - 9, len(raw) // 2, len(raw) // 7):
        reader = zlib.decompressobj(31)
        have = len(reader.decompress(raw[:kept]))
        whole = [i for n, i in enumerate(ids) if sum(map(len, parts[: n + 1])) <= have]
        tail, (last,) = archive(1, True)[0][0], archive(1, True)[1]
        found, gaps = read(raw[:kept] + tail)
        assert found == whole + [last] and whole
        assert len(gaps) == 1 and gaps[0][1] == kept


@pytest.mark.parametrize("seed", range(12))
def test_damaged_member_of_several_records(seed):
    """A wrong byte anywhere: all records that end before it come back, and what follows."""
    rng = random.Random(seed)
    parts, ids = [], []
    for i in range(30):
        payload = rng.randbytes(9000)
        head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Payload-Digest: sha1:{op.digest_of(payload)}\r\nContent-Length: {len(payload)}\r\n\r\n"
        parts.append(head.encode() + payload + b"\r\n\r\n")
        ids.append(f"<urn:page:{i}>")
    raw = bytearray(gzip.compress(b"".join(parts)))
    hit = rng.randrange(len(raw) // 3, len(raw))
    raw[hit] ^= 0x55
    before = len(zlib.decompressobj(31).decompress(bytes(raw[:hit])))
    whole = [i for n, i in enumerate(ids) if sum(map(len, parts[: n + 1])) <= before]
    tail, (last,) = archive(1, True)[0][0], archive(1, True)[1]
    found, _ = read(bytes(raw) + tail)
    assert whole and found[: len(whole)] == whole and found[-1] == last
    assert len(found) == len(set(found[:-1])) + 1


def test_wrong_checksum_of_a_member_costs_no_record():
    content, ids, _ = in_one_member(-1)
    raw = bytearray(gzip.compress(content))
    raw[-6] ^= 1
    found, gaps = read(bytes(raw))
    assert found == ids and len(gaps) == 1 and len(raw) - 10 <= gaps[0][0] <= len(raw) - 8 and gaps[0][1] == len(raw)


def test_member_without_records_is_one_gap():
    parts, ids = archive(2, True)
    text = gzip.compress(b"no record")
    assert read(parts[0] + text + parts[1]) == (ids, [(len(parts[0]), len(parts[0]) + len(text))])


def test_log_of_inner_gaps(spark, place):
    content, ids, parts = in_one_member(3, 6)
    os.makedirs(f"{place}/inner")
    open(f"{place}/inner/a.warc.gz", "wb").write(gzip.compress(content))
    log = sorted((r.inner_offset, r.kind, r.inner_length, r.record_id) for r in op.read(spark, f"{place}/inner").collect())
    assert [r[1] for r in log] == ["record"] * 3 + ["gap"] + ["record"] * 2
    assert log[3] == (sum(map(len, parts[:3])), "gap", len(parts[3]), None)


def test_digest_check():
    parts, ids = archive(2, False)
    raw = parts[0].replace(b"payload 0", b"PAYLOAD 0") + parts[1]
    assert read(raw) == ([ids[1]], [(0, len(parts[0]))])


@pytest.mark.parametrize("compress", [False, True])
def test_round_trip(spark, compress):
    found = rows(op.round_trip(pages_of(spark), compress=compress))
    expected = []
    for i, html in enumerate(HTMLS):
        raw = (html or "").encode()
        holder = max(j for j, h in enumerate(HTMLS) if (h or "").encode() == raw)
        expected.append((i, len(raw), op.digest_of(raw), "response" if i == holder else "revisit", None if i == holder else holder))
    assert found == expected


@pytest.mark.parametrize("compress", [False, True])
def test_a_damaged_archive_of_the_round_trip_is_no_silent_loss(spark, place, monkeypatch, compress):
    """If what was written cannot be read back whole, the query fails and says where."""
    real = op.write

    def write(pages, path, *a, **b):
        real(pages, path, *a, **b)
        file = max(glob.glob(f"{path}/part-*"), key=os.path.getsize)
        raw = bytearray(open(file, "rb").read())
        raw[len(raw) // 2] ^= 0xFF
        os.remove(os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc"))
        open(file, "wb").write(raw)

    monkeypatch.setattr(op, "write", write)
    monkeypatch.setattr(op, "scratch_dir", lambda session, label: f"{place}/{label}{compress}")
    with pytest.raises(Exception, match="damaged archive: .*part-"):
        op.round_trip(pages_of(spark).coalesce(1), compress=compress).collect()


@pytest.mark.parametrize("compress", [False, True])
def test_files_and_payloads(spark, place, compress):
    op.write(pages_of(spark).coalesce(1), f"{place}/out", compress, records_per_file=3)
    files = glob.glob(f"{place}/out/part-*")
    assert len(files) == 3
    if compress:  # any gzip reader gets the same records
        assert all(gzip.decompress(open(f, "rb").read()).startswith(b"WARC/1.1\r\n") for f in files)
    found = op.read(spark, f"{place}/out", with_payload=True).where("record_type = 'response'")
    payloads = {r.record_id: bytes(r.payload).decode() for r in found.collect()}
    assert payloads["<urn:page:1>"] == HTMLS[1] and payloads["<urn:page:5>"] == HTMLS[5]
    damaged = max(files, key=os.path.getsize)
    raw = bytearray(open(damaged, "rb").read())
    raw[len(raw) // 2] ^= 0xFF
    os.makedirs(f"{place}/hurt")
    open(f"{place}/hurt/a.warc", "wb").write(raw)
    log = op.read(spark, f"{place}/hurt").collect()
    assert {r.kind for r in log} == {"record", "gap"}
    assert sum(r.kind == "record" for r in log) == 2


@pytest.mark.parametrize("compress", [False, True])
def test_archives_are_bounded_by_bytes(spark, place, compress):
    """Small and large pages: no file above the limit but for a record that is."""
    rng = random.Random(1)
    htmls = [rng.randbytes(size // 2).hex() for size in [200] * 60 + [6_000] * 40 + [30_000] * 12 + [120_000] * 2]
    op.write(pages_of(spark, htmls).coalesce(1), f"{place}/sized{compress}", compress, records_per_file=64, file_bytes=100_000)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{place}/sized{compress}/part-*")]
    assert sum(s > 100_000 for s in sizes) <= 2 and max(sizes) < 125_000
    found = op.read(spark, f"{place}/sized{compress}")
    assert {(r.kind, r.payload_digest) for r in found.collect()} == {("record", op.digest_of(h.encode())) for h in htmls}
    assert found.count() == len(htmls)


def test_least_bytes(spark):
    found = op.round_trip(pages_of(spark), least_bytes=5).where("record_type = 'revisit'")
    assert rows(found, "page_id", "refers_to") == [(0, 3)]


def test_odd_rows(spark):
    pages = spark.createDataFrame([(None, None, None, None, None, None), (None, None, "x", None, None, None), (None, None, "x", None, None, None), (4, None, "", None, None, None), (4, None, "", None, None, None), (5, "u", "y" * 200_000, "", "", "")], PAGES)
    found = rows(op.round_trip(pages), "page_id", "payload_bytes", "record_type", "refers_to")
    assert found == [(None, 0, "revisit", 4), (None, 1, "response", None), (None, 1, "response", None), (4, 0, "response", None), (4, 0, "response", None), (5, 200_000, "response", None)]
    assert op.round_trip(pages.limit(0)).count() == 0
