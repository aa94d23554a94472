import gzip
import hashlib
import io
import os

import pytest

from vistasieve.llm import warc_writer as ww
from vistasieve.llm.queries import ORACLE, op7_warc
from vistasieve.plans.check import duck, rows_of

from .conftest import SF_SMALL

ROWS = ([(i, f"http://h/{i % 7}", "x" * 1200 if i % 3 == 0 else f"page {i} " * 150, "c") for i in range(60)]
        + [(100 + i, None, t, "c") for i, t in enumerate([None, "", "s" * 999, "s" * 999, "ü" * 500, "ü" * 500])]
        + [(None, "u\r\nX: 1", "n" * 2000, "c"), (None, "u", "n" * 2000, "c"), (300, "u", "r" * 1500, "c"),
           (300, "u", "r" * 1500, "c"), (301, "z", "\r\n\r\nbody\x00" * 200_000, "c"), (None, "u", "x" * 1200, "c")])


def brute(rows):
    most = {}
    for p, _, t, _ in rows:
        b = (t or "").encode()
        if len(b) >= 1000 and p is not None:
            most[b] = max(p, most.get(b, p))
    out = []
    for p, _, t, _ in rows:
        b = (t or "").encode()
        to = most.get(b) if most.get(b) != p else None
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if to is not None else "response", to))
    return sorted(out, key=str)


def run(spark, folder, rows, parts=4, roll=3000):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, shard string").repartition(parts)
    return ww.write_warc(df, str(folder), roll_bytes=roll)


def test_round_trip_and_rolling(spark, tmp_path):
    manifest = run(spark, tmp_path / "a", ROWS)
    got = ww.read_warc(manifest).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(ROWS)
    payloads = {(r.page_id, bytes(r.payload)) for r in got if r.record_type == "response"}
    assert payloads <= {(p, (t or "").encode()) for p, _, t, _ in ROWS}
    files = manifest.collect()
    assert len(files) > 4 and sum(f.records for f in files) == len(ROWS)
    for f in files:
        data = (tmp_path / "a" / f.name).read_bytes()
        assert len(data) == f.bytes and hashlib.sha256(data).hexdigest() == f.sha256
        assert f.bytes <= 3000 or f.records == 1
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    assert os.listdir(tmp_path / "a" / "_temporary") == []


def test_same_rows_give_the_same_files(spark, tmp_path):
    a = {(f.name, f.sha256) for f in run(spark, tmp_path / "a", ROWS, 2).collect()}
    b = {(f.name, f.sha256) for f in run(spark, tmp_path / "b", ROWS[::-1], 7).collect()}
    assert a == b


def test_damage_is_noticed():
    data = ww.page_record(1, "u", b"body" * 300, hashlib.sha1(b"body" * 300).hexdigest(), None, 0)
    raw = next(ww.read_members(io.BytesIO(data), 100))
    assert ww.parse_record(raw)[0]["X-Page-ID"] == "1"
    with pytest.raises(ValueError):
        ww.parse_record(raw.replace(b"bodybody", b"bodyBody", 1))
    with pytest.raises(EOFError):
        list(ww.read_members(io.BytesIO(data[:-20])))


def test_empty_table(spark, tmp_path):
    manifest = run(spark, tmp_path / "a", ROWS[:0])
    assert manifest.collect() == [] and ww.read_warc(manifest).collect() == []


def test_oracle(spark):
    df = op7_warc(spark, SF_SMALL)
    res = duck(SF_SMALL).execute(ORACLE["op7_warc"])
    cols = [d[0] for d in res.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())


def test_every_shard_is_one_task_and_null_ids_spread(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ww, "SHARD_BYTES", 3000)
    rows = [(i, "u", f"{i} " * 200) for i in range(60)] + [(None, "n", f"null {i} " * 30) for i in range(60)] + [(None, "n", "null 1 " * 30)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    listed = ww.write_warc(df, str(tmp_path / "w"))
    shards = {r.shard: r.records for r in spark.read.parquet(f"{tmp_path}/w/_manifest").collect()}
    assert len(shards) >= 10 and max(shards.values()) < 40
    back = ww.read_warc(listed).collect()
    assert sorted(str(r.page_id) + r.payload.decode() for r in back) == sorted(str(i) + t for i, _, t in rows)
    idents = [m.split(b"WARC-Record-ID: ")[1].split(b"\r\n")[0] for r in listed.collect()
              for m in ww.read_members(open(f"{r.folder}/{r.name}", "rb")) if b"X-Page-ID" in m or b"null" in m]
    assert len(idents) == len(set(idents)) >= len(rows)
