import gzip
import hashlib
import os

import pytest

from fieldkpi.llm import warc

SCHEMA = "page_id long, url string, html string, file string, payload binary"
NASTY = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n\x00é" * 9


def pages(spark, rows):
    return spark.createDataFrame([(*r, "f", b"p") for r in rows], SCHEMA).repartition(3)


def expected(rows):
    out = []
    for i, _, html in rows:
        b = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == b and j is not None]
        first = min(same) if len(b) >= 100 else i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "response" if first == i else "revisit", None if first == i else first))
    return sorted(out)


ROWS = [(5, "http://x/ é\r\nA: b%41", NASTY), (3, None, NASTY), (9, "", NASTY), (1, "u", None), (2, "u", ""), (7, "u", "k" * 99), (8, "u", "k" * 99),
        (11, "u", "k" * 100), (10, "v", "k" * 100), (12, "w", "é" * 50), (13, "w", "é" * 50), (14, "big", "x" * 300_000), (-4, "big", "x" * 300_000)]


def test_pages_read_back(spark):
    got = warc.digest(spark, pages(spark, ROWS))
    assert sorted(tuple(r) for r in got.collect()) == expected(ROWS)
    assert warc.digest(spark, pages(spark, ROWS).where("false")).count() == 0


def test_files_are_valid_archives_with_resolved_references(spark, tmp_path):
    raw, final = str(tmp_path / "raw"), str(tmp_path / "final")
    warc.write_archives(pages(spark, ROWS), raw, file_bytes=2000)
    warc.deduplicate(spark, raw, final, file_bytes=2000)
    before = {r["page_id"]: r for r in warc.read_archives(spark, raw, bodies=True).collect()}
    after = {r["page_id"]: r for r in warc.read_archives(spark, final, bodies=True).collect()}
    assert len([f for f in os.listdir(final) if f.endswith(".gz")]) > 3
    for i, url, html in ROWS:
        a, b = after[i], before[i]
        assert bytes(b["payload"]) == (html or "").encode() and b["url"] == a["url"] == url
        whole = after[a["refers_to"]] if a["record_type"] == "revisit" else a
        assert bytes(whole["payload"]) == (html or "").encode()
        if a["record_type"] == "revisit":
            assert bytes(a["payload"]) == b"" and a["record_id"] != b["record_id"] and a["refers_to_id"] == whole["record_id"]
        else:
            assert a["record_id"] == b["record_id"]
    size = {d: sum(len(gzip.open(os.path.join(d, f)).read()) for f in os.listdir(d) if f.endswith(".gz")) for d in (raw, final)}
    assert size[final] < size[raw] - 299_000
    again = str(tmp_path / "again")
    warc.deduplicate(spark, final, again)  # revisits stay as they are
    third = {r["page_id"]: r for r in warc.read_archives(spark, again).collect()}
    assert all(third[i][c] == after[i][c] for i in third for c in ("record_type", "record_id", "refers_to_id", "refers_to", "refers_to_url", "payload_bytes"))


def test_repeated_and_null_ids_are_records_of_their_own(spark):
    body = "z" * 200
    rows = [(None, "a", body), (4, "a", body), (4, "a", body), (None, None, body), (None, "n", "q" * 150)]
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.digest(spark, pages(spark, rows)).collect()), key=repr)
    assert got == sorted([(4, "response", None), (4, "revisit", 4), (None, "revisit", 4), (None, "revisit", 4), (None, "response", None)], key=repr)


def test_hot_payloads_without_broadcast_of_all(spark, monkeypatch):
    monkeypatch.setattr(warc, "MAX_BROADCAST_COPIES", 1)
    rows = [(i, "u", "h" * 120 if i % 3 else f"{i % 5}" * 130) for i in range(60)]
    got = warc.digest(spark, pages(spark, rows))
    assert sorted(tuple(r) for r in got.collect()) == expected(rows)


def test_damaged_archives_are_refused(spark, tmp_path):
    raw = str(tmp_path / "raw")
    warc.write_archives(pages(spark, ROWS[:1]).coalesce(1), raw)
    name = next(os.path.join(raw, f) for f in os.listdir(raw) if f.endswith(".gz") and not f.startswith(".") and gzip.open(os.path.join(raw, f)).read())
    whole = gzip.open(name).read()
    bad = tmp_path / "bad"
    for i, data in enumerate((whole[:-60], whole.replace(b"WARC/1.1\r\nContent-Length: 3", b"WARC/1.1\r\nContent-Length: 4"))):
        (bad / str(i)).mkdir(parents=True)
        (bad / str(i) / "part.gz").write_bytes(gzip.compress(data))
        with pytest.raises(Exception, match="archive ends|differs from its head"):
            warc.read_archives(spark, str(bad / str(i))).collect()
