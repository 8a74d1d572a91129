import base64
import hashlib
import re

import pytest

from webloom.llm import warc_store as W

PAGE = "page_id long, url string, html string, rid long, sha256 string, payload string"


def expected(rows, least):
    out, top = [], {}
    for i, _, h in rows:
        b = (h or "").encode()
        top[b] = max(top.get(b, -1), -1 if i is None else i)
    for i, _, h in rows:
        b = (h or "").encode()
        revisit = len(b) >= least and top[b] != i
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response",
                    top[b] if revisit else None))
    return sorted(out)


ROWS = [(1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (9, None, "<p>x</p>"), (3, "", ""), (4, "u\r\nv", None), (5, "é", "ü" * 5000),
        (6, "http://c", "line\r\n\r\nWARC/1.1\r\n")] + [(100 + i, f"h{i}", "same") for i in range(50)]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, tmp_path, least):
    df = spark.createDataFrame([(*r, 0, "z", "z") for r in ROWS], PAGE).repartition(4)
    folder = str(tmp_path / "w")
    W.write(df, folder, revisit_min_bytes=least)
    got = W.read(spark, folder).collect()
    assert sorted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == expected(ROWS, least)
    assert spark.read.parquet(f"{folder}/payloads").count() == len({h or "" for _, _, h in ROWS})
    urls = {r["page_id"]: r["url"] for r in got}
    assert urls[4] == "u%0D%0Av" and urls[9] == "" and urls[5] == "é"


def test_records_are_well_formed(spark, tmp_path):
    df = spark.createDataFrame([(*r, 0, "z", "z") for r in ROWS], PAGE)
    W.write(df, str(tmp_path / "w"))
    for r in W.records(spark, str(tmp_path / "w")).collect():
        raw = bytes(r["record"])
        head, rest = raw.split(b"\r\n\r\n", 1)
        assert head.startswith(b"WARC/1.1\r\n")
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        n = int(fields[b"Content-Length"])
        assert rest[n:] == b"\r\n\r\n" and rest.startswith(b"HTTP/1.1 200 OK\r\n")
        body = rest[:n].split(b"\r\n\r\n", 1)[1]
        if fields[b"WARC-Type"] == b"response":
            assert base64.b32encode(hashlib.sha1(body).digest()) == fields[b"WARC-Payload-Digest"].removeprefix(b"sha1:")
        else:
            assert body == b"" and fields[b"WARC-Refers-To"].startswith(b"<urn:page:")


def test_damaged_payload_is_noticed(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "abc", 0, "", "")], PAGE)
    W.write(df, str(tmp_path / "w"))
    bad = spark.read.parquet(str(tmp_path / "w/payloads")).selectExpr("address", "cast('abd' as binary) as payload")
    W_folder = tmp_path / "x"
    spark.read.parquet(str(tmp_path / "w/headers")).write.parquet(str(W_folder / "headers"))
    bad.write.parquet(str(W_folder / "payloads"))
    with pytest.raises(Exception, match="does not match"):
        W.read(spark, str(W_folder)).collect()


def test_null_ids_repeats_and_empty_table(spark, tmp_path):
    df = spark.createDataFrame([(None, "u", "a", 0, "", ""), (3, "u", "a", 0, "", ""), (3, "u", "a", 0, "", ""), (None, "v", "b", 0, "", "")], PAGE)
    W.write(df, str(tmp_path / "w"))
    got = sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in W.read(spark, str(tmp_path / "w")).collect())
    assert got == [("3", "response", None), ("3", "revisit", 3), ("None", "response", None), ("None", "revisit", 3)]
    W.write(df.limit(0), str(tmp_path / "e"))
    assert W.read(spark, str(tmp_path / "e")).count() == 0


def test_reading_back_shuffles_no_payload(spark, tmp_path):
    df = spark.createDataFrame([(*r, 0, "z", "z") for r in ROWS], PAGE)
    W.write(df, str(tmp_path / "w"))
    plan = W.read(spark, str(tmp_path / "w"))._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join ", 1)
    assert "payload#" not in above  # the join passes on what was taken from a payload, not the payload
    right = [x for x in below.splitlines() if x.lstrip(" :+-").startswith("Project") and " AS digest#" in x]
    assert right and not re.search(r"[\[ ]payload#\d+[,\]]", right[0])
