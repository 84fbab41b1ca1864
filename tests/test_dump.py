from __future__ import annotations

import os

import pytest
from conftest import rows

from popstats.sources import dump
from popstats.streaming.ingest import parsed_stream, read_dump_stream

T = "\t"
COLS = ("uid", "a", "b")


def _lines(spark):
    return spark.createDataFrame([
        ("uid\ta\tb\tmisc",),          # header
        ("123456\tx\ty\t<NULL>",),     # good
        ("123457\t\t\t<NULL>",),       # good, empty fields kept
        ('123458\t"q"\ty\t<NULL>',),   # quote characters are data
        ("123459\tx\t<NULL>",),        # too few fields
        ("123460\tx\ty\tz\t<NULL>",),  # too many fields
        ("12345\tx\ty\t<NULL>",),      # five digits only
        ("",),                         # empty line
    ], "value string")


def test_dump_lines_pattern(spark):
    kept = [r.value[:6] for r in dump.dump_lines(_lines(spark)).collect()]
    assert sorted(kept) == ["123456", "123457", "123458", "123459", "123460"]


def test_dump_parse_keeps_empty_fields(spark):
    out = dump.dump_parse(_lines(spark), columns=COLS)
    assert out.columns == list(COLS)
    assert rows(out) == [("123456", "x", "y"), ("123457", "", ""), ("123458", '"q"', "y")]


def test_dump_rejects_reasons(spark):
    out = {r.value: (r.n_parts, r.reason) for r in dump.dump_rejects(_lines(spark), columns=COLS).collect()}
    assert out["uid\ta\tb\tmisc"] == (4, "no_uid")
    assert out["123459\tx\t<NULL>"] == (3, "field_count")
    assert out["123460\tx\ty\tz\t<NULL>"] == (5, "field_count")
    assert out["12345\tx\ty\t<NULL>"] == (4, "no_uid")
    assert out[""] == (1, "no_uid")
    assert len(out) == 5


def test_parse_plus_rejects_cover_every_line(spark):
    lines = _lines(spark)
    assert dump.dump_parse(lines, columns=COLS).count() + dump.dump_rejects(lines, columns=COLS).count() \
        == lines.count()


def test_reference_layout_has_sixteen_columns(spark):
    line = T.join(["000001"] + [f"f{i}" for i in range(2, 17)] + ["<NULL>"])
    out = dump.dump_parse(spark.createDataFrame([(line,)], "value string"))
    assert len(out.columns) == 16 and out.columns[8] == "date_of_birth"
    assert out.first().door_or_entrance_number == "f16"


def test_file_round_trip(spark, scratch):
    src = spark.createDataFrame([("100001", "ann", None), ("100002", "bob", "x")], "uid string, a string, b string")
    path = os.path.join(scratch, "dump")
    dump.format_dump(src, COLS).write.text(path)
    back = dump.dump_parse(dump.read_dump(spark, path), columns=COLS)
    assert rows(back) == [("100001", "ann", ""), ("100002", "bob", "x")]


def test_streaming_ingest_matches_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    with open(os.path.join(src, "part1.txt"), "w") as f:
        f.write("header\n100001\tx\t1/2/1950\t<NULL>\n100002\ty\t31/2/1950\t<NULL>\n100003\tbad\n")
    cols = ("uid", "name", "date_of_birth")
    stream = parsed_stream(read_dump_stream(spark, src), columns=cols, date_column="date_of_birth")
    q = stream.writeStream.format("memory").queryName("ingest_test").outputMode("append").start()
    try:
        q.processAllAvailable()
        got = rows(spark.table("ingest_test"), "uid", "date_status")
    finally:
        q.stop()
    assert got == [("100001", "ok"), ("100002", "impossible")]


def test_start_ingest_exactly_once_to_parquet(spark, scratch):
    from popstats.streaming.ingest import start_ingest

    src, out, ckpt = (os.path.join(scratch, d) for d in ("src", "out", "ckpt"))
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("100001\tx\t1/2/1950\t<NULL>\n100002\ty\tbad\t<NULL>\n")
    cols = ("uid", "name", "date_of_birth")
    q = start_ingest(spark, src, out, columns=cols, date_column="date_of_birth", checkpoint=ckpt,
                     trigger_once=True, query_name="ingest_once")
    q.awaitTermination(120)
    first = rows(spark.read.parquet(out), "uid", "date_status")
    assert first == [("100001", "ok"), ("100002", "malformed")]  # marked, not dropped
    # a restart with the same checkpoint reads only the new file
    with open(os.path.join(src, "b.txt"), "w") as f:
        f.write("100003\tz\t31/2/1950\t<NULL>\n")
    q = start_ingest(spark, src, out, columns=cols, date_column="date_of_birth", checkpoint=ckpt,
                     trigger_once=True, query_name="ingest_once")
    q.awaitTermination(120)
    assert rows(spark.read.parquet(out), "uid", "date_status") == [
        ("100001", "ok"), ("100002", "malformed"), ("100003", "impossible")]


def test_start_rejects_keeps_what_ingest_leaves_out(spark, scratch):
    from popstats.streaming.ingest import start_rejects

    src, out, ckpt = (os.path.join(scratch, d) for d in ("src2", "out2", "ckpt2"))
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("header\n100001\tx\t1/2/1950\t<NULL>\n100002\tshort\n")
    q = start_rejects(spark, src, out, columns=("uid", "name", "date_of_birth"), checkpoint=ckpt, trigger_once=True)
    q.awaitTermination(120)
    assert rows(spark.read.parquet(out), "value", "reason") == [("100002\tshort", "field_count"), ("header", "no_uid")]


def test_rejects_stream_on_static_lines(spark):
    from popstats.streaming.ingest import rejects_stream

    out = {r.value: r.reason for r in rejects_stream(_lines(spark), columns=COLS).collect()}
    assert out["123459\tx\t<NULL>"] == "field_count" and out["uid\ta\tb\tmisc"] == "no_uid"


def test_a_dump_of_text_files_is_read_back(spark, scratch):
    lines = spark.createDataFrame([("000001\ta\t<NULL>",), ("-- footer",), ("000002\ta",)], "value string").repartition(2)
    for k, compression in enumerate((None, "gzip")):
        dump.write_dump(lines, f"{scratch}/{k}", compression=compression)
        back = dump.read_dump(spark, f"{scratch}/{k}", file_column="file")
        assert sorted(r.value for r in back.collect()) == sorted(r.value for r in lines.collect())
        assert all(f"/{k}/part-" in r.file for r in back.collect())
        assert [r.uid for r in dump.dump_parse(back, columns=("uid", "x")).collect()] == ["000001"]
        assert sorted(r.reason for r in dump.dump_rejects(back, columns=("uid", "x")).collect()) == ["field_count", "no_uid"]
    with pytest.raises(Exception, match="line break"):
        dump.write_dump(spark.createDataFrame([("a\nb",)], "value string"), f"{scratch}/bad")
    from popstats.sources.files import remove

    remove(spark, f"{scratch}/0")
    remove(spark, f"{scratch}/0")
    assert not os.path.exists(f"{scratch}/0")
