"""The line log: offsets by file, restarts in mid-file, a bound for each batch, half-written lines."""

import io
import os

import pytest

from encore.session import scratch_path
from encore.sources.line_log import LineLogReader, last_line_end, line_log
from encore.streaming import process


def _folder(spark, name):
    path = scratch_path(spark, name).removeprefix("file:")
    os.makedirs(path)
    return path


def _append(folder, name, data):
    with open(f"{folder}/{name}", "ab") as f:
        f.write(data)


def _run(spark, folder, out, checkpoint, **bounds):
    process.run_stream(line_log(spark, folder, **bounds),
                       process.batch_dir_writer(out, lambda df, _id: df), checkpoint)


def _values(spark, out):
    return sorted(r.value for r in spark.read.parquet(out).collect())


def test_each_line_once_over_restarts_and_half_lines(spark):
    folder, out, ckpt = _folder(spark, "log"), scratch_path(spark, "log_out"), scratch_path(spark, "log_ckpt")
    _append(folder, "a.txt", b"1\n2\r\n\nhal")
    _append(folder, "b.txt", "é\nlast".encode())
    _append(folder, "_hidden", b"no\n")
    _append(folder, "c.parquet", b"no\n")
    _run(spark, folder, out, ckpt)
    assert _values(spark, out) == ["", "1", "2", "é"]
    _append(folder, "a.txt", b"f\n3\n")
    _append(folder, "c.txt", b"new\xff\n")
    _run(spark, folder, out, ckpt)
    _run(spark, folder, out, ckpt)  # nothing new
    rows = spark.read.parquet(out)
    assert _values(spark, out) == ["", "1", "2", "3", "half", "new�", "é"]
    assert sorted(r.batch_id for r in rows.select("batch_id").distinct().collect()) == [0, 1]


def test_the_bound_holds_and_a_restart_goes_on_in_mid_file(spark):
    folder, out, ckpt = _folder(spark, "log"), scratch_path(spark, "log_out"), scratch_path(spark, "log_ckpt")
    lines = [f"{i:06d}" for i in range(3000)]  # 7 bytes each with the line feed
    for part in range(3):
        _append(folder, f"part-{part}", "".join(x + "\n" for x in lines[part * 1000:(part + 1) * 1000]).encode())
    progress = _folder(spark, "progress")
    for _ in range(3):  # each run takes one bound: half a file and a bit
        _run(spark, folder, out, ckpt, max_bytes=4000, progress=progress)
    sizes = {r.batch_id: r["count"] for r in spark.read.parquet(out).groupBy("batch_id").count().collect()}
    assert sizes == {0: 571, 1: 571, 2: 571}
    assert _values(spark, out) == lines[:3 * 571]
    stream = line_log(spark, folder, max_bytes=4000, progress=progress)
    query = (stream.writeStream.foreachBatch(process.batch_dir_writer(out, lambda df, _id: df))
             .option("checkpointLocation", ckpt).trigger(processingTime="0 seconds").start())
    query.processAllAvailable()
    query.stop()
    rows = spark.read.parquet(out)
    assert _values(spark, out) == lines
    assert max(r["count"] for r in rows.groupBy("batch_id").count().collect()) <= 571
    assert len(os.listdir(progress)) == 3


@pytest.mark.parametrize("split", [1, 5, 7, 1000])
def test_slices_hold_each_line_once(tmp_path, split):
    data = b"one\n\ntwenty-two letters long\nx\r\ny\nopen"
    (tmp_path / "f.txt").write_bytes(data)
    reader = LineLogReader(str(tmp_path), split_bytes=split)
    end = reader.latestOffset()
    assert end == {"f.txt": len(data) - 4}
    got = [v for part in reader.partitions({}, end) for batch in reader.read(part) for v in batch.column(0).to_pylist()]
    assert got == ["one", "", "twenty-two letters long", "x", "y"]
    middle = [v for part in reader.partitions({"f.txt": 5}, end) for b in reader.read(part) for v in b.column(0).to_pylist()]
    assert middle == got[2:]


def test_a_long_line_comes_alone_and_a_shrunk_file_is_an_error(tmp_path):
    (tmp_path / "a").write_bytes(b"x\n" + b"y" * 50 + b"\nz\n")
    notes = tmp_path / "_notes"
    options = (str(tmp_path), 10, str(notes))
    assert LineLogReader(*options).latestOffset() == {"a": 2}
    assert LineLogReader(*options).latestOffset() == {"a": 53}
    (notes / "9").write_bytes(b'{"a": 5')  # cut short by a crash
    assert LineLogReader(*options).latestOffset() == {"a": 55}
    (tmp_path / "a").write_bytes(b"x\n")
    with pytest.raises(ValueError, match="shrunk"):
        LineLogReader(*options).latestOffset()
    os.remove(tmp_path / "a")
    assert LineLogReader(*options).latestOffset() == {}


def test_line_ends():
    data = io.BytesIO(b"ab\ncdef\ng")
    assert [last_line_end(data, 0, 9, n) for n in (1, 3, 7, 8, None)] == [3, 3, 3, 8, 8]
    assert last_line_end(data, 8, 9, None) == 8


def test_a_bound_needs_a_progress_folder(spark):
    with pytest.raises(ValueError, match="progress"):
        line_log(spark, "/tmp", max_bytes=10)
