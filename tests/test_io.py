"""Sources and sinks."""

import hashlib

import pytest

from churnlab.sources import io


def test_read_missing_table_names_it(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="customer_features"):
        io.read_table(spark, str(tmp_path), "customer_features", hint="Build features first.")


def test_write_read_roundtrip_and_resolver(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "customer_id long, v string")
    full = tmp_path / "full"
    demo = tmp_path / "demo"
    io.write_table(df, io.table_path(str(demo), "features"))
    io.write_table(df, io.table_path(str(demo), "scores"))
    root, tables = io.resolve_dataset(spark, [str(full), str(demo)], ["features", "scores"], ["explanations"])
    assert root == str(demo) and set(tables) == {"features", "scores"}
    io.write_table(df, io.table_path(str(full), "features"))
    root, _ = io.resolve_dataset(spark, [str(full), str(demo)], ["features", "scores"])
    assert root == str(demo)  # full set incomplete -> demo set
    with pytest.raises(FileNotFoundError):
        io.resolve_dataset(spark, [str(tmp_path / "none")], ["features"])


def test_file_fingerprints(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"hello")
    (tmp_path / "b.bin").write_bytes(b"world!")
    rows = {r["path"].rsplit("/", 1)[-1]: r for r in io.file_fingerprints(spark, str(tmp_path / "*.bin")).collect()}
    assert rows["a.bin"]["sha256"] == hashlib.sha256(b"hello").hexdigest()
    assert rows["b.bin"]["length"] == 6


def test_json_report(spark, tmp_path):
    frame = io.report_frame(spark, {"b": 2, "a": {"y": 1}})
    assert [r["key"] for r in frame.collect()] == ["a", "b"]
    io.write_json_report(frame, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 2


def test_fingerprints_stream_files_in_chunks(spark, tmp_path, monkeypatch):
    """Files longer than a chunk, empty files, names with blanks."""
    contents = {"empty.bin": b"", "two words.bin": bytes(range(256)) * 9000, "one.bin": b"x" * (9 << 20)}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    found = io.file_fingerprints(spark, str(tmp_path / "*.bin"))
    got = {r["path"].rsplit("/", 1)[-1].replace("%20", " "): (r["length"], r["sha256"]) for r in found.collect()}
    assert got == {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in contents.items() if d}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and "MapInPandas" in plan
    # a store that Arrow does not know goes through Spark's reader
    monkeypatch.setattr(io, "_ARROW_SCHEMES", {})
    again = {r["sha256"] for r in io.file_fingerprints(spark, str(tmp_path / "*.bin")).collect()}
    assert again == {sha for _, sha in got.values()}
