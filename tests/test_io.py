import glob
import lzma
import os

import pyarrow as pa
import pytest
from conftest import SF, item, sentences

from tidewell.model import STREAM_ITEM
from tidewell.operators import spans
from tidewell.plans import fixtures as fx
from tidewell.sources import chunk_source, chunks, manifest, scan, sinks, tsv
from tidewell.streaming import counts


def test_manifest_skips_comments_blanks_and_marks(spark, tmp_path):
    path = tmp_path / "list.txt"
    path.write_text("﻿# first\n\n  documents.parquet \n#x\npages.parquet\n", encoding="utf-8")
    assert {r.path for r in manifest.read_manifest(spark, str(path)).collect()} == {"documents.parquet", "pages.parquet"}


def test_missing_and_corrupt_files_are_told_and_skipped(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "good"))
    good = glob.glob(str(tmp_path / "good" / "*.parquet"))[0]
    bad = tmp_path / "bad.parquet"
    bad.write_bytes(b"not parquet at all")
    paths = spark.createDataFrame([(good,), (str(bad),), (str(tmp_path / "gone.parquet"),)], "path string")
    told = {os.path.basename(r.path): r.error.split(":")[0] for r in manifest.quarantine(spark, paths).collect()}
    assert told == {"bad.parquet": "unreadable", "gone.parquet": "missing"}
    assert manifest.scan_manifest(spark, paths, "id long", tolerant=True).count() == 5
    with pytest.raises(Exception, match="gone.parquet|not a Parquet|CANNOT_READ"):
        manifest.scan_manifest(spark, paths, "id long").count()


def test_items_are_read_with_their_chunk(spark, corpus, tmp_path):
    path = str(tmp_path / "items")
    corpus(item("a", taggers={"serif": sentences("Bob/PER x")}), item("b")).drop("src_file").coalesce(1).write.parquet(path)
    back = scan.read_items(spark, path)
    assert {f.name for f in back.schema} == {f.name for f in STREAM_ITEM}
    rows = back.collect()
    assert len(rows) == 2 and all(r.src_file.endswith(".parquet") and "/" not in r.src_file for r in rows)
    assert [r.entity for r in spans.ne_doc_counts(back).collect()] == ["Bob "]


def test_xz_plain_and_broken_chunks(spark, tmp_path):
    lines = b'{"id": 1, "t": "a"}\n{"id": 2, "t": "b\\u00e9"}\n'
    (tmp_path / "one.json.xz").write_bytes(lzma.compress(lines))
    (tmp_path / "two.json").write_bytes(lines.replace(b'"id": 1', b'"id": 3').rstrip(b"\n"))
    (tmp_path / "bad.json.xz").write_bytes(b"no xz")
    with pytest.raises(Exception, match="cannot be read to its end"):
        chunks.read_chunks(spark, str(tmp_path), "id long, t string").collect()
    rows = chunks.read_chunks(spark, str(tmp_path), "id long, t string", strict=False).collect()
    assert sorted((r.chunk, r.id, r.t) for r in rows) == [
        ("one.json.xz", 1, "a"), ("one.json.xz", 2, "bé"), ("two.json", 2, "bé"), ("two.json", 3, "a")]
    assert [(r.chunk, r.lines) for r in chunks.broken_chunks(spark, str(tmp_path)).collect()] == [("bad.json.xz", 0)]


def test_damaged_data_pages_are_reported_and_left_out(spark, tmp_path):
    spark.range(200_000).selectExpr("id", "md5(cast(id as string)) t").coalesce(1).write.parquet(str(tmp_path / "p"))
    file = glob.glob(str(tmp_path / "p" / "*.parquet"))[0]
    data = bytearray(open(file, "rb").read())
    middle = len(data) // 2
    data[middle:middle + 200_000] = bytes(200_000)
    open(str(tmp_path / "damaged.parquet"), "wb").write(data)
    paths = spark.createDataFrame([(file,), (str(tmp_path / "damaged.parquet"),)], "path string")
    report = {os.path.basename(r.path): r for r in manifest.file_report(spark, paths).collect()}
    good, bad = report[os.path.basename(file)], report["damaged.parquet"]
    assert (good.expected, good.rows, good.error) == (200_000, 200_000, None)
    assert bad.error and (bad.expected or 0) != bad.rows
    assert manifest.scan_manifest(spark, paths, "id long", tolerant=True).count() == 200_000


def test_lines_without_a_record_are_reported(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b'{"id": 1}\n\noops\n{"id": 2\n{"id": 3}')
    assert sorted(r.id for r in chunks.read_chunks(spark, str(tmp_path), "id long").collect()) == [1, 3]
    told = chunks.rejected_lines(spark, str(tmp_path), "id long").collect()
    assert sorted(map(tuple, told)) == [("a.json", 3, "oops"), ("a.json", 4, '{"id": 2')]


def test_records_without_a_chunk_are_written(spark, tmp_path):
    df = spark.createDataFrame([("x", 1), (None, 2), (None, 3)], "c string, id long")
    chunks.save_chunks(df, str(tmp_path / "c"), "c")
    assert sorted(r.id for r in chunks.read_chunks(spark, str(tmp_path / "c"), "id long").collect()) == [1, 2, 3]


def test_a_key_is_whole_in_one_file_and_counts_are_kept(spark, tmp_path):
    df = spark.range(400).selectExpr("cast(if(id < 300, 0, id % 5) as string) k", "id v")
    sinks.sink(df, str(tmp_path / "k"), key="k", partitions=4)
    files = [{r.k for r in spark.read.parquet(f).collect()} for f in glob.glob(str(tmp_path / "k" / "*.parquet"))]
    assert sum(map(len, files)) == 5
    sinks.sink(df, str(tmp_path / "s"), key="k", partitions=4, spread=4)
    assert sum("0" in {r.k for r in spark.read.parquet(f).collect()} for f in glob.glob(str(tmp_path / "s" / "*.parquet"))) > 1
    sinks.sink(df.coalesce(1), str(tmp_path / "n"), partitions=6)
    assert len(glob.glob(str(tmp_path / "n" / "*.parquet"))) == 6


def test_chunks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("x", i, "é\n\"" * i) for i in range(50)] + [("y", 99, None)], "c string, id long, t string")
    chunks.save_chunks(df, str(tmp_path / "c"), "c")
    assert glob.glob(str(tmp_path / "c" / "x-*.json.xz")) and glob.glob(str(tmp_path / "c" / "y-*.json.xz"))
    back = chunks.read_chunks(spark, str(tmp_path / "c"), "id long, t string")
    assert {(r.id, r.t) for r in back.collect()} == {(r.id, r.t) for r in df.collect()}


def test_tsv_lines_keep_every_text(spark, tmp_path):
    df = spark.createDataFrame([("1", 'tab\there\nline "q" \\ <&>é'), ("2", ""), ("3", "plain")], "doc_id string, text string")
    sinks.sink(tsv.encode_lines(df, "doc_id", "text"), str(tmp_path / "t"), fmt="text", compression="bz2")
    assert glob.glob(str(tmp_path / "t" / "*.bz2"))
    assert {tuple(r) for r in tsv.read_lines(spark, str(tmp_path / "t")).collect()} == {tuple(r) for r in df.collect()}
    assert [r.value for r in tsv.plain_lines(spark.createDataFrame([(20240101, 3)], "d int, n int"), "d", "n").collect()] == ["20240101\t3"]


def test_sink_options(spark, tmp_path):
    df = spark.range(100).selectExpr("cast(id % 7 as string) k", "id v")
    path = str(tmp_path / "out")
    sinks.sink(df, path, key="k", partitions=3, compression="gz")
    files = glob.glob(path + "/*.parquet")
    assert 1 <= len(files) <= 3 and all(".gz." in f for f in files)
    for f in files:
        keys = [r.k for r in spark.read.parquet(f).collect()]
        assert keys == sorted(keys)
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.sink(df, path)
    sinks.sink(df.limit(5), path, overwrite=True)
    assert spark.read.parquet(path).count() == 5
    sinks.sink(df, str(tmp_path / "by"), by="k", key="v")
    assert len(glob.glob(str(tmp_path / "by" / "k=*"))) == 7
    assert spark.read.parquet(str(tmp_path / "by")).count() == 100


def test_unknown_codecs_are_errors(spark, tmp_path):
    for codec in ("lzo", "rar"):
        with pytest.raises(ValueError, match=codec):
            sinks.sink(spark.range(1), str(tmp_path / codec), compression=codec)


def test_given_tables_pair_up(spark):
    assert fx.items(spark, SF).count() == fx.table(spark, SF, "documents").count()


def test_only_committed_chunks_count(spark, tmp_path):
    path = str(tmp_path / "c")
    good = spark.createDataFrame([("x", 1), ("y", 2)], "c string, id long")
    chunks.save_chunks(good, path, "c", compress=False)
    failing = spark.range(0, 4, 1, 4).selectExpr("'z' c", "if(id = 3, cast(raise_error('no') as long), id) id")
    with pytest.raises(Exception, match="no"):
        chunks.save_chunks(failing, path, "c")
    assert sorted(r.id for r in chunks.read_chunks(spark, path, "id long").collect()) == [1, 2]
    chunks.save_chunks(good.filter("id = 2"), path, "c", overwrite=True)
    assert [r.id for r in chunks.read_chunks(spark, path, "id long").collect()] == [2]
    assert all(os.path.basename(f).startswith("y-") for f in glob.glob(path + "/*.json*"))


def test_a_stream_takes_up_new_chunks(spark, tmp_path):
    path, out = str(tmp_path / "c"), str(tmp_path / "out")
    for ids in (range(5), range(5, 8), ()):
        if ids:
            chunks.save_chunks(spark.createDataFrame([("s", i, "t" * i) for i in ids], "c string, id long, text string"), path, "c")
        counts.run_chunks(chunks.stream_chunks(spark, path, "id long, text string"), out)
    assert [tuple(r) for r in counts.chunk_totals(spark, out).collect()] == [("s", 8, 28)]


def test_chunks_are_compressed_at_the_quick_level(tmp_path, monkeypatch):
    """The default level took nine tenths of the time of writing and reading chunks."""
    levels, plain = [], lzma.open
    monkeypatch.setattr(chunk_source.lzma, "open", lambda *a, **more: levels.append(more.get("preset")) or plain(*a, **more))
    writer = chunk_source.ChunkWriter({"path": str(tmp_path)}, False)
    lines = [f"line {i} é" for i in range(1000)]
    writer.commit([writer.write(iter([pa.RecordBatch.from_arrays(
        [pa.array(["c"] * 1000), pa.array([0] * 1000, pa.int64()), pa.array(lines)], schema=chunk_source._ARROW)]))])
    [(_, name)] = chunk_source.ChunkReader({"path": str(tmp_path)}).listed()
    assert levels == [chunk_source.LEVEL] and chunk_source.LEVEL <= 1
    assert [line.decode() for line in chunk_source.file_lines(*chunk_source.open_folder(name))] == lines
