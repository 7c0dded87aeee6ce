"""Listing in tasks, versions of a manifest, parts that count only when complete."""

import os
import time

import pytest

from clipframe.plans import jobs
from clipframe.sources import commits, manifest
from clipframe.sources.manifest import Manifest, list_files


@pytest.fixture
def tree(tmp_path):
    names = ["a.wav", "_b.wav", ".c.wav", "zero.wav", "UPPER.WAV", "note.txt", "_sub/d.wav",
             ".hidden/e.wav", "deep/er/and/deeper/f g%20é.wav", "none.wav/h.wav", "empty/x.txt"]
    for i, name in enumerate(names):
        path = tmp_path / "tree" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"" if name == "zero.wav" else b"x" * (i + 1))
    return tmp_path / "tree"


def names_of(df, root):
    return sorted((os.path.relpath(r.path.removeprefix("file:"), root), r.length)
                  for r in df.collect())


ALL = sorted([("a.wav", 1), ("_b.wav", 2), ("zero.wav", 0), ("_sub/d.wav", 7),
              ("deep/er/and/deeper/f g%20é.wav", 9), ("none.wav/h.wav", 10)])


def test_listing(spark, tree):
    assert names_of(list_files(spark, str(tree)), tree) == ALL
    assert names_of(list_files(spark, [str(tree), f"file:{tree}/deep"]), tree) == ALL
    assert names_of(list_files(spark, f"{tree}/_sub/d.wav"), tree) == [("_sub/d.wav", 7)]
    assert names_of(list_files(spark, f"{tree}/empty"), tree) == []
    assert [n for n, _ in names_of(list_files(spark, str(tree), "[a-m]*.txt"), tree)] == []
    assert [n for n, _ in names_of(list_files(spark, str(tree), "*.txt"), tree)] == [
        "empty/x.txt", "note.txt"]
    with pytest.raises(Exception, match="no such file or folder"):
        list_files(spark, f"{tree}/missing").collect()


def test_a_loop_of_links_ends(spark, tree, monkeypatch):
    (tree / "deep" / "loop").symlink_to(tree, target_is_directory=True)
    monkeypatch.setattr(manifest, "MAX_LEVELS", 8)
    with pytest.raises(RecursionError):
        list_files(spark, str(tree))


def test_listed_files_are_read(spark, tree):
    rows = manifest.read_listed(list_files(spark, str(tree)), max_bytes=8).collect()
    assert sorted(len(r.content) for r in rows if r.content is not None) == [0, 1, 2, 7]
    assert sorted(r.length for r in rows if r.load_error == "file too large") == [9, 10]
    listed = manifest.pin(list_files(spark, str(tree)))
    (tree / "a.wav").unlink()
    gone = manifest.read_listed(listed).filter("load_error is not null").collect()
    assert [(os.path.basename(r.path), r.load_error) for r in gone] == [
        ("a.wav", "cannot read file: FileNotFoundError")]


def test_lines_end_as_in_the_text_source(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("one\r\ntwo\n\nfour\rfive é\n".encode() + b"\xff bad")
    got = manifest.read_lines(list_files(spark, str(tmp_path), "*.txt")).orderBy("line_id").collect()
    want = [r.value for r in spark.read.text(str(tmp_path / "a.txt")).collect()]
    assert [r.value for r in got] == want and [r.line_id for r in got] == list(range(len(want)))


def test_versions(spark, tree, tmp_path):
    known = Manifest(spark, str(tmp_path / "manifest"))
    assert known.versions() == [] and known.files().count() == 0
    assert known.refresh(str(tree)) == 1 and names_of(known.files(), tree) == ALL
    assert known.refresh(str(tree)) == 1 and known.fresh(1).count() == 0
    (tree / "new.wav").write_bytes(b"new")
    (tree / "a.wav").write_bytes(b"longer")
    (tree / "_b.wav").unlink()
    os.utime(tree / "zero.wav", (time.time() + 9, time.time() + 9))
    assert known.refresh(str(tree)) == 2
    assert sorted((os.path.basename(r.path), r.change) for r in known.changes(1).collect()) == [
        ("_b.wav", "removed"), ("a.wav", "changed"), ("new.wav", "added"), ("zero.wav", "changed")]
    assert [n for n, _ in names_of(known.fresh(1), tree)] == ["a.wav", "new.wav", "zero.wav"]
    assert names_of(known.files(1), tree) == ALL
    assert ("_b.wav", 2) not in names_of(known.files(), tree)
    (tree / "_b.wav").write_bytes(b"back")
    assert known.refresh(str(tree)) == 3 and ("_b.wav", 4) in names_of(known.files(), tree)


def test_a_killed_run_leaves_no_version(spark, tree, tmp_path):
    folder = str(tmp_path / "manifest")
    half = commits.stage(spark, folder, "version=1")
    spark.range(3).write.parquet(f"{half}/files")  # and then the run is lost
    known = Manifest(spark, folder)
    assert known.versions() == []
    assert known.refresh(str(tree)) == 1 and names_of(known.files(), tree) == ALL


def test_parts(spark, tmp_path):
    folder = str(tmp_path / "parts")
    assert commits.complete(spark, folder) == []
    for key, rows in (("run=b", 2), ("run=a", 3), ("run=b", 4)):
        part = commits.stage(spark, folder, key)
        assert not commits.is_complete(spark, part)
        spark.range(rows).write.parquet(f"{part}/rows")
        time.sleep(0.05)
        commits.finish(spark, part)
    assert commits.complete(spark, folder) == ["run=a", "run=b"]
    assert spark.read.parquet(f"{folder}/run=b/rows").count() == 4
    with pytest.raises(ValueError):
        commits.stage(spark, folder, "../x")


def test_jobs_over_names_and_folders(spark, tmp_path, wav_cases):
    for name in ("mono16", "stereo8k", "empty", "junk"):
        (tmp_path / f"_{name}.wav").write_bytes(wav_cases[name])
    known = Manifest(spark, str(tmp_path / ".manifest"))
    known.refresh(str(tmp_path))
    for source in (str(tmp_path), known.files(), known.fresh(0)):
        heads = {os.path.basename(r.path): r.error for r in jobs.clip_headers(spark, source).collect()}
        assert heads == {"_mono16.wav": None, "_stereo8k.wav": None,
                         "_empty.wav": "not a RIFF/WAVE file", "_junk.wav": "not a RIFF/WAVE file"}
        got = jobs.mean_dbfs(spark, source).first()
        assert (got.n_clips, got.n_rejected) == (2, 2)
