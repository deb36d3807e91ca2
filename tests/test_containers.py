"""The container data source: field scan, slices, stride samples, stream."""

import os
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from fieldcat.operators import sampling
from fieldcat.schemas import FIELDS
from fieldcat.sources import containers as C

KEY = "/measurement/instrument/time_stamp"


def field(path, key, kind="i", s=None, i=None, d=None, shape=None, maxshape=None):
    values = s if s is not None else i if i is not None else d
    shape = [len(values or [])] if shape is None else shape
    return (path, key, kind, shape, maxshape or shape, s, i, d)


def staged(spark, tmp_path, rows, chunk=None):
    root = str(tmp_path / "c")
    C.write_containers(spark.createDataFrame(rows, FIELDS), root, chunk)
    return root


def rewrite(path, drop=(), spoil=()):
    """The archive at ``path`` without some members, others turned to noise."""
    with zipfile.ZipFile(path) as z:
        members = {n: z.read(n) for n in z.namelist() if n not in drop}
    with zipfile.ZipFile(path, "w") as z:
        for n, data in members.items():
            z.writestr(n, b"noise" if n in spoil else data)


ROWS = [field("/a/x.h5", "/k/text", "S", s=["é", "", None], shape=[3], maxshape=[None]), field("/a/x.h5", "/k/one", d=[1.5], kind="f", shape=[]),
        field("/a/x.h5", "/k/ints", i=[2**60, None, -1]), field("/a/y.h5", "/k/none", "f"), field("/a/y.h5", "/k/nan", "f", d=[float("inf"), 0.0]),
        field("/b/z.h5", "/k/empty", "i", i=[]), field("/b/z.h5", "/k/long", "i", i=list(range(1000)))]


@pytest.mark.parametrize("chunk", [None, 64])
def test_what_is_written_is_read(spark, tmp_path, chunk):
    got = C.read_containers(spark, staged(spark, tmp_path, ROWS, chunk)).collect()
    assert sorted(tuple(r) for r in got) == sorted(ROWS)


def test_only_what_is_asked_for_is_decoded(spark, tmp_path):
    root = staged(spark, tmp_path, ROWS)
    rewrite(f"{root}/a/x.h5.npz", spoil=["k/text.npy", "k/text@", "k/one.npy"])
    assert [tuple(r) for r in C.read_containers(spark, root, ["/k/ints"]).collect()] == [ROWS[2]]
    assert C.read_containers(spark, root, ["/k/text"]).collect()[0].kind is None  # unreadable: a row of nulls
    shapes = C._Scan(spark.createDataFrame([], "file_path string, key string, shape array<long>").schema, {"path": root, "keys": '["/k/one"]'})
    assert [r for b in shapes.decode(C.Slice([f"{root}/a/x.h5.npz"])) for r in b.to_pylist()] == [{"file_path": "/a/x.h5", "key": "/k/one", "shape": []}]
    # two scans with different keys in one plan keep their own keys
    both = C.read_containers(spark, root, ["/k/ints"]).unionAll(C.read_containers(spark, root, ["/k/long"])).groupBy("key").count()
    assert sorted(map(tuple, both.collect())) == [("/k/ints", 1), ("/k/long", 1)]


def test_unreadable_files_have_no_rows(spark, tmp_path):
    root = staged(spark, tmp_path, ROWS)
    (tmp_path / "c" / "bad.npz").write_bytes(b"no archive")
    (tmp_path / "c" / "empty.npz").write_bytes(b"")
    np.savez(str(tmp_path / "c" / "plain.npz"), **{"g/a": np.arange(6, dtype=np.int16).reshape(2, 3), "g/s": np.array(["u", "v"])})
    got = {r.key: r for r in C.read_containers(spark, root).where("file_path = '/plain'").collect()}
    assert (got["/g/a"].int_values, got["/g/a"].shape, got["/g/s"].str_values) == ([0, 1, 2, 3, 4, 5], [2, 3], ["u", "v"])
    assert C.read_containers(spark, root).count() == len(ROWS) + 2
    assert C.read_containers(spark, str(tmp_path / "nowhere")).count() == 0


def test_slices_hold_bytes_not_files(tmp_path):
    for i, n in enumerate([10, 10, 10, 5000, 10]):
        np.savez(str(tmp_path / f"f{i}.npz"), **{f"k{j}": np.zeros(n) for j in range(4)})
    scan = C._Scan(FIELDS, {"path": str(tmp_path), "partitionbytes": "90000", "openbytes": "40000"})
    parts = scan.slices(scan.listed())
    assert [os.path.basename(f) for p in parts for f in p.files if not p.keys] == ["f0.npz", "f1.npz", "f2.npz", "f4.npz"]
    assert max(len(p.files) for p in parts) == 2
    split = [p for p in parts if p.keys]  # 4 members of 40 kB each: two tasks
    assert [p.keys for p in split] == [["k0", "k1"], ["k2", "k3"]]
    whole = sorted(r["key"] for p in parts for b in scan.decode(p) for r in b.to_pylist())
    assert whole == sorted(f"/k{j}" for j in range(4) for _ in range(5))


def test_samples_read_only_the_chunks_they_keep(spark, tmp_path):
    n = 10_000
    root = staged(spark, tmp_path, [field("/f.h5", KEY, "i", i=list(range(n))), field("/f.h5", "/s", "f", d=[1.0], shape=[]),
                                    field("/f.h5", "/t", "S", s=["a"] * 30)], chunk=100)
    kept = list(range(0, n, 1000))
    rewrite(f"{root}/f.h5.npz", drop=[f"{KEY.lstrip('/')}#{c}.npy" for c in range(100) if c not in {i // 100 for i in kept}])
    got = {r.key: r for r in C.read_containers(spark, root, sample_size=10).collect()}
    assert (got[KEY].int_values, got[KEY].step, got[KEY].chunks, got[KEY].chunks_read) == (kept, 1000, 100, 10)
    assert got["/s"].step is None and got["/s"].kind == "f" and len(got["/t"].str_values) == 10


def test_missing_keys_are_silent_and_scalars_are_errors(spark, tmp_path):
    root = staged(spark, tmp_path, [field("/f.h5", KEY, "f", d=[3.0], shape=[]), field("/g.h5", KEY, "f", d=[3.0, float("nan")])])
    samples = C.read_containers(spark, root, [KEY, "/missing"], 10)
    files = spark.createDataFrame([("/f.h5", "j1"), ("/g.h5", "j2"), ("/h.h5", "j3")], "file_path string, job_id string")
    issues = sampling.sample_issues(files, samples, ["/missing", KEY]).collect()
    assert [(r.job_id, r.key, r.key_seq, r.issue.severity) for r in issues] == [("j1", KEY, 1, "error")]
    assert [tuple(r) for r in sampling.sample_json(samples, ["/missing", KEY]).collect()] == [("/g.h5", f'{{"{KEY}":[3.0,null]}}')]


def test_a_restarted_stream_takes_the_new_files_only(spark, tmp_path):
    root = str(tmp_path / "c")

    def drop(names):
        C.write_containers(spark.createDataFrame([field(f"/{n}", "/k", i=[1]) for n in names], FIELDS), root)
        C.stream_containers(spark, root, ["/k"], settleSeconds="0").writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.file_path for r in spark.read.schema(FIELDS).parquet(str(tmp_path / "out")).collect())

    assert drop(["b", "c"]) == ["/b", "/c"]
    assert drop(["a"]) == ["/a", "/b", "/c"]
    reader = C.ContainerStreamReader(FIELDS, {"path": root, "settleseconds": "3600"})
    assert reader.latestOffset() == reader.initialOffset()  # too young


def test_a_failed_write_leaves_no_container(spark, tmp_path):
    root = str(tmp_path / "c")
    fails = F.when(F.col("file_path") == "/z", F.raise_error(F.lit("stop"))).otherwise(F.col("kind"))
    rows = spark.createDataFrame([field(f"/{n}", "/k", i=[1]) for n in "abz"], FIELDS).coalesce(1).withColumn("kind", fails)
    with pytest.raises(Exception):
        C.write_containers(rows, root)
    assert C.read_containers(spark, root).count() == 0


def test_small_files_fill_few_tasks_and_every_core_has_some(spark, tmp_path):
    scan = lambda **o: C._Scan(None, {"path": str(tmp_path), **o})
    files = [(0, f"{tmp_path}/f{i:05}.npz", 1000) for i in range(20_000)]
    options = C._spread(spark)
    few = scan(openbytes=options["openBytes"], tasks="16").slices(files)
    assert 16 <= len(few) <= 20 and [f for s in few for f in s.files] == [f[1] for f in files]
    assert 16 <= len(scan(openbytes=options["openBytes"], tasks="16").slices(files[:50])) <= 25
    assert len(scan(openbytes=options["openBytes"], tasks="1").slices(files)) == 10  # 128 MB of files and openings


def test_the_driver_holds_some_bytes_a_file(tmp_path, monkeypatch):
    from pyspark import cloudpickle
    root = str(tmp_path / "c")
    files = [f"{root}/{d}/x{i:05}.npz" for d in ("a", "a.b", "b/c") for i in range(700)]
    for f in files:
        os.makedirs(os.path.dirname(f), exist_ok=True)
        open(f, "w").close()
    scan = C._Scan(None, {"path": root, "tasks": "3", "openbytes": "10"})
    parts = scan.slices_of()
    assert [f for p in parts for f in p.files] == sorted(files) == [f for p in scan.slices(scan.listed()) for f in p.files]
    assert 3 <= len(parts) <= 4 and sum(len(cloudpickle.dumps(p)) for p in parts) < 12 * len(files) < sum(map(len, files)) / 3
    assert [f for p in scan.slices_of(lambda f: "/b/" in f[1]) for f in p.files] == sorted(f for f in files if "/b/c/" in f)
    most, listing = [], scan.system.get_file_info
    monkeypatch.setattr(scan, "system", type("S", (), {"get_file_info": lambda self, s: most.append(listing(s)) or most[-1]})())
    scan.slices_of()
    assert max(map(len, most)) <= 700  # a folder at a time


def test_a_write_tells_the_driver_one_path_a_task(tmp_path):
    root = str(tmp_path / "c")
    writer = C.ContainerWriter({"path": root})
    rows = pa.RecordBatch.from_pylist([dict(zip(FIELDS.names, field(f"/{i}", "/k", i=[i]))) for i in range(50)], to_arrow_schema(FIELDS))
    kept, dropped = writer.write(iter([rows])), writer.write(iter([rows]))
    assert isinstance(kept.path, str) and writer.write(iter([])).path is None and writer.scan.listed() == []
    writer.abort([dropped, None, C.Written(None)])
    writer.commit([kept, None, C.Written(None)])
    assert sorted(os.listdir(root)) == sorted(f"{i}.npz" for i in range(50))


def test_a_tree_of_files_is_listed_in_tasks(spark, tmp_path):
    from fieldcat.sources.files import scan_files
    root = tmp_path / "t"
    for name in ("x.npz", "a/y.npz", "a/b c/é.npz", "a/b c/n.txt", "a/.h.npz", "a/_h.npz", "_hidden/z.npz", ".h/z.npz", "_k=1/w.npz", "d.npz/v.npz"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"12345"[:len(name) % 6])
    (root / "empty").mkdir()
    plain = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    for glob in (None, "*.npz", "?.npz"):
        want = (plain.option("pathGlobFilter", glob) if glob else plain).load(str(root)).select("path", "length", "modificationTime")
        for path in (str(root), f"file://{root}", f"file:{root}/"):
            out = scan_files(spark, path, glob, recursive=True)
            assert sorted(map(tuple, out.select("file_path", "size", "mod_time").collect())) == sorted(map(tuple, want.collect()))
            assert "binaryFile" not in out._jdf.queryExecution().executedPlan().toString()
    assert scan_files(spark, str(root / "empty"), recursive=True).count() == 0


def test_a_query_over_samples_opens_each_file_once(spark, tmp_path, monkeypatch):
    from fieldcat.plans import scan_queries
    spark.createDataFrame([(i, [0.5] * 80, i) for i in range(12)], "vec_id long, embedding array<float>, label int").write.parquet(
        f"{tmp_path}/embeddings.parquet")
    for query in (scan_queries.sampled_fields, scan_queries.ingest_vector_issues, scan_queries.ingest_vector_datasets):
        out = query(spark, str(tmp_path))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BatchScan" not in plan and out.count() > 0  # stored rows, no scan of the files again


def test_headers_of_arrays_are_those_of_numpy(tmp_path):
    import io
    import zipfile
    for a in (np.arange(3), np.array([], float), np.ones((2, 3), np.float32), np.asfortranarray(np.ones((2, 3))), np.array(7), np.array(["x", "yz"])):
        out = io.BytesIO()
        np.savez(out, **{"a": a})
        got = C.Container(io.BytesIO(out.getvalue())).array("a")
        assert got.dtype == a.dtype and got.shape == a.shape and (got == a).all()
    for a in (np.arange(5), np.zeros(2), np.frombuffer(b"[1]", np.uint8)):
        plain = io.BytesIO()
        np.lib.format.write_array(plain, a)
        assert C._header_of(len(a), a.dtype.str) + a.tobytes() == plain.getvalue()
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.npy", plain.getvalue()[:-1])
    try:
        C.Container(io.BytesIO(out.getvalue())).array("a")
        raise AssertionError("a cut array was read")
    except ValueError:
        pass
