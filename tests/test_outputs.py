"""Files in total order, published versions, archives, kept aggregates and damaged records."""

import io
import json
import os
import random
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from leafmill.operators import maintained
from leafmill.plans import outputs
from leafmill.sources import archives, files


def test_sorted_files(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.choice((None, *range(40))), rng.choice((None, "a", "b", "\u00e9", "z" * 9)), i) for i in range(900)]
    frame = spark.createDataFrame(rows, "k int, name string, i long").repartition(7)
    path = str(tmp_path / "out")
    outputs.write_sorted(frame, path, "k", "name", "i", files=6)
    assert outputs.manifest_of(spark, path).count() == 6 and outputs.out_of_order(spark, path).count() == 0
    least = lambda v: (v is not None, v if v is not None else 0)
    expected = sorted(rows, key=lambda r: (least(r[0]), (r[1] is not None, r[1] or ""), r[2]))
    got = sorted(outputs.read_sorted(spark, path).collect(), key=lambda r: r.place)
    assert [(r.k, r.name, r.i) for r in got] == expected and [r.place for r in got] == list(range(900))
    # the files one after another, by name
    names = sorted(f for f in os.listdir(f"{path}/data") if f.endswith(".parquet"))
    assert [tuple(r) for f in names for r in spark.read.parquet(f"{path}/data/{f}").orderBy(F.monotonically_increasing_id()).collect()] == expected
    part = outputs.read_sorted(spark, path, (10, "b"), (12,))
    assert len(part.inputFiles()) < 4
    own = [i for i, r in enumerate(expected) if r[0] is not None and (r[0], r[1] or "") >= (10, "b") and r[0] <= 12]
    assert sorted(r.place for r in part.collect()) == own
    assert outputs.read_sorted(spark, path, (99,)).count() == 0
    outputs.write_sorted(frame.where("false"), path, "k")
    assert outputs.read_sorted(spark, path).count() == 0 and outputs.out_of_order(spark, path).count() == 0
    outputs.write_sorted(frame.withColumn("name", F.lit("one")).select("name"), path, "name", files=3)  # ties only
    assert outputs.read_sorted(spark, path).count() == 900 and outputs.out_of_order(spark, path).count() == 0


def test_files_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(outputs, "FILE_ROWS", 100)
    frame, path = spark.range(950).select((F.col("id") * 7 % 950).alias("k")), str(tmp_path / "out")
    outputs.write_sorted(frame, path, "k", files=2)
    known = outputs.manifest_of(spark, path).orderBy("file").collect()
    assert len(known) == 10 and max(r.rows for r in known) < 200 and outputs.out_of_order(spark, path).count() == 0
    assert [(r.first.k, r.last.k) for r in known] == [(r.offset, r.offset + r.rows - 1) for r in known]
    assert all(r.k == r.place for r in outputs.read_sorted(spark, path).collect())


def test_published_versions(spark, tmp_path):
    home = outputs.Published(spark, f"file://{tmp_path}/home")
    with pytest.raises(FileNotFoundError):
        home.current()
    frame = lambda *rows: spark.createDataFrame(rows, "part string, x int")
    first = home.publish(frame(("a", 1), ("b", 2), (None, 3)), "part")
    reader = home.current()
    home.replace_parts(frame(("b", 20), (None, 30), ("new", 4)), "part")
    assert {tuple(r) for r in reader.select("part", "x").collect()} == {("a", 1), ("b", 2), (None, 3)}
    assert {tuple(r) for r in home.current().select("part", "x").collect()} == {("a", 1), ("b", 20), (None, 30), ("new", 4)}
    assert home.reclaim(3600) == [] and home.reclaim(-1) == [first] and home.reclaim(-1) == []
    left = sorted(os.listdir(tmp_path / "home"))
    assert len([f for f in left if f.startswith("v-")]) == 1 and home.current().count() == 4
    # a version that fails is never switched to
    with pytest.raises(Exception, match="division|DIVIDE"):
        home.publish(frame(("a", 0)).withColumn("x", F.expr("1 div x")), "part")
    assert home.current().count() == 4


def test_archives(spark, tmp_path):
    rng = random.Random(6)
    content = {f"m{i}.txt": bytes(rng.randrange(256) for _ in range(300)) * rng.randrange(1, 40) for i in range(12)} | {"empty": b"", "big": b"0" * (5 << 20)}
    rows = [(a, name, data) for a in ("one", "two") for name, data in content.items()]
    frame = spark.createDataFrame(rows, "archive string, name string, content binary")
    root = f"file://{tmp_path}/zip"
    for _ in range(2):  # a task that runs again replaces its archive
        assert {(r.archive, r.members) for r in archives.write_archives(frame, root).collect()} == {("one", 14), ("two", 14)}
    assert sorted(os.listdir(tmp_path / "zip")) == ["one.zip", "two.zip"]
    with zipfile.ZipFile(tmp_path / "zip" / "one.zip") as z:
        assert z.testzip() is None and {i.filename: z.read(i) for i in z.infolist()} == content
    with zipfile.ZipFile(tmp_path / "zip" / "stored.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("s", b"stored" * 999)
        z.mkdir("folder")
    found = archives.members(spark, f"{tmp_path}/zip/*.zip")
    good = archives.checked(found).collect()
    assert len(good) == 29 and all(r.error is None and len(r.sha256) == 64 for r in good)
    assert {(r.name, r.size, r.crc) for r in good} == {(n, len(d), zlib.crc32(d)) for n, d in (content | {"s": b"stored" * 999}).items()}

    data = bytearray((tmp_path / "zip" / "stored.zip").read_bytes())
    data[200] ^= 1
    (tmp_path / "zip" / "flipped.zip").write_bytes(data)
    whole = (tmp_path / "zip" / "one.zip").read_bytes()
    (tmp_path / "zip" / "cut.zip").write_bytes(whole[: len(whole) // 2])
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_BZIP2) as z:
        z.writestr("b", b"x" * 99)
    (tmp_path / "zip" / "other.zip").write_bytes(out.getvalue())
    found = archives.members(spark, f"{tmp_path}/zip/*.zip")
    bad = {(os.path.basename(r.path), r.name, r.error) for r in archives.checked(found).collect() if r.error}
    assert bad == {("flipped.zip", "s", "CRC"), ("cut.zip", None, "File is not a zip file"), ("other.zip", "b", "method 12")}
    path = [r.path for r in good if r.path.endswith("one.zip")][0]
    wanted = spark.createDataFrame([(path, n) for n in [*content, "more"] if n != "big"], "path string, name string")
    one = found.where(F.col("path") == path)
    assert {(r.name, r.side) for r in archives.missing_members(one, wanted).collect()} == {("more", "missing"), ("big", "unexpected")}


def test_kept_aggregates(spark):
    rng = random.Random(7)
    rows = [(rng.choice("abc"), rng.randrange(6), rng.randrange(9), i, f"d{rng.randrange(5)}") for i in range(200)]
    log = spark.createDataFrame(rows, "page string, issue long, line long, seq long, applied_at string").repartition(5)
    order = lambda kept: sorted(map(tuple, kept.stats.collect()))
    whole = order(maintained.aggregated(log))
    kept = maintained.aggregated(log.where("false"))
    for part in ("seq BETWEEN 100 AND 150", "seq < 100 AND page <> 'c'", "false", "seq > 150", "seq < 100 AND page = 'c'"):  # later ones may come first
        kept = maintained.merged(kept, log.where(part))
    assert order(kept) == whole and maintained.differences(kept, log).count() == 0
    wrong = maintained.Kept(kept.stats.withColumn("distinct_lines", F.col("distinct_lines") + (F.col("page") == "b").cast("int")), kept.issues, kept.lines)
    assert [r.page for r in maintained.differences(wrong, log).collect()] == ["b"]
    assert maintained.differences(maintained.aggregated(log.where("page <> 'a'")), log).first().page == "a"


def test_damaged_lines(spark, tmp_path):
    lines = [json.dumps({"id": f"r{i}", "n": i}) for i in range(3000)]
    bad = {7: '{"id": "x"', 8: "nothing", 1500: '{"id": "y", "n": "no number"}', 2999: "[1"}
    for i, line in bad.items():
        lines[i] = line
    lines[20] = "  "
    for name in ("a", "b"):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")  # files in several pieces
    try:
        records, damaged = files.json_lines(spark, str(tmp_path), "id string, n long")
        assert records.rdd.getNumPartitions() > 2
        got = [(os.path.basename(r.file), r.line_no, r.id) for r in records.collect()]
        lost = sorted((os.path.basename(r.file), r.line_no, r.value) for r in damaged.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert lost == sorted((f"{f}.jsonl", i + 1, v) for f in "ab" for i, v in bad.items())
    assert sorted(got) == sorted((f"{f}.jsonl", i + 1, f"r{i}") for f in "ab" for i in range(3000) if i not in bad and i != 20)
    strict, _ = files.json_lines(spark, f"{tmp_path}/a.jsonl", "id string, n long", strict=True)
    with pytest.raises(Exception, match=r"no record: .*a\.jsonl:(8|9|1501|3000)"):
        strict.collect()
