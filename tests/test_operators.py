"""Golden and property cases of joins, aggregations, ordered operators, geometry, rules, corrections and streams."""

import json
import os
import random
import struct
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from leafmill.functions import content as C
from leafmill.functions import geometry as G
from leafmill.operators import aggregates as A
from leafmill.operators import checks as V
from leafmill.operators import corrections as R
from leafmill.operators import imaging
from leafmill.operators import joins as J
from leafmill.operators import machines
from leafmill.operators import ordered as W
from leafmill.plans import views
from leafmill.streaming import ingest


def cell(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def box(*v):
    return F.struct(*[F.lit(x).alias(k) for k, x in zip("ltrb", v, strict=True)])


def test_tiles(spark):
    out = [tuple(t) for t in cell(spark, G.tiles(box(10, 100, 210, 1100), F.lit(4), F.lit(40)))]
    assert out[0] == (10, 100, 210, 370) and out[-1] == (10, 830, 210, 1100)
    assert all(a[3] - b[1] == 40 for a, b in zip(out, out[1:], strict=False))
    assert cell(spark, G.box_is_valid(box(0, 0, 101, 100), F.lit(100), F.lit(100))) is False
    assert cell(spark, G.tiles(box(0, 0, 10, 100), F.lit(4), F.lit(25))) is None


def test_geometry(spark):
    e = cell(spark, G.envelope((F.lit(100.0), F.lit(120.0)), (F.lit(900.0), F.lit(940.0)), F.lit(200), F.lit(100), F.lit(0), F.lit(1000)))
    assert e.x <= 104 and e.x + e.w >= 912
    assert tuple(cell(spark, G.variant_size(F.lit(3000), F.lit(4200), F.lit(1000)))) == (1000, 1400)
    assert tuple(cell(spark, G.variant_size(F.lit(800), F.lit(1200), F.lit(1000)))) == (800, 1200)
    assert cell(spark, G.half_even(F.lit(2.5))) == 2 and cell(spark, G.floor_div(F.lit(-7), F.lit(2))) == -4
    b = cell(spark, G.column_bounds(F.lit(2721), box(340, 0, 1450, 1), box(1500, 0, 2600, 1)))
    assert tuple(b.first) == (300, 1505) and tuple(b.second) == (1445, 2651)
    c = cell(spark, G.line_crop(F.lit(0), F.lit(1), box(0, 0, 10, 100)))
    assert (c.crop.y, c.crop.h) == (46, 8)


def test_ordered(spark):
    x = F.array(*[F.lit(float(v)) for v in (10, 50, 60, 100)])
    assert cell(spark, W.guarded(x, F.transform(x, lambda v: v + 1))) == [10, 50, 61, 100]
    flat = cell(spark, W.smoothed(F.array(F.lit(1.0), F.lit(1.0), F.lit(1.0)), W.reflected_weights()))
    assert flat == pytest.approx([1, 1, 1])
    assert cell(spark, W.first_maximum(F.array(F.lit(1), F.lit(5), F.lit(5)), F.lit(0), F.lit(3))) == 1
    assert cell(spark, W.interpolated(F.lit(1), F.lit(1))) == 50 and cell(spark, W.interpolated(F.lit(3), F.lit(3))) == pytest.approx(95.8)
    rows = spark.createDataFrame([(i,) for i in (9, 1, 4, 200_000, 70_000)], "k long")
    assert {r.k: r["rank"] for r in W.global_rank(rows, "k").collect()} == {1: 1, 4: 2, 9: 3, 70_000: 4, 200_000: 5}
    assert sorted(r.k for r in W.missing_between(rows.where("k < 10"), "k").collect()) == [2, 3, 5, 6, 7, 8]
    runs = spark.createDataFrame([(1, i, v) for i, v in enumerate("aabba")], "k int, i int, v string")
    assert sorted((r.v, r.first_pos, r.last_pos) for r in W.islands(runs, "k", "v", "i").collect()) == [("a", 1, 2), ("a", 5, 5), ("b", 3, 4)]
    filled = runs.withColumn("v", F.when(F.col("i") % 2 == 0, F.col("v"))).select("i", W.filled_forward("v", "k", "i").alias("f"))
    assert [r.f for r in filled.orderBy("i").collect()] == ["a", "a", "b", "b", "a"]
    times = spark.createDataFrame([(1, 0), (1, 600), (1, 3000), (1, 3100)], "k int, s long").withColumn("ts", F.timestamp_seconds("s"))
    assert sorted(r.s for r in W.until_gap(times, "k", "ts").collect()) == [0, 600, 3000]


def test_aggregates(spark):
    rows = spark.createDataFrame([("k", "b", 1), ("k", "a", 2), ("k", "a", 3), ("k", "b", 4)], "k string, v string, i int")
    assert A.mode_first_seen(rows, "k", "v", "i").first().v == "b"
    assert A.latest_per_key(rows, "k", "i").first().i == 4
    assert A.median_gap(rows, "k", "i", "i").first().median_gap == 1
    assert A.median_gap(rows.limit(1), "k", "i", "i").first().median_gap == 62
    log = spark.createDataFrame(
        [("p", 1, "1", "2026-01-02", 1), ("p", 1, "2", "2026-01-02", 1), ("p", 2, "2", "2026-01-01", 2), ("p", 2, "3", "2026-01-01", 2)],
        "page string, issue int, line string, at string, seq int",
    )
    assert tuple(A.correction_stats(log, "page", "issue", "line", "at", "seq").first()) == ("p", 2, 4, 3, "2026-01-01")
    head = spark.createDataFrame([("1", "", "100x"), ("2", "u", "332a")], "id string, link string, note string")
    from leafmill.functions.text import leading_number

    assert tuple(A.file_summary(head, "id", F.col("link"), leading_number(F.col("note")), 332).first()) == (2, 2, 1, 1)


def test_joins(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2, "x"), (3, "y")], "k int, v string")
    assert {(r.k, r.v) for r in J.with_defaults(a, b, "k", {"v": "-"}).collect()} == {(1, "-"), (2, "x")}
    found, missing = J.strict(a, b, "k")
    assert found.count() == 1 and missing.first().k == 1
    assert {(r.k, r.side) for r in J.reconciled(a, b, "k").collect()} == {(1, "missing"), (3, "extra")}
    assert {(r.k, r.v) for r in J.upserted(a.withColumn("v", F.lit("o")), b, "k").collect()} == {(1, "o"), (2, "x"), (3, "y")}


def test_version_ignores_geometry_and_tracks_style(spark):
    def version(**more):
        values = {"typeface": "roman", "text": "a", "placement": None, "layout": None, "line_span": None, "span_id": None} | more
        runs = F.from_json(F.lit(json.dumps([values])), "array<struct<typeface:string,text:string,placement:string,layout:string,line_span:int,span_id:string>>")
        return cell(spark, C.line_version(F.lit("l1"), runs))

    import hashlib

    plain = '{"id":"l1","text":"a","runs":[{"typeface":"roman","text":"a"}]}'
    assert version() == "sha256:" + hashlib.sha256(plain.encode()).hexdigest()
    assert version(placement="far-right") == version() != version(typeface="italic")
    assert version(layout="large-initial", line_span=2) != version()


def test_rules(spark):
    review = "id string, units map<string, struct<status:string,reviewer:string,reviewed_at:string>>"
    unit = lambda s, r=None: (s, r, r)
    good = {"column-1": unit("checked", "x"), "column-2": unit("pending"), "furniture": unit("pending")}
    assert V.review_violations(spark.createDataFrame([("p", good)], review)).count() == 0
    assert V.review_violations(spark.createDataFrame([("p", good | {"column-1": unit("checked")})], review)).count() == 1
    assert V.review_violations(spark.createDataFrame([("p", {"column-1": unit("odd")})], review)).count() == 2
    leaves = spark.createDataFrame([(1,), (3,)], "leaf int")
    assert V.gaps(leaves, "V31", "leaf").first().key == "2"
    assert V.wrong_count(leaves, "V56", 651).count() == 1 and V.wrong_count(leaves, "V56", 2).count() == 0
    rect = "line_ref string, crop struct<x:int,y:int,w:int,h:int>, context_crop struct<x:int,y:int,w:int,h:int>, width int, height int"
    rows = [("a", (1, 1, 5, 5), (0, 0, 9, 9), 10, 10), ("b", (1, 1, 5, 5), (2, 0, 9, 9), 10, 10)]
    assert sorted(r.rule for r in V.geometry_violations(spark.createDataFrame(rows, rect)).collect()) == ["V37", "V38"]
    log = "event_id string, page string, step string, before string, after string, outcome string, categories string, provenance string"
    ok = ("e-1", "bnf-f0001", "1", "a", "b", "accepted", "c", "p")
    assert V.correction_violations(spark.createDataFrame([ok], log)).count() == 0
    bad = ("e-1", "x", "0", "a", "a", "odd", "", "p")
    assert V.correction_violations(spark.createDataFrame([ok, bad], log)).count() == 6
    tiles = "id string, box struct<l:int,t:int,r:int,b:int>, width int, height int, line_span array<double>, tiles int, overlap int"
    rows = [("a", (0, 0, 10, 100), 10, 100, [5.0, 95.0], 4, 10), ("b", (0, 0, 11, 100), 10, 100, [5.0, 95.0], 4, 25)]
    assert sorted(r.rule for r in V.tile_violations(spark.createDataFrame(rows, tiles)).collect()) == ["V30", "V55"]
    payload = "issue int, payload struct<schema:int,page:string,base_commit:string,base_transcription_version:string,changes:array<struct<line:string,before:string,after:string,comment:string,second_opinion:boolean>>>"
    change = ("l1", "a", "b", None, None)
    rows = [(1, (2, "f1", "c", "v", [change])), (2, (1, "f1", "c", "v", [change])), (3, (2, "f1", "c", "v", [change, change]))]
    assert sorted((r.rule, r.key) for r in V.payload_violations(spark.createDataFrame(rows, payload)).collect()) == [("V43", "2"), ("V44", "3:l1")]
    head = spark.createDataFrame([("1", "a", "", 1), ("3", "a", "http://x", 2)], "n string, id string, link string, pos long")
    assert V.headword_violations(head, "n", "id", "link", "http://y", "pos", 2).count() == 3
    summary = spark.createDataFrame([(True, 1), (True, 0), (False, None)], "processed boolean, issues_applied int")
    assert tuple(views.summary(summary).first()) == (3, 2, 1, 1) and views.overview(summary, "corrected").count() == 1


RUNS = "array<struct<typeface:string,text:string,placement:string,layout:string,line_span:int,span_id:string>>"


def test_corrections(spark):
    plain = lambda text, face="roman": [(face, text, None, None, None, None)]
    lines = spark.createDataFrame([("p:1", plain("não tẽ")), ("p:2", plain("b"))], f"line_ref string, runs {RUNS}")
    rows = [
        ("p:1", "não tẽ", "*não tẽ", None, None), ("p:2", "x", "y", None, None), ("p:3", "a", "b", None, None),
        ("p:2", "b", "[c", None, None), ("p:2", "b", "c", "why", None), ("p:2", "z", "b", None, None),
    ]
    changes = spark.createDataFrame(rows, "line_ref string, before string, after string, comment string, second_opinion boolean")
    out = R.applied(lines, changes).select("line_ref", "after", "outcome", C.line_text(F.col("new_runs")).alias("t")).collect()
    got = {(r.line_ref, r.after): (r.outcome, r.t) for r in out}
    assert got[("p:1", "*não tẽ")] == ("applied", "naõ tẽ")
    assert [got[k][0] for k in (("p:2", "y"), ("p:3", "b"), ("p:2", "[c"), ("p:2", "c"), ("p:2", "b"))] == [
        "mismatch", "unknown_line", "invalid", "held", "already",
    ]
    log = spark.createDataFrame([("p", 1, ["1", "2"], 1), ("p", 1, ["2", "1"], 2), ("p", 2, ["1"], 3), ("p", 2, ["9"], 4)], "page_id string, issue_no int, lines array<string>, seq int")
    kept, conflicts = R.idempotent(log)
    assert kept.count() == 2 and [r.issue_no for r in conflicts.collect()] == [2]


def test_edits(spark):
    lines = spark.createDataFrame(
        [(f"p:{i}", [("roman", "now", None, None, None, None)], "v2") for i in range(5)], f"line_ref string, runs {RUNS}, version string"
    )
    rows = [
        ("p:0", "now", "new", None, "v2"), ("p:1", "old", "now", None, "v1"), ("p:2", "old", "now", "why", "v1"),
        ("p:3", "old", "new", "why", None), ("p:4", "old", "old", None, "v1"), ("p:9", "a", "b", None, None),
    ]
    edits = spark.createDataFrame(rows, "line_ref string, before string, after string, comment string, base_line_version string")
    got = {r.line_ref: r for r in R.reconciled_edits(edits, lines).collect()}
    assert {k: r.action for k, r in got.items()} == {"p:0": "keep", "p:1": "drop", "p:2": "comment_only", "p:3": "rebase", "p:4": "drop", "p:9": "orphan"}
    assert (got["p:3"].before, got["p:3"].after, got["p:3"].comment_review_needed) == ("now", "new", True)
    assert (got["p:2"].before, got["p:2"].after) == ("now", "now")


def test_streams(spark, tmp_path):
    schema = "id string, recorded_at string, sha256 string, disposition string"
    source, log = tmp_path / "in", str(tmp_path / "log")
    source.mkdir()
    (source / "a.json").write_text('{"id":"1","recorded_at":"a","sha256":"x"}\n{"id":"1","recorded_at":"b","sha256":"y"}\n')
    read = lambda: spark.readStream.schema(schema).json(str(source))
    ingest.ingest(read(), log, str(tmp_path / "c"), schema).awaitTermination(60)
    (source / "b.json").write_text('{"id":"1","recorded_at":"b","sha256":"y"}\n{"id":"2","recorded_at":"a","sha256":"z"}\n')
    ingest.ingest(read(), log, str(tmp_path / "c"), schema).awaitTermination(60)
    assert spark.read.schema(schema).json(log).count() == 3
    latest = ingest.latest(spark, log, schema)
    assert {(r.id, r.sha256) for r in latest.collect()} == {("1", "y"), ("2", "z")}
    items, files = spark.createDataFrame([("1",), ("2",), ("3",)], "id string"), spark.createDataFrame([("1", "y"), ("2", "q")], "id string, sha256 string")
    what = {r.id: r.disposition for r in ingest.dispositions(items, ingest.existing(spark, log, schema), files).collect()}
    assert what == {"1": "skip", "2": "recover", "3": "fetch"}


RECORD = "id string, recorded_at string, sha256 string"


def test_ingest_after_a_crash(spark, tmp_path, monkeypatch):
    source, log, at = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "status.json")
    source.mkdir()
    for k in range(6):
        (source / f"{k}.json").write_text("".join(json.dumps({"id": f"{i:03}", "recorded_at": "a", "sha256": "x"}) + "\n" for i in (k, k + 1, 50 + k)))

    def start():
        status = ingest.Status(spark, at, log, RECORD)
        stream = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).json(str(source))
        return status, ingest.ingest(stream, log, str(tmp_path / "c"), RECORD, status=status)

    written = DataFrameWriter.json

    def dies(self, path, *args, **options):  # the log has the batch, the checkpoint does not know
        written(self, path, *args, **options)
        if path.endswith("batch=2"):
            raise RuntimeError("power is off")

    monkeypatch.setattr(DataFrameWriter, "json", dies)
    status, run = start()
    with pytest.raises(StreamingQueryException):
        status.wait(run)
    assert status.document.read()["state"] == "failed"
    monkeypatch.setattr(DataFrameWriter, "json", written)

    status, run = start()
    assert status.now["batches"] == 3 and status.document.read()["state"] == "running"
    while status.now["batches"] < 4 and not run.awaitTermination(0.02):
        pass
    middle = status.stop(run)
    assert middle["state"] in ("interrupted", "complete")

    status, run = start()
    end = status.wait(run)
    rows = [r.id for r in ingest.existing(spark, log, RECORD).collect()]
    assert sorted(rows) == sorted({f"{i:03}" for k in range(6) for i in (k, k + 1, 50 + k)})
    again = ingest.Status(spark, at, log, RECORD)
    assert (end["state"], end["batches"], end["last_id"], end["interruptions"]) == ("complete", 6, "055", 1 + (middle["state"] == "interrupted"))
    assert (again.now["rows"], again.now["batches"]) == (len(rows), 6)
    assert not [f for f in os.listdir(tmp_path) if f.endswith(".tmp")]


def test_documents_are_replaced_whole(spark, tmp_path):
    from leafmill.shared import Document

    document = Document(spark, f"file://{tmp_path}/a.json")
    assert document.read() is None
    for k in (1, 2):
        document.replace({"k": k, "name": "\u00e9"})
        assert document.read() == {"k": k, "name": "\u00e9"}
    assert [f for f in os.listdir(tmp_path) if not f.startswith(".")] == ["a.json"]


def test_corrections_in_any_order(spark, tmp_path):
    random.seed(3)
    rows = [(random.choice("pqr"), random.randrange(4), [random.choice("ab"), "z"][:: random.choice((1, -1))], i, f"2024-01-{1 + i // 4:02} 00:00:00") for i in range(80)]
    schema = "page_id string, issue_no long, lines array<string>, seq long, recorded_at timestamp"
    place = sorted(range(80), key=lambda i: i + random.randrange(24))
    (tmp_path / "in").mkdir()
    names = schema.replace("array<string>", "array").split(", ")
    for k in range(8):
        own = [dict(zip((n.split()[0] for n in names), rows[i], strict=True)) for i in place[10 * k : 10 * k + 10]]
        (tmp_path / "in" / f"{k}.json").write_text("".join(json.dumps(x) + "\n" for x in own))
        os.utime(tmp_path / "in" / f"{k}.json", (k + 1, k + 1))
    (tmp_path / "in" / "end.json").write_text('{"page_id": "end", "issue_no": 0, "lines": [], "seq": 99, "recorded_at": "2025-01-01 00:00:00"}\n')
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    ingest.run_once(ingest.applied_once(stream, "recorded_at", "8 days"), str(tmp_path / "out"), str(tmp_path / "c"))
    first, expected = {}, []
    for page, issue, lines, seq, _ in rows:
        known = first.setdefault((page, issue), (seq, sorted(lines)))
        expected.append((page, issue, seq, "applied" if known[0] == seq else "repeated" if known[1] == sorted(lines) else "conflict"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(expected)
    done, conflicts = R.idempotent(spark.createDataFrame([r[:4] for r in rows], "page_id string, issue_no long, lines array<string>, seq long"))
    assert {(r.page_id, r.issue_no, r.seq) for r in done.collect()} == {x[:3] for x in expected if x[3] == "applied"}
    assert {tuple(r) for r in conflicts.collect()} == {x[:2] for x in expected if x[3] == "conflict"}


def test_state_calls_do_not_grow_with_records():
    calls = []

    class Kept(list):
        def get(self):
            calls.append("get")
            return iter(list(self))

        def appendList(self, rows):  # noqa: N802
            calls.append("append")
            self.extend(rows)

        def put(self, rows):
            calls.append("put")
            self[:] = rows

    class Now:
        getListState = lambda self, name, schema: lists.setdefault(name, Kept())
        registerTimer = lambda self, at: calls.append("timer")
        getCurrentWatermarkInMs = lambda self: now

    lists, now, got, judge, expected = {}, 0, [], ingest.AppliedOnce(), []
    judge.init(Now())
    rng = random.Random(8)
    for turn in range(40):
        rows = [(100 * turn + rng.randrange(100), i, rng.choice(("p", "q", "")), rng.choice((*range(60), None)), rng.choice(("a", "b", None))) for i in range(2000)]
        expected += sorted(rows, key=lambda r: (r[0], r[1]))
        batch = pd.DataFrame(rows, columns=["at", "seq", "page_id", "issue_no", "lines"])
        before = len(calls)
        judge.handleInputRows((1,), iter([batch]), Now())
        now = 100 * (turn + 1)
        for out in judge.handleExpiredTimer((1,), Now(), None):
            got += [(r.page_id, None if r.issue_no != r.issue_no else r.issue_no, r.seq, r.outcome) for r in out.itertuples()]
        assert len(calls) - before <= 8 and len(lists["first"]) <= 33
    seen, want = {}, []
    for _, seq, page, issue, lines in expected:
        if (page, issue) in seen:
            want.append((page, issue, seq, "repeated" if seen[page, issue] == lines else "conflict"))
        else:
            seen[page, issue] = lines
            want.append((page, issue, seq, "applied"))
    assert got == want and not lists["waiting"]


@pytest.mark.parametrize("width", [1, 7, 10**9])
def test_machine_is_a_fold(spark, width):
    machine = machines.Machine(machines.CORRECTION_STATES, machines.CORRECTION_STEPS)
    random.seed(width)
    events = [*machine.maps, None, "other"]
    rows = [(random.choice(("a", "b", None)), i, random.choice(events)) for i in range(400)]
    frame = spark.createDataFrame(rows, "k string, i long, e string").repartition(5)
    found = machines.machine_states(frame, "k", "i", bucket=F.floor(F.col("i") / width), event=F.col("e"), machine=machine)
    state, expected = {}, []
    for k, i, e in rows:
        was = state.get(k, "new")
        now = machines.CORRECTION_STEPS.get((was, e), was)
        state[k] = now
        expected.append((k, i, e, was, now, (was, e) not in machines.CORRECTION_STEPS))
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1]) == expected
    assert machines.machine_states(frame.limit(0), "k", "i", bucket=F.col("i"), event=F.col("e"), machine=machine).count() == 0
    loop = machines.Machine(["on", "off"], {("on", "x"): "on", ("off", "y"): "on", ("on", "y"): "off"})
    rows = machines.machine_states(frame.where("k = 'a'").withColumn("e", F.lit("x")), "k", "i", bucket=F.col("i"), event=F.col("e"), machine=loop).collect()
    assert {(r.state, r.refused) for r in rows} == {("on", False)}


def test_ranks_and_offsets(spark):
    rng = random.Random(9)
    ids = [None, -(1 << 63), (1 << 63) - 1, 0, -1, *(rng.randrange(-(1 << 60), 1 << 60) for _ in range(300)), *(rng.randrange(40) for _ in range(99))]
    frame = spark.createDataFrame([(x, i) for i, x in enumerate(ids)], "k long, i int").repartition(6)
    expected = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, i))
    for width in (16, 1 << 16):
        got = sorted((r["rank"], r.i) for r in W.global_rank(frame, "k", ["i"], width=width).collect())
        assert got == [(n + 1, i) for n, i in enumerate(expected)]
    rows = [(rng.choice("ab"), i, rng.choice((None, "", "x" * rng.randrange(9)))) for i in range(200)]
    pieces = spark.createDataFrame(rows, "k string, i int, t string").repartition(5)
    for width in (3, 1000):
        found = W.running_total(pieces, "k", "i", bucket=F.floor(F.col("i") / width), value=F.length("t")).collect()
        assert all(r.start == sum(len(t or "") for k, i, t in rows if k == r.k and i < r.i) for r in found) and len(found) == 200


def plain_centres(grey, box, count, first, last, radius=24, least=28):
    left, top, right, bottom = box
    off = max(45, (right - left) // 14)
    dark = (grey[top:bottom, left + off : right - off] < 105).sum(1).astype(float)
    kernel = np.array(W.reflected_weights())
    padded = np.pad(dark, len(kernel) // 2, "symmetric")
    smooth = np.array([round(float((padded[i : i + len(kernel)] * kernel).sum()), 9) for i in range(len(dark))])
    out = []
    for value in np.linspace(first, last, count).tolist():
        start, stop = max(0, round(value - top - radius)), min(len(dark), round(value - top + radius + 1))
        centre = top + start + int(np.argmax(smooth[start:stop]))
        out.append(round(value) if out and centre <= out[-1] + least else centre)
    return out


def png(grey, colour):
    """A PNG file, grey or with three equal channels."""
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    rows = np.repeat(grey[:, :, None], 3, 2).reshape(len(grey), -1) if colour else grey
    body = b"".join(b"\0" + r.tobytes() for r in rows)
    head = struct.pack(">IIBBBBB", grey.shape[1], grey.shape[0], 8, 2 if colour else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")


def test_line_centres_of_image_files(spark, tmp_path):
    rng = np.random.default_rng(4)
    grey = np.full((500, 400), 230, np.uint8)
    lines = np.cumsum(rng.integers(34, 60, 8)) + 20
    for y in lines:
        grey[y - 8 : y + 8] = rng.integers(0, 255, (16, 400))
    (tmp_path / "a.png").write_bytes(png(grey, False))
    (tmp_path / "b.png").write_bytes(png(grey, True))
    (tmp_path / "no.png").write_bytes(b"no image")
    found = imaging.page_images(spark, f"{tmp_path}/*.png")
    bodies = spark.createDataFrame([(bytes(f"P5 # x\n400 500\n255\n", "ascii") + grey.tobytes(),), (b"P5 4 4 255\nxx",), (None,)], "content binary")
    bodies = imaging.from_graymaps(bodies, "content")
    assert bodies.where("image IS NULL").count() == 2
    whole = found.unionByName(bodies)
    for boxes in ([20, 30, 380, 480], [0, 0, 400, 500]):
        box = F.struct(*(F.lit(v).alias(k) for k, v in zip("ltrb", boxes, strict=True)))
        rows = imaging.row_profiles(whole.withColumn("box", box).withColumn("n", F.lit(len(lines))), "image", "box")
        centres = imaging.local_centres(F.col("profile"), F.lit(boxes[1]), F.lit(int(lines[0]) + 5), F.lit(int(lines[-1]) - 9), F.col("n"))
        got = [r.c for r in rows.select(centres.alias("c")).collect()]
        expected = plain_centres(grey, boxes, len(lines), int(lines[0]) + 5, int(lines[-1]) - 9)
        assert sorted(map(str, got)) == sorted(map(str, [expected] * 3 + [None] * 2))
    off = imaging.row_profiles(whole.withColumn("box", F.struct(*(F.lit(v).alias(k) for k, v in zip("ltrb", (390, 600, 410, 700), strict=True)))), "image", "box")
    assert {str(r.profile) for r in off.collect()} == {"[]", "None"}


def test_navigation_window(spark):
    rows = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c")], "leaf int, unit_pos int, unit string")
    assert {(r.unit, r.k, r.n) for r in views.navigation(rows).collect()} == {("a", 1, 2), ("b", 2, 2), ("c", 1, 1)}


def test_marked_turns_have_results(spark, tmp_path):
    from leafmill.plans import catalog

    texts = ["plain", "a [b] {c}", "a [b {c}]", "{c", "[]", "x ]", "", "{all}", "star *s*", "e {\u00e9}"]
    stripped = ["plain", "a b c", None, None, None, None, "", "all", "star *s*", "e \u00e9"]
    rows = [(i, turn, "user", text) for i, text in enumerate(texts) for turn in range(5)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = catalog.QUERIES["notation_parse"](spark, str(tmp_path)).collect()
    assert sorted((r.conv_id, r.turn, r.text) for r in got if r.turn == 0) == [(i, 0, x) for i, x in enumerate(stripped)]
    assert len(got) == len(rows)
    acts = {(r.conv_id, r.turn): r.action for r in catalog.QUERIES["edit_reconcile"](spark, str(tmp_path)).collect()}
    # line texts are taken as they stand, so an edit with tilde (F3) or typeface marks (F4) proposes another line or is invalid
    same = lambda text: not any(c in text for c in "*[]{}")
    by_turn = lambda text: ["keep", "keep", "drop" if same(text) else "rebase", "rebase", "orphan"]
    assert acts == {(i, turn): x for i, text in enumerate(texts) for turn, x in enumerate(by_turn(text))}


def guard_by_hand(pairs, least=28):
    out, last = [], None
    for s, e in pairs:
        fine = last is None or (s is not None and s > last + least)
        last = s if fine else e
        out.append((last, fine))
    return out


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_guarded_rows(spark, width):
    rng = random.Random(width)
    draw = lambda: None if rng.random() < 0.05 else float(rng.randint(0, 120))
    data = [(k, i, draw(), draw()) for k in ("a", "b", None) for i in range({"a": 200, "b": 1, None: 40}[k])]
    rows = spark.createDataFrame(data, "k string, i int, s double, e double").repartition(5)
    got = W.guarded_rows(rows, "k", "i", bucket=F.col("i") / width, snapped=F.col("s"), expected=F.col("e"))
    assert got.columns == ["k", "i", "s", "e", "guarded_snapped", "guarded"]
    found = {(r.k, r.i): (r.guarded, r.guarded_snapped) for r in got.collect()}
    for k in ("a", "b", None):
        own = [(s, e) for kk, _, s, e in data if kk == k]
        assert [found[k, i] for i in range(len(own))] == guard_by_hand(own)
    assert len(found) == len(data)
    assert W.guarded_rows(rows.limit(0), "k", "i", bucket=F.col("i"), snapped=F.col("s"), expected=F.col("e")).count() == 0


@pytest.mark.parametrize("width", [1, 50, 1000])
def test_smoothed_rows(spark, width):
    weights, rng = W.reflected_weights(), random.Random(width)
    sizes = {"a": 150, "b": 1, "c": 7, None: 33}
    data = [(k, i, rng.random()) for k, n in sizes.items() for i in range(n)]
    rows = spark.createDataFrame(data, "k string, i int, x double").repartition(5)
    got = W.smoothed_rows(rows, "k", "i", bucket=F.col("i") / width, value="x", weights=weights, chunk=40)
    found = {(r.k, r.i): (r.place, r.smooth) for r in got.collect()}
    assert got.columns == ["k", "i", "x", "place", "smooth"] and len(found) == len(data)
    for k, n in sizes.items():
        values = [x for kk, _, x in data if kk == k]
        folded = lambda j, n=n: j % (2 * n) if j % (2 * n) < n else 2 * n - 1 - j % (2 * n)
        for i in range(n):
            place, smooth = found[k, i]
            assert place == i and smooth == pytest.approx(sum(w * values[folded(i + j - 16)] for j, w in enumerate(weights)), abs=1e-12)


def test_assembled_digests(spark):
    rng = random.Random(3)
    texts, joins = ["a", "ab-", "", "-", "c==", "  d", "é-"], ["space", "none", "word", "newline"]
    data = [(k if k else None, i, rng.choice(texts), rng.choice(joins)) for k in range(60) for i in range(rng.randint(1, 6))]
    rows = spark.createDataFrame(data, "k int, i int, text string, how string")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("i", "text", F.col("how").alias("join")))), lambda x: F.struct(x["text"], x["join"]))
    whole = rows.groupBy("k").agg(F.md5(W.assembled(parts)["text"]).alias("digest"))
    streamed = W.assembled_digests(rows, "k", "i", text="text", join="how")
    known = {r.k: r.digest for r in whole.collect()}
    assert {r.k: r.digest for r in streamed.collect()} == known and None in known.values() and len(set(known.values())) > 20
    broken = spark.createDataFrame([(1, 0, "a", "space"), (1, 1, None, "space"), (1, 2, "b", "space")], "k int, i int, text string, how string")
    assert W.assembled_digests(broken, "k", "i", text="text", join="how").first().digest is None
