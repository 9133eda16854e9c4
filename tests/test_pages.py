"""The compact page format: parsing, export, registry, rules."""

import pytest
from pyspark.sql import functions as F

from leafmill import model
from leafmill.operators import checks as V
from leafmill.plans import views
from leafmill.sources import files, pages

HEAD = f"""---
format: {model.COMPACT_FORMAT}
version: 1
id: bnf-f0001
source: Library
view: f1
url: https://example.org/f1
sha256: {{sha}}
scope: all
origin: scan
wikisource: false
lineation: checked
status: scan_confirmed
---
"""
PAGE = (
    HEAD.format(sha="a" * 64)
    + """
## header [running_header] Head

[h-l001] 12

## column-1 [column] Column 1

> A note.

[c1-l001 initial=2] Abc *de f* g
[c1-l002 >] *only italic* x || {mark}z
[c1-l003 >>] far
"""
)


def parsed(spark, *bodies):
    return spark.createDataFrame([(f"p{i}", b) for i, b in enumerate(bodies)], "path string, body string")


def test_round_trip(spark):
    rows = parsed(spark, PAGE)
    compiled = pages.compiled(rows).cache()
    page = compiled.first()
    assert (page.id, page.review.wikisource_used_for_this_trial, len(page.zones)) == ("bnf-f0001", False, 2)
    first = page.zones[1].lines[0].runs
    assert [(r.typeface, r.text, r.layout, r.line_span) for r in first] == [
        ("roman", "A", "large-initial", 2), ("roman", "bc", None, None), ("italic", " de f", None, None), ("roman", " g", None, None),
    ]
    assert [r.span_id for r in page.zones[1].lines[1].runs] == [None, None, "mark"]
    out = pages.exported(compiled).first().body
    again = pages.compiled(parsed(spark, out)).first()
    assert again.zones == page.zones and again.review == page.review
    assert V.page_violations(rows).count() == 0


def test_registry_and_views(spark):
    compiled = pages.compiled(parsed(spark, PAGE))
    lines = pages.registry(compiled)
    assert lines.count() == 4
    assert pages.printed_number(lines).first().printed == "12"
    view = views.page_view(compiled).first().body
    assert "| `c1-l002` | &emsp;*only italic* x | z |" in view
    assert V.run_violations(lines).count() == 0
    sequences = spark.createDataFrame(
        [("s", "S", [("bnf-f0001:c1-l003", None, None, None), ("bnf-f0001:c1-l002", "none", "mark", None)])],
        "id string, label string, segments array<struct<line:string,join:string,span:string,runs:array<int>>>",
    )
    assert views.readings(sequences, lines).first().text == "farz"


BROKEN = [
    ("V1", PAGE.replace(" g\n", " a\u0303\n")),
    ("V2", PAGE.replace("---\n", "", 1)),
    ("V3", PAGE.replace("view: f1", "view f1")),
    ("V3", PAGE.replace("view: f1", "view: f1\nview: f2")),
    ("V4", PAGE.replace("version: 1", "version: 2")),
    ("V5", PAGE.replace("scope: all\n", "")),
    ("V6", PAGE.replace("a" * 64, "A" * 64)),
    ("V7", PAGE.replace("lineation: checked", "lineation: no")),
    ("V8", PAGE.replace("scan_confirmed", "done")),
    ("V9", PAGE + "stray\n"),
    ("V10", PAGE.replace("## header [running_header] Head\n", "")),
    ("V11", PAGE.replace("> A note.", "> A note.\n> Another.")),
    ("V12", PAGE.replace("c1-l002", "c1-l001")),
    ("V13", PAGE.replace("## column-1 ", "## header ")),
    ("V14", PAGE.replace("far\n", "far || more\n")),
    ("V15", PAGE.replace("[c1-l003 >>] far", "[c1-l003] {x}far")),
    ("V15", PAGE.replace("{mark}z", "{mark}z *y*")),
    ("V16", PAGE.replace("[c1-l003 >>] far", "[c1-l003 >> initial=2] far")),
    ("V17", PAGE.replace("{mark}z", "{mark}z || {mark}y")),
    ("V18", HEAD.format(sha="a" * 64)),
    ("V28", PAGE.replace("*de f*", "*de f")),
]


def test_page_rules(spark):
    found = {(r.key.split(":")[0], r.rule) for r in V.page_violations(parsed(spark, *[b for _, b in BROKEN])).collect() if r.rule != "V19"}
    for i, (rule, _) in enumerate(BROKEN):
        assert (f"p{i}", rule) in found, (i, rule)


def test_unique_ids_across_pages(spark):
    assert {r.rule for r in V.page_violations(parsed(spark, PAGE, PAGE)).collect()} == {"V19"}


def plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_rules_of_pages_take_one_pass(spark):
    rows = parsed(spark, *[b for _, b in BROKEN])
    said = plan(V.page_violations(rows))
    assert "Window" not in said and "Join" not in said and said.count("LogicalRDD") + said.count("LocalRelation") == 1
    found = {(r.key, r.rule, r.detail) for r in V.page_violations(rows).collect()}
    few = V.page_violations(rows, ["V2", "V11", "V15"])  # the rules asked for, and what they said among all
    assert {tuple(r)[1::-1] + (r.detail,) for r in few.collect()} == {x for x in found if x[1] in ("V2", "V11", "V15")} and "nfc" not in plan(few)
    assert [tuple(r)[1:] for r in few.where("rule = 'V11'").collect()] == [("p11:20", "2")]
    dark = spark.createDataFrame([("n", None), ("e", ""), ("m", PAGE.replace("\n", "\r\n") + "\n\u2028")], "path string, body string")
    assert {(r.key, r.rule) for r in V.page_violations(dark).collect()} == {("n", "V1"), ("n", "V18"), ("e", "V2"), ("e", "V18")}
    assert [r.n for r in pages.numbered(dark.where("path = 'm'")).orderBy("n").collect()] == list(range(1, len(PAGE.splitlines()) + 3))


def test_rules_of_runs_take_one_pass(spark):
    lines = pages.registry(pages.compiled(parsed(spark, PAGE, PAGE.replace(" g\n", " a\u0303=\n")))).withColumn("indent", F.when(F.col("line_id") == "c1-l003", -1))
    said = plan(V.run_violations(lines, ["V21", "V23", "V24"]))
    assert "nfc" not in said and said.count("LogicalRDD") + said.count("LocalRelation") == 1
    found = sorted((r.rule, r.key.split(":")[1], r.detail) for r in V.run_violations(lines).collect())
    twice = [("V24", x, "2") for x in ("c1-l001", "c1-l002", "c1-l003", "h-l001")]
    assert found == [("V21", "c1-l003", None)] * 2 + [("V22", "c1-l001", None)] + twice + [("V58", "c1-l001", None)]


def test_keys_of_sets_are_counted_before_they_are_dealt(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int"), spark.createDataFrame([(2,), (3,), (None,)], "k int")
    assert sorted(map(tuple, V.unresolved(a, b, "V34", "k").fillna("", ["key"]).collect())) == [("V34", "", None), ("V34", "1", None)]
    one, other = "not in the second", "not in the first"
    assert sorted(tuple(r)[1:] for r in V.unequal_sets(a, b, "V20", "k").fillna("", ["key"]).collect()) == [("", other), ("", one), ("1", one), ("3", other)]
    assert "Join" not in plan(V.unresolved(a, b, "V34", "k")) + plan(V.unequal_sets(a, b, "V20", "k"))


def test_pages_are_compiled_where_they_are(spark):
    odd = "---\nid: q\nid: r\n---\n[x] lost\n> lost\n## a [column] A\n> one\n[x >>] {m}y || \nodd\n[y initial=3]  *i* b\n---\n## b [column] B\n"
    page = pages.compiled(parsed(spark, odd, "---\nid: q\n---\n", "## a [column] A\n[x] y", None)).collect()
    assert [(p.path, p.id, [(z.id, z.label, z.note, z.lines and [(x.id, x.indent) for x in z.lines]) for z in p.zones]) for p in page] == [
        ("p0", "q", [("a", "A", "one", [("x", None), ("y", None)]), ("b", "B", None, None)])
    ]
    first, second = (x.runs for x in page[0].zones[0].lines)
    assert first is None and [(r.typeface, r.text, r.layout) for r in second] == [("italic", " ", "large-initial"), ("italic", "i", None), ("roman", " b", None)]
    said = plan(pages.compiled(parsed(spark, PAGE)))
    assert "Window" not in said and "Join" not in said and "Aggregate" not in said


def test_selected_text(spark):
    runs = F.from_json(F.lit('[{"text":"a"},{"text":"b","span_id":"m"}]'), "array<struct<text:string,span_id:string>>")
    pick = lambda i, s: spark.range(1).select(pages.selected_text(runs, i, s).alias("x")).first().x
    none, word = F.lit(None).cast("array<int>"), F.lit(None).cast("string")
    assert pick(none, word) == "ab"
    assert pick(F.array(F.lit(1), F.lit(0)), word) == "ba"
    assert pick(F.array(F.lit(2)), word) is None
    assert pick(none, F.lit("m")) == "b"
    assert pick(none, F.lit("x")) is None


def frame(w, h):
    return b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x07\x08" + h.to_bytes(2, "big") + w.to_bytes(2, "big")


def test_files(spark, tmp_path):
    assert files.jpeg_size(frame(640, 480)) == (640, 480, None)
    assert files.jpeg_size(b"x")[2] and files.jpeg_size(frame(0, 480))[2] and files.jpeg_size(b"\xff\xd8\xff\xd9")[2]
    assert files.jpeg_size(b"\xff\xd8\xff\xff\xd0\xff\xe0\x00\x04\xff\xc0" + frame(64, 48)[8:]) == (64, 48, None)  # a marker's bytes inside a segment
    assert files.jpeg_size(b"\xff\xd8\xff\xe0\x00\x01")[2] == "segment too short" and files.jpeg_size(frame(640, 480)[:-1])[2] == "no frame"
    for bad in ((0, 3), (3, 2), (650, 652)):
        with pytest.raises(ValueError):
            files.leaves(spark, *bad)
    (tmp_path / "f0001.jpg").write_bytes(frame(640, 480))
    assert [tuple(r.size)[:2] for r in files.images(spark, str(tmp_path / "*.jpg")).collect()] == [(640, 480)]
    assert files.by_leaf(spark, str(tmp_path)).first().leaf == 1
    for name in ("f10000.jpg", "f0123456.jpg", "f123.jpg", "f12345.jpeg"):
        (tmp_path / "leaves").mkdir(exist_ok=True)
        (tmp_path / "leaves" / name).write_bytes(b"x")
    assert sorted(r.leaf for r in files.by_leaf(spark, str(tmp_path / "leaves")).collect()) == [10000, 123456]
    (tmp_path / "t.tsv").write_text("﻿a\tb\n1\t\"x\n", encoding="utf-8")
    assert [tuple(r) for r in files.delimited(spark, str(tmp_path / "t.tsv"), ["a", "b"]).collect()] == [("1", '"x')]
    with pytest.raises(ValueError):
        files.delimited(spark, str(tmp_path / "t.tsv"), ["a", "c"])
    (tmp_path / "m.jsonl").write_text('{"id":"a","width":1}\n\n{"x":1}\nbroken\n{"id":"a","width":2}\n')
    good, bad = files.manifest(spark, str(tmp_path / "m.jsonl"), "id string, width int")
    assert sorted(r.width for r in good.collect()) == [1, 2] and bad.count() == 1
    body = spark.createDataFrame([(1, 'x\n```json\n{"schema":2}\n```\n'), (2, "none")], "issue int, body string")
    out = {r.issue: r for r in files.fenced_json(body, "body", "schema int").collect()}
    assert out[1].payload.schema == 2 and out[2].error


def written_pages(spark, tmp_path, n=12):
    from leafmill.sources import page_source

    head = "---\nformat: f\nversion: 1\nid: {0}\nview: v{1}\nscope: all\nstatus: {2}\n---\n\n## column-1 [column] C\n\n"
    body = [(f"p{i}", head.format(f"p{i}", i, "open" if i % 3 else "done") + "".join(f"[l-{k} >] text {i} {k}\n" for k in range(i))) for i in range(1, n + 1)]
    path = f"file://{tmp_path}/pages"
    page_source.write_pages(spark.createDataFrame(body, "id string, body string").repartition(3), path)
    return page_source, path, body


def test_page_source(spark, tmp_path):
    source, path, body = written_pages(spark, tmp_path)
    lines = source.page_lines(spark, path, bundle="300")
    assert lines.count() == sum(range(1, 13)) and 3 < lines.rdd.getNumPartitions() < 12
    row = lines.where("page_id = 'p5' AND line_id = 'l-3'").first()
    assert (row.view, row.status, row.zone_pos, row.line_pos, row.flag, row.content) == ("v5", "open", 0, 3, ">", "text 5 3")
    few = source.page_lines(spark, path, "line_id", "page_id")
    assert few.columns == ["line_id", "page_id"] and "content" not in few._jdf.queryExecution().executedPlan().toString()
    # a page whose header does not match is not read on: this one has a bad body
    (tmp_path / "pages" / "bad.txt").write_text("---\nid: bad\nstatus: spoilt\n---\nno line\n")
    assert source.page_lines(spark, path, "page_id", "status").where("status IN ('done', 'other') AND page_id <> 'p3'").count() == 6 + 9 + 12
    with pytest.raises(Exception, match="bad.txt:5 is no line"):
        source.page_lines(spark, path).count()


def test_page_source_commits_whole(spark, tmp_path):
    source, path, body = written_pages(spark, tmp_path)
    here = tmp_path / "pages"
    frame = lambda rows: spark.createDataFrame(rows, "id string, body string").repartition(4)
    with pytest.raises(Exception, match="no file name"):
        source.write_pages(frame([("q", "x"), ("../q", "x")]), path)
    with pytest.raises(Exception, match="more than once"):
        source.write_pages(frame([("q", "x"), ("q", "y")]), path)
    assert sorted(p.name for p in here.glob("*.txt")) == sorted(f"{i}.txt" for i, _ in body)
    source.write_pages(frame([("p1", body[0][1]), ("new", body[1][1])]), path)
    assert sorted(p.name for p in here.glob("*.txt")) == ["new.txt", "p1.txt"] and (here / "_SUCCESS").exists()
    source.write_pages(frame([("more", body[2][1])]), path, "append")
    assert len(list(here.glob("*.txt"))) == 3 and source.page_lines(spark, path).count() == 1 + 2 + 3
    source.write_pages(frame([]), f"file://{tmp_path}/none")
    assert source.page_lines(spark, f"file://{tmp_path}/none").count() == 0


def test_page_source_batches_are_small(spark, tmp_path, monkeypatch):
    """Neither side holds more than a few MB of a partition's pages in Python, whatever the session's batches are."""
    from leafmill.sources import page_source as source

    said = f"{tmp_path}/said"

    class Spy(source.PageSource):
        def reader(self, schema):
            class Reader(source.PageReader):
                def read(self, partition):
                    for batch in super().read(partition):
                        with open(said, "a") as file:
                            file.write(f"read {batch.num_rows} {batch.nbytes}\n")
                        yield batch

            return Reader(schema, self.options)

        def writer(self, schema, overwrite):
            class Writer(source.PageWriter):
                def write(self, iterator):
                    def seen():
                        for batch in iterator:
                            with open(said, "a") as file:
                                file.write(f"write {batch.num_rows} {batch.nbytes}\n")
                            yield batch

                    return super().write(seen())

            return Writer(schema, self.options, overwrite)

    monkeypatch.setattr(source, "PageSource", Spy)
    head = "---\nid: p\nstatus: done\n---\n\n## column-1 [column] C\n\n"
    lines = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(399)), lambda i: F.concat(F.lit("[l-"), i.cast("string"), F.lit("] "), F.repeat(F.lit("é"), 500))), "\n")
    pages = spark.range(0, 60, 1, 1).select(F.concat(F.lit("p"), "id").alias("id"), F.concat(F.lit(head), lines, F.lit("\n")).alias("body"))
    before = spark.conf.get(source.BATCH_BYTES)
    source.write_pages(pages, f"file://{tmp_path}/pages")
    assert spark.conf.get(source.BATCH_BYTES) == before
    got = source.page_lines(spark, f"file://{tmp_path}/pages", "page_id", "line_pos", "content").agg(
        F.count(F.lit(1)).alias("n"), F.sum("line_pos").alias("at"), F.sum(F.length("content")).alias("size")
    ).first()
    assert (got.n, got.at, got.size) == (60 * 400, 60 * 400 * 399 // 2, 60 * 400 * 500)
    seen = [row.split() for row in open(said).read().splitlines()]
    for side, rows in (("write", 60), ("read", 60 * 400)):
        own = [(int(n), int(size)) for kind, n, size in seen if kind == side]
        assert sum(n for n, _ in own) == rows and len(own) > 10 and max(size for _, size in own) < 3 * source.BATCH
    # a page or a line of more than a batch goes whole, and one without body is refused
    source.write_pages(spark.createDataFrame([("big", head + f"[l-0] {'x' * 3_000_000}\n[l-1] y\n")], "id string, body string"), f"file://{tmp_path}/big")
    assert [len(r.content) for r in source.page_lines(spark, f"file://{tmp_path}/big", "content").collect()] == [3_000_000, 1]
    with pytest.raises(Exception, match="page q has no body"):
        source.write_pages(spark.createDataFrame([("q", None)], "id string, body string"), f"file://{tmp_path}/none")
