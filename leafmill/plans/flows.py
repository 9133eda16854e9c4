"""Queries that run streams or machines over the driver's tables; importing this registers them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafmill.functions import content as C
from leafmill.functions import text as T
from leafmill.operators import checks as V
from leafmill.operators import corrections as R
from leafmill.operators import imaging
from leafmill.operators import machines as M
from leafmill.operators import maintained
from leafmill.operators import ordered as W
from leafmill.plans import outputs, records
from leafmill.plans.catalog import CONTROLS, ORACLES, QUERIES, Tables, clean_pages, query
from leafmill.shared import fresh
from leafmill.sources import archives, files, page_source
from leafmill.sources import pages as P
from leafmill.streaming import ingest as I

__all__ = ["ORACLES", "QUERIES", "records"]
FILES = 8
RECORD = "id long, recorded_at string, user_id long, event_type string, value double"


def record_files(t: Tables, folder: str) -> None:
    """Events as files of records of an ingest, every fifth of them twice, in another file."""
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    rows = t.events.select(F.col("event_id").alias("id"), stamp.alias("recorded_at"), "user_id", "event_type", "value")
    again = rows.where("id % 5 = 0").withColumn("file", F.pmod(F.col("id") + 3, F.lit(FILES)))
    rows = rows.withColumn("file", F.pmod("id", F.lit(FILES))).unionByName(again)
    rows.repartitionByRange(FILES, "file").write.partitionBy("file").json(folder)  # one file each


def ingest_run(t: Tables, folder: str) -> tuple[I.Status, StreamingQuery]:
    """A run of an ingest of the files of ``folder``, a file at a time."""
    source = t.spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).json(f"{folder}/in/*")
    status = I.Status(t.spark, f"{folder}/status.json", f"{folder}/log", RECORD)
    with I.state_partitions(t.spark, t.events.count()):
        return status, I.ingest(source, f"{folder}/log", f"{folder}/checkpoint", RECORD, status=status)


@query("SELECT event_id AS id, user_id, event_type, value FROM events")
def ingest_resumed(t: Tables) -> DataFrame:
    """The log of an ingest that was stopped after part of its files and went on (R1, R5, K6): each record once."""
    folder = fresh(t.spark, "ingest")
    record_files(t, f"{folder}/in")
    status, run = ingest_run(t, folder)
    while status.now["batches"] < 2 and not run.awaitTermination(0.05):
        pass
    status.stop(run)
    status, run = ingest_run(t, folder)
    status.wait(run)
    return I.existing(t.spark, f"{folder}/log", RECORD).select("id", "user_id", "event_type", "value")


@query(f"SELECT 'complete' AS state, CAST(0 AS BIGINT) AS interruptions, CAST({FILES} AS BIGINT) AS batches, count(*) AS rows, max(event_id) AS last_id FROM events")
def ingest_status(t: Tables) -> DataFrame:
    """The status document at the end of an ingest."""
    folder = fresh(t.spark, "ingest")
    record_files(t, f"{folder}/in")
    status, run = ingest_run(t, folder)
    status.wait(run)
    found = t.spark.read.schema("state string, interruptions long, batches long, rows long, last_id long").option("multiLine", True)
    return found.json(f"{folder}/status.json")


@query("""
WITH items AS (SELECT doc_id AS id FROM documents UNION SELECT page_id FROM pages),
files AS (SELECT doc_id AS id, sha256(text) AS sha256 FROM documents WHERE doc_id % 7 <> 3),
log AS (
  SELECT doc_id AS id, CASE WHEN quality = 0 THEN 'old' ELSE sha256(text) END AS sha256 FROM documents JOIN labels USING (doc_id)
)
SELECT CASE WHEN f.sha256 IS NULL THEN 'fetch' WHEN l.sha256 = f.sha256 THEN 'skip' ELSE 'recover' END AS disposition, count(*) AS n
FROM items LEFT JOIN files f USING (id) LEFT JOIN log l USING (id) GROUP BY 1""")
def ingest_dispositions(t: Tables) -> DataFrame:
    """What is to be done with each item, from the files that are there and the last record of each."""
    digest = F.sha2("text", 256)
    files = t.documents.where("doc_id % 7 <> 3").select(F.col("doc_id").alias("id"), digest.alias("sha256"))
    said = t.documents.join(t.labels, "doc_id").select(F.col("doc_id").alias("id"), digest.alias("own"), "quality")
    first = said.select("id", F.lit("a").alias("recorded_at"), F.lit("older").alias("sha256"))
    last = said.select("id", F.lit("b").alias("recorded_at"), F.when(F.col("quality") == 0, "old").otherwise(F.col("own")).alias("sha256"))
    items = t.documents.select(F.col("doc_id").alias("id")).union(t.pages.select("page_id")).distinct()
    return I.run_counters(I.dispositions(items, first.unionByName(last), files))


@query("""
WITH r AS (SELECT o_custkey, o_orderkey, o_orderpriority, o_orderstatus, o_orderdate,
                  first_value(o_orderstatus) OVER w AS first, row_number() OVER w AS i
           FROM orders WINDOW w AS (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey))
SELECT CAST(o_custkey AS VARCHAR) AS page_id, CAST(left(o_orderpriority, 1) AS BIGINT) AS issue_no, o_orderkey AS seq,
       CASE WHEN i = 1 THEN 'applied' WHEN first = o_orderstatus THEN 'repeated' ELSE 'conflict' END AS outcome FROM r""")
def corrections_once(t: Tables) -> DataFrame:
    """Orders as corrections of a customer's page, in files up to 60 days out of order: each issue applied once."""
    folder = fresh(t.spark, "corrections")
    day = F.unix_date(F.col("o_orderdate").cast("date"))
    rows = t.orders.select(
        F.col("o_custkey").alias("page_id"), F.left("o_orderpriority", F.lit(1)).cast("long").alias("issue_no"), F.array("o_orderstatus").alias("lines"),
        F.col("o_orderkey").alias("seq"), F.col("o_orderdate").cast("timestamp").alias("recorded_at"),
        (day + F.pmod(F.xxhash64("o_orderkey"), F.lit(60))).alias("arrived"),
    )
    span = rows.agg(F.min("arrived").alias("least"), F.max("arrived").alias("most"), F.max("recorded_at").alias("end"), F.count(F.lit(1)).alias("n")).first()
    width = (span["most"] - span["least"]) // FILES + 1 if span["most"] is not None else 1
    slots = F.floor((F.col("arrived") - F.lit(span["least"])) / width)
    each = max(1, span["n"] // FILES >> 18)
    for k in range(FILES):  # files whose times of change say the order in which the stream takes them
        own = rows.where(slots == k).drop("arrived")
        (own.coalesce(1) if each == 1 else own.repartition(each, "seq")).write.mode("append").json(f"{folder}/in")
    end = rows.limit(1).select(F.lit(None).cast("long").alias("page_id"), F.lit(0).alias("issue_no"), F.array(F.lit("")).alias("lines"), F.lit(0).alias("seq"), (F.lit(span["end"]) + F.expr("INTERVAL 200 DAYS")).alias("recorded_at"))
    end.coalesce(1).write.mode("append").json(f"{folder}/in")  # tells the stream that all before has come
    stream = t.spark.readStream.schema("page_id string, issue_no long, lines array<string>, seq long, recorded_at timestamp").option("maxFilesPerTrigger", 2 * each).json(f"{folder}/in")
    with I.state_partitions(t.spark, span["n"]):
        I.run_once(I.applied_once(stream, "recorded_at", "61 days", max(64, span["n"] >> 14)), f"{folder}/out", f"{folder}/checkpoint")
    return t.spark.read.schema(I.APPLIED).parquet(f"{folder}/out").where("page_id <> ''")


def correction_event() -> Column:
    """Events of users as what happens to a correction."""
    kinds = {"signup": "prepare", "error": "fail", "view": "flag", "click": "pass"}
    step = F.create_map(*(F.lit(x) for pair in kinds.items() for x in pair))
    late = F.when(F.col("value") < 10, "decide").when(F.col("value") < 40, "finalize").otherwise("publish")
    return F.when(F.col("event_type") == "purchase", late).otherwise(F.try_element_at(step, F.col("event_type")))


STEPS_SQL = ", ".join(f"('{s}', '{e}', '{to}')" for (s, e), to in M.CORRECTION_STEPS.items())


@query(f"""
WITH RECURSIVE steps AS (SELECT * FROM (VALUES {STEPS_SQL}) AS s(state, event, after)),
e AS (
  SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i,
         CASE event_type WHEN 'signup' THEN 'prepare' WHEN 'error' THEN 'fail' WHEN 'view' THEN 'flag' WHEN 'click' THEN 'pass'
              WHEN 'purchase' THEN CASE WHEN value < 10 THEN 'decide' WHEN value < 40 THEN 'finalize' ELSE 'publish' END END AS event
  FROM events
), g AS (
  SELECT user_id, event_id, i, 'new' AS state_before, coalesce(after, 'new') AS state, after IS NULL AS refused
  FROM e LEFT JOIN steps ON steps.state = 'new' AND steps.event = e.event WHERE i = 1
  UNION ALL
  SELECT e.user_id, e.event_id, e.i, g.state, coalesce(s.after, g.state), s.after IS NULL
  FROM g JOIN e ON e.user_id = g.user_id AND e.i = g.i + 1 LEFT JOIN steps s ON s.state = g.state AND s.event = e.event
)
SELECT event_id, state_before, state, refused FROM g""")
def correction_states(t: Tables) -> DataFrame:
    """The state of a user's correction after each event (R4, K11): a scan of transition maps."""
    machine = M.Machine(M.CORRECTION_STATES, M.CORRECTION_STEPS)
    hour = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600)
    known = M.machine_states(t.events, "user_id", "ts", "event_id", bucket=hour, event=correction_event(), machine=machine)
    return known.select("event_id", "state_before", "state", "refused")


@query(f"""
SELECT 'd' || doc_id AS page_id, 'human_checked' AS status, CAST(u.i - 1 AS INTEGER) AS line_pos, 'l-' || (u.i - 1) AS line_id, md5('x' || w[u.i] || '.') AS digest
FROM (SELECT doc_id, string_split(regexp_replace(regexp_replace(coalesce(text, ''), '{CONTROLS}', ' ', 'g'), '[*{{{{}}}}|]', '', 'g'), chr(10)) AS w FROM documents),
     unnest(range(1, len(w) + 1)) AS u(i)""".replace("{{", "{").replace("}}", "}"))
def page_source_lines(t: Tables) -> DataFrame:
    """All documents written as page files by the data source, and some columns of their lines read back by it."""
    folder = fresh(t.spark, "pages")
    page_source.write_pages(clean_pages(t.documents).select(F.concat(F.lit("d"), "path").alias("id"), "body"), folder)
    lines = page_source.page_lines(t.spark, folder, "page_id", "status", "line_pos", "line_id", "content")
    return lines.where("status = 'human_checked'").select("page_id", "status", "line_pos", "line_id", F.md5("content").alias("digest"))


WIDE, EDGE, RADIUS, LEAST = 32, 3, 6, 9
WEIGHTS_SQL = ", ".join(f"CAST({w!r} AS DOUBLE)" for w in W.reflected_weights())


def graymap(vector: Column) -> Column:
    """A picture of a vector as graymap bytes: a row for each component, ``WIDE`` pixels that follow from it."""
    pixel = lambda v, y, x: (F.floor(F.abs(v.cast("double")) * 256) * (x + 7) + y * 31) % 211
    row = lambda v, y: F.array_join(F.transform(F.sequence(F.lit(0), F.lit(WIDE - 1)), lambda x: F.lpad(F.hex(pixel(v, y, x)), 2, "0")), "")
    head = F.concat(F.lit(f"P5 {WIDE} "), F.size(vector).cast("string"), F.lit(" 255\n")).cast("binary")
    return F.concat(head, F.unhex(F.array_join(F.transform(vector, row), "")))


@query(f"""
WITH p AS (
  SELECT vec_id, len(embedding) AS n, list_transform(range(len(embedding)), lambda y: CAST(len(list_filter(range({EDGE}, {WIDE - EDGE}), lambda x:
    (CAST(floor(abs(CAST(embedding[y + 1] AS DOUBLE)) * 256) AS BIGINT) * (x + 7) + y * 31) % 211 < 105)) AS DOUBLE)) AS v FROM embeddings
), s AS (
  SELECT vec_id, n, list_transform(range(n), lambda i: round(list_sum(list_transform(range(33), lambda j: [{WEIGHTS_SQL}][j + 1] * v[CAST(
    CASE WHEN ((i + j - 16) % (2 * n) + 2 * n) % (2 * n) < n THEN ((i + j - 16) % (2 * n) + 2 * n) % (2 * n)
         ELSE 2 * n - 1 - ((i + j - 16) % (2 * n) + 2 * n) % (2 * n) END AS BIGINT) + 1])), 9)) AS smooth FROM p
), e AS (
  SELECT vec_id, n, smooth, u.i, CASE WHEN vec_id % 5 = 0 THEN 6.0::DOUBLE ELSE 6.0::DOUBLE + u.i * 52.0::DOUBLE / (vec_id % 5) END AS expected
  FROM s, unnest(range(vec_id % 5 + 1)) AS u(i)
), w AS (
  SELECT *, CAST(greatest(0, round_even(expected - {RADIUS}, 0)) AS BIGINT) AS a, CAST(least(n, round_even(expected + {RADIUS + 1}, 0)) AS BIGINT) AS b FROM e
), c AS (
  SELECT vec_id, i, CAST(round_even(expected, 0) AS BIGINT) AS plain, a + list_position(smooth[a + 1:b], list_max(smooth[a + 1:b])) - 1 AS snapped FROM w
), g AS (
  SELECT vec_id, list_reduce(list_prepend([]::BIGINT[], list([snapped, plain] ORDER BY i)),
    lambda done, x: CAST(list_append(done, CASE WHEN len(done) = 0 OR x[1] > done[-1] + {LEAST} THEN x[1] ELSE x[2] END) AS BIGINT[])) AS centres FROM c GROUP BY vec_id
)
SELECT vec_id, array_to_string(centres, ',') AS centres FROM g""")
def line_centres(t: Tables) -> DataFrame:
    """Line centres in pictures of all vectors, encoded as bytes and decoded again."""
    pictures = imaging.from_graymaps(t.embeddings.select("vec_id", graymap(F.col("embedding")).alias("content")), "content")
    box = F.struct(F.lit(0).alias("l"), F.lit(0).alias("t"), F.lit(WIDE).alias("r"), F.col("image.height").alias("b"))
    rows = imaging.row_profiles(pictures.withColumn("box", box), "image", "box", margin=EDGE)
    count = (F.col("vec_id") % 5 + 1).cast("int")
    centres = imaging.local_centres(F.col("profile"), F.lit(0), F.lit(6), F.lit(58), count, RADIUS, LEAST)
    return rows.select("vec_id", F.array_join(centres.cast("array<string>"), ",").alias("centres"))


@query("""
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS place, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem""")
def sorted_output(t: Tables) -> DataFrame:
    """Order lines in files of total order, and the place of each by its file and its row in it."""
    key = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    folder = fresh(t.spark, "sorted")
    outputs.write_sorted(t.lineitem.select(*key), folder, *key, files=FILES)
    return outputs.read_sorted(t.spark, folder).select("place", *key)


@query("""
WITH o AS (SELECT row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS place, o_custkey, o_orderkey FROM orders)
SELECT place, o_custkey, o_orderkey FROM o WHERE o_custkey BETWEEN 40 AND 90""")
def sorted_range(t: Tables) -> DataFrame:
    """Orders of a range of customers, read from the files whose keys meet it."""
    folder = fresh(t.spark, "sorted")
    outputs.write_sorted(t.orders.select("o_custkey", "o_orderkey"), folder, "o_custkey", "o_orderkey", files=4 * FILES)
    return outputs.read_sorted(t.spark, folder, (40,), (90,)).select("place", "o_custkey", "o_orderkey")


@query("""
SELECT printf('a%02d.zip', doc_id % 16) AS archive, 'd' || doc_id || '.txt' AS name, CAST(strlen(coalesce(text, '')) AS BIGINT) AS size, sha256(coalesce(text, '')) AS sha256,
       CAST(NULL AS VARCHAR) AS error FROM documents""")
def archive_members(t: Tables) -> DataFrame:
    """All documents as members of archives, found by the index and checked member by member."""
    folder = fresh(t.spark, "archives")
    content = F.coalesce("text", F.lit("")).cast("binary")
    rows = t.documents.select(F.format_string("a%02d", F.col("doc_id") % 16).alias("archive"), F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), content.alias("content"))
    archives.write_archives(rows, f"{folder}/zip").write.parquet(f"{folder}/written")
    found = archives.checked(archives.members(t.spark, f"{folder}/zip/*.zip"))
    return found.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "name", "size", "sha256", "error")


@query("""
SELECT user_id AS page, count(DISTINCT event_type) AS issues_applied, count(*) AS accepted_edits, count(DISTINCT CAST(floor(value) AS BIGINT)) AS distinct_lines,
       max(event_id) AS last_seq, strftime(arg_max(ts, event_id), '%Y-%m-%d') AS last_applied, 0::BIGINT AS wrong FROM events GROUP BY user_id""")
def merged_stats(t: Tables) -> DataFrame:
    """Statistics of half of the events, brought up to date by two quarters and proved against the whole."""
    day = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd")
    log = t.events.select(
        F.col("user_id").alias("page"), F.col("event_type").alias("issue"), F.floor("value").alias("line"), F.col("event_id").alias("seq"), day.alias("applied_at")
    )
    kept = maintained.aggregated(log.where("seq % 2 = 0"))
    for quarter in (1, 3):
        kept = maintained.merged(kept, log.where(F.col("seq") % 4 == quarter))
    wrong = maintained.differences(kept, log).agg(F.count(F.lit(1)))
    return kept.stats.withColumn("wrong", wrong.scalar())


@query("""
SELECT 'before' AS reader, lang, count(*) AS n, sum(doc_id) AS ids FROM documents WHERE doc_id % 2 = 0 GROUP BY lang
UNION ALL SELECT 'after', lang, count(*), sum(doc_id) FROM documents GROUP BY lang
UNION ALL SELECT 'parts', lang, count(*), sum(doc_id) FROM documents WHERE lang IS DISTINCT FROM 'de' OR doc_id % 3 = 0 GROUP BY lang""")
def published_versions(t: Tables) -> DataFrame:
    """What readers see who began before and after a version was published, and after one part was replaced (K5, K9)."""
    docs = t.documents.select("doc_id", "lang")
    home = outputs.Published(t.spark, fresh(t.spark, "published"))
    home.publish(docs.where("doc_id % 2 = 0"), "lang")
    readers = {"before": home.current()}
    home.publish(docs, "lang")
    readers["after"] = home.current()
    home.replace_parts(docs.where("lang = 'de' AND doc_id % 3 = 0"), "lang")
    readers["parts"] = home.current()
    seen = [
        frame.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids")).select(F.lit(name).alias("reader"), "lang", "n", "ids")
        for name, frame in readers.items()
    ]
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


@query("""
WITH r AS (SELECT event_id, props, event_id % 4 AS file, row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id) AS line_no FROM events)
SELECT file, line_no, event_id % 10 = 3 AS damaged, CASE WHEN event_id % 10 <> 3 THEN CAST(json_extract(props, '$.k') AS BIGINT) ELSE -1 END AS k FROM r""")
def malformed_records(t: Tables) -> DataFrame:
    """Properties of events as lines of files, every tenth cut short: records with their file and line, and the damaged lines."""
    folder = fresh(t.spark, "lines")
    said = F.when(F.col("event_id") % 10 == 3, F.expr("substring(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    rows = t.events.select((F.col("event_id") % 4).alias("file"), "event_id", said.alias("value"))
    rows.repartitionByRange(4, "file").sortWithinPartitions("file", "event_id").drop("event_id").write.partitionBy("file").text(folder)
    records, damaged = files.json_lines(t.spark, f"{folder}/*/*.txt", "k long")
    file = F.regexp_extract("file", r"/file=(\d+)/", 1).cast("long").alias("file")
    lost = damaged.select(file, "line_no", F.lit(True).alias("damaged"), F.lit(-1).cast("long").alias("k"))
    return records.select(file, "line_no", F.lit(False).alias("damaged"), "k").unionByName(lost)


CLEAN_LINES_SQL = f"""SELECT doc_id, source, len(string_split(regexp_replace(coalesce(text, ''), '{CONTROLS}', ' ', 'g'), chr(10))) AS n FROM documents"""


@query(f"""
WITH d AS ({CLEAN_LINES_SQL})
SELECT 'V2' AS rule, count(*) AS n FROM d WHERE doc_id % 7 = 2
UNION ALL SELECT 'V15', coalesce(sum(n), 0)::BIGINT FROM d WHERE source = 'src3' AND doc_id % 7 <> 2
UNION ALL SELECT 'V21', coalesce(sum(n), 0)::BIGINT FROM d WHERE doc_id % 11 = 3
UNION ALL SELECT 'V23', coalesce(sum(n), 0)::BIGINT FROM d WHERE doc_id % 13 = 5
UNION ALL SELECT 'V24', count(*) FROM d WHERE doc_id % 17 = 7 AND n > 1""")
def damaged_pages(t: Tables) -> DataFrame:
    """Rules that pages of documents keep by themselves, over pages damaged in each way."""
    pages = clean_pages(t.documents, "doc_id", "source")
    unfenced = F.replace("body", F.lit("\n---\n\n##"), F.lit("\n\n##"))
    labelled = F.regexp_replace("body", r"(?m)^\[l-(\d+)\] x", r"[l-$1] {m}x")
    body = F.when(F.col("doc_id") % 7 == 2, unfenced).when(F.col("source") == "src3", labelled).otherwise(F.col("body"))
    of_text = V.page_violations(pages.select("path", body.alias("body")), ["V2", "V15"])
    lines = P.registry(P.compiled(clean_pages(t.documents))).withColumn("k", F.substring("page_id", 2, 20).cast("long"))
    other = F.transform("runs", lambda r: r.withField("layout", F.lit("other")))
    lines = lines.withColumns(
        {
            "indent": F.when(F.col("k") % 11 == 3, -1).otherwise(F.col("indent")),
            "runs": F.when(F.col("k") % 13 == 5, other).otherwise(F.col("runs")),
            "line_ref": F.when(F.col("k") % 17 == 7, F.col("page_id")).otherwise(F.col("line_ref")),
        }
    )
    of_runs = V.run_violations(lines, ["V21", "V23", "V24"])
    return V.counts(of_text.unionByName(of_runs), ["V2", "V15", "V21", "V23", "V24"])


@query("""
WITH c AS (SELECT conv_id, turn, nfc_normalize(text) AS x FROM conversations)
SELECT conv_id, turn, CASE turn % 6 WHEN 0 THEN 'applied' WHEN 1 THEN 'held' WHEN 2 THEN 'mismatch' WHEN 3 THEN 'unknown_line' WHEN 4 THEN 'already' ELSE 'invalid' END AS outcome,
       CASE WHEN turn % 6 = 0 THEN md5(x || '!') WHEN turn % 6 <> 3 THEN md5(x) END AS digest
FROM c""")
def change_outcomes(t: Tables) -> DataFrame:
    """Turns as lines, and a change to each that applies, waits, or cannot be."""
    said = t.conversations.select("conv_id", "turn", F.concat_ws(":", "conv_id", "turn").alias("line_ref"), T.nfc("text").alias("x"))
    k, x, none = F.col("turn") % 6, F.col("x"), F.lit(None).cast("string")
    run = F.struct(F.lit("roman").alias("typeface"), x.alias("text"), none.alias("placement"), none.alias("layout"), F.lit(None).cast("int").alias("line_span"), none.alias("span_id"))
    lines = said.where("turn % 6 <> 3").select("line_ref", F.array(run).alias("runs"))
    before = F.when(k == 2, F.concat(F.lit("~"), x)).when(k == 4, "another text").otherwise(x)
    after = F.when(k == 4, x).when(k == 5, F.concat(x, F.lit(" ]"))).otherwise(F.concat(x, F.lit("!")))
    changes = said.select("conv_id", "turn", "line_ref", before.alias("before"), after.alias("after"), F.when(k == 1, "why").alias("comment"), F.lit(None).cast("boolean").alias("second_opinion"))
    return R.applied(lines, changes).select("conv_id", "turn", "outcome", F.md5(C.line_text(F.col("new_runs"))).alias("digest"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, p_name || ' \"x\", y' AS name, p_brand AS brand, sep FROM part, (VALUES ('tab'), ('comma')) s(sep)")
def delimited_files(t: Tables) -> DataFrame:
    """Parts as delimited files, bare with tabs and quoted with commas, read back under the same header."""
    folder, columns = fresh(t.spark, "delimited"), ["id", "name", "brand"]
    rows = t.part.select(F.col("p_partkey").cast("string").alias("id"), F.concat("p_name", F.lit(' "x", y')).alias("name"), F.col("p_brand").alias("brand"))
    out = []
    for name, sep, quote in (("tab", "\t", ""), ("comma", ",", '"')):
        rows.write.options(sep=sep, header=True, quote=quote, escape=quote).csv(f"{folder}/{name}")
        out.append(files.delimited(t.spark, f"{folder}/{name}", columns, sep).withColumn("sep", F.lit(name)))
    return out[0].unionByName(out[1])


@query("""
SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN NULL WHEN 1 THEN 'needs exactly one JSON block' WHEN 2 THEN 'needs exactly one JSON block' ELSE 'block is not JSON' END AS error,
       CASE WHEN turn % 4 = 0 THEN conv_id * 100 + turn ELSE -1 END AS page FROM conversations""")
def fenced_payloads(t: Tables) -> DataFrame:
    """Turns that hold a payload in one block, in none, in two, or one that is broken."""
    block = F.concat(F.lit('\n```json\n{"page": '), (F.col("conv_id") * 100 + F.col("turn")).cast("string"), F.lit("}\n```\n"))
    broken = F.replace(block, F.lit("}"), F.lit(""))
    body = F.concat(F.replace("text", F.lit("`"), F.lit("'")), F.element_at(F.array(block, F.lit(""), F.concat(block, block), broken), (F.col("turn") % 4 + 1).cast("int")))
    found = files.fenced_json(t.conversations.select("conv_id", "turn", body.alias("body")), "body", "page long")
    return found.select("conv_id", "turn", "error", F.coalesce("payload.page", F.lit(-1)).alias("page"))


@query("SELECT 'u' || o_custkey AS id, o_orderkey AS line, o_orderstatus AS state FROM orders")
def side_records(t: Tables) -> DataFrame:
    """Orders as one JSON document a customer, each with an array of records, read as rows (S3)."""
    folder = fresh(t.spark, "side")
    record = F.struct(F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("id"), F.col("o_orderkey").alias("line"), F.col("o_orderstatus").alias("state"))
    customers = t.orders.groupBy("o_custkey").agg(F.collect_list(record).alias("pages")).select("pages")
    customers.write.json(folder)
    return files.side_table(t.spark, folder, "id:string,line:long,state:string", one_a_line=True)


@query("""
SELECT conv_id, turn, coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
       sum(length(coalesce(text, ''))) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS stop
FROM conversations""")
def concat_index(t: Tables) -> DataFrame:
    """Where each turn begins and ends in the whole text of its conversation."""
    size = F.length(F.coalesce("text", F.lit("")))
    known = W.running_total(t.conversations, "conv_id", "turn", "role", "text", bucket=F.floor(F.col("turn") / 64), value=size)
    return known.select("conv_id", "turn", "start", (F.col("start") + size).alias("stop"))


@query("""
WITH l AS (SELECT l_orderkey * 1000003 - 40000000000 + l_linenumber AS id, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (ORDER BY id, l_partkey, l_suppkey) AS rank FROM l""")
def sparse_rank(t: Tables) -> DataFrame:
    """Order lines ranked by ids that lie far apart, some of them negative."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_orderkey") * 1000003 - 40000000000 + F.col("l_linenumber")).alias("id"))
    return W.global_rank(rows, "id", ["l_partkey", "l_suppkey"]).drop("id")
