"""Operators on small tables: nulls, empty texts, ties, repeated rows, empty tables, clashing columns, brute force."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import decontaminate, html_text, lm_score, mixing, near_dup, pii, quality, secrets, topk, url_rules

random.seed(5)
VOCAB = [f"w{i}" for i in range(60)]


def words(n):
    return " ".join(random.choice(VOCAB) for _ in range(n))


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


# 1 mixing


def water(sizes, weights, share=1.5, most=2):
    target, free = {}, dict.fromkeys(sizes, 0)
    rest = share * sum(sizes.values())
    while free:
        w = sum(weights[s] for s in free)
        over = [s for s in free if rest * weights[s] / w > most * sizes[s]]
        if not over:
            target |= {s: rest * weights[s] / w for s in free}
            break
        for s in over:
            target[s] = most * sizes[s]
            del free[s]
        rest = share * sum(sizes.values()) - sum(v for k, v in target.items() if k not in free)
    return target


def test_mixing(spark):
    rows = [(i, words(random.randint(1, 40)), "abcd"[i % 7 % 4]) for i in range(300)]
    rows += [(900, None, "a"), (901, "", "b"), (902, words(9), None), (902, words(9), None), (903, words(3000), "a")]
    out = mixing.mix(docs(spark, rows)).select("doc_id", "source", "_size", "_z", "_target", "_drawn").collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for _, text, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate([*sorted(s for s in sizes if s), None])}
    goal, taken, blocks = water(sizes, weights), Counter(), set()
    for r in out:
        own = sum(d.words for d in r._drawn)
        assert own <= 2 * r._size and r._z == sizes[r.source] and r._target == pytest.approx(goal[r.source])
        taken[r.source] += own
        blocks.update(d.shard for d in r._drawn)
    assert all(abs(taken[s] - goal[s]) <= 1 for s in sizes) and len(blocks) == 4
    again = mixing.mix(docs(spark, rows[::-1])).select("doc_id", "_drawn").collect()
    total = lambda part: sorted((r.doc_id, sum(d.words for d in r._drawn)) for r in part)
    assert total(out) == total(again)
    mixed = mixing.mixed_rows(docs(spark, rows)).collect()
    assert all(len((r.text or "").split()) == r.mix_words for r in mixed)
    assert mixing.mix(docs(spark, [])).count() == 0 and mixing.mixed_rows(docs(spark, [(1, None, "a")])).count() == 0


def test_mixing_keeps_clashing_columns(spark):
    frame = docs(spark, [(i, words(9), "ab"[i % 2]) for i in range(40)]).select(
        "*", *(F.lit(f"mine {c}").alias(c) for c in ("_z", "size", "row", "stop", "off", "w", "mix_copy", "a.b"))
    )
    for out, said in ((mixing.mix(frame), "_z_in"), (mixing.mixed_rows(frame), "mix_copy_in")):
        row = out.first()
        assert row[said] == f"mine {said.removesuffix('_in')}"
        assert all(row[c] == f"mine {c}" for c in ("size", "row", "stop", "off", "w", "a.b"))


def test_splitting_tree(spark):
    root = spark.createDataFrame([([(0, 40), (2, 7), (3, 1)],)], "quotas array<struct<i:int,q:long>>")
    leaves = mixing.splitting_tree(root, 3, 1).collect()
    assert len(leaves) == 8 and [sum(x.q for r in leaves for x in r.quotas if x.i == i) for i in range(4)] == [40, 0, 7, 1]
    assert all(5 <= sum(x.q for x in r.quotas) <= 7 for r in leaves)
    blocks = sorted(map(tuple, mixing.permuted_blocks(spark.createDataFrame(leaves), 1).collect()))
    assert [b[:2] for b in blocks] == [(0, k) for k in range(40)] + [(2, k) for k in range(7)] + [(3, 0)]
    assert Counter(b[2] for b in blocks) == {r.shard: sum(x.q for x in r.quotas) for r in leaves}


def test_draws_are_hypergeometric(spark):
    quotas = F.expr("array(named_struct('i', 0, 'q', 30L), named_struct('i', 1, 'q', 12L), named_struct('i', 2, 'q', 6L))")
    out = spark.range(4000).withColumn("quotas", quotas)
    got = np.array([r[0] for r in out.select(mixing.drawn_left(F.col("quotas"), F.lit(20), F.col("id"), 5)).collect()])
    n, k = 48, 20
    for i, q in enumerate((30, 12, 6)):
        mean, variance = k * q / n, k * q / n * (1 - q / n) * (n - k) / (n - 1)
        assert abs(got[:, i].mean() - mean) < 4 * (variance / 4000) ** 0.5 and got[:, i].var() == pytest.approx(variance, rel=0.12)
    covariance = -k * (30 / n) * (12 / n) * (n - k) / (n - 1)
    assert np.cov(got[:, 0], got[:, 1])[0, 1] == pytest.approx(covariance, rel=0.15) and (got.sum(1) == 20).all()


# 2 top-k


def test_top_k(spark):
    rows = [(i, [random.uniform(-1, 1) for _ in range(6)]) for i in range(400)]
    rows += [(401, rows[3][1]), (402, rows[3][1]), (450, None), (500, [float("nan")] * 6), (550, [None] * 6), (50, rows[50][1])]
    rows += [(600, [2.0**60] * 6), (7, rows[7][1]), (650, [])]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    got = topk.top_k(frame.where("vec_id <> 600"), F.col("vec_id") % 50 == 0)
    fine = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows if v is not None and i != 600 and all(x is not None and np.isfinite(x) for x in v)}
    expected = []
    for q in (i for i in fine if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(fine[q], v, strict=False)), i) for i, v in fine.items() if i != q)[:5]
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert topk.top_k(frame.where("vec_id = 50"), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(frame.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_of_all_doubles(spark):
    rows = [(0, [1e308, -1e308, 0.3]), (1, [1.7e308, 0.0]), (2, [-1e-308, 2.0**-60, 1.0]), (50, [0.5, 0.25]), (3, [2.0**52 + 1, -0.001])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, vector array<double>"), F.col("vec_id") % 50 == 0).collect()
    whole = {i: [int(256 * Fraction(x) // 1) for x in v] for i, v in rows}
    clip = lambda x: min(max(x, -(1 << 63)), (1 << 63) - 1)
    expected = []
    for q in (0, 50):
        scores = sorted((-clip(sum(a * b for a, b in zip(whole[q], v, strict=False))), i) for i, v in whole.items() if i != q)
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert sorted(map(tuple, got)) == sorted(expected)


@pytest.mark.parametrize("size", [2.0**17, 2.0**60])
def test_top_k_of_large_components(spark, size):
    base = [(i, [size + random.randint(-9, 9) if size < 2**50 else size * random.choice((1, -1, 3)) for _ in range(16)]) for i in range(60)]
    frame = spark.createDataFrame(base, "vec_id long, vector array<double>")
    got = topk.top_k(frame, F.col("vec_id") % 50 == 0)
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in base}
    clip = lambda x: min(max(x, -(1 << 63)), (1 << 63) - 1)
    expected = []
    for q in (0, 50):
        scores = sorted((-clip(sum(a * b for a, b in zip(whole[q], v, strict=True))), i) for i, v in whole.items() if i != q)[:5]
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert sorted(map(tuple, got.collect())) == sorted(expected)


# 3 decontamination


@pytest.mark.parametrize("piece", [1 << 24, 60])
def test_decontaminate(spark, monkeypatch, piece):
    monkeypatch.setattr(decontaminate, "PIECE_BYTES", piece)
    items = [(1, words(20)), (2, words(40)), (3, "only three words"), (4, None), (5, ""), (6, words(12))]
    long = words(3000)
    rows = [(1, f"{long} {items[0][1].upper()} {long}", "a"), (2, items[1][1], "a"), (2, items[1][1], "a"), (3, None, "a"), (4, "", "a")]
    part = items[1][1].split()
    rows += [(5, " ".join([*part[:34], "other", *part[38:]]), "a"), (6, " ".join(part[:20]), "a"), (7, "x only three\twords y", "a"), (8, long, "a")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, decontaminate.contaminated_pairs(docs(spark, rows), bench).collect()))
    expected = []
    for i, text, _ in rows:
        w = decontaminate.words_of(text)
        for k, item in items:
            s = decontaminate.shingles_of(decontaminate.words_of(item), 5)
            if s:
                n = len(next(iter(s)))
                own = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)}
                if 10 * len(s & own) >= 8 * len(s):
                    expected.append((i, k, len(s), len(s & own)))
    assert got == sorted(expected) and {e[0] for e in expected} >= {1, 2, 7}
    kept = [r.doc_id for r in decontaminate.decontaminate(docs(spark, rows), bench).collect()]
    assert sorted(kept) == sorted(i for i, _, _ in rows if i not in {e[0] for e in expected})
    assert decontaminate.contaminated_pairs(docs(spark, rows), bench.where("false")).count() == 0


def test_decontaminate_sql(spark):
    import duckdb
    import pandas as pd

    rows = [(1, "a B c d e f g", "a"), (2, "x a b y", "a"), (3, "a b c d e f", "a"), (4, None, "a"), (5, "q", "a")]
    items = [(1, "a b c d e f g"), (2, "A b"), (3, "q"), (4, None), (5, " ")]
    found = decontaminate.contaminated_pairs(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame([r[:2] for r in rows], columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]))
    expected = con.sql(decontaminate.OP3_SQL).fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(expected) and {(1, 1), (2, 2), (5, 3)} <= {e[:2] for e in expected}


# 4 URL rules


def test_url_filter(spark):
    urls = [
        "http://A.Example.org/es/1", "https://example.org/en/17?x", "x://org/", "http://borg/", "http://shop.com/de/", "http://com/fr/x#y",
        "http://example.org", "http://example.org?x=/es/", "nothing", None, "http://a://b.org/", "http://example.org/en/1", "://x.example.org/es/",
    ]
    rows = [(i, u, "own") for i, u in enumerate(urls)] * 2
    frame = spark.createDataFrame(rows, "page_id long, url string, rule string")

    def judge(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.lower()
        fits = [(len(h + p), h + p, a) for a, h, p in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(fits)[1:] if fits else (None, "allow")))

    for size in (200_000, 2):
        got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_rules.url_filter(frame, url_rules.RULES, rules_per_pass=size).collect())
        assert [x[1:] for x in got] == [x[1:] for x in sorted(((i, *judge(u)) for i, u, _ in rows), key=lambda x: x[0])]
    assert url_rules.url_filter(frame.where("false"), url_rules.RULES).count() == 0
    out = url_rules.url_filter(frame.withColumn("_path", F.lit("p")).withColumn("_best_rule", F.lit("b")), url_rules.RULES)
    assert {(r.rule_in, r._path, r._best_rule) for r in out.collect()} == {("own", "p", "b")}


def test_url_rules_of_equal_length(spark):
    rules = [("allow", "org", "/x23456"), ("block", "a.org", "/x234")]
    frame = spark.createDataFrame([("http://a.org/x23456",)], "url string")
    for own in (rules, rules[::-1]):
        for size in (1, 2):
            row = url_rules.url_filter(frame, own, rules_per_pass=size).first()
            assert (row.rule, row.verdict) == ("a.org/x234", "block")
    assert len(url_rules.levels([("block", "h.org", f"/{i}") for i in range(200_000)])[0].paths) == 200_000


# 5 secrets


def brute_secrets(text):
    out = []
    for k, (kind, pattern, group, least) in enumerate(
        (("assign", secrets.RULES[0][2], 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32))
    ):
        out += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(out))


def test_secrets(spark):
    key = "0123456789abcdef" * 2
    texts = [
        f"é\U0001f600 token = \"{key}\" and AKIA{'A' * 12}!", "password: token: abcdefghij", "Password=short api_key:longenough1 passwd='x'",
        None, "", f"{key}\n{key}g{key[:-1]}", "AKIAAKIA" + "B" * 9, "secret = " + "z" * 5000, "SECRET:\"aaaaaaaa\" secret=bbbbbbbb",
    ]
    alphabet = ["token", "=", ":", " ", "secret", "abcdefgh", key, "AKIA", "ABCDEFGHIJKL", "'", "\"", "ß", "\n"]
    texts += ["".join(random.choices(alphabet, k=random.randint(0, 12))) for _ in range(150)]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(0, texts[0], "again")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, found string")
    out = secrets.secret_scan(frame).select("doc_id", "found", secrets.written(F.filter("_found", lambda s: s["rank"] < 3)).alias("s")).collect()
    assert len(out) == len(rows)
    assert {r.doc_id: r.s for r in out} == {i: brute_secrets(t or "") for i, t, _ in rows}
    more = secrets.secret_scan(spark.createDataFrame([(1, "-----BEGIN RSA PRIVATE KEY----- ghp_" + "G" * 36)], "doc_id long, text string"))
    assert [s.kind for s in more.first()._found] == ["pem", "ghtoken"]
    assert secrets.secret_scan(frame.where("false")).count() == 0


def test_ledger(spark):
    frame = spark.createDataFrame([(1, "token = abcdefgh1"), (2, "AKIA" + "A" * 12)], "doc_id long, text string")
    versions = frame.select(secrets.blob_of(F.col("text")).alias("blob"), "text")
    old = secrets.new_findings(versions, rules=secrets.RULES[:1])
    new = secrets.new_findings(versions, old, secrets.RULES).collect()
    assert all(r.scanned == [secrets.rule_id(x) for x in secrets.RULES[1:]] for r in new) and len(new) == 2
    assert secrets.new_findings(versions, old, secrets.RULES[:1]).count() == 0


def test_ledger_grows(spark, tmp_path):
    frame = spark.createDataFrame([(1, "token = abcdefgh1", "x"), (2, "AKIA" + "A" * 12, "x")], "doc_id long, text string, _found string")
    place = str(tmp_path / "ledger")
    said = lambda rules: {r.doc_id: r.s for r in secrets.secret_scan(frame, place, rules).select("doc_id", secrets.written(F.col("_found")).alias("s")).collect()}
    assert said(secrets.RULES[:1]) == {1: "assign:0:17", 2: ""}
    assert said(secrets.RULES) == {1: "assign:0:17", 2: "access:0:16"}
    before = spark.read.parquet(place).count()
    assert said(secrets.RULES) == {1: "assign:0:17", 2: "access:0:16"} and spark.read.parquet(place).count() == before == 4
    newer = [(secrets.RULES[0][0], 2, *secrets.RULES[0][2:]), *secrets.RULES[1:]]
    assert said(newer) == {1: "assign:0:17", 2: "access:0:16"}  # the older version's spans are out
    assert said(secrets.RULES[:0:-1]) == {1: "", 2: "access:0:16"}  # without a rule, and in another order
    assert {r._found_in for r in secrets.secret_scan(frame).collect()} == {"x"}


def test_second_scan_reads_unseen_texts_only(spark, tmp_path, monkeypatch):
    frame = spark.createDataFrame([(i, f"token = abcdefgh{i % 40}") for i in range(90)], "doc_id long, text string").repartition(4)
    place, read = str(tmp_path / "ledger"), []
    own = secrets.scan
    monkeypatch.setattr(secrets, "scan", lambda blobs, rules: read.append(blobs.count()) or own(blobs, rules))
    secrets.appended(frame.where("doc_id < 15"), place)
    found = secrets.secret_scan(frame, place)
    assert read == [15, 25] and found.count() == 90
    secrets.appended(frame, place, [*secrets.RULES, ("more", 1, "abc", 0, 0)])
    assert read[2] == 40
    pairs = spark.read.parquet(place).select("blob", F.explode("scanned").alias("r"))
    assert pairs.count() == pairs.distinct().count() == 40 * (len(secrets.RULES) + 1)


def test_many_secrets_in_a_text(spark):
    text = " ".join(f"token={i:08d}" for i in range(2000))
    found = secrets.secret_scan(spark.createDataFrame([(text,)], "text string")).first()._found
    assert [(s.start, s.end) for s in found] == [m.span() for m in re.finditer(r"token=\d{8}", text)]


# 6 near duplicates


def linked_by_brute_force(rows, width, num, den):
    """Shingle sets, and the least id that each id is linked with."""
    sets = {i: decontaminate.shingles_of(decontaminate.words_of(t), width) for i, t, _ in rows if i is not None}
    to = {i: i for i in sets}

    def root(x):
        while to[x] != x:
            x = to[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and den * len(shared := sets[a] & sets[b]) >= num * (len(sets[a]) + len(sets[b]) - len(shared)) and shared:
                x, y = sorted((root(a), root(b)))
                to[y] = x
    return sets, root


def test_near_duplicates(spark):
    base = [words(random.randint(3, 120)).split() for _ in range(25)]
    rows = []
    for i, b in enumerate(base):
        for _ in range(random.randint(1, 12)):
            w = list(b)
            for _ in range(random.randint(0, max(1, len(w) // 25))):
                w[random.randrange(len(w))] = random.choice(VOCAB)
            rows.append((len(rows), " ".join(w), "a"))
        if i == 0:
            rows += [(len(rows) + k, " ".join([*b[:-1], f"z{k}"]), "a") for k in range(60)]
    n = len(rows)
    rows += [(n, None, "a"), (n + 1, "", "a"), (n + 2, "two words", "a"), (n + 3, "Two\nWORDS", "b"), (0, rows[0][1], "a"), (n + 4, words(9000), "a"), (None, rows[0][1], "a")]
    turned = words(30)
    rows += [(n + 5, f"{turned} {turned} {turned}", "a"), (n + 6, f"{turned} {turned}", "a")]  # equal sets, other words
    frame = docs(spark, rows).withColumn("c", F.lit("clash")).withColumn("th", F.lit("mine")).withColumn("a.b", F.lit("dot"))
    got = near_dup.near_duplicates(frame, 3, 85, 100).collect()
    assert len(got) == len(rows)
    sets, root = linked_by_brute_force(rows, 3, 85, 100)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == {(i, len(s), root(i)) for i, s in sets.items()}
    kept = near_dup.without_near_duplicates(frame, 3, 85, 100)
    assert kept.columns == frame.columns
    found = kept.collect()
    assert {r.doc_id for r in found if r.doc_id is not None} == {i for i in sets if root(i) == i}
    assert {(r.c, r.th, r["a.b"]) for r in found} == {("clash", "mine", "dot")}
    assert near_dup.near_duplicates(frame.where("false"), 3, 85, 100).count() == 0


def test_near_misses_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 128)
    monkeypatch.setattr(near_dup, "FAN", 64)
    base, rows = words(100).split(), []
    for i in range(700):
        w = list(base)
        for at in random.sample(range(100), random.choice((1, 2, 3, 3, 4, 4, 5))):
            w[at] = f"x{i}.{at}"
        rows.append((i, " ".join(w), "a"))
    sets, root = linked_by_brute_force(rows, 3, 85, 100)
    got = near_dup.near_duplicates(docs(spark, rows), 3, 85, 100).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(i, root(i)) for i in sets}
    assert 10 < len({root(i) for i in sets}) < 600


def test_components(spark):
    n = 200
    path = [(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1002), (1000, 1002)]
    random.shuffle(path)
    out = near_dup.components(spark.createDataFrame(path, "a long, b long")).collect()
    assert len({r.root for r in out}) == 2 and len(out) == n + 4


# 7 personal data


def test_pii(spark):
    texts = [
        "mail a.b@c-d.example.com, 10.0.0.1 999.1.1.1 card 4111 1111 1111 1111 call +1 (212) 555-0100", "ééé \U0001f600 x@y.zz",
        None, "", "no data", "call +1 (826) 555-4081 190.137.2.4 now", "a@b@c.de 1.2.3.4.5.6.7.8 " + "9" * 4000,
    ]
    rows = [(i, t, "n_email") for i, t in enumerate(texts)] * 20 + [(99, words(20000) + " +44 20 7946 0958", "x")]
    frame = docs(spark, rows).withColumn("n_chars", F.length("text").cast("long"))
    clean = pii.redact(frame)
    assert clean.columns == frame.columns and clean.count() == len(rows)
    out = {r.doc_id: r for r in clean.collect()}
    assert "[EMAIL]" in out[0].text and "[IP]" in out[0].text and "999.1.1.1" in out[0].text and "[CARD]" in out[0].text and "[PHONE]" in out[0].text
    assert out[2].text is None and out[3].text == "" and out[4].text == "no data" and out[99].text.endswith("[PHONE]")
    assert all(r.text is None or r.n_chars == len(r.text) for r in out.values())
    assert pii.redact(frame.where("false")).count() == 0


def test_pii_base_is_brute_force():
    email, ip = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    digits = lambda s: re.sub("[^0-9]", "", s)
    for _ in range(4000):
        x = "".join(random.choice("a.@-+1290 5(b") for _ in range(random.randint(0, 40)))
        spans = [(0, *m.span()) for m in email.finditer(x)]
        spans += [(1, *m.span()) for m in ip.finditer(x) if all(int(p) <= 255 for p in m[0].split("."))]
        spans += [(2, *m.span()) for m in pii.CARD.finditer(x) if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
        spans += [(3, *m.span()) for m in pii.PHONE.finditer(x) if 9 <= len(digits(m[0])) <= 15]
        assert pii.base_spans(x) == spans, x


def test_emails_are_linear_and_windows_of_all_kinds(spark):
    start = time.perf_counter()
    assert pii.base_spans("@" * 400_000) == [] and time.perf_counter() - start < 1
    text = " ".join(f"m{i}@x.org" for i in range(300)) + " 10.0.0.1 x 4111 1111 1111 1111 x +1 (212) 555-0100 x 7"
    kinds = Counter(r["kind"] for r in pii.training_windows(docs(spark, [(1, text, "a")])).collect())
    assert kinds[0] >= 256 and all(kinds[k] == 1 for k in (1, 2, 3)) and kinds[4] > 0


def test_tagger_learns_and_gradients_hold():
    rng = np.random.default_rng(0)
    tagger = pii.Tagger(1)
    x, y = rng.integers(0, 22, (3, 7)), np.array([[0, 1, 2, 2, 0, 0, 3], [0] * 7, [7, 8, 8, 0, 5, 6, 0]])
    _, grads = tagger.step(x, y)
    for name, at in (("x", (0, x[0, 0], 3)), ("h", (1, 2, 5)), ("o", (4, 2)), ("t", (1, 2))):
        old = tagger.p[name][at]
        tagger.p[name][at] = old + 1e-5
        up = tagger.step(x, y)[0]
        tagger.p[name][at] = old - 1e-5
        down = tagger.step(x, y)[0]
        tagger.p[name][at] = old
        assert grads[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-5)
    texts = [f"{'ab cd ' * random.randint(0, 6)}+1 ({random.randint(200, 999)}) 555-{random.randint(1000, 9999)} ef gh" for _ in range(80)]
    tags = []
    for t in texts:
        tag = np.zeros(pii.WIDTH, np.int64)
        for k, a, b in pii.base_spans(t):
            tag[a:b] = 2 + 2 * k
            tag[a] = 1 + 2 * k
        tags.append(tag)
    xs = np.array([pii.padded(pii.classes_of(t), 0) for t in texts]).astype(int)
    learned = pii.Tagger(0)
    losses = learned.train(xs[:60], np.array(tags[:60]))
    assert losses[-1] < losses[0] / 10
    assert (learned.decode(xs[60:]) == np.array(tags[60:])).mean() > 0.98  # held out


# 8 language model


def test_lm_scores(spark):
    rows = [(i, words(random.randint(0, 60)).replace("w1", "É "), "a") for i in range(120)] + [(500, None, "a"), (7, "x", "a"), (501, "zzz\u20ac" * 900, "b")]
    out = lm_score.scored(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    import math
    import zlib

    train = [t or "" for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    c = Counter(w for t in train for w in tokens(t))
    n, v = sum(c.values()), len(c)
    expected = Counter()
    for i, t, _ in rows:
        w = tokens(t)
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        expected[(i, zlib.crc32(str(i).encode()) % 5 == 1, len(w), sum(c[x] > 0 for x in w), n, round(base, 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == expected
    assert all(r.score < 0 for r in out)
    assert lm_score.scored(docs(spark, []).where("false")).count() == 0
    none = lm_score.scored(docs(spark, [(i, "ab", "a") for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1])).first()
    assert none.base_score == 0 and none.score == pytest.approx(-3 * math.log10(257), rel=1e-5)


def ppm(counts, context, symbol):
    """Escapes and exclusions step by step, from a dict of context -> Counter."""
    p, excluded = 1.0, set()
    for k in range(len(context) + 1):
        seen = counts.get(context[k:], {})
        if not seen:
            continue
        left = {s: n for s, n in seen.items() if s not in excluded}
        total = sum(left.values()) + len(left)
        if symbol in left:
            return p * left[symbol] / total
        if total:
            p *= len(left) / total
        excluded |= set(seen)
    return p / (257 - len(excluded))


def step_by_step(texts):
    """Counts of all contexts of the training texts, and the log10 probability of a text by them."""
    symbols = lambda t: (256,) * 4 + tuple(t) + (256,)
    counts = {}
    for s in map(symbols, texts):
        for i in range(4, len(s)):
            for k in range(5):
                counts.setdefault(s[i - k : i], Counter())[s[i]] += 1
    return lambda t: sum(np.log10(ppm(counts, s[i - 4 : i], s[i])) for s in [symbols(t)] for i in range(4, len(s)))


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


@pytest.mark.parametrize("fan", [2, 256])
def test_scores_are_step_by_step_ppm(spark, monkeypatch, fan):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(lm_score, "FAN", fan)
    monkeypatch.setattr(lm_score, "CHUNK", 700)
    monkeypatch.setattr(lm_score, "MERGE", 500)
    rows = [(i, words(random.randint(0, 40)) + chr(200 + i) * (i % 5), "a") for i in range(150)]
    rows += [(900, None, "a"), (901, "q" * 5000 + words(50), "a"), (902, "abracadabra", "a"), (902, "abracadabra", "a"), (None, "abra", "a"), (903, "", "b")]
    score = step_by_step([(t or "").encode() for i, t, _ in rows if not held_out(i)])
    expected = {(i, round(score((t or "").encode()), 3)) for i, t, _ in rows}
    got = lm_score.scored(docs(spark, rows)).collect()
    assert {(r.doc_id, round(r.score, 3)) for r in got} == expected and len(got) == len(rows)
    blocks = lm_score.blocks_of(docs(spark, rows).selectExpr("doc_id", "false AS held_out", "coalesce(text, '') AS text"))
    held = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("k"), F.sum(F.octet_length("text")).alias("n")).collect()
    assert len(held) > 4 and all(b.n <= 2000 or b.k == 1 for b in held)


# 9 HTML


def main_text(html):
    return html_text.Page(html).main_text({})


def test_html():
    page = (
        "<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t=\"</p>\";</script></head><body><nav><ul><li>menu</li></ul></nav>"
        "<header><h1>Site</h1></header><div class='ad'>buy</div><article><h1>Head &amp; A&am</h1><p><b>One<br> two&nbsp;&eacute;<p>x < y &lt;z&gt;</p>"
        "<aside>side</aside><form><p>f</p></form><ul><li>i<li>j</ul><!-- no <p>no</p> --><div class=\"comments\"><p>c</p></div></article><footer>&copy;</footer>"
        "<div id=cookie-notice>ok</div></body></html>"
    )
    assert main_text(page) == "Head & A&am\nOne two é\nx < y <z>\ni\nj"
    assert main_text(None) == main_text("") == main_text("<nav>x</nav>") == ""
    assert main_text("plain  text") == "plain text"
    assert main_text("<div>a<span class=advert>b</span>c</div><p>d") == "ac\nd"
    assert main_text("<article><div class=section-header><h2>Real head</h2></div><p class=notice>n</p><math>x</math></article>") == "Real head\nn\nx"
    assert main_text("a < b <3 <p title='x>y'>c<q title=\"z>d<p") == "a < b <3\ncd<p"
    assert main_text("<article>" + "<p>w</p>" * 5000 + "<script>unclosed") == "\n".join(["w"] * 5000)


def test_names_do_not_decide_alone():
    assert main_text("<div id=social><article><p>whole article</p></article></div>") == "whole article"
    assert main_text("<article><div class=widget><p>First.</p></div><p>Next.</p></article>") == "First.\nNext."
    assert main_text("<article><h2 class=navigation>Head</h2><p>a <b class=ads>b</b> c</p></article>") == "Head\na b c"
    assert main_text("<div class=widget><p>all there is</p></div><nav>menu</nav>") == "all there is"
    # what names and HTML do set apart
    assert main_text("<article><p>a</p><div class=ad>buy</div><div class=comments><article><p>reader</p></article></div></article>") == "a"
    assert main_text("<ol class=commentlist><li><article class=x><p>reader</p></article></li></ol><p>text</p>") == "text"
    assert main_text("<aside><article><p>side</p></article></aside><div class=ad>buy</div><p>text</p>") == "text"


def test_nothing_goes_by_length():
    for n in (1, 10, 1000):
        assert main_text(f"<p>opening words</p><article><p>{'w ' * n}</p></article>") == " ".join(["w"] * n)
        assert main_text(f"<div class=text>{'w ' * n}</div><article><a href=x>see more</a></article>") == " ".join(["w"] * n) + "\nsee more"


def test_comments_end_as_html_says():
    assert main_text("<p>x</p><!-- c --!><p>y</p>") == main_text("<p>x</p><!--><p>y</p>") == main_text("<p>x</p><!---><p>y</p>") == "x\ny"
    assert main_text("<p>x</p><!-- a -- b - -> c --><p>y</p><!-- open") == "x\ny"


def test_markup_is_read_in_linear_time():
    for part in ("<a ", "<a '", "<a \">", "<b>", "<b><p>", "</b>", "<!", "<li><b>", "&amp", "<"):
        start = time.perf_counter()
        html_text.Page(part * (1_000_000 // len(part) // (8 if part.startswith(("<b", "<li")) else 1)))
        assert time.perf_counter() - start < 3, part


def test_style_tree_is_brute_force(spark):
    """Importance of each path of a small host, counted page by page."""
    pages = [f"<div class=top>same</div><article><p>own {i}</p><div class=x>{'again' if i else 'once'}</div></article>" for i in range(5)]
    got = html_text.low_paths(spark.createDataFrame([("h", p) for p in [*pages, pages[0]]], "host string, html string")).first()
    seen = {}
    for page in map(html_text.Page, pages):
        for path in {b.path for b in page.blocks}:
            blocks = {b.text for b in page.blocks if b.path == path}
            styles = {c for p, c in page.styles if p == path}
            seen.setdefault(path, ([], []))
            seen[path][0].append(blocks)
            seen[path][1].append(styles)
    expected = {}
    for path, (blocks, styles) in seen.items():
        m = len(blocks)
        entropy = lambda sets: 1 - sum(k * np.log(k) for k in c.values()) / (sum(c.values()) + 0.5) / np.log(m + 0.5) if (c := Counter(x for s in sets for x in s)) else 0  # noqa: E731, B023
        content, look = entropy(blocks), entropy(styles)
        weight = 0.9 ** len({x for s in styles for x in s})
        expected[path] = max(content, (1 - weight) * look + weight * content)
    low = {x.path: x.importance for x in got.low}
    assert low == pytest.approx({p: v for p, v in expected.items() if v < 0.5}) and 1 < len(low) < len(expected)


def test_doubtful_names_go_if_they_recur(spark):
    page = lambda i: f"<article><p class=notice>{'Read our rules' if i < 9 else 'Only here'}</p><p>story {i} {words(20)}</p></article>"
    rows = [(i, "http://h.example/x", page(i)) for i in range(9)] + [(9, "http://g.example/x", page(9))]
    out = {r.page_id: r.text for r in html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(out[i].startswith(f"story {i} ") for i in range(9)) and out[9].startswith("Only here\nstory 9 ")


def test_style_tree(spark):
    body = lambda i: f"<div class=top>Welcome to the site</div><div class=text><p>story {i} {words(8)}</p></div><div class=end>All rights</div>"
    rows = [(i, "http://h.example/x", body(i)) for i in range(30)] + [(90, None, "<p>alone</p>"), (91, "http://o.example/", None)]
    out = {r.page_id: r for r in html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(out) == len(rows)
    assert all(out[i].text.startswith(f"story {i} ") and "\n" not in out[i].text and out[i].n_chars == len(out[i].text) for i in range(30))
    assert out[90].text == "alone" and out[91].text == "" and out[91].n_chars == 0


def test_style_tree_of_copies_and_small_hosts(spark):
    page = lambda text: f"<div class=top>Welcome to the site</div><div class=text><p>{text}</p></div><div class=end>All rights</div>"
    rows = [(i, "http://copies.example/x", page("one and the same")) for i in range(200)]
    rows += [(1000 + i, "http://copies.example/x", page(f"story {i} {words(8)}")) for i in range(20)]
    rows += [(2000 + i, "http://few.example/x", page(f"story {i} {words(8)}")) for i in range(4)]
    # marks of many kinds beside plain ones: the presentation recurs, the text does not
    styled = lambda i: "<div class=text>" + "".join(f"<p>{'<b>x</b>' * j}{words(3)} {i} {j}</p>" for j in range(30)) + "</div>"
    rows += [(3000 + i, "http://styled.example/x", styled(i)) for i in range(9)]
    out = {r.page_id: r.text for r in html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(out[i] == "one and the same" for i in range(200))
    assert all(out[k].startswith("story ") and "\n" not in out[k] for k in [*range(1000, 1020), *range(2000, 2004)])
    assert all(out[3000 + i].count("\n") == 29 for i in range(9))


def test_style_tree_judges_marked_articles(spark):
    box = "<div class='box-x'>Get our letter each week</div>"
    page = lambda i: f"<main><article><h1>head {i}</h1><p>story {i} {words(20)}</p>{box}</article></main><div class=end>All rights</div>"
    rows = [(i, "http://h.example/x", page(i)) for i in range(12)]
    card = lambda i: f"<div class=text><p>body {i} {words(40)}</p></div><article><a href=x><h3>card {i}</h3><p>{words(90)}</p></a></article>"
    rows += [(100 + i, "http://cards.example/x", card(i)) for i in range(6)]
    # near copies of one article, judged by what such a branch holds elsewhere, and an article whose only page it is
    rows += [(200 + i, "http://near.example/x", f"<article><p>version {i}</p><div>one and the same long article</div></article>") for i in range(9)]
    rows += [(400 + i, f"http://h{i % 9}.example/x", f"<article><p>other {i}</p><div>{words(9)} {i}</div></article>") for i in range(60)]
    rows += [(300, "http://one.example/x", "<article><p>alone</p></article><p>no</p>")]
    out = {r.page_id: r.text for r in html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(out[i].startswith(f"head {i}\nstory {i} ") and out[i].count("\n") == 1 for i in range(12))
    assert all(out[100 + i].startswith(f"body {i} ") for i in range(6))
    assert all(out[200 + i] == f"version {i}\none and the same long article" for i in range(9))
    assert out[300] == "alone"


# 10 quality


def test_quality(spark):
    vocab = ["".join(random.choices("abcdefghilmnoprstu", k=random.randint(2, 9))) for _ in range(400)]
    sentence = lambda: " ".join(random.choices(vocab, k=60)) + "."
    rows = [(i, sentence(), "a") for i in range(240)]
    rows += [(300 + i, " ".join(w + "%%%" for w in sentence().split()), "a") for i in range(30)]
    rows += [(400 + i, "buy buy buy buy " * 40, "a") for i in range(20)]
    rows += [(500 + i, sentence() + " zorgle " + sentence() + " Zorgle!", "a") for i in range(40)]
    rows += [(600, None, "a"), (601, "", "a"), (602, sentence() * 300, "a"), (0, rows[0][1], "a")]
    labels = [(500 + i, 1, 1) for i in range(20)] + [(i, 1, 0) for i in range(60)] + [(500, 1, None), (None, 1, 1), (9999, 0, 1), (501, 1, 1)]
    frame = docs(spark, rows).withColumn("p_quality", F.lit("clash")).withColumn("_x", F.lit("x"))
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = quality.judged(frame, marked)
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(rows) and {(r.p_quality_in, r._x) for r in got.values()} == {("clash", "x")}
    assert all(got[i].p_quality > 0.5 and got[i].p_toxic < 0.5 for i in range(240))
    assert all(got[300 + i].p_quality < 0.5 for i in range(30)) and all(got[400 + i].p_quality < 0.5 for i in range(20))
    assert all(got[500 + i].p_toxic > 0.5 for i in range(40))  # half of them without a label
    kept = quality.accepted(frame, marked)
    assert kept.columns == frame.columns and kept.where("doc_id BETWEEN 300 AND 599").count() == 0
    assert {(r.p_quality, r._x) for r in kept.collect()} == {("clash", "x")}
    assert quality.accepted(frame.where("false"), marked.where("false")).count() == 0


def test_estimated_accuracies():
    rng = np.random.default_rng(3)
    bad = rng.random(4000) < 0.2
    votes = np.stack([np.where(bad, np.where(rng.random(4000) < hit, -1, 1), np.where(rng.random(4000) < 0.003, -1, 1)) for hit in (0.9, 0.6, 0.7)], 1)
    patterns, at, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    p = quality.estimated(patterns, n.astype(float))[at.ravel()]
    assert ((p > 0.5) == bad).mean() > 0.97


def test_digest_of_nothing():
    assert hashlib.sha256(pii.written([]).encode()).hexdigest().startswith("e3b0c442")
