"""The pipeline and the registered queries on a small folder of tables, against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from leafmill.llm import decontaminate, pii, quality, registry

random.seed(11)
VOCAB = ["".join(random.choices("abcdefghilmnoprstu", k=random.randint(2, 9))) for _ in range(400)]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(n=60):
    return " ".join(random.choices(VOCAB, k=n)) + "."


ITEMS = [(1, sentence(30)), (2, sentence(12)), (3, None), (4, "")]
BASE = sentence(100).split()


def rows():
    out = [(i, sentence(), "en", f"src{i % 3}") for i in range(150)]
    out += [(200 + i, " ".join(w + "%%%" for w in sentence().split()), "en", "src0") for i in range(20)]  # low quality
    out += [(300 + i, sentence() + " zorgle " + sentence() + " Zorgle!", "en", "src1") for i in range(20)]  # toxic
    out += [(400 + i, " ".join([*BASE[:90], f"end{i}", *BASE[91:]]), "en", "src2") for i in range(25)]  # near copies
    out += [(500 + i, out[3][1].upper(), "en", None) for i in range(3)]  # copies
    out += [(600, f"{sentence()} {ITEMS[0][1]} {sentence()}", "en", "src0"), (601, ITEMS[1][1] + " " + sentence(), "en", "src1")]
    out += [(700 + i, f"{sentence()} write to me{i}@site.example.org or 10.0.{i}.1 {sentence()}", "en", "src1") for i in range(6)]
    out += [(800, None, None, None), (801, "", "en", "src0"), (802, sentence(5000), "en", "src2"), (0, out[0][1], "en", "src0")]
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    docs.repartition(3).write.parquet(f"{place}/documents.parquet")
    labels = [(i, 1, 0) for i in range(0, 150, 2)] + [(200 + i, 0, 0) for i in range(10)] + [(300 + i, 1, 1) for i in range(12)] + [(None, 1, 1), (9999, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    vectors = [(i, [random.uniform(-1, 1) for _ in range(8)]) for i in range(120)]
    labelled = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("label", (F.col("vec_id") % 3).cast("int"))
    labelled.write.parquet(f"{place}/embeddings.parquet")
    pages = [(i, f"http://h{i % 3}.example.org/en/{i}", f"<nav>menu</nav><article><p>story {i} {sentence()}</p></article>") for i in range(20)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{place}/pages.parquet")
    return place


def contained(text):
    """Whether a text holds four fifths of a benchmark item's shingles."""
    words = decontaminate.words_of(text)
    for _, item in ITEMS:
        shingles = decontaminate.shingles_of(decontaminate.words_of(item), 5)
        own = {tuple(words[i : i + 5]) for i in range(len(words))}
        if shingles and 10 * len(shingles & own) >= 8 * len(shingles):
            return True
    return False


def firsts_of_near_copies(docs):
    """(doc_id, text) of the rows that no near copy of smaller id makes go."""
    sets = {d: decontaminate.shingles_of(decontaminate.words_of(t), 5) for d, t in docs}
    to = {d: d for d in sets}

    def root(x):
        while to[x] != x:
            x = to[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and (shared := len(sets[a] & sets[b])) and 10 * shared >= 8 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((root(a), root(b)))
                to[y] = x
    return sorted((d, t or "") for d, t in docs if root(d) == d)


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dup", "decontamination", "pii", "mixing"]
    found = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    step = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.keep(stage(spark, docs, folder), f"test-{name}")
        step[name] = docs
        if name != "mixing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    first = found(step["quality"])
    ids = Counter(d for d, _ in first)
    assert ids[0] == 2 and all(ids[i] for i in [*range(150), *range(400, 425), 600, 601, *range(700, 706), 802])
    assert not any(200 <= i < 220 or 300 <= i < 320 for i in ids)
    second = found(step["near_dup"])
    assert sorted((d, t or "") for d, t in second) == firsts_of_near_copies(first)
    assert 400 in dict(second) and 401 not in dict(second) and 500 not in dict(second)
    third = found(step["decontamination"])
    assert sorted((d, t or "") for d, t in third) == sorted((d, t or "") for d, t in second if not contained(t))
    assert not {600, 601} & {d for d, _ in third}
    fourth = dict(found(step["pii"]))
    assert set(fourth) == {d for d, _ in third} and not any(pii.base_spans(t or "") for t in fourth.values())
    assert all(t == fourth[d] for d, t in third if not pii.base_spans(t or "") and "[" not in (fourth[d] or "")) and "[EMAIL]" in fourth[700]
    sizes = Counter()
    for r in step["pii"].collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    taken = Counter()
    for r in step["mixing"].collect():
        assert len(WORD.findall(r.text)) == r.mix_words
        taken[r.source] += r.mix_words
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= len(sizes) and all(taken[s] <= 2 * sizes[s] for s in sizes)
    whole = corpus_pipeline.run(spark, folder)
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, step["mixing"].collect()))


def test_queries_on_a_folder(spark, folder):
    out = {name: query(spark, folder) for name, query in registry.QUERIES.items()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in out["op7_pii"].collect():
        spans = pii.base_spans(texts[r.doc_id])
        said = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest() and set(filter(None, said.split(","))) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in range(4)]
    judged = {r.doc_id: r for r in out["op10_quality"].collect()}
    kept = {r.doc_id for r in quality.accepted(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")).collect()}
    assert kept == {d for d, r in judged.items() if r.accepted}
    assert all(r.text.startswith(f"story {r.page_id} ") and r.n_chars == len(r.text) for r in out["op9_main_text"].collect())
    assert out["op6_near_duplicates"].where("kept <> (doc_id = component_id)").count() == 0
    assert out["op8_lm_score"].count() == len(rows()) and out["op2_top_k"].count() == 15
    assert {r.doc_id for r in out["op3_decontaminate"].collect()} == {600, 601}
    leaves = out["op11_merkle"].collect()
    assert len(leaves) == len(rows()) and len({r.root for r in leaves}) == 1 and all(r.verified for r in leaves)  # no text has a line end
    assert out["op12_whitening"].count() == 4 * 120 and out["op13_near_vectors"].where("kept = (vec_id = component_id)").count() == 120
