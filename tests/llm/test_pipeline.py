"""Stages of the pipeline against brute force, and on clean rows."""

import random
import re
import shutil
import subprocess
import sys

import corpus_pipeline
import pytest
import xxhash

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SAMPLE = "/root/testdata/sf0.001"


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(LOWER))
    runs = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.fixture(scope="module")
def copies():
    """Texts in pairs of similarity 0.5 to 1, and texts alone."""
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdef", k=draw.randint(2, 8))) for _ in range(2000)]
    rows = []
    for i in range(150):
        text = draw.choices(words, k=draw.randint(60, 400))
        near = [w if draw.random() > draw.choice([0.005, 0.02, 0.06]) else "other" for w in text]
        rows += [(i, " ".join(text)), (1000 + i, " ".join(near).upper())]
    return [*rows, (None, "a b c"), (None, "a b d"), (2000, ""), (2001, None), (2002, " \n")]


def one_of_each_group(rows):
    """Rows with the least id (nulls last) of their group of linked fingerprints."""
    prints = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (doc_id, text) in zip(group, rows):
        at = (doc_id is None, doc_id or 0, text is None, text or "")
        least[g] = min(least.get(g, at), at)
    return [(None if at[0] else at[1], None if at[2] else at[3]) for at in least.values()]


def test_near_duplicates_as_in_brute_force(spark, copies):
    docs = spark.createDataFrame(copies, "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    want = one_of_each_group(copies)
    assert sorted(map(repr, map(tuple, kept))) == sorted(map(repr, want))
    assert len(copies) - 100 < len(want) < len(copies) - 5


FOREIGN = [
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом",
    "Привет, мир",
    "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心",
    "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni",
    "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek ésszel",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu",
    "xqzj vbkw zzkx qqwv jxkz vvbq wxzq kkjq",
]
SHORT = ["A.|All rights reserved.", "Les.", "And ornd.", "The end"]


def test_foreign_texts_go_and_short_ones_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = [(10**9 + i, t) for i, t in enumerate([*FOREIGN, *SHORT, "123 !", "", None])]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    every = docs.unionByName(more, allowMissingColumns=True)
    kept = corpus_pipeline.language(spark, every, "")
    assert kept.schema == every.schema
    assert {r.text for r in kept.where(f"doc_id >= {10**9}").collect()} == {*SHORT}
    lettered = docs.where("text rlike '[A-Za-z]'").count()
    assert kept.where(f"doc_id < {10**9}").count() == lettered


def folder(tmp_path, spark, docs):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    shutil.copy(f"{SAMPLE}/benchmark.parquet", tmp_path / "benchmark.parquet")
    return str(tmp_path)


def test_the_whole_pipeline_on_planted_rows(spark, tmp_path):
    """Each stage's rows go, its decisions take effect, and clean documents stay."""
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    item = max(spark.read.parquet(f"{SAMPLE}/benchmark.parquet").collect(), key=lambda r: len(r.text))
    words = [w for r in docs.collect() if r.text and r.lang == "en" for w in r.text.split()][:5000]
    draw = random.Random(6)
    body = lambda n: " ".join(draw.choices(words, k=n))
    passage, clean = body(70), [body(4000), *(body(300) for _ in range(19))]
    near = clean[0].split()
    near[150] = "other"
    planted = [*((10**6 + i, t) for i, t in enumerate(clean))]
    planted += [(2 * 10**6, clean[1]), (2 * 10**6 + 1, " ".join(near)), (3 * 10**6, FOREIGN[0])]
    planted += [(4 * 10**6, body(60) + "\n" + item.text), (5 * 10**6, "123"), (5 * 10**6 + 1, None)]
    planted += [(6 * 10**6 + i, f"{body(200)}\n{passage}") for i in range(3)]
    planted.append((None, body(100)))
    more = spark.createDataFrame(planted, "doc_id long, text string")
    more = docs.unionByName(more, allowMissingColumns=True).selectExpr("*", "lang as h1", "lang as maybe")
    path = folder(tmp_path, spark, more)
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, path).collect() if r.doc_id is None or r.doc_id >= 10**6}
    assert {*out} == {None, *range(10**6, 10**6 + 20), *range(6 * 10**6, 6 * 10**6 + 3)}
    assert all(out[10**6 + i].decoded == t for i, t in enumerate(clean))
    holding = [i for i in range(3) if passage in out[6 * 10**6 + i].decoded]
    assert holding == [0]
    assert all(r.n_tokens == len(r.ids) > 0 for r in out.values())


def test_the_whole_pipeline_on_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet").limit(0)
    found = corpus_pipeline.run(spark, folder(tmp_path, spark, docs))
    assert found.columns == ["doc_id", "n_tokens", "ids", "decoded"] and found.collect() == []


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Queries with broadcast models, where only the driver has the package."""
    root = corpus_pipeline.__file__.rsplit("/", 1)[0]
    script = tmp_path / "run.py"
    script.write_text(f"""
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config(map={{"spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": {str(tmp_path / "shared")!r}}}).getOrCreate()
def missing(_):
    import importlib.util
    yield importlib.util.find_spec("clickspark") is None
assert spark.sparkContext.parallelize([0], 1).mapPartitions(missing).collect() == [True]
sys.path.insert(0, {root!r})
import __spark_entry__
queries = __spark_entry__.queries()
for name in ("op4_sentencepiece", "op5_decontamination", "op7_language_id", "op8_toxicity",
             "op11_embedding_whitening", "op12_html_extraction", "op13_conversation_trie"):
    queries[name](spark, {SAMPLE!r}).write.format("noop").mode("overwrite").save()
print("all ran")
""")
    ran = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=400)
    assert "all ran" in ran.stdout, ran.stderr[-3000:]


def test_the_language_stage_keeps_what_the_regression_names():
    from clickspark.llm import language_id

    en = ["the cat sat on the mat and then it slept", "where is the house of the old man", "we went to the shop"]
    fr = ["le chat est sur la table et il dort", "où est la maison du vieil homme", "nous sommes allés au marché"]
    model = language_id.fit_sample([*en, *fr], ["en"] * 3 + ["fr"] * 3, landmarks=6, ridge=0.01)
    texts = ["the old man went to the house", "le vieil homme est dans la maison", "123 !", "", None]
    langs, _ = language_id.scores(model, texts)
    kept = language_id.in_language(model, texts, 0.99)
    assert list(kept) == [lang != language_id.UNKNOWN for lang in langs] == [True, True, False, False, False]
    assert not language_id.in_language(language_id.fit_sample([], [], 6, 0.01), texts, 0.99).any()


def test_the_limit_is_measured_on_all_rows(spark):
    """Also on rows beyond a sample's, and on texts of any length."""
    import numpy as np

    from clickspark.llm import language_id

    en = ["the cat sat on the mat and then it slept", "where is the house of the old man", "we went to the shop"]
    fr = ["le chat est sur la table et il dort", "où est la maison du vieil homme", "nous sommes allés au marché"]
    model = language_id.fit_sample([*en, *fr], ["en"] * 3 + ["fr"] * 3, landmarks=6, ridge=0.01)
    long = "the cat sat on the mat " * 1_000 + "zyx wvu kjq " * 40
    texts = [*(en * 1_000), long, long.replace("wvu", "xxq"), "qqq zzz " * 30, "ww xx jj kk " * 30, "vv uu " * 30]
    rows = [(k, t, "en") for k, t in enumerate(texts)]
    odd = [(None, "zzz " * 50, "en"), (-1, None, "en"), (-2, "12 !", "en"), (-3, "", "en"), (-4, "zz " * 50, "de"), (-5, "zz " * 50, None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    want = np.quantile(language_id.strangeness(model, texts), 0.999)
    assert language_id.fit_limit(model, docs, margin=0.0) == pytest.approx(want) and want > 0.05
    assert language_id.fit_limit(model, docs.limit(0)) == 0.1
    none = language_id.fit_sample([], [], 6, 0.01)
    assert language_id.fit_limit(none, docs) == 0.1
