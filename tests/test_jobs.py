import pytest
from pyspark.sql import functions as F

from corpusmill.params import Evaluation, Sampling, Selection, Settings, Style
from corpusmill.plans import jobs
from corpusmill.sources import tables as T
from corpusmill.sources.catalog import write_catalog
from corpusmill.sources.texts import read_text_files
from corpusmill.streaming.incremental import stream_features

SETTINGS = Settings(
    selection=Selection(language="de", keywords=("drama",), max_per_author=2, max_per_epoch=6, min_words=40, seed=3),
    sampling=Sampling(skip_fraction=0.1, sample_words=40), style=Style(window=10, min_mentions=1),
    evaluation=Evaluation(test_folds=3, cv_folds=2, seed=3, repeats=2, trees=5, max_iter=50))
MARK = "*** {} OF THE PROJECT GUTENBERG EBOOK X ***"


def sentence(i, n):
    return " ".join(f"wort{(i * 7 + j * j) % 23}" for j in range(n)) + ". "


def book_text(i):
    n = 5 if i % 10 == 9 else 60 + i
    body = "\n\n".join(f"Herr Effi{i % 3} und die Frau Anna kam.\n" + sentence(i + p, n // 6) for p in range(6))
    return f"Licence\n{MARK.format('START')}\n{body}\n{MARK.format('END')}\nMore"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("land")
    names = "text_no type title language authors subjects locc bookshelves".split()
    rows = [(str(i), "Text", f"Titel {i}", "de", f"Autor{i % 14}, Vorname, 1700-{1790 + (i % 14) * 12}",
             "", "PT", "") for i in range(60)]
    write_catalog(spark.createDataFrame(rows, names), str(root / "catalog"))
    (root / "texts").mkdir()
    for i in range(60):
        (root / "texts" / f"{i}.txt").write_text(book_text(i), encoding="utf-8")
    return root


@pytest.fixture(scope="module")
def corpus(spark, landed):
    candidates = jobs.build_candidates(spark, str(landed / "catalog"), str(landed / "candidates"), SETTINGS)
    texts = read_text_files(spark, str(landed / "texts")).withColumn("lang", F.lit("de"))
    return candidates, texts, jobs.build_corpus(candidates, texts, str(landed / "corpus"), SETTINGS)


def test_corpus_keeps_the_quotas(spark, landed, corpus):
    candidates, _, table = corpus
    assert candidates.count() == 60
    assert spark.read.option("header", True).csv(str(landed / "candidates_filter_counts")).count() == 7
    assert table.where(F.col("n_words") < 40).count() == 0
    assert table.groupBy("author").count().where("count > 2").count() == 0
    assert {r["epoch"]: r["count"] for r in table.groupBy("epoch").count().collect()} == {
        "Goethezeit": 6, "Realismus": 6, "Moderne": 6}


def test_features_resume(spark, landed, corpus, tmp_path):
    _, texts, table = corpus
    out = str(tmp_path / "features")
    some = table.where(F.col("epoch") == "Moderne")
    first = jobs.build_features(some, texts, out, SETTINGS).collect()
    both = jobs.build_features(table, texts, out, SETTINGS)
    assert {r["id"] for r in first} < {r["id"] for r in both.collect()}
    n = both.count()
    assert n == both.select("id").distinct().count() == jobs.samples(
        texts.join(table.select("id"), "id"), SETTINGS.sampling).count()
    assert jobs.build_features(table, texts, out, SETTINGS).count() == n
    row = both.orderBy("id").first()
    assert row["character_density"] > 0 and 0 < row["sttr"] <= 1
    lost = table.withColumn("id", F.col("id") + 1000)
    with pytest.raises(ValueError, match="no text"):
        jobs.build_features(lost, texts, out, SETTINGS)
    assert jobs.build_features(lost, texts, out, SETTINGS, strict=False).count() == n


def test_stream_equals_batch(spark, corpus, tmp_path):
    _, texts, _ = corpus
    texts = texts.select("id", "lang", "raw")
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    counts = []
    for part in (texts.where("id < 20"), None, texts.where("id >= 20"), texts.where("id < 5")):
        if part is not None:
            part.coalesce(1).write.mode("append").parquet(source)
        stream_features(spark, source, out, mark, SETTINGS).awaitTermination()
        counts.append(spark.read.parquet(out).count())
    batch = jobs.style_features(jobs.samples(texts, SETTINGS.sampling, keep=["lang"]), SETTINGS.style)
    assert counts[0] == counts[1] < counts[2] == counts[3]
    key = ["id", *T.FEATURE_COLUMNS]
    assert sorted(map(tuple, spark.read.parquet(out).select(key).collect())) == sorted(map(tuple, batch.select(key).collect()))


def test_analysis_writes_everything(spark, tmp_path):
    import random
    rng = random.Random(1)
    order = SETTINGS.epochs.order
    rows = [(i, f"a{i % 18}", order[i % 18 % 3], i % 3 + rng.random(), rng.random(), i % 18 % 3 + rng.random(), 1.0)
            for i in range(108)]
    features = spark.createDataFrame(rows, ["id", "author", "epoch", *T.FEATURE_COLUMNS])
    out = str(tmp_path / "results")
    jobs.run_analysis(features, out, SETTINGS)
    table = lambda name: spark.read.option("header", True).csv(f"{out}/{name}")
    assert table("epoch_distribution").count() == 3 and table("kruskal_tests").count() == 4
    assert table("feature_summary").count() == 12 and table("feature_boxes").count() == 12
    assert table("cv_results").count() == 8 and table("test_results").count() == 4
    assert table("reports").count() == 4 * 6 and table("confusion").count() == 4 * 9
    assert table("coefficients").count() == 12 and table("importance").count() == 4 and table("ablation").count() == 4
    record = spark.read.json(f"{out}/metrics").first()
    assert record["n_texts"] == 108 and record["n_authors"] == 18 and record["n_train"] + record["n_test"] == 108
    assert record["test_accuracy"] > record["baseline_test_accuracy"]
    assert table("misclassified").count() == round((1 - record["test_accuracy"]) * record["n_test"])
