import numpy as np
import pytest
from pyspark.sql import functions as F

from gapmend.llm.language import TextModel, identify, learn_texts, page_evidence
from gapmend.llm.quality import Entries, SIZE, fitted, held_out, quality_scores, train
from gapmend.llm.url_filter import (
    LABELLED, RULES, grams, host_and_path, judge_urls, labelled_urls, train as train_urls,
)
from tests.llm.cases import documents, odd_documents

SF = "/root/testdata/sf0.1"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# Quality


@pytest.fixture(scope="module")
def machine(spark):
    return train(table(spark, "documents"), table(spark, "labels"))


def test_held_out_quality(spark, machine):
    found = quality_scores(table(spark, "documents"), machine).join(table(spark, "labels"), "doc_id").filter("held_out")
    rows = found.select("quality", "predicted", "score").toPandas()
    assert len(rows) > 500 and rows.score.between(0, 1).all()
    assert (rows.predicted == rows.quality).mean() > 0.98
    assert rows[rows.quality == 1].predicted.mean() > 0.99


def test_scores_depend_on_text_and_length_alone(spark, machine):
    docs = table(spark, "documents").limit(300)
    other = docs.withColumns({"doc_id": F.col("doc_id") + 10**6, "lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    scores = [dict(quality_scores(d, machine).select(F.col("doc_id") % 10**6, "score").collect()) for d in (docs, other)]
    assert scores[0] == scores[1]


def test_quality_of_odd_documents(spark, machine):
    df = odd_documents(spark)
    rows = quality_scores(df, machine).collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert len({r.score for r in rows if r.doc_id == 3}) <= 2
    assert quality_scores(documents(spark, []), machine).count() == 0


def test_held_out_is_a_fifth(spark):
    import zlib

    rows = spark.range(500).select("id", held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)
    assert not spark.sql("SELECT CAST(NULL AS bigint) AS id").select(held_out("id")).first()[0]


def test_training_on_little(spark):
    df = odd_documents(spark)
    for labels in ([], [(3, 1), (3, 0), (4, None), (None, 1), (99, 1)], [(i, 1) for i in range(15)]):
        labelled = spark.createDataFrame(labels, "doc_id bigint, quality int").withColumn("text", F.lit("clash"))
        rows = quality_scores(df, train(df, labelled)).collect()
        assert all(0 <= r.score <= 1 for r in rows)
    assert min(r.score for r in rows) > 0.5


def test_pairs_are_scored_as_written_out():
    random = np.random.default_rng(2)
    machine = fitted(Entries(np.zeros(1, int), np.zeros(0, np.int32), np.zeros(0, np.float32)), np.zeros(0))
    machine.vectors[:] = random.normal(0, 0.3, machine.vectors.shape)
    machine.linear[:] = random.normal(0, 0.3, SIZE)
    index, value = random.choice(SIZE, 6, replace=False), random.random(6).astype(np.float32)
    x = Entries(np.array([0, 6]), index.astype(np.int32), value)
    pairs = sum(
        machine.vectors[index[i]] @ machine.vectors[index[j]] * value[i] * value[j] for i in range(6) for j in range(i)
    )
    assert np.isclose(machine.parts(x)[0][0], machine.bias + machine.linear[index] @ value + pairs, atol=1e-4)


# URLs


ODD_URLS = [
    (None, ("", "", None)),
    ("no scheme/en/1", ("", "", None)),
    ("http://", ("", "", None)),
    ("HTTP://WWW.Example.ORG/en/12?x#y", ("www.example.org", "/en/12", "example.org/en/1")),
    ("https://a.example.org/es/", ("a.example.org", "/es/", "example.org/es/")),
    ("https://example.org/fr/", ("example.org", "/fr/", "org/")),
    ("https://notexample.org/es/1", ("notexample.org", "/es/1", "org/")),
    ("https://x.com/fr/1", ("x.com", "/fr/1", "com/fr/")),
    ("https://x.com/de/#a", ("x.com", "/de/", "com/de/")),
    ("https://xcom/fr/1", ("xcom", "/fr/1", None)),
    ("https://x.org", ("x.org", "", None)),
    ("https://x.com?u=http://y.org/a", ("x.com", "", None)),
    ("https://É.net/ü", ("É.net", "/ü", None)),
    ("a://b://c/d", ("b:", "//c/d", None)),
]


def test_odd_urls(spark):
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(ODD_URLS)] + [(0, None)], "page_id bigint, url string")
    df = df.selectExpr("*", "'x' AS host", "'y' AS path", "1 AS score", "2 AS grams")
    rows = judge_urls(df, labelled_urls(spark)).collect()
    assert len(rows) == len(ODD_URLS) + 1
    kinds = {text: kind for kind, text in RULES}
    for r in rows:
        assert (r.host, r.path, r.rule) == ODD_URLS[r.page_id][1]
        assert r.verdict == (kinds[r.rule] if r.rule else "block" if r.score >= 0.5 else "allow")
    assert judge_urls(df.limit(0), labelled_urls(spark)).count() == 0


def test_training_takes_one_document_of_each_id(spark):
    """Repeated rows and ids neither count more nor come to the driver."""
    texts = [f"{'good words here' if i % 2 else 'bad spam now'} {i} " * 9 for i in range(40)]
    labelled = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    once = documents(spark, texts)
    more = documents(spark, [(1, texts[1])] * 300 + [(3, "z" + texts[3])] * 5)
    alone, repeated = (quality_scores(once, train(df, labelled)).orderBy("doc_id").collect() for df in (once, once.unionByName(more)))
    assert [r.score for r in alone] == [r.score for r in repeated]


def test_training_is_gradient_descent(spark):
    """Against the same steps in numpy."""
    from gapmend.llm import url_filter as f

    host, path = host_and_path(F.col("url"))
    rows = labelled_urls(spark).select("url", "label", grams(host, path, f.BUCKETS).alias("g")).orderBy("url").collect()
    weights, rate = np.zeros(f.BUCKETS + 1), f.RATE
    seen = np.zeros(f.BUCKETS + 1, bool)
    seen[-1] = True
    for r in rows:
        seen[r.g] = True
    for _ in range(f.ROUNDS):
        for r in rows:
            scale = 1 / np.sqrt(len(r.g))
            change = rate * (r.label - 1 / (1 + np.exp(-(weights[-1] + weights[r.g].sum() * scale))))
            weights *= 1 - f.DECAY
            weights[r.g] += change * scale
            weights[-1] += change
    assert np.allclose(train_urls(labelled_urls(spark)), np.where(seen, weights, 0), atol=1e-8)


def test_known_kinds_of_hosts(spark):
    pages = table(spark, "pages")
    rows = judge_urls(pages, labelled_urls(spark)).filter("rule IS NULL").toPandas()
    bad = rows.host.str.contains("casino|pills|adult|bets|ads-|spam")
    blocked = rows.verdict == "block"
    assert blocked[bad].mean() > 0.7 and blocked[~bad].mean() < 0.02
    assert len(LABELLED) < 100


def test_no_labelled_urls(spark):
    none = labelled_urls(spark).limit(0)
    assert not any(train_urls(none))
    df = spark.createDataFrame([(1, "http://a.net/b")], "page_id bigint, url string")
    assert judge_urls(df, none).first().verdict == "block"


# Language


@pytest.fixture(scope="module")
def model(spark):
    return learn_texts(table(spark, "documents"))


def test_languages_of_documents(spark, model):
    docs = table(spark, "documents")
    evidence = page_evidence(table(spark, "pages"))
    out = identify(docs, model, host="source", evidence=evidence).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(out) == 10_000 and out.accepted.mean() > 0.999
    assert (out.language == out.lang).mean() > 0.99


def test_other_evidence_decides_where_the_text_says_little(spark, model):
    rows = [(i, "an en", d, h) for i, (d, h) in enumerate([(None, None), ("fr", None), ("fr-CA", None), ("xx", None), (None, "h.de")])]
    rows += [(100 + i, "der und die mit von zu das ist nicht ein eine", None, "h.de") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, declared string, host string")
    out = {r.doc_id: r for r in identify(df, model, "declared", "host").collect()}
    assert out[1].language == out[2].language == "fr" != out[0].language
    assert (out[3].language, out[3].probability) == (out[0].language, out[0].probability)
    assert out[4].language == "de" and out[4].probability > out[0].probability


def test_unknown_language_is_rejected(spark, model):
    df = documents(spark, ["это текст на другом языке, которого модель не знает " * 5, "日本語の文章です。" * 20, "!!! 123 ???"])
    assert [(r.language, r.accepted) for r in identify(df, model).orderBy("doc_id").collect()] == [("und", False)] * 3


def test_language_of_odd_documents(spark, model):
    df = odd_documents(spark)
    for declared, host in ((None, None), ("declared", "host"), ("lang", "source")):
        rows = identify(df, model, declared, host).collect()
        assert len(rows) == df.count()
        assert all(r.language == "und" and not r.accepted for r in rows if r.doc_id in (0, 1, 2))
    evidence = spark.createDataFrame([(3, "DE-at", "a.example.org"), (4, None, None)], "doc_id bigint, declared string, host string")
    rows = identify(df, model, "lang", "source", evidence=evidence).collect()
    assert len(rows) == df.count() and {r.language for r in rows if r.doc_id == 3} == {"de"}
    assert identify(documents(spark, []), model, evidence=evidence.limit(0)).count() == 0


def test_no_known_language(spark):
    none = learn_texts(documents(spark, [None]).withColumn("lang", F.lit(None).cast("string")))
    assert none.languages == []
    assert not any(r.accepted for r in identify(odd_documents(spark), none, "lang", "source").collect())


def test_posterior_is_bayes_rule(spark):
    """Against the rule written out, for texts with no other evidence."""
    from gapmend.llm import language as module

    logs = np.full((3, 2**module.TRIGRAM_BITS), -8.0, np.float32)
    logs[0], logs[2] = -7.0, -9.0
    df = documents(spark, ["abcdef", "ab"], extra=False)
    rows = identify(df, TextModel(["aa", "bb"], logs), accept=0.0).orderBy("doc_id").collect()
    share = (1 - module.UNKNOWN_SHARE) / 2
    start = np.array([share, share, module.UNKNOWN_SHARE])
    said = np.exp(np.array([-7.0, -8.0, -9.0]) * 4 * module.TEMPER) * start
    said /= said.sum()
    prior = (said + start) / 2
    post = np.exp(np.array([-7.0, -8.0, -9.0]) * 4 * module.TEMPER) * prior
    assert rows[0].language == "aa" and np.isclose(rows[0].probability, (post / post.sum()).max())
    assert (rows[1].language, rows[1].accepted) == ("und", False)


def test_page_evidence(spark):
    rows = [
        (5, "https://H.example.com/de/17.html?x", '<!DOCTYPE html><HTML class="a" LANG=de-AT><p>'),
        (3, "http://b.example.com/fr/17", "<html><body>"),
        (6, None, None),
        (7, "http://c.example.com/about", '<html lang="en">'),
        (8, "http://d.example.com/18/#t", '<html lang="en">'),
    ]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    out = {r.doc_id: (r.declared, r.host) for r in page_evidence(df).collect()}
    assert out == {17: ("", "b.example.com"), 18: ("en", "d.example.com")}


def test_every_language_is_learnt(spark):
    """More than 64 languages, and one that a sample over all would miss."""
    texts = {f"l{i:02}": " ".join(f"{chr(97 + i % 26)}{chr(97 + j % 26)}{chr(97 + i // 26)}" for j in range(30)) for i in range(70)}
    rows = [(i, text, name) for i, (name, text) in enumerate(texts.items())]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = learn_texts(df)
    assert model.languages == sorted(texts)
    assert [r.language for r in identify(df, model).orderBy("doc_id").collect()] == sorted(texts)
    common = [(100 + i, f"usual words {i}", "common") for i in range(400)]
    df = df.filter("doc_id = 0").unionByName(spark.createDataFrame(common, df.schema))
    model = learn_texts(df, most=5)
    assert model.languages == ["common", "l00"]
    found = identify(df, model).filter("doc_id = 0").first()
    assert (found.language, found.accepted) == ("l00", True)
