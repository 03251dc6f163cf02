import hashlib

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gapmend.llm import alignment
from gapmend.llm.alignment import Matrix, align, align_tokenizers, alignments, intervals, product_sizes, row_products
from gapmend.shared import session_conf
from tests.llm.cases import as_counter, documents, odd_documents

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def spell():
    """The (id, bytes) of both libraries' tokens."""
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}

    def piece(i):
        p = model.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()

    def both(text):
        if not text:
            return [], []
        a = [(i, bytes(byte_of[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, piece(i)) for i in model.encode(text)]
        spelt = (" " + text).encode()
        return (a, b) if all(b"".join(x[1] for x in s) == spelt for s in (a, b)) else ([], [])

    return both


def overlaps(a, b):
    """(positions, shared bytes) of overlapping tokens, by all pairs; the groups."""
    spans = []
    for side in (a, b):
        ends = np.cumsum([len(x) for _, x in side]).tolist()
        spans.append(list(zip([0, *ends], ends)))
    links = []
    for i, (x0, x1) in enumerate(spans[0]):
        for j, (y0, y1) in enumerate(spans[1]):
            if min(x1, y1) > max(x0, y0):
                links.append((i, j, min(x1, y1) - max(x0, y0)))
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    group = [[sum(c < end for c in cuts) for _, end in s] for s in spans]
    return links, group, len(cuts)


def figures(texts, spell):
    """The rows of the contract from (doc_id, text)."""
    held, rows = {}, []
    for _, text in texts:
        a, b = spell(text)
        links, group, n = overlaps(a, b)
        pairs = [(a[i][0], b[j][0]) for i, j, _ in links]
        for p in set(pairs):
            held[p] = held.get(p, 0) + 1
        parts = [
            ",".join(str(a[i][0]) for i in range(len(a)) if group[0][i] == g)
            + "|" + ",".join(str(b[j][0]) for j in range(len(b)) if group[1][j] == g)
            for g in range(n)
        ]
        shared = sum(group[0].count(g) * group[1].count(g) for g in range(n))
        rows.append((len(a), len(b), n, pairs, shared, hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""))
    most = {}
    for (x, _), n in held.items():
        most[x] = max(most.get(x, 0), n)
    return [
        (name, n_a, n_b, n, len(pairs), shared, digest, sum(held[p] == most[p[0]] for p in pairs), sum(held[p] for p in pairs))
        for (name, _), (n_a, n_b, n, pairs, shared, digest) in zip(texts, rows)
    ]


TEXTS = [
    "<|endoftext|> and <s> are plain text </s><unk>", "a ▁ b", "x﻿ y\u0000z", "é é ﬁ Ⅸ",
    "日本語のテキスト 한국어 \U0001f600\U0001f600", "  two  spaces \t\n\n tab", "don't we'll I've " * 3, "a" * 300, "1234567890" * 5,
]


@pytest.mark.parametrize("block", [64, 2 << 20])
def test_odd_documents(spark, spell, block):
    df = odd_documents(spark).filter("length(text) < 3000 OR text IS NULL")
    df = df.unionByName(documents(spark, [(i + 100, t) for i, t in enumerate(TEXTS)]))
    texts = [tuple(r) for r in df.select("doc_id", "text").collect()]
    found = align_tokenizers(df, A, B, block_bytes=block).drop("text_key")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256", "n_best", "count_sum"]
    want = figures(texts, spell)
    assert as_counter(found.select(*names).collect()) == as_counter(want)
    assert sum(w[1] == 0 for w in want) > 3


def test_long_texts(spark, spell):
    """A text of a megabyte, one without any space, and one of foreign bytes."""
    df = documents(spark, ["word salad " * 90_000, "x" * 60_000, "日本" * 20_000, "word salad"])
    for r, text in zip(sorted(align_tokenizers(df, A, B).collect()), ["word salad " * 90_000, "x" * 60_000, "日本" * 20_000]):
        a, b = spell(text)
        assert (r.n_a, r.n_b) == (len(a), len(b)) and r.n_links >= max(len(a), len(b)) and r.count_sum >= r.n_links


def test_empty_table(spark):
    assert align_tokenizers(documents(spark, []), A, B).count() == 0
    assert align_tokenizers(documents(spark, [None, ""]), A, B).filter("n_a = 0 AND groups_sha256 = ''").count() == 2


def test_ids_of_any_type(spark):
    for zone in ("UTC", "America/New_York"):
        with session_conf(spark, {"spark.sql.session.timeZone": zone}):
            df = spark.sql("SELECT timestamp'2024-01-02 03:04:05' AS doc_id, 'a text' AS text UNION ALL SELECT NULL, NULL")
            df = df.selectExpr("named_struct('a', doc_id, 'b', 1.5) AS doc_id", "text").unionByName(df.selectExpr("named_struct('a', doc_id, 'b', 2) AS doc_id", "text"))
            for kind in ("doc_id", "doc_id.a"):
                rows = df.selectExpr(f"{kind} AS doc_id", "text")
                assert as_counter(align_tokenizers(rows, A, B).select("doc_id").collect()) == as_counter(rows.select("doc_id").collect())


def test_no_row_grows_with_its_block(spark, spell, monkeypatch):
    """What a step writes has one text or a stretch of pairs in a row, though all
    texts are in one block."""
    texts = [(i, " ".join(f"{a}{b}{c}" for a in "bdfglmnprst" for b in "aeiou" for c in chr(97 + i % 26) + chr(97 + i % 23))) for i in range(700)]
    df, most = documents(spark, texts, False).coalesce(1), {}

    def spy(write):
        def written(rows, label, *rest, **options):
            done = write(rows, label, *rest, **options)
            sizes = [F.max(F.length(F.to_json(c))) for c, kind in done.frame.dtypes if kind.startswith(("array", "struct"))]
            most[label] = max([x or 0 for x in done.frame.agg(F.count("*"), *sizes).first()[1:]], default=0)
            return done

        return written

    for name in ("write_scanned", "write_shared"):
        monkeypatch.setattr(alignment, name, spy(getattr(alignment, name)))
    found = align_tokenizers(df, A, B)
    assert dict(found.select("doc_id", "n_a").collect()) == {i: len(spell(t)[0]) for i, t in texts}
    # The figures of 700 texts are more than 100,000 characters.
    assert {"token-blocks", "pair-counts", "token-alignment"} == set(most) and max(most.values()) < 50_000


def test_a_table(spark, spell):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(text) < 1500")
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256", "n_best", "count_sum"]
    assert len(texts) > 50
    assert as_counter(align_tokenizers(docs.repartition(5), A, B).select(*names).collect()) == as_counter(figures(texts, spell))


def test_alignments_themselves(spark, spell):
    df = odd_documents(spark).filter("length(text) < 500 OR text IS NULL")
    texts = {(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()}
    rows = alignments(df, A, B).join(df.select("text", F.xxhash64(F.lit("key"), "text").alias("text_key")).distinct(), "text_key")
    rows = rows.collect()
    assert {(r.doc_id, r.text) for r in rows} == texts
    for r in rows:
        a, b = spell(r.text)
        links, group, _ = overlaps(a, b)
        assert (r.a, r.b) == ([i for i, _ in a], [i for i, _ in b])
        assert [tuple(x) for x in r.links] == links and [r.group_a, r.group_b] == group


def dense(m, columns):
    out = np.zeros((len(m.begins) - 1, columns), int)
    np.add.at(out, (m.rows(), m.indices), 1)
    return out


def random_matrix(draw, rows, columns):
    lists = [sorted(draw(st.sets(st.integers(0, columns - 1)))) if columns else [] for _ in range(rows)]
    return Matrix(np.cumsum([0, *map(len, lists)]), np.array([x for r in lists for x in r], np.int64), columns)


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_products_of_any_matrices(data):
    n, k, m = (data.draw(st.integers(1, 6)) for _ in range(3))
    a, b = random_matrix(data.draw, n, k), random_matrix(data.draw, k, m)
    want = dense(a, k) @ dense(b, m)
    got = np.zeros((n, m), int)
    rows, columns, values = row_products(a, b)
    got[rows, columns] = values
    assert (got == want).all() and len(rows) == np.count_nonzero(want)
    assert product_sizes(a, b).tolist() == want.sum(axis=1).tolist()
    assert (dense(b.transposed(), k) == dense(b, m).T).all()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=30), st.lists(st.integers(1, 9), min_size=1, max_size=30), st.integers(1, 40))
def test_stretches_of_groups(x, y, most):
    """Any two ways to cut the same bytes, whatever the size of a stretch."""
    total = max(sum(x), sum(y))
    x, y = ([*s, total - sum(s)] if sum(s) < total else s for s in (x, y))
    found = align(np.array(x), np.array(y), most)
    links, group, n = overlaps([(0, b"." * i) for i in x], [(0, b"." * i) for i in y])
    assert list(zip(found.link_a.tolist(), found.link_b.tolist(), found.shared.tolist())) == links
    assert [found.group_a.tolist(), found.group_b.tolist()] == group and found.groups == n
    assert found.group_links.tolist() == [group[1].count(g) for g in group[0]]
    assert intervals(np.array(x)).columns == total
