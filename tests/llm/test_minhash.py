import numpy as np
import pytest
from pyspark.sql import functions as F

from gapmend.llm import hyperminhash as H
from gapmend.llm.hyperminhash import near_duplicate_sets
from tests.llm.cases import as_counter, documents, lower, odd_documents, unspaced


def shingles(text, size):
    w = unspaced(lower(text))
    return {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, min(len(w), 1)))}


def groups(rows, size, percent=80):
    """(doc_id, set size, component) of each (doc_id, text), by all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    best = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            best[find(i)] = min(best.get(find(i), name), name)
    return [(n, len(s), best.get(find(i)) if s else n) for i, ((n, _), s) in enumerate(zip(rows, sets))]


def check(df, size, percent=80):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    found = near_duplicate_sets(df, percent, size=size).collect()
    assert as_counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == as_counter(groups(rows, size, percent))
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    return found


def test_odd_documents(spark):
    check(odd_documents(spark), 5)


def test_empty_table(spark):
    assert near_duplicate_sets(documents(spark, [])).count() == 0
    assert near_duplicate_sets(documents(spark, [None, "", "alone here"])).filter("kept").count() == 3


def changed(random, words, share):
    return [f"z{random.integers(10**6)}" if random.random() < share else w for w in words]


@pytest.mark.parametrize("tile", [8, 1024])
def test_groups_around_the_threshold(spark, monkeypatch, tile):
    """Copies of a few texts with more and less changed, so that many pairs lie
    close to the threshold; also with buckets cut into tiles."""
    monkeypatch.setattr(H.left_over, "__defaults__", (tile,))
    monkeypatch.setattr(H, "PARTNERS", 5)
    monkeypatch.setattr(H, "ENTRIES", tile << 8)
    monkeypatch.setattr(H, "SHINGLES_AT_ONCE", 100 * tile)
    random = np.random.default_rng(11)
    texts = []
    for base in range(6):
        n = [5, 12, 40, 150, 400, 900][base]
        words = [f"b{base}w{random.integers(10**6)}" for _ in range(n)]
        texts += [" ".join(changed(random, words, random.uniform(0, 0.06))) for _ in range(60)]
    # Short texts: one shingle more or less is the threshold itself.
    texts += ["a b c d e f g", "a b c d e f g h", "a b c d e f", "A B c d E f g", "q r s t", "q r s", "s r q"]
    found = check(documents(spark, texts, extra=False), 4)
    assert 10 < len({r.component_id for r in found}) < len(texts)


def test_a_chain_over_many_links(spark):
    """Each text links with the next alone."""
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[i : i + 100]) for i in range(0, 290, 10)]
    found = check(documents(spark, texts), 4)
    assert {r.component_id for r in found} == {0}


def test_a_hot_group(spark):
    """A third of the rows are one text, another third near copies of one."""
    random = np.random.default_rng(3)
    words = [f"n{i}" for i in range(120)]
    texts = [" ".join(f"hot{i}" for i in range(50))] * 60
    texts += [" ".join(changed(random, words, 0.02)) for _ in range(60)]
    texts += [" ".join(f"t{j}x{i}" for i in range(30)) for j in range(60)]
    check(documents(spark, texts), 4)


def test_every_real_link_is_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(docs.withColumn("text", F.col("text")), 4)


def test_estimates_follow_the_index():
    """Over sizes far above and far below the number of registers."""
    random = np.random.default_rng(1)
    for n in (6, 30, 128, 2000):
        for share in (0.5, 0.8, 0.95):
            both = int(n * 2 * share / (1 + share))
            index, found, missed = both / (2 * n - both), [], 0
            for _ in range(200):
                pool = random.integers(0, 2**63, 2 * n - both, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
                pool ^= random.integers(0, 2**63, len(pool), dtype=np.uint64)
                a, b = pool[:n], pool[n - both :]
                x, y = H.registers(np.sort(a)), H.registers(np.sort(b))
                found.append(H.estimates(x[None], y[None], np.array([n]), np.array([n]))[0])
                missed += not (x.view(np.int64) == y.view(np.int64)).any()
            assert abs(np.mean(found) - index) < 0.02
            if index >= 0.79:
                assert min(found) > index - H.MARGIN and missed == 0


def test_accidents_are_what_chance_gives():
    """Measured on sets without a common shingle, with fewer bits of mantissa."""
    random = np.random.default_rng(2)
    n = 3000
    sketches = np.array([H.registers(random.integers(0, 2**64, n, dtype=np.uint64)) for _ in range(300)])
    coarse = sketches >> 6
    agree = np.mean([(coarse[i] == coarse[j]).mean() for i in range(300) for j in range(i)])
    expected = H.accidents(np.array([n]), np.array([n]))[0] * 2**6
    assert abs(agree / expected - 1) < 0.1


def test_common_is_the_size_of_intersections(monkeypatch):
    monkeypatch.setattr(H, "SHINGLES_AT_ONCE", 7)
    random = np.random.default_rng(4)
    sides = [[np.unique(random.integers(0, 60, random.integers(1, 50))) for _ in range(n)] for n in (5, 9)]
    want = [[len(np.intersect1d(a, b)) for b in sides[1]] for a in sides[0]]
    assert H.common(*sides).tolist() == want
    assert H.common([np.array([1])], [np.array([2])]).tolist() == [[0]]
