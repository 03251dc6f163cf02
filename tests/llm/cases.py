"""Small tables with every odd case, and brute force to hold results against."""

import re
from collections import Counter

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use for themselves.
CLASHING = {
    name: "'x'"
    for name in (
        "text_key", "row", "line", "lines", "spans", "runs", "start", "end", "leaf", "block", "rank", "k", "d", "h",
        "key", "size", "shard", "slot", "part", "node", "root", "first", "least", "fingerprint", "logs", "grams",
        "host", "declared", "label", "held_out", "score", "words", "prints", "others", "tokens", "`clash ing`",
    )
}

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
PASSAGE = " ".join(f"pass{i}" for i in range(60))


def documents(spark, texts, extra=True):
    """Documents 0, 1, 2 ... of the given texts, or of given (id, text) pairs."""
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in pairs]
    df = spark.createDataFrame(rows, DOCUMENTS)
    return df.selectExpr("*", *(f"{v} AS {k}" for k, v in CLASHING.items())) if extra else df


ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "One two three",
    "One two three",
    f"before {PASSAGE} after",
    f"{PASSAGE}\n\n{PASSAGE}",
    LONG,
    LONG + " end",
    "a b " * 200,
    "É ß 日本 " * 30,
    "line one\nline two\nline three",
    "line zero\nline one\nline two\n\nline three\n",
    "x" * 50_000,
]


def odd_documents(spark, extra=True):
    """Nulls, empty and very long texts, ties, repeated rows and repeated ids."""
    rows = list(enumerate(ODD_TEXTS))
    rows += [(3, "one"), (3, "one"), (4, "another text of the same id"), (None, "no id"), (None, None), (None, "no id")]
    return documents(spark, rows, extra)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def unspaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def as_counter(rows):
    return Counter(map(tuple, rows))


def later_lines(rows, m):
    """(number of lines, lines that stay) of each row, by windows of m lines."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    seen, result = set(), {}
    for row in order:
        lines = row[1].split("\n") if row[1] is not None else []
        full = [i for i, x in enumerate(lines) if re.search(r"[^ \t\n\x0b\f\r]", x)]
        gone = set()
        for a in range(len(full) - m + 1):
            window = tuple(lines[i] for i in full[a : a + m])
            if window in seen:
                gone.update(full[a : a + m])
            seen.add(window)
        text = None if row[1] is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        result[row] = (len(full), len(gone), text)
    return result


def repeated_words(texts, size):
    """(number of words, kept words) of each text, by windows of ``size`` words."""
    words = [unspaced(t) for t in texts]
    times = Counter(tuple(w[a : a + size]) for w in words for a in range(len(w) - size + 1))
    result = []
    for w in words:
        gone = set()
        for a in range(len(w) - size + 1):
            if times[tuple(w[a : a + size])] > 1:
                gone.update(range(a, a + size))
        result.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return result


def contaminated(texts, items):
    """(words, hit words, items) of each text."""
    windows = {}
    for name, text in items:
        w = item_words(text)
        n = min(13, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[a : a + n]), set()).add(name)
    result = []
    for text in texts:
        w, hit, found = item_words(text), set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                names = windows.get(tuple(w[a : a + n]))
                if names:
                    hit.update(range(a, a + n))
                    found |= names
        result.append((len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return result


def simhash(text, size=4, seed=42):
    import xxhash

    w = unspaced(lower(text))
    shingles = [" ".join(w[i : i + size]) for i in range(max(len(w) - size + 1, min(len(w), 1)))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, radius):
    """The component of each fingerprint, by all pairs."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]
