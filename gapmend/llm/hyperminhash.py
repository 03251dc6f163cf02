"""Near duplicates by HyperMinHash, confirmed on the full sets of shingles.

A document is the set of its shingles. One hash deals each shingle to one of
128 buckets; a bucket keeps the smallest rest of its hashes as a register of 16
bits, the number of leading zeros and ten bits of mantissa behind the first
one. An empty bucket borrows from the first full one in an order of its own,
the same for all sets, so that short texts have full sketches too. Four
registers are a band. Sets that agree in one of 32 bands are candidates: at a
Jaccard index of 0.8, all bands fail in 5 of 10^8 cases.

Equal sets are one node. Candidates are compared by the share of registers
that agree, less what agrees by accident (registers collide), and only those far
above chance, within 0.25 of the threshold, go to the comparison of full sets,
which alone makes a link. That is done twice: first each node with the best of
the smallest nodes in its buckets, so that a group of copies costs a link for
each member. Then the nodes of a bucket that no link has joined so far meet in
tiles, where products of incidence matrices compare their full sets, and only
links that join them come out; so no group is written out as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from gapmend.llm.components import components
from gapmend.llm.simhash import spaced
from gapmend.llm.texts import LOWER, UNSPACED, Words, chunks, mixed, schema_of, text_key, words_of, write_scanned
from gapmend.shared import Written, write_shared

REGISTERS = 128
MANTISSA = 10
BANDS = 32
# Bits of a hash below those that choose the bucket; 53 of them are looked at.
REST = np.uint64(7)
DEPTH = 53
# How far an estimate may fall below the threshold: at 0.8 by 0.25, once in 10^8.
MARGIN = 0.25
# Nodes and shingles in a tile of a large bucket, and how many pairs and columns
# of a matrix are looked at once.
TILE = 1024
ENTRIES = 1 << 18
PAIRS_AT_ONCE = 4096
SHINGLES_AT_ONCE = 4096
# Partners of one set that a task compares it with.
PARTNERS = 1000


def _borrowing() -> np.ndarray:
    """For each bucket the place of all in its order of lenders, itself first."""
    mixing = mixed(np.arange(REGISTERS * REGISTERS, dtype=np.uint64)).reshape(REGISTERS, REGISTERS)
    np.fill_diagonal(mixing, 0)
    return mixing.argsort(axis=1).argsort(axis=1).astype(np.uint8)


LENDERS = _borrowing()


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """The distinct XXH64 of each text's shingles, sorted. A text of fewer words
    than a shingle is one shingle, one without words has none."""
    data, begins = spaced(words)
    raw, digest = data.tobytes(), xxhash.xxh64_intdigest
    starts, ends = begins[:-1].tolist(), (begins[1:] - 1).tolist()
    sets = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        count = max(b - a - size + 1, min(b - a, 1))
        found = (digest(raw[starts[i] : ends[min(i + size, b) - 1]]) for i in range(a, a + count))
        sets.append(np.unique(np.fromiter(found, np.uint64, count)))
    return sets


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a set that is not empty."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, (hashes & np.uint64(REGISTERS - 1)).astype(np.int64), hashes >> REST)
    full = least != np.iinfo(np.uint64).max
    if not full.all():
        least = least[np.where(full, LENDERS, 255).argmin(axis=1)] if full.sum() > 1 else np.full(REGISTERS, least[full][0])
    fraction, exponent = np.frexp((least >> np.uint64(64 - 7 - DEPTH)).astype(np.float64))
    zeros = np.where(fraction > 0, DEPTH - exponent, DEPTH)
    mantissa = np.where(fraction > 0, (fraction * 2 - 1) * (1 << MANTISSA), 0)
    return (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | mantissa.astype(np.uint16)


def accidents(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The chance that registers of sets of n and m shingles agree though their
    smallest shingles differ: both minima fall into one of the cells, which
    halve in width with each leading zero."""
    a, b = (np.maximum(x / REGISTERS, 1.0) for x in (n, m))
    rate = (a + b)[:, None]
    upper = 0.5 ** np.arange(DEPTH)
    width = upper / 2 / (1 << MANTISSA)
    return a * b / (a + b) * ((np.exp(-rate * upper / 2) - np.exp(-rate * upper)) * width).sum(axis=1)


def estimates(left: np.ndarray, right: np.ndarray, n: np.ndarray, m: np.ndarray, floor: float = -1.0) -> np.ndarray:
    """Jaccard indices by the agreement of registers, corrected for accidents.
    The correction lowers them, so what is below ``floor`` goes without."""
    agree = (left == right).mean(axis=1) if len(left) else np.zeros(0)
    high = np.flatnonzero(agree >= floor)
    chance = accidents(n[high], m[high])
    agree[high] = (agree[high] - chance) / (1 - chance)
    return agree


def sketches_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint16).reshape(-1, REGISTERS)


def sketched(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_key, n_shingles, a and b (hashes of the set) and bands (its
    registers, four in each long); those of empty sets are null."""
    schema = schema_of(docs.select("doc_id", "text_key"), "n_shingles long, a long, b long, bands array<long>")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in chunks(batches):
            sets = shingle_sets(words_of(LOWER[data], bounds, UNSPACED), size)
            names = [np.array([xxhash.xxh64_intdigest(s.tobytes(), seed) for s in sets], np.uint64).view(np.int64) for seed in (1, 2)]
            empty = np.array([not len(s) for s in sets], bool)
            bands = [registers(s).view(np.int64) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
                    *(pa.array(x, mask=empty) for x in names), pa.array(bands, pa.list_(pa.int64())),
                ],
                schema.names,
            )

    return docs.mapInArrow(sketch, schema)


def set_rows(docs: DataFrame, size: int) -> DataFrame:
    """node and shingles of rows with node and text."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in chunks(batches):
            sets = shingle_sets(words_of(LOWER[data], bounds, UNSPACED), size)
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "shingles"]
            )

    return docs.select("node", "text").mapInArrow(read, "node long, shingles array<long>")


def large_enough(percent: int, n: str = "n", m: str = "m") -> str:
    """Sets whose sizes alone do not rule out a link."""
    return f"100 * least({n}, {m}) >= {int(percent)} * greatest({n}, {m})"


def promising(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs u, v with estimates that may be links: u, v, estimate."""
    rows = pairs
    for name, n, bands in (("u", "n", "left"), ("v", "m", "right")):
        side = nodes.select(F.col("node").alias(name), F.col("n_shingles").alias(n), F.col("bands").alias(bands))
        rows = rows.join(side, name)
    rows = rows.filter(large_enough(percent)).select("u", "v", "n", "m", "left", "right")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("n", "m"))
            floor = percent / 100 - MARGIN
            found = estimates(sketches_of(batch.column("left")), sketches_of(batch.column("right")), n, m, floor)
            yield pa.RecordBatch.from_arrays(
                [batch.column("u"), batch.column("v"), pa.array(found, pa.float64())], ["u", "v", "estimate"]
            ).filter(pa.array(found >= floor))

    return rows.mapInArrow(compare, "u long, v long, estimate double")


def sets_of(ends: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, made: list[Written]) -> DataFrame:
    """node and shingles, the full sets of some nodes, read from one text of each."""
    wanted = nodes.join(ends, "node").select("node", F.col("least.doc_id").alias("d"), F.col("least.text_key").alias("k"))
    made.append(write_shared(wanted, "minhash-wanted"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k"))
    made.append(write_scanned(set_rows(docs.join(made[-1].for_join(), same), size), "minhash-sets"))
    # Rows that agree in id and text give the same set.
    return made[-1].frame.groupBy("node").agg(F.first("shingles").alias("shingles"))


def confirmed(pairs: Written, nodes: DataFrame, docs: DataFrame, size: int, percent: int, made: list[Written]) -> Written:
    """The pairs whose full sets reach the threshold."""
    ends = pairs.frame.select(F.col("u").alias("node")).unionByName(pairs.frame.select(F.col("v").alias("node"))).distinct()
    sets = sets_of(ends, nodes, docs, size, made)
    rows = pairs.frame.select("u", "v")
    for name in ("v", "u"):
        # A set that is asked for very often is dealt to several tasks.
        counts = rows.select("u", "v").groupBy(F.col(name).alias("node")).agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("parts"))
        made.append(write_shared(counts.filter("parts > 1"), "minhash-hot"))
        hot = made[-1]
        parts = hot.for_join().withColumnRenamed("node", name)
        other = "u" if name == "v" else "v"
        part = F.coalesce(F.pmod(F.xxhash64(other), "parts"), F.lit(0)).alias("part")
        rows = rows.join(parts, name, "left").select(*rows.columns, part)
        copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("parts", F.lit(1).cast("bigint")) - 1)).alias("part")
        side = sets.join(hot.for_join(), "node", "left").select(F.col("node").alias(name), copies, F.col("shingles").alias(f"set_{name}"))
        rows = rows.join(side.hint("shuffle_merge"), [name, "part"]).drop("part")
    shared = F.size(F.array_intersect("set_u", "set_v")).cast("bigint")
    union = F.size("set_u") + F.size("set_v") - shared
    links = write_shared(rows.filter(100 * shared >= percent * union).select("u", "v"), "minhash-links")
    made.append(links)
    return links


def labels_of(links: Written, made: list[Written]) -> Written:
    """node and label, for the nodes that links name."""
    made.append(write_shared(components(links.frame).withColumnRenamed("root", "label"), "minhash-labels"))
    return made[-1]


def tiles_of(rows: DataFrame, payload: list[str], made: list[Written], tile: int, entries: int) -> DataFrame:
    """The members of buckets as tiles that meet: band, left and right, lists of
    node, label, n and the payload; right is null where a tile meets itself.

    ``rows`` has band, key, node, label, main and n_shingles. Tiles have about
    ``tile`` nodes and ``entries`` shingles. Those of a bucket's main label, mostly
    nearly all nodes, are joined already and do not meet each other.
    """
    def parts(main: str) -> Column:
        n, held = F.count_if(F.expr(main)), F.sum(F.when(F.expr(main), F.col("n_shingles")))
        return F.greatest(F.ceil(n / tile), F.ceil(F.coalesce(held, F.lit(0)) / entries)).cast("bigint")

    sizes = rows.groupBy("band", "key").agg(parts("main").alias("same"), parts("NOT main").alias("others"))
    # The centre is of the main label, unless its row was left out.
    sizes = sizes.filter("others > 0")
    large = F.col("same") + F.col("others") > 2
    kind = F.when(large & F.col("main"), 1).otherwise(0)
    part = F.when(large, F.pmod(F.xxhash64("node"), F.when(F.col("main"), F.col("same")).otherwise(F.col("others")))).otherwise(0)
    held = F.collect_list(F.struct("node", "label", F.col("n_shingles").alias("n"), *payload))
    none = F.lit(0).cast("bigint")
    tiles = rows.join(sizes, ["band", "key"]).groupBy(
        "band", "key", kind.alias("kind"), part.alias("part"),
        F.when(large, F.col("others")).otherwise(none).alias("others"), F.when(large, F.col("same")).otherwise(none).alias("same"),
    ).agg(held.alias("left"))
    made.append(write_shared(tiles, "minhash-tiles"))
    tiles = made[-1].frame
    row = tiles.schema["left"].dataType.simpleString()
    within = tiles.filter("kind = 0").select("band", "key", "left", F.lit(None).cast(row).alias("right"))
    partners = F.expr(
        "concat(transform(filter(sequence(0L, others), p -> p > part AND p < others), p -> struct(0 AS kind2, p AS part2)),"
        " transform(filter(sequence(0L, same), p -> p < same), p -> struct(1 AS kind2, p AS part2)))"
    )
    asked = tiles.filter("kind = 0 AND others > 0").select("band", "key", "left", F.explode(partners).alias("p"))
    right = tiles.select("band", "key", F.col("kind").alias("kind2"), F.col("part").alias("part2"), F.col("left").alias("right"))
    asked = asked.select("band", "key", "left", "p.kind2", "p.part2")
    between = asked.join(right, ["band", "key", "kind2", "part2"]).select("band", "key", "left", "right")
    return within.unionByName(between)


def sides_of(batch: pa.RecordBatch, i: int, payload: str) -> Iterator[tuple[dict, pa.Array]]:
    """Left and right of a row: arrays of node, label and n, and the payload."""
    for name in ("left", "right"):
        one = batch.column(name).slice(i, 1)
        if one.null_count:
            yield left
            return
        flat = one.flatten()
        left = {c: flat.field(c).to_numpy(zero_copy_only=False) for c in ("node", "label", "n")}, flat.field(payload)
        yield left


def apart(x: dict, y: dict, percent: int) -> np.ndarray:
    """Which nodes of two tiles have different labels and sizes that may link."""
    small, big = (f(x["n"][:, None], y["n"]) for f in (np.minimum, np.maximum))
    near = (x["label"][:, None] != y["label"]) & (100 * small >= percent * big)
    return np.triu(near) if x is y else near


def undecided(rows: DataFrame, nodes: DataFrame, percent: int, made: list[Written], tile: int) -> Written:
    """band, key and node of members whose sketch is like that of another label.

    Each pair is looked at in the first band in which it agrees alone, so a
    node stays in few of its buckets.
    """
    sketches = nodes.select("node", "n_shingles", "bands")
    pairs = tiles_of(rows.join(sketches, "node"), ["bands"], made, tile, 1 << 40)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, band in enumerate(batch.column("band").to_pylist()):
                (x, left), (y, right) = sides_of(batch, i, "bands")
                l, r = sketches_of(left), sketches_of(right)
                first, second = np.nonzero(apart(x, y, percent))
                found = [np.zeros(0, np.int64)]
                for a in range(0, len(first), PAIRS_AT_ONCE):
                    f, s = first[a : a + PAIRS_AT_ONCE], second[a : a + PAIRS_AT_ONCE]
                    here = (l.view(np.int64)[f] == r.view(np.int64)[s]).argmax(axis=1) == band
                    f, s = f[here], s[here]
                    good = estimates(l[f], r[s], x["n"][f], y["n"][s], percent / 100 - MARGIN) >= percent / 100 - MARGIN
                    found += [x["node"][f[good]], y["node"][s[good]]]
                node = np.unique(np.concatenate(found))
                key = batch.column("key")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(node), band, np.int32)), pa.array(np.full(len(node), key, np.int64)), pa.array(node)],
                    ["band", "key", "node"],
                )

    kept = write_scanned(pairs.mapInArrow(compare, "band int, key long, node long").distinct(), "minhash-undecided")
    made.append(kept)
    return kept


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections of two lists of sets, by products of
    their incidence matrices, some thousand shingles at a time."""
    out = np.zeros((len(left), len(right)), np.float32)
    known = np.intersect1d(*(np.unique(np.concatenate(x)) for x in (left, right)), assume_unique=True)
    entries = []
    for sets in (left, right):
        values, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), list(map(len, sets)))
        column = np.searchsorted(known, values)
        inside = np.append(known, 0)[column] == values if len(known) else np.zeros(len(values), bool)
        column, row = column[inside], row[inside]
        order = np.argsort(column, kind="stable")
        entries.append((column[order], row[order], len(sets)))
    for a in range(0, len(known), SHINGLES_AT_ONCE):
        blocks = []
        for column, row, n in entries:
            x, y = np.searchsorted(column, (a, a + SHINGLES_AT_ONCE))
            block = np.zeros((n, min(SHINGLES_AT_ONCE, len(known) - a)), np.float32)
            block[row[x:y], column[x:y] - a] = 1
            blocks.append(block)
        out += blocks[0] @ blocks[1].T
    return out.astype(np.int64)


def spanning(linked: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Pairs u, v that join what the links between x and y join: a star for each
    connected part."""
    free_rows, free_columns = linked.any(axis=1), linked.any(axis=0)
    u, v = [], []
    for i in np.flatnonzero(free_rows):
        if not free_rows[i]:
            continue
        rows = np.array([i])
        free_rows[i] = False
        while len(rows):
            columns = np.flatnonzero(linked[rows].any(axis=0) & free_columns)
            free_columns[columns] = False
            rows = np.flatnonzero(linked[:, columns].any(axis=1) & free_rows)
            free_rows[rows] = False
            v += [y[columns], x[rows]]
            u.append(np.full(len(columns) + len(rows), x[i]))
    return u, v


def settled(rows: DataFrame, percent: int, made: list[Written], tile: int) -> Written:
    """Links u, v that join all sets of different labels which share a bucket
    and reach the threshold; ``rows`` as for ``tiles_of``, with shingles."""
    pairs = tiles_of(rows, ["shingles"], made, tile, ENTRIES)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (x, left), (y, right) = sides_of(batch, i, "shingles")
                near = apart(x, y, percent)
                if not near.any():
                    continue
                sets = [[s.values.to_numpy() for s in side] for side in (left, right)]
                shared = common(*sets)
                linked = near & (100 * shared >= percent * (x["n"][:, None] + y["n"] - shared))
                if x is y:
                    linked |= linked.T
                u, v = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in spanning(linked, x["node"], y["node"]))
                other = u != v
                yield pa.RecordBatch.from_arrays([pa.array(u[other]), pa.array(v[other])], ["u", "v"])

    links = write_scanned(pairs.mapInArrow(compare, "u long, v long").distinct(), "minhash-links")
    made.append(links)
    return links


def left_over(
    members: DataFrame, nodes: DataFrame, labels: Written, docs: DataFrame, size: int, percent: int, made: list[Written],
    tile: int = TILE,
) -> Written:
    """Links between nodes that share a bucket and have different labels.

    ``members`` has band, key, node and centre.
    """
    own = labels.for_join()
    rows = members.join(own, "node", "left").withColumn("label", F.coalesce("label", "node"))
    centre = own.withColumnsRenamed({"node": "centre", "label": "main"})
    rows = rows.join(centre, "centre", "left").withColumn("main", F.col("label") == F.coalesce("main", "centre"))
    rows = rows.select("band", "key", "node", "label", "main")
    asked = undecided(rows, nodes, percent, made, tile)
    sets = sets_of(asked.frame.select("node").distinct(), nodes, docs, size, made)
    # Keys of the joins: no node has more than one row for each band.
    rows = rows.join(asked.for_join(), ["band", "key", "node"], "left_semi").join(sets.hint("shuffle_merge"), "node")
    return settled(rows.withColumn("n_shingles", F.size("shingles").cast("bigint")), percent, made, tile)


def near_duplicate_sets(
    docs: DataFrame, percent: int = 80, size: int = 5, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Group documents whose sets of shingles have a Jaccard index of ``percent``
    in a hundred or more, directly or by others.

    A shingle is ``size`` words, A-Z in lower case; a text of fewer words is one
    shingle. Returns doc_id, text_key, n_shingles (distinct), component_id, the
    smallest doc_id that can be reached, itself included, and kept, true where
    that is its own. Null and empty texts and texts without words are linked
    with nothing. Rows with a null doc_id take part; a group of such rows alone
    has a null component_id. Repeated rows are returned as often as they come.
    An empty table gives no rows; other columns are not looked at.
    """
    made: list[Written] = []

    def keep(table: Written) -> DataFrame:
        made.append(table)
        return table.frame

    rows = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))
    prints = keep(write_scanned(sketched(rows, size), "minhash-sketches"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    nodes = prints.filter("n_shingles > 0").groupBy("a", "b").agg(
        first.alias("least"), F.max("n_shingles").alias("n_shingles"), F.any_value("bands").alias("bands")
    )
    # Written, so that each node keeps its number.
    nodes = keep(write_shared(nodes.withColumn("node", F.monotonically_increasing_id()), "minhash-nodes"))
    banded = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = banded.groupBy("band", "key").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n"))
    made.append(write_shared(buckets.filter("n > 1").drop("n"), "minhash-buckets"))
    members = keep(write_shared(banded.join(made[-1].for_join(), ["band", "key"]), "minhash-members"))

    stars = members.filter("node != centre").select(F.col("centre").alias("u"), F.col("node").alias("v")).distinct()
    made.append(write_scanned(promising(stars, nodes, percent), "minhash-stars"))
    best = made[-1].frame.groupBy("v").agg(F.max_by("u", F.struct("estimate", "u")).alias("u"))
    made.append(write_shared(best, "minhash-pairs"))
    links = confirmed(made[-1], nodes, rows, size, percent, made)
    labels = labels_of(links, made)

    more = left_over(members, nodes, labels, rows, size, percent, made)
    if more.rows:
        both = links.frame.select("u", "v").unionByName(more.frame.select("u", "v"))
        made.append(write_shared(both, "minhash-links"))
        labels = labels_of(made[-1], made)

    labelled = nodes.join(labels.for_join(), "node", "left").withColumn("label", F.coalesce("label", "node"))
    groups = labelled.groupBy("label").agg(F.min("least").alias("least"))
    roots = labelled.select("a", "b", "label").join(groups, "label").select(
        F.col("a").alias("x"), F.col("b").alias("y"), F.col("least.doc_id").alias("root"), F.lit(True).alias("known")
    )
    # Written, so that Spark can split the rows of a hot set in the join.
    roots = keep(write_shared(roots, "minhash-roots"))
    found = prints.join(roots, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")), "left")
    component = F.when(F.col("known"), F.col("root")).otherwise(F.col("doc_id"))
    result = write_shared(
        found.select(
            "doc_id", "text_key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
        ),
        "near-duplicate-sets",
    ).frame
    for table in made:
        table.drop()
    return result
