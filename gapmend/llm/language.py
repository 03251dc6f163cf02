"""Language of documents by Bayes' rule over several kinds of evidence.

- The text: likelihood of its hashed byte trigrams in each language, against
  that of text in no known language, which has all trigrams alike.
- The language that the markup declares, which is mostly right.
- The suffix of the address: how often texts under it are in each language.
- The host: the same, smoothed towards its domain, and that towards all texts.

The last two are sums over the whole corpus by host, domain and suffix of what
the texts alone say, made by grouped aggregation, so a host of any size costs
each task one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gapmend.llm.texts import LOWER, byte_table, chunks, fields, schema_of, text_key, write_scanned
from gapmend.shared import write_shared

TRIGRAM_BITS = 16
# Labelled documents of each language that the text model learns from at most,
# those of smallest hash.
MOST_LABELLED = 1000
# Neighbouring trigrams share letters; each counts for so much.
TEMPER = 1 / 3
SMOOTHING = 0.5
DECLARED_RIGHT = 0.9
# What a host's own texts weigh as much as, of its domain's.
PRIOR_TEXTS = 20.0
UNKNOWN = "und"
# A small chance of an unknown language for every text.
UNKNOWN_SHARE = 1e-3

LETTER = byte_table(lambda b: b >= 128 or chr(b).isalpha())


def trigrams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of letters in lower case, with blanks for all else, and
    where each text's begin. Runs of blanks have none."""
    lower = np.where(LETTER[data], LOWER[data], np.uint8(32)).astype(np.uint32)
    size = np.maximum(np.diff(bounds) - 2, 0)
    first = np.concatenate(([0], np.cumsum(size)))
    at = np.arange(first[-1]) + np.repeat(bounds[:-1] - first[:-1], size)
    a, b, c = lower[at], lower[at + 1], lower[at + 2]
    some = (b != 32) | ((a != 32) & (c != 32))
    mixed = ((a << np.uint32(16)) | (b << np.uint32(8)) | c) * np.uint32(0x9E3779B1)
    return (mixed >> np.uint32(32 - TRIGRAM_BITS))[some].astype(np.int64), np.concatenate(([0], np.cumsum(some)))[first]


@dataclass
class TextModel:
    """Languages, and the log likelihood of each trigram in each; the last row
    is that of no known language."""

    languages: list[str]
    logs: np.ndarray

    def likelihoods(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A row of log likelihoods and the number of trigrams for each text."""
        grams, first = trigrams(data, bounds)
        rows = np.column_stack([np.diff(np.concatenate(([0.0], np.cumsum(log[grams], dtype=np.float64)))[first]) for log in self.logs])
        return rows, np.diff(first)


def learn_texts(
    docs: DataFrame, language: str = "lang", text: str = "text", doc_id: str = "doc_id", most: int = MOST_LABELLED
) -> TextModel:
    """Count trigrams by language in at most ``most`` labelled documents of each.

    Every language that labels a text with letters is in the model, which holds 256 KB for each.
    """
    rows = docs.select(F.col(language).alias("language"), F.col(text).alias("text"), F.col(doc_id).alias("doc_id"))
    rows = rows.filter("language is not null and text is not null")
    labelled = rows.select("doc_id", "language", text_key("text").alias("k")).distinct()
    labelled = write_shared(labelled.withColumn("place", F.xxhash64("doc_id", "k")), "labelled").frame
    # Smallest hashes without sorting a common language: those under a bound that
    # about twice as many pass, then the first of them.
    sizes = write_shared(labelled.groupBy("language").agg(F.count(F.lit(1)).alias("all")), "label-sizes")
    share = (F.col("place") / F.lit(2.0**64)) + 0.5
    few = labelled.join(sizes.for_join(), "language").filter((F.col("all") <= 4 * most + 100) | (share * F.col("all") <= 2 * most + 100))
    order = Window.partitionBy("language").orderBy("place", "doc_id", "k")
    chosen = few.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= most)
    chosen = write_shared(chosen.select(F.col("doc_id").alias("d"), F.col("language").alias("l"), F.col("k").alias("h")), "learnt")
    sample = rows.withColumn("k", text_key("text")).join(
        chosen.for_join(),
        F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("k") == F.col("h")) & (F.col("language") == F.col("l")),
    ).select("language", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in chunks(batches):
            grams, first = trigrams(data, bounds)
            codes = part.column("language").dictionary_encode()
            code = np.repeat(codes.indices.to_numpy(), np.diff(first)).astype(np.int64)
            key, times = np.unique((code << TRIGRAM_BITS) + grams, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [codes.dictionary.take(pa.array(key >> TRIGRAM_BITS)), pa.array((key & (2**TRIGRAM_BITS - 1)).astype(np.int32)), pa.array(times)],
                ["language", "gram", "n"],
            )

    sums = sample.mapInArrow(count, "language string, gram int, n long").groupBy("language", "gram").agg(F.sum("n").alias("n"))
    size = 2**TRIGRAM_BITS
    counts: dict[str, np.ndarray] = {}
    # At most 2^16 numbers for each language.
    for name, grams, times in sums.groupBy("language").agg(F.collect_list("gram"), F.collect_list("n")).collect():
        counts[name] = np.bincount(np.array(grams), np.array(times), size)
    names = sorted(counts)
    logs = [np.log((counts[n] + SMOOTHING) / (counts[n].sum() + SMOOTHING * size)) for n in names]
    return TextModel(names, np.array([*logs, np.full(size, -np.log(size))], np.float32))


def _sums(shares: str, n: int) -> Column:
    return F.array(*[F.sum(F.col(shares)[i]) for i in range(n)])


def _plus(left: Column, right: Column, weight: float) -> Column:
    """Sums ``left`` and ``weight`` more texts that are dealt as ``right`` says."""
    total = F.aggregate(left, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(left, right, lambda a, b: (a + weight * b) / (total + weight))


def _softmax(logs: Column) -> Column:
    most = F.array_max(logs)
    weights = F.transform(logs, lambda x: F.exp(x - most))
    total = F.aggregate(weights, F.lit(0.0), lambda a, b: a + b)
    return F.transform(weights, lambda w: w / total)


def identify(
    docs: DataFrame, model: TextModel, declared: str | None = None, host: str | None = None, text: str = "text",
    doc_id: str = "doc_id", accept: float = 0.5, evidence: DataFrame | None = None,
) -> DataFrame:
    """The language of each document.

    ``declared`` and ``host`` name columns with the language that the markup
    declares and the host of the address. ``evidence`` may have both under these
    names, in one row for a ``doc_id`` at most, which go before the columns; it
    is joined to the scores of the texts, which stay where they are. Returns doc_id, text_key, language
    (``und`` if none of the model's), probability and accepted: the language is
    known, its probability at least ``accept``, and the text has letters.

    Null and empty texts and those without letters are ``und`` and not
    accepted. A null or unknown declaration and a null host tell nothing;
    regions as in ``en-GB`` and capitals do not matter. Repeated rows are
    judged alike. Without languages in the model nothing is accepted. An empty
    table gives no rows; other columns are not looked at.
    """
    names = model.languages
    n = len(names) + 1

    def known(declared: str | None, host: str | None) -> list[Column]:
        nothing = F.lit(None).cast("string")
        language = F.nullif(F.lower(F.regexp_extract(F.col(declared), "^[A-Za-z]+", 0)), F.lit("")) if declared else nothing
        return [language.alias("declared"), (F.col(host).cast("string") if host else nothing).alias("host")]

    own = [F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key")]
    rows = docs.select(*own, *known(declared, host), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(fields(model))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in chunks(batches):
            logs, grams = TextModel(*shared.value).likelihoods(data, bounds)
            offsets = pa.array((np.arange(part.num_rows + 1) * n).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("doc_id", "text_key", "declared", "host")), pa.ListArray.from_arrays(offsets, pa.array(logs.ravel())), pa.array(grams)],
                ["doc_id", "text_key", "declared", "host", "logs", "grams"],
            )

    schema = schema_of(rows.drop("text"), "logs array<double>, grams long")
    scored = write_scanned(rows.mapInArrow(scan, schema), "language-texts").frame
    if evidence is not None:
        more = evidence.select("doc_id", *known("declared", "host")).toDF("id", "page_declared", "page_host")
        scored = scored.join(more, F.col("doc_id") == F.col("id"), "left").select(
            "doc_id", "text_key", F.coalesce("page_declared", "declared").alias("declared"),
            F.coalesce("page_host", "host").alias("host"), "logs", "grams",
        )
    return _fused(scored, names, accept)


def _fused(scored: DataFrame, names: list[str], accept: float) -> DataFrame:
    n = len(names) + 1
    share = (1 - UNKNOWN_SHARE) / max(len(names), 1)
    start = F.array(*[F.lit(share)] * len(names), F.lit(UNKNOWN_SHARE if names else 1.0))
    by_text = F.transform("logs", lambda x: x * TEMPER)
    alone = _softmax(F.zip_with(by_text, start, lambda x, p: x + F.log(p)))
    # What texts alone say, for the texts that say anything.
    said = scored.filter("grams > 0").select("host", alone.alias("shares"))
    hosts = said.groupBy("host").agg(_sums("shares", n).alias("sums")).filter("host is not null")
    labels = F.split("host", r"\.")
    dotted = F.size(labels) > 1
    hosts = hosts.select(
        "host", "sums",
        F.when(dotted, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(F.lit("")).alias("domain"),
        F.when(dotted, F.element_at(labels, -1)).otherwise(F.lit("")).alias("suffix"),
    )
    hosts = write_shared(hosts, "language-hosts").frame
    everything = said.groupBy().agg(_sums("shares", n).alias("sums")).select(
        _plus(F.transform("sums", lambda x: F.coalesce(x, F.lit(0.0))), start, 1.0).alias("overall")
    )
    overall = F.lit(everything.first()["overall"])
    domains = hosts.groupBy("domain").agg(_sums("sums", n).alias("domain_sums"))
    suffixes = hosts.groupBy("suffix").agg(_sums("sums", n).alias("suffix_sums"))
    domains = domains.select("domain", _plus(F.col("domain_sums"), overall, PRIOR_TEXTS).alias("domain_prior"))
    suffixes = suffixes.select("suffix", _plus(F.col("suffix_sums"), overall, PRIOR_TEXTS).alias("by_suffix"))
    priors = hosts.join(domains, "domain").join(suffixes, "suffix").select(
        F.col("host").alias("h"), _plus(F.col("sums"), F.col("domain_prior"), PRIOR_TEXTS).alias("prior"),
        # How much more likely each language is under the suffix than overall.
        F.zip_with("by_suffix", overall, lambda a, b: F.log(a / b)).alias("suffix_logs"),
    )
    rows = scored.join(priors, F.col("host") == F.col("h"), "left")
    others = (1 - DECLARED_RIGHT) / max(len(names), 1)
    said = F.transform(
        F.lit([*names, UNKNOWN]),
        lambda name: F.when(~F.coalesce(F.array_contains(F.lit(names or [""]), F.col("declared")), F.lit(False)), F.lit(0.0))
        .when(name == F.col("declared"), F.lit(float(np.log(DECLARED_RIGHT)))).otherwise(F.lit(float(np.log(others)))),
    )
    logs = F.zip_with(by_text, F.coalesce("prior", overall), lambda x, p: x + F.log(p))
    logs = F.zip_with(logs, F.coalesce("suffix_logs", F.array_repeat(F.lit(0.0), n)), lambda a, b: a + b)
    logs = F.zip_with(logs, said, lambda a, b: a + b)
    fused = rows.select("doc_id", "text_key", "grams", _softmax(logs).alias("shares"))
    best = F.array_position("shares", F.array_max("shares")).cast("int")
    language = F.when(F.col("grams") > 0, F.element_at(F.lit([*names, UNKNOWN]), best)).otherwise(F.lit(UNKNOWN))
    found = fused.select("doc_id", "text_key", language.alias("language"), F.array_max("shares").alias("probability"))
    known = (F.col("language") != UNKNOWN) & (F.col("probability") >= accept)
    return found.withColumn("accepted", known)


def page_evidence(pages: DataFrame) -> DataFrame:
    """doc_id, declared and host of the pages whose address ends in a document's
    number; of several for one document the page of smallest page_id."""
    address = F.regexp_extract("url", r"^[^:]*://([^/?#]*)((?:/[^?#]*)?)", 1)
    path = F.regexp_extract("url", r"^[^:]*://([^/?#]*)((?:/[^?#]*)?)", 2)
    number = F.nullif(F.regexp_extract(path, r"/([0-9]{1,18})(?:\.html)?/?$", 1), F.lit("")).cast("bigint")
    declared = F.regexp_extract("html", r"(?i)<html[^>]*\slang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    rows = pages.select(number.alias("doc_id"), F.struct("page_id", declared.alias("declared"), F.lower(address).alias("host")).alias("page"))
    rows = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min("page").alias("page"))
    return rows.select("doc_id", "page.declared", "page.host")
