"""Language identification by Bayesian fusion of text, declared language, address suffix and host.

Text likelihoods are naive Bayes over hashed byte trigrams, counted over all labelled rows. Host priors come from
the text posteriors of a host's documents, smoothed towards those of its address suffix, which are smoothed towards
the whole corpus; all by grouped aggregation, and without the document itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshlark.llm import common
from meshlark.plans.lineage import store

BUCKETS = 1 << 16
#: Overlapping trigrams repeat evidence; their sum counts as a third.
TEXT_WEIGHT = 1 / 3
#: Rows that a parent prior counts as.
SMOOTHING = 20.0
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


@dataclass
class LanguageModel:
    """``log_likelihood[bucket, language]`` of a trigram."""

    languages: tuple[str, ...]
    log_likelihood: np.ndarray


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte trigrams that hold no ASCII digit, sign or two blanks, and the row of each."""
    low = _LOWER[data]
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    letter = ((low >= 97) & (low <= 122)) | (low >= 128)
    blank = (low == 32) | ((low >= 9) & (low <= 13))
    low = np.where(blank, np.uint32(32), low)
    code = low[:-2] << np.uint32(16) | low[1:-1] << np.uint32(8) | low[2:]
    fit = (letter | blank)
    ok = fit[:-2] & fit[1:-1] & fit[2:] & (letter[:-2].astype(np.int8) + letter[1:-1] + letter[2:] >= 2)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    ok &= row[:-2] == row[2:]
    at = np.flatnonzero(ok)
    return ((code[at] * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64), row[at]


def _counts(languages: Sequence[str]):
    number = {name: i for i, name in enumerate(languages)}

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(languages) * BUCKETS, np.int64)
        for batch in batches:
            labels = np.array([number.get(x, -1) for x in batch.column(1).to_pylist()], np.int64)
            data, offsets = common.utf8(batch.column(0))
            for start, stop in common.slices(offsets):
                bucket, row = _trigrams(data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start])
                own = labels[start:stop][row]
                known = own >= 0
                total += np.bincount(own[known] * BUCKETS + bucket[known], minlength=len(total))
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], ["cell", "n"])

    return kernel


def fit_language_model(docs: DataFrame, label: str = "lang", text: str = "text",
                       languages: Sequence[str] = ("de", "en", "es", "fr")) -> LanguageModel:
    """Trigram counts of all rows whose ``label`` is one of ``languages``; a task sends one count per language and
    bucket at most, and the driver gets ``len(languages) * BUCKETS`` sums at most."""
    rows = docs.where(F.col(label).isin(*languages)).select(common.text_or_empty(text).alias("text"), F.col(label).alias("label"))
    cells = rows.mapInArrow(_counts(languages), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(languages) * BUCKETS)
    counts[cells["cell"].to_numpy().astype(np.int64)] = cells["n"].to_numpy()
    counts = counts.reshape(len(languages), BUCKETS)
    share = (counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * BUCKETS)
    return LanguageModel(tuple(languages), np.log(share).T.astype(np.float32).copy())


def _evidence(model: LanguageModel, text_at: int):
    """Pass all columns on and add the log likelihood of the text under each language, the largest being 0."""
    table = model.log_likelihood

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = common.utf8(batch.column(text_at))
            sums = np.zeros((batch.num_rows, len(model.languages)))
            letters = np.zeros(batch.num_rows, np.int64)
            for start, stop in common.slices(offsets):
                bucket, row = _trigrams(data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start])
                for k in range(sums.shape[1]):
                    sums[start:stop, k] = np.bincount(row, table[bucket, k], stop - start)
                letters[start:stop] = np.bincount(row, minlength=stop - start)
            sums = TEXT_WEIGHT * (sums - sums.max(1, keepdims=True, initial=-np.inf))
            flat = pa.ListArray.from_arrays(
                pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * sums.shape[1]), pa.array(sums.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, flat, pa.array(letters)], [*batch.schema.names, "_lid_text", "_lid_trigrams"])

    return kernel


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    weights = F.transform(logs, lambda v: F.exp(v - top))
    return F.transform(weights, lambda v: v / F.aggregate(weights, F.lit(0.0), lambda a, b: a + b))


def _sums(probabilities: str, n: int) -> list[Column]:
    return [F.sum(F.col(probabilities)[k]).alias(f"_s{k}") for k in range(n)]


def _joined(*names: str, n: int) -> Column:
    return F.array(*[F.col(f"_s{k}") for k in range(n)])


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", declared: Column | None = None,
             suffix: Column | None = None, host: Column | None = None, least_posterior: float = 0.5) -> DataFrame:
    """``docs`` with ``language``, ``language_posterior``, ``language_kept`` (columns of these names are replaced).

    The posterior of a language is proportional to the likelihood of the text, the chance that a page in it declares
    what this one declares, and the prior of its host. Missing evidence (null) counts for nothing: without a host the
    prior of the suffix holds, without both that of the corpus. ``language`` is ``und`` and the row not kept where
    the text has no word to judge by (null, empty, digits or signs only) or no language reaches
    ``least_posterior``. Ties go to the first language. Repeated rows get equal results; an empty table stays empty.

    Text is scored twice, once for the priors and once for the result, so that no text is shuffled or stored. The
    table of hosts is written first: Spark sends it to all tasks only if it is small.
    """
    n, spark = len(model.languages), docs.sparkSession
    replaced = ("language", "language_posterior", "language_kept")
    base = docs.select(*[f"`{c}`" for c in docs.columns if c not in replaced])
    extra = {"_lid_text_in": common.text_or_empty(text),
             "_lid_declared": (F.lit(None).cast("string") if declared is None else F.lower(declared)),
             "_lid_suffix": F.coalesce(F.lit(None).cast("string") if suffix is None else F.lower(suffix), F.lit("")),
             "_lid_host": F.coalesce(F.lit(None).cast("string") if host is None else F.lower(host), F.lit(""))}

    def scored(columns: list[str]) -> DataFrame:
        df = base.withColumns(extra).select(*[f"`{c}`" for c in columns], *extra)
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        return df.mapInArrow(_evidence(model, df.columns.index("_lid_text_in")),
                             f"{kinds}, _lid_text array<double>, _lid_trigrams long").drop("_lid_text_in")

    seen = scored([]).where("_lid_trigrams > 0").select("_lid_declared", "_lid_suffix", "_lid_host", _softmax(F.col("_lid_text")).alias("p"))
    by_host = store(seen.groupBy("_lid_suffix", "_lid_host", "_lid_declared").agg(*_sums("p", n))).df
    totals = by_host.agg(*[F.sum(f"_s{k}") for k in range(n)]).first()
    corpus = np.array([x or 0.0 for x in totals]) + 1.0
    corpus = corpus / corpus.sum()

    def smoothed(parent: Column) -> Column:
        total = sum((F.col(f"_s{k}") for k in range(1, n)), F.col("_s0"))
        return F.array(*[(F.col(f"_s{k}") + SMOOTHING * parent[k]) / (total + SMOOTHING) for k in range(n)])

    whole = F.array(*[F.lit(float(x)) for x in corpus])
    add = [F.sum(f"_s{k}").alias(f"_s{k}") for k in range(n)]
    suffixes = store(by_host.where("_lid_suffix <> ''").groupBy("_lid_suffix").agg(*add).select(
        "_lid_suffix", smoothed(whole).alias("_lid_parent"))).df
    hosts = store(by_host.where("_lid_host <> ''").groupBy("_lid_suffix", "_lid_host").agg(*add)
                  .select("_lid_suffix", "_lid_host", _joined(n=n).alias("_lid_seen"))).df
    # How often pages in a language declare each language: bounded by the languages and one line for all others.
    known = F.when(F.col("_lid_declared").isin(*model.languages), F.col("_lid_declared")).otherwise(F.lit("other"))
    said = by_host.where("_lid_declared IS NOT NULL").groupBy(known.alias("said")).agg(*add).collect()
    table = {r["said"]: np.array([r[f"_s{k}"] for k in range(n)]) for r in said}
    kinds = [*model.languages, "other"]
    confusion = np.array([table.get(k, np.zeros(n)) for k in kinds]) + 1.0
    confusion = np.log(confusion / confusion.sum(0))
    declares = F.lit(None)
    for k, name in enumerate(kinds):
        row = F.array(*[F.lit(float(x)) for x in confusion[k]])
        declares = F.when(known == name, row).otherwise(declares) if k else F.when(known == name, row)
    nothing = F.array(*[F.lit(0.0)] * n)

    rows = scored(base.columns).join(suffixes, "_lid_suffix", "left").join(hosts, ["_lid_suffix", "_lid_host"], "left")
    own = F.when(F.col("_lid_trigrams") > 0, _softmax(F.col("_lid_text"))).otherwise(nothing)
    parent = F.coalesce("_lid_parent", whole)
    others = F.zip_with(F.coalesce("_lid_seen", nothing), F.when(F.col("_lid_seen").isNull(), nothing).otherwise(own),
                        lambda a, b: F.greatest(a - b, F.lit(0.0)))
    rows = rows.withColumns({"_lid_others": others, "_lid_up": parent,
                             "_lid_said": F.when(F.col("_lid_declared").isNotNull(), declares).otherwise(nothing)})
    seen_total = F.aggregate("_lid_others", F.lit(0.0), lambda a, b: a + b)
    logs = F.array(*[
        F.col("_lid_text")[k] + F.col("_lid_said")[k]
        + F.log((F.col("_lid_others")[k] + SMOOTHING * F.col("_lid_up")[k]) / (seen_total + SMOOTHING)) for k in range(n)])
    rows = rows.withColumn("_lid_posterior", _softmax(logs))
    best = F.array_max("_lid_posterior")
    names = F.array(*[F.lit(x) for x in model.languages])
    kept = (F.col("_lid_trigrams") > 0) & (best >= least_posterior)
    language = F.when(kept, F.element_at(names, F.array_position("_lid_posterior", best).cast("int"))).otherwise(F.lit("und"))
    return rows.select(*[f"`{c}`" for c in base.columns], language.alias("language"), best.alias("language_posterior"), kept.alias("language_kept"))


def page_evidence() -> dict[str, Column]:
    """Declared language, address suffix and host of web pages (columns ``url``, ``html``)."""
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    said = F.regexp_extract("html", r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-z]{2,3})", 1)
    last = F.regexp_extract(host, r"\.([A-Za-z]{2,})$", 1)
    return {"declared": F.nullif(said, F.lit("")), "suffix": F.nullif(last, F.lit("")), "host": F.nullif(host, F.lit(""))}


def page_text() -> Column:
    """Text of ``html`` without scripts, styles, comments, tags and entities."""
    bare = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"<[^>]*>", " "), r"&[#A-Za-z0-9]+;", " ")
