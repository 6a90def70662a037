"""URL filter: rules on host and path where one fits, else logistic regression on hashed character n-grams.

The classifier learns from a small table of labelled URLs, for instance those that rules decide, so that it carries a
policy over to hosts and paths that no rule names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meshlark.llm import common

#: Lengths of the n-grams in bytes, buckets of their hashes.
GRAMS, BUCKETS = (3, 4, 5, 6, 7, 8), 1 << 16
#: Labelled URLs that are learned from, half of them of each label.
MOST_LABELLED = 2_000
#: Rules go to every task as they are.
MOST_RULES = 10_000
EPOCHS, RATE, DECAY = 60, 0.5, 1e-4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(_after(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


class Rules:
    """``(verdict, "host/path")`` rules. One fits its host and the host's subdomains where the path starts with the
    rule's; of several the longest decides, of equal ones the first."""

    def __init__(self, rules: list[tuple[str, str]]):
        if len(rules) > MOST_RULES:
            raise ValueError(f"more than {MOST_RULES} rules")
        self.by_host: dict[str, list[tuple[int, int, str, str, str]]] = {}
        for place, (verdict, rule) in enumerate(rules):
            if verdict not in ("allow", "block") or "/" not in rule:
                raise ValueError(f"a rule is allow or block and host/path: {verdict!r}, {rule!r}")
            host, slash, rest = rule.partition("/")
            self.by_host.setdefault(host, []).append((-len(rule), place, slash + rest, rule, verdict))
        for own in self.by_host.values():
            own.sort()
        self.labels = max((h.count(".") + 1 for h in self.by_host), default=0)

    def decide(self, host: str, path: str) -> tuple[str, str] | None:
        """The rule that decides, and its verdict."""
        best = None
        labels = host.rsplit(".", self.labels)
        for n in range(1, min(self.labels, len(labels)) + 1):
            for found in self.by_host.get(".".join(labels[-n:]), ()):
                if path.startswith(found[2]):
                    best = min(best or found, found)
                    break
        return best and best[3:]


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length, the texts' numbers and the buckets of their hashed n-grams, which never cross texts."""
    sums = common.prefix_hash(data)
    sizes = np.diff(offsets)
    row, start = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(data))
    left = np.repeat(offsets[1:], sizes) - start
    for n in GRAMS:
        at = start[left >= n]
        hashes = common.mixed(common.ranges_hash(sums, at, at + n) + np.uint64(n))
        yield row[at], (hashes >> np.uint64(40)).astype(np.int64) % BUCKETS


@dataclass
class UrlModel:
    """Weights of the n-gram buckets and the constant; a score is the probability of ``block``."""

    weights: np.ndarray
    constant: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Scores of host and path texts (see ``features``): constant plus the weights' sum over the root of their number."""
        rows = len(offsets) - 1
        total, counts = np.zeros(rows), np.zeros(rows)
        for row, buckets in gram_buckets(data, offsets):
            total += np.bincount(row, self.weights[buckets], rows)
            counts += np.bincount(row, minlength=rows)
        return _sigmoid(self.constant + total / np.sqrt(np.maximum(counts, 1)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def features(host: Column, path: Column) -> Column:
    """The text whose n-grams count: marks before the host, between host and path, and after the path."""
    return F.concat(F.lit("\u0002"), host, F.lit("\u0003"), path, F.lit("\u0004"))


def train(texts: list[str], blocked: list[bool]) -> UrlModel:
    """Full-batch gradient descent with a step for each weight (Duchi et al., 2011); both labels weigh the same."""
    model = UrlModel(np.zeros(BUCKETS), 0.0)
    if not texts:
        return model
    data, offsets = common.utf8(pa.array(texts))
    row, buckets = [np.concatenate(p) for p in zip(*gram_buckets(data, offsets))]
    counts = np.bincount(row, minlength=len(texts))
    share = 1 / np.sqrt(np.maximum(counts, 1))
    target = np.array(blocked, float)
    ones = target.sum()
    weight = np.where(target > 0, 1 / max(ones, 1), 1 / max(len(target) - ones, 1)) / 2
    past, past_constant = np.full(BUCKETS, 1e-8), 1e-8
    for _ in range(EPOCHS):
        z = model.constant + np.bincount(row, model.weights[buckets], len(counts)) * share
        slope = (_sigmoid(z) - target) * weight
        step = np.bincount(buckets, (slope * share)[row], BUCKETS) + DECAY * model.weights
        past += step * step
        past_constant += slope.sum() ** 2
        model.weights -= RATE * step / np.sqrt(past)
        model.constant -= RATE * slope.sum() / np.sqrt(past_constant)
    return model


def _judged(rules: Rules, model: UrlModel | None):
    """Kernel over a text (features), host and path, and a struct of all that stays."""

    def per_slice(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        found = [rules.decide(h, p) for h, p in zip(hosts, paths)]
        scores = model.scores(data, offsets) if model is not None else np.full(len(hosts), np.nan)
        verdicts = [f[1] if f else None if s != s else "block" if s >= 0.5 else "allow" for f, s in zip(found, scores.tolist())]
        return pa.RecordBatch.from_arrays(
            [batch.column(3), batch.column(1), batch.column(2), pa.array([f and f[0] for f in found], pa.string()),
             pa.array(scores, from_pandas=True), pa.array(verdicts, pa.string())],
            ["_row", "host", "path", "rule", "score", "verdict"])

    return common.text_kernel(per_slice)


_ADDED = ("host", "path", "rule", "score", "verdict")


def _apply(df: DataFrame, rules: Rules, model: UrlModel | None, url: str) -> DataFrame:
    stay = [c for c in df.columns if c not in _ADDED]
    parts = df.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
                      F.struct(*[F.col(f"`{c}`") for c in stay]).alias("_row"))
    ready = parts.select(features(F.coalesce("host", F.lit("")), F.coalesce("path", F.lit(""))).alias("text"),
                         F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "_row")
    added = "host string, path string, rule string, score double, verdict string"
    schema = StructType([ready.schema["_row"], *StructType.fromDDL(added)])
    return ready.mapInArrow(_judged(rules, model), schema).select("_row.*", *_ADDED)


def apply_rules(df: DataFrame, rules: list[tuple[str, str]], url: str = "url") -> DataFrame:
    """``df`` with ``host, path, rule, score, verdict``: of the rules alone; without a fitting one the last three are null."""
    return _apply(df, Rules(rules), None, url)


def fit_url_model(labelled: DataFrame, url: str = "url", label: str = "verdict", most: int = MOST_LABELLED) -> UrlModel:
    """Learn from ``labelled``: URLs and ``allow`` or ``block``; rows with another label or none are left out.

    At most ``most`` distinct host and path pairs are taken, half of them of each label, those of the least hash: the same
    ones however the table is stored. A pair with both labels counts as ``block``. No rows give a model that
    scores one half everywhere.
    """
    host, path = F.coalesce(host_of(F.col(url)), F.lit("")), F.coalesce(path_of(F.col(url)), F.lit(""))
    text = features(host, path)
    known = labelled.where(F.col(label).isin("allow", "block")).select(text.alias("text"), (F.col(label) == "block").alias("blocked"))
    distinct = known.groupBy("text").agg(F.max("blocked").alias("blocked"))
    taken = [distinct.where(w).orderBy(F.xxhash64("text"), "text").limit(most // 2) for w in ("blocked", "NOT blocked")]
    rows = taken[0].union(taken[1]).collect()  # at most ``most``
    rows.sort(key=lambda r: r.text)
    return train([r.text for r in rows], [r.blocked for r in rows])


def judge_urls(df: DataFrame, rules: list[tuple[str, str]], model: UrlModel, url: str = "url") -> DataFrame:
    """``df`` with ``host, path, rule, score, verdict``; columns of ``df`` with these names are replaced.

    ``verdict`` is that of the longest fitting rule, else ``block`` where the model's ``score`` is one half or more, else
    ``allow``. A null URL, or one without ``://``, has an empty host and path, which are scored like any other. Rows stay
    one to one: repeated rows and ties need nothing, a very long URL is scored whole, an empty table stays empty.
    """
    return _apply(df, Rules(rules), model, url)
