"""URL filters by a ratio of character language models.

Two smoothed variable-order Markov models are fitted, to accepted and to
rejected URLs.  A URL's score is the difference of its log-probabilities under
the two, divided by its length, less a threshold calibrated on URLs that
neither model was fitted to.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from levyframe.llm.common import drop_columns, packed, quoted, read, result_schema, unpacked

ORDER = 5
#: Labelled URLs of each kind that the models are fitted to and calibrated with, by hash; this bounds the model, which goes to all tasks.
FIT_URLS, CALIBRATION_URLS = 8000, 4000
#: Scores of (context, character) that a Python worker remembers.
REMEMBERED = 500_000


@dataclass(frozen=True)
class Rule:
    """A host, its subdomains, and a path's beginning."""

    rule: str
    verdict: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


RULES = (Rule("net/", "block"), Rule("example.net/en/", "allow"), Rule("example.com/de/", "block"), Rule("org/fr/", "allow"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first :// up to / ? # or the end, and from there up to ? # or the end; empty without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return ascii_lower(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, else null; of equally long ones the first."""
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.rule)):  # longer ones go outermost
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.lit(r.rule)).otherwise(found)
    return found


@dataclass
class Markov:
    """Characters given up to ORDER before them, orders mixed as Witten and Bell do."""

    order: int = ORDER
    counts: dict[str, Counter] = field(default_factory=dict)

    def fit(self, texts: Iterable[str]) -> Markov:
        for text in texts:
            padded = "\n" * self.order + text + "\n"
            for i in range(self.order, len(padded)):
                c = padded[i]
                for k in range(self.order + 1):
                    self.counts.setdefault(padded[i - k : i], Counter())[c] += 1
        return self

    def probability(self, context: str, c: str) -> float:
        p = 1 / 65536
        for k in range(len(context) + 1):
            seen = self.counts.get(context[len(context) - k :])
            if seen is None:
                break
            n, kinds = seen.total(), len(seen)
            p = (seen[c] + kinds * p) / (n + kinds)
        return p


@dataclass
class Ratio:
    accepted: Markov
    rejected: Markov
    threshold: float = 0.0
    known: dict[tuple[str, str], float] = field(default_factory=dict)

    def raw(self, text: str) -> float:
        """Log-likelihood difference a character; 0 for an empty text."""
        if not text:
            return 0.0
        order, total, known = self.accepted.order, 0.0, self.known
        padded = "\n" * order + text + "\n"
        for i in range(order, len(padded)):
            key = (padded[i - order : i], padded[i])
            score = known.get(key)
            if score is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                score = known[key] = math.log(self.accepted.probability(*key)) - math.log(self.rejected.probability(*key))
            total += score
        return total / (len(text) + 1)

    def score(self, text: str) -> float:
        """Positive for what looks accepted; 0 for an empty text, whatever the threshold."""
        return self.raw(text) - self.threshold if text else 0.0


def best_threshold(accepted: Sequence[float], rejected: Sequence[float]) -> float:
    """The cut with the largest sum of both kinds' shares on their own side, midway between neighbours."""
    if not accepted or not rejected:
        return 0.0
    ordered = sorted([(s, True) for s in accepted] + [(s, False) for s in rejected])
    good, best = 1.0, (1.0, ordered[0][0] - 1e-9)  # all above the cut
    for (s, ok), following in zip(ordered, [*ordered[1:], (ordered[-1][0] + 2e-9, True)], strict=True):
        good += -1 / len(accepted) if ok else 1 / len(rejected)
        if following[0] > s and good > best[0]:
            best = (good, (s + following[0]) / 2)
    return best[1]


def fit_ratio(labelled: DataFrame) -> Ratio:
    """(text, accepted boolean) -> a calibrated model, from a bounded sample of distinct texts by hash."""
    model, folds = {}, {}
    for kind in (True, False):
        order = F.xxhash64("text")
        sample = labelled.where(F.col("accepted") == kind).select("text").where("text <> ''").distinct().orderBy(order, "text").limit(FIT_URLS + CALIBRATION_URLS)
        texts = [r.text for r in sample.collect()]
        hold = len(texts) * CALIBRATION_URLS // (FIT_URLS + CALIBRATION_URLS)
        model[kind], folds[kind] = Markov().fit(texts[hold:]), texts[:hold]
    ratio = Ratio(model[True], model[False])
    ratio.threshold = best_threshold([ratio.raw(t) for t in folds[True]], [ratio.raw(t) for t in folds[False]])
    return ratio


def with_scores(rows: DataFrame, ratio: Ratio, text_col: str) -> DataFrame:
    """rows with the text column, which comes last, replaced by score."""
    kept = [f for f in rows.schema.fields if f.name != text_col]
    ratio.known = {}
    shared = rows.sparkSession.sparkContext.broadcast(ratio)  # bounded by FIT_URLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = [model.score(t or "") for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*batch.schema.names[:-1], "score"])

    return rows.select(*[quoted(f.name) for f in kept], quoted(text_col)).mapInArrow(run, result_schema(kept, "score double"))


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, *, url_col: str = "url") -> DataFrame:
    """pages without the URL, with host, path, rule, verdict and score.

    A rule's verdict holds where one fits; the models are fitted to such URLs
    (host and path) and judge the others: allow where the score is 0 or more.
    Null URLs and those without :// have an empty host and path, no rule, and
    score 0.  Repeated rows are judged alike; without labelled URLs of both
    kinds all that no rule fits is allowed; an empty table gives an empty
    result.  Columns of pages with the results' names are replaced.
    """
    host, path = url_parts(F.col(quoted(url_col)))
    kept = drop_columns(pages, ["host", "path", "rule", "verdict", "score"])
    parts = packed(kept, [url_col], host=host, path=path)
    ruled = parts.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules)).withColumn("text", F.concat("host", "path"))
    allowed = F.col("rule").isin([r.rule for r in rules if r.verdict == "allow"])
    ratio = fit_ratio(ruled.where("rule is not null").select("text", allowed.alias("accepted")))
    scored = with_scores(ruled, ratio, "text")
    by_rule = F.when(allowed, "allow").when(F.col("rule").isNotNull(), "block")
    verdict = F.coalesce(by_rule, F.when(F.col("score") >= 0, "allow").otherwise("block"))
    return scored.select(*unpacked(scored, [c for c in kept.columns if c != url_col]), "host", "path", "rule", verdict.alias("verdict"), "score")


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages").select("page_id", "url"))


QUERIES = {"op10_urls": op10_urls}
SQL: dict[str, str] = {}
