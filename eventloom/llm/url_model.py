"""URL filters: a character language-model ratio, with fixed host rules before it.

The models are counts of three characters in a row over an alphabet of ``len(ALPHABET)``
symbols. Their tables have that many entries cubed at most, whatever the data: this is the
bound of what reaches the driver and of the literal that scores a URL.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import let
from eventloom.session import stage_table

# Symbol 0 stands for the beginning, the last one for every other character; digits are one.
ALPHABET = "^" + string.ascii_lowercase + "0" + ":/.-_?=&#%+~" + "*"
SIZE = len(ALPHABET)


@dataclass(frozen=True)
class UrlRule:
    """``host`` and its subdomains, for paths that start with ``path``."""

    allow: bool
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def column(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def rule_column(rules: list[UrlRule], host: Column, path: Column, value) -> Column:
    """``value`` of the longest rule that fits, else null."""
    out = F.lit(None)
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        out = F.when(rule.column(host, path), F.lit(value(rule))).otherwise(out)
    return out


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or a URL without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def symbols(url: Column) -> Column:
    """Codes of the alphabet, one a character, after two beginnings."""
    text = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), "[0-9]", "0")
    text = F.regexp_replace(text, "[^a-z0:/.\\-_?=&#%+~]", "*")
    code = F.lit(ALPHABET)
    return F.transform(F.split(F.concat(F.lit("^^"), text), ""), lambda c: F.instr(code, c) - 1)


def trigrams(url: Column) -> Column:
    """Of each character the number of (two before it, one before it, itself)."""
    return let(
        F.filter(symbols(url), lambda x: x >= 0),
        lambda s: F.transform(
            F.slice(s, 3, F.greatest(F.size(s) - 2, F.lit(0))),
            lambda x, i: (F.get(s, i) * SIZE + F.get(s, i + 1)) * SIZE + x,
        ),
    )


def _conditionals(counts: dict[int, int], min_context: int) -> list[float]:
    """log2 P(c | two before) for each trigram.

    Variable order: the longest context seen ``min_context`` times or more is used, smoothed
    into the next shorter one by Witten and Bell's weight; rarer contexts are skipped.
    """
    uni, bi, tri = [0] * SIZE, {}, {}
    for key, n in counts.items():
        a, b, c = key // SIZE // SIZE, key // SIZE % SIZE, key % SIZE
        uni[c] += n
        bi.setdefault(b, {}).setdefault(c, 0)
        bi[b][c] += n
        tri.setdefault((a, b), {})[c] = n

    def mixed(own: dict[int, int], shorter: list[float]) -> list[float]:
        total, kinds = sum(own.values()), len(own)
        if total < min_context or not total:
            return shorter
        return [(own.get(c, 0) + kinds * shorter[c]) / (total + kinds) for c in range(SIZE)]

    base = mixed({c: n for c, n in enumerate(uni) if n}, [1 / SIZE] * SIZE)
    second = [mixed(bi.get(b, {}), base) for b in range(SIZE)]
    out: list[float] = []
    for a in range(SIZE):
        for b in range(SIZE):
            out += [math.log2(p) for p in mixed(tri.get((a, b), {}), second[b])]
    return out


@dataclass(frozen=True)
class UrlModel:
    """``weights``: a comma-joined log ratio for each trigram. ``threshold``: lowest accepted score."""

    weights: str
    threshold: float

    def score(self, grams: Column) -> Column:
        """Mean log2 ratio a character, accepted against rejected; 0 for no characters."""
        table = F.split(F.lit(self.weights), ",").cast("array<float>")  # folded to one literal
        total = F.aggregate(grams, F.lit(0.0), lambda acc, g: acc + F.get(table, g))
        return F.when(F.size(grams) > 0, total / F.size(grams)).otherwise(0.0)


def fit(labelled: DataFrame, min_context: int = 8, steps: int = 256) -> UrlModel:
    """Fit on rows (``grams``, ``accepted``, ``calibrate``), all of them counted by Spark.

    Rows with ``calibrate`` only set the threshold: the one with the highest balanced accuracy
    among ``steps`` equal steps, the lowest of equals. Without rows of either class the
    threshold is 0, and with no rows at all every score is 0, which is accepted.
    """
    counts: dict[bool, dict[int, int]] = {True: {}, False: {}}
    counted = (
        labelled.where(~F.col("calibrate"))
        .select("accepted", F.explode("grams").alias("gram"))
        .groupBy("accepted", "gram")
        .count()
    )
    for row in counted.collect():  # at most 2 * SIZE ** 3 rows
        counts[row["accepted"]][row["gram"]] = row["count"]
    yes, no = (_conditionals(counts[x], min_context) for x in (True, False))
    model = UrlModel(",".join(f"{a - b:.4f}" for a, b in zip(yes, no)), 0.0)
    low, high = -4.0, 4.0
    step = F.floor((F.least(F.greatest(F.col("score"), F.lit(low)), F.lit(high)) - low) / (high - low) * steps)
    table = (
        labelled.where("calibrate")
        .select("accepted", model.score(F.col("grams")).alias("score"))
        .groupBy("accepted", step.alias("step"))
        .count()
        .collect()  # at most 2 * (steps + 1) rows
    )
    sums = {x: sum(r["count"] for r in table if r["accepted"] == x) for x in (True, False)}
    if not all(sums.values()):
        return model
    best = (-1.0, 0.0)
    for k in range(steps + 1):
        right = sum(r["count"] / sums[True] for r in table if r["accepted"] and r["step"] >= k)
        right += sum(r["count"] / sums[False] for r in table if not r["accepted"] and r["step"] < k)
        best = max(best, (right, -k / steps * (high - low) - low))
    return UrlModel(model.weights, -best[1])


def judge_urls(
    pages: DataFrame, rules: list[UrlRule], id_col: str = "page_id", url_col: str = "url", **fitting
) -> DataFrame:
    """``id_col``, host, path, rule, verdict and score of every row.

    The model learns from the URLs that a rule decides (a fifth of them, by a hash of the
    URL, calibrates) and decides the others; repeated URLs count as often as they occur. Null
    and empty URLs, and those without ``://``, have an empty host and path and no rule; they
    are scored like others, null as empty, which is accepted if the threshold is at most 0.
    """
    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path"), F.col(url_col).alias("_url")).select(
        id_col,
        "host",
        "path",
        rule_column(rules, F.col("host"), F.col("path"), lambda r: r.name).cast("string").alias("rule"),
        rule_column(rules, F.col("host"), F.col("path"), lambda r: r.allow).cast("boolean").alias("accepted"),
        (F.pmod(F.xxhash64("_url"), F.lit(5)) == 0).alias("calibrate"),
        trigrams(F.col("_url")).alias("grams"),
    )
    rows = stage_table(rows, "urls")
    model = fit(rows.where("accepted is not null"), **fitting)
    score = model.score(F.col("grams"))
    return rows.withColumn("score", score).select(
        id_col,
        "host",
        "path",
        "rule",
        F.when(F.coalesce("accepted", F.col("score") >= model.threshold), "allow").otherwise("block").alias("verdict"),
        "score",
    )
