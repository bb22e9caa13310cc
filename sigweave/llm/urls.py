"""URL filter: longest matching rule, else gradient-boosted trees on lexical features."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigweave.llm.common import last_place

# Fixed production rules: (host and its subdomains, start of the path, verdict).
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
FEATURES = [
    "length", "host_length", "path_length", "path_depth", "host_depth", "digit_ratio",
    "host_digit_ratio", "entropy", "host_entropy", "parameters", "hyphens", "longest_part",
    "suffix_rate",
]
# Documented bound of the labelled URLs that trees are grown on.
TRAIN_ROWS = 20_000
ROUNDS = 40
DEPTH = 3
BINS = 32
RATE = 0.2
SMOOTHING = 5.0
# Hosts are dealt into so many parts; a training row's suffix_rate leaves out its own part.
FOLDS = 5


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host and path; both are empty for a null url and one without ``://``."""
    url = F.col("url").cast("string")
    after = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    return pages.select(F.col("page_id"), url.alias("url")).select(
        "page_id",
        "url",
        F.coalesce(_lower(host), F.lit("")).alias("host"),
        F.coalesce(path, F.lit("")).alias("path"),
    )


def ruled(rows: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Adds rule and rule_verdict of the longest rule that fits, null where none does."""
    name = verdict = F.lit(None).cast("string")
    for host, path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col(
            "path"
        ).startswith(path)
        name = F.when(fits, F.lit(host + path)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rows.withColumns({"rule": name, "rule_verdict": verdict})


def with_suffix_rate(rows: DataFrame, labelled: DataFrame, held_out: bool = False) -> DataFrame:
    """Adds suffix_rate, the smoothed share of blocked among the labelled URLs of a suffix.

    ``labelled`` has host, blocked (0 or 1) and rule. A suffix is what follows a host's last
    dot. An unseen one has the share of all, and so has one that a single rule labels: its
    share would only repeat that rule. With ``held_out`` a row's share is that of the hosts in
    other folds, so its own label is no feature of it.
    """
    suffix = F.substring_index("host", ".", -1)
    fold = F.pmod(F.xxhash64("host"), F.lit(FOLDS))
    # A suffix without a single URL is the total: hot suffixes are combined before the shuffle.
    folds = labelled.groupBy(suffix.alias("suffix"), fold.alias("fold")).agg(
        F.sum("blocked").alias("bad"),
        F.count("*").alias("all"),
        F.min("rule").alias("low"),
        F.max("rule").alias("high"),
    )
    stats = folds.groupBy("suffix").agg(
        F.sum("bad").alias("bad"),
        F.sum("all").alias("all"),
        F.coalesce(F.min("low") == F.max("high"), F.lit(False)).alias("alone"),
    )
    totals = labelled.agg(F.coalesce(F.avg("blocked"), F.lit(0.5))).first()[0]
    joined = rows.withColumns({"suffix": suffix, "fold": fold}).join(stats, "suffix", "left")
    bad, every = F.col("bad"), F.col("all")
    if held_out:
        own = folds.select(
            "suffix", "fold", F.col("bad").alias("own_bad"), F.col("all").alias("own_all")
        )
        joined = joined.join(own, ["suffix", "fold"], "left")
        bad = bad - F.coalesce("own_bad", F.lit(0))
        every = every - F.coalesce("own_all", F.lit(0))
    rate = F.when(~F.col("alone"), (bad + SMOOTHING * totals) / (every + SMOOTHING))
    return joined.withColumn("suffix_rate", F.coalesce(rate, F.lit(totals))).drop(
        "suffix", "fold", "bad", "all", "alone", "own_bad", "own_all"
    )


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def _digits(text: str) -> float:
    return sum(c.isdigit() for c in text) / max(1, len(text))


def features(url: str | None, host: str, path: str, suffix_rate: float) -> list[float]:
    url = url or ""
    # The suffix speaks through suffix_rate only: its letters would spell the rules' verdicts.
    name = host.rpartition(".")[0]
    scheme, mark, rest = url.partition("://")
    line = scheme + mark + name + rest[len(host) :]
    query = url.partition("#")[0].partition("?")[2]
    parts = name.split(".") + path.split("/")
    return [
        len(line), len(name), len(path), path.count("/"), host.count("."), _digits(line),
        _digits(name), _entropy(line), _entropy(name), query.count("=") or int(bool(query)),
        name.count("-") + path.count("-"), max(map(len, parts)), suffix_rate,
    ]


@dataclass
class Trees:
    """Boosted regression trees for the log-odds of blocking; nodes in heap order."""

    base: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            total += value[node]
        return total


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees from features and labels; with one kind of label only, that label always."""
    if not len(y) or y.min() == y.max():
        # Nothing known is allowed.
        return Trees(base=4.0 if len(y) and y[0] else -4.0)
    share = y.mean()
    model = Trees(base=float(math.log(share / (1 - share))))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, x.T, strict=True)], axis=1)
    margin = np.full(len(y), model.base)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-margin))
        tree = _tree(binned, cuts, p - y, p * (1 - p))
        model.trees.append(tree)
        one = Trees(0.0, [tree])
        margin += one.margin(x)
    return model


def _tree(binned, cuts, gradient, hessian):
    inner, nodes = 2**DEPTH - 1, 2 ** (DEPTH + 1) - 1
    feature, cut, value = np.zeros(nodes, int), np.full(nodes, np.inf), np.zeros(nodes)
    node = np.zeros(len(gradient), dtype=np.int64)
    for n in range(nodes):
        rows = np.flatnonzero(node == n)
        g, h = gradient[rows].sum(), hessian[rows].sum()
        value[n] = -RATE * g / (h + 1.0)
        if n >= inner or len(rows) < 2:
            # Without a split every row goes left; the left child takes over the rows.
            if n < inner:
                node[rows] = 2 * n + 1
            continue
        best, chosen = 1e-9, None
        for f, c in enumerate(cuts):
            bins = binned[rows, f]
            left_g = np.cumsum(np.bincount(bins, gradient[rows], len(c) + 1))[:-1]
            left_h = np.cumsum(np.bincount(bins, hessian[rows], len(c) + 1))[:-1]
            gain = left_g**2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g**2 / (h + 1)
            if len(gain) and gain.max() > best:
                best, chosen = gain.max(), (f, int(gain.argmax()))
        if chosen:
            feature[n], cut[n] = chosen[0], cuts[chosen[0]][chosen[1]]
            node[rows] = 2 * n + 1 + (binned[rows, chosen[0]] > chosen[1])
        else:
            node[rows] = 2 * n + 1
    return feature, cut, value


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    columns = [batch.column(c).to_pylist() for c in ("url", "host", "path", "suffix_rate")]
    return np.array([features(*r) for r in zip(*columns, strict=True)], dtype=float).reshape(
        -1, len(FEATURES)
    )


def fit(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> Trees:
    """Trees from ``labelled`` (url, host, path, suffix_rate, blocked), about ``train_rows`` rows.

    The rows are drawn by a hash of the URL; a URL counts once with each label, however often
    rows repeat it.
    """
    place = F.xxhash64("url", F.lit(13))
    urls = labelled.agg(F.count_distinct(place)).first()[0]
    drawn = labelled.filter(place <= last_place(train_rows, max(1, urls)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array(list(_matrix(batch)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([x, batch.column("blocked")], ["x", "blocked"])

    # Merged before the driver sees them, since copies of a URL have no bound.
    chosen = drawn.select(
        "url", "host", "path", "suffix_rate", F.col("blocked").cast("int")
    ).distinct()
    rows = sorted(map(tuple, chosen.mapInArrow(run, "x array<double>, blocked int").collect()))
    x = np.array([r[0] for r in rows], dtype=float).reshape(-1, len(FEATURES))
    return grow(x, np.array([r[1] for r in rows], dtype=float))


def judge(
    pages: DataFrame,
    labelled: DataFrame | None = None,
    rules: list[tuple[str, str, str]] = RULES,
) -> DataFrame:
    """page_id, host, path, rule, verdict and p_block of every page.

    ``labelled`` (url, blocked) teaches the trees; without it they learn from the pages that a
    rule decides. A rule's verdict always stands. A null url, one without ``://`` and an
    empty one have no host and are judged by the trees. Rows that repeat come out as often as
    they came in; other columns are not read. Without labelled URLs everything is allowed.
    """
    rows = ruled(parsed(pages), rules)
    if labelled is None:
        known = rows.filter("rule IS NOT NULL").withColumn(
            "blocked", (F.col("rule_verdict") == "block").cast("int")
        )
    else:
        known = parsed(labelled.withColumn("page_id", F.col("blocked").cast("int"))).withColumn(
            "blocked", F.col("page_id")
        ).filter("blocked IN (0, 1)").withColumn("rule", F.lit(None).cast("string"))
    model = fit(with_suffix_rate(known, known, held_out=True))
    names = "page_id, host, path, rule, rule_verdict"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = 1 / (1 + np.exp(-model.margin(_matrix(batch))))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names.split(", ")), pa.array(p)],
                [*names.split(", "), "p_block"],
            )

    judged = with_suffix_rate(rows, known).mapInArrow(
        run,
        f"page_id {dict(rows.dtypes)['page_id']}, host string, path string, rule string,"
        " rule_verdict string, p_block double",
    )
    method = F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", method).alias("verdict"), "p_block"
    )
