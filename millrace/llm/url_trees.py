"""URL filter: rules, and gradient-boosted trees for what no rule fits.

URLs that a rule fits are labelled by it.  Trees learn from a bounded sample
of those (``sample_rows``, chosen by hash) on lexical features: lengths, depth,
digit ratio, entropy, parameters, and statistics of the host's suffix over all
labelled URLs.  They are grown level by level on sums of gradients, each level
one grouped aggregate over the sample; gradients are summed as integers, so
the same rows give the same trees.  A tree is a SQL expression.  Everything
here is DataFrame functions.

A null URL, or one without ``://``, has an empty host and path; no rule fits it
and its features are those of an empty text where the URL is null.  Without
labelled URLs, or with labels of one kind, all others get that kind (allow
without any).  Rows are judged one by one; other columns are not looked at.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_UNIT = float(1 << 24)  # gradients are summed in these parts


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rule(verdict: str, name: str) -> Rule:
    """``rule("block", "example.com/en/")``."""
    host, slash, path = name.partition("/")
    return Rule(verdict, host, slash + path)


def with_parts(pages: DataFrame) -> DataFrame:
    """``page_id, url, host, path``."""
    start = F.instr("url", "://")
    rest = F.when(start > 0, F.substring(F.col("url"), start + 3, F.length("url")))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _CAPITALS, _SMALL)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    none = F.lit("")
    return pages.select("page_id", "url", F.coalesce(host, none).alias("host"), F.coalesce(path, none).alias("path"))


def fitting(rules: list[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule's name and verdict, or null."""
    name = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda x: (len(x.name), x.name)):  # the longest is asked first
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def features() -> dict[str, Column]:
    """Lexical features of ``url, host, path``; the suffix ones are joined."""
    url = F.coalesce("url", F.lit(""))
    length = F.greatest(F.length(url), F.lit(1))
    digits = lambda x: F.length(x) - F.length(F.translate(x, "0123456789", ""))
    signs = F.array_distinct(F.split(url, ""))
    spread = F.aggregate(
        F.transform(signs, lambda c: F.length(url) - F.length(F.replace(url, c, F.lit("")))),
        F.lit(0.0),
        lambda total, n: total + F.when(n > 0, n * F.log(n.cast("double"))).otherwise(0.0),
    )
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return {
        "length": F.length(url).cast("double"),
        "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "host_depth": _count(F.col("host"), ".").cast("double"),
        "path_depth": _count(F.col("path"), "/").cast("double"),
        "digit_ratio": digits(url) / length,
        "host_digit_ratio": digits(F.col("host")) / F.greatest(F.length("host"), F.lit(1)),
        "entropy": F.round(F.log(length.cast("double")) - spread / length, 9),
        "parameters": F.when(F.length(query) > 0, _count(query, "&") + 1).otherwise(0).cast("double"),
        "hyphens": _count(url, "-").cast("double"),
        "suffix_blocked": F.coalesce("suffix_blocked", F.lit(0.5)),
        "suffix_often": F.coalesce("suffix_often", F.lit(0.0)),
    }


def suffix() -> Column:
    """The host's last label."""
    return F.substring_index("host", ".", -1)


class Split(NamedTuple):
    feature: str
    cut: float
    left: Split | float
    right: Split | float

    def column(self) -> Column:
        left, right = (x.column() if isinstance(x, Split) else F.lit(x) for x in (self.left, self.right))
        return F.when(F.col(self.feature) <= self.cut, left).otherwise(right)


def _leaf(g: float, h: float, rate: float, keep: float) -> float:
    return -rate * g / (h + keep)


def grow(sample: DataFrame, cuts: dict[str, list[float]], trees: int = 10, depth: int = 3, rate: float = 0.4, keep: float = 1.0) -> list:
    """Boosted trees on ``sample`` (features, ``block`` 0 or 1, ``n`` alike).

    Each level of each tree reads the sample once; what comes back is one row
    for each open node, feature and bin.
    """
    bins = F.array(
        *(
            F.struct(F.lit(i).alias("feature"), sum((F.when(F.col(f) > c, 1).otherwise(0) for c in cuts[f]), F.lit(0)).alias("bin"))
            for i, f in enumerate(cuts)
        )
    )
    names, forest, score = list(cuts), [], F.lit(0.0)
    for _ in range(trees):
        chance = 1 / (1 + F.exp(-score))
        rows = sample.select(
            "*",
            F.round((chance - F.col("block")) * F.col("n") * _UNIT).cast("long").alias("g"),
            F.round(chance * (1 - chance) * F.col("n") * _UNIT).cast("long").alias("h"),
        )
        # Nodes by number: the children of k are 2k + 1 and 2k + 2.
        splits: dict[int, tuple[str, float]] = {}
        leaves: dict[int, float] = {}
        node = F.lit(0)
        for level in range(depth):
            each = rows.select(node.alias("node"), "g", "h", F.explode(bins).alias("b"))
            sums = each.groupBy("node", "b.feature", "b.bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
            table: dict[int, dict[int, dict[int, tuple[float, float]]]] = {}
            for r in sums:
                table.setdefault(r["node"], {}).setdefault(r["feature"], {})[r["bin"]] = (r["g"] / _UNIT, r["h"] / _UNIT)
            for k in sorted(table):
                if k < 2**level - 1 or k in leaves:
                    continue
                whole = [sum(x) for x in zip(*table[k][0].values(), strict=True)]
                best = (1e-6, None, None)
                for f in sorted(table[k]):
                    g = h = 0.0
                    for b in range(len(cuts[names[f]])):
                        dg, dh = table[k][f].get(b, (0.0, 0.0))
                        g, h = g + dg, h + dh
                        gain = g * g / (h + keep) + (whole[0] - g) ** 2 / (whole[1] - h + keep) - whole[0] ** 2 / (whole[1] + keep)
                        if gain > best[0] + 1e-9 and h > 1e-3 and whole[1] - h > 1e-3:
                            best = (gain, f, b, (g, h), (whole[0] - g, whole[1] - h))
                if best[1] is None:
                    leaves[k] = _leaf(*whole, rate, keep)
                    continue
                name, cut = names[best[1]], cuts[names[best[1]]][best[2]]
                splits[k] = (name, cut)
                leaves[2 * k + 1], leaves[2 * k + 2] = _leaf(*best[3], rate, keep), _leaf(*best[4], rate, keep)
            deeper = [k for k in splits if k >= 2**level - 1]
            if not deeper:
                break
            for k in deeper:
                name, cut = splits[k]
                node = F.when(node == k, F.when(F.col(name) <= cut, 2 * k + 1).otherwise(2 * k + 2)).otherwise(node)
                if level < depth - 1:
                    leaves.pop(2 * k + 1), leaves.pop(2 * k + 2)
            if level < depth - 1:
                rows = rows.select("*")

        def tree(k: int) -> Split | float:
            return Split(*splits[k], tree(2 * k + 1), tree(2 * k + 2)) if k in splits else leaves[k]

        forest.append(tree(0))
        score = score + (forest[-1].column() if isinstance(forest[-1], Split) else F.lit(forest[-1]))
    return forest


def judged(pages: DataFrame, rules: list[Rule], sample_rows: int = 20_000, bins: int = 12) -> DataFrame:
    """``page_id, host, path, rule, verdict, block_score`` for every page.

    ``block_score`` is the trees' probability of block, also where a rule
    decides.  Runs the jobs that count labels, sample and grow the trees.
    """
    name, verdict = fitting(rules)
    rows = with_parts(pages).select("*", name.alias("rule"), verdict.alias("by_rule"), suffix().alias("suffix"))
    block = (F.col("by_rule") == "block").cast("int")
    labelled = rows.where("by_rule is not null").select("*", block.alias("block"))
    # Suffixes: block rate, drawn towards one half, and frequency.
    of_suffix = stored(
        labelled.groupBy("suffix").agg(
            ((F.sum("block") + 1) / (F.count(F.lit(1)) + 2)).alias("suffix_blocked"),
            F.log(F.count(F.lit(1)) + 1.0).alias("suffix_often"),
        )
    )
    count = labelled.count()
    step = max(1, math.ceil(count / sample_rows))
    some = labelled.where(F.pmod(F.xxhash64("url"), F.lit(step)) == 0).join(of_suffix, "suffix", "left")
    wanted = features()
    some = some.select(*(c.alias(f) for f, c in wanted.items()), "block")
    some = stored(some.groupBy(*wanted, "block").agg(F.count(F.lit(1)).alias("n")))
    places = [i / bins for i in range(1, bins)]
    found = some.agg(*(F.percentile_approx(f, places, 1000).alias(f) for f in wanted), F.max("block").alias("most"), F.min("block").alias("least")).first()
    if found["most"] is None or found["most"] == found["least"]:
        score = F.lit(1.0 if found["most"] else 0.0)
    else:
        cuts = {f: sorted(set(found[f])) for f in wanted}
        forest = [t for t in grow(some, cuts) if isinstance(t, Split)]
        total = reduce(lambda a, t: a + t.column(), forest, F.lit(0.0))
        score = F.round(1 / (1 + F.exp(-total)), 9)
    whole = rows.join(of_suffix, "suffix", "left").select("page_id", "host", "path", "rule", "by_rule", *(c.alias(f"{f}") for f, c in wanted.items() if f not in ("host", "path")))
    whole = whole.select("page_id", "host", "path", "rule", "by_rule", score.alias("block_score"))
    method = F.when(F.col("block_score") > 0.5, "block").otherwise("allow")
    return whole.select("page_id", "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), "block_score")
