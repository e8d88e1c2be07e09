"""Judge URLs by rules and, where none fits, by gradient-boosted trees, with DataFrame and SQL functions only.

A rule is a host and a path; it fits the host and all its subdomains if the URL's path starts with the rule's. The
longest fitting rule decides. The URLs that rules decide are the labelled ones. How common a host's suffix is, and how often blocked, is
counted over all labelled rows. The trees are trained on at most ``SAMPLE`` distinct labelled URLs, drawn by their
counts (see ``drawn``), on lexical features: length, depth, digit ratio, entropy, parameter counts and the
statistics of the suffix. Each level of a tree is one aggregate over binned features, whose size
does not depend on the data; the finished trees are one SQL expression, so scoring is a plain projection.

A null URL, or one without ``://``, has empty host and path, fits no rule and is judged by the trees. Repeated rows
are judged alike. With no labelled URL, or only one kind, every prediction is the share of blocked labels (0 if none).
Extra columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from hourlake.sources.scratch import written

#: Bound of the trees' training sample, and the model's size.
SAMPLE = 50_000
TREES, DEPTH, BINS, RATE, RIDGE = 12, 3, 16, 0.3, 1.0


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; then up to ``?``, ``#`` or the end."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct ``name, verdict`` of the longest rule that fits, else null."""
    out = F.lit(None)
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    chars = F.split(text, "")
    part = lambda c: F.size(F.filter(chars, lambda x: x == c)) / n
    return F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda acc, c: acc - part(c) * F.log2(part(c)))


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


FEATURES = ("length", "host_length", "labels", "depth", "digits", "digit_ratio", "entropy", "parameters", "query_length", "signs", "last_length", "suffix_share", "suffix_blocked")


def suffix_of(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]*\.[^.]*|[^.]*)$", 1)


def features(rows: DataFrame) -> DataFrame:
    """Adds the lexical features, and ``suffix``, to rows with ``url, host, path``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    tail = F.regexp_extract(url, r"\?([^#]*)", 1)
    digits = _count(url, "[0-9]").cast("double")
    return rows.select(
        "*",
        suffix_of(F.col("host")).alias("suffix"),
        F.length(url).cast("double").alias("length"),
        F.length("host").cast("double").alias("host_length"),
        _count(F.col("host"), r"\.").cast("double").alias("labels"),
        _count(F.col("path"), "/").cast("double").alias("depth"),
        digits.alias("digits"),
        (digits / F.greatest(F.length(url), F.lit(1))).alias("digit_ratio"),
        F.round(entropy(url), 6).alias("entropy"),
        F.when(tail == "", 0.0).otherwise(1.0 + _count(tail, "&")).alias("parameters"),
        F.length(tail).cast("double").alias("query_length"),
        _count(url, r"[-_~%=]").cast("double").alias("signs"),
        F.length(F.regexp_extract("path", r"([^/]*)/?$", 1)).cast("double").alias("last_length"),
    )


def with_suffix_statistics(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """Adds a suffix's share of the labelled rows and how often these are blocked (smoothed; 0.5 if unseen)."""
    return rows.join(stats, "suffix", "left").na.fill({"suffix_share": 0.0, "suffix_blocked": 0.5})


def suffix_statistics(counted: DataFrame) -> DataFrame:
    """``suffix, suffix_share, suffix_blocked`` over all labelled rows, from ``host, y`` and the rows ``n`` of each URL."""
    stats = counted.groupBy(suffix_of(F.col("host")).alias("suffix")).agg(F.sum("n").cast("double").alias("n"), F.sum(F.col("n") * F.col("y")).alias("blocked"))
    stats = written(stats, "suffixes")
    total = stats.agg(F.sum("n")).first()[0] or 1.0
    return stats.select("suffix", (F.col("n") / total).alias("suffix_share"), ((F.col("blocked") + 1) / (F.col("n") + 2)).alias("suffix_blocked"))


def drawn(counted: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` of the distinct URLs, with the ``weight`` each has in the sample.

    Priority sampling: the URLs with the greatest n / u are taken (u: the url's hash as a number between 0 and 1); the
    first one left out has priority t, and a URL stands for max(n, t) rows, so sums over the sample are unbiased.
    URLs of many rows are always in, with their own counts. Weights are scaled down to ``sample`` in all.
    """
    u = F.xxhash64("url").cast("double") / float(1 << 64) + 0.5 + 2.0**-54
    first = written(counted.withColumn("priority", F.col("n") / u).orderBy(F.desc("priority"), "url").limit(sample + 1), "labelled-urls")
    size, least = first.agg(F.count(F.lit(1)), F.min("priority")).first()
    if size <= sample:
        taken = first.withColumn("weight", F.col("n").cast("double"))
    else:
        last = first.where(F.col("priority") == least).agg(F.max("url")).first()[0]
        taken = first.where((F.col("priority") > least) | (F.col("url") < last)).withColumn("weight", F.greatest(F.col("n").cast("double"), F.lit(least)))
    total = taken.agg(F.sum("weight")).first()[0] or 1.0
    return taken.withColumn("weight", F.round(F.col("weight") * min(1.0, sample / total), 9))


@dataclass(frozen=True)
class Node:
    """An inner node (feature, cut, children) or a leaf (value)."""

    value: float = 0.0
    feature: str | None = None
    cut: float = 0.0
    left: "Node | None" = None
    right: "Node | None" = None

    def expression(self) -> str:
        if self.feature is None:
            return f"{self.value!r}D"
        return f"(CASE WHEN {self.feature} <= {self.cut!r}D THEN {self.left.expression()} ELSE {self.right.expression()} END)"

    def paths(self, here: str = "true") -> list[tuple[str, "Node"]]:
        if self.feature is None:
            return [(here, self)]
        below = f"{self.feature} <= {self.cut!r}D"
        return self.left.paths(f"{here} AND {below}") + self.right.paths(f"{here} AND NOT {below}")


@dataclass(frozen=True)
class Model:
    prior: float
    trees: tuple[Node, ...] = ()

    def margin(self) -> str:
        return " + ".join([f"{self.prior!r}D", *[t.expression() for t in self.trees]])

    def probability(self) -> Column:
        return F.expr(f"1D / (1D + exp(-({self.margin()})))")


def _best_split(cells: list, parent: tuple[float, float]) -> tuple[float, str, int] | None:
    """The feature and bin after which to cut, with the gain; cells are (feature, bin, gradient, hessian)."""
    score = lambda g, h: g * g / (h + RIDGE)
    best = None
    by_feature: dict[str, list] = {}
    for feature, b, g, h in cells:
        by_feature.setdefault(feature, []).append((b, g, h))
    for feature, bins in sorted(by_feature.items()):
        g = h = 0.0
        for b, bg, bh in sorted(bins)[:-1]:
            g, h = g + bg, h + bh
            gain = score(g, h) + score(parent[0] - g, parent[1] - h) - score(*parent)
            if min(h, parent[1] - h) >= 1.0 and (best is None or gain > best[0] + 1e-9):
                best = (gain, feature, b)
    return best if best and best[0] > 1e-6 else None


def _grown(tree: Node, splits: dict[int, tuple[str, float]]) -> Node:
    """The tree with its leaves, numbered from the left, split."""
    number = iter(range(1 << (DEPTH + 1)))

    def grow(node: Node) -> Node:
        if node.feature is None:
            k = next(number)
            return Node(0.0, *splits[k], Node(), Node()) if k in splits else node
        return Node(node.value, node.feature, node.cut, grow(node.left), grow(node.right))

    return grow(tree)


def _valued(tree: Node, values: dict[int, float]) -> Node:
    number = iter(range(1 << (DEPTH + 1)))

    def fill(node: Node) -> Node:
        if node.feature is None:
            return Node(values.get(next(number), 0.0))
        return Node(0.0, node.feature, node.cut, fill(node.left), fill(node.right))

    return fill(tree)


def _leaf(tree: Node) -> Column:
    return F.expr("CASE " + " ".join(f"WHEN {path} THEN {k}" for k, (path, _) in enumerate(tree.paths())) + " END")


def train(sample: DataFrame) -> Model:
    """Boosted trees from ``FEATURES``, ``y`` (1: block) and ``weight``; the sample is a written table."""
    kinds = {r["y"]: r["weight"] for r in sample.groupBy("y").agg(F.sum("weight").alias("weight")).collect()}  # two at most
    n, blocked = sum(kinds.values()), kinds.get(1.0, 0.0)
    if len(kinds) < 2:
        return Model(20.0 if n and blocked else -20.0)
    from math import log

    model = Model(log(blocked / (n - blocked)))
    quantiles = sample.agg(*[F.percentile_approx(f, [k / BINS for k in range(1, BINS)], 1000).alias(f) for f in FEATURES]).first()
    cuts = {f: sorted(set(quantiles[f])) for f in FEATURES}
    bin_of = lambda f: sum((F.when(F.col(f) > c, 1).otherwise(0) for c in cuts[f]), F.lit(0))
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), bin_of(f).alias("bin")) for f in FEATURES])).alias("cell")
    for _ in range(TREES):
        p = model.probability()
        state = sample.select("*", (F.col("weight") * (F.col("y") - p)).alias("g"), (F.col("weight") * p * (1 - p)).alias("h"))
        tree = Node()
        for _ in range(DEPTH):
            sums = state.select(_leaf(tree).alias("leaf"), "g", "h", cells).groupBy("leaf", "cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
            by_leaf: dict[int, list] = {}
            for r in sums:  # leaves x features x bins at most
                by_leaf.setdefault(r["leaf"], []).append((r["cell"]["feature"], r["cell"]["bin"], round(r["g"], 9), round(r["h"], 9)))
            splits = {}
            for leaf, got in by_leaf.items():
                whole = (sum(g for f, _, g, _ in got if f == FEATURES[0]), sum(h for f, _, _, h in got if f == FEATURES[0]))
                if (found := _best_split(got, whole)) and found[2] < len(cuts[found[1]]):
                    splits[leaf] = (found[1], cuts[found[1]][found[2]])
            if not splits:
                break
            tree = _grown(tree, splits)
        leaves = state.groupBy(_leaf(tree).alias("leaf")).agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
        model = Model(model.prior, (*model.trees, _valued(tree, {r["leaf"]: round(RATE * r["g"] / (r["h"] + RIDGE), 9) for r in leaves})))
        if all(r["h"] < 1e-3 for r in leaves):
            break
    return model


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> DataFrame:
    """``page_id, host, path, rule, verdict, probability`` (of blocking, by the trees) of every page."""
    url = F.col("url").cast("string")
    host, path = host_and_path(url)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    labelled = rows.where("fit is not null").select("url", F.when(F.col("fit.verdict") == "block", 1.0).otherwise(0.0).alias("y"))
    counted = written(labelled.groupBy("url", "y").agg(F.count(F.lit(1)).alias("n")), "url-counts")  # a url has one label
    host, path = host_and_path(F.col("url"))
    counted = counted.select("*", host.alias("host"), path.alias("path"))
    stats = written(suffix_statistics(counted), "suffix-statistics")
    model = train(written(with_suffix_statistics(features(drawn(counted, sample)), stats).select(*FEATURES, "y", "weight"), "url-sample"))
    scored = with_suffix_statistics(features(rows), stats).withColumn("probability", model.probability())
    by_model = F.when(F.col("probability") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", F.col("fit.name").alias("rule"), F.coalesce("fit.verdict", by_model).alias("verdict"), "probability")
