"""URL filter: rules, and for the rest the ratio of two character language models.

Two smoothed variable-order Markov models, of accepted and of rejected URLs, are counted over all
URLs that a rule decides, except a held-out fifth (by hash). Counts of contexts and of contexts with
their next character are kept for orders 0 to `order` - 1, exactly, by the characters themselves, in
a table that grows with the input. A character's probability at an order mixes its count with the
next shorter order's probability, which weighs as much as `prior` observations. The difference of
the log-likelihoods, divided by the number of characters, is compared with the cut that separates
the held-out URLs best.

A character's probability hangs on its gram only, the last `order` characters up to it. So ratios are
worked out once for each distinct gram, order by order: a gram is joined to the gram without its
first character, and such a key has one row for each preceding character at most. Places of the
distinct URLs to be scored get their ratios by a join; the grams with 1 / `HOT` of all places or
more, which are `HOT` at most, are broadcast, so no other key has more than that share.

`fit` and `Model` are an approximation in hashed tables of a fixed size, for models that have to go
into a plan as constants; `judge` does not use them.

Only built-in expressions run on the rows. The number of places and the held-out URLs' bins reach the
driver. A null URL is an empty one; a URL without ``://`` has an empty host and path. Repeated URLs
count as often as they occur. Without accepted or rejected held-out URLs the cut is 0; without any
decided URL all undecided ones pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from igarape.llm.common import let
from igarape.session import cut_lineage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the production filter.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    known = F.coalesce(url, F.lit(""))
    after = F.when(F.instr(known, "://") > 0, F.substr(known, F.instr(known, "://") + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    path = F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def first_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Number of the longest rule that fits, or null."""
    found = F.lit(None).cast("int")
    for number, rule in sorted(enumerate(rules), key=lambda x: len(x[1].name)):
        inside = (host == rule.host) | host.endswith("." + rule.host)
        found = F.when(inside & path.startswith(rule.path), number).otherwise(found)
    return found


@dataclass(frozen=True)
class Model:
    """Hashed counts as comma-separated texts, by class, and the cut on the scores.

    Parts that share one of the `buckets` cells of a table are added up.
    """

    order: int
    buckets: int
    prior: float
    accepted: str
    rejected: str
    cut: float = 0.0

    def _cells(self, framed: Column, i: Column) -> Column:
        """Cells of the character at place `i`: for each order its context, then the context with it."""
        cells = []
        for k in range(1, self.order + 1):
            for width, table in ((k - 1, k - 1), (k, self.order + k - 1)):
                part = F.substr(framed, i - (k - 1), F.lit(width))
                cell = F.pmod(F.xxhash64(part), F.lit(self.buckets)) + F.lit(table * self.buckets)
                cells.append(F.when(i >= k, cell.cast("int")))
        return F.array(*cells)

    def cells(self, url: Column) -> Column:
        """Cells of all characters of a URL, with its end."""

        def over(framed: Column) -> Column:
            return F.transform(F.sequence(F.lit(2), F.length(framed)), lambda i: self._cells(framed, i))

        return let(_framed(url), over)

    def score(self, url: Column) -> Column:
        """Mean log-likelihood difference per character."""
        tables = [F.split(F.lit(text), ",").cast("array<double>") for text in (self.accepted, self.rejected)]

        def chance(cells: Column, table: Column) -> Column:
            value = F.lit(1.0 / 256)
            for k in range(self.order):
                seen, both = F.get(cells, F.lit(2 * k)), F.get(cells, F.lit(2 * k + 1))
                mixed = (F.get(table, both) + self.prior * value) / (F.get(table, seen) + self.prior)
                value = F.coalesce(mixed, value)
            return value

        def mean(cells: Column, accepted: Column, rejected: Column) -> Column:
            each = F.transform(cells, lambda c: F.log(chance(c, accepted)) - F.log(chance(c, rejected)))
            return F.aggregate(each, F.lit(0.0), lambda total, x: total + x) / F.size(cells)

        # Each table is written once in the plan, as a constant.
        return let(tables[0], lambda a: let(tables[1], lambda r: let(self.cells(url), lambda c: mean(c, a, r))))


def _framed(url: Column) -> Column:
    return F.concat(F.lit("\x02"), F.coalesce(url, F.lit("")), F.lit("\x03"))


def _held_out(url: Column) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(5)) == 0


def fit(decided: DataFrame, order: int = 4, buckets: int = 1 << 13, prior: float = 2.0) -> Model:
    """Hashed models of rows (url, verdict), with the cut set on the held-out ones."""
    spark = decided.sparkSession
    empty = Model(order, buckets, prior, "", "")
    cells = (
        decided.filter(~_held_out(F.col("url")))
        .select("verdict", F.explode(F.flatten(empty.cells(F.col("url")))).alias("cell"))
        .filter(F.col("cell").isNotNull())
        .groupBy("cell")
        .agg(F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("r"))
    )
    whole = spark.range(2 * order * buckets).select(F.col("id").cast("int").alias("cell"))
    filled = whole.join(cells, "cell", "left").fillna(0, ["a", "r"])
    ordered = F.sort_array(F.collect_list(F.struct("cell", "a", "r")))
    row = filled.agg(ordered.alias("all")).select(
        F.array_join(F.transform("all", lambda x: x["a"].cast("string")), ",").alias("a"),
        F.array_join(F.transform("all", lambda x: x["r"].cast("string")), ",").alias("r"),
    )
    counts = row.first()
    model = Model(order, buckets, prior, counts["a"], counts["r"])

    scored = decided.filter(_held_out(F.col("url"))).select("verdict", model.score(F.col("url")).alias("score"))
    return Model(order, buckets, prior, model.accepted, model.rejected, best_cut(scored.withColumn("n", F.lit(1))))


def best_cut(scored: DataFrame, steps: int = 64) -> float:
    """The cut that separates rows (verdict, score, n) best: a multiple of 1 / `steps`; scores beyond 16 count as 16."""
    bins = scored.groupBy(
        F.greatest(F.lit(-16 * steps), F.least(F.lit(16 * steps), F.floor(F.col("score") * steps))).alias("bin")
    ).agg(*[F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0)).alias(v) for v in ("allow", "block")])
    found = sorted((int(x["bin"]), x["allow"], x["block"]) for x in bins.collect())
    all_a, all_r = sum(x[1] for x in found), sum(x[2] for x in found)
    if not all_a or not all_r:
        return 0.0
    best, cut, below_a, below_r = -1.0, 0.0, 0, 0
    for place, a, r in found:
        good = (all_a - below_a) / all_a + below_r / all_r
        if good > best:
            best, cut = good, place / steps
        below_a, below_r = below_a + a, below_r + r
    return cut


#: Grams with this part of all places or more are broadcast.
HOT = 1024


def _grams(url: Column, order: int) -> Column:
    """For each character of a URL, and its end, the last `order` characters up to it."""

    def over(framed: Column) -> Column:
        places = F.sequence(F.lit(2), F.length(framed))
        return F.transform(
            places, lambda i: F.substr(framed, F.greatest(F.lit(1), i - (order - 1)), F.least(i, F.lit(order)))
        )

    return let(_framed(url), over)


def gram_ratios(urls: DataFrame, order: int = 4, prior: float = 2.0) -> DataFrame:
    """(gram, places, ratio) of all grams of the URLs to be scored: in how many places a gram
    stands there, and the log-likelihood difference of its last character.

    `urls` has rows (url, a, r, asked): how often a URL counts as accepted and as rejected, and
    whether it is to be scored.
    """
    each = urls.select("a", "r", "asked", F.explode(_grams(F.col("url"), order)).alias("gram"))
    grams = each.groupBy("gram").agg(F.sum("a").alias("a"), F.sum("r").alias("r"), F.count_if("asked").alias("places"))
    ends = grams.select("*", F.explode(F.sequence(F.lit(1), F.length("gram"))).alias("k"))
    both = ends.groupBy(F.right("gram", F.col("k")).alias("gram")).agg(
        F.sum("a").alias("a"),
        F.sum("r").alias("r"),
        F.sum(F.when(F.col("k") == F.length("gram"), F.col("places")).otherwise(0)).alias("places"),
        F.max(F.col("places") > 0).alias("asked"),
    )
    both = both.withColumn("context", F.substr("gram", F.lit(1), F.length("gram") - 1))
    seen = both.groupBy("context").agg(F.sum("a").alias("seen_a"), F.sum("r").alias("seen_r"))
    needed = cut_lineage(both.filter("asked").join(seen, "context"), "grams")

    def mixed(count: str, shorter: Column) -> Column:
        return (F.col(count) + prior * shorter) / (F.col(f"seen_{count}") + prior)

    levels = []
    for k in range(1, order + 1):
        level = needed.filter(F.length("gram") == k)
        below = [F.lit(1.0 / 256), F.lit(1.0 / 256)]
        if levels:
            shorter = levels[-1].select(
                F.col("gram").alias("rest"), F.col("chance_a").alias("below_a"), F.col("chance_r").alias("below_r")
            )
            level = level.withColumn("rest", F.right("gram", F.lit(k - 1))).join(shorter, "rest")
            below = [F.col("below_a"), F.col("below_r")]
        levels.append(
            level.select(
                "gram", "places", mixed("a", below[0]).alias("chance_a"), mixed("r", below[1]).alias("chance_r")
            )
        )
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    ratio = F.log("chance_a") - F.log("chance_r")
    return found.filter(F.col("places") > 0).select("gram", "places", ratio.alias("ratio"))


def scores(urls: DataFrame, order: int = 4, prior: float = 2.0) -> DataFrame:
    """(url, score) of the distinct URLs to be scored in rows (url, a, r, asked): the mean
    log-likelihood difference per character."""
    ratios = cut_lineage(gram_ratios(urls, order, prior), "ratios")
    total = ratios.agg(F.sum("places")).first()[0] or 0
    is_hot = F.col("places") * HOT >= F.lit(total)
    hot = F.broadcast(ratios.filter(is_hot).select("gram", "ratio"))  # `HOT` rows at most
    cold = ratios.filter(~is_hot).select("gram", "ratio")
    places = urls.filter("asked").select("url", F.posexplode(_grams(F.col("url"), order)).alias("place", "gram"))
    told = places.join(hot, "gram").unionByName(places.join(hot, "gram", "left_anti").join(cold, "gram"))
    each = F.sort_array(F.collect_list(F.struct("place", "ratio")))  # not the order in which tasks end
    summed = F.aggregate("each", F.lit(0.0), lambda total, x: total + x["ratio"])
    return told.groupBy("url").agg(each.alias("each")).select("url", (summed / F.size("each")).alias("score"))


def judge(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, score): the models are fitted at once, on all URLs."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"))
    rows = rows.withColumn("host", host).withColumn("path", path)
    rows = rows.withColumn("number", first_rule(F.col("host"), F.col("path"), rules))
    verdicts = F.array(*[F.lit(rule.verdict) for rule in rules])
    names = F.array(*[F.lit(rule.name) for rule in rules])
    verdict = F.get(verdicts, F.col("number"))

    known = F.coalesce("url", F.lit(""))
    held = _held_out(F.col("known"))
    distinct = rows.groupBy(known.alias("known"), verdict.alias("verdict")).agg(F.count("*").alias("n"))
    trained = [F.when((F.col("verdict") == v) & ~held, F.col("n")).otherwise(0).alias(c) for v, c in (("allow", "a"), ("block", "r"))]
    asked = (F.col("verdict").isNull() | held).alias("asked")
    urls = cut_lineage(distinct.select(F.col("known").alias("url"), "verdict", "n", *trained, asked), "urls")
    found = cut_lineage(scores(urls), "scores")
    cut = best_cut(urls.filter("asked").filter(F.col("verdict").isNotNull()).join(found, "url"))

    undecided = rows.filter(F.col("number").isNull())
    undecided = undecided.join(found.withColumnRenamed("url", "known"), known == F.col("known"), "left").drop("known")
    scored = rows.filter(F.col("number").isNotNull()).withColumn("score", F.lit(None).cast("double"))
    scored = scored.unionByName(undecided)
    by_model = F.when(F.col("score") >= cut, "allow").otherwise("block")
    return scored.select(
        "page_id",
        "url",
        "host",
        "path",
        F.get(names, F.col("number")).alias("rule"),
        F.coalesce(verdict, by_model).alias("verdict"),
        "score",
    )
