"""URL filter: rules first, then the ratio of two character language models.

Pages with a rule are the examples. For accepted and for rejected URLs, character models of
order 0 to 5 are counted, each smoothed with the next shorter one, so that a long context
weighs as much as its counts support. A URL without a rule is
judged by its mean log-likelihood difference against a threshold calibrated on examples
that were not counted. Everything is a built-in expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import stored

ALLOW, BLOCK = "allow", "block"
LONGEST = 6  # characters of a gram: the last one and its context
_START, _END = "\x02", "\x03"
SMOOTHING = 2.0
CALIBRATION_FOLDS = 5
# Grams with at least one in COMMON of all places, at most that many, are joined by broadcast.
COMMON = 10_000
_STEPS = 1e9  # log ratios are added as whole numbers, so their order does not matter
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Longest rule that fits, as struct(verdict, rule); null without one.

    A rule is (verdict, host + path). It fits its host and all subdomains where the path
    starts with the path of the rule.
    """
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def _grams(df: DataFrame) -> DataFrame:
    """One row per character of _url and its end: the character behind the LONGEST - 1 before it."""
    letters = F.filter(F.split(F.lower("_url"), ""), lambda c: c != "")
    padded = F.concat(F.array(*[F.lit(_START)] * (LONGEST - 1)), letters, F.array(F.lit(_END)))
    listed = df.select(*[c for c in df.columns if c != "_url"], padded.alias("_letters"))
    joined = ", ".join(f"_letters[i + {j}]" for j in range(LONGEST))
    return listed.select(
        *[c for c in listed.columns if c != "_letters"],
        F.explode(F.expr(f"transform(sequence(0, size(_letters) - {LONGEST}), i -> concat({joined}))")).alias("_gram"),
    )


def fit(urls: DataFrame) -> DataFrame:
    """Gram, log ratio of accepted to rejected in steps of 1 / _STEPS, and whether it is common.

    ``urls`` has _url, _verdict (null: not an example) and _n, the number of rows. All
    grams are listed, so that those of unjudged URLs find their shorter contexts here. The
    table grows with the URLs.
    """
    kinds = (ALLOW, BLOCK)
    counted = _grams(urls.select("_url", "_verdict", "_n")).groupBy("_gram").agg(
        F.count(F.lit(1)).alias("_places"),
        *[F.sum(F.when(F.col("_verdict") == v, F.col("_n")).otherwise(0)).alias(f"{v}_n") for v in kinds],
    )
    longest = stored(counted, "url-grams")
    before = None
    for size in range(1, LONGEST + 1):
        gram = F.substring("_gram", 1 + LONGEST - size, size)
        sums = [F.sum(f"{c}").alias(c) for c in ("_places", *[f"{k}_n" for k in kinds])]
        grams = longest.groupBy(gram.alias("_gram")).agg(*sums)
        if before is None:
            every = Window.partitionBy()
            grams = grams.withColumns({f"{k}_less": 1.0 / F.count(F.lit(1)).over(every) for k in kinds})
        else:
            shorter = before.select(F.col("_gram").alias("_shorter"), *[F.col(f"{k}_p").alias(f"{k}_less") for k in kinds])
            grams = grams.withColumn("_shorter", F.substring("_gram", 2, size - 1)).join(shorter, "_shorter")
        around = Window.partitionBy(*([F.substring("_gram", 1, size - 1)] if size > 1 else []))
        before = grams.withColumns(
            {
                f"{k}_p": (F.col(f"{k}_n") + SMOOTHING * F.col(f"{k}_less")) / (F.sum(f"{k}_n").over(around) + SMOOTHING)
                for k in kinds
            }
        )
    places = longest.agg(F.sum("_places")).first()[0] or 0
    return before.select(
        "_gram",
        F.round(F.log(F.col(f"{ALLOW}_p") / F.col(f"{BLOCK}_p")) * _STEPS).cast("long").alias("_ratio"),
        (F.col("_places") * COMMON >= places).alias("_common"),
    )


def scored(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """Adds _score, the mean log ratio over the places of _url, to distinct URLs.

    Places are told apart by two hashes of their URL. Common grams are looked up by broadcast,
    all others meet their row by shuffle; none of these has many places.
    """
    marks = {"_one": F.xxhash64("_url"), "_two": F.xxhash64(F.lit(1), "_url")}
    places = _grams(urls.select("_url").withColumns(marks))
    common = F.broadcast(ratios.filter("_common").select("_gram", "_ratio"))
    rare = ratios.filter("NOT _common").select("_gram", "_ratio")
    sums = [
        found.groupBy("_one", "_two").agg(F.sum("_ratio").alias("_sum"), F.count(F.lit(1)).alias("_places"))
        for found in (places.join(common, "_gram"), places.join(common, "_gram", "left_anti").join(rare, "_gram"))
    ]
    whole = sums[0].unionByName(sums[1]).groupBy("_one", "_two").agg(
        F.round(F.sum("_sum") / F.sum("_places") / _STEPS, 6).alias("_score")
    )
    return urls.withColumns(marks).join(whole, ["_one", "_two"]).drop("_one", "_two")


def threshold(scores: DataFrame) -> float:
    """The score that separates examples best, by the mean of both hit rates.

    ``scores`` has _score, _verdict and _n. Scores are counted in steps of 0.01 first; there
    are few, because a mean log ratio is bounded by the smoothing. Of the values between two
    counted steps, which separate alike, the one nearest to 0 stands. Without both kinds: 0.
    """
    steps = scores.groupBy(F.floor(F.col("_score") * 100).alias("_step")).agg(
        F.sum(F.when(F.col("_verdict") == ALLOW, F.col("_n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("_verdict") == BLOCK, F.col("_n")).otherwise(0)).alias("bad"),
    )
    upto = Window.orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    below = F.lag("_step").over(Window.orderBy("_step")) + 1
    rates = steps.select(
        F.least(F.greatest(F.lit(0), below), F.col("_step")).alias("_step"),
        ((F.sum("good").over(everything) - F.coalesce(F.sum("good").over(upto), F.lit(0))) / F.sum("good").over(everything)).alias("kept"),
        (F.coalesce(F.sum("bad").over(upto), F.lit(0)) / F.sum("bad").over(everything)).alias("cut"),
    )
    best = rates.filter("kept + cut IS NOT NULL").orderBy((F.col("kept") + F.col("cut")).desc(), F.abs("_step")).first()
    return best["_step"] / 100.0 if best else 0.0


def judge(df: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url", into: str = "judged") -> DataFrame:
    """Adds the struct ``into``: host, path, rule, verdict, score (mean log ratio).

    Null URLs count as empty. Every row is kept and repeated rows stay repeated. Without
    examples of both kinds all scores lie at the threshold or are equal, and ties are allowed.
    Long URLs are read whole. An existing column ``into`` is replaced.
    """
    rest = df.drop(into)
    pages = rest.withColumn("_url", F.coalesce(F.col(f"`{url}`"), F.lit("")))
    ruled = rule_of(host_of(F.col("_url")), path_of(F.col("_url")), rules)
    distinct = stored(
        pages.groupBy("_url").agg(F.count(F.lit(1)).alias("_n")).withColumn("_verdict", ruled["verdict"]), "urls"
    )
    counted = F.crc32(F.col("_url")) % CALIBRATION_FOLDS != 0
    ratios = stored(fit(distinct.withColumn("_verdict", F.when(counted, F.col("_verdict")))), "url-ratios")
    scores = scored(distinct, ratios)
    scores = stored(scores, "url-scores")
    cut = threshold(scores.filter(~counted & F.col("_verdict").isNotNull()))
    names = rest.columns
    given = pages.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), "_url")
    judged = given.join(scores.select("_url", "_score"), "_url").withColumn(
        "_rule", rule_of(host_of(F.col("_url")), path_of(F.col("_url")), rules)
    )
    by_model = F.when(F.col("_score") >= cut, ALLOW).otherwise(BLOCK)
    return judged.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in names],
        F.struct(
            host_of(F.col("_url")).alias("host"),
            path_of(F.col("_url")).alias("path"),
            F.col("_rule.rule").alias("rule"),
            F.coalesce(F.col("_rule.verdict"), by_model).alias("verdict"),
            F.col("_score").alias("score"),
        ).alias(into),
    )
