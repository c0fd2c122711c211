"""URL verdicts: a rule list first, then gradient-boosted trees on lexical features."""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host and path start).
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
_MAX_RULES = 200
_CHARS = _LOWER + "0123456789.-_"


def parts_of(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path and the rest; all empty without ``://`` and for null."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    tail = F.regexp_extract(rest, "(?s)^[^?#]*(.*)$", 1)
    return F.translate(host, _UPPER, _LOWER), path, tail


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null.

    A rule fits its host and all subdomains if the url's path starts with the rule's. Rules
    are a parameter, written into the expression; more than 200 are refused.
    """
    if len(rules) > _MAX_RULES:
        raise ValueError(f"at most {_MAX_RULES} rules")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):  # the longest comes outermost
        own, slash, start = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + start)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


# What the built-in labelled urls are made of.
_WORDS = """bank paper river stone market garden music travel house sport kitchen school health light cloud
bridge summer winter radio forum photo design energy animal planet hotel insurance doctor library camera
berg wasser zeit haus stadt buch schule reise freund garten livre maison ville jour monde jardin casa
libro mundo tienda coche noticias campo playa""".split()
_USUAL_SUFFIXES = "com com com com org org net net edu gov de de fr es co.uk io ch at".split()
_CHEAP_SUFFIXES = "top xyz click info biz win loan work icu online site club ru cn".split()
_STEPS = "en de news blog shop about page index article archive wiki category images static download".split()


def labelled_urls(count: int = 3000, seed: int = 11, words: Sequence[str] = tuple(_WORDS)) -> list[tuple[str, int]]:
    """``(url, 1 to block)``, half of each kind, with names of the same words, joined by a hyphen
    as often in both. What tells them apart is the form that link farms, trackers, phishing
    pages and dubious shops give their addresses: cheap suffixes, digits, scrambled and long
    names, many labels, deep and scrambled paths, many and long parameters. Of these traits a
    url to block has two or more, any other one now and then."""
    rng = random.Random(seed)

    def noise(n: int, letters: str = _LOWER + "0123456789") -> str:
        return "".join(rng.choices(letters, k=n))

    def name(low: int, high: int) -> str:
        return rng.choice(("", "", "-")).join(rng.choices(words, k=rng.randint(low, high)))

    def traits(bad: int) -> set[str]:
        kinds = ["cheap", "digits", "scrambled", "long", "labels", "deep", "noisy", "parameters", "tail", "number"]
        return set(rng.sample(kinds, rng.choice((2, 3, 3, 4)) if bad else rng.choice((0, 0, 0, 0, 1, 1))))

    out = []
    for i in range(count):
        has = traits(i % 2)
        host = noise(rng.randint(8, 24)) if "scrambled" in has else name(3, 6) if "long" in has else name(1, 2)
        host += noise(rng.randint(2, 6), "0123456789") if "digits" in has else ""
        front = [noise(rng.randint(2, 8)) if rng.random() < 0.5 else name(1, 1) for _ in range(rng.randint(2, 4))] if "labels" in has else rng.choice(([], [], ["www"], ["www"], ["blog"], ["m"], [name(1, 1)]))
        host = ".".join([*front, host, rng.choice(_CHEAP_SUFFIXES if "cheap" in has else _USUAL_SUFFIXES)])
        if "number" in has and rng.random() < 0.5:
            host = ".".join(str(rng.randrange(1, 255)) for _ in range(4))
        steps = [rng.choice((name(1, 2), rng.choice(_STEPS), rng.choice(_STEPS), str(rng.randrange(5000)))) for _ in range(rng.randint(5, 8) if "deep" in has else rng.choice((0, 0, 1, 1, 2, 2, 3, 4)))]
        steps += ["-".join(rng.choices(words, k=rng.randint(3, 9)))] if rng.random() < (0.1 if i % 2 else 0.4) else []
        steps += [noise(rng.randint(8, 18))] if "noisy" in has else []
        steps += [noise(rng.randint(7, 13), "0123456789")] if "number" in has else []
        asked = rng.randint(3, 8) if "parameters" in has else rng.choice((0, 0, 0, 1, 1, 2))
        tail = "&".join(f"{rng.choice(_STEPS)}={noise(rng.randint(12, 24)) if 'tail' in has else noise(rng.randint(1, 4))}" for _ in range(max(asked, "tail" in has)))
        out.append((f"{rng.choice(('http', 'https', 'https'))}://{host}/{'/'.join(steps)}{rng.choice(('', '', '/', '.html'))}{'?' * bool(tail)}{tail}{rng.choice(('', '', '', '#top'))}", i % 2))
    return out


def suffix_statistics(labelled: Sequence[tuple[str, int]]) -> tuple[dict[str, float], dict[str, float]]:
    """By suffix (the host's last label): smoothed log odds of blocking, and the share of urls."""
    bad, every = Counter(), Counter()
    for url, label in labelled:
        suffix = url.partition("://")[2].partition("/")[0].partition("?")[0].partition("#")[0].rpartition(".")[2].lower()
        every[suffix] += 1
        bad[suffix] += label
    odds = {k: math.log((bad[k] + 1) / (n - bad[k] + 1)) for k, n in sorted(every.items())}
    return odds, {k: n / len(labelled) for k, n in sorted(every.items())}


def _lookup(odds: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for kv in odds.items() for x in kv]) if odds else F.lit(None).cast("map<string,double>")


FEATURES = ["url_length", "host_length", "depth", "labels", "longest_label", "hyphens", "digit_ratio", "host_digit_ratio", "entropy", "parameters", "tail_length", "suffix_odds", "suffix_share"]
Statistics = tuple[dict[str, float], dict[str, float]]


def features(df: DataFrame, url: str, statistics: Statistics) -> DataFrame:
    """``df`` with the lexical features of its url column; a null url has those of an empty one."""
    host, path, tail = parts_of(F.col(url))
    whole = F.coalesce(F.col(url), F.lit(""))
    df = df.withColumns({"_whole": whole, "_host": host, "_path": path, "_tail": tail})
    h, n = F.col("_host"), F.greatest(F.length("_host"), F.lit(1))
    suffix = F.substring_index(h, ".", -1)

    def count(of: Column, kind: str) -> Column:
        return F.length(F.regexp_replace(of, f"[^{kind}]+", ""))

    entropy = F.lit(0.0)
    for c in _CHARS:
        p = (F.length(h) - F.length(F.replace(h, F.lit(c), F.lit("")))) / n
        entropy = entropy - F.when(p > 0, p * F.log2(p)).otherwise(0.0)
    found = {
        "url_length": F.length("_whole"),
        "host_length": F.length(h),
        "depth": count(F.col("_path"), "/"),
        "labels": count(h, "."),
        "longest_label": F.array_max(F.transform(F.split(h, "[.]"), F.length)),
        "hyphens": F.length(h) - F.length(F.replace(h, F.lit("-"), F.lit(""))),
        "digit_ratio": count(F.col("_whole"), "0-9") / F.greatest(F.length("_whole"), F.lit(1)),
        "host_digit_ratio": count(h, "0-9") / n,
        "entropy": entropy,
        "parameters": count(F.col("_tail"), "="),
        "tail_length": F.length("_tail"),
        "suffix_odds": F.coalesce(F.try_element_at(_lookup(statistics[0]), suffix), F.lit(0.0)),
        "suffix_share": F.coalesce(F.try_element_at(_lookup(statistics[1]), suffix), F.lit(0.0)),
    }
    return df.withColumns({k: v.cast("double") for k, v in found.items()}).drop("_whole", "_host", "_path", "_tail")


_fitted: dict[tuple, tuple[GBTClassificationModel, Statistics]] = {}


def train(spark: SparkSession, labelled: Sequence[tuple[str, int]], trees: int = 12, depth: int = 4) -> tuple[GBTClassificationModel, Statistics]:
    """Fit the trees on labelled urls, which are a bounded list of the caller's.

    The suffix statistics that a url trains with are those of the other half of the list, so
    that they say no more about it than about urls to come; those returned are of all. A
    session keeps the last model, for the next call with the same list.
    """
    key = (spark.sparkContext.applicationId, tuple(labelled), trees, depth)
    if key in _fitted:
        return _fitted[key]
    halves = [[x for i, x in enumerate(labelled) if i // 2 % 2 == k] for k in (0, 1)]
    data = None
    for own, other in (halves, halves[::-1]):
        table = spark.createDataFrame([(u, float(y)) for u, y in own], "url string, label double")
        part = features(table, "url", suffix_statistics(other))
        data = part if data is None else data.unionByName(part)
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(data.coalesce(1)).select("features", "label").cache()
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7).fit(data)
    data.unpersist()
    _fitted.clear()
    _fitted[key] = model, suffix_statistics(labelled)
    return _fitted[key]


def url_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, labelled: Sequence[tuple[str, int]] | None = None) -> DataFrame:
    """``(page_id, host, path, rule, verdict, block_score)`` for each row of ``pages`` (page_id, url).

    The verdict is the longest fitting rule's, else block from a score of 0.5 by the trees.
    ``labelled`` are (url, 1 to block), of both kinds; by default a built-in list. Null urls, and urls without
    ``://``, have an empty host and path, fit no rule and are scored as empty hosts. Null
    page_ids, repeated rows and extra columns are fine; an empty table gives no rows.
    """
    model, statistics = train(pages.sparkSession, labelled_urls() if labelled is None else labelled)
    host, path, _ = parts_of(F.col("url"))
    rows = pages.select("page_id", F.col("url")).withColumns({"host": host, "path": path})
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features(rows, "url", statistics))
    scored = model.transform(data.select("page_id", "host", "path", "features"))
    scored = scored.withColumn("block_score", vector_to_array("probability")[1]).withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", own).alias("verdict"), "block_score")
