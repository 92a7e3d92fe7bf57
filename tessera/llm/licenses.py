"""Licence scan: a trained paragraph classifier, confirmed by template comparison.

All of it is DataFrame functions.  Lines are paragraphs; their features are the words and
pairs of words that occur in a template.  Per licence family a sparse logistic regression
is fitted by proximal gradient steps on the templates and on a bounded sample of
``NEGATIVES`` corpus lines without a word of ``MARKS`` and not close to a template (the documented bound of the fit).
Half of that sample is kept out and calibrates the unknown class: a family must score above
every line kept out and be more probable than not.  A predicted family is confirmed when
the line has ``CONFIRM`` of the words and pairs of one of its templates.  No line is left out:
those that hold no pair of a template, which cannot be confirmed, are not scored.

The weights are bounded by the templates, so they enter the scan as literals and the scan
itself needs no shuffle: each document is read and judged where it lies.

Null and empty texts have no families and a null score; repeated rows and rows with a null
key are each judged; only the key and the added columns are returned.  An empty corpus
trains on the templates alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents
from tessera.session import stage

NEGATIVES = 1000
STEPS, RATE, L1 = 12, 8.0, 0.0005
CONFIRM = 0.6
MARKS = "licen[cs]e|permission|redistribut"
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version"),
    ("apache", "released under the apache license version"),
    ("gpl", "this work is licensed under the gnu general public license version"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "released under the bsd license"),
    ("cc", "licensed under cc by"),
    ("cc", "licensed under cc by nc"),
    ("cc", "this work is licensed under a creative commons attribution license"),
]
FAMILIES = sorted({f for f, _ in TEMPLATES})


def grams(words: list[str]) -> list[str]:
    """Distinct words and pairs of words, in order."""
    return list(dict.fromkeys([*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]))


TEMPLATE_GRAMS = [(f, grams(t.split())) for f, t in TEMPLATES]
FEATURES = sorted({g for _, listed in TEMPLATE_GRAMS for g in listed})


def _pairs_pattern() -> str:
    """Pattern of the lines that hold a pair of words of a template.

    No template has as many words as ``CONFIRM`` of its words and pairs, so a line without a pair is never confirmed.
    """
    followers: dict[str, set[str]] = {}
    for _, listed in TEMPLATE_GRAMS:
        pairs = [g for g in listed if " " in g]
        if len(listed) - len(pairs) >= CONFIRM * len(listed):
            raise ValueError(f"the words alone would confirm a line: {listed}")
        for pair in pairs:
            followers.setdefault(pair.split()[0], set()).add(pair.split()[1])
    return "(?<![a-z])(?:" + "|".join(f"{a}[^a-z]+(?:{'|'.join(sorted(b))})" for a, b in sorted(followers.items())) + ")(?![a-z])"


PAIRS = _pairs_pattern()


def _texts(listed: list[str]) -> Column:
    return F.array(*map(F.lit, listed))


def line_features(line: Column) -> Column:
    """The template words and pairs of words that the line holds."""
    words = F.filter(F.split(F.lower(line), "[^a-z]+"), lambda w: w != "")
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_intersect(F.concat(words, F.filter(pairs, lambda p: p.isNotNull())), _texts(FEATURES))


def _score(features: Column, weights: dict[str, float]) -> Column:
    """Bias (the weight of "") and the features' weights, scaled by the root of their number."""
    held = {g: w for g, w in weights.items() if g and w}
    bias = F.lit(weights[""])
    if not held:
        return bias
    table = F.map_from_arrays(_texts(list(held)), F.array(*map(F.lit, held.values())))
    total = F.aggregate(features, F.lit(0.0), lambda s, g: s + F.coalesce(table[g], F.lit(0.0)))
    return bias + total / F.sqrt(F.greatest(F.size(features), F.lit(1)))


def _close(features: Column, family: str | None = None) -> Column:
    """True where the line has ``CONFIRM`` of the words and pairs of a template (of the family)."""
    held = F.lit(False)
    for k, listed in TEMPLATE_GRAMS:
        if family in (None, k):
            held = held | (F.size(F.array_intersect(features, _texts(listed))) >= CONFIRM * len(listed))
    return held


def _negatives(docs: DataFrame, text: str) -> DataFrame:
    """(features, held): at most NEGATIVES distinct lines without a marked word and not close to a template, chosen by their hash.

    Only lines below a share of the hash range, set from the number of all lines, are
    compared, and equal lines meet before the shuffle.
    """
    total = docs.agg(F.sum(F.size(F.split(F.col(text), "\n")))).first()[0] or 0
    share = min(1.0, 8 * NEGATIVES / max(1, total))
    lines = docs.select(F.explode(F.split(F.col(text), "\n")).alias("line")).select("line", F.xxhash64("line").alias("h"))
    lines = lines.where((F.pmod("h", F.lit(1 << 30)) <= int(share * (1 << 30))) & F.lower("line").rlike("[a-z]") & ~F.lower("line").rlike(MARKS))
    lines = lines.where(~(F.lower("line").rlike(PAIRS) & _close(line_features(F.col("line")))))  # a line to be judged is no example of the rest
    chosen = lines.distinct().orderBy("h", "line").limit(NEGATIVES)
    return chosen.select(line_features(F.col("line")).alias("x"), (F.pmod(F.xxhash64("h"), F.lit(2)) == 0).alias("held"))


def train(docs: DataFrame, text: str = "text") -> tuple[dict[str, dict[str, float]], dict[str, float]]:
    """Per family the weights of its features, "" being the bias, and its least score."""
    spark = docs.sparkSession
    rows = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("line")) for f, t in TEMPLATES])
    templates = spark.range(1).select(F.inline(rows)).select("family", line_features(F.col("line")).alias("x"), F.lit(False).alias("held"))
    both = templates.unionByName(_negatives(docs, text).select(F.lit("").alias("family"), "x", "held"))
    both = stage(both.coalesce(1), "license-examples")  # the templates and at most NEGATIVES rows
    number = {r["family"]: r["n"] for r in both.where("not held").groupBy("family").agg(F.count("*").alias("n")).collect()}
    weights = {k: {"": 0.0} for k in FAMILIES}
    for _ in range(STEPS):
        errors = []
        for k in FAMILIES:
            truth = (F.col("family") == k).cast("double")
            others = sum(number[f] for f in FAMILIES if f != k)
            share = F.when(F.col("family") == k, 1.0 / number[k]).when(F.col("family") != "", 1.0 / others).otherwise(1.0 / max(1, number.get("", 0)))
            e = (truth - 1 / (1 + F.exp(-_score(F.col("x"), weights[k])))) * share
            errors.append(F.struct(F.lit(k).alias("k"), e.alias("e"), F.lit("").alias("g")))
        wide = both.where("not held").select("x", F.inline(F.array(*errors)))
        value = F.when(F.col("g") == "", 1.0).otherwise(1 / F.sqrt(F.size("x")))
        each = wide.select("k", "e", "x", F.explode(F.concat(F.array(F.lit("")), "x")).alias("g"))
        for r in each.groupBy("k", "g").agg(F.sum(F.col("e") * value).alias("d")).collect():  # bounded by the templates
            own = weights[r["k"]]
            w = own.get(r["g"], 0.0) + RATE * r["d"]
            own[r["g"]] = w if not r["g"] else max(0.0, abs(w) - L1 * RATE) * (1 if w > 0 else -1)
    top = both.where("held").agg(*[F.max(_score(F.col("x"), weights[k])).alias(k) for k in FAMILIES]).collect()[0]
    return weights, {k: max(0.0, top[k] if top[k] is not None else 0.0) for k in FAMILIES}


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, families sorted, n_license_lines, license_score), one row per document."""
    weights, least = train(docs, text)

    def judged(features: Column) -> Column:
        """The confirmed families of a line with their scores."""
        found = []
        for k in FAMILIES:
            score = _score(features, weights[k])
            found.append(F.when(_close(features, k) & (score > least[k]), F.struct(score.alias("s"), F.lit(k).alias("k"))))
        return F.array_max(F.array(*found))

    able = F.filter(F.split(F.col(text), "\n"), lambda line: F.lower(line).rlike(PAIRS))
    lines = F.filter(F.transform(F.transform(able, line_features), judged), lambda b: b.isNotNull())
    return docs.select(F.col(key), F.coalesce(lines, F.array().cast("array<struct<s:double,k:string>>")).alias("_b")).select(
        F.col(key),
        F.array_sort(F.array_distinct(F.col("_b.k"))).alias("families"),
        F.size("_b").cast("long").alias("n_license_lines"),
        (1 / (1 + F.exp(-F.array_max(F.col("_b.s"))))).alias("license_score"),
    )


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir).select("doc_id", "text"))
