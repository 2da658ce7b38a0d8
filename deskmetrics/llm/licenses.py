"""License scans: a trained paragraph classifier over word n-grams, with an unknown class and template confirmation.

A paragraph is a line with a word. It is judged in windows of ``WINDOW`` words, one every ``STEP`` words, so that a notice counts the same
in a short line and inside a long one. A window's features are its distinct single words and word pairs, each weighing one over
the root of their number. Words and pairs that stand in no template have no weight of their own; they count in that number.
Two sparse logistic regressions (``spark.ml``, fitted on all documents) judge it:

1. licence or not. The unknown class is calibrated: the least probability that is accepted lies above that of all but
   ``FALSE_SHARE`` of the ordinary windows that the fit did not see (a quarter of all), and is at least ``LEAST``. A paragraph is
   accepted when one of its windows is;
2. which family, for accepted windows only.

*Confirmation*: of the pairs of neighbouring words of one of the family's templates, at least ``CONFIRM`` have to stand in the accepted
window or within ``STEP`` words of it, and no other family may have more there. A paragraph with several notices confirms each of them.

The regressions' weights enter the scan as array constants, so scoring a paragraph is a column expression; documents are never
split over rows and nothing is shuffled.

Training: every distinct window of all documents that shares few word pairs with any template is an ordinary one. Windows with equal
features are one row with a weight, so what the regressions read is the number of different feature sets, not of windows; nothing is
sampled. The templates, whole and in parts, stand against them alone and behind the first words of every ordinary window. All ordinary
windows together weigh as much as ``ORDINARY`` rows (each one at most), those with a part of a template ``INSIDE``, it alone ``ALONE``.

Defined results: null and empty texts have no paragraphs; repeated rows give repeated results; an empty table gives an empty
result; without ordinary paragraphs everything is unknown; other columns are ignored. Texts without a doc_id are learned from, too.
"""

from __future__ import annotations

import itertools
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskmetrics.llm.common import written
from deskmetrics.llm.line_rules import let

ORDINARY = 4_000
INSIDE = 80
ALONE = 10
HEAD = 8
FALSE_SHARE = 0.001
LEAST = 0.5
CONFIRM = 0.4
WINDOW = 16
STEP = 8

#: Short notices of licence families, as their publishers word them.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("bsd", "Released under the BSD License."),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause"),
    ("cc-by", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-nc", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT license."),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mpl-2.0", "SPDX-License-Identifier: MPL-2.0"),
)
FAMILIES = tuple(sorted({f for f, _ in TEMPLATES}))


def words_of(line: Column) -> Column:
    """Lower-case words; marks at their ends are no part of them."""
    return F.array_remove(F.split(F.lower(line), r"[^\p{L}\p{N}+-]+"), "")


def pairs_of(words: Column) -> Column:
    return F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.xxhash64(a, b))


@dataclass
class Lexicon:
    """Numbers of the words and, after them, of the word pairs of all templates. Words are found by their hash in a table without clashes."""

    words: list[int]
    pairs: dict[tuple[int, int], int]
    places: int

    @classmethod
    def of(cls, lines: list[list[int]]) -> Lexicon:
        """Of lines as hashes of their words."""
        words = sorted({h for line in lines for h in line})
        number = {h: i for i, h in enumerate(words)}
        places = next(m for m in itertools.count(4 * len(words)) if len({h % m for h in words}) == len(words))
        pairs = sorted({(number[a], number[b]) for line in lines for a, b in itertools.pairwise(line)})
        return cls(words, {pair: len(words) + i for i, pair in enumerate(pairs)}, places)

    @property
    def size(self) -> int:
        return len(self.words) + len(self.pairs)

    def pairs_in(self, line: list[int]) -> list[int]:
        number = {h: i for i, h in enumerate(self.words)}
        return sorted({self.pairs[number[a], number[b]] for a, b in itertools.pairwise(line)})

    def all_in(self, line: list[int]) -> list[int]:
        number = {h: i for i, h in enumerate(self.words)}
        return sorted({number[h] for h in line}) + self.pairs_in(line)

    def codes_of(self, words: Column) -> Column:
        """The number of each word; other words keep their hash, as a negative number."""
        at = {h % self.places: (h, i) for i, h in enumerate(self.words)}
        known = _constant([at[k][0] if k in at else k + 1 for k in range(self.places)], "array<bigint>")  # k + 1 has another place
        number = _constant([at[k][1] if k in at else -1 for k in range(self.places)], "array<bigint>")
        place = lambda h: F.pmod(h, F.lit(self.places)).cast("int")
        other = lambda h: h.bitwiseOR(F.lit(-(2**63)))
        own = lambda h: F.coalesce(F.get(number, place(h)), F.lit(0))
        return F.transform(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.when(F.get(known, place(h)) == h, own(h)).otherwise(other(h)))

    @property
    def bits(self) -> int:
        return len(self.words).bit_length()

    @property
    def limit(self) -> int:
        """Codes of the lexicon's words, and of pairs of two of them, lie from 0 to below this."""
        return (len(self.words) + 1) << self.bits

    def pair_codes_of(self, codes: Column) -> Column:
        """A code for each pair of neighbouring codes, below ``limit`` for two words of the lexicon; the last code stands for its pair with the line's end.

        The first word's code is moved up by ``bits``: what that drops of another word's hash leaves 57 bits and the whole hash of the second."""
        pair = lambda a, b: F.coalesce(F.shiftleft(a + 1, self.bits).bitwiseXOR(b), a, F.lit(0))
        return F.zip_with(codes, F.slice(codes, 2, F.greatest(F.size(codes), F.lit(1))), pair)

    def numbers_of(self, codes: Column) -> Column:
        """The numbers behind codes below ``limit``, in the same order; pairs that stand in no template have none."""
        pairs = {((a + 1) << self.bits) ^ b: i for (a, b), i in self.pairs.items()}
        number = _constant([c if c < len(self.words) else pairs.get(c, -1) for c in range(self.limit)], "array<int>")
        return F.filter(F.transform(codes, lambda c: F.get(number, c.cast("int"))), lambda i: i >= 0)


def coded(words: Column, lexicon: Lexicon) -> Column:
    """Codes of the words and of the word pairs, one of each a place."""
    return let(lexicon.codes_of(words), lambda one: F.struct(one.alias("one"), lexicon.pair_codes_of(one).alias("two")))


def features_of(codes: Column, at: Column, many: int, lexicon: Lexicon) -> Column:
    """(ids, n) of the ``many`` words from place ``at``: numbers of the lexicon, and how many distinct words and pairs there are in all."""
    both = F.concat(F.slice(codes["one"], at, F.lit(many)), F.slice(codes["two"], at, F.lit(many - 1)))
    known = lambda b: F.filter(b, lambda c: (c >= 0) & (c < lexicon.limit))
    return let(F.array_distinct(both), lambda b: F.struct(lexicon.numbers_of(known(b)).alias("ids"), F.size(b).alias("n")))


def known_features_of(codes: Column, at: Column, many: int, lexicon: Lexicon) -> Column:
    """The same; without a word of the lexicon ``n`` makes no difference and is 0."""
    none = F.struct(F.array().cast("array<int>").alias("ids"), F.lit(0).alias("n"))
    return F.when(F.exists(F.slice(codes["one"], at, F.lit(many)), lambda c: c >= 0), features_of(codes, at, many, lexicon)).otherwise(none)


@dataclass
class Scanner:
    """Weights of both regressions by number of the lexicon, the acceptance line, and the word pairs of each family's templates."""

    lexicon: Lexicon
    weights: list[float]
    bias: float
    least: float
    family_weights: list[list[float]]
    family_bias: list[float]
    pairs: dict[str, list[list[int]]]


def _constant(values: list, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(values)), kind)


def _margin(features: Column, weights: list[float], bias: float) -> Column:
    table = _constant([round(w, 5) for w in weights], "array<double>")
    total = F.aggregate(features["ids"], F.lit(0.0), lambda a, i: a + F.get(table, i))
    return F.lit(float(bias)) + total / F.sqrt(F.greatest(features["n"], F.lit(1)))


def _logistic(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def paragraphs(docs: DataFrame) -> DataFrame:
    return docs.select(F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike(r"\p{L}"))


def starts_of(words: Column) -> Column:
    """Places, from 1, where the windows of ``words`` start; the last ones reach the end."""
    last = F.ceil((F.size(words) - WINDOW) / F.lit(STEP)).cast("int")
    return F.sequence(F.lit(1), F.greatest(last, F.lit(0)) * STEP + 1, F.lit(STEP))


def template_pairs(spark: SparkSession) -> dict[str, list[list[int]]]:
    """The distinct word pairs of each template, by family; the pair with the end is none of them."""
    rows = spark.createDataFrame(list(TEMPLATES), "family string, line string")
    rows = rows.select("family", let(words_of(F.col("line")), inner_pairs).alias("pairs")).collect()
    return {f: [sorted(set(r["pairs"])) for r in rows if r["family"] == f] for f in FAMILIES}


def inner_pairs(words: Column) -> Column:
    return F.slice(pairs_of(words), F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)))


def template_share(pairs: Column, templates: list[list[int]], kind: str = "array<bigint>") -> Column:
    """The largest share of a template's pairs that stand in ``pairs``."""
    return F.greatest(F.lit(0.0), *[F.size(F.array_intersect(pairs, _constant(t, kind))) / F.lit(float(len(t))) for t in templates if t])


@dataclass
class Notices:
    """What the templates consist of: their words and pairs, the numbers of each template's pairs, and those of whole templates and parts."""

    lexicon: Lexicon
    pairs: list[list[int]]
    parts: list[tuple[str, list[int]]]


def notices(spark: SparkSession) -> Notices:
    templates = spark.createDataFrame(list(TEMPLATES), "family string, line string")
    words = F.split("line", " ")
    part = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ((0, 1), (0, 2), (1, 2), (1, 3), (0, 3), (2, 3))]))
    parts = templates.select("family", words.alias("w"), part.alias("p")).select(
        "family", F.col("w"), (F.floor(F.size("w") * F.col("p.a") / F.col("p.b")) + 1).cast("int").alias("start"), F.ceil(F.size("w") / F.col("p.b")).cast("int").alias("many")
    )
    parts = parts.where("many >= 4 OR many = size(w)").select("family", F.array_join(F.slice("w", F.col("start"), F.col("many")), " ").alias("line")).distinct()
    hashes = F.transform(words_of(F.col("line")), lambda w: F.xxhash64(w)).alias("h")
    whole = [r["h"] for r in templates.select(hashes).collect()]
    lexicon = Lexicon.of(whole)
    rows = parts.select("family", "line", hashes).orderBy("family", "line").collect()
    return Notices(lexicon, [lexicon.pairs_in(h) for h in whole], [(r["family"], lexicon.all_in(r["h"])) for r in rows])


def is_ordinary(ids: Column, many: Column, known: Notices) -> Column:
    """Whether a window of ``many`` words shares few of its pairs with the templates, and holds no large part of one."""
    few = lambda pairs: (F.size(pairs) / F.greatest(many - 1, F.lit(1)) < 0.2) & (template_share(pairs, known.pairs, "array<int>") < CONFIRM)
    return let(F.filter(ids, lambda i: i >= len(known.lexicon.words)), lambda pairs: (F.size(pairs) == 0) | few(pairs))


def window_groups(docs: DataFrame, known: Notices) -> DataFrame:
    """(ids, n, head_ids, head_n, seen, k): how many distinct ordinary windows of all documents have these features, as a whole and in their first words.

    A quarter of the windows is not seen by the fit."""

    lexicon = known.lexicon
    bounds = F.array(F.lit(-1).cast("bigint"), F.lit(lexicon.limit).cast("bigint"))
    distinct = lambda *codes: F.sort_array(F.array_distinct(F.concat(*codes, bounds)))
    at = lambda codes, bound: F.array_position(codes, F.get(bounds, F.lit(bound))).cast("int")
    between = lambda codes: F.slice(codes, at(codes, 0) + 1, at(codes, 1) - at(codes, 0) - 1).cast("array<int>")

    # A row per window: all that is done for a window are then plain functions of its row, which Spark compiles; those inside transform() it interprets.
    lines = paragraphs(docs.select("text")).select(lexicon.codes_of(words_of(F.col("line"))).alias("one"))
    lines = lines.select("one", lexicon.pair_codes_of(F.col("one")).alias("two"))
    windows = lines.select("one", "two", F.explode(starts_of(F.col("one"))).alias("at"))
    windows = windows.select(F.slice("one", F.col("at"), F.lit(WINDOW)).alias("one"), F.slice("two", F.col("at"), F.lit(WINDOW - 1)).alias("two"))
    head = distinct(F.slice("one", 1, HEAD), F.slice("two", 1, HEAD - 1))
    windows = windows.select(F.xxhash64("one").alias("h"), F.size("one").alias("many"), distinct(F.col("one"), F.col("two")).alias("f"), head.alias("head"))
    windows = windows.select("h", "many", "f", "head", between(F.col("f")).alias("ids"), between(F.col("head")).alias("head_ids"))
    n = F.when(F.size("ids") > 0, F.size("f") - 2).otherwise(0)  # without a word of the lexicon it makes no difference
    every = windows.select("h", "many", "ids", n.alias("n"), "head_ids", (F.size("head") - 2).alias("head_n")).distinct()
    every = every.withColumn("ids", lexicon.numbers_of(F.col("ids"))).withColumn("head_ids", lexicon.numbers_of(F.col("head_ids")))
    seen = F.pmod(F.xxhash64(F.lit(7), "h"), F.lit(4)) != 0
    k = F.count_if(is_ordinary(F.col("ids"), F.col("many"), known))  # counted and not filtered by: as a filter it would move to where windows still repeat
    return written(every.withColumn("seen", seen).groupBy("ids", "n", "head_ids", "head_n", "seen").agg(k.alias("k")).where("k > 0"), "ordinary")


def training_table(groups: DataFrame, known: Notices, share: float) -> DataFrame:
    """(family, ids, n, weight): family null for ordinary windows, each of which weighs ``share``."""
    plain = groups.where("seen").groupBy("ids", "n").agg((F.sum("k") * share).alias("weight")).withColumn("family", F.lit(None).cast("string"))
    parts = F.explode(_constant([{"family": f, "ids": ids} for f, ids in known.parts], "array<struct<family:string,ids:array<int>>>"))
    alone = groups.sparkSession.range(1).select(parts.alias("part")).select("part.family", "part.ids", F.size("part.ids").alias("n"), F.lit(float(ALONE)).alias("weight"))
    heads = groups.groupBy("head_ids", "head_n").agg((F.sum("k") * (share * INSIDE / ORDINARY)).alias("weight")).withColumn("part", parts)
    ids, common = F.sort_array(F.array_union("head_ids", "part.ids")), F.size(F.array_intersect("head_ids", "part.ids"))
    inside = heads.select("part.family", ids.alias("ids"), (F.col("head_n") + F.size("part.ids") - common).alias("n"), "weight")
    inside = inside.groupBy("family", "ids", "n").agg(F.sum("weight").alias("weight"))
    return plain.unionByName(alone).unionByName(inside)


def acceptance_line(rows: DataFrame, share: float) -> float:
    """The least score, in steps of 2 ** -32, that at most ``share`` of the windows (``k`` in a row) reach, by counts in steps of 2 ** -16."""
    left = int(share * rows.agg(F.sum("k").alias("k")).first()["k"])
    low, width, steps = 0.0, 1.0, 1 << 16
    for _ in range(2):
        width /= steps
        place = F.least(F.floor((F.col("score") - low) / width), F.lit(steps - 1))
        at = None
        for at, k in sorted(rows.groupBy(place).agg(F.sum("k")).collect(), reverse=True):
            if k > left:
                break
            left -= k
        rows, low = rows.where(place == at), low + at * width
    return low + width


def fit(docs: DataFrame, ordinary: int = ORDINARY) -> Scanner | None:
    """The scanner, learned from all documents, or None when they have no ordinary window. ``ordinary`` is what all those windows weigh."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizerModel, Interaction

    spark = docs.sparkSession
    known = notices(spark)
    groups = window_groups(docs, known)
    found = groups.agg(F.sum("k").alias("all"), F.sum(F.when(F.col("seen"), F.col("k"))).alias("seen"), F.sum(F.when(~F.col("seen"), F.col("k"))).alias("unseen")).first()
    if not found["seen"]:
        return None
    rows = training_table(groups, known, ordinary / max(found["all"], ordinary))
    names = rows.withColumn("tokens", F.transform("ids", lambda i: i.cast("string"))).withColumn("each", F.lit(1.0) / F.sqrt(F.greatest(F.col("n"), F.lit(1))))
    names = names.withColumn("licence", F.col("family").isNotNull().cast("double"))
    names = names.withColumn("number", F.coalesce(F.array_position(F.array(*[F.lit(f) for f in FAMILIES]), F.col("family")) - 1, F.lit(0)).cast("double"))
    vectors = CountVectorizerModel.from_vocabulary([str(i) for i in range(known.lexicon.size)], inputCol="tokens", outputCol="counts").transform(names)
    vectors = Interaction(inputCols=["each", "counts"], outputCol="features").transform(vectors)
    vectors = written(vectors.select("licence", "number", "weight", "features"), "vectors")
    how = {"maxIter": 40, "regParam": 1e-4, "standardization": False, "weightCol": "weight"}
    binary = LogisticRegression(labelCol="licence", family="binomial", **how).fit(vectors)
    family = LogisticRegression(labelCol="number", family="multinomial", **how).fit(vectors.where("licence = 1"))
    weights, bias = binary.coefficients.toArray().tolist(), float(binary.intercept)
    unseen = groups.where("NOT seen") if found["unseen"] else groups
    score = _logistic(_margin(F.struct("ids", "n"), weights, bias))
    least = max(LEAST, acceptance_line(unseen.select(score.alias("score"), "k"), FALSE_SHARE))
    matrix = family.coefficientMatrix.toArray()
    return Scanner(known.lexicon, weights, bias, least, [r.tolist() for r in matrix], family.interceptVector.toArray().tolist(), template_pairs(spark))


def scan(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_paragraphs, n_licence (accepted), n_confirmed, families (confirmed, in order, joined by commas),
    score (highest licence probability of a paragraph), found (accepted paragraphs with score, the family and share of their best window,
    confirmed, and all families confirmed in them)."""
    scanner = scanner or fit(docs)
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"\p{L}"))
    if scanner is None:
        nothing = F.lit(None).cast("array<struct<line:string,score:double,family:string,share:double,confirmed:boolean,families:array<string>>>")
        return _summary(own.select("doc_id", F.size(lines).alias("n"), F.lit(0.0).alias("score"), F.coalesce(nothing, F.array()).alias("found")))

    def judge(words: Column) -> Column:
        """Start and score of each window; words and pairs are hashed once for all of them."""
        places = F.struct(coded(words, scanner.lexicon).alias("codes"), starts_of(words).alias("at"))
        score = lambda p, at: _logistic(let(known_features_of(p["codes"], at, WINDOW, scanner.lexicon), lambda f: _margin(f, scanner.weights, scanner.bias)))
        return let(places, lambda p: F.transform(p["at"], lambda at: F.struct(at.alias("at"), score(p, at).alias("score"))))

    top = lambda windows: F.array_max(F.transform(windows, lambda x: x["score"]))
    judged = F.transform(lines, lambda line: let(let(words_of(line), judge), lambda ws: F.struct(line.alias("line"), top(ws).alias("score"), ws.alias("windows"))))

    def family_of(words: Column, hit: Column) -> Column:
        first = F.greatest(hit["at"] - STEP, F.lit(1))
        near = inner_pairs(F.slice(words, first, hit["at"] - first + WINDOW + STEP))

        def of(x: Column) -> Column:
            sides = F.array(
                *[
                    F.struct(
                        _margin(x["features"], scanner.family_weights[i], scanner.family_bias[i]).alias("margin"),
                        F.lit(f).alias("family"),
                        F.get(x["shares"], F.lit(i)).alias("share"),
                    )
                    for i, f in enumerate(FAMILIES)
                ]
            )
            return let(
                F.struct(F.array_max(sides).alias("best"), F.array_max(x["shares"]).alias("most")),
                lambda r: F.struct(
                    ((r["best"]["share"] >= CONFIRM) & (r["best"]["share"] >= r["most"])).alias("confirmed"),
                    r["best"]["share"].alias("share"), hit["score"].alias("score"), r["best"]["family"].alias("family"),
                ),
            )

        features = let(coded(words, scanner.lexicon), lambda codes: features_of(codes, hit["at"], WINDOW, scanner.lexicon))
        shares = let(near, lambda pairs: F.array(*[template_share(pairs, scanner.pairs[f]) for f in FAMILIES]))
        return let(F.struct(features.alias("features"), shares.alias("shares")), of)

    def name(hit: Column) -> Column:
        sides = let(
            words_of(hit["line"]),
            lambda words: F.transform(F.filter(hit["windows"], lambda x: x["score"] >= scanner.least), lambda x: family_of(words, x)),
        )
        sure = lambda xs: F.array_distinct(F.transform(F.filter(xs, lambda x: x["confirmed"]), lambda x: x["family"]))
        return let(
            F.struct(sides.alias("sides")),
            lambda s: let(
                F.array_max(s["sides"]),
                lambda best: F.struct(
                    hit["line"].alias("line"), hit["score"].alias("score"), best["family"].alias("family"), best["share"].alias("share"),
                    best["confirmed"].alias("confirmed"), sure(s["sides"]).alias("families"),
                ),
            ),
        )

    rows = own.select(
        "doc_id",
        let(
            judged,
            lambda js: F.struct(
                F.size(js).alias("n"),
                F.coalesce(F.array_max(F.transform(js, lambda j: j["score"])), F.lit(0.0)).alias("score"),
                F.transform(F.filter(js, lambda j: j["score"] >= scanner.least), name).alias("found"),
            ),
        ).alias("r"),
    )
    return _summary(rows.select("doc_id", "r.*"))


def _summary(rows: DataFrame) -> DataFrame:
    sure = F.filter("found", lambda f: f["confirmed"])
    return rows.select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_paragraphs"),
        F.size("found").cast("bigint").alias("n_licence"),
        F.size(sure).cast("bigint").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.transform(sure, lambda f: f["families"])))), ",").alias("families"),
        "score",
        "found",
    )
