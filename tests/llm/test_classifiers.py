"""Quality trees, language models, line rules and licence scans."""

from collections import Counter
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from compare import canon, duck
from conftest import SF_CHECK, SF_SMALL
from edge_tables import corpus, edge_docs, no_docs  # noqa: F401
from deskmetrics.llm import langid, licenses, line_rules, quality, trees
from deskmetrics.llm.common import text_parts


def test_trees_separate_and_match_a_walk_by_hand():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] < -0.4)).astype(float)
    model = trees.fit(x[:1500], y[:1500])
    assert ((model.score(x[1500:]) > 0.5) == y[1500:]).mean() > 0.97
    for row, margin in zip(x[:20], model.margin(x[:20]), strict=True):
        total = model.base
        for feature, threshold, value in zip(model.feature, model.threshold, model.value, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += value[node - len(feature)]
        assert abs(total - margin) < 1e-9


def test_trees_without_rows_or_with_one_class():
    none = trees.fit(np.zeros((0, 4)), np.zeros(0))
    assert none.score(np.ones((2, 4))).tolist() == [0.5, 0.5]
    one = trees.fit(np.ones((5, 4)), np.ones(5))
    assert (one.score(np.ones((2, 4))) > 0.9).all()


def test_statistics_against_plain_python():
    texts = ["", "a b a a.\nx y\nx y\n", "\n\n", "é", "The The", "One, two! three | four.\n\nOne", None]
    got = quality.document_statistics(*text_parts(pa.array(texts)))
    names = quality.STATISTICS
    for row, text in zip(got, texts, strict=True):
        text = text or ""
        words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
        s = dict(zip(names, row, strict=True))
        assert round(np.expm1(s["log_words"])) == len(words)
        assert s["twin_words"] * max(len(words), 1) == sum(a == b for a, b in zip(words, words[1:], strict=False))
        assert np.isclose(s["distinct_words"], len(set(words)) / np.sqrt(max(len(words), 1)))
        assert np.isclose(s["repeated_lines"], (len(lines) - len(set(lines))) / max(len(lines), 1))
        assert np.isclose(s["top_line_words"], max([len(x.split()) for x in lines], default=0) / max(len(words), 1))
        assert np.isclose(s["exclamations"] * max(len(words), 1), sum(c in "!?" for c in text))


def test_quality_on_the_held_out_fold(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels)
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.95
    assert got.count() == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.collect())


def test_quality_edge_cases(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(3, 1), (4, 0), (8, 0), (8, 0), (9, 1), (9, None), (None, 1), (4, 7)], "doc_id bigint, quality int")
    rows = quality.classify(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["score"] == 0.5 for r in quality.classify(edge_docs, labels.limit(0)).collect())
    assert quality.classify(no_docs, labels).count() == 0
    kept = quality.keep_good(edge_docs, labels)
    assert kept.columns == edge_docs.columns and kept.exceptAll(edge_docs).count() == 0


def test_labels_do_not_reach_the_held_out_fold(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    sample = quality.training_sample(docs, labels, "quality", 1000)
    assert sample.where(quality.fold("doc_id") == quality.HELD_OUT).isEmpty()
    assert quality.training_sample(docs, labels, "quality", 5).select("doc_id").distinct().count() == 5


def test_language_on_the_held_out_fold(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    got = langid.identify(docs)
    rows = got.join(docs, "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) >= 0.97
    assert got.where("accepted").count() >= 0.99 * docs.count()


def test_language_probabilities_sum_to_one():
    words = [("a", w, n) for w, n in (("banana", 3), ("ban", 2), ("nab", 1))] + [("b", "abba", 2)]
    model = langid.kneser_ney(words)
    # After "b" every next symbol of the vocabulary: the probabilities of the known ones leave only the unseen mass.
    total, _ = model.words(["b" + c for c in "abn"])
    assert model.langs == ["a", "b"] and (np.exp(total).sum(0) < 1).all()
    known, _ = model.words(["banana"])
    other, _ = model.words(["abba"])
    assert known[0, 0] > known[0, 1] and other[0, 1] > other[0, 0]


def test_language_scores_do_not_depend_on_the_company(spark):
    model = langid.kneser_ney([("a", "banana", 3), ("b", "abba", 2)])
    alone = [model.words([w])[0][0] for w in ("banana", "zzz", "ab")]
    together = model.words(["banana", "zzz", "ab"])[0]
    assert np.allclose(alone, together)


def test_language_edge_cases(spark, edge_docs, no_docs):
    rows = langid.identify(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    texts = {r["doc_id"]: r["text"] for r in edge_docs.collect() if r["doc_id"] is not None}
    for r in rows:
        if r["doc_id"] is None:
            continue
        letters = any(c.isalpha() for c in texts[r["doc_id"]] or "")
        assert (r["lang_pred"] != "und") == letters and 0 <= r["score"] <= 1
    assert langid.identify(no_docs).count() == 0
    nothing = langid.identify(edge_docs.withColumn("lang", edge_docs["lang"].substr(9, 9)).where("lang IS NULL"))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}
    kept = langid.keep_known(edge_docs)
    assert kept.columns == edge_docs.columns and kept.where("text IS NULL").isEmpty()


def test_gibberish_is_rejected(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = spark.createDataFrame([(1, "qzxj wvkq xxqz zzqj kkxw " * 30), (2, "Ωмега дубль " * 30)], "doc_id bigint, text string")
    assert not any(r["accepted"] for r in langid.identify(odd, langid.fit(docs)).collect())


def test_line_rules_match_sql(spark):
    for folder in (SF_SMALL, SF_CHECK):
        got = line_rules.verdicts(spark.read.parquet(f"{folder}/documents.parquet")).toPandas()
        assert canon(got) == canon(duck(folder).execute(line_rules.VERDICTS_SQL).df())


def plain_counts(text):
    import re

    words = re.findall(r"[^ \t-\r]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^ \t-\r]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_line_rules_edge_cases(spark, edge_docs, no_docs):
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(list("abc"), n)) for n in (0, 1, 2, 3, 4, 9, 60, 300)] + ["a b c\n" * 30, "l1\nl2\n\nl1\n l1"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for frame in (docs, edge_docs.where("doc_id IS NOT NULL AND doc_id <> 9")):
        own = {r["doc_id"]: r["text"] for r in frame.collect()}
        for r in line_rules.verdicts(frame).collect():
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain_counts(own[r["doc_id"]])
            assert r["base_failed"] == (r["n_words"] < 50 or r["n_repeat_words"] * 2 > r["n_words"]) and not (r["base_failed"] and r["kept"])
    assert line_rules.verdicts(no_docs).count() == 0


def test_two_hash_layouts_agree_with_one(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = canon(line_rules.verdicts(docs).toPandas())
    monkeypatch.setattr(line_rules, "ONE_LAYOUT", 3)
    assert canon(line_rules.verdicts(docs).toPandas()) == want


def test_bad_lines_go_and_good_ones_stay(spark):
    good = "This is a plain sentence with some words in it."
    bad = ["SHOUT!! LOUD!! MORE!! WORDS!! HERE!!", "a# b$ c* d& e%", "Home | News | About | Contact", "Login", "Read our privacy policy.", "go go go go go go go go go go"]
    row = line_rules.clean_lines(spark.createDataFrame([(1, "\n".join([good, *bad, good]))], "doc_id bigint, text string")).first()
    assert row["cleaned"] == good


@pytest.mark.parametrize("name", ["op6_line_rules", "op8_license_paragraphs"])
def test_native_queries_run_no_python(spark, name):
    from deskmetrics.llm.queries import QUERIES

    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "MapPartitions"))


def test_licences_of_the_corpus(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    marks = {"apache-2.0": "Licensed under the Apache License", "cc-by-nc": "CC BY-NC 4.0", "gpl": "GNU General Public License", "mit": "under the MIT License"}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = {i: ",".join(sorted(f for f, m in marks.items() if m in t)) for i, t in texts.items()}
    got = {r["doc_id"]: r["families"] for r in licenses.scan(docs).collect()}
    assert sum(got[i] == w for i, w in want.items()) >= 0.995 * len(want)
    assert all(got[i] == w for i, w in want.items() if w)


def test_licence_edge_cases(spark, edge_docs, no_docs, corpus):
    assert licenses.scan(no_docs).count() == 0
    rows = licenses.scan(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    scanner = licenses.fit(corpus[0])
    rows = {r["doc_id"]: r for r in licenses.scan(edge_docs.where("doc_id IS NOT NULL"), scanner).collect()}
    assert rows[0]["n_paragraphs"] == rows[1]["n_paragraphs"] == 0 and rows[0]["families"] == "" and rows[0]["score"] == 0
    unseen = spark.createDataFrame(
        [(1, "Permission is hereby granted, free of charge, to anyone obtaining a copy of this software"), (2, "Mit."), (3, "We went home and had dinner.")], "doc_id bigint, text string"
    )
    got = {r["doc_id"]: r["families"] for r in licenses.scan(unseen, scanner).collect()}
    assert got == {1: "mit", 2: "", 3: ""}


def test_language_counts_hold_every_distinct_text(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {(r["lang"], r["text"]) for r in langid.learnable(docs).collect()}
    want = {}
    for lang, text in rows:
        doc, code, runs = langid.letter_runs(*text_parts(pa.array([text])))
        for run, n in zip(runs.to_pylist(), np.bincount(code, minlength=len(runs)), strict=True):
            if word := langid.words_of(run):
                want[lang, word] = want.get((lang, word), 0) + n
    got = langid.word_table(docs.union(docs).union(docs.limit(50))).groupBy("lang", "word").sum("n").collect()
    assert {(r[0], r[1]): r[2] for r in got} == want


def test_language_learns_from_more_than_a_sample(spark):
    # 700 texts of a language, each with a word of its own; and one text that holds nine tenths of the rows.
    own = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(700)]
    rows = [(i, f"common words and {w}", "en") for i, w in enumerate(own)] + [(1000 + i, "one text again", "en") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    words = {r["word"]: r["n"] for r in langid.word_table(docs).groupBy("word").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    learned = {r["doc_id"] for r in langid.learnable(docs).collect()}
    assert {w for i, w in enumerate(own) if i in learned} <= set(words) and words["again"] == 1


def test_language_model_from_spark_is_the_plain_one(spark):
    words = [("a", "banana", 3), ("a", "ban  nab", 2), ("a", "b", 4), ("b", "abba", 2), ("b", "éa", 1), ("c", "日本", 1)]
    frame = spark.createDataFrame(words, "lang string, word string, n bigint")
    grams = {}
    for r in langid.gram_table(frame).collect():
        assert (r["lang"], r["gram"]) not in grams
        grams[r["lang"], r["gram"]] = r["n"]
    assert grams["a", "\x01ban"] == 5 and grams["a", "anana"] == 3 and grams["a", "an"] == 2 and grams["b", "a\x02"] == 2
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = langid.fit(docs)
    counted = langid.word_table(docs).where("not calibration").collect()
    want = langid.kneser_ney([(r["lang"], r["word"], r["n"]) for r in counted])
    assert got.langs == want.langs and got.unseen == want.unseen
    for name in ("grams", "logp", "contexts", "weight"):
        for a, b in zip(getattr(got, name), getattr(want, name), strict=True):
            assert a.shape == b.shape and np.allclose(a.astype(float), b.astype(float), rtol=1e-5)


def test_language_model_too_large_to_broadcast(spark, monkeypatch, edge_docs):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").unionByName(edge_docs.drop("score"), allowMissingColumns=True)
    small = langid.fit(docs)
    monkeypatch.setattr(langid, "MODEL_BYTES", 0)
    monkeypatch.setattr(langid, "BLOCK_WORDS", 500)
    large = langid.fit(docs)
    assert isinstance(large, langid.Spread) and np.allclose(large.mean, small.mean) and np.allclose(large.deviation, small.deviation)
    rows = lambda model: sorted((r["doc_id"] is None, r["doc_id"] or 0, r["lang_pred"], r["accepted"], round(r["score"], 6)) for r in langid.identify(docs, model).collect())
    assert rows(large) == rows(small)
    kept = langid.keep_known(docs, large)
    assert kept.columns == docs.columns and canon(kept.toPandas()) == canon(langid.keep_known(docs, small).toPandas())


def test_letters_beside_digits_are_words():
    doc, code, runs = langid.letter_runs(*text_parts(pa.array(["ab12 cd"])))
    assert [runs[i].as_py() for i in code] == [b"ab", b"cd"]


def test_licences_inside_long_lines(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    marks = ("licen", "CC BY", "SPDX", "General Public")
    prose = " ".join(t.replace("\n", " ") for r in docs.where("lang = 'en'").orderBy("doc_id").limit(60).collect() if not any(m in (t := r["text"]) for m in marks)).split()
    notices = {f: t for f, t in reversed(licenses.TEMPLATES)}  # the first of each family
    notices |= {"mit": "Released under the MIT License.", "cc-by-nc": "Licensed under CC BY-NC 4.0."}
    rows, want = [], {}
    for k, (family, notice) in enumerate(sorted(notices.items())):
        for many in (5, 12, 40, 700):
            own = prose[k * 50 : k * 50 + 2 * many]
            rows.append((len(rows), " ".join([*own[:many], notice, *own[many:]])))
            want[rows[-1][0]] = family
    rows.append((1000, " ".join([*prose[:100], notices["mit"], *prose[100:200], notices["gpl"], *prose[200:300]])))
    rows.append((1001, " ".join(prose[:2000])))
    got = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), licenses.fit(docs)).collect()
    assert {r["doc_id"]: r["families"] for r in got} == want | {1000: "gpl,mit", 1001: ""}
    assert all(r["n_confirmed"] == (r["doc_id"] != 1001) for r in got)


def test_licences_learn_from_every_ordinary_window(spark):
    # 2 000 paragraphs of one window each, and their copies; one in 50 sounds like a notice. Seen or not, such windows are ordinary.
    def word(i):
        return "".join(chr(97 + i // 26**k % 26) for k in range(4)) + "q"

    def text(i):
        if i % 50 == 7:
            return f"{word(i)} license of {word(i + 1)} source {word(i + 2)} under code {word(i + 3)} software {word(i + 4)} granted version public {word(i + 5)} terms"
        return " ".join(word(16 * i + k) for k in range(16))

    rows = [(i, text(i % 2000)) for i in range(2200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = licenses.notices(spark)
    groups = licenses.window_groups(docs, known).collect()
    assert sum(r["k"] for r in groups) == 2000
    assert sum(r["k"] for r in groups if r["ids"]) >= 40
    scanner = licenses.fit(docs, ordinary=50)
    accepted = {r["doc_id"] for r in licenses.scan(docs, scanner).where("n_licence > 0").collect() if r["doc_id"] < 2000}
    assert len(accepted) <= 2000 * licenses.FALSE_SHARE
    notice = spark.createDataFrame([(1, "Released under the MIT License.")], "doc_id bigint, text string")
    assert licenses.scan(notice, scanner).first()["families"] == "mit"


def templates(spark):
    return spark.createDataFrame([(t,) for _, t in licenses.TEMPLATES], "line string")


def test_licence_windows_and_weights_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    known = licenses.notices(spark)
    words = licenses.words_of(F.col("line"))
    number = {r["w"]: known.lexicon.words.index(r["h"]) for r in templates(spark).select(F.explode(words).alias("w")).select("w", F.xxhash64("w").alias("h")).collect()}
    number |= {(a, b): known.lexicon.pairs[number[a], number[b]] for r in templates(spark).select(words.alias("w")).collect() for a, b in pairwise(r["w"])}
    want = {}
    for (line,) in licenses.paragraphs(docs).select(words).distinct().collect():
        for at in range(0, max(-(-(len(line) - 16) // 8), 0) * 8 + 1, 8):
            own = line[at : at + 16]
            features = {*own, *pairwise(own)}
            ids = sorted({number[f] for f in features if f in number})
            hits = {number[f] for f in features if f in number and isinstance(f, tuple)}
            if len(hits) < 0.2 * max(len(own) - 1, 1) and all(len(hits & set(t)) < licenses.CONFIRM * len(t) for t in known.pairs if t):
                want[tuple(own)] = (tuple(ids), len(features) if ids else 0)
    got = {}
    groups = licenses.window_groups(docs.union(docs), known)
    for r in groups.collect():
        key = tuple(r["ids"]), r["n"]
        got[key] = got.get(key, 0) + r["k"]
    assert got == dict(Counter(want.values()))
    rows = licenses.training_table(groups, known, 0.5).groupBy("family").agg(F.sum("weight")).collect()
    weight = {r[0]: r[1] for r in rows}
    seen, parts = groups.where("seen").agg(F.sum("k")).first()[0], Counter(f for f, _ in known.parts)
    assert np.isclose(weight.pop(None), seen / 2)
    each = licenses.ALONE + licenses.INSIDE * 0.5 * len(want) / licenses.ORDINARY
    assert all(np.isclose(weight[f], parts[f] * each) for f in licenses.FAMILIES)


def test_licence_features_of_odd_lines(spark):
    # Words of the templates beside each other in pairs that no template has, repeated words, one word, none of the lexicon, windows that overlap.
    lines = ["Mit.", "the the the", "License the version zzz license the", "under Apache License, Version License Version", "q w e r t y", "ß É の 42 of", " ".join(["zz", "of", "the"] * 9)]
    known = licenses.notices(spark)
    words = licenses.words_of(F.col("line"))
    number = {r["w"]: known.lexicon.words.index(r["h"]) for r in templates(spark).select(F.explode(words).alias("w")).select("w", F.xxhash64("w").alias("h")).collect()}
    number |= {(a, b): known.lexicon.pairs[number[a], number[b]] for r in templates(spark).select(words.alias("w")).collect() for a, b in pairwise(r["w"])}
    rows = spark.createDataFrame([(line,) for line in lines], "line string")
    for (own,) in rows.select(words).collect():
        for many in (licenses.HEAD, licenses.WINDOW):
            part = own[:many]
            codes = licenses.coded(F.array(*[F.lit(w) for w in own]), known.lexicon)
            got = rows.limit(1).select(licenses.features_of(codes, F.lit(1), many, known.lexicon).alias("f")).first()["f"]
            want = {*part, *pairwise(part)}
            assert sorted(got["ids"]) == sorted(number[f] for f in want if f in number) and got["n"] == len(want)
    docs = rows.withColumnRenamed("line", "text")
    want = {}
    for (own,) in rows.select(words).collect():
        for at in range(0, max(-(-(len(own) - 16) // 8), 0) * 8 + 1, 8):
            parts = [{*p, *pairwise(p)} for p in (own[at : at + 16], own[at : at + 8])]
            ids, head = ([number[f] for f in p if f in number] for p in parts)
            if sum(i >= len(known.lexicon.words) for i in ids) < 0.2 * max(len(own[at : at + 16]) - 1, 1):
                want[tuple(own[at : at + 16])] = tuple(sorted(ids)), len(parts[0]) if ids else 0, tuple(sorted(head)), len(parts[1])
    got = Counter()
    for r in licenses.window_groups(docs.union(docs), known).collect():
        got[tuple(r["ids"]), r["n"], tuple(r["head_ids"]), r["head_n"]] += r["k"]
    assert got == Counter(want.values())


def test_licence_windows_are_compiled(spark, monkeypatch):
    # what is done for every window stands in no lambda, which Spark interprets, and nothing is judged before equal windows have met.
    monkeypatch.setattr(licenses, "written", lambda df, name: df)
    docs = spark.createDataFrame([(1, "We went home and had dinner.")], "doc_id bigint, text string")
    plan = licenses.window_groups(docs, licenses.notices(spark))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert any("array_distinct(" in line for line in plan)
    assert not any("lambdafunction(" in line for line in plan if "array_distinct(" in line or "Filter " in line)


def test_acceptance_line_of_licences(spark):
    scores = np.random.default_rng(3).beta(1, 8, 5000)
    rows = spark.createDataFrame([(float(s), 3) for s in scores], "score double, k bigint")
    for share in (0.0, 0.001, 0.1):
        line = licenses.acceptance_line(rows, share)
        top = np.sort(scores)[::-1]
        many = int(share * 15_000) // 3
        assert (scores >= line).sum() == many and 0 < line - top[many] <= 2**-32
