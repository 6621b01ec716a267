"""Quality rules, mixing and decontamination."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from marketframe.llm.decontaminate import common_subsequence, contaminated, decontaminate
from marketframe.llm.mixing import Mixture, mix, mixed_documents
from marketframe.llm.quality import CORPUS_RULES, QualityRules, keep_good, score_quality

DOCS = "doc_id long, text string, lang string, source string"
RULES = QualityRules()


def corpus(n=60, seed=4):
    rng = random.Random(seed)
    common = "the of and to in a is that it for".split()
    rare = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(400)]
    rows = []
    for i in range(n):
        ws = [rng.choice(common if rng.random() < 0.4 else rare) for _ in range(rng.randint(20, 160))]
        text = " ".join(ws)
        if i % 9 == 1:
            text = " ".join(w.upper() + "!!" for w in ws)
        if i % 9 == 2:
            text = "\n".join(["same old line", " "] * 40)
        if i % 9 == 3:
            text = text.replace(" ", "\n", 30) + " " + text[:80]
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["hot", "hot", "s1", "s2", None])))
    return rows + [(900, None, "en", "hot"), (901, "", None, None), (902, "é ß — " * 70, "xx", "hot")]


def no_python(plan, df):
    text = plan(df)
    return not any(n in text for n in ("EvalPython", "InPandas", "InArrow", "ArrowEval", "PythonUDF"))


def test_quality_against_the_plain_version(spark, plan):
    rows = corpus()
    scored = score_quality(spark.createDataFrame(rows, DOCS))
    assert no_python(plan, scored)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    found = {r.doc_id: r for r in scored.collect()}
    for doc, text, _, _ in rows:
        assert tuple(found[doc][n] for n in names) == brute.quality_counts(text)
    kept = brute.quality_kept([r[:3] for r in rows], RULES)
    assert {d: r.kept for d, r in found.items()} == kept and len(set(kept.values())) == 2


def test_registered_rules_against_the_plain_version(spark):
    """On whole test tables and on rows with copies, the rules of the query and the first stage."""
    tables = [corpus(80) + corpus(80)[:30] * 3]
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tables.append([tuple(r) for r in documents.select("doc_id", "text", "lang", "source").collect()])
    for rows in tables:
        rows = [(i, *r[1:]) for i, r in enumerate(rows)]
        docs = spark.createDataFrame(rows, DOCS).repartition(3)
        want = brute.quality_kept([r[:3] for r in rows], CORPUS_RULES)
        found = score_quality(docs, CORPUS_RULES, keep=["doc_id"]).collect()
        assert {r.doc_id: r.kept for r in found} == want and len(set(want.values())) == 2
        assert {r.doc_id for r in keep_good(docs).collect()} == {d for d, good in want.items() if good}


def test_a_very_long_text_that_repeats(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(90_000)]
    rows = [(1, " ".join(words * 2), "en", "s"), (2, " ".join(words), "en", "s"), (3, "a b " * 200_000, "en", "s")]
    found = {r.doc_id: r for r in score_quality(spark.createDataFrame(rows, DOCS)).collect()}
    counts = [(found[i].n_words, found[i].n_repeat_words) for i in (1, 2, 3)]
    assert counts == [(180_000, 180_000), (90_000, 0), (400_000, 400_000)]


def test_copies_are_one_text_in_the_references(spark):
    """A third of the rows copies of one text, another third one that fails the base rules."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7)))
    usual, rare = [word() for _ in range(60)], [word() for _ in range(300)]
    texts = [" ".join(rng.choice(usual if rng.random() < 0.7 else rare) for _ in range(200)) for _ in range(40)]
    clean = [(i, text, "es", "s") for i, text in enumerate(texts)]
    odd = " ".join(word() + str(i) for i in range(150))
    copies = [(1000 + i, odd, "es", "s") for i in range(400)]
    failed = [(2000 + i, f"buy{i % 7} now cheap " * 60 + str(i), "es", "s") for i in range(400)]
    other = [(3000 + i, text, "en", "s") for i, text in enumerate(texts * 10)]
    table = lambda rows: spark.createDataFrame(rows, DOCS).repartition(5)
    kept = keep_good(table(clean + copies + failed + other)).filter("doc_id < 1000").collect()
    assert sorted(r.doc_id for r in kept) == list(range(len(clean)))
    columns = ("doc_id", "char_distance", "word_distance", "kept")
    verdicts = lambda rows: sorted(
        score_quality(table(rows), CORPUS_RULES).filter("doc_id < 1000").select(*columns).collect()
    )
    assert verdicts(clean + copies + failed + other) == verdicts(clean + copies[:1])
    only = score_quality(table(failed[:3]), CORPUS_RULES).collect()
    assert [(r.char_distance, r.word_distance, r.kept) for r in only] == [(None, None, False)] * 3


def test_quality_of_odd_tables(spark):
    rows = corpus(10)
    wide = spark.createDataFrame(rows + rows[:2], DOCS).select(
        "*", F.lit(1).alias("Kept"), F.lit(2).alias("n_words"), F.lit(3).alias("cell"), F.lit(4).alias("common_shares")
    )
    good = keep_good(wide)
    assert good.columns == wide.columns and all(r.n_words == 2 for r in good.collect())
    assert score_quality(wide).count() == len(rows) + 2
    empty = spark.createDataFrame([], DOCS)
    assert score_quality(empty).collect() == [] and keep_good(empty).collect() == []


def test_mixing_against_the_plain_version(spark, plan):
    rows = corpus(120)
    for mixture in (Mixture(), Mixture(budget=0.9, powers={"source": 0.0, "lang": 0.3, "topic": 1.0})):
        drawn = mix(spark.createDataFrame(rows, DOCS), mixture)
        assert no_python(plan, drawn)
        want = brute.mixing([(d, t, s, g) for d, t, g, s in rows], mixture)
        for r in drawn.collect():
            rate, kept = want[r.doc_id]
            assert r._m_rate == pytest.approx(rate, rel=1e-6, abs=1e-9) and r._m_kept == kept


def test_mixing_reaches_its_marginals_and_budget(spark):
    drawn = mix(spark.createDataFrame(corpus(300), DOCS), Mixture(budget=0.3, shares={"source": {"hot": 0.25}}))
    drawn = drawn.withColumn("expected", F.col("_m_tokens") * F.col("_m_rate"))
    total, expected = drawn.agg(F.sum("_m_tokens"), F.sum("expected")).first()
    assert expected == pytest.approx(0.3 * total, rel=1e-6)
    hot = drawn.filter("_m_source = 'hot'").agg(F.sum("expected")).first()[0]
    assert hot / expected == pytest.approx(0.25, rel=0.02)


def test_mixing_of_odd_tables(spark):
    rows = corpus(12)
    wide = spark.createDataFrame(rows + rows[:1] + [(None, "x y", "en", "hot")], DOCS).select(
        "*", F.lit(1).alias("weight"), F.lit(2).alias("Rate"), F.lit("t").alias("topic"), F.lit(3).alias("tokens")
    )
    kept = mixed_documents(wide)
    assert kept.columns == wide.columns and 0 < kept.count() < wide.count()
    assert mix(wide).count() == wide.count()
    assert mix(spark.createDataFrame([], DOCS)).collect() == []
    nothing = spark.createDataFrame([(1, None, None, None), (2, "", "en", "a")], DOCS)
    assert [r._m_kept for r in mix(nothing).collect()] == [False, False]


def benchmark(seed=9):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("qrstuvwxyz") for _ in range(rng.randint(3, 8)))
    return [(i, " ".join(rng.choice(["the", "of", word(), word()]) for _ in range(rng.randint(16, 60)))) for i in range(12)]


def test_leaks_and_paraphrases_are_found(spark):
    items, rows = benchmark(), [r[:2] for r in corpus(60)]
    planted = {}
    for i, (item, text) in enumerate(items):
        ws = text.split()
        if i % 3 == 1:  # words left out and put in
            ws = [w for k, w in enumerate(ws) if k % 9] + ["extra"]
        if i % 3 == 2:  # another case, markup around words
            ws = [w.upper() + "%%%" for w in ws]
        host = rows[i * 4][1] or ""
        cut = host.find(" ", len(host) // 2)
        rows[i * 4] = (rows[i * 4][0], f"{host[:cut]} {' '.join(ws)} {host[cut:]}")
        planted[rows[i * 4][0]] = item
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    pairs = {(r.doc_id, r.item_id) for r in found.collect()}
    assert pairs == set(planted.items()) == brute.leaks(rows, items)


def test_hot_items_in_short_passages_are_found(spark):
    """Over 1,000 short documents hold one item, and another item is made of frequent words only."""
    rng, items = random.Random(12), benchmark()
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    frequent = [word() for _ in range(20)]
    items = items[:6] + [(50, " ".join(rng.choice(frequent) for _ in range(24)))]
    plain = lambda n: " ".join(rng.choice([word(), rng.choice(frequent)]) for _ in range(n))
    rows = [(i, f"{plain(10)} {items[0][1]} {plain(10)}") for i in range(1200)]
    rows += [(2000 + i, plain(30)) for i in range(2400)]
    rows += [(5000 + i, f"{plain(10)} {items[-1][1]} {plain(10)}") for i in range(5)]
    rows += [(6000, f"{plain(10)} {items[3][1]}")]
    want = {(i, items[0][0]) for i in range(1200)} | {(5000 + i, 50) for i in range(5)} | {(6000, items[3][0])}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want


def test_decontamination_of_odd_tables(spark):
    items = benchmark()[:3]
    bench = spark.createDataFrame(items + [(90, None), (91, ""), (None, "..."), items[0]], "item_id long, text string")
    rows = [(1, items[0][1]), (1, items[0][1]), (2, None), (3, ""), (None, items[1][1]), (4, "the of " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", F.lit(1).alias("text_key"), F.lit(2).alias("item_id"), F.lit(3).alias("terms")
    )
    left = decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 3, 4]
    found = contaminated(docs, bench).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in found) == [("1", 0)] * 4 + [("None", 1)]
    empty = docs.limit(0)
    assert contaminated(empty, bench).collect() == [] and decontaminate(docs, bench.limit(0)).count() == 6
    assert contaminated(empty, bench.limit(0)).collect() == []


def test_bit_parallel_subsequence():
    rng = random.Random(8)
    for _ in range(300):
        a = [rng.randrange(5) for _ in range(rng.randint(1, 70))]
        b = [rng.randrange(6) for _ in range(rng.randint(0, 90))]
        masks = {}
        for i, t in enumerate(a):
            masks[t] = masks.get(t, 0) | 1 << i
        assert common_subsequence(masks, len(a), b) == brute.subsequence(a, b)
