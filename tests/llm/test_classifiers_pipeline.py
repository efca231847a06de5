"""Both classifiers on held-out rows and edge cases, and the pipeline stage by stage."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from blotter.llm import quality_rules as Q
from blotter.llm import toxicity as T
from blotter.llm.packing import pack_documents
from blotter.llm.queries import op5_compression_toxicity, op8_rule_ensemble
from blotter.llm.simhash import simhash_groups
from conftest import SF_MID

SF_LARGE = "/root/testdata/sf0.1"



def held_out(spark, df, label):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    rows = df.join(labels, "doc_id").filter("held_out").select("score", "predicted", F.col(label).alias("y")).collect()
    good = [r.score for r in rows if r.y == 1]
    bad = [r.score for r in rows if r.y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    return auc, rows


def test_quality_held_out(spark):
    auc, rows = held_out(spark, op8_rule_ensemble(spark, SF_MID), "quality")
    assert auc > 0.97
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted for r in rows if r.y == 1]) > 0.97  # clean documents stay


def test_toxicity_held_out(spark):
    df = op5_compression_toxicity(spark, SF_MID)
    auc, rows = held_out(spark, df, "toxic")
    assert auc > 0.6  # 41 toxic training rows; the README has the figures at larger sizes
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    assert df.count() == 1000


def toxic_corpus(spark, n=900):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(30, 120))]
        if i % 5 == 0:
            for _ in range(6):
                text.insert(rng.randrange(len(text)), rng.choice(["nincompoop", "scoundrel", "blackguard"]))
        rows.append((i, " ".join(text), int(i % 5 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_learns_planted_words_and_ignores_other_rows_labels(spark):
    df = toxic_corpus(spark)
    train = F.pmod(F.col("doc_id"), F.lit(3)) != 0
    scores = {r.doc_id: r.score for r in T.score_toxicity(df, df, train=train).collect()}
    test = [(i, int(i % 5 == 0)) for i in range(0, 900, 3)]
    assert np.mean([(scores[i] >= 0.5) == y for i, y in test]) > 0.95
    flipped = df.withColumn("toxic", F.when(train, F.col("toxic")).otherwise(1 - F.col("toxic")))
    again = {r.doc_id: r.score for r in T.score_toxicity(df, flipped, train=train).collect()}
    assert again == scores


def test_toxicity_learns_passages_late_in_long_texts(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    rows = []
    for i in range(240):
        text = [rng.choice(words) for _ in range(1300)]  # over 6,000 characters before the passage
        if i % 4 == 0:
            text += [w for _ in range(6) for w in (rng.choice(["nincompoop", "scoundrel", "blackguard"]), rng.choice(words))]
        rows.append((i, " ".join(text), int(i % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scores = {r.doc_id: r.score for r in T.score_toxicity(df, df, train=F.pmod(F.floor(F.col("doc_id") / 4), F.lit(3)) != 0).collect()}
    held = [(scores[i], y) for i, _, y in rows if i // 4 % 3 == 0]
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.95


def test_toxicity_scores_read_from_the_model_by_hand(spark):
    """Windows found by plain search, compressed one by one with new compressors, features and fit spelled out."""
    import math
    import zstandard as z
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randrange(2, 9))) for _ in range(200)]
    rows = [(i, " ".join(rng.choice(words) if i % 3 or rng.random() < 0.9 else "scoundrel" for _ in range(80)), int(i % 3 == 0)) for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    some, share = T.labelled_sample(df, df, "toxic", F.lit(True), T.Sample(), "doc_id")
    model = T.train_model(some, share, T.Settings())
    assert any("scound" in run for run in model.typical)
    for _, text, _ in rows[:30] + [(0, "", 0), (0, "Scoundrel!", 1)]:
        t = f" {T.normal(text)} "
        savings = []
        for a in range(0, len(t), model.settings.window):
            held = any(t[i:i + len(run)] == run and i < a + model.settings.window and i + len(run) > a
                       for run in model.typical for i in range(max(0, a - len(run)), min(len(t), a + model.settings.window)))
            sizes = []
            for content in (model.ordinary, model.both):
                d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=model.settings.level)
                c = z.ZstdCompressor(level=model.settings.level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
                sizes.append(len(c.compress(t[a:a + model.settings.window].encode())))
            savings.append(sizes[0] - sizes[1] if held else 0)
        n = len(savings)
        over = [sum(s >= limit for s in savings) for limit in model.thresholds]
        x = [sum(savings) / n, max(savings), math.log1p(n), *[k / n for k in over], *[math.log1p(k) for k in over]]
        total = model.weights[0] + sum(w * (v - m) / d for w, v, m, d in zip(model.weights[1:], x, model.mean, model.scale))
        assert model.score(text) == pytest.approx(1 / (1 + math.exp(-total)), rel=1e-9)


def test_quality_scores_read_from_the_rules_by_hand(spark):
    rng = random.Random(4)
    rows = [(i, ("word " * rng.randrange(3, 30)).strip() + ("!!! $$$ ### " * 5 if i % 2 else " and some more of it."), i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, y int")
    table = Q._class_table()
    by_hand = {i: {name: float(v) for name, v in zip(Q.STATISTICS, Q.statistics(t, table))} for i, t, _ in rows}
    stats = spark.createDataFrame([(float(y), *[by_hand[i][s] for s in Q.STATISTICS]) for i, _, y in rows], ["y", *Q.STATISTICS])
    ensemble = Q.fit_ensemble(stats)
    assert ensemble.weights
    scored = Q.text_statistics(df).select("doc_id", ensemble.score().alias("score")).collect()
    for r in scored:
        s = by_hand[r.doc_id]
        held = [w for rule, w in ensemble.weights if all((s[c.statistic] > c.threshold) == c.above for c in rule)]
        assert r.score == pytest.approx(1 / (1 + np.exp(-(ensemble.intercept + sum(held)))), rel=1e-9)


def test_toxicity_is_found_in_every_language(spark):
    scores = {r.doc_id: r for r in op5_compression_toxicity(spark, SF_LARGE).collect()}
    rows = spark.read.parquet(f"{SF_LARGE}/labels.parquet").join(spark.read.parquet(f"{SF_LARGE}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = {}
    for r in rows.filter("toxic is not null").collect():
        if scores[r.doc_id].held_out:
            right.setdefault((r.lang, r.toxic), []).append(scores[r.doc_id].predicted == r.toxic)
    assert len(right) == 8  # four languages, both classes
    for (lang, toxic), hits in right.items():
        assert np.mean(hits) >= (0.8 if toxic else 0.98), (lang, toxic, sum(hits), len(hits))


def test_repeated_ids_give_the_sample_one_text_each(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "other words"), (2, "other words"), (3, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, None)], "doc_id long, toxic int")
    some, share = T.labelled_sample(docs, labels, "toxic", F.lit(True), T.Sample(), "doc_id")
    assert sorted((r.doc_id, r.plain, r.bad) for r in some.collect()) == [(1, 0, 1), (2, 2, 0)] and share == pytest.approx(1 / 3)


def test_runs_and_stretches_of_words():
    assert T.runs("ab worthless") == {f" worthless "[i:i + n] for n in (6, 7, 8) for i in range(12 - n)}
    assert T.stretches("worthless less", {" worth", "rthles"}) == {" worthles"}
    assert T.stretches("worthless", {" worth", "thless"}) == {" worthless"}
    assert T.stretches("worthlessness", {" worth", "essnes"}) == {" worth", "essnes"} and T.stretches("", {"x"}) == set()


def test_quantiles_of_counted_values():
    rng = np.random.default_rng(1)
    values, counts = rng.integers(-3, 9, 40).astype(float), rng.integers(1, 6, 40)
    shares = (0.0, 0.31, 0.97, 0.995, 1.0)
    assert T.quantiles(values, counts, shares) == pytest.approx(np.quantile(np.repeat(values, counts), shares))


EDGES = [(1, None), (2, ""), (None, "some text here"), (3, "   \n "), (4, "word " * 60_000), (5, "same"), (5, "same"), (6, "日本語\n\n日本語")]


@pytest.mark.parametrize("labels", [[], [(2, 1), (5, 1)], [(2, None), (None, 1), (5, 0)], [(2, 1), (5, 0), (5, 1), (99, 1)]])
def test_classifier_edges(spark, labels):
    docs = spark.createDataFrame([(*r, 1, "x") for r in EDGES], "doc_id long, text string, score int, upper string")
    known = spark.createDataFrame([(a, b, b) for a, b in labels], "doc_id long, quality int, toxic int")
    for make in (Q.score_quality, T.score_toxicity):
        got = make(docs, known, train=F.lit(True)).collect()
        assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
        assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in EDGES)
        assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
        assert make(docs.limit(0), known, train=F.lit(True)).collect() == []


def test_rules_are_conjunctions_on_paths(spark):
    path = [Q.Condition("upper", False, 0.5), Q.Condition("upper", False, 0.2), Q.Condition("digit", True, 0.1), Q.Condition("digit", True, 0.3)]
    assert Q.simplified(path) == frozenset({Q.Condition("upper", False, 0.2), Q.Condition("digit", True, 0.3)})
    df = spark.createDataFrame([(0.1, 0.4), (0.3, 0.4), (0.1, 0.2)], "upper double, digit double")
    rule = Q.simplified(path)
    assert [r[0] for r in df.select(Q.rule_column(rule)).collect()] == [True, False, False]
    ensemble = Q.Ensemble(-1.0, ((rule, 3.0),))
    got = [r[0] for r in df.select(ensemble.score()).collect()]
    assert got == pytest.approx([1 / (1 + np.exp(-2)), 1 / (1 + np.exp(1)), 1 / (1 + np.exp(1))])


def test_statistics_of_empty_and_plain_text():
    table = Q._class_table()
    assert Q.statistics("", table) == [0.0] * len(Q.STATISTICS) == Q.statistics(" \n", table)
    s = dict(zip(Q.STATISTICS, Q.statistics("Ab cd.\nAb cd.\nx", table)))
    assert s["repeated_lines"] == pytest.approx(1 / 3) and s["upper"] == pytest.approx(2 / 15)
    assert s["distinct_words"] == pytest.approx(3 / 5) and s["top_word"] == pytest.approx(2 / 5)


# ---- pipeline


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in pipeline.STAGES:
        docs = pipeline.stored(stage(spark, docs, SF_MID), name)
        out.append((name, docs))
    return out


def test_stage_contract(stages):
    columns = stages[0][1].columns
    assert len(pipeline.STAGES) == 5
    for name, df in stages[1:-1]:
        assert df.columns == columns, name
    assert stages[-1][1].columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_quality_stage_keeps_good_documents(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1][1].collect()}
    assert np.mean([d in kept for d, y in labels.items() if y == 1]) > 0.97
    assert np.mean([d in kept for d, y in labels.items() if y == 0]) < 0.2


def test_duplicate_stage_keeps_the_smallest_id_of_each_group(stages):
    before, after = stages[1][1], stages[2][1]
    want = {r.component_id for r in simhash_groups(before).collect()}
    got = [r.doc_id for r in after.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_decontamination_stage_drops_exactly_the_contaminated(spark, stages):
    from test_windows_shards_warc import best_windows
    docs = [(r.doc_id, r.text) for r in stages[2][1].collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    bad = {d for d, _ in best_windows(docs, items)}
    assert {r.doc_id for r in stages[3][1].collect()} == {d for d, _ in docs} - bad


def test_secret_stage_masks_and_keeps_all_documents(stages):
    from blotter.llm.secrets import redact, scan_text
    before = {r.doc_id: r for r in stages[3][1].collect()}
    after = {r.doc_id: r for r in stages[4][1].collect()}
    assert before.keys() == after.keys()
    for d, r in before.items():
        assert after[d].text == redact(r.text, scan_text(r.text)[0]) and after[d].n_chars == len(after[d].text)
        assert (after[d].lang, after[d].source) == (r.lang, r.source)


def test_pack_stage_covers_every_document(stages):
    docs, pieces = stages[4][1], stages[5][1]
    want = {(r.doc_id, r.doc_tokens): r.n for r in pack_documents(docs).groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n")).collect()}
    got = {(r.doc_id, r.doc_tokens): r.n for r in pieces.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n")).collect()}
    assert got == want and all(n == k[1] for k, n in got.items()) and len(got) == docs.count()


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").limit(40)
    names = ["text_digest", "row_of_digest", "text_digest_", "key", "score", "fp", "root", "found", "a.b", "back`tick", "__row"]
    extra = docs.select("*", *[F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")).alias(n) for n in names])
    for name, stage in pipeline.STAGES[:-1]:
        made = stage(spark, extra, SF_MID)
        assert made.columns == extra.columns, name
        rows = made.collect()
        assert rows and all(r[n] == f"{n}-{r.doc_id}" for r in rows for n in names), name
    assert pipeline.pack(spark, extra, SF_MID).agg(F.countDistinct("doc_id")).first()[0] == 40


def test_stages_on_nulls_repeats_and_extra_columns(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").limit(60)
    odd = [(None, "null id one two three", "en", "s", 3), (None, "null id one two three", "en", "s", 3), (7_000_001, None, None, None, None),
           (7_000_002, "", "en", "s", 0), (7_000_003, "password=hunter2secret and the rest of a sentence", "en", "s", 1)]
    extra = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("key", F.lit("k")).withColumn("score", F.lit(1))
    for name, stage in pipeline.STAGES[:-1]:
        made = stage(spark, extra, SF_MID)
        assert made.columns == extra.columns, name
        rows = made.collect()
        if name == "simhash_near_dedup":
            assert sum(r.doc_id is None for r in rows) == 1  # one row of each group, also of repeated rows
            assert [r.doc_id for r in rows if r.text in (None, "")] == [7_000_001]
        if name == "secret_scans":
            assert len(rows) == 65 and [r.n_chars for r in rows if r.doc_id == 7_000_001] == [None]
            assert [r.text for r in rows if r.doc_id == 7_000_003] == ["[SECRET] and the rest of a sentence"]
        if name == "benchmark_decontamination":
            assert sum(r.doc_id is None for r in rows) == 2
        assert stage(spark, extra.limit(0), SF_MID).collect() == [], name
    assert pipeline.pack(spark, extra.limit(0), SF_MID).collect() == []
    assert pipeline.pack(spark, extra, SF_MID).agg(F.countDistinct("doc_id")).first()[0] == 63
