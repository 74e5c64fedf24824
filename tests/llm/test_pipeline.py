"""The stages against plain Python, and the whole run on a small table."""


import corpus_pipeline as pipeline
import pyarrow as pa
import pytest
from test_leaks import passage
from test_lines import LONG, plain
from test_neardup import classes
from test_packing import assert_whole, reference_ids

from turnstile.llm import language, leaks, shared

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_run_equals_the_stages_in_plain_python(spark, given):
    docs = [(r["doc_id"], r["text"]) for r in given.collect()]
    # Language: the same learned chances, each text fitted on its own.
    learned = given.where(~((pipeline.F.crc32(pipeline.F.col("doc_id").cast("string")) % 4) == 2))
    langs, chances = language.learn(learned, "text", "lang", "doc_id", 20_000)
    mixture = language.Mixture(langs, chances, 3.0, 12)
    fits = {i: mixture.fit(t) for i, t in docs}
    docs = [(i, t) for i, t in docs if fits[i] and fits[i][0][1] >= pipeline.LEAST_SHARE]
    docs = [(i, t) for (i, t), (_, old) in zip(plain(docs), sorted(docs, key=str), strict=True) if t == old or t.strip()]
    root = classes(docs)
    docs = [(i, t) for i, t in docs if root[i] == i]
    words = lambda text: leaks.words_of([text])[0]
    items = [words(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    grams = [set(leaks.ngrams(w, 3).tolist()) for w in items]

    def clean(text):
        own = words(text)
        held = set(leaks.ngrams(own, 3).tolist())
        # Without a common trigram no alignment reaches half of an item here.
        return not any(g & held and leaks.align(w, own)[0] >= leaks.MATCH * len(w) * 0.5 for w, g in zip(items, grams, strict=True))

    docs = [(i, t) for i, t in docs if clean(t)]
    rows = pipeline.run(spark, FOLDER).collect()
    assert_whole(rows, {i: reference_ids(t) for i, t in docs})
    assert 0 < len(docs) < given.count()


def test_stages_keep_columns_and_survive_odd_rows(spark, given):
    text = given.where("lang = 'en' and n_chars > 500").orderBy("doc_id").first()["text"]
    rows = [
        (1, text, "en", None, 10, "a", 1.0), (1, text, "en", None, 10, "a", 1.0), (2, None, None, "s", None, "b", None), (3, "", None, None, 0, None, 0.0),
        (None, text + " and one more word", "en", "s", 5, "c", 0.0), (4, f"{LONG}\n" + text[:200], "en", "s", 7, "d", 0.1), (5, LONG, "en", "s", 7, "d", 0.1),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, template string, score double"
    docs = spark.createDataFrame(rows, schema).unionByName(given.selectExpr("doc_id + 1000 AS doc_id", "text", "lang", "source", "n_chars", "'z' AS template", "0.5 AS score"))
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0, name
        out = stage(spark, docs, FOLDER)
        assert out.count() > 0, name
        if name != "packing":
            assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString(), name
        docs = out
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(docs.columns)


def test_each_stage_acts_on_what_it_is_given(spark, given, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    make = lambda rows: spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in rows], schema)
    kept = lambda stage, rows: sorted(r["doc_id"] for r in stage(spark, make(rows).unionByName(given.selectExpr("doc_id + 1000 AS doc_id", "text", "lang", "source", "n_chars")), FOLDER).collect() if r["doc_id"] < 1000)
    prose = [r["text"] for r in given.where("n_chars > 800").orderBy(pipeline.F.desc("doc_id")).limit(2).collect()]
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").orderBy("item_id").first()["text"]
    assert kept(pipeline.identify_language, [(1, "12 34 ?!"), (2, prose[0]), (3, "")]) == [2]
    own = " ".join(passage(1, 90))
    assert kept(pipeline.drop_near_duplicates, [(1, own), (2, own.upper()), (3, own + " more"), (4, " ".join(passage(2, 90)))]) == [1, 4]
    assert kept(pipeline.decontaminate, [(1, f"{own} {item} {own}"), (2, own)]) == [2]
    assert kept(pipeline.drop_lines, [(1, own), (2, own), (3, f"{own}\nleft here")]) == [1, 3]


def test_the_order_of_the_stages():
    assert [f for _, f in pipeline.STAGES] == [pipeline.identify_language, pipeline.drop_lines, pipeline.drop_near_duplicates, pipeline.decontaminate, pipeline.pack_sequences]
    assert pipeline.ORACLE_SQL is None


def test_python_gets_small_batches_and_each_text_once(spark, given, monkeypatch):
    wide = spark.range(0, 4_000, 1, 1).select("id", pipeline.F.repeat(pipeline.F.lit("abcd"), 1_000).alias("text"))  # 16 MB

    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.nbytes])], names=["n"])

    largest = lambda: max(r.n for r in wide.mapInArrow(sizes, "n long").collect())
    limit, sent, send = "spark.sql.execution.arrow.maxBytesPerBatch", [], type(wide).mapInArrow
    monkeypatch.setattr(type(wide), "mapInArrow", lambda df, *a, **k: (sent.append(df.columns), send(df, *a, **k))[1])
    try:
        pipeline.identify_language(spark, given, FOLDER)
        assert len(sent[-1]) == len(given.columns)
        assert largest() < 2 * pipeline.BATCH_BYTES
        spark.conf.set(limit, "1m")
        pipeline.identify_language(spark, given, FOLDER)
        assert spark.conf.get(limit) == "1m"
    finally:
        spark.conf.unset(limit)


def test_run_leaves_the_session_as_it_was(spark, monkeypatch):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    monkeypatch.setattr(pipeline, "STAGES", pipeline.STAGES[:1])
    assert pipeline.run(spark, FOLDER).count() > 0
    assert spark.conf.get(limit, None) is None


@pytest.mark.parametrize("stage", [pipeline.drop_lines, pipeline.drop_near_duplicates])
def test_little_data_makes_few_files_whatever_the_partitions(spark, given, monkeypatch, stage):
    files, store = {}, shared.Scratch.stored

    def watched(kept, df, name):
        out = store(kept, df, name)
        files[name] = len(out.inputFiles())
        return out

    monkeypatch.setattr(shared.Scratch, "stored", watched)
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        stage(spark, given, FOLDER)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    assert max(files.values()) <= 4 * spark.sparkContext.defaultParallelism < 60
