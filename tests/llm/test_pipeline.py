import os

import corpus_pipeline
import duckdb
import pytest
from egolake.llm import mixing, queries
from pyspark.sql import functions as F

from .common import documents, prose
from .test_near_dedup import brute
from .test_text_rules import base

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def key(rows):
    return sorted(rows, key=str)


@needs_data
def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select(*COLUMNS)
    stage = dict(corpus_pipeline.STAGES)
    more = DATA.replace("sf0.001", "sf0.01")  # labels enough to learn from
    large = spark.read.parquet(f"{more}/documents.parquet").select(*COLUMNS)
    kept = stage["toxicity"](spark, large, more)
    assert kept.columns == COLUMNS
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    insults = ("idiot", "moron", "worthless", "pathetic", "scum")
    texts = {r.doc_id: r.text for r in large.collect()}
    plain = {i for i, t in texts.items() if sum(t.lower().count(w) for w in insults) >= 3}
    assert not plain & ids and len(ids) > 0.8 * len(texts)
    texts = {r.doc_id: r.text for r in docs.collect()}

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    single = stage["minhash_near_dedup"](spark, docs, DATA)
    assert single.columns == COLUMNS
    assert {r.doc_id for r in single.collect()} == {d for d, _, _, k in brute(rows, 5, 80, 100) if k}

    clean = {r.doc_id: r.text for r in stage["secret_scan"](spark, docs, DATA).collect()}
    assert clean.keys() == texts.keys()
    assert all((clean[i] != t) >= bool(base(t)) and not base(clean[i]) for i, t in texts.items())

    order = [r.doc_id for r in stage["mix_sources"](spark, docs, DATA).collect()]
    want = [r.doc_id for r in sorted(mixing.scheduled(docs).collect(), key=lambda r: r.position)]
    assert order == want and sorted(order) == sorted(texts)


@needs_data
def test_run(spark):
    out = corpus_pipeline.run(spark, DATA)
    assert {"doc_id", "ids", "starts", "ends", "n_tokens"} <= set(out.columns)
    assert 0 < out.count() < 200 and out.where("n_tokens <> size(ids)").count() == 0
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select(*COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, DATA)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = out.collect()
    assert {r.doc_id: list(r.ids) for r in rows} == {i: lib.encode(t) for i, t in texts.items()}
    assert all(r.ends[-1] == len(texts[r.doc_id].encode()) and lib.decode(list(r.ids)) == lib.decode(lib.encode(texts[r.doc_id])) for r in rows if r.ids)
    assert sorted(r.position for r in rows) == sorted({r.position for r in rows})


def test_stages_on_odd_rows(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    for rows in (None, []):
        docs = documents(spark, rows).select(*COLUMNS)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, f"file://{tmp_path}")
            assert name == "sentencepiece" or docs.columns == COLUMNS
        assert docs.count() == 0 if rows == [] else docs.count() > 8


def test_the_mixture_has_every_source_of_very_many(spark):
    names = [f"host{i:04d}" for i in range(2101)]
    docs = spark.createDataFrame([(i, "word", "en", s, 4) for i, s in enumerate(names)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.source for r in corpus_pipeline.mix_sources(spark, docs, "").collect()] == names
    got = corpus_pipeline.encode_pieces(spark, docs, "").select("source", "position").collect()
    assert [r.source for r in sorted(got, key=lambda r: r.position)] == names


def test_run_keeps_the_mixture_over_part_files(spark, tmp_path):
    sizes = {"a": 600, "b": 300, "c": 100}
    rows = [(i, prose(i, 20), "en", s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text"))
    docs.repartition(7).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "90")
    try:
        got = corpus_pipeline.run(spark, f"file://{tmp_path}").select("source", "position").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    block, slot_of = mixing.BLOCK, {}
    blocks = [-(-n // block) for n in sizes.values()]
    for slot, (i, j) in enumerate(mixing.schedule(blocks, [n**0.5 for n in sizes.values()])):
        slot_of[slot] = list(sizes)[i], j
    want = {}
    for slot, (source, j) in slot_of.items():
        want |= {slot * block + k: source for k in range(min(block, sizes[source] - j * block))}
    assert {r.position: r.source for r in got} == want and len(got) == 1000


@needs_data
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    found = con.execute(queries.ORACLE_SQL[name])
    cols = [c[0] for c in found.description]
    got = queries.QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(cols)
    assert key(tuple(r[c] for c in cols) for r in got.collect()) == key(found.fetchall())
