import glob
import hashlib
import os
import time

import duckdb
import public_tokenizers
import pytest
from helpers import TEXTS, edge_docs, none_of
from pyspark.sql import functions as F

import corpus_pipeline
from check_oracle import compare
from tablewright.llm import merkle, minhash, mixing, packing, pii, queries
from tablewright.session import small_frame


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, sf, con, name):
    assert compare(spark, con, name, sf)[0] == "ok"


def test_every_operator_is_registered():
    import __spark_entry__ as entry
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_stages_on_edge_cases(spark, tmp_path):
    docs = edge_docs(spark).drop("ids")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, "")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "language":
            assert {r["doc_id"] for r in docs.collect()} == {4, 5, 6, 8, 9, 10, None}
        if name == "near_duplicates":
            assert sorted((r["doc_id"] for r in docs.collect()), key=repr) == sorted([4, 5, 8, 9, 10, None], key=repr)
    assert all(r["decoded_sha256"] == hashlib.sha256(dict(TEXTS)[r["doc_id"]].encode()).hexdigest() for r in docs.collect())


INTERNAL = ("_source", "_rate", "_copies", "_copy", "_order", "_pii", "_replaced", "_p", "_id_score", "_id_lang_pred", "_gone", "row", "place", "rate",
            "id", "of", "name", "copy", "held", "key", "t", "k", "tree", "uid", "digest", "length", "piece", "start")


def test_operators_carry_clashing_columns(spark):
    """A frame that has every name the operators use inside loses nothing and mixes nothing up."""
    docs = small_frame(spark, [(i, t, "en", "s", 0 if t is None else len(t), *[f"{n}{i}" for n in INTERNAL]) for i, t in TEXTS],
                       "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in INTERNAL))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and not out.isEmpty(), name
        wrong = " or ".join(f"`{n}` <> concat('{n}', coalesce(cast(doc_id as string), 'None'))" for n in INTERNAL)
        assert out.where(wrong).isEmpty(), name
    assert corpus_pipeline.encoding(spark, docs, "").count() == len(TEXTS)
    mixed = mixing.mix(docs, units=F.length(F.coalesce("text", F.lit(""))) + 1)
    assert mixed.columns == [*docs.columns, "__copy", "__rate", "__order"]
    assert pii.pseudonymise(docs, "k").columns == docs.columns
    assert minhash.near_duplicates(docs).count() == len(TEXTS)
    assert merkle.manifest(docs).count() == len(TEXTS)
    assert packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, 1_000_000).count() == len(TEXTS)


def test_stages_on_nothing(spark, tmp_path):
    docs = none_of(spark).drop("ids")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() == 0


def test_language_with_nothing_to_learn_from(spark):
    docs = edge_docs(spark).drop("ids").withColumn("lang", F.lit(None).cast("string"))
    with pytest.raises(ValueError):
        corpus_pipeline.language(spark, docs, "")


def test_pipeline_keeps_clean_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    language = corpus_pipeline.language(spark, docs, sf)
    assert language.count() == docs.count()
    kept = corpus_pipeline.near_duplicates(spark, language, sf)
    assert kept.count() == minhash.near_duplicates(docs, 5, 80).where("kept").count()
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_null_id_with_the_set_of_others(spark):
    docs = small_frame(spark, [(1, "a b c d"), (2, "a b c d"), (None, "a b c d")], "doc_id long, text string")
    got = {tuple(r) for r in minhash.near_duplicates(docs, 3, 85).collect()}
    assert got == {(1, 2, 1, True), (2, 2, 1, False), (None, 2, None, True)}


def test_very_many_values_in_one_text(spark):
    """A hundred thousand values: the work grows with the text, not with its square."""
    text = "\n".join(f"10.{i // 65536 % 256}.{i // 256 % 256}.{i % 256}" for i in range(100_000))
    docs = small_frame(spark, [(1, text)], "doc_id long, text string")
    started = time.time()
    row = pii.pseudonymise(docs, "k", count="n").first()
    assert time.time() - started < 30
    lines = row.text.split("\n")
    assert row.n == 100_000 and len(set(lines)) == 100_000 and all(len(x.split(".")) == 4 for x in lines)


def test_bucket_members_are_compared_by_tiles(spark, monkeypatch):
    """A template that differs a little: not linked to the first of a bucket, but to others, over several tiles."""
    monkeypatch.setattr(minhash, "TILE", 3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(24):
        words = list(base)
        for j in range(3):
            words[(7 * k + j) % 60] = f"x{k // 2}-{j}"
        rows.append((k, " ".join(words)))
    docs = small_frame(spark, rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 3, 85).collect()}
    sets = [{tuple(t.split()[i: i + 3]) for i in range(58)} for _, t in rows]
    want = {}
    for k in range(24):
        want.setdefault(k, k)
    for _ in range(24):
        for a in range(24):
            for b in range(24):
                if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    want[a] = want[b] = min(want[a], want[b])
    assert got == want
