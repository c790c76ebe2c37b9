"""The stages against plain versions of their rules."""

import re

import pytest

import corpus_pipeline as cp
from test_spans import plain_secrets


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """What each stage gets and gives."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        result = stage(spark, docs, sf)
        result.write.parquet(str(folder / name))
        result = spark.read.parquet(str(folder / name))
        out[name] = (docs, result)
        docs = result
    return out


def texts(df):
    return {r.doc_id: r.text or "" for r in df.collect()}


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())


def test_columns_stay(stages):
    for name, (docs, result) in list(stages.items())[:-1]:
        assert result.dtypes == docs.dtypes, name


def test_quality_drops_bad_documents_only(stages, spark, sf):
    docs, result = stages["quality_classifier"]
    left = set(texts(result))
    bad = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 0").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
    assert not bad & left and good <= left


def test_one_document_of_each_group(stages):
    docs, result = stages["near_duplicates"]
    sets = {d: shingles(t) for d, t in texts(docs).items()}
    group = {d: d for d in sets}

    def top(d):
        while group[d] != d:
            d = group[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                group[y] = x
    assert set(texts(result)) == {d for d in sets if top(d) == d}


def test_benchmark_passages_go(stages, spark, sf):
    docs, result = stages["decontamination"]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    held = {d for d, t in texts(docs).items() if any(i in t for i in items)}
    assert held and set(texts(result)) == set(texts(docs)) - held


def test_secrets_are_masked(stages):
    docs, result = stages["secrets"]
    before, after = texts(docs), texts(result)
    assert set(before) == set(after) and any(plain_secrets(t) for t in before.values())
    for d, t in after.items():
        assert not plain_secrets(t)
        if not plain_secrets(before[d]):
            assert t == before[d]
    assert all(r.n_chars == len(r.text) for r in result.collect())


def test_all_documents_are_packed(stages):
    docs, result = stages["packing"]
    assert {r.doc_id for r in result.collect()} == set(texts(docs))


def test_odd_rows_go_through(spark, sf, tmp_path):
    long = "word another thing. " * 20_000
    rows = [(None, "no id", "en", "s", 5), (1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0),
            (3, long, "en", "s", len(long)), (4, long, "en", "s", len(long))]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    for data in (rows, []):
        docs = spark.createDataFrame(data, kind)
        for k, (name, stage) in enumerate(cp.STAGES[:-1]):
            docs = stage(spark, docs, sf)
            docs.write.mode("overwrite").parquet(str(tmp_path / f"{len(data)}-{k}"))
            docs = spark.read.parquet(str(tmp_path / f"{len(data)}-{k}"))
        assert cp.packed(spark, docs, sf).count() >= (1 if data else 0)
