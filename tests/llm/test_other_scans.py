"""Operators that read a table twice give the same rows when it is split in another way."""

import pytest
from cases import DOCS, TESTDATA, odd_docs

from culvert.llm import decontamination, jaccard, mixing

SPLITS = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def files(spark, tmp_path):
    """Nine files that are read as one task or as many."""
    path = str(tmp_path / "docs")
    spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").union(
        spark.createDataFrame(odd_docs(), DOCS)
    ).repartition(9).write.parquet(path)
    return path


@pytest.fixture
def resplit(spark, monkeypatch):
    """After each table that an operator writes, the scans that follow are cut otherwise."""

    def of(module):
        cost, least = "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"
        steps = iter([("1", "64"), ("200m", "1")] * 500)
        real = module.stored

        def stored(df, name):
            out = real(df, name)
            opening, number = next(steps)
            spark.conf.set(cost, opening)
            spark.conf.set(least, number)
            return out

        monkeypatch.setattr(module, "stored", stored)

    yield of
    for name in ("spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"):
        spark.conf.unset(name)


def rows(df):
    return sorted(map(str, df.collect()))


def test_representatives(spark, files, resplit):
    docs = spark.read.parquet(files)
    whole = rows(jaccard.representatives(docs.coalesce(1)))
    resplit(jaccard)
    assert rows(jaccard.representatives(spark.read.parquet(files))) == whole and len(whole) > 50


def test_classes(spark, files, resplit):
    wanted = ("doc_id", "n_shingles", "component_id")
    whole = rows(jaccard.classes(spark.read.parquet(files).coalesce(1)).select(*wanted))
    resplit(jaccard)
    assert rows(jaccard.classes(spark.read.parquet(files)).select(*wanted)) == whole


def test_clean(spark, files, resplit):
    items = spark.read.parquet(f"{TESTDATA}/sf0.001/benchmark.parquet")
    whole = rows(decontamination.clean(spark.read.parquet(files).coalesce(1), items))
    resplit(decontamination)
    kept = rows(decontamination.clean(spark.read.parquet(files), items))
    assert kept == whole and len(kept) < spark.read.parquet(files).count()


def test_base_scores_of_the_mixing_model(spark, files, resplit):
    docs = spark.read.parquet(files)
    wanted = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    whole = rows(mixing.score(docs.coalesce(1)).select(*wanted))
    resplit(mixing)
    again = mixing.score(spark.read.parquet(files))
    assert rows(again.select(*wanted)) == whole and len(whole) == docs.count()
