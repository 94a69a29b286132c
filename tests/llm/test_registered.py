"""Registration, the pipeline's stages, and oracle agreement."""

import hashlib
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.test_decontaminate import words
from tests.llm.test_jaccard_join import brute as near_brute
from tidepool.llm import bpe
from tidepool.llm.catalog import ORACLE, QUERIES, vocabulary

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, rel = QUERIES[name](spark, SF), con.sql(ORACLE[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    assert sorted(map(str, map(tuple, df.select(cols).collect()))) == sorted(map(str, rel.select(*cols).fetchall()))


def test_pipeline_against_plain_stages(spark, tmp_path):
    """Stages 2 to 5 in plain Python from what language ID kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids == {r["doc_id"] for r in rows if any(c.isalpha() for c in r["text"] or "")}
    left = {}
    for r in sorted((r for r in rows if r["doc_id"] in ids), key=lambda r: r["doc_id"]):
        left[r["text"]] = r["doc_id"]
    left = [(i, t) for t, i in left.items()]
    first = {i for i, _, c in near_brute(left) if i == c}
    wins = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        ws = words(r["text"])
        wins |= {tuple(ws[k:k + 10]) for k in range(max(len(ws) - 9, 1)) if ws}
    short = {len(w) for w in wins}
    tok, expected = bpe.load(vocabulary()), []
    for i, t in left:
        ws = words(t)
        if i in first and not any(tuple(ws[k:k + n]) in wins for n in short for k in range(len(ws) - n + 1)):
            tokens = tok.encode(t)
            expected.append((i, len(tokens), hashlib.sha256(" ".join(map(str, tokens)).encode()).hexdigest()))
    got = corpus_pipeline.run(spark, SF)
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in got.collect()) == sorted(expected)


def test_the_rest_works_without_this_package(tmp_path):
    """A copy of the library without the llm parts still imports."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = (f"import shutil, sys; shutil.copytree({root + '/tidepool'!r}, 'tidepool', ignore=shutil.ignore_patterns('llm'));"
            f"shutil.copy({root + '/__spark_entry__.py'!r}, '.'); sys.path.insert(0, '.');"
            "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and len(q) > 50; e.oracle_sql()")
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": ""})
