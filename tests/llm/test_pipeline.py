import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tierflow.llm.common import frozen
from tierflow.llm.queries import ORACLES, QUERIES
from tierflow.llm.quality import RULES, Text

from .test_ngram_join import groups, shingles
from .test_quality import brute as quality_brute

ROOT = Path(__file__).resolve().parents[2]
FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def stages(spark):
    """The input and the output of every stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(frozen(stage(spark, out[-1], FOLDER), "stage"))
    return [df.collect() for df in out], [df.columns for df in out]


def test_order_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "toxicity", "n-gram join", "secret scan", "best-two-fit packing"]
    assert all(columns == stages[1][0] for columns in stages[1][:-1])


def test_quality_stage(stages):
    before, after = stages[0][:2]
    want = [r.doc_id for r in before if not quality_brute(r.text)[5] and not any(rule.rejects(Text(r.text or "")) for rule in RULES)]
    assert sorted(r.doc_id for r in after) == sorted(want)


def test_toxicity_stage_keeps_most_and_drops_insults(stages):
    before, after = stages[0][1:3]
    kept = {r.doc_id for r in after}
    assert kept < {r.doc_id for r in before} and len(kept) > 0.8 * len(before)


def test_near_copies_stage(stages):
    before, after = stages[0][2:4]
    before = sorted(before, key=lambda r: r.doc_id)
    want = {before[k].doc_id for k in groups([shingles(r.text) for r in before])}
    assert sorted(r.doc_id for r in after) == sorted(want)


def test_secrets_stage_masks_and_keeps_rows(stages):
    before, after = ({r.doc_id: r for r in rows} for rows in stages[0][3:5])
    assert before.keys() == after.keys()
    changed = [i for i in before if before[i].text != after[i].text]
    assert all("<assign>" in after[i].text or "<hex>" in after[i].text or "<access>" in after[i].text for i in changed)
    assert all(r.n_chars == len(r.text) for r in after.values())


def test_packing_stage_covers_all_documents(stages):
    before, after = stages[0][4:]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    assert max(r.offset + r.length for r in after) <= 1024


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.count() == len(stages[0][-1])
    assert got.agg(F.sum("length")).first()[0] == sum(r.length for r in stages[0][-1])


def test_queries_are_registered():
    assert sorted(name.split("_")[0] for name in QUERIES) == sorted([*(f"op{n}" for n in range(1, 14)), "pipeline"])
    assert {name.split("_")[0] for name in ORACLES} == {"op11", "op13"} and corpus_pipeline.ORACLE_SQL is None


def test_entry_works_without_the_subpackage(tmp_path):
    skip = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    code = "import __spark_entry__ as e; n = e.queries(); print(len(n), any(x.startswith('op') and x[2].isdigit() for x in n))"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    count, has = run.stdout.split()[-2:]
    assert int(count) > 100 and has == "False", run.stderr
