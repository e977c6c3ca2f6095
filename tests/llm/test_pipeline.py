"""The pipeline beside its stages' own rules, and the repository without the subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import public_tokenizers
import tiktoken
from odd_cases import SF_DIR
from test_dedup import components, groups, leaks

from wardstat.llm import byte_bpe, toxicity

REPO = Path(__file__).resolve().parents[2]


def test_pipeline(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    tagger = toxicity.train(documents, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.toxicity_scores(documents, tagger).where("predicted = 1").collect()}
    rows = [r for r in rows if r[0] not in toxic]
    keep = {i for i, k, *_ in groups(rows) if i == k}
    rows = [r for r in rows if r[0] in keep]
    keep = {i for i, _, c in components(rows) if i == c}
    rows = [r for r in rows if r[0] in keep]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    gone = {i for i, *_ in leaks(rows, items)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=byte_bpe.read_ranks(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    expected = {i: library.encode_ordinary(t) for i, t in rows if i not in gone}
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert toxic and gone and got == expected


def test_stages_keep_the_columns(spark, odd, nothing):
    for frame in (odd, nothing):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF_DIR)
            assert docs.columns == frame.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == docs.count()


def test_the_rest_stands_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') for n in q), q"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120)
