import re
import shutil
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from patronlens.llm import quality
from tests.llm.test_decontaminate import brute as contamination
from tests.llm.test_linededup import brute as line_dedup
from tests.llm.test_simhash import brute_print, groups

REPO = Path(__file__).resolve().parents[2]
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents and what each stage made of them, written and read again."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    tables, folder = [docs], tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], FOLDER).write.parquet(f"{folder}/{name}")
        tables.append(spark.read.parquet(f"{folder}/{name}"))
    return tables


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "packing"]
    assert all(t.schema == stages[0].schema for t in stages[1:-1])
    assert all(0 < after.count() <= before.count() for before, after in zip(stages[:-2], stages[1:-1]))


def test_quality_classifier(spark, stages):
    model = quality.train(stages[0], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    accepted = {r.doc_id for r in quality.score(stages[0], model).where("score >= 0.3").collect()}
    assert accepted == set(texts(stages[1]))


def test_line_dedup(stages):
    want = line_dedup(list(texts(stages[1]).items()))
    assert texts(stages[2]) == {doc_id: text for doc_id, (text, *_) in want.items()}
    assert stages[2].where("n_chars <> length(text)").count() == 0


def test_simhash_near_dedup(stages):
    before = texts(stages[2])
    ids = sorted(before)
    kept = {ids[k] for k in groups([brute_print(before[i]) for i in ids])}
    assert set(texts(stages[3])) == kept


def test_benchmark_decontamination(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    before = texts(stages[3])
    ids = list(before)
    short = [(i, re.sub(r"\s+", " ", before[i])) for i in ids]
    hit = contaminated(short, items)
    assert set(texts(stages[4])) == {i for i in ids if i not in hit}


def contaminated(docs, items):
    """Ids of documents with a window of an item; a set of windows by size instead of the plain loops, which are slow here."""
    from tests.llm.test_decontaminate import words_of

    windows = {}
    for _, item in items:
        words = words_of(item)
        size = min(10, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows.setdefault(size, set()).add(tuple(words[i : i + size]))
    hit = set()
    for doc_id, text in docs:
        words = words_of(text)
        if any(tuple(words[i : i + n]) in own for n, own in windows.items() for i in range(len(words) - n + 1)):
            hit.add(doc_id)
    assert contamination([docs[0][1][:300]], items[:2], 10)[0][0] == len(words_of(docs[0][1][:300]))
    return hit


def test_packing(stages):
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    pieces = {}
    for r in stages[5].collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids))
    packed = {i: np.frombuffer(b"".join(ids for _, ids in sorted(p)), dtype="<u4").tolist() for i, p in pieces.items()}
    assert packed == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in texts(stages[4]).items()}


def test_run_gives_the_last_stage(spark, stages):
    columns = ["doc_id", "start", "length", F.crc32("ids").alias("crc")]
    run = __spark_entry__.queries()["pipeline"](spark, FOLDER).select(*columns)
    assert run.agg(F.sum("length"), F.countDistinct("doc_id")).first() == stages[5].agg(F.sum("length"), F.countDistinct("doc_id")).first()


def test_stages_on_an_empty_table(spark, stages):
    empty = stages[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0


def test_the_rest_works_without_these_folders(tmp_path):
    shutil.copytree(REPO, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    said = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(sorted(e.queries())[0], any(q.startswith('op1') for q in e.queries()), 'pipeline' in e.oracle_sql())"],
        cwd=tmp_path / "r", capture_output=True, text=True,
    )
    assert said.stdout.split()[1:] == ["False", "False"], said.stderr
    assert not any("llm" in p.read_text() for p in (REPO / "patronlens").rglob("*.py") if "llm" not in p.parts)


def test_every_operator_has_one_query():
    names = [re.match(r"op(\d+)_", name) for name in __spark_entry__.queries()]
    assert sorted(int(m[1]) for m in names if m) == list(range(1, 14))
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
