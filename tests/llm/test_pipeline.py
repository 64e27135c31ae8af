import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from foldboard.llm.common import table
from foldboard.llm.decontamination import contaminated, contamination
from foldboard.llm.near_dedup import near_duplicates
from foldboard.llm.toxicity import learnt, score_toxicity

ROOT = Path(__file__).resolve().parents[2]


@pytest.mark.usefixtures("sparse")
def test_stages_keep_columns_and_take_effect(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    toxic = score_toxicity(docs, learnt(spark, docs, sf_dir)).filter("predicted = 1")
    clean = stages["toxicity"](spark, docs, sf_dir)
    assert clean.columns == columns
    assert clean.count() == docs.count() - toxic.count()

    single = stages["near_dedup"](spark, docs, sf_dir)
    assert single.columns == columns
    classes = near_duplicates(docs).select("class_id").distinct()
    assert {r["doc_id"] for r in single.select("doc_id").collect()} == {
        r["class_id"] for r in classes.collect()
    }

    benchmark = table(spark, sf_dir, "benchmark")
    dirty = contamination(docs, benchmark).filter(contaminated())
    left = stages["decontamination"](spark, docs, sf_dir)
    assert left.columns == columns
    assert left.count() == docs.count() - dirty.count()
    assert stages["mixing"](spark, docs, sf_dir).columns == columns
    assert stages["sharding"](spark, docs, sf_dir).count() == docs.count()


def test_stages_take_empty_tables(spark, sf_dir, sparse):
    none = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0


def test_entry_without_these_operators(tmp_path):
    """The other queries load where this subpackage and the pipeline are absent."""
    for name in ("foldboard", "__spark_entry__.py"):
        (tmp_path / name).symlink_to(ROOT / name)
    code = (
        "import sys, importlib.abc\n"
        "class Absent(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('foldboard.llm'):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Absent())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 40 and not any(q.startswith('op1') for q in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
