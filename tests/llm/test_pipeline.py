"""The pipeline's stages against plain Python, and its registration."""

import pathlib
import subprocess
import sys
from collections import defaultdict

import pytest

import __spark_entry__
import corpus_pipeline
from tests.llm.cases import edge_texts
from tests.llm.test_decontaminate import expected as hits
from tests.llm.test_quality import MORE, counts
from tests.llm.test_runs import expected_lines
from tests.llm.test_simhash import groups, plain_fingerprint

ROOT = pathlib.Path(__file__).resolve().parents[2]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = []
    for i, t in edge_texts(11) + MORE:
        rows.append((i, t, "en", "s", None if t is None else len(t)))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    good = [t for i, t in edge_texts(11) if t and len(t.split()) > 60]
    items = [(1, " ".join(good[3].split()[5:40])), (2, "not in any of these texts, whatever one may look for in them, surely")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, items


def test_stages(spark, folder):
    path, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        found = stage(spark, docs, path)
        rows = found.collect()
        if name != "packing":
            assert found.columns == docs.columns
            after = sorted(((r.doc_id, r.text) for r in rows), key=repr)
            assert all(r.n_chars == len(r.text) for r in rows)
        if name == "quality":
            assert all(counts(t)[0] >= 10 and 5 * counts(t)[4] <= counts(t)[0] for _, t in after)
            kept = {i for i, _ in after}
            assert 1006 in kept and 1000 not in kept
        elif name == "lines":
            plain = [(i, t) for i, n, gone, t in expected_lines(before, 3) if n == 0 or gone < n]
            assert after == sorted(plain, key=repr)
        elif name == "near_duplicates":
            fps = {t: plain_fingerprint(t) for _, t in before}
            root = groups(sorted(set(fps.values())), lambda a, b: (a ^ b).bit_count() <= 3)
            members = defaultdict(list)
            for i, t in before:
                members[root[fps[t]]].append(i)
            wanted = [min((i for i in own if i is not None), default=None) for own in members.values()]
            assert sorted((i for i, _ in after), key=repr) == sorted(wanted, key=repr)
            assert set(after) <= set(before)
        elif name == "decontamination":
            bad = {i for i, *_, contaminated in hits(before, items, 13) if contaminated}
            assert bad and after == sorted(((i, t) for i, t in before if i not in bad), key=repr)
        else:
            total = defaultdict(int)
            for r in rows:
                total[r.doc_id] += r.length
            assert set(total) == {i for i, _ in before}
        if name != "packing":
            kind = docs.schema
            docs = spark.createDataFrame([tuple(r) for r in rows], kind)


def test_run_and_registration(spark, folder):
    assert corpus_pipeline.run(spark, folder[0]).count() > 0
    names = __spark_entry__.queries()
    assert names["pipeline"] is corpus_pipeline.run
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_entry_without_the_text_operators(tmp_path):
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name in ('corpus_pipeline', 'tallymart.llm'): raise ModuleNotFoundError(name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'kpi_yearly' in e.queries() and not any(n.startswith('op') or n == 'pipeline' for n in e.queries())\n"
        "assert set(e.oracle_sql()) <= set(e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
