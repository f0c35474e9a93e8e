"""The pipeline against a plain version of each stage, each on what the stage before has written."""

import hashlib
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from etalage.llm import quality
from tests.conftest import SF
from tests.llm.test_bpe import TIKTOKEN
from tests.llm.test_mixing import water_level
from tests.llm.test_quality import WORDS, by_hand
from tests.llm.test_simhash import fingerprint_by_hand, groups_by_hand

FOLDER = SF.replace("sf0.001", "sf0.01")
ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """Rows of documents, then of each stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages(written):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["by_rules", "exact", "near_dedup", "in_mix", "tokens"]
    columns = written[0].columns
    assert all(df.columns == columns for df in written[:-1])


def test_rules(spark, written):
    judged = quality.quality(written[0], {"doc_id": F.col("doc_id")}).collect()
    kept = {r.doc_id for r in judged if r.kept}
    texts = {r.doc_id: r.text for r in written[0].collect()}
    failed = {i for i, t in texts.items() if (c := by_hand(t))[0] < 20 or 100 * c[4] > 30 * c[0]}
    assert not kept & failed
    assert {r.doc_id for r in written[1].collect()} == kept
    good = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").collect()}
    assert good - failed <= kept


def test_exact(written):
    newest = {}
    for r in written[1].collect():
        if r.text not in newest or r.doc_id > newest[r.text].doc_id:
            newest[r.text] = r
    assert rows(written[2]) == Counter(tuple(r) for r in newest.values())


def test_near(written):
    docs = sorted(written[2].collect(), key=lambda r: r.doc_id)
    label = groups_by_hand([fingerprint_by_hand(r.text) for r in docs], 4)
    assert rows(written[3]) == Counter(tuple(docs[i]) for i in set(label))


def test_mix(written):
    docs = written[3].collect()
    size = {r.doc_id: len(WORDS.findall(r.text or "")) for r in docs}
    sizes = Counter()
    for r in docs:
        sizes[r.source] += size[r.doc_id]
    target = water_level(dict(sizes), [5, 2, 1], 3)
    want = Counter()
    for source in sizes:
        start = 0
        for r in sorted((r for r in docs if r.source == source), key=lambda r: hashlib.md5(str(r.doc_id).encode()).hexdigest()):
            copies = sum(start + p * sizes[source] + size[r.doc_id] / 2 <= target[source] for p in range(3))
            if copies:
                want[tuple(r)] = copies
            start += size[r.doc_id]
    assert rows(written[4]) == want


def test_tokens(written):
    want = Counter()
    for r in written[4].collect():
        ids = TIKTOKEN.encode_ordinary(r.text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want[r.doc_id, len(ids), digest, hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    assert rows(written[5]) == want


def test_run_gives_the_last_stage(spark, written):
    assert rows(corpus_pipeline.run(spark, FOLDER)) == rows(written[-1])


def test_nulls_empties_repeats_and_extra_columns(spark):
    text = " ".join(f"word{i}" for i in range(40))
    made = [(1, text, "en", "a"), (1, text, "en", "a"), (None, text, None, None), (2, None, "en", "a"), (3, "", None, "b"),
            (4, text + " more", "en", None), (None, "few", "en", "a")]
    docs = spark.createDataFrame([(*r, 0, "x", 1.0) for r in made],
                                 "doc_id long, text string, lang string, source string, n_chars long, key string, _loc double")
    kept = {"by_rules": 4, "exact": 4, "near_dedup": 4, "in_mix": None}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        assert out.count() == kept[name] if kept[name] else out.count() > 0, name
        assert stage(spark, docs.where("false"), FOLDER).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == len(made)


def test_entry_works_without_this_part(tmp_path):
    """With the folder and the pipeline gone, the entry has the other queries; other errors are not hidden."""
    import shutil

    shutil.copytree(ROOT / "etalage", tmp_path / "etalage", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    ask = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') for n in q), 'pipeline' in q)"
    said = subprocess.run([sys.executable, "-c", ask], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert said.stdout.split()[1:] == ["False", "False"] and int(said.stdout.split()[0]) > 100, said.stderr
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module\n")
    broken = subprocess.run([sys.executable, "-c", ask], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert broken.returncode and "no_such_module" in broken.stderr
