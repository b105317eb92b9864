import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry
import corpus_pipeline

ROOT = Path(entry.__file__).parent
SMALL = "/root/testdata/sf0.001"


def test_stages_follow_one_another(spark, tmp_path):
    """Each stage returns the columns of documents and works on what came before."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kinds = docs.columns, docs.dtypes
    counts = [docs.count()]
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "ngram_jaccard", "decontamination", "best_fit_packing",
    ]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, SMALL)
        assert result.columns == columns and result.dtypes == kinds
        result.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
        assert docs.join(spark.read.parquet(f"{SMALL}/documents.parquet"), "doc_id", "left_anti").count() == 0
    assert counts == sorted(counts, reverse=True) and counts[-1] < counts[0]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.select("doc_id").collect()}
    run = corpus_pipeline.run(spark, SMALL).collect()
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[k] for k in key) for r in run) == sorted(tuple(r[k] for k in key) for r in pieces)


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_the_rest_works_without_the_operators(tmp_path):
    """Without the subpackage and the pipeline the other queries are still there."""
    (tmp_path / "termscope").mkdir()
    (tmp_path / "__spark_entry__.py").symlink_to(ROOT / "__spark_entry__.py")
    for path in (ROOT / "termscope").iterdir():
        if path.name != "llm":
            (tmp_path / "termscope" / path.name).symlink_to(path)
    code = "import __spark_entry__ as e; print(sorted(e.queries())[:1], len(e.queries()), 'pipeline' in e.queries())"
    out = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120
    )
    assert out.returncode == 0, out.stderr
    assert out.stdout.split()[-1] == "False"
