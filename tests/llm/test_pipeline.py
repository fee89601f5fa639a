import re
import subprocess
import sys

import corpus_pipeline
from claimsieve.llm import exact_dedup, mixing, quality_classifier, simhash
from claimsieve.sources import tables

SMALL = "/root/testdata/sf0.001"
BLANKS = re.compile(r"[\x20\x09-\x0D]+")


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    after = [docs]
    for name, stage in corpus_pipeline.STAGES:
        after.append(tables.stage(stage(spark, after[-1], SMALL), "test"))
    for step in after[1:-1]:
        assert step.columns == docs.columns
    raw, good, exact, near, mixed, encoded = after
    kept = {r.doc_id for r in quality_classifier.classify(raw, labels).where("kept").collect()}
    assert sorted(r.doc_id for r in good.collect()) == sorted(kept)
    solid = [BLANKS.sub("", r.text) for r in good.collect()]
    assert sorted(BLANKS.sub("", r.text) for r in exact.collect()) == sorted(set(solid))
    roots = {r.component_id for r in simhash.near_duplicates(exact).collect()}
    assert sorted(r.doc_id for r in near.collect()) == sorted(roots)
    planned = {r.doc_id: r.repeats for r in mixing.plan(near).collect() if r.repeats}
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == planned
    assert encoded.count() == mixed.count() and encoded.where("not round_trip").isEmpty()
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).select("doc_id", "n_tokens").collect())) == sorted(
        map(tuple, encoded.select("doc_id", "n_tokens").collect())
    )
    assert exact_dedup.exact_groups(exact).where("group_size > 1").isEmpty()


def test_encoding_holds_one_python_worker_a_task(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(50)
    plan = corpus_pipeline.encoded(spark, docs, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_the_rest_does_without_these_modules():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('claimsieve.llm') or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'silver_claims' in e.queries() and not any(q.startswith('op') for q in e.queries())\n"
        "assert 'pipeline' not in e.queries() and not any(q.startswith('op') for q in e.oracle_sql())\n"
    )
    folder = corpus_pipeline.__file__.rpartition("/")[0]
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
