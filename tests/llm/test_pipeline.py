from __future__ import annotations

import re
import subprocess
import sys

import corpus_pipeline
from dialogeval.llm import decontaminate, jaccard, secrets, toxicity
from dialogeval.llm.queries import QUERIES


def test_stages_against_the_operators_row_by_row(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = toxicity.fit(docs, labels)
    left = texts.keys() - {r["doc_id"] for r in toxicity.score(docs, model).where("toxic").collect()}
    stages, df = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, sf_dir)
        if name != "mixing":
            assert out.columns == docs.columns
            df = spark.createDataFrame(out.collect(), docs.schema)
        stages[name] = out.collect()
    assert {r["doc_id"] for r in stages["toxicity"]} == left
    clean = docs.where(docs["doc_id"].isin(sorted(left)))
    left = {r["component_id"] for r in jaccard.jaccard_components(clean).collect()}
    assert {r["doc_id"] for r in stages["ngram_jaccard"]} == left
    found = decontaminate.decontaminate(docs, benchmark).where("contaminated").collect()
    left = left - {r["doc_id"] for r in found}
    assert {r["doc_id"] for r in stages["decontamination"]} == left == {r["doc_id"] for r in stages["secrets"]}
    spans = {r["doc_id"]: r["spans"] for r in secrets.scan_secrets(docs).collect()}
    for r in stages["secrets"]:
        assert (r["text"] == texts[r["doc_id"]]) == (spans[r["doc_id"]] == "") and r["n_chars"] == len(r["text"])
        assert not re.search("AKIA[A-Z0-9]{14}|[0-9a-f]{16}", r["text"])
    whole = sorted(map(tuple, QUERIES["pipeline"](spark, sf_dir).collect()))
    assert whole == sorted(map(tuple, stages["mixing"])) and {r[0] for r in whole} <= left


def test_the_rest_does_not_need_this_subpackage():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, *a):\n"
        "        if name == 'corpus_pipeline' or name.startswith('dialogeval.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "print(sum(q.startswith('op') and q[2].isdigit() for q in e.queries()), len(e.queries()) > 50)\n"
    )
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=corpus_pipeline.__file__.rsplit("/", 1)[0])
    assert done.stdout.split() == ["0", "True"], done.stderr
