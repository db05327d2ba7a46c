import re
from collections import Counter

import __spark_entry__ as E
import corpus_pipeline as P
from llm_frames import components
from test_llm_cuckoo import squeezed
from test_llm_mixing import expected
from test_llm_tokens import library  # noqa: F401
from tipscope.llm import quality
from tipscope.llm.tables import table

SF001 = "/root/testdata/sf0.001"


def test_stages_and_registration():
    assert [name for name, _ in P.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "mix_sources", "pack"]
    names = set(E.queries())
    for n in range(1, 11):
        assert len([x for x in names if re.match(rf"op{n}_", x)]) == 1
    assert "pipeline" in names


def test_run_against_brute_force(spark, library):  # noqa: F811
    docs = table(spark, SF001, "documents")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    good = {r.doc_id for r in quality.quality_report(docs).where("kept").collect()}
    rows = [r for r in rows if r[0] in good]
    best = {}
    for i, t, s in rows:
        best[squeezed(t)] = min(best.get(squeezed(t), (1, 0)), (-len(t), i))
    rows = [r for r in rows if best[squeezed(r[1])][1] == r[0]]
    place = components({i: t for i, t, _ in rows}, 5, 80)
    rows = [r for r in rows if place[r[0]] == r[0]]
    copies = Counter()
    for (k, _), n in expected(rows).items():
        copies[rows[k][0]] += n
    got = P.run(spark, SF001).collect()
    tokens = Counter()
    for r in got:
        tokens[r.doc_id] += r.length
    text = {i: t for i, t, _ in rows}
    from tipscope.llm.pieces import vocabulary_path

    path = vocabulary_path("word_bpe_49k.json")
    assert tokens == Counter({i: n * (len(library(path, text[i])) + 1) for i, n in copies.items()})


def test_every_stage_takes_an_empty_table(spark):
    docs = table(spark, SF001, "documents").limit(0)
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF001)
        assert out.count() == 0, name
        assert name == "pack" or out.columns == docs.columns
