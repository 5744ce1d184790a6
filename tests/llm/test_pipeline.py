"""The pipeline and its stages against plain versions on a small fixture."""

from __future__ import annotations

import random
import re

import pytest

import __spark_entry__
import corpus_pipeline
from ledgerlark.llm import pii, toxicity
from ledgerlark.llm.queries import QUERIES
from ledgerlark.llm.url_filter import RULES
from tests.llm.conftest import sentence
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_near_dedup import brute as grouped
from tests.llm.test_pii import brute as personal
from tests.llm.test_pii import PLAIN, valid

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    items = [(i, sentence(rng, 25, 10**6)) for i in range(5)]
    texts = []
    for i in range(160):
        words = sentence(rng, rng.randrange(30, 120), 5000).split()
        if i % 4 == 1:
            for _ in range(8):
                words[rng.randrange(len(words))] = rng.choice(["idiot", "scum", "moron"])
        if i % 10 == 2:
            words[5:5] = items[i % 5][1].split()[3:18]
        if i % 7 == 3:
            words[3:3] = ["a.b@x.org", "+1 (988) 555-2485"]
        texts.append(" ".join(words))
    texts += [texts[0], texts[4] + " more", texts[8].upper(), "", None]
    docs = [(i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    docs.append(docs[0])
    base = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{base}/benchmark.parquet")
    labels = [(i, 1, int(i % 4 == 1)) for i in range(160)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return base, docs, items


def plain_redaction(text):
    """Base spans only; the fixture has no candidate beside them."""
    spans = sorted((m.start(), m.end(), k) for k in PLAIN for m in re.finditer(PLAIN[k], text) if valid(k, m.group()))
    out, at = "", 0
    for a, b, k in spans:
        if a >= at:
            out += text[at:a] + f"[{k}]"
        at = max(at, b)
    return out + text[at:]


def test_stages_take_effect(spark, folder):
    base, rows, items = folder
    docs = spark.read.parquet(f"{base}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_dedup", "decontamination", "pii", "packing"]

    kept = stages["toxicity"](spark, docs, base)
    assert kept.schema == docs.schema
    scores = {r.doc_id: r.predicted for r in toxicity.score_toxicity(
        docs, spark.read.parquet(f"{base}/labels.parquet")).collect()}
    left = [r for r in rows if not scores[r[0]]]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(left, key=str)
    assert not any(i % 4 == 1 for i, *_ in left if i < 160) and len(left) > 110

    alone = stages["near_dedup"](spark, kept, base)
    assert alone.schema == docs.schema
    groups = grouped([(r[0], r[1]) for r in left])
    want = {i for i, n, least in groups if i == least}
    assert sorted(r.doc_id for r in alone.collect()) == sorted(want)

    clean = stages["decontamination"](spark, alone, base)
    assert clean.schema == docs.schema
    before = [(r.doc_id, r.text) for r in alone.collect()]
    hit = {k[0] for k in contaminated(before, items) if k[5]}
    assert hit and {r.doc_id for r in clean.collect()} == {i for i, _ in before if i not in hit}

    safe = stages["pii"](spark, clean, base)
    assert safe.schema == docs.schema
    texts = {r.doc_id: r.text for r in clean.collect()}
    for r in safe.collect():
        old = texts[r.doc_id]
        assert r.text == (old if old is None else plain_redaction(old))
        assert r.n_chars == (None if old is None else len(r.text))
        assert personal(r.text)[1] == ""
    assert any("[email]" in (r.text or "") for r in safe.collect())

    packed = stages["packing"](spark, safe, base).collect()
    assert {r.doc_id for r in packed} == set(texts)
    run = corpus_pipeline.run(spark, base).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, run)) == sorted(map(key, packed))


def test_queries_are_registered():
    found = __spark_entry__.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in found) == 1
    assert found["pipeline"] is corpus_pipeline.run and set(QUERIES) <= set(found)
    assert "pipeline" not in __spark_entry__.oracle_sql()
    assert len(RULES) == 4 and pii.KINDS
