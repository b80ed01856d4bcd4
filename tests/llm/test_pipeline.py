"""The pipeline's stages, and every query of the subpackage against SQL or for its shape."""

import pytest

import corpus_pipeline
from rdfweave.llm import common, minhash, pii, tiling, tokens
from rdfweave.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


def test_stages_follow_each_other(shared):
    source = common.table(shared, SF_DIR, "documents")
    docs, seen = source, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stage(stage(shared, docs, SF_DIR), name)
        seen[name] = docs
        if name != "packing":
            assert docs.columns == source.columns
    kept = {name: {r[0] for r in df.select("doc_id").distinct().collect()} for name, df in seen.items()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    assert all(kept[b] <= kept[a] for a, b in zip(names, names[1:]))
    assert kept["decontamination"] == kept["personal_data"] == kept["packing"]
    assert minhash.near_duplicates(shared, seen["near_duplicates"], 5).filter("NOT kept").count() == 0
    assert tiling.contaminated(shared, seen["decontamination"], common.table(shared, SF_DIR, "benchmark")).count() == 0
    assert pii.find(shared, seen["personal_data"]).filter("n_email + n_ip + n_card + n_phone > 0").count() == 0
    texts = dict(seen["personal_data"].select("doc_id", "text").collect())
    encoder = tokens.Encoder()
    sizes = {i: len(encoder.tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts.items()}
    assert dict(seen["packing"].groupBy("doc_id").sum("length").collect()) == sizes


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(shared, name):
    problem, _ = differences(shared, connect(SF_DIR), SF_DIR, QUERIES[name], ORACLES[name])
    assert problem is None


def test_odd_documents_pass_all_stages(shared, frame):
    from tests.llm.conftest import ODD

    docs = frame(ODD)
    for _, stage in corpus_pipeline.STAGES:
        docs = common.stage(stage(shared, docs, SF_DIR), "odd")
    assert docs.count() > 0
