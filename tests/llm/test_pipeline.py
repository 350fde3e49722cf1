"""The corpus pipeline against its operators' brute-force forms."""
import pyarrow.parquet as pq

import corpus_pipeline as P
from conftest import SF_SMALL
from llm_fixtures import make  # noqa: F401
from tessera.llm import odd_minhash as OM
from tessera.llm.common import table


def test_stages_in_order(spark, tmp_path):
    docs = table(spark, SF_SMALL, "documents")
    cols, seen = docs.columns, []
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == cols
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append({r["doc_id"]: r["text"] for r in docs.collect()})
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "encoding"]
    before = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()}
    tox, near, dec, sec = seen
    assert set(tox) < set(before) and set(near) <= set(tox) and set(dec) <= set(near) and set(sec) == set(dec)
    sets = {i: OM.shingle_hashes(t, 5).tolist() for i, t in near.items()}
    ids = sorted(sets)
    for a, i in enumerate(ids):  # nothing left is a near copy of anything left
        x = set(sets[i])
        for j in ids[:a]:
            both = len(x.intersection(sets[j]))
            assert not both or 100 * both < 80 * (len(x) + len(sets[j]) - both)
    got = P.run(spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(sec)
    assert all(len(r["ids"]) == r["n_tokens"] for r in got)


def test_rows_without_text_stay(spark, make):
    docs = make([(1, None), (2, ""), (3, "a plain text of several words that nobody minds"), (None, None)]).select(
        "doc_id", "text", "lang", "source", "n_chars")
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.count() == 4
        docs = out
    assert P.STAGES[-1][1](spark, docs, SF_SMALL).count() == 4
