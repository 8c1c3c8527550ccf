"""The registered queries and the pipeline at sf0.001, against SQL or brute force."""

import os
import re
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import compare  # noqa: E402
import corpus  # noqa: E402
from __spark_entry__ import oracle_sql, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    names = [n for n in queries() if n.startswith("op")]
    numbers = sorted(int(n[2:].split("_")[0]) for n in names if n[2:].split("_")[0].isdigit())
    assert numbers == list(range(1, 14))
    assert "pipeline" in queries()


@pytest.mark.parametrize("name", sorted(n for n in oracle_sql() if re.match(r"op\d+_", n)))
def test_matches_sql(spark, name):
    con = compare.duck(SF)
    sql = oracle_sql()[name]
    df = queries()[name](spark, SF)
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    assert compare.digest(df.columns, [tuple(r) for r in df.collect()])[0] == compare.digest(cols, cur.fetchall())[0]


COLUMNS = {
    1: {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
        "sequence_id": "bigint", "offset": "bigint"},
    2: {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint",
        "base_labels": "string", "labels": "string", "score": "double"},
    4: {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    5: {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    6: {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    7: {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint",
        "base_sha256": "string", "spans": "string"},
    8: {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint",
        "grown_shard": "int"},
    9: {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    10: {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    11: {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    12: {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"},
    13: {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"},
}


@pytest.mark.parametrize("number", COLUMNS)
def test_contract_columns(spark, number):
    name = next(n for n in queries() if n.startswith(f"op{number}_"))
    df = queries()[name](spark, SF)
    assert COLUMNS[number].items() <= dict(df.dtypes).items()


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted(tuple(r) for r in docs.collect())
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    seen, unique = set(), []
    for r in rows:
        if corpus.blanks(r[1]) not in seen:
            seen.add(corpus.blanks(r[1]))
            unique.append(r)
    root, _ = corpus.jaccard_components(unique)
    near = [r for i, (k, r) in enumerate(zip(root, unique)) if k == i]
    out = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, out, SF), "test")
        kept[name] = out
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
    assert sorted(map(tuple, kept["n-gram Jaccard join"].collect())) == near
    mixed = [tuple(r) for r in kept["mixing to target weights"].collect()]
    assert set(mixed) == set(near)
    n, least = corpus.check_packing(out.collect(), [(r[0], r[1]) for r in mixed])
    assert n <= least + 2
    assert queries()["pipeline"](spark, SF).count() == out.count()
