"""The registered queries give the columns and types that their contracts name, with nothing missing."""

import os

import pytest

from tidewatch.llm import queries

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

CONTRACTS = {
    "op1_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op2_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op3_syncmers": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op4_attention": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op5_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op6_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op7_quality": "doc_id bigint, rejected boolean",
    "op8_lattice": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op9_secrets": "doc_id bigint",
    "op10_bagminhash": "doc_id bigint",
    "op11_zone_maps": "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    "op12_whitening": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
    "op13_pieces": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
}


def test_every_query_has_a_contract():
    assert set(queries.all_queries()) == set(CONTRACTS)


@pytest.mark.parametrize("name", list(CONTRACTS))
def test_columns_and_types(spark, name):
    out = queries.all_queries()[name](spark, FOLDER)
    kinds = dict(out.dtypes)
    want = dict(part.split() for part in CONTRACTS[name].split(", "))
    assert {c: kinds.get(c) for c in want} == want
    assert out.count() > 0
