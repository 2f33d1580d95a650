"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (
    attention_lm,
    bagminhash,
    bpe,
    lattice,
    packing,
    pieces,
    quality,
    secret_scans,
    sharding,
    syncmers,
    token_counts,
    whitening,
    zone_maps,
)
from tidewatch.llm.common import documents
from tidewatch.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


#: Shards that the documents are taken to lie in before, by source and language.
OLD_SHARDS = 12


def op1_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """All documents from 12 shards by source and language to 16 shards of equal bytes."""
    old = F.pmod(F.xxhash64("source", "lang"), F.lit(OLD_SHARDS))
    return sharding.shard_documents(documents(spark, sf), old).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Every text encoded and decoded again."""
    return bpe.encode_decode(documents(spark, sf), public_tokenizers.path("byte_bpe_50k.json"))


def op3_syncmers(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of every text and its edited text."""
    return syncmers.fingerprints(documents(spark, sf))


def op4_attention(spark: SparkSession, sf: str) -> DataFrame:
    """Every text scored under the attention model and under plain counts."""
    return attention_lm.score_documents(documents(spark, sf), public_tokenizers.path("byte_bpe_50k.json"))


def op5_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents end to end in sequences of 2048 ids."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.piece_digests(packing.pack_documents(documents(spark, sf), path))


def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes and tokens of every text."""
    return token_counts.count_tokens(documents(spark, sf), public_tokenizers.path("word_bpe_49k.json"))


def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its evidence, the rates of its host and path, and the decision.

    The source of a document is its host, the language under a source its path.
    """
    docs, labels = documents(spark, sf), read_table(spark, sf, "labels")
    model, rows = quality.fit(docs, labels, F.col("source"), F.col("lang"))
    return quality.judged(rows, model).select(
        "doc_id", "host", "path", "evidence", "host_rate", "path_rate", "quality_prob", "rejected"
    )


def op8_lattice(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector with its number of links at cosine 0.93 and its component."""
    return lattice.near_vectors(read_table(spark, sf, "embeddings"))


def op9_secrets(spark: SparkSession, sf: str) -> DataFrame:
    """Every candidate of every text with the score of the forest."""
    return secret_scans.scan(documents(spark, sf), F.col("source")).drop("text_key")


def op10_bagminhash(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its class of equal texts, its group of near-duplicates and whether it stays."""
    return bagminhash.groups(documents(spark, sf)).drop("node")


def op11_zone_maps(spark: SparkSession, sf: str) -> DataFrame:
    """Every usable vector with the nearest of eight centroids after ten rounds."""
    return zone_maps.cluster(read_table(spark, sf, "embeddings"))


def op12_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """Every usable vector with its squared deviation and its whitened components up to 32."""
    rows = whitening.whiten(read_table(spark, sf, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").cast("bigint"))


def op13_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """Every text encoded and decoded again."""
    return pieces.digests(pieces.encode_decode(documents(spark, sf), public_tokenizers.path("piece_bpe_32k.model")))


QUERIES: list[Query] = [
    op1_sharding, op2_bpe, op3_syncmers, op4_attention, op5_packing, op6_token_counts, op7_quality, op8_lattice,
    op9_secrets, op10_bagminhash, op11_zone_maps, op12_whitening, op13_pieces,
]


def all_queries() -> dict[str, Query]:
    def in_utc(query: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return query(spark, sf)

        return run

    return {q.__name__: in_utc(q) for q in QUERIES}


def _clustered(k: int = 8, rounds: int = 10) -> str:
    """The rounds of op11_zone_maps written out one after the other."""
    dist = "list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(x, c)])"
    near = f"SELECT row, vec_id, x, min((d, j)) AS best FROM (SELECT row, vec_id, x, j, {dist} AS d FROM v CROSS JOIN c{{r}}) GROUP BY ALL"
    parts = [
        """usable AS (SELECT vec_id, [CAST(e AS DOUBLE) FOR e IN embedding] AS e FROM embeddings
  WHERE len(embedding) = 64 AND len([e FOR e IN embedding IF e IS NOT NULL AND isfinite(e)]) = 64)""",
        """v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id,
  [CAST(floor(1024 * c) AS BIGINT) FOR c IN e] AS x FROM usable)""",
        f"""c0 AS MATERIALIZED (SELECT place - 1 AS j, x AS c FROM (
  SELECT x, row_number() OVER (ORDER BY sha256('3:' || vec_id)) AS place FROM v) WHERE place <= {k})""",
    ]
    for n in range(rounds):
        parts += [
            f"a{n} AS MATERIALIZED ({near.format(r=n)})",
            f"""m{n} AS MATERIALIZED (SELECT j, list(m ORDER BY i) AS c FROM (
  SELECT best[2] AS j, i, CAST((sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
  FROM a{n}, range(1, 65) AS g(i) GROUP BY 1, 2) GROUP BY j)""",
            f"c{n + 1} AS MATERIALIZED (SELECT j, coalesce(m{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN m{n} USING (j))",
        ]
    parts.append(f"a{rounds} AS MATERIALIZED ({near.format(r=rounds)})")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(best[2] AS INTEGER) AS cluster, CAST(best[1] AS BIGINT) AS distance,
  CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia, CAST(sum(best[1]) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON j = best[2]"""


def all_sql() -> dict[str, str]:
    """Counterparts of the operators that SQL can express; the others are tested against brute force."""
    return {"op11_zone_maps": _clustered()}
