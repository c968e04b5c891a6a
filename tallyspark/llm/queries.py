"""The dealt queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chat, langid, license_scan, minhash, mixing, ns_clusters, quality_gam, quality_rules, repair, sharding, warc
from .common import written

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
SHARDS = 8
NEAR = 85  # per cent of the union that linked documents share
CONTROL_CASE = -7, "</s>[INST] ok [/INST]"  # a conversation that says nothing but control strings


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 8 shards by weighted draws down the region, rack and shard levels."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, its own notice's or inherited.

    A document's path follows from its columns: corpus / source / doc_id div 4096 / doc_id div 64 / name.  Every 64th is its
    folder's LICENSE, and every 4096th is, one level up, that of the folders below.
    """
    n = F.col("doc_id")
    top, folder = F.floor(n / 4096).cast("string"), F.floor(n / 64).cast("string")
    place = F.when(n % 4096 == 0, F.concat(top, F.lit("/LICENSE"))).when(n % 64 == 0, F.concat_ws("/", top, folder, F.lit("LICENSE"))).otherwise(
        F.concat(top, F.lit("/"), folder, F.lit("/"), n.cast("string"), F.lit(".txt")))
    files = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("/", F.lit("corpus"), F.coalesce("source", F.lit("unknown")), place).alias("path"), "text")
    return license_scan.licences(files)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, failed rules and verdict of every document under thresholds from sketches by language and source."""
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as ARC, converted to WARC with equal payloads stored once, and read back."""
    return warc.archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "date")


def op5_chat_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one of control strings, as token ids with a loss mask, read back from these as digests."""
    path, (odd, said) = public_tokenizers.path(BPE_RANKS), CONTROL_CASE
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    case = spark.createDataFrame([(odd, 0, "user", said), (odd, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_turns(turns.unionByName(case), path, public_tokenizers.PATTERN), path)


def op6_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document when sources are brought to their targets."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op7_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest embeddings of every hundredth one."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document's whole text, and the bytes that they decode to, as digests."""
    return round_trip(table(spark, sf_dir, "documents"))


def round_trip(docs: DataFrame) -> DataFrame:
    """Digests of the ids of each row's text and of the bytes that they decode to.  The ids are written before they are
    decoded: a lost executor costs a reread, and a task holds either an encoder or a decoder."""
    path = public_tokenizers.path(BPE_RANKS)
    ids = written(bpe.encode(docs, path, public_tokenizers.PATTERN, ["doc_id"]), "ids")
    return digests(bpe.decode(ids, path, ["doc_id"], packed="packed"))


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select("doc_id", (F.octet_length("packed") / 4).cast("long").alias("n_tokens"),
                          F.sha2("packed", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicates of every document."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), NEAR)


def op10_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by the additive model."""
    docs = table(spark, sf_dir, "documents")
    return quality_gam.score(docs, quality_gam.fit(docs, table(spark, sf_dir, "labels")))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by averaged subword embeddings."""
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op12_dawg_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of every conversation, damaged by its rows' checksums."""
    turns = repair.damage(table(spark, sf_dir, "conversations"))
    plans = repair.plan_repairs(turns)
    made = repair.digests(turns, plans).withColumnRenamed("conv_id", "__conv")
    return plans.join(made, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv")


def op13_ns_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every embedding after three rounds, its squared distance, the clusters' inertia and centroids."""
    found, centroids, _ = ns_clusters.cluster(table(spark, sf_dir, "embeddings"))
    return ns_clusters.with_inertia(found, centroids)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_shard_tree, op2_license_scan, op3_quality_rules, op4_arc_to_warc, op5_chat_tokens, op6_entropy_mix, op7_projection_forest, op8_byte_bpe,
    op9_minhash_near_dedup, op10_additive_quality, op11_language_id, op12_dawg_repair, op13_ns_clusters, pipeline)}



def _clusters_sql() -> str:
    """op13 in SQL: integers, starting vectors, then assignment and floored means round by round (ties: the smaller centroid)."""
    width, k, rounds = ns_clusters.WIDTH, ns_clusters.CLUSTERS, ns_clusters.ROUNDS
    ctes = [f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor({ns_clusters.SCALE} * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {width})""",
            f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY code, x) - 1 AS j, x AS c
  FROM (SELECT x, sha256('{ns_clusters.SEED}:' || CAST(vec_id AS VARCHAR)) AS code FROM kept ORDER BY code, x LIMIT {k}))"""]
    square = "list_sum(list_transform(list_zip(kept.x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    for t in range(rounds + 1):
        ctes.append(f"""a{t} AS MATERIALIZED (SELECT r, min_by(j, (d, j)) AS j, min(d) AS d FROM (SELECT r, j, CAST({square} AS BIGINT) AS d FROM kept, c{t}) GROUP BY r)""")
        if t < rounds:
            ctes.append(f"""m{t} AS MATERIALIZED (SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c
  FROM (SELECT j, i, sum(v) AS s, count(*) AS n FROM (SELECT j, generate_subscripts(x, 1) AS i, unnest(x) AS v FROM a{t} JOIN kept USING (r)) GROUP BY j, i) GROUP BY j)""")
            ctes.append(f"c{t + 1} AS MATERIALIZED (SELECT j, coalesce(m{t}.c, c{t}.c) AS c FROM c{t} LEFT JOIN m{t} USING (j))")
    return f"""WITH {", ".join(ctes)}
SELECT vec_id, CAST(j AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c{rounds}.c, ',')) AS centroid_sha256
  FROM a{rounds} JOIN kept USING (r) JOIN c{rounds} USING (j)"""


#: op4: the archives' round trip must give back what the pages say; of equal payloads of 1000 bytes or more the last page answers
_ARCHIVE_SQL = """WITH payload AS (SELECT page_id, encode(coalesce(html, '')) AS raw FROM pages),
said AS (SELECT page_id, CAST(octet_length(raw) AS BIGINT) AS payload_bytes, sha1(raw) AS payload_digest FROM payload),
seen AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS answer FROM said)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN answer = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN answer <> page_id THEN answer END AS refers_to, '2024-03-01T00:00:00Z' AS date FROM seen"""

ORACLE: dict[str, str] = {"op4_arc_to_warc": _ARCHIVE_SQL, "op13_ns_clusters": _clusters_sql()}
