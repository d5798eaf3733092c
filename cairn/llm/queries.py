"""The operators as checked queries, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.checks.registry import query, table
from cairn.llm import byte_pairs, centroids, decontamination, jaccard_join, languages, license_scans, line_dedup, lm_scoring, piece_agenda, prefix_trie, quality_classifier, quality_rules, sharding
from cairn.llm.staging import stage
from cairn.llm.texts import remainder


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def crc_table() -> list[int]:
    table = list(range(256))
    for _ in range(8):
        table = [(x >> 1) ^ (0xEDB88320 if x & 1 else 0) for x in table]
    return table


OP1 = f"""
WITH bytes AS (
    SELECT doc_id, source, coalesce(octet_length(encode(text)), 0) + 8 AS size,
        list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda b: CAST('0x' || b AS BIGINT)) AS b
    FROM documents
), rows_ AS (
    SELECT doc_id, source, size,
        xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda a, x: xor(a >> 8, {crc_table()}[(xor(a, x) & 255) + 1])), 4294967295) AS text_crc32,
        coalesce('=' || source, '') AS stratum
    FROM bytes
), drawn AS (
    SELECT *, CAST('0x' || substr(md5('1|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || text_crc32 || '|' || size), 1, 15) AS BIGINT) AS draw FROM rows_
), placed AS (
    SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY draw, doc_id, text_crc32, size) - 1
        + CAST('0x' || substr(md5('2|' || stratum), 1, 15) AS BIGINT) / 1152921504606846976.0::DOUBLE) / count(*) OVER (PARTITION BY stratum) AS place
    FROM drawn
), sequence_ AS (
    SELECT *, row_number() OVER (ORDER BY place, draw, doc_id, text_crc32, size) - 1 AS position, count(*) OVER () AS total FROM placed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
    CAST(position * 24 // total AS INTEGER) AS shard,
    CAST(position - ((position * 24 // total) * total + 23) // 24 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard, source
FROM sequence_
"""


@query(OP1)
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query()
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


@query()
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    field = quality_rules.fit_lines(documents, table(spark, sf_dir, "labels"))
    return quality_rules.quality_rules(documents, field)


@query()
def op4_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_pairs.encode_documents(table(spark, sf_dir, "documents"), vocabulary())


@query(license_scans.licenses_sql())
def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scans.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_sentences", *(F.array_join(name, ",").alias(name) for name in ("sentence_ids", "licenses")))


OP6 = r"""
WITH lines AS (
    SELECT doc_id, i, w[i] AS line,
        translate(regexp_replace(w[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents))
), owned AS (
    SELECT *, CASE WHEN length(key) >= 10 THEN min(doc_id) OVER (PARTITION BY key) ELSE doc_id END AS owner FROM lines
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE owner < doc_id) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE owner = doc_id), '')) AS kept_sha256
FROM owned GROUP BY doc_id
"""


@query(OP6)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    text = F.coalesce(F.col("row.text"), F.lit("")).cast("binary")
    return kept.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))


@query()
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


OP8 = r"""
WITH item_words AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), windows AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS win
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)
), sizes AS (
    SELECT DISTINCT n FROM windows
), doc_windows AS (
    SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, sizes WHERE len(w) >= n)
), found AS (
    SELECT d.doc_id, d.i, d.n, x.item_id FROM doc_windows d JOIN windows x ON d.win = x.win AND d.n = x.n
), hits AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM found))
    GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found)
    GROUP BY doc_id
)
SELECT doc_id, coalesce(CAST(len(w) AS BIGINT), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query(OP8)
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), passages=False)
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


@query()
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = stage(quality_classifier.features(table(spark, sf_dir, "documents")), "statistics")
    vectors = vectors.withColumn("held_out", remainder("doc_id", 4) == 2)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality_classifier.fit(vectors.where("not held_out").join(labels, "doc_id"))
    scored = quality_classifier.score_features(vectors, model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query()
def op10_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = languages.learn(documents.where(remainder("doc_id", 3) != 1))
    found = languages.identify(documents, model)
    return found.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "n_spans")


@query()
def op11_piece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_agenda.encode_documents(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def _clustering_sql(clusters: int = centroids.CLUSTERS, rounds: int = centroids.ROUNDS, size: int = centroids.SIZE) -> str:
    """Every distance of every round, in whole numbers."""
    near = """near{0} AS MATERIALIZED (
    SELECT vec_id, q, min(d * {1} + n) AS best FROM (
        SELECT vec_id, q, n, list_sum(list_transform(list_zip(q, c), lambda z: CAST((z[1] - z[2]) * (z[1] - z[2]) AS HUGEINT))) AS d
        FROM kept, centres{0})
    GROUP BY vec_id, q)"""
    moved = """sums{0} AS MATERIALIZED (
    SELECT n, i, sum(x) AS s, count(*) AS m
    FROM (SELECT best % {2} AS n, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM near{1}) GROUP BY n, i
), centres{0} AS MATERIALIZED (
    SELECT old.n, coalesce(new.c, old.c) AS c
    FROM centres{1} old LEFT JOIN (SELECT n, list(CAST((s - ((s % m) + m) % m) // m AS BIGINT) ORDER BY i) AS c FROM sums{0} GROUP BY n) new ON old.n = new.n)"""
    steps = [near.format(0, clusters)]
    for k in range(1, rounds + 1):
        steps += [moved.format(k, k - 1, clusters), near.format(k, clusters)]
    steps = ",\n".join(steps)
    return f"""WITH kept AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
    WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}
), centres0 AS MATERIALIZED (
    SELECT n, q AS c FROM (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), q) - 1 AS n, q FROM kept) WHERE n < {clusters}
), {steps}, found AS (SELECT vec_id, best % {clusters} AS n, best // {clusters} AS d FROM near{rounds})
SELECT vec_id, CAST(found.n AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY found.n) AS BIGINT) AS cluster_inertia,
    CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM found JOIN centres{rounds} ON found.n = centres{rounds}.n"""


@query(_clustering_sql())
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings")).drop("n_verified")


OP13 = f"""
WITH own AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS turn
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT c, c - c % 100 AS base, list(turn ORDER BY pos) AS l,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(CAST(c AS VARCHAR))), '..'), lambda b: CAST('0x' || b AS BIGINT))),
            lambda a, x: xor(a >> 8, {crc_table()}[(xor(a, x) & 255) + 1])), 4294967295) % 6 AS h
    FROM own GROUP BY c
), rebuilt AS (
    SELECT x.c, list_concat(coalesce(b.l[1 : x.h], []), x.l[x.h + 1 :]) AS l FROM convs x LEFT JOIN convs b ON b.c = x.base
), nodes AS MATERIALIZED (
    SELECT l[1 : d] AS p, d, min(c) AS conv, count(*) AS n, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len(l) = d), '') AS ends
    FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM rebuilt) GROUP BY 1, 2
), kids AS (
    SELECT p[1 : d - 1] AS p, count(*) AS k FROM nodes WHERE d > 0 GROUP BY 1
), weighed AS (
    SELECT nodes.p, d, CASE WHEN d > 0 THEN (n - 1) * length(nodes.p[d].t) ELSE 0 END AS saved, CASE WHEN k IS NULL THEN 1 ELSE 0 END AS leaf
    FROM nodes LEFT JOIN kids ON nodes.p = kids.p
), below AS (
    SELECT p[1 : e] AS p, sum(saved) AS saved, sum(leaf) AS leaves FROM (SELECT p, saved, leaf, unnest(range(0, d + 1)) AS e FROM weighed) GROUP BY 1
)
SELECT x.conv AS conv_id, x.d AS depth, up.conv AS parent_conv_id, x.n AS n_convs, coalesce(k, 0) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
    CAST(saved AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
FROM nodes x JOIN below ON x.p = below.p LEFT JOIN kids ON x.p = kids.p LEFT JOIN nodes up ON x.d > 0 AND up.d = x.d - 1 AND up.p = x.p[1 : x.d - 1]
"""


@query(OP13)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))
