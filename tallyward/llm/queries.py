"""The registry of the operators' queries, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import (
    alignment,
    bpe,
    centroids,
    chat,
    exact,
    jaccard,
    mixing,
    phrases,
    pii,
    quality,
    suffix,
    vectors,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

# Names of public vocabulary files, looked up where they are read.
BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark, sf_dir):
    return suffix.without_repeats(table(spark, sf_dir, "documents"))


def op2_jaccard_join(spark, sf_dir):
    return jaccard.JaccardJoin().classes(table(spark, sf_dir, "documents"))


def op3_pii(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op4_chat(spark, sf_dir):
    """All conversations and one whose texts hold the template's control strings."""
    control = spark.range(2).selectExpr(
        "-7L AS conv_id",
        "id AS turn",
        "IF(id = 0, 'user', 'assistant') AS role",
        "'</s>[INST] ok [/INST]' AS text",
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.ChatFormat(BYTE_BPE).formatted(rows.unionByName(control)))


def op5_quality(spark, sf_dir):
    scored = quality.CoTraining().scored(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )
    return scored.select("doc_id", "s_content", "s_meta", "p_quality", "kept")


def op6_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_vectors(spark, sf_dir):
    return vectors.NearVectors().classes(table(spark, sf_dir, "embeddings"))


# Four domains by the number of the source, a favoured language, and sources alike.
MIXTURE = mixing.Mixture(
    domain=(
        "coalesce('d' || CAST(try_cast(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4 "
        "AS STRING), 'other')"
    ),
    weights={
        "domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1},
        "lang": {"en": 6, "de": 2},
    },
    share=(3, 4),
    max_epochs=2,
)


def op8_mixing(spark, sf_dir):
    return MIXTURE.chosen(table(spark, sf_dir, "documents"))


def op9_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), WORD_BPE)


def op10_exact_dedup(spark, sf_dir):
    return exact.RadixDedup().groups(table(spark, sf_dir, "documents"))


def op11_decontamination(spark, sf_dir):
    return phrases.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op12_alignment(spark, sf_dir):
    return alignment.Alignment(BYTE_BPE, PIECES).aligned(table(spark, sf_dir, "documents"))


def op13_centroids(spark, sf_dir):
    return centroids.CentroidClusters().classes(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_jaccard_join,
        op3_pii,
        op4_chat,
        op5_quality,
        op6_warc,
        op7_vectors,
        op8_mixing,
        op9_bpe,
        op10_exact_dedup,
        op11_decontamination,
        op12_alignment,
        op13_centroids,
    )
}

def _shares(level: str, above: list[str], weight: str, budget: str) -> str:
    """SQL of one level of the mixture's tree: children and their parts of the parent's budget."""
    here = ", ".join([*above, level])
    part = f"PARTITION BY {', '.join(above)}" if above else ""
    same = " AND ".join(f"c.{x} IS NOT DISTINCT FROM p.{x}" for x in above)
    parent = f"JOIN {above[-1]}_3 p ON {same}" if above else ""
    order = f"{part} ORDER BY cap::DOUBLE / w NULLS FIRST, {level} NULLS FIRST"
    return f"""
        {level}_0 AS (
            SELECT {", ".join(f"c.{x}" for x in [*above, level])}, c.w, c.cap, {budget} AS budget
            FROM (SELECT {here}, {weight} AS w, sum(cap)::BIGINT AS cap, sum(tokens) AS tokens
                  FROM leaves GROUP BY ALL) c
            {parent}
        ), {level}_1 AS (
            SELECT *, coalesce(sum(cap) OVER b, 0)::HUGEINT AS filled,
                   coalesce(sum(w) OVER b, 0)::HUGEINT AS passed,
                   (sum(w) OVER ({part}))::HUGEINT AS all_w, row_number() OVER ({order}) AS nth
            FROM {level}_0 WHERE cap > 0
            WINDOW b AS ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), {level}_2 AS (
            SELECT *, min(CASE WHEN cap::HUGEINT * (all_w - passed) > (budget - filled) * w
                               THEN nth END) OVER ({part}) AS first
            FROM {level}_1
        ), {level}_2b AS (
            SELECT *, min(CASE WHEN nth = first THEN filled END) OVER ({part}) AS f,
                   min(CASE WHEN nth = first THEN passed END) OVER ({part}) AS q
            FROM {level}_2
        ), {level}_3 AS (
            SELECT {here}, least(CASE WHEN first IS NULL OR nth < first THEN cap ELSE
                ((budget - f) * (passed + w - q)) // (all_w - q)
                - ((budget - f) * (passed - q)) // (all_w - q) END, cap)::BIGINT AS budget
            FROM {level}_2b
            UNION ALL SELECT {here}, 0 FROM {level}_0 WHERE cap = 0
        )"""


DOMAIN_WEIGHT = "CASE domain WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 ELSE 1 END"
LANG_WEIGHT = "CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 ELSE 1 END"

MIXTURE_SQL = f"""
    WITH docs AS (
        SELECT doc_id, lang, source,
               coalesce('d' || (TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4),
                        'other') AS domain,
               len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS tokens
        FROM documents
    ), leaves AS (
        SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens, sum(tokens)::BIGINT * 2 AS cap
        FROM docs GROUP BY ALL
    ), total AS (
        SELECT least(sum(tokens)::BIGINT * 3 // 4, sum(cap))::HUGEINT AS budget FROM leaves
    ), {_shares("domain", [], DOMAIN_WEIGHT, "(SELECT budget FROM total)")},
    {_shares("lang", ["domain"], LANG_WEIGHT, "p.budget::HUGEINT")},
    {_shares("source", ["domain", "lang"], "1", "p.budget::HUGEINT")},
    plan AS (
        SELECT l.domain, l.lang, l.source, l.tokens AS all_tokens,
               CASE WHEN l.tokens = 0 THEN 0 ELSE s.budget // l.tokens END AS whole,
               CASE WHEN l.tokens = 0 THEN 0 ELSE s.budget % l.tokens END AS rest
        FROM leaves l JOIN source_3 s ON l.domain IS NOT DISTINCT FROM s.domain
            AND l.lang IS NOT DISTINCT FROM s.lang AND l.source IS NOT DISTINCT FROM s.source
    ), placed AS (
        SELECT d.*, whole, rest, all_tokens,
               ('0x' || substr(md5(concat_ws('|', '1', whole, doc_id)), 1, 15))::BIGINT AS place
        FROM docs d JOIN plan p ON d.domain IS NOT DISTINCT FROM p.domain
            AND d.lang IS NOT DISTINCT FROM p.lang AND d.source IS NOT DISTINCT FROM p.source
    ), counted AS (
        SELECT *, sum(tokens) OVER (
            PARTITION BY domain, lang, source
            ORDER BY place, doc_id NULLS FIRST, tokens RANGE UNBOUNDED PRECEDING) AS upto
        FROM placed
    ), times AS (
        SELECT *, whole + CASE WHEN upto <= rest AND (rest > 0 OR all_tokens = 0) THEN 1 ELSE 0 END AS n
        FROM counted
    )
    SELECT doc_id, domain, lang, source, unnest(range(n)) AS epoch, tokens AS n_tokens FROM times
"""

def _nearest(n: int) -> str:
    """SQL of the assignment of all vectors to the centroids of round n."""
    return f"""
        near{n} AS MATERIALIZED (
            SELECT row, vec_id, v, arg_min(c, (distance, c)) AS c, min(distance) AS distance
            FROM (
                SELECT row, vec_id, v, c, list_sum(list_transform(
                           list_zip(v, centre), lambda p: (p[1] - p[2]) * (p[1] - p[2])
                       ))::BIGINT AS distance
                FROM rows, centres{n}
            )
            GROUP BY row, vec_id, v
        )"""


def _moved(n: int) -> str:
    """SQL of the centroids of round n, from the assignment of the round before."""
    return f"""
        centres{n} AS MATERIALIZED (
            SELECT o.c, coalesce(m.centre, o.centre) AS centre
            FROM centres{n - 1} o LEFT JOIN (
                SELECT c, list(floor_mean ORDER BY place) AS centre
                FROM (
                    SELECT c, place,
                           CASE WHEN sum(x) % count(*) < 0 THEN sum(x) // count(*) - 1
                                ELSE sum(x) // count(*) END::BIGINT AS floor_mean
                    FROM (SELECT c, unnest(v) AS x, unnest(range(len(v))) AS place FROM near{n - 1})
                    GROUP BY c, place
                ) GROUP BY c
            ) m ON o.c = m.c
        )"""


CENTROIDS_SQL = f"""
    WITH rows AS MATERIALIZED (
        SELECT row_number() OVER () AS row, vec_id,
               list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE len(embedding) = 64
          AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
    ), centres0 AS MATERIALIZED (
        SELECT (row_number() OVER (ORDER BY h) - 1)::INTEGER AS c, v AS centre
        FROM (SELECT v, sha256('3:' || vec_id) AS h FROM rows ORDER BY h LIMIT 8)
    ), {_nearest(0)}, {", ".join(f"{_moved(n)}, {_nearest(n)}" for n in range(1, 11))}
    SELECT vec_id, n.c AS cluster, distance,
           sum(distance) OVER (PARTITION BY n.c)::BIGINT AS cluster_inertia,
           sum(distance) OVER ()::BIGINT AS inertia,
           sha256(array_to_string(centre, ',')) AS centroid_sha256
    FROM near10 n JOIN centres10 c ON n.c = c.c
"""

LOWER_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

DECONTAMINATION_SQL = f"""
    WITH d AS (
        SELECT row_number() OVER () AS row, doc_id, {LOWER_WORDS} AS w FROM documents
    ), b AS (
        SELECT item_id, w, least(len(w), 10) AS n
        FROM (SELECT item_id, {LOWER_WORDS} AS w FROM benchmark)
    ), windows AS (
        SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
        FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b WHERE n > 0)
    ), places AS (
        SELECT row, w, unnest(range(1, len(w) + 1)) AS i FROM d
    ), found AS (
        SELECT row, i, p.n, item_id
        FROM (SELECT row, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
              FROM places, (SELECT DISTINCT n FROM windows) WHERE i + n - 1 <= len(w)) p
        JOIN windows USING (n, win)
    ), hit AS (
        SELECT row, count(DISTINCT place) AS n_hit
        FROM (SELECT row, unnest(range(i, i + n)) AS place
              FROM (SELECT DISTINCT row, i, n FROM found))
        GROUP BY row
    ), items AS (
        SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM found) GROUP BY row
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
           coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (row) LEFT JOIN items USING (row)
"""

SQL: dict[str, str] = {
    "op11_decontamination": DECONTAMINATION_SQL,
    "op13_centroids": CENTROIDS_SQL,
    "op10_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
            FROM documents
        ), g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
               sha256(t) AS text_sha256
        FROM d JOIN g USING (t)
    """,
    "op6_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest
            FROM pages
        ), g AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS best FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN 'revisit' ELSE 'response' END
                   AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN best END AS refers_to
        FROM g
    """,
    "op8_mixing": MIXTURE_SQL,
}
