"""The dealt operators as driver queries, with the SQL to check them by where there is one."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorekit.llm.bpe import encode_documents
from scorekit.llm.chat import digest_conversations, format_turns, read_turns
from scorekit.llm.clusters import cluster
from scorekit.llm.common import table
from scorekit.llm.exact_dedup import exact_groups
from scorekit.llm.hard_negatives import mine_hard_negatives
from scorekit.llm.mixing import draw_copies
from scorekit.llm.near_dedup import near_groups
from scorekit.llm.neighbours import nearest
from scorekit.llm.quality import judge_quality
from scorekit.llm.secrets import KINDS, find_secrets, fit_random_strings
from scorekit.llm.toxicity import held_out, judge_toxicity
from scorekit.llm.url_filter import Rule, judge_urls
from scorekit.llm.warc import plan_records, read_archives, write_archives
from scorekit.sources.scratch import scratch_path

# The rules that the url query judges by.
URL_RULES = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]

# Fixed value: what both rows of the added conversation say.
TRICKY_TURN = "</s>[INST] ok [/INST]"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = judge_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "rejected",
    )


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame(
        [(-1, 0, "user", TRICKY_TURN), (-1, 1, "assistant", TRICKY_TURN)], turns.schema
    )
    return digest_conversations(read_turns(format_turns(turns.unionByName(tricky))))


OP2_SQL = rf"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations
        UNION ALL SELECT -1, 0, 'user', '{TRICKY_TURN}'
        UNION ALL SELECT -1, 1, 'assistant', '{TRICKY_TURN}'
    ),
    m AS (
        SELECT *, regexp_replace(text,
            '([\[<])(\\*)(INST\]|/INST\]|s>|/s>|\|(?:system|/system|role|text|end)\|>)',
            '\1\\\2\3', 'g') AS escaped,
            CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 21 END AS marks
        FROM t
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
            AS turns_sha256,
        coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
            FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
        sum(length(escaped) + marks)::BIGINT AS formatted_chars
    FROM m GROUP BY conv_id
"""


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP3_SQL = """
    WITH v AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    p AS (
        SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
    ),
    r AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT)
            AS rank
        FROM p
    )
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
    WITH d AS (
        SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
        FROM documents
    ),
    g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256
    FROM d JOIN g USING (h)
"""


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_secrets(docs, fit_random_strings(docs))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        place = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(place, ",")

    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_documents(table(spark, sf_dir, "documents"))
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = draw_copies(table(spark, sf_dir, "documents"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return drawn.select("doc_id", "size", "source_size", "target", taken)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = plan_records(table(spark, sf_dir, "pages"))
    archives = write_archives(records, scratch_path(spark, "archives"))
    return read_archives(archives, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP9_SQL = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, encode(coalesce(html, '')) AS b FROM pages),
    r AS (
        SELECT *, octet_length(b)::BIGINT AS n,
            max(page_id) OVER (PARTITION BY html) AS last_id
        FROM p
    )
    SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
        CASE WHEN n >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN n >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
    FROM r
"""


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP10_SQL = r"""
    WITH u AS (
        SELECT page_id,
            coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
            coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages
    ),
    r AS (
        SELECT *, CASE
            WHEN (host = 'example.net' OR suffix(host, '.example.net'))
                AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN (host = 'example.com' OR suffix(host, '.example.com'))
                AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/'
            END AS rule
        FROM u
    )
    SELECT page_id, host, path, rule,
        CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
    FROM r
"""


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents")).drop("lang")


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def _op12_sql(clusters: int = 40, rounds: int = 5, dimensions: int = 64) -> str:
    """Each round as a table of distances to all centroids. Division of integers drops the fraction,
    so the remainder is taken off first for a quotient rounded down."""

    def nearest(i: int) -> str:
        return f"""
        d{i} AS MATERIALIZED (
            SELECT v.vec_id, c.cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance
            FROM part v JOIN c{i} c ON v.place = c.place GROUP BY v.vec_id, c.cluster
        ),
        a{i} AS MATERIALIZED (
            SELECT vec_id, cluster, distance FROM d{i}
            QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1
        )"""

    steps = []
    for i in range(rounds):
        steps.append(f"""{nearest(i)},
        m{i} AS (
            SELECT a.cluster, v.place, sum(v.x)::BIGINT AS s, count(*)::BIGINT AS n
            FROM a{i} a JOIN part v ON a.vec_id = v.vec_id GROUP BY a.cluster, v.place
        ),
        c{i + 1} AS MATERIALIZED (
            SELECT c.cluster, c.place, CASE WHEN m.n IS NULL THEN c.x
                ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS x
            FROM c{i} c LEFT JOIN m{i} m ON c.cluster = m.cluster AND c.place = m.place
        ),""")
    return f"""
        WITH kept AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
            FROM embeddings WHERE len(embedding) = {dimensions}
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        part AS MATERIALIZED (SELECT vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS place FROM kept),
        first AS (
            SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster
            FROM kept
        ),
        c0 AS MATERIALIZED (
            SELECT f.cluster, v.place, v.x FROM first f JOIN part v ON f.vec_id = v.vec_id
            WHERE f.cluster < {clusters}
        ),
        {"".join(steps)}
        {nearest(rounds)},
        named AS (
            SELECT cluster, sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY place)) AS centroid_sha256
            FROM c{rounds} GROUP BY cluster
        )
        SELECT vec_id, a.cluster::INT AS cluster, distance,
            (sum(distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
            (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
        FROM a{rounds} a JOIN named USING (cluster)
    """


OP12_SQL = _op12_sql()


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings")
    return mine_hard_negatives(vectors, F.col("vec_id") % 50 == 0, label=shifted)


OP13_SQL = """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    s AS (
        SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
            list_inner_product(a.e, c.e)::BIGINT AS score
        FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0
    ),
    p AS (
        SELECT * FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    ),
    n AS (
        SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id,
            p.score AS positive_score, s.score AS negative_score,
            row_number() OVER (PARTITION BY p.anchor_id, p.vec_id
                ORDER BY s.score DESC, s.vec_id)::INT AS rank
        FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
        WHERE 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
    )
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
    FROM n WHERE rank <= 3
"""

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_toxicity": (op1_toxicity, None),
    "op2_chat": (op2_chat, OP2_SQL),
    "op3_neighbours": (op3_neighbours, OP3_SQL),
    "op4_exact_dedup": (op4_exact_dedup, OP4_SQL),
    "op5_secrets": (op5_secrets, None),
    "op6_bpe": (op6_bpe, None),
    "op7_near_dedup": (op7_near_dedup, None),
    "op8_mixing": (op8_mixing, None),
    "op9_warc": (op9_warc, OP9_SQL),
    "op10_url_filter": (op10_url_filter, OP10_SQL),
    "op11_quality": (op11_quality, None),
    "op12_clusters": (op12_clusters, OP12_SQL),
    "op13_hard_negatives": (op13_hard_negatives, OP13_SQL),
}
