"""The queries of the training-data operators."""

from __future__ import annotations

from . import fill_middle, importance
from .chunk_bpe import op9_chunk_bpe
from .extract import op2_block_labeller
from .fill_middle import op12_fill_middle
from .importance import op11_importance_resampling
from .media import op8_media_columns
from .near_dedup import op5_minhash_near_dedup
from .packing import op7_best_fit_packing
from .piece_bpe import op13_piece_bpe
from .quality import op3_quality_rules
from .secrets import op4_secret_field
from .sharding import op6_sampled_splitters
from .topk import op1_exact_topk
from .warc import op10_zip_warc

QUERIES = {
    "op1_exact_topk": op1_exact_topk,
    "op2_block_labeller": op2_block_labeller,
    "op3_quality_rules": op3_quality_rules,
    "op4_secret_field": op4_secret_field,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op6_sampled_splitters": op6_sampled_splitters,
    "op8_media_columns": op8_media_columns,
    "op9_chunk_bpe": op9_chunk_bpe,
    "op10_zip_warc": op10_zip_warc,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_fill_middle": op12_fill_middle,
    "op13_piece_bpe": op13_piece_bpe,
}
ORACLES: dict[str, str] = {
    "op1_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v))
        SELECT query_id, rank::INT AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        WHERE rank <= 5""",
    "op2_block_labeller": r"""
        WITH a AS (SELECT page_id, url, regexp_extract(html, '<article>(.*)</article>', 1, 's') AS h FROM pages),
        b AS (SELECT page_id, url, list_transform(string_split_regex(replace(h, '<br>', ' '), '</?(?:p|h1)>'), lambda x: regexp_replace(x, '<[^>]*>', '', 'g')) AS parts FROM a),
        c AS (SELECT page_id, url, list_transform(parts, lambda x: regexp_replace(replace(replace(replace(x, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g')) AS parts FROM b),
        d AS (SELECT page_id, url, list_filter(list_transform(parts, lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '') AS parts FROM c)
        SELECT page_id, url, coalesce(array_to_string(parts, chr(10)), '') AS text, length(coalesce(array_to_string(parts, chr(10)), '')) AS n_chars FROM d""",
    "op5_minhash_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle FROM w),
        n AS (SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n_shingles + y.n_shingles - k)),
        edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (SELECT a AS doc_id, b AS other FROM edges UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.other),
        c AS (SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id)
        SELECT doc_id, coalesce(n_shingles, 0) AS n_shingles, least(doc_id, coalesce(least, doc_id)) AS component_id, doc_id = least(doc_id, coalesce(least, doc_id)) AS kept
        FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)""",
    "op10_zip_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
        c AS (SELECT page_id, html, n, max(page_id) OVER (PARTITION BY html) AS last FROM p)
        SELECT page_id, n::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
        FROM c""",
    "op11_importance_resampling": importance.ORACLE_SQL,
    "op12_fill_middle": fill_middle.ORACLE_SQL,
}
