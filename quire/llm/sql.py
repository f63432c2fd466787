"""SQL twins for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

from quire.llm.canonical import canonical_sql

_P3 = r"""WITH c AS (SELECT chapter_id, body FROM chapters WHERE length(body) > 6000),
    stretches AS (SELECT chapter_id, unnest(regexp_split_to_array(body, '\n[^\S\n]*(?:\n[^\S\n]*)+')) AS s FROM c),
    long_stretches AS (SELECT * FROM stretches WHERE length(s) > 6000),
    sentences AS (SELECT chapter_id, unnest(string_split(regexp_replace(s, '([.!?।])\s+', '\1' || chr(1), 'g'), chr(1))) AS s FROM long_stretches),
    long_sentences AS (SELECT * FROM sentences WHERE length(s) > 6000),
    words AS (SELECT chapter_id, unnest(regexp_split_to_array(s, '\s+')) AS s FROM long_sentences)
    SELECT chapter_id, CASE WHEN chapter_id NOT IN (SELECT chapter_id FROM long_stretches) THEN 'paragraph' WHEN chapter_id NOT IN (SELECT chapter_id FROM long_sentences) THEN 'sentence'
        WHEN chapter_id NOT IN (SELECT chapter_id FROM words WHERE length(s) > 6000) THEN 'word' ELSE 'inside' END AS finest_cut FROM c"""


def oracle_sql() -> dict[str, str]:
    form = canonical_sql("text")
    return {
        "p3_found": _P3,
        "p4_text": f"SELECT extraction_id, {form} AS text FROM pages",
        "p4_classes": f"""WITH c AS (SELECT extraction_id, md5({form}) AS look, md5(text) AS exact FROM pages WHERE text <> ''),
            s AS (SELECT look, count(*) AS class_rows, count(DISTINCT exact) AS variants FROM c GROUP BY look)
            SELECT look, extraction_id, exact, class_rows, variants FROM c JOIN s USING (look)""",
        "p4_found": f"""WITH c AS (SELECT extraction_id, text, {form} AS look FROM pages WHERE text <> '')
            SELECT DISTINCT a.extraction_id AS extraction_id_a, b.extraction_id AS extraction_id_b FROM c a JOIN c b ON a.look = b.look AND a.extraction_id < b.extraction_id AND a.text <> b.text""",
    }
