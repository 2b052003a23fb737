"""The same results in DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op4_rule_cascade": rf"""
        WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
        grams AS (
            SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
            FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) >= 3)
        ),
        twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
        repeated AS (
            SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
        ),
        lines AS (
            SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup,
                count_if(regexp_matches(line, '^[\x20\x09-\x0D]*[-*\x{{2022}}]')) AS bullets,
                count_if(regexp_matches(line, '(\.\.\.|\x{{2026}})[\x20\x09-\x0D]*\z')) AS open
            FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM t)
            WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
        ),
        m AS (
            SELECT doc_id, len(w)::BIGINT AS n_words,
                length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
                length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                coalesce(lines.n, 0)::BIGINT AS n_lines, coalesce(lines.dup, 0)::BIGINT AS n_dup_lines,
                coalesce(repeated.n, 0)::BIGINT AS n_repeat_words,
                len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\x{{80}}-\x{{10FFFF}}]'))) AS n_letter_words,
                coalesce(lines.bullets, 0) AS n_bullet_lines, coalesce(lines.open, 0) AS n_open_lines
            FROM t LEFT JOIN repeated USING (r) LEFT JOIN lines USING (r)
        )
        SELECT * EXCLUDE (n_letter_words, n_bullet_lines, n_open_lines), (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
            NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > 3 * n_words
                OR 10 * n_dup_lines > 5 * n_lines OR 2 * word_chars < 3 * n_words OR word_chars > 25 * n_words
                OR 10 * n_letter_words < 6 * n_words OR 10 * n_bullet_lines > 9 * n_lines
                OR 10 * n_open_lines > 3 * n_lines) AS kept
        FROM m
    """,
    "op5_poisson_mix": """
        WITH RECURSIVE sizes AS (
            SELECT source, sum(coalesce(length(text), 0))::BIGINT AS size FROM documents GROUP BY source
        ),
        rates AS (
            SELECT source, CASE WHEN size > 0 THEN
                (SELECT sum(size)::DOUBLE FROM sizes) * sqrt(size::DOUBLE) / (SELECT sum(sqrt(size::DOUBLE)) FROM sizes) / size
                ELSE 1.0 END AS rate
            FROM sizes
        ),
        chances AS (
            SELECT source, rate, 0 AS k, exp(-rate) AS chance, exp(-rate) AS below FROM rates
            UNION ALL
            SELECT source, rate, k + 1, chance * rate / (k + 1), below + chance * rate / (k + 1)
            FROM chances WHERE k < 100 + 20 * rate
        ),
        known AS (
            SELECT *, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS id FROM documents
        ),
        counted AS (
            SELECT known.*, (
                SELECT count(*) FROM chances
                WHERE chances.source IS NOT DISTINCT FROM known.source
                    AND chances.below <= (('0x' || substr(md5('20240501:' || known.id || ':1'), 1, 13))::BIGINT + 0.5) / 4503599627370496.0
            ) AS copies FROM known
        )
        SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy,
            ('0x' || substr(md5('order:20240501:' || id || ':' || copy), 1, 15))::BIGINT AS shuffle_key
        FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM counted)
    """,
    "op7_preferences": """
        WITH rows AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
        numbered AS (
            SELECT *, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST
            ) AS k FROM rows
        ),
        replies AS (SELECT conv_id, max(k) AS reply_k FROM numbered WHERE role = 'assistant' GROUP BY conv_id),
        kept AS (
            SELECT n.*, r.reply_k, '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS part
            FROM numbered n LEFT JOIN replies r USING (conv_id)
        ),
        last AS (SELECT conv_id, role, text, part FROM kept WHERE k = reply_k),
        prompts AS (
            SELECT k.conv_id, any_value(k.reply_k) AS reply_k,
                coalesce(string_agg(k.part, '' ORDER BY k.k) FILTER (WHERE k.reply_k IS NULL OR k.k < k.reply_k), '') AS before,
                count(*) FILTER (WHERE k.reply_k IS NULL OR k.k < k.reply_k) AS n_before
            FROM kept k GROUP BY k.conv_id
        ),
        both_ AS (
            SELECT p.conv_id, p.before, p.n_before, p.reply_k, own.part AS mine, own.text AS my_text,
                other.part AS theirs, other.text AS their_text,
                p.reply_k IS NOT NULL AND other.part IS NOT NULL AND own.text IS NOT DISTINCT FROM other.text AS same
            FROM prompts p LEFT JOIN last own ON own.conv_id = p.conv_id
            LEFT JOIN last other ON other.conv_id = xor(p.conv_id, 1)
        )
        SELECT conv_id, (n_before + CASE WHEN same THEN 1 ELSE 0 END)::INTEGER AS n_common,
            before || CASE WHEN same THEN mine ELSE '' END AS prompt,
            CASE WHEN reply_k IS NULL OR same THEN '' ELSE mine END AS chosen_completion,
            CASE WHEN reply_k IS NULL OR same OR theirs IS NULL THEN '' ELSE theirs END AS rejected_completion,
            CASE WHEN reply_k IS NULL OR same THEN '' ELSE '14-' || (length(mine) - 1) END AS chosen_spans,
            CASE WHEN reply_k IS NULL OR same OR theirs IS NULL THEN '' ELSE '14-' || (length(theirs) - 1) END AS rejected_spans
        FROM both_
    """,
    "op11_ranked_search": r"""
        WITH lowered AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
        ),
        asked AS (
            SELECT item_id, term, count(*) AS times FROM (
                SELECT item_id, unnest(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
            ) GROUP BY item_id, term
        ),
        totals AS (SELECT count(*) FILTER (WHERE len(t) > 0)::BIGINT AS n_all, sum(len(t))::BIGINT AS l_all FROM lowered),
        lengths AS (
            SELECT r, doc_id, 100 - 25 + (25 * len(t)::BIGINT * n_all) // greatest(l_all, 1) AS m FROM lowered, totals
        ),
        postings AS (
            SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM lowered)
            WHERE term IN (SELECT term FROM asked) GROUP BY r, term
        ),
        weights AS (
            SELECT term, floor(1000 * ln((2 * n_all + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM postings, totals GROUP BY term, n_all
        ),
        scores AS (
            SELECT item_id, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
            FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (r) GROUP BY item_id, r
        ),
        ranked AS (
            SELECT item_id, doc_id, score,
                row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
            FROM scores JOIN lengths USING (r) WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
    """,
    "op12_substring_dedup": rf"""
        WITH t AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
        passages AS (
            SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
            FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM t WHERE len(w) >= 13)
        ),
        least AS (SELECT g, min(doc_id) AS first_id FROM passages GROUP BY g),
        hits AS (
            SELECT r, i FROM passages JOIN least USING (g)
            WHERE first_id IS NOT NULL AND (doc_id IS NULL OR first_id < doc_id)
        ),
        gone AS (SELECT DISTINCT r, i + k AS i FROM hits, range(13) AS s(k)),
        left_ AS (
            SELECT e.r, string_agg(e.word, ' ' ORDER BY e.i) AS kept, count(*) AS n
            FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM t) e
            LEFT JOIN gone ON gone.r = e.r AND gone.i = e.i WHERE gone.r IS NULL GROUP BY e.r
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
            sha256(coalesce(kept, '')) AS kept_sha256
        FROM t LEFT JOIN left_ USING (r)
    """,
    "op13_infill": """
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n,
                sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
        ),
        drawn AS (
            SELECT doc_id, text, n, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS u1, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS u2,
                n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                    OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 AS plain,
                ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 AS spm
            FROM t
        ),
        cut AS (
            SELECT *, least(u1, u2) AS a, greatest(u1, u2) AS b, substr(text, 1, least(u1, u2)) AS prefix,
                substr(text, least(u1, u2) + 1, greatest(u1, u2) - least(u1, u2)) AS middle,
                substr(text, greatest(u1, u2) + 1) AS suffix
            FROM drawn
        )
        SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
            CASE WHEN NOT plain THEN a END AS prefix_chars, CASE WHEN NOT plain THEN b - a END AS middle_chars,
            sha256(CASE WHEN plain THEN text WHEN spm THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
            sha256(text) AS restored_sha256
        FROM cut
    """,
}
