"""DuckDB SQL of the operators that SQL can express: another form of each result, not of the method."""

_KEY = r"translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op2_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WINDOW same AS (PARTITION BY t)""",
    "op9_line_dedup": f"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM cut),
keyed AS (SELECT *, {_KEY} AS key FROM placed),
common AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
           GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.keeper AS gone FROM keyed k LEFT JOIN common c USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op13_phrases": r"""
WITH cut AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM cut),
totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM pieces GROUP BY lang),
grams AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, unnest(range(1, 6)) AS t(k)),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, any_value(w[i:i + k - 1]) AS w, count(*) AS f
      FROM grams GROUP BY ALL HAVING count(*) >= 100),
f2 AS (SELECT lang, phrase, any_value(w) AS w, any_value(k) AS k, sum(f) AS f FROM f GROUP BY lang, phrase),
inner_ AS (SELECT lang, phrase, max(f) AS longer FROM (
      SELECT lang, f, array_to_string(w[1:k - 1], ' ') AS phrase FROM f2 WHERE k > 2
      UNION ALL SELECT lang, f, array_to_string(w[2:k], ' ') FROM f2 WHERE k > 2) GROUP BY lang, phrase),
open_ AS (SELECT f2.* FROM f2 LEFT JOIN inner_ USING (lang, phrase) WHERE k > 1 AND (longer IS NULL OR 100 * longer < 100 * f)),
cuts AS (SELECT lang, phrase, w, k, f AS a, unnest(range(1, k)) AS c FROM open_),
scored AS (SELECT cuts.lang, cuts.phrase, a, l.f AS l, r.f AS r, n, c,
                  (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score
           FROM cuts JOIN f2 l ON l.lang = cuts.lang AND l.phrase = array_to_string(cuts.w[1:c], ' ')
           JOIN f2 r ON r.lang = cuts.lang AND r.phrase = array_to_string(cuts.w[c + 1:cuts.k], ' ')
           JOIN totals ON totals.lang = cuts.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM lowest)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000""",
}
