"""DuckDB SQL for the queries that SQL can express over whole tables; the others are tested against brute force."""

from kpiloom.llm.quality_rules import STOP_WORDS

GAP = r"[\x20\x09-\x0D]+"
_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in sorted({x for ws in STOP_WORDS.values() for w in ws for x in (w, w.capitalize())}))

ORACLE = {
    "op4_quality_rules": f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{GAP}'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM t),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM again, (SELECT unnest(range(0, 8)) AS o) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words, len(l) AS n_lines,
             len(list_distinct(w)) AS n_distinct, len(list_filter(w, lambda x: x IN ({_STOP}))) AS n_stop
      FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2.0 AND 20.0 AND n_symbols / word_chars <= 0.04
       AND n_dup_lines / n_lines <= 0.5 AND (n_words < 50 OR (n_stop / n_words >= 0.02 AND n_distinct / n_words >= 0.15)) AS kept
FROM b""",
    "op5_ngram_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{GAP}'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (SELECT a, b FROM common JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT reach.d, link.b FROM reach JOIN link ON reach.r = link.a),
comp AS (SELECT d, min(r) AS component_id FROM reach GROUP BY d),
deg AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT documents.doc_id, coalesce(n.n, 0) AS n_shingles, comp.component_id, coalesce(deg.n_links, 0) AS n_links
FROM documents LEFT JOIN n ON documents.doc_id = n.doc_id JOIN comp ON documents.doc_id = comp.d LEFT JOIN deg ON documents.doc_id = deg.a""",
    "op7_phrase_automata": f"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{GAP}'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS f FROM win) WHERE f < doc_id),
gone AS (SELECT DISTINCT doc_id, i + o AS p FROM late, (SELECT unnest(range(0, 13)) AS o)),
each AS (SELECT doc_id, w[p] AS word, p FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM w)),
kept AS (SELECT each.doc_id, string_agg(word, ' ' ORDER BY each.p) AS k, count(*) AS n FROM each
         LEFT JOIN gone ON each.doc_id = gone.doc_id AND each.p = gone.p WHERE gone.p IS NULL GROUP BY each.doc_id)
SELECT w.doc_id, len(w.w) AS n_words, len(w.w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.k, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id""",
    "op12_collocations": r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (SELECT lang, k AS words, array_to_string(w[i:i + k - 1], ' ') AS phrase
          FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k))),
f AS (SELECT lang, words, phrase, count(*) AS f FROM grams GROUP BY lang, words, phrase),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
cand AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= 10),
cut AS (SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
        FROM (SELECT *, unnest(range(1, words)) AS k FROM cand) c
        JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
        JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:c.words], ' ')),
worst AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM cand WHERE words = 3),
held AS (SELECT lang, phrase, max(a) AS a FROM longer GROUP BY lang, phrase),
kept AS (SELECT worst.* FROM worst LEFT JOIN held ON worst.lang = held.lang AND worst.phrase = held.phrase
         WHERE held.a IS NULL OR 100 * held.a < 50 * worst.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n.n AS n, score::BIGINT AS score FROM ranked JOIN n ON ranked.lang = n.lang WHERE rank <= 2000""",
    "op13_exact_dedup": """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT *, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
             row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) AS place FROM t)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM g""",
}
