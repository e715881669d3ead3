"""DuckDB SQL that gives the rows of the queries that SQL can express."""

from mirrorspan.llm.licenses import TEMPLATES

ORACLES: dict[str, str] = {}

ORACLES["op9_mix_sources"] = r"""
WITH docs AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS place,
         row_number() OVER () AS r
  FROM documents
), sized AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), weighed AS (
  SELECT *, list_extract([5, 2, 1],
           CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)) AS weight
  FROM sized
), ordered AS (
  SELECT *, 2 * source_size / weight AS ratio,
         coalesce(sum(2 * source_size) OVER w, 0) AS limit_before,
         coalesce(sum(weight) OVER w, 0) AS weight_before
  FROM weighed
  WINDOW w AS (ORDER BY 2 * source_size / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), leveled AS (
  SELECT *, (CAST(1.5 * (SELECT sum(source_size) FROM sized) AS DOUBLE) - CAST(limit_before AS DOUBLE))
            / CAST((SELECT sum(weight) FROM weighed) - weight_before AS DOUBLE) AS level
  FROM ordered
), targets AS (
  SELECT source, source_size,
         least(CAST(2 * source_size AS DOUBLE),
               coalesce((SELECT arg_min(level, limit_before + weight_before)
                         FROM leveled WHERE level <= ratio) * weight,
                        CAST(2 * source_size AS DOUBLE))) AS target
  FROM leveled
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM targets
), placed AS (
  SELECT d.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS part,
         sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id NULLS FIRST, size, r) AS upto
  FROM docs d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
), fitted AS (
  SELECT *, CASE WHEN size > 0 AND upto <= part THEN 1 ELSE 0 END AS extra FROM placed
), missing AS (
  SELECT source, max(part) - sum(extra * size) AS missing FROM fitted WHERE size > 0 GROUP BY source
), closing AS (
  SELECT r FROM (
    SELECT r, row_number() OVER (PARTITION BY f.source
             ORDER BY abs(size - missing), place, doc_id NULLS FIRST, size, r) AS nearest
    FROM fitted f JOIN missing m ON f.source IS NOT DISTINCT FROM m.source
    WHERE size > 0 AND extra = 0 AND abs(size - missing) < missing)
  WHERE nearest = 1
)
SELECT doc_id, size, source_size, target,
       CASE WHEN size > 0
            THEN (whole + CASE WHEN r IN (SELECT r FROM closing) THEN 1 ELSE extra END) * size
            ELSE 0 END AS taken
FROM fitted
"""


def _license_sql() -> str:
    def text(word: str) -> str:
        return "'" + word.replace("'", "''") + "'"

    rows = ",\n    ".join(
        f"({k}, {text(t.label)}, {t.base}, [{', '.join(map(text, t.words))}], {t.key_positions()})"
        for k, t in enumerate(TEMPLATES)
    )
    return rf"""
WITH templates(template, label, base, twords, keys) AS (VALUES
    {rows}
), docs AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), cells AS (
  SELECT template, base, unnest(twords) AS word, unnest(range(len(twords))) AS at FROM templates
), placed AS (
  SELECT r, unnest(words) AS word, unnest(range(len(words))) AS at FROM docs
), hits AS (
  SELECT * FROM placed WHERE word IN (SELECT word FROM cells)
), frequencies AS (
  SELECT word, count(DISTINCT r) AS n FROM hits GROUP BY word
), ranked AS (
  SELECT template, base, word,
         row_number() OVER (PARTITION BY template ORDER BY n, word) AS rank
  FROM (SELECT DISTINCT template, base, word FROM cells) JOIN frequencies USING (word)
), postings AS (
  SELECT cells.* FROM cells JOIN ranked USING (template, word)
  WHERE rank <= CASE WHEN ranked.base THEN 1 ELSE 2 END
), proposed AS (
  SELECT DISTINCT r, template, hits.at - postings.at AS start
  FROM hits JOIN postings USING (word) WHERE hits.at >= postings.at
), compared AS (
  SELECT p.r, t.label, t.base, p.start, len(t.twords) AS n,
         [CASE WHEN words[p.start + k + 1] = twords[k + 1] THEN 1 ELSE 0 END
          FOR k IN range(len(twords))] AS same, t.keys
  FROM proposed p JOIN templates t USING (template) JOIN docs d USING (r)
), found AS (
  SELECT r, label, base, start, list_sum(same) / n AS match FROM compared
  WHERE list_sum(same) / n >= 0.6 AND list_sum([same[k + 1] FOR k IN keys]) = len(keys)
)
SELECT doc_id, CAST(len(any_value(words)) AS BIGINT) AS n_words,
       count(*) FILTER (WHERE base) AS n_base,
       min(start) FILTER (WHERE base) AS first_word,
       max(start) FILTER (WHERE base) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
       coalesce(max(match), 0.0) AS score
FROM docs LEFT JOIN found USING (r)
GROUP BY r, doc_id
"""


ORACLES["op5_license_scan"] = _license_sql()


ORACLES["op4_dual_tree"] = """
WITH whole AS (
  SELECT vec_id, row_number() OVER () AS r,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, q.r AS query_row, c.vec_id, c.r,
         CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.r <> c.r AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id, r) AS INT) AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLES["op13_collocations"] = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (
  SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), placed AS (
  SELECT lang, words, unnest(range(1, CAST(len(words) AS BIGINT) + 1)) AS at FROM worded
), totals AS (
  SELECT lang, count(*) AS n FROM placed GROUP BY lang
), counts AS (
  SELECT lang, size, array_to_string(words[at : at + size - 1], ' ') AS phrase, count(*) AS a
  FROM placed, (SELECT unnest(range(1, 6)) AS size) AS sizes
  WHERE at + size - 1 <= len(words)
  GROUP BY lang, size, phrase HAVING count(*) >= 100
), listed AS (
  SELECT *, string_split(phrase, ' ') AS words FROM counts WHERE size > 1
), inner_parts AS (
  SELECT lang, size - 1 AS size, unnest([array_to_string(words[1 : size - 1], ' '),
         array_to_string(words[2 : size], ' ')]) AS phrase, a
  FROM listed WHERE size > 2
), longer AS (
  SELECT lang, size, phrase, max(a) AS most FROM inner_parts GROUP BY ALL
), kept AS (
  SELECT c.* FROM listed c LEFT JOIN longer o USING (lang, size, phrase)
  WHERE o.most IS NULL OR 100 * o.most < 100 * c.a
), cuts AS (
  SELECT *, unnest(range(1, size)) AS k FROM kept
), scored AS (
  SELECT c.lang, c.phrase, c.a, t.n, c.k, x.a AS l, y.a AS r,
         CAST(CAST(1000 AS HUGEINT) * c.a * t.n // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts c JOIN totals t USING (lang)
  JOIN counts x ON x.lang = c.lang AND x.size = c.k
    AND x.phrase = array_to_string(c.words[1 : c.k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.size = c.size - c.k
    AND y.phrase = array_to_string(c.words[c.k + 1 : c.size], ' ')
), worst AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM worst QUALIFY rank <= 2000
"""
