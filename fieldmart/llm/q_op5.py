from fieldmart.llm.common import table
from fieldmart.llm.quotes import chat


def op5_quotation_linking(spark, sf_dir):
    return chat(table(spark, sf_dir, "conversations"))


_NORM = r"trim(regexp_replace(lower({}), '[ \t\n\x0B\f\r]+', ' ', 'g'))"
SQL = rf"""
WITH m AS (SELECT row_number() OVER () AS id, conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
l AS (SELECT id, conv_id, turn, generate_subscripts(s, 1) AS pos, unnest(s) AS x FROM (SELECT *, regexp_split_to_array(text, '\r?\n') AS s FROM m)),
v AS (SELECT id, conv_id, turn, pos, len(regexp_replace(regexp_extract(x, '^((?:[ \t]*>)*)', 1), '[^>]', '', 'g')) AS level, regexp_replace(x, '^(?:[ \t]*>)+ ?', '') AS line FROM l),
b AS (SELECT id, trim(regexp_replace(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (level = 0), ''), '\n{{3,}}', chr(10) || chr(10), 'g')) AS body FROM v GROUP BY id),
r AS (SELECT *, pos - row_number() OVER (PARTITION BY id, level ORDER BY pos) AS run FROM v),
p AS (SELECT id, conv_id, turn, level, string_agg(line, ' ' ORDER BY pos) AS line FROM r WHERE level > 0 GROUP BY id, conv_id, turn, level, run),
k AS (SELECT conv_id, turn, {_NORM.format('line')} AS key FROM v WHERE level = 0 UNION ALL SELECT conv_id, turn, {_NORM.format('body')} FROM b JOIN m USING (id)),
o AS (SELECT conv_id, key, min(turn) AS said FROM k WHERE key <> '' GROUP BY ALL),
q AS (SELECT DISTINCT id, conv_id, turn, level, {_NORM.format('line')} AS key FROM (SELECT id, conv_id, turn, level, line FROM p UNION ALL SELECT id, conv_id, turn, level, line FROM v WHERE level > 0)),
a AS (SELECT id, arg_max(said, (-level) * 1000000 + said) AS answers, count(DISTINCT key) AS n_linked FROM q JOIN o USING (conv_id, key) WHERE said < turn GROUP BY id),
t AS (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM (SELECT DISTINCT conv_id, turn FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL)),
n AS (SELECT id, count(*) AS n_quotes FROM p WHERE {_NORM.format('line')} <> '' GROUP BY id)
SELECT conv_id, turn, role, coalesce(answers, before) AS reply_to, coalesce(n_quotes, 0)::BIGINT AS n_quotes, coalesce(n_linked, 0)::BIGINT AS n_linked, body,
       '<|' || coalesce(role, '') || '|>' || chr(10) || body || chr(10) AS formatted
FROM m JOIN b USING (id) LEFT JOIN a USING (id) LEFT JOIN n USING (id) LEFT JOIN t USING (conv_id, turn)
"""

QUERIES = [("op5_quotation_linking", op5_quotation_linking, SQL)]
