"""The Column rules once more in DuckDB's SQL, for the oracles.  Patterns and
character sets are spelled here from the rules, not taken from the code."""

from __future__ import annotations

# white space and line ends of Python strings, by code point
WS_CLASS = r"[\x09-\x0d\x1c-\x20\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}-\x{2029}\x{202f}\x{205f}\x{3000}]"
STRIP_WS = "^" + WS_CLASS + "+|" + WS_CLASS + "+$"
LINE_BREAK = r"(?:\x0d\x0a|[\x0a-\x0d\x1c-\x1e\x{0085}\x{2028}\x{2029}])"
BOXED = r"\\boxed[{]([^}]*)[}]"
ANSWER_MARK = "(?:A|a)nswer" + WS_CLASS + "*(?::|-)" + WS_CLASS + r"*([^\x0a]*)"
DOUBLE_BACKSLASH = r"\\{2}"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def pystrip(e: str) -> str:
    return f"regexp_replace({e}, {lit(STRIP_WS)}, '', 'g')"


def strip_chars(e: str, chars: str) -> str:
    cls = "[" + "".join("\\" + ch if ch in "\\]^-[" else ch for ch in chars) + "]"
    return f"regexp_replace({e}, {lit(r'\A' + cls + '+|' + cls + r'+\z')}, '', 'g')"


def collapse_ws(e: str, repl: str = " ") -> str:
    return f"regexp_replace({e}, {lit(WS_CLASS + '+')}, {lit(repl)}, 'g')"


def last_line(e: str) -> str:
    trimmed = f"regexp_replace({e}, {lit(LINE_BREAK + r'\z')}, '')"
    return f"list_extract(string_split_regex({trimmed}, {lit(LINE_BREAK)}), -1)"


def extract_math_answer(e: str) -> str:
    t = pystrip(e)
    cand = (f"CASE WHEN regexp_matches({t}, {lit(BOXED)}) THEN regexp_extract({t}, {lit(BOXED)}, 1) "
            f"ELSE {last_line(t)} END")
    cand = f"regexp_replace({cand}, {lit(DOUBLE_BACKSLASH)}, '', 'g')"
    cand = collapse_ws(cand, " ")
    return f"coalesce({strip_chars(cand, ' .')}, '')"


def normalize_numeric_answer(e: str) -> str:
    t = pystrip(e)
    s = (f"CASE WHEN regexp_matches({t}, {lit(ANSWER_MARK)}) "
         f"THEN regexp_extract({t}, {lit(ANSWER_MARK)}, 1) ELSE {t} END")
    s = f"replace({s}, ',', '')"
    s = f"split_part({s}, chr(10), 1)"
    return f"coalesce({strip_chars(s, ' .')}, '')"


def normalize_for_dataset(ds: str, e: str) -> str:
    return (f"CASE WHEN lower({ds}) = 'math' THEN {extract_math_answer(e)} "
            f"WHEN lower({ds}) = 'gsm8k' THEN {normalize_numeric_answer(e)} "
            f"ELSE error('no grader for dataset ' || {ds}) END")


# --- derived views (FIXTURES.md §3), as CTE bodies --------------------------

_PLAIN_PRED = """
       CASE o_orderkey % 6
         WHEN 0 THEN concat('so ', chr(92), 'boxed{', c, '} done')
         WHEN 1 THEN concat('Answer: ', c, '.')
         WHEN 2 THEN concat('step', chr(10), c, '  .')
         WHEN 3 THEN concat('1,', c, chr(10), 'tail')
         WHEN 4 THEN concat(c, chr(10), 'unsure')
         ELSE concat('answer - ', chr(10), CAST(o_custkey + 1 AS VARCHAR)) END"""
FX_PRED = rf"""
SELECT o_orderkey AS sample_id,
       CASE WHEN o_orderkey % 2 = 0 THEN 'math' ELSE 'gsm8k' END AS dataset,
       CAST(substr(o_orderpriority, 1, 1) AS INT) AS level,
       CASE WHEN o_orderkey % 5 <> 4 THEN {_PLAIN_PRED}
         ELSE CASE (o_orderkey // 5) % 14
         WHEN 0 THEN 'so \boxed{{\frac{{' || c || '}}{{2}}}}' WHEN 1 THEN 'Answer: ' || c || '.5 km' WHEN 2 THEN ''
         WHEN 3 THEN 'Answer: $1,' || c WHEN 4 THEN '\boxed{{' || c || '\frac{{1}}{{2}}}}' WHEN 5 THEN '+' || c WHEN 6 THEN '.5'
         WHEN 7 THEN 'The answer is dog' WHEN 9 THEN 'Answer: ' || c || '\%' WHEN 10 THEN 'Answer: ' || c || ' 1/2'
         WHEN 11 THEN '\boxed{{\text{{' || c || '}}}}' WHEN 12 THEN '  ' WHEN 13 THEN '\boxed{{\frac{{1}}{{2}}}}' END END AS prediction,
       CASE WHEN o_orderkey % 5 <> 4 THEN CASE o_orderkey % 6 WHEN 3 THEN 'Answer: 1' || c ELSE c END
         ELSE CASE (o_orderkey // 5) % 14
         WHEN 0 THEN c || '/2' WHEN 1 THEN c || '.5' WHEN 3 THEN '1' || c WHEN 4 THEN c || '.5' WHEN 6 THEN '0.5' WHEN 7 THEN 'do'
         WHEN 10 THEN c || '.5' WHEN 13 THEN '\boxed{{\frac{{1}}{{3}}}}' ELSE c END END AS reference
FROM (SELECT *, CAST(o_custkey AS VARCHAR) AS c FROM orders)
"""

FX_QA = """
SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'
"""

FX_GRADED = """
SELECT o_orderkey AS sample_id, CAST(substr(o_orderpriority, 1, 1) AS INT) AS level,
       CASE WHEN o_orderkey % 7 = 0 THEN '  '
            ELSE concat('Order ', CAST(o_orderkey AS VARCHAR), ' status ', o_orderstatus) END AS question
FROM orders
"""

FX_ATTN = """
SELECT CAST(floor(vec_id / 24) AS INT) AS sample, CAST(floor(vec_id / 24) AS INT) % 5 + 1 AS level,
       CAST(floor(vec_id / 4) AS INT) % 6 AS layer, CAST(vec_id % 4 AS INT) AS head,
       CAST(i - 1 AS INT) AS pos, CAST(abs(embedding[i]) AS DOUBLE) AS weight
FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
"""

FX_TRAINLOG = """
SELECT user_id AS run_id, event_id AS global_step,
       CASE WHEN event_type = 'error' THEN NULL ELSE value END AS eval_loss, ts
FROM events
"""


def with_views(body: str, **views: str) -> str:
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in views.items())
    return f"WITH {ctes}\n{body}" if views else body

FX_RECORDS = """
SELECT CASE WHEN sample_id % 2 = 0 THEN 'math' ELSE 'gsm8k' END AS dataset, sample_id,
  CASE WHEN sample_id % 13 = 0 THEN concat('{"question": "', question, '", ')
  ELSE CASE sample_id % 8
    WHEN 0 THEN concat('{"problem": "  ", "question": "', question, '", "level": ', CAST(level AS VARCHAR), '}')
    WHEN 1 THEN concat('{"query": {"problem": "', question, '"}, "level": "Level ', CAST(level AS VARCHAR), '"}')
    WHEN 2 THEN concat('{"prompt": "', question, '", "level": " ', CAST(level AS VARCHAR), ' "}')
    WHEN 3 THEN concat('{"problem": 7, "input": "', question, '", "level": ', CAST(level AS VARCHAR), '.7}')
    WHEN 4 THEN concat('{"instruction": "", "query": "", "level": "', CAST(level AS VARCHAR), '.0"}')
    WHEN 5 THEN concat('{"question": null, "query": {"question": "', question, '"}, "level": ', CAST(level AS VARCHAR), '}')
    WHEN 6 THEN concat('{"question": "', question, '", "level": ', CAST(level + 1 AS VARCHAR), '}')
    ELSE concat('{"question": "', question, '", "level": ', CAST(level - 1 AS VARCHAR), '}') END
  END AS raw
FROM fx_graded
"""


def json_string(raw: str, path: str) -> str:
    return (f"CASE WHEN json_valid({raw}) AND json_type({raw}, {lit(path)}) = 'VARCHAR' "
            f"THEN json_extract_string({raw}, {lit(path)}) END")


def get_query(raw: str) -> str:
    from ..operators.extraction import NESTED_QUERY_FIELDS, QUERY_FIELDS
    cands = [f"$.{k}" for k in QUERY_FIELDS] + [f"$.query.{k}" for k in NESTED_QUERY_FIELDS]
    parts = []
    for p in cands:
        s = json_string(raw, p)
        parts.append(f"CASE WHEN {pystrip(s)} <> '' THEN {s} END")
    return "coalesce(" + ", ".join(parts) + ")"


def parse_level(raw: str) -> str:
    from ..operators.extraction import INT_TEXT
    p = "'$.level'"
    s = pystrip(f"json_extract_string({raw}, {p})")
    return (f"CASE WHEN NOT json_valid({raw}) THEN NULL "
            f"WHEN json_type({raw}, {p}) = 'VARCHAR' THEN CASE WHEN regexp_matches({s}, {lit(INT_TEXT)}) "
            f"THEN TRY_CAST(replace({s}, '_', '') AS BIGINT) END "
            f"WHEN json_type({raw}, {p}) = 'BOOLEAN' THEN CASE WHEN CAST(json_extract({raw}, {p}) AS BOOLEAN) THEN 1 ELSE 0 END "
            f"WHEN json_type({raw}, {p}) IN ('UBIGINT', 'BIGINT', 'DOUBLE') "
            f"THEN CAST(trunc(CAST(json_extract({raw}, {p}) AS DOUBLE)) AS BIGINT) END")
