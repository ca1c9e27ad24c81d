"""The queries of `catalog.py` in plain SQL (DuckDB), written from their definitions.

Each result is one SELECT over common table expressions; only the needed expressions are put in front.
"""

from __future__ import annotations

from dialogeval import constants as K
from dialogeval import fixtures as fx
from dialogeval.catalog import HOLDOUT, LONG_SLICE, MIX_ROWS, READING_ROWS, SEED, SHEET_ROWS, SLICE, SUBSET_ROWS


def text_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


STRIP_CHARS = text_literal(K.PY_WHITESPACE)
MARKER = text_literal(K.SUMMARY_MARKER)
SYSTEM = text_literal(K.SYSTEM_PROMPT)
PREFIX = text_literal(K.PROMPT_PREFIX)
PREFIX_ONE_LINE = text_literal(K.PROMPT_PREFIX_ONE_LINE)
SEPARATOR = text_literal(K.DIALOG_SEPARATOR)
MODEL_LIST = "[" + ", ".join(text_literal(m) for m in fx.MODELS) + "]"
TYPES = "(" + ", ".join(text_literal(t) for t in K.ENTITY_TYPES) + ")"
SPANS = "[A-Z][a-z]+(?: [A-Z][a-z]+)*"


def strip(x: str) -> str:
    return f"trim({x}, {STRIP_CHARS})"


def number(x: str) -> str:
    return f"('0x' || substr(md5({x}), 1, 8))::BIGINT"


def place(x: str) -> str:
    return f"md5('{SEED}:' || {x})"


def is_test(x: str) -> str:
    return f"('0x' || substr({place(x)}, 1, 8))::BIGINT < {int(K.TEST_FRACTION * 2**32)}"


def exact_split(x: str) -> str:
    """The split with exactly the given share of test rows."""
    rank = f"row_number() OVER (ORDER BY {place(x)}, {x})"
    return f"CASE WHEN {rank} <= ceil({K.TEST_FRACTION} * count(*) OVER ()) THEN 'test' ELSE 'train' END"


def sentences(x: str) -> str:
    return (
        f"list_filter(list_transform(regexp_split_to_array({x}, '[.\\n]'), "
        f"lambda s: {strip('s')}), lambda s: s <> '')"
    )


def lead(x: str) -> str:
    return f"({sentences(x)})[1]"


def tail(x: str) -> str:
    return f"({sentences(x)})[-1]"


def longest(x: str) -> str:
    s = f"({sentences(x)})"
    sizes = f"list_transform({s}, lambda s: length(s))"
    return f"{s}[list_position({sizes}, list_max({sizes}))]"


def untag(x: str) -> str:
    return (
        f"replace(regexp_replace({x}, {text_literal(K.SPEAKER_TAG_PATTERN)}, '', 'g'), chr(10), ' ')"
    )


def markup(x: str) -> str:
    return strip(f"regexp_replace({x}, '[\\n*:]', '', 'g')")


def pieces(x: str) -> str:
    return f"regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+')"


def words(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'))"


def tokens(x: str) -> str:
    return f"list_filter(string_split({words(x)}, ' '), lambda t: t <> '')"


def spans(x: str) -> str:
    return f"list_distinct(coalesce(regexp_extract_all({x}, '{SPANS}'), []))"


def chatml(*turns: tuple[str, str]) -> str:
    """ChatML text of `(role, content expression)` pairs."""
    return " || ".join(
        f"'<|im_start|>{role}' || chr(10) || coalesce({content}, '') || '<|im_end|>' || chr(10)"
        for role, content in turns
    )


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, *needs: str, sql: str) -> None:
    CTES[name] = (needs, sql)


cte(
    "dialogs",
    sql=f"""
    SELECT dialog_id,
           string_agg(CASE WHEN role = 'user' THEN '#Person1#: ' ELSE '#Person2#: ' END || text,
                      chr(10) ORDER BY turn) AS dialogue,
           {lead("arg_min(text, turn) FILTER (WHERE role = 'assistant')")} AS summary
    FROM (SELECT CAST(conv_id AS VARCHAR) AS dialog_id, turn, role, text
          FROM conversations WHERE role <> 'system')
    GROUP BY dialog_id""",
)
cte(
    "raw",
    "dialogs",
    sql=f"""
    SELECT dialog_id,
           CASE WHEN summary IS NULL THEN dialogue
                WHEN {number('dialog_id')} % 10 = 0
                THEN dialogue || chr(10) || chr(10) || '**Summary draft:** *' || summary || '*'
                     || chr(10) || chr(10) || '**Summary:** *' || summary || '*'
                ELSE dialogue || chr(10) || chr(10) || '**Summary:** ' || summary END AS response
    FROM dialogs""",
)
cte(
    "parts",
    "raw",
    sql=f"""
    SELECT dialog_id, split_part(response, {MARKER}, -1) AS summary,
           split_part(response, {MARKER}, 1) AS dialog
    FROM raw""",
)
cte(
    "processed",
    "parts",
    sql=f"""
    SELECT dialog_id, {markup('summary')} AS summary, {PREFIX} || {markup('dialog')} AS dialog,
           {SYSTEM} AS system_prompt
    FROM parts""",
)
cte(
    "tagged",
    sql="""
    SELECT doc_id AS row_id,
           CASE WHEN doc_id % 2 = 0 THEN '#Person1#: ' ELSE '#Person2#:' END || text AS dialogue
    FROM documents""",
)
cte(
    "corpus2",
    sql=f"""
    SELECT row_id, {chatml(('user', 'text'), ('assistant', lead('text')))} AS text,
           CASE WHEN {is_test('row_id')} THEN 'test' ELSE 'train' END AS split
    FROM (SELECT 'c2:' || doc_id AS row_id, text FROM documents)""",
)
cte(
    "cleaned",
    "dialogs",
    sql=f"""
    SELECT dialog_id, dialogue, {untag('dialogue')} AS dialog, summary,
           {number('dialog_id')} AS mark
    FROM dialogs""",
)
_USER_TURN = "split_part(split_part(dialogue, '#Person1#: ', -1), chr(10) || '#Person2#: ', 1)"
cte(
    "candidates",
    "cleaned",
    sql=f"""
    SELECT *, {lead('dialog')} AS first_one, {tail('dialog')} AS last_one,
           {longest('dialog')} AS longest_one,
           CASE WHEN contains(dialogue, '#Person1#: ') THEN {lead(_USER_TURN)} END AS user_one
    FROM cleaned""",
)
cte(
    "outputs",
    "candidates",
    sql=f"""
    SELECT dialog_id, dialog, summary, model_id, split_part(model_id, '/', -1) AS model,
           CASE WHEN model_id = 'org/tail-1' AND mark % 17 = 0 THEN NULL
                WHEN model_id = 'org/lead-1' OR mark % 25 = 0 THEN first_one
                WHEN model_id = 'org/tail-1' THEN last_one
                WHEN model_id = 'org/longest-1' THEN longest_one
                ELSE user_one END AS model_output
    FROM candidates, unnest({MODEL_LIST}) AS m(model_id)""",
)
cte("scorable", "outputs", sql="SELECT * FROM outputs WHERE summary IS NOT NULL AND model_output IS NOT NULL")
_PIVOT = ", ".join(
    f"max(CASE WHEN model = '{m}' THEN model_output END) AS \"summary_by_{m}\"" for m in fx.SHORT_MODELS
)
cte("wide", "outputs", sql=f"SELECT dialog_id, summary, dialog, {_PIVOT} FROM outputs GROUP BY ALL")
cte(
    "labels4",
    "outputs",
    sql="""
    SELECT model, row_number() OVER (ORDER BY md5('label:' || model), model) AS position
    FROM (SELECT DISTINCT model FROM outputs)""",
)
cte(
    "votes",
    "dialogs",
    sql=f"""
    SELECT dialog_id, CASE WHEN v = 5 THEN '1,3' WHEN v > 0 THEN v::VARCHAR END AS winner
    FROM (SELECT dialog_id, {number("'vote:' || dialog_id")} % 6 AS v FROM dialogs)""",
)
cte(
    "listed",
    "dialogs",
    sql=f"""
    SELECT entity, ['PER', 'ORG', 'LOC', 'MISC'][1 + {number('entity')} % 4] AS type
    FROM (SELECT DISTINCT unnest(list_concat({spans('dialogue')},
                   flatten([string_split(s, ' ') FOR s IN {spans('dialogue')}]),
                   CASE WHEN len({pieces('dialogue')}) > 5
                        THEN [array_to_string(({pieces('dialogue')})[4:6], '')] ELSE [] END)) AS entity
          FROM dialogs)""",
)
cte(
    "vectors",
    "outputs",
    sql=f"""
    SELECT token, embedding::DOUBLE[] AS embedding
    FROM (SELECT DISTINCT unnest(list_concat({tokens("coalesce(summary, '')")},
                                             {tokens("coalesce(model_output, '')")})) AS token
          FROM outputs)
    JOIN embeddings ON vec_id = {number('token')} % (SELECT count(*) FROM embeddings)""",
)

# Longest common subsequence by dynamic programming: a running row of the table per word of `p`.
_LCS = """list_reduce(
    list_transform(range(1, len(p) + 1), lambda i: [i]),
    lambda above, i: list_reduce(
        list_transform(range(1, len(r) + 1), lambda j: [j]),
        lambda row, j: list_append(row, CASE WHEN p[i[1]] = r[j[1]] THEN above[j[1]] + 1
                                             ELSE greatest(row[j[1]], above[j[1] + 1]) END),
        [0::BIGINT]),
    list_transform(range(0, len(r) + 1), lambda z: 0::BIGINT))[-1]"""


def overlap(common: str) -> str:
    """F-measure of `common` words out of lists `p` and `r`."""
    p, r = f"({common} / len(p))", f"({common} / len(r))"
    return f"CASE WHEN len(p) = 0 OR len(r) = 0 OR {common} = 0 THEN 0.0 ELSE 2 * {p} * {r} / ({p} + {r}) END"


cte(
    "subsequences",
    "scorable",
    sql=f"""
    SELECT dialog_id, model, p, r, CASE WHEN len(p) > 0 AND len(r) > 0 THEN {_LCS} ELSE 0 END AS common
    FROM (SELECT dialog_id, model, {tokens('model_output')} AS p, {tokens('summary')} AS r FROM scorable)""",
)
cte(
    "overlap_scores",
    "subsequences",
    sql=f"SELECT dialog_id, model, {overlap('common')}::DOUBLE AS rouge_l FROM subsequences",
)
cte(
    "said",
    "scorable",
    "vectors",
    sql=f"""
    SELECT dialog_id, model, token, count(*) AS n
    FROM (SELECT dialog_id, model, unnest({tokens('model_output')}) AS token FROM scorable)
    SEMI JOIN vectors USING (token) GROUP BY ALL""",
)
cte(
    "given",
    "scorable",
    "vectors",
    sql=f"""
    SELECT dialog_id, model, token, count(*) AS n
    FROM (SELECT dialog_id, model, unnest({tokens('summary')}) AS token FROM scorable)
    SEMI JOIN vectors USING (token) GROUP BY ALL""",
)
cte(
    "cosines",
    "said",
    "given",
    "vectors",
    sql="""
    SELECT s, g, list_cosine_similarity(a.embedding, b.embedding) AS cosine
    FROM (SELECT DISTINCT said.token AS s, given.token AS g FROM said JOIN given USING (dialog_id, model))
    JOIN vectors a ON a.token = s JOIN vectors b ON b.token = g""",
)
cte(
    "matches",
    "cosines",
    sql="""
    SELECT dialog_id, model, s, g, said.n AS sn, given.n AS gn, cosine
    FROM said JOIN given USING (dialog_id, model)
    JOIN cosines ON s = said.token AND g = given.token""",
)
cte(
    "bert",
    "matches",
    sql="""
    SELECT dialog_id, model, coalesce(p, 0) AS p, coalesce(r, 0) AS r,
           CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f
    FROM scorable
    LEFT JOIN (SELECT dialog_id, model, sum(best * sn) / sum(sn) AS p
               FROM (SELECT dialog_id, model, s, sn, max(cosine) AS best FROM matches GROUP BY ALL)
               GROUP BY ALL) USING (dialog_id, model)
    LEFT JOIN (SELECT dialog_id, model, sum(best * gn) / sum(gn) AS r
               FROM (SELECT dialog_id, model, g, gn, max(cosine) AS best FROM matches GROUP BY ALL)
               GROUP BY ALL) USING (dialog_id, model)""",
)


def entities_of(source: str, keys: str, text: str) -> str:
    """`keys, entity`: listed entries that occur in a text between word edges and inside no longer one."""
    return f"""
    (WITH parts AS (SELECT DISTINCT {keys}, {pieces(text)} AS p FROM {source} WHERE {text} IS NOT NULL),
    runs AS (
      SELECT {keys}, i, i + n AS j, array_to_string(p[i:i + n - 1], '') AS entity
      FROM (SELECT {keys}, p, unnest(range(1, len(p) + 1)) AS i FROM parts),
           (SELECT DISTINCT len({pieces('entity')}) AS n FROM listed)
      WHERE i + n <= len(p) + 1 AND regexp_matches(p[i], '^[\\p{{L}}\\p{{N}}]')),
    hits AS (SELECT * FROM runs SEMI JOIN (SELECT entity FROM listed WHERE type IN {TYPES}) USING (entity))
    SELECT DISTINCT {keys}, entity FROM hits a
    WHERE NOT EXISTS (SELECT 1 FROM hits b WHERE ({", ".join("a." + k for k in keys.split(", "))}) = ({", ".join("b." + k for k in keys.split(", "))})
                      AND b.i <= a.i AND b.j >= a.j AND b.j - b.i > a.j - a.i))"""


def entity_sets(source: str, given: str) -> str:
    """`dialog_id, model, given, said`: sorted allowed entities of both texts."""

    def listed(x: str) -> str:
        return (
            f"SELECT dialog_id, model, list_sort(list(entity)) AS found FROM "
            f"{entities_of(source, 'dialog_id, model', x)} GROUP BY ALL"
        )

    return f"""
    SELECT dialog_id, model, coalesce(i.found, []) AS given, coalesce(o.found, []) AS said
    FROM {source} LEFT JOIN ({listed(given)}) i USING (dialog_id, model)
    LEFT JOIN ({listed('model_output')}) o USING (dialog_id, model)"""


cte("sets_summary", "outputs", "listed", sql=entity_sets("outputs", "summary"))
cte("sets_dialog", "outputs", "listed", sql=entity_sets("outputs", "dialog"))
_ONLY_SAID = "list_filter(said, lambda e: NOT list_contains(given, e))"
_ONLY_GIVEN = "list_filter(given, lambda e: NOT list_contains(said, e))"
cte(
    "entity_counts",
    "sets_summary",
    sql=f"""
    SELECT dialog_id, model, len({_ONLY_SAID}) AS num_hallucinated_entities,
           len({_ONLY_GIVEN}) AS num_missed_entities
    FROM sets_summary""",
)
cte(
    "evaluated",
    "bert",
    "overlap_scores",
    "entity_counts",
    sql="""
    SELECT dialog_id, model, num_hallucinated_entities, num_missed_entities, f AS bert_f1, rouge_l
    FROM bert JOIN overlap_scores USING (dialog_id, model) JOIN entity_counts USING (dialog_id, model)""",
)
cte(
    "mixed",
    "processed",
    "corpus2",
    sql=f"""
    SELECT row_id,
           {chatml(('system', 'system_prompt'), ('user', 'dialog'), ('assistant', 'summary'))} AS text,
           {exact_split('row_id')} AS split
    FROM (SELECT 'd:' || dialog_id AS row_id, * FROM processed)
    UNION ALL BY NAME SELECT row_id, text, split FROM corpus2""",
)

# The stemmer as steps over the distinct words. `shape` marks vowels and consonants of `w`.
_SHAPE = """(list_reduce(list_transform(range(1, length(w) + 1), lambda i: [substr(w, i, 1)]),
    lambda done, c: [done[1] || CASE WHEN contains('aeiou', c[1]) THEN 'v'
                                     WHEN c[1] = 'y' AND done[1][-1] = 'c' THEN 'v' ELSE 'c' END],
    [''])[1])"""


def measure(cut: int) -> str:
    """Vowel-consonant changes in `w` without its last `cut` letters."""
    shape = f"left(shape, length(shape) - {cut})"
    return f"((length({shape}) - length(replace({shape}, 'vc', ''))) // 2)"


def step(case: str, source: str) -> str:
    return (
        f"(SELECT token, w, {_SHAPE} AS shape FROM (SELECT token, CASE {case} ELSE w END AS w FROM {source}))"
    )


def cut(n: int, new: str = "") -> str:
    return f"left(w, length(w) - {n}) || '{new}'" if new else f"left(w, length(w) - {n})"


def suffix_rules(rules: list[tuple[str, str]], minimum: int) -> str:
    return " ".join(
        f"WHEN w LIKE '%{old}' THEN CASE WHEN {measure(len(old))} > {minimum} "
        f"THEN {cut(len(old), new)} ELSE w END"
        for old, new in rules
    )


_ENDS_CVC = "(shape = 'vc' OR (shape LIKE '%cvc' AND NOT regexp_matches(w, '[wxy]$')))"
_ENDS_CVC_BEFORE_E = (
    "(left(shape, length(shape) - 1) = 'vc' OR (left(shape, length(shape) - 1) LIKE '%cvc' "
    "AND NOT regexp_matches(w, '[wxy]e$')))"
)
_RULES_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"),
]
_RULES_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
]
_RULES_4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()
_IRREGULAR = (
    "CASE token WHEN 'skies' THEN 'sky' WHEN 'dying' THEN 'die' WHEN 'lying' THEN 'lie' "
    "WHEN 'tying' THEN 'tie' WHEN 'news' THEN 'news' WHEN 'innings' THEN 'inning' "
    "WHEN 'inning' THEN 'inning' WHEN 'outings' THEN 'outing' WHEN 'outing' THEN 'outing' "
    "WHEN 'cannings' THEN 'canning' WHEN 'canning' THEN 'canning' WHEN 'howe' THEN 'howe' "
    "WHEN 'proceed' THEN 'proceed' WHEN 'exceed' THEN 'exceed' WHEN 'succeed' THEN 'succeed' END"
)


def stems(vocabulary: str) -> str:
    """`token, stem` for a table of distinct tokens; only tokens longer than three letters change."""
    table = f"(SELECT token, w, {_SHAPE} AS shape FROM (SELECT token, token AS w FROM {vocabulary}))"
    table = step(
        f"WHEN w LIKE '%ies' AND length(w) = 4 THEN {cut(1)} WHEN w LIKE '%ies' THEN {cut(2)} "
        f"WHEN w LIKE '%sses' THEN {cut(2)} WHEN w LIKE '%s' AND w NOT LIKE '%ss' THEN {cut(1)}",
        table,
    )
    # A removed `ed` or `ing` leaves a mark for the repair step behind it.
    table = step(
        f"WHEN w LIKE '%ied' AND length(w) = 4 THEN {cut(1)} WHEN w LIKE '%ied' THEN {cut(2)} "
        f"WHEN w LIKE '%eed' THEN CASE WHEN {measure(3)} > 0 THEN {cut(1)} ELSE w END "
        f"WHEN w LIKE '%ed' AND contains(left(shape, length(shape) - 2), 'v') THEN '+' || {cut(2)} "
        f"WHEN w LIKE '%ing' AND contains(left(shape, length(shape) - 3), 'v') THEN '+' || {cut(3)}",
        table,
    )
    table = f"(SELECT token, left(w, 1) = '+' AS repair, ltrim(w, '+') AS w FROM {table})"
    table = f"(SELECT *, {_SHAPE} AS shape FROM {table})"
    table = step(
        f"WHEN NOT repair THEN w WHEN regexp_matches(w, '(at|bl|iz)$') THEN w || 'e' "
        f"WHEN length(w) > 1 AND w[-1] = w[-2] AND shape[-1] = 'c' "
        f"THEN CASE WHEN w[-1] IN ('l', 's', 'z') THEN w ELSE {cut(1)} END "
        f"WHEN {measure(0)} = 1 AND {_ENDS_CVC} THEN w || 'e'",
        table,
    )
    table = step(
        f"WHEN w LIKE '%y' AND length(w) > 2 AND shape[-2] = 'c' THEN {cut(1, 'i')}", table
    )
    for _ in range(2):
        table = step(f"WHEN w LIKE '%alli' AND {measure(4)} > 0 THEN {cut(2)}", table)
    table = step(
        f"{suffix_rules(_RULES_2, 0)} "
        f"WHEN w LIKE '%logi' THEN CASE WHEN {measure(3)} > 0 THEN {cut(1)} ELSE w END",
        table,
    )
    table = step(suffix_rules(_RULES_3, 0), table)
    fourth = " ".join(
        f"WHEN w LIKE '%{s}' THEN CASE WHEN {measure(len(s))} > 1"
        + (" AND regexp_matches(w, '[st]ion$')" if s == "ion" else "")
        + f" THEN {cut(len(s))} ELSE w END"
        for s in _RULES_4
    )
    table = step(fourth, table)
    table = step(
        f"WHEN w LIKE '%e' AND ({measure(1)} > 1 OR ({measure(1)} = 1 AND NOT {_ENDS_CVC_BEFORE_E})) "
        f"THEN {cut(1)}",
        table,
    )
    table = step(f"WHEN w LIKE '%ll' AND {measure(1)} > 1 THEN {cut(1)}", table)
    return (
        f"SELECT token, CASE WHEN length(token) > 3 THEN coalesce({_IRREGULAR}, w) ELSE token END AS stem "
        f"FROM {table}"
    )


cte(
    "output_words",
    "scorable",
    sql=f"""
    SELECT DISTINCT unnest(list_concat({tokens('summary')}, {tokens('model_output')})) AS token
    FROM scorable""",
)
cte("output_stems", "output_words", sql=stems("output_words"))
for _side, _column in (("p", "model_output"), ("r", "summary")):
    cte(
        f"stemmed_{_side}",
        "output_stems",
        sql=f"""
        SELECT dialog_id, model, list(stem ORDER BY place) AS {_side}
        FROM (SELECT dialog_id, model, unnest(w) AS token, generate_subscripts(w, 1) AS place
              FROM (SELECT dialog_id, model, {tokens(_column)} AS w FROM scorable))
        JOIN output_stems USING (token) GROUP BY ALL""",
    )
cte(
    "stemmed_overlaps",
    "stemmed_p",
    "stemmed_r",
    sql=f"""
    SELECT dialog_id, model, {overlap('common')}::DOUBLE AS rouge_l
    FROM (SELECT *, CASE WHEN len(p) > 0 AND len(r) > 0 THEN {_LCS} ELSE 0 END AS common
          FROM (SELECT dialog_id, model, coalesce(p, []) AS p, coalesce(r, []) AS r
                FROM scorable LEFT JOIN stemmed_p USING (dialog_id, model)
                LEFT JOIN stemmed_r USING (dialog_id, model)))""",
)
cte("document_words", sql=f"SELECT DISTINCT unnest({tokens('text')}) AS token FROM documents")
_CLEAN = "(SELECT row_id, " + untag("dialogue") + " AS d FROM tagged)"
cte(
    "central_said",
    "tagged",
    sql=f"""
    SELECT row_id, i, s.s AS sentence, {tokens('s.s')} AS w
    FROM (SELECT row_id, {sentences('d')} AS all_s FROM {_CLEAN}), unnest(all_s) WITH ORDINALITY AS s(s, i)""",
)
cte(
    "central_weights",
    "central_said",
    sql=f"""
    SELECT t, round(ln((SELECT count(d) FROM {_CLEAN}) / count(*)) * 1000000)::BIGINT AS weight
    FROM (SELECT DISTINCT row_id, unnest(w) AS t FROM central_said) GROUP BY t""",
)
cte(
    "central_means",
    "central_weights",
    sql="""
    SELECT row_id, i, sum(weight) / count(*) AS mean
    FROM (SELECT row_id, i, unnest(w) AS t FROM central_said) JOIN central_weights USING (t) GROUP BY row_id, i""",
)
cte(
    "evaluated_stemmed",
    "bert",
    "stemmed_overlaps",
    "entity_counts",
    sql="""
    SELECT dialog_id, model, num_hallucinated_entities, num_missed_entities, f AS bert_f1, rouge_l
    FROM bert JOIN stemmed_overlaps USING (dialog_id, model) JOIN entity_counts USING (dialog_id, model)""",
)
cte(
    "prompts",
    "tagged",
    sql=f"""
    SELECT min(row_id) AS row_id, clean_dialog
    FROM (SELECT row_id, {untag('dialogue')} AS clean_dialog FROM tagged) GROUP BY clean_dialog""",
)


def statement(select: str, *needs: str) -> str:
    """`select` behind the expressions it needs, directly or not."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    body = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name][1]})" for name in ordered)
    return f"WITH {body}\n{select}" if body else select


def shuffled(table: str, row_id: str, columns: str, lo: int, hi: int) -> str:
    return (
        f"SELECT {columns} FROM {table} ORDER BY {place(row_id)}, {row_id} LIMIT {hi - lo} OFFSET {lo}"
    )


def bar(x: str) -> str:
    return f"array_to_string({x}, '|')"


_SPLIT = f"CASE WHEN {is_test('doc_id')} THEN 'test' ELSE 'train' END AS split"
_SETS = f"""{bar('given')} AS entities_in_input, {bar('said')} AS entities_in_output,
    {bar(_ONLY_SAID)} AS hallucinated_entities, {bar(_ONLY_GIVEN)} AS missed_entities,
    len({_ONLY_SAID}) AS num_hallucinated_entities, len({_ONLY_GIVEN}) AS num_missed_entities"""
_BERT = "round(p, 5) AS bert_precision, round(r, 5) AS bert_recall, round(f, 5) AS bert_f1"
_SAMPLE = "(SELECT dialog_id FROM dialogs ORDER BY " + place("dialog_id") + " LIMIT {n})"
_UNTAGGED = untag("dialogue")


def _oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["flagship"] = statement(
        f"""
        SELECT model, count(*) AS num_rows, round(avg(rouge_l), 6) AS mean_rouge_l
        FROM (SELECT model_id AS model, {overlap('common')}::DOUBLE AS rouge_l
              FROM (SELECT model_id, p, r, CASE WHEN len(p) > 0 AND len(r) > 0 THEN {_LCS} ELSE 0 END AS common
                    FROM (SELECT m.model AS model_id, {tokens('m.output')} AS p, {tokens('summary')} AS r
                          FROM candidates, unnest([{{model: 'org/lead-1', output: first_one}},
                                                   {{model: 'org/tail-1', output: last_one}},
                                                   {{model: 'org/longest-1', output: longest_one}}]) AS u(m)
                          WHERE summary IS NOT NULL AND m.output IS NOT NULL)))
        GROUP BY model""",
        "candidates",
    )
    q["scan_dataset"] = "SELECT doc_id, lang, n_chars FROM documents"
    q["scan_csv"] = statement("SELECT row_id, dialogue FROM tagged", "tagged")
    q["write_csv"] = statement(
        "SELECT dialog_id, model_id AS model, model_output, summary FROM outputs", "outputs"
    )
    q["write_dataset"] = statement(
        f"SELECT dialog_id, dialog, summary, {exact_split('dialog_id')} AS split FROM processed",
        "processed",
    )
    q["split_response"] = statement("SELECT dialog_id, summary, dialog FROM parts", "parts")
    q["strip_markup"] = statement(f"SELECT dialog_id, {markup('response')} AS response FROM raw", "raw")
    q["build_prompt"] = statement(f"SELECT dialog_id, {PREFIX} || dialogue AS dialog FROM dialogs", "dialogs")
    q["build_prompt_v2"] = statement(
        f"SELECT dialog_id, {PREFIX_ONE_LINE} || dialogue AS user_prompt FROM dialogs", "dialogs"
    )
    q["add_constant"] = statement(f"SELECT dialog_id, {SYSTEM} AS system_prompt FROM dialogs", "dialogs")
    q["project_keep"] = statement(
        "SELECT dialog_id, system_prompt, dialog, summary FROM processed", "processed"
    )
    q["chat_messages"] = statement(
        """SELECT dialog_id, 'system|user|assistant' AS roles,
                  concat_ws('|', system_prompt, dialog, summary) AS contents FROM processed""",
        "processed",
    )
    kind = f"{number('dialog_id')} % 3"
    q["make_prompt"] = statement(
        f"""SELECT dialog_id, CASE WHEN {kind} = 0 THEN 'system|user' ELSE 'user' END AS roles,
                   CASE WHEN {kind} = 0 THEN {SYSTEM} || '|' || dialogue ELSE dialogue END AS contents
            FROM dialogs""",
        "dialogs",
    )
    q["render_chatml"] = statement("SELECT row_id, text FROM corpus2", "corpus2")
    q["recover_dialog"] = statement(
        f"SELECT row_id, {strip(_UNTAGGED)} AS dialog FROM tagged", "tagged"
    )
    q["strip_speaker_tags"] = statement(
        "SELECT dialog_id, dialog AS clean_dialog FROM cleaned", "cleaned"
    )
    letters = ", ".join(f'"summary_by_{m}" AS {c}' for m, c in zip(fx.SHORT_MODELS, "abcd"))
    q["rename_by_map"] = statement(f"SELECT dialog_id, summary, {letters} FROM wide", "wide")
    q["reorder_columns"] = statement(
        f"SELECT * REPLACE ({PREFIX} || dialog AS dialog) FROM wide", "wide"
    )
    q["model_short_name"] = statement(
        "SELECT dialog_id, model AS short_name, model AS from_column FROM outputs", "outputs"
    )
    q["normalise_text"] = f"SELECT doc_id, {strip('lower(text)')} AS form FROM documents"
    q["attach_column"] = statement(
        f"""SELECT dialog_id, {PREFIX_ONE_LINE} || dialogue AS model_input, winner
            FROM dialogs JOIN votes USING (dialog_id)""",
        "votes",
    )
    q["drop_missing"] = statement(
        "SELECT dialog_id, model_id AS model, summary, model_output FROM scorable", "scorable"
    )
    q["null_guard"] = statement(
        f"""SELECT dialog_id, model_id AS model, len({spans('model_output')}) AS num_spans,
                   {untag('model_output')} AS clean_output FROM outputs""",
        "outputs",
    )
    q["entity_type_in"] = statement(f"SELECT entity, type FROM listed WHERE type IN {TYPES}", "listed")
    q["head_n"] = statement(
        f"SELECT dialog_id, winner FROM votes ORDER BY dialog_id LIMIT {K.BALLOTS_READ}", "votes"
    )
    q["range_slice"] = shuffled("documents", "doc_id", "doc_id, lang", *SLICE)
    q["range_slice_ranked"] = shuffled("documents", "doc_id", "doc_id, lang", *LONG_SLICE)
    q["dedup_exact"] = statement("SELECT row_id, clean_dialog FROM prompts", "prompts")
    q["models_x_prompts"] = statement(
        f"SELECT dialog_id, dialogue, model FROM dialogs, unnest({MODEL_LIST}) AS m(model)", "dialogs"
    )
    q["attach_outputs"] = statement(
        "SELECT dialog_id, summary, model_id AS model, model_output FROM outputs", "outputs"
    )
    q["label_to_model"] = statement(
        "SELECT dialog_id, winner, model FROM votes JOIN labels4 ON winner = position::VARCHAR",
        "votes",
        "labels4",
    )
    q["holdout_antijoin"] = (
        f"SELECT doc_id, source FROM documents WHERE doc_id NOT IN "
        f"({shuffled('documents', 'doc_id', 'doc_id', 0, HOLDOUT[0])})"
    )
    q["wide_to_long"] = statement(
        f"SELECT dialog_id, summary, {strip('dialog')} AS dialog, model, model_output FROM scorable",
        "scorable",
    )
    q["long_to_wide"] = statement("SELECT * EXCLUDE (dialog) FROM wide", "wide")
    q["concat_tables"] = statement(
        """SELECT dialog_id AS row_id, dialogue, summary FROM dialogs
           UNION ALL SELECT row_id::VARCHAR, dialogue, NULL FROM tagged""",
        "dialogs",
        "tagged",
    )
    said, given = spans("model_output"), spans("summary")
    q["entity_set_difference"] = statement(
        f"""SELECT dialog_id, model_id AS model,
                   {bar(f"list_sort(list_filter({said}, lambda e: NOT list_contains({given}, e)))")} AS only_in_output,
                   {bar(f"list_sort(list_filter({given}, lambda e: NOT list_contains({said}, e)))")} AS only_in_summary
            FROM outputs""",
        "outputs",
    )
    q["set_cardinality"] = statement(
        f"SELECT dialog_id, len({spans('dialogue')}) AS num_spans FROM dialogs", "dialogs"
    )
    q["distinct_values"] = statement(
        """SELECT DISTINCT model, (SELECT count(DISTINCT model) FROM outputs) AS num_models
           FROM outputs""",
        "outputs",
    )
    same = f"count(DISTINCT {strip('lower(model_output)')}) = 1 AND count(model_output) = count(*)"
    q["identical_outputs"] = statement(
        f"SELECT dialog_id, {same} AS identical FROM outputs GROUP BY dialog_id", "outputs"
    )
    q["identical_outputs_wide"] = statement(
        f"""SELECT coalesce(bool_or(same), false) AS any_identical
            FROM (SELECT {same} AS same FROM outputs GROUP BY dialog_id)""",
        "outputs",
    )
    q["train_test_split"] = f"SELECT doc_id, {_SPLIT} FROM documents"
    q["train_test_split_exact"] = f"""
        SELECT doc_id, CASE WHEN r <= ceil({K.TEST_FRACTION} * n) THEN 'test' ELSE 'train' END AS split
        FROM (SELECT doc_id, row_number() OVER (ORDER BY {place('doc_id')}, doc_id) AS r,
                     count(*) OVER () AS n FROM documents)"""
    q["seeded_shuffle"] = f"SELECT doc_id, {place('doc_id')} AS place FROM documents"
    q["eval_subset"] = statement(
        shuffled(
            "(SELECT 'd:' || dialog_id AS row_id FROM dialogs UNION ALL SELECT row_id FROM corpus2)",
            "row_id",
            "row_id",
            0,
            SUBSET_ROWS,
        ),
        "dialogs",
        "corpus2",
    )
    q["holdout_slice"] = shuffled("documents", "doc_id", "doc_id, lang", HOLDOUT[0], sum(HOLDOUT))
    q["sample_n"] = statement(
        shuffled("dialogs", "dialog_id", "dialog_id, summary", 0, SHEET_ROWS), "dialogs"
    )
    q["blind_labels"] = statement("SELECT position, model, chr(96 + position::INT) AS label FROM labels4", "labels4")
    sheet = ", ".join(
        f"max(CASE WHEN position = {n} THEN model_output END) AS label_{n}" for n in fx.LABELS
    )
    q["human_eval_sheet"] = statement(
        f"""SELECT dialog_id, dialog, summary, {sheet} FROM outputs JOIN labels4 USING (model)
            WHERE dialog_id IN {_SAMPLE.format(n=SHEET_ROWS)} GROUP BY ALL""",
        "labels4",
    )
    q["side_by_side"] = statement(
        f"SELECT * FROM wide WHERE dialog_id IN {_SAMPLE.format(n=READING_ROWS)}", "wide"
    )
    # Scores exist for rows with both texts; the others count as missing.
    q["mean_by_model"] = statement(
        "SELECT model, round(avg(rouge_l), 6) AS mean_rouge_l FROM overlap_scores GROUP BY model", "overlap_scores"
    )
    q["entity_totals"] = statement(
        """SELECT model, sum(num_hallucinated_entities)::BIGINT AS hallucinated_entities,
                  sum(num_missed_entities)::BIGINT AS missed_entities
           FROM entity_counts GROUP BY model""",
        "entity_counts",
    )
    q["mean_per_column"] = statement(
        """SELECT 'rougeL_score_summary_by_' || model AS model, round(avg(rouge_l), 6) AS mean_rouge_l
           FROM overlap_scores GROUP BY ALL""",
        "overlap_scores",
    )
    q["describe_scores"] = statement(
        """SELECT model, 'rouge_l' AS score, count(*) AS count, round(avg(rouge_l), 6) AS mean,
                  round(stddev_samp(rouge_l), 6) AS std, round(min(rouge_l), 6) AS min,
                  round(quantile_cont(rouge_l, 0.25), 6) AS q25,
                  round(quantile_cont(rouge_l, 0.5), 6) AS q50,
                  round(quantile_cont(rouge_l, 0.75), 6) AS q75, round(max(rouge_l), 6) AS max
           FROM overlap_scores GROUP BY model""",
        "overlap_scores",
    )
    q["win_counts"] = statement(
        """SELECT model, position::VARCHAR AS label, count(winner) AS wins
           FROM labels4 LEFT JOIN votes ON winner = position::VARCHAR GROUP BY ALL""",
        "labels4",
        "votes",
    )
    q["win_counts_ties"] = statement(
        """SELECT model, position::VARCHAR AS label, count(winner) AS wins
           FROM labels4 LEFT JOIN (SELECT unnest(string_split(winner, ',')) AS winner FROM votes)
           ON winner = position::VARCHAR GROUP BY ALL""",
        "labels4",
        "votes",
    )
    q["winner_string"] = statement(
        f"""SELECT string_agg(winner, ',' ORDER BY dialog_id) AS winners
            FROM (SELECT * FROM votes ORDER BY dialog_id LIMIT {K.BALLOTS_READ})""",
        "votes",
    )
    q["rouge_l"] = statement(
        """SELECT dialog_id, model, round(rouge_l, 6) AS rouge_l
           FROM outputs LEFT JOIN stemmed_overlaps USING (dialog_id, model)""",
        "stemmed_overlaps",
    )
    q["rouge_l_unstemmed"] = statement(
        """SELECT dialog_id, model, round(rouge_l, 6) AS rouge_l
           FROM outputs LEFT JOIN overlap_scores USING (dialog_id, model)""",
        "overlap_scores",
    )
    q["stem_vocabulary"] = statement(stems("document_words"), "document_words")
    q["bert_score"] = statement(
        f"SELECT dialog_id, model, {_BERT} FROM outputs LEFT JOIN bert USING (dialog_id, model)", "bert"
    )
    q["bert_score_joined"] = q["bert_score"]
    q["extract_entities"] = statement(
        f"""SELECT text, coalesce({bar("list_sort(list(entity) FILTER (WHERE entity IS NOT NULL))")}, '') AS entities
            FROM (SELECT dialogue AS text FROM dialogs UNION SELECT summary FROM dialogs)
            LEFT JOIN {entities_of("(SELECT dialogue AS text FROM dialogs UNION SELECT summary FROM dialogs)", "text", "text")}
            USING (text)
            WHERE text IS NOT NULL GROUP BY text""",
        "listed",
    )
    clean = _CLEAN
    q["batch_generate"] = statement(
        f"""SELECT row_id, m.model AS model, m.output AS model_output
            FROM {clean}, unnest([{{model: 'org/lead-1', output: {lead('d')}}},
                                  {{model: 'org/tail-1', output: {tail('d')}}},
                                  {{model: 'org/longest-1', output: {longest('d')}}}]) AS u(m)""",
        "tagged",
    )
    q["batch_generate_central"] = statement(
        f"""SELECT c.row_id, 'org/central-1' AS model, arg_min(sentence, i) AS model_output
            FROM {clean} c LEFT JOIN (
              SELECT central_said.* FROM central_said LEFT JOIN central_means USING (row_id, i)
              QUALIFY coalesce(mean, -1) = max(coalesce(mean, -1)) OVER (PARTITION BY row_id)) b USING (row_id)
            GROUP BY c.row_id""",
        "central_means",
    )
    q["batch_generate_central_joined"] = q["batch_generate_central"]
    q["batch_generate_predictor"] = statement(
        """SELECT row_id, CASE WHEN row_id % 3 > 0 THEN row_id + 9007199254740993 END AS carried,
                  m.model AS model, m.output AS model_output
           FROM (SELECT row_id, string_split(dialogue, ' ') AS w FROM tagged),
                unnest([{model: 'first-word', output: w[1]}, {model: 'last-word', output: w[-1]},
                        {model: 'count', output: len(w)::VARCHAR}]) AS u(m)""",
        "tagged",
    )
    q["infer_holdout"] = statement(
        f"""SELECT dialog_id, summary, dialog, system_prompt, w[1] AS "summary_by_first-word",
                   w[-1] AS "summary_by_last-word", len(w)::VARCHAR AS summary_by_count
            FROM (SELECT *, string_split(dialog, ' ') AS w,
                         row_number() OVER (ORDER BY {place('dialog_id')}, dialog_id) AS r FROM processed)
            WHERE r > 5 AND r <= {5 + HOLDOUT[0]}""",
        "processed",
    )
    q["infer_dialogsum"] = statement(
        f"""SELECT row_id, clean_dialog, m.model AS model, m.output AS model_output
            FROM (SELECT row_id, clean_dialog, string_split({PREFIX_ONE_LINE} || clean_dialog, ' ') AS w FROM prompts),
                 unnest([{{model: 'first-word', output: w[1]}}, {{model: 'last-word', output: w[-1]}},
                         {{model: 'count', output: len(w)::VARCHAR}}]) AS u(m)""",
        "prompts",
    )
    q["label_map_io"] = statement(
        "SELECT position, model, position::VARCHAR AS label FROM labels4", "labels4"
    )
    q["dated_output"] = statement(
        """SELECT dialog_id, winner, '2024-05-01' AS run_date FROM votes
           UNION ALL SELECT dialog_id, winner, '2024-05-02' FROM votes WHERE winner IS NOT NULL""",
        "votes",
    )
    q["entity_scores"] = statement(f"SELECT dialog_id, model, {_SETS} FROM sets_summary", "sets_summary")
    q["entity_scores_large_gazetteer"] = q["entity_scores"]
    q["entity_scores_distinct"] = q["entity_scores"]
    q["entity_scores_dialog"] = statement(f"SELECT dialog_id, model, {_SETS} FROM sets_dialog", "sets_dialog")
    q["evaluate_outputs"] = statement(
        """SELECT dialog_id, model, num_hallucinated_entities, num_missed_entities,
                  round(bert_f1, 5) AS bert_f1, round(rouge_l, 6) AS rouge_l FROM evaluated_stemmed""",
        "evaluated_stemmed",
    )
    q["leaderboard"] = statement(
        """SELECT model, round(avg(bert_f1), 5) AS mean_bert_f1, round(avg(rouge_l), 6) AS mean_rouge_l,
                  sum(num_hallucinated_entities)::BIGINT AS hallucinated_entities,
                  sum(num_missed_entities)::BIGINT AS missed_entities,
                  (SELECT count(*) FROM votes JOIN labels4 ON winner = position::VARCHAR
                   WHERE labels4.model = e.model) AS wins
           FROM evaluated_stemmed e GROUP BY model""",
        "evaluated_stemmed",
        "votes",
        "labels4",
    )
    q["build_training_set"] = statement(
        f"""SELECT dialog_id, summary, dialog, system_prompt,
                   {exact_split('dialog_id')} AS split,
                   'system|user|assistant' AS roles,
                   concat_ws('|', system_prompt, dialog, summary) AS contents
            FROM processed""",
        "processed",
    )
    q["mix_corpora"] = statement("SELECT row_id, text FROM mixed WHERE split = 'train'", "mixed")
    q["mix_corpora_eval"] = statement(
        shuffled("(SELECT * FROM mixed WHERE split = 'test')", "row_id", "row_id, text", 0, MIX_ROWS),
        "mixed",
    )
    q["prepare_eval_prompts"] = statement(
        f"""SELECT row_id, clean_dialog, 'system|user' AS roles,
                   {SYSTEM} || '|' || {PREFIX_ONE_LINE} || clean_dialog AS contents FROM prompts""",
        "prompts",
    )
    return q


ORACLES: dict[str, str] = _oracles()
