"""For each registered query, SQL that computes the same from the same tables."""

from __future__ import annotations

from vecshelf.constants import BRACKET_SPAN, MARKERS, WHITESPACE
from vecshelf.checks.registered import (
    COMMON_SHARE,
    ENCODER_DIM,
    NOW,
    SEED,
    STOPWORDS,
    WORD_DIM,
    WORD_DIM_NAMES,
)
from vecshelf.operators.batching import ROUNDS


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def without_markers(text: str) -> str:
    for marker in MARKERS:
        text = f"replace({text}, {quoted(marker)}, '')"
    return text


def stripped(text: str) -> str:
    return f"regexp_replace({text}, '\\A{WHITESPACE}+|{WHITESPACE}+\\z', '', 'g')"


def without_spans(text: str) -> str:
    return (
        f"list_reduce(list_prepend({text}, regexp_extract_all({text}, '{BRACKET_SPAN}')), "
        "lambda acc, span: replace(acc, span, ''))"
    )


HAN = r"\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}\x{20000}-\x{3ffff}"


def tokens(text: str) -> str:
    runs = (
        f"string_split_regex(regexp_replace(lower({text}), '([{HAN}]+)', ' \\1 ', 'g'), "
        "'[^\\p{L}\\p{N}]+')"
    )
    return (
        f"flatten(list_transform({runs}, lambda w: CASE WHEN regexp_full_match(w, '[{HAN}]+') "
        "THEN list_transform(range(1, length(w)), lambda i: substr(w, i, 2)) "
        "WHEN w = '' THEN [] ELSE [w] END))"
    )


def md5_number(text: str) -> str:
    return f"('0x' || left(md5({text}), 8))::BIGINT"


def r6(value: str) -> str:
    return f"round({value}, 6) + 0.0"


def in_list(words: list[str]) -> str:
    return ", ".join(quoted(w) for w in words)


DRESSED = """dressed AS (
  SELECT doc_id AS id,
    chr(12288) || '【福利秒杀】【' || source || '】[' || lang || '](新品)[x[' || lang || ']] 苹果手机那些 '
    || text || ' 源本' || chr(9) || chr(160) AS name
  FROM documents)"""

DOC_TOKENS = f"doc_tokens AS (SELECT doc_id AS id, {tokens('text')} AS toks FROM documents)"


def words(source: str, dim: int) -> str:
    """Word vectors in long form with their norms, for the words of a `(id, toks)` table."""
    return f"""words AS (
  SELECT token, j, {md5_number("token || ':' || j")} / 4294967296.0::DOUBLE - 0.5 AS v
  FROM (SELECT token FROM (SELECT unnest(toks) AS token FROM {source}) GROUP BY token HAVING count(*) > 1), range({dim}) t(j)),
norms AS (SELECT token, sqrt(sum(v * v)) AS norm FROM words GROUP BY token)"""


def vocabulary(source: str, min_count: int = 1) -> str:
    return f"""vocab AS (
  SELECT token, n, row_number() OVER (ORDER BY n DESC, token) + 3 AS id
  FROM (SELECT token, count(*) AS n FROM (SELECT unnest(toks) AS token FROM {source})
        GROUP BY token HAVING count(*) >= {min_count}))"""


def coded(source: str, column: str, limit: str, out: str) -> str:
    """Ids of the first `limit` tokens of a column, as an ordered list per id."""
    return f"""{out} AS (
  SELECT s.id, list(coalesce(v.id, 1) ORDER BY s.place) AS ids
  FROM (SELECT id, unnest({column}[1:{limit}]) AS token,
               generate_subscripts({column}[1:{limit}], 1) AS place FROM {source}) s
  LEFT JOIN vocab v ON v.token = s.token GROUP BY s.id)"""


def ids_text(items: str) -> str:
    return f"array_to_string({items}, ',')"


COMMON = f"""common AS (
  SELECT token FROM (SELECT DISTINCT id, unnest(toks) AS token FROM doc_tokens)
  GROUP BY token HAVING count(*) > {COMMON_SHARE} * (SELECT count(*) FROM documents))"""
LINES = """lines AS (
  SELECT unnest(string_split(text, chr(10))) AS line, lang, ' ' || quality AS label
  FROM documents JOIN labels USING (doc_id))"""
CSV = f"WITH {LINES}, cut AS (SELECT line || ',' || label AS value, string_split(line || ',' || label, ',') AS f FROM lines)"
TSV = f"WITH {LINES}, cut AS (SELECT string_split(concat_ws(chr(9), line, lang, label), chr(9)) AS f FROM lines)"

E = "e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label::BIGINT AS label FROM embeddings)"
MOVED = """m AS (
  SELECT id, list_transform(u, lambda x: x / sqrt(list_sum(list_transform(u, lambda y: y * y)))) AS v, u
  FROM (SELECT id, list_transform(embedding, lambda x: (x + 0.25) * (label + 1)) AS u
        FROM (SELECT vec_id AS id, embedding::DOUBLE[] AS embedding, label FROM embeddings)))"""
CENTROIDS = """c AS (
  SELECT class, list(w ORDER BY place) AS w FROM (
    SELECT label AS class, place, avg(x) AS w
    FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM e)
    GROUP BY label, place) GROUP BY class)"""
COSINES = """z AS (
  SELECT e.id, e.label, c.class,
    list_dot_product(e.v, c.w) / sqrt(list_dot_product(e.v, e.v)) / sqrt(list_dot_product(c.w, c.w)) AS cos
  FROM e, c)"""
COSINES_FEATURE = """cf AS (
  SELECT class, place, w / sqrt(sum(w * w) OVER (PARTITION BY place)) AS w
  FROM (SELECT class, unnest(w) AS w, generate_subscripts(w, 1) AS place FROM c)),
cn AS (SELECT class, list(w ORDER BY place) AS w FROM cf GROUP BY class),
z AS (
  SELECT e.id, e.label, cn.class, list_dot_product(e.v, cn.w) / sqrt(list_dot_product(e.v, e.v)) AS cos
  FROM e, cn)"""


def margin(m: float = 0.40, easy: bool = False, s: float = 64.0) -> str:
    sin = "sqrt(least(greatest(1 - cos * cos, 0), 1))"
    moved = f"cos * cos({m}::DOUBLE) - {sin} * sin({m}::DOUBLE)"
    if easy:
        target = f"CASE WHEN cos > 0 THEN {moved} ELSE cos END"
    else:
        target = (
            f"CASE WHEN cos > cos(pi() - {m}) THEN {moved} ELSE cos - {m} * sin(pi() - {m}) END"
        )
    return f"{s} * CASE WHEN class = label THEN {target} ELSE cos END"


def long_list(source: str, vector: str) -> str:
    return (
        f"SELECT id, place - 1 AS place, {r6('value')} AS value FROM ("
        f"SELECT id, unnest({vector}) AS value, generate_subscripts({vector}, 1) AS place FROM {source})"
    )


def logits(cosines: str, z: str) -> str:
    return f"WITH {E}, {CENTROIDS}, {cosines} SELECT id, class AS place, {r6(z)} AS value FROM z"


def ranked(queries: str, items: str, k: int, condition: str = "TRUE", skip: int = 0) -> str:
    """Neighbours `(id, neighbour_id, d2, rank)` of every query row."""
    return f"""SELECT id, neighbour_id, {r6('d2')} AS d2, rank - {skip} AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(d2, 9), neighbour_id) AS rank FROM (
    SELECT a.id, b.id AS neighbour_id, pow(list_distance(a.v, b.v), 2) AS d2
    FROM {queries} a, {items} b WHERE {condition}))
  WHERE rank > {skip} AND rank <= {k + skip}"""


def scaled(factor: str) -> str:
    """Neighbours of stretched vectors, ranked by exact distance and then by id."""
    return f"""WITH {E}, f AS (SELECT id, list_transform(v, lambda x: x * {factor}::DOUBLE) AS v FROM e)
SELECT id, neighbour_id, {r6(f'd2 / {factor}::DOUBLE / {factor}::DOUBLE')} AS d2, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, neighbour_id) AS rank FROM (
    SELECT a.id, b.id AS neighbour_id,
      list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d2
    FROM f a, f b WHERE a.id <> b.id))
  WHERE rank <= 12"""


TWO_NAMES = f"""WITH cat AS (
  SELECT row_number() OVER (ORDER BY brand, name) AS id, brand, name
  FROM (SELECT DISTINCT p_brand AS brand, p_name AS name FROM part)), {{hashed}},
hb AS (SELECT h.id, brand, v FROM h JOIN cat USING (id)),
near AS (
  SELECT a.id AS row_id, a.brand AS id, b.brand AS neighbour_id, min(pow(list_distance(a.v, b.v), 2)) AS d2
  FROM hb a, hb b WHERE a.brand <> b.brand GROUP BY ALL)
SELECT id, neighbour_id, {r6('d2')} AS d2,
  row_number() OVER (PARTITION BY row_id ORDER BY round(d2, 9), neighbour_id) AS rank
FROM near QUALIFY rank <= 12"""

KEPT_UP = """WITH cat AS (
  SELECT p_partkey AS id, CASE WHEN p_type = 'PROMO' THEN p_name || ' small' ELSE p_name END AS name FROM part WHERE p_type <> 'ECONOMY'),
{h} SELECT 'dj_similar:deep:' || id AS key, value FROM ({lists})"""

DROPOUT = f"""WITH {E},
x AS (SELECT id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e),
z0 AS (SELECT id, x, i, (({md5_number(f"id || ':{SEED}:1'")}::UHUGEINT
  + i::UHUGEINT * 11400714819323198485::UHUGEINT) % 18446744073709551616::UHUGEINT)::UBIGINT AS z FROM x),
z1 AS (SELECT id, x, i, ((xor(z, z >> 30)::UHUGEINT * 13787848793156543929::UHUGEINT)
  % 18446744073709551616::UHUGEINT)::UBIGINT AS z FROM z0),
z2 AS (SELECT id, x, i, ((xor(z, z >> 27)::UHUGEINT * 10723151780598845931::UHUGEINT)
  % 18446744073709551616::UHUGEINT)::UBIGINT AS z FROM z1),
z3 AS (SELECT id, x, i, xor(z, z >> 31) AS z FROM z2)
SELECT id, i - 1 AS place,
  {r6('CASE WHEN (z >> 11)::DOUBLE / 9007199254740992.0::DOUBLE >= 0.1::DOUBLE THEN x / 0.9::DOUBLE ELSE 0 END')} AS value
FROM z3"""


def hashed(source: str, text: str, dim: int = ENCODER_DIM) -> str:
    """Hashing-encoder vectors as lists, for a table with `id` and a text expression."""
    number = md5_number("token")
    return f"""toks AS (
  SELECT id, unnest(string_split({text}, ' ')) AS token FROM {source}),
slots AS (
  SELECT id, {number} % {dim} AS j, sum(1 - 2 * (({number} // {dim}) % 2)) AS v
  FROM toks WHERE token <> '' GROUP BY 1, 2),
h AS (
  SELECT s.id, list(coalesce(slots.v, 0)::DOUBLE ORDER BY t.j) AS v
  FROM {source} s CROSS JOIN range({dim}) t(j) LEFT JOIN slots ON slots.id = s.id AND slots.j = t.j
  GROUP BY s.id)"""


def averaged(source: str, dim: int, supervised: bool = False) -> str:
    """Sentence vectors in long form for `(id, toks)`."""
    if supervised:
        return f"""known AS (SELECT id, token FROM (SELECT id, unnest(toks) AS token FROM {source})
  WHERE token IN (SELECT token FROM norms)),
means AS (
  SELECT s.id, t.j, (coalesce(sum(w.v), 0) + t.j / {dim}.0::DOUBLE) / (count(w.v) + 1) AS v
  FROM {source} s CROSS JOIN range({dim}) t(j)
  LEFT JOIN known k ON k.id = s.id LEFT JOIN words w ON w.token = k.token AND w.j = t.j
  GROUP BY s.id, t.j)"""
    return f"""known AS (SELECT id, token FROM (SELECT id, unnest(toks) AS token FROM {source})
  WHERE token IN (SELECT token FROM norms)),
means AS (
  SELECT s.id, t.j, coalesce(sum(w.v / n.norm), 0) / greatest(count(w.v), 1) AS v
  FROM {source} s CROSS JOIN range({dim}) t(j)
  LEFT JOIN known k ON k.id = s.id LEFT JOIN words w ON w.token = k.token AND w.j = t.j
  LEFT JOIN norms n ON n.token = k.token
  GROUP BY s.id, t.j)"""


def listed(neighbours: str) -> str:
    return f"""SELECT id, string_agg(neighbour_id::VARCHAR, ',' ORDER BY rank) AS value
FROM ({neighbours}) GROUP BY id"""


ECONOMY = "SELECT DISTINCT p_partkey AS id, p_name AS name FROM part WHERE p_type = 'ECONOMY'"


def encoded_pairs() -> str:
    room = 47
    return f"""WITH turns AS (SELECT conv_id, turn, role, {tokens('text')} AS toks FROM conversations),
{vocabulary('turns')},
pairs AS (
  SELECT a.conv_id || '-' || a.turn AS id, a.toks AS a, b.toks AS b, len(a.toks) AS la, len(b.toks) AS lb
  FROM turns a JOIN turns b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
  WHERE a.role = 'user' AND b.role = 'assistant'),
cut AS (
  SELECT id, a[1:least(la, greatest({room} - lb, {(room + 1) // 2}))] AS a,
             b[1:least(lb, greatest({room} - la, {room // 2}))] AS b FROM pairs),
{coded('cut', 'a', 'len(a)', 'ca')},
{coded('cut', 'b', 'len(b)', 'cb')}
SELECT cut.id,
  {ids_text('flatten([[2], coalesce(ca.ids, []), [3], coalesce(cb.ids, []), [3]])')} AS input_ids,
  {ids_text('flatten([list_transform(range(len(a) + 2), lambda x: 0), list_transform(range(len(b) + 1), lambda x: 1)])')} AS token_type_ids
FROM cut LEFT JOIN ca USING (id) LEFT JOIN cb USING (id)"""


def padded() -> str:
    return f"""{DOC_TOKENS}, {vocabulary('doc_tokens')},
{coded('doc_tokens', 'toks', '48', 'cd')},
full_ids AS (
  SELECT l.doc_id AS id, l.quality AS label, flatten([[2], coalesce(cd.ids, []), [3]]) AS ids,
    row_number() OVER (ORDER BY l.doc_id) - 1 AS pos
  FROM labels l JOIN doc_tokens d ON d.id = l.doc_id LEFT JOIN cd ON cd.id = l.doc_id),
sized AS (SELECT *, pos // 32 AS batch_id, max(len(ids)) OVER (PARTITION BY pos // 32) AS width FROM full_ids),
padded AS (
  SELECT *, {ids_text('flatten([ids, list_transform(range(width - len(ids)), lambda x: 0)])')} AS input_ids,
    {ids_text('list_transform(range(width), lambda x: 0)')} AS token_type_ids FROM sized)"""


def shuffled(size: int = 32, world: int = 3, epoch: int = 1) -> str:
    return f"""WITH placed AS (
  SELECT doc_id AS id, row_number() OVER (ORDER BY md5('{SEED}:{epoch}:' || doc_id), doc_id) - 1 AS pos,
    count(*) OVER () AS n FROM documents),
sized AS (SELECT *, (n + {world - 1}) // {world} * {world} AS total FROM placed),
spread AS (SELECT id, total, total % {size * world} AS tail, unnest(range(pos, total, n)) AS pos FROM sized),
split AS (SELECT *, total - tail AS full_rows FROM spread),
ranked AS (
  SELECT id, pos, full_rows,
    CASE WHEN pos < full_rows THEN pos // {size} % {world}
         ELSE (pos - full_rows) // (tail // {world}) END AS rank FROM split)
SELECT id, pos, rank,
  CASE WHEN pos < full_rows THEN pos // {size * world} ELSE full_rows // {size * world} END * {world} + rank AS batch_id
FROM ranked"""


def fit_chain(steps: int, lr: float, warmup: float = 0.25, decay: float = 1e-4) -> str:
    """A whole fit from the class centroids, step after step: gradient, moments, decay and warm-up; one row of history a step."""
    warm, parts = int(warmup * steps), []
    for i in range(steps):
        rate = lr * i / max(warm, 1) if i < warm else lr * max(0.0, (steps - i) / max(steps - warm, 1))
        parts.append(f"""
c{i} AS MATERIALIZED (SELECT class, list(w ORDER BY dim) AS w FROM s{i} GROUP BY class),
z{i} AS (
  SELECT e.id, e.label, c.class, list_dot_product(e.v, c.w) / sqrt(list_dot_product(e.v, e.v)) / sqrt(list_dot_product(c.w, c.w)) AS cos
  FROM e, c{i} c),
y{i} AS (SELECT *, max(z) OVER (PARTITION BY id) AS top FROM (SELECT id, label, class, cos, {margin()} AS z FROM z{i})),
p{i} AS MATERIALIZED (SELECT *, exp(z - top) / sum(exp(z - top)) OVER (PARTITION BY id) AS p FROM y{i}),
h{i} AS (
  SELECT {i + 1} AS step, {rate!r}::DOUBLE AS rate, avg(loss) AS loss, avg(hit) AS hit FROM (
    SELECT id, ln(sum(exp(z - top))) + any_value(top) - max(CASE WHEN class = label THEN z END) AS loss,
      (arg_max(class, (z, -class)) = any_value(label))::INT AS hit FROM p{i} GROUP BY id)),
g{i} AS (
  SELECT id, class, 64.0 * (p - CASE WHEN class = label THEN 1 ELSE 0 END)
    * CASE WHEN class = label AND cos > cos(pi() - 0.4) THEN cos(0.4::DOUBLE)
        + sin(0.4::DOUBLE) * cos / greatest(sqrt(greatest(1 - cos * cos, 0)), 1e-7) ELSE 1 END
    / (SELECT count(*) FROM e) AS g FROM p{i}),
a{i} AS MATERIALIZED (SELECT class, dim, sum(g * x) AS a FROM g{i} JOIN x USING (id) GROUP BY class, dim),
d{i} AS (
  SELECT *, sum(a * w / norm) OVER (PARTITION BY class) AS dot FROM (
    SELECT *, sqrt(sum(w * w) OVER (PARTITION BY class)) AS norm FROM s{i} JOIN a{i} USING (class, dim))),
n{i} AS (
  SELECT class, dim, w, 0.9::DOUBLE * m + 0.1::DOUBLE * g AS m, 0.999::DOUBLE * q + 0.001::DOUBLE * g * g AS q
  FROM (SELECT *, (a - w / norm * dot) / norm AS g FROM d{i})),
s{i + 1} AS MATERIALIZED (
  SELECT class, dim, w * (1 - {rate!r}::DOUBLE * {decay}::DOUBLE)
    - {rate!r}::DOUBLE * (m / (1 - pow(0.9::DOUBLE, {i + 1}))) / (sqrt(q / (1 - pow(0.999::DOUBLE, {i + 1}))) + 1e-8::DOUBLE) AS w, m, q
  FROM n{i})""")
    history = " UNION ALL ".join(f"SELECT * FROM h{i}" for i in range(steps))
    return f"""WITH {E}, {CENTROIDS},
x AS MATERIALIZED (
  SELECT id, unnest(v) / norm AS x, generate_subscripts(v, 1) - 1 AS dim
  FROM (SELECT id, v, sqrt(list_dot_product(v, v)) AS norm FROM e)),
s0 AS MATERIALIZED (
  SELECT class, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS dim, 0.0::DOUBLE AS m, 0.0::DOUBLE AS q FROM c),{','.join(parts)}
SELECT step, {r6('loss')} AS loss, {r6('avg(hit) OVER (ORDER BY step)')} AS accuracy, round(rate * 1e6, 6) + 0.0 AS rate
FROM ({history})"""


def permuted(size: int = 32, world: int = 3, rounds: int = ROUNDS) -> str:
    k = md5_number(f"'{SEED}:' || epoch || ':' || r")
    other = f"(({k} % n) - x + n) % n"
    drawn = md5_number(f"'{SEED}:' || epoch || ':' || r || ':' || greatest(x, {other})")
    swap = f"CASE WHEN {drawn} % 2 = 1 THEN {other} ELSE x END"
    return f"""WITH placed AS (
  SELECT doc_id AS id, row_number() OVER (ORDER BY doc_id) - 1 AS pos, count(*) OVER () AS n FROM documents),
mixed AS (
  SELECT epoch, id, n, list_reduce(list_prepend(pos, range({rounds})), lambda x, r: {swap}) AS pos
  FROM placed, range(2) e(epoch)),
sized AS (SELECT *, (n + {world - 1}) // {world} * {world} AS total FROM mixed),
spread AS (SELECT epoch, id, total, total % {size * world} AS tail, unnest(range(pos, total, n)) AS pos FROM sized),
split AS (SELECT *, total - tail AS full_rows FROM spread),
ranked AS (
  SELECT epoch, id, pos, full_rows,
    CASE WHEN pos < full_rows THEN pos // {size} % {world}
         ELSE (pos - full_rows) // (tail // {world}) END AS rank FROM split)
SELECT epoch, id, pos, rank,
  CASE WHEN pos < full_rows THEN pos // {size * world} ELSE full_rows // {size * world} END * {world} + rank AS batch_id
FROM ranked"""


def oracles() -> dict[str, str]:
    economy_h = f"WITH cat AS ({ECONOMY}), {hashed('cat', 'name')}"
    other = "a.id <> b.id"
    loss = "ln(sum(exp(z - top))) + any_value(top) - max(CASE WHEN class = label THEN z END)"
    topped = "SELECT *, max(z) OVER (PARTITION BY id) AS top FROM"
    scored = f"WITH {E}, {CENTROIDS}, {COSINES}"
    clean_name = without_spans(without_markers("name"))
    gradient = f"""{scored},
y AS ({topped} (SELECT id, label, class, cos, {margin()} AS z FROM z)),
p AS (SELECT *, exp(z - top) / sum(exp(z - top)) OVER (PARTITION BY id) AS p FROM y),
g AS (
  SELECT id, class, 64.0 * (p - CASE WHEN class = label THEN 1 ELSE 0 END)
    * CASE WHEN class = label AND cos > cos(pi() - 0.4) THEN cos(0.4::DOUBLE)
        + sin(0.4::DOUBLE) * cos / greatest(sqrt(greatest(1 - cos * cos, 0)), 1e-7) ELSE 1 END
    / (SELECT count(*) FROM e) AS g FROM p),
x AS (SELECT id, unnest(v) / norm AS x, generate_subscripts(v, 1) - 1 AS dim
      FROM (SELECT id, v, sqrt(list_dot_product(v, v)) AS norm FROM e)),
a AS (SELECT class, dim, sum(g * x) AS a FROM g JOIN x USING (id) GROUP BY class, dim),
u AS (SELECT class, unnest(w) / norm AS u, generate_subscripts(w, 1) - 1 AS dim, norm
      FROM (SELECT class, w, sqrt(list_dot_product(w, w)) AS norm FROM c)),
d AS (SELECT *, sum(a * u) OVER (PARTITION BY class) AS dot FROM a JOIN u USING (class, dim))"""
    found = {
        "catalogue_up": "SELECT DISTINCT p_brand AS id, p_name AS name FROM part WHERE p_type = 'ECONOMY'",
        "catalogue_one_row": "SELECT p_brand AS id, min(p_name) AS name FROM part WHERE p_type = 'ECONOMY' GROUP BY p_brand",
        "catalogue_rejects": "SELECT CASE WHEN lang = 'fr' THEN 'null_name' ELSE 'good' END AS reason, count(*) AS n FROM documents GROUP BY 1",
        "labelled_read": f"{CSV} SELECT f[1] AS query, trim(f[2])::BIGINT AS label FROM cut WHERE len(f) = 2",
        "labelled_read_tabs": f"{TSV} SELECT f[1] AS query, trim(f[3])::BIGINT AS label FROM cut WHERE len(f) = 3",
        "labelled_unlabelled": f"{CSV} SELECT f[1] AS query FROM cut WHERE len(f) = 2",
        "labelled_rejects": f"{CSV} SELECT value AS text, 'field_count' AS reason FROM cut WHERE len(f) <> 2",
        "clean_deep": f"WITH {DRESSED} SELECT id, {stripped(without_markers('name'))} AS clean FROM dressed",
        "clean_baseline": f"""WITH {DRESSED}, bare AS (SELECT id, {clean_name} AS name FROM dressed)
SELECT id, array_to_string(list_filter({tokens('name')},
  lambda t: length(t) > 1 AND t NOT IN ({in_list(STOPWORDS)})), ' ') AS clean FROM bare""",
        "bracket_spans": f"WITH {DRESSED} SELECT id, {without_spans('name')} AS clean FROM dressed",
        "labelled_files": f"{CSV} SELECT value AS line FROM cut",
        "stopword_file": f"WITH {DOC_TOKENS}, {COMMON} SELECT token AS stopword FROM common",
        "word_vector_file": f"WITH {DOC_TOKENS}, {words('doc_tokens', WORD_DIM_NAMES)} SELECT token AS id, j AS place, {r6('round(v, 4)')} AS value FROM words",
        "segmenter_tokens": f"""SELECT doc_id AS id, array_to_string(list_filter(string_split(text, ' '),
  lambda t: length(t) > 1 AND t NOT IN ({in_list(STOPWORDS)})), ' ') AS clean FROM documents WHERE contains(text, ',')""",
        "segmenter_rejects": "SELECT doc_id AS id, text, 'segmenter_failed' AS reason FROM documents WHERE NOT contains(text, ',')",
        "mapped_batches": "SELECT doc_id AS id, length(text) AS n FROM documents",
        "saved_head": f"WITH {E}, {CENTROIDS}, k AS (SELECT class AS id, w FROM c) {long_list('k', 'w')}",
        "stopword_tokens": f"""WITH {DOC_TOKENS}, {COMMON},
kept AS (
  SELECT id, string_agg(token, ' ' ORDER BY place) AS clean
  FROM (SELECT id, unnest(toks) AS token, generate_subscripts(toks, 1) AS place FROM doc_tokens)
  WHERE token NOT IN (SELECT token FROM common) GROUP BY id)
SELECT id, coalesce(clean, '') AS clean FROM doc_tokens LEFT JOIN kept USING (id)""",
        "vocab": f"""WITH {DOC_TOKENS}, {vocabulary('doc_tokens')}
SELECT token, id, n AS count FROM vocab
UNION ALL SELECT * FROM (VALUES ('[PAD]', 0, 0), ('[UNK]', 1, 0), ('[CLS]', 2, 0), ('[SEP]', 3, 0))""",
        "encode_single": f"""WITH {DOC_TOKENS}, {vocabulary('doc_tokens', 2)},
{coded('doc_tokens', 'toks', '126', 'cd')}
SELECT id, {ids_text('flatten([[2], coalesce(ids, []), [3]])')} AS input_ids,
  {ids_text('list_transform(range(coalesce(len(ids), 0) + 2), lambda x: 0)')} AS token_type_ids
FROM doc_tokens LEFT JOIN cd USING (id)""",
        "encode_pair": encoded_pairs(),
        "batches_seq": "SELECT id, pos, pos // 128 AS batch_id FROM (SELECT doc_id AS id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)",
        "batches_shuffled": shuffled(),
        "batches_permuted": permuted(),
        "pad_batch": f"WITH {padded()} SELECT batch_id, id, input_ids, token_type_ids FROM padded",
        "collate": f"""WITH {padded()}
SELECT batch_id, count(*) AS n_rows, max(width) AS width,
  string_agg(input_ids, ';' ORDER BY pos) AS input_ids, string_agg(label::VARCHAR, ';' ORDER BY pos) AS labels
FROM padded GROUP BY batch_id""",
        "embed_names": f"WITH cat AS (SELECT p_partkey AS id, p_name AS name FROM part), {hashed('cat', 'name')} {long_list('h', 'v')}",
        "embed_documents": f"WITH cat AS (SELECT doc_id AS id, text FROM documents), {hashed('cat', 'text')} {long_list('h', 'v')}",
        "embed_ids": f"""WITH {DOC_TOKENS}, {vocabulary('doc_tokens')}, {coded('doc_tokens', 'toks', '48', 'cd')},
ids AS (SELECT id, unnest(flatten([[2], coalesce(ids, []), [3]])) * 2654435761 % 4294967296 AS n
        FROM doc_tokens LEFT JOIN cd USING (id)),
slots AS (SELECT id, n % {ENCODER_DIM} AS place, sum(1 - 2 * ((n // {ENCODER_DIM}) % 2)) AS v FROM ids GROUP BY 1, 2)
SELECT d.id, j AS place, {r6('coalesce(v, 0)::DOUBLE')} AS value
FROM doc_tokens d CROSS JOIN range({ENCODER_DIM}) t(j) LEFT JOIN slots s ON s.id = d.id AND s.place = t.j""",
        "train_head_run": f"""{CSV}, good AS (SELECT f[1] AS text FROM cut WHERE len(f) = 2),
toks AS (SELECT {tokens('text')} AS toks FROM good)
SELECT (SELECT count(*) FROM cut) AS loaded, (SELECT count(*) FROM cut WHERE len(f) <> 2) AS rejected,
  (SELECT count(*) FROM good) AS embedded, TRUE AS balanced,
  4 + (SELECT count(DISTINCT t) FROM (SELECT unnest(toks) AS t FROM toks)) AS words,
  (SELECT count(*) FROM cut WHERE len(f) <> 2) AS reject_rows, 2 * {ENCODER_DIM} AS saved_values, 1 AS evaluations""",
        "sentence_vector": f"WITH {DOC_TOKENS}, {words('doc_tokens', WORD_DIM)}, {averaged('doc_tokens', WORD_DIM)} SELECT id, j AS place, {r6('v')} AS value FROM means",
        "sentence_vector_sup": f"WITH {DOC_TOKENS}, {words('doc_tokens', WORD_DIM)}, {averaged('doc_tokens', WORD_DIM, True)} SELECT id, j AS place, {r6('v')} AS value FROM means",
        "l2_normalise": f"WITH {MOVED} {long_list('m', 'v')}",
        "dim_check": "SELECT min(len(embedding)) AS min_dim, max(len(embedding)) AS max_dim, count(*) AS n, count(*) - count(embedding) AS n_null FROM embeddings",
        "project_linear": f"""WITH {E}, x AS (SELECT id, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS i FROM e)
SELECT id, j AS place, {r6('sum(x * ((i * 7 + j * 3) % 11 - 5) / 10.0::DOUBLE) + any_value(j) / 8.0::DOUBLE')} AS value
FROM x, range(8) t(j) GROUP BY id, j""",
        "class_centroids": f"WITH {E}, {CENTROIDS}, k AS (SELECT class AS id, w FROM c) {long_list('k', 'w')}",
        "initial_weights": f"""SELECT class AS id, j AS place,
  {r6(f"(({md5_number(f'{SEED} || chr(58) || class || chr(58) || j')} / 4294967296.0::DOUBLE) * 2 - 1) * sqrt(6.0::DOUBLE / 64)")} AS value
FROM (SELECT DISTINCT label AS class FROM embeddings), range(64) t(j)""",
        "cosine_logits": logits(COSINES, "cos"),
        "cosine_logits_feature_axis": logits(COSINES_FEATURE, "cos"),
        "arc_logits": logits(COSINES, margin()),
        "arc_logits_easy": logits(COSINES, margin(easy=True)),
        "arc_logits_feature_axis": logits(COSINES_FEATURE, margin()),
        "cross_entropy": f"""{scored}, y AS ({topped} (SELECT id, label, class, {margin()} AS z FROM z))
SELECT id, {r6(loss)} AS loss FROM y GROUP BY id""",
        "train_accuracy": f"""{scored}, y AS (SELECT id, label, class, {margin(0.05)} AS z FROM z),
best AS (SELECT id, any_value(label) AS label, arg_max(class, (z, -class)) AS class FROM y GROUP BY id)
SELECT count(*) AS n, {r6('avg((class = label)::INT)')} AS accuracy FROM best""",
        "eval_head": f"""{scored},
y1 AS ({topped} (SELECT id, label, class, cos AS z FROM z)),
y64 AS ({topped} (SELECT id, label, class, 64.0 * cos AS z FROM z)),
l1 AS (SELECT id, {loss} AS loss, (arg_max(class, (z, -class)) = any_value(label))::INT AS hit FROM y1 GROUP BY id),
l64 AS (SELECT id, {loss} AS scaled FROM y64 GROUP BY id),
l AS (SELECT *, (row_number() OVER (ORDER BY id) - 1) // 128 AS batch_id FROM l1 JOIN l64 USING (id))
SELECT count(*) AS n,
  {r6('(SELECT avg(b) FROM (SELECT avg(loss) AS b FROM l GROUP BY batch_id))')} AS loss_batch_mean,
  {r6('avg(loss)')} AS loss_row_mean, {r6('avg(scaled)')} AS loss_scaled, {r6('avg(hit)')} AS accuracy FROM l""",
        "predict": f"{scored} SELECT id, arg_max(class, (cos, -class)) AS predicted FROM z GROUP BY id",
        "grad_step": f"{gradient} SELECT class, dim, {r6('(a - u * dot) / norm')} AS g FROM d",
        # The first AdamW step: both moments are the gradient's own, so the move is nearly its sign.
        "fit_step": f"""{gradient}, g2 AS (SELECT class, dim, u * norm AS w, (a - u * dot) / norm AS g FROM d)
SELECT class AS id, dim AS place, {r6('w * (1 - 0.05::DOUBLE * 1e-4::DOUBLE) - 0.05::DOUBLE * g / (abs(g) + 1e-8::DOUBLE)')} AS value FROM g2""",
        "fit_run": fit_chain(4, 0.05),
        "fit_resumed": f"SELECT step, loss, rate FROM ({fit_chain(4, 0.05)}) WHERE step > 2",
        "learning_rate": """SELECT step, round(CASE WHEN step < n // 4 THEN 1e-5::DOUBLE * step / (n // 4)
  ELSE 1e-5::DOUBLE * (n - step) / (n - n // 4) END * 1e6, 9) + 0.0 AS rate
FROM range(8) t(step), (SELECT 8 AS n FROM embeddings LIMIT 1)""",
        "knn_self": f"WITH {E} {ranked('e', 'e', 12, other)}",
        "knn_drop_first": f"WITH {E} {ranked('e', 'e', 12, skip=1)}",
        "knn_blocks": f"WITH {E} {ranked('e', 'e', 12, other)}",
        "knn_cross": f"WITH {E}, {CENTROIDS}, k AS (SELECT class AS id, w AS v FROM c) {ranked('k', 'e', 13)}",
        "knn_tree": f"WITH {E} {ranked('e', 'e', 12, other)}",
        "knn_tree_cross": f"WITH {E}, {CENTROIDS}, k AS (SELECT class AS id, w AS v FROM c) {ranked('k', 'e', 13)}",
        "knn_small": scaled("1e-6"),
        "knn_small_blocks": scaled("1e-6"),
        "knn_large": scaled("1e20"),
        "knn_large_blocks": scaled("1e20"),
        "knn_two_names": TWO_NAMES.format(hashed=hashed("cat", "name")),
        "knn_two_names_blocks": TWO_NAMES.format(hashed=hashed("cat", "name")),
        "knn_short": f"WITH {E}, {CENTROIDS}, k AS (SELECT class AS id, w AS v FROM c) {ranked('e', 'k', 12)}",
        "list_purity": f"""WITH {E}, n AS ({ranked('e', 'e', 12, other)})
SELECT n.id, {r6('avg((a.label = b.label)::INT)')} AS purity
FROM n JOIN e a ON a.id = n.id JOIN e b ON b.id = n.neighbour_id GROUP BY n.id""",
        "dropout": DROPOUT,
        "publish_run": f"""WITH {E} SELECT 'dj_similar:deep:' || id AS key, value
FROM ({listed(ranked('e', 'e', 12, other))})""",
        "published_batches": f"""WITH {E} SELECT 'dj_similar:deep:' || id AS key, value
FROM ({listed(ranked('e', 'e', 12, other))})""",
        "snapshot_difference": """WITH rows AS (
  SELECT doc_id AS id, text AS name, lang FROM documents UNION ALL SELECT doc_id, nullif(source, 'src0'), lang FROM documents),
told AS (SELECT id, coalesce('=' || name, '-') AS name, lang FROM rows),
before AS (SELECT id, list(DISTINCT name ORDER BY name) AS names FROM told WHERE lang <> 'de' GROUP BY id),
after AS (
  SELECT id, list(DISTINCT name ORDER BY name) AS names FROM (
    SELECT id, CASE WHEN lang = 'fr' THEN upper(name) ELSE name END AS name FROM told WHERE lang <> 'es') GROUP BY id)
SELECT id, CASE WHEN b.names IS NULL THEN 'new' WHEN a.names IS NULL THEN 'gone' ELSE 'changed' END AS change
FROM before b FULL JOIN after a USING (id) WHERE b.names IS DISTINCT FROM a.names""",
        "vectors_kept": f"WITH cat AS (SELECT doc_id AS id, text FROM documents), {hashed('cat', 'text')} {long_list('h', 'v')}",
        "lists_repaired": f"""WITH {E}, f AS (
  SELECT id, CASE WHEN label = 2 THEN list_transform(v, lambda x: -x) ELSE v END AS v FROM e WHERE label <> 3)
{ranked('f', 'f', 12, other)}""",
        "daily_runs": KEPT_UP.format(h=hashed("cat", "name"), lists=listed(ranked("h", "h", 12, other))),
        "stream_publish": KEPT_UP.format(h=hashed("cat", "name"), lists=listed(ranked("h", "h", 12, other))),
        "run_summary_baseline": """WITH cat AS (SELECT DISTINCT p_partkey, nullif(p_name, 'small ring') AS name FROM part WHERE p_type = 'ECONOMY')
SELECT count(*) AS loaded, count(name) AS cleaned, count(*) - count(name) AS rejected,
  count(name) AS embedded, count(name) AS searched, TRUE AS balanced FROM cat""",
        "knn_cosine": f"WITH {MOVED} {ranked('m', 'm', 12, other)}",
        "knn_names": f"WITH cat AS (SELECT p_partkey AS id, p_name AS name FROM part), {hashed('cat', 'name')} {ranked('h', 'h', 12, other)}",
        "list_texts": f"WITH {E} {listed(ranked('e', 'e', 12, other))}",
        "publish_records": f"""WITH {E}
SELECT 'dj_similar:deep:' || id AS key, value,
  strftime(TIMESTAMP '{NOW}' + INTERVAL 604800 SECOND, '%Y-%m-%d %H:%M:%S') AS expires_at
FROM ({listed(ranked('e', 'e', 12, other))})""",
        "live_records": f"""SELECT key, value FROM (
  SELECT user_id || ':' || event_type AS key, event_id::VARCHAR AS value, ts,
    row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id::VARCHAR DESC) AS r FROM events)
WHERE r = 1 AND ts + INTERVAL 604800 SECOND > TIMESTAMP '{NOW}'""",
        "deep_lists_names": f"{economy_h} {listed(ranked('h', 'h', 12, other))}",
        "baseline_lists_names": f"""WITH cat AS ({ECONOMY}),
all_toks AS (SELECT id, {tokens('name')} AS toks FROM cat),
kept AS (SELECT id, list_filter(toks, lambda t: length(t) > 1 AND t <> 'small') AS toks FROM all_toks),
{words('all_toks', WORD_DIM_NAMES)}, {averaged('kept', WORD_DIM_NAMES)},
h AS (SELECT id, list(v ORDER BY j) AS v FROM means GROUP BY id)
{listed(ranked('h', 'h', 12, other))}""",
        "run_summary": f"""WITH cat AS (SELECT DISTINCT p_partkey, nullif(p_name, 'small ring') AS name FROM part WHERE p_type = 'ECONOMY')
SELECT count(*) AS loaded, count(name) AS cleaned, count(*) - count(name) AS rejected,
  count(name) AS embedded, count(name) AS searched, TRUE AS balanced FROM cat""",
        "list_overlap": f"""WITH {E}, {MOVED},
a AS ({ranked('e', 'e', 12, other)}), b AS ({ranked('m', 'm', 12, other)}),
la AS (SELECT id, list(neighbour_id ORDER BY rank) AS l FROM a GROUP BY id),
lb AS (SELECT id, list(neighbour_id ORDER BY rank) AS l FROM b GROUP BY id),
d AS (SELECT a.id, min(a.rank) AS first_diff FROM a JOIN b ON a.id = b.id AND a.rank = b.rank
      WHERE a.neighbour_id <> b.neighbour_id GROUP BY a.id),
s AS (SELECT la.id, len(list_intersect(la.l, lb.l)) AS n, len(list_distinct(list_concat(la.l, lb.l))) AS u
      FROM la JOIN lb USING (id))
SELECT id, n AS n_shared, {r6('n / 12.0::DOUBLE')} AS overlap, {r6('n / u::DOUBLE')} AS jaccard, first_diff
FROM s LEFT JOIN d USING (id)""",
        "arm_metrics": f"""SELECT {md5_number("'ab:' || user_id")} % 2 AS arm, event_type, count(*) AS events,
  count(DISTINCT user_id) AS users, {r6('avg(value)')} AS mean_value FROM events GROUP BY 1, 2""",
    }
    # The same results by the other code path.
    twins = ("stopword_join stopword_tokens", "encode_single_join encode_single", "encode_pair_join encode_pair",
             "sentence_vector_join sentence_vector", "fit_step_sharded fit_step", "eval_head_sharded eval_head")
    return found | {a: found[b] for a, b in map(str.split, twins)}
