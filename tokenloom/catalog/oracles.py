"""SQL that computes each query's result independently, for DuckDB over the same tables."""

from __future__ import annotations

from ..constants import NER_LABELS, VOCAB_SIZE
from .inputs import DOCS_PER_FILE, TAGS, TRAINED_SIZE, WORDPIECE_SIZE
from .queries import BLOCK, SHORT_TRIM

# Building blocks

CORPUS = "corpus AS (SELECT source AS file, doc_id, text FROM documents)"

ENC = """enc AS (
  SELECT source AS file, doc_id, flatten(list_transform(string_split(text, chr(10)), lambda l:
    list_concat(
      list_transform(list_filter(string_split(l, ' '), lambda w: w <> ''), lambda w:
        ('0x' || substr(md5(w), 1, 8))::BIGINT % 49147 + 5),
      [2::BIGINT]))) AS ids
  FROM documents)"""

TOK = """tok AS (
  SELECT file, doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS i FROM enc)"""

# Segments with their number j and the place of each token in its segment.
SEG = """seg_tok AS (
  SELECT *, coalesce(sum(CASE WHEN id = 2 THEN 1 ELSE 0 END) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS j
  FROM tok),
seg AS (
  SELECT file, doc_id, j, count(*) AS len, list(id ORDER BY i) AS ids FROM seg_tok GROUP BY ALL)"""


def examples(trim: int = 512, enc: str = ENC) -> str:
    """Greedy packing, one segment per recursion step."""
    return f"""{enc}, {TOK}, {SEG},
walk AS (
  SELECT doc_id, j, 0::BIGINT AS ex, CASE WHEN len > {trim} THEN 1 ELSE 0 END::BIGINT AS open,
    CASE WHEN len > {trim} THEN 0 ELSE len END::BIGINT AS cur
  FROM seg WHERE j = 0
  UNION ALL
  SELECT s.doc_id, s.j,
    CASE WHEN s.len > {trim} THEN w.open + CASE WHEN w.cur > 0 THEN 1 ELSE 0 END
         WHEN w.cur + s.len > {trim} THEN w.open + 1 ELSE w.open END,
    CASE WHEN s.len > {trim} THEN w.open + CASE WHEN w.cur > 0 THEN 2 ELSE 1 END
         WHEN w.cur + s.len > {trim} THEN w.open + 1 ELSE w.open END,
    CASE WHEN s.len > {trim} THEN 0 WHEN w.cur + s.len > {trim} THEN s.len
         ELSE w.cur + s.len END
  FROM walk w JOIN seg s ON s.doc_id = w.doc_id AND s.j = w.j + 1),
ex AS (
  SELECT s.file, s.doc_id, w.ex AS ex_idx,
    flatten(list(list_slice(s.ids, 1, {trim}) ORDER BY s.j)) AS ids
  FROM seg s JOIN walk w ON w.doc_id = s.doc_id AND w.j = s.j GROUP BY ALL)"""


EX = examples()
FILE_POS = "row_number() OVER (ORDER BY file, doc_id, ex_idx) - 1"
HASH = "md5('0:' || file || ':' || doc_id || ':' || ex_idx)"
HASH_POS = f"row_number() OVER (ORDER BY {HASH}, file, doc_id, ex_idx) - 1"

_TAG_LIST = "[" + ", ".join(f"'{t}'" for t in TAGS) + "]"
_LABEL_MAP = "MAP {" + ", ".join(f"'{k}': {v}" for k, v in NER_LABELS.items()) + "}"
_NAME_LIST = "[" + ", ".join(f"'{k}'" for k in NER_LABELS) + "]"

WORDS = """sentence AS (
  SELECT doc_id || ':' || (generate_subscripts(lines, 1) - 1) AS sent_id, string_split(unnest(lines), ' ') AS w
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)),
words AS (
  SELECT sent_id, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS pos FROM sentence)"""

TAGGED = f"""{WORDS},
tagged AS (
  SELECT sent_id, pos, token,
    {_TAG_LIST}[(('0x' || substr(md5(sent_id || ':' || pos), 1, 8))::BIGINT % 16 + 1)::INT] AS ner
  FROM words),
labelled AS (
  SELECT *, coalesce({_LABEL_MAP}[ner], -100)::BIGINT AS label FROM tagged)"""

PRED = f"""{TAGGED},
scores AS (
  SELECT sent_id, pos, label, list_transform(range(15), lambda k:
    ('0x' || substr(md5(sent_id || ':' || pos || ':' || k), 1, 8))::BIGINT / 4294967296.0::DOUBLE
    + CASE WHEN label = k AND ('0x' || substr(md5(sent_id || ':' || pos), 9, 8))::BIGINT % 10 < 8
      THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END) AS logits
  FROM labelled),
pred AS (
  SELECT sent_id, pos, label, list_position(logits, list_max(logits)) - 1 AS pred FROM scores),
kept AS (
  SELECT sent_id, row_number() OVER (PARTITION BY sent_id ORDER BY pos) - 1 AS i,
    {_NAME_LIST}[pred + 1] AS p, {_NAME_LIST}[label + 1] AS t
  FROM pred WHERE label <> -100)"""


def spans(tag: str, name: str) -> str:
    """Spans by lag, start flag and running sum."""
    return f"""{name}_flags AS (
  SELECT sent_id, i, {tag} AS tag, CASE WHEN {tag} <> 'O' AND (
      left({tag}, 1) = 'B'
      OR coalesce(lag({tag}) OVER (PARTITION BY sent_id ORDER BY i), 'O') = 'O'
      OR substr(lag({tag}) OVER (PARTITION BY sent_id ORDER BY i), 3) <> substr({tag}, 3))
    THEN 1 ELSE 0 END AS fresh
  FROM kept),
{name} AS (
  SELECT sent_id, any_value(substr(tag, 3)) AS type, min(i) AS "start", max(i) AS "end"
  FROM (SELECT *, sum(fresh) OVER (PARTITION BY sent_id ORDER BY i) AS g FROM {name}_flags)
  WHERE tag <> 'O' GROUP BY sent_id, g)"""


# The piece pattern without lookahead: a mark splits the last character off a run of white
# space that a word follows.
_MARK = "\\x{E000}"
PIECES = f"""pieces AS (
  SELECT doc_id, unnest(regexp_extract_all(
    regexp_replace(CASE WHEN text <> '' AND left(text, 1) <> ' ' THEN ' ' || text ELSE text END,
      '(\\s)(\\s\\S)', '\\1' || chr(57344) || '\\2', 'g'),
    '''s|''t|''re|''ve|''m|''ll|''d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^\\s\\p{{L}}\\p{{N}}{_MARK}]+|\\s+')) AS piece
  FROM documents),
hist AS (SELECT piece, count(*) AS n FROM pieces GROUP BY piece)"""

# Byte b of a text -> its token id before any merge.
BYTE_ID = """CASE WHEN b BETWEEN 33 AND 126 THEN b - 28 WHEN b BETWEEN 161 AND 172 THEN b - 62
  WHEN b >= 174 THEN b - 63 WHEN b <= 32 THEN b + 193 WHEN b <= 160 THEN b + 99 ELSE 260 END"""


def byte_ids(text: str) -> str:
    """List of byte-token ids of a text expression."""
    return f"""list_transform(list_transform(range(octet_length(encode({text}))::INT), lambda k:
      ('0x' || substr(hex(encode({text})), 2 * k::INT + 1, 2))::BIGINT), lambda b: {BYTE_ID})"""


PIECE_TOK = f"""{PIECES},
spelled AS (SELECT piece, n, {byte_ids('piece')} AS ids FROM hist)"""

ALIGNED = f"""{TAGGED},
spelled AS (
  SELECT sent_id, pos, label, {byte_ids("' ' || token")} AS ids FROM labelled WHERE token <> ''),
aligned AS (
  SELECT d.sent_id,
    list_concat([0::BIGINT], coalesce(any_value(s.ids), []), [2::BIGINT]) AS ids,
    list_concat([-100::BIGINT], coalesce(any_value(s.labels), []), [-100::BIGINT]) AS labels
  FROM sentence d LEFT JOIN (
    SELECT sent_id, flatten(list(ids ORDER BY pos)) AS ids,
      flatten(list(list_transform(ids, lambda x, k: CASE WHEN k = 1 THEN label ELSE -100 END)
        ORDER BY pos)) AS labels
    FROM spelled GROUP BY sent_id) s ON s.sent_id = d.sent_id GROUP BY d.sent_id)"""

MATRIX = f"""{ENC},
numbered AS (
  SELECT file || '_' || (doc_id // {DOCS_PER_FILE}) AS file, doc_id, ids FROM enc)"""

SENT_FILES = f"""sent AS (
  SELECT source || '_' || (doc_id // {DOCS_PER_FILE}) AS file, doc_id, unnest(l) AS sent,
    generate_subscripts(l, 1) AS k
  FROM (SELECT source, doc_id, string_split(text, chr(10)) AS l FROM documents)),
placed AS (
  SELECT file, row_number() OVER (PARTITION BY file ORDER BY doc_id, k) - 1 AS pos, sent FROM sent)"""

GRAMS = f"""{ENC}, {TOK},
gram AS (
  SELECT doc_id, id AS a, lead(id) OVER w AS b, lead(id, 2) OVER w AS c
  FROM tok WINDOW w AS (PARTITION BY doc_id ORDER BY i))"""

WEIGHTED = f"""{GRAMS},
weighted AS (
  SELECT a AS prev, b AS next, count(*) AS n, pow(count(*)::DOUBLE, 1.0::DOUBLE / 0.75) AS weight
  FROM gram WHERE b IS NOT NULL GROUP BY a, b)"""

MARKED = "list_transform(string_split(text, chr(10)), lambda l: '<s>' || l || '</s>')"

# Batches over numbered examples.
def padded(position: str) -> str:
    return f"""{EX},
numbered AS (SELECT *, {position} AS pos FROM ex),
wide AS (
  SELECT pos // 8 AS batch_id, pos % 8 AS "row", ids,
    max(len(ids)) OVER (PARTITION BY pos // 8) AS width FROM numbered)"""


def pad(values: str, width: str, fill: str) -> str:
    return f"""array_to_string(list_concat({values},
      list_transform(range(greatest({width} - len({values}), 0)), lambda k: ({fill})::BIGINT)), ' ')"""


def mask(values: str, width: str) -> str:
    ones = f"list_transform({values}, lambda k: 1::BIGINT)"
    return pad(ones, width, "0")


def replaced(chosen: str, vocab: int = VOCAB_SIZE) -> str:
    """Columns input_ids and labels, where ``chosen`` is a test on x and k, from 1."""
    h = "md5('0:' || key || ':' || (k - 1))"
    return f"""array_to_string(list_transform(ids, lambda x, k: CASE WHEN NOT ({chosen}) THEN x
      WHEN substr({h}, 9, 8) < 'cccccccd' THEN 4
      WHEN substr({h}, 9, 8) < 'e6666666' THEN ('0x' || substr({h}, 17, 8))::BIGINT % {vocab}
      ELSE x END), ' ') AS input_ids,
    array_to_string(list_transform(ids, lambda x, k: CASE WHEN {chosen} THEN x ELSE -100 END), ' ')
      AS labels"""


KEY = "keyed AS (SELECT *, file || ':' || doc_id || ':' || ex_idx AS key FROM ex)"
KEYED = f"{EX}, {KEY}"


def whole_words(start: str) -> str:
    """The positions hit per example; ``start`` tests whether a word begins at token x."""
    return f"""etok AS (SELECT key, len(ids) AS size, unnest(ids) AS x, generate_subscripts(ids, 1) - 1 AS i FROM keyed),
flag AS (
  SELECT *, CASE WHEN i = 0 OR x < 5 OR {start} OR lag(x) OVER (PARTITION BY key ORDER BY i) < 5
    THEN 1 ELSE 0 END AS fresh FROM etok),
word AS (
  SELECT key, any_value(size) AS size, min(i) AS start, count(*) AS len FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY key ORDER BY i) AS g FROM flag)
  WHERE x >= 5 GROUP BY key, g),
visit AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY md5('0:' || key || ':w:' || start), start) AS v,
    greatest(round_even(size * 0.15::DOUBLE, 0), 1)::BIGINT AS budget FROM word),
taken AS (
  SELECT key, v, start, len, (len <= budget) AS hit, CASE WHEN len <= budget THEN len ELSE 0 END AS used
  FROM visit WHERE v = 1
  UNION ALL
  SELECT w.key, w.v, w.start, w.len, t.used + w.len <= w.budget,
    CASE WHEN t.used + w.len <= w.budget THEN t.used + w.len ELSE t.used END
  FROM taken t JOIN visit w ON w.key = t.key AND w.v = t.v + 1),
hits AS (
  SELECT key, flatten(list(range(start, start + len))) AS hit FROM taken WHERE hit GROUP BY key)"""


# Training one merge at a time. A word is a string with the character id + 1 per token, so a
# merge is a replace. Pieces that are only to be encoded take part with count 0.

def _pieces_of(text: str) -> str:
    return f"""regexp_extract_all(regexp_replace({text}, '(\\s)(\\s\\S)', '\\1' || chr(57344) || '\\2', 'g'),
    '''s|''t|''re|''ve|''m|''ll|''d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^\\s\\p{{L}}\\p{{N}}{_MARK}]+|\\s+')"""


def _loop(start: str, base: str, size: int) -> str:
    return f"""loop AS (
  SELECT 0::BIGINT AS step, unit, word, n::BIGINT AS n, NULL::VARCHAR AS pair FROM {start}
  UNION ALL
  SELECT l.step + 1, l.unit, replace(l.word, b.pair, chr(({base} + l.step + 1)::INT)), l.n, b.pair
  FROM loop l, (
    SELECT pair FROM (
      SELECT n, unnest(list_transform(range(1, len(c)), lambda k: c[k] || c[k + 1])) AS pair
      FROM (SELECT n, string_split(word, '') AS c FROM loop WHERE n > 0))
    GROUP BY pair HAVING sum(n) >= 2 ORDER BY sum(n) DESC, pair LIMIT 1) b
  WHERE {base} + l.step < {size}),
merges AS MATERIALIZED (
  SELECT DISTINCT step - 1 AS rank, unicode(substr(pair, 1, 1)) - 1 AS l,
    unicode(substr(pair, 2, 1)) - 1 AS r FROM loop WHERE step > 0)"""


BASE_VOCAB = f"""symbols AS MATERIALIZED (
  SELECT i - 1 AS id, ['<s>', '<pad>', '</s>', '<unk>', '<mask>'][i] AS token FROM range(1, 6) r(i)
  UNION ALL
  SELECT {BYTE_ID}, CASE WHEN b BETWEEN 33 AND 126 OR b BETWEEN 161 AND 172 OR b >= 174
    THEN chr(b::INT) ELSE chr((256 + {BYTE_ID} - 193)::INT) END FROM range(256) r(b))"""

# The tokens by id, and the vocabulary after the last merge.
GROWN = """grown AS (
  SELECT 0::BIGINT AS step, (SELECT list(token ORDER BY id) FROM symbols) AS tokens
  UNION ALL
  SELECT g.step + 1, list_append(g.tokens, g.tokens[m.l + 1] || replace(g.tokens[m.r + 1], '##', ''))
  FROM grown g JOIN merges m ON m.rank = g.step),
final AS (SELECT tokens FROM grown ORDER BY step DESC LIMIT 1)"""

LINES = """line AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS j
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"""


def trained(units: str) -> str:
    """Train on the documents' pieces; ``units`` selects other pieces to encode."""
    return f"""{PIECES},
units AS (
  SELECT piece, n FROM hist UNION ALL
  SELECT piece, 0 FROM ({units}) WHERE piece NOT IN (SELECT piece FROM hist) GROUP BY piece),
start AS MATERIALIZED (
  SELECT piece AS unit, array_to_string(list_transform({byte_ids('piece')}, lambda x: chr((x + 1)::INT)), '')
    AS word, n FROM units),
{_loop('start', '261', TRAINED_SIZE)},
dict AS (
  SELECT unit AS piece, list_transform(string_split(word, ''), lambda c: unicode(c)::BIGINT - 1) AS ids
  FROM loop WHERE step = (SELECT max(step) FROM loop))"""


LINE_PIECES = f"SELECT unnest({_pieces_of('line')}) AS piece FROM line"

TRAINED_ENC = f"""{LINES}, {trained(LINE_PIECES)},
line_piece AS (
  SELECT doc_id, j, unnest(p) AS piece, generate_subscripts(p, 1) AS k
  FROM (SELECT doc_id, j, {_pieces_of('line')} AS p FROM line)),
line_ids AS (
  SELECT doc_id, j, flatten(list(d.ids ORDER BY k)) AS ids
  FROM line_piece p JOIN dict d ON d.piece = p.piece GROUP BY ALL),
enc AS (
  SELECT s.source AS file, l.doc_id, flatten(list(
    list_concat([0::BIGINT], coalesce(i.ids, []), [2::BIGINT]) ORDER BY l.j)) AS ids
  FROM line l JOIN documents s ON s.doc_id = l.doc_id
    LEFT JOIN line_ids i ON i.doc_id = l.doc_id AND i.j = l.j GROUP BY ALL)"""

WORD_PIECES = f"SELECT unnest({_pieces_of(chr(39) + ' ' + chr(39) + ' || token')}) AS piece FROM words WHERE token <> ''"

TRAINED_ALIGNED = f"""{TAGGED}, {trained(WORD_PIECES)},
word_piece AS (
  SELECT sent_id, pos, label, unnest(p) AS piece, generate_subscripts(p, 1) AS k
  FROM (SELECT *, {_pieces_of("' ' || token")} AS p FROM labelled WHERE token <> '')),
piece_ids AS (
  SELECT sent_id, pos, k, d.ids, list_transform(d.ids, lambda x, q:
    CASE WHEN q = 1 AND k = 1 THEN label ELSE -100 END) AS labels
  FROM word_piece p JOIN dict d ON d.piece = p.piece),
joined AS (
  SELECT sent_id, flatten(list(ids ORDER BY pos, k)) AS ids, flatten(list(labels ORDER BY pos, k)) AS labels
  FROM piece_ids GROUP BY sent_id),
aligned AS (
  SELECT d.sent_id,
    list_concat([0::BIGINT], list_slice(coalesce(s.ids, []), 1, 254), [2::BIGINT]) AS ids,
    list_concat([-100::BIGINT], list_slice(coalesce(s.labels, []), 1, 254), [-100::BIGINT]) AS labels
  FROM sentence d LEFT JOIN joined s ON s.sent_id = d.sent_id)"""

# WordPiece: a line is one unit; the alphabet follows the corpus.
WORDPIECE = f"""{LINES}, {BASE_VOCAB.replace("symbols AS", "byte_symbols AS")},
chars AS MATERIALIZED (
  SELECT line, n, unnest(string_split(line, '')) AS c, generate_subscripts(string_split(line, ''), 1) AS k
  FROM (SELECT line, count(*) AS n FROM line WHERE line <> '' GROUP BY line)),
symbols AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY part, place, token) - 1 AS id, token FROM (
    SELECT 1 AS part, id AS place, token FROM byte_symbols WHERE id < 5
    UNION ALL
    SELECT 2, 0, token FROM (
      SELECT token FROM byte_symbols WHERE id >= 5 UNION SELECT c FROM chars)
    UNION ALL
    SELECT DISTINCT 3, 0, '##' || c FROM chars WHERE k > 1)),
start AS MATERIALIZED (
  SELECT line AS unit, any_value(n) AS n, string_agg(chr((s.id + 1)::INT), '' ORDER BY k) AS word
  FROM chars JOIN symbols s ON s.token = CASE WHEN k > 1 THEN '##' || c ELSE c END
    AND (k > 1 OR s.id >= 5) GROUP BY line),
{_loop('start', '(SELECT count(*) FROM symbols)', WORDPIECE_SIZE)}, {GROWN}"""

# The longest token at each place of a line, one after the other.
WALK = """names AS MATERIALIZED (
  SELECT generate_subscripts(tokens, 1) - 1 AS id, unnest(tokens) AS token FROM final),
longest AS (SELECT max(len(token)) AS most FROM names),
walk AS (
  SELECT DISTINCT line, 1::BIGINT AS place, []::BIGINT[] AS ids FROM line WHERE line <> ''
  UNION ALL
  SELECT line, place + max(k), list_append(ids, max_by(id, k)) FROM (
    SELECT w.line, w.place, w.ids, k, v.id
    FROM (SELECT *, unnest(range(1, least((SELECT most FROM longest), len(line) - place + 1) + 1)) AS k FROM walk
          WHERE place <= len(line)) w
    JOIN names v ON v.token = CASE WHEN w.place > 1 THEN '##' ELSE '' END || substr(w.line, w.place, w.k))
  GROUP BY line, place, ids)"""


def query(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{select}"


ORACLES: dict[str, str] = {
    "read_jsonl_attr": """SELECT source AS file, text,
      row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS line FROM documents""",
    "read_json_list_attr": query(SENT_FILES, "SELECT * FROM placed"),
    "read_tolerant_sents": query(
        SENT_FILES, "SELECT * FROM placed WHERE left(md5(file), 1) >= '8'"),
    "read_tolerant_rejects": query(
        SENT_FILES, "SELECT DISTINCT file FROM placed WHERE left(md5(file), 1) < '8'"),
    "read_tolerant_report": query(
        SENT_FILES, """SELECT count(DISTINCT file) AS files,
          count(*) FILTER (left(md5(file), 1) >= '8') AS sentences FROM placed"""),
    "select_files": query(ENC, """SELECT file, len(ids) AS n FROM enc
      WHERE file LIKE '%src1%' AND file NOT LIKE '%src12%'"""),
    "read_token_lists": query(ENC, """SELECT file, array_to_string(ids, ' ') AS ids,
      row_number() OVER (PARTITION BY file ORDER BY doc_id) - 1 AS line FROM enc"""),
    "read_token_matrix": query(MATRIX, """SELECT file, array_to_string(ids, ' ') AS ids,
      row_number() OVER (PARTITION BY file ORDER BY doc_id) - 1 AS line FROM numbered"""),
    "pack_none": query(MATRIX, """SELECT file, array_to_string(ids, ' ') AS ids,
      row_number() OVER (PARTITION BY file ORDER BY doc_id) - 1 AS line FROM numbered"""),
    "write_token_lists": query(ENC, """SELECT file, array_to_string(ids, ' ') AS ids,
      row_number() OVER (PARTITION BY file ORDER BY doc_id) - 1 AS line FROM enc"""),
    "write_token_matrix": query(ENC, """SELECT file, array_to_string(ids, ' ') AS ids,
      row_number() OVER (PARTITION BY file ORDER BY doc_id) - 1 AS line FROM enc"""),
    "write_split": query(EX, f"""SELECT CASE WHEN pos < round_even(n * 0.01::DOUBLE, 0)
        THEN 'dev_trim' ELSE 'train_trim' END AS split, array_to_string(ids, ' ') AS ids
      FROM (SELECT ids, {FILE_POS} AS pos, count(*) OVER () AS n FROM ex)"""),
    "read_labelled": query(TAGGED, """SELECT string_agg(token, ' ' ORDER BY pos) AS token,
      string_agg(ner, ' ' ORDER BY pos) AS ner, row_number() OVER (ORDER BY sent_id) - 1 AS sent_id
      FROM tagged GROUP BY sent_id"""),
    "append_sample_log": """SELECT replace(replace(text, chr(10), chr(9)), ' ', chr(9)) AS value
      FROM documents""",
    "strip_blank": """SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN replace(text, chr(10), '')
      ELSE text END AS text FROM conversations""",
    "drop_source_columns": query(TAGGED, """SELECT sent_id,
      string_agg(label::VARCHAR, ' ' ORDER BY pos) AS labels FROM labelled GROUP BY sent_id"""),
    "map_label_names": query(TAGGED, """SELECT sent_id,
      string_agg(label::VARCHAR, ' ' ORDER BY pos) AS labels FROM labelled GROUP BY sent_id"""),
    "argmax_label": query(PRED, "SELECT sent_id, pos, pred::BIGINT AS pred FROM pred"),
    "drop_ignored": query(PRED, """SELECT s.sent_id,
        coalesce(string_agg(p, ' ' ORDER BY i), '') AS pred_tags,
        coalesce(string_agg(t, ' ' ORDER BY i), '') AS true_tags
      FROM (SELECT DISTINCT sent_id FROM pred) s LEFT JOIN kept k ON k.sent_id = s.sent_id
      GROUP BY s.sent_id"""),
    "format_pairs": query(TAGGED, "SELECT sent_id, token || chr(9) || ner AS line FROM tagged"),
    "word_counts": query(PIECES, "SELECT piece, n FROM hist"),
    "initial_vocab": query(PIECE_TOK, f"""SELECT v.id, v.token, coalesce(u.n, 0)::BIGINT AS n FROM (
        SELECT i - 1 AS id, ['<s>', '<pad>', '</s>', '<unk>', '<mask>'][i] AS token
        FROM range(1, 6) r(i)
        UNION ALL
        SELECT {BYTE_ID}, CASE WHEN b BETWEEN 33 AND 126 OR b BETWEEN 161 AND 172 OR b >= 174
          THEN chr(b::INT) ELSE chr((256 + {BYTE_ID} - 193)::INT) END
        FROM range(256) r(b)) v
      LEFT JOIN (SELECT id, sum(n) AS n FROM (SELECT unnest(ids) AS id, n FROM spelled) GROUP BY id) u
        ON u.id = v.id"""),
    "pair_counts": query(PIECE_TOK, """SELECT * FROM (
        SELECT p.l AS "left", p.r AS "right", sum(n)::BIGINT AS n FROM (
          SELECT n, unnest(list_transform(range(1, len(ids)), lambda k:
            {'l': ids[k], 'r': ids[k + 1]})) AS p FROM spelled)
        GROUP BY ALL) WHERE n >= 2"""),
    "bpe_train": query(trained("SELECT NULL AS piece WHERE false"), """
      SELECT rank, l::BIGINT AS "left", r::BIGINT AS "right", 261 + rank AS new_id FROM merges"""),
    "write_tokenizer": query(
      f"""{trained("SELECT NULL AS piece WHERE false")}, {BASE_VOCAB}, {GROWN}""",
      "SELECT generate_subscripts(tokens, 1) - 1 AS id, unnest(tokens) AS token FROM final"),
    "wordpiece_train": query(
      WORDPIECE, "SELECT generate_subscripts(tokens, 1) - 1 AS id, unnest(tokens) AS token FROM final"),
    "encode_wordpiece": query(f"{WORDPIECE}, {WALK}", """
      SELECT doc_id, j - 1 AS line, array_to_string(coalesce(ids, []), ' ') AS ids
      FROM line LEFT JOIN (SELECT line, ids FROM walk WHERE place > len(line)) w ON w.line = line.line"""),
    "decode_wordpiece": query(LINES, "SELECT doc_id, j - 1 AS line, line AS text FROM line"),
    "read_tokenizer_json": query(trained("SELECT NULL AS piece WHERE false"), """
      SELECT rank, l::BIGINT AS "left", r::BIGINT AS "right", 261 + rank AS new_id FROM merges"""),
    "encode": query(TRAINED_ENC, "SELECT doc_id, array_to_string(ids, ' ') AS ids FROM enc"),
    "align_labels": query(TRAINED_ALIGNED, """SELECT sent_id, array_to_string(ids, ' ') AS input_ids,
      array_to_string(labels, ' ') AS labels FROM aligned"""),
    "encode_bytes": f"""SELECT doc_id, array_to_string(flatten(list_transform(
        string_split(text, chr(10)), lambda l: list_concat([0::BIGINT], {byte_ids('l')}, [2::BIGINT]))), ' ') AS ids
      FROM documents""",
    "decode": f"""SELECT doc_id, array_to_string({MARKED}, '') AS text,
      replace(text, chr(10), '') AS plain FROM documents""",
    "split_at_eos": query(f"{ENC}, {TOK}, {SEG}", """
      SELECT file, doc_id, j AS seg_idx, array_to_string(ids, ' ') AS ids FROM seg
      UNION ALL
      SELECT file, doc_id, len(list_filter(ids, lambda x: x = 2))::BIGINT, '' FROM enc
      WHERE len(ids) = 0 OR ids[len(ids)] = 2"""),
    "pack_trim": query(EX, "SELECT file, doc_id, ex_idx, array_to_string(ids, ' ') AS ids FROM ex"),
    "pack_trim_short": query(
        examples(SHORT_TRIM),
        "SELECT file, doc_id, ex_idx, array_to_string(ids, ' ') AS ids FROM ex"),
    "chunk_block": query(f"{ENC}, {TOK}", f"""
      SELECT file, p // {BLOCK} AS chunk_idx, string_agg(id::VARCHAR, ' ' ORDER BY p) AS ids FROM (
        SELECT file, id, row_number() OVER (PARTITION BY file ORDER BY doc_id, i) - 1 AS p FROM tok)
      GROUP BY ALL"""),
    "shuffle_rows": query(EX, f"SELECT file, doc_id, ex_idx, {HASH_POS} AS pos FROM ex"),
    "shuffle_files": query(EX, """SELECT file, doc_id, ex_idx,
      row_number() OVER (ORDER BY md5('0:' || file), file, doc_id, ex_idx) - 1 AS pos FROM ex"""),
    "split_head": query(EX, f"""SELECT file, doc_id, ex_idx,
        CASE WHEN pos < round_even(n * 0.01::DOUBLE, 0) THEN 'dev' ELSE 'train' END AS split
      FROM (SELECT *, {FILE_POS} AS pos, count(*) OVER () AS n FROM ex)"""),
    "split_head_shuffled": query(EX, f"""SELECT file, doc_id, ex_idx,
        CASE WHEN pos < round_even(n * 0.01::DOUBLE, 0) THEN 'dev' ELSE 'train' END AS split
      FROM (SELECT *, {HASH_POS} AS pos, count(*) OVER () AS n FROM ex)"""),
    "split_fraction": query(WORDS, """SELECT sent_id,
        CASE WHEN row_number() OVER (ORDER BY md5('0:' || sent_id), sent_id)
          <= ceil(count(*) OVER () * 0.1::DOUBLE) THEN 'test' ELSE 'train' END AS split
      FROM sentence"""),
    "top_k": """SELECT * FROM (
        SELECT file, word, n, row_number() OVER (PARTITION BY file ORDER BY n DESC, word) AS "rank"
        FROM (SELECT file, word, count(*) AS n FROM (
            SELECT source AS file, unnest(string_split(replace(text, chr(10), ' '), ' ')) AS word
            FROM documents) GROUP BY ALL)) WHERE "rank" <= 3""",
    "batch_pad": query(padded(FILE_POS), f"""SELECT batch_id, "row",
      {pad('ids', 'width', '1')} AS input_ids, {mask('ids', 'width')} AS attention_mask FROM wide"""),
    "clm_labels": query(padded(HASH_POS), f"""SELECT batch_id, "row",
      {pad('ids', 'width', '1')} AS input_ids, {mask('ids', 'width')} AS attention_mask,
      {pad('ids', 'width', '-100')} AS labels FROM wide"""),
    "mlm_mask": query(KEYED, f"""SELECT file, doc_id, ex_idx, {replaced(
      "x >= 5 AND substr(md5('0:' || key || ':' || (k - 1)), 1, 8) < '26666666'")} FROM keyed"""),
    "whole_word_mask_trained": query(
      f"""{examples(512, TRAINED_ENC)}, {KEY}, {BASE_VOCAB}, {GROWN},
      {whole_words("starts_with((SELECT tokens FROM final)[x + 1], 'Ġ')")}""",
      f"""SELECT file, doc_id, ex_idx, {replaced("list_contains(hit, k - 1)", TRAINED_SIZE)} FROM (
        SELECT e.*, coalesce(h.hit, []) AS hit FROM keyed e LEFT JOIN hits h ON h.key = e.key)"""),
    "whole_word_mask": query(f"{KEYED}, {whole_words('x % 3 <> 0')}", f"""SELECT file, doc_id, ex_idx, {replaced(
      "list_contains(hit, k - 1)")} FROM (
        SELECT e.*, coalesce(h.hit, []) AS hit FROM keyed e LEFT JOIN hits h ON h.key = e.key)"""),
    "tokcls_pad": query(f"""{ALIGNED},
      numbered AS (SELECT *, row_number() OVER (ORDER BY md5('0:' || sent_id), sent_id) - 1 AS pos FROM aligned),
      wide AS (SELECT pos // 8 AS batch_id, pos % 8 AS "row", ids, labels,
        max(len(ids)) OVER (PARTITION BY pos // 8) AS width FROM numbered)""",
      f"""SELECT batch_id, "row", {pad('ids', 'width', '1')} AS input_ids,
        {mask('ids', 'width')} AS attention_mask, {pad('labels', 'width', '-100')} AS labels FROM wide"""),
    "fit_length": query(f"{ENC}, cutoff AS (SELECT doc_id, list_slice(ids, 1, 514) AS ids FROM enc)",
      f"""SELECT doc_id, {pad('ids', '514', '1')} AS ids, {mask('ids', '514')} AS attention_mask
      FROM cutoff"""),
    "align_labels_bytes": query(ALIGNED, """SELECT sent_id, array_to_string(ids, ' ') AS input_ids,
      array_to_string(labels, ' ') AS labels FROM aligned"""),
    "entity_spans": query(f"{PRED}, {spans('t', 'true_spans')}",
                          'SELECT sent_id, type, "start", "end" FROM true_spans'),
    "span_scores": query(f"{PRED}, {spans('t', 'true_spans')}, {spans('p', 'pred_spans')}", """,
      sums AS (SELECT
        (SELECT count(*) FROM true_spans JOIN pred_spans USING (sent_id, type, "start", "end")) AS c,
        (SELECT count(*) FROM pred_spans) AS p, (SELECT count(*) FROM true_spans) AS t,
        (SELECT avg((p = t)::INT) FROM kept) AS accuracy),
      ratios AS (SELECT coalesce(c / nullif(p, 0), 0)::DOUBLE AS "precision",
        coalesce(c / nullif(t, 0), 0)::DOUBLE AS recall, accuracy FROM sums)
      SELECT "precision", recall,
        coalesce(2 * "precision" * recall / nullif("precision" + recall, 0), 0) AS f1, accuracy
      FROM ratios"""),
    "fill_slot_topk": query(GRAMS, """SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY prev, next ORDER BY n DESC, mid) AS "rank" FROM (
          SELECT a AS prev, c AS next, b AS mid, count(*) AS n FROM gram WHERE c IS NOT NULL
          GROUP BY ALL)) WHERE "rank" <= 3"""),
    "next_token_distribution": query(WEIGHTED, """SELECT prev, next, n,
      round(weight / sum(weight) OVER (PARTITION BY prev), 6) AS p FROM weighted"""),
    "sample_next": query(WEIGHTED, """SELECT prev, draw, next FROM (
        SELECT prev, draw, next, row_number() OVER (PARTITION BY prev, draw ORDER BY
          -ln((('0x' || substr(md5('0:' || draw || ':' || prev || ':' || next), 1, 8))::BIGINT + 1)
            / 4294967296.0::DOUBLE) / weight, next) AS r
        FROM weighted, range(3) d(draw)) WHERE r = 1"""),
    "repeated_ngrams": query(GRAMS, """SELECT d.source AS file, g.doc_id, a || ' ' || b || ' ' || c AS gram, count(*) AS n
      FROM gram g JOIN documents d ON d.doc_id = g.doc_id
      WHERE c IS NOT NULL GROUP BY d.source, g.doc_id, a, b, c HAVING count(*) > 1"""),
    "corpus_counts": query(EX, """SELECT file, count(*) AS docs, sum(s)::BIGINT AS sentences,
        sum(e)::BIGINT AS examples FROM (
          SELECT d.source AS file, len(string_split(text, chr(10))) AS s, coalesce(e.n, 0) AS e
          FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM ex GROUP BY doc_id) e
            ON e.doc_id = d.doc_id)
      GROUP BY ROLLUP (file)"""),
    "map_batches": """SELECT doc_id, len(string_split(text, ' '))::BIGINT AS words FROM documents""",
    "corpus_to_splits": query(EX, f"""SELECT CASE WHEN pos < round_even(n * 0.01::DOUBLE, 0)
          THEN 'dev' ELSE 'train' END AS split, count(*) AS examples, sum(len(ids))::BIGINT AS tokens
      FROM (SELECT ids, {HASH_POS} AS pos, count(*) OVER () AS n FROM ex) GROUP BY ALL"""),
    "pretraining_batches": query(f"""{KEYED}, {whole_words('x % 3 <> 0')},
      placed AS (
        SELECT file, doc_id, ex_idx, {HASH_POS} AS pos FROM ex),
      masked AS (SELECT file, doc_id, ex_idx, len(ids) AS n, {replaced("list_contains(hit, k - 1)")} FROM (
        SELECT e.*, coalesce(h.hit, []) AS hit FROM keyed e LEFT JOIN hits h ON h.key = e.key)),
      wide AS (SELECT pos // 8 AS batch_id, pos % 8 AS "row", n, input_ids, labels,
        max(n) OVER (PARTITION BY pos // 8) AS width FROM masked JOIN placed USING (file, doc_id, ex_idx))""",
      """SELECT batch_id, "row", input_ids || repeat(' 1', width - n) AS input_ids,
        labels || repeat(' -100', width - n) AS labels,
        substr(repeat(' 1', n) || repeat(' 0', width - n), 2) AS attention_mask FROM wide"""),
}
