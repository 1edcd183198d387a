"""Registered queries: each name has a Spark callable ``(spark, sf_dir) -> DataFrame``
and, where the result is expressible in SQL, the same computation as DuckDB SQL
over the driver's tables.  Column names match on both sides.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from prefdata.functions.keys import sql_h, sql_hnum
from prefdata.operators import pairs as P
from prefdata.operators import split as S
from prefdata.sources import fixtures as FX
from prefdata.sources.tables import table

QUERIES: dict = {}
SQL: dict = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SEED = 42

# ---------------------------------------------------------------- splits

SPLIT_CASE = ("CASE WHEN pos < n * 3 // 10 THEN 'finetune' WHEN pos < n * 6 // 10 THEN 'reward' "
              "WHEN pos < n * 9 // 10 THEN 'rl' ELSE 'evaluation' END")


def sql_positions(src: str, key: str, seed=SEED) -> str:
    return (f"SELECT *, row_number() OVER (ORDER BY {sql_h(seed, key)}, {key}) - 1 AS pos, "
            f"count(*) OVER () AS n FROM {src}")


@register("split_exact", f"WITH o AS ({sql_positions('documents', 'doc_id')}) SELECT doc_id, {SPLIT_CASE} AS split FROM o")
def q_split_exact(spark, sf):
    return S.split_exact(table(spark, sf, "documents").select("doc_id"), "doc_id", SEED)


@register("holdout", f"WITH o AS ({sql_positions('documents', 'doc_id')}) "
                     "SELECT doc_id, CASE WHEN pos < ceil(0.005 * n) THEN 'test' ELSE 'train' END AS part FROM o")
def q_holdout(spark, sf):
    return S.holdout(table(spark, sf, "documents").select("doc_id"), "doc_id", 0.005, SEED)


@register("split_counts", f"WITH o AS ({sql_positions('documents', 'doc_id')}) "
                          f"SELECT {SPLIT_CASE} AS split, count(*) AS n FROM o GROUP BY 1")
def q_split_counts(spark, sf):
    return S.split_counts(S.split_exact(table(spark, sf, "documents").select("doc_id"), "doc_id", SEED))


FIRST_N = 500


@register("first_n", f"WITH o AS ({sql_positions('documents', 'doc_id')}) "
                     f"SELECT doc_id, lang, n_chars FROM o WHERE pos < {FIRST_N}")
def q_first_n(spark, sf):
    return S.first_n(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), "doc_id", FIRST_N, SEED)


TAKE_N = 100


@register("take_skip", f"WITH o AS ({sql_positions('documents', 'doc_id')}) "
                       f"SELECT doc_id, CASE WHEN pos < {TAKE_N} THEN 'valid' ELSE 'train' END AS part FROM o")
def q_take_skip(spark, sf):
    return S.take_skip(table(spark, sf, "documents").select("doc_id"), "doc_id", TAKE_N, SEED)


# ---------------------------------------------------------------- pairs

def sql_sample_pairs(src: str, k: int = P.MAX_PAIRS, seed=SEED) -> str:
    """Oracle of :func:`prefdata.operators.pairs.sample_pairs` over a CTE ``src(qid, aid, score)``."""
    prev = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""a AS (SELECT qid, aid, score FROM {src} WHERE score IS NOT NULL),
c0 AS (SELECT qid, score, count(*) AS n FROM a GROUP BY qid, score),
c1 AS (SELECT *, CAST(coalesce(sum(n) OVER (PARTITION BY qid ORDER BY score DESC {prev}), 0) AS BIGINT) AS above FROM c0),
c AS (SELECT *, n * above AS pairs,
      CAST(coalesce(sum(n * above) OVER (PARTITION BY qid ORDER BY score DESC {prev}), 0) AS BIGINT) AS block FROM c1),
q AS (SELECT qid, CAST(sum(pairs) AS BIGINT) AS np FROM c GROUP BY qid HAVING sum(pairs) > 0),
d0 AS (SELECT qid, np, unnest(range(least(np, {k}))) AS i, np - least(np, {k}) AS base FROM q),
d1 AS (SELECT qid, list([base + i, {sql_hnum(sql_h(seed, "'draw'", 'qid', 'i'))} % (base + i + 1)] ORDER BY i) AS ts FROM d0 GROUP BY qid),
d2 AS (SELECT qid, list_reduce(ts, lambda acc, x: list_append(acc, CASE WHEN list_contains(acc, x[2]) THEN x[1] ELSE x[2] END),
       CAST([] AS BIGINT[])) AS s FROM d1),
d AS (SELECT qid, unnest(range(len(s))) AS i, unnest(s) AS idx FROM d2),
x AS (SELECT d.qid, d.i, c.score AS score_w, (d.idx - c.block) // c.above AS m_w, (d.idx - c.block) % c.above AS bp
      FROM d JOIN c ON c.qid = d.qid AND d.idx >= c.block AND d.idx < c.block + c.pairs),
y AS (SELECT x.qid, x.i, x.score_w, x.m_w, c.score AS score_b, x.bp - c.above AS m_b
      FROM x JOIN c ON c.qid = x.qid AND x.bp >= c.above AND x.bp < c.above + c.n),
r AS (SELECT qid, score, aid, row_number() OVER (PARTITION BY qid, score ORDER BY {sql_h(seed, 'qid', 'aid')}, aid) - 1 AS m
      FROM a),
sampled AS (SELECT y.qid, CAST(y.i AS BIGINT) AS pair_no, rb.aid AS aid_j, y.score_b AS score_j,
            rw.aid AS aid_k, y.score_w AS score_k
      FROM y JOIN r rb ON rb.qid = y.qid AND rb.score = y.score_b AND rb.m = y.m_b
             JOIN r rw ON rw.qid = y.qid AND rw.score = y.score_w AND rw.m = y.m_w)"""


QA_SRC = "qa_src AS (SELECT qid, aid, pm_score AS score FROM qa_answers)"


def _qa_src(spark, sf):
    return FX.qa_answers(spark, sf).withColumnRenamed("pm_score", "score")


@register("pairs_all", _with(FX.sql_lines("order_lines", "l_orderkey")) + """,
b AS (SELECT a.qid, count(*) AS n_pairs FROM order_lines a JOIN order_lines b ON a.qid = b.qid AND a.score > b.score GROUP BY 1),
t AS (SELECT a.qid, count(*) AS n_tied FROM order_lines a JOIN order_lines b ON a.qid = b.qid AND a.score = b.score AND a.aid < b.aid GROUP BY 1),
n AS (SELECT qid, count(*) AS n_answers FROM order_lines GROUP BY 1)
SELECT n.qid, n.n_answers, coalesce(b.n_pairs, 0) AS n_pairs, coalesce(t.n_tied, 0) AS n_tied
FROM n LEFT JOIN b ON b.qid = n.qid LEFT JOIN t ON t.qid = n.qid""")
def q_pairs_all(spark, sf):
    """J1 sizes: per order, answers, unequal pairs and dropped ties (the oracle enumerates; Spark counts)."""
    return P.pair_space(FX.order_lines(spark, sf))


@register("pairs_capped", _with(FX.SQL_QA_ANSWERS, QA_SRC, sql_sample_pairs("qa_src")) + "SELECT * FROM sampled")
def q_pairs_capped(spark, sf):
    return P.sample_pairs(_qa_src(spark, sf))


@register("pairs_large_question",
          _with(FX.sql_lines("supplier_lines", "l_suppkey"), sql_sample_pairs("supplier_lines")) + "SELECT * FROM sampled")
def q_pairs_large_question(spark, sf):
    """Few large questions: every supplier's lines, ~n^2/2 candidate pairs each, 10 drawn without enumeration."""
    return P.sample_pairs(FX.supplier_lines(spark, sf))


@register("pairs_orders",
          _with(FX.sql_lines("order_lines", "l_orderkey"), sql_sample_pairs("order_lines")) + "SELECT * FROM sampled")
def q_pairs_orders(spark, sf):
    """Many small questions: lines of each order."""
    return P.sample_pairs(FX.order_lines(spark, sf))


# ---------------------------------------------------------------- prompts and filters

from prefdata.functions import text as TX  # noqa: E402
from prefdata.functions.tokens import TOKEN_PATTERN, token_count, tokens  # noqa: E402
from prefdata.operators import prompts as PR  # noqa: E402
from prefdata.operators import vocab as V  # noqa: E402

SQL_Q = "'Question: '"
SQL_A = "chr(10) || chr(10) || 'Answer: '"
# Caller-supplied prefixes for the prefixed-prompt query (outermost first).
PREFIXES = ("|TRAINING| \n", "Answer in one short paragraph. \n\n")


def sql_ntok(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, '{TOKEN_PATTERN}')) AS INTEGER)"


def sql_clean(x: str) -> str:
    return (f"regexp_replace(regexp_replace({x}, {TX.sql_literal(TX.BLANK_LINES_PATTERN)}, chr(10) || chr(10), 'g'), "
            f"{TX.sql_literal(TX.STRIP_PATTERN)}, '', 'g')")


def _turns(spark, sf):
    return FX.qa_turns(spark, sf)


def _questions(spark, sf):
    return FX.user_turns(spark, sf)


#: A limit that some prompts of the tables exceed.
PROMPT_LIMIT = 32


@register("prompt_question", _with(FX.SQL_USER_TURNS) +
          f"SELECT conv_id, turn, {SQL_Q} || question || {SQL_A} AS query FROM user_turns")
def q_prompt_question(spark, sf):
    return _questions(spark, sf).select("conv_id", "turn", PR.question_prompt("question").alias("query"))


@register("prompt_qa", _with(FX.SQL_QA_TURNS) +
          f"SELECT conv_id, turn, {SQL_Q} || question || {SQL_A} || answer AS text FROM qa_turns")
def q_prompt_qa(spark, sf):
    return _turns(spark, sf).select("conv_id", "turn", PR.qa_text("question", "answer").alias("text"))


@register("prompt_prefixed", _with(FX.SQL_USER_TURNS) +
          f"SELECT conv_id, turn, {' || '.join(TX.sql_literal(p) for p in PREFIXES)} || {SQL_Q} || question || {SQL_A}"
          " AS query FROM user_turns")
def q_prompt_prefixed(spark, sf):
    return _questions(spark, sf).select(
        "conv_id", "turn", PR.add_prefixes(PR.question_prompt("question"), PREFIXES).alias("query"))


@register("query_response", _with(FX.SQL_QA_TURNS) +
          f"SELECT conv_id, turn, {SQL_Q} || question || {SQL_A} || answer AS text FROM qa_turns")
def q_query_response(spark, sf):
    t = _turns(spark, sf)
    return t.select("conv_id", "turn", PR.query_response(PR.question_prompt("question"), "answer").alias("text"))


@register("filter_strict", _with(FX.SQL_USER_TURNS) + f"""SELECT conv_id, turn, n_tokens FROM (
  SELECT conv_id, turn, {sql_ntok(f"{SQL_Q} || question || {SQL_A}")} AS n_tokens FROM user_turns) WHERE n_tokens < {PROMPT_LIMIT}""")
def q_filter_strict(spark, sf):
    t = _questions(spark, sf).select("conv_id", "turn", PR.question_prompt("question").alias("query"))
    return PR.filter_shorter(t, "query", PROMPT_LIMIT, out="n_tokens").select("conv_id", "turn", "n_tokens")


def _qa_pairs_with_text(spark, sf):
    qa = _qa_src(spark, sf)
    questions = FX.qa_questions(spark, sf)
    ids = P.sample_pairs(qa)
    out = P.attach_texts(ids, qa, questions, clean=lambda c: TX.strip_text(TX.collapse_blank_lines(c)))
    return out.withColumn("question", TX.strip_text(TX.collapse_blank_lines("question")))


SQL_QA_PAIRS_TEXT = _with(FX.SQL_QA_QUESTIONS, FX.SQL_QA_ANSWERS, QA_SRC, sql_sample_pairs("qa_src")) + f""",
qtext AS (SELECT qid, question FROM qa_questions),
atext AS (SELECT aid, text FROM qa_answers),
pairs_text AS (
  SELECT s.qid, s.pair_no, s.aid_j, s.aid_k, {sql_clean('q.question')} AS question,
         {sql_clean('j.text')} AS response_j, {sql_clean('k.text')} AS response_k
  FROM sampled s JOIN qtext q ON q.qid = s.qid JOIN atext j ON j.aid = s.aid_j JOIN atext k ON k.aid = s.aid_k)
"""


@register("pairs_with_text", SQL_QA_PAIRS_TEXT + "SELECT * FROM pairs_text")
def q_pairs_with_text(spark, sf):
    return _qa_pairs_with_text(spark, sf).select(
        "qid", "pair_no", "aid_j", "aid_k", "question", "response_j", "response_k")


@register("filter_two_sided", SQL_QA_PAIRS_TEXT + f"""SELECT * FROM (
  SELECT qid, pair_no, {sql_ntok(f"{SQL_Q} || question || {SQL_A} || response_j")} AS n_j,
         {sql_ntok(f"{SQL_Q} || question || {SQL_A} || response_k")} AS n_k FROM pairs_text)
WHERE n_j <= 512 AND n_k <= 512""")
def q_filter_two_sided(spark, sf):
    p = _qa_pairs_with_text(spark, sf)
    p = p.select("qid", "pair_no", PR.qa_text("question", "response_j").alias("tj"),
                 PR.qa_text("question", "response_k").alias("tk"))
    p = PR.filter_both_within(p, "tj", "tk", 512)
    return p.select("qid", "pair_no", token_count("tj").alias("n_j"), token_count("tk").alias("n_k"))


TRUNCATE_AT = 2048


@register("truncate_ids", _with(FX.SQL_DOC_TOKENS) + f"""SELECT doc_id, CAST(len(t) AS INTEGER) AS n_ids,
  CASE WHEN len(t) = 0 THEN NULL ELSE t[len(t)] END AS last_token
FROM (SELECT doc_id, list_slice(toks, 1, {TRUNCATE_AT}) AS t FROM doc_tokens)""")
def q_truncate_ids(spark, sf):
    d = FX.doc_tokens(spark, sf).select("doc_id", PR.truncate_ids("toks", TRUNCATE_AT).alias("t"))
    return d.select("doc_id", F.size("t").alias("n_ids"), F.get("t", F.size("t") - 1).alias("last_token"))


# ---------------------------------------------------------------- vocabulary, encode, decode

SQL_VOCAB = f"""vocab AS (
  SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 2 AS INTEGER) AS id, n
  FROM (SELECT t AS token, count(*) AS n FROM (SELECT unnest(toks) AS t FROM doc_tokens) GROUP BY 1)
  QUALIFY row_number() OVER (ORDER BY n DESC, token) <= {V.MAX_VOCAB - 3})"""
SQL_DOC_UNNEST = """u AS (SELECT doc_id, unnest(toks) AS t, unnest(range(len(toks))) AS pos FROM doc_tokens)"""


def _docs_vocab(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return docs, V.build_vocab(docs, "text")


@register("vocab", _with(FX.SQL_DOC_TOKENS, SQL_VOCAB) + "SELECT token, id, n FROM vocab")
def q_vocab(spark, sf):
    return _docs_vocab(spark, sf)[1]


#: A token outside the vocabulary: the byte of a space, then its UTF-8 bytes, each as MAX_VOCAB + byte.
SQL_SPELLED = f"""array_to_string(list_prepend({V.MAX_VOCAB + 32}, list_transform(range(strlen(u.t)), lambda i:
    {V.MAX_VOCAB} + 16 * (strpos('0123456789ABCDEF', substr(hex(encode(u.t)), 2 * i + 1, 1)) - 1)
    + strpos('0123456789ABCDEF', substr(hex(encode(u.t)), 2 * i + 2, 1)) - 1)), ',')"""
SQL_ENCODED = f"""encoded AS (
  SELECT d.doc_id, CAST(coalesce(x.n_ids, 0) AS INTEGER) AS n_ids, coalesce(x.ids, '') AS ids
  FROM documents d LEFT JOIN (
    SELECT u.doc_id, sum(CASE WHEN v.id IS NULL THEN 1 + strlen(u.t) ELSE 1 END) AS n_ids,
           string_agg(CASE WHEN v.id IS NULL THEN {SQL_SPELLED} ELSE CAST(v.id AS VARCHAR) END, ',' ORDER BY u.pos) AS ids
    FROM u LEFT JOIN vocab v ON v.token = u.t GROUP BY u.doc_id) x ON x.doc_id = d.doc_id)"""


@register("encode", _with(FX.SQL_DOC_TOKENS, SQL_VOCAB, SQL_DOC_UNNEST, SQL_ENCODED) + "SELECT doc_id, n_ids, ids FROM encoded")
def q_encode(spark, sf):
    docs, vocab = _docs_vocab(spark, sf)
    enc = docs.select("doc_id", V.encoder(vocab)("text").alias("ids"))
    return enc.select("doc_id", F.size("ids").alias("n_ids"), F.array_join("ids", ",").alias("ids"))


SQL_PROMPT_TOKENS = f"""prompts AS (SELECT row_number() OVER (ORDER BY conv_id, turn) AS doc_id, conv_id, turn, query,
  regexp_extract_all(query, '{TOKEN_PATTERN}') AS toks
  FROM (SELECT conv_id, turn, {SQL_Q} || text || {SQL_A} AS query FROM conversations WHERE role = 'user')
  WHERE {sql_ntok('query')} < {PROMPT_LIMIT}),
doc_tokens AS (SELECT doc_id, toks FROM prompts)"""


@register("prompt_dataset", _with(SQL_PROMPT_TOKENS, SQL_VOCAB, SQL_DOC_UNNEST, SQL_ENCODED.replace("FROM documents d", "FROM prompts d")) + """
SELECT p.conv_id, p.turn, p.query, e.ids AS input_ids, e.n_ids FROM prompts p JOIN encoded e ON e.doc_id = p.doc_id""")
def q_prompt_dataset(spark, sf):
    """The prompt dataset: queries under the limit and their ids (vocabulary of the kept prompts)."""
    p = _questions(spark, sf).select("conv_id", "turn", PR.question_prompt("question").alias("query"))
    p = PR.filter_shorter(p, "query", PROMPT_LIMIT)
    ids = p.withColumn("ids", V.encoder(V.build_vocab(p, "query"))("query"))
    return ids.select("conv_id", "turn", "query", F.array_join("ids", ",").alias("input_ids"), F.size("ids").alias("n_ids"))


@register("decode", _with(FX.SQL_DOC_TOKENS) + "SELECT doc_id, array_to_string(toks, ' ') AS text FROM doc_tokens")
def q_decode(spark, sf):
    docs, vocab = _docs_vocab(spark, sf)
    enc = docs.select("doc_id", V.encoder(vocab)("text").alias("ids"))
    return enc.select("doc_id", V.decoder(vocab)("ids").alias("text"))


RATIO_ROWS = 400


@register("chars_per_token", f"""WITH o AS ({sql_positions('documents', 'doc_id')})
SELECT count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars,
       CAST(sum({sql_ntok('text')}) AS BIGINT) AS n_tokens,
       CAST(sum(length(text)) AS DOUBLE) / CAST(sum({sql_ntok('text')}) AS DOUBLE) AS ratio
FROM o WHERE pos < {RATIO_ROWS}""")
def q_chars_per_token(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return V.chars_per_token(S.first_n(docs, "doc_id", RATIO_ROWS, SEED), "text")


@register("append_eos", _with(FX.SQL_DOC_TOKENS, SQL_VOCAB, SQL_DOC_UNNEST, SQL_ENCODED) +
          "SELECT doc_id, CAST(n_ids + 1 AS INTEGER) AS n_ids, 1 AS last_id FROM encoded")
def q_append_eos(spark, sf):
    docs, vocab = _docs_vocab(spark, sf)
    ids = V.with_eos(V.encoder(vocab)("text"))
    d = docs.select("doc_id", ids.alias("ids"))
    return d.select("doc_id", F.size("ids").alias("n_ids"), F.element_at("ids", -1).alias("last_id"))


# ---------------------------------------------------------------- packing

from prefdata.functions.tokens import EOS_TOKEN, PAD_TOKEN  # noqa: E402
from prefdata.operators import batches as B  # noqa: E402
from prefdata.operators import buffers as BF  # noqa: E402
from prefdata.operators import metrics as M  # noqa: E402
from prefdata.operators import packing as PK  # noqa: E402

PACK_L = 128
PACK_BUDGET = f"({PACK_L} * {PK.CHARS_PER_TOKEN} * {PK.NUM_OF_SEQUENCES})"


def _doc_toks(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return d, d.select("doc_id", F.concat(tokens("text"), F.array(F.lit(EOS_TOKEN))).alias("toks"))


def sql_pack(epochs: int = 1) -> str:
    ekey = "epoch, doc_id" if epochs > 1 else "doc_id"
    src = (f"(SELECT d.*, e AS epoch FROM documents d, range({epochs}) t(e))" if epochs > 1 else "documents")
    return f"""WITH ns AS (SELECT CAST(floor({epochs} * sum(length(text)) / {PACK_BUDGET}) AS BIGINT) + 1 AS n FROM documents),
dt AS (SELECT {ekey}, list_append(regexp_extract_all(text, '{TOKEN_PATTERN}'), '{EOS_TOKEN}') AS toks,
              {sql_h(SEED, *ekey.split(', '))} AS o FROM {src}),
s AS (SELECT *, CAST({sql_hnum('o')} % (SELECT n FROM ns) AS INTEGER) AS shard, len(toks) AS sz FROM dt),
w AS (SELECT *, CAST(coalesce(sum(sz) OVER (PARTITION BY shard ORDER BY o, {ekey}
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off FROM s),
c AS (SELECT shard, off, sz, toks, unnest(range(off // {PACK_L}, (off + sz - 1) // {PACK_L} + 1)) AS chunk FROM w),
p AS (SELECT shard, chunk, greatest(chunk * {PACK_L}, off) AS lo,
             list_slice(toks, greatest(chunk * {PACK_L}, off) - off + 1, least((chunk + 1) * {PACK_L}, off + sz) - off) AS piece
      FROM c),
blocks AS (SELECT shard, CAST(chunk AS BIGINT) AS chunk, flatten(list(piece ORDER BY lo)) AS ids
           FROM p GROUP BY shard, chunk HAVING len(flatten(list(piece ORDER BY lo))) = {PACK_L})
"""


def _blocks(spark, sf, epochs: int = 1):
    d, dt = _doc_toks(spark, sf)
    keys = ["doc_id"]
    if epochs > 1:
        dt, keys = PK.repeat_epochs(dt, epochs), ["epoch", "doc_id"]
    n = PK.buffer_count(epochs * PK.total_chars(d, "text"), PACK_L)
    return PK.pack(dt, keys, "toks", PACK_L, n, SEED)


@register("pack_blocks", sql_pack() + "SELECT shard, chunk, array_to_string(ids, ' ') AS block FROM blocks")
def q_pack_blocks(spark, sf):
    return _blocks(spark, sf).select("shard", "chunk", F.array_join("input_ids", " ").alias("block"))


BUFFER_L, BUFFER_CHARS = 128, 128 * 4 * 64  # blocks of 128 tokens, 4 characters a token, 64 blocks a buffer


def sql_sequential() -> str:
    return "WITH RECURSIVE " + BF.buffers_sql("documents", "doc_id", "text", BUFFER_CHARS, sql_h(SEED, "doc_id"))


@register("sequential_buffers", sql_sequential() + " SELECT doc_id, buffer FROM buffered")
def q_sequential_buffers(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return BF.sequential_buffers(d, ["doc_id"], "text", BUFFER_CHARS, SEED).select("doc_id", "buffer")


@register("supervised_blocks", sql_sequential() + f""",
dt AS (SELECT doc_id, buffer AS shard, list_append(regexp_extract_all(text, '{TOKEN_PATTERN}'), '{EOS_TOKEN}') AS toks, {sql_h(SEED, 'doc_id')} AS o
       FROM documents JOIN buffered USING (doc_id)),
w AS (SELECT *, len(toks) AS sz, CAST(coalesce(sum(len(toks)) OVER (PARTITION BY shard ORDER BY o, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off FROM dt),
c AS (SELECT shard, off, sz, toks, unnest(range(off // {BUFFER_L}, (off + sz - 1) // {BUFFER_L} + 1)) AS chunk FROM w),
p AS (SELECT shard, chunk, greatest(chunk * {BUFFER_L}, off) AS lo,
             list_slice(toks, greatest(chunk * {BUFFER_L}, off) - off + 1, least((chunk + 1) * {BUFFER_L}, off + sz) - off) AS piece FROM c),
b AS (SELECT shard AS buffer, CAST(chunk AS BIGINT) AS chunk, flatten(list(piece ORDER BY lo)) AS ids FROM p GROUP BY shard, chunk)
SELECT buffer, chunk, array_to_string(ids, ' ') AS input_ids, array_to_string(ids, ' ') AS labels FROM b WHERE len(ids) = {BUFFER_L}""")
def q_supervised_blocks(spark, sf):
    d = BF.sequential_buffers(table(spark, sf, "documents").select("doc_id", "text"), ["doc_id"], "text", BUFFER_CHARS, SEED)
    d = d.withColumn("toks", F.concat(tokens("text"), F.array(F.lit(EOS_TOKEN))))
    blocks = PK.with_labels(PK.pack_buffers(d, ["doc_id"], "toks", "buffer", BUFFER_L, SEED))
    return blocks.select(F.col("shard").alias("buffer"), "chunk", F.array_join("input_ids", " ").alias("input_ids"), F.array_join("labels", " ").alias("labels"))


@register("pack_shuffled", sql_pack() + f"""SELECT shard, chunk,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY {sql_h(SEED, 'shard', 'chunk')}, chunk) - 1 AS INTEGER) AS pos
FROM blocks""")
def q_pack_shuffled(spark, sf):
    return PK.shuffle_blocks(_blocks(spark, sf), SEED).select("shard", "chunk", "pos")


@register("repeat_epochs", sql_pack(2) + "SELECT shard, chunk, array_to_string(ids, ' ') AS block FROM blocks")
def q_repeat_epochs(spark, sf):
    return _blocks(spark, sf, 2).select("shard", "chunk", F.array_join("input_ids", " ").alias("block"))


# ---------------------------------------------------------------- batches and padding

BATCH = 32
SHARD_ROWS = 64
N_FIRST_BATCHES = 3
PAD_TO = 512
PAD_MULTIPLE = 8


def sql_batches(src: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"""bn AS (SELECT count(*) // {SHARD_ROWS} + 1 AS n FROM {src}),
bo AS (SELECT *, {sql_h(SEED, *keys)} AS o FROM {src}),
bs AS (SELECT *, CAST({sql_hnum('o')} % (SELECT n FROM bn) AS INTEGER) AS shard FROM bo),
br AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY o, {k}) - 1 AS r FROM bs),
batched AS (SELECT * EXCLUDE (o, r), CAST(r // {BATCH} AS INTEGER) AS batch_id, CAST(r % {BATCH} AS INTEGER) AS pos FROM br)"""


def _batched_turns(spark, sf, source=FX.user_turns):
    t = source(spark, sf)
    n = B.shard_count(t, SHARD_ROWS)
    return B.assign_batches(t, ["conv_id", "turn"], BATCH, n, SEED), n


@register("batches", _with(FX.SQL_USER_TURNS, sql_batches("user_turns", ["conv_id", "turn"])) +
          "SELECT conv_id, turn, shard, batch_id, pos FROM batched")
def q_batches(spark, sf):
    return _batched_turns(spark, sf)[0].select("conv_id", "turn", "shard", "batch_id", "pos")


@register("collate_lists", _with(FX.SQL_USER_TURNS, sql_batches("user_turns", ["conv_id", "turn"])) + """
SELECT shard, batch_id, CAST(count(*) AS INTEGER) AS n,
       string_agg(CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR), ',' ORDER BY pos) AS keys
FROM batched GROUP BY shard, batch_id""")
def q_collate_lists(spark, sf):
    c = B.collate(_batched_turns(spark, sf)[0], ["conv_id", "turn"])
    keys = F.array_join(F.zip_with("conv_id", "turn", lambda a, b: F.concat_ws(":", a.cast("string"), b.cast("string"))), ",")
    return c.select("shard", "batch_id", "n", keys.alias("keys"))


@register("first_batches", _with(FX.SQL_USER_TURNS, sql_batches("user_turns", ["conv_id", "turn"])) +
          f"SELECT conv_id, turn, shard, batch_id FROM batched WHERE batch_id * (SELECT n FROM bn) + shard < {N_FIRST_BATCHES}")
def q_first_batches(spark, sf):
    b, n = _batched_turns(spark, sf)
    return B.first_batches(b, N_FIRST_BATCHES, n).select("conv_id", "turn", "shard", "batch_id")


@register("length_draw", _with(FX.SQL_USER_TURNS) + f"""SELECT conv_id, turn,
  CAST({B.MIN_GEN_LENGTH} + {sql_hnum(sql_h(SEED, "'len'", 'conv_id', 'turn'))} % {B.MAX_GEN_LENGTH - B.MIN_GEN_LENGTH} AS INTEGER)
  AS gen_len FROM user_turns""")
def q_length_draw(spark, sf):
    return _questions(spark, sf).select("conv_id", "turn", B.length_draw(["conv_id", "turn"], SEED).alias("gen_len"))


def sql_padded(toks: str, n: str, width: str) -> str:
    pads = f"list_transform(range(greatest({width} - {n}, 0)), lambda x: '{PAD_TOKEN}')"
    mask = (f"list_concat(list_transform(range({n}), lambda x: '1'), "
            f"list_transform(range(greatest({width} - {n}, 0)), lambda x: '0'))")
    return (f"CAST(greatest({n}, {width}) AS INTEGER) AS width, CAST(greatest({width} - {n}, 0) AS INTEGER) AS n_pad, "
            f"md5(array_to_string(list_concat({toks}, {pads}), ' ')) AS padded_md5, "
            f"md5(array_to_string({mask}, '')) AS mask_md5")


def _pad_out(df, ids="toks"):
    return df.select("conv_id", "turn", F.size("input_ids").alias("width"),
                     (F.size("input_ids") - F.size(ids)).alias("n_pad"),
                     F.md5(F.array_join("input_ids", " ")).alias("padded_md5"),
                     F.md5(F.array_join("attention_mask", "")).alias("mask_md5"))


SQL_TURN_TOKS = f"""tt AS (SELECT conv_id, turn, regexp_extract_all({SQL_Q} || question || {SQL_A}, '{TOKEN_PATTERN}') AS toks
  FROM user_turns)"""


@register("pad_max", _with(FX.SQL_USER_TURNS, SQL_TURN_TOKS) +
          f"SELECT conv_id, turn, {sql_padded('toks', 'len(toks)', str(PAD_TO))} FROM tt")
def q_pad_max(spark, sf):
    t = _questions(spark, sf).select("conv_id", "turn", tokens(PR.question_prompt("question")).alias("toks"))
    t = t.withColumn("shard", F.lit(0)).withColumn("batch_id", F.lit(0))
    return _pad_out(B.pad_batch(t, "toks", PAD_TOKEN, max_length=PAD_TO))


def _batched_turn_toks(spark, sf):
    b, _ = _batched_turns(spark, sf)
    return b.withColumn("toks", tokens(PR.question_prompt("question")))


def sql_pad_batch(multiple: int | None) -> str:
    width = "mx" if not multiple else f"((mx + {multiple - 1}) // {multiple}) * {multiple}"
    return _with(FX.SQL_USER_TURNS, sql_batches("user_turns", ["conv_id", "turn"])) + f""",
tt AS (SELECT conv_id, turn, shard, batch_id, regexp_extract_all({SQL_Q} || question || {SQL_A}, '{TOKEN_PATTERN}') AS toks
       FROM batched),
tw AS (SELECT *, max(len(toks)) OVER (PARTITION BY shard, batch_id) AS mx FROM tt)
SELECT conv_id, turn, {sql_padded('toks', 'len(toks)', width)} FROM tw"""


@register("pad_longest", sql_pad_batch(None))
def q_pad_longest(spark, sf):
    return _pad_out(B.pad_batch(_batched_turn_toks(spark, sf), "toks", PAD_TOKEN))


@register("pad_multiple", sql_pad_batch(PAD_MULTIPLE))
def q_pad_multiple(spark, sf):
    return _pad_out(B.pad_batch(_batched_turn_toks(spark, sf), "toks", PAD_TOKEN, multiple=PAD_MULTIPLE))


@register("reward_batches", SQL_QA_PAIRS_TEXT + "," + sql_batches("pairs_text", ["qid", "pair_no"]) + f""",
rt AS (SELECT shard, batch_id, {sql_ntok(f"{SQL_Q} || question || {SQL_A} || response_j")} AS n_j,
              {sql_ntok(f"{SQL_Q} || question || {SQL_A} || response_k")} AS n_k FROM batched)
SELECT shard, batch_id, CAST(count(*) AS INTEGER) AS n,
       CAST(((max(n_j) + {PAD_MULTIPLE - 1}) // {PAD_MULTIPLE}) * {PAD_MULTIPLE} AS INTEGER) AS width_j,
       CAST(((max(n_k) + {PAD_MULTIPLE - 1}) // {PAD_MULTIPLE}) * {PAD_MULTIPLE} AS INTEGER) AS width_k,
       true AS return_loss
FROM rt GROUP BY shard, batch_id""")
def q_reward_batches(spark, sf):
    p = _qa_pairs_with_text(spark, sf)
    n = B.shard_count(p, SHARD_ROWS)
    b = B.assign_batches(p, ["qid", "pair_no"], BATCH, n, SEED)
    b = b.withColumn("ids_j", tokens(PR.qa_text("question", "response_j"))).withColumn(
        "ids_k", tokens(PR.qa_text("question", "response_k")))
    b = B.pad_batch(b, "ids_j", PAD_TOKEN, multiple=PAD_MULTIPLE, prefix="j_")
    b = B.pad_batch(b, "ids_k", PAD_TOKEN, multiple=PAD_MULTIPLE, prefix="k_")
    b = PR.with_return_loss(b)
    return b.groupBy("shard", "batch_id").agg(
        F.count(F.lit(1)).cast("int").alias("n"), F.max(F.size("j_input_ids")).alias("width_j"),
        F.max(F.size("k_input_ids")).alias("width_k"), F.first("return_loss").alias("return_loss"))


REWARD_MAX = 256


def _reward_sql(split: str) -> str:
    """The reward stage's rows of one split: pairs of its questions, both sides within the limit, batched and padded side by side."""
    side = lambda x: f"regexp_extract_all({SQL_Q} || question || {SQL_A} || response_{x}, '{TOKEN_PATTERN}')"
    width = lambda x: f"CAST(((max(len(t_{x})) OVER (PARTITION BY shard, batch_id) + {PAD_MULTIPLE - 1}) // {PAD_MULTIPLE}) * {PAD_MULTIPLE} AS INTEGER) AS w_{x}"
    out = lambda x: (f"array_to_string(t_{x}, ' ') || repeat(' {PAD_TOKEN}', w_{x} - len(t_{x})) AS input_ids_{x}, "  # noqa: E731
                     f"rtrim(repeat('1 ', len(t_{x})) || repeat('0 ', w_{x} - len(t_{x}))) AS attention_mask_{x}")
    return SQL_QA_PAIRS_TEXT + f""",
qs AS (SELECT qid, {SPLIT_CASE} AS split FROM ({sql_positions('(SELECT DISTINCT qid FROM qa_answers)', 'qid')})),
sides AS (SELECT p.qid, p.pair_no, {side('j')} AS t_j, {side('k')} AS t_k FROM pairs_text p JOIN qs ON qs.qid = p.qid WHERE qs.split = '{split}'),
src AS (SELECT * FROM sides WHERE len(t_j) <= {REWARD_MAX} AND len(t_k) <= {REWARD_MAX}),""" + sql_batches("src", ["qid", "pair_no"]) + f""",
wide AS (SELECT *, {width('j')}, {width('k')} FROM batched)
SELECT qid, pair_no, shard, batch_id, pos, {out('j')}, {out('k')} FROM wide"""


def _reward_dataset(spark, sf, split: str):
    pairs = _qa_pairs_with_text(spark, sf)
    questions = S.split_exact(_qa_src(spark, sf).select("qid").distinct(), "qid", SEED).filter(F.col("split") == split).select("qid")
    p = pairs.join(questions, "qid").select("qid", "pair_no", PR.qa_text("question", "response_j").alias("text_j"), PR.qa_text("question", "response_k").alias("text_k"))
    p = PR.filter_both_within(p, "text_j", "text_k", REWARD_MAX)
    p = materialize(p, "reward-rows")  # counted and batched
    b = B.assign_batches(p, ["qid", "pair_no"], BATCH, B.shard_count(p, SHARD_ROWS), SEED)
    b = b.withColumn("ids_j", tokens("text_j")).withColumn("ids_k", tokens("text_k"))
    b = B.pad_batch(B.pad_batch(b, "ids_j", PAD_TOKEN, multiple=PAD_MULTIPLE, prefix="j_"), "ids_k", PAD_TOKEN, multiple=PAD_MULTIPLE, prefix="k_")
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), " ")
    return b.select("qid", "pair_no", "shard", "batch_id", "pos", *(text(f"{x}_{c}").alias(f"{c}_{x}") for x in "jk" for c in ("input_ids", "attention_mask")))


@register("reward_train", _reward_sql("reward"))
def q_reward_train(spark, sf):
    return _reward_dataset(spark, sf, "reward")


@register("reward_evaluation", _reward_sql("evaluation"))
def q_reward_evaluation(spark, sf):
    return _reward_dataset(spark, sf, "evaluation")


# ---------------------------------------------------------------- scoring and metrics

REWARD_BASELINE = 2.0


def sql_score(x: str) -> str:
    return f"CAST(length({x}) AS DOUBLE) / (1 + len(regexp_extract_all({x}, '{TOKEN_PATTERN}')))"


@register("score_texts", f"SELECT conv_id, turn, {sql_score('text')} AS score FROM conversations")
def q_score_texts(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", M.scorer()(F.col("text")).alias("score"))


@register("score_pairs", SQL_QA_PAIRS_TEXT + f"""SELECT qid, pair_no,
  {sql_score(f"{SQL_Q} || question || {SQL_A} || response_j")} AS r_j,
  {sql_score(f"{SQL_Q} || question || {SQL_A} || response_k")} AS r_k FROM pairs_text""")
def q_score_pairs(spark, sf):
    p = _qa_pairs_with_text(spark, sf)
    p = p.select("qid", "pair_no", PR.qa_text("question", "response_j").alias("tj"),
                 PR.qa_text("question", "response_k").alias("tk"))
    return M.score_pair(p, "tj", "tk").select("qid", "pair_no", "r_j", "r_k")


SQL_TURN_REWARD = f"""rw AS (SELECT *, {sql_score(f"{SQL_Q} || question || {SQL_A} || answer")} - {REWARD_BASELINE} AS reward
  FROM batched)"""


@register("reward_baseline", _with(FX.SQL_QA_TURNS) + f"""SELECT conv_id, turn,
  {sql_score(f"{SQL_Q} || question || {SQL_A} || answer")} - {REWARD_BASELINE} AS reward FROM qa_turns""")
def q_reward_baseline(spark, sf):
    t = _turns(spark, sf)
    s = M.scorer()(PR.query_response(PR.question_prompt("question"), "answer"))
    return t.select("conv_id", "turn", M.baseline_shift(s, REWARD_BASELINE).alias("reward"))


@register("reward_log", _with(FX.SQL_QA_TURNS, sql_batches("qa_turns", ["conv_id", "turn"]), SQL_TURN_REWARD) + """
SELECT shard, batch_id, count(*) AS n, round(avg(reward), 6) AS mean, round(stddev_pop(reward), 6) AS std,
       round(min(reward), 6) AS min, round(max(reward), 6) AS max FROM rw GROUP BY shard, batch_id""")
def q_reward_log(spark, sf):
    b, _ = _batched_turns(spark, sf, FX.qa_turns)
    s = M.scorer()(PR.query_response(PR.question_prompt("question"), "answer"))
    b = b.withColumn("reward", M.baseline_shift(s, REWARD_BASELINE))
    return M.reward_stats(b, "reward", ["shard", "batch_id"])


SQL_LOSS = "round(avg(greatest(-(r_j - r_k), 0.0) + ln(1.0 + exp(-abs(r_j - r_k)))), 6)"
SQL_ACC = "round(avg(CAST(r_j >= r_k AS DOUBLE)), 6)"
EVAL_EVERY = 500


@register("pair_logloss", _with(FX.SQL_SCORES) + f"SELECT count(*) AS n, {SQL_LOSS} AS loss FROM scores")
def q_pair_logloss(spark, sf):
    return M.pair_metrics(FX.scores(spark, sf)).select("n", "loss")


@register("pair_accuracy", _with(FX.SQL_SCORES) + f"SELECT count(*) AS n, {SQL_ACC} AS accuracy FROM scores")
def q_pair_accuracy(spark, sf):
    return M.pair_metrics(FX.scores(spark, sf)).select("n", "accuracy")


@register("eval_by_step", _with(FX.SQL_SCORES) + f"""SELECT {EVAL_EVERY} * (1 + pair_id % 10) AS step, count(*) AS n,
  {SQL_LOSS} AS loss, {SQL_ACC} AS accuracy FROM scores GROUP BY 1""")
def q_eval_by_step(spark, sf):
    s = FX.scores(spark, sf).withColumn("step", F.lit(EVAL_EVERY) * (F.lit(1) + F.col("pair_id") % 10))
    return M.pair_metrics(s, ["step"])


# ---------------------------------------------------------------- HTML and text cleanup

from prefdata.plans.prepare import html_clean  # noqa: E402


@register("html_to_markdown", f"SELECT page_id, {TX.sql_markdown_native('html')} AS markdown, strlen({TX.sql_markdown_native('html')}) AS n_bytes FROM pages")
def q_html_to_markdown(spark, sf):
    """The cleaner of plan A (T1 - T5) on whole pages; every page has a row."""
    pages = table(spark, sf, "pages").select("page_id", html_clean("html").alias("markdown"))
    return pages.select("page_id", "markdown", F.octet_length("markdown").cast("long").alias("n_bytes"))


@register("markdown_native", f"SELECT page_id, {TX.sql_markdown_native('html')} AS markdown FROM pages")
def q_markdown_native(spark, sf):
    return table(spark, sf, "pages").select("page_id", TX.markdown_native("html").alias("markdown"))


#: Text of a page with every tag replaced by a line break: full of blank lines, and with white space at both ends.
SQL_PAGE_TEXT = "regexp_replace(html, '<[^>]*>', chr(10), 'g')"


def _page_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.regexp_replace("html", "<[^>]*>", "\n").alias("text"))


@register("collapse_blank_lines", f"""SELECT page_id,
  regexp_replace({SQL_PAGE_TEXT}, {TX.sql_literal(TX.BLANK_LINES_PATTERN)}, chr(10) || chr(10), 'g') AS text FROM pages""")
def q_collapse_blank_lines(spark, sf):
    return _page_text(spark, sf).select("page_id", TX.collapse_blank_lines("text").alias("text"))


@register("strip_text",
          f"SELECT page_id, regexp_replace({SQL_PAGE_TEXT}, {TX.sql_literal(TX.STRIP_PATTERN)}, '', 'g') AS text FROM pages")
def q_strip_text(spark, sf):
    return _page_text(spark, sf).select("page_id", TX.strip_text("text").alias("text"))


#: A class attribute as code blocks carry it, from the language of the page.
SQL_PAGE_CLASS = "concat('lang-', regexp_extract(html, '<html lang=\"([^\"]*)\"', 1), ' code-block')"


@register("code_language", f"""SELECT page_id, CASE WHEN c = '' THEN NULL ELSE string_split(c, '-')[-1] END AS lang
FROM (SELECT page_id, regexp_extract({SQL_PAGE_CLASS}, '[^{TX.WHITESPACE_CLASS}]+', 0) AS c FROM pages)""")
def q_code_language(spark, sf):
    css = F.concat(F.lit("lang-"), F.regexp_extract("html", '<html lang="([^"]*)"', 1), F.lit(" code-block"))
    return table(spark, sf, "pages").select("page_id", TX.code_language(css).alias("lang"))


# ---------------------------------------------------------------- shards and sinks (K1-K5)

from prefdata.operators import shards as SH  # noqa: E402
from prefdata.session import materialize, scratch_path  # noqa: E402
from prefdata.sources import sinks as SK  # noqa: E402

SHARD_BYTES_Q = 256 << 10
SQL_DOC_BYTES = "(8 + strlen(text) + strlen(lang) + strlen(source) + 8)"
SQL_SPLIT_IDX = ("CASE WHEN pos < n * 3 // 10 THEN 0 WHEN pos < n * 6 // 10 THEN 1 "
                 "WHEN pos < n * 9 // 10 THEN 2 ELSE 3 END")


@register("shard_plan", f"""WITH o AS ({sql_positions('documents', 'doc_id')})
SELECT {SPLIT_CASE} AS split, CAST(sum({SQL_DOC_BYTES}) AS BIGINT) AS nbytes,
       CAST(sum({SQL_DOC_BYTES}) // {SHARD_BYTES_Q} + 1 AS INTEGER) AS n_shards
FROM o GROUP BY 1""")
def q_shard_plan(spark, sf):
    docs = table(spark, sf, "documents")
    return SH.shard_plan(S.split_exact(docs, "doc_id", SEED), "split", SHARD_BYTES_Q)


SQL_SHARD_ROWS = f"""WITH o AS ({sql_positions('documents', 'doc_id')}),
s AS (SELECT *, {SQL_SPLIT_IDX} AS si FROM o),
t AS (SELECT *, pos - CASE si WHEN 0 THEN 0 WHEN 1 THEN n * 3 // 10 WHEN 2 THEN n * 6 // 10 ELSE n * 9 // 10 END AS p,
             count(*) OVER (PARTITION BY si) AS ssize,
             sum({SQL_DOC_BYTES}) OVER (PARTITION BY si) // {SHARD_BYTES_Q} + 1 AS k FROM s),
u AS (SELECT *, ssize // k AS dv, ssize % k AS md FROM t)
SELECT doc_id, {SPLIT_CASE} AS split,
       CAST(CASE WHEN p < md * (dv + 1) THEN p // (dv + 1) ELSE md + (p - md * (dv + 1)) // dv END AS INTEGER) AS shard
FROM u"""


@register("shard_rows", SQL_SHARD_ROWS)
def q_shard_rows(spark, sf):
    docs = table(spark, sf, "documents")
    return SH.split_and_shard(docs, "doc_id", SEED, SHARD_BYTES_Q).select("doc_id", "split", "shard")


@register("shard_write", f"""WITH x AS ({SQL_SHARD_ROWS})
SELECT split, shard, count(*) AS rows FROM x GROUP BY split, shard""")
def q_shard_write(spark, sf):
    """K3-K5: write the sharded splits under the shared checkpoint folder and read the row counts back."""
    docs = table(spark, sf, "documents")
    path = scratch_path(spark, "shards")
    SK.write_sharded(SH.split_and_shard(docs, "doc_id", SEED, SHARD_BYTES_Q, keep_order=True), path, order_by=S.ORDER_COL)
    back = spark.read.parquet(path)
    return back.groupBy("split", "shard").agg(F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------- streaming

from prefdata.streaming import streams as ST  # noqa: E402

STREAM_WINDOW_SECONDS = 86400
STREAM_WATERMARK_SECONDS = 3600


def _stream(spark, sf, name):
    # a glob, not the file itself: a file stream source lists a folder or a pattern
    path = f"{sf.rstrip('/')}/{name}[.]parquet"
    return ST.read_stream(spark, path, table(spark, sf, name).schema)


@register("stream_split", f"""SELECT event_id, CASE WHEN b < 3 THEN 'finetune' WHEN b < 6 THEN 'reward' WHEN b < 9 THEN 'rl'
  ELSE 'evaluation' END AS split FROM (SELECT event_id, {sql_hnum(sql_h(SEED, 'event_id'))} % 10 AS b FROM events)""")
def q_stream_split(spark, sf):
    s = _stream(spark, sf, "events").select("event_id", ST.hash_split("event_id", SEED).alias("split"))
    return ST.run_to_table(spark, s, "stream-split", partition_by=["split"]).select("event_id", "split")


@register("stream_prompts", f"""SELECT conv_id, turn, query FROM (
  SELECT conv_id, turn, {SQL_Q} || text || {SQL_A} AS query FROM conversations WHERE role = 'user')
WHERE {sql_ntok('query')} < {PROMPT_LIMIT}""")
def q_stream_prompts(spark, sf):
    s = ST.prompts(_stream(spark, sf, "conversations"), PROMPT_LIMIT)
    return ST.run_to_table(spark, s, "stream-prompts")


@register("stream_rewards", f"""SELECT * FROM (
  SELECT CAST(floor(epoch(ts) / {STREAM_WINDOW_SECONDS}) * {STREAM_WINDOW_SECONDS} AS BIGINT) AS window_start, event_type,
         count(*) AS n, round(avg(value), 6) AS mean_value
  FROM events GROUP BY 1, 2)
WHERE window_start + {STREAM_WINDOW_SECONDS} <= (SELECT epoch(max(ts)) FROM events) - {STREAM_WATERMARK_SECONDS}""")
def q_stream_rewards(spark, sf):
    s = ST.windowed_rewards(_stream(spark, sf, "events"), window="1 day", watermark="1 hour")
    return ST.run_to_table(spark, s, "stream-rewards")


# ---------------------------------------------------------------- topic and split scans

from prefdata.sources import tables as TB  # noqa: E402


@register("topic_scan", "SELECT doc_id, source AS topic, n_chars FROM documents WHERE source IN ('src0', 'src7')")
def q_topic_scan(spark, sf):
    """Documents written as one folder per topic; the scan reads the folders of the topics asked for."""
    root = scratch_path(spark, "topics")
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", F.col("source").alias("topic"))
    docs.write.partitionBy("topic").parquet(root)
    return TB.read_topic_folders(spark, root, "src0", "src7").select("doc_id", "topic", "n_chars")


@register("split_scan", f"""WITH o AS ({sql_positions('documents', 'doc_id')})
SELECT doc_id, 'reward' AS split FROM o WHERE {SPLIT_CASE} = 'reward'""")
def q_split_scan(spark, sf):
    """Split folders written once; the filter prunes all but one."""
    root = scratch_path(spark, "splits")
    S.split_exact(table(spark, sf, "documents").select("doc_id"), "doc_id", SEED).write.partitionBy("split").parquet(root)
    return TB.read_split(spark, root, "reward").select("doc_id", "split")


# ---------------------------------------------------------------- flagship plan (O4 + J3 + P4 + G3)

from prefdata.plans import prepare as PA  # noqa: E402


@register("split_pairs", SQL_QA_PAIRS_TEXT + f""",
qs AS (SELECT qid, {SPLIT_CASE} AS split FROM ({sql_positions('(SELECT DISTINCT qid FROM qa_answers)', 'qid')}))
SELECT qs.split, count(*) AS n_pairs, count(DISTINCT p.qid) AS n_questions,
       CAST(sum(length({SQL_Q} || p.question || {SQL_A} || p.response_j)) AS BIGINT) AS n_chars
FROM pairs_text p JOIN qs ON qs.qid = p.qid GROUP BY qs.split""")
def q_split_pairs(spark, sf):
    return PA.paired_split_counts(spark, sf, SEED)


SHARD_BYTES_P = 64 << 10


@register("prepared_threads", _with(FX.SQL_PAGE_THREADS, sql_sample_pairs("qa_src")) + f""",
qs AS (SELECT qid, {SPLIT_CASE} AS split FROM ({sql_positions('page_questions', 'qid')})),
pt AS (SELECT s.qid, s.pair_no, s.aid_j, s.aid_k, qs.split, s.qid || '-' || s.pair_no AS pair_key,
       {TX.sql_markdown_native('q.question')} AS question, {TX.sql_markdown_native('j.text')} AS response_j,
       {TX.sql_markdown_native('k.text')} AS response_k
  FROM sampled s JOIN qs ON qs.qid = s.qid JOIN page_questions q ON q.qid = s.qid
  JOIN page_answers j ON j.qid = s.qid AND j.aid = s.aid_j JOIN page_answers k ON k.qid = s.qid AND k.aid = s.aid_k),
po AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY {sql_h(SEED, 'pair_key')}, pair_key) - 1 AS p,
       count(*) OVER (PARTITION BY split) AS n,
       CAST(sum(48 + strlen(pair_key) + strlen(question) + strlen(response_j) + strlen(response_k)) OVER (PARTITION BY split)
            // {SHARD_BYTES_P} + 1 AS BIGINT) AS k FROM pt),
ps AS (SELECT *, CAST(CASE WHEN p < (n % k) * (n // k + 1) THEN p // (n // k + 1)
                      ELSE n % k + (p - (n % k) * (n // k + 1)) // (n // k) END AS INTEGER) AS shard FROM po)
SELECT qid, pair_no, aid_j, aid_k, question, response_j, response_k, split, shard, p - min(p) OVER (PARTITION BY split, shard) AS place,
       printf('train-%05d-of-%05d', shard, k) AS name FROM ps""")
def q_prepared_threads(spark, sf):
    """Plan A from nested HTML threads to ordered shard files; rows, places and shard names as read back from the files."""
    out = PA.prepared_threads(spark, FX.page_threads(spark, sf), scratch_path(spark, "prepared-shards"), SEED, SHARD_BYTES_P)
    return out.select("qid", "pair_no", "aid_j", "aid_k", "question", "response_j", "response_k", "split", "shard", "place", "name")


STREAM_HOLDOUT = 0.005
HOLDOUT_RESOLUTION = 1_000_000


@register("stream_holdout", f"""SELECT event_id, CASE WHEN {sql_hnum(sql_h(SEED, 'event_id'))} % {HOLDOUT_RESOLUTION}
  < {int(round(STREAM_HOLDOUT * HOLDOUT_RESOLUTION))} THEN 'valid' ELSE 'train' END AS part FROM events""")
def q_stream_holdout(spark, sf):
    """L2 / O5 on a stream: a keyed-hash fraction is the validation part (a stream has no first n rows)."""
    s = _stream(spark, sf, "events").select(
        "event_id", ST.hash_holdout("event_id", STREAM_HOLDOUT, SEED, HOLDOUT_RESOLUTION).alias("part"))
    return ST.run_to_table(spark, s, "stream-holdout")


# ---------------------------------------------------------------- stateful streams, subwords, files

import os  # noqa: E402

from prefdata.operators import subword as SW  # noqa: E402
from prefdata.sources.positions import FilePositions  # noqa: E402
from prefdata.streaming import stateful as SF  # noqa: E402

STREAM_SHARDS, SHUFFLE_BUFFER = 8, 32
ARRIVING_ROWS = 50_000


def _arriving(spark, docs):
    """Stand-in input: ``docs`` as files that arrive one after the other in the order of ``doc_id``.

    One pass writes all files; a stream takes files by their time, so each gets a later one than the file before.
    """
    path = scratch_path(spark, "arriving")
    low, high, n = docs.agg(F.coalesce(F.min("doc_id"), F.lit(0)), F.coalesce(F.max("doc_id"), F.lit(0)), F.count(F.lit(1))).first()
    files = max(4, n // ARRIVING_ROWS)
    share = (F.col("doc_id").cast("double") - F.lit(float(low))) / F.lit(float(high + 1 - low))
    number = F.least(F.floor(share * files), F.lit(files - 1)).cast("int")
    rows = docs.filter(F.col("doc_id").isNotNull()).withColumn("_file", number).repartition(files, "_file").sortWithinPartitions("_file")
    # Small row groups: a file's rows are read by many tasks.
    rows.write.partitionBy("_file").option("parquet.block.size", 8 << 20).option("maxRecordsPerFile", 0).parquet(path)
    SK.arrival_times(spark, [f"{path}/_file={i}" for i in range(files)])
    return path


@register("stream_rewards_closed", f"""SELECT CAST(floor(epoch(ts) / {STREAM_WINDOW_SECONDS}) * {STREAM_WINDOW_SECONDS} AS BIGINT) AS window_start, event_type,
  count(*) AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY 1, 2""")
def q_stream_rewards_closed(spark, sf):
    """X3 to the end of the stream: emitted windows and those still open."""
    root = scratch_path(spark, "stream-rewards-closed")
    out = ST.run_to_table(spark, ST.windowed_rewards(_stream(spark, sf, "events"), window="1 day", watermark="1 hour"), "rewards", root=root)
    return out.unionByName(ST.open_windows(spark, f"{root}/checkpoint"))


SQL_STREAM_SHARD = f"CAST({sql_hnum(sql_h(SEED, 'doc_id'))} % {STREAM_SHARDS} AS INTEGER) AS shard"


@register("stream_shuffle", f"""WITH RECURSIVE src AS (
  SELECT doc_id, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS n FROM (SELECT doc_id, {SQL_STREAM_SHARD} FROM documents)),
walk AS (
  SELECT shard, CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS held, CAST(NULL AS BIGINT) AS emitted FROM (SELECT DISTINCT shard FROM src)
  UNION ALL
  SELECT shard, n + 1,
         CASE WHEN n < {SHUFFLE_BUFFER} THEN list_append(held, doc_id)
              ELSE list_concat(list_append(list_slice(held, 1, j), doc_id), list_slice(held, j + 2, {SHUFFLE_BUFFER})) END,
         CASE WHEN n < {SHUFFLE_BUFFER} THEN NULL ELSE held[j + 1] END
  FROM (SELECT w.*, s.doc_id, {sql_hnum(sql_h(SEED, 'w.shard', 'w.n'))} % {SHUFFLE_BUFFER} AS j
        FROM walk w JOIN src s ON s.shard = w.shard AND s.n = w.n)),
last AS (SELECT shard, n, held FROM walk QUALIFY row_number() OVER (PARTITION BY shard ORDER BY n DESC) = 1),
rest AS (SELECT shard, n - len(held) AS first, unnest(held) AS doc_id, unnest(range(len(held))) AS slot FROM last)
SELECT shard, n - 1 - {SHUFFLE_BUFFER} AS pos, emitted AS doc_id FROM walk WHERE emitted IS NOT NULL
UNION ALL
SELECT shard, first + row_number() OVER (PARTITION BY shard ORDER BY {sql_h(SEED, 'shard', "'end'", 'slot')}, slot) - 1 AS pos, doc_id FROM rest""")
def q_stream_shuffle(spark, sf):
    """O2: documents through the shuffle buffer of a stream, one micro-batch per file; what is held at the end comes last."""
    docs = table(spark, sf, "documents", spread_scan=False).select("doc_id")
    root = scratch_path(spark, "stream-shuffle")
    stream = ST.read_stream(spark, _arriving(spark, docs), docs.schema, 1)
    out = ST.run_to_table(spark, SF.buffered_shuffle(stream, "doc_id", ["doc_id"], STREAM_SHARDS, SHUFFLE_BUFFER, SEED), "shuffle", root=root)
    every = out.unionByName(SF.held_rows(spark, f"{root}/checkpoint", SEED))
    return SF.rows_of(every, docs.schema).select("shard", "pos", "doc_id")


@register("stream_pack", f"""WITH dt AS (SELECT doc_id, {SQL_STREAM_SHARD}, list_append(regexp_extract_all(coalesce(text, ''), '{TOKEN_PATTERN}'), '{EOS_TOKEN}') AS toks FROM documents),
w AS (SELECT *, len(toks) AS sz, CAST(coalesce(sum(len(toks)) OVER (PARTITION BY shard ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off FROM dt),
c AS (SELECT shard, off, sz, toks, unnest(range(off // {PACK_L}, (off + sz - 1) // {PACK_L} + 1)) AS chunk FROM w),
p AS (SELECT shard, chunk, greatest(chunk * {PACK_L}, off) AS lo,
             list_slice(toks, greatest(chunk * {PACK_L}, off) - off + 1, least((chunk + 1) * {PACK_L}, off + sz) - off) AS piece FROM c),
b AS (SELECT shard, CAST(chunk AS BIGINT) AS chunk, flatten(list(piece ORDER BY lo)) AS ids FROM p GROUP BY shard, chunk)
SELECT shard, chunk, array_to_string(ids, ' ') AS block FROM b WHERE len(ids) = {PACK_L}""")
def q_stream_pack(spark, sf):
    """S4 -> T12: documents of a stream packed into full blocks; a shard's unfinished block is carried from batch to batch."""
    docs = table(spark, sf, "documents", spread_scan=False).select("doc_id", "text")
    stream = ST.read_stream(spark, _arriving(spark, docs), docs.schema, 1)
    stream = stream.select("doc_id", F.concat(tokens(F.coalesce("text", F.lit(""))), F.array(F.lit(EOS_TOKEN))).alias("toks"))
    out = ST.run_to_table(spark, SF.pack_stream(stream, "doc_id", ["doc_id"], "toks", PACK_L, STREAM_SHARDS, SEED), "stream-pack")
    return out.select("shard", "chunk", F.array_join("input_ids", " ").alias("block"))


#: A public byte-level vocabulary; another file of the form is named by this variable.
VOCABULARY_FILE = os.environ.get("PREFDATA_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")


@register("subword_decode", "SELECT doc_id, text FROM documents")
def q_subword_decode(spark, sf):
    """Every text to subword ids and back."""
    sub = SW.Subwords(spark, VOCABULARY_FILE)
    return table(spark, sf, "documents").select("doc_id", sub.decode(sub.encode("text", eos=True)).alias("text"))


FILE_SHARDS = 5


def _positions(spark, sf):
    path = scratch_path(spark, "positions")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    docs.repartitionByRange(8, "doc_id").sortWithinPartitions("doc_id").write.parquet(path)
    return FilePositions(spark, path)


SQL_FILE_ORDER = "o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position, count(*) OVER () AS n FROM documents)"


@register("file_take_skip", f"""WITH {SQL_FILE_ORDER}
SELECT CASE WHEN position < n // 10 THEN 'valid' ELSE 'train' END AS part, position, doc_id FROM o""")
def q_file_take_skip(spark, sf):
    """L1/L2: the first tenth of the rows as they lie in the files, and the rest."""
    files = _positions(spark, sf)
    n = files.n_rows // 10
    parts = [rows.select(F.lit(name).alias("part"), "position", "doc_id") for name, rows in (("valid", files.take(n)), ("train", files.skip(n)))]
    return parts[0].unionByName(parts[1])


@register("file_shard", f"""WITH {SQL_FILE_ORDER}, s AS (SELECT *, n // {FILE_SHARDS} AS d, n % {FILE_SHARDS} AS m FROM o)
SELECT position, doc_id FROM s WHERE position >= 2 * d + least(2, m) AND position < 3 * d + least(3, m)""")
def q_file_shard(spark, sf):
    """K2: the third of five contiguous shards in file order; other files are not opened."""
    return _positions(spark, sf).shard(2, FILE_SHARDS).select("position", "doc_id")


@register("published_shards", f"""WITH x AS ({SQL_SHARD_ROWS}), k AS (SELECT split AS s, max(shard) + 1 AS n FROM x GROUP BY 1),
o AS ({sql_positions('documents', 'doc_id')})
SELECT x.split, printf('train-%05d-of-%05d.parquet', shard, k.n) AS name,
       row_number() OVER (PARTITION BY x.split, shard ORDER BY o.pos) - 1 AS place, x.doc_id
FROM x JOIN k ON k.s = x.split JOIN o ON o.doc_id = x.doc_id""")
def q_published_shards(spark, sf):
    """K1-K4: shards as named files; split, name and place as the files themselves give them."""
    path = scratch_path(spark, "published")
    SK.publish_shards(SH.split_and_shard(table(spark, sf, "documents"), "doc_id", SEED, SHARD_BYTES_Q, keep_order=True), path, order_by=S.ORDER_COL)
    return SK.read_published(spark, path).select("split", "name", "place", "doc_id")


TOPIC_KINDS = ("src0", "src1", "src2")


@register("topic_schemas", """SELECT qid, topic, CAST(unnest(range(len(lines))) AS INTEGER) AS aid, question,
  CASE WHEN topic = 'src1' THEN CAST(strlen(unnest(lines)) AS DOUBLE) / 2 ELSE CAST(strlen(unnest(lines)) AS DOUBLE) END AS pm_score,
  CASE WHEN topic = 'src2' THEN lang END AS author, unnest(lines) AS text
FROM (SELECT doc_id AS qid, source AS topic, lang, string_split(text, chr(10)) AS lines,
             CASE WHEN source <> 'src1' THEN lang END AS question FROM documents WHERE source IN ('src0', 'src1', 'src2'))""")
def q_topic_schemas(spark, sf):
    """Topics written with integer, fractional and signed answers, one of them without a question, read as one table."""
    root = scratch_path(spark, "topic-schemas")
    docs = table(spark, sf, "documents").filter(F.col("source").isin(*TOPIC_KINDS))
    size = lambda x: F.octet_length(x)
    answer = {"src0": lambda x: F.struct(size(x).alias("pm_score"), x.alias("text")),
              "src1": lambda x: F.struct((size(x) / 2).alias("pm_score"), x.alias("text")),
              "src2": lambda x: F.struct(x.alias("text"), size(x).cast("long").alias("pm_score"), F.col("lang").alias("author"))}
    for topic in TOPIC_KINDS:
        cols = [F.col("doc_id").alias("qid"), F.transform(F.split("text", "\n", -1), answer[topic]).alias("answers")]
        cols += [F.col("lang").alias("question")] if topic != "src1" else []
        SK.publish_shards(docs.filter(F.col("source") == topic).select(*cols, F.lit(f"{topic}.site").alias("split"), F.lit(0).alias("shard")), f"{root}/{topic}")
    both = TB.read_topics_reconciled(spark, f"{root}/{{{','.join(TOPIC_KINDS)}}}/data", *TOPIC_KINDS, site_suffix=".site")
    flat = both.select("qid", "topic", "question", F.posexplode("answers").alias("aid", "a"))
    return flat.select("qid", "topic", "aid", "question", F.col("a.pm_score").alias("pm_score"), F.col("a.author").alias("author"), F.col("a.text").alias("text"))


SCORE_TOKENS = 40
SQL_CUT = f"""CASE WHEN len(regexp_extract_all(text, '{TOKEN_PATTERN}')) > {SCORE_TOKENS}
  THEN array_to_string(list_slice(regexp_extract_all(text, '{TOKEN_PATTERN}'), 1, {SCORE_TOKENS}), ' ') ELSE text END"""


@register("score_truncated", f"SELECT conv_id, turn, {sql_score('t')} AS score FROM (SELECT conv_id, turn, {SQL_CUT} AS t FROM conversations)")
def q_score_truncated(spark, sf):
    """Scores of texts cut to the model's length."""
    return table(spark, sf, "conversations").select("conv_id", "turn", M.scorer(max_tokens=SCORE_TOKENS)(F.col("text")).alias("score"))


def _lines_of(rows):
    out = rows.assign(line=rows["text"].str.split("\n")).explode("line").dropna(subset=["line"])
    return out.assign(n_chars=out["line"].str.len().astype("int64"))[["doc_id", "line", "n_chars"]]


@register("batched_map", """SELECT doc_id, line, length(line) AS n_chars
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)""")
def q_batched_map(spark, sf):
    """A map over batches of exactly 1000 rows that returns more rows than it gets."""
    return M.map_batches(table(spark, sf, "documents").select("doc_id", "text"), _lines_of, "doc_id long, line string, n_chars long")


EVAL_STEPS = M.eval_steps(10 * EVAL_EVERY, EVAL_EVERY)


@register("eval_first_step", _with(FX.SQL_SCORES) + f"""SELECT CAST(list_extract({EVAL_STEPS}, CAST(pair_id % {len(EVAL_STEPS)} AS BIGINT) + 1) AS INTEGER) AS step,
  count(*) AS n, {SQL_LOSS} AS loss, {SQL_ACC} AS accuracy FROM scores GROUP BY 1""")
def q_eval_first_step(spark, sf):
    """M5: evaluations after the first step and at every 500th."""
    steps = F.array(*[F.lit(s) for s in EVAL_STEPS])
    s = FX.scores(spark, sf).withColumn("step", F.element_at(steps, (F.col("pair_id") % len(EVAL_STEPS) + 1).cast("int")))
    return M.pair_metrics(s, ["step"])
