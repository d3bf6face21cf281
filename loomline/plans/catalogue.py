"""The registered queries: each operator over the given tables, with the SQL that must agree.

Where the tables lack what an operator is about (greetings, code, headings, bad
rows), the same change is made to rows of both sides; no row is left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import template as chat
from ..functions import text as tx
from ..operators import chunking, dedup, gate, layout, leakage, records, resume, split, stats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


# SQL spellings of the text functions.
WS, NOT_WS = tx.WS, tx.NOT_WS
W = "[\\pL\\pN_]"


def s_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def s_norm(x: str) -> str:
    return f"regexp_replace(regexp_replace(lower({x}), '{WS}+', ' ', 'g'), '^ | $', '', 'g')"


def s_hash(x: str) -> str:
    return f"sha256({s_norm(x)})"


def s_sig(x: str) -> str:
    return f"regexp_replace(lower({x}), '{WS}', '', 'g')"


def s_greet(x: str) -> str:
    x = s_strip(x)
    for g in tx.GREETINGS:
        x = s_strip(f"""regexp_replace({x}, '(?i)^{g.replace("'", "''")}', '')""")
    return x


PAIRS_SQL = """pairs AS (
  SELECT conv_id, turn, instruction, response FROM (
    SELECT conv_id, turn, role, text AS instruction, lead(role) OVER w AS next, lead(text) OVER w AS response
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND next = 'assistant')"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, turn, instruction, response: a user's turn and the assistant's next."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.col("text").alias("instruction"), F.lead("role").over(w).alias("next"), F.lead("text").over(w).alias("response"))
    return t.filter("role = 'user' AND next = 'assistant'").select("conv_id", "turn", "instruction", "response")


@query(f"SELECT doc_id, {s_hash('text')} AS text_hash FROM documents")
def text_hash(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", tx.text_hash(F.col("text")).alias("text_hash"))


@query(f"""
SELECT doc_id, len(regexp_extract_all(text, '{NOT_WS}+'))::INT AS n_words, (length(text) // 4)::INT AS tokens, {s_strip("chr(160) || text || chr(12288) || ' ' || chr(10)")} AS stripped FROM documents""")
def text_measures(spark, sf_dir):
    padded = F.concat(F.lit(" "), F.col("text"), F.lit("　 \n"))
    return docs(spark, sf_dir).select("doc_id", tx.word_count(F.col("text")).alias("n_words"), tx.approx_tokens(F.col("text")).alias("tokens"), tx.strip(padded).alias("stripped"))


@query(f"""
SELECT doc_id FROM (SELECT doc_id, {s_sig('text')} AS sig, row_number() OVER (PARTITION BY {s_sig('text')} ORDER BY doc_id) AS n FROM documents) WHERE n = 1 AND sig <> ''""")
def dedup_signature(spark, sf_dir):
    return dedup.by_signature(docs(spark, sf_dir), "text", "doc_id").select("doc_id")


@query(f"SELECT min(doc_id) AS doc_id, {s_hash('text')} AS text_hash FROM documents GROUP BY 2")
def dedup_text_hash(spark, sf_dir):
    hashed = docs(spark, sf_dir).select("doc_id", tx.text_hash(F.col("text")).alias("text_hash"))
    return dedup.first_by(hashed, F.col("text_hash"), "doc_id")


@query(f"""
WITH {PAIRS_SQL}, h AS (SELECT conv_id, turn, {s_hash("instruction || ' || ' || response")} AS example_hash FROM pairs)
SELECT conv_id, turn, example_hash FROM (SELECT *, row_number() OVER (PARTITION BY example_hash ORDER BY conv_id, turn) AS n FROM h) WHERE n = 1""")
def pair_dedup(spark, sf_dir):
    return dedup.by_pair_hash(pairs(spark, sf_dir), "conv_id", "turn").select("conv_id", "turn", "example_hash")


@query(f"SELECT doc_id FROM documents WHERE {s_sig('text')} NOT IN (SELECT {s_sig('text')} FROM benchmark)")
def dedup_seeded(spark, sf_dir):
    return dedup.unseen(docs(spark, sf_dir), table(spark, sf_dir, "benchmark"), "text").select("doc_id")


GATE_SQL = f"""
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 97 = 0 THEN ' ' ELSE text END AS text FROM documents),
m AS (SELECT *, length({s_strip('text')}) AS n, length(text) AS size FROM d),
e AS (SELECT *, CASE WHEN n = 0 THEN 'Field ''text'' is empty or not a string'
                     WHEN n < 50 THEN 'Formatted text too short (' || n || ' chars < 50)' END AS early, {s_hash('text')} AS h FROM m),
f AS (SELECT *, min(CASE WHEN early IS NULL AND size <= 16384 THEN doc_id END) OVER (PARTITION BY h) AS first_ok FROM e),
gated AS (SELECT doc_id, text, CASE WHEN early IS NOT NULL THEN early WHEN doc_id > first_ok THEN 'Duplicate example found'
                     WHEN size > 16384 THEN 'Excessive sequence length (~' || (size // 4) || ' tokens)' END AS reason FROM f)
"""
REPORT_SQL = """SELECT count(*) AS total_count, count(*) - count(reason) AS valid_count, count(reason) AS invalid_count,
  count(*) FILTER (WHERE reason = 'Duplicate example found') AS duplicate_count,
  CASE WHEN count(reason) = 0 AND count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM gated"""


def gated_docs(spark, sf_dir):
    d = docs(spark, sf_dir).withColumn("text", F.when(F.col("doc_id") % 97 == 0, " ").otherwise(F.col("text")))
    return gate.gate_texts(d, order="doc_id", keep=())


@query(GATE_SQL + "SELECT doc_id, reason FROM gated")
def gate_reasons(spark, sf_dir):
    return gated_docs(spark, sf_dir).select("doc_id", "reason")


@query(GATE_SQL + REPORT_SQL)
def gate_report(spark, sf_dir):
    return gate.gate_report(gated_docs(spark, sf_dir))


@query(GATE_SQL + "SELECT doc_id AS index, reason FROM gated WHERE reason IS NOT NULL ORDER BY doc_id LIMIT 20")
def gate_issues(spark, sf_dir):
    return gate.gate_issues(gated_docs(spark, sf_dir), "doc_id").select("index", "reason")


@query(f"""
WITH {PAIRS_SQL},
o AS (SELECT conv_id * 1000 + turn AS ord, CASE WHEN conv_id % 7 = 1 THEN '  ' ELSE instruction END AS instruction,
             CASE WHEN conv_id % 7 = 2 THEN '' WHEN conv_id % 7 = 3 THEN 'short' ELSE response END AS response, conv_id % 7 = 4 AS no_response FROM pairs),
e AS (SELECT *, CASE WHEN length({s_strip('instruction')}) = 0 THEN 'Field ''instruction'' is empty or not a string'
                     WHEN no_response THEN 'Missing required field: ''response'' (or ''text'' for formatted datasets)'
                     WHEN length({s_strip('response')}) = 0 THEN 'Field ''response'' is empty or not a string'
                     WHEN length({s_strip('response')}) < 20 THEN 'Response too short (' || length({s_strip('response')}) || ' chars < 20)' END AS early,
             {s_hash(s_strip('instruction') + " || ' || ' || " + s_strip('response'))} AS h, length(instruction) + length(response) AS size FROM o),
f AS (SELECT *, min(CASE WHEN early IS NULL AND size <= 16384 THEN ord END) OVER (PARTITION BY h) AS first_ok FROM e)
SELECT ord, CASE WHEN early IS NOT NULL THEN early WHEN ord > first_ok THEN 'Duplicate example found'
                 WHEN size > 16384 THEN 'Excessive sequence length (~' || (size // 4) || ' tokens)' END AS reason FROM f""")
def gate_pairs(spark, sf_dir):
    k = F.col("conv_id") % 7
    p = pairs(spark, sf_dir).withColumns({"ord": F.col("conv_id") * 1000 + F.col("turn"), "instruction": F.when(k == 1, "  ").otherwise(F.col("instruction")), "response": F.when(k == 2, "").when(k == 3, "short").otherwise(F.col("response"))})
    return gate.gate_pairs(p, min_length=20, missing={"response": k == 4}, keep=()).select("ord", "reason")


HELLOS = ("Hello! ", " Hi there ", "Certainly! Sure, ", "I'd be happy to help. Let's dive in. ", "Sure,  Great question! ")


@query(f"""
SELECT conv_id, turn, {s_greet("CASE conv_id % 6 " + " ".join(f"WHEN {k} THEN '" + h.replace("'", "''") + "'" for k, h in enumerate(HELLOS)) + " ELSE '' END || text")} AS cleaned FROM conversations""")
def greeting_clean(spark, sf_dir):
    hello = F.element_at(F.array(*[F.lit(h) for h in (*HELLOS, "")]), (F.col("conv_id") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", tx.strip_greetings(F.concat(hello, F.col("text"))).alias("cleaned"))


LABELS = ("easy", "EXPERT", "n/a", "Beginner ", "intermediate", "medium-hard", "ADVANCED", "", " advanced", "Interesting", "hard")
LABEL_SQL = "([" + ", ".join(f"'{x}'" for x in LABELS) + "])[event_id % 11 + 1]"


def labels(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.element_at(F.array(*[F.lit(x) for x in LABELS]), (F.col("event_id") % 11 + 1).cast("int")).alias("label"))


@query(f"""
SELECT event_id, CASE WHEN l LIKE '%begin%' OR l LIKE '%easy%' THEN 'Beginner' WHEN l LIKE '%inter%' OR l LIKE '%med%' THEN 'Intermediate'
  WHEN l LIKE '%adv%' OR l LIKE '%hard%' OR l LIKE '%expert%' THEN 'Advanced' END AS difficulty FROM (SELECT event_id, lower({LABEL_SQL}) AS l FROM events)""")
def difficulty_strict(spark, sf_dir):
    return labels(spark, sf_dir).select("event_id", tx.strict_difficulty(F.col("label")).alias("difficulty"))


@query(f"""
SELECT event_id, CASE trim(lower({LABEL_SQL})) WHEN 'beginner' THEN 'Beginner' WHEN 'advanced' THEN 'Advanced' ELSE 'Intermediate' END AS difficulty FROM events""")
def difficulty_lenient(spark, sf_dir):
    return labels(spark, sf_dir).select("event_id", tx.lenient_difficulty(F.col("label")).alias("difficulty"))


LEVEL_SQL = "CASE conv_id % 4 WHEN 0 THEN 'Beginner' WHEN 1 THEN 'Intermediate' WHEN 2 THEN 'Advanced' ELSE 'beginner' END"


def leveled(spark, sf_dir):
    k = F.col("conv_id") % 4
    level = F.when(k == 0, "Beginner").when(k == 1, "Intermediate").when(k == 2, "Advanced").otherwise("beginner")
    concept = F.when(k == 3, "").otherwise(F.concat(F.lit(" Topic "), (F.col("conv_id") % 13).cast("string"), F.when(k == 1, " ").otherwise("")))
    return pairs(spark, sf_dir).withColumns({"difficulty": level, "concept": concept})


@query(f"""
WITH {PAIRS_SQL}, l AS (SELECT *, {LEVEL_SQL} AS difficulty, CASE WHEN conv_id % 4 = 3 THEN '' ELSE ' Topic ' || (conv_id % 13) || CASE WHEN conv_id % 4 = 1 THEN ' ' ELSE '' END END AS concept FROM pairs)
SELECT count(*) AS total_examples, count(*) FILTER (WHERE difficulty = 'Beginner') AS beginner_count, count(*) FILTER (WHERE difficulty = 'Intermediate') AS intermediate_count,
  count(*) FILTER (WHERE difficulty = 'Advanced') AS advanced_count, coalesce(avg(length(response)), 0) AS average_response_length,
  count(DISTINCT CASE WHEN concept <> '' THEN lower({s_strip('concept')}) END) AS unique_concepts FROM l""")
def dataset_stats(spark, sf_dir):
    return stats.dataset_statistics(leveled(spark, sf_dir))


@query(f"""
WITH {PAIRS_SQL} SELECT count(*) AS total_evaluated, count(*) FILTER (WHERE length(response) > 20) AS valid_responses, sum(length(response)) / greatest(1, count(*)) AS average_response_length FROM pairs""")
def eval_summary(spark, sf_dir):
    return stats.evaluation_summary(pairs(spark, sf_dir), "response")


CODES = ("", "\n    import  os  \n", "`x`\n\t y  z ", "\na = b\nf()\n", "\n# note\n", "hy-\n phen  é-\nà  end", "\n  def f(x):  \n   return  1")


def inject(spark, sf_dir) -> DataFrame:
    extra = F.element_at(F.array(*[F.lit(c) for c in CODES]), (F.col("doc_id") % len(CODES) + 1).cast("int"))
    return docs(spark, sf_dir).select("doc_id", F.concat("text", extra).alias("t"))


def s_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_LINE = f"(?-s)^{WS}*(?:" + "|".join(c.replace(tx.WORD, W) for c in tx.CODE_LINES) + ")"
INJECT_SQL = f"""
WITH i AS (SELECT doc_id, regexp_replace(text || ([{', '.join(s_text(c) for c in CODES)}])[doc_id % {len(CODES)} + 1], '({W}+)-{WS}*\\n{WS}*({W}+)', '\\1\\2', 'g') AS t FROM documents),
c AS (SELECT doc_id, t, string_split(t, chr(10)) AS ls FROM i),
k AS (SELECT *, contains(t, '`') OR len(list_filter(ls, lambda x: regexp_matches(x, '{_LINE}'))) > 0
        OR (({' + '.join(f"contains(t, '{s}')::INT" for s in tx.CODE_SYMBOLS)}) >= 2 AND len(ls) > 1) AS code FROM c)
"""


@query(INJECT_SQL + "SELECT doc_id, code FROM k")
def code_like(spark, sf_dir):
    return inject(spark, sf_dir).select("doc_id", tx.code_like(tx.dehyphenate(F.col("t"))).alias("code"))


@query(
    INJECT_SQL
    + f"""SELECT doc_id, CASE WHEN code THEN {s_strip(f"array_to_string(list_transform(ls, lambda x: regexp_extract(x, '^[ \\t]*') || regexp_replace(regexp_replace(x[length(regexp_extract(x, '^[ \\t]*')) + 1:], '{WS}+$', ''), '[ \\t]+', ' ', 'g')), chr(10))")}
  ELSE {s_strip("regexp_replace(replace(t, chr(10), ' '), '[ \\t]+', ' ', 'g')")} END AS cleaned FROM k"""
)
def segment_clean(spark, sf_dir):
    # DuckDB has no NFKC, so the SQL agrees on texts that it leaves alone; others are tested against Python.
    return inject(spark, sf_dir).select("doc_id", tx.clean_segment(F.col("t")).alias("cleaned"))


@query(f"""
WITH RECURSIVE s AS (SELECT doc_id, string_split(text, chr(10)) AS segs FROM documents),
c AS (SELECT doc_id, segs, list_transform(segs, lambda x: len(regexp_extract_all(x, '{NOT_WS}+'))) AS w, len(segs) AS n FROM s),
p AS (SELECT doc_id, segs, n, list_transform(range(0, n + 1), lambda j: coalesce(list_sum(w[1:j]), 0)) AS p FROM c),
f AS (
  SELECT doc_id, 1 AS k, 0 AS st, coalesce(list_filter(range(0, n), lambda j: p[j + 2] >= 150)[1], n - 1) AS en FROM p
  UNION ALL
  SELECT doc_id, k + 1, st2, coalesce(list_filter(range(en + 1, n), lambda j: p[j + 2] - p[st2 + 1] >= 150)[1], n - 1) FROM (
    SELECT f.doc_id, k, en, p.p, n,
      en + 1 - least(en + 1 - coalesce(list_filter(range(st, en + 1), lambda j: p.p[en + 2] - p.p[j + 1] <= 15)[1], en), en - st) AS st2
    FROM f JOIN p USING (doc_id) WHERE en < n - 1))
SELECT doc_id, format('chunk_{{:03d}}', k) AS chunk_id, st::INT AS st, en::INT AS en, array_to_string(segs[st + 1:en + 1], chr(10) || chr(10)) AS source_chunk FROM f JOIN p USING (doc_id)""")
def chunks(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("text"))).alias("all"))
    made = chunking.chunk_arrays(d, "all", 150, 15)
    return made.select("doc_id", tx.chunk_id(F.col("number")).alias("chunk_id"), "st", "en", F.array_join(F.transform("segs", lambda s: s["text"]), "\n\n").alias("source_chunk"))


def blocks(spark, sf_dir) -> DataFrame:
    """A document's lines as page blocks of 20 a page; every ninth is a heading."""
    lines = docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    y = (F.col("pos") % 20) * 40.0 + 10
    heading = F.concat(F.when(F.col("pos") % 2 == 0, "Chapter ").otherwise("part "), F.when(F.col("pos") % 2 == 0, F.col("pos").cast("string")).otherwise("IV"), F.lit(": "), F.substring("line", 1, 30))
    return lines.select(F.col("doc_id").cast("string").alias("source_book"), F.floor(F.col("pos") / 20).cast("int").alias("page"), F.col("pos").alias("block_ord"), y.alias("y0"), (y + 30).alias("y1"), F.lit(840.0).alias("page_height"), F.when(F.col("pos") % 9 == 4, heading).when(F.col("pos") % 7 == 3, F.concat(F.lit(" oceanofpdf.COM "), F.col("line"))).otherwise(F.col("line")).alias("text"))


BLOCKS_SQL = f"""
WITH l AS (SELECT doc_id, unnest(range(0, len(ls))) AS pos, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
b AS (SELECT doc_id, pos, (pos % 20) * 40.0 + 10 AS y0, CASE WHEN pos % 9 = 4 THEN CASE WHEN pos % 2 = 0 THEN 'Chapter ' || pos ELSE 'part IV' END || ': ' || substr(line, 1, 30)
        WHEN pos % 7 = 3 THEN ' oceanofpdf.COM ' || line ELSE line END AS text FROM l),
body AS (SELECT * FROM (SELECT doc_id, pos, {s_strip("regexp_replace(text, '(?i)OceanofPDF\\.com', '', 'g')")} AS text, y0 FROM b WHERE y0 + 30 >= 50 AND y0 <= 840 - 55) WHERE text <> '')
"""


@query(BLOCKS_SQL + "SELECT doc_id::VARCHAR AS source_book, pos::INT AS block_ord, text FROM body")
def margin_filter(spark, sf_dir):
    return layout.body_blocks(blocks(spark, sf_dir)).select("source_book", "block_ord", "text")


@query(
    BLOCKS_SQL
    + f"""SELECT doc_id::VARCHAR AS source_book, pos::INT AS block_ord, coalesce(last_value(h IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos // 20, y0, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'Preface') AS chapter
FROM (SELECT *, CASE WHEN length(text) <= 120 AND regexp_matches(text, '(?i)^Chapter{WS}+\\p{{Nd}}+[:.]?|^Part{WS}+[IVXLCDM]+[:.]?|(?-i)^\\p{{Nd}}+\\.{WS}+[A-Z][a-zA-Z{tx.WS_RANGES}]+$') THEN text END AS h FROM body)"""
)
def chapter_fill(spark, sf_dir):
    return layout.with_chapters(layout.body_blocks(blocks(spark, sf_dir))).select("source_book", "block_ord", "chapter")


WRAP_SQL = """CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN ' ```json' || chr(10) || props || chr(10) || '``` ' WHEN 2 THEN 'Here it is: ' || props || ' as asked' ELSE substr(props, 1, length(props) - 1) END"""


@query("SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE json_extract(props, '$.k')::BIGINT END AS k FROM events")
def json_extract(spark, sf_dir):
    p = F.col("props")
    k = F.col("event_id") % 4
    answer = F.when(k == 0, p).when(k == 1, F.concat(F.lit(" ```json\n"), p, F.lit("\n``` "))).when(k == 2, F.concat(F.lit("Here it is: "), p, F.lit(" as asked"))).otherwise(p.substr(F.lit(1), F.length(p) - 1))
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(tx.fenced_json(answer), "$.k", "bigint").alias("k"))


def answers(spark, sf_dir) -> DataFrame:
    """Pairs as a generator's answers: good, too short, without a level, a list, nothing."""
    k = F.col("conv_id") % 8
    fields = F.struct(F.col("instruction"), F.when(k == 1, "short").otherwise(F.col("response")).alias("response"), F.lit(" topic ").alias("concept"), F.when(k == 2, "unclear").otherwise("easy one").alias("difficulty"))
    text = F.when(k == 3, F.lit("[1]")).when(k == 4, F.lit("no answer")).when(k == 5, F.lit("{}")).otherwise(F.concat(F.lit("```json\n"), F.to_json(fields), F.lit("\n```")))
    return pairs(spark, sf_dir).select("conv_id", "turn", text.alias("answer"))


@query(f"""
WITH {PAIRS_SQL}, j AS (SELECT conv_id, turn, conv_id % 8 AS k, {s_strip('instruction')} AS i, {s_strip('response')} AS r FROM pairs),
s AS (SELECT *, CASE WHEN k IN (4, 5) THEN 'generation_failed' WHEN k = 3 THEN 'not_an_object' WHEN k IN (1, 2) OR length(i) = 0 OR length(r) < 60 THEN 'invalid' ELSE 'ok' END AS status FROM j)
SELECT conv_id, turn, status, CASE WHEN status = 'ok' THEN i END AS instruction, CASE WHEN status = 'ok' THEN 'topic' END AS concept, CASE WHEN status = 'ok' THEN 'Beginner' END AS difficulty FROM s""")
def strict_validation(spark, sf_dir):
    judged = records.validate_strict(records.parse_answers(answers(spark, sf_dir)), min_response=60)
    return judged.select("conv_id", "turn", "status", "instruction", "concept", "difficulty")


@query(f"""
WITH {PAIRS_SQL}, s AS (SELECT conv_id % 8 AS k, {s_strip('instruction')} AS i, {s_strip('response')} AS r, conv_id * 1000 + turn AS ord FROM pairs),
v AS (SELECT *, CASE WHEN k IN (4, 5) THEN 'generation_failed' WHEN k = 3 THEN 'not_an_object' WHEN k IN (1, 2) OR length(i) = 0 OR length(r) < 60 THEN 'invalid' ELSE 'ok' END AS status FROM s),
d AS (SELECT CASE WHEN status = 'ok' AND row_number() OVER (PARTITION BY status, {s_sig('i')} ORDER BY ord) > 1 THEN 'duplicate' ELSE status END AS status FROM v)
SELECT count(*) AS total_chunks, count(*) FILTER (WHERE status IN ('ok', 'duplicate')) AS processed_chunks, count(*) FILTER (WHERE status NOT IN ('ok', 'duplicate')) AS failed_chunks,
  count(*) FILTER (WHERE status IN ('ok', 'duplicate')) AS generated_examples, count(*) FILTER (WHERE status = 'duplicate') AS duplicates_removed, count(*) FILTER (WHERE status = 'ok') AS final_examples FROM d""")
def gen_report(spark, sf_dir):
    judged = records.validate_strict(records.parse_answers(answers(spark, sf_dir)), min_response=60).withColumn("ord", F.col("conv_id") * 1000 + F.col("turn")).select("ord", "status", "instruction")
    first = dedup.by_signature(judged.filter("status = 'ok'")).select("ord", F.lit(True).alias("first"))
    marked = judged.join(first, "ord", "left").select(F.when((F.col("status") == "ok") & F.col("first").isNull(), "duplicate").otherwise(F.col("status")).alias("status"))
    return stats.generation_report(marked)


@query(f"""
WITH {PAIRS_SQL},
g AS (SELECT 0 AS source_rank, conv_id * 1000 + turn AS ord, instruction AS i, 'Hello! ' || response AS r, 'c' AS c, 'EASY' AS d, conv_id % 5 AS k FROM pairs),
b AS (SELECT 1 AS source_rank, item_id AS ord, text AS i, text AS r, ' bench ' AS c, ' advanced' AS d, item_id % 5 AS k FROM benchmark
      UNION ALL SELECT 1, 1000000 + conv_id * 1000 + turn, instruction, ' Certainly! ' || response, 'c', 'x', 9 FROM pairs),
v AS (SELECT * FROM (SELECT * FROM g UNION ALL SELECT * FROM b) WHERE k NOT IN (1, 2) AND {s_strip('i')} <> '' AND {s_strip('r')} <> ''),
m AS (SELECT source_rank, ord, {s_strip('i')} AS instruction, {s_greet('r')} AS response, {s_strip('c')} AS concept, CASE lower({s_strip('d')}) WHEN 'beginner' THEN 'Beginner' WHEN 'advanced' THEN 'Advanced' ELSE 'Intermediate' END AS difficulty FROM v),
h AS (SELECT *, {s_hash("instruction || ' || ' || response")} AS example_hash FROM m)
SELECT source_rank, ord, difficulty, example_hash FROM (SELECT *, row_number() OVER (PARTITION BY example_hash ORDER BY source_rank, ord) AS n FROM h) WHERE n = 1""")
def merge_pipeline(spark, sf_dir):
    """Conversation pairs as the generated source, benchmark texts and the pairs again as batches; a fifth of the records lack the chapter, a fifth have a null concept."""

    def values(df: DataFrame, i: Column, r: Column, c: str, d: str, k: Column, ord_: Column) -> DataFrame:
        fields = {"instruction": i, "response": r, "concept": F.when(k == 2, F.lit(None)).otherwise(F.lit(c)), "difficulty": F.lit(d), "source_book": F.lit("book")}
        full = F.to_json(F.struct(*[v.alias(n) for n, v in fields.items()], F.lit("one").alias("chapter")), {"ignoreNullFields": "false"})
        bare = F.to_json(F.struct(*[v.alias(n) for n, v in fields.items()]), {"ignoreNullFields": "false"})
        return df.select(ord_.alias("ord"), F.parse_json(F.when(k == 1, bare).otherwise(full)).alias("value"))

    p = pairs(spark, sf_dir)
    place = F.col("conv_id") * 1000 + F.col("turn")
    generated = values(p, F.col("instruction"), F.concat(F.lit("Hello! "), "response"), "c", "EASY", F.col("conv_id") % 5, place)
    bench = values(table(spark, sf_dir, "benchmark"), F.col("text"), F.col("text"), " bench ", " advanced", F.col("item_id") % 5, F.col("item_id"))
    again = values(p, F.col("instruction"), F.concat(F.lit(" Certainly! "), "response"), "c", "x", F.lit(9), place + 1000000)
    return records.merge(generated, bench.union(again)).select("source_rank", "ord", "difficulty", "example_hash")


def s_chat(parts: list[tuple[str, str]], end: str = "") -> str:
    return " || ".join(f"'<|im_start|>{role}' || chr(10) || {x} || '<|im_end|>' || chr(10)" for role, x in parts) + end


@query(f"WITH {PAIRS_SQL} SELECT conv_id, turn, {s_chat([('system', s_text(chat.SYSTEM_PROMPT)), ('user', s_strip('instruction')), ('assistant', s_strip('response'))])} AS text FROM pairs")
def chat_format(spark, sf_dir):
    return pairs(spark, sf_dir).select("conv_id", "turn", chat.chat_text(F.col("instruction"), F.col("response")).alias("text"))


@query(f"""SELECT item_id, {s_chat([('system', s_text(chat.SYSTEM_PROMPT)), ('user', 'text')], " || '<|im_start|>assistant' || chr(10)")} AS prompt FROM benchmark""")
def prompt_format(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", chat.question_prompt(F.col("text")).alias("prompt"))


SPLIT_SQL = "s AS (SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY sha256('42|' || doc_id), doc_id) <= ceil(count(*) OVER () * 0.1 - 1e-9) THEN 'val' ELSE 'train' END AS split FROM documents)"


@query(f"WITH {SPLIT_SQL} SELECT doc_id, split FROM s")
def train_val_split(spark, sf_dir):
    return split.train_val(docs(spark, sf_dir).select("doc_id"), "doc_id")


SIZES_SQL = f"WITH {SPLIT_SQL}, z AS (SELECT count(*) AS total, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'val') AS val FROM s)"


@query(SIZES_SQL + " SELECT * FROM z")
def split_sizes(spark, sf_dir):
    return split.split_sizes(train_val_split(spark, sf_dir))


@query(SIZES_SQL + " SELECT greatest(1, train // 8)::BIGINT AS steps_per_epoch, greatest(5, least(25, greatest(1, train // 8)))::BIGINT AS eval_steps, greatest(10, least(50, 2 * greatest(1, train // 8)))::BIGINT AS save_steps FROM z")
def schedule(spark, sf_dir):
    return split.schedule_rows(split_sizes(spark, sf_dir))


@query(f"""
WITH t AS (SELECT {s_hash('text')} AS h FROM documents UNION SELECT {s_hash("' ' || text || chr(10)")} FROM benchmark WHERE item_id % 4 = 0)
SELECT item_id FROM benchmark WHERE {s_hash('text')} IN (SELECT h FROM t)""")
def leaked_questions(spark, sf_dir):
    """A quarter of the benchmark, with other blanks, is put among the training instructions."""
    bench = table(spark, sf_dir, "benchmark")
    planted = bench.withColumn("instruction", F.when(F.col("item_id") % 4 == 0, F.concat(F.lit(" "), "text", F.lit("\n")))).select(F.lit(None).cast("string").alias("text"), "instruction")
    train = docs(spark, sf_dir).select("text", F.lit(None).cast("string").alias("instruction")).union(planted)
    return leakage.leaked(bench.select("item_id", F.col("text").alias("instruction")), train).select("item_id")


@query(f"SELECT count(*) AS leaked FROM benchmark WHERE {s_hash('text')} IN (SELECT {s_hash('text')} FROM documents)")
def leak_count(spark, sf_dir):
    bench = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("instruction"))
    return leakage.leaked(bench, docs(spark, sf_dir)).agg(F.count("*").alias("leaked"))


def ids(spark, sf_dir) -> DataFrame:
    return docs(spark, sf_dir).select(tx.chunk_id(F.col("doc_id")).alias("chunk_id"), "doc_id")


@query("SELECT format('chunk_{:03d}', doc_id) AS chunk_id FROM documents WHERE doc_id % 3 <> 0 AND doc_id % 5 <> 0")
def resume_pending(spark, sf_dir):
    d = ids(spark, sf_dir)
    return resume.pending(d, d.filter("doc_id % 3 = 0"), d.filter("doc_id % 5 = 0")).select("chunk_id")


@query("""
SELECT format('chunk_{:03d}', doc_id) AS chunk_id, CASE WHEN doc_id % 4 = 0 THEN 'known' ELSE 'new 1' END AS reason, 't' || CASE WHEN doc_id % 4 = 0 THEN 0 ELSE 1 END AS timestamp
FROM documents WHERE doc_id % 4 = 0 OR doc_id % 6 < 3""")
def failed_upsert(spark, sf_dir):
    d = ids(spark, sf_dir)
    row = lambda df, reason, t: df.select("chunk_id", F.lit(reason).alias("reason"), F.lit(t).alias("timestamp"))
    new = d.filter("doc_id % 6 < 3")
    return resume.upsert_failed(row(d.filter("doc_id % 4 = 0"), "known", "t0"), row(new, "new 2", "t2").union(row(new, "new 1", "t1")))


@query(f"""
WITH d AS (SELECT doc_id, {s_norm('text')} AS t, length({s_strip('text')}) AS n, length(text) AS size FROM documents),
f AS (SELECT doc_id, sha256(t) AS text_hash, n, size FROM d)
SELECT doc_id, text_hash FROM (SELECT *, row_number() OVER (PARTITION BY text_hash ORDER BY doc_id) AS k FROM f WHERE n >= 50 AND size <= 16384) WHERE k = 1""")
def clean_corpus(spark, sf_dir):
    """The flagship: normalize, hash, gate, and keep what is valid."""
    gated = gate.gate_texts(docs(spark, sf_dir), order="doc_id", keep=(), hashed="text_hash").filter("reason is null")
    return gated.select("doc_id", "text_hash")
