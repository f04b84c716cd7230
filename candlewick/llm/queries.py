"""The queries of this folder's operators: ``QUERIES`` and ``ORACLES``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from candlewick.llm.best_position import best_documents
from candlewick.llm.chat_format import conversations_in_order, format_chat, read_loss, read_turns
from candlewick.llm.kmeans_tree import nearest
from candlewick.llm.license_scan import LICENCE_TEMPLATES, scan_licences
from candlewick.llm.line_dedup import dedup_lines
from candlewick.llm.mixing import mix_sources
from candlewick.llm.packing import pack
from candlewick.llm.periodic_runs import periodic_runs
from candlewick.llm.rp_forest import embedding_groups
from candlewick.llm.simhash import simhash_groups
from candlewick.llm.toxicity import score_toxicity
from candlewick.llm.url_reputation import judge_urls
from candlewick.llm.warc import read_warc, write_warc
from candlewick.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_TEMPLATE_ROWS = ", ".join(f"({i}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')"
                           for i, (name, text) in enumerate(LICENCE_TEMPLATES))
OP1_SQL = f"""
WITH tw AS (SELECT template, licence, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w
            FROM (VALUES {_TEMPLATE_ROWS}) t(template, licence, text)),
tb AS (SELECT template, licence, len(w) - 1 AS m, b, count(*) AS c
       FROM (SELECT template, licence, w, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM tw)
       GROUP BY ALL),
ts AS (SELECT DISTINCT template, licence, m FROM tb),
d AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
u AS (SELECT doc_id, -1 AS line, text FROM d
      UNION ALL SELECT doc_id, unnest(range(len(lines))), unnest(lines) FROM d WHERE len(lines) > 1),
uw AS (SELECT doc_id, line, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM u),
uc AS (SELECT doc_id, line, w, len(w) - 1 AS n FROM uw
       WHERE len(w) > 1 AND (len(w) - 1) * 1.5 + 1e-9 >= (SELECT min(m) FROM ts)
         AND (len(w) - 1) * 0.8 / 1.2 - 1e-9 <= (SELECT max(m) FROM ts)),
ub AS (SELECT doc_id, line, n, b, count(*) AS c
       FROM (SELECT doc_id, line, n, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM uc)
       GROUP BY ALL),
s AS (SELECT doc_id, line, template, licence, 2.0::DOUBLE * sum(least(ub.c, tb.c)) / (m + n) AS dice
      FROM ub JOIN tb USING (b) GROUP BY doc_id, line, template, licence, m, n),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line, licence ORDER BY dice DESC, template) AS k FROM s WHERE dice >= 0.8)
SELECT doc_id, licence, line::INTEGER AS line, dice, template::INTEGER AS template FROM r WHERE k = 1
"""


@register("op1_license_scan", OP1_SQL)
def op1(spark, sf_dir):
    return scan_licences(table(spark, sf_dir, "documents"), threshold=0.8)


OP2_SQL = """
WITH d AS (SELECT doc_id, coalesce('=' || source, '') AS site, string_split(text, chr(10)) AS raw FROM documents),
l AS (SELECT doc_id, site, unnest(raw) AS raw, unnest(range(len(raw))) AS pos FROM d),
n AS (SELECT doc_id, site, pos, raw, trim(regexp_replace(lower(raw), '[ \\t\\x0B\\f\\r]+', ' ', 'g'), ' ') AS line FROM l),
g AS (SELECT line, min((doc_id, pos)) AS first, count(DISTINCT site) AS sites, len(string_split(line, ' ')) AS words
      FROM n WHERE line <> '' GROUP BY line),
b AS (SELECT line, first FROM g
      WHERE sites >= CASE WHEN words >= 30 THEN 2 WHEN words >= 8 THEN 3 ELSE 10 END),
k AS (SELECT n.*, b.line IS NOT NULL AND (doc_id, pos) <> b.first AS gone FROM n LEFT JOIN b USING (line)),
a AS (SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text,
             count(*) FILTER (gone)::INTEGER AS lines_removed FROM k GROUP BY doc_id)
SELECT d.doc_id, a.text, coalesce(lines_removed, 0) AS lines_removed FROM d LEFT JOIN a ON d.doc_id = a.doc_id
"""


@register("op2_line_dedup", OP2_SQL)
def op2(spark, sf_dir):
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "lines_removed")


@register("op3_embedding_near_dedup")
def op3(spark, sf_dir):
    return embedding_groups(table(spark, sf_dir, "embeddings"), threshold=0.9)


@register("op4_nearest_neighbours")
def op4(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@register("op5_toxicity")
def op5(spark, sf_dir):
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted",
                         F.transform("evidence", lambda e: e["doc_id"]).alias("nearest"))


OP6_SQL = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS tokens FROM documents),
s AS (SELECT source, sum(tokens)::BIGINT AS n FROM d GROUP BY source),
e AS (SELECT source, n, greatest(0.0::DOUBLE, 1 - ln(2.0::DOUBLE) / nullif(ln(max(n) OVER () / (min(n) OVER ())::DOUBLE), 0)) AS a,
             max(n) OVER () AS most FROM s WHERE n > 0),
w AS (SELECT source, n, pow(most / n::DOUBLE, 1 - coalesce(a, 0)) AS epochs FROM e),
p AS (SELECT s.source, coalesce(floor(epochs + 1e-9), 1)::BIGINT AS whole,
             greatest(0, coalesce(floor((epochs - floor(epochs + 1e-9)) * w.n + 0.5), 0)) AS rest
      FROM s LEFT JOIN w ON s.source IS NOT DISTINCT FROM w.source),
x AS (SELECT d.*, whole, rest, coalesce(sum(tokens) OVER (
        PARTITION BY d.source ORDER BY md5('1|' || whole || '|' || coalesce(doc_id::VARCHAR, ''))
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
r AS (SELECT doc_id, source, tokens, unnest(range(whole + CASE WHEN upto < rest THEN 1 ELSE 0 END)) AS block FROM x)
SELECT doc_id, source, tokens::BIGINT AS mix_tokens, block::BIGINT AS mix_block,
       md5('1|' || block || '|' || coalesce(doc_id::VARCHAR, '')) AS mix_order
FROM r
"""


@register("op6_source_mixing", OP6_SQL)
def op6(spark, sf_dir):
    mixed = mix_sources(table(spark, sf_dir, "documents"), max_epochs=2.0)
    return mixed.select("doc_id", "source", "mix_tokens", "mix_block", "mix_order")


#: the rules of the contract
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

OP7_SQL = """
WITH p AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
h AS (SELECT host, count(quality) AS n, coalesce(sum(quality), 0)::BIGINT AS k,
             array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
             string_split(host, '.')[-1] AS suffix
      FROM u LEFT JOIN labels ON page_id = doc_id GROUP BY host),
d AS (SELECT suffix, domain, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k FROM h GROUP BY ALL),
t AS (SELECT suffix, sum(n)::BIGINT AS n, sum(k)::BIGINT AS k FROM d GROUP BY ALL),
g AS (SELECT 'h' AS lev, n, k FROM h UNION ALL SELECT 'd', n, k FROM d UNION ALL SELECT 't', n, k FROM t),
m AS (SELECT lev, sum(n)::DOUBLE AS s, sum(k)::DOUBLE / nullif(sum(n), 0) AS p, sum(n * n)::DOUBLE AS q,
             sum(CASE WHEN n > 0 THEN (k * k)::DOUBLE / n END) AS r, count(*) FILTER (n > 0) - 1 AS f FROM g GROUP BY lev),
e AS (SELECT lev, f, (r - s * p * p) / nullif(p * (1 - p), 0) AS spread, s - q / nullif(s, 0) - f AS extra FROM m),
c AS (SELECT lev, 1 / least(0.5::DOUBLE, greatest(1.0::DOUBLE / 1001, coalesce(
             CASE WHEN extra > 0 THEN (spread - f) / extra END, 0.5::DOUBLE))) - 1 AS st FROM e),
tp AS (SELECT suffix, (st * prior + k) / (st + n) AS share
       FROM t, (SELECT (sum(k) + 0.5::DOUBLE) / (sum(n) + 1) AS prior FROM t), (SELECT st FROM c WHERE lev = 't')),
dp AS (SELECT d.suffix, d.domain, (st * tp.share + k) / (st + n) AS share
       FROM d JOIN tp USING (suffix), (SELECT st FROM c WHERE lev = 'd')),
hp AS (SELECT host, n, (st * dp.share + k) / (st + n) AS share, st + n AS whole
       FROM h JOIN dp USING (suffix, domain), (SELECT st FROM c WHERE lev = 'h')),
hb AS (SELECT host, n, share - 1.645::DOUBLE * sqrt(share * (1 - share) / (whole + 1)) AS bound FROM hp),
rules(v, rule, own, start) AS (VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
   ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
x AS (SELECT host, path, arg_max(rule, len(rule)) AS rule, arg_max(v, len(rule)) AS v
      FROM (SELECT DISTINCT host, path FROM u), rules
      WHERE (host = own OR ends_with(host, '.' || own)) AND starts_with(path, start) GROUP BY ALL)
SELECT page_id, u.host, u.path, x.rule, coalesce(x.v, CASE WHEN bound >= 0.6 THEN 'allow' ELSE 'block' END) AS verdict,
       n AS labelled
FROM u JOIN hb ON u.host = hb.host LEFT JOIN x ON u.host = x.host AND u.path = x.path
"""


@register("op7_url_filters", OP7_SQL)
def op7(spark, sf_dir):
    judged = judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), rules=URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "labelled")


OP8_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
m AS (
  SELECT *, CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 14 WHEN 'assistant' THEN 8
            ELSE 17 + length(replace(replace(replace(role, '&', '&amp;'), '<', '&#60;'), '[', '&#91;')) END
         + length(replace(replace(replace(text, '&', '&amp;'), '<', '&#60;'), '[', '&#91;')) AS chars,
         coalesce(lag(role) OVER w, 'start') || '>' || role IN
           ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user') AS fits,
         lead(role) OVER w IS NULL AND role <> 'assistant' AS cut
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars, bool_and(fits) AND NOT bool_or(cut) AS valid
FROM m GROUP BY conv_id
"""


@register("op8_chat_formatting", OP8_SQL)
def op8(spark, sf_dir):
    extra = spark.sql("SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), "
                      "(-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS v(conv_id, turn, role, text)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    chats = format_chat(rows)
    back = chats.select("*", read_turns(F.col("formatted")).alias("turns"),
                        read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    listed = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(listed, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


@register("op9_simhash_near_dedup")
def op9(spark, sf_dir):
    return simhash_groups(table(spark, sf_dir, "documents"), shingle_words=4, radius=4)


@register("op10_packing")
def op10(spark, sf_dir):
    pieces = pack(table(spark, sf_dir, "documents"), sequence_tokens=4096)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


OP11_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (SELECT *, list_reduce(list_transform(range(1, 41), lambda i:
        right('000' || bin(strpos('0123456789abcdef', substr(hex, i, 1)) - 1), 4)), lambda x, y: x || y) AS bits FROM p),
d AS (SELECT *, list_reduce(list_transform(range(32), lambda g: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + 16 * substr(bits, 5 * g + 1, 1)::INTEGER + 8 * substr(bits, 5 * g + 2, 1)::INTEGER + 4 * substr(bits, 5 * g + 3, 1)::INTEGER
          + 2 * substr(bits, 5 * g + 4, 1)::INTEGER + substr(bits, 5 * g + 5, 1)::INTEGER, 1)), lambda x, y: x || y) AS digest FROM b),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM d)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to, 'ok' AS status
FROM f
"""


@register("op11_warc", OP11_SQL)
def op11(spark, sf_dir):
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/candlewick-warc-{uuid.uuid4().hex}"
    write_warc(table(spark, sf_dir, "pages"), folder, min_revisit_bytes=0)
    records = read_warc(spark, folder, payloads=False).filter("warc_type <> 'warcinfo'")
    return records.select("page_id", "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"),
                          F.col("refers_to_page").alias("refers_to"), "status")


OP12_SQL = """
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM n),
i AS (SELECT item_id, term, count(*) AS r FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark) q GROUP BY ALL),
p AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM i) GROUP BY ALL),
f AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, s GROUP BY term, docs),
g AS (SELECT term, doc_id, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))) AS x
      FROM p JOIN n USING (doc_id) JOIN f USING (term), s),
c AS (SELECT item_id, doc_id, sum(r * x)::BIGINT AS score FROM i JOIN g USING (term) GROUP BY ALL HAVING sum(r * x) > 0),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM c)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 20
"""


@register("op12_ranked_search", OP12_SQL)
def op12(spark, sf_dir):
    return best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


#: CRC-32 of a doc_id as text, bit by bit (reflected polynomial 0xEDB88320)
CRC32_SQL = """xor(4294967295::BIGINT, list_reduce(
  list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT),
  lambda crc, byte: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda k, z: xor(k >> 1, 3988292384::BIGINT * (k & 1)),
                                xor(crc, byte)), 4294967295::BIGINT))"""

OP13_SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+') AS v, {CRC32_SQL} AS h FROM documents),
a AS (SELECT *, len(v) AS n, CASE WHEN h % 10 = 0 AND len(v) > 0 THEN (h // 10) % len(v) END AS a FROM v),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM a),
w AS (SELECT rid, doc_id, n, CASE WHEN a IS NULL THEN v
             ELSE list_transform(range(n), lambda i: v[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM p),
-- words as numbers of their first place: a gram is five numbers
t AS (SELECT rid, n, unnest(w) AS x, unnest(range(n)) AS i FROM w),
f AS (SELECT rid, i, lead(x, 4) OVER o IS NOT NULL AS whole,
             md5_number(concat_ws(' ', x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o)) AS g
      FROM t WINDOW o AS (PARTITION BY rid ORDER BY i)),
e AS (SELECT l.rid, l.i, r.i - l.i AS d FROM f l JOIN f r ON l.rid = r.rid AND l.g = r.g AND l.i < r.i
      WHERE l.whole AND r.whole),
s AS (SELECT rid, d, min(i) AS start, count(*) + 4 + d AS length
      FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, d ORDER BY i) AS island FROM e) q
      GROUP BY rid, d, island HAVING count(*) + 4 + d >= greatest(6, 4 * d)),
r AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM s z WHERE z.rid = s.rid AND z.d < s.d AND z.start <= s.start
                                        AND z.start + z.length >= s.start + s.length)),
b AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY (length * 1000000000000) // d DESC, start, d) AS k FROM r),
o AS (SELECT rid, count(*) AS n_runs, max(start) FILTER (k = 1) AS start, max(length) FILTER (k = 1) AS length,
             max(d) FILTER (k = 1) AS period, string_agg(start || ',' || length || ',' || d || chr(10), '' ORDER BY start, d) AS said
      FROM b GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(start + d, start + length)) AS i FROM r),
c AS (SELECT rid, string_agg(x, ' ' ORDER BY i) AS kept FROM t ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT w.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
       (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(said, '')) AS runs_sha256,
       sha256(coalesce(kept, '')) AS collapsed_sha256
FROM w LEFT JOIN o ON w.rid = o.rid LEFT JOIN c ON w.rid = c.rid
"""


def repeated_tails(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``: of every tenth text (by crc32 of its id) the words from some
    place on repeat the first of them."""
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", words.alias("w"), h.alias("h")).withColumn("n", F.size("w").cast("long"))
    g = F.floor(F.col("h") / 10).cast("long")
    first = F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), g % F.greatest("n", F.lit(1)))
    unit = 1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8)).cast("long")
    cut = chosen.withColumn("a", first).withColumn("p", unit)
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", F.col("a").cast("int") + 1, F.col("p").cast("int")), times)),
                   1, (F.col("n") - F.col("a")).cast("int"))
    text = F.concat_ws(" ", F.slice("w", F.lit(1), F.col("a").cast("int")), tail)
    return cut.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(text).alias("text"))


@register("op13_periodic_runs", OP13_SQL)
def op13(spark, sf_dir):
    found = periodic_runs(repeated_tails(table(spark, sf_dir, "documents")), min_length=6, min_exponent=4)
    main = {c: F.col(f"main_run.{c}") for c in ("start", "length", "period")}
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *(r[c].cast("string") for c in main)), F.lit("\n"))))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *(c.alias(k) for k, c in main.items()),
                        F.expr("(1000 * main_run.length) div main_run.period").alias("exponent_milli"),
                        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
