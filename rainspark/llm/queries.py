"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainspark.llm import chat, decontaminate, fill_middle, lexical, lm_score, packing, quality, sharding, simhash, suffix_dedup, toxicity, url_filter, warc
from rainspark.llm.common import new_path, stage

URL_RULES = [
    url_filter.Rule("allow", "com"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op2_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = packing.pack(table(spark, sf_dir, "documents"), packing.public_vocabulary(), window=2048, end_id=1)
    return got.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "archives")
    warc.write_archives(warc.records(table(spark, sf_dir, "pages"), "page_id", "url", "html"), path)
    got = stage(
        warc.read_pages(spark, path).select(
            "page_id",
            "type",
            "refers_to",
            F.regexp_replace("digest", "^sha1:", "").alias("named"),
            F.octet_length("payload").cast("long").alias("bytes"),
            F.sha1("payload").alias("digest"),
        ),
        "pages",
    )
    originals = got.filter("type = 'response'").groupBy(F.col("page_id").alias("refers_to"), F.col("digest").alias("named"))
    originals = originals.agg(F.first("bytes").alias("original_bytes"))
    return got.join(originals, ["refers_to", "named"], "left").select(
        "page_id",
        F.coalesce("bytes", "original_bytes").alias("payload_bytes"),
        F.when(F.col("type") == "response", F.col("digest"))
        .when(F.col("original_bytes").isNotNull(), F.col("named"))
        .alias("payload_digest"),
        F.col("type").alias("record_type"),
        "refers_to",
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=50)
    return got.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, errors=4)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return got.select("doc_id", digits.alias("fingerprint"), "component_id")


def op6_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.apply_rules(table(spark, sf_dir, "documents"))


def op7_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = sharding.shard_rows(table(spark, sf_dir, "documents"), "doc_id", "text", shards=8)
    return got.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    done = chat.format_conversations(rows.unionByName(extra))
    turns = chat.read_turns(F.col("formatted"))
    joined = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return (
        done.select("conv_id", "valid", turns.alias("turns"), chat.read_loss(F.col("segments")).alias("loss"), "formatted")
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(joined, 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
            "valid",
        )
    )


def op9_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)
    outcomes = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    judged = url_filter.judge(table(spark, sf_dir, "pages"), outcomes, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    got = decontaminate.scan(docs, items, columns=["doc_id"])
    ids = F.array_sort(F.array_distinct("items"))
    return got.select(
        "doc_id",
        "n_words",
        decontaminate.n_hit().alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.coalesce("longest.length", F.lit(0)).alias("longest_words"),
        F.col("longest.doc_word").alias("longest_at"),
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = fill_middle.rearrange_texts(table(spark, sf_dir, "documents"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return got.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")
    )


def op12_blocked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_toxic_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    nearest = F.transform("evidence", lambda e: e["example"])
    return got.select("doc_id", "held_out", "score", "predicted", nearest.alias("nearest_ids"))


OP8_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), s AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS from_end,
         length(role) + length(text) + length('### : ') + length(' </turn>') + 1 AS plain,
         length(role || text) - length(replace(replace(replace(replace(role || text, '\', ''), '#', ''), '<', ''), ':', '')) AS more
  FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(plain + more)::BIGINT AS formatted_chars,
       bool_and(CASE WHEN role = 'system' THEN before IS NULL
                     WHEN role = 'user' THEN before IS NULL OR before IN ('system', 'assistant')
                     WHEN role = 'assistant' THEN coalesce(before = 'user', false) ELSE false END)
         AND bool_or(from_end = 1 AND role = 'assistant') AS valid
FROM s GROUP BY conv_id
"""


OP3_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS n FROM pages
), t AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload) AS top FROM p
)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN n < 1000 OR page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN n < 1000 OR page_id = top THEN NULL ELSE top END AS refers_to
FROM t
"""


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
o AS (SELECT r, unnest(w) AS x, unnest(range(len(w))) AS i FROM s),
g AS (SELECT r, i, CASE WHEN lead(x, 4) OVER p IS NOT NULL THEN concat_ws(' ', x, lead(x, 1) OVER p, lead(x, 2) OVER p, lead(x, 3) OVER p, lead(x, 4) OVER p) END AS five
  FROM o WINDOW p AS (PARTITION BY r ORDER BY i)),
m AS (SELECT r, i, five IS NOT NULL AND count(*) OVER (PARTITION BY r, five) > 1 AS twice FROM g),
n AS (SELECT r, count(*) FILTER (inside) AS n_repeat_words FROM (SELECT r, bool_or(twice) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS inside FROM m) GROUP BY r),
b AS (SELECT s.r, doc_id, len(w)::BIGINT AS n_words, coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
  len(l) AS n_lines, len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z`]|[^\x00-\x7F]'))) AS lettered,
  len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*([-*]|•)'))) AS bullets, len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS cut
  FROM s LEFT JOIN n ON n.r = s.r),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > 3 * n_words OR NOT word_chars BETWEEN 2 * n_words AND 20 * n_words OR (n_dup_lines > 2 AND 100 * n_dup_lines > 30 * n_lines)
    OR 100 * lettered < 60 * n_words OR 100 * bullets > 90 * n_lines OR 100 * cut > 30 * n_lines) AS kept
FROM f
"""


OP9_SQL = r"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
o AS (SELECT doc_id, max(CASE WHEN coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY 1),
h AS (SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$|\.$', '') AS name, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS k
  FROM p LEFT JOIN o ON o.doc_id = p.page_id GROUP BY 1),
h2 AS (SELECT *, coalesce(nullif(regexp_extract(name, '(?:^|\.)((?:ac|co|com|edu|gov|net|org)\.[a-z]{2})$', 1), ''), regexp_extract(name, '([^.]*)$', 1)) AS suffix FROM h),
h3 AS MATERIALIZED (SELECT *, CASE WHEN length(name) > length(suffix) + 1 THEN regexp_extract(substr(name, 1, length(name) - length(suffix) - 1), '([^.]*)$', 1) || '.' || suffix
  ELSE name END AS domain FROM h2),
mean AS (SELECT CASE WHEN sum(n) > 0 THEN (sum(k) + 0.5) / (sum(n) + 1) ELSE 0.0 END AS m FROM h3),
a AS (SELECT suffix, sum(n) AS n, sum(k) AS k, any_value(m) AS m FROM h3, mean GROUP BY 1),
aw AS (SELECT CASE WHEN coalesce(sum(n), 0) = 0 OR coalesce(sum(n * m * (1 - m)), 0) = 0 THEN 20.0 ELSE
  CASE WHEN sum(n * m * (1 - m)) - sum(m * (1 - m)) <= 0 THEN 20.0
  WHEN (sum(n * pow(k / n - m, 2)) - sum(m * (1 - m))) / (sum(n * m * (1 - m)) - sum(m * (1 - m))) <= 0 THEN 20.0
  ELSE least(greatest((1 - (sum(n * pow(k / n - m, 2)) - sum(m * (1 - m))) / (sum(n * m * (1 - m)) - sum(m * (1 - m)))) /
    ((sum(n * pow(k / n - m, 2)) - sum(m * (1 - m))) / (sum(n * m * (1 - m)) - sum(m * (1 - m)))), 1.0), 20.0) END END AS w FROM a WHERE n > 0),
b AS (SELECT domain, h3.suffix, sum(h3.n) AS n, sum(h3.k) AS k, any_value((a.k - dk + w * a.m) / (a.n - dn + w)) AS m FROM h3 JOIN a ON a.suffix = h3.suffix
  JOIN (SELECT domain AS dd, suffix AS ds, sum(n) AS dn, sum(k) AS dk FROM h3 GROUP BY 1, 2) ON dd = domain AND ds = h3.suffix, aw GROUP BY 1, 2),
bw AS (SELECT CASE WHEN coalesce(sum(n), 0) = 0 OR coalesce(sum(n * m * (1 - m)), 0) = 0 THEN 20.0 ELSE
  CASE WHEN sum(n * m * (1 - m)) - sum(m * (1 - m)) <= 0 THEN 20.0
  WHEN (sum(n * pow(k / n - m, 2)) - sum(m * (1 - m))) / (sum(n * m * (1 - m)) - sum(m * (1 - m))) <= 0 THEN 20.0
  ELSE least(greatest((1 - (sum(n * pow(k / n - m, 2)) - sum(m * (1 - m))) / (sum(n * m * (1 - m)) - sum(m * (1 - m)))) /
    ((sum(n * pow(k / n - m, 2)) - sum(m * (1 - m))) / (sum(n * m * (1 - m)) - sum(m * (1 - m)))), 1.0), 20.0) END END AS w FROM b WHERE n > 0),
c AS (SELECT host, h3.n, h3.k, (b.k - h3.k + w * b.m) / (b.n - h3.n + w) AS m FROM h3 JOIN b ON b.domain = h3.domain AND b.suffix = h3.suffix, bw),
cw AS (SELECT CASE WHEN coalesce(sum(n), 0) = 0 OR coalesce(sum(n * m * (1 - m)), 0) = 0 THEN 20.0 ELSE
  CASE WHEN sum(n * m * (1 - m)) - sum(m * (1 - m)) <= 0 THEN 20.0
  WHEN (sum(n * pow(k / n - m, 2)) - sum(m * (1 - m))) / (sum(n * m * (1 - m)) - sum(m * (1 - m))) <= 0 THEN 20.0
  ELSE least(greatest((1 - (sum(n * pow(k / n - m, 2)) - sum(m * (1 - m))) / (sum(n * m * (1 - m)) - sum(m * (1 - m)))) /
    ((sum(n * pow(k / n - m, 2)) - sum(m * (1 - m))) / (sum(n * m * (1 - m)) - sum(m * (1 - m)))), 1.0), 20.0) END END AS w FROM c WHERE n > 0),
q AS (SELECT host, k + w * m AS alpha, n - k + w * (1 - m) AS beta FROM c, cw),
v AS (SELECT host, alpha / (alpha + beta) - sqrt(alpha / (alpha + beta) * (1 - alpha / (alpha + beta)) / (alpha + beta + 1)) > m AS worse FROM q, mean),
r AS (SELECT * FROM (VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'), ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')) t(rule, rhost, rpath, rverdict)),
f AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(rverdict, length(rule)) AS rverdict FROM p JOIN r
  ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY 1)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(rverdict, CASE WHEN worse THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN v ON v.host = p.host LEFT JOIN f ON f.page_id = p.page_id
"""


OP10_SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT row_number() OVER () AS k, CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
widths AS (SELECT DISTINCT least(len(w), 10) AS n FROM b WHERE len(w) > 0),
iw AS (SELECT k, item, n, i, array_to_string(w[i + 1 : i + n], ' ') AS win FROM (SELECT k, item, w, least(len(w), 10) AS n, unnest(range(len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, n, i, array_to_string(w[i + 1 : i + n], ' ') AS win FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, widths WHERE len(w) >= n)),
hit AS MATERIALIZED (SELECT dw.r, iw.k, iw.item, dw.n, dw.i, iw.i AS f FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
words AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY 1),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT r, item FROM hit) GROUP BY 1),
runs AS (SELECT r, k, i, n, i - row_number() OVER (PARTITION BY r, k, i - f ORDER BY i) AS g, i - f AS diag FROM hit),
len_ AS (SELECT r, min(i) AS pos, count(*) - 1 + any_value(n) AS words FROM runs GROUP BY r, k, diag, g),
ig AS MATERIALIZED (SELECT DISTINCT array_to_string(w[i + 1 : i + n], ' ') AS gram FROM (SELECT w, n, unnest(range(len(w) - n + 1)) AS i FROM b, (SELECT unnest(range(1, 10)) AS n) WHERE len(w) >= n)),
dg(r, pos, words) AS (SELECT r, i, 1 FROM (SELECT r, unnest(w) AS gram, unnest(range(len(w))) AS i FROM d) JOIN ig USING (gram)
  UNION ALL SELECT dg.r, pos, words + 1 FROM dg JOIN d ON d.r = dg.r AND words < least(9, len(w) - pos) JOIN ig ON ig.gram = array_to_string(w[pos + 1 : pos + words + 1], ' ')),
long_ AS (SELECT r, max(words) AS longest_words, arg_min(pos, {'w': -words, 'p': pos}) AS longest_at FROM (SELECT r, pos, words FROM len_ UNION ALL SELECT * FROM dg) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, coalesce(longest_words, 0)::BIGINT AS longest_words, longest_at::BIGINT AS longest_at
FROM d LEFT JOIN words ON words.r = d.r LEFT JOIN its ON its.r = d.r LEFT JOIN long_ ON long_.r = d.r
"""


#: Tokens are counted, and cuts found, on the list of tokens; list_sum over a prefix of it gives code points.
OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '(?s)[A-Za-z]+|[^A-Za-z]') AS w FROM d),
x AS (SELECT *, len(w) AS n, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2, ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4 FROM u),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS a, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM x),
s AS (SELECT *, array_to_string(w[1 : a], '') AS pre, array_to_string(w[a + 1 : b], '') AS mid, array_to_string(w[b + 1 : n], '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM s
"""


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
c AS (SELECT count(*) AS rows_, sum(len(w))::BIGINT AS terms_ FROM d WHERE len(w) > 0),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(w) AS term FROM b) GROUP BY ALL),
t AS MATERIALIZED (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, floor(1000 * ln((2 * any_value(rows_) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM t, c GROUP BY term),
s AS (SELECT item_id, r, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * rows_) // terms_))))::BIGINT AS score
  FROM q JOIN t USING (term) JOIN f USING (term), c GROUP BY ALL),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""


def queries():
    return {f.__name__: f for f in (
            op1_deleted_interpolation,
            op2_nnls_packing,
            op3_warc_round_trip,
            op4_suffix_dedup,
            op5_simhash_pigeonring,
            op6_quality_cascade,
            op7_jump_sharding,
            op8_chat_format,
            op9_url_reputation,
            op10_suffix_decontamination,
            op11_fill_in_middle,
            op12_blocked_search,
            op13_toxic_neighbours,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc_round_trip": OP3_SQL,
        "op6_quality_cascade": OP6_SQL,
        "op8_chat_format": OP8_SQL,
        "op9_url_reputation": OP9_SQL,
        "op10_suffix_decontamination": OP10_SQL,
        "op11_fill_in_middle": OP11_SQL,
        "op12_blocked_search": OP12_SQL,
    }
