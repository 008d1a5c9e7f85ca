"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import stored, table


#: Words that a proximity match of op9 may be off.
NEAR_SLOP = 3


def _store(spark: SparkSession, name: str):
    return lambda df: stored(spark, df, name)


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.quality import quality_rules

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out = quality_rules(docs, keep_columns=["doc_id"], store=_store(spark, "quality"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


def q_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.shards import minimax_shards

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = minimax_shards(spark, docs, _store(spark, "shards"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def q_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.lang_id import identify_language

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn(
        "held_out", F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    out = identify_language(docs.select("doc_id", "text", "held_out"), docs.filter(~F.col("held_out")))
    return out.select("doc_id", "held_out", "lang_pred", "score")


def q_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.token_counts import count_tokens, model_path

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(spark, docs, _store(spark, "tokens"), model_path())


def q_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.html_text import extract_main_text

    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = extract_main_text(pages, _store(spark, "templates"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.simhash import simhash_components

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = simhash_components(spark, docs, _store(spark, "simhash"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def q_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.mixing import mix, taken

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = mix(docs, _store(spark, "mixing"), keep_columns=["doc_id"])
    return out.select("doc_id", "size", "source_size", "target", taken(F.col("copies")).alias("taken"),
                      F.transform("copies", lambda c: c["shard"]).alias("shards"))


def q_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.decontam import decontaminate

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate(spark, docs, table(spark, sf_dir, "benchmark"), _store(spark, "decontam"), slop=NEAR_SLOP)
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near",
                      F.array_join("near_ids", ",").alias("near_ids"))


def q_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.warc import read_archives, write_archives

    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = read_archives(write_archives(spark, pages, _store(spark, "manifest")), payloads=False)
    return out.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.toxicity import score_toxicity

    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out)
    labels = table(spark, sf_dir, "labels").filter(~held_out)
    out = score_toxicity(docs, docs.select("doc_id", "text"), labels)
    return out.select("doc_id", "held_out", "score", "predicted", "toxic_spans")


def q_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.target_resampling import resample

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(spark, docs, table(spark, sf_dir, "benchmark"), _store(spark, "resampling"))


def q_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.merkle import compare_with_next

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return compare_with_next(spark, docs, _store(spark, "merkle"))


def q_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.collocations import collocations

    docs = table(spark, sf_dir, "documents").select("text", "lang")
    return collocations(spark, docs, _store(spark, "collocations"))


QUERIES = {
    "op1_lang_id": q_lang_id,
    "op2_token_counts": q_token_counts,
    "op3_html_text": q_html_text,
    "op4_simhash_golay": q_simhash,
    "op5_mixing_tree": q_mixing,
    "op6_toxicity_crf": q_toxicity,
    "op7_quality_quantiles": q_quality,
    "op8_minimax_shards": q_shards,
    "op9_decontamination": q_decontaminate,
    "op10_warc_zip": q_warc,
    "op11_target_resampling": q_resampling,
    "op12_merkle_fingerprints": q_merkle,
    "op13_collocations": q_collocations,
}

_WORDS = r"[^\x20\x09-\x0D]+"

ORACLES = {
    "op7_quality_quantiles": rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS ws
  FROM documents
), l AS (
  SELECT rid, [x for x in string_split(t, chr(10)) if regexp_matches(x, '{_WORDS}')] AS ls FROM d
), g AS (
  SELECT rid, p, ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] AS w3
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS p FROM d WHERE len(ws) >= 3)
), rep AS (
  SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, w3) AS c FROM g) WHERE c > 1
), cov AS (
  SELECT rid, sum(least(3, coalesce(nxt - p, 3))) AS n_repeat_words
  FROM (SELECT rid, p, lead(p) OVER (PARTITION BY rid ORDER BY p) AS nxt FROM rep) GROUP BY rid
), m AS (
  SELECT d.rid, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(list_aggregate(list_concat(ws, ['']), 'string_agg', '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN l USING (rid) LEFT JOIN cov USING (rid)
), r AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         [n_symbols * 1000 // greatest(n_words, 1), n_dup_lines * 1000 // greatest(n_lines, 1),
          n_repeat_words * 1000 // greatest(n_words, 1), word_chars * 100 // greatest(n_words, 1)] AS sig
  FROM m
), s AS (
  SELECT lang, source, i AS signal, sig[i] AS v FROM r, (SELECT unnest(range(1, 5)) AS i) WHERE NOT base_failed
), b AS (
  SELECT lang, source, signal,
         CASE WHEN v < 64 THEN v ELSE (length(bin(v)) - 6) * 32 + (v >> (length(bin(v)) - 6)) END AS bucket
  FROM s
), q AS (
  SELECT grouping(lang) AS no_lang, grouping(source) AS no_source, lang, source, signal, count(*) AS total,
         quantile_disc(bucket, 0.25) AS b1, quantile_disc(bucket, 0.75) AS b3
  FROM b GROUP BY GROUPING SETS ((lang, source, signal), (lang, signal), (signal))
), v AS (
  SELECT no_lang, no_source, lang, source, signal, total,
         CASE WHEN b1 < 64 THEN b1 ELSE (b1 - (b1 - 32) // 32 * 32) << CAST((b1 - 32) // 32 AS INT) END AS q1,
         CASE WHEN b3 < 64 THEN b3 ELSE (b3 - (b3 - 32) // 32 * 32) << CAST((b3 - 32) // 32 AS INT) END AS q3
  FROM q
), p AS (
  SELECT o.lang, o.source, o.signal,
         CASE WHEN o.total >= 100 THEN o.q1 WHEN g.total >= 100 THEN g.q1 ELSE a.q1 END AS q1,
         CASE WHEN o.total >= 100 THEN o.q3 WHEN g.total >= 100 THEN g.q3 ELSE a.q3 END AS q3
  FROM v o
  LEFT JOIN v g ON g.no_source = 1 AND g.no_lang = 0 AND g.lang IS NOT DISTINCT FROM o.lang AND g.signal = o.signal
  LEFT JOIN v a ON a.no_lang = 1 AND a.signal = o.signal
  WHERE o.no_source = 0
), f AS (
  SELECT lang, source, signal, q1 - 6 * greatest(q3 - q1, [10, 100, 80, 30][signal]) AS lo,
         q3 + 6 * greatest(q3 - q1, [10, 100, 80, 30][signal]) AS hi
  FROM p
), bad AS (
  SELECT DISTINCT rid FROM (SELECT rid, lang, source, i AS signal, sig[i] AS v
                            FROM r, (SELECT unnest(range(1, 5)) AS i)) x
  JOIN f ON f.lang IS NOT DISTINCT FROM x.lang AND f.source IS NOT DISTINCT FROM x.source AND f.signal = x.signal
  WHERE v > hi OR (x.signal = 4 AND v < lo)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rid NOT IN (SELECT rid FROM bad) AS kept
FROM r
""",
    "op9_decontamination": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, n, list_aggregate(ws[p : p + n - 1], 'string_agg', ' ') AS w
  FROM (SELECT item_id, ws, least(10, len(ws)) AS n, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS p
        FROM b WHERE len(ws) > 0)
), dw AS (
  SELECT rid, n, p, list_aggregate(ws[p : p + n - 1], 'string_agg', ' ') AS w
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS p
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(ws) >= n)
), m AS (
  SELECT rid, item_id, p, dw.n FROM dw JOIN bw ON bw.n = dw.n AND bw.w = dw.w
), hits AS (
  SELECT rid, count(DISTINCT x) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS x FROM m) GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM m) GROUP BY rid
), it AS (  -- from here: two of the two rarest words of an item's windows, as far apart as in the item, give or take 3
  SELECT row_number() OVER () AS item, ws, len(ws) AS n FROM (SELECT DISTINCT ws FROM b WHERE len(ws) > 0)
), freq AS (
  SELECT term, count(*) AS f FROM (SELECT unnest(ws) AS term FROM d) GROUP BY term
), st AS (
  SELECT item, term, off, coalesce(f, 0) AS f, unnest(range(greatest(0, off - 9), least(off, greatest(0, n - 10)) + 1)) AS start
  FROM (SELECT item, n, unnest(ws) AS term, generate_subscripts(ws, 1) - 1 AS off FROM it) LEFT JOIN freq USING (term)
), an AS (
  SELECT DISTINCT item, term, off
  FROM (SELECT *, row_number() OVER (PARTITION BY item, start ORDER BY f, term, off) AS k, min(f) OVER (PARTITION BY item, start) AS least_f FROM st)
  WHERE k <= 2 AND least_f > 0
), ls AS (
  SELECT rid, item, pos, off, pos - off AS delta
  FROM (SELECT rid, unnest(ws) AS term, generate_subscripts(ws, 1) - 1 AS pos FROM d) JOIN an USING (term)
), nr AS (
  SELECT DISTINCT x.rid, x.item FROM ls x JOIN ls y ON x.rid = y.rid AND x.item = y.item
  AND y.delta BETWEEN x.delta - 3 AND x.delta AND x.pos <> y.pos AND x.off <> y.off
), near AS (
  SELECT rid, count(*) AS n_near, string_agg(i, ',' ORDER BY i) AS near_ids FROM (
    SELECT rid, CAST(item_id AS VARCHAR) AS i FROM nr JOIN it USING (item) JOIN b ON b.ws = it.ws WHERE item_id IS NOT NULL
    UNION SELECT rid, CAST(item_id AS VARCHAR) FROM m WHERE item_id IS NOT NULL) GROUP BY rid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(n_near, 0) AS n_near, coalesce(near_ids, '') AS near_ids
FROM d LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid) LEFT JOIN near USING (rid)
""",
    "op10_warc_zip": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS x FROM pages
), r AS (
  SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, x, max(page_id) OVER (PARTITION BY t) AS last FROM p
), c AS (
  SELECT page_id, i, CAST('0x' || substr(x, 5 * i + 1, 5) AS BIGINT) AS v FROM r, (SELECT unnest(range(8)) AS i)
), e AS (
  SELECT page_id, string_agg(substr(a, CAST(v // 32768 AS INT) + 1, 1) || substr(a, CAST(v // 1024 % 32 AS INT) + 1, 1)
                             || substr(a, CAST(v // 32 % 32 AS INT) + 1, 1) || substr(a, CAST(v % 32 AS INT) + 1, 1),
                             '' ORDER BY i) AS payload_digest
  FROM c, (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' AS a) GROUP BY page_id
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM r JOIN e USING (page_id)
""",
    # crc32 by its table of 256 remainders, built here, over the bytes of the distinct words
    "op11_target_resampling": r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab
), d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), dw AS (
  SELECT rid, w, count(*) AS n FROM (SELECT rid, unnest(ws) AS w FROM d) GROUP BY ALL
), bw AS (
  SELECT w, count(*) AS n
  FROM (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark)
  GROUP BY ALL
), vocab AS (
  SELECT w, xor(4294967295, list_reduce(
           list_concat([4294967295], list_transform(range(strlen(w)), lambda i: CAST('0x' || substr(hex(w), 2 * i + 1, 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
  FROM (SELECT w FROM dw UNION SELECT w FROM bw), crc
), s AS (
  SELECT bucket, CAST(sum(n) AS BIGINT) AS s FROM dw JOIN vocab USING (w) GROUP BY bucket
), t AS (
  SELECT bucket, CAST(sum(n) AS BIGINT) AS t FROM bw JOIN vocab USING (w) GROUP BY bucket
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(s), 0) FROM s) + 10000 AS DOUBLE)
           / (CAST(s + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(t), 0) FROM t) + 10000 AS DOUBLE)))) AS BIGINT) AS g
  FROM s LEFT JOIN t USING (bucket)
), w AS (
  SELECT rid, CAST(sum(n * g) AS BIGINT) AS weight FROM dw JOIN vocab USING (w) JOIN gain USING (bucket) GROUP BY rid
), x AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')),
           1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN w USING (rid)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place FROM x
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= (SELECT 10 * count(*) // 100 FROM x WHERE n_features >= 20) THEN place END AS rank
FROM r
""",
    # the nodes of all texts and edited texts by level; nodes that the other side lacks go on to the next level
    "op12_merkle_fingerprints": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id NULLS LAST) AS rid FROM documents
), n AS (
  SELECT *, coalesce(lead(rid) OVER (ORDER BY rid), 1) AS next_rid, coalesce(lead(t) OVER (ORDER BY rid), first_value(t) OVER (ORDER BY rid)) AS next_t
  FROM d
), e AS (
  SELECT rid, doc_id, t, next_rid, left(t, length(t) - length(t) // 2) || left(next_t, length(t) // 2) AS x FROM n
), texts AS (
  SELECT 2 * rid AS tid, t FROM e UNION ALL SELECT 2 * rid + 1, x FROM e
), lines AS (
  SELECT tid, generate_subscripts(ls, 1) AS li, unnest(ls) AS line FROM (SELECT tid, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS ls FROM texts)
), sentences AS (
  SELECT tid, li, generate_subscripts(ss, 1) AS si, unnest(ss) AS s
  FROM (SELECT tid, li, regexp_extract_all(line, '[^.!?\n]*[.!?]*[ \t\r\x0b\x0c]*\n?') AS ss FROM lines)
), words AS (
  SELECT tid, li, si, generate_subscripts(ws, 1) AS wi, unnest(ws) AS w
  FROM (SELECT tid, li, si, CASE WHEN length(s) <= 240 THEN [s]
                                 ELSE regexp_extract_all(s, '[^ \t\n\r\x0b\x0c]{1,64}[ \t\n\r\x0b\x0c]*|[ \t\n\r\x0b\x0c]+') END AS ws
        FROM sentences WHERE s <> '')
), cut AS (
  SELECT *, coalesce(sum(CASE WHEN starts_with(sha256(w), '0') THEN 1 ELSE 0 END)
                     OVER (PARTITION BY tid, li, si ORDER BY wi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ci FROM words
), leaf AS (
  SELECT tid, li, si, ci, left(sha256('leaf:' || string_agg(w, '' ORDER BY wi)), 32) AS h, CAST(sum(length(w)) AS BIGINT) AS c
  FROM cut GROUP BY tid, li, si, ci
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tid ORDER BY li, si, ci) AS k,
         coalesce(sum(c) OVER (PARTITION BY tid ORDER BY li, si, ci ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM leaf
), par AS (
  SELECT tid, li, left(sha256('paragraph:' || string_agg(h, '' ORDER BY k)), 32) AS h, sum(c) AS c FROM placed GROUP BY tid, li
), ends AS (
  SELECT par.*, regexp_full_match(line, '[ \t\n\r\x0b\x0c]*') OR left(h, 1) IN ('0', '4', '8', 'c') AS ends FROM par JOIN lines USING (tid, li)
), numbered AS (
  SELECT *, coalesce(sum(CASE WHEN ends THEN 1 ELSE 0 END)
                     OVER (PARTITION BY tid ORDER BY li ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS xi FROM ends
), sec AS (
  SELECT tid, xi, left(sha256('section:' || string_agg(h, '' ORDER BY li)), 32) AS h, sum(c) AS c FROM numbered GROUP BY tid, xi
), root AS (
  SELECT tid, left(sha256('root:' || coalesce(string_agg(h, '' ORDER BY xi), '')), 32) AS h, coalesce(sum(c), 0) AS c
  FROM texts LEFT JOIN sec USING (tid) GROUP BY tid
), pair AS (
  SELECT rid, 'edited' AS kind, 2 * rid AS a, 2 * rid + 1 AS b FROM e UNION ALL SELECT rid, 'next', 2 * rid, 2 * next_rid FROM e
), side AS (
  SELECT rid, kind, 'a' AS s, a AS tid FROM pair UNION ALL SELECT rid, kind, 'b', b FROM pair
), r1 AS (
  SELECT rid, kind, s, tid, xi, h, c, row_number() OVER (PARTITION BY rid, kind, s, h ORDER BY xi) AS k FROM side JOIN sec USING (tid)
), l1 AS (
  SELECT r1.*, coalesce(n, 0) AS n FROM r1 LEFT JOIN (SELECT rid, kind, s, h, count(*) AS n FROM r1 GROUP BY ALL) o
  ON o.rid = r1.rid AND o.kind = r1.kind AND o.h = r1.h AND o.s <> r1.s
), r2 AS (
  SELECT rid, kind, s, tid, p.li, p.h, p.c, row_number() OVER (PARTITION BY rid, kind, s, p.h ORDER BY p.li) AS k
  FROM l1 JOIN numbered p USING (tid, xi) WHERE l1.k > l1.n
), l2 AS (
  SELECT r2.*, coalesce(n, 0) AS n FROM r2 LEFT JOIN (SELECT rid, kind, s, h, count(*) AS n FROM r2 GROUP BY ALL) o
  ON o.rid = r2.rid AND o.kind = r2.kind AND o.h = r2.h AND o.s <> r2.s
), r3 AS (
  SELECT rid, kind, s, tid, p.h, p.c, p.place, row_number() OVER (PARTITION BY rid, kind, s, p.h ORDER BY p.k) AS k
  FROM l2 JOIN placed p USING (tid, li) WHERE l2.k > l2.n
), l3 AS (
  SELECT r3.*, coalesce(n, 0) AS n FROM r3 LEFT JOIN (SELECT rid, kind, s, h, count(*) AS n FROM r3 GROUP BY ALL) o
  ON o.rid = r3.rid AND o.kind = r3.kind AND o.h = r3.h AND o.s <> r3.s
), common AS (
  SELECT rid, kind, sum(c) AS common FROM (
    SELECT rid, kind, c FROM l1 WHERE s = 'a' AND k <= n UNION ALL SELECT rid, kind, c FROM l2 WHERE s = 'a' AND k <= n
    UNION ALL SELECT rid, kind, c FROM l3 WHERE s = 'a' AND k <= n) GROUP BY ALL
), near AS (
  SELECT rid, kind, x.h AS ha, y.h AS hb,
         CASE WHEN x.h = y.h THEN 1.0::DOUBLE ELSE CAST(2 * coalesce(common, 0) AS DOUBLE) / CAST(x.c + y.c AS DOUBLE) END AS near
  FROM pair JOIN root x ON x.tid = a JOIN root y ON y.tid = b LEFT JOIN common USING (rid, kind)
), span AS (
  SELECT rid, CAST(min(place) AS BIGINT) AS edit_start, CAST(max(place + c) AS BIGINT) AS edit_end FROM l3
  WHERE kind = 'edited' AND s = 'a' AND k > n GROUP BY rid
)
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, sha256(x) AS edited_sha256, f.ha AS fingerprint, f.hb AS edited_fingerprint,
       f.near AS near_edited, g.near AS near_next, edit_start, edit_end
FROM e JOIN near f ON f.rid = e.rid AND f.kind = 'edited' JOIN near g ON g.rid = e.rid AND g.kind = 'next' LEFT JOIN span ON span.rid = e.rid
""",
    "op13_collocations": r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM d
), o AS (
  SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
  FROM p, (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k
), f AS (
  SELECT lang, list_aggregate(ws[i : i + k - 1], 'string_agg', ' ') AS phrase, k, count(*) AS a FROM o GROUP BY ALL
), n AS (
  SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM p GROUP BY lang
), c AS (
  SELECT lang, phrase, string_split(phrase, ' ') AS ws, k, a FROM f WHERE k >= 2 AND a >= 100
), inner_ AS (
  SELECT DISTINCT lang, list_aggregate(ws[i : i + m - 1], 'string_agg', ' ') AS phrase, a AS longer
  FROM (SELECT lang, ws, k, a, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest(range(2, 5)) AS m) WHERE m < k)
), kept AS (
  SELECT * FROM c WHERE NOT EXISTS (
    SELECT 1 FROM inner_ x WHERE x.lang = c.lang AND x.phrase = c.phrase AND 100 * x.longer >= 100 * c.a)
), cuts AS (
  SELECT lang, phrase, a, j, list_aggregate(ws[1 : j], 'string_agg', ' ') AS first_part,
         list_aggregate(ws[j + 1 : k], 'string_agg', ' ') AS last_part
  FROM (SELECT *, unnest(range(1, k)) AS j FROM kept)
), scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, j, x.a AS l, y.a AS r, n,
         CAST(1000 * cuts.a::HUGEINT * n::HUGEINT // (x.a::HUGEINT * y.a::HUGEINT) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = first_part
  JOIN f y ON y.lang = cuts.lang AND y.phrase = last_part JOIN n ON n.lang = cuts.lang
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM lowest
)
SELECT * FROM ranked WHERE rank <= 2000
""",
}
