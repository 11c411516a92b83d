"""Registered queries of the training-data operators, and their DuckDB oracles where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe,
    exact_dedup,
    html_extract,
    language,
    packing,
    periodic_runs,
    quality,
    sharding,
    simhash,
    url_filter,
    warc_zip,
    whitening,
    winnowing,
)
from .common import SPACE_CLASS, materialize, table

SHARDS = [f"shard-{i:02d}" for i in range(32)]
SLOTS = 4099  # a prime, about 128 slots for each shard

# fixed values: the rules of the contract
URL_RULES = [
    url_filter.Rule("allow", "org/"),
    url_filter.Rule("block", "example.org/es/"),
    url_filter.Rule("block", "example.org/en/1"),
    url_filter.Rule("allow", "com/fr/"),
    url_filter.Rule("block", "com/de/"),
]


def op1_maglev_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sharding.assign_shards(docs, "doc_id", SHARDS, SLOTS, ["doc_id", "source", "n_chars"])


def op2_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096
    )
    return packing.with_checksums(pieces)


def op3_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = quality.with_counts(docs, keep=["doc_id", "lang", "source"])
    judged = quality.judge(materialize(counts, "quality-counts"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "failed")


def op4_host_path_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "path")


def op5_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest, folder = warc_zip.archive_pages(table(spark, sf_dir, "pages"))
    size = manifest.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    records = warc_zip.read_records(warc_zip.read_index(manifest, folder), folder, size)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = byte_bpe.Vocabulary.load(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.encode(docs, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(byte_bpe.packed(F.col("ids"), vocabulary), 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decode(F.col("ids"), vocabulary), 256).alias("decoded_sha256"),
    )


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, tau=4)
    return found.select("doc_id", simhash.fingerprint_hex("fp").alias("fingerprint"), "component_id", "kept")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact_dedup.exact_duplicates(docs, keep="largest").drop("row_id")


def op9_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocked keys: every host and path that some page gives with a ``ref=`` parameter."""
    pages = table(spark, sf_dir, "pages")
    tracked = url_filter.with_host_path(pages.filter(F.col("url").contains("ref=")).select("url"))
    listed = tracked.select(F.concat("host", "path").alias("key"))
    return url_filter.judge_urls(pages.select("page_id", "url"), listed, URL_RULES).drop("url")


def op10_zstd_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    model = language.fit(docs.filter(~held_out))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected"
    )


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.edited_fingerprints(table(spark, sf_dir, "documents"), k=12, w=16)
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        winnowing.digest(F.col("marks")).alias("fingerprint"),
        winnowing.digest(F.col("edited_marks")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        F.size("marks").cast("long").alias("n_marks"),
    )


def _repeating_tails(docs: DataFrame) -> DataFrame:
    """The contract's texts: of documents whose crc32 of the id ends in 0, words from one on repeat with a period.

    A document without an id stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(rf"[^{SPACE_CLASS[1:]}+"), F.lit(0))

    def tail(w: Column) -> Column:
        n, g = F.size(w), F.floor(h / 10)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        again = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(w, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")

    bound = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, tail(w)).otherwise(F.lit(""))), F.lit(0))
    return docs.select("doc_id", F.when(F.coalesce(h % 10 == 0, F.lit(False)), bound).otherwise(F.col("text")).alias("text"))


def op12_grammar_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_repeating_tails(table(spark, sf_dir, "documents")))
    longest = F.array_max(  # ties: the smallest start, then period
        F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("q")))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.s")).alias("start"),
        F.col("longest.n").alias("length"),
        (-F.col("longest.q")).alias("period"),
        F.floor(1000 * F.col("longest.n") / -F.col("longest.q")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


def op13_spectrum_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=16)


QUERIES = {f.__name__: f for f in (
    op1_maglev_sharding,
    op2_sum_of_squares_packing,
    op3_adaptive_quality,
    op4_host_path_extraction,
    op5_zip_warc,
    op6_byte_bpe,
    op7_simhash_near_dedup,
    op8_exact_dedup,
    op9_bloom_cascade,
    op10_zstd_language,
    op11_winnowing,
    op12_grammar_runs,
    op13_spectrum_whitening,
)}

_MD5_NUMBER = "('0x' || substr(md5({}), 1, 15))::BIGINT"

_OP1 = f"""
WITH RECURSIVE shards AS MATERIALIZED (
  SELECT i, 'shard-' || lpad(i::VARCHAR, 2, '0') AS shard,
         {_MD5_NUMBER.format("'shard-' || lpad(i::VARCHAR, 2, '0') || '#start'")} % {SLOTS} AS start,
         {_MD5_NUMBER.format("'shard-' || lpad(i::VARCHAR, 2, '0') || '#step'")} % {SLOTS - 1} + 1 AS step
  FROM range({len(SHARDS)}) r(i)),
turns AS (
  SELECT 0::BIGINT AS turn, list_transform(range({SLOTS}), lambda x: -1::BIGINT) AS taken
  UNION ALL
  SELECT turn + 1, list_transform(taken, lambda v, n: CASE WHEN n = slot + 1 THEN i ELSE v END)
  FROM (SELECT turn, taken, i, (start + step * list_filter(range({SLOTS}),
               lambda j: taken[(start + j * step) % {SLOTS} + 1] < 0)[1]) % {SLOTS} AS slot
        FROM turns JOIN shards ON i = turn % {len(SHARDS)} WHERE turn < {SLOTS})),
filled AS (SELECT taken FROM turns WHERE turn = {SLOTS}),
lookup AS (SELECT unnest(range({SLOTS}))::INTEGER AS slot, unnest(taken) AS i FROM filled)
SELECT doc_id, source, n_chars, slot, shard
FROM (SELECT doc_id, source, n_chars,
             ({_MD5_NUMBER.format("coalesce(doc_id::VARCHAR, '')")} % {SLOTS})::INTEGER AS slot FROM documents)
JOIN lookup USING (slot) JOIN shards USING (i)
"""

_WORD = r"[^\x20\x09-\x0D]+"
_SYMBOL = "[#*$%&|<>]"


def _by_metric(value) -> str:
    return "CASE metric " + " ".join(f"WHEN '{m}' THEN {value(f)}" for m, f in quality.FENCES.items()) + " END"


def _op3_sql() -> str:
    rates = ", ".join(
        f"{{'m': '{m}', 'v': CASE WHEN n_words >= {f.min_words} THEN 1000 * {f.count} // n_words END}}"
        for m, f in quality.FENCES.items()
    )
    order = _by_metric(list(quality.FENCES.values()).index)
    reach, floor, lower = _by_metric(lambda f: f.reach), _by_metric(lambda f: f.floor), _by_metric(lambda f: str(f.lower))
    spread = f"({reach}) * greatest(q75 - q25, {floor})"
    inner = f"(2 * ({reach}) + 1) * greatest(2 * least(q50 - q25, q75 - q50), {floor}) // 2"
    used = ", ".join(
        f"CASE WHEN o.n >= {quality.MIN_GROUP} THEN o.{q} WHEN l.n >= {quality.MIN_GROUP} THEN l.{q} ELSE a.{q} END AS {q}"
        for q in ("q25", "q50", "q75")
    )

    def quartiles(name: str, groups: str) -> str:
        by = f"{groups}, " if groups else ""
        return f"""{name} AS (
  SELECT {by}metric, sum(n) AS n, min(bin) FILTER (4 * upto >= total) AS q25, min(bin) FILTER (2 * upto >= total) AS q50,
         min(bin) FILTER (4 * upto >= 3 * total) AS q75
  FROM (SELECT *, sum(n) OVER (PARTITION BY {by}metric ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY {by}metric) AS total
        FROM (SELECT {by}metric, bin, sum(n) AS n FROM sketch GROUP BY ALL))
  GROUP BY ALL)"""

    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, lang, source, t, regexp_extract_all(t, '{_WORD}') AS ws,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS lines FROM d),
grams AS (SELECT r, i, list_aggregate(ws[i:i + 4], 'string_agg', ' ') AS g
          FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
again AS (SELECT r, i FROM grams JOIN (SELECT r, g FROM grams GROUP BY r, g HAVING count(*) > 1) USING (r, g)),
covered AS (SELECT r, count(DISTINCT p) AS n_repeat_words
            FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM again) GROUP BY r),
f AS (SELECT r, doc_id, lang, source, len(ws)::BIGINT AS n_words,
             length(list_aggregate(list_append(ws, ''), 'string_agg', ''))::BIGINT AS word_chars,
             len(regexp_extract_all(t, '{_SYMBOL}'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN covered USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f),
rates AS (SELECT r, lang, source, unnest([{rates}], recursive := true)
          FROM b WHERE NOT base_failed),
v AS (SELECT r, lang, source, m AS metric, v FROM rates WHERE v IS NOT NULL),
sketch AS (SELECT lang, source, metric, (v >> s) << s AS bin, count(*) AS n
           FROM (SELECT *, greatest(length(bin(v)) - 7, 0)::BIGINT AS s FROM v) GROUP BY ALL),
{quartiles("own", "lang, source")}, {quartiles("by_lang", "lang")}, {quartiles("of_all", "")},
peers AS (SELECT metric, max(low) FILTER (2 * low_nr >= groups) AS peer_low, min(high) FILTER (2 * high_nr >= groups) AS peer_high
          FROM (SELECT metric, low, high, count(*) OVER (PARTITION BY metric) AS groups,
                       row_number() OVER (PARTITION BY metric ORDER BY low DESC) AS low_nr,
                       row_number() OVER (PARTITION BY metric ORDER BY high) AS high_nr
                FROM (SELECT metric, q25 - {spread} AS low, q75 + {spread} AS high FROM own))
          GROUP BY metric),
used AS (SELECT o.lang, o.source, o.metric, {used}
         FROM own o JOIN by_lang l ON o.lang IS NOT DISTINCT FROM l.lang AND o.metric = l.metric
         JOIN of_all a ON o.metric = a.metric),
limits AS (SELECT lang, source, metric,
                  CASE WHEN {lower} THEN greatest(q25 - {spread}, least(q50 - {inner}, peer_low)) ELSE -1 END AS low,
                  least(q75 + {spread}, greatest(q50 + {inner}, peer_high)) AS high
           FROM used JOIN peers USING (metric)),
bad AS (SELECT r, arg_min(metric, {order}) AS metric
        FROM (SELECT v.r, v.metric
              FROM v JOIN limits u ON v.metric = u.metric AND v.lang IS NOT DISTINCT FROM u.lang
                   AND v.source IS NOT DISTINCT FROM u.source
              WHERE v.v < u.low OR v.v > u.high) GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND metric IS NULL AS kept, CASE WHEN base_failed THEN 'base' ELSE metric END AS failed
FROM b LEFT JOIN bad USING (r)
"""


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP8 = f"""
WITH n AS (SELECT row_number() OVER () AS r, doc_id, {_LOWER.format("coalesce(text, '')")} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST, r) = 1 AS kept, sha256(t) AS text_sha256
FROM n
"""

_RULE_CASES = sorted(URL_RULES, key=lambda r: -len(r.text))


def _rule_case(what: str) -> str:
    cases = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{getattr(r, what)}'"
        for r in _RULE_CASES
    )
    return f"CASE {cases} END"


_OP9 = f"""
WITH u AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
h AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, url, {_LOWER.format("raw")} AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
listed AS (SELECT DISTINCT host || path AS key FROM p WHERE contains(url, 'ref='))
SELECT page_id, host, path, {_rule_case("text")} AS rule,
       coalesce({_rule_case("verdict")}, CASE WHEN l.key IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       l.key IS NOT NULL AS on_list
FROM p LEFT JOIN listed l ON l.key = p.host || p.path
"""

_OP5 = """
WITH p AS (SELECT row_number() OVER () AS r, page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT r, page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
o AS (SELECT *, row_number() OVER w AS nr, first_value(page_id) OVER w AS head
      FROM d WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, r))
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND nr > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND nr > 1 THEN head END AS refers_to
FROM o
"""

ORACLES = {
    "op1_maglev_sharding": _OP1,
    "op3_adaptive_quality": _op3_sql(),
    "op5_zip_warc": _OP5,
    "op8_exact_dedup": _OP8,
    "op9_bloom_cascade": _OP9,
}
