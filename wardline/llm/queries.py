"""The operators on the test tables: one query each, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import canonical_turns, format_turns, read_back
from .collocations import collocations
from .exact import exact_groups
from .hard_negatives import hard_negatives
from .line_templates import drop_recurring_lines
from .packing import pack
from .quality import fit_quality, held_out, score_quality
from .rule_ledger import BASE, passes, POLICIES, rule_ledger
from .secret_scan import scan_secrets
from .simhash import near_duplicate_groups
from .suffix_dedup import remove_repeats
from .url_cascade import Cascade, rule_of, url_host, url_path
from .wu_manber import benchmark_hits

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


OWN_CONVERSATION = r"\### Assistant: </turn> ok"

def _escaped_sql(c: str) -> str:
    return rf"replace(replace({c}, '\', '\\'), '<|', '<\|')"


@query(
    "op2_chat_format",
    rf"""WITH turns AS (
 SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT -7, 0, 'user', '{OWN_CONVERSATION}' UNION ALL SELECT -7, 1, 'assistant', '{OWN_CONVERSATION}')
 SELECT conv_id, count(*) AS n_turns,
 sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
 CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
 CAST(sum(length({_escaped_sql("role")}) + length({_escaped_sql("text")}) + 23) AS BIGINT) AS formatted_chars
 FROM turns GROUP BY conv_id""",
)
def op2_chat_format(spark, sf):
    """Turns are ordered by turn, then role and text, so that repeated turn numbers have one order."""
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(OWN_CONVERSATION).alias("text"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))))
    records = rows.unionByName(own).groupBy("conv_id").agg(ordered.alias("rows"))
    records = records.select(
        "conv_id", F.transform("rows", lambda m: F.struct(m["role"].alias("role"), m["text"].alias("content"))).alias("messages")
    )
    formatted = format_turns(canonical_turns(records, ["messages"], keep=["conv_id"]), keep=["conv_id"])
    back = read_back(formatted, keep=["conv_id", "formatted"])
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    loss = F.concat_ws("", "loss_texts")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", F.transform("turns", line)), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query(
    "op7_exact_dedup",
    """WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
 g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
 SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)""",
)
def op7_exact_dedup(spark, sf):
    groups = exact_groups(table(spark, sf, "documents"), digest_all=True)
    return groups.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


URL_RULES = (
    ("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
)
# Fixed values, the block list of the query (link farms, betting, pharmacies, trackers, adult sites): a host is listed if one
# of its labels is one of these. The operator takes any list, as a column.
LISTED_LABELS = ("spam-farm", "free-bets", "casino-win", "cheap-pills", "ads-track", "adult-x")
_LISTED_SQL = " OR ".join(f"('.' || host || '.') LIKE '%.{w}.%'" for w in LISTED_LABELS)


@query(
    "op4_url_filter",
    rf"""WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
 h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
 r AS (SELECT *, CASE
 WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
 WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
 WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
 WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM h)
 SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
 WHEN {_LISTED_SQL} THEN 'block' ELSE 'allow' END AS verdict FROM r""",
)
def op4_url_filter(spark, sf):
    """Listed keys are the hosts with a listed label; the universe is every host of ``pages``."""
    urls = table(spark, sf, "pages").select("page_id", url_host("url").alias("host"), url_path("url").alias("path"))
    listed = F.arrays_overlap(F.split("host", r"\."), F.array(*[F.lit(w) for w in LISTED_LABELS]))
    cascade = Cascade.build(urls.select("host", listed.alias("listed")), "host", "listed")
    judged = cascade.contains(urls, "host", "in_list")
    rule, verdict = rule_of(F.col("host"), F.col("path"), URL_RULES)
    own = F.when(F.col("in_list"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"))


@query("op5_simhash")
def op5_simhash(spark, sf):
    groups = near_duplicate_groups(table(spark, sf, "documents"), words=3, distance=3)
    return groups.select("doc_id", F.lower(F.hex("fingerprint")).alias("fingerprint"), "component_id")


@query("op6_decontaminate")
def op6_decontaminate(spark, sf):
    hits = benchmark_hits(table(spark, sf, "documents"), table(spark, sf, "benchmark"), window=10)
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["first"])
    return hits.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


@query("op9_pack")
def op9_pack(spark, sf):
    return pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), size=2048)


@query("op10_suffix_dedup")
def op10_suffix_dedup(spark, sf):
    return remove_repeats(table(spark, sf, "documents"), length=100, digest=True).withColumnRenamed("kept", "kept_sha256")


@query("op3_quality")
def op3_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf, "labels"), "quality")
    scored = docs.select("doc_id", held_out().alias("held_out"), score_quality(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op8_secret_scan")
def op8_secret_scan(spark, sf):
    scanned = scan_secrets(table(spark, sf, "documents"))
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scanned.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


@query(
    "op1_line_dedup",
    r"""WITH o AS (SELECT doc_id, text, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS owner FROM documents),
 l AS (SELECT doc_id, owner, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
 unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS line_no FROM o),
 f AS (SELECT doc_id, owner, line_no, raw,
 regexp_replace(regexp_replace(trim(translate(raw, chr(9) || chr(13) || chr(12) || chr(11), '    '), ' '), '  +', ' ', 'g'), '[^ ]*[0-9][^ ]*', '<*>', 'g') AS masked FROM l),
 k AS (SELECT *, string_split(masked, ' ') AS tokens FROM f),
 c AS (SELECT *, len(tokens) AS n, tokens[1:3] AS lead FROM k WHERE masked <> ''),
 d AS (SELECT DISTINCT n, lead, masked, tokens FROM c),
 v AS (SELECT n, lead, place, token, count(*) AS votes FROM (SELECT n, lead, unnest(tokens) AS token, unnest(range(n)) AS place FROM d) GROUP BY ALL),
 t AS (SELECT n, lead, place, arg_min(token, (-votes, token)) AS token FROM v GROUP BY ALL),
 e AS (SELECT n, lead, list(token ORDER BY place) AS centre FROM t GROUP BY ALL),
 a AS (SELECT d.n, d.lead, d.masked,
 CASE WHEN len(list_filter(list_zip(d.tokens, e.centre), lambda x: x[1] = x[2])) >= CAST(0.6 AS DOUBLE) * d.n THEN '' ELSE d.masked END AS own
 FROM d JOIN e ON d.n = e.n AND d.lead = e.lead),
 r AS (SELECT a.n, a.lead, a.own FROM c JOIN a ON c.n = a.n AND c.lead = a.lead AND c.masked = a.masked
 GROUP BY a.n, a.lead, a.own HAVING count(DISTINCT c.owner) >= greatest(2, least(10, ceil(60 / a.n)))),
 g AS (SELECT a.masked FROM a JOIN r ON a.n = r.n AND a.lead = r.lead AND a.own = r.own)
 SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN g.masked IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
 sha256(coalesce(string_agg(raw, chr(10) ORDER BY line_no) FILTER (g.masked IS NULL), '')) AS kept_sha256
 FROM f LEFT JOIN g ON f.masked = g.masked GROUP BY doc_id""",
)
def op1_line_dedup(spark, sf):
    kept = drop_recurring_lines(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query(
    "op13_quality_rules",
    r"""WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
 w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
 e AS (SELECT r, unnest(words) AS word, unnest(range(len(words))) AS i FROM w),
 g AS (SELECT r, i, CASE WHEN lead(word, 4) OVER p IS NOT NULL THEN
 struct_pack(a := word, b := lead(word, 1) OVER p, c := lead(word, 2) OVER p, d := lead(word, 3) OVER p, e := lead(word, 4) OVER p) END AS five
 FROM e WINDOW p AS (PARTITION BY r ORDER BY i)),
 c AS (SELECT r, i, CASE WHEN five IS NOT NULL AND count(*) OVER (PARTITION BY r, five) > 1 THEN 1 ELSE 0 END AS again FROM g),
 h AS (SELECT r, max(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS covered FROM c),
 n AS (SELECT r, CAST(sum(covered) AS BIGINT) AS n_repeat_words FROM h GROUP BY r),
 m AS (SELECT doc_id, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
 length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
 coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
 length(regexp_replace(text, '[^A-Za-z\x{80}-\x{10FFFF}]', '', 'g')) AS n_letters, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
 len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]'))) AS n_letter_words,
 len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09\x0B-\x0D]*[-*•]'))) AS n_bullet_lines,
 len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09\x0B-\x0D]*$'))) AS n_ellipsis_lines
 FROM t JOIN w USING (r) LEFT JOIN n USING (r)),
 f AS (SELECT *, CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
 + CASE WHEN n_words > 1000000 THEN 4 ELSE 0 END + CASE WHEN 10 * word_chars < 25 * n_words THEN 8 ELSE 0 END
 + CASE WHEN word_chars > 12 * n_words THEN 16 ELSE 0 END + CASE WHEN 10 * n_symbols > n_words THEN 32 ELSE 0 END
 + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 64 ELSE 0 END + CASE WHEN 100 * n_letter_words < 80 * n_words THEN 128 ELSE 0 END
 + CASE WHEN 100 * n_upper > 60 * n_letters THEN 256 ELSE 0 END + CASE WHEN 100 * n_bullet_lines > 90 * n_lines THEN 512 ELSE 0 END
 + CASE WHEN 100 * n_ellipsis_lines > 30 * n_lines THEN 1024 ELSE 0 END AS bits FROM m)
 SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
 CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
 n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, bits = 0 AS kept, CAST(bits AS BIGINT) AS failed FROM f""",
)
def op13_quality_rules(spark, sf):
    """Kept by the newest policy; the bits of all failed rules come along."""
    ledger = rule_ledger(table(spark, sf, "documents"))
    return ledger.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~passes(BASE)).alias("base_failed"),
        passes(POLICIES[-1]).alias("kept"), "failed",
    )


@query(
    "op12_hard_negatives",
    """WITH e AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
 list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
 WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
 s AS (SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
 FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
 p AS (SELECT anchor, anchor_id, id, score, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS place FROM s WHERE same),
 n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
 row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.id) AS rank
 FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score WHERE p.place <= 5)
 SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""",
)
def op12_hard_negatives(spark, sf):
    rows = table(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query(
    "op11_collocations",
    r"""WITH t AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
 p AS (SELECT r, lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
 w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM p),
 i AS (SELECT lang, words, unnest(range(len(words))) AS i FROM w),
 o AS (SELECT lang, k, array_to_string(words[i + 1 : i + k], ' ') AS phrase FROM i, (SELECT unnest(range(1, 5)) AS k) WHERE i + k <= len(words)),
 f AS MATERIALIZED (SELECT lang, k, phrase, lang || chr(9) || phrase AS id, count(*) AS f FROM o GROUP BY ALL),
 n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
 c AS MATERIALIZED (SELECT lang, k, phrase, string_split(phrase, ' ') AS words, f AS a FROM f WHERE k > 1 AND f >= 30),
 s AS MATERIALIZED (SELECT lang, phrase, a, j, lang || chr(9) || array_to_string(words[1 : j], ' ') AS first,
 lang || chr(9) || array_to_string(words[j + 1 :], ' ') AS rest FROM c, (SELECT unnest(range(1, 4)) AS j) WHERE j < k),
 y AS MATERIALIZED (SELECT s.*, f.f AS l FROM s JOIN f ON f.id = s.first),
 x AS MATERIALIZED (SELECT y.lang, y.phrase, y.a, y.j, y.l, f.f AS r, CAST(2000000 * CAST(y.a AS HUGEINT) // (y.l + f.f) AS BIGINT) AS score
 FROM y JOIN f ON f.id = y.rest),
 b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
 d AS (SELECT DISTINCT b.lang, b.phrase FROM b JOIN c ON c.lang = b.lang AND len(c.phrase) > len(b.phrase)
 AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * CAST(c.a AS HUGEINT) >= 80 * CAST(b.a AS HUGEINT)),
 k AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
 FROM b LEFT JOIN d ON b.lang = d.lang AND b.phrase = d.phrase WHERE d.phrase IS NULL)
 SELECT k.lang, rank, phrase, a, l, r, n, score FROM k JOIN n USING (lang) WHERE rank <= 2000""",
)
def op11_collocations(spark, sf):
    return collocations(table(spark, sf, "documents"))
